"""Session settings the operators count on, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings. AQE sizes shuffles, turns small sides into broadcasts at run time and
# splits hot join keys; the forced skew join matters where a join feeds an aggregate on its own key.
# Where every partition of one side is small, a hash join spares sorting the large side.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "municipia", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the runtime settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.showConsoleProgress", "false")
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master, where driver and executors share one disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master == "local" or context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="municipia-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def run_folder(spark: SparkSession, stem: str) -> str:
    """A folder of its own for one run, in the folder all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{stem}-{uuid.uuid4().hex}"
