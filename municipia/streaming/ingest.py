"""Load only the slices that are new since the last run, and replace corrected ones."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import schemas
from municipia.functions.cleaning import clean_numeric
from municipia.session import ensure_checkpoint_dir
from municipia.sources.files import as_kind, slice_identity

SLICE = ["survey_table", "slice_year", "uf"]


def newest_file_per_slice(rows: DataFrame) -> DataFrame:
    """Of several files for one slice keep the newest; names break ties of the time."""
    arrived = F.struct("file_time", "file_name")
    files = rows.select(*SLICE, arrived.alias("_newest")).distinct()
    newest = files.groupBy(*SLICE).agg(F.max("_newest").alias("_newest"))
    return rows.join(newest, SLICE).where(arrived == F.col("_newest")).drop("_newest")


def _newer_than_table(spark: SparkSession, rows: DataFrame, table_path: str) -> DataFrame:
    """Rows of files that are newer than what the table holds for their slice."""
    try:
        held = spark.read.parquet(table_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows
    ensure_checkpoint_dir(spark)
    # One row per slice, cut off from the table, as the table is about to be overwritten.
    held = held.groupBy(*SLICE).agg(F.max(F.struct("file_time", "file_name")).alias("_held")).checkpoint()
    arrived = F.struct("file_time", "file_name")
    return rows.join(held, SLICE, "left").where(F.col("_held").isNull() | (arrived > F.col("_held"))).drop("_held")


def ingest_new_slices(spark: SparkSession, folder: str, table_path: str, checkpoint: str, pattern: str = "ppm_*.csv", touched_path: str | None = None) -> None:
    """Read files not read before, write them into ``table_path``, stop. ``touched_path`` logs the slices that each batch replaces, for a refresh of what is built on them.

    The table is partitioned by slice (survey table, year, state) and a batch overwrites just the partitions it holds. So a batch
    that runs again after a failure changes nothing, and a corrected slice that lands under a new name
    replaces its old rows; a state that a corrected file lacks keeps its rows. Rows keep their file's name and time: an older file that arrives late
    replaces nothing. A file rewritten under its old name is not read again, and a file with another header stops the load. The rebalance
    hint gives a slice as many tasks as its size needs.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        newest = _newer_than_table(spark, newest_file_per_slice(batch), table_path)
        if touched_path is not None:
            # Logged before the table changes, and added to: the second try of a batch finds some slices in the table already.
            newest.select(*SLICE).distinct().write.mode("append").parquet(f"{touched_path}/batch={number}")
        (
            newest.hint("rebalance", *SLICE)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*SLICE).parquet(table_path)
        )
        batch.unpersist()

    landed = (
        spark.readStream.schema(schemas.RAW_SLICE_SCHEMA)
        .option("sep", ";").option("header", True).option("enforceSchema", False).option("pathGlobFilter", pattern)
        .csv(folder)
    )
    columns = [
        as_kind(F.col(source), kind).alias(name) if name != "value" else clean_numeric(F.col(source)).alias(name)
        for source, (name, kind) in schemas.LIVESTOCK_LONG.items()
    ]
    stamped = landed.select(
        *columns,
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )
    rows = stamped.select("*", *slice_identity("file_name")).where(F.col("mun").isNotNull())
    query = (
        rows.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def landed_slices(spark: SparkSession, table_path: str) -> DataFrame:
    """Slices in the table; for comparison with the expected grid."""
    return spark.read.parquet(table_path).select(*SLICE).distinct().withColumnRenamed("slice_year", "year")
