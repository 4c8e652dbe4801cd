"""Helpers shared by the operators: names, checkpoints, orderings and prefix sums."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from municipia.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder; lost executors read them again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def table(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the shared checkpoint folder, read again. Shuffle files of the job that made them go at its end.

    For intermediate results that several later steps read and that are large: compressed, they take a fraction of a checkpoint.
    """
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name starting with ``stem`` that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def bucket_count(rows: int, per_bucket: int = 65_536) -> int:
    """Buckets for a hashed order of ``rows`` rows; it follows from the rows, not from the cluster."""
    return max(1_024, -(-rows // per_bucket))


def prefix_sums(df: DataFrame, group: list[str], bucket: str, value: str, order: list[str], out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in (bucket, order), per group.

    Only one bucket's rows meet in a task. Bucket totals are summed up in two levels of 1,024, so that the
    top level holds a row per million of buckets' worth of rows. Groups compare null-safe.
    """
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_total")).withColumn("_high", F.expr(f"`{bucket}` div 1024"))
    highs = totals.groupBy(*group, "_high").agg(F.sum("_total").alias("_high_total"))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    key = group or [F.lit(0)]
    highs = highs.withColumn("_high_before", F.coalesce(F.sum("_high_total").over(before(*key).orderBy("_high")), F.lit(0)))
    lows = totals.withColumn("_low_before", F.coalesce(F.sum("_total").over(before(*group, "_high").orderBy(bucket)), F.lit(0)))
    starts = join_null_safe(lows, highs.drop("_high_total"), [*group, "_high"])
    starts = starts.select(*group, bucket, (F.col("_low_before") + F.col("_high_before")).alias("_start"))
    inner = df.withColumn("_before", F.coalesce(F.sum(value).over(before(*group, bucket).orderBy(*order)), F.lit(0)))
    return join_null_safe(inner, starts, [*group, bucket]).withColumn(out, F.col("_before") + F.col("_start")).drop("_before", "_start")


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the right side's keys are dropped."""
    renamed = right.select(*(F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns))
    condition = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on))
    return left.join(renamed, condition, how).drop(*(f"_r_{c}" for c in on))


def feistel_sql(x: str, high: int, low: int, key: int, rounds: int = 8) -> str:
    """SQL for a keyed permutation of 0 .. high*low-1: an alternating Feistel network over two radices.

    Each round adds a hash of one part to the other, modulo that part's radix, so it can be undone.
    """
    return (
        f"aggregate(sequence(0, {rounds - 1}), named_struct('l', ({x}) div {low}L, 'r', ({x}) % {low}L), (s, i) -> CASE WHEN i % 2 = 0 "
        f"THEN named_struct('l', pmod(s.l + pmod(xxhash64({key}L, i, s.r), {high}L), {high}L), 'r', s.r) "
        f"ELSE named_struct('l', s.l, 'r', pmod(s.r + pmod(xxhash64({key}L, i, s.l), {low}L), {low}L)) END, s -> s.l * {low}L + s.r)"
    )


def unsigned_crc32(text: Column) -> Column:
    """Spark's crc32 is unsigned already; null counts as empty."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
