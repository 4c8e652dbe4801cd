"""Base tables laid out for the questions asked of them: clustered for scopes, bucketed for joins on a place."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP_BYTES = 32 << 20
SCOPE = ("uf", "category")


def write_clustered(rows: DataFrame, path: str, by: str = "year", scope: Sequence[str] = SCOPE, spread: Sequence[str] = ("mun",), row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """``rows`` in a partition for every ``by``, ordered by ``scope`` inside it, so that a row group spans few states and categories.

    Row groups keep the least and the greatest value of every column; a question about a state or category reads only the groups that may hold
    it. One range shuffle deals the rows: ``spread`` goes on behind the scope, so that a state with a third of all rows is cut into
    several ranges. Null keys come first; an empty table leaves a table without rows.
    """
    order = [by, *scope, *spread]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").option("parquet.block.size", row_group_bytes).partitionBy(by).parquet(path)


def read_clustered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table under its declared schema, which an empty table has no file to tell."""
    return spark.read.schema(schema).parquet(path)


def write_bucketed(rows: DataFrame, path: str, keys: Sequence[str], buckets: int, name: str | None = None) -> DataFrame:
    """``rows`` as a catalogue table of files under ``path`` in ``buckets`` buckets of ``keys``, sorted by them, and read back.

    Tables of the same keys and number of buckets join, and roll up by ``keys``, without a shuffle, however often; the one shuffle is paid here. A task writes one
    bucket, so there are as many files as buckets. All rows of a key share a bucket: meant for keys that a survey bounds, like a municipality's categories and years.
    Without a ``name`` the table gets one of its own; dropping it leaves the files.
    """
    name = name or f"municipia_{uuid.uuid4().hex}"
    dealt = rows.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return rows.sparkSession.table(name)


def bucket_number(rows: int, per_bucket: int = 4_000_000) -> int:
    """Buckets for a table of ``rows`` rows; the larger table of a join decides for both."""
    return max(8, -(-rows // per_bucket))
