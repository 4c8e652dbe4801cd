"""Sharding by a keyed permutation of global row numbers.

Rows get numbers 0 .. n-1 in a hashed order, a Feistel network permutes the numbers, and a number's remainder and
quotient by the shard count are its shard and slot. Anyone who knows n and the key can compute both from the number.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.llm.common import bucket_count, feistel_sql, prefix_sums

MAX_WALK = 16


def permuted_sql(x: str, n: int, key: int) -> str:
    """SQL for a permutation of 0 .. n-1.

    The network works on high*low >= n values with high*low - n < high; values from n on walk their cycle further.
    A walk longer than MAX_WALK (for n > 256 its chance is below n**0.5 to the power -15) stops the job rather than give a wrong slot.
    """
    high = max(1, math.isqrt(max(0, n - 1)) + 1)
    low = max(1, -(-n // high))
    step = feistel_sql("y", high, low, key)
    return (
        f"aggregate(sequence(0, {MAX_WALK}), {feistel_sql(x, high, low, key)}, (y, k) -> CASE WHEN y < {n}L THEN y "
        f"WHEN k = {MAX_WALK} THEN CAST(raise_error('cycle walk too long: choose another key') AS BIGINT) ELSE {step} END)"
    )


def shard_rows(df: DataFrame, shards: int, key: int = 20_240_611) -> DataFrame:
    """``df`` with row_number, shard (0 .. shards-1) and slot (gapless from 0 in each shard).

    Shards differ by at most one row. Row numbers follow a hash of the whole row, whatever the partitioning; equal rows are
    counted first and numbered as a run, so that a row repeated without bound never meets in one task. Nulls are ordinary
    values. An empty frame gives an empty frame. Columns named row_number, shard or slot are refused, as are map columns.
    """
    clash = {"row_number", "shard", "slot"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    columns = df.columns
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    rows = df.count()
    hashed = counted.withColumn("_hash", F.xxhash64(F.lit(key), *columns))
    hashed = hashed.withColumn("_bucket", F.pmod("_hash", F.lit(bucket_count(rows)).cast("long")))
    numbered = prefix_sums(hashed, [], "_bucket", "_copies", ["_hash", *columns], "_first")
    runs = numbered.select(*columns, F.explode(F.expr("sequence(_first, _first + _copies - 1)")).alias("row_number"))
    place = runs.withColumn("_place", F.expr(permuted_sql("row_number", rows, key)))
    return place.select(*columns, "row_number", (F.col("_place") % shards).cast("int").alias("shard"), F.expr(f"_place div {shards}L").alias("slot"))
