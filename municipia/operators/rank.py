"""Rankings. Ties are broken by the key, ascending, so results do not depend on row order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranking_order(value: str = "value", key: str = "key") -> list[Column]:
    return [F.col(value).desc(), F.col(key).asc()]


def top_k(df: DataFrame, k: int, value: str = "value", key: str = "key", keep_zeros: bool = False) -> DataFrame:
    """The ``k`` largest rows; each task keeps only its own best ``k`` before the merge."""
    kept = df if keep_zeros else df.where(F.col(value) > 0)
    return kept.orderBy(*ranking_order(value, key)).limit(k)


def ranked_top_k(df: DataFrame, k: int, value: str = "value", key: str = "key") -> DataFrame:
    """``top_k`` with its 1-based position. The window sees at most ``k`` rows."""
    best = top_k(df, k, value, key)
    return best.withColumn("position", F.row_number().over(Window.orderBy(*ranking_order(value, key))))


def top_k_per_scope(df: DataFrame, scope: Sequence[str], k: int, value: str = "value", key: str = "key") -> DataFrame:
    """The ``k`` largest positive rows of every scope, with their position.

    A filter on ``row_number`` lets Spark cut each task's rows to ``k`` per scope before the shuffle,
    so a scope with most of the rows sends few of them.
    """
    window = Window.partitionBy(*scope).orderBy(*ranking_order(value, key))
    positive = df.where((F.col(value) > 0))
    return positive.withColumn("position", F.row_number().over(window)).where(F.col("position") <= k)


# A range of a scope aims at this many rows; the cuts are quantiles of at most SAMPLE of its rows, one in ONE_IN by a hash.
PER_RANGE, SAMPLE, ONE_IN, STEP = 65_536, 4_096, 16, 64


def _cut_points(df: DataFrame, scope: Sequence[str], value: str, key: str, per_range: int, sample: int, one_in: int, ascending: bool = False) -> DataFrame:
    """Per scope the places (value, key) that cut it into as many even ranges as its rows ask for, in ranking order, and every STEP-th of them.

    Without a scope there is one row, whose cuts are null where nothing has to be cut.
    """
    hashed = F.xxhash64(*scope, key)
    drawn = df.where(F.pmod(hashed, F.lit(one_in)) == 0).select(*scope, F.col(value).alias("v"), F.col(key).alias("k"), hashed.alias("_h"))
    drawn = drawn.where(F.col("v").isNotNull())
    if scope:
        few = drawn.withColumn("_n", F.row_number().over(Window.partitionBy(*scope).orderBy("_h", "k"))).where(F.col("_n") <= sample)
    else:
        few = drawn.orderBy("_h", "k").limit(sample)
    up = 1 if ascending else -1
    order = lambda x, y: (
        F.when(x["v"] > y["v"], up).when(x["v"] < y["v"], -up).when(x["k"] < y["k"], -1).when(x["k"] > y["k"], 1).otherwise(0))
    drawn = few.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct("v", "k")), order).alias("_sample"))
    counted = df.groupBy(*scope).agg(F.count(F.lit(1)).alias("_rows")).where((F.col("_rows") > per_range) | F.lit(not scope))
    ranges = F.least(F.ceil(F.col("_rows") / per_range), F.size("_sample"))
    cuts = F.when(ranges > 1, F.transform(F.sequence(F.lit(1).cast("long"), ranges - 1), lambda j: F.try_element_at("_sample", F.floor(j * F.size("_sample") / ranges).cast("int") + 1)))
    both = drawn.join(counted, list(scope)) if scope else drawn.withColumn("_rows", counted.scalar())
    return both.select(*scope, cuts.alias("_cuts")).withColumn("_coarse", F.filter("_cuts", lambda _, i: i % STEP == 0))


def rank_position(df: DataFrame, scope: Sequence[str], value: str = "value", key: str = "key", per_range: int = PER_RANGE, sample: int = SAMPLE, one_in: int = ONE_IN,
                  ascending: bool = False) -> DataFrame:
    """1-based position of every row in its scope, however large one scope is: the largest value first, or with ``ascending`` the least. Null values come last.

    A scope of more than ``per_range`` rows is cut into ranges of (value, key), which also cut ties; their number follows from its rows, up to ``sample``. Rows are
    numbered inside their range; a range starts where the rows of the earlier ranges end. All of it is one plan; its uses of ``df`` share their last exchange.
    """
    def before(cut: Column) -> Column:
        earlier = cut["v"] < F.col(value) if ascending else cut["v"] > F.col(value)
        return earlier | ((cut["v"] == F.col(value)) & (cut["k"] <= F.col(key)))

    # The coarse cuts tell which STEP cuts to look at.
    steps = F.size(F.filter("_coarse", before))
    inside = F.size(F.filter(F.slice("_cuts", (steps - 1) * STEP + 1, F.lit(STEP)), before))
    found = F.when(F.col("_cuts").isNull(), 0).when(F.col(value).isNull(), F.size("_cuts") + 1).when(steps == 0, 0).otherwise((steps - 1) * STEP + inside)
    cuts = _cut_points(df, scope, value, key, per_range, sample, one_in, ascending)
    if scope:
        cut = df.join(cuts, list(scope), "left")
    else:
        cut = df.withColumn("_c", cuts.select(F.struct("_cuts", "_coarse")).scalar()).withColumns({"_cuts": F.col("_c._cuts"), "_coarse": F.col("_c._coarse")}).drop("_c")
    ranged = cut.withColumn("_range", found).drop("_cuts", "_coarse")
    parts = [*scope, "_range"]
    earlier = Window.partitionBy(*scope).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy(*parts).agg(F.count(F.lit(1)).alias("_size"))
    if not scope:
        sizes = sizes.orderBy("_range").limit(sample + 2)  # there are no more ranges
    starts = sizes.select(*parts, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))

    within = Window.partitionBy(*parts).orderBy(F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last(), F.col(key).asc())
    numbered = ranged.withColumn("_inside", F.row_number().over(within))
    position = (F.col("_start") + F.col("_inside")).cast("bigint")
    return numbered.join(starts, parts).withColumn("position", position).drop("_range", "_inside", "_start")


def value_over_scope_max(df: DataFrame, scope: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Each row beside its scope's maximum, which is never below 1.

    The maximum is an aggregate joined back, not a window, so no scope has to fit into one task.
    """
    top = F.greatest(F.max(F.col(value)).cast("double"), F.lit(1.0)).alias("scope_max")
    if not scope:
        return df.withColumn("scope_max", df.agg(top).scalar())
    return df.join(df.groupBy(*scope).agg(top), list(scope))
