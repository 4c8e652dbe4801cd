"""Roll-ups along geography, category, group and year.

Measures may be raw columns or partial sums: yields travel as ``r_sum`` and ``r_n`` so that a
roll-up of a roll-up is still exact. Null keys are dropped first, as the surveys define their totals.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.units import scaled, total, total_sql
from municipia.operators.cells import SUFFIX
from municipia.operators.classify import classify_group
from municipia.operators.filters import drop_null_keys

CROP_SUMS = ("a", "p", "v")
LIVESTOCK_SUMS = ("q", "v")
YIELD_PARTS = ("r_sum", "r_n")


def with_yield_parts(fact: DataFrame, r: str = "r") -> DataFrame:
    """Replace the yield by its sum and count parts."""
    count = F.when(F.col(r).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return fact.withColumns({"r_sum": F.col(r), "r_n": count}).drop(r)


def yield_mean() -> Column:
    return F.when(F.col("r_n") > 0, F.col("r_sum").cast("double") / F.col("r_n"))


def yield_weighted(p: Column | None = None, a: Column | None = None) -> Column:
    p = F.col("p") if p is None else p
    a = F.col("a") if a is None else a
    return F.try_divide(p.cast("double") * 1000, a.cast("double"))


def _summed(df: DataFrame, name: str) -> Column:
    """Numbers of yields and of bad cells are counts and stay so; everything else may be whole units."""
    return F.sum(name).alias(name) if name == "r_n" or name.endswith(SUFFIX) else total(df, name)


def rollup(fact: DataFrame, keys: Sequence[str], sums: Sequence[str] = CROP_SUMS) -> DataFrame:
    """Sums per key, with map-side partial aggregation; a sum of nothing but nulls stays null."""
    return drop_null_keys(fact, keys).groupBy(*keys).agg(*[_summed(fact, c) for c in sums])


def rollup_base(fact: DataFrame, keys: Sequence[str] = ("uf", "mic", "mun", "category", "year"), sums: Sequence[str] = (*CROP_SUMS, *YIELD_PARTS)) -> DataFrame:
    """The finest roll-up, from which all others follow. Only category and year must be present."""
    return drop_null_keys(fact, ["category", "year"]).groupBy(*keys).agg(*[_summed(fact, c) for c in sums])


def rollup_state_category(fact: DataFrame, uf: str = "uf", category: str = "category", year: str = "year",
                          per_one: Mapping[str, int] | None = None, counts: Sequence[str] = ()) -> DataFrame:
    """Per state, category and year: sums, the plain mean of yields, and the area-weighted yield.

    ``per_one`` names the units of measures that are whole counts; the sums are then amounts. ``counts`` are added up beside them.
    """
    summed = scaled(rollup(fact, [uf, category, year], (*CROP_SUMS, *YIELD_PARTS, *counts)), per_one or {})
    return summed.withColumns({"r_mean": yield_mean(), "r_weighted": yield_weighted()})


# When a classified row belongs to a group: TEM and PER follow its type, COL and TRA its group.
GROUP_TESTS = {fixed.TEM: "kind = 'TEM'", fixed.PER: "kind = 'PER'", fixed.COL: "grp = 'COL'", fixed.TRA: "grp = 'TRA'"}


def membership(crops_as_groups: bool) -> Column:
    """All groups a classified row belongs to; combine-harvested categories are groups of their own."""
    members = [f"'{fixed.ALL}'", *[f"CASE WHEN {test} THEN '{code}' END" for code, test in GROUP_TESTS.items()]]
    if crops_as_groups:
        members.append(f"CASE WHEN {GROUP_TESTS[fixed.COL]} THEN category END")
    return F.expr(f"array_compact(array({', '.join(members)}))")


def rollup_membership(fact: DataFrame, groups: DataFrame, key: str = "mic", crops_as_groups: bool = True,
                      sums: Sequence[str] = CROP_SUMS, year: str = "year") -> DataFrame:
    """Per key, group and year, where a category counts in several groups.

    The fact shrinks to (key, category, year) before its rows are repeated per group.
    """
    base = rollup(fact, [key, "category", year], sums)
    members = classify_group(base, groups).withColumn("grp", F.explode(membership(crops_as_groups)))
    return rollup(members, [key, "grp", year], sums)


def rollup_membership_wide(fact: DataFrame, groups: DataFrame, key: str = "mun", sums: Sequence[str] = CROP_SUMS,
                           year: str = "year") -> DataFrame:
    """The four fixed groups of ``rollup_membership`` in one shuffle, for keys too many to roll up twice.

    Each group is a conditional sum, so no row is repeated before the shuffle.
    """
    classified = classify_group(drop_null_keys(fact, [key, "category", year]), groups)
    parts = [F.expr(f"count(1) FILTER (WHERE {test}) AS {code}_n") for code, test in GROUP_TESTS.items()]
    kinds = dict(classified.dtypes)
    parts += [F.expr(total_sql(kinds[c], c, test)).alias(f"{code}_{c}") for code, test in GROUP_TESTS.items() for c in sums]
    wide = classified.groupBy(key, year).agg(*parts)
    fields = {code: ", ".join(f"`{code}_{c}` AS `{c}`" for c in sums) for code in GROUP_TESTS}
    cells = ", ".join(f"struct('{code}' AS grp, {code}_n AS n, {fields[code]})" for code in GROUP_TESTS)
    long = wide.select(key, year, F.expr(f"inline(array({cells}))")).where("n > 0")
    return long.select(key, "grp", year, *sums)


def rollup_levels(fact: DataFrame, levels: Sequence[str] = ("uf", "mic", "mun"), sums: Sequence[str] = LIVESTOCK_SUMS,
                  category: str = "category", year: str = "year") -> DataFrame:
    """Every geography level at once: ``level, key, category, year`` and sums, by grouping sets.

    Levels are told apart by the grouping id, then each level drops its own null keys.
    """
    fine = drop_null_keys(fact, [category, year]).groupBy(*levels, category, year).agg(*[_summed(fact, c) for c in sums])
    sets = [[level, category, year] for level in levels]
    grouped = fine.groupingSets(sets, *levels, category, year).agg(
        F.grouping_id(*levels, category, year).alias("_gid"), *[_summed(fine, c) for c in sums]
    )
    columns = [*levels, category, year]
    ids = {level: sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in (level, category, year)) for level in levels}
    level_name = F.coalesce(*[F.when(F.col("_gid") == ids[level], F.lit(level)) for level in levels])
    key = F.coalesce(*[F.when(F.col("_gid") == ids[level], F.col(level).cast("string")) for level in levels])
    tagged = grouped.select(level_name.alias("level"), key.alias("key"), category, year, *sums)
    return tagged.where(F.col("key").isNotNull())


def pivot_variables(long: DataFrame, keys: Sequence[str], variables: Sequence[str], variable: str = "variable",
                    value: str = "value", order: str | None = None) -> DataFrame:
    """Long to wide: the first non-null value per cell, in ``order`` if given, else the smallest.

    Null index keys and rows without any value are dropped; a variable that never occurs is a null column.
    Conditional aggregates need one shuffle and combine on the map side.
    """
    kept = long.where(F.col(value).isNotNull())
    cells = []
    for name in variables:
        cell = F.when(F.col(variable) == name, F.col(value))
        if order is None:
            cells.append(F.min(cell).alias(name))
        else:
            cells.append(F.min_by(F.col(value), F.when(F.col(variable) == name, F.col(order))).alias(name))
    wide = drop_null_keys(kept, keys).groupBy(*keys).agg(*cells)
    return wide.dropna(how="all", subset=list(variables))


def sum_active(fact: DataFrame, active: DataFrame, key: str = "uf", metric: str = "p", category: str = "category") -> DataFrame:
    """Sum per state over an active category set."""
    chosen = fact.join(active.select(category), category, "left_semi")
    return drop_null_keys(chosen, [key]).groupBy(key).agg(total(fact, metric).alias("value"))


def category_totals(fact: DataFrame, metric: str = "p", category: str = "category") -> DataFrame:
    return drop_null_keys(fact, [category]).groupBy(category).agg(total(fact, metric).alias("value"))


def distinct_domain(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values; null is no value."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def profile(places: DataFrame, categories: DataFrame, mun: str = "mun", category: str = "category", uf: str = "uf", year: str = "year", rows: str | None = None) -> DataFrame:
    """One row: counts and the year range. Distinct keys are counted on the reduced combinations.

    ``places`` has municipality, state and year, and in ``rows`` the number of rows each of its rows stands for (one, if there is none); ``categories`` may be the same frame,
    or one that needs fewer joins.
    """
    count = F.count(F.lit(1)) if rows is None else F.sum(rows)
    reduced = places.groupBy(mun, uf).agg(count.alias("_n"), F.min(year).alias("_lo"), F.max(year).alias("_hi"))
    known = categories.agg(F.count_distinct(category)).scalar()
    counts = reduced.agg(
        F.sum("_n").cast("bigint").alias("row_count"), F.count_distinct(mun).alias("municipalities"), F.count_distinct(uf).alias("states"),
        F.min("_lo").alias("first_year"), F.max("_hi").alias("last_year"),
    )
    return counts.select("row_count", "municipalities", known.alias("categories"), "states", "first_year", "last_year")


def distinct_bitmaps(df: DataFrame, by: Sequence[str], numbers: Mapping[str, Column]) -> DataFrame:
    """Sets of whole numbers per group, as bitmaps that can be joined further: ``by``, name of the set, bucket, bits.

    ``numbers`` maps a set's name to an expression of at most one number a row; nulls are in no set. Each bitmap has a fixed size (32,768 numbers in 4 KB), so that
    neither a group nor a task holds a list. One pass serves all sets and every coarser grouping.
    """
    sets = F.array(*[F.struct(F.lit(name).alias("set"), number.cast("bigint").alias("n")) for name, number in numbers.items()])
    long = df.select(*by, F.explode(sets).alias("s")).select(*by, "s.set", "s.n").where(F.col("n").isNotNull())
    placed = long.select(*by, "set", F.bitmap_bucket_number("n").alias("bucket"), F.bitmap_bit_position("n").alias("bit"))
    return placed.groupBy(*by, "set", "bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """Exact distinct counts per coarser group, one column per set."""
    joined = bitmaps.groupBy(*by, "set", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("set") == s, F.bitmap_count("bits"))), F.lit(0)).cast("bigint").alias(s) for s in sets])


def scope_max(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Largest value per scope, never below 1."""
    top = F.greatest(F.max(F.col(value)).cast("double"), F.lit(1.0)).alias("scope_max")
    return df.groupBy(*by).agg(top) if by else df.agg(top)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Stack frames with different columns; what one lacks is null."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
