"""Yearly series: one value for every year, long or packed into arrays. Rows of one key and year add up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from municipia.functions.units import total_sql

def known_years(df: DataFrame, year: str = "year") -> list[int]:
    """The years that occur, sorted: the distinct values of one integer column."""
    return sorted(int(row[0]) for row in df.select(year).where(F.col(year).isNotNull()).distinct().collect())


def outside_years(df: DataFrame, years: Sequence[int], year: str = "year") -> DataFrame:
    """Rows per year that a caller's list leaves out of a series, a null year among them; no rows if the list is complete."""
    listed = F.coalesce(F.col(year).isin(*[int(y) for y in years]), F.lit(False))
    return df.where(~listed).groupBy(year).agg(F.count(F.lit(1)).alias("left_out"))


# An aggregate of more fields than this leaves Spark's generated code (spark.sql.codegen.maxFields is 100).
FIELDS = 90
MASK_BITS = 63


def _slot_width(years: Sequence[int], keys: Sequence[str], per_year: int) -> int:
    """How many calendar years share a row of slots: all of them while the aggregate stays narrow, else as many as fit, 8 at most."""
    if not years or len(years) * per_year + len(keys) <= FIELDS:
        return 0
    return max(1, min(8, (FIELDS - len(keys) - 1) // per_year))


def _slot_sums(df: DataFrame, keys: Sequence[str], measures: Sequence[str], years: Sequence[int], year: str, width: int) -> DataFrame:
    """Per key and block of ``width`` calendar years a sum and a row count for every slot, in one narrow aggregate. Years outside the list are block -1."""
    kinds, first = dict(df.dtypes), min(years)
    listed = F.col(year).isin(*years)
    placed = df.where(F.col(year).isNotNull()).withColumns({
        "_block": F.when(listed, F.expr(f"CAST((`{year}` - {first}) div {width} AS INT)")).otherwise(-1),
        "_slot": F.when(listed, F.expr(f"CAST((`{year}` - {first}) % {width} AS INT)"))})
    cells = []
    for i in range(width):
        cells.append(F.expr(f"count_if(_slot = {i})").alias(f"_n{i}"))
        cells += [F.expr(total_sql(kinds[m], m, f"_slot = {i}")).alias(f"_{m}{i}") for m in measures]
    return placed.groupBy(*keys, "_block").agg(*cells)


def pack_series(df: DataFrame, keys: Sequence[str], measures: Sequence[str], years: Sequence[int], year: str = "year") -> DataFrame:
    """One array per measure, position = year index, 0 = missing.

    Every element is a conditional sum, so rows combine on the map side and rows of one key and year add
    up: a fact that is not rolled up yet is packed within one shuffle. ``outside_years`` tells what a list leaves out. Where years and measures are too many for
    one aggregate, rows are packed into blocks of years first, and a key's few blocks are put together in a second step.
    """
    kinds, years = dict(df.dtypes), [int(y) for y in years]
    width = _slot_width(years, keys, 2 * len(measures) + 1)
    if width:
        return _pack_blocks(df, keys, measures, years, year, width)

    def array_of(measure: str) -> Column:
        elements = ", ".join(f"coalesce({total_sql(kinds[measure], measure, f'`{year}` = {y}')}, 0)" for y in years)
        return F.expr(f"array({elements})").alias(measure)

    return df.where(F.col(year).isNotNull()).groupBy(*keys).agg(*[array_of(m) for m in measures])


def _pack_blocks(df: DataFrame, keys: Sequence[str], measures: Sequence[str], years: Sequence[int], year: str, width: int) -> DataFrame:
    first = min(years)
    slots = _slot_sums(df, keys, measures, years, year, width)
    arrays = [F.expr(f"array({', '.join(f'coalesce(`_{m}{i}`, 0)' for i in range(width))})").alias(m) for m in measures]
    blocks = slots.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_block", F.struct(*arrays)))).alias("_blocks"))
    places = F.array(*[F.struct(F.lit((y - first) // width).alias("b"), F.lit((y - first) % width + 1).alias("s")) for y in years])

    def array_of(measure: str) -> Column:
        zero = F.lit(0).cast(dict(slots.dtypes)[f"_{measure}0"])
        return F.transform(places, lambda p: F.coalesce(F.try_element_at(F.try_element_at("_blocks", p["b"])[measure], p["s"]), zero)).alias(measure)

    return blocks.select(*keys, *[array_of(m) for m in measures])


def densify(df: DataFrame, keys: Sequence[str], measures: Sequence[str], years: Sequence[int], year: str = "year", rolled_up: bool = False) -> DataFrame:
    """One row per key and year: 0 where absent, with ``is_observed`` to tell zero from missing.

    Conditional sums and counts per year as in ``pack_series``, unfolded to rows: one shuffle, no collected lists. Without keys
    there is one series, also for an empty input. Too many years for one aggregate are summed in blocks; a mask of each key's blocks, the only thing
    shuffled again, tells which are missing. ``rolled_up`` says that ``df`` has one row per key and year, as a roll-up by them gives: nothing is
    summed then, and tasks sort narrow rows instead of holding one wide row per key.
    """
    kinds, years = dict(df.dtypes), [int(y) for y in years]
    if rolled_up and keys and years:
        return _fill_gaps(df, keys, measures, sorted(set(years)), year)
    if width := _slot_width(years, keys, 2 * len(measures) + 1):
        return _densify_blocks(df, keys, measures, years, year, width)
    cells = []
    for i, y in enumerate(years):
        cells.append(F.expr(f"count_if(`{year}` = {y})").alias(f"_n{i}"))
        cells += [F.expr(total_sql(kinds[m], m, f"`{year}` = {y}")).alias(f"_{m}{i}") for m in measures]
    wide = df.where(F.col(year).isNotNull()).groupBy(*keys).agg(*cells) if years else df.limit(0)
    if not years:
        return wide.select(*keys, F.lit(None).cast("int").alias(year), *measures, F.lit(False).alias("is_observed"))
    fields = [", ".join([f"{y} AS `{year}`", *[f"coalesce(`_{m}{i}`, 0) AS `{m}`" for m in measures], f"`_n{i}` > 0 AS is_observed"]) for i, y in enumerate(years)]
    return wide.select(*keys, F.expr(f"inline(array({', '.join(f'struct({f})' for f in fields)}))"))


def _fill_gaps(df: DataFrame, keys: Sequence[str], measures: Sequence[str], years: list[int], year: str) -> DataFrame:
    """Every row stands for its own year and the missing ones up to its key's next row; the first one also for those before it."""
    listed = F.array(*[F.lit(y) for y in years])
    # The place of the row's year in the list; rows of other years come last, and count only where their key has no listed one.
    placed = df.where(F.col(year).isNotNull()).withColumn("_at", F.nullif(F.array_position(listed, F.col(year).cast("int")), F.lit(0)).cast("int"))
    along = Window.partitionBy(*keys).orderBy(F.col("_at").asc_nulls_last())
    ranged = placed.withColumns({"_number": F.row_number().over(along), "_next": F.lead("_at").over(along)})
    first = F.when(F.col("_number") == 1, F.lit(1)).otherwise(F.col("_at"))
    spread = ranged.withColumn("_place", F.explode(F.sequence(first, F.coalesce("_next", F.lit(len(years) + 1)) - 1)))
    own = F.col("_place").eqNullSafe(F.col("_at"))
    zeros = {m: F.lit(0).cast(kind) for m, kind in df.dtypes}
    values = [F.coalesce(F.when(own, F.col(m)), zeros[m]).alias(m) for m in measures]
    return spread.select(*keys, F.element_at(listed, F.col("_place")).alias(year), *values, own.alias("is_observed"))


def _densify_blocks(df: DataFrame, keys: Sequence[str], measures: Sequence[str], years: Sequence[int], year: str, width: int) -> DataFrame:
    first = min(years)
    wanted = sorted({(y - first) // width for y in years})
    slots = _slot_sums(df, keys, measures, years, year, width)
    fields = [", ".join([f"{first} + _block * {width} + {i} AS `{year}`", *[f"coalesce(`_{m}{i}`, 0) AS `{m}`" for m in measures], f"`_n{i}` > 0 AS is_observed"]) for i in range(width)]
    seen = slots.where("_block >= 0").select(*keys, F.expr(f"inline(array({', '.join(f'struct({f})' for f in fields)}))"))
    masks = [F.expr(f"coalesce(bit_or(CASE WHEN _block >= 0 AND _block div {MASK_BITS} = {j} THEN shiftleft(1L, _block % {MASK_BITS}) END), 0L)").alias(f"_mask{j}")
             for j in range(max(wanted) // MASK_BITS + 1)]
    held = slots.groupBy(*keys).agg(*masks)
    tests = " + ".join(f"CASE WHEN b div {MASK_BITS} = {j} THEN shiftright(_mask{j}, b % {MASK_BITS}) & 1 ELSE 0 END" for j in range(len(masks)))
    missing = f"filter(array({', '.join(map(str, wanted))}), b -> ({tests}) = 0)"
    empty = held.select(*keys, F.expr(f"explode({missing})").alias("_block")).select(*keys, F.expr(f"explode(sequence({first} + _block * {width}, {first} + _block * {width} + {width - 1}))").alias(year))
    zeros = [F.lit(0).cast(dict(seen.dtypes)[m]).alias(m) for m in measures]
    return seen.unionByName(empty.select(*keys, year, *zeros, F.lit(False).alias("is_observed"))).where(F.col(year).isin(*years))


def yearly_totals(df: DataFrame, measures: Sequence[str], years: Sequence[int], year: str = "year", keys: Sequence[str] = ()) -> DataFrame:
    """Dense series of sums over whatever rows ``df`` holds."""
    return densify(df, keys, measures, years, year)


def series_state_from_municipalities(mun_values: DataFrame, mun_dim: DataFrame, years: Sequence[int], measures: Sequence[str],
                                     mun: str = "mun", uf: str = "uf") -> DataFrame:
    """State series built by adding up its municipalities."""
    located = mun_values.drop(uf).join(mun_dim.select(mun, uf), mun, "inner").where(F.col(uf).isNotNull())
    return yearly_totals(located, measures, years, keys=[uf])


def nest_package(packed: DataFrame, key: str, member: str, measures: Sequence[str]) -> DataFrame:
    """key -> member -> measure -> array, one row per key. Members are categories or groups, a short list."""
    entry = F.struct(F.col(member).alias("k"), F.struct(*measures).alias("m"))
    members = F.array_sort(F.collect_list(entry), lambda x, y: F.when(x.k < y.k, -1).when(x.k > y.k, 1).otherwise(0))
    return packed.groupBy(key).agg(F.map_from_entries(members).alias("package"))
