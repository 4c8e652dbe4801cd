"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight that changes linearly over the run (time 0 to 1). The integral of the schedule is the source's share of
all words; the share of the integral up to time t is its cumulative demand. A word at a known place of its source's stream is due
at the time when demand reaches that place: the inverse of the integral. Sorting by due time gives the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from municipia.llm.common import WORD, bucket_count, free_name, join_null_safe, prefix_sums, table

WEIGHTS = (3, 1, 2)
# Slope of each weight's schedule: w(t) = w * (1 + slope * (1 - 2t)); the integral over the run is w.
SLOPES = (0.5, 0.0, -0.5)


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source, source_size, weight, slope, target.

    ``sizes`` has one row per source. Sources in code point order, null last, take WEIGHTS in turn. Targets add up to ``share``
    times all sizes; a target above ``most`` times its source's size stops there and the excess is shared by weight among the others:
    in order of size by weight, the saturated sources come first, so prefix sums settle it in one pass. Only rows of
    sources meet in this task, never rows of documents.
    """
    everything = Window.partitionBy()
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (F.col("_rank") % len(values) + 1).cast("int"))
    ranked = ranked.withColumn("weight", pick(WEIGHTS)).withColumn("slope", pick(SLOPES))
    demand = F.lit(share) * F.sum("source_size").over(everything)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "_rank")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = demand - F.lit(most) * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))
    full = left * F.col("weight") > F.lit(most) * F.col("source_size") * F.sum("weight").over(later)
    ranked = ranked.withColumn("_demand", demand).withColumn("_full", full)
    rest = F.col("_demand") - F.lit(most) * F.sum(F.when(F.col("_full"), F.col("source_size")).otherwise(0)).over(everything)
    unit = rest / F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("_full"), F.lit(most) * F.col("source_size")).otherwise(unit * F.col("weight"))
    return ranked.select("source", "source_size", "weight", "slope", target.alias("target"))


def due_time(u: Column, slope: Column) -> Column:
    """The time at which the share ``u`` of a source's demand is reached: the inverse of t + slope * (t - t^2)."""
    return F.when(slope == 0, u).otherwise((1 + slope - F.sqrt((1 + slope) * (1 + slope) - 4 * slope * u)) / (2 * slope))


def plan_mix(documents: DataFrame, keys: list[str], seed: int = 7) -> DataFrame:
    """One row per row of ``documents`` (``keys``, source, size): its copy number, source_size, target, taken, and the due times of its passes.

    A source is read in a hashed order, round and round, until its target (rounded to words) is reached. The last document may be
    taken in part. ``taken`` is the sum over the passes; ``passes`` holds (time, words). Null sizes count as 0, a null source is a source,
    equal rows are counted first and spread as a run, an empty table gives no rows.
    """
    rows = documents.select(*keys, "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"))
    counted = rows.groupBy(*keys, "source", "size").agg(F.count(F.lit(1)).alias("_copies"))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes)
    hashed = counted.withColumn("_hash", F.md5(F.concat_ws("|", F.lit(str(seed)), *keys).cast("binary")))
    number = F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long")
    hashed = hashed.withColumn("_bucket", number % F.lit(bucket_count(documents.count())).cast("long"))
    hashed = hashed.withColumn("_words", F.col("size") * F.col("_copies"))
    placed = prefix_sums(hashed, ["source"], "_bucket", "_words", ["_hash", *keys, "size"], "_first")
    placed = placed.withColumn("_copy", F.explode(F.expr("sequence(1L, _copies)")))
    placed = placed.withColumn("_begin", F.col("_first") + (F.col("_copy") - 1) * F.col("size"))
    known = join_null_safe(placed, targets, ["source"]).withColumn("_goal", F.floor(F.col("target") + 0.5).cast("long"))
    # Pass r covers the places r * source_size + [begin, begin + size) of the stream; the goal cuts the stream off.
    parts = F.expr(
        "filter(transform(sequence(0L, CASE WHEN source_size > 0 THEN _goal div source_size ELSE 0L END), r -> named_struct("
        "'at', r * source_size + _begin, 'words', greatest(0L, least(size, _goal - r * source_size - _begin)))), p -> p.words > 0)"
    )
    known = known.withColumn("_parts", parts)
    passes = F.transform("_parts", lambda p: F.struct(due_time(p["at"] / F.greatest(F.col("_goal"), F.lit(1)), F.col("slope")).alias("time"), p["words"].alias("words")))
    taken = F.aggregate("_parts", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    copy = F.col("_copy").alias("copy")
    return known.select(*keys, "source", "size", copy, "source_size", "target", taken.alias("taken"), passes.alias("passes"))


def training_positions(plan: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """One row per pass of ``plan``: ``keys``, source, size, copy, time, words, and ``position``, the number of words of the mix before it.

    Passes come in order of due time, ties by keys, source and copy. Demand is spread over time by bounded weights, so that equal spans of time
    hold about equal numbers of words: such spans are the ranges that are sorted and summed on their own.
    """
    by = [*keys, "source", "size", "copy"]
    due = plan.select(*by, F.explode("passes").alias("_pass")).select(*by, "_pass.time", "_pass.words")
    span = F.least(F.floor(F.col("time") * buckets), F.lit(buckets - 1)).cast("long")
    return prefix_sums(due.withColumn("_span", span), [], "_span", "words", ["time", *keys, "source", "copy"], "position").drop("_span")


def with_positions(plan: DataFrame, keys: list[str]) -> DataFrame:
    """``plan`` with n_passes, first_position and last_position (null without passes) instead of ``passes``. The plan's rows, no texts, are written once."""
    by = [*keys, "source", "size", "copy"]
    plan = table(plan)
    placed = training_positions(plan, keys, bucket_count(plan.count()))
    ends = placed.groupBy(*by).agg(F.min("position").alias("first_position"), F.max("position").alias("last_position"))
    out = join_null_safe(plan, ends, by, "left")
    return out.withColumn("n_passes", F.size("passes")).drop("passes")


def row_digest(docs: DataFrame) -> Column:
    """A string that rows share if they are equal in every column, nulls included (128 bits of hashes)."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    values = []
    for field in docs.schema:
        value = docs[field.name]
        values += [F.to_json(F.struct(value), {"ignoreNullFields": "false"}) if isinstance(field.dataType, nested) else value, value.isNull()]
    return F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(seed), *values)), 16, "0") for seed in (1, 2)))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix in training order, one row per whole pass; the columns of ``docs``.

    Needs text and source. Rows equal in every column count as copies of one row; rows that share a doc_id and differ anywhere are documents of their own.
    Passes that the target cuts off inside a document are left out, so that texts stay whole; that is less than one document
    a source. A document without words is never due. Rows are ranges of their position, sorted within.
    """
    row, at = free_name(docs, "_row"), free_name(docs, "_at")
    keyed = docs.withColumn(row, row_digest(docs))
    plan = table(plan_mix(keyed.select(F.col(row).alias("_row"), "source", word_count(F.col("text")).alias("size")), ["_row"]))
    placed = training_positions(plan, ["_row"], bucket_count(plan.count()))
    due = placed.filter(F.col("words") == F.col("size")).select(F.col("_row").alias(row), F.col("position").alias(at))
    mixed = keyed.dropDuplicates([row]).join(due, row)
    return mixed.repartitionByRange(at).sortWithinPartitions(at).select(*docs.columns)
