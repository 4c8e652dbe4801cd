"""Names that contain one another, found by an inverted index of character n-grams.

Of two names of which one contains the other, every n-gram of the shorter one occurs in the longer one. So each name is looked up under its rarest
trigram alone, in postings of the other table's names, and candidates are verified. Both tables may be of any size; no list goes into the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia.functions.cleaning import plain_name

GRAM = 3


def _grams(plain: Column, size: int) -> Column:
    """The distinct n-grams of ``size`` characters; none of shorter names."""
    characters = F.split(plain, F.lit(""))
    grams = characters
    for after in range(1, size):  # the last ones run over the end, and are null
        grams = F.zip_with(grams, F.slice(characters, after + 1, F.length(plain)), lambda left, right: F.concat(left, right))
    grams = F.array_compact(F.array_distinct(grams))
    return F.when(F.length(plain) >= size, grams).otherwise(F.array().cast("array<string>"))


def _looked_up(plain: Column) -> Column:
    """The n-grams of which a name needs one: its trigrams, or itself where it has none."""
    return F.when(F.length(plain) < GRAM, F.array(plain)).otherwise(_grams(plain, GRAM))


def _containing(short: DataFrame, long: DataFrame) -> DataFrame:
    """Pairs ``short, long`` of plain names where the second contains the first."""
    listed = F.concat(F.array(F.lit("")), *[_grams(F.col("long"), n) for n in range(1, GRAM + 1)])
    wanted = short.select("short", F.explode(_looked_up(F.col("short"))).alias("gram"))
    postings = long.select("long", F.explode(listed).alias("gram")).join(wanted.select("gram").distinct(), "gram", "left_semi")
    # A gram without postings has count 0 and is the rarest: its name has no match.
    counts = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarity = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")
    rarest = wanted.join(counts, "gram", "left").groupBy("short").agg(F.min(rarity).alias("least")).select("short", "least.gram")
    return rarest.join(postings, "gram").where(F.col("long").contains(F.col("short"))).select("short", "long")


def matched_names(names: DataFrame, targets: DataFrame, name: str = "category", target: str = "target") -> DataFrame:
    """``name, target``: all distinct pairs whose plain names are equal or contain one another.

    Null names match nothing. A name that is empty once it is plain is contained in every other, and gives a row for each of them.
    """
    mine = names.select(F.col(name).alias("_name"), plain_name(F.col(name)).alias("_mine")).where(F.col(name).isNotNull()).distinct()
    theirs = targets.select(F.col(target).alias("_target"), plain_name(F.col(target)).alias("_theirs")).where(F.col(target).isNotNull()).distinct()
    # Names of equal plain form are looked up once.
    mine_once, theirs_once = mine.select("_mine").distinct(), theirs.select("_theirs").distinct()
    longer = _containing(theirs_once.toDF("short"), mine_once.toDF("long")).select(F.col("long").alias("_mine"), F.col("short").alias("_theirs"))
    shorter = _containing(mine_once.toDF("short"), theirs_once.toDF("long")).select(F.col("short").alias("_mine"), F.col("long").alias("_theirs"))
    # Equal plain names come from both; the second look-up leaves them out.
    pairs = longer.unionByName(shorter.where(F.col("_mine") != F.col("_theirs")))
    return pairs.join(mine, "_mine").join(theirs, "_theirs").select(F.col("_name").alias(name), F.col("_target").alias(target))


def first_matches(names: DataFrame, targets: DataFrame, name: str = "category", target: str = "target") -> DataFrame:
    """For each target that any name matches, the first of those names and their number: ``target, name, matches``."""
    return matched_names(names, targets, name, target).groupBy(target).agg(F.min(name).alias(name), F.count(F.lit(1)).alias("matches"))
