"""Categories: type, group, first-time classification, and set comparisons with the lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.cleaning import contains_either_way, plain_name
from municipia.operators.lookups import attach


def flag_columns(groups: DataFrame) -> list[str]:
    """Every column of the lookup beside the category and its type is a flag."""
    return [c for c in groups.columns if c not in ("category", "kind")]


def attach_type(df: DataFrame, groups: DataFrame, category: str = "category") -> DataFrame:
    """``kind`` per row, TEM where the lookup has none."""
    return attach(df, groups, category, ["kind"], {"kind": F.lit(fixed.TEM)}, lookup_key="category")


def classify_group(df: DataFrame, groups: DataFrame, category: str = "category") -> DataFrame:
    """``kind`` and ``grp``: COL if flagged, else TRA for temporary and PER for the rest."""
    defaults = {"kind": F.lit(fixed.TEM), fixed.COL: F.lit(0)}
    flagged = attach(df, groups, category, ["kind", fixed.COL], defaults, lookup_key="category")
    grp = (
        F.when(F.col(fixed.COL) == 1, fixed.COL)
        .when(F.col("kind") == fixed.TEM, fixed.TRA)
        .otherwise(fixed.PER)
    )
    return flagged.withColumn("grp", grp).drop(fixed.COL)


def bootstrap_type(categories: DataFrame, keywords: Sequence[str] = tuple(fixed.PERMANENT_KEYWORDS), category: str = "category") -> DataFrame:
    """PER if any keyword occurs in the name, else TEM."""
    words = F.array(*[F.lit(word.lower()) for word in keywords])
    hit = F.exists(words, lambda word: F.lower(F.col(category)).contains(word))
    return categories.withColumn("kind", F.when(hit, fixed.PER).otherwise(fixed.TEM))


def matched_targets(name: Column, targets: Sequence[str]) -> Column:
    """Targets whose plain name equals, contains, or is contained in the plain name."""
    listed = F.array(*[F.lit(target) for target in targets])
    return F.filter(listed, lambda target: contains_either_way(plain_name(name), plain_name(target)))


def bootstrap_flag(categories: DataFrame, targets: Sequence[str] = tuple(fixed.COMBINE_CROPS), category: str = "category") -> DataFrame:
    """For each target the first matching category: ``target, category``.

    The targets are a short fixed list, so each category carries its own matches and no join is needed.
    """
    matches = categories.select(category, F.explode(matched_targets(F.col(category), targets)).alias("target"))
    return matches.groupBy("target").agg(F.min(category).alias(category))


def bootstrap_groups(categories: DataFrame, category: str = "category") -> DataFrame:
    """A first lookup ``category, kind, COL`` for categories that have none."""
    named = categories.select(category).where(F.col(category).isNotNull()).distinct()
    flagged = bootstrap_flag(named, category=category).select(category).distinct().withColumn(fixed.COL, F.lit(1))
    return attach(bootstrap_type(named, category=category), flagged, category, [fixed.COL], {fixed.COL: F.lit(0)})


def new_categories(fact: DataFrame, groups: DataFrame, category: str = "category") -> DataFrame:
    """Categories of the fact that the lookup lacks, with the default type and all flags 0."""
    seen = fact.select(category).where(F.col(category).isNotNull()).distinct()
    missing = seen.join(groups.select(F.col("category").alias(category)), category, "left_anti")
    flags = [F.lit(0).cast("int").alias(flag) for flag in flag_columns(groups)]
    return missing.select(F.col(category).alias("category"), F.lit(fixed.TEM).alias("kind"), *flags)


def extend_groups(fact: DataFrame, groups: DataFrame, category: str = "category") -> DataFrame:
    return groups.unionByName(new_categories(fact, groups, category))


def categories_of_kind(fact: DataFrame, groups: DataFrame, kind: str) -> DataFrame:
    seen = fact.select("category").where(F.col("category").isNotNull()).distinct()
    return attach_type(seen, groups).where(F.col("kind") == kind).select("category")


def combine_categories(fact: DataFrame, groups: DataFrame) -> DataFrame:
    """Flagged categories that occur in the data."""
    seen = fact.select("category").distinct()
    return groups.where(F.col(fixed.COL) == 1).select("category").distinct().join(seen, "category", "left_semi")


def tractor_categories(fact: DataFrame, groups: DataFrame) -> DataFrame:
    """Temporary categories that are not flagged as combine-harvested."""
    flagged = groups.where(F.col(fixed.COL) == 1).select("category")
    return categories_of_kind(fact, groups, fixed.TEM).join(flagged, "category", "left_anti")
