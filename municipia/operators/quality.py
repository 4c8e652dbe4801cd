"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.operators.classify import classify_group, new_categories
from municipia.operators.rollup import GROUP_TESTS


def state_check(df: DataFrame, uf: str = "uf", uf_file: str = "uf_file") -> DataFrame:
    """Rows in all, rows whose code names no state, rows whose file state differs from the code's."""
    differs = F.col(uf).isNotNull() & F.col(uf_file).isNotNull() & (F.col(uf) != F.col(uf_file))
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(uf).isNull()).alias("unmapped"),
        F.count_if(differs).alias("disagreeing"),
    )


def expected_slices(spark: SparkSession, tables: Sequence[int] = tuple(fixed.SURVEY_TABLES), first_year: int = fixed.FIRST_YEAR,
                    last_year: int = fixed.LAST_YEAR) -> DataFrame:
    """The grid of (table, year, state) slices a complete load has, from the survey's first year to the one given."""
    listed = F.array(*[F.lit(t) for t in tables])
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    ufs = F.array(*[F.lit(state[1]) for state in fixed.STATES])
    return (
        spark.range(1)
        .select(F.explode(listed).alias("survey_table"))
        .select("survey_table", F.explode(years).alias("year"))
        .select("survey_table", "year", F.explode(ufs).alias("uf"))
    )


def missing_slices(expected: DataFrame, landed: DataFrame, keys: Sequence[str] = ("survey_table", "year", "uf")) -> DataFrame:
    return expected.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def reject_count(rejects: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    count = F.count(F.lit(1)).alias("rejected_rows")
    return rejects.groupBy(*by).agg(count) if by else rejects.agg(count)


def crop_checks(located: DataFrame, groups: DataFrame) -> DataFrame:
    """(name, rows) of what the crop batch leaves out or had to assume. ``located`` has uf from the code beside uf_file."""
    known = F.col("uf").isNotNull()
    checks = {
        "rows": F.lit(True), "unknown_state": ~known, "state_differs_from_file": known & F.col("uf_file").isNotNull() & (F.col("uf") != F.col("uf_file")),
        "no_category": known & F.col("category").isNull(), "no_year": known & F.col("category").isNotNull() & F.col("year").isNull(),
    }
    counted = located.agg(*[F.count_if(test).alias(name) for name, test in checks.items()])
    cells = ", ".join(f"struct('{name}' AS name, `{name}` AS rows)" for name in checks)
    long = counted.select(F.expr(f"inline(array({cells}))"))
    fresh = new_categories(located.where(known), groups).select(F.concat(F.lit("new_category: "), "category").alias("name"), F.lit(0).cast("bigint").alias("rows"))
    return long.unionByName(fresh)


def mapping_report(counted: DataFrame, mapping: DataFrame, by: Sequence[str], mun: str = "mun", mic: str = "mic") -> DataFrame:
    """Per ``by``: rows with and without a micro-region, and the micro-regions met. ``counted`` has ``rows`` per municipality; one join serves both counts."""
    joined = counted.join(mapping.select(F.col(mun), F.col(mic)), mun, "left")
    known = F.col(mic).isNotNull()
    return joined.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(known, F.col("rows"))), F.lit(0)).alias("kept_rows"),
        F.count_distinct(F.when(known, F.col(mic))).alias("micro_regions"),
        F.coalesce(F.sum(F.when(~known, F.col("rows"))), F.lit(0)).alias("rejected_rows"),
    )


def group_profile(fact: DataFrame, groups: DataFrame, mun: str = "mun") -> DataFrame:
    """Municipalities per group. One row per municipality with four flags, then a plain count of flags."""
    pairs = fact.select(mun, "category").dropna().distinct()
    classified = classify_group(pairs, groups)
    flags = classified.groupBy(mun).agg(*[F.expr(f"max({test}) AS {code}") for code, test in GROUP_TESTS.items()])
    counts = flags.agg(*[F.expr(f"count_if({code}) AS {code}") for code in GROUP_TESTS])
    cells = ", ".join(f"struct('{code}' AS grp, {code} AS municipalities)" for code in GROUP_TESTS)
    return counts.select(F.expr(f"inline(array({cells}))"))
