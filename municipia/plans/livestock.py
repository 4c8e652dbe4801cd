"""Livestock batch: raw slices to the wide fact, and the wide fact to roll-ups and package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia import schemas
from municipia.functions.units import scaled, whole_units
from municipia.operators.cells import bad_counts, cell_report, fit_cells, poisoned, unfit_cells
from municipia.operators.filters import exclude_categories, normalise_measures
from municipia.operators.lookups import attach
from municipia.operators.quality import expected_slices, missing_slices
from municipia.operators.rollup import distinct_domain, rollup_base, rollup_levels, union_all
from municipia.operators.series import known_years
from municipia.sinks import files, packages
from municipia.sinks.tables import materialise
from municipia.sources.files import consolidate_table, read_raw_slices, rejected_slice_rows

MEASURES = ["q", "v"]
UNITS = dict.fromkeys(MEASURES, 1_000)
SUMS = (*MEASURES, *bad_counts(MEASURES))


def in_units(df: DataFrame) -> DataFrame:
    """Amounts as thousandths. A sum too large for that counts as a bad cell."""
    columns = {}
    for c, n in UNITS.items():
        units = whole_units(F.col(c), n)
        columns |= {c: units, f"{c}_bad": F.coalesce(F.col(f"{c}_bad"), F.lit(0)) + F.when(F.col(c).isNotNull() & units.isNull(), 1).otherwise(0)}
    return df.withColumns(columns)


def export_consolidated(spark: SparkSession, raw_folder: str, out_folder: str, last_year: int | None = None) -> DataFrame:
    """Wide herd, product and combined files under the column names of the surveys, for all landed years or up to ``last_year``.

    The slices that are missing up to the newest landed year, and the rows that do not fit, are reported beside them.
    """
    names = {name: source for source, (name, _) in schemas.LIVESTOCK_INDEX.items()}
    herd, product = (consolidate_table(spark, raw_folder, table, last_year) for table in fixed.SURVEY_TABLES)
    combined = union_all([herd, product])
    for name, frame in (("rebanho", herd), ("producao", product), ("completo", combined)):
        files.write_csv(frame.withColumnsRenamed(names), f"{out_folder}/{name}")
    newest = combined.agg(F.max("year")).first()[0]
    landed = union_all([
        read_raw_slices(spark, raw_folder, table, last_year).select(F.lit(table).alias("survey_table"), "year", "uf") for table in fixed.SURVEY_TABLES])
    if newest is not None:
        missing = missing_slices(expected_slices(spark, last_year=newest), landed)
        files.write_csv(missing, f"{out_folder}/missing_slices")
    files.write_csv(union_all([rejected_slice_rows(spark, raw_folder, table)for table in fixed.SURVEY_TABLES]), f"{out_folder}/rejected_rows")
    return combined


def clean_livestock(wide: DataFrame, mapping: DataFrame) -> DataFrame:
    """One (q, v) pair per row with its micro-region; totals over mixed units go.

    Rows whose municipality has no micro-region stay, with ``rejected`` = 1. NaN cells are missing, so a quantity takes the place of such a head-count; an infinite
    or too large head-count keeps its place. ``bad_cells`` lists them all.
    """
    measures = [c for c in schemas.LIVESTOCK_MEASURES if c in wide.columns]
    fitted = fit_cells(exclude_categories(wide, ["Total"]), dict.fromkeys(measures, UNITS["q"]))
    lacking = F.lit(0).cast("bigint")
    head, quantity, value = (F.col(f"{c}_bad") if c in measures else lacking for c in schemas.LIVESTOCK_MEASURES)
    no_head = F.col(schemas.LIVESTOCK_MEASURES[0]).isNull() if schemas.LIVESTOCK_MEASURES[0] in measures else F.lit(True)
    counted = fitted.withColumns({"q_bad": F.when(head > 0, head).when(no_head, quantity).otherwise(lacking), "v_bad": value})
    pairs = normalise_measures(counted.drop(*bad_counts(measures))).withColumn("q", F.when(F.col("q_bad") == 0, F.col("q")))
    return attach(pairs, mapping, "mun", ["mic"]).withColumn("rejected", F.col("mic").isNull().cast("int"))


def base_rows(cleaned: DataFrame) -> DataFrame:
    """Sums per place, category and year of the rows that have a micro-region, a category and a year."""
    kept = cleaned.where(F.col("rejected") == 0).dropna(subset=["category", "year"])
    return scaled(rollup_base(in_units(kept), ["uf", "mic", "mun", "kind", "category", "year"], SUMS), UNITS)


def levels(base: DataFrame) -> DataFrame:
    return poisoned(scaled(rollup_levels(in_units(base), sums=SUMS), UNITS), {m: [m] for m in MEASURES})


@dataclass(frozen=True)
class LivestockTables:
    base: DataFrame  # uf, mic, mun, kind, category, year, q, v, and the number of bad cells in each
    years: list[int]
    quality: DataFrame  # category, rows, rejected_rows
    rejected_cells: DataFrame  # mun, category, year, measure, problem, value

    def levels(self) -> DataFrame:
        return levels(self.base)

    def categories(self, kind: str) -> DataFrame:
        return distinct_domain(self.base.where(F.col("kind") == kind), "category")


def livestock_tables(wide: DataFrame, mapping: DataFrame, work_folder: str, run_id: str | None = None) -> LivestockTables:
    """The livestock base as a table partitioned by year; resumes like the crop tables."""
    cleaned = materialise(clean_livestock(wide, mapping), f"{work_folder}/livestock_fact", "rejected", run_id=run_id)
    summed = base_rows(cleaned)
    unfit = materialise(unfit_cells(cleaned, ["mun", "category", "year"]), f"{work_folder}/rejected_cells")
    report = cleaned.groupBy("category").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("rejected") == 1).alias("rejected_rows"))
    base = materialise(summed.hint("rebalance", "year"), f"{work_folder}/livestock", "year")
    return LivestockTables(base, known_years(base), materialise(report, f"{work_folder}/quality"), unfit)


def write_livestock_package(tables: LivestockTables, folder: str) -> None:
    """The six sections of the livestock package, and beside them the quality report and the cells that were left out or rounded."""
    files.write_csv(tables.quality, f"{folder}/quality")
    files.write_csv(tables.rejected_cells, f"{folder}/rejected_cells")
    files.write_csv(cell_report(tables.rejected_cells), f"{folder}/quality_cells")
    spark, years = tables.base.sparkSession, tables.years
    packages.write_section(packages.years_section(spark, years), f"{folder}/anos")
    packages.write_section(packages.list_section(tables.categories("Rebanho"), "category"), f"{folder}/rebanho_categorias")
    packages.write_section(packages.list_section(tables.categories("Producao"), "category"), f"{folder}/producao_categorias")
    levels = tables.levels()
    for level, section in (("uf", "est_data"), ("mic", "mic_data"), ("mun", "mun_data")):
        one = levels.where(F.col("level") == level).withColumnRenamed("key", "code")
        packages.write_section(packages.nested_section(one, "code", "category", MEASURES, years), f"{folder}/{section}")
