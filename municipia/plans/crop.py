"""Crop batch: fact and lookup in, roll-up tables and package out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.units import scaled, whole_units
from municipia.operators.cells import bad_counts, cell_report, fit_cells, poisoned, unfit_cells
from municipia.operators.classify import bootstrap_groups, categories_of_kind, combine_categories, extend_groups, tractor_categories
from municipia.operators.dims import micro_dim, municipality_dim, state_dim
from municipia.operators.lookups import derive_parent_code, states
from municipia.operators.quality import crop_checks
from municipia.operators.rollup import (
    distinct_domain, rollup, rollup_base, rollup_membership, rollup_membership_wide, rollup_state_category, with_yield_parts,
)
from municipia.operators.series import known_years
from municipia.sinks import packages
from municipia.sinks.files import save_category_groups, write_csv
from municipia.sinks.tables import materialise

MEASURES = ["a", "p", "v"]
# The survey's amounts have three decimals at most; sums of thousandths do not depend on row order.
UNITS = dict.fromkeys([*MEASURES, "r_sum"], 1_000)
BAD = bad_counts([*MEASURES, "r"])
# Published measures and what they are made of.
MADE_OF = {m: [m] for m in MEASURES}


def in_units(df: DataFrame) -> DataFrame:
    """Amounts as thousandths. A sum too large for that counts as a bad cell."""
    columns = {}
    for c, n in UNITS.items():
        units = whole_units(F.col(c), n)
        bad = f"{c.removesuffix('_sum')}_bad"
        columns |= {c: units, bad: F.coalesce(F.col(bad), F.lit(0)) + F.when(F.col(c).isNotNull() & units.isNull(), 1).otherwise(0)}
    return df.withColumns(columns)


def clean_crop_fact(fact: DataFrame) -> DataFrame:
    """State from the municipality code, yields as sum and count, and only cells that can be summed.

    Rows without a state, category or year stay, with ``rejected`` = 1. ``bad_cells`` lists the cells that are no numbers, or not as they were.
    """
    known = F.broadcast(states(fact.sparkSession))  # 27 rows
    located = derive_parent_code(fit_cells(fact, dict.fromkeys([*MEASURES, "r"], UNITS["a"])), known)
    lacking = F.col("uf").isNull() | F.col("category").isNull() | F.col("year").isNull()
    return with_yield_parts(located).withColumn("rejected", lacking.cast("int"))


def base_rows(kept: DataFrame) -> DataFrame:
    """The finest roll-up of cleaned rows, as amounts."""
    return scaled(rollup_base(in_units(kept), sums=(*MEASURES, "r_sum", "r_n", *BAD)), UNITS)


SUMS = (*MEASURES, *bad_counts(MEASURES))


def state_category(base: DataFrame) -> DataFrame:
    cells = rollup_state_category(in_units(base), per_one=UNITS, counts=BAD)
    return poisoned(cells, {**MADE_OF, "r_mean": ["r"], "r_weighted": ["p", "a"]})


def micro_groups(base: DataFrame, groups: DataFrame) -> DataFrame:
    return poisoned(scaled(rollup_membership(in_units(base), groups, "mic", sums=SUMS), UNITS), MADE_OF)


def municipality(base: DataFrame) -> DataFrame:
    return poisoned(scaled(rollup(in_units(base), ["mun", "year"], SUMS), UNITS), MADE_OF)


def municipality_groups(base: DataFrame, groups: DataFrame) -> DataFrame:
    return poisoned(scaled(rollup_membership_wide(in_units(base), groups, "mun", SUMS), UNITS), MADE_OF)


@dataclass(frozen=True)
class CropTables:
    """Everything the crop package and the interactive questions read."""

    base: DataFrame  # uf, mic, mun, category, year, a, p, v, r_sum, r_n, and the number of bad cells in each
    groups: DataFrame
    years: list[int]
    states: DataFrame
    micros: DataFrame
    municipalities: DataFrame
    quality: DataFrame  # name, rows
    rejected_cells: DataFrame  # mun, uf, category, year, measure, problem, value

    def state_category(self) -> DataFrame:
        return state_category(self.base)

    def micro_groups(self) -> DataFrame:
        return micro_groups(self.base, self.groups)

    def municipality(self) -> DataFrame:
        return municipality(self.base)

    def municipality_groups(self) -> DataFrame:
        return municipality_groups(self.base, self.groups)


def crop_tables(fact: DataFrame, groups: DataFrame | None, work_folder: str, run_id: str | None = None, groups_folder: str | None = None) -> CropTables:
    """Build the base roll-up once, as a table partitioned by year, and derive the rest from it.

    ``work_folder`` must be shared by all executors. A run that was cut off goes on where it stopped if
    it is given the same folder and the same input files, or the same ``run_id``. Without ``groups`` (the first run) the categories are
    classified by keywords. ``groups_folder``, a new folder, takes the lookup with the new categories, for people to edit.
    """
    spark = fact.sparkSession
    # One pass over the delimited files; all that follows reads single columns of its result.
    cleaned = materialise(clean_crop_fact(fact), f"{work_folder}/fact", "rejected", run_id=run_id)
    kept = cleaned.where(F.col("rejected") == 0)
    if groups is None:
        groups = bootstrap_groups(kept)
    # The tasks of the roll-up write its rows, each a file a year; gathering them by year first would shuffle the whole table again.
    base = materialise(base_rows(kept), f"{work_folder}/base", "year")
    unfit = materialise(unfit_cells(cleaned, ["mun", "uf", "category", "year"]), f"{work_folder}/rejected_cells")
    report = materialise(crop_checks(cleaned, groups).unionByName(cell_report(unfit)), f"{work_folder}/quality")
    extended = materialise(extend_groups(base, groups), f"{work_folder}/groups", run_id=run_id)
    if groups_folder:
        save_category_groups(extended, groups_folder)
    return CropTables(
        base=base,
        groups=extended,
        years=known_years(base),
        states=state_dim(base, states(spark)),
        micros=materialise(micro_dim(kept), f"{work_folder}/micros"),
        municipalities=materialise(municipality_dim(kept), f"{work_folder}/municipalities"),
        quality=report,
        rejected_cells=unfit,
    )


def write_crop_package(tables: CropTables, folder: str) -> None:
    """The thirteen sections of the crop package, and beside them the quality report and the cells that were left out or rounded."""
    spark, years = tables.base.sparkSession, tables.years
    sections = {
        "anos": packages.years_section(spark, years),
        "culturas": packages.list_section(distinct_domain(tables.base, "category"), "category"),
        "colheitadeiras": packages.list_section(combine_categories(tables.base, tables.groups), "category"),
        "tratores": packages.list_section(tractor_categories(tables.base, tables.groups), "category"),
        "permanentes": packages.list_section(categories_of_kind(tables.base, tables.groups, fixed.PER), "category"),
        "temporarias": packages.list_section(categories_of_kind(tables.base, tables.groups, fixed.TEM), "category"),
        "ufs_info": packages.info_section(tables.states, "uf", {"uf_name": "n", "region": "r"}),
        "mic_info": packages.info_section(tables.micros, "mic", {"mic_name": "n", "uf": "uf", "meso_name": "ms"}),
        "mun_info": packages.info_section(tables.municipalities, "mun", {"mun_name": "n", "uf": "uf", "mic": "mid"}),
        "est_data": packages.nested_section(
            tables.state_category().withColumnRenamed("r_mean", "r"), "uf", "category", [*MEASURES, "r"], years),
        "mic_data": packages.nested_section(tables.micro_groups(), "mic", "grp", MEASURES, years),
        "mun_data": packages.flat_section(tables.municipality(), ["mun"], MEASURES, years),
        "mun_grp_data": packages.flat_section(tables.municipality_groups(), ["grp", "mun"], MEASURES, years),
    }
    for name, section in sections.items():
        packages.write_section(section, f"{folder}/{name}")
    write_csv(tables.quality, f"{folder}/quality")
    write_csv(tables.rejected_cells, f"{folder}/rejected_cells")
