"""The survey tables played by a trade schema (orders and events), for tests and benchmarks.

state = nation, micro-region = nation and market segment, municipality = customer, category = brand,
year = order year; a, p, v = quantity, price, discounted price; r = retail price. Livestock rows are
events: category = event type, year = day of month. Amounts are whole counts of the units below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.units import whole_units
from municipia.operators.series import known_years

PRODUCT_TYPES = ("purchase", "signup")
CROP_UNITS = {"a": 1, "p": 100, "v": 10_000, "r_sum": 100}
LIVESTOCK_UNITS = {"q": 100, "v": 100}


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table under its declared schema; inferring one costs a job per read."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def geography(spark: SparkSession, folder: str, region: bool = False) -> DataFrame:
    """One row per customer: municipality, micro-region, state, and macro-region if asked for."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    places = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    columns = [
        F.col("c_custkey").alias("mun"), F.col("c_name").alias("mun_name"),
        F.concat("n_name", F.lit("-"), "c_mktsegment").alias("mic"), F.col("c_mktsegment").alias("mic_name"),
        F.col("n_name").alias("uf"),
    ]
    if region:
        regions = table(spark, folder, "region")
        places = places.join(regions, places.n_regionkey == regions.r_regionkey)
        columns.append(F.col("r_name").alias("region"))
    return places.select(*columns)


def state_names(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("uf"), F.initcap("n_name").alias("uf_name"), F.col("r_name").alias("region"),
    )


PART_COLUMNS = {"category", "r_sum", "r_n"}
PLACE_COLUMNS = {"uf", "mic", "mic_name", "mun_name"}


def years(spark: SparkSession, folder: str) -> list[int]:
    """The years of the orders."""
    return known_years(table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")))


def quarters(spark: SparkSession, folder: str) -> list[int]:
    """The quarters of the orders, counted from the year 0."""
    return known_years(table(spark, folder, "orders").select((F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1).alias("year")))


def _line_measures() -> dict[str, Column]:
    price, discount = whole_units(F.col("l_extendedprice")), whole_units(F.col("l_discount"))
    return {"a": whole_units(F.col("l_quantity"), 1), "p": price, "v": price * (F.lit(100) - discount), "n": F.lit(1).cast("bigint")}


def crop_fact(spark: SparkSession, folder: str, *columns: str, combine: bool = True) -> DataFrame:
    """Line items as crop rows with the named columns, joining only the tables these columns need.

    Declared constraint: every line item has its part and order, and every order its customer and nation (a test checks the given
    tables). So a join that brings no column changes no row, yet would shuffle the largest table. Prices and discounts have two
    decimals at most; finer ones would be rounded to cents. With ``combine`` line items shrink to partial sums (``n`` counts them), or to
    distinct keys if no measure is named, on their join key, if they have only one: this needs no shuffle beyond the
    join's own, and a hot key becomes few rows before it. Join sides carry no hint; Spark broadcasts
    them only while their files are small, and splits hot keys of a shuffled join.
    """
    needs_part = bool(PART_COLUMNS.intersection(columns))
    needs_order = bool({"year", "quarter", "mun", *PLACE_COLUMNS}.intersection(columns))
    measures = {name: column for name, column in _line_measures().items() if name in columns}
    keys = [k for k, needed in (("l_partkey", needs_part), ("l_orderkey", needs_order)) if needed]
    rows = table(spark, folder, "lineitem").select(*keys, *[column.alias(name) for name, column in measures.items()])
    counts_lines = bool({"r_sum", "r_n"}.intersection(columns))
    if combine and len(keys) == 1 and not counts_lines:
        rows = rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures]) if measures else rows.distinct()
    if needs_part:
        part = table(spark, folder, "part").select(
            "p_partkey", F.col("p_brand").alias("category"), whole_units(F.col("p_retailprice")).alias("r_sum"),
            F.lit(1).cast("bigint").alias("r_n"),
        )
        rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if needs_order:
        quarter = F.year("o_orderdate") * 4 + F.quarter("o_orderdate") - 1
        bought = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("mun"), F.year("o_orderdate").alias("year"), quarter.alias("quarter"))
        if PLACE_COLUMNS.intersection(columns):
            bought = bought.join(geography(spark, folder), "mun")
        rows = rows.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*columns)


def category_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Lookup of brands: odd numbers are permanent, multiples of four combine-harvested."""
    number = F.substring_index("category", "#", -1).cast("int")
    brands = table(spark, folder, "part").select(F.col("p_brand").alias("category")).distinct()
    return brands.select(
        "category",
        F.when(number % 2 == 1, fixed.PER).otherwise(fixed.TEM).alias("kind"),
        F.when(number % 4 == 0, 1).otherwise(0).alias(fixed.COL),
    )


def event_kind() -> Column:
    return F.when(F.col("event_type").isin(*PRODUCT_TYPES), F.lit("Producao")).otherwise(F.lit("Rebanho"))


LIVESTOCK_COLUMNS = ("uf", "mic", "mun", "kind", "category", "year", "q", "v")


def livestock_rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Events as livestock rows with the named columns (all by default): quantity always, value only for products.

    Events shrink to sums per user and the named event columns before they meet their places. Unknown users have no place.
    """
    columns = columns or LIVESTOCK_COLUMNS
    events = table(spark, folder, "events")
    amount = whole_units(F.col("value"))
    made = {
        "kind": event_kind(), "category": F.col("event_type"), "year": F.dayofmonth("ts"), "q": amount,
        "v": F.when(F.col("event_type").isin(*PRODUCT_TYPES), amount).otherwise(F.lit(0).cast("bigint")),
    }
    keys, sums = (["user_id", *[c for c in made if c in columns and c not in "qv"]], [c for c in "qv" if c in columns])
    rows = events.select("user_id", *[made[c].alias(c) for c in (*keys[1:], *sums)])
    rows = rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]) if sums else rows.distinct()
    return rows.join(geography(spark, folder), F.col("user_id") == F.col("mun")).select(*columns)
