"""Every operator shown on the stand-in tables, one query each.

Queries run over the whole tables. Choices such as a group or a ``k`` are the feature shown, never
a way to read less.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia import schemas
from municipia.functions import cleaning, labels
from municipia.functions.units import scaled, total, whole_units
from municipia.operators import choropleth, classify, dims, filters, kpi, lookups, names, quality, rank, rollup, series
from municipia.params import Selection
from municipia.plans import roundtrips, standin
from municipia.plans.explorer import Explorer
from municipia.session import tune
from municipia.sinks import exports, files
from municipia.sources import api, geo
from municipia.sources import files as sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CROP = ["a", "p", "v"]
# Words for the first-time classification of the stand-in's product names.
FLAG_TARGETS = ["Red (widget)", "ring", "BLUE (bolt)", "small gear", "(Valve) green"]
KIND_KEYWORDS = ["eco", "promo", "ring"]
UNITS = [("click", "cab."), ("view", "cab."), ("purchase", "kg")]
VARIABLE_CODES = {"click": "105", "purchase": "106", "signup": "215"}
VARIABLE_NAMES = {"105": "Efetivo_Cabecas", "106": "Quantidade", "215": "Valor_mil_reais"}
LIVESTOCK_KEYS = ["mun", "kind", "category", "year"]


def query(function: Query) -> Query:
    """Register a query under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(tune(spark), folder)
    return function


def crop_amounts(df: DataFrame) -> DataFrame:
    return scaled(df, standin.CROP_UNITS)


def livestock_amounts(df: DataFrame) -> DataFrame:
    return scaled(df, standin.LIVESTOCK_UNITS)


def value_of(df: DataFrame, metric: str) -> DataFrame:
    """A summed metric as an amount in a column ``value``."""
    return df.withColumn(metric, F.col(metric) / F.lit(float(standin.CROP_UNITS[metric]))).withColumnRenamed(metric, "value")


def unknown_where(condition, column):
    """A code that no lookup knows where the condition holds, so that a query shows a miss over a whole lookup."""
    return F.when(condition, F.concat(F.lit("n/a "), column)).otherwise(column)


def groups_of(spark: SparkSession, folder: str) -> DataFrame:
    return standin.category_groups(spark, folder)


def explorer(spark: SparkSession, folder: str, *columns: str, groups: DataFrame | None = None, livestock: tuple[str, ...] = (), years: bool = False) -> Explorer:
    """The interactive questions over crop rows with these columns, or over ``livestock`` rows with those.

    Only a chosen group needs the lookup, and only a series the years.
    """
    places = standin.geography(spark, folder)
    return Explorer(
        crop=standin.crop_fact(spark, folder, *columns) if columns else None, groups=groups,
        livestock=standin.livestock_rows(spark, folder, *livestock) if livestock else None, states=standin.state_names(spark, folder),
        micros=places.select("mic", "mic_name", "uf").distinct(), municipalities=places, years=tuple(standin.years(spark, folder)) if years else (),
        crop_units=standin.CROP_UNITS, livestock_units=standin.LIVESTOCK_UNITS,
    )


# -- roll-ups ------------------------------------------------------------------------------------


@query
def state_category_rollup(spark, folder):
    cells = rollup.rollup_state_category(standin.crop_fact(spark, folder, "uf", "category", "year", "a", "p", "v", "r_sum", "r_n"), per_one=standin.CROP_UNITS)
    return cells.select("uf", "category", "year", *CROP, "r_mean", "r_weighted")


@query
def micro_membership_rollup(spark, folder):
    return crop_amounts(rollup.rollup_membership(standin.crop_fact(spark, folder, "mic", "category", "year", "a", "p", "v"), groups_of(spark, folder), "mic"))


@query
def micro_crop_groups(spark, folder):
    """Combine-harvested categories per micro-region, each as a group of its own."""
    cells = rollup.rollup(standin.crop_fact(spark, folder, "mic", "category", "year", "a", "p", "v"), ["mic", "category", "year"], CROP)
    combine = groups_of(spark, folder).where(F.col(fixed.COL) == 1).select("category")
    return crop_amounts(filters.rename_to_group(cells.join(combine, "category", "left_semi")))


@query
def mun_rollup(spark, folder):
    return crop_amounts(rollup.rollup(standin.crop_fact(spark, folder, "mun", "year", "a", "p", "v"), ["mun", "year"], CROP))


@query
def mun_group_rollup(spark, folder):
    return crop_amounts(rollup.rollup_membership_wide(standin.crop_fact(spark, folder, "mun", "category", "year", "a", "p", "v"), groups_of(spark, folder), "mun"))


@query
def base_rollup(spark, folder):
    # State and micro-region follow from the municipality: their texts join the rolled-up rows, not the lines.
    fact = standin.crop_fact(spark, folder, "mun", "category", "year", "a", "p", "v", "r_sum", "r_n")
    cells = crop_amounts(rollup.rollup_base(fact, keys=["mun", "category", "year"]))
    return cells.join(standin.geography(spark, folder).select("mun", "mic", "uf"), "mun")


@query
def livestock_levels(spark, folder):
    return livestock_amounts(rollup.rollup_levels(standin.livestock_rows(spark, folder)))


def _livestock_long(spark, folder):
    events = standin.table(spark, folder, "events")
    k = F.from_json("props", "k int")["k"]
    product = F.col("event_type").isin(*standin.PRODUCT_TYPES)
    variable = F.when(~product, "Efetivo_Cabecas").when(k % 2 == 0, "Quantidade").otherwise("Valor_mil_reais")
    return events.select(
        F.col("user_id").alias("mun"), standin.event_kind().alias("kind"), F.col("event_type").alias("category"),
        F.dayofmonth("ts").alias("year"), variable.alias("variable"), F.when(k >= 5, F.col("value")).alias("value"), "event_id",
    )


@query
def variables_pivot(spark, folder):
    long = _livestock_long(spark, folder)
    return rollup.pivot_variables(long, LIVESTOCK_KEYS, list(VARIABLE_NAMES.values()), order="event_id")


@query
def union_missing_columns(spark, folder):
    long = _livestock_long(spark, folder)
    herd = rollup.pivot_variables(long.where(F.col("kind") == "Rebanho"), LIVESTOCK_KEYS, ["Efetivo_Cabecas"], order="event_id")
    product = rollup.pivot_variables(long.where(F.col("kind") == "Producao"), LIVESTOCK_KEYS, ["Quantidade", "Valor_mil_reais"], order="event_id")
    return rollup.union_all([herd, product])


@query
def normalise_measures(spark, folder):
    wide = variables_pivot(spark, folder)
    return filters.normalise_measures(wide)


@query
def active_set_sum(spark, folder):
    fact, groups = standin.crop_fact(spark, folder, "uf", "category", "p"), groups_of(spark, folder)
    active = groups.where(F.col(fixed.COL) == 1).select("category")
    return scaled(rollup.sum_active(fact, active), {"value": standin.CROP_UNITS["p"]})


@query
def category_totals(spark, folder):
    return scaled(rollup.category_totals(standin.crop_fact(spark, folder, "category", "p")), {"value": standin.CROP_UNITS["p"]})


@query
def profile(spark, folder):
    # Two facts with one key each, so that both shrink before they are joined.
    return rollup.profile(standin.crop_fact(spark, folder, "mun", "uf", "year", "n"), standin.crop_fact(spark, folder, "category"), rows="n")


@query
def profile_levels(spark, folder):
    """Distinct municipalities, categories and years per state and year, per state, per year and in all: bitmaps made once and joined upwards."""
    fact = standin.crop_fact(spark, folder, "uf", "mun", "category", "year")
    sets = {"municipalities": F.col("mun"), "categories": F.substring_index("category", "#", -1).cast("int"), "years": F.col("year")}
    fine = rollup.distinct_bitmaps(fact, ["uf", "year"], sets)
    levels = {"state_year": ["uf", "year"], "state": ["uf"], "year": ["year"], "country": []}
    parts = [rollup.distinct_counts(fine, by, list(sets)).withColumn("level", F.lit(level)) for level, by in levels.items()]
    return rollup.union_all(parts)


@query
def micro_rejects(spark, folder):
    """Users with a micro-region, and apart from them the number of those without, per event type."""
    unknown = F.from_json("props", "k int")["k"] == 0
    events = standin.table(spark, folder, "events").select(
        F.when(unknown, -F.col("user_id")).otherwise(F.col("user_id")).alias("mun"), F.col("event_type").alias("category"))
    kept, rejects = lookups.attach_microregion(events.distinct(), standin.geography(spark, folder))
    known = kept.groupBy("category").agg(F.count_distinct("mic").alias("micro_regions"), F.count(F.lit(1)).alias("municipalities"))
    return known.join(quality.reject_count(rejects, ["category"]), "category", "full")


@query
def domain_years(spark, folder):
    years = rollup.distinct_domain(standin.crop_fact(spark, folder, "year"), "year")
    return years.agg(F.array_sort(F.collect_list("year")).alias("years")).select(F.posexplode("years").alias("position", "year"))


@query
def domain_categories_by_kind(spark, folder):
    rows = standin.livestock_rows(spark, folder, "kind", "category")
    return rows.select("kind", "category").where(F.col("category").isNotNull()).distinct().orderBy("kind", "category")


@query
def scope_maximum(spark, folder):
    values = rollup.rollup(standin.crop_fact(spark, folder, "uf", "mic", "year", "p"), ["uf", "mic", "year"], ["p"])
    return rollup.scope_max(value_of(values, "p"), by=["uf", "year"])


# -- dimensions ------------------------------------------------------------------------------------


@query
def state_dim(spark, folder):
    places = standin.geography(spark, folder)
    coded = places.withColumn("uf", unknown_where(F.col("mic_name") == "BUILDING", F.col("uf")))
    return dims.state_dim(coded, standin.state_names(spark, folder))


@query
def micro_dim_last_wins(spark, folder):
    orders = standin.table(spark, folder, "orders")
    places = standin.geography(spark, folder, region=True)
    seen = orders.join(places, orders.o_custkey == places.mun).select(
        "o_orderkey", F.col("mic_name").alias("mic"), F.col("uf").alias("mic_name"), F.col("region").alias("uf"),
        F.col("o_orderpriority").alias("meso_name"),
    )
    return dims.micro_dim(seen, order="o_orderkey")


@query
def mun_dim_first_wins(spark, folder):
    orders = standin.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("mun"), F.col("o_orderpriority").alias("mun_name"),
        F.col("o_orderstatus").alias("uf"), F.year("o_orderdate").cast("string").alias("mic"),
    )
    return dims.municipality_dim(orders, order="o_orderkey")


@query
def attach_names(spark, folder):
    totals = rollup.rollup(standin.crop_fact(spark, folder, "uf", "category", "p"), ["uf", "category"], ["p"])
    coded = totals.withColumn("uf", unknown_where(F.col("category") == "Brand#1", F.col("uf")))
    return crop_amounts(lookups.attach_names(coded, standin.state_names(spark, folder), "uf", "uf_name"))


@query
def region_lookup(spark, folder):
    totals = rollup.rollup(standin.crop_fact(spark, folder, "uf", "year", "p"), ["uf", "year"], ["p"])
    coded = totals.withColumn("uf", unknown_where(F.col("year") % 2 == 0, F.col("uf")))
    return crop_amounts(lookups.attach_region(coded, standin.state_names(spark, folder)))


@query
def locale_order(spark, folder):
    named = standin.geography(spark, folder).select("mic", "mic_name").distinct()
    return dims.locale_positions(named, "mic_name", "mic").select("position", "mic", "mic_name")


def _state_code():
    """Two digits of the state; one segment has a code that no state has."""
    return F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("99")).otherwise(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))


@query
def parent_code_lookup(spark, folder):
    customer = standin.table(spark, folder, "customer")
    coded = customer.select(
        F.concat(_state_code(), F.col("c_custkey").cast("string")).alias("mun"), "c_acctbal",
    )
    nation = standin.table(spark, folder, "nation")
    parents = nation.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("uf_code"), F.col("n_name").alias("uf"))
    located = lookups.derive_parent_code(coded, parents)
    return filters.drop_unmapped(located).groupBy("uf").agg(F.count(F.lit(1)).alias("municipalities"), F.max("mun").alias("last_code"))


@query
def state_check(spark, folder):
    customer = standin.table(spark, folder, "customer")
    coded = customer.select(
        F.concat(_state_code(), F.col("c_custkey").cast("string")).alias("mun"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NATION_0")).otherwise(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))).alias("uf_file"),
    )
    nation = standin.table(spark, folder, "nation")
    parents = nation.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("uf_code"), F.col("n_name").alias("uf"))
    return quality.state_check(lookups.derive_parent_code(coded, parents))


@query
def feature_state(spark, folder):
    customer = standin.table(spark, folder, "customer")
    features = customer.select(_state_code().alias("area_code"))
    nation = standin.table(spark, folder, "nation")
    parents = nation.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("uf_code"), F.col("n_name").alias("uf"))
    return lookups.feature_state(features, parents).groupBy("uf").agg(F.count(F.lit(1)).alias("features"))


@query
def unmapped_rejects(spark, folder):
    # Users of one group of events have a number that nobody has.
    unknown = F.from_json("props", "k int")["k"] == 0
    events = standin.table(spark, folder, "events").select(
        F.when(unknown, -F.col("user_id")).otherwise(F.col("user_id")).alias("mun"), F.col("event_type").alias("category"))
    counted = events.groupBy("mun", "category").agg(F.count(F.lit(1)).alias("rows"))
    return quality.mapping_report(counted, standin.geography(spark, folder).select("mun", "mic"), by=["category"])


@query
def unit_labels(spark, folder):
    rows = standin.livestock_rows(spark, folder, "kind", "category", "q")
    totals = livestock_amounts(rows.groupBy("kind", "category").agg(total(rows, "q"))).withColumnRenamed("q", "value")
    units = F.broadcast(spark.createDataFrame(UNITS, "category string, unit string"))  # 3 rows
    named = lookups.attach_unit(totals, units)
    herd, product = Selection("livestock", "q", kind="Rebanho"), Selection("livestock", "v", kind="Producao")
    label = F.when(F.col("kind") == "Rebanho", labels.metric_label(herd, F.col("category"), F.col("unit"))).otherwise(
        labels.metric_label(product, F.col("category"), F.col("unit"))
    )
    return named.select("category", "unit", "value", label.alias("label"))


# -- classification ----------------------------------------------------------------------------------


@query
def bootstrap_flags(spark, folder):
    categories = standin.table(spark, folder, "part").select(F.col("p_name").alias("category")).distinct()
    return classify.bootstrap_flag(categories, FLAG_TARGETS)


def _listed_names(spark, folder):
    """Names of parts, customers and suppliers, and targets that are too many for a list in code: part names in parentheses, supplier numbers."""
    columns = {"part": "p_name", "customer": "c_name", "supplier": "s_name"}
    parts, customers, suppliers = (standin.table(spark, folder, t).select(F.col(c).alias("category")) for t, c in columns.items())
    number = F.concat(F.lit(" ("), F.substring_index("category", "#", -1).substr(4, 6), F.lit(")"))
    targets = parts.select(F.upper(F.concat(F.lit("("), "category", F.lit(")"))).alias("target")).union(suppliers.select(number))
    return parts.union(customers).union(suppliers), targets


@query
def name_matches(spark, folder):
    return names.matched_names(*_listed_names(spark, folder))


@query
def first_name_matches(spark, folder):
    return names.first_matches(*_listed_names(spark, folder))


@query
def bootstrap_type(spark, folder):
    categories = standin.table(spark, folder, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("category")).distinct()
    return classify.bootstrap_type(categories, KIND_KEYWORDS)


def _with_new_categories(df: DataFrame) -> DataFrame:
    """High brand numbers renamed, as if the lookup were older than the fact."""
    number = F.substring_index("category", "#", -1).cast("int")
    return df.withColumn("category", F.when(number > 20, F.concat(F.lit("New "), "category")).otherwise(F.col("category")))


@query
def new_categories(spark, folder):
    return classify.new_categories(_with_new_categories(standin.crop_fact(spark, folder, "category")), groups_of(spark, folder))


@query
def attach_type_default(spark, folder):
    totals = rollup.category_totals(standin.crop_fact(spark, folder, "category", "a"), "a")
    return classify.attach_type(scaled(_with_new_categories(totals), {"value": 1}), groups_of(spark, folder))


@query
def classify_groups(spark, folder):
    totals = rollup.rollup(standin.crop_fact(spark, folder, "category", "year", "a"), ["category", "year"], ["a"])
    return crop_amounts(classify.classify_group(_with_new_categories(totals), groups_of(spark, folder)))


@query
def set_difference_tra(spark, folder):
    return classify.tractor_categories(standin.crop_fact(spark, folder, "category"), groups_of(spark, folder))


@query
def set_intersect_col(spark, folder):
    return classify.combine_categories(standin.crop_fact(spark, folder, "category"), groups_of(spark, folder))


@query
def group_profile(spark, folder):
    return quality.group_profile(standin.crop_fact(spark, folder, "mun", "category"), groups_of(spark, folder))


# -- cleaning ------------------------------------------------------------------------------------------


@query
def clean_numeric(spark, folder):
    line = standin.table(spark, folder, "lineitem")
    number = F.format_number(F.col("l_extendedprice"), 2)
    text = (
        F.when(F.col("l_linenumber") == 1, "-").when(F.col("l_linenumber") == 2, " ... ").when(F.col("l_linenumber") == 3, "X")
        .when(F.col("l_linenumber") == 4, "nd").when(F.col("l_linenumber") == 5, F.concat(F.lit(" "), number)).otherwise(number)
    )
    cleaned = line.select("l_linenumber", "l_returnflag", cleaning.clean_numeric(text).alias("value"))
    counted = cleaned.groupBy("l_linenumber", "l_returnflag").agg(
        F.count("value").alias("numbers"), F.count_if(F.col("value").isNull()).alias("missing"),
        F.sum(whole_units(F.col("value"))).cast("double").alias("total"),
    )
    return scaled(counted, {"total": 100})


@query
def decode_variable(spark, folder):
    events = standin.table(spark, folder, "events")
    code = cleaning.decode_variable(F.col("event_type"), VARIABLE_CODES)
    return events.select(cleaning.decode_variable(code, VARIABLE_NAMES).alias("variable")).groupBy("variable").agg(F.count(F.lit(1)).alias("n"))


@query
def exclude_total(spark, folder):
    events = standin.table(spark, folder, "events")
    renamed = events.select(F.when(F.col("event_type") == "error", "Total").otherwise(F.col("event_type")).alias("category"), whole_units(F.col("value")).alias("q"))
    kept = filters.exclude_categories(renamed, ["Total"])
    return livestock_amounts(kept.groupBy("category").agg(total(kept, "q"), F.count(F.lit(1)).alias("n")))


@query
def area_code_normalise(spark, folder):
    customer = standin.table(spark, folder, "customer")
    text = F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("0"), F.col("c_nationkey").cast("string"))).when(
        F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("n/a "), F.col("c_nationkey").cast("string"))
    ).otherwise(F.col("c_nationkey").cast("string"))
    return customer.select(cleaning.normalise_area_code(text).alias("area_code")).groupBy("area_code").agg(F.count(F.lit(1)).alias("n"))


@query
def sanitize_float(spark, folder):
    line = standin.table(spark, folder, "lineitem")
    raw = (
        F.when(F.col("l_discount") == 0, F.lit(float("inf"))).when(F.col("l_tax") == 0, F.lit(float("nan")))
        .when(F.col("l_linenumber") == 1, F.lit(float("-inf"))).otherwise(F.col("l_extendedprice"))
    )
    clean = line.select("l_returnflag", "l_linestatus", cleaning.sanitize_float(raw).alias("x"))
    counted = clean.groupBy("l_returnflag", "l_linestatus").agg(
        F.count_if(F.col("x") == 0).alias("zeros"), F.sum(whole_units(F.col("x"))).alias("total"),
    )
    return scaled(counted, {"total": 100})


@query
def round_published(spark, folder):
    cells = rollup.rollup_state_category(standin.crop_fact(spark, folder, "uf", "category", "year", "a", "p", "v", "r_sum", "r_n"), per_one=standin.CROP_UNITS).select("uf", "category", "year", *CROP, "r_mean")
    return files.round_measures(cells)


@query
def latest_period(spark, folder):
    events = standin.table(spark, folder, "events")
    day = F.dayofmonth("ts")
    text = F.when(day > 28, "...").when(F.col("event_type") == "error", "-").otherwise(F.col("value").cast("string"))
    return filters.latest_period(events.select(day.alias("year"), text.alias("value")))


@query
def json_decode(spark, folder):
    events = standin.table(spark, folder, "events")
    decoded = events.select(F.from_json("props", "k int")["k"].alias("k"), whole_units(F.col("value")).alias("x"))
    return scaled(decoded.groupBy("k").agg(F.count(F.lit(1)).alias("n"), total(decoded, "x").alias("total")), {"total": 100})


@query
def missing_slices(spark, folder):
    """The grid spans what occurs: all states, all event types, and the days from the first to the last."""
    events = standin.table(spark, folder, "events").select(F.dayofmonth("ts").alias("day"), "event_type")
    kinds = events.agg(F.collect_set("event_type")).scalar()
    days = events.agg(F.sequence(F.min("day"), F.max("day"))).scalar()
    rows = standin.livestock_rows(spark, folder, "uf", "category", "year")
    expected = (
        standin.state_names(spark, folder).select("uf", F.explode(kinds).alias("category"))
        .select("uf", "category", F.explode(days).alias("year"))
    )
    return quality.missing_slices(expected, rows, ["uf", "category", "year"])


@query
def scope_filter(spark, folder):
    groups = groups_of(spark, folder)
    selection = Selection(group=fixed.TRA, uf="NATION_3", year=1998)
    rows = filters.scope_filter(standin.crop_fact(spark, folder, "uf", "mun", "category", "year", "p"), selection)
    chosen = filters.active_categories(classify.classify_group(rows, groups), selection)
    return value_of(rollup.rollup(chosen, ["mun", "category"], ["p"]), "p")


# -- series ------------------------------------------------------------------------------------------------


def _state_group_rows(spark, folder, group):
    groups = groups_of(spark, folder)
    cells = rollup.rollup(standin.crop_fact(spark, folder, "uf", "category", "year", "p"), ["uf", "category", "year"], ["p"])
    return filters.active_categories(classify.classify_group(cells, groups), Selection(group=group))


@query
def dense_series_state(spark, folder):
    rows = _state_group_rows(spark, folder, fixed.TEM)
    return crop_amounts(series.yearly_totals(rows, ["p"], standin.years(spark, folder), keys=["uf"]))


@query
def dense_series_mun_category(spark, folder):
    cells = rollup.rollup(standin.crop_fact(spark, folder, "mun", "category", "year", "a", "p", "v"), ["mun", "category", "year"], CROP)
    return crop_amounts(series.densify(cells, ["mun", "category"], CROP, standin.years(spark, folder), rolled_up=True))


@query
def packed_series(spark, folder):
    fact = standin.crop_fact(spark, folder, "mun", "category", "year", "p")
    packed = series.pack_series(fact, ["mun", "category"], ["p"], standin.years(spark, folder))
    return crop_amounts(packed.select("mun", "category", F.posexplode("p").alias("year_index", "p")))


@query
def dense_quarters(spark, folder):
    """Quarters as periods: a list too long for one aggregate, summed in blocks."""
    fact = standin.crop_fact(spark, folder, "mic", "quarter", "a", "p", "v")
    return crop_amounts(series.densify(fact, ["mic"], CROP, standin.quarters(spark, folder), year="quarter"))


@query
def packed_quarters(spark, folder):
    fact = standin.crop_fact(spark, folder, "uf", "category", "quarter", "a", "p", "v")
    packed = series.pack_series(fact, ["uf", "category"], CROP, standin.quarters(spark, folder), year="quarter")
    return crop_amounts(packed.select("uf", "category", F.posexplode(F.arrays_zip(*CROP)).alias("period", "x")).select("uf", "category", "period", "x.*"))


@query
def value_at_year(spark, folder):
    years = standin.years(spark, folder)
    packed = series.pack_series(standin.crop_fact(spark, folder, "mun", "year", "p"), ["mun"], ["p"], years)
    wanted = {"first": 0, "last": len(years) - 1, "beyond": len(years)}
    values = packed.select("mun", *[cleaning.value_at(F.col("p"), i).alias(name) for name, i in wanted.items()])
    return scaled(values, dict.fromkeys(wanted, standin.CROP_UNITS["p"]))


@query
def series_micro(spark, folder):
    fact = standin.crop_fact(spark, folder, "mic", "year", "a", "p", "v")
    return crop_amounts(series.yearly_totals(fact, CROP, standin.years(spark, folder), keys=["mic"]))


@query
def series_national(spark, folder):
    return explorer(spark, folder, "uf", "year", "v", years=True).series(Selection(metric="v"))


@query
def series_municipality(spark, folder):
    return crop_amounts(series.yearly_totals(standin.crop_fact(spark, folder, "mun", "year", "p"), ["p"], standin.years(spark, folder), keys=["mun"]))


@query
def series_state_from_mun(spark, folder):
    fact, places = standin.crop_fact(spark, folder, "mun", "year", "p"), standin.geography(spark, folder)
    by_mun = rollup.rollup(fact, ["mun", "year"], ["p"])
    return crop_amounts(series.series_state_from_municipalities(by_mun, places, standin.years(spark, folder), ["p"]))


@query
def series_by_scope(spark, folder):
    view = explorer(spark, folder, "uf", "mic", "year", "p", years=True)
    scopes = [Selection(metric="p"), Selection(metric="p", uf="NATION_3"), Selection(metric="p", uf="NATION_3", mic="NATION_7-BUILDING")]
    parts = [view.series(sel).select(F.lit(sel.scope_level()).alias("scope"), "year", "value") for sel in scopes]
    return rollup.union_all(parts)


@query
def yield_series(spark, folder):
    return explorer(spark, folder, "year", "a", "p", years=True).series(Selection(metric="r"))


# -- rankings ----------------------------------------------------------------------------------------------


@query
def top_states(spark, folder):
    return explorer(spark, folder, "uf", "v").top_states(Selection(metric="v"))


@query
def top_categories(spark, folder):
    return explorer(spark, folder, "uf", "category", "year", "p").top_categories(Selection(metric="p"))


@query
def top_categories_in_state(spark, folder):
    cells = rollup.rollup(standin.crop_fact(spark, folder, "uf", "category", "p"), ["uf", "category"], ["p"])
    return crop_amounts(rank.top_k_per_scope(cells, ["uf"], 15, "p", "category"))


@query
def top_livestock_categories(spark, folder):
    return explorer(spark, folder, livestock=("kind", "category", "q")).top_categories(Selection("livestock", "q", kind="Producao"))


@query
def top_micros(spark, folder):
    return explorer(spark, folder, "mic", "a").top_micros(Selection(metric="a"))


@query
def top_micros_zeros(spark, folder):
    # Few livestock places exist, so some micro-regions rank with 0.
    sel = Selection("livestock", "v", category="click")
    return explorer(spark, folder, livestock=("mic", "category", "v")).top_micros(sel, 15, keep_zeros=True)


@query
def mun_ranking(spark, folder):
    by_mun = rollup.rollup(standin.crop_fact(spark, folder, "uf", "mun", "p"), ["uf", "mun"], ["p"])
    best = rank.top_k_per_scope(by_mun, ["uf"], 100, "p", "mun")
    places = standin.geography(spark, folder).select("mun", "mun_name", "mic_name")
    return crop_amounts(places.join(best, "mun"))


@query
def top_municipalities(spark, folder):
    return explorer(spark, folder, "mun", "p").top_municipalities(Selection(metric="p"))


@query
def top_k_per_scope(spark, folder):
    by_mic = rollup.rollup(standin.crop_fact(spark, folder, "uf", "mic", "year", "v"), ["uf", "mic", "year"], ["v"])
    return crop_amounts(rank.top_k_per_scope(by_mic, ["uf", "year"], 3, "v", "mic"))


@query
def rank_position(spark, folder):
    by_mun = rollup.rollup(standin.crop_fact(spark, folder, "uf", "mun", "p"), ["uf", "mun"], ["p"])
    return crop_amounts(rank.rank_position(by_mun, ["uf"], "p", "mun"))


# -- the published dashboard's own arithmetic ---------------------------------------------------------------------


@query
def compat_state_yields(spark, folder):
    """Rounded mean yields, added up over the categories of a group."""
    view = explorer(spark, folder, "uf", "category", "year", "r_sum", "r_n", groups=groups_of(spark, folder))
    return view.values(Selection(metric="r", group=fixed.TEM, compat=True), "uf", year=False)


@query
def compat_micro_values(spark, folder):
    """A category that is not combine-harvested reads as its whole group below state level."""
    view = explorer(spark, folder, "mic", "category", "year", "v", groups=groups_of(spark, folder))
    return view.values(Selection(metric="v", group=fixed.PER, category="Brand#7", compat=True), "mic", year=False)


@query
def compat_mun_values(spark, folder):
    view = explorer(spark, folder, "mun", "category", "year", "v", groups=groups_of(spark, folder))
    return view.values(Selection(metric="v", group=fixed.COL, category="Brand#8", compat=True), "mun", year=False)


@query
def compat_kpis(spark, folder):
    """Headline numbers over cells rounded first."""
    view = explorer(spark, folder, "uf", "category", "a", "p", "v")
    return view.kpis(Selection(compat=True))


# -- headline numbers, maps, labels, exports -------------------------------------------------------------------


@query
def kpi_crop(spark, folder):
    cells = rollup.rollup(standin.crop_fact(spark, folder, "uf", "category", "year", "a", "p", "v"), ["uf", "category", "year"], CROP)
    return crop_amounts(kpi.kpi_crop(cells, by=["year"]))


@query
def kpi_livestock(spark, folder):
    return livestock_amounts(kpi.kpi_livestock(standin.livestock_rows(spark, folder, "category", "mun", "q", "v"), by=["category"]))


@query
def scope_counts(spark, folder):
    places = standin.geography(spark, folder)
    values = value_of(rollup.rollup(standin.crop_fact(spark, folder, "uf", "mun", "p"), ["uf", "mun"], ["p"]), "p")
    return kpi.scope_counts(places.select("uf", "mic").distinct(), values)


@query
def choropleth_classes(spark, folder):
    values = rollup.rollup(standin.crop_fact(spark, folder, "uf", "mic", "year", "p"), ["uf", "mic", "year"], ["p"])
    return choropleth.colour_classes(value_of(values, "p"), ["uf", "year"], palette=fixed.PALETTE_REGION)


@query
def value_over_scope_max(spark, folder):
    values = rollup.rollup(standin.crop_fact(spark, folder, "uf", "p"), ["uf"], ["p"])
    return rank.value_over_scope_max(value_of(values, "p"))


@query
def legend_steps(spark, folder):
    values = rollup.rollup(standin.crop_fact(spark, folder, "uf", "year", "p"), ["uf", "year"], ["p"])
    # The log bounds come from exp and log, whose last digits differ between engines.
    return choropleth.legend(value_of(values, "p"), by=["year"]).withColumn("log_value", F.round("log_value", 2))


@query
def feature_values(spark, folder):
    features = standin.geography(spark, folder).select("mic", "uf").distinct()
    events = standin.livestock_rows(spark, folder, "mic", "q")
    values = livestock_amounts(rollup.rollup(events, ["mic"], ["q"])).withColumnRenamed("q", "value")
    return choropleth.attach_values_to_features(features, values, "mic")


@query
def features_in_scope(spark, folder):
    features = standin.geography(spark, folder).select("mic").distinct()
    active = standin.livestock_rows(spark, folder, "mic", "uf").distinct()
    return choropleth.features_in_scope(features, active, "mic")


@query
def fmt_magnitude(spark, folder):
    fact = standin.crop_fact(spark, folder, "uf", "category", "year", "a", "p", "v")
    cells = rollup.rollup(fact, ["uf", "category", "year"], CROP)
    country = rollup.rollup(cells, ["year"], CROP).withColumn("place", F.lit("country"))
    places = cells.select(F.concat_ws("/", "uf", "category").alias("place"), "year", *CROP)
    both = crop_amounts(places).unionByName(crop_amounts(country))
    texts = [labels.fmt_magnitude(F.col(c), c).alias(f"{c}_text") for c in CROP]
    return both.select("place", "year", *texts, labels.fmt_magnitude(F.col("a"), "r").alias("r_text"))


@query
def export_slice(spark, folder):
    return explorer(spark, folder, "uf", "category", "year", "p").export_rows(Selection(metric="p"))


@query
def export_nested_json(spark, folder):
    cells = rollup.rollup(standin.crop_fact(spark, folder, "uf", "category", "year", "a"), ["uf", "category", "year"], ["a"]).withColumnRenamed("a", "value")
    maps = exports.export_state_maps(cells.withColumn("value", F.col("value").cast("decimal(18,2)")), True, by=["uf", "year"])
    return maps.select("uf", "year", F.to_json("data").alias("data"))


@query
def nested_package(spark, folder):
    cells = rollup.rollup(standin.crop_fact(spark, folder, "uf", "category", "year", "a", "p"), ["uf", "category", "year"], ["a", "p"])
    exact = crop_amounts(cells).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("a", "p")})
    packed = series.pack_series(exact, ["uf", "category"], ["a", "p"], standin.years(spark, folder))
    return series.nest_package(packed, "uf", "category", ["a", "p"]).select("uf", F.to_json("package").alias("package"))


@query
def api_payload_rows(spark, folder):
    """Events as responses of the statistics service (a header and a row each), parsed and counted."""
    event = standin.table(spark, folder, "events").withColumn("k", F.from_json("props", "k int")["k"])
    labels_of = {"D1C": "Município (Código)", "D1N": "Município (Nome)", "D2C": "Variável (Código)", "D3N": "Ano (Nome)",
                 "D4C": "Tipo de rebanho (Código)", "D4N": "Tipo de rebanho (Nome)", "V": "Valor"}
    row = {
        "D1C": F.col("user_id").cast("string"), "D1N": F.lit("x"), "D2C": F.when(F.col("k") % 2 == 0, "105").otherwise("999"),
        "D3N": F.date_format("ts", "yyyy"), "D4C": F.col("k").cast("string"), "D4N": F.col("event_type"),
        "V": F.when(F.col("k") == 3, "...").otherwise(F.format_number("value", 2)),
    }
    as_map = lambda cells: F.create_map(*[x for key, cell in cells.items() for x in (F.lit(key), cell)])
    code = F.when(F.col("event_type") == "click", "35").when(F.col("event_type") == "view", "33").otherwise("99")
    responses = event.select(code.alias("uf_code"), F.to_json(F.array(as_map({k: F.lit(v) for k, v in labels_of.items()}), as_map(row))).alias("value"))
    rows = api.parse_stat_api(responses, 3939).withColumn("units", whole_units(F.col("value")))
    counted = rows.groupBy("uf", "region", "kind", "year", "category", "variable").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("numbers"), total(rows, "units").alias("total"))
    return scaled(counted, {"total": 100})


@query
def geo_feature_rows(spark, folder):
    """Customers as map features, one collection each, counted by the state their code names."""
    customer = standin.table(spark, folder, "customer")
    code = F.when(F.col("c_mktsegment") == "BUILDING", "0").otherwise("")
    text = F.concat(F.lit('{"features":[{"type":"Feature","properties":{"codarea":"'), code, (F.col("c_nationkey") + 11).cast("string"),
                    F.lit('"},"geometry":{"type":"Polygon","coordinates":[]}}]}'))
    parsed = customer.select(F.from_json(text, schemas.GEO_SCHEMA)["features"].alias("features"))
    return geo.features_of(parsed, "uf").groupBy("codarea", "uf", "geometry").agg(F.count(F.lit(1)).alias("n"))


@query
def category_flags_parse(spark, folder):
    """Brands as a lookup file's text columns, flags written in the ways that occur."""
    number = F.substring_index("p_brand", "#", -1).cast("int")
    flag = F.when(number % 4 == 0, "1").when(number % 4 == 1, "1.0").when(number % 4 == 2, "x")
    brands = standin.table(spark, folder, "part").select("p_brand").distinct()
    raw = brands.select(F.col("p_brand").alias("cultura"), F.when(number % 2 == 1, "PER").alias("tipo"), flag.alias("COL"), F.lit("0").alias("XYZ"))
    return sources.parse_category_groups(raw)


@query
def municipality_series(spark, folder):
    """The series of one municipality, and of one without data: its state's, added up."""
    view = explorer(spark, folder, "uf", "mun", "year", "p", years=True)
    one, none = Selection(metric="p", mun=7), Selection(metric="p", uf="NATION_3", mun=-1)
    return rollup.union_all([view.municipality_series(sel).select(F.lit(name).alias("asked"), "year", "value") for name, sel in (("one", one), ("none", none))])


@query
def crop_labels(spark, folder):
    """Display text and label of every crop metric, for the whole country."""
    rows = standin.crop_fact(spark, folder, "category", "a", "p", "v")
    totals = crop_amounts(rows.agg(*[total(rows, c) for c in CROP]))
    view = explorer(spark, folder, "category")
    parts = []
    for metric in CROP:
        sel = Selection(metric=metric, category="Brand#7")
        parts.append(view.labelled(totals.select(F.col(metric).alias("value")), sel).select(F.lit(metric).alias("metric"), "value", "text", "label"))
    return rollup.union_all(parts)


@query
def kpi_livestock_known(spark, folder):
    """Headline numbers in which only municipalities of a dimension count: those of one segment."""
    rows = standin.livestock_rows(spark, folder, "category", "mun", "q", "v")
    known = standin.geography(spark, folder).where(F.col("mic_name") == "BUILDING").select("mun")
    return livestock_amounts(kpi.kpi_livestock(rows, by=["category"], known=known))


@query
def export_document(spark, folder):
    """The complete export of a year as one document."""
    return explorer(spark, folder, "uf", "category", "year", "a").export_document(Selection(metric="a", year=1998))


# -- batches from file to file --------------------------------------------------------------------------------

BATCHES = ("crop_package", "rejected_crop_cells", "ingested_slices", "landed_slice_rows", "refreshed_crop", "refreshed_livestock", "livestock_package", "geo_files",
           "clustered_scope", "bucketed_places")


@query
def crop_package(spark, folder):
    """The published crop package of the line items, some cells of which are no usable numbers."""
    return roundtrips.crop_package(spark, folder)


@query
def rejected_crop_cells(spark, folder):
    """What the crop batch keeps out of its sums."""
    return roundtrips.rejected_crop_cells(spark, folder)


@query
def ingested_slices(spark, folder):
    """Incremental loads of landed slices, with late and corrected files."""
    return roundtrips.ingested_slices(spark, folder)


@query
def landed_slice_rows(spark, folder):
    """Delimited slices written and read, rows that do not fit among them."""
    return roundtrips.landed_slice_rows(spark, folder)


@query
def refreshed_crop(spark, folder):
    """Crop roll-ups kept up to date load by load."""
    return roundtrips.refreshed_crop(spark, folder)


@query
def refreshed_livestock(spark, folder):
    """Livestock levels kept up to date with the slices that land."""
    return roundtrips.refreshed_livestock(spark, folder)


@query
def livestock_package(spark, folder):
    """The published livestock package, from landed slices and a localities file."""
    return roundtrips.livestock_package(spark, folder)


@query
def geo_files(spark, folder):
    """Feature collections read from disk and features written."""
    return roundtrips.geo_files(spark, folder)


@query
def clustered_scope(spark, folder):
    """A scope's sums from the base table ordered by state and category."""
    return roundtrips.clustered_scope(spark, folder)


@query
def bucketed_places(spark, folder):
    """Sums per municipality from tables that share their buckets."""
    return roundtrips.bucketed_places(spark, folder)
