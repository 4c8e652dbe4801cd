"""The batches from file to file on the stand-in tables: landed files are written, read, built, published and read again.

Every run works in a folder of its own under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions.units import scaled, total, whole_units
from municipia.operators.choropleth import attach_values_to_features
from municipia.plans import crop, livestock, refresh, standin
from municipia.session import run_folder
from municipia.sinks.clustered import bucket_number, read_clustered, write_bucketed, write_clustered
from municipia.sinks.files import save_category_groups, write_csv, write_geo_features
from municipia.sinks.slices import land_slices, slice_lines
from municipia.sinks.tables import materialise
from municipia.sources.api import read_localities
from municipia.sources.files import read_category_groups, read_crop_fact, read_livestock_fact, read_raw_slices, rejected_slice_rows, slice_identity
from municipia.sources.geo import read_geo_features
from municipia.streaming.ingest import ingest_new_slices

SERIES = "array<double>"
CROP_SECTIONS = {
    "est_data": f"key string, value map<string,struct<a:{SERIES},p:{SERIES},v:{SERIES},r:{SERIES}>>",
    "mic_data": f"key string, value map<string,struct<a:{SERIES},p:{SERIES},v:{SERIES}>>",
    "mun_data": f"key string, value struct<a:{SERIES},p:{SERIES},v:{SERIES}>",
    "mun_grp_data": f"key struct<grp:string,mun:string>, value struct<a:{SERIES},p:{SERIES},v:{SERIES}>",
}
CROP_LISTS = ("culturas", "colheitadeiras", "tratores", "permanentes", "temporarias", "anos")


def state_codes(spark: SparkSession) -> DataFrame:
    """A survey state for every nation."""
    return spark.createDataFrame([(n, s[0], s[1]) for n, s in enumerate(fixed.STATES)], "n_nationkey int, uf_code string, uf string")


def crop_file_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items under the crop file's headings, as text. Some customers' cells are no usable numbers."""
    line, part, orders = (standin.table(spark, folder, t) for t in ("lineitem", "part", "orders"))
    places = standin.table(spark, folder, "customer").join(state_codes(spark), F.col("c_nationkey") == F.col("n_nationkey"))
    # Orders find their places first: they are fewer than their lines, which are dealt anew twice instead of three times.
    placed = orders.join(places, F.col("o_custkey") == F.col("c_custkey"))
    rows = line.join(part, line.l_partkey == part.p_partkey).join(placed, line.l_orderkey == placed.o_orderkey)
    customer, text = F.col("c_custkey"), lambda c: F.col(c).cast("string")
    mun = F.concat("uf_code", customer.cast("string"))
    return rows.select(
        mun.alias("Cod_Municipio"), F.col("c_name").alias(fixed.MUNICIPALITY_NAME_COLUMNS[0]), F.col("uf").alias("UF"),
        F.concat("uf", F.lit("-"), "c_mktsegment").alias("Cod_Microrregiao"), F.col("c_mktsegment").alias("Microrregiao"),
        F.col("uf").alias("Cod_Mesorregiao"), F.col("uf").alias("Mesorregiao"), F.year("o_orderdate").cast("string").alias("Ano"), F.col("p_brand").alias("Cultura"),
        F.when(customer % 97 == 5, "Infinity").otherwise(text("l_quantity")).alias("Area_Colhida_ha"),
        F.when(customer % 89 == 7, "1e300").otherwise(text("l_extendedprice")).alias("Quantidade_Produzida_ton"),
        F.when(customer % 13 == 2, "NaN").otherwise(text("l_extendedprice")).alias("Valor_Producao_mil_reais"), text("p_retailprice").alias("Rendimento_Medio_kg_ha"),
    )


def crop_batch(spark: SparkSession, folder: str) -> tuple[crop.CropTables, str]:
    """The crop batch from landed files, and the folder of this run."""
    work = run_folder(spark, "crop")
    write_csv(crop_file_rows(spark, folder), f"{work}/landed", compression="gzip")
    save_category_groups(standin.category_groups(spark, folder), f"{work}/groups")
    return crop.crop_tables(read_crop_fact(spark, f"{work}/landed"), read_category_groups(spark, f"{work}/groups"), f"{work}/tables"), work


def crop_package(spark: SparkSession, folder: str) -> DataFrame:
    """Every value and list entry of the published crop package: (section, key, member, year_index, a, p, v, r, entry)."""
    tables, work = crop_batch(spark, folder)
    crop.write_crop_package(tables, f"{work}/package")

    def rows(section: str) -> DataFrame:
        read = spark.read.schema(CROP_SECTIONS[section]).json(f"{work}/package/{section}")
        if section in ("est_data", "mic_data"):
            read = read.select("key", F.explode("value").alias("member", "value"))
        elif section == "mun_grp_data":
            read = read.select(F.col("key.mun").alias("key"), F.col("key.grp").alias("member"), "value")
        else:
            read = read.withColumn("member", F.lit(None).cast("string"))
        yields = F.col("value.r") if section == "est_data" else F.transform("value.a", lambda _: F.lit(None).cast("double"))
        zipped = read.select("key", "member", F.posexplode(F.arrays_zip(*[F.col(f"value.{m}").alias(m) for m in "apv"], yields.alias("r"))).alias("year_index", "x"))
        return zipped.select(F.lit(section).alias("section"), "key", "member", "year_index", "x.*", F.lit(None).cast("string").alias("entry"))

    none = F.lit(None).cast("double")
    out = [rows(section) for section in CROP_SECTIONS]
    for section in CROP_LISTS:
        read = spark.read.schema("key int, value string").json(f"{work}/package/{section}")
        out.append(read.select(
            F.lit(section).alias("section"), F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("member"), F.col("key").alias("year_index"),
            *[none.alias(m) for m in "apvr"], F.col("value").alias("entry")))
    first, *rest = out
    for frame in rest:
        first = first.unionByName(frame)
    return first.withColumnRenamed("year_index", "position")


def rejected_crop_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The cells that the crop batch keeps out of its sums, counted as its quality report does."""
    tables, _ = crop_batch(spark, folder)
    named = tables.rejected_cells.groupBy("measure", "problem", "value").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("mun").alias("municipalities"))
    reported = tables.quality.where(F.col("name").startswith("cell ")).select(F.col("name").alias("value"), "rows")
    return named.unionByName(reported, allowMissingColumns=True)


def slice_rows(spark: SparkSession, folder: str, value: Column | None = None) -> DataFrame:
    """Events as raw slice rows: herds in one survey table, products in the other, a day of the month as a year of this century."""
    events = standin.table(spark, folder, "events")
    places = standin.table(spark, folder, "customer").join(state_codes(spark), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "uf")
    herd, product = fixed.SURVEY_TABLES
    is_product = F.col("event_type").isin(*standin.PRODUCT_TYPES)
    year = F.dayofmonth("ts") + 2000
    cells = {
        "Cod_Municipio": F.col("user_id").cast("string"), "Municipio": F.lit("M"), "UF": F.col("uf"), "Regiao": F.lit("R"), "Ano": year.cast("string"),
        "Tipo": standin.event_kind(), "Cod_Categoria": F.lit("1"), "Categoria": F.col("event_type"),
        "Variavel": F.when(~is_product, "Efetivo_Cabecas").when(F.col("event_id") % 2 == 0, "Quantidade").otherwise("Valor_mil_reais"), "Valor": (F.col("value") if value is None else value).cast("decimal(18,2)").cast("string"),
    }
    located = events.join(places, F.col("user_id") == F.col("c_custkey"))
    return located.select(F.when(is_product, product).otherwise(herd).alias("survey_table"), year.alias("slice_year"), "event_id", *[c.alias(n) for n, c in cells.items()])


def _totals(rows: DataFrame, by: list[str]) -> DataFrame:
    counted = rows.withColumn("units", whole_units(F.col("value")))
    sums = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), total(counted, "units").alias("total"))
    return scaled(sums, {"total": 100})


def ingested_slices(spark: SparkSession, folder: str) -> DataFrame:
    """What the table holds after three loads: first slices up to day 20; then the rest, corrections of days 5 to 9 (one more each) and an old copy
    of days 12 to 14, dated back; then nothing new."""
    work = run_folder(spark, "slices")
    table, load = f"{work}/table", lambda: ingest_new_slices(spark, f"{work}/landed", f"{work}/table", f"{work}/progress")
    day = F.col("slice_year") - 2000
    rows, more = slice_rows(spark, folder), slice_rows(spark, folder, F.col("value") + 1)
    land_slices(slice_lines(rows.where(day <= 20)), f"{work}/landed")
    load()
    land_slices(slice_lines(rows.where(day > 20)), f"{work}/landed")
    land_slices(slice_lines(more.where(day.between(5, 9))), f"{work}/landed", suffix="v2")
    land_slices(slice_lines(more.where(day.between(12, 14))), f"{work}/landed", suffix="v0", age_seconds=86_400)
    load()
    load()
    return _totals(spark.read.parquet(table), ["survey_table", "slice_year", "uf", "category", "variable"])


def landed_slice_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of delimited slices that the reader takes and those it sets aside: every ninth event has a field too few, every eleventh one too many."""
    work = run_folder(spark, "raw")
    rows = slice_rows(spark, folder)
    names = [c for c in rows.columns if c not in ("survey_table", "slice_year", "event_id")]
    full = F.concat_ws(";", *names)
    short = F.concat_ws(";", *names[:-1])
    line = F.when(F.col("event_id") % 9 == 0, short).when(F.col("event_id") % 11 == 0, F.concat(full, F.lit(";more"))).otherwise(full)
    land_slices(slice_lines(rows, line), f"{work}/landed")
    parts = []
    for number in fixed.SURVEY_TABLES:
        kept = _totals(read_raw_slices(spark, f"{work}/landed", number), ["year", "uf", "category"]).withColumn("state", F.lit("kept"))
        bad = rejected_slice_rows(spark, f"{work}/landed", number).select(*slice_identity("file"), (F.size(F.split("row", ";")) - F.lit(len(names))).alias("state"))
        counted = bad.groupBy(F.col("slice_year").alias("year"), F.when(F.col("state") < 0, "too few").otherwise("too many").alias("state")).agg(F.count(F.lit(1)).alias("rows"))
        parts += [f.withColumn("survey_table", F.lit(number)) for f in (kept, counted)]
    first, *rest = parts
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def refreshed_crop(spark: SparkSession, folder: str) -> DataFrame:
    """The crop roll-ups after three loads: the years up to 1996; the later ones, with one state's 1995 corrected (areas plus one); and one whose 1996 is withdrawn."""
    work, groups = run_folder(spark, "refresh"), standin.category_groups(spark, folder)
    write_csv(crop_file_rows(spark, folder), f"{work}/landed", compression="lz4")
    # One pass over the delimited file; every load reads the years it wants of the result.
    fact = materialise(read_crop_fact(spark, f"{work}/landed"), f"{work}/fact")
    corrected = (F.col("year") == 1995) & (F.col("uf_file") == fixed.STATES[3][1])
    withdrawn = (F.col("year") == 1996) & (F.col("uf_file") == fixed.STATES[5][1])
    refresh.refresh_crop(fact.where("year <= 1996"), groups, f"{work}/tables")
    refresh.refresh_crop(fact.where((F.col("year") > 1996) | corrected).withColumn("a", F.when(corrected, F.col("a") + 1).otherwise(F.col("a"))), groups, f"{work}/tables")
    # Rows without a category do not count: the slice is there, and empty.
    refresh.refresh_crop(fact.where(withdrawn).withColumn("category", F.lit(None).cast("string")), groups, f"{work}/tables")
    parts = [refresh.read_slices(spark, f"{work}/tables/{name}").select(
        F.lit(name).alias("rollup"), F.col(key).alias("key"), (F.col(member) if member else F.lit(None).cast("string")).alias("member"), "year", "a", "p", "v",
        (F.col("r_mean") if name == "state_category" else F.lit(None).cast("double")).alias("r_mean"))
        for name, key, member in (("state_category", "uf", "category"), ("micro_groups", "mic", "grp"), ("municipality", "mun", None), ("municipality_groups", "mun", "grp"))]
    first, *rest = parts
    for frame in rest:
        first = first.unionByName(frame)
    return first.withColumns({m: F.nullif(m, F.lit(float("inf"))) for m in ("a", "p", "v")})


def refreshed_livestock(spark: SparkSession, folder: str) -> DataFrame:
    """The livestock levels after loads of landed slices, each followed by a refresh: days up to 20, then the rest with corrections of days 5 to 9."""
    work = run_folder(spark, "levels")
    day = F.col("slice_year") - 2000
    rows, more = slice_rows(spark, folder), slice_rows(spark, folder, F.col("value") + 1)
    mapping = standin.geography(spark, folder).select(F.col("mun").cast("string").alias("mun"), "mic")

    def load() -> None:
        ingest_new_slices(spark, f"{work}/landed", f"{work}/table", f"{work}/progress", touched_path=f"{work}/touched")
        refresh.refresh_from_slices(spark, f"{work}/table", f"{work}/touched", mapping, f"{work}/tables")

    land_slices(slice_lines(rows.where(day <= 20)), f"{work}/landed")
    load()
    land_slices(slice_lines(rows.where(day > 20)), f"{work}/landed")
    land_slices(slice_lines(more.where(day.between(5, 9))), f"{work}/landed", suffix="v2")
    load()
    return refresh.read_slices(spark, f"{work}/tables/levels")


PER_FILE = 1_000  # objects of one JSON document


def write_localities(spark: SparkSession, folder: str, path: str) -> None:
    """Customers as the service lists localities: documents of at most PER_FILE municipalities, every fiftieth without a micro-region."""
    micro = F.struct((F.col("c_nationkey") * 100 + F.ascii("c_mktsegment")).alias("id"))
    rows = standin.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 50 != 0, micro).alias("microrregiao"), F.expr(f"c_custkey div {PER_FILE}").alias("document"))
    listed = rows.groupBy("document").agg(F.to_json(F.collect_list(F.struct("id", "microrregiao"))).alias("value"))
    listed.write.partitionBy("document").text(path)


def livestock_package(spark: SparkSession, folder: str) -> DataFrame:
    """Every value and list entry of the published livestock package: slices are landed, made wide, written as the consolidated file, read again and built,
    with the micro-regions of a localities file. (section, key, member, position, q, v, entry)"""
    work = run_folder(spark, "livestock")
    land_slices(slice_lines(slice_rows(spark, folder)), f"{work}/landed")
    livestock.export_consolidated(spark, f"{work}/landed", f"{work}/consolidated")
    write_localities(spark, folder, f"{work}/localities")
    wide, mapping = read_livestock_fact(spark, f"{work}/consolidated/completo"), read_localities(spark, f"{work}/localities")
    livestock.write_livestock_package(livestock.livestock_tables(wide, mapping, f"{work}/tables"), f"{work}/package")
    parts = []
    for section in ("est_data", "mic_data", "mun_data"):
        read = spark.read.schema(f"key string, value map<string,struct<q:{SERIES},v:{SERIES}>>").json(f"{work}/package/{section}")
        cells = read.select("key", F.explode("value").alias("member", "value")).select("key", "member", F.posexplode(F.arrays_zip(F.col("value.q").alias("q"), F.col("value.v").alias("v"))).alias("position", "x"))
        parts.append(cells.select(F.lit(section).alias("section"), "key", "member", "position", "x.q", "x.v", F.lit(None).cast("string").alias("entry")))
    for section in ("rebanho_categorias", "producao_categorias", "anos"):
        read = spark.read.schema("key int, value string").json(f"{work}/package/{section}")
        none = F.lit(None)
        parts.append(read.select(
            F.lit(section).alias("section"), none.cast("string").alias("key"), none.cast("string").alias("member"), F.col("key").alias("position"),
            none.cast("double").alias("q"), none.cast("double").alias("v"), F.col("value").alias("entry")))
    first, *rest = parts
    for frame in rest:
        first = first.unionByName(frame)
    return first


def geo_files(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as polygons in feature collections on disk, read, joined to their state's value and written as features, one a line; what these lines hold."""
    work = run_folder(spark, "geo")
    code = F.when(F.col("c_mktsegment") == "BUILDING", "0").otherwise("")
    state = F.element_at(F.array(*[F.lit(s[0]) for s in fixed.STATES]), F.col("c_nationkey") + 1)
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"codarea":"'), code, state, F.lit('"},"geometry":{"type":"Polygon","coordinates":[[['), F.col("c_custkey").cast("string"),
        F.lit(",0]]]}}"))
    customer = standin.table(spark, folder, "customer")
    listed = customer.groupBy(F.expr(f"c_custkey div {PER_FILE}").alias("document")).agg(F.array_join(F.collect_list(feature), ",").alias("f"))
    listed.select("document", F.concat(F.lit('{"type":"FeatureCollection","features":['), "f", F.lit("]}")).alias("value")).write.partitionBy("document").text(f"{work}/landed")
    values = customer.join(state_codes(spark), F.col("c_nationkey") == F.col("n_nationkey")).where(F.col("c_nationkey") % 5 != 0).groupBy("uf").agg(F.count(F.lit(1)).cast("double").alias("value"))
    valued = attach_values_to_features(read_geo_features(spark, f"{work}/landed"), values, "uf")
    write_geo_features(valued, f"{work}/features", "value")
    back = spark.read.schema("type string, properties struct<codarea:string,value:double>, geometry struct<type:string,coordinates:array<array<array<long>>>>").json(f"{work}/features")
    return back.groupBy("type", F.col("properties.codarea").alias("codarea"), F.col("properties.value").alias("value"), F.col("geometry.type").alias("shape")).agg(
        F.count(F.lit(1)).alias("features"), F.sum(F.col("geometry.coordinates")[0][0][0]).alias("corner"))


BASE_COLUMNS = ("uf", "mic", "mun", "category", "year", "a", "p", "v")
BASE_SCHEMA = "uf string, mic string, mun long, category string, a long, p long, v long, year int"


def clustered_scope(spark: SparkSession, folder: str) -> DataFrame:
    """A state's and a category's rows of the clustered base table, summed by year; the scan skips row groups of other scopes."""
    path = f"{run_folder(spark, 'clustered')}/base"
    write_clustered(standin.crop_fact(spark, folder, *BASE_COLUMNS), path)
    base = read_clustered(spark, path, BASE_SCHEMA)
    chosen = base.where((F.col("uf") == "NATION_3") & F.col("category").between("Brand#2", "Brand#4"))
    sums = [total(chosen, m) for m in ("a", "p", "v")]
    return scaled(chosen.groupBy("uf", "category", "year").agg(*sums, F.count_distinct("mun").alias("municipalities")), standin.CROP_UNITS)


def bucketed_places(spark: SparkSession, folder: str) -> DataFrame:
    """Every municipality with its name and sums, from a base and a dimension that share their buckets: neither join nor roll-up shuffles."""
    work = run_folder(spark, "bucketed")
    base = standin.crop_fact(spark, folder, "mun", "category", "year", "a", "p")
    buckets = bucket_number(standin.table(spark, folder, "lineitem").count())
    facts = write_bucketed(base, f"{work}/base", ["mun"], buckets)
    places = write_bucketed(standin.geography(spark, folder), f"{work}/places", ["mun"], buckets)
    rolled = facts.groupBy("mun").agg(total(facts, "a"), total(facts, "p"), F.count_distinct("category").alias("categories"))
    joined = scaled(places.join(rolled, "mun", "left"), standin.CROP_UNITS)
    return joined.select("mun", "mun_name", "mic", "uf", "a", "p", F.coalesce("categories", F.lit(0)).alias("categories"))
