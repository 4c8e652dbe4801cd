"""Landed JSON of the statistics service."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia import schemas
from municipia.functions.cleaning import clean_numeric, decode_variable
from municipia.operators.lookups import attach, attach_region, states

# Texts that mark a header label, and the column used where none matches.
HEADER_WORDS = {
    "mun": (["Munic", "digo"], "D1C"),
    "mun_name": (["Munic", "Nome"], "D1N"),
    "variable": (["Vari", "digo"], "D2C"),
    "year": (["Ano", "Nome"], "D3N"),
    "category_code": (["digo"], "D4C"),
    "category": (["Nome"], "D4N"),
}
CATEGORY_WORDS = ["rebanho", "produto"]


def _header_key(header: Column, target: str) -> Column:
    """Key of the first header label that holds the target's words, else the usual key."""
    words, usual = HEADER_WORDS[target]

    def matches(_, label: Column) -> Column:
        found = F.lit(True)
        for word in words:
            found = found & label.contains(word)
        if target.startswith("category"):
            about = F.lit(False)
            for word in CATEGORY_WORDS:
                about = about | F.lower(label).contains(word)
            found = found & about
        return F.coalesce(found, F.lit(False))

    return F.coalesce(F.try_element_at(F.map_keys(F.map_filter(header, matches)), F.lit(1)), F.lit(usual))


def read_stat_api_json(spark: SparkSession, folder: str, table: int) -> DataFrame:
    """Landed payloads ``ppm_<table>_<year>_<state code>*.json`` as long rows.

    Each file is one response of the service, which limits a response's size, so a file is read whole:
    its first element is the header that names the columns of all others.
    """
    files = (
        spark.read.option("wholetext", True).option("pathGlobFilter", f"ppm_{table}_*.json").text(folder)
        .select("value", F.regexp_extract("_metadata.file_name", r"^ppm_\d+_\d{4}_(\d{2})", 1).alias("uf_code"))
    )
    return parse_stat_api(files, table)


def parse_stat_api(responses: DataFrame, table: int) -> DataFrame:
    """Responses (``uf_code``, ``value`` as JSON text) of one survey table as long rows."""
    spark, config = responses.sparkSession, fixed.SURVEY_TABLES[table]
    parsed = responses.select("uf_code", F.from_json("value", schemas.API_PAYLOAD).alias("_payload"))
    header = F.try_element_at("_payload", F.lit(1))
    keyed = parsed.select(
        "uf_code", "_payload", *[_header_key(header, target).alias(f"_k_{target}") for target in HEADER_WORDS],
    )
    rows = keyed.select(
        "uf_code", *[f"_k_{target}" for target in HEADER_WORDS], F.posexplode("_payload").alias("_position", "_row"),
    ).where(F.col("_position") > 0)

    def field(key: Column) -> Column:
        return F.coalesce(F.try_element_at("_row", key), F.lit(""))

    values = {target: field(F.col(f"_k_{target}")) for target in HEADER_WORDS}
    long = rows.select(
        "uf_code",
        values["mun"].alias("mun"), values["mun_name"].alias("mun_name"),
        values["year"].try_cast("int").alias("year"),
        F.lit(config["kind"]).alias("kind"),
        values["category_code"].alias("category_code"), values["category"].alias("category"),
        decode_variable(values["variable"], config["variables"]).alias("variable"),
        clean_numeric(field(F.lit("V"))).alias("value"),
    )
    known = F.broadcast(states(spark))  # 27 rows
    located = attach(long, known, "uf_code", ["uf"])
    regions = known.select("uf", F.col("region_name").alias("region"))
    return attach_region(located, regions).select(*[name for name, _ in schemas.LIVESTOCK_LONG.values()])


def read_localities(spark: SparkSession, path: str) -> DataFrame:
    """Municipality to micro-region; entries without a micro-region are left out."""
    raw = spark.read.schema(schemas.LOCALITY_SCHEMA).option("multiLine", True).json(path)
    mapping = raw.select(F.col("id").cast("string").alias("mun"), F.col("microrregiao.id").cast("string").alias("mic"))
    return mapping.dropna()
