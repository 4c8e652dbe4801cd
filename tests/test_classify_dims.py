from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.operators import classify, dims, lookups, quality

GROUPS = "category string, kind string, COL int"


def test_shipped_lookup(spark):
    groups = lookups.default_category_groups(spark)
    counts = {(r.kind, r.COL): r["count"] for r in groups.groupBy("kind", "COL").count().collect()}
    assert counts == {("PER", 0): 33, ("TEM", 0): 20, ("TEM", 1): 14}


def test_unknown_and_null_types_default_to_temporary(spark, rows):
    groups = spark.createDataFrame([("Uva", "PER", 0), ("Soja", "TEM", 1), ("Nova", None, 0), ("Café", "PER", 1), ("Odd", "XXX", 0)], GROUPS)
    fact = spark.createDataFrame([(c,) for c in ("Uva", "Soja", "Nova", "Café", "Odd", "Kiwi")], "category string")
    got = {r.category: (r.kind, r.grp) for r in classify.classify_group(fact, groups).collect()}
    assert got == {
        "Uva": ("PER", "PER"), "Soja": ("TEM", "COL"), "Nova": ("TEM", "TRA"), "Café": ("PER", "COL"),
        "Odd": ("XXX", "PER"), "Kiwi": ("TEM", "TRA"),
    }


def test_bootstrap_equals_a_plain_restatement(spark):
    names = sorted(fixed.PERMANENT_CROPS + fixed.TEMPORARY_CROPS)
    df = spark.createDataFrame([(n,) for n in names], "category string")

    def plain(text):
        return text.lower().replace("(", "").replace(")", "").strip()

    flagged = set()
    for target in fixed.COMBINE_CROPS:
        hits = [n for n in names if plain(target) in plain(n) or plain(n) in plain(target)]
        flagged |= set(hits[:1])
    expected = {
        n: ("PER" if any(k.lower() in n.lower() for k in fixed.PERMANENT_KEYWORDS) else "TEM", int(n in flagged)) for n in names
    }
    assert {r.category: (r.kind, r.COL) for r in classify.bootstrap_groups(df).collect()} == expected


def test_first_match_wins_per_target(spark, rows):
    df = spark.createDataFrame([("Feijão B",), ("Feijão A",), ("Fei",), ("Uva",)], "category string")
    assert rows(classify.bootstrap_flag(df, ["Feijão", "Trigo"])) == [("Feijão", "Fei")]


def test_set_operations(spark, rows):
    groups = spark.createDataFrame([("Uva", "PER", 0), ("Soja", "TEM", 1), ("Milho", "TEM", 1), ("Alho", "TEM", 0)], GROUPS).withColumn("XYZ", F.lit(1))
    fact = spark.createDataFrame([(c,) for c in ("Soja", "Alho", "Uva", "Kiwi", "Kiwi", None)], "category string")
    assert rows(classify.new_categories(fact, groups)) == [("Kiwi", "TEM", 0, 0)]
    assert classify.extend_groups(fact, groups).count() == 5
    assert rows(classify.combine_categories(fact, groups)) == [("Soja",)]
    assert rows(classify.tractor_categories(fact, groups)) == [("Alho",), ("Kiwi",)]
    assert rows(classify.categories_of_kind(fact, groups, "PER")) == [("Uva",)]
    assert classify.flag_columns(groups) == ["COL", "XYZ"]


def test_micro_dim_takes_the_last_first_appearance(spark, rows):
    data = [(1, "m", "A", "SP", "x"), (2, "m", "B", "SP", "x"), (3, "m", "A", "SP", "x"), (4, "k", "C", "RJ", None), (5, None, "D", "RJ", "y")]
    fact = spark.createDataFrame(data, "n int, mic string, mic_name string, uf string, meso_name string")
    assert rows(dims.micro_dim(fact, order="n")) == [("k", "C", "RJ", None), ("m", "B", "SP", "x")]


def test_municipality_dim_takes_the_first(spark, rows):
    data = [(2, "1", "Older", "SP", "m"), (1, "1", "First", "SP", "m"), (1, "2", "Z", "SP", None), (1, "2", "B", "SP", None)]
    fact = spark.createDataFrame(data, "year int, mun string, mun_name string, uf string, mic string")
    assert rows(dims.municipality_dim(fact)) == [("1", "First", "SP", "m"), ("2", "B", "SP", None)]


def test_state_dim_and_regions(spark, rows):
    fact = spark.createDataFrame([("SP",), ("SP",), ("ZZ",), (None,)], "uf string")
    assert rows(dims.state_dim(fact, lookups.states(spark))) == [("SP", "São Paulo", "SE"), ("ZZ", "ZZ", "")]
    long_names = lookups.states(spark).select("uf", F.col("region_name").alias("region"))
    assert rows(lookups.attach_region(fact.dropna(), long_names).distinct()) == [("SP", "Sudeste"), ("ZZ", "??")]


def test_parent_code_and_state_check(spark, rows):
    fact = spark.createDataFrame([("3550308", "SP"), ("3304557", "SP"), ("9912345", "SP"), (None, "SP")], "mun string, uf_file string")
    located = lookups.derive_parent_code(fact, lookups.states(spark))
    assert {r.mun: r.uf for r in located.collect()} == {"3550308": "SP", "3304557": "RJ", "9912345": None, None: None}
    assert rows(quality.state_check(located)) == [(4, 2, 1)]


def test_names_units_and_rejects(spark, rows):
    dim = spark.createDataFrame([("1", "Um")], "mic string, mic_name string")
    fact = spark.createDataFrame([("1",), ("2",)], "mic string")
    assert rows(lookups.attach_names(fact, dim, "mic", "mic_name")) == [("1", "Um"), ("2", "2")]
    assert rows(lookups.attach_names(fact, dim, "mic", "mic_name", F.lit(""))) == [("1", "Um"), ("2", "")]
    cats = spark.createDataFrame([("Leite",), ("Total",)], "category string")
    assert rows(lookups.attach_unit(cats, lookups.category_units(spark))) == [("Leite", "mil L"), ("Total", "")]
    muns = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "mun string, x int")
    mapping = spark.createDataFrame([("a", "m1"), ("c", None)], "mun string, mic string")
    kept, rejects = lookups.attach_microregion(muns, mapping)
    assert rows(kept) == [("a", 1, "m1")] and rows(rejects) == [("b", 2), ("c", 3)]
    assert quality.reject_count(rejects).first()[0] == 2


def test_locale_order(spark):
    names = ["Zulmira", "Água", "Abaeté", "Ângulo", "Acre", "água"]
    df = spark.createDataFrame([(n, str(i)) for i, n in enumerate(names)], "n string, k string")
    ordered = [r.n for r in dims.locale_sorted(df, "n", "k").collect()]
    assert ordered.index("Abaeté") < ordered.index("Acre") < ordered.index("Água") < ordered.index("Ângulo") < ordered.index("Zulmira")
