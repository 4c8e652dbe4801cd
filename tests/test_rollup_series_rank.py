import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from municipia.operators import choropleth, dims, filters, kpi, quality, rank, rollup, series

GROUPS = "category string, kind string, COL int"
FACT = "uf string, mic string, mun string, category string, year int, a double, p double, v double, r double"


@pytest.fixture(scope="module")
def groups(spark):
    data = [("Soja", "TEM", 1), ("Alho", "TEM", 0), ("Uva", "PER", 0), ("Café", "PER", 1)]
    return spark.createDataFrame(data, GROUPS)


@pytest.fixture(scope="module")
def fact_rows():
    draw = random.Random(11)
    out = []
    for _ in range(600):
        mun = draw.randint(1, 12)
        mic = None if mun == 12 else f"m{mun // 3}"
        amounts = [None if draw.random() < 0.1 else float(draw.randint(0, 900)) for _ in range(4)]
        year = draw.choice([2004, 2005, 2007])
        out.append((f"U{mun % 2}", mic, str(mun), draw.choice(["Soja", "Alho", "Uva", "Café", "Kiwi"]), year, *amounts))
    return out


@pytest.fixture(scope="module")
def fact(spark, fact_rows):
    return rollup.with_yield_parts(spark.createDataFrame(fact_rows, FACT)).cache()


def test_state_rollup_sums_and_means(spark, fact, fact_rows):
    cells = defaultdict(lambda: [[], [], [], []])
    for uf, _, _, category, year, *amounts in fact_rows:
        for bucket, x in zip(cells[uf, category, year], amounts):
            bucket.append(x)
    got = {(r.uf, r.category, r.year): r for r in rollup.rollup_state_category(fact).collect()}
    assert set(got) == set(cells)
    for key, (a, p, v, r) in cells.items():
        row, real = got[key], [x for x in r if x is not None]
        assert [row.a or 0, row.p or 0, row.v or 0] == [sum(x or 0 for x in m) for m in (a, p, v)]
        assert row.r_mean == (pytest.approx(sum(real) / len(real)) if real else None)


def test_rollup_of_a_rollup_is_the_same(fact, rows):
    direct = rollup.rollup_state_category(fact)
    twice = rollup.rollup_state_category(rollup.rollup_base(fact))
    assert rows(direct) == rows(twice)


def test_null_keys_and_null_sums(spark, rows):
    df = spark.createDataFrame([("x", 1, None), ("x", 1, None), (None, 1, 5.0), ("y", None, 5.0)], "k string, year int, a double")
    assert rows(rollup.rollup(df, ["k", "year"], ["a"])) == [("x", 1, None)]


def totals(df, key):
    return {(r[key], r.grp, r.year): tuple(x or 0 for x in (r.a, r.p, r.v)) for r in df.collect()}


def test_membership_identities_and_wide_form(fact, groups):
    by_mic = totals(rollup.rollup_membership(fact, groups, "mic"), "mic")
    assert None not in {k[0] for k in by_mic}
    keys = {(k, y) for k, g, y in by_mic if g == "ALL"}
    zero = (0, 0, 0)
    for k, y in keys:
        get = lambda g: by_mic.get((k, g, y), zero)
        assert get("ALL") == tuple(map(sum, zip(get("TEM"), get("PER"))))
        # The flagged permanent crop counts in COL and PER, so TEM is TRA and the flagged temporary one.
        assert get("TEM") == tuple(map(sum, zip(get("TRA"), get("Soja"))))
        assert get("COL") == tuple(map(sum, zip(get("Soja"), get("Café"))))
    assert not {g for _, g, _ in by_mic} & {"Alho", "Uva", "Kiwi"}
    long = rollup.rollup_membership(fact, groups, "mun", crops_as_groups=False).where(F.col("grp") != "ALL")
    assert totals(rollup.rollup_membership_wide(fact, groups, "mun"), "mun") == totals(long, "mun")


def test_levels_tell_null_keys_from_aggregated_ones(spark, rows):
    data = [("U", "m", "1", "c", 2004, 1.0, None), ("U", None, "2", "c", 2004, 2.0, 5.0), (None, "m", "1", "c", 2004, 4.0, 1.0)]
    df = spark.createDataFrame(data, "uf string, mic string, mun string, category string, year int, q double, v double")
    assert rows(rollup.rollup_levels(df)) == [
        ("mic", "m", "c", 2004, 5.0, 1.0), ("mun", "1", "c", 2004, 5.0, 1.0), ("mun", "2", "c", 2004, 2.0, 5.0),
        ("uf", "U", "c", 2004, 3.0, 5.0),
    ]


def test_pivot_first_non_null_and_dropped_rows(spark, rows):
    data = [
        ("1", "Quantidade", None, 1), ("1", "Quantidade", 7.0, 2), ("1", "Quantidade", 3.0, 3), ("1", "Valor_mil_reais", 1.0, 4),
        ("2", "Quantidade", None, 5), ("2", "Valor_mil_reais", None, 6), (None, "Quantidade", 1.0, 7),
    ]
    df = spark.createDataFrame(data, "mun string, variable string, value double, n int")
    wide = rollup.pivot_variables(df, ["mun"], ["Efetivo_Cabecas", "Quantidade", "Valor_mil_reais"], order="n")
    assert rows(wide) == [("1", None, 7.0, 1.0)]
    assert wide.columns == ["mun", "Efetivo_Cabecas", "Quantidade", "Valor_mil_reais"]


def test_normalise_measures_with_absent_columns(spark, rows):
    wide = spark.createDataFrame([("a", 1.0, None, None), ("b", None, 2.0, 3.0)], "k string, Efetivo_Cabecas double, Quantidade double, Valor_mil_reais double")
    assert rows(filters.normalise_measures(wide)) == [("a", 1.0, 0.0), ("b", 2.0, 3.0)]
    assert rows(filters.normalise_measures(wide.drop("Valor_mil_reais", "Quantidade"))) == [("a", 1.0, 0.0), ("b", None, 0.0)]
    assert rows(filters.normalise_measures(wide.select("k"))) == [("a", None, 0.0), ("b", None, 0.0)]


def test_small_filters(spark, rows):
    df = spark.createDataFrame([("Total",), ("Leite",), (None,)], "category string")
    assert rows(filters.exclude_categories(df, ["Total"])) == [("Leite",), (None,)]
    assert filters.resolve_column(df, ["x", "category"], "y") == "category" and filters.resolve_column(df, ["x"], "y") == "y"
    periods = spark.createDataFrame([(2024, "..."), (2023, " - "), (2022, "5"), (2021, "")], "year int, value string")
    assert filters.latest_period(periods).first().year == 2022
    assert filters.latest_period(periods.where("year > 2022")).first().year == 2023
    assert rollup.union_all([df.limit(0), spark.createDataFrame([(1,)], "x int")]).columns == ["category", "x"]


def test_profile_and_scope_max(fact, fact_rows):
    got = rollup.profile(fact, fact).first()
    assert (got.row_count, got.municipalities, got.categories, got.states, got.first_year, got.last_year) == (
        len(fact_rows), 12, 5, 2, 2004, 2007)
    assert rollup.scope_max(fact.where("a < 0"), "a").first().scope_max == 1.0


def test_densify_and_pack_agree(spark, rows):
    df = spark.createDataFrame([("x", 2004, 1.0, None), ("x", 2007, 0.0, 2.0), ("y", 2005, 3.0, 3.0)], "k string, year int, a double, p double")
    years = [2004, 2005, 2006, 2007]
    long = series.densify(df, ["k"], ["a", "p"], years)
    assert rows(long.where("k = 'x'")) == [
        ("x", 2004, 1.0, 0.0, True), ("x", 2005, 0.0, 0.0, False), ("x", 2006, 0.0, 0.0, False), ("x", 2007, 0.0, 2.0, True)]
    packed = {r.k: (r.a, r.p) for r in series.pack_series(df, ["k"], ["a", "p"], years).collect()}
    assert packed == {"x": ([1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 2.0]), "y": ([0.0, 3.0, 0.0, 0.0], [0.0, 3.0, 0.0, 0.0])}
    twice = series.pack_series(df.unionByName(df), ["k"], ["a"], years)
    assert {r.k: r.a for r in twice.collect()} == {"x": [2.0, 0.0, 0.0, 0.0], "y": [0.0, 6.0, 0.0, 0.0]}
    assert series.known_years(df) == [2004, 2005, 2007]
    empty = series.densify(df.where("k = 'none'"), [], ["a"], years)
    assert rows(empty) == [(y, 0.0, False) for y in years]


def test_state_series_from_municipalities_equals_direct(spark, fact, rows):
    years = [2004, 2005, 2006, 2007]
    mun_dim = fact.select("mun", "uf").distinct()
    direct = series.yearly_totals(fact, ["p"], years, keys=["uf"])
    by_mun = rollup.rollup(fact, ["mun", "year"], ["p"])
    assert rows(series.series_state_from_municipalities(by_mun, mun_dim, years, ["p"])) == rows(direct)


def test_nested_package(spark):
    df = spark.createDataFrame([("U", "b", 2004, 1.0), ("U", "a", 2005, 2.0)], "uf string, category string, year int, a double")
    nested = series.nest_package(series.pack_series(df, ["uf", "category"], ["a"], [2004, 2005]), "uf", "category", ["a"])
    assert nested.select(F.to_json("package").alias("j")).first().j == '{"a":{"a":[0.0,2.0]},"b":{"a":[1.0,0.0]}}'


def ranked(data, scope_of):
    by_scope = defaultdict(list)
    for row in data:
        by_scope[scope_of(row)].append(row)
    return {row[1]: i for group in by_scope.values() for i, row in enumerate(sorted(group, key=lambda r: (-r[2], r[1])), 1)}


@pytest.mark.parametrize(("per_range", "sample", "one_in"), [(65_536, 4_096, 16), (100, 4_096, 16), (2, 4_096, 1), (10, 5, 2), (7, 500, 3)])
def test_rank_position_with_a_large_scope_and_ties(spark, per_range, sample, one_in):
    draw = random.Random(2)
    data = [("hot" if i % 3 else f"s{i % 30}", i, float(draw.choice([0, 1, 1, 2, draw.randint(0, 50)]))) for i in range(900)]
    df = spark.createDataFrame(data, "scope string, key int, value double").repartition(5)
    got = {r.key: r.position for r in rank.rank_position(df, ["scope"], per_range=per_range, sample=sample, one_in=one_in).collect()}
    assert got == ranked(data, lambda r: r[0])
    gaps = df.withColumn("value", F.when(F.col("key") % 7 != 0, F.col("value")))
    spots = {r.key: (r.scope, r.position) for r in rank.rank_position(gaps, ["scope"], per_range=per_range, sample=sample, one_in=one_in).collect()}
    absent = [(scope, spots[key][1]) for scope, key, _ in data if key % 7 == 0]
    sizes = Counter(scope for scope, _, _ in data)
    assert len(set(spots.values())) == 900 and sorted(absent) == sorted((s, sizes[s] - i) for s, n in Counter(a[0] for a in absent).items() for i in range(n))


def test_rank_ranges_follow_the_rows_of_a_scope(spark):
    """One scope of equal values and 200,000 rows falls into even ranges; a small one is not cut."""
    df = spark.range(200_000).selectExpr("'one' AS scope", "id AS key", "0.0D AS value").unionByName(spark.range(9).selectExpr("'two' AS scope", "id AS key", "1.0D AS value"))
    cuts = {r.scope: r._cuts for r in rank._cut_points(df, ["scope"], "value", "key", 4_000, 4_096, 16).collect()}
    places = [-1, *(c.k for c in cuts["one"]), 199_999]
    widths = [b - a for a, b in zip(places, places[1:])]
    assert list(cuts) == ["one"] and len(widths) == 50 and max(widths) < 3 * 4_000
    ranked_rows = rank.rank_position(df, ["scope"], per_range=4_000)
    assert ranked_rows.where("position <> key + 1").count() == 0 and ranked_rows.count() == 200_009


def test_top_k_variants(spark, rows):
    data = [("u", "b", 5.0), ("u", "a", 5.0), ("u", "c", 0.0), ("w", "d", 9.0)]
    df = spark.createDataFrame(data, "uf string, key string, value double")
    assert [r.key for r in rank.top_k(df, 3).collect()] == ["d", "a", "b"]
    assert [r.key for r in rank.top_k(df, 4, keep_zeros=True).collect()] == ["d", "a", "b", "c"]
    assert [(r.key, r.position) for r in rank.ranked_top_k(df, 2).orderBy("position").collect()] == [("d", 1), ("a", 2)]
    assert rows(rank.top_k_per_scope(df, ["uf"], 1)) == [("u", "a", 5.0, 1), ("w", "d", 9.0, 1)]


def test_value_over_scope_max(spark, rows):
    df = spark.createDataFrame([("u", 5.0), ("u", 2.0), ("w", 0.5)], "uf string, value double")
    assert rows(rank.value_over_scope_max(df, ["uf"])) == [("u", 2.0, 5.0), ("u", 5.0, 5.0), ("w", 0.5, 1.0)]
    assert {r.scope_max for r in rank.value_over_scope_max(df).collect()} == {5.0}


def test_colours_and_features(spark, rows):
    values = spark.createDataFrame([("a", 100.0), ("b", 3.0)], "mic string, value double")
    features = spark.createDataFrame([("a",), ("b",), ("c",)], "mic string")
    coloured = choropleth.colour_classes(choropleth.attach_values_to_features(features, values, "mic"))
    got = {r.mic: (r.value, r.class_index, r.colour) for r in coloured.collect()}
    assert got == {"a": (100.0, 6, "#800026"), "b": (3.0, 1, "#fed976"), "c": (0.0, 0, "#ffffb2")}
    dim = spark.createDataFrame([("a", "SP"), ("b", "RJ")], "mic string, uf string")
    assert rows(choropleth.features_in_scope(features, dim, "mic", "RJ")) == [("b",)]
    steps = choropleth.legend(values).orderBy("step").collect()
    assert [s.colour for s in steps][:2] == ["#ffffb2", "#fed976"] and steps[-1].linear_value == 100.0


def test_kpis(spark, rows):
    cells = spark.createDataFrame([("u", "x", 1.0, None, 0.0), ("w", "x", 2.0, 1.0, 1.0), ("w", "y", 0.0, 0.0, None)],
                                  "uf string, category string, a double, p double, v double")
    assert rows(kpi.kpi_crop(cells)) == [(3.0, 1.0, 1.0, 2, 1)]
    herd = spark.createDataFrame([("1", 2.0, 0.0), ("1", 1.0, 5.0), ("2", 0.0, 1.0), (None, 1.0, 1.0)], "mun string, q double, v double")
    assert rows(kpi.kpi_livestock(herd)) == [(4.0, 7.0, 1)]
    assert rows(kpi.kpi_livestock(herd.limit(0))) == [(0.0, 0.0, 0)]


def test_scope_counts_and_group_profile(spark, groups, rows):
    micros = spark.createDataFrame([("a", "u"), ("b", "u"), ("c", "w")], "mic string, uf string")
    muns = spark.createDataFrame([("1", "u", 1.0), ("2", "u", 0.0)], "mun string, uf string, value double")
    assert rows(kpi.scope_counts(micros, muns)) == [("u", 2, 1), ("w", 1, 0)]
    pairs = spark.createDataFrame([("1", "Soja"), ("1", "Alho"), ("2", "Café"), ("2", None), ("3", "Kiwi")], "mun string, category string")
    assert rows(quality.group_profile(pairs, groups)) == [("COL", 2), ("PER", 1), ("TEM", 2), ("TRA", 2)]


def test_missing_slices(spark):
    expected = quality.expected_slices(spark)
    assert expected.count() == 2 * 21 * 27
    landed = spark.createDataFrame([(74, 2004, "SP"), (74, 2004, "SP"), (1, 2004, "SP")], "survey_table int, year int, uf string")
    assert quality.missing_slices(expected, landed).count() == 2 * 21 * 27 - 1


@pytest.mark.parametrize("years", [list(range(2004, 2025)), [1990, 1999, *range(2004, 2040)], list(range(1500, 2040, 3)), [2004, 2150, 3000]], ids=["21", "38", "180 of 540", "far apart"])
def test_many_years_in_blocks(spark, years):
    """Series over more years than one aggregate holds, against a restatement: gaps, keys with other years only, null keys, sums of nothing."""
    draw = random.Random(3)
    data = [(draw.choice(["x", "y", None]), draw.choice([*years, 1234]), *(draw.choice([None, draw.randint(0, 99)]) for _ in range(3))) for _ in range(300)]
    data += [("outside", 1234, 1, 1, 1), ("late", years[-1], 7, None, 0), ("none", None, 1, 1, 1)]
    df = spark.createDataFrame(data, "k string, year int, a long, p long, v long").withColumn("v", F.col("v").cast("double")).repartition(3)
    want = {}
    for k, y, *cells in data:
        if y is not None:
            row = want.setdefault(k, {m: [0] * len(years) for m in "apvn"})
            if y in years:
                for m, x in zip("apvn", [*cells, 1], strict=True):
                    row[m][years.index(y)] += x or 0
    packed = {r.k: r for r in series.pack_series(df, ["k"], ["a", "p", "v"], years).collect()}
    assert set(packed) == set(want)
    assert all([float(x) for x in packed[k][m]] == want[k][m] for k in want for m in "apv")
    long = series.densify(df, ["k"], ["a", "p", "v"], years).collect()
    assert len(long) == len(want) * len(years)
    got = {(r.k, r.year): (float(r.a), float(r.p), float(r.v), r.is_observed) for r in long}
    assert got == {(k, y): (*(float(w[m][i]) for m in "apv"), w["n"][i] > 0) for k, w in want.items() for i, y in enumerate(years)}
    whole = series.densify(df, [], ["a", "p", "v"], years).orderBy("year").collect()
    assert [r.a for r in whole] == [sum(w["a"][i] for w in want.values()) for i in range(len(years))]
    empty = series.densify(df.limit(0), [], ["a", "p", "v"], years).collect()
    assert sorted(r.year for r in empty) == years and not any(r.is_observed or r.a or r.v for r in empty)
    assert series.pack_series(df.limit(0), ["k"], ["a", "p", "v"], years).count() == 0


def test_bitmaps_count_distinct_numbers_at_every_level(spark, rows):
    draw = random.Random(4)
    data = [(draw.choice("uw"), draw.choice([1, 2]), draw.choice([None, draw.randint(-5, 200_000)]), draw.randint(0, 3)) for _ in range(500)]
    df = spark.createDataFrame(data, "uf string, year int, mun long, kind int").repartition(4)
    fine = rollup.distinct_bitmaps(df, ["uf", "year"], {"muns": F.col("mun"), "kinds": F.col("kind")})
    for by in (["uf", "year"], ["uf"], []):
        want = df.groupBy(*by).agg(F.count_distinct("mun").alias("muns"), F.count_distinct("kind").alias("kinds"))
        assert rows(rollup.distinct_counts(fine, by, ["muns", "kinds"])) == rows(want)


@pytest.mark.parametrize("per_range", [65_536, 5])
def test_locale_positions(spark, per_range):
    names = ["Água", "Abacate", "agua", "Zebra", "Álamo", "Avião", "ção", "Cão", "É", "e", None, "Zebra"] + [f"N{i % 7}" for i in range(60)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "k int, n string").repartition(3)
    want = [r.k for r in dims.locale_sorted(df.where("n IS NOT NULL"), "n", "k").collect()] + [10]
    got = {r.position: r.k for r in dims.locale_positions(df, "n", "k", per_range=per_range).collect()}
    assert [got[i] for i in range(len(names))] == want


def test_densify_of_a_roll_up_fills_gaps_without_summing(spark, rows):
    """The same rows as from sums: years missing at either end and between, keys with years outside the list alone, null keys and amounts."""
    years = [2001, 2002, 2004, 2007]
    data = [("x", 2002, 1, None), ("x", 2004, None, 5), ("y", 2001, 2, 2), ("y", 2007, 3, 3), ("z", 1990, 9, 9), ("z", 1991, 9, 9), ("w", 1990, 1, 1), ("w", 2007, 1, 1),
            (None, 2004, 7, 7), ("n", None, 8, 8), *(("full", y, y, -y) for y in years)]
    df = spark.createDataFrame(data, "k string, year int, a bigint, p bigint")
    filled = series.densify(df, ["k"], ["a", "p"], years, rolled_up=True)
    summed = series.densify(df, ["k"], ["a", "p"], years)
    assert filled.columns == summed.columns and rows(filled) == [tuple(int(v) if not isinstance(v, (str, bool, type(None))) else v for v in r) for r in rows(summed)]
    text = filled._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text and "Aggregate" not in text
