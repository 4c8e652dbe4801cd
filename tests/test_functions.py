import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from municipia import fixed_values as fixed
from municipia.functions import classes, cleaning, labels, units
from municipia.params import Selection


def values_of(spark, inputs, kind, expression):
    numbered = list(enumerate(inputs))
    df = spark.createDataFrame(numbered, f"i int, x {kind}")
    return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_numeric(spark):
    inputs = ["-", "..", "...", "X", "", "nd", "1,234.5", " 12 ", "\t7\n", "abc", None, "1d", "2.F", "1e3", "-5", "x", "ND"]
    expected = [None] * 6 + [1234.5, 12.0, 7.0, None, None, None, None, 1000.0, -5.0, None, None]
    assert values_of(spark, inputs, "string", cleaning.clean_numeric) == expected


def test_area_code(spark):
    inputs = ["011", "11", "7", "abc", "", None, "1234567", "00035001"]
    assert values_of(spark, inputs, "string", cleaning.normalise_area_code) == ["11", "11", "07", "abc", "", None, "1234567", "35001"]
    narrow = values_of(spark, ["011", "007", "x"], "string", lambda c: cleaning.normalise_area_code(c, 1))
    assert narrow == ["11", "7", "x"]


def test_decode_variable_passes_unknown_codes(spark):
    mapping = fixed.SURVEY_TABLES[74]["variables"]
    decoded = values_of(spark, ["106", "215", "999", None], "string", lambda c: cleaning.decode_variable(c, mapping))
    assert decoded == ["Quantidade", "Valor_mil_reais", "999", None]


def test_sanitize_float(spark):
    inputs = [float("nan"), float("inf"), float("-inf"), 1.5, None, 0.0]
    assert values_of(spark, inputs, "double", cleaning.sanitize_float) == [0.0, 0.0, 0.0, 1.5, None, 0.0]


def test_round_half_even_equals_python(spark):
    random.seed(5)
    inputs = [0.35, 1234567.05, 0.25, 0.05, 2.675, 1.005, -0.25, -1234.55, 1e15 + 0.5, 0.0]
    inputs += [random.uniform(0, 1e7) for _ in range(2000)] + [random.randint(0, 10**7) / 20 for _ in range(2000)]
    for digits in (0, 1, 2):
        got = values_of(spark, inputs, "double", lambda c: cleaning.round_half_even(c, digits))
        assert got == [round(x, digits) for x in inputs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=1, max_size=200))
def test_round_half_even_property(spark, inputs):
    assert values_of(spark, inputs, "double", lambda c: cleaning.round_half_even(c, 1)) == [round(x, 1) for x in inputs]


def test_plain_name_and_containment(spark):
    assert values_of(spark, ["Milho (em Grão) ", "(X)"], "string", cleaning.plain_name) == ["milho em grão", "x"]


def test_value_at(spark):
    series = [[1.0, 2.0], [], None]
    assert values_of(spark, series, "array<double>", lambda c: cleaning.value_at(c, 1)) == [2.0, 0.0, 0.0]


def log_class_by_hand(v, top, n=7):
    if not v or not top:
        return 0
    return min(math.floor(min(math.log1p(v) / math.log1p(top), 1) * (n - 1)), n - 1)


def test_log_class(spark):
    inputs = [0.0, 1e-9, 1.0, 10.0, 99.0, 100.0, 101.0, None]
    got = values_of(spark, inputs, "double", lambda c: classes.log_class(c, F.lit(100.0)))
    assert got == [log_class_by_hand(v, 100.0) for v in inputs]
    assert [c for v, c in zip(inputs, got) if c == 6] == [6, 6]  # only from the maximum on
    assert values_of(spark, [5.0], "double", lambda c: classes.log_class(c, F.lit(0.0))) == [0]


def test_legends(spark):
    linear, log = (values_of(spark, [600.0], "double", f)[0] for f in (classes.legend_linear, classes.legend_log))
    assert linear == [0, 100, 200, 300, 400, 500, 600]
    assert log[0] == 0 and abs(log[-1] - 600) < 1e-9
    # A value just above a log bound falls into that class.
    just_above = values_of(spark, [x * 1.000001 for x in log[1:6]], "double", lambda c: classes.log_class(c, F.lit(600.0)))
    assert just_above == [1, 2, 3, 4, 5]


def test_fmt_magnitude(spark):
    inputs = [None, 0.0, float("nan"), 12.34, 999.96, 1000.0, 1250.0, 12345.0, 1.5e6, 3.456e9, 1e12]
    expected = ["—", "—", "—", "12,3", "1.000", "1 mil", "1,3 mil", "12,3 mil", "1,5 Mi", "3,46 Gi", "1.000 Gi"]
    assert values_of(spark, inputs, "double", lambda c: labels.fmt_magnitude(c, "p")) == expected
    assert values_of(spark, [1234.56, 0.0], "double", lambda c: labels.fmt_magnitude(c, "r")) == ["1.234,6 kg/ha", "—"]


def test_metric_label(spark):
    def label(sel, unit=None):
        column = labels.metric_label(sel, None if sel.domain == "crop" else F.lit(sel.category), F.lit(unit))
        return spark.range(1).select(column.alias("x")).first().x

    assert label(Selection(metric="a")) == "Área Colhida (ha)"
    assert label(Selection("livestock", "q", category="Bovino"), "cab.") == "Bovino — Efetivo (cab.)"
    assert label(Selection("livestock", "q", kind="Producao", category="Leite"), "mil L") == "Leite — Quantidade (mil L)"
    assert label(Selection("livestock", "q", kind="Producao", category="Leite")) == "Leite — Quantidade"
    assert label(Selection("livestock", "v", kind="Producao", category="Leite"), "mil L") == "Leite — Valor (mil R$)"
    assert label(Selection("livestock", "q")) == "Selecione uma categoria"


def test_whole_units_do_not_depend_on_order(spark):
    amounts = [round(random.Random(3).uniform(0, 1e5) + i / 100, 2) for i in range(5000)]
    exact = sum(round(x * 100) for x in amounts) / 100
    for parts in (1, 3, 7):
        df = spark.createDataFrame([(x,) for x in amounts], "x double").repartition(parts)
        total = units.scaled(df.agg(F.sum(units.whole_units(F.col("x"))).alias("x")), {"x": 100}).first().x
        assert total == exact


def test_selection_scope_and_checks():
    assert Selection().scope_level() == "country"
    assert Selection(uf="SP").scope_level() == "uf"
    assert Selection(uf="SP", mic="35001").scope_level() == "mic"
    assert Selection(group="TEM", category="Soja").micro_group_key(["Soja"]) == "Soja"
    assert Selection(group="TEM", category="Alho").micro_group_key(["Soja"]) == "TEM"
    for bad in ({"metric": "q"}, {"domain": "livestock", "metric": "p"}, {"domain": "x"}):
        try:
            Selection(**bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_totals_beyond_53_and_63_bits_are_exact_in_any_order(spark):
    values = [2**62, 2**62, 2**62, 3, -5, 2**53 + 1, None, -(2**61) - 7]
    want = sum(v for v in values if v is not None)
    for rows in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in rows], "x bigint").repartition(3)
        once = df.agg(units.total(df, "x"))
        assert int(once.first().x) == want
        twice = once.unionByName(once)
        assert int(twice.agg(units.total(twice, "x")).first().x) == 2 * want
    empty = spark.createDataFrame([], "x bigint")
    assert empty.agg(units.total(empty, "x")).first().x is None
    assert units.scaled(once, {"x": 100}).first().x == pytest.approx(want / 100)
