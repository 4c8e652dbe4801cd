"""Both batch builds and the interactive questions, against a plain-Python restatement of their rules."""

import json
import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from municipia.functions.labels import EM_DASH
from municipia.params import Selection
from municipia.plans import crop, livestock
from municipia.plans.explorer import Explorer
from municipia.sources.files import read_category_groups

KINDS = {"Soja": ("TEM", 1), "Milho": ("TEM", 1), "Alho": ("TEM", 0), "Uva": ("PER", 0), "Café": ("PER", 0)}
CROPS = [*KINDS, "Kiwi"]  # Kiwi is not in the lookup
YEARS = [2019, 2020, 2022]
CODES = {"35": "SP", "33": "RJ", "11": "RO"}
FACT = ("mun string, uf_file string, mic string, mic_name string, meso string, meso_name string, year int, category string, "
        "a double, p double, v double, r double, mun_name string")


def crop_rows():
    draw = random.Random(7)
    out = []
    for prefix in CODES:
        for n in range(6):
            mun, mic = f"{prefix}{n:05d}", f"{prefix}00{n // 2}"
            for year in YEARS:
                for category in CROPS:
                    if draw.random() < 0.35:
                        continue
                    # Eighths add up exactly in any order, and still meet every rounding rule.
                    cell = [None if draw.random() < 0.1 else draw.randint(0, 8000) / 8 for _ in range(4)]
                    out.append((mun, "??", mic, f"Mic {mic}", "m", f"Meso {prefix}", year, category, *cell, f"Mun {mun}"))
    out.append(("9900001", "??", "x", "x", "m", "x", 2020, "Soja", 1.0, 1.0, 1.0, 1.0, "Nowhere"))
    out.append(("3500001", "SP", "35000", "Mic 35000", "m", "Meso 35", 2020, None, 1.0, 1.0, 1.0, 1.0, "No crop"))
    return out


def groups_of(category):
    kind, combine = KINDS.get(category, ("TEM", 0))
    named = {"ALL", kind, "COL" if combine else "TRA" if kind == "TEM" else "PER"}
    return named | ({category} if combine else set())


class Model:
    """Sums and means by hand."""

    def __init__(self, data):
        self.rows = [r for r in data if r[0][:2] in CODES and r[7] is not None]

    def select(self, level, key, year, group=None, category=None):
        place = {"uf": lambda r: CODES[r[0][:2]], "mic": lambda r: r[2], "mun": lambda r: r[0]}[level]
        return [r for r in self.rows if place(r) == key and r[6] == year and (group is None or group in groups_of(r[7])) and category in (None, r[7])]

    @staticmethod
    def total(rows, metric):
        return sum(r["apv".index(metric) + 8] or 0 for r in rows)

    def cell(self, uf, category, year, metric):
        rows = self.select("uf", uf, year, category=category)
        if metric != "r":
            return round(self.total(rows, metric), 1)
        real = [r[11] for r in rows if r[11] is not None]
        return round(sum(real) / len(real), 2) if real else 0

    def keys(self, level):
        return sorted({{"uf": CODES[r[0][:2]], "mic": r[2], "mun": r[0]}[level] for r in self.rows})


@pytest.fixture(scope="module")
def data():
    return crop_rows()


@pytest.fixture(scope="module")
def model(data):
    return Model(data)


@pytest.fixture(scope="module")
def tables(spark, data, tmp_path_factory):
    fact = spark.createDataFrame(data, FACT)
    lookup = spark.createDataFrame([(c, kind, flag) for c, (kind, flag) in KINDS.items()], "category string, kind string, COL int")
    return crop.crop_tables(fact, lookup, str(tmp_path_factory.mktemp("work")))


@pytest.fixture(scope="module")
def live_rows():
    draw = random.Random(9)
    out = []
    for prefix, uf in CODES.items():
        for n in range(6):
            for year in YEARS:
                for kind, category in (("Rebanho", "Bovino"), ("Rebanho", "Ovino"), ("Producao", "Leite"), ("Producao", "Total")):
                    if draw.random() < 0.3:
                        continue
                    head = float(draw.randint(0, 500)) if kind == "Rebanho" else None
                    made = None if head is not None else float(draw.randint(0, 500))
                    out.append((f"{prefix}{n:05d}", "M", uf, "R", year, kind, "1", category, head, made, None if made is None else made * 2.5))
    return out


LIVE = ("mun string, mun_name string, uf string, region string, year int, kind string, category_code string, category string, "
        "Efetivo_Cabecas double, Quantidade double, Valor_mil_reais double")


@pytest.fixture(scope="module")
def live_tables(spark, live_rows, tmp_path_factory):
    mapping = spark.createDataFrame([(f"{p}{n:05d}", f"{p}00{n // 2}") for p in CODES for n in range(5)], "mun string, mic string")
    return livestock.livestock_tables(spark.createDataFrame(live_rows, LIVE), mapping, str(tmp_path_factory.mktemp("live")))


@pytest.fixture(scope="module")
def view(tables, live_tables):
    return Explorer(tables.base, tables.groups, live_tables.base, tables.states, tables.micros, tables.municipalities, tuple(tables.years))


def near(value):
    return pytest.approx(value, abs=1e-6)


def test_tables_and_rejects(spark, tables, model):
    assert tables.years == YEARS
    assert sorted(r.uf for r in tables.states.collect()) == ["RJ", "RO", "SP"]
    assert {r.category for r in tables.groups.collect()} == set(CROPS)
    assert tables.base.agg(F.sum("p")).first()[0] == near(sum(r[9] or 0 for r in model.rows))
    assert tables.base.where(F.col("category").isNull()).count() == 0
    folder = tables.base.inputFiles()[0].split("/base/")[0]
    rejects = spark.read.parquet(f"{folder}/fact").where("rejected = 1")
    assert sorted((r.mun, r.uf) for r in rejects.collect()) == [("3500001", "SP"), ("9900001", None)]
    report = {r["name"]: r["rows"] for r in tables.quality.collect()}
    assert (report["unknown_state"], report["no_category"], report["no_year"]) == (1, 1, 0)
    assert {n.removeprefix("new_category: ") for n in report if n.startswith("new_category")} == set(CROPS) - set(KINDS)


def test_first_run_classifies_and_writes_the_lookup(spark, data, tmp_path):
    made = crop.crop_tables(spark.createDataFrame(data, FACT), None, str(tmp_path / "work"), groups_folder=str(tmp_path / "groups"))
    lookup = {r.category: r.kind for r in read_category_groups(spark, str(tmp_path / "groups")).collect()}
    assert lookup == {r.category: r.kind for r in made.groups.collect()} and set(lookup) == set(CROPS)


def test_questions_that_would_mix_units_or_years_are_refused(view):
    live = Selection("livestock", "q", kind="Rebanho", year=YEARS[0])
    for ask in (view.kpis, view.export_rows, view.series, view.top_states, view.top_micros):
        with pytest.raises(ValueError, match="category"):
            ask(live)
    with pytest.raises(ValueError, match="year"):
        view.export_document(Selection(metric="a"))


def read_section(spark, folder, name):
    frame = spark.read.text(f"{folder}/{name}")
    lines = [json.loads(r.value) for r in frame.collect()]
    return {json.dumps(x["key"]) if isinstance(x["key"], dict) else x["key"]: x["value"] for x in lines}


def test_crop_package(spark, tables, model, tmp_path):
    crop.write_crop_package(tables, str(tmp_path))
    section = lambda name: read_section(spark, tmp_path, name)
    in_order = lambda name: [v for _, v in sorted(section(name).items())]
    assert in_order("anos") == YEARS
    assert in_order("culturas") == sorted(CROPS)
    assert in_order("colheitadeiras") == ["Milho", "Soja"]
    assert in_order("tratores") == ["Alho", "Kiwi"]
    assert in_order("permanentes") == ["Café", "Uva"]
    assert in_order("temporarias") == ["Alho", "Kiwi", "Milho", "Soja"]
    assert section("ufs_info")["SP"] == {"n": "São Paulo", "r": "SE"}
    assert section("mic_info")["35000"] == {"n": "Mic 35000", "uf": "SP", "ms": "Meso 35"}
    assert section("mun_info")["3500002"] == {"n": "Mun 3500002", "uf": "SP", "mid": "35001"}
    states = section("est_data")
    assert sorted(states) == model.keys("uf")
    for uf, crops in states.items():
        for category, series in crops.items():
            for metric in "apvr":
                assert series[metric] == [near(model.cell(uf, category, y, metric)) for y in YEARS]
    micros = section("mic_data")
    assert sorted(micros) == model.keys("mic")
    for mic, groups in micros.items():
        for group, series in groups.items():
            assert series["p"] == [near(round(model.total(model.select("mic", mic, y, group), "p"), 1)) for y in YEARS]
    for mun, series in section("mun_data").items():
        assert series["v"] == [near(round(model.total(model.select("mun", mun, y), "v"), 1)) for y in YEARS]
    for key, series in section("mun_grp_data").items():
        key = json.loads(key)
        assert series["a"] == [near(round(model.total(model.select("mun", key["mun"], y, key["grp"]), "a"), 1)) for y in YEARS]


ACTIVE = {"ALL": CROPS, "TEM": ["Soja", "Milho", "Alho", "Kiwi"], "PER": ["Uva", "Café"], "COL": ["Soja", "Milho"], "TRA": ["Alho", "Kiwi"]}


def got(df, key):
    return {r[key]: r.value for r in df.collect()}


@pytest.mark.parametrize("group", list(ACTIVE))
@pytest.mark.parametrize("compat", [False, True])
def test_values_per_level(view, model, group, compat):
    sel = Selection(metric="p", group=group, year=2020, compat=compat)
    states = got(view.values(sel, "uf"), "uf")
    for uf in model.keys("uf"):
        if compat:
            expected = sum(model.cell(uf, c, 2020, "p") for c in ACTIVE[group])
        else:
            expected = model.total(model.select("uf", uf, 2020, group), "p")
        assert states.get(uf, 0) == near(expected)
    for level in ("mic", "mun"):
        values = got(view.values(sel, level), level)
        for key in model.keys(level):
            expected = model.total(model.select(level, key, 2020, group), "p")
            assert values.get(key, 0) == near(round(expected, 1) if compat else expected)


def test_chosen_category_below_state_level(view, model):
    for category in ("Alho", "Soja"):
        sel = Selection(metric="a", group="TEM", category=category, year=2019)
        exact, published = got(view.values(sel, "mic"), "mic"), got(view.values(sel.with_(compat=True), "mic"), "mic")
        by_mun = got(view.values(sel.with_(compat=True), "mun"), "mun")
        for mic in model.keys("mic"):
            assert exact.get(mic, 0) == near(model.total(model.select("mic", mic, 2019, category=category), "a"))
            key = "Soja" if category == "Soja" else "TEM"
            assert published.get(mic, 0) == near(round(model.total(model.select("mic", mic, 2019, key), "a"), 1))
        for mun in model.keys("mun"):
            assert by_mun.get(mun, 0) == near(round(model.total(model.select("mun", mun, 2019, "TEM"), "a"), 1))


def test_yields(view, model):
    sel = Selection(metric="r", group="COL", year=2022)
    weighted, published = got(view.values(sel, "uf"), "uf"), got(view.values(sel.with_(compat=True), "uf"), "uf")
    for uf in model.keys("uf"):
        rows = model.select("uf", uf, 2022, "COL")
        assert weighted[uf] == near(model.total(rows, "p") * 1000 / model.total(rows, "a"))
        assert published[uf] == near(sum(model.cell(uf, c, 2022, "r") for c in ACTIVE["COL"]))
    assert set(got(view.values(sel.with_(compat=True), "mic"), "mic").values()) == {0.0}
    assert set(got(view.values(sel.with_(compat=True), "mun"), "mun").values()) == {0.0}


@pytest.mark.parametrize("compat", [False, True])
def test_rankings(view, model, compat):
    sel = Selection(metric="v", year=2020, compat=compat)
    cell = lambda uf, c: model.cell(uf, c, 2020, "v") if compat else model.total(model.select("uf", uf, 2020, category=c), "v")
    by_uf = sorted(((sum(cell(u, c) for c in CROPS), u) for u in model.keys("uf")), key=lambda x: (-x[0], x[1]))
    top = view.top_states(sel, 2).collect()
    assert [(r.uf, r.value) for r in top] == [(u, near(v)) for v, u in by_uf[:2]]
    assert top[0].uf_name in ("São Paulo", "Rio de Janeiro", "Rondônia")
    for uf in (None, "RJ"):
        scope = [uf] if uf else model.keys("uf")
        by_crop = sorted(((sum(cell(u, c) for u in scope), c) for c in CROPS), key=lambda x: (-x[0], x[1]))
        assert [(r.category, r.value) for r in view.top_categories(sel.with_(uf=uf), 4).collect()] == [(c, near(v)) for v, c in by_crop[:4]]
    by_mic = sorted(((round(model.total(model.select("mic", m, 2020), "v"), 1), m) for m in model.keys("mic") if m[:2] == "35"), key=lambda x: (-x[0], x[1]))
    assert [r.mic for r in view.top_micros(sel.with_(uf="SP"), 20).collect()] == [m for v, m in by_mic if v > 0]
    best = view.municipality_ranking(sel.with_(uf="SP"), 3).collect()
    by_mun = sorted(((round(model.total(model.select("mun", m, 2020), "v"), 1), m) for m in model.keys("mun") if m[:2] == "35"), key=lambda x: (-x[0], x[1]))
    assert [(r.position, r.mun, r.mun_name, r.mic_name) for r in best] == [
        (i, m, f"Mun {m}", f"Mic 3500{int(m[2:]) // 2}") for i, (_, m) in enumerate(by_mun[:3], 1)]


def test_series(view, model):
    sel = Selection(metric="p", group="TEM")
    national = {r.year: r.value for r in view.series(sel).collect()}
    assert national == {y: near(sum(model.total(model.select("uf", u, y, "TEM"), "p") for u in model.keys("uf"))) for y in YEARS}
    state = [r.value for r in view.series(sel.with_(uf="RO")).orderBy("year").collect()]
    assert state == [near(model.total(model.select("uf", "RO", y, "TEM"), "p")) for y in YEARS]
    from_muns = [r.value for r in view.municipality_series(sel.with_(uf="RO")).orderBy("year").collect()]
    assert from_muns == [near(x) for x in state]
    micro = [r.value for r in view.series(sel.with_(uf="RO", mic="35001")).orderBy("year").collect()]
    assert micro == [near(model.total(model.select("mic", "35001", y, "TEM"), "p")) for y in YEARS]
    one = [r.value for r in view.municipality_series(sel.with_(uf="RO", mun="1100003")).orderBy("year").collect()]
    assert one == [near(model.total(model.select("mun", "1100003", y, "TEM"), "p")) for y in YEARS]
    fallback = [r.value for r in view.municipality_series(sel.with_(uf="RO", mun="none")).orderBy("year").collect()]
    assert fallback == [near(x) for x in state]
    assert [r.value for r in view.series(sel.with_(mic="none")).collect()] == [0.0] * 3


def test_yield_series_compat(view, model):
    sel = Selection(metric="r", compat=True)
    got_series = {r.year: r.value for r in view.series(sel).collect()}
    assert got_series == {y: near(sum(model.cell(u, c, y, "r") for u in model.keys("uf") for c in CROPS)) for y in YEARS}


@pytest.mark.parametrize("compat", [False, True])
def test_crop_kpis(view, model, compat):
    row = view.kpis(Selection(group="TEM", year=2020, compat=compat)).first()
    cells = [(u, c, [model.cell(u, c, 2020, m) for m in "apv"]) for u in model.keys("uf") for c in ACTIVE["TEM"]]
    assert (row.a, row.p, row.v) == tuple(pytest.approx(sum(x[2][i] for x in cells), abs=1) for i in range(3))
    filled = [(u, c) for u, c, m in cells if sum(m) > 0]
    assert (row.pair_count, row.crop_count) == (len(filled), len({c for _, c in filled}))


def test_choropleth_and_labels(spark, view, model):
    features = spark.createDataFrame([(m, "geo") for m in [*model.keys("mic"), "zzz"]], "mic string, geometry string")
    sel = Selection(metric="p", year=2020, uf="SP")
    painted = view.choropleth(sel, features, "mic").collect()
    assert sorted(r.mic for r in painted) == [m for m in model.keys("mic") if m[:2] == "35"]
    assert [r.class_index for r in painted if r.value == r.scope_max] == [6]
    texts = view.labelled(view.values(sel, "mic"), sel).first()
    assert texts.label == "Produção (ton)" and texts.text != EM_DASH
    live = Selection("livestock", "q", category="Bovino", year=2020)
    assert view.labelled(view.values(live, "uf"), live).first().label == "Bovino — Efetivo (cab.)"


def test_export_files(spark, view, model, tmp_path):
    sel = Selection(metric="v", group="PER", year=2019, uf="SP", compat=True)
    path = view.write_export_csv(sel, str(tmp_path))
    assert path.endswith("PAM_2019_SP.csv")
    written = spark.read.option("sep", ";").option("header", True).csv(path)
    assert written.columns == ["UF", "Estado", "Cultura", "Valor (mil R$)"]
    assert {(r.UF, r.Estado, r.Cultura, float(r[3])) for r in written.collect()} == {
        ("SP", "São Paulo", c, model.cell("SP", c, 2019, "v")) for c in ACTIVE["PER"]}
    live = Selection("livestock", "q", category="Bovino", year=2020)
    columns = spark.read.option("sep", ";").option("header", True).csv(view.write_export_csv(live, str(tmp_path))).columns
    assert columns == ["UF", "Estado", "Categoria", "Bovino — Efetivo (cab.)"]
    text = spark.read.text(view.write_export_json(live, str(tmp_path))).first().value
    assert json.loads(text)["metrica"] == "q"


def test_exports(view, model):
    sel = Selection(metric="a", group="PER", year=2019, compat=True)
    rows = {(r.uf, r.category): r.value for r in view.export_rows(sel).collect()}
    assert rows == {(u, c): near(model.cell(u, c, 2019, "a")) for u in model.keys("uf") for c in ACTIVE["PER"] if model.cell(u, c, 2019, "a")}
    document = json.loads(view.export_document(sel).first().document)
    assert (document["ano"], document["metrica"], document["uf"]) == (2019, "a", "BR")
    assert {(u, c) for u, m in document["data"].items() for c in m} == set(rows)
    empty = json.loads(view.export_document(sel.with_(category="Nothing", uf="RJ")).first().document)
    assert empty["uf"] == "RJ" and empty["data"] == {"RJ": {}}
    live = json.loads(view.export_document(Selection("livestock", "q", category="Nothing", year=2020)).first().document)
    assert live["data"] == {}


def live_total(rows, measure, **wanted):
    names = dict(mun=0, uf=2, year=4, kind=5, category=7)
    kept = [r for r in rows if r[7] != "Total" and int(r[0][2:]) < 5 and all(r[names[k]] == v for k, v in wanted.items())]
    return sum((r[8] if r[8] is not None else r[9]) if measure == "q" else (r[10] or 0) for r in kept)


def test_livestock_questions(view, live_rows, live_tables):
    assert live_tables.years == YEARS
    assert [r.category for r in live_tables.categories("Producao").collect()] == ["Leite"]
    sel = Selection("livestock", "q", category="Bovino", year=2020)
    assert got(view.values(sel, "uf"), "uf") == {u: near(live_total(live_rows, "q", uf=u, year=2020, category="Bovino")) for u in CODES.values()}
    top = view.top_categories(Selection("livestock", "q", kind="Rebanho", year=2020)).collect()
    assert [(r.category, r.value) for r in top] == sorted(
        [(c, near(live_total(live_rows, "q", year=2020, category=c))) for c in ("Bovino", "Ovino")], key=lambda x: -x[1].expected)
    assert [r.category for r in view.top_categories(Selection("livestock", "v", kind="Producao", year=2020, compat=True)).collect()] == ["Leite"]
    kpis = view.kpis(sel.with_(uf="SP")).first()
    assert (kpis.q, kpis.v) == (near(live_total(live_rows, "q", uf="SP", year=2020, category="Bovino")), 0)
    assert kpis.municipalities == sum(live_total(live_rows, "q", mun=f"35{n:05d}", year=2020, category="Bovino") > 0 for n in range(5))
    ranking = view.municipality_ranking(sel.with_(uf="SP", compat=True), 2).collect()
    assert [r.position for r in ranking] == [1, 2] and ranking[0].mun_name == f"Mun {ranking[0].mun}"
    one = view.municipalities.where(F.col("mun") == ranking[0].mun)
    narrow = replace(view, municipalities=one)
    assert narrow.kpis(sel.with_(compat=True)).first().municipalities == 1
    assert narrow.kpis(sel.with_(compat=True)).first().q == view.kpis(sel).first().q
    assert [r.mun for r in narrow.municipality_ranking(sel.with_(uf="SP", compat=True)).collect()] == [ranking[0].mun]
    series = view.series(Selection("livestock", "v", kind="Producao", category="Leite", uf="RJ")).orderBy("year").collect()
    assert [r.value for r in series] == [near(live_total(live_rows, "v", uf="RJ", year=y, category="Leite")) for y in YEARS]


def test_livestock_package(spark, live_rows, live_tables, tmp_path):
    livestock.write_livestock_package(live_tables, str(tmp_path))
    assert [v for _, v in sorted(read_section(spark, tmp_path, "rebanho_categorias").items())] == ["Bovino", "Ovino"]
    for name, level in (("est_data", "uf"), ("mun_data", "mun")):
        for key, categories in read_section(spark, tmp_path, name).items():
            for category, series in categories.items():
                for measure in "qv":
                    assert series[measure] == [near(live_total(live_rows, measure, year=y, category=category, **{level: key})) for y in YEARS]
    assert len(read_section(spark, tmp_path, "mic_data")) > 0


def test_consolidated_export(spark, tmp_path):
    head = "Cod_Municipio;Municipio;UF;Regiao;Ano;Tipo;Cod_Categoria;Categoria;Variavel;Valor\n"
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "ppm_3939_2020.csv").write_text(head + "1;X;SP;S;2020;Rebanho;1;Bovino;Efetivo_Cabecas;4.0\n", encoding="utf-8")
    (tmp_path / "raw" / "ppm_74_2020.csv").write_text(head + "1;X;SP;S;2020;Producao;2;Leite;Quantidade;5.0\n", encoding="utf-8")
    combined = livestock.export_consolidated(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    got_rows = {r.category: (r.Efetivo_Cabecas, r.Quantidade, r.Valor_mil_reais) for r in combined.collect()}
    assert got_rows == {"Bovino": (4.0, None, None), "Leite": (None, 5.0, None)}
    from municipia.sources.files import read_livestock_fact
    again = read_livestock_fact(spark, str(tmp_path / "out" / "completo"))
    assert sorted(r.category for r in again.collect()) == ["Bovino", "Leite"]


def test_sections_cover_every_key_once(spark, tables, tmp_path):
    crop.write_crop_package(tables, str(tmp_path))
    counts = defaultdict(int)
    for row in spark.read.text(f"{tmp_path}/mun_data").collect():
        counts[json.loads(row.value)["key"]] += 1
    assert set(counts.values()) == {1} and len(counts) == 18


UNFIT = [float("nan"), float("inf"), float("-inf"), 1e300, 0.1234]


def test_bad_cells_are_left_out_counted_and_published_as_0(spark, tmp_path):
    """Every kind of bad cell in every measure: NaN is missing, an infinite or too large cell makes its sums 0, finer ones are rounded."""
    rows, expected = [], {}
    for i, value in enumerate(UNFIT):
        for j, measure in enumerate("apvr"):
            mun, cell = f"35{i}{j:04d}", [1.0, 2.0, 3.0, 4.0]
            cell[j] = value
            rows.append((mun, "SP", f"35{i}", "m", "m", "m", 2020, f"C{j}", *cell, "x"))
            rows.append((mun, "SP", f"35{i}", "m", "m", "m", 2021, f"C{j}", 1.0, 2.0, 3.0, 4.0, "x"))
            expected[mun] = {m: [round(cell["apvr".index(m)], 1) if abs(cell["apvr".index(m)]) < 1e9 else 0.0, [1.0, 2.0, 3.0][k]] for k, m in enumerate("apv")}
    rows.append(("3599999", "SP", "35z", "m", "m", "m", 2020, "C0", 5.0, 5.0, 5.0, None, "x"))  # a good cell of the same state and category
    lookup = spark.createDataFrame([(f"C{j}", "TEM", j % 2) for j in range(4)], "category string, kind string, COL int")
    made = crop.crop_tables(spark.createDataFrame(rows, FACT), lookup, str(tmp_path / "work"))
    report = {r["name"]: r["rows"] for r in made.quality.collect()}
    for measure in "apvr":
        assert [report[f"cell {p}: {measure}"] for p in ("nan", "infinite", "too_large", "finer_than_unit")] == [1, 2, 1, 1]
    cells = made.rejected_cells.collect()
    assert len(cells) == 20 and {c.value for c in cells} == {"NaN", "Infinity", "-Infinity", "1.0E300", "0.1234"}
    crop.write_crop_package(made, str(tmp_path / "package"))
    muns = read_section(spark, tmp_path / "package", "mun_data")
    assert {k: v for k, v in muns.items() if k != "3599999"} == expected and muns["3599999"]["a"] == [5.0, 0.0]
    state = read_section(spark, tmp_path / "package", "est_data")["SP"]
    assert [state["C0"][m][0] for m in "apvr"] == [0, 15.0, 20.0, 4.0]  # an infinite area among the state's; the yields' mean
    assert state["C0"]["a"][1] == 5.0 and state["C3"]["r"] == [0, 4.0] and state["C3"]["a"] == [5.0, 5.0]
    for section, key in (("mic_data", "351"), ("mun_grp_data", json.dumps({"grp": "TEM", "mun": "3510000"}))):
        value = read_section(spark, tmp_path / "package", section)[key]
        assert (value["ALL"] if section == "mic_data" else value)["a"][0] == 0


def test_bad_livestock_cells(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    cells = [(nan, 7.0, 1.0), (inf, 7.0, 1.0), (None, 1e300, nan), (3.0, inf, -inf), (None, None, 0.00051)]
    rows = [(f"35{i:05d}", "M", "SP", "R", 2020, "Rebanho", "1", "Bovino", *c) for i, c in enumerate(cells)]
    mapping = spark.createDataFrame([(r[0], "35001") for r in rows], "mun string, mic string")
    made = livestock.livestock_tables(spark.createDataFrame(rows, LIVE), mapping, str(tmp_path / "work"))
    livestock.write_livestock_package(made, str(tmp_path / "package"))
    muns = {k: (v["Bovino"]["q"][0], v["Bovino"]["v"][0]) for k, v in read_section(spark, tmp_path / "package", "mun_data").items()}
    assert [muns[r[0]] for r in rows] == [(7.0, 1.0), (0.0, 1.0), (0.0, 0.0), (3.0, 0.0), (0.0, 0.0)]
    assert read_section(spark, tmp_path / "package", "est_data")["SP"]["Bovino"] == {"q": [0.0], "v": [0.0]}
    assert made.rejected_cells.count() == 7
    # Columns that a file lacks are no cells.
    narrow = spark.createDataFrame(rows, LIVE).drop("Efetivo_Cabecas", "Valor_mil_reais")
    assert livestock.clean_livestock(narrow, mapping).agg(F.sum("q"), F.sum("q_bad"), F.sum("v_bad")).first()[:] == (14.0, 2, 0)
