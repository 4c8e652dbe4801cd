"""Readers, writers and incremental loading on landed files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from municipia.operators import lookups, quality
from municipia.sinks import files
from municipia.sinks.tables import materialise
from municipia.sources import api, geo
from municipia.sources import files as sources
from municipia.streaming import ingest

BOM = "﻿"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_read_crop_fact_any_column_order(spark, tmp_path):
    path = write(tmp_path / "crop.csv", BOM + "Ano;Cod_Municipio;Nome_Municipio;UF;Cod_Microrregiao;Cultura;Area_Colhida_ha;Quantidade_Produzida_ton\n"
                 "2020;0100015;Alta Floresta;XX;01001;Soja;10.5;\n;1100023;;RO;;;x;3\n")
    got = {r.mun: r for r in sources.read_crop_fact(spark, path).collect()}
    first, second = got["0100015"], got["1100023"]
    assert (first.mun_name, first.mic, first.year, first.category, first.a, first.p, first.v, first.uf_file) == (
        "Alta Floresta", "01001", 2020, "Soja", 10.5, None, None, "XX")
    assert (second.mun_name, second.year, second.category, second.a, second.p) == (None, None, None, None, 3.0)


def test_read_crop_fact_without_a_name_column(spark, tmp_path):
    path = write(tmp_path / "crop.csv", "Cod_Municipio;Ano\n1100015;2020\n")
    assert sources.read_crop_fact(spark, path).first().mun_name == "1100015"


def test_read_livestock_fact(spark, tmp_path):
    path = write(tmp_path / "live.csv", BOM + "Cod_Municipio;Municipio;UF;Regiao;Ano;Tipo;Cod_Categoria;Categoria;Efetivo_Cabecas\n"
                 "0100015;A;RO;Norte;2020;Rebanho;2670;Bovino;12.0\n")
    df = sources.read_livestock_fact(spark, path)
    assert df.first().asDict() == {
        "mun": "0100015", "mun_name": "A", "uf": "RO", "region": "Norte", "year": 2020, "kind": "Rebanho",
        "category_code": "2670", "category": "Bovino", "Efetivo_Cabecas": 12.0}


def test_category_groups_round_trip(spark, tmp_path, rows):
    path = write(tmp_path / "groups.csv", BOM + "cultura,tipo,COL,XYZ\nSoja,TEM,1,\nUva,PER,,1.0\nNova,,0,0\n")
    groups = sources.read_category_groups(spark, path)
    assert rows(groups) == [("Nova", None, 0, 0), ("Soja", "TEM", 1, 0), ("Uva", "PER", 0, 1)]
    files.save_category_groups(groups, str(tmp_path / "new"))
    assert rows(sources.read_category_groups(spark, str(tmp_path / "new"))) == rows(groups)
    with pytest.raises(Exception):
        files.save_category_groups(groups, str(tmp_path / "new"))


HEAD = "Cod_Municipio;Municipio;UF;Regiao;Ano;Tipo;Cod_Categoria;Categoria;Variavel;Valor\n"


def slice_text(value, mun="3550308", uf="SP", variable="Quantidade", year=2020, category="Leite"):
    return BOM + HEAD + f"{mun};X;{uf};Sudeste;{year};Producao;2682;{category};{variable};{value}\n"


def test_raw_slices_of_all_years_without_empty_files(spark, tmp_path, rows):
    folder = tmp_path / "raw"
    write(folder / "ppm_74_2020.csv", slice_text("5.0") + "3550308;X;SP;Sudeste;2020;Producao;2682;Leite;Valor_mil_reais;7.5\n")
    write(folder / "ppm_74_2021.csv", "\n")
    write(folder / "ppm_74_2030.csv", slice_text("9.0", year=2030))
    write(folder / "ppm_3939_2020.csv", slice_text("1.0", variable="Efetivo_Cabecas"))
    write(folder / "other.csv", "junk\n")
    long = sources.read_raw_slices(spark, str(folder), 74)
    every = [("3550308", 2020, "Quantidade", 5.0), ("3550308", 2020, "Valor_mil_reais", 7.5), ("3550308", 2030, "Quantidade", 9.0)]
    assert rows(long.select("mun", "year", "variable", "value")) == every
    assert rows(sources.read_raw_slices(spark, str(folder), 74, last_year=2029).select("mun", "year", "variable", "value")) == every[:2]
    wide = sources.consolidate_table(spark, str(folder), 74).where("year = 2020").first()
    assert (wide.Quantidade, wide.Valor_mil_reais) == (5.0, 7.5)
    assert sources.consolidate_table(spark, str(folder), 3939).count() == 1


def test_raw_slices_keep_bad_rows_apart_and_refuse_other_headers(spark, tmp_path, rows):
    folder = tmp_path / "raw"
    write(folder / "ppm_74_2020.csv", slice_text("5.0") + "3550308;X;SP;Sudeste;2020.0;Producao;2682;Leite;Valor_mil_reais;7.5\n1;too;few\n" + slice_text("1;2").split("\n")[1] + "\n")
    got = sources.read_raw_slices(spark, str(folder), 74).select("mun", "year", "value")
    assert rows(got) == [("3550308", 2020, 5.0), ("3550308", 2020, 7.5)] and got.count() == 2
    assert sorted(r.row for r in sources.rejected_slice_rows(spark, str(folder), 74).collect()) == ["1;too;few", "3550308;X;SP;Sudeste;2020;Producao;2682;Leite;Quantidade;1;2"]
    swapped = tmp_path / "swapped"
    write(swapped / "ppm_74_2020.csv", slice_text("5.0").replace("Cod_Municipio;Municipio", "Municipio;Cod_Municipio"))
    with pytest.raises(Exception, match="header"):
        sources.read_raw_slices(spark, str(swapped), 74).collect()


def test_whole_years_written_as_decimals(spark, tmp_path):
    path = write(tmp_path / "crop.csv", "Cod_Municipio;Ano\n1100015;2020.0\n1100023;2020.5\n1100031;n\n")
    assert [r.year for r in sources.read_crop_fact(spark, path).orderBy("mun").collect()] == [2020, None, None]


LABELS = {"D1C": "Município (Código)", "D1N": "Município (Nome)", "D2C": "Variável (Código)", "D2N": "Variável",
          "D3C": "Ano (Código)", "D3N": "Ano (Nome)", "D4C": "Tipo de rebanho (Código)", "D4N": "Tipo de rebanho (Nome)", "V": "Valor"}


def payload(labels, rename=None):
    rename = rename or {}
    row = {"D1C": "3550308", "D1N": "São Paulo", "D2C": "105", "D3N": "2020", "D4C": "2670", "D4N": "Bovino", "V": "1,234"}
    rows = [row, {**row, "V": "...", "D2C": "999"}, {**row, "V": "-", "D4N": "Ovino"}]
    move = lambda d: {rename.get(k, k): v for k, v in d.items()}
    return json.dumps([move(labels)] + [move(r) for r in rows], ensure_ascii=False)


def test_api_payloads(spark, tmp_path, rows):
    folder = tmp_path / "api"
    write(folder / "ppm_3939_2020_35.json", payload(LABELS))
    # Columns moved: the header says where they are.
    moved = {"D1C": "D5C", "D1N": "D5N", "D3N": "D1N", "D4C": "D9C", "D4N": "D9N"}
    write(folder / "ppm_3939_2021_33.json", payload(LABELS, moved))
    # No label matches: the usual keys are used.
    write(folder / "ppm_3939_2022_11.json", payload({k: "?" for k in LABELS}))
    write(folder / "ppm_3939_2023_12.json", json.dumps([LABELS]))
    write(folder / "ppm_3939_2023_13.json", "[]")
    write(folder / "ppm_74_2020_35.json", payload(LABELS))
    got = api.read_stat_api_json(spark, str(folder), 3939)
    assert got.count() == 9
    for uf, region in (("SP", "Sudeste"), ("RJ", "Sudeste"), ("RO", "Norte")):
        one = got.where(F.col("uf") == uf)
        assert rows(one.drop("uf")) == sorted([
            ("3550308", "São Paulo", region, 2020, "Rebanho", "2670", "Bovino", "Efetivo_Cabecas", 1234.0),
            ("3550308", "São Paulo", region, 2020, "Rebanho", "2670", "Bovino", "999", None),
            ("3550308", "São Paulo", region, 2020, "Rebanho", "2670", "Ovino", "Efetivo_Cabecas", None),
        ], key=repr)


def test_localities(spark, tmp_path, rows):
    path = write(tmp_path / "loc.json", json.dumps([
        {"id": 3550308, "nome": "São Paulo", "microrregiao": {"id": 35061, "nome": "x"}}, {"id": 5101837, "microrregiao": None}, {"id": 1}]))
    assert rows(api.read_localities(spark, path)) == [("3550308", "35061")]


POLYGON = '{"type":"Polygon","coordinates":[[[1.5,2],[3,4]]]}'
MULTI = '{"type":"MultiPolygon","coordinates":[[[[1,2],[3,4]]]]}'


def test_geo_features_keep_geometry(spark, tmp_path):
    features = ('{"type":"FeatureCollection","features":['
                '{"type":"Feature","properties":{"codarea":"035"},"geometry":' + POLYGON + "},"
                '{"type":"Feature","properties":{"codarea":"99"},"geometry":' + MULTI + "},"
                '{"type":"Feature","properties":{"codarea":"abc"},"geometry":' + POLYGON + "},"
                '{"type":"Feature","properties":{"codarea":""},"geometry":' + POLYGON + "},"
                '{"type":"Feature","geometry":' + POLYGON + "}]}")
    path = write(tmp_path / "geo.json", features)
    ufs = [r.uf for r in geo.read_geo_features(spark, path, "uf").collect()]
    assert sorted(ufs) == ["", "", "99", "SP", "abc"]
    mids = geo.read_geo_features(spark, path, "mid")
    assert sorted(r.mid for r in mids.collect()) == ["", "", "35", "99", "abc"]
    files.write_geo_features(mids.where("mid in ('35', '99')"), str(tmp_path / "out"), "mid")
    lines = [json.loads(line) for part in (tmp_path / "out").glob("part-*") for line in part.read_text().splitlines()]
    assert {f["properties"]["mid"]: f["geometry"] for f in lines} == {"35": json.loads(POLYGON), "99": json.loads(MULTI)}
    with pytest.raises(ValueError):
        geo.read_geo_features(spark, path, "mun")


def test_csv_and_published_measures(spark, tmp_path):
    df = spark.createDataFrame([("São", 0.35, 2.675, float("nan"))], "n string, a double, r double, x double")
    rounded = files.sanitize_measures(files.round_measures(df)).first()
    assert (rounded.a, rounded.r, rounded.x) == (0.3, 2.67, 0.0)
    files.write_csv(df.select("n", "a").coalesce(1), str(tmp_path / "csv"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "csv").glob("part-*"))
    assert text == "n;a\nSão;0.35\n"


def test_ingest_new_corrected_and_empty_slices(spark, tmp_path, rows):
    landing, table, checkpoint = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ckpt")

    def load():
        ingest.ingest_new_slices(spark, str(landing), table, checkpoint)
        return rows(spark.read.parquet(table).select("survey_table", "slice_year", "uf", "mun", "value"))

    write(landing / "ppm_74_2020.csv", slice_text("5.0") + "3304557;Y;RJ;Sudeste;2020;Producao;2682;Leite;Quantidade;1,000\n")
    write(landing / "ppm_74_2021.csv", "\n")
    first = load()
    assert first == [(74, 2020, "RJ", "3304557", 1000.0), (74, 2020, "SP", "3550308", 5.0)]
    assert load() == first  # nothing new
    write(landing / "ppm_74_2022.csv", slice_text("...", year=2022))
    assert load() == sorted(first + [(74, 2022, "SP", "3550308", None)], key=repr)
    # A corrected slice under a new name replaces its rows and no other ones.
    write(landing / "ppm_74_2020_b.csv", slice_text("6.0") + slice_text("8.0", mun="3509502").split("\n")[1] + "\n")
    assert load() == sorted([(74, 2020, "RJ", "3304557", 1000.0), (74, 2020, "SP", "3550308", 6.0), (74, 2020, "SP", "3509502", 8.0),
                             (74, 2022, "SP", "3550308", None)], key=repr)
    # An older file that arrives late replaces nothing.
    write(landing / "ppm_74_2020_late.csv", slice_text("1.0"))
    os.utime(landing / "ppm_74_2020_late.csv", (1, 1))
    assert (74, 2020, "SP", "3550308", 6.0) in load() and (74, 2020, "SP", "3550308", 1.0) not in load()
    landed = ingest.landed_slices(spark, table)
    missing = quality.missing_slices(quality.expected_slices(spark, tables=[74], first_year=2020, last_year=2022), landed)
    assert missing.count() == 3 * 27 - 3


def test_newest_file_wins_within_a_batch(spark, rows):
    data = [(74, 2020, "SP", "old", 1, "1"), (74, 2020, "SP", "new", 2, "2"), (74, 2020, "RJ", "old", 1, "3")]
    df = spark.createDataFrame(data, "survey_table int, slice_year int, uf string, file_name string, file_time int, mun string")
    assert rows(ingest.newest_file_per_slice(df).select("mun")) == [("2",), ("3",)]


def test_states_are_complete(spark):
    known = lookups.states(spark)
    assert known.count() == 27 and known.select("region").distinct().count() == 5


def test_materialise_resumes_and_rebuilds_what_was_cut_off(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = spark.createDataFrame([(1, 2020)], "x int, year int"), spark.createDataFrame([(2, 2021)], "x int, year int")
    assert materialise(first, path, "year", run_id="one").first().x == 1
    assert materialise(second, path, "year", run_id="one").first().x == 1  # the same run, finished before: read only
    assert materialise(second, path, "year", run_id="two").first().x == 2
    assert materialise(first, path, "year").first().x == 1  # neither files nor a run: written anew
    other = str(tmp_path / "cut")
    first.write.parquet(other)  # data without the marker, as after a lost driver
    assert [r.x for r in materialise(second, other, run_id="one").collect()] == [2]


def test_materialise_follows_its_input_files(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    spark.range(3).write.parquet(source)
    built = materialise(spark.read.parquet(source), path)
    before = sorted(built.inputFiles())
    assert sorted(materialise(spark.read.parquet(source), path).inputFiles()) == before  # unchanged: read only
    spark.range(3, 9).write.mode("append").parquet(source)
    assert materialise(spark.read.parquet(source), path).count() == 9
