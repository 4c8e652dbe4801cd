"""Roll-ups refreshed load by load, against a full build."""

import random

import pytest
from pyspark.sql import functions as F

from municipia.plans import crop, refresh
from municipia.sinks.slices import land_slices, slice_lines
from municipia.streaming import ingest

FACT = ("mun string, uf_file string, mic string, mic_name string, meso string, meso_name string, year int, category string, "
        "a double, p double, v double, r double, mun_name string")
STATES = {"35": "SP", "33": "RJ"}


def slice_of(prefix, year, seed, categories=("Soja", "Uva", "Alho")):
    draw = random.Random(f"{prefix}{year}{seed}")
    return [(f"{prefix}{n:05d}", STATES[prefix], f"{prefix}00{n // 2}", "m", "x", "x", year, c, *(draw.choice([None, draw.randint(0, 99) / 4]) for _ in range(4)), "n")
            for n in range(4) for c in categories]


def files_of(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_refresh_equals_a_full_build(spark, rows, tmp_path):
    groups = spark.createDataFrame([("Soja", "TEM", 1), ("Uva", "PER", 0)], "category string, kind string, COL int")
    folder = tmp_path / "tables"
    first = {(p, y): slice_of(p, y, 0) for p in STATES for y in (2019, 2020)}
    corrected = {("35", 2020): slice_of("35", 2020, 1, ("Soja", "Kiwi")), ("33", 2021): slice_of("33", 2021, 0)}
    frame = lambda slices: spark.createDataFrame([r for s in slices.values() for r in s], FACT)
    assert refresh.refresh_crop(frame(first), groups, str(folder)) == [2019, 2020]
    before = files_of(folder)
    assert refresh.refresh_crop(frame(corrected), groups, str(folder)) == [2020, 2021]
    touched = {p for p, t in before.items() if files_of(folder).get(p) != t}
    assert touched and all("year=2020" in p for p in touched) and not any("/base/" in p and "uf=RJ" in p for p in touched)

    def check(slices, names=tuple(refresh.crop_rollups(groups))):
        full = crop.base_rows(crop.clean_crop_fact(frame(slices)).where("rejected = 0"))
        for name, made in refresh.crop_rollups(groups).items():
            held = refresh.read_slices(spark, str(folder / name))
            assert rows(held.select(*made(full).columns)) == rows(made(full)), name

    check({**first, **corrected})
    # A slice without a usable row empties its partition; a second try of the same load changes nothing.
    withdrawn = frame({0: first["33", 2019]}).withColumn("category", F.lit(None).cast("string"))
    for _ in range(2):
        assert refresh.refresh_crop(withdrawn, groups, str(folder)) == [2019]
        check({k: v for k, v in {**first, **corrected}.items() if k != ("33", 2019)})
    assert refresh.refresh_crop(withdrawn.limit(0), groups, str(folder)) == []


def test_refresh_after_loads_and_a_batch_cut_off(spark, tmp_path, monkeypatch):
    landed, table, touched, out = (str(tmp_path / n) for n in ("landed", "table", "touched", "out"))
    mapping = spark.createDataFrame([("1", "m1"), ("2", "m2")], "mun string, mic string")
    names = ["Cod_Municipio", "Municipio", "UF", "Regiao", "Ano", "Tipo", "Cod_Categoria", "Categoria", "Variavel", "Valor"]

    def land(year, value, suffix=""):
        cells = [(m, "M", uf, "R", str(year), "Rebanho", "1", "Bovino", "Efetivo_Cabecas", value, 3939, year) for m, uf in (("1", "SP"), ("2", "RJ"))]
        land_slices(slice_lines(spark.createDataFrame(cells, [*names, "survey_table", "slice_year"])), landed, suffix)

    load = lambda: ingest.ingest_new_slices(spark, landed, table, str(tmp_path / "progress"), touched_path=touched)
    levels = lambda: {(r.level, r.key, r.year): r.q for r in refresh.read_slices(spark, f"{out}/levels").collect()}
    ask = lambda: refresh.refresh_from_slices(spark, table, touched, mapping, out)
    assert ask() == []
    land(2020, "5")
    load()
    assert ask() == [2020] and ask() == []
    assert levels()["uf", "SP", 2020] == 5.0 and len(levels()) == 6
    land(2021, "7")
    land(2020, "6", "v2")
    write = ingest._newer_than_table  # the batch ends after its table is written and before the stream knows

    def fails_late(*args):
        rows = write(*args)
        rows.select(*ingest.SLICE).distinct().write.mode("append").parquet(f"{touched}/batch=1")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*ingest.SLICE).parquet(table)
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_newer_than_table", fails_late)
    with pytest.raises(Exception, match="lost"):
        load()
    monkeypatch.setattr(ingest, "_newer_than_table", write)
    load()
    assert ask() == [2020, 2021]
    assert (levels()["uf", "SP", 2020], levels()["mic", "m2", 2021]) == (6.0, 7.0)


def test_slices_of_a_load_are_found_once(spark, tmp_path, monkeypatch):
    """A load may be a pass over delimited files; what is written must not read it again for the names of its slices."""
    groups = spark.createDataFrame([("Soja", "TEM", 1)], "category string, kind string, COL int")
    path, seen = str(tmp_path / "landed"), []
    spark.createDataFrame(slice_of("35", 2020, 0), FACT).write.csv(path)
    whole = refresh.overwrite_slices

    def watched(rows, touched, *rest):
        seen.append(touched._jdf.queryExecution().executedPlan().toString())
        whole(rows, touched, *rest)

    monkeypatch.setattr(refresh, "overwrite_slices", watched)
    assert refresh.refresh_crop(spark.read.schema(FACT).csv(path), groups, str(tmp_path / "tables")) == [2020]
    assert len(seen) == 5 and not any("FileScan" in text for text in seen)
