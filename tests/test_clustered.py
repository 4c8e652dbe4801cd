"""Layouts of the base table: what a scan skips, and joins without a shuffle."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from municipia.sinks import clustered

SCHEMA = "uf string, mun long, category string, p long, year int"


def facts(spark, n=60_000, hot=3):
    """Rows of 20 states, 30 categories and two years; one state holds every third row, and some keys are null."""
    draw = random.Random(5)
    rows = [("S00" if i % hot == 0 else f"S{draw.randrange(20):02d}", i % 997, f"C{draw.randrange(30):02d}", i, 2019 + i % 2) for i in range(n)]
    return spark.createDataFrame([*rows, (None, 1, "C01", 5, 2020), ("S01", None, None, None, 2020)], SCHEMA).repartition(6)


def scan_rows(df):
    """Rows that the scan gave to the plan, after the query has run."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_a_scope_reads_only_its_row_groups(spark, tmp_path, rows):
    given = facts(spark)
    clustered.write_clustered(given, str(tmp_path / "t"), row_group_bytes=8_192)
    table = clustered.read_clustered(spark, str(tmp_path / "t"), SCHEMA)
    assert rows(table.select(*given.columns)) == rows(given)
    asked = [F.col("uf") == "S07", (F.col("uf") == "S00") & (F.col("category") == "C11"), F.col("uf").isNull()]
    for condition in asked:
        found = table.where(condition & (F.col("year") == 2020))
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in text and "PartitionFilters: [isnotnull(year" in text
        assert rows(found.select(*given.columns)) == rows(given.where(condition & (F.col("year") == 2020)))
        assert scan_rows(found) < given.count() / 10


def test_a_hot_state_is_cut_into_several_files(spark, tmp_path):
    ranges = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}  # as if the ranges were large
    before = {n: spark.conf.get(n) for n in ranges}
    try:
        for n, value in ranges.items():
            spark.conf.set(n, value)
        clustered.write_clustered(facts(spark), str(tmp_path / "t"))
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    holding = []
    for path in sorted((tmp_path / "t").rglob("*.parquet")):
        values = pq.ParquetFile(path).read(["uf"]).column("uf").to_pylist()
        holding.append(values.count("S00"))
    assert sum(n > 0 for n in holding) >= 5 and max(holding) < 0.4 * sum(holding)


def test_equal_buckets_join_and_roll_up_without_a_shuffle(spark, tmp_path, rows):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    given, places = facts(spark), spark.range(1_200).select(F.col("id").alias("mun"), F.concat(F.lit("m"), "id").alias("name"))
    a = clustered.write_bucketed(given, str(tmp_path / "a"), ["mun"], 8)
    b = clustered.write_bucketed(places, str(tmp_path / "b"), ["mun"], 8)
    assert len(list((tmp_path / "a").glob("*.parquet"))) == 8
    joined = lambda x, y: y.join(x.groupBy("mun").agg(F.sum("p").alias("p"), F.count_distinct("category").alias("n")), "mun", "left")
    try:
        for n in names:
            spark.conf.set(n, "-1")
        found = joined(a, b)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(joined(given, places))
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


@pytest.mark.parametrize("rows_, least", [(0, 8), (1, 8), (32_000_001, 9), (10**11, 25_000)])
def test_buckets_follow_the_rows(rows_, least):
    assert clustered.bucket_number(rows_) == least


def test_empty_tables(spark, tmp_path):
    none = facts(spark).limit(0)
    clustered.write_clustered(none, str(tmp_path / "t"))
    assert clustered.read_clustered(spark, str(tmp_path / "t"), SCHEMA).count() == 0
    assert clustered.write_bucketed(none, str(tmp_path / "b"), ["mun"], 4).count() == 0
