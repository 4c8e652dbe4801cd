"""What the plans must look like to hold at scale. Broadcasts by size are off, so every join side counts as large."""

import pytest

from municipia.plans import catalogue

# Queries from file to file end in a plain read of what they wrote.
QUERIES = {n: q for n, q in catalogue.QUERIES.items() if n not in catalogue.BATCHES}

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def large(spark):
    """A session in which no table is small enough to be broadcast by its size."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield spark
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_workers_cross_joins_or_whole_windows(large, name):
    text = plan(large, name)
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node
    # A window without a partition is allowed only right over a top-k of bounded size.
    lines = [line.strip(" :+-*0123456789()") for line in text.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Window [") and "], [" in line and not line.split("windowspecdefinition(")[1].split(" ASC")[0].split(" DESC")[0].count(","):
            below = next(x for x in lines[i + 1 :] if not x.startswith(("Sort", "Project", "Exchange SinglePartition", "WholeStage")))
            assert not lines[i + 1 :][1].startswith("Exchange SinglePartition") or below.startswith(("TakeOrderedAndProject", "GlobalLimit")), line


@pytest.mark.parametrize("name", ["top_states", "top_categories", "top_micros", "top_municipalities", "top_livestock_categories"])
def test_top_k_keeps_k_rows_per_task(large, name):
    assert "TakeOrderedAndProject" in plan(large, name)


@pytest.mark.parametrize("name", ["top_k_per_scope", "mun_ranking", "top_categories_in_state"])
def test_top_k_per_scope_cuts_before_the_shuffle(large, name):
    text = plan(large, name)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scans_read_only_what_is_needed(large):
    text = plan(large, "mun_rollup")
    assert "l_discount" in text and "l_shipdate" not in text and "c_custkey" not in text and "p_brand" not in text
    text = plan(large, "category_totals")
    assert "l_orderkey" not in text and "o_orderkey" not in text


def test_filters_reach_the_scan_of_a_partitioned_base(large, tmp_path):
    from municipia.params import Selection
    from municipia.plans.explorer import Explorer

    data = [("SP", "m", "1", "Soja", 2020, 1.0, 2.0, 3.0, 4.0, 1)]
    columns = "uf string, mic string, mun string, category string, year int, a double, p double, v double, r_sum double, r_n bigint"
    large.createDataFrame(data, columns).write.partitionBy("year").parquet(str(tmp_path / "base"))
    view = Explorer(large.read.parquet(str(tmp_path / "base")), years=(2020,))
    text = view.values(Selection(metric="p", year=2020, uf="SP"), "mun")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "EqualTo(uf,SP)" in text
    assert "r_sum" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["base_rollup", "micro_membership_rollup", "mun_ranking", "top_municipalities", "active_set_sum"])
def test_no_table_is_hinted_for_broadcast(large, name):
    assert "BroadcastHashJoin" not in plan(large, name)


@pytest.mark.parametrize("name", ["feature_values", "features_in_scope", "unit_labels", "kpi_livestock", "new_categories", "domain_categories_by_kind", "set_intersect_col"])
def test_facts_with_one_key_shrink_before_their_join(large, name):
    """Between the scan of the fact and its first join stands an aggregate."""
    lines = plan(large, name).splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and ("events.parquet" in line or "lineitem.parquet" in line))
    join = max(i for i, line in enumerate(lines[:scan]) if "Join" in line)
    assert any("HashAggregate" in line for line in lines[join:scan])


def test_dense_series_take_one_shuffle_after_the_joins(large):
    text = plan(large, "dense_series_mun_category")
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert sum("Exchange hashpartitioning" in line for line in lines[:join]) <= 2 and "ObjectHashAggregate" not in text


def test_ranks_need_no_checkpoint(large):
    assert "ExistingRDD" not in plan(large, "rank_position")


def test_membership_repeats_rows_only_after_the_first_roll_up(large):
    lines = plan(large, "micro_membership_rollup").splitlines()
    generate = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert sum("HashAggregate" in line for line in lines[generate:]) >= 2
    assert "Generate" not in "".join(line for line in lines if "SortMergeJoin" in line)


def test_wide_membership_needs_one_shuffle_after_the_joins(large):
    lines = plan(large, "mun_group_rollup").splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert sum("Exchange hashpartitioning" in line for line in lines[:join]) == 1


@pytest.mark.parametrize("span", [7, 21, 40, 200])
def test_series_aggregates_run_in_generated_code(spark, span):
    """However many years there are: wide lists are summed in blocks of years."""
    from municipia.operators import series

    years = list(range(1900, 1900 + span))
    df = spark.range(100).selectExpr("id % 7 AS mun", "'c' AS category", "CAST(1900 + id % 50 AS INT) AS year", "id AS a", "id AS p", "id AS v")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for made in (series.densify(df, ["mun", "category"], ["a", "p", "v"], years), series.pack_series(df, ["mun", "category"], ["a", "p", "v"], years)):
            lines = [x for x in made._jdf.queryExecution().executedPlan().toString().splitlines() if " HashAggregate(" in x]
            assert len(lines) >= 2 and all("*(" in x for x in lines), lines
            assert not made._jdf.queryExecution().executedPlan().toString().count("SortAggregate")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_crop_batch_shuffles_lines_and_base_rows_no_more_than_needed(large, tmp_path, monkeypatch):
    """Places join the orders, not the lines; the finest roll-up is written by the tasks that made it."""
    from municipia.plans import crop, roundtrips, standin

    lines = [x for x in roundtrips.crop_file_rows(large, FOLDER)._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin" in x]
    assert "l_orderkey" in lines[0] and any("o_custkey" in x for x in lines[1:])
    plans, whole = {}, crop.materialise

    def watched(df, path, *rest, **options):
        plans[path.rsplit("/", 1)[1]] = df._jdf.queryExecution().executedPlan().toString()
        return whole(df, path, *rest, **options)

    monkeypatch.setattr(crop, "materialise", watched)
    fact = "mun string, uf_file string, mic string, mic_name string, meso string, meso_name string, year int, category string, a double, p double, v double, r double, mun_name string"
    rows = [(f"35{n}", "SP", "m", "m", "x", "x", 2000 + n % 2, "Soja", 1.0, 2.0, 3.0, 4.0, "n") for n in range(6)]
    made = crop.crop_tables(large.createDataFrame(rows, fact), standin.category_groups(large, FOLDER), str(tmp_path))
    assert plans["base"].count("Exchange") == 1 and made.base.count() == 6
