"""Years, days and keys come from the data: tables with values that the given ones lack, against the same SQL."""

import pandas as pd
import pytest

from municipia.operators import series
from municipia.plans import standin
from tests.oracle_check import compare, connect

SOURCE = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def odd_folder(tmp_path_factory):
    """The tables with an order of 1971 and one of 2030 and an event of day 31 of a new type."""
    folder = tmp_path_factory.mktemp("odd")
    frames = {name: pd.read_parquet(f"{SOURCE}/{name}.parquet") for name in TABLES}
    orders, lines, events = frames["orders"], frames["lineitem"], frames["events"]
    more, lines_more = orders.head(2).copy(), lines.head(2).copy()
    more["o_orderkey"] = lines_more["l_orderkey"] = [10**9, 10**9 + 1]
    more["o_orderdate"] = [pd.Timestamp(1971, 5, 1), pd.Timestamp(2030, 5, 1)]
    late = events.head(1).copy()
    late["event_type"], late["ts"] = "barter", pd.Timestamp(2024, 1, 31)
    frames |= {"orders": pd.concat([orders, more.astype(orders.dtypes)]), "lineitem": pd.concat([lines, lines_more]), "events": pd.concat([events, late.astype(events.dtypes)])}
    for name, frame in frames.items():
        frame.to_parquet(folder / f"{name}.parquet", index=False)
    return str(folder)


@pytest.mark.parametrize("name", [
    "packed_series", "dense_series_mun_category", "dense_series_state", "series_national", "series_by_scope", "value_at_year",
    "nested_package", "domain_years", "missing_slices", "series_state_from_mun", "yield_series",
])
def test_no_year_or_day_is_left_out(spark, odd_folder, name):
    with connect(odd_folder) as duck:
        assert compare(spark, duck, odd_folder, name) is None


def test_years_of_the_orders(spark, odd_folder):
    years = standin.years(spark, odd_folder)
    assert years[0] == 1971 and years[-1] == 2030


def test_rows_outside_a_callers_list_are_reported(spark, rows):
    df = spark.createDataFrame([("x", 1994), ("x", 1995), ("y", 1994), ("y", None)], "k string, year int")
    assert rows(series.outside_years(df, [1995, 1996])) == [(1994, 2), (None, 1)]
    assert series.outside_years(df.where("year = 1995"), [1995]).count() == 0


def test_given_tables_keep_the_declared_constraints(spark):
    """Every line item has its part and order, every order its customer and nation; amounts have two decimals at most."""
    t = {name: standin.table(spark, SOURCE, name) for name in TABLES}
    assert t["lineitem"].join(t["orders"], t["lineitem"].l_orderkey == t["orders"].o_orderkey, "left_anti").count() == 0
    assert t["lineitem"].join(t["part"], t["lineitem"].l_partkey == t["part"].p_partkey, "left_anti").count() == 0
    assert t["orders"].join(t["customer"], t["orders"].o_custkey == t["customer"].c_custkey, "left_anti").count() == 0
    assert t["customer"].join(t["nation"], t["customer"].c_nationkey == t["nation"].n_nationkey, "left_anti").count() == 0
    assert t["lineitem"].where("round(l_extendedprice, 2) <> l_extendedprice OR round(l_discount, 2) <> l_discount").count() == 0
