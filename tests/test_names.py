"""Names looked up in an inverted index, against the either-way test on all pairs."""

import random

import pytest

from municipia.operators import classify, names
from municipia.plans import catalogue


def plain(text):
    return text.lower().replace("(", "").replace(")", "").strip()


def all_pairs(mine, theirs):
    return sorted({(a, b) for a in mine for b in theirs if a is not None and b is not None and (plain(a) in plain(b) or plain(b) in plain(a))})


def frames(spark, mine, theirs):
    return spark.createDataFrame([(x,) for x in mine], "category string"), spark.createDataFrame([(x,) for x in theirs], "target string")


@pytest.mark.parametrize("seed", range(3))
def test_any_names_against_all_pairs(spark, seed):
    draw = random.Random(seed)
    mine, theirs = ([None, *("".join(draw.choices("abÇ (", k=draw.randint(0, 9))) for _ in range(80))] for _ in range(2))
    got = names.matched_names(*frames(spark, mine, theirs)).collect()
    assert sorted((r.category, r.target) for r in got) == all_pairs(mine, theirs)


def test_short_empty_long_and_repeated_names(spark, rows):
    mine = ["", "x", "Xy", "xyz" * 20_000, "Milho (em grão)", "milho em grão", "Milho", None, "Milho", "🌽 milho"]
    theirs = ["()", "X", "(MILHO)", "grão", "zx", "nothing alike", None, "X", "xyz" * 20_001]
    assert rows(names.matched_names(*frames(spark, mine, theirs))) == sorted(all_pairs(mine, theirs), key=repr)
    assert names.matched_names(*frames(spark, [], theirs)).isEmpty() and names.matched_names(*frames(spark, mine, [])).isEmpty()


def test_columns_of_any_name(spark):
    mine, theirs = frames(spark, ["Soja"], ["soja (grão)"])
    got = names.matched_names(mine.toDF("gram"), theirs.toDF("short"), "gram", "short")
    assert [r.asDict() for r in got.collect()] == [{"gram": "Soja", "short": "soja (grão)"}]


def test_first_matches_equal_the_list_in_code(spark, rows):
    mine, theirs = frames(spark, ["red widget", "small gear", "gear", "ring", "blue bolt", "large ring"], catalogue.FLAG_TARGETS)
    assert rows(names.first_matches(mine, theirs).drop("matches")) == rows(classify.bootstrap_flag(mine, catalogue.FLAG_TARGETS))


def test_each_name_is_looked_up_under_one_rare_gram(spark):
    """A target whose other trigrams are in every name meets only the names that hold its rare one."""
    mine, theirs = frames(spark, [f"common words {i:04d}" for i in range(500)], ["common words 0123"])
    plan = names.matched_names(mine, theirs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "explode" in plan
    assert names.matched_names(mine, theirs).count() == 1
