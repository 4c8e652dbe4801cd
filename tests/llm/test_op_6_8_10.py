from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import SF
from tests.oracle_check import compare, connect

from municipia.llm import mixing, queries, sharding, vectors

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert compare(spark, connect(SF), SF, name) is None


# 6: sharding


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1_000])
def test_permutation_is_one_to_one(spark, n):
    for key in (1, 2):
        places = [r[0] for r in spark.range(n).select(F.expr(sharding.permuted_sql("id", n, key))).collect()]
        assert sorted(places) == list(range(n))
        assert n < 64 or places != list(range(n))


def test_shards_are_even_gapless_and_reproducible(spark, corpus):
    rows = queries.op6_shards(spark, SF).collect()
    want = {r["doc_id"]: r["text"] or "" for r in corpus.collect()}
    import zlib

    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in want.items()}
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s])) for s in counts)
    narrow = corpus.select("doc_id")
    one, two = (sharding.shard_rows(df, 5).collect() for df in (narrow.repartition(3), narrow.repartition(7)))
    assert sorted(one) == sorted(two)


def test_shards_of_odd_rows(spark, odd):
    rows = sharding.shard_rows(odd, 3).collect()
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == odd.count() == len({(r["shard"], r["slot"]) for r in rows}) and max(counts.values()) - min(counts.values()) <= 1
    assert sorted(r["row_number"] for r in rows) == list(range(len(rows)))
    copies = sharding.shard_rows(spark.range(900).selectExpr("1 AS same"), 8).collect()
    assert sorted(r["row_number"] for r in copies) == list(range(900))
    assert sharding.shard_rows(odd.limit(0), 3).count() == 0
    with pytest.raises(ValueError):
        sharding.shard_rows(odd.withColumn("Slot", F.lit(1)), 3)


# 8: vectors


def plain_links(rows, least=0.93):
    usable = [(i, np.asarray(v, np.float64), label) for i, v, label in rows if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {}
    for n, (i, v, label) in enumerate(usable):
        for j, w, other in usable[n + 1 :]:
            if label == other and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links.setdefault(i, set()).add(j)
                links.setdefault(j, set()).add(i)
    out = {}
    for i, *_ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(links.get(i, ())), min(seen) if i is not None else None)
    return out


def crowd(centres=6, each=50, loners=200, size=24, seed=3):
    rng = np.random.default_rng(seed)
    rows = [c + rng.normal(0, s, (each, size)) for s in np.linspace(0.01, 0.25, centres) for c in [rng.normal(0, 1, size)]]
    rows = np.concatenate([*rows, rng.normal(0, 1, (loners, size))]).astype(np.float32)
    return [(int(i) * 3, [float(x) for x in v], int(rng.integers(0, 2)) if n >= centres * each else 0) for n, (i, v) in enumerate(zip(rng.permutation(len(rows)), rows, strict=True))]


def test_vectors_recall_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = crowd()
    want = plain_links(rows)
    got = {r["vec_id"]: r for r in vectors.near_vectors(spark.createDataFrame(rows, VECTORS)).collect()}
    assert set(got) == set(want) and all(got[i]["n_links"] <= want[i][0] for i in want)
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert sum(got[i]["component_id"] == c for i, (_, c) in want.items()) >= 0.97 * len(want)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_vectors_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (5, v, 1), (3, v, 1), (3, v, 1), (9, [2.0, 4.0, 6.01], 1), (1, v, 2), (2, None, 1), (4, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 3.0], 1), (7, [float("nan")] * 3, 1),
        (8, [float("inf"), 1.0, 1.0], 1), (10, [], 1), (11, v, None), (12, [1.0, 2.0], 1), (None, v, 1), (13, [-1.0, -2.0, -3.0], 1),
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumn("rep", F.lit(1)).withColumn("component", F.lit("x"))
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df).collect()), key=str)
    linked = [(3, 3, 3, True), (3, 3, 3, True), (5, 3, 3, False), (9, 3, 3, False)]
    alone = [(i, 0, i, True) for i in (1, 2, 4, 6, 7, 8, 10, 11, 12, 13)]
    assert got == sorted([*linked, *alone, (None, 0, None, False)], key=str)
    assert vectors.near_vectors(df.limit(0)).count() == 0


# 10: mixing


def plain_targets(sizes, share=1.5, most=2.0):
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    open_, target, left = set(sizes), {}, share * sum(sizes.values())
    while True:
        unit = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if unit * weights[s] > most * sizes[s]}
        if not over:
            return target | {s: unit * weights[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over


def test_mix_meets_its_targets(spark, corpus):
    rows = queries.op10_mixing(spark, SF).collect()
    assert sorted(rows) == sorted(queries.op10_mixing(spark, SF).collect())
    sources = {r["doc_id"]: r["source"] for r in corpus.collect()}
    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in corpus.collect()}
    by_source, taken = Counter(), Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source[sources[r["doc_id"]]] += r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
    want = plain_targets(by_source)
    for r in rows:
        assert r["target"] == pytest.approx(want[sources[r["doc_id"]]]) and r["source_size"] == by_source[sources[r["doc_id"]]]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want) and sum(sizes.values()) > 0


def test_due_times_invert_the_schedule(spark):
    for slope in mixing.SLOPES:
        rows = spark.range(101).select((F.col("id") / 100).alias("u")).select("u", mixing.due_time(F.col("u"), F.lit(slope)).alias("t")).collect()
        assert all(r["t"] + slope * (r["t"] - r["t"] ** 2) == pytest.approx(r["u"], abs=1e-12) for r in rows)
        assert [r["t"] for r in rows] == sorted(r["t"] for r in rows)


def test_mixed_documents_come_in_training_order(spark, corpus):
    mixed = mixing.mix_documents(corpus)
    assert mixed.columns == corpus.columns
    rows, texts = mixed.collect(), {r["doc_id"]: r["text"] for r in corpus.collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in rows)
    plan = {r["doc_id"]: r["taken"] // r["size"] for r in queries.op10_mixing(spark, SF).collect() if r["size"]}
    counts = Counter(r["doc_id"] for r in rows)
    assert all(abs(counts[i] - n) <= 1 for i, n in plan.items()) and max(counts.values()) == 2
    half = len(rows) // 2
    falling = {r["source"] for r in corpus.select("source").distinct().collect()}
    falling = {s for i, s in enumerate(sorted(falling)) if i % 3 == 0}
    first, last = (sum(len(r["text"].split()) for r in part if r["source"] in falling) for part in (rows[:half], rows[half:]))
    assert first > last


def test_mix_of_odd_rows(spark, odd):
    sized = odd.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    plan = mixing.plan_mix(sized, ["doc_id"]).collect()
    assert len(plan) == odd.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in plan)
    got = mixing.mix_documents(odd.withColumn("size", F.lit("clash")).withColumn("_copy", F.lit(1))).collect()
    assert {r["text"] for r in got} <= {r["text"] for r in odd.collect()}
    assert mixing.plan_mix(sized.limit(0), ["doc_id"]).count() == 0 and mixing.mix_documents(odd.limit(0)).count() == 0
    tied = spark.range(300).selectExpr("1L AS doc_id", "'s' AS source", "3L AS size")
    assert sum(r["taken"] for r in mixing.plan_mix(tied, ["doc_id"]).collect()) == 1_350


def test_mix_keeps_rows_that_differ_anywhere(spark):
    """One id and text under two languages, one with a nested column that differs, and a null beside an empty value."""
    rows = [(1, "a b c", "s", "en", [1]), (1, "a b c", "s", "pt", [1]), (1, "a b c", "s", "pt", [None]), (1, "a b c", "s", None, [1]), (1, "a b c", "s", "", [1]), (1, "a b c", "s", "en", [1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _text string, _at array<int>").withColumn("_time", F.lit(5)).withColumn("_ROW", F.lit("x"))
    got = Counter((r["_text"], tuple(r["_at"])) for r in mixing.mix_documents(docs).collect())
    # 18 words, 27 are taken: nine passes; which rows come twice follows from their hashes.
    assert sum(got.values()) == 9 and set(got) == {(r[3], tuple(r[4])) for r in rows}
    assert all(n <= 2 * sum((r[3], tuple(r[4])) == k for r in rows) for k, n in got.items())


def test_positions_follow_due_times_without_gaps(spark, corpus):
    sized = corpus.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    plan = mixing.plan_mix(sized, ["doc_id"]).collect()
    passes = sorted((p["time"], r["doc_id"], r["source"], r["copy"], p["words"]) for r in plan for p in r["passes"])
    begins, at = {}, 0
    for _, doc, source, copy, words in passes:
        begins.setdefault((doc, source, copy), []).append(at)
        at += words
    got = mixing.with_positions(mixing.plan_mix(sized, ["doc_id"]), ["doc_id"]).collect()
    assert len(got) == len(plan) and sum(r["n_passes"] for r in got) == len(passes)
    for r in got:
        want = begins.get((r["doc_id"], r["source"], r["copy"]))
        assert (r["first_position"], r["last_position"]) == ((want[0], want[-1]) if want else (None, None))
