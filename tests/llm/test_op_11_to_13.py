from __future__ import annotations

import hashlib
import math
import os
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import SF

from municipia.llm import bpe, codes, negatives, queries

VECTORS = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")
ODD_VECTORS = [(900, None, 1), (901, [NAN, 1.0, 0.0, 0.0], 1), (902, [INF, 0.0, 0.0, 0.0], 2), (903, [None, 1.0, 0.0, 0.0], 3), (904, [], 1), (905, [0.0] * 4, None)]


def usable(v) -> bool:
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


# 11: hard negatives


def brute_negatives(rows, every=50, positives=5, most=3, scale=256):
    items = sorted({(i, label, tuple(math.floor(scale * x) for x in v)) for i, v, label in rows if i is not None and label is not None and usable(v)})
    out = []
    for anchor in (r for r in items if r[0] % every == 0):
        scored = [(-sum(a * b for a, b in zip(anchor[2], r[2], strict=True)), r[0], r) for r in items if r != anchor and len(r[2]) == len(anchor[2])]
        scored.sort(key=lambda s: s[:2])
        for p, pid, _ in [s for s in scored if s[2][1] == anchor[1]][:positives]:
            fit = [s for s in scored if s[2][1] != anchor[1] and 50 * -p <= 100 * -s[0] <= 95 * -p][:most]
            out += [(anchor[0], pid, rank, nid, -p, -n) for rank, (n, nid, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, every=50, partitions=3):
    df = spark.createDataFrame(rows, VECTORS).repartition(partitions)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0).collect())


def crowd(n, labels, size, seed, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, size))
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        v = centres[label] * rng.choice([0.2, 1.0]) + rng.standard_normal(size)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v)], label))
    return rows + [(n + k, rows[0][1], rows[k % 7][2]) for k in range(copies)]


@pytest.mark.parametrize("rows", [crowd(400, 3, 12, 1), crowd(300, 2, 5, 2, copies=120), crowd(150, 40, 20, 3)], ids=["plain", "copies", "few of a label"])
def test_negatives_against_brute_force(spark, rows):
    want = brute_negatives(rows, every=10)
    assert want and mined(spark, rows, every=10) == want


def test_negatives_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 64)
    monkeypatch.setattr(negatives, "QUERIES", 16)
    monkeypatch.setattr(negatives, "TOGETHER", 8)
    rows = crowd(500, 3, 70, 4, copies=30)
    assert mined(spark, rows, every=7) == brute_negatives(rows, every=7)


def test_negatives_with_ties_and_odd_rows(spark):
    # Small whole components: many equal scores, zero and negative ones, repeated rows and ids, other sizes, long vectors.
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 4) / 256], int(rng.integers(3))) for i in range(160)]
    rows += rows[:5] + [(50, [1.0, 0.0, 0.0, 0.0], 0), (100, [0.0, 1.0, 1.0], 1), (101, [0.0, 1.0, 0.5], 1), (102, [0.0, 0.9, 0.5], 2), (None, [1.0, 1.0, 1.0, 1.0], 1)]
    rows += [(150, [3e5, 1.0, 2e5, 0.0], 1), (151, [3e5, 0.5, 2e5, 0.0], 1), (152, [2.5e5, 1.0, 1.5e5, 7.0], 2), *ODD_VECTORS]
    assert mined(spark, rows, every=10) == brute_negatives(rows, every=10)
    assert mined(spark, ODD_VECTORS) == [] and mined(spark, [(50, [1.0, 0.0], 1)]) == []
    clash = spark.createDataFrame(rows, VECTORS).withColumns({"row": F.lit(1), "block": F.lit(2), "score": F.lit("x")})
    assert sorted(tuple(r) for r in negatives.hard_negatives(clash, F.col("vec_id") % 10 == 0).collect()) == brute_negatives(rows, every=10)


def test_negatives_broadcast_nothing(spark, monkeypatch):
    """No join of any step goes through the driver, however small Spark takes its sides to be."""
    plans = []

    def planned(step):
        def seen(df):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return step(df)

        return seen

    for name in ("cut", "table"):
        monkeypatch.setattr(negatives, name, planned(getattr(negatives, name)))
    rows = crowd(120, 3, 8, 6)
    out = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0)
    planned(lambda df: None)(out)
    assert sum("SortMergeJoin" in p for p in plans) >= 6 and not any("Broadcast" in p for p in plans)
    assert sorted(tuple(r) for r in out.collect()) == brute_negatives(rows, every=10)


def test_files_of_the_index_hold_few_blocks(spark, monkeypatch):
    """A block is one large row, and Parquet's reader takes all rows of a file at once."""
    made, table = [], negatives.table
    monkeypatch.setattr(negatives, "BLOCK", 8)
    monkeypatch.setattr(negatives, "table", lambda df: made.append(table(df)) or made[-1])
    negatives.hard_negatives(spark.createDataFrame(crowd(480, 3, 8, 7), VECTORS), F.col("vec_id") % 240 == 0)
    files = [r["count"] for r in made[1].groupBy(F.input_file_name()).count().collect()]
    assert sum(files) >= 55 and max(files) <= 5


@given(st.integers(0, 10_000), st.integers(1, 40), st.integers(1, 30), st.integers(1, 20), st.floats(-1, 1))
@settings(max_examples=60, deadline=None)
def test_threshold_join_finds_all(seed, n, k, size, share):
    rng = np.random.default_rng(seed)
    x, q = rng.integers(-300, 300, (n, size)), rng.integers(-300, 300, (k, size))
    least = share * (q.astype(float) ** 2).sum(axis=1)
    got = {(int(i), int(j), int(v)) for i, j, value in negatives.joined(q, least, x, negatives.tails(x)) for i, j, v in zip(i, j, value, strict=True)}
    full = q @ x.T
    assert got == {(i, j, int(full[i, j])) for i in range(k) for j in range(n) if full[i, j] >= least[i]}


def test_threshold_join_omits_dimensions_and_prunes():
    """A list holds only rows whose remaining norm can still matter: with a high bar, rows without weight in front are in none."""
    x = np.zeros((2, 24), np.int64)
    x[0, :8], x[1, 16:] = 200, 3
    q = x[:1].copy()
    lists = negatives.tails(x)[:, :-1] * negatives.tails(q)[:, :-1].max(axis=0) >= 0.5 * (q**2).sum()
    assert lists.tolist() == [[True, False, False], [False, False, False]]
    assert [(int(i[0]), int(j[0])) for i, j, _ in negatives.joined(q, np.array([0.5 * (q**2).sum()]), x, negatives.tails(x))] == [(0, 0)]


# 12: byte-pair encoding


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))


TRICKY = [
    "", " ", "don't  I'LL we've '' 's", "<|endoftext|>", "a<|startoftext|>b<|STARTOFTEXT|><|endoftext|><|endoftext|>", "İstanbul ΣΑΣ ǅ ﬁ", "é Å ẛ̣",
    "x" * 20_000, "aAbB1234567890!?#$%^&*()", "漢字仮名 \U0001f600‍\U0001f525", "a b c　d\x1ce\x85f", "tab\tnul\x00\x0b\x0c", "՘࢏꟎", "1²३Ⅷ", "word " * 3_000, "'S 'Ll 'ſ",
]


@pytest.mark.parametrize("text", TRICKY, ids=range(len(TRICKY)))
def test_ids_are_the_librarys(library, text):
    words = bpe.vocabulary(bpe.VOCABULARY)
    ids = words.encode(text)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert words.decode(pa.array([ids], pa.list_(pa.int32()))).to_pylist() == [library.decode(ids.tolist(), skip_special_tokens=False)]


@given(st.text(max_size=200) | st.text("abcdeABC '0.<|>", max_size=300))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text_are_the_librarys(library, text):
    assert bpe.vocabulary(bpe.VOCABULARY).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_slices_and_memory_change_nothing(monkeypatch, library, corpus):
    texts = [r["text"] or "" for r in corpus.limit(60).collect()]
    monkeypatch.setattr(bpe, "SLICE", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "TOKENS", 100)
    words = bpe.vocabulary(bpe.VOCABULARY)
    words.known.clear()
    ids = [words.encode(t) for t in texts]
    assert len(words.known) <= 20 and [x.tolist() for x in ids] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    lists = pa.array([None, *ids, [], [10**6, 5]], pa.list_(pa.int32()))
    assert words.decode(lists).to_pylist() == [None, *(library.decode(x.tolist(), skip_special_tokens=False) for x in ids), "", words.strings[5].as_py()]
    assert words.decode(lists.slice(3, 4)).to_pylist() == words.decode(lists).to_pylist()[3:7]


def test_query_of_tokens(spark, library, corpus, odd):
    texts = {r["doc_id"]: r["text"] or "" for r in corpus.collect()}
    rows = queries.op12_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))
    made = odd.withColumn("ids", bpe.encoded(F.col("text"))).withColumn("again", bpe.decoded(F.col("ids"))).collect()
    assert len(made) == odd.count() and all(r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids for r in made)
    assert odd.limit(0).select(bpe.encoded(F.col("text"))).count() == 0


# 13: vector codes


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, v) for i, v, _ in rows if usable(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = -(-len(kept[0][1]) // parts) * parts
    whole = [[codes.whole(x) for x in v] + [0] * (width - len(v)) for _, v in kept if len(v) == len(kept[0][1])]
    step = width // parts
    cut = [[w[p * step : (p + 1) * step] for w in whole] for p in range(parts)]
    books = [[list(c) for c in points[:entries]] for points in cut]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [[min(range(len(b)), key=lambda e: (far(c, b[e]), e)) for c in points] for points, b in zip(cut, books, strict=True)]
    for _ in range(rounds):
        for points, chosen, book in zip(cut, assign(), books, strict=True):
            for e in range(len(book)):
                if mine := [c for c, x in zip(points, chosen, strict=True) if x == e]:
                    book[e] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    last = assign()
    out = [("".join(f"{last[p][i]:02x}" for p in range(parts)), sum(far(cut[p][i], books[p][last[p][i]]) for p in range(parts))) for i in range(len(whole))]
    return sorted(out), books


def check_codes(spark, rows, parts=4, entries=16, rounds=6, partitions=3):
    df = spark.createDataFrame(rows, VECTORS).repartition(partitions)
    found, books = codes.coded(df, parts=parts, entries=entries, rounds=rounds)
    want, want_books = brute_codes(rows, parts, entries, rounds)
    assert [b.tolist() for b in books] == want_books
    fitting = [(c, e if e < 10**38 else None) for c, e in want]
    assert sorted(((r["code"], r["error"]) for r in found.collect()), key=repr) == sorted(((c, None if e is None else Decimal(e)) for c, e in fitting), key=repr)


def test_codes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK", 100)  # several blocks in a task
    rows = crowd(700, 12, 16, 6, copies=90)
    check_codes(spark, rows)
    check_codes(spark, [*rows, *rows[:40], *ODD_VECTORS], parts=8, entries=5, rounds=3, partitions=7)


def test_codes_of_odd_rows(spark):
    ties = [(i, [float(i % 3), float(i % 2), 0.0], i % 2) for i in range(60)]
    check_codes(spark, [*ties, (None, [1.0, 1.0, 1.0], 3), (3, [9.0, 9.0, 9.0], None), (61, [1.0, 2.0], 1)], parts=2, entries=4)
    check_codes(spark, [(1, [1.0, 2.0], 1), (0, [1.0, 2.0], 1)], parts=2)  # fewer rows than entries, all equal
    check_codes(spark, [(i, [10.0 ** (i % 25), -(10.0 ** (i % 13)), 1.5, 1e300 if i == 7 else 0.1], 1) for i in range(50)], parts=2, entries=8)
    nothing, books = codes.coded(spark.createDataFrame(ODD_VECTORS[:5], VECTORS))
    assert nothing.count() == 0 and codes.books_text(books) == ""
    extra = spark.createDataFrame(ties, VECTORS).withColumns({"row": F.lit("r"), "rows": F.lit(1), "digits": F.lit(2)})
    found, _ = codes.coded(extra, parts=3, entries=4)
    assert found.count() == 60 and {r["row"] for r in found.collect()} == {"r"}
    with pytest.raises(ValueError):
        codes.coded(extra.withColumn("Code", F.lit(1)))


def test_errors_of_a_label(spark):
    rows = spark.createDataFrame([(1, "a", 5), (2, None, 7), (3, "a", 6), (4, None, None)], "id int, label string, error long").withColumn("error", F.col("error").cast("decimal(38,0)"))
    assert sorted((r["id"], r["t"]) for r in codes.with_group_error(rows, "label", "error", "t").collect()) == [(1, 11), (2, 7), (3, 11), (4, 7)]


@given(st.integers(0, 10_000), st.integers(1, 200), st.integers(1, 8), st.integers(1, 16))
@settings(max_examples=60, deadline=None)
def test_cover_tree(seed, n, size, entries):
    rng = np.random.default_rng(seed)
    points = rng.integers(-50, 50, (n, size)) * rng.choice([1, 1_000], (n, 1))
    tree, book = codes.cover_tree(points), rng.integers(-60, 60, (entries, size)) * rng.choice([1, 1_000], (entries, 1))
    assert (points[tree["row"]] == tree["points"]).all() and sorted(tree["row"].tolist()) == list(range(n))
    for i, (radius, count) in enumerate(zip(tree["radius"], tree["count"], strict=True)):
        mine = tree["points"][tree["begin"][i] : tree["begin"][i] + count]
        assert (mine.sum(axis=0) == tree["total"][i]).all() and np.sqrt(((mine - tree["centre"][i]) ** 2).sum(axis=1)).max() <= radius + 1e-9
        below = range(tree["child"][i], tree["child"][i + 1])
        assert not below or sum(tree["count"][c] for c in below) == count and all(tree["radius"][c] <= radius / 2 + 1e-9 for c in below)
    got = np.full(n, -1)
    for nodes, entry, loose in codes.settled(tree, book):
        for node, e in zip(nodes, entry[: len(nodes)], strict=False):
            got[tree["begin"][node] : tree["begin"][node] + tree["count"][node]] = e
        if len(loose):
            got[loose] = entry
    assert got.tolist() == codes.nearest(tree["points"], book)[0].tolist()
