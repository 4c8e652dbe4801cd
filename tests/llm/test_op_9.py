from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import ODD_TEXTS, SF

from municipia.llm import queries, repeats


def plain_removal(texts):
    """{doc: (removed spans, kept bytes)}: every string is looked up among all earlier ones."""
    seen, out = set(), {}
    for doc in sorted(texts):
        data = (texts[doc] or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            part = data[s : s + 100]
            if part in seen:
                gone[s : s + 100] = True
            seen.add(part)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0])))).tolist()
        out[doc] = list(zip(edges[::2], edges[1::2], strict=True)), bytes(np.frombuffer(data, np.uint8)[~gone])
    return out


def check(df, texts):
    got = {r["doc_id"]: ([(s["begin"], s["end"]) for s in r["removed"]], bytes(r["kept"])) for r in repeats.without_repeats(df).collect()}
    assert got == plain_removal(texts)


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=3_000), st.integers(0, 3))
def test_anchors_cover_every_start_and_follow_the_content(data, letters):
    data = bytes(b % (letters + 1) for b in data) if letters else data
    start, count, anchor = repeats.anchors(data)
    covered = [s + i for s, c in zip(start.tolist(), count.tolist(), strict=True) for i in range(c)]
    assert covered == list(range(max(0, len(data) - 99))) and (len(count) == 0 or count.max() <= 77)
    alone = {}
    for s, c, a in zip(start.tolist(), count.tolist(), anchor.tolist(), strict=True):
        for i in range(s, s + c, 7):
            one = repeats.anchors(data[i : i + 100])
            assert one[2][0] == a and alone.setdefault(data[i : i + 100], a) == a


@pytest.mark.parametrize("hot", [4_096, 1])
def test_planted_repeats(docs_of, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "BLOCK", 700)
    rng = np.random.default_rng(4)
    noise = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    shared, line = noise(400), noise(105)
    texts = {}
    for i in range(40):
        parts = [noise(int(rng.integers(0, 900)))]
        if i % 3 == 0:
            parts.append(shared[int(rng.integers(0, 200)) :])
        parts += [line, noise(30)] * (i % 4)
        parts.append(noise(50))
        texts[int(rng.integers(0, 10_000))] = "".join(parts)
    ids = sorted(texts)
    texts |= {ids[-1] + 1: texts[ids[0]], ids[-1] + 2: texts[ids[0]], ids[-1] + 3: "ab" * 600, ids[-1] + 4: "x" * 99, ids[-1] + 5: texts[ids[3]][10:]}
    check(docs_of(list(texts.items())), texts)


def test_repeats_query(spark, corpus):
    texts = {r["doc_id"]: r["text"] for r in corpus.collect()}
    want = plain_removal(texts)
    rows = queries.op9_repeats(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len((texts[r["doc_id"]] or "").encode()), sum(b - a for a, b in spans), len(spans))
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_repeats_of_odd_rows(docs_of, odd):
    check(docs_of(list(enumerate(ODD_TEXTS))), dict(enumerate(ODD_TEXTS)))
    rows = repeats.without_repeats(odd).collect()
    assert len(rows) == odd.count() and all(bytes(r["kept"]) in (b"no id", b"") for r in rows if r["doc_id"] is None)
    twice = docs_of([(1, "q" * 100 + "w" * 100), (1, "q" * 100 + "w" * 100), (None, "q" * 100)])
    assert sum(len(r["removed"]) for r in repeats.without_repeats(twice).collect()) == 0
    assert repeats.without_repeats(odd.limit(0)).count() == 0
