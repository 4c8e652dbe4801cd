"""Every stage of the pipeline on the small tables, against its brute-force version."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from tests.llm.conftest import DOCS, SF
from tests.llm.test_op_1_to_5 import check_pieces, plain_components, plain_fingerprint

import corpus_pipeline
from municipia.llm import mixing, pii, queries, toxicity


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """The rows of every stage, written and read again."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), corpus, {"documents": corpus}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return out


def test_stages_keep_the_columns_of_documents(stages, corpus):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "pii", "mixing", "packing"]
    for name in names[:-1]:
        assert dict(stages[name].dtypes) == dict(corpus.dtypes)


def test_toxic_documents_go(spark, stages):
    model = toxicity.train_model(stages["documents"], spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r["doc_id"] for r in stages["documents"].collect() if toxicity.probability(model, r["text"]) < corpus_pipeline.REJECTED}
    assert {r["doc_id"] for r in stages["toxicity"].collect()} == want


def test_the_stage_rejects_what_the_query_predicts(spark, stages):
    toxic = {r["doc_id"] for r in queries.op1_toxicity(spark, SF).collect() if r["predicted"]}
    left = {r["doc_id"] for r in stages["toxicity"].collect()}
    assert toxic and not toxic & left and toxic | left == {r["doc_id"] for r in stages["documents"].collect()}


def test_one_document_of_each_group_stays(stages):
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in stages["toxicity"].collect()}
    groups = plain_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert sorted(r["doc_id"] for r in stages["near_duplicates"].collect()) == sorted(set(groups.values()))


def test_private_values_are_replaced_and_other_text_stays(stages):
    before, after = ({r["doc_id"]: r for r in stages[s].collect()} for s in ("near_duplicates", "pii"))
    want = {r["doc_id"]: r["text"] for r in pii.pseudonymised(stages["near_duplicates"]).collect()}
    assert set(before) == set(after) and {i: r["text"] for i, r in after.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    assert sum(before[i]["text"] != after[i]["text"] for i in after) > 0
    assert all(before[i]["text"] == after[i]["text"] for i in after if not set("0123456789@") & set(before[i]["text"]))


def test_mix_follows_the_plan(stages):
    docs = stages["pii"].withColumn("row", mixing.row_digest(stages["pii"])).withColumn("size", mixing.word_count(F.col("text")))
    ids = {r["row"]: r["doc_id"] for r in docs.collect()}
    plan = mixing.plan_mix(docs.select("row", "source", "size"), ["row"]).collect()
    want = Counter()
    for r in plan:
        want[ids[r["row"]]] += sum(p["words"] == r["size"] for p in r["passes"])
    assert Counter(r["doc_id"] for r in stages["mixing"].collect()) == +want


def test_every_token_is_packed_once(stages):
    mixed = stages["mixing"].collect()
    rows = [r.asDict() for r in stages["packing"].collect()]
    copies = Counter(r["doc_id"] for r in mixed)
    texts = {r["doc_id"]: r["text"] for r in mixed}
    # A document taken twice has each of its pieces' tokens twice, cut wherever the sequences end: its pieces are dealt to its copies by their places.
    dealt, open_ = [], {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"], r["length"])):
        ends = open_.setdefault(r["doc_id"], [0] * copies[r["doc_id"]])
        copy = ends.index(r["start"])
        ends[copy] += r["length"]
        dealt.append(r | {"doc_id": (r["doc_id"], copy)})
    sequences, tokens = check_pieces(dealt, {(i, n): texts[i] for i, many in copies.items() for n in range(many)})
    assert tokens >= 1024 * (sequences - 8)


def test_odd_rows_and_empty_tables_pass_every_stage(spark, odd):
    clashing = odd.withColumn("score", F.lit(1)).withColumn("component", F.lit("x")).withColumn("_text", F.lit("y")).withColumn("start", F.lit(2))
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, spark.createDataFrame([], DOCS), clashing):
            got, rows = stage(spark, docs, SF), docs.collect()
            if name == "packing":
                # Of each row, the pieces that begin a document: a null id is kept, and so is every repeated row.
                assert Counter(r["doc_id"] for r in got.collect() if r["start"] == 0) == Counter(r["doc_id"] for r in rows)
                continue
            assert got.columns == docs.columns
            ids, had = Counter(r["doc_id"] for r in got.collect()), Counter(r["doc_id"] for r in rows)
            if name == "pii":
                assert ids == had
            elif name == "toxicity":
                assert not ids - had and all(n == had[i] for i, n in ids.items()) and (not rows or ids)
            elif name == "near_duplicates":
                # Null and empty texts (0 to 2) have one fingerprint, equal texts (7, 8) another; rows that repeat an id are one document.
                assert ids[None] == had[None] and all(n == 1 for i, n in ids.items() if i is not None)
                assert not rows or (0 in ids and 7 in ids and not {1, 2, 8} & set(ids))
            else:
                assert not set(ids) - set(had) and all(n <= 2 * had[i] for i, n in ids.items()) and (not rows or ids)
                assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in rows}


def test_of_different_rows_under_one_id_the_same_one_stays(spark):
    docs = spark.createDataFrame([(1, f"text number {n} of its own kind", "en", "s", n) for n in range(40)] + [(2, "something else altogether here", "pt", "s", 1)], DOCS)
    got = [sorted(map(tuple, corpus_pipeline.simhash_stage(spark, docs.repartition(n), SF).collect())) for n in (1, 3, 7)]
    assert got[0] == got[1] == got[2] and len({r[0] for r in got[0]}) == len(got[0])
