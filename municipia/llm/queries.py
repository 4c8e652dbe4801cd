"""The queries of the operators over the given tables, with production parameters."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from municipia.llm import bpe, codes, media, mixing, negatives, packing, passages, pii, repeats, sharding, simhash, toxicity, vectors
from municipia.llm.common import read, unsigned_crc32


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train_model(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, count="n_replaced")


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    seen = media.with_read_back(media.with_media(docs), out="probe")
    ranges = F.crc32(F.concat_ws(",", "probe.keyframe_offsets", "probe.keyframe_sizes").cast("binary"))
    feature = F.concat_ws("|", "probe.codec", "probe.width", "probe.height", "probe.timescale", "probe.duration", "probe.samples", F.size("probe.keyframe_offsets"), ranges)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    digests = [f"probe.{field.split()[0]}" for field in media.DIGESTS.split(", ")]
    stored = ["probe.codec", "probe.timescale", "probe.duration", "probe.keyframe_offsets", "probe.keyframe_sizes"]
    return seen.select("doc_id", n_bytes.alias("n_bytes"), *digests, feature.alias("feature"), *stored)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"), unsigned_crc32(F.col("text")).alias("text_crc32"))
    placed = sharding.shard_rows(rows, 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(read(spark, sf_dir, "documents"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = repeats.without_repeats(read(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    plan = mixing.with_positions(mixing.plan_mix(docs, ["doc_id"]), ["doc_id"])
    return plan.select("doc_id", "size", "source_size", "target", "taken", "n_passes", "first_position", "last_position")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", bpe.round_trip(F.col("text")).alias("t"))
    digits = F.array_join(F.col("t.ids").cast("array<string>"), " ")
    return docs.select("doc_id", F.size("t.ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"), F.sha2("t.decoded", 256).alias("decoded_sha256"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors_ = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    found, books = codes.coded(vectors_)
    summed = codes.with_group_error(found.drop("embedding"), "label", "error", "label_error")
    digest = hashlib.sha256(codes.books_text(books).encode()).hexdigest()
    return summed.select("vec_id", "code", F.expr("try_cast(error AS bigint)").alias("error"), F.expr("try_cast(label_error AS bigint)").alias("label_error"), F.lit(digest).alias("codebooks_sha256"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_pseudonyms": op3_pseudonyms,
    "op4_media": op4_media,
    "op5_packing": op5_packing,
    "op6_shards": op6_shards,
    "op7_passages": op7_passages,
    "op8_vectors": op8_vectors,
    "op9_repeats": op9_repeats,
    "op10_mixing": op10_mixing,
    "op11_negatives": op11_negatives,
    "op12_bpe": op12_bpe,
    "op13_codes": op13_codes,
}

def _codes_sql(rounds: int = codes.ROUNDS) -> str:
    """Lloyd's rounds written out one after the other, over components as rows."""
    nearest = """
dist{n} AS (SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS far FROM points p JOIN book{n} b USING (part, place) GROUP BY ALL),
near{n} AS (SELECT vec_id, part, entry, far FROM dist{n} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) = 1)"""
    moved = """
sums{n} AS (SELECT p.part, n.entry, p.place, sum(p.x) AS s, count(*) AS c FROM points p JOIN near{n} n USING (vec_id, part) GROUP BY ALL),
book{m} AS (SELECT b.part, b.entry, b.place, CASE WHEN c IS NULL THEN b.x ELSE (s - ((s % c) + c) % c) // c END AS x FROM book{n} b LEFT JOIN sums{n} USING (part, entry, place))"""
    steps = [nearest.format(n=n) + "," + moved.format(n=n, m=n + 1) for n in range(rounds)] + [nearest.format(n=rounds)]
    return f"""
WITH kept AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), points AS (
    SELECT vec_id, (i - 1) // (len(v) // 8) AS part, (i - 1) % (len(v) // 8) AS place, floor(4096 * v[i])::HUGEINT AS x FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept)
), firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 16),
book0 AS (SELECT part, entry, place, x FROM points JOIN firsts USING (vec_id)),{",".join(steps)},
codes AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
digest AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM codes JOIN kept USING (vec_id) CROSS JOIN digest
"""


ORACLES = {
    "op8_vectors": """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
    SELECT vec_id AS id, vec_id AS other FROM usable UNION SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other
), groups AS (SELECT id, min(other) AS least FROM reach GROUP BY id)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links, coalesce(g.least, e.vec_id) AS component_id,
    coalesce(e.vec_id = coalesce(g.least, e.vec_id), false) AS kept
FROM embeddings e LEFT JOIN groups g ON g.id = e.vec_id
""",
    "op10_mixing": """
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM sizes),
weighted AS (SELECT *, [3, 1, 2][r % 3 + 1] AS w, [0.5::DOUBLE, 0::DOUBLE, -0.5::DOUBLE][r % 3 + 1] AS slope, 1.5::DOUBLE * sum(source_size) OVER () AS demand FROM ranked),
judged AS (
    SELECT *, (demand - 2.0::DOUBLE * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * w
        > 2.0::DOUBLE * source_size * sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS is_full
    FROM weighted WINDOW o AS (ORDER BY source_size::DOUBLE / w, r)
),
targets AS (
    SELECT source, source_size, slope, CASE WHEN is_full THEN 2.0::DOUBLE * source_size
        ELSE (demand - 2.0::DOUBLE * coalesce(sum(source_size) FILTER (WHERE is_full) OVER (), 0)) / (sum(w) FILTER (WHERE NOT is_full) OVER ()) * w END AS target
    FROM judged
), goals AS (SELECT *, floor(target + 0.5)::BIGINT AS goal FROM targets),
hashed AS (
    SELECT d.*, source_size, target, goal, slope, md5('7|' || doc_id) AS h,
        ('0x' || substr(md5('7|' || doc_id), 1, 8))::BIGINT % greatest(1024, (count(*) OVER () + 65535) // 65536) AS bucket
    FROM docs d JOIN goals t ON d.source IS NOT DISTINCT FROM t.source
), placed AS (
    SELECT *, row_number() OVER (ORDER BY source, bucket, h, doc_id, size) AS n,
        coalesce(sum(size) OVER (PARTITION BY source ORDER BY bucket, h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins,
        CASE WHEN source_size > 0 THEN goal // source_size ELSE 0 END AS rounds FROM hashed
), parts AS (
    SELECT n, doc_id, source, slope, (r * source_size + begins)::DOUBLE / greatest(goal, 1) AS u, greatest(0, least(size, goal - r * source_size - begins)) AS words
    FROM (SELECT *, unnest(range(0, rounds + 1)) AS r FROM placed)
), due AS (
    SELECT *, CASE WHEN slope = 0 THEN u ELSE (1 + slope - sqrt((1 + slope) * (1 + slope) - 4 * slope * u)) / (2 * slope) END AS time FROM parts WHERE words > 0
), ordered AS (
    SELECT n, coalesce(sum(words) OVER (ORDER BY time, doc_id NULLS FIRST, source NULLS FIRST, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS position FROM due
), ends AS (SELECT n, count(*) AS passes, min(position) AS first_position, max(position) AS last_position FROM ordered GROUP BY n)
SELECT doc_id, size, source_size, target, (rounds * size + greatest(0, least(size, goal - rounds * source_size - begins)))::BIGINT AS taken,
    coalesce(passes, 0)::INTEGER AS n_passes, first_position, last_position
FROM placed LEFT JOIN ends USING (n)
""",
    "op11_negatives": """
WITH items AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS other_id, b.label AS other_label, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM items a JOIN items b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS n FROM scored WHERE anchor_label = other_label
), found AS (
    SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
    FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND s.other_label <> s.anchor_label AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
    WHERE p.n <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 3
""",
    "op13_codes": _codes_sql(),
}
