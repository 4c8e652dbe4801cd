"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text. A window of a text that takes fewer bytes with the toxic
dictionary than with the ordinary one resembles toxic text. Both hold the same trained dictionary of ordinary text as a tail, and differ
in a small head: trained on the words that set toxic documents apart, or on more ordinary text. What both know cancels out, so a
difference comes from the heads. A document's differences are summed up in a few features and calibrated
to a probability on documents that no dictionary has seen.

Training takes a bounded sample of the labelled rows (``Bounds``), chosen by a hash of the id; every document is scored whole.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields, replace
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, STRIDE = 96, 72
TOXIC = 0.3  # the probability from which a document counts as toxic


@dataclass(frozen=True)
class Bounds:
    """What training may take: labelled documents of each class, and the longest text among them in characters."""

    toxic: int = 3_000
    ordinary: int = 6_000
    longest: int = 20_000


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the window threshold, and the calibration: mean, scale, weight of each feature, and the intercept."""

    toxic: bytes
    ordinary: bytes
    threshold: float
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    intercept: float


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


@lru_cache(maxsize=4)
def compressor(dictionary: bytes) -> zs.ZstdCompressor:
    setup = zs.ZstdCompressionParameters(
        window_log=17, chain_log=15, hash_log=15, search_log=5, min_match=3, target_length=64, strategy=zs.STRATEGY_BTLAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    data = zs.ZstdCompressionDict(dictionary, dict_type=zs.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(compression_params=setup)
    return zs.ZstdCompressor(dict_data=data, compression_params=setup)


def starts(n: int) -> np.ndarray:
    """Begins of the windows that cover ``n`` bytes; the last one ends with the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - WINDOW, STRIDE), n - WINDOW)


def normal(text: str | None) -> bytes:
    """Lower case, in UTF-8, filled up with spaces to a window's length; null counts as empty."""
    return (text or "").lower().encode("utf-8", "replace").ljust(WINDOW)


def differences(text: bytes, toxic: bytes, ordinary: bytes) -> np.ndarray:
    """Bytes that each window saves with the toxic dictionary; blocks of windows bound the memory for long texts."""
    at, out = starts(len(text)), []
    for block in range(0, len(at), 8_192):
        segments = np.empty((len(at[block : block + 8_192]), 2), np.uint64)
        segments[:, 0], segments[:, 1] = at[block : block + 8_192], WINDOW
        lengths = []
        for dictionary in (ordinary, toxic):
            packed = compressor(dictionary).multi_compress_to_buffer(zs.BufferWithSegments(text, segments.tobytes()), threads=0)
            lengths.append(np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(packed)))
        out.append(lengths[0] - lengths[1])
    return np.concatenate(out)


def features(d: np.ndarray, threshold: float) -> list[float]:
    top = np.zeros(3)
    best = np.sort(np.partition(d, len(d) - min(3, len(d)))[-3:])[::-1]
    top[: len(best)] = best
    return [top[0], top[0] + top[1], top.sum(), d.sum(), np.maximum(d - threshold, 0).sum(), np.log(len(d))]


def _trained(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the samples' last bytes where there are too few to train one."""
    try:
        return zs.train_dictionary(size, samples).as_bytes()
    except zs.ZstdError:
        return b" ".join(samples)[-size:]


def _distinct(texts: list[bytes]) -> list[bytes]:
    """One text of each group of near copies: texts that share their least word hash count as copies."""
    seen, kept = set(), []
    for t in texts:
        least = min((zlib.crc32(w) for w in set(t.split())), default=0)
        if least not in seen:
            seen.add(least)
            kept.append(t)
    return kept


def _grams(word: bytes, n: int = 5) -> list[bytes]:
    word = b" " + word + b" "
    return [word[i : i + n] for i in range(max(1, len(word) - n + 1))]


def _telling_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The words of toxic texts that hold a 5-gram at least ten times as frequent there, by documents, as in ordinary texts."""
    grams = lambda text: {g for w in set(text.split()) for g in _grams(w)}
    least, ratio = max(5, 0.01 * len(toxic)), 10 * len(toxic) / max(1, len(ordinary))
    here = {g: n for g, n in Counter(g for t in toxic for g in grams(t)).items() if n >= least}
    # Only grams that may be telling are counted in the many ordinary texts.
    there = Counter(g for t in ordinary for g in grams(t) if g in here)
    telling = {g for g, n in here.items() if n >= ratio * (there[g] + 0.5)}
    words = [w for t in toxic for w in t.split() if telling.intersection(_grams(w))]
    return words or [w for t in toxic for w in t.split()]


def fit(train: list[tuple[str, int]], calibrate: list[tuple[str, int]], tail: int = 16_384, head: int = 1_536, seed: int = 0) -> Model | None:
    """Dictionaries from ``train``, calibration from ``calibrate``: lists of (text, 0 or 1). None if either lacks a class."""
    split = lambda rows, y: [normal(t) for t, label in rows if label == y]
    if any(not split(rows, y) for rows in (train, calibrate) for y in (0, 1)):
        return None
    toxic, ordinary = _distinct(split(train, 1)), _distinct(split(train, 0))
    rng = np.random.default_rng(seed)

    def mixed(items: list[bytes], most: int) -> list[bytes]:
        return [items[i] for i in rng.permutation(len(items))[:most]]

    ends = np.cumsum([max(1, (len(t) - 16) // 16) for t in ordinary])

    def windows(most: int) -> list[bytes]:
        """Windows of 32 bytes, 16 apart, drawn from all ordinary texts."""
        drawn = rng.permutation(int(ends[-1]))[:most]
        texts = np.searchsorted(ends, drawn, "right")
        return [ordinary[t][16 * s : 16 * s + 32] for t, s in zip(texts.tolist(), (drawn - np.append(0, ends)[texts]).tolist(), strict=True)]

    words = mixed(_telling_words(toxic, ordinary), 1 << 20)
    phrases = [b" " + b"  ".join(words[i : i + 6]) + b" " for i in range(0, len(words), 6)]
    shared = _trained(windows(60_000), tail)
    toxic_bytes, ordinary_bytes = _trained(phrases, head) + shared, _trained(windows(60_000), head) + shared
    saved = [(differences(normal(t), toxic_bytes, ordinary_bytes), y) for t, y in calibrate]
    threshold = float(np.quantile(np.concatenate([d for d, y in saved if y == 0]), 0.99))
    x = np.array([features(d, threshold) for d, _ in saved])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weights, intercept = _logistic((x - mean) / scale, np.array([y for _, y in saved], float))
    return Model(toxic_bytes, ordinary_bytes, threshold, tuple(mean), tuple(scale), tuple(weights), intercept)


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Newton's method for logistic regression with a small ridge."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x1.shape[1]), np.diag([penalty] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + ridge, x1.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def probability(model: Model, text: str | None) -> float:
    z = np.array(features(differences(normal(text), model.toxic, model.ordinary), model.threshold))
    z = float((z - np.array(model.mean)) / np.array(model.scale) @ np.array(model.weights) + model.intercept)
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


FITTED = (
    "ordinary_taken long, toxic_taken long, toxic binary, ordinary binary, threshold double, "
    "mean array<double>, scale array<double>, weights array<double>, intercept double"
)


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """FITTED: the numbers of rows and the model of all rows (doc_id, text, toxic, _part); no row without a model."""
    rows = sorted((r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True)), key=lambda r: r[:2])
    pick = lambda *parts: [(text, toxic) for _, text, toxic, part in rows if part in parts]
    model, taken = fit(pick(0, 1), pick(3)), Counter(r[2] for r in rows)
    if model is not None:
        values = [taken[0], taken[1], *(getattr(model, f.name) for f in fields(Model))]
        plain = [[float(y) for y in x] if isinstance(x, tuple) else x for x in values]
        names = [f.split()[0] for f in FITTED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in plain], names)


def train_model(docs: DataFrame, labels: DataFrame, bounds: Bounds | None = None) -> Model | None:
    """Fit on labelled rows outside the held-out part. Ids are chosen from ``labels`` alone; only the chosen texts reach the task that fits,
    and the driver gets no text.

    Dictionaries learn from the rows whose id's checksum leaves 0 or 1 when divided by 4, calibration from those that leave 3.
    Labels other than 0 and 1 and null ids are passed over.
    """
    bounds = bounds or Bounds()
    known = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = lambda y, n: known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = F.broadcast(some(1, bounds.toxic).unionAll(some(0, bounds.ordinary)))  # at most bounds.toxic + bounds.ordinary ids
    texts = docs.select("doc_id", "text").filter(F.length("text") <= bounds.longest).join(chosen, "doc_id")
    rows = texts.withColumn("_part", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4).select("doc_id", "text", "toxic", "_part")
    found = rows.repartition(1).mapInArrow(_fitted, FITTED).first()  # the rows are bounded by ``bounds``
    if found is None:
        return None
    *taken, model = found["ordinary_taken"], found["toxic_taken"], Model(*(tuple(x) if isinstance(x, list) else bytes(x) if isinstance(x, bytearray) else x for x in found[2:]))
    # The classes are sampled at different rates; a probability has to follow their true shares.
    labelled = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    return replace(model, intercept=model.intercept + math.log(labelled[1] / taken[1]) - math.log(labelled[0] / taken[0]))


def with_score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic in ``out``; a column of that name is replaced.

    Null and empty texts get the score of a blank window. Without a model (a class has no labelled row) every score is 0.
    """
    if model is None:
        return docs.withColumn(out, F.lit(0.0))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: probability(model, t)).astype("float64")

    return docs.withColumn(out, score(F.col(text)))
