"""Packing documents into token sequences along a space-filling curve.

A document's bytes are hashed, three at a time, into a vector of counts; the vector is projected by fixed signs to a few dimensions, and
the place in that box becomes a Hilbert key. Documents with near keys have near vectors. They are range-sorted by key, and each range's
documents are laid end to end and cut every 1,024 tokens: only the last sequence of a range can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LENGTH, END = 1_024, 0
FEATURES, DIMENSIONS, BITS = 4_096, 4, 11
VOCABULARY = "byte_bpe_50k.json"
SPECIAL = "<|endoftext|>"
PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    return np.random.default_rng(0).choice([-1.0, 1.0], (FEATURES, DIMENSIONS))


def document_point(text: str | None) -> np.ndarray:
    """The hashed vector projected to DIMENSIONS numbers between -1 and 1; the middle of the box for texts under three bytes."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(FEATURES)
    for at in range(0, max(0, len(data) - 2), 1 << 20):
        part = data[at : at + (1 << 20) + 2].astype(np.uint32)
        grams = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2_654_435_761)
        counts += np.bincount(grams >> np.uint32(20), minlength=FEATURES)
    norm = np.sqrt(counts @ counts)
    return np.zeros(DIMENSIONS) if norm == 0 else np.tanh(counts @ _signs() / norm / 2)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of each row of ``cells``: n points of d coordinates below 2**bits, with d * bits < 63.

    Coordinates are turned from the curve's frame bit by bit (Skilling's transform) and then interleaved, the first coordinate highest.
    """
    x = cells.T.astype(np.int64).copy()
    d = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        for i in range(d):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(up, q - 1, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | x[i] >> b & 1
    return key


def curve_keys(texts: pd.Series) -> pd.Series:
    points = np.array([document_point(t) for t in texts]).reshape(-1, DIMENSIONS)
    cells = np.clip(((points + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
    return pd.Series(hilbert_keys(cells, BITS))


def with_curve_key(docs: DataFrame, text: str = "text", out: str = "curve_key") -> DataFrame:
    """``docs`` with the Hilbert key of ``text`` in ``out``; a column of that name is replaced."""
    return docs.withColumn(out, F.pandas_udf(curve_keys, "long")(F.col(text)))


@lru_cache(maxsize=2)
def _encoders(vocabulary: str):
    """The tokenizer, and the same vocabulary in the faster tiktoken where its file of ranks lies beside it."""
    import base64
    import os

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    path = public_tokenizers.path(vocabulary)
    ranks, fast = path.removesuffix(".json") + ".tiktoken", None
    if os.path.exists(ranks):
        with open(ranks, "rb") as file:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return Tokenizer.from_file(path), fast


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of a text, then END. Texts that spell the special token go through ``tokenizers``, which knows it as one id."""
    slow, fast = _encoders(vocabulary)
    text = (text or "").encode("utf-8", "replace").decode()
    ids = slow.encode(text, add_special_tokens=False).ids if fast is None or SPECIAL in text else fast.encode_ordinary(text)
    return np.array([*ids, END], "<u4")


def _packer(vocabulary: str, length: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence, used = TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            names = [f.name for f in batch.schema if f.name != "_text"]
            source, rows = [], []
            for n, text in enumerate(batch.column("_text")):
                ids, start = token_ids(text.as_py(), vocabulary), 0
                while start < len(ids):
                    take = min(length - used, len(ids) - start)
                    source.append(n)
                    rows.append((start, take, zlib.crc32(ids[start : start + take].tobytes()), len(ids), sequence, used))
                    start, used = start + take, used + take
                    if used == length:
                        sequence, used = sequence + 1, 0
            kept = pa.array(source, pa.int64())
            made = np.array(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(kept) for c in names), *(pa.array(made[:, k]) for k in range(6))],
                [*names, *(c.split()[0] for c in PIECES.split(", "))],
            )

    return pack


def pack_documents(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), vocabulary: str = VOCABULARY, length: int = LENGTH) -> DataFrame:
    """One row per piece: the ``keep`` columns, then PIECES. Pieces of a sequence have its id and gapless offsets from 0.

    Every range of the curve fills sequences of ``length`` tokens and leaves its last one short. Equal keys are spread by a hash of
    the row, so that any number of copies can be cut into several ranges. Null and empty texts are one END token; an empty
    table gives no rows. Text is tokenized once, behind the shuffle, and in a stream. Sequence ids follow the ranges, which Spark samples: they
    are the same when a task runs again, and may differ between runs.
    """
    clash = {"_text", "_curve", "_spread", *(c.split()[0] for c in PIECES.split(", "))} & {c.lower() for c in keep}
    if clash:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    rows = docs.select(*keep, F.col(text).alias("_text"))
    keyed = with_curve_key(rows, "_text", "_curve").withColumn("_spread", F.xxhash64(*keep))
    ordered = keyed.repartitionByRange("_curve", "_spread").sortWithinPartitions("_curve", "_spread").select(*keep, "_text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return ordered.mapInArrow(_packer(vocabulary, length), f"{fields}, {PIECES}")
