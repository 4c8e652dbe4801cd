"""Removing repeated byte strings, by longest previous factors in a sampled suffix order.

A byte goes if a string of LENGTH bytes around it also starts earlier. Every LENGTH-byte string has an anchor: the leftmost of its
24-byte grams whose hash is least. Equal strings have equal anchors at equal places, so they meet under the anchor's hash, and neighbouring
strings with one anchor form a run: one row for about 40 starts instead of one for each.

Runs with equal bytes are settled by the earliest of them. Where an anchor has several different runs (the edges of repeats), the strings
of its runs are sorted as suffixes; in a block of suffixes whose common prefix reaches LENGTH, whoever has a smaller
position before or after it in the order has a previous factor of LENGTH bytes. Anchors with more than HOT different runs
are settled by digests of the strings themselves, so that no group grows without bound. Digests have 128 bits and stand for their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.llm.common import table

LENGTH, GRAM, HOT, BLOCK = 100, 24, 4_096, 1 << 20
REMOVED = "removed array<struct<begin: long, end: long>>, kept binary"
FACTOR, MIX = 0x100000001B3, 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every ``size`` bytes: a polynomial put together from doubled pieces, then mixed."""
    n = len(data) - size + 1
    whole, whole_len, piece, piece_len, power = None, 0, data.astype(np.uint64), 1, FACTOR
    left = size
    while left:
        if left & 1:
            whole = piece[:n] if whole is None else whole[:n] * np.uint64(power) + piece[whole_len : whole_len + n]
            whole_len += piece_len
        left >>= 1
        if left:
            piece = piece[:-piece_len] * np.uint64(power) + piece[piece_len:]
            piece_len, power = piece_len * 2, power * power % (1 << 64)
    whole = (whole ^ whole >> np.uint64(32)) * np.uint64(MIX)
    return whole ^ whole >> np.uint64(29)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of a text: first start, number of starts, and the anchor's hash. Texts below LENGTH bytes have none."""
    parts = []
    for at in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        block = np.frombuffer(data, np.uint8)[at : at + BLOCK + LENGTH - 1]
        hashes = gram_hashes(block)
        # 40 bits of hash above 24 bits of place: the least value names the leftmost least gram.
        ranked = (hashes >> np.uint64(24) << np.uint64(24)) | np.arange(len(hashes), dtype=np.uint64)
        width = LENGTH - GRAM + 1
        padded = np.append(ranked, np.full(-len(ranked) % width, np.uint64(2**64 - 1))).reshape(-1, width)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        n = len(block) - LENGTH + 1
        place = (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        parts.append((first + at, np.diff(np.append(first, n)), hashes[place[first]]))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    return ((t.as_py() or "").encode("utf-8", "replace") for t in batch.column(column))


def _hashes_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        found = [anchors(t)[2] for t in _texts(batch)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))], ["anchor"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """anchor, digest of the run's bytes, doc, and start and number of starts in one long."""
    for part in _slices(batches):
        rows = [], [], [], []
        for doc, data in zip(part.column("doc").to_pylist(), _texts(part), strict=True):
            start, count, anchor = anchors(data)
            rows[0].append(anchor)
            rows[1].append(np.array([xxhash.xxh3_64_intdigest(data[s : s + c + LENGTH - 1]) for s, c in zip(start.tolist(), count.tolist(), strict=True)], np.uint64))
            rows[2].append(np.full(len(start), doc, np.int64))
            rows[3].append(start << 8 | count)
        arrays = [np.concatenate([np.zeros(0, t), *x]).astype(t).view(np.int64) for x, t in zip(rows, (np.uint64, np.uint64, np.int64, np.int64), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["anchor", "digest", "doc", "at"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zs.ZstdCompressor(level=1)
    for batch in _slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(map(squeeze.compress, _texts(batch)), pa.binary())], ["doc", "packed"])


def _unpacked(data: bytes) -> bytes:
    return zs.ZstdDecompressor().decompress(data)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for steps that unfold a row to many."""
    for batch in batches:
        for k in range(0, len(batch), rows):
            yield batch.slice(k, rows)


def _lists(column: pa.Array, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Lengths of a column of lists of structs, null lists being empty, and the structs' fields end to end."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()
    return lengths, [flat.field(flat.type.get_field_index(f)).to_numpy(zero_copy_only=False).astype(np.int64) for f in fields]


def _bytes_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that ``wanted`` lists for each document."""
    for batch in _slices(batches):
        lengths, (anchor, runs, at) = _lists(batch.column("wanted"), "anchor", "runs", "at")
        content, begin = [], 0
        for packed, n in zip(batch.column("packed").to_pylist(), lengths.tolist(), strict=True):
            data = _unpacked(packed)
            content += [data[x >> 8 : (x >> 8) + (x & 255) + LENGTH - 1] for x in at[begin : begin + n].tolist()]
            begin += n
        doc = np.repeat(batch.column("doc").to_numpy(), lengths)
        yield pa.RecordBatch.from_arrays([*map(pa.array, (anchor, runs, doc, at)), pa.array(content, pa.binary())], ["anchor", "runs", "doc", "at", "content"])


def _strings(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc, start and LENGTH bytes of every start of the runs, in order of position."""
    contents, at, doc = rows["content"].to_pylist(), rows["at"].to_numpy(), rows["doc"].to_numpy()
    count = np.array([len(c) - LENGTH + 1 for c in contents])
    views = [np.lib.stride_tricks.sliding_window_view(np.frombuffer(c, np.uint8), LENGTH) for c in contents]
    strings = np.ascontiguousarray(np.concatenate(views)).view(f"S{LENGTH}").ravel()
    docs, starts = np.repeat(doc, count), np.repeat(at >> 8, count) + np.concatenate([np.arange(c) for c in count])
    order = np.lexsort((starts, docs))
    return docs[order], starts[order], strings[order]


def previous_factor(docs: np.ndarray, starts: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """Which suffixes have an earlier one with the same first LENGTH bytes; suffixes come in order of position.

    The sort is stable, so that positions rise within a block of suffixes whose common prefix reaches LENGTH: smaller positions
    stand above, none stands below, and the least is the block's first. A position that comes twice (a repeated row) is no earlier one.
    """
    order = np.argsort(strings, kind="stable")
    new = np.append(True, strings[order[1:]] != strings[order[:-1]])
    least = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    found = np.zeros(len(strings), bool)
    found[order] = (docs[order] != docs[least]) | (starts[order] != starts[least])
    return found


def _spans(docs: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """Starts joined to (doc, start, count), count below 2**31; they come in order of position."""
    first = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1] + 1))) if len(docs) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(docs)))
    return pa.RecordBatch.from_arrays([pa.array(docs[first]), pa.array(starts[first]), pa.array(count)], ["doc", "start", "count"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settle whole anchors; rows come sorted by anchor. Equal strings have equal anchors, so several anchors may share one sort."""
    kept = None

    def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(rows):
            docs, starts, strings = _strings(rows)
            found = previous_factor(docs, starts, strings)
            yield _spans(docs[found], starts[found])

    for batch in batches:
        for k in range(0, len(batch), 2_000):
            rows = pa.Table.from_batches([batch.slice(k, 2_000)])
            rows = rows if kept is None else pa.concat_tables([kept, rows])
            open_ = int(np.flatnonzero(rows["anchor"].to_numpy() == rows["anchor"][-1].as_py())[0])
            yield from settle(rows.slice(0, open_))
            kept = rows.slice(open_)
    if kept is not None:
        yield from settle(kept)


def _string_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, len(batch), 500):
            docs, starts, strings = _strings(pa.Table.from_batches([batch.slice(k, 500)]))
            pairs = [divmod(xxhash.xxh3_128_intdigest(s.ljust(LENGTH, b"\0")), 1 << 64) for s in strings.tolist()]
            digests = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(docs), pa.array(starts)], ["high", "low", "doc", "start"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        removed, kept, begin = [], [], 0
        lengths, (start, count) = _lists(batch.column("spans"), "start", "count")
        for packed, n in zip(batch.column("packed").to_pylist(), lengths.tolist(), strict=True):
            data = _unpacked(packed)
            gone = np.zeros(len(data) + 1, np.int64)
            first, last = start[begin : begin + n], start[begin : begin + n] + count[begin : begin + n] + LENGTH - 1
            begin += n
            np.add.at(gone, first[first < len(data)], 1)
            np.add.at(gone, np.minimum(last, len(data))[first < len(data)], -1)
            mask = np.cumsum(gone) > 0
            edges = np.flatnonzero(np.diff(np.concatenate(([False], mask)).astype(np.int8))).tolist()
            removed.append([{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)])
            kept.append(np.frombuffer(data, np.uint8)[~mask[:-1]].tobytes())
        types = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(removed, types), pa.array(kept, pa.binary())], ["doc_id", "removed", "kept"])


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc, packed) of every row, and (doc, start, count) of strings that also start earlier. ``docs``: doc long, text string."""
    packed = table(docs.select("doc", "text").mapInArrow(_packed, "doc long, packed binary"))  # two steps need it
    known = docs.filter(F.col("doc").isNotNull())
    again = known.select("text").mapInArrow(_hashes_only, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    runs = table(known.mapInArrow(_runs, "anchor long, digest long, doc long, at long").join(again, "anchor", "left_semi"))
    first = runs.groupBy("anchor", "digest").agg(F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("copies"))
    whole = runs.join(first.filter("copies > 1").drop("copies"), ["anchor", "digest"]).filter(F.struct("doc", "at") != F.col("first"))
    whole = whole.select("doc", F.shiftright("at", 8).alias("start"), F.col("at").bitwiseAND(F.lit(255)).alias("count"))

    several = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("runs")).filter("runs > 1")
    open_ = first.join(several, "anchor").select("anchor", "runs", "first.doc", "first.at")
    wanted = open_.groupBy("doc").agg(F.collect_list(F.struct("anchor", "runs", "at")).alias("wanted"))
    content = packed.join(wanted, "doc").mapInArrow(_bytes_of_runs, "anchor long, runs long, doc long, at long, content binary")
    # One place to sort, and another for anchors too frequent for one task; every row takes one of them.
    few = content.filter(F.col("runs") <= HOT).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_compare, "doc long, start long, count long")
    strings = content.filter(F.col("runs") > HOT).mapInArrow(_string_digests, "high long, low long, doc long, start long")
    earliest = strings.groupBy("high", "low").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    many = strings.join(earliest, ["high", "low"]).filter(F.struct("doc", "start") != F.col("first")).select("doc", "start", F.lit(1).cast("long").alias("count"))
    return packed, table(whole.unionByName(few).unionByName(many))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, ``removed`` (maximal runs of removed bytes) and ``kept`` (the other bytes) of every row.

    Earlier means a smaller id, or an earlier place in the same document. Null texts count as empty; texts below LENGTH bytes stay. Rows without an id
    stay as they are and count for nobody. Rows that repeat an id count as versions of one document: what one loses at a place all lose there.
    Kept bytes need not be valid UTF-8, as strings are cut by bytes. An empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    packed, spans = repeated_spans(rows)
    listed = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "count")).alias("spans"))  # bounded by the document's own length
    joined = packed.join(listed, "doc", "left").select(F.col("doc").alias("doc_id"), "packed", "spans")
    out = joined.mapInArrow(_cut_out, f"doc_id long, {REMOVED}")
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"])
    return out.withColumn("n_bytes", F.octet_length("kept") + gone).select("doc_id", "n_bytes", "removed", "kept")
