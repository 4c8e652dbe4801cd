"""Near duplicates by SimHash fingerprints, searched with bands and a table of distances to pivots.

Fingerprints that differ in at most ``RADIUS`` of 64 bits agree on at least two of six blocks of bits, so every linked pair meets
under one of 15 keys of two blocks. Under a key, pairs are discarded by their distances to reference fingerprints: Hamming
distance is a metric, so the distances of a linked pair to any pivot differ by RADIUS at most. What is left is verified.

The pivots only discard; they can't search. Distances of unrelated fingerprints to a pivot spread by 4, as much as the
radius, so that cells of pivot distances would put most of the corpus beside every query.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municipia.llm.common import cut
from municipia.llm.components import components

RADIUS, SHINGLE, SEED = 4, 4, 42
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))
PIVOTS = tuple(xxhash.xxh64_intdigest(f"pivot {i}") for i in range(16))
HOT = 8_192


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint of a text's word shingles, repeats included; zero for null and for texts without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words])
    begins = ends - [len(w) + 1 for w in words]
    joined, n = b" ".join(words), max(1, len(words) - SHINGLE + 1)
    last = ends[min(SHINGLE, len(words)) - 1 :] - 1
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        spans = zip(begins[k : min(n, k + 65_536)].tolist(), last[k : k + 65_536].tolist(), strict=False)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``out``; a column of that name is replaced."""
    return docs.withColumn(out, F.pandas_udf(fingerprints, "long")(F.col(text)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def pivot_table(fp: Column) -> list[Column]:
    """The distances to the pivots, eight to a long."""
    distance = [F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))).cast("long") for p in PIVOTS]
    packed = []
    for k in range(0, len(PIVOTS), 8):
        word = distance[k]
        for i in range(1, 8):
            word = word.bitwiseOR(F.shiftleft(distance[k + i], 8 * i))
        packed.append(word.alias(f"pivots{k // 8}"))
    return packed


def _bands(fp: Column) -> Column:
    """The keys of two blocks, each with its number in the lowest four bits."""
    block = [F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << size) - 1)) for at, size in BLOCKS]
    keys = [F.shiftleft(F.shiftleft(block[i], 11).bitwiseOR(block[j]), 4).bitwiseOR(F.lit(k)) for k, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))]
    return F.array(*keys)


class Forest:
    """Union-find over small integers; ``join`` says whether two trees became one."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def _verified(i: np.ndarray, j: np.ndarray, fp: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which pairs the pivots don't discard and the distance confirms."""
    kept = np.flatnonzero(np.abs(table[i] - table[j]).max(axis=1) <= RADIUS)
    return kept[np.bitwise_count(fp[i[kept]] ^ fp[j[kept]]) <= RADIUS]


def run_links(key: np.ndarray, fp: np.ndarray, table: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the linked pairs under each key, as pairs of row numbers; rows are sorted by key."""
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    size = np.diff(np.append(begin, len(key)))
    forest, links = Forest(), []

    def add(i: np.ndarray, j: np.ndarray) -> None:
        ok = _verified(i, j, fp, table)
        links.extend(p for p in zip(i[ok].tolist(), j[ok].tolist(), strict=True) if forest.join(*p))

    left = np.repeat(np.where(size <= 64, size, 0), size) - (np.arange(len(key)) - np.repeat(begin, size)) - 1  # later rows of the same short run
    at, shift = np.flatnonzero(left > 0), 1
    while len(at):
        add(at, at + shift)
        shift += 1
        at = at[left[at] >= shift]
    for b, n in zip(begin[size > 64].tolist(), size[size > 64].tolist(), strict=True):
        for i in range(b, b + n - 1):
            rest = np.arange(i + 1, b + n)
            add(np.full(len(rest), i), rest)
    return links


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows that come sorted by key; a run goes on into the next batch."""
    kept = None

    def found(rows: pa.Table) -> pa.RecordBatch:
        column = lambda c: rows[c].to_numpy()
        table = np.column_stack([column(c) for c in rows.column_names if c.startswith("pivots")]).astype("<i8").view(np.int8).astype(np.int16)
        changes = (column("key")[1:] != column("key")[:-1]) | (column("part")[1:] != column("part")[:-1])
        pairs = np.array(run_links(np.cumsum(np.append(True, changes)), column("fp").view(np.uint64), table), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(column("node")[pairs[:, 0]]), pa.array(column("node")[pairs[:, 1]])], ["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if kept is None else pa.concat_tables([kept, rows])
        if len(rows) == 0:
            continue
        same = (rows["key"].to_numpy() == rows["key"][-1].as_py()) & (rows["part"].to_numpy() == rows["part"][-1].as_py())
        last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if last:
            yield found(rows.slice(0, last))
        kept = rows.slice(last)
    if kept is not None:
        yield found(kept)


def link_fingerprints(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect what is linked directly or through others. ``nodes``: node long, fp long, one row per fingerprint.

    Keys of more than HOT rows are dealt over pairs of chunks, so that no task holds more than two chunks of a key. Under each key only a
    spanning forest leaves the task.
    """
    keyed = nodes.select("node", "fp", *pivot_table(F.col("fp")), F.explode(_bands(F.col("fp"))).alias("key"))
    hot = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > HOT)
    spread = keyed.join(hot.select("key", F.ceil(F.col("_rows") / HOT).alias("_chunks")), "key", "left")
    chunk = F.pmod(F.xxhash64("fp"), F.col("_chunks"))
    pairs = F.transform(F.expr("sequence(0L, _chunks - 1)"), lambda k: F.least(k, chunk) * F.col("_chunks") + F.greatest(k, chunk))
    dealt = spread.withColumn("part", F.explode(F.coalesce(pairs, F.array(F.lit(0).cast("long"))))).drop("_chunks")
    return dealt.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component) for every row: the least id reachable over links of at most RADIUS differing bits, the row itself included.

    Equal fingerprints are linked, that of texts without words (zero) like any other; null counts as empty. Rows without an id
    join no documents and take the component of their fingerprint, or null where nobody else has it. An empty table gives no rows.
    """
    marked = cut(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).select("doc_id", "fp"))
    nodes = marked.filter(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").cast("long").alias("node"))
    joined = components(link_fingerprints(nodes))
    classes = nodes.join(joined, nodes["node"] == joined["id"], "left").select("fp", F.coalesce("component", "node").alias("component"))
    return marked.join(classes, "fp", "left").select("doc_id", "fp", "component")
