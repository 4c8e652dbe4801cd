"""Near-duplicate vectors by sorted projection passes.

A pass hashes every vector to the signs of random projections, concatenated, and sorts each label's vectors by them; near vectors tend to
lie near each other. Every vector is compared with its next WINDOW neighbours, and verified pairs of all passes are united.

Windows can't name all partners in a crowd of near copies, so links are counted exactly inside each united group. With angles to the group's
least vector, the triangle inequality settles most pairs without looking: a vector whose angle and the group's largest angle together stay within
the limit is linked to all. Only the others are compared with each other, in blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.llm.common import cut, join_null_safe
from municipia.llm.components import components
from municipia.llm.simhash import Forest

LEAST, PASSES, BITS, WINDOW, BLOCK = 0.93, 16, 62, 24, 2_048
MARGIN = 1e-6  # angles closer than this to the limit are compared


@lru_cache(maxsize=8)
def _planes(size: int, passes: int) -> np.ndarray:
    return np.random.default_rng(11).standard_normal((size, passes * BITS))


def _key_maker(passes: int):
    def keys(vectors: pd.Series) -> pd.Series:
        return sign_keys(vectors, passes)

    return keys


def sign_keys(vectors: pd.Series, passes: int = PASSES) -> pd.Series:
    """One key a pass: BITS signs, the first one highest."""
    out: list = [None] * len(vectors)
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        signs = (np.stack([vectors.iloc[i] for i in at]).astype(np.float64) @ _planes(int(size), passes) > 0).reshape(len(at), passes, BITS)
        keys = signs.astype(np.int64) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
        for i, row in zip(at, keys, strict=True):
            out[i] = row
    return pd.Series(out)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one size, as unit vectors in double precision."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str], emit: Callable[[pa.Table], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    """Call ``emit`` for every run of rows that are equal in ``keys``; rows come sorted by them, and a run may go on in the next batch."""
    kept = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if kept is None else pa.concat_tables([kept, rows])
        if not len(rows):
            continue
        columns = [rows[k].to_numpy() for k in keys]
        begins = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)))
        for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True):
            if (made := emit(rows.slice(a, b - a))) is not None:
                yield made
        kept = rows.slice(int(begins[-1]))
    if kept is not None and (made := emit(kept)) is not None:
        yield made


def _neighbours(least: float, window: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Verified pairs of rows at most ``window`` apart and equal in pass and label, as a forest for each batch."""
        tail = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (rows if tail is None else pa.concat_tables([tail, rows])).combine_chunks()
            group, rep, forest, links = rows["group"].to_numpy(), rows["rep"].to_numpy(), Forest(), []
            if len(rows):
                edges = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group)).tolist()
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    x = _matrix(rows["embedding"].combine_chunks().slice(a, b - a))
                    for shift in range(1, min(window, b - a - 1) + 1):
                        near = np.flatnonzero(np.einsum("ij,ij->i", x[:-shift], x[shift:]) >= least) + a
                        links.extend(p for p in zip(rep[near].tolist(), rep[near + shift].tolist(), strict=True) if forest.join(*p))
            made = np.array(links, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], ["a", "b"])
            tail = rows.slice(max(0, len(rows) - window))

    return search


def angles(vectors: pd.Series, centres: pd.Series) -> pd.Series:
    def angle(v: np.ndarray, c: np.ndarray) -> float:
        v, c = np.asarray(v, np.float64), np.asarray(c, np.float64)
        return math.acos(max(-1.0, min(1.0, v @ c / math.sqrt((v @ v) * (c @ c)))))

    return pd.Series([angle(v, c) for v, c in zip(vectors, centres, strict=True)], dtype="float64")


def _counts(least: float):
    def count(rows: pa.Table) -> pa.RecordBatch | None:
        """Copies linked to each row of a block, or between two blocks."""
        rows = rows.combine_chunks()
        x, rep, copies, block = _matrix(rows["embedding"].combine_chunks()), rows["rep"].to_numpy(), rows["copies"].to_numpy(), rows["block"].to_numpy()
        same, links = rows["inside"][0].as_py(), np.zeros(len(rep), np.int64)
        for a in range(0, len(x), 512):
            near = x[a : a + 512] @ x.T >= least
            near &= rep[a : a + 512, None] != rep[None, :] if same else block[a : a + 512, None] != block[None, :]
            links[a : a + 512] = near @ copies
        return pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links)], ["rep", "links"])

    return lambda batches: runs(batches, ["component", "part"], count)


def near_vectors(vectors: DataFrame, least: float = LEAST, passes: int = PASSES, window: int = WINDOW) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Pairs with equal labels and a cosine of at least ``least`` are linked; passes may miss some, and none below it is taken. Vectors that are null, empty, zero
    or hold null or non-finite components, rows with a null label or a null id, and vectors of different sizes link with nothing.
    Rows with the same vector and label are copies: counted first, never compared. Rows that repeat an id are rows of their own. An empty table gives no rows.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<float>").alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    named = rows.withColumn("usable", usable)
    classes = cut(named.filter("usable").groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))

    keys = F.pandas_udf(_key_maker(passes), "array<long>")
    keyed = classes.select("label", "embedding", "rep", F.posexplode(keys("embedding")).alias("pass", "key"))
    grouped = keyed.select(F.xxhash64("pass", "label", F.size("embedding")).alias("group"), "key", "rep", "embedding")
    ordered = grouped.repartitionByRange("group", "key", "rep").sortWithinPartitions("group", "key", "rep")
    joined = components(ordered.mapInArrow(_neighbours(least, window), "a long, b long"))

    members = classes.join(joined, classes["rep"] == joined["id"]).select("component", "rep", "copies", "embedding")
    centres = classes.join(joined.filter(F.col("id") == F.col("component")), classes["rep"] == joined["id"]).select("component", F.col("embedding").alias("centre"))
    measured = cut(members.join(centres, "component").withColumn("angle", F.pandas_udf(angles, "double")("embedding", "centre")).drop("centre"))
    limit = math.acos(least) - MARGIN
    widest = measured.groupBy("component").agg(F.max("angle").alias("widest"), F.sum("copies").alias("everyone"))
    judged = measured.join(widest, "component").withColumn("core", F.col("angle") + F.col("widest") <= limit)
    core = judged.filter("core").select("rep", (F.col("everyone") - F.col("copies")).alias("links"))
    rest = judged.filter("not core")
    sizes = rest.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"), (F.max("everyone") - F.sum("copies")).alias("core_copies"))
    blocked = rest.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    parts = F.transform(F.expr("sequence(0L, blocks - 1)"), lambda k: F.least(k, F.col("block")) * F.col("blocks") + F.greatest(k, F.col("block")))
    dealt = blocked.select("component", "rep", "copies", "embedding", "block", "blocks", F.explode(parts).alias("part"))
    dealt = dealt.withColumn("inside", F.expr("part div blocks = part % blocks")).drop("blocks").repartition("component", "part").sortWithinPartitions("component", "part")
    counted = dealt.mapInArrow(_counts(least), "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))
    outer = blocked.select("rep", "core_copies").join(counted, "rep").select("rep", (F.col("links") + F.col("core_copies")).alias("links"))
    found = core.unionByName(outer).join(joined.select(F.col("id").alias("rep"), "component"), "rep")
    known = classes.join(found, "rep", "left").select("label", "embedding", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))

    linked = join_null_safe(named.filter("usable"), known, ["label", "embedding"]).select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
    alone = named.filter("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
