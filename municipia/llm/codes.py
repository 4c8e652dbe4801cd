"""Short codes for vectors: one small codebook per part of the vector, fitted by Lloyd's rounds over cover trees.

Vectors become integers, so that sums, means and distances are exact and no result depends on row order. The rows are cut into blocks of bounded
size. Every part of every block gets a cover tree once: each node knows its centre, its radius, and how many points lie below it with which sum.
A round walks the trees from the top. Where the triangle inequality leaves one entry for a whole node, its sum goes to that entry unopened; only
the other nodes are opened, down to leaves, whose points are compared exactly. The driver sees sums per entry only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.llm.common import free_name, join_null_safe, table

SCALE, PARTS, ENTRIES, ROUNDS = 4_096, 8, 16, 6
BLOCK, LEAF = 4_096, 8
NARROW = 1 << 25  # below it, squared distances of parts of 1,024 components fit a long
LIMB = 40
TREE = "centre array<bigint>, radius array<double>, count array<bigint>, total array<bigint>, child array<bigint>, begin array<bigint>, points array<bigint>, row array<bigint>"
FIELDS = [f.split()[0] for f in TREE.split(", ")]
BLOCKS = f"rows array<bigint>, wide array<string>, trees array<struct<{', '.join(f.replace(' ', ':', 1) for f in TREE.split(', '))}>>"


def whole(x: float) -> int:
    """floor(SCALE * x), exact for any finite number."""
    top, bottom = float(x).as_integer_ratio()
    return top * SCALE // bottom


def cover_tree(points: np.ndarray) -> dict[str, np.ndarray]:
    """A cover tree over integer points, as flat arrays.

    A node's points lie within its radius of its centre, which is one of them. Its children are centred at its own centre and at points more than half
    its radius from each other; each holds the points nearest to its centre, none of them farther than that half. Nodes of LEAF points or fewer, or of
    equal points, are leaves. The children of node i are the nodes from ``child[i]`` up to ``child[i + 1]``, its points those from ``begin[i]`` on, ``count[i]`` of them.
    """
    size = points.shape[1]
    order = np.arange(len(points))
    root = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1))) if len(points) else 0
    level, found, children = [(0, len(points), root)] if len(points) else [], [], []
    while level:
        below = []
        for begin, end, centre in level:
            rows = order[begin:end]
            here, middle = points[rows], points[centre]
            apart = np.sqrt(((here - middle) ** 2).sum(axis=1).astype(np.float64))
            radius = float(apart.max())
            found.append((middle, radius, end - begin, here.sum(axis=0), begin))
            if end - begin <= LEAF or radius == 0:
                children.append(0)
                continue
            gap, owner, centres = apart, np.zeros(len(rows), np.int64), [centre]
            while gap[at := int(gap.argmax())] > radius / 2:
                distance = np.sqrt(((here - here[at]) ** 2).sum(axis=1).astype(np.float64))
                owner = np.where(distance < gap, len(centres), owner)
                gap = np.minimum(gap, distance)
                centres.append(int(rows[at]))
            order[begin:end] = rows[np.argsort(owner, kind="stable")]
            edges = begin + np.append(0, np.cumsum(np.bincount(owner, minlength=len(centres))))
            below += zip(edges[:-1].tolist(), edges[1:].tolist(), centres, strict=True)
            children.append(len(centres))
        level = below
    count = np.array([f[2] for f in found], np.int64)
    firsts = 1 + np.append(0, np.cumsum(children)).astype(np.int64)
    return {
        "centre": np.array([f[0] for f in found], np.int64).reshape(-1, size), "radius": np.array([f[1] for f in found], np.float64), "count": count,
        "total": np.array([f[3] for f in found], np.int64).reshape(-1, size), "child": firsts, "begin": np.array([f[4] for f in found], np.int64),
        "points": points[order].reshape(-1, size), "row": order,
    }


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by entries; of Python integers where a long might not hold them."""
    if max(int(abs(points).max(initial=0)), int(abs(entries).max(initial=0))) >= NARROW:
        points, entries = points.astype(object), entries.astype(object)
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and the squared distance to it; ties go to the lower index."""
    distances = squared(points, entries)
    best = np.argmin(distances, axis=1).astype(np.int64)
    return best, distances[np.arange(len(points)), best]


def settled(tree: dict[str, np.ndarray], entries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(nodes, entry, points) of the tree: nodes that lie with one entry as a whole, then single points; the other array is empty.

    A node is settled if every other entry is farther from its centre than the nearest one by more than twice the radius.
    """
    none = np.empty(0, np.int64)
    wide = int(abs(entries).max(initial=0)) >= NARROW  # such distances may exceed a double: compare points only
    nodes, loose = np.zeros(min(1, len(tree["count"])), np.int64), []
    while len(nodes) and not wide:
        distance = np.sqrt(squared(tree["centre"][nodes], entries).astype(np.float64))
        best = distance.argmin(axis=1)
        gap = np.partition(distance, 1, axis=1)[:, 1] - distance.min(axis=1) if len(entries) > 1 else np.full(len(nodes), np.inf)
        done = gap > 2 * tree["radius"][nodes] + 1e-6 * (1 + distance.min(axis=1))
        yield nodes[done], best[done].astype(np.int64), none
        nodes = nodes[~done]
        first, last = tree["child"][nodes], tree["child"][nodes + 1]
        leaves = nodes[first == last]
        loose += [np.arange(a, a + n) for a, n in zip(tree["begin"][leaves].tolist(), tree["count"][leaves].tolist(), strict=True)]
        nodes = np.concatenate([none, *(np.arange(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True))])
    points = np.arange(len(tree["points"])) if wide else np.concatenate([none, *loose])
    yield none, nearest(tree["points"][points], entries)[0] if len(points) else none, points


def _limbs(value: int) -> list[int]:
    """A whole number in limbs of LIMB bits, lowest first; the last one carries the sign."""
    out = []
    while not -(1 << LIMB) <= value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    flat = [np.asarray(r).reshape(-1) for r in rows]
    bounds = np.append(0, np.cumsum([len(f) for f in flat]))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(flat) if flat else np.empty(0), kind))


def _blocks(width: int, parts: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of at most BLOCK rows with their trees. Rows with a component of NARROW or more stand apart, as text."""
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made(rows: np.ndarray, points: np.ndarray | None, wide: list[str]) -> pa.RecordBatch:
            trees = [] if points is None else [cover_tree(p) for p in np.split(points, parts, axis=1)]
            kinds = [pa.float64() if f == "radius" else pa.int64() for f in FIELDS]
            cells = [_lists([t[f] for t in trees], kind) for f, kind in zip(FIELDS, kinds, strict=True)]
            structs = pa.StructArray.from_arrays(cells, FIELDS)
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.array(rows, pa.int64())),
                pa.ListArray.from_arrays(pa.array([0, len(wide)], pa.int32()), pa.array(wide, pa.string())),
                pa.ListArray.from_arrays(pa.array([0, len(trees)], pa.int32()), structs)], ["rows", "wide", "trees"])

        def flushed(least: int) -> Iterator[pa.RecordBatch]:
            while (have := sum(len(r) for r, _ in held)) >= least and have:
                rows, points = (np.concatenate(x) for x in zip(*held, strict=True))
                held[:] = [(rows[BLOCK:], points[BLOCK:])]
                yield made(rows[:BLOCK], points[:BLOCK], [])

        for batch in batches:
            rows, vectors = batch.column("row").to_numpy(), batch.column("vector")
            x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
            narrow = (np.abs(x) < NARROW / SCALE - 1).all(axis=1)
            padded = np.zeros((int(narrow.sum()), width), np.int64)
            padded[:, : x.shape[1]] = np.floor(x[narrow] * SCALE)
            held.append((rows[narrow], padded))
            yield from flushed(BLOCK)
            if not narrow.all():
                digits = [str(whole(v)) for line in x[~narrow] for v in [*line, *[0.0] * (width - x.shape[1])]]
                for a in range(0, int((~narrow).sum()), BLOCK):
                    yield made(rows[~narrow][a : a + BLOCK], None, digits[a * width : (a + BLOCK) * width])
        yield from flushed(1)

    return build


def _read_blocks(batch: pa.RecordBatch, width: int, parts: int) -> Iterator[tuple[np.ndarray, list[dict[str, np.ndarray]], np.ndarray]]:
    """Rows, trees and wide points of each block. Wide points are Python integers."""
    for i in range(len(batch)):
        rows = batch.column("rows").slice(i, 1).flatten().to_numpy()
        wide = np.array([int(d) for d in batch.column("wide").slice(i, 1).flatten().to_pylist()], object).reshape(-1, width)
        structs = batch.column("trees").slice(i, 1).flatten()
        trees = []
        for k in range(len(structs)):
            one = structs.slice(k, 1)
            cells = dict(zip(FIELDS, (c.flatten().to_numpy(zero_copy_only=False) for c in one.flatten()), strict=True))
            for name in ("centre", "total", "points"):
                cells[name] = cells[name].reshape(-1, width // parts)
            trees.append(cells)
        yield rows, trees, wide


def _sums(books: list[np.ndarray], width: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per part and entry, the sum of its points at each place and their number (at place -1), in limbs."""
        parts = len(books)
        totals = [np.zeros(b.shape, object) for b in books]
        counts = [np.zeros(len(b), object) for b in books]
        for batch in batches:
            for _, trees, wide in _read_blocks(batch, width, parts):
                for part, tree in enumerate(trees):
                    entries = len(books[part])
                    total, count = np.zeros(books[part].shape, np.int64), np.zeros(entries, np.int64)
                    for nodes, entry, points in settled(tree, books[part]):
                        below = tree["total"][nodes] if len(nodes) else tree["points"][points]
                        np.add.at(total, entry, below)
                        np.add.at(count, entry, tree["count"][nodes] if len(nodes) else 1)
                    totals[part] += total
                    counts[part] += count
                for part, points in enumerate(np.split(wide, parts, axis=1)) if len(wide) else ():
                    entry = nearest(points, books[part])[0]
                    np.add.at(totals[part], entry, points)
                    np.add.at(counts[part], entry, 1)
        made = [
            (part, entry, place, limb, digits) for part in range(parts) for entry in range(len(books[part]))
            for place in range(-1, width // parts)
            for limb, digits in enumerate(_limbs(int(counts[part][entry] if place < 0 else totals[part][entry, place]))) if digits
        ]
        cells = np.array(made, np.int64).reshape(-1, 5)
        yield pa.RecordBatch.from_arrays([pa.array(cells[:, k]) for k in range(5)], ["part", "entry", "place", "limb", "digits"])

    return add


def _assigned(books: list[np.ndarray], width: int):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Row, code and squared error (as text) of every vector."""
        parts = len(books)
        for batch in batches:
            for rows, trees, wide in _read_blocks(batch, width, parts):
                codes, error = np.zeros((len(rows), parts), np.int64), np.zeros(len(rows), object)
                for part in range(parts):
                    book = books[part]
                    if trees:
                        tree, entry = trees[part], np.zeros(len(rows), np.int64)
                        for nodes, found, points in settled(tree, book):
                            for node, one in zip(nodes.tolist(), found.tolist(), strict=False) if len(nodes) else ():
                                entry[tree["begin"][node] : tree["begin"][node] + tree["count"][node]] = one
                            entry[points] = found if len(points) else 0
                        far = tree["points"] - book[entry] if int(abs(book).max(initial=0)) < NARROW else tree["points"].astype(object) - book[entry]
                        codes[tree["row"], part] = entry
                        error[tree["row"]] += (far**2).sum(axis=1)
                    else:
                        codes[:, part], distance = nearest(np.split(wide, parts, axis=1)[part], book)
                        error += distance
                text = ["".join(f"{c:02x}" for c in line) for line in codes.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(text, pa.string()), pa.array([str(e) for e in error], pa.string())], ["row", "code", "error"])

    return assign


def codebooks(blocks: DataFrame, books: list[np.ndarray], width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after ``rounds`` rounds. The driver gets one sum per entry and place."""
    for _ in range(rounds):
        cells = blocks.mapInArrow(_sums(books, width), "part long, entry long, place long, limb long, digits long")
        found: dict[tuple[int, int, int], int] = {}
        for r in cells.groupBy("part", "entry", "place", "limb").agg(F.sum("digits").alias("digits")).collect():
            key = (r["part"], r["entry"], r["place"])
            found[key] = found.get(key, 0) + (r["digits"] << (LIMB * r["limb"]))
        new = []
        for part, book in enumerate(books):
            lines = [
                [found.get((part, e, place), 0) // n for place in range(book.shape[1])] if (n := found.get((part, e, -1), 0)) else book[e].tolist()
                for e in range(len(book))
            ]
            new.append(_book(lines))
        books = new
    return books


def _book(lines: list[list[int]]) -> np.ndarray:
    wide = any(abs(v) >= NARROW for line in lines for v in line)
    return np.array(lines, object if wide else np.int64)


def finite(vector: str) -> str:
    """SQL: the vector is there, not empty, and all its components are finite numbers."""
    return f"coalesce(size({vector}) > 0 AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')), false)"


def coded(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          code: str = "code", error: str = "error") -> tuple[DataFrame, list[np.ndarray]]:
    """(rows with ``code`` and ``error`` added, the codebooks).

    Rows whose vector is null or empty, or holds null or non-finite components, go. All vectors must be of the size of the first one by ``key``: others go too. A size
    that ``parts`` does not divide is filled up with zeros. The first codebooks are the ``entries`` first rows by ``key``, null keys last, equal keys
    by their vectors; fewer rows make smaller codebooks. ``error`` is a decimal, null beyond 38 digits. An empty table gives no rows and empty codebooks.
    Repeated rows are coded each. Names that the rows have already are refused.
    """
    if clash := {code.lower(), error.lower(), "_row", "_coded"} & {c.lower() for c in vectors.columns}:
        raise ValueError(f"columns already exist: {sorted(clash)}")
    usable = vectors.filter(finite(f"`{vector}`"))
    order = [F.col(key).asc_nulls_last(), F.col(vector)]
    first = [r[0] for r in usable.orderBy(*order).select(F.col(vector).cast("array<double>")).limit(1).collect()]
    size = len(first[0]) if first else parts
    width = -(-size // parts) * parts
    # Numbers must stay the same when a task runs again, so the numbered rows are written first.
    numbered = table(usable.filter(F.size(vector) == size).withColumn("_row", F.monotonically_increasing_id()))
    seeds = [r[0] for r in numbered.orderBy(*order).select(F.col(vector).cast("array<double>")).limit(entries).collect()]
    lines = [[whole(x) for x in s] + [0] * (width - size) for s in seeds]
    step = width // parts
    books = [_book([line[p * step : (p + 1) * step] for line in lines]).reshape(-1, step) for p in range(parts)]
    narrow = numbered.select(F.col("_row").alias("row"), F.col(vector).cast("array<double>").alias("vector"))
    blocks = table(narrow.mapInArrow(_blocks(width, parts), BLOCKS))
    books = codebooks(blocks, books, width, rounds)
    found = blocks.mapInArrow(_assigned(books, width), "row long, code string, error string")
    found = found.select(F.col("row").alias("_coded"), F.col("code").alias(code), F.expr("try_cast(error AS decimal(38,0))").alias(error))
    return numbered.join(found, F.col("_row") == F.col("_coded")).drop("_row", "_coded"), books


def with_group_error(rows: DataFrame, label: str, error: str, out: str) -> DataFrame:
    """``out``: the errors summed over the rows of equal labels, nulls together; null beyond 38 digits."""
    name = free_name(rows, "_error")
    sums = rows.groupBy(label).agg(F.expr(f"try_sum(`{error}`)").alias(name))
    return join_null_safe(rows, sums, [label]).withColumnRenamed(name, out)


def books_text(books: list[np.ndarray]) -> str:
    """All entries' components by part, entry and place, joined by commas."""
    return ",".join(str(int(v)) for book in books for line in book for v in line)
