"""Hard negatives: for an anchor and each of its positives, the best rows of other labels whose score lies in a window below the positive's.

Scores are inner products of whole numbers. Rows that are equal in label and vector are one class, so that crowds of copies cost one comparison.
The classes are cut into index blocks of bounded size, in which dimensions are ordered by their weight and every row knows the norm of its vector from each
dimension on. A threshold join of query blocks with index blocks lists a row under a dimension only while the norms from there on could still reach the
least threshold; partial scores are added up list by list, pairs whose remaining norms can't lift them to their threshold are dropped, and survivors are scored exactly.

Thresholds start high. A query whose windows are full is done; for the others the threshold is lowered, down to where nothing can be missing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from municipia.llm.common import cut, table

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
LOWEST, HIGHEST = (1, 2), (19, 20)  # a negative's score against its positive's, at least and at most
BLOCK, QUERIES, TOGETHER, STEP = 8_192, 1_024, 128, 8
POSITIVE_LEVELS = (0.75, 0.45, 0.2, None)  # thresholds as shares of the query's squared norm; None finds all
NEGATIVE_LEVELS = (0.85, 0.68, None)  # as shares of the positive's score; None reaches down to the window's end
EXACT = float(1 << 53)
INDEX = "size int, block long, label array<bigint>, row array<bigint>, x array<bigint>, tail array<double>, axis array<int>, ids array<bigint>, first array<int>"


def tails(x: np.ndarray) -> np.ndarray:
    """Norms of each row from every STEP-th dimension on; the last one is 0."""
    squares = np.add.reduceat(x.astype(np.float64) ** 2, np.arange(0, x.shape[1], STEP), axis=1)
    return np.sqrt(np.hstack([np.cumsum(squares[:, ::-1], axis=1)[:, ::-1], np.zeros((len(x), 1))]))


def indexed(rows: pa.Table) -> pa.Table:
    """One index block: its rows by label, their dimensions from the heaviest on, and the norms that are left at every STEP-th one."""
    rows = rows.sort_by([("label", "ascending"), ("row", "ascending")]).combine_chunks()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
    axis = np.argsort(-(x.astype(np.float64) ** 2).sum(axis=0), kind="stable").astype(np.int32)
    x, ids = np.ascontiguousarray(x[:, axis]), rows["ids"].combine_chunks()
    first = np.append(0, np.cumsum(ids.value_lengths().to_numpy())).astype(np.int32)
    cells = [rows["label"].to_numpy(), rows["row"].to_numpy(), x.reshape(-1), tails(x).reshape(-1), axis, ids.flatten().to_numpy(), first]
    names = ["label", "row", "x", "tail", "axis", "ids", "first"]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c)) for c in cells]
    return pa.table([rows["size"].slice(0, 1), rows["block"].slice(0, 1), *lists], names=["size", "block", *names])


def joined(q: np.ndarray, least: np.ndarray, x: np.ndarray, tail: np.ndarray, best: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, row, score) of all pairs whose score is at least the query's threshold, in pieces; with ``best`` a query's pairs below its
    ``best``-th score may be left out."""
    if not len(x) or not len(q):
        return
    heads = tails(q)
    exact = heads[:, 0].max() * tail[:, 0].max() < EXACT
    # Float sums of numbers too long for them are off by a small share of the largest norms.
    bar = least - 1e-9 * (1 + heads[:, 0] * tail[:, 0].max())
    lists = tail[:, :-1] * heads[:, :-1].max(axis=0) >= bar.min()  # under which dimensions a row is listed: the first ones
    length = lists.sum(axis=1)
    order = np.argsort(-length, kind="stable")
    order = order[length[order] > 0]
    xf, qf, steps = x[order].astype(np.float64), q.astype(np.float64), lists.shape[1]
    for begin in range(0, len(q), TOGETHER):
        part = slice(begin, begin + TOGETHER)
        who, rest, bars = np.arange(len(order)), heads[part], bar[part, None]
        score, live = np.zeros((len(rest), len(who))), np.ones((len(rest), len(who)), bool)
        for c in range(steps):
            m = int((length[order[who]] > c).sum())
            if m == 0:
                break
            span = slice(c * STEP, (c + 1) * STEP)
            score[:, :m] += qf[part, span] @ xf[who[:m], span].T
            live[:, :m] &= score[:, :m] + rest[:, c + 1, None] * tail[order[who[:m]], c + 1] >= bars
            share = live.mean() if live.size else 0.0
            if share < 0.02 or (share > 0.5 and c >= steps // 2):
                break
            if (some := live.any(axis=0)).mean() < 0.6:
                who, score, live = who[some], score[:, some], live[:, some]
        if live.size and live.mean() > 0.05:
            some = np.flatnonzero(live.any(axis=0))
            full = qf[part] @ xf[who[some]].T if exact else q[part] @ x[order[who[some]]].T
            floor = least[part, None]
            if best is not None and full.shape[1] > best:
                floor = np.maximum(floor, np.partition(full, -best, axis=1)[:, -best, None])
            a, b = np.nonzero(full >= floor)
            yield a + begin, order[who[some[b]]], full[a, b].astype(np.int64)
        else:
            a, b = np.nonzero(live)
            for at in range(0, len(a), 1 << 16):
                i, j = a[at : at + (1 << 16)] + begin, order[who[b[at : at + (1 << 16)]]]
                value = np.einsum("ij,ij->i", q[i], x[j])
                good = value >= least[i]
                yield i[good], j[good], value[good]


def _ranked(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], low_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs by query, best score first, then least id."""
    i, j, value = (np.concatenate([np.empty(0, np.int64), *c]) for c in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 3
    order = np.lexsort((low_id[j], -value, i))
    return i[order], j[order], value[order]


class Pair:
    """A block of queries and an index block, read from one row."""

    def __init__(self, batch: pa.RecordBatch, n: int):
        cell = lambda name: batch.column(name).slice(n, 1).flatten()
        self.label, self.row, self.ids, self.first = (cell(c).to_numpy() for c in ("label", "row", "ids", "first"))
        self.x = cell("x").to_numpy().reshape(len(self.row), -1)
        self.tail = cell("tail").to_numpy().reshape(len(self.row), -1)
        asked = cell("asked")
        names = [f.name for f in asked.type]
        field = dict(zip(names, asked.flatten(), strict=True))
        self.query, self.query_label = field["row"].to_numpy(), field["label"].to_numpy()
        self.q = np.ascontiguousarray(field["x"].flatten().to_numpy().reshape(len(self.query), -1)[:, cell("axis").to_numpy()])
        self.goals = field["goals"].to_pylist()

    def expand(self, i: np.ndarray, j: np.ndarray, value: np.ndarray, most: int) -> list[tuple[int, int, int, int]]:
        """(row, id, score) of the first ``most`` ids of ranked pairs of one query."""
        rows = [(-v, k, r) for r, v, a, b in zip(self.row[j].tolist(), value.tolist(), self.first[j].tolist(), self.first[j + 1].tolist(), strict=True) for k in self.ids[a:b].tolist()]
        return sorted(rows)[:most]


def _positives(level: float | None, most: int) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ``most`` best ids of each query's own label, among those above its threshold."""
        for batch in batches:
            for n in range(len(batch)):
                pair, made = Pair(batch, n), []
                low_id = pair.ids[pair.first[:-1]]
                for label in np.unique(pair.query_label):
                    asked = np.flatnonzero(pair.query_label == label)
                    a, b = np.searchsorted(pair.label, [label, label + 1])
                    q = pair.q[asked]
                    least = np.full(len(q), -np.inf) if level is None else level * (q.astype(np.float64) ** 2).sum(axis=1)
                    i, j, value = _ranked([(i, j + a, v) for i, j, v in joined(q, least, pair.x[a:b], pair.tail[a:b], most)], low_id)
                    edges = np.searchsorted(i, np.arange(len(q) + 1))
                    for k in range(len(q)):
                        s = slice(edges[k], min(edges[k + 1], edges[k] + most))
                        made += [(pair.query[asked[k]], row, id_, -v) for v, id_, row in pair.expand(i[s], j[s], value[s], most)]
                cells = np.array(made, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(cells[:, c]) for c in range(4)], ["query", "row", "id", "score"])

    return find


def window_of(goal: int, level: float | None) -> tuple[int, int]:
    """Least and largest score of a negative for a positive's score, at this level of thresholds."""
    low, high = -(-goal * LOWEST[0] // LOWEST[1]), goal * HIGHEST[0] // HIGHEST[1]
    return (low if level is None else max(low, int(goal * level))), high


def _negatives(level: float | None, most: int) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The ``most`` best ids of other labels in each window of each query, among those above its threshold."""
        for batch in batches:
            for n in range(len(batch)):
                pair, made = Pair(batch, n), []
                low_id = pair.ids[pair.first[:-1]]
                windows = [[(g, *window_of(g, level)) for g in goals] for goals in pair.goals]
                least = np.array([min((low for _, low, _ in w), default=np.inf) for w in windows], np.float64)
                top = np.array([max((high for _, _, high in w), default=0) for w in windows], np.int64)
                found = []
                for i, j, value in joined(pair.q, least, pair.x, pair.tail):
                    other = (pair.query_label[i] != pair.label[j]) & (value <= top[i])
                    found.append((i[other], j[other], value[other]))
                i, j, value = _ranked(found, low_id)
                edges = np.searchsorted(i, np.arange(len(windows) + 1))
                for k, asked in enumerate(windows):
                    a, b = edges[k], edges[k + 1]
                    falling = -value[a:b]
                    for goal, low, high in asked:
                        s, e = a + np.searchsorted(falling, -high, "left"), a + np.searchsorted(falling, -low, "right")
                        s = slice(s, min(e, s + most))
                        made += [(pair.query[k], goal, id_, -v) for v, id_, _ in pair.expand(i[s], j[s], value[s], most)]
                cells = np.array(made, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([pa.array(cells[:, c]) for c in range(4)], ["query", "goal", "id", "score"])

    return find


def _met(left: DataFrame, right: DataFrame, on: list[str] | str | Column, how: str = "inner") -> DataFrame:
    """A join by shuffles, never by broadcast. Spark would choose that by the size of compressed files, or of rows before an explode: a small part of
    what the driver then holds."""
    return left.join(right.hint("merge"), on, how)


def _asked(queries: DataFrame, index: DataFrame, blocks: int, find: Callable, schema: str) -> DataFrame:
    """What ``find`` makes of every block of queries with every index block of the same vector size. ``queries``: size, row, label, x, goals."""
    parts = -(-queries.count() // QUERIES)
    part = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(max(1, parts)))
    gathered = queries.groupBy("size", part.alias("part")).agg(F.collect_list(F.struct("row", "label", "x", "goals")).alias("asked"))
    dealt = gathered.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    return _met(dealt, index, ["size", "block"]).mapInArrow(find, schema)


def _best(found: DataFrame, by: list[str], order: list[Column], most: int, struct: list[str]) -> DataFrame:
    """``best``: the first rows of each group as a list of structs, in order."""
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= most)
    return ranked.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("rank", *struct))).alias("best"))


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` chooses.

    ``rows``: vec_id, label (whole numbers), embedding; other columns are passed over. A component x counts as floor(scale * x). An anchor's positives are its first other rows
    of the same label by score, ties by the smaller id; the negatives of each are the first rows of other labels with scores from a half to 95 % of the
    positive's, in the same order. Rows with a null id, label or vector, an empty vector or null or non-finite components take no part, nor do
    vectors so long that a score might not fit a long. Vectors of different sizes have no score. Rows equal in id, label and vector count once;
    other rows that repeat an id are rows of their own. An anchor without positives or negatives gives no row.
    """
    number = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * scale))
    finite = "coalesce(size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < 9e15), false)"
    named = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()).filter(finite)
    # By the Cauchy-Schwarz inequality no score exceeds the largest squared norm.
    short = F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")) < float(1 << 62)
    named = named.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), number.alias("x")).filter(short)
    most = positives + 1  # an anchor may be its own best partner
    first = F.row_number().over(Window.partitionBy("label", "x").orderBy("id"))
    kept = named.distinct().withColumn("n", first).filter(F.col("n") <= max(most, negatives))
    classes = kept.groupBy("label", "x").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = table(classes.select(F.monotonically_increasing_id().alias("row"), "label", F.size("x").alias("size"), "x", "ids"))
    blocks = max(1, -(-classes.count() // BLOCK))
    dealt = classes.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks).cast("long")))
    # A file holds about one block: Parquet's reader takes thousands of rows at once, and a row is a block here.
    index = table(dealt.repartition(blocks, "size", "block").groupBy("size", "block").applyInArrow(indexed, INDEX))

    marked = named.withColumnRenamed("id", "vec_id").filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "x").distinct()
    owned = cut(_met(marked, classes.select("label", "x", "row"), ["label", "x"]).select("anchor_id", "row"))
    queries = _met(classes.drop("ids"), owned.select("row").distinct(), "row", "left_semi").withColumn("goals", F.lit(None).cast("array<bigint>"))

    tops, open_ = [], cut(queries)
    for level in POSITIVE_LEVELS:
        found = _asked(open_, index, blocks, _positives(level, most), "query long, row long, id long, score long")
        best = cut(_best(found, ["query"], [F.desc("score"), F.asc("id"), F.asc("row")], most, ["row", "id", "score"]))
        done = best if level is None else best.filter(F.size("best") == most)
        tops.append(done)
        if level is not None:
            open_ = cut(_met(open_, done, open_["row"] == done["query"], "left_anti"))
            if open_.isEmpty():
                break
    tops = cut(_stacked(tops))

    goals = tops.select("query", F.array_distinct(F.filter("best.score", lambda s: s >= 0)).alias("goals")).filter(F.size("goals") > 0)
    open_ = cut(_met(classes.drop("ids"), goals, classes["row"] == goals["query"]).drop("query"))
    lows = []
    for level in NEGATIVE_LEVELS:
        found = _asked(open_, index, blocks, _negatives(level, negatives), "query long, goal long, id long, score long")
        best = cut(_best(found, ["query", "goal"], [F.desc("score"), F.asc("id")], negatives, ["id", "score"]))
        done = best if level is None else best.filter(F.size("best") == negatives)
        lows.append(done)
        if level is not None:
            full = done.groupBy("query").agg(F.collect_list("goal").alias("full"))
            left = _met(open_, full, open_["row"] == full["query"], "left").withColumn("goals", F.array_except("goals", F.coalesce("full", F.array().cast("array<bigint>"))))
            open_ = cut(left.drop("query", "full").filter(F.size("goals") > 0))
            if open_.isEmpty():
                break

    others = _met(owned, tops, owned["row"] == tops["query"])
    own = lambda e: (e["id"] == F.col("anchor_id")) & (e["row"] == F.col("query"))
    chosen = others.select("anchor_id", "query", F.explode(F.slice(F.filter("best", lambda e: ~own(e)), 1, positives)).alias("p"))
    pairs = chosen.select("anchor_id", "query", F.col("p.id").alias("positive_id"), F.col("p.score").alias("goal"))
    lists = _stacked(lows).withColumnsRenamed({"query": "_query", "goal": "_goal"})
    out = _met(pairs, lists, (F.col("query") == F.col("_query")) & (F.col("goal") == F.col("_goal"))).withColumn("n", F.explode("best"))
    return out.select("anchor_id", "positive_id", F.col("n.rank").alias("rank"), F.col("n.id").alias("negative_id"), F.col("goal").alias("positive_score"), F.col("n.score").alias("negative_score"))


def _stacked(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
