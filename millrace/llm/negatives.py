"""Hard negatives by a packed R-tree (sort-tile-recursive) and best-first search under score windows.

Vectors of one label and length are tiled into shards of SHARD rows, each a packed tree: LEAF rows to a box, FANOUT boxes to
a box above. As a box bounds each coordinate, each product with an anchor's coordinate lies in an interval, and their sums bound the
scores inside. A queue opens the box of the highest bound first and drops those that lie outside all windows or below every kth
score. Anchors are broadcast in blocks of bounded size; the index is only scanned, never shuffled again.
"""

from __future__ import annotations

import heapq
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import table, table_path, written

#: Rows of a shard, rows under a leaf box, boxes under a box.
SHARD, LEAF, FANOUT = 2048, 32, 8
#: Positives of an anchor, negatives of a positive, and the window of negative scores in hundredths of the positive's.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 5, 80, 100
#: Numbers in one broadcast block of anchors, at most (32,768 anchors of 64).
ANCHOR_CELLS = 1 << 21
#: With more shards than this, a first pass over about so many gives every anchor a kth score to begin with.
SEED_SHARDS = 64
#: Rows of the sample that says along which two coordinates shards are tiled.
TILE_ROWS, MOST_SLABS = 4096, 256
SCALE = 256
#: Scaled components below this keep all scores exact in 64 bits (vectors up to 32,768 long).
MOST_COMPONENT = 1 << 24
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def str_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Sort-tile-recursive order of rows: slabs along the coordinate of largest variance, each tiled along the next, runs of ``leaf`` rows last."""
    order: list[np.ndarray] = []
    todo = [np.arange(len(x))]
    while todo:
        rows = todo.pop()
        along = rows[np.argsort(x[rows, int(np.argmax(x[rows].var(axis=0)))], kind="stable")] if len(rows) > 1 else rows
        leaves = -(-len(rows) // leaf)
        if leaves <= 1:
            order.append(along)
            continue
        slabs = max(2, round(leaves**0.5)) if leaves > 3 else leaves
        size = -(-leaves // slabs) * leaf
        todo.extend(along[lo : lo + size] for lo in reversed(range(0, len(along), size)))
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def boxes(x: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Tree over packed rows: low and high corners and smallest id of every node, and what lies below it: rows (lo, hi) of a leaf, nodes of
    others as (-lo - 1, hi). The last node is the root."""
    starts = np.arange(0, len(x), LEAF)
    low, high, least = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts), np.minimum.reduceat(ids, starts)
    below = [(int(s), int(min(s + LEAF, len(x)))) for s in starts]
    first, count = 0, len(starts)
    while count > 1:
        starts = np.arange(0, count, FANOUT)
        level = slice(first, first + count)
        below += [(-(first + int(s)) - 1, first + int(min(s + FANOUT, count))) for s in starts]
        low, high, least = (np.concatenate((v, f.reduceat(v[level], starts))) for v, f in ((low, np.minimum), (high, np.maximum), (least, np.minimum)))
        first, count = first + count, len(starts)
    return low, high, least, below


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in tile order to shards of at most SHARD rows of one label and length, each in the order of its tree."""
    held: list[tuple[int, np.ndarray]] = []
    kind = None

    def shard() -> pa.RecordBatch:
        ids, x = np.array([i for i, _ in held], np.int64), np.stack([v for _, v in held])
        order = str_order(x, LEAF)
        arrays = {"label": pa.array([kind[0]], pa.int64()), "dim": pa.array([kind[1]], pa.int32()), "ids": pa.array([ids[order]], pa.list_(pa.int64())), "cells": pa.array([x[order].ravel()], pa.list_(pa.int32()))}
        return pa.RecordBatch.from_pydict(arrays)

    for batch in batches:
        cells = batch.column("x")
        flat, at = cells.values.to_numpy(zero_copy_only=False), cells.offsets.to_numpy()
        for r, (label, i) in enumerate(zip(batch.column("label").to_pylist(), batch.column("vec_id").to_pylist())):
            row = flat[at[r] : at[r + 1]].astype(np.int32)
            if held and (len(held) >= SHARD or kind != (label, len(row))):
                yield shard()
                held.clear()
            kind = (label, len(row))
            held.append((i, row))
    if held:
        yield shard()


class Best:
    """The k best (score, id) of one window, higher scores and then smaller ids first."""

    __slots__ = ("k", "low", "high", "floor", "rows")

    def __init__(self, k: int, low: int, high: int, floor: int):
        self.k, self.low, self.high, self.floor, self.rows = k, low, high, max(low, floor), []

    def wants(self, least: int, most: int, smallest: int) -> bool:
        """May a box with scores between ``least`` and ``most``, and ids from ``smallest`` on, hold one of the best?"""
        if most < self.floor or least > self.high:
            return False
        return len(self.rows) < self.k or (-most, smallest) < self.rows[-1]

    def offer(self, score: int, i: int) -> None:
        if self.floor <= score <= self.high:
            insort(self.rows, (-score, i))
            if len(self.rows) > self.k:
                self.rows.pop()


def search_shard(x: np.ndarray, ids: np.ndarray, q: np.ndarray, found: list[list[Best]], own: np.ndarray) -> None:
    """Best-first search of a shard for each anchor (row of ``q``), into its windows; a row with the anchor's own id is passed over."""
    low, high, least, below = boxes(x, ids)
    exact = np.float64 if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[1]) < 2**53 else np.int64
    x, low, high = x.astype(exact), low.astype(exact), high.astype(exact)
    for lo in range(0, len(q), 1024):
        some = q[lo : lo + 1024].astype(exact)
        up, down = np.maximum(some, 0), np.minimum(some, 0)
        most, least_score = up @ high.T + down @ low.T, up @ low.T + down @ high.T
        for a in range(len(some)):
            windows, tops, lows = found[lo + a], most[a].tolist(), least_score[a].tolist()
            queue = [(-tops[-1], len(below) - 1)]
            while queue:
                _, node = heapq.heappop(queue)
                wanted = [w for w in windows if w.wants(lows[node], tops[node], int(least[node]))]
                if not wanted:
                    continue
                b, e = below[node]
                if b < 0:
                    for child in range(-b - 1, e):
                        heapq.heappush(queue, (-tops[child], child))
                    continue
                scores = (x[b:e] @ some[a]).astype(np.int64)
                bound = min(w.floor if len(w.rows) < w.k else max(w.floor, -w.rows[-1][0]) for w in wanted)
                for r in np.nonzero(scores >= bound)[0]:
                    s, i = int(scores[r]), int(ids[b + r])
                    if i != own[lo + a]:
                        for w in wanted:
                            w.offer(s, i)


def _searching(block, k: int, same: bool):
    """Search all shards of a task for a broadcast block of anchors: row (place in the block), window, vec_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        windows = [[Best(k, int(a), int(b), int(f)) for a, b, f in zip(*rows)] for rows in zip(anchors["low"], anchors["high"], anchors["floor"])]
        for batch in batches:
            for r in range(batch.num_rows):
                label, dim = batch.column("label")[r].as_py(), batch.column("dim")[r].as_py()
                if dim not in anchors["x"]:
                    continue
                places, x = anchors["x"][dim]
                mine = (anchors["label"][places] == label) == same
                if mine.any():
                    ids = batch.column("ids")[r].values.to_numpy()
                    cells = batch.column("cells")[r].values.to_numpy().reshape(len(ids), dim)
                    places = places[mine]
                    search_shard(cells, ids, x[mine], [windows[p] for p in places], anchors["vec_id"][places])
        rows = [(p, w, i, -s) for p, own in enumerate(windows) for w, best in enumerate(own) for s, i in best.rows]
        for lo in range(0, len(rows), 50_000):
            columns = list(zip(*rows[lo : lo + 50_000]))
            yield pa.RecordBatch.from_pydict(dict(zip(("row", "window", "vec_id", "score"), (pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.int64()))))))

    return run


def _best(tree: DataFrame, anchors: dict, k: int, same: bool, seeds) -> DataFrame:
    """The k best rows of each window of each anchor of a block: row, window, rank, vec_id, score."""
    spark = tree.sparkSession
    kind = "row int, window int, vec_id long, score long"
    run = lambda shards: shards.mapInArrow(_searching(spark.sparkContext.broadcast(anchors), k, same), kind)
    rank = F.row_number().over(Window.partitionBy("row", "window").orderBy(F.desc("score"), "vec_id"))
    ranked = lambda rows: rows.withColumn("rank", rank).where(F.col("rank") <= k)
    if seeds is None:
        return ranked(run(tree))
    first = written(ranked(run(tree.where(seeds))))
    kth = first.where(F.col("rank") == k).select("row", "window", "score").toPandas()  # at most one number for each window of the block
    floor = anchors["floor"].copy()
    floor[kth["row"], kth["window"]] = kth["score"]
    anchors = anchors | {"floor": floor}
    return ranked(first.drop("rank").unionByName(run(tree.where(~seeds))))


def packed_tree(rows: DataFrame) -> DataFrame:
    """``rows`` (label, vec_id, x: array of int) as a written table of shards: label, dim, ids, cells (their vectors one after another).

    The tiles' two coordinates, and the slabs of the first, are those of a sample of TILE_ROWS rows; every row is in a shard.
    """
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("x").limit(TILE_ROWS).toPandas()["x"]
    width = max((len(v) for v in sample), default=0)
    longest = np.stack([v for v in sample if len(v) == width]) if width else np.zeros((0, 0))
    a, b = (np.argsort(-longest.var(axis=0), kind="stable")[:2].tolist() * 2)[:2] if width else (0, 0)
    slabs = min(MOST_SLABS, max(1, round((rows.count() / SHARD) ** 0.5)))
    cuts = sorted({int(c) for c in np.quantile(longest[:, a], np.arange(1, slabs) / slabs)}) if width and slabs > 1 else []
    at = lambda c: F.coalesce(F.get("x", F.lit(c)), F.lit(0))
    slab = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= at(a))) if cuts else F.lit(0)
    tiled = rows.select("label", F.size("x").alias("dim"), slab.alias("slab"), at(b).alias("along"), "vec_id", "x")
    order = ["label", "dim", "slab", "along", "vec_id"]
    return written(tiled.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack, "label long, dim int, ids array<long>, cells array<int>"))


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """For each of ``anchors`` (rows of ``vectors``) and each of its first ``positives`` rows of the same label, the first ``negatives`` rows of other labels whose
    score s satisfies low * p <= 100 * s <= high * p, where p is the positive's score.

    Both: vec_id, label, embedding. Components become floor(SCALE * x); a score is the inner product of integers, higher ones come first, ties by smaller vec_id. Rows with a
    null vec_id, label, vector or component, a non-finite component, no component, or one beyond MOST_COMPONENT take no part. Vectors
    of different length are never compared. Rows that repeat are all found; rows with the anchor's vec_id are not its positives; an anchor that repeats is asked once.
    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.
    """
    spark = vectors.sparkSession
    tree = packed_tree(written(_scaled(vectors)))
    shards = tree.count()
    seeds = F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(max(1, shards // SEED_SHARDS))) == 0 if shards > 2 * SEED_SHARDS else None
    asked = written(_scaled(anchors).distinct())
    cells = asked.agg(F.sum(F.size("x"))).first()[0] or 0
    blocks = max(1, -(-cells // ANCHOR_CELLS)) * (2 if cells > ANCHOR_CELLS else 1)
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path = table_path(spark)
    spark.createDataFrame([], kind).write.parquet(path)
    for k in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("vec_id", "label", "x"), F.lit(blocks)) == k).orderBy("vec_id", "label", "x").toPandas()
        if not len(block):
            continue
        by_dim: dict[int, list[int]] = {}
        for p, v in enumerate(block["x"]):
            by_dim.setdefault(len(v), []).append(p)
        n = len(block)
        known = {"vec_id": block["vec_id"].to_numpy(np.int64), "label": block["label"].to_numpy(np.int64), "x": {d: (np.array(p), np.stack([block["x"][i] for i in p]).astype(np.int64)) for d, p in by_dim.items()}}
        everything = {"low": np.full((n, 1), _LEAST), "high": np.full((n, 1), _MOST), "floor": np.full((n, 1), _LEAST)}
        near = _best(tree, known | everything, positives, True, seeds).select("row", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")).toPandas()
        score = np.full((n, positives), -1)  # no window holds a score for a negative one
        score[near["row"], near["place"] - 1] = near["positive_score"]
        windows = {"low": -(-low * score // 100), "high": np.where(score < 0, _LEAST, high * score // 100), "floor": np.full((n, positives), _LEAST)}
        far = _best(tree, known | windows, negatives, False, seeds)
        near["anchor_id"] = known["vec_id"][near["row"]] if len(near) else pd.Series(dtype="int64")
        asked_for = spark.createDataFrame(near.assign(window=near["place"] - 1)[["row", "window", "anchor_id", "positive_id", "positive_score"]], "row int, window int, anchor_id long, positive_id long, positive_score long")
        made = far.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(F.broadcast(asked_for), ["row", "window"])  # a block's windows are few
        made.select(*(c.split()[0] for c in kind.split(", "))).write.mode("append").parquet(path)
    return spark.read.schema(kind).parquet(path)


def _scaled(rows: DataFrame) -> DataFrame:
    """label, vec_id, x: the rows that take part, with whole components."""
    x = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.floor(v * SCALE))
    raw = rows.select(F.col("label").cast("long").alias("label"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v * SCALE) < MOST_COMPONENT))
    return raw.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine).select("label", "vec_id", x.cast("array<int>").alias("x"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of rows whose vec_id is divisible by 7 move on by one; anchors are the rows whose vec_id is divisible by 100."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), "embedding")
    return hard_negatives(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) for x in embedding] AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5
"""
