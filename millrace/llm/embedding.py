"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its NEAREST reference vectors (pivots) in order. Inverted lists hold the vectors
of each pivot among the first LISTED of this order; two vectors that meet in a list and share at least MIN_SHARED of
all their nearest pivots are candidates, and only these are verified by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import components, table, written

COSINE = 0.98
#: Nearest pivots that describe a vector, and how many of them two candidates share.
NEAREST, MIN_SHARED = 8, 3
#: A vector stands in the lists of this many of its nearest pivots.
LISTED = 4
#: The sample of pivots grows with the square root of the vectors, within these bounds.
LEAST_PIVOTS, MOST_PIVOTS = 64, 65536
#: Vectors of one side of a block; longer lists are dealt out over pairs of blocks.
BLOCK = 2048


def _matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column.to_pylist()])


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _describe(pivots, nearest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pivots.value
        at_dim: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.asarray(batch.column("dim"))
            tops: list = [None] * len(dims)
            for dim in np.unique(dims):
                if dim not in at_dim:  # vectors of another length get the same pivots, cut or padded
                    at_dim[dim] = np.stack([np.pad(p[:dim], (0, max(0, dim - len(p)))) for p in known])
                rows = np.nonzero(dims == dim)[0]
                for lo in range(0, len(rows), 1024):
                    some = rows[lo : lo + 1024]
                    near = -(_unit(_matrix(batch.column("embedding").take(pa.array(some)))) @ at_dim[dim].T)
                    k = min(nearest, near.shape[1])
                    first = np.argpartition(near, k - 1, axis=1)[:, :k]
                    first = np.take_along_axis(first, np.argsort(np.take_along_axis(near, first, 1), 1, kind="stable"), 1)
                    for r, top in zip(some, first.astype(np.int32)):
                        tops[r] = top
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tops, pa.list_(pa.int32()))], names=[*batch.schema.names, "nearest"])

    return run


def _link_block(cosine: float, min_shared: int, listed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"rep": pd.Series(dtype="int64"), "n_links": pd.Series(dtype="int64"), "root": pd.Series(dtype="int64")})
        pivot = int(pdf["pivot"].iloc[0])
        one_block = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        left = pdf if one_block else pdf[pdf["chunk"] == pdf["i"]]
        right = pdf if one_block else pdf[pdf["chunk"] == pdf["j"]]
        if not len(left) or not len(right):
            return none
        ta, tb = np.stack(left["nearest"].to_list()), np.stack(right["nearest"].to_list())
        names = np.unique(np.concatenate((ta.ravel(), tb.ravel())))
        held = [np.zeros((len(t), len(names)), np.float32) for t in (ta, tb)]
        for m, t in zip(held, (ta, tb)):
            np.put_along_axis(m, np.searchsorted(names, t), 1, 1)
        candidates = held[0] @ held[1].T >= min(min_shared, ta.shape[1])  # shared pivots of every two members
        if one_block:
            candidates = np.triu(candidates, 1)
        x, y = np.nonzero(candidates)
        a, b = (_unit(np.stack(side["embedding"].to_list()).astype(np.float64)) for side in (left, right))
        keep = np.zeros(len(x), bool)
        for lo in range(0, len(x), 100_000):
            i, j = x[lo : lo + 100_000], y[lo : lo + 100_000]
            s, t = ta[i, :listed], tb[j, :listed]
            both = (s[:, :, None] == t[:, None, :]).any(2)
            enough = np.where(both, s, np.iinfo(np.int32).max).min(1) == pivot  # a pair counts in one list only
            enough[enough] = np.einsum("ij,ij->i", a[i[enough]], b[j[enough]]) >= cosine
            keep[lo : lo + 100_000] = enough
        x, y = x[keep], y[keep]
        if not len(x):
            return none
        ids = np.concatenate((left["rep"].to_numpy(), right["rep"].to_numpy()))
        copies = np.concatenate((left["copies"].to_numpy(), right["copies"].to_numpy()))
        u, v = x, y + len(left)
        links = np.bincount(u, copies[v], len(ids)) + np.bincount(v, copies[u], len(ids))
        low, place = np.unique(ids, return_inverse=True)
        root = np.arange(len(low))
        u, v = place[u], place[v]
        while True:  # smallest id spreads along the links of this block, with shortcuts
            before = root.copy()
            np.minimum.at(root, u, root[v])
            np.minimum.at(root, v, root[u])
            root = root[root]
            if (root == before).all():
                break
        links = np.bincount(place, links, len(low)).astype(np.int64)
        some = links > 0
        return pd.DataFrame({"rep": low[some], "n_links": links[some], "root": low[root][some]})

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, min_shared: int = MIN_SHARED, listed: int = LISTED) -> DataFrame:
    """Link vectors (vec_id, embedding, label) of equal, non-null label by cosine.

    Returns one row per row: vec_id, n_links (other vectors linked directly), component_id
    (smallest vec_id reachable) and kept (vec_id is that smallest one). Vectors that are null, empty, zero
    or hold null or non-finite components link with nothing, nor do vectors of different length;
    such a vector is its own component. Equal vectors of one label are linked through one
    representative. A null vec_id links with nothing.

    Every vector is indexed; the pivots are a sample of vectors by hash order, sqrt(n) of them
    between LEAST_PIVOTS and MOST_PIVOTS. A list longer than BLOCK is dealt out over pairs of
    blocks, each a task of bounded size that returns one row per linked vector, never pairs.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    sound = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    key = F.md5(F.to_json(F.struct("label", "embedding")))  # doubles print in full
    sound = sound.withColumn("key", key)
    reps = written(
        sound.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"), F.first("embedding").alias("embedding"), F.first("label").alias("label"))
        .withColumn("dim", F.size("embedding"))
    )
    n = reps.count()
    wanted = min(MOST_PIVOTS, max(LEAST_PIVOTS, isqrt(n)))
    pivots = [np.asarray(r["embedding"], np.float64) for r in reps.orderBy(F.xxhash64("rep"), "rep").select("embedding").limit(wanted).collect()]
    if not pivots:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    shared = spark.sparkContext.broadcast([_unit(p[None])[0] for p in pivots])
    described = written(reps.select("rep", "copies", "label", "dim", "embedding").mapInArrow(_describe(shared, nearest), "rep long, copies long, label string, dim int, embedding array<double>, nearest array<int>"))
    entries = described.withColumn("pivot", F.explode(F.slice("nearest", 1, listed)))
    lists = entries.groupBy("label", "dim", "pivot").agg(F.count("*").alias("n")).where("n > 1")
    dealt = entries.join(lists, ["label", "dim", "pivot"]).withColumn("chunks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("label", "dim", "pivot", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "rep", "copies", "embedding", "nearest")
    linked = written(dealt.groupBy("label", "dim", "pivot", "i", "j").applyInPandas(_link_block(cosine, min_shared, listed), "rep long, n_links long, root long"))
    counts = linked.groupBy("rep").agg(F.sum("n_links").alias("n"))
    classes = components(linked.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = reps.select("key", "rep", "copies").join(counts, "rep", "left").join(classes.withColumnRenamed("id", "rep"), "rep", "left")
    known = known.select("key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    ids = rows.select("vec_id", F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)), key).alias("key"))
    out = ids.join(known, "key", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (SELECT vec_id, label, [x::DOUBLE for x in embedding] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT vec_id, label, [x / sqrt(list_dot_product(e, e)) for x in e] AS e FROM v WHERE list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) >= 0.98)
, reach AS (
  WITH RECURSIVE r(id, low) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.low FROM r JOIN links l ON l.a = r.id WHERE r.low < l.b)
  SELECT id, min(low) AS low FROM r GROUP BY id
)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, r.low AS component_id, e.vec_id = r.low AS kept
FROM embeddings e JOIN reach r ON r.id = e.vec_id LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
"""
