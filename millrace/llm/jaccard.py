"""N-gram Jaccard join: size-aware heavy-light set similarity join with exact results.

Small sets enumerate their fixed-size subsets and meet in equal subsets. Large sets meet in
inverted lists of their prefix: the part of the set that two sets of the wanted similarity must
share, in an order that puts heavy (frequent) shingles last, so that lists of passages
which many documents share are hardly read. The size that parts small from large is chosen by cost.

Which shingles are heavy comes from a count of all shingles of all documents into a fixed number
of cells: the order is right for any counts, and items of a given share of the corpus stand
out equally at every size. Every candidate is verified on its whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import components, later_of_equals, small_side, table, written
from millrace.llm.words import WordHashes, pieces_of, raw_texts, shingles, signed, words_of

SHINGLE = 5
#: Similarity as a fraction: 80 / 100.
NUMER, DENOM = 80, 100
CELLS, BLOCK = 1 << 20, 1 << 12
#: Counts of a block of cells are first summed in this many groups.
CELL_GROUPS = 1024
#: Lists that a pair must share; prefixes are longer by one less than this.
SHARE = 4
#: A subset says as much as any number of single shingles.
SUBSET_WEIGHT = 1 << 20
#: Cost of one entry of an inverted list against one enumerated subset, and the largest boundary tried.
LIST_COST, MOST_SMALL = 3, 14
LEAST_SMALL = 5
#: A list of more members than this is read in blocks of BLOCK_ROWS inside tasks, without making rows of its pairs.
HOT_LIST, BLOCK_ROWS = 128, 1024
#: Bytes of its digest that tell a text from the others of its doc_id.
TAG_BYTES = 7


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; ``bytes.lower`` changes only these."""
    return text.lower().split() if text else []


def _least(n: int) -> int:
    """Shared shingles that a set of n needs with its smallest possible partner."""
    return -(-NUMER * n // DENOM)


def _subset_size(n: int) -> int:
    """Shared shingles that two sets need whose smaller one has n."""
    return -(-2 * NUMER * n // (NUMER + DENOM))


def subset_sizes(n: int) -> list[int]:
    """Sizes of the subsets that a small set of n enumerates: one for each smaller set it may meet."""
    return sorted({_subset_size(a) for a in range(_least(n), n + 1)})


def n_subsets(n: int) -> int:
    return sum(comb(n, c) for c in subset_sizes(n))


def prefix_length(n: int) -> int:
    return min(n, n - _least(n) + SHARE)


def boundary(sizes: dict[int, int]) -> int:
    """Largest size of a small set, by the cost of subsets against list entries over all sets."""
    best, best_cost = LEAST_SMALL, None
    cost = 0.0
    for n in range(1, MOST_SMALL + 1):
        cost += sizes.get(n, 0) * (n_subsets(n) - LIST_COST * prefix_length(n))
        if n >= LEAST_SMALL and (best_cost is None or cost < best_cost):
            best, best_cost = n, cost
    return best


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _profile(n: int):
    """Digest and set size of each document, and this task's counts of all its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        counts = np.zeros(CELLS, np.int64)
        fields = [("doc_id", pa.int64()), ("digest", pa.binary()), ("n_shingles", pa.int64()), ("block", pa.int32()), ("width", pa.int32()), ("cells", pa.binary())]
        for batch in batches:
            digests, sizes = [], []
            for text in raw_texts(batch.column("text")):
                words = lower_words(text)
                own = shingles(words, hashes, n)
                np.add.at(counts, (own >> np.uint64(44)).astype(np.int64), 1)
                digests.append(_digest(words) if words else None)
                sizes.append(len(own))
            none = [None] * len(sizes)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, t) for v, (_, t) in zip((digests, sizes, none, none, none), fields[1:]))], names=[k for k, _ in fields])
        blocks = [counts[at : at + BLOCK] for at in range(0, CELLS, BLOCK)]
        widths = [1 if b.max() < 256 else 2 if b.max() < 65536 else 8 for b in blocks]
        none = [None] * len(blocks)
        packed = [b.astype(f"<u{w}").tobytes() for b, w in zip(blocks, widths)]
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, (_, t) in zip((none, none, none, range(len(blocks)), widths, packed), fields)], names=[k for k, _ in fields])

    return run


def _add_cells(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK, np.int64)
    for w, data in zip(pdf["width"], pdf["cells"]):
        total += np.frombuffer(data, f"<u{w}").astype(np.int64)
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "width": [8], "cells": [total.astype("<u8").tobytes()]})


def _emit_postings(n: int, small: int, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        counts = weights.value
        for batch in pieces_of(batches, 512):
            out_h, out_d, out_n, out_w, out_t = [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_numpy(zero_copy_only=False), raw_texts(batch.column("text"))):
                words = lower_words(text)
                own = shingles(words, hashes, n)
                size = len(own)
                if not size:
                    continue
                h, w = [], []
                if size <= small:
                    for c in subset_sizes(size):
                        tag = c.to_bytes(2, "little")
                        for some in combinations(range(size), c):
                            h.append(xxhash.xxh3_64_intdigest(tag + own[list(some)].tobytes()))
                    w = [SUBSET_WEIGHT] * len(h)
                if size > small or size >= _least(small + 1):
                    order = np.argsort(counts[(own >> np.uint64(44)).astype(np.int64)], kind="stable")
                    top = own[order[: prefix_length(size)]]
                    h += top.tolist()
                    w += [1] * len(top)
                out_h.append(np.array(h, np.uint64))
                out_w.append(np.array(w, np.int32))
                out_d.append(np.full(len(h), doc_id, np.int64))
                out_n.append(np.full(len(h), size, np.int32))
                out_t.append(np.full(len(h), int.from_bytes(_digest(words)[:TAG_BYTES], "big"), np.int64))
            if out_h:
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(out_h))), *(pa.array(np.concatenate(v)) for v in (out_d, out_n, out_w, out_t))], names=["h", "doc_id", "size", "w", "tag"])

    return run


def _count_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one block (or pair of blocks) of a long list that are of different classes and share enough lists."""
    this = pdf["h"].iloc[0]
    one_block = pdf["i"].iloc[0] == pdf["j"].iloc[0]
    left = pdf if one_block else pdf[pdf["chunk"] == pdf["i"]]
    right = pdf if one_block else pdf[pdf["chunk"] == pdf["j"]]
    if not len(left) or not len(right) or pdf["cls"].nunique() < 2:
        return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})

    def entries(side: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        h, w = np.concatenate(side["hs"].to_list()), np.concatenate(side["ws"].to_list())
        row = np.repeat(np.arange(len(side)), [len(x) for x in side["hs"]])
        order = np.argsort(h, kind="stable")
        h, w, row = h[order], w[order], row[order]
        names, start = np.unique(h, return_index=True)
        return names, start, np.append(start[1:], len(h)), row, w

    names_a, lo_a, hi_a, row_a, w_a = entries(left)
    names_b, lo_b, hi_b, row_b, _ = entries(right)
    both, at_a, at_b = np.intersect1d(names_a, names_b, assume_unique=True, return_indices=True)
    count = np.zeros((len(left), len(right)), np.int64)
    hot_before = np.zeros(count.shape, bool)  # the pair is told by the first long list that it shares
    first = np.zeros(count.shape, bool)
    for name, x, y in zip(both.tolist(), at_a.tolist(), at_b.tolist()):
        place = np.ix_(row_a[lo_a[x] : hi_a[x]], row_b[lo_b[y] : hi_b[y]])
        weight = int(w_a[lo_a[x]])
        if name == this:
            first[place] = ~hot_before[place]
        elif weight < 0 and name < this:
            hot_before[place] = True
        count[place] += abs(weight)
    m, n = left["size"].to_numpy()[:, None].astype(np.int64), right["size"].to_numpy()[None, :].astype(np.int64)
    small, large = np.minimum(m, n), np.maximum(m, n)
    need = np.maximum(SHARE, -(-NUMER * (m + n) // (NUMER + DENOM)) + NUMER * -large // DENOM + SHARE)
    fine = first & (left["cls"].to_numpy()[:, None] != right["cls"].to_numpy()[None, :]) & (DENOM * small >= NUMER * large) & (count >= need)
    if one_block:
        fine = np.triu(fine, 1)
    x, y = np.nonzero(fine)
    a, b = left["doc_id"].to_numpy()[x], right["doc_id"].to_numpy()[y]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def _verify(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        last, last_set = None, None
        for batch in pieces_of(batches, 512):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(raw_texts(batch.column("text_a")), raw_texts(batch.column("text_b")))):
                if x != last:
                    last, last_set = x, shingles(lower_words(x), hashes, n)
                other = shingles(lower_words(y), hashes, n)
                both = len(np.intersect1d(last_set, other, assume_unique=True))
                if both and DENOM * both >= NUMER * (len(last_set) + len(other) - both):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], names=["a", "b"])

    return run


def verified(pairs: DataFrame, base: DataFrame, n: int) -> DataFrame:
    """Those pairs (a, b) whose texts reach the similarity. ``pairs`` should be a written table."""
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    texts = base.join(small_side(ids), "doc_id", "left_semi")
    rows = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")
    return written(rows.mapInArrow(_verify(n), "a long, b long"))


def _needed(x: Column, y: Column) -> Column:
    """Lists that two sets of these sizes must share.

    Common shingles up to the smaller of the two prefix ends all count; of those after it there
    are at most size - prefix.
    """
    overlap = F.ceil(NUMER * (x + y) / F.lit(NUMER + DENOM))
    return F.greatest(F.lit(SHARE), overlap - F.ceil(NUMER * F.greatest(x, y) / F.lit(DENOM)) + SHARE)


def _fits(x: Column, y: Column) -> Column:
    return (DENOM * F.least(x, y)) >= (NUMER * F.greatest(x, y))


def near_duplicates(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """Classes of documents linked by Jaccard similarity >= 0.8 of their ``n``-word shingle sets.

    Returns one row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id
    reachable by links, itself included). Exact: no cap on lists, partners or candidates.

    1. Equal word sequences are linked by digest; one representative of each goes on.
    2. Inverted lists (subset and prefix entries) that two representatives share are kept.
    3. In each list and size band all link up with the smallest member, after verification.
    4. Only pairs that are still in different classes are then looked up, in all lists: first
       by class, then by document, counted against the number of lists they must share. Long lists are
       counted block by block inside tasks; only pairs that share enough leave them.

    Null and empty texts have no shingles and link with nothing. A null doc_id keeps its row, with
    a null class. Rows that repeat a doc_id are one node with the links of all of them; only the text that is a
    copy leaves the lists, and pairs are counted for each size of either side.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = written(base.mapInArrow(_profile(n), "doc_id long, digest binary, n_shingles long, block int, width int, cells binary"))
    rows = profile.where("block is null").select("doc_id", "digest", "n_shingles")
    # summed in two steps, so that no group holds the counts of all tasks
    part = profile.where("block is not null").select("block", "width", "cells").groupBy("block", F.pmod(F.xxhash64("cells"), F.lit(CELL_GROUPS)))
    cells = part.applyInPandas(_add_cells, "block int, width int, cells binary").groupBy("block").applyInPandas(_add_cells, "block int, width int, cells binary")
    weights = np.zeros(CELLS, np.uint32)
    for r in cells.collect():  # CELLS / BLOCK rows
        weights[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.minimum(np.frombuffer(r["cells"], "<u8"), 2**32 - 1)
    small = boundary({r["n_shingles"]: r["n"] for r in rows.where(F.col("n_shingles").between(1, MOST_SMALL)).groupBy("n_shingles").agg(F.count("*").alias("n")).collect()})

    nodes = rows.where("doc_id is not null and digest is not null")
    tag = F.conv(F.hex(F.substring("digest", 1, TAG_BYTES)), 16, 10).cast("long")
    gone = written(later_of_equals(nodes, "digest", "doc_id").select(F.col("first").alias("a"), F.col("doc_id").alias("b"), tag.alias("tag")).distinct())
    copies = gone.select("a", "b")

    shared = spark.sparkContext.broadcast(weights)
    postings = written(base.where("doc_id is not null").mapInArrow(_emit_postings(n, small, shared), "h long, doc_id long, size int, w int, tag long"))
    lists = postings.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    met = postings.join(lists, "h").join(small_side(gone.select(F.col("b").alias("doc_id"), "tag").distinct()), ["doc_id", "tag"], "left_anti").drop("tag")
    # bands of sizes that may match: log base 1.25
    met = written(met.withColumn("band", F.floor(F.log("size") / F.log(F.lit(DENOM / NUMER))).cast("int")))

    centers = met.groupBy("h", "band").agg(F.min(F.struct("doc_id", "size")).alias("c"), F.count("*").alias("n")).where("n > 1").select("h", "band", F.col("c.doc_id").alias("a"), F.col("c.size").alias("size_a"))
    stars = met.join(centers, ["h", "band"]).where("doc_id > a").groupBy("a", F.col("doc_id").alias("b"), F.col("size_a").alias("x"), F.col("size").alias("y")).agg(F.sum("w").alias("w"))
    stars = written(stars.where(_fits(F.col("x"), F.col("y")) & (F.col("w") >= _needed(F.col("x"), F.col("y")))).select("a", "b").distinct())
    links = copies.unionByName(verified(stars, base, n))

    classes = written(components(links))
    classed = met.join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("cls", F.coalesce("component_id", "doc_id")).select("h", "doc_id", "size", "w", "cls")
    mixed = classed.groupBy("h").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi").select("h")
    classed = written(classed.join(mixed, "h"))
    sizes = written(classed.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > HOT_LIST))
    cold = classed.join(sizes, "h", "left_anti")
    in_list = cold.groupBy("h", "cls").agg(F.max("w").alias("w"))
    meet = in_list.select("h", F.col("cls").alias("c1"), "w").join(in_list.select("h", F.col("cls").alias("c2")), "h").where("c1 < c2")
    close = meet.groupBy("c1", "c2").agg(F.sum("w").alias("w")).where(F.col("w") >= SHARE).select("c1", "c2")
    meet = meet.join(close, ["c1", "c2"]).select("h", "c1", "c2")
    left = cold.select("h", F.col("cls").alias("c1"), F.col("doc_id").alias("d1"), F.col("size").alias("s1"), "w")
    right = cold.select("h", F.col("cls").alias("c2"), F.col("doc_id").alias("d2"), F.col("size").alias("s2"))
    pairs = meet.join(left, ["h", "c1"]).join(right, ["h", "c2"]).where(_fits(F.col("s1"), F.col("s2")))
    pairs = pairs.groupBy(F.least("d1", "d2").alias("a"), F.greatest("d1", "d2").alias("b"), F.col("s1").alias("x"), F.col("s2").alias("y")).agg(F.sum("w").alias("w"))
    pairs = pairs.where(F.col("w") >= _needed(F.col("x"), F.col("y"))).select("a", "b")
    # pairs that share a hot list, counted over all the lists of both
    members = classed.join(sizes, "h").withColumn("chunks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
    marked = classed.join(sizes, "h", "left").withColumn("w", F.when(F.col("n").isNotNull(), -F.col("w")).otherwise(F.col("w")))  # below zero: a long list
    own = marked.join(members.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_list(F.struct("h", "w")).alias("e")).select("doc_id", F.col("e.h").alias("hs"), F.col("e.w").alias("ws"))
    dealt = members.join(own, "doc_id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("h", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "doc_id", "size", "cls", "hs", "ws")
    hot = dealt.groupBy("h", "i", "j").applyInPandas(_count_block, "a long, b long")
    pairs = written(pairs.unionByName(hot).distinct())
    links = links.unionByName(verified(pairs, base, n))

    found = components(links)
    return rows.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
