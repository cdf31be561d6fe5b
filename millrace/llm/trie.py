"""Prefix trie of conversations, totals of subtrees rolled up in depth bands.

A node is a distinct sequence of first turns. Bands are HEIGHT depths high: a node explodes only to its ancestors
inside its band, and the totals of band roots come from the same job over the tree of band roots, which is HEIGHT times
less deep. So depth d takes log_HEIGHT(d) levels, and no node explodes to more than HEIGHT rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import small_side, table, written

#: Depths of a band.
HEIGHT = 8
#: Conversations share the first turns of the one at the multiple of GROUP below their conv_id.
GROUP, MOST_SHARED = 20, 4
#: Decimal ids that stand in one piece of a digest's text, at most.
PIECE = 4096
WORD = r"[^\x20\x09-\x0D]+"


def positions(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place (from 0) in the order of their ``key``; a key of any size is spread over tasks.

    Rows are dealt by ranges of key and order and written; each range numbers its own rows, and the only key of a range that began in
    an earlier one adds the rows that it has there.
    """
    dealt = written(rows.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("_part", key).agg(F.count("*").alias("n")).withColumn("_before", F.sum("n").over(before))
    later = written(counts.where("_before > 0").select("_part", key, "_before"))
    own = F.row_number().over(Window.partitionBy("_part", key).orderBy(*order)) - 1
    found = dealt.withColumn("pos", own).join(small_side(later), ["_part", key], "left")
    return found.withColumn("pos", F.col("pos") + F.coalesce("_before", F.lit(0))).drop("_part", "_before")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: conv_id, depth (0 is an empty turn that all have), item (digest of role and text), words, last (depth of
    the conversation's last turn)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("item"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    own = written(positions(turns, "conv_id", ["turn", "role", "item"]))
    first = F.array_sort(F.collect_list(F.when(F.col("pos") < MOST_SHARED - 1, F.struct("pos", "item", "words"))))
    counts = written(own.groupBy("conv_id").agg(F.count("*").alias("n"), first.alias("first")))
    shared = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    base = counts.select(F.col("conv_id").alias("base"), "first")
    convs = counts.select("conv_id", "n", shared.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")).join(base, "base", "left")
    head = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.expr("cast(array() as array<struct<pos:bigint,item:binary,words:bigint>>)"))
    convs = convs.select("conv_id", "n", "h", head.alias("head"))
    convs = written(convs.withColumn("last", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    root = F.struct(F.lit(0).cast("long").alias("depth"), F.unhex(F.md5(F.lit(""))).alias("item"), F.lit(0).cast("long").alias("words"))
    heads = convs.select("conv_id", "last", F.explode(F.concat(F.array(root), F.transform("head", lambda x: F.struct((x["pos"] + 1).alias("depth"), x["item"].alias("item"), x["words"].alias("words"))))).alias("t"))
    rest = own.join(convs.select("conv_id", "h", F.size("head").alias("shared"), "last"), "conv_id").where("pos >= h")
    rest = rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("shared") + 1).cast("long").alias("depth"), "item", "words", "last")
    return heads.select("conv_id", "t.depth", "t.item", "t.words", "last").unionByName(rest)


def _banded(rows: DataFrame, height: int) -> DataFrame:
    """Chained keys of all prefixes, in rows conv_id, band, own (the rows of the band in order), keys, parent (the key before the band), last.

    The key before a band is that of the sequence of full bands before it, which is found in the same way.
    """
    own = F.array_sort(F.collect_list(F.struct("depth", "item", "words")))
    cells = written(rows.groupBy("conv_id", F.floor(F.col("depth") / height).alias("band")).agg(own.alias("own"), F.max("last").alias("last")))
    cells = cells.withColumn("before", F.lit(b"").cast("binary"))
    deep = not cells.where("band > 0").isEmpty()
    if deep:
        whole = F.aggregate("own", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["item"]))
        full = cells.where(F.size("own") == height).select("conv_id", F.col("band").alias("depth"), F.unhex(F.md5(whole)).alias("item"), F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("last"))
        upper = _banded(full, height).select("conv_id", F.explode(F.arrays_zip("own.depth", "keys")).alias("k"))
        upper = upper.select("conv_id", (F.col("k.depth") + 1).alias("band"), F.col("k.keys").alias("before"))
        cells = cells.drop("before").join(upper, ["conv_id", "band"], "left").withColumn("before", F.coalesce("before", F.lit(b"").cast("binary")))
    chain = F.aggregate("own", F.array("before"), lambda acc, x: F.array_append(acc, F.unhex(F.md5(F.concat(F.element_at(acc, -1), x["item"])))))
    made = cells.select("conv_id", "band", "own", "last", F.slice(chain, 2, height).alias("keys"))
    if not deep:
        return made.withColumn("parent", F.lit(None).cast("binary"))
    made = written(made)
    ends = made.where(F.size("keys") == height).select("conv_id", (F.col("band") + 1).alias("band"), F.element_at("keys", -1).alias("parent"))
    return made.join(ends, ["conv_id", "band"], "left")


def _subtrees(cells: DataFrame, values: DataFrame, height: int) -> DataFrame:
    """Sums of ``values`` (key, leaves, saved) over the subtrees of ``cells`` (conv_id, band, keys, parent)."""
    added = [F.sum(c).alias(c) for c in ("leaves", "saved")]
    nodes = cells.select(F.posexplode("keys").alias("i", "key"), "keys").select("key", F.slice("keys", F.lit(1), F.col("i") + 1).alias("above")).distinct()
    nodes = written(nodes)
    below = cells.where("band > 0").select(F.col("keys")[0].alias("key"), "parent").distinct()
    if not cells.where("band > 0").isEmpty():
        own = nodes.join(values, "key").groupBy(F.col("above")[0].alias("key")).agg(*added)
        roots = cells.select("conv_id", F.col("band").alias("depth"), F.col("keys")[0].alias("key"))
        path = F.transform(F.array_sort(F.collect_list(F.struct("depth", "key"))), lambda x: x["key"])
        upper = written(roots.groupBy("conv_id", F.floor(F.col("depth") / height).alias("band")).agg(path.alias("keys")))
        ends = upper.where(F.size("keys") == height).select("conv_id", (F.col("band") + 1).alias("band"), F.element_at("keys", -1).alias("parent"))
        totals = _subtrees(written(upper.join(ends, ["conv_id", "band"], "left")), written(own), height)
        hung = below.join(totals, "key").groupBy(F.col("parent").alias("key")).agg(*added)
        values = written(values.unionByName(hung).groupBy("key").agg(*added))
    found = nodes.join(values, "key").select(F.explode("above").alias("key"), "leaves", "saved")
    return written(found.groupBy("key").agg(*added))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each key, joined by commas; pieces come in order, and only one hash is open at a time."""
    now, digest = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if key != now:
                if digest:
                    done.append((now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in done], pa.binary()), "ends_sha256": pa.array([d for _, d in done], pa.string())})
    if digest:
        yield pa.RecordBatch.from_pydict({"key": pa.array([now], pa.binary()), "ends_sha256": [digest.hexdigest()]})


def digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """``ends`` (key, conv_id) to key, ends_sha256: the digest of the key's ids in order, joined by commas.

    The ids of a key are joined in pieces of neighbouring ids first; one task then hashes the pieces of a key one after another, as SHA-256
    takes its input in order.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    pieces = ends.groupBy("key", F.floor(F.col("conv_id") / piece).alias("piece")).agg(ids.alias("ids"))
    return pieces.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(_digest, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Nodes of the trie of rebuilt conversations (conv_id, turn, role, text in).

    Each conversation c takes the first h turns of conversation ``c - c % GROUP`` (all if it has fewer, none if it is absent), h being crc32 of its decimal id
    modulo MOST_SHARED, and then its own turns after the first h. Turns go by ``turn`` (null first), equal ones by role and the digest of the text; a null
    role or text is empty. Rows without a conv_id belong to no conversation. Returns for each distinct sequence of first turns: conv_id (smallest member), depth, parent_conv_id (null at
    the root), n_convs, n_children, n_leaves, saved_tokens (what sharing the prefixes of the subtree saves, in words) and
    ends_sha256 (of the ids of members that end here). An empty table has no node.
    """
    cells = written(_banded(rebuilt(conversations), height))
    one = cells.select("conv_id", "last", "keys", "parent", F.posexplode("own").alias("i", "t"))
    above = F.when(F.col("i") == 0, F.col("parent")).otherwise(F.get("keys", F.col("i") - 1))
    one = written(one.select("conv_id", F.get("keys", F.col("i")).alias("key"), above.alias("parent"), "t.depth", "t.words", (F.col("t.depth") == F.col("last")).alias("ends")))
    nodes = written(one.groupBy("key", "parent", "depth", "words").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")))
    children = written(nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children")))
    nodes = written(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    values = nodes.select("key", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    totals = _subtrees(cells.select("conv_id", "band", "keys", "parent"), values, height)
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    made = nodes.join(totals, "key").join(digests(one.where("ends").select("key", "conv_id")), "key", "left").join(parents, "parent", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return made.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


ORACLE = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, item) - 1 AS pos
  FROM (SELECT *, md5(length(role) || ':' || role || text) AS item, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t)
),
c AS (
  SELECT conv_id, xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))), 4294967295::BIGINT), 4294967295) % 4 AS h
  FROM t GROUP BY conv_id
),
head AS (SELECT c.conv_id, pos + 1 AS d, item, words FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND pos < h),
s AS (SELECT c.conv_id, h, count(d) AS shared FROM c LEFT JOIN head ON head.conv_id = c.conv_id GROUP BY ALL),
r AS (
  SELECT conv_id, 0 AS d, '' AS item, 0 AS words FROM c UNION ALL SELECT * FROM head
  UNION ALL SELECT o.conv_id, pos - h + shared + 1, item, words FROM o JOIN s ON s.conv_id = o.conv_id WHERE pos >= h
),
k AS (SELECT conv_id, d, words, md5(string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY d)) AS key, d = max(d) OVER (PARTITION BY conv_id) AS ends FROM r),
n AS (
  SELECT key, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(words) AS words, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM k GROUP BY key
),
p AS (SELECT n.*, k.key AS parent FROM n LEFT JOIN k ON k.conv_id = n.conv_id AND k.d = n.depth - 1),
b AS (SELECT parent, count(*) AS n_children FROM p GROUP BY parent),
v AS (SELECT p.*, coalesce(n_children, 0) AS n_children FROM p LEFT JOIN b ON b.parent = p.key),
s2 AS (SELECT k.key, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves, sum((n_convs - 1) * v.words) AS saved FROM v JOIN k ON k.conv_id = v.conv_id AND k.d <= v.depth GROUP BY k.key)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN s2 ON s2.key = v.key LEFT JOIN n u ON u.key = v.parent
"""
