"""Exact substring dedup: suffix automata of reference shards, streamed for matching statistics.

Every 13-word window holds a smallest 5-word hash, its minimizer; equal windows have equal
minimizers, so only windows whose minimizer is seen in two documents can repeat, and equal
windows meet if their surroundings are routed by minimizer. The references that one automaton
would need grow with the corpus, so a broadcast of them has no bound: instead each shard of
distinct segments is routed to the task that builds its automaton and streams the
segments through it. Decisions are made on the words themselves, not on hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import BROADCAST_ROWS, later_of_equals, remove_table, small_side, table, table_path, with_row, written
from millrace.llm.words import WordHashes, pieces_of, raw_texts, signed, sliding, sliding_argmin, words_of

WINDOW = 13
GRAM = 5
#: Minimizers of more rows than this route single windows instead of whole segments.
COMMON = 500
#: Words of reference that one automaton takes (more only if one route alone has more).
SHARD_WORDS = 20_000


class SuffixAutomaton:
    """Suffix automaton of several word sequences; every state knows its smallest owner.

    Owners must be added in any order; ``finish`` carries them from each state to its suffix links.
    """

    def __init__(self):
        self.length = [0]
        self.link = [-1]
        self.next: list[dict[int, int]] = [{}]
        self.owner: list[int | None] = [None]

    def add(self, words: list[int], owner: int) -> None:
        length, link, step, owners = self.length, self.link, self.next, self.owner
        last = 0
        for w in words:
            q = step[last].get(w)
            if q is not None and length[q] == length[last] + 1:
                last = q
            else:
                cur = -1
                if q is None:
                    cur = len(length)
                    length.append(length[last] + 1)
                    link.append(0)
                    step.append({})
                    owners.append(None)
                    p = last
                    while p >= 0 and w not in step[p]:
                        step[p][w] = cur
                        p = link[p]
                    q = step[p][w] if p >= 0 else -1
                else:
                    p = last
                if q >= 0:
                    if length[p] + 1 == length[q]:
                        link[cur] = q
                    else:
                        clone = len(length)
                        length.append(length[p] + 1)
                        link.append(link[q])
                        step.append(dict(step[q]))
                        owners.append(owners[q])
                        while p >= 0 and step[p].get(w) == q:
                            step[p][w] = clone
                            p = link[p]
                        link[q] = clone
                        if cur >= 0:
                            link[cur] = clone
                        else:
                            cur = clone
                last = cur
            if owners[last] is None or owner < owners[last]:
                owners[last] = owner

    def finish(self) -> None:
        owners, link = self.owner, self.link
        for s in sorted(range(1, len(owners)), key=self.length.__getitem__, reverse=True):
            up = link[s]
            if up > 0 and owners[s] is not None and (owners[up] is None or owners[s] < owners[up]):
                owners[up] = owners[s]

    def smallest_owners(self, words: list[int], n: int) -> list[int | None]:
        """For each run of ``n`` words the smallest owner that holds it (None: no one)."""
        length, link, step, owners = self.length, self.link, self.next, self.owner
        out: list[int | None] = []
        state = matched = 0
        for i, w in enumerate(words):
            while state and w not in step[state]:
                state = link[state]
                matched = length[state]
            if w in step[state]:
                state = step[state][w]
                matched += 1
            while state and length[link[state]] >= n:
                state = link[state]
                matched = length[state]
            if i >= n - 1:
                out.append(owners[state] if matched >= n else None)
        return out


class Windows:
    """The ``n``-word windows of a slice of texts, with the minimizer of each, worked out for all texts at once."""

    def __init__(self, texts: list[bytes | None], hashes: WordHashes, n: int, k: int):
        self.words: list[bytes] = []
        ends = []
        for text in texts:
            self.words += words_of(text)
            ends.append(len(self.words))
        self.hashed = hashes.of(self.words)
        self.begins = np.array([0, *ends[:-1]], np.int64)
        of = np.repeat(np.arange(len(texts)), np.diff([0, *ends]))
        if len(self.words) < n:
            self.at = self.row = self.place = np.zeros(0, np.int64)
            self.minimizer = np.zeros(0, np.uint64)
            return
        grams = sliding(self.hashed, k)
        place = sliding_argmin(grams, n - k + 1)
        self.at = np.nonzero(of[: len(place)] == of[n - 1 :])[0]  # windows that lie in one text
        self.row, self.place = of[self.at], place[self.at]
        self.minimizer = grams[self.place]


def _emit_minimizers(n: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces_of(batches):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            w = Windows(raw_texts(batch.column("text")), hashes, n, k)
            if not len(w.at):
                continue
            new = np.ones(len(w.at), bool)  # windows next to each other mostly have one minimizer
            new[1:] = np.diff(w.place) != 0
            row, m = w.row[new], signed(w.minimizer[new])
            order = np.lexsort((m, row))
            row, m = row[order], m[order]
            new = np.ones(len(row), bool)
            new[1:] = (np.diff(row) != 0) | (np.diff(m) != 0)
            yield pa.RecordBatch.from_arrays([pa.array(m[new]), pa.array(ids[row[new]])], names=["mhash", "doc_id"])

    return run


def _emit_segments(n: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces_of(batches):
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "text_key"))
            w = Windows(raw_texts(batch.column("text")), hashes, n, k)
            if not len(w.at):
                continue
            # whether a minimizer is shared or common is the same for all documents
            shared, common = (np.unique(batch.column(c).flatten().to_numpy(zero_copy_only=False)) for c in ("shared", "common"))
            m = signed(w.minimizer)
            first = np.ones(len(m), bool)
            first[1:] = (np.diff(w.place) != 0) | (np.diff(w.row) != 0)
            lo = np.nonzero(first)[0]
            hi = np.append(lo[1:], len(m))
            plain = np.isin(m[lo], shared)
            lo, hi = lo[plain], hi[plain]
            route = m[lo]
            single = np.nonzero(np.isin(m, common))[0]
            if len(single):
                lo, hi = np.concatenate((lo, single)), np.concatenate((hi, single + 1))
                route = np.concatenate((route, signed(sliding(w.hashed, n)[w.at[single]])))
            if not len(lo):
                continue
            row, x, y = w.row[lo], w.at[lo], w.at[hi - 1] + n
            words, join = w.words, b" ".join
            segments = [join(words[i:j]) for i, j in zip(x.tolist(), y.tolist())]
            arrays = (pa.array(ids[row]), pa.array(keys[row]), pa.array((x - w.begins[row]).astype(np.int32)), pa.array(route), pa.array(segments, pa.binary()))
            yield pa.RecordBatch.from_arrays(list(arrays), names=["doc_id", "text_key", "start", "route", "segment"])

    return run


def _match_shards(n: int, shard_words: int):
    """Build an automaton of each block of routes and stream the block's segments through it."""

    def answer(block: list[tuple[bytes, int, int]]) -> list[list[int]]:
        if len(block) == 1:  # one reference alone owns all its windows
            return [[block[0][1]] * (len(block[0][0].split()) - n + 1)]
        numbers: dict[bytes, int] = {}
        number = numbers.setdefault
        rows = [[number(w, len(numbers)) for w in segment.split()] for segment, _, _ in block]
        automaton = SuffixAutomaton()
        for words, (_, owner, _) in zip(rows, block):
            automaton.add(words, owner)
        automaton.finish()
        return [automaton.smallest_owners(words, n) for words in rows]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(groups):
            segments, owners = [], []

            def tell(block):
                for (segment, _, last), own in zip(block, answer(block)):
                    if min(own) < last:  # else no row that holds the segment is told anything
                        segments.append(segment)
                        owners.append(own)

            block: list[tuple[bytes, int, int]] = []
            size = 0
            for group in groups:
                if len(group) == 1:
                    tell(group)
                else:
                    block += group
                    size += sum(s.count(b" ") + 1 for s, _, _ in group)
                    if size > shard_words:
                        tell(block)
                        block, size = [], 0
            if block:
                tell(block)
            return pa.RecordBatch.from_arrays([pa.array(segments, pa.binary()), pa.array(owners, pa.list_(pa.int64()))], names=["segment", "owners"])

        route, group, groups, held = None, [], [], 0
        for batch in batches:
            for r, s, o, last in zip(*(batch.column(c).to_pylist() for c in ("route", "segment", "owner", "last"))):
                if r != route and group:
                    groups.append(group)
                    held += len(group)
                    group = []
                    if held >= 5000:
                        yield flush(groups)
                        groups, held = [], 0
                route = r
                group.append((s, o, last))
        if group:
            groups.append(group)
        if groups:
            yield flush(groups)

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """with_row plus text_key: a hash of the text where a doc_id has several texts, else 0."""
    base = with_row(docs, ("text",))
    several = base.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("h")).groupBy("doc_id").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b")
    several = written(several.select("doc_id", F.lit(True).alias("several")))
    return base.join(small_side(several), "doc_id", "left").withColumn("text_key", F.when(F.col("several"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))).drop("several")


def _later_copies(base: DataFrame) -> DataFrame:
    """(doc_id, text_key) of rows whose whole text a smaller doc_id has too."""
    own = base.where("doc_id is not null and text is not null").select("doc_id", "text_key", F.unhex(F.md5("text")).alias("digest"))
    return written(later_of_equals(written(own), "digest", "doc_id").select("doc_id", "text_key").distinct())


def repeated_spans(base: DataFrame, n: int = WINDOW, k: int = GRAM, common: int = COMMON, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Windows of ``n`` words that also start in a row with a smaller doc_id.

    ``base``: doc_id, text, text_key. Returns doc_id, text_key and starts: the words at which such windows
    begin. Only rows with such windows appear.
    """
    base = base.where("doc_id is not null").select("doc_id", "text_key", "text")
    path = table_path(base.sparkSession)
    seen = written(base.mapInArrow(_emit_minimizers(n, k), "mhash long, doc_id long"), path)
    counts = seen.groupBy("mhash").agg(F.count("*").alias("n")).where("n > 1")
    # hot minimizers: Spark splits the skewed side of this join
    per_doc = seen.join(counts, "mhash").select("doc_id", "mhash", "n").repartition("doc_id").groupBy("doc_id").agg(
        F.collect_list(F.when(F.col("n") <= common, F.col("mhash"))).alias("shared"), F.collect_list(F.when(F.col("n") > common, F.col("mhash"))).alias("common")
    )
    found = base.join(per_doc, "doc_id").mapInArrow(_emit_segments(n, k), "doc_id long, text_key long, start int, route long, segment binary")
    segments = written(found)
    remove_table(base.sparkSession, path)
    distinct = segments.groupBy("route", "segment").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    shards = distinct.repartition("route").sortWithinPartitions("route")
    answers = shards.mapInArrow(_match_shards(n, shard_words), "segment binary, owners array<long>").select(F.unhex(F.md5("segment")).alias("key"), "owners")
    hits = F.filter(F.transform("owners", lambda o, i: F.when(o < F.col("doc_id"), F.col("start") + i)), lambda x: x.isNotNull())
    told = segments.select(F.unhex(F.md5("segment")).alias("key"), "doc_id", "text_key", "start").join(answers, "key").select("doc_id", "text_key", hits.alias("at"))
    return told.where(F.size("at") > 0).repartition("doc_id").groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("at")).alias("starts"))


def _cut(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            kept, counts, removed = [], [], []
            for text, starts, copied in zip(raw_texts(batch.column("text")), batch.column("starts"), batch.column("copied").to_pylist()):
                words = words_of(text)
                counts.append(len(words))
                if copied and len(words) >= n:
                    words = []
                elif words and starts.is_valid:
                    at = starts.values.to_numpy(zero_copy_only=False)
                    gone = np.zeros(len(words) + 1, np.int32)
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + n, -1)
                    words = [w for w, over in zip(words, np.cumsum(gone[:-1]).tolist()) if not over]
                kept.append(b" ".join(words))
                removed.append(counts[-1] - len(words))
            names = [c for c in batch.schema.names if c not in ("starts", "copied")]
            more = [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *more], names=[*names, "kept_text", "n_words", "n_removed"])

    return run


def remove_repeats(docs: DataFrame, n: int = WINDOW) -> DataFrame:
    """Remove every word covered by an ``n``-word window that a smaller doc_id holds too.

    Returns doc_id, text, row (the other input columns), kept_text (left words joined by one space),
    n_words and n_removed, one row per row of ``docs``. Null and empty texts have no words. A null
    doc_id has no order: its words stay and count for nothing. Rows that repeat a doc_id don't take
    from each other; each is judged by its own text.

    A row whose whole text a smaller doc_id has loses all its windows at once; the rest goes through the automata.
    """
    base = _keyed(docs)
    copies = _later_copies(base)
    copied = small_side(copies)
    spans = written(repeated_spans(base.join(copied, ["doc_id", "text_key"], "left_anti"), n))
    touched = spans.select("doc_id", "text_key")
    marked = base.join(copied.withColumn("copied", F.lit(True)), ["doc_id", "text_key"], "left")
    if touched.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:  # then only texts with repeats are shuffled
        ids = F.broadcast(touched)
        plain = marked.join(ids, ["doc_id", "text_key"], "left_anti").withColumn("starts", F.lit(None).cast("array<int>"))
        marked = marked.join(ids, ["doc_id", "text_key"], "left_semi").join(spans, ["doc_id", "text_key"]).unionByName(plain)
    else:
        marked = marked.join(spans, ["doc_id", "text_key"], "left")
    fields = [base.schema["doc_id"], base.schema["text"], base.schema["row"]]
    schema = T.StructType([*fields, T.StructField("kept_text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return marked.select("doc_id", "text", "row", "starts", "copied").mapInArrow(_cut(n), schema)


def cut_rows(docs: DataFrame, n: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, with repeats (see ``remove_repeats``) cut from text.

    Texts without repeats stay as they are. A column n_chars is brought in line with a cut text.
    """
    made = remove_repeats(docs, n)
    cut = F.col("n_removed") > 0
    columns = {c: F.col("text") if c == "text" else F.col("row").getField(c) for c in docs.columns}
    columns["text"] = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(cut, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return made.select(*[v.alias(k) for k, v in columns.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
