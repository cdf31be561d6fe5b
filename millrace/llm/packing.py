"""Best-fit packing by patterns: non-negative least squares over few-document length patterns."""

from __future__ import annotations

import os
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import small_side, table, written
from millrace.llm.words import raw_texts, words_of

CAPACITY = 4096
END_ID = 1
#: Pieces of one length are numbered in groups of about this many, so that a common length is no single task.
GROUP_ROWS = 500
#: Patterns are of up to this many pieces, by length bands of equal width.
MOST_DOCS, BANDS = 6, 48
#: Room that a sequence of a fitted pattern may leave.
SPARE = 4
#: Pieces of this many shortest bands are in no pattern: they stay to fill up sequences.
FILLERS = 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Trailing marks that a lower-casing word vocabulary always splits from a letter before them.
TAIL = b".,;:!?%*&$#"
#: Texts on which shortcuts must give the ids of plain encoding, or they are not used.
PROBES = ("The quick,  brown fox.\nJumped!! Over 12.5 DOGS?", "élan Über straße; año Ça%%% x*** it's &&&a")


def byte_letters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (chr(256 + n) for n in range(256))
    return [chr(b) if b in plain else next(rest) for b in range(256)]


class ChunkIds:
    """Ids of white-space-separated chunks as little-endian bytes, remembered within a task.

    A vocabulary that drops white space gives a text the ids of its chunks, one after the other; one
    that lower-cases and never joins a letter with a mark after it gives a chunk the ids of its
    stem and its trailing marks; and a Latin stem needs only the merges. PROBES decide which of these
    holds for the vocabulary at hand; where none does, whole texts are encoded.
    """

    def __init__(self, tokenizer_path: str, chunks: int = 400_000, stems: int = 800_000):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(tokenizer_path)
        self.chunks: dict[bytes, bytes] = {}
        self.stems: dict[bytes, bytes] = {b"": b""}
        self.limits = chunks, stems
        self.letters = byte_letters()
        self.by_chunk = self.by_stem = self.by_merges = True
        for flag in ("by_merges", "by_stem", "by_chunk"):
            if all(b"".join(self.encoded([self.split(t.encode())])[0]) == np.array(self._plain(t), "<u4").tobytes() for t in PROBES):
                break
            setattr(self, flag, False)
            self.chunks.clear()
            self.stems = {b"": b""}

    def _plain(self, text: str) -> list[int]:
        return self.encoder.encode(text, add_special_tokens=False).ids

    def split(self, text: bytes | None) -> list[bytes]:
        return words_of(text) if self.by_chunk else [text] if text else []

    def _stem(self, word: bytes) -> tuple[bytes, bytes]:
        if self.by_stem:
            stem = word.rstrip(TAIL)
            if stem.isalpha():  # bytes.isalpha: ASCII alone
                return stem.lower(), word[len(stem) :]
            # a Latin letter at the end that lower-cases to one letter is parted from the marks by any word vocabulary
            if stem and b"<|" not in word and (last := stem.decode()[-1]) < "\u0250" and last.isalpha() and len(last.lower()) == 1:
                return stem.lower(), word[len(stem) :]
        return word, b""

    def _merged(self, stem: bytes) -> bytes | None:
        """Ids of a stem of Latin letters by the vocabulary's merges alone."""
        if stem.isalpha():
            return array("I", [t.id for t in self.merges(stem.decode())]).tobytes()
        text = stem.decode()
        if text.isalpha() and max(text) < "\u0250" and (text := text.lower()).isalpha() and unicodedata.is_normalized("NFC", text):
            return array("I", [t.id for t in self.merges("".join([self.letters[b] for b in text.encode()]))]).tobytes()
        return None

    def encoded(self, rows: list[list[bytes]]) -> list[list[bytes]]:
        """The ids of every chunk of every row."""
        if len(self.chunks) > self.limits[0]:
            self.chunks.clear()
        if len(self.stems) > self.limits[1]:
            self.stems = {b"": b""}
        stem, stems, chunks = self._stem, self.stems, self.chunks
        split = [(w, *stem(w)) for w in set().union(*rows).difference(chunks)]
        new = [part for part in {x[1] for x in split}.union([x[2] for x in split]) if part not in stems]
        if self.by_merges:
            self.merges = self.encoder.model.tokenize
            for w in new:
                if (ids := self._merged(w)) is not None:
                    stems[w] = ids
            new = [w for w in new if w not in stems]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            for w, e in zip(some, self.encoder.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)):
                self.stems[w] = np.array(e.ids, "<u4").tobytes()
        for w, first, tail in split:
            chunks[w] = stems[first] + stems[tail]
        known = chunks.__getitem__
        return [list(map(known, ws)) for ws in rows]


def _tokenize(tokenizer_path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        memory = ChunkIds(tokenizer_path)
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            texts = raw_texts(batch.column("text"))
            rows = batch.column("doc_id").to_pylist()
            for lo in range(0, len(texts), 256):
                made = memory.encoded([memory.split(t) for t in texts[lo : lo + 256]])
                out = defaultdict(list)
                for doc_id, ws in zip(rows[lo : lo + 256], made):
                    ids = b"".join(ws) + end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        out["doc_id"].append(doc_id)
                        out["piece"].append(piece)
                        out["start"].append(start // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                        if with_ids:
                            out["ids"].append(np.frombuffer(part, "<u4").astype(np.int32))
                fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
                if with_ids:
                    fields.append(("ids", pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in fields], names=[k for k, _ in fields])

    return run


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token ids of every whole text plus ``end_id``, cut into pieces of ``capacity`` ids.

    Columns doc_id, piece, start, length, ids_crc32 (of the little-endian unsigned 32-bit ids)
    and, with ``with_ids``, the ids themselves. The vocabulary drops white space, so each
    chunk between ASCII white space is encoded by itself and remembered in the task (a test
    compares this with encoding whole texts). A null text counts as empty: one piece that holds ``end_id``.
    A null doc_id keeps its rows. Rows that repeat are packed as often as they occur.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_tokenize(tokenizer_path or default_tokenizer(), capacity, end_id, with_ids), schema)


# --- the plan, from the histogram of piece lengths (at most ``capacity`` numbers) ------------


def bands_of(histogram: dict[int, int], capacity: int, bands: int = BANDS) -> dict[int, tuple[int, float]]:
    """Length bands of equal width that hold pieces: band -> (pieces, mean length)."""
    held: dict[int, list[int]] = defaultdict(lambda: [0, 0])
    for length, n in histogram.items():
        own = held[(length - 1) * bands // capacity]
        own[0] += n
        own[1] += n * length
    return {k: (n, total / n) for k, (n, total) in sorted(held.items()) if n}


def candidate_patterns(bands: dict[int, tuple[int, float]], capacity: int, most_docs: int = MOST_DOCS, room: float = 1 / BANDS) -> list[tuple[int, ...]]:
    """All patterns of up to ``most_docs`` bands whose mean lengths fill a sequence up to ``room`` of it."""
    order = sorted((k for k in bands if k >= FILLERS), reverse=True)
    mean = [bands[k][1] for k in order]
    found: list[tuple[int, ...]] = []

    def extend(parts: tuple[int, ...], total: float, at: int) -> None:
        if parts and total >= capacity * (1 - room):
            found.append(parts)
        left = most_docs - len(parts)
        for i in range(at, len(order)) if left else ():
            if total + mean[i] * left < capacity * (1 - room):
                break  # bands after this one are shorter still
            if total + mean[i] <= capacity:
                extend((*parts, order[i]), total + mean[i], i)

    extend((), 0.0, 0)
    return found


def fit_counts(patterns: list[tuple[int, ...]], histogram: dict[int, int], sweeps: int = 30) -> np.ndarray:
    """Non-negative least squares: repeat counts x >= 0 that bring sum(x * pattern) nearest to the histogram.

    Coordinate descent on the sparse columns (at most a few entries each): the exact minimiser in
    one coordinate, cut off at zero, again and again.
    """
    columns = [tuple(Counter(p).items()) for p in patterns]
    norms = [sum(n * n for _, n in c) for c in columns]
    rest = {length: float(n) for length, n in histogram.items()}
    x = [0.0] * len(columns)
    for _ in range(sweeps):
        moved = 0.0
        for j, column in enumerate(columns):
            step = sum(n * rest[length] for length, n in column) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                for length, n in column:
                    rest[length] -= step * n
                moved = max(moved, abs(step))
        if moved < 0.5:
            break
    return np.array(x)


def best_fit(histogram: dict[int, int], capacity: int, begun: Counter | None = None) -> Counter:
    """Best-fit decreasing of a histogram, many equal sequences at a time: pattern -> repeats.

    ``begun``: sequences that hold pieces already; those with room take more, and all are in the result.
    """
    open_bins: dict[int, Counter] = defaultdict(Counter)  # room -> pattern -> how many
    rooms: list[int] = []

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in open_bins:
            insort(rooms, room)
        open_bins[room][pattern] += n

    for pattern, n in sorted((begun or {}).items(), reverse=True):
        put(capacity - sum(pattern), pattern, n)
    for length in sorted((k for k, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                full, some = divmod(left, fit)
                if full:
                    put(capacity - fit * length, (length,) * fit, full)
                if some:
                    put(capacity - some * length, (length,) * some, 1)
                break
            room = rooms[at]
            pattern, n = next(iter(open_bins[room].items()))
            take = min(n, left)
            if take == n:
                del open_bins[room][pattern]
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            else:
                open_bins[room][pattern] -= take
            put(room - length, (*pattern, length), take)
            left -= take
    out: Counter = Counter()
    for bins in open_bins.values():
        out.update(bins)
    return out


def fitted(histogram: dict[int, int], capacity: int) -> Counter:
    """Patterns with their fitted repeats, rounded to whole ones, as the lengths of real pieces: lengths -> repeats.

    Repeats are fitted to the histogram of bands and rounded by largest remainder. In a pattern each place but the last takes the
    longest pieces left in its band, and the last the longest piece that still fits, many equal sequences at a time.
    """
    bands = bands_of(histogram, capacity)
    patterns = candidate_patterns(bands, capacity)
    x = fit_counts(patterns, {k: n for k, (n, _) in bands.items()})
    repeats = np.floor(x).astype(int)
    for j in np.argsort(repeats - x, kind="stable")[: int(round((x - repeats).sum()))]:
        repeats[j] += 1
    left = dict(histogram)
    lengths = sorted(left)
    in_band: dict[int, list[int]] = defaultdict(list)
    for length in lengths:
        in_band[(length - 1) * BANDS // capacity].append(length)
    chosen: Counter = Counter()

    def longest(of: list[int], most: int, taken: list[int]) -> int | None:
        """The longest piece of at most ``most`` that is left beside ``taken``; lengths that are used up leave ``of``."""
        at = bisect_left(of, most + 1) - 1
        while at >= 0:
            if not left[of[at]]:
                of.pop(at)
            elif left[of[at]] > taken.count(of[at]):
                return of[at]
            at -= 1
        return None

    for j in np.argsort([len(p) for p in patterns], kind="stable").tolist():
        todo = int(repeats[j])
        while todo > 0:
            own: list[int] = []
            for k in patterns[j][:-1]:
                if (got := longest(in_band[k], capacity - sum(own), own)) is None:
                    break
                own.append(got)
            if len(own) < len(patterns[j]) - 1 or (got := longest(lengths, capacity - sum(own), own)) is None:
                break
            own.append(got)
            if capacity - sum(own) > SPARE or (got - 1) * BANDS // capacity < max(FILLERS, patterns[j][-1] - 1):
                break  # a later pattern or best fit makes more of these pieces
            need = Counter(own)
            n = min(todo, *(left[length] // k for length, k in need.items()))
            chosen[tuple(sorted(own, reverse=True))] += n
            todo -= n
            for length, k in need.items():
                left[length] -= n * k
    return chosen


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that together use every counted length exactly.

    What the fitted patterns leave over is packed by ``best_fit`` into the room they leave and into new sequences.
    """
    chosen = fitted(histogram, capacity)
    left = Counter(histogram)
    for pattern, n in chosen.items():
        for length in pattern:
            left[length] -= n
    return sorted(best_fit(left, capacity, chosen).items(), reverse=True)


def _assign(shared):
    """shared: length -> rows (first rank, first sequence, offset), sorted by first rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps: dict[int, np.ndarray] = shared.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            seq = np.empty(len(length), np.int64)
            off = np.empty(len(length), np.int64)
            for one in np.unique(length):
                at = np.nonzero(length == one)[0]
                first, base, offset = steps[int(one)].T
                k = np.searchsorted(first, rank[at], "right") - 1
                seq[at] = base[k] + rank[at] - first[k]
                off[at] = offset[k]
            kept = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(seq), pa.array(off)], names=[*kept, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (any columns besides a ``length`` of 1..capacity).

    The histogram of lengths (at most ``capacity`` rows) is all that reaches the driver; there the
    plan is made. Every piece gets its rank among the pieces of its length: a length is numbered in groups of
    about GROUP_ROWS rows, and grouped counts give each group its first rank. The plan maps ranges of ranks to a
    place in a run of equal sequences. No pieces give no rows; pieces that repeat are packed as often as they occur.
    """
    spark = pieces.sparkSession
    held = written(pieces.withColumn("_u", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["count"] for r in held.groupBy("length").count().collect()}
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    if not histogram:
        return spark.createDataFrame([], f"{fields}, sequence_id long, offset long")
    steps: dict[int, list] = defaultdict(list)
    used: Counter = Counter()
    base = 0
    for pattern, repeats in plan(histogram, capacity):
        offset = 0
        for length in pattern:
            steps[length].append((used[length], base, offset))
            used[length] += repeats
            offset += length
        base += repeats
    tables = spark.sparkContext.broadcast({length: np.array(rows, np.int64) for length, rows in steps.items()})

    groups = spark.createDataFrame([(k, -(-n // GROUP_ROWS)) for k, n in histogram.items()], "length long, _groups long")
    grouped = held.withColumn("length", F.col("length").cast("long")).join(F.broadcast(groups), "length").withColumn("_g", F.pmod(F.xxhash64("_u"), F.col("_groups")))
    counts = grouped.groupBy("length", "_g").count()
    before = Window.partitionBy("length").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    firsts = written(counts.select("length", "_g", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first")))
    order = Window.partitionBy("length", "_g").orderBy("doc_id", "piece", "_u")
    ranked = grouped.withColumn("_n", F.row_number().over(order) - 1).join(small_side(firsts), ["length", "_g"])
    ranked = ranked.select(*(F.col(f.name).cast(f.dataType) for f in pieces.schema.fields), (F.col("_first") + F.col("_n")).cast("long").alias("rank"))
    return ranked.mapInArrow(_assign(tables), f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenise and pack documents (see ``token_pieces`` and ``pack``)."""
    return pack(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
