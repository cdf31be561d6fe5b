"""Benchmark decontamination by templates: re-parameterised questions count as leaks too."""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import table, with_row, written
from millrace.llm.words import raw_texts, words_of

WINDOW = 13
#: With changed slots an item needs so many words, and a window this share of plain words; verbatim copies need neither.
LEAST_WORDS, PLAIN_SHARE = 5, 0.5
#: Words that are looked up together.
AT_ONCE = 20_000
#: Bytes of benchmark text that are broadcast at once; a larger benchmark is taken in several blocks.
BLOCK_BYTES = 16_000_000
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces t ton tons tonne tonnes "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "kmh mph kph ms w kw kwh j kj v a hz khz mhz ghz kb mb gb tb c f k percent % $ dollar dollars euro euros eur usd cent cents".split()
)
NUMBER = re.compile(r"[$€£+-]?\d+(?:[.,:/]\d+)*(?:st|nd|rd|th)?([A-Za-z%°$€£]*)\Z")
EDGES = ".,;:!?\"'()[]{}<>*#&|"
_NUM, _NUM_UNIT, _NAME, _UNIT = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b"\0num", b"\0num-unit", b"\0name", b"\0unit"))


class Templates:
    """Canonical tokens of words; remembers each word's readings."""

    def __init__(self, limit: int = 300_000):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {}
        self.plain = np.zeros(4096, np.uint64)  # the word itself, without case and outer punctuation
        self.first = np.zeros(4096, np.uint64)  # reading at the start of a sentence
        self.inside = np.zeros(4096, np.uint64)  # reading within one
        self.flags = np.zeros(4096, np.int64)  # 1: ends a sentence, 2: a number, 4: a unit word

    def _read(self, word: bytes) -> int:
        raw = word.decode(errors="replace")
        bare = raw.strip(EDGES)
        ends = 1 if raw.rstrip("\"')]}*").endswith((".", "!", "?", ":")) else 0
        m = None if bare.isalpha() else NUMBER.match(bare)
        lower = bare.lower()
        plain = xxhash.xxh3_64_intdigest(lower.encode() or word)
        if m:
            first = inside = int(_NUM_UNIT if m[1] else _NUM)
            flags = ends | (0 if m[1] else 2)
        else:
            first = inside = xxhash.xxh3_64_intdigest(lower.encode())
            if len(bare) > 1 and bare[0].isupper() and bare[1:].islower():
                inside = int(_NAME)
            flags = ends | (4 if lower in UNITS else 0)
        at = self.at[word] = len(self.at)
        if at == len(self.first):
            self.plain, self.first, self.inside, self.flags = (np.concatenate((x, np.zeros_like(x))) for x in (self.plain, self.first, self.inside, self.flags))
        self.plain[at], self.first[at], self.inside[at], self.flags[at] = plain, first, inside, flags
        return at

    def of(self, words: list[bytes], starts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Three tokens of each word of texts that begin at ``starts``: the word itself; its canonical token
        (numbers, units after numbers and names inside a sentence are placeholders, other words hashes);
        and the same with every capitalised word as a name."""
        if len(self.at) > self.limit:
            self.clear()
        known = self.at
        try:
            idx = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        except KeyError:
            for w in set(words).difference(known):
                self._read(w)
            idx = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        first, inside, flags = self.first[idx], self.inside[idx], self.flags[idx]
        before = np.concatenate(([1], flags[:-1]))
        before[starts] = 1
        units = (before & 2 > 0) & (flags & 4 > 0)
        near = np.where(before & 1, first, inside)
        near[units] = inside[units] = _UNIT
        return self.plain[idx], near, inside


def is_slot(tokens: np.ndarray) -> np.ndarray:
    return (tokens == _NUM) | (tokens == _NUM_UNIT) | (tokens == _NAME) | (tokens == _UNIT)


class Powers:
    """Hashes of all runs of n values from running sums, for many n at the cost of one."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        if len(values) >= len(self.up):
            full = np.ones(2 * len(values) + 1, np.uint64)
            full[1:] = self.BASE
            self.up = np.cumprod(full, dtype=np.uint64)
            full[1:] = pow(self.BASE, -1, 1 << 64)
            self.down = np.cumprod(full, dtype=np.uint64)
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, n: int) -> np.ndarray:
        m = len(sums) - n
        return (sums[n:] - sums[:m]) * self.down[:m] if m > 0 else np.zeros(0, np.uint64)


class Index:
    """Windows of benchmark items: sorted hashes, and which item and place each is.

    Every window is held by its plain words, so that a verbatim copy is found whatever its words are.
    Windows of ``LEAST_WORDS`` at least with enough plain words are held by their templates too, with each
    capitalised sentence start (an item's first word is one) read both as a plain word and as a name; windows with more
    than ``BOTH`` of them have the readings that repeat after as many.
    """

    BOTH = 4

    def __init__(self, items: list[tuple[int, str]], n: int):
        read, powers = Templates(), Powers()
        self.n = n
        self.ids = [i for i, _ in items]
        self.words: list[tuple[np.ndarray, np.ndarray]] = []
        found: dict[tuple[int, bool], list] = defaultdict(list)
        for key, (_, text) in enumerate(items):
            words = words_of((text or "").encode())
            plain, near, far = read.of(words, [0]) if words else (np.zeros(0, np.uint64),) * 3
            self.words.append((plain, far))
            if not words:
                continue
            size = min(n, len(words))
            found[size, True].append((powers.runs(powers.sums(plain), size), key, np.arange(len(words) - size + 1)))
            if len(words) >= LEAST_WORDS:
                for tokens in self._readings(near, far):
                    slots = np.convolve(is_slot(tokens), np.ones(size, int), "valid")
                    at = np.nonzero(size - slots >= PLAIN_SHARE * size)[0]
                    found[size, False].append((powers.runs(powers.sums(tokens), size)[at], key, at))
        self.places = {}
        for kind, parts in found.items():
            rows = np.zeros(sum(len(h) for h, _, _ in parts), [("hash", np.uint64), ("key", np.int32), ("at", np.int32)])
            k = 0
            for h, key, at in parts:
                rows["hash"][k : k + len(h)], rows["key"][k : k + len(h)], rows["at"][k : k + len(h)] = h, key, at
                k += len(h)
            if k:
                rows = np.unique(rows)
                self.places[kind] = tuple(np.ascontiguousarray(rows[c]) for c in ("hash", "key", "at"))

    def _readings(self, near: np.ndarray, far: np.ndarray) -> Iterator[np.ndarray]:
        starts = near != far
        order = (np.cumsum(starts) - 1) % self.BOTH
        for pattern in range(1 << min(self.BOTH, int(starts.sum()))):
            yield np.where(starts & (pattern >> order & 1 > 0), far, near)

    def open(self) -> Index:
        """Make the gates: which upper bits of a hash occur."""
        self.powers, self.gates = Powers(), {}
        for kind, (hs, _, _) in self.places.items():
            bits = min(24, max(16, len(hs).bit_length() + 6))
            gate = np.zeros(1 << bits, bool)
            gate[(hs >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.gates[kind] = np.uint64(64 - bits), gate
        return self

    def _hits(self, own: np.ndarray, kind: tuple[int, bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, place in the item) of windows with equal hashes."""
        (hs, keys, places), (shift, gate) = self.places[kind], self.gates[kind]
        maybe = np.nonzero(gate[(own >> shift).astype(np.int64)])[0]
        lo, hi = np.searchsorted(hs, own[maybe], "left"), np.searchsorted(hs, own[maybe], "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else lo
        return np.repeat(maybe, n), keys[at].astype(np.int64), places[at].astype(np.int64)

    def leaks(self, texts: list[list[bytes]], read: Templates) -> list[list[tuple[int, int, int, int]]]:
        """For each text (item, words matched, first word in the text, changed slots) of consistent matches."""
        ends = np.cumsum([len(w) for w in texts])
        starts = ends - [len(w) for w in texts]
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        if not self.places or not len(ends) or not ends[-1]:
            return [[] for _ in texts]
        plain, near, far = read.of([w for t in texts for w in t], starts[ends > starts].tolist())
        readings = [(True, plain), (False, near), *([(False, far)] if (near != far).any() else [])]
        found = []
        for verbatim, tokens in readings:
            sums = self.powers.sums(tokens)
            for kind in self.places:
                if kind[1] == verbatim:
                    i, key, j = self._hits(self.powers.runs(sums, kind[0]), kind)
                    doc = np.searchsorted(ends, i, "right")
                    row = np.stack((doc, key, i - j, i), 1)[i + kind[0] <= ends[doc]]
                    if verbatim and kind[0] < self.n and len(row):  # whole items: the last copy is as good as all
                        row = row[np.lexsort((row[:, 3], row[:, 1], row[:, 0]))]
                        row = row[np.append((row[1:, :2] != row[:-1, :2]).any(1), True)]
                    found.append(row)
        rows = np.concatenate(found)
        if len(rows):
            rows = np.unique(rows, axis=0)
            cuts = np.nonzero((rows[1:, :3] != rows[:-1, :3]).any(1))[0] + 1
            for part in np.split(rows, cuts):
                doc, key, shift = part[0, :3].tolist()
                got = self._longest(key, shift, part[:, 3], int(starts[doc]), int(ends[doc]), plain, far)
                if got[0]:
                    got = (got[0], got[1] - int(starts[doc]), got[2])
                    best[doc][key] = max(best[doc].get(key, (0, 0, 0)), got)
        return [[(self.ids[key], *x) for key, x in sorted(b.items())] for b in best]

    def _longest(self, key: int, shift: int, at: np.ndarray, begin: int, end: int, plain: np.ndarray, far: np.ndarray) -> tuple[int, int, int]:
        """(words, first word, changed slots) of the longest consistent stretch of the windows at ``at``, which
        lie along one shift of item and text.

        Consistent: verbatim, or every value of the item stands for one value of the text and back. A name of
        several words counts whole, even where the stretch ends within it.
        """
        own, own_far = self.words[key]
        size = min(self.n, len(own))
        begin, end = max(begin, shift), min(end, shift + len(own))
        a, b = own[begin - shift : end - shift], plain[begin:end]
        both = own_far[begin - shift : end - shift] == far[begin:end]
        same, slot, name = a == b, both & is_slot(far[begin:end]), both & (far[begin:end] == _NAME)
        at = at - begin
        total = lambda x: np.concatenate(([0], np.cumsum(x)))
        wrong, differ, changed = total(~(same | both)), total(~same), total(slot & ~same)
        at = at[wrong[at + size] == wrong[at]]
        best = (0, 0, 0)

        def joined(of: np.ndarray) -> list[np.ndarray]:
            return [x for x in np.split(of, np.nonzero(np.diff(of) > size)[0] + 1) if len(x)]

        for run in joined(at[differ[at + size] == differ[at]]):
            best = max(best, (int(run[-1] + size - run[0]), int(run[0]) + begin, 0))
        if not differ[-1]:
            return best
        for run in (x.tolist() for x in joined(at)):
            values: dict = defaultdict(lambda: defaultdict(int))
            clashes = 0
            first, left = 0, self._whole(name, run[0], -1)
            right = left
            for last, s in enumerate(run):
                for k in range(right, stop := max(right, self._whole(name, s + size, 1))):
                    if slot[k]:
                        for x, y in (((0, int(a[k])), int(b[k])), ((1, int(b[k])), int(a[k]))):
                            values[x][y] += 1
                            clashes += values[x][y] == 1 and len(values[x]) == 2
                right = stop
                while clashes and first <= last:
                    first += 1
                    stop = self._whole(name, run[first], -1) if first < len(run) else right
                    for k in range(left, stop):
                        if slot[k]:
                            for x, y in (((0, int(a[k])), int(b[k])), ((1, int(b[k])), int(a[k]))):
                                values[x][y] -= 1
                                if not values[x][y]:
                                    del values[x][y]
                                    clashes -= len(values[x]) == 1
                    left = stop
                if first <= last:
                    lo, hi = run[first], s + size
                    best = max(best, (hi - lo, lo + begin, int(changed[hi] - changed[lo])))
        return best

    @staticmethod
    def _whole(name: np.ndarray, edge: int, step: int) -> int:
        """The end, in direction ``step``, of the run of names that the edge before word ``edge`` cuts."""
        while 0 < edge < len(name) and name[edge - 1] and name[edge]:
            edge += step
        return edge


def _scan(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Index = pickle.loads(index.value).open()
        read = Templates()
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("words", pa.int32()), ("start", pa.int32()), ("changed", pa.int32())]))
        for batch in batches:
            out, held, n = [], [], 0
            for text in [*raw_texts(batch.column("text")), ...]:
                if text is not ...:
                    held.append(words_of(text))
                    n += len(held[-1])
                if n >= AT_ONCE or text is ...:
                    out += [[dict(zip(("item_id", "words", "start", "changed"), x)) for x in found] for found in known.leaks(held, read)]
                    held, n = [], 0
            names = batch.schema.names
            old = pa.array(out, kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, old], names=[*names, "new_leaks"])

    return run


LEAKS = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("words", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("changed", T.IntegerType())]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Benchmark items that each document holds, verbatim or with other numbers, names and units.

    Words become template tokens: numbers, units after a number, and names (capitalised inside a
    sentence) turn into typed placeholders, other words lose case and outer punctuation.
    Windows of ``n`` tokens (a whole item if it has fewer) of the benchmark are hash-joined with
    those of every whole text in the scan itself, by their plain words and, from 5 words on and with plain words
    for half of them at least, by their tokens. Neighbouring windows join up as long as they are verbatim or their
    slots agree: one value of the item always stands for one value of the text and back. The longest such
    stretch counts. A capitalised word at the start of a sentence is read both as a name and as a plain word.

    Returns doc_id, row, leaks (item_id, words, start word, changed slots), one row per input row.
    Null or empty texts and items match nothing; items that are repeated are each reported. The benchmark is the stated
    side: at most ``block_bytes`` of it is broadcast, in as many passes as it needs.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    out = with_row(docs).withColumn("leaks", F.array().cast(LEAKS))
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        index = spark.sparkContext.broadcast(pickle.dumps(Index([(r["item_id"], r["text"]) for r in own], n)))
        out = out.mapInArrow(_scan(index), T.StructType([*out.schema.fields, T.StructField("new_leaks", LEAKS)]))
        out = out.withColumn("leaks", F.concat("leaks", "new_leaks")).drop("new_leaks")
        if b < blocks - 1:  # a pass of its own for each block, so that one is in memory at a time
            out = written(out)
            index.unpersist()
    return out.drop("text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    leaked = F.size("leaks") > 0
    return found.select(
        "doc_id", leaked.alias("contaminated"), (~leaked).alias("kept"), F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.array_sort(F.transform("leaks", lambda x: x["item_id"])).cast("array<string>"), ",").alias("item_ids"), F.coalesce(F.array_max(F.transform("leaks", lambda x: x["words"])), F.lit(0)).cast("long").alias("longest_match"),
    )
