"""Hidden texts inside messages, found by automata that are broadcast in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.automaton import Automaton
from millrace.lineage import written
from millrace.registry import query

#: Bytes of hidden texts in one automaton, and of messages in one scan of it, at most (a single longer one excepted).
AUTOMATON_BYTES, SCAN_BYTES = 1 << 18, 1 << 22
#: Beyond so many automata, hidden texts of more than WORDS + 1 words meet messages by hashes of their words instead.
MOST_AUTOMATA, WORDS = 16, 5


def _clean(name: str):
    return F.trim(F.regexp_replace(F.col(name), r"[ \t]+(?=\n|$)", ""))


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, ids = shared.value
        for batch in batches:
            texts, docs = batch.column("message").to_pylist(), batch.column("doc")
            lo = 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SCAN_BYTES):
                    size += len(texts[hi])
                    hi += 1
                found = sorted(automaton.find(texts[lo:hi]))
                rows = docs.take(pa.array([lo + t for t, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([rows, pa.array([ids[p] for _, p in found], pa.int64())], names=["doc", "item"])
                lo = hi

    return run


def _by_words(messages: DataFrame, hidden: DataFrame, n: int) -> DataFrame:
    """Candidates share the hash of the hidden text's ``n`` words from the second on; containment is then checked."""
    words = lambda c: F.split(c, r"[\s]+")
    keys = hidden.select("item", "secret", F.xxhash64(F.array_join(F.slice(words(F.col("secret")), 2, n), " ")).alias("key"))
    w = words(F.decode("message", "utf-8"))
    shifted = F.arrays_zip(*[F.slice(w, k + 1, F.greatest(F.lit(0), F.size(w) - k)) for k in range(n)])
    grams = F.transform(shifted, lambda x: F.xxhash64(F.concat_ws(" ", *[x[str(k)] for k in range(n)])))
    hit = messages.select("doc", F.explode(F.array_distinct(grams)).alias("key")).join(keys.select("item", "key"), "key").select("doc", "item").distinct()
    both = hit.join(messages, "doc").join(keys.select("item", "secret"), "item")
    return both.where(F.contains("message", F.encode("secret", "utf-8"))).select("doc", "item")


def hidden_text_containment(messages: DataFrame, hidden: DataFrame, most_automata: int = MOST_AUTOMATA) -> DataFrame:
    """Distinct (doc_id, item_id) where the normalised hidden text is a substring of the message.

    Both texts lose the spaces and tabs before line ends, and blanks around. Hidden texts are dealt into automata of AUTOMATON_BYTES, and each is one
    scan of the messages. Where that would be more than ``most_automata`` scans, texts of at least WORDS + 2 words are found by an equi-join on
    hashes of words instead, and only shorter ones by automata, however many. Empty or null texts contain nothing and are found nowhere. Ids are whole numbers.
    """
    spark = messages.sparkSession
    m = messages.select(F.col("doc_id").cast("long").alias("doc"), F.encode(_clean("text"), "utf-8").alias("message")).where(F.octet_length("message") > 0)
    h = hidden.select(F.col("item_id").cast("long").alias("item"), _clean("text").alias("secret")).where("secret <> ''").distinct()
    h = written(h.withColumns({"bytes": F.octet_length("secret").cast("long"), "long": F.size(F.split("secret", r"[\s]+")) >= WORDS + 2}))
    total = h.agg(F.sum("bytes")).first()[0] or 0
    found = []
    if total > most_automata * AUTOMATON_BYTES:
        found.append(_by_words(m, h.where("long"), WORDS))
        h = h.where("not long")
        total = h.agg(F.sum("bytes")).first()[0] or 0
    blocks = -(-total // AUTOMATON_BYTES) * (2 if total > AUTOMATON_BYTES else 1)  # hashed, so half full on average
    for k in range(blocks):
        own = h.where(F.pmod(F.xxhash64("item", "secret"), F.lit(blocks)) == k).select("item", "secret").collect()  # a block of bounded bytes
        if own:
            shared = spark.sparkContext.broadcast((Automaton([r["secret"].encode() for r in own]), [r["item"] for r in own]))
            found.append(m.mapInArrow(_scan(shared), "doc long, item long"))
    none = spark.createDataFrame([], "doc long, item long")
    for some in found:
        none = none.unionByName(some)
    return none.distinct().select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


CLEAN = r"trim(regexp_replace({}, '[ \t]+(\n|$)', '\1', 'g'), ' ')"
query("hidden_text_containment", f"WITH m AS (SELECT doc_id, {CLEAN.format('text')} AS x FROM documents), h AS (SELECT item_id, {CLEAN.format('text')} AS y FROM benchmark) SELECT DISTINCT doc_id, item_id FROM m JOIN h ON contains(x, y) AND y <> ''")(
    lambda t: hidden_text_containment(t.documents, t.benchmark)
)
SHORT = "array_to_string(list_slice(string_split(trim(regexp_replace(text, '\\s+', ' ', 'g'), ' '), ' '), 2, 1 + item_id % 6 + 1), ' ')"
query("short_text_containment", f"WITH m AS (SELECT doc_id, {CLEAN.format('text')} AS x FROM documents), h AS (SELECT item_id, {SHORT} AS y FROM benchmark) SELECT DISTINCT doc_id, item_id FROM m JOIN h ON contains(x, y) AND y <> ''")(
    lambda t: hidden_text_containment(t.documents, t.benchmark.select("item_id", F.array_join(F.slice(F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " "), F.lit(2), (F.col("item_id") % 6 + 1).cast("int")), " ").alias("text")))
)
