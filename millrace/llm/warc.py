"""WARC archives: written as text of records, read back in splits by boundary chains.

Reading takes three scans, each in order within a split. The first emits, for whatever looks like the start of a record, the offset of its
successor; successors inside the split are followed at once, so that one jump leads out of it. Pointer jumping from the start of each file then
keeps what can be reached, and with it the first true record of every split: a magic line inside a payload is reached by
nobody. The second scan picks up the pieces of records that lie across splits, and the third reads the records of a split from its first one on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_ROWS, later_of_equals, small_side, table, table_path, union_all, written

#: Payloads of at least so many bytes are written once; equal ones refer to the first.
LEAST_BYTES = 0
#: Magic, line end, end of a record, profile of a revisit, date of records that have none, base32 alphabet.
MAGIC, CRLF, DATE = "WARC/1.1", "\r\n", "1970-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_START = re.compile(rb"WARC/\d+\.\d+\r")
_FIELD = re.compile(rb"(?:[^\x00-\x20:\x7f]+:|[ \t]).*\r", re.DOTALL)
_LENGTH = re.compile(rb"(?:\A|\n)content-length:[ \t]*(\d{1,18})[ \t]*\r\n", re.IGNORECASE)
#: Bytes of payloads that one batch of records holds, about.
BATCH = 1 << 23
RECORD = "file string, offset long, type string, record_id string, refers_to string, page_id long, url string, digest string, payload binary"


def base32(hex_digest: Column) -> Column:
    """A SHA-1 digest in hex (40 digits) as 32 characters of base32: five hex digits make four."""
    parts = [F.lpad(F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def write_warc(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as uncompressed WARC files below ``path``, one record a row.

    Of records with equal payloads of at least ``least`` bytes, those of the smallest page_id are responses and others revisits without a block, which name
    that record. The payload is the html in UTF-8, empty for null. A row without a page_id, and any payload smaller than ``least``, is a response. Line ends inside a
    url are written %0D and %0A; a null url has no field. Rows that repeat are written as often. Each task writes a file of its own rows; payloads
    are shuffled only where the revisits are too many to broadcast.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), base32(F.sha1(html)).alias("digest"))
    keyed = written(base.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest"))
    again = written(later_of_equals(keyed, "digest", "page_id").distinct())
    base = base.join(small_side(again), ["page_id", "digest"], "left")
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    field = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(":"), F.col("digest"), F.lit(">"))
    old = F.col("first").isNotNull()
    body = F.when(old, "").otherwise(F.col("html"))
    record = F.concat(
        F.lit(MAGIC + CRLF), field("WARC-Type", F.when(old, "revisit").otherwise("response")), field("WARC-Record-ID", name("page_id")), field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", uri), field("WARC-Page-ID", F.col("page_id").cast("string")), field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        field("WARC-Refers-To", F.when(old, name("first"))), field("WARC-Profile", F.when(old, SAME_PAYLOAD)), field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.octet_length(body).cast("string")), F.lit(CRLF), body,
    )
    base.select(record).write.option("lineSep", CRLF * 2).text(path)


def _arrow(names: tuple, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: pa.array(c, t) for (n, t), c in zip(names, zip(*rows) if rows else [[]] * len(names))})


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files in order within a split: file, block (where the split starts), size, line."""
    m = F.col("_metadata")
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(m["file_path"].alias("file"), m["file_block_start"].alias("block"), m["file_size"].alias("size"), F.col("value").cast("binary").alias("line"))


def _length(header: bytes) -> int | None:
    found = _LENGTH.search(header)
    return int(found[1]) if found else None


class _Split:
    """What looks like records in one split, with offsets from its first line."""

    def __init__(self, file: str, block: int, size: int):
        self.file, self.block, self.size, self.at = file, block, size, 0
        self.begun: int | None = None  # offset of a header that isn't complete
        self.raw = bytearray()
        self.lead: bytearray | None = bytearray() if block else None  # the rest of a header of the split before
        self.whole_lead: tuple[int, bytes] | None = None
        self.next: dict[int, int] = {}

    def add(self, line: bytes) -> None:
        end = self.at + len(line) + 1
        if self.lead is not None:
            if line == b"\r":
                self.whole_lead, self.lead = (end, bytes(self.lead)), None
            elif _FIELD.fullmatch(line):
                self.lead += line + b"\n"
            else:
                self.lead = None
        if self.begun is not None:
            if line == b"\r":
                length = _length(bytes(self.raw))
                if length is not None:
                    self.next[self.begun] = end + length + 4
                self.begun = None
            elif _FIELD.fullmatch(line):
                self.raw += line + b"\n"
            else:
                self.begun = None
        if self.begun is None and _START.fullmatch(line):
            self.begun, self.raw = self.at, bytearray(b"\n")
        self.at = end

    def rows(self) -> list[tuple]:
        """kind, at, out, last, raw: the split's size; records with the offset that their chain leaves it for (null: for nowhere) and the last
        record of this chain; an open header; the rest of one (``out`` null: it takes the whole split)."""
        out: dict[int, tuple[int | None, int]] = {}
        for start in sorted(self.next, reverse=True):
            to = self.next[start]
            out[start] = out.get(to) or ((to if to >= self.at or to == self.begun else None), start)
        made = [("size", self.at, self.size, None, None), *(("record", s, to, last, None) for s, (to, last) in out.items())]
        if self.begun is not None:
            made.append(("open", self.begun, None, None, bytes(self.raw)))
        if self.whole_lead:
            made.append(("lead", 0, *self.whole_lead[:1], None, self.whole_lead[1]))
        elif self.lead:
            made.append(("lead", 0, None, None, bytes(self.lead)))
        return [(self.file, self.block, *r) for r in made]


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = (("file", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("at", pa.int64()), ("out", pa.int64()), ("last", pa.int64()), ("raw", pa.binary()))
    now = None
    for batch in batches:
        files, sizes = batch.column("file"), batch.column("size")
        for r, (block, line) in enumerate(zip(batch.column("block").to_pylist(), batch.column("line"))):
            if now is None or now.block != block or now.file != files[r].as_py():
                if now:
                    yield _arrow(names, now.rows())
                now = _Split(files[r].as_py(), block, sizes[r].as_py())
            now.add(line.as_py())
    if now:
        yield _arrow(names, now.rows())


def _chains(spark: SparkSession, path: str) -> DataFrame:
    """Where records begin in every split: file, block, base (offset of its first line), entry (of its first true record, or null), owner (the true record that the
    lines before belong to, or null)."""
    found = written(_lines(spark, path).mapInArrow(_splits, "file string, block long, kind string, at long, out long, last long, raw binary"))
    order = Window.partitionBy("file").orderBy("block")  # a row for each split
    splits = found.where("kind = 'size'").select("file", "block", F.col("at").alias("bytes"), F.col("out").alias("size"))
    splits = splits.withColumn("n", F.row_number().over(order)).withColumn("base", F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    splits = written(splits)
    wrong = splits.groupBy("file").agg((F.sum("bytes") - F.max("size")).alias("over")).where("over not in (0, 1)").first()  # 1: no end of line at the end
    if wrong:
        raise RuntimeError(f"the splits of {wrong['file']} do not make up the file")
    known = found.join(small_side(splits.select("file", "block", "n", "base")), ["file", "block"])
    records = known.where("kind = 'record'").select("file", (F.col("base") + F.col("at")).alias("start"), (F.col("base") + F.col("out")).alias("out"), (F.col("base") + F.col("last")).alias("last"))
    lead = written(known.where("kind = 'lead'").select("file", F.col("n").cast("int").alias("n"), (F.col("base") + F.col("out")).alias("data"), F.col("raw").alias("rest")))
    opened = written(known.where("kind = 'open'").select("file", (F.col("n") + 1).cast("int").alias("n"), (F.col("base") + F.col("at")).alias("start"), "raw"))
    while not opened.isEmpty():  # mostly once: a header lies across two splits
        longer = written(opened.join(lead, ["file", "n"]).select("file", "n", "start", F.concat("raw", "rest").alias("raw"), "data"))
        length = F.regexp_extract(F.decode("raw", "iso-8859-1"), r"(?i)\ncontent-length:[ \t]*(\d{1,18})[ \t]*\r\n", 1)
        done = longer.where(F.col("data").isNotNull() & (length != ""))
        records = records.unionByName(done.select("file", "start", (F.col("data") + length.cast("long") + 4).alias("out"), F.col("start").alias("last")))
        opened = written(longer.where("data is null").select("file", (F.col("n") + 1).alias("n"), "start", "raw"))
    records = written(records)
    targets = written(records.where("out is not null").select("file", F.col("out").alias("start")).distinct())
    zero = F.col("start") == 0
    entries = written(records.where(~zero).join(small_side(targets), ["file", "start"], "left_semi").unionByName(records.where(zero)))
    jump = entries.select("file", "start", "out").where("out is not null")
    reached, before = entries.where(zero).select("file", "start"), 0
    while (now := reached.count()) > before:
        before = now
        ahead = reached.join(jump, ["file", "start"]).select("file", F.col("out").alias("start"))
        reached = written(reached.unionByName(ahead).distinct())
        jump = written(jump.alias("x").join(jump.select("file", F.col("start").alias("out"), F.col("out").alias("far")), ["file", "out"]).select("file", "start", F.col("far").alias("out")))
    true = entries.join(reached, ["file", "start"], "left_semi")
    # the split of a true record is the last that begins at or before it: both in one order
    marks = splits.select("file", F.col("base").alias("at"), "block", F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("out"), F.lit(None).cast("long").alias("last"))
    marks = marks.unionByName(true.select("file", F.col("start").alias("at"), F.lit(None).cast("long").alias("block"), "start", "out", "last"))
    block = F.last("block", ignorenulls=True).over(Window.partitionBy("file").orderBy("at", F.col("block").asc_nulls_last()))
    placed = marks.withColumn("block", block).where("start is not null")
    leaves = F.max_by(F.struct("last", "out"), "start")
    homes = placed.groupBy("file", "block").agg(F.min("start").alias("entry"), leaves.alias("leaves"))
    full = splits.join(homes, ["file", "block"], "left")
    owner = F.last(F.when(F.col("entry").isNotNull(), F.struct(F.when(F.col("leaves.out").isNotNull(), F.col("leaves.last")).alias("at"))), ignorenulls=True)
    return written(full.select("file", "block", "base", "entry", owner.over(order.rowsBetween(Window.unboundedPreceding, -1))["at"].alias("owner")))


def parse_record(raw: bytes) -> tuple | None:
    """Fields and payload of a whole record, or None where it isn't one: type, record_id, refers_to, page_id, url, digest, payload."""
    head, blank, rest = raw.partition(b"\r\n\r\n")
    length = _length(b"\n" + head + b"\r\n")
    if not blank or length is None or len(rest) < length:
        return None
    fields: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split(CRLF)[1:]:
        if line[:1] in " \t":
            fields[name] = f"{fields.get(name, '')} {line.strip()}"
        else:
            name, _, value = line.partition(":")
            name = name.lower()
            fields[name] = value.strip()
    page = fields.get("warc-page-id", "")
    return (*(fields.get(c) for c in ("warc-type", "warc-record-id", "warc-refers-to")), int(page) if re.fullmatch(r"-?\d{1,18}", page) else None, fields.get("warc-target-uri"), fields.get("warc-payload-digest"), rest[:length])


_PIECE = (("file", pa.string()), ("offset", pa.int64()), ("at", pa.int64()), ("raw", pa.binary()))
_RECORD = (("file", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.string()), ("payload", pa.binary()))


class _Reader:
    """Follows the true records of one split line by line."""

    def __init__(self, file: str, base: int, entry: int | None, owner: int | None, parts: bool):
        self.file, self.entry, self.owner, self.parts, self.at = file, entry, owner, parts, base
        self.begin(owner if parts else None)  # until the first true record, lines belong to one of an earlier split

    def begin(self, start: int | None) -> None:
        self.start, self.raw, self.raw_at, self.end = start, bytearray(), self.at, None

    def piece(self) -> list[tuple]:
        """What is held of a record that goes on elsewhere."""
        return [(self.file, self.start, self.raw_at, bytes(self.raw))] if self.parts and self.start is not None and self.raw else []

    def add(self, line: bytes) -> list[tuple]:
        done: list[tuple] = []
        if self.at == self.entry:
            done = self.piece()
            self.begin(self.at)
        self.at += len(line)
        if self.start is None:
            return done
        if self.start != self.owner and self.end is None and line != b"\r\n" and not (_FIELD if self.raw else _START).fullmatch(line[:-1]):
            self.begin(None)  # no record: the chain is over
            return done
        self.raw += line
        if self.start == self.owner:
            if len(self.raw) > BATCH:  # a payload of many splits goes piece by piece
                done = self.piece()
                self.begin(self.owner)
            return done
        if self.end is None and line == b"\r\n":
            length = _length(bytes(self.raw))
            if length is None:
                self.begin(None)
                return done
            self.end = self.at + length + 4
        if self.end is not None and self.at >= self.end:
            record = None if self.parts or self.at > self.end else parse_record(bytes(self.raw))
            if record:
                done.append((self.file, self.start, *record))
            self.begin(self.at if self.at == self.end else None)
        return done


def _follow(parts: bool):
    """Read each split from its first true record on: whole records, or (``parts``) the pieces of those that lie across its ends."""
    names = _PIECE if parts else _RECORD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reader, out, held = None, None, [], 0
        for batch in batches:
            files, bases, entries, owners = (batch.column(c) for c in ("file", "base", "entry", "owner"))
            for r, (block, line) in enumerate(zip(batch.column("block").to_pylist(), batch.column("line"))):
                if key is None or key[1] != block or key[0] != files[r].as_py():
                    out += reader.piece() if reader else []
                    key = (files[r].as_py(), block)
                    reader = _Reader(key[0], bases[r].as_py(), entries[r].as_py(), owners[r].as_py(), parts)
                done = reader.add(line.as_py() + b"\n")
                if done:
                    out += done
                    held += sum(len(d[-1]) for d in done)
                    if held > BATCH:
                        yield _arrow(names, out)
                        out, held = [], 0
        yield _arrow(names, out + (reader.piece() if reader else []))

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, offset, pieces in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "pieces"))):
            record = parse_record(b"".join(p["raw"] for p in pieces))
            yield _arrow(_RECORD, [(file, offset, *record)] if record else [])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the uncompressed WARC files at ``path``: file, offset, type, record_id, refers_to, page_id, url, digest (as its header says), payload.

    Files are read in splits of any size. Only records that a chain of record ends reaches from the start of the file are returned, whatever payloads
    look like. A chain ends at bytes that are no record; a record cut off by the end of its file isn't returned, nor is one without a
    Content-Length. Fields that a record lacks are null. What is broadcast is one row for each split (a million at most, else files are taken in groups).
    """
    chains = _chains(spark, path)
    groups = -(-chains.count() // BROADCAST_ROWS) or 1
    whole, pieces = [], []
    for g in range(groups):
        mine = F.pmod(F.xxhash64("file"), F.lit(groups)) == g
        lines = _lines(spark, path).where(mine).drop("size").join(F.broadcast(chains.where(mine)), ["file", "block"])
        whole.append(lines.mapInArrow(_follow(False), RECORD))
        pieces.append(lines.mapInArrow(_follow(True), "file string, offset long, at long, raw binary"))
    parts = written(union_all(pieces)).groupBy("file", "offset").agg(F.array_sort(F.collect_list(F.struct("at", "raw"))).alias("pieces"))
    return union_all([*whole, parts.mapInArrow(_joined, RECORD)])


def archived(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> DataFrame:
    """Write ``pages`` to ``path``, read them back and say what each record holds: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Bytes and digest are those of the payload that was read, for a revisit those of the response that it names.
    """
    write_warc(pages, path, least)
    digest = base32(F.sha1("payload"))
    read = written(read_warc(pages.sparkSession, path).select("page_id", "type", "record_id", "refers_to", F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("payload_digest")))
    named = read.where("type = 'response'").groupBy(F.col("record_id").alias("refers_to")).agg(F.first("page_id").alias("first"), F.first("payload_bytes").alias("b"), F.first("payload_digest").alias("d"))
    again = read.where("type = 'revisit'").join(named, "refers_to", "left").select("page_id", F.col("b").alias("payload_bytes"), F.col("d").alias("payload_digest"), F.col("type").alias("record_type"), F.col("first").alias("refers_to"))
    plain = read.where("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return plain.unionByName(again)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"), table_path(spark))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT *, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, list_transform(range(8), lambda k: ('0x' || substr(x, (5 * k + 1)::INTEGER, 5))::BIGINT) AS groups FROM f)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  array_to_string(list_transform(groups, lambda n: substr('{BASE32}', ((n >> 15) & 31)::INTEGER + 1, 1) || substr('{BASE32}', ((n >> 10) & 31)::INTEGER + 1, 1) || substr('{BASE32}', ((n >> 5) & 31)::INTEGER + 1, 1) || substr('{BASE32}', (n & 31)::INTEGER + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id > first AND strlen(h) >= {LEAST_BYTES} THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first AND strlen(h) >= {LEAST_BYTES} THEN first END AS refers_to
FROM b
"""
