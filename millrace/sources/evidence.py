"""Files in and out: evidence tables, reports, JSON records, canonical JSONL, shards, inventories.

Files may be larger than a split: lines are numbered inside a split and the counts of the splits before are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pa_fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.lineage import new_path, running, small_side, written
from millrace.registry import query

#: Lines of one part file of a canonical dataset, at most: its bytes are hashed as one value.
PART_LINES = 50_000


def decode_escapes(col: Column) -> Column:
    """``\\t \\n \\r \\\\`` of an evidence table; doubled backslashes are set apart first."""
    parts = F.split(col, r"\\\\", -1)
    plain = lambda p: F.replace(F.replace(F.replace(p, F.lit("\\t"), F.lit("\t")), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.array_join(F.transform(parts, plain), "\\")


def encode_escapes(col: Column) -> Column:
    """Inverse of ``decode_escapes``; null becomes empty."""
    for plain, escaped in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
        col = F.replace(col, F.lit(plain), F.lit(escaped))
    return F.coalesce(col, F.lit(""))


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines come in order within a split: number them from 1."""
    split, n = None, 0
    for batch in batches:
        numbers = []
        for now in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
            split, n = now, (n + 1 if now == split else 1)
            numbers.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "n"])


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines below ``path`` as file, line_no (from 1), value; a line end is ``\\n`` with or without ``\\r`` before it.

    Needs two scans: one counts the lines of every split, the other numbers them. An empty file has no line.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path)
    m = F.col("_metadata")
    lines = lines.select(m["file_path"].alias("file"), m["file_block_start"].alias("block"), "value")
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    counts = written(lines.groupBy("file", "block").agg(F.count("*").alias("lines")))
    before = counts.select("file", "block", F.coalesce(F.sum("lines").over(order), F.lit(0)).alias("before"))
    numbered = lines.mapInArrow(_number, "file string, block long, value string, n long").join(small_side(before), ["file", "block"], "left")
    known = F.when(F.col("before").isNull(), F.raise_error(F.lit("the splits changed between two scans; read again"))).otherwise(F.col("before"))
    return numbered.select("file", (F.col("n") + known).alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))


def write_evidence_tsv(df: DataFrame, path: str) -> None:
    """Tab files with a header each; tabs, line ends and backslashes of values are escaped, null is written empty."""
    head = "\t".join(df.columns)

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [head]})
        for batch in batches:  # all of one schema
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    line = F.concat_ws("\t", *[encode_escapes(F.col(f"`{c}`").cast("string")) for c in df.columns])
    df.select(line.alias("value")).mapInArrow(headed, "value string").write.option("lineSep", "\n").text(path)


def read_evidence_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Tab files whose first line must be the schema's names in order: the columns, file, line_no and ``bad`` (a row of another width).

    Every field is decoded and cast to its type; what doesn't fit is null. Only the first line of a file is its header, rows that
    look like it are kept. A file with another header raises, an empty one has no rows.
    """
    names = [f.name for f in schema.fields]
    head = "\t".join(names)
    rows = numbered_lines(spark, path)
    first = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("file"))
    first = first.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("value"))  # a file's first split is read in order
    wrong = first.where(F.regexp_replace("value", "\r$", "") != head).first()
    if wrong:
        raise ValueError(f"header {wrong['value']!r} of {wrong['file']} is not {head!r}")
    cells = F.split("value", "\t", -1)
    cast = [decode_escapes(F.try_element_at("c", F.lit(i + 1))).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    return rows.where("line_no > 1").withColumn("c", cells).select(*cast, "file", "line_no", (F.size("c") != len(names)).alias("bad"))


def read_reports(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Whole text reports with their path; ``ok`` says that the version line is there (a line of its own)."""
    rows = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    line = F.array_contains(F.transform(F.split("value", "\n", -1), lambda x: F.rtrim(x)), version)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), line.alias("ok"))


def read_json_evidence(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per file, with its path; what doesn't fit the schema is kept in ``_corrupt_record``."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(wide).option("multiLine", True).option("recursiveFileLookup", True).json(path).select("*", F.col("_metadata.file_path").alias("path"))


SFT = "struct<messages:array<struct<role:string,content:string>>,metadata:map<string,string>>"


def judge_sft_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Every line: file, line_no, value, r (messages and metadata, as far as they can be read) and reasons why it is no record, read and judged once.

    A record is an object with three messages, of system, user and assistant in this order, each with a content that is a string and not blank, and a
    metadata object. Line numbers are those of the file.
    """
    r = numbered_lines(spark, path).withColumns({"r": F.from_json("value", SFT), "v": F.try_parse_json("value")})
    kind = lambda at: F.coalesce(F.schema_of_variant(F.try_variant_get("v", at, "variant")), F.lit("absent"))
    is_object = kind("$").startswith("OBJECT")
    roles = F.transform("r.messages", lambda m: m["role"])
    three = kind("$.messages").startswith("ARRAY") & (F.coalesce(F.size("r.messages"), F.lit(-1)) == 3)
    texts = F.lit(True)
    for i in range(3):
        texts = texts & (kind(f"$.messages[{i}].content") == "STRING")
    blank = F.exists("r.messages", lambda m: ~F.coalesce(m["content"], F.lit("")).rlike(r"(?U)\S"))
    reasons = F.array_compact(F.array(
        F.when(~F.col("value").rlike(r"(?U)\S"), "blank_line").when(F.col("v").isNull(), "invalid_json").when(~is_object, "not_an_object").when(~three, "messages")
        .when(~F.coalesce(roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")), F.lit(False)), "roles").when(~texts | F.coalesce(blank, F.lit(True)), "content")
        .when(~kind("$.metadata").startswith("OBJECT"), "metadata"),
    ))
    return r.withColumn("reasons", reasons).drop("v")


def read_sft_jsonl(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good records, bad lines) of ``judge_sft_jsonl``: messages, metadata, file, line_no; and file, line_no, value, reasons. Each of the two reads the files; who needs both should take the judged lines."""
    r = judge_sft_jsonl(spark, path)
    return r.where(F.size("reasons") == 0).select("r.*", "file", "line_no"), r.where(F.size("reasons") > 0).select("file", "line_no", "value", "reasons")


def sft_lines(df: DataFrame, key: str) -> DataFrame:
    """(key, line): compact JSON with fields in alphabetical order; null fields are left out."""
    return df.select(key, F.to_json(F.struct(*sorted(df.columns))).alias("line"))


def write_sft_jsonl(df: DataFrame, key: str, path: str, part_lines: int = PART_LINES) -> DataFrame:
    """Records as JSON lines sorted by key, in part files whose names are in order; returns and writes (to ``_manifest``) a row a part.

    Parts are ranges of the key, of at most ``part_lines`` lines. Manifest: part (file name), first_line (of the whole dataset, from 1), lines, bytes, sha256 (of the part's
    bytes, read back). Keys that repeat stay together in any order; a null key comes first. An empty table gives no line.
    """
    spark = df.sparkSession
    made = sft_lines(df, key).repartitionByRange(key).sortWithinPartitions(key, "line").select("line")
    made.write.option("lineSep", "\n").option("maxRecordsPerFile", part_lines).text(path)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    parts = parts.select(name.alias("part"), F.regexp_count(F.decode("content", "iso-8859-1"), F.lit("\n")).cast("long").alias("lines"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    parts = written(parts.where("bytes > 0"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part file
    manifest = parts.withColumn("first_line", 1 + F.coalesce(F.sum("lines").over(before), F.lit(0)))
    manifest.write.json(f"{path}/_manifest")
    return spark.read.schema(manifest.schema).json(f"{path}/_manifest")


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    """(line_no of the whole dataset, value) of what ``write_sft_jsonl`` wrote, placed by its manifest."""
    manifest = spark.read.schema("part string, first_line long, lines long, bytes long, sha256 string").json(f"{path}/_manifest")
    lines = numbered_lines(spark, f"{path}/part-*").withColumn("part", F.regexp_extract("file", r"([^/]*)$", 1))
    return lines.join(small_side(manifest.select("part", "first_line")), "part").select((F.col("line_no") + F.col("first_line") - 1).alias("line_no"), "value")


def dealt(ranked: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Rows in one global order dealt round-robin into n shards: place (from 0) and shard. The order is numbered by ranges, never in one task."""
    placed = running(ranked, [], order, {"place": "1"})
    return placed.withColumn("place", F.col("place") - 1).withColumn("shard", F.col("place") % n)


def write_sharded_candidates(ranked: DataFrame, n: int, order: list[str], path: str) -> DataFrame:
    """``dealt`` rows written to a folder a shard, and their counts: shard, rows, first and last place. ``order`` should be total; equal rows are dealt in any order."""
    dealt(ranked, n, order).write.partitionBy("shard").parquet(path)
    return ranked.sparkSession.read.parquet(path).groupBy("shard").agg(F.count("*").alias("rows"), F.min("place").alias("first"), F.max("place").alias("last"))


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every file below a folder with its path from there, bytes and sha256, hidden files excepted.

    Spark lists what the store shows it: a link is read as the file that it leads to and cannot be told from one. Each file is one value
    while it is hashed, so files over 2 GB need another way.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    top = root.rstrip("/").split("/")[-1] + "/"
    inside = F.substr("path", F.instr("path", top) + len(top))
    return rows.select(inside.alias("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def upsert_artifacts(base: DataFrame, changes: DataFrame, key: list[str], order: str) -> DataFrame:
    """The latest row of each key out of base and changes (changes win ties)."""
    both = base.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)))
    return both.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order), F.desc("_new")))).where("_n = 1").drop("_n", "_new")


# --- registered queries: each writes its files from the tables first, and reads them ---


def _tsv(t) -> DataFrame:
    path = new_path(t.spark, "tsv")
    rows = t.documents.select("doc_id", "lang", "text", "n_chars")
    write_evidence_tsv(rows, path)
    got = read_evidence_tsv(t.spark, path, rows.schema)
    return got.select("doc_id", "lang", F.sha2("text", 256).alias("text_sha256"), "n_chars", "bad")


query("read_evidence_tsv", "SELECT doc_id, lang, sha256(text) AS text_sha256, n_chars, false AS bad FROM documents")(_tsv)

SFT_BAD = {0: "blank_line", 1: "invalid_json", 2: "not_an_object", 3: "messages", 4: "roles", 5: "content", 6: "metadata"}


def _sft(t) -> DataFrame:
    """A line a document: a record, or (by doc_id) one of the forms that a reader must refuse."""
    path = new_path(t.spark, "sft")
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    text = F.concat(F.lit("say: "), F.substr(F.col("text"), F.lit(1), F.lit(2000)))
    whole = lambda *m, meta=None: F.to_json(F.struct(F.array(*m).alias("messages"), (F.struct(F.col("doc_id").cast("string").alias("id")) if meta is None else meta).alias("metadata")))
    good = [say("system", F.lit("s")), say("user", text), say("assistant", text)]
    bad = [F.lit("  "), F.lit('{"messages": ['), F.lit("[1]"), whole(*good[:2]), whole(good[1], *good[1:]), whole(*good[:2], say("assistant", F.lit(" "))), whole(*good, meta=F.lit("none"))]
    line = F.lit(None).cast("string")
    for k, form in enumerate(bad):
        line = F.when(F.col("doc_id") % 40 == k, form).otherwise(line)
    t.documents.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select(F.coalesce(line, whole(*good))).write.option("lineSep", "\n").text(path)
    judged, good = judge_sft_jsonl(t.spark, path), F.size("reasons") == 0
    own = [F.regexp_extract("file", r"part-(\d+)", 1).alias("part"), "line_no", F.when(good, F.element_at("r.metadata", "id").cast("long")).alias("doc_id"), F.when(good, "").otherwise(F.get("reasons", F.lit(0))).alias("reason")]
    every = written(judged.select(*own))
    before = every.groupBy("part").agg(F.max("line_no").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return every.join(before.select("part", "before"), "part").select((F.col("line_no") + F.col("before")).alias("line_no"), F.coalesce("doc_id", F.lit(-1).cast("long")).alias("doc_id"), "reason")


query("read_sft_jsonl", "SELECT row_number() OVER (ORDER BY doc_id) AS line_no, CASE WHEN doc_id % 40 < 7 THEN -1 ELSE doc_id END AS doc_id, CASE doc_id % 40 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in SFT_BAD.items()) + " ELSE '' END AS reason FROM documents")(_sft)


def write_files(df: DataFrame, path: str) -> None:
    """A text file for each ``name``, of its ``value`` lines in order, straight below ``path``; names should be fit for files.

    Tasks write the files themselves: Spark's writer takes a task's whole commit, with a folder and checksum file, for each. A task that is run again writes the same files.
    """
    uri = path if "://" in path else "file://" + path.removeprefix("file:")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pa_fs.FileSystem.from_uri(uri)
        store.create_dir(root)
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                with store.open_output_stream(f"{root}/{name}") as f:
                    f.write(text.encode())
            yield pa.RecordBatch.from_arrays([batch.column("name")], names=["name"])

    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    whole = df.repartition(tasks, "name").groupBy("name").agg(F.concat(F.array_join(F.array_sort(F.collect_list("value")), "\n"), F.lit("\n")).alias("text"))
    whole.select("name", "text").mapInArrow(put, "name string").write.format("noop").mode("overwrite").save()


def _by_supplier(t, line: Column, kind: str) -> str:
    """A folder of one text file a supplier."""
    path = new_path(t.spark, kind)
    write_files(t.supplier.select(F.concat(F.lit("s_suppkey="), "s_suppkey", F.lit(".txt")).alias("name"), line.alias("value")), path)
    return path


def _key() -> Column:
    return F.regexp_extract("path", r"s_suppkey=(-?\d+)", 1).cast("long").alias("s_suppkey")


query("read_reports", "SELECT s_suppkey, s_suppkey % 3 > 0 AS ok, sha256((CASE WHEN s_suppkey % 3 > 0 THEN 'version 7' ELSE 'version 70' END) || chr(10) || s_name || chr(10)) AS text_sha256 FROM supplier")(
    lambda t: read_reports(t.spark, _by_supplier(t, F.concat(F.when(F.col("s_suppkey") % 3 > 0, "version 7").otherwise("version 70"), F.lit("\n"), "s_name"), "reports"), "version 7").select(_key(), "ok", F.sha2("text", 256).alias("text_sha256"))
)
query("read_json_evidence", "SELECT s_suppkey, CASE WHEN s_suppkey % 5 > 0 THEN s_name ELSE '' END AS name, s_suppkey % 5 = 0 AS corrupt FROM supplier")(
    lambda t: read_json_evidence(t.spark, _by_supplier(t, F.concat(F.lit('{\n "name": "'), "s_name", F.when(F.col("s_suppkey") % 5 > 0, '"\n}').otherwise('"')), "json"), T.StructType([T.StructField("name", T.StringType())]))
    .select(_key(), F.when(F.col("_corrupt_record").isNull(), F.col("name")).otherwise("").alias("name"), F.col("_corrupt_record").isNotNull().alias("corrupt"))
)
query("file_inventory", "SELECT s_suppkey, CAST(strlen(s_name) + 1 AS BIGINT) AS bytes, sha256(s_name || chr(10)) AS sha256 FROM supplier")(
    lambda t: file_inventory(t.spark, _by_supplier(t, F.col("s_name"), "files")).select(_key(), "bytes", "sha256")
)


def _canonical(t) -> DataFrame:
    path = new_path(t.spark, "jsonl")
    write_sft_jsonl(t.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), "role", "text"), "id", path)
    return read_canonical(t.spark, path).select("line_no", F.sha2("value", 256).alias("sha256"))


query("write_sft_jsonl", "WITH r AS (SELECT conv_id * 100 + turn AS id, role, text FROM conversations) SELECT row_number() OVER (ORDER BY id) AS line_no, sha256(CAST(json_object('id', id, 'role', role, 'text', text) AS VARCHAR)) AS sha256 FROM r")(_canonical)


def _shards(t) -> DataFrame:
    path = new_path(t.spark, "shards")
    write_sharded_candidates(t.paths.select("path_id", "slack_ns"), 8, ["slack_ns", "path_id"], path)
    return t.spark.read.parquet(path).select("path_id", "place", F.col("shard").cast("long").alias("shard"))


query("write_sharded_candidates", "WITH r AS (SELECT path_id, row_number() OVER (ORDER BY slack_ns, path_id) - 1 AS place FROM {paths}) SELECT path_id, place, place % 8 AS shard FROM r")(_shards)
query("upsert_artifacts", "WITH b AS (SELECT user_id, event_type, value, event_id FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM b) SELECT user_id, event_type, value FROM r WHERE n = 1")(
    lambda t: upsert_artifacts(t.events.where("event_id % 2 = 0").select("user_id", "event_type", "value", "event_id"), t.events.where("event_id % 2 = 1").select("user_id", "event_type", "value", "event_id"), ["user_id", "event_type"], "event_id").select("user_id", "event_type", "value")
)
