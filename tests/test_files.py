"""Readers and writers against plain Python ones, over files larger than a split; streams over several batches."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.sources import evidence
from millrace.streaming import jobs


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k, v in zip(old, ("997", "0")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_line_numbers_over_splits(spark, folder, small_splits):
    rng = random.Random(3)
    want = {}
    for name in "abc":
        lines = ["".join(rng.choice(["x", "é", " ", "\t"]) for _ in range(rng.choice([0, 3, 60, 4000]))) for _ in range(rng.randrange(1, 60))]
        (folder / name).write_bytes(("\r\n" if name == "b" else "\n").join(lines).encode() + (b"\n" if name == "c" else b""))
        want |= {(name, i): x for i, x in enumerate(lines, 1) if not (i == len(lines) and name != "c" and not x)}
    (folder / "empty").write_bytes(b"")
    got = {(r["file"].rsplit("/", 1)[1], r["line_no"]): r["value"] for r in evidence.numbered_lines(spark, str(folder)).collect()}
    assert got == want


def test_evidence_tables(spark, folder, small_splits):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])
    rows = "a\\tb\\\\n\t3\nx\ty\nshort\nname\tn\n" + "long " * 900 + "\t7\n"
    (folder / "t.tsv").write_text("name\tn\n" + rows)
    (folder / "u.tsv").write_text("name\tn\n")
    got = evidence.read_evidence_tsv(spark, str(folder), schema).orderBy("line_no").collect()
    assert [(r["name"], r["n"], r["line_no"], r["bad"]) for r in got] == [("a\tb\\n", 3, 2, False), ("x", None, 3, False), ("short", None, 4, True), ("name", None, 5, False), ("long " * 900, 7, 6, False)]
    with pytest.raises(ValueError, match="header"):
        evidence.read_evidence_tsv(spark, str(folder), T.StructType(schema.fields[:1]))
    df = spark.createDataFrame([("tab\there", 1), ("line\r\nend \\t", None), (None, 3), ("", -4)], schema)
    evidence.write_evidence_tsv(df, str(folder / "out"))
    back = sorted((tuple(r) for r in evidence.read_evidence_tsv(spark, str(folder / "out"), schema).select("name", "n").collect()), key=str)
    assert back == sorted([("tab\there", 1), ("line\r\nend \\t", None), ("", 3), ("", -4)], key=str)


def test_sft_lines_and_their_numbers(spark, folder, small_splits):
    good = {"messages": [{"role": r, "content": r * 40} for r in ("system", "user", "assistant")], "metadata": {"id": "1"}}
    change = lambda **k: json.dumps(good | k)
    say = good["messages"]
    forms = {
        "blank_line": "  ", "invalid_json": "{", "not_an_object": "[]", "messages": change(messages=say[:2]), "roles": change(messages=say[::-1]), "content": change(messages=[*say[:2], {"role": "assistant", "content": 5}]), "metadata": change(metadata="x"),
    }
    rng = random.Random(1)
    kinds = [rng.choice([None, None, *forms]) for _ in range(150)] + ["content"]
    lines = [json.dumps(good) if k is None else forms[k] for k in kinds]
    lines[-1] = change(messages=[*say[:2], {"role": "assistant", "content": " \n"}])
    (folder / "s.jsonl").write_text("\n".join(lines) + "\n")
    ok, bad = evidence.read_sft_jsonl(spark, str(folder))
    assert {r["line_no"]: r["reasons"] for r in bad.collect()} == {i: [k] for i, k in enumerate(kinds, 1) if k}
    assert sorted(r["line_no"] for r in ok.collect()) == [i for i, k in enumerate(kinds, 1) if not k] and ok.first()["metadata"] == {"id": "1"}


def test_judged_lines_are_read_once(spark, folder):
    (folder / "s.jsonl").write_text('{"messages": []}\n \n')
    df = evidence.judge_sft_jsonl(spark, str(folder))
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan text") == 1
    assert {r["line_no"]: r["reasons"] for r in df.collect()} == {1: ["messages"], 2: ["blank_line"]}


def test_canonical_dataset_in_parts(spark, folder):
    rows = [(i * 7 % 1000, f"text é\n{i}" if i % 9 else None) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(5)
    manifest = evidence.write_sft_jsonl(df, "id", str(folder / "d"), 90).orderBy("part").collect()
    whole = b""
    for m in manifest:
        raw = (folder / "d" / m["part"]).read_bytes()
        assert (m["bytes"], m["sha256"], m["lines"], m["first_line"]) == (len(raw), hashlib.sha256(raw).hexdigest(), raw.count(b"\n"), whole.count(b"\n") + 1) and m["lines"] <= 90
        whole += raw
    want = [json.dumps({"id": i} | ({"text": t} if t else {}), ensure_ascii=False, separators=(",", ":")) for i, t in sorted(rows)]
    assert whole.decode().split("\n")[:-1] == want
    assert [r["value"] for r in evidence.read_canonical(spark, str(folder / "d")).orderBy("line_no").collect()] == want
    assert evidence.write_sft_jsonl(df.where("false"), "id", str(folder / "none")).count() == 0


def test_shards_of_one_global_order(spark, folder):
    df = spark.createDataFrame([(i, (i * 37 % 200) / 8) for i in range(200)], "id long, slack double").repartition(6)
    counts = evidence.write_sharded_candidates(df, 3, ["slack", "id"], str(folder / "s")).orderBy("shard").collect()
    assert [tuple(r) for r in counts] == [(0, 67, 0, 198), (1, 67, 1, 199), (2, 66, 2, 197)]
    got = [r["id"] for r in spark.read.parquet(str(folder / "s")).orderBy("place").collect()]
    assert got == sorted(range(200), key=lambda i: ((i * 37 % 200) / 8, i))
    files = {r["path"]: (r["bytes"], r["sha256"]) for r in evidence.file_inventory(spark, str(folder / "s")).collect()}
    assert files and all(hashlib.sha256((folder / "s" / p).read_bytes()).hexdigest() == h for p, (_, h) in files.items())


def test_reports_and_json(spark, folder):
    (folder / "a.rpt").write_text("head\nversion 7 \nrest")
    (folder / "b.rpt").write_text("version 70\n")
    assert {r["path"].rsplit("/", 1)[1]: r["ok"] for r in evidence.read_reports(spark, str(folder / "*.rpt"), "version 7").collect()} == {"a.rpt": True, "b.rpt": False}
    (folder / "a.json").write_text('{\n"n": 1}')
    (folder / "b.json").write_text('{"n": ')
    got = {r["path"].rsplit("/", 1)[1]: (r["n"], r["_corrupt_record"] is not None) for r in evidence.read_json_evidence(spark, str(folder / "*.json"), T.StructType([T.StructField("n", T.LongType())])).collect()}
    assert got == {"a.json": (1, False), "b.json": (None, True)}


def stream(spark, folder, name, rows, schema, build):
    """Write ``rows`` as a new file of the source, and drain the stream from where it stopped."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / name))
    return jobs.run_once(spark, build(spark.readStream.schema(schema).parquet(str(folder / name))), str(folder / f"{name}-out"))


def test_case_states_go_on_after_a_restart(spark, folder):
    schema = "case_id long, sequence long, state string"
    build = lambda df: jobs.stream_case_state(df, jobs.ALLOWED)
    stream(spark, folder, "s", [(1, 2, "running"), (1, 1, "planned"), (1, 3, "accepted"), (2, 5, None), (2, None, "failed")], schema, build)
    got = stream(spark, folder, "s", [(1, 2, "measured"), (1, 9, "failed"), (1, 10, "running"), (2, 6, "running"), (3, 1, "running")], schema, build)  # sequence 2 comes late
    rows = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0], r[1] or 0, r[2] or ""))
    assert rows == [
        (1, 1, "planned", True, "planned", 0), (1, 2, "measured", True, "measured", 1), (1, 2, "running", True, "running", 1), (1, 3, "accepted", False, "running", 1), (1, 9, "failed", True, "failed", 1), (1, 10, "running", True, "running", 2),
        (2, None, "failed", True, "failed", 0), (2, 5, None, False, "failed", 0), (2, 6, "running", True, "running", 1), (3, 1, "running", True, "running", 1),
    ]


def test_claims_are_released_and_kept_over_batches(spark, folder):
    schema = "fingerprint string, sequence long, case_id long, released boolean"
    stream(spark, folder, "c", [("k", 1, 10, False), ("k", 2, 11, False), ("k", 3, 11, True), ("k", 4, 10, True), ("k", 5, 11, False), ("m", 1, 7, True)], schema, jobs.stream_first_claim)
    got = stream(spark, folder, "c", [("k", 6, 10, False), ("m", 2, 8, False), ("k", 0, 11, True), ("k", 7, 12, False)], schema, jobs.stream_first_claim)
    granted = {(r["fingerprint"], r["sequence"]): r["granted"] for r in got.collect()}
    assert granted == {("k", 1): True, ("k", 2): False, ("k", 3): False, ("k", 4): True, ("k", 5): True, ("m", 1): False, ("k", 0): True, ("k", 6): True, ("k", 7): False, ("m", 2): True}
    once = stream(spark, folder, "d", [("a", 1)] * 3 + [(None, 1)], "key string, v int", lambda df: jobs.stream_measurement_dedupe(df, ["key"]))
    assert once.count() == 2 and stream(spark, folder, "d", [("a", 2), ("b", 1)], "key string, v int", lambda df: jobs.stream_measurement_dedupe(df, ["key"])).where(F.col("key") == "a").count() == 1
