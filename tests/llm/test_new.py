"""Prefix trie, archives and hard negatives against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import negatives, trie, warc


def brute_trie(rows):
    own = {}
    item = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest()
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", item(role or "", text or ""), text or ""))
    own = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for k, members in nodes.items():
        under = [x for x in nodes if x[: len(k)] == k]
        leaf = lambda x: not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in nodes)
        ends = ",".join(map(str, sorted(c for c in members if len(made[c]) == len(k))))
        out[(min(members), len(k))] = (
            min(nodes[k[:-1]]) if k else None, len(members), sum(len(y) == len(k) + 1 and y[: len(k)] == k for y in nodes), sum(map(leaf, under)),
            sum((len(nodes[x]) - 1) * len(x[-1][1].split()) for x in under if x), hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def trie_of(df, height):
    return {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in trie.prefix_trie(df, height).collect()}


KIND = "conv_id long, turn long, role string, text string, depth int, key string"


@pytest.mark.parametrize("height", [2, 8])
def test_trie_equals_brute_force(spark, height):
    rng = random.Random(height)
    rows = []
    for c in [*range(48), *range(200, 215)]:
        for t in range(rng.choice([1, 2, 3, 4, 9, 14])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["a b c", "d", "", None]) if t < 3 else "go on then", 1, "x"))
    rows += [(60, None, None, None, 1, "x"), (60, 3, "user", "u", 1, "x"), (60, 3, "user", "u", 1, "x"), (60, 3, "user", "b", 1, "x"), (None, 0, "user", "no id", 1, "x"), (61, 0, "user", "w " * 50_000, 1, "x")]
    df = spark.createDataFrame(rows, KIND)
    assert trie_of(df, height) == brute_trie([r[:4] for r in rows])


def test_trie_of_one_very_long_conversation_and_none(spark):
    rows = [(40, t, "user", f"turn {t}", 1, "x") for t in range(700)] + [(c, 0, "user", "only", 1, "x") for c in range(100, 400)]
    got = trie_of(spark.createDataFrame(rows, KIND).repartition(7), 4)
    long = [d for c, d in got if c == 40]
    h = zlib.crc32(b"40") % 4
    assert max(long) == 700 and got[(40, 700)][3] == 1 and len(long) >= 699 and h < 4
    assert sum(v[1] for (c, d), v in got.items() if d == 1) == 1 + 300
    assert trie_of(spark.createDataFrame([], KIND), 8) == {}


def test_positions_of_a_key_over_many_ranges(spark):
    rows = [("hot", i // 3) for i in range(3000)] + [(f"k{i}", j) for i in range(50) for j in range(i % 4)] + [(None, 1)]
    df = spark.createDataFrame(rows, "key string, v int").repartition(5)
    got = {}
    for r in trie.positions(df, "key", ["v"]).collect():
        got.setdefault(r["key"], []).append((r["pos"], r["v"]))
    for v in got.values():
        v.sort()
        assert [p for p, _ in v] == list(range(len(v))) and [x for _, x in v] == sorted(x for _, x in v)


def test_archives_in_small_splits(spark, tmp_path):
    rng = random.Random(4)
    trap = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Page-ID: 999999\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    bits = ["\r\n\r\n", "\r\n", "\n", "\r", "plain words ", "é語", "WARC/1.1\r\n", "Content-Length: 5\r\n", trap.format(3, "abc"), trap.format(5000, "x"), trap.format(0, ""), "x" * 700]
    rows = [(i, f"http://h{i % 3}.org/{i}", "".join(rng.choice(bits) for _ in range(rng.randrange(0, 12))), "clash") for i in range(300)]
    rows += [(i, None, "the same page " * 20, "clash") for i in range(1000, 1040)] + [(2000, "u\r\nWARC-Type: x", None, None), (2001, "u" * 5000, "", None), (2002, "", "long\n" * 30_000, None), (None, "n", "the same page " * 20, None), (None, None, None, None)]
    rows += [rows[0], rows[0]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, file string")
    want = {}
    first = {}
    for i, _, html, _ in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    for i, _, html, _ in rows:
        raw = (html or "").encode()
        again = i is not None and len(raw) >= 20 and i > first[html or ""]
        key = (i, len(raw), warc_digest(raw), "revisit" if again else "response", first[html or ""] if again else None)
        want[key] = want.get(key, 0) + 1
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = str(tmp_path / "archive")
    warc.write_warc(df.repartition(2), path, 20)
    for size in (4001, 10**8):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            got = {}
            records = warc.read_warc(spark, path)
            texts = {}
            for r in records.collect():
                texts.setdefault((r["page_id"], r["type"]), set()).add(bytes(r["payload"]))
            assert {i for i, _ in texts} == {i for i, *_ in rows}
            for i, _, html, _ in rows:
                raw = (html or "").encode()
                again = i is not None and len(raw) >= 20 and i > first[html or ""]
                assert (b"" if again else raw) in texts[(i, "revisit" if again else "response")]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
            spark.conf.unset("spark.sql.files.openCostInBytes")
    for r in warc.archived(df, str(tmp_path / "b"), 20).collect():
        key = tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
        got[key] = got.get(key, 0) + 1
    assert got == want
    assert warc.archived(df.where("false"), str(tmp_path / "c")).count() == 0


def warc_digest(raw):
    import base64

    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def test_chain_ends_at_garbage_and_at_a_cut_record(spark, tmp_path):
    record = lambda i, body: f"WARC/1.0\r\nwarc-type: response\r\nWARC-Page-ID: {i}\r\nX:\r\n folded: y\r\ncontent-length:  {len(body)}\r\n\r\n{body}\r\n\r\n"
    (tmp_path / "a").write_bytes((record(1, "one") + record(2, "WARC/1.0\r\n") + "rubbish\r\n" + record(3, "three")).encode())
    (tmp_path / "b").write_bytes((record(4, "four") + record(5, "five" * 100)).encode()[:-250])
    (tmp_path / "c").write_bytes(b"no record at all\r\n" + record(6, "six").encode())
    (tmp_path / "d").write_bytes(b"")
    assert sorted((r["page_id"], bytes(r["payload"])) for r in warc.read_warc(spark, str(tmp_path)).collect()) == [(1, b"one"), (2, b"WARC/1.0\r\n"), (4, b"four")]


def brute_negatives(rows, anchors):
    own = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and max(abs(x) for x in v) * 256 < 2**24:
            own.setdefault(len(v), []).append((i, label, [int(np.floor(256 * x)) for x in v]))
    out = set()
    for vectors in own.values():
        for a, la, q in vectors:
            if a not in anchors:
                continue
            scored = sorted((-sum(x * y for x, y in zip(q, v)), i, lv) for i, lv, v in vectors if i != a)
            for s, p, _ in [x for x in scored if x[2] == la][:5]:
                fits = [x for x in scored if x[2] != la and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
                out |= {(a, p, k + 1, i, -s, -n) for k, (n, i, _) in enumerate(fits)}
    return out


@pytest.mark.parametrize("shard, seeds, cells", [(64, 2, 200), (2048, 64, 1 << 21)])
def test_negatives_equal_brute_force(spark, monkeypatch, shard, seeds, cells):
    for name, value in (("SHARD", shard), ("SEED_SHARDS", seeds), ("ANCHOR_CELLS", cells), ("LEAF", 8), ("FANOUT", 3)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(shard)
    middle = rng.standard_normal((6, 12))
    x = middle[rng.integers(0, 6, 900)] + rng.standard_normal((900, 12)) * 0.2
    rows = [(i, [float(c) for c in v], int(rng.integers(0, 3))) for i, v in enumerate(x)]
    rows += [(2000 + i, rows[5][1], i % 4) for i in range(300)]  # a third are copies
    rows += [(3000, None, 1), (3001, [None] * 12, 1), (3002, [float("inf")] * 12, 1), (3003, rows[0][1], None), (3004, [], 1), (3005, [1e30] * 12, 1), (None, rows[0][1], 1)]
    rows += [(4000 + i, [float(i + 1), 2.0], i % 2) for i in range(12)] + [(5000 + i, [-1.0, 0.0] if i % 2 else [0.0, 1.0], 7) for i in range(4)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, label int, x string")
    anchors = set(range(0, 900, 60)) | {2000, 2151, 4000, 4003, 5000, 3000, 3004}
    got = [tuple(r) for r in negatives.hard_negatives(df, df.where(F.col("vec_id").isin(*anchors))).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows, anchors)
    assert negatives.hard_negatives(df, df.where("false")).count() == 0 and negatives.hard_negatives(df.where("false"), df.where("false")).count() == 0


def test_tiles_and_boxes():
    rng = np.random.default_rng(1)
    x, ids = rng.integers(-50, 50, (777, 5)), rng.permutation(777)
    order = negatives.str_order(x, 32)
    assert sorted(order) == list(range(777)) and list(negatives.str_order(x[:0], 32)) == []
    low, high, least, below = negatives.boxes(x[order], ids[order])
    assert (low[-1] == x.min(0)).all() and (high[-1] == x.max(0)).all() and least[-1] == 0
    for node, (b, e) in enumerate(below):
        if b >= 0:
            assert (low[node] == x[order][b:e].min(0)).all() and e - b <= 32
