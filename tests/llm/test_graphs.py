"""URL trust, embedding index, chat trees and the pipeline."""

import random

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import chat, common, embedding, urls


def test_urls(spark):
    rows = [
        (1, "http://a.com/x", '<a href="http://b.org/1">x</a><a href="//c.org">'), (2, "http://b.org/", "<a class=x href=https://C.org/>"), (3, "http://c.org", ""), (4, "http://q.org/z", '<a href="http://bad.net/es/">'),
        (5, "http://bad.net/es/1", None), (6, None, None), (7, "nope", '<a href="http://c.org">'), (8, "HTTP://Bad.NET/fr/?x", ""), (9, "http://z.org?u=http://a.com/en/", ""), (10, "https://www.example.com/en/", None), (11, "https://m.example.com/en/#x", None), (9, "http://z.org?u=http://a.com/en/", ""),
    ]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")))
    by = {r["page_id"]: r for r in got.collect()}
    assert got.count() == len(rows)
    assert (by[9]["host"], by[9]["path"], by[9]["rule"]) == ("z.org", "", None)
    assert (by[6]["host"], by[6]["path"], by[6]["verdict"]) == (by[7]["host"], by[7]["path"], by[7]["verdict"]) == ("", "", "allow")
    assert by[4]["verdict"] == "block" and abs(by[4]["distrust"] - 0.85) < 1e-9
    assert by[2]["verdict"] == "allow" and abs(by[2]["trust"] - 0.425) < 1e-9
    assert by[8]["rule"] == "net/fr/" and by[10]["rule"] == "www.example.com/en/" and by[11]["rule"] == "example.com/en/" and by[3]["rule"] is None
    assert urls.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_urls_distrust_of_a_hub_with_many_linkers(spark):
    rows = [(0, "http://hub.net/es/", None)] + [(i, f"http://h{i}.org/", '<a href="http://hub.net/">' + '<a href="http://fine.org/">' * (i % 2)) for i in range(1, 301)]
    rows += [(1000, "http://mixed.org/", '<a href="http://hub.net/">' + '<a href="http://fine.org/">' * 3)]
    by = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(1, 301):
        assert abs(by[i]["distrust"] - 0.85 / (1 + i % 2)) < 1e-9 and by[i]["verdict"] == ("allow" if i % 2 else "block")
    assert abs(by[1000]["distrust"] - 0.85 / 4) < 1e-9 and by[1000]["verdict"] == "allow"


def test_urls_subdomains_take_from_their_parent_and_not_from_each_other(spark):
    bad = [(i, f"http://bad.shop.co.net/es/{i}", None) for i in range(9)]  # a tenant whose pages are all blocked
    rows = [*bad, (20, "http://fine.shop.co.net/x", None), (21, "http://shop.co.net/y", None), (22, "http://other.co.net/z", None)]  # co.net has no pages of its own
    rows += [(30, "http://evil.net/fr/", None), (31, "http://www.evil.net/home", None), (32, "http://evil.org/home", None)]
    by = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(by[i]["verdict"] == "allow" and by[i]["distrust"] == 0 for i in (20, 21, 22, 32))
    assert by[31]["verdict"] == "block" and abs(by[31]["distrust"] - 0.85) < 1e-9 and by[30]["verdict"] == "block"


def test_urls_scores_stay_shares(spark):
    ring = [(i, f"http://r{i % 5}.org/" if i % 2 else f"http://r{i % 5}.net/es/", f'<a href="http://r{(i + 1) % 5}.org/"><a href="http://r{(i + 2) % 5}.net/">') for i in range(40)]
    rows = [*ring, (90, "http://good.com/", "".join(f'<a href="http://r{i}.org/">' for i in range(5))), *((100 + i, f"http://g{i}.com/", '<a href="http://r1.org/">') for i in range(9))]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(0 <= r["distrust"] <= 1 and 0 <= r["trust"] <= 1 for r in got) and max(r["trust"] for r in got if r["host"] == "r1.org") == 1


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(40)] + [(200, i) for i in range(201, 300)] + [(5, 5), (None, 3)]
    got = {r["id"]: r["component_id"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {i: i for e in edges if None not in e for i in e}
    for _ in range(200):
        for a, b in edges:
            if a is not None:
                low[a] = low[b] = min(low[a], low[b])
    assert got == {i: c for i, c in low.items() if any(i in e and e[0] != e[1] and None not in e for e in edges)}


def test_embedding_recall_and_edges(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 16)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((60, 24))
    near = np.concatenate([base, base[:40] + rng.standard_normal((40, 24)) * 0.03, base[:20] * 3.0, base[:5]])
    rows = [(i, [float(x) for x in v], int(i % 60 % 3), "c") for i, v in enumerate(near)]
    rows += [(900, None, 1, None), (901, [0.0] * 24, 1, None), (902, [float("nan")] + [1.0] * 23, 1, None), (903, rows[0][1], None, None), (904, rows[0][1][:10], 0, None), (905, [], 1, None), (906, [None] + [1.0] * 23, 1, None), (None, rows[0][1], 0, None)]
    got = {r["vec_id"]: r for r in embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, rep string")).collect()}
    unit = near / np.linalg.norm(near, axis=1, keepdims=True)
    same = np.array([i % 60 % 3 for i in range(len(near))])
    links = (unit @ unit.T >= 0.98) & (same[:, None] == same[None, :])
    want = links.sum(1) - 1
    found = sum(got[i]["n_links"] for i in range(len(near)))
    assert all(got[i]["n_links"] <= want[i] for i in range(len(near))) and found >= 0.9 * want.sum()
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in (900, 901, 902, 903, 904, 905, 906))
    assert got[None]["n_links"] == 0 and got[None]["kept"]
    assert embedding.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_embedding_one_list_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(embedding, "BLOCK", 16)
    monkeypatch.setattr(embedding, "LEAST_PIVOTS", 1)
    monkeypatch.setattr(embedding, "MOST_PIVOTS", 1)  # one pivot: a single list, dealt over blocks
    rng = np.random.default_rng(5)
    base = rng.standard_normal((100, 12))
    vectors = np.concatenate([base, base[:30] + rng.standard_normal((30, 12)) * 0.02, np.ones((60, 12)) + rng.standard_normal((60, 12)) * 0.01])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)]
    got = {r["vec_id"]: r for r in embedding.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert len(got) == len(rows)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    root = np.arange(len(rows))
    for _ in range(len(rows)):
        root = np.where(near, root[None, :], len(rows)).min(1)
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(len(rows))] == [(int(n) - 1, int(r)) for n, r in zip(near.sum(1), root)]


def test_chat_tree_paths_and_round_trip(spark):
    nodes = [("t", 1, None, "user", "hi", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 2.0), ("t", 4, 3, "user", None, None), ("t", 5, 4, "assistant", "\\<|im_end|> \\n", 1.0), ("t", 9, 77, "user", "lost parent", 0.0), ("u", 1, 2, "x", "cycle", 0.0), ("u", 2, 1, "x", "cycle", 0.0), (None, 1, None, "user", "no tree", 0.0)]
    n = spark.createDataFrame(nodes, "tree_id string, node_id long, parent_id long, role string, text string, score double")
    got = chat.tree_paths(n).collect()
    paths = {}
    for r in sorted(got, key=lambda r: r["depth"]):
        paths.setdefault((r["tree_id"], r["path_id"], r["branch"]), []).append(r["node_id"])
    assert paths == {("t", 5, 1): [1, 3, 4, 5], ("t", 2, 2): [1, 2], ("t", 9, 3): [9]}
    best = chat.format_paths(chat.tree_paths(n, branches=1), n).select(chat.parse(F.col("formatted")).alias("t"), F.transform("loss_spans", lambda s: chat.unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))).alias("loss")).collect()
    assert [[tuple(x) for x in r["t"]] for r in best] == [[("user", "hi"), ("assistant", "b"), ("user", ""), ("assistant", "\\<|im_end|> \\n")]]
    assert best[0]["loss"] == ["b", "\\<|im_end|> \\n"]


def test_chat_conversations_with_ties(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, "sys\ntem\\n<|", None), (1, 5, None, "<|im_start|>assistant\nboo\\"), (2, 3, "assistant", ""), (None, 1, "user", "lost")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("score", F.lit(1)))
    got = {r["tree_id"]: [tuple(t) for t in r["t"]] for r in made.select("tree_id", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("sys\ntem\\n<|", ""), ("user", "x"), ("user", "x"), ("", "<|im_start|>assistant\nboo\\")], 2: [("assistant", "")]}
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_pipeline_stages(spark, folder):
    import corpus_pipeline
    from tests.llm.test_texts import corpus

    rows = [(i, t, "en", "s", len(t or "")) for i, t, *_ in corpus(7, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 30 == 0)) for i in range(0, 90, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, rows[0][1])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(folder))
        assert now.columns == docs.columns
        now = common.written(now)
    assert now.where("doc_id is not null").count() == now.where("doc_id is not null").select("doc_id").distinct().count()
    out = corpus_pipeline.run(spark, str(folder))
    assert out.where("offset + length > 4096").count() == 0 and out.count() >= now.count()
