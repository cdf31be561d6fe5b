"""The pipeline row by row against plain loops, and the edge cases of whole tables."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import common, decontaminate, langid, packing, quality, toxicity
from tests.llm.test_texts import brute_jaccard, brute_substring, corpus, longest_leak, words_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row map<string,int>, leaks string"
LABELS, BENCHMARK = "doc_id long, quality int, toxic int", "item_id long, text string"


def save(spark, folder, docs, labels, benchmark):
    for name, rows, schema in (("documents", docs, SCHEMA), ("labels", labels, LABELS), ("benchmark", benchmark, BENCHMARK)):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def key(row):
    return str(row["doc_id"]), str(row["text"])


def is_toxic(text, model):
    """By sums over distinct words, one at a time."""
    words = Counter(f for w in set((text or "").lower().split()) for f in set(model.hits(w)))
    score = sum(model.weights[f] * np.log2(1 + n) for f, n in words.items())
    return 1 / (1 + np.exp(model.cuts[0] - score)) >= model.threshold


def test_every_stage_equals_plain_loops(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, t, "en", "s", 0, {"a": 1}, "keep") for i, t, *_ in corpus(9, 60)]
    items = [[f"w{rng.randrange(400)}" for _ in range(20)] for _ in range(8)]
    labels = []
    for i in range(60):  # planted: toxic texts, and clean ones of the same words
        words = [f"w{rng.randrange(400)}" for _ in range(50)]
        words[::9] = rng.choices(["vileword", "rottenword", "foulword"], k=6) if i % 2 else words[::9]
        rows.append((5000 + i, " ".join(words), "en", "s", 0, None, None))
        labels.append((5000 + i, 1, i % 2))
    rows += [(6000 + i, " ".join([*(f"v{i}{k}" for k in range(30)), *items[i][2 : 12 + i], f"v{i}"]), "en", "s", 0, None, None) for i in range(8)]  # 10 to 17 words of an item
    sf_dir = save(spark, tmp_path, rows, labels, [*((i, " ".join(item)) for i, item in enumerate(items)), (20, None), (1, " ".join(items[1]))])
    docs = common.table(spark, sf_dir, "documents")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(common.written(stage(spark, steps[-1], sf_dir)))
        assert steps[-1].columns == docs.columns
    first, polite, single, cut, clean = ([r.asDict() for r in s.collect()] for s in steps)

    model = toxicity.fit_labelled(docs, common.table(spark, sf_dir, "labels"))
    assert sorted(map(key, polite)) == sorted(key(r) for r in first if not is_toxic(r["text"], model))
    caught = {r["doc_id"] for r in first} - {r["doc_id"] for r in polite}
    assert caught == {5000 + i for i in range(60) if i % 2}

    low = {i: c for i, _, c in brute_jaccard([(r["doc_id"], r["text"]) for r in polite]) if i is not None}
    texts = {}
    for r in polite:
        if r["doc_id"] is not None and low[r["doc_id"]] == r["doc_id"]:
            texts.setdefault(r["doc_id"], []).append(r["text"])
    kept = [(str(i), str(min(own, key=lambda t: (t is not None, t or "")))) for i, own in texts.items()]
    assert sorted(map(key, single)) == sorted([*kept, *(key(r) for r in polite if r["doc_id"] is None)])

    removed = Counter({i: gone for i, _, gone, _ in brute_substring([(r["doc_id"], r["text"]) for r in single])})
    before = {r["doc_id"]: r["text"] for r in single if r["doc_id"] is not None}
    assert all(len(words_of(before[r["doc_id"]])) - len(words_of(r["text"])) == removed[r["doc_id"]] for r in cut if r["doc_id"] is not None)
    assert sum(removed.values()) > 0 and len(cut) == len(single)

    leaking = {key(r) for r in cut if any(longest_leak(item, words_of(r["text"]), 13) for item in items)}
    assert sorted(map(key, clean)) == sorted(key(r) for r in cut if key(r) not in leaking)
    assert {int(i) for i, _ in leaking} & set(range(6000, 6008)) == set(range(6003, 6008))
    assert all(r["row"] == {"a": 1} and r["leaks"] == "keep" for r in clean if r["doc_id"] is not None and r["doc_id"] < 5000)

    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    want = Counter((r["doc_id"], r["piece"], r["length"]) for r in packing.pack_documents(spark.createDataFrame([(r["doc_id"], r["text"]) for r in clean], "doc_id long, text string")).collect())
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in pieces) == want
    spans = {}
    for r in pieces:
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in spans.values():
        assert [o for o, _ in sorted(own)] == list(np.cumsum([0] + [n for _, n in sorted(own)])[:-1]) and sum(n for _, n in own) <= 4096


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_pipeline_with_an_empty_table(spark, tmp_path, empty):
    rows = [(i, f"some words of text {i} " * 4, "en", "s", 0, None, None) for i in range(6)]
    tables = {"documents": rows, "labels": [(i, 1, i % 2) for i in range(6)], "benchmark": [(1, "nothing like it")]}
    tables[empty] = []
    out = corpus_pipeline.run(spark, save(spark, tmp_path, tables["documents"], tables["labels"], tables["benchmark"])).collect()
    assert bool(out) == (empty != "documents") and all(r["length"] > 0 for r in out)


def test_leaks_of_no_documents_and_of_a_very_long_one(spark):
    item = " ".join(f"w{i}" for i in range(15))
    bench = spark.createDataFrame([(1, item), (1, item)], BENCHMARK)
    docs = spark.createDataFrame([(1, "filler word " * 150_000 + item + " filler" * 1000)], "doc_id long, text string")
    (row,) = decontaminate.find_leaks(docs, bench).collect()
    assert [(x["item_id"], x["words"], x["start"]) for x in row["leaks"]] == [(1, 15, 300_000)] * 2
    assert decontaminate.find_leaks(docs.where("false"), bench).count() == 0


def test_languages_of_a_line_without_blanks(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choice("語文字言" if i % 2 else "abcd") for _ in range(4)) for _ in range(40)), "zh" if i % 2 else "en") for i in range(80)]
    rows += [(900, "".join(rng.choice("語文字言") for _ in range(100_000)), None), (901, "abcd" * 25_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, langid.fit_labelled(docs, rows=80, words=4000)).collect()}
    assert got[900] == "zh" and got[901] == "en"


def test_quality_of_a_very_long_text_and_clashing_names(spark):
    rows = [(i, "good plain words here " * 20 if i % 2 else "%%% ### " * 30, "h", 1.0, 2.0, "p") for i in range(40)] + [(99, "good plain words here " * 100_000, "h", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, x double, q double, path string")
    got = {r["doc_id"]: r for r in quality.score(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"), F.col("host"), F.col("path")).collect()}
    assert len(got) == 41 and 0 <= got[99]["q"] <= 1 and got[1]["kept"] and not got[2]["kept"] and got[99]["path"] == ""
