"""Range and nearest joins, sweeps and automata against brute force, with nulls, ties, hot keys and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.automaton import Automaton
from millrace.lineage import running
from millrace.operators import containment, intervals


def some_intervals():
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b"]), rng.randrange(-50, 400), rng.choice([1, 1, 2, 5, 17])) for i in range(160)]
    rows += [(200, "a", -1000, 5000), (201, "a", 0, 300), (202, "b", 10, 0), (203, None, 1, 4), (204, "a", None, 4), (205, "a", 7, None), (0, "a", 3, 4)]
    return rows


def test_overlaps_and_their_counts(spark):
    rows = some_intervals()
    df = spark.createDataFrame(rows, "id long, timing string, first_rank long, n_ranks long").repartition(3)
    meets = lambda a, b: a[1] is not None and a[1] == b[1] and a[2] < b[2] + b[3] and b[2] < a[2] + a[3]
    good = [r for r in rows if None not in r and r[3] > 0]
    want = sorted((a[1], a[0], b[0]) for a in good for b in good if a[0] < b[0] and meets(a, b))
    assert sorted(tuple(r) for r in intervals.interval_overlap(df).collect()) == want
    once = [r for r in good if r[0] != 0]
    counts = {(r["timing"], r["id"]): r["n_overlaps"] for r in intervals.overlap_counts(df.where("id <> 0")).collect() if r["timing"]}
    assert counts == {(a[1], a[0]): sum(a is not b and meets(a, b) for b in once) for a in once}
    assert intervals.interval_overlap(df.where("false")).count() == intervals.overlap_counts(df.where("false")).count() == 0


def test_windows_of_all_widths(spark):
    rng = random.Random(6)
    measured = [(i, rng.choice("xy"), rng.randrange(0, 4000) / 16384) for i in range(300)] + [(900, "x", None), (901, None, 0.1), (902, "x", 0.125), (902, "x", 0.125)]
    specs = [(i, rng.choice("xy"), v, v + w) for i in range(40) for v, w in [(rng.randrange(-100, 3000) / 16384, rng.choice([0.0, 1 / 16384, 0.05, 9.0]))]] + [(90, "x", 0.5, 0.25), (91, "x", None, 1.0), (92, None, 0.0, 1.0), (93, "x", 0.125, 0.125)]
    got = intervals.window_match(spark.createDataFrame(measured, "m long, hierarchy_group string, slack_ns double"), spark.createDataFrame(specs, "s long, hierarchy_group string, low double, high double"))
    want = sorted((m, s, abs(v - (lo + hi) / 2)) for m, g, v in measured for s, h, lo, hi in specs if g and g == h and v is not None and lo is not None and lo <= v <= hi)
    assert sorted((r["m"], r["s"], r["distance"]) for r in got.collect()) == want


@pytest.mark.parametrize("k", [1, 3])
def test_nearest_with_ties_and_one_family(spark, k):
    rng = random.Random(k)
    measured = [(i, "hot", rng.randrange(0, 60) / 4, float(i % 7)) for i in range(240)] + [(500, "one", 1.0, 4.0), (501, "hot", None, 1.0), (502, None, 1.0, 1.0)]
    asked = [(i, "hot", rng.randrange(-40, 300) / 8) for i in range(120)] + [(600, "one", 9.0), (601, "none", 1.0), (602, None, 1.0), (603, "hot", None), (0, "hot", 1.0), (0, "hot", 1.0)]
    m = spark.createDataFrame(measured, "cell long, family string, ratio double, value double").repartition(4)
    c = spark.createDataFrame(asked, "cell long, family string, ratio double")
    want = {}
    for key, f, at in asked:
        near = sorted((abs(at - x), i, v) for i, g, x, v in measured if g == f and f and x is not None and at is not None)[:k] if at is not None else []
        if near:
            want[key, f, at] = (len(near), round(sum(v for *_, v in near) / len(near), 9))
    got = [((r["cell"], r["family"], r["ratio"]), (r["n_analogues"], round(r["predicted"], 9))) for r in intervals.nearest_measured(c, m, k, ["family"], "ratio", "cell").collect()]
    assert len(got) == len(want) and dict(got) == want


def test_running_sums_over_ranges(spark):
    rows = [("hot", i, i % 3) for i in range(2000)] + [(f"k{i}", j, 1) for i in range(40) for j in range(i % 5)] + [(None, 1, 5), (None, 2, 7)]
    got = running(spark.createDataFrame(rows, "k string, at long, v long").repartition(6), ["k"], ["at"], {"n": "1", "s": "v"}).collect()
    assert len(got) == len(rows)
    for r in got:
        own = [v for k, at, v in rows if k == r["k"] and at <= r["at"]]
        assert (r["n"], r["s"]) == (len(own), sum(own))


def test_automata_find_every_pattern(monkeypatch):
    rng = random.Random(1)
    for _ in range(30):
        monkeypatch.setattr(Automaton, "PIECE", rng.choice([4, 7, 2048]))
        patterns = list({bytes(rng.choice(b"abc\xc3") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 25))})
        texts = [bytes(rng.choice(b"abcd\xc3") for _ in range(rng.randrange(0, 60))) for _ in range(20)]
        assert Automaton(patterns).find(texts) == {(i, j) for i, t in enumerate(texts) for j, p in enumerate(patterns) if p in t}
    assert Automaton([b"a"]).find([]) == Automaton([]).find([b"a"]) == set()


@pytest.mark.parametrize("size, most", [(1 << 18, 16), (40, 1000), (40, 0)])
def test_hidden_texts_of_any_number_of_words(spark, monkeypatch, size, most):
    monkeypatch.setattr(containment, "AUTOMATON_BYTES", size)
    words = "set the drive of cell u1 to a weaker one then check hold and route again é語".split()
    hidden = [(n, " ".join(words[:n])) for n in range(1, len(words) + 1)] + [(50, ""), (51, None), (52, "  drive \t\n of"), (53, "zz"), (54, "the drive"), (54, "cell u1")]
    rng = random.Random(2)
    messages = [(i, " ".join(words[a : a + n]) + rng.choice(["", " \n", "x"])) for i, (a, n) in enumerate((rng.randrange(0, 9), rng.randrange(1, 18)) for _ in range(80))]
    messages += [(900, None), (901, ""), (902, "pad " * 9000 + " ".join(words)), (903, "a drive  \n of it"), (903, "other")]
    clean = lambda t: "\n".join(x.rstrip(" \t") for x in t.split("\n")).strip(" ")
    want = {(d, i) for d, m in messages for i, h in hidden if m and h and clean(h) and clean(h) in clean(m)}
    got = containment.hidden_text_containment(spark.createDataFrame(messages, "doc_id long, text string"), spark.createDataFrame(hidden, "item_id long, text string"), most)
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) == want and len(rows) == len(want)
    plan = got._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert containment.hidden_text_containment(got.select("doc_id", F.lit("a").alias("text")), spark.createDataFrame([], "item_id long, text string")).count() == 0
