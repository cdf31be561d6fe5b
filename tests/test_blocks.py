"""Joins with packed values, whose results have the square of a key: against brute force or SQL, with hot keys, small slices, nulls and repeats."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import lineage
from millrace.operators import intervals
from tests.test_ranges import some_intervals
from tests.test_sizes import one_class, same


@pytest.fixture
def small(monkeypatch):
    """Sizes so small that some tens of rows fill blocks, slices and shares."""
    for name, n in (("PACKED_VALUES", 3), ("PACKED_ROWS", 2), ("SLICE_VALUES", 7), ("KEY_PAIRS", 60)):
        monkeypatch.setattr(lineage, name, n)


def joined(spark, run):
    """The most rows that a join emits in what ``run`` executes."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    found, execs = [0], store.executionsList()
    for i in range(before, execs.size()):
        key = execs.apply(i).executionId()
        values, nodes = store.executionMetrics(key), store.planGraph(key).allNodes()
        for node in (nodes.apply(j) for j in range(nodes.size())):
            for m in (node.metrics().apply(k) for k in range(node.metrics().size()) if "Join" in node.name()):
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    found.append(int(values.apply(m.accumulatorId()).replace(",", "")))
    return max(found)


def tasks(df):
    """Tasks that make rows of ``df``."""
    return df.select(F.spark_partition_id()).distinct().count()


def test_values_are_packed_in_order(spark, small):
    df = spark.createDataFrame([("a", i % 5 if i else None) for i in range(8)] + [(None, 1)], "k string, v long")
    got = {(r["k"], r["_block"]): r["_values"] for r in lineage.packed(df, ["k"], "v").collect()}
    assert got == {("a", 0): [None, 0, 1], ("a", 1): [1, 2, 2], ("a", 2): [3, 4], (None, 0): [1]}


def test_rows_meet_every_block_of_a_hot_key_once(spark, small):
    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [("one", 1), (None, 2), ("none", 3)], "k string, r long")
    values = spark.createDataFrame([("hot", i) for i in range(40)] + [("one", 1), (None, 2), ("other", 3)], "k string, v long")
    got = lineage.block_join(rows, lineage.packed(values, ["k"], "v").drop("_block"), ["k"])
    pairs = sorted((r["k"], r["r"], v) for r in got.collect() for v in r["_values"])
    assert pairs == sorted([("hot", r, v) for r in range(50) for v in range(40)] + [("one", 1, 1)]) and tasks(got) > 1


def test_windows_of_small_slices(spark, small):
    rng = random.Random(8)
    measured = [(i, rng.choice("xxxy"), rng.randrange(0, 400) / 16384) for i in range(90)] + [(900, "x", None), (901, None, 0.1), (902, "x", 0.125), (902, "x", 0.125)]
    specs = [(i % 30, "t" if i % 3 else None, "x", v, v + w) for i, (v, w) in enumerate((rng.choice([0.0, 0.01]), rng.choice([0.0, 0.02])) for _ in range(40))] + [(90, "t", "x", 0.5, 0.25), (91, "t", "x", None, 1.0), (92, "t", None, 0.0, 1.0), (93, "t", "x", 0.125, 0.125)]
    m, s = spark.createDataFrame(measured, "m long, hierarchy_group string, slack_ns double").repartition(3), spark.createDataFrame(specs, "s long, tag string, hierarchy_group string, low double, high double")
    want = sorted(((i, n, t, lo, hi, round(abs(v - (lo + hi) / 2), 3)) for i, g, v in measured for n, t, h, lo, hi in specs if g and g == h and v is not None and lo is not None and lo <= v <= hi), key=repr)
    got = intervals.window_match(m, s, digits=3)
    assert sorted(((r["m"], r["s"], r["tag"], r["low"], r["high"], r["distance"]) for r in got.collect()), key=repr) == want


def test_equal_windows_are_compared_once(spark):
    measured = spark.range(0, 200).select(F.col("id").alias("m"), F.lit("x").alias("hierarchy_group"), (F.col("id") / 1e4).alias("slack_ns"))
    specs = spark.range(0, 500).select(F.col("id").alias("s"), F.lit("x").alias("hierarchy_group"), F.lit(0.0).alias("low"), F.lit(0.02).alias("high"))
    found = []
    assert joined(spark, lambda: found.append(intervals.window_match(measured, specs).count())) < 2000 and found == [200 * 500]


def test_one_hot_window_takes_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(lineage, "KEY_PAIRS", 1000)
    measured = spark.range(0, 400).selectExpr("id AS m", "if(id < 0, 'y', 'x') AS hierarchy_group", "id * 1e-9D AS slack_ns")
    specs = spark.range(0, 50).selectExpr("id AS s", "if(id < 0, 'y', 'x') AS hierarchy_group", "0D AS low", "0.02D AS high")
    got = intervals.window_match(measured, specs)
    assert got.count() == 400 * 50 and tasks(got) > 4


def test_overlaps_of_small_slices(spark, small):
    rows = some_intervals() + [(300 + i, "a", 5, 2) for i in range(30)] + [(310, "a", 5, 2), (None, "a", 5, 2)]
    df = spark.createDataFrame(rows, "id long, timing string, first_rank long, n_ranks long").repartition(3)
    good = [r for r in rows if None not in r and r[3] > 0]
    want = sorted((a[1], a[0], b[0]) for a in good for b in good if a[0] < b[0] and a[1] == b[1] and a[2] < b[2] + b[3] and b[2] < a[2] + a[3])
    assert sorted(tuple(r) for r in intervals.interval_overlap(df).collect()) == want


def test_equal_intervals_are_compared_once(spark, monkeypatch):
    monkeypatch.setattr(lineage, "KEY_PAIRS", 1000)
    df = spark.range(0, 900).selectExpr("id", "if(id < 0, 'u', 't') AS timing", "id % 3 AS first_rank", "2L AS n_ranks")
    found = []
    assert joined(spark, lambda: found.append(intervals.interval_overlap(df).count())) < 20_000
    assert found == [3 * 300 * 299 // 2 + 2 * 300 * 300] and tasks(intervals.interval_overlap(df)) > 4


@pytest.mark.parametrize("name", "ladder_levels ladder_candidates ladder_candidates_up".split())
def test_variants_of_a_drive_are_joined_together(spark, folder, name):
    tables = one_class(spark)
    pairs = []
    assert joined(spark, lambda: pairs.append(len(same(spark, folder, name, **tables)))) < 2000 and pairs[0] > 50_000


@pytest.mark.parametrize("name", "ladder_levels ladder_candidates ladder_candidates_up".split())
def test_ladders_of_small_slices(spark, folder, small, name):
    tables = one_class(spark)
    odd = spark.createDataFrame([(5000, None, "t", 3), (5001, "b", None, 3), (5002, "b", "t", None), (5003, "c", "t", 4)], "p_partkey long, p_brand string, p_type string, p_size int")
    assert same(spark, folder, name, orders=tables["orders"], lineitem=tables["lineitem"], part=tables["part"].where("p_partkey % 13 = 0").unionByName(odd))
