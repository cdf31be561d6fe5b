"""Queries against their SQL on tables large or odd enough to meet rules that the smallest tables don't."""

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from millrace.operators import timing
from millrace.operators.probes import written_constraints
from millrace.operators.replay import pairs_in_classes
from millrace.sources.evidence import read_reports, write_files


def same(spark, folder, name, **tables):
    """``name`` over ``tables`` equals its SQL; returns the rows."""
    for k, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{k}.parquet")
    got = sorted(map(tuple, queries()[name](spark, str(folder)).collect()), key=repr)
    con = duckdb.connect()
    for k in tables:
        con.execute(f"CREATE VIEW {k} AS SELECT * FROM '{folder}/{k}.parquet/*.parquet'")
    assert got == sorted(map(tuple, con.execute(oracle_sql()[name]).fetchall()), key=repr)
    return got


def test_distribution_without_a_cell_of_one(spark, folder):
    part = spark.range(0, 60).select((F.col("id") * 5).alias("p_partkey"), F.lit("b").alias("p_brand"), (F.col("id") % 4).cast("string").alias("p_type"), (F.col("id") % 3).cast("int").alias("p_size"))
    assert len(same(spark, folder, "distribution_check", part=part)) == 13


def test_digests_of_trees_over_the_first_levels(spark, folder):
    docs = spark.range(0, 4150).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 4120, "large").otherwise("small").alias("source"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    for name in ("tree_digest", "tree_digest_deep"):
        assert len(same(spark, folder, name, documents=docs.unionByName(docs.limit(1).selectExpr("-1L AS doc_id", "'one' AS source", "text")))) == 3


def test_every_pair_of_a_thousand_ranks(spark, folder):
    orders = spark.range(0, 4000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), (F.col("id") * 50.0).alias("o_totalprice"), F.lit("O").alias("o_orderstatus"), F.lit("2020-01-01").cast("date").alias("o_orderdate"))
    assert len(same(spark, folder, "interval_overlap", orders=orders)) > 4000 * 4 / 2


def test_every_window_of_a_group(spark, folder):
    orders = spark.range(0, 500).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), (50000.0 + F.col("id") * 100).alias("o_totalprice"), F.lit("O").alias("o_orderstatus"), F.lit("2020-01-01").cast("date").alias("o_orderdate"))
    part = spark.range(0, 100).select((F.col("id") * 5 + 1).alias("p_partkey"), (F.col("id") % 50 + 1).cast("int").alias("p_size"))
    assert len(same(spark, folder, "window_match", orders=orders, part=part)) > 100


def test_no_probe_table_is_broadcast(spark):
    sdc = spark.createDataFrame([("p", "setup", "1", "OK", "a"), ("p", "setup", "2", "OK", "b")], "probe_id string, analysis string, sequence string, status string, relative_file string")
    files = spark.createDataFrame([("p", "a", "x"), ("p", "b", "x")], "probe_id string, relative_file string, text string")
    found = written_constraints(sdc, files)
    assert "Broadcast" not in found._jdf.queryExecution().toString() and [tuple(r) for r in found.collect()] == [("p", "setup", True, True, True, True)]


def test_a_file_for_each_name(spark, folder):
    rows = [(f"s_suppkey={i}.txt", line) for i in range(300) for line in ("version 7", f"é{i}")[: 1 + i % 2]]
    write_files(spark.createDataFrame(rows, "name string, value string"), str(folder / "reports"))
    got = {r["path"].split("=")[1]: r["text"] for r in read_reports(spark, str(folder / "reports"), "version 7").collect()}
    assert got == {f"{i}.txt": "version 7\n" + (f"é{i}\n" if i % 2 else "") for i in range(300)}
    assert not list((folder / "reports").glob("*/")) and len(list((folder / "reports").iterdir())) == 300


def test_pairs_of_a_class_are_made_for_questions_only(spark):
    members = spark.range(0, 3000).select(F.col("id").alias("ref"), (F.col("id") % 3).alias("drive"), F.when(F.col("id") < 2990, "c").alias("kind"))
    diffs = spark.createDataFrame([(1, 2), (2, 1), (1, 4), (1, 2), (2991, 2992), (1, None), (7, 9999)], "old_ref long, new_ref long")
    assert sorted(tuple(r) for r in pairs_in_classes(diffs, members, ["kind"]).collect()) == [(1, 2), (2, 1)]


def most(spark, metric, run):
    """The largest value that ``metric`` has in a step of the plans that ``run`` executes."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    found, execs = [0], store.executionsList()
    for i in range(before, execs.size()):
        key = execs.apply(i).executionId()
        values, nodes = store.executionMetrics(key), store.planGraph(key).allNodes()
        for m in (nodes.apply(j).metrics().apply(k) for j in range(nodes.size()) for k in range(nodes.apply(j).metrics().size())):
            if m.name() == metric and values.contains(m.accumulatorId()):
                found.append(int(values.apply(m.accumulatorId()).split("\n")[-1].split(" ")[0].replace(",", "")))
    return max(found)


def one_class(spark):
    """2,000 parts of one class with ten drives, and 100 points that ask for them; some candidates were measured."""
    part = spark.range(0, 2000).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), (F.col("id") % 10 + 1).cast("int").alias("p_size"))
    orders = spark.range(0, 20).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("1-URGENT").alias("o_orderpriority"), (50000.0 + F.col("id") * 100).alias("o_totalprice"), F.lit("O").alias("o_orderstatus"), F.lit("2020-01-01").cast("date").alias("o_orderdate"))
    line = spark.range(0, 100).select((F.col("id") % 20).alias("l_orderkey"), (F.col("id") * 13).alias("l_partkey"), F.lit(3).cast("long").alias("l_suppkey"), F.expr("int(id / 20) + 1").alias("l_linenumber"), F.lit(1.0).alias("l_quantity"), (F.col("id") * 7.0 + 100).alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"), F.when(F.col("id") < 90, "A").otherwise("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), F.lit("2020-01-01").cast("date").alias("l_shipdate"))
    return {"part": part, "orders": orders, "lineitem": line}


@pytest.mark.parametrize("name", "topk_candidates mine_candidates endpoint_specialists ladder_levels ladder_candidates ladder_candidates_up".split())
def test_ladders_of_a_large_class_are_not_made(spark, folder, name):
    assert most(spark, "number of output rows", lambda: same(spark, folder, name, **one_class(spark))) < 200_000  # the class has 3,600,000 pairs


def test_measured_first_variants_give_way(spark, folder):
    parts, tables = spark.createDataFrame([(i, "b", "t", 1 + i // 300) for i in range(600)], "p_partkey long, p_brand string, p_type string, p_size int"), one_class(spark)
    line = tables["lineitem"].withColumns({"l_partkey": F.expr("388 + (l_orderkey % 2) * 97"), "l_suppkey": F.col("l_orderkey")})  # measured: new_ref 0, the first ref of the only lower drive
    got = same(spark, folder, "mine_candidates", part=parts, orders=tables["orders"], lineitem=line)
    assert got and all(r[2] > 0 for r in got)


def test_pairs_of_a_group_are_not_shuffled(spark, folder):
    part = spark.range(0, 300).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type"), F.lit(1).alias("p_size"))
    part = part.unionByName(spark.createDataFrame([(0, "c", "t", 1), (1, "c", "t", 1), (1, "c", "t", 1), (7000, "c", "t", 1), (7001, None, "t", 1)], "p_partkey long, p_brand string, p_type string, p_size int"))
    assert most(spark, "shuffle records written", lambda: same(spark, folder, "equivalence_ladders", part=part)) < 10_000


@pytest.mark.parametrize("name", "parse_fix_operations parse_path_points endpoint_local_cells".split())
def test_lines_are_shuffled_once_to_their_group(spark, name):
    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == (2 if name == "endpoint_local_cells" else 1)  # of lines by order, then by instance; orders are broadcast here


def test_first_candidates_suffice_unless_they_were_measured(spark, monkeypatch):
    rows = spark.range(0, 5000, 1, 4).selectExpr("concat('i', cast(id % 900 as string)) AS instance", "id % 7 AS new_ref", "id AS path_id", "id % 5 AS point_index", "if(id = 4999, null, (id * 37 % 1000) / 8D) AS predicted_ns").cache()
    for seen in ("false", "instance like 'i1%'", "predicted_ns < 100", "predicted_ns < 124"):
        want = {}
        for r in sorted(rows.collect(), key=lambda r: (r["predicted_ns"] is not None, r["predicted_ns"] or 0.0, r["path_id"])):
            want.setdefault(r["instance"], []).append(r)
        gone = {r["instance"] for r in rows.where(seen).collect()}
        best = sorted((r for i, v in want.items() if i not in gone for r in v[:2]), key=lambda r: (r["predicted_ns"] is not None, r["predicted_ns"] or 0.0, r["instance"], r["path_id"]))[:10]
        for first in (0, 200, 100_000):
            monkeypatch.setattr(timing, "FIRST_ROWS", first)
            got = timing.unseen_first_quota(rows, rows.where(seen), 2, 10).collect()
            assert [(r["instance"], r["path_id"]) for r in got] == [(r["instance"], r["path_id"]) for r in best]


def test_candidates_behind_the_first_are_not_shuffled(spark):
    rows = spark.range(0, 50_000, 1, 4).selectExpr("cast(id as string) AS instance", "id AS new_ref", "id AS path_id", "id AS point_index", "cast(id as double) AS predicted_ns")
    assert most(spark, "shuffle records written", lambda: timing.unseen_first_quota(rows, rows.where("path_id % 10 = 0"), 2, 10).collect()) < 20_000
