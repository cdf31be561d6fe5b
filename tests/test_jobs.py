"""Timing, replay, text, tensor, file and streaming jobs on literals; registered queries against DuckDB."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace import plans
from millrace.functions import text
from millrace.operators import replay, tensor, timing

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if v is None or v is math.nan or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(float(v)) if isinstance(v, float) else str(v)


CHECKED = "mine_candidates timing_summary stable_rank ladder_candidates slack_compare category_regression interval_overlap gate_verdict inverse_policy parse_timing_paths parse_drc_categories command_policy conv2d pooling_avg lut_interpolate upsert_artifacts".split()


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, name):
    got = plans.QUERIES[name](spark, SF)
    want = duck.execute(plans.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    order = sorted(names)
    assert sorted(got.columns) == order
    a = sorted(tuple(plain(r[c]) for c in order) for r in got.collect())
    b = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in want.fetchall())
    assert a == b


def test_tolerance_and_missing_keys(spark):
    left = spark.createDataFrame([("c", "a", 0.0), ("c", "b", 0.0), ("c", "d", 1.0)], "case_id string, endpoint string, slack_ns double")
    right = spark.createDataFrame([("c", "a", 0.001), ("c", "b", 0.0011), ("c", "e", 1.0)], "case_id string, endpoint string, slack_ns double")
    got = {r["endpoint"]: r["reason"] for r in replay.slack_compare(left, right, ["case_id", "endpoint"]).collect()}
    assert got == {"b": "over", "d": "only_left", "e": "only_right"}
    assert replay.slack_compare(left, left, ["case_id", "endpoint"]).count() == 0


def test_tns_counts_endpoints_not_paths(spark):
    p = spark.createDataFrame([("e1", "b1", -0.5), ("e1", "b2", -0.25), ("e2", "b1", 0.1)], "endpoint string, beginpoint string, slack_ns double")
    r = timing.timing_summary(p, []).first()
    assert (r["wns_ns"], r["tns_ns"], r["violating_endpoints"], r["paths"], r["worst_beginpoint"]) == (-0.5, -0.5, 1, 3, "b1")


def test_reports(spark):
    report = "v\nPath 1: VIOLATED\nEndpoint: e\nBeginpoint: b\nView: f\n= Slack Time  -0.060\nPath 2: MET\nEndpoint: e\nBeginpoint: b\n  Slack Time  0.2\nPath 3: MET\nEndpoint: e\nBeginpoint: b\nView: f\n  Slack Time  -0.2\n"
    got = text.parse_timing_paths(spark.createDataFrame([("r", report)], "report string, text string")).orderBy("path_no").collect()
    assert [(r["slack_ns"], r["reasons"]) for r in got] == [(-0.06, []), (0.2, ["missing_field"]), (-0.2, ["status_sign"])]
    c = spark.createDataFrame([(1, "Found no problems or warnings."), (2, "16 Problem(s) (IMPVFC-92)\n15 Problem(s) (IMPVFC-96)\n16 Problem(s) (IMPVFC-94)\n47 total info(s) created"), (3, ""), (4, "16 Problem(s) (IMPVFC-92)\n17 total info(s) created"), (5, None)], "k int, text string")
    assert {r["k"]: r["n"] for r in text.parse_connectivity(c).collect()} == {1: 0, 2: 47, 3: None, 4: None, 5: None}


def test_rounding_is_half_away_from_zero(spark):
    v = spark.createDataFrame([(x,) for x in (-6, -5, -2, -1, 0, 1, 2, 5, 6)], "v long")
    assert [r[0] for r in v.select(tensor.round_shift(F.col("v"), 2)).collect()] == [-2, -1, -1, 0, 0, 0, 1, 1, 2]
    assert [r[0] for r in v.select(tensor.saturate(F.col("v") * 50, 8)).collect()] == [-128, -128, -100, -50, 0, 50, 100, 127, 127]
