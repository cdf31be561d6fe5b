"""Registries over several loads and the plans that keep them unshuffled; sketches against exact figures."""

import random
import uuid

import pytest
from millrace.sources import ledger

KEY = ["endpoint", "new_ref"]


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(df) -> int:
    return df._jdf.queryExecution().sparkPlan().toString().count("Exchange") + df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")


def test_two_loads_and_no_shuffle_of_the_registry(spark, no_broadcast):
    table = f"r_{uuid.uuid4().hex}"
    rows = lambda r: spark.createDataFrame(r, "endpoint string, new_ref long")
    ledger.append_measured(rows([("a", 1), ("b", 2), ("b", 2), (None, 3)]), table, KEY, 4)
    ledger.append_measured(rows([("c", 1), ("a", 1)]), table, KEY, 4)
    asked = rows([("a", 1), ("a", 2), ("c", 1), (None, 3), ("d", None), ("a", 2)])
    got = ledger.unmeasured_in(asked, table, KEY)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", 2), ("a", 2), (None, 3), ("d", None)]))
    assert exchanges(got) == 1  # that of the candidates


def test_versions_of_a_registry(spark, no_broadcast):
    names = [f"v_{uuid.uuid4().hex}" for _ in range(3)]
    kind = "endpoint string, new_ref long, value double, seen long"
    spark.createDataFrame([("a", 1, 0.1, 5), ("b", 1, 0.2, 5), (None, 1, 0.3, 5), ("n", 1, 0.4, None)], kind).write.bucketBy(4, *KEY).saveAsTable(names[0])
    ledger.upsert_registry(spark, names[0], spark.createDataFrame([("a", 1, 9.0, 5), ("a", 1, 8.0, 4), ("b", 1, 7.0, 1), ("c", 1, 6.0, 2), ("n", 1, 5.0, None), (None, 2, 4.0, 1)], kind), KEY, "seen", names[1], 4)
    ledger.upsert_registry(spark, names[1], spark.createDataFrame([("c", 1, None, 3), ("a", 1, 1.0, None)], kind), KEY, "seen", names[2], 4)
    got = {(r["endpoint"], r["new_ref"]): (r["value"], r["seen"]) for r in spark.table(names[2]).collect()}
    assert got == {("a", 1): (9.0, 5), ("b", 1): (0.2, 5), (None, 1): (0.3, 5), ("n", 1): (5.0, None), ("c", 1): (None, 3), (None, 2): (4.0, 1)}


def test_sketches_of_shards_and_loads(spark):
    rng = random.Random(4)
    rows = [(rng.choice("xy"), rng.randrange(6), f"i{rng.randrange(3000)}", rng.gauss(0, 1)) for _ in range(20_000)] + [("x", 1, None, None), ("z", 0, "only", None)]
    df = spark.createDataFrame(rows, "g string, shard int, instance string, measured_slack_ns double")
    loads = [ledger.measurement_sketches(df.where(w), ["g"], ["shard"], ["instance"]) for w in ("shard < 3", "shard >= 3")]
    got = {r["g"]: r for r in ledger.merge_sketches(loads[0].unionByName(loads[1]), ["g"]).collect()}
    lone = got.pop("z")
    assert (lone["n_rows"], lone["n_operations"], lone["median_ns"]) == (1, 1, None)
    for g, r in got.items():
        own = [x for x in rows if x[0] == g]
        slacks = sorted(x[3] for x in own if x[3] is not None)
        assert r["n_rows"] == len(own) and abs(r["n_operations"] / len({x[2] for x in own}) - 1) < 0.02
        for q, c in ((0.1, "p10_ns"), (0.5, "median_ns"), (0.9, "p90_ns")):
            assert abs(sum(s <= r[c] for s in slacks) / len(slacks) - q) < 0.015


def test_points_of_a_registry_are_made_once(spark):
    from millrace.plans import QUERIES

    plan = QUERIES["unmeasured_registry"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "point_index" in plan and "l_shipdate" not in plan
