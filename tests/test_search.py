"""Searches and scoring against brute force, report forms as literals, and the edges of their inputs."""

import time
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import search, tensor

REPORT = """#  Design:            blinker
Path 1: VIOLATED Setup Check with Pin blk/r7/CK
Endpoint:   blk/r7/D    (v) checked with leading edge of 'osc'
Beginpoint: blk/r2/Q (v) triggered by leading edge of 'osc'
Analysis View: slow_125c
= Slack Time                   -0.231
     Timing Path:
     | Pin | Edge | Net | Cell | Delay | Arrival | Required |
     | blk/cts0/Y | v | osc_l | BUF_X8M | 0.055 | 0.055 | 0.3 |
     | blk/r2/Q | v | q2 | DFFQ_X2M | 0.120 | 0.175 | 0.4 |
     | blk/m3/B | v | q2 | AOI21_X1M | 0.002 | 0.177 | 0.4 |
     | blk/m3/Y | ^ | t3 | AOI21_X1M | 0.613 | 0.790 | 1.0 |
     | blk/g9/Y | ^ | t4 | CKGX2 | 0.140 | 0.930 | 1.1 |
     | blk/m5/Y | v | t5 | NOR2_X3M | 0.377 | 1.307 | 1.5 |
     | blk/r7/D -> | v | t5 | DFFQ_X2M | 0.000 | 1.307 | 1.5 |
     Other End Path:
"""
NEAR = 1e-9


def reports(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string")


def test_paths_and_points_of_a_real_report(spark):
    df = reports(spark, REPORT, None, "")
    (row,) = text.parse_timing_paths(df, "Setup", "slow_125c").collect()
    assert (row["endpoint"], row["beginpoint"], row["view"], row["slack_ns"], row["reasons"]) == ("blk/r7/D", "blk/r2/Q", "slow_125c", -0.231, [])
    assert text.parse_timing_paths(df, "Hold", "other").first()["reasons"] == ["wrong_check", "wrong_view"]
    points = [(r["instance"], r["pin"], r["delay_ns"]) for r in text.parse_path_points(df).orderBy(F.desc("delay_ns")).collect()]
    assert points == [("blk/m3", "blk/m3/Y", 0.613), ("blk/m5", "blk/m5/Y", 0.377)]
    assert text.parse_path_points(df, max_cells=1).count() == 1


def test_counts_prove_zero_only_where_said(spark):
    drv = reports(spark, "Check type : max_transition\nNo violations\nCheck type : max_fanout\n | u/a/Y | 1.0 | 2.0 | -1.0 | INV |\nCheck type : max_capacitance\n?", None)
    assert {r["check"]: r["n"] for r in text.parse_drv_counts(drv).collect()} == {"max_transition": 0, "max_fanout": 1, "max_capacitance": None}
    drc = reports(spark, "No DRC violations were found\n", "SHORT: ( Metal ) a\nSHORT: ( Metal ) b\nCUT: ( Via ) c\n Total Violations : 3 Viols.\n", "SHORT: ( x )\n Total Violations : 2 Viols.", "", None)
    got = {(r["id"], r["category"]): (r["complete"], r["n"]) for r in text.parse_drc_categories(drc).collect()}
    assert got == {(0, None): (True, 0), (1, "SHORT"): (True, 2), (1, "CUT"): (True, 1), (2, "SHORT"): (False, 1), (3, None): (False, 0), (4, None): (False, 0)}


def test_fix_scripts(spark):
    good = "# fix\nsetEcoMode -batchMode true\n ecoChangeCell -inst {u/a} -cell {INV_X2}\nsetEcoMode -batchMode false\nrefinePlace -eco true\n"
    rows = [("good", good), ("late", good + "setEcoMode -batchMode true\n"), ("bad", good.replace("{u/a}", "{u a}")), ("none", None)]
    scripts = spark.createDataFrame(rows, "script_id string, text string")
    expected = spark.createDataFrame([(k, 1) for k, _ in rows], "script_id string, n long")
    got = {r["script_id"]: r["reasons"] for r in text.fix_script_reasons(scripts, expected).collect()}
    assert got["good"] == [] and got["late"] == ["open_batch", "last_line"] and got["bad"] == ["refused_line", "resize_count"] and "legalize" in got["none"]


def test_padding_alone_gives_outputs(spark):
    cells = spark.createDataFrame([(0, 0, 0, 0, 5)], "tensor_id long, c long, y long, x long, v long")
    weights = spark.createDataFrame([(0, 0, 0, 0, 3)], "k long, c long, r long, q long, w long")
    got = {(r["y"], r["x"]): r["v"] for r in tensor.conv2d(cells, weights, 1, 1, (1, 1), pad=1, pad_value=2).collect()}
    assert len(got) == 9 and got[1, 1] == 15 and all(v == 6 for k, v in got.items() if k != (1, 1))


def test_level_vectors_are_the_best_of_all(spark):
    rng = np.random.default_rng(3)
    ops = [("k", o, e, [float(x) for x in np.sort(rng.random(3))]) for o in range(3) for e in ("a", "b") if (o, e) != (2, "b")]
    slacks, target = {"a": 0.4, "b": 0.3}, -0.1
    scored = []
    for levels in product(range(3), repeat=3):
        best = min(
            100 * sum(s >= 0 for s in v) + 10 * sum(s for s in v if s >= 0) + abs(min(v) - target) + 0.001 * k
            for k, scale in enumerate((3, 2, 4, 1))
            for v in [[slacks[e] - sum(values[levels[o]] / scale for _, o, x, values in ops if x == e) for e in slacks]]
        )
        scored.append((round(best, 9), levels))
    frames = spark.createDataFrame(ops, "case_id string, op long, endpoint string, estimates array<double>"), spark.createDataFrame([("k", e, s) for e, s in slacks.items()], "case_id string, endpoint string, slack_ns double")
    targets = spark.createDataFrame([("k", target)], "case_id string, target_wns_ns double")
    got = [(round(r["score"], 9), tuple(r["levels"])) for r in search.level_vectors(*frames, targets, 7).orderBy("rank").collect()]
    assert got == sorted(scored)[:7]
    some = list(search._best_first([3, 3, 3], lambda v: np.array([{k: s for s, k in scored}[tuple(x)] for x in v.tolist()]), 27))
    assert len(some) == 27 and len({v for _, v in some}) == 27
    assert search.level_vectors(frames[0].where("false"), frames[1], targets).count() == 0


def test_knobs_are_private_first_and_used_once(spark):
    ops = [("k", "p", "a", "p", 1, 1, [0.1, 0.2, 0.3], True), ("k", "s", "a", "s", 9, 1, [0.1, 0.9, 1.0], True), ("k", "s", "b", "s", 9, 1, [0.0, 0.5, 0.6], True), ("k", "q", "b", "q", 2, 0, [0.4, 0.5, 0.6], True)]
    ops = spark.createDataFrame(ops, "case_id string, op string, endpoint string, instance string, point_index long, level int, estimates array<double>, reachable boolean")
    slacks = spark.createDataFrame([("k", "a", -0.3, True), ("k", "b", -0.2, True), ("k", "c", 0.1, False), ("n", "a", None, True)], "case_id string, endpoint string, slack_ns double, target boolean")
    specs = spark.createDataFrame([("k", -0.1, 0.01), ("n", -0.1, 0.01)], "case_id string, target_wns_ns double, tol_ns double")
    targets = search.refinement_targets(slacks, specs)
    assert sorted((r["endpoint"], r["direction"]) for r in targets.collect()) == [("a", -1), ("b", -1)]
    # q has no stronger level; s touches both, so it stands behind p for a
    assert sorted((r["endpoint"], r["op"]) for r in search.refinement_knobs(ops, targets).collect()) == [("a", "p"), ("b", "s")]


def brute_binding(viable, specs, ends):
    out = {}
    for run in {v[0] for v in viable}:
        own = {}
        for _, e, rank, inst, est, base in (v for v in viable if v[0] == run):
            r, b, cells = own.get(e, (rank, base, []))
            own[e] = (min(r, rank), min(b, base), [*cells, (est, inst)])
        used = set()
        for _, case, _, target, n in sorted((s for s in specs if s[0] == run), key=lambda s: (s[2], s[1])):
            for e in sorted(own, key=lambda e: (own[e][0], e)):
                needed = own[e][1] - target
                fit = [c for c in own[e][2] if needed > 0 and c[0] >= 0.55 * needed]
                if e in used or not fit:
                    continue
                guard = [x for x in sorted({x for r, x in ends if r == run}) if x not in used and x != e][:n]
                if len(guard) == n:
                    out[run, case] = (e, min(fit, key=lambda c: (abs(c[0] - needed), -c[0], c[1]))[1], guard)
                    used |= {e, *guard}
                break
    return out


def test_bindings_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    viable, specs, ends = [], [], []
    for run in ("r", "s"):
        for e in range(30):
            base, rank = int(rng.integers(-4, 8)) / 128, int(rng.integers(0, 9))
            viable += [(run, f"e{e:02d}", rank, f"c{e}{j}", int(rng.integers(0, 16)) / 128, base) for j in range(int(rng.integers(1, 4)))]
            ends.append((run, f"e{e:02d}"))
        specs += [(run, c, int(rng.integers(0, 6)), -int(rng.integers(0, 12)) / 128, int(rng.integers(0, 3))) for c in range(20)]
    ends += [("r", "a0"), ("r", "a0"), ("t", "x")]
    frames = spark.createDataFrame(viable + viable[:3] + [("r", "e00", 0, "null", None, 0.5)], "run_id string, endpoint string, rank long, instance string, estimate_ns double, baseline_ns double"), spark.createDataFrame(specs + [("u", 1, 1, 0.0, 0)], "run_id string, case_id long, seq long, target_ns double, n_protected int"), spark.createDataFrame(ends, "run_id string, endpoint string")
    got = {(r["run_id"], r["case_id"]): (r["endpoint"], r["instance"], r["protected"]) for r in search.greedy_binding(*frames).collect()}
    assert got == brute_binding(viable, specs, ends) and 10 < len(got) < 40


def test_knobs_are_picked_without_a_python_call_per_case(spark):
    ops = spark.createDataFrame([("c", o, e, o, 1, 1, [0.0, d, 2 * d], True) for o, e, d in [("p", "a", 1.0), ("q", "a", 2.0), ("q", "b", 2.0), ("r", "b", 1.0), ("r", "c", 3.0), ("s", "d", 1.0)]], "case_id string, op string, endpoint string, instance string, point_index int, level int, estimates array<double>, reachable boolean")
    targets = spark.createDataFrame([("c", e, -1, k) for k, e in enumerate("abcd")], "case_id string, endpoint string, direction int, turn int")
    found = search.refinement_knobs(ops, targets, 2)
    assert sorted((r["endpoint"], r["op"]) for r in found.collect()) == [("a", "p"), ("b", "q")]
    assert "FlatMapGroups" not in found._jdf.queryExecution().toString()


def test_binding_passes_used_endpoints_once():
    n = 40_000
    cases = pd.DataFrame({"case_id": range(n), "seq": range(n), "target_ns": -1.0, "n_protected": 0})
    ends = pd.DataFrame({"endpoint": range(2 * n), "rank": range(2 * n), "baseline_ns": 0.0, "most_ns": 1.0, "pool": False})
    began = time.process_time()
    got = search._bind(("r",), cases, ends)
    assert got["endpoint"].tolist() == list(range(n)) and time.process_time() - began < 4
