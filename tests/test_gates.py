"""Every gate on its own: what passes, and the one mutation that each gate must tell."""

import hashlib

import pytest

from millrace.operators import gates, replay, timing

KEYED = "case_id string, endpoint string, slack_ns double"


def kind(row):
    of = {str: "string", bool: "boolean", int: "long", float: "double"}
    return ", ".join(f"{k} {of[type(v)]}" for k, v in row.items())


REPLAY = dict(case_id="c", replay=1, status="PASS", tool_version="7", fix_sha256="f", checkpoint_sha256="k", hold_gated=False, hold_recorded=True, placement_legal=True, equivalent=True, moved_by_resize=0, moved_by_legalize=0, topology_before="t", topology_after="t",
    constraints_before="s", constraints_after="s", max_fanout_before=2, max_fanout_after=2, max_transition_before=1, max_transition_after=0, max_capacitance_before=1, max_capacitance_after=1, drc_before=4, drc_after=4, connectivity_before=0, connectivity_after=0)
SPEC = dict(case_id="c", tool_version="7", fix_sha256="f", checkpoint_sha256="k", n_targets=1, n_protected=1, nominal_ns=-0.02, tolerance_ns=0.001)
TARGET = dict(case_id="c", replay=1, endpoint="a", target=True, protected=False, before_ns=-0.0205, resized_ns=0.0, after_ns=0.001, baseline_ns=0.0, cell_ns=7.0, net_ns=3.0, path_ns=-0.0205)
GUARD = dict(TARGET, endpoint="b", target=False, protected=True, before_ns=0.3, after_ns=0.299, baseline_ns=0.3)
OPERATION = dict(case_id="c", instance="i", old_ref="x", new_ref="y")
DIFF = dict(OPERATION, replay=1, equivalent=True)
GAIN = dict(case_id="c", replay=1, instance="i", endpoint="a", gain_ns=0.001)
START = {"replays": [REPLAY], "specs": [SPEC], "endpoints": [TARGET, GUARD], "operations": [OPERATION], "diffs": [DIFF], "sensitivity": [GAIN]}


def failed(spark, **changed):
    tables = START | changed
    frames = [spark.createDataFrame([tuple(r.values()) for r in tables[k]], kind(START[k][0])) for k in START]
    return {r["gate"] for r in gates.validate_replay(*frames).where("not passed").collect()}


MUTATIONS = [
    ("status", "replays", dict(status="FAIL")), ("tool_version", "replays", dict(tool_version="8")), ("fix_sha256", "replays", dict(fix_sha256=None)), ("checkpoint_sha256", "specs", dict(checkpoint_sha256="z")), ("hold_not_gated", "replays", dict(hold_gated=True)),
    ("hold_recorded", "replays", dict(hold_recorded=None)), ("placement", "replays", dict(placement_legal=False)), ("equivalence", "replays", dict(equivalent=False)), ("targets", "specs", dict(n_targets=2)), ("protected", "specs", dict(n_protected=0)),
    ("severity", "specs", dict(nominal_ns=-0.03)), ("domination", "endpoints", dict(net_ns=3.5)), ("domination", "endpoints", dict(path_ns=-0.03)), ("resize_closure", "endpoints", dict(resized_ns=-0.001)), ("closure", "endpoints", dict(after_ns=None)),
    ("no_regression", "replays", dict(drc_after=5)), ("no_regression", "replays", dict(max_fanout_after=1)), ("no_regression", "replays", dict(connectivity_after=None)), ("constraints", "replays", dict(constraints_after="u")), ("routing", "replays", dict(moved_by_legalize=1)),
    ("topology", "replays", dict(topology_after=None)), ("resize_equivalence", "diffs", dict(equivalent=False)), ("cell_diff", "diffs", dict(new_ref="w")), ("sensitivity", "sensitivity", dict(gain_ns=0.0009)),
]


def test_every_replay_gate_by_one_mutation(spark):
    assert failed(spark) == set()
    for gate, at, change in MUTATIONS:
        assert failed(spark, **{at: [START[at][0] | change, *START[at][1:]]}) == {gate}, (gate, change)


def test_replay_sets(spark):
    assert failed(spark, endpoints=[TARGET, TARGET | GUARD | {"protected": True, "after_ns": 0.298}]) == {"protected_slack"}
    assert failed(spark, endpoints=[TARGET | {"protected": True}, GUARD]) == {"protected", "disjoint"} | {"protected_slack"} - {"protected_slack"}
    assert failed(spark, endpoints=[TARGET, GUARD | {"before_ns": -0.001}]) == {"negative_set"}
    assert failed(spark, operations=[OPERATION, OPERATION | {"instance": "j"}]) == {"cell_diff", "sensitivity"}
    assert failed(spark, diffs=[DIFF | {"new_ref": "x"}], operations=[OPERATION | {"new_ref": "x"}]) == {"cell_diff"}
    assert {"targets", "severity", "status"} <= failed(spark, specs=[SPEC | {"case_id": "other"}], replays=[REPLAY | {"status": None}])


def test_repeated_and_null_changes_of_a_replay(spark):
    two = [OPERATION, OPERATION | {"instance": "j", "new_ref": "z"}]
    both = [DIFF, DIFF | {"instance": "j", "new_ref": "z"}]
    gains = [GAIN, GAIN | {"gain_ns": 0.0}, GAIN | {"instance": "j"}]
    assert failed(spark, operations=two, diffs=both, sensitivity=gains) == set()
    assert failed(spark, operations=[*two, OPERATION], diffs=both, sensitivity=gains) == failed(spark, operations=two, diffs=[*both, DIFF], sensitivity=gains) == {"cell_diff"}
    assert failed(spark, operations=[*two, OPERATION | {"instance": None}], diffs=[*both, DIFF | {"instance": None}], sensitivity=[*gains, GAIN | {"instance": None}]) == {"cell_diff", "sensitivity"}
    assert failed(spark, sensitivity=[GAIN, GAIN | {"instance": "other"}]) == failed(spark, sensitivity=[]) == {"sensitivity"}
    assert failed(spark, operations=[], diffs=[], sensitivity=[]) == {"cell_diff", "resize_equivalence", "sensitivity"} and failed(spark, diffs=[]) == {"cell_diff"}
    assert failed(spark, endpoints=[TARGET, GUARD, GUARD | {"endpoint": None}]) == {"protected"} and failed(spark, endpoints=[TARGET, TARGET, GUARD]) == {"targets"}


def test_tables_of_replays_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = [spark.createDataFrame([tuple(r.values()) for r in START[k]], kind(START[k][0])) for k in START]
        plan = gates.validate_replay(*frames)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange ") <= 8 and "Expand" not in plan  # seven tables, and gains before and after they are grouped


def compared(spark, evidence=("f", "f"), process=(1, 2), slot=(1, 2), right=(("m", "k", 1.0),), n=2):
    runs = [("c", i + 1, process[i], slot[i], {"fix": evidence[i], "same": None}) for i in range(n)]
    values = [("c", 1, "m", "k", 1.0), ("c", 1, "m", "nan", float("nan")), ("c", 2, "m", "nan", float("nan")), *(("c", 2, *x) for x in right)]
    df = gates.compare_replays(spark.createDataFrame(runs, "case_id string, replay int, process_id long, slot long, evidence map<string,string>"), spark.createDataFrame(values, "case_id string, replay int, map string, key string, value double"))
    (row,) = df.collect()
    return row["reasons"]


def test_pairs_of_replays(spark):
    assert compared(spark) == [] and compared(spark, right=(("m", "k", 1.001),)) == []
    assert compared(spark, right=(("m", "k", 1.0011),)) == compared(spark, right=(("m", "k", None),)) == ["values:m"]
    assert compared(spark, right=(("m", "q", 1.0),)) == compared(spark, right=(("m", "k", 1.0), ("m", "k", 1.0))) == ["keys:m"]
    assert compared(spark, evidence=("f", "g")) == compared(spark, evidence=("f", None)) == ["evidence:fix"]
    assert compared(spark, process=(3, 3), slot=(4, None)) == ["same_process", "same_slot"]
    assert "missing_replay" in compared(spark, n=1)


@pytest.mark.parametrize("profile", ["official", "fast"])
def test_every_criterion_of_a_score_by_one_mutation(spark, profile):
    good = {}
    for _, m, rule, bound in gates.CRITERIA:
        value = {"replays": 2.0, "eco_actions": 1.0}.get(m, {"close": 1.0, "same": None}.get(rule, 0.0))
        good[m] = (m, value, 1.0, "a", "a")
    criteria = spark.createDataFrame(gates.CRITERIA, "gate string, metric string, rule string, bound double")
    profiles = spark.createDataFrame(gates.PROFILES, "profile string, gate string, decision_label string, official boolean")
    own = {g for p, g, *_ in gates.PROFILES if p == profile}
    rows, want = [("fine", *m) for m in good.values()], {"fine": set()}
    for i, (g, m, rule, bound) in enumerate(gates.CRITERIA):
        bad = {"least": (m, (bound or 0) - 0.5, 1.0, "a", "a"), "equal": (m, 1.0, 1.0, "a", "a"), "close": (m, 1.1, 1.0, "a", "a"), "at_most_reference": (m, 2.0, 1.0, "a", "a"), "same": (m, None, None, "a", "b")}[rule]
        for kind_, change in (("bad", [bad]), ("gone", []), ("null", [(m, None, None, None, None)]), ("twice", [good[m]] * 2), ("nan", [(m, float("nan"), 1.0, "a", "a")] if rule != "same" else [(m, 0.0, 0.0, "a", None)])):
            case = f"{i}{kind_}"
            rows += [(case, *x) for k, v in good.items() for x in (change if k == m else [v])]
            fails = {h for h, n, r, b in gates.CRITERIA if n == m and (kind_ != "bad" or (h, r, b) == (g, rule, bound) or (n == "replays" and not bad[1] >= b) or (n == "eco_actions" and r == rule))}
            want[case] = fails & own
    metrics = spark.createDataFrame(rows, "case_id string, metric string, value double, reference double, text string, text_reference string")
    got = {r["case_id"]: r for r in gates.score_candidates(metrics, criteria, profiles, profile).collect()}
    assert {k: set(r["failed"]) for k, r in got.items()} == want
    assert got["fine"]["decision"] == ("PASS" if profile == "official" else "PASS_FAST") and got["fine"]["official"] == (profile == "official") and all(r["passed"] == (not want[k]) for k, r in got.items())


def test_profiles_that_are_missing_or_empty(spark):
    metrics = spark.createDataFrame([("c", "wns", 0.0)], "case_id string, metric string, value double")
    criteria = spark.createDataFrame([("timing", "wns", "least", 0.0), ("odd", "wns", "sideways", 0.0)], "gate string, metric string, rule string, bound double")
    profiles = spark.createDataFrame([("p", "timing", "OK", True), ("q", "none", "OK", True), ("r", "odd", "OK", True)], "profile string, gate string, decision_label string, official boolean")
    score = lambda p: gates.score_candidates(metrics, criteria, profiles, p).first()
    assert (score("p")["decision"], score("p")["official"], score("p")["reward"]) == ("OK", True, 1.0)
    assert score("q")["reasons"] == ["none:no_criteria"] and score("r")["failed"] == ["odd"]
    assert (score("nobody")["failed"], score("nobody")["decision"], score("nobody")["reward"]) == (["unknown_profile"], "FAIL", 0.0)
    rows = spark.createDataFrame([("a", "g", True), ("a", "h", None), ("b", "g", True), ("b", "g", False), ("d", "x", False)], "case_id string, gate string, passed boolean")
    table = spark.createDataFrame([("p", "g", "OK")], "profile string, gate string, decision_label string")
    assert {r["case_id"]: (r["failed"], r["decision"]) for r in gates.gate_verdict(rows, table, "p").collect()} == {"a": ([], "OK"), "b": (["g"], "FAIL"), "d": (["g"], "FAIL")}
    assert {r["case_id"]: r["failed"] for r in gates.gate_verdict(rows).collect()} == {"a": ["h"], "b": ["g"], "d": ["x"]}
    assert {r["decision"] for r in gates.gate_verdict(rows, table, "no").collect()} == {"FAIL"}


def test_presence_is_not_read_off_nulls(spark):
    left = spark.createDataFrame([("c", "a", None), ("c", "b", 1.0), ("c", "d", 1.0), ("c", None, 1.0), ("c", "n", 1.0)], KEYED)
    right = spark.createDataFrame([("c", "a", None), ("c", "b", None), ("c", "e", None), ("c", None, 1.0), ("c", "n", -0.5)], KEYED)
    got = {r["endpoint"]: r["reason"] for r in replay.slack_compare(left, right, ["case_id", "endpoint"]).collect()}
    assert got == {"b": "over", "d": "only_left", "e": "only_right", "n": "over"}
    dropped = {r["endpoint"]: r["reason"] for r in replay.protected_drop(left, right, ["case_id", "endpoint"]).collect()}
    assert dropped == {"a": "unknown", "b": "unknown", "d": "missing", "e": "extra", "n": "negative"}
    cells = lambda rows: spark.createDataFrame(rows, "instance string, ref string")
    diff = replay.cell_diff(cells([("i", None), ("j", "x"), ("k", None)]), cells([("i", None), ("j", None), ("l", None)]))
    assert {r["instance"]: r["change"] for r in diff.collect()} == {"j": "changed", "k": "removed", "l": "added"}
    files = lambda rows: spark.createDataFrame(rows, "case_id string, path string, bytes long, sha256 string")
    found = replay.inventory_verify(files([("c", "p", None, "h"), ("c", "q", 1, None), ("c", "r", 1, "h")]), files([("c", "p", 1, "h"), ("c", "q", 1, None), ("c", "s", None, None)]))
    assert {r["path"]: r["reason"] for r in found.collect()} == {"p": "bytes", "r": "missing", "s": "extra"}


def test_digest_of_trees_of_any_size(spark):
    sha = lambda lines: hashlib.sha256("\n".join(lines).encode()).hexdigest()
    rows = [("one", "p0", 1, "h0"), *(("few", f"p{i}", i, "h") for i in range(4)), *(("many", f"p{i:03d}", i, "h") for i in range(70)), ("odd", None, None, None), ("odd", "p", 1, "h"), ("odd", "p", 1, "h")]
    got = {r["t"]: (r["digest"], r["n"]) for r in replay.tree_digest(spark.createDataFrame(rows, "t string, path string, bytes long, sha256 string").repartition(5), ["t"], 4).collect()}
    level = [f"p{i:03d}\t{i}\th" for i in range(70)]
    while len(level) > 1:
        level = [sha(level[i : i + 4]) for i in range(0, len(level), 4)]
    assert got == {"one": (sha(["p0\t1\th0"]), 1), "few": (sha([f"p{i}\t{i}\th" for i in range(4)]), 4), "many": (level[0], 70), "odd": (sha(["", "p\t1\th", "p\t1\th"]), 3)}
    assert replay.tree_digest(spark.createDataFrame([], "t string, path string, bytes long, sha256 string"), ["t"]).count() == 0


def test_negative_rows_and_counts(spark):
    df = spark.createDataFrame([("r", "a", -1.0), ("r", "a", 2.0), ("r", "b", None), ("s", "a", 1.0), ("r", None, -1.0)], "run_id string, endpoint string, slack_ns double")
    assert sorted((r["endpoint"] or "") for r in timing.negative_set(df, ["run_id"]).collect()) == ["", "a"]
    assert {r["run_id"]: (r["n_negative"], r["n_endpoints"]) for r in timing.negative_counts(df, ["run_id"]).collect()} == {"r": (2, 3), "s": (0, 1)}


def test_scores_are_met_before_the_shuffle(spark):
    metrics = spark.range(0, 400, 1, 4).selectExpr("id % 100 as case_id", "'m' || cast(floor(id / 100) as int) as metric", "cast(if(id = 7, -1, 1) as double) as value").repartition(4, "case_id")
    twice = metrics.unionByName(spark.createDataFrame([(9, "m3", 1.0), (9, "m3", 1.0), (200, "else", None)], "case_id long, metric string, value double"))
    criteria = spark.createDataFrame([(f"g{k % 70}", f"m{k % 4}", "least", k / 1e3) for k in range(140)], "gate string, metric string, rule string, bound double")
    profiles = spark.createDataFrame([("p", f"g{k}", "OK", True) for k in range(70)], "profile string, gate string, decision_label string, official boolean")
    got = {r["case_id"]: r for r in gates.score_candidates(twice, criteria, profiles, "p").collect()}
    own = lambda m: sorted({f"g{k % 70}:m{k % 4}" for k in range(140) if k % 4 in m})
    assert {k: r["reasons"] for k, r in got.items() if not r["passed"]} == {7: own({0}), 9: own({3}), 200: own(range(4))} and len(got) == 101
    plan = gates.score_candidates(metrics, criteria, profiles, "p")._jdf.queryExecution().toString()
    assert plan[plan.index("== Physical Plan =="):].count("Exchange hashpartitioning") == 1  # metrics that lie by case are not shuffled again, nor gathered as lists
    assert "collect_list" not in plan


def test_scores_take_one_grouping_of_a_row_for_each_case(spark):
    criteria = spark.createDataFrame([("g", "m0", "least", 0.0), ("g", "m0", "most", 5.0), ("h", "m1", "equal", 1.0)], "gate string, metric string, rule string, bound double")
    profiles = spark.createDataFrame([("p", g, "OK", True) for g in "ghi"], "profile string, gate string, decision_label string, official boolean")
    metrics = spark.createDataFrame([(1, "m0", 1.0), (1, "m1", 1.0), (2, "m0", 9.0), (2, "m1", 1.0), (2, "m1", 1.0), (2, "m1", 1.0), (3, "other", None)], "case_id long, metric string, value double")
    df = gates.score_candidates(metrics, criteria, profiles, "p")
    assert {r["case_id"]: (r["failed"], r["reasons"]) for r in df.collect()} == {1: (["i"], ["i:no_criteria"]), 2: (["g", "h", "i"], ["g:m0", "h:m1", "i:no_criteria"]), 3: (["g", "h", "i"], ["g:m0", "h:m1", "i:no_criteria"])}
    plan = df._jdf.queryExecution().toString()
    assert plan[plan.index("== Optimized Logical Plan ==") : plan.index("== Physical Plan ==")].count("Aggregate ") == 1  # a table of cases times criteria grew beyond memory
