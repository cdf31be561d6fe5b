"""Each rule of specs, repairs, markers and scripts by one mutation."""

from millrace.operators import policies

SPEC = dict(case_id="c", difficulty="M", n_modifications=3, severity_ps=240.0, percent=3.0, tolerance_ps=36.0, profile="I0", inverse_allowed=True)
KIND = "case_id string, difficulty string, n_modifications long, severity_ps double, percent double, tolerance_ps double, profile string, inverse_allowed boolean"


def test_specs_by_one_mutation(spark):
    changes = {
        "difficulty": dict(difficulty="Z"), "modifications": dict(n_modifications=5), "severity": dict(severity_ps=160.0, percent=2.0, tolerance_ps=24.0), "percent": dict(percent=3.1), "tolerance": dict(tolerance_ps=36.1), "inverse": dict(profile="IA"), "null": dict(inverse_allowed=None),
    }
    rows = [SPEC, *(SPEC | c | {"case_id": k} for k, c in changes.items()), SPEC | {"case_id": "twice"}, SPEC | {"case_id": "twice"}, SPEC | {"case_id": "easy", "difficulty": "E", "n_modifications": 1, "severity_ps": 40.0, "percent": 0.5, "tolerance_ps": 10.0}]
    got = [(r["case_id"], r["reasons"]) for r in policies.spec_checks(spark.createDataFrame([tuple(r.values()) for r in rows], KIND)).collect()]
    want = {k: [k] for k in changes} | {"c": [], "easy": [], "null": ["inverse"], "twice": ["repeated"], "difficulty": ["difficulty", "modifications", "severity"]}
    assert dict(got) == want and len(got) == len(rows)


def test_distribution_and_margins(spark):
    specs = spark.createDataFrame([("a", "A", "E")] * 3 + [("a", "B", None), ("b", "A", "E")], "shape string, strategy string, difficulty string")
    kind = "shape string, strategy string, difficulty string, n long"
    exact = [("a", "A", "E", 3), ("a", "B", "?", 1), ("b", "A", "E", 1)]
    check = lambda rows: sorted(map(tuple, policies.distribution_check(specs, spark.createDataFrame(rows, kind)).collect()), key=str)
    assert check(exact) == [] and check([("a", None, None, 4), (None, "A", None, 4), (None, None, None, 5)]) == []
    assert check([*exact[:2], ("z", "A", "E", 2), ("a", None, None, 5)]) == sorted([("b", "A", "E", 1, 0), ("z", "A", "E", 0, 2), ("a", None, None, 4, 5)], key=str)


def test_inverse_policies(spark):
    cases = {
        "good": ("I0", 1, [("i", "x", "y")], [("i", "y", "x")], []), "count": ("I0", 2, [("i", "x", "y")], [("i", "y", "x")], ["count"]), "refs": ("I0", 1, [("i", "x", "y")], [("i", "y", "z")], ["refs"]), "where": ("I0", 1, [("i", "x", "y")], [("j", "y", "x")], ["instances"]),
        "other": ("IA", 9, [("i", "x", "y"), ("k", "p", "q")], [("j", "a", "b"), ("k", "c", "d")], []), "same": ("IA", 9, [("i", "x", "y")], [("i", "a", "b")], ["instances"]), "turned": ("IA", 9, [("i", "x", "y")], [("j", "y", "x")], ["ref_inverse"]),
        "none": ("IA", 9, [("i", "x", "y")], [], ["no_repair", "instances"]), "twice": ("I0", 1, [("i", "x", "y")] * 2, [("i", "y", "x")], ["repeated"]), "absent": ("I0", 1, [], [], ["no_injection", "no_repair", "count"]),
    }
    side = lambda k: spark.createDataFrame([(c, *x) for c, v in cases.items() for x in v[k]], "case_id string, instance string, old_ref string, new_ref string")
    specs = spark.createDataFrame([(c, v[0], v[1]) for c, v in cases.items()], "case_id string, profile string, n_modifications long")
    assert {r["case_id"]: r["reasons"] for r in policies.inverse_policy(side(2), side(3), specs).collect()} == {c: v[4] for c, v in cases.items()}


def test_markers_by_one_mutation(spark):
    good = dict(status="PASS", mode="setup", delay_type="max", top="t", wns_ns="0.1", tns_ns="0", violating_paths="0", threshold_ns="0.05", parasitics_read="1", propagated_clocks="1", clock_count="2", tool_version="v7")
    say = lambda d: "P " + " ".join(f"{k}={v}" for k, v in d.items())
    bad = dict(status="FAIL", wns_ns="-0.5", tns_ns="-0.7", violating_paths="2")
    forms = {
        "": say(good), "fail": say(good | bad), "hold": say(good | dict(mode="hold", delay_type="min")), "status": say(good | dict(status="MAYBE")), "missing": say({k: v for k, v in good.items() if k != "top"}), "mode": say(good | dict(mode="both")), "delay_type": say(good | dict(mode="hold")),
        "number": say(good | dict(clock_count="1.5")), "threshold": say(good | dict(threshold_ns="-1")), "parasitics": say(good | dict(parasitics_read="0")), "clocks": say(good | dict(clock_count="0")), "paths_and_tns": say(good | bad | dict(violating_paths="0", wns_ns="0")), "verdict": say(good | dict(status="FAIL")),
        "version": say(good | dict(tool_version="v6")), "malformed": say(good) + " alone", "repeated": say(good) + " top=t", "error": "P status=ERROR mode=unknown delay_type=? reason=none", "error_missing": "P status=ERROR mode=setup delay_type=max", "number_nan": say(good | dict(wns_ns="nan")),
        "paths_and_wns": say(good | bad | dict(wns_ns="0")), "tns_sign": say(good | dict(tns_ns="0.2")), "noise": "Px status=PASS", "bare": "P",
    }
    got = {r["id"]: r["reasons"] for r in policies.check_markers(spark.createDataFrame([(k, "noise\n" + v + "\n") for k, v in forms.items()] + [("null", None)], "id string, text string"), "P", "v7").collect()}
    assert "noise" not in got and "null" not in got
    clean = {"", "fail", "hold", "error"}
    assert {k for k, v in got.items() if not v} == clean
    want = {"error_missing": ["missing"], "number_nan": ["number"], "status": ["status"], "threshold": ["threshold"], "tns_sign": ["tns_sign", "verdict"]}
    for k, v in got.items():
        if k not in clean | {"bare"}:
            assert set(want.get(k, [k])) <= set(v) and len(v) <= 2, (k, v)
    assert {"status", "missing", "mode"} <= set(got["bare"])


def test_scripts_by_one_mutation(spark):
    good = ["# fix", "setEcoMode -batchMode true", "ecoChangeCell -inst {u/a[3]} -cell X2", "  ecoChangeCell  -inst u/b -cell X4 ", "", "setEcoMode -batchMode false", "refinePlace -eco true", "ecoRoute -target"]
    edit = lambda i, *new: [*good[:i], *new, *good[i + 1 :]]
    forms = {
        "good": good, "substitution": edit(4, "ecoRoute -target; exit"), "unknown_command": edit(0, "exit"), "form": edit(3, "ecoChangeCell -inst u/b"), "hidden_cell": edit(3, "ecoChangeCell -inst u/z -cell X4"), "outside_batch": edit(0, "ecoChangeCell -inst u/b -cell X1"),
        "inside_batch": [*good[:4], "refinePlace -eco true", "setEcoMode -batchMode false", "ecoRoute -target"], "no_action": [*good[:2], *good[5:]], "batch": [*good[:5], *good[6:]], "placement": good[:7], "order": [*good[:6], good[7], good[6]], "budget": edit(3, *[good[3]] * 4), "empty": [],
    }
    scripts = spark.createDataFrame([(k, "\n".join(v) if v else None) for k, v in forms.items()], "script_id string, text string")
    cells = spark.createDataFrame([(k, i) for k in forms for i in ("u/a[3]", "u/b", "u/b")], "script_id string, instance string")
    got = {r["script_id"]: r["reasons"] for r in policies.fix_script_policy(scripts, cells, spark.createDataFrame([(k, 4) for k in forms], "script_id string, budget int")).collect()}
    more = {"good": [], "substitution": ["substitution", "form"], "batch": ["inside_batch", "batch"], "empty": ["no_action", "batch", "placement"]}
    assert {k: v for k, v in got.items()} == {k: more.get(k, [k]) for k in forms}


def test_scripts_are_shuffled_without_their_texts(spark):
    scripts = spark.createDataFrame([("a", "setEcoMode -batchMode true\necoChangeCell -inst x -cell y;")], "script_id string, text string")
    found = policies.fix_script_policy(scripts, spark.createDataFrame([("a", "x")], "script_id string, instance string"), spark.createDataFrame([("a", 4)], "script_id string, budget int"))
    assert found.first()["reasons"][:2] == ["substitution", "form"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan and "RLIKE" not in plan[: plan.index("Window")]
