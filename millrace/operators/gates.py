"""Gates: what a replay, a pair of replays and a scored candidate must fulfil, each failure a row or a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.lineage import dealt
from millrace.registry import query

#: Comparison of doubles; one ps in ns; shares of cell and net delay on a target's path.
EPSILON, TOLERANCE_NS = 1e-12, 0.001
MIN_CELL, MAX_NET = 0.7, 0.3
#: Replays that a task takes, with all that belongs to their cases.
CASE_ROWS = 40_000
#: Rules that a criterion may have.
RULES = ("least", "most", "equal", "close", "no_worse", "at_most_reference", "same")


def _sure(test: Column) -> Column:
    """A test that null does not pass."""
    return F.coalesce(test, F.lit(False))


def _packed(tests: dict[str, Column]) -> Column:
    """Tests as bits of a long, from bit 0 on."""
    bits = F.lit(0).cast("long")
    for i, test in enumerate(tests.values()):
        bits = bits.bitwiseOR(F.when(_sure(test), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return bits


def _same(a: str, b: str) -> Column:
    return _sure(F.col(a) == F.col(b))


#: Hashes and versions that a replay must share with its case, states of its run that must hold, and counts that may not grow.
SHARED = ("tool_version", "fix_sha256", "checkpoint_sha256")
NO_MORE = ("max_transition", "max_capacitance", "drc", "connectivity")


def validate_replay(replays: DataFrame, specs: DataFrame, endpoints: DataFrame, operations: DataFrame, diffs: DataFrame, sensitivity: DataFrame, max_drop: float = TOLERANCE_NS, min_gain: float = TOLERANCE_NS) -> DataFrame:
    """Every gate of every replay: case_id, replay, gate, passed. What is missing or null fails.

    ``replays``: case_id, replay, status, SHARED, hold_gated, hold_recorded, placement_legal, equivalent, moved_by_resize, moved_by_legalize (routing mutations), topology_before and _after, constraints_before and
    _after, max_fanout_before and _after, and NO_MORE with _before and _after. ``specs``: case_id, SHARED, n_targets, n_protected, nominal_ns (negative), tolerance_ns. ``endpoints``: case_id, replay, endpoint,
    target, protected, before_ns, resized_ns, after_ns, baseline_ns (of protected ones), cell_ns, net_ns, path_ns (of targets' paths). ``operations``: case_id, instance, old_ref, new_ref.
    ``diffs``: case_id, replay, instance, old_ref, new_ref, equivalent. ``sensitivity``: case_id, replay, instance, endpoint, gain_ns.

    A replay without a spec, or without endpoints, fails all that needs them. Repeated endpoints, instances or specs of a case fail by their count. A case with all its replays and endpoints, some thousands, is
    one task's; tasks take CASE_ROWS replays each, so ``replays`` should be cheap to count.
    """
    at = ["case_id", "replay"]
    e = endpoints.withColumns({"t": _sure(F.col("target")), "p": _sure(F.col("protected"))})
    total = F.col("cell_ns") + F.col("net_ns")
    dominated = (total > 0) & (F.col("cell_ns") / total + EPSILON >= MIN_CELL) & (F.col("net_ns") / total - EPSILON <= MAX_NET) & (F.abs(F.col("path_ns") - F.col("before_ns")) <= TOLERANCE_NS + EPSILON)
    kept = (F.col("after_ns") >= 0) & (F.col("baseline_ns") - F.col("after_ns") <= max_drop + EPSILON)
    n = replays.count()
    by_case = lambda df: dealt(df, "case_id", rows=CASE_ROWS, n=n)
    # everything meets in its case: each table is shuffled once, with the bits that its gates ask and no more, and is grouped and joined where it lies
    bits = {"negative": (F.col("before_ns") < 0) == F.col("t"), "dominated": ~F.col("t") | dominated, "resized": F.col("resized_ns") >= 0, "closed": F.col("after_ns") >= 0, "kept": ~F.col("p") | kept}
    e = by_case(e.select(*at, "endpoint", "before_ns", _packed({"t": F.col("t"), "p": F.col("p"), **bits}).alias("bits")))
    bit = {k: F.getbit("bits", F.lit(i)) == 1 for i, k in enumerate(("t", "p", *bits))}
    # repeated endpoints are told by a row for each endpoint, so that distinct ones need no copies of the rows
    one = e.groupBy(*at, "endpoint").agg(
        F.count_if(bit["t"]).alias("n_t"), F.count_if(bit["p"]).alias("n_p"), F.count_if(bit["t"] & bit["p"]).alias("n_both"), F.min("before_ns").alias("wns"), *[F.bool_and(bit[k]).alias(k) for k in bits]
    )
    named = F.col("endpoint").isNotNull()
    ends = one.groupBy(*at).agg(
        *[F.sum(c).alias(c) for c in ("n_t", "n_p", "n_both")], *[F.count_if((F.col(f"n_{c}") > 0) & named).alias(f"d_{c}") for c in "tp"], F.min("wns").alias("wns"), *[F.bool_and(k).alias(k) for k in bits]
    )
    no_more = F.lit(True)
    for c in NO_MORE:
        no_more = no_more & (F.col(f"{c}_after") <= F.col(f"{c}_before"))
    states = {
        "status": F.col("status") == "PASS", "hold_not_gated": ~F.col("hold_gated"), "hold_recorded": F.col("hold_recorded"), "placement": F.col("placement_legal"), "equivalence": F.col("equivalent"),
        "no_regression": no_more & (F.col("max_fanout_after") == F.col("max_fanout_before")), "constraints": _same("constraints_before", "constraints_after"), "routing": (F.col("moved_by_resize") == 0) & (F.col("moved_by_legalize") == 0), "topology": _same("topology_before", "topology_after"),
    }
    r = by_case(replays.select(*at, *SHARED, _packed(states).alias("states")))
    every = by_case(replays.select(*at)).join(by_case(operations.select("case_id", "instance", F.col("old_ref").alias("o"), F.col("new_ref").alias("n"))), "case_id").withColumn("asked", F.lit(1))
    done = by_case(diffs.select(*at, "instance", "old_ref", "new_ref", _sure(F.col("equivalent")).alias("equivalent"), F.lit(1).alias("found")))
    gains = by_case(sensitivity.groupBy(*at, "instance").agg(F.max("gain_ns").alias("gain"))).withColumn("measured", F.lit(1))
    values = ("o", "n", "old_ref", "new_ref")
    of = every.unionByName(done, allowMissingColumns=True).unionByName(gains, allowMissingColumns=True).groupBy(*at, "instance").agg(
        *[F.count(c).alias(c) for c in ("asked", "found", "measured")], *[F.count(c).alias(f"n_{c}") for c in values], *[f(c).alias(f"{k}_{c}") for c in values for k, f in (("min", F.min), ("max", F.max))],
        F.bool_and("equivalent").alias("equivalent"), F.max("gain").alias("gain"),
    )
    named, asked, found, measured = F.col("instance").isNotNull(), F.col("asked") > 0, F.col("found") > 0, F.col("measured") > 0
    # every pair of an asked and a found change is the same one: nothing is null, and each side has one value, which is the other's
    fit = named & asked & found
    for a, b in (("o", "old_ref"), ("n", "new_ref")):
        fit = fit & (F.col(f"n_{a}") == F.col("asked")) & (F.col(f"n_{b}") == F.col("found")) & (F.col(f"min_{a}") == F.col(f"max_{a}")) & (F.col(f"min_{b}") == F.col(f"max_{b}")) & (F.col(f"min_{a}") == F.col(f"min_{b}"))
    fit = fit & (F.col("min_old_ref") != F.col("min_new_ref"))
    both = of.groupBy(*at).agg(
        F.bool_and(F.when(asked | found, _sure(fit))).alias("diff"), F.when(F.bool_or(asked | found), F.coalesce(F.bool_and("equivalent"), F.lit(True))).alias("alike"),
        F.sum(F.when(named & asked, F.col("asked") * F.col("found")).otherwise(F.col("found"))).alias("n_diff"), F.count_if(named & (asked | found)).alias("d_diff"),
        F.bool_and(F.when(asked | measured, _sure(named & asked & measured & (F.col("gain") >= min_gain - EPSILON)))).alias("sensitive"),
    )
    spec = by_case(specs.select("case_id", *[F.col(c).alias(f"spec_{c}") for c in SHARED], "n_targets", "n_protected", "nominal_ns", "tolerance_ns"))
    # a replay takes the one row of its endpoints and of its changes by a window, as a join by case and replay would shuffle all three again; null keys match nothing
    told, own = [c for c in (*ends.columns, *both.columns) if c not in at], Window.partitionBy(*at)
    r = r.join(spec, "case_id", "left").withColumn("_row", F.lit(1))
    for part in (ends, both):
        r = r.unionByName(part.where("case_id is not null and replay is not null"), allowMissingColumns=True)
    r = r.withColumns({c: F.max(c).over(own) for c in told}).where("_row = 1")
    gates = {
        **{g: F.getbit("states", F.lit(i)) == 1 for i, g in enumerate(states)}, **{c: _same(c, f"spec_{c}") for c in SHARED},
        "targets": (F.col("n_t") == F.col("n_targets")) & (F.col("d_t") == F.col("n_t")), "protected": (F.col("n_p") == F.col("n_protected")) & (F.col("d_p") == F.col("n_p")), "disjoint": F.col("n_both") == 0,
        "negative_set": F.col("negative"), "severity": F.abs(F.col("wns") - F.col("nominal_ns")) <= F.col("tolerance_ns") + EPSILON, "domination": F.col("dominated"), "resize_closure": F.col("resized"), "closure": F.col("closed"),
        "protected_slack": F.col("kept"), "cell_diff": F.col("diff") & (F.col("n_diff") == F.col("d_diff")), "resize_equivalence": F.col("alike"), "sensitivity": F.col("sensitive"),
    }
    rows = F.array(*[F.struct(F.lit(g).alias("gate"), _sure(test).alias("passed")) for g, test in gates.items()])
    return r.select(*at, F.explode(rows).alias("g")).select(*at, "g.gate", "g.passed")


def compare_replays(runs: DataFrame, values: DataFrame, tol: float = TOLERANCE_NS) -> DataFrame:
    """Do the two replays of each case agree? case_id, n_values, reasons (sorted), same.

    ``runs``: case_id, replay (1 or 2), process_id, slot, evidence (map of text that must be equal: targets, hashes, cell diffs); ``values``: case_id, replay, map, key, value (numbers that must be equal within ``tol``:
    scalars, slacks of targets and of protected endpoints, path delays). Reasons: missing_replay, repeated_replay, same_process, same_slot, evidence:NAME, keys:MAP (a key that one replay lacks or repeats), values:MAP (beyond
    ``tol``, or null or no number in one only). Nulls of both sides are equal; a null process or slot counts as the same.
    """
    side = lambda n: runs.where(F.col("replay") == n).groupBy("case_id").agg(F.count("*").alias(f"n{n}"), *[F.first(c).alias(f"{c}{n}") for c in ("process_id", "slot", "evidence")])
    both = side(1).join(side(2), "case_id", "full_outer")
    names = F.array_distinct(F.concat(*[F.coalesce(F.map_keys(f"evidence{n}"), F.array().cast("array<string>")) for n in (1, 2)]))
    odd = F.filter(names, lambda k: ~F.get(F.array(F.try_element_at("evidence1", k)), F.lit(0)).eqNullSafe(F.try_element_at("evidence2", k)))
    fresh = lambda c: ~_sure(F.col(f"{c}1") != F.col(f"{c}2"))
    first = F.array_compact(F.concat(F.array(
        F.when(F.col("n1").isNull() | F.col("n2").isNull(), "missing_replay"), F.when((F.col("n1") > 1) | (F.col("n2") > 1), "repeated_replay"), F.when(fresh("process_id"), "same_process"), F.when(fresh("slot"), "same_slot"),
    ), F.transform(odd, lambda k: F.concat(F.lit("evidence:"), k))))
    n = lambda k: F.count_if(F.col("replay") == k)
    one = values.where(F.col("replay").isin(1, 2)).groupBy("case_id", "map", "key").agg(
        n(1).alias("n1"), n(2).alias("n2"), *[F.max(F.when(F.col("replay") == k, F.col("value"))).alias(f"v{k}") for k in (1, 2)]
    )
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    off = F.when(number("v1") & number("v2"), F.abs(F.col("v1") - F.col("v2")) > tol + EPSILON).otherwise(~F.col("v1").eqNullSafe(F.col("v2")))
    maps = one.groupBy("case_id", "map").agg(F.count("*").alias("n"), F.bool_or((F.col("n1") != 1) | (F.col("n2") != 1)).alias("keys"), F.bool_or((F.col("n1") == 1) & (F.col("n2") == 1) & off).alias("off"))
    told = F.array_compact(F.array(F.when(F.col("keys"), F.concat(F.lit("keys:"), "map")), F.when(F.col("off"), F.concat(F.lit("values:"), "map"))))
    maps = maps.groupBy("case_id").agg(F.sum("n").alias("n"), F.flatten(F.collect_list(told)).alias("more"))  # a row for each map
    out = both.join(maps, "case_id", "full_outer")
    none = F.array().cast("array<string>")
    lone = F.when(F.col("n1").isNull() & F.col("n2").isNull(), F.array(F.lit("missing_replay"))).otherwise(F.coalesce(first, none))
    reasons = F.array_sort(F.concat(lone, F.coalesce("more", none)))
    return out.select("case_id", F.coalesce("n", F.lit(0)).alias("n_values"), reasons.alias("reasons")).withColumn("same", F.size("reasons") == 0)


#: What each gate of a scored candidate asks: gate, metric, rule, bound. A metric has a value and a reference, or texts of both.
CRITERIA = (
    [("start_state", m, "close", TOLERANCE_NS) for m in ("start_wns", "start_tns", "start_hold_wns", "start_hold_tns")] + [("start_state", m, "same", None) for m in ("start_drc", "start_drv", "checkpoint", "constraints")]
    + [("candidate_policy", "refused_commands", "equal", 0.0), ("candidate_policy", "hidden_objects", "equal", 0.0), ("candidate_policy", "eco_actions", "at_most_reference", 0.0), ("candidate_policy", "eco_actions", "least", 1.0)]
    + [("timing", m, "least", 0.0) for m in ("setup_wns", "setup_tns", "hold_wns", "hold_tns")] + [("timing", "violating_endpoints", "equal", 0.0)]
    + [("physical_no_regression", m, "at_most_reference", 0.0) for m in ("max_transition", "max_capacitance", "max_fanout", "drc_total", "worst_drc_category")] + [("physical_no_regression", "connectivity", "equal", 0.0)]
    + [("constraints_unchanged", m, "same", None) for m in ("setup_constraints", "hold_constraints")] + [("functional_integrity", "failed_audits", "equal", 0.0), ("functional_integrity", "audited_operations", "close", 0.0)]
    + [("typed_physical_audit", m, "close", 0.0) for m in ("audited_drc", "audited_drv", "audited_connectivity")] + [("check_design", m, "equal", 0.0) for m in ("multidriven_nets", "unplaced", "overlaps", "floating_inputs", "undriven_nets")]
    + [("replay_determinism", "replays", "least", 2.0), ("replay_determinism", "differing_values", "equal", 0.0), ("replay_determinism", "replay_fix", "same", None), ("replay_available", "replays", "least", 1.0)]
    + [("crosscheck", m, "least", 0.0) for m in ("independent_setup_wns", "independent_hold_wns")] + [("crosscheck", "independent_errors", "equal", 0.0), ("artifact_integrity", "bad_artifacts", "equal", 0.0)]
)
COMMON = ("start_state", "candidate_policy", "timing", "physical_no_regression", "constraints_unchanged", "functional_integrity", "typed_physical_audit", "check_design", "artifact_integrity")
#: profile, gate, decision_label, official
PROFILES = [("official", g, "PASS", True) for g in (*COMMON, "replay_determinism", "crosscheck")] + [("fast", g, "PASS_FAST", False) for g in (*COMMON, "replay_available")]


def score_candidates(metrics: DataFrame, criteria: DataFrame, profiles: DataFrame, profile: str) -> DataFrame:
    """All gates of a profile per case: case_id, passed, failed (gates), reasons (gate:metric), n_gates, decision, official, reward.

    ``metrics``: case_id, metric, value, reference and, where the rule is ``same``, text and text_reference. ``criteria``: gate, metric, rule, bound, where rule is ``least`` (value >= bound), ``most`` (value <= bound), ``equal``,
    ``close`` (value within bound of the reference), ``no_worse`` or ``at_most_reference`` (value <= reference + bound) or ``same`` (equal texts). ``profiles``: profile, gate, decision_label, official.
    A criterion whose metric is missing, told twice, null or no number fails, as does one of an unknown rule, and a gate without criteria. A profile that isn't there fails every case
    with ``unknown_profile``. Cases are those with any metric. The criteria, a few, are broadcast, and each has a sum in the row of a case.
    """
    spark = metrics.sparkSession
    own = profiles.where(F.col("profile") == profile).select("gate", "decision_label", "official").distinct().orderBy("gate").collect()
    need = sorted({(r["gate"], r["metric"], r["rule"], r["bound"]) for r in criteria.join(F.broadcast(profiles.where(F.col("profile") == profile).select("gate").distinct()), "gate").collect()}, key=str)
    gates = sorted({r["gate"] for r in own})
    for c in ("reference", "text", "text_reference"):
        if c not in metrics.columns:
            metrics = metrics.withColumn(c, F.lit(None))
    m = metrics.select("case_id", "metric", F.col("value").cast("double"), F.col("reference").cast("double"), F.col("text").cast("string"), F.col("text_reference").cast("string"))
    asked = spark.createDataFrame([(metric, RULES.index(rule) if rule in RULES else -1, bound, k) for k, (_, metric, rule, bound) in enumerate(need)], "metric string, rule int, bound double, k int")
    x, ref, b, rule = F.col("value"), F.col("reference"), F.col("bound"), lambda *names: F.col("rule").isin(*[RULES.index(n) for n in names])
    number = F.when(rule("least"), x >= b - EPSILON).when(rule("most"), x <= b + EPSILON).when(rule("equal"), F.abs(x - b) <= EPSILON).when(rule("close"), F.abs(x - ref) <= b + EPSILON)
    number = number.when(rule("no_worse", "at_most_reference"), x <= ref + b + EPSILON) & ~F.isnan(x) & ~F.coalesce(F.isnan(ref), F.lit(False))
    fine = _sure(F.when(rule("same"), F.col("text") == F.col("text_reference")).otherwise(number))
    # a fine row counts 1 and another 2, so that a criterion is met where its rows sum to 1; one grouping by case, which has no more groups than cases and shuffles no metrics that lie by case
    one = m.join(F.broadcast(asked), "metric", "left").select("case_id", "k", F.when(fine, 1).otherwise(2).cast("long").alias("v"))
    per = one.groupBy("case_id").agg(F.count("*").alias("n"), *[F.sum(F.when(F.col("k") == k, F.col("v"))).alias(f"c{k}") for k in range(len(need))])
    failing: dict[str, dict[str, Column]] = {"gate": {}, "reason": {}}
    for k, (g, metric, *_) in enumerate(need):
        for kind, name in (("gate", g), ("reason", f"{g}:{metric}")):
            failing[kind][name] = failing[kind].get(name, F.lit(False)) | ~_sure(F.col(f"c{k}") == 1)
    for g in gates if gates else ["unknown_profile"]:
        if g not in failing["gate"]:
            failing["gate"][g] = failing["reason"][f"{g}:no_criteria" if gates else g] = F.lit(True)
    told = lambda kind: F.array_compact(F.array(*[F.when(failing[kind][n], F.lit(n)) for n in sorted(failing[kind])]))
    out = per.select("case_id", told("gate").alias("failed"), told("reason").alias("reasons")).withColumn("passed", F.size("failed") == 0)
    labels, official = {r["decision_label"] for r in own}, bool(own) and all(r["official"] for r in own)
    return out.select(
        "case_id", "passed", "failed", "reasons", F.lit(len(gates)).cast("long").alias("n_gates"),
        F.when(F.col("passed"), min(labels, default="FAIL")).otherwise("FAIL").alias("decision"), (F.col("passed") & F.lit(official)).alias("official"), F.when(F.col("passed"), 1.0).otherwise(0.0).alias("reward"),
    )


def gate_verdict(gates: DataFrame, profiles: DataFrame | None = None, profile: str | None = None) -> DataFrame:
    """All gates of a case: passed, the failed ones by name, n_gates, reward 1 or 0; with ``profiles`` (profile, gate, decision_label) also its decision.

    ``gates``: case_id, gate, passed. A null gate has failed, a gate that repeats passes if all its rows do. With a ``profile`` only its gates count, and one that the case lacks
    has failed; a profile that isn't there fails every case.
    """
    fine = _sure(F.col("passed"))
    if profiles is None:
        out = gates.groupBy("case_id").agg(F.bool_and(fine).alias("passed"), F.array_sort(F.collect_set(F.when(~fine, F.col("gate")))).alias("failed"), F.count("*").alias("n_gates"))
        return out.withColumn("reward", F.when(F.col("passed"), 1.0).otherwise(0.0))
    own = profiles.where(F.col("profile") == profile).select("gate", "decision_label").collect()
    asked = F.array(*[F.lit(g) for g in sorted({r["gate"] for r in own})]).cast("array<string>")
    known = F.col("gate").isin(*[r["gate"] for r in own]) if own else F.lit(False)
    per = gates.groupBy("case_id").agg(F.collect_set(F.when(known & fine, F.col("gate"))).alias("good"), F.collect_set(F.when(known & ~fine, F.col("gate"))).alias("bad"))
    failed = F.array_sort(F.array_union(F.col("bad"), F.array_except(asked, "good"))) if own else F.array(F.lit("unknown_profile"))
    out = per.select("case_id", failed.alias("failed")).withColumn("passed", F.size("failed") == 0)
    label = min((r["decision_label"] for r in own), default="FAIL")
    return out.select("case_id", "passed", "failed", F.lit(len({r["gate"] for r in own})).cast("long").alias("n_gates"), F.when(F.col("passed"), 1.0).otherwise(0.0).alias("reward"), F.when(F.col("passed"), label).otherwise("FAIL").alias("decision"))


# --- registered queries ---

REPLAY_SQL = """WITH e AS (SELECT case_id, replay, count(CASE WHEN target THEN 1 END) AS n_t, count(DISTINCT CASE WHEN target THEN endpoint END) AS d_t, count(CASE WHEN protected THEN 1 END) AS n_p, count(DISTINCT CASE WHEN protected THEN endpoint END) AS d_p, count(CASE WHEN target AND protected THEN 1 END) AS n_both, min(before_ns) AS wns, bool_and((before_ns < 0) = target) AS negative,
      bool_and(NOT target OR (cell_ns / (cell_ns + net_ns) >= 0.7 - 1e-12 AND net_ns / (cell_ns + net_ns) <= 0.3 + 1e-12 AND abs(path_ns - before_ns) <= 0.001 + 1e-12)) AS dominated, bool_and(coalesce(resized_ns >= 0, false)) AS resized, bool_and(coalesce(after_ns >= 0, false)) AS closed,
      bool_and(coalesce(NOT protected OR (after_ns >= 0 AND baseline_ns - after_ns <= 0.001 + 1e-12), false)) AS kept FROM {gate_endpoints} GROUP BY case_id, replay),
    a AS (SELECT r.case_id, replay, instance, old_ref AS o, new_ref AS n FROM {gate_replays} r JOIN {gate_operations} q ON q.case_id = r.case_id),
    d AS (SELECT coalesce(a.case_id, f.case_id) AS case_id, coalesce(a.replay, f.replay) AS replay, bool_and(coalesce(o = old_ref AND n = new_ref AND old_ref <> new_ref, false)) AS diff, bool_and(f.instance IS NULL OR equivalent) AS alike, count(f.instance) = count(DISTINCT coalesce(a.instance, f.instance)) AS once
      FROM a FULL JOIN {gate_diffs} f ON a.case_id = f.case_id AND a.replay = f.replay AND a.instance = f.instance GROUP BY 1, 2),
    g AS (SELECT case_id, replay, instance, max(gain_ns) AS gain FROM {gate_sensitivity} GROUP BY ALL),
    s AS (SELECT coalesce(a.case_id, g.case_id) AS case_id, coalesce(a.replay, g.replay) AS replay, bool_and(coalesce(a.instance IS NOT NULL AND gain >= 0.001 - 1e-12, false)) AS sensitive FROM a FULL JOIN g ON a.case_id = g.case_id AND a.replay = g.replay AND a.instance = g.instance GROUP BY 1, 2),
    x AS (SELECT r.*, p.tool_version AS pv, p.fix_sha256 AS pf, p.checkpoint_sha256 AS pc, n_targets, n_protected, nominal_ns, tolerance_ns, e.* EXCLUDE (case_id, replay), diff, once, alike, sensitive
      FROM {gate_replays} r LEFT JOIN {gate_specs} p ON p.case_id = r.case_id LEFT JOIN e ON e.case_id = r.case_id AND e.replay = r.replay LEFT JOIN d ON d.case_id = r.case_id AND d.replay = r.replay LEFT JOIN s ON s.case_id = r.case_id AND s.replay = r.replay)
    """ + " UNION ALL ".join(
    f"SELECT case_id, replay, '{g}' AS gate, coalesce({t}, false) AS passed FROM x"
    for g, t in {
        "status": "status = 'PASS'", "tool_version": "tool_version = pv", "fix_sha256": "fix_sha256 = pf", "checkpoint_sha256": "checkpoint_sha256 = pc", "hold_not_gated": "NOT hold_gated", "hold_recorded": "hold_recorded", "placement": "placement_legal",
        "equivalence": "equivalent", "targets": "n_t = n_targets AND d_t = n_t", "protected": "n_p = n_protected AND d_p = n_p", "disjoint": "n_both = 0", "negative_set": "negative", "severity": "abs(wns - nominal_ns) <= tolerance_ns + 1e-12", "domination": "dominated",
        "resize_closure": "resized", "closure": "closed", "no_regression": "max_transition_after <= max_transition_before AND max_capacitance_after <= max_capacitance_before AND drc_after <= drc_before AND connectivity_after <= connectivity_before AND max_fanout_after = max_fanout_before",
        "constraints": "constraints_before = constraints_after", "routing": "moved_by_resize = 0 AND moved_by_legalize = 0", "topology": "topology_before = topology_after", "protected_slack": "kept", "cell_diff": "diff AND once", "resize_equivalence": "alike", "sensitivity": "sensitive",
    }.items()
)
query("validate_replay", REPLAY_SQL)(lambda t: validate_replay(t.gate_replays, t.gate_specs, t.gate_endpoints, t.gate_operations, t.gate_diffs, t.gate_sensitivity))

query("compare_replays", """WITH v AS (SELECT coalesce(l.case_id, r.case_id) AS case_id, count(*) AS n, bool_or(l.case_id IS NULL OR r.case_id IS NULL) AS keys, coalesce(bool_or(abs(l.slack_ns - r.slack_ns) > 0.001 + 1e-12), false) AS off
      FROM {replay_1} l FULL JOIN {replay_2} r ON l.case_id = r.case_id AND l.endpoint = r.endpoint GROUP BY 1)
    SELECT v.case_id, n AS n_values, concat_ws(',', CASE WHEN v.case_id % 41 = 0 THEN 'evidence:fix' END, CASE WHEN keys THEN 'keys:slack' END, CASE WHEN v.case_id % 101 = 0 THEN 'missing_replay' END, CASE WHEN v.case_id % 43 = 0 OR v.case_id % 101 = 0 THEN 'same_process' END, CASE WHEN v.case_id % 47 = 0 OR v.case_id % 101 = 0 THEN 'same_slot' END, CASE WHEN off THEN 'values:slack' END) AS reasons,
      NOT keys AND NOT off AND v.case_id % 41 <> 0 AND v.case_id % 43 <> 0 AND v.case_id % 47 <> 0 AND v.case_id % 101 <> 0 AS same FROM v""")(lambda t: _compared(t))  # fmt: skip


def _compared(t) -> DataFrame:
    sides = [(n, df.where("case_id % 101 <> 0") if n == 2 else df) for n, df in ((1, t.replay_1), (2, t.replay_2))]
    odd = lambda k, n: F.when((F.col("case_id") % k != 0) & F.lit(n == 2), 2).otherwise(1)
    fix = lambda n: F.when((F.col("case_id") % 41 == 0) & F.lit(n == 2), "other").otherwise("fix")
    runs = [df.select("case_id").distinct().select("case_id", F.lit(n).alias("replay"), odd(43, n).alias("process_id"), odd(47, n).alias("slot"), F.create_map(F.lit("fix"), fix(n), F.lit("targets"), F.col("case_id").cast("string")).alias("evidence")) for n, df in sides]
    values = [df.select("case_id", F.lit(n).alias("replay"), F.lit("slack").alias("map"), F.col("endpoint").alias("key"), F.col("slack_ns").alias("value")) for n, df in sides]
    # with case_id % 41 = 0 and no second replay the first's evidence differs from none, so both names are told
    made = compare_replays(runs[0].unionByName(runs[1]), values[0].unionByName(values[1]))
    told = F.filter("reasons", lambda x: ~((F.col("case_id") % 101 == 0) & x.startswith("evidence:") & ((F.col("case_id") % 41 != 0) | (x == "evidence:targets"))))
    return made.withColumn("reasons", F.array_join(told, ","))


def _metrics(t) -> DataFrame:
    """Every metric of CRITERIA for each order; each fails where the order's key is divisible by the prime of its place."""
    names = sorted({(m, r) for _, m, r, _ in CRITERIA if (m, r) != ("eco_actions", "least") and (m, r) != ("replays", "least")})
    names = names + [("replays", "two")]
    values = {"least": (-1.0, 0.5), "equal": (1.0, 0.0), "close": (3.0, 1.0), "at_most_reference": (3.0, 1.0), "two": (1.0, 2.0)}  # of a bad one, of a good one
    told = t.spark.createDataFrame([(m, 31 + 2 * i, *values.get(r, (None, None))) for i, (m, r) in enumerate(names)], "metric string, place int, off double, fine double")
    bad = F.col("o_orderkey") % F.col("place") == 0
    # few bytes but many metrics an order: parts by case, which adaptive execution doesn't join into one task
    keys = dealt(t.orders.select("o_orderkey"), "o_orderkey", rows=100_000)
    rows = keys.crossJoin(F.broadcast(told))
    return rows.select(F.col("o_orderkey").alias("case_id"), "metric", F.when(bad, F.col("off")).otherwise(F.col("fine")).alias("value"), F.lit(1.0).alias("reference"), F.when(bad, "b").otherwise("a").alias("text"), F.lit("a").alias("text_reference"))


def _score_sql(profile: str) -> str:
    names = sorted({(m, r) for _, m, r, _ in CRITERIA if (m, r) != ("eco_actions", "least") and (m, r) != ("replays", "least")}) + [("replays", "two")]
    place = {m: 31 + 2 * i for i, (m, _) in enumerate(names)}
    gates = sorted({g for p, g, *_ in PROFILES if p == profile})
    fails = {g: " OR ".join(f"o_orderkey % {place[m]} = 0" for m in sorted({m for h, m, _, b in CRITERIA if h == g and not (m == "replays" and b == 1.0) and not (m == "eco_actions" and b == 1.0)})) or "false" for g in gates}
    failed = "concat_ws(',', " + ", ".join(f"CASE WHEN {fails[g]} THEN '{g}' END" for g in gates) + ")"
    label, official = ("PASS", "true") if profile == "official" else ("PASS_FAST", "false")
    return f"WITH f AS (SELECT o_orderkey AS case_id, {failed} AS failed FROM orders) SELECT case_id, failed = '' AS passed, failed, {len(gates)}::BIGINT AS n_gates, CASE WHEN failed = '' THEN '{label}' ELSE 'FAIL' END AS decision, failed = '' AND {official} AS official, CASE WHEN failed = '' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM f"


for _name, _profile in (("score_candidates", "official"), ("score_candidates_fast", "fast")):
    query(_name, _score_sql(_profile))(
        lambda t, p=_profile: score_candidates(_metrics(t), t.spark.createDataFrame(CRITERIA, "gate string, metric string, rule string, bound double"), t.spark.createDataFrame(PROFILES, "profile string, gate string, decision_label string, official boolean"), p)
        .drop("reasons").withColumn("failed", F.array_join("failed", ","))
    )
VERDICT = "WITH g AS (SELECT l_orderkey AS case_id, l_returnflag || l_linestatus AS gate, l_discount < 0.09 AS p FROM lineitem)"
query("gate_verdict", f"{VERDICT} SELECT case_id, bool_and(p) AS passed, coalesce(string_agg(DISTINCT CASE WHEN NOT p THEN gate END, ',' ORDER BY CASE WHEN NOT p THEN gate END), '') AS failed, count(*) AS n_gates, CASE WHEN bool_and(p) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM g GROUP BY case_id")(
    lambda t: gate_verdict(_flags(t)).withColumn("failed", F.array_join("failed", ","))
)
query("gate_verdict_by_profile", f"{VERDICT}, c AS (SELECT case_id, coalesce(bool_and(p) FILTER (gate = 'NO'), false) AS n, coalesce(bool_and(p) FILTER (gate = 'AF'), false) AS a FROM g GROUP BY case_id) SELECT case_id, n AND a AS passed, concat_ws(',', CASE WHEN NOT a THEN 'AF' END, CASE WHEN NOT n THEN 'NO' END) AS failed, 2::BIGINT AS n_gates, CASE WHEN n AND a THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward, CASE WHEN n AND a THEN 'OK' ELSE 'FAIL' END AS decision FROM c")(
    lambda t: gate_verdict(_flags(t), t.spark.createDataFrame([("p", "NO", "OK"), ("p", "AF", "OK"), ("q", "RF", "OK")], "profile string, gate string, decision_label string"), "p").withColumn("failed", F.array_join("failed", ","))
)


def _flags(t) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("case_id"), F.concat("l_returnflag", "l_linestatus").alias("gate"), (F.col("l_discount") < 0.09).alias("passed"))
