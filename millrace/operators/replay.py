"""Replays of a case compared under tolerances, gates with reasons, and set checks over cases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.lineage import running, written
from millrace.registry import query

#: One picosecond in ns, and the slack of comparisons of doubles.
TOLERANCE_NS, EPSILON = 0.001, 1e-12


def functional_pair_lookup(diffs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Is (old_ref, new_ref), or its reverse, a known equivalent pair? Unknown pairs are not."""
    known = pairs.select("source_ref", "variant_ref").unionByName(pairs.select(F.col("variant_ref").alias("source_ref"), F.col("source_ref").alias("variant_ref"))).distinct()
    known = known.select(F.col("source_ref").alias("old_ref"), F.col("variant_ref").alias("new_ref"), F.lit(True).alias("_known"))
    return diffs.join(known, ["old_ref", "new_ref"], "left").withColumn("equivalent", F.coalesce("_known", F.lit(False))).drop("_known")


def pairs_in_classes(diffs: DataFrame, members: DataFrame, by: list[str]) -> DataFrame:
    """Of the pairs (old_ref, new_ref) of ``diffs`` those that share a class ``by`` and differ in drive: source_ref, variant_ref.

    ``members``: ref, drive and the columns of ``by``; null matches nothing. Only pairs that are asked for are made, so the work grows with diffs and members and not with the square of a class.
    """
    asked = diffs.select(F.col("old_ref").alias("source_ref"), F.col("new_ref").alias("variant_ref")).distinct()
    one = members.select(F.col("ref").alias("source_ref"), F.col("drive").alias("_drive"), *by)
    two = members.select(F.col("ref").alias("variant_ref"), F.col("drive").alias("_other"), *by)
    return asked.join(one, "source_ref").join(two, ["variant_ref", *by]).where("_drive <> _other").select("source_ref", "variant_ref").distinct()


def _sides(left: DataFrame, right: DataFrame, on: list[str], columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Full outer join of two keyed tables with ``_l`` and ``_r``, which say where a key is, whatever its values; null keys are keys."""
    one = left.select(*on, *[F.col(c).alias(a) for c, (a, _) in columns.items()], F.lit(True).alias("_l")).alias("l")
    two = right.select(*on, *[F.col(c).alias(b) for c, (_, b) in columns.items()], F.lit(True).alias("_r")).alias("r")
    same = reduce(Column.__and__, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in on])
    both = one.join(two, same, "full_outer")
    return both.select(*[F.coalesce(f"l.{c}", f"r.{c}").alias(c) for c in on], *[x for p in columns.values() for x in p], F.coalesce("_l", F.lit(False)).alias("_l"), F.coalesce("_r", F.lit(False)).alias("_r"))


def cell_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Instances whose ref changed (also from or to null), or that were added or removed: instance, old_ref, new_ref, change."""
    both = _sides(before, after, ["instance"], {"ref": ("old_ref", "new_ref")})
    change = F.when(~F.col("_l"), "added").when(~F.col("_r"), "removed").when(~F.col("old_ref").eqNullSafe(F.col("new_ref")), "changed")
    return both.withColumn("change", change).where("change is not null").drop("_l", "_r")


def slack_compare(left: DataFrame, right: DataFrame, on: list[str], tol: float = TOLERANCE_NS) -> DataFrame:
    """Keys that only one map has (only_left, only_right), or whose slacks differ by more than ``tol`` (over); two nulls are equal, a null or NaN and a number are not."""
    both = _sides(left, right, on, {"slack_ns": ("l", "r")})
    number = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    over = F.when(number("l") & number("r"), F.abs(F.col("l") - F.col("r")) > tol + EPSILON).otherwise(~F.col("l").eqNullSafe(F.col("r")))
    return both.withColumn("reason", F.when(~F.col("_r"), "only_left").when(~F.col("_l"), "only_right").when(over, "over")).where("reason is not null").drop("_l", "_r")


def protected_drop(baseline: DataFrame, after: DataFrame, on: list[str], max_drop: float = TOLERANCE_NS) -> DataFrame:
    """Protected endpoints that fell below zero (negative), lost more than ``max_drop`` (dropped), are on one side only (missing, extra) or have a null or NaN slack (unknown)."""
    both = _sides(baseline, after, on, {"slack_ns": ("before_ns", "after_ns")})
    unknown = F.col("before_ns").isNull() | F.col("after_ns").isNull() | F.isnan("before_ns") | F.isnan("after_ns")
    why = F.when(~F.col("_r"), "missing").when(~F.col("_l"), "extra").when(unknown, "unknown").when(F.col("after_ns") < 0, "negative").when(F.col("before_ns") - F.col("after_ns") > max_drop + EPSILON, "dropped")
    return both.withColumn("reason", why).where("reason is not null").drop("_l", "_r")


def category_regression(before: DataFrame, after: DataFrame, mode: str = "each") -> DataFrame:
    """Categories that got worse: more of any (``each``), a new one (``new_only``), or a larger ``total``; missing counts as 0."""
    both = before.select("case_id", "category", F.col("n").alias("b")).join(after.select("case_id", "category", F.col("n").alias("a")), ["case_id", "category"], "full_outer")
    both = both.select("case_id", "category", F.coalesce("b", F.lit(0)).alias("n_before"), F.coalesce("a", F.lit(0)).alias("n_after"))
    if mode == "total":
        total = both.groupBy("case_id").agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"))
        return total.where("n_after > n_before").select("case_id", F.lit("total").alias("category"), "n_before", "n_after")
    return both.where("n_after > n_before" if mode == "each" else "n_before = 0 and n_after > 0")


def corner_crosscheck(markers: DataFrame) -> DataFrame:
    """Do the setup and hold corners of a case agree on top, threshold and version, and both pass?"""
    side = lambda c: markers.where(F.col("corner") == c).select("case_id", *(F.col(x).alias(f"{c}_{x}") for x in ("top", "threshold", "version", "passed")))
    both = side("setup").join(side("hold"), "case_id", "full_outer")
    same = lambda x: F.coalesce(F.col(f"setup_{x}") == F.col(f"hold_{x}"), F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(F.col("setup_top").isNull() | F.col("hold_top").isNull(), "missing_corner"), *[F.when(~same(x), f"{x}_differs") for x in ("top", "threshold", "version")],
        F.when(~(F.coalesce("setup_passed", F.lit(False)) & F.coalesce("hold_passed", F.lit(False))), "not_passed"),
    ))
    return both.select("case_id", reasons.alias("reasons"))


def inventory_verify(declared: DataFrame, found: DataFrame) -> DataFrame:
    """Declared against found files: missing, extra, bytes or hash differ; a null size or hash differs from any other."""
    both = _sides(declared, found, ["case_id", "path"], {"bytes": ("db", "fb"), "sha256": ("ds", "fs")})
    why = F.when(~F.col("_r"), "missing").when(~F.col("_l"), "extra").when(~F.col("db").eqNullSafe(F.col("fb")), "bytes").when(~F.col("ds").eqNullSafe(F.col("fs")), "hash")
    return both.select("case_id", "path", why.alias("reason")).where("reason is not null")


def dataset_sync_diff(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Record ids that are missing, extra or changed, by the hash of the whole record."""
    digest = lambda df, n: df.select(key, F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256).alias(n))
    why = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "extra").when(F.col("a") != F.col("e"), "changed")
    return digest(expected, "e").join(digest(actual, "a"), key, "full_outer").select(key, why.alias("reason")).where("reason is not null")


def object_visibility(operations: DataFrame, visible: DataFrame) -> DataFrame:
    """Scripted instances that the case never showed."""
    return operations.join(visible.select("case_id", "instance").distinct(), ["case_id", "instance"], "left_anti").select("case_id", "instance").distinct()


# --- aggregates and gates ---


def distribution_cube(specs: DataFrame) -> DataFrame:
    """Counts by shape, strategy and difficulty with every margin."""
    return specs.cube("shape", "strategy", "difficulty").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def state_counts(states: DataFrame, order: list[str]) -> DataFrame:
    """Cases per state in the machine's order, states without cases included."""
    dim = states.sparkSession.createDataFrame([(i, s) for i, s in enumerate(order)], "place long, state string")
    return dim.join(states.groupBy("state").agg(F.count("*").alias("n")), "state", "left").select("place", "state", F.coalesce("n", F.lit(0)).alias("n"))


def target_coverage(chosen: DataFrame, targets: DataFrame) -> DataFrame:
    """Endpoints that a case's cells cover against its targets: how many are missing or extra."""
    c = chosen.select("case_id", "endpoint").distinct().withColumn("chosen", F.lit(1))
    t = targets.select("case_id", "endpoint").distinct().withColumn("target", F.lit(1))
    both = c.join(t, ["case_id", "endpoint"], "full_outer").groupBy("case_id").agg(F.count(F.when(F.col("chosen").isNull(), 1)).alias("n_missing"), F.count(F.when(F.col("target").isNull(), 1)).alias("n_extra"))
    return both.withColumn("exact", (F.col("n_missing") == 0) & (F.col("n_extra") == 0))


def sensitivity_gate(sensitivity: DataFrame, repairs: DataFrame, min_ns: float = TOLERANCE_NS) -> DataFrame:
    """Per repaired instance: the largest slack gain over endpoints, and whether it is known and large enough."""
    best = sensitivity.groupBy("case_id", "instance").agg(F.max("delta_ns").alias("gain_ns"))
    both = repairs.select("case_id", "instance").distinct().withColumn("repaired", F.lit(True)).join(best, ["case_id", "instance"], "full_outer")
    reason = F.when(F.col("repaired").isNull(), "not_repaired").when(F.col("gain_ns").isNull(), "unmeasured").when(F.col("gain_ns") < min_ns - EPSILON, "too_small").otherwise("ok")
    return both.select("case_id", "instance", "gain_ns", reason.alias("reason"))


def operation_fingerprint(operations: DataFrame, by: list[str]) -> DataFrame:
    """sha256 of a case's operations in order."""
    line = F.concat_ws(" ", "kind", F.col("instance").cast("string"), F.col("old_ref").cast("string"), F.col("new_ref").cast("string"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))), lambda x: x["line"])
    return operations.groupBy(*by).agg(F.sha2(F.array_join(rows, "\n"), 256).alias("fingerprint"), F.count("*").alias("n"))


def tree_digest(inventory: DataFrame, by: list[str], fanout: int = 4096) -> DataFrame:
    """One hash per tree (``by``) from its files' path, bytes and hash, sorted by path: digest, n.

    A tree of up to ``fanout`` files is the hash of its lines. Those of a larger one are hashed in runs of ``fanout`` by path, the runs' hashes (a line each) in runs of ``fanout`` again, until one
    is left; no task ever holds more lines of a tree. Null paths come first and print empty; repeated files count as often; equal paths go by their line.
    """
    line = F.concat_ws("\t", F.coalesce("path", F.lit("")), F.col("bytes").cast("string"), "sha256")
    n = written(inventory.groupBy(*by).agg(F.count("*").alias("n")))
    most = n.agg(F.max("n")).first()[0] or 0
    placed = running(inventory.select(*by, line.alias("line"), "path"), by, ["path", "line"], {"at": "1"})
    level = placed.join(n, by).select(*by, "at", "line", F.col("n").alias("left"), F.lit(False).alias("hashed"))
    while True:
        lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n")
        one = F.when(F.first("hashed") & (F.first("left") == 1), F.first("line")).otherwise(F.sha2(lines, 256))  # a tree that is one hash keeps it
        level = level.groupBy(*by, F.floor((F.col("at") - 1) / fanout).alias("run")).agg(one.alias("line"), F.ceil(F.first("left") / fanout).alias("left"))
        most = -(-most // fanout)
        if most <= 1:
            return level.select(*by, F.col("line").alias("digest")).join(n, by)
        level = written(level.select(*by, (F.col("run") + 1).alias("at"), "line", "left", F.lit(True).alias("hashed")))


def slack_map_digest(slacks: DataFrame, by: list[str]) -> DataFrame:
    """Canonical hash of endpoint -> slack in whole femtoseconds."""
    line = F.concat_ws("=", F.col("endpoint").cast("string"), F.round(F.col("slack_ns") * 1_000_000).cast("long").cast("string"))
    return slacks.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("digest"))


def measurement_rollup(measured: DataFrame, by: list[str], lo: float, hi: float) -> DataFrame:
    """Rows, distinct operations, negatives, extremes and window hits."""
    s = F.col("measured_slack_ns")
    return measured.groupBy(*by).agg(
        F.count("*").alias("n_rows"), F.count_distinct("endpoint", "instance", "new_ref").alias("n_operations"), F.count(F.when(s < 0, 1)).alias("n_negative"),
        F.min(s).alias("min_ns"), F.max(s).alias("max_ns"), F.count(F.when(s.between(lo, hi), 1)).alias("n_in_window"),
    )


def residual_median(measured: DataFrame, by: list[str]) -> DataFrame:
    """Median of measured minus estimated."""
    return measured.groupBy(*by).agg(F.median(F.col("measured_ns") - F.col("estimated_ns")).alias("median_residual"), F.count("*").alias("n"))


def benchmark_rollup(runs: DataFrame) -> DataFrame:
    """Pass rate, wall time, turns and calls by model and case type, with totals."""
    return runs.rollup("model", "case_type").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("passed"), 1)).alias("n_passed"), F.round(F.avg(F.col("passed").cast("double")), 6).alias("pass_rate"), F.round(F.sum("wall_s"), 3).alias("wall_s"), F.sum("turns").alias("turns"), F.grouping_id().alias("level")
    )


# --- states over time ---


def state_transitions(events: DataFrame, allowed: DataFrame) -> DataFrame:
    """Each event against the state before it: is the step allowed, and which attempt is it?"""
    w = Window.partitionBy("case_id").orderBy("sequence")
    step = events.withColumn("previous", F.lag("state").over(w)).withColumn("attempt", F.sum(F.when(F.col("state") == "running", 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    known = allowed.select(F.col("from_state").alias("previous"), F.col("to_state").alias("state"), F.lit(True).alias("_ok"))
    out = step.join(F.broadcast(known), ["previous", "state"], "left")  # pairs of states: a fixed, small table
    return out.withColumn("legal", F.coalesce("_ok", F.lit(False)) | F.col("previous").isNull()).drop("_ok")


def repeat_validation(validations: DataFrame) -> DataFrame:
    """Validations whose candidate hash, checkpoint and profile equal the one before: wasted time."""
    w = Window.partitionBy("case_id").orderBy("sequence")
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.lag(c).over(w)) for c in ("candidate", "checkpoint", "profile")]) & F.lag("sequence").over(w).isNotNull()
    return validations.withColumn("repeated", same)


def last_write_before_read(commands: DataFrame) -> DataFrame:
    """Each read with the last value written to its address before it (null: never written)."""
    w = Window.partitionBy("trace", "addr").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    out = commands.withColumn("expected", F.last(F.when(F.col("op") == "write_reg", F.col("data")), ignorenulls=True).over(w))
    return out.where("op = 'read_reg'")


# --- sets over cases ---


def exact_set_match(observed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per case: do the observed endpoints equal the targets, and what differs?"""
    side = lambda df, n: df.groupBy("case_id").agg(F.array_sort(F.collect_set("endpoint")).alias(n))
    both = side(observed, "o").join(side(targets, "t"), "case_id", "full_outer")
    o, t = (F.coalesce(F.col(c), F.array().cast("array<string>")) for c in ("o", "t"))
    return both.select("case_id", F.array_sort(F.concat(F.array_except(o, t), F.array_except(t, o))).alias("difference")).withColumn("exact", F.size("difference") == 0)


def target_reuse(targets: DataFrame) -> DataFrame:
    """Endpoints that two cases or more claim as target."""
    return targets.groupBy("endpoint").agg(F.count_distinct("case_id").alias("n_cases"), F.min("case_id").alias("first_case")).where("n_cases > 1")


def fingerprint_collisions(fingerprints: DataFrame) -> DataFrame:
    """Cases whose fingerprint an earlier case owns."""
    owner = fingerprints.groupBy("fingerprint").agg(F.min("case_id").alias("owner"), F.count_distinct("case_id").alias("n")).where("n > 1")
    return fingerprints.join(owner, "fingerprint").where("case_id <> owner").select("case_id", "owner", "fingerprint").distinct()


def target_protected_disjoint(targets: DataFrame, protected: DataFrame) -> DataFrame:
    """Per case: how many targets, how many protected endpoints, how many are both (should be none)."""
    t = targets.select("case_id", "endpoint").distinct().withColumn("t", F.lit(1))
    p = protected.select("case_id", "endpoint").distinct().withColumn("p", F.lit(1))
    return t.join(p, ["case_id", "endpoint"], "full_outer").groupBy("case_id").agg(F.count("t").alias("n_targets"), F.count("p").alias("n_protected"), F.count(F.when(F.col("t").isNotNull() & F.col("p").isNotNull(), 1)).alias("n_both"))


def measurement_union_dedupe(*measured: DataFrame, key: list[str], best: list) -> DataFrame:
    """All runs together, one row per operation by best evidence."""
    every = reduce(DataFrame.unionByName, measured)
    return every.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*best))).where("_n = 1").drop("_n")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def priority_case_order(specs: DataFrame, classes: list[str]) -> DataFrame:
    """Cases by profile class, then hardest first."""
    place = F.array_position(F.array(*map(F.lit, classes)), F.col("profile"))
    return specs.withColumn("class", place).orderBy("class", F.desc("target_count"), F.desc("nominal"), "case_id")


def spec_range_checks(specs: DataFrame, rules: DataFrame) -> DataFrame:
    """Specs whose count lies outside the range of their difficulty, or that have no rule."""
    both = specs.join(F.broadcast(rules), "difficulty", "left")  # one rule per difficulty
    return both.where(~F.coalesce(F.col("target_count").between(F.col("least"), F.col("most")), F.lit(False)))


# --- registered queries ---

query("functional_pair_lookup", """WITH k AS (SELECT source_ref AS a, variant_ref AS b FROM {ladders} UNION SELECT variant_ref, source_ref FROM {ladders})
    SELECT l_orderkey AS case_id, l_linenumber AS seq, l_partkey AS old_ref, l_suppkey AS new_ref, (l_partkey, l_suppkey) IN (SELECT (a, b) FROM k) AS equivalent FROM lineitem""")(
    lambda t: _pair_lookup(t)
)


def _pair_lookup(t) -> DataFrame:
    """Both ways round are the same question here: parts of one class with other sizes, as in the ladders."""
    diffs = t.lineitem.select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("old_ref"), F.col("l_suppkey").alias("new_ref"))
    parts = t.part.select(F.col("p_partkey").alias("ref"), F.col("p_size").alias("drive"), "p_brand", "p_type", F.floor((F.col("p_size") - 1) / 10).alias("reach"))
    return functional_pair_lookup(diffs, pairs_in_classes(diffs, parts, ["p_brand", "p_type", "reach"]))


query("cell_diff", """SELECT coalesce(b.instance, a.instance) AS instance, coalesce(b.ref, -1) AS old_ref, coalesce(a.ref, -1) AS new_ref, CASE WHEN b.ref IS NULL THEN 'added' WHEN a.ref IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM {cells_before} b FULL JOIN {cells_after} a ON a.instance = b.instance WHERE b.ref IS DISTINCT FROM a.ref""")(
    lambda t: cell_diff(t.cells_before, t.cells_after).withColumns({c: F.coalesce(c, F.lit(-1).cast("long")) for c in ("old_ref", "new_ref")})
)
query("slack_compare", """SELECT coalesce(l.case_id, r.case_id) AS case_id, coalesce(l.endpoint, r.endpoint) AS endpoint, CASE WHEN r.slack_ns IS NULL THEN 'only_left' WHEN l.slack_ns IS NULL THEN 'only_right' ELSE 'over' END AS reason
    FROM {replay_1} l FULL JOIN {replay_2} r ON l.case_id = r.case_id AND l.endpoint = r.endpoint WHERE l.slack_ns IS NULL OR r.slack_ns IS NULL OR abs(l.slack_ns - r.slack_ns) > 0.001 + 1e-12""")(
    lambda t: slack_compare(t.replay_1, t.replay_2, ["case_id", "endpoint"]).select("case_id", "endpoint", "reason")
)
query("protected_drop", """SELECT coalesce(l.case_id, r.case_id) AS case_id, coalesce(l.endpoint, r.endpoint) AS endpoint, CASE WHEN r.case_id IS NULL THEN 'missing' WHEN l.case_id IS NULL THEN 'extra' WHEN r.slack_ns < 0 THEN 'negative' ELSE 'dropped' END AS reason
    FROM {replay_1} l FULL JOIN (SELECT * FROM {replay_2} WHERE case_id % 7 <> 0) r ON l.case_id = r.case_id AND l.endpoint = r.endpoint WHERE l.case_id IS NULL OR r.case_id IS NULL OR r.slack_ns < 0 OR l.slack_ns - r.slack_ns > 0.001 + 1e-12""")(
    lambda t: protected_drop(t.replay_1, t.replay_2.where("case_id % 7 <> 0"), ["case_id", "endpoint"]).select("case_id", "endpoint", "reason")
)
BOTH = "b AS (SELECT coalesce(x.case_id, y.case_id) AS case_id, coalesce(x.category, y.category) AS category, coalesce(x.n, 0) AS n_before, coalesce(y.n, 0) AS n_after FROM {drc_before} x FULL JOIN {drc_after} y ON x.case_id = y.case_id AND x.category = y.category)"
query("category_regression", f"WITH {BOTH} SELECT 'each' AS mode, * FROM b WHERE n_after > n_before UNION ALL SELECT 'new_only', * FROM b WHERE n_before = 0 AND n_after > 0 UNION ALL SELECT 'total', case_id, 'total', CAST(sum(n_before) AS BIGINT), CAST(sum(n_after) AS BIGINT) FROM b GROUP BY case_id HAVING sum(n_after) > sum(n_before)")(
    lambda t: reduce(DataFrame.unionByName, [category_regression(t.drc_before, t.drc_after, m).withColumn("mode", F.lit(m)) for m in ("each", "new_only", "total")])
)
MARKERS = "m AS (SELECT o_custkey AS case_id, CASE WHEN o_orderpriority < '3' THEN 'setup' ELSE 'hold' END AS corner, min(o_orderstatus) AS top, count(*) AS threshold, max(o_orderpriority) AS version, min(o_totalprice) > 20000 AS passed FROM orders GROUP BY 1, 2)"
query("corner_crosscheck", f"""WITH {MARKERS} SELECT coalesce(s.case_id, h.case_id) AS case_id, concat_ws(',', CASE WHEN s.case_id IS NULL OR h.case_id IS NULL THEN 'missing_corner' END, CASE WHEN coalesce(s.top = h.top, false) THEN NULL ELSE 'top_differs' END,
    CASE WHEN coalesce(s.threshold = h.threshold, false) THEN NULL ELSE 'threshold_differs' END, CASE WHEN coalesce(s.version = h.version, false) THEN NULL ELSE 'version_differs' END, CASE WHEN coalesce(s.passed, false) AND coalesce(h.passed, false) THEN NULL ELSE 'not_passed' END) AS reasons
    FROM (SELECT * FROM m WHERE corner = 'setup') s FULL JOIN (SELECT * FROM m WHERE corner = 'hold') h ON s.case_id = h.case_id""")(
    lambda t: corner_crosscheck(
        t.orders.groupBy(F.col("o_custkey").alias("case_id"), F.when(F.col("o_orderpriority") < "3", "setup").otherwise("hold").alias("corner"))
        .agg(F.min("o_orderstatus").alias("top"), F.count("*").alias("threshold"), F.max("o_orderpriority").alias("version"), (F.min("o_totalprice") > 20000).alias("passed"))
    ).withColumn("reasons", F.array_join("reasons", ","))
)


def _files(t) -> tuple[DataFrame, DataFrame]:
    d = t.documents.select(F.col("source").alias("case_id"), F.col("doc_id").cast("string").alias("path"), F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    f = d.where("cast(path as bigint) % 13 <> 0").withColumn("bytes", F.when(F.expr("cast(path as bigint) % 17 = 0"), F.col("bytes") + 1).otherwise(F.col("bytes"))).withColumn("sha256", F.when(F.expr("cast(path as bigint) % 19 = 0"), F.lit("0")).otherwise(F.col("sha256")))
    return d, f


FILES = "d AS (SELECT source AS case_id, CAST(doc_id AS STRING) AS path, CAST(strlen(text) AS BIGINT) AS bytes, sha256(text) AS sha256 FROM documents), f AS (SELECT case_id, path, bytes + CASE WHEN CAST(path AS BIGINT) % 17 = 0 THEN 1 ELSE 0 END AS bytes, CASE WHEN CAST(path AS BIGINT) % 19 = 0 THEN '0' ELSE sha256 END AS sha256 FROM d WHERE CAST(path AS BIGINT) % 13 <> 0)"
query("inventory_verify", f"WITH {FILES} SELECT d.case_id, d.path, CASE WHEN f.bytes IS NULL THEN 'missing' WHEN d.bytes <> f.bytes THEN 'bytes' ELSE 'hash' END AS reason FROM d LEFT JOIN f ON d.case_id = f.case_id AND d.path = f.path WHERE f.bytes IS NULL OR d.bytes <> f.bytes OR d.sha256 <> f.sha256")(lambda t: inventory_verify(*_files(t)))


def _tree_sql(fanout: int) -> str:
    """The rule of ``tree_digest``: lines, then hashes, in runs of ``fanout`` by path, as often as it takes to be left with one (a tree of one run: its lines hashed once)."""
    line = "concat_ws(chr(9), coalesce(path, ''), CAST(bytes AS STRING), sha256)"
    text = f"WITH {FILES}, t0 AS (SELECT case_id, {line} AS line, row_number() OVER (PARTITION BY case_id ORDER BY path NULLS FIRST, {line}) - 1 AS k, count(*) OVER (PARTITION BY case_id) AS n FROM d)"
    levels, left = 0, 1
    while left < 2**63:  # no table is larger
        hashed = "sha256(string_agg(line, chr(10) ORDER BY k))"
        one = hashed if levels == 0 else f"CASE WHEN n <= {left} THEN min(line) ELSE {hashed} END"
        levels, left = levels + 1, left * fanout
        text += f", t{levels} AS (SELECT case_id, n, k // {fanout} AS k, {one} AS line FROM t{levels - 1} GROUP BY case_id, n, k // {fanout})"
    return f"{text} SELECT case_id, line AS digest, n FROM t{levels}"


query("tree_digest", _tree_sql(4096))(lambda t: tree_digest(_files(t)[0], ["case_id"]))
query("tree_digest_deep", _tree_sql(16))(lambda t: tree_digest(_files(t)[0], ["case_id"], 16))
query("dataset_sync_diff", "SELECT conv_id * 100 + turn AS id, CASE WHEN (conv_id * 100 + turn) % 7 = 0 THEN 'missing' ELSE 'changed' END AS reason FROM conversations WHERE (conv_id * 100 + turn) % 7 = 0 OR (conv_id * 100 + turn) % 11 = 0")(
    lambda t: dataset_sync_diff(
        e := t.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), "role", "text"), e.where("id % 7 <> 0").withColumn("text", F.when(F.col("id") % 11 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))), "id",
    )
)
query("object_visibility", "SELECT DISTINCT case_id, instance FROM {operations} o WHERE kind = 'repair' AND NOT EXISTS (SELECT 1 FROM {operations} v WHERE v.kind = 'injection' AND v.case_id = o.case_id AND v.instance = o.instance)")(
    lambda t: object_visibility(t.operations.where("kind = 'repair'"), t.operations.where("kind = 'injection'"))
)
query("distribution_cube", "SELECT shape, strategy, difficulty, count(*) AS n, CAST(grouping_id(shape, strategy, difficulty) AS BIGINT) AS level FROM {catalog} GROUP BY CUBE (shape, strategy, difficulty)")(lambda t: distribution_cube(t.catalog))
STATES = ["planned", "running", "measured", "accepted", "failed", "abandoned"]
query("state_counts", "WITH s AS (SELECT case_id, arg_max(state, sequence) AS state FROM {state_events} GROUP BY case_id) SELECT CAST(place AS BIGINT) AS place, d.state, (SELECT count(*) FROM s WHERE s.state = d.state) AS n FROM (VALUES " + ", ".join(f"({i}, '{s}')" for i, s in enumerate(STATES)) + ") d(place, state)")(
    lambda t: state_counts(t.state_events.groupBy("case_id").agg(F.max_by("state", "sequence").alias("state")), STATES)
)
query("target_coverage", "WITH c AS (SELECT DISTINCT run_id AS case_id, endpoint FROM {paths} WHERE analysis = 'O'), g AS (SELECT DISTINCT run_id AS case_id, endpoint FROM {paths} WHERE analysis = 'F') SELECT coalesce(c.case_id, g.case_id) AS case_id, count(CASE WHEN c.case_id IS NULL THEN 1 END) AS n_missing, count(CASE WHEN g.case_id IS NULL THEN 1 END) AS n_extra, count(CASE WHEN c.case_id IS NULL OR g.case_id IS NULL THEN 1 END) = 0 AS exact FROM c FULL JOIN g ON c.case_id = g.case_id AND c.endpoint = g.endpoint GROUP BY 1")(
    lambda t: target_coverage(t.paths.where("analysis = 'O'").select(F.col("run_id").alias("case_id"), "endpoint"), t.paths.where("analysis = 'F'").select(F.col("run_id").alias("case_id"), "endpoint"))
)
query("sensitivity_gate", "WITH s AS (SELECT case_id, instance, max((new_ref - old_ref) * 5e-4) AS gain_ns FROM {operations} WHERE kind = 'injection' GROUP BY 1, 2), r AS (SELECT DISTINCT case_id, instance FROM {operations} WHERE kind = 'repair') SELECT coalesce(s.case_id, r.case_id) AS case_id, coalesce(s.instance, r.instance) AS instance, round(gain_ns, 6) AS gain_ns, CASE WHEN r.case_id IS NULL THEN 'not_repaired' WHEN gain_ns IS NULL THEN 'unmeasured' WHEN gain_ns < 0.001 - 1e-12 THEN 'too_small' ELSE 'ok' END AS reason FROM s FULL JOIN r ON s.case_id = r.case_id AND s.instance = r.instance")(
    lambda t: sensitivity_gate(t.operations.where("kind = 'injection'").select("case_id", "instance", ((F.col("new_ref") - F.col("old_ref")) * 5e-4).alias("delta_ns")), t.operations.where("kind = 'repair'")).withColumn("gain_ns", F.round("gain_ns", 6))
)
PRINT = "SELECT case_id, kind, sha256(string_agg(kind || ' ' || CAST(instance AS STRING) || ' ' || CAST(old_ref AS STRING) || ' ' || CAST(new_ref AS STRING), chr(10) ORDER BY seq)) AS fingerprint, count(*) AS n FROM {operations} GROUP BY case_id, kind"
query("operation_fingerprint", PRINT)(lambda t: operation_fingerprint(t.operations, ["case_id", "kind"]))
query("slack_map_digest", "SELECT case_id, sha256(string_agg(endpoint || '=' || CAST(CAST(round(slack_ns * 1000000) AS BIGINT) AS STRING), chr(10) ORDER BY endpoint || '=' || CAST(CAST(round(slack_ns * 1000000) AS BIGINT) AS STRING))) AS digest FROM {replay_1} GROUP BY case_id")(lambda t: slack_map_digest(t.replay_1, ["case_id"]))
query("measurement_rollup", "SELECT hierarchy_group, count(*) AS n_rows, count(DISTINCT (endpoint, instance, new_ref)) AS n_operations, count(CASE WHEN measured_slack_ns < 0 THEN 1 END) AS n_negative, round(min(measured_slack_ns), 9) AS min_ns, round(max(measured_slack_ns), 9) AS max_ns, count(CASE WHEN measured_slack_ns BETWEEN -0.02 AND 0.02 THEN 1 END) AS n_in_window FROM {measured} GROUP BY hierarchy_group")(
    lambda t: measurement_rollup(t.measured, ["hierarchy_group"], -0.02, 0.02).withColumns({"min_ns": F.round("min_ns", 9), "max_ns": F.round("max_ns", 9)})
)
query("residual_median", "SELECT l_returnflag AS family, CAST(l_linenumber AS BIGINT) AS drive, round(median(l_extendedprice - l_quantity * 1000), 6) AS median_residual, count(*) AS n FROM lineitem GROUP BY 1, 2")(
    lambda t: residual_median(t.lineitem.select(F.col("l_returnflag").alias("family"), F.col("l_linenumber").cast("long").alias("drive"), F.col("l_extendedprice").alias("measured_ns"), (F.col("l_quantity") * 1000).alias("estimated_ns")), ["family", "drive"]).withColumn("median_residual", F.round("median_residual", 6))
)
query("benchmark_rollup", "SELECT o_orderpriority AS model, o_orderstatus AS case_type, count(*) AS n, count(CASE WHEN o_totalprice > 100000 THEN 1 END) AS n_passed, round(avg(CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0 END), 6) AS pass_rate, round(CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE), 3) AS wall_s, CAST(sum(o_custkey % 9) AS BIGINT) AS turns, CAST(grouping_id(o_orderpriority, o_orderstatus) AS BIGINT) AS level FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)")(
    lambda t: benchmark_rollup(t.orders.select(F.col("o_orderpriority").alias("model"), F.col("o_orderstatus").alias("case_type"), (F.col("o_totalprice") > 100000).alias("passed"), F.round("o_totalprice").alias("wall_s"), (F.col("o_custkey") % 9).alias("turns")))
)
ALLOWED = [("planned", "running"), ("running", "measured"), ("running", "failed"), ("measured", "accepted"), ("measured", "failed"), ("failed", "running")]
ALLOWED_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in ALLOWED) + ") k(a, b)"
query("state_transitions", f"WITH s AS (SELECT *, lag(state) OVER w AS previous, sum(CASE WHEN state = 'running' THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS attempt FROM {{state_events}} WINDOW w AS (PARTITION BY case_id ORDER BY sequence)) SELECT case_id, sequence, state, coalesce(previous, '') AS previous, CAST(attempt AS BIGINT) AS attempt, previous IS NULL OR (previous, state) IN (SELECT (a, b) FROM {ALLOWED_SQL}) AS legal FROM s")(
    lambda t: state_transitions(t.state_events, t.spark.createDataFrame(ALLOWED, "from_state string, to_state string")).select("case_id", "sequence", "state", F.coalesce("previous", F.lit("")).alias("previous"), "attempt", "legal")
)
query("repeat_validation", "SELECT event_id AS sequence, coalesce(event_type = lag(event_type) OVER w AND CAST(floor(value / 20) AS BIGINT) = lag(CAST(floor(value / 20) AS BIGINT)) OVER w, false) AS repeated FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")(
    lambda t: repeat_validation(t.events.select(F.col("user_id").alias("case_id"), F.col("event_id").alias("sequence"), F.col("event_type").alias("candidate"), F.floor(F.col("value") / 20).alias("checkpoint"), F.lit("a").alias("profile"))).select("sequence", "repeated")
)
query("last_write_before_read", "WITH s AS (SELECT *, last_value(CASE WHEN op = 'write_reg' THEN data END IGNORE NULLS) OVER (PARTITION BY trace, addr ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM {trace}) SELECT trace, seq, addr, coalesce(e, -1) AS expected FROM s WHERE op = 'read_reg'")(
    lambda t: last_write_before_read(t.trace).select("trace", "seq", "addr", F.coalesce("expected", F.lit(-1).cast("long")).alias("expected"))
)
query("exact_set_match", "WITH o AS (SELECT DISTINCT case_id, endpoint FROM {replay_1} WHERE slack_ns < 0.03), g AS (SELECT DISTINCT case_id, endpoint FROM {replay_2} WHERE slack_ns < 0.0295), x AS (SELECT coalesce(o.case_id, g.case_id) AS case_id, CASE WHEN o.case_id IS NULL OR g.case_id IS NULL THEN coalesce(o.endpoint, g.endpoint) END AS d FROM o FULL JOIN g ON o.case_id = g.case_id AND o.endpoint = g.endpoint) SELECT case_id, coalesce(string_agg(d, ',' ORDER BY d), '') AS difference, count(d) = 0 AS exact FROM x GROUP BY case_id")(
    lambda t: exact_set_match(t.replay_1.where("slack_ns < 0.03"), t.replay_2.where("slack_ns < 0.0295")).withColumn("difference", F.array_join("difference", ","))
)
query("target_reuse", "SELECT endpoint, count(DISTINCT run_id) AS n_cases, min(run_id) AS first_case FROM {paths} WHERE slack_ns < 0 GROUP BY endpoint HAVING count(DISTINCT run_id) > 1")(lambda t: target_reuse(t.paths.where("slack_ns < 0").withColumnRenamed("run_id", "case_id")))
query("fingerprint_collisions", f"WITH f AS (SELECT case_id, sha256(string_agg(CAST(instance % 7 AS STRING), '-' ORDER BY seq)) AS fingerprint FROM {{operations}} WHERE kind = 'repair' GROUP BY case_id), o AS (SELECT fingerprint, min(case_id) AS owner FROM f GROUP BY fingerprint HAVING count(DISTINCT case_id) > 1) SELECT DISTINCT case_id, owner, f.fingerprint FROM f JOIN o ON f.fingerprint = o.fingerprint WHERE case_id <> owner")(
    lambda t: fingerprint_collisions(t.operations.where("kind = 'repair'").groupBy("case_id").agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", (F.col("instance") % 7).cast("string").alias("v")))), lambda x: x["v"]), "-"), 256).alias("fingerprint")))
)
query("target_protected_disjoint", "WITH t AS (SELECT DISTINCT run_id AS case_id, endpoint FROM {paths} WHERE slack_ns < 0), p AS (SELECT DISTINCT run_id AS case_id, endpoint FROM {paths} WHERE slack_ns > 0.4) SELECT coalesce(t.case_id, p.case_id) AS case_id, count(t.endpoint) AS n_targets, count(p.endpoint) AS n_protected, count(CASE WHEN t.endpoint = p.endpoint THEN 1 END) AS n_both FROM t FULL JOIN p ON t.case_id = p.case_id AND t.endpoint = p.endpoint GROUP BY 1")(
    lambda t: target_protected_disjoint(t.paths.where("slack_ns < 0").withColumnRenamed("run_id", "case_id"), t.paths.where("slack_ns > 0.4").withColumnRenamed("run_id", "case_id"))
)
query("measurement_union_dedupe", "WITH u AS (SELECT * FROM {measured} UNION ALL SELECT * REPLACE (evidence_level + 1 AS evidence_level) FROM {measured} WHERE new_ref < 50), r AS (SELECT *, row_number() OVER (PARTITION BY endpoint, instance, baseline_ref, new_ref ORDER BY evidence_level DESC, measured_slack_ns, hierarchy_group) AS n FROM u) SELECT endpoint, instance, baseline_ref, new_ref, evidence_level, measured_slack_ns FROM r WHERE n = 1")(
    lambda t: measurement_union_dedupe(t.measured, t.measured.where("new_ref < 50").withColumn("evidence_level", F.col("evidence_level") + 1), key=["endpoint", "instance", "baseline_ref", "new_ref"], best=[F.desc("evidence_level"), "measured_slack_ns", "hierarchy_group"])
    .select("endpoint", "instance", "baseline_ref", "new_ref", "evidence_level", "measured_slack_ns")
)
query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")(lambda t: duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]))
CLASSES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
query("priority_case_order", "SELECT case_id, CAST(list_position(" + str(CLASSES) + ", profile) AS BIGINT) AS class, target_count, nominal FROM {specs}")(lambda t: priority_case_order(t.specs, CLASSES).select("case_id", "class", "target_count", "nominal"))
query("spec_range_checks", "SELECT case_id, difficulty, target_count FROM {catalog} WHERE NOT (CASE difficulty WHEN 'easy' THEN target_count BETWEEN 1 AND 10 WHEN 'medium' THEN target_count BETWEEN 20 AND 35 ELSE false END)")(
    lambda t: spec_range_checks(t.catalog, t.spark.createDataFrame([("easy", 1, 10), ("medium", 20, 35)], "difficulty string, least int, most int")).select("case_id", "difficulty", "target_count")
)
