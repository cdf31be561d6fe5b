"""Rules of specs, repairs, markers and scripts in full: each broken rule is a reason in a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import lines
from millrace.registry import query

EPSILON = 1e-12
#: Number of modifications (from, to) and severity in ps (above, to) of each difficulty; the profile whose repair is the direct inverse.
COUNTS = {"E": (1, 2), "M": (2, 4), "H": (4, 6)}
BANDS = {"E": (39.0, 160.0), "M": (160.0, 400.0), "H": (400.0, 640.0)}
DIRECT = "I0"
#: Fields that a result marker needs, and an error marker.
MARKER_FIELDS = ("mode", "delay_type", "top", "wns_ns", "tns_ns", "violating_paths", "threshold_ns", "parasitics_read", "propagated_clocks", "clock_count", "tool_version")
ERROR_FIELDS = ("mode", "delay_type", "reason")


def _not(test: Column) -> Column:
    return ~F.coalesce(test, F.lit(False))


def _reasons(**tests: Column) -> Column:
    return F.array_compact(F.array(*[F.when(broken, name) for name, broken in tests.items()]))


def _of(table: dict[str, tuple], key: str, place: int) -> Column:
    return F.create_map(*[F.lit(x) for k, v in table.items() for x in (k, float(v[place]))])[F.col(key)]


def spec_checks(specs: DataFrame) -> DataFrame:
    """Reasons of each spec: case_id, reasons. ``specs``: case_id, difficulty, n_modifications, severity_ps, percent (of an 8 ns clock), tolerance_ps, profile, inverse_allowed.

    difficulty (unknown), modifications, severity (outside the band), percent (80 ps each), tolerance (15 %, 10 ps at least), inverse (only profile DIRECT allows it). Null breaks its rule; a
    case_id that repeats has ``repeated`` on all its rows.
    """
    n, ps = F.col("n_modifications"), F.col("severity_ps")
    again = F.count("*").over(Window.partitionBy("case_id")) > 1
    return specs.select("case_id", _reasons(
        repeated=again, difficulty=_not(F.col("difficulty").isin(*COUNTS)), modifications=_not((n >= _of(COUNTS, "difficulty", 0)) & (n <= _of(COUNTS, "difficulty", 1))),
        severity=_not((ps > _of(BANDS, "difficulty", 0)) & (ps <= _of(BANDS, "difficulty", 1))), percent=_not(F.abs(F.col("percent") * 80 - ps) <= 0.001),
        tolerance=_not(F.abs(F.col("tolerance_ps") - F.greatest(F.lit(10.0), ps * 0.15)) <= EPSILON * 1e3), inverse=_not((F.col("profile") == DIRECT) == F.col("inverse_allowed")),
    ).alias("reasons"))


def distribution_check(specs: DataFrame, expected: DataFrame) -> DataFrame:
    """Cells and margins of shape, strategy and difficulty whose count is not what ``expected`` (shape, strategy, difficulty, n; null stands for all) says: with n, wanted.

    Every cell that has specs must be expected unless no cell without a null is; margins are compared only if they are expected. Null values of specs are counted as ``?``.
    """
    by = ["shape", "strategy", "difficulty"]
    known = specs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c) for c in by])
    got = known.cube(*by).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    want = expected.select(*by, F.col("n").alias("wanted"))
    full = not want.where(" and ".join(f"{c} is not null" for c in by)).isEmpty()
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"w.{c}")) for c in by]
    both = got.alias("g").join(want.alias("w"), same, "full_outer")
    wrong = F.when(F.col("wanted").isNull(), F.lit(full) & (F.col("level") == 0)).otherwise(~F.col("n").eqNullSafe(F.col("wanted")) & ~(F.col("n").isNull() & (F.col("wanted") == 0)))
    return both.where(wrong).select(*[F.coalesce(f"g.{c}", f"w.{c}").alias(c) for c in by], F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("wanted", F.lit(0)).alias("wanted"))


def inverse_policy(injection: DataFrame, repair: DataFrame, specs: DataFrame) -> DataFrame:
    """Does each case's repair follow its profile? case_id, reasons. ``injection``, ``repair``: case_id, instance, old_ref, new_ref; ``specs``: case_id, profile, n_modifications.

    Profile DIRECT: as many modifications as the spec says, on the same instances, each the exact inverse (count, instances, refs). Any other: each side has an instance that the other lacks
    (instances), and no repair's refs are those of an injection turned round, on whatever instance (ref_inverse). no_injection, no_repair: a case without any. An instance twice on one side
    breaks ``repeated``. Cases without a spec are not told.
    """
    i = injection.select("case_id", "instance", F.col("old_ref").alias("io"), F.col("new_ref").alias("in")).groupBy("case_id", "instance").agg(F.count("*").alias("ki"), F.first("io").alias("io"), F.first("in").alias("in"))
    r = repair.groupBy("case_id", "instance").agg(F.count("*").alias("kr"), F.first("old_ref").alias("ro"), F.first("new_ref").alias("rn"))
    both = i.join(r, ["case_id", "instance"], "full_outer").groupBy("case_id").agg(
        F.count("ki").alias("n_i"), F.count("kr").alias("n_r"), F.count_if(F.col("ki").isNotNull() & F.col("kr").isNull()).alias("only_i"), F.count_if(F.col("ki").isNull()).alias("only_r"),
        F.count_if(F.col("ki").isNotNull() & F.col("kr").isNotNull() & _not((F.col("ro") == F.col("in")) & (F.col("rn") == F.col("io")))).alias("odd"), F.bool_or((F.col("ki") > 1) | (F.col("kr") > 1)).alias("twice"),
    )
    turned = injection.select("case_id", F.col("new_ref").alias("a"), F.col("old_ref").alias("b")).distinct()
    again = repair.select("case_id", F.col("old_ref").alias("a"), F.col("new_ref").alias("b")).distinct().join(turned, ["case_id", "a", "b"]).groupBy("case_id").agg(F.count("*").alias("n_inverse"))
    s = specs.select("case_id", "profile", "n_modifications").join(both, "case_id", "left").join(again, "case_id", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    direct = F.coalesce(F.col("profile") == DIRECT, F.lit(False))
    return s.select("case_id", _reasons(
        no_injection=n("n_i") == 0, no_repair=n("n_r") == 0, repeated=F.coalesce("twice", F.lit(False)), count=direct & _not(F.col("n_i") == F.col("n_modifications")), instances=F.when(direct, (n("only_i") > 0) | (n("only_r") > 0)).otherwise((n("only_i") == 0) | (n("only_r") == 0)),
        refs=direct & (n("odd") > 0), ref_inverse=~direct & (n("n_inverse") > 0),
    ).alias("reasons"))


def check_markers(texts: DataFrame, prefix: str, version: str) -> DataFrame:
    """Every line ``PREFIX k=v ...`` of ``texts`` (with text) as status, mode and numbers, and the reasons why it contradicts itself.

    Reasons: malformed (a token without ``=``, or without key or value), repeated (a key twice), status, missing, mode, delay_type (max for setup, min for hold), number (no finite number, or a count below 0), threshold (below 0), parasitics, clocks, tns_sign,
    paths_and_tns, paths_and_wns, verdict (PASS exactly if WNS reaches the threshold and nothing violates), version. An error marker needs mode, delay_type and reason only; its mode may be unknown.
    """
    m = lines(texts).where((F.col("line") == prefix) | F.startswith("line", F.lit(prefix + " ")))
    words = F.filter(F.split(F.substring("line", len(prefix) + 2, 1_000_000), r"\s+"), lambda w: w != "")
    pairs = F.transform(words, lambda w: F.struct(F.substring_index(w, "=", 1).alias("k"), F.when(F.instr(w, "=") > 0, F.substr(w, F.instr(w, "=") + 1)).otherwise(F.lit(None)).alias("v")))
    m = m.withColumn("p", pairs)
    value = lambda k: F.get(F.transform(F.filter("p", lambda x: x["k"] == k), lambda x: x["v"]), F.lit(0))
    number = lambda k: value(k).try_cast("double")
    m = m.withColumns({k: value(k) for k in ("status", "mode", "delay_type", "top", "tool_version", "reason")} | {k: number(k) for k in ("wns_ns", "tns_ns", "threshold_ns", "violating_paths", "clock_count", "parasitics_read", "propagated_clocks")})
    error = F.coalesce(F.col("status") == "ERROR", F.lit(False))
    has = lambda names: F.forall(F.array(*map(F.lit, names)), lambda k: F.exists("p", lambda x: x["k"] == k))
    counts = ("violating_paths", "clock_count", "parasitics_read", "propagated_clocks")
    finite = F.lit(True)
    for c in ("wns_ns", "tns_ns", "threshold_ns", *counts):
        finite = finite & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) & (F.lit(c not in counts) | ((F.col(c) >= 0) & (F.col(c) == F.floor(c))))
    v, w, t = F.col("violating_paths"), F.col("wns_ns"), F.col("tns_ns")
    good = (w >= F.col("threshold_ns") - EPSILON) & (F.abs(t) <= EPSILON) & (v == 0)
    full = ~error
    told = _reasons(
        malformed=F.exists("p", lambda x: (x["k"] == "") | x["v"].isNull() | (x["v"] == "")), repeated=F.size(F.array_distinct(F.transform("p", lambda x: x["k"]))) < F.size("p"), status=_not(F.col("status").isin("PASS", "FAIL", "ERROR")),
        missing=F.when(error, ~has(ERROR_FIELDS)).otherwise(~has(MARKER_FIELDS)), mode=_not(F.col("mode").isin("setup", "hold") | (error & (F.col("mode") == "unknown"))),
        delay_type=F.col("mode").isin("setup", "hold") & _not(F.col("delay_type") == F.when(F.col("mode") == "setup", "max").otherwise("min")), number=full & _not(finite), threshold=full & (F.col("threshold_ns") < 0),
        parasitics=full & (F.col("parasitics_read") != 1), clocks=full & ((F.col("propagated_clocks") != 1) | (F.col("clock_count") < 1)), tns_sign=full & (t > EPSILON), paths_and_tns=full & ((v > 0) != (t < -EPSILON)), paths_and_wns=full & (((v == 0) & (w < -EPSILON)) | ((v > 0) & (w >= 0))),
        verdict=full & _not((F.col("status") == "PASS") == good), version=full & _not(F.col("tool_version") == version),
    )
    return m.withColumn("reasons", told).drop("p", "text", "line")


def fix_script_policy(scripts: DataFrame, cells: DataFrame, budgets: DataFrame) -> DataFrame:
    """Reasons why a script (script_id, text) of resizes is refused: script_id, n_actions, reasons. ``cells``: script_id, instance (those that the case shows); ``budgets``: script_id, budget.

    Lines that are blank or begin with ``#`` don't count. substitution (any of ``; [ ] $ \\``), unknown_command, form (options that are not exactly those of the command, or names that are no
    plain names), hidden_cell, outside_batch (a resize before the batch opens or after it closes), inside_batch (placement or routing within), no_action, budget, batch (not opened and closed once, in this order), placement
    (not once each), order (placement after the last action, then routing). A script without a budget has ``budget``; one without text has no_action, batch and placement.
    """
    l = lines(scripts).withColumn("line", F.trim(F.regexp_replace("line", r"\s+", " "))).where(~F.col("line").rlike("^(#|$)"))  # noqa: E741
    w = Window.partitionBy("script_id").orderBy("line_no")
    word = F.substring_index("line", " ", 1)
    l = l.withColumns({"word": word, "open": F.col("line") == "setEcoMode -batchMode true", "close": F.col("line") == "setEcoMode -batchMode false"})  # noqa: E741
    depth = F.sum(F.when(F.col("open"), 1).when(F.col("close"), -1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    name = r"(?:\{[A-Za-z0-9_/\[\]\.]+\}|[A-Za-z0-9_/\.]+)"
    resize = rf"^ecoChangeCell -inst ({name}) -cell ({name})$"
    instance = F.translate(F.regexp_extract("line", resize, 1), "{}", "")
    l = l.withColumns({"instance": F.nullif(instance, F.lit("")), "place": F.col("line") == "refinePlace -eco true", "route": F.col("line") == "ecoRoute -target"})  # noqa: E741
    # what is asked of a line is answered before the shuffles, which carry no texts
    fine = F.col("open") | F.col("close") | F.col("instance").isNotNull() | F.col("place") | F.col("route")
    asked = {"act": F.col("word") == "ecoChangeCell", "allowed": F.col("word").isin("setEcoMode", "ecoChangeCell", "refinePlace", "ecoRoute"), "fine": fine, "subst": F.col("line").rlike(r"[;\[\]$\\]") & F.col("instance").isNull()}
    l = l.withColumns(asked).select("script_id", "line_no", "instance", "open", "close", "place", "route", *asked).withColumn("depth", depth)  # noqa: E741
    seen = cells.select("script_id", "instance", F.lit(True).alias("seen")).distinct()
    l = l.join(seen, ["script_id", "instance"], "left")  # noqa: E741
    n = lambda test: F.count_if(F.coalesce(test, F.lit(False)))
    act, allowed, fine = F.col("act"), F.col("allowed"), F.col("fine")
    at = lambda test: F.max(F.when(test, F.col("line_no")))
    s = l.groupBy("script_id").agg(
        n(F.col("subst")).alias("subst"), n(~allowed).alias("unknown"), n(allowed & ~fine).alias("form"), n(act & F.col("instance").isNotNull() & F.col("seen").isNull()).alias("hidden"), n(act & (F.col("depth") != 1)).alias("outside"),
        n((F.col("place") | F.col("route")) & (F.col("depth") > 0)).alias("inside"), n(act).alias("n_actions"), n(F.col("open")).alias("opens"), n(F.col("close")).alias("closes"), at(F.col("open")).alias("o"), at(F.col("close")).alias("c"), n(F.col("place")).alias("places"), n(F.col("route")).alias("routes"),
        at(act).alias("last"), at(F.col("place")).alias("p"), at(F.col("route")).alias("r"),
    )
    every = scripts.select("script_id").distinct().join(s, "script_id", "left").join(budgets.select("script_id", "budget"), "script_id", "left")
    k = lambda c: F.coalesce(F.col(c), F.lit(0))
    once = (k("places") == 1) & (k("routes") == 1)
    return every.select("script_id", k("n_actions").alias("n_actions"), _reasons(
        substitution=k("subst") > 0, unknown_command=k("unknown") > 0, form=k("form") > 0, hidden_cell=k("hidden") > 0, outside_batch=k("outside") > 0, inside_batch=k("inside") > 0, no_action=k("n_actions") == 0, budget=_not(k("n_actions") <= F.col("budget")),
        batch=_not((k("opens") == 1) & (k("closes") == 1) & (F.col("o") < F.col("c"))), placement=~once, order=once & _not((k("last") < F.col("p")) & (F.col("p") < F.col("r"))),
    ).alias("reasons"))


# --- registered queries ---

_SPEC = """SELECT p_partkey AS case_id, CASE p_partkey % 4 WHEN 0 THEN 'E' WHEN 1 THEN 'M' WHEN 2 THEN 'H' ELSE 'X' END AS difficulty, CAST(p_size % 7 AS BIGINT) AS n_modifications, CAST(p_size * 16 AS DOUBLE) AS severity_ps, p_size * 0.2 + CASE WHEN p_partkey % 9 = 0 THEN 1 ELSE 0 END AS percent,
    greatest(10.0, p_size * 16 * 0.15) + CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END AS tolerance_ps, 'I' || CAST(p_partkey % 3 AS STRING) AS profile, p_partkey % 3 = 0 OR p_partkey % 13 = 0 AS inverse_allowed FROM part"""
query("spec_checks", f"""WITH s AS ({_SPEC}) SELECT case_id, concat_ws(',', CASE WHEN difficulty = 'X' THEN 'difficulty' END, CASE WHEN NOT (CASE difficulty WHEN 'E' THEN n_modifications BETWEEN 1 AND 2 WHEN 'M' THEN n_modifications BETWEEN 2 AND 4 WHEN 'H' THEN n_modifications BETWEEN 4 AND 6 ELSE false END) THEN 'modifications' END,
    CASE WHEN NOT (CASE difficulty WHEN 'E' THEN severity_ps > 39 AND severity_ps <= 160 WHEN 'M' THEN severity_ps > 160 AND severity_ps <= 400 WHEN 'H' THEN severity_ps > 400 AND severity_ps <= 640 ELSE false END) THEN 'severity' END, CASE WHEN case_id % 9 = 0 THEN 'percent' END,
    CASE WHEN case_id % 11 = 0 THEN 'tolerance' END, CASE WHEN (profile = 'I0') <> inverse_allowed THEN 'inverse' END) AS reasons FROM s""")(lambda t: spec_checks(t.spark.sql(_SPEC.replace("FROM part", "FROM {part}"), part=t.part)).withColumn("reasons", F.array_join("reasons", ",")))  # fmt: skip
query("distribution_check", "SELECT p_brand AS shape, p_type AS strategy, CAST(p_size % 3 AS STRING) AS difficulty, count(*) AS n, CAST(0 AS BIGINT) AS wanted FROM part WHERE p_partkey % 5 = 0 GROUP BY ALL HAVING count(*) <> 1 UNION ALL SELECT 'none', NULL, NULL, 0, 3")(
    lambda t: _distribution(t)
)


def _distribution(t) -> DataFrame:
    p = t.part.where("p_partkey % 5 = 0").select(F.col("p_brand").alias("shape"), F.col("p_type").alias("strategy"), (F.col("p_size") % 3).cast("string").alias("difficulty"))
    once = p.groupBy("shape", "strategy", "difficulty").agg(F.count("*").alias("n")).where("n = 1")
    # a cell that none may fill makes the list of cells a full one, also where no count is 1
    margin = t.spark.createDataFrame([("none", None, None, 3), ("none", "none", "none", 0)], "shape string, strategy string, difficulty string, n long")
    return distribution_check(p, once.unionByName(margin))


_SIDES = """j AS (SELECT DISTINCT o_orderkey AS case_id, l_linenumber AS instance, l_linenumber % 3 AS old_ref, l_linenumber % 3 + 1 AS new_ref FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber <= 3),
    p AS (SELECT DISTINCT o_orderkey AS case_id, l_linenumber + CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END AS instance, l_linenumber % 3 + CASE WHEN o_orderkey % 5 = 0 THEN 7 ELSE 1 END AS old_ref, l_linenumber % 3 AS new_ref FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber <= 3 AND o_orderkey % 17 <> 0)"""
query("inverse_policy", f"""WITH {_SIDES}, b AS (SELECT coalesce(j.case_id, p.case_id) AS case_id, count(j.instance) AS n_i, count(p.instance) AS n_r, count(CASE WHEN p.instance IS NULL THEN 1 END) AS only_i, count(CASE WHEN j.instance IS NULL THEN 1 END) AS only_r,
      count(CASE WHEN j.instance IS NOT NULL AND p.instance IS NOT NULL AND NOT (p.old_ref = j.new_ref AND p.new_ref = j.old_ref) THEN 1 END) AS odd FROM j FULL JOIN p ON j.case_id = p.case_id AND j.instance = p.instance GROUP BY 1),
    v AS (SELECT DISTINCT p.case_id FROM p JOIN j ON p.case_id = j.case_id AND p.old_ref = j.new_ref AND p.new_ref = j.old_ref),
    s AS (SELECT o_orderkey AS case_id, o_orderkey % 2 = 0 AS direct, CAST(2 AS BIGINT) AS k, b.* EXCLUDE (case_id), v.case_id IS NOT NULL AS turned FROM orders LEFT JOIN b ON b.case_id = o_orderkey LEFT JOIN v ON v.case_id = o_orderkey)
    SELECT case_id, concat_ws(',', CASE WHEN coalesce(n_i, 0) = 0 THEN 'no_injection' END, CASE WHEN coalesce(n_r, 0) = 0 THEN 'no_repair' END, CASE WHEN direct AND NOT coalesce(n_i = k, false) THEN 'count' END,
      CASE WHEN CASE WHEN direct THEN coalesce(only_i, 0) > 0 OR coalesce(only_r, 0) > 0 ELSE coalesce(only_i, 0) = 0 OR coalesce(only_r, 0) = 0 END THEN 'instances' END, CASE WHEN direct AND coalesce(odd, 0) > 0 THEN 'refs' END, CASE WHEN NOT direct AND turned THEN 'ref_inverse' END) AS reasons FROM s""")(lambda t: _inverse(t))  # fmt: skip


def _inverse(t) -> DataFrame:
    l = t.lineitem.where("l_linenumber <= 3").join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey").select(F.col("l_orderkey").alias("case_id"), F.col("l_linenumber").alias("n")).distinct()  # noqa: E741
    i = l.select("case_id", F.col("n").alias("instance"), (F.col("n") % 3).alias("old_ref"), (F.col("n") % 3 + 1).alias("new_ref"))
    k = lambda m, x: F.when(F.col("case_id") % m == x, 1).otherwise(0)
    r = l.where("case_id % 17 <> 0").select("case_id", (F.col("n") + k(4, 1)).alias("instance"), (F.col("n") % 3 + 1 + k(5, 0) * 6).alias("old_ref"), (F.col("n") % 3).alias("new_ref"))
    s = t.orders.select(F.col("o_orderkey").alias("case_id"), F.when(F.col("o_orderkey") % 2 == 0, "I0").otherwise("IA").alias("profile"), F.lit(2).cast("long").alias("n_modifications"))
    return inverse_policy(i, r, s).withColumn("reasons", F.array_join("reasons", ","))


query("check_markers", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'ERROR' WHEN o_orderkey % 2 = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
    CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE concat_ws(',', CASE WHEN o_orderkey % 11 = 0 THEN 'delay_type' END, CASE WHEN o_orderkey % 13 = 0 THEN 'paths_and_tns' END, CASE WHEN o_orderkey % 13 = 0 AND o_orderkey % 2 = 0 THEN 'verdict' END, CASE WHEN o_orderkey % 17 = 0 THEN 'version' END) END AS reasons FROM orders""")(
    lambda t: check_markers(t.orders.select(F.col("o_orderkey").alias("id"), _marker().alias("text")), "MARK_V1", "v7").select("id", "status", F.array_join("reasons", ",").alias("reasons"))
)


def _marker() -> Column:
    k = F.col("o_orderkey")
    fail = k % 2 == 1
    full = F.concat(
        F.lit("noise\nMARK_V1 status="), F.when(fail, "FAIL").otherwise("PASS"), F.lit(" mode=setup delay_type="), F.when(k % 11 == 0, "min").otherwise("max"), F.lit(" top=t wns_ns="), F.when(fail, "-0.5").otherwise("0.1"), F.lit(" tns_ns="),
        F.when(fail != (k % 13 == 0), "-0.5").otherwise("0.0"), F.lit(" violating_paths="), F.when(fail, "3").otherwise("0"), F.lit(" threshold_ns=0 parasitics_read=1 propagated_clocks=1 clock_count=2 tool_version="), F.when(k % 17 == 0, "v8").otherwise("v7"),
    )
    return F.when(k % 7 == 0, "MARK_V1 status=ERROR mode=unknown delay_type=none reason=licence").otherwise(full)


_SCRIPT = "count(*) AS n, count(CASE WHEN l_linenumber > 5 THEN 1 END) AS hidden"
query("fix_script_policy", f"SELECT l_orderkey AS script_id, n AS n_actions, concat_ws(',', CASE WHEN l_orderkey % 5 = 0 THEN 'unknown_command' END, CASE WHEN hidden > 0 THEN 'hidden_cell' END, CASE WHEN l_orderkey % 7 = 0 THEN 'inside_batch' END, CASE WHEN n > 4 THEN 'budget' END, CASE WHEN l_orderkey % 11 = 0 THEN 'placement' END, CASE WHEN l_orderkey % 13 = 0 AND l_orderkey % 11 <> 0 THEN 'order' END) AS reasons FROM (SELECT l_orderkey, {_SCRIPT} FROM lineitem GROUP BY l_orderkey)")(lambda t: _script(t))


def _script(t) -> DataFrame:
    k = F.col("script_id")
    acts = F.array_sort(F.collect_list(F.format_string("ecoChangeCell -inst {u/%d} -cell X%d", F.col("l_linenumber").cast("int"), (F.col("l_suppkey") % 9).cast("int"))))
    made = t.lineitem.groupBy(F.col("l_orderkey").alias("script_id")).agg(acts.alias("a"))
    place, route = F.when(k % 13 == 0, "ecoRoute -target").otherwise("refinePlace -eco true"), F.when(k % 13 == 0, "refinePlace -eco true").otherwise("ecoRoute -target")
    close = F.when(k % 7 == 0, F.concat(place, F.lit("\nsetEcoMode -batchMode false"))).otherwise(F.concat(F.lit("setEcoMode -batchMode false\n"), place))
    text = F.concat_ws("\n", F.lit("# fix"), F.lit("setEcoMode -batchMode true"), F.array_join("a", "\n"), close, F.when(k % 11 != 0, route), F.when(k % 5 == 0, "create_clock x"))
    cells = made.select("script_id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.concat(F.lit("u/"), i.cast("string")))).alias("instance"))
    return fix_script_policy(made.select("script_id", text.alias("text")), cells, made.select("script_id", F.lit(4).alias("budget"))).withColumn("reasons", F.array_join("reasons", ","))
