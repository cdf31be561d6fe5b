"""Scoring of candidate results, checks of diagnostics and probes, and the supervised dataset made of accepted cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import chat_assembly
from millrace.lineage import running
from millrace.registry import query

EPSILON = 1e-12


def locality_check(localities: DataFrame, slacks: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Reasons why a case's diagnostic of selected endpoints doesn't agree with their slacks: case_id, reasons.

    ``localities``: case_id, required, selected and violating (arrays), expected, n_selected, n_violating, wns, tns; ``slacks``: case_id, endpoint, slack_ns of the selected
    endpoints. Lists must be sorted and hold nothing twice. Where the direction is required, selected and violating endpoints are the same, as
    many as expected, and their slacks give WNS and TNS; elsewhere nothing is expected, selected or violating. Null lists count as broken.
    """
    got = slacks.groupBy("case_id").agg(
        F.array_sort(F.collect_list("endpoint")).alias("known"), F.array_sort(F.collect_list(F.when(F.col("slack_ns") < 0, F.col("endpoint")))).alias("negative"),
        F.min("slack_ns").alias("low"), F.sum("slack_ns").alias("sum"), F.count_if(F.col("slack_ns").isNull() | F.isnan("slack_ns")).alias("bad"),
    )
    both = localities.join(got, "case_id", "left")
    bare = lambda c: F.coalesce(F.col(c), F.array().cast(localities.schema["selected"].dataType))
    broken = lambda test: F.coalesce(test, F.lit(True))
    ordered = lambda c: broken(F.array_sort(F.array_distinct(F.col(c))) != F.col(c))
    off = lambda a, b: broken(F.abs(F.col(a) - F.col(b)) > tol)
    need = F.coalesce(F.col("required"), F.lit(False))
    reasons = F.array_compact(F.array(
        F.when(ordered("selected"), "selected_order"), F.when(ordered("violating"), "violating_order"), F.when(broken(bare("known") != F.col("selected")) | (F.coalesce("bad", F.lit(0)) > 0), "slack_coverage"),
        F.when(broken(bare("negative") != F.col("violating")), "violating_slacks"), F.when(broken(F.size("selected") != F.col("n_selected")), "selected_count"), F.when(broken(F.size("violating") != F.col("n_violating")), "violating_count"),
        F.when(need & broken((F.col("expected") < 1) | (F.col("selected") != F.col("violating")) | (F.size("selected") != F.col("expected"))), "coverage"), F.when(need & off("low", "wns"), "wns"), F.when(need & off("sum", "tns"), "tns"),
        F.when(~need & broken((F.col("expected") != 0) | (F.size("selected") > 0) | (F.size("violating") > 0)), "not_clean"),
    ))
    return both.select("case_id", reasons.alias("reasons"))


def summarize_probe(tables: dict[str, DataFrame], fields: dict[str, dict[str, str]], keys: dict[str, list[str]]) -> DataFrame:
    """Typed checks of a probe's tables of text: table, field, type, n_rows, n_bad, n_duplicate_keys, one row per checked field.

    ``fields``: table -> column -> SQL type that every value must cast to, or ``text`` for any value that is not empty; ``keys``: table -> columns that
    name a row. Each table is read twice at most: once for all its counts, once by key. A column that a table lacks is bad in every row.
    """
    out = None
    for name, wanted in fields.items():
        df = tables[name]
        ok = {c: F.lit(False) if c not in df.columns else F.length(F.trim(F.col(c).cast("string"))) > 0 if kind == "text" else F.col(c).cast("string").try_cast(kind).isNotNull() for c, kind in wanted.items()}
        counts = df.agg(F.count("*").alias("n"), *[F.count_if(~F.coalesce(v, F.lit(False))).alias(f"bad{i}") for i, v in enumerate(ok.values())])
        twice = df.groupBy(*keys[name]).agg((F.count("*") - 1).alias("k")).agg(F.coalesce(F.sum("k"), F.lit(0)).alias("twice"))
        rows = F.array(*[F.struct(F.lit(c).alias("field"), F.lit(kind).alias("type"), F.col(f"bad{i}").alias("n_bad")) for i, (c, kind) in enumerate(wanted.items())])
        # both sides are one row each
        one = counts.withColumn("_1", F.lit(1)).join(twice.withColumn("_1", F.lit(1)), "_1").select(F.lit(name).alias("table"), F.col("n").alias("n_rows"), F.col("twice").alias("n_duplicate_keys"), F.explode(rows).alias("r"))
        one = one.select("table", "r.field", "r.type", "n_rows", "r.n_bad", "n_duplicate_keys")
        out = one if out is None else out.unionByName(one)
    return out


def build_sft_dataset(cases: DataFrame, turns: DataFrame, verdicts: DataFrame, hidden: tuple[str, ...] = ()) -> DataFrame:
    """Examples of accepted cases, one canonical line each: conv_id, rank, line, sha256.

    ``cases``: conv_id, fingerprint; ``turns``: conv_id, turn, role, text, code; ``verdicts``: conv_id, accepted. Refused are cases without an accepted verdict, without a user turn or an assistant's last
    one, that show a word of ``hidden``, or whose fingerprint a smaller conv_id has. Lines are numbered by conv_id, whatever ids there are, through ranges that number their own. Null ids are refused; repeated cases count once.
    """
    word = F.lit(False) if not hidden else F.col("text").rlike("(?i)(" + "|".join(hidden) + ")")
    shape = turns.groupBy("conv_id").agg(F.bool_or(F.col("role") == "user").alias("asked"), (F.max_by("role", "turn") == "assistant").alias("answered"), F.bool_or(F.coalesce(word, F.lit(False))).alias("shown"))
    good = verdicts.groupBy("conv_id").agg(F.bool_and("accepted").alias("accepted")).where("accepted").join(shape.where("asked and answered and not shown"), "conv_id").select("conv_id")
    first = cases.join(good, "conv_id").groupBy("fingerprint").agg(F.min("conv_id").alias("conv_id")).select("conv_id")
    made = chat_assembly(turns.join(first, "conv_id", "left_semi")).select("conv_id", F.to_json(F.struct(F.col("conv_id").alias("id"), "messages")).alias("line"))
    placed = running(made, [], ["conv_id"], {"rank": "1"})  # numbered by ranges of conv_id
    return placed.select("conv_id", "rank", "line", F.sha2("line", 256).alias("sha256"))


# --- registered queries ---

def _locality(t) -> DataFrame:
    p = t.paths.where("slack_ns < 0").select(F.col("endpoint").alias("case_id"), F.col("path_id").alias("endpoint"), "slack_ns")
    ends = F.array_sort(F.collect_list("endpoint"))
    odd = lambda k: F.when(F.col("case_id") % k == 0, 1).otherwise(0)
    made = p.groupBy("case_id").agg(ends.alias("selected"), F.count("*").alias("n"), F.min("slack_ns").alias("wns"), F.sum("slack_ns").alias("tns")).select(
        "case_id", (F.col("case_id") % 5 != 0).alias("required"), "selected", F.when(F.col("case_id") % 7 == 0, F.reverse("selected")).otherwise(F.col("selected")).alias("violating"), (F.col("n") + odd(11)).alias("expected"), F.col("n").alias("n_selected"),
        (F.col("n") + odd(13)).alias("n_violating"), (F.col("wns") + odd(3) * 0.001).alias("wns"), "tns",
    )
    return locality_check(made, p).withColumn("reasons", F.array_join("reasons", ","))


query("locality_check", "WITH c AS (SELECT endpoint AS case_id, count(*) AS n FROM {paths} WHERE slack_ns < 0 GROUP BY endpoint) SELECT case_id, concat_ws(',', CASE WHEN case_id % 7 = 0 AND n > 1 THEN 'violating_order,violating_slacks' END, CASE WHEN case_id % 13 = 0 THEN 'violating_count' END, CASE WHEN case_id % 5 <> 0 AND (case_id % 11 = 0 OR (case_id % 7 = 0 AND n > 1)) THEN 'coverage' END, CASE WHEN case_id % 5 <> 0 AND case_id % 3 = 0 THEN 'wns' END, CASE WHEN case_id % 5 = 0 THEN 'not_clean' END) AS reasons FROM c")(_locality)
query("summarize_probe", "SELECT 'paths' AS \"table\", f.field, f.type, (SELECT count(*) FROM orders) AS n_rows, CASE f.field WHEN 'slack' THEN (SELECT count(*) FROM orders WHERE o_orderkey % 9 = 0) WHEN 'missing' THEN (SELECT count(*) FROM orders) ELSE 0 END AS n_bad, (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS n_duplicate_keys FROM (VALUES ('id', 'long'), ('slack', 'double'), ('missing', 'text')) f(field, type) UNION ALL SELECT 'points', f.field, f.type, (SELECT count(*) FROM lineitem), CASE f.field WHEN 'flag' THEN (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') ELSE 0 END, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM (VALUES ('line', 'int'), ('flag', 'text')) f(field, type)")(
    lambda t: summarize_probe(
        {
            "paths": t.orders.select(F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 9 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("slack")),
            "points": t.lineitem.select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").cast("string").alias("line"), F.when(F.col("l_returnflag") == "R", " ").otherwise(F.col("l_returnflag")).alias("flag")),
        },
        {"paths": {"id": "long", "slack": "double", "missing": "text"}, "points": {"line": "int", "flag": "text"}}, {"paths": ["id"], "points": ["id", "line"]},
    )
)
query("build_sft_dataset", """WITH s AS (SELECT conv_id, bool_or(role = 'user') AS asked, arg_max(role, turn) = 'assistant' AS answered, bool_or(regexp_matches(text, '(?i)(secret|idiot)')) AS shown FROM conversations GROUP BY conv_id),
    g AS (SELECT min(conv_id) AS conv_id FROM s WHERE asked AND answered AND NOT shown AND conv_id % 6 <> 0 GROUP BY conv_id // 2),
    l AS (SELECT conv_id, '{"id":' || conv_id || ',"messages":[' || string_agg('{"role":' || CAST(to_json(role) AS VARCHAR) || ',"content":' || CAST(to_json(text) AS VARCHAR) || '}', ',' ORDER BY turn) || ']}' AS line FROM conversations WHERE conv_id IN (SELECT conv_id FROM g) GROUP BY conv_id)
    SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS rank, line, sha256(line) AS sha256 FROM l""")(
    lambda t: build_sft_dataset(
        t.conversations.select("conv_id").distinct().withColumn("fingerprint", F.floor(F.col("conv_id") / 2)), t.conversations.withColumn("code", F.lit(None).cast("string")),
        t.conversations.select("conv_id", (F.col("conv_id") % 6 != 0).alias("accepted")), ("secret", "idiot"),
    )
)
