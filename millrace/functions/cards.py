"""Case cards of a catalog in its own wording, as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.registry import query

#: The catalog's words for shapes, guardrail axes and topology, and the labels of its fields.
SHAPES = {"单关键锥": "single_cone", "多 endpoint": "multi_endpoint", "Setup/DRV guardrail": "setup_drv_guardrail"}
GUARDRAILS = {"防止恶化非目标 setup endpoint": "protected_setup_endpoint", "max transition 风险": "max_transition", "max capacitance 风险": "max_capacitance"}
TAGS = {
    "capture_near": ("capture 近端", "capture 前", "末级", "末端"), "launch_near": ("launch 近端", "launch 后"), "reconvergence": ("reconverge", "reconvergence", "汇合"), "fork": ("分叉", "分支", "旁支", "旁路"),
    "shared_driver": ("共享驱动", "公共瓶颈", "共享高负载"), "slew_chain": ("slew-chain", "slew chain", "链首", "深链"), "high_load": ("高负载", "负载"), "input_cap_tradeoff": ("输入电容", "pin cap", "capacitance"),
    "transition_guardrail": ("max transition", "transition 限值"), "capacitance_guardrail": ("max capacitance", "capacitance 限值"), "protected_setup": ("非目标 endpoint", "非目标 setup", "非目标路径"), "multi_input_arc": ("多输入", "input pin", "慢输入"),
}
PLANNED, METADATA, SCENARIO, SOLUTION = "`planned_unvalidated`", "元数据", "场景", "安全解与检查"
STRATEGY, CHANGES, HIERARCHY, TARGETS = r"策略 ([A-D])", r"预计 ([1-6]) 个有效修改", r"候选层级 `(exp|pipeline|top_tree)`", r"(\d+) 个 ?(?:目标 )?endpoint"
PROFILE, INVERSE, GUARDRAIL, SEVERITY = r"隐藏构造：(I0|I[ABCD])", r"直接逆操作：(允许|不允许)", r"guardrail 轴：([^；。]+)", r"(\d+(?:\.\d+)?)%\s*/\s*(\d+) ps"
ALLOWED = "允许"


def case_cards(catalogs: DataFrame) -> DataFrame:
    """Cards of catalogs (with text) as case_id, shape, strategy, difficulty, n_modifications, hierarchy, n_targets, profile, inverse_allowed, guardrail, percent, severity_ps, tolerance_ps, tags, reasons.

    A card is a ``####`` heading with its three fields below. Its severity is the largest of its scenario, in per cent of an 8 ns clock and in ps. Reasons name the fields that are missing or no known word, and
    ``severity`` where per cent and ps differ. Texts without cards, and null ones, give no row.
    """
    blocks = F.slice(F.split(F.regexp_replace("text", "\r\n?", "\n"), r"(?m)^#### (?=\S)", -1), 2, 2_000_000_000)
    card = catalogs.select(*[c for c in catalogs.columns if c != "text"], F.explode(blocks).alias("b"))
    field = lambda name: F.regexp_extract("b", rf"(?m)^- {name}：(.+)$", 1)
    card = card.select(*[c for c in card.columns if c != "b"], F.trim(F.substring_index("b", "\n", 1)).alias("case_id"), field(METADATA).alias("m"), field(SCENARIO).alias("s"), field(SOLUTION).alias("a"))
    part = F.split(F.regexp_replace("m", "。$", ""), "；", -1)
    at = lambda i: F.get(part, F.lit(i))
    pick = lambda text, p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    whole = lambda i, p: pick(at(i), f"^{p}$")
    known = lambda words, value: F.create_map(*[F.lit(x) for kv in words.items() for x in kv])[value]
    guard = pick(F.col("m"), GUARDRAIL)
    every = F.arrays_zip(F.regexp_extract_all("s", F.lit(SEVERITY), F.lit(2)).alias("ps"), F.regexp_extract_all("s", F.lit(SEVERITY), F.lit(1)).alias("percent"))
    worst = F.array_max(F.transform(every, lambda x: F.struct(x["ps"].cast("double").alias("ps"), x["percent"].cast("double").alias("percent"))))
    card = card.select(
        *[c for c in card.columns if c not in ("m", "s", "a")], known(SHAPES, at(1)).alias("shape"), whole(2, STRATEGY).alias("strategy"), F.when(at(3).isin("E", "M", "H"), at(3)).alias("difficulty"), whole(4, CHANGES).cast("long").alias("n_modifications"),
        whole(5, HIERARCHY).alias("hierarchy"), whole(6, TARGETS).cast("long").alias("n_targets"), pick(F.col("m"), PROFILE).alias("profile"), (pick(F.col("m"), INVERSE) == ALLOWED).alias("inverse_allowed"),
        F.coalesce(known(GUARDRAILS, guard), guard, F.lit("none")).alias("guardrail"), worst.alias("worst"), F.lower(F.concat_ws(" ", "m", "s", "a")).alias("said"), (F.coalesce(at(0), F.lit("")) == PLANNED).alias("planned"),
    )
    tags = [F.when(_any(words), F.lit(tag)) for tag, words in TAGS.items()]
    ps, percent = F.col("worst.ps"), F.col("worst.percent")
    needed = ("shape", "strategy", "difficulty", "n_modifications", "hierarchy", "n_targets", "profile", "inverse_allowed")
    reasons = F.array_compact(F.array(F.when(~F.col("planned"), "status"), *[F.when(F.col(c).isNull(), c) for c in needed], F.when(~F.coalesce(F.abs(percent * 80 - ps) <= 0.001, F.lit(False)), "severity")))
    return card.select(
        *[c for c in card.columns if c not in ("worst", "said", "planned")], percent.alias("percent"), ps.alias("severity_ps"), F.greatest(F.lit(10.0), ps * 0.15).alias("tolerance_ps"),
        F.array_sort(F.array_distinct(F.array_compact(F.array("shape", F.concat(F.lit("strategy_"), F.lower("strategy")), *tags)))).alias("tags"), reasons.alias("reasons"),
    )


def _any(words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains("said", F.lit(w.lower()))
    return found


# --- registered queries ---


def _catalogs(t) -> DataFrame:
    """A catalog for each brand, with a card for each part."""
    k = F.col("p_partkey")
    shape = F.element_at(F.array(*map(F.lit, SHAPES)), (k % 3 + 1).cast("int"))
    letter = F.element_at(F.array(*map(F.lit, "ABCD")), (k % 4 + 1).cast("int"))
    meta = F.concat_ws(
        "；", F.lit(PLANNED), shape, F.concat(F.lit("策略 "), letter), F.when(k % 7 == 0, "Q").otherwise("M"), F.concat(F.lit("预计 "), (k % 6 + 1).cast("string"), F.lit(" 个有效修改")), F.lit("候选层级 `exp`"), F.concat(F.col("p_size").cast("string"), F.lit(" 个目标 endpoint")),
        F.concat(F.lit("隐藏构造：I"), F.when(k % 4 == 0, "0").otherwise(letter)), F.concat(F.lit("直接逆操作："), F.when(k % 4 == 0, "允许").otherwise("不允许")), F.when(k % 5 == 0, "guardrail 轴：max transition 风险"),
    )
    ps = F.col("p_size") * 80 + F.when(k % 11 == 0, 1).otherwise(0)
    card = F.concat(F.lit("#### C"), k.cast("string"), F.lit("\n\n- 元数据："), meta, F.lit("。\n- 场景：1% / 80 ps, "), F.col("p_size").cast("string"), F.lit("% / "), ps.cast("string"), F.lit(" ps。\n- 安全解与检查："), F.when(k % 2 == 0, "分叉").otherwise("-"), F.lit("\n"))
    return t.part.groupBy("p_brand").agg(F.concat(F.lit("# catalog\n"), F.array_join(F.array_sort(F.collect_list(card)), "\n")).alias("text"))


query("case_cards", """SELECT p_brand, 'C' || p_partkey AS case_id, CASE p_partkey % 3 WHEN 0 THEN 'single_cone' WHEN 1 THEN 'multi_endpoint' ELSE 'setup_drv_guardrail' END AS shape, substr('ABCD', CAST(p_partkey % 4 + 1 AS INTEGER), 1) AS strategy, p_partkey % 6 + 1 AS n_modifications, CAST(p_size AS BIGINT) AS n_targets,
    'I' || CASE WHEN p_partkey % 4 = 0 THEN '0' ELSE substr('ABCD', CAST(p_partkey % 4 + 1 AS INTEGER), 1) END AS profile, p_partkey % 4 = 0 AS inverse_allowed, CASE WHEN p_partkey % 5 = 0 THEN 'max_transition' ELSE 'none' END AS guardrail,
    CAST(greatest(p_size * 80 + CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END, 80) AS DOUBLE) AS severity_ps, p_partkey % 2 = 0 AS forked, concat_ws(',', CASE WHEN p_partkey % 7 = 0 THEN 'difficulty' END, CASE WHEN p_partkey % 11 = 0 THEN 'severity' END) AS reasons FROM part""")(
    lambda t: case_cards(_catalogs(t)).select("p_brand", "case_id", "shape", "strategy", "n_modifications", "n_targets", "profile", "inverse_allowed", "guardrail", "severity_ps", F.array_contains("tags", "fork").alias("forked"), F.array_join("reasons", ",").alias("reasons"))
)
