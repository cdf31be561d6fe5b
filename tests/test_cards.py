"""Cards in the catalog's wording."""

from millrace.functions import cards

TEXT = """# 目录

#### CASE_7

- 元数据：`planned_unvalidated`；多 endpoint；策略 C；H；预计 5 个有效修改；候选层级 `pipeline`；3 个 endpoint；隐藏构造：IB；直接逆操作：不允许；guardrail 轴：max capacitance 风险。
- 场景：共享驱动 2% / 160 ps 与 6.5% / 520 ps。
- 安全解与检查：检查 pin cap。

#### CASE_8
- 元数据：`done`；圆；策略 E
- 场景：1% / 90 ps
"""


def test_cards(spark):
    rows = cards.case_cards(spark.createDataFrame([(1, TEXT), (2, None), (3, "no card"), (4, TEXT[:120].replace("\n", "\r\n"))], "k int, text string")).collect()
    by = {(r["k"], r["case_id"]): r for r in rows}
    assert set(by) == {(1, "CASE_7"), (1, "CASE_8"), (4, "CASE_7")}
    r = by[1, "CASE_7"]
    assert (r["shape"], r["strategy"], r["difficulty"], r["n_modifications"], r["hierarchy"], r["n_targets"], r["profile"], r["inverse_allowed"], r["guardrail"]) == ("multi_endpoint", "C", "H", 5, "pipeline", 3, "IB", False, "max_capacitance")
    assert (r["percent"], r["severity_ps"], r["tolerance_ps"], r["reasons"]) == (6.5, 520.0, 78.0, [])
    assert r["tags"] == ["capacitance_guardrail", "input_cap_tradeoff", "multi_endpoint", "shared_driver", "strategy_c"]
    assert by[1, "CASE_8"]["reasons"] == ["status", "shape", "strategy", "difficulty", "n_modifications", "hierarchy", "n_targets", "profile", "inverse_allowed", "severity"]
