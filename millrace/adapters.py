"""How the test tables play the roles of timing data; one SQL text per role for Spark and for the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from millrace.lineage import dealt, written

LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

#: role -> SQL over tables and other roles, each in braces
ROLES = {
    "paths": """SELECT CAST(year(o_orderdate) AS BIGINT) AS run_id, o_orderkey AS path_id, o_orderkey AS beginpoint, o_custkey AS endpoint,
        (CAST(round(o_totalprice * 100) AS BIGINT) - 5000000) / 1e8 AS slack_ns, o_orderpriority AS hierarchy_group, o_orderstatus AS analysis FROM {orders}""",
    "points": f"""SELECT l_orderkey AS path_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER}) AS BIGINT) AS point_index,
        CAST(l_partkey AS STRING) || '/' || CAST(l_suppkey AS STRING) AS instance, l_partkey AS ref, CAST(round(l_extendedprice * 100) AS BIGINT) / 1e8 AS delay_ns,
        CASE l_returnflag WHEN 'A' THEN 'cell' WHEN 'R' THEN 'net' ELSE 'other' END AS delay_kind, l_discount > 0.09 AS dont_touch, l_tax > 0.07 AS sequential, l_linenumber = 1 AS clock FROM {{lineitem}}""",
    "ladders": """SELECT a.p_partkey AS source_ref, CAST(a.p_size AS BIGINT) AS source_drive, b.p_partkey AS variant_ref, CAST(b.p_size AS BIGINT) AS variant_drive
        FROM {part} a JOIN {part} b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND floor((a.p_size - 1) / 10) = floor((b.p_size - 1) / 10) AND a.p_size <> b.p_size""",
    "members": """SELECT p_partkey AS ref, CAST(p_size AS BIGINT) AS drive, p_brand, p_type, floor((p_size - 1) / 10) AS span FROM {part}""",
    "reach": """SELECT DISTINCT p.instance, o.endpoint FROM {points} p JOIN {paths} o ON o.path_id = p.path_id""",
    "measured": """SELECT o.endpoint, p.instance, p.ref AS baseline_ref, CAST(p.ref % 97 AS BIGINT) AS new_ref, o.slack_ns + p.delay_ns / 4 AS measured_slack_ns, o.hierarchy_group,
        p.point_index AS evidence_level FROM {points} p JOIN {paths} o ON o.path_id = p.path_id WHERE p.point_index % 3 = 0""",
    "replay_1": """SELECT endpoint AS case_id, hierarchy_group AS endpoint, min(slack_ns) AS slack_ns FROM {paths} GROUP BY endpoint, hierarchy_group""",
    "replay_2": """SELECT case_id, endpoint, slack_ns + CASE WHEN case_id % 97 = 0 THEN 0.002 WHEN case_id % 5 = 0 THEN 0.0005 ELSE 0 END AS slack_ns FROM {replay_1} WHERE case_id % 101 <> 0""",
    "cells_before": """SELECT p_partkey AS instance, CAST(p_size AS BIGINT) AS ref FROM {part}""",
    "cells_after": """SELECT p_partkey AS instance, CAST(p_size + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS ref FROM {part} WHERE p_partkey % 211 <> 0
        UNION ALL SELECT -s_suppkey AS instance, CAST(1 AS BIGINT) AS ref FROM {supplier} WHERE s_suppkey % 50 = 0""",
    "drc_before": """SELECT o_orderpriority AS case_id, l_returnflag || l_linestatus AS category, count(*) AS n FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey WHERE l_quantity < 25 GROUP BY o_orderpriority, l_returnflag || l_linestatus""",
    "drc_after": """SELECT o_orderpriority AS case_id, l_returnflag || l_linestatus AS category, count(*) AS n FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey WHERE l_quantity >= 26 AND l_returnflag <> 'N' GROUP BY o_orderpriority, l_returnflag || l_linestatus""",
    "specs": """SELECT c_custkey AS case_id, c_mktsegment AS profile, c_acctbal AS nominal, CAST(c_nationkey AS BIGINT) AS target_count FROM {customer}""",
    "catalog": """SELECT p_partkey AS case_id, p_type AS shape, 'S' || CAST(p_partkey % 4 AS STRING) AS strategy, CASE WHEN p_size <= 15 THEN 'easy' WHEN p_size <= 35 THEN 'medium' ELSE 'hard' END AS difficulty, CAST(p_size AS BIGINT) AS target_count, p_retailprice AS severity_ps FROM {part}""",
    "state_events": """SELECT user_id AS case_id, event_id AS sequence, CASE event_type WHEN 'view' THEN 'planned' WHEN 'click' THEN 'running' WHEN 'add_to_cart' THEN 'measured' WHEN 'purchase' THEN 'accepted' ELSE 'failed' END AS state, ts FROM {events}""",
    "intervals": """SELECT o_orderkey AS id, o_orderpriority AS timing, o_orderkey * 2 AS first_rank, o_custkey % 5 + 1 AS n_ranks FROM {orders}""",
    "rank_intervals": """SELECT o_orderkey AS id, o_orderpriority AS timing, o_orderkey % 1000 AS first_rank, o_custkey % 5 + 1 AS n_ranks FROM {orders}""",
    "operations": """SELECT l_orderkey AS case_id, CASE WHEN l_linestatus = 'O' THEN 'injection' ELSE 'repair' END AS kind, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY LINE) AS BIGINT) AS seq,
        l_partkey AS instance, l_suppkey % 7 AS old_ref, CAST(l_linenumber % 7 AS BIGINT) AS new_ref FROM {lineitem}""".replace("LINE", LINE_ORDER),
    "trace": """SELECT user_id AS trace, event_id AS seq, CASE event_type WHEN 'view' THEN 'read_reg' WHEN 'click' THEN 'write_reg' WHEN 'purchase' THEN 'write_reg' ELSE 'wait' END AS op, user_id % 8 + event_id % 16 AS addr, CAST(round(value * 100) AS BIGINT) AS data FROM {events}""",
    "gate_replays": " UNION ALL ".join(f"""SELECT o_orderkey AS case_id, CAST({k} AS BIGINT) AS replay, CASE WHEN o_orderkey % 23 = 0 THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN o_orderkey % 29 = 0 THEN '8' ELSE '7' END AS tool_version, o_orderpriority AS fix_sha256,
        CASE WHEN o_orderkey % 31 <> 0 THEN o_orderstatus END AS checkpoint_sha256, o_orderkey % 37 = {k} AS hold_gated, o_orderkey % 41 <> 0 AS hold_recorded, o_orderkey % 43 <> 0 AS placement_legal, o_orderkey % 47 <> 0 AS equivalent, CAST(CASE WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END AS BIGINT) AS moved_by_resize,
        CAST(CASE WHEN o_orderkey % 59 = 0 THEN 1 ELSE 0 END AS BIGINT) AS moved_by_legalize, o_orderdate AS topology_before, CASE WHEN o_orderkey % 61 <> 0 THEN o_orderdate END AS topology_after, 'c' AS constraints_before, CASE WHEN o_orderkey % 67 = 0 THEN 'd' ELSE 'c' END AS constraints_after,
        5 AS max_fanout_before, CASE WHEN o_orderkey % 71 = 0 THEN 4 ELSE 5 END AS max_fanout_after, 3 AS max_transition_before, CASE WHEN o_orderkey % 73 = 0 THEN 4 ELSE 2 END AS max_transition_after, 3 AS max_capacitance_before, CASE WHEN o_orderkey % 79 = 0 THEN 4 ELSE 3 END AS max_capacitance_after,
        9 AS drc_before, CASE WHEN o_orderkey % 83 = 0 THEN 10 WHEN o_orderkey % 89 = 0 THEN NULL ELSE 9 END AS drc_after, 0 AS connectivity_before, CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END AS connectivity_after FROM {{orders}}""" for k in (1, 2)),
    "gate_specs": """SELECT o_orderkey AS case_id, '7' AS tool_version, o_orderpriority AS fix_sha256, o_orderstatus AS checkpoint_sha256, n_targets, n_protected, -0.022 AS nominal_ns, CASE WHEN o_orderkey % 19 = 0 THEN 0.0005 ELSE 0.002 END AS tolerance_ns
        FROM {orders} JOIN (SELECT l_orderkey, count(CASE WHEN l_linenumber <= 2 THEN 1 END) AS n_targets, count(CASE WHEN l_linenumber IN (3, 4) THEN 1 END) AS n_protected FROM {lineitem} GROUP BY l_orderkey) ON l_orderkey = o_orderkey WHERE o_orderkey % 103 <> 0""",
    "gate_endpoints": " UNION ALL ".join(f"""SELECT l_orderkey AS case_id, CAST({k} AS BIGINT) AS replay, l_linenumber AS endpoint, l_linenumber <= 2 AS target, l_linenumber IN (3, 4) OR (l_linenumber = 2 AND l_orderkey % 107 = 0) AS protected,
        CASE WHEN l_linenumber <= 2 OR l_orderkey % 109 = 0 THEN -(20 + l_suppkey % 5) / 1e3 ELSE 0.05 END AS before_ns, CASE WHEN l_orderkey % 113 = 0 THEN -0.001 ELSE l_quantity / 1e3 END AS resized_ns, CASE WHEN l_orderkey % 127 = {k} THEN NULL ELSE l_quantity / 1e3 END AS after_ns,
        l_quantity / 1e3 + CASE WHEN l_partkey % 50 = 0 THEN 0.002 ELSE 0.0005 END AS baseline_ns, 80.0 + l_linenumber AS cell_ns, CASE WHEN l_partkey % 60 = 0 THEN 60.0 ELSE 20.0 END AS net_ns, -(20 + l_suppkey % 5) / 1e3 + CASE WHEN l_partkey % 70 = 0 THEN 0.01 ELSE 0 END AS path_ns FROM {{lineitem}}""" for k in (1, 2)),
    "gate_operations": """SELECT l_orderkey AS case_id, l_linenumber AS instance, l_suppkey % 7 AS old_ref, l_suppkey % 7 + 1 AS new_ref FROM {lineitem} WHERE l_linenumber <= 3""",
    "gate_diffs": " UNION ALL ".join(f"""SELECT l_orderkey AS case_id, CAST({k} AS BIGINT) AS replay, l_linenumber AS instance, l_suppkey % 7 AS old_ref, l_suppkey % 7 + CASE WHEN l_partkey % 80 = 0 THEN 0 ELSE 1 END AS new_ref, l_partkey % 90 <> 0 AS equivalent
        FROM {{lineitem}} WHERE l_linenumber <= CASE WHEN l_orderkey % 131 = 0 THEN 4 WHEN l_orderkey % 137 = 0 THEN 1 ELSE 3 END""" for k in (1, 2)),
    "gate_sensitivity": " UNION ALL ".join(f"""SELECT l_orderkey AS case_id, CAST({k} AS BIGINT) AS replay, l_linenumber AS instance, e AS endpoint, CASE WHEN l_partkey % 100 = 0 THEN 0.0005 ELSE 0.002 END - e * 0.0001 AS gain_ns FROM {{lineitem}} CROSS JOIN (VALUES (1), (2)) v(e) WHERE l_linenumber <= 3 AND l_orderkey % 139 <> 0""" for k in (1, 2)),
}
#: tensor cells: vectors of 64 numbers as an 8 x 8 image with one channel per label
TENSOR_SPARK = """SELECT vec_id AS tensor_id, CAST(coalesce(label, 0) AS BIGINT) AS label, CAST(pos AS BIGINT) AS c, CAST(floor(pos / 8) AS BIGINT) AS y, CAST(pos % 8 AS BIGINT) AS x, CAST(round(e * 1024) AS BIGINT) AS v FROM (SELECT vec_id, label, posexplode(embedding) AS (pos, e) FROM {embeddings})"""
TENSOR_DUCK = """SELECT vec_id AS tensor_id, CAST(coalesce(label, 0) AS BIGINT) AS label, CAST(pos - 1 AS BIGINT) AS c, CAST((pos - 1) // 8 AS BIGINT) AS y, CAST((pos - 1) % 8 AS BIGINT) AS x, CAST(round(embedding[pos]::DOUBLE * 1024) AS BIGINT) AS v FROM (SELECT vec_id, label, embedding, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)"""


class Tables:
    """The tables of a data folder, and the roles made from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def keep(self, name: str) -> Tables:
        """Write the role ``name`` once for all that is made from it."""
        setattr(self, name, written(getattr(self, name)))
        return self

    def deal(self, name: str, key: str) -> Tables:
        """Deal the rows of table ``name`` out by ``key``, so many a task, for all that is made from it and grouped by that key."""
        if name not in vars(self):
            setattr(self, name, dealt(getattr(self, name), key))
        return self

    def __getattr__(self, name: str) -> DataFrame:
        if name == "cells":
            text = TENSOR_SPARK
        elif name in ROLES:
            text = ROLES[name]
        else:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.spark.sql(text, **{k: getattr(self, k) for k in set(re.findall(r"\{(\w+)\}", text))})


def sql(text: str) -> str:
    """Oracle SQL: each {role} in braces becomes a common table expression before the query."""
    order: list[str] = []

    def need(t: str) -> None:
        for name in re.findall(r"\{(\w+)\}", t):
            body = TENSOR_DUCK if name == "cells" else ROLES.get(name)
            if body is not None and name not in order:
                need(body)
                order.append(name)

    need(text)
    bare = lambda t: re.sub(r"\{(\w+)\}", r"\1", t)
    parts = [f"{n} AS ({bare(TENSOR_DUCK if n == 'cells' else ROLES[n])})" for n in order]
    body = bare(text).strip()
    if body.upper().startswith("WITH "):
        recursive = "RECURSIVE " if body.upper().startswith("WITH RECURSIVE") else ""
        body = re.sub(r"(?i)^WITH (RECURSIVE )?", "", body)
        return f"WITH {recursive}{', '.join([*parts, body])}"
    return f"WITH {', '.join(parts)} {body}" if parts else body
