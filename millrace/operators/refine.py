"""Refinements around a measured seed, and repair sets by cover: bounded choices made by DataFrame functions.

A case's choices are few (knobs and levels are bounded by parameters), so that their product is exploded inside a row; endpoints, of which a case
may have any number, stay rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.lineage import written
from millrace.operators.search import _estimates, _slacks, _specs, refinement_knobs, refinement_targets
from millrace.registry import query

#: How much slower than estimated a cell may turn out, in order of trust.
SCALES = (1.0, 2.0, 3.0, 4.0)
#: Numbers that are compared are rounded to so many places, so that the order of a sum decides nothing.
PLACES = 12


def _outside(value: Column) -> Column:
    """How far a slack lies outside the case's window [low, high]."""
    return F.round(F.greatest(F.col("low") - value, value - F.col("high"), F.lit(0.0)), PLACES)


def _closeness(n_met: Column, slack: Column, rank: int) -> Column:
    """What is compared first: endpoints that are no longer negative, then distance to the window and to its middle."""
    return F.struct(n_met.cast("long").alias("n_met"), _outside(slack).alias("outside"), F.round(F.abs(slack - F.col("target_wns_ns")), PLACES).alias("off"), F.lit(rank).alias("scale"))


def refinement_vectors(operations: DataFrame, slacks: DataFrame, specs: DataFrame, knobs: DataFrame | None = None, limit: int = 32, levels: int = 4) -> DataFrame:
    """Neighbours of a measured seed for fresh trials: case_id, rank, moves (op, level; by op), n_met, outside, moved; the best ``limit`` of each case.

    ``operations``, ``slacks``, ``specs`` and ``knobs`` are those of ``refinement_knobs``, whose result is taken if none is given (at most four knobs a case). Each knob
    may move along its ladder in the direction that its endpoint needs, to the ``levels`` levels that bring this endpoint nearest (best of the SCALES; then fewer steps, lower levels).
    All combinations are ranked by what they predict for the case's target endpoints under the best scale: fewest that are no longer negative, distance of the
    worst one to the window, to its middle; then by steps moved in all, and by the levels in order of the ops. Every other operation stays at its seed.

    Cases that need no refinement, or have a null slack among their targets, give no row; nor does a case one of whose operations has no estimate at its seed level, or one of whose
    knobs cannot move. Levels without an estimate are no choice. Repeated rows count once.
    """
    targets = refinement_targets(slacks, specs)
    if knobs is None:
        knobs = refinement_knobs(operations, targets)
    ops = operations.select("case_id", "op", "endpoint", F.col("level").alias("seed"), "estimates").distinct()
    broken = ops.where(F.get("estimates", F.col("seed")).isNull()).select("case_id").distinct()
    case = specs.select("case_id", "target_wns_ns", (F.col("target_wns_ns") - F.col("tol_ns")).alias("low"), (F.col("target_wns_ns") + F.col("tol_ns")).alias("high"))
    case = case.join(targets.select("case_id", "direction").distinct(), "case_id").join(broken, "case_id", "left_anti")
    goal = slacks.where("target").select("case_id", "endpoint", "slack_ns").distinct()
    ops = written(ops.join(case.select("case_id"), "case_id", "left_semi"))

    # the levels of each knob that bring its own endpoint nearest
    one = knobs.select("case_id", "op", "endpoint").join(ops, ["case_id", "op", "endpoint"]).join(goal, ["case_id", "endpoint"]).join(case, "case_id")
    ahead = F.filter(F.sequence(F.lit(0), F.size("estimates") - 1), lambda i: F.when(F.col("direction") < 0, i < F.col("seed")).otherwise(i > F.col("seed")))
    one = one.withColumn("level", F.explode_outer(ahead)).withColumn("gain", F.get("estimates", F.col("seed")) - F.get("estimates", F.col("level")))
    at = lambda scale: F.round(F.col("slack_ns") + F.col("gain") / scale, PLACES)
    near = F.array_min(F.array(*[_closeness(at(s) >= 0, at(s), k) for k, s in enumerate(SCALES)]))
    order = Window.partitionBy("case_id", "op").orderBy(F.col("gain").isNull(), near, F.abs(F.col("level") - F.col("seed")), "level")
    best = one.withColumn("place", F.row_number().over(order)).where(F.col("place") <= levels)
    choices = best.groupBy("case_id", "op", "seed").agg(F.array_sort(F.collect_list(F.when(F.col("gain").isNotNull(), F.col("level")))).alias("levels"))
    per = choices.groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("op", "seed", "levels"))).alias("knobs")).where(F.forall("knobs", lambda k: F.size(k["levels"]) > 0))
    none = F.array(F.filter(F.transform("knobs", lambda k: F.struct(k["op"], k["seed"], F.lit(0).alias("level"))), lambda k: F.lit(False)))
    longer = lambda made, k: F.flatten(F.transform(made, lambda v: F.transform(k["levels"], lambda x: F.array_append(v, F.struct(k["op"], k["seed"], x.alias("level"))))))
    vectors = written(per.select("case_id", F.posexplode(F.aggregate("knobs", none, longer)).alias("vector", "moves")))

    # what each does to the endpoints that its ops touch; all other targets keep their slack
    touched = ops.join(per.select("case_id", F.explode("knobs.op").alias("op")), ["case_id", "op"])
    gains = vectors.select("case_id", "vector", F.explode("moves").alias("m")).select("case_id", "vector", "m.op", "m.level").join(touched, ["case_id", "op"]).join(goal, ["case_id", "endpoint"])
    gains = gains.withColumn("gain", F.get("estimates", F.col("seed")) - F.get("estimates", F.col("level")))
    moved = gains.groupBy("case_id", "vector", "endpoint").agg(F.first("slack_ns").alias("slack_ns"), F.sum("gain").alias("gain"))
    still = goal.join(touched.select("case_id", "endpoint").distinct(), ["case_id", "endpoint"], "left_anti")
    still = still.groupBy("case_id").agg(F.min("slack_ns").alias("still_ns"), F.count(F.when(F.col("slack_ns") >= 0, 1)).alias("still_met"))
    sums = [x for k, s in enumerate(SCALES) for x in (F.count(F.when(at(s) >= 0, 1)).alias(f"met{k}"), F.min(at(s)).alias(f"wns{k}"))]
    scored = vectors.join(moved.groupBy("case_id", "vector").agg(*sums), ["case_id", "vector"]).join(case, "case_id").join(still, "case_id", "left")
    alternatives = [_closeness(F.col(f"met{k}") + F.coalesce("still_met", F.lit(0)), F.round(F.least(f"wns{k}", "still_ns"), PLACES), k) for k in range(len(SCALES))]
    steps = F.aggregate("moves", F.lit(0), lambda acc, m: acc + F.abs(m["level"] - m["seed"]))
    scored = scored.withColumns({"best": F.array_min(F.array(*alternatives)), "moved": steps, "to": F.transform("moves", lambda m: m["level"])})
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("case_id").orderBy("best", "moved", "to"))).where(F.col("rank") <= limit)
    return ranked.select("case_id", "rank", F.transform("moves", lambda m: F.struct(m["op"], m["level"])).alias("moves"), "best.n_met", "best.outside", "moved")


def _covers(limit: int):
    """Greedy covers of one case from all starts together: rows are starts, columns are cells or endpoints."""

    def best(n: int, need: np.ndarray, names: np.ndarray, ends: np.ndarray, weak: np.ndarray, seed: np.ndarray, strength: np.ndarray) -> list[tuple[tuple, float]]:
        at = {e: i for i, e in enumerate(need)}
        touches = np.zeros((len(names), len(need)), bool)
        for i, own in enumerate(ends):
            touches[i, [at[e] for e in own]] = True
        left_out, seeds = np.nonzero(weak)[0], np.nonzero(seed)[0]
        starts = np.array([(w, s) for w in left_out for s in seeds], np.int64).reshape(-1, 2)
        row = np.arange(len(starts))
        taken = np.zeros((len(starts), len(names)), bool)
        taken[row, starts[:, 1]] = True
        closed = taken.copy()
        closed[row, starts[:, 0]] = True
        covered = touches[starts[:, 1]]
        for _ in range(n - 1):  # the most endpoints gained, then the earliest place
            worth = (~covered).astype(np.int64) @ touches.T * len(names) - np.arange(len(names))
            worth[closed] = np.iinfo(np.int64).min
            best = worth.argmax(axis=1)
            able = ~closed[row, best]
            taken[row[able], best[able]] = True
            closed[row[able], best[able]] = True
            covered |= touches[best] & able[:, None]
        fine = covered.all(axis=1) & (taken.sum(axis=1) == n)
        sets = {tuple(sorted(names[t])): round(float(strength[t].sum()), PLACES) for t in taken[fine]}
        return sorted(sets.items(), key=lambda x: (-x[1], x[0]))[:limit]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(case, k, list(i), s) for case, *rest in pdf.itertuples(index=False) for k, (i, s) in enumerate(best(*rest))]
            yield pd.DataFrame(rows, columns=["case_id", "rank", "instances", "strength"])

    return run


def repair_alternatives(cells: DataFrame, cases: DataFrame, limit: int = 6) -> DataFrame:
    """Repair sets of exactly ``n`` cells that cover all ``endpoints`` of a case: case_id, rank, instances (sorted), strength.

    ``cells``: case_id, instance (once a case), injected, endpoints (those it speeds up), strength (summed best estimate), delay_ns; ``cases``: case_id, n, endpoints. Only the
    case's own endpoints count. Cells are placed by how many they speed up, then strength, delay and instance. Each set leaves out one of the two weakest injected cells, starts from one of the first
    max(2 * limit, n + limit) cells that were not injected, and takes the cell of most new endpoints (then the first place) until it has ``n``. Distinct sets are ranked by strength, then
    instances. Null strengths and delays are 0; cases without endpoints, injected or other cells, or a covering set, have no rows.

    Cells of a case that speed up the same endpoints replace each other in order of place, so that of each such class only as many as a set can take reach the choice.
    """
    case = cases.where((F.col("n") > 0) & (F.size("endpoints") > 0)).select("case_id", "n", F.array_distinct("endpoints").alias("required"))
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
    own = cells.join(case, "case_id").select("case_id", "n", "required", "instance", "injected", F.array_sort(F.array_intersect("endpoints", "required")).alias("endpoints"), zero("strength"), zero("delay_ns")).where(F.size("endpoints") > 0)
    by_place = [F.desc(F.size("endpoints")), F.desc("strength"), F.desc("delay_ns"), "instance"]
    window = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*by_place))
    weakest = F.row_number().over(Window.partitionBy("case_id", "injected").orderBy("strength", "delay_ns", "instance"))
    most = F.greatest(F.lit(2 * limit), F.col("n") + limit)
    own = own.withColumns({"weak": F.col("injected") & (weakest <= 2), "seed": ~F.col("injected") & (window("case_id", "injected") <= most), "place": window("case_id"), "alike": window("case_id", "endpoints")})
    few = own.where(F.col("weak") | F.col("seed") | (F.col("alike") <= F.col("n") + 2)).drop("injected", "alike")
    kind = {f.name: f.dataType.simpleString() for f in few.schema.fields}
    cells = F.array_sort(F.collect_list(F.struct("place", "instance", "endpoints", "weak", "seed", "strength")))
    grouped = few.groupBy("case_id").agg(F.first("n").alias("n"), F.first("required").alias("required"), cells.alias("c")).where(F.exists("c", lambda x: x["weak"]) & F.exists("c", lambda x: x["seed"]))
    grouped = grouped.select("case_id", "n", "required", "c.instance", "c.endpoints", "c.weak", "c.seed", "c.strength")
    return grouped.mapInPandas(_covers(limit), f"case_id {kind['case_id']}, rank int, instances array<{kind['instance']}>, strength double")


# --- registered queries ---

query("refinement_vectors")(lambda t: refinement_vectors(_estimates(t), _slacks(t), _specs(t)))
query("repair_alternatives")(
    lambda t: repair_alternatives(
        _estimates(t).groupBy("case_id", "instance").agg(F.collect_set("endpoint").alias("endpoints"), F.sum(F.element_at("estimates", -1)).alias("strength"), F.max("point_index").cast("double").alias("delay_ns"))
        .withColumn("injected", F.pmod(F.xxhash64("instance"), F.lit(2)) == 0),
        t.paths.where("slack_ns < 0").groupBy(F.col("endpoint").alias("case_id")).agg(F.lit(3).alias("n"), F.collect_set("hierarchy_group").alias("endpoints")),
    )
)
