"""Refinements and repair sets against brute force over all choices."""

import random
from itertools import product

from millrace.operators import refine, search

OPS = "case_id string, op long, endpoint string, instance string, point_index long, level int, estimates array<double>, reachable boolean"


def random_cases(seed, n):
    rng = random.Random(seed)
    ops, slacks, specs = [], [], []
    for c in range(n):
        ends = [f"e{i}" for i in range(rng.randrange(1, 6))]
        slacks += [(f"c{c}", e, -rng.randrange(1, 60) / 128, True) for e in ends] + [(f"c{c}", "ok", 0.5, False)]
        specs.append((f"c{c}", -rng.randrange(1, 40) / 128, rng.choice([1 / 256, 1 / 16])))
        for op in range(rng.randrange(1, 7)):
            size = rng.randrange(1, 8)
            level = rng.randrange(size)
            for e in rng.sample(ends, rng.randrange(1, len(ends) + 1)):
                values = sorted(rng.randrange(0, 96) / 128 for _ in range(size))
                ops.append((f"c{c}", op, e, f"i{op}", rng.randrange(4), level, values, rng.random() < 0.8))
    return ops, slacks, specs


def brute(ops, slacks, specs, knobs, limit, levels):
    r12 = lambda x: round(x, 12) + 0.0
    out = {}
    for case, target, tol in specs:
        own = sorted(k for k in knobs if k[0] == case)
        low, high = target - tol, target + tol
        outside = lambda v: r12(max(low - v, v - high, 0.0))
        goal = {e: s for c, e, s, t in slacks if c == case and t}
        at = {(o, e): (seed, v) for c, o, e, _, _, seed, v, _ in ops if c == case}
        if not own:
            continue
        down = min(goal.values()) < low
        choices = []
        for _, e, op in own:
            seed, v = at[op, e]
            key = lambda x: (min((int(p >= 0), outside(p), r12(abs(p - target)), k) for k, s in enumerate((1, 2, 3, 4)) for p in [r12(goal[e] + (v[seed] - v[x]) / s)]), abs(x - seed), x)  # noqa: B023, E731
            choices.append((op, sorted(range(seed) if down else range(seed + 1, len(v)), key=key)[:levels]))
        choices.sort()
        scored = []
        for to in product(*(c for _, c in choices)):
            alternatives = []
            for k, s in enumerate((1, 2, 3, 4)):
                after = {e: r12(slack + sum(at[op, e][1][at[op, e][0]] - at[op, e][1][x] for (op, _), x in zip(choices, to) if (op, e) in at) / s) for e, slack in goal.items()}
                alternatives.append((sum(p >= 0 for p in after.values()), outside(min(after.values())), r12(abs(min(after.values()) - target)), k))
            seeds = [next(sd for (o, _), (sd, _) in at.items() if o == op) for op, _ in choices]
            scored.append((min(alternatives), sum(abs(x - sd) for x, sd in zip(to, seeds)), to))
        out[case] = [tuple(zip((op for op, _ in choices), to)) for _, _, to in sorted(scored)[:limit]]
    return {k: v for k, v in out.items() if v}


def frames(spark, ops, slacks, specs):
    return (
        spark.createDataFrame(ops, OPS), spark.createDataFrame(slacks, "case_id string, endpoint string, slack_ns double, target boolean"),
        spark.createDataFrame(specs, "case_id string, target_wns_ns double, tol_ns double"),
    )


def test_vectors_equal_brute_force_over_all_neighbours(spark):
    ops, slacks, specs = random_cases(7, 40)
    o, s, p = frames(spark, ops, slacks, specs)
    knobs = spark.createDataFrame(search.refinement_knobs(o, search.refinement_targets(s, p)).collect(), "case_id string, endpoint string, op long")
    for limit, levels in ((32, 4), (5, 2)):
        got = {}
        for r in refine.refinement_vectors(o, s, p, knobs, limit, levels).orderBy("case_id", "rank").collect():
            got.setdefault(r["case_id"], []).append(tuple((m["op"], m["level"]) for m in r["moves"]))
        assert got == brute(ops, slacks, specs, [tuple(k) for k in knobs.collect()], limit, levels) and len(got) > 10


def test_ties_nulls_and_broken_ladders(spark):
    ops = [("t", 1, "a", "i", 1, 2, [0.0, 0.25, 0.5], True), ("t", 2, "b", "j", 1, 2, [0.0, 0.25, 0.5], True), ("b", 1, "a", "i", 1, 5, [0.0, 0.5], True), ("n", 1, "a", "i", 1, 1, [None, 0.5], True), ("z", 1, "a", "i", 1, 1, [0.1, 0.5], True)]
    slacks = [("t", "a", -0.75, True), ("t", "b", -0.75, True), ("b", "a", -0.5, True), ("n", "a", -0.5, True), ("z", "a", None, True)]
    o, s, p = frames(spark, ops + ops[:1], slacks, [(c, -0.5, 0.0625) for c in "tbnz"] + [("absent", -0.5, 0.1)])
    got = [(r["case_id"], r["rank"], [tuple(m) for m in r["moves"]]) for r in refine.refinement_vectors(o, s, p).orderBy("case_id", "rank").collect()]
    assert [g[0] for g in got] == ["t"] * 4 and got[0] == ("t", 1, [(1, 1), (2, 1)])  # both a level down meet the window; ties by steps, then levels
    assert refine.refinement_vectors(o.where("false"), s, p).count() == 0


def brute_sets(cells, n, required, limit):
    """Every start on its own, cell by cell."""
    own = {c: (inj, set(e) & set(required), s or 0.0, d or 0.0) for c, inj, e, s, d in cells if set(e) & set(required)}
    place = sorted(own, key=lambda c: (-len(own[c][1]), -own[c][2], -own[c][3], c))
    weak = sorted((c for c in own if own[c][0]), key=lambda c: (own[c][2], own[c][3], c))[:2]
    seeds = [c for c in place if not own[c][0]][: max(2 * limit, n + limit)]
    sets = {}
    for out in weak:
        for seed in seeds:
            chosen = [seed]
            while len(chosen) < n:
                covered = set().union(*(own[c][1] for c in chosen))
                rest = [c for c in place if c not in chosen and c != out]
                if not rest:
                    break
                chosen.append(max(rest, key=lambda c: (len(own[c][1] - covered), -place.index(c))))
            if len(chosen) == n and set().union(*(own[c][1] for c in chosen)) == set(required):
                sets[tuple(sorted(chosen))] = sum(own[c][2] for c in chosen)
    return sorted(sets.items(), key=lambda x: (-x[1], x[0]))[:limit]


def test_repair_sets_equal_brute_force(spark):
    rng = random.Random(11)
    cells, cases, want = [], [], {}
    for c in range(40):
        ends = [f"e{i}" for i in range(rng.randrange(1, 5))]
        own = [(f"i{i:02d}", rng.random() < 0.5, rng.sample([*ends, "far"], rng.randrange(1, len(ends) + 2)), rng.choice([None, *(x / 8 for x in range(6))]), rng.randrange(3) / 4) for i in range(rng.randrange(2, 24))]
        n, limit = rng.randrange(1, 5), 6
        cells += [(f"c{c}", *x) for x in own]
        cases.append((f"c{c}", n, ends))
        if found := brute_sets(own, n, ends, limit):
            want[f"c{c}"] = found
    kinds = "case_id string, instance string, injected boolean, endpoints array<string>, strength double, delay_ns double"
    got = {}
    rows = refine.repair_alternatives(spark.createDataFrame(cells, kinds), spark.createDataFrame([*cases, ("none", 2, ["a"]), ("zero", 0, ["a"])], "case_id string, n int, endpoints array<string>")).orderBy("case_id", "rank").collect()
    for r in rows:
        got.setdefault(r["case_id"], []).append((tuple(r["instances"]), r["strength"]))
    assert got == want and len(want) > 15


def test_foreign_endpoints_cover_nothing(spark):
    cells = [("k", "i1", True, ["a"], 1.0, 0.1), ("k", "o1", False, ["a", "y", "z"], 3.0, 0.2), ("k", "o2", False, ["a"], 0.5, 0.2)]
    df = spark.createDataFrame(cells, "case_id string, instance string, injected boolean, endpoints array<string>, strength double, delay_ns double")
    assert refine.repair_alternatives(df, spark.createDataFrame([("k", 2, ["a", "b"])], "case_id string, n int, endpoints array<string>")).count() == 0
    (row,) = refine.repair_alternatives(df, spark.createDataFrame([("k", 2, ["a"])], "case_id string, n int, endpoints array<string>")).collect()
    assert row["instances"] == ["o1", "o2"]


def test_covers_take_no_python_call_per_case(spark):
    cells = [("k", i, i < "b", ["a"], 1.0, 1.0) for i in "abc"]
    df = spark.createDataFrame(cells, "case_id string, instance string, injected boolean, endpoints array<string>, strength double, delay_ns double")
    found = refine.repair_alternatives(df, spark.createDataFrame([("k", 1, ["a"])], "case_id string, n int, endpoints array<string>"))
    assert [(r["rank"], r["instances"]) for r in found.orderBy("rank").collect()] == [(0, ["b"]), (1, ["c"])]
    assert "FlatMapGroups" not in found._jdf.queryExecution().toString()
