"""Registries that only grow, kept in tables bucketed by operation key, so that they are never shuffled; sketches kept for each shard."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.lineage import new_path
from millrace.registry import query

#: Buckets of a registry; a bucket holds rows / BUCKETS and is read by one task, so choose it for the size that is expected.
BUCKETS = 64


def _bucketed(df: DataFrame, table: str, key: list[str], buckets: int) -> None:
    """Write ``df`` to a table bucketed by ``key``; a new one lies in the shared folder."""
    writer = df.write.bucketBy(buckets, *key).sortBy(*key).mode("append")
    spark = df.sparkSession
    (writer if spark.catalog.tableExists(table) else writer.option("path", new_path(spark, "registry"))).saveAsTable(table)


def append_measured(measured: DataFrame, table: str, key: list[str], buckets: int = BUCKETS) -> None:
    """Add measurements to the registry ``table``, which is made if it isn't there; each load writes its own files of every bucket."""
    _bucketed(measured.repartition(buckets, *key), table, key, buckets)


def unmeasured_in(candidates: DataFrame, table: str, key: list[str]) -> DataFrame:
    """Candidates whose key the registry doesn't hold; only they are shuffled, to its buckets. A null in a key matches nothing, so such candidates stay."""
    known = candidates.sparkSession.table(table).select(*key)
    return candidates.hint("merge").join(known, key, "left_anti")


def upsert_registry(spark: SparkSession, table: str, changes: DataFrame, key: list[str], order: str, into: str, buckets: int = BUCKETS) -> None:
    """Write the next version ``into`` of the registry ``table``: the latest row of each key by ``order``; changes win ties, and of theirs the one that is greatest over all columns.

    The registry is read by its buckets and only the changes are shuffled. Rows with a null in the key are kept as they are, those of ``table`` and of ``changes``; a null order is the oldest.
    """
    columns = spark.table(table).columns
    whole = F.struct(F.col(order).isNotNull().alias("_known"), F.col(order).alias("_order"), *[F.col(c) for c in sorted(columns)])
    latest = changes.where(" and ".join(f"`{c}` is not null" for c in key)).groupBy(*key).agg(F.max(whole).alias("_new"))
    base = spark.table(table).select(*key, F.struct(*columns).alias("_old"))
    both = base.hint("merge").join(latest, key, "full_outer")
    newer = F.col("_old").isNull() | (F.col("_new").isNotNull() & F.coalesce((F.col("_new._order") >= F.col(f"_old.{order}")), F.col(f"_old.{order}").isNull()))
    pick = both.select(*[F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in columns])
    odd = changes.where(" or ".join(f"`{c}` is null" for c in key)).select(*columns)
    _bucketed(pick.unionByName(odd), into, key, buckets)


def measurement_sketches(measured: DataFrame, by: list[str], shard: list[str], operation: list[str]) -> DataFrame:
    """One row for each ``by`` and shard that later loads need not read again: n_rows, and sketches of the distinct operations and of the measured slacks (null slacks left out)."""
    key = F.xxhash64(*operation)
    return measured.groupBy(*by, *shard).agg(
        F.count("*").alias("n_rows"), F.hll_sketch_agg(key, F.lit(14)).alias("operations"), F.kll_sketch_agg_double(F.col("measured_slack_ns").cast("double"), F.lit(400)).alias("slacks"),
    )


def merge_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of any number of shards and loads merged: n_rows (exact), n_operations (within 2 %, in most groups 1 %), and the median, first and ninth decile of slack (rank within 1 %; null without a slack)."""
    merged = sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("operations")).alias("n_operations"), F.kll_merge_agg_double("slacks").alias("s"))
    known = F.coalesce(F.kll_sketch_get_n_double("s"), F.lit(0)) > 0
    at = lambda q: F.when(known, F.kll_sketch_get_quantile_double("s", F.lit(q)))
    return merged.select(*by, "n_rows", "n_operations", at(0.1).alias("p10_ns"), at(0.5).alias("median_ns"), at(0.9).alias("p90_ns"))


# --- registered queries ---

KEY = ["endpoint", "instance", "new_ref"]


def _name() -> str:
    return f"registry_{uuid.uuid4().hex}"


def _unmeasured(t) -> DataFrame:
    """Two loads of the registry, then the candidates that neither holds."""
    table, t = _name(), t.keep("points")
    for load in (0, 1):
        append_measured(t.measured.where(F.col("new_ref") % 2 == load).select(*KEY, "measured_slack_ns"), table, KEY)
    both = t.paths.join(t.points, "path_id").select("endpoint", "instance", (F.col("ref") % 97).alias("new_ref"), "path_id", "point_index")
    return unmeasured_in(both, table, KEY)


query("unmeasured_registry", "WITH c AS (SELECT o.endpoint, p.instance, p.ref % 97 AS new_ref, p.path_id, p.point_index FROM {points} p JOIN {paths} o ON o.path_id = p.path_id) SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM {measured} m WHERE m.endpoint = c.endpoint AND m.instance = c.instance AND m.new_ref = c.new_ref)")(_unmeasured)


def _upserted(t) -> DataFrame:
    names = [_name() for _ in range(3)]
    rows = t.events.select("user_id", "event_type", "value", "event_id")
    first = rows.where("event_id % 3 = 0").groupBy("user_id", "event_type").agg(F.max_by(F.struct("value", "event_id"), "event_id").alias("s")).select("user_id", "event_type", "s.*")
    append_measured(first, names[0], ["user_id", "event_type"])
    for k in (1, 2):
        upsert_registry(t.spark, names[k - 1], rows.where(F.col("event_id") % 3 == k), ["user_id", "event_type"], "event_id", names[k])
    return t.spark.table(names[2])


query("upsert_registry", "SELECT user_id, event_type, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id, event_type")(_upserted)


def _near(t) -> DataFrame:
    """Merged sketches of twelve shards against exact figures: are they within their bounds?"""
    m = t.measured.withColumn("shard", F.pmod(F.xxhash64("endpoint"), F.lit(12)))
    got = merge_sketches(measurement_sketches(m, ["hierarchy_group"], ["shard"], KEY), ["hierarchy_group"])
    n = m.groupBy("hierarchy_group").agg(F.count_distinct(*KEY).alias("exact"))
    below = lambda c: F.count_if(F.col("measured_slack_ns") <= F.col(c)) / F.count("*")
    ranks = m.join(F.broadcast(got), "hierarchy_group").groupBy("hierarchy_group").agg(*[below(c).alias(c) for c in ("p10_ns", "median_ns", "p90_ns")])  # a row for each group
    near = lambda c, q: F.abs(F.col(f"r.{c}") - q) < 0.015
    both = got.alias("g").join(n, "hierarchy_group").join(ranks.alias("r"), "hierarchy_group")
    return both.select("hierarchy_group", "g.n_rows", (F.abs(F.col("n_operations") / F.col("exact") - 1) < 0.02).alias("distinct_near"), (near("p10_ns", 0.1) & near("median_ns", 0.5) & near("p90_ns", 0.9)).alias("ranks_near"))


query("measurement_sketches", "SELECT hierarchy_group, count(*) AS n_rows, true AS distinct_near, true AS ranks_near FROM {measured} GROUP BY hierarchy_group")(_near)
