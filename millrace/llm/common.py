"""Session helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of (at most) a few longs that may be broadcast once their count has been checked.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read the table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share for cut lineage.

    Reads ``spark.checkpoint.dir``; only where it is unset on a local master (as in tests) a temporary
    folder is made and set as the checkpoint folder. A cluster must name one.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found


def table_path(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that no plan reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder (to ``path`` if given) and read it back.

    Survives the loss of any executor, as the rows no longer depend on shuffle files.
    """
    spark = df.sparkSession
    path = path or table_path(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small ``df`` by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after counting that it has at most ``limit`` rows.

    ``df`` should be cheap to count (read from a written table); beyond the bound the join
    is left to a shuffle.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def later_of_equals(rows: DataFrame, key: str, order: str, hot: int = 1000) -> DataFrame:
    """Those ``rows`` (a written table, nothing null) beside which a row of equal ``key`` has a smaller ``order``; adds ``first``, the smallest.

    Keys of more than ``hot`` rows are at most rows / hot; they are joined by broadcast (where their count allows),
    so that no task gets all rows of such a key.
    """
    firsts = written(rows.groupBy(key).agg(F.min(order).alias("first"), F.count("*").alias("_n")).where("_n > 1"))
    many = small_side(firsts.where(F.col("_n") > hot).drop("_n"))
    few = firsts.where(F.col("_n") <= hot).drop("_n")
    rest = rows.join(many.select(key), key, "left_anti").join(few, key)
    return rows.join(many, key).unionByName(rest).where(F.col(order) > F.col("first"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` as rows (id, component_id = smallest id).

    Alternates the two star operations (hook every neighbour to the smallest one seen), which
    need a number of rounds in the order of the logarithm of the longest path. Every round is a
    few equi-joins and grouped minima, with the lineage cut in the shared folder; hubs are met by
    Spark's skew-join splitting. Null ends and loops are ignored; no edges give no rows.
    """
    now = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    now = checkpointed(now)
    mark = _fingerprint(now)
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (
            large.join(low, "b")
            .select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b").alias("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a < b")
            .distinct()
        )
        now, before = checkpointed(small), mark
        mark = _fingerprint(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("b").alias("id"), F.col("a").alias("component_id")).unionAll(now.select(F.col("a").alias("id"), F.col("a").alias("component_id")).distinct())


def with_row(docs: DataFrame, but: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text and beside them the row (all columns ``but`` some), so that no name of an extra column can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in but)).alias("row"))
