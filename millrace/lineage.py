"""Written tables that cut lineage, broadcasts behind a count, and numbering by ranges."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that a counted side may have to be broadcast.
BROADCAST_ROWS = 1_000_000
#: Rows that a task takes of a table that is dealt out.
DEALT_ROWS = 200_000
#: Values and rows that a packed array has at most, the values of a slice, which one array of rows meets at once, and pairs of one key that are left together.
PACKED_VALUES, PACKED_ROWS, SLICE_VALUES, KEY_PAIRS = 1024, 32, 8192, 50_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share; a local master without one gets a temporary folder."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def new_path(spark: SparkSession, kind: str = "table") -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that later jobs survive lost executors and don't repeat it."""
    path = new_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows; else the join is left to a shuffle. ``df`` should be cheap to count."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def dealt(df: DataFrame, *key: str, rows: int = DEALT_ROWS, n: int | None = None) -> DataFrame:
    """``df`` dealt out by ``key``, about ``rows`` of its ``n`` rows a task, so that a task's share doesn't grow with the table; never fewer tasks than a shuffle has. Without ``n`` it is counted, which should be cheap."""
    parts = -(-(df.count() if n is None else n) // rows)
    return df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *key)


def packed(df: DataFrame, by: list[str], value: str, most: int | None = None) -> DataFrame:
    """``by``, ``_block`` and ``_values``: the values of each ``by`` in order, nulls first, in arrays of ``most`` (PACKED_VALUES) at most."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(value))
    blocks = df.select(*by, value, F.floor((place - 1) / (most or PACKED_VALUES)).alias("_block")).groupBy(*by, "_block")
    return blocks.agg(F.transform(F.sort_array(F.collect_list(F.struct(value))), lambda x: x[value]).alias("_values"))


def packed_rows(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """``by`` and ``_rows``: arrays of PACKED_ROWS values at most, without an order among them; a large ``by`` is packed by several tasks."""
    shares = packed(df.withColumn("_by", F.pmod(F.xxhash64(value), F.lit(16))), [*by, "_by"], value, PACKED_ROWS)
    return shares.select(*by, F.col("_values").alias("_rows"))


def block_join(rows: DataFrame, blocks: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` joined with ``blocks``, which have arrays ``_values``, for results as large as all pairs of a key: the arrays are shuffled and not the pairs, which the caller explodes.

    ``rows`` may be packed too (``_rows``): if these are exploded before ``_values``, the same values are told for each of them in turn, which Parquet stores in little room. Blocks of a key lie in slices of about SLICE_VALUES values, so that a row (or array of them) meets no more at once, and goes to each slice. Rows of a key that would make more than KEY_PAIRS pairs in a slice are spread,
    and the slice is copied to each share. So one hot key takes many tasks, whose number follows the pairs. Both sides are read twice and should be written tables, or cheap.
    """
    size, own = F.size("_values"), F.size("_rows") if "_rows" in rows.columns else F.lit(1)
    before = F.sum(size).over(Window.partitionBy(*on).orderBy(*[c for c in blocks.columns if c not in on]).rowsBetween(Window.unboundedPreceding, -1))
    blocks = written(blocks.withColumn("_slice", F.coalesce(F.floor(before / SLICE_VALUES), F.lit(0))))
    keys = blocks.groupBy(*on).agg((F.max("_slice") + 1).alias("_slices"), F.sum(size).cast("double").alias("_n"))
    keys = written(rows.groupBy(*on).agg(F.sum(own).alias("_asked")).join(keys, on))
    total = keys.agg(F.sum(F.col("_asked") * F.col("_n")).alias("pairs"), F.sum(F.col("_asked") * F.col("_slices")).alias("rows")).first()
    shares = F.ceil(F.col("_asked") * F.least("_n", F.lit(float(SLICE_VALUES))) / KEY_PAIRS)
    large = keys.select(*on, F.col("_slices").alias("_ns"), shares.alias("_nr")).where("_ns > 1 or _nr > 1")
    to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(n, F.lit(1)) - 1))
    mine = rows.join(small_side(large), on, "left").withColumns({"_share": F.pmod(F.xxhash64(*rows.columns), F.coalesce("_nr", F.lit(1))), "_slice": to(F.col("_ns"))}).drop("_ns", "_nr")
    theirs = blocks.join(small_side(large), on, "left").withColumn("_share", to(F.col("_nr"))).drop("_ns", "_nr")
    n = min(int(max(total["rows"] or 0, (total["pairs"] or 0) * DEALT_ROWS / KEY_PAIRS)), 10_000 * DEALT_ROWS)
    key = [*on, "_slice", "_share"]
    return dealt(mine, *key, n=n).join(dealt(theirs, *key, n=n).hint("merge"), key).drop("_slice", "_share")


def running(rows: DataFrame, key: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """``rows`` with ``sums`` (name: expression of a whole number) over the rows of the same ``key`` up to and with this one in ``order``.

    Keys of any size are spread over tasks: rows are dealt by ranges of key and order and written, each range sums its own, and a key that began in an earlier range
    adds what it has there (one row for each key and range). Rows that tie in ``order`` are summed in any order. Null keys make a group.
    """
    values = {f"_v{i}": F.expr(e).cast("long") for i, e in enumerate(sums.values())}
    dealt = written(rows.repartitionByRange(*key, *order).withColumns({"_part": F.spark_partition_id(), **values}))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("_part", *key).agg(*[F.sum(v).alias(v) for v in values])
    parts = parts.withColumn("_first", F.row_number().over(Window.partitionBy(*key).orderBy("_part")) == 1)
    later = parts.select("_part", "_first", *[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], *[F.sum(v).over(before).alias(f"_b{i}") for i, v in enumerate(values)])
    later = written(later.where("not _first").drop("_first"))
    own = Window.partitionBy("_part", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    mine = dealt.withColumns({v: F.sum(v).over(own) for v in values}).alias("d")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    found = mine.join(small_side(later).alias("l"), [F.col("d._part") == F.col("l._part"), *same], "left")
    return found.select(*[F.col(f"d.`{c}`") for c in rows.columns], *[(F.col(f"_v{i}") + F.coalesce(f"_b{i}", F.lit(0))).alias(n) for i, n in enumerate(sums)])
