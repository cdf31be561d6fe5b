"""Exact integer tensor maths on tables of cells (tensor_id, c, y, x, v)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.registry import query

#: Rows of a per-channel table that may be broadcast: channels times kernel cells of one layer.
SMALL_TABLE = 1_000_000


def round_shift(v: Column, shift: int) -> Column:
    """v / 2**shift, half away from zero, exact in bigint."""
    if shift <= 0:
        return v * (1 << -shift)
    return F.signum(v).cast("long") * F.shiftright(F.abs(v) + (1 << (shift - 1)), shift)


def saturate(v: Column, bits: int) -> Column:
    return F.least(F.lit((1 << (bits - 1)) - 1), F.greatest(F.lit(-(1 << (bits - 1))), v)).cast("long")


def _broadcast_checked(df: DataFrame, limit: int = SMALL_TABLE) -> DataFrame:
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def quantize_convert(cells: DataFrame, offset: int, scale: int, shift: int, bits: int) -> DataFrame:
    """((v - offset) * scale) rounded right by shift and saturated, with a flag where it was."""
    raw = round_shift((F.col("v") - offset) * scale, shift)
    return cells.withColumn("raw", raw).withColumn("saturated", saturate(F.col("raw"), bits) != F.col("raw")).withColumn("v", saturate(F.col("raw"), bits)).drop("raw")


def pixel_normalize(cells: DataFrame, means: DataFrame, scale: int, shift: int, bits: int) -> DataFrame:
    """Subtract the channel's mean (missing: 0), then convert."""
    less = cells.join(_broadcast_checked(means), "c", "left").withColumn("v", F.col("v") - F.coalesce("mean", F.lit(0))).drop("mean")
    return quantize_convert(less, 0, scale, shift, bits)


def operand_join(cells: DataFrame, operand: DataFrame, mode: str) -> DataFrame:
    """Cells with an operand per ``channel`` (small, broadcast after a count) or per ``element``."""
    return cells.join(_broadcast_checked(operand), "c", "left") if mode == "channel" else cells.join(operand, ["tensor_id", "c", "y", "x"], "left")


def pointwise(cells: DataFrame, stages: list[tuple]) -> DataFrame:
    """Stages in order: ('max'|'min'|'add', operand, left shift), ('mul', operand, right shift), ('prelu', operand, shift), ('relu',).

    An operand is a number or the name of a column (see ``operand_join``).
    """
    v = F.col("v")
    for kind, *rest in stages:
        operand = (F.col(rest[0]) if isinstance(rest[0], str) else F.lit(rest[0])).cast("long") if rest else None
        if kind in ("max", "min", "add"):
            operand = operand * (1 << rest[1])
            v = {"max": F.greatest, "min": F.least}[kind](v, operand) if kind != "add" else v + operand
        elif kind == "mul":
            v = round_shift(v * operand, rest[1])
        elif kind == "prelu":
            v = F.when(v >= 0, v).otherwise(round_shift(v * operand, rest[1]))
        else:
            v = F.greatest(v, F.lit(0).cast("long"))
    return cells.withColumn("v", v.cast("long"))


def conv2d(cells: DataFrame, weights: DataFrame, height: int, width: int, kernel: tuple[int, int], stride: int = 1, pad: int = 0, dilation: int = 1, pad_value: int = 0, shift: int = 0) -> DataFrame:
    """out[k, oy, ox] = sum of in[c, oy*s + r*d - pad, ox*s + q*d - pad] * w[k, c, r, q]; outside is ``pad_value``.

    ``weights``: k, c, r, q, w. Every input cell meets the weights of its channel (one layer's weights
    are counted, then broadcast) and adds to the outputs it touches; sums combine before the
    shuffle. The pad's share is the pad value times the weights that fall outside. The sum is clamped once to 48 bits, then rounded
    and saturated to 32 bits.
    """
    oh = (height + 2 * pad - dilation * (kernel[0] - 1) - 1) // stride + 1
    ow = (width + 2 * pad - dilation * (kernel[1] - 1) - 1) // stride + 1
    w = _broadcast_checked(weights)
    at = cells.join(w, "c").withColumns({"ty": F.col("y") + pad - F.col("r") * dilation, "tx": F.col("x") + pad - F.col("q") * dilation})
    at = at.where((F.col("ty") % stride == 0) & (F.col("tx") % stride == 0)).withColumns({"oy": (F.col("ty") / stride).cast("long"), "ox": (F.col("tx") / stride).cast("long")})
    part = at.where(F.col("oy").between(0, oh - 1) & F.col("ox").between(0, ow - 1)).groupBy("tensor_id", "k", "oy", "ox").agg(F.sum(F.col("v") * F.col("w")).alias("s"))
    if pad and pad_value:
        spark = cells.sparkSession
        grid = spark.range(oh * ow).select((F.col("id") / ow).cast("long").alias("oy"), (F.col("id") % ow).alias("ox"))
        place = grid.join(F.broadcast(weights)).withColumns({"iy": F.col("oy") * stride + F.col("r") * dilation - pad, "ix": F.col("ox") * stride + F.col("q") * dilation - pad})
        outside = place.where(~(F.col("iy").between(0, height - 1) & F.col("ix").between(0, width - 1))).groupBy("k", "oy", "ox").agg((F.sum("w") * pad_value).alias("p"))
        part = part.join(F.broadcast(outside), ["k", "oy", "ox"], "left").withColumn("s", F.col("s") + F.coalesce("p", F.lit(0))).drop("p")
    reached = lambda n_out, n_in, size: [o for o in range(n_out) if any(0 <= o * stride + r * dilation - pad < n_in for r in range(size))]
    rows, cols = reached(oh, height, kernel[0]), reached(ow, width, kernel[1])
    if len(rows) < oh or len(cols) < ow:  # outputs that only padding touches have no input cell to come from
        kernels = F.array(*[F.lit(r["k"]) for r in weights.select("k").distinct().collect()])
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        places = cells.select("tensor_id").distinct().withColumn("k", F.explode(kernels)).withColumn("oy", upto(oh)).withColumn("ox", upto(ow))
        places = places.where(~(F.col("oy").isin(rows) & F.col("ox").isin(cols)))
        whole = weights.groupBy("k").agg((F.sum("w") * pad_value).alias("s"))
        part = part.select("tensor_id", "k", "oy", "ox", "s").unionByName(places.join(F.broadcast(whole), "k").select("tensor_id", "k", "oy", "ox", "s"))
    limit = 1 << 47
    clamped = F.least(F.lit(limit - 1), F.greatest(F.lit(-limit), F.col("s")))
    return part.select("tensor_id", F.col("k").alias("c"), F.col("oy").alias("y"), F.col("ox").alias("x"), saturate(round_shift(clamped, shift), 32).alias("v"))


def fully_connected(vectors: DataFrame, weights: DataFrame) -> DataFrame:
    """Dot products of vectors (tensor_id, c, v) with rows of weights (k, c, w)."""
    return vectors.join(_broadcast_checked(weights), "c").groupBy("tensor_id", "k").agg(F.sum(F.col("v") * F.col("w")).alias("v"))


def sparse_decompress(mask: DataFrame, packed: DataFrame) -> DataFrame:
    """Bit mask (tensor_id, pos, bit) and packed non-zeros (tensor_id, n, v) to dense cells."""
    n = F.sum("bit").over(Window.partitionBy("tensor_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    numbered = mask.withColumn("n", F.when(F.col("bit") == 1, n - 1))
    return numbered.join(packed, ["tensor_id", "n"], "left").select("tensor_id", "pos", F.coalesce("v", F.lit(0)).cast("long").alias("v"))


def pooling(cells: DataFrame, method: str, height: int, width: int, kernel: int, stride: int, pad: int = 0, pad_value: int = 0) -> DataFrame:
    """min, max or avg over windows; min and max ignore the pad, avg counts it as ``pad_value`` and divides by reciprocals of 16 bits."""
    out = (height + 2 * pad - kernel) // stride + 1
    outw = (width + 2 * pad - kernel) // stride + 1
    span = lambda c, n: F.sequence(F.greatest(F.lit(0).cast("long"), F.ceil((F.col(c) + pad - kernel + 1) / stride).cast("long")), F.least(F.lit(n - 1).cast("long"), F.floor((F.col(c) + pad) / stride).cast("long")))
    hit = lambda c, n: F.ceil((F.col(c) + pad - kernel + 1) / stride) <= F.least(F.lit(n - 1), F.floor((F.col(c) + pad) / stride))
    w = cells.where(hit("y", out) & hit("x", outw)).withColumn("oy", F.explode(span("y", out))).withColumn("ox", F.explode(span("x", outw))).groupBy("tensor_id", "c", "oy", "ox")
    if method in ("min", "max"):
        r = w.agg((F.min if method == "min" else F.max)("v").alias("v"))
    else:
        r = w.agg(F.sum("v").alias("s"), F.count("*").alias("n")).withColumn("s", F.col("s") + (kernel * kernel - F.col("n")) * pad_value)
        part = 65536 // kernel
        r = r.withColumn("v", round_shift(round_shift(F.col("s") * part, 16) * part, 16))
    return r.select("tensor_id", "c", F.col("oy").alias("y"), F.col("ox").alias("x"), F.col("v").cast("long").alias("v"))


def lrn_window(cells: DataFrame, k: int) -> DataFrame:
    """Sum of squares over channels c-k..c+k at each place; missing channels add nothing."""
    w = Window.partitionBy("tensor_id", "y", "x").orderBy("c").rangeBetween(-k, k)
    return cells.withColumn("sumsq", F.sum(F.col("v") * F.col("v")).over(w))


def lut_interpolate(df: DataFrame, col: str, start: int, shift: int, table: list[int], under_slope: int = 0, over_slope: int = 0) -> DataFrame:
    """Look up (col - start) / 2**shift in a table with 16-bit linear interpolation; slopes go on below and above it."""
    t = F.array(*[F.lit(x).cast("long") for x in table])
    off = F.col(col) - start
    top = (len(table) - 1) << shift
    i = F.shiftright(off, shift).cast("int")
    frac = (off - F.shiftleft(i.cast("long"), shift)) * (1 << 16) / (1 << shift)
    low, high = F.try_element_at(t, i + 1), F.try_element_at(t, i + 2)
    inside = low + round_shift((high - low) * frac.cast("long"), 16)
    v = F.when(off < 0, F.lit(table[0]) + round_shift(off * under_slope, 16)).when(off >= top, F.lit(table[-1]) + round_shift((off - top) * over_slope, 16)).otherwise(inside)
    state = F.when(off < 0, "under").when(off >= top, "over").otherwise("hit")
    return df.withColumns({"lut": v.cast("long"), "lut_state": state})


def lrn(cells: DataFrame, k: int, start: int, shift: int, table: list[int], out_shift: int, bits: int = 16) -> DataFrame:
    """Local response normalisation: window of squares, table look-up, product, convert."""
    looked = lut_interpolate(lrn_window(cells, k), "sumsq", start, shift, table)
    return looked.withColumn("v", saturate(round_shift(F.col("v") * F.col("lut"), out_shift), bits)).drop("sumsq", "lut", "lut_state")


def layout_transform(cells: DataFrame, mode: str, sx: int = 1, sy: int = 1, padded_channels: int = 0) -> DataFrame:
    """Index arithmetic without a shuffle: ``split`` a cube into planes, ``merge`` them, or ``contract`` channels into places."""
    if mode == "split":
        return cells.select((F.col("tensor_id") * padded_channels + F.col("c")).alias("tensor_id"), F.lit(0).cast("long").alias("c"), "y", "x", "v")
    if mode == "merge":
        return cells.select(F.floor(F.col("tensor_id") / padded_channels).alias("tensor_id"), (F.col("tensor_id") % padded_channels).alias("c"), "y", "x", "v")
    g = F.floor(F.col("c") / padded_channels)
    return cells.select("tensor_id", (F.col("c") % padded_channels).alias("c"), (F.col("y") * sy + F.floor(g / sx)).alias("y"), (F.col("x") * sx + g % sx).alias("x"), "v")


def strided_copy(descriptors: DataFrame) -> DataFrame:
    """Descriptors (id, base, line_size, lines, line_stride, surfaces, surface_stride) to address ranges."""
    d = descriptors.withColumn("surface", F.explode(F.sequence(F.lit(0).cast("long"), F.col("surfaces") - 1))).withColumn("line", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lines") - 1)))
    return d.select("id", "surface", "line", (F.col("base") + F.col("surface") * F.col("surface_stride") + F.col("line") * F.col("line_stride")).alias("first"), F.col("line_size").alias("size"))


def numeric_exceptions(cells: DataFrame, by: list[str], bits: int = 8) -> DataFrame:
    """NaN, infinite and out-of-range values per group."""
    v = F.col("v").cast("double")
    n = lambda test: F.count(F.when(test, 1))
    inf = F.abs(v) == float("inf")
    return cells.groupBy(*by).agg(n(F.isnan(v)).alias("n_nan"), n(inf).alias("n_inf"), n(~F.isnan(v) & ~inf & ~v.between(-(1 << (bits - 1)), (1 << (bits - 1)) - 1)).alias("n_saturated"))


# --- registered queries: vectors of 64 numbers, as vectors (c = position) or as 8 x 8 images ---

RS = lambda e, s: f"(CASE WHEN ({e}) < 0 THEN -1 ELSE 1 END) * ((abs({e}) + {1 << (s - 1)}) // {1 << s})"
SAT = lambda e, b: f"least({(1 << (b - 1)) - 1}, greatest({-(1 << (b - 1))}, {e}))"
IMAGE = "img AS (SELECT tensor_id, label AS c, y, x, v FROM {cells})"


def _image(t) -> DataFrame:
    return t.cells.select("tensor_id", F.col("label").alias("c"), "y", "x", "v")


def _vector(t) -> DataFrame:
    return t.cells.select("tensor_id", "c", F.lit(0).cast("long").alias("y"), F.lit(0).cast("long").alias("x"), "v")


query("quantize_convert", f"WITH q AS (SELECT tensor_id, c, {RS('(v - 5) * 7', 4)} AS r FROM {{cells}}) SELECT tensor_id, c, CAST({SAT('r', 8)} AS BIGINT) AS v, r <> {SAT('r', 8)} AS saturated FROM q")(lambda t: quantize_convert(_vector(t), 5, 7, 4, 8).select("tensor_id", "c", "v", "saturated"))
query("pixel_normalize", f"WITH m AS (SELECT c, CAST(floor(avg(v)) AS BIGINT) AS mean FROM {{cells}} WHERE c < 60 GROUP BY c), q AS (SELECT tensor_id, x.c, {RS('(v - coalesce(mean, 0)) * 3', 2)} AS r FROM {{cells}} x LEFT JOIN m ON m.c = x.c) SELECT tensor_id, c, CAST({SAT('r', 8)} AS BIGINT) AS v, r <> {SAT('r', 8)} AS saturated FROM q")(
    lambda t: pixel_normalize(_vector(t), t.cells.where("c < 60").groupBy("c").agg(F.floor(F.avg("v")).alias("mean")), 3, 2, 8).select("tensor_id", "c", "v", "saturated")
)
query("operand_join", "SELECT a.tensor_id, a.c, a.v, coalesce(b.v, 0) AS operand FROM {cells} a LEFT JOIN (SELECT tensor_id + 1 AS tensor_id, c, v FROM {cells} WHERE v > 0) b ON a.tensor_id = b.tensor_id AND a.c = b.c")(
    lambda t: operand_join(_vector(t), _vector(t).where("v > 0").select((F.col("tensor_id") + 1).alias("tensor_id"), "c", "y", "x", F.col("v").alias("operand")), "element").select("tensor_id", "c", "v", F.coalesce("operand", F.lit(0)).cast("long").alias("operand"))
)
query("pointwise", f"WITH a AS (SELECT tensor_id, c, v + (c % 5) * 4 AS v FROM {{cells}}), b AS (SELECT tensor_id, c, {RS('v * 3', 1)} AS v FROM a), p AS (SELECT tensor_id, c, CASE WHEN v >= 0 THEN v ELSE {RS('v * 5', 3)} END AS v FROM b) SELECT tensor_id, c, CAST(least(v, 400) AS BIGINT) AS v FROM p")(
    lambda t: pointwise(operand_join(_vector(t), t.spark.range(64).select(F.col("id").alias("c"), (F.col("id") % 5).alias("bias")), "channel"), [("add", "bias", 2), ("mul", 3, 1), ("prelu", 5, 3), ("min", 400, 0)]).select("tensor_id", "c", "v")
)
CUBE = "cube AS (SELECT tensor_id, c // 16 AS c, (c // 4) % 4 AS y, c % 4 AS x, v FROM {cells})"
WEIGHTS = "wt AS (SELECT k, c, r, q, (k * 7 + c * 3 + r * 5 + q) % 9 - 4 AS w FROM range(3) a(k), range(4) b(c), range(3) d(r), range(3) e(q))"


def _conv(t) -> DataFrame:
    i = F.col("id")
    weights = t.spark.range(3 * 4 * 9).select(F.floor(i / 36).alias("k"), (F.floor(i / 9) % 4).alias("c"), (F.floor(i / 3) % 3).alias("r"), (i % 3).alias("q"))
    weights = weights.withColumn("w", (F.col("k") * 7 + F.col("c") * 3 + F.col("r") * 5 + F.col("q")) % 9 - 4)
    cube = t.cells.select("tensor_id", F.floor(F.col("c") / 16).alias("c"), (F.floor(F.col("c") / 4) % 4).alias("y"), (F.col("c") % 4).alias("x"), "v")
    return conv2d(cube, weights, 4, 4, (3, 3), stride=1, pad=1, pad_value=6, shift=3)


query("conv2d", f"WITH {CUBE}, {WEIGHTS}, o AS (SELECT DISTINCT tensor_id FROM cube), g AS (SELECT tensor_id, k, c, oy, ox, w, oy + r - 1 AS iy, ox + q - 1 AS ix FROM o, range(4) a(oy), range(4) b(ox), wt), s AS (SELECT g.tensor_id, k, oy, ox, sum(coalesce(v, 6) * w) AS s FROM g LEFT JOIN cube i ON i.tensor_id = g.tensor_id AND i.c = g.c AND i.y = iy AND i.x = ix GROUP BY ALL) SELECT tensor_id, k AS c, oy AS y, ox AS x, CAST({RS('s', 3)} AS BIGINT) AS v FROM s")(_conv)
query("fully_connected", "SELECT a.tensor_id, b.tensor_id AS k, CAST(sum(a.v * b.v) AS BIGINT) AS v FROM {cells} a JOIN {cells} b ON a.c = b.c AND b.tensor_id < 16 GROUP BY 1, 2")(
    lambda t: fully_connected(t.cells, t.cells.where("tensor_id < 16").select(F.col("tensor_id").alias("k"), "c", F.col("v").alias("w")))
)
query("sparse_decompress", "SELECT tensor_id, c AS pos, CASE WHEN v > 100 THEN v ELSE 0 END AS v FROM {cells}")(
    lambda t: sparse_decompress(t.cells.select("tensor_id", F.col("c").alias("pos"), (F.col("v") > 100).cast("int").alias("bit")), t.cells.where("v > 100").select("tensor_id", (F.row_number().over(Window.partitionBy("tensor_id").orderBy("c")) - 1).cast("long").alias("n"), "v"))
)
for _m in ("max", "min", "avg"):
    _v = f"{_m}(v)" if _m != "avg" else None
    _w = f"WITH {IMAGE}, g AS (SELECT tensor_id, c, oy, ox, v FROM img, range(4) a(oy), range(4) b(ox) WHERE y BETWEEN oy * 2 - 1 AND oy * 2 + 1 AND x BETWEEN ox * 2 - 1 AND ox * 2 + 1)"
    _s = f"{_w} SELECT tensor_id, c, oy AS y, ox AS x, {_m}(v) AS v FROM g GROUP BY ALL" if _m != "avg" else f"{_w}, s AS (SELECT tensor_id, c, oy, ox, sum(v) + (9 - count(*)) * 4 AS s FROM g GROUP BY ALL), h AS (SELECT *, {RS('s * 21845', 16)} AS h FROM s) SELECT tensor_id, c, oy AS y, ox AS x, CAST({RS('h * 21845', 16)} AS BIGINT) AS v FROM h"
    query("pooling" if _m == "max" else f"pooling_{_m}", _s)(lambda t, m=_m: pooling(_image(t), m, 8, 8, 3, 2, 1, 4))
query("lrn_window", "SELECT a.tensor_id, a.c, CAST(sum(b.v * b.v) AS BIGINT) AS sumsq FROM {cells} a JOIN {cells} b ON a.tensor_id = b.tensor_id AND b.c BETWEEN a.c - 2 AND a.c + 2 GROUP BY 1, 2")(lambda t: lrn_window(_vector(t), 2).select("tensor_id", "c", "sumsq"))
LUT = [i * i - 3 * i for i in range(65)]
LUTSQL = "(" + str(LUT) + ")"
query("lut_interpolate", f"WITH o AS (SELECT tensor_id, c, v + 300 AS o FROM {{cells}}), i AS (SELECT *, CASE WHEN o BETWEEN 0 AND 511 THEN o // 8 ELSE 0 END AS i FROM o), d AS (SELECT *, ({LUTSQL}[i + 2] - {LUTSQL}[i + 1]) * ((o - i * 8) * 8192) AS d FROM i) SELECT tensor_id, c, CAST(CASE WHEN o < 0 THEN {RS('o * 40000', 16)} WHEN o >= 512 THEN {LUT[-1]} + {RS('(o - 512) * 70000', 16)} ELSE {LUTSQL}[i + 1] + {RS('d', 16)} END AS BIGINT) AS lut, CASE WHEN o < 0 THEN 'under' WHEN o >= 512 THEN 'over' ELSE 'hit' END AS lut_state FROM d")(
    lambda t: lut_interpolate(_vector(t), "v", -300, 3, LUT, 40000, 70000).select("tensor_id", "c", "lut", "lut_state")
)
query("lrn", f"WITH w AS (SELECT a.tensor_id, a.c, any_value(a.v) AS v, CAST(sum(b.v * b.v) AS BIGINT) AS o FROM {{cells}} a JOIN {{cells}} b ON a.tensor_id = b.tensor_id AND b.c BETWEEN a.c - 1 AND a.c + 1 GROUP BY 1, 2), i AS (SELECT *, CASE WHEN o < 65536 THEN o // 1024 ELSE 0 END AS i FROM w), l AS (SELECT *, CASE WHEN o >= 65536 THEN {LUT[-1]} ELSE {LUTSQL}[i + 1] + {RS(f'({LUTSQL}[i + 2] - {LUTSQL}[i + 1]) * ((o - i * 1024) * 64)', 16)} END AS l FROM i), r AS (SELECT tensor_id, c, {RS('v * l', 6)} AS r FROM l) SELECT tensor_id, c, CAST({SAT('r', 16)} AS BIGINT) AS v FROM r")(
    lambda t: lrn(_vector(t), 1, 0, 10, LUT, 6).select("tensor_id", "c", "v")
)
query("layout_transform", "SELECT tensor_id, c % 16 AS c, (c // 16) // 2 AS y, (c // 16) % 2 AS x, v FROM {cells}")(lambda t: layout_transform(_vector(t), "contract", 2, 2, 16))
query("strided_copy", "SELECT p_partkey AS id, s AS surface, l AS line, p_partkey * 10000 + s * 4096 + l * 64 AS first, CAST(p_size AS BIGINT) AS size FROM part, range(8) a(l), range(4) b(s) WHERE l <= p_size % 8 AND s <= p_partkey % 4")(
    lambda t: strided_copy(t.part.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") * 10000).alias("base"), F.col("p_size").cast("long").alias("line_size"), (F.col("p_size") % 8 + 1).cast("long").alias("lines"), F.lit(64).cast("long").alias("line_stride"), (F.col("p_partkey") % 4 + 1).alias("surfaces"), F.lit(4096).cast("long").alias("surface_stride")))
)
query("numeric_exceptions", "SELECT label, count(CASE WHEN v = 0 THEN 1 END) AS n_nan, count(CASE WHEN v = 7 THEN 1 END) AS n_inf, count(CASE WHEN v NOT BETWEEN -128 AND 127 THEN 1 END) AS n_saturated FROM {cells} GROUP BY label")(
    lambda t: numeric_exceptions(t.cells.withColumn("v", F.when(F.col("v") == 0, float("nan")).when(F.col("v") == 7, float("inf")).otherwise(F.col("v").cast("double"))), ["label"])
)
