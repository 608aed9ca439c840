"""Aggregations: content masks, layer statistics, medians, reports, top-k and sampling.

Rank statistics run on value histograms: voxels are counted per (key, value)
with map-side combine first, so a layer that holds a third of all voxels still
reaches the ranking window as at most 256 (u8) or 65 536 (u16) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.functions.scalar import half_up, outside_content, to_pixel
from voxelframe.schema import KEY, POS, clamp, require
from voxelframe.session import small

XY = KEY + ["y", "x"]


# ---- content mask and layer normalisation ---------------------------------

def content_mask(vox: DataFrame, dtype: str = "u8") -> DataFrame:
    """Per (x, y): 1 when no layer is too dark or too bright, else 0."""
    require(vox, *POS, "v")
    return vox.groupBy(*XY).agg(F.min(F.when(outside_content(F.col("v"), dtype), 0).otherwise(1)).alias("content"))


def histogram(df: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def ranked_histogram(hist: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """Add the rank interval [lo, hi) of each value and the group total."""
    up_to = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (hist.withColumn("hi", F.sum("n").over(up_to))
            .withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
            .withColumn("lo", F.col("hi") - F.col("n")))


def trimmed_stats(df: DataFrame, keys: list[str], cutoff: float = 0.03, value: str = "v") -> DataFrame:
    """Median of all values; mean, population deviation, min and max after
    cutting round(n * cutoff) values at both ends."""
    ranks = ranked_histogram(histogram(df, keys, value), keys, value)
    cut = half_up(F.col("total") * F.lit(float(cutoff)))
    kept = F.greatest(F.lit(0), F.least("hi", F.col("total") - cut) - F.greatest("lo", cut))
    middle = F.expr("total div 2")
    v = F.col(value)
    sums = ranks.withColumn("kept", kept).groupBy(*keys).agg(
        F.max(F.when((F.col("lo") <= middle) & (middle < F.col("hi")), v)).alias("median"),
        F.sum("kept").alias("kept"),
        F.sum(F.col("kept") * v).alias("s1"),
        F.sum(F.col("kept") * v * v).alias("s2"),
        F.min(F.when(F.col("kept") > 0, v)).alias("min"),
        F.max(F.when(F.col("kept") > 0, v)).alias("max"),
    )
    mean = F.col("s1") / F.col("kept")
    # exact integer numerator: n * s2 - s1^2
    spread = (F.col("kept") * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")
    return sums.select(
        *keys, "median", mean.alias("mean"),
        (F.sqrt(F.greatest(spread, F.lit(0.0))) / F.col("kept")).alias("std"), "min", "max",
    )


def layer_stats(vox: DataFrame, cutoff: float = 0.03, dtype: str = "u8") -> DataFrame:
    """Trimmed statistics of every layer over the content pixels only."""
    content = content_mask(vox, dtype).where("content = 1")
    return trimmed_stats(vox.join(content, XY, "left_semi"), KEY + ["z"], cutoff)


def _scale(kind: str) -> Column:
    return {"none": F.lit(1.0), "full_range": (F.col("max") - F.col("min")).cast("double"),
            "gauss": F.lit(4.0) * F.col("std")}[kind]


def _shift(kind: str) -> Column:
    return {"none": F.lit(0.0), "median": F.col("median").cast("double"), "mean": F.col("mean")}[kind]


def layer_models(stats: DataFrame, scale: str = "gauss", shift: str = "mean") -> DataFrame:
    """Linear model of every layer towards the first layer with the widest scale."""
    described = stats.select(*KEY, "z", _scale(scale).alias("scale"), _shift(shift).alias("shift"))
    target = described.groupBy(*KEY).agg(
        F.max(F.struct(F.col("scale"), (-F.col("z")).alias("first"), F.col("shift"))).alias("t"))
    a = F.col("t.scale") / F.col("scale")
    return described.join(target, KEY).select(
        *KEY, "z", a.alias("a"), (F.col("t.shift") - F.col("shift") * a).alias("b"))


def apply_layer_models(vox: DataFrame, models: DataFrame, dtype: str = "u8") -> DataFrame:
    """Foreground becomes clamp(trunc(a v + b)); background stays 0. The model
    table has one row per layer and is broadcast after its size was checked, so
    the volume is neither shuffled nor gathered by layer."""
    mapped = clamp((F.col("a") * F.col("v") + F.col("b")).cast("long"), dtype)
    return vox.join(small(models), KEY + ["z"]).select(*POS, F.when(F.col("v") > 0, mapped).otherwise(F.lit(0)).alias("v"))


# ---- masks -----------------------------------------------------------------

def flatten_mask(mask: DataFrame, projection: str = "min") -> DataFrame:
    fold = {"min": F.min, "max": F.max}[projection]
    return mask.groupBy(*XY).agg(fold("v").alias("m"))


def apply_mask(vox: DataFrame, flat: DataFrame) -> DataFrame:
    """Zero every voxel whose (x, y) column is masked out; a column without mask is background."""
    return vox.join(flat, XY, "left").select(
        *POS, F.when(F.coalesce("m", F.lit(0)) == 0, F.lit(0)).otherwise(F.col("v")).alias("v"))


def cost_mask(cost: DataFrame) -> DataFrame:
    """1 where the z column is not constant."""
    return cost.groupBy(*XY).agg(F.when(F.min("v") != F.max("v"), 1).otherwise(0).alias("m"))


def full_column_mask(mask: DataFrame) -> DataFrame:
    """1 where every layer of the column carries data."""
    return mask.groupBy(*XY).agg(F.when(F.min("v") >= 1, 1).otherwise(0).alias("m"))


# ---- scalar reductions ------------------------------------------------------

def weighted_mean(df: DataFrame, keys: list[str], value: str = "h", weight: str = "m") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum(F.col(value) * F.col(weight)).alias("weighted_sum"), F.sum(weight).alias("weight"),
        (F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias("mean"))


def min_max(df: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("min"), F.max(value).alias("max"))


def median_nonzero(df: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """Exact median of the non-zero pixels; the integer mean of the middle two for even counts."""
    ranks = ranked_histogram(histogram(df.where(F.col(value) != 0), keys, value), keys, value)

    def at(rank):
        return F.max(F.when((F.col("lo") <= rank) & (rank < F.col("hi")), F.col(value)))

    return ranks.groupBy(*keys).agg(
        F.max("total").alias("n"), at(F.expr("(total - 1) div 2")).alias("lower"), at(F.expr("total div 2")).alias("upper"),
    ).select(*keys, F.expr("(lower + upper) div 2").alias("median"))


def out_of_bounds_value(vox: DataFrame) -> DataFrame:
    """The median non-zero grey value of the last layer of every volume."""
    last = vox.groupBy(*KEY).agg(F.max("z").alias("z"))
    return median_nonzero(vox.join(small(last), KEY + ["z"], "left_semi"), KEY)


def mean_value(df: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"))


def approximate_mean(df: DataFrame, keys: list[str], position: list[str], fraction: float, seed: int,
                     value: str = "v") -> DataFrame:
    """Mean over a repeatable random draw of positions."""
    from voxelframe.functions.scalar import hash_unit

    draw = hash_unit(seed, *[F.col(c) for c in keys + position]) < fraction
    return mean_value(df.where(draw), keys, value)


def squared_error(a: DataFrame, b: DataFrame) -> DataFrame:
    joined = a.join(b.withColumnRenamed("v", "w"), POS)
    return joined.groupBy(*KEY).agg(F.sum((F.col("v") - F.col("w")) * (F.col("v") - F.col("w"))).alias("score"))


def mean_shear(fits: DataFrame, keys: list[str]) -> DataFrame:
    """Mean shear over all stacks of a channel, from sums and counts."""
    return fits.groupBy(*keys).agg(
        F.avg("sx").alias("sx"), F.avg("sy").alias("sy"), F.count(F.lit(1)).alias("stacks"))


# ---- match counts and reports ----------------------------------------------

def pair_counts(matches: DataFrame) -> DataFrame:
    return matches.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


def tile_match_counts(matches: DataFrame, tiles: DataFrame, tile: str = "tile") -> DataFrame:
    """Matches touching each tile; unconnected tiles get 0. Pairs are counted before
    both ends are listed, so the fan-out works on pairs, not on matches."""
    ends = pair_counts(matches).select(F.explode(F.array("a", "b")).alias(tile), "n")
    total = ends.groupBy(tile).agg(F.sum("n").alias("n"))
    return tiles.select(tile).distinct().join(total, tile, "left").select(tile, F.coalesce("n", F.lit(0)).alias("n"))


def pair_report(matches: DataFrame, models: DataFrame) -> DataFrame:
    """Inliers, mean and greatest residual of each pair under two models, worst pairs first.

    ``models`` holds per pair a translation (sx, sy) and an affine matrix ``m``."""
    def residual(x, y):
        return F.sqrt((x - F.col("qx")) * (x - F.col("qx")) + (y - F.col("qy")) * (y - F.col("qy")))

    shift = residual(F.col("px") + F.col("sx"), F.col("py") + F.col("sy"))
    m = F.col("m")
    full = residual(m[0] * F.col("px") + m[1] * F.col("py") + m[2], m[3] * F.col("px") + m[4] * F.col("py") + m[5])
    return (matches.join(models, ["a", "b"]).withColumn("r1", shift).withColumn("r2", full)
            .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.avg("r1").alias("shift_error"),
                                   F.avg("r2").alias("affine_error"), F.max("r2").alias("affine_max"))
            .orderBy(F.desc("shift_error"), "a", "b"))


# ---- boxes -------------------------------------------------------------------

def bounding_box(points: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    return points.groupBy(*keys).agg(*[f(a).alias(f"{n}_{a}") for a in axes for n, f in (("min", F.min), ("max", F.max))])


def combine_boxes(boxes: DataFrame, keys: list[str], axes: list[str], how: str = "union") -> DataFrame:
    low, high = (F.min, F.max) if how == "union" else (F.max, F.min)
    aggs = [c for a in axes for c in (low(f"min_{a}").alias(f"min_{a}"), high(f"max_{a}").alias(f"max_{a}"))]
    return (boxes.groupBy(*keys) if keys else boxes).agg(*aggs)


def mapped_box(models: DataFrame, width: Column, height: Column, matrix: str = "m") -> DataFrame:
    """The box of an affine-mapped image rectangle, one row per model."""
    from voxelframe.functions.affine import apply_affine

    corners = [(F.lit(0.0), F.lit(0.0)), (width - 1, F.lit(0.0)), (F.lit(0.0), height - 1), (width - 1, height - 1)]
    xs, ys = zip(*[apply_affine(F.col(matrix), list(c)) for c in corners])
    return models.select("*", F.least(*xs).alias("min_x"), F.greatest(*xs).alias("max_x"),
                         F.least(*ys).alias("min_y"), F.greatest(*ys).alias("max_y"))


def stack_bounds(models: DataFrame, keys: list[str], width: Column, height: Column, largest: bool = True) -> DataFrame:
    """Bounds of an aligned slice stack: union (largest) or intersection over slices."""
    return combine_boxes(mapped_box(models, width, height), keys, ["x", "y"], "union" if largest else "intersect")


def transformed_bounds(models: DataFrame, width: Column, height: Column) -> DataFrame:
    """Overall bounds after mapping the four corners of each dataset through the inverse model."""
    from voxelframe.functions.affine import invert2

    inverse = models.withColumn("inverse", invert2(F.col("m")))
    return combine_boxes(mapped_box(inverse, width, height, "inverse"), [], ["x", "y"], "union")


# ---- regressions -------------------------------------------------------------

def fit_plane(field: DataFrame, keys: list[str], value: str = "h") -> DataFrame:
    """Least-squares plane h = a x + b y + c from centred sums."""
    sums = field.groupBy(*keys).agg(
        F.avg("x").alias("mx"), F.avg("y").alias("my"), F.avg(value).alias("mh"),
        F.covar_pop("x", "x").alias("xx"), F.covar_pop("y", "y").alias("yy"), F.covar_pop("x", "y").alias("xy"),
        F.covar_pop("x", value).alias("xh"), F.covar_pop("y", value).alias("yh"))
    det = F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    a = (F.col("xh") * F.col("yy") - F.col("yh") * F.col("xy")) / det
    b = (F.col("yh") * F.col("xx") - F.col("xh") * F.col("xy")) / det
    return (sums.withColumn("a", a).withColumn("b", b)
            .select(*keys, "a", "b", (F.col("mh") - F.col("a") * F.col("mx") - F.col("b") * F.col("my")).alias("c")))


def plane_residual(field: DataFrame, planes: DataFrame, keys: list[str], value: str = "h") -> DataFrame:
    predicted = F.col("a") * F.col("x") + F.col("b") * F.col("y") + F.col("c")
    return field.join(small(planes), keys).select(*keys, "y", "x", (F.col(value) - predicted).alias("residual"))


def compare_alignments(shifts: DataFrame, fits: DataFrame) -> DataFrame:
    """Per channel mean shear, residual shift of every slice, mean residual per slice over stacks."""
    shear = mean_shear(fits, ["channel"])
    rest = shifts.join(shear, "channel").select(
        "channel", "stack", "z", (F.col("tx") - F.col("z") * F.col("sx")).alias("rx"),
        (F.col("ty") - F.col("z") * F.col("sy")).alias("ry"))
    return rest.groupBy("channel", "z").agg(F.avg("rx").alias("rx"), F.avg("ry").alias("ry"))


# ---- limits and samples --------------------------------------------------------

def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, spread: list[str]) -> DataFrame:
    """The first n rows of each group. A first pass keeps n rows per (group, salt),
    so a group with a third of all rows never meets in one task."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(64)))
    part = Window.partitionBy(*keys, "_salt").orderBy(*order)
    whole = Window.partitionBy(*keys).orderBy(*order)
    near = salted.withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= n).drop("_r", "_salt")
    return near.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= n)


def sample_per_group(df: DataFrame, keys: list[str], identity: list[str], n: int, seed: int) -> DataFrame:
    """At most n rows per group, chosen by a seeded hash of the row identity."""
    order = [F.xxhash64(*identity, F.lit(seed)), *[F.col(c) for c in identity]]
    return top_per_group(df, keys, order, n, identity).drop("rank")


def first_best(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The order value of the greatest row, first on ties."""
    best = F.max(F.struct(F.col(value), (-F.col(order)).alias("o"))).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, (-F.col("best.o")).alias(order), F.col(f"best.{value}").alias(value))


def ordered_views(matches: DataFrame) -> DataFrame:
    """Every (id, channel, cam) named at either end of a match, distinct and in order."""
    ends = matches.select("id_a", "channel_a", "cam_a", "id_b", "channel_b", "cam_b").distinct()
    sides = F.array(*[F.struct(F.col(f"id_{s}").alias("id"), F.col(f"channel_{s}").alias("channel"),
                               F.col(f"cam_{s}").alias("cam")) for s in "ab"])
    return ends.select(F.explode(sides).alias("s")).select("s.*").distinct().orderBy("id", "channel", "cam")


def random_subsample(vox: DataFrame, seed: int) -> DataFrame:
    """Deal the values of every 2x2x2 cell, in random order, to eight half-size outputs."""
    cell = [F.expr(f"{a} div 2").alias(a) for a in ("z", "y", "x")]
    order = [F.xxhash64("dataset", "z", "y", "x", F.lit(seed)), F.col("z"), F.col("y"), F.col("x")]
    packed = vox.groupBy("dataset", *cell).agg(
        F.sort_array(F.collect_list(F.struct(order[0].alias("h"), "z", "y", "x", "v"))).alias("cell"))
    return packed.select("dataset", "z", "y", "x", F.posexplode("cell").alias("output", "c")).select(
        "dataset", "output", "z", "y", "x", F.col("c.v").alias("v"))
