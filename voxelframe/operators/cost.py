"""Cost volumes: how unlikely each voxel is to lie on the slab surface.

Columns are image lines along the depth axis. Column statistics come from one
array per column (never longer than the volume is deep); the running sums and
gradients are windows over the same column, so they reuse its partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.functions.scalar import half_up, to_pixel
from voxelframe.operators import compose, pixel, stats, stencils, transforms
from voxelframe.schema import KEY, POS
from voxelframe.session import small

AXES = ("z", "y", "x")


def derivative_cost(vox: DataFrame, outside: DataFrame, sizes: DataFrame, mask: DataFrame | None = None,
                    median: bool = False, smooth: bool = False, steps: dict[str, int] | None = None) -> DataFrame:
    """Cost of thin slabs: 255 - max(0, v(z + 1) - v(z)), stretched by four.

    ``outside`` holds the grey value beyond each volume (column ``median``). The
    first layer and the end layers of incomplete columns take 255 - outside;
    elsewhere incomplete columns cost 255."""
    base = vox.join(small(outside).select(*KEY, F.col("median").alias("_o")), KEY).join(small(sizes).select(*KEY, F.col("nz").alias("_nz")), KEY)
    if median:
        base = stencils.median_z3(base, F.col("_o"))
    ahead = F.coalesce(F.lead("v").over(stencils.line(base, "z")), F.col("_o"))
    fall = F.lit(255) - F.greatest(F.lit(0), ahead - F.col("v"))
    rim = F.lit(255) - F.col("_o")
    if mask is None:
        value = F.when(F.col("z") == 0, rim).otherwise(fall)
    else:
        base = base.join(stats.full_column_mask(mask), [*KEY, "y", "x"], "left").fillna({"m": 0})
        edge = (F.col("z") == 0) | (F.col("z") == F.col("_nz") - 1)
        gap = F.when(edge, rim).otherwise(F.lit(255))
        value = F.when(F.col("m") == 0, gap).when(F.col("z") == 0, rim).otherwise(fall)
    out = base.select(*POS, (F.lit(255.0) - (F.lit(255.0) - value) * 4.0).alias("v"))
    if steps:
        out = pixel.subsample(out, steps)
    if smooth:
        extent = sizes.select(*KEY, *[F.ceil(F.col(f"n{a}") / (steps or {}).get(a, 1)).alias(f"n{a}") for a in AXES])
        out = stencils.gauss(out, {"z": 1.0}, "constant", extent, outside=255.0)
    return out.select(*POS, to_pixel(F.col("v")).alias("v"))


# ---- resin cost ---------------------------------------------------------------------------

def _band(values: Column, size: int, threshold: Column, prefix: str) -> dict[str, Column]:
    """First ``size`` valid values from the first one above a threshold: sorted
    band, start, number of saturated values passed and number of values passed."""
    # a column without any value above the threshold starts at 0
    start = F.greatest(F.array_position(F.transform(values, lambda v: (v > threshold) & (v < 254.5)), True) - 1, F.lit(0).cast("long"))
    tail = F.slice(values, start.cast("int") + 1, F.greatest(F.size(values), F.lit(1)))
    valid = F.filter(F.transform(tail, lambda v, i: F.when((v > 0.5) & (v < 254.5), i)), lambda i: i.isNotNull())
    last = F.coalesce(F.try_element_at(valid, F.lit(size)), F.size(tail))
    passed = F.slice(tail, 1, last)
    band = F.array_sort(F.slice(F.filter(tail, lambda v: (v > 0.5) & (v < 254.5)), 1, size))
    return {f"{prefix}_band": band, f"{prefix}_start": start,
            f"{prefix}_full": F.size(F.filter(passed, lambda v: v >= 254.5)), f"{prefix}_total": last + 1}


def _bands(columns: DataFrame, size: int, threshold: float) -> DataFrame:
    """Bands at both ends of every column (``a``), each refined by its own upper
    quartile; adds band, start, full, total and end."""
    def refine(df: DataFrame, source: str, first: int, prefix: str) -> DataFrame:
        df = df.withColumns(_band(F.col(source), first, F.lit(float(threshold)), "_r"))
        n = F.size("_r_band")
        quartile = F.least(F.element_at("_r_band", F.greatest(F.floor(n * 0.75), F.lit(0)).cast("int") + 1), F.lit(253.5))
        df = df.withColumn("_q", F.when(n > 0, quartile))
        df = df.withColumns(_band(F.col(source), size, F.coalesce("_q", F.lit(float(threshold))), prefix))
        return df.drop("_q", "_r_band", "_r_start", "_r_full", "_r_total")

    out = refine(columns, "a", size, "b")
    out = refine(out.withColumn("_back", F.reverse("a")), "_back", 2 * size, "e").drop("_back")
    depth = F.size("a")
    return out.select(
        *columns.columns, F.col("b_band").alias("band"),
        F.when(F.size("b_band") == 0, depth - 1).otherwise(F.col("b_start")).alias("start"),
        F.col("b_full").alias("full"), F.col("b_total").alias("total"),
        F.when(F.size("e_band") == 0, F.lit(0)).otherwise(depth - F.col("e_start") - 1).alias("end"))


def column_slopes(columns: DataFrame, group: list[str], along: str, size: int, reach: int, factor: float,
                  low: float, high: float) -> DataFrame:
    """Slope of intensity with depth below ``start`` in the neighbouring columns,
    clamped. ``columns`` holds an array ``a`` per column with start and end."""
    near = Window.partitionBy(*group).orderBy(along).rangeBetween(-reach, reach)
    last = F.max(along).over(Window.partitionBy(*group))
    out = columns.withColumn("_last", last).withColumn("_near", F.collect_list(F.struct(F.col(along).alias("p"), "a")).over(near))
    stop = F.least(F.col("start") + factor * size, F.col("end").cast("double")).cast("long")
    out = out.withColumn("_stop", stop).withColumn("_rows", F.greatest(F.col("_stop") - F.col("start"), F.lit(0)).cast("int"))
    # the last column of a slice never takes part
    used = F.filter("_near", lambda n: n["p"] < F.col("_last"))
    cut = F.transform(used, lambda n: F.transform(
        F.slice(n["a"], (F.col("start") + 1).cast("int"), F.col("_rows")), lambda v, i: F.struct(
            F.when((v > 0) & (v < 255), v).otherwise(F.lit(0)).cast("double").alias("v"), i.alias("i"))))
    out = out.withColumn("_flat", F.flatten(cut))
    centre = (F.lit(2.0) * F.col("start") + factor * size) * 0.5
    out = out.withColumn("_c", centre)
    ordered = F.array_sort(F.transform("_flat", lambda s: s["v"]))
    out = out.withColumn("_med", F.try_element_at(ordered, (F.floor(F.size("_flat") / 2) + 1).cast("int")))

    def depth(s: Column) -> Column:
        return (F.col("start") + s["i"] - F.col("_c")).cast("long").cast("double")

    def total(term) -> Column:
        return F.aggregate("_flat", F.lit(0.0), lambda acc, s: acc + term(s))

    # sum of depth * (v - median), with the median outside the loop
    out = out.withColumns({"_dv": total(lambda s: depth(s) * s["v"]), "_d": total(depth), "_dd": total(lambda s: depth(s) * depth(s))})
    rise = (F.col("_dv") - F.col("_med") * F.col("_d")) / F.nullif(F.col("_dd"), F.lit(0.0))
    # least and greatest skip nulls, so a missing slope is decided first
    slope = F.when(rise.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), rise)))
    return out.withColumn("slope", slope).drop("_last", "_near", "_stop", "_rows", "_flat", "_c", "_med", "_dv", "_d", "_dd")


def correct_slope(values: Column, start: Column, end: Column, slope: Column) -> Column:
    """Subtract the slope from a column, kept within 0..255."""
    change = -(end - start) * slope / (end - start + 1)
    return F.transform(values, lambda v, i: F.greatest(F.lit(0), F.least(F.lit(255), (v + (i - start) * change).cast("long"))))


def one_sided_cost(vox: DataFrame, depth: str = "y", along: str = "x", band: int = 20, threshold: float = 50.0,
                   min_gradient: float = 20.0, kernel: int = 5, slope_reach: int | None = 10, slope_factor: float = 3.5,
                   min_slope: float = 0.0, max_slope: float = 0.04) -> DataFrame:
    """Resin cost seen from the low end of every column.

    The band of the first valid values gives the typical resin grey level; the
    cost sums what lies on the wrong side of it above and below each voxel, is
    lowered by the local gradient and spread to 0..255. Columns without a clear
    result cost 255."""
    third = next(a for a in AXES if a not in (depth, along))
    key = [*KEY, third, along]
    packed = vox.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct(F.col(depth).alias("p"), "v"))).alias("s"))
    packed = packed.select(*key, F.col("s")[0]["p"].alias("p0"), F.col("s.v").alias("a"))
    columns = _bands(packed, band, threshold)
    if slope_reach is not None:
        sloped = column_slopes(columns, [*KEY, third], along, band, slope_reach, slope_factor, min_slope, max_slope)
        # rows in between keep the optimizer from recomputing the slope for every voxel
        fixed = columns.join(sloped.select(*key, "slope"), key)
        corrected = correct_slope(F.col("a"), F.col("start"), F.col("end"), F.col("slope"))
        fixed = fixed.select(*key, "p0", F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("a") - 1).alias("i"), corrected.alias("v"))).alias("s"))
        again = fixed.groupBy(*key, "p0").agg(F.sort_array(F.collect_list("s")).alias("s"))
        columns = _bands(again.select(*key, "p0", F.col("s.v").alias("a")), band, threshold)
    n = F.size("band")

    def quantile(q: float) -> Column:
        return F.try_element_at("band", F.floor(n * q).cast("int") + 1).cast("double")

    spread = (quantile(0.84) - quantile(0.16)) * 0.5
    columns = columns.withColumn("level", quantile(0.3)).withColumn("below", F.least(quantile(0.3) - 1, quantile(0.5) - spread))
    columns = columns.withColumn("start", F.greatest("start", F.lit(1)))
    columns = columns.withColumn("reach", F.greatest(F.lit(1.0), F.col("level") - F.col("below")))
    clean = F.transform("a", lambda v: F.when(v > 254.5, F.lit(0)).otherwise(v))
    before = F.exists(F.slice(clean, 1, F.col("start").cast("int")), lambda v: v != 0)
    beyond = F.exists(F.slice(clean, F.greatest(F.col("end"), F.lit(0)).cast("int") + 1, F.size("a") + 1), lambda v: v != 0)
    usable = (n > 0) & (F.col("full") <= F.col("total") * 0.2) & (F.col("end") - F.col("start") > kernel) & (F.col("level") < 255) & before & beyond
    columns = columns.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = columns.select(*key, "p0", "start", "end", "level", "below", "reach", "usable", F.posexplode("a").alias("i", "v"))
    over = Window.partitionBy(*key).orderBy("i")
    whole = Window.partitionBy(*key)
    upto = over.rowsBetween(Window.unboundedPreceding, 0)
    inside = F.col("usable") & F.col("i").between(F.col("start"), F.col("end"))

    def excess(difference: Column) -> Column:
        kept = (F.col("v") >= 0.5) & (F.col("v") <= 254.5) & inside
        return F.when(kept, F.greatest(F.lit(0.0), F.least(F.col("reach"), difference))).otherwise(0.0)

    rows = rows.withColumn("_d", excess(F.col("level") - F.col("v"))).withColumn("_u", excess(F.col("v") - F.col("below")))
    rows = rows.withColumn("_t", F.sum("_d").over(upto) + F.sum("_u").over(whole) - F.sum("_u").over(upto))
    searched = inside & (F.col("i") <= F.col("end") - 2)
    rows = rows.withColumn("_best", F.min(F.when(searched, F.struct("_t", "i"))).over(whole))
    lowered = F.when(searched, F.col("_t") - F.col("_best._t")).otherwise(F.col("_t"))
    rows = rows.withColumn("_w", F.when(F.col("v") > 254.5, F.lit(0)).otherwise(F.col("v")))
    five = over.rowsBetween(-2, 2)
    mean = F.sum("_w").over(five) / F.nullif(F.sum(F.when(F.col("_w") > 0, 1).otherwise(0)).over(five), F.lit(0)).cast("double")
    rows = rows.withColumn("_t", F.least(F.lit(255.0), lowered)).withColumn("_m", F.when((F.col("i") >= F.col("start") + 1) & (F.col("i") <= F.col("end") - 2), mean))
    # gradient g of step s sits at i = start + s; its means lie two and kernel + two voxels on
    rows = rows.withColumn("_g", F.lead("_m", 1 + kernel).over(over) - F.lead("_m", 1).over(over))
    slot = inside & (F.col("i") <= F.col("end") - kernel)
    rows = rows.withColumn("_g", F.when(slot, F.col("_g")))
    rows = rows.withColumn("_any", F.count("_g").over(whole))
    rows = rows.withColumn("_g", F.when(slot, F.least(F.lit(abs(min_gradient)), F.abs(F.coalesce(F.last("_g", ignorenulls=True).over(upto), F.lit(0.0))))))
    rows = rows.withColumn("_r", F.lag("_g", 4).over(over)).withColumn("_t", F.col("_t") - F.coalesce("_r", F.lit(0.0)))
    rows = rows.withColumn("_lo", F.min(F.when(F.col("_r").isNotNull(), F.col("_t"))).over(whole))
    rows = rows.withColumn("_hi", F.max(F.when(F.col("_r").isNotNull(), F.col("_t"))).over(whole))
    scaled = (F.col("_t") - F.col("_lo")) / F.greatest(F.col("_hi") - F.col("_lo"), F.lit(1.0)) * 255.0
    half = band // 2
    clear = (F.col("_any") > 0) & F.col("_best.i").between(F.col("start") + half, F.col("end") - half)
    shown = inside & clear & (F.col("i") <= F.col("end") - half + 1)
    value = F.when(shown, F.greatest(F.lit(0.0), F.least(F.lit(255.0), scaled))).otherwise(255.0)
    return rows.select(*KEY, third, along, (F.col("p0") + F.col("i")).alias(depth), value.alias("v")).select(*POS, "v")


def resin_cost(vox: DataFrame, depth: str = "y", along: str = "x", top: bool = True, bottom: bool = True, **options) -> DataFrame:
    """Cost of thick slabs: the smaller of the costs seen from both ends."""
    sides = []
    if top:
        sides.append(one_sided_cost(vox, depth, along, **options))
    if bottom:
        turned = one_sided_cost(pixel.invert_axis(vox, depth), depth, along, **options)
        sides.append(pixel.invert_axis(turned, depth))
    return compose.merge_costs(sides)


def cost_volume(vox: DataFrame, sizes: DataFrame, axis_mode: str = "both", steps: dict[str, int] | None = None, depth: str = "y", **options) -> DataFrame:
    """Column cost with slices along x, along z or the smaller of both; black
    voxels cost 255. A subsampled axis is blurred first."""
    steps = steps or {}
    costs = []
    for mode, along in (("x", "x"), ("z", "z")):
        if axis_mode not in (mode, "both"):
            continue
        step = steps.get(along, 1)
        ready = vox
        if step > 1:
            ready = stencils.gauss(vox, {along: math.sqrt(step * step - 0.25)}, "mirror_single", sizes)
            ready = ready.withColumn("v", to_pixel(F.col("v")))
        black = ready.select(*POS, F.col("v").alias("_b"))
        cost = resin_cost(ready, depth, along, **options).join(black, POS)
        costs.append(cost.select(*POS, F.when(F.col("_b") == 0, F.lit(255.0)).otherwise(F.col("v")).alias("v")))
    merged = compose.merge_costs(costs)
    return pixel.subsample(merged, {a: s for a, s in steps.items() if a != depth}).withColumn("v", F.floor("v").cast("long"))


def cost_pyramid(cost: DataFrame, factors: list[dict[str, int]]) -> list[DataFrame]:
    """Cost levels with their own step per axis."""
    return transforms.pyramid_mean(cost, factors)


def initialize_cost(cost: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Cost with constant columns treated as missing and filled from their surroundings."""
    flat = stats.cost_mask(cost)
    holes = cost.join(flat, [*KEY, "y", "x"]).select(*POS, F.when(F.col("m") == 1, F.col("v").cast("double")).alias("v"))
    return stencils.inpaint(holes, max_rounds)


def distance_to_surface(vox: DataFrame, field: DataFrame, scale: float, stretch: float, factor: int = 6, height: str = "h") -> DataFrame:
    """scale / (stretch |z - h| + 0.001), the field being ``factor`` times coarser."""
    spots = vox.select(*POS).withColumns({"_fy": F.expr(f"y div {factor}"), "_fx": F.expr(f"x div {factor}")})
    near = field.select(*KEY, F.col("y").alias("_fy"), F.col("x").alias("_fx"), F.col(height).alias("_h"))
    value = F.lit(float(scale)) / (F.lit(float(stretch)) * F.abs(F.col("z") - F.col("_h")) + F.lit(0.001))
    return spots.join(near, [*KEY, "_fy", "_fx"]).select(*POS, value.alias("v"))
