"""Surfaces through cost volumes: extraction, refinement and edits of height fields.

The minimum-cost surface is found by passing costs along image lines in four
directions (semi-global matching) and taking the best height per column; the
slope limit then holds exactly through a distance envelope. For a single line
of columns the result is the exact optimum.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.operators import stats, stencils, transforms
from voxelframe.schema import KEY
from voxelframe.session import checkpoint, small

XY = [*KEY, "y", "x"]
BLOCKED = 1e9


def cost_columns(cost: DataFrame) -> DataFrame:
    """One array of costs per (x, y) column, in z order, with its first z."""
    packed = cost.groupBy(*XY).agg(F.sort_array(F.collect_list(F.struct("z", F.col("v").cast("double").alias("v")))).alias("s"))
    return packed.select(*XY, F.col("s")[0]["z"].alias("z0"), F.col("s.v").alias("c"))


def _spread(costs: np.ndarray, max_dz: int) -> np.ndarray:
    """Smallest value within max_dz along the last axis."""
    best = costs.copy()
    for d in range(1, max_dz + 1):
        np.minimum(best[..., d:], costs[..., :-d], out=best[..., d:])
        np.minimum(best[..., :-d], costs[..., d:], out=best[..., :-d])
    return best


def _scan(columns: DataFrame, axis: str, max_dz: int, batch: int) -> DataFrame:
    """Cost of the best path to each height from both ends of every line, without the cost itself."""
    side = "y" if axis == "x" else "x"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([axis, side])
        n = rows[axis].nunique()
        cube = np.stack(rows.c.to_numpy()).reshape(n, -1, len(rows.c.iat[0]))
        total = np.zeros_like(cube)
        for order in (range(n), range(n - 1, -1, -1)):
            before = np.zeros_like(cube[0])
            for i in order:
                reached = _spread(before, max_dz)
                # keep numbers small: only differences between heights matter
                reached -= reached.min(axis=1, keepdims=True)
                total[i] += reached
                before = reached + cube[i]
        flat = total.reshape(len(rows), -1)
        return pd.DataFrame({**{k: rows[k].to_numpy() for k in XY}, "p": list(flat)})

    keyed = columns.withColumn("_b", F.floor(F.col(side) / batch))
    return keyed.groupBy(*KEY, "_b").applyInPandas(run, "dataset string, y long, x long, p array<double>")


def limit_slope(field: DataFrame, max_dz: float, value: str = "h") -> DataFrame:
    """Largest surface below ``h`` that changes by at most ``max_dz`` per pixel step."""
    out = field
    for a in ("x", "y"):
        over = stencils.line(out, a)
        up, down = over.rowsBetween(Window.unboundedPreceding, 0), over.rowsBetween(0, Window.unboundedFollowing)
        climb = F.col(a) * F.lit(float(max_dz))
        out = out.withColumn(value, F.least(F.min(F.col(value) - climb).over(up) + climb, F.min(F.col(value) + climb).over(down) - climb))
    return out


def min_surface(cost: DataFrame, max_dz: int, batch: int = 16, within: DataFrame | None = None) -> DataFrame:
    """Minimum-cost surface z(x, y) of every volume with |dz| <= max_dz between
    neighbouring columns. ``within`` (lo, hi per column) restricts the heights.
    Heights come as ``h`` with the cost there."""
    columns = cost_columns(cost)
    if within is not None:
        limited = columns.join(within.select(*XY, "lo", "hi"), XY)
        blocked = F.transform("c", lambda c, i: F.when((i + F.col("z0")).between(F.col("lo"), F.col("hi")), c).otherwise(F.lit(BLOCKED)))
        columns = limited.withColumn("c", blocked).drop("lo", "hi")
    px, py = [_scan(columns, a, max_dz, batch).withColumnRenamed("p", f"p{a}") for a in ("x", "y")]
    total = columns.join(px, XY).join(py, XY)
    add = F.zip_with(F.zip_with("c", "px", lambda a, b: a + b), "py", lambda a, b: a + b)
    total = total.withColumn("_s", add)
    best = F.array_position("_s", F.array_min("_s")) - 1
    found = limit_slope(total.withColumn("h", (best + F.col("z0")).cast("double")), max_dz)
    at = (F.col("h") - F.col("z0")).cast("int")
    return found.select(*XY, "h", F.try_element_at("c", at + 1).alias("cost"))


def surface_pair(cost: DataFrame, max_dz: int, min_distance: int, max_distance: int, batch: int = 16) -> DataFrame:
    """Two surfaces whose distance lies between the limits: the best one, then
    the better of the best ones above and below it, as hmin <= hmax."""
    first = checkpoint(min_surface(cost, max_dz, batch))
    above = min_surface(cost, max_dz, batch, first.select(*XY, (F.col("h") + min_distance).alias("lo"), (F.col("h") + max_distance).alias("hi")))
    below = min_surface(cost, max_dz, batch, first.select(*XY, (F.col("h") - max_distance).alias("lo"), (F.col("h") - min_distance).alias("hi")))
    both = first.select(*XY, "h").join(above.select(*XY, F.col("h").alias("ha"), F.col("cost").alias("ca")), XY)
    both = both.join(below.select(*XY, F.col("h").alias("hb"), F.col("cost").alias("cb")), XY)
    side = both.groupBy(*KEY).agg((F.sum(F.coalesce("ca", F.lit(BLOCKED))) <= F.sum(F.coalesce("cb", F.lit(BLOCKED)))).alias("up"))
    up = F.col("up")
    return both.join(small(side), KEY).select(*XY, F.when(up, F.col("h")).otherwise(F.col("hb")).alias("hmin"),
                                       F.when(up, F.col("ha")).otherwise(F.col("h")).alias("hmax"))


def order_by_mean(a: DataFrame, b: DataFrame, mask: DataFrame) -> DataFrame:
    """Two fields of every volume as hmin and hmax, by their mask-weighted means."""
    both = a.select(*XY, F.col("h").alias("ha")).join(b.select(*XY, F.col("h").alias("hb")), XY).join(mask.select(*XY, "m"), XY)
    means = both.groupBy(*KEY).agg((F.sum(F.col("ha") * F.col("m")) <= F.sum(F.col("hb") * F.col("m"))).alias("ordered"))
    swap = F.col("ordered")
    return both.join(small(means), KEY).select(*XY, F.when(swap, F.col("ha")).otherwise(F.col("hb")).alias("hmin"),
                                        F.when(swap, F.col("hb")).otherwise(F.col("ha")).alias("hmax"), "m")


def initial_surfaces(cost: DataFrame, max_dz: int, min_distance: int, max_distance: int) -> DataFrame:
    """Both surfaces at the coarsest level with their column mask; masked columns are inpainted."""
    mask = stats.cost_mask(cost)
    pair = checkpoint(surface_pair(cost, max_dz, min_distance, max_distance))
    fields = [fill_masked(pair.select(*XY, F.col(c).alias("h")), mask) for c in ("hmin", "hmax")]
    return order_by_mean(fields[0], fields[1], mask)


def fill_masked(field: DataFrame, mask: DataFrame, rounds: int | None = None) -> DataFrame:
    """Replace heights of masked columns (m = 0) from their surroundings."""
    holes = field.join(mask.select(*XY, "m"), XY, "left").select(*XY, F.when(F.coalesce("m", F.lit(0)) != 0, F.col("h")).alias("v"))
    return stencils.inpaint(holes, rounds).withColumnRenamed("v", "h")


def refine_surface(cost: DataFrame, coarse: DataFrame, factors: dict[str, int], padding: int, max_dz: int = 1) -> DataFrame:
    """One refinement step: bring the field to the level of ``cost``, search
    within ``padding`` of it, keep the slope limit and fill masked columns."""
    grid = cost.select(*XY).distinct()
    scale = (float(factors.get("x", 1)), float(factors.get("y", 1)), float(factors.get("z", 1)))
    start = checkpoint(transforms.rescale_height_field(coarse, grid, scale))
    near = cost.join(start.select(*XY, F.col("h").alias("_h")), XY)
    # flatten: heights become offsets from the rescaled field
    offset = near.withColumn("z", F.col("z") - F.floor(F.col("_h") + 0.5)).where(F.col("z").between(-padding, padding))
    depth = F.sequence(F.lit(-padding).cast("long"), F.lit(padding).cast("long"))
    frame = start.select(*XY, F.explode(depth).alias("z"))
    dense = frame.join(offset.select(*XY, "z", "v"), [*XY, "z"], "left").fillna({"v": 255})
    update = checkpoint(min_surface(dense, max_dz))
    moved = start.join(update.select(*XY, F.col("h").alias("_d")), XY).select(*XY, (F.floor(F.col("h") + 0.5) + F.col("_d")).alias("h"))
    return fill_masked(moved, stats.cost_mask(cost))


def surface_average(field: DataFrame, mask: DataFrame) -> DataFrame:
    """Mask-weighted mean height of every volume."""
    return stats.weighted_mean(field.join(mask, XY), KEY, "h", "m")


def validated(field: DataFrame, value: str = "h") -> DataFrame:
    """Fail for a volume whose height field is zero everywhere."""
    empty = field.groupBy(*KEY).agg((F.max(F.abs(value)) == 0).alias("_empty"))
    message = F.concat(F.lit("height field is empty: "), F.col("dataset"))
    checked = F.when(F.col("_empty"), F.raise_error(message).cast("double")).otherwise(F.col(value))
    return field.join(small(empty), KEY).withColumn(value, checked).drop("_empty")


def smooth_height_field(field: DataFrame, sigma: float, sizes: DataFrame, value: str = "hmax") -> DataFrame:
    """Validated field with ``value`` blurred; other columns are copied."""
    checked = validated(field, value)
    smooth = stencils.gauss(checked.select(*XY, F.col(value).alias("v")), {"x": sigma, "y": sigma}, "mirror_single", sizes)
    return checked.drop(value).join(smooth.withColumnRenamed("v", value), XY)


# ---- edits ----------------------------------------------------------------------------------

def brush(edits: DataFrame, field: DataFrame, cell: int = 64) -> DataFrame:
    """Brush weights of edits (seq, y, x, sigma, amount) on the pixels they reach:
    a Gaussian cut at three sigma. Range join on grid cells."""
    reach = F.ceil(F.col("sigma") * 3)
    spread = edits
    for a in ("y", "x"):
        spread = spread.withColumn(f"_c{a}", F.explode(F.sequence(F.floor((F.col(a) - reach) / cell), F.floor((F.col(a) + reach) / cell))))
    spread = spread.withColumnsRenamed({"y": "ey", "x": "ex"})
    spots = field.withColumns({f"_c{a}": F.floor(F.col(a) / cell) for a in ("y", "x")})
    d2 = (F.col("y") - F.col("ey")) * (F.col("y") - F.col("ey")) + (F.col("x") - F.col("ex")) * (F.col("x") - F.col("ex"))
    hit = spots.join(spread, [*KEY, "_cy", "_cx"]).where((F.abs(F.col("y") - F.col("ey")) <= reach) & (F.abs(F.col("x") - F.col("ex")) <= reach))
    return hit.select(*XY, "seq", "amount", F.exp(-d2 / (F.lit(2.0) * F.col("sigma") * F.col("sigma"))).alias("w"))


def push(field: DataFrame, edits: DataFrame, magnitude: float, step: float = 0.1) -> DataFrame:
    """Push or pull (signed amount) the field under brush masks."""
    moved = brush(edits, field).groupBy(*XY).agg(F.sum(F.col("w") * F.col("amount")).alias("_m"))
    return field.join(moved, XY, "left").select(*XY, (F.col("h") + F.coalesce("_m", F.lit(0.0)) * F.lit(step * magnitude)).alias("h"))


def smooth_under(field: DataFrame, edits: DataFrame, sigma: float, sizes: DataFrame, gradient: DataFrame | None = None,
                 low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Blend the field to its blurred version under the brush. With a gradient
    field the blur is weighted: steep places (towards ``high``) count less."""
    if gradient is None:
        blurred = stencils.gauss(field.select(*XY, F.col("h").alias("v")), {"x": sigma, "y": sigma}, "mirror_single", sizes)
    else:
        weight = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(1.0) - (F.col("g") - low) / F.lit(high - low)))
        ready = field.join(gradient, XY).select(*XY, F.col("h").alias("v"), weight.alias("w"))
        blurred = stencils.weighted_gauss(ready, {"x": sigma, "y": sigma}, "w", "mirror_single", sizes).drop("weight")
    mask = brush(edits, field).groupBy(*XY).agg(F.max("w").alias("_l"))
    lam = F.coalesce("_l", F.lit(0.0))
    return field.join(blurred.withColumnRenamed("v", "_b"), XY).join(mask, XY, "left").select(
        *XY, (F.col("h") + lam * (F.col("_b") - F.col("h"))).alias("h"))
