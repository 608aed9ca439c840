"""Coordinate transforms and the jobs built on them.

Every transform maps an output position to the source position it reads, so a
resampled volume is: output grid -> coordinate expression -> one gather.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.functions.affine import apply_affine
from voxelframe.functions.scalar import distance_to_interval, fade, half_up, to_pixel
from voxelframe.operators import blocks, gather, pixel, stencils
from voxelframe.operators.resample import interpolate, look_up, nearest
from voxelframe.schema import KEY, POS
from voxelframe.session import measured, small

AXES = ("z", "y", "x")


# ---- volumes through affine models ---------------------------------------------------

def output_grid(sizes: DataFrame, axes: tuple = AXES, keys: list[str] = KEY) -> DataFrame:
    """All voxels of the given extents (n* per axis)."""
    out = sizes
    for a in axes:
        out = out.withColumn(a, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n{a}").cast("long") - 1)))
    return out.select(*keys, *axes)


def affine_targets(grid: DataFrame, models: DataFrame, on: list[str], dim: int = 3) -> DataFrame:
    """Source positions sx, sy[, sz] of grid voxels under a model table."""
    ax = "xyz"[:dim]
    mapped = apply_affine(F.col("m"), [F.col(a).cast("double") for a in ax])
    return grid.join(small(models).select(*on, "m"), on).withColumns({f"s{a}": v for a, v in zip(ax, mapped)}).drop("m")


def resample(vox: DataFrame, targets: DataFrame, background: float = 0.0, linear: bool = True, keys: list[str] = KEY,
             at: dict[str, str] | None = None) -> DataFrame:
    """Volume values at the source positions of the targets."""
    at = at or {a: f"s{a}" for a in AXES}
    read = interpolate if linear else nearest
    return read(targets, vox, at, ["v"], keys, background)


def resample_affine(vox: DataFrame, models: DataFrame, sizes: DataFrame, background: float = 0.0, linear: bool = True,
                    block: dict[str, int] | None = None, dtype: str = "u8") -> DataFrame:
    """Volumes under affine models on their own extents, block by block."""
    block = block or gather.DEFAULT
    packed = blocks.to_blocks(vox, block, sizes, dtype, background)
    return gather.placed_voxels(gather.affine_blocks(packed, block, models, sizes, block, background, linear, dtype))


def coverage_mask(targets: DataFrame, sizes: DataFrame, axes: tuple = AXES, keys: list[str] = KEY) -> DataFrame:
    """1 where the nearest source voxel exists."""
    inside = F.lit(True)
    for a in axes:
        inside = inside & half_up(F.col(f"s{a}")).between(F.lit(0), F.col(f"n{a}") - 1)
    return targets.join(small(sizes), keys).withColumn("mask", F.when(inside, 1).otherwise(0)).drop(*[f"n{a}" for a in AXES])


def render_series(slices: DataFrame, models: DataFrame, bounds: DataFrame, sizes: DataFrame, background: float = 0.0) -> DataFrame:
    """Affine render of a slice series with values and coverage mask; ``bounds``
    (min_x, max_x, min_y, max_y per volume) places the output grid."""
    layers = models.select(*KEY, "z")
    grid = bounds.withColumn("y", F.explode(F.sequence(F.floor("min_y"), F.ceil("max_y"))))
    grid = grid.select(*KEY, "y", F.explode(F.sequence(F.floor("min_x"), F.ceil("max_x"))).alias("x"))
    targets = affine_targets(layers.join(grid, KEY), models, [*KEY, "z"], 2)
    covered = coverage_mask(targets, sizes, ("y", "x"))
    return resample(slices, covered, background, at={"z": "z", "y": "sy", "x": "sx"}).select(*POS, "v", "mask")


def slice_of_stack(position: DataFrame, models: DataFrame, keys: list[str] = KEY, z: str = "z") -> DataFrame:
    """2-D transform of the slice a real z falls on (rounded)."""
    slot = position.withColumn("slot", half_up(F.col(z)).cast("long"))
    chosen = slot.join(models.select(*keys, F.col("z").alias("slot"), "m"), [*keys, "slot"])
    x, y = apply_affine(F.col("m"), [F.col("x"), F.col("y")])
    return chosen.withColumns({"tx": x, "ty": y}).drop("m", "slot")


def render_stack(vox: DataFrame, models: DataFrame, grid: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Slice-stack render between slices: each real z reads its two neighbouring
    slices through their own models; the mask is 1 where the weight is complete."""
    low = F.floor("pz").cast("long")
    both = grid.withColumn("_f", F.col("pz") - low).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    both = both.withColumn("z", low + F.col("side")).withColumn("w", F.when(F.col("side") == 1, F.col("_f")).otherwise(F.lit(1.0) - F.col("_f")))
    placed = affine_targets(both.where("w > 0"), models, [*keys, "z"], 2)
    ready = vox.withColumn("one", F.lit(1.0))
    read = interpolate(placed, ready, {"z": "z", "y": "sy", "x": "sx"}, ["v", "one"], keys)
    sums = read.groupBy(*keys, "k", "y", "x").agg(F.sum(F.col("w") * F.col("v")).alias("v"), F.sum(F.col("w") * F.col("one")).alias("weight"))
    return sums.withColumn("mask", F.when(F.col("weight") >= 0.99999, 1).otherwise(0)).drop("weight")


def resample_integer(vox: DataFrame, targets: DataFrame, matrix: list[int], sizes: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Volume through an integer 3 x 4 matrix (x, y, z rows), mirrored at the border, without interpolation."""
    m = matrix
    out = targets.join(small(sizes), keys)
    for r, a in enumerate(("x", "y", "z")):
        s = F.col("x") * m[r * 4] + F.col("y") * m[r * 4 + 1] + F.col("z") * m[r * 4 + 2] + m[r * 4 + 3]
        period = F.greatest(2 * F.col(f"n{a}") - 2, F.lit(1))
        wrapped = F.pmod(s, period)
        out = out.withColumn(f"s{a}", F.when(wrapped < F.col(f"n{a}"), wrapped).otherwise(period - wrapped))
    source = vox.select(*keys, *[F.col(a).alias(f"s{a}") for a in AXES], "v")
    return out.join(source, [*keys, *[f"s{a}" for a in AXES]]).select(*keys, *AXES, "v")


def split_integer(matrix: Column, n: int = 3) -> Column:
    """The rounded integer part of an affine; the rest is matrix x part^-1."""
    return F.transform(matrix, lambda c: half_up(c).cast("double"))


def non_rigid_targets(grid: DataFrame, model_grid: DataFrame, spacing: dict[str, float], sizes: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Source positions through 3-D affine models on a control grid: the twelve
    coefficients are interpolated at the voxel, then applied to it."""
    names = [f"m{i}" for i in range(12)]
    spots = grid.join(small(sizes).select(*keys, *[F.col(f"n{a}").alias(f"_n{a}") for a in AXES]), keys)
    for a in AXES:
        place = F.col(a).cast("double") / F.lit(float(spacing[a]))
        spots = spots.withColumn(f"g{a}", F.greatest(F.lit(0.0), F.least(place, F.col(f"_n{a}").cast("double") - 1)))
    table = model_grid.select(*keys, *AXES, *[F.col("m")[i].alias(n) for i, n in enumerate(names)])
    read = interpolate(spots, table, {a: f"g{a}" for a in AXES}, names, keys)
    model = F.array(*[F.col(n) for n in names])
    mapped = apply_affine(model, [F.col(a).cast("double") for a in ("x", "y", "z")])
    return read.select(*keys, *AXES, *[v.alias(f"s{a}") for v, a in zip(mapped, ("x", "y", "z"))])


# ---- position and displacement fields ----------------------------------------------------

def field_grid(bounds: DataFrame, scale: float, keys: list[str] = KEY) -> DataFrame:
    """Positions of a field baked over bounds: indices iy, ix and world x, y."""
    out = bounds
    for a in ("y", "x"):
        first, last = F.floor(F.col(f"min_{a}") * scale), F.ceil(F.col(f"max_{a}") * scale)
        out = out.withColumn(f"_o{a}", first).withColumn(f"i{a}", F.explode(F.sequence(F.lit(0).cast("long"), last - first)))
    return out.select(*keys, "iy", "ix", *[((F.col(f"i{a}") + F.col(f"_o{a}")) / F.lit(float(scale))).alias(a) for a in ("x", "y")])


def bake(placed: DataFrame, scale: float, keys: list[str] = KEY) -> DataFrame:
    """Store transformed positions (tx, ty in world units) as a field of that scale."""
    return placed.select(*keys, "iy", "ix", (F.col("tx") * scale).alias("tx"), (F.col("ty") * scale).alias("ty"))


def field_sizes(field: DataFrame, keys: list[str] = KEY) -> DataFrame:
    return measured(field.groupBy(*keys).agg((F.max("iy") + 1).alias("ny"), (F.max("ix") + 1).alias("nx")))


def apply_field(targets: DataFrame, field: DataFrame, scale: float, offset: DataFrame | None = None, keys: list[str] = KEY,
                x: str = "x", y: str = "y", out: tuple = ("tx", "ty"), sizes: DataFrame | None = None) -> DataFrame:
    """Look up world positions in a position field: interp(p * scale - offset) / scale."""
    sizes = field_sizes(field, keys) if sizes is None else sizes
    spots = targets if offset is None else targets.join(small(offset).select(*keys, "off_x", "off_y"), keys)
    off_x, off_y = (F.lit(0.0), F.lit(0.0)) if offset is None else (F.col("off_x"), F.col("off_y"))
    named = field.withColumnsRenamed({"iy": "y", "ix": "x"})
    read = look_up(spots, named, F.col(x) * scale - off_x, F.col(y) * scale - off_y, ["tx", "ty"], sizes, keys, prefix="_l")
    read = read.withColumns({out[0]: F.col("_ltx") / F.lit(float(scale)), out[1]: F.col("_lty") / F.lit(float(scale))})
    return read.drop("_ltx", "_lty", "off_x", "off_y")


def compose_field(affine: DataFrame, field: DataFrame, bounds: DataFrame, scale: float, keys: list[str] = KEY) -> DataFrame:
    """Bake affine-after-nothing-before: positions pass the affine, then the prior field."""
    grid = affine_targets(field_grid(bounds, scale, keys), affine, keys, 2)
    return bake(apply_field(grid, field, scale, keys=keys, x="sx", y="sy"), scale, keys)


def blend_cells(cells: DataFrame, step: int, keys: list[str] = KEY) -> DataFrame:
    """Blend overlapping grid-cell fields, each two steps wide, with tent weights;
    at the low edge the first cell counts fully. One aggregation, no join."""
    weight = F.lit(1.0)
    for a in ("x", "y"):
        g = F.floor(F.col(f"i{a}") / step)
        lam = (F.col(f"i{a}") - g * step) / F.lit(float(step))
        weight = weight * F.when(g == 0, F.when(F.col(f"c{a}") == 0, 1.0).otherwise(0.0)).when(
            F.col(f"c{a}") == g, lam).when(F.col(f"c{a}") == g - 1, F.lit(1.0) - lam).otherwise(0.0)
    return cells.groupBy(*keys, "iy", "ix").agg(F.sum(weight * F.col("tx")).alias("tx"), F.sum(weight * F.col("ty")).alias("ty"))


def displace(targets: DataFrame, field: DataFrame, keys: list[str] = KEY, gain: Column | None = None, scale: float = 1.0) -> DataFrame:
    """y = x + gain * d(x) for a displacement field (rows iy, ix with dx, dy) whose
    samples lie at pixel centres of a grid ``scale`` times coarser."""
    sizes = field_sizes(field, keys)
    named = field.withColumnsRenamed({"iy": "y", "ix": "x"})
    shift = scale * 0.5 - 0.5
    at = [(F.col(a) - F.lit(shift)) / F.lit(float(scale)) for a in ("x", "y")]
    read = look_up(targets, named, at[0], at[1], ["dx", "dy"], sizes, keys, prefix="_l")
    factor = F.lit(float(scale)) * (F.lit(1.0) if gain is None else gain)
    return read.withColumns({"tx": F.col("x") + F.col("_ldx") * factor, "ty": F.col("y") + F.col("_ldy") * factor}).drop("_ldx", "_ldy")


def displace_stacked(targets: DataFrame, first: DataFrame, second: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Two displacement fields, one after the other."""
    once = displace(targets, first, keys).withColumns({"x0": F.col("x"), "y0": F.col("y"), "x": F.col("tx"), "y": F.col("ty")}).drop("tx", "ty")
    twice = displace(once, second, keys)
    return twice.withColumns({"x": F.col("x0"), "y": F.col("y0")}).drop("x0", "y0")


def field_difference(a: DataFrame, b: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Difference of two position fields and its length."""
    other = b.select(*keys, "iy", "ix", F.col("tx").alias("_ux"), F.col("ty").alias("_uy"))
    dx, dy = F.col("_ux") - F.col("tx"), F.col("_uy") - F.col("ty")
    return a.join(other, [*keys, "iy", "ix"]).select(*keys, "iy", "ix", dx.alias("dx"), dy.alias("dy"), F.hypot(dx, dy).alias("length"))


def edit_field(field: DataFrame, edits: DataFrame, keys: list[str] = KEY, cell: int = 64) -> DataFrame:
    """Add moves (x, y, mx, my, sx, sy) to a position field, each weighted by
    un-normalised Gaussian half kernels that end at their kernel size.

    Range join on grid cells: an edit is listed in the cells its kernel touches."""
    reach = {a: F.greatest(F.lit(2), (F.col(f"s{a}") * 3 + 0.5).cast("long") + 1) for a in "xy"}
    spread = edits
    for a in "xy":
        first, last = F.floor((F.col(a) - reach[a]) / cell), F.floor((F.col(a) + reach[a]) / cell)
        spread = spread.withColumn(f"_c{a}", F.explode(F.sequence(first, last)))
    tagged = field.withColumns({f"_c{a}": F.floor(F.col(f"i{a}") / cell) for a in "xy"})
    dist = {a: F.abs(F.col(f"i{a}") - F.col(a)) for a in "xy"}
    hit = tagged.join(spread, [*keys, "_cx", "_cy"]).where((dist["x"] < reach["x"]) & (dist["y"] < reach["y"]))
    w = F.lit(1.0)
    for a in "xy":
        w = w * F.exp(-(dist[a] * dist[a]) / (F.lit(2.0) * F.col(f"s{a}") * F.col(f"s{a}")))
    moved = hit.groupBy(*keys, "iy", "ix").agg(F.sum(w * F.col("mx")).alias("_mx"), F.sum(w * F.col("my")).alias("_my"))
    return field.join(moved, [*keys, "iy", "ix"], "left").select(
        *keys, "iy", "ix", (F.col("tx") + F.coalesce("_mx", F.lit(0.0))).alias("tx"), (F.col("ty") + F.coalesce("_my", F.lit(0.0))).alias("ty"))


def stretch_field(field: DataFrame, line_from: tuple, line_to: tuple, scale: float, down: bool, keys: list[str] = KEY) -> DataFrame:
    """Stretch one side of a line: positions move along its normal by distance x scale."""
    (x1, y1), (x2, y2) = line_from, line_to
    dx, dy = x2 - x1, y2 - y1
    length = math.hypot(dx, dy)
    side = ((F.lit(y1) - F.col("iy")) * dx - (F.lit(x1) - F.col("ix")) * dy) / length
    on_side = side < 0 if down else side > 0
    # the offset from the line to the point is -side times the unit normal (-dy, dx) / length
    px, py = side * (dy / length), side * (-dx / length)
    return field.select(*keys, "iy", "ix", F.when(on_side, F.col("tx") + px * scale).otherwise(F.col("tx")).alias("tx"),
                        F.when(on_side, F.col("ty") + py * scale).otherwise(F.col("ty")).alias("ty"))


# ---- height fields -----------------------------------------------------------------------

def flatten_z(z: Column, hmin: Column, hmax: Column, low: Column, high: Column) -> Column:
    return (z - hmin) / (hmax - hmin) * (high - low) + low


def unflatten_z(z: Column, hmin: Column, hmax: Column, low: Column, high: Column) -> Column:
    return (z - low) / (high - low) * (hmax - hmin) + hmin


def shift_to_surface(z: Column, height: Column, offset: float = 0.0) -> Column:
    return z - height + F.lit(float(offset))


def shift_from_surface(z: Column, height: Column, offset: float = 0.0) -> Column:
    return z + height - F.lit(float(offset))


def scale_height_values(height: Column, scale: float, offset: float = 0.0) -> Column:
    """Pixel-centre rule for heights between scale levels."""
    return (height + F.lit(offset + 0.5)) * F.lit(float(scale)) - F.lit(0.5)


def rescale_height_field(field: DataFrame, targets: DataFrame, scale: tuple, value: str = "h", keys: list[str] = KEY) -> DataFrame:
    """Height field read on another grid: values and xy follow the pixel-centre rule."""
    sx, sy, sz = scale
    sizes = measured(field.groupBy(*keys).agg((F.max("y") + 1).alias("ny"), (F.max("x") + 1).alias("nx")))
    ready = field.select(*keys, "y", "x", scale_height_values(F.col(value), sz).alias(value))
    at = [(F.col(a) - F.lit(s * 0.5 - 0.5)) / F.lit(float(s)) for a, s in (("x", sx), ("y", sy))]
    return look_up(targets.select(*keys, "y", "x"), ready, at[0], at[1], [value], sizes, keys)


def flatten_volume(vox: DataFrame, field: DataFrame, averages: DataFrame, padding: float, sizes: DataFrame | None = None,
                   block: dict[str, int] | None = None) -> DataFrame:
    """Volume between two surfaces made flat. ``averages`` (low, high) are the target planes; the output covers
    round(low - padding) .. round(high + padding). Voxels are packed into blocks first; volumes that are stored as
    blocks go to ``gather.flattened_blocks`` as they are."""
    block = block or gather.DEFAULT
    sizes = pixel.extents(vox) if sizes is None else measured(sizes)
    placed = gather.flattened_blocks(blocks.to_blocks(vox, block, sizes), block, field, flat_planes(averages, padding), sizes, block)
    return gather.placed_voxels(placed, "u8")


def flat_planes(averages: DataFrame, padding: float) -> DataFrame:
    """Target planes with the first and last layer of the output."""
    checked = averages.withColumn("low", F.when(F.col("low") >= F.col("high"), F.raise_error(F.lit("lower surface must lie below the upper one")).cast("double")).otherwise(F.col("low")))
    return checked.withColumn("first", half_up(F.col("low") - padding)).withColumn("last", half_up(F.col("high") + padding))


def extend_height_field(targets: DataFrame, field: DataFrame, average: Column, plane: tuple, fade_to_plane: float,
                        fade_to_average: float, sizes: DataFrame, keys: list[str] = KEY, value: str = "h") -> DataFrame:
    """Heights beyond the field: the border residual fades to the plane, the plane to the average."""
    a, b, c = plane

    def plane_at(x: Column, y: Column) -> Column:
        return x * F.lit(float(a)) + y * F.lit(float(b)) + F.lit(float(c))

    extent = small(sizes).select(*keys, F.col("nx").alias("_nx"), F.col("ny").alias("_ny"))
    spots = targets.join(extent, keys)
    spots = spots.withColumns({f"_b{d}": F.greatest(F.lit(0).cast("long"), F.least(F.col(d), F.col(f"_n{d}") - 1)) for d in ("x", "y")})
    border = field.select(*keys, F.col("y").alias("_by"), F.col("x").alias("_bx"), (F.col(value) - plane_at(F.col("x"), F.col("y"))).alias("_rest"))
    out = spots.join(border, [*keys, "_by", "_bx"])

    def weight(dist: float) -> Column:
        parts = [distance_to_interval(F.col(d).cast("double"), F.lit(0.0), F.col(f"_n{d}") - 1.0) * F.lit(4.0 / dist) for d in ("x", "y")]
        return fade(parts[0] * parts[0] + parts[1] * parts[1])

    height = average + (F.col("_rest") * weight(fade_to_plane) + plane_at(F.col("x"), F.col("y")) - average) * weight(fade_to_average)
    return out.select(*targets.columns, height.alias(value))


def extended_flatten_z(z: Column, unflattened: Column, low: float, high: float, fade_distance: float) -> Column:
    """Inverse flattening inside, identity above ``high``, fading to identity below ``low``."""
    d = (F.lit(float(low)) - z) * F.lit(4.0 / fade_distance)
    return F.when(z > high, z).when(z > low, unflattened).otherwise(fade(d * d) * (unflattened - z) + z)


def interval_shift(position: list[Column], box: list[tuple], shift: list[float], reach: list[float]) -> list[Column]:
    """Shift a box by -shift; around it the shift falls off like a Gaussian."""
    total = F.lit(0.0)
    for p, (low, high), r in zip(position, box, reach):
        d = distance_to_interval(p, float(low), float(high)) / F.lit(float(r))
        total = total + d * d
    return [p - fade(total) * F.lit(float(s)) for p, s in zip(position, shift)]


def plane_interval_shift(position: list[Column], box: list[tuple], shift: list[float], reach: list[float], ortho: int) -> list[Column]:
    """Like ``interval_shift``, with a squared linear fall-off on one axis."""
    total, along = F.lit(0.0), None
    for i, (p, (low, high), r) in enumerate(zip(position, box, reach)):
        d = distance_to_interval(p, float(low), float(high)) / F.lit(float(r))
        if i == ortho:
            along = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(1.0) - d))
        else:
            total = total + d * d
    return [p - along * along * fade(total) * F.lit(float(s)) for p, s in zip(position, shift)]


def drag(targets: DataFrame, edits: DataFrame, min_sigma: float, gain: float, keys: list[str] = KEY) -> DataFrame:
    """Point drags in order: x + exp(-|x - end|^2 / 2 sigma^2) (start - end) for every
    edit (seq, sx, sy, ex, ey). The edits of one volume travel as one array."""
    size = F.hypot(F.col("sx") - F.col("ex"), F.col("sy") - F.col("ey"))
    entry = F.struct("seq", "sx", "sy", "ex", "ey", F.greatest(F.lit(float(min_sigma)), size * F.lit(float(gain))).alias("sigma"))
    lists = edits.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_edits"))

    def step(p: Column, e: Column) -> Column:
        dx, dy = p["x"] - e["ex"], p["y"] - e["ey"]
        w = F.exp(-(dx * dx + dy * dy) / (F.lit(2.0) * e["sigma"] * e["sigma"]))
        return F.struct((p["x"] + w * (e["sx"] - e["ex"])).alias("x"), (p["y"] + w * (e["sy"] - e["ey"])).alias("y"))

    start = F.struct(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    moved = targets.join(small(lists), keys, "left").withColumn("_p", F.coalesce(F.aggregate("_edits", start, step), start))
    return moved.withColumns({"tx": F.col("_p.x"), "ty": F.col("_p.y")}).drop("_p", "_edits")


def transition(targets: DataFrame, top: DataFrame, bottom: DataFrame, z: Column, z_top: Column, z_bottom: Column,
               scale: float = 1.0, keys: list[str] = KEY) -> DataFrame:
    """Mix the transforms of the top and bottom face linearly along z, clipped at both faces."""
    return mix_faces(face_positions(targets, top, bottom, scale, keys), z, z_top, z_bottom)


def face_positions(targets: DataFrame, top: DataFrame, bottom: DataFrame, scale: float = 1.0, keys: list[str] = KEY) -> DataFrame:
    """Positions of the targets in both faces (ax, ay and bx, by). The two fields
    share their grid, so one look-up serves both; it does not depend on z."""
    other = bottom.select(*keys, "iy", "ix", F.col("tx").alias("bx"), F.col("ty").alias("by"))
    both = top.select(*keys, F.col("iy").alias("y"), F.col("ix").alias("x"), F.col("tx").alias("ax"), F.col("ty").alias("ay")).join(
        other.withColumnsRenamed({"iy": "y", "ix": "x"}), [*keys, "y", "x"])
    at = [F.col(a) * F.lit(float(scale)) for a in ("x", "y")]
    read = look_up(targets, both, *at, ["ax", "ay", "bx", "by"], field_sizes(top, keys), keys)
    return read.withColumns({c: F.col(c) / F.lit(float(scale)) for c in ("ax", "ay", "bx", "by")})


def mix_faces(placed: DataFrame, z: Column, z_top: Column, z_bottom: Column) -> DataFrame:
    lam = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (z - z_top) / (z_bottom - z_top)))
    return placed.withColumns({
        "sx": F.col("ax") + lam * (F.col("bx") - F.col("ax")),
        "sy": F.col("ay") + lam * (F.col("by") - F.col("ay"))}).drop("ax", "ay", "bx", "by")


# ---- pyramids and faces ---------------------------------------------------------------------

def pyramid_gauss(vox: DataFrame, levels: int, sizes: DataFrame, axes: tuple = AXES) -> list[DataFrame]:
    """Scale levels by factor two: blur by sqrt(0.25 step^2 - 0.25), then subsample.
    An odd last sample is dropped, as every level has half the size."""
    sigma = math.sqrt(0.25 * 2 * 2 - 0.25)
    out, level, extent = [], vox.withColumn("v", F.col("v").cast("double")), sizes
    for _ in range(levels):
        smooth = stencils.gauss(level, {a: sigma for a in axes}, "mirror_single", extent)
        extent = measured(extent.select(*KEY, *[(F.expr(f"n{a} div 2") if a in axes else F.col(f"n{a}")).alias(f"n{a}") for a in AXES]))
        level = pixel.subsample(smooth, {a: 2 for a in axes}).join(small(extent), KEY)
        keep = F.lit(True)
        for a in AXES:
            keep = keep & (F.col(a) < F.col(f"n{a}"))
        level = level.where(keep).select(*POS, "v")
        out.append(level)
    return out


def pyramid_mean(vox: DataFrame, factors: list[dict[str, int]], integer: bool = True) -> list[DataFrame]:
    """Scale levels by block averages, each from the previous level; integers round half up."""
    out, level = [], vox
    for f in factors:
        cell = [F.expr(f"{a} div {f.get(a, 1)}").alias(a) for a in AXES]
        mean = half_up(F.avg("v")).cast("long") if integer else F.avg("v")
        level = level.groupBy(*KEY, *cell).agg(mean.alias("v"))
        out.append(level)
    return out


def extract_face(vox: DataFrame, low: dict[str, int], size: dict[str, int]) -> DataFrame:
    """Layer 0 of a region (a negative size counts backwards), as reals."""
    region = pixel.crop(vox, low, size)
    return pixel.hyperslice(region, "z", 0).withColumn("v", F.col("v").cast("double"))


def warp_phase_out(vox: DataFrame, field: DataFrame, sizes: DataFrame, first: int, last: int, scale: float = 1.0,
                   linear: bool = True) -> DataFrame:
    """Slice i of n moves by (n - i) / n of a displacement field; a descending range fades the other way."""
    n = abs(last - first) + 1
    rank = F.col("z") - first if first <= last else F.lit(first) - F.col("z")
    lam = (F.lit(n) - rank) / F.lit(float(n))
    grid = output_grid(sizes).where(F.col("z").between(min(first, last), max(first, last)))
    moved = displace(grid, field, gain=lam, scale=scale)
    if linear:
        return interpolate(moved, vox, {"z": "z", "y": "ty", "x": "tx"}, ["v"]).select(*POS, "v")
    return nearest(moved, vox, {"z": "z", "y": "ty", "x": "tx"}, ["v"]).select(*POS, "v")
