"""Label volumes: connected regions and distance to the nearest label boundary."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.operators import blocks, border
from voxelframe.operators.solve import components
from voxelframe.operators.stencils import line
from voxelframe.schema import KEY, POS
from voxelframe.session import measured, small

AXES = ("z", "y", "x")


def label_volume(vox: DataFrame, foreground: Column, sizes: DataFrame) -> DataFrame:
    """Connected regions (6 neighbours) of the foreground; a region is named by
    its first voxel number (z, y, x order) plus one, background is 0.

    Runs along x become the graph nodes, so the graph is one image line shorter
    per dimension than the volume."""
    number = (F.col("z") * F.col("ny") + F.col("y")) * F.col("nx") + F.col("x")
    on = vox.where(foreground).join(small(sizes), KEY)
    starts = F.col("x") != F.coalesce(F.lag("x").over(line(on, "x")), F.lit(-2)) + 1
    runs = on.withColumn("first", starts).withColumn("_start", F.when(F.col("first"), number))
    run = F.last("_start", ignorenulls=True).over(line(on, "x").rowsBetween(Window.unboundedPreceding, 0))
    runs = runs.withColumn("node", run).select(*POS, "node")
    edges = None
    for axis in ("z", "y"):
        step = F.lag(F.struct(axis, "node")).over(line(runs, axis))
        touching = runs.withColumn("_p", step).where(F.col("_p")[axis] == F.col(axis) - 1)
        found = touching.select(*KEY, F.col("node").alias("u"), F.col("_p.node").alias("v")).distinct()
        edges = found if edges is None else edges.unionByName(found)
    nodes = runs.select(*KEY, "node").distinct()
    named = components(edges, nodes, KEY)
    labelled = runs.join(named, [*KEY, "node"]).select(*POS, (F.col("component") + 1).alias("label"))
    return vox.select(*POS).join(labelled, POS, "left").select(*POS, F.coalesce("label", F.lit(0)).alias("v"))


def lower_envelope(heights: np.ndarray, first: float, weight: float, length: int) -> np.ndarray:
    """min over k of heights[k] + weight * (i - first - k)^2 for i below ``length``, along the first axis of (sites, lines).

    Parabolas enter a stack from left to right; one that nowhere is the lowest leaves it for good, so the work is
    linear in the sites of a line. Lines advance together. Sites of infinite height take no part."""
    sites, lines = heights.shape
    stack = np.zeros((sites, lines), dtype=np.int32)
    begin = np.full((sites, lines), np.inf)  # from where on a parabola of the stack is the lowest
    top = np.full(lines, -1, dtype=np.int64)
    for k in range(sites):
        new = np.flatnonzero(np.isfinite(heights[k]))
        start = np.full(lines, -np.inf)
        rest = new[top[new] >= 0]
        while len(rest):
            last = stack[top[rest], rest]
            gap = k - last
            meet = first + (k + last) / 2.0 + (heights[k, rest] - heights[last, rest]) / (2.0 * weight * gap)
            lower = meet <= begin[top[rest], rest]
            start[rest] = np.where(lower, -np.inf, meet)
            rest = rest[lower]
            top[rest] -= 1
            rest = rest[top[rest] >= 0]
        top[new] += 1
        stack[top[new], new] = k
        begin[top[new], new] = start[new]
    place, line_ = np.nonzero(np.arange(sites)[:, None] <= top)
    at = np.clip(np.ceil(begin[place, line_]), 0, length).astype(np.int64)
    ruler = np.zeros((length + 1, lines), dtype=np.int64)
    np.maximum.at(ruler, (at, line_), place)
    ruler = np.maximum.accumulate(ruler[:length], axis=0)
    column = np.arange(lines)
    best = stack[ruler, column]
    out = heights[best, column] + weight * (np.arange(length)[:, None] - first - best) ** 2
    return np.where(top >= 0, out, np.inf)


def _on_lines(fn, cube: np.ndarray, axis: int) -> np.ndarray:
    front = np.moveaxis(cube, axis, 0)
    return np.moveaxis(fn(front.reshape(front.shape[0], -1)).reshape(front.shape), 0, axis)


def _from_faces(cube: np.ndarray, axis: int, weight: float) -> np.ndarray:
    """Least height of the faces across ``axis`` (each below its voxel, and the last of the volume) plus distance."""
    def fn(heights):
        return lower_envelope(np.vstack([heights, np.zeros((1, heights.shape[1]))]), -0.5, weight, len(heights))

    return _on_lines(fn, cube, axis)


def _from_edges(cube: np.ndarray, axis: int, weight: float) -> np.ndarray:
    """Least height of the faces along ``axis`` plus distance to their nearer edge: a face counts for its own voxel
    without distance, for others from the edges it shares with its neighbours."""
    def fn(heights):
        if len(heights) == 1:
            return heights
        return np.minimum(heights, lower_envelope(np.minimum(heights[:-1], heights[1:]), 0.5, weight, len(heights)))

    return _on_lines(fn, cube, axis)


# longer than any volume: a block of this side is a bar of whole lines
WHOLE = 1 << 40
BARS = "dataset string, gz long, gy long, gx long, nz long, ny long, nx long, data binary, layer int"


def distance_blocks(layer: border.Layer, resolution: dict[str, float], block: dict[str, int], sizes: DataFrame,
                    tile: int = 32, dtype_limit: int = 65535) -> DataFrame:
    """Distance from every voxel centre to the nearest boundary face, rounded to u16, as blocks of the same grid.

    A face is a boundary between different labels, above a voxel of label 0 and at the volume surface. The squared
    distance is the least of three families, one for the faces across each axis, and each family is closed by one
    envelope an axis. The label blocks become bars of whole lines along x, those bars along y, those bars along z: one
    exchange an axis. A task holds one bar, ``tile`` x ``tile`` lines. Exact for the whole volume."""
    sizes = measured(sizes)
    weights = [float(resolution[a]) ** 2 for a in AXES]
    bars = {a: {b: WHOLE if b == a else tile for b in AXES} for a in AXES}

    def stage(axis: str, kinds: list[tuple], wide: dict[str, int], kernel):
        side, reach = [bars[axis][a] for a in AXES], [wide.get(a, 0) for a in AXES]

        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            cubes, inner, _ = border.assembled(rows, key[1:], kinds, side, reach)
            done = kernel(*cubes, inner)
            return pd.DataFrame([[*key, *c.shape, np.ascontiguousarray(c).tobytes(), i] for i, c in enumerate(done)], columns=columns)

        return run

    columns = [c.split()[0] for c in BARS.split(", ")]
    real = (blocks.numpy_type("f64"), np.inf)

    def along_x(label, inner):
        families = []
        for axis in range(3):
            face = np.ones(label.shape, dtype=bool)
            low, high = [tuple(part if i == axis else slice(None) for i in range(3)) for part in (slice(None, -1), slice(1, None))]
            face[high] = (label[high] != label[low]) | (label[low] == 0)
            families.append(np.where(face[inner], 0.0, np.inf))
        return _from_edges(families[0], 2, weights[2]), _from_edges(families[1], 2, weights[2]), _from_faces(families[2], 2, weights[2])

    def along_y(z, y, x, inner):
        return _from_edges(z, 1, weights[1]), np.minimum(_from_faces(y, 1, weights[1]), _from_edges(x, 1, weights[1]))

    def along_z(z, yx, inner):
        least = np.minimum(_from_faces(z, 0, weights[0]), _from_edges(yx, 0, weights[0]))
        return (np.minimum(dtype_limit, np.floor(np.sqrt(least) + 0.5)).astype(blocks.numpy_type("u16")),)

    grid, near = border.GRID, {"z": 1, "y": 1}
    first = border.pieces([layer], block, near, sizes, True, bars["x"]).groupBy(*grid).applyInPandas(
        stage("x", [(blocks.numpy_type(layer.dtype), layer.background)], near, along_x), BARS)
    second = border.pieces([border.Layer(first, "f64")], bars["x"], {}, sizes, False, bars["y"]).groupBy(*grid).applyInPandas(
        stage("y", [real] * 3, {}, along_y), BARS)
    third = border.pieces([border.Layer(second, "f64")], bars["y"], {}, sizes, False, bars["z"]).groupBy(*grid).applyInPandas(
        stage("z", [real] * 2, {}, along_z), BARS)
    return blocks.reblock(third.drop("layer"), bars["z"], block, sizes, "u16")


def distance_to_boundary(vox: DataFrame, resolution: dict[str, float], sizes: DataFrame, dtype_limit: int = 65535,
                         block: dict[str, int] | None = None) -> DataFrame:
    """``distance_blocks`` of voxel rows, as voxel rows. Labels are below 2^53."""
    block = block or {"z": 64, "y": 64, "x": 64}
    packed = border.Layer(blocks.to_blocks(vox, block, sizes, "f64"), "f64")
    return blocks.to_voxels(distance_blocks(packed, resolution, block, sizes, dtype_limit=dtype_limit), block, "u16")
