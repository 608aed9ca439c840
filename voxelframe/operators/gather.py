"""Gathers on blocks: read a volume at real positions, one output block at a time.

Every output block knows the box of source voxels that its positions can touch. The boxes name the source
blocks they meet; one join brings these blocks, each cut to the box before it moves, and one numpy kernel reads
all voxels of the output block. What a task holds is one box; no voxel becomes a row.

Output rows are (dataset, gz, gy, gx, z0, y0, x0, nz, ny, nx, data): a grid key, an origin, an extent, a payload.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.operators.blocks import PIECE_ROWS, numpy_type, value_type
from voxelframe.schema import KEY, PIXEL_TYPES, volume_type
from voxelframe.session import measured, small

AXES = ("z", "y", "x")
GRID = ["dataset", "gz", "gy", "gx"]
PLACED = "dataset string, gz long, gy long, gx long, z0 long, y0 long, x0 long, nz long, ny long, nx long, data binary"
DEFAULT = {"z": 64, "y": 64, "x": 64}
# Cells added around a box: positions of corners and of voxels may round differently.
MARGIN = 1


def block_grid(extents: DataFrame, block: dict[str, int], low: dict[str, Column] | None = None) -> DataFrame:
    """Blocks that cover the extents (n* per axis, from ``low``): ``extents`` with g*, origin *0 and size m*."""
    out = extents
    for a in AXES:
        start = (low or {}).get(a, F.lit(0).cast("long"))
        end = start + F.col(f"n{a}").cast("long")
        b = F.lit(block[a]).cast("long")
        first, last = F.floor(start / b), F.floor((end - 1) / b)
        out = out.withColumn(f"_s{a}", start).withColumn(f"_e{a}", end)
        out = out.withColumn(f"g{a}", F.explode(F.when(end > start, F.sequence(first, last))))
        out = out.withColumn(f"{a}0", F.greatest(F.col(f"_s{a}"), F.col(f"g{a}") * b))
        out = out.withColumn(f"m{a}", F.least(F.col(f"_e{a}"), (F.col(f"g{a}") + 1) * b) - F.col(f"{a}0"))
    return out.drop(*[f"_{s}{a}" for a in AXES for s in "se"])


def patches(columns: DataFrame, block: dict[str, int], values: list[str], keys: list[str] = KEY) -> DataFrame:
    """Pixel columns (y, x and values) as one row per face block: gy, gx, origin, extent, ``patch`` (an array of structs)."""
    put = columns.select(*keys, F.floor(F.col("y") / block["y"]).alias("gy"), F.floor(F.col("x") / block["x"]).alias("gx"),
                         F.struct("y", "x", *[F.col(v).cast("double").alias(v) for v in values]).alias("c"))
    out = put.groupBy(*keys, "gy", "gx").agg(F.collect_list("c").alias("patch"))
    for a in ("y", "x"):
        at = F.transform("patch", _field(a))
        out = out.withColumn(f"{a}0", F.array_min(at)).withColumn(f"m{a}", F.array_max(at) - F.array_min(at) + 1)
    return out


def span(low: Column, high: Column) -> tuple[Column, Column]:
    """Cells that positions from ``low`` to ``high`` can read."""
    return F.floor(low) - MARGIN, F.floor(high) + 1 + MARGIN


def read_at(cube: np.ndarray, low: tuple, at: dict[str, np.ndarray], background: float, linear: bool = True) -> np.ndarray:
    """Values of a cube whose first voxel lies at ``low``; integer positions are exact, real ones interpolated
    (or nearest). Beyond the cube lies the background."""
    at = {a: np.asarray(p) for a, p in at.items()}
    if not linear:
        at = {a: p if p.dtype.kind == "i" else np.floor(p + 0.5).astype(np.int64) for a, p in at.items()}
    real = [a for a in AXES if at[a].dtype.kind == "f"]
    base = {a: np.floor(at[a]).astype(np.int64) if a in real else at[a] for a in AXES}
    part = {a: at[a] - base[a] for a in real}
    total = None
    for i in range(1 << len(real)):
        weight = 1.0
        spot = dict(base)
        for bit, a in enumerate(real):
            upper = i >> bit & 1
            weight = weight * (part[a] if upper else 1.0 - part[a])
            spot[a] = base[a] + upper
        inside, index = True, []
        for a, l, n in zip(AXES, low, cube.shape):
            place = spot[a] - l
            inside = inside & (place >= 0) & (place < n)
            index.append(np.clip(place, 0, max(0, n - 1)))
        found = np.where(inside, cube[tuple(index)], background) if cube.size else np.broadcast_to(background, np.broadcast_shapes(*[np.shape(s) for s in spot.values()]))
        term = weight * found if real else found
        total = term if total is None else total + term
    return total


def gather(outputs: DataFrame, blocks: DataFrame, block: dict[str, int], sizes: DataFrame, fill: Callable[[dict, np.ndarray, tuple], np.ndarray],
           background: float = 0.0, dtype: str = "u8", out_dtype: str = "f64", name: str | None = None) -> DataFrame:
    """Output blocks of ``outputs`` (dataset, g*, *0, m*, box l* to h*, ``p``) from ``blocks`` on the grid ``block``.

    ``fill`` gets the row, the cube of the box (absent blocks as background) and the cube's origin, and returns the
    values. ``name`` renames the data set. A box is cut to the volume (``sizes``); one outside it reads background."""
    kind, out_kind = numpy_type(dtype), numpy_type(out_dtype)
    limits = PIXEL_TYPES[out_dtype][1:]
    extents = small(measured(sizes)).select("dataset", *[F.col(f"n{a}").cast("long").alias(f"_n{a}") for a in AXES])
    boxed = outputs.join(extents, KEY)
    for a in AXES:
        boxed = boxed.withColumn(f"l{a}", F.greatest(F.lit(0).cast("long"), F.col(f"l{a}").cast("long"))).withColumn(f"h{a}", F.least(F.col(f"_n{a}") - 1, F.col(f"h{a}").cast("long")))
    boxes = [f"{s}{a}" for a in AXES for s in "lh"]
    boxed = boxed.select(*GRID, *[f"{a}0" for a in AXES], *[f"m{a}" for a in AXES], *boxes, "p")
    near = boxed.select(*GRID, *boxes)
    for a in AXES:
        b = block[a]
        near = near.withColumn(f"s{a}", F.explode(F.when(F.col(f"h{a}") >= F.col(f"l{a}"), F.sequence(F.floor(F.col(f"l{a}") / b), F.floor(F.col(f"h{a}") / b)))))
    source = blocks.select("dataset", *[F.col(f"g{a}").alias(f"s{a}") for a in AXES], *[F.col(f"n{a}").alias(f"b{a}") for a in AXES], "data")
    found = near.join(source, ["dataset", *[f"s{a}" for a in AXES]])

    def cut(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                cube = np.frombuffer(r["data"], dtype=kind).reshape(r["bz"], r["by"], r["bx"])
                origin = [r[f"s{a}"] * block[a] for a in AXES]
                start = [max(r[f"l{a}"], o) for a, o in zip(AXES, origin)]
                stop = [min(r[f"h{a}"] + 1, o + n) for a, o, n in zip(AXES, origin, cube.shape)]
                if all(e > s for s, e in zip(start, stop)):
                    part = cube[tuple(slice(s - o, e - o) for s, e, o in zip(start, stop, origin))]
                    rows.append((*[r[k] for k in GRID], *start, *part.shape, part.tobytes()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 11, [pa.string(), *[pa.int64()] * 9, pa.binary()])],
                                  names=[*GRID, "pz", "py", "px", "cz", "cy", "cx", "data"])

    pieces = found.mapInArrow(cut, "dataset string, gz long, gy long, gx long, pz long, py long, px long, cz long, cy long, cx long, data binary")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in left.to_dict("records"):
            low = tuple(int(r[f"l{a}"]) for a in AXES)
            cube = np.full([max(0, int(r[f"h{a}"]) - l + 1) for a, l in zip(AXES, low)], background)
            for q in right.itertuples(index=False):
                at = [p - l for p, l in zip((q.pz, q.py, q.px), low)]
                cube[at[0]:at[0] + q.cz, at[1]:at[1] + q.cy, at[2]:at[2] + q.cx] = np.frombuffer(q.data, dtype=kind).reshape(q.cz, q.cy, q.cx)
            shape = tuple(int(r[f"m{a}"]) for a in AXES)
            values = np.broadcast_to(fill(r, cube, low), shape)
            if limits[0] is not None:
                values = np.clip(np.floor(values + 0.5), *limits)
            out.append((name or r["dataset"], *[r[f"g{a}"] for a in AXES], *[r[f"{a}0"] for a in AXES], *shape, np.ascontiguousarray(values.astype(out_kind)).tobytes()))
        return pd.DataFrame(out, columns=[f.split()[0] for f in PLACED.split(", ")])

    return boxed.groupBy(*GRID).cogroup(pieces.groupBy(*GRID)).applyInPandas(run, PLACED)


def placed_voxels(placed: DataFrame, dtype: str = "f64", skip: float | None = None) -> DataFrame:
    """Voxel rows of placed blocks, without those of value ``skip``."""
    kind, whole = numpy_type(dtype), value_type(dtype)

    def unpack(batches):
        for batch in batches:
            for r in batch.to_pylist():
                cube = np.frombuffer(r["data"], dtype=kind).reshape(r["nz"], r["ny"], r["nx"])
                step = max(1, PIECE_ROWS // max(1, r["ny"] * r["nx"]))
                for start in range(0, r["nz"], step):
                    part = cube[start:start + step]
                    z, y, x = np.nonzero(part != skip) if skip is not None else [i.ravel() for i in np.indices(part.shape)]
                    cells = [np.full(len(z), r["dataset"], dtype=object), z + start + r["z0"], y + r["y0"], x + r["x0"], part[z, y, x].astype(whole)]
                    yield pa.record_batch([pa.array(c) for c in cells], names=["dataset", "z", "y", "x", "v"])

    return placed.mapInArrow(unpack, volume_type(dtype))


def positions(r: dict) -> dict[str, np.ndarray]:
    """Voxel positions of an output row, as open grids per axis."""
    out = {}
    for i, a in enumerate(AXES):
        shape = [1, 1, 1]
        shape[i] = int(r[f"m{a}"])
        out[a] = (np.arange(int(r[f"m{a}"])) + int(r[f"{a}0"])).reshape(shape)
    return out


def _field(name: str):
    return lambda c: c[name]


def packed(values: list[str], *more: str) -> Column:
    """The patch as one array per value, and other columns, as the payload ``p``."""
    return F.struct(*[F.transform("patch", _field(v)).alias(v) for v in ("y", "x", *values)], *more)


def face(r: dict, values: list[str]) -> dict[str, np.ndarray]:
    """The values of a patch on the pixels of its block, absent pixels as NaN."""
    y, x = [np.asarray(r["p"][a], dtype=np.int64) - int(r[f"{a}0"]) for a in ("y", "x")]
    out = {}
    for v in values:
        grid = np.full((int(r["my"]), int(r["mx"])), np.nan)
        grid[y, x] = r["p"][v]
        out[v] = grid
    return out


# ---- jobs ------------------------------------------------------------------------------

def affine_blocks(blocks: DataFrame, block: dict[str, int], models: DataFrame, sizes: DataFrame, out_block: dict[str, int],
                  background: float = 0.0, linear: bool = True, dtype: str = "u8", out_dtype: str = "f64") -> DataFrame:
    """Volumes under affine models (dataset, m: twelve numbers, output x, y, z to source x, y, z), on their own extents."""
    grid = block_grid(small(measured(sizes)).join(small(models), KEY), out_block)
    for row, a in enumerate(("x", "y", "z")):
        low = high = F.col("m")[4 * row + 3]
        for i, b in enumerate(("x", "y", "z")):
            ends = [F.col("m")[4 * row + i] * F.col(f"{b}0"), F.col("m")[4 * row + i] * (F.col(f"{b}0") + F.col(f"m{b}") - 1)]
            low, high = low + F.least(*ends), high + F.greatest(*ends)
        first, last = span(low, high)
        grid = grid.withColumn(f"l{a}", first).withColumn(f"h{a}", last)

    def fill(r, cube, low):
        at, m = positions(r), np.asarray(r["p"]["m"], dtype=float)
        z, y, x = [at[a].astype(float) for a in AXES]
        moved = {a: m[4 * i] * x + m[4 * i + 1] * y + m[4 * i + 2] * z + m[4 * i + 3] for i, a in enumerate(("x", "y", "z"))}
        return read_at(cube, low, moved, background, linear)

    return gather(grid.withColumn("p", F.struct("m")), blocks, block, sizes, fill, background, dtype, out_dtype)


def _between(part: Column) -> Column:
    return F.transform("patch", lambda c: part * (c["hmax"] - c["hmin"]) + c["hmin"])


def flattened_blocks(blocks: DataFrame, block: dict[str, int], field: DataFrame, planes: DataFrame, sizes: DataFrame, out_block: dict[str, int],
                     dtype: str = "u8") -> DataFrame:
    """Volumes between two surfaces made flat: ``field`` (y, x, hmin, hmax), ``planes`` (low, high, first and last layer)."""
    rows = patches(field, out_block, ["hmin", "hmax"]).join(small(planes.select(*KEY, *[F.col(c).cast("double").alias(c) for c in ("low", "high")], "first", "last")), KEY)
    rows = rows.withColumn("gz", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - F.col("first")) / out_block["z"]))))
    rows = rows.withColumn("z0", F.col("gz") * out_block["z"]).withColumn("mz", F.least(F.lit(out_block["z"]).cast("long"), F.col("last") - F.col("first") + 1 - F.col("z0")))
    ends = []
    for z in (F.col("z0"), F.col("z0") + F.col("mz") - 1):
        part = (z + F.col("first") - F.col("low")) / (F.col("high") - F.col("low"))
        ends.append(_between(part))
    low, high = span(F.least(*[F.array_min(e) for e in ends]), F.greatest(*[F.array_max(e) for e in ends]))
    rows = rows.withColumn("lz", low).withColumn("hz", high)
    for a in ("y", "x"):
        rows = rows.withColumn(f"l{a}", F.col(f"{a}0")).withColumn(f"h{a}", F.col(f"{a}0") + F.col(f"m{a}") - 1)

    def fill(r, cube, low):
        at, p, h = positions(r), r["p"], face(r, ["hmin", "hmax"])
        sz = (at["z"].astype(float) + p["first"] - p["low"]) / (p["high"] - p["low"]) * (h["hmax"] - h["hmin"]) + h["hmin"]
        return read_at(cube, low, {"z": np.nan_to_num(sz, nan=-1e9), "y": at["y"], "x": at["x"]}, 0.0)

    rows = rows.withColumn("p", packed(["hmin", "hmax"], "low", "high", "first"))
    return gather(rows, blocks, block, sizes, fill, 0.0, dtype, "u8")


def mixed_faces_blocks(blocks: DataFrame, block: dict[str, int], faces: DataFrame, placed: DataFrame, sizes: DataFrame, out_block: dict[str, int],
                       z_range: tuple[int, int] | None = None, dtype: str = "u8", name: str | None = None) -> DataFrame:
    """Slabs read through the mix of the transforms of their two faces. ``faces`` (y, x, ax, ay, bx, by) holds the positions
    of pixel columns in both; ``placed`` (top, bot, zoff) says which layers a slab gives and where its first one goes."""
    names = ["ax", "ay", "bx", "by"]
    slabs = placed.select(*KEY, *[F.col(c).cast("long").alias(c) for c in ("top", "bot", "zoff")]).where("bot >= top")
    first, last = F.col("zoff"), F.col("zoff") + F.col("bot") - F.col("top")
    if z_range is not None:
        first, last = F.greatest(first, F.lit(z_range[0])), F.least(last, F.lit(z_range[1]))
    slabs = slabs.withColumn("_a", first.cast("long")).withColumn("_b", last.cast("long")).where("_a <= _b")
    b = out_block["z"]
    slabs = slabs.withColumn("gz", F.explode(F.sequence(F.floor(F.col("_a") / b), F.floor(F.col("_b") / b))))
    slabs = slabs.withColumn("z0", F.greatest("_a", F.col("gz") * b)).withColumn("mz", F.least(F.col("_b"), (F.col("gz") + 1) * b - 1) - F.col("z0") + 1).drop("_a", "_b")
    rows = patches(faces, out_block, names).join(small(slabs), KEY)
    rows = rows.withColumn("lz", F.col("z0") - F.col("zoff") + F.col("top")).withColumn("hz", F.col("lz") + F.col("mz") - 1)
    for a, one, two in (("y", "ay", "by"), ("x", "ax", "bx")):
        both = F.concat(F.transform("patch", _field(one)), F.transform("patch", _field(two)))
        low, high = span(F.array_min(both), F.array_max(both))
        rows = rows.withColumn(f"l{a}", low).withColumn(f"h{a}", high)

    def fill(r, cube, low):
        p, f = r["p"], face(r, names)
        sz = positions(r)["z"] - p["zoff"] + p["top"]
        deep = p["bot"] - p["top"]
        lam = np.maximum(0.0, np.minimum(1.0, (sz - float(p["top"])) / deep)) if deep else np.ones(sz.shape)
        sx, sy = [np.nan_to_num(f[f"a{a}"] + lam * (f[f"b{a}"] - f[f"a{a}"]), nan=-1e9) for a in ("x", "y")]
        return read_at(cube, low, {"z": sz, "y": sy, "x": sx}, 0.0)

    rows = rows.withColumn("p", packed(names, "top", "bot", "zoff"))
    return gather(rows, blocks, block, sizes, fill, 0.0, dtype, "u8", name)
