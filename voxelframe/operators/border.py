"""Neighbourhood operators on blocks: every block borrows a border from its neighbours.

A block row sends its payload to its own key and, to each neighbour whose border it meets, only the part inside
that border: faces, edges and corners. One shuffle brings the parts together; a kernel on arrays then works on the
block with its border, cut at the volume, and what it returns is cut back to the block. No voxel becomes a row, and
a task holds one block with its border. The extent of a border may exceed a block. Blocks without a row read as
background and get a row, unless ``dense`` is off: then only blocks that meet stored ones do.

Kernels treat an end of the array as an end of the volume. Where it is the end of a border instead, the wrong values
reach no further than the border is wide, and are cut off.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.operators.blocks import numpy_type, reblock
from voxelframe.operators.gather import block_grid
from voxelframe.operators.stencils import half_kernel
from voxelframe.schema import BLOCKS, KEY, PIXEL_TYPES
from voxelframe.session import checkpoint, measured, small

AXES = ("z", "y", "x")
GRID = ["dataset", "gz", "gy", "gx"]
_PLACES = [f"{s}{a}" for s in "pme" for a in AXES]  # global origin, size, extent of the volume
PIECES = ", ".join(["dataset string", *[f"g{a} long" for a in AXES], "layer int", *[f"{p} long" for p in _PLACES], "aside double", "data binary"])
_ARROW = [pa.string(), *[pa.int64()] * 3, pa.int32(), *[pa.int64()] * 9, pa.float64(), pa.binary()]
_NAMES = [f.split()[0] for f in PIECES.split(", ")]
# numpy names of the borders of volumes
MODES = {"mirror_single": "reflect", "mirror_double": "symmetric", "border": "edge"}


class Layer:
    """Blocks that take part in a kernel, with their pixel type and the value of absent voxels."""

    def __init__(self, blocks: DataFrame, dtype: str = "u8", background: float = 0):
        self.blocks, self.dtype, self.background = blocks, dtype, background


def pieces(layers: list[Layer], block: dict[str, int], halo: dict[str, int], sizes: DataFrame, dense: bool = True,
           target: dict[str, int] | None = None) -> DataFrame:
    """Parts of all layers' blocks under the keys of the blocks that need them, on the grid ``target`` (else the same).
    A layer whose rows name their own number (``layer``) holds several of the same pixel type."""
    source, side = [block[a] for a in AXES], [(target or block)[a] for a in AXES]
    wide = [halo.get(a, 0) for a in AXES]
    aside = F.col("aside").cast("double") if "aside" in sizes.columns else F.lit(0.0)
    sizes = measured(sizes)
    extents = small(sizes).select("dataset", *[F.col(f"n{a}").cast("long").alias(f"e{a}") for a in AXES], aside.alias("aside"))

    def cut(number: int, kind: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    cube = np.frombuffer(r["data"], dtype=kind).reshape(r["nz"], r["ny"], r["nx"])
                    extent = [r[f"e{a}"] for a in AXES]
                    low = [r[f"g{a}"] * b for a, b in zip(AXES, source)]
                    high = [min(e, l + n) for e, l, n in zip(extent, low, cube.shape)]
                    if any(h <= l for l, h in zip(low, high)):
                        continue
                    spans = [range(max(0, (l - w) // b), min((e - 1) // b, (h - 1 + w) // b) + 1) for l, h, w, b, e in zip(low, high, wide, side, extent)]
                    rows = []
                    for g in ((gz, gy, gx) for gz in spans[0] for gy in spans[1] for gx in spans[2]):
                        first = [max(l, i * b - w) for l, i, b, w in zip(low, g, side, wide)]
                        last = [min(h, (i + 1) * b + w) for h, i, b, w in zip(high, g, side, wide)]
                        part = cube[tuple(slice(f - l, t - l) for f, t, l in zip(first, last, low))]
                        rows.append((r["dataset"], *g, r.get("layer", number), *first, *part.shape, *extent, r["aside"], part.tobytes()))
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names=_NAMES)

        return run

    out = None
    for number, layer in enumerate(layers):
        part = layer.blocks.select(*BLOCKS.names, *[c for c in ("layer",) if c in layer.blocks.columns]).join(extents, KEY).mapInArrow(cut(number, numpy_type(layer.dtype)), PIECES)
        out = part if out is None else out.unionByName(part)
    if dense:
        none = [F.lit(0).cast("long").alias(p) for p in _PLACES[:6]]
        cells = block_grid(sizes.select(*KEY, *[f"n{a}" for a in AXES]), target or block).select(*GRID).join(extents, KEY)
        out = out.unionByName(cells.select(*GRID, F.lit(0).alias("layer"), *none, *_PLACES[6:], "aside", F.unhex(F.lit("")).alias("data")))
    return out


def assembled(rows: pd.DataFrame, g: tuple, layers: list[tuple], side: list[int], wide: list[int]):
    """Arrays of all layers with their border, the place of the block in them, and their global origin."""
    extent = [int(rows[f"e{a}"].iat[0]) for a in AXES]
    inner = [(i * b, min(e, (i + 1) * b)) for i, b, e in zip(g, side, extent)]
    low = [max(0, l - w) for (l, _), w in zip(inner, wide)]
    high = [min(e, h + w) for (_, h), w, e in zip(inner, wide, extent)]
    cubes = [np.full([h - l for l, h in zip(low, high)], background, dtype=kind) for kind, background in layers]
    for r in rows.itertuples(index=False):
        if r.mz:
            at = [p - l for p, l in zip((r.pz, r.py, r.px), low)]
            cubes[r.layer][at[0]:at[0] + r.mz, at[1]:at[1] + r.my, at[2]:at[2] + r.mx] = np.frombuffer(r.data, dtype=layers[r.layer][0]).reshape(r.mz, r.my, r.mx)
    return cubes, tuple(slice(a - l, b - l) for (a, b), l in zip(inner, low)), low


def map_bordered(layers: list[Layer], fn: Callable[..., np.ndarray], block: dict[str, int], halo: dict[str, int], sizes: DataFrame,
                 out_dtype: str = "f64", dense: bool = True, placed: bool = False, step: dict[str, int] | None = None) -> DataFrame:
    """Blocks of ``fn`` over the layers' arrays, each with a border of ``halo`` voxels where the volume goes on.

    ``fn`` returns an array of the shape it got. Integer results are rounded half up and clamped. With ``placed`` it also
    gets the array's origin ``low`` and the volume's value ``aside`` (a column of ``sizes``). ``step`` keeps every so many
    voxels of a block; the sides of blocks are multiples of it, and an incomplete last step is dropped."""
    side, wide = [block[a] for a in AXES], [halo.get(a, 0) for a in AXES]
    if step and any(block[a] % step[a] for a in AXES):
        raise ValueError(f"sides of blocks {block} are no multiples of {step}")
    kinds = [(numpy_type(l.dtype), l.background) for l in layers]
    out_kind, (least, most) = numpy_type(out_dtype), PIXEL_TYPES[out_dtype][1:]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cubes, inner, low = assembled(rows, key[1:], kinds, side, wide)
        out = fn(*cubes, {"low": low, "aside": rows.aside.iat[0]})[inner] if placed else fn(*cubes)[inner]
        if step:
            out = out[tuple(slice(0, (s.stop - s.start) // step[a] * step[a], step[a]) for a, s in zip(AXES, inner))]
            if not out.size:
                return pd.DataFrame([], columns=BLOCKS.names)
        if least is not None:
            out = np.clip(np.floor(out + 0.5), least, most)
        return pd.DataFrame([[*key, *out.shape, np.ascontiguousarray(out.astype(out_kind)).tobytes()]], columns=BLOCKS.names)

    return pieces(layers, block, halo, sizes, dense).groupBy(*GRID).applyInPandas(run, BLOCKS)


def scan_bordered(layers: list[Layer], fn: Callable[..., tuple[np.ndarray, dict[str, np.ndarray]]], columns: list[str], block: dict[str, int],
                  halo: dict[str, int], sizes: DataFrame, dense: bool = False) -> DataFrame:
    """Rows of the voxels that ``fn`` picks: it returns a boolean array and one real array per column.

    ``columns`` named p and an axis are offsets from the voxel and become positions."""
    side, wide = [block[a] for a in AXES], [halo.get(a, 0) for a in AXES]
    kinds = [(numpy_type(l.dtype), l.background) for l in layers]
    schema = ", ".join(["dataset string", *[f"{a} long" for a in AXES], *[f"{c} double" for c in columns]])

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cubes, inner, low = assembled(rows, key[1:], kinds, side, wide)
        picked, values = fn(*cubes)
        at = np.nonzero(picked[inner])
        spot = {a: i + s.start + l for a, i, s, l in zip(AXES, at, inner, low)}
        shift = {f"p{a}": spot[a] for a in AXES}
        return pd.DataFrame({"dataset": key[0], **spot, **{c: values[c][inner][at] + shift.get(c, 0) for c in columns}})

    return pieces(layers, block, halo, sizes, dense).groupBy(*GRID).applyInPandas(run, schema)


# ---- kernels on arrays ---------------------------------------------------------------

def _along(cube: np.ndarray, axis: int, start: int, stop: int | None) -> np.ndarray:
    return cube[tuple(slice(start, stop) if i == axis else slice(None) for i in range(3))]


def _padded(cube: np.ndarray, axis: int, reach: int, border: str, outside: float = 0.0) -> np.ndarray:
    width = [(reach, reach) if i == axis else (0, 0) for i in range(3)]
    if border in ("constant", "zero"):
        return np.pad(cube, width, constant_values=outside if border == "constant" else 0)
    return np.pad(cube, width, mode="edge" if cube.shape[axis] == 1 else MODES[border])


def smoothed(cube: np.ndarray, sigmas: dict[str, float], border: str = "mirror_single", outside: float = 0.0) -> np.ndarray:
    """Separable Gaussian of an array, axis by axis in the order given."""
    out = cube.astype(float)
    for a, sigma in sigmas.items():
        if sigma > 0:
            axis, kernel = AXES.index(a), half_kernel(sigma)
            reach, n = len(kernel) - 1, cube.shape[AXES.index(a)]
            full = _padded(out, axis, reach, border, outside)
            out = _along(full, axis, reach, reach + n) * kernel[0]
            for i in range(1, reach + 1):
                out += (_along(full, axis, reach - i, reach - i + n) + _along(full, axis, reach + i, reach + i + n)) * kernel[i]
    return out


def difference(cube: np.ndarray, axis: int) -> np.ndarray:
    """v(i + 1) - v(i - 1), with end values repeated."""
    full = _padded(cube, axis, 1, "border")
    return _along(full, axis, 2, None) - _along(full, axis, 0, -2)


def box(cube: np.ndarray, reach: dict[str, int]) -> np.ndarray:
    """Sums over 2 reach + 1 values an axis, cut at the ends, from running sums."""
    out = cube
    for a, r in reach.items():
        axis, n = AXES.index(a), cube.shape[AXES.index(a)]
        total = np.concatenate([np.zeros_like(_along(out, axis, 0, 1)), np.cumsum(out, axis=axis)], axis=axis)
        at = np.arange(n)
        out = np.take(total, np.minimum(at + r + 1, n), axis=axis) - np.take(total, np.maximum(at - r, 0), axis=axis)
    return out


def _reaches(sigmas: dict[str, float]) -> dict[str, int]:
    return {a: len(half_kernel(s)) - 1 if s > 0 else 0 for a, s in sigmas.items()}


# ---- operators -----------------------------------------------------------------------

def gauss(layer: Layer, sigmas: dict[str, float], block: dict[str, int], sizes: DataFrame, border: str = "mirror_single",
          outside: float = 0.0, out_dtype: str = "f64") -> DataFrame:
    """Separable Gaussian with one sigma per axis (0 or absent leaves the axis alone); all axes take one exchange."""
    return map_bordered([layer], lambda v: smoothed(v, sigmas, border, outside), block, _reaches(sigmas), sizes, out_dtype)


def weighted_gauss(layer: Layer, weight: Layer, sigmas: dict[str, float], block: dict[str, int], sizes: DataFrame,
                   border: str = "mirror_single", out_dtype: str = "f64") -> DataFrame:
    """G(v w) / G(w); where no weight is near, the source value stays."""
    def fn(v, w):
        v, w = v.astype(float), w.astype(float)
        below = smoothed(w, sigmas, border)
        return np.where(below != 0, smoothed(v * w, sigmas, border) / np.where(below != 0, below, 1.0), v)

    return map_bordered([layer, weight], fn, block, _reaches(sigmas), sizes, out_dtype)


def local_contrast(layer: Layer, rx: int, ry: int, block: dict[str, int], sizes: DataFrame, factor: float = 3.0, limit: float = 10.0,
                   gamma: float = 1.0, center: bool = True, stretch: bool = True, keep_min_max: bool = False, low: float = 0.0,
                   high: float = 255.0, cut: bool = False, out_dtype: str = "f64") -> DataFrame:
    """Mean and deviation of a box brought to the value range, as ``stencils.local_contrast``; ``cut`` limits the
    result to the range (classic contrast). Sums of integer pixels are exact."""
    span, reach = high - low, {"x": rx, "y": ry}
    middle = low + span / 2

    def fn(cube):
        whole = cube.astype(np.int64 if cube.dtype.kind in "iu" else float)
        n, s1, s2 = [box(c, reach).astype(float) for c in (np.ones_like(whole), whole, whole * whole)]
        v, mean = whole.astype(float), s1 / n
        d = np.sqrt(np.maximum(n * s2 - s1 * s1, 0.0) / np.where(n > 1, n * (n - 1), 1.0)) * factor
        flat = (d == 0) | (n <= 1)
        d = np.where(flat, 1.0, d)
        if not stretch:
            out = v - mean + middle if center else v
        elif gamma == 1:
            shift, base = (mean - d, low) if center else (middle, middle)
            out = np.where(flat, low, (v - shift) / 2.0 / d * span + base)
        else:
            gain, joint = span / d, gamma ** (-1.0 / (gamma - 1.0))
            bent = np.power(np.maximum(gain + (joint - limit), 0.0), gamma) + (limit - joint ** gamma)
            gain = 0.5 * np.where(gain < limit, gain, bent)
            if center:
                out = np.where(flat, low, (v - mean) * gain + 0.5 * span + low)
                out = np.where((v == low) | (v == high), v, out) if keep_min_max else out
            else:
                out = np.where(flat, middle, (v - middle) * gain * span + middle)
        return np.clip(out, low, high) if cut else out

    return map_bordered([layer], fn, block, reach, sizes, out_dtype)


def median_z3(layer: Layer, outside: float, block: dict[str, int], sizes: DataFrame, out_dtype: str = "f64") -> DataFrame:
    """Median of each voxel and its two z neighbours; beyond the volume the outside value counts."""
    def fn(cube):
        full = _padded(cube.astype(float), 0, 1, "constant", outside)
        return np.median(np.stack([full[:-2], full[1:-1], full[2:]]), axis=0)

    return map_bordered([layer], fn, block, {"z": 1}, sizes, out_dtype)


def gradient_forward(layer: Layer, axis: str, block: dict[str, int], sizes: DataFrame, out_dtype: str = "f64") -> DataFrame:
    """v(i + 1) - v(i), with the border value repeated."""
    at = AXES.index(axis)
    return map_bordered([layer], lambda v: np.diff(_padded(v.astype(float), at, 1, "border"), axis=at).take(range(1, v.shape[at] + 1), axis=at),
                        block, {axis: 1}, sizes, out_dtype)


def gradient_center(layer: Layer, axis: str, sigma: float, block: dict[str, int], sizes: DataFrame, out_dtype: str = "f64") -> DataFrame:
    """(v(i + 1) - v(i - 1)) * 2 / sigma."""
    return map_bordered([layer], lambda v: difference(v.astype(float), AXES.index(axis)) * (2.0 / sigma), block, {axis: 1}, sizes, out_dtype)


def gradient_magnitude(layer: Layer, block: dict[str, int], sizes: DataFrame, out_dtype: str = "f64") -> DataFrame:
    """Length of the central gradient."""
    def fn(cube):
        v = cube.astype(float)
        return np.sqrt(sum((difference(v, axis) / 2.0) ** 2 for axis in (0, 1, 2)))

    return map_bordered([layer], fn, block, {a: 1 for a in AXES}, sizes, out_dtype)


def tubeness(layer: Layer, sigmas: dict[str, float], block: dict[str, int], sizes: DataFrame, out_dtype: str = "f64") -> DataFrame:
    """Tube response from the Hessian's two strongest eigenvalues, as ``stencils.tubeness``; 0 where their signs differ."""
    def fn(cube):
        first = {a: difference(cube.astype(float), AXES.index(a)) * (2.0 / sigmas[a]) for a in AXES}
        h = {d + e: difference(first[e], AXES.index(d)) * (sigmas[e] / 2.0) for d, e in ("xx", "xy", "xz", "yy", "yz", "zz")}
        q = (h["xx"] + h["yy"] + h["zz"]) / 3.0
        a, b, c = h["xx"] - q, h["yy"] - q, h["zz"] - q
        p = np.sqrt((a * a + b * b + c * c + 2.0 * (h["xy"] ** 2 + h["xz"] ** 2 + h["yz"] ** 2)) / 6.0)
        det = a * (b * c - h["yz"] ** 2) - h["xy"] * (h["xy"] * c - h["yz"] * h["xz"]) + h["xz"] * (h["xy"] * h["yz"] - b * h["xz"])
        angle = np.arccos(np.clip(np.where(p != 0, det / np.where(p != 0, 2.0 * p * p * p, 1.0), 1.0), -1.0, 1.0)) / 3.0
        top, bottom = q + 2.0 * p * np.cos(angle), q + 2.0 * p * np.cos(angle + 2.0 * math.pi / 3.0)
        values = np.stack([top, 3.0 * q - top - bottom, bottom])
        least, middle, strong = np.take_along_axis(values, np.argsort(np.abs(values), axis=0), axis=0)
        same = ((strong < 0) & (middle < 0)) | ((strong > 0) & (middle > 0))
        product = np.abs(strong) * (np.abs(middle) - np.abs(least))
        return np.where(same, np.sqrt(np.maximum(product, 0.0)) / np.where(same, -strong, 1.0), 0.0)

    return map_bordered([layer], fn, block, {a: 2 for a in AXES}, sizes, out_dtype)


def black_neighbour(layer: Layer, block: dict[str, int], sizes: DataFrame) -> DataFrame:
    """1 where one of the four xy neighbours is 0 or lies beyond the volume, else 0 (u8)."""
    def fn(cube):
        hit = np.zeros(cube.shape, dtype=bool)
        for axis in (1, 2):
            full = _padded(cube, axis, 1, "zero")
            hit |= (_along(full, axis, 0, -2) == 0) | (_along(full, axis, 2, None) == 0)
        return hit.astype(float)

    return map_bordered([layer], fn, block, {"y": 1, "x": 1}, sizes, "u8")


def detect_dog(layer: Layer, sigma: float, threshold: float, block: dict[str, int], sizes: DataFrame, factor: float = 2 ** 0.25,
               axes: tuple = AXES) -> DataFrame:
    """Bright blobs, as ``features.detect_dog``: (z, y, x, px, py, pz, intensity) of local maxima of the difference of Gaussians."""
    narrow, broad = [{a: s for a in axes} for s in (sigma, sigma * factor)]
    reach = {a: r + 1 for a, r in _reaches(broad).items()}

    def fn(cube):
        d = smoothed(cube, narrow) - smoothed(cube, broad)
        best, shifts = d, {f"p{a}": np.zeros(d.shape) for a in AXES}
        for a in axes:
            axis = AXES.index(a)
            full = _padded(d, axis, 1, "border")
            left, right = _along(full, axis, 0, -2), _along(full, axis, 2, None)
            bend = left - 2.0 * d + right
            shifts[f"p{a}"] = np.clip((left - right) * 0.5 / np.where(bend != 0, bend, np.inf), -0.5, 0.5)
            tall = _padded(best, axis, 1, "border")
            best = np.maximum(np.maximum(_along(tall, axis, 0, -2), best), _along(tall, axis, 2, None))
        return (d == best) & (d > threshold), {**shifts, "intensity": d}

    # absent blocks hold a constant, of which no voxel exceeds a threshold of 0 or more
    return scan_bordered([layer], fn, ["px", "py", "pz", "intensity"], block, reach, sizes, dense=threshold < 0)


def derivative_cost(layer: Layer, outside: DataFrame, block: dict[str, int], sizes: DataFrame, median: bool = False, smooth: bool = False,
                    out_dtype: str = "u8") -> DataFrame:
    """Cost of thin slabs, as ``cost.derivative_cost``: 255 - max(0, v(z + 1) - v(z)), stretched by four; the first layer takes
    255 - outside. ``outside`` holds the grey value beyond each volume (column ``median``). Median and blur share the exchange."""
    told = measured(sizes.join(outside.select(*KEY, F.col("median").cast("double").alias("aside")), KEY))
    reach = _reaches({"z": 1.0})["z"] if smooth else 0

    def fn(cube, place):
        v = cube.astype(float)
        full = _padded(v, 0, 1, "constant", place["aside"])
        if median:
            v = np.median(np.stack([full[:-2], full[1:-1], full[2:]]), axis=0)
            full = _padded(v, 0, 1, "constant", place["aside"])
        fall = 255.0 - np.maximum(0.0, full[2:] - v)
        if place["low"][0] == 0:
            fall[0] = 255.0 - place["aside"]
        out = 255.0 - (255.0 - fall) * 4.0
        return smoothed(out, {"z": 1.0}, "constant", 255.0) if smooth else out

    return map_bordered([layer], fn, block, {"z": 1 + median + reach}, told, out_dtype, placed=True)


def pyramid_gauss(layer: Layer, levels: int, block: dict[str, int], sizes: DataFrame, axes: tuple = AXES) -> list[tuple[DataFrame, DataFrame]]:
    """Scale levels by factor two on the same grid, as (blocks, sizes), each from the one before: blur by
    sqrt(0.25 step^2 - 0.25), keep every second voxel. An odd last voxel is dropped. Sides of blocks must be even."""
    sigma = math.sqrt(0.25 * 2 * 2 - 0.25)
    step = {a: 2 if a in axes else 1 for a in AXES}
    half = {a: block[a] // step[a] for a in AXES}
    out = []
    for _ in range(levels):
        sigmas = {a: sigma for a in axes}
        thin = map_bordered([layer], lambda v, sigmas=sigmas: smoothed(v, sigmas), block, _reaches(sigmas), sizes, "f64", step=step)
        sizes = measured(sizes.select(*KEY, *[F.expr(f"n{a} div {step[a]}").alias(f"n{a}") for a in AXES]))
        layer = Layer(checkpoint(reblock(thin, half, block, sizes, "f64")), "f64", layer.background)
        out.append((layer.blocks, sizes))
    return out
