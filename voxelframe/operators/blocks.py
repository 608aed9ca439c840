"""Block form: one row per chunk with a little-endian C-order binary payload.

Voxel form suits relational operators, block form suits dense kernels; both
carry the same keys. All groups below are one block, whose size the caller sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.operators.grid import with_block, with_halo
from voxelframe.schema import BLOCKS, KEY, PIXEL_TYPES, POS, volume_type
from voxelframe.session import measured, small

PIECE_ROWS = 1 << 18


def numpy_type(dtype: str, byteorder: str = "little") -> str:
    return ("<" if byteorder == "little" else ">") + PIXEL_TYPES[dtype][0]


def value_type(dtype: str) -> str:
    """numpy type of the value column of voxel rows."""
    return "float64" if PIXEL_TYPES[dtype][1] is None else "int64"


def whole_groups(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame, np.ndarray], Iterator[pd.DataFrame]], schema) -> DataFrame:
    """Run ``fn`` on frames that hold whole groups, many small ones at once, and on
    the first row of each group in them. A task holds one Arrow batch and the
    rows of one group; a group that is longer than a batch comes alone or with
    the end of its last batch."""
    def run(frames):
        held: list[pd.DataFrame] = []

        def release(frame: pd.DataFrame):
            same = np.ones(len(frame), dtype=bool)
            for k in keys:
                column = frame[k].to_numpy()
                frame[k] = column  # text of joined frames comes in chunks, which Arrow does not take back
                same[1:] &= column[1:] == column[:-1]
            same[0] = False
            return fn(frame, np.flatnonzero(~same))

        for frame in frames:
            if frame.empty:
                continue
            end = frame[keys].iloc[-1]
            if held and (held[0][keys].iloc[-1] == end).all():
                held.append(frame)  # sorted, so all of it is the group held back
                continue
            cut = len(frame) - int((frame[keys] == end).all(axis=1).sum())
            ready = pd.concat([*held, frame.iloc[:cut]], ignore_index=True)
            held = [frame.iloc[cut:]]
            if len(ready):
                yield from release(ready)
        if held:
            yield from release(pd.concat(held, ignore_index=True))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def whole_tables(df: DataFrame, keys: list[str], fn: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``whole_groups`` on Arrow tables: for narrow rows by the million, whose
    text would cost more as Python objects than the work on them."""
    def starts(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
        new = np.zeros(rows.num_rows, dtype=bool)
        for k in keys:
            column = rows.column(k)
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1)).to_numpy(zero_copy_only=False)
        return np.flatnonzero(new)

    def run(batches):
        held: list[pa.RecordBatch] = []

        def release(parts: list[pa.RecordBatch]):
            table = pa.Table.from_batches(parts).combine_chunks()
            rows = table.to_batches()[0]
            return fn(table, np.append(0, starts(rows)))

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = starts(batch)
            cut = int(marks[-1]) if len(marks) else 0
            if held and not cut and all(held[-1].column(k)[-1] == batch.column(k)[0] for k in keys):
                held.append(batch)  # sorted, so all of it is the group held back
                continue
            ready = [*held, batch.slice(0, cut)] if cut else held
            held = [batch.slice(cut)]
            if ready:
                yield from release(ready)
        if held:
            yield from release(held)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def to_blocks(vox: DataFrame, block: dict[str, int], sizes: DataFrame, dtype: str = "u8",
              background: float = 0) -> DataFrame:
    """Pack voxels into blocks. Blocks without a voxel have no row; missing
    voxels inside a block take the background value. Small blocks are packed
    many at a time, up to ``PIECE_ROWS`` voxels. A voxel moves with its place in
    its block only."""
    kind, axes = numpy_type(dtype), ("z", "y", "x")
    grid = ["dataset", "gz", "gy", "gx"]

    def pack(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        place, values = (rows.column(c).to_numpy() for c in ("place", "v"))
        if (place < 0).any():
            raise IndexError("a voxel lies outside its volume")
        first = rows.select([*grid, *[f"n{a}" for a in axes]]).take(pa.array(starts)).combine_chunks()
        volume = np.prod([first.column(f"n{a}").to_numpy() for a in axes], axis=0)
        ends = np.append(starts[1:], len(place))
        group = np.repeat(np.arange(len(starts)), ends - starts)
        i, upto = 0, np.cumsum(volume)
        while i < len(starts):
            before = upto[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(upto, before + PIECE_ROWS, side="right")))
            offset = upto[i:j] - volume[i:j] - before
            flat = np.full(int(upto[j - 1] - before), background, dtype=kind)
            part = slice(starts[i], ends[j - 1])
            flat[offset[group[part] - i] + place[part]] = values[part]
            yield _packed(first.slice(i, j - i), np.append(offset, len(flat)), flat)
            i = j

    keyed = with_block(vox, block).join(small(sizes), KEY)
    side = {a: F.least(F.lit(block[a]).cast("long"), F.col(f"n{a}") - F.col(f"g{a}") * block[a]) for a in axes}
    at = {a: F.col(a) - F.col(f"g{a}") * block[a] for a in axes}
    inside = F.lit(True)
    for a in axes:
        inside = inside & (at[a] >= 0) & (at[a] < side[a])
    place = F.when(inside, (at["z"] * side["y"] + at["y"]) * side["x"] + at["x"]).otherwise(F.lit(-1)).cast("long")
    rows = keyed.select(*grid, *[side[a].cast("long").alias(f"n{a}") for a in axes], place.alias("place"), "v")
    return whole_tables(rows, grid, pack, BLOCKS)


def to_voxels(blocks: DataFrame, block: dict[str, int], dtype: str = "u8", skip_background: bool = False) -> DataFrame:
    """Unpack blocks into voxel rows, one slab of a block or many small blocks at a time."""
    kind, bz, by, bx = numpy_type(dtype), block["z"], block["y"], block["x"]
    whole = value_type(dtype)

    def unpack(batches):
        names, parts, many, grids = [], [], 0, {}

        def release():
            z, y, x, v = (np.concatenate(c) for c in zip(*parts))
            owner = np.repeat(np.arange(len(names)), [len(p[0]) for p in parts])
            text = pa.array(names, pa.string()).take(pa.array(owner))
            return pa.RecordBatch.from_arrays([text, *[pa.array(c) for c in (z, y, x, v)]], names=["dataset", "z", "y", "x", "v"])

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in ("dataset", "gz", "gy", "gx", "nz", "ny", "nx")])
            for (dataset, gz, gy, gx, nz, ny, nx), data in zip(keys, batch.column("data")):
                cube = np.frombuffer(data.as_buffer(), dtype=kind).reshape(nz, ny, nx)
                step = max(1, PIECE_ROWS // max(1, ny * nx))
                for start in range(0, nz, step):
                    part = cube[start:start + step]
                    if skip_background:
                        z, y, x = np.nonzero(part)
                        v = part[z, y, x]
                    else:
                        if part.shape not in grids:
                            grids.clear()
                            grids[part.shape] = [i.ravel() for i in np.indices(part.shape)]
                        (z, y, x), v = grids[part.shape], part.ravel()
                    names.append(dataset)
                    parts.append((z + (start + gz * bz), y + gy * by, x + gx * bx, v.astype(whole)))
                    many += len(v) + 1
                    if many >= PIECE_ROWS:
                        yield release()
                        names, parts, many = [], [], 0
        if parts:
            yield release()

    return blocks.mapInArrow(unpack, volume_type(dtype))


def reblock(blocks: DataFrame, block: dict[str, int], target: dict[str, int], sizes: DataFrame, dtype: str = "u8",
            low: dict[str, int] | None = None, background: float = 0) -> DataFrame:
    """Cut every block at the borders of the target grid and reassemble the
    pieces; each input block is read once and stays binary. ``low`` crops the
    source: that position becomes the origin. ``sizes`` is the target extent."""
    kind = numpy_type(dtype)
    axes = ("z", "y", "x")
    old, new = [block[a] for a in axes], [target[a] for a in axes]
    start = [(low or {}).get(a, 0) for a in axes]
    names = ["dataset", "gz", "gy", "gx", "pz", "py", "px", "mz", "my", "mx", "nz", "ny", "nx", "data"]
    schema = ", ".join(["dataset string", *[f"{n} long" for n in names[1:-1]], "data binary"])

    def cut(batches):
        for batch in batches:
            g, n, e = ([batch.column(f"{c}{a}").to_numpy() for a in axes] for c in "gne")
            origin = [i * b - s for i, b, s in zip(g, old, start)]
            lows = [np.maximum(0, o) for o in origin]
            highs = [np.minimum(m, o + k) for m, o, k in zip(e, origin, n)]
            who = np.flatnonzero(np.all([h > l for l, h in zip(lows, highs)], axis=0))
            cell = []
            for l, h, b in zip(lows, highs, new):  # the cells that a block meets along one axis after the other
                first = l[who] // b
                many = (h[who] - 1) // b - first + 1
                back = np.repeat(np.arange(len(who)), many)
                step = np.arange(len(back)) - np.repeat(np.cumsum(many) - many, many)
                who, cell = who[back], [*[c[back] for c in cell], first[back] + step]
            if not len(who):
                continue
            a = [np.maximum(l[who], i * b) for l, i, b in zip(lows, cell, new)]
            z = [np.minimum(h[who], (i + 1) * b) for h, i, b in zip(highs, cell, new)]
            side = [np.minimum(b, m[who] - i * b) for b, m, i in zip(new, e, cell)]
            form = np.stack([*[m[who] for m in n], *[p - o[who] for p, o in zip(a, origin)], *[q - p for p, q in zip(a, z)]], axis=1)
            data, out = batch.column("data"), [None] * len(who)
            for pieces, (nz, ny, nx, *spot) in _alike(form):
                window = tuple(slice(o, o + k) for o, k in zip(spot[:3], spot[3:]))
                most = max(1, PIECE_ROWS // int(nz * ny * nx))
                for i in range(0, len(pieces), most):
                    some = pieces[i:i + most]
                    cubes = np.stack([np.frombuffer(data[k].as_buffer(), dtype=kind).reshape(nz, ny, nx)[window] for k in who[some].tolist()])
                    for k, cube in zip(some.tolist(), cubes):
                        out[k] = cube.tobytes()
            inner = [p - i * b for p, i, b in zip(a, cell, new)]
            columns = [*cell, *inner, *form.T[6:], *side]
            # the pieces of one batch may be many times its blocks: they leave in bounded parts
            size = np.cumsum(form[:, 6] * form[:, 7] * form[:, 8])
            text, i = batch.column("dataset").take(pa.array(who)), 0
            while i < len(who):
                j = max(i + 1, int(np.searchsorted(size, (size[i - 1] if i else 0) + PIECE_ROWS, side="right")))
                yield pa.RecordBatch.from_arrays([text.slice(i, j - i), *[pa.array(np.ascontiguousarray(c[i:j])) for c in columns], pa.array(out[i:j], pa.binary())], names=names)
                i = j

    def join_pieces(rows: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        first = rows.select(["dataset", "gz", "gy", "gx", "nz", "ny", "nx"]).take(pa.array(starts)).combine_chunks()
        n = np.stack([first.column(f"n{a}").to_numpy() for a in axes], axis=1)
        place = np.stack([rows.column(f"{c}{a}").to_numpy() for c in "pm" for a in axes], axis=1)
        data, ends, i, upto = rows.column("data").chunk(0), np.append(starts[1:], rows.num_rows), 0, np.cumsum(n.prod(axis=1))
        while i < len(starts):
            before = upto[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(upto, before + PIECE_ROWS, side="right")))
            flat = np.full(int(upto[j - 1] - before), background, dtype=kind)
            offset = upto[i:j] - n[i:j].prod(axis=1) - before
            part = np.arange(starts[i], ends[j - 1])
            group = np.repeat(np.arange(j - i), ends[i:j] - starts[i:j])
            for pieces, (pz, py, px, mz, my, mx, nz, ny, nx) in _alike(np.hstack([place[part], n[i:j][group]])):
                window = (slice(pz, pz + mz), slice(py, py + my), slice(px, px + mx))
                for k in pieces.tolist():
                    at = offset[group[k]]
                    cube = flat[at:at + nz * ny * nx].reshape(nz, ny, nx)
                    cube[window] = np.frombuffer(data[int(part[k])].as_buffer(), dtype=kind).reshape(mz, my, mx)
            yield _packed(first.slice(i, j - i), np.append(offset, len(flat)), flat)
            i = j

    extents = small(sizes).select("dataset", F.col("nz").alias("ez"), F.col("ny").alias("ey"), F.col("nx").alias("ex"))
    pieces = blocks.join(extents, KEY).mapInArrow(cut, schema)
    return whole_tables(pieces, ["dataset", "gz", "gy", "gx"], join_pieces, BLOCKS)


def _alike(rows: np.ndarray) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Places of equal rows, and the row as Python numbers."""
    order = np.lexsort(rows.T)
    new = (np.diff(rows[order], axis=0) != 0).any(axis=1)
    for same in np.split(order, np.flatnonzero(new) + 1):
        if len(same):
            yield same, rows[same[0]].tolist()


def _packed(first: pa.Table, cuts: np.ndarray, flat: np.ndarray) -> pa.RecordBatch:
    """Block rows whose payloads lie one after the other in ``flat``."""
    ends = (cuts * flat.itemsize).astype(np.int32)
    data = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    return pa.RecordBatch.from_arrays([*first.combine_chunks().to_batches()[0].columns, data], names=BLOCKS.names)


def map_blocks(vox: DataFrame, fn: Callable[[np.ndarray], np.ndarray], block: dict[str, int], halo: dict[str, int],
               sizes: DataFrame, mode: str = "reflect", skip_empty: bool = False) -> DataFrame:
    """Apply a function on arrays to every block with a border of ``halo`` voxels.

    The border comes from the neighbouring blocks; beyond the volume it is
    filled by the numpy pad ``mode``. With ``skip_empty`` a block that is zero
    with its border stays zero."""
    axes = ("z", "y", "x")
    halos = [halo.get(a, 0) for a in axes]
    sides = [block[a] for a in axes]
    schema = "dataset string, z long, y long, x long, v double"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        g = key[1:]
        extent = [int(rows[f"n{a}"].iat[0]) for a in axes]
        inner_low = [i * b for i, b in zip(g, sides)]
        inner_high = [min(e, (i + 1) * b) for e, i, b in zip(extent, g, sides)]
        low = [max(0, l - h) for l, h in zip(inner_low, halos)]
        high = [min(e, u + h) for e, u, h in zip(extent, inner_high, halos)]
        cube = np.zeros([u - l for l, u in zip(low, high)])
        cube[tuple(rows[a].to_numpy() - l for a, l in zip(axes, low))] = rows.v
        missing = [(h - (il - l), h - (u - iu)) for h, il, l, u, iu in zip(halos, inner_low, low, high, inner_high)]
        inner = tuple(slice(il - l, iu - l) for il, l, iu in zip(inner_low, low, inner_high))
        if skip_empty and not cube.any():
            out = cube[inner]
        else:
            full = np.pad(cube, missing, mode=mode)
            out = fn(full)[tuple(slice(h, h + iu - il) for h, iu, il in zip(halos, inner_high, inner_low))]
        z, y, x = [i.ravel() for i in np.indices(out.shape)]
        return pd.DataFrame({"dataset": key[0], "z": z + inner_low[0], "y": y + inner_low[1], "x": x + inner_low[2],
                             "v": out.ravel().astype(float)})

    sizes = measured(sizes)
    spread = with_halo(vox, block, halo, sizes).join(small(sizes), KEY)
    return spread.groupBy("dataset", "gz", "gy", "gx").applyInPandas(run, schema)


def map_slices(vox: DataFrame, fn: Callable[[np.ndarray], np.ndarray], block: dict[str, int], padding: int,
               sizes: DataFrame, low: float | None = None, high: float | None = None, mode: str = "reflect") -> DataFrame:
    """Apply a 2-D filter to every z slice, block by block, with padding, an
    optional value range. A block that is black with its padding stays black,
    whatever the range."""
    def per_slice(cube):
        out = np.stack([fn(s) for s in cube])
        return out if low is None else np.clip(out, low, high)

    return map_blocks(vox, per_slice, {"z": 1, **{a: block[a] for a in ("y", "x")}}, {"y": padding, "x": padding},
                      sizes, mode, skip_empty=True)


def nonempty_blocks(vox: DataFrame, block: dict[str, int], background: float = 0) -> DataFrame:
    """Keys of the blocks that hold at least one voxel that is not background."""
    return with_block(vox.where(F.col("v") != background), block).select(*KEY, "gz", "gy", "gx").distinct()


def drop_empty_blocks(vox: DataFrame, block: dict[str, int], background: float = 0) -> DataFrame:
    """Voxels of non-empty blocks only: the input of expensive stencils."""
    kept = nonempty_blocks(vox, block, background)
    return with_block(vox, block).join(kept, KEY + ["gz", "gy", "gx"], "left_semi").select(*POS, "v")
