"""Volume sources and sinks: slices, tiles, octrees, block tables and attributes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.operators.blocks import PIECE_ROWS, numpy_type, reblock, value_type
from voxelframe.schema import KEY, POS, volume_type
from voxelframe.session import small, stored

STRUCTURAL = ["dimensions", "blockSize", "dataType", "compression"]


# ---- slices --------------------------------------------------------------------

def read_slices(spark: SparkSession, path: str, name_pattern: str, width: int, height: int, dataset: str) -> DataFrame:
    """Raw slice files as rows (dataset, z, w, h, data); z is the number the
    pattern finds in the file name. Files that are missing are simply absent."""
    files = spark.read.format("binaryFile").load(path)
    z = F.regexp_extract("path", name_pattern, 1)
    return files.where(z != "").select(
        F.lit(dataset).alias("dataset"), z.cast("long").alias("z"), F.lit(width).alias("w"), F.lit(height).alias("h"),
        F.col("content").alias("data"))


def decode_slices(slices: DataFrame, dtype: str = "u8", byteorder: str = "little", low: dict[str, int] | None = None,
                  size: dict[str, int] | None = None, first_slice: int = 0) -> DataFrame:
    """Decode slice rows to voxels, with an optional window. Slice number
    ``first_slice`` becomes z = 0. Rows leave the task in bounded strips."""
    low, size = low or {}, size or {}
    kind, whole = numpy_type(dtype, byteorder), value_type(dtype)
    y0, x0 = low.get("y", 0), low.get("x", 0)
    out_z = slices.withColumn("z", F.col("z") - first_slice - low.get("z", 0)).where("z >= 0")
    if "z" in size:
        out_z = out_z.where(F.col("z") < size["z"])

    def decode(frames):
        for frame in frames:
            for r in frame.itertuples(index=False):
                image = np.frombuffer(r.data, dtype=kind).reshape(r.h, r.w)
                part = image[:, x0:x0 + size.get("x", r.w)]
                step = max(1, PIECE_ROWS // max(1, part.shape[1]))
                for start in range(0, part.shape[0], step):
                    strip = part[start:start + step]
                    y, x = [i.ravel() for i in np.indices(strip.shape)]
                    yield pd.DataFrame({"dataset": r.dataset, "z": r.z, "y": y + start, "x": x,
                                        "v": strip.ravel().astype(whole)})

    # only the wanted rows of an image reach Python
    row = F.col("w") * np.dtype(kind).itemsize
    rows = F.greatest(F.lit(0), F.least(F.col("h") - y0, F.lit(size["y"]) if "y" in size else F.col("h")))
    window = F.substring("data", (row * y0 + 1).cast("int"), (row * rows).cast("int"))
    return out_z.select("dataset", "z", "w", rows.alias("h"), window.alias("data")).mapInPandas(decode, volume_type(dtype))


def export_slices(vox: DataFrame, sizes: DataFrame, strip: int = 4096, dtype: str = "u8",
                  byteorder: str = "little") -> DataFrame:
    """One image per z, as strips of at most ``strip`` rows so that no task
    holds more than one strip of a large layer."""
    kind = numpy_type(dtype, byteorder)

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        top = key[2] * strip
        w, h = int(rows.nx.iat[0]), int(min(strip, rows.ny.iat[0] - top))
        image = np.zeros((h, w), dtype=kind)
        image[rows.y - top, rows.x] = rows.v
        return pd.DataFrame([[*key, w, h, image.tobytes()]], columns=["dataset", "z", "strip", "w", "h", "data"])

    keyed = vox.join(small(sizes), KEY).withColumn("strip", F.floor(F.col("y") / strip))
    return keyed.groupBy("dataset", "z", "strip").applyInPandas(
        pack, "dataset string, z long, strip long, w int, h int, data binary")


# ---- tiles and octrees ------------------------------------------------------------

def assemble_tiles(tiles: DataFrame, tile: dict[str, int], block: dict[str, int], sizes: DataFrame,
                   low: dict[str, int] | None = None, dtype: str = "u8") -> DataFrame:
    """Blocks from tile rows (dataset, z, row, col, data). Absent tiles leave
    background; a block without any tile has no row."""
    th, tw = tile["y"], tile["x"]
    as_blocks = tiles.select("dataset", F.col("z").alias("gz"), F.col("row").alias("gy"), F.col("col").alias("gx"),
                             F.lit(1).cast("long").alias("nz"), F.lit(th).cast("long").alias("ny"),
                             F.lit(tw).cast("long").alias("nx"), "data")
    return reblock(as_blocks, {"z": 1, "y": th, "x": tw}, block, sizes, dtype, low)


def octree_coordinates(paths: DataFrame, path: str = "path") -> DataFrame:
    """Grid position of octree nodes from digit paths such as "3/1/8": child k
    sets the bits of k - 1 at the node's depth (x, y, z from the lowest bit)."""
    named = F.filter(F.split(F.col(path), "/"), lambda d: d != "")  # the root's path is empty
    digits = F.transform(named, lambda d: d.cast("long") - 1)

    def fold(bit: int) -> Column:
        return F.aggregate(digits, F.lit(0).cast("long"), lambda acc, d: acc * 2 + F.shiftright(d, bit).bitwiseAND(F.lit(1)))

    return paths.withColumns({"gx": fold(0), "gy": fold(1), "gz": fold(2), "depth": F.size(digits)})


def octree_blocks(nodes: DataFrame, levels: int, block: dict[str, int], dtype: str = "u16", fill: bool = True) -> DataFrame:
    """Blocks of the finest grid from sparse octree nodes (dataset, channel, path, data),
    one row per node and channel; data sets are named "dataset/c<channel>".

    A tree of ``levels`` steps below its root fills 2 ** levels blocks an axis,
    and every node's payload has one block's shape, whatever its depth. The
    finest node at a place wins, also where it is empty; with ``fill`` a place
    without a node at the last level shows its nearest ancestor, each voxel
    repeated. Blocks of zeros have no row, nodes below the last level no effect.

    A node hands its octants down one level at a time, only those that no node
    of that level replaces and that are not empty, so a single coarse node
    spreads over more tasks with every level."""
    kind, sides = numpy_type(dtype), [block[a] for a in "zyx"]
    if fill and levels and any(n % 2 for n in sides):
        raise ValueError("octants need even block sides")
    named = nodes.select(F.concat_ws("/c", "dataset", "channel").alias("dataset"), "path", "data")
    named = named.withColumn("depth", F.size(F.filter(F.split("path", "/"), lambda d: d != "")))
    if fill:  # every level reads the nodes again
        named = stored(named, "nodes")

    def level(depth: int) -> DataFrame:
        return named.where(F.col("depth") == depth).select("dataset", "path", "data")

    def hand_down(frames):
        for frame in frames:
            rows = []
            for r in frame.itertuples(index=False):
                cube = np.frombuffer(r.data, dtype=kind).reshape(sides)
                taken = set() if r.taken is None else set(r.taken)
                for digit in range(1, 9):
                    if str(digit) in taken:
                        continue
                    at = [(digit - 1 >> bit & 1) * n // 2 for bit, n in zip((2, 1, 0), sides)]
                    part = cube[tuple(slice(a, a + n // 2) for a, n in zip(at, sides))]
                    if part.any():
                        for axis in range(3):
                            part = part.repeat(2, axis)
                        rows.append((r.dataset, f"{r.path}/{digit}".lstrip("/"), part.tobytes()))
            yield pd.DataFrame(rows, columns=["dataset", "path", "data"])

    def not_empty(frames):
        for frame in frames:
            yield frame[[np.frombuffer(d, dtype=kind).any() for d in frame["data"]]]

    found = level(0) if fill else level(levels)
    for depth in range(1, levels + 1) if fill else ():
        parent = F.regexp_replace("path", "/?[^/]*$", "")
        taken = level(depth).select("dataset", parent.alias("path"), F.regexp_extract("path", "([^/]*)$", 1).alias("digit"))
        taken = taken.groupBy("dataset", "path").agg(F.collect_set("digit").alias("taken"))
        above = found.join(taken, ["dataset", "path"], "left")
        found = above.mapInPandas(hand_down, "dataset string, path string, data binary").unionByName(level(depth))
    nz, ny, nx = [F.lit(n).cast("long") for n in sides]
    return octree_coordinates(found.mapInPandas(not_empty, found.schema)).select(
        "dataset", "gz", "gy", "gx", nz.alias("nz"), ny.alias("ny"), nx.alias("nx"), "data")


# ---- volume tables ---------------------------------------------------------------

def write_volume(df: DataFrame, path: str, background: float | None = None, block_z: int = 64, mode: str = "error") -> None:
    """Write voxels as Parquet, partitioned by volume and z slab and sorted by
    position. Existing output is refused unless ``mode`` is "overwrite". The
    rebalance splits slabs that are much larger than others.

    A slab is named by its first and last z, so readers need not know
    ``block_z``. Voxels of a given ``background`` are left out; who reads such
    a volume for an operator on neighbours passes its sizes to ``read_volume``."""
    kept = df if background is None else df.where(F.col("v") != background)
    # the folders come first in the order, else the writer sorts once more and by them alone
    laid = _slabs(kept, block_z).hint("rebalance", "dataset", "z0").sortWithinPartitions("dataset", "z0", "z1", "z", "y", "x")
    laid.write.mode(mode).partitionBy("dataset", "z0", "z1").parquet(path)


def _slabs(df: DataFrame, block_z: int) -> DataFrame:
    first = F.expr(f"(z div {block_z}) * {block_z}")
    return df.withColumn("z0", first).withColumn("z1", first + block_z - 1)


def resume_volume(df: DataFrame, path: str, background: float | None = None, block_z: int = 64) -> None:
    """Write the slabs that a broken run left out. A slab is there as a whole or
    not at all, as files appear when their job commits."""
    spark = df.sparkSession
    there = spark.read.schema("dataset string, z0 long, z1 long").parquet(path).select("dataset", "z0").distinct()
    rest = _slabs(df, block_z).join(there, ["dataset", "z0"], "left_anti").drop("z0", "z1")
    write_volume(rest, path, background, block_z, "append")


def read_volume(spark: SparkSession, path: str, roi: dict[str, tuple[int, int]] | None = None, datasets: list[str] | None = None,
                value: str = "long", sizes: DataFrame | None = None, background: float = 0) -> DataFrame:
    """Read volumes; names and a region [low, high) prune partitions, and the
    region is pushed to the file scan through the plain coordinate columns.
    With ``sizes`` (dataset, nz, ny, nx) voxels that are not stored are added as
    ``background``."""
    schema = f"z long, y long, x long, v {value}, dataset string, z0 long, z1 long"
    out = spark.read.schema(schema).parquet(path)
    if datasets:
        out = out.where(F.col("dataset").isin(datasets))
    for a, (low, high) in (roi or {}).items():
        if a == "z":
            out = out.where((F.col("z0") < high) & (F.col("z1") >= low))
        out = out.where((F.col(a) >= low) & (F.col(a) < high))
    out = out.select(*POS, "v")
    if sizes is None:
        return out
    if datasets:
        sizes = sizes.where(F.col("dataset").isin(datasets))
    return densify(out, sizes, background, roi)


def densify(vox: DataFrame, sizes: DataFrame, background: float = 0, roi: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """All voxels of the volumes in ``sizes`` (or of a region), those without a
    row as background: the input of operators that look at neighbours."""
    grid = sizes.select(*KEY, "nz", "ny", "nx")
    for a in ("z", "y", "x"):
        low, high = (roi or {}).get(a, (0, None))
        end = F.col(f"n{a}") if high is None else F.least(F.col(f"n{a}"), F.lit(high))
        grid = grid.withColumn(a, F.explode(F.when(end > low, F.sequence(F.lit(low).cast("long"), end.cast("long") - 1))))
        if a == "z":  # one row per volume and layer so far
            grid = grid.repartition("dataset", "z")
    return grid.select(*POS).join(vox, POS, "left").select(*POS, F.coalesce("v", F.lit(background).cast(vox.schema["v"].dataType)).alias("v"))


def check_consistent(existing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Fail when a data set to be resumed is not there, or has other dims, block,
    pixel type or compression (an attribute)."""
    joined = wanted.alias("w").join(existing.alias("e"), "dataset", "left")
    same = F.lit(True)
    for c in ("dims", "block", "dtype"):
        same = same & F.col(f"e.{c}").eqNullSafe(F.col(f"w.{c}"))
    packing = [F.element_at(F.col(f"{side}.attrs"), "compression") for side in ("e", "w")]
    same = same & packing[0].eqNullSafe(packing[1])
    checked = F.when(same, F.col("dataset")).otherwise(
        F.raise_error(F.concat(F.lit("data set differs from its existing output: "), F.col("dataset"))))
    return joined.select(checked.alias("dataset"))


# ---- attributes and job lists -------------------------------------------------------

def transfer_attributes(source: Column, target: Column) -> Column:
    """Target attributes plus all descriptive attributes of the source."""
    described = F.map_filter(source, lambda k, v: ~k.isin(STRUCTURAL))
    kept = F.map_filter(target, lambda k, v: ~F.map_contains_key(described, k))
    return F.map_concat(kept, described)


def required_attribute(attrs: Column, key: str, dataset: Column) -> Column:
    message = F.concat(F.lit(f"required attribute {key} is missing from "), dataset)
    return F.coalesce(F.element_at(attrs, key), F.raise_error(message).cast("string"))


def resolve_datasets(names: DataFrame, in_pattern: str, out_pattern: str, scales: list[int], name: str = "dataset") -> DataFrame:
    """Expand one ``*`` in the input and output names over the known groups,
    times a list of scale levels."""
    if in_pattern.count("*") != out_pattern.count("*") or in_pattern.count("*") > 1:
        raise ValueError("input and output need exactly one wildcard, or none")
    if "*" in in_pattern:
        head, tail = in_pattern.split("*")
        middle = F.regexp_extract(name, f"^\\Q{head}\\E([^/]+)\\Q{tail}\\E$", 1)
        out_head, out_tail = out_pattern.split("*")
        found = names.withColumn("part", middle).where("part <> ''")
        target = F.concat(F.lit(out_head), "part", F.lit(out_tail))
    else:
        found = names.where(F.col(name) == in_pattern)
        target = F.lit(out_pattern)
    levels = F.explode(F.array(*[F.lit(s) for s in scales]))
    return found.select(F.col(name).alias("source"), target.alias("target"), levels.alias("scale"))


def read_jobs(spark: SparkSession, path: str, form: str = "csv") -> DataFrame:
    """Job list of (source, field, target) rows from CSV without header, from
    JSON lines, or (``form`` "array") from a JSON array of from/to records with
    an optional field; any other missing value fails."""
    schema = "source string, field string, target string"
    if form == "csv":
        rows = spark.read.schema(schema).csv(path, mode="FAILFAST")
    elif form == "array":
        found = spark.read.schema("`from` string, `to` string, field string").json(path, multiLine=True, mode="FAILFAST")
        rows = found.select(F.col("from").alias("source"), F.coalesce("field", F.lit("")).alias("field"), F.col("to").alias("target"))
    else:
        rows = spark.read.schema(schema).json(path)
    complete = F.col("source").isNotNull() & F.col("field").isNotNull() & F.col("target").isNotNull()
    checked = F.when(complete, F.trim("source")).otherwise(F.raise_error(F.lit("a job needs three values")))
    return rows.select(checked.alias("source"), F.trim("field").alias("field"), F.trim("target").alias("target"))


def read_positions(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Tile position records, one per line or (``array``) as one JSON array; the
    position id is parsed from the file name."""
    schema = ("type string, file string, position array<long>, size array<long>, "
              "pixelResolution array<double>, index long")
    rows = spark.read.schema(schema).json(path, multiLine=array)
    return rows.withColumn("position_id", F.regexp_extract(F.lower("file"), r"pos(0\d+)", 1))


def slice_catalog(slices: DataFrame) -> DataFrame:
    """One row per (stack, channel, cam): number of slices, first and last slice.
    The slices themselves stay rows, ordered by ``idx``."""
    entry = F.struct("idx", "path", "affine")
    return slices.groupBy("stack", "channel", "cam").agg(
        F.count(F.lit(1)).alias("n"), F.min(entry).alias("first"), F.max(entry).alias("last"))


def rewrite_catalog(slices: DataFrame, cam_affine: DataFrame) -> DataFrame:
    """Slice rows with the camera transform of their (stack, channel, cam) put
    in front of their own affine."""
    from voxelframe.functions.affine import concatenate

    joined = slices.join(small(cam_affine), ["stack", "channel", "cam"])
    return joined.withColumn("affine", concatenate(F.col("affine"), F.col("cam_affine"))).drop("cam_affine")


def add_paths(catalog: DataFrame, paths: DataFrame) -> DataFrame:
    """Attach the data path of every (stack, channel, cam)."""
    return catalog.join(paths, ["stack", "channel", "cam"], "left")


def export_transforms(fields: DataFrame, slabs: DataFrame, scale: float) -> DataFrame:
    """Top and bottom position fields of every slab with face offset and scale."""
    offset = F.when(F.col("side") == "top", F.col("top")).otherwise(F.col("bot"))
    return fields.join(small(slabs), KEY).select(*KEY, "side", "iy", "ix", "tx", "ty", offset.alias("face_offset"),
                                          F.lit(float(scale)).alias("scale"))


def save_rows(df: DataFrame, path: str, keys: list[str], mode: str = "error") -> None:
    """Store features or matches as typed rows, one folder per key; the rebalance
    lets several tasks write a large key."""
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


def save_matches(matches: DataFrame, path: str, mode: str = "error", minimum: int = 4) -> None:
    """Store the matches of pairs that have at least ``minimum`` of them. Rows of
    one large pair are written by several tasks."""
    enough(matches, minimum).write.mode(mode).parquet(path)


def enough(matches: DataFrame, minimum: int = 4) -> DataFrame:
    kept = matches.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= minimum).drop("n")
    return matches.join(kept, ["a", "b"], "left_semi")
