"""Grid keys: blocks, offsets, halos, batches and point blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.schema import KEY
from voxelframe.session import measured, small

AXES = ("z", "y", "x")


def grid(sizes: DataFrame, block: dict[str, int], out_block: dict[str, int] | None = None,
         keys: list[str] = KEY) -> DataFrame:
    """All blocks of every volume: offset o*, cropped size s* and position g* in
    units of the stored block. Built by exploding one axis after the other."""
    out_block = out_block or block
    out = sizes
    for a in AXES:
        out = out.withColumn(f"o{a}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n{a}").cast("long") - 1, F.lit(block[a]).cast("long"))))
    for a in AXES:
        out = out.withColumn(f"s{a}", F.least(F.lit(block[a]).cast("long"), F.col(f"n{a}") - F.col(f"o{a}")))
        out = out.withColumn(f"g{a}", F.expr(f"o{a} div {out_block[a]}"))
    return out.select(*keys, *[p + a for p in "osg" for a in AXES])


def offsets(boxes: DataFrame, spacing: dict[str, int], keys: list[str]) -> DataFrame:
    """Regularly spaced offsets from min_* to max_* (inclusive) of every box."""
    out = boxes
    for a, s in spacing.items():
        out = out.where(F.col(f"min_{a}") <= F.col(f"max_{a}"))
        out = out.withColumn(a, F.explode(F.sequence(F.col(f"min_{a}"), F.col(f"max_{a}"), F.lit(s).cast("long"))))
    return out.select(*keys, *spacing)


def grid_cell(offset: Column, low: Column, spacing: int) -> Column:
    return F.floor((offset - low) / F.lit(spacing))


def floor_scaled(value: Column, scale: float) -> Column:
    return F.floor(value * F.lit(float(scale)))


def ceil_scaled(value: Column, scale: float) -> Column:
    return F.ceil(value * F.lit(float(scale)))


def with_block(vox: DataFrame, block: dict[str, int]) -> DataFrame:
    return vox.withColumns({f"g{a}": F.expr(f"{a} div {b}") for a, b in block.items()})


def with_halo(vox: DataFrame, block: dict[str, int], halo: dict[str, int], sizes: DataFrame,
              keys: list[str] = KEY) -> DataFrame:
    """Copy every voxel into each block that needs it with a border of ``halo``
    voxels. Only voxels near a block face are copied more than once."""
    out = vox.join(small(sizes), keys)
    for a, b in block.items():
        h = halo.get(a, 0)
        first = F.greatest(F.lit(0).cast("long"), F.floor((F.col(a) - h) / b))
        last = F.least(F.floor((F.col(f"n{a}") - 1) / b), F.floor((F.col(a) + h) / b))
        out = out.withColumn(f"g{a}", F.explode(F.sequence(first, last)) if h else F.expr(f"{a} div {b}"))
    return out.drop(*[f"n{a}" for a in AXES])


def block_columns(blocks: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Blocks of one (x, y) column as a sorted array of grid z positions."""
    return blocks.groupBy(*keys, "gy", "gx").agg(
        F.sort_array(F.collect_set("gz")).alias("layers"), F.count(F.lit(1)).alias("n"))


def z_batch(last: Column, block: int, batch: Column, total: Column) -> list[Column]:
    """First and last z of a one-based batch; remainder blocks go to the first batches."""
    blocks = F.ceil(last / F.lit(float(block)))
    per, rest, i = F.floor(blocks / total), blocks % total, batch - 1
    start = (F.least(i, rest) * (per + 1) + F.greatest(F.lit(0), i - rest) * per) * block
    size = F.when(i < rest, per + 1).otherwise(per) * block
    return [start.alias("min_z"), (start + size - 1).alias("max_z")]


def included_blocks(blocks: DataFrame, min_z: int, max_z: int, positions: list[int] | None = None) -> DataFrame:
    """Blocks inside the z range of a run and, if given, at chosen grid z positions."""
    out = blocks.where((F.col("oz") >= min_z) & (F.col("oz") + F.col("sz") - 1 <= max_z))
    return out.where(F.col("gz").isin(positions)) if positions else out


# ---- points and boxes ---------------------------------------------------------

def points_in_box(points: DataFrame, box: dict[str, tuple]) -> DataFrame:
    for a, (low, high) in box.items():
        points = points.where(F.col(a).between(low, high))
    return points


def touched_cells(low: Column, high: Column, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(low / F.lit(cell)), F.floor(high / F.lit(cell))))


def points_in_blocks(points: DataFrame, boxes: DataFrame, cell: float, identity: list[str]) -> DataFrame:
    """Points inside any box (o* + s*): range join through the grid cells a box touches."""
    cells = boxes
    for a in ("x", "y", "z"):
        cells = cells.withColumn(f"c{a}", touched_cells(F.col(f"o{a}"), F.col(f"o{a}") + F.col(f"s{a}") - 1, cell))
    located = points.withColumns({f"c{a}": F.floor(F.col(a) / F.lit(cell)) for a in ("x", "y", "z")})
    inside = F.lit(True)
    for a in ("x", "y", "z"):
        inside = inside & F.col(f"p.{a}").between(F.col(f"b.o{a}"), F.col(f"b.o{a}") + F.col(f"b.s{a}") - 1)
    same = [F.col(f"p.c{a}") == F.col(f"b.c{a}") for a in ("x", "y", "z")]
    return located.alias("p").join(cells.alias("b"), [*same, inside], "left_semi").select(*identity)


def sliding_blocks(points: DataFrame, axis: str, step: float) -> DataFrame:
    """Assign points to blocks of one step that overlap by half: block i covers
    [i * step / 2, i * step / 2 + step)."""
    half = step / 2
    i = F.floor(F.col(axis) / F.lit(half))
    return points.withColumn("block", F.explode(F.array(i - 1, i))).where("block >= 0")


def overlap_blocks(a: DataFrame, b: DataFrame, keys: list[str], size: dict[str, float], min_points: int = 10) -> DataFrame:
    """Half-overlapping blocks that hold more than ``min_points`` points of both
    sides inside the common box of the two sides."""
    axes = list(size)

    def box(df, tag):
        return df.groupBy(*keys).agg(*[f(c).alias(f"{tag}{n}_{c}") for c in axes for n, f in (("lo", F.min), ("hi", F.max))])

    both = box(a, "a").join(box(b, "b"), keys)
    common = measured(both.select(*keys, *[F.greatest(f"alo_{c}", f"blo_{c}").alias(f"lo_{c}") for c in axes],
                                  *[F.least(f"ahi_{c}", f"bhi_{c}").alias(f"hi_{c}") for c in axes]))

    def counted(df, name):
        out = df.join(small(common), keys)
        for c in axes:
            half = size[c] / 2
            out = out.where(F.col(c).between(F.col(f"lo_{c}"), F.col(f"hi_{c}")))
            i = F.floor((F.col(c) - F.col(f"lo_{c}")) / F.lit(half))
            out = out.withColumn(f"block_{c}", F.explode(F.array(i - 1, i))).where(f"block_{c} >= 0")
        return out.groupBy(*keys, *[f"block_{c}" for c in axes]).agg(F.count(F.lit(1)).alias(name))

    blocks = counted(a, "na").join(counted(b, "nb"), keys + [f"block_{c}" for c in axes])
    return blocks.where((F.col("na") > min_points) & (F.col("nb") > min_points))
