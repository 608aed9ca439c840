"""Export plans: which blocks an export run covers, and the aligned volume itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.functions.scalar import to_pixel
from voxelframe.operators import blocks, compose, gather, joins, pixel, stencils
from voxelframe.operators.transforms import face_positions
from voxelframe.schema import KEY, POS
from voxelframe.session import measured


def plan_export(blocks: DataFrame, slabs: DataFrame, cell: int) -> DataFrame:
    """Blocks of an export with every slab that contributes, without computing pixels."""
    return joins.blocks_of_slabs(blocks, slabs.withColumnRenamed("dataset", "slab"), cell)


def place_slabs(slabs: DataFrame) -> DataFrame:
    """Resolve bottom offsets below 0 (counted from the end of the slab, ``nz``) and add z offsets."""
    return joins.slab_offsets(slabs.withColumn("bot", F.when(F.col("bot") < 0, F.col("nz") + F.col("bot")).otherwise(F.col("bot"))))


def export_slabs(vox: DataFrame, slabs: DataFrame, grid: DataFrame, top: DataFrame, bottom: DataFrame,
                 z_range: tuple[int, int] | None = None, normalize: tuple[int, int] | None = None,
                 overflow: str | None = None, scale: float = 1.0, name: str = "aligned", sizes: DataFrame | None = None,
                 block: dict[str, int] | None = None) -> DataFrame:
    """One aligned volume from a series of slabs, as voxels.

    Voxels are packed into blocks first; slabs that are stored as blocks go to ``export_blocks`` as they are.
    ``normalize`` applies local contrast with these radii. Background voxels are not stored. Slabs placed by
    running offsets do not overlap; give ``overflow`` to add slabs that do."""
    block = block or gather.DEFAULT
    sizes = pixel.extents(vox) if sizes is None else measured(sizes)
    out = gather.placed_voxels(export_blocks(blocks.to_blocks(vox, block, sizes), block, slabs, grid, top, bottom, sizes, z_range, scale, name), "u8", 0)
    if overflow is not None:
        out = compose.additive([out], overflow)
    if normalize is not None:
        out = stencils.local_contrast(out, *normalize, limit=10.0, gamma=0.5, keep_min_max=True).select(
            *POS, to_pixel(F.col("v")).alias("v"))
    return out.where(F.col("v") != 0)


def export_blocks(source: DataFrame, block: dict[str, int], slabs: DataFrame, grid: DataFrame, top: DataFrame, bottom: DataFrame,
                  sizes: DataFrame, z_range: tuple[int, int] | None = None, scale: float = 1.0, name: str = "aligned",
                  out_block: dict[str, int] | None = None) -> DataFrame:
    """Blocks of one aligned volume from blocks of slabs. Each slab layer reads its source through the mix of the
    transforms of its two faces and moves to its place in the series. ``grid`` holds the output pixels (y, x) of every
    slab; face positions are looked up once per pixel column. A z range limits the blocks before any pixel is read."""
    placed = place_slabs(slabs).select(*KEY, "top", "bot", "zoff")
    return gather.mixed_faces_blocks(source, block, face_positions(grid, top, bottom, scale), placed, sizes, out_block or block, z_range, name=name)
