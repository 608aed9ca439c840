"""Ingest: slices or tiles to blocks of a volume in one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.operators import blocks
from voxelframe.sources import volumes


def slices_to_blocks(slices: DataFrame, height: int, width: int, block: dict[str, int], sizes: DataFrame, dtype: str = "u8",
                     low: dict[str, int] | None = None) -> DataFrame:
    """Blocks straight from slice rows (dataset, z, data), cropped at ``low``.

    A slice is a block of one layer, so it is cut along the target grid and the
    pieces meet in one shuffle, without ever becoming voxel rows. Slices that do
    not exist leave background."""
    rows = slices.select("dataset", F.col("z").alias("gz"), F.lit(0).cast("long").alias("gy"), F.lit(0).cast("long").alias("gx"),
                         F.lit(1).cast("long").alias("nz"), F.lit(height).cast("long").alias("ny"), F.lit(width).cast("long").alias("nx"), "data")
    return blocks.reblock(rows, {"z": 1, "y": height, "x": width}, block, sizes, dtype, low)


def tiles_to_volume(tiles: DataFrame, tile: dict[str, int], block: dict[str, int], sizes: DataFrame, path: str,
                    dtype: str = "u8", low: dict[str, int] | None = None, mode: str = "error") -> None:
    """Assemble tiles and write the non-empty voxels as a volume table."""
    packed = volumes.assemble_tiles(tiles, tile, block, sizes, low, dtype)
    volumes.write_volume(blocks.to_voxels(packed, block, dtype, skip_background=True), path, mode=mode)
