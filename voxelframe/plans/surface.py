"""Surface jobs: mask levels and the way from a cost volume to flattened slabs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelframe.operators import pixel, stats, surface, transforms
from voxelframe.schema import KEY
from voxelframe.session import checkpoint

XY = [*KEY, "y", "x"]


def height_mask_levels(vox: DataFrame, field: DataFrame, factors: list[dict[str, int]]) -> list[DataFrame]:
    """Mask between two surfaces at full size and at every pyramid level."""
    full = pixel.heightfield_mask(vox, field)
    return [full, *transforms.pyramid_mean(full, factors)]


def flatten_slabs(vox: DataFrame, cost: DataFrame, factors: list[dict[str, int]], max_dz: int, min_distance: int,
                  max_distance: int, padding: float, search: int = 5) -> DataFrame:
    """Find both surfaces of every slab from coarse to fine, then flatten the volume.

    ``factors`` lead from each cost level to the next coarser one. Every level
    starts from the fields of the level above, which are written out so that the
    plan of one level stays small."""
    levels = [cost, *transforms.pyramid_mean(cost, factors)]
    shrink = 1
    for f in factors:
        shrink *= f.get("z", 1)
    pair = checkpoint(surface.initial_surfaces(levels[-1], max_dz, max(1, min_distance // shrink), max(1, max_distance // shrink)))
    fields = {c: pair.select(*XY, F.col(c).alias("h")) for c in ("hmin", "hmax")}
    for level, f in zip(reversed(levels[:-1]), reversed(factors)):
        fields = {c: checkpoint(surface.refine_surface(level, h, f, search, max_dz)) for c, h in fields.items()}
    mask = stats.cost_mask(cost)
    both = checkpoint(surface.order_by_mean(fields["hmin"], fields["hmax"], mask))
    # a column whose surfaces touch has nothing between them: keep them one voxel apart
    both = both.withColumn("hmax", F.greatest(F.col("hmax"), F.col("hmin") + 1))
    low = stats.weighted_mean(both, KEY, "hmin").select(*KEY, F.col("mean").alias("low"))
    high = stats.weighted_mean(both, KEY, "hmax").select(*KEY, F.col("mean").alias("high"))
    return transforms.flatten_volume(vox, both.drop("m"), low.join(high, KEY), padding)
