"""Compositing of overlapping volumes. Inputs are united and folded with one
aggregation, which combines on the map side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.operators.pixel import combine
from voxelframe.schema import POS, clamp


def _united(volumes: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [v.select(*POS, "v") for v in volumes])


def additive(volumes: list[DataFrame], overflow: str = "wrap", dtype: str = "u8") -> DataFrame:
    """Sum of overlapping volumes; u8 overflow wraps or saturates."""
    total = F.sum("v")
    limits = {"saturate": clamp(total, dtype), "wrap": total % 256}
    return _united(volumes).groupBy(*POS).agg(limits[overflow].alias("v"))


def max_fusion(volumes: list[DataFrame], dtype: str = "u16") -> DataFrame:
    """Greatest value of overlapping resampled stacks, rounded to the pixel type."""
    from voxelframe.functions.scalar import to_pixel

    return _united(volumes).groupBy(*POS).agg(to_pixel(F.max("v"), dtype).alias("v"))


def overlay(top: DataFrame, bottom: DataFrame, inside_top: Column, inside_bottom: Column, background: int = 0) -> DataFrame:
    """``top`` inside its box, else ``bottom`` inside its own; elsewhere background."""
    ranked = top.select(*POS, "v", F.when(inside_top, 0).otherwise(2).alias("rank")).unionByName(
        bottom.select(*POS, "v", F.when(inside_bottom, 1).otherwise(2).alias("rank")))
    best = F.min(F.struct("rank", "v"))
    return ranked.groupBy(*POS).agg(best.alias("b")).select(
        *POS, F.when(F.col("b.rank") == 2, F.lit(background)).otherwise(F.col("b.v")).alias("v"))


def merge_costs(costs: list[DataFrame]) -> DataFrame:
    """Pointwise minimum of cost volumes."""
    return reduce(lambda a, b: combine(a, b, "min"), costs)


def union_matches(sets: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sets)
