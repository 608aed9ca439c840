"""Queries over neighbourhood operators on blocks; their SQL is that of the same operator on voxel rows."""

from pyspark.sql import functions as F

from catalog.registry import RAW, query
from catalog.registration import S1
from catalog.stencils import SIGMA, WEIGHTED
from catalog.surfaces import outside
from voxelframe.operators import blocks, border, pixel

BLOCK = {"z": 16, "y": 10, "x": 14}


def layer(f, vox=None, dtype="u8"):
    return border.Layer(blocks.to_blocks(f.em if vox is None else vox, BLOCK, pixel.extents(f.em), dtype), dtype)


def on_blocks(name):
    """Register ``name`` on blocks: the function gives real blocks, the query their voxels."""
    _, columns, sql = RAW[name]

    def wrap(fn):
        query(f"{name}_blocks", columns, sql)(lambda f: blocks.to_voxels(fn(f, pixel.extents(f.em)), BLOCK, "f64"))
        return fn

    return wrap


@on_blocks("w1_gauss")
def _(f, sizes):
    return border.gauss(layer(f), {"x": 1.5, "y": 1.0, "z": 0.0}, BLOCK, sizes)


@on_blocks("w2_weighted_gauss")
def _(f, sizes):
    data = f.sql(WEIGHTED)
    weight = layer(f, data.select("dataset", "z", "y", "x", F.col("w").cast("long").alias("v")))
    return border.weighted_gauss(layer(f, data.drop("w")), weight, {"x": 1.0, "y": 1.0}, BLOCK, sizes)


CONTRASTS = {"w3_local_contrast": {}, "w3_local_contrast_center": {"stretch": False}, "w3_local_contrast_stretch": {"center": False},
             "w3_local_contrast_soft": {"limit": 2.0, "gamma": 0.5, "keep_min_max": True}, "w4_classic_contrast": {"cut": True}}
for name, choice in CONTRASTS.items():
    on_blocks(name)(lambda f, sizes, choice=choice: border.local_contrast(layer(f), 4, 3, BLOCK, sizes, **choice))


@on_blocks("w7_median_z3")
def _(f, sizes):
    return border.median_z3(layer(f), 90, BLOCK, sizes)


@on_blocks("w8_gradient_forward")
def _(f, sizes):
    return border.gradient_forward(layer(f), "x", BLOCK, sizes)


@on_blocks("w9_gradient_center")
def _(f, sizes):
    return border.gradient_center(layer(f), "y", 1.5, BLOCK, sizes)


@on_blocks("w10_gradient_magnitude")
def _(f, sizes):
    return border.gradient_magnitude(layer(f), BLOCK, sizes)


@on_blocks("w11_tubeness")
def _(f, sizes):
    return border.tubeness(layer(f), SIGMA, BLOCK, sizes)


@query("w12_black_neighbour_blocks", *RAW["w12_black_neighbour"][1:])
def _(f):
    near = border.black_neighbour(layer(f), BLOCK, pixel.extents(f.em))
    return blocks.to_voxels(near, BLOCK).select("dataset", "z", "y", "x", (F.col("v") == 1).alias("black"))


@query("m1_detect_dog_blocks", *RAW["m1_detect_dog"][1:])
def _(f):
    return border.detect_dog(layer(f), S1, 0.5, BLOCK, pixel.extents(f.em))


@query("c1_derivative_cost_filtered_blocks", *RAW["c1_derivative_cost_filtered"][1:])
def _(f):
    cost = border.derivative_cost(layer(f), outside(f), BLOCK, pixel.extents(f.em), median=True, smooth=True)
    return blocks.to_voxels(cost, BLOCK)


@on_blocks("t21_pyramid_gauss")
def _(f, sizes):
    return border.pyramid_gauss(layer(f), 1, BLOCK, sizes)[0][0]
