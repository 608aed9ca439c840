"""Gathers on blocks against numpy on whole arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelframe.operators import blocks, gather
from voxelframe.plans import export

SHAPE = (9, 14, 17)
BLOCK = {"z": 4, "y": 5, "x": 6}


def _volume(spark, seed=1, names=("a", "b")):
    rng = np.random.default_rng(seed)
    cubes = {n: rng.integers(1, 255, SHAPE) for n in names}
    rows = [(n, z, y, x, int(c[z, y, x])) for n, c in cubes.items() for z, y, x in np.ndindex(*SHAPE)]
    sizes = spark.createDataFrame([(n, *SHAPE) for n in names], "dataset string, nz long, ny long, nx long")
    return cubes, spark.createDataFrame(rows, "dataset string, z long, y long, x long, v long"), sizes


def _at(cube, z, y, x, background, linear=True):
    """Value at one position by the definition."""
    def look(p):
        return cube[p] if all(0 <= i < n for i, n in zip(p, cube.shape)) else background

    if not linear:
        return look(tuple(int(np.floor(v + 0.5)) for v in (z, y, x)))
    low = [int(np.floor(v)) for v in (z, y, x)]
    part = [v - l for v, l in zip((z, y, x), low)]
    return sum(look(tuple(l + i for l, i in zip(low, c))) * np.prod([p if i else 1 - p for p, i in zip(part, c)]) for c in np.ndindex(2, 2, 2))


@pytest.mark.parametrize("linear", [True, False])
def test_affine_blocks(spark, linear):
    cubes, vox, sizes = _volume(spark)
    models = {"a": [0.9, 0.2, -0.1, 1.3, -0.2, 1.1, 0.05, -2.6, 0.3, -0.1, 0.8, 0.4], "b": [-1.0, 0, 0, 16, 0, 2.5, 0, -9, 0, 0, 1, 0]}
    table = spark.createDataFrame([(n, [float(c) for c in m]) for n, m in models.items()], "dataset string, m array<double>")
    packed = blocks.to_blocks(vox, BLOCK, sizes)
    placed = gather.affine_blocks(packed, BLOCK, table, sizes, {"z": 5, "y": 4, "x": 7}, 9.0, linear)
    got = {(r["dataset"], r["z"], r["y"], r["x"]): r["v"] for r in gather.placed_voxels(placed).collect()}
    assert len(got) == 2 * np.prod(SHAPE)
    for (n, z, y, x), v in got.items():
        m = np.array(models[n]).reshape(3, 4)
        sx, sy, sz = [r[0] * x + r[1] * y + r[2] * z + r[3] for r in m]  # in this order: ties of the nearest voxel
        assert v == pytest.approx(_at(cubes[n], sz, sy, sx, 9.0, linear), abs=1e-9)


def test_absent_blocks_read_background(spark):
    _, vox, sizes = _volume(spark, names=("a",))
    packed = blocks.to_blocks(vox.where("x >= 12"), BLOCK, sizes)
    still = sizes.select("dataset", F.array(*[F.lit(float(v)) for v in (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0)]).alias("m"))
    got = gather.placed_voxels(gather.affine_blocks(packed, BLOCK, still, sizes, BLOCK, 3.0)).groupBy("x").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    assert {r["x"] for r in got.collect() if r["a"] == r["b"] == 3.0} == set(range(12))
    gone = still.withColumn("m", F.array(*[F.lit(float(v)) for v in (1, 0, 0, 500, 0, 1, 0, 0, 0, 0, 1, 0)]))
    assert {r["v"] for r in gather.placed_voxels(gather.affine_blocks(packed, BLOCK, gone, sizes, BLOCK, 3.0)).collect()} == {3.0}


def test_flattened_blocks_skip_absent_columns(spark):
    cubes, vox, sizes = _volume(spark, names=("a",))
    rng = np.random.default_rng(4)
    field = [("a", y, x, float(rng.uniform(0, 2)), float(rng.uniform(5, 8))) for y in range(SHAPE[1]) for x in range(SHAPE[2]) if (y, x) != (3, 3)]
    rows = spark.createDataFrame(field, "dataset string, y long, x long, hmin double, hmax double")
    planes = spark.createDataFrame([("a", 1.25, 6.5, 0, 8)], "dataset string, low double, high double, first long, last long")
    placed = gather.flattened_blocks(blocks.to_blocks(vox, BLOCK, sizes), BLOCK, rows, planes, sizes, {"z": 2, "y": 6, "x": 5})
    got = {(r["z"], r["y"], r["x"]): r["v"] for r in gather.placed_voxels(placed, "u8").collect()}
    assert got[4, 3, 3] == 0 and len(got) == 9 * SHAPE[1] * SHAPE[2]
    for _, y, x, low, high in field:
        for z in range(9):
            want = _at(cubes["a"], (z - 1.25) / 5.25 * (high - low) + low, y, x, 0.0)
            assert got[z, y, x] == int(np.floor(np.clip(want, 0, 255) + 0.5))


def test_slabs_go_to_their_place(spark):
    """Two slabs in a row; a z range leaves out blocks before they are read; each layer reads between its faces."""
    cubes, vox, sizes = _volume(spark)
    slabs = spark.createDataFrame([("a", 0, 1, 7, 9), ("b", 1, 2, -1, 9)], "dataset string, ord long, top long, bot long, nz long")
    grid = spark.createDataFrame([(n, y, x) for n in "ab" for y in range(SHAPE[1]) for x in range(SHAPE[2])], "dataset string, y long, x long")
    faces = {}
    for side, (dx, dy) in {"top": (0.5, -0.25), "bottom": (-2.0, 1.0)}.items():
        faces[side] = grid.select("dataset", F.col("y").alias("iy"), F.col("x").alias("ix"), (F.col("x") + dx).alias("tx"), (F.col("y") + dy).alias("ty"))
    packed = blocks.to_blocks(vox, BLOCK, sizes)
    placed = {r["dataset"]: r for r in export.place_slabs(slabs).collect()}
    want = {}
    for n, r in placed.items():
        for sz in range(r["top"], r["bot"] + 1):
            lam = (sz - r["top"]) / (r["bot"] - r["top"])
            for y in range(SHAPE[1]):
                for x in range(SHAPE[2]):
                    v = _at(cubes[n], sz, y - 0.25 + lam * 1.25, x + 0.5 - lam * 2.5, 0.0)
                    want[sz - r["top"] + r["zoff"], y, x] = v
    for z_range in (None, (5, 9)):
        out = export.export_blocks(packed, BLOCK, slabs, grid, faces["top"], faces["bottom"], sizes, z_range, out_block={"z": 3, "y": 8, "x": 8})
        got = {(r["z"], r["y"], r["x"]): r["v"] for r in gather.placed_voxels(out, "u8", 0).collect()}
        asked = {k: v for k, v in want.items() if z_range is None or z_range[0] <= k[0] <= z_range[1]}
        assert set(got) <= set(asked) and all(abs(got.get(k, 0) - v) <= 0.5 + 1e-9 for k, v in asked.items())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode(data" not in plan and plan.count("FlatMapCoGroupsInPandas") == 1
