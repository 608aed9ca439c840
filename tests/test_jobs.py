"""Whole jobs on small planted cases, storage and plans."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.operators import stencils, transforms
from voxelframe.plans import registration
from voxelframe.session import small
from voxelframe.sources import volumes


def faces(spark, shift):
    a = 1 + np.random.default_rng(21).integers(0, 250, size=(40, 44))
    b = np.roll(a, shift, axis=1)
    rows = []
    for name, image in (("a", a), ("b", b)):
        y, x = [i.ravel() for i in np.indices(image.shape)]
        rows.append(pd.DataFrame({"dataset": name, "z": 0, "y": y, "x": x, "v": image.ravel()}))
    vox = spark.createDataFrame(pd.concat(rows))
    names = spark.createDataFrame([("a",), ("b",)], "dataset string")
    sizes = names.selectExpr("dataset", "1L AS nz", "40L AS ny", "44L AS nx")
    bounds = names.selectExpr("dataset", "0.0D AS min_x", "43.0D AS max_x", "0.0D AS min_y", "39.0D AS max_y")
    field = transforms.output_grid(sizes, ("y", "x")).selectExpr("dataset", "y AS iy", "x AS ix", "double(x) AS tx", "double(y) AS ty")
    return vox, spark.createDataFrame([(0, "a", "b")], "pair long, a string, b string"), sizes, bounds, field


@pytest.mark.parametrize("symmetric", [False, True])
def test_alignment_pass_finds_a_shift(spark, symmetric):
    vox, pairs, sizes, bounds, field = faces(spark, 3)
    options = {"min_inliers": 5, "iterations": 100, "epsilon": 1.5, "kind": "translation"}
    if not symmetric:
        options |= {"regularizer": None, "lam": 0.0}
    out = registration.align_pass(vox, field, pairs, bounds, sizes, 22, symmetric,
                                  {"sigma": 0.8, "threshold": 2.0, "radius": 5, "cells": 2, "noise": None}, **options).toPandas()
    inner = out.query("ix >= 8 and ix < 34 and iy >= 8 and iy < 30")
    moved = inner.assign(d=inner.tx - inner.ix, e=inner.ty - inner.iy).groupby("dataset")[["d", "e"]].median()
    assert abs(moved.d["b"] - moved.d["a"] - 3) < 0.2 and abs(moved.e["b"] - moved.e["a"]) < 0.2
    assert abs(moved.d["a"] + 1.5) < 0.2 if symmetric else moved.d["a"] == 0


def test_unwarping_with_identity_parameters_changes_nothing(spark, make, sizes_of, cube):
    v = np.random.default_rng(22).integers(0, 256, size=(6, 7, 8))
    sizes = sizes_of(v)
    flat = transforms.output_grid(sizes, ("y", "x"))
    field = flat.selectExpr("dataset", "y AS iy", "x AS ix", "double(x) AS tx", "double(y) AS ty")
    heights = flat.withColumn("h", F.lit(1.0))
    out = registration.unwarp_volume(make(v), sizes, heights, field, field, F.lit(1.0), (0.0, 0.0, 1.0), 1.0, 4.0, 5.0,
                                     [(2, 4), (2, 4), (2, 3)], [0.0, 0.0, 0.0], [1.0, 1.0, 1.0])
    assert np.allclose(cube(out, v.shape), v)


def test_channel_alignment_recovers_the_shear(spark):
    rng = np.random.default_rng(23)
    rows = []
    for z in range(5):
        if z == 3:
            continue  # slice 4 stays isolated
        for x, y in rng.uniform(0, 50, size=(8, 2)):
            if z + 1 < 5:
                rows.append((0, 0, z, z + 1, float(x), float(y), float(x - 2), float(y + 1), 1.0))
    matches = spark.createDataFrame(rows, "stack long, channel long, a long, b long, px double, py double, qx double, qy double, w double")
    slices = spark.createDataFrame([(0, 0, z) for z in range(5)], "stack long, channel long, z long")
    got = {r.z: (r.tx, r.ty) for r in registration.align_channels(matches, slices, rounds=30).collect()}
    assert set(got) == set(range(5))
    for z, (tx, ty) in got.items():
        assert abs(tx - 2 * z) < 0.4 and abs(ty + z) < 0.4


def test_a_wrong_link_bends_its_surroundings_only(spark):
    """Four series on one shear; in one a link is off by 8. The shear keeps it near, the data alone do not."""
    rng = np.random.default_rng(24)
    rows = []
    for stack in range(4):
        for z in range(11):
            off = 8.0 if (stack, z) == (2, 5) else 0.0
            for x, y in rng.uniform(0, 50, size=(6, 2)):
                rows.append((stack, 0, z, z + 1, float(x), float(y), float(x - 2 + off), float(y + 1), 1.0))
    matches = spark.createDataFrame(rows, "stack long, channel long, a long, b long, px double, py double, qx double, qy double, w double")
    slices = spark.createDataFrame([(s, 0, z) for s in range(4) for z in range(12)], "stack long, channel long, z long")

    known = spark.createDataFrame([(0, 2.0, -1.0)], "channel long, sx double, sy double")

    def gaps(**options):
        got = registration.align_channels(matches, slices, shear=known, **options).collect()
        assert len(got) == 48
        return {(r.stack, r.z): abs(r.tx - 2 * r.z) + abs(r.ty + r.z) for r in got}

    kept, free = gaps(rounds=25), gaps(rounds=50, weights=(0.0,))
    assert max(v for (n, _), v in kept.items() if n != 2) < 0.05  # the other series lie on the shear
    assert max(v for (n, _), v in kept.items() if n == 2) < 4 and kept[2, 11] < 1 and kept[2, 1] < 1
    assert free[2, 8] > 2 and free[2, 8] > 2 * kept[2, 8]


def test_prefilter_like_numpy(make, sizes_of, cube):
    v = np.random.default_rng(24).integers(1, 256, size=(2, 14, 12))
    v[:, :3, :] = 0
    v[:, 11:, 4] = 0
    got = cube(stencils.prefilter(make(v), sizes_of(v), radius=2, reach=300), v.shape)
    want = v.astype(float)
    for z in range(2):
        for x in range(12):
            rows = np.nonzero(v[z, :, x])[0]
            part = v[z, rows[0]:rows[-1] + 1, x].astype(float)
            d = 3 * part.std(ddof=1)
            value = (part - (part.mean() - d)) / 2 / d * 255 if d > 0 else 0 * part
            want[z, rows[0]:rows[-1] + 1, x] = np.clip(np.floor(np.clip(value, 0, 255) + 0.5), 0, 255)
    wide = np.pad(want, ((0, 0), (2, 2), (2, 2)), mode="edge")
    disc = [(dy, dx) for dy in range(-2, 3) for dx in range(-2, 3) if dy * dy + dx * dx <= 5]
    for z, y, x in np.ndindex(v.shape):
        assert got[z, y, x] == np.median([wide[z, y + 2 + a, x + 2 + b] for a, b in disc])


def test_window_reads_are_pruned_and_pushed(spark, make, tmp_path):
    v = np.random.default_rng(25).integers(1, 256, size=(8, 6, 5))
    path = str(tmp_path / "volume")
    volumes.write_volume(make(v, "007"), path, block_z=2)
    with pytest.raises(Exception, match="already exists"):
        volumes.write_volume(make(v), path, block_z=2)
    out = volumes.read_volume(spark, path, {"z": (3, 5), "x": (1, 3)}, datasets=["007"])
    assert {r.dataset for r in out.collect()} == {"007"} and out.count() == 2 * 6 * 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(z,3)" in plan and "GreaterThanOrEqual(x,1)" in plan
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "z0" in filters.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_small_tables_are_broadcast_only_up_to_the_limit(spark):
    table, rows = spark.range(100).withColumnRenamed("id", "k"), spark.range(1000).selectExpr("id % 100 AS k", "id")
    assert "BroadcastHashJoin" in rows.join(small(table), "k")._jdf.queryExecution().executedPlan().toString()
    hint = small(table, limit=10)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in hint.lower()


def test_resuming_with_other_block_size_fails(spark):
    meta = spark.createDataFrame([("d", [5, 6, 7], [2, 2, 2], "u8", {"compression": "gzip"})],
                                 "dataset string, dims array<long>, block array<long>, dtype string, attrs map<string,string>")
    other = meta.withColumn("block", F.array(F.lit(4).cast("long"), F.lit(2).cast("long"), F.lit(2).cast("long")))
    assert volumes.check_consistent(meta, meta).count() == 1
    with pytest.raises(Exception, match="differs from its existing output"):
        volumes.check_consistent(meta, other).collect()
    for other in (meta.withColumn("attrs", F.create_map(F.lit("compression"), F.lit("raw"))), meta.withColumn("dataset", F.lit("e"))):
        with pytest.raises(Exception, match="differs from its existing output"):
            volumes.check_consistent(meta, other).collect()


def test_windows_do_not_depend_on_the_slab_height(spark, make, tmp_path):
    """Written in slabs of 4 without zeros; any window reads right and dense."""
    v = np.random.default_rng(26).integers(0, 3, size=(17, 5, 4))
    path = str(tmp_path / "volume")
    volumes.write_volume(make(v), path, background=0, block_z=4)
    sizes = spark.createDataFrame([("d", 17, 5, 4)], "dataset string, nz long, ny long, nx long")
    for low, high in ((8, 16), (3, 5), (0, 17), (16, 17)):
        got = {(r.z, r.y, r.x): r.v for r in volumes.read_volume(spark, path, {"z": (low, high), "x": (1, 3)}, sizes=sizes).collect()}
        assert got == {(z, y, x): v[z, y, x] for z in range(low, high) for y in range(5) for x in range(1, 3)}
