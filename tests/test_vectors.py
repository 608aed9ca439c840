"""Fixed cases: flatten vectors, slab plan, counting image, integer transforms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelframe.functions import affine, scalar
from voxelframe.operators import grid, joins, stats, transforms

HEIGHTS = [(0, 0, 1.0, 11.0), (1, 0, 2.0, 22.0), (2, 0, 3.0, 33.0), (0, 1, 4.0, 44.0), (1, 1, 5.0, 55.0), (2, 1, 6.0, 66.0)]
VECTORS = [(0, 0, 1, 100), (0, 0, 6, 150), (0, 0, 11, 200), (1, 0, 2, 100), (1, 0, 22, 200), (2, 0, 3, 100), (2, 0, 18, 150), (2, 0, 33, 200)]


def test_flatten_vectors(spark):
    field = spark.createDataFrame(HEIGHTS, "x long, y long, hmin double, hmax double")
    rows = spark.createDataFrame([(x, y, float(z), float(t)) for x, y, z, t in VECTORS], "x long, y long, s double, t double").join(field, ["x", "y"])
    low, high = F.lit(100.0), F.lit(200.0)
    args = (F.col("hmin"), F.col("hmax"), low, high)
    out = rows.select("s", "t", transforms.flatten_z(F.col("s"), *args).alias("f"), transforms.unflatten_z(F.col("t"), *args).alias("b")).collect()
    assert len(out) == 8
    for r in out:
        assert abs(r.f - r.t) < 0.01 and abs(r.b - r.s) < 0.01


def test_blocks_of_a_run_are_included(spark):
    sizes = spark.createDataFrame([("v", 92316, 73351, 59817)], "dataset string, nz long, ny long, nx long")
    blocks = grid.grid(sizes, {"x": 1024, "y": 1024, "z": 128}, {"x": 128, "y": 128, "z": 128})
    kept = grid.included_blocks(blocks, 44032, 46335)
    found = {r.gz for r in kept.select("gz").distinct().collect()}
    assert 361 in found and found == set(range(344, 362))
    assert {r.gz for r in grid.included_blocks(blocks, 44032, 46335, [361]).select("gz").distinct().collect()} == {361}


def test_slab_offsets_run(spark):
    rows = [(i, f"s{i}", 20, 1435 + 40 * i) for i in range(35)]
    slabs = spark.createDataFrame(rows, "ord long, dataset string, top long, bot long")
    got = {r.ord: r.zoff for r in joins.slab_offsets(slabs).collect()}
    run = 0
    for i, _, top, bot in rows:
        assert got[i] == run
        run += bot - top + 1


def test_counting_image_subsample(spark):
    rows = [("d", 0, i // 4, i % 4, i) for i in range(16)]
    vox = spark.createDataFrame(rows, "dataset string, z long, y long, x long, v long")
    out = stats.random_subsample(vox, 3).collect()
    assert sorted(r.v for r in out) == list(range(16))
    for r in out:
        assert (r.v // 4) // 2 == r.y and (r.v % 4) // 2 == r.x
    assert {r.output for r in out} == {0, 1, 2, 3}


@pytest.mark.parametrize("seed", range(3))
def test_integer_resample_matches_numpy(spark, make, sizes_of, cube, seed):
    rng = np.random.default_rng(seed)
    volume = rng.integers(0, 256, size=(8, 15, 11))
    m = rng.integers(-10, 10, size=12).tolist()
    vox = make(volume)
    got = cube(transforms.resample_integer(vox, vox.select("dataset", "z", "y", "x"), m, sizes_of(volume)), volume.shape)

    def mirror(p, n):
        p = p % (2 * n - 2)
        return np.where(p < n, p, 2 * n - 2 - p)

    z, y, x = np.indices(volume.shape)
    s = [x * m[r] + y * m[r + 1] + z * m[r + 2] + m[r + 3] for r in (0, 4, 8)]
    want = volume[mirror(s[2], 8), mirror(s[1], 15), mirror(s[0], 11)]
    assert np.array_equal(got, want)


def test_affine_inverse_and_concatenation(spark):
    m = [2.0, 0.5, 0.0, 3.0, 0.25, 1.0, 0.125, -1.0, 0.0, -0.5, 4.0, 2.0]
    row = spark.range(1).select(F.array(*[F.lit(c) for c in m]).alias("m")).withColumn("i", affine.invert3(F.col("m")))
    got = row.select(affine.concatenate(F.col("m"), F.col("i"), 3).alias("u")).first().u
    assert np.allclose(np.array(got).reshape(3, 4), np.eye(3, 4))


def test_bad_values_fail(spark):
    with pytest.raises(Exception, match="between 1 and"):
        spark.range(1).select(scalar.parse_batch(F.lit("7:3")).alias("p")).collect()
    with pytest.raises(Exception, match="six values"):
        spark.range(1).select(affine.parse_affine(F.lit("[1,2,3]")).alias("p")).collect()
    assert spark.range(1).select(scalar.parse_numbers(F.lit("1,x")).alias("p")).first().p is None


def test_half_up_rounds_towards_plus_infinity(spark):
    got = spark.createDataFrame([(-2.5,), (-0.5,), (0.5,), (2.5,)], "v double").select(scalar.half_up(F.col("v")).alias("r"))
    assert [r.r for r in got.collect()] == [-2, 0, 1, 3]
