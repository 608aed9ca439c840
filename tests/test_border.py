"""Neighbourhood operators on blocks against numpy on whole arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelframe.operators import blocks, border, features, labels

SHAPE = (7, 11, 13)
BLOCK = {"z": 2, "y": 4, "x": 6}


@pytest.fixture(scope="module")
def volume():
    return np.random.default_rng(3).integers(0, 255, SHAPE)


def _unpacked(df, dtype="f64"):
    return blocks.to_voxels(df, BLOCK, dtype)


@pytest.mark.parametrize("mode", ["mirror_single", "mirror_double", "border", "constant"])
def test_border_wider_than_a_block(make, sizes_of, cube, volume, mode):
    """A kernel over five layers each way on blocks of two layers."""
    packed = border.Layer(blocks.to_blocks(make(volume), BLOCK, sizes_of(volume)))
    got = cube(_unpacked(border.gauss(packed, {"z": 1.5, "x": 2.0}, BLOCK, sizes_of(volume), mode, 9.0)), SHAPE)
    assert np.allclose(got, border.smoothed(volume, {"z": 1.5, "x": 2.0}, mode, 9.0), atol=1e-9)


def test_smoothing_by_definition(volume):
    kernel = border.half_kernel(1.0)
    line = volume[2, 3].astype(float)
    n, reach = len(line), len(kernel) - 1
    mirrored = [abs(i) if abs(i) < n else 2 * (n - 1) - abs(i) for i in range(-reach, n + reach)]
    want = [sum(kernel[abs(o)] * line[mirrored[i + reach + o]] for o in range(-reach, reach + 1)) for i in range(n)]
    assert np.allclose(border.smoothed(volume, {"x": 1.0})[2, 3], want, atol=1e-9)


def test_box_sums_are_cut_at_the_ends(volume):
    got = border.box(volume, {"x": 3, "y": 20})
    assert all(got[z, y, x] == volume[z, :, max(0, x - 3):x + 4].sum() for z, y, x in np.ndindex(*SHAPE))


def test_absent_blocks_are_background(make, sizes_of, cube, volume):
    """A volume stored without its black blocks gives the result of the whole volume."""
    hollow = volume * (np.arange(SHAPE[2]) >= 12)
    stored = border.Layer(blocks.to_blocks(make(hollow).where("x >= 12"), BLOCK, sizes_of(hollow)))
    assert stored.blocks.select("gx").distinct().count() == 1
    got = cube(_unpacked(border.local_contrast(stored, 3, 2, BLOCK, sizes_of(hollow), stretch=False)), SHAPE)
    n, total = border.box(np.ones(SHAPE), {"x": 3, "y": 2}), border.box(hollow, {"x": 3, "y": 2})
    assert np.allclose(got, hollow - total / n + 127.5)


def test_only_faces_move(make, sizes_of, volume):
    """Parts of neighbours carry no more than the borders of the blocks."""
    sizes = sizes_of(volume)
    packed = border.Layer(blocks.to_blocks(make(volume), BLOCK, sizes))
    moved = border.pieces([packed], BLOCK, {"z": 1, "y": 1, "x": 1}, sizes).agg(F.sum(F.length("data"))).first()[0]
    with_borders = 0
    for z, y, x in np.ndindex(*[-(-n // b) for n, b in zip(SHAPE, BLOCK.values())]):
        spans = [min(n, (i + 1) * b + 1) - max(0, i * b - 1) for i, b, n in zip((z, y, x), BLOCK.values(), SHAPE)]
        with_borders += np.prod(spans)
    assert moved == with_borders


def test_blobs_equal_those_of_voxel_rows(make, sizes_of):
    z, y, x = np.mgrid[:12, :16, :18]
    spots = [(3, 4, 5), (4, 8, 11), (8, 12, 6), (7, 3, 12)]  # at and across the faces of blocks
    volume = sum(200 * np.exp(-((z - a) ** 2 + (y - b) ** 2 + (x - c) ** 2) / 4) for a, b, c in spots).astype(int)
    packed = border.Layer(blocks.to_blocks(make(volume), BLOCK, sizes_of(volume)))
    order = ["z", "y", "x", "px", "py", "pz", "intensity"]
    got = border.detect_dog(packed, 1.4, 3.0, BLOCK, sizes_of(volume)).select(order).orderBy("z", "y", "x").collect()
    want = features.detect_dog(make(volume), 1.4, 3.0, sizes_of(volume)).select(order).orderBy("z", "y", "x").collect()
    assert {tuple(r[:3]) for r in got} == set(spots)
    assert np.allclose(np.array([tuple(r) for r in got]), np.array([tuple(r) for r in want]))


def test_pyramid_drops_odd_ends_and_needs_even_blocks(make, sizes_of, cube, volume):
    packed = border.Layer(blocks.to_blocks(make(volume), BLOCK, sizes_of(volume)))
    (first, extent), (second, _) = border.pyramid_gauss(packed, 2, BLOCK, sizes_of(volume))
    assert extent.select("nz", "ny", "nx").first() == (3, 5, 6)
    sigma = {a: np.sqrt(0.75) for a in "zyx"}
    want = border.smoothed(volume, sigma)[:6:2, :10:2, :12:2]
    assert np.allclose(cube(_unpacked(first), (3, 5, 6)), want)
    assert np.allclose(cube(_unpacked(second), (1, 2, 3)), border.smoothed(want, sigma)[:2:2, :4:2, :6:2])
    with pytest.raises(ValueError):
        border.pyramid_gauss(packed, 1, {**BLOCK, "x": 5}, sizes_of(volume))


def test_integer_results_and_empty_tables(make, sizes_of, cube, volume):
    sizes = sizes_of(volume)
    packed = border.Layer(blocks.to_blocks(make(volume), BLOCK, sizes))
    got = cube(_unpacked(border.gauss(packed, {"y": 1.0}, BLOCK, sizes, out_dtype="u8"), "u8"), SHAPE)
    assert np.array_equal(got, np.floor(border.smoothed(volume, {"y": 1.0}) + 0.5))
    none = border.Layer(packed.blocks.where("false"))
    assert border.map_bordered([none], lambda v: v, BLOCK, {}, sizes.where("false")).count() == 0
    assert cube(_unpacked(border.gradient_magnitude(none, BLOCK, sizes)), SHAPE).max() == 0


@pytest.mark.parametrize("first,sites", [(-0.5, 12), (0.5, 10), (0.0, 1)])
def test_lower_envelope_is_the_least_parabola(first, sites):
    rng = np.random.default_rng(sites)
    heights = rng.integers(0, 60, (sites, 400)) * 1.0
    heights[rng.random(heights.shape) < 0.3] = np.inf
    heights[:, 0] = np.inf  # a line without a site
    heights[:, 1] = 5.0  # ties
    got = labels.lower_envelope(heights, first, 1.75, 11)
    at = np.arange(11)[:, None, None] - first - np.arange(sites)[None, :, None]
    assert np.allclose(got, (heights[None] + 1.75 * at ** 2).min(axis=1))


def test_distance_blocks_by_all_faces(make, sizes_of, cube):
    """Several labels with holes; bars of 4 x 4 lines over blocks that do not divide the volume."""
    rng = np.random.default_rng(8)
    volume = np.kron(rng.integers(0, 4, (2, 3, 4)), np.ones((3, 4, 4), dtype=int))[:6, :11, :13]
    block, resolution = {"z": 4, "y": 5, "x": 6}, {"z": 3.0, "y": 2.0, "x": 1.0}
    packed = border.Layer(blocks.to_blocks(make(volume), block, sizes_of(volume), "u16"), "u16")
    got = cube(blocks.to_voxels(labels.distance_blocks(packed, resolution, block, sizes_of(volume), tile=4), block, "u16"), volume.shape)
    step = np.array([resolution[a] for a in "zyx"])
    faces = []  # (centre in half voxels, axis)
    for axis in range(3):
        for p in np.ndindex(*[n + (i == axis) for i, n in enumerate(volume.shape)]):
            before = tuple(c - (i == axis) for i, c in enumerate(p))
            edge = p[axis] in (0, volume.shape[axis])
            if edge or volume[before] != volume[p] or volume[before] == 0:
                faces.append([2 * c + (i != axis) for i, c in enumerate(p)] + [axis])
    faces = np.array(faces)
    for p in np.ndindex(*volume.shape):
        gap = np.abs(2 * np.array(p) + 1 - faces[:, :3]).astype(float)
        across = np.arange(3)[None] == faces[:, 3:]
        gap = np.where(across, gap, np.maximum(0, gap - 1))
        assert got[p] == np.floor(np.sqrt(((gap * step / 2) ** 2).sum(axis=1).min()) + 0.5)
