"""Operators on volumes against plain numpy."""

import itertools

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxelframe.operators import blocks, cost, features, labels, pixel, stencils, surface, transforms
from voxelframe.operators.resample import interpolate


def volume(shape, seed=0, high=256):
    return np.random.default_rng(seed).integers(0, high, size=shape)


def test_reblock_round_trip(make, sizes_of, cube):
    v = volume((5, 7, 9), 1)
    first = blocks.to_blocks(make(v), {"z": 2, "y": 3, "x": 4}, sizes_of(v))
    second = blocks.reblock(first, {"z": 2, "y": 3, "x": 4}, {"z": 3, "y": 5, "x": 2}, sizes_of(v))
    third = blocks.reblock(second, {"z": 3, "y": 5, "x": 2}, {"z": 2, "y": 3, "x": 4}, sizes_of(v))
    assert np.array_equal(cube(blocks.to_voxels(third, {"z": 2, "y": 3, "x": 4}), v.shape), v)


@pytest.mark.parametrize("block", [{"z": 6, "y": 8, "x": 9}, {"z": 2, "y": 3, "x": 4}])
def test_map_blocks_has_no_seams(make, sizes_of, cube, block):
    v = volume((6, 8, 9), 2)

    def blur(c):
        import numpy as np
        out = np.zeros_like(c)
        out[1:-1, 1:-1, 1:-1] = sum(c[1 + a:c.shape[0] - 1 + a, 1 + b:c.shape[1] - 1 + b, 1 + d:c.shape[2] - 1 + d]
                                    for a in (-1, 0, 1) for b in (-1, 0, 1) for d in (-1, 0, 1))
        return out

    got = cube(blocks.map_blocks(make(v), blur, block, {"z": 1, "y": 1, "x": 1}, sizes_of(v)), v.shape)
    want = blur(np.pad(v.astype(float), 1, mode="reflect"))[1:-1, 1:-1, 1:-1]
    assert np.allclose(got, want)


@pytest.mark.parametrize("mode,name", [("border", "edge"), ("mirror_single", "reflect"), ("mirror_double", "symmetric"), ("zero", "constant")])
def test_pad_like_numpy(make, cube, mode, name):
    v = volume((3, 4, 5), 3)
    got = pixel.pad(make(v), {"z": 2, "y": 3, "x": 4}, mode)
    moved = pixel.translate(got, {"z": 2, "y": 3, "x": 4})
    assert np.array_equal(cube(moved, (7, 10, 13)), np.pad(v, ((2, 2), (3, 3), (4, 4)), mode=name))


def test_tubeness_like_numpy(make, cube):
    v = volume((6, 7, 8), 4).astype(float)
    sigmas = {"x": 1.5, "y": 1.0, "z": 2.0}

    def central(a, axis):
        p = np.pad(a, [(1, 1) if i == axis else (0, 0) for i in range(3)], mode="edge")
        n = a.shape[axis]
        return np.take(p, range(2, n + 2), axis) - np.take(p, range(n), axis)

    axis = {"x": 2, "y": 1, "z": 0}
    g = {a: central(v, axis[a]) * 2 / sigmas[a] for a in "xyz"}
    h = np.zeros(v.shape + (3, 3))
    for i, d in enumerate("xyz"):
        for j, e in enumerate("xyz"):
            if j >= i:
                h[..., i, j] = h[..., j, i] = central(g[e], axis[d]) * sigmas[e] / 2
    values = np.linalg.eigvalsh(h)
    values = np.take_along_axis(values, np.argsort(np.abs(values), axis=-1), axis=-1)
    s, m, b = values[..., 0], values[..., 1], values[..., 2]
    want = np.where(m * b > 0, np.sqrt(np.maximum(np.abs(b) * (np.abs(m) - np.abs(s)), 0)) / np.where(b == 0, 1, -b), 0)
    got = cube(stencils.tubeness(make(v), sigmas), v.shape)
    assert np.allclose(got, want, atol=1e-5)


def test_inpaint_rounds_like_numpy(make, cube):
    v = volume((2, 9, 10), 5).astype(float)
    v[0, 2:7, 3:8] = np.nan
    v[1, :, 0:3] = np.nan
    got = cube(stencils.inpaint(make(v, integer=False)), v.shape)
    want = v.copy()
    for z in range(2):
        plane = want[z]
        while np.isnan(plane).any():
            old, new = plane.copy(), plane.copy()
            for y, x in zip(*np.nonzero(np.isnan(old))):
                s = n = 0.0
                for dy, dx, w in stencils.RING:
                    if 0 <= y + dy < 9 and 0 <= x + dx < 10 and not np.isnan(old[y + dy, x + dx]):
                        s, n = s + w * old[y + dy, x + dx], n + w
                if n:
                    new[y, x] = s / n
            plane[:] = new
    assert np.allclose(got, want)


def test_inpaint_rays_like_numpy(make, sizes_of, cube):
    v = volume((5, 6, 7), 6).astype(float)
    v[1:4, 1:5, 1:6] = np.nan
    got = cube(stencils.inpaint_rays(make(v, integer=False), sizes_of(v), directions=24, stride=2), v.shape)
    want = v.copy()
    for z, y, x in zip(*np.nonzero(np.isnan(v))):
        top = bottom = 0.0
        for dx, dy, dz in stencils.ray_directions(24):
            for step in itertools.count(1):
                p = [int(np.floor(c + step * d + 0.5)) for c, d in zip((z, y, x), (dz, dy, dx))]
                if any(i < 0 or i >= n for i, n in zip(p, v.shape)):
                    break
                if not np.isnan(v[tuple(p)]):
                    top, bottom = top + v[tuple(p)] / step, bottom + 1 / step
                    break
        want[z, y, x] = top / bottom
    assert np.allclose(got, want)


@pytest.mark.parametrize("side, reach", [(48, 16), (4, 2)])
def test_inpaint_rays_end_inside_tasks_or_go_on(make, sizes_of, cube, monkeypatch, side, reach):
    """Blocks with borders, rays that leave them, and a hole that is filled without a row for any ray."""
    v = volume((6, 9, 11), 8).astype(float)
    v[1:6, 1:8, 1:10] = np.nan
    monkeypatch.setattr(stencils, "RAY_BLOCK", side)
    monkeypatch.setattr(stencils, "RAY_REACH", reach)
    beams = np.array(stencils.ray_directions(12))[:, ::-1]
    rows = stencils._first_rays(make(v, integer=False), sizes_of(v), beams, reach)
    assert (rows.where("ray IS NOT NULL").count() == 0) == (reach == 16) and rows.where("ray IS NULL").count() == np.isnan(v).sum()
    got = cube(stencils.inpaint_rays(make(v, integer=False), sizes_of(v), directions=12, stride=2), v.shape)
    want = v.copy()
    for p in np.argwhere(np.isnan(v)):
        top = bottom = 0.0
        for d in beams:
            for step in itertools.count(1):
                q = np.floor(p + step * d + 0.5).astype(int)
                if (q < 0).any() or (q >= v.shape).any():
                    break
                if not np.isnan(v[tuple(q)]):
                    top, bottom = top + v[tuple(q)] / step, bottom + 1 / step
                    break
        want[tuple(p)] = top / bottom if bottom else np.nan
    assert np.allclose(got, want, equal_nan=True)


def test_distance_to_boundary_brute_force(make, sizes_of, cube):
    v = volume((4, 6, 7), 7, 3)
    v = np.repeat(np.repeat(v[:2, :3, :4], 2, axis=0), 2, axis=1)[:4, :6, :4]
    res = {"x": 8.0, "y": 6.0, "z": 20.0}
    got = cube(labels.distance_to_boundary(make(v), res, sizes_of(v)), v.shape)
    faces = []
    for axis in range(3):
        for p in itertools.product(*[range(n + (i == axis)) for i, n in enumerate(v.shape)]):
            low = tuple(c - (i == axis) for i, c in enumerate(p))
            if p[axis] == 0 or p[axis] == v.shape[axis] or v[low] != v[p] or v[low] == 0:
                faces.append((axis, p))
    step = [res["z"], res["y"], res["x"]]
    for q in itertools.product(*[range(n) for n in v.shape]):
        best = np.inf
        for axis, p in faces:
            d = 0.0
            for i in range(3):
                gap = abs(q[i] + 0.5 - p[i]) if i == axis else max(0.0, abs(q[i] - p[i]) - 0.5)
                d += (gap * step[i]) ** 2
            best = min(best, d)
        assert got[q] == np.floor(np.sqrt(best) + 0.5)


def test_sparse_interpolation_like_numpy(make, sizes_of, spark):
    v = volume((4, 5, 6), 8)
    v[v < 128] = 0
    rng = np.random.default_rng(9)
    at = rng.uniform(-1.5, 7, size=(200, 3))
    rows = [("d", i, *[float(c) for c in p]) for i, p in enumerate(at)]
    targets = spark.createDataFrame(rows, "dataset string, id long, sz double, sy double, sx double")
    got = interpolate(targets, make(v).where("v <> 0"), {"z": "sz", "y": "sy", "x": "sx"}).toPandas().set_index("id").v
    wide = np.pad(v.astype(float), 3)
    for i, p in enumerate(at):
        base = np.floor(p).astype(int)
        f = p - base
        if (base < -3).any() or (base + 4 >= np.array(wide.shape)).any():
            continue
        want = sum(wide[tuple(base + 3 + np.array(c))] * np.prod([fi if ci else 1 - fi for fi, ci in zip(f, c)]) for c in itertools.product((0, 1), repeat=3))
        assert abs(got[i] - want) < 1e-9


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 1000))
def test_mean_pyramid_keeps_the_total(make, seed):
    v = volume((4, 4, 6), seed)
    level = transforms.pyramid_mean(make(v), [{"z": 2, "y": 2, "x": 2}], integer=False)[0]
    assert abs(level.agg(F.sum("v")).first()[0] * 8 - v.sum()) < 1e-6


# ---- surfaces ------------------------------------------------------------------------------

def best_path(costs, max_dz):
    n, depth = costs.shape
    best = None
    for path in itertools.product(range(depth), repeat=n):
        if all(abs(a - b) <= max_dz for a, b in zip(path, path[1:])):
            total = sum(costs[i, z] for i, z in enumerate(path))
            best = total if best is None else min(best, total)
    return best


@pytest.mark.parametrize("seed", range(3))
def test_surface_of_one_line_is_optimal(make, seed):
    costs = np.random.default_rng(seed).permutation(5 * 4).reshape(4, 1, 5)
    found = surface.min_surface(make(costs), 1).toPandas().sort_values("x")
    assert (np.abs(np.diff(found.h)) <= 1).all()
    assert found.cost.sum() == best_path(costs[:, 0, :].T, 1)


def test_surface_keeps_the_slope_limit(make):
    found = surface.min_surface(make(volume((9, 8, 7), 11)), 1).toPandas()
    h = found.pivot(index="y", columns="x", values="h").to_numpy()
    assert (np.abs(np.diff(h, axis=0)) <= 1).all() and (np.abs(np.diff(h, axis=1)) <= 1).all()


def resin_column(a, band=4, thresh=45.0, kernel=2, gradient=20.0):
    """One column of the resin cost, written straight from its definition."""
    def take(col, size, t):
        start = next((i for i, v in enumerate(col) if t < v < 254.5), 0)
        values, full, k = [], 0, start
        for k in range(start, len(col)):
            if 0.5 < col[k] < 254.5:
                values.append(col[k])
                if len(values) == size:
                    break
            elif col[k] >= 254.5:
                full += 1
        else:
            k = len(col)
        return sorted(values), start, full, k - start + 1

    out = np.full(len(a), 255.0)
    first, start, full, total = take(a, band, thresh)
    if first:
        first, start, full, total = take(a, band, min(first[3 * len(first) // 4], 253.5))
    else:
        return out
    last, end, _, _ = take(a[::-1], 2 * band, thresh)
    if last:
        last, end, _, _ = take(a[::-1], band, min(last[3 * len(last) // 4], 253.5))
    end = len(a) - end - 1 if last else 0
    n = len(first)
    if full > 0.2 * total:
        return out
    median, std = first[n // 2], 0.5 * (first[int(0.84 * n)] - first[int(0.16 * n)])
    level = first[int(0.3 * n)]
    below = min(level - 1, median - std)
    start = max(start, 1)
    if end - start <= kernel or level >= 255:
        return out
    most = max(1.0, level - below)
    part = np.array(a[start:end + 1], dtype=float)
    ok = (part >= 0.5) & (part <= 254.5)
    d = np.where(ok, np.clip(level - part, 0, most), 0)
    u = np.where(ok, np.clip(part - below, 0, most), 0)
    t = np.cumsum(d) + u.sum() - np.cumsum(u)
    best = int(np.argmin(t[:len(t) - 2]))
    low = t[best]
    t[:len(t) - 2] -= low
    t = np.minimum(t, 255)
    w = np.where(np.array(a) > 254.5, 0, a).astype(float)
    if not w[:start].any() or not w[end:].any():
        return out
    mean = np.full(len(t), np.nan)
    for p in range(start + 1, end - 1):
        five = w[p - 2:p + 3]
        if (five > 0).any():
            mean[p - start - 1] = five.sum() / (five > 0).sum()
    g = mean[kernel:] - mean[:len(t) - kernel]
    if np.isnan(g).all():
        return out
    filled, before = [], 0.0
    for x in g:
        before = before if np.isnan(x) else min(abs(x), gradient)
        filled.append(before)
    touched = np.zeros(len(t), dtype=bool)
    for i, x in enumerate(filled):
        if i + 4 < len(t):
            t[i + 4] -= x
            touched[i + 4] = True
    lo, hi = t[touched].min(), t[touched].max()
    t = (t - lo) / max(hi - lo, 1) * 255
    half = band // 2
    if start + half <= best + start <= end - half:
        stop = end - half + 1
        out[start:stop + 1] = np.clip(t[:stop + 1 - start], 0, 255)
    return out


def test_resin_cost_columns(make, cube):
    rng = np.random.default_rng(12)
    v = np.zeros((3, 30, 6), dtype=int)
    for z in range(3):
        for x in range(6):
            a, b = rng.integers(2, 6), rng.integers(22, 27)
            v[z, a:b, x] = rng.integers(60, 200, size=b - a)
            v[z, :a, x] = rng.integers(1, 40, size=a)
            v[z, b:, x] = rng.integers(1, 40, size=30 - b)
    v[0, :, 0] = 0
    v[1, 10:14, 1] = 255
    got = cube(cost.one_sided_cost(make(v), "y", "x", 4, 45.0, 20.0, 2, None), v.shape)
    for z in range(3):
        for x in range(6):
            assert np.allclose(got[z, :, x], resin_column(v[z, :, x].tolist())), (z, x)
    assert (got < 255).any()


# ---- flow ------------------------------------------------------------------------------------

def test_block_votes_have_no_seams(make, sizes_of):
    a = volume((1, 24, 26), 13)
    b = np.roll(a, (1, -1), axis=(1, 2))
    rows = [features.block_votes(make(a), make(b), 2, [1, 2, 3], sizes_of(a), block).toPandas().sort_values(["y", "x"]).reset_index(drop=True)
            for block in ({"y": 24, "x": 26}, {"y": 7, "x": 9})]
    assert rows[0].equals(rows[1])
    inner = rows[0].query("y >= 4 and y < 20 and x >= 5 and x < 20")
    assert (inner.sx == -1).all() and (inner.sy == 1).all()


def test_flow_moves_a_shifted_image_back(make, sizes_of):
    a = 1 + volume((1, 30, 32), 14, 250)
    b = np.roll(a, 2, axis=2)
    field = features.block_flow(make(a), make(b), 3, 1.5, sizes_of(a), 32, rounds=1, block={"y": 30, "x": 32}).toPandas()
    inner = field.query("y >= 8 and y < 22 and x >= 8 and x < 22")
    assert (np.abs(inner.px - inner.x - 2) < 0.2).all() and (np.abs(inner.py - inner.y) < 0.2).all()


def test_detection_finds_a_blob(make, sizes_of):
    z, y, x = np.indices((9, 15, 17))
    v = 200 * np.exp(-((z - 4) ** 2 + (y - 7) ** 2 + (x - 9.25) ** 2) / (2 * 1.5 ** 2))
    found = features.detect_dog(make(v, integer=False), 1.5, 5.0, sizes_of(v)).collect()
    assert len(found) == 1
    assert (found[0].z, found[0].y) == (4, 7) and abs(found[0].px - 9.25) < 0.1


def test_octree_blocks_show_the_finest_node(spark, cube):
    """Three levels with gaps at each, an empty fine node, a fine node without a parent and one too deep, against descent by hand."""
    rng = np.random.default_rng(41)
    side, levels = {"z": 2, "y": 4, "x": 2}, 3
    nodes = {"": rng.integers(0, 3, (2, 4, 2)) * 1000, "3": rng.integers(1, 9, (2, 4, 2)), "3/8": np.zeros((2, 4, 2)),
             "3/8/1": rng.integers(1, 9, (2, 4, 2)), "7/2/5": rng.integers(100, 200, (2, 4, 2)), "3/1/1/1": np.full((2, 4, 2), 77), "1": np.zeros((2, 4, 2))}
    rows = [("o", c, p, (v * (c + 1)).astype("<u2").tobytes()) for p, v in nodes.items() for c in (0, 1)]
    df = spark.createDataFrame(rows, "dataset string, channel long, path string, data binary")

    def shown(fill):
        want = np.zeros((16, 32, 16))
        for z, y, x in np.ndindex(want.shape):
            for depth in range(levels, -1 if fill else levels - 1, -1):
                gone = levels - depth
                at = [z >> gone, y >> gone, x >> gone]
                cell = [a // s for a, s in zip(at, (2, 4, 2))]
                path = "/".join(str(1 + (cell[2] >> b & 1) + 2 * (cell[1] >> b & 1) + 4 * (cell[0] >> b & 1)) for b in reversed(range(depth)))
                if path in nodes:
                    want[z, y, x] = nodes[path][tuple(a % s for a, s in zip(at, (2, 4, 2)))]
                    break
        return want

    from voxelframe.sources import volumes
    for fill in (True, False):
        packed = volumes.octree_blocks(df, levels, side, fill=fill)
        assert packed.where("dataset = 'o/c0'").count() == sum(b.any() for b in shown(fill).reshape(8, 2, 8, 4, 8, 2).transpose(0, 2, 4, 1, 3, 5).reshape(-1, 16))
        for c in (0, 1):
            got = cube(blocks.to_voxels(packed.where(f"dataset = 'o/c{c}'"), side, "u16"), (16, 32, 16), fill=0)
            assert (got == shown(fill) * (c + 1)).all()
    root = df.where("path = '' AND channel = 0")
    assert [(r.gz, r.gy, r.gx) for r in volumes.octree_blocks(root, 0, side).collect()] == [(0, 0, 0)]
    assert volumes.octree_blocks(df.limit(0), levels, side).count() == 0
