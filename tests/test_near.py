"""Neighbourhoods on blocks against all pairs."""

import numpy as np
import pandas as pd
import pytest

from voxelframe.operators import near, points


@pytest.mark.parametrize("whole", [True, False])
def test_filters_and_neighbours_by_all_pairs(spark, whole):
    """On a lattice (sums along lines) and on free positions (pairs); no pair becomes a row."""
    rng = np.random.default_rng(5)
    at = rng.integers(0, 14, size=(500, 3)).astype(float) if whole else rng.uniform(0, 14, size=(500, 3))
    rows = pd.DataFrame(at, columns=["x", "y", "z"]).assign(g=0, pid=range(500), v=rng.integers(1, 9, 500).astype(float))
    df = spark.createDataFrame(rows)
    d2 = ((at[:, None] - at[None]) ** 2).sum(axis=2)
    inside, w = d2 <= 9.0, np.exp(-d2 / 8.0)
    v = rows.v.to_numpy()
    want = {("density", "weights"): inside.sum(1), ("mean", "weights"): inside @ v / inside.sum(1), ("gauss", "weights"): (inside * w) @ v / (inside * w).sum(1),
            ("gauss", "samples"): (inside * w) @ v / inside.sum(1), ("gauss", None): (inside * w) @ v}
    for (kind, normalize), values in want.items():
        out = points.radius_filter(df, df.drop("v"), ["g"], ["x", "y", "z"], 3.0, kind, sigma=2.0, normalize=normalize)
        assert np.allclose(out.toPandas().set_index("pid").v.sort_index(), values)
        assert "NestedLoop" not in out._jdf.queryExecution().toString() and "d2#" not in out._jdf.queryExecution().toString()
    got = near.nearest(df, df, ["g"], ["x", "y", "z"], 3.0, 3, "pid").toPandas()
    for r in got.itertuples():
        i = np.flatnonzero((at == [r.x, r.y, r.z]).all(axis=1))[0]
        best = [j for j in np.lexsort((np.arange(500), d2[i])) if inside[i, j]][:3]
        assert [n.pid for n in r.near] == best and np.allclose([n.d2 for n in r.near], d2[i, best])


def test_sparse_points_get_few_blocks(spark):
    """A small radius over a wide space is no block for every few points."""
    rng = np.random.default_rng(9)
    rows = pd.DataFrame(rng.uniform(0, 400, size=(600, 3)), columns=["x", "y", "z"]).assign(g=0, pid=range(600))
    df = spark.createDataFrame(rows)
    seen = near.on_blocks(df, df, ["g"], ["x", "y", "z"], 1.0, lambda a, b: pd.DataFrame({"n": [len(a)]}), "n long").toPandas()
    assert seen.n.sum() == 600 and len(seen) <= 8 ** 3


@pytest.mark.parametrize("whole", [True, False])
def test_median_and_weighted_sum_by_all_pairs(spark, whole):
    """Copies at one place, values that repeat and values that do not; no pair becomes a row."""
    rng = np.random.default_rng(6)
    at = rng.integers(0, 12, size=(400, 3)).astype(float) if whole else rng.uniform(0, 12, size=(400, 3))
    at[300:330] = at[0]
    spots = np.vstack([at + [1.0, 0.0, 0.0], [[99.0, 99.0, 99.0]]])
    d2 = ((spots[:, None] - at[None]) ** 2).sum(axis=2)
    targets = spark.createDataFrame(pd.DataFrame(spots, columns=["x", "y", "z"]).assign(g=0, pid=range(401)))
    for v in (rng.integers(1, 9, 400).astype(float), rng.normal(size=400)):
        df = spark.createDataFrame(pd.DataFrame(at, columns=["x", "y", "z"]).assign(g=0, pid=range(400), v=v))
        inside = d2 <= 9.0
        medians = [np.median(v[row]) if row.any() else -1.0 for row in inside]
        sums = np.where(inside.any(1), (inside / (1.0 + d2)) @ v, -1.0)
        for kind, want in (("median", medians), (points.WeightedSum(lambda d: 1.0 / (1.0 + d)), sums)):
            out = points.radius_filter(df, targets, ["g"], ["x", "y", "z"], 3.0, kind, fill=-1.0)
            assert np.allclose(out.toPandas().set_index("pid").v.sort_index(), want)
            assert "d2#" not in out._jdf.queryExecution().toString()


def test_medians_of_many_values_on_a_lattice():
    """More values in a block than near one line."""
    rng = np.random.default_rng(8)
    p, q = rng.integers(0, 30, (300, 3)).astype(float), rng.integers(0, 30, (4000, 3)).astype(float)
    v, n = rng.normal(size=4000), rng.integers(1, 4, 4000)
    got = near.ball_medians(p, q, v, n, 2.0)
    for i in range(300):
        inside = ((q - p[i]) ** 2).sum(axis=1) <= 4.0
        assert np.isclose(got[i], np.median(np.repeat(v[inside], n[inside])), equal_nan=True) if inside.any() else np.isnan(got[i])


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("kind", ["translation", "affine"])
def test_warp_by_all_pairs(spark, whole, kind):
    """Every point's own model far from the origin, exact hits and points without controls; no pair becomes a row."""
    rng = np.random.default_rng(7)
    p = rng.integers(0, 12, size=(300, 3)).astype(float) if whole else rng.uniform(0, 12, size=(300, 3))
    p = np.unique(p, axis=0) + [5000.0, 200.0, 0.0]
    q = p * [1.1, 0.9, 1.0] + rng.normal(0, 0.2, p.shape)
    at = np.vstack([rng.integers(0, 12, size=(60, 3)).astype(float) + [5000.5, 200.0, 0.0], p[:1], [[0.0, 0.0, 0.0]]])
    controls = spark.createDataFrame(pd.DataFrame(np.hstack([p, q]), columns=["px", "py", "pz", "qx", "qy", "qz"]).assign(g=0, mid=range(len(p))))
    df = spark.createDataFrame(pd.DataFrame(at, columns=["x", "y", "z"]).assign(g=0, pid=range(len(at))))
    out = points.mls_warp(df, controls, ["g"], 4.0, kind)
    assert "NestedLoop" not in out._jdf.queryExecution().toString() and "d2#" not in out._jdf.queryExecution().toString()
    got = out.toPandas().set_index("pid").sort_index()[["x", "y", "z"]].to_numpy()
    assert np.allclose(got[60], q[0])
    for i in range(60):
        d2 = ((p - at[i]) ** 2).sum(axis=1)
        near_by = (d2 <= 16.0) & (d2 > 0)
        w, a, b = 1 / d2[near_by], p[near_by] - at[i], q[near_by] - at[i]
        mean = [(w[:, None] * m).sum(0) / w.sum() for m in (a, b)]
        want = at[i] + mean[1] - mean[0]
        if kind == "affine" and near_by.sum() > 6:
            root = np.sqrt(w)[:, None]
            linear = np.linalg.lstsq(root * (a - mean[0]), root * (b - mean[1]), rcond=None)[0]
            want = at[i] + mean[1] - mean[0] @ linear
        assert np.allclose(got[i], want, atol=1e-6)


def test_sums_by_lines_and_by_pairs_agree(monkeypatch):
    """Where coordinates repeat both ways are open, and the cheaper one is taken."""
    rng = np.random.default_rng(12)
    p, q = rng.integers(0, 20, (500, 3)).astype(float), rng.integers(0, 20, (3000, 3)).astype(float)
    values, weights = [rng.normal(size=3000) for _ in range(3)], [None, near.inverse_square, near.inverse_square]
    found = []
    for step in (0.0, 1e9):
        monkeypatch.setattr(near, "STEP", step)
        found.append(near.ball_sums(p, q, values, weights, 4.0))
    assert np.allclose(*found)


def test_nearest_in_a_block_without_any_pair_in_reach(spark):
    """Both sides are there, but too far from each other."""
    a, b = [spark.createDataFrame([(0, i, 9.0 * i, 0.0, z) for i in range(4)], "g int, pid long, x double, y double, z double") for z in (0.0, 5.0)]
    assert near.nearest(a, b, ["g"], ["x", "y", "z"], 3.0, 1, "pid").count() == 0


def test_a_round_of_closest_points_makes_its_pairs_once(spark, monkeypatch):
    """Sums and error come from one pass; no id is looked up."""
    plans, real = [], points.checkpoint
    monkeypatch.setattr(points, "checkpoint", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    rng = np.random.default_rng(3)
    rows = pd.DataFrame(rng.uniform(0, 30, size=(200, 3)), columns=["x", "y", "z"]).assign(g=0, pid=range(200))
    a, b = spark.createDataFrame(rows), spark.createDataFrame(rows.assign(x=rows.x + 0.25, z=rows.z - 0.125))
    found = points.icp(a, b, ["g"], "translation", 1.0, rounds=3).first()
    assert found.n == 200 and np.allclose(np.array(found.m)[[3, 7, 11]], [0.25, 0.0, -0.125]) and np.isclose(found.error, np.hypot(0.25, 0.125), atol=0.3)
    assert plans and all(plan.count("FlatMapCoGroupsInPandas") == 1 for plan in plans)


def test_closest_by_all_pairs_in_any_dimension():
    """Ties, copies, one line only, places far from the origin."""
    rng = np.random.default_rng(4)
    for turn in range(60):
        dim, n, radius = 1 + turn % 3, 1 + turn % 5, [0.5, 2.0, 20.0][turn % 3 - turn % 2]
        size, far = [0.0, 3.0, 40.0, 9000.0][turn % 4], [0.0, 1e6][turn % 2]
        p, q = [rng.uniform(0, size + 1e-3, size=(k, dim)) + far for k in (70, 90)]
        if turn % 3:
            p, q = np.floor(p), np.floor(q)
        d2 = sum((p[:, None, c] - q[None, :, c]) ** 2 for c in range(dim))
        d2[d2 > radius * radius] = np.inf
        want = np.argsort(d2, axis=1, kind="stable")[:, :n]
        least = np.take_along_axis(d2, want, axis=1)
        who, got = near._closest(p, q, n, radius)
        assert (got == least).all() and (who == np.where(np.isinf(least), -1, want)).all()
