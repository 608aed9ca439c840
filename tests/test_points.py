"""Points, matches and graphs against plain Python."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voxelframe.operators import joins, labels, leaves, matching, points, solve, stats
from voxelframe.plans import registration


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(1)
    at = rng.uniform(0, 60, size=(400, 3))
    at[300:340] = at[0]  # copies of one point
    rows = pd.DataFrame(at, columns=["x", "y", "z"])
    rows["pid"], rows["g"] = range(400), 0
    return at, spark.createDataFrame(rows)


def test_nearest_k_is_exact(cloud):
    at, df = cloud
    got = points.nearest_k(df, ["g"], ["x", "y", "z"], 4, 3.0).toPandas().set_index("pid").near
    for i in range(0, 400, 7):
        d = ((at - at[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        assert np.allclose([n.d2 for n in got[i]], np.sort(d)[:4])


def test_nearest_k_lists_few_copies_and_writes_columns(spark, tmp_path, monkeypatch):
    """Copies beyond the listed ones, groups smaller than k and places without a value: exact, and what is kept
    between the steps stays a small multiple of the points (a checkpoint of their neighbours as plain rows did not)."""
    rng = np.random.default_rng(4)
    at = rng.integers(0, 40, size=(6000, 3)).astype(float)
    at[100:400] = at[0]  # a heap of copies
    rows = pd.DataFrame(at, columns=["x", "y", "z"]).assign(pid=rng.permutation(6000) + 10**15, g=0)
    rows.loc[5990:, "g"] = 1
    rows.loc[5998:, "g"] = 2
    lost = rows.iloc[:2].assign(pid=[1, 2], x=[np.nan, 3.0], y=[3.0, np.nan])
    df = spark.createDataFrame(pd.concat([rows, lost], ignore_index=True))
    folder = tmp_path / "kept"
    folder.mkdir()
    from voxelframe import session
    with monkeypatch.context() as m:
        m.setattr(session, "ensure_checkpoint_dir", lambda _: str(folder))
        got = points.nearest_k(df, ["g"], ["x", "y", "z"], 3, 2.0).select("pid", "near").toPandas().set_index("pid").near
    assert sorted(got.index) == sorted(rows.pid)
    pid, g = rows.pid.to_numpy(), rows.g.to_numpy()
    for i in [*range(0, 6000, 97), 0, 100, 250, 399, *range(5990, 6000)]:
        d = ((at - at[i]) ** 2).sum(axis=1)
        d[(g != g[i]) | (pid == pid[i])] = np.inf
        best = [j for j in np.lexsort((pid, d)) if np.isfinite(d[j])][:3]
        assert [n.pid for n in got[pid[i]]] == list(pid[best]) and [n.d2 for n in got[pid[i]]] == list(d[best])
    kept = sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    assert 0 < kept < 120 * 6000


def test_nn_join_is_exact(cloud):
    at, df = cloud
    moved = df.withColumn("x", F.col("x") + 0.7)
    got = joins.nn_join(moved, df, ["g"], ["x", "y", "z"], 5.0).toPandas().set_index("a")
    for i in range(0, 400, 7):
        d = ((at - (at[i] + [0.7, 0, 0])) ** 2).sum(axis=1)
        assert abs(got.d2[i] - d.min()) < 1e-9 and d[got.b[i]] == pytest.approx(d.min())


def test_match_features_brute_force(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(150, 8)), rng.normal(size=(120, 8))
    b[:40] = a[:40] + 0.05 * rng.normal(size=(40, 8))

    def rows(m):
        return spark.createDataFrame(pd.DataFrame({"g": 0, "fid": range(len(m)), "desc": [list(map(float, r)) for r in m]}))

    got = matching.match_features(rows(a), rows(b), ["g"], 0.8, chunk=17).collect()
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    order = np.argsort(d, axis=1)
    want = {(i, order[i, 0]) for i in range(150) if d[i, order[i, 0]] < 0.8 * d[i, order[i, 1]]}
    hits = pd.Series([j for _, j in want]).value_counts()
    assert {(r.a, r.b) for r in got} == {(i, j) for i, j in want if hits[j] == 1}


@pytest.mark.parametrize("whole", [False, True])
def test_short_descriptors_match_like_all_pairs(spark, monkeypatch, whole):
    """Several cells and lanes a group, copies, ties of a lattice, a group of one target and values that are no numbers."""
    monkeypatch.setattr(leaves, "CELL", 64)
    rng = np.random.default_rng(12)
    sides = [np.round(rng.normal(size=(n, 6)) * 2) if whole else rng.normal(size=(n, 6)) for n in (420, 500)]
    sides[1][:150] = sides[0][:150] + (0 if whole else 0.05 * rng.normal(size=(150, 6)))
    sides[1][480:] = sides[1][440:460]
    sides[0][400:] = sides[0][380:400]

    def rows(m, sign):
        out = pd.DataFrame({"g": 0, "fid": [sign * i for i in range(len(m))], "desc": [list(map(float, r)) for r in m]})
        more = pd.DataFrame({"g": [0, 1], "fid": [9000, 9001], "desc": [[float("nan")] + [0.0] * 5, [1.0] * 6]})
        return spark.createDataFrame(pd.concat([out, more]), "g long, fid long, desc array<double>")

    p, q = rows(sides[0], 1), rows(sides[1], -1)
    d = np.sqrt(((sides[0][:, None] - sides[1][None]) ** 2).sum(axis=2))
    ids = -np.arange(500)
    for unique, ratio in ((True, 0.8), (False, 1.0)):
        got = {r.a: (r.b, r.d, r.ratio) for r in leaves.match_short(p, q, ["g"], ratio, unique).collect()}
        want = {}
        for i in range(len(d)):
            order = np.lexsort((ids, d[i]))[:2]
            if d[i, order[0]] < ratio * d[i, order[1]]:
                want[i] = (int(ids[order[0]]), d[i, order[0]], d[i, order[0]] / d[i, order[1]])
        hits = pd.Series([b for b, _, _ in want.values()]).value_counts()
        want = {i: row for i, row in want.items() if not unique or hits[row[0]] == 1}
        assert got.keys() == want.keys() and len(want) > 50
        assert all(got[i][0] == want[i][0] and np.allclose(got[i], want[i]) for i in want)


def test_copies_of_short_descriptors_are_not_pairs(spark):
    """Two groups of 150,000 copies would make 2 x 10^10 pairs."""
    rows = spark.range(300000).select(F.lit(0).alias("g"), F.col("id").alias("fid"), F.array(*[(F.col("id") % 2).cast("double")] * 6).alias("desc"))
    one = spark.createDataFrame([(0, 500000, [5.0] * 6)], "g int, fid long, desc array<double>")
    got = leaves.match_short(rows.unionByName(one), rows.unionByName(one), ["g"], 0.5).collect()
    assert [(r.a, r.b, r.d) for r in got] == [(500000, 500000, 0.0)]


def test_merge_matches_like_a_sequence(spark):
    rng = np.random.default_rng(3)
    rows = [(int(p), int(a), int(b), int(k)) for p, a, b, k in zip(rng.integers(0, 2, 400), rng.integers(0, 60, 400), rng.integers(0, 60, 400), rng.integers(0, 9, 400))]
    rows += [(0, 100, 10, 0), (0, 100, 11, 0), (0, 101, 90, 0), (0, 101, 90, 1)]
    df = spark.createDataFrame(rows, "pair long, a long, b long, block long")
    merged = joins.merge_matches(df, ["pair"])
    got = {tuple(r) for r in merged.select("pair", "a", "b", "block").collect()}
    want, count = set(), {p: [0, 0, 0] for p in (0, 1)}
    for block in range(9):
        now = {r for r in rows if r[3] == block}
        ends_a, ends_b, pairs = {(p, a) for p, a, _, _ in want}, {(p, b) for p, _, b, _ in want}, {r[:3] for r in want}
        new = {r for r in now if (r[0], r[1]) not in ends_a and (r[0], r[2]) not in ends_b}
        for r in now:
            count[r[0]][0 if r in new else 1 if r[:3] in pairs else 2] += 1
        want |= new
    assert got == want
    counts = {r["pair"]: [r["added"], r["same"], r["different"]] for r in joins.merge_counts(df, merged, ["pair"]).collect()}
    assert counts == count


def test_seeds_come_from_all_matches(spark):
    """A model that few of very many matches follow, and more sets than a fixed number of rounds would find."""
    n = 6000
    rows = pd.DataFrame({"g": 0, "mid": range(n), "w": 1.0, "px": np.arange(n) * 7.0, "py": 0.0})
    rng = np.random.default_rng(8)
    rows["qx"], rows["qy"] = rows.px + rng.permutation(n) * 100.0, rng.permutation(n) * 100.0 + 50
    chosen = rng.choice(n, size=9, replace=False)
    rows.loc[chosen, "qx"] = rows.px[chosen] - 1e7
    rows.loc[chosen, "qy"] = rows.py[chosen] - 1e7
    got = matching.ransac(spark.createDataFrame(rows), ["g"], "translation", iterations=n, epsilon=1.0, min_inliers=7)
    assert {r["mid"] for r in got.collect()} == set(chosen.tolist())
    rows = pd.DataFrame([{"g": 0, "mid": 10 * s + i, "w": 1.0, "px": float(i), "py": 0.0, "qx": i + 1000.0 * s, "qy": 0.0} for s in range(18) for i in range(8)])
    sets = matching.multi_consensus(spark.createDataFrame(rows), ["g"], kind="translation", iterations=400, epsilon=1.0, min_inliers=7)
    assert sets.select("consensus").distinct().count() == 18 and sets.count() == len(rows)


def test_consensus_recovers_planted_models(spark):
    rng = np.random.default_rng(4)
    p = rng.uniform(0, 100, size=(600, 3))
    m = np.array([[1.1, 0.1, 0, 5], [-0.05, 0.9, 0.1, -3], [0, 0.02, 1.2, 7]])
    q = p @ m[:, :3].T + m[:, 3]
    q[400:] = rng.uniform(0, 100, size=(200, 3))
    rows = pd.DataFrame(np.hstack([p, q]), columns=["px", "py", "pz", "qx", "qy", "qz"])
    rows["mid"], rows["w"], rows["g"] = range(600), 1.0, 0
    df = spark.createDataFrame(rows)
    kept = matching.ransac(df, ["g"], "affine", iterations=300, epsilon=0.01, dim=3)
    assert {r.mid for r in kept.collect()} == set(range(400))
    fit = matching.fit_model(kept, ["g"], "affine", dim=3).first().m
    assert np.allclose(np.array(fit).reshape(3, 4), m, atol=1e-6)


def test_consensus_is_empty_without_a_model(spark):
    rng = np.random.default_rng(5)
    rows = pd.DataFrame(rng.uniform(0, 1000, size=(60, 4)), columns=["px", "py", "qx", "qy"])
    rows["mid"], rows["w"], rows["g"] = range(60), 1.0, 0
    assert matching.multi_consensus(spark.createDataFrame(rows), ["g"], kind="rigid", iterations=50, epsilon=1.0, min_inliers=7).count() == 0


def test_components_like_union_find(spark):
    rng = np.random.default_rng(6)
    edges = [(0, int(a), int(b)) for a, b in rng.integers(0, 300, size=(260, 2))] + [(0, 0, i) for i in range(250, 300)]
    parent = list(range(300))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for _, a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    nodes = spark.range(300).select(F.lit(0).cast("long").alias("g"), F.col("id").alias("node"))
    got = solve.components(spark.createDataFrame(edges, "g long, u long, v long"), nodes, ["g"]).collect()
    assert {r.node: r.component for r in got} == {i: root(i) for i in range(300)}


def test_label_volume_like_flood_fill(make, sizes_of, cube):
    v = np.random.default_rng(7).integers(0, 2, size=(4, 6, 8))
    got = cube(labels.label_volume(make(v), F.col("v") > 0, sizes_of(v)), v.shape)
    want, todo = np.zeros(v.shape), []
    for p in np.ndindex(v.shape):
        if v[p] and not want[p]:
            name = (p[0] * 6 + p[1]) * 8 + p[2] + 1
            todo = [p]
            while todo:
                q = todo.pop()
                if all(0 <= c < n for c, n in zip(q, v.shape)) and v[q] and not want[q]:
                    want[q] = name
                    todo += [tuple(c + s * (i == a) for i, c in enumerate(q)) for a in range(3) for s in (-1, 1)]
    assert np.array_equal(got, want)


def test_relaxation_finds_the_planted_layout(spark):
    rng = np.random.default_rng(8)
    shift = {t: rng.uniform(-20, 20, 2) for t in range(5)}
    rows = []
    for a, b in [(0, 1), (1, 2), (2, 3), (3, 4), (0, 3)]:
        for _ in range(12):
            world = rng.uniform(0, 100, 2)
            rows.append((0, a, b, *[float(c) for c in world - shift[a]], *[float(c) for c in world - shift[b]], 1.0))
    df = spark.createDataFrame(rows, "g long, a long, b long, px double, py double, qx double, qy double, w double")
    fixed = spark.createDataFrame([(0, 0)], "g long, tile long")
    got = solve.relax(df, ["g"], "translation", fixed=fixed, rounds=60, damp=1.0, patience=15, plateau=1e-9)
    for r in got.collect():
        assert np.allclose([r.m[2], r.m[5]], shift[r.tile] - shift[0], atol=0.05)


def test_top_per_group_with_a_hot_group(spark):
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("g"), "id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("v"))
    got = stats.top_per_group(df, ["g"], [F.desc("v"), F.col("id")], 10, ["id"]).toPandas()
    want = df.toPandas().sort_values(["v", "id"], ascending=[False, True]).groupby("g").head(10)
    assert set(got.id) == set(want.id)


def test_block_matching_recovers_a_shift(spark):
    rng = np.random.default_rng(9)
    at = rng.uniform(0, 80, size=(200, 3))
    a = pd.DataFrame(at, columns=["x", "y", "z"])
    a["pid"], a["stack"] = range(200), 1
    b = a.copy()
    b[["x", "y", "z"]] += [4.0, -3.0, 2.0]
    found = registration.match_blocks(spark.createDataFrame(a), spark.createDataFrame(b), ["stack"], 10.0, epsilon=0.5,
                                      icp_distance=2.0, icp_epsilon=0.5, iterations=30, rounds=3).toPandas()
    assert len(found) >= 190 and (found.a == found.b).all()
    assert np.allclose((found.qx - found.px).mean(), 4.0)


def test_volume_solve_finds_planted_models(spark):
    """Tiles in a row and one across, with affine truth near a translation; from pre-alignment to the softest stage."""
    rng = np.random.default_rng(31)
    truth = {t: np.hstack([np.eye(3) + (t > 0) * rng.normal(0, 0.004, (3, 3)), rng.uniform(-40, 40, (3, 1)) * (t > 0)]) for t in range(5)}
    rows = []
    for a, b in ((0, 1), (1, 2), (2, 3), (1, 4), (0, 4)):
        for i in range(60):
            world = rng.uniform(0, 100, 3)
            p, q = (np.linalg.solve(truth[t][:, :3], world - truth[t][:, 3]) for t in (a, b))
            rows.append((0, a, b, i, 1.0, *map(float, p), *map(float, q)))
    df = spark.createDataFrame(rows, "g long, a long, b long, mid long, w double, px double, py double, pz double, qx double, qy double, qz double")
    fixed = spark.createDataFrame([(0, 0)], "g long, tile long")
    start = {r.tile: np.array(r.m).reshape(3, 4) for r in solve.pre_align(df, ["g"], fixed, dim=3).collect()}
    assert set(start) == set(truth) and all(np.abs(start[t][:, 3] - truth[t][:, 3]).max() < 3 for t in truth)
    models = solve.solve_volume(df, ["g"], fixed, stages=[(1.0, 2, 2), (0.0, 10, 5)], damp=1.0)
    got = {r.tile: np.array(r.m).reshape(3, 4) for r in models.collect()}
    points = rng.uniform(0, 100, (50, 3))
    for t in truth:
        assert np.abs(points @ got[t][:, :3].T + got[t][:, 3] - points @ truth[t][:, :3].T - truth[t][:, 3]).max() < 1.0


def test_worst_matches_go_one_by_one(spark):
    rng = np.random.default_rng(32)
    p = rng.uniform(0, 50, (40, 3))
    q = p + [5, -2, 1]
    q[:4] += rng.uniform(20, 60, (4, 3))
    rows = [(0, 0, 1, i, 1.0, *map(float, p[i]), *map(float, q[i])) for i in range(40)]
    df = spark.createDataFrame(rows, "g long, a long, b long, mid long, w double, px double, py double, pz double, qx double, qy double, qz double")
    assert {r.mid for r in solve.drop_worst(df, ["g"], 0.5).collect()} == set(range(4, 40))


def test_consensus_lanes_agree_with_one_task(spark):
    """Groups above and below a lane, and a group of many matches, find the same model; hypotheses stay in their tasks."""
    rng = np.random.default_rng(4)
    rows = pd.DataFrame({"g": np.repeat([0, 1, 2], [3000, 700, 30]), "px": rng.uniform(0, 900, 3730), "py": rng.uniform(0, 900, 3730), "w": 1.0})
    rows["mid"] = range(len(rows))
    rows["qx"], rows["qy"] = 1.1 * rows.px - 0.1 * rows.py + 5, 0.2 * rows.px + 0.9 * rows.py - 3
    rows.loc[rows.mid % 3 == 0, "qx"] += rng.uniform(50, 90, (rows.mid % 3 == 0).sum())
    df = spark.createDataFrame(rows)
    want = set(rows.mid[rows.mid % 3 != 0])
    for lane in (500, 32768):
        got = matching.ransac(df, ["g"], "affine", iterations=400, epsilon=0.5, lane=lane)
        assert {r.mid for r in got.collect()} == want
        assert "models" not in got._jdf.queryExecution().toString()


@pytest.mark.parametrize("piece", [1 << 22, 2000])
def test_descriptors_move_once_a_piece(spark, monkeypatch, piece):
    """Pieces are cut by bytes, not by the rows compared at a time; equal distances take the smaller id."""
    monkeypatch.setattr(matching, "PIECE_BYTES", piece)
    rng = np.random.default_rng(6)
    b = rng.integers(0, 3, size=(90, 6)).astype(float)
    a = rng.integers(0, 3, size=(70, 6)) + 0.25

    def rows(m):
        return spark.createDataFrame(pd.DataFrame({"g": 0, "fid": range(len(m)), "desc": [list(map(float, r)) for r in m]}))

    got = {r.a: (r.b, r.d, r.ratio) for r in matching.match_features(rows(a), rows(b), ["g"], 1.01, unique=False, chunk=7).collect()}
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    for i, line in enumerate(d):
        first, second = np.sort(line)[:2]
        assert got[i] == (int(line.argmin()), pytest.approx(first), pytest.approx(first / second))


def test_staged_relaxation_settles_a_long_chain(spark, monkeypatch):
    """Rounds end when the error does; one task gives the models of rounds as joins."""
    rng = np.random.default_rng(2)
    p = rng.uniform(0, 20, size=(30, 12, 2))
    rows = [(0, t, t + 1, float(x), float(y), float(x) + 3.0, float(y) - 1.0, 1.0) for t in range(30) for x, y in p[t]]
    df = spark.createDataFrame(rows, "g int, a int, b int, px double, py double, qx double, qy double, w double")
    fixed = spark.createDataFrame([(0, 0)], "g int, tile int")
    want = np.array([[1, 0, -3.0 * t, 0, 1, 1.0 * t] for t in range(31)])
    start = solve.pre_align(df, ["g"], fixed, "rigid")
    for lambdas in ([1.0], [1.0, 0.1]):
        got = {r.tile: r.m for r in solve.relax_staged(df, ["g"], "affine", "rigid", lambdas, fixed=fixed, start=start).collect()}
        assert np.abs(np.array([got[t] for t in range(31)]) - want).max() < 1e-6
    prior = spark.createDataFrame([(0, t, [1.0, 0.0, -2.0 * t, 0.0, 1.0, 0.0]) for t in range(0, 31, 2)], "g int, tile int, m array<double>")
    tilted = df.withColumns({"qx": F.col("qx") * 1.02 + F.col("qy") * 0.1, "w": F.col("w") + F.col("a") % 3})
    for kind, stiff, given in (("affine", "rigid", None), ("rigid", None, prior), ("similarity", "identity", None), ("translation", None, prior)):
        both = []
        for limit in (1 << 18, 0):
            monkeypatch.setattr(solve, "TOGETHER", limit)
            out = solve.relax(tilted, ["g"], kind, stiff, 0.3, fixed, rounds=3, patience=2, prior=given, prior_weight=0.2)
            both.append(np.array([r.m for r in out.orderBy("tile").collect()]))
        assert np.allclose(*both, atol=1e-9)


def test_slab_graph_is_solved_to_its_end(spark):
    """Another solve from the models of the query moves no tile: nothing is left over."""
    import __spark_entry__ as entry
    from catalog import registry
    f = registry.Fixtures(spark, "/root/testdata/sf0.01")
    first = spark.createDataFrame([(0, 0)], "graph long, tile long")
    kept = f.matches.where("planted = 1").withColumn("graph", F.lit(0).cast("long"))
    start = solve.pre_align(kept, ["graph"], first, "rigid")
    longer = solve.relax_staged(kept, ["graph"], "affine", "rigid", [1.0, 0.1], [20000, 20000], fixed=first, start=start, patience=200)
    want = {r.tile: (r.m[2], r.m[5]) for r in longer.collect()}
    got = {r.tile: (r.x, r.y) for r in entry.queries()["aligned_slab_graph"](spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == set(want) and max(np.abs(np.subtract(got[t], want[t])).max() for t in got) < 0.01


def test_pre_alignment_in_one_task_walks_as_its_rounds(spark, monkeypatch):
    """Rings and a branch that no fixed tile reaches."""
    rng = np.random.default_rng(8)
    links = [(0, 1), (1, 2), (2, 3), (3, 0), (2, 4), (4, 5), (7, 8)]
    rows = [(0, a, b, *[float(v) for v in rng.uniform(0, 9, 4)], 1.0 + i) for a, b in links for i in range(5)]
    df = spark.createDataFrame(rows, "g int, a int, b int, px double, py double, qx double, qy double, w double")
    fixed = spark.createDataFrame([(0, 0)], "g int, tile int")
    both = []
    for limit in (1 << 18, 0):
        monkeypatch.setattr(solve, "TOGETHER", limit)
        both.append({r.tile: r.m for r in solve.pre_align(df, ["g"], fixed, "rigid").collect()})
    assert set(both[0]) == set(both[1]) == set(range(6)) and all(np.allclose(both[0][t], both[1][t]) for t in both[0])


def test_two_closest_descriptors_as_all_pairs_give_them(spark):
    """Ties, copies, values far from zero; a target that is not a number hides no other."""
    rng = np.random.default_rng(11)
    for p, q in [(rng.normal(size=(70, 9)), rng.normal(size=(90, 9))), (rng.integers(0, 3, (70, 4)) * 1.0, rng.integers(0, 3, (90, 4)) * 1.0),
                 (rng.normal(size=(70, 9)) * 1e-3 + 1e5, rng.normal(size=(90, 9)) * 1e-3 + 1e5), (rng.normal(size=(5, 9)), rng.normal(size=(1, 9)))]:
        d2 = sum((p[:, None, c] - q[None, :, c]) ** 2 for c in range(p.shape[1]))
        want = np.argsort(d2, axis=1, kind="stable")[:, :2]
        for chunk in (1, 20, 1024):
            who, least = matching.two_closest(p, q, chunk)
            assert (who[:, :want.shape[1]] == want).all() and (least[:, :want.shape[1]] == np.take_along_axis(d2, want, axis=1)).all()
    rows = [(0, i, [float(i), float(i % 3)]) for i in range(20)]
    a = spark.createDataFrame(rows, "g int, fid long, desc array<double>")
    b = a.unionByName(spark.createDataFrame([(0, 99, [float("nan"), 0.0])], a.schema))
    assert {(r.a, r.b) for r in matching.match_features(a, b, ["g"], 0.92).collect()} == {(i, i) for i in range(20)}
