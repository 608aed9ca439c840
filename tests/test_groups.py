"""Small blocks are handled many at a time, with the results of one at a time."""

import numpy as np
import pandas as pd
import pytest

from voxelframe.operators import blocks, features
from voxelframe.sources import volumes


def test_groups_stay_whole_across_batches(spark):
    """Groups shorter and longer than an Arrow batch each come once, whole and with their starts."""
    rng = np.random.default_rng(1)
    group = np.repeat(np.arange(40), np.where(np.arange(40) % 13 == 0, 900, 7))
    rows = pd.DataFrame({"a": [f"g{i % 3}" for i in group], "b": group, "v": rng.integers(0, 100, len(group))}).sample(frac=1, random_state=2)

    def total(frame, starts):
        yield pd.DataFrame({"a": frame.a.iloc[starts], "b": frame.b.iloc[starts], "n": np.diff(np.append(starts, len(frame))),
                            "s": np.add.reduceat(frame.v.to_numpy(), starts)})

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = blocks.whole_groups(spark.createDataFrame(rows), ["a", "b"], total, "a string, b long, n long, s long").toPandas().sort_values("b")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = rows.groupby("b").v.agg(["count", "sum"])
    assert list(got.b) == list(want.index) and list(got.n) == list(want["count"]) and list(got.s) == list(want["sum"])


def test_small_blocks_do_not_call_python_one_by_one(spark, make, sizes_of, cube, monkeypatch):
    """Packing, cutting, votes and phase correlation of tiny blocks; pieces of any size give the same rows."""
    rng = np.random.default_rng(3)
    v = rng.integers(1, 200, size=(6, 13, 17))
    vox, sizes, block = make(v), sizes_of(v), {"z": 2, "y": 4, "x": 5}
    packed = blocks.to_blocks(vox, block, sizes)
    again = blocks.reblock(packed, block, {"z": 4, "y": 3, "x": 7}, sizes)
    found = features.phase_shift(vox, vox, {"y": 12, "x": 16})
    votes = features.block_votes(vox, vox, 2, [1, 2], sizes, {"y": 6, "x": 8})
    for df in (packed, again, found, votes):
        assert "FlatMapGroupsInPandas" not in df._jdf.queryExecution().toString()
    assert (cube(blocks.to_voxels(again, {"z": 4, "y": 3, "x": 7}), v.shape) == v).all()
    assert found.where("abs(qx - px) + abs(qy - py) > 0").count() == 0 and found.count() > 0
    assert votes.count() == v.size and votes.where("sx <> 0 or sy <> 0").count() == 0
    monkeypatch.setattr(blocks, "PIECE_ROWS", 30)
    monkeypatch.setattr(features, "STACKED", 100)
    assert (cube(blocks.to_voxels(blocks.to_blocks(vox, block, sizes), block), v.shape) == v).all()
    few = features.block_votes(vox, vox, 2, [1, 2], sizes, {"y": 6, "x": 8})
    assert few.exceptAll(votes).isEmpty() and votes.exceptAll(few).isEmpty()


def test_pre_alignment_passes_pieces_and_not_single_tiles(spark, monkeypatch):
    """Chains, rings and an unreached part: shifts as tile by tile, whole graphs at once and in many small pieces."""
    from voxelframe.operators import solve

    rng = np.random.default_rng(4)
    pairs = [(i, i + 1) for i in range(40)] + [(41, 3), (41, 5), (42, 41), (20, 42), (60, 61), (30, 10)] + [(i, i + 7) for i in range(22, 30)]
    rows = [(0, int(a), int(b), k, *map(float, rng.normal(size=4)), float(rng.uniform(0.5, 2))) for a, b in pairs for k in range(3)]
    matches = spark.createDataFrame(rows, "g long, a long, b long, mid long, px double, py double, qx double, qy double, w double")
    placed = {0: np.zeros(2)}
    while True:
        new = {}
        for tile in {t for pair in pairs for t in pair} - set(placed):
            parts = [(r[8], np.array(s * (np.array(r[6:8]) - np.array(r[4:6]))) + placed[o]) for r in rows
                     for m, o, s in ((r[1], r[2], 1), (r[2], r[1], -1)) if m == tile and o in placed]
            if parts:
                new[tile] = sum(w * t for w, t in parts) / sum(w for w, _ in parts)
        if not new:
            break
        placed.update(new)
    fixed = spark.createDataFrame([(0, 0)], "g long, tile long")
    jobs = []
    kept = solve.checkpoint
    monkeypatch.setattr(solve, "checkpoint", lambda df: jobs.append(1) or kept(df))
    for piece in (1 << 16, 14):
        monkeypatch.setattr(solve, "PIECE", piece)
        got = {r.tile: (r.m[2], r.m[5]) for r in solve.pre_align(matches, ["g"], fixed).collect()}
        assert set(got) == set(placed) and all(np.allclose(got[t], placed[t]) for t in placed)
        if piece > 100:
            assert len(jobs) < 12
    sizes = solve.tile_pieces(solve.edge_moments(matches, ["g"]), ["g"]).groupBy("piece").count().toPandas()["count"]
    assert 4 < len(sizes) < 30


def test_overlaps_of_all_shifts_at_once_are_those_of_single_shifts(spark, make):
    """Every shift of a stack in one pass, flat parts marked as unsure; block by block the shifts of a plain search."""
    rng = np.random.default_rng(7)
    u, v = rng.integers(0, 200, size=(2, 3, 6, 9)).astype(float)
    u[1, :, 3:], u[2] = 7.0, 0.0
    rough, sound = features._overlap_correlation(u, v)
    assert not sound[2].any() and sound[0, 0, 0]

    def plain(a, b, dy, dx):
        h, w = a.shape
        p = a[max(0, -dy):h - max(0, dy), max(0, -dx):w - max(0, dx)]
        q = b[max(0, dy):h - max(0, -dy), max(0, dx):w - max(0, -dx)]
        p, q = p - p.mean(), q - q.mean()
        norm = np.sqrt((p * p).sum() * (q * q).sum())
        return (p * q).sum() / norm if norm > 0 else -1.0

    for k in range(2):
        for dy in range(-4, 5):
            for dx in range(-7, 8):
                if sound[k, dy, dx]:
                    assert abs(rough[k, dy, dx] - plain(u[k], v[k], dy, dx)) < 1e-6
    image = rng.integers(0, 200, size=(2, 25, 33)).astype(float)
    other = np.roll(image, (1, -2), axis=(1, 2)) + rng.normal(size=image.shape)
    image[0, :12, :16] = other[1, :12, 16:] = 5.0
    found = {(r.z, r.by, r.bx): ((r.qy - r.py, r.qx - r.px), r.w) for r in features.phase_shift(make(image, integer=False), make(other, integer=False), {"y": 12, "x": 16}).collect()}
    want = {}
    for z in range(2):
        for by in range(5):
            for bx in range(5):
                a, b = [i[z, by * 6:by * 6 + 12, bx * 8:bx * 8 + 16] for i in (image, other)]
                h, w = a.shape
                cross = np.conj(np.fft.fft2(a - a.mean())) * np.fft.fft2(b - b.mean())
                size = np.abs(cross)
                phase = np.fft.ifft2(np.divide(cross, size, out=np.zeros_like(cross), where=size > 1e-9)).real
                ways = [(plain(a, b, dy, dx), dy, dx) for i in np.argsort(-phase.ravel(), kind="stable")[:15]
                        for dy in {i // w, i // w - h} for dx in {i % w, i % w - w} if min(h - abs(dy), w - abs(dx)) >= 4]
                if ways and max(ways)[0] > 0.3:
                    want[z, by, bx] = max(ways)
    assert found.keys() == want.keys() and len(want) > 20
    assert all(found[k][0] == want[k][1:] and abs(found[k][1] - want[k][0]) < 1e-9 for k in want)


def test_flow_joins_its_images_once(spark, make, sizes_of):
    """Boxes by slices are cut at the border; background has no weight; one join of the images for all rounds."""
    rng = np.random.default_rng(9)
    image = rng.integers(0, 9, size=(3, 7, 5)).astype(float)
    tables = features._edged(features._summed(image), 6)
    for r in (1, 3, 6):
        box = features._box(tables, r, 6)
        for y in range(7):
            for x in range(5):
                assert (box[:, y, x] == image[:, max(0, y - r):y + r + 1, max(0, x - r):x + r + 1].sum(axis=(1, 2))).all()
    a, b = rng.integers(1, 200, size=(2, 2, 12, 14))
    a[0, 4:8] = b[1, :, 3:6] = 0
    block = {"y": 6, "x": 7}
    both = make(a).join(make(b).withColumnRenamed("v", "w"), ["dataset", "z", "y", "x"]).selectExpr("*", "v = 0 OR w = 0 AS empty")
    got = features._joined_votes(both, 2, [1, 2], sizes_of(a), block).toPandas()
    plain = features.block_votes(make(a), make(b), 2, [1, 2], sizes_of(a), block).toPandas()
    rows = got.merge(plain, on=["dataset", "z", "y", "x"], suffixes=("", "_plain"))
    none = (a[rows.z, rows.y, rows.x] == 0) | (b[rows.z, rows.y, rows.x] == 0)
    assert len(rows) == a.size and (rows.sx == rows.sx_plain).all() and (rows.w == np.where(none, 0.0, rows.w_plain)).all() and none.any()
    flow = features.block_flow(make(a), make(b), 2, 1.0, sizes_of(a), 12, rounds=1, block=block)
    assert flow.count() == a.size


def test_voxels_are_packed_and_cut_without_python_objects(spark):
    """Ragged volumes, crops, one block and many, pieces of many forms: blocks are packed, cut and joined as Arrow columns."""
    rng = np.random.default_rng(8)
    shapes = {"a": (5, 9, 13), "b": (1, 4, 30), "c": (7, 7, 7)}
    cubes = {k: rng.integers(1, 200, size=s) for k, s in shapes.items()}
    rows = [pd.DataFrame({"dataset": k, **dict(zip("zyx", (i.ravel() for i in np.indices(c.shape)))), "v": c.ravel()}) for k, c in cubes.items()]
    vox = spark.createDataFrame(pd.concat(rows, ignore_index=True)).where("(z + y + x) % 5 <> 0")
    sizes = spark.createDataFrame([(k, *s) for k, s in shapes.items()], "dataset string, nz long, ny long, nx long")
    part = spark.createDataFrame([(k, s[0], s[1] - 2, s[2] - 3) for k, s in shapes.items()], "dataset string, nz long, ny long, nx long")
    for block in ({"z": 2, "y": 4, "x": 5}, {"z": 8, "y": 16, "x": 32}):
        packed = blocks.to_blocks(vox, block, sizes, background=7)
        for target in ({"z": 3, "y": 3, "x": 4}, {"z": 1, "y": 20, "x": 20}):
            got = blocks.to_voxels(blocks.reblock(packed, block, target, part, low={"y": 2, "x": 3}), target)
            plan = got._jdf.queryExecution().toString()
            assert "MapInArrow" in plan and "MapInPandas" not in plan
            out = {k: np.zeros((s[0], s[1] - 2, s[2] - 3), dtype=int) for k, s in shapes.items()}
            seen = got.toPandas()
            for k, r in seen.groupby("dataset"):
                out[k][r.z, r.y, r.x] = r.v
            for k, c in cubes.items():
                want = np.where(np.indices(c.shape).sum(axis=0) % 5 != 0, c, 7)[:, 2:, 3:]
                assert (out[k] == want).all() and (seen.dataset == k).sum() == want.size


def test_voxels_outside_their_volume_are_refused(spark):
    vox = spark.createDataFrame([("a", 0, 0, 5, 1)], "dataset string, z long, y long, x long, v long")
    sizes = spark.createDataFrame([("a", 1, 1, 5)], "dataset string, nz long, ny long, nx long")
    with pytest.raises(Exception, match="outside its volume"):
        blocks.to_blocks(vox, {"z": 4, "y": 4, "x": 4}, sizes).collect()


def test_octree_nodes_are_made_once_for_all_levels(spark):
    """A tree with fill looks at its nodes level by level; what makes them runs once."""
    made = spark.sparkContext.accumulator(0)

    def make(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    data = bytearray(np.arange(1, 9, dtype="<u2").tobytes())
    nodes = spark.createDataFrame([("d", 0, "", data), ("d", 0, "1", data), ("d", 0, "1/8", data)], "dataset string, channel int, path string, data binary")
    got = volumes.octree_blocks(nodes.mapInPandas(make, nodes.schema), 2, {"z": 2, "y": 2, "x": 2})
    assert got.count() == 64 and made.value == 3


def test_slab_files_are_written_in_the_order_of_positions(spark, tmp_path):
    """The folders' columns lead the order of the rows, so the writer needs no order of its own."""
    import pyarrow.parquet as pq

    at = np.random.default_rng(3).permutation(4 * 30 * 30)
    rows = pd.DataFrame({"dataset": [f"d{i % 2}" for i in at], "z": at // 900, "y": at // 30 % 30, "x": at % 30, "v": at})
    volumes.write_volume(spark.createDataFrame(rows), str(tmp_path / "v"), block_z=2)
    files = list((tmp_path / "v").rglob("*.parquet"))
    assert len({f.parent for f in files}) == 4
    for f in files:
        found = pq.ParquetFile(f).read().to_pandas()
        place = found.z * 900 + found.y * 30 + found.x
        assert (np.diff(place) > 0).all()
