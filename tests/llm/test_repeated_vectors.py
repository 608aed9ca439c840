"""Nearest neighbours of tables with repeated rows and ids of several vectors, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelframe.llm import neighbours


@pytest.mark.parametrize("block", [60, 2048])
def test_repeated_rows_take_no_places(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    monkeypatch.setattr(neighbours, "LEAF", 16)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(240, 6))
    ids = np.r_[np.arange(200), np.arange(40)]  # the first 40 ids have two vectors
    rows = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<double>")
    rows = rows.crossJoin(spark.range(25)).drop("id")
    got = neighbours.neighbours(rows, F.col("vec_id") % 20 == 0).toPandas()
    seen = 0
    for q in range(0, 200, 20):
        score = {}
        for i, v in zip(ids, x):
            if i != q:
                score[i] = max(score.get(i, -np.inf), *(float(w @ v) for w in x[ids == q]))
        best = sorted(score, key=lambda i: (-score[i], i))[:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert list(mine["rank"]) == list(range(1, 21)) and mine.vec_id.nunique() == 20
        assert np.allclose(mine.score, [score[i] for i in mine.vec_id])
        seen += len(set(best) & set(mine.vec_id))
    assert seen >= 0.95 * 200
