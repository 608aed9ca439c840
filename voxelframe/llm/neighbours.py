"""Nearest neighbours by inner product: stable projections, a kd-tree, and a chi-square stop.

A vector x is scaled by the largest norm and given one more component that makes it a unit
vector; a query is scaled to a unit vector whose last component is 0. Then the largest inner
product is the least distance. Both are projected by ``DIMS`` Gaussian vectors: the squared
projected distance divided by the squared distance has a chi-square distribution.

The kd-tree over projected vectors has a top, built from a sample of ``SAMPLE`` of them, whose
cells hold every vector, and below it one tree per block of about ``BLOCK`` vectors, or more
where there would be over ``BLOCKS`` blocks (their boxes are broadcast); a cell with many
(equal) vectors has several blocks. A query searches its own cell first. Then it
visits the other blocks, and in a block the leaves, by projected distance, and verifies true
products, until what is left lies so far off that a vector as near as its k-th best would have
been seen with probability ``SURE``. So each true neighbour is missed with probability
1 - SURE at most, whatever the data.

Vectors that are null, zero, of no id, hold null or non-finite components, or are not of the
commonest length take no part. Repeated rows are one, and an id with several vectors is one
neighbour, by its best score. A query's own row is any row of its id. Ties go to the smaller
id. Fewer candidates than k give all of them; no vectors give no rows. Queries are never
broadcast: they move in packs to the blocks they have to visit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, exp, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelframe.llm.common import table, written
from voxelframe.llm.registry import query

K, DIMS, SURE, SEED = 20, 8, 0.95, 17
BLOCK, BLOCKS, LEAF, PACK, SAMPLE, DEPTH = 2048, 65_536, 256, 256, 50_000, 14


def chi_square(dims: int, sure: float) -> float:
    """Quantile of the chi-square distribution with an even number of degrees of freedom."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        term = total = 1.0
        for i in range(1, dims // 2):
            term *= mid / 2 / i
            total += term
        low, high = (mid, high) if 1 - exp(-mid / 2) * total < sure else (low, mid)
    return high


@dataclass
class Space:
    """Scale, projection and top of the tree."""

    norm: float
    axes: np.ndarray
    dims: np.ndarray
    cuts: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        x = x / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("nd,nd->n", x, x)))
        return np.column_stack([x, rest]) @ self.axes

    def queries(self, q: np.ndarray) -> np.ndarray:
        return (q / np.linalg.norm(q, axis=1, keepdims=True)) @ self.axes[:-1]

    def cell(self, p: np.ndarray) -> np.ndarray:
        node = np.zeros(len(p), dtype=np.int64)
        for _ in range(int(log2(len(self.dims) + 1))):
            node = 2 * node + 1 + (p[np.arange(len(p)), self.dims[node]] > self.cuts[node])
        return node - len(self.dims)


def _top(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    dims, cuts = np.zeros((1 << depth) - 1, dtype=np.int64), np.zeros((1 << depth) - 1)
    held = {0: points}
    for node in range(len(dims)):
        p = held.pop(node)
        if len(p):
            dims[node] = np.argmax(p.max(axis=0) - p.min(axis=0))
            cuts[node] = np.median(p[:, dims[node]])
        right = p[:, dims[node]] > cuts[node]
        held[2 * node + 1], held[2 * node + 2] = p[~right], p[right]
    return dims, cuts


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree."""
    out, todo = [], [np.arange(len(points))]
    while todo:
        at = todo.pop()
        if len(at) <= size:
            out.append(at)
            continue
        p = points[at]
        order = np.argpartition(p[:, np.argmax(p.max(axis=0) - p.min(axis=0))], len(at) // 2)
        todo += [at[order[:len(at) // 2]], at[order[len(at) // 2:]]]
    return out


def gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances (points, boxes)."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        out += np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0.0) ** 2
    return out


def best(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each owner's k largest scores over different ids, each by its best; ties by smaller id."""
    order = np.lexsort((-score, ids, owner))
    at, one = owner[order], ids[order]
    if len(at):
        order = order[np.r_[True, (at[1:] != at[:-1]) | (one[1:] != one[:-1])]]
    order = order[np.lexsort((ids[order], -score[order], owner[order]))]
    at = owner[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, dtype=np.int64)
    rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    return order[rank < k]


def search(space: Space, k: int, limit: float, qids: np.ndarray, q: np.ndarray, kth: np.ndarray, ids: np.ndarray, x: np.ndarray) -> tuple:
    """(place of query, id, score) of the k best of a block for each query that may enter its best; kth: the k-th scores so far."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    points, asked = space.rows(x), space.queries(q)
    parts = leaves(points)
    far = gaps(asked, np.array([points[a].min(axis=0) for a in parts]), np.array([points[a].max(axis=0) for a in parts]))
    turn, scale = np.argsort(far, axis=1, kind="stable"), np.linalg.norm(q, axis=1) * space.norm
    kth, held = kth.copy(), (np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0, dtype=np.int64))
    for r in range(len(parts)):
        leaf = turn[:, r]
        radius = np.where(np.isfinite(kth), limit * np.maximum(0.0, 2 - 2 * kth / scale), np.inf)
        live = far[np.arange(len(q)), leaf] <= radius + 1e-9
        if not live.any():
            break
        new = [held]
        for one in np.unique(leaf[live]):
            mine = np.flatnonzero(live & (leaf == one))
            at = parts[one]
            s = np.einsum("qd,nd->qn", q[mine], x[at])  # the same sum for equal vectors, wherever they lie
            i, j = np.nonzero((s >= kth[mine][:, None]) & (ids[at][None, :] != qids[mine][:, None]))
            new.append((mine[i], s[i, j], ids[at][j]))
        owner, score, found = (np.concatenate([n[c] for n in new]) for c in range(3))
        top = best(owner, score, found, k)
        held = owner[top], score[top], found[top]
        n = np.bincount(held[0], minlength=len(q))
        last = np.full(len(q), np.inf)
        np.minimum.at(last, held[0], held[1])
        kth = np.where(n >= k, np.maximum(kth, last), kth)
    return held


_BLOCK = "block long, cell int, ids binary, vecs binary, low binary, high binary"
_PACK = "block long, qids binary, qvecs binary, kth binary"
_FOUND = "query_id long, vec_id long, score double"


def _ids(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=np.int64)


def _matrix(b: bytes, n: int) -> np.ndarray:
    return np.frombuffer(b, dtype=np.float64).reshape(n, -1)


def usable(vec: Column) -> Column:
    v = vec.cast("array<double>")
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def neighbours(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", sure: float = SURE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found for every row of which ``is_query`` holds."""
    spark = vectors.sparkSession
    good = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(usable(F.col("v")) & F.col("id").isNotNull())
    # repeated rows are one vector; how often each occurs only decides the commonest length
    good = written(good.groupBy("id", "v").agg(F.bool_or("asks").alias("asks"), F.count(F.lit(1)).alias("copies")), "vectors")
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("rows"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m"))
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = common["d"], common["rows"]
    size = max(BLOCK, ceil(total / BLOCKS))
    good = good.where(F.size("v") == dim)
    axes = np.random.default_rng(SEED).standard_normal((dim + 1, DIMS))
    space = Space(float(np.sqrt(common["m"])) or 1.0, axes, np.zeros(0, dtype=np.int64), np.zeros(0))
    depth = min(DEPTH, max(0, ceil(log2(total / size))))
    if depth:
        share = int(min(1.0, SAMPLE / total) * (1 << 40))
        drawn = good.where(F.pmod(F.xxhash64("id", "v"), F.lit(1 << 40)) < share).select("v").toPandas()["v"]
        space.dims, space.cuts = _top(space.rows(np.stack(drawn.to_numpy())) if len(drawn) else np.zeros((0, DIMS)), depth)
    shared, limit = spark.sparkContext.broadcast(space), chi_square(DIMS, sure)

    @F.pandas_udf("cell int, qcell int")
    def cells(v: pd.Series) -> pd.DataFrame:
        x, s = np.stack(v.to_numpy()), shared.value
        return pd.DataFrame({"cell": s.cell(s.rows(x)), "qcell": s.cell(s.queries(x))})

    placed = written(good.withColumn("c", cells("v")).select("id", "v", "asks", "c.cell", "c.qcell"), "placed")

    def packed(rows: DataFrame, cell: str, size: int, salt: int) -> DataFrame:
        """Number rows by cell and, where a cell has more than ``size``, by parts of it."""
        parts = rows.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
        return rows.join(F.broadcast(parts), cell).withColumn("block", F.col(cell) * F.lit(1 << 32) + F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.col("parts")))

    def block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["v"].to_numpy())
        p = shared.value.rows(x)
        return pd.DataFrame({"block": [key[0]], "cell": [rows["cell"].iloc[0]], "ids": [rows["id"].to_numpy().tobytes()], "vecs": [x.tobytes()],
                             "low": [p.min(axis=0).tobytes()], "high": [p.max(axis=0).tobytes()]})

    blocks = written(packed(placed.drop("asks", "qcell"), "cell", size, 0).groupBy("block").applyInPandas(block, _BLOCK), "blocks")
    asking = written(packed(placed.where("asks").drop("cell", "asks"), "qcell", PACK, 1).select("id", "v", "qcell", "block"), "asking")

    def home(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": [int(rows["qcell"].iloc[0])], "qids": [rows["id"].to_numpy().tobytes()], "qvecs": [np.stack(rows["v"].to_numpy()).tobytes()],
                             "kth": [np.full(len(rows), -np.inf).tobytes()]})

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                qids, ids = _ids(r.qids), _ids(r.ids)
                q, x = _matrix(r.qvecs, len(qids)), _matrix(r.vecs, len(ids))
                owner, score, found = search(shared.value, k, limit, qids, q, np.frombuffer(r.kth, dtype=np.float64), ids, x)
                yield pd.DataFrame({"query_id": qids[owner], "vec_id": found, "score": score})

    asked = ["qids", "qvecs", "kth", "ids", "vecs"]
    first = asking.groupBy("block").applyInPandas(home, _PACK).withColumnRenamed("block", "cell").join(blocks.select("cell", "ids", "vecs"), "cell")
    near = written(first.select(*asked).mapInPandas(verify, _FOUND), "near")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    kth = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", rank).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    boxes = blocks.select("block", "cell", "low", "high").toPandas()
    box = spark.sparkContext.broadcast((boxes["block"].to_numpy(), boxes["cell"].to_numpy(), np.array([np.frombuffer(b) for b in boxes["low"]]), np.array([np.frombuffer(b) for b in boxes["high"]])))

    def further(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        number, cell, low, high = box.value
        q, kth, s = np.stack(rows["v"].to_numpy()), rows["kth"].fillna(-np.inf).to_numpy(dtype=np.float64), shared.value
        radius = np.where(np.isfinite(kth), limit * np.maximum(0.0, 2 - 2 * kth / (np.linalg.norm(q, axis=1) * s.norm)), np.inf)
        go = (gaps(s.queries(q), low, high) <= radius[:, None] + 1e-9) & (cell != rows["qcell"].iloc[0])
        ids, out = rows["id"].to_numpy(), []
        for j in np.flatnonzero(go.any(axis=0)):
            at = go[:, j]
            out.append((int(number[j]), ids[at].tobytes(), q[at].tobytes(), kth[at].tobytes()))
        return pd.DataFrame(out, columns=["block", "qids", "qvecs", "kth"])

    packs = asking.join(kth, "id", "left").groupBy("block").applyInPandas(further, _PACK)
    more = packs.join(blocks.select("block", "ids", "vecs"), "block").select(*asked).mapInPandas(verify, _FOUND)
    # rows that share a query's id ask the same question or several; each pair counts once, by its best score
    found = near.unionByName(more).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query("op8_nearest_neighbours")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
