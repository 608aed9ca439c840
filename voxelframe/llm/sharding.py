"""Shards of nearly equal bytes by histogram sort.

Rows have a total order: hash of the text, hash of the id, number of the row. Splitters are
found by probes: keys drawn from the open intervals. Each round counts the exact bytes and rows
below every probe across all partitions and narrows the intervals, until each splitter is within
tolerance of its share or between two neighbouring rows. Then the rows move once. Between the
splitters of two shards further ones cut ranges of bounded size, in which rows are numbered, so
no shard passes through one task.

A boundary is moved to the edge of a group of equal texts where that costs at most ``TOGETHER`` of a
shard: small groups stay in one shard, large ones are split, as equal bytes are the law. Null texts
have no bytes and share a hash; repeated rows are told apart by their number; no rows give no
shards. More shards than rows leave some empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxelframe.llm.common import table, written
from voxelframe.llm.registry import query

SHARDS, RANGE_ROWS, PROBES = 16, 1_000_000, 64
TOLERANCE, TOGETHER = 0.001, 0.01
KEY = ["__h", "__d", "__u"]
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
Key = tuple[int, int, int]


def place(columns: list[np.ndarray], probes: np.ndarray) -> np.ndarray:
    """Number of probes (rows of three, in order) that are not above each key."""
    low, high = np.zeros(len(columns[0]), dtype=np.int64), np.full(len(columns[0]), len(probes), dtype=np.int64)
    for _ in range(len(probes).bit_length()):
        open_ = low < high
        mid = np.minimum((low + high) // 2, max(0, len(probes) - 1))
        above, equal = np.zeros(len(low), dtype=bool), np.ones(len(low), dtype=bool)
        for i, column in enumerate(columns):
            at = probes[mid, i]
            above |= equal & (at > column)
            equal &= at == column
        high = np.where(open_ & above, mid, high)
        low = np.where(open_ & ~above, mid + 1, low)
    return low


def _array(keys: list[Key]) -> np.ndarray:
    return np.array(keys, dtype=np.int64).reshape(-1, 3)


def below(rows: DataFrame, probes: list[Key]) -> list[tuple[int, int]]:
    """Exact (bytes, rows) below each probe."""
    cut = _array(probes)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, n = np.zeros(len(cut) + 1, dtype=np.int64), np.zeros(len(cut) + 1, dtype=np.int64)
        for b in batches:
            at = place([b[k].to_numpy() for k in KEY], cut)
            np.add.at(size, at, b["size"].to_numpy())
            n += np.bincount(at, minlength=len(n))
        there = np.flatnonzero(n)
        yield pd.DataFrame({"at": there, "size": size[there], "n": n[there]})

    found = rows.select(*KEY, "size").mapInPandas(summed, "at int, size long, n long").groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    sums = {r["at"]: (r["size"], r["n"]) for r in found.collect()}
    out, b, n = [], 0, 0
    for i in range(len(probes)):
        b, n = b + sums.get(i, (0, 0))[0], n + sums.get(i, (0, 0))[1]
        out.append((b, n))
    return out


def drawn(rows: DataFrame, open_: list[tuple[Key, Key, int]], each: int, seed: int) -> list[Key]:
    """About ``each`` keys from every open interval (from, to, rows in it); all keys of a smaller one."""
    edges = sorted({k for a, b, _ in open_ for k in (a, b)})
    cut = _array(edges)
    share = np.zeros(len(edges) + 1)
    for a, b, n in open_:
        share[edges.index(a) + 1:edges.index(b) + 1] = min(1.0, each / max(1, n))

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            mixed = (b["__u"].to_numpy().astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            dice = (mixed >> np.uint64(11)).astype(np.float64) / (1 << 53)
            yield b[dice < share[place([b[k].to_numpy() for k in KEY], cut)]]

    found = rows.select(*KEY).mapInPandas(some, "__h long, __d long, __u long").collect()
    return sorted({tuple(r) for r in found})


def splitters(rows: DataFrame, shards: int, ranges: int, tolerance: float = TOLERANCE, max_rounds: int = 100) -> list[tuple[Key, int, int]]:
    """(key, bytes below, rows below) of the shards x ranges - 1 splitters, in order."""
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    first, last = (_LEAST,) * 3, (_MOST,) * 3
    known: dict[Key, tuple[int, int]] = {first: (0, 0), last: tuple(total)}
    parts = shards * ranges
    goals = [total[0] * i // parts for i in range(1, parts)]
    slack = [total[0] / shards * tolerance if i % ranges == 0 else total[0] / parts / 4 for i in range(1, parts)]

    def around() -> list[tuple[Key, Key]]:
        keys = sorted(known)
        sums = np.array([known[k][0] for k in keys])
        at = np.clip(np.searchsorted(sums, goals, side="right"), 1, len(keys) - 1)
        return [(keys[i - 1], keys[i]) for i in at]

    for seed in range(max_rounds):
        open_ = {(a, b, known[b][1] - known[a][1]) for (a, b), goal, s in zip(around(), goals, slack)
                 if known[b][1] - known[a][1] > 1 and min(goal - known[a][0], known[b][0] - goal) > s}
        if not open_:
            break
        probes = [k for k in drawn(rows, sorted(open_), PROBES, seed) if k not in known]
        known.update(zip(probes, below(rows, probes)))
    else:
        raise RuntimeError(f"splitters did not settle in {max_rounds} rounds")
    best = [min((a, b), key=lambda k, goal=goal: (abs(known[k][0] - goal), k)) for (a, b), goal in zip(around(), goals)]
    edges = sorted({e for k in best if k != first and k != last for e in ((k[0], _LEAST, _LEAST), (k[0] + 1, _LEAST, _LEAST) if k[0] < _MOST else last)} - known.keys())
    if edges:
        known.update(zip(edges, below(rows, edges)))
    out = []
    for i, (k, goal) in enumerate(zip(best, goals), 1):
        near = [e for e in ((k[0], _LEAST, _LEAST), (k[0] + 1, _LEAST, _LEAST) if k[0] < _MOST else last) if e in known]
        near = [e for e in near if abs(known[e][0] - goal) <= total[0] / shards * TOGETHER]
        if i % ranges == 0 and near:
            k = min(near, key=lambda e: abs(known[e][0] - goal))
        k = max(k, out[-1][0]) if out else k
        out.append((k, *known[k]))
    return out


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE,
          range_rows: int = RANGE_ROWS, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default), size, shard and slot (gapless from 0 in a shard) of every row.

    Rows lie sorted by shard and slot within the partitions of the result."""
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if keep is None else F.struct(*keep)
    rows = written(docs.select(row.alias("__row"), size.alias("size"), F.xxhash64(text).alias("__h"), F.xxhash64(F.col(id_col)).alias("__d"),
                               F.monotonically_increasing_id().alias("__u")), "keys")
    ranges = max(4, -(-rows.count() // (shards * range_rows)))
    found = splitters(rows, shards, ranges, tolerance)
    cut = _array([k for k, _, _ in found])
    starts = np.array([0] + [n for _, _, n in found], dtype=np.int64)
    base = starts - starts[::ranges][np.arange(len(starts)) // ranges]

    @F.pandas_udf("cell int, base long")
    def cell(h: pd.Series, d: pd.Series, u: pd.Series) -> pd.DataFrame:
        at = place([h.to_numpy(), d.to_numpy(), u.to_numpy()], cut)
        return pd.DataFrame({"cell": at, "base": base[at]})

    put = rows.withColumn("__c", cell(*KEY))
    number = F.row_number().over(W.partitionBy("__c.cell").orderBy(*KEY)) - 1
    done = put.withColumn("slot", F.col("__c.base") + number).withColumn("shard", F.floor(F.col("__c.cell") / ranges).cast("int"))
    return done.select("__row", "size", "shard", "slot")


@query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    done = shard(docs.withColumn("text_crc32", crc), keep=["doc_id", "text_crc32"])
    return done.select("__row.doc_id", "size", "__row.text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
