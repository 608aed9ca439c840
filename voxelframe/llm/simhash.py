"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, Hamming check, components.

Texts are lower-cased in A-Z and split at ASCII white space; shingles of three
words, repeats included, are hashed with XXH64 (seed 42); a fingerprint bit is set
if over half of the hashes have it. Fewer words than a shingle give one shingle;
null, empty and blank texts have fingerprint zero, which links like any other.

Blocks: 64 bits are four parts of 16. Fingerprints that differ in at most two bits
agree in two parts at least, so each fingerprint is sent to the six pairs of parts.
A block with more than ``BLOCK`` fingerprints is not compared as it stands: what
remains of its fingerprints is cut into four parts again, by the same argument, and
a third time, after which a block can hold 256 different fingerprints at most. No
link is lost, and no block is compared whole that near copies have made large.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.llm.common import row_key, table, written
from voxelframe.llm.components import components
from voxelframe.llm.registry import query

WORDS, SEED, BITS, BLOCK = 3, 42, 2, 128
_CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """Fingerprint of one text as an unsigned integer."""
    parts = text.encode().lower().split() if text else []
    if not parts:
        return 0
    shingles = [b" ".join(parts)] if len(parts) < words else map(b" ".join, zip(*(parts[i:] for i in range(words))))
    total = max(1, len(parts) - words + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), dtype="<u8", count=total)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, total, _CHUNK):
        bits = np.unpackbits(hashes[at:at + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                 seed: int = SEED) -> DataFrame:
    """(id, __k1, __k2, fp): one row per row of ``docs``; fp is the fingerprint as a signed long."""
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64))

    return docs.select(F.col(id_col), *row_key(id_col, text_col), prints(F.col(text_col).cast("string")).alias("fp"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(free: list[int], bits: int) -> list[tuple[int, list[int]]]:
    """Cut the free bit places into bits + 2 parts; every choice of two parts as (its mask, places left free)."""
    parts = [list(p) for p in np.array_split(np.array(free), bits + 2)]
    out = []
    for chosen in combinations(range(len(parts)), 2):
        mask = sum(1 << int(i) for c in chosen for i in parts[c])
        out.append((mask, [int(i) for c, p in enumerate(parts) if c not in chosen for i in p]))
    return out


def _levels(bits: int, depth: int = 3) -> list[list[tuple[int, int]]]:
    """(mask of the parent block, mask) for each level of blocks."""
    levels, above = [], [(0, list(range(64)))]
    for _ in range(depth):
        rows, below = [], []
        for parent, free in above:
            for mask, rest in _masks(free, bits):
                rows.append((_signed(parent), _signed(parent | mask)))
                below.append((parent | mask, rest))
        levels.append(rows)
        above = below
    return levels


def close_pairs(nodes: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """(u, v), u < v: all pairs of different fingerprints (column ``fp``) at most ``bits`` bits apart.

    With ``bits`` = 2 the blocks are pairs of four parts. ``nodes`` must hold each fingerprint once."""
    spark = nodes.sparkSession
    pairs, rows = None, nodes.select("fp")
    levels = _levels(bits)
    for depth, masks in enumerate(levels):
        cut = F.broadcast(spark.createDataFrame(masks, "parent long, mask long"))  # 6 rows for each parent, 216 at most
        split = rows.join(cut, "parent") if depth else rows.withColumn("mask", F.explode(F.array(*[F.lit(m) for _, m in masks])))
        rows = split.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
        if depth + 1 < len(levels):
            large = written(rows.groupBy("mask", "part").count().where(F.col("count") > block).select("mask", "part"), "blocks")
            whole = rows.join(large, ["mask", "part"], "left_anti")
        else:
            large, whole = None, rows
        a, b = whole.alias("a"), whole.select("mask", "part", F.col("fp").alias("fp2")).alias("b")
        found = a.join(b, (F.col("a.mask") == F.col("b.mask")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.fp") < F.col("b.fp2"))
                       & (F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp2"))) <= bits)).select(F.col("a.fp").alias("u"), F.col("b.fp2").alias("v"))
        pairs = found if pairs is None else pairs.unionByName(found)
        if large is None or large.isEmpty():
            break
        rows = rows.join(large, ["mask", "part"], "left_semi").select("fp", F.col("mask").alias("parent"))
    return pairs.distinct()


def linked(prints: DataFrame, id_col: str = "doc_id", bits: int = BITS) -> DataFrame:
    """Add ``root`` (smallest fingerprint reachable) and ``component_id`` (smallest id reachable, null if none has an id)
    to the rows of ``fingerprints``. Equal fingerprints are one node, so copies never become pairs."""
    nodes = written(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    roots = components(close_pairs(nodes, bits))
    nodes = nodes.join(roots.withColumnRenamed("u", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(nodes.select("fp", "root").join(least, "root"), "fp")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each component: that of smallest id (null ids last), then of smallest row key."""
    prints = written(fingerprints(docs, id_col, text_col, words), "prints")
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), F.col("__k1"), F.col("__k2"))
    kept = linked(prints, id_col, bits).groupBy("root").agg(F.min(order).alias("o")).select("o.__k1", "o.__k2")
    mine = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *row_key(id_col, text_col))
    return mine.join(kept, ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"]).select("__row.*")


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    prints = written(fingerprints(table(spark, sf_dir, "documents")), "prints")
    return linked(prints).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
