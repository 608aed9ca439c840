"""Helpers shared by the operators: tables, written intermediates, row keys."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelframe.session import ensure_checkpoint_dir

# The letters that "lower-case A-Z" touches.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read by Spark from whatever store the path names."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it back: the
    lineage ends there, and a lost executor costs no recomputation of it."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def crc_mod(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def row_key(id_col: str, text_col: str) -> list[Column]:
    """128 bits that tell rows apart by id and text (rows equal in both share it)."""
    i, t = F.col(id_col), F.col(text_col)
    return [F.xxhash64(i.isNull(), i, t.isNull(), t).alias("__k1"), F.xxhash64(F.lit(7), t, i).alias("__k2")]


def sized(df: DataFrame, name: str, limit: int = 100_000) -> DataFrame:
    """Write a narrow table and count it: up to ``limit`` rows it may be broadcast,
    beyond that joins with it are left to Spark's shuffles."""
    done = written(df, name)
    return F.broadcast(done) if done.count() <= limit else done
