"""Session helpers: reliable checkpoints for the iterative operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session's
    ``spark.checkpoint.dir``. Only a local session may fall back to a temporary
    folder; on a cluster a missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="voxelframe-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage of a loop variable by writing it to reliable storage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table that is read again to reliable storage, as compressed columns:
    the form for wide or long tables, of which a checkpoint would keep plain rows."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/voxelframe-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Fixed value: rows up to which a narrow table (sizes, models, offsets) may be broadcast.
SMALL_ROWS = 50_000


def measured(df: DataFrame) -> DataFrame:
    """Materialise a table that should be small and remember its row count."""
    if getattr(df, "_measured_rows", None) is None:
        df = checkpoint(df)
        df._measured_rows = df.count()
    return df


def small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """The side of a join that holds one narrow row per volume, layer or pair.

    It is computed once and counted; up to ``limit`` rows it is broadcast, so
    the voxels on the other side are not shuffled by a key that a third of them
    may share. Beyond the limit the join is left to Spark."""
    done = measured(df)
    return F.broadcast(done) if done._measured_rows <= limit else done
