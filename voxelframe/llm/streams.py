"""Sorted rows of a table as streams in tasks: runs of equal keys, parts of bounded size, digests of parts in order.

Rows are dealt by ranges of their whole order, so a key with a third of all rows lies in many
tasks. A task sees its share in order and holds one part at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 512


def turn_rows(convs: DataFrame, missing: str = "") -> DataFrame:
    """(conv_id, turn, role, text, tie) of a conversations table; a null role or text becomes ``missing``.

    Rows of one turn (or of none) are taken by ``tie``, a hash of role and text: an arbitrary but fixed order."""
    put = convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in ("role", "text")])
    return put.withColumn("tie", F.xxhash64("role", "text"))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples of Python values; nulls stay None and 64-bit ids stay whole."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, BATCH).columns])


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int = BATCH) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def in_ranges(df: DataFrame, order: list[str | Column], fn: Callable[[Iterator[tuple], int], Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` over the rows of each range of ``order``, sorted by it. ``fn`` also gets the number of the range;
    ranges are numbered in order. Sampled range borders carry the columns of ``order`` only."""
    return _streamed(df.repartitionByRange(*order).sortWithinPartitions(*order), fn, schema)


def by_key(df: DataFrame, key: list[str], order: list[str], fn: Callable[[Iterator[tuple], int], Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` over rows dealt by ``key`` and sorted by key and ``order``."""
    return _streamed(df.repartition(*key).sortWithinPartitions(*key, *order), fn, schema)


def _streamed(df: DataFrame, fn, schema: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)

    def run(batches):
        yield from batched(fn(rows_of(batches), TaskContext.get().partitionId()), arrow)

    return df.mapInArrow(run, parsed)


def part_number(task: int, n: int) -> int:
    """Numbers that rise with the range, then with the part in it."""
    return (task << 33) + n


def digests(parts: DataFrame, key: list[str], joiner: str) -> DataFrame:
    """(key, sha256) of the texts of ``parts`` (key, part, body) in order, with ``joiner`` between them.

    SHA-256 is one chain, so the parts of a key pass one task, part by part; parts, not rows, are what it reads."""
    kinds = dict(parts.dtypes)
    wide = len(key)

    def run(rows: Iterator[tuple], _: int) -> Iterator[tuple]:
        last, state = None, None
        for row in rows:
            if state is None or row[:wide] != last:
                if state is not None:
                    yield (*last, state.hexdigest())
                last, state = row[:wide], hashlib.sha256(row[-1].encode())
            else:
                state.update((joiner + row[-1]).encode())
        if state is not None:
            yield (*last, state.hexdigest())

    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in key], "sha256 string"])
    return by_key(parts.select(*key, "part", "body"), key, ["part"], run, schema)
