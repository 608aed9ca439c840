"""Registered queries, their SQL counterparts and the fixtures both read."""

from __future__ import annotations

import importlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from catalog.fixtures import FIXTURES, TABLES, WIDE

MODULES = ["sources", "grid", "pixel", "joins", "stats", "stencils", "compose", "transforms",
           "points", "matching", "labels", "surfaces", "registration", "bordered"]

QUERIES: dict = {}
ORACLES: dict = {}
RAW: dict = {}
_TOKEN = re.compile(r"@(\w+)")
# Rounding point: six places, moved off the dyadic ties so that both engines agree.
BIAS = 0.50013


class Fixtures:
    """Lazily built fixture DataFrames of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._cache, self.wide = spark, sf_dir, {}, False

    def __getattr__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                self._cache[name] = self.sql(self._fitting(name))
        return self._cache[name]

    def _fitting(self, name: str) -> str:
        """The text of a fixture; where the keys of the table lead its id beyond 64 bits, with the id as a decimal."""
        if name not in WIDE:
            return FIXTURES[name]
        table, factors, first = WIDE[name]
        ends = getattr(self, table).agg(*[end(c) for c in factors for end in (F.min, F.max)]).first()
        largest = [max(abs(v) for v in pair if v is not None) if pair != (None, None) else 0 for pair in zip(ends[::2], ends[1::2])]
        if sum(v * factor for v, factor in zip(largest, factors.values())) < 1 << 63:
            return FIXTURES[name]
        self.wide = True
        return FIXTURES[name].replace(first, f"CAST({first} AS DECIMAL(38, 0))", 1)

    def sql(self, text: str) -> DataFrame:
        names = sorted(set(_TOKEN.findall(text)))
        return self.spark.sql(_TOKEN.sub(r"{\1}", text), **{n: getattr(self, n) for n in names})


def _columns(spec: str):
    for item in spec.split():
        name, _, kind = item.partition(":")
        yield name, kind or "i"


def _shape(df: DataFrame, spec: str, wide: bool = False) -> DataFrame:
    """``wide``: the fixtures have decimal ids, which stay what they are."""
    out = []
    for name, kind in _columns(spec):
        c = F.col(name)
        if kind == "i":
            c = c if wide and df.schema[name].dataType == DecimalType(38, 0) else c.cast("long")
        elif kind == "f":
            c = F.floor(c.cast("double") * 1e6 + BIAS) / F.lit(1e6)
        out.append(c.alias(name))
    return df.select(*out)


def _with_chain(text: str, done: list, chain: list) -> None:
    for name in _TOKEN.findall(text):
        if name in TABLES or name in done:
            continue
        _with_chain(FIXTURES[name], done, chain)
        done.append(name)
        chain.append(f"{name} AS ({FIXTURES[name]})")


def oracle_text(sql: str, spec: str) -> str:
    chain: list = []
    _with_chain(sql, [], chain)
    body = sql.strip()
    if re.match(r"(?is)^with\s", body):
        head, tail = body[5:], ""
        depth, cut = 0, None
        for m in re.finditer(r"[()]|\bSELECT\b", head):
            if m.group() == "(":
                depth += 1
            elif m.group() == ")":
                depth -= 1
            elif depth == 0:
                cut = m.start()
                break
        chain.append(head[:cut].rstrip())
        body = head[cut:] + tail
    cells = []
    for name, kind in _columns(spec):
        if kind == "i":
            cells.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind == "f":
            cells.append(f"floor(CAST({name} AS DOUBLE) * 1e6 + {BIAS}) / 1e6 AS {name}")
        else:
            cells.append(name)
    prefix = f"WITH RECURSIVE {', '.join(chain)} " if chain else ""
    return _TOKEN.sub(r"\1", f"{prefix}SELECT {', '.join(cells)} FROM ({body}) AS result")


def query(name: str, columns: str, sql: str | None = None):
    """Register a query. ``columns`` lists ``name:kind`` (i integer, f real, s text, b boolean)."""

    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        RAW[name] = fn, columns, sql
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            fixtures = Fixtures(spark, sf_dir)
            return _shape(fn(fixtures), columns, fixtures.wide)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle_text(sql, columns)
        return fn

    return wrap


# Queries whose operators look at neighbours; they also run on a volume that was stored without its zeros.
STORED = ["w1_gauss", "w3_local_contrast", "w7_median_z3", "w8_gradient_forward", "w9_gradient_center", "w10_gradient_magnitude",
          "w12_black_neighbour", "c1_derivative_cost", "m1_detect_dog"]


def _stored(fn):
    from voxelframe.operators import pixel
    from voxelframe.session import ensure_checkpoint_dir
    from voxelframe.sources import volumes

    def run(f: Fixtures) -> DataFrame:
        path = f"{ensure_checkpoint_dir(f.spark)}/voxelframe-stored-{uuid.uuid4().hex}"
        volumes.write_volume(f.em, path, background=0, block_z=4)
        f._cache["em"] = volumes.read_volume(f.spark, path, sizes=pixel.extents(f.em))
        return fn(f)

    return run


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"catalog.{module}")
    for name in STORED:
        fn, columns, sql = RAW[name]
        if f"{name}_stored" not in QUERIES:
            query(f"{name}_stored", columns, sql)(_stored(fn))
