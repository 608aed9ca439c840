"""Gathers: read a volume or a field at real positions.

Each source sample is first joined with its upper neighbours along the
interpolated axes (windows over image lines), which gives one row per lattice
cell with all its corners. A target then needs a single equi-join to one cell,
instead of one lookup per corner and an aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.operators.stencils import line
from voxelframe.schema import KEY
from voxelframe.session import small

AXES = ("z", "y", "x")


def corner_cells(df: DataFrame, axes: list[str], values: list[str], keys: list[str] = KEY) -> DataFrame:
    """Lattice cells with their corners: column ``c`` holds 2^k structs of the
    values, the first axis varying fastest; absent corners are null. Works on
    sparse volumes: cells below the first sample of a run are added."""
    lattice = [a for a in AXES if a in df.columns and a not in keys]
    out = df.select(*keys, *lattice, F.array(F.struct(*[F.col(v).cast("double").alias(v) for v in values])).alias("c"))
    for a in axes:
        over = line(out, a, keys)
        blank = F.transform(F.col("c"), lambda s: F.when(F.lit(False), s))
        out = out.withColumn("_prev", F.lag(a).over(over))
        near = F.when(F.col("_prev") == F.col(a) - 1, F.array(F.col(a))).otherwise(F.array(F.col(a) - 1, F.col(a)))
        out = out.withColumn("_at", F.explode(near))
        out = out.withColumn("c", F.when(F.col("_at") == F.col(a), F.col("c")).otherwise(blank)).withColumn(a, F.col("_at"))
        step = F.lead(F.struct(F.col(a), F.col("c"))).over(line(out, a, keys))
        out = out.withColumn("_next", step)
        blank = F.transform(F.col("c"), lambda s: F.when(F.lit(False), s))
        upper = F.when(F.col(f"_next.{a}") == F.col(a) + 1, F.col("_next.c")).otherwise(blank)
        out = out.withColumn("c", F.concat("c", upper)).drop("_prev", "_at", "_next")
    return out


def interpolate(targets: DataFrame, source: DataFrame, at: dict[str, str], values: list[str] = ("v",),
                keys: list[str] = KEY, background: float = 0.0, prefix: str = "") -> DataFrame:
    """Add n-linearly interpolated values at real positions. ``at`` maps every
    lattice axis of the source to the target column that holds the position;
    integer columns are matched exactly. Outside the source lies ``background``."""
    kinds = dict(targets.dtypes)
    real = [a for a, c in at.items() if kinds[c] in ("double", "float")]
    cells = corner_cells(source, real, list(values), keys).withColumnRenamed("c", "_c")
    cells = cells.withColumnsRenamed({a: f"_{a}" for a in at})
    spots = targets.withColumns({f"_{a}": (F.floor(F.col(c)) if a in real else F.col(c)).cast("long") for a, c in at.items()})
    spots = spots.withColumns({f"_f{a}": F.col(at[a]) - F.col(f"_{a}") for a in real})
    joined = spots.join(cells, [*keys, *[f"_{a}" for a in at]], "left")
    out = {}
    for v in values:
        terms = []
        for i in range(2 ** len(real)):
            w = F.lit(1.0)
            for bit, a in enumerate(real):
                w = w * (F.col(f"_f{a}") if i >> bit & 1 else F.lit(1.0) - F.col(f"_f{a}"))
            terms.append(w * F.coalesce(F.col("_c")[i][v], F.lit(float(background))))
        out[prefix + v] = reduce(lambda p, q: p + q, terms)
    joined = joined.withColumns(out)
    return joined.drop("_c", *[f"_{a}" for a in at], *[f"_f{a}" for a in real])


def nearest(targets: DataFrame, source: DataFrame, at: dict[str, str], values: list[str] = ("v",),
            keys: list[str] = KEY, background: float | None = 0.0, prefix: str = "") -> DataFrame:
    """Add the value of the nearest sample."""
    spots = targets.withColumns({f"_{a}": F.floor(F.col(c) + F.lit(0.5)).cast("long") for a, c in at.items()})
    ready = source.select(*keys, *[F.col(a).alias(f"_{a}") for a in at], *[F.col(v).alias(f"_v{v}") for v in values])
    joined = spots.join(ready, [*keys, *[f"_{a}" for a in at]], "left")
    fill = {prefix + v: (F.col(f"_v{v}") if background is None else F.coalesce(f"_v{v}", F.lit(background))) for v in values}
    return joined.withColumns(fill).drop(*[f"_{a}" for a in at], *[f"_v{v}" for v in values])


def clamped(position: Column, size: Column) -> Column:
    """Border extension: positions outside read the nearest border sample."""
    return F.greatest(F.lit(0.0), F.least(position, (size - 1).cast("double")))


def look_up(targets: DataFrame, field: DataFrame, x: Column, y: Column, values: list[str], sizes: DataFrame,
            keys: list[str] = KEY, prefix: str = "") -> DataFrame:
    """Bilinear, border-extended values of a 2-D field (rows y, x) at (x, y)."""
    extent = small(sizes).select(*keys, F.col("nx").alias("_nx"), F.col("ny").alias("_ny"))
    spots = targets.join(extent, keys).withColumn("_px", clamped(x, F.col("_nx"))).withColumn("_py", clamped(y, F.col("_ny")))
    out = interpolate(spots, field, {"y": "_py", "x": "_px"}, values, keys, 0.0, prefix)
    return out.drop("_nx", "_ny", "_px", "_py")
