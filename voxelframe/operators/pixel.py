"""Per-voxel operators: crops, axis changes, slices, border policies and pointwise maths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.schema import KEY, POS
from voxelframe.session import measured, small

AXES = ("z", "y", "x")


def extents(vox: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Size of every volume, from the greatest coordinate (one row per volume),
    computed once. Volumes listed in a data set table need no scan: see ``sizes_of``."""
    return measured(vox.groupBy(*keys).agg(*[(F.max(a) + 1).alias(f"n{a}") for a in AXES if a in vox.columns]))


def sizes_of(datasets: DataFrame) -> DataFrame:
    """Size of every volume from the data set table (dims in x, y, z order)."""
    return measured(datasets.select("dataset", *[F.col("dims")[i].alias(f"n{a}") for i, a in enumerate(("x", "y", "z"))]))


def crop(vox: DataFrame, low: dict[str, int], size: dict[str, int]) -> DataFrame:
    """Cut a region and move it to the origin. A negative size is measured
    backwards from ``low`` and flips that axis. Comparisons stay on the bare
    columns so that they reach the file scan."""
    out = vox
    for a, n in size.items():
        start = low.get(a, 0)
        if n >= 0:
            out = out.where((F.col(a) >= start) & (F.col(a) < start + n))
        else:
            out = out.where((F.col(a) <= start) & (F.col(a) > start + n))
    moved = {a: (F.col(a) - low.get(a, 0)) if n >= 0 else (F.lit(low.get(a, 0)) - F.col(a)) for a, n in size.items()}
    return out.withColumns(moved)


def permute(vox: DataFrame, order: dict[str, str]) -> DataFrame:
    """``{"y": "z", "z": "y"}`` reads the new y from the old z and so on."""
    return vox.withColumns({new: F.col(old) for new, old in order.items()})


def invert_axis(vox: DataFrame, axis: str) -> DataFrame:
    return vox.withColumn(axis, -F.col(axis))


def translate(vox: DataFrame, shift: dict[str, int]) -> DataFrame:
    return vox.withColumns({a: F.col(a) + F.lit(s) for a, s in shift.items()})


def rotate90(vox: DataFrame, from_axis: str, to_axis: str) -> DataFrame:
    """Quarter turn that carries ``from_axis`` onto ``to_axis``."""
    return vox.withColumns({to_axis: F.col(from_axis), from_axis: -F.col(to_axis)})


def zero_min(vox: DataFrame, keys: list[str] = KEY) -> DataFrame:
    low = vox.groupBy(*keys).agg(*[F.min(a).alias(f"low_{a}") for a in AXES])
    return vox.join(small(low), keys).select(*keys, *[(F.col(a) - F.col(f"low_{a}")).alias(a) for a in AXES], "v")


def hyperslice(vox: DataFrame, axis: str, at: int) -> DataFrame:
    return vox.where(F.col(axis) == at).drop(axis)


def add_axis(plane: DataFrame, axis: str, at: int) -> DataFrame:
    return plane.withColumn(axis, F.lit(at).cast("long"))


def stack(planes: list[DataFrame], axis: str = "z") -> DataFrame:
    out = add_axis(planes[0], axis, 0)
    for i, p in enumerate(planes[1:], 1):
        out = out.unionByName(add_axis(p, axis, i))
    return out


def subsample(vox: DataFrame, step: dict[str, int]) -> DataFrame:
    out = vox
    for a, s in step.items():
        if s > 1:
            out = out.where(F.col(a) % s == 0).withColumn(a, F.expr(f"{a} div {s}"))
    return out


def _candidates(at: Column, n: Column, halo: int, mode: str) -> Column:
    """All positions in [-halo, n + halo) that read their value from ``at``."""
    if mode == "border":
        low = F.when(at == 0, F.sequence(F.lit(-halo), F.lit(-1)))
        high = F.when(at == n - 1, F.sequence(n, n + halo - 1))
        none = F.array().cast("array<long>")
        return F.concat(F.array(at), F.coalesce(low.cast("array<long>"), none), F.coalesce(high, none))
    period, mirror = (2 * n - 2, -at) if mode == "mirror_single" else (2 * n, -at - 1)
    safe = F.greatest(period, F.lit(1))
    turns = F.sequence(-F.ceil(F.lit(halo) / safe) - 1, F.ceil(F.lit(halo) / safe) + 1)
    images = F.array_distinct(F.flatten(F.transform(turns, lambda t: F.array(at + t * safe, mirror + t * safe))))
    kept = F.filter(images, lambda p: (p >= -halo) & (p < n + halo))
    return F.when(n == 1, F.sequence(F.lit(-halo).cast("long"), F.lit(halo).cast("long"))).otherwise(kept)


def pad(vox: DataFrame, halo: dict[str, int], mode: str, sizes: DataFrame | None = None, keys: list[str] = KEY,
        value: float = 0) -> DataFrame:
    """Extend volumes by ``halo`` voxels per axis end: ``constant``, ``zero``,
    ``border``, ``mirror_single`` or ``mirror_double``. Only voxels close to a
    face are copied; nothing is shuffled but the one-row-per-volume sizes."""
    sizes = extents(vox, keys) if sizes is None else sizes
    out = vox.join(small(sizes), keys)
    if mode in ("constant", "zero"):
        fill = F.lit(0 if mode == "zero" else value)
        frame = sizes
        for a in AXES:
            if a in vox.columns:
                h = halo.get(a, 0)
                frame = frame.withColumn(a, F.explode(F.sequence(F.lit(-h).cast("long"), F.col(f"n{a}") + h - 1)))
        inside = F.lit(True)
        for a in AXES:
            if a in vox.columns:
                inside = inside & F.col(a).between(F.lit(0), F.col(f"n{a}") - 1)
        axes = [a for a in AXES if a in vox.columns]
        rim = frame.where(~inside).select(*keys, *axes, fill.alias("v"))
        return vox.select(*keys, *axes, "v").unionByName(rim)
    for a, h in halo.items():
        if h > 0:
            out = out.withColumn(a, F.explode(_candidates(F.col(a), F.col(f"n{a}"), h, mode)))
    return out.drop(*[f"n{a}" for a in AXES])


def heightfield_mask(vox: DataFrame, field: DataFrame, low: str = "hmin", high: str = "hmax") -> DataFrame:
    """1 where the layer lies between the two surfaces."""
    return vox.join(field, KEY + ["y", "x"]).select(
        *POS, F.when(F.col("z").between(F.col(low), F.col(high)), 1).otherwise(0).alias("v"))


def surface_mask(vox: DataFrame, field: DataFrame, height: str = "hmin") -> DataFrame:
    """255 where the surface lies above the layer, as u8 mask."""
    return vox.join(field, KEY + ["y", "x"]).select(
        *POS, F.when(F.col(height) > F.col("z"), 255).otherwise(0).alias("v"))


def mask_out(vox: DataFrame, mask: DataFrame, value: float = float("nan")) -> DataFrame:
    """Set masked voxels (mask 0) to a value, NaN by default."""
    joined = vox.join(mask.select(*POS, F.col("v").alias("m")), POS, "left")
    return joined.select(*POS, F.when(F.coalesce("m", F.lit(0)) == 0, F.lit(float(value)))
                         .otherwise(F.col("v").cast("double")).alias("v"))


def combine(a: DataFrame, b: DataFrame, op: str, keys: list[str] = POS) -> DataFrame:
    """Pointwise multiply, max or min of two volumes."""
    left, right = F.col("v"), F.col("w")
    value = {"multiply": left * right, "max": F.greatest(left, right), "min": F.least(left, right)}[op]
    return a.join(b.withColumnRenamed("v", "w"), keys).select(*keys, value.alias("v"))


def generate(sizes: DataFrame, value: Column, keys: list[str] = KEY) -> DataFrame:
    """A volume whose value is a function of position; ``sizes`` has nz, ny, nx."""
    out = sizes
    for a in AXES:
        out = out.withColumn(a, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n{a}").cast("long") - 1)))
    return out.select(*keys, *AXES, value.alias("v"))


def exclude(df: DataFrame, **lists) -> DataFrame:
    """Drop rows whose column value is on an exclusion list."""
    for column, values in lists.items():
        if values:
            df = df.where(~F.col(column).isin(list(values)))
    return df
