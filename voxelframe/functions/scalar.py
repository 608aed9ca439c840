"""Column expressions on pixel values, names and small parsed strings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxelframe.schema import clamp


def half_up(value: Column) -> Column:
    """Round half towards plus infinity (not away from zero)."""
    return F.floor(value + F.lit(0.5))


def to_pixel(value: Column, dtype: str = "u8") -> Column:
    """Round and clamp a real value to a pixel type."""
    return clamp(half_up(value), dtype).cast("long")


def rescale(value: Column, low: float, high: float) -> Column:
    """Map [low, high] onto [0, 255] linearly."""
    return (value - F.lit(float(low))) * F.lit(255.0) / F.lit(float(high) - float(low))


def invert(value: Column, keep_zero: bool = False) -> Column:
    flipped = F.lit(255) - value
    return F.when(value == 0, F.lit(0)).otherwise(flipped) if keep_zero else flipped


def stretch_cost(value: Column, factor: float = 4.0) -> Column:
    """Contrast stretch of a cost value around 255, clamped to u8."""
    return to_pixel(F.lit(255.0) - (F.lit(255.0) - value) * F.lit(factor))


def outside_content(value: Column, dtype: str = "u8") -> Column:
    """True where a pixel is too dark or too bright to be tissue."""
    low, high = {"u8": (20, 200), "u16": (5000, 60000)}[dtype]
    return (value < low) | (value > high)


def hash_unit(seed: int, *columns: Column) -> Column:
    """A repeatable uniform number in [0, 1) that depends on coordinates only."""
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def value_to_noise(value: Column, target: float, low: float, high: float, seed: int, *position: Column) -> Column:
    """Replace one value (or NaN) by uniform noise in [low, high)."""
    hit = F.isnan(value.cast("double")) if math.isnan(target) else value == F.lit(target)
    noise = F.lit(float(low)) + hash_unit(seed, *position) * F.lit(float(high) - float(low))
    return F.when(hit, noise).otherwise(value.cast("double"))


def parse_numbers(text: Column, kind: str = "long") -> Column:
    """Parse "a,b,c"; null when any part is not a number of that kind."""
    if kind == "double":
        parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("double"))
    else:
        # an integer field holding "1.5" is an error, not 1
        whole = F.transform(F.split(text, ","), lambda p: F.when(F.trim(p).rlike(r"^[+-]?\d+$"), F.trim(p)))
        parts = F.transform(whole, lambda p: p.try_cast(kind))
    return F.when(~F.exists(parts, lambda p: p.isNull()), parts)


def parse_batch(text: Column) -> Column:
    """Parse a one-based "i:n" batch specification, failing outside 1..n."""
    shape = r"^(\d+):(\d+)$"
    batch = F.regexp_extract(text, shape, 1).try_cast("long")
    total = F.regexp_extract(text, shape, 2).try_cast("long")
    problem = (
        F.when(~text.rlike(shape), F.lit("batch must look like <batch>:<total>"))
        .when(total < 1, F.lit("total batch count must be greater than 0"))
        .when((batch < 1) | (batch > total), F.concat(F.lit("batch must be between 1 and "), total.cast("string")))
    )
    return F.struct(
        F.when(problem.isNotNull(), F.raise_error(problem).cast("long")).otherwise(batch).alias("batch"),
        F.when(problem.isNotNull(), F.raise_error(problem).cast("long")).otherwise(total).alias("total"),
    )


def flatten_group(name: Column, separator: str = "/", replacement: str = ".") -> Column:
    """"/a/b" -> "a.b"."""
    return F.regexp_replace(F.regexp_replace(name, f"^{separator}", ""), separator, replacement)


def sanitize_dataset(name: Column) -> Column:
    """Trim blanks, then leading and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.trim(name), "^/+", ""), "/+$", "")


def parse_match_name(name: Column) -> Column:
    """Ids, channels and cameras of "matches_IDA_ChA_camA__IDB_ChB_camB"."""
    shape = r"^matches_(.{6})_(Ch.*?)_(cam.)__(.{6})_(Ch.*?)_(cam.).*$"
    fields = ["id_a", "channel_a", "cam_a", "id_b", "channel_b", "cam_b"]
    return F.struct(*[F.regexp_extract(name, shape, i + 1).alias(f) for i, f in enumerate(fields)])


def soft_limit(value: Column, limit: float, gamma: float) -> Column:
    """Identity below ``limit``; above it a power curve with slope one at the joint."""
    joint = gamma ** (-1.0 / (gamma - 1.0))
    curved = F.pow(value + F.lit(joint - limit), F.lit(gamma)) + F.lit(limit - joint ** gamma)
    return F.when(value < limit, value).otherwise(curved)


def distance_to_interval(value: Column, low, high) -> Column:
    low, high = [c if isinstance(c, Column) else F.lit(c) for c in (low, high)]
    return F.greatest(low - value, value - high, F.lit(0.0))


def fade(squared: Column) -> Column:
    return F.exp(squared / F.lit(-2.0))


def sigma_difference(source: float, target: float, scale: float) -> float:
    """Extra blur that takes ``source`` to ``target`` after dividing by ``scale``."""
    return math.sqrt(max(0.0, (target / scale) ** 2 - source ** 2))


def sigma_difference_expr(source: Column, target: Column, scale: Column) -> Column:
    ratio = target / scale
    return F.sqrt(F.greatest(F.lit(0.0), ratio * ratio - source * source))
