"""Row types and value ranges shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY = ["dataset"]
VOXEL = ["z", "y", "x"]
POS = KEY + VOXEL

VOLUME = T.StructType([
    T.StructField("dataset", T.StringType(), False),
    T.StructField("z", T.LongType(), False),
    T.StructField("y", T.LongType(), False),
    T.StructField("x", T.LongType(), False),
    T.StructField("v", T.LongType(), False),
])

BLOCKS = T.StructType([
    T.StructField("dataset", T.StringType(), False),
    T.StructField("gz", T.LongType(), False),
    T.StructField("gy", T.LongType(), False),
    T.StructField("gx", T.LongType(), False),
    T.StructField("nz", T.LongType(), False),
    T.StructField("ny", T.LongType(), False),
    T.StructField("nx", T.LongType(), False),
    T.StructField("data", T.BinaryType(), False),
])

DATASETS = T.StructType([
    T.StructField("dataset", T.StringType(), False),
    T.StructField("dims", T.ArrayType(T.LongType()), False),
    T.StructField("block", T.ArrayType(T.LongType()), False),
    T.StructField("dtype", T.StringType(), False),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType()), True),
])

# Pixel type -> (numpy name, smallest, largest).
PIXEL_TYPES = {
    "u8": ("u1", 0, 255),
    "i8": ("i1", -128, 127),
    "u16": ("u2", 0, 65535),
    "i16": ("i2", -32768, 32767),
    "u32": ("u4", 0, 4294967295),
    "f32": ("f4", None, None),
    "f64": ("f8", None, None),
}


def volume_type(dtype: str) -> T.StructType:
    """Voxel rows of a pixel type: real types keep their fractions."""
    if PIXEL_TYPES[dtype][1] is not None:
        return VOLUME
    return T.StructType([*VOLUME.fields[:-1], T.StructField("v", T.DoubleType(), False)])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Fail at the API edge when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df


def clamp(value: Column, dtype: str) -> Column:
    """Limit a value (not null) to the range of an integer pixel type."""
    _, low, high = PIXEL_TYPES[dtype]
    if low is None:
        return value
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
