import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    import check

    return check.session()


@pytest.fixture(scope="session")
def make(spark):
    """Volume rows from a numpy array (z, y, x)."""
    import numpy as np
    import pandas as pd

    def build(array, dataset="d", integer=True):
        z, y, x = [i.ravel() for i in np.indices(array.shape)]
        values = array.ravel()
        rows = pd.DataFrame({"dataset": dataset, "z": z, "y": y, "x": x,
                             "v": values.astype("int64") if integer else values.astype(float)})
        df = spark.createDataFrame(rows)
        if not integer:
            from pyspark.sql import functions as F
            df = df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
        return df

    return build


@pytest.fixture(scope="session")
def sizes_of(spark):
    def build(array, dataset="d"):
        nz, ny, nx = array.shape
        return spark.createDataFrame([(dataset, nz, ny, nx)], "dataset string, nz long, ny long, nx long")

    return build


@pytest.fixture(scope="session")
def cube():
    """Volume rows back to a numpy array."""
    import numpy as np

    def build(df, shape, column="v", fill=np.nan):
        rows = df.toPandas()
        out = np.full(shape, fill, dtype=float)
        out[rows.z, rows.y, rows.x] = rows[column]
        return out

    return build
