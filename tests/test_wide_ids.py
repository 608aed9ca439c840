"""Tables whose keys lead the ids of the points beyond 64 bits."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# orders further on: the same places, as 400 divides it, and ids that a long can't hold
FURTHER = 54_000_000
IDS = {"pid", "fid", "a", "b"}
NAMES = ["w19_mean", "w19_median", "m12_icp", "m13_mls_warp", "m4_match_geometric", "j10_look_up_points"]


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("wide")
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_orderkey < 500").coalesce(1)
    rows.write.parquet(f"{root}/near/lineitem.parquet")
    rows.withColumn("l_orderkey", F.col("l_orderkey") + FURTHER).write.parquet(f"{root}/far/lineitem.parquet")
    return f"{root}/near", f"{root}/far"


@pytest.mark.parametrize("name", NAMES)
def test_points_of_far_keys_have_the_ids_of_the_formula(spark, folders, name):
    here, there = [entry.queries()[name](spark, folder) for folder in folders]
    assert here.columns == there.columns and all(kind != "decimal(38,0)" for _, kind in here.dtypes)

    def rows(df, shift):
        out = [{c: int(v) + (shift if v >= 0 else -shift) if c in IDS else v for c, v in r.asDict().items()} for r in df.collect()]
        return sorted(tuple(r.values()) for r in out)

    found = rows(there, 0)
    assert found and found == rows(here, FURTHER * 10 ** 12)
