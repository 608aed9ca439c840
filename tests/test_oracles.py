"""Every query with an SQL counterpart must give the same rows at the smallest scale."""

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
# three layers are too few for the planted surfaces
DEEP = {name: "/root/testdata/sf0.01" for name in ("c6_min_surface", "c6_surface_pair", "c7_refine_surface", "c8_initial_surfaces")}


@pytest.fixture(scope="module")
def con():
    return {sf: check.database(sf) for sf in {SF, *DEEP.values()}}


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    sf = DEEP.get(name, SF)
    got = entry.queries()[name](spark, sf).toPandas()
    assert check.same(got, con[sf].execute(entry.oracle_sql()[name]).df()) == ""


def test_entry_has_rows_and_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["dataset", "z", "y", "x", "v"]
    assert df.count() == 1500
