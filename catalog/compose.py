"""Queries over compositing."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import compose

VOX = "dataset:s z y x v"


@query("u1_additive_saturate", VOX, "SELECT dataset, z, y, x, least(255, sum(v)) AS v FROM (SELECT * FROM @em UNION ALL SELECT * FROM @em_b) GROUP BY ALL")
def _(f):
    return compose.additive([f.em, f.em_b], overflow="saturate")


@query("u1_additive_wrap", VOX, "SELECT dataset, z, y, x, sum(v) % 256 AS v FROM (SELECT * FROM @em UNION ALL SELECT * FROM @em_b) GROUP BY ALL")
def _(f):
    return compose.additive([f.em, f.em_b], overflow="wrap")


@query("u3_overlay", VOX, """WITH r AS (SELECT *, CASE WHEN x BETWEEN 5 AND 12 THEN 0 ELSE 2 END AS k FROM @em_b UNION ALL
SELECT *, CASE WHEN y BETWEEN 3 AND 15 THEN 1 ELSE 2 END AS k FROM @em)
SELECT dataset, z, y, x, CASE WHEN min(k) = 2 THEN 0 ELSE arg_min(v, k) END AS v FROM r GROUP BY ALL""")
def _(f):
    return compose.overlay(f.em_b, f.em, F.col("x").between(5, 12), F.col("y").between(3, 15))


@query("u4_merge_costs", VOX, "SELECT dataset, z, y, x, least(a.v, b.v) AS v FROM @cost_plane a JOIN @em b USING (dataset, z, y, x)")
def _(f):
    return compose.merge_costs([f.cost_plane, f.em])


@query("u5_union_matches", "a b n", "SELECT a, b, 2 * count(*) AS n FROM @matches GROUP BY a, b")
def _(f):
    return compose.union_matches([f.matches, f.matches]).groupBy("a", "b").agg(F.count("*").alias("n"))
