"""Queries over features, dense matching and registration jobs."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.stencils import gauss_sql
from voxelframe.operators import features, matching, pixel, points
from voxelframe.plans import registration

S1, S2 = 1.2, 1.2 * 2 ** 0.25


def three(name: str, sigma: float) -> str:
    return (f"{name}z AS ({gauss_sql('@em', 'z', '(SELECT max(z) + 1 FROM @em)', sigma)}), {name}y AS ({gauss_sql(name + 'z', 'y', '20', sigma)}), "
            f"{name} AS ({gauss_sql(name + 'y', 'x', '25', sigma)})")


DOG = f"""WITH {three('f', S1)}, {three('g', S2)}, d AS (SELECT dataset, z, y, x, f.v - g.v AS d FROM f JOIN g USING (dataset, z, y, x)),
m1 AS (SELECT *, max(d) OVER (PARTITION BY dataset, y, x ORDER BY z ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m, coalesce(lag(d) OVER (PARTITION BY dataset, z, y ORDER BY x), d) AS l, coalesce(lead(d) OVER (PARTITION BY dataset, z, y ORDER BY x), d) AS r FROM d),
m2 AS (SELECT * REPLACE (max(m) OVER (PARTITION BY dataset, z, x ORDER BY y ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m) FROM m1),
m3 AS (SELECT * REPLACE (max(m) OVER (PARTITION BY dataset, z, y ORDER BY x ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS m) FROM m2)"""


@query("m1_detect_dog", "dataset:s z y x px:f intensity:f", DOG + """ SELECT dataset, z, y, x, x + greatest(-0.5, least(0.5, CASE WHEN l - 2 * d + r = 0 THEN 0 ELSE (l - r) * 0.5 / (l - 2 * d + r) END)) AS px, d AS intensity FROM m3 WHERE d = m AND d > 0.5""")
def _(f):
    return features.detect_dog(f.em, S1, 0.5, pixel.extents(f.em))


@query("m19_fan_out_detection", "dataset:s n last", DOG + " SELECT dataset, count(*) AS n, count(*) - 1 AS last FROM m3 WHERE d = m AND d > 0.5 GROUP BY dataset")
def _(f):
    found = features.detect_dog(f.em, S1, 0.5, pixel.extents(f.em))
    numbered = points.renumber(found.withColumn("pid", F.xxhash64("z", "y", "x")), ["dataset"], ["z", "y", "x"])
    return numbered.groupBy("dataset").agg(F.count("*").alias("n"), F.max("id").alias("last"))


@query("m1_detect_dog_masked", "dataset:s z y x", DOG + " SELECT dataset, z, y, x FROM m3 JOIN (SELECT dataset, z, y, x, v FROM @mask) k USING (dataset, z, y, x) WHERE d = m AND d > 0.5 AND k.v <> 0")
def _(f):
    return features.detect_dog(f.em, S1, 0.5, pixel.extents(f.em), mask=f.mask)


@query("m3_describe", "dataset:s z fid n norm:f smallest:f")
def _(f):
    found = features.extract_features(f.em, pixel.extents(f.em), radius=5, cells=2)
    norm = F.sqrt(F.aggregate("desc", F.lit(0.0), lambda a, x: a + x * x))
    return found.select("dataset", "z", "fid", F.size("desc").alias("n"), norm.alias("norm"), F.array_min("desc").alias("smallest"))


@query("m14_phase_shift", "dataset:s z by_ bx_ sx:f sy:f", """WITH p AS (SELECT a.dataset, a.z, a.y, a.x FROM @em a JOIN @em_b b USING (dataset, z, y, x)),
k AS (SELECT dataset, z, y // 6 + o AS by_, x // 8 + q AS bx_, max(y) - min(y) + 1 AS h, max(x) - min(x) + 1 AS w FROM p, (VALUES (0), (-1)) AS u(o), (VALUES (0), (-1)) AS w(q) GROUP BY ALL)
SELECT dataset, z, by_, bx_, 2 AS sx, 0 AS sy FROM k WHERE by_ >= 0 AND bx_ >= 0 AND h >= 4 AND w - 2 >= 4""")
def _(f):
    found = features.phase_shift(f.em, f.em_b, {"y": 12, "x": 16})
    return found.select("dataset", "z", F.col("by").alias("by_"), F.col("bx").alias("bx_"), (F.col("qx") - F.col("px")).alias("sx"), (F.col("qy") - F.col("py")).alias("sy"))


@query("m14_phase_consensus", "dataset:s tx:f ty:f", "SELECT DISTINCT dataset, 2 AS tx, 0 AS ty FROM @em")
def _(f):
    found = features.phase_shift(f.em, f.em_b, {"y": 12, "x": 16}).withColumn("mid", F.xxhash64("z", "by", "bx"))
    kept = matching.ransac(found, ["dataset"], "translation", epsilon=1.5, min_inliers=5)
    return matching.fit_model(kept, ["dataset"], "translation").select("dataset", F.col("m")[2].alias("tx"), F.col("m")[5].alias("ty"))


@query("m15_block_votes", "dataset:s z y x sx sy w:f", """SELECT a.dataset, a.z, a.y, a.x, CASE WHEN a.y BETWEEN 3 AND 16 AND a.x BETWEEN 3 AND 21 THEN 2 ELSE 0 END AS sx, 0 AS sy, 1 AS w
FROM @em a JOIN @em_b b USING (dataset, z, y, x)""")
def _(f):
    return features.block_votes(f.em, f.em_b, 3, features.flow_radii(25), pixel.extents(f.em), {"y": 20, "x": 13})


@query("m15_block_flow", "dataset:s z y x px:f py:f weight:f")
def _(f):
    return features.block_flow(f.em, f.em_b, 3, 1.5, pixel.extents(f.em), 25, rounds=2, block={"y": 20, "x": 25})


PAIRS = "SELECT z AS pair, concat(dataset, 'a', CAST(z AS STRING)) AS a, concat(dataset, 'b', CAST(z AS STRING)) AS b FROM @em GROUP BY dataset, z"


def faces(f):
    """Every layer of both volumes as a face of its own."""
    one = f.em.withColumn("dataset", F.concat("dataset", F.lit("a"), F.col("z").cast("string")))
    two = f.em_b.where("x < 25").withColumn("dataset", F.concat("dataset", F.lit("b"), F.col("z").cast("string")))
    rows = one.unionByName(two).withColumn("z", F.lit(0).cast("long"))
    pairs = f.em.select("dataset", "z").distinct().select(F.concat("dataset", F.col("z").cast("string")).alias("pair"),
        F.concat("dataset", F.lit("a"), F.col("z").cast("string")).alias("a"), F.concat("dataset", F.lit("b"), F.col("z").cast("string")).alias("b"))
    names = rows.select("dataset").distinct()
    sizes = names.selectExpr("dataset", "1L AS nz", "20L AS ny", "25L AS nx")
    bounds = names.selectExpr("dataset", "0.0D AS min_x", "24.0D AS max_x", "0.0D AS min_y", "19.0D AS max_y")
    identity = names.select("dataset", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(19).cast("long"))).alias("iy"))
    identity = identity.select("dataset", "iy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(24).cast("long"))).alias("ix"))
    identity = identity.withColumns({"tx": F.col("ix").cast("double"), "ty": F.col("iy").cast("double")})
    return rows, pairs, sizes, bounds, identity


FEATURES = {"sigma": 0.8, "threshold": 0.5, "radius": 5, "cells": 2, "noise": None}


@query("m8_align_cells", "dataset:s iy ix tx:f ty:f")
def _(f):
    rows, pairs, sizes, bounds, identity = faces(f)
    return registration.align_pass(rows, identity, pairs, bounds, sizes, 13, feature_options=FEATURES, kind="translation", regularizer=None,
                                   lam=0.0, min_inliers=4, epsilon=1.5)


@query("m9_align_cells_halfway", "dataset:s iy ix tx:f ty:f")
def _(f):
    rows, pairs, sizes, bounds, identity = faces(f)
    return registration.align_pass(rows, identity, pairs, bounds, sizes, 13, True, FEATURES, kind="translation", min_inliers=4, epsilon=1.5)


@query("m16_flow_pass", "dataset:s iy ix tx:f ty:f")
def _(f):
    rows, pairs, sizes, bounds, identity = faces(f)
    return registration.flow_pass(rows, identity, pairs, sizes, 25, 3, 1.5, rounds=1, block={"y": 20, "x": 25})


MOVED = "SELECT stack, pid, x + 3.0 AS x, y - 2.0 AS y, z + 1.0 AS z FROM @points"


def unit(f, sql=None):
    rows = f.points if sql is None else f.sql(sql)
    return rows.select("stack", "pid", *[F.col(c).cast("double").alias(c) for c in "xyz"])


@query("m11_match_blocks", "stack same:b tx:f ty:f tz:f", "SELECT DISTINCT stack, true AS same, 3 AS tx, -2 AS ty, 1 AS tz FROM @points")
def _(f):
    found = registration.match_blocks(unit(f), unit(f, MOVED), ["stack"], 10.0, epsilon=0.5, icp_distance=2.0, icp_epsilon=0.5)
    # points that share a position share their matches
    twin = (F.col("qx") == F.col("px") + 3) & (F.col("qy") == F.col("py") - 2) & (F.col("qz") == F.col("pz") + 1)
    return found.groupBy("stack").agg(F.bool_and(twin).alias("same"),
        F.avg(F.col("qx") - F.col("px")).alias("tx"), F.avg(F.col("qy") - F.col("py")).alias("ty"), F.avg(F.col("qz") - F.col("pz")).alias("tz"))


SLICES = "SELECT DISTINCT CAST(k % 2 AS BIGINT) AS stack, CAST(0 AS BIGINT) AS channel, CAST(floor(k / 500) AS BIGINT) AS z FROM @keys"
SHIFTED = """SELECT CAST(k % 2 AS BIGINT) AS stack, CAST(0 AS BIGINT) AS channel, CAST(floor(k / 500) AS BIGINT) AS a, CAST(floor(k / 500) AS BIGINT) + 1 AS b, CAST(x AS DOUBLE) AS px, CAST(y AS DOUBLE) AS py,
CAST(x - 0.5 AS DOUBLE) AS qx, CAST(y + 0.25 AS DOUBLE) AS qy, CAST(1 AS DOUBLE) AS w FROM @keys WHERE CAST(floor(k / 500) AS BIGINT) < (SELECT max(CAST(floor(k / 500) AS BIGINT)) FROM @keys)"""


@query("m18_align_channels", "stack channel z tx:f ty:f")
def _(f):
    return registration.align_channels(f.sql(SHIFTED), f.sql(SLICES))


@query("t19_unwarp_volume", "dataset:s z y x v:f")
def _(f):
    bottom = f.sql("SELECT dataset, iy, ix, tx + 1.5 AS tx, ty - 0.5 AS ty FROM @posfield")
    field = f.heightfield.select("dataset", "y", "x", F.col("hmin").alias("h"))
    return registration.unwarp_volume(f.em, pixel.extents(f.em), field, f.posfield, bottom, F.lit(0.75), (0.01, 0.02, 0.5), 1.0, 8.0, 6.0,
                                      [(5, 15), (5, 15), (2, 6)], [1.0, 0.5, 0.25], [4.0, 4.0, 2.0])


@query("aligned_slab_graph", "tile x:f y:f")
def _(f):
    from voxelframe.operators import solve
    kept = matching.ransac(f.matches, ["a", "b"], "affine", epsilon=1.0).withColumn("graph", F.lit(0).cast("long"))
    first = f.matches.agg(F.min("a").alias("tile")).withColumn("graph", F.lit(0).cast("long"))
    start = solve.pre_align(kept, ["graph"], first, "rigid")
    models = solve.relax_staged(kept, ["graph"], "affine", "rigid", [1.0, 0.1], fixed=first, start=start)
    return models.select("tile", F.col("m")[2].alias("x"), F.col("m")[5].alias("y"))
