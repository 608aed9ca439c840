"""Queries over model fitting, consensus and global relaxation."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import matching, solve, stats

MODEL = "a b n m0:f m1:f m2:f m3:f m4:f m5:f"


def cells(df, keys=("a", "b")):
    return df.select(*keys, "n", *[F.col("m")[i].alias(f"m{i}") for i in range(6)])


CENTRED = """WITH s AS (SELECT a, b, count(*) AS n, avg(px) AS mpx, avg(py) AS mpy, avg(qx) AS mqx, avg(qy) AS mqy, covar_pop(px, px) AS xx, covar_pop(py, py) AS yy, covar_pop(px, py) AS xy,
covar_pop(qx, px) AS qxx, covar_pop(qx, py) AS qxy, covar_pop(qy, px) AS qyx, covar_pop(qy, py) AS qyy FROM @matches GROUP BY a, b)"""
AFFINE = CENTRED + """, l AS (SELECT *, (qxx * yy - qxy * xy) / (xx * yy - xy * xy) AS m0, (qxy * xx - qxx * xy) / (xx * yy - xy * xy) AS m1,
(qyx * yy - qyy * xy) / (xx * yy - xy * xy) AS m3, (qyy * xx - qyx * xy) / (xx * yy - xy * xy) AS m4 FROM s),
affine AS (SELECT a, b, n, m0, m1, mqx - m0 * mpx - m1 * mpy AS m2, m3, m4, mqy - m3 * mpx - m4 * mpy AS m5 FROM l)"""
RIGID = """, r0 AS (SELECT *, (qxx + qyy) / sqrt((qxx + qyy) ** 2 + (qyx - qxy) ** 2) AS c, (qyx - qxy) / sqrt((qxx + qyy) ** 2 + (qyx - qxy) ** 2) AS sn FROM s),
rigid AS (SELECT a, b, n, c AS m0, -sn AS m1, mqx - c * mpx + sn * mpy AS m2, sn AS m3, c AS m4, mqy - sn * mpx - c * mpy AS m5 FROM r0)"""


@query("m5_fit_affine", MODEL, AFFINE + " SELECT * FROM affine")
def _(f):
    return cells(matching.fit_model(f.matches, ["a", "b"], "affine"))


@query("m5_fit_rigid", MODEL, CENTRED + RIGID + " SELECT * FROM rigid")
def _(f):
    return cells(matching.fit_model(f.matches, ["a", "b"], "rigid"))


@query("m5_fit_translation", MODEL, "SELECT a, b, count(*) AS n, 1 AS m0, 0 AS m1, avg(qx - px) AS m2, 0 AS m3, 1 AS m4, avg(qy - py) AS m5 FROM @matches GROUP BY a, b")
def _(f):
    return cells(matching.fit_model(f.matches, ["a", "b"], "translation"))


@query("m5_fit_interpolated", MODEL, AFFINE + RIGID + " SELECT p.a, p.b, p.n, " + ", ".join(f"0.75::DOUBLE * p.m{i} + 0.25::DOUBLE * r.m{i} AS m{i}" for i in range(6)) +
       " FROM affine p JOIN rigid r USING (a, b)")
def _(f):
    return cells(matching.fit_model(f.matches, ["a", "b"], "affine", "rigid", 0.25))


THREE = """SELECT stack, pid, x AS px, y AS py, z AS pz, x * 1.5 + y * 0.25 + 2 + intensity % 2 AS qx, y - z * 0.5 - 1 AS qy, z * 2 + x * 0.125 + 4 AS qz, CAST(1 + pid % 2 AS DOUBLE) AS w FROM @points"""


@query("m5_fit_affine_3d", "stack n m0:f m1:f m2:f m4:f m5:f m6:f m7:f m8:f m9:f m10:f m11:f", f"""SELECT stack, count(*) AS n,
1.5 AS m0, 0.25 AS m1, 0 AS m2, 0 AS m4, 1 AS m5, -0.5 AS m6, -1 AS m7, 0.125 AS m8, 0 AS m9, 2 AS m10, 4 AS m11 FROM ({THREE}) GROUP BY stack""")
def _(f):
    rows = f.sql(THREE.replace(" + intensity % 2", ""))
    fit = matching.fit_model(rows, ["stack"], "affine", dim=3)
    return fit.select("stack", "n", *[F.round(F.col("m")[i], 5).alias(f"m{i}") for i in range(12)])


@query("m5_fit_translation_3d", "stack n m3:f m7:f m11:f", f"""SELECT stack, count(*) AS n, sum(w * (qx - px)) / sum(w) AS m3, sum(w * (qy - py)) / sum(w) AS m7, sum(w * (qz - pz)) / sum(w) AS m11
FROM ({THREE}) GROUP BY stack""")
def _(f):
    fit = matching.fit_model(f.sql(THREE), ["stack"], "translation", dim=3)
    return fit.select("stack", "n", *[F.col("m")[i].alias(f"m{i}") for i in (3, 7, 11)])


@query("x3_similarity_model", MODEL, CENTRED + """, k AS (SELECT *, (qxx + qyy) / (xx + yy) AS c, (qyx - qxy) / (xx + yy) AS sn FROM s)
SELECT a, b, n, c AS m0, -sn AS m1, mqx - c * mpx + sn * mpy AS m2, sn AS m3, c AS m4, mqy - sn * mpx - c * mpy AS m5 FROM k""")
def _(f):
    return cells(matching.fit_model(f.matches, ["a", "b"], "similarity"))


@query("x4_match_filters", "a n", "SELECT a, least(20, count(*)) AS n FROM @matches WHERE planted = 1 GROUP BY a")
def _(f):
    def consensus(rows):
        return matching.ransac(rows, ["a", "b"], "affine", epsilon=1.0)

    def thinned(rows):
        return stats.sample_per_group(rows, ["a", "b"], ["mid"], 20, 5)

    return f.matches.transform(consensus).transform(thinned).groupBy("a").agg(F.count("*").alias("n"))


@query("m6_ransac", "a b mid", "SELECT a, b, mid FROM @matches WHERE planted = 1")
def _(f):
    return matching.ransac(f.matches, ["a", "b"], "affine", epsilon=1.0, min_ratio=0.1, min_inliers=7)


@query("m6_ransac_rigid", "a n", "SELECT a, count(*) AS n FROM @matches WHERE planted = 1 GROUP BY a")
def _(f):
    found = matching.ransac(f.matches, ["a", "b"], "rigid", epsilon=3.0, min_inliers=7)
    return found.groupBy("a").agg(F.count("*").alias("n"))


@query("m7_multi_consensus", "a b mid consensus", "SELECT a, b, mid, 1 - planted AS consensus FROM @matches")
def _(f):
    return matching.multi_consensus(f.matches, ["a", "b"], kind="affine", epsilon=1.0, min_inliers=7)


@query("m17_fit_shear", "stack sx:f ox:f sy:f oy:f", """SELECT stack, regr_slope(tx, z) AS sx, regr_intercept(tx, z) AS ox, regr_slope(ty, z) AS sy, regr_intercept(ty, z) AS oy FROM @series_shift GROUP BY stack""")
def _(f):
    return matching.fit_shear(f.series_shift, ["stack"])


# ---- global relaxation -------------------------------------------------------------

ROUND = """t{n} AS (SELECT tile, CASE WHEN tile = 0 THEN x ELSE x * 0.5::DOUBLE + 0.5::DOUBLE * gx END AS x, CASE WHEN tile = 0 THEN y ELSE y * 0.5::DOUBLE + 0.5::DOUBLE * gy END AS y FROM
(SELECT c.tile, c.x, c.y, sum(e.sx + e.n * o.x) / sum(e.n) AS gx, sum(e.sy + e.n * o.y) / sum(e.n) AS gy FROM t{p} c JOIN e ON e.a = c.tile JOIN t{p} o ON o.tile = e.b GROUP BY c.tile, c.x, c.y))"""
RELAX = """WITH e0 AS (SELECT a, b, count(*) AS n, sum(qx - px) AS sx, sum(qy - py) AS sy FROM @matches GROUP BY a, b),
e AS (SELECT * FROM e0 UNION ALL SELECT b, a, n, -sx, -sy FROM e0), t0 AS (SELECT DISTINCT a AS tile, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y FROM e), """ + ", ".join(ROUND.format(n=i + 1, p=i) for i in range(3))


def fixed_tile(f):
    return f.sql("SELECT CAST(0 AS BIGINT) AS g, CAST(0 AS BIGINT) AS tile")


def keyed(f):
    return f.matches.withColumn("g", F.lit(0).cast("long"))


@query("i1_relax_translation", "tile x:f y:f", RELAX + " SELECT * FROM t3")
def _(f):
    out = solve.relax(keyed(f), ["g"], "translation", fixed=fixed_tile(f), rounds=3, patience=10)
    return out.select("tile", F.col("m")[2].alias("x"), F.col("m")[5].alias("y"))


# the y of the plane again as z, so that the third axis has the same answer
DEEP = "SELECT CAST(0 AS BIGINT) AS g, a, b, mid, px, py, py AS pz, qx, qy, qy AS qz, w FROM @matches"


@query("i1_relax_translation_3d", "tile x:f y:f z:f", RELAX + " SELECT tile, x, y, y AS z FROM t3")
def _(f):
    out = solve.relax(f.sql(DEEP), ["g"], "translation", fixed=fixed_tile(f), rounds=3, patience=10, dim=3)
    return out.select("tile", *[F.col("m")[i].alias(n) for i, n in ((3, "x"), (7, "y"), (11, "z"))])


@query("i1_pre_align", "tile x:f y:f z:f", """WITH steps AS (SELECT a, avg(px - qx) AS dx, avg(py - qy) AS dy FROM @matches GROUP BY a)
SELECT CAST(t AS BIGINT) AS tile, coalesce(sum(dx) FILTER (WHERE a < t), 0) AS x, coalesce(sum(dy) FILTER (WHERE a < t), 0) AS y, coalesce(sum(dy) FILTER (WHERE a < t), 0) AS z
FROM steps, (SELECT DISTINCT a AS t FROM @matches UNION SELECT DISTINCT b FROM @matches) GROUP BY t""")
def _(f):
    out = solve.pre_align(f.sql(DEEP), ["g"], fixed_tile(f), dim=3)
    return out.select("tile", *[F.col("m")[i].alias(n) for i, n in ((3, "x"), (7, "y"), (11, "z"))])


@query("i1_relax_staged_affine", "tile x:f y:f")
def _(f):
    out = solve.relax_staged(keyed(f), ["g"], "affine", "rigid", [1.0, 0.1], [6, 6], fixed=fixed_tile(f))
    return out.select("tile", F.col("m")[2].alias("x"), F.col("m")[5].alias("y"))


@query("i4_local_versus_global", "a b local_error:f global_error:f flagged:b", RELAX + """, l AS (SELECT a, b, avg(qx - px) AS sx, avg(qy - py) AS sy FROM @matches GROUP BY a, b)
SELECT m.a, m.b, avg(sqrt((px + sx - qx) ** 2 + (py + sy - qy) ** 2)) AS local_error, avg(sqrt((px + p.x - qx - q.x) ** 2 + (py + p.y - qy - q.y) ** 2)) AS global_error,
avg(sqrt((px + p.x - qx - q.x) ** 2 + (py + p.y - qy - q.y) ** 2)) > 6 AS flagged FROM @matches m JOIN l USING (a, b) JOIN t3 p ON p.tile = m.a JOIN t3 q ON q.tile = m.b GROUP BY m.a, m.b""")
def _(f):
    models = solve.relax(keyed(f), ["g"], "translation", fixed=fixed_tile(f), rounds=3, patience=10)
    return solve.local_versus_global(keyed(f), models, ["g"], "translation")


GAP_3D = "avg(sqrt((px + p.x - qx - q.x) ** 2 + 2 * (py + p.y - qy - q.y) ** 2))"


@query("i4_local_versus_global_3d", "a b local_error:f global_error:f flagged:b", RELAX + f""", l AS (SELECT a, b, avg(qx - px) AS sx, avg(qy - py) AS sy FROM @matches GROUP BY a, b)
SELECT m.a, m.b, avg(sqrt((px + sx - qx) ** 2 + 2 * (py + sy - qy) ** 2)) AS local_error, {GAP_3D} AS global_error, {GAP_3D} > 6 AS flagged
FROM @matches m JOIN l USING (a, b) JOIN t3 p ON p.tile = m.a JOIN t3 q ON q.tile = m.b GROUP BY m.a, m.b""")
def _(f):
    models = solve.relax(f.sql(DEEP), ["g"], "translation", fixed=fixed_tile(f), rounds=3, patience=10, dim=3)
    return solve.local_versus_global(f.sql(DEEP), models, ["g"], "translation", dim=3)
