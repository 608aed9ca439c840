"""Queries over cost volumes and surfaces."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.stencils import gauss_sql
from voxelframe.operators import cost, pixel, stats, surface, transforms

VOX = "dataset:s z y x v"
RVOX = "dataset:s z y x v:f"
D1 = """WITH o AS (SELECT dataset, 70 AS oob, max(z) + 1 AS nz FROM @em GROUP BY dataset), m2 AS (SELECT dataset, y, x, min(v) AS m FROM @mask GROUP BY ALL),
d AS (SELECT e.dataset, e.z, e.y, e.x, oob, nz, m, 255 - greatest(0, coalesce(lead(e.v) OVER (PARTITION BY e.dataset, e.y, e.x ORDER BY e.z), oob) - e.v) AS fall FROM @em e JOIN o USING (dataset) JOIN m2 USING (dataset, y, x))"""
C1 = D1 + """, c AS (SELECT *, CASE WHEN m < 1 THEN CASE WHEN z = 0 OR z = nz - 1 THEN 255 - oob ELSE 255 END WHEN z = 0 THEN 255 - oob ELSE fall END AS c FROM d)"""


def outside(f):
    return f.em.select("dataset").distinct().withColumn("median", F.lit(70).cast("long"))


@query("c1_derivative_cost", VOX, C1 + " SELECT dataset, z, y, x, greatest(0, least(255, 255 - (255 - c) * 4)) AS v FROM c")
def _(f):
    return cost.derivative_cost(f.em, outside(f), pixel.extents(f.em), f.mask)


MED = """WITH o AS (SELECT dataset, 70 AS oob FROM @em GROUP BY dataset), b AS (SELECT e.*, oob, list_sort([coalesce(lag(v) OVER w, oob), v, coalesce(lead(v) OVER w, oob)])[2] AS md FROM @em e JOIN o USING (dataset) WINDOW w AS (PARTITION BY e.dataset, e.y, e.x ORDER BY e.z)),
s AS (SELECT dataset, z, y, x, 255.0::DOUBLE - (255 - CASE WHEN z = 0 THEN 255 - oob ELSE 255 - greatest(0, coalesce(lead(md) OVER (PARTITION BY dataset, y, x ORDER BY z), oob) - md) END) * 4 AS v FROM b)"""
K = [1.0, 0.6065306597126334, 0.1353352832366127, 0.011108996538242306]


@query("c1_derivative_cost_filtered", VOX, MED + f""", g AS (SELECT a.dataset, a.z, a.y, a.x, sum(t.w * coalesce(b.v, 255)) / {K[0] + 2 * sum(K[1:])!r}::DOUBLE AS v FROM s a CROSS JOIN (VALUES {", ".join(f"({o}, {K[abs(o)]!r}::DOUBLE)" for o in range(-3, 4))}) AS t(o, w)
LEFT JOIN s b ON b.dataset = a.dataset AND b.y = a.y AND b.x = a.x AND b.z = a.z + t.o GROUP BY a.dataset, a.z, a.y, a.x)
SELECT dataset, z, y, x, greatest(0, least(255, floor(v + 0.5))) AS v FROM g""")
def _(f):
    return cost.derivative_cost(f.em, outside(f), pixel.extents(f.em), median=True, smooth=True)


def deep(f):
    """The fixture with its rows as depth."""
    return f.em


RESIN = {"band": 4, "threshold": 45.0, "kernel": 2, "slope_reach": 3, "min_gradient": 20.0}


@query("c2_resin_cost", RVOX)
def _(f):
    return cost.resin_cost(f.em, **RESIN)


@query("c3_column_slope", "dataset:s z x slope:f", """WITH p AS (SELECT dataset, z, x, y, CASE WHEN v > 0 AND v < 255 THEN v ELSE 0 END AS v, max(x) OVER (PARTITION BY dataset, z) AS mx FROM @em),
r AS (SELECT c.dataset, c.z, c.x, n.v, trunc(n.y - 0.5 * (2 * 2 + 2.5 * 4)) AS d FROM (SELECT DISTINCT dataset, z, x FROM @em) c JOIN p n ON n.dataset = c.dataset AND n.z = c.z AND n.x BETWEEN c.x - 3 AND c.x + 3 AND n.x < n.mx AND n.y >= 2 AND n.y < 12),
m AS (SELECT *, row_number() OVER (PARTITION BY dataset, z, x ORDER BY v) - 1 AS k, count(*) OVER (PARTITION BY dataset, z, x) AS n FROM r),
q AS (SELECT dataset, z, x, max(v) FILTER (WHERE k = n // 2) AS med FROM m GROUP BY ALL)
SELECT dataset, z, x, greatest(-0.5, least(0.5, sum(d * (v - med)) / sum(d * d))) AS slope FROM r JOIN q USING (dataset, z, x) GROUP BY dataset, z, x""")
def _(f):
    packed = f.em.groupBy("dataset", "z", "x").agg(F.expr("transform(sort_array(collect_list(struct(y, v))), s -> s.v)").alias("a"))
    ready = packed.withColumn("start", F.lit(2).cast("long")).withColumn("end", F.lit(18).cast("long"))
    return cost.column_slopes(ready, ["dataset", "z"], "x", 4, 3, 2.5, -0.5, 0.5)


@query("c4_cost_volume", VOX)
def _(f):
    return cost.cost_volume(f.em, pixel.extents(f.em), "both", {"x": 2}, **{**RESIN, "slope_reach": None})


@query("c5_cost_pyramid", VOX, """WITH a AS (SELECT dataset, z // 2 AS z, y // 1 AS y, x // 3 AS x, CAST(floor(avg(v) + 0.5) AS BIGINT) AS v FROM @cost_plane GROUP BY ALL)
SELECT dataset, z, y // 4 AS y, x // 2 AS x, CAST(floor(avg(v) + 0.5) AS BIGINT) AS v FROM a GROUP BY dataset, z, y // 4, x // 2""")
def _(f):
    return cost.cost_pyramid(f.cost_plane, [{"z": 2, "x": 3}, {"y": 4, "x": 2}])[1]


PLANTED = "SELECT dataset, y, x, 3 + x // 8 AS h FROM @cost_plane GROUP BY dataset, y, x"


@query("c6_min_surface", "dataset:s y x h", PLANTED)
def _(f):
    return surface.min_surface(f.cost_plane, 2)


@query("c6_surface_pair", "dataset:s y x hmin hmax", """SELECT dataset, y, x, 1 + x // 12 AS hmin, 6 + x // 12 AS hmax FROM @em GROUP BY dataset, y, x""")
def _(f):
    two = f.sql("""SELECT dataset, z, y, x, CAST(least(250, least(40 * abs(z - 1 - CAST(floor(x / 12) AS BIGINT)), 5 + 40 * abs(z - 6 - CAST(floor(x / 12) AS BIGINT)))) AS BIGINT) AS v FROM @em""")
    return surface.surface_pair(two, 2, 2, 6)


@query("c7_refine_surface", "dataset:s y x h", PLANTED)
def _(f):
    coarse = f.sql("SELECT dataset, CAST(floor(y / 2) AS BIGINT) AS y, CAST(floor(x / 2) AS BIGINT) AS x, avg(CAST(1.25 + floor(x / 8) * 0.5 AS DOUBLE)) AS h FROM @cost_plane GROUP BY dataset, CAST(floor(y / 2) AS BIGINT), CAST(floor(x / 2) AS BIGINT)")
    return surface.refine_surface(f.cost_plane, coarse, {"x": 2, "y": 2, "z": 2}, 3, max_dz=2)


@query("c8_initial_surfaces", "dataset:s y x hmin hmax m", """SELECT dataset, y, x, 1 + x // 12 AS hmin, 6 + x // 12 AS hmax, 1 AS m FROM @em GROUP BY dataset, y, x""")
def _(f):
    two = f.sql("""SELECT dataset, z, y, x, CAST(least(250, least(5 + 40 * abs(z - 1 - CAST(floor(x / 12) AS BIGINT)), 40 * abs(z - 6 - CAST(floor(x / 12) AS BIGINT)))) AS BIGINT) AS v FROM @em""")
    return surface.initial_surfaces(two, 2, 2, 6)


FLAT = "SELECT dataset, 0 AS z, y, x, hmax AS v FROM @heightfield"


@query("c9_smooth_height_field", "dataset:s y x hmin:f hmax:f", f"""WITH s AS ({FLAT}), g1 AS ({gauss_sql('s', 'x', '25', 2.0)}), g2 AS ({gauss_sql('g1', 'y', '20', 2.0)})
SELECT dataset, y, x, hmin, v AS hmax FROM g2 JOIN @heightfield USING (dataset, y, x)""")
def _(f):
    return surface.smooth_height_field(f.heightfield, 2.0, pixel.extents(f.em))


BRUSH = "SELECT dataset, z AS seq, z + 4 AS y, z * 2 + 2 AS x, CAST(1.5 AS DOUBLE) AS sigma, CAST(CASE WHEN z % 2 = 0 THEN 1 ELSE -1 END AS DOUBLE) AS amount FROM @em GROUP BY dataset, z"
HIT = f"""WITH e AS ({BRUSH}), h AS (SELECT f.dataset, f.y, f.x, amount, exp(-((f.y - e.y) ** 2 + (f.x - e.x) ** 2) / (2 * 2.25::DOUBLE)) AS w FROM @heightfield f JOIN e ON e.dataset = f.dataset AND abs(f.y - e.y) <= 5 AND abs(f.x - e.x) <= 5)"""


@query("c10_push", "dataset:s y x h:f", HIT + """, s AS (SELECT dataset, y, x, sum(w * amount) AS m FROM h GROUP BY ALL)
SELECT dataset, y, x, hmin + coalesce(s.m, 0) * 0.5 AS h FROM @heightfield LEFT JOIN s USING (dataset, y, x)""")
def _(f):
    return surface.push(f.heightfield.withColumnRenamed("hmin", "h"), f.sql(BRUSH), 5.0)


@query("c10_smooth_under_brush", "dataset:s y x h:f", HIT + f""", s AS (SELECT dataset, y, x, max(w) AS m FROM h GROUP BY ALL), f0 AS ({FLAT}), g1 AS ({gauss_sql('f0', 'x', '25', 1.0)}), g2 AS ({gauss_sql('g1', 'y', '20', 1.0)})
SELECT dataset, y, x, hmax + coalesce(s.m, 0) * (v - hmax) AS h FROM @heightfield JOIN g2 USING (dataset, y, x) LEFT JOIN s USING (dataset, y, x)""")
def _(f):
    return surface.smooth_under(f.heightfield.withColumnRenamed("hmax", "h"), f.sql(BRUSH), 1.0, pixel.extents(f.em))


@query("c10_weighted_smooth_under_brush", "dataset:s y x h:f", HIT + f""", s AS (SELECT dataset, y, x, max(w) AS m FROM h GROUP BY ALL),
f0 AS (SELECT dataset, 0 AS z, y, x, hmax * greatest(0, least(1, 1 - abs(hmin - 0.75))) AS a, greatest(0, least(1, 1 - abs(hmin - 0.75))) AS b FROM @heightfield),
a1 AS ({gauss_sql('f0', 'x', '25', 1.0, 'a')}), a2 AS ({gauss_sql('a1', 'y', '20', 1.0, 'a')}), b1 AS ({gauss_sql('f0', 'x', '25', 1.0, 'b')}), b2 AS ({gauss_sql('b1', 'y', '20', 1.0, 'b')})
SELECT dataset, y, x, hmax + coalesce(s.m, 0) * (a2.a / b2.b - hmax) AS h FROM @heightfield JOIN a2 USING (dataset, y, x) JOIN b2 USING (dataset, y, x) LEFT JOIN s USING (dataset, y, x)""")
def _(f):
    gradient = f.heightfield.select("dataset", "y", "x", F.abs(F.col("hmin") - 0.75).alias("g"))
    return surface.smooth_under(f.heightfield.withColumnRenamed("hmax", "h"), f.sql(BRUSH), 1.0, pixel.extents(f.em), gradient)


@query("c11_height_mask_pyramid", VOX, """WITH m AS (SELECT dataset, z, y, x, CASE WHEN z BETWEEN hmin AND hmax THEN 1 ELSE 0 END AS v FROM @em JOIN @heightfield USING (dataset, y, x))
SELECT dataset, z // 2 AS z, y // 2 AS y, x // 2 AS x, floor(avg(v) + 0.5) AS v FROM m GROUP BY dataset, z // 2, y // 2, x // 2""")
def _(f):
    from voxelframe.plans.surface import height_mask_levels
    return height_mask_levels(f.em, f.heightfield, [{"z": 2, "y": 2, "x": 2}])[1]


@query("c12_distance_to_surface", RVOX, """SELECT e.dataset, e.z, e.y, e.x, 100.0::DOUBLE / (2.0::DOUBLE * abs(e.z - hmin) + 0.001::DOUBLE) AS v FROM @em e JOIN @heightfield f ON f.dataset = e.dataset AND f.y = e.y // 6 AND f.x = e.x // 6""")
def _(f):
    return cost.distance_to_surface(f.em, f.heightfield, 100.0, 2.0, height="hmin")


CONST = "SELECT dataset, z, y, x, CASE WHEN (x * 7 + y * 3) % 31 = 0 THEN 255 ELSE v END AS v FROM @cost_plane"


@query("c13_initialize_cost", RVOX, f"""WITH c AS ({CONST}), h AS (SELECT dataset, z, y, x, CASE WHEN max(v) OVER (PARTITION BY dataset, y, x) = min(v) OVER (PARTITION BY dataset, y, x) THEN NULL ELSE v END AS v FROM c),
n AS (SELECT a.dataset, a.z, a.y, a.x, sum(b.v * w) / sum(CASE WHEN b.v IS NULL THEN 0 ELSE w END) AS v FROM h a,
(VALUES (-1, -1, 0.5::DOUBLE), (-1, 0, 1.0), (-1, 1, 0.5), (0, -1, 1.0), (0, 1, 1.0), (1, -1, 0.5), (1, 0, 1.0), (1, 1, 0.5)) AS o(dy, dx, w), h b
WHERE a.v IS NULL AND b.dataset = a.dataset AND b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL)
SELECT dataset, z, y, x, v::DOUBLE AS v FROM h WHERE v IS NOT NULL UNION ALL SELECT * FROM n""")
def _(f):
    return cost.initialize_cost(f.sql(CONST))


@query("surface_to_flat_volume", "dataset:s low:b high:b n")
def _(f):
    from voxelframe.plans.surface import flatten_slabs
    flat = flatten_slabs(f.em, f.cost_plane, [{"z": 2, "y": 2, "x": 2}], 2, 2, 6, 1.0)
    return flat.groupBy("dataset").agg((F.min("z") == 0).alias("low"), (F.max("z") > 0).alias("high"), F.count("*").alias("n"))
