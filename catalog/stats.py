"""Queries over aggregations, limits and samples."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import matching, stats

CONTENT = "SELECT dataset, y, x, min(CASE WHEN v < 20 OR v > 200 THEN 0 ELSE 1 END) AS content FROM @em GROUP BY dataset, y, x"
STATS = f"""
WITH content AS ({CONTENT}),
ranked AS (SELECT e.dataset, e.z, e.v, row_number() OVER (PARTITION BY e.dataset, e.z ORDER BY e.v) - 1 AS r,
           count(*) OVER (PARTITION BY e.dataset, e.z) AS n FROM @em e JOIN content c USING (dataset, y, x) WHERE c.content = 1),
st AS (SELECT dataset, z, max(v) FILTER (WHERE r = n // 2) AS median,
       avg(v) FILTER (WHERE r >= floor(n * 0.03::DOUBLE + 0.5) AND r < n - floor(n * 0.03::DOUBLE + 0.5)) AS mean,
       stddev_pop(v) FILTER (WHERE r >= floor(n * 0.03::DOUBLE + 0.5) AND r < n - floor(n * 0.03::DOUBLE + 0.5)) AS std,
       min(v) FILTER (WHERE r >= floor(n * 0.03::DOUBLE + 0.5)) AS min,
       max(v) FILTER (WHERE r < n - floor(n * 0.03::DOUBLE + 0.5)) AS max
       FROM ranked GROUP BY dataset, z)"""
MODELS = STATS + """, d AS (SELECT dataset, z, 4 * std AS scale, mean AS shift FROM st),
t AS (SELECT dataset, scale AS ts, shift AS th FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY scale DESC, z) AS r FROM d) WHERE r = 1),
models AS (SELECT dataset, z, ts / scale AS a, th - shift * (ts / scale) AS b FROM d JOIN t USING (dataset))"""


@query("a1_content_mask", "dataset:s y x content", CONTENT)
def _(f):
    return stats.content_mask(f.em)


@query("a2_layer_stats", "dataset:s z median mean:f std:f min max", STATS + " SELECT * FROM st")
def _(f):
    return stats.layer_stats(f.em)


@query("a3_layer_models", "dataset:s z a:f b:f", MODELS + " SELECT * FROM models")
def _(f):
    return stats.layer_models(stats.layer_stats(f.em))


@query("a4_normalize_layers", "dataset:s z y x v", MODELS + """
SELECT dataset, z, y, x, CASE WHEN v > 0 THEN greatest(0, least(255, trunc(a * v + b))) ELSE 0 END AS v
FROM @em JOIN models USING (dataset, z)""")
def _(f):
    from voxelframe.plans.normalize import normalize_layers
    return normalize_layers(f.em)


@query("a4_normalize_layers_median_range", "dataset:s z y x v", STATS + """,
d AS (SELECT dataset, z, (max - min)::DOUBLE AS scale, median::DOUBLE AS shift FROM st),
t AS (SELECT dataset, scale AS ts, shift AS th FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY scale DESC, z) AS r FROM d) WHERE r = 1),
models AS (SELECT dataset, z, ts / scale AS a, th - shift * (ts / scale) AS b FROM d JOIN t USING (dataset))
SELECT dataset, z, y, x, CASE WHEN v > 0 THEN greatest(0, least(255, trunc(a * v + b))) ELSE 0 END AS v
FROM @em JOIN models USING (dataset, z)""")
def _(f):
    from voxelframe.plans.normalize import normalize_layers
    return normalize_layers(f.em, scale="full_range", shift="median")


@query("a5_flatten_mask", "dataset:s y x low high",
       "SELECT dataset, y, x, min(v) AS low, max(v) AS high FROM @mask GROUP BY dataset, y, x")
def _(f):
    low = stats.flatten_mask(f.mask, "min").withColumnRenamed("m", "low")
    return low.join(stats.flatten_mask(f.mask, "max").withColumnRenamed("m", "high"), ["dataset", "y", "x"])


@query("a6_apply_mask", "dataset:s z y x v", """
WITH flat AS (SELECT dataset, y, x, min(v) AS m FROM @mask GROUP BY dataset, y, x)
SELECT dataset, z, y, x, CASE WHEN m = 0 THEN 0 ELSE v END AS v FROM @em JOIN flat USING (dataset, y, x)""")
def _(f):
    return stats.apply_mask(f.em, stats.flatten_mask(f.mask))


@query("a7_cost_mask", "dataset:s y x m",
       "SELECT dataset, y, x, CASE WHEN min(v) <> max(v) THEN 1 ELSE 0 END AS m FROM @em GROUP BY dataset, y, x")
def _(f):
    return stats.cost_mask(f.em)


@query("a8_full_column_mask", "dataset:s y x m",
       "SELECT dataset, y, x, CASE WHEN min(v) >= 1 THEN 1 ELSE 0 END AS m FROM @mask GROUP BY dataset, y, x")
def _(f):
    return stats.full_column_mask(f.mask)


@query("a9_weighted_mean", "dataset:s weighted_sum:f weight:f mean:f", """
SELECT dataset, sum(hmax * m) AS weighted_sum, sum(m) AS weight, sum(hmax * m) / sum(m) AS mean FROM @heightfield GROUP BY dataset""")
def _(f):
    return stats.weighted_mean(f.heightfield, ["dataset"], "hmax")


@query("a10_min_max", "dataset:s z min max", "SELECT dataset, z, min(v) AS min, max(v) AS max FROM @em GROUP BY dataset, z")
def _(f):
    return stats.min_max(f.em, ["dataset", "z"])


MEDIAN = """WITH r AS (SELECT dataset, z, v, row_number() OVER (PARTITION BY dataset, z ORDER BY v) - 1 AS r,
count(*) OVER (PARTITION BY dataset, z) AS n FROM @em WHERE v <> 0),
med AS (SELECT dataset, z, (max(v) FILTER (WHERE r = (n - 1) // 2) + max(v) FILTER (WHERE r = n // 2)) // 2 AS median FROM r GROUP BY dataset, z)"""


@query("a11_median_nonzero", "dataset:s z median", MEDIAN + " SELECT * FROM med")
def _(f):
    return stats.median_nonzero(f.em, ["dataset", "z"])


@query("a12_out_of_bounds_value", "dataset:s median", MEDIAN + """
SELECT dataset, median FROM med JOIN (SELECT dataset, max(z) AS z FROM @em GROUP BY dataset) USING (dataset, z)""")
def _(f):
    return stats.out_of_bounds_value(f.em)


@query("a13_mean_value", "dataset:s mean:f", "SELECT dataset, avg(hmin) AS mean FROM @heightfield GROUP BY dataset")
def _(f):
    return stats.mean_value(f.heightfield, ["dataset"], "hmin")


@query("a13_approximate_mean", "dataset:s mean:f")
def _(f):
    return stats.approximate_mean(f.em, ["dataset"], ["z", "y", "x"], 0.2, 7)


@query("a14_squared_error", "dataset:s score", """
SELECT dataset, sum((e.v - b.v) * (e.v - b.v)) AS score FROM @em e JOIN @em_b b USING (dataset, z, y, x) GROUP BY dataset""")
def _(f):
    return stats.squared_error(f.em, f.em_b)


SHEAR = """WITH fits AS (SELECT stack, stack % 2 AS channel, regr_slope(tx, z) AS sx, regr_slope(ty, z) AS sy FROM @series_shift GROUP BY stack)"""


@query("a15_mean_shear", "channel sx:f sy:f stacks",
       SHEAR + " SELECT channel, avg(sx) AS sx, avg(sy) AS sy, count(*) AS stacks FROM fits GROUP BY channel")
def _(f):
    fits = matching.fit_shear(f.series_shift, ["stack"]).withColumn("channel", F.col("stack") % 2)
    return stats.mean_shear(fits, ["channel"])


@query("a24_compare_alignments", "channel z rx:f ry:f", SHEAR + """,
mean AS (SELECT channel, avg(sx) AS sx, avg(sy) AS sy FROM fits GROUP BY channel)
SELECT channel, z, avg(tx - z * sx) AS rx, avg(ty - z * sy) AS ry FROM (SELECT *, stack % 2 AS channel FROM @series_shift) JOIN mean USING (channel)
GROUP BY channel, z""")
def _(f):
    shifts = f.series_shift.withColumn("channel", F.col("stack") % 2)
    return stats.compare_alignments(shifts, matching.fit_shear(shifts, ["channel", "stack"]))


@query("a16_tile_match_counts", "tile n", """
WITH e AS (SELECT a AS tile FROM @matches UNION ALL SELECT b FROM @matches), t AS (SELECT DISTINCT a AS tile FROM @matches UNION SELECT -1)
SELECT t.tile, count(e.tile) AS n FROM t LEFT JOIN e ON t.tile = e.tile GROUP BY t.tile""")
def _(f):
    tiles = f.sql("SELECT DISTINCT a AS tile FROM @matches UNION SELECT -1")
    return stats.tile_match_counts(f.matches, tiles)


@query("a16_connected_total", "unconnected fewest most total", """
WITH e AS (SELECT a AS tile FROM @matches UNION ALL SELECT b FROM @matches), t AS (SELECT DISTINCT a AS tile FROM @matches UNION SELECT -1),
c AS (SELECT t.tile, count(e.tile) AS n FROM t LEFT JOIN e ON t.tile = e.tile GROUP BY t.tile)
SELECT count(*) FILTER (WHERE n = 0) AS unconnected, min(n) AS fewest, max(n) AS most, sum(n) AS total FROM c""")
def _(f):
    tiles = f.sql("SELECT DISTINCT a AS tile FROM @matches UNION SELECT -1")
    n = F.col("n")
    return stats.tile_match_counts(f.matches, tiles).agg(
        F.count_if(n == 0).alias("unconnected"), F.min(n).alias("fewest"), F.max(n).alias("most"), F.sum(n).alias("total"))


BOX = "WITH box AS (SELECT stack, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z FROM @points GROUP BY stack)"
BOXCOLS = "min_x:f max_x:f min_y:f max_y:f min_z:f max_z:f"


@query("a17_bounding_box", "stack " + BOXCOLS, BOX + " SELECT * FROM box")
def _(f):
    return stats.bounding_box(f.points, ["stack"], ["x", "y", "z"])


@query("a17_box_union", BOXCOLS, BOX + """ SELECT min(min_x) AS min_x, max(max_x) AS max_x, min(min_y) AS min_y, max(max_y) AS max_y,
min(min_z) AS min_z, max(max_z) AS max_z FROM box""")
def _(f):
    return stats.combine_boxes(stats.bounding_box(f.points, ["stack"], ["x", "y", "z"]), [], ["x", "y", "z"])


@query("a17_box_intersection", "min_x max_x min_y max_y", """SELECT max(ox) AS min_x, min(ox + sx) AS max_x, max(oy) AS min_y, min(oy + sy) AS max_y
FROM @tiles""")
def _(f):
    boxes = f.sql("SELECT tile, ox AS min_x, ox + sx AS max_x, oy AS min_y, oy + sy AS max_y FROM @tiles")
    return stats.combine_boxes(boxes, [], ["x", "y"], "intersect")


SLICE_MODELS = "SELECT stack, z, 1.0::DOUBLE AS a, 0.125::DOUBLE AS b, tx, -0.25::DOUBLE AS c, 1.0::DOUBLE AS d, ty FROM @series_shift"
CORNERS = f"""WITH m AS ({SLICE_MODELS}),
c AS (SELECT m.*, cx, cy FROM m, (VALUES (0, 0), (24, 0), (0, 19), (24, 19)) AS t(cx, cy)),
s AS (SELECT stack, z, min(a * cx + b * cy + tx) AS min_x, max(a * cx + b * cy + tx) AS max_x, min(c * cx + d * cy + ty) AS min_y, max(c * cx + d * cy + ty) AS max_y FROM c GROUP BY stack, z)"""


def slice_models(f):
    return f.series_shift.select("stack", "z", F.array(F.lit(1.0), F.lit(0.125), "tx", F.lit(-0.25), F.lit(1.0), "ty").alias("m"))


@query("a22_stack_bounds_union", "stack min_x:f max_x:f min_y:f max_y:f", CORNERS + """
SELECT stack, min(min_x) AS min_x, max(max_x) AS max_x, min(min_y) AS min_y, max(max_y) AS max_y FROM s GROUP BY stack""")
def _(f):
    return stats.stack_bounds(slice_models(f), ["stack"], F.lit(25.0), F.lit(20.0))


@query("a22_stack_bounds_intersection", "stack min_x:f max_x:f min_y:f max_y:f", CORNERS + """
SELECT stack, max(min_x) AS min_x, min(max_x) AS max_x, max(min_y) AS min_y, min(max_y) AS max_y FROM s GROUP BY stack""")
def _(f):
    return stats.stack_bounds(slice_models(f), ["stack"], F.lit(25.0), F.lit(20.0), largest=False)


@query("a18_transformed_bounds", "min_x:f max_x:f min_y:f max_y:f", f"""WITH m AS ({SLICE_MODELS}),
c AS (SELECT m.*, cx - tx AS ux, cy - ty AS uy, a * d - b * c AS det FROM m, (VALUES (0, 0), (24, 0), (0, 19), (24, 19)) AS t(cx, cy))
SELECT min((d * ux - b * uy) / det) AS min_x, max((d * ux - b * uy) / det) AS max_x,
min((a * uy - c * ux) / det) AS min_y, max((a * uy - c * ux) / det) AS max_y FROM c""")
def _(f):
    return stats.transformed_bounds(slice_models(f), F.lit(25.0), F.lit(20.0))


@query("a19_pair_report", "a b n shift_error:f affine_error:f affine_max:f", """
WITH t AS (SELECT a, b, avg(qx - px) AS sx, avg(qy - py) AS sy FROM @matches GROUP BY a, b),
r AS (SELECT a, b, sqrt((px + sx - qx) ** 2 + (py + sy - qy) ** 2) AS r1,
sqrt((px * 1.01::DOUBLE - py * 0.02::DOUBLE + 3 - qx) ** 2 + (px * 0.02::DOUBLE + py * 1.01::DOUBLE - 1 - qy) ** 2) AS r2 FROM @matches JOIN t USING (a, b))
SELECT a, b, count(*) AS n, avg(r1) AS shift_error, avg(r2) AS affine_error, max(r2) AS affine_max FROM r GROUP BY a, b""")
def _(f):
    shift = matching.fit_model(f.matches, ["a", "b"], "translation").select("a", "b", F.col("m")[2].alias("sx"), F.col("m")[5].alias("sy"))
    fixed = F.array(*[F.lit(c) for c in (1.01, -0.02, 3.0, 0.02, 1.01, -1.0)])
    return stats.pair_report(f.matches, shift.withColumn("m", fixed))


PLANE = """WITH p AS (SELECT dataset, regr_count(hmin, x) AS n, avg(x) AS mx, avg(y) AS my, avg(hmin) AS mh, covar_pop(x, x) AS xx, covar_pop(y, y) AS yy,
covar_pop(x, y) AS xy, covar_pop(x, hmin) AS xh, covar_pop(y, hmin) AS yh FROM @heightfield GROUP BY dataset),
ab AS (SELECT *, (xh * yy - yh * xy) / (xx * yy - xy * xy) AS a, (yh * xx - xh * xy) / (xx * yy - xy * xy) AS b FROM p),
pl AS (SELECT dataset, a, b, mh - a * mx - b * my AS c FROM ab)"""


@query("a23_fit_plane", "dataset:s a:f b:f c:f", PLANE + " SELECT * FROM pl")
def _(f):
    return stats.fit_plane(f.heightfield, ["dataset"], "hmin")


@query("a23_plane_residual", "dataset:s y x residual:f", PLANE + " SELECT dataset, y, x, hmin - (a * x + b * y + c) AS residual FROM @heightfield JOIN pl USING (dataset)")
def _(f):
    return stats.plane_residual(f.heightfield, stats.fit_plane(f.heightfield, ["dataset"], "hmin"), ["dataset"], "hmin")


@query("l1_random_subsample", "dataset:s z y x n total", """
SELECT dataset, z // 2 AS z, y // 2 AS y, x // 2 AS x, count(*) AS n, sum(v) AS total FROM @em GROUP BY dataset, z // 2, y // 2, x // 2""")
def _(f):
    return (stats.random_subsample(f.em, 5).groupBy("dataset", "z", "y", "x")
            .agg(F.count_distinct("output").alias("n"), F.sum("v").alias("total")))


@query("l2_sample_matches", "a n distinct_ids", """
SELECT a, least(64, count(*)) AS n, least(64, count(*)) AS distinct_ids FROM @matches GROUP BY a""")
def _(f):
    return stats.sample_per_group(f.matches, ["a", "b"], ["mid"], 64, 23).groupBy("a").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("mid").alias("distinct_ids"))


@query("l3_brightest_points", "stack pid intensity:f rank", """
SELECT stack, pid, intensity, rank FROM (SELECT stack, pid, intensity, row_number() OVER (PARTITION BY stack ORDER BY intensity DESC, pid) AS rank FROM @points)
WHERE rank <= 500""")
def _(f):
    return stats.top_per_group(f.points, ["stack"], [F.desc("intensity"), F.col("pid")], 500, ["pid"])


@query("l4_sorted_pairs", "a b n", "SELECT a, b, count(*) AS n FROM @matches GROUP BY a, b ORDER BY a, b")
def _(f):
    return stats.pair_counts(f.matches).orderBy("a", "b")


VIEWS = """SELECT concat('id', CAST(a AS STRING)) AS id_a, concat('Ch', CAST(mid % 3 AS STRING)) AS channel_a, 'cam1' AS cam_a,
concat('id', CAST(b AS STRING)) AS id_b, concat('Ch', CAST(mid % 3 AS STRING)) AS channel_b, 'cam1' AS cam_b FROM @matches"""


@query("l5_ordered_views", "id:s channel:s cam:s", f"""WITH v AS ({VIEWS})
SELECT id_a AS id, channel_a AS channel, cam_a AS cam FROM v UNION SELECT id_b, channel_b, cam_b FROM v""")
def _(f):
    return stats.ordered_views(f.sql(VIEWS))


@query("l6_first_best_layer", "dataset:s z n", """
WITH s AS (SELECT dataset, z, max(v) AS n FROM @em GROUP BY dataset, z)
SELECT dataset, z, n FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY n DESC, z) AS r FROM s) WHERE r = 1""")
def _(f):
    return stats.first_best(f.em.groupBy("dataset", "z").agg(F.max("v").alias("n")), ["dataset"], "n", "z")
