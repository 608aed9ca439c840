"""Queries over coordinate transforms, resampling, pyramids and faces."""

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.stencils import gauss_sql
from voxelframe.operators import compose, pixel, stats, transforms as tf

VOX = "dataset:s z y x v:f"
IVOX = "dataset:s z y x v"
FIELD = "dataset:s iy ix tx:f ty:f"
D = "::DOUBLE"


def trilinear(targets: str, source: str = "@em", background: str = "0") -> str:
    """SQL: eight-corner lookup of targets (sx, sy, sz) in a dense volume."""
    return f"""SELECT t.dataset, t.z, t.y, t.x, sum((CASE WHEN cx = 1 THEN t.sx - floor(t.sx) ELSE 1 - (t.sx - floor(t.sx)) END) *
 (CASE WHEN cy = 1 THEN t.sy - floor(t.sy) ELSE 1 - (t.sy - floor(t.sy)) END) * (CASE WHEN cz = 1 THEN t.sz - floor(t.sz) ELSE 1 - (t.sz - floor(t.sz)) END) * coalesce(e.v, {background})) AS v
 FROM {targets} t CROSS JOIN (VALUES (0,0,0),(0,0,1),(0,1,0),(0,1,1),(1,0,0),(1,0,1),(1,1,0),(1,1,1)) AS c(cx, cy, cz)
 LEFT JOIN {source} e ON e.dataset = t.dataset AND e.x = floor(t.sx) + cx AND e.y = floor(t.sy) + cy AND e.z = floor(t.sz) + cz GROUP BY t.dataset, t.z, t.y, t.x"""


AFF = "0.875::DOUBLE * x + 0.125::DOUBLE * y + 0.5 AS sx, -0.125::DOUBLE * x + 1.0::DOUBLE * y + 1.25 AS sy, 1.0::DOUBLE * z + 0.0625 * x - 0.75 AS sz"
MATRIX = [0.875, 0.125, 0.0, 0.5, -0.125, 1.0, 0.0, 1.25, 0.0625, 0.0, 1.0, -0.75]


def affine_case(f):
    sizes = pixel.extents(f.em)
    models = sizes.select("dataset", F.array(*[F.lit(c) for c in MATRIX]).alias("m"))
    return tf.affine_targets(tf.output_grid(sizes), models, ["dataset"]), sizes, models


@query("t1_resample_affine", VOX, f"WITH t AS (SELECT dataset, z, y, x, {AFF} FROM @em) {trilinear('t', background='7')}")
def _(f):
    _, sizes, models = affine_case(f)
    return tf.resample_affine(f.em, models, sizes, 7.0)


@query("t1_resample_nearest", VOX, f"""WITH t AS (SELECT dataset, z, y, x, {AFF} FROM @em) SELECT t.dataset, t.z, t.y, t.x, coalesce(e.v, 7) AS v FROM t LEFT JOIN @em e
ON e.dataset = t.dataset AND e.x = floor(sx + 0.5) AND e.y = floor(sy + 0.5) AND e.z = floor(sz + 0.5)""")
def _(f):
    _, sizes, models = affine_case(f)
    return tf.resample_affine(f.em, models, sizes, 7.0, linear=False)


@query("t2_coverage_mask", "dataset:s z y x mask", f"""WITH t AS (SELECT dataset, z, y, x, {AFF}, max(z) OVER (PARTITION BY dataset) AS mz FROM @em)
SELECT dataset, z, y, x, CASE WHEN floor(sx + 0.5) BETWEEN 0 AND 24 AND floor(sy + 0.5) BETWEEN 0 AND 19 AND floor(sz + 0.5) BETWEEN 0 AND mz THEN 1 ELSE 0 END AS mask FROM t""")
def _(f):
    targets, sizes, _ = affine_case(f)
    return tf.coverage_mask(targets, sizes)


SERIES = "SELECT dataset, z, 1.0::DOUBLE AS a, 0.0625::DOUBLE AS b, z * 0.25::DOUBLE - 1 AS tx, -0.125::DOUBLE AS c, 1.0::DOUBLE AS d, z * 0.125::DOUBLE + 0.5 AS ty FROM @em GROUP BY dataset, z"


def series_models(f):
    z = F.col("z")
    return f.em.select("dataset", "z").distinct().select("dataset", "z", F.array(F.lit(1.0), F.lit(0.0625), z * 0.25 - 1, F.lit(-0.125), F.lit(1.0), z * 0.125 + 0.5).alias("m"))


@query("t3_render_series", VOX + " mask", f"""WITH m AS ({SERIES}), k AS (SELECT m.*, cx, cy, a * d - b * c AS det FROM m, (VALUES (0, 0), (24, 0), (0, 19), (24, 19)) AS q(cx, cy)),
b AS (SELECT dataset, floor(min((d * (cx - tx) - b * (cy - ty)) / det)) AS x0, ceil(max((d * (cx - tx) - b * (cy - ty)) / det)) AS x1,
 floor(min((a * (cy - ty) - c * (cx - tx)) / det)) AS y0, ceil(max((a * (cy - ty) - c * (cx - tx)) / det)) AS y1 FROM k GROUP BY dataset),
g AS (SELECT m.dataset, m.z, CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x, a * x + b * y + tx AS sx, c * x + d * y + ty AS sy, m.z::DOUBLE AS sz FROM m JOIN b USING (dataset), unnest(range(-60, 90)) AS u(x), unnest(range(-60, 90)) AS w(y)
 WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1), r AS ({trilinear('g')})
SELECT r.*, CASE WHEN floor(sx + 0.5) BETWEEN 0 AND 24 AND floor(sy + 0.5) BETWEEN 0 AND 19 THEN 1 ELSE 0 END AS mask FROM r JOIN g USING (dataset, z, y, x)""".replace("m.*, cx, cy, a", "m.*, cx, cy, m.a").replace("b AS (SELECT dataset, floor", "bb AS (SELECT dataset, floor").replace("FROM m JOIN b USING", "FROM m JOIN bb USING"))
def _(f):
    models = series_models(f)
    from voxelframe.functions.affine import invert2
    boxes = stats.mapped_box(models.withColumn("inverse", invert2(F.col("m"))), F.lit(25.0), F.lit(20.0), "inverse")
    bounds = stats.combine_boxes(boxes, ["dataset"], ["x", "y"])
    return tf.render_series(f.em, models, bounds, pixel.extents(f.em))


BOUNDS = "SELECT dataset, 0.0::DOUBLE AS min_x, 24.0::DOUBLE AS max_x, 0.0::DOUBLE AS min_y, 19.0::DOUBLE AS max_y FROM @em GROUP BY dataset"


def bounds(f):
    c = [F.lit(v) for v in (0.0, 24.0, 0.0, 19.0)]
    return f.em.select("dataset").distinct().select("dataset", c[0].alias("min_x"), c[1].alias("max_x"), c[2].alias("min_y"), c[3].alias("max_y"))


@query("t4_bake_field", FIELD, """SELECT dataset, iy, ix, 0.5::DOUBLE * (1.25 * (ix / 0.5) + 0.25 * (iy / 0.5) + 3) AS tx, 0.5::DOUBLE * (iy / 0.5 - 0.5 * (ix / 0.5)) AS ty
FROM (SELECT DISTINCT dataset FROM @em), unnest(range(0, 13)) AS a(ix), unnest(range(0, 11)) AS b(iy)""")
def _(f):
    grid = tf.field_grid(bounds(f), 0.5)
    return tf.bake(grid.withColumns({"tx": F.col("x") * 1.25 + F.col("y") * 0.25 + 3, "ty": F.col("y") - F.col("x") * 0.5}), 0.5)


def bilinear(targets: str, field: str, nx: str, ny: str, values: tuple, px: str = "px", py: str = "py", keep: str = "t.dataset, t.z, t.y, t.x") -> str:
    cx, cy = f"greatest(0.0::DOUBLE, least(t.{px}, {nx} - 1))", f"greatest(0.0::DOUBLE, least(t.{py}, {ny} - 1))"
    w = f"(CASE WHEN ox = 1 THEN {cx} - floor({cx}) ELSE 1 - ({cx} - floor({cx})) END) * (CASE WHEN oy = 1 THEN {cy} - floor({cy}) ELSE 1 - ({cy} - floor({cy})) END)"
    sums = ", ".join(f"sum({w} * f.{v}) AS {v}" for v in values)
    return (f"SELECT {keep}, {sums} FROM {targets} t CROSS JOIN (VALUES (0,0),(0,1),(1,0),(1,1)) AS c(ox, oy) "
            f"JOIN {field} f ON f.dataset = t.dataset AND f.ix = floor({cx}) + ox AND f.iy = floor({cy}) + oy GROUP BY {keep}")


T5 = "SELECT dataset, z, y, x, (x + 0.25::DOUBLE * z) * 1.0 - 2 AS px, (y * 1.0625::DOUBLE) * 1.0 + 1 AS py FROM @em"


@query("t5_apply_field", "dataset:s z y x tx:f ty:f", f"WITH t AS ({T5}) " + bilinear("t", "@posfield", "25", "20", ("tx", "ty")))
def _(f):
    spots = f.em.select("dataset", "z", "y", "x", (F.col("x") + F.col("z") * 0.25).alias("wx"), (F.col("y") * 1.0625).alias("wy"))
    offset = f.em.select("dataset").distinct().select("dataset", F.lit(2.0).alias("off_x"), F.lit(-1.0).alias("off_y"))
    return tf.apply_field(spots, f.posfield, 1.0, offset, x="wx", y="wy")


@query("t6_compose_field", FIELD, """WITH t AS (SELECT dataset, iy, ix, (0.9375::DOUBLE * (ix / 0.5) + 1) * 0.5 AS px, (iy / 0.5 - 0.125::DOUBLE * (ix / 0.5)) * 0.5 AS py
FROM (SELECT DISTINCT dataset FROM @em), unnest(range(0, 13)) AS a(ix), unnest(range(0, 11)) AS b(iy)) """ + bilinear("t", "@posfield", "25", "20", ("tx", "ty"), keep="t.dataset, t.iy, t.ix"))
def _(f):
    affine = f.em.select("dataset").distinct().withColumn("m", F.array(*[F.lit(c) for c in (0.9375, 0.0, 1.0, -0.125, 1.0, 0.0)]))
    return tf.compose_field(affine, f.posfield, bounds(f), 0.5)


CELLS = """SELECT dataset, iy, ix, cx, cy, tx + cx * 0.5 AS tx, ty - cy * 0.25 AS ty FROM @posfield, unnest(range(0, 3)) AS a(cx), unnest(range(0, 3)) AS b(cy)
WHERE ix >= cx * 10 AND ix < cx * 10 + 20 AND iy >= cy * 10 AND iy < cy * 10 + 20"""


@query("t7_blend_cells", FIELD, f"""WITH c AS ({CELLS}), g AS (SELECT *, ix // 10 AS gx, iy // 10 AS gy, (ix % 10) / 10.0::DOUBLE AS lx, (iy % 10) / 10.0::DOUBLE AS ly FROM @posfield),
j AS (SELECT g.dataset, g.iy, g.ix, g.lx, g.ly, a.tx AS x00, b.tx AS x10, c1.tx AS x01, d.tx AS x11, a.ty AS y00, b.ty AS y10, c1.ty AS y01, d.ty AS y11 FROM g
JOIN c a ON a.dataset = g.dataset AND a.iy = g.iy AND a.ix = g.ix AND a.cx = greatest(0, gx - 1) AND a.cy = greatest(0, gy - 1)
JOIN c b ON b.dataset = g.dataset AND b.iy = g.iy AND b.ix = g.ix AND b.cx = gx AND b.cy = greatest(0, gy - 1)
JOIN c c1 ON c1.dataset = g.dataset AND c1.iy = g.iy AND c1.ix = g.ix AND c1.cx = greatest(0, gx - 1) AND c1.cy = gy
JOIN c d ON d.dataset = g.dataset AND d.iy = g.iy AND d.ix = g.ix AND d.cx = gx AND d.cy = gy)
SELECT dataset, iy, ix, ((x11 - x01) * lx + x01 - ((x10 - x00) * lx + x00)) * ly + (x10 - x00) * lx + x00 AS tx,
((y11 - y01) * lx + y01 - ((y10 - y00) * lx + y00)) * ly + (y10 - y00) * lx + y00 AS ty FROM j""")
def _(f):
    cells = f.posfield.withColumn("cx", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumn("cy", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    cells = cells.where("ix >= cx * 10 AND ix < cx * 10 + 20 AND iy >= cy * 10 AND iy < cy * 10 + 20")
    cells = cells.withColumns({"tx": F.col("tx") + F.col("cx") * 0.5, "ty": F.col("ty") - F.col("cy") * 0.25})
    return tf.blend_cells(cells, 10)


DISP = "SELECT dataset, iy, ix, tx - ix AS dx, ty - iy AS dy FROM @posfield"


@query("t8_displacement", "dataset:s z y x tx:f ty:f", f"""WITH d AS ({DISP}), t AS (SELECT dataset, z, y, x, x + 0.5::DOUBLE AS px, y - 0.25::DOUBLE AS py FROM @em),
r AS ({bilinear('t', 'd', '25', '20', ('dx', 'dy'))}) SELECT dataset, z, y, x, x + 0.5 + dx AS tx, y - 0.25 + dy AS ty FROM r""")
def _(f):
    spots = f.em.select("dataset", "z", F.col("y").alias("oy"), F.col("x").alias("ox"), (F.col("x") + 0.5).alias("x"), (F.col("y") - 0.25).alias("y"))
    out = tf.displace(spots, f.sql(DISP))
    return out.select("dataset", "z", F.col("oy").alias("y"), F.col("ox").alias("x"), "tx", "ty")


@query("t8_displacement_stacked", "dataset:s z y x tx:f ty:f", f"""WITH d AS ({DISP}), t AS (SELECT dataset, z, y, x, x::DOUBLE AS px, y::DOUBLE AS py FROM @em),
r AS ({bilinear('t', 'd', '25', '20', ('dx', 'dy'))}), t2 AS (SELECT dataset, z, y, x, x + dx AS px, y + dy AS py FROM r),
r2 AS ({bilinear('t2', 'd', '25', '20', ('dx', 'dy'))}) SELECT dataset, z, y, x, px + dx AS tx, py + dy AS ty FROM r2 JOIN t2 USING (dataset, z, y, x)""")
def _(f):
    d = f.sql(DISP)
    return tf.displace_stacked(f.em, d, d)


@query("t9_flatten", "dataset:s z y x flat:f back:f", "SELECT dataset, z, y, x, (z - hmin) / (hmax - hmin) * 8 + 1 AS flat, z AS back FROM @em JOIN @heightfield USING (dataset, y, x)")
def _(f):
    low, high, c = F.lit(1.0), F.lit(9.0), F.col
    rows = f.em.join(f.heightfield, ["dataset", "y", "x"]).withColumn("flat", tf.flatten_z(c("z"), c("hmin"), c("hmax"), low, high))
    return rows.withColumn("back", tf.unflatten_z(c("flat"), c("hmin"), c("hmax"), low, high))


@query("t10_surface_shift", "dataset:s z y x a:f b:f", "SELECT dataset, z, y, x, z - hmin + 2.5 AS a, z + hmin - 2.5 AS b FROM @em JOIN @heightfield USING (dataset, y, x)")
def _(f):
    c = F.col
    return f.em.join(f.heightfield, ["dataset", "y", "x"]).withColumns({"a": tf.shift_to_surface(c("z"), c("hmin"), 2.5), "b": tf.shift_from_surface(c("z"), c("hmin"), 2.5)})


@query("t11_flatten_volume", IVOX, """WITH av AS (SELECT dataset, sum(hmin * m) / sum(m) AS low, sum(hmax * m) / sum(m) AS high FROM @heightfield GROUP BY dataset),
g AS (SELECT dataset, y, x, zt, zt - floor(low - 2 + 0.5) AS z, (zt - low) / (high - low) * (hmax - hmin) + hmin AS sz FROM @heightfield JOIN av USING (dataset), unnest(range(-20, 40)) AS t(zt)
WHERE zt BETWEEN floor(low - 2 + 0.5) AND floor(high + 2 + 0.5))
SELECT g.dataset, g.z, g.y, g.x, greatest(0, least(255, floor((1 - (sz - floor(sz))) * coalesce(a.v, 0) + (sz - floor(sz)) * coalesce(b.v, 0) + 0.5))) AS v FROM g
LEFT JOIN @em a ON a.dataset = g.dataset AND a.y = g.y AND a.x = g.x AND a.z = floor(sz) LEFT JOIN @em b ON b.dataset = g.dataset AND b.y = g.y AND b.x = g.x AND b.z = floor(sz) + 1""")
def _(f):
    low = stats.weighted_mean(f.heightfield, ["dataset"], "hmin").select("dataset", F.col("mean").alias("low"))
    high = stats.weighted_mean(f.heightfield, ["dataset"], "hmax").select("dataset", F.col("mean").alias("high"))
    return tf.flatten_volume(f.em, f.heightfield.drop("m"), low.join(high, "dataset"), 2.0)


@query("t12_rescale_height_field", "dataset:s y x h:f", f"""WITH f AS (SELECT dataset, y AS iy, x AS ix, (hmin + 0.5) * 2 - 0.5 AS h FROM @heightfield),
t AS (SELECT dataset, 0 AS z, y, x, (x - 0.5::DOUBLE) / 2 AS px, (y - 0.5::DOUBLE) / 2 AS py FROM (SELECT DISTINCT dataset FROM @em), unnest(range(0, 50)) AS a(x), unnest(range(0, 40)) AS b(y)),
r AS ({bilinear('t', 'f', '25', '20', ('h',))}) SELECT dataset, y, x, h FROM r""")
def _(f):
    grid = tf.output_grid(pixel.extents(f.em).selectExpr("dataset", "ny * 2 AS ny", "nx * 2 AS nx"), ("y", "x"))
    return tf.rescale_height_field(f.heightfield.withColumnRenamed("hmin", "h"), grid, (2.0, 2.0, 2.0))


@query("t13_extend_height_field", "dataset:s y x h:f", """WITH g AS (SELECT dataset, y, x, greatest(0, least(24, x)) AS bx, greatest(0, least(19, y)) AS bys FROM (SELECT DISTINCT dataset FROM @em), unnest(range(-10, 40)) AS a(x), unnest(range(-8, 30)) AS b(y)),
j AS (SELECT g.*, hmin - (0.01::DOUBLE * bx + 0.02::DOUBLE * bys + 0.5) AS rest, 0.01::DOUBLE * g.x + 0.02::DOUBLE * g.y + 0.5 AS pz,
 greatest(0 - g.x, g.x - 24, 0) ** 2 + greatest(0 - g.y, g.y - 19, 0) ** 2 AS q FROM g JOIN @heightfield h ON h.dataset = g.dataset AND h.x = bx AND h.y = bys)
SELECT dataset, y, x, 1.5 + (rest * exp(-q * (4 / 6.0::DOUBLE) ** 2 / 2) + pz - 1.5) * exp(-q * (4 / 20.0::DOUBLE) ** 2 / 2) AS h FROM j""")
def _(f):
    spots = f.em.select("dataset").distinct().withColumn("x", F.explode(F.sequence(F.lit(-10).cast("long"), F.lit(39).cast("long"))))
    spots = spots.withColumn("y", F.explode(F.sequence(F.lit(-8).cast("long"), F.lit(29).cast("long"))))
    return tf.extend_height_field(spots, f.heightfield.withColumnRenamed("hmin", "h"), F.lit(1.5), (0.01, 0.02, 0.5), 6.0, 20.0, pixel.extents(f.em))


@query("t14_extended_flatten", "dataset:s z y x s:f", """WITH u AS (SELECT dataset, z, y, x, z * 1.5::DOUBLE - 3 AS q, hmin FROM @em JOIN @heightfield USING (dataset, y, x)),
i AS (SELECT *, (q - 2) / 6 * (8 - hmin) + hmin AS fz FROM u)
SELECT dataset, z, y, x, CASE WHEN q > 8 THEN q WHEN q > 2 THEN fz ELSE exp(-1 * ((2 - q) * 4 / 10.0::DOUBLE) ** 2 / 2) * (fz - q) + q END AS s FROM i""")
def _(f):
    q = F.col("z") * 1.5 - 3
    flat = tf.unflatten_z(q, F.col("hmin"), F.lit(8.0), F.lit(2.0), F.lit(8.0))
    return f.em.join(f.heightfield, ["dataset", "y", "x"]).withColumn("s", tf.extended_flatten_z(q, flat, 2.0, 8.0, 10.0))


DIST = "greatest({lo} - {c}, {c} - {hi}, 0.0::DOUBLE) / {r}::DOUBLE"


@query("t15_local_shifts", "dataset:s z y x ax:f ay:f az:f bx:f bz:f", f"""WITH d AS (SELECT *, {DIST.format(c='x', lo=5, hi=10, r=4)} AS dx, {DIST.format(c='y', lo=3, hi=8, r=5)} AS dy, {DIST.format(c='z', lo=2, hi=4, r=3)} AS dz FROM @em),
s AS (SELECT *, exp(-(dx * dx + dy * dy + dz * dz) / 2) AS g, greatest(0, least(1, 1 - dy)) ** 2 * exp(-(dx * dx + dz * dz) / 2) AS h FROM d)
SELECT dataset, z, y, x, x - 3 * g AS ax, y - 0 * g AS ay, z + 2 * g AS az, x - 3 * h AS bx, z + 2 * h AS bz FROM s""")
def _(f):
    at = [F.col(a).cast("double") for a in ("x", "y", "z")]
    box, shift, reach = [(5, 10), (3, 8), (2, 4)], [3.0, 0.0, -2.0], [4.0, 5.0, 3.0]
    a, b = tf.interval_shift(at, box, shift, reach), tf.plane_interval_shift(at, box, shift, reach, 1)
    return f.em.select("dataset", "z", "y", "x", a[0].alias("ax"), a[1].alias("ay"), a[2].alias("az"), b[0].alias("bx"), b[2].alias("bz"))


EDITS = """SELECT dataset, z AS seq, CAST(5 + z AS DOUBLE) AS sx, CAST(4 + z AS DOUBLE) AS sy, CAST(8 + z AS DOUBLE) AS ex, CAST(3 + z AS DOUBLE) AS ey FROM @em GROUP BY dataset, z"""


@query("t16_point_drags", "dataset:s z y x tx:f ty:f", f"""WITH e AS (SELECT *, greatest(2.0::DOUBLE, sqrt((sx - ex) ** 2 + (sy - ey) ** 2) * 0.75) AS sg FROM ({EDITS})),
r(dataset, z, y, x, k, tx, ty) AS (SELECT dataset, z, y, x, 0::BIGINT, x::DOUBLE, y::DOUBLE FROM @em UNION ALL
SELECT r.dataset, r.z, r.y, r.x, k + 1, tx + exp(-((tx - ex) ** 2 + (ty - ey) ** 2) / (2 * sg * sg)) * (sx - ex), ty + exp(-((tx - ex) ** 2 + (ty - ey) ** 2) / (2 * sg * sg)) * (sy - ey)
FROM r JOIN e ON e.dataset = r.dataset AND e.seq = k)
SELECT r.dataset, z, y, x, tx, ty FROM r JOIN (SELECT dataset, max(seq) + 1 AS n FROM e GROUP BY dataset) q ON q.dataset = r.dataset AND k = n""")
def _(f):
    return tf.drag(f.em, f.sql(EDITS), 2.0, 0.75)


BOT = "SELECT dataset, iy, ix, tx + 1.5 AS tx, ty - 0.5 AS ty FROM @posfield"


@query("t17_transition", "dataset:s z y x sx:f sy:f", f"""WITH t AS (SELECT dataset, z, y, x, x::DOUBLE AS px, y::DOUBLE AS py FROM @em), r AS ({bilinear('t', '@posfield', '25', '20', ('tx', 'ty'))})
SELECT dataset, z, y, x, tx + greatest(0, least(1, (z - 1) / 6.0::DOUBLE)) * 1.5 AS sx, ty - greatest(0, least(1, (z - 1) / 6.0::DOUBLE)) * 0.5 AS sy FROM r""")
def _(f):
    return tf.transition(f.em, f.posfield, f.sql(BOT), F.col("z"), F.lit(1.0), F.lit(7.0))


@query("t18_export_slabs", IVOX, f"""WITH s AS (SELECT dataset, row_number() OVER (ORDER BY CAST(substr(dataset, 2) AS BIGINT)) - 1 AS ord, max(z) AS bot FROM @em GROUP BY dataset),
o AS (SELECT *, bot - 1 + 1 AS depth, coalesce(sum(bot) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS zoff FROM s),
t AS (SELECT o.dataset, e.z, e.y, e.x, e.x::DOUBLE AS px, e.y::DOUBLE AS py FROM @em e JOIN o USING (dataset) WHERE e.z >= 1),
r AS ({bilinear('t', '@posfield', '25', '20', ('tx', 'ty'))}),
m AS (SELECT r.dataset, r.z, y, x, tx + greatest(0, least(1, (r.z - 1) / (bot - 1)::DOUBLE)) * 1.5 AS sx, ty - greatest(0, least(1, (r.z - 1) / (bot - 1)::DOUBLE)) * 0.5 AS sy, r.z::DOUBLE AS sz FROM r JOIN o USING (dataset)),
p AS ({trilinear('m')})
SELECT 'aligned' AS dataset, z - 1 + zoff AS z, y, x, CAST(greatest(0, least(255, floor(v + 0.5))) AS BIGINT) AS v FROM p JOIN o USING (dataset) WHERE floor(v + 0.5) > 0""")
def _(f):
    from voxelframe.plans.export import export_slabs
    slabs = f.em.groupBy("dataset").agg(F.lit(1).cast("long").alias("top"), F.lit(-1).cast("long").alias("bot"), (F.max("z") + 1).alias("nz"))
    slabs = slabs.withColumn("ord", F.expr("CAST(substr(dataset, 2) AS BIGINT)"))
    grid = tf.output_grid(pixel.extents(f.em).select("dataset", "ny", "nx"), ("y", "x"))
    return export_slabs(f.em, slabs, grid, f.posfield, f.sql(BOT))


@query("t20_warp_phase_out", VOX, f"""WITH d AS ({DISP}), t AS (SELECT dataset, z, y, x, x::DOUBLE AS px, y::DOUBLE AS py FROM @em WHERE z <= 7), r AS ({bilinear('t', 'd', '25', '20', ('dx', 'dy'))}),
m AS (SELECT dataset, z, y, x, x + dx * (8 - z) / 8.0::DOUBLE AS sx, y + dy * (8 - z) / 8.0::DOUBLE AS sy, z::DOUBLE AS sz FROM r) {trilinear('m')}""")
def _(f):
    return tf.warp_phase_out(f.em, f.sql(DISP), pixel.extents(f.em), 0, 7)


G3 = 0.75 ** 0.5


@query("t21_pyramid_gauss", VOX, f"""WITH n AS (SELECT max(z) + 1 AS nz FROM @em), g1 AS ({gauss_sql('@em', 'z', '(SELECT nz FROM n)', G3)}), g2 AS ({gauss_sql('g1', 'y', '20', G3)}), g3 AS ({gauss_sql('g2', 'x', '25', G3)})
SELECT dataset, z // 2 AS z, y // 2 AS y, x // 2 AS x, v FROM g3 WHERE z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0 AND x // 2 < 12 AND z // 2 < (SELECT nz FROM n) // 2""")
def _(f):
    return tf.pyramid_gauss(f.em, 1, pixel.extents(f.em))[0]


@query("t21_pyramid_gauss_levels", "dataset:s level n total:f", f"""WITH a1 AS ({gauss_sql('@em', 'y', '20', G3)}), a2 AS ({gauss_sql('a1', 'x', '25', G3)}),
l1 AS (SELECT dataset, z, y // 2 AS y, x // 2 AS x, v FROM a2 WHERE y % 2 = 0 AND x % 2 = 0 AND x // 2 < 12), b1 AS ({gauss_sql('l1', 'y', '10', G3)}), b2 AS ({gauss_sql('b1', 'x', '12', G3)}),
l2 AS (SELECT dataset, z, y // 2 AS y, x // 2 AS x, v FROM b2 WHERE y % 2 = 0 AND x % 2 = 0 AND x // 2 < 6)
SELECT dataset, 1 AS level, count(*) AS n, sum(v) AS total FROM l1 GROUP BY dataset UNION ALL SELECT dataset, 2, count(*), sum(v) FROM l2 GROUP BY dataset""")
def _(f):
    out = None
    for i, level in enumerate(tf.pyramid_gauss(f.em, 2, pixel.extents(f.em), ("y", "x"))):
        row = level.groupBy("dataset").agg(F.lit(i + 1).alias("level"), F.count("*").alias("n"), F.sum("v").alias("total"))
        out = row if out is None else out.unionByName(row)
    return out


@query("t22_pyramid_mean", "level " + IVOX, """WITH a AS (SELECT dataset, z // 2 AS z, y // 2 AS y, x // 2 AS x, CAST(floor(avg(v) + 0.5) AS BIGINT) AS v FROM @em GROUP BY ALL),
b AS (SELECT dataset, z, y // 3 AS y, x // 3 AS x, CAST(floor(avg(v) + 0.5) AS BIGINT) AS v FROM a GROUP BY ALL)
SELECT 1 AS level, * FROM a UNION ALL SELECT 2, * FROM b""")
def _(f):
    a, b = tf.pyramid_mean(f.em, [{"z": 2, "y": 2, "x": 2}, {"y": 3, "x": 3}])
    return a.withColumn("level", F.lit(1)).unionByName(b.withColumn("level", F.lit(2)))


@query("t23_downsample_axis", VOX, "SELECT dataset, z, y, x // 2 AS x, avg(v) AS v FROM @em GROUP BY dataset, z, y, x // 2")
def _(f):
    return tf.pyramid_mean(f.em, [{"x": 2}], integer=False)[0]


@query("t24_extract_face", "dataset:s y x v:f", "SELECT dataset, y - 2 AS y, x - 1 AS x, v FROM @em JOIN (SELECT dataset, max(z) AS top FROM @em GROUP BY dataset) USING (dataset) WHERE z = 6 AND y >= 2 AND y < 18 AND x >= 1 AND x < 21")
def _(f):
    return tf.extract_face(f.em, {"z": 6, "y": 2, "x": 1}, {"z": -6, "y": 16, "x": 20})


@query("t25_field_difference", "dataset:s iy ix dx:f dy:f length:f", """SELECT dataset, iy, ix, 1.5 - ix * 0.25 AS dx, -0.5 AS dy, sqrt((1.5 - ix * 0.25::DOUBLE) ** 2 + 0.25) AS length FROM @posfield""")
def _(f):
    other = f.sql("SELECT dataset, iy, ix, tx + 1.5 - ix * CAST(0.25 AS DOUBLE) AS tx, ty - CAST(0.5 AS DOUBLE) AS ty FROM @posfield")
    return tf.field_difference(f.posfield, other)


@query("t26_slice_transform", "dataset:s z:f y x tx:f ty:f", f"""WITH m AS ({SERIES}) SELECT e.dataset, e.z + 0.375 AS z, y, x, a * x + b * y + tx AS tx, c * x + d * y + ty AS ty
FROM @em e JOIN m ON m.dataset = e.dataset AND m.z = floor(e.z + 0.375 + 0.5)""")
def _(f):
    return tf.slice_of_stack(f.em.withColumn("z", F.col("z") + 0.375), series_models(f))


@query("t27_resample_integer", IVOX, """WITH n AS (SELECT dataset, max(z) + 1 AS nz FROM @em GROUP BY dataset), t AS (SELECT e.*, nz, ((2 * x - y + 3) % 48 + 48) % 48 AS px, ((x + z - 4) % 38 + 38) % 38 AS py, ((z * 3 - y + 1) % (2 * nz - 2) + 2 * nz - 2) % (2 * nz - 2) AS pz FROM @em e JOIN n USING (dataset)),
s AS (SELECT *, CASE WHEN px < 25 THEN px ELSE 48 - px END AS sx, CASE WHEN py < 20 THEN py ELSE 38 - py END AS sy, CASE WHEN pz < nz THEN pz ELSE 2 * nz - 2 - pz END AS sz FROM t)
SELECT s.dataset, s.z, s.y, s.x, e.v FROM s JOIN @em e ON e.dataset = s.dataset AND e.x = sx AND e.y = sy AND e.z = sz""")
def _(f):
    return tf.resample_integer(f.em, f.em.select("dataset", "z", "y", "x"), [2, -1, 0, 3, 1, 0, 1, -4, 0, -1, 3, 1], pixel.extents(f.em))


@query("t27_split_integer", "id a tx ra:f rtx:f", """WITH q AS (SELECT o_orderkey AS id, (o_orderkey % 40) / 8.0::DOUBLE + 0.7 AS a, o_custkey / 3.0::DOUBLE AS tx FROM @orders)
SELECT id, floor(a + 0.5) AS a, floor(tx + 0.5) AS tx, a / floor(a + 0.5) AS ra, tx - a * floor(tx + 0.5) / floor(a + 0.5) AS rtx FROM q""")
def _(f):
    from voxelframe.functions.affine import concatenate, invert3
    a, tx = (F.col("o_orderkey") % 40) / F.lit(8.0) + 0.7, F.col("o_custkey") / F.lit(3.0)
    one, zero = F.lit(1.0), F.lit(0.0)
    m = F.array(a, zero, zero, tx, zero, one, zero, zero, zero, zero, one, zero)
    rows = f.orders.select(F.col("o_orderkey").alias("id"), m.alias("m")).withColumn("part", tf.split_integer(F.col("m")))
    rows = rows.withColumn("inverse", invert3(F.col("part"))).withColumn("rest", concatenate(F.col("m"), F.col("inverse"), 3))
    return rows.select("id", F.col("part")[0].alias("a"), F.col("part")[3].alias("tx"), F.col("rest")[0].alias("ra"), F.col("rest")[3].alias("rtx"))


@query("t30_non_rigid", VOX, f"""WITH g AS (SELECT dataset, z, y, x, (x / 8.0::DOUBLE) AS gx, (y / 10.0::DOUBLE) AS gy, (z / 5.0::DOUBLE) AS gz FROM @em),
w AS (SELECT dataset, z, y, x, x + 0.25 + 0.125 * least(gx, 3) + 0.0625 * least(gy, 2) * 2 AS sx, y - 0.5 + 0.25 * least(gz, 2) AS sy, z + 0.125 * least(gy, 2) AS sz FROM g) {trilinear('w')}""")
def _(f):
    control = f.em.select("dataset").distinct().withColumn("z", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))))
    control = control.withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long")))).withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))))
    c, one, zero = F.col, F.lit(1.0), F.lit(0.0)
    control = control.withColumn("m", F.array(one, zero, zero, c("x") * 0.125 + c("y") * 0.125 + 0.25, zero, one, zero, c("z") * 0.25 - 0.5, zero, zero, one, c("y") * 0.125))
    targets = tf.non_rigid_targets(f.em.select("dataset", "z", "y", "x"), control, {"x": 8.0, "y": 10.0, "z": 5.0}, pixel.extents(control))
    return tf.resample(f.em, targets)


@query("t31_render_stack", "dataset:s k y x v:f mask", f"""WITH m AS ({SERIES}), g AS (SELECT e.dataset, e.z AS k, e.z * 0.75::DOUBLE AS pz, y, x FROM @em e),
h AS (SELECT g.*, o, CASE WHEN o = 1 THEN pz - floor(pz) ELSE 1 - (pz - floor(pz)) END AS w FROM g, (VALUES (0), (1)) AS q(o)),
t AS (SELECT h.dataset, h.k * 2 + o AS z, h.y, h.x, k, w, a * x + b * y + tx AS sx, c * x + d * y + ty AS sy, m.z::DOUBLE AS sz FROM h JOIN m ON m.dataset = h.dataset AND m.z = floor(pz) + o WHERE w > 0),
r AS ({trilinear('t')}), one AS (SELECT dataset, z, y, x, 1 AS v FROM @em), r1 AS ({trilinear('t', 'one')})
SELECT t.dataset, k, t.y, t.x, sum(w * r.v) AS v, CASE WHEN sum(w * r1.v) >= 0.99999::DOUBLE THEN 1 ELSE 0 END AS mask FROM t JOIN r USING (dataset, z, y, x) JOIN r1 USING (dataset, z, y, x) GROUP BY t.dataset, k, t.y, t.x""")
def _(f):
    grid = f.em.select("dataset", F.col("z").alias("k"), "y", "x", (F.col("z") * 0.75).alias("pz"))
    return tf.render_stack(f.em, series_models(f), grid)


MOVES = "SELECT dataset, z * 2 AS x, z + 3 AS y, CAST(1.5 AS DOUBLE) AS mx, CAST(z * 0.25 AS DOUBLE) AS my, CAST(1 + z * 0.25 AS DOUBLE) AS sx, CAST(2 AS DOUBLE) AS sy FROM @em GROUP BY dataset, z"


@query("t32_edit_field", FIELD, f"""WITH e AS ({MOVES}), h AS (SELECT f.dataset, f.iy, f.ix, mx * exp(-((f.ix - e.x) ** 2) / (2 * sx * sx)) * exp(-((f.iy - e.y) ** 2) / (2 * sy * sy)) AS dx,
my * exp(-((f.ix - e.x) ** 2) / (2 * sx * sx)) * exp(-((f.iy - e.y) ** 2) / (2 * sy * sy)) AS dy FROM @posfield f JOIN e ON e.dataset = f.dataset AND abs(f.ix - e.x) < greatest(2, floor(3 * sx + 0.5) + 1) AND abs(f.iy - e.y) < greatest(2, floor(3 * sy + 0.5) + 1)),
s AS (SELECT dataset, iy, ix, sum(dx) AS dx, sum(dy) AS dy FROM h GROUP BY ALL)
SELECT dataset, iy, ix, tx + coalesce(dx, 0) AS tx, ty + coalesce(dy, 0) AS ty FROM @posfield LEFT JOIN s USING (dataset, iy, ix)""")
def _(f):
    return tf.edit_field(f.posfield, f.sql(MOVES), cell=8)


@query("t32_stretch_field", FIELD, f"""WITH d AS (SELECT *, (20 * (4.0::DOUBLE - iy) - (2.0::DOUBLE - ix) * 6) / sqrt(436.0::DOUBLE) AS q FROM @posfield)
SELECT dataset, iy, ix, CASE WHEN q < 0 THEN tx + q * 6 / sqrt(436.0::DOUBLE) * 0.125 ELSE tx END AS tx, CASE WHEN q < 0 THEN ty - q * 20 / sqrt(436.0::DOUBLE) * 0.125 ELSE ty END AS ty FROM d""")
def _(f):
    return tf.stretch_field(f.posfield, (2.0, 4.0), (22.0, 10.0), 0.125, True)


@query("u2_max_fusion", IVOX, f"""WITH t AS (SELECT dataset, z, y, x, {AFF} FROM @em), a AS ({trilinear('t')}), b AS (SELECT dataset, z, y, x, v::DOUBLE AS v FROM @em_b)
SELECT dataset, z, y, x, floor(max(v) + 0.5) AS v FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL""")
def _(f):
    first = tf.resample(f.em, affine_case(f)[0]).select("dataset", "z", "y", "x", "v")
    return compose.max_fusion([first, f.em_b.withColumn("v", F.col("v").cast("double"))])
