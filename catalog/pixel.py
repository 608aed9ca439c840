"""Queries over per-voxel operators and scalar functions."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.functions import affine, scalar
from voxelframe.operators import grid, pixel

VOX = "dataset:s z y x v"


@query("p1_rescale", "dataset:s z y x v:f", "SELECT dataset, z, y, x, (v - 20.0::DOUBLE) * 255 / 180 AS v FROM @em")
def _(f):
    return f.em.withColumn("v", scalar.rescale(F.col("v"), 20, 200))


@query("p2_invert", "dataset:s z y x a b", "SELECT dataset, z, y, x, 255 - v AS a, CASE WHEN v = 0 THEN 0 ELSE 255 - v END AS b FROM @em")
def _(f):
    return f.em.withColumns({"a": scalar.invert(F.col("v")), "b": scalar.invert(F.col("v"), keep_zero=True)})


@query("p3_clamp_round", "dataset:s z y x a b", """SELECT dataset, z, y, x, greatest(0, least(255, floor(v * 2.25::DOUBLE - 60 + 0.5))) AS a,
greatest(0, least(65535, floor(v * 600.5::DOUBLE - 60 + 0.5))) AS b FROM @em""")
def _(f):
    v = F.col("v")
    return f.em.withColumns({"a": scalar.to_pixel(v * 2.25 - 60, "u8"), "b": scalar.to_pixel(v * 600.5 - 60, "u16")})


@query("p4_stretch_cost", VOX, "SELECT dataset, z, y, x, greatest(0, least(255, 255 - (255 - v) * 4)) AS v FROM @cost_plane")
def _(f):
    return f.cost_plane.withColumn("v", scalar.stretch_cost(F.col("v")))


@query("p5_crop", VOX, "SELECT dataset, z - 1 AS z, 15 - y AS y, x - 3 AS x, v FROM @em WHERE z >= 1 AND z < 8 AND y <= 15 AND y > 5 AND x >= 3 AND x < 20")
def _(f):
    return pixel.crop(f.em, {"z": 1, "y": 15, "x": 3}, {"z": 7, "y": -10, "x": 17})


@query("p6_axes", VOX, """WITH r AS (SELECT dataset, y AS z, -(z + 5) AS y, x - 7 AS x, v FROM @em)
SELECT dataset, z - min(z) OVER w AS z, y - min(y) OVER w AS y, x - min(x) OVER w AS x, v FROM r WINDOW w AS (PARTITION BY dataset)""")
def _(f):
    moved = pixel.translate(f.em, {"x": -7, "z": 5})
    return pixel.zero_min(pixel.invert_axis(pixel.permute(moved, {"y": "z", "z": "y"}), "y"))


@query("p6_rotate", VOX, "SELECT dataset, z, x AS y, -y AS x, v FROM @em")
def _(f):
    return pixel.rotate90(f.em, "x", "y")


@query("p7_slice_and_stack", VOX, "SELECT dataset, CASE WHEN z = 2 THEN 0 ELSE 1 END AS z, y, x, v FROM @em WHERE z IN (1, 2)")
def _(f):
    return pixel.stack([pixel.hyperslice(f.em, "z", 2), pixel.hyperslice(f.em, "z", 1)])


@query("p8_subsample", VOX, "SELECT dataset, z // 2 AS z, y // 3 AS y, x // 2 AS x, v FROM @em WHERE z % 2 = 0 AND y % 3 = 0 AND x % 2 = 0")
def _(f):
    return pixel.subsample(f.em, {"z": 2, "y": 3, "x": 2})


SRC = {
    "border": "greatest(0, least(n - 1, t))",
    "mirror_single": "(CASE WHEN n = 1 THEN 0 WHEN ((t % (2*n-2)) + 2*n-2) % (2*n-2) < n THEN ((t % (2*n-2)) + 2*n-2) % (2*n-2) ELSE 2*n-2 - ((t % (2*n-2)) + 2*n-2) % (2*n-2) END)",
    "mirror_double": "(CASE WHEN ((t % (2*n)) + 2*n) % (2*n) < n THEN ((t % (2*n)) + 2*n) % (2*n) ELSE 2*n-1 - ((t % (2*n)) + 2*n) % (2*n) END)",
}


def source_axis(axis: str, halo: int, mode: str) -> str:
    """SQL: position t of a padded axis and the position it reads from."""
    return (f"SELECT dataset, t AS {axis}, {SRC[mode]} AS s{axis} FROM (SELECT dataset, n, unnest(range(-{halo}, n + {halo})) AS t "
            f"FROM (SELECT dataset, max({axis}) + 1 AS n FROM @em GROUP BY dataset))")


def padded(mode: str, hz: int, hy: int, hx: int) -> str:
    return (f"SELECT pz.dataset, pz.z, py.y, px.x, e.v FROM ({source_axis('z', hz, mode)}) pz JOIN ({source_axis('y', hy, mode)}) py "
            f"ON pz.dataset = py.dataset JOIN ({source_axis('x', hx, mode)}) px ON pz.dataset = px.dataset "
            "JOIN @em e ON e.dataset = pz.dataset AND e.z = sz AND e.y = sy AND e.x = sx")


for _mode in SRC:
    @query(f"p9_pad_{_mode}", VOX, padded(_mode, 1, 2, 3))
    def _(f, mode=_mode):
        return pixel.pad(f.em, {"z": 1, "y": 2, "x": 3}, mode)


@query("p9_pad_constant", VOX, padded("border", 1, 2, 3).replace("e.v FROM", "CASE WHEN pz.z = sz AND py.y = sy AND px.x = sx THEN e.v ELSE 7 END AS v FROM"))
def _(f):
    return pixel.pad(f.em, {"z": 1, "y": 2, "x": 3}, "constant", value=7)


@query("p10_content_filter", VOX, "SELECT * FROM @em WHERE v >= 20 AND v <= 200")
def _(f):
    return f.em.where(~scalar.outside_content(F.col("v"), "u8"))


@query("p11_heightfield_mask", "dataset:s z y x v u", """SELECT dataset, z, y, x, CASE WHEN z BETWEEN hmin AND hmax THEN 1 ELSE 0 END AS v,
CASE WHEN hmin > z THEN 255 ELSE 0 END AS u FROM @em JOIN @heightfield USING (dataset, y, x)""")
def _(f):
    above = pixel.surface_mask(f.em, f.heightfield).withColumnRenamed("v", "u")
    return pixel.heightfield_mask(f.em, f.heightfield).join(above, ["dataset", "z", "y", "x"])


@query("p12_value_to_noise", "dataset:s z same inside:b", """SELECT dataset, z, count(*) FILTER (WHERE v <> 0) AS same, true AS inside FROM @em GROUP BY dataset, z""")
def _(f):
    noisy = f.em.withColumn("n", scalar.value_to_noise(F.col("v"), 0, 10, 20, 3, *[F.col(c) for c in ("dataset", "z", "y", "x")]))
    return noisy.groupBy("dataset", "z").agg(F.count_if((F.col("v") != 0) & (F.col("n") == F.col("v"))).alias("same"),
                                             F.bool_and((F.col("v") != 0) | F.col("n").between(10, 20)).alias("inside"))


@query("p13_mask_out", "dataset:s z y x v:f", "SELECT dataset, z, y, x, CASE WHEN m.v = 0 THEN -1 ELSE e.v END AS v FROM @em e JOIN @mask m USING (dataset, z, y, x)")
def _(f):
    return pixel.mask_out(f.em, f.mask, -1.0)


@query("p14_block_inclusion", "dataset:s gz gy gx", """SELECT DISTINCT dataset, z // 4 AS gz, y // 8 AS gy, x // 8 AS gx FROM @em
WHERE (z // 4) * 4 >= 0 AND least((z // 4) * 4 + 3, (SELECT max(z) FROM @em)) <= 7 AND z // 4 IN (1)""")
def _(f):
    blocks = grid.grid(pixel.extents(f.em), {"z": 4, "y": 8, "x": 8})
    return grid.included_blocks(blocks, 0, 7, [1])


@query("p15_points_in_box", "stack pid", "SELECT stack, pid FROM @points WHERE x BETWEEN 100 AND 300 AND y BETWEEN 50 AND 250 AND z BETWEEN 10 AND 40")
def _(f):
    return grid.points_in_box(f.points, {"x": (100, 300), "y": (50, 250), "z": (10, 40)})


@query("p15_points_in_blocks", "stack pid", """SELECT stack, pid FROM @points WHERE EXISTS (SELECT 1 FROM @tiles
WHERE x BETWEEN ox + 10 AND ox + 60 AND y BETWEEN oy + 10 AND oy + 60 AND z BETWEEN oz + 10 AND oz + 60)""")
def _(f):
    # the cores of all tiles, so that many points lie in none
    cores = f.tiles.selectExpr("tile", *[f"o{a} + 10 AS o{a}" for a in "xyz"], *[f"51 AS s{a}" for a in "xyz"])
    return grid.points_in_blocks(f.points, cores, 100, ["stack", "pid"])


@query("p16_exclusions", "stack pid", "SELECT stack, pid FROM @points WHERE stack NOT IN (2, 5)")
def _(f):
    return pixel.exclude(f.points, stack=[2, 5])


@query("p18_pointwise", "dataset:s z y x p h l", """SELECT dataset, z, y, x, e.v * m.v AS p, greatest(e.v, m.v) AS h, least(e.v, m.v) AS l
FROM @em e JOIN @cost_plane m USING (dataset, z, y, x)""")
def _(f):
    pos = ["dataset", "z", "y", "x"]
    a = pixel.combine(f.em, f.cost_plane, "multiply").withColumnRenamed("v", "p")
    b = pixel.combine(f.em, f.cost_plane, "max").withColumnRenamed("v", "h")
    c = pixel.combine(f.em, f.cost_plane, "min").withColumnRenamed("v", "l")
    return a.join(b, pos).join(c, pos)


# ---- scalar functions -------------------------------------------------------

CSV = "SELECT o_orderkey AS id, concat(CAST(o_orderkey AS STRING), ', ', CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 9 = 0 THEN ',x' ELSE ',7' END) AS t FROM @orders"


@query("f1_parse_numbers", "id a b c:f", f"""SELECT id, CASE WHEN id % 9 = 0 THEN NULL ELSE id END AS a,
CASE WHEN id % 9 = 0 THEN NULL ELSE CAST(trim(split_part(t, ',', 2)) AS BIGINT) END AS b, CASE WHEN id % 9 = 0 THEN NULL ELSE 7.0::DOUBLE END AS c FROM ({CSV})""")
def _(f):
    longs, reals = scalar.parse_numbers(F.col("t")), scalar.parse_numbers(F.col("t"), "double")
    return f.sql(CSV).select("id", longs[0].alias("a"), longs[1].alias("b"), reals[2].alias("c"))


BATCH = "SELECT o_orderkey AS id, concat(CAST(1 + o_orderkey % 5 AS STRING), ':', CAST(5 + o_orderkey % 3 AS STRING)) AS t FROM @orders"


@query("f2_parse_batch", "id batch total", "SELECT o_orderkey AS id, 1 + o_orderkey % 5 AS batch, 5 + o_orderkey % 3 AS total FROM @orders")
def _(f):
    return f.sql(BATCH).select("id", scalar.parse_batch(F.col("t")).alias("p")).select("id", "p.*")


NAMES = "SELECT o_orderkey AS id, concat('/', CAST(o_custkey AS STRING), '/s', CAST(o_orderkey % 10 AS STRING), '/') AS t FROM @orders"


@query("f3_group_names", "id flat:s clean:s", f"""SELECT id, replace(substr(t, 2), '/', '.') AS flat, trim(t, '/') AS clean FROM ({NAMES})""")
def _(f):
    return f.sql(NAMES).select("id", scalar.flatten_group(F.col("t")).alias("flat"),
                               scalar.sanitize_dataset(F.concat(F.lit("  /"), "t")).alias("clean"))


@query("f4_name_templates", "id file:s cell:s", """SELECT o_orderkey AS id, concat('slice-', lpad(CAST(o_orderkey AS STRING), 8, '0'), '.tif') AS file,
concat('base.', CAST(o_custkey % 7 AS STRING), '-', CAST(o_custkey % 5 AS STRING)) AS cell FROM @orders""")
def _(f):
    return f.orders.select(F.col("o_orderkey").alias("id"), F.format_string("slice-%08d.tif", "o_orderkey").alias("file"),
                           F.format_string("base.%d-%d", F.col("o_custkey") % 7, F.col("o_custkey") % 5).alias("cell"))


MATCHNAMES = """SELECT o_orderkey AS id, concat('matches_', lpad(CAST(o_orderkey % 1000 AS STRING), 6, '0'), '_Ch', CAST(400 + o_custkey % 300 AS STRING), 'nm_cam1__',
lpad(CAST(o_custkey % 1000 AS STRING), 6, 'Z'), '_Ch', CAST(405 + o_orderkey % 3 AS STRING), '+561nm_cam2') AS t FROM @orders"""


@query("f5_match_names", "id id_a:s channel_a:s cam_a:s id_b:s channel_b:s cam_b:s", """SELECT o_orderkey AS id, lpad(CAST(o_orderkey % 1000 AS STRING), 6, '0') AS id_a,
concat('Ch', CAST(400 + o_custkey % 300 AS STRING), 'nm') AS channel_a, 'cam1' AS cam_a, lpad(CAST(o_custkey % 1000 AS STRING), 6, 'Z') AS id_b,
concat('Ch', CAST(405 + o_orderkey % 3 AS STRING), '+561nm') AS channel_b, 'cam2' AS cam_b FROM @orders""")
def _(f):
    return f.sql(MATCHNAMES).select("id", scalar.parse_match_name(F.col("t")).alias("n")).select("id", "n.*")


@query("f6_parse_affine", "id a:f b:f c:f d:f tx:f ty:f", """SELECT o_orderkey AS id, 1.0::DOUBLE AS a, 0.5::DOUBLE AS b, (o_orderkey % 9)::DOUBLE AS c, 0.25::DOUBLE AS d,
(o_custkey)::DOUBLE AS tx, -3.5::DOUBLE AS ty FROM @orders""")
def _(f):
    text = F.concat(F.lit("[[1.0, 0.5, "), F.col("o_custkey").cast("string"), F.lit("],["), (F.col("o_orderkey") % 9).cast("string"), F.lit(", 0.25, -3.5]]"))
    m = affine.parse_affine(text)
    return f.orders.select(F.col("o_orderkey").alias("id"), m[0].alias("a"), m[2].alias("b"), m[1].alias("c"), m[3].alias("d"), m[4].alias("tx"), m[5].alias("ty"))


@query("f7_affine_json", "id n third:f same:b", "SELECT o_orderkey AS id, 6 AS n, o_custkey::DOUBLE AS third, true AS same FROM @orders")
def _(f):
    m = F.array(F.lit(1.0), F.lit(0.5), F.col("o_custkey").cast("double"), F.lit(0.0), F.lit(1.0), F.lit(-2.0))
    back = affine.from_json(F.col("j"))
    return (f.orders.select(F.col("o_orderkey").alias("id"), m.alias("m")).withColumn("j", affine.to_json(F.col("m")))
            .select("id", F.size(back).alias("n"), back[2].alias("third"), (back == F.col("m")).alias("same")))


def matrix(f):
    m = F.array(F.lit(1.5), F.lit(0.25), F.col("o_custkey").cast("double"), F.lit(-0.5), F.lit(2.0), (F.col("o_orderkey") % 50).cast("double"))
    return f.orders.select(F.col("o_orderkey").alias("id"), m.alias("m"))


MATRIX = "SELECT o_orderkey AS id, 1.5::DOUBLE AS a, 0.25::DOUBLE AS b, o_custkey::DOUBLE AS tx, -0.5::DOUBLE AS c, 2.0::DOUBLE AS d, (o_orderkey % 50)::DOUBLE AS ty FROM @orders"


@query("f8_affine_algebra", "id itx:f ity:f ia:f ctx:f cty:f ca:f stx:f sty:f unit:f", f"""WITH m AS ({MATRIX})
SELECT id, (b * ty - d * tx) / (a * d - b * c) AS itx, (c * tx - a * ty) / (a * d - b * c) AS ity, d / (a * d - b * c) AS ia,
a * tx + b * ty + tx AS ctx, c * tx + d * ty + ty AS cty, a * a + b * c AS ca, tx / 4 AS stx, ty / 4 AS sty, 1.0::DOUBLE AS unit FROM m""")
def _(f):
    m = F.col("m")
    inv, twice, small = affine.invert2(m), affine.concatenate(m, m), affine.scale_conjugate(m, 4)
    back = affine.swap_layout_back(affine.swap_layout(m))
    one = affine.concatenate(inv, m)[0] * F.when(back == m, 1.0).otherwise(0.0)
    return matrix(f).select("id", inv[2].alias("itx"), inv[5].alias("ity"), inv[0].alias("ia"), twice[2].alias("ctx"), twice[5].alias("cty"),
                            twice[0].alias("ca"), small[2].alias("stx"), small[5].alias("sty"), one.alias("unit"))


@query("f8_affine_3d", "id a:f b:f c:f tx:f ty:f tz:f", """WITH q AS (SELECT o_orderkey AS id, (o_custkey % 10)::DOUBLE AS t FROM @orders)
SELECT id, 1.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c, t AS tx, t + 1 AS ty, t + 2 AS tz FROM q""")
def _(f):
    t = (F.col("o_custkey") % 10).cast("double")
    m = F.array(*[F.lit(c) for c in (2.0, 0.5, 0.0)], t, *[F.lit(c) for c in (0.25, 1.0, 0.125)], t + 1, *[F.lit(c) for c in (0.0, -0.5, 4.0)], t + 2)
    steps = f.orders.select(F.col("o_orderkey").alias("id"), m.alias("m")).withColumn("inv", affine.invert3(F.col("m")))
    steps = steps.withColumn("unit", affine.concatenate(F.col("m"), F.col("inv"), 3))
    steps = steps.withColumn("back", affine.concatenate(F.col("unit"), F.col("m"), 3))
    unit, back = F.col("unit"), F.col("back")
    return steps.select("id", unit[0].alias("a"), unit[1].alias("b"), unit[2].alias("c"), back[3].alias("tx"), back[7].alias("ty"), back[11].alias("tz"))


@query("f9_scale_arrays", "id x:f y:f", "SELECT o_orderkey AS id, o_custkey * 8.0::DOUBLE AS x, (o_orderkey % 50) * 8.0::DOUBLE AS y FROM @orders")
def _(f):
    scaled = affine.scale_array(F.array(F.col("o_custkey").cast("double"), (F.col("o_orderkey") % 50).cast("double")), 2 ** 3)
    return f.orders.select(F.col("o_orderkey").alias("id"), scaled[0].alias("x"), scaled[1].alias("y"))


@query("f10_reorder", "id x y z", "SELECT o_orderkey AS id, o_custkey % 3 AS x, o_custkey AS y, o_orderkey AS z FROM @orders")
def _(f):
    r = affine.reorder(F.array("o_orderkey", "o_custkey", F.col("o_custkey") % 3))
    return f.orders.select(F.col("o_orderkey").alias("id"), r[0].alias("x"), r[1].alias("y"), r[2].alias("z"))


@query("f11_soft_limit_and_fade", "id s:f w:f", """WITH v AS (SELECT o_orderkey AS id, (o_orderkey % 400) / 20.0::DOUBLE AS v, (o_orderkey % 100)::DOUBLE AS p FROM @orders),
g AS (SELECT *, pow(0.5::DOUBLE, -1 / (0.5::DOUBLE - 1)) AS joint FROM v)
SELECT id, CASE WHEN v < 10 THEN v ELSE pow(v + joint - 10, 0.5::DOUBLE) + 10 - pow(joint, 0.5::DOUBLE) END AS s,
exp(-(greatest(20 - p, p - 60, 0) / 5) * (greatest(20 - p, p - 60, 0) / 5) / 2) AS w FROM g""")
def _(f):
    v = (F.col("o_orderkey") % 400) / F.lit(20.0)
    d = scalar.distance_to_interval((F.col("o_orderkey") % 100).cast("double"), 20.0, 60.0) / 5.0
    return f.orders.select(F.col("o_orderkey").alias("id"), scalar.soft_limit(v, 10.0, 0.5).alias("s"), scalar.fade(d * d).alias("w"))


@query("f12_sigma_difference", "id s:f", """SELECT o_orderkey AS id, sqrt(greatest(0, pow((o_orderkey % 7) / 2.0::DOUBLE, 2) - 0.25)) AS s FROM @orders""")
def _(f):
    return f.orders.select(F.col("o_orderkey").alias("id"), scalar.sigma_difference_expr(F.lit(0.5), (F.col("o_orderkey") % 7).cast("double"), F.lit(2.0)).alias("s"))
