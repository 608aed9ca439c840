"""Queries over joins."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import grid, joins, matching, pixel, stats

SLICES = "SELECT DISTINCT stack, z FROM @series_shift"


@query("j1_slice_pairs", "stack i j", f"WITH s AS ({SLICES}) SELECT a.stack, a.z AS i, b.z AS j FROM s a JOIN s b ON a.stack = b.stack AND b.z - a.z > 0 AND b.z - a.z < 5")
def _(f):
    return joins.slice_pairs(f.series_shift, ["stack"], 5)


@query("j1_slice_pairs_inclusive", "stack i j", f"WITH s AS ({SLICES}) SELECT a.stack, a.z AS i, b.z AS j FROM s a JOIN s b ON a.stack = b.stack AND b.z - a.z > 0 AND b.z - a.z <= 5")
def _(f):
    return joins.slice_pairs(f.series_shift, ["stack"], 5, inclusive=True)


ORDER_SLABS = "SELECT o_orderkey AS ord, concat('slab', CAST(o_orderkey AS STRING)) AS dataset, CAST(2 AS BIGINT) AS top, 20 + o_custkey % 5 AS bot FROM @orders"


@query("j2_face_pairs", "pair a:s b:s", """SELECT o_orderkey + 1 AS pair, concat('slab', CAST(o_orderkey AS STRING), '/bot') AS a, concat('slab', CAST(o_orderkey + 1 AS STRING), '/top') AS b
FROM @orders WHERE o_orderkey < (SELECT max(o_orderkey) FROM @orders)""")
def _(f):
    return joins.face_pairs(f.sql(ORDER_SLABS))


@query("j3_zip_lists", "k a b", "SELECT o_orderkey AS k, o_custkey AS a, o_orderkey * 2 AS b FROM @orders")
def _(f):
    left = f.orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("a"))
    return joins.zip_lists(left, f.orders.select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") * 2).alias("b")), "k")


@query("j4_overlap_pairs", "a b overlap_x overlap_y overlap_z", """SELECT p.tile AS a, q.tile AS b, least(p.ox + p.sx, q.ox + q.sx) - greatest(p.ox, q.ox) AS overlap_x,
least(p.oy + p.sy, q.oy + q.sy) - greatest(p.oy, q.oy) AS overlap_y, least(p.oz + p.sz, q.oz + q.sz) - greatest(p.oz, q.oz) AS overlap_z
FROM @tiles p JOIN @tiles q ON p.tile < q.tile AND p.ox < q.ox + q.sx AND q.ox < p.ox + p.sx AND p.oy < q.oy + q.sy AND q.oy < p.oy + p.sy AND p.oz < q.oz + q.sz AND q.oz < p.oz + p.sz""")
def _(f):
    return joins.overlap_pairs(f.tiles, 100)


BLOCKS = "SELECT o_orderkey AS block, (o_orderkey % 500) * 16 AS oz, CAST(16 AS BIGINT) AS sz FROM @orders"
ZOFF = "SELECT ord, coalesce(sum(bot - top + 1) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS zoff, bot - top + 1 AS depth FROM @slabs"


@query("j5_blocks_of_slabs", "block ord zoff", f"""WITH s AS ({ZOFF}) SELECT block, ord, zoff FROM ({BLOCKS}) b JOIN s ON NOT (oz > zoff + depth OR oz + sz < zoff)""")
def _(f):
    return joins.blocks_of_slabs(f.sql(BLOCKS), f.slabs, 32)


@query("p17_export_plan", "gz n slabs", f"""WITH s AS ({ZOFF}), b AS (SELECT dataset, z // 4 AS gz, y // 8 AS gy, x // 10 AS gx FROM @em GROUP BY ALL)
SELECT gz, count(DISTINCT (dataset, gy, gx)) AS n, count(*) AS slabs FROM b JOIN s ON NOT (gz * 4 > zoff + depth OR least(gz * 4 + 4, 10) < zoff) GROUP BY gz""")
def _(f):
    from voxelframe.plans.export import plan_export
    blocks = grid.grid(pixel.extents(f.em), {"z": 4, "y": 8, "x": 10}).withColumnRenamed("dataset", "volume")
    plan = plan_export(blocks, f.slabs, 32)
    return plan.groupBy("gz").agg(F.count_distinct("volume", "gy", "gx").alias("n"), F.count("*").alias("slabs"))


@query("j6_layer_model_join", "dataset:s z y x v a", "SELECT dataset, z, y, x, v, a FROM @em JOIN (SELECT dataset, z, max(v) AS a FROM @em GROUP BY dataset, z) USING (dataset, z)")
def _(f):
    return joins.join_layer_models(f.em, f.em.groupBy("dataset", "z").agg(F.max("v").alias("a")))


@query("j7_field_join", "dataset:s z y x v m hmin:f", "SELECT dataset, z, y, x, e.v, m.v AS m, hmin FROM @em e JOIN @mask m USING (dataset, z, y, x) JOIN @heightfield USING (dataset, y, x)")
def _(f):
    return joins.join_field(f.em.join(f.mask.withColumnRenamed("v", "m"), ["dataset", "z", "y", "x"]), f.heightfield.drop("m"))


@query("j8_match_features", "pair a b d:f ratio:f", """WITH a AS (SELECT fid, CAST(descr AS DOUBLE[]) AS d FROM @descriptors WHERE side = 0), b AS (SELECT fid, CAST(descr AS DOUBLE[]) AS d FROM @descriptors WHERE side = 1),
p AS (SELECT a.fid AS a, b.fid AS b, list_distance(a.d, b.d) AS d FROM a, b), r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS r, lead(d) OVER (PARTITION BY a ORDER BY d, b) AS d2 FROM p),
k AS (SELECT 0 AS pair, a, b, d, d / d2 AS ratio, count(*) OVER (PARTITION BY b) AS hits FROM r WHERE r = 1 AND d < d2 * 0.92::DOUBLE)
SELECT pair, a, b, d, ratio FROM k WHERE hits = 1""")
def _(f):
    rows = f.descriptors.select("pair", "fid", "side", F.col("descr").cast("array<double>").alias("desc"))
    return matching.match_features(rows.where("side = 0"), rows.where("side = 1"), ["pair"], 0.92, chunk=100)


NEAR = """WITH a AS (SELECT stack AS pair, pid, x, y, z FROM @points WHERE stack < 7), b AS (SELECT stack - 1 AS pair, pid, x, y, z FROM @points WHERE stack > 1),
n AS (SELECT pair, a.pid AS a, b.pid AS b, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 AS d2 FROM a JOIN b USING (pair)
WHERE abs(a.x - b.x) <= 6 AND abs(a.y - b.y) <= 6 AND abs(a.z - b.z) <= 6)"""


def sides(f):
    a = f.points.where("stack < 7").withColumnRenamed("stack", "pair")
    return a, f.points.where("stack > 1").withColumn("stack", F.col("stack") - 1).withColumnRenamed("stack", "pair")


@query("j9_nearest_point", "pair a b d2:f", NEAR + """ SELECT pair, a, arg_min(b, (d2, b)) AS b, min(d2) AS d2 FROM n WHERE d2 <= 36 GROUP BY pair, a""")
def _(f):
    a, b = sides(f)
    return joins.nn_join(a, b, ["pair"], ["x", "y", "z"], 6.0)


@query("j10_look_up_points", "pair a b px:f qz:f", NEAR + """, m AS (SELECT pair, a, arg_min(b, (d2, b)) AS b FROM n WHERE d2 <= 36 GROUP BY pair, a)
SELECT m.pair, m.a, m.b, a.x AS px, b.z AS qz FROM m JOIN a ON a.pair = m.pair AND a.pid = m.a JOIN b ON b.pair = m.pair AND b.pid = m.b""")
def _(f):
    a, b = sides(f)
    return joins.look_up_points(joins.nn_join(a, b, ["pair"], ["x", "y", "z"], 6.0), a, b, ["pair"])


ORIENTED = "SELECT CASE WHEN a % 3 = 0 THEN b ELSE a END AS a, CASE WHEN a % 3 = 0 THEN a ELSE b END AS b, mid, px, py, qx, qy FROM @matches"


@query("j11_flip_fallback", "a b mid px:f py:f qx:f qy:f", f"WITH m AS ({ORIENTED}) SELECT * FROM m UNION ALL SELECT b AS a, a AS b, mid, qx AS px, qy AS py, px AS qx, py AS qy FROM m")
def _(f):
    return joins.with_flipped(f.sql(ORIENTED))


BLOCKED = "SELECT o_orderkey % 3 AS pair, o_custkey % 400 AS a, o_custkey % 400 + o_orderkey % 2 AS b, o_orderkey % 50 AS block FROM @orders"
# block by block, as lists of the matches kept so far
MERGED = f"""WITH every AS (SELECT DISTINCT pair, a, b, block FROM ({BLOCKED})), sets AS (SELECT pair, block, list({{'a': a, 'b': b, 'block': block}}) AS l FROM every GROUP BY pair, block),
k AS (SELECT pair, CAST(-1 AS BIGINT) AS t, CAST([] AS STRUCT(a BIGINT, b BIGINT, block BIGINT)[]) AS kept FROM (SELECT DISTINCT pair FROM every)
 UNION ALL SELECT k.pair, k.t + 1, CASE WHEN l IS NULL THEN kept ELSE list_concat(kept, list_filter(l, lambda m: NOT list_contains(list_transform(kept, lambda x: x.a), m.a)
 AND NOT list_contains(list_transform(kept, lambda x: x.b), m.b))) END FROM k LEFT JOIN sets ON sets.pair = k.pair AND sets.block = k.t + 1 WHERE k.t < 49),
merged AS (SELECT pair, unnest(kept, recursive := true) FROM k WHERE t = 49)"""


@query("j12_merge_matches", "pair a b block", MERGED + " SELECT pair, a, b, block FROM merged")
def _(f):
    return joins.merge_matches(f.sql(BLOCKED), ["pair"])


@query("j12_merge_counts", "pair n added same different", MERGED + """, first AS (SELECT pair, a, b, min(block) AS kept FROM merged GROUP BY pair, a, b)
SELECT pair, count(*) AS n, count(*) FILTER (WHERE kept = block) AS added, count(*) FILTER (WHERE kept < block) AS same, count(*) FILTER (WHERE kept IS NULL) AS different
FROM every LEFT JOIN first USING (pair, a, b) GROUP BY pair""")
def _(f):
    rows = f.sql(BLOCKED)
    return joins.merge_counts(rows, joins.merge_matches(rows, ["pair"]), ["pair"])
