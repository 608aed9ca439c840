"""Queries over irregular points."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import grid, matching, points, stats

AX = ["x", "y", "z"]
TARGETS = "SELECT stack, pid, x + 1 AS x, y, z FROM @points"
# targets go to the cells of 25 that their surroundings touch, points to their own
NEAR = f"""WITH t AS (SELECT DISTINCT stack, x, y, z FROM ({TARGETS})),
tx AS (SELECT *, unnest(range(CAST(floor((x - 12) / 25) AS BIGINT), CAST(floor((x + 12) / 25) AS BIGINT) + 1)) AS cx FROM t),
ty AS (SELECT *, unnest(range(CAST(floor((y - 12) / 25) AS BIGINT), CAST(floor((y + 12) / 25) AS BIGINT) + 1)) AS cy FROM tx),
p AS (SELECT stack, x, y, z, intensity, CAST(floor(x / 25) AS BIGINT) AS cx, CAST(floor(y / 25) AS BIGINT) AS cy FROM @points),
n AS (SELECT t.stack, t.x, t.y, t.z, p.intensity AS v, (t.x - p.x) ** 2 + (t.y - p.y) ** 2 + (t.z - p.z) ** 2 AS d2 FROM ty t JOIN p ON p.stack = t.stack AND p.cx = t.cx AND p.cy = t.cy),
r AS (SELECT * FROM n WHERE d2 <= 144)"""


def w19(name, kind, value, fill, **options):
    @query(f"w19_{name}", "stack pid v:f", f"""{NEAR}, f AS (SELECT stack, x, y, z, {value} AS v FROM r GROUP BY ALL)
    SELECT q.stack, pid, coalesce(f.v, {fill}) AS v FROM ({TARGETS}) q LEFT JOIN f USING (stack, x, y, z)""")
    def _(f):
        rows = f.points.select("stack", "pid", *AX, F.col("intensity").alias("v"))
        return points.radius_filter(rows, f.sql(TARGETS), ["stack"], AX, 12.0, kind, fill=-1.0, **options)


w19("mean", "mean", "avg(v)", -1)
w19("median", "median", "median(v)", -1)
w19("density", "density", "count(*)", 0)
w19("gauss_weights", "gauss", "sum(v * exp(-d2 / 50.0::DOUBLE)) / sum(exp(-d2 / 50.0::DOUBLE))", -1, sigma=5.0)
w19("gauss_samples", "gauss", "sum(v * exp(-d2 / 50.0::DOUBLE)) / count(*)", -1, sigma=5.0, normalize="samples")
w19("gauss_plain", "gauss", "sum(v * exp(-d2 / 50.0::DOUBLE))", -1, sigma=5.0, normalize=None)

@query("x5_custom_filter", "stack pid v:f", f"""{NEAR}, f AS (SELECT stack, x, y, z, sum(v / (1 + d2)) AS v FROM r GROUP BY ALL)
SELECT q.stack, pid, coalesce(f.v, 0) AS v FROM ({TARGETS}) q LEFT JOIN f USING (stack, x, y, z)""")
def _(f):
    rows = f.points.select("stack", "pid", *AX, F.col("intensity").alias("v"))
    return points.radius_filter(rows, f.sql(TARGETS), ["stack"], AX, 12.0, points.WeightedSum(lambda d2: 1.0 / (1.0 + d2)))


RASTER = """WITH b AS (SELECT stack, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM @points GROUP BY stack),
g AS (SELECT stack, ix, iy, x0 + ix * 8.0::DOUBLE AS x, y0 + iy * 8.0::DOUBLE AS y FROM b, unnest(range(0, 100)) AS a(ix), unnest(range(0, 100)) AS c(iy) WHERE x0 + ix * 8 <= x1 AND y0 + iy * 8 <= y1),
q AS (SELECT p.*, x0, y0, unnest(range(CAST(ceil((x - x0 - 2) / 8) AS BIGINT), CAST(floor((x - x0 + 2) / 8) AS BIGINT) + 1)) AS ix FROM @points p JOIN b USING (stack)),
q2 AS (SELECT *, unnest(range(CAST(ceil((y - y0 - 2) / 8) AS BIGINT), CAST(floor((y - y0 + 2) / 8) AS BIGINT) + 1)) AS iy FROM q),
n AS (SELECT g.stack, g.ix, g.iy, pid, intensity, (g.x - p.x) ** 2 + (g.y - p.y) ** 2 AS d2 FROM g JOIN q2 p ON p.stack = g.stack AND p.ix = g.ix AND p.iy = g.iy)"""


def plane(f):
    rows = f.points.select("stack", "pid", "x", "y", F.col("intensity").alias("v"))
    return rows, points.raster(stats.bounding_box(rows, ["stack"], ["x", "y"]), ["stack"], {"x": 8.0, "y": 8.0})


@query("t29_rasterize_nearest", "stack ix iy v:f", RASTER + """, best AS (SELECT stack, ix, iy, arg_min(intensity, (d2, pid)) AS v FROM n WHERE d2 <= 4 GROUP BY ALL)
SELECT g.stack, g.ix, g.iy, coalesce(v, 0) AS v FROM g LEFT JOIN best USING (stack, ix, iy)""")
def _(f):
    rows, spots = plane(f)
    return points.rasterize(rows, spots, ["stack"], ["x", "y"], 2.0)


@query("t29_rasterize_mean", "stack ix iy v:f", RASTER + """, best AS (SELECT stack, ix, iy, avg(intensity) AS v FROM n WHERE d2 <= 4 GROUP BY ALL)
SELECT g.stack, g.ix, g.iy, coalesce(v, 0) AS v FROM g LEFT JOIN best USING (stack, ix, iy)""")
def _(f):
    rows, spots = plane(f)
    return points.rasterize(rows, spots, ["stack"], ["x", "y"], 2.0, "mean")


@query("t28_place_points", "stack pid x:f y:f z:f", """SELECT stack, pid, x + ox - oz * 0.5::DOUBLE AS x, y + oy AS y, z + oz AS z FROM @points JOIN (SELECT tile AS stack, ox, oy, oz FROM @tiles) USING (stack)""")
def _(f):
    return points.place_points(f.points, f.sql("SELECT tile AS stack, ox, oy, oz FROM @tiles"), {"x": 0.5})


@query("m2_renumber", "stack pid id", "SELECT stack, pid, row_number() OVER (PARTITION BY stack ORDER BY z, y, x, pid) - 1 AS id FROM @points")
def _(f):
    return points.renumber(f.points, ["stack"], ["z", "y", "x", "pid"])


DESCRIPTORS = """WITH n AS (SELECT a.stack, a.pid AS fid, b.pid AS nid, b.x, b.y, b.z, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 AS dd FROM @points a JOIN @points b
ON a.stack = b.stack AND a.pid <> b.pid AND abs(a.x - b.x) <= 40 AND abs(a.y - b.y) <= 40 AND abs(a.z - b.z) <= 40 WHERE (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 <= 1600),
k AS (SELECT stack, fid, min({'d': dd, 'p': nid, 'x': x, 'y': y, 'z': z}, 3) AS l FROM n GROUP BY stack, fid),
d AS (SELECT stack, fid, sqrt(l[1].d) AS d1, sqrt(l[2].d) AS d2, sqrt(l[3].d) AS d3, sqrt((l[1].x - l[2].x) ** 2 + (l[1].y - l[2].y) ** 2 + (l[1].z - l[2].z) ** 2) AS e12,
sqrt((l[1].x - l[3].x) ** 2 + (l[1].y - l[3].y) ** 2 + (l[1].z - l[3].z) ** 2) AS e13, sqrt((l[2].x - l[3].x) ** 2 + (l[2].y - l[3].y) ** 2 + (l[2].z - l[3].z) ** 2) AS e23 FROM k)"""


@query("m10_geometric_descriptors", "stack fid d1:f d2:f d3:f e12:f e13:f e23:f", DESCRIPTORS + " SELECT * FROM d")
def _(f):
    found = points.geometric_descriptors(f.points, ["stack"], AX, 10.0)
    names = ["d1", "d2", "d3", "e12", "e13", "e23"]
    return found.select("stack", "fid", *[F.col("desc")[i].alias(n) for i, n in enumerate(names)])


@query("m4_match_geometric", "stack a b", DESCRIPTORS + """, u AS (SELECT *, count(*) OVER (PARTITION BY stack, d1, d2, d3, e12, e13, e23) AS n FROM d)
SELECT stack, fid AS a, -fid AS b FROM u WHERE n = 1""")
def _(f):
    here = points.geometric_descriptors(f.points, ["stack"], AX, 10.0)
    there = here.withColumn("fid", -F.col("fid"))
    return points.match_geometric(here, there, ["stack"])


MOVED = "SELECT stack, pid, x + 0.75 AS x, y - 0.5 AS y, z + 0.25 AS z FROM @points"
STEP = """n{i} AS (SELECT a.stack, a.pid AS a, arg_min(b.pid, ((a.x + m.tx - b.x) ** 2 + (a.y + m.ty - b.y) ** 2 + (a.z + m.tz - b.z) ** 2, b.pid)) AS b
 FROM @points a JOIN m{p} m USING (stack) JOIN q b ON b.stack = a.stack AND abs(a.x + m.tx - b.x) <= 2 AND abs(a.y + m.ty - b.y) <= 2 AND abs(a.z + m.tz - b.z) <= 2
 WHERE (a.x + m.tx - b.x) ** 2 + (a.y + m.ty - b.y) ** 2 + (a.z + m.tz - b.z) ** 2 <= 4 GROUP BY a.stack, a.pid),
m{i} AS (SELECT stack, count(*) AS n, avg(q.x - p.x) AS tx, avg(q.y - p.y) AS ty, avg(q.z - p.z) AS tz FROM n{i} JOIN @points p ON p.stack = n{i}.stack AND p.pid = n{i}.a
 JOIN q ON q.stack = n{i}.stack AND q.pid = n{i}.b GROUP BY n{i}.stack)"""


@query("m12_icp", "stack n tx:f ty:f tz:f", f"WITH q AS ({MOVED}), m0 AS (SELECT DISTINCT stack, 0.0::DOUBLE AS tx, 0.0::DOUBLE AS ty, 0.0::DOUBLE AS tz FROM @points), " +
       ", ".join(STEP.format(i=i, p=i - 1).replace("SELECT stack, count", f"SELECT n{i}.stack, count") for i in (1, 2)) + " SELECT stack, n, tx, ty, tz FROM m2")
def _(f):
    found = points.icp(f.points, f.sql(MOVED), ["stack"], "translation", 2.0, rounds=2)
    return found.select("stack", "n", *[F.col("m")[i].alias(n) for i, n in ((3, "tx"), (7, "ty"), (11, "tz"))])


CONTROL = "SELECT stack, pid AS mid, x + 0.5 AS px, y AS py, z AS pz, x + 2.5 AS qx, y + intensity AS qy, z - 1 AS qz FROM @points"


@query("m13_mls_warp", "stack pid x:f y:f z:f", f"""WITH n AS (SELECT a.stack, a.pid, a.x, a.y, a.z, 1.0::DOUBLE / ((a.x - px) ** 2 + (a.y - py) ** 2 + (a.z - pz) ** 2) AS w, qx - px AS dx, qy - py AS dy, qz - pz AS dz
FROM @points a JOIN ({CONTROL}) c ON c.stack = a.stack AND abs(a.x - px) <= 15 AND abs(a.y - py) <= 15 AND abs(a.z - pz) <= 15 WHERE (a.x - px) ** 2 + (a.y - py) ** 2 + (a.z - pz) ** 2 <= 225)
SELECT stack, pid, x + sum(w * dx) / sum(w) AS x, y + sum(w * dy) / sum(w) AS y, z + sum(w * dz) / sum(w) AS z FROM n GROUP BY stack, pid, x, y, z""")
def _(f):
    return points.mls_warp(f.points, f.sql(CONTROL), ["stack"], 15.0, "translation")
