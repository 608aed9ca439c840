"""Queries over label volumes and tile graphs."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import labels, pixel, solve

EDGES = "SELECT CAST(0 AS BIGINT) AS graph, o_orderkey AS u, CAST(floor(o_orderkey / 58) * 58 AS BIGINT) + (o_orderkey * 7 + 3) % 58 AS v FROM @orders"
NODES = "SELECT CAST(0 AS BIGINT) AS graph, o_orderkey AS node FROM @orders"


@query("i2_components", "node component", f"""WITH e AS (SELECT u, v FROM ({EDGES}) WHERE v < (SELECT count(*) FROM @orders)), nodes AS ({NODES}),
b AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
r(node, component) AS (SELECT node, node FROM nodes UNION SELECT b.v, r.component FROM r JOIN b ON r.node = b.u WHERE r.component < b.v)
SELECT node, min(component) AS component FROM r GROUP BY node""")
def _(f):
    nodes = f.sql(NODES)
    edges = f.sql(EDGES).join(nodes.withColumnRenamed("node", "v"), ["graph", "v"], "left_semi")
    return solve.components(edges, nodes, ["graph"])


@query("i2_largest_component", "graph node", f"""WITH e AS (SELECT a AS u, b AS v FROM @matches WHERE a % 11 <> 5 GROUP BY ALL), x AS (SELECT u, v FROM e UNION ALL SELECT v, u FROM e),
nodes AS (SELECT u AS node FROM x UNION SELECT b FROM @matches UNION SELECT a FROM @matches), r(node, component) AS (SELECT node, node FROM nodes UNION SELECT x.v, r.component FROM r JOIN x ON r.node = x.u WHERE r.component < x.v),
c AS (SELECT node, min(component) AS component FROM r GROUP BY node), s AS (SELECT component FROM c GROUP BY component ORDER BY count(*) DESC, component LIMIT 1)
SELECT 0 AS graph, node FROM c JOIN s USING (component)""")
def _(f):
    pairs = f.matches.select(F.lit(0).cast("long").alias("graph"), "a", "b").distinct()
    nodes = pairs.select("graph", F.explode(F.array("a", "b")).alias("node")).distinct()
    edges = pairs.where("a % 11 <> 5").select("graph", F.col("a").alias("u"), F.col("b").alias("v"))
    return solve.largest_component(solve.components(edges, nodes, ["graph"]), ["graph"])


PRESENT = "SELECT DISTINCT stack, z - 1 AS a, z AS b, CAST(0.5 AS DOUBLE) AS shift FROM @series_shift WHERE z % 4 = 1 AND z >= 1"


@query("i3_connect_isolated", "stack a b shift:f is_default:b", f"""WITH e AS ({PRESENT}), ends AS (SELECT stack, a AS z FROM e UNION SELECT stack, b FROM e)
SELECT stack, a, b, shift, false AS is_default FROM e UNION ALL SELECT s.stack, s.z - 1, s.z, s.z * 0.25::DOUBLE, true FROM @series_shift s
WHERE s.z >= 1 AND NOT EXISTS (SELECT 1 FROM ends WHERE ends.stack = s.stack AND ends.z = s.z)""")
def _(f):
    return solve.connect_isolated(f.sql(PRESENT), f.series_shift, ["stack"], F.col("z") * 0.25)


@query("i5_label_volume", "dataset:s z y x v", """WITH on_ AS (SELECT dataset, z, y, x, (z * 20 + y) * 25 + x AS id FROM @em WHERE v > 100),
e AS (SELECT a.dataset, a.id AS u, b.id AS v FROM on_ a JOIN on_ b ON a.dataset = b.dataset AND (b.id = a.id + 500 OR (b.id = a.id + 25 AND b.z = a.z) OR (b.id = a.id + 1 AND b.y = a.y AND b.z = a.z))),
b AS (SELECT dataset, u, v FROM e UNION ALL SELECT dataset, v, u FROM e),
r(dataset, node, component) AS (SELECT dataset, id, id FROM on_ UNION SELECT b.dataset, b.v, r.component FROM r JOIN b ON r.dataset = b.dataset AND r.node = b.u WHERE r.component < b.v),
c AS (SELECT dataset, node, min(component) + 1 AS label FROM r GROUP BY dataset, node)
SELECT e.dataset, z, y, x, coalesce(label, 0) AS v FROM @em e LEFT JOIN c ON c.dataset = e.dataset AND c.node = (z * 20 + y) * 25 + x""")
def _(f):
    return labels.label_volume(f.em, F.col("v") > 100, pixel.extents(f.em))


@query("i6_distance_to_boundary", "dataset:s z y x v", """WITH n AS (SELECT dataset, max(z) + 1 AS nz FROM @labels_vol GROUP BY dataset),
pairs AS (SELECT a.dataset, a.z, a.y, a.x, 'x' AS o FROM @labels_vol a LEFT JOIN @labels_vol b ON b.dataset = a.dataset AND b.z = a.z AND b.y = a.y AND b.x = a.x + 1 WHERE b.v IS NULL OR b.v <> a.v
 UNION ALL SELECT dataset, z, y, -1, 'x' FROM @labels_vol WHERE x = 0
 UNION ALL SELECT a.dataset, a.z, a.y, a.x, 'y' FROM @labels_vol a LEFT JOIN @labels_vol b ON b.dataset = a.dataset AND b.z = a.z AND b.y = a.y + 1 AND b.x = a.x WHERE b.v IS NULL OR b.v <> a.v
 UNION ALL SELECT dataset, z, -1, x, 'y' FROM @labels_vol WHERE y = 0
 UNION ALL SELECT a.dataset, a.z, a.y, a.x, 'z' FROM @labels_vol a LEFT JOIN @labels_vol b ON b.dataset = a.dataset AND b.z = a.z + 1 AND b.y = a.y AND b.x = a.x WHERE b.v IS NULL OR b.v <> a.v
 UNION ALL SELECT dataset, -1, y, x, 'z' FROM @labels_vol WHERE z = 0),
d AS (SELECT p.dataset, p.z, p.y, p.x, min(
 16 * (CASE WHEN o = 'x' THEN (2 * p.x + 1 - 2 * (f.x + 1)) ELSE greatest(0, 2 * abs(p.x - f.x) - 1) END) ** 2 +
 16 * (CASE WHEN o = 'y' THEN (2 * p.y + 1 - 2 * (f.y + 1)) ELSE greatest(0, 2 * abs(p.y - f.y) - 1) END) ** 2 +
 100 * (CASE WHEN o = 'z' THEN (2 * p.z + 1 - 2 * (f.z + 1)) ELSE greatest(0, 2 * abs(p.z - f.z) - 1) END) ** 2) AS d2
 FROM @labels_vol p JOIN pairs f USING (dataset) GROUP BY ALL)
SELECT dataset, z, y, x, least(65535, floor(sqrt(d2::DOUBLE) + 0.5)) AS v FROM d""")
def _(f):
    return labels.distance_to_boundary(f.labels_vol, {"x": 8.0, "y": 8.0, "z": 20.0}, pixel.extents(f.labels_vol))
