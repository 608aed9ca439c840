"""Queries over grid keys."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import grid, pixel

G = "SELECT id, oz, oy, ox, least(4, nz - oz) AS sz, least(16, ny - oy) AS sy, least(20, nx - ox) AS sx, oz // 2 AS gz, oy // 8 AS gy, ox // 10 AS gx FROM @grid_orders, unnest(range(0, nz, 4)) AS a(oz), unnest(range(0, ny, 16)) AS b(oy), unnest(range(0, nx, 20)) AS c(ox)"


@query("g1_grid_blocks", "id oz oy ox sz sy sx gz gy gx", G)
def _(f):
    return grid.grid(f.grid_orders, {"z": 4, "y": 16, "x": 20}, {"z": 2, "y": 8, "x": 10}, ["id"])


@query("g2_offsets", "id x y", "SELECT id, x, y FROM @grid_orders, unnest(range(nz, nx + 1, 7)) AS a(x), unnest(range(2, ny + 1, 5)) AS b(y)")
def _(f):
    boxes = f.grid_orders.select("id", F.col("nz").alias("min_x"), F.col("nx").alias("max_x"), F.lit(2).cast("long").alias("min_y"), F.col("ny").alias("max_y"))
    return grid.offsets(boxes, {"x": 7, "y": 5}, ["id"])


@query("g3_cells_and_bounds", "id cell low high", "SELECT id, (id - 3) // 8 AS cell, floor(nx * 0.125::DOUBLE) AS low, ceil(nx * 0.125::DOUBLE) AS high FROM @grid_orders WHERE id >= 3")
def _(f):
    c = F.col
    return f.grid_orders.where("id >= 3").select("id", grid.grid_cell(c("id"), F.lit(3), 8).alias("cell"), grid.floor_scaled(c("nx"), 0.125).alias("low"), grid.ceil_scaled(c("nx"), 0.125).alias("high"))


@query("g4_halo", "dataset:s gz gy gx n total", """WITH b AS (SELECT DISTINCT dataset, z // 4 AS gz, y // 8 AS gy, x // 10 AS gx FROM @em)
SELECT b.dataset, gz, gy, gx, count(*) AS n, sum(v) AS total FROM b JOIN @em e ON e.dataset = b.dataset AND z BETWEEN gz * 4 - 1 AND gz * 4 + 4
AND y BETWEEN gy * 8 - 2 AND gy * 8 + 9 AND x BETWEEN gx * 10 - 3 AND gx * 10 + 12 GROUP BY ALL""")
def _(f):
    spread = grid.with_halo(f.em, {"z": 4, "y": 8, "x": 10}, {"z": 1, "y": 2, "x": 3}, pixel.extents(f.em))
    return spread.groupBy("dataset", "gz", "gy", "gx").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query("g5_block_columns", "dataset:s gy gx n first last", "SELECT dataset, y // 8 AS gy, x // 10 AS gx, count(DISTINCT z // 2) AS n, min(z // 2) AS first, max(z // 2) AS last FROM @em GROUP BY dataset, y // 8, x // 10")
def _(f):
    blocks = grid.grid(pixel.extents(f.em), {"z": 2, "y": 8, "x": 10})
    return grid.block_columns(blocks).select("dataset", "gy", "gx", "n", F.element_at("layers", 1).alias("first"), F.element_at("layers", -1).alias("last"))


@query("g6_z_batches", "id batch min_z max_z", """WITH b AS (SELECT id, unnest(range(1, 6)) AS batch, CAST(ceil((nx * 30) / 64.0) AS BIGINT) AS n FROM @grid_orders),
s AS (SELECT *, (n // 5 + CASE WHEN batch - 1 < n % 5 THEN 1 ELSE 0 END) * 64 AS size FROM b)
SELECT id, batch, coalesce(sum(size) OVER (PARTITION BY id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS min_z,
sum(size) OVER (PARTITION BY id ORDER BY batch) - 1 AS max_z FROM s""")
def _(f):
    rows = f.grid_orders.withColumn("batch", F.explode(F.sequence(F.lit(1), F.lit(5))))
    return rows.select("id", "batch", *grid.z_batch(F.col("nx") * 30, 64, F.col("batch"), F.lit(5)))


@query("g9_overlap_blocks", "pair block_x block_y block_z na nb", """WITH a AS (SELECT stack AS pair, x, y, z FROM @points WHERE stack < 7), b AS (SELECT stack - 1 AS pair, x, y, z FROM @points WHERE stack > 1),
box AS (SELECT pair, greatest(a.x0, b.x0) AS x0, least(a.x1, b.x1) AS x1, greatest(a.y0, b.y0) AS y0, least(a.y1, b.y1) AS y1, greatest(a.z0, b.z0) AS z0, least(a.z1, b.z1) AS z1
FROM (SELECT pair, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM a GROUP BY pair) a
JOIN (SELECT pair, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, min(z) AS z0, max(z) AS z1 FROM b GROUP BY pair) b USING (pair)),
cells AS (SELECT *, unnest(range(0, 20)) AS block_x FROM box), c2 AS (SELECT *, unnest(range(0, 20)) AS block_y FROM cells), c3 AS (SELECT *, unnest(range(0, 8)) AS block_z FROM c2),
na AS (SELECT pair, block_x, block_y, block_z, count(*) AS na FROM c3 JOIN a USING (pair) WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1
 AND floor((x - x0) / 50) IN (block_x, block_x + 1) AND floor((y - y0) / 50) IN (block_y, block_y + 1) AND floor((z - z0) / 10) IN (block_z, block_z + 1) GROUP BY ALL),
nb AS (SELECT pair, block_x, block_y, block_z, count(*) AS nb FROM c3 JOIN b USING (pair) WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 AND z BETWEEN z0 AND z1
 AND floor((x - x0) / 50) IN (block_x, block_x + 1) AND floor((y - y0) / 50) IN (block_y, block_y + 1) AND floor((z - z0) / 10) IN (block_z, block_z + 1) GROUP BY ALL)
SELECT * FROM na JOIN nb USING (pair, block_x, block_y, block_z) WHERE na > 10 AND nb > 10""")
def _(f):
    a = f.points.where("stack < 7").withColumnRenamed("stack", "pair")
    b = f.points.where("stack > 1").withColumn("stack", F.col("stack") - 1).withColumnRenamed("stack", "pair")
    return grid.overlap_blocks(a, b, ["pair"], {"x": 100.0, "y": 100.0, "z": 20.0})


@query("g10_sliding_blocks", "stack block n", """SELECT stack, block, count(*) AS n FROM @points, unnest(range(0, 40)) AS t(block)
WHERE z >= block * 5 AND z < block * 5 + 10 GROUP BY stack, block""")
def _(f):
    return grid.sliding_blocks(f.points, "z", 10.0).groupBy("stack", "block").agg(F.count("*").alias("n"))
