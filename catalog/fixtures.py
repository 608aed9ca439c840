"""Fixture views over the driver tables, as SQL both engines read alike.

``k`` is the contiguous order key. A slab is 25 x 20 x 10 voxels; the number of
slabs grows with the table.
"""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

FIXTURES = {
    "keys": """SELECT o_orderkey AS k, concat('s', CAST(CAST(floor(o_orderkey / 5000) AS BIGINT) AS STRING)) AS dataset,
        CAST(floor(o_orderkey / 5000) AS BIGINT) AS slab,
        CAST(floor((o_orderkey % 5000) / 500) AS BIGINT) AS z,
        CAST(floor((o_orderkey % 500) / 25) AS BIGINT) AS y, o_orderkey % 25 AS x,
        CAST(floor(o_totalprice) AS BIGINT) % 100 AS p FROM @orders""",
    "em": """SELECT dataset, z, y, x, CAST(CASE WHEN x < 2 OR y < 2 THEN 0 ELSE 40 + p + z % 17 END AS BIGINT) AS v FROM @keys""",
    "em_b": """SELECT dataset, z, y, x + 2 AS x, CAST(CASE WHEN v > 0 THEN v + 3 ELSE 0 END AS BIGINT) AS v FROM @em""",
    "mask": """SELECT dataset, z, y, x, CAST(CASE WHEN k % 11 = 0 THEN 0 ELSE 1 END AS BIGINT) AS v FROM @keys""",
    "labels_vol": """SELECT dataset, z, y, x,
        CAST(1 + (CAST(floor(x / 5) AS BIGINT) * 3 + CAST(floor(y / 5) AS BIGINT) + CAST(floor((z + slab) / 4) AS BIGINT)) % 7 AS BIGINT) AS v FROM @keys""",
    "cost_plane": """SELECT dataset, z, y, x,
        CAST(least(250, 40 * abs(z - (3 + CAST(floor(x / 8) AS BIGINT)))) + p % 5 AS BIGINT) AS v FROM @keys""",
    "columns_xy": """SELECT dataset, y, x, CAST(sum(k) % 3 AS BIGINT) AS r, CAST(sum(p) % 8 AS BIGINT) AS q,
        CAST(max(z) AS BIGINT) AS top FROM @keys GROUP BY dataset, y, x""",
    "heightfield": """SELECT dataset, y, x, CAST(0.25 + r * 0.5 AS DOUBLE) AS hmin,
        CAST(top - 0.25 - (r % 2) * 0.25 - q * 0.03125 AS DOUBLE) AS hmax,
        CAST(CASE WHEN q = 0 THEN 0 ELSE 1 END AS DOUBLE) AS m FROM @columns_xy""",
    "posfield": """SELECT dataset, y AS iy, x AS ix, CAST(x + 0.5 + (y % 4) * 0.125 + q * 0.0625 AS DOUBLE) AS tx,
        CAST(y - 0.25 + (x % 3) * 0.125 AS DOUBLE) AS ty FROM @columns_xy""",
    "points": """SELECT CAST(l_linenumber AS BIGINT) AS stack, ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey AS pid,
        CAST(l_partkey % 500 AS DOUBLE) AS x, CAST(l_orderkey % 400 AS DOUBLE) AS y, CAST(l_suppkey % 60 AS DOUBLE) AS z,
        CAST(max(l_quantity) AS DOUBLE) AS intensity FROM @lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey""",
    "tiles": """SELECT s_suppkey AS tile, (s_suppkey % 10) * 90 AS ox, (CAST(floor(s_suppkey / 10) AS BIGINT) % 10) * 90 AS oy,
        CAST(floor(s_suppkey / 100) AS BIGINT) * 90 AS oz, 100 AS sx, 100 AS sy, 100 AS sz FROM @supplier""",
    "matches": """SELECT CAST(floor(k / 500) AS BIGINT) AS a, CAST(floor(k / 500) AS BIGINT) + 1 AS b, k AS mid,
        CAST(x AS DOUBLE) AS px, CAST(y AS DOUBLE) AS py,
        CAST(1.01 * x - 0.02 * y + 3 + CASE WHEN k % 7 = 0 THEN 40 ELSE 0 END AS DOUBLE) AS qx,
        CAST(0.02 * x + 1.01 * y - 1 + CASE WHEN k % 7 = 0 THEN 40 ELSE 0 END AS DOUBLE) AS qy,
        CAST(1 AS DOUBLE) AS w, CASE WHEN k % 7 = 0 THEN 0 ELSE 1 END AS planted FROM @keys""",
    "series_shift": """SELECT CAST(k % 5 AS BIGINT) AS stack, CAST(floor(k / 500) AS BIGINT) AS z,
        avg(CAST(0.5 * floor(k / 500) + (k % 13) * 0.01 AS DOUBLE)) AS tx, avg(CAST(-0.2 * floor(k / 500) AS DOUBLE)) AS ty
        FROM @keys GROUP BY CAST(k % 5 AS BIGINT), CAST(floor(k / 500) AS BIGINT)""",
    "slabs": """SELECT n_nationkey AS ord, concat('slab', CAST(n_nationkey AS STRING)) AS dataset, CAST(2 AS BIGINT) AS top,
        CAST(20 + n_regionkey AS BIGINT) AS bot FROM @nation""",
    "descriptors": """SELECT vec_id AS fid, CAST(vec_id % 2 AS BIGINT) AS side, vec_id % 1 AS pair, embedding AS descr FROM @embeddings""",
    "grid_orders": """SELECT o_orderkey AS id, 20 + o_orderkey % 60 AS nx, 10 + o_orderkey % 37 AS ny, 1 + o_orderkey % 23 AS nz FROM @orders""",
}

# Ids made of several keys: the table, the factor of every key, and the key that is widened where the id would leave 64 bits.
WIDE = {"points": ("lineitem", {"l_orderkey": 10 ** 12, "l_linenumber": 10 ** 11, "l_partkey": 10 ** 5, "l_suppkey": 1}, "l_orderkey")}
