"""Queries over sources, sinks, block form and job lists."""

import uuid

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import blocks, pixel
from voxelframe.session import ensure_checkpoint_dir
from voxelframe.sources import volumes

VOX = "dataset:s z y x v"
EM = "SELECT dataset, z, y, x, v FROM @em"
BLOCK = {"z": 4, "y": 8, "x": 10}


def folder(f, name):
    """A fresh folder in the shared storage of the session."""
    return f"{ensure_checkpoint_dir(f.spark)}/voxelframe-{name}-{uuid.uuid4().hex}"


def slices(f, dtype="u8", byteorder="little"):
    return volumes.export_slices(f.em, pixel.extents(f.em), dtype=dtype, byteorder=byteorder)


@query("s1_slices_cropped", VOX, "SELECT dataset, z - 1 AS z, y - 4 AS y, x - 3 AS x, v FROM @em WHERE z >= 1 AND y >= 4 AND y < 16 AND x >= 3 AND x < 20")
def _(f):
    return volumes.decode_slices(slices(f), low={"y": 4, "x": 3}, size={"y": 12, "x": 17}, first_slice=1)


@query("s1_slice_files", VOX, "SELECT 'raw' AS dataset, z + 10 * CAST(substr(dataset, 2) AS BIGINT) AS z, y, x, v FROM @em")
def _(f):
    path = folder(f, "slices")
    named = f.em.select(F.col("z") + 10 * F.expr("CAST(substr(dataset, 2) AS BIGINT)"), "y", "x", "v").toDF("z", "y", "x", "v")
    # one text file per slice: the row keeps its own line end out of the payload
    lines = named.groupBy("z").agg(F.expr("array_join(transform(array_sort(collect_list(struct(y, x, v))), s -> lpad(hex(s.v), 2, '0')), '')").alias("value"))
    lines.select("value", "z").write.partitionBy("z").text(path, lineSep=";")
    raw = volumes.read_slices(f.spark, f"{path}/z=*/*.txt", r"z=(\d+)/", 25, 20, "raw")
    payload = F.unhex(F.rtrim(F.expr("replace(cast(data AS string), ';', '')")))
    return volumes.decode_slices(raw.withColumn("data", payload))


@query("s2_png_like_slices", VOX, EM)
def _(f):
    return volumes.decode_slices(slices(f, "u8"), "u8")


@query("s3_typed_windows", VOX, "SELECT dataset, z, y - 2 AS y, x - 5 AS x, v FROM @em WHERE y >= 2 AND y < 12 AND x >= 5 AND x < 15")
def _(f):
    return volumes.decode_slices(slices(f, "u16", "big"), "u16", "big", low={"y": 2, "x": 5}, size={"y": 10, "x": 10})


@query("s3_real_windows", "dataset:s z y x v:f", "SELECT dataset, z, y - 2 AS y, x - 5 AS x, v / 4.0::DOUBLE - 20.5::DOUBLE AS v FROM @em WHERE y >= 2 AND y < 12 AND x >= 5 AND x < 15")
def _(f):
    real = f.em.withColumn("v", F.col("v") / 4 - 20.5)
    packed = volumes.export_slices(real, pixel.extents(f.em), dtype="f32", byteorder="big")
    return volumes.decode_slices(packed, "f32", "big", low={"y": 2, "x": 5}, size={"y": 10, "x": 10})


@query("s7_real_blocks", "dataset:s z y x v:f", "SELECT dataset, z, y, x, v / 4.0::DOUBLE - 20.5::DOUBLE AS v FROM @em")
def _(f):
    sizes = pixel.extents(f.em)
    return blocks.to_voxels(blocks.to_blocks(f.em.withColumn("v", F.col("v") / 4 - 20.5), BLOCK, sizes, "f32"), BLOCK, "f32")


@query("s1_slices_to_blocks", VOX, """WITH e AS (SELECT dataset, z, y - 2 AS y, x - 5 AS x, CASE WHEN z % 5 = 3 THEN 0 ELSE v END AS v FROM @em WHERE y >= 2 AND x >= 5),
b AS (SELECT DISTINCT dataset, z // 4 AS gz FROM e WHERE z % 5 <> 3) SELECT dataset, z, y, x, v FROM e WHERE (dataset, z // 4) IN (SELECT (dataset, gz) FROM b)""")
def _(f):
    from voxelframe.plans.ingest import slices_to_blocks
    sizes = pixel.extents(f.em).selectExpr("dataset", "nz", "ny - 2 AS ny", "nx - 5 AS nx")
    present = slices(f).where("z % 5 <> 3")
    return blocks.to_voxels(slices_to_blocks(present, 20, 25, BLOCK, sizes, low={"y": 2, "x": 5}), BLOCK)


@query("s5_tiles_to_volume", VOX, EM + " WHERE v <> 0")
def _(f):
    from voxelframe.plans.ingest import tiles_to_volume
    path = folder(f, "assembled")
    tiles_to_volume(tiles(f), {"y": 8, "x": 8}, BLOCK, pixel.extents(f.em), path)
    return volumes.read_volume(f.spark, path)


def tiles(f, size=8):
    keyed = blocks.to_blocks(f.em, {"z": 1, "y": size, "x": size}, pixel.extents(f.em).select(
        "dataset", "nz", (F.ceil(F.col("ny") / size) * size).alias("ny"), (F.ceil(F.col("nx") / size) * size).alias("nx")))
    return keyed.select("dataset", F.col("gz").alias("z"), F.col("gy").alias("row"), F.col("gx").alias("col"), "data")


@query("s4_assemble_tiles", VOX, """WITH b AS (SELECT DISTINCT dataset, z // 4 AS gz, (y - 3) // 8 AS gy, (x - 2) // 10 AS gx FROM @em WHERE x >= 2 AND y >= 3 AND (y // 8 + x // 8) % 3 <> 0),
e AS (SELECT dataset, z, y - 3 AS y, x - 2 AS x, CASE WHEN (y // 8 + x // 8) % 3 = 0 THEN 0 ELSE v END AS v FROM @em WHERE x >= 2 AND y >= 3)
SELECT e.* FROM e JOIN b ON e.dataset = b.dataset AND z // 4 = gz AND y // 8 = gy AND x // 10 = gx""")
def _(f):
    present = tiles(f).where("(row + col) % 3 <> 0")
    sizes = pixel.extents(f.em).selectExpr("dataset", "nz", "ny - 3 AS ny", "nx - 2 AS nx")
    return blocks.to_voxels(volumes.assemble_tiles(present, {"y": 8, "x": 8}, BLOCK, sizes, {"y": 3, "x": 2}), BLOCK)


@query("s5_render_tiles_reblocked", VOX, EM)
def _(f):
    sizes = pixel.extents(f.em)
    first = {"z": 1, "y": 16, "x": 16}
    rough = volumes.assemble_tiles(tiles(f), {"y": 8, "x": 8}, first, sizes)
    return blocks.to_voxels(blocks.reblock(rough, first, BLOCK, sizes), BLOCK)


OCTREE = """SELECT o_orderkey AS id, concat(CAST(1 + o_orderkey % 8 AS STRING), '/', CAST(1 + o_custkey % 8 AS STRING), '/',
CAST(1 + CAST(floor(o_orderkey / 8) AS BIGINT) % 8 AS STRING)) AS path, o_orderkey % 8 AS a, o_custkey % 8 AS b, CAST(floor(o_orderkey / 8) AS BIGINT) % 8 AS c FROM @orders"""


@query("s6_octree_coordinates", "id gx gy gz depth", f"""SELECT id, (a % 2) * 4 + (b % 2) * 2 + c % 2 AS gx,
(a // 2 % 2) * 4 + (b // 2 % 2) * 2 + c // 2 % 2 AS gy, (a // 4) * 4 + (b // 4) * 2 + c // 4 AS gz, 3 AS depth FROM ({OCTREE})""")
def _(f):
    return volumes.octree_coordinates(f.sql(OCTREE))


NODE = {"z": 2, "y": 4, "x": 4}
DIGIT = "CAST(1 + (shiftright(gx, {0}) & 1) + 2 * (shiftright(gy, {0}) & 1) + 4 * (shiftright(gz, {0}) & 1) AS STRING)"


def octree_nodes(f):
    """Two levels of nodes in two channels: two thirds of the finest, and all that are half as fine."""
    names = f.em.select("dataset").distinct()
    fine = blocks.to_blocks(f.em.where("z < 8 AND y < 16 AND x < 16"), NODE, names.selectExpr("dataset", "8L AS nz", "16L AS ny", "16L AS nx"), "u16")
    half = f.em.where("z < 8 AND y < 16 AND x < 16 AND z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0").selectExpr(
        "dataset", "z div 2 AS z", "y div 2 AS y", "x div 2 AS x", "v")
    half = blocks.to_blocks(half, NODE, names.selectExpr("dataset", "4L AS nz", "8L AS ny", "8L AS nx"), "u16")
    upper, lower = (F.expr(DIGIT.format(bit)) for bit in (1, 0))
    nodes = fine.where("(gz + gy + gx) % 3 <> 0").withColumn("path", F.concat_ws("/", upper, lower)).unionByName(half.withColumn("path", lower))
    return nodes.select("dataset", F.explode(F.array(F.lit(0), F.lit(1))).alias("channel"), "path", "data")


OCTREE_FINE = """SELECT concat(dataset, '/c', c) AS dataset, z, y, x, v FROM @em, (VALUES ('0'), ('1')) AS u(c)
WHERE z < 8 AND y < 16 AND x < 16 AND (z // 2 + y // 4 + x // 4) % 3 <> 0 AND v <> 0"""


@query("s6_octree_blocks", VOX, f"""SELECT * FROM ({OCTREE_FINE}) UNION ALL SELECT concat(dataset, '/c', c), z + a, y + b, x + d, v
FROM @em, (VALUES ('0'), ('1')) AS u(c), (VALUES (0), (1)) AS p(a), (VALUES (0), (1)) AS q(b), (VALUES (0), (1)) AS r(d)
WHERE z < 8 AND y < 16 AND x < 16 AND z % 2 = 0 AND y % 2 = 0 AND x % 2 = 0 AND (z // 2 + y // 4 + x // 4) % 3 = 0 AND v <> 0""")
def _(f):
    return blocks.to_voxels(volumes.octree_blocks(octree_nodes(f), 2, NODE), NODE, "u16", skip_background=True)


@query("s6_octree_finest", VOX, OCTREE_FINE)
def _(f):
    return blocks.to_voxels(volumes.octree_blocks(octree_nodes(f), 2, NODE, fill=False), NODE, "u16", skip_background=True)


@query("s7_reblock", VOX, EM)
def _(f):
    sizes = pixel.extents(f.em)
    packed = blocks.to_blocks(f.em, BLOCK, sizes)
    other = {"z": 3, "y": 7, "x": 16}
    return blocks.to_voxels(blocks.reblock(packed, BLOCK, other, sizes), other)


@query("s7_reblock_layout", "dataset:s gz gy gx nz ny nx", """SELECT dataset, z // 3 AS gz, y // 7 AS gy, x // 16 AS gx, count(DISTINCT z) AS nz, count(DISTINCT y) AS ny,
count(DISTINCT x) AS nx FROM @em GROUP BY dataset, z // 3, y // 7, x // 16""")
def _(f):
    sizes = pixel.extents(f.em)
    return blocks.reblock(blocks.to_blocks(f.em, BLOCK, sizes), BLOCK, {"z": 3, "y": 7, "x": 16}, sizes)


@query("s8_read_window", VOX, EM + " WHERE z >= 2 AND z < 7 AND y >= 1 AND y < 15 AND x >= 1 AND x < 9")
def _(f):
    path = folder(f, "volume")
    volumes.write_volume(f.em, path, background=0, block_z=4)
    return volumes.read_volume(f.spark, path, {"z": (2, 7), "y": (1, 15), "x": (1, 9)}, sizes=pixel.extents(f.em))


@query("s9_write_nonempty", VOX, EM + " WHERE v <> 0")
def _(f):
    path = folder(f, "volume")
    volumes.write_volume(f.em, path, background=0)
    return volumes.read_volume(f.spark, path)


@query("s9_nonempty_blocks", "dataset:s gz gy gx", "SELECT DISTINCT dataset, z // 4 AS gz, y // 2 AS gy, x // 2 AS gx FROM @em WHERE v <> 0")
def _(f):
    return blocks.nonempty_blocks(f.em, {"z": 4, "y": 2, "x": 2})


@query("s10_resume", VOX, "SELECT dataset, z, y, x, CASE WHEN z < 4 THEN v + 1 ELSE v END AS v FROM @em")
def _(f):
    path = folder(f, "volume")
    volumes.write_volume(f.em.where("z < 4").withColumn("v", F.col("v") + 1), path, block_z=4)
    volumes.resume_volume(f.em, path, block_z=4)
    return volumes.read_volume(f.spark, path)


@query("s10_overwrite_and_consistency", VOX, EM + " WHERE v > 100")
def _(f):
    path = folder(f, "volume")
    volumes.write_volume(f.em, path)
    volumes.write_volume(f.em.where("v > 100"), path, mode="overwrite")
    meta = pixel.extents(f.em).select("dataset", F.array("nx", "ny", "nz").alias("dims"), F.array(F.lit(10), F.lit(8), F.lit(4)).alias("block"),
                                      F.lit("u8").alias("dtype"), F.create_map(F.lit("compression"), F.lit("gzip")).alias("attrs"))
    return volumes.read_volume(f.spark, path).join(volumes.check_consistent(meta, meta), "dataset")


ATTRS = "SELECT o_orderkey AS id, CAST(o_custkey AS STRING) AS c, CAST(o_orderkey % 7 AS STRING) AS m FROM @orders"


@query("s11_transfer_attributes", "id n mean:s scale:s dims:s", f"SELECT id, 4 AS n, c AS mean, m AS scale, 'out' AS dims FROM ({ATTRS})")
def _(f):
    source = F.create_map(F.lit("avg"), "c", F.lit("dimensions"), F.lit("in"), F.lit("scale"), "m")
    target = F.create_map(F.lit("dimensions"), F.lit("out"), F.lit("scale"), F.lit("old"), F.lit("kept"), F.lit("1"))
    rows = f.sql(ATTRS).withColumn("attrs", volumes.transfer_attributes(source, target))
    name = F.col("id").cast("string")
    return rows.select("id", F.size("attrs").alias("n"), volumes.required_attribute(F.col("attrs"), "avg", name).alias("mean"),
                       volumes.required_attribute(F.col("attrs"), "scale", name).alias("scale"), F.col("attrs")["dimensions"].alias("dims"))


GROUPS = "SELECT DISTINCT concat('/flat/s', CAST(o_custkey AS STRING), CASE WHEN o_orderkey % 3 = 0 THEN '/mask' ELSE '/raw' END) AS dataset FROM @orders"


@query("s12_resolve_datasets", "source:s target:s scale", f"""SELECT dataset AS source, replace(replace(dataset, '/flat/', '/norm/'), '/raw', '/top') AS target, s AS scale
FROM ({GROUPS}) g, (VALUES (0), (1), (5)) AS t(s) WHERE dataset LIKE '%/raw'""")
def _(f):
    return volumes.resolve_datasets(f.sql(GROUPS), "/flat/*/raw", "/norm/*/top", [0, 1, 5])


JOBS = "SELECT concat('/raw/s', CAST(o_orderkey AS STRING)) AS source, concat('/field/', CAST(o_custkey AS STRING)) AS field, concat('/flat/s', CAST(o_orderkey AS STRING)) AS target FROM @orders"


@query("s13_read_jobs", "source:s field:s target:s form:s", f"SELECT *, 'csv' AS form FROM ({JOBS}) UNION ALL SELECT *, 'json' FROM ({JOBS}) UNION ALL SELECT source, '', target, 'array' FROM ({JOBS})")
def _(f):
    path = folder(f, "jobs")
    f.sql(JOBS).write.csv(path + "/csv")
    f.sql(JOBS).write.json(path + "/json")
    pairs = f.sql(JOBS).select(F.expr("concat('{\"from\": \"', source, '\",\\n  \"to\": \"', target, '\"}')").alias("r"))
    # one array, written by one task as it is one file
    array_file(pairs, path + "/array")
    return volumes.read_jobs(f.spark, path + "/csv").withColumn("form", F.lit("csv")).unionByName(
        volumes.read_jobs(f.spark, path + "/json", "json").withColumn("form", F.lit("json"))).unionByName(
        volumes.read_jobs(f.spark, path + "/array", "array").withColumn("form", F.lit("array")))


def array_file(rows, path, part=1000):
    """Arrays of JSON objects (column r), pretty-printed, one of at most about ``part`` in a line-separated file."""
    salt = F.pmod(F.xxhash64("r"), F.lit(64))
    one = rows.groupBy(salt.alias("s")).agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("r"), ",\n"), F.lit("\n]")).alias("value"))
    one.repartition("s").write.partitionBy("s").text(path)


POSITIONS = """SELECT 'tile' AS type, concat('Stack_Pos0', CAST(s_suppkey AS STRING), '_a.h5') AS file, array(s_suppkey * 10, s_suppkey * 20, CAST(0 AS BIGINT)) AS position,
array(CAST(100 AS BIGINT), CAST(200 AS BIGINT), CAST(50 AS BIGINT)) AS size, array(CAST(0.4 AS DOUBLE), CAST(0.4 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS pixelResolution, s_suppkey AS index FROM @supplier"""


@query("s14_read_positions", "position_id:s px py index", "SELECT concat('0', CAST(s_suppkey AS STRING)) AS position_id, s_suppkey * 10 AS px, s_suppkey * 20 AS py, s_suppkey AS index FROM @supplier")
def _(f):
    path = folder(f, "positions")
    f.sql(POSITIONS).write.json(path)
    array_file(f.sql(POSITIONS).where("index % 2 = 1").select(F.to_json(F.struct("*")).alias("r")), path + "-array")
    both = volumes.read_positions(f.spark, path).where("index % 2 = 0").unionByName(volumes.read_positions(f.spark, path + "-array", array=True).drop("s"))
    return both.select("position_id", F.col("position")[0].alias("px"), F.col("position")[1].alias("py"), "index")


CATALOG = """SELECT o_custkey AS stack, concat('Ch', CAST(o_orderkey % 3 AS STRING)) AS channel, 'cam1' AS cam, o_orderkey AS idx,
concat('/data/', CAST(o_orderkey AS STRING)) AS path FROM @orders"""


@query("s15_slice_catalog", "stack channel:s cam:s n first:s tx:f data:s", f"""SELECT stack, channel, cam, count(*) AS n, min_by(path, idx) AS first, min(idx)::DOUBLE AS tx,
concat('/h5/', CAST(stack AS STRING)) AS data FROM ({CATALOG}) GROUP BY stack, channel, cam""")
def _(f):
    rows = f.sql(CATALOG).withColumn("affine", F.array(F.lit(1.0), F.lit(0.0), F.col("idx").cast("double"), F.lit(0.0), F.lit(1.0), F.lit(0.0)))
    paths = rows.select("stack", "channel", "cam", F.concat(F.lit("/h5/"), F.col("stack").cast("string")).alias("data")).distinct()
    return volumes.add_paths(volumes.slice_catalog(rows), paths).select(
        "stack", "channel", "cam", "n", F.col("first.path").alias("first"), F.col("first.affine")[2].alias("tx"), "data")


@query("s15_rewrite_catalog", "stack channel:s idx a:f tx:f", f"""SELECT stack, channel, idx, 2.0 AS a, idx + 2.0 * (stack % 4) AS tx FROM ({CATALOG})""")
def _(f):
    rows = f.sql(CATALOG).withColumn("affine", F.array(F.lit(2.0), F.lit(0.0), F.col("idx").cast("double"), F.lit(0.0), F.lit(1.0), F.lit(0.0)))
    cams = rows.select("stack", "channel", "cam").distinct()
    cams = cams.withColumn("cam_affine", F.array(F.lit(1.0), F.lit(0.0), (F.col("stack") % 4).cast("double"), F.lit(0.0), F.lit(1.0), F.lit(0.0)))
    out = volumes.rewrite_catalog(rows, cams)
    return out.select("stack", "channel", "idx", F.col("affine")[0].alias("a"), F.col("affine")[2].alias("tx"))


@query("s16_export_transforms", "dataset:s side:s iy ix tx:f ty:f face_offset scale:f", """WITH s AS (SELECT dataset, min(z) + 1 AS top, max(z) AS bot FROM @em GROUP BY dataset)
SELECT dataset, 'top' AS side, iy, ix, tx, ty, top AS face_offset, 0.5::DOUBLE AS scale FROM @posfield JOIN s USING (dataset)
UNION ALL SELECT dataset, 'bot', iy, ix, tx + 1, ty, bot, 0.5 FROM @posfield JOIN s USING (dataset)""")
def _(f):
    slabs = f.em.groupBy("dataset").agg((F.min("z") + 1).alias("top"), F.max("z").alias("bot"))
    top = f.posfield.withColumn("side", F.lit("top"))
    fields = top.unionByName(f.posfield.withColumn("tx", F.col("tx") + 1).withColumn("side", F.lit("bot")))
    path = folder(f, "transforms")
    volumes.save_rows(volumes.export_transforms(fields, slabs, 0.5), path, ["dataset", "side"])
    return f.spark.read.parquet(path)


@query("s17_export_slices", "dataset:s z strip w h bytes head:s", """SELECT dataset, z, y // 7 AS strip, 25 AS w, count(*) // 25 AS h, count(*) AS bytes,
string_agg(lpad(lower(to_hex(v)), 2, '0'), '' ORDER BY y, x) AS head FROM @em GROUP BY dataset, z, y // 7""")
def _(f):
    out = volumes.export_slices(f.em, pixel.extents(f.em), strip=7)
    return out.select("dataset", "z", "strip", "w", "h", F.length("data").alias("bytes"), F.lower(F.hex("data")).alias("head"))


@query("s18_save_and_reload_features", "stack pid x:f y:f intensity:f", "SELECT stack, pid, x, y, intensity FROM @points")
def _(f):
    path = folder(f, "features")
    volumes.save_rows(f.points, path, ["stack"])
    return f.spark.read.parquet(path)


FEW = "SELECT o_custkey AS a, o_orderkey % 10 AS b, o_orderkey AS mid FROM @orders"


@query("s19_save_matches", "a b mid", f"SELECT a, b, mid FROM (SELECT *, count(*) OVER (PARTITION BY a, b) AS n FROM ({FEW})) WHERE n >= 4")
def _(f):
    path = folder(f, "matches")
    volumes.save_matches(f.sql(FEW), path)
    return f.spark.read.parquet(path)


# ---- block functions ---------------------------------------------------------

# black right parts of some layers, so that blocks are black with and without black borders
DARK = "SELECT dataset, z, y, x, CASE WHEN z % 3 = 1 OR z % 3 = 2 AND x >= 18 OR z % 3 = 0 AND x >= 8 THEN 0 ELSE v END AS v FROM @em"


@query("x1_map_slices", "dataset:s z y x v:f", f"""WITH p AS (SELECT dataset, z, y, x, v, max(y) OVER (PARTITION BY dataset) AS my, max(x) OVER (PARTITION BY dataset) AS mx FROM ({DARK}))
SELECT a.dataset, a.z, a.y, a.x, CASE WHEN NOT e.full_block THEN 0 ELSE least(150, greatest(10, (l.v + r.v) / 2.0::DOUBLE)) END AS v FROM p a
JOIN p l ON l.dataset = a.dataset AND l.z = a.z AND l.y = a.y AND l.x = CASE WHEN a.x = 0 THEN 1 ELSE a.x - 1 END
JOIN p r ON r.dataset = a.dataset AND r.z = a.z AND r.y = a.y AND r.x = CASE WHEN a.x = a.mx THEN a.mx - 1 ELSE a.x + 1 END
JOIN (SELECT dataset, z, gy, gx, max(v) > 0 AS full_block FROM ({DARK}), (VALUES (0), (1), (2)) AS b(gy), (VALUES (0), (1), (2)) AS c(gx)
 WHERE y BETWEEN gy * 8 - 2 AND gy * 8 + 9 AND x BETWEEN gx * 10 - 2 AND gx * 10 + 11 GROUP BY dataset, z, gy, gx) e
ON e.dataset = a.dataset AND e.z = a.z AND e.gy = a.y // 8 AND e.gx = a.x // 10""")
def _(f):
    def neighbours(s):
        import numpy as np
        p = np.pad(s, 1, mode="edge")
        return (p[1:-1, :-2] + p[1:-1, 2:]) / 2

    return blocks.map_slices(f.sql(DARK), neighbours, BLOCK, 2, pixel.extents(f.em), 10, 150)


@query("x2_map_blocks", "dataset:s z y x v:f", """SELECT a.dataset, a.z, a.y, a.x, a.v - (coalesce(b.v, c.v) + coalesce(c.v, b.v)) / 2.0::DOUBLE AS v FROM @em a
LEFT JOIN @em b ON b.dataset = a.dataset AND b.z = a.z - 1 AND b.y = a.y AND b.x = a.x
LEFT JOIN @em c ON c.dataset = a.dataset AND c.z = a.z + 1 AND c.y = a.y AND c.x = a.x""")
def _(f):
    def detail(c):
        import numpy as np
        out = np.zeros_like(c)
        out[1:-1] = c[1:-1] - (c[:-2] + c[2:]) / 2
        return out

    return blocks.map_blocks(f.em, detail, BLOCK, {"z": 1}, pixel.extents(f.em))


@query("x6_generate", VOX, "SELECT dataset, z, y, x, x + 2 * y + 3 * z AS v FROM @em")
def _(f):
    return pixel.generate(pixel.extents(f.em), F.col("x") + 2 * F.col("y") + 3 * F.col("z"))
