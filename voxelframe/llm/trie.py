"""Prefix trie of conversations by truncation peeling.

A conversation is the path of its turns. From the greatest depth down, conversations that end at a depth join the nodes
that survive there; each node is complete then, loses its last turn, and the nodes that agree in what is left are one
node of the next depth, with the sums of their members, leaves and savings. Nodes are discovered and aggregated at once.

Subtrees are peeled side by side. Equal conversations are one row with their number first. A subtree of at most
``LIMIT`` turns, whose parent's subtree is larger, is peeled in one task down to its top; tops lose their last turn, are
merged by Spark into one row per parent (sums combine on the map side, so a first turn that all share is no hot key), and
the next round peels what is left. A round reduces each subtree to a row, so a few rounds reach the root at any depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelframe.llm.common import table, written
from voxelframe.llm.registry import query
from voxelframe.llm.streams import by_key, digests, in_ranges, part_number, turn_rows

LIMIT, SALTS, BODY = 1 << 15, 64, 1 << 16
FAMILY, HEADS = 100, 6
NONE = hashlib.sha256(b"").hexdigest()
NODE = ("pid binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, "
        "top boolean, path array<binary>, lens array<int>")


def turn_marks(convs: DataFrame) -> DataFrame:
    """(conv_id, turn, tie, mark, len): 128 bits of role and text, and code points of the text. Rows without conv_id
    belong to no conversation and take no part."""
    rows = turn_rows(convs).where("conv_id IS NOT NULL")
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return rows.select("conv_id", "turn", "tie", F.substring(F.unhex(F.sha2(said, 256)), 1, 16).alias("mark"), F.length("text").alias("len"))


def chained(rows: Iterator[tuple], skip: bool) -> Iterator[tuple]:
    """(conv_id, path, lens) of runs of (conv_id, kind, turn, tie, mark, len, head, h): the first turns of ``head`` as the
    row of kind 0 says, then the turns of kind 1 that ``skip`` leaves."""
    last, path, lens, left, at = None, [], [], 0, b""
    for conv, kind, _, _, mark, length, head, h in rows:
        if conv != last:
            if last is not None:
                yield last, path, lens
            last, path, lens, left, at = conv, [], [], 0, b""
        new = []
        if kind == 0:
            left, new = (h if skip else 0), [(m["mark"], m["len"]) for m in (head or [])[:h]]
        elif left > 0:
            left -= 1
        else:
            new = [(mark, length)]
        for mark, length in new:
            at = hashlib.sha256(at + mark).digest()[:16]
            path.append(at)
            lens.append(length)
    if last is not None:
        yield last, path, lens


PATH = "conv_id long, path array<binary>, lens array<int>"


def paths(marks: DataFrame) -> DataFrame:
    """(conv_id, path, lens): each conversation as the chain of hashes of its first 1, 2, ... turns. A conversation's
    turns pass one task as a stream of short rows; its path is one value of the result."""
    blank = F.array().cast("array<struct<mark:binary,len:int>>")
    rows = marks.select("conv_id", F.lit(1).alias("kind"), "turn", "tie", "mark", "len", blank.alias("head"), F.lit(0).alias("h"))
    return by_key(rows, ["conv_id"], ["kind", "turn", "tie"], lambda found, _: chained(found, False), PATH)


def grafted(marks: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """``paths`` with the first h turns of conversation c - c % family before c's own turns after its first h, where h is
    crc32 of c as text, modulo ``heads``. Only the first turns of the families' first conversations are joined."""
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "tie"))
    first = marks.where(F.col("conv_id") % family == 0).withColumn("place", place).where(F.col("place") < heads)
    first = first.groupBy(F.col("conv_id").alias("family")).agg(F.sort_array(F.collect_list(F.struct("place", "mark", "len"))).alias("head"))
    first = first.select("family", F.transform("head", lambda t: F.struct(t["mark"].alias("mark"), t["len"].alias("len"))).alias("head"))
    ids = marks.select("conv_id").distinct().withColumn("family", F.col("conv_id") - F.col("conv_id") % family)
    ids = ids.withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")).join(first, "family", "left")
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("tie", "long"), ("mark", "binary"), ("len", "int"))]
    ids = ids.select("conv_id", F.lit(0).alias("kind"), *nothing, "head", "h")
    rows = marks.select("conv_id", F.lit(1).alias("kind"), "turn", "tie", "mark", "len", F.lit(None).cast("array<struct<mark:binary,len:int>>").alias("head"), F.lit(0).alias("h"))
    return by_key(ids.unionByName(rows), ["conv_id"], ["kind", "turn", "tie"], lambda found, _: chained(found, True), PATH)


def _end(path: str = "path"):
    return F.when(F.size(path) > 0, F.element_at(path, -1)).otherwise(F.lit(b""))


def ended(found: DataFrame) -> DataFrame:
    """One row per different path of ``paths``: its end, number, smallest id, and a digest of its ids in order. Ids are
    dealt by ranges and written to parts, so the ids of a path that a third of all share are joined in many tasks."""
    found = found.select(_end().alias("end"), "*")

    def join(rows: Iterator[tuple], task: int) -> Iterator[tuple]:
        last, held, size, n = None, [], 0, 0
        for end, conv in rows:
            if held and (end != last or size >= BODY):
                yield last, part_number(task, n), ",".join(held)
                held, size, n = [], 0, n + 1
            held.append(str(conv))
            last, size = end, size + len(held[-1]) + 1
        if held:
            yield last, part_number(task, n), ",".join(held)

    parts = in_ranges(found.select("end", "conv_id"), ["end", "conv_id"], join, "end binary, part long, body string")
    sums = digests(parts, ["end"], ",").withColumnRenamed("sha256", "ends")
    rows = found.groupBy("end").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("path").alias("path"), F.first("lens").alias("lens"))
    return rows.join(sums, "end").select("end", "path", "lens", "n", "least", *[F.lit(0).cast("long").alias(c) for c in ("kids", "leaves", "saved")], "ends")


def peel(rows: list[tuple], top: int) -> Iterator[tuple]:
    """Nodes of the subtree at depth ``top`` that all ``rows`` (path, lens, n, least, kids, leaves, saved, ends) share."""
    ending: dict[int, list[tuple]] = {}
    for row in rows:
        ending.setdefault(len(row[0]), []).append(row)
    level: dict[bytes, list] = {}  # pid: n, least, kids, leaves, saved, ends, path, lens, children without their parent's id
    for depth in range(max(ending), top - 1, -1):
        for path, lens, n, least, kids, leaves, saved, ends in ending.get(depth, []):
            _merge(level, path[-1] if path else b"", n, least, kids, leaves, saved, ends, path, lens, None)
        above: dict[bytes, list] = {}
        for pid, (n, least, kids, leaves, saved, ends, path, lens, children) in level.items():
            for child in children:
                yield (*child[:3], least, *child[4:])
            leaves = leaves if kids else 1
            saved += (n - 1) * (lens[depth - 1] if depth else 0)
            node = (pid, least, depth, None, n, kids, leaves, saved, ends or NONE, False, None, None)
            if depth > top:
                _merge(above, path[depth - 2] if depth > 1 else b"", n, least, 1, leaves, saved, None, path, lens, node)
            else:
                yield (*node[:-3], True, path[:max(depth - 1, 0)], lens[:max(depth - 1, 0)])
        level = above


def _merge(level, pid, n, least, kids, leaves, saved, ends, path, lens, child) -> None:
    at = level.get(pid)
    if at is None:
        level[pid] = [n, least, kids, leaves, saved, ends, path, lens, [] if child is None else [child]]
        return
    at[0] += n
    at[1] = min(at[1], least)
    at[2] += kids
    at[3] += leaves
    at[4] += saved
    at[5] = at[5] or ends
    if child is not None:
        at[8].append(child)


def _peeled(rows: DataFrame) -> DataFrame:
    """Nodes of all subtrees of ``rows`` (top, path, ...); a run of one key is a subtree."""
    def run(found: Iterator[tuple], _: int) -> Iterator[tuple]:
        last, held = None, []
        for key, *row in found:
            if held and key != last:
                yield from peel([r[1:] for r in held], held[0][0])
                held = []
            held.append(row)
            last = key
        if held:
            yield from peel([r[1:] for r in held], held[0][0])

    return by_key(rows.select("key", "top", "path", "lens", "n", "least", "kids", "leaves", "saved", "ends"), ["key"], [], run, NODE)


def _large(rows: DataFrame, limit: int) -> DataFrame:
    """(pid, depth) of the prefixes with more than ``limit`` turns at or below them."""
    at = rows.select(F.size("path").alias("size"), F.posexplode(F.concat(F.array(F.lit(b"")), "path")).alias("depth", "pid"))
    return at.groupBy("pid", "depth").agg(F.sum(F.col("size") - F.col("depth") + 1).alias("w")).where(F.col("w") > limit).select("pid", "depth")


def _tops(rows: DataFrame, large: DataFrame, deepest: int) -> DataFrame:
    """Rows with the depth of the first prefix that is not large. Large prefixes are few and met in ``SALTS`` pieces."""
    spread = large.select("pid", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    prefix = F.slice(F.concat(F.array(F.lit(b"")), "path"), 1, deepest + 1)
    at = rows.select("end", F.pmod(F.xxhash64("end"), F.lit(SALTS)).cast("int").alias("salt"), F.posexplode(prefix).alias("depth", "pid"))
    found = at.join(spread, ["pid", "salt"]).groupBy("end").agg((F.max("depth") + 1).alias("top"))
    return rows.join(found, "end")


def trie(found: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie of ``paths``: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (code points that members other than one repeat, over the subtree), ends_sha256. No conversation: no node."""
    rows, levels = written(ended(written(found, "trie-paths")), "trie-ends"), []
    while True:
        large = written(_large(rows, limit), "trie-large")
        deepest = large.agg(F.max("depth")).first()[0]
        if deepest is None:
            levels.append(written(_peeled(rows.withColumn("key", F.lit(b"")).withColumn("top", F.lit(0))), "trie-nodes"))
            break
        dealt = written(_tops(rows, large, deepest), "trie-tops")
        ready = F.col("top") <= F.size("path")
        nodes = written(_peeled(dealt.where(ready).withColumn("key", F.element_at("path", F.col("top")))), "trie-nodes")
        levels.append(nodes)
        tops = nodes.where("top").select(_end().alias("end"), "path", "lens", F.col("n_convs").alias("n"), F.col("conv_id").alias("least"), F.lit(1).cast("long").alias("kids"),
                                         F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(None).cast("string").alias("ends"))
        both = tops.unionByName(dealt.where(~ready).select(*tops.columns))
        rows = written(both.groupBy("end").agg(F.first("path").alias("path"), F.first("lens").alias("lens"), F.sum("n").alias("n"), F.min("least").alias("least"), F.sum("kids").alias("kids"),
                                               F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")), "trie-rows")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256")]
    done = levels[-1].select(*out)
    for n, nodes in enumerate(levels[:-1]):
        done = done.unionByName(nodes.where("NOT top").select(*out)).unionByName(_joined(nodes.where("top"), levels[n + 1:]).select(*out))
    return done


def _joined(tops: DataFrame, later: list[DataFrame]) -> DataFrame:
    """Tops with the ids of their parents, which later rounds found; a parent is met in ``SALTS`` pieces."""
    tops = tops.withColumn("parent", _end()).withColumn("salt", F.pmod(F.xxhash64("pid"), F.lit(SALTS)).cast("int")).drop("parent_conv_id")
    known = later[0].select("pid", "conv_id")
    for nodes in later[1:]:
        known = known.unionByName(nodes.select("pid", "conv_id"))
    known = known.join(tops.select(F.col("parent").alias("pid")).distinct(), "pid", "left_semi")
    known = known.select(F.col("pid").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return tops.join(known, ["parent", "salt"])


SQL = """
WITH t AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, c - c % 100 AS family,
               xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(c::VARCHAR, ''), lambda b: [ord(b)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256]))),
                   lambda a, x: CASE WHEN x < 256 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END), 4294967295::UBIGINT) % 6 AS h
        FROM (SELECT DISTINCT c FROM t)),
r AS (SELECT ids.c, 0 AS own, t.pos, t.role, t.text FROM ids JOIN t ON t.c = ids.family AND t.pos <= ids.h
      UNION ALL SELECT ids.c, 1, t.pos, t.role, t.text FROM ids JOIN t ON t.c = ids.c AND t.pos > ids.h),
s AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, pos) AS d, length(text) AS len, sha256(length(role)::VARCHAR || ':' || role || text) AS mark FROM r),
p AS (SELECT c, 0 AS d, 0 AS len, '' AS k FROM ids
      UNION ALL SELECT c, d, len, sha256(string_agg(mark, '') OVER (PARTITION BY c ORDER BY d)) FROM s),
q AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS ends FROM p),
n AS (SELECT d, k, any_value(up) AS up, any_value(len) AS len, min(c) AS least, count(*) AS members,
             sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM q GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN kids USING (d, k)),
w AS (SELECT q.c, q.d, q.k, sum(CASE WHEN v.least = q.c THEN (v.members - 1) * v.len ELSE 0 END) OVER below AS saved,
             sum(CASE WHEN v.least = q.c AND v.kids = 0 THEN 1 ELSE 0 END) OVER below AS leaves
      FROM q JOIN v USING (d, k) WINDOW below AS (PARTITION BY q.c ORDER BY q.d DESC)),
x AS (SELECT d, k, sum(saved) AS saved, sum(leaves) AS leaves FROM w GROUP BY d, k)
SELECT v.least AS conv_id, v.d AS depth, u.least AS parent_conv_id, v.members AS n_convs, v.kids AS n_children,
       CAST(x.leaves AS BIGINT) AS n_leaves, CAST(x.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM v JOIN x USING (d, k) LEFT JOIN n u ON u.d = v.d - 1 AND u.k = v.up
"""


@query("op13_prefix_trie", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all conversations, each rebuilt on the first turns of its family's first."""
    return trie(grafted(turn_marks(table(spark, sf_dir, "conversations"))))
