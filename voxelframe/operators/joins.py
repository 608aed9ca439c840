"""Joins: neighbouring slices and faces, box overlap, nearest points, match sets.

Range joins become equi-joins on grid cells followed by an exact recheck, so
they hash-partition; adaptive execution splits skewed cells. Only tables whose
row count was checked are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.functions.scalar import half_up
from voxelframe.operators.near import nearest
from voxelframe.schema import KEY
from voxelframe.session import checkpoint, small


def slice_pairs(slices: DataFrame, keys: list[str], distance: int, inclusive: bool = False, index: str = "z") -> DataFrame:
    """Pairs (i, j) of slices of one series with 0 < j - i < distance (or <= distance)."""
    reach = distance if inclusive else distance - 1
    left = slices.select(*keys, F.col(index).alias("i"))
    ahead = left.withColumn("j", F.explode(F.sequence(F.col("i") + 1, F.col("i") + F.lit(max(reach, 1)))))
    if reach < 1:
        ahead = ahead.where(F.lit(False))
    return ahead.join(slices.select(*keys, F.col(index).alias("j")), [*keys, "j"], "left_semi").select(*keys, "i", "j")


def face_pairs(slabs: DataFrame) -> DataFrame:
    """Bottom face of each slab with the top face of the next: in the list of
    faces (top, bottom per slab) these are faces 2k + 1 and 2k + 2."""
    faces = slabs.select("ord", F.explode(F.array(F.lit("top"), F.lit("bot"))).alias("side"), "dataset")
    faces = faces.withColumn("face", F.col("ord") * 2 + F.when(F.col("side") == "bot", 1).otherwise(0))
    pair = F.floor((F.col("face") + 1) / 2)
    keyed = faces.withColumn("pair", pair)
    first = keyed.where("side = 'bot'").select("pair", F.col("face").alias("face_a"), F.concat_ws("/", "dataset", "side").alias("a"))
    second = keyed.where("side = 'top'").select("pair", F.col("face").alias("face_b"), F.concat_ws("/", "dataset", "side").alias("b"))
    return first.join(second, "pair")


def zip_lists(a: DataFrame, b: DataFrame, index: str) -> DataFrame:
    """Pair two lists by position."""
    return a.join(b, index)


def overlap_pairs(tiles: DataFrame, cell: int, axes: tuple = ("x", "y", "z"), tile: str = "tile") -> DataFrame:
    """Tile pairs (a < b) whose boxes overlap in every axis. A pair is reported
    only in the cell that holds the low corner of its intersection, so no
    duplicate removal (and no second shuffle) is needed."""
    cells = tiles
    for a in axes:
        low, high = F.col(f"o{a}"), F.col(f"o{a}") + F.col(f"s{a}") - 1
        cells = cells.withColumn(f"c{a}", F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell))))
    p, q = cells.alias("p"), cells.alias("q")
    cond = F.col(f"p.{tile}") < F.col(f"q.{tile}")
    for a in axes:
        cond = cond & (F.col(f"p.c{a}") == F.col(f"q.c{a}"))
        cond = cond & (F.col(f"p.o{a}") < F.col(f"q.o{a}") + F.col(f"q.s{a}"))
        cond = cond & (F.col(f"q.o{a}") < F.col(f"p.o{a}") + F.col(f"p.s{a}"))
        cond = cond & (F.col(f"p.c{a}") == F.floor(F.greatest(F.col(f"p.o{a}"), F.col(f"q.o{a}")) / cell))
    out = [F.col(f"p.{tile}").alias("a"), F.col(f"q.{tile}").alias("b")]
    for a in axes:
        low = F.greatest(F.col(f"p.o{a}"), F.col(f"q.o{a}"))
        high = F.least(F.col(f"p.o{a}") + F.col(f"p.s{a}"), F.col(f"q.o{a}") + F.col(f"q.s{a}"))
        out.append((high - low).alias(f"overlap_{a}"))
    return p.join(q, cond).select(*out)


def running_total(df: DataFrame, keys: list[str], order: str, value: str, name: str, chunk: int = 4096) -> DataFrame:
    """Exclusive running sum along an integer order column. The long window
    spans one chunk of order steps; only one row per chunk enters the window
    over the whole series, so a long series does not meet in one task."""
    part = df.withColumn("_c", F.floor(F.col(order) / chunk))
    whole = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    base = part.groupBy(*keys, "_c").agg(F.sum(value).alias("_s"))
    base = base.withColumn("_base", F.coalesce(F.sum("_s").over(whole), F.lit(0))).drop("_s")
    inside = Window.partitionBy(*keys, "_c").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col("_base")
    return part.join(base, [*keys, "_c"]).withColumn(name, total).drop("_c", "_base")


def slab_offsets(slabs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Running z offset of every slab of a series: the sum of the depths before it."""
    rows = slabs.withColumn("depth", F.col("bot") - F.col("top") + 1)
    return running_total(rows, keys or [], "ord", "depth", "zoff")


def blocks_of_slabs(blocks: DataFrame, slabs: DataFrame, cell: int) -> DataFrame:
    """Which slabs contribute to which output block; boxes that only touch count.
    Equi-join on z cells; the cell of the greater start reports the pair."""
    b = blocks.withColumn("c", F.explode(F.sequence(F.floor(F.col("oz") / cell), F.floor((F.col("oz") + F.col("sz")) / cell))))
    s = slab_offsets(slabs).withColumn("end", F.col("zoff") + F.col("depth"))
    s = s.withColumn("c", F.explode(F.sequence(F.floor(F.col("zoff") / cell), F.floor(F.col("end") / cell))))
    touch = (F.col("zoff") <= F.col("oz") + F.col("sz")) & (F.col("end") >= F.col("oz"))
    own = F.col("c") == F.floor(F.greatest("zoff", "oz") / cell)
    return b.join(s, "c").where(touch & own).drop("c", "end")


def join_layer_models(vox: DataFrame, models: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Attach per-layer models (one row per layer) to every voxel."""
    return vox.join(small(models), [*keys, "z"])


def join_field(vox: DataFrame, field: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Attach a 2-D field to every voxel of its (x, y) column."""
    return vox.join(field, [*keys, "y", "x"])


# ---- nearest points -----------------------------------------------------------

def sites(points: DataFrame, keys: list[str], axes: list[str], pid: str) -> DataFrame:
    """Distinct coordinates with the smallest id there: copies of a point
    collapse before any neighbour search."""
    return points.groupBy(*keys, *axes).agg(F.min(pid).alias(pid))


def near_pairs(a: DataFrame, b: DataFrame, keys: list[str], axes: list[str], radius: float) -> DataFrame:
    """All (a, b) rows of one key with distance <= radius and the squared distance d2.
    Cells are two radii wide, so ``a`` is copied to two per axis (three if it lies
    in the middle of one, up to rounding); ``b`` keeps its own cell."""
    cell, reach = F.lit(2.0 * radius), F.lit(float(radius) * (1 + 1e-9))
    left, right = a, b
    for c in axes:
        left = left.withColumn(f"_c{c}", F.explode(F.sequence(F.floor((F.col(c) - reach) / cell), F.floor((F.col(c) + reach) / cell))))
        right = right.withColumn(f"_c{c}", F.floor(F.col(c) / cell))
    l, r = left.alias("l"), right.alias("r")
    same = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in [*keys, *[f"_c{c}" for c in axes]]]
    d2 = sum(((F.col(f"l.{c}") - F.col(f"r.{c}")) * (F.col(f"l.{c}") - F.col(f"r.{c}")) for c in axes), F.lit(0.0))
    return l.join(r, [*same, d2 <= F.lit(float(radius) * float(radius))]).withColumn("d2", d2)


def nn_join(a: DataFrame, b: DataFrame, keys: list[str], axes: list[str], radius: float,
            aid: str = "pid", bid: str = "pid", ends: list[str] | None = None) -> DataFrame:
    """Nearest b of every a within ``radius`` (smallest id on ties), as (keys, aid a, bid b, d2).
    Both inputs are reduced to sites first, which meet on blocks; no pair leaves a task.
    With ``ends`` these columns of a and the place of b (q and the axis) come along."""
    best = nearest(a.select(*keys, *axes).distinct(), sites(b, keys, axes, bid), keys, axes, radius, 1, bid)
    best = best.select(*keys, *axes, F.col("near")[0].alias("best"))
    more = [] if ends is None else [*ends, *[F.col("best")[c].alias(f"q{c}") for c in axes]]
    return a.join(best, [*keys, *axes]).select(*keys, F.col(aid).alias("a"), F.col("best")[bid].alias("b"), F.col("best.d2").alias("d2"), *more)


# ---- match sets -----------------------------------------------------------------

def look_up_points(matches: DataFrame, points_a: DataFrame, points_b: DataFrame, keys: list[str]) -> DataFrame:
    """Coordinates of both ends of a match given by point ids."""
    a = points_a.select(*keys, F.col("pid").alias("a"), *[F.col(c).alias(f"p{c}") for c in "xyz"])
    b = points_b.select(*keys, F.col("pid").alias("b"), *[F.col(c).alias(f"q{c}") for c in "xyz"])
    return matches.join(a, [*keys, "a"]).join(b, [*keys, "b"])


def flip(matches: DataFrame) -> DataFrame:
    swap = {"a": "b", "b": "a", "px": "qx", "qx": "px", "py": "qy", "qy": "py", "pz": "qz", "qz": "pz"}
    return matches.select(*[F.col(swap.get(c, c)).alias(c) for c in matches.columns])


def with_flipped(matches: DataFrame) -> DataFrame:
    """Add (b, a) flipped for every pair stored only as (a, b)."""
    known = matches.select("a", "b").distinct()
    return matches.unionByName(flip(matches).join(known, ["a", "b"], "left_anti"))


def merge_matches(matches: DataFrame, keys: list[str], order: str = "block") -> DataFrame:
    """Merge the match sets of overlapping blocks of every pair of point sets, in
    block order: a match enters unless one of its ends is in a match of an
    earlier block. Matches of one block do not exclude each other.

    Which match enters depends on the earliest matches at its two ends only, so
    the set is settled in rounds: matches of the first block at both ends enter,
    and those of later blocks at these ends leave."""
    row = [*keys, "a", "b", order]
    todo, taken = checkpoint(matches.select(*row).distinct()), None
    while True:
        def first(rows: DataFrame, end: str) -> DataFrame:
            return rows.groupBy(*keys, end).agg(F.min(order).alias(f"first_{end}"))

        marked = todo.join(first(todo, "a"), [*keys, "a"]).join(first(todo, "b"), [*keys, "b"])
        winners = checkpoint(marked.where((F.col(order) == F.col("first_a")) & (F.col(order) == F.col("first_b"))).select(*row))
        taken = winners if taken is None else taken.unionByName(winners)
        rest = todo.join(winners, row, "left_anti")
        for end in ("a", "b"):
            rest = rest.join(first(winners, end), [*keys, end], "left").where(F.col(f"first_{end}").isNull() | (F.col(order) <= F.col(f"first_{end}")))
        todo = checkpoint(rest.select(*row))
        if todo.isEmpty():
            return taken


def merge_counts(matches: DataFrame, merged: DataFrame, keys: list[str], order: str = "block") -> DataFrame:
    """Per pair the matches of all blocks, those added, those that an earlier block
    had added already (same) and those refused for an end in another match."""
    found = matches.select(*keys, "a", "b", order).distinct()
    kept = merged.groupBy(*keys, "a", "b").agg(F.min(order).alias("kept"))
    state = found.join(kept, [*keys, "a", "b"], "left")
    return state.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("kept") == F.col(order)).alias("added"),
        F.count_if(F.col("kept") < F.col(order)).alias("same"), F.count_if(F.col("kept").isNull()).alias("different"))


def nearest_layer(index: DataFrame, transforms: DataFrame, column: str = "z") -> DataFrame:
    """Pick the transform whose index is the rounded z."""
    return index.withColumn("slot", half_up(F.col(column))).join(transforms.withColumnRenamed("z", "slot"), "slot")
