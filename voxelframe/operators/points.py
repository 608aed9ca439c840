"""Operators on irregular points: radius filters, rasters, descriptors, ICP and warps."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.functions.affine import apply_affine
from voxelframe.operators import matching
from voxelframe.operators.joins import near_pairs, nn_join
from voxelframe.operators.leaves import match_short
from voxelframe.operators.near import ball_filter, ball_median, ball_moments, nearest_others
from voxelframe.operators.stats import histogram
from voxelframe.session import SMALL_ROWS, checkpoint, small, stored

KINDS = ("mean", "median", "density", "gauss")


@dataclass(frozen=True)
class WeightedSum:
    """Custom filter: the sum of the values, each times ``weight`` of its squared
    distance (a numpy function). It adds up inside the tasks."""

    weight: Callable


def radius_filter(points: DataFrame, targets: DataFrame, keys: list[str], axes: list[str], radius: float, kind: str | WeightedSum | Callable,
                  value: str = "v", sigma: float = 1.0, normalize: str | None = "weights", fill: float = 0.0) -> DataFrame:
    """Value at every target position from the points within ``radius``. ``kind``
    is a name, a ``WeightedSum``, or a function of (count, sum, squared distance)
    columns that returns any aggregation; only the last makes a row of every pair.

    Points at one position are counted and summed first, so copies cost one row.
    ``normalize`` (gauss) divides by the sum of weights, the number of samples
    or nothing; positions without neighbours take ``fill`` (density: 0)."""
    if not callable(kind) and not isinstance(kind, WeightedSum) and kind not in KINDS:
        raise ValueError(f"unknown filter {kind}")
    spots = targets.select(*keys, *axes).distinct()
    if kind == "median":
        heaps = histogram(points.where(F.col(value).isNotNull()), [*keys, *axes], value).withColumnRenamed(value, "v")
        found = ball_median(spots, heaps, keys, axes, radius)
    else:
        heaps = points.groupBy(*keys, *axes).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("s"))
        if callable(kind):
            near = near_pairs(spots, heaps, keys, axes, radius)
            at = [F.col(f"l.{c}").alias(c) for c in [*keys, *axes]]
            found = near.groupBy(*at).agg(kind(F.col("r.n"), F.col("r.s"), F.col("d2")).alias("v"))
        elif isinstance(kind, WeightedSum):
            found = ball_filter(spots, heaps, keys, axes, radius, "sum", sigma, None, kind.weight)
        else:
            found = ball_filter(spots, heaps, keys, axes, radius, kind, sigma, normalize)
    rest = F.lit(0.0 if kind == "density" else float(fill))
    return targets.join(found, [*keys, *axes], "left").select(*targets.columns, F.coalesce("v", rest).alias("v"))


def raster(boxes: DataFrame, keys: list[str], step: dict[str, float]) -> DataFrame:
    """Regular positions that cover each box (min_*, max_*)."""
    out = boxes
    for a, s in step.items():
        count = F.floor((F.col(f"max_{a}") - F.col(f"min_{a}")) / F.lit(float(s)))
        out = out.withColumn(f"i{a}", F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long"))))
    return out.select(*keys, *[f"i{a}" for a in step], *[(F.col(f"min_{a}") + F.col(f"i{a}") * F.lit(float(s))).alias(a) for a, s in step.items()])


def rasterize(points: DataFrame, grid: DataFrame, keys: list[str], axes: list[str], radius: float, kind: str = "nearest",
              value: str = "v", pid: str = "pid", background: float = 0.0, **options) -> DataFrame:
    """Render points onto raster positions: the nearest point's value or a radius
    filter; positions with no point within ``radius`` are background."""
    if kind != "nearest":
        return radius_filter(points, grid, keys, axes, radius, kind, value, fill=background, **options)
    spots = grid.select(*keys, *axes)
    best = points.groupBy(*keys, *axes).agg(F.min(F.struct(pid, value)).alias("p"))
    near = near_pairs(spots.distinct(), best, keys, axes, radius)
    found = near.groupBy(*[F.col(f"l.{c}").alias(c) for c in [*keys, *axes]]).agg(
        F.min(F.struct(F.col("d2"), F.col("r.p").alias("p"))).alias("b"))
    return grid.join(found, [*keys, *axes], "left").select(*grid.columns, F.coalesce(F.col(f"b.p.{value}"), F.lit(float(background))).alias("v"))


def place_points(points: DataFrame, positions: DataFrame, shear: dict[str, float], key: str = "stack") -> DataFrame:
    """Sheared stack points in the common frame of the tile positions (ox, oy, oz)."""
    out = points.join(small(positions), key)
    return out.withColumns({
        "x": F.col("x") + F.col("ox") - F.col("oz") * F.lit(float(shear.get("x", 0.0))),
        "y": F.col("y") + F.col("oy") - F.col("oz") * F.lit(float(shear.get("y", 0.0))),
        "z": F.col("z") + F.col("oz")}).drop("ox", "oy", "oz")


def renumber(points: DataFrame, keys: list[str], order: list[str], name: str = "id", chunk: int = 64) -> DataFrame:
    """Number the points of every group 0..n-1 in a fixed order. The first order
    column cuts a group into ranges whose sizes are summed up first, and a range
    of one value is cut again by the second, so no window holds a whole group."""
    first, second = order[0], order[1]
    cells = points.withColumn("_a", F.floor(F.col(first))).withColumn("_b", F.floor(F.col(second) / chunk))
    counts = cells.groupBy(*keys, "_a", "_b").agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.groupBy(*keys, "_a").agg(F.sum("_n").alias("_row"))
    before = Window.partitionBy(*keys).orderBy("_a").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_base", F.coalesce(F.sum("_row").over(before), F.lit(0)))
    within = Window.partitionBy(*keys, "_a").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_skip", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    starts = counts.join(rows, [*keys, "_a"]).select(*keys, "_a", "_b", (F.col("_base") + F.col("_skip")).alias("_start"))
    rank = F.row_number().over(Window.partitionBy(*keys, "_a", "_b").orderBy(*order)) - 1
    return cells.join(starts, [*keys, "_a", "_b"]).withColumn(name, rank + F.col("_start")).drop("_a", "_b", "_start")


# ---- neighbours and descriptors -----------------------------------------------------

def nearest_k(points: DataFrame, keys: list[str], axes: list[str], k: int, radius: float, pid: str = "pid") -> DataFrame:
    """The k nearest other points of every point, exactly (smallest ids on ties);
    points without a place have none and are absent.

    Of many copies at one position only the k + 1 smallest ids can be an answer, so
    k + 2 are listed and searched; who comes after them has the answer of the last.
    The radius doubles for the points that have found too few, until the group runs out."""
    pos = [*keys, *axes]
    placed = points.select(pid, *pos)
    for c in pos:
        placed = placed.where(F.col(c).isNotNull() & (~F.isnan(F.col(c).cast("double")) if c in axes else F.lit(True)))
    rank = F.row_number().over(Window.partitionBy(*pos).orderBy(pid))
    listed = stored(placed.withColumn("_rank", rank).where(F.col("_rank") <= k + 2), "listed")
    totals = small(listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    todo, done = None, None
    while True:
        got = nearest_others(todo, listed, keys, axes, radius, k, pid)
        state = stored(got, "near").join(totals, keys)
        enough = F.col("found") >= F.least(F.lit(k + 1), F.col("_n"))
        ready = state.where(enough).select(pid, *pos, "_rank", "near")
        done = ready if done is None else done.unionByName(ready)
        todo = checkpoint(state.where(~enough).select(*listed.columns))
        if todo.isEmpty():
            break
        radius = radius * 2
    found = done.select(pid, *pos, "near")
    last = done.where(F.col("_rank") == k + 2).select(*pos, F.col(pid).alias("_last"), "near")
    many = last.count()
    if not many:
        return found
    copies = placed.join(F.broadcast(last) if many <= SMALL_ROWS else last, pos).where(F.col(pid) > F.col("_last"))
    return found.unionByName(copies.select(pid, *pos, "near"))


def geometric_descriptors(points: DataFrame, keys: list[str], axes: list[str], radius: float, k: int = 3, pid: str = "pid") -> DataFrame:
    """Rotation-invariant local descriptor: distances of a point to its k nearest
    neighbours, then the distances among these neighbours, in order."""
    near = nearest_k(points, keys, axes, k, radius, pid)

    def gap(i: int, j: int) -> Column:
        a, b = F.col("near")[i], F.col("near")[j]
        return F.sqrt(sum(((a[c] - b[c]) * (a[c] - b[c]) for c in axes), F.lit(0.0)))

    values = [F.sqrt(F.col("near")[i]["d2"]) for i in range(k)] + [gap(i, j) for i in range(k) for j in range(i + 1, k)]
    return near.where(F.size("near") == k).select(*keys, F.col(pid).alias("fid"), *axes, F.array(*values).alias("desc"))


def match_geometric(a: DataFrame, b: DataFrame, keys: list[str], min_ratio: float = 2.0) -> DataFrame:
    """Correspondence where the second-best descriptor is at least ``min_ratio`` times farther."""
    return match_short(a, b, keys, 1.0 / min_ratio)


# ---- point registration ---------------------------------------------------------------

def transform_points(points: DataFrame, models: DataFrame, keys: list[str], dim: int = 3) -> DataFrame:
    ax = "xyz"[:dim]
    mapped = apply_affine(F.col("m"), [F.col(a) for a in ax])
    out = points.join(small(models).select(*keys, "m"), keys, "left")
    return out.withColumns({a: F.coalesce(v, F.col(a)) for a, v in zip(ax, mapped)}).drop("m")


def icp(a: DataFrame, b: DataFrame, keys: list[str], kind: str, max_distance: float, rounds: int = 100, dim: int = 3,
        pid: str = "pid", start: DataFrame | None = None) -> DataFrame:
    """Iterative closest point per key: match each moved a to its nearest b
    within ``max_distance``, refit the model from the original coordinates, stop
    when the match count and the mean distance no longer change."""
    ax = list("xyz"[:dim])
    ends = [f"p{c}" for c in ax]
    own = a.withColumns({f"p{c}": F.col(c).cast("double") for c in ax})  # the original place moves along, so no id is looked up
    moved, last, models = own if start is None else transform_points(own, start, keys, dim), None, None
    for _ in range(rounds):
        rows = nn_join(moved, b, keys, ax, max_distance, pid, pid, ends)
        rows = rows.withColumns({"w": F.lit(1.0), **{f"q{c}": F.col(f"q{c}").cast("double") for c in ax}})
        # sums and error in one pass: the pairs of a round are made once
        fit = matching.moments(rows, keys, dim, more=(F.avg(F.sqrt("d2")).alias("error"),))
        models = checkpoint(matching.model_from_moments(fit, kind, dim).select(*keys, "n", "m", "error"))
        state = models.agg(F.sum("n"), F.round(F.sum("error"), 9)).first()
        if tuple(state) == last:
            break
        last = tuple(state)
        moved = transform_points(own, models, keys, dim)
    return models


def mls_warp(points: DataFrame, matches: DataFrame, keys: list[str], radius: float, kind: str = "affine", dim: int = 3,
             pid: str = "pid") -> DataFrame:
    """Moving-least-squares warp: every point gets its own model from the matches
    within ``radius``, weighted by inverse squared distance. A point on a control
    point maps exactly; with too few controls near, the shift of the near ones,
    and without any, the model of the whole group applies."""
    ax = list("xyz"[:dim])
    # controls at one position act like their mean with their count as weight
    control = matches.groupBy(*keys, *[F.col(f"p{a}").cast("double").alias(a) for a in ax]).agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct(*[F.col(f"q{a}").cast("double").alias(f"q{a}") for a in ax])).alias("hit"),
        *[F.avg(f"q{a}").alias(f"q{a}") for a in ax])
    control = control.withColumns({f"p{a}": F.col(a) for a in ax})
    spots = points.select(*keys, *[F.col(a).cast("double").alias(a) for a in ax]).distinct()
    at = [*keys, *ax]
    exact = control.join(spots, at, "left_semi").select(*at, "hit")
    local = ball_moments(spots, control, keys, ax, radius, kind != "translation")
    local = matching.model_from_moments(local, kind, dim, "m")
    local = matching.model_from_moments(local, "translation", dim, "t")
    group = matching.fit_model(matches.withColumn("w", F.lit(1.0)), keys, kind, dim=dim).select(*keys, F.col("m").alias("_group"))
    out = spots.join(exact, at, "left").join(local.select(*at, "m", "t"), at, "left").join(small(group), keys, "left")
    usable = F.col("m").isNotNull() & ~F.exists("m", lambda c: c.isNull())
    zero = [F.lit(0.0)] * dim
    by_local = [v + F.col(a) for v, a in zip(apply_affine(F.col("m"), zero), ax)]
    by_shift = [v + F.col(a) for v, a in zip(apply_affine(F.col("t"), zero), ax)]
    by_group = apply_affine(F.col("_group"), [F.col(a) for a in ax])
    cells = []
    for i, a in enumerate(ax):
        cells.append(F.when(F.col("hit").isNotNull(), F.col(f"hit.q{a}")).when(usable, by_local[i])
                     .when(F.col("t").isNotNull(), by_shift[i]).otherwise(by_group[i]).alias(f"_{a}"))
    moved = out.select(*at, *cells)
    return points.select(*keys, pid, *[F.col(a).cast("double").alias(a) for a in ax]).join(moved, at).select(
        *keys, pid, *[F.col(f"_{a}").alias(a) for a in ax])
