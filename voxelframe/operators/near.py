"""Neighbourhoods of points on blocks.

Space is cut into blocks several radii wide. A target goes to its own block, a
point to every block that it can reach, and one task sees both. Pairs are made
and reduced inside the task, so the rows that move grow with the points and not
with the pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.session import checkpoint, small

# Radii to the edge of a block, rows up to which blocks are wider, rows from which they are halved (down
# to two radii), pairs held at a time; nanoseconds of a step along a line, of a pair and of its products (either way gives the same sums).
EDGE, FEW, ROWS, HELD = 8.0, 20_000, 400_000, 1 << 18
# Points hoped for within the first radius of a search for the nearest, per point asked for; share of the radius it starts from at least;
# candidates and targets of a search that are held at a time, lines an axis.
HOPED, FIRST, MEET, STRETCH, LINES = 8, 1 / 64, 1 << 20, 1 << 16, 1 << 12
STEP, PAIR, PRODUCT = 0.3, 12.0, 2.0


def _cells(df: DataFrame, axes: list[str], edge: float, reach: float = 0.0) -> DataFrame:
    for c in axes:
        df = df.where(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
        low, high = [F.floor((F.col(c) + s * reach) / F.lit(edge)) for s in (-1.0, 1.0)]
        df = df.withColumn(f"_c{c}", F.explode(F.sequence(low, high)) if reach else low)
    return df


def on_blocks(a: DataFrame | None, b: DataFrame, keys: list[str], axes: list[str], radius: float,
              kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str, few: int = FEW) -> DataFrame:
    """Run ``kernel`` (targets, points in reach) on every block that holds targets.
    Without ``a`` every point is a target, and the points move once for both."""
    cell, edge = [*keys, *[f"_c{c}" for c in axes]], EDGE * radius

    def tally(df: DataFrame, side: int) -> DataFrame:
        return _cells(df, axes, edge).groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).withColumn("_side", F.lit(side))

    def both() -> DataFrame:
        return tally(b, 0) if a is None else tally(a, 0).unionByName(tally(b, 1))

    # one count of both sides; sparse points get wider blocks, dense ones narrower
    counts, wide = checkpoint(both()), 3
    while True:
        up = [F.floor(F.col(f"_c{c}") / 2 ** wide).alias(f"_c{c}") for c in axes]
        full = counts.groupBy("_side", *keys, *up).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
        if not wide or full <= few:
            break
        wide -= 1
    edge *= 2 ** wide
    used = counts.where("_side = 0").select(*keys, *up).distinct()
    while full > ROWS and edge > 2 * radius:
        edge, used = edge / 2, None
        full = both().agg(F.max("n")).first()[0]
    right = _cells(b.withColumns({f"_o{c}": F.floor(F.col(c) / F.lit(edge)) for c in axes}) if a is None else b, axes, edge, radius * (1 + 1e-9))
    if used is not None:  # a point that reaches no target's block stays where it is
        right = right.join(small(used), cell, "left_semi")
    if a is None:
        own = F.lit(True)
        for c in axes:
            own = own & (F.col(f"_o{c}") == F.col(f"_c{c}"))
        right = right.withColumn("_own", own).drop(*[f"_o{c}" for c in axes])
        return right.groupBy(*cell).applyInPandas(lambda y: kernel(y[y["_own"].to_numpy()], y), schema)
    left = _cells(a, axes, edge)
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, as both may come from one table

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return kernel(x, y)

    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(run, schema)


def _types(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _batches(p: np.ndarray, q: np.ndarray, radius: float, heap: int = 64):
    """(target rows, point rows in ascending order) that together hold every pair
    within reach, on cells of about ``heap`` points at least."""
    dim, low = p.shape[1], q.min(axis=0)
    space = float(np.prod(np.maximum(q.max(axis=0) - low, 1e-9)))
    edge = max(radius, (heap * space / len(q)) ** (1.0 / dim))
    reach = radius * (1 + 1e-9)
    cells = np.floor((q - low) / edge).astype(np.int64)
    span = cells.max(axis=0) + 1
    step = np.append(np.cumprod(span[::-1])[::-1][1:], 1)
    code = cells @ step
    order = np.argsort(code, kind="stable")
    code = code[order]
    own = np.floor((p - low) / edge).astype(np.int64)
    place = np.lexsort(own.T[::-1])
    cuts = np.flatnonzero((np.diff(own[place], axis=0) != 0).any(axis=1)) + 1
    for rows in np.split(place, cuts):
        first = np.maximum(np.floor((p[rows].min(axis=0) - reach - low) / edge).astype(np.int64), 0)
        last = np.minimum(np.floor((p[rows].max(axis=0) + reach - low) / edge).astype(np.int64), span - 1)
        if (first > last).any():
            continue
        lines = np.stack(np.meshgrid(*[np.arange(u, v + 1) for u, v in zip(first[:-1], last[:-1])], indexing="ij"), -1).reshape(-1, dim - 1) @ step[:-1]
        at, to = np.searchsorted(code, lines + first[-1]), np.searchsorted(code, lines + last[-1], side="right")
        near = np.sort(np.concatenate([order[u:v] for u, v in zip(at, to)]))
        if len(near):
            most = max(1, HELD // len(near))
            for start in range(0, len(rows), most):
                yield rows[start:start + most], near


def _squares(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return sum((p[:, None, c] - q[None, :, c]) ** 2 for c in range(p.shape[1]))


def _pairs(p: np.ndarray, q: np.ndarray, radius: float):
    """(target, point, squared distance) of all pairs within ``radius``, all pairs
    of a target together and about ``MEET`` candidates at a time. Points lie in lines
    along the last axis, a radius wide; a target meets a stretch of the lines around it."""
    dim, low, high = p.shape[1], q.min(axis=0), q.max(axis=0)
    length = high[-1] - low[-1] + 4 * radius + 1
    lines = LINES if length * LINES ** 2 * 4e-16 < radius else 1  # very long lines would lose their places to rounding
    edge = np.maximum(radius * (1 + 1e-9), (high - low)[:-1] / lines)
    cells = np.floor((q[:, :-1] - low[:-1]) / edge).astype(np.int64)
    span = cells.max(axis=0, initial=0) + 1
    step = np.append(np.cumprod(span[::-1])[::-1][1:], 1)[:dim - 1]
    # line and place on it as one number; what rounding may hide is added to the stretch, the distance decides
    key = (cells @ step) * length + (q[:, -1] - low[-1])
    order = np.argsort(key, kind="stable")
    key = key[order]
    reach = radius * (1 + 1e-9) + 4e-16 * float(np.prod(span.astype(float))) * length
    near = np.flatnonzero(((p >= low - radius * (1 + 1e-9)) & (p <= high + radius * (1 + 1e-9))).all(axis=1))
    own = np.floor((p[near, :-1] - low[:-1]) / edge).astype(np.int64)
    at = np.argsort((own @ step) * length + (p[near, -1] - low[-1]), kind="stable")
    near, own = near[at], own[at]
    around = np.array(list(product((-1, 0, 1), repeat=dim - 1)), dtype=np.int64)
    for start in range(0, len(near), STRETCH):
        rows, beside = near[start:start + STRETCH], own[start:start + STRETCH, None, :] + around[None]
        there = ((beside >= 0) & (beside < span)).all(axis=2)
        middle = (beside @ step) * length + (p[rows, -1] - low[-1])[:, None]
        first = np.searchsorted(key, middle - reach)
        many = np.where(there, np.searchsorted(key, middle + reach, side="right") - first, 0)
        upto = many.sum(axis=1).cumsum()
        cuts = np.unique(np.searchsorted(upto, np.arange(MEET, upto[-1], MEET), side="right"))
        for u, w in zip([0, *cuts], [*cuts, len(rows)]):
            n = many[u:w].ravel()
            if not n.any():
                continue
            begin = np.cumsum(n) - n
            point = order[np.arange(n.sum()) + np.repeat(first[u:w].ravel() - begin, n)]
            target = np.repeat(rows[u:w], many[u:w].sum(axis=1))
            d2 = sum((p[target, c] - q[point, c]) ** 2 for c in range(dim))
            inside = d2 <= radius * radius
            yield target[inside], point[inside], d2[inside]


def _closest(p: np.ndarray, q: np.ndarray, n: int, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` nearest rows of q within ``radius`` of every p (first rows on ties)
    and their squared distances; -1 and infinity where there are fewer. Dense points
    are searched within a part of the radius first, so a target meets about as many
    points as it asks for and not all in its ball."""
    who, least = np.full((len(p), n), -1), np.full((len(p), n), np.inf)
    space = np.prod(np.maximum(q.max(axis=0) - q.min(axis=0), 1e-9))
    near_by = 0.5 * (HOPED * n * space / len(q)) ** (1.0 / p.shape[1])
    r, left = min(radius, max(near_by, FIRST * radius)), np.arange(len(p))
    while len(left):
        for target, point, d2 in _pairs(p[left], q, r):
            order = np.lexsort((point, d2, target))
            target, point, d2 = target[order], point[order], d2[order]
            begin = np.flatnonzero(np.append(True, np.diff(target) != 0)[:len(target)])
            rank = np.arange(len(target)) - np.repeat(begin, np.diff(np.append(begin, len(target))))
            kept = rank < n
            rows = left[target[kept]]
            who[rows, rank[kept]], least[rows, rank[kept]] = point[kept], d2[kept]
        if r >= radius:
            break
        r, left = min(radius, 2 * r), left[np.isinf(least[left, n - 1])]
    return who, least


def nearest(a: DataFrame, b: DataFrame, keys: list[str], axes: list[str], radius: float, n: int, pid: str) -> DataFrame:
    """The ``n`` nearest rows of b within ``radius`` of every row of a (smallest ids
    on ties): (keys, axes, near), near an array of (d2, pid, axes) in that order.
    Rows of a without any are absent."""
    columns, parts, one = [*keys, *axes], ["d2", pid, *axes], n == 1  # a single nearest needs no lists
    kinds = {"d2": "double"} | {c: b.schema[c].dataType.simpleString() for c in [pid, *axes]}
    schema = f"{_types(a, columns)}, " + ", ".join(f"_{c} {k if one else f'array<{k}>'}" for c, k in kinds.items())

    def kernel(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        out = x[columns].iloc[:0].assign(**{f"_{c}": pd.Series([], dtype=object) for c in parts})
        if x.empty or y.empty:
            return out
        y = y.sort_values(pid, kind="stable")
        who, least = _closest(x[axes].to_numpy(dtype=float), y[axes].to_numpy(dtype=float), n, radius)
        many = (who >= 0).sum(axis=1)
        hit = np.flatnonzero(many)
        if not len(hit):
            return out
        got = x[columns].iloc[hit]
        for name, cells in [("d2", None), *[(c, y[c].to_numpy()) for c in [pid, *axes]]]:
            table = least[hit] if cells is None else cells[who[hit]]
            got = got.assign(**{f"_{name}": table[:, 0] if one else [row[:m] for row, m in zip(table, many[hit])]})
        return got

    found = on_blocks(a.select(*columns), b.select(pid, *columns), keys, axes, radius, kernel, schema)
    if one:
        return found.select(*columns, F.array(F.struct(*[F.col(f"_{c}").alias(c) for c in parts])).alias("near"))
    return found.select(*columns, _near(parts))


def _near(parts: list[str]) -> Column:
    rows = F.arrays_zip(*[F.col(f"_{c}").alias(c) for c in parts])
    return F.transform(rows, lambda r: F.struct(*[r[c].alias(c) for c in parts])).alias("near")


def nearest_others(a: DataFrame | None, b: DataFrame, keys: list[str], axes: list[str], radius: float, n: int, pid: str) -> DataFrame:
    """The ``n`` nearest other rows of b within ``radius`` of every row of a, a part of b
    (all of b, if None), smallest ids on ties: the rows of a with near, an array of (d2, pid,
    axes) in that order, and found, the rows seen, itself included, up to n + 1. Copies at one place are searched for once."""
    columns, parts = b.columns, ["d2", pid, *axes]
    schema = f"{_types(b, columns)}, found long, _d2 array<double>, " + ", ".join(f"_{c} array<{b.schema[c].dataType.simpleString()}>" for c in [pid, *axes])

    def kernel(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return x[columns].iloc[:0].assign(found=0, **{f"_{c}": pd.Series([], dtype=object) for c in parts})
        y = y.sort_values(pid, kind="stable")
        p = x[axes].to_numpy(dtype=float)
        order = np.lexsort(p.T)
        new = np.append(True, (np.diff(p[order], axis=0) != 0).any(axis=1))
        spot = np.empty(len(p), dtype=np.int64)
        spot[order] = np.cumsum(new) - 1
        who, least = (t[spot] for t in _closest(p[order[new]], y[axes].to_numpy(dtype=float), n + 1, radius))
        cells = {c: y[c].to_numpy() for c in [pid, *axes]}
        there = who >= 0
        kept = there & (cells[pid][who] != x[pid].to_numpy()[:, None])
        first = np.argsort(~kept, axis=1, kind="stable")[:, :n]
        who, least = np.take_along_axis(who, first, axis=1), np.take_along_axis(least, first, axis=1)
        many = np.minimum(kept.sum(axis=1), n)
        got = x[columns].assign(found=there.sum(axis=1))
        for name in parts:
            table = least if name == "d2" else cells[name][who]
            got[f"_{name}"] = list(table) if (many == n).all() else [row[:m] for row, m in zip(table, many)]
        return got

    # a block holds several times as many points as where targets meet all in reach
    done = on_blocks(a, b, keys, axes, radius, kernel, schema, few=4 * FEW)
    return done.select(*columns, "found", _near(parts))


def _shared(p: np.ndarray, q: np.ndarray, radius: float):
    """Rank-compressed axes of both sides, if coordinates repeat so much that whole
    lines of a block are cheaper than its pairs; else None."""
    sides = [[np.unique(m[:, c], return_inverse=True) for c in range(3)] for m in (p, q)]
    cells = np.prod([float(len(u)) for u, _ in sides[1]])
    if cells > 64 * len(q) + 4096:
        return None
    gaps = [(sides[0][c][0][:, None] - sides[1][c][0][None, :]) ** 2 for c in range(3)]
    kinds = np.unique(gaps[1][gaps[1] <= radius * radius])
    return None if len(kinds) > 64 else (sides, gaps, kinds)


def _lines_pay(shared: tuple, p: np.ndarray, q: np.ndarray, radius: float, many: int) -> bool:
    """Whether sums along whole lines cost less than all pairs of neighbouring cells."""
    sides, gaps, kinds = shared
    cells = np.prod([float(len(u)) for u, _ in sides[0]])
    steps = cells * (gaps[0] <= radius * radius).mean() * gaps[0].shape[1] * len(kinds) * len(sides[1][2][0]) * many
    space = np.maximum(q.max(axis=0) - q.min(axis=0), 1e-9)
    edge = max(radius, (64.0 * float(np.prod(space)) / len(q)) ** (1.0 / 3))
    pairs = float(len(p)) * len(q) * float(np.prod(np.minimum(1.0, (2 * radius + edge) / space)))
    return steps * STEP < pairs * (PAIR + PRODUCT * many)


def ball_sums(p: np.ndarray, q: np.ndarray, values: list[np.ndarray], weights: list[Callable | None], radius: float) -> np.ndarray:
    """Sums over the points q within ``radius`` of every p, value by value, each
    times its function of the squared distance. Exact at the border of the ball."""
    r2, out = radius * radius, np.zeros((len(values), len(p)))
    shared = _shared(p, q, radius) if p.shape[1] == 3 else None
    if shared is None or not _lines_pay(shared, p, q, radius, len(values)):
        table = np.stack(values, axis=1)
        for rows, near in _batches(p, q, radius):
            d2 = _squares(p[rows], q[near])
            inside = d2 <= r2
            for w in dict.fromkeys(weights):
                same = [i for i, other in enumerate(weights) if other is w]
                out[np.ix_(same, rows)] = ((inside.astype(float) if w is None else np.where(inside, w(d2), 0.0)) @ table[np.ix_(near, same)]).T
        return out
    sides, gaps, kinds = shared
    (nx, ny, nz), (mx, my, mz) = [[len(u) for u, _ in side] for side in sides]
    at, to = [tuple(i for _, i in side) for side in sides]
    pick = [(gaps[1] == k).astype(float) for k in kinds]
    for w in dict.fromkeys(weights):
        same = [i for i, other in enumerate(weights) if other is w]
        dense, sums, filters = np.zeros((mx, len(same), my, mz)), np.zeros((nx, len(same) * ny, nz)), {}
        for j, i in enumerate(same):
            np.add.at(dense, (to[0], j, to[1], to[2]), values[i])
        for x2 in range(mx):
            near = np.flatnonzero(gaps[0][:, x2] <= r2)
            if not len(near) or not dense[x2].any():
                continue
            # the points of one plane, added up over the lines at one distance
            lines = [(m @ dense[x2]).reshape(-1, mz) for m in pick]
            for x1 in near:
                for k, line in zip(kinds, lines):
                    c = gaps[0][x1, x2] + k
                    if c > r2:
                        break
                    if c not in filters:
                        if len(filters) > 1024:
                            filters.clear()
                        d2 = c + gaps[2].T
                        filters[c] = (d2 <= r2).astype(float) if w is None else np.where(d2 <= r2, w(d2), 0.0)
                    sums[x1] += line @ filters[c]
        sums = sums.reshape(nx, len(same), ny, nz)
        for j, i in enumerate(same):
            out[i] = sums[:, j][at]
    return out


def _middle(counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Median of every row from the counts of the ascending ``values``; NaN where nothing counts."""
    upto = counts.cumsum(axis=1)
    total = upto[:, -1]
    low, high = [np.minimum((upto <= rank[:, None]).sum(axis=1), len(values) - 1) for rank in ((total - 1) // 2, total // 2)]
    return np.where(total > 0, (values[low] + values[high]) / 2.0, np.nan)


def ball_medians(p: np.ndarray, q: np.ndarray, v: np.ndarray, n: np.ndarray, radius: float) -> np.ndarray:
    """Median over the points q within ``radius`` of every p, a point counting n
    times; NaN where there is none. Exact, at the border of the ball too."""
    r2, out = radius * radius, np.full(len(p), np.nan)
    ranked, rank = np.unique(v, return_inverse=True)
    shared = _shared(p, q, radius) if p.shape[1] == 3 else None
    if shared is not None:
        (sx, sy, sz), gaps, kinds = [[side[c] for side in shared[0]] for c in range(3)], shared[1], shared[2]
        across = np.unique(gaps[0][gaps[0] <= r2])
        if len(across) * len(kinds) * gaps[2].size > 1 << 25:
            shared = None
    if shared is None:
        for rows, near in _batches(p, q, radius):
            near = near[np.argsort(rank[near], kind="stable")]
            out[rows] = _middle(np.where(_squares(p[rows], q[near]) <= r2, n[near], 0), v[near])
        return out
    # targets of a line along z that a point counts for, by the distances of its line in x and y: from first to last
    reached = across[:, None, None, None] + kinds[None, :, None, None] + gaps[2].T[None, None] <= r2
    nz = len(sz[0][0])
    first, last = reached.argmax(axis=3), nz - reached[..., ::-1].argmax(axis=3)
    first[~reached.any(axis=3)] = last[~reached.any(axis=3)] = nz
    first, last = first.ravel(), last.ravel()
    my, mz = len(sy[1][0]), len(sz[1][0])
    order = np.lexsort((sz[1][1], sy[1][1], sx[1][1]))
    y2, z2, rank, n = sy[1][1][order], sz[1][1][order], rank[order], n[order]
    starts = np.searchsorted(sx[1][1][order] * my + y2, np.arange(len(sx[1][0]) * my + 1))
    kind = np.searchsorted(kinds, np.minimum(gaps[1], kinds[-1] if len(kinds) else 0.0)) * mz
    lines = np.lexsort((sz[0][1], sy[0][1], sx[0][1]))
    cuts = np.flatnonzero((np.diff(sx[0][1][lines]) != 0) | (np.diff(sy[0][1][lines]) != 0)) + 1
    for rows in np.split(lines, cuts):
        x1, y1 = sx[0][1][rows[0]], sy[0][1][rows[0]]
        spans = []
        for x2 in np.flatnonzero(gaps[0][x1] <= r2):
            inside = np.flatnonzero(gaps[0][x1, x2] + gaps[1][y1] <= r2)
            if len(inside):
                u, w = starts[x2 * my + inside[0]], starts[x2 * my + inside[-1] + 1]
                if w > u:
                    spans.append((u, w, np.searchsorted(across, gaps[0][x1, x2]) * len(kinds) * mz))
        if not spans:
            continue
        at = np.concatenate([np.arange(u, w) for u, w, _ in spans])
        code = np.repeat([c for _, _, c in spans], [w - u for u, w, _ in spans]) + kind[y1, y2[at]] + z2[at]
        level, known = rank[at], len(ranked)
        names = ranked
        if known > 4 * len(at):
            used, level = np.unique(level, return_inverse=True)
            names, known = ranked[used], len(used)
        steps = np.bincount(first[code] * known + level, n[at], (nz + 1) * known) - np.bincount(last[code] * known + level, n[at], (nz + 1) * known)
        spots = sz[0][1][rows]
        out[rows] = _middle(steps.reshape(nz + 1, known).cumsum(axis=0)[spots], names)
    return out


def ball_filter(spots: DataFrame, heaps: DataFrame, keys: list[str], axes: list[str], radius: float, kind: str, sigma: float,
                normalize: str | None, weight: Callable | None = None) -> DataFrame:
    """Mean, density, Gaussian or weighted sum (``weight`` of the squared distance)
    of the heaps (n points with sum s) around every spot, as (keys, axes, v).
    Spots with no point in reach are absent."""
    columns = [*keys, *axes]

    def gauss(d2: np.ndarray) -> np.ndarray:
        return np.exp(-d2 / (2.0 * sigma * sigma))

    def kernel(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return x[columns].iloc[:0].assign(v=0.0)
        p, q = x[axes].to_numpy(dtype=float), y[axes].to_numpy(dtype=float)
        n, s = y["n"].to_numpy(dtype=float), y["s"].to_numpy(dtype=float)
        full = ~np.isnan(s)  # a heap of nulls counts, but has no sum
        some = full.astype(float)
        s = np.where(full, s, 0.0)
        values, weights = {"density": ([n], [None]), "mean": ([n, s, some], [None, None, None]), "sum": ([n, s, some], [None, weight, None]),
                           "gauss": {"weights": ([n, s, some, n], [None, gauss, None, gauss]), "samples": ([n, s, some], [None, gauss, None]),
                                     None: ([n, s, some], [None, gauss, None])}[normalize]}[kind]
        sums = ball_sums(p, q, values, weights, radius)
        below = 1.0 if kind in ("density", "sum") else sums[0] if kind == "mean" or normalize == "samples" else sums[3] if normalize else 1.0
        with np.errstate(all="ignore"):
            v = sums[0] if kind == "density" else np.where(sums[2] > 0, sums[1] / below, np.nan)
        hit = sums[0] > 0
        return x[columns][hit].assign(v=v[hit])

    schema = f"{_types(spots, columns)}, v double"
    found = on_blocks(spots.select(*columns), heaps.select(*columns, "n", F.col("s").cast("double").alias("s")), keys, axes, radius, kernel, schema)
    return found.withColumn("v", F.nanvl("v", F.lit(None).cast("double")))


def ball_median(spots: DataFrame, heaps: DataFrame, keys: list[str], axes: list[str], radius: float) -> DataFrame:
    """Median of the heaps (n points of value v at one position) around every
    spot, as (keys, axes, v). Spots with no point in reach are absent."""
    columns = [*keys, *axes]

    def kernel(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return x[columns].iloc[:0].assign(v=0.0)
        v = ball_medians(x[axes].to_numpy(dtype=float), y[axes].to_numpy(dtype=float), y["v"].to_numpy(dtype=float), y["n"].to_numpy(), radius)
        return x[columns].assign(v=v)[~np.isnan(v)]

    rows = heaps.select(*columns, F.col("v").cast("double").alias("v"), "n")
    return on_blocks(spots.select(*columns), rows, keys, axes, radius, kernel, f"{_types(spots, columns)}, v double")


def inverse_square(d2: np.ndarray) -> np.ndarray:
    return np.divide(1.0, d2, out=np.zeros(d2.shape), where=d2 > 0)


def ball_moments(spots: DataFrame, controls: DataFrame, keys: list[str], axes: list[str], radius: float, second: bool) -> DataFrame:
    """Sums over the controls (copies of a match p -> q, at p) around every spot,
    seen from the spot and weighted by inverse squared distance, as
    ``matching.moments`` names them. Without ``second`` only shifts count: q is
    taken from p, the sums of p and of products are 0. A control on the spot does
    not count; spots with no other are absent."""
    columns = [*keys, *axes]
    ends = [f"{s}{c}" for s in "pq" for c in axes]
    products = [(f"p{a}", f"p{b}") for i, a in enumerate(axes) for b in axes[i:]] + [(f"q{a}", f"p{b}") for a in axes for b in axes]
    names = ["sw", *[f"s{e}" for e in ends], *[f"s{u[0]}{v[0]}_{u[1:]}{v[1:]}" for u, v in products]]

    def kernel(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return x[columns].iloc[:0].assign(**{c: 0.0 for c in names})
        p, q = x[axes].to_numpy(dtype=float), y[axes].to_numpy(dtype=float)
        middle = p.mean(axis=0)
        n = y["copies"].to_numpy(dtype=float)
        place = {e: np.nan_to_num(y[e].to_numpy(dtype=float) - middle[axes.index(e[1:])]) for e in ends}
        if not second:
            moves = [n * np.nan_to_num(y[f"q{c}"].to_numpy(dtype=float) - y[f"p{c}"].to_numpy(dtype=float)) for c in axes]
            sums = ball_sums(p, q, [n, *moves], [inverse_square] * (1 + len(axes)), radius)
            out = dict.fromkeys(names, 0.0) | {"sw": sums[0]} | {f"sq{c}": sums[1 + i] for i, c in enumerate(axes)}
            return x[columns].assign(**out)[sums[0] > 0]
        values = [n, *[n * place[e] for e in ends], *[n * place[u] * place[v] for u, v in products]]
        sums = ball_sums(p, q, values, [inverse_square] * len(values), radius)
        seen = {e: (p - middle)[:, axes.index(e[1:])] for e in ends}
        raw = dict(zip(ends, sums[1:]))
        out = {"sw": sums[0], **{f"s{e}": raw[e] - seen[e] * sums[0] for e in ends}}
        for i, (u, v) in enumerate(products):
            out[names[1 + len(ends) + i]] = sums[1 + len(ends) + i] - seen[u] * raw[v] - seen[v] * raw[u] + seen[u] * seen[v] * sums[0]
        return x[columns].assign(**out)[sums[0] > 0]

    schema = f"{_types(spots, columns)}, " + ", ".join(f"{c} double" for c in names)
    return on_blocks(spots.select(*columns), controls.select(*columns, "copies", *ends), keys, axes, radius, kernel, schema)
