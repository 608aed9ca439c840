"""Graph operators: connected components and global relaxation of tile models."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelframe.operators import matching
from voxelframe.session import SMALL_ROWS, checkpoint


def components(edges: DataFrame, nodes: DataFrame, keys: list[str], node: str = "node") -> DataFrame:
    """Smallest node of the component of every node (columns u, v of ``edges``).

    Alternating star contraction: every round links the larger neighbours, then
    the smaller ones, of each node to the smallest node in sight. The smallest
    neighbour is a map-side minimum, so a node with very many edges is safe;
    the number of rounds grows with the logarithm of the graph."""
    work = edges.where("u <> v").select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    work = checkpoint(work)
    while True:
        both = work.unionByName(work.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, [*keys, "u"]).where("v > u").select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = large.join(least, [*keys, "u"]).select(*keys, F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        work = checkpoint(small.where("u <> v").distinct())
        parents = work.groupBy(*keys, "u").agg(F.count(F.lit(1)).alias("n"))
        nested = work.select(*keys, F.col("v").alias("u")).join(work, [*keys, "u"], "left_semi")
        if parents.where("n > 1").isEmpty() and nested.isEmpty():
            break
    roots = work.select(*keys, F.col("u").alias(node), F.col("v").alias("component"))
    return nodes.select(*keys, node).join(roots, [*keys, node], "left").select(
        *keys, node, F.coalesce("component", node).alias("component"))


def largest_component(found: DataFrame, keys: list[str], node: str = "node") -> DataFrame:
    """Nodes of the largest component (smallest id on ties)."""
    sizes = found.groupBy(*keys, "component").agg(F.count(F.lit(1)).alias("n"))
    best = sizes.groupBy(*keys).agg((-F.max(F.struct("n", (-F.col("component")).alias("c")))["c"]).alias("component"))
    return found.join(best, [*keys, "component"], "left_semi").select(*keys, node)


def connect_isolated(edges: DataFrame, tiles: DataFrame, keys: list[str], shift: Column, tile: str = "z") -> DataFrame:
    """Link a tile that has no edge to its predecessor with a default shift."""
    ends = edges.select(*keys, F.explode(F.array("a", "b")).alias(tile)).distinct()
    alone = tiles.select(*keys, tile, shift.alias("shift")).join(ends, [*keys, tile], "left_anti")
    extra = alone.join(tiles.select(*keys, (F.col(tile) + 1).alias(tile)), [*keys, tile], "left_semi")
    added = extra.select(*keys, (F.col(tile) - 1).alias("a"), F.col(tile).alias("b"), "shift", F.lit(True).alias("is_default"))
    return edges.select(*keys, "a", "b", "shift", F.lit(False).alias("is_default")).unionByName(added)


# ---- relaxation ---------------------------------------------------------------------------

def edge_moments(matches: DataFrame, keys: list[str], dim: int = 2) -> DataFrame:
    """Sums per tile pair that replace the matches for the rest of the solve;
    both directions, tile ``a`` being the one that moves."""
    forward = matching.moments(matches, [*keys, "a", "b"], dim)

    def turned(name: str) -> Column:
        if name in ("a", "b"):
            return F.col({"a": "b", "b": "a"}[name]).alias(name)
        if name.startswith("sqp_"):
            return F.col("sqp_" + name[:3:-1]).alias(name)
        if name[:2] in ("sp", "sq"):  # squares and plain sums of either end
            return F.col(name.translate(str.maketrans("pq", "qp"))).alias(name)
        return F.col(name)

    return forward.unionByName(forward.select(*[turned(c) for c in forward.columns]))


def _pairs(dim: int) -> list[str]:
    ax = "xyz"[:dim]
    return [u + v for i, u in enumerate(ax) for v in ax[i:]]


def _targets(edges: DataFrame, keys: list[str], dim: int = 2) -> DataFrame:
    """Sums of every moving tile against its neighbours' current positions."""
    m, ax = F.col("mb"), "xyz"[:dim]
    mapped = {}
    for r, a in enumerate(ax):
        row, t = [m[r * (dim + 1) + c] for c in range(dim)], m[r * (dim + 1) + dim]
        mapped[f"sq{a}"] = sum((k * F.col(f"sq{u}") for k, u in zip(row, ax)), t * F.col("sw"))
        for c in ax:
            mapped[f"sqp_{a}{c}"] = sum((k * F.col(f"sqp_{u}{c}") for k, u in zip(row, ax)), t * F.col(f"sp{c}"))
    kept = ["n", "sw", *[f"sp{a}" for a in ax], *[f"spp_{c}" for c in _pairs(dim)]]
    return edges.groupBy(*keys, F.col("a").alias("tile")).agg(
        *[F.sum(c).alias(c) for c in kept], *[F.sum(v).alias(k) for k, v in mapped.items()])


def _edge_error(a: Column, b: Column, dim: int = 2) -> Column:
    """Weighted sum of squared distances A p - B q of an edge, from its sums."""
    ax = [*"xyz"[:dim], "1"]

    def square(end: str, u: str, v: str) -> Column:
        plain = "".join(sorted((u + v).replace("1", "")))
        return F.col("sw" if not plain else f"s{end}{plain}" if len(plain) == 1 else f"s{end}{end}_{plain}")

    def mixed(u: str, v: str) -> Column:
        return F.col(f"sqp_{u}{v}") if "1" not in u + v else F.col("sw" if u == v else f"sq{u}" if v == "1" else f"sp{v}")

    total = F.lit(0.0)
    for r in range(dim):
        for i, u in enumerate(ax):
            for j, v in enumerate(ax):
                at, to = r * (dim + 1) + i, r * (dim + 1) + j
                total = total + a[at] * a[to] * square("p", u, v) + b[at] * b[to] * square("q", u, v)
                total = total - F.lit(2.0) * b[at] * a[to] * mixed(u, v)
    return total


def edge_errors(edges: DataFrame, models: DataFrame, keys: list[str], dim: int = 2) -> DataFrame:
    """Root mean square distance of every pair under the tile models."""
    joined = edges.join(models.select(*keys, F.col("tile").alias("a"), F.col("m").alias("ma")), [*keys, "a"])
    joined = joined.join(models.select(*keys, F.col("tile").alias("b"), F.col("m").alias("mb")), [*keys, "b"])
    square = F.greatest(_edge_error(F.col("ma"), F.col("mb"), dim) / F.col("sw"), F.lit(0.0))
    return joined.select(*keys, "a", "b", "n", "sw", F.sqrt(square).alias("error"))


def _identity(dim: int) -> Column:
    return F.array(*[F.lit(1.0 if r == c else 0.0) for r in range(dim) for c in range(dim + 1)])


def _fit_to(edges: DataFrame, placed: DataFrame, keys: list[str], kind: str, regularizer: str | None, lam: float, dim: int) -> DataFrame:
    """Model (goal) of every tile with a placed neighbour (tile, m); null entries where it has no solution."""
    neighbours = placed.select(*keys, F.col("tile").alias("b"), F.col("m").alias("mb"))
    sums = _targets(edges.join(neighbours, [*keys, "b"]), keys, dim)
    goal = matching.model_of(sums.withColumns({f"sqq_{c}": F.lit(0.0) for c in _pairs(dim)}), kind, regularizer, lam, dim)
    return goal.select(*keys, "tile", F.col("m").alias("goal"))


def _solved(goal: str = "goal") -> Column:
    return F.col(goal).isNotNull() & ~F.exists(goal, lambda c: c.isNull())


# Fixed value: directed tile pairs (a few hundred bytes each) up to which one task runs all rounds of a relaxation in the plane.
TOGETHER = 1 << 18
# Sums that the model of the neighbour moves.
MOVED = [["sqp_xx", "sqp_xy", "sqx"], ["sqp_yx", "sqp_yy", "sqy"]]


def _few(edges: DataFrame, keys: list[str]) -> bool:
    """Whether the tile pairs fit one task and have all their sums."""
    sums = [c for c in edges.columns if c not in (*keys, "a", "b")]
    gaps = F.count_if(F.greatest(*[(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).cast("int") for c in sums]) == 1)
    pairs, missing = edges.agg(F.count(F.lit(1)), gaps).first()
    return 0 < pairs <= TOGETHER and not missing


def _fitted(s: dict[str, np.ndarray], kind: str, regularizer: str | None, lam: float) -> np.ndarray:
    """``matching.model_of`` in the plane on arrays of sums: (tiles, 2, 3), NaN where there is no solution."""
    mp, mq = [np.stack([s[f"s{e}x"], s[f"s{e}y"]], axis=1) / s["sw"][:, None] for e in "pq"]
    w = s["sw"][:, None, None]
    qp = np.stack([s["sqp_xx"], s["sqp_xy"], s["sqp_yx"], s["sqp_yy"]], axis=1).reshape(-1, 2, 2) - w * mq[:, :, None] * mp[:, None, :]
    pp = np.stack([s["spp_xx"], s["spp_xy"], s["spp_xy"], s["spp_yy"]], axis=1).reshape(-1, 2, 2) - w * mp[:, :, None] * mp[:, None, :]

    def model(kind: str) -> np.ndarray:
        if kind in ("translation", "identity"):
            linear = np.broadcast_to(np.eye(2), qp.shape)
        elif kind in ("rigid", "similarity"):
            c, v = qp[:, 0, 0] + qp[:, 1, 1], qp[:, 1, 0] - qp[:, 0, 1]
            norm = np.sqrt(c * c + v * v) if kind == "rigid" else pp[:, 0, 0] + pp[:, 1, 1]
            linear = np.stack([c / norm, -v / norm, v / norm, c / norm], axis=1).reshape(-1, 2, 2)
        elif kind == "affine":
            det = pp[:, 0, 0] * pp[:, 1, 1] - pp[:, 0, 1] * pp[:, 1, 0]
            det = np.where(det != 0, det, np.nan)[:, None]
            first, second = [(qp[:, :, i] * pp[:, None, j, j] - qp[:, :, j] * pp[:, None, i, j]) / det for i, j in ((0, 1), (1, 0))]
            linear = np.stack([first, second], axis=2)
        else:
            raise ValueError(f"unknown model {kind}")
        shift = np.zeros(mq.shape) if kind == "identity" else mq - (linear * mp[:, None, :]).sum(axis=2)
        return np.concatenate([linear, shift[:, :, None]], axis=2)

    return model(kind) if not regularizer else model(kind) * (1.0 - lam) + model(regularizer) * lam


# Fixed value: directed tile pairs that one task of the pre-alignment may hold, unless a single tile has more.
PIECE = 1 << 16


def tile_pieces(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Connected pieces (tile, piece) of a tile graph (directed rows a, b) with at
    most ``PIECE`` rows each; a smaller graph is one piece. In every round half of the pieces, by hash, join a
    neighbour of the other half, as many as fit, the smallest first."""
    totals = edges.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"), F.min("a").alias("_least"))
    pieces = edges.groupBy(*keys, F.col("a").alias("tile")).agg(F.count(F.lit(1)).alias("n")).join(totals, keys)
    pieces = checkpoint(pieces.select(*keys, "tile", F.when(F.col("_total") <= PIECE, F.col("_least")).otherwise(F.col("tile")).alias("piece"), "n"))
    if totals.where(F.col("_total") > PIECE).isEmpty():
        return pieces.select(*keys, "tile", "piece")
    links, turn, idle = checkpoint(edges.select(*keys, "a", "b").where("a <> b").distinct()), 0, 0
    while idle < 4:
        sizes = pieces.groupBy(*keys, "piece").agg(F.sum("n").alias("n"))
        named = {e: pieces.select(*keys, F.col("tile").alias(e), F.col("piece").alias(f"_{e}")) for e in "ab"}
        near = links.join(named["a"], [*keys, "a"]).join(named["b"], [*keys, "b"]).where("_a <> _b").select(*keys, "_a", "_b").distinct()
        side = [F.pmod(F.xxhash64(F.col(c), F.lit(turn)), F.lit(2)) for c in ("_a", "_b")]
        near = near.where((side[0] == 0) & (side[1] == 1))
        near = near.join(sizes.select(*keys, F.col("piece").alias("_a"), F.col("n").alias("_na")), [*keys, "_a"])
        near = near.join(sizes.select(*keys, F.col("piece").alias("_b"), F.col("n").alias("_nb")), [*keys, "_b"]).where(F.col("_na") + F.col("_nb") <= PIECE)
        joins = near.groupBy(*keys, "_a").agg(F.min(F.struct("_nb", "_b", "_na")).alias("to")).select(*keys, F.col("_a").alias("piece"), "to.*")
        upto = F.sum("_na").over(Window.partitionBy(*keys, "_b").orderBy("_na", "piece").rowsBetween(Window.unboundedPreceding, 0))
        joins = joins.withColumn("_upto", upto).where(F.col("_upto") + F.col("_nb") <= PIECE)
        joins = checkpoint(joins.select(*keys, "piece", "_b"))
        turn, idle = turn + 1, idle + 1 if joins.isEmpty() else 0
        pieces = checkpoint(pieces.join(joins, [*keys, "piece"], "left").select(*keys, "tile", F.coalesce("_b", "piece").alias("piece"), "n"))
    return pieces.select(*keys, "tile", "piece")


def _pre_align_shifts(edges: DataFrame, keys: list[str], fixed: DataFrame, dim: int) -> DataFrame:
    """Pre-alignment by translations on pieces of the tile graph. A task walks its
    piece outwards from what it knows of the tiles next to it, so a round passes
    whole pieces and not one tile; the rounds end when no tile's distance
    (``hops``) or shift changes any more."""
    ax = "xyz"[:dim]
    shifts = [f"t{c}" for c in ax]
    pieces = tile_pieces(edges, keys)
    rows = edges.where("a <> b and sw > 0").select(*keys, F.col("a").alias("tile"), "b", "sw", *[(F.col(f"sq{c}") - F.col(f"sp{c}")).alias(f"d{c}") for c in ax])
    rows = rows.join(pieces, [*keys, "tile"]).join(pieces.select(*keys, F.col("tile").alias("b"), F.col("piece").alias("of")), [*keys, "b"])
    rows = checkpoint(rows.withColumn("outside", F.col("piece") != F.col("of")).drop("of"))
    border = checkpoint(rows.where("outside").select(*keys, "piece", F.col("b").alias("tile")).distinct())
    start = fixed.select(*keys, "tile").distinct().join(pieces, [*keys, "tile"])
    start = checkpoint(start.select(*keys, "piece", "tile", F.lit(0).cast("long").alias("hops"), *[F.lit(0.0).alias(t) for t in shifts]))
    schema = ", ".join([*[f"`{c}` {start.schema[c].dataType.simpleString()}" for c in keys], f"piece {start.schema['piece'].dataType.simpleString()}",
                        f"tile {start.schema['tile'].dataType.simpleString()}", "hops long", *[f"{t} double" for t in shifts]])
    names = [*keys, "piece", "tile", "hops", *shifts]

    def walk(links: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if links.empty or known.empty:
            return known[known["tile"].isin(set())][names]
        links = links.sort_values(["tile", "b"])
        tiles, a = np.unique(links["tile"].to_numpy(), return_inverse=True)
        every, other = np.unique(np.concatenate([links["b"].to_numpy(), known["tile"].to_numpy(), tiles]), return_inverse=True)
        b, given, own = np.split(other, [len(links), len(links) + len(known)])
        a = own[a]
        mine = np.zeros(len(every), dtype=bool)
        mine[own] = True
        w, d = links["sw"].to_numpy(), links[[f"d{c}" for c in ax]].to_numpy()
        first = known["hops"].to_numpy()
        far = np.iinfo(np.int64).max
        hops, at = np.full(len(every), far), np.zeros((len(every), dim))
        hops[given], at[given] = first, known[shifts].to_numpy()
        order = np.argsort(b, kind="stable")
        begin = np.searchsorted(b[order], np.arange(len(every) + 1))
        # distances: outwards level by level; tiles outside come in at their own
        waiting = np.sort(np.unique(first))[::-1].tolist()
        while waiting:
            now = waiting.pop()
            front = np.flatnonzero(hops == now)
            to = np.concatenate([order[begin[t]:begin[t + 1]] for t in front]) if len(front) else order[:0]
            new = np.unique(a[to][hops[a[to]] > now + 1])
            hops[new] = now + 1
            if len(new) and (not waiting or waiting[-1] != now + 1):
                waiting.append(now + 1)
            # shifts of this level are complete: the next takes the mean over all its links to it
            use = np.sort(to[(hops[a[to]] == now + 1) & mine[a[to]]])
            if len(use):
                ready, row = np.unique(a[use], return_inverse=True)
                total = np.zeros((len(ready), dim + 1))
                np.add.at(total, row, np.hstack([d[use] + w[use, None] * at[b[use]], w[use, None]]))
                at[ready] = total[:, :dim] / total[:, dim:]
        hit = own[hops[own] < far]
        out = {k: [links[k].iat[0]] * len(hit) for k in [*keys, "piece"]}
        return pd.DataFrame({**out, "tile": every[hit], "hops": hops[hit], **{t: at[hit, i] for i, t in enumerate(shifts)}})[names]

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return walk(x, y)

    group, state = [*keys, "piece"], None
    while True:
        known = start
        if state is not None:
            known = start.unionByName(border.join(state.drop("piece"), [*keys, "tile"]).select(*names))
        new = checkpoint(rows.groupBy(*group).cogroup(known.groupBy(*group)).applyInPandas(run, schema))
        inner = new.join(border.select(*keys, "tile").distinct(), [*keys, "tile"], "left_semi").select(*names)
        if (inner if state is None else inner.exceptAll(state.select(*names))).isEmpty():
            break
        state = new
    found = new.join(start, [*keys, "tile"], "left_anti").select(*keys, "tile", *shifts)
    entries = [F.col(f"t{ax[r]}") if c == dim else F.lit(1.0 if r == c else 0.0) for r in range(dim) for c in range(dim + 1)]
    placed = fixed.select(*keys, "tile").distinct().withColumn("m", _identity(dim))
    return checkpoint(placed.unionByName(found.select(*keys, "tile", F.array(*entries).alias("m"))))


def _pre_align_together(edges: pd.DataFrame, fixed: pd.DataFrame, keys: list[str], kind: str) -> pd.DataFrame:
    """The rounds of ``pre_align`` on the sums of all tile pairs."""
    at = pd.concat([edges[[*keys, "a"]].rename(columns={"a": "tile"}), fixed[[*keys, "tile"]]]).drop_duplicates(ignore_index=True)
    at["_i"] = np.arange(len(at))
    a, b = [edges[[*keys, e]].merge(at.rename(columns={"tile": e}), on=[*keys, e], how="left")["_i"].to_numpy() for e in "ab"]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    s = {c: edges[c].to_numpy(dtype=float)[order] for c in edges.columns if c == "sw" or c[:2] in ("sp", "sq")}
    own, to = np.searchsorted(a, np.arange(len(at) + 1)), np.argsort(b, kind="stable")
    into = np.searchsorted(b[to], np.arange(len(at) + 1))
    m, placed = np.full((len(at), 2, 3), np.nan), np.zeros(len(at), dtype=bool)
    front = fixed[[*keys, "tile"]].merge(at, on=[*keys, "tile"])["_i"].to_numpy()
    m[front], placed[front] = np.eye(2, 3), True
    with np.errstate(all="ignore"):
        while len(front):
            ahead = np.unique(np.concatenate([a[to[into[t]:into[t + 1]]] for t in front]))
            ahead = ahead[~placed[ahead]]
            rows = np.concatenate([np.arange(own[t], own[t + 1]) for t in ahead]) if len(ahead) else own[:0]
            rows = rows[placed[b[rows]]]
            if not len(rows):
                break
            tiles, begin = np.unique(a[rows], return_index=True)
            part = {c: v[rows] for c, v in s.items()}
            c = np.stack([part["sqp_xx"], part["sqp_xy"], part["sqx"], part["sqp_yx"], part["sqp_yy"], part["sqy"], part["spx"], part["spy"], part["sw"]], axis=1)
            moved = np.add.reduceat(m[b[rows]] @ c.reshape(-1, 3, 3), begin, axis=0)
            sums = {k: np.add.reduceat(v, begin) for k, v in part.items()} | {k: moved[:, r, i] for r, row in enumerate(MOVED) for i, k in enumerate(row)}
            goal = _fitted(sums, kind, None, 0.0)
            able = ~np.isnan(goal).any(axis=(1, 2))
            front = tiles[able]
            m[front], placed[front] = goal[able], True
    return at.loc[placed, [*keys, "tile"]].assign(m=list(m[placed].reshape(-1, 6)))


def pre_align(matches: DataFrame, keys: list[str], fixed: DataFrame, kind: str = "translation", dim: int = 2) -> DataFrame:
    """Start models (tile, m): tiles next to placed ones are fitted to them, from
    the fixed tiles outwards, until no tile is reached any more. Translations
    pass a piece of the tile graph a round, other kinds one tile, or all in one
    task for up to ``TOGETHER`` directed pairs in the plane."""
    edges = checkpoint(edge_moments(matches, keys, dim))
    if kind == "translation":
        return _pre_align_shifts(edges, keys, fixed, dim)
    placed = checkpoint(fixed.select(*keys, "tile").distinct().withColumn("m", _identity(dim)))
    if dim == 2 and _few(edges, keys):
        def walk(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
            return _pre_align_together(x, y, keys, kind)

        one = F.lit(0).alias("_all")
        return checkpoint(edges.groupBy(one).cogroup(placed.groupBy(one)).applyInPandas(walk, placed.schema))
    while True:
        ahead = edges.join(placed.select(*keys, F.col("tile").alias("a")), [*keys, "a"], "left_anti")
        # written before it is filtered: a filter would be copied into the formulas of the fit
        new = checkpoint(_fit_to(ahead, placed, keys, kind, None, 0.0, dim)).where(_solved()).withColumnRenamed("goal", "m")
        if new.isEmpty():
            return placed
        placed = checkpoint(placed.unionByName(new))


def _relax_together(edges: pd.DataFrame, models: pd.DataFrame, keys: list[str], kind: str, regularizer: str | None, lam: float, rounds: int,
                    damp: float, plateau: float, patience: int, max_error: float | None, prior_weight: float) -> pd.DataFrame:
    """The rounds of ``relax`` on the sums of all tile pairs; the models with their last state."""
    at = models[[*keys, "tile"]].assign(_i=np.arange(len(models)))
    a, b = [edges[[*keys, e]].merge(at.rename(columns={"tile": e}), on=[*keys, e], how="left")["_i"].to_numpy() for e in "ab"]
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    s = {c: edges[c].to_numpy(dtype=float)[order] for c in edges.columns if c == "sw" or c[:2] in ("sp", "sq")}
    tiles, begin = np.unique(a, return_index=True)
    m = np.stack(models["m"].tolist()).astype(float).reshape(-1, 2, 3)
    free = ~models["held"].to_numpy(dtype=bool)[tiles]
    prior = None
    if "prior" in models:
        prior = np.stack([np.full(6, np.nan) if v is None else v for v in models["prior"]]).astype(float).reshape(-1, 2, 3)[tiles]
        none = np.isnan(prior).any(axis=(1, 2), keepdims=True)
    fixed = {c: np.add.reduceat(v, begin) for c, v in s.items() if c == "sw" or c[:2] == "sp"}
    one = s["sw"]
    p, q = [np.stack([s[f"s{e}{e}_xx"], s[f"s{e}{e}_xy"], s[f"s{e}x"], s[f"s{e}{e}_xy"], s[f"s{e}{e}_yy"], s[f"s{e}y"], s[f"s{e}x"], s[f"s{e}y"], one], axis=1)
            .reshape(-1, 3, 3) for e in "pq"]
    c = np.stack([s["sqp_xx"], s["sqp_xy"], s["sqx"], s["sqp_yx"], s["sqp_yy"], s["sqy"], s["spx"], s["spy"], one], axis=1).reshape(-1, 3, 3)
    best = None
    with np.errstate(all="ignore"):
        for step in range(rounds):
            moved = np.add.reduceat(m[b] @ c, begin, axis=0)
            goal = _fitted(fixed | {k: moved[:, r, i] for r, row in enumerate(MOVED) for i, k in enumerate(row)}, kind, regularizer, lam)
            able = free & ~np.isnan(goal).any(axis=(1, 2))
            if prior is not None:
                goal = np.where(none, goal, goal * (1.0 - prior_weight) + prior * prior_weight)
            m[tiles[able]] = m[tiles[able]] * (1.0 - damp) + goal[able] * damp
            if (step + 1) % patience == 0:
                ma, mb = m[a], m[b]
                square = ((ma @ p) * ma + (mb @ q) * mb - 2.0 * (mb @ c) * ma).sum(axis=(1, 2))
                error = np.sqrt(np.maximum(square / one, 0.0) @ one / one.sum())
                if best is not None and best - error < plateau * max(best, 1e-12) and (max_error is None or error <= max_error):
                    break
                best = error
    return models[[*keys, "tile"]].assign(m=list(m.reshape(-1, 6)))


def relax(matches: DataFrame, keys: list[str], kind: str = "affine", regularizer: str | None = None, lam: float = 0.0,
          fixed: DataFrame | None = None, start: DataFrame | None = None, rounds: int = 1000, damp: float = 0.5,
          plateau: float = 1e-4, patience: int = 5, max_error: float | None = None, dim: int = 2,
          prior: DataFrame | None = None, prior_weight: float = 0.0) -> DataFrame:
    """Move every tile towards the current positions of its neighbours until the
    error stops falling, over ``patience`` rounds, by ``plateau`` of itself; with
    ``max_error`` it must also lie below that. ``rounds`` ends a solve that never
    settles.

    Matches are summed to one row per tile pair once; every round then joins
    these few rows to the tile models. All tiles of a round move together, by
    the fraction ``damp``. Fixed tiles keep their start model. With ``prior``
    (tile, m) every fit is mixed with the tile's prior model by ``prior_weight``.
    A solve in the plane of up to ``TOGETHER`` directed pairs runs its rounds in one task."""
    edges = checkpoint(edge_moments(matches, keys, dim))
    identity = _identity(dim)
    models = edges.select(*keys, F.col("a").alias("tile")).distinct()
    if start is not None:
        models = models.join(start.select(*keys, "tile", "m"), [*keys, "tile"], "left").withColumn("m", F.coalesce("m", identity))
    else:
        models = models.withColumn("m", identity)
    held = models.limit(0).select(*keys, "tile") if fixed is None else fixed.select(*keys, "tile")
    models = models.join(held.withColumn("held", F.lit(True)), [*keys, "tile"], "left").fillna({"held": False})
    if prior is not None:
        models = models.join(prior.select(*keys, "tile", F.col("m").alias("prior")), [*keys, "tile"], "left")
    models = checkpoint(models)
    if dim == 2 and _few(edges, keys):
        schema = models.select(*keys, "tile", "m").schema

        def settle(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
            return _relax_together(x, y, keys, kind, regularizer, lam, rounds, damp, plateau, patience, max_error, prior_weight)

        one = F.lit(0).alias("_all")
        return checkpoint(edges.groupBy(one).cogroup(models.groupBy(one)).applyInPandas(settle, schema))
    # the number of tiles does not change, so one count decides about the broadcast
    spread = F.broadcast if models.count() <= SMALL_ROWS else lambda df: df
    best, extra = None, [] if prior is None else ["prior"]
    for step in range(rounds):
        goal = _fit_to(edges, spread(models), keys, kind, regularizer, lam, dim)
        if dim == 3:  # the formulas of a 3-D fit are long, and are named several times below
            goal = checkpoint(goal)
        moved = models.join(goal, [*keys, "tile"], "left")
        solvable = ~F.col("held") & F.coalesce(_solved(), F.lit(False))
        to = F.col("goal")
        if prior is not None:
            to = F.when(F.col("prior").isNull(), to).otherwise(matching.blend(to, F.col("prior"), prior_weight))
        models = moved.select(
            *keys, "tile", F.when(solvable, matching.blend(F.col("m"), to, damp)).otherwise(F.col("m")).alias("m"), "held", *extra)
        models = checkpoint(models)
        if (step + 1) % patience == 0:
            error = edge_errors(edges, models, keys, dim).agg(F.sqrt(F.sum(F.col("error") ** 2 * F.col("sw")) / F.sum("sw"))).first()[0]
            if best is not None and best - error < plateau * max(best, 1e-12) and (max_error is None or error <= max_error):
                break
            best = error
    return models.drop("held", "prior")


# Stiffness, most rounds and plateau width of the stages of a volume solve.
STAGES_3D = [(1.0, 1000, 250), (0.5, 500, 100), (0.1, 200, 75), (0.01, 100, 25)]


# Most rounds and plateau width of the stages of a solve in the plane.
ROUNDS_2D, PLATEAU_2D = 5000, 200


def relax_staged(matches: DataFrame, keys: list[str], kind: str, regularizer: str, lambdas: list[float],
                 rounds: list[int] | None = None, **options) -> DataFrame:
    """Relax with a stiff model first, then with ever softer ones, each until its
    error settles. ``rounds`` ends the stages earlier."""
    models = options.pop("start", None)
    if rounds is None:
        rounds, options = [ROUNDS_2D] * len(lambdas), {"patience": PLATEAU_2D, **options}
    for lam, n in zip(lambdas, rounds):
        models = relax(matches, keys, kind, regularizer, lam, start=models, rounds=n, **options)
    return models


def solve_volume(matches: DataFrame, keys: list[str], fixed: DataFrame, max_error: float = 5.0, stages: list[tuple] = STAGES_3D, **options) -> DataFrame:
    """Affine 3-D models of tiles, stiffened by translations: pre-aligned from the
    fixed tiles, then relaxed stage by stage."""
    models = pre_align(matches, keys, fixed, dim=3)
    for lam, rounds, width in stages:
        models = relax(matches, keys, "affine", "translation", lam, fixed, models, rounds, patience=width, max_error=max_error, dim=3, **options)
    return models


def drop_worst(matches: DataFrame, keys: list[str], limit: float, kind: str = "translation", dim: int = 3, least: int = 4) -> DataFrame:
    """Take the worst match from every pair whose mean error under its own model
    exceeds ``limit``, one at a time, until none does or ``least`` are left."""
    group, kept = [*keys, "a", "b"], checkpoint(matches)
    while True:
        fit = matching.fit_model(kept, group, kind, dim=dim)
        scored = kept.join(fit, group).withColumn("_e", matching.residual("m", dim))
        mean = scored.groupBy(*group).agg(F.avg("_e").alias("mean"), F.count(F.lit(1)).alias("_k"), F.max(F.struct("_e", "mid"))["mid"].alias("mid"))
        worst = checkpoint(mean.where((F.col("mean") > limit) & (F.col("_k") > least)).select(*group, "mid"))
        if worst.isEmpty():
            return kept
        kept = checkpoint(kept.join(worst, [*group, "mid"], "left_anti"))


def local_versus_global(matches: DataFrame, models: DataFrame, keys: list[str], kind: str = "affine", limit: float = 6.0, dim: int = 2) -> DataFrame:
    """Error of each pair under its own best model and under the global models;
    pairs whose global error exceeds ``limit`` are flagged."""
    from voxelframe.functions.affine import apply_affine
    from voxelframe.operators.matching import fit_model, residual

    own = matches.join(fit_model(matches, [*keys, "a", "b"], kind, dim=dim).drop("n"), [*keys, "a", "b"])
    own = own.groupBy(*keys, "a", "b").agg(F.avg(residual(dim=dim)).alias("local_error"))
    placed = matches.join(models.select(*keys, F.col("tile").alias("a"), F.col("m").alias("ma")), [*keys, "a"])
    placed = placed.join(models.select(*keys, F.col("tile").alias("b"), F.col("m").alias("mb")), [*keys, "b"])
    ends = [apply_affine(F.col(f"m{t}"), [F.col(f"{s}{c}") for c in "xyz"[:dim]]) for t, s in (("a", "p"), ("b", "q"))]
    square = sum(((u - v) * (u - v) for u, v in zip(*ends)), F.lit(0.0))
    both = placed.groupBy(*keys, "a", "b").agg(F.avg(F.sqrt(square)).alias("global_error"))
    return own.join(both, [*keys, "a", "b"]).withColumn("flagged", F.col("global_error") > limit)
