"""Model fitting and match filtering on match rows (px, py, qx, qy[, pz, qz], w).

Fits come from sums, so they combine on the map side. Consensus search keeps
matches distributed: seeds drawn from all matches of a pair yield the hypotheses,
all matches vote in bounded lanes, and only models and counts leave a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelframe.operators.stats import top_per_group
from voxelframe.session import checkpoint, small

CHUNK = 2048
# Fixed value: matches of a group that one consensus task takes.
LANE = 32768


def fit_shear(shifts: DataFrame, keys: list[str]) -> DataFrame:
    """Regression line of the per-slice shift on z."""
    z = F.col("z").cast("double")
    return shifts.groupBy(*keys).agg(
        F.regr_slope("tx", z).alias("sx"), F.regr_intercept("tx", z).alias("ox"),
        F.regr_slope("ty", z).alias("sy"), F.regr_intercept("ty", z).alias("oy"))


# ---- least squares ------------------------------------------------------------

def _axes(dim: int) -> str:
    return "xyz"[:dim]


def moments(matches: DataFrame, keys: list[str], dim: int = 2, weight: Column | None = None, more: tuple = ()) -> DataFrame:
    """Weighted sums that determine every least-squares model of a group, and ``more`` aggregations of the same pass."""
    w = F.col("w") if weight is None else weight
    ax = _axes(dim)
    aggs = [F.sum(w).alias("sw"), F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(w * F.col(f"{s}{a}")).alias(f"s{s}{a}") for s in "pq" for a in ax]
    aggs += [F.sum(w * F.col(f"p{a}") * F.col(f"p{b}")).alias(f"spp_{a}{b}") for i, a in enumerate(ax) for b in ax[i:]]
    aggs += [F.sum(w * F.col(f"q{a}") * F.col(f"q{b}")).alias(f"sqq_{a}{b}") for i, a in enumerate(ax) for b in ax[i:]]
    aggs += [F.sum(w * F.col(f"q{a}") * F.col(f"p{b}")).alias(f"sqp_{a}{b}") for a in ax for b in ax]
    return matches.groupBy(*keys).agg(*aggs, *more)


def _pp(a: str, b: str) -> Column:
    return F.col("spp_" + "".join(sorted(a + b)))


def _determinant(m: list[list[Column]]) -> Column:
    if len(m) == 2:
        return m[0][0] * m[1][1] - m[0][1] * m[1][0]
    return (m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
            - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
            + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0]))


def model_from_moments(sums: DataFrame, kind: str, dim: int = 2, name: str = "m") -> DataFrame:
    """Add the model array of one kind: translation, rigid (2-D), similarity (2-D) or affine."""
    ax = _axes(dim)
    out = sums
    for a in ax:
        out = out.withColumn(f"_mp{a}", F.col(f"sp{a}") / F.col("sw")).withColumn(f"_mq{a}", F.col(f"sq{a}") / F.col("sw"))
    out = out.withColumns({f"_qp_{a}{b}": F.col(f"sqp_{a}{b}") - F.col("sw") * F.col(f"_mq{a}") * F.col(f"_mp{b}") for a in ax for b in ax})
    out = out.withColumns({f"_pp_{a}{b}": _pp(a, b) - F.col("sw") * F.col(f"_mp{a}") * F.col(f"_mp{b}") for a in ax for b in ax})
    if kind == "translation":
        linear = [[F.lit(1.0 if a == b else 0.0) for b in ax] for a in ax]
    elif kind in ("rigid", "similarity"):
        if dim != 2:
            raise ValueError(f"{kind} models are two-dimensional")
        c = F.col("_qp_xx") + F.col("_qp_yy")
        s = F.col("_qp_yx") - F.col("_qp_xy")
        norm = F.sqrt(c * c + s * s) if kind == "rigid" else F.col("_pp_xx") + F.col("_pp_yy")
        out = out.withColumn("_c", c / norm).withColumn("_s", s / norm)
        linear = [[F.col("_c"), -F.col("_s")], [F.col("_s"), F.col("_c")]]
    elif kind == "affine":
        grid = [[F.col(f"_pp_{a}{b}") for b in ax] for a in ax]
        out = out.withColumn("_det", _determinant(grid))
        linear = []
        for a in ax:
            right = [F.col(f"_qp_{a}{b}") for b in ax]
            row = []
            for j in range(dim):
                swapped = [[right[i] if c == j else grid[i][c] for c in range(dim)] for i in range(dim)]
                row.append(F.when(F.col("_det") != 0, _determinant(swapped) / F.col("_det")))
            linear.append(row)
        out = out.withColumns({f"_l{r}{c}": linear[r][c] for r in range(dim) for c in range(dim)})
        linear = [[F.col(f"_l{r}{c}") for c in range(dim)] for r in range(dim)]
    else:
        raise ValueError(f"unknown model {kind}")
    cells = []
    for r, a in enumerate(ax):
        shift = F.col(f"_mq{a}")
        for c, b in enumerate(ax):
            shift = shift - linear[r][c] * F.col(f"_mp{b}")
        cells += [*linear[r], shift]
    out = out.withColumn(name, F.array(*cells))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def blend(a: Column, b: Column, lam: float) -> Column:
    """(1 - lam) a + lam b, coefficient by coefficient."""
    return F.zip_with(a, b, lambda u, v: u * F.lit(1.0 - lam) + v * F.lit(lam))


def model_of(sums: DataFrame, kind: str, regularizer: str | None = None, lam: float = 0.0, dim: int = 2) -> DataFrame:
    out = model_from_moments(sums, kind, dim)
    if regularizer == "identity":
        one = F.array(*[F.lit(1.0 if c == r else 0.0) for r in range(dim) for c in range(dim + 1)])
        return out.withColumn("m", blend(F.col("m"), one, lam))
    if regularizer:
        out = model_from_moments(out, regularizer, dim, "stiff")
        return out.withColumn("m", blend(F.col("m"), F.col("stiff"), lam)).drop("stiff")
    return out


def fit_model(matches: DataFrame, keys: list[str], kind: str = "affine", regularizer: str | None = None,
              lam: float = 0.0, dim: int = 2) -> DataFrame:
    """Least-squares model of every group, optionally blended with a stiffer one."""
    return model_of(moments(matches, keys, dim), kind, regularizer, lam, dim).select(*keys, "n", "m")


def residual(matrix: str = "m", dim: int = 2) -> Column:
    from voxelframe.functions.affine import apply_affine

    ax = _axes(dim)
    mapped = apply_affine(F.col(matrix), [F.col(f"p{a}") for a in ax])
    total = F.lit(0.0)
    for value, a in zip(mapped, ax):
        total = total + (value - F.col(f"q{a}")) * (value - F.col(f"q{a}"))
    return F.sqrt(total)


# ---- consensus -------------------------------------------------------------------

def _seeds(kind: str, dim: int) -> int:
    """Matches needed to determine a model."""
    return {"translation": 1, "rigid": 2, "similarity": 2, "affine": dim + 1}[kind]


def _solve_seed(p: np.ndarray, q: np.ndarray, kind: str) -> np.ndarray:
    """Exact models of many small seed sets: p, q (h, k, dim) -> (h, dim * (dim + 1))."""
    h, _, dim = p.shape
    if kind == "affine":
        left = np.concatenate([p, np.ones((h, dim + 1, 1))], axis=2)
        solvable = np.abs(np.linalg.det(left)) > 1e-9
        left[~solvable] = np.eye(dim + 1)
        model = np.linalg.solve(left, q).transpose(0, 2, 1)
        model[~solvable] = np.nan
        return model.reshape(h, -1)
    mp, mq = p.mean(axis=1), q.mean(axis=1)
    if kind == "translation":
        return np.concatenate([np.broadcast_to(np.eye(dim), (h, dim, dim)), (mq - mp)[:, :, None]], axis=2).reshape(h, -1)
    u, v = p[:, 1] - p[:, 0], q[:, 1] - q[:, 0]
    c, s = (u * v).sum(axis=1), u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]
    norm = np.hypot(c, s) if kind == "rigid" else (u * u).sum(axis=1)
    with np.errstate(all="ignore"):
        c, s = c / norm, s / norm
    tx = mq[:, 0] - c * mp[:, 0] + s * mp[:, 1]
    ty = mq[:, 1] - s * mp[:, 0] - c * mp[:, 1]
    return np.stack([c, -s, tx, s, c, ty], axis=1)


def ransac(matches: DataFrame, keys: list[str], kind: str = "affine", iterations: int = 10000, epsilon: float = 10.0,
           min_ratio: float = 0.0, min_inliers: int = 7, seed: int = 1, identity: str = "mid", refine: int = 2, dim: int = 2,
           lane: int = LANE) -> DataFrame:
    """Inliers of the model with the largest consensus of every group.

    The seeds of ``iterations`` hypotheses are drawn from all matches of a group:
    without repetition where there are enough, so the rows that leave a group are
    as many as the hypotheses can use. All matches vote. A group of up to ``lane``
    matches is settled in one task, which returns its model only; a larger one is
    cut into lanes that meet its pool of seeds and return one count a hypothesis.
    Hypotheses are made where they are used and never move. Returns the match
    rows of groups that reach the minimum consensus."""
    matches = checkpoint(matches)
    k = _seeds(kind, dim)
    ends = [f"{s}{a}" for s in "pq" for a in _axes(dim)]
    most = max(CHUNK, iterations * k)
    order = [F.xxhash64(identity, F.lit(seed)), F.col(identity)]

    def cells(rows: pd.DataFrame) -> np.ndarray:
        return rows[ends].to_numpy(dtype=float)

    def hypotheses(rows: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(seed)
        if len(rows) > CHUNK and len(rows) >= iterations * k:
            picks = rng.permutation(len(rows))[:iterations * k].reshape(iterations, k)
        else:
            picks = rng.integers(0, len(rows), size=(iterations, k))
        if k == 1:  # the same match again gives the same model, and the first one wins a tie
            picks = picks[np.sort(np.unique(picks[:, 0], return_index=True)[1])]
        return _solve_seed(rows[picks, :dim], rows[picks, dim:], kind)

    def votes(models: np.ndarray, rows: np.ndarray) -> np.ndarray:
        m, total = models.reshape(-1, dim, dim + 1), np.zeros(len(models), dtype=np.int64)
        for start in range(0, len(rows), CHUNK):
            part = rows[start:start + CHUNK]
            for at in range(0, len(m), 512):
                h = m[at:at + 512]
                gap = sum((h[:, r, :dim] @ part[:, :dim].T + h[:, r, dim:] - part[:, dim + r]) ** 2 for r in range(dim))
                with np.errstate(invalid="ignore"):
                    total[at:at + 512] += (gap < epsilon * epsilon).sum(axis=1)
        return total

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        points = cells(rows.sort_values(["_o", "_i", *ends], kind="stable"))
        models = hypotheses(points[:most])
        return rows[keys].iloc[:1].assign(m=[models[votes(models, points).argmax()]])

    def count(rows: pd.DataFrame, pool: pd.DataFrame) -> pd.DataFrame:
        models = hypotheses(cells(pool.sort_values("rank")))
        return rows[keys].iloc[:1].assign(votes=[votes(models, cells(rows))])

    def pick(pool: pd.DataFrame) -> pd.DataFrame:
        models = hypotheses(cells(pool.sort_values("rank")))
        return pool[keys].iloc[:1].assign(m=[models[pool["_h"].iat[0]]])

    counts = small(matches.groupBy(*keys).agg(F.count(F.lit(1)).alias("total")))
    named = matches.select(*keys, identity, *[F.col(c).cast("double").alias(c) for c in ends]).join(counts, keys)
    key = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in matches.select(*keys).schema)
    whole = named.where(F.col("total") <= lane).select(*keys, order[0].alias("_o"), F.col(identity).alias("_i"), *ends)
    chosen = whole.groupBy(*keys).applyInPandas(settle, f"{key}, m array<double>")
    wide = counts.where(F.col("total") > lane).select(*keys, F.ceil(F.col("total") / lane).alias("_lanes"))
    if not wide.isEmpty():
        rows = matches.select(*keys, identity, *[F.col(c).cast("double").alias(c) for c in ends]).join(small(wide), keys)
        pool = checkpoint(top_per_group(rows.drop("_lanes"), keys, order, most, [identity]))
        lanes = rows.withColumn("_lane", F.pmod(F.xxhash64(identity, F.lit(seed + 1)), F.col("_lanes"))).drop("_lanes")
        seen = pool.join(small(wide), keys).withColumn("_lane", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_lanes") - 1)))
        seen = seen.select(*[F.col(c).alias(c) for c in [*keys, "_lane", "rank", *ends]])  # columns of its own, apart from those of the lanes
        sums = lanes.groupBy(*keys, "_lane").cogroup(seen.groupBy(*keys, "_lane")).applyInPandas(count, f"{key}, votes array<long>")
        best = sums.select(*keys, F.posexplode("votes").alias("h", "votes")).groupBy(*keys, "h").agg(F.sum("votes").alias("votes"))
        best = best.groupBy(*keys).agg((-F.max(F.struct("votes", (-F.col("h")).alias("o")))["o"]).alias("_h"))
        chosen = chosen.unionByName(pool.join(small(best), keys).groupBy(*keys).applyInPandas(pick, f"{key}, m array<double>"))
    for step in range(refine + 1):
        # one row per group, materialised so that the vote is not repeated
        inside = matches.join(small(chosen), keys).where(residual("m", dim) < epsilon).drop("m")
        if step < refine:
            # a model without solution has null residuals and so no inliers
            chosen = fit_model(inside, keys, kind, dim=dim).select(*keys, "m")
    kept = inside.groupBy(*keys).agg(F.count(F.lit(1)).alias("inliers")).join(counts, keys)
    kept = kept.where((F.col("inliers") >= min_inliers) & (F.col("inliers") >= F.col("total") * F.lit(min_ratio)))
    return inside.join(kept.select(*keys), keys, "left_semi")


def multi_consensus(matches: DataFrame, keys: list[str], identity: str = "mid", **options) -> DataFrame:
    """Repeat the consensus search on what is left until no group yields a set;
    all groups advance together. Adds the set number."""
    rest, found, number = matches, None, 0
    while True:
        inside = checkpoint(ransac(rest, keys, identity=identity, **options).withColumn("consensus", F.lit(number)))
        if inside.isEmpty():
            break
        found = inside if found is None else found.unionByName(inside)
        rest = checkpoint(rest.join(inside.select(*keys, identity), [*keys, identity], "left_anti")
                          .join(inside.select(*keys).distinct(), keys, "left_semi"))
        if rest.isEmpty():
            break
        number += 1
    return matches.withColumn("consensus", F.lit(0)).where(F.lit(False)) if found is None else found


# ---- descriptors -------------------------------------------------------------------

# Fixed value: bytes of descriptors that one side of a matching task holds.
PIECE_BYTES = 1 << 22


def _tiled(features: DataFrame, keys: list[str], prefix: str, other: DataFrame) -> DataFrame:
    """Bounded pieces of descriptors, copied once per piece of the other side."""
    rows = features.join(other, keys).withColumn(prefix, F.pmod(F.xxhash64("fid"), F.col("pieces")))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("other") - 1)).alias("t" if prefix == "s" else "s")
    rows = rows.select(*keys, prefix, F.col("fid"), F.col("desc").cast("array<double>").alias("desc"), copies)
    # columns of its own, as both sides may come from one table
    return rows.select(*[F.col(c).alias(c) for c in [*keys, "s", "t", "fid", "desc"]])


# Sources that meet a stretch of targets at a time, pairs whose distances are added up at a time.
SOURCES, EXACT = 512, 1 << 16


def two_closest(p: np.ndarray, q: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """The two nearest rows of q of every p (first rows on ties; -1 where there are
    fewer) and their squared distances, as sums in order of the values. A product
    of matrices tells which pairs can be among them, within the bound of its
    rounding; only their distances are added up. Rows that are not finite take no part."""
    who, least = np.full((len(p), 2), -1), np.full((len(p), 2), np.inf)
    rows, cols = [np.flatnonzero(np.isfinite(m).all(axis=1)) for m in (p, q)]
    if not len(rows) or not len(cols):
        return who, least
    middle = q[cols].mean(axis=0)
    u, v = p[rows] - middle, q[cols] - middle
    nu, nv = (u * u).sum(axis=1), (v * v).sum(axis=1)
    scale = (p[rows] ** 2).sum(axis=1) + (q[cols] ** 2).sum(axis=1).max() + nu + nv.max()
    slack = 2.3e-16 * (8 * p.shape[1] + 64) * scale
    for start in range(0, len(rows), SOURCES):
        part = slice(start, start + SOURCES)
        own = rows[part]
        for at in range(0, len(cols), chunk):
            gap = nu[part, None] + nv[None, at:at + chunk] - 2.0 * (u[part] @ v[at:at + chunk].T)
            second = np.partition(gap, 1, axis=1)[:, 1] if gap.shape[1] > 1 else gap[:, 0]
            limit = np.minimum(second, least[own, 1]) + 2 * slack[part]
            source, target = np.nonzero(gap <= limit[:, None])
            if not len(source):
                continue
            source, target, d2 = own[source], cols[at + target], np.empty(len(source))
            for first in range(0, len(source), EXACT):
                some = slice(first, first + EXACT)
                x, y = p[source[some]], q[target[some]]
                d2[some] = sum((x[:, c] - y[:, c]) ** 2 for c in range(p.shape[1]))
            # together with the two known so far
            known, slot = np.nonzero(who[own] >= 0)
            source, target, d2 = [np.concatenate(pair) for pair in ((own[known], source), (who[own[known], slot], target), (least[own[known], slot], d2))]
            order = np.lexsort((target, d2, source))
            source, target, d2 = source[order], target[order], d2[order]
            begin = np.flatnonzero(np.append(True, source[1:] != source[:-1]))
            rank = np.arange(len(source)) - np.repeat(begin, np.diff(np.append(begin, len(source))))
            kept = rank < 2
            who[source[kept], rank[kept]], least[source[kept], rank[kept]] = target[kept], d2[kept]
    return who, least


def match_features(a: DataFrame, b: DataFrame, keys: list[str], ratio: float = 0.92, unique: bool = True,
                   chunk: int = 1024) -> DataFrame:
    """Nearest-descriptor matches of every group whose distance ratio to the
    second nearest stays below ``ratio``.

    Exact: bounded pieces of both sides meet pairwise, one task each, and only
    the two nearest targets per source row leave a task. A task compares ``SOURCES``
    sources with ``chunk`` targets at a time; a piece has ``PIECE_BYTES`` of
    descriptors, so a row is copied once per so many bytes of the other side.
    With ``unique`` a target hit by more than one source is dropped."""
    def tally(df, name):
        wide = F.max(F.size("desc")) * F.lit(8.0)
        return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) * F.greatest(wide, F.lit(8.0)) / PIECE_BYTES).alias(name))

    sizes = small(tally(a, "na").join(tally(b, "nb"), keys))
    left = _tiled(a, keys, "s", sizes.select(*keys, F.col("na").alias("pieces"), F.col("nb").alias("other")))
    right = _tiled(b, keys, "t", sizes.select(*keys, F.col("nb").alias("pieces"), F.col("na").alias("other")))

    def nearest(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if x.empty or y.empty:
            return pd.DataFrame({**{k: x[k].iloc[:0] for k in keys}, "a": x.fid.iloc[:0], "b": y.fid.iloc[:0], "d": []})
        # targets are in id order, so the first minimum has the smallest id
        y = y.sort_values("fid", kind="stable")
        p, q, i, j = np.stack(x.desc.tolist()), np.stack(y.desc.tolist()), x.fid.to_numpy(), y.fid.to_numpy()
        who, least = two_closest(p, q, chunk)
        source, slot = np.nonzero(who >= 0)
        group = {k: x[k].iat[0] for k in keys}
        return pd.DataFrame({"a": i[source], "b": j[who[source, slot]], "d": np.sqrt(least[source, slot])}).assign(**group)[[*keys, "a", "b", "d"]]

    key = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in a.select(*keys).schema)
    ids = [df.schema["fid"].dataType.simpleString() for df in (a, b)]
    tile = [*keys, "s", "t"]
    found = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(nearest, f"{key}, a {ids[0]}, b {ids[1]}, d double")
    # at most two candidates per source and target chunk
    best = found.groupBy(*keys, "a").agg(F.slice(F.sort_array(F.collect_list(F.struct("d", "b"))), 1, 2).alias("c"))
    kept = best.where((F.size("c") == 2) & (F.col("c")[0]["d"] < F.col("c")[1]["d"] * F.lit(ratio)))
    out = kept.select(*keys, "a", F.col("c")[0]["b"].alias("b"), F.col("c")[0]["d"].alias("d"),
                      (F.col("c")[0]["d"] / F.col("c")[1]["d"]).alias("ratio"))
    if unique:
        single = out.groupBy(*keys, "b").agg(F.count(F.lit(1)).alias("hits")).where("hits = 1").drop("hits")
        out = out.join(single, [*keys, "b"], "left_semi")
    return out
