"""Queries over neighbourhood operators."""

from pyspark.sql import functions as F

from catalog.registry import query
from voxelframe.operators import joins, pixel, stencils

VOX = "dataset:s z y x v:f"


def gauss_sql(source: str, axis: str, n: str, sigma: float, value: str = "v") -> str:
    k = stencils.half_kernel(sigma)
    taps = ", ".join(f"({o}, {k[abs(o)]!r}::DOUBLE)" for o in range(-len(k) + 1, len(k)))
    period = f"(2 * ({n} - 1))"
    t = f"((((a.{axis} + t.o) % {period}) + {period}) % {period})"
    src = f"CASE WHEN {t} < {n} THEN {t} ELSE {period} - {t} END"
    same = " AND ".join(f"b.{c} = a.{c}" for c in ("dataset", "z", "y", "x") if c != axis)
    return (f"SELECT a.dataset, a.z, a.y, a.x, sum(t.w * b.{value}) AS {value} FROM {source} a, (VALUES {taps}) AS t(o, w), {source} b "
            f"WHERE {same} AND b.{axis} = {src} GROUP BY a.dataset, a.z, a.y, a.x")


@query("w1_gauss", VOX, f"WITH g1 AS ({gauss_sql('@em', 'x', '25', 1.5)}), g2 AS ({gauss_sql('g1', 'y', '20', 1.0)}) SELECT * FROM g2")
def _(f):
    return stencils.gauss(f.em, {"x": 1.5, "y": 1.0, "z": 0.0})


WEIGHTED = "SELECT e.dataset, e.z, e.y, e.x, e.v, CASE WHEN m.v = 0 OR e.x > 15 THEN 0 ELSE 1 END AS w FROM @em e JOIN @mask m USING (dataset, z, y, x)"


@query("w2_weighted_gauss", VOX, f"""WITH e AS ({WEIGHTED}), s0 AS (SELECT dataset, z, y, x, (v * w)::DOUBLE AS s, w::DOUBLE AS g FROM e),
s1 AS ({gauss_sql('s0', 'x', '25', 1.0, 's')}), g1 AS ({gauss_sql('s0', 'x', '25', 1.0, 'g')}),
s2 AS ({gauss_sql('s1', 'y', '20', 1.0, 's')}), g2 AS ({gauss_sql('g1', 'y', '20', 1.0, 'g')})
SELECT dataset, z, y, x, CASE WHEN g <> 0 THEN s / g ELSE v END AS v FROM e JOIN s2 USING (dataset, z, y, x) JOIN g2 USING (dataset, z, y, x)""")
def _(f):
    return stencils.weighted_gauss(f.sql(WEIGHTED), {"x": 1.0, "y": 1.0})


BOXES = """WITH r AS (SELECT dataset, z, y, x, v, count(v) OVER w AS n, sum(v) OVER w AS s1, sum(v * v) OVER w AS s2 FROM @em
WINDOW w AS (PARTITION BY dataset, z, y ORDER BY x RANGE BETWEEN 4 PRECEDING AND 4 FOLLOWING)),
b AS (SELECT dataset, z, y, x, v, sum(n) OVER w AS n, sum(s1) OVER w AS s1, sum(s2) OVER w AS s2 FROM r
WINDOW w AS (PARTITION BY dataset, z, x ORDER BY y RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
c AS (SELECT dataset, z, y, x, v, s1::DOUBLE / n::DOUBLE AS mean, 3 * sqrt(greatest(n::DOUBLE * s2::DOUBLE - s1::DOUBLE * s1::DOUBLE, 0) / (n::DOUBLE * (n::DOUBLE - 1))) AS d FROM b) """


@query("w3_local_contrast", VOX, BOXES + "SELECT dataset, z, y, x, CASE WHEN d = 0 THEN 0 ELSE (v - (mean - d)) / 2 / d * 255 END AS v FROM c")
def _(f):
    return stencils.local_contrast(f.em, 4, 3)


@query("w3_local_contrast_center", VOX, BOXES + "SELECT dataset, z, y, x, v - mean + 127.5 AS v FROM c")
def _(f):
    return stencils.local_contrast(f.em, 4, 3, stretch=False)


@query("w3_local_contrast_soft", VOX, BOXES + """, g AS (SELECT *, CASE WHEN d = 0 THEN NULL WHEN 255 / d < 2 THEN 255 / d ELSE
pow(255 / d + pow(0.5::DOUBLE, 2.0::DOUBLE) - 2, 0.5::DOUBLE) + 2 - pow(pow(0.5::DOUBLE, 2.0::DOUBLE), 0.5::DOUBLE) END * 0.5 AS s FROM c)
SELECT dataset, z, y, x, CASE WHEN v = 0 OR v = 255 THEN v ELSE coalesce((v - mean) * s + 127.5, 0) END AS v FROM g""")
def _(f):
    return stencils.local_contrast(f.em, 4, 3, limit=2.0, gamma=0.5, keep_min_max=True)


@query("w3_local_contrast_stretch", VOX, BOXES + "SELECT dataset, z, y, x, CASE WHEN d = 0 THEN 0 ELSE (v - 127.5) / 2 / d * 255 + 127.5 END AS v FROM c")
def _(f):
    return stencils.local_contrast(f.em, 4, 3, center=False)


@query("w4_classic_contrast", VOX, BOXES + "SELECT dataset, z, y, x, CASE WHEN d = 0 THEN 0 ELSE greatest(0, least(255, (v - (mean - d)) / 2 / d * 255)) END AS v FROM c")
def _(f):
    return stencils.classic_contrast(f.em, 4, 3)


def clahe_sql(masked: bool) -> str:
    seen = "WHERE m = 1" if masked else ""
    keep = "CASE WHEN m = 0 THEN v ELSE" if masked else "CASE WHEN false THEN v ELSE"
    return f"""WITH d AS (SELECT e.*, m.v AS m, y // 10 AS gy, x // 10 AS gx FROM @em e JOIN @mask m USING (dataset, z, y, x)),
h AS (SELECT dataset, z, gy, gx, v AS bin, count(*) AS n FROM d {seen} GROUP BY ALL),
tot AS (SELECT dataset, z, gy, gx, sum(n) AS total, CAST(floor(sum(n) * 4.0::DOUBLE / 256 + 0.5) AS BIGINT) AS cap FROM h GROUP BY ALL),
f AS (SELECT t.*, b.bin, least(coalesce(h.n, 0), t.cap) AS cut FROM tot t CROSS JOIN (SELECT unnest(range(0, 256)) AS bin) b
 LEFT JOIN h ON h.dataset = t.dataset AND h.z = t.z AND h.gy = t.gy AND h.gx = t.gx AND h.bin = b.bin),
x1 AS (SELECT *, total - sum(cut) OVER (PARTITION BY dataset, z, gy, gx) AS excess FROM f),
cdf AS (SELECT *, sum(cut * 256 + excess) OVER (PARTITION BY dataset, z, gy, gx ORDER BY bin) AS c FROM x1),
lim AS (SELECT dataset, z, gy, gx, min(c) FILTER (WHERE c > 0) AS lo, max(c) AS hi FROM cdf GROUP BY ALL),
tab AS (SELECT dataset, z, gy, gx, bin, CASE WHEN hi = lo THEN bin ELSE greatest(0, (c - lo)::DOUBLE / (hi - lo)::DOUBLE) * 255 END AS t FROM cdf JOIN lim USING (dataset, z, gy, gx)),
mx AS (SELECT dataset, z, max(gy) AS my, max(gx) AS mx FROM tot GROUP BY ALL),
p AS (SELECT d.dataset, d.z, y, x, v, m, my, mx, floor((y + 0.5::DOUBLE) / 10 - 0.5) AS qy, floor((x + 0.5::DOUBLE) / 10 - 0.5) AS qx FROM d JOIN mx USING (dataset, z)),
w AS (SELECT *, (y + 0.5::DOUBLE) / 10 - 0.5 - qy AS fy, (x + 0.5::DOUBLE) / 10 - 0.5 - qx AS fx FROM p),
k AS (SELECT w.dataset, w.z, w.y, w.x, w.v, w.m, sum((CASE WHEN cy = 1 THEN fy ELSE 1 - fy END) * (CASE WHEN cx = 1 THEN fx ELSE 1 - fx END) * tab.t) AS s
 FROM w, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS q(cy, cx), tab
 WHERE tab.dataset = w.dataset AND tab.z = w.z AND tab.bin = w.v AND tab.gy = greatest(0, least(my, qy + cy)) AND tab.gx = greatest(0, least(mx, qx + cx)) GROUP BY ALL)
SELECT dataset, z, y, x, {keep} greatest(0, least(255, floor(s + 0.5))) END AS v FROM k"""


@query("w5_clahe", "dataset:s z y x v", clahe_sql(False))
def _(f):
    return stencils.clahe(f.em, 10, slope=4.0)


@query("w5_clahe_masked", "dataset:s z y x v", clahe_sql(True))
def _(f):
    return stencils.clahe(f.em, 10, slope=4.0, mask=f.mask)


@query("w6_drop_empty_blocks", "dataset:s z y x v", """SELECT dataset, z, y, x, v FROM (SELECT *, max(v) OVER (PARTITION BY dataset, z // 2, y // 2, x // 2) AS m FROM @em) WHERE m <> 0""")
def _(f):
    from voxelframe.operators import blocks
    return blocks.drop_empty_blocks(f.em, {"z": 2, "y": 2, "x": 2})


@query("w7_median_z3", "dataset:s z y x v", """SELECT dataset, z, y, x, list_sort([coalesce(lag(v) OVER w, 90), v, coalesce(lead(v) OVER w, 90)])[2] AS v
FROM @em WINDOW w AS (PARTITION BY dataset, y, x ORDER BY z)""")
def _(f):
    return stencils.median_z3(f.em, 90)


@query("w8_gradient_forward", "dataset:s z y x v", "SELECT dataset, z, y, x, coalesce(lead(v) OVER (PARTITION BY dataset, z, y ORDER BY x), v) - v AS v FROM @em")
def _(f):
    return stencils.gradient_forward(f.em, "x")


@query("w9_gradient_center", VOX, """SELECT dataset, z, y, x, (coalesce(lead(v) OVER w, v) - coalesce(lag(v) OVER w, v)) * 2 / 1.5::DOUBLE AS v FROM @em
WINDOW w AS (PARTITION BY dataset, z, x ORDER BY y)""")
def _(f):
    return stencils.gradient_center(f.em, "y", 1.5)


@query("w10_gradient_magnitude", VOX, """SELECT dataset, z, y, x, sqrt(((coalesce(lead(v) OVER wx, v) - coalesce(lag(v) OVER wx, v)) / 2.0::DOUBLE) ** 2 +
((coalesce(lead(v) OVER wy, v) - coalesce(lag(v) OVER wy, v)) / 2.0::DOUBLE) ** 2 + ((coalesce(lead(v) OVER wz, v) - coalesce(lag(v) OVER wz, v)) / 2.0::DOUBLE) ** 2) AS v FROM @em
WINDOW wx AS (PARTITION BY dataset, z, y ORDER BY x), wy AS (PARTITION BY dataset, z, x ORDER BY y), wz AS (PARTITION BY dataset, y, x ORDER BY z)""")
def _(f):
    return stencils.gradient_magnitude(f.em)


def central(axis: str, value: str) -> str:
    rest = ", ".join(["dataset", *[a for a in "zyx" if a != axis]])
    over = f"OVER (PARTITION BY {rest} ORDER BY {axis})"
    return f"(coalesce(lead({value}) {over}, {value}) - coalesce(lag({value}) {over}, {value}))"


SIGMA = {"x": 1.0, "y": 1.0, "z": 2.0}


@query("w11_tubeness", VOX, f"""WITH g AS (SELECT *, {', '.join(f"{central(a, 'v')} * {2 / SIGMA[a]}::DOUBLE AS g{a}" for a in 'xyz')} FROM @em),
h AS (SELECT *, {', '.join(f"{central(d, 'g' + e)} * {SIGMA[e] / 2}::DOUBLE AS h{d}{e}" for d, e in ('xx', 'xy', 'xz', 'yy', 'yz', 'zz'))} FROM g),
q AS (SELECT *, (hxx + hyy + hzz) / 3 AS q FROM h),
p AS (SELECT *, sqrt(((hxx - q) ** 2 + (hyy - q) ** 2 + (hzz - q) ** 2 + 2 * (hxy ** 2 + hxz ** 2 + hyz ** 2)) / 6) AS p,
 (hxx - q) * ((hyy - q) * (hzz - q) - hyz * hyz) - hxy * (hxy * (hzz - q) - hyz * hxz) + hxz * (hxy * hyz - (hyy - q) * hxz) AS det FROM q),
t AS (SELECT *, acos(greatest(-1, least(1, CASE WHEN p = 0 THEN 1 ELSE det / (2 * p * p * p) END))) / 3 AS t FROM p),
e AS (SELECT dataset, z, y, x, q + 2 * p * cos(t) AS e1, q + 2 * p * cos(t + 2 * pi() / 3) AS e3, q FROM t),
s AS (SELECT *, list_sort([{{'m': abs(e1), 'x': e1}}, {{'m': abs(3 * q - e1 - e3), 'x': 3 * q - e1 - e3}}, {{'m': abs(e3), 'x': e3}}]) AS l FROM e)
SELECT dataset, z, y, x, CASE WHEN (l[3].x < 0 AND l[2].x < 0) OR (l[3].x > 0 AND l[2].x > 0) THEN sqrt(greatest(l[3].m * (l[2].m - l[1].m), 0)) / -l[3].x ELSE 0 END AS v FROM s""")
def _(f):
    return stencils.tubeness(f.em, {"x": 1.0, "y": 1.0, "z": 2.0})


@query("w12_black_neighbour", "dataset:s z y x black:b", """SELECT dataset, z, y, x, coalesce(lag(v) OVER wx, 0) = 0 OR coalesce(lead(v) OVER wx, 0) = 0 OR
coalesce(lag(v) OVER wy, 0) = 0 OR coalesce(lead(v) OVER wy, 0) = 0 AS black FROM @em
WINDOW wx AS (PARTITION BY dataset, z, y ORDER BY x), wy AS (PARTITION BY dataset, z, x ORDER BY y)""")
def _(f):
    return stencils.black_neighbour(f.em)


@query("w13_column_range", "dataset:s z x first last", """SELECT dataset, z, x, min(y) FILTER (WHERE v <> 0) AS first, max(y) FILTER (WHERE v <> 0) AS last
FROM @em GROUP BY dataset, z, x HAVING max(y) FILTER (WHERE v <> 0) > min(y) FILTER (WHERE v <> 0)""")
def _(f):
    return stencils.prefilter_columns(f.em)


@query("w13_prefilter", "dataset:s z y x v:f first last")
def _(f):
    return stencils.prefilter(f.em, pixel.extents(f.em), radius=3)


@query("w14_cumulative_sum", "dataset:s z y x v", "SELECT dataset, z, y, x, sum(v) OVER (PARTITION BY dataset, z, x ORDER BY y ROWS UNBOUNDED PRECEDING) AS v FROM @em")
def _(f):
    return stencils.cumulative_sum(f.em, "y")


SLABS = """SELECT o_orderkey AS ord, concat('slab', CAST(o_orderkey AS STRING)) AS dataset, CAST(2 AS BIGINT) AS top, 20 + o_custkey % 5 AS bot FROM @orders"""


@query("w15_slab_offsets", "ord zoff depth", f"""SELECT ord, bot - top + 1 AS depth, coalesce(sum(bot - top + 1) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS zoff FROM ({SLABS})""")
def _(f):
    return joins.slab_offsets(f.sql(SLABS))


MASKED = "SELECT e.dataset, e.z, e.y, e.x, CASE WHEN m.v = 0 THEN NULL ELSE e.v END AS v FROM @em e JOIN @mask m USING (dataset, z, y, x)"


@query("w16_inpaint", VOX, f"""WITH h AS ({MASKED}), n AS (SELECT a.dataset, a.z, a.y, a.x, sum(b.v * w) / sum(CASE WHEN b.v IS NULL THEN 0 ELSE w END) AS v FROM h a,
(VALUES (-1, -1, 0.5::DOUBLE), (-1, 0, 1.0), (-1, 1, 0.5), (0, -1, 1.0), (0, 1, 1.0), (1, -1, 0.5), (1, 0, 1.0), (1, 1, 0.5)) AS o(dy, dx, w), h b
WHERE a.v IS NULL AND b.dataset = a.dataset AND b.z = a.z AND b.y = a.y + dy AND b.x = a.x + dx GROUP BY ALL)
SELECT dataset, z, y, x, v::DOUBLE AS v FROM h WHERE v IS NOT NULL UNION ALL SELECT * FROM n""")
def _(f):
    return stencils.inpaint(f.sql(MASKED))


@query("w17_inpaint_rays", VOX)
def _(f):
    return stencils.inpaint_rays(f.sql(MASKED), pixel.extents(f.em))


def _side(axis: str) -> str:
    others = ", ".join(["dataset", *[a for a in "zyx" if a != axis]])
    back = f"OVER (PARTITION BY {others} ORDER BY {axis} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ahead = f"OVER (PARTITION BY {others} ORDER BY {axis} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN v IS NOT NULL THEN {axis} END"
    return (f"last_value(v IGNORE NULLS) {back} AS bv{axis}, {axis} - last_value({at} IGNORE NULLS) {back} AS bd{axis}, "
            f"first_value(v IGNORE NULLS) {ahead} AS fv{axis}, first_value({at} IGNORE NULLS) {ahead} - {axis} AS fd{axis}")


_parts = [f"{s}{{}}{a}" for a in "zyx" for s in "bf"]


@query("w18_inpaint_axes", VOX, f"""WITH h AS ({MASKED}), s AS (SELECT *, {', '.join(_side(a) for a in 'zyx')} FROM h)
SELECT dataset, z, y, x, coalesce(v::DOUBLE, ({' + '.join(f"coalesce({p.format('v')} * (1.0::DOUBLE / {p.format('d')}), 0)" for p in _parts)}) /
({' + '.join(f"coalesce(1.0::DOUBLE / {p.format('d')}, 0)" for p in _parts)})) AS v FROM s""")
def _(f):
    return stencils.inpaint_axes(f.sql(MASKED))
