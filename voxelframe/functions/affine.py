"""Affine transforms as ``ARRAY<DOUBLE>`` columns: 6 values (2-D) or 12 (3-D), row by row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _at(matrix: Column, n: int, row: int, col: int) -> Column:
    return matrix[row * (n + 1) + col]


def rank(length: int) -> int:
    return {6: 2, 12: 3}[length]


def apply_affine(matrix: Column, point: list[Column]) -> list[Column]:
    n = len(point)
    out = []
    for r in range(n):
        acc = _at(matrix, n, r, 0) * point[0]
        for c in range(1, n):
            acc = acc + _at(matrix, n, r, c) * point[c]
        out.append(acc + _at(matrix, n, r, n))
    return out


def concatenate(outer: Column, inner: Column, n: int = 2) -> Column:
    """The transform that applies ``inner`` first, then ``outer``."""
    cells = []
    for r in range(n):
        for c in range(n + 1):
            acc = _at(outer, n, r, 0) * _at(inner, n, 0, c)
            for k in range(1, n):
                acc = acc + _at(outer, n, r, k) * _at(inner, n, k, c)
            cells.append(acc + _at(outer, n, r, n) if c == n else acc)
    return F.array(*cells)


def invert2(m: Column) -> Column:
    a, b, tx, c, d, ty = [m[i] for i in range(6)]
    det = a * d - b * c
    return F.array(d / det, -b / det, (b * ty - d * tx) / det, -c / det, a / det, (c * tx - a * ty) / det)


def invert3(m: Column) -> Column:
    g = [[m[r * 4 + c] for c in range(4)] for r in range(3)]

    def minor(r, c):
        r0, r1 = [i for i in range(3) if i != r]
        c0, c1 = [i for i in range(3) if i != c]
        value = g[r0][c0] * g[r1][c1] - g[r0][c1] * g[r1][c0]
        return value if (r + c) % 2 == 0 else -value

    det = g[0][0] * minor(0, 0) + g[0][1] * minor(0, 1) + g[0][2] * minor(0, 2)
    cells = []
    for r in range(3):
        row = [minor(c, r) / det for c in range(3)]
        cells += row + [-(row[0] * g[0][3] + row[1] * g[1][3] + row[2] * g[2][3])]
    return F.array(*cells)


def scale_conjugate(matrix: Column, scale: float, n: int = 2) -> Column:
    """The same transform in coordinates divided by ``scale``: only the shift changes."""
    return F.transform(
        matrix, lambda m, i: F.when((i % (n + 1)) == n, m / F.lit(float(scale))).otherwise(m)
    )


def parse_affine(text: Column) -> Column:
    """"[[a,b,c],[d,e,f]]" -> column order (a, d, b, e, c, f); any other count fails."""
    parts = F.split(F.regexp_replace(text, r"[\[\]]", ""), ",")
    values = F.transform(parts, lambda p: F.trim(p).cast("double"))
    order = F.array(*[values[i] for i in (0, 3, 1, 4, 2, 5)])
    return F.when(
        F.size(parts) != 6, F.raise_error(F.lit("an affine model needs six values")).cast("array<double>")
    ).otherwise(order)


def from_json(text: Column) -> Column:
    return F.from_json(text, "array<double>")


def to_json(matrix: Column) -> Column:
    return F.to_json(matrix)


def swap_layout(matrix: Column) -> Column:
    """Row order (a, b, tx, c, d, ty) <-> column order (a, c, b, d, tx, ty)."""
    return F.array(*[matrix[i] for i in (0, 3, 1, 4, 2, 5)])


def swap_layout_back(matrix: Column) -> Column:
    return F.array(*[matrix[i] for i in (0, 2, 4, 1, 3, 5)])


def scale_array(values: Column, factor: float) -> Column:
    return F.transform(values, lambda v: v * F.lit(float(factor)))


def reorder(values: Column) -> Column:
    """Reverse the axis order of a vector."""
    return F.reverse(values)
