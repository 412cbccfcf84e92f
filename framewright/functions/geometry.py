"""Geometry and small mathematics as Column expressions. A box is [x0, y0, x1, y1]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SAME = 0.9


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 without overlap or if the union isn't positive. Areas are signed."""
    x0, y0 = F.greatest(a[0], b[0]), F.greatest(a[1], b[1])
    x1, y1 = F.least(a[2], b[2]), F.least(a[3], b[3])
    inter = (x1 - x0) * (y1 - y0)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return F.when((x1 <= x0) | (y1 <= y0) | (union <= 0), 0.0).otherwise(F.try_divide(inter, union))


def area(b: Column) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def width(b: Column) -> Column:
    return F.abs(b[2] - b[0])


def height(b: Column) -> Column:
    return F.abs(b[3] - b[1])


def short_side(b: Column) -> Column:
    return F.least(width(b), height(b))


def rounded(x: Column, digits: int) -> Column:
    """``x`` rounded as the number that it is in binary, ties to even: 0.08625 is a little less
    than it looks and becomes 0.0862, where ROUND, by its decimal form, gives 0.0863. The
    error of the product with 10^digits is worked out exactly, from the halves of ``x``."""
    ten = float(10**digits)
    high = x * 134217729.0 - (x * 134217729.0 - x)  # the upper 26 bits
    p = x * ten
    error = (high * ten - p) + (x - high) * ten
    low = F.floor(p).cast("double")
    over = p - low - 0.5 + error
    up = F.when(over > 0, 1.0).when(over < 0, 0.0).otherwise(low % 2)
    return (low + up) / ten


def area_fraction(b: Column, w: Column, h: Column) -> Column:
    return rounded(F.try_divide(area(b), w * h), 4)


def scaled(b: Column, w: Column, h: Column, to_w: Column, to_h: Column) -> Column:
    """A box of an image of w x h on its picture of to_w x to_h."""
    sx, sy = F.try_divide(to_w.cast("double"), w), F.try_divide(to_h.cast("double"), h)
    return F.array(b[0] * sx, b[1] * sy, b[2] * sx, b[3] * sy)


def fitted(w: Column, h: Column, max_side: int) -> Column:
    """(w, h) of an image shrunk so that no side is over ``max_side``; at least one pixel."""
    share = F.lit(float(max_side)) / F.greatest(w, h)
    side = lambda x: F.greatest(F.lit(1), F.floor(x * share)).cast("int")
    fits = F.greatest(w, h) <= max_side
    return F.struct(F.when(fits, w).otherwise(side(w)).alias("w"), F.when(fits, h).otherwise(side(h)).alias("h"))


def crop(b: Column, w: Column, h: Column, pad: float) -> Column:
    """The box padded by a share of its sides, inside the image."""
    pw, ph = (b[2] - b[0]) * pad, (b[3] - b[1]) * pad
    zero = F.lit(0.0)
    return F.array(F.greatest(zero, b[0] - pw), F.greatest(zero, b[1] - ph), F.least(w.cast("double"), b[2] + pw), F.least(h.cast("double"), b[3] + ph))


def too_small(cropped: Column, side: int = 8) -> Column:
    """Less than ``side`` pixels wide or high, corners rounded to whole pixels."""
    return (F.rint(cropped[2]) - F.rint(cropped[0]) < side) | (F.rint(cropped[3]) - F.rint(cropped[1]) < side)


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson interval of k of n; (0, 1) for n = 0."""
    n = n.cast("double")
    p = F.try_divide(k.cast("double"), n)
    d = 1 + F.try_divide(F.lit(z * z), n)
    c = p + F.try_divide(F.lit(z * z), 2 * n)
    m = z * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z), 4 * n * n))
    return F.when(n == 0, 0.0).otherwise((c - m) / d), F.when(n == 0, 1.0).otherwise((c + m) / d)


def share(k: Column, n: Column) -> Column:
    """k / max(1, n)."""
    return k / F.greatest(F.lit(1), n)
