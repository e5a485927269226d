"""Planar geometry as column expressions. Lines are arrays of struct<x, y>; nulls in, nulls out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distance2(x1, y1, x2, y2) -> Column:
    """Squared distance; exact on integers."""
    dx, dy = x1 - x2, y1 - y2
    return dx * dx + dy * dy


def distance(x1, y1, x2, y2) -> Column:
    return F.sqrt(distance2(x1, y1, x2, y2).cast("double"))


def direction(x1, y1, x2, y2) -> Column:
    """Degrees from the first point to the second, 0 to 360; null where they are equal."""
    angle = F.pmod(F.degrees(F.atan2((y2 - y1).cast("double"), (x2 - x1).cast("double"))), F.lit(360.0))
    return F.when((x1 != x2) | (y1 != y2), angle)


def reverse(angle: Column) -> Column:
    return F.pmod(angle + 180, F.lit(360.0))


def azimuth(x1, y1, x2, y2) -> Column:
    """Undirected, 0 to 180."""
    return F.pmod(direction(x1, y1, x2, y2), F.lit(180.0))


def orientation_difference(a: Column, b: Column) -> Column:
    """Of undirected angles, 0 to 90."""
    d = F.pmod(F.abs(a - b), F.lit(180.0))
    return F.least(d, 180 - d)


def direction_difference(a: Column, b: Column) -> Column:
    """Of directed angles, 0 to 180."""
    d = F.pmod(F.abs(a - b), F.lit(360.0))
    return F.least(d, 360 - d)


def line_distance(px, py, x1, y1, x2, y2) -> Column:
    """From a point to the infinite line through two points; to the point where they are one."""
    length = distance(x1, y1, x2, y2)
    cross = F.abs((x2 - x1) * (y1 - py) - (x1 - px) * (y2 - y1)).cast("double")
    return F.when(length == 0, distance(px, py, x1, y1)).otherwise(cross / length)


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    """From a point to a segment."""
    l2 = distance2(x1, y1, x2, y2).cast("double")
    t = F.when(l2 == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / l2)))
    return distance(px, py, x1 + t * (x2 - x1), y1 + t * (y2 - y1))


def vertex_angle(ax, ay, bx, by, cx, cy) -> Column:
    """Degrees at b between a and c; 360 where a side has no length."""
    dot = ((ax - bx) * (cx - bx) + (ay - by) * (cy - by)).cast("double")
    n = distance(ax, ay, bx, by) * distance(cx, cy, bx, by)
    return F.when(n == 0, F.lit(360.0)).otherwise(F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot / n)))))


def crosses(ax, ay, bx, by, cx, cy, dx, dy) -> Column:
    """Whether segments a-b and c-d cross inside both."""

    def side(px, py, qx, qy, rx, ry):
        return F.signum(((qx - px) * (ry - py) - (qy - py) * (rx - px)).cast("double"))

    return (side(ax, ay, bx, by, cx, cy) * side(ax, ay, bx, by, dx, dy) < 0) & (side(cx, cy, dx, dy, ax, ay) * side(cx, cy, dx, dy, bx, by) < 0)


def snap(x: Column, step: int) -> Column:
    """Nearest multiple of step; halves go up."""
    return (F.floor(x / step + 0.5) * step).cast("bigint")


def line_length(line: Column) -> Column:
    """Of an array of struct<x, y>."""
    ends = F.zip_with(F.slice(line, 1, F.size(line) - 1), F.slice(line, 2, F.size(line) - 1), lambda a, b: F.hypot((a["x"] - b["x"]).cast("double"), (a["y"] - b["y"]).cast("double")))
    return F.when(F.size(line) < 2, F.lit(0.0)).otherwise(F.aggregate(ends, F.lit(0.0), lambda s, x: s + x))


def reverse_line(line: Column) -> Column:
    return F.reverse(line)


def merge_lines(a: Column, b: Column) -> Column:
    """b after a, the shared vertex once."""
    return F.concat(a, F.when(F.element_at(a, -1) == F.element_at(b, 1), F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0)))).otherwise(b))


def replace_end(line: Column, point: Column) -> Column:
    return F.concat(F.slice(line, 1, F.size(line) - 1), F.array(point))


def extend_end(line: Column, point: Column) -> Column:
    return F.concat(line, F.array(point))


def trim(x1, y1, x2, y2, t: float) -> Column:
    """The segment without t at both ends; null where nothing is left."""
    n = distance(x1, y1, x2, y2)
    ux, uy = (x2 - x1) / n, (y2 - y1) / n
    return F.when(n > 2 * t, F.struct((x1 + ux * t).alias("x1"), (y1 + uy * t).alias("y1"), (x2 - ux * t).alias("x2"), (y2 - uy * t).alias("y2")))


def even_positions(length: Column, interval: float) -> Column:
    """Array of (start, end) of ceil(length / interval) equal parts; the whole where it is no longer than one."""
    n = F.when(length <= interval, F.lit(1)).otherwise(F.ceil(length / interval)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((length * i / n).alias("a"), (length * (i + 1) / n).alias("b")))


def fixed_positions(length: Column, interval: float, tail: float) -> Column:
    """Full parts, then the rest; a rest up to tail lengthens the last part."""
    q = F.floor(length / interval).cast("int")
    rest = length - q * interval
    n = F.when(length <= interval, F.lit(1)).when((rest > 0) & (rest > tail), q + 1).otherwise(q)
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((i * F.lit(interval)).alias("a"), F.when(i == n - 1, length).otherwise((i + 1) * F.lit(interval)).alias("b")))
