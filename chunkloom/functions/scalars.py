"""Scalar expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def packed_id(token: Column, local: Column, bits: int) -> Column:
    """token << bits | local; a local id that needs more bits is an error."""
    fits = F.when(F.shiftright(local.cast("long"), bits) == 0, local.cast("long"))
    return F.shiftleft(token.cast("long"), bits).bitwiseOR(F.coalesce(fits, F.raise_error(F.lit(f"a local id needs more than {bits} bits")).cast("long")))


def unpacked_id(packed: Column, bits: int) -> tuple[Column, Column]:
    """(token, local)."""
    return F.shiftright(packed, bits), packed.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def smoothstep(t: Column) -> Column:
    """t * t * (3 - 2 t) of t clipped to [0, 1]."""
    c = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return c * c * (3 - 2 * c)


def page_place(page: Column, channels: int, depth: int) -> tuple[Column, Column, Column]:
    """(t, z, c) of a page of interleaved channels."""
    return F.floor(page / (channels * depth)), F.floor(page / channels) % depth, page % channels


def signed_bounds(start: Column, extent: Column, scale: Column) -> tuple[Column, Column]:
    """Least and most physical position of an axis whose scale may be negative."""
    far = start + (extent - 1) * scale
    return F.least(start, far), F.greatest(start, far)


def nearest_bin(value: Column, edges: list[float]) -> Column:
    """The bin whose centre is nearest, the lower one at a midpoint; centres are in ascending order."""
    middles = [(a + b) / 2 for a, b in zip(edges, edges[1:])]
    return sum((F.when(value > m, 1).otherwise(0) for m in middles), F.lit(0)).cast("int")


def stretched(value: Column, low: Column, high: Column) -> Column:
    """0 to 255 over [low, high], clipped and truncated; an empty range counts as one wide."""
    return F.floor(F.least(F.greatest((value - low) * 255 / F.greatest(high - low, F.lit(1)), F.lit(0.0)), F.lit(255.0))).cast("int")


def human_bytes(n: Column) -> Column:
    """Bytes with a binary unit and one decimal, halves rounded to even."""
    units = ("B", "KiB", "MiB", "GiB", "TiB")
    shown = lambda k: F.format_string(f"%.1f {units[k]}", F.bround(n / float(1 << (10 * k)), 1))
    out = shown(4)
    for k in range(3, 0, -1):
        out = F.when(n < 1 << (10 * (k + 1)), shown(k)).otherwise(out)
    return F.when(n < 1024, F.format_string("%d B", n)).otherwise(out)


#: Microns of a unit of length.
MICRONS = {"nm": 0.001, "um": 1.0, "mm": 1000.0, "m": 1_000_000.0}


def microns(value: Column, unit: Column) -> Column:
    """A length in microns; an unknown unit is an error."""
    factor = F.create_map(*[F.lit(x) for pair in MICRONS.items() for x in pair])[unit]
    return value * F.coalesce(factor, F.raise_error(F.concat(F.lit("unknown unit of length: "), unit)).cast("double"))


def to_world(i: Column, j: Column, origin: tuple[float, float], spacing: float, direction: tuple[float, float]) -> tuple[Column, Column]:
    """Physical position of an index: origin + direction * spacing * index, direction (cos, sin) of the first axis."""
    c, s = direction
    return origin[0] + c * (i * spacing) - s * (j * spacing), origin[1] + s * (i * spacing) + c * (j * spacing)


def to_index(x: Column, y: Column, origin: tuple[float, float], spacing: float, direction: tuple[float, float]) -> tuple[Column, Column]:
    """The inverse of to_world."""
    c, s = direction
    dx, dy = x - origin[0], y - origin[1]
    return (c * dx + s * dy) / spacing, (c * dy - s * dx) / spacing


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def clipped(polygon: Column, axis: str, bound: Column, above: bool) -> Column:
    """The part of a polygon, an array of (x, y) in order, at or above a bound of an axis, or below it."""
    other = "y" if axis == "x" else "x"
    inside = lambda p: p[axis] >= bound if above else p[axis] < bound

    def cross(p: Column, q: Column) -> Column:
        at = p[other] + (bound - p[axis]) / (q[axis] - p[axis]) * (q[other] - p[other])
        place = {axis: bound.cast("double"), other: at}
        return F.struct(place["x"].alias("x"), place["y"].alias("y"))

    none = F.array().cast("array<struct<x:double,y:double>>")

    def part(points: Column) -> Column:
        before = lambda i: F.when(i == 0, F.element_at(points, -1)).otherwise(F.get(points, i - 1))
        return F.flatten(
            F.transform(
                points,
                lambda p, i: _let(before(i), lambda q: F.concat(F.when(inside(p) != inside(q), F.array(cross(q, p))).otherwise(none), F.when(inside(p), F.array(F.struct(p["x"].alias("x"), p["y"].alias("y")))).otherwise(none))),
            )
        )

    return _let(polygon, lambda points: F.when(F.size(points) > 0, part(points)).otherwise(none))


def clipped_area(polygon: Column, low_x: Column, high_x: Column, low_y: Column, high_y: Column) -> Column:
    """The area of a polygon, an array of (x, y) doubles in order, within a rectangle; convex polygons only, as parts of others would be joined."""
    for axis, bound, above in (("x", low_x, True), ("x", high_x, False), ("y", low_y, True), ("y", high_y, False)):
        polygon = clipped(polygon, axis, bound, above)

    def area(points: Column) -> Column:
        turns = F.transform(points, lambda p, i: _let(F.get(points, (i + 1) % F.size(points)), lambda q: p["x"] * q["y"] - q["x"] * p["y"]))
        return F.abs(F.aggregate(turns, F.lit(0.0), lambda s, t: s + t)) / 2

    return _let(polygon, lambda points: F.when(F.size(points) > 0, area(points)).otherwise(0.0))
