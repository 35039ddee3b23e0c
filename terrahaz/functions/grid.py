"""Grid cells.

``grid_cell`` is a fixed-size cell for reports. The joins use a quad grid: level
``n`` splits 360 degrees into ``2**n`` columns, so cell sizes are exact binary
fractions, levels nest, and columns wrap at the antimeridian.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_cell(lon, lat, size: float) -> Column:
    """``struct<cx bigint, cy bigint>`` of the fixed-size cell holding the point."""
    cx = F.floor(_col(lon) / F.lit(float(size))).cast("bigint")
    cy = F.floor(_col(lat) / F.lit(float(size))).cast("bigint")
    return F.struct(cx.alias("cx"), cy.alias("cy"))


def cells_of_box(box, size: float) -> Column:
    """Fixed-size cells covering an envelope, as an array to explode."""
    box, step = _col(box), F.lit(float(size))

    def span(lo, hi):
        return F.sequence(F.floor(lo / step).cast("bigint"), F.floor(hi / step).cast("bigint"))

    columns = F.transform(
        span(box["min_x"], box["max_x"]),
        lambda cx: F.transform(
            span(box["min_y"], box["max_y"]),
            lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")),
        ),
    )
    return F.flatten(columns)


def quad_size(level: int) -> float:
    """Cell edge in degrees."""
    return 360.0 / (1 << level)


def size_of(level) -> Column:
    """Cell edge of a literal level or of a level column; powers of two are exact."""
    if isinstance(level, int):
        return F.lit(quad_size(level))
    return F.lit(360.0) / F.pow(F.lit(2.0), level.cast("double"))


def quad_row(lat: Column, level) -> Column:
    return F.floor((lat + F.lit(90.0)) / size_of(level)).cast("bigint")


def quad_column(lon: Column, level) -> Column:
    """Column number, not yet wrapped."""
    return F.floor((lon + F.lit(180.0)) / size_of(level)).cast("bigint")


def pack(column: Column, row: Column, level) -> Column:
    """One bigint per cell; columns wrap around the globe."""
    level = F.lit(level) if isinstance(level, int) else level
    count = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    return F.call_function("shiftleft", row, level).bitwiseOR(F.pmod(column, count))


def quad_cell(lon, lat, level) -> Column:
    lon, lat = _col(lon), _col(lat)
    return pack(quad_column(lon, level), quad_row(lat, level), level)


def quad_neighbourhood(lon, lat, level: int) -> Column:
    """The cell and its eight neighbours (fewer where they coincide)."""
    lon, lat = _col(lon), _col(lat)
    cx, cy = quad_column(lon, level), quad_row(lat, level)
    cells = [
        pack(cx + F.lit(dx).cast("bigint"), cy + F.lit(dy).cast("bigint"), level)
        for dx in (-1, 0, 1)
        for dy in (-1, 0, 1)
    ]
    return F.array_distinct(F.array(*cells))
