"""Labels and map attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sizes and colours of the map points.
FLAT_RADIUS = 25000.0
BASE_RADIUS, RADIUS_RANGE = 2000.0, 38000.0
FLAT_COLOUR = 120
BASE_COLOUR, COLOUR_RANGE, MAX_COLOUR = 50, 180, 230
COLOUR_GREEN, COLOUR_BLUE_TOP, COLOUR_RED_CAP, COLOUR_ALPHA = 60, 255, 200, 160
HIGHLIGHT_FACTOR, HIGHLIGHT_MIN, HIGHLIGHT_MAX = 1.4, 4000.0, 60000.0
NO_VALUE = "—"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_label(c: Column | str) -> Column:
    """``$1.25M`` style label; a dash for NULL."""
    value = _col(c).cast("double")
    size = F.abs(value)
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(NO_VALUE))
        .when(size >= 1e9, F.format_string("$%.2fB", value / 1e9))
        .when(size >= 1e6, F.format_string("$%.2fM", value / 1e6))
        .when(size >= 1e3, F.format_string("$%.2fK", value / 1e3))
        .otherwise(F.format_string("$%.0f", value))
    )


def point_radius(value: Column | str, largest: Column) -> Column:
    """Radius by share of the largest value; negatives count as zero."""
    value = F.greatest(F.coalesce(_col(value).cast("double"), F.lit(0.0)), F.lit(0.0))
    largest = F.coalesce(largest.cast("double"), F.lit(0.0))
    scaled = F.lit(BASE_RADIUS) + F.lit(RADIUS_RANGE) * (value / largest)
    return F.when(largest <= 0, F.lit(FLAT_RADIUS)).otherwise(scaled)


def point_colour_index(value: Column | str, largest: Column) -> Column:
    value = F.coalesce(_col(value).cast("double"), F.lit(0.0))
    largest = F.coalesce(largest.cast("double"), F.lit(0.0))
    scaled = F.lit(float(BASE_COLOUR)) + F.lit(float(COLOUR_RANGE)) * (value / largest)
    clipped = F.least(F.greatest(scaled, F.lit(float(BASE_COLOUR))), F.lit(float(MAX_COLOUR)))
    return F.when(largest <= 0, F.lit(FLAT_COLOUR)).otherwise(clipped.cast("int"))


def point_colour(index: Column | str) -> Column:
    """Red, green, blue and alpha of a colour index."""
    index = _col(index)
    blue = F.lit(COLOUR_BLUE_TOP) - F.least(index, F.lit(COLOUR_RED_CAP))
    return F.array(index, F.lit(COLOUR_GREEN), blue, F.lit(COLOUR_ALPHA))


def highlight_radius(radius: Column | str) -> Column:
    wider = _col(radius) * F.lit(HIGHLIGHT_FACTOR)
    return F.least(F.greatest(wider, F.lit(HIGHLIGHT_MIN)), F.lit(HIGHLIGHT_MAX))
