"""Named value bands."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Bands(NamedTuple):
    """``below``: label under the first edge (exclusive). ``upto``: label and upper edge
    (inclusive) of each following band. ``above``: everything beyond, NaN included."""

    below: tuple[str, float]
    upto: tuple[tuple[str, float], ...]
    above: str


# Degrees Fahrenheit and miles.
TEMPERATURE = Bands(("Freezing", 32), (("Cold", 50), ("Moderate", 70), ("Warm", 85)), "Hot")
VISIBILITY = Bands(("Poor", 1), (("Moderate", 5),), "Good")


def band(value: Column, bands: Bands, null_label: str | None = None) -> Column:
    """The first band that holds ``value``; NULL stays NULL unless it gets a label."""
    label, edge = bands.below
    out = F.when(value.isNull(), F.lit(null_label).cast("string")).when(value < edge, label)
    for label, edge in bands.upto:
        out = out.when(value <= edge, label)
    return out.otherwise(bands.above)
