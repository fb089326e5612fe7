"""Fuel text to fuel category."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridplume.schemas import FUEL_LABELS, OTHER_FUEL


def fuel_category(fuel: Column) -> Column:
    """The first label the text contains, whatever its case; missing text is 'Other'."""
    text = F.lower(fuel)
    labelled = reduce(lambda cases, label: cases.when(text.contains(label.lower()), label), FUEL_LABELS, F)
    return labelled.otherwise(OTHER_FUEL)
