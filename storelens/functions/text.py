"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(col: Column) -> Column:
    """Upper-case every letter that follows a non-letter (also after quotes, digits, hyphens)."""
    pieces = F.split(F.lower(col), r"(?<=\P{L})")
    return F.array_join(F.transform(pieces, F.initcap), "")


def risk_band(probability: Column) -> Column:
    """Probability to High (0.7 and up), Medium (0.4 and up) or Low."""
    return F.when(probability >= 0.7, "High").when(probability >= 0.4, "Medium").otherwise("Low")
