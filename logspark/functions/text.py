"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zero_padded(number: Column, width: int = 9) -> Column:
    """Digits filled with zeros to ``width``; longer numbers stay whole."""
    digits = number.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))
