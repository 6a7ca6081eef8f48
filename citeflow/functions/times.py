"""Violation-time parts: ``hhmm`` + ``A``/``P``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeflow.constants import HOUR_FILL, HOUR_POSITION, HOUR_RANGE, MERIDIEM_POSITION


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def meridiem_of(c) -> Column:
    """Fifth character (``A``/``P``); '' when the text is shorter; null stays null."""
    return F.substring(_col(c), *MERIDIEM_POSITION)


def hour_of(c) -> Column:
    """First two characters as a double; null on bad text."""
    return F.substring(_col(c), *HOUR_POSITION).try_cast("double")


def clamp_hour(c, low: float = HOUR_RANGE[0], high: float = HOUR_RANGE[1],
               fill: float = HOUR_FILL) -> Column:
    """Hours outside ``(low, high]`` become ``fill``; null stays null."""
    h = _col(c)
    return F.when((h <= low) | (h > high), F.lit(fill)).otherwise(h)
