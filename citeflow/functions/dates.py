"""Issue-date parts and weekday.

The original job split the ``MM/dd/yyyy`` text and computed the weekday with a
row-at-a-time Python UDF (a ``BatchEvalPython`` barrier that raises on a null or
malformed date). Here everything is a built-in: ``get`` returns null for a missing
part, ``try_cast`` returns null on bad text (ANSI mode stays on), and
``try_to_date`` returns null for impossible dates such as 29 February of a
non-leap year; such rows then fall to the any-null drop.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeflow.constants import ISSUE_DATE_FORMAT, ISSUE_DATE_SEPARATOR


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_part(c, index: int, sep: str = ISSUE_DATE_SEPARATOR) -> Column:
    """0-based part of a separated date string; null when absent."""
    return F.get(F.split(_col(c), sep), F.lit(index))


def month_of(c) -> Column:
    """Month number (double) of a ``M/d/yyyy`` string; null on bad text."""
    return date_part(c, 0).try_cast("double")


def year_of(c) -> Column:
    """Year (int) of a ``M/d/yyyy`` string; null on bad text."""
    return date_part(c, 2).try_cast("int")


def weekday_of(c, fmt: str = ISSUE_DATE_FORMAT) -> Column:
    """Weekday, Monday = 0, of a date string; null when unparseable."""
    return F.weekday(F.try_to_date(_col(c), fmt))
