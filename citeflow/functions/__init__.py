"""Column -> Column helpers. All are Spark built-ins (codegen, no Python UDF)."""

from citeflow.functions.dates import date_part, month_of, weekday_of, year_of
from citeflow.functions.text import blank_to_null, canonicalize, decode_label
from citeflow.functions.times import clamp_hour, hour_of, meridiem_of

__all__ = [
    "blank_to_null", "canonicalize", "clamp_hour", "date_part", "decode_label",
    "hour_of", "meridiem_of", "month_of", "weekday_of", "year_of",
]
