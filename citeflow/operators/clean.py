"""The citation cleaning plan as a chain of lazy stages.

Every stage is a narrow transformation (projection or filter): the whole clean
runs in the scan's stage with no shuffle, filters are merged and pushed down by
Catalyst, and no Python UDF breaks whole-stage codegen. Intermediate stages are
exposed because the profiling reports bind to them.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeflow import constants as K
from citeflow.functions import (canonicalize, clamp_hour, hour_of, meridiem_of, month_of,
                                weekday_of, year_of)
from citeflow.functions.text import blank_to_null
from citeflow.operators.columns import blank_to_null_all, drop_columns, standardize_names
from citeflow.operators.filters import drop_sentinels, dropna_any, dropna_subset, year_range
from citeflow.session import keep_methods_compiled


_INT_COLUMNS = set(K.std(K.RAW_INTEGER_COLUMNS))
# Schema of the cleaned table (for reading it back from text formats).
CLEANED_SCHEMA = ", ".join(
    f"{c} {'double' if c in K.NUMERIC else 'int' if c in _INT_COLUMNS else 'string'}"
    for c in K.CLEANED_COLUMNS)


@dataclass(frozen=True)
class CleanOptions:
    """Defaults reproduce the batch cleaning job.

    ``sentinels={}`` and ``canonicalize_first=True`` reproduce the packaged job,
    which omits the state and plate filters. ``hour_mode='drop'`` removes
    out-of-range hours instead of replacing them.
    """
    year_range: tuple[int, int] = K.YEAR_RANGE
    sentinels: dict = field(default_factory=lambda: dict(K.SENTINEL_VALUES))
    county_rules: tuple = tuple(K.COUNTY_RULES)
    anchored_rules: bool = False
    hour_mode: str = "fill"
    drop: tuple = tuple(K.DROP_COLUMNS)
    keep: tuple = ()            # extra columns to carry through (e.g. a row id)
    canonicalize_first: bool = False


def add_time_features(df: DataFrame, issue_date: str = "issue_date",
                      violation_time: str = "violation_time") -> DataFrame:
    """Month, Year, Day (weekday, Monday = 0), Meridiem and Time_Hour."""
    return df.withColumns({
        "month": month_of(issue_date),
        "year": year_of(issue_date),
        "day": weekday_of(issue_date).cast("double"),
        "meridiem": meridiem_of(violation_time),
        "time_hour": hour_of(violation_time),
    })


def fix_hour(df: DataFrame, mode: str = "fill") -> DataFrame:
    if mode == "drop":
        h = F.col("time_hour")
        return df.where(h.isNull() | ((h > K.HOUR_RANGE[0]) & (h <= K.HOUR_RANGE[1])))
    return df.withColumn("time_hour", clamp_hour("time_hour"))


def canonicalize_target(df: DataFrame, opts: CleanOptions) -> DataFrame:
    t = K.TARGET
    out = df.withColumn(t, canonicalize(t, opts.county_rules, opts.anchored_rules))
    out = dropna_subset(out, [t])
    sentinel = opts.sentinels.get(t)
    return out.where(F.col(t) != F.lit(sentinel)) if sentinel is not None else out


def cleaning_stages(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> "OrderedDict[str, DataFrame]":
    """Named intermediate stages, in the order of the original job."""
    st: OrderedDict[str, DataFrame] = OrderedDict()
    # filters repeat the derived columns' expressions: as one method they are past what the JVM compiles
    keep_methods_compiled(raw.sparkSession)
    df = standardize_names(raw)
    st["raw"] = df
    if opts.canonicalize_first:
        df = canonicalize_target(df, opts)
    df = add_time_features(df)
    st["featured"] = df
    df = year_range(df, "year", *opts.year_range)
    st["year_filtered"] = df
    df = df.withColumn("meridiem", blank_to_null("meridiem"))
    st["meridiem_nulled"] = df
    df = fix_hour(df, opts.hour_mode)
    st["hour_fixed"] = df
    state = {k: v for k, v in opts.sentinels.items() if k == "registration_state"}
    df = drop_sentinels(df, state)
    st["state_filtered"] = df
    plate = {k: v for k, v in opts.sentinels.items() if k == "plate_type"}
    df = drop_sentinels(df, plate)
    st["plate_filtered"] = df
    if not opts.canonicalize_first:
        df = canonicalize_target(df, opts)
    st["target_clean"] = df
    df = blank_to_null_all(df)
    st["blanks_nulled"] = df
    keep = set(opts.keep)
    df = drop_columns(df, [c for c in opts.drop if c not in keep])
    st["dropped"] = df
    df = dropna_any(df)
    order = [c for c in opts.keep if c in df.columns] + \
            [c for c in K.CLEANED_COLUMNS if c in df.columns]
    order += [c for c in df.columns if c not in order]
    st["cleaned"] = df.select(*order)
    return st


def clean_citations(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Raw citation export -> the 18-column cleaned table."""
    return cleaning_stages(raw, opts)["cleaned"]
