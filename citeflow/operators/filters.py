"""Row filters. Comparison filters follow SQL three-valued logic: ``col != v``
also removes nulls, as in the original job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def year_range(df: DataFrame, col: str, low: int, high: int) -> DataFrame:
    """Keep ``low < col < high`` (both exclusive)."""
    return df.where((F.col(col) > low) & (F.col(col) < high))


def drop_sentinels(df: DataFrame, sentinels: Mapping[str, str]) -> DataFrame:
    """Remove rows equal to a sentinel code (and rows null in those columns)."""
    cond = None
    for c, v in sentinels.items():
        if c not in df.columns:
            continue
        term = F.col(c) != F.lit(v)
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def dropna_subset(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(subset))


def dropna_any(df: DataFrame) -> DataFrame:
    """Drop rows with any null (NaN counts as null for float columns)."""
    return df.dropna(how="any")
