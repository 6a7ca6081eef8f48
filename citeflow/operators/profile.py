"""Profiling: counts, value shares, describe, missing-value audit, correlation,
schema listing and missing-fraction pruning.

Each report is a single aggregation pass with map-side partial aggregation, so
what crosses the shuffle is one partial row per task (or one per group and task),
never the raw rows. Nothing is collected to the driver except where noted
(``drop_sparse_columns`` reads back one row of fractions, one value per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def value_share(df: DataFrame, col: str, count_col: str = "count",
                pct_col: str = "percentage") -> DataFrame:
    """Rows per value of ``col`` and their share of all rows, ``(count/total)*100``.

    The total is a scalar subquery over the grouped counts (a sum of at most one
    row per group), not a second pass with ``count()`` on the driver and not a
    cross join; the grouped exchange is reused by the subquery.
    """
    grouped = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    total = grouped.select(F.sum(count_col)).scalar()
    return grouped.withColumn(pct_col, (F.col(count_col) / total) * F.lit(100))


def _numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def _stack(pairs: Sequence[tuple[str, list]], names: Sequence[str]) -> str:
    """``stack`` expression turning one wide row into one row per column."""
    parts = []
    for label, exprs in pairs:
        parts.append(f"'{label}'")
        parts.extend(exprs)
    return f"stack({len(pairs)}, {', '.join(parts)}) as ({', '.join(names)})"


def describe_stats(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """count, mean, sample stddev, min, max per column, in long form.

    Text columns have no mean and stddev; their min and max are in ``min_text`` and
    ``max_text``, those of numeric columns in ``min`` and ``max``. One aggregation over all
    columns at once (the built-in ``describe`` returns strings in a wide layout);
    ``stack`` then turns the single row into one row per column. Floating results are
    rounded to ``digits``.
    """
    numeric = set(_numeric_columns(df))
    cols = list(cols) if cols is not None else df.columns
    aggs, pairs = [], []
    for i, c in enumerate(cols):
        if c in numeric:
            x = F.col(c).cast("double")
            aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
            pairs.append((c, [f"n{i}", f"m{i}", f"s{i}", f"lo{i}", f"hi{i}", "cast(null as string)", "cast(null as string)"]))
        else:
            x = F.col(c).cast("string")
            aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
            none = ["cast(null as double)"] * 4
            pairs.append((c, [f"n{i}", *none, f"lo{i}", f"hi{i}"]))
    names = ["column_name", "n", "mean", "stddev", "min", "max", "min_text", "max_text"]
    long = df.agg(*aggs).selectExpr(_stack(pairs, names))
    return long.select(
        "column_name", F.col("n").alias("count"),
        F.round("mean", digits).alias("mean"), F.round("stddev", digits).alias("stddev"),
        "min", "max", "min_text", "max_text")


def _missing_condition(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    x = F.col(c)
    if isinstance(dt, StringType):
        # text markers, blanks and nulls
        return x.contains("None") | x.contains("NULL") | (x == F.lit("")) | x.isNull()
    if isinstance(dt, (DoubleType, FloatType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def missing_audit(df: DataFrame) -> DataFrame:
    """Per column: rows that are null, NaN, blank or contain 'None'/'NULL'.

    One row, one count column per input column, in one pass. Text tests apply
    to string columns and NaN tests to float columns only (``isnan`` on text
    raises under ANSI mode).
    """
    return df.agg(*[F.count_if(_missing_condition(df, c)).alias(c) for c in df.columns])


def observe_audit(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows and audits its columns while something else runs over it (a write):
    no pass of its own. Read the metrics with ``observed_audit`` when that has ended."""
    seen = Observation(name)
    conditions = [F.count_if(_missing_condition(df, c)).alias(f"missing{i}") for i, c in enumerate(df.columns)]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *conditions), seen


def observed_audit(df: DataFrame, seen: Observation, stage: str) -> list[tuple[str, str, int, int]]:
    """``(stage, column_name, missing, n_rows)`` for every column: the same numbers as ``missing_audit``
    and ``row_count`` give."""
    got = seen.get
    return [(stage, c, got[f"missing{i}"], got["n_rows"]) for i, c in enumerate(df.columns)]


def column_corr(df: DataFrame, a: str, b: str, nulls_as_zero: bool = True,
                name: str = "corr", digits: int = 10) -> DataFrame:
    """Pearson correlation as a one-row aggregate.

    ``nulls_as_zero=True`` reproduces ``DataFrame.stat.corr``, which reads a null
    as 0.0; ``False`` gives pairwise-complete correlation (``F.corr``).
    """
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    if nulls_as_zero:
        x, y = F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))
    return df.agg(F.round(F.corr(x, y), digits).alias(name))


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, n_columns, n_rows): a table's columns beside its size,
    one row per column from one counting pass."""
    n = len(df.columns)
    cells = ", ".join(f"{i}, '{f.name}', '{f.dataType.simpleString()}', {n}, n_rows"
                      for i, f in enumerate(df.schema.fields, 1))
    return row_count(df, "n_rows").selectExpr(
        f"stack({n}, {cells}) as (position, column_name, data_type, n_columns, n_rows)")


def missing_fraction(df: DataFrame, digits: int = 6) -> DataFrame:
    """(column_name, missing_fraction) per column in one pass; blanks count as missing."""
    conds = []
    for c in df.columns:
        x = F.col(c)
        miss = x.isNull()
        if isinstance(df.schema[c].dataType, StringType):
            miss = miss | (x == F.lit(""))
        conds.append(F.avg(miss.cast("double")).alias(f"f{len(conds)}"))
    wide = df.agg(*conds)
    pairs = [(c.replace("'", "\\'"), [f"f{i}"]) for i, c in enumerate(df.columns)]
    long = wide.selectExpr(_stack(pairs, ["column_name", "fraction"]))
    return long.select("column_name", F.round("fraction", digits).alias("missing_fraction"))


def drop_sparse_columns(df: DataFrame, threshold: float) -> DataFrame:
    """Drop columns whose missing fraction exceeds ``threshold``.

    The rule the original job applied by hand (hard-coded >30% and >75% lists),
    made executable. One aggregation; one value per column comes back.
    """
    fr = missing_fraction(df).collect()
    sparse = [r["column_name"] for r in fr if r["missing_fraction"] > threshold]
    return df.drop(*sparse)
