"""Column-level DataFrame -> DataFrame operators (renames, drops, casts, flatten).

All are projections: no shuffle, and Catalyst prunes unused columns down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from citeflow.constants import RAW_NAME_FIXES, standardize_name
from citeflow.functions.text import blank_to_null


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns in one projection; absent names are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def normalize_names(df: DataFrame) -> DataFrame:
    """Spaces in names become underscores (one ``toDF``, no per-column select)."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


def standardize_names(df: DataFrame) -> DataFrame:
    """Raw export header -> library names: fix known bad raw names, then strip,
    lower-case and replace spaces by underscores."""
    fixed = rename_columns(df, RAW_NAME_FIXES)
    return fixed.toDF(*[standardize_name(c) for c in fixed.columns])


def to_title_names(df: DataFrame, sep: str = " ") -> DataFrame:
    """Library names -> export-style names (``street_code1`` -> ``Street Code1``);
    ``sep='_'`` gives the cleaned export header (``Street_Code1``)."""
    def title(name: str) -> str:
        return sep.join(w[:1].upper() + w[1:] for w in name.split("_"))
    return df.toDF(*[title(c) for c in df.columns])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop a list of columns; absent names are ignored."""
    return df.drop(*list(names))


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def blank_to_null_all(df: DataFrame) -> DataFrame:
    """'' -> null over every string column in one projection."""
    targets = set(string_columns(df))
    return df.select(*[blank_to_null(F.col(c)).alias(c) if c in targets else F.col(c)
                       for c in df.columns])


def cast_all(df: DataFrame, data_type: str = "double") -> DataFrame:
    """Cast every column; bad text becomes null (``try_cast``) instead of failing."""
    return df.select(*[F.col(c).try_cast(data_type).alias(c) for c in df.columns])


def flatten_struct(df: DataFrame, struct_col: str, keep: Iterable[str] = ()) -> DataFrame:
    """``select(keep..., struct.*)``."""
    return df.select(*list(keep), f"{struct_col}.*")
