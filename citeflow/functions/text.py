"""Text canonicalisation, blank handling and label decoding."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeflow.constants import COUNTY_RULES


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonicalize(c, rules: Sequence[tuple[str, str]] = COUNTY_RULES,
                 anchored: bool = False) -> Column:
    """Apply ordered rewrite rules.

    Default: unanchored substring replacement, one rule after the other, exactly
    as the original chain (so ``QUEENS`` becomes ``QS``). ``anchored=True``
    rewrites whole values only (``QUEENS`` is left alone).

    A pattern without regex metacharacters (and a replacement without group
    references) is a literal rewrite, done with ``replace``: same result, no
    regex engine per row. Other rules go through ``regexp_replace``.
    """
    out = _col(c)
    for pattern, replacement in rules:
        if anchored:
            out = F.when(out == F.lit(pattern), F.lit(replacement)).otherwise(out)
        elif re.escape(pattern) == pattern and not set("$\\") & set(replacement):
            out = F.replace(out, F.lit(pattern), F.lit(replacement))
        else:
            out = F.regexp_replace(out, F.lit(pattern), F.lit(replacement))
    return out


def blank_to_null(c) -> Column:
    """'' becomes null (string columns only: comparing an int column with ''
    raises under ANSI mode, and never matched before)."""
    return F.nullif(_col(c), F.lit(""))


def decode_label(idx, labels: Sequence[str]) -> Column:
    """Class index -> label text by exact lookup in the fitted labels.

    Replaces a chain of unescaped regex rewrites on the stringified prediction,
    which turned ``10.0`` into ``1NY``. An index without a label (the ``keep``
    bucket) stays as its text.
    """
    i = _col(idx)
    table = F.array(*[F.lit(x) for x in labels])
    return F.coalesce(F.try_element_at(table, i.cast("int") + F.lit(1)), i.cast("string"))
