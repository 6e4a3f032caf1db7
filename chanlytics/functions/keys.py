"""Surrogate and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chanlytics.functions._util import as_col


def surrogate_key(*cols: "Column | str") -> Column:
    """md5 over the columns cast to text and joined by '-', NULL -> ''.

    This is the surrogate-key rule of the model: every part is always
    present (a NULL becomes an empty string, the separator stays), so
    ``concat_ws`` - which drops NULL parts with their separator - is not
    usable here.
    """
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("-"))
        parts.append(F.coalesce(as_col(c).cast("string"), F.lit("")))
    return F.md5(F.concat(*parts))


def date_key(d: "Column | str") -> Column:
    """YYYYMMDD as int, by arithmetic (no string formatting per row)."""
    d = as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
