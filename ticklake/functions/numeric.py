"""Rounding and safe arithmetic on Columns.

``rnd`` is HALF_UP rounding (Spark's ``round``; the reference stores results
in NUMERIC columns, which round the same way).  ``eps`` shifts the value
before rounding; the registered queries use a tiny shift so results at an
exact decimal tie do not depend on the last bit of a float sum, which
differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TIE_EPS = 1e-9


def rnd(c: Column | str, digits: int, eps: float = 0.0) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    if eps:
        c = c + F.lit(eps)
    return F.round(c, digits)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(num, F.nullif(den, F.lit(0)))
