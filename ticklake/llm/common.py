"""Small helpers shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.session import materialize

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back: an
    executor that is lost later costs nothing that came before."""
    return materialize(df, f"llm-{name}")


def id_remainder(col: Column, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def valid_vector(col: Column) -> Column:
    """Neither null nor holding a null or non-finite component."""
    inf = F.lit(float("inf"))
    ok = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < inf))
    return F.coalesce(col.isNotNull() & ok, F.lit(False))
