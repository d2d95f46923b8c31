"""Latest-row, ranking and top-k operators (E10, E11, F-series)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row with the greatest ``order`` per key (DISTINCT ON).

    Written as one hash aggregate with ``max_by(struct(row), struct(order))``:
    partial aggregation keeps one candidate per key per input partition, so a
    key holding a third of the rows never reaches a task as a third of the
    rows, and no sort is needed.  ``order`` should be a total order within a
    key (add tie-break columns) so the answer is deterministic.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordk).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """at most n rows per key.

    ``row_number() <= n`` over a partition is planned with a
    ``WindowGroupLimit`` below the exchange, so each input partition sends
    at most n rows per key to the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """global newest-n (TakeOrderedAndProject: per-partition top n, then merge)."""
    return df.orderBy(*order).limit(n)


def recent_dates(df: DataFrame, n: int, date: str = "trade_date") -> DataFrame:
    """the n newest distinct dates (distinct is a partial hash aggregate;
    the result is at most n rows)."""
    return df.select(date).distinct().orderBy(F.col(date).desc()).limit(n)


def restrict_to_recent_dates(df: DataFrame, n: int, date: str = "trade_date",
                             calendar: DataFrame | None = None) -> DataFrame:
    """Keep rows whose date is among the n newest (of ``calendar`` when
    given, which must hold the same dates as ``df``).

    The date list has at most n rows, so broadcasting it is size-bounded;
    a left-semi join never adds columns or duplicates.
    """
    dates = recent_dates(calendar if calendar is not None else df, n, date)
    return df.join(F.broadcast(dates), date, "left_semi")


def running_total(df: DataFrame, order: Sequence[Column], value: str, total: str = "running_total") -> DataFrame:
    """``df`` with the sum of ``value`` up to and including each row in
    ``order`` (a total order), for any number of rows: a stored range sort, a
    running sum within each of its partitions, and the sums of the partitions
    before (one row a partition).  No window over the whole table."""
    from ticklake.session import materialize
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("_at", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy("_part").agg(F.sum(value).alias("_sum")).agg(
        F.array_sort(F.collect_list(F.struct("_part", "_sum"))).alias("p"))
    before = F.transform("p", lambda x: F.struct(x["_part"].alias("_part"), F.aggregate(
        F.filter("p", lambda y: y["_part"] < x["_part"]), F.lit(0).cast("long"), lambda a, y: a + y["_sum"]).alias("_before")))
    parts = parts.select(F.explode(before).alias("b")).select("b.*")
    w = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    return (rows.join(parts, "_part").withColumn(total, F.col("_before") + F.sum(value).over(w))
            .drop("_part", "_at", "_before"))
