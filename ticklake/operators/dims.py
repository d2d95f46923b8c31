"""Dimensions and facts (K1 SCD2, K2 calendar, K14 facts, K15 fundamentals)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.labels import date_parts
from ticklake.operators.ranking import latest_per_key

TRACKED = ("company_name", "sector", "industry", "exchange")
OPEN_END = "9999-12-31"
DIM_COLUMNS = ("company_key", "symbol", "company_name", "sector", "industry", "exchange",
               "version", "is_current", "effective_from", "effective_to")


def company_key(symbol: Column, version: Column) -> Column:
    """Deterministic surrogate key of (symbol, version)."""
    return F.xxhash64(symbol.cast("string"), version)


def _lit_date(d) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)))


def empty_dim(spark: SparkSession, symbol_type: str = "bigint") -> DataFrame:
    """An empty dimension.  Built from ``range(0)`` so the optimizer knows it
    is empty (a local relation from an empty list has unknown size, which
    would make the *other* side of a join look like the broadcast candidate)."""
    cols = {"company_key": "bigint", "symbol": symbol_type, "company_name": "string", "sector": "string",
            "industry": "string", "exchange": "string", "version": "int", "is_current": "boolean",
            "effective_from": "date", "effective_to": "date"}
    return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in cols.items()])


def scd2_upsert(dim: DataFrame, updates: DataFrame, as_of, key: str = "symbol",
                tracked=TRACKED) -> DataFrame:
    """K1: slowly changing dimension, type 2.

    * new symbol -> open row, version 1, effective_from = as_of;
    * a tracked attribute changed (NULL-safe) -> close the current row
      (is_current false, effective_to = as_of - 1 day) and open version + 1;
    * nothing changed / no update -> rows unchanged.

    One full outer join between the current rows and the (deduplicated)
    updates on the key; each joined row emits one or two output rows through
    ``explode``, so the join result is read once.  Closed history rows
    bypass the join.
    """
    as_of_c = _lit_date(as_of)
    u = latest_per_key(updates.select(key, *tracked), [key], list(tracked))
    cur = dim.filter(F.col("is_current"))
    hist = dim.filter(~F.col("is_current"))
    j = cur.alias("c").join(u.withColumn("_u", F.lit(True)).alias("u"), key, "full_outer")
    has_c = F.col("c.version").isNotNull()
    has_u = F.col("_u").isNotNull()
    same = F.lit(True)
    for t in tracked:
        same = same & F.col(f"c.{t}").eqNullSafe(F.col(f"u.{t}"))
    changed = has_c & has_u & ~same
    new_version = F.when(has_c, F.col("c.version") + 1).otherwise(F.lit(1))

    def row(symbol, attrs, version, is_current, eff_from, eff_to):
        return F.struct(company_key(symbol, version).alias("company_key"), symbol.alias("symbol"),
                        *[a.alias(t) for a, t in zip(attrs, tracked)],
                        version.cast("int").alias("version"), is_current.alias("is_current"),
                        eff_from.alias("effective_from"), eff_to.alias("effective_to"))

    k = F.col(key)
    old = row(k, [F.col(f"c.{t}") for t in tracked], F.col("c.version"),
              F.when(changed, F.lit(False)).otherwise(F.col("c.is_current")),
              F.col("c.effective_from"),
              F.when(changed, F.date_sub(as_of_c, 1)).otherwise(F.col("c.effective_to")))
    new = row(k, [F.col(f"u.{t}") for t in tracked], new_version, F.lit(True), as_of_c,
              F.lit(None).cast("date"))
    out = F.filter(F.array(F.when(has_c, old), F.when(changed | ~has_c, new)), lambda x: x.isNotNull())
    touched = j.select(F.explode(out).alias("r")).select("r.*")
    return hist.select(*DIM_COLUMNS).unionByName(touched.select(*DIM_COLUMNS))


def build_dim_date(spark: SparkSession, start, end) -> DataFrame:
    """K2: calendar for literal bounds (the reference loads 2020-01-01 .. 2035-12-31)."""
    b = spark.range(1).select(_lit_date(start).alias("min_date"), _lit_date(end).alias("max_date"))
    return dim_date_from(b)


def dim_date_from(bounds: DataFrame, start: str = "min_date", end: str = "max_date") -> DataFrame:
    """K2 over the span of a one-row bounds frame (e.g. D10 of the facts).

    The calendar has one row per day of the span, so its size is bounded by
    the calendar, not by the data volume.
    """
    d = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("full_date"))
    return d.select(*date_parts(F.col("full_date"))[:1], "full_date", *date_parts(F.col("full_date"))[1:],
                    F.lit(False).alias("is_holiday"))


# The member that facts without a company version in force belong to.
UNKNOWN_KEY, UNKNOWN_VERSION = -1, 0
BUCKET_DAYS = 1461                     # versions are met within spans of four years
LAST_BUCKET_DAY = "2100-01-01"         # later days share its span; the dates themselves are compared whole


def with_unknown_member(dim: DataFrame) -> DataFrame:
    """The dimension and its unknown member (no symbol, never current)."""
    none = {"company_key": UNKNOWN_KEY, "version": UNKNOWN_VERSION, "is_current": False}
    row = dim.sparkSession.range(1).select(*[F.lit(none.get(c)).cast(t).alias(c) for c, t in dim.dtypes])
    return dim.unionByName(row)


def _span(day: Column) -> Column:
    return F.floor(F.unix_date(F.least(day, F.lit(LAST_BUCKET_DAY).cast("date"))) / BUCKET_DAYS).cast("int")


def as_of_version(facts: DataFrame, dim: DataFrame, day: Column) -> DataFrame:
    """Every fact with ``company_key`` and ``company_version`` of the
    version in force on ``day``, or of the unknown member.

    An interval join by date spans: each version is listed under the spans it
    reaches, and facts meet the versions of their own span only, so neither
    many versions of a company nor many facts make a quadratic join, and a
    company's facts spread by span.  Facts out = facts in (versions of a
    company do not overlap)."""
    to = F.coalesce(F.col("effective_to"), F.lit(OPEN_END).cast("date"))
    d = dim.filter(F.col("symbol").isNotNull()).select(
        F.col("symbol").alias("_sym"), F.col("company_key").alias("_key"), F.col("version").alias("_version"),
        F.col("effective_from").alias("_from"), to.alias("_to"),
        F.explode(F.sequence(_span(F.col("effective_from")), _span(to))).alias("_sp"))
    f = facts.withColumns({"_day": day, "_span": _span(day)})
    on = ((f["symbol"] == d["_sym"]) & (f["_span"] == d["_sp"]) & (f["_day"] >= d["_from"]) & (f["_day"] <= d["_to"]))
    return f.join(d, on, "left").withColumns({
        "company_key": F.coalesce("_key", F.lit(UNKNOWN_KEY)),
        "company_version": F.coalesce("_version", F.lit(UNKNOWN_VERSION))}).drop(
        "_sym", "_key", "_version", "_from", "_to", "_sp", "_span", "_day")


def load_fact_prices(prices: DataFrame, dim: DataFrame) -> DataFrame:
    """fact_prices with date_key (H18) and the company version in force on the trade date."""
    j = as_of_version(prices, dim, F.col("trade_date"))
    date_key = F.date_format("trade_date", "yyyyMMdd").cast("int")
    return j.select(F.xxhash64(date_key, F.col("company_key"), F.col("symbol")).alias("price_key"),
                    date_key.alias("date_key"), "company_key", "company_version", "symbol", "trade_date",
                    "open_price", "high_price", "low_price", "close_price", "adj_close_price",
                    "volume", "daily_return")


def load_fact_fundamentals(fund: DataFrame, dim: DataFrame) -> DataFrame:
    """fact_fundamentals keyed by (date_key of the report period, company_key, metric)."""
    j = as_of_version(fund, dim, F.col("report_period"))
    date_key = F.date_format("report_period", "yyyyMMdd").cast("int")
    return j.select(date_key.alias("date_key"), "company_key", "company_version", "symbol", "metric_name",
                    "metric_value")


def reload_facts(stored: DataFrame, loaded: DataFrame, keys=("date_key", "symbol")) -> DataFrame:
    """K14 + A9: facts that are stored stay as they are; new ones are added."""
    from ticklake.sources.sinks import insert_ignore
    return insert_ignore(stored, loaded, list(keys))


def promote_fundamentals(raw: DataFrame) -> DataFrame:
    """Newest report period per (symbol, metric_name)."""
    return latest_per_key(raw, ["symbol", "metric_name"], ["report_period", "metric_value"])


def upsert_fundamentals(silver: DataFrame, raw: DataFrame) -> DataFrame:
    """K15 + A10: the newest values of ``raw`` replace silver's; other rows stay."""
    from ticklake.sources.sinks import upsert_overwrite
    return upsert_overwrite(silver, promote_fundamentals(raw), ["symbol", "metric_name"],
                            ["report_period", "metric_value"])
