"""Fundamentals and earnings plans (D1, C1, A8 summary, F4, F8, F9, C9, H17, L10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.labels import fundamentals_narrative
from ticklake.operators.ranking import latest_per_key

# Summary column <- accepted metric names (first wins).
SUMMARY_METRICS = {
    "market_cap": ("marketCap",),
    "trailing_pe": ("trailingPE", "pe"),
    "price_to_book": ("priceToBook",),
    "debt_to_equity": ("debtToEquity",),
    "return_on_equity": ("returnOnEquity",),
    "dividend_yield": ("dividendYield",),
    "fifty_two_week_high": ("high52",),
    "fifty_two_week_low": ("low52",),
}
SUMMARY_PRICE_COLUMNS = ("close_price", "daily_return", "normalised_close", "sma_20", "sma_50", "rsi_14")


def pivot_fundamentals(fund: DataFrame) -> DataFrame:
    """EAV -> one row per symbol, ``max(value) filter (metric = m)`` per
    summary column.  A hash aggregate on symbol with partial aggregation."""
    aggs = []
    for col, names in SUMMARY_METRICS.items():
        aggs.append(F.max(F.when(F.col("metric_name").isin(list(names)), F.col("metric_value"))).alias(col))
    return fund.groupBy("symbol").agg(*aggs)


def stock_summary(latest: DataFrame, fund: DataFrame) -> DataFrame:
    """C1 + D1: latest bar per symbol LEFT JOIN pivoted fundamentals.

    Pivoting before the join makes it 1:1 on symbol (the reference joins
    every metric row then groups; same result, fewer rows shuffled).
    """
    p = pivot_fundamentals(fund)
    base = latest.select("symbol", F.col("trade_date").alias("as_of_date"), *SUMMARY_PRICE_COLUMNS)
    return base.join(p, "symbol", "left")


def latest_metrics(fund: DataFrame) -> DataFrame:
    """newest value per (symbol, metric) (newest wins; the reference's
    dict fold let the oldest win, see README)."""
    return latest_per_key(fund, ["symbol", "metric_name"], ["report_period"])


def metrics_wide(latest: DataFrame) -> DataFrame:
    names = ["pe", "eps", "marketCap", "bookValue", "priceToBook", "high52", "low52", "sectorPE"]
    return latest.groupBy("symbol").agg(
        *[F.max(F.when(F.col("metric_name") == n, F.col("metric_value"))).alias(n) for n in names],
        F.max("report_period").alias("report_date"))


def earnings_report(fund: DataFrame, summaries: DataFrame | None = None,
                    fallback_chars: int | None = None) -> DataFrame:
    """Latest metrics -> narrative (H17) -> summary (model output when
    supplied, else the narrative, or its first ``fallback_chars``) -> sentiment
    (NULL -> 0).  Keyed by (ticker, report_date)."""
    w = metrics_wide(latest_metrics(fund))
    narrative = fundamentals_narrative(
        "symbol", eps="eps", pe="pe", market_cap="marketCap", book_value="bookValue",
        price_to_book="priceToBook", high52="high52", low52="low52", sector_pe="sectorPE",
        fetched=F.date_format("report_date", "yyyy-MM-dd"))
    out = w.select(F.col("symbol").alias("ticker"), "report_date", narrative.alias("narrative"))
    if summaries is not None:
        out = out.join(summaries, ["ticker", "report_date"], "left")
    else:
        out = out.withColumn("summary", F.lit(None).cast("string")).withColumn(
            "sentiment_score", F.lit(None).cast("double"))
    return out.select(
        "ticker", "report_date", "narrative",
        F.coalesce(F.nullif(F.col("summary"), F.lit("")),
                   F.substring("narrative", 1, fallback_chars) if fallback_chars else F.col("narrative")).alias("summary"),
        F.coalesce(F.col("sentiment_score"), F.lit(0.0)).alias("sentiment_score"),
        F.length("narrative").alias("raw_text_length"))


def upsert_reports(stored: DataFrame, reports: DataFrame) -> DataFrame:
    """L10 + A10: one report per (ticker, report_date); a newer run replaces
    its text, and reports of other dates stay."""
    from ticklake.sources.sinks import upsert_overwrite
    keys = ["ticker", "report_date"]
    return upsert_overwrite(stored, reports, keys, [c for c in stored.columns if c not in keys])


def attach_metrics(reports: DataFrame, summary: DataFrame) -> DataFrame:
    """Report rows LEFT JOIN the summary on the upper-cased symbol."""
    s = summary.withColumn("_k", F.upper(F.col("symbol").cast("string"))).drop("symbol")
    r = reports.withColumn("_k", F.upper(F.col("ticker").cast("string")))
    return r.join(s, "_k", "left").drop("_k")


def summary_snapshot(summary: DataFrame, symbols) -> DataFrame:
    """F8: filter + projection of the summary table."""
    from ticklake.functions.clean import filter_symbols
    return filter_symbols(summary, symbols)


def report_list(reports: DataFrame) -> DataFrame:
    """report rows newest first (order is presentation; keep it last)."""
    return reports.orderBy(F.col("report_date").desc(), F.col("ticker"))
