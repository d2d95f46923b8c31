"""Live quote overlays (C10, G3, H19) and the quotes input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.labels import pct_change
from ticklake.operators.ranking import latest_per_key

LIVE_PRICE_FACTOR = 1.01


def last_closes(bars: DataFrame) -> DataFrame:
    """(symbol, trade_date, close_price) of every symbol's newest bar."""
    return latest_per_key(bars.select("symbol", "trade_date", "close_price"), ["symbol"], ["trade_date"])


def quotes_from_bars(bars: DataFrame) -> DataFrame:
    """Live quotes derived from the newest bar of every symbol: live price =
    close * 1.01, previous close = close, change_pct by H19; odd symbols have
    no live price (change 0); market cap etc. only for symbols divisible by 4."""
    last = last_closes(bars)
    even = F.pmod("symbol", F.lit(2)) == 0
    cap = F.pmod("symbol", F.lit(4)) == 0
    live = F.when(even, F.col("close_price") * LIVE_PRICE_FACTOR)
    return last.select(
        "symbol", live.alias("live_price"), F.col("close_price").alias("prev_close"),
        F.when(even, pct_change(live, F.col("close_price"))).otherwise(F.lit(0.0)).alias("change_pct"),
        F.when(cap, F.col("close_price") * 1e6).alias("market_cap"),
        F.when(cap, F.lit(20.0)).alias("trailing_pe"),
        F.when(cap, F.lit(2.5)).alias("price_to_book"),
        F.when(cap, F.col("close_price") * 1.5).alias("fifty_two_week_high"),
        F.when(cap, F.col("close_price") * 0.5).alias("fifty_two_week_low"))


def _truthy(c: Column) -> Column:
    return F.coalesce(c != 0, F.lit(False))


def overlay_live(snapshot: DataFrame, quotes: DataFrame, page: str = "price") -> DataFrame:
    """LEFT JOIN live quotes; per column the live value wins when present
    and non-zero.  ``page='price'``: daily_return = change_pct / 100 whenever
    change_pct is present (0 included).  ``page='insights'``: price and return
    only with a live price (return = coalesce(change_pct, 0) / 100), and
    PE / PB / 52-week taken as a block only when market cap is present."""
    q = quotes.select("symbol", *[F.col(c).alias(f"q_{c}") for c in quotes.columns if c != "symbol"])
    j = snapshot.join(q, "symbol", "left")
    out = {}
    if page == "price":
        out["close_price"] = F.when(_truthy(F.col("q_live_price")), F.col("q_live_price")).otherwise(F.col("close_price"))
        out["daily_return"] = F.when(F.col("q_change_pct").isNotNull(), F.col("q_change_pct") / 100.0).otherwise(F.col("daily_return"))
        for c in ("market_cap", "trailing_pe", "price_to_book", "fifty_two_week_high", "fifty_two_week_low"):
            out[c] = F.when(_truthy(F.col(f"q_{c}")), F.col(f"q_{c}")).otherwise(F.col(c))
    else:
        live = _truthy(F.col("q_live_price"))
        out["close_price"] = F.when(live, F.col("q_live_price")).otherwise(F.col("close_price"))
        out["daily_return"] = F.when(live, F.coalesce(F.col("q_change_pct"), F.lit(0.0)) / 100.0).otherwise(F.col("daily_return"))
        cap = _truthy(F.col("q_market_cap"))
        for c in ("market_cap", "trailing_pe", "price_to_book", "fifty_two_week_high", "fifty_two_week_low"):
            out[c] = F.when(cap, F.col(f"q_{c}")).otherwise(F.col(c))
    return j.select(*[out.get(c, F.col(c)).alias(c) for c in snapshot.columns])


def append_live_bar(history: DataFrame, quotes: DataFrame, today, last: DataFrame | None = None) -> DataFrame:
    """Add today's bar from the live quote when the symbol's last bar is
    older than today: open = previous close (else the last close), high/low =
    max/min(open, live), volume 0, indicators NULL, daily_return =
    coalesce(change_pct, 0) / 100, is_outlier false.

    ``history`` passes through; the new bars, one a symbol at most, come from
    an aggregate (``last``: the newest bar of each symbol, when the caller has
    it cheaper than from ``history``)."""
    today_c = today if isinstance(today, Column) else F.lit(today).cast("date")
    last = last_closes(history) if last is None else last
    live, chg = F.col("live_price"), F.col("change_pct")
    j = last.join(quotes.select("symbol", "live_price", "prev_close", "change_pct"), "symbol")
    j = j.filter(_truthy(live) & (F.col("trade_date") < today_c))
    open_ = F.coalesce(F.nullif(F.col("prev_close"), F.lit(0.0)), F.col("close_price"))
    new = {"symbol": F.col("symbol"), "trade_date": today_c, "open_price": open_,
           "high_price": F.greatest(open_, live), "low_price": F.least(open_, live), "close_price": live,
           "volume": F.lit(0), "daily_return": F.coalesce(chg, F.lit(0.0)) / 100.0, "is_outlier": F.lit(False)}
    return history.unionByName(j.select(*[new.get(c, F.lit(None)).cast(t).alias(c) for c, t in history.dtypes]))
