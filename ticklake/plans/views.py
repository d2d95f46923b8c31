"""Market views over the enriched price table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.functions.numeric import rnd
from ticklake.operators.ranking import latest_per_key, restrict_to_recent_dates
from ticklake.operators.indicators import ENRICHED_COLUMNS

TRADING_DAYS = 252          # fixed: annualisation factor
RECENT_DATES = 20           # fixed: "last 20 trading dates"
MIN_OBSERVATIONS = 5        # fixed: portfolio risk needs >= 5 log returns
OVERBOUGHT, OVERSOLD = 70, 30


def market_pulse(prices: DataFrame, eps: float = 0.0) -> DataFrame:
    """Daily breadth.  One hash aggregate on trade_date (partial + final)."""
    r = F.col("daily_return")
    total = F.count(F.lit(1))
    adv = F.count_if(r > 0)
    return prices.groupBy("trade_date").agg(
        total.alias("total_symbols"),
        adv.alias("advancing"),
        F.count_if(r < 0).alias("declining"),
        F.count_if((r == 0) | r.isNull()).alias("unchanged"),
        rnd(F.try_divide(adv, F.nullif(total, F.lit(0))) * 100, 2, eps).alias("advance_pct"),
        F.sum("volume").alias("total_volume"),
        rnd(F.avg(r) * 100, 4, eps).alias("avg_return_pct"),
        F.count_if(F.col("is_outlier")).alias("outlier_count"),
        F.count_if(F.col("rsi_14") > OVERBOUGHT).alias("overbought_count"),
        F.count_if(F.col("rsi_14") < OVERSOLD).alias("oversold_count"))


def latest_bars(prices: DataFrame) -> DataFrame:
    """The current-quote row per symbol (newest trade_date)."""
    return latest_per_key(prices.select(*[c for c in ENRICHED_COLUMNS if c in prices.columns]), ["symbol"], ["trade_date"])


def current_dim(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))


def join_current_dim(facts: DataFrame, dim: DataFrame, cols=("sector",)) -> DataFrame:
    """C4: facts joined to the current version of each company.

    No broadcast hint: the dimension grows with the number of companies;
    AQE turns the join into a broadcast at run time when the filtered
    dimension is measured to be small.
    """
    d = current_dim(dim).select("symbol", *cols)
    return facts.join(d, "symbol")


def sector_momentum(prices: DataFrame, dim: DataFrame, eps: float = 0.0,
                    n_dates: int = RECENT_DATES, calendar: DataFrame | None = None) -> DataFrame:
    """D3: per (sector, date) over the n newest dates.

    ``calendar`` (any frame with the same trade dates, e.g. the cleaned bars
    the prices were computed from) lets the date list come from a cheap scan
    instead of a second evaluation of the indicator plan.
    """
    p = restrict_to_recent_dates(prices, n_dates, calendar=calendar)
    j = join_current_dim(p, dim).filter(F.col("sector").isNotNull())
    r = F.col("daily_return")
    return j.groupBy("sector", "trade_date").agg(
        F.countDistinct("symbol").alias("symbol_count"),
        rnd(F.avg("close_price"), 4, eps).alias("avg_close"),
        rnd(F.avg(r), 6, eps).alias("avg_daily_return"),
        rnd(F.avg("sma_20"), 4, eps).alias("avg_sma_20"),
        rnd(F.avg("sma_50"), 4, eps).alias("avg_sma_50"),
        rnd(F.avg("rsi_14"), 4, eps).alias("avg_rsi_14"),
        rnd(F.avg("normalised_close"), 4, eps).alias("avg_norm_close"),
        F.count_if(r > 0).alias("advancing"),
        F.count_if(r < 0).alias("declining"),
        F.sum("volume").alias("total_volume"))


def market_proxy(prices: DataFrame, n_dates: int | None = RECENT_DATES) -> DataFrame:
    """Equal-weight mean log return per date (optionally the n newest dates)."""
    p = prices.filter(F.col("log_return").isNotNull())
    if n_dates:
        p = restrict_to_recent_dates(prices, n_dates).filter(F.col("log_return").isNotNull())
    return p.groupBy("trade_date").agg(F.avg("log_return").alias("market_log_return"))


def portfolio_risk(prices: DataFrame, eps: float = 0.0, n_dates: int = RECENT_DATES,
                   calendar: DataFrame | None = None) -> DataFrame:
    """20-day annualised volatility, beta against the equal-weight market
    and a Sharpe proxy, for symbols with at least 5 observations.

    The market proxy (D6) is an aggregate per date, pre-aggregated before
    its shuffle and joined back as a broadcast of at most ``n_dates`` rows;
    then one aggregate per symbol.
    """
    p = restrict_to_recent_dates(prices, n_dates, calendar=calendar).filter(F.col("log_return").isNotNull())
    proxy = p.groupBy("trade_date").agg(F.avg("log_return").alias("market_log_return"))
    j = p.join(F.broadcast(proxy), "trade_date")
    lr, mr = F.col("log_return"), F.col("market_log_return")
    s = j.groupBy("symbol").agg(
        F.count(lr).alias("obs_count"),
        (F.stddev_pop(lr) * F.lit(math.sqrt(TRADING_DAYS))).alias("vol"),
        F.avg(lr).alias("avg_lr"),
        F.covar_pop(lr, mr).alias("cov_m"),
        F.var_pop(mr).alias("var_m"))
    vol = F.col("vol")
    return s.filter(F.col("obs_count") >= MIN_OBSERVATIONS).select(
        "symbol", "obs_count",
        rnd(vol, 6, eps).alias("annualised_vol"),
        rnd("avg_lr", 6, eps).alias("avg_log_return_20d"),
        rnd(F.when(F.col("var_m") > 0, F.col("cov_m") / F.col("var_m")), 4, eps).alias("beta_20d"),
        rnd(F.when(F.nullif(vol, F.lit(0.0)).isNotNull(), F.col("avg_lr") * TRADING_DAYS / vol), 4, eps)
         .alias("sharpe_proxy"))


def return_moments(prices: DataFrame, eps: float = 0.0) -> DataFrame:
    """Per-symbol population mean / std of daily returns (std 0 -> 1e-9)."""
    r = F.col("daily_return")
    s = prices.groupBy("symbol").agg(F.avg(r).alias("m"), F.stddev_pop(r).alias("s"),
                                     F.count(r).alias("n_returns"))
    return s.select("symbol", "n_returns",
                    rnd(F.coalesce("m", F.lit(0.0)), 8, eps).alias("mean_return"),
                    rnd(F.when(F.col("s") > 0, F.col("s")).otherwise(F.lit(1e-9)), 8, eps).alias("std_return"))


def recent_breadth(pulse: DataFrame, n: int = 10) -> DataFrame:
    """the n newest pulse rows (returned in ascending date order)."""
    return pulse.orderBy(F.col("trade_date").desc()).limit(n).orderBy("trade_date")


def price_history(prices: DataFrame, symbols, as_of, days: int) -> DataFrame:
    """one symbol's (or several symbols') bars over a look-back, ordered."""
    from ticklake.functions.clean import filter_symbols, lookback
    return lookback(filter_symbols(prices, symbols), days, as_of).orderBy("symbol", "trade_date")
