"""Scalar Column functions H1-H19 (labels, formats, date parts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticklake.functions.clean import strip

# Keyword lists of the keyword sentiment proxy (H5).
POSITIVE_WORDS = ("growth", "profit", "increase", "strong", "beat")
NEGATIVE_WORDS = ("loss", "decline", "weak", "miss", "fall")
KEYWORD_WEIGHT = 0.15
# The texts that the functions below show (labels, narrative lines, money formats) must read so.
RUPEE = "₹"
CRORE = 1e7
LAKH_CRORE = 1e5


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def content_hash(text) -> Column:
    """H1: SHA-256 hex."""
    return F.sha2(_c(text), 256)


def headline_text(c) -> Column:
    """A headline as it is stored and hashed: without white space of any kind at either end."""
    return strip(_c(c))


def headline_hash(headline) -> Column:
    """The key of an article (H1 of the stored headline); NULL without a headline."""
    return content_hash(headline_text(headline))


def doc_text(title, summary) -> Column:
    """H4: ``title || '. ' || coalesce(summary, '')``."""
    return F.concat(_c(title), F.lit(". "), F.coalesce(_c(summary), F.lit("")))


def keyword_sentiment(text) -> Column:
    """H5: (positive words present - negative words present) * 0.15.

    Each word counts once if it occurs anywhere as a substring (lower case).
    """
    low = F.lower(_c(text))
    pos = sum(F.contains(low, F.lit(w)).cast("int") for w in POSITIVE_WORDS)
    neg = sum(F.contains(low, F.lit(w)).cast("int") for w in NEGATIVE_WORDS)
    return (pos - neg) * F.lit(KEYWORD_WEIGHT)


def _grouped(x: Column, decimals: int) -> Column:
    """Python's ``{x:,.Nf}``: thousands separators, HALF_EVEN like format_number."""
    return F.format_number(x, decimals)


def crore_label(v) -> Column:
    """H6: value / 1e7; >= 1e5 crore -> '₹x.xL Cr', else '₹x,xxx Cr'; NULL or NaN -> 'N/A'."""
    cr = _c(v).cast("double") / F.lit(CRORE)
    return (F.when(_c(v).isNull() | F.isnan(cr), F.lit("N/A"))
             .when(cr >= LAKH_CRORE, F.concat(F.lit(RUPEE), F.format_string("%.1f", F.bround(cr / LAKH_CRORE, 1)),
                                         F.lit("L Cr")))
             .otherwise(F.concat(F.lit(RUPEE), _grouped(cr, 0), F.lit(" Cr"))))


def pe_label(v) -> Column:
    """H7: 'x.xx' -> 'x.x' + 'x'; NULL -> 'N/A'."""
    return F.when(_c(v).isNull() | F.isnan(_c(v).cast("double")), F.lit("N/A")).otherwise(
        F.concat(F.format_string("%.1f", F.bround(_c(v).cast("double"), 1)), F.lit("x")))


def rsi_label(rsi) -> Column:
    """H8."""
    r = _c(rsi)
    return (F.when(r < 30, F.lit("Oversold")).when(r < 50, F.lit("Weakening"))
             .when(r < 70, F.lit("Healthy")).when(r.isNotNull(), F.lit("Overbought")))


def position_label(norm) -> Column:
    """H9: position in the 52-week range, norm * 100 bucketed at 20 / 50 / 80."""
    p = _c(norm) * 100
    return (F.when(p < 20, F.lit("Near 52-week low")).when(p < 50, F.lit("Lower half of range"))
             .when(p < 80, F.lit("Upper half of range")).when(p.isNotNull(), F.lit("Near 52-week high")))


def breadth_label(advance_pct) -> Column:
    """> 60 broad rally, < 40 broad sell-off, else mixed (NULL counts as 0)."""
    a = F.coalesce(_c(advance_pct), F.lit(0.0))
    return F.when(a > 60, F.lit("Broad rally")).when(a < 40, F.lit("Broad sell-off")).otherwise(F.lit("Mixed"))


def valuation_label(pe) -> Column:
    """Only for pe > 0."""
    p = _c(pe)
    return (F.when(~(p > 0) | p.isNull(), F.lit(None).cast("string"))
             .when(p > 30, F.lit("premium")).when(p < 15, F.lit("conservative")).otherwise(F.lit("moderate")))


def drop_from_high(close, high) -> Column:
    return (_c(high) - _c(close)) / _c(high) * 100


def momentum_label(close, high, low) -> Column:
    """Drop from the 52-week high (h - c) / h * 100: < 5 testing the high,
    > 20 distribution, else consolidating; only when h > l."""
    d = drop_from_high(close, high)
    ok = _c(close).isNotNull() & (_c(high) > _c(low))
    return (F.when(~F.coalesce(ok, F.lit(False)), F.lit(None).cast("string"))
             .when(d < 5, F.lit("testing high")).when(d > 20, F.lit("distribution"))
             .otherwise(F.lit("consolidating")))


def sma_gap(price, sma20) -> Column:
    """struct(direction 'above'/'below', distance) when both present and non-zero."""
    p, s = _c(price), _c(sma20)
    ok = F.coalesce((p != 0) & (s != 0), F.lit(False))
    return F.when(ok, F.struct(F.when(p > s, F.lit("above")).otherwise(F.lit("below")).alias("direction"),
                               F.abs(p - s).alias("distance")))


def outlook_label(score) -> Column:
    """H14 (page form): > 0.1 positive, < -0.1 cautious, else neutral; NULL -> ''."""
    s = _c(score)
    return (F.when(s.isNull(), F.lit("")).when(s > 0.1, F.lit("Positive Outlook"))
             .when(s < -0.1, F.lit("Cautious Outlook")).otherwise(F.lit("Neutral Outlook")))


def sentiment_label(avg_score) -> Column:
    """H14 (view form): BULLISH / BEARISH / NEUTRAL."""
    s = _c(avg_score)
    return F.when(s > 0.1, F.lit("BULLISH")).when(s < -0.1, F.lit("BEARISH")).otherwise(F.lit("NEUTRAL"))


def bar_direction(open_, close, ret) -> Column:
    """struct(candle_down = close < open, return_up = coalesce(ret, 0) >= 0)."""
    return F.struct((_c(close) < _c(open_)).alias("candle_down"),
                    (F.coalesce(_c(ret), F.lit(0.0)) >= 0).alias("return_up"))


def range_position(close, high, low) -> Column:
    """Unclamped (c - l) / (h - l); NULL when h = l."""
    return F.try_divide(_c(close) - _c(low), F.nullif(_c(high) - _c(low), F.lit(0.0)))


def pct_change(live, prev) -> Column:
    """(live - prev) / prev * 100; NULL when prev is 0 or NULL."""
    return F.try_divide(_c(live) - _c(prev), F.nullif(_c(prev), F.lit(0.0))) * 100


def date_parts(d) -> list[Column]:
    """date_key (YYYYMMDD int), year, quarter, month, ISO week,
    weekday (0 = Monday .. 6 = Sunday), weekend flag."""
    d = _c(d)
    return [F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
            F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
            F.weekofyear(d).alias("week_of_year"), F.weekday(d).alias("day_of_week"),
            (F.weekday(d) >= 5).alias("is_weekend")]


def _whole(x: Column) -> Column:
    """Python's ``{x:.0f}``: round half to even, then print the integer."""
    return F.format_string("%.0f", F.bround(x, 0))


def narrative_money(x: Column) -> Column:
    return F.concat(F.lit(RUPEE), F.format_string("%.2f", x))


def fundamentals_narrative(symbol, eps=None, pe=None, market_cap=None, book_value=None,
                           price_to_book=None, high52=None, low52=None, sector_pe=None,
                           fetched=None) -> Column:
    """Multi-line summary; each line only when the metric is present and
    non-zero; the 52-week low line only under a present high; caps above
    1e7 are shown in crore."""

    def line(v, render):
        if v is None:
            return F.lit(None).cast("string")
        v = _c(v).cast("double")
        return F.when(F.coalesce(v != 0, F.lit(False)), render(v))

    def cap_render(v):
        return F.concat(F.lit("• Market Cap: "),
                        F.when(v > CRORE, F.concat(F.lit(RUPEE), _whole(v / CRORE), F.lit(" Cr")))
                         .otherwise(F.concat(F.lit(RUPEE), _whole(v))))

    hi = None if high52 is None else _c(high52).cast("double")
    lo_line = F.lit(None).cast("string")
    if high52 is not None and low52 is not None:
        lo = _c(low52).cast("double")
        lo_line = F.when(F.coalesce(hi != 0, F.lit(False)) & F.coalesce(lo != 0, F.lit(False)),
                         F.concat(F.lit("• 52-Week Low: "), narrative_money(lo)))
    fetched_c = F.lit("N/A") if fetched is None else F.coalesce(_c(fetched).cast("string"), F.lit("N/A"))
    return F.concat_ws(
        "\n",
        F.concat(_c(symbol).cast("string"), F.lit(" Financial Summary")),
        F.lit("=" * 50),
        line(eps, lambda v: F.concat(F.lit("• EPS (Earnings Per Share): "), narrative_money(v))),
        line(pe, lambda v: F.concat(F.lit("• P/E Ratio: "), F.format_string("%.2f", v), F.lit("x"))),
        line(market_cap, cap_render),
        line(book_value, lambda v: F.concat(F.lit("• Book Value: "), narrative_money(v))),
        line(price_to_book, lambda v: F.concat(F.lit("• Price-to-Book Ratio: "), F.format_string("%.2f", v), F.lit("x"))),
        line(high52, lambda v: F.concat(F.lit("• 52-Week High: "), narrative_money(v))),
        lo_line,
        line(sector_pe, lambda v: F.concat(F.lit("• Sector P/E: "), F.format_string("%.2f", v), F.lit("x"))),
        F.concat(F.lit("\nData fetched: "), fetched_c))
