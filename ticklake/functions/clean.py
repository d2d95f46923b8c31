"""Projections, filters and predicates (B1-B13) as Column / DataFrame helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wire schema of a price message.
PRICE_MESSAGE_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), True),
    T.StructField("trade_date", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("adj_close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("ingested_at", T.StringType(), True),
])

# Market session (IST, inclusive bounds) and statement guard.
MARKET_TZ = "Asia/Kolkata"
MARKET_OPEN = "09:15:00.000000"
MARKET_CLOSE = "15:30:00.000000"
FORBIDDEN_WORDS = ("DROP", "DELETE", "TRUNCATE", "INSERT", "UPDATE", "ALTER", "CREATE")
COMMENT_MARK = "--"
ROW_CAP = 1000
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def canonical_symbol(col: Column | str) -> Column:
    """B1: strip the exchange suffix '.NS' and upper-case."""
    return F.upper(F.replace(_c(col), F.lit(".NS"), F.lit("")))


def decode_price_json(df: DataFrame, value: str = "value") -> DataFrame:
    """B2: bytes/string -> typed columns; malformed JSON gives an all-NULL row
    (PERMISSIVE), which the dead-letter split then catches."""
    parsed = F.from_json(_c(value).cast("string"), PRICE_MESSAGE_SCHEMA, {"mode": "PERMISSIVE"})
    return df.select(parsed.alias("m")).select("m.*")


def add_date_columns(df: DataFrame) -> DataFrame:
    """Parse trade_date / ingested_at; derive year and month."""
    return (df.withColumn("trade_date", F.try_to_date(F.col("trade_date"), "yyyy-MM-dd"))
              .withColumn("ingested_at", F.try_to_timestamp(F.col("ingested_at")))
              .withColumn("year", F.year("trade_date"))
              .withColumn("month", F.month("trade_date")))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def valid_condition(close: str = "close") -> Column:
    return F.col(close).isNotNull() & ~F.isnan(F.col(close).cast("double")) & (F.col(close) > 0)


def split_valid_dead(df: DataFrame, close: str = "close") -> tuple[DataFrame, DataFrame]:
    """valid = close neither NULL nor NaN, and > 0; dead = the exact complement."""
    ok = valid_condition(close)
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))


def safe_float(col: Column | str) -> Column:
    """NULL for NULL, '', '-' and non-numeric text."""
    s = F.trim(_c(col).cast("string"))
    return F.when(s.rlike(NUMBER), s).try_cast("double")


def lookback(df: DataFrame, days: int, as_of, date: str = "trade_date") -> DataFrame:
    """Rows with date >= as_of - days (as_of is a literal or Column)."""
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of)
    col = F.col(date)
    if isinstance(df.schema[date].dataType, T.DateType):
        return df.filter(col >= F.date_sub(as_of_c.cast("date"), days))
    return df.filter(col >= as_of_c - F.make_dt_interval(F.lit(days)))


def filter_symbols(df: DataFrame, symbols, col: str = "symbol") -> DataFrame:
    """``symbol = ANY(list)``; a DataFrame of symbols becomes a semi join."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select(F.col(symbols.columns[0]).alias(col)).distinct(), col, "left_semi")
    return df.filter(F.col(col).isin(list(symbols)))


def in_market_hours(ts: Column | str) -> Column:
    """Monday-Friday and 09:15:00 <= IST wall time <= 15:30:00.

    ``ts`` is a UTC instant stored without zone (timestamp_ntz); the IST wall
    clock comes from ``convert_timezone``, independent of the session zone.
    """
    t = _c(ts)
    local = F.convert_timezone(F.lit("UTC"), F.lit(MARKET_TZ), t.cast("timestamp_ntz"))
    hhmmss = F.date_format(local, "HH:mm:ss.SSSSSS")
    return (F.weekday(local) < 5) & hhmmss.between(MARKET_OPEN, MARKET_CLOSE)


def clean_articles(df: DataFrame, body_chars: int | None = None) -> DataFrame:
    """Non-empty title without outer white space; source name from a
    nested struct when present; body = content else description else '',
    whole unless the caller asks for its first ``body_chars``."""
    title = strip(F.col("title"))
    src = F.col("source")
    if isinstance(df.schema["source"].dataType, T.StructType):
        src = F.col("source.name")
    body = F.coalesce(F.nullif(F.col("content"), F.lit("")),
                      F.nullif(F.col("description"), F.lit("")), F.lit(""))
    return (df.withColumn("title", title)
              .filter(F.col("title").isNotNull() & (F.col("title") != ""))
              .withColumn("source_name", src)
              .withColumn("body", F.substring(body, 1, body_chars) if body_chars else body))


def require_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """B11."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def statement_verdict(sql: Column | str) -> Column:
    """struct(allowed boolean, reason string) for a statement text.

    Keywords are checked first (whole word, case-insensitive; '--' anywhere),
    then the statement must start with SELECT.
    """
    s = _c(sql)
    up = F.upper(s)
    reason = F.lit(None).cast("string")
    branches = None
    for w in FORBIDDEN_WORDS:
        cond = up.rlike(rf"\b{w}\b")
        branches = F.when(cond, F.lit(f"forbidden keyword {w}")) if branches is None \
            else branches.when(cond, F.lit(f"forbidden keyword {w}"))
    branches = branches.when(F.contains(s, F.lit(COMMENT_MARK)), F.lit(f"forbidden keyword {COMMENT_MARK}"))
    branches = branches.when(~F.startswith(strip(up), F.lit("SELECT")), F.lit("not a SELECT"))
    reason = branches.otherwise(reason)
    return F.struct(reason.isNull().alias("allowed"), reason.alias("reason"))


def cap_statement(sql: Column | str, cap: int = ROW_CAP) -> Column:
    """Append ``LIMIT <cap>;`` when LIMIT is absent, else ensure a trailing ';'."""
    s = _c(sql)
    rstripped = F.regexp_replace(s, r"\s+$", "")
    return (F.when(~F.contains(F.upper(s), F.lit("LIMIT")),
                   F.concat(F.regexp_replace(rstripped, r";+$", ""), F.lit(f" LIMIT {cap};")))
             .when(F.endswith(rstripped, F.lit(";")), s)
             .otherwise(F.concat(s, F.lit(";"))))


def classify_statements(df: DataFrame, col: str = "statement") -> DataFrame:
    """B12 + B13 over a table of statements: allowed, reason, guarded text."""
    v = statement_verdict(col)
    return (df.withColumn("_v", v)
              .select("*", F.col("_v.allowed").alias("allowed"), F.col("_v.reason").alias("reason"))
              .drop("_v")
              .withColumn("guarded", F.when(F.col("allowed"), cap_statement(col))))


def capped_read(df: DataFrame, *order: str, cap: int = ROW_CAP) -> DataFrame:
    """B13 DataFrame form: at most ``cap`` rows (the feature is the cap), the
    first in ``order`` when one is given."""
    return (df.orderBy(*order) if order else df).limit(cap)
