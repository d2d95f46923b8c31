"""Canonical operator inputs derived from the given tables.

The test tables are TPC-H-like, so every market-data input is derived
from them with plain DataFrame expressions (and every derivation has a
DuckDB twin in the oracle SQL):

* ``bars``          one OHLCV bar per (supplier, ship date) from ``lineitem``
* ``companies``     supplier -> name, sector (region), industry (nation)
* ``fundamentals``  quarterly EAV metrics per supplier from ``lineitem``
* ``news``          one article per document (headline = first line)
* ``messages``      JSON price messages built from ``events``

All of them grow with the tables they come from; none is a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.labels import headline_hash, headline_text
from ticklake.functions.numeric import TIE_EPS, rnd
from ticklake.sources.tables import read_table

# Fixed values of the fixtures (kept equal in the oracle SQL).
NEWS_EPOCH = "2024-01-01 00:00:00"       # published_at = epoch + doc_id * 20 minutes
NEWS_MINUTES_PER_DOC = 20
FUNDAMENTAL_METRICS = ("marketCap", "pe", "high52", "low52")


def _bar_order() -> Column:
    # Total order inside one (supplier, day): (orderkey, linenumber) repeats,
    # so partkey and price complete the tie-break.
    return F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def bars(spark: SparkSession, sf_dir: str, net: bool = False, lineitem: DataFrame | None = None) -> DataFrame:
    """Daily OHLCV bars, one per (symbol = l_suppkey, trade_date = ship day).

    One grouped aggregate: partial aggregation runs before the shuffle, so
    a hot supplier costs one partial row per input partition, not a hot task.
    """
    cols = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    li = lineitem.select(*cols) if lineitem is not None else read_table(spark, sf_dir, "lineitem", *cols)
    o = _bar_order()
    if net:  # net-of-discount prices (a second feed with the same keys)
        li = (read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_extendedprice", "l_discount", "l_quantity", "l_shipdate")
              .withColumn("l_price", F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))))
    else:
        li = li.withColumn("l_price", F.col("l_extendedprice"))
    return (li.groupBy(F.col("l_suppkey").alias("symbol"),
                       F.to_date("l_shipdate").alias("trade_date"))
              .agg(F.min_by("l_price", o).alias("open_price"),
                   F.max("l_price").alias("high_price"),
                   F.min("l_price").alias("low_price"),
                   F.max_by("l_price", o).alias("close_price"),
                   F.sum("l_quantity").cast("bigint").alias("volume")))


def bar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trade dates of ``bars`` without building them.

    Every ``lineitem`` row makes (or joins) the bar of its supplier on its
    ship day, so the bars' dates are exactly the ship days: a one-column
    scan instead of the OHLCV aggregate.
    """
    li = read_table(spark, sf_dir, "lineitem", "l_shipdate")
    return li.select(F.to_date("l_shipdate").alias("trade_date"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company attributes: sector = region name, industry = nation name.

    nation (25 rows) and region (5 rows) are fixed-size TPC-H tables, so
    broadcasting them is bounded by construction.
    """
    s = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
             .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select(F.col("s_suppkey").alias("symbol"),
                     F.col("s_name").alias("company_name"),
                     F.col("r_name").alias("sector"),
                     F.col("n_name").alias("industry"),
                     F.lit("X").alias("exchange")))


def company_updates(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """A later snapshot of ``companies``: a third change sector, a third are
    unchanged, a third are absent, and a few new symbols appear."""
    c = base if base is not None else companies(spark, sf_dir)
    changed = (c.filter(F.pmod("symbol", F.lit(3)) == 0)
                .withColumn("sector", F.concat("sector", F.lit("_NEW"))))
    same = c.filter(F.pmod("symbol", F.lit(3)) == 1)
    new = (c.filter(F.col("symbol") < 5)
            .withColumn("symbol", F.col("symbol") + F.lit(1000000)))
    return changed.unionByName(same).unionByName(new)


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly EAV metrics per symbol: (symbol, report_period, metric_name, metric_value)."""
    li = read_table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    period = F.date_sub(F.add_months(F.trunc(F.to_date("l_shipdate"), "quarter"), 3), 1)
    wide = (li.groupBy(F.col("l_suppkey").alias("symbol"), period.alias("report_period"))
              .agg(F.sum("l_extendedprice").alias("marketCap"),
                   F.avg("l_quantity").alias("pe"),
                   F.max("l_extendedprice").alias("high52"),
                   F.min("l_extendedprice").alias("low52")))
    long = wide.unpivot(["symbol", "report_period"], list(FUNDAMENTAL_METRICS),
                        "metric_name", "metric_value")
    return long.withColumn("metric_value", rnd("metric_value", 2, TIE_EPS))


def headline_of(text: Column) -> Column:
    return headline_text(F.substring_index(text, "\n", 1))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document; documents repeat headlines across sources.

    sentiment_score = (quality - toxic) / 2 where a label exists, else NULL.
    The labels join is a shuffle join (labels grows with documents); headline,
    hash and summary are derived before it, so that a query without the body
    shuffles no texts.
    """
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    head = headline_of(F.col("text"))
    minutes = F.col("doc_id") * NEWS_MINUTES_PER_DOC          # a long: beyond an int, days carry it
    articles = (d.select(headline_hash(head).alias("content_hash"),
                     F.col("source").alias("symbol"),
                     head.alias("headline"),
                     F.col("lang").alias("source"),
                     (F.lit(NEWS_EPOCH).cast("timestamp_ntz")
                      + F.make_dt_interval(F.floor(minutes / 1440).cast("int"), F.lit(0), F.pmod(minutes, F.lit(1440)).cast("int"))).alias("published_at"),
                     F.concat(F.lit("https://news.invalid/"), F.col("doc_id").cast("string")).alias("url"),
                     F.col("text").alias("raw_body"),
                     F.nullif(F.trim(F.split_part(F.col("text"), F.lit("\n"), F.lit(2))), F.lit("")).alias("summary"),
                     F.col("doc_id")))
    score = ((F.col("quality") - F.col("toxic")) * F.lit(0.5)).cast("double").alias("sentiment_score")
    return articles.join(lab, "doc_id", "left").select(
        *[c for c in articles.columns if c != "doc_id"], score, "doc_id")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, embedding array<double>, label)."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return e.withColumn("embedding", F.col("embedding").cast("array<double>"))
