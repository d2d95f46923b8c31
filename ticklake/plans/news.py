"""News plans: 7-day sentiment view, incremental enrichment, feeds (D4, C2,
F1-F3, K12, K13, L9, L11)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.labels import doc_text, sentiment_label
from ticklake.functions.numeric import rnd
from ticklake.operators.ranking import running_total, top_n, top_n_per_key
from ticklake.sources.sinks import upsert_coalesce, upsert_overwrite

SENTIMENT_DAYS = 7
POSITIVE_CUT, NEGATIVE_CUT = 0.1, -0.1
DAILY_CALL_BUDGET = 80
CALLS_PER_ARTICLE = 2


def _ts(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (_dt.datetime, _dt.date)):
        x = x.isoformat(sep=" ") if isinstance(x, _dt.datetime) else x.isoformat()
    return F.lit(str(x)).cast("timestamp_ntz")


def article_order() -> list[Column]:
    """E11 order: newest first, NULL dates last, content_hash tie-break."""
    return [F.col("published_at").desc_nulls_last(), F.col("content_hash")]


def news_sentiment_7d(news: DataFrame, as_of, eps: float = 0.0) -> DataFrame:
    """Per symbol over [as_of - 7 days, ...): count, avg/min/max (4 dp),
    positive (> 0.1) / negative (< -0.1) counts, latest article and a label
    on the rounded average.

    The latest article comes from the same grouped aggregate as the
    statistics (``max_by`` over the E11 order), so there is one shuffle and
    no separate ranked copy to join back.
    """
    since = _ts(as_of) - F.make_dt_interval(F.lit(SENTIMENT_DAYS))
    n = news.filter((F.col("published_at") >= since) & F.col("sentiment_score").isNotNull())
    s = F.col("sentiment_score")
    agg = n.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("article_count_7d"),
        rnd(F.avg(s), 4, eps).alias("avg_sentiment_7d"),
        rnd(F.min(s), 4, eps).alias("min_sentiment_7d"),
        rnd(F.max(s), 4, eps).alias("max_sentiment_7d"),
        F.count_if(s > POSITIVE_CUT).alias("positive_count"),
        F.count_if(s < NEGATIVE_CUT).alias("negative_count"),
        F.min_by(F.struct("headline", "source", "published_at", "summary"),
                 F.struct(F.col("published_at").isNull(),
                          -F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                            F.col("published_at")),
                          F.col("content_hash"))).alias("_l"))
    return agg.select(
        "symbol", "article_count_7d", "avg_sentiment_7d", "min_sentiment_7d", "max_sentiment_7d",
        "positive_count", "negative_count",
        F.col("_l.headline").alias("latest_headline"), F.col("_l.source").alias("latest_source"),
        F.col("_l.published_at").alias("latest_published_at"), F.col("_l.summary").alias("latest_summary"),
        sentiment_label(F.col("avg_sentiment_7d")).alias("sentiment_label"))


def unenriched_news(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze articles not in silver, or in silver with a NULL summary
    or sentiment (left join + filter, one shuffle on content_hash)."""
    s = silver.select("content_hash", F.col("summary").alias("_s_summary"),
                      F.col("sentiment_score").alias("_s_score"), F.lit(True).alias("_in_s"))
    j = bronze.join(s, "content_hash", "left")
    keep = F.col("_in_s").isNull() | F.col("_s_summary").isNull() | F.col("_s_score").isNull()
    return j.filter(keep).drop("_s_summary", "_s_score", "_in_s")


def enrichment_batch(pending: DataFrame, per_symbol: int | None = None) -> DataFrame:
    """the pending articles of all symbols in one job; with
    ``per_symbol``, that many of the newest of each."""
    if per_symbol is None:
        return pending
    return top_n_per_key(pending, ["symbol"], article_order(), per_symbol)


def budgeted_batch(pending: DataFrame, calls_spent, limit: int = DAILY_CALL_BUDGET,
                   cost: int | str = CALLS_PER_ARTICLE) -> DataFrame:
    """The articles (newest first) that the remaining daily call budget
    pays for; the cap is the feature.  One cost for all: the first
    floor((limit - spent) / cost).  A column of costs: the articles up to
    which the costs sum to no more than what is left."""
    left = max(0, limit - int(calls_spent))
    if isinstance(cost, str):
        return running_total(pending, article_order(), cost, "_spent").filter(F.col("_spent") <= left).drop("_spent")
    return top_n(pending, article_order(), left // cost)


def news_feed(silver: DataFrame, rows: int | None = None) -> DataFrame:
    """the articles with a publication time (the newest ``rows``)."""
    cols = ["content_hash", "symbol", "headline", "source", "published_at", "url", "summary",
            "sentiment_score"]
    p = silver.filter(F.col("published_at").isNotNull()).select(*cols)
    return p if rows is None else top_n(p, article_order(), rows)


def refresh_news_feed(feed: DataFrame, silver: DataFrame, rows: int | None = None) -> DataFrame:
    """F1 + A10: add new articles to the feed; those in it already get the
    new summary and sentiment and keep everything else."""
    new = news_feed(silver, rows)
    return upsert_overwrite(feed, new, ["content_hash"], ["summary", "sentiment_score"])


def embedding_batch(silver: DataFrame, rows: int | None = None, newest_first: bool = False) -> DataFrame:
    """articles never embedded (embedding_updated_at NULL), oldest first
    (or newest first); with ``rows``, a batch of that many."""
    p = silver.filter(F.col("embedding_updated_at").isNull())
    if rows is None:
        return p
    o = F.col("published_at").desc_nulls_last() if newest_first else F.col("published_at").asc_nulls_last()
    return top_n(p, [o, F.col("content_hash")], rows)


def mark_processed(silver: DataFrame, done: DataFrame, at) -> DataFrame:
    """Set embedding_updated_at for processed ids (A10 with one column)."""
    d = done.select("content_hash").distinct().withColumn("embedding_updated_at", _ts(at))
    return upsert_overwrite(silver, d, ["content_hash"], ["embedding_updated_at"]).select(*silver.columns)


def _vector_rows(articles: DataFrame, id_col: str) -> DataFrame:
    md = F.struct(F.coalesce(F.col("symbol").cast("string"), F.lit("")).alias("ticker"),
                  F.coalesce(F.col("url"), F.lit("")).alias("url"),
                  F.coalesce(F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("")).alias("published_at"),
                  F.coalesce(F.col("sentiment_score"), F.lit(0.0)).alias("sentiment_score"))
    return articles.select(F.col(id_col).alias("id"), doc_text("headline", "summary").alias("document"),
                           md.alias("metadata"), F.col("doc_id"))


def vector_records(articles: DataFrame, vectors: DataFrame, id_col: str = "content_hash") -> DataFrame:
    """(id, document text = H4, metadata with '' / 0.0 defaults, vector)
    of every article; without a vector it is ``pending`` (a left join: none is lost)."""
    rows = _vector_rows(articles, id_col).join(vectors.select("doc_id", "embedding"), "doc_id", "left")
    return rows.drop("doc_id").withColumn("pending", F.col("embedding").isNull())


def vector_upsert(store: DataFrame, records: DataFrame) -> DataFrame:
    """Keyed upsert of (id, document, metadata, embedding, pending)."""
    return upsert_overwrite(store, records, ["id"], ["document", "metadata", "embedding", "pending"])


def scorer_input(pending: DataFrame) -> DataFrame:
    """(content_hash, text) that goes to the models: the body, else the headline."""
    text = F.coalesce(F.nullif(F.col("raw_body"), F.lit("")), F.col("headline"))
    return pending.select("content_hash", "doc_id", text.alias("text"))


def enrich_news(bronze: DataFrame, silver: DataFrame, scores: DataFrame,
                per_symbol: int | None = None) -> DataFrame:
    """Incremental bronze -> silver enrichment.

    Pending = C2; batch = F2; model output comes in as ``scores``
    (content_hash, summary, sentiment_score), made from ``scorer_input`` of the
    same articles; silver is updated with A11 (new value only when non-NULL)."""
    batch = enrichment_batch(unenriched_news(bronze, silver), per_symbol).drop("summary", "sentiment_score")
    sc = scores.select("content_hash", "summary", "sentiment_score")
    scored = batch.join(sc, "content_hash", "left").select(
        "content_hash", "symbol", "headline", "source", "published_at", "url", "summary", "sentiment_score")
    return upsert_coalesce(silver, scored, ["content_hash"], ["summary", "sentiment_score"])
