"""Text operators (L1-L5): dedupe by content hash, signed sentiment,
fixed-size chunking, chunk recombination, length-based text fallback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.functions.clean import strip
from ticklake.functions.labels import headline_hash, headline_text

CHUNK_CHARS = 4000          # fixed: summariser chunk size
MIN_TEXT_CHARS = 200        # fixed: extraction acceptance threshold
# Sentiment label -> sign.
LABEL_SIGN = {"positive": 1.0, "negative": -1.0, "neutral": 0.0}


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order`` per key (one grouped aggregate,
    partial before the shuffle)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def dedupe_news(articles: DataFrame, headline: str = "headline",
                order: Sequence[str] = ("published_at", "doc_id")) -> DataFrame:
    """L1: one article per SHA-256 of the headline without outer white space, across sources
    and symbols; the first (smallest ``order``) wins.  The headline is stored as it is hashed;
    an article without one has no key and is left out."""
    h = articles.filter(F.col(headline).isNotNull()).withColumns(
        {"content_hash": headline_hash(headline), headline: headline_text(headline)})
    return first_per_key(h, ["content_hash"], list(order))


def signed_sentiment(scores: Column | str) -> Column:
    """L2: ``array<struct<label, score>>`` -> sign(label of the highest score)
    * score, 4 dp; the first of equal scores wins; empty or NULL -> NULL."""
    arr = F.col(scores) if isinstance(scores, str) else scores
    best = F.reduce(arr, arr[0], lambda acc, x: F.when(x["score"] > acc["score"], x).otherwise(acc))
    lab = F.lower(best["label"])
    sign = F.lit(0.0)
    for name, s in LABEL_SIGN.items():
        sign = F.when(lab == name, F.lit(s)).otherwise(sign)
    return F.when(F.size(arr) > 0, F.round(sign * best["score"].cast("double"), 4))


def chunk_text(df: DataFrame, text: str = "text", n: int = CHUNK_CHARS) -> DataFrame:
    """L3: whole text -> (chunk_index, chunk) of ``n`` characters each.

    ``sequence`` + ``posexplode`` keeps the work per row inside the task that
    holds the document; no shuffle.
    """
    t = F.col(text)
    k = F.greatest(F.lit(0), F.ceil(F.length(t) / F.lit(n)).cast("int") - 1)
    starts = F.when(F.length(t) > 0, F.sequence(F.lit(0), k))
    rest = [c for c in df.columns if c != text]
    return (df.select(*rest, t, F.posexplode(starts).alias("chunk_index", "_i"))
              .select(*rest, "chunk_index", F.substring(t, F.col("_i") * n + 1, n).alias("chunk")))


def recombine_chunks(chunks: DataFrame, key: Sequence[str], out: str = "summary",
                     idx: str = "chunk_index", part: str = "chunk_summary",
                     raw_len: str | None = "chunk_chars") -> DataFrame:
    """L4: non-empty chunk outputs joined by one space in chunk order, plus
    the raw text length.  A group is one document, bounded by its length."""
    key = list(key)
    aggs = [F.array_join(
        F.transform(F.filter(F.array_sort(F.collect_list(F.struct(F.col(idx), F.col(part)))),
                             lambda s: F.coalesce(F.length(s[part]) > 0, F.lit(False))),
                    lambda s: s[part]), " ").alias(out)]
    if raw_len:
        aggs.append(F.sum(raw_len).cast("bigint").alias("raw_text_length"))
    return chunks.groupBy(*key).agg(*aggs)


def text_fallback(df: DataFrame, primary: str, secondary: str,
                  min_chars: int = MIN_TEXT_CHARS) -> DataFrame:
    """Primary text if its stripped length >= 200, else the secondary if
    >= 200, else rejected.  Adds ``text``, ``method`` and ``accepted``."""
    p, s = strip(F.coalesce(F.col(primary), F.lit(""))), strip(F.coalesce(F.col(secondary), F.lit("")))
    method = (F.when(F.length(p) >= min_chars, F.lit("primary"))
               .when(F.length(s) >= min_chars, F.lit("fallback")).otherwise(F.lit("rejected")))
    txt = F.when(F.length(p) >= min_chars, p).when(F.length(s) >= min_chars, s)
    return df.withColumn("text", txt).withColumn("method", method).withColumn("accepted", txt.isNotNull())
