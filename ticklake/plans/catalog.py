"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Each query reads the given tables (through ``ticklake.sources.fixtures``)
and runs over the whole of them.  Queries use the tie-shifted rounding
(``TIE_EPS``) so that their results can be compared value for value with
an independent SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticklake.functions.numeric import TIE_EPS
from ticklake.operators import indicators as ind
from ticklake.plans import views
from ticklake.sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def clean_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.clean_bars(fx.bars(spark, sf_dir))


def prices(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Silver prices: bars -> B5 clean -> E12 enrich; only ``columns`` if any
    are named (the grouped map and the windows they do not need fall away)."""
    return ind.enrich_bars(clean_bars(spark, sf_dir), eps=TIE_EPS, columns=columns or None)


def recent_clean_dates(spark: SparkSession, sf_dir: str, n: int = views.RECENT_DATES) -> DataFrame:
    """The n newest dates that carry a clean bar (the calendar of C3),
    without a second full OHLCV aggregate.

    Candidates are the n newest ship dates (a one-column scan).  The clean
    bars of just those days are built from the rows shipped on them (the
    date filter reaches the Parquet scan; a day's bars only hold that day's
    rows, so they equal the full bars).  If every candidate has a clean bar,
    the candidates are the answer; otherwise the full calendar is used.
    Exact either way; at most n dates reach the driver.
    """
    from ticklake.operators.ranking import recent_dates
    from ticklake.sources.tables import read_table
    lo = recent_dates(fx.bar_dates(spark, sf_dir), n).agg(F.min("trade_date")).first()[0]
    if lo is not None:
        li = read_table(spark, sf_dir, "lineitem").filter(
            F.col("l_shipdate") >= F.lit(lo).cast("timestamp_ntz"))
        got = [r[0] for r in ind.clean_bars(fx.bars(spark, sf_dir, lineitem=li))
               .select("trade_date").distinct().collect()]
        if len(got) == n:
            return spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in got])).alias("trade_date"))
    return clean_bars(spark, sf_dir)


def price_facts_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver columns the star facts carry (bars + E1 daily return).

    Facts and integrity checks need no indicator beyond the return, so they
    skip the grouped-map step entirely.
    """
    return ind.with_daily_return(clean_bars(spark, sf_dir), eps=TIE_EPS)


@query("daily_bars")
def q_daily_bars(spark, sf_dir):
    return fx.bars(spark, sf_dir)


@query("enriched_prices")
def q_enriched_prices(spark, sf_dir):
    return prices(spark, sf_dir)


PULSE_COLUMNS = ("trade_date", "volume", "daily_return", "is_outlier", "rsi_14")


@query("market_pulse")
def q_market_pulse(spark, sf_dir):
    return views.market_pulse(prices(spark, sf_dir, *PULSE_COLUMNS), eps=TIE_EPS)


# ------------------------------------------------------------------ shared inputs
from pyspark.sql import functions as F  # noqa: E402

from ticklake.operators import dims, quality  # noqa: E402
from ticklake.plans import earnings  # noqa: E402

INITIAL_LOAD = "1995-01-01"    # fixed: first dimension load
UPDATE_LOAD = "1998-01-01"     # fixed: second dimension load


def dim_companies(spark, sf_dir, stored: bool = False):
    """K1 applied twice: initial load, then the later company snapshot.

    The dimension is a stored table in the pipeline (one row per company
    version); with ``stored`` it is written to the shared folder and read
    back, for queries that read it several times."""
    from ticklake.session import materialize
    comp = fx.companies(spark, sf_dir)
    d0 = dims.scd2_upsert(dims.empty_dim(spark), comp, INITIAL_LOAD)
    d1 = dims.scd2_upsert(d0, fx.company_updates(spark, sf_dir, comp), UPDATE_LOAD)
    return materialize(d1, "dim_companies") if stored else d1


def dim_date(spark, sf_dir):
    """K2 over the span of the bars (a stored table in the pipeline: checkpointed)."""
    from ticklake.session import materialize
    return materialize(dims.dim_date_from(quality.date_bounds(fx.bar_dates(spark, sf_dir))), "dim_date")


def fact_prices(spark, sf_dir):
    return dims.load_fact_prices(price_facts_input(spark, sf_dir), dim_companies(spark, sf_dir))


@query("latest_bars")
def q_latest_bars(spark, sf_dir):
    return views.latest_bars(prices(spark, sf_dir))


@query("rsi_simple")
def q_rsi_simple(spark, sf_dir):
    return ind.rsi_simple(ind.clean_bars(fx.bars(spark, sf_dir)), eps=TIE_EPS)


@query("sector_momentum")
def q_sector_momentum(spark, sf_dir):
    p = prices(spark, sf_dir, "symbol", "trade_date", "close_price", "volume", "daily_return", "sma_20", "sma_50",
               "rsi_14", "normalised_close")
    return views.sector_momentum(p, dim_companies(spark, sf_dir), eps=TIE_EPS,
                                 calendar=recent_clean_dates(spark, sf_dir))


@query("portfolio_risk")
def q_portfolio_risk(spark, sf_dir):
    return views.portfolio_risk(prices(spark, sf_dir, "symbol", "trade_date", "log_return"), eps=TIE_EPS, calendar=recent_clean_dates(spark, sf_dir))


@query("market_proxy")
def q_market_proxy(spark, sf_dir):
    m = views.market_proxy(prices(spark, sf_dir, "trade_date", "log_return"), n_dates=None)
    return m.select("trade_date", F.round(F.col("market_log_return") + TIE_EPS, 8).alias("market_log_return"))


@query("return_moments")
def q_return_moments(spark, sf_dir):
    return views.return_moments(prices(spark, sf_dir, "symbol", "daily_return"), eps=TIE_EPS)


@query("recent_breadth")
def q_recent_breadth(spark, sf_dir):
    from ticklake.functions.labels import breadth_label
    p = views.recent_breadth(views.market_pulse(prices(spark, sf_dir, *PULSE_COLUMNS), eps=TIE_EPS), 10)
    return p.select("trade_date", "advancing", "declining", "total_symbols", "advance_pct",
                    breadth_label("advance_pct").alias("breadth"))


@query("dim_companies")
def q_dim_companies(spark, sf_dir):
    return dim_companies(spark, sf_dir).drop("company_key")


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return dim_date(spark, sf_dir)


@query("fact_prices")
def q_fact_prices(spark, sf_dir):
    return fact_prices(spark, sf_dir).drop("price_key", "company_key")


@query("integrity_report")
def q_integrity_report(spark, sf_dir):
    """K8 over the star schema.  Silver is a stored table in the pipeline:
    it is written once here and both the facts and the coverage check read it."""
    from ticklake.session import materialize
    silver = materialize(price_facts_input(spark, sf_dir), "silver")
    d = dim_companies(spark, sf_dir, stored=True)
    return quality.integrity_report(dims.load_fact_prices(silver, d), dims.with_unknown_member(d),
                                    dim_date(spark, sf_dir), silver)


@query("table_health")
def q_table_health(spark, sf_dir):
    from ticklake.session import materialize
    silver = materialize(price_facts_input(spark, sf_dir), "silver")
    d = dim_companies(spark, sf_dir, stored=True)
    return quality.table_health({
        "gold.dim_date": dim_date(spark, sf_dir),
        "gold.dim_companies": d,
        "gold.fact_prices": dims.load_fact_prices(silver, d),
        "silver.prices": silver,
        "silver.news": fx.news(spark, sf_dir)})


@query("price_contract")
def q_price_contract(spark, sf_dir):
    p = prices(spark, sf_dir, "symbol", "trade_date", "close_price", "volume", "rsi_14", "normalised_close")
    cur = dim_companies(spark, sf_dir).filter("is_current")
    return quality.contract_report(
        p, "silver.prices", not_null=["symbol", "trade_date", "close_price"],
        unique=[["symbol", "trade_date"]],
        checks={"volume_non_negative": F.col("volume") >= 0,
                "rsi_in_range": F.col("rsi_14").between(0, 100),
                "normalised_in_unit": F.col("normalised_close").between(0, 1)},
        foreign_keys=[("symbol", cur, "symbol")])


@query("fact_prices_reload")
def q_fact_prices_reload(spark, sf_dir):
    """K14 on reload (A9): facts up to a day are stored; a later load of the net-price
    feed's whole history adds the days after it and changes none before."""
    d = dim_companies(spark, sf_dir)
    net = ind.with_daily_return(ind.clean_bars(fx.bars(spark, sf_dir, net=True)), eps=TIE_EPS)
    stored = fact_prices(spark, sf_dir).filter(F.col("trade_date") <= F.lit(EARLIER).cast("date"))
    out = dims.reload_facts(stored, dims.load_fact_prices(net, d))
    return out.select("date_key", "symbol", "company_version", "close_price")


@query("bar_directions")
def q_bar_directions(spark, sf_dir):
    """H15 over every bar: its candle (close below open) and its return."""
    b = price_facts_input(spark, sf_dir)
    d = lb.bar_direction("open_price", "close_price", "daily_return")
    return b.select("symbol", "trade_date", d["candle_down"].alias("candle_down"), d["return_up"].alias("return_up"))


@query("capped_bars")
def q_capped_bars(spark, sf_dir):
    """A read of the bars, capped; the first in order of symbol and day."""
    return cl.capped_read(fx.bars(spark, sf_dir), "symbol", "trade_date")


@query("date_bounds")
def q_date_bounds(spark, sf_dir):
    return quality.date_bounds(clean_bars(spark, sf_dir))   # silver has exactly the clean bars' rows


@query("fundamentals_eav")
def q_fundamentals_eav(spark, sf_dir):
    return fx.fundamentals(spark, sf_dir)


@query("promote_fundamentals")
def q_promote_fundamentals(spark, sf_dir):
    return dims.promote_fundamentals(fx.fundamentals(spark, sf_dir))


@query("fact_fundamentals")
def q_fact_fundamentals(spark, sf_dir):
    f = dims.load_fact_fundamentals(fx.fundamentals(spark, sf_dir), dim_companies(spark, sf_dir))
    return f.drop("company_key")


SUMMARY_BARS = ("symbol", "trade_date", "close_price", "daily_return", "normalised_close", "sma_20", "sma_50", "rsi_14")


@query("stock_summary")
def q_stock_summary(spark, sf_dir):
    latest = views.latest_bars(prices(spark, sf_dir, *SUMMARY_BARS))
    fund = dims.promote_fundamentals(fx.fundamentals(spark, sf_dir))
    return earnings.stock_summary(latest, fund)


@query("latest_metrics")
def q_latest_metrics(spark, sf_dir):
    return earnings.latest_metrics(fx.fundamentals(spark, sf_dir))


@query("earnings_report")
def q_earnings_report(spark, sf_dir):
    return earnings.earnings_report(fx.fundamentals(spark, sf_dir))


# ------------------------------------------------------------------ news, text, vectors
from ticklake.functions import clean as cl  # noqa: E402
from ticklake.functions import labels as lb  # noqa: E402
from ticklake.operators import text as tx  # noqa: E402
from ticklake.operators import vectors as vx  # noqa: E402
from ticklake.plans import live  # noqa: E402
from ticklake.plans import news as nw  # noqa: E402
from ticklake.sources import pricelog  # noqa: E402
from ticklake.sources import prices as src  # noqa: E402
from ticklake.sources import sinks  # noqa: E402
from ticklake.sources.versioned import VersionedTable  # noqa: E402
from ticklake.streaming import ingest  # noqa: E402

BUDGET_SPENT = 10          # calls already spent today in the budget example


def scratch_folder(spark, name: str) -> str:
    """A new folder under the shared checkpoint folder."""
    import uuid
    from ticklake.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def newest_article(news_df):
    """as_of for the news views: the newest publication time in the data
    (one scalar; a view parameter, not data passed through the driver)."""
    return news_df.agg(F.max("published_at")).first()[0]


def before_midpoint(news_df):
    """Published in the first half of the data's time span."""
    b = news_df.agg(F.min("published_at").alias("lo"), F.max("published_at").alias("hi")).first()
    return F.col("published_at") < nw._ts(b["lo"] + (b["hi"] - b["lo"]) / 2)


def articles(spark, sf_dir):
    """The news without bodies: nothing that follows shuffles or sorts texts."""
    return fx.news(spark, sf_dir).drop("raw_body")


def silver_news(spark, sf_dir):
    """Silver news before enrichment: one row per content hash, no model output."""
    d = tx.dedupe_news(articles(spark, sf_dir))
    return d.select("content_hash", "symbol", "headline", "source", "published_at", "url",
                    F.lit(None).cast("string").alias("summary"),
                    F.lit(None).cast("double").alias("sentiment_score"),
                    F.lit(None).cast("timestamp_ntz").alias("embedding_updated_at"))


@query("news_sentiment_7d")
def q_news_sentiment_7d(spark, sf_dir):
    n = fx.news(spark, sf_dir)
    return nw.news_sentiment_7d(n, newest_article(n), eps=TIE_EPS)


@query("news_dedupe")
def q_news_dedupe(spark, sf_dir):
    return tx.dedupe_news(articles(spark, sf_dir))


@query("unenriched_news")
def q_unenriched_news(spark, sf_dir):
    return nw.unenriched_news(articles(spark, sf_dir), silver_news(spark, sf_dir))


@query("enrichment_batch")
def q_enrichment_batch(spark, sf_dir):
    pending = nw.unenriched_news(articles(spark, sf_dir), silver_news(spark, sf_dir))
    return nw.enrichment_batch(pending).select("content_hash", "symbol", "doc_id", "published_at")


@query("budgeted_batch")
def q_budgeted_batch(spark, sf_dir):
    pending = nw.unenriched_news(articles(spark, sf_dir), silver_news(spark, sf_dir))
    return nw.budgeted_batch(pending, BUDGET_SPENT).select("content_hash", "symbol", "doc_id", "published_at")


@query("budgeted_batch_costs")
def q_budgeted_batch_costs(spark, sf_dir):
    """K12 with a cost of its own for each article: one call for a short headline, more for a long one."""
    pending = nw.unenriched_news(articles(spark, sf_dir), silver_news(spark, sf_dir))
    pending = pending.withColumn("calls", 1 + F.floor(F.length("headline") / 40))
    return nw.budgeted_batch(pending, BUDGET_SPENT, cost="calls").select("content_hash", "doc_id", "calls")


FEED_ROWS, SYMBOL_ROWS, BATCH_ROWS = 200, 20, 100     # the limits of F1, F2 and F3 in the queries below


@query("newest_feed")
def q_newest_feed(spark, sf_dir):
    """F1 with its limit: the newest articles."""
    return nw.news_feed(tx.dedupe_news(articles(spark, sf_dir)), FEED_ROWS)


@query("enrichment_batch_limited")
def q_enrichment_batch_limited(spark, sf_dir):
    """F2 with its limit: the newest pending articles of each symbol."""
    pending = nw.unenriched_news(articles(spark, sf_dir), silver_news(spark, sf_dir))
    return nw.enrichment_batch(pending, SYMBOL_ROWS).select("content_hash", "symbol", "doc_id")


@query("embedding_batches")
def q_embedding_batches(spark, sf_dir):
    """F3 with its limit, both ways round: the oldest and the newest articles never embedded."""
    s = silver_news(spark, sf_dir)
    part = lambda newest: nw.embedding_batch(s, BATCH_ROWS, newest).select(
        F.lit("newest" if newest else "oldest").alias("batch"), "content_hash")
    return part(False).unionByName(part(True))


@query("scorer_input")
def q_scorer_input(spark, sf_dir):
    """The text of every pending article that goes to the models."""
    n = fx.news(spark, sf_dir)
    bodiless = n.withColumn("raw_body", F.when(F.pmod("doc_id", F.lit(4)) != 0, F.col("raw_body")).otherwise(F.lit("")))
    pending = nw.unenriched_news(bodiless, silver_news(spark, sf_dir))
    return nw.scorer_input(pending).select("content_hash", "doc_id", F.sha2("text", 256).alias("text_hash"))


@query("news_feed")
def q_news_feed(spark, sf_dir):
    n = tx.dedupe_news(articles(spark, sf_dir))
    return nw.news_feed(n)


@query("enrich_news")
def q_enrich_news(spark, sf_dir):
    scores = tx.dedupe_news(articles(spark, sf_dir)).select("content_hash", "summary", "sentiment_score")
    return nw.enrich_news(fx.news(spark, sf_dir), silver_news(spark, sf_dir), scores)


@query("mark_processed")
def q_mark_processed(spark, sf_dir):
    s = silver_news(spark, sf_dir)
    done = nw.embedding_batch(s)
    return nw.mark_processed(s, done, newest_article(fx.news(spark, sf_dir)))


@query("news_insert_ignore")
def q_news_insert_ignore(spark, sf_dir):
    """yesterday's silver (articles published before the midpoint of the
    data's time span) plus today's arrivals; existing hashes are kept."""
    n = fx.news(spark, sf_dir).drop("raw_body")
    old = tx.dedupe_news(n.filter(before_midpoint(n)))
    return sinks.insert_ignore(old, n, ["content_hash"], ["published_at", "doc_id"])


@query("signed_sentiment")
def q_signed_sentiment(spark, sf_dir):
    from ticklake.sources.tables import read_table
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    arr = F.array(F.struct(F.lit("positive").alias("label"), F.col("quality").cast("double").alias("score")),
                  F.struct(F.lit("negative").alias("label"), F.col("toxic").cast("double").alias("score")),
                  F.struct(F.lit("neutral").alias("label"), F.lit(0.5).alias("score")))
    return lab.select("doc_id", tx.signed_sentiment(arr).alias("sentiment_score"))


@query("keyword_sentiment")
def q_keyword_sentiment(spark, sf_dir):
    from ticklake.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", lb.keyword_sentiment("text").alias("keyword_score"),
                    lb.outlook_label(lb.keyword_sentiment("text")).alias("outlook"))


def doc_chunks(spark, sf_dir):
    from ticklake.sources.tables import read_table
    return tx.chunk_text(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query("chunk_text")
def q_chunk_text(spark, sf_dir):
    return doc_chunks(spark, sf_dir)


@query("recombine_chunks")
def q_recombine_chunks(spark, sf_dir):
    """L4 over whole texts: the per-chunk output is the chunk itself."""
    c = doc_chunks(spark, sf_dir)
    return tx.recombine_chunks(c.withColumn("chunk_chars", F.length("chunk")), ["doc_id"], part="chunk")


@query("text_fallback")
def q_text_fallback(spark, sf_dir):
    from ticklake.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    d = d.select("doc_id",
                 F.when(F.pmod("doc_id", F.lit(3)) == 0, F.lit("")).otherwise(F.col("text")).alias("primary"),
                 F.when(F.pmod("doc_id", F.lit(2)) == 0, F.lit("")).otherwise(F.col("text")).alias("secondary"))
    out = tx.text_fallback(d, "primary", "secondary")
    return out.select("doc_id", "method", "accepted", F.length("text").alias("text_chars"))


def vector_topk(spark, sf_dir):
    v = fx.vectors(spark, sf_dir)
    return vx.cosine_topk(v.withColumnRenamed("vec_id", "query_id"), v.withColumnRenamed("vec_id", "doc_id"),
                          vx.TOP_K, exclude_self=True, eps=TIE_EPS)


@query("cosine_topk")
def q_cosine_topk(spark, sf_dir):
    return vector_topk(spark, sf_dir)


@query("similarity_guard")
def q_similarity_guard(spark, sf_dir):
    v = fx.vectors(spark, sf_dir).select(F.col("vec_id").alias("query_id"))
    g = vx.similarity_guard(vector_topk(spark, sf_dir), v)
    return g.groupBy("query_id").agg(F.count("doc_id").alias("n_accepted"),
                                     F.max("similarity").alias("best_similarity"))


@query("rag_context")
def q_rag_context(spark, sf_dir):
    v = fx.vectors(spark, sf_dir).select(F.col("vec_id").alias("query_id"))
    g = vx.similarity_guard(vector_topk(spark, sf_dir), v, threshold=0.2)
    n = fx.news(spark, sf_dir)
    meta = n.select(F.col("doc_id"), lb.doc_text("headline", "summary").alias("doc_text"), "url",
                    "published_at", F.col("symbol").alias("ticker"))
    ctx = vx.assemble_context(g, meta)
    return ctx.select("query_id", "n_sources", "status", "context",
                      F.array_join(F.transform("sources", lambda s: s["url"]), " ").alias("source_urls"))


@query("embedding_compat")
def q_embedding_compat(spark, sf_dir):
    v = fx.vectors(spark, sf_dir)
    meta = v.agg(F.lit("minilm").alias("model_name"), F.max(F.size("embedding")).alias("dimension"))
    return quality.embedding_compat(v, meta, "minilm", 64)


# ------------------------------------------------------------------ ingest, clean, live
def parsed_messages(spark, sf_dir):
    return ingest.parse_messages(src.messages(spark, sf_dir))


BRONZE_OUT = ("ticker", "trade_date", "open", "high", "low", "close", "adj_close", "volume", "year", "month")


@query("bronze_valid")
def q_bronze_valid(spark, sf_dir):
    valid, _ = cl.split_valid_dead(parsed_messages(spark, sf_dir))
    return valid.select(*BRONZE_OUT)


@query("dead_letters")
def q_dead_letters(spark, sf_dir):
    _, dead = cl.split_valid_dead(parsed_messages(spark, sf_dir))
    return dead.select("ticker", "trade_date", "close")


def spool_messages(spark, sf_dir, files: int | None = None):
    """Write the message fixture as text files under the shared checkpoint
    folder (the file-source form of the price topic); returns the folder."""
    base = scratch_folder(spark, "stream")
    m = src.messages(spark, sf_dir)
    m = m.repartition(files, "event_id") if files else m
    m.select("value").write.mode("overwrite").text(base + "/in")
    return base


@query("stream_bronze")
def q_stream_bronze(spark, sf_dir):
    """The messages as text files -> availableNow stream -> bronze."""
    base = spool_messages(spark, sf_dir)
    ingest.bronze_backfill(spark, {"format": "text", "path": base + "/in", "max_files_per_trigger": 4},
                           base + "/bronze", base + "/dead", base + "/ckpt")
    bronze = ingest.read_committed(spark, base + "/bronze", ingest.commits_of(base + "/bronze"))
    return bronze.select(*BRONZE_OUT)


class SinkFailure(RuntimeError):
    """The failure that a query injects between two sinks."""


def interrupted_ingest(spark, sf_dir):
    """I4: bronze ingest in several micro-batches; the second fails once its
    bronze rows are written and its dead letters are not; then a restart."""
    base = spool_messages(spark, sf_dir, files=6)
    source, failed = {"format": "text", "path": base + "/in", "max_files_per_trigger": 2}, []

    def fail_once(sink, batch_id):
        if sink == "bronze" and batch_id == 1 and not failed:
            failed.append(batch_id)
            raise SinkFailure(f"after {sink}")

    args = (source, base + "/bronze", base + "/dead", base + "/ckpt", {"availableNow": True})
    try:
        ingest.bronze_ingest(spark, *args, after_sink=fail_once).awaitTermination()
    except Exception:  # noqa: BLE001 - the stream wraps what its function raised
        if not failed:
            raise
    ingest.bronze_ingest(spark, *args, after_sink=fail_once).awaitTermination()
    return base


@query("stream_exactly_once")
def q_stream_exactly_once(spark, sf_dir):
    """Both sinks after a failure between them and a restart."""
    base = interrupted_ingest(spark, sf_dir)
    part = lambda name: ingest.read_committed(
        spark, f"{base}/{name}", ingest.commits_of(base + "/bronze")).select(F.lit(name).alias("sink"), "ticker",
                                                                             "trade_date", "close")
    return part("bronze").unionByName(part("dead"))


@query("stream_audit")
def q_stream_audit(spark, sf_dir):
    """K10 for streams: rows per sink and status over all batches, the failed attempt included."""
    base = interrupted_ingest(spark, sf_dir)
    audit = ingest.stream_audit(spark, ingest.commits_of(base + "/bronze"))
    return audit.groupBy("status", "sink").agg(F.sum("rows").alias("rows"))


LATE_SLICES = 4            # time slices in which the messages arrive
REPLAYED = 7               # every so many-th event is sent once more at the end


@query("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """I3 over several micro-batches: the messages arrive in time order, then
    some once more.  A replay of the last day is a duplicate, an older one is
    late and lands in the dead letters."""
    base = scratch_folder(spark, "late")
    m = src.messages(spark, sf_dir, keep=("ts",))
    bounds = m.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    width = (bounds["hi"] - bounds["lo"]) / LATE_SLICES
    at = lambda k: F.lit(bounds["lo"] + width * k)

    def arrive(part):
        # a slice is a batch, in as many files as tasks wrote it: the stream takes what lies there and goes on later
        part.select("value").write.mode("append").text(base + "/in")
        ingest.dedupe_ingest(spark, {"format": "text", "path": base + "/in"}, base + "/kept", base + "/dead",
                             base + "/ckpt", trigger={"availableNow": True}).awaitTermination()

    for k in range(LATE_SLICES):
        arrive(m.filter((F.col("ts") >= at(k)) & ((F.col("ts") < at(k + 1)) if k + 1 < LATE_SLICES else F.lit(True))))
    arrive(m.filter(F.pmod("event_id", F.lit(REPLAYED)) == 0))
    kept = spark.read.parquet(base + "/kept").select(F.lit("kept").alias("verdict"), "ticker", "trade_date", "close")
    dead = spark.read.parquet(base + "/dead").select(F.col("reason").alias("verdict"), "ticker", "trade_date", "close")
    counts = ingest.read_commits(spark, ingest.commits_of(base + "/kept")).groupBy(
        F.concat(F.lit("rows "), "sink").alias("verdict")).agg(F.sum("rows").cast("double").alias("close"))
    return kept.unionByName(dead).unionByName(counts, allowMissingColumns=True)


@query("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """Stateful de-duplication of (ticker, trade_date) in a bounded stream."""
    base = spool_messages(spark, sf_dir)
    ingest.dedupe_stream_to(spark, {"format": "text", "path": base + "/in"}, base + "/dedup", base + "/ckpt")
    # which of the repeated messages stays depends on arrival: the keys do not
    return spark.read.parquet(base + "/dedup").select("ticker", "trade_date")


LOG_PARTITIONS = 4


@query("log_offsets")
def q_log_offsets(spark, sf_dir):
    """A1, A2 over a log with offsets: a stream reads the first third of the
    messages; what it has read and, unread, partition 0 of the second third
    are dropped; the stream goes on from its checkpoint, and a batch reads
    what is left."""
    base = scratch_folder(spark, "log")
    m, options = src.messages(spark, sf_dir), {"format": "log", "path": base + "/log"}

    def append(k):
        pricelog.append_log(m.filter(F.pmod("event_id", F.lit(3)) == k).withColumn("key", F.col("event_id")), base + "/log",
                            F.pmod("event_id", F.lit(LOG_PARTITIONS)), LOG_PARTITIONS)

    def run():
        (src.read_price_stream(spark, options).writeStream.format("parquet").option("path", base + "/out")
         .option("checkpointLocation", base + "/ck").trigger(availableNow=True).start().awaitTermination())

    append(0)
    run()
    read = {p: s[-1][1] for p, s in pricelog.segments(base + "/log").items()}
    append(1)
    pricelog.retain_log(base + "/log", read | {0: pricelog.segments(base + "/log")[0][-1][1]})
    append(2)
    run()
    part = lambda name, df: df.select(F.lit(name).alias("reader"), F.col("key").cast("long").alias("event_id"),
                                      "partition", F.length("value").alias("chars"))
    return part("stream", spark.read.parquet(base + "/out")).unionByName(part("batch", src.read_price_batch(spark, options)))


@query("market_hours")
def q_market_hours(spark, sf_dir):
    from ticklake.sources.tables import read_table
    e = read_table(spark, sf_dir, "events", "event_id", "ts")
    return e.filter(cl.in_market_hours("ts"))


@query("statement_guard")
def q_statement_guard(spark, sf_dir):
    from ticklake.sources.tables import read_table
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name")
    k = F.pmod("p_partkey", F.lit(4))
    stmt = (F.when(k == 0, F.concat(F.lit("SELECT * FROM "), "p_name"))
             .when(k == 1, F.concat(F.lit("drop table "), "p_name"))
             .when(k == 2, F.concat(F.lit("SELECT updated -- "), "p_name"))
             .otherwise(F.concat(F.lit("WITH "), "p_name")))
    return cl.classify_statements(p.select("p_partkey", stmt.alias("statement")))


@query("quote_metrics")
def q_quote_metrics(spark, sf_dir):
    last = views.latest_bars(prices(spark, sf_dir, "symbol", "trade_date", "open_price", "low_price", "close_price",
                                    "volume", "daily_return", "high_52w", "low_52w", "normalised_close"))
    dash = F.pmod("symbol", F.lit(5)) == 0
    text = lambda c: c.cast("string")
    doc = F.to_json(F.struct(
        F.struct(F.when(dash, F.lit("-")).otherwise(text(F.col("close_price") / 10)).alias("pe"),
                 text(F.col("open_price") / 4).alias("eps"), text(F.col("low_price")).alias("bookValue"),
                 text(F.col("close_price") / F.col("low_price")).alias("pbRatio"),
                 text(F.col("daily_return") * 100).alias("pChange365d"), text(F.col("normalised_close")).alias("pChange30d"),
                 F.struct(text(F.col("high_52w")).alias("max"), text(F.col("low_52w")).alias("min")).alias("weekHighLow"))
        .alias("priceInfo"),
        F.struct(text(F.col("close_price") * F.col("volume")).alias("marketCap"),
                 text(F.pmod("symbol", F.lit(40)) + 1).alias("pdSectorInd")).alias("metadata"),
        F.struct(F.lit("10").alias("faceValue")).alias("securityInfo"),
        F.struct(text(F.col("volume")).alias("deliveryToTradedQuantity")).alias("tradeInfo")))
    q = last.select("symbol", F.col("trade_date").alias("report_period"), doc.alias("quote_json"))
    return src.quote_json_to_metrics(q)


def summary_frame(spark, sf_dir):
    latest = views.latest_bars(prices(spark, sf_dir, *SUMMARY_BARS))
    fund = dims.promote_fundamentals(fx.fundamentals(spark, sf_dir))
    return earnings.stock_summary(latest, fund)


@query("live_overlay")
def q_live_overlay(spark, sf_dir):
    return live.overlay_live(summary_frame(spark, sf_dir), live.quotes_from_bars(fx.bars(spark, sf_dir)), "price")


@query("live_overlay_insights")
def q_live_overlay_insights(spark, sf_dir):
    return live.overlay_live(summary_frame(spark, sf_dir), live.quotes_from_bars(fx.bars(spark, sf_dir)),
                             "insights")


@query("append_live_bar")
def q_append_live_bar(spark, sf_dir):
    from ticklake.session import materialize
    bars = materialize(fx.bars(spark, sf_dir), "bars")     # read by the indicators, the newest bars and the quotes
    clean = ind.clean_bars(bars)
    last = materialize(live.last_closes(clean), "last_closes")      # read for the date and for the new bars
    today = last.agg(F.date_add(F.max("trade_date"), 1)).scalar()
    return live.append_live_bar(ind.enrich_bars(clean, eps=TIE_EPS), live.quotes_from_bars(bars), today, last)


@query("summary_labels")
def q_summary_labels(spark, sf_dir):
    s = summary_frame(spark, sf_dir)
    return s.select("symbol", lb.rsi_label("rsi_14").alias("rsi_label"),
                    lb.position_label("normalised_close").alias("position_label"),
                    lb.valuation_label("trailing_pe").alias("valuation_label"),
                    lb.momentum_label("close_price", "fifty_two_week_high", "fifty_two_week_low").alias("momentum"),
                    F.round(lb.range_position("close_price", "fifty_two_week_high", "fifty_two_week_low") + TIE_EPS, 6)
                    .alias("range_position"),
                    lb.sma_gap("close_price", "sma_20")["direction"].alias("sma_direction"),
                    lb.bar_direction(F.lit(None).cast("double"), F.col("close_price"), F.col("daily_return"))["return_up"]
                    .alias("return_up"))


@query("merge_prices")
def q_merge_prices(spark, sf_dir):
    """yesterday's bars (all but the last 30 days) merged with a feed of
    net-price bars for the last 60 days (30 days overlap, 30 days new); both
    are committed versions of one table, which is read back."""
    b = fx.bars(spark, sf_dir)
    hi = b.agg(F.max("trade_date")).first()[0]
    target = b.filter(F.col("trade_date") < F.date_sub(F.lit(hi), 30))
    updates = fx.bars(spark, sf_dir, net=True).filter(F.col("trade_date") >= F.date_sub(F.lit(hi), 60))
    table = VersionedTable(spark, scratch_folder(spark, "prices"), ["symbol", "trade_date"], ["symbol"])
    table.merge(target)
    table.merge(updates)
    return table.read()


@query("call_counter")
def q_call_counter(spark, sf_dir):
    """A17 over all events: per-user counter of clicks incremented by the
    day's events of every other type."""
    from ticklake.sources.tables import read_table
    e = read_table(spark, sf_dir, "events", "user_id", "event_type")
    is_click = F.col("event_type").eqNullSafe("click")
    counts = [e.filter(c).groupBy("user_id").agg(F.count(F.lit(1)).alias("count")) for c in (is_click, ~is_click)]
    return sinks.upsert_increment(*counts, ["user_id"], "count")


# ------------------------------------------------------------------ more sources, reports, facts
SUMMARY_PRICE_COLS = ("as_of_date", "close_price", "daily_return", "normalised_close", "sma_20", "sma_50", "rsi_14")
SUMMARY_FUND_COLS = tuple(earnings.SUMMARY_METRICS)


@query("summary_upsert")
def q_summary_upsert(spark, sf_dir):
    """yesterday's gold summary (bars up to 30 days before the newest
    date) upserted with today's: price columns replaced, fundamentals only
    where today's value is present (today's feed lacks the P/E metric).

    Both snapshots come from one grouped aggregate over the prices (two
    ``max_by``), so the indicator plan runs once."""
    from ticklake.sources.tables import read_table  # noqa: F401
    p = prices(spark, sf_dir, *SUMMARY_BARS)
    hi = clean_bars(spark, sf_dir).agg(F.max("trade_date")).first()[0]
    cutoff = F.date_sub(F.lit(hi), 30)
    cols = [c for c in p.columns if c != "symbol"]
    row = F.struct(*cols)
    early = F.col("trade_date") < cutoff
    from ticklake.session import materialize
    both = materialize(p.groupBy("symbol").agg(
        F.max_by(row, "trade_date").alias("new"),
        F.max_by(F.when(early, row), F.when(early, F.col("trade_date"))).alias("old")))
    fund = dims.promote_fundamentals(fx.fundamentals(spark, sf_dir))
    old = earnings.stock_summary(both.filter(F.col("old").isNotNull()).select("symbol", "old.*"), fund)
    new = earnings.stock_summary(both.select("symbol", "new.*"), fund.filter(F.col("metric_name") != "pe"))
    return sinks.upsert_gold_summary(old, new, "symbol", SUMMARY_PRICE_COLS, SUMMARY_FUND_COLS)


@query("history_plus_today")
def q_history_plus_today(spark, sf_dir):
    """History clipped before the newest day plus today's bar from the
    net-price feed."""
    b = fx.bars(spark, sf_dir)
    hi = b.agg(F.max("trade_date")).first()[0]
    today = fx.bars(spark, sf_dir, net=True).filter(F.col("trade_date") == F.lit(hi))
    return src.history_plus_today(b, today, hi)


@query("normalise_ohlcv")
def q_normalise_ohlcv(spark, sf_dir):
    """A vendor-shaped frame (Date / Open / High / Low / Close / Volume,
    no Adj Close) normalised to the bronze bar columns."""
    b = fx.bars(spark, sf_dir)
    vendor = b.select("symbol", F.date_format("trade_date", "yyyy-MM-dd").alias("Date"),
                      F.col("open_price").alias("Open"), F.col("high_price").alias("High"),
                      F.col("low_price").alias("Low"), F.col("close_price").alias("Close"),
                      F.col("volume").alias("Volume"))
    return src.normalise_ohlcv(vendor, keep=("symbol",))


@query("report_metrics")
def q_report_metrics(spark, sf_dir):
    """C9 (+F9): earnings reports, newest first, with summary metrics attached."""
    rep = earnings.earnings_report(fx.fundamentals(spark, sf_dir))
    out = earnings.attach_metrics(rep.select("ticker", "report_date", "sentiment_score"), summary_frame(spark, sf_dir))
    return earnings.report_list(out.select("ticker", "report_date", "sentiment_score", "close_price", "rsi_14",
                                           "market_cap"))


@query("report_stats")
def q_report_stats(spark, sf_dir):
    """D11 over the earnings reports (created_at = report date here)."""
    rep = earnings.earnings_report(fx.fundamentals(spark, sf_dir)).withColumn("created_at", F.col("report_date"))
    return quality.report_stats(rep)


@query("symbol_list")
def q_symbol_list(spark, sf_dir):
    return quality.symbol_list(clean_bars(spark, sf_dir))


@query("price_history")
def q_price_history(spark, sf_dir):
    """F6 (B7 + B8): the last 30 days of bars for one sector's companies."""
    bars = clean_bars(spark, sf_dir)
    hi = bars.agg(F.max("trade_date")).first()[0]
    asia = dim_companies(spark, sf_dir).filter(F.col("is_current") & (F.col("sector") == "ASIA")).select("symbol")
    # indicators are per symbol: other companies' bars go before they are computed
    columns = ("symbol", "trade_date", "close_price", "sma_20", "rsi_14")
    p = ind.enrich_bars(cl.filter_symbols(bars, asia), eps=TIE_EPS, columns=columns)
    return views.price_history(p, asia, hi, 30).select(*columns)


@query("run_audit")
def q_run_audit(spark, sf_dir):
    """Build the daily bars with observed row counts and return the
    audit record (task, run_date, status, rows read, rows written)."""
    from ticklake.sources.tables import read_table
    li, obs_read = quality.run_audit(read_table(spark, sf_dir, "lineitem"), "read", None, "lineitem_read")
    out, obs_written = quality.run_audit(fx.bars(spark, sf_dir, lineitem=li), "write", None, "bars_written")
    bounds = out.agg(F.max("trade_date").alias("d")).first()   # the action; both observations fill
    return quality.audit_row(spark, "daily_bars", bounds["d"], "success", obs_read.get["rows"],
                             obs_written.get["rows"]).drop("recorded_at")


def _news_company(df):
    """News sources are named 'src<N>': company N of the dimension."""
    return df.withColumn("symbol", F.regexp_extract("symbol", r"(\d+)$", 1).cast("bigint"))


@query("fact_news_sentiment")
def q_fact_news_sentiment(spark, sf_dir):
    """News sentiment facts keyed by day and the company version in force."""
    n = _news_company(tx.dedupe_news(articles(spark, sf_dir)))
    day = F.to_date("published_at")
    j = dims.as_of_version(n, dim_companies(spark, sf_dir), day)
    return j.select(F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"), "company_version", "symbol",
                    "content_hash", "headline", "summary", "sentiment_score")


@query("vector_upsert")
def q_vector_upsert(spark, sf_dir):
    """The vector store after yesterday's load (articles before the
    midpoint of the news span) is upserted with all of today's records."""
    n = tx.dedupe_news(articles(spark, sf_dir))
    vec = fx.vectors(spark, sf_dir).select(F.col("vec_id").alias("doc_id"), "embedding")
    store = nw.vector_records(n.filter(before_midpoint(n)), vec)
    out = nw.vector_upsert(store, nw.vector_records(n, vec))
    return out.select("id", "document", "metadata.*", "pending", F.size("embedding").alias("dims"))


@query("summary_snapshot")
def q_summary_snapshot(spark, sf_dir):
    """F8: the gold summary rows of one sector's current companies."""
    europe = dim_companies(spark, sf_dir).filter(F.col("is_current") & (F.col("sector") == "EUROPE")).select("symbol")
    return earnings.summary_snapshot(summary_frame(spark, sf_dir), europe)


# ------------------------------------------------------------------ checks that find something, round trips, upserts
LOST_COMPANIES = 7         # fixture: the dimension has lost every seventh company
LOST_DAY = 13              # fixture: the calendar has lost this day of each month
STORED_LANGS = ("en", "de")     # fixture: the languages that an earlier load has stored
EARLIER = "1996-12-31"     # fixture: what an earlier load has seen


@query("integrity_faults")
def q_integrity_faults(spark, sf_dir):
    """K3-K7 (C7, C8, G4) over a star schema with companies and days missing."""
    from ticklake.session import materialize
    silver = materialize(price_facts_input(spark, sf_dir), "silver")
    d = dim_companies(spark, sf_dir, stored=True)
    return quality.integrity_report(
        dims.load_fact_prices(silver, d),
        dims.with_unknown_member(d.filter(F.pmod("symbol", F.lit(LOST_COMPANIES)) != 0)),
        dim_date(spark, sf_dir).filter(F.dayofmonth("full_date") != LOST_DAY), silver)


@query("news_contract")
def q_news_contract(spark, sf_dir):
    """K9 on the raw news, which breaks most of its rules."""
    from ticklake.sources.tables import read_table
    return quality.contract_report(
        articles(spark, sf_dir), "bronze.news", not_null=["summary", "sentiment_score"],
        unique=[["url"], ["content_hash"]], checks={"sentiment_positive": F.col("sentiment_score") > 0},
        max_length={"headline": 40}, foreign_keys=[("doc_id", read_table(spark, sf_dir, "labels", "doc_id"), "doc_id")])


@query("embedding_checks")
def q_embedding_checks(spark, sf_dir):
    """Another dimension, another model, and a store without a record."""
    v = fx.vectors(spark, sf_dir)
    record = spark.range(1).select(F.lit("minilm").alias("model_name"), F.lit(64).alias("dimension"))
    cases = {"other_dimension": (record, "minilm", 128), "other_model": (record, "mpnet", 64),
             "first_run": (record.filter("dimension < 0"), "minilm", 64)}
    parts = [quality.embedding_compat(v, meta, model, dim).withColumn("case", F.lit(name))
             for name, (meta, model, dim) in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("embedding_gate")
def q_embedding_gate(spark, sf_dir):
    """K11 as a gate: the first run records model and size, the same again passes, others are refused."""
    v, path = fx.vectors(spark, sf_dir), scratch_folder(spark, "embedding-record")
    runs = []
    for name, model, dim in (("first", "minilm", 64), ("again", "minilm", 64), ("other_model", "mpnet", 64),
                             ("other_size", "minilm", 128)):
        try:
            quality.embedding_gate(spark, path, v, model, dim)
            runs.append((name, True))
        except RuntimeError:
            runs.append((name, False))
    cases = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(n).alias("case"), F.lit(ok).alias("accepted"))
                                                      for n, ok in runs])).alias("c")).select("c.*")
    stored = spark.read.parquet(path).join(v.agg(F.count("*").alias("vectors")))
    return cases.join(stored)


@query("unenriched_news_stored")
def q_unenriched_news_stored(spark, sf_dir):
    """C2 against a silver table with complete, half complete and missing articles."""
    silver = tx.dedupe_news(articles(spark, sf_dir)).filter(F.col("source").isin(*STORED_LANGS))
    return nw.unenriched_news(articles(spark, sf_dir), silver).select("content_hash", "doc_id", "symbol")


@query("news_refresh")
def q_news_refresh(spark, sf_dir):
    """F1 refresh: articles in the feed get summary and sentiment and keep the rest."""
    n = tx.dedupe_news(articles(spark, sf_dir))
    feed = (nw.news_feed(n).filter(F.col("source").isin(*STORED_LANGS))
            .withColumns({"source": F.lit("stored"), "summary": F.lit(None).cast("string")}))
    return nw.refresh_news_feed(feed, n)


@query("fundamentals_upsert")
def q_fundamentals_upsert(spark, sf_dir):
    """K15 with its upsert: an earlier load's metrics, then the later reports."""
    raw = fx.fundamentals(spark, sf_dir)
    seen = F.col("report_period") <= F.lit(EARLIER).cast("date")
    return dims.upsert_fundamentals(dims.promote_fundamentals(raw.filter(seen)), raw.filter(~seen))


@query("earnings_upsert")
def q_earnings_upsert(spark, sf_dir):
    """L10 with its upsert: an earlier run's reports, then today's."""
    raw = fx.fundamentals(spark, sf_dir)
    stored = earnings.earnings_report(raw.filter(F.col("report_period") <= F.lit(EARLIER).cast("date")))
    return earnings.upsert_reports(stored, earnings.earnings_report(raw))


@query("csv_export")
def q_csv_export(spark, sf_dir):
    """The companies as CSV, read back."""
    import uuid
    from ticklake.session import scratch_path
    c, path = fx.companies(spark, sf_dir), scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    sinks.export_csv(c, path)
    return spark.read.schema(c.schema).option("header", "true").csv(path)


@query("bronze_batch")
def q_bronze_batch(spark, sf_dir):
    """The messages as a bounded scan, appended to bronze and read back typed."""
    base = spool_messages(spark, sf_dir)
    raw = src.read_price_batch(spark, {"format": "text", "path": base + "/in"})
    valid, _ = cl.split_valid_dead(ingest.parse_messages(raw))
    sinks.write_bronze_batch(valid, base + "/bronze")
    return src.read_bronze_prices(spark, base + "/bronze").drop("ingested_at")


@query("stream_two_sinks")
def q_stream_two_sinks(spark, sf_dir):
    """A3, A4, I4: one query per sink, each run again from its checkpoint
    (which must add nothing)."""
    base = spool_messages(spark, sf_dir)
    for _ in range(2):
        parsed = ingest.parse_messages(src.read_price_stream(spark, {"format": "text", "path": base + "/in"}))
        valid, dead = cl.split_valid_dead(parsed)
        runs = [sinks.write_bronze_stream(valid, base + "/bronze", base + "/ck1", {"availableNow": True}),
                sinks.write_dead_letter_stream(dead, base + "/dead", base + "/ck2", {"availableNow": True})]
        for q in runs:
            q.awaitTermination()
    part = lambda name: spark.read.parquet(f"{base}/{name}").select(
        F.lit(name).alias("sink"), "ticker", "trade_date", "close")
    return part("bronze").unionByName(part("dead"))


@query("clean_articles")
def q_clean_articles(spark, sf_dir):
    """Articles of vendor shape (nested source, content or description)."""
    from ticklake.sources.tables import read_table
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    vendor = d.select("doc_id", F.substring_index("text", "\n", 1).alias("title"),
                      F.struct(F.col("source").alias("name")).alias("source"),
                      F.when(F.col("lang") == "en", F.col("text")).otherwise("").alias("content"),
                      F.split_part("text", F.lit("\n"), F.lit(2)).alias("description"))
    out = cl.require_not_null(cl.clean_articles(vendor), "title", "source_name")
    return out.select("doc_id", "title", "source_name", F.sha2("body", 256).alias("body_hash"))


@query("number_labels")
def q_number_labels(spark, sf_dir):
    """H6, H7 over the fundamentals (every seventh company without a value)."""
    f = fx.fundamentals(spark, sf_dir)
    value = F.when(F.pmod("symbol", F.lit(7)) != 0, F.col("metric_value"))
    return f.select("symbol", "report_period", "metric_name", lb.crore_label(value * 1000000).alias("crore"),
                    lb.pe_label(value).alias("ratio"))


@query("run_audit_log")
def q_run_audit_log(spark, sf_dir):
    """A run that succeeds and one that fails, both appended to the log."""
    import uuid
    from ticklake.session import scratch_path
    from ticklake.sources.tables import read_table
    log = scratch_path(spark, f"audit-{uuid.uuid4().hex}")
    li = read_table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate")

    def days_from(start):
        rows = li.filter(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
        n = rows.count()
        if not n:
            raise ValueError("no rows from that day on")
        return n, rows.distinct().count()

    quality.audited(spark, log, "count_days", "1996-01-01", lambda: days_from("1996-01-01"))
    try:
        quality.audited(spark, log, "count_days", "2999-01-01", lambda: days_from("2999-01-01"))
    except ValueError:
        pass                                       # the log has it
    return spark.read.parquet(log).drop("recorded_at", "started_at")
