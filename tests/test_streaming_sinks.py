"""Streaming ingest, sinks and remaining column functions."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from ticklake.functions import clean as cl
from ticklake.functions import labels as lb
from ticklake.operators import quality
from ticklake.sources import prices as src
from ticklake.sources import sinks
from ticklake.streaming import ingest

SF = "/root/testdata/sf0.001"


def _spool(spark, d):
    src.messages(spark, SF).select("value").write.mode("overwrite").text(d + "/in")


def test_stream_two_sinks_equal_batch_split(spark):
    d = tempfile.mkdtemp(prefix="ticklake-stream-")
    _spool(spark, d)
    ingest.bronze_backfill(spark, {"format": "text", "path": d + "/in", "max_files_per_trigger": 1},
                           d + "/bronze", d + "/dead", d + "/ckpt")
    bronze = src.read_bronze_prices(spark, d + "/bronze")
    dead = spark.read.parquet(d + "/dead")
    parsed = ingest.parse_messages(src.messages(spark, SF))
    valid, rejected = cl.split_valid_dead(parsed)
    assert bronze.count() == valid.count() and dead.count() == rejected.count()
    assert bronze.count() + dead.count() == src.messages(spark, SF).count()
    assert bronze.filter(F.col("ticker").endswith(".NS")).count() == 0
    # restarting from the checkpoint processes nothing twice
    ingest.bronze_backfill(spark, {"format": "text", "path": d + "/in"}, d + "/bronze", d + "/dead", d + "/ckpt")
    assert spark.read.parquet(d + "/bronze").count() == valid.count()


def test_foreach_batch_write_is_idempotent_per_batch(spark):
    d = tempfile.mkdtemp(prefix="ticklake-fb-")
    raw = src.messages(spark, SF).select("value")
    fn = ingest._write_batch(d + "/bronze", d + "/dead")
    fn(raw, 7)
    fn(raw, 7)   # a retried micro-batch replaces its own files
    n_valid = cl.split_valid_dead(ingest.parse_messages(raw))[0].count()
    assert spark.read.parquet(d + "/bronze").count() == n_valid


def test_stream_dedupe(spark):
    d = tempfile.mkdtemp(prefix="ticklake-dedupe-")
    _spool(spark, d)
    ingest.dedupe_stream_to(spark, {"format": "text", "path": d + "/in"}, d + "/out", d + "/ckpt")
    out = spark.read.parquet(d + "/out")
    valid = cl.split_valid_dead(ingest.parse_messages(src.messages(spark, SF)))[0]
    assert out.count() == valid.select("ticker", "trade_date").distinct().count()


def test_merge_into_path_and_bronze_batch(spark):
    d = tempfile.mkdtemp(prefix="ticklake-merge-")
    t = spark.createDataFrame([(1, dt.date(2024, 1, 1), 10.0), (2, dt.date(2024, 1, 1), 20.0)],
                              "symbol long, trade_date date, close double")
    u = spark.createDataFrame([(1, dt.date(2024, 1, 1), 11.0), (1, dt.date(2024, 1, 2), 12.0)],
                              "symbol long, trade_date date, close double")
    sinks.merge_into_path(spark, d + "/silver", t, ["symbol", "trade_date"], ["symbol"])
    sinks.merge_into_path(spark, d + "/silver", u, ["symbol", "trade_date"], ["symbol"])
    sinks.merge_into_path(spark, d + "/silver", u, ["symbol", "trade_date"], ["symbol"])
    got = sorted((r["symbol"], r["trade_date"], r["close"]) for r in spark.read.parquet(d + "/silver").collect())
    assert got == [(1, dt.date(2024, 1, 1), 11.0), (1, dt.date(2024, 1, 2), 12.0), (2, dt.date(2024, 1, 1), 20.0)]
    sinks.export_csv(spark.read.parquet(d + "/silver"), d + "/csv")
    assert spark.read.option("header", "true").csv(d + "/csv").count() == 3


def test_normalise_and_history_plus_today(spark):
    v = spark.createDataFrame([("2024-01-02", 1.0, 2.0, 0.5, 1.5, None, 10), ("2024-01-03", 1.5, 2.5, 1.0, float("nan"), 2.0, 11)],
                              "Date string, Open double, High double, Low double, Close double, `Adj Close` double, Volume long")
    n = {r["trade_date"]: r for r in src.normalise_ohlcv(v).collect()}
    assert n[dt.date(2024, 1, 2)]["adj_close"] == 1.5 and n[dt.date(2024, 1, 3)]["close"] is None
    h = spark.createDataFrame([(1, dt.date(2024, 1, 1), 1.0), (1, dt.date(2024, 1, 2), 2.0)],
                              "symbol long, trade_date date, close_price double")
    today = spark.createDataFrame([(1, dt.date(2024, 1, 2), 3.0)], "symbol long, trade_date date, close_price double")
    got = sorted((r["trade_date"], r["close_price"]) for r in src.history_plus_today(h, today, "2024-01-02").collect())
    assert got == [(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 3.0)]


def test_quote_json_to_metrics(spark):
    full = ('{"priceInfo": {"pe": "21.5", "eps": 4, "bookValue": "9", "pbRatio": "2.5", "pChange365d": "-3", '
            '"pChange30d": "1e1", "weekHighLow": {"max": "120", "min": "80"}}, "metadata": {"marketCap": "5", '
            '"pdSectorInd": "30"}, "securityInfo": {"faceValue": 10}, "tradeInfo": {"deliveryToTradedQuantity": "44.5"}}')
    part = '{"priceInfo": {"pe": "-", "eps": "5d", "bookValue": "", "weekHighLow": {"max": " 7 "}}, "metadata": "junk"}'
    df = spark.createDataFrame([("X", dt.date(2024, 1, 1), full), ("Y", dt.date(2024, 1, 1), part)],
                               "symbol string, report_period date, quote_json string")
    got = {(r["symbol"], r["metric_name"]): r["metric_value"] for r in src.quote_json_to_metrics(df).collect()}
    assert {m: v for (s, m), v in got.items() if s == "X"} == {
        "high52": 120.0, "low52": 80.0, "pChange365d": -3.0, "pChange30d": 10.0, "pe": 21.5, "eps": 4.0, "bookValue": 9.0,
        "priceToBook": 2.5, "marketCap": 5.0, "faceValue": 10.0, "industryPE": 30.0, "deliveryToTradedQty": 44.5}
    assert {m: v for (s, m), v in got.items() if s == "Y"} in ({"high52": 7.0}, {})


def test_labels(spark):
    df = spark.createDataFrame([(None, None, 25.25), (5e12, 150.0, None), (3.2e9, 20.0, 31.0)],
                               "cap double, rsi double, pe double")
    rows = df.select(lb.crore_label("cap").alias("c"), lb.pe_label("pe").alias("p"),
                     lb.rsi_label("rsi").alias("r"), lb.valuation_label("pe").alias("v")).collect()
    assert rows[0]["c"] == "N/A" and rows[0]["p"] == "25.2x"   # half to even, like Python's format
    assert rows[1]["c"] == "₹5.0L Cr" and rows[1]["r"] == "Overbought" and rows[1]["p"] == "N/A"
    assert rows[2]["c"] == "₹320 Cr" and rows[2]["v"] == "premium"
    parts = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date").select(*lb.date_parts("d")).first()
    assert parts["date_key"] == 20240107 and parts["day_of_week"] == 6 and parts["is_weekend"] is True
    assert abs(spark.range(1).select(lb.pct_change(F.lit(110.0), F.lit(100.0))).first()[0] - 10.0) < 1e-9
    assert spark.range(1).select(lb.pct_change(F.lit(110.0), F.lit(0.0))).first()[0] is None


def test_clean_articles_and_guards(spark):
    df = spark.createDataFrame([("  Title  ", "src", None, "desc"), ("   ", "src", "c", None), ("T2", "s", "", "")],
                               "title string, source string, content string, description string")
    out = {r["title"]: r["body"] for r in cl.clean_articles(df).collect()}
    assert out == {"Title": "desc", "T2": ""}
    assert spark.range(1).select(cl.canonical_symbol(F.lit("reliance.NS"))).first()[0] == "RELIANCE"
    assert [r[0] for r in spark.createDataFrame([("",), ("-",), ("x",), ("1.5",)], "v string")
            .select(cl.safe_float("v")).collect()] == [None, None, None, 1.5]


def test_sample_list_and_compat(spark):
    df = spark.createDataFrame([(i,) for i in [10, 3, 7, 1, 2, 9]], "v long")
    r = quality.sample_list(df, "v", 3).first()
    assert (r["n"], r["sample"]) == (6, "1, 2, 3")
    vec = spark.createDataFrame([(1, [0.1, 0.2]), (2, [0.1])], "id long, embedding array<double>")
    meta = spark.createDataFrame([("m", 2)], "model_name string, dimension int")
    c = quality.embedding_compat(vec, meta, "m", 2).first()
    assert c["compatible"] is False and c["bad_vectors"] == 1


def test_two_query_sinks(spark):
    """A3/A4: the reference's two-query form (one checkpoint per sink)."""
    d = tempfile.mkdtemp(prefix="ticklake-2q-")
    _spool(spark, d)
    raw = src.read_price_stream(spark, {"format": "text", "path": d + "/in"})
    valid, dead = cl.split_valid_dead(ingest.parse_messages(raw))
    q1 = sinks.write_bronze_stream(valid, d + "/bronze", d + "/ck1", {"availableNow": True})
    q2 = sinks.write_dead_letter_stream(dead, d + "/dead", d + "/ck2", {"availableNow": True})
    q1.awaitTermination()
    q2.awaitTermination()
    batch_valid, batch_dead = cl.split_valid_dead(ingest.parse_messages(src.messages(spark, SF)))
    assert spark.read.parquet(d + "/bronze").count() == batch_valid.count()
    assert spark.read.parquet(d + "/dead").count() == batch_dead.count()


def test_odd_numbers_and_statements(spark):
    nan = float("nan")
    df = spark.createDataFrame([("5d", nan), ("1f", 1.0), (" 1.5e2 ", None), ("-", -1.0), (".5", 2.0), ("NaN", 0.0)],
                               "t string, x double")
    assert [r[0] for r in df.select(cl.safe_float("t")).collect()] == [None, None, 150.0, None, 0.5, None]
    assert {(r["c"], r["p"]) for r in df.where("isnan(x)").select(lb.crore_label("x").alias("c"), lb.pe_label("x").alias("p"))
            .collect()} == {("N/A", "N/A")}
    valid, dead = cl.split_valid_dead(df.withColumnRenamed("x", "close"))
    assert sorted(r["close"] for r in valid.collect()) == [1.0, 2.0] and dead.count() == 4
    said = spark.createDataFrame([("\nSELECT 1",), ("\tselect x",), (" update t",)], "s string")
    assert [r[0] for r in said.select(cl.statement_verdict("s")["allowed"]).collect()] == [True, True, False]


def test_first_merge_keeps_one_row_per_key(spark):
    d = tempfile.mkdtemp(prefix="ticklake-merge1-")
    from ticklake.sources.sinks import merge_into_path
    merge_into_path(spark, d + "/t", spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 3.0)], "k long, v double"), ["k"])
    assert spark.read.parquet(d + "/t").count() == 2


def test_metrics_and_news_lose_nothing(spark):
    from ticklake.plans import earnings, news
    fund = spark.createDataFrame([(1, dt.date(2020, 1, 1) + dt.timedelta(days=i), f"m{i % 80}", float(i))
                                  for i in range(400)], "symbol long, report_period date, metric_name string, metric_value double")
    got = earnings.latest_metrics(fund).collect()
    assert len(got) == 80 and min(r["metric_value"] for r in got) == 320.0
    pending = spark.createDataFrame([(f"h{i:03d}", 1, dt.datetime(2024, 1, 1, 0, i % 60)) for i in range(130)],
                                    "content_hash string, symbol long, published_at timestamp")
    assert news.enrichment_batch(pending).count() == 130
    seen, left = 0, pending
    while left.count():
        batch = news.enrichment_batch(left, 50).select("content_hash")
        seen += batch.count()
        left = left.join(batch, "content_hash", "left_anti")
    assert seen == 130


def test_feed_refresh_changes_summary_and_sentiment_only(spark):
    from ticklake.plans import news
    schema = ("content_hash string, symbol string, headline string, source string, published_at timestamp, url string, "
              "summary string, sentiment_score double")
    at = dt.datetime(2024, 1, 1)
    feed = spark.createDataFrame([("a", "S", "old", "x", at, "u", None, None)], schema)
    new = spark.createDataFrame([("a", "T", "new", "y", at, "v", "sum", 0.5), ("b", "T", "n", "y", at, "v", None, None)], schema)
    got = {r["content_hash"]: tuple(r)[1:4] + tuple(r)[5:] for r in
           news.refresh_news_feed(feed, new).select(*feed.columns).collect()}
    assert got == {"a": ("S", "old", "x", "u", "sum", 0.5), "b": ("T", "n", "y", "v", None, None)}


def test_headlines_strip_all_white_space(spark):
    from ticklake.operators.text import dedupe_news
    df = spark.createDataFrame([("x", 1, 1), ("x\t", 1, 2), ("\n x", 1, 3)], "headline string, published_at long, doc_id long")
    assert dedupe_news(df).count() == 1


def test_small_prices_keep_their_mean(spark):
    from pyspark.sql import Window
    from ticklake.operators import indicators as ind
    df = spark.createDataFrame([(1, i, 0.00004) for i in range(20)], "symbol long, trade_date long, close_price double")
    w = Window.partitionBy("symbol").orderBy("trade_date")
    got = ind.rolling_mean_exact(df, "close_price", [20], w).orderBy("trade_date").collect()[-1]["_sma_20"]
    assert abs(got - 0.00004) < 1e-12


def test_log_offsets_and_zero_rows(spark, tmp_path):
    """Lost offsets are skipped or refused; an empty range writes nothing and gives 0."""
    from ticklake.sources import pricelog
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    m = src.messages(spark, SF)
    for _ in range(2):
        pricelog.append_log(m, path, F.pmod("event_id", F.lit(2)), 2, segment_rows=100)
    n = m.count()
    read = lambda **o: src.read_price_batch(spark, {"format": "log", "path": path, **o})
    assert read().count() == 2 * n and read().select("partition", "offset").distinct().count() == 2 * n
    latest = '{"0": %d, "1": %d}' % tuple(s[-1][1] for _, s in sorted(pricelog.segments(path).items()))
    source = {"format": "log", "path": path, "startingOffsets": latest}
    assert ingest.ingest_price_batch(spark, source, out + "/bronze", out + "/dead") == 0 and not os.path.exists(out)
    written = ingest.ingest_price_batch(spark, {"format": "log", "path": path}, out + "/bronze", out + "/dead")
    assert written == spark.read.parquet(out + "/bronze").count() == 2 * cl.split_valid_dead(ingest.parse_messages(m))[0].count()
    pricelog.retain_log(path, {0: 100})
    assert read(startingOffsets='{"0": 0, "1": 0}').count() == 2 * n - 100
    try:
        read(startingOffsets='{"0": 0}', failOnDataLoss="true").count()
        raise AssertionError("lost offsets went unnoticed")
    except Exception as e:
        assert "are lost" in str(e)


def test_late_rows_arrive_in_slices_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A slice of time is one batch, however many tasks write it; results against SQL."""
    import datetime
    import duckdb
    from oracle.queries import SQL
    from ticklake.plans import catalog
    from ticklake.streaming import ingest
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(i, t0 + datetime.timedelta(minutes=37 * i), i % 13, "view", float(i % 29), None) for i in range(600)]
    sf = str(tmp_path / "sf")
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
                          ).repartition(4).write.parquet(sf + "/events.parquet")
    monkeypatch.setattr(catalog, "scratch_folder", lambda spark, name: str(tmp_path / name))
    got = sorted((tuple(r) for r in catalog.REGISTRY["stream_late_rows"](spark, sf).collect()), key=str)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet/*.parquet'")
    assert got == sorted(con.sql(SQL["stream_late_rows"]).fetchall(), key=str)
    assert len(list((tmp_path / "late" / "in").glob("part-*"))) > catalog.LATE_SLICES + 1      # not one task a slice
    batches = ingest.read_commits(spark, str(tmp_path / "late" / "kept_commits")).select("batch_id").distinct().count()
    assert batches == catalog.LATE_SLICES + 1
