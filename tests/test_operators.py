"""Dimensions, guards, upserts, vectors and text operators on small frames."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from ticklake.functions import clean as cl
from ticklake.functions import labels as lb
from ticklake.operators import dims, text as tx, vectors as vx
from ticklake.sources import sinks


def company(spark, rows):
    return spark.createDataFrame(rows, "symbol bigint, company_name string, sector string, industry string, "
                                       "exchange string")


def test_scd2_change_closes_previous_day(spark):
    d0 = dims.scd2_upsert(dims.empty_dim(spark), company(spark, [(1, "RIL", "Energy", "Oil", "NSE")]), "2024-01-01")
    d1 = dims.scd2_upsert(d0, company(spark, [(1, "RIL", "Conglomerates", "Oil", "NSE")]), "2024-06-01")
    rows = sorted(d1.collect(), key=lambda r: r["version"])
    assert [(r["version"], r["is_current"], r["effective_from"], r["effective_to"]) for r in rows] == [
        (1, False, dt.date(2024, 1, 1), dt.date(2024, 5, 31)),
        (2, True, dt.date(2024, 6, 1), None)]
    assert rows[0]["company_key"] != rows[1]["company_key"]


def test_scd2_unchanged_is_noop_and_one_open_row(spark):
    base = company(spark, [(1, "A", "S1", "I1", "X"), (2, "B", None, "I2", "X")])
    d0 = dims.scd2_upsert(dims.empty_dim(spark), base, "2024-01-01")
    d1 = dims.scd2_upsert(d0, base, "2024-02-01")   # NULL sector compares equal (<=>)
    assert sorted(map(tuple, d0.collect())) == sorted(map(tuple, d1.collect()))
    d2 = dims.scd2_upsert(d1, company(spark, [(2, "B", "S2", "I2", "X"), (3, "C", "S3", "I3", "X")]), "2024-03-01")
    open_rows = d2.filter("is_current").groupBy("symbol").count().collect()
    assert all(r["count"] == 1 for r in open_rows) and len(open_rows) == 3


def test_statement_guard(spark):
    rows = [("SELECT * FROM t",), ("SELECT 1 LIMIT 5",), ("drop table t",), ("DELETE FROM t",),
            ("TRUNCATE t",), ("UPDATE t SET a=1",), ("SELECT a -- c",), ("WITH x AS (SELECT 1) SELECT * FROM x",),
            ("SELECT updated_at FROM t",)]
    out = cl.classify_statements(spark.createDataFrame(rows, "statement string")).collect()
    got = {r["statement"]: (r["allowed"], r["guarded"]) for r in out}
    assert got["SELECT * FROM t"] == (True, "SELECT * FROM t LIMIT 1000;")
    assert got["SELECT 1 LIMIT 5"] == (True, "SELECT 1 LIMIT 5;")
    assert got["SELECT updated_at FROM t"][0] is True
    for s in ("drop table t", "DELETE FROM t", "TRUNCATE t", "UPDATE t SET a=1", "SELECT a -- c",
              "WITH x AS (SELECT 1) SELECT * FROM x"):
        assert got[s][0] is False


def test_valid_and_dead_partition_input(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (-2.0,), (3.0,)], "close double")
    v, d = cl.split_valid_dead(df)
    assert v.count() + d.count() == df.count() and v.count() == 2


def test_market_hours_bounds(spark):
    rows = [(dt.datetime(2024, 1, 1, 3, 45, 0),),       # 09:15:00 IST Monday
            (dt.datetime(2024, 1, 1, 10, 0, 0),),       # 15:30:00 IST
            (dt.datetime(2024, 1, 1, 10, 0, 0, 1),),    # 15:30:00.000001
            (dt.datetime(2024, 1, 6, 5, 0, 0),)]        # Saturday
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(cl.in_market_hours("ts")).collect()]
    assert got == [True, True, False, False]


def test_merge_upsert_idempotent(spark):
    t = spark.createDataFrame([(1, 1, 10.0), (1, 2, 11.0)], "s long, d long, v double")
    u = spark.createDataFrame([(1, 2, 12.0), (1, 3, 13.0)], "s long, d long, v double")
    once = sinks.merge_upsert(t, u, ["s", "d"])
    twice = sinks.merge_upsert(once, u, ["s", "d"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [
        (1, 1, 10.0), (1, 2, 12.0), (1, 3, 13.0)]


def test_upsert_overwrite_and_coalesce(spark):
    t = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, s string, x double")
    r = spark.createDataFrame([(1, None, 5.0), (3, "c", 3.0)], "k long, s string, x double")
    ow = {row["k"]: (row["s"], row["x"]) for row in sinks.upsert_overwrite(t, r, ["k"], ["s", "x"]).collect()}
    co = {row["k"]: (row["s"], row["x"]) for row in sinks.upsert_coalesce(t, r, ["k"], ["s", "x"]).collect()}
    assert ow == {1: (None, 5.0), 2: ("b", 2.0), 3: ("c", 3.0)}
    assert co == {1: ("a", 5.0), 2: ("b", 2.0), 3: ("c", 3.0)}
    inc = sinks.upsert_increment(spark.createDataFrame([(1, 2)], "k long, count long"),
                                 spark.createDataFrame([(1, 3), (2, 1)], "k long, count long"), ["k"])
    assert sorted(map(tuple, inc.collect())) == [(1, 5), (2, 1)]


def test_cosine_topk_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(0)
    q = rng.normal(size=(37, 8))
    d = rng.normal(size=(91, 8))
    qdf = spark.createDataFrame([(i, q[i].tolist()) for i in range(len(q))], "query_id long, embedding array<double>")
    ddf = spark.createDataFrame([(i, d[i].tolist()) for i in range(len(d))], "doc_id long, embedding array<double>")
    got = vx.cosine_topk(qdf, ddf, 3, block_rows=10).collect()
    sim = (q @ d.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(d, axis=1))
    for i in range(len(q)):
        want = list(np.argsort(-sim[i], kind="stable")[:3])
        mine = [r["doc_id"] for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])]
        assert mine == want


def test_similarity_guard_and_context(spark):
    topk = spark.createDataFrame([(1, 10, 1, 0.9, 0.1), (2, 11, 1, 0.2, 0.8)],
                                 "query_id long, doc_id long, rank int, similarity double, distance double")
    qs = spark.createDataFrame([(1,), (2,)], "query_id long")
    meta = spark.createDataFrame([(10, "doc ten", "u10", None, "T"), (11, "doc eleven", "u11", None, "T")],
                                 "doc_id long, doc_text string, url string, published_at timestamp, ticker string")
    ctx = {r["query_id"]: r for r in vx.assemble_context(vx.similarity_guard(topk, qs), meta).collect()}
    assert ctx[1]["status"] == "answered" and ctx[1]["sources"][0]["url"] == "u10"
    assert ctx[2]["status"] == vx.INSUFFICIENT and ctx[2]["sources"] == []


def test_chunk_and_recombine_whole_text(spark):
    text = "x" * 9001
    df = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    ch = tx.chunk_text(df, n=4000).orderBy("chunk_index").collect()
    assert [len(r["chunk"]) for r in ch] == [4000, 4000, 1001]
    assert "".join(r["chunk"] for r in ch) == text
    parts = spark.createDataFrame([(1, 1, "b"), (1, 0, "a"), (1, 2, "")], "doc_id long, chunk_index int, chunk_summary string")
    out = tx.recombine_chunks(parts, ["doc_id"], raw_len=None).collect()
    assert out[0]["summary"] == "a b"


def test_signed_sentiment(spark):
    df = spark.createDataFrame([([("negative", 0.9), ("positive", 0.1)],), ([],)],
                               "s array<struct<label:string,score:double>>")
    got = [r[0] for r in df.select(tx.signed_sentiment("s")).collect()]
    assert got == [-0.9, None]


def test_narrative_lines(spark):
    df = spark.createDataFrame([("TCS", 25.5, 150.75, 5e9, 320.0, 2.5, 2500.0, 1800.0, 24.0)],
                               "s string, pe double, eps double, mc double, bv double, pb double, h double, l double, spe double")
    n = df.select(lb.fundamentals_narrative("s", eps="eps", pe="pe", market_cap="mc", book_value="bv",
                                            price_to_book="pb", high52="h", low52="l", sector_pe="spe")).first()[0]
    assert n.splitlines()[0] == "TCS Financial Summary"
    assert "• P/E Ratio: 25.50x" in n and "• Market Cap: ₹500 Cr" in n and "• 52-Week Low: ₹1800.00" in n
    assert "• EPS (Earnings Per Share): ₹150.75" in n and "• Sector P/E: 24.00x" in n


def test_stored_and_pending_vectors_are_all_articles(spark):
    from ticklake.plans import news as nw
    from ticklake.plans.catalog import REGISTRY, articles
    sf = "/root/testdata/sf0.001"
    ids = lambda df: sorted(r["id"] for r in df.collect())
    everything = sorted(r["content_hash"] for r in tx.dedupe_news(articles(spark, sf)).collect())
    stored = REGISTRY["vector_upsert"](spark, sf)
    assert ids(stored) == everything
    a = spark.createDataFrame([("h1", 1), ("h2", 2), ("h3", None)], "content_hash string, doc_id long")
    a = a.selectExpr("*", "'A' symbol", "'u' url", "timestamp'2024-01-01' published_at", "1.0D sentiment_score",
                     "'head' headline", "'sum' summary")
    v = spark.createDataFrame([(1, [1.0])], "doc_id long, embedding array<double>")
    got = {r["id"]: (r["pending"], r["embedding"]) for r in nw.vector_records(a, v).collect()}
    assert got == {"h1": (False, [1.0]), "h2": (True, None), "h3": (True, None)}


def test_recombined_chunks_hold_the_whole_text(spark):
    """Every character of every document reaches the result, against SQL."""
    import duckdb
    from oracle.queries import SQL
    from ticklake.plans.catalog import REGISTRY
    from ticklake.sources.tables import read_table, table_path
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in REGISTRY["recombine_chunks"](spark, sf).collect()}
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, sf, "documents", "doc_id", "text").collect() if r["text"]}
    assert max(map(len, texts.values())) > 3 * 4000 and set(got) == set(texts)
    for i, t in texts.items():
        assert got[i]["summary"] == " ".join(t[a:a + 4000] for a in range(0, len(t), 4000))
        assert got[i]["raw_text_length"] == len(t)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{table_path(sf, 'documents')}'")
    rows = con.sql(SQL["recombine_chunks"]).fetchall()
    assert sorted(rows) == sorted((r["doc_id"], r["summary"], r["raw_text_length"]) for r in got.values())


def test_call_counter_counts_every_event(spark):
    import duckdb
    from oracle.queries import SQL
    from ticklake.plans.catalog import REGISTRY
    from ticklake.sources.tables import table_path
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, REGISTRY["call_counter"](spark, sf).select("user_id", "count").collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{table_path(sf, 'events')}'")
    assert got == sorted(con.sql(SQL["call_counter"]).fetchall())
    assert sum(n for _, n in got) == con.sql("SELECT count(*) FROM events").fetchall()[0][0]


def test_one_headline_rule_for_storing_and_hashing(spark):
    """Line ends, tabs and a missing headline: what was enriched is not pending again, and no article doubles."""
    from ticklake.plans import news as nw
    from ticklake.sources.fixtures import headline_of
    texts = [(1, "Title A\r\nbody"), (2, "\t Title A \nother"), (3, "Title B\r\n"), (4, None), (5, " \r\nx"), (6, "Title C")]
    d = spark.createDataFrame(texts, "doc_id long, raw_body string")
    d = d.withColumn("headline", headline_of(F.col("raw_body"))).withColumn("content_hash", lb.headline_hash("headline"))
    d = d.selectExpr("*", "'S' symbol", "'en' source", "timestamp_ntz'2024-01-01 00:00:00' published_at", "'u' url",
                     "cast(null as string) summary", "cast(null as double) sentiment_score")
    silver = tx.dedupe_news(d)
    assert sorted((r["headline"], r["doc_id"]) for r in silver.collect()) == [("", 5), ("Title A", 1), ("Title B", 3), ("Title C", 6)]
    assert all(r["content_hash"] == r["h"] for r in silver.select("content_hash", lb.headline_hash("headline").alias("h")).collect())
    scores = silver.select("content_hash", F.lit("sum").alias("summary"), F.lit(0.5).alias("sentiment_score"))
    done = nw.enrich_news(d.filter("headline is not null"), silver.drop("doc_id", "raw_body"), scores)
    assert done.count() == 4 and done.filter("summary is null or sentiment_score is null").count() == 0
    assert nw.unenriched_news(d.filter("headline is not null"), done).count() == 0


def test_cosine_topk_of_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, None), (4, []), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [1.0, 0.0, 0.0]),
            (8, [0.0, 1.0, 0.0]), (9, [0.0, 0.0])]
    v = spark.createDataFrame(rows, "query_id long, embedding array<double>")
    got = {(r["query_id"], r["doc_id"]) for r in
           vx.cosine_topk(v, v.withColumnRenamed("query_id", "doc_id"), 3, exclude_self=True).collect()}
    assert got == {(1, 2), (2, 1), (7, 8), (8, 7)}
    empty = v.limit(0)
    assert vx.cosine_topk(empty, empty.withColumnRenamed("query_id", "doc_id")).count() == 0


def test_running_total_over_partitions(spark):
    from ticklake.operators.ranking import running_total
    rows = [(i, (i * 7) % 5) for i in range(500)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "k long, cost long").repartition(7)
    got = {r["k"]: r["running_total"] for r in running_total(df, [F.col("k").desc()], "cost").collect()}
    total = 0
    for k, c in sorted(rows, reverse=True):
        total += c
        assert got[k] == total


def test_every_fact_is_kept(spark):
    """A fact on, before and between versions, of an unknown company, and on a far day."""
    dim = spark.createDataFrame(
        [(11, 1, 1, dt.date(2000, 1, 1), dt.date(2009, 12, 31)), (12, 1, 2, dt.date(2010, 1, 1), dt.date(2012, 6, 30)),
         (13, 1, 3, dt.date(2013, 1, 1), None)],
        "company_key long, symbol long, version int, effective_from date, effective_to date").withColumn("is_current", F.lit(True))
    days = [(1, dt.date(1999, 12, 31), 0), (1, dt.date(2000, 1, 1), 1), (1, dt.date(2009, 12, 31), 1), (1, dt.date(2010, 1, 1), 2),
            (1, dt.date(2012, 7, 1), 0), (1, dt.date(2013, 1, 1), 3), (1, dt.date(2150, 1, 1), 3), (2, dt.date(2013, 1, 1), 0),
            (None, dt.date(2013, 1, 1), 0)]
    facts = spark.createDataFrame(days, "symbol long, day date, want int")
    got = dims.as_of_version(facts, dim, F.col("day")).collect()
    assert len(got) == len(days) and all(r["company_version"] == r["want"] for r in got)
    assert dims.with_unknown_member(dim).filter("company_key = -1 and version = 0 and not is_current").count() == 1


def test_batches_drain_the_pending_articles(spark):
    from ticklake.plans import news as nw
    s = spark.createDataFrame([(f"h{i}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 7)) for i in range(23)],
                              "content_hash string, published_at timestamp_ntz").withColumn(
        "embedding_updated_at", F.lit(None).cast("timestamp_ntz"))
    rounds = 0
    while (batch := nw.embedding_batch(s, 10)).count():
        s = spark.createDataFrame(nw.mark_processed(s, batch, "2024-02-01").collect(), s.schema)
        rounds += 1
    assert rounds == 3 and s.filter("embedding_updated_at is null").count() == 0


def test_cosine_topk_scores_ties_alike_and_tells_near_vectors_apart(spark):
    """Copies of a vector (also under one id) tie whatever tile they are in, and differences
    below single precision decide; scored in tiles, a block never holds all its scores."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(300, 7))
    v[40:200:3] = v[1]                                          # copies
    for i in range(200, 230):
        v[i] = v[2]
        v[i, 0] += (i - 199) * 1e-10                            # near copies
    v = v.round(12)
    ids = [i if i % 50 else i // 100 * 100 for i in range(300)]  # some ids twice
    rows = [(ids[i], v[i].tolist()) for i in range(300)]
    qdf = spark.createDataFrame(rows + [(None, [1.0] * 7)], "query_id long, embedding array<double>")
    ddf = qdf.withColumnRenamed("query_id", "doc_id")
    top = vx.cosine_topk(qdf, ddf, 3, exclude_self=True)
    best = {}
    for i, q in zip(ids, v):
        for j, d in zip(ids, v):
            if i != j:
                best.setdefault(i, []).append((-(q * d).sum() / (np.linalg.norm(q) * np.linalg.norm(d)), j))
    got = {}
    for r in sorted(top.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    odd = {i for i, s in best.items() if len({round(x, 14) for x, _ in sorted(s)[:4]}) > 1
           and any(0 < b - a < 1e-14 for a, b in zip(sorted(x for x, _ in s)[:3], sorted(x for x, _ in s)[1:4]))}
    assert set(got) == set(best)
    for i, s in best.items():
        if i not in odd:                                        # apart by more than double precision
            assert got[i] == [j for _, j in sorted(s)[:3]], i
    assert got[1] == [40, 43, 46] and len(odd) < 60


def test_local_topk_holds_no_block_of_scores():
    """Memory of a cell is that of its vectors and a tile, not of all its scores."""
    import tracemalloc
    import pyarrow as pa
    v = np.random.default_rng(6).normal(size=(6000, 4))
    t = pa.table({"id": np.arange(6000), "vec": pa.array(v.tolist(), pa.list_(pa.float64()))})
    tracemalloc.start()
    out = vx._local_topk(3, True)(t, t)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.num_rows == 18000 and peak < 6000 * 6000 * 8 / 4
