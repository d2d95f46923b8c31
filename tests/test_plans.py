"""Plan-shape checks: the properties the scale design relies on."""

import datetime as dt
import re

from pyspark.sql import functions as F

from ticklake.operators import indicators as ind
from ticklake.operators.ranking import latest_per_key
from ticklake.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_aggregate_partially_before_the_shuffle(spark):
    from ticklake.sources import fixtures as fx
    p = plan_of(fx.bars(spark, SF))
    assert "partial_min_by" in p and "partial_sum" in p


def test_indicators_never_gather_a_symbol(spark):
    """Bars move once, on (symbol, block); what moves on the symbol alone is
    the blocks' summaries; no Python, no second read of the bars."""
    df = REGISTRY["enriched_prices"](spark, SF)
    df.collect()
    p = plan_of(df).split("Initial Plan")[0]
    assert "FlatMapGroups" not in p and "ArrowEval" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert p.count("FileScan parquet [l_") == 1 and "ReusedExchange" in p
    lines = p.splitlines()
    alone = [i for i, line in enumerate(lines) if re.search(r"Exchange hashpartitioning\(symbol#\d+L, \d+\)", line)]
    assert len(alone) == 1
    below = next(line for line in lines[alone[0] + 1:] if "Aggregate(" in line)
    assert re.search(r"keys=\[symbol#\d+L, _b#\d+\]", below)          # a row a block, not a row a bar


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    p = plan_of(latest_per_key(df, ["k"], ["v"]))
    assert "Window" not in p and "partial_max_by" in p


def test_no_registered_query_builds_a_cartesian_product(spark):
    for name in ("cosine_topk", "similarity_guard", "integrity_report", "sector_momentum", "portfolio_risk"):
        p = plan_of(REGISTRY[name](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_hot_symbol_is_still_exact(spark):
    """A third of all rows on one symbol: results equal a per-symbol rebuild."""
    rows = []
    for day in range(300):
        rows.append((1, day, 100.0 + day % 17))
        rows.append((2, day, 50.0 + day % 7))
        rows.append((3, day, 20.0 + day % 5))
    df = spark.createDataFrame(rows, "symbol long, d int, close_price double").select(
        "symbol", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")).alias("trade_date"),
        *[F.col("close_price").alias(c) for c in ("open_price", "high_price", "low_price", "close_price")],
        F.lit(1).cast("long").alias("volume"))
    all_syms = ind.enrich_bars(df).filter("symbol = 1").orderBy("trade_date").collect()
    alone = ind.enrich_bars(df.filter("symbol = 1")).orderBy("trade_date").collect()
    assert all_syms == alone


def test_recent_dates_do_not_rebuild_the_bars(spark):
    """D3 / D5 read lineitem once: the newest-dates list is a literal table
    (built from a date-filtered scan), not a second OHLCV aggregate.  D5
    reads its rows twice (market mean, then symbols); the plan that ran has
    the second read from the first one's exchange."""
    for name in ("sector_momentum", "portfolio_risk"):
        df = REGISTRY[name](spark, SF)
        df.collect()
        ran = plan_of(df).split("Initial Plan")[0]
        assert ran.count("FileScan parquet [l_") == 1 and "ReusedExchange" in ran, name


def test_risk_and_moments_run_no_python(spark):
    from ticklake.plans.catalog import REGISTRY
    for name in ("portfolio_risk", "market_proxy", "return_moments", "quote_metrics"):
        plan = REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "FlatMapGroups" not in plan, name


def test_append_live_bar_builds_the_bars_once(spark, tmp_path, monkeypatch):
    from ticklake.plans import catalog, live
    from ticklake.sources import fixtures as fx
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    rows = [(o, 1, o, s, 100.0 + 3 * s + o % 7, float(o), day(o // 2 + s)) for s in (1, 2, 3, 6) for o in range(40)]
    rows += [(90, 1, 1, 2, 0.0, 1.0, day(60)), (91, 1, 1, 4, None, 1.0, day(5)), (92, 2, 1, 3, 7.0, 1.0, None),
             (3, 1, 3, 1, 50.0, None, day(2)), (2, 2, None, 1, 51.0, 1.0, day(2))]
    names = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double"
    spark.createDataFrame(rows, names + ", l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    # first and last price of a day by order, repeats and nulls included
    expected = {}
    for r in rows:
        expected.setdefault((r[3], r[6] and r[6].date()), []).append(r)
    low_first = lambda r: [(x is not None, x or 0) for x in (r[0], r[1], r[2], r[4])]
    bars = {(r.symbol, r.trade_date): (r.open_price, r.close_price) for r in fx.bars(spark, str(tmp_path)).collect()}
    assert bars == {k: (min(v, key=low_first)[4], max(v, key=low_first)[4]) for k, v in expected.items()}
    # the query as it reads without a stored table
    last = live.last_closes(catalog.clean_bars(spark, str(tmp_path)))
    plain = live.append_live_bar(catalog.prices(spark, str(tmp_path)), live.quotes_from_bars(fx.bars(spark, str(tmp_path))),
                                 last.agg(F.date_add(F.max("trade_date"), 1)).scalar(), last)
    built, real = [], fx.bars
    monkeypatch.setattr(fx, "bars", lambda *a, **k: built.append(1) or real(*a, **k))
    got = catalog.REGISTRY["append_live_bar"](spark, str(tmp_path))
    assert len(built) == 1 and not [f for f in got.inputFiles() if "lineitem" in f]
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert got.filter("volume = 0").count() == 1          # symbol 6; the newest bar of symbol 2 has price 0
