"""SQL CTE fragments (DuckDB dialect) for the canonical inputs."""

EPS = "1e-9"  # tie shift, same as ticklake.functions.numeric.TIE_EPS


def r(expr: str, d: int) -> str:
    return f"round(({expr}) + {EPS}, {d})"


BARS = """
bars AS (
  SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS trade_date,
         arg_min(l_extendedprice, {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'e': l_extendedprice}) AS open_price,
         max(l_extendedprice) AS high_price, min(l_extendedprice) AS low_price,
         arg_max(l_extendedprice, {'a': l_orderkey, 'b': l_linenumber, 'c': l_partkey, 'e': l_extendedprice}) AS close_price,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem GROUP BY 1, 2
)"""

# Enriched price table (E12) with recursive EMA-20 / Wilder RSI-14.
ENRICHED = BARS + """,
b AS (
  SELECT symbol, trade_date, open_price, high_price, low_price, close_price,
         close_price AS adj_close_price, volume,
         row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS rn,
         lag(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) AS prev_close
  FROM bars WHERE close_price IS NOT NULL AND close_price > 0
),
ema(symbol, rn, e) AS (
  SELECT symbol, 20, sum(close_price) / 20 FROM b WHERE rn <= 20 GROUP BY symbol HAVING count(*) = 20
  UNION ALL
  SELECT b.symbol, b.rn, b.close_price * (2.0::DOUBLE / 21) + ema.e * (1 - 2.0::DOUBLE / 21)
  FROM ema JOIN b ON b.symbol = ema.symbol AND b.rn = ema.rn + 1
),
g AS (
  SELECT symbol, rn, greatest(close_price - prev_close, 0) AS gain,
         greatest(prev_close - close_price, 0) AS loss
  FROM b WHERE rn >= 2
),
rsi(symbol, rn, ag, al) AS (
  SELECT symbol, 15, sum(gain) / 14, sum(loss) / 14 FROM g WHERE rn <= 15 GROUP BY symbol HAVING count(*) = 14
  UNION ALL
  SELECT g.symbol, g.rn, (rsi.ag * 13 + g.gain) / 14, (rsi.al * 13 + g.loss) / 14
  FROM rsi JOIN g ON g.symbol = rsi.symbol AND g.rn = rsi.rn + 1
),
w AS (
  SELECT b.*,
         round((close_price - prev_close) / prev_close + 1e-9, 6) AS daily_return,
         round(ln(close_price / prev_close) + 1e-9, 6) AS log_return,
         CASE WHEN count(*) OVER w20 >= 20 THEN round(avg(close_price) OVER w20 + 1e-9, 4) END AS sma_20,
         CASE WHEN count(*) OVER w50 >= 50 THEN round(avg(close_price) OVER w50 + 1e-9, 4) END AS sma_50,
         CASE WHEN count(*) OVER w200 >= 200 THEN round(avg(close_price) OVER w200 + 1e-9, 4) END AS sma_200,
         max(close_price) OVER w252 AS high_52w,
         min(close_price) OVER w252 AS low_52w
  FROM b
  WINDOW w20 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         w50 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
         w200 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 199 PRECEDING AND CURRENT ROW),
         w252 AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)
),
z AS (
  SELECT w.*, avg(daily_return) OVER (PARTITION BY symbol) AS mr,
         stddev_pop(daily_return) OVER (PARTITION BY symbol) AS sr
  FROM w
),
prices AS (
  SELECT z.symbol, z.trade_date, open_price, high_price, low_price, close_price, adj_close_price, volume,
         daily_return, log_return,
         coalesce(abs((daily_return - coalesce(mr, 0)) / CASE WHEN sr > 0 THEN sr ELSE 1e-9 END) > 4.0, false) AS is_outlier,
         sma_20, sma_50, sma_200,
         round(ema.e + 1e-9, 4) AS ema_20,
         round(CASE WHEN rsi.al = 0 THEN 100.0 ELSE 100 - 100 / (1 + rsi.ag / rsi.al) END + 1e-9, 4) AS rsi_14,
         high_52w, low_52w,
         round(high_52w - low_52w + 1e-9, 4) AS price_range_52w,
         CASE WHEN high_52w <> low_52w
              THEN round(greatest(0.0, least(1.0, (close_price - low_52w) / (high_52w - low_52w))) + 1e-9, 4) END
           AS normalised_close
  FROM z LEFT JOIN ema ON ema.symbol = z.symbol AND ema.rn = z.rn
         LEFT JOIN rsi ON rsi.symbol = z.symbol AND rsi.rn = z.rn
)"""

COMPANIES = """
companies AS (
  SELECT s_suppkey AS symbol, s_name AS company_name, r_name AS sector, n_name AS industry, 'X' AS exchange
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

# SCD2 dimension after the initial load (1995-01-01) and the update (1998-01-01).
DIM = COMPANIES + """,
upd AS (
  SELECT symbol, company_name,
         CASE WHEN symbol % 3 = 0 THEN sector || '_NEW' ELSE sector END AS sector, industry, exchange
  FROM companies WHERE symbol % 3 IN (0, 1)
  UNION ALL
  SELECT symbol + 1000000, company_name, sector, industry, exchange FROM companies WHERE symbol < 5
),
ch AS (
  SELECT c.symbol FROM companies c JOIN upd u USING (symbol)
  WHERE c.company_name IS DISTINCT FROM u.company_name OR c.sector IS DISTINCT FROM u.sector
     OR c.industry IS DISTINCT FROM u.industry OR c.exchange IS DISTINCT FROM u.exchange
),
dim AS (
  SELECT c.symbol, c.company_name, c.sector, c.industry, c.exchange, 1 AS version,
         ch.symbol IS NULL AS is_current, DATE '1995-01-01' AS effective_from,
         CASE WHEN ch.symbol IS NOT NULL THEN DATE '1997-12-31' END AS effective_to
  FROM companies c LEFT JOIN ch USING (symbol)
  UNION ALL
  SELECT u.symbol, u.company_name, u.sector, u.industry, u.exchange, 2, true, DATE '1998-01-01', CAST(NULL AS DATE)
  FROM upd u JOIN ch USING (symbol)
  UNION ALL
  SELECT u.symbol, u.company_name, u.sector, u.industry, u.exchange, 1, true, DATE '1998-01-01', CAST(NULL AS DATE)
  FROM upd u WHERE u.symbol NOT IN (SELECT symbol FROM companies)
)"""

DIM_DATE = """
bd AS (SELECT min(trade_date) AS lo, max(trade_date) AS hi FROM bars),
dd AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
         CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week, isodow(full_date) >= 6 AS is_weekend,
         false AS is_holiday
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS full_date FROM bd)
)"""

FACTS = """
facts AS (
  SELECT CAST(strftime(p.trade_date, '%Y%m%d') AS INTEGER) AS date_key, p.symbol, p.trade_date,
         p.open_price, p.high_price, p.low_price, p.close_price, p.adj_close_price, p.volume,
         p.daily_return, coalesce(d.version, 0) AS company_version
  FROM prices p LEFT JOIN dim d ON d.symbol = p.symbol
   AND p.trade_date BETWEEN d.effective_from AND coalesce(d.effective_to, DATE '9999-12-31')
)"""

FUNDAMENTALS = """
fq AS (
  SELECT l_suppkey AS symbol,
         CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTHS - INTERVAL 1 DAY AS DATE) AS report_period,
         l_extendedprice AS x, l_quantity AS y
  FROM lineitem
),
fund AS (
  SELECT symbol, report_period, metric_name, round(metric_value + 1e-9, 2) AS metric_value
  FROM (SELECT symbol, report_period, sum(x) AS marketCap, avg(y) AS pe, max(x) AS high52, min(x) AS low52
        FROM fq GROUP BY ALL)
  UNPIVOT (metric_value FOR metric_name IN (marketCap, pe, high52, low52))
),
promoted AS (
  SELECT symbol, report_period, metric_name, metric_value FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, metric_name
                                 ORDER BY report_period DESC, metric_value DESC) AS rn_ FROM fund)
  WHERE rn_ = 1
)"""

NEWS = """
news AS (
  SELECT sha256(regexp_replace(split_part(d.text, chr(10), 1), '^\\s+|\\s+$', '', 'g')) AS content_hash, d.source AS symbol,
         regexp_replace(split_part(d.text, chr(10), 1), '^\\s+|\\s+$', '', 'g') AS headline, d.lang AS source,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(d.doc_id * 20 AS INTEGER)) AS published_at,
         'https://news.invalid/' || CAST(d.doc_id AS VARCHAR) AS url, d.text AS raw_body,
         nullif(trim(split_part(d.text, chr(10), 2)), '') AS summary,
         CAST((l.quality - l.toxic) * 0.5 AS DOUBLE) AS sentiment_score, d.doc_id
  FROM documents d LEFT JOIN labels l USING (doc_id)
),
dedup AS (
  SELECT * EXCLUDE (rn_) FROM (
    SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY published_at, doc_id) AS rn_ FROM news)
  WHERE rn_ = 1
),
silver0 AS (
  SELECT content_hash, symbol, headline, source, published_at, url, CAST(NULL AS VARCHAR) AS summary,
         CAST(NULL AS DOUBLE) AS sentiment_score, CAST(NULL AS TIMESTAMP) AS embedding_updated_at
  FROM dedup
),
pending AS (
  SELECT n.* FROM news n LEFT JOIN silver0 s USING (content_hash)
  WHERE s.content_hash IS NULL OR s.summary IS NULL OR s.sentiment_score IS NULL
)"""

TOP3 = """
e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS doc_id,
         list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS sim
  FROM e a JOIN e b ON a.vec_id <> b.vec_id
),
top3 AS (
  SELECT query_id, doc_id, CAST(rank AS INTEGER) AS rank, round(sim + 1e-9, 6) AS similarity,
         round(1 - sim + 1e-9, 6) AS distance
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, doc_id) AS rank FROM pairs)
  WHERE rank <= 3
)"""

MESSAGES = """
msg AS (
  SELECT event_id, user_id, ts, value,
         CASE WHEN event_id % 10 = 0 THEN 0.0 ELSE value END AS close_v
  FROM events
),
valid AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trade_date, value AS "open",
         value AS high, value AS low, close_v AS "close", 0.0::DOUBLE AS adj_close, CAST(100 AS BIGINT) AS volume,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
  FROM msg WHERE event_id % 10 <> 1 AND close_v > 0
)"""

QUOTES = """
lastbar AS (
  SELECT * FROM (SELECT symbol, trade_date, close_price,
                        row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS rn_ FROM bars)
  WHERE rn_ = 1
),
q AS (
  SELECT symbol,
         CASE WHEN symbol % 2 = 0 THEN close_price * 1.01 END AS live_price,
         close_price AS prev_close,
         CASE WHEN symbol % 2 = 0 THEN (close_price * 1.01 - close_price) / close_price * 100 ELSE 0.0 END AS change_pct,
         CASE WHEN symbol % 4 = 0 THEN close_price * 1e6 END AS market_cap,
         CASE WHEN symbol % 4 = 0 THEN 20.0::DOUBLE END AS trailing_pe,
         CASE WHEN symbol % 4 = 0 THEN 2.5::DOUBLE END AS price_to_book,
         CASE WHEN symbol % 4 = 0 THEN close_price * 1.5 END AS fifty_two_week_high,
         CASE WHEN symbol % 4 = 0 THEN close_price * 0.5 END AS fifty_two_week_low
  FROM lastbar
)"""

SUMMARY = """
lb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS rn_
                      FROM prices) WHERE rn_ = 1),
pv AS (SELECT symbol,
         max(metric_value) FILTER (WHERE metric_name IN ('marketCap')) AS market_cap,
         max(metric_value) FILTER (WHERE metric_name IN ('trailingPE', 'pe')) AS trailing_pe,
         max(metric_value) FILTER (WHERE metric_name IN ('priceToBook')) AS price_to_book,
         max(metric_value) FILTER (WHERE metric_name IN ('debtToEquity')) AS debt_to_equity,
         max(metric_value) FILTER (WHERE metric_name IN ('returnOnEquity')) AS return_on_equity,
         max(metric_value) FILTER (WHERE metric_name IN ('dividendYield')) AS dividend_yield,
         max(metric_value) FILTER (WHERE metric_name IN ('high52')) AS fifty_two_week_high,
         max(metric_value) FILTER (WHERE metric_name IN ('low52')) AS fifty_two_week_low
       FROM promoted GROUP BY symbol),
ss AS (SELECT lb.symbol, lb.trade_date AS as_of_date, close_price, daily_return, normalised_close, sma_20, sma_50,
              rsi_14, pv.* EXCLUDE (symbol)
       FROM lb LEFT JOIN pv ON pv.symbol = lb.symbol)"""
