"""Price sources (A1, A2, A6, A12, A13, A14, A16) and the message fixture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.functions.clean import safe_float
from ticklake.sources import pricelog
from ticklake.sources.tables import read_table


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:  # noqa: BLE001
        return False


def read_price_stream(spark: SparkSession, options: dict) -> DataFrame:
    """A1: unbounded scan of price messages exposing a ``value`` column.

    Kafka when its connector is on the classpath, or the log folder of
    ``sources.pricelog`` (format ``log``): earliest offsets, lost offsets
    tolerated; otherwise a text-file stream over ``options['path']`` with the
    same single ``value`` contract.
    """
    if options.get("format") == "log":
        pricelog.register(spark)
        return spark.readStream.format("price_log").options(**{k: str(v) for k, v in options.items() if k != "format"}).load()
    if options.get("format", "kafka") == "kafka" and kafka_available(spark):
        return (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", options["bootstrap"])
                .option("subscribe", options["topic"])
                .option("startingOffsets", "earliest")
                .option("failOnDataLoss", "false")
                .load().select(F.col("key").cast("string").alias("key"), "value"))
    reader = spark.readStream.format("text")
    if options.get("max_files_per_trigger"):
        reader = reader.option("maxFilesPerTrigger", str(options["max_files_per_trigger"]))
    return reader.load(options["path"])


def read_price_batch(spark: SparkSession, options: dict) -> DataFrame:
    """A2: bounded scan (earliest -> latest) with the same contract as A1."""
    if options.get("format") == "log":
        pricelog.register(spark)
        return spark.read.format("price_log").options(**{k: str(v) for k, v in options.items() if k != "format"}).load()
    if options.get("format", "kafka") == "kafka" and kafka_available(spark):
        return (spark.read.format("kafka")
                .option("kafka.bootstrap.servers", options["bootstrap"])
                .option("subscribe", options["topic"])
                .option("startingOffsets", "earliest").option("endingOffsets", "latest")
                .load().select(F.col("key").cast("string").alias("key"), "value"))
    return spark.read.format("text").load(options["path"])


BRONZE_PRICE_COLUMNS = {
    "ticker": "string", "trade_date": "date", "open": "double", "high": "double",
    "low": "double", "close": "double", "adj_close": "double", "volume": "bigint",
    "ingested_at": "timestamp",
}


def read_bronze_prices(spark: SparkSession, path: str) -> DataFrame:
    """Lake scan with a typed projection (pruning and pushdown built in)."""
    df = spark.read.parquet(path)
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in BRONZE_PRICE_COLUMNS.items()])


def normalise_ohlcv(df: DataFrame, date_col: str = "Date", keep=()) -> DataFrame:
    """Vendor OHLCV frame -> (trade_date, open, high, low, close,
    adj_close, volume).  Renames the date column, casts it to date, fills
    ``adj_close`` from ``close`` when missing and turns NaN into NULL."""
    def num(c):
        x = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(x), x)
    adj = num("Adj Close") if "Adj Close" in df.columns else F.lit(None).cast("double")
    out = df.select(
        *keep,
        F.to_date(F.col(f"`{date_col}`")).alias("trade_date"),
        num("Open").alias("open"), num("High").alias("high"), num("Low").alias("low"),
        num("Close").alias("close"), F.coalesce(adj, num("Close")).alias("adj_close"),
        F.col("Volume").cast("bigint").alias("volume"))
    return out


# Quote document fields -> metric names.
QUOTE_METRIC_PATHS = {
    "high52": "priceInfo.weekHighLow.max",
    "low52": "priceInfo.weekHighLow.min",
    "pChange365d": "priceInfo.pChange365d",
    "pChange30d": "priceInfo.pChange30d",
    "pe": "priceInfo.pe",
    "eps": "priceInfo.eps",
    "bookValue": "priceInfo.bookValue",
    "priceToBook": "priceInfo.pbRatio",
    "marketCap": "metadata.marketCap",
    "faceValue": "securityInfo.faceValue",
    "industryPE": "metadata.pdSectorInd",
    "deliveryToTradedQty": "tradeInfo.deliveryToTradedQuantity",
}


def _leaves(prefix: str) -> T.StructType:
    """The part of the document under a path that the metrics read, as text."""
    names = dict.fromkeys(p[len(prefix):].split(".")[0] for p in QUOTE_METRIC_PATHS.values() if p.startswith(prefix))
    return T.StructType([T.StructField(n, T.StringType() if prefix + n in QUOTE_METRIC_PATHS.values()
                                       else _leaves(f"{prefix}{n}.")) for n in names])


QUOTE_SCHEMA = _leaves("")


def quote_json_to_metrics(df: DataFrame, json_col: str = "quote_json",
                          keys=("symbol", "report_period")) -> DataFrame:
    """Nested quote document -> EAV rows (metric_name, metric_value).

    ``from_json`` with an explicit schema reads every leaf as text, B6 turns
    '', '-' and junk into NULL, ``unpivot`` makes the long form and NULLs are
    dropped.  Pure projection: no shuffle.
    """
    q = df.select(*keys, F.from_json(F.col(json_col), QUOTE_SCHEMA).alias("q"))
    wide = q.select(*keys, *[safe_float(F.col("q." + p)).alias(m) for m, p in QUOTE_METRIC_PATHS.items()])
    long = wide.unpivot(list(keys), list(QUOTE_METRIC_PATHS), "metric_name", "metric_value")
    return long.filter(F.col("metric_value").isNotNull())


def encode_price_message(df: DataFrame, key: str = "ticker", keep=()) -> DataFrame:
    """Bar rows -> (key, value) JSON messages; missing numbers become 0."""
    num = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    body = F.struct(
        F.col("ticker").cast("string").alias("ticker"),
        F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
        num("open").alias("open"), num("high").alias("high"), num("low").alias("low"),
        num("close").alias("close"), num("adj_close").alias("adj_close"),
        F.coalesce(F.col("volume").cast("bigint"), F.lit(0)).alias("volume"),
        F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("ingested_at"))
    return df.select(*keep, F.col(key).cast("string").alias("key"), F.to_json(body).alias("value"))


def history_plus_today(history: DataFrame, today: DataFrame, as_of,
                       keys=("symbol", "trade_date")) -> DataFrame:
    """History clipped to dates before ``as_of`` plus today's bar.

    A deterministic dedupe on the key keeps today's row when both carry it.
    """
    as_of_c = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    h = history.filter(F.col("trade_date") < as_of_c).withColumn("_src", F.lit(0))
    t = today.withColumn("_src", F.lit(1))
    both = h.unionByName(t, allowMissingColumns=True)
    from ticklake.operators.ranking import latest_per_key
    return latest_per_key(both, list(keys), ["_src"]).drop("_src")


def messages(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    """Price messages (key, value) from ``events``: one bar per event
    (``keep``: columns of the event to carry along).

    ticker ``U<user_id>.NS``, trade_date = event day, close = value; every
    tenth event (event_id % 10 = 0) carries close 0 and every tenth shifted by
    one (event_id % 10 = 1) is malformed text, so the stream has dead letters.
    """
    e = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value")
    bars = e.select(
        "event_id", *keep,
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit(".NS")).alias("ticker"),
        F.to_date("ts").alias("trade_date"),
        F.col("value").alias("open"), F.col("value").alias("high"), F.col("value").alias("low"),
        F.when(F.pmod("event_id", F.lit(10)) == 0, F.lit(0.0)).otherwise(F.col("value")).alias("close"),
        F.lit(None).cast("double").alias("adj_close"),
        F.lit(100).cast("bigint").alias("volume"),
        F.col("ts").cast("timestamp").alias("ingested_at"))
    enc = encode_price_message(bars, keep=("event_id", *keep))
    value = F.when(F.pmod("event_id", F.lit(10)) == 1, F.lit("{bad")).otherwise(F.col("value"))
    return enc.select("event_id", *keep, "key", value.alias("value"))
