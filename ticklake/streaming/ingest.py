"""Bronze ingest as Structured Streaming.

One source scan feeds both sinks: ``foreachBatch`` persists the parsed
micro-batch once and writes the valid rows to bronze and the rejected rows
to the dead-letter table.  ``foreachBatch`` is at-least-once, so each
write is keyed by the batch id: the batch id is the last partition level
and the write is a dynamic partition overwrite, so a retried batch replaces
its own files instead of appending twice.

After both sinks a commit record is written: one row a sink with the rows it
took, which is the batch's audit as well.  ``read_committed`` leaves out
batches without one, so no reader sees a batch that is in one sink only; a
failed attempt leaves a row in the failure log and goes on to the caller.
Checkpoints live under the caller-supplied (shared) folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.functions.clean import (
    add_date_columns, canonical_symbol, decode_price_json, split_valid_dead, valid_condition)
from ticklake.sources.prices import read_price_batch, read_price_stream
from ticklake.sources.sinks import BRONZE_PARTITIONS, MICRO_BATCH, clustered, path_exists, write_bronze_batch

BATCH_COL = "batch_id"
WATERMARK = "1 day"


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """B2 + B3 (+ B1 on the ticker): raw messages -> typed bronze rows."""
    return (add_date_columns(decode_price_json(raw, value))
            .withColumn("ticker", canonical_symbol("ticker")))


COMMITS = "batch_id bigint, sink string, rows bigint, max_event_time timestamp, recorded_at timestamp"
FAILURES = "batch_id bigint, error string, recorded_at timestamp"


def commits_of(path: str) -> str:
    """Where the commit records of a sink's batches lie unless told otherwise."""
    return path.rstrip("/") + "_commits"


def _put(df: DataFrame, path: str, *partitions: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partitions, BATCH_COL).parquet(path))


def commit_batch(spark: SparkSession, path: str, batch_id: int, rows: dict[str, int], max_event_time=None) -> None:
    """The record that a batch is whole in every sink: one file, replaced if the batch is retried."""
    records = spark.createDataFrame([(batch_id, k, n, max_event_time) for k, n in rows.items()],
                                    "batch_id bigint, sink string, rows bigint, max_event_time timestamp")
    _put(records.withColumn("recorded_at", F.current_timestamp()).coalesce(1), path)


def read_commits(spark: SparkSession, path: str) -> DataFrame:
    """The commit records: (batch_id, sink, rows, max_event_time, recorded_at)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], COMMITS)
    return spark.read.schema(COMMITS).parquet(path)


def read_committed(spark: SparkSession, path: str, commits: str, schema=None) -> DataFrame:
    """A sink's rows of the batches that have a commit record."""
    reader = spark.read.schema(schema) if schema else spark.read
    done = read_commits(spark, commits).select(BATCH_COL).distinct()
    return reader.parquet(path).join(done, BATCH_COL, "left_semi")


def stream_audit(spark: SparkSession, commits: str) -> DataFrame:
    """K10 for streams: a row a batch and sink, and a row a failed attempt."""
    good = read_commits(spark, commits).select(BATCH_COL, "sink", F.lit("success").alias("status"), "rows",
                                               F.lit(None).cast("string").alias("error"))
    failed = commits + "_failed"
    if not path_exists(spark, failed):
        return good
    return good.unionByName(spark.read.schema(FAILURES).parquet(failed).select(
        BATCH_COL, F.lit(None).cast("string").alias("sink"), F.lit("failed").alias("status"),
        F.lit(0).cast("bigint").alias("rows"), "error"))


def _noted(spark: SparkSession, commits: str, batch_id: int, action: Callable[[], None]) -> None:
    """Run a batch; what it raises goes into the failure log and on to the caller."""
    try:
        action()
    except Exception as e:
        note = spark.createDataFrame([(batch_id, f"{type(e).__name__}: {e}"[:1000])], "batch_id bigint, error string")
        note.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(commits + "_failed")
        raise


def _write_batch(bronze_path: str, dead_path: str, commits: str | None = None,
                 after_sink: Callable[[str, int], None] = lambda sink, batch_id: None):
    """``after_sink`` is called with each sink's name once it is written."""
    commits = commits or commits_of(bronze_path)

    def fn(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch).withColumn(BATCH_COL, F.lit(batch_id)).persist()

        def write() -> None:
            valid, dead = split_valid_dead(parsed)
            _put(clustered(valid), bronze_path, *BRONZE_PARTITIONS)
            after_sink("bronze", batch_id)
            _put(dead, dead_path)
            after_sink("dead", batch_id)
            ok = F.coalesce(valid_condition(), F.lit(False))
            n = parsed.agg(F.count_if(ok).alias("bronze"), F.count_if(~ok).alias("dead"),
                           F.max("ingested_at").alias("t")).first()
            commit_batch(batch.sparkSession, commits, batch_id, {"bronze": n["bronze"], "dead": n["dead"]}, n["t"])
        try:
            _noted(batch.sparkSession, commits, batch_id, write)
        finally:
            parsed.unpersist()
    return fn


def bronze_ingest(spark: SparkSession, source: dict, bronze_path: str, dead_path: str,
                  checkpoint: str, trigger: dict | None = None, commits: str | None = None,
                  after_sink: Callable[[str, int], None] = lambda sink, batch_id: None):
    """Stream -> parse -> split -> bronze + dead letter (one query, one
    checkpoint).  ``trigger`` defaults to a 30 s micro-batch; pass
    ``{"availableNow": True}`` for a bounded run (I2)."""
    raw = read_price_stream(spark, source)
    return (raw.writeStream.foreachBatch(_write_batch(bronze_path, dead_path, commits, after_sink))
               .option("checkpointLocation", checkpoint)
               .trigger(**(trigger or {"processingTime": MICRO_BATCH}))
               .start())


def bronze_backfill(spark: SparkSession, source: dict, bronze_path: str, dead_path: str,
                    checkpoint: str) -> None:
    """Bounded run of I1 (``availableNow``); unlike the reference's batch
    path the dead letters are kept."""
    q = bronze_ingest(spark, source, bronze_path, dead_path, checkpoint, {"availableNow": True})
    q.awaitTermination()


def ingest_price_batch(spark: SparkSession, source: dict, bronze_path: str, dead_path: str) -> int:
    """A2: one bounded run from earliest to latest; returns the rows written
    to bronze.  Without a row it writes nothing and returns 0."""
    parsed = parse_messages(read_price_batch(spark, source)).persist()
    try:
        valid, dead = split_valid_dead(parsed)
        ok = F.coalesce(valid_condition(), F.lit(False))
        n = parsed.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("dead")).first()
        if n["valid"]:
            write_bronze_batch(valid, bronze_path)
        if n["dead"]:
            dead.write.mode("append").parquet(dead_path)
        return n["valid"]
    finally:
        parsed.unpersist()


def dedupe_messages(parsed: DataFrame, keys=("ticker", "trade_date"), event_time: str = "ingested_at",
                    watermark: str = WATERMARK) -> DataFrame:
    """Drop repeated (ticker, trade_date) messages within the watermark
    (stateful in a stream; plain de-duplication on a batch frame)."""
    if not parsed.isStreaming:
        return parsed.dropDuplicates(list(keys))
    return (parsed.withColumn(event_time, F.col(event_time).cast("timestamp"))
                  .withWatermark(event_time, watermark)
                  .dropDuplicatesWithinWatermark(list(keys)))


def dedupe_stream_to(spark: SparkSession, source: dict, path: str, checkpoint: str,
                     keys=("ticker", "trade_date")) -> None:
    """I3 as a bounded stream: whole valid messages, one per ``keys``,
    appended to ``path`` (parquet)."""
    parsed = parse_messages(read_price_stream(spark, source))
    valid, _ = split_valid_dead(parsed)
    out = dedupe_messages(valid, keys)
    q = (out.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


# ---------------------------------------------------------------- de-duplication that accounts for every row
def _split_batch(parsed: DataFrame, seen: DataFrame, behind: Column, keys: list[str], event_time: str) -> DataFrame:
    """Rows of a micro-batch with their ``verdict``: invalid, late, duplicate
    (of a row kept before, or of an earlier one of the batch) or kept; ``copies``
    rows stand behind a duplicate, and ``newest`` is the latest event time behind a row."""
    ok = F.coalesce(valid_condition(), F.lit(False))
    rest = [F.col(c) for c in parsed.columns if c not in (*keys, event_time)]
    state = F.when(~ok, "invalid").when(F.coalesce(behind, F.lit(False)), "late").otherwise("kept")
    rows = parsed.withColumn("verdict", state)
    kept = rows.filter(F.col("verdict") == "kept").withColumn("_row", F.struct(event_time, *rest))
    # one row a key: the earliest; the number of the others is all that is needed of them
    first = kept.groupBy(*keys).agg(F.min("_row").alias("_row"), F.count("*").alias("_n"),
                                   F.max(event_time).alias("newest"))
    old = seen.select(*keys).distinct().withColumn("_old", F.lit(True))
    first = first.join(old, keys, "left")
    take = F.when(F.col("_old"), 0).otherwise(1)
    out = first.select(*keys, "_row.*", F.when(take == 1, "kept").otherwise("duplicate").alias("verdict"),
                       F.when(take == 1, 1).otherwise(F.col("_n")).alias("copies"), "newest")
    more = first.filter((take == 1) & (F.col("_n") > 1)).select(
        *keys, "_row.*", F.lit("duplicate").alias("verdict"), (F.col("_n") - 1).alias("copies"), "newest")
    bad = rows.filter(F.col("verdict") != "kept").withColumns(
        {"copies": F.lit(1).cast("bigint"), "newest": F.col(event_time)})
    return bad.unionByName(out).unionByName(more)


def dedupe_ingest(spark: SparkSession, source: dict, path: str, dead_path: str, checkpoint: str,
                  keys=("ticker", "trade_date"), event_time: str = "ingested_at", watermark: str = WATERMARK,
                  trigger: dict | None = None):
    """I3 with every row accounted for: ``path`` gets the first message of
    each key, ``dead_path`` the invalid ones and those that come after the
    watermark (``reason``), and the commit record of each batch the numbers of
    kept, duplicate, late and invalid rows, whose sum is the batch.

    The state is what is stored: the watermark lies ``watermark`` behind the
    newest event time of the committed batches before, and keys are looked up
    in those of them that reach past it.  A batch that is retried so finds
    the state it found before, and no state store has to be kept."""
    commits, keys = commits_of(path), list(keys)

    def fn(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        parsed = parse_messages(batch)
        before = read_commits(s, commits).filter((F.col(BATCH_COL) < batch_id) & (F.col("sink") == "kept"))
        line = before.agg((F.max("max_event_time") - F.expr(f"INTERVAL {watermark}")).alias("t")).first()["t"]
        behind, seen = F.lit(False), s.createDataFrame([], parsed.select(*keys).schema)
        if line is not None:
            behind = F.col(event_time) < F.lit(line)
            live = [r[0] for r in before.filter(F.col("max_event_time") >= F.lit(line)).select(BATCH_COL).collect()]
            if path_exists(s, path):                         # as many batches as the watermark spans
                seen = s.read.parquet(path).filter(F.col(BATCH_COL).isin(live))
        split = _split_batch(parsed, seen, behind, keys, event_time).withColumn(BATCH_COL, F.lit(batch_id)).persist()

        def write() -> None:
            _put(clustered(split.filter("verdict = 'kept'").drop("verdict", "copies", "newest")), path, *BRONZE_PARTITIONS)
            dead = split.filter(F.col("verdict").isin("late", "invalid")).withColumnRenamed("verdict", "reason")
            _put(dead.drop("copies", "newest"), dead_path)
            found = split.groupBy("verdict").agg(F.sum("copies").alias("n"), F.max("newest").alias("t")).collect()
            n = {r["verdict"]: r["n"] for r in found}
            newest = max((r["t"] for r in found if r["verdict"] != "invalid" and r["t"] is not None), default=None)
            commit_batch(s, commits, batch_id, {v: n.get(v, 0) for v in ("kept", "duplicate", "late", "invalid")}, newest)
        try:
            _noted(s, commits, batch_id, write)
        finally:
            split.unpersist()

    return (read_price_stream(spark, source).writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": MICRO_BATCH})).start())
