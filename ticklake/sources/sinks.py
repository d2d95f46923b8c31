"""Sinks and upserts.

Every upsert is expressed twice: as a DataFrame function that returns the
merged table (testable, lazy) and, where it writes, as a function that
writes it.  Without Delta Lake on the classpath a MERGE becomes: compute
the merged rows of the touched partitions, stage them in the shared
checkpoint folder, then dynamic-partition-overwrite the target (a path is
never overwritten while it is being read).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.session import materialize, scratch_path

BRONZE_PARTITIONS = ("year", "month")   # one layout for stream and batch; rows of a ticker lie together
MICRO_BATCH = "30 seconds"


# ---------------------------------------------------------------- streaming sinks
def write_bronze_stream(df: DataFrame, path: str, checkpoint: str,
                        trigger: dict | None = None):
    """A3: append sink partitioned by year and month; checkpointed."""
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("path", path).option("checkpointLocation", checkpoint)
           .partitionBy(*BRONZE_PARTITIONS))
    return w.trigger(**(trigger or {"processingTime": MICRO_BATCH})).start()


def write_dead_letter_stream(df: DataFrame, path: str, checkpoint: str,
                             trigger: dict | None = None):
    """A4: append sink for rejected rows with its own checkpoint."""
    w = (df.writeStream.format("parquet").outputMode("append")
           .option("path", path).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": MICRO_BATCH})).start()


def clustered(df: DataFrame) -> DataFrame:
    """Rows of a month and ticker together and in order, so that a folder
    holds few files and a ticker filter skips row groups.  Ranges, not
    hashes: a busy month is split over several tasks."""
    key = [*BRONZE_PARTITIONS, "ticker", "trade_date"]
    return df.repartitionByRange(*key).sortWithinPartitions(*key)


def write_bronze_batch(df: DataFrame, path: str) -> None:
    """A5: append, same layout as the stream."""
    clustered(df).write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Report download (header row, one folder of part files)."""
    df.write.mode("overwrite").option("header", "true").csv(path)


# ---------------------------------------------------------------- merge logic
def dedupe_on_keys(rows: DataFrame, keys: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """One row per key; the greatest ``order`` wins (all columns when not given)."""
    from ticklake.operators.ranking import latest_per_key
    rest = [c for c in rows.columns if c not in keys]
    return latest_per_key(rows, keys, list(order) if order else rest)


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update-all / insert-all on ``keys`` (MERGE semantics).

    Target rows whose key is updated are dropped with a left-anti join and
    the (deduplicated) updates are appended: one shuffle on the keys.
    """
    u = dedupe_on_keys(updates, keys)
    keep = target.join(u.select(*keys), list(keys), "left_anti")
    return keep.unionByName(u, allowMissingColumns=True)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                  order: Sequence | None = None) -> DataFrame:
    """ON CONFLICT DO NOTHING: existing rows win, only new keys are added;
    among new rows sharing a key the first in ``order`` wins (as a row-by-row
    insert would keep the first)."""
    from ticklake.operators.text import first_per_key
    rest = [c for c in rows.columns if c not in keys]
    r = first_per_key(rows, keys, list(order) if order else rest)
    new = r.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def _merge_columns(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                   cols: Sequence[str], mode: str, coalesce_cols: Sequence[str] = ()) -> DataFrame:
    r = dedupe_on_keys(rows, keys).withColumn("_r", F.lit(True))
    t = target.withColumn("_t", F.lit(True))
    j = t.alias("t").join(r.alias("r"), list(keys), "full_outer")
    has_t = F.col("_t").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        tc = F.col(f"t.{c}")
        rc = F.col(f"r.{c}") if c in rows.columns else F.lit(None).cast(target.schema[c].dataType)
        if c in coalesce_cols:
            v = F.coalesce(rc, tc)
        elif c in cols:
            if mode == "overwrite":
                v = F.when(F.col("_r").isNotNull(), rc).otherwise(tc)
            else:
                v = F.coalesce(rc, tc)
        else:
            v = F.when(has_t, tc).otherwise(rc)
        out.append(v.alias(c))
    return j.select(*out)


def upsert_overwrite(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                     cols: Sequence[str]) -> DataFrame:
    """A10: on key match replace the listed columns; new keys are inserted whole.

    A full outer join on the keys (both sides unique on the keys, so no
    skew from duplicates).
    """
    return _merge_columns(target, rows, keys, cols, "overwrite")


def upsert_coalesce(target: DataFrame, rows: DataFrame, keys: Sequence[str],
                    cols: Sequence[str]) -> DataFrame:
    """On key match a listed column takes the new value only if non-NULL."""
    return _merge_columns(target, rows, keys, cols, "coalesce")


def upsert_gold_summary(target: DataFrame, rows: DataFrame, key: str = "symbol",
                        price_cols: Sequence[str] = ("as_of_date", "close_price", "daily_return",
                                                     "normalised_close", "sma_20", "sma_50", "rsi_14"),
                        fundamental_cols: Sequence[str] = ()) -> DataFrame:
    """Price columns overwritten, fundamental columns kept unless a new
    non-NULL value arrives (COALESCE(new, old))."""
    return _merge_columns(target, rows, [key], price_cols, "overwrite", fundamental_cols)


def upsert_increment(target: DataFrame, deltas: DataFrame, keys: Sequence[str],
                     col: str = "count") -> DataFrame:
    """Insert or add (count = old + delta).  A union and one aggregate:
    partial sums run before the shuffle, so a hot key is cheap."""
    both = target.select(*keys, col).unionByName(deltas.select(*keys, col))
    return both.groupBy(*keys).agg(F.sum(col).alias(col))


# ---------------------------------------------------------------- table writes
def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def delta_available(spark: SparkSession) -> bool:
    try:
        spark._jvm.java.lang.Class.forName("io.delta.tables.DeltaTable")
        return True
    except Exception:  # noqa: BLE001
        return False


def merge_into_path(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str],
                    partition_cols: Sequence[str] = ()) -> None:
    """A7 write form.

    First write creates the table.  Later writes: Delta ``MERGE`` when Delta
    is present; otherwise only the partitions touched by ``updates`` are
    recomputed, staged under the shared checkpoint folder and swapped in
    with dynamic partition overwrite.
    """
    if not path_exists(spark, path):
        w = dedupe_on_keys(updates, keys).select(*updates.columns).write.mode("overwrite")
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        w.parquet(path)
        return
    if delta_available(spark):  # pragma: no cover - jar absent in tests
        from delta.tables import DeltaTable  # type: ignore
        cond = " AND ".join(f"t.{k} = u.{k}" for k in keys)
        (DeltaTable.forPath(spark, path).alias("t").merge(updates.alias("u"), cond)
         .whenMatchedUpdateAll().whenNotMatchedInsertAll().execute())
        return
    target = spark.read.parquet(path)
    updates = materialize(updates, "updates")          # read twice below
    if partition_cols:
        touched = updates.select(*partition_cols).distinct()
        target = target.join(touched, list(partition_cols), "left_semi")
    merged = merge_upsert(target, updates, keys).select(*spark.read.parquet(path).columns)
    stage = scratch_path(spark, f"stage-{uuid.uuid4().hex}")
    w = merged.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(stage)
    staged = spark.read.parquet(stage).select(*merged.columns)
    w = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
