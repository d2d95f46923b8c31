"""SparkSession construction and cluster-safe settings.

The session is pinned to UTC so that dates derived from timestamps do not
depend on the machine the driver runs on, AQE is on so shuffle partition
counts and join strategies adapt to the data actually seen, and the Spark
UI is off (no HTTP port is opened).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The size bound for every join Spark broadcasts on its own: planned
    # from file statistics, or by AQE after the side has been measured.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, app: str = "ticklake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset so ``spark-submit`` decides, and let
    AQE coalesce from a generous ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    A cluster sets this to shared storage; we only create our own folder
    when the setting is absent and the master is local: on a cluster each
    executor would write to its own disk, so there a missing setting raises.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not fallback and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        path = fallback or tempfile.mkdtemp(prefix="ticklake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name


def materialize(df, name: str = "table"):
    """Cut lineage for a frame consumed more than once: write it as Parquet
    under the shared ``spark.checkpoint.dir`` and read it back.

    A written table survives executor loss (unlike a local checkpoint) and,
    unlike ``Dataset.checkpoint`` without a cache, computes the frame once.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
