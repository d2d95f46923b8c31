"""Versioned table folders: an atomic MERGE without a table format.

    <path>/data/<commit>/_bucket=<k>/part-*.parquet     written once, never changed
    <path>/_versions/<n>.json                           which commit holds each bucket in version n

Rows are dealt to a fixed number of buckets by a hash of the cluster columns
and lie in their order.  A merge rewrites the buckets its rows touch into a new
data folder and then commits version n + 1: its manifest is written aside and
moved into place only if no version n + 1 is there.  Readers resolve the newest
version.  So a writer killed at any point leaves the old version readable (and
a data folder that no version names, which ``vacuum`` removes), and of two
writers that start from the same version one is told so and merges again onto
the other's result.

The file system must be able to move a file into place without replacing one
that is there (HDFS and local folders can).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.session import materialize

BUCKET = "_bucket"
BUCKETS = 64


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], cluster: Sequence[str] = (),
                 buckets: int = BUCKETS):
        """``keys`` tell rows apart; rows of one ``cluster`` value (a part of the keys) share a bucket."""
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.cluster, self.buckets = list(cluster or keys), buckets
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    # ------------------------------------------------------------ files
    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def _read_text(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def versions(self) -> list[int]:
        """The committed versions, oldest first."""
        folder = self._at("_versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, version: int | None = None) -> dict:
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "schema": None, "buckets": {}}
        return json.loads(self._read_text(f"_versions/{known[-1] if version is None else version}.json"))

    def _commit(self, manifest: dict) -> bool:
        """Move the manifest into place; False if its version is taken."""
        aside = self._at(f"_versions/.{uuid.uuid4().hex}.tmp")
        self._fs.mkdirs(self._at("_versions"))
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        final = self._at(f"_versions/{manifest['version']}.json")
        context = self._hadoop.FileContext.getFileContext(aside.toUri(), self._conf) if aside.toUri().getScheme() \
            else self._hadoop.FileContext.getFileContext(self._conf)
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = rename
        try:
            context.rename(aside, final, options)
        except Exception as e:  # noqa: BLE001 - the JVM's exception type decides
            if "FileAlreadyExists" not in str(e):
                raise
            self._fs.delete(aside, False)
            return False
        return True

    # ------------------------------------------------------------ reading
    def _frame(self, manifest: dict, buckets=None) -> DataFrame | None:
        if manifest["schema"] is None:
            return None
        parts = [f"{self.path}/data/{commit}/{BUCKET}={k}" for k, commit in manifest["buckets"].items()
                 if buckets is None or int(k) in buckets]
        schema = T.StructType.fromJson(manifest["schema"])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*parts)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version (or an older one that is still there)."""
        out = self._frame(self._manifest(version))
        if out is None:
            raise FileNotFoundError(f"no committed version at {self.path}")
        return out

    # ------------------------------------------------------------ writing
    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.cluster), F.lit(self.buckets)).cast("int"))

    def _write(self, base: dict, updates: DataFrame, touched: set[int]) -> dict:
        from ticklake.sources.sinks import dedupe_on_keys, merge_upsert
        target = self._frame(base, touched)
        merged = (dedupe_on_keys(updates, self.keys) if target is None
                  else merge_upsert(target, updates, self.keys)).select(*self._columns(base, updates))
        commit = uuid.uuid4().hex
        (self._bucketed(merged).repartition(BUCKET, *self.cluster).sortWithinPartitions(BUCKET, *self.keys)
         .write.partitionBy(BUCKET).parquet(f"{self.path}/data/{commit}"))
        return {"schema": json.loads(merged.schema.json()), "buckets": {str(k): commit for k in touched}}

    def _columns(self, base: dict, updates: DataFrame) -> list[str]:
        old = self._frame(base)
        return list(dict.fromkeys([*(old.columns if old is not None else []), *updates.columns]))

    def merge(self, updates: DataFrame) -> int:
        """Update all / insert all on the keys (the greatest of rows that share
        one); returns the version committed.  The first merge makes the table."""
        stored = self._frame(self._manifest())
        if stored is not None:                                     # the bucket is a hash of typed values
            types = dict(stored.dtypes)
            updates = updates.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in updates.columns])
        updates = materialize(updates, "merge-updates")            # read more than once, and again after a conflict
        touched = {r[0] for r in self._bucketed(updates).select(BUCKET).distinct().collect()}   # at most ``buckets``
        while True:
            base = self._manifest()
            mine = self._write(base, updates, touched)
            now = base
            while True:
                new = {"version": now["version"] + 1, "schema": mine["schema"],
                       "buckets": now["buckets"] | mine["buckets"]}
                if self._commit(new):
                    return new["version"]
                now = self._manifest()
                same = all(now["buckets"].get(str(k)) == base["buckets"].get(str(k)) for k in touched)
                if not same or now["schema"] != base["schema"]:
                    break                                          # another writer changed what we merged with

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove versions but the newest ``keep``, and data that none of them
        names; run it when no writer is at work.  Returns the folders removed."""
        known = self.versions()
        for v in known[:-keep]:
            self._fs.delete(self._at(f"_versions/{v}.json"), False)
        used = {c for v in known[-keep:] for c in self._manifest(v)["buckets"].values()}
        folder = self._at("data")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        gone = [n for n in names if n not in used]
        for n in gone:
            self._fs.delete(self._at(f"data/{n}"), True)
        return gone
