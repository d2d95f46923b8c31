"""A price log with offsets: a folder that is read as a topic is (A1, A2).

    <path>/<partition>/<first offset>-<end offset>.jsonl     lines of {"key", "value"}

``append_log`` adds segments from Spark tasks; ``retain_log`` drops old ones.
The source ``price_log`` reads it, as a batch (earliest to latest, or the
ranges asked for) and as a stream whose offsets are per partition and kept in
the checkpoint.  Rows are (key, value, partition, offset).  Offsets that were
dropped before they were read are skipped, or raise with ``failOnDataLoss``.

The folder must be one that the driver and all executors see; it is reached
through the file systems of pyarrow.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SEGMENT_ROWS = 100_000
SCHEMA = "key string, value string, partition int, offset bigint"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[len("file:"):])
    return pafs.LocalFileSystem(), path


def segments(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """partition -> its segments (first offset, end offset, file) in order."""
    files, root = _open(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for info in files.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
        if info.type == pafs.FileType.File and info.base_name.endswith(".jsonl") and not info.base_name.startswith("."):
            first, end = info.base_name[:-len(".jsonl")].split("-")
            out.setdefault(int(info.path.rsplit("/", 2)[-2]), []).append((int(first), int(end), info.path))
    return {p: sorted(s) for p, s in out.items()}


def append_log(messages: DataFrame, path: str, partition: Column, partitions: int,
               segment_rows: int = SEGMENT_ROWS) -> None:
    """Append (key, value) rows; ``partition`` deals them to 0 .. ``partitions`` - 1.
    Rows of a partition are put in order first, so a task that is run again
    writes the same segments."""
    ends = {p: s[-1][1] for p, s in segments(path).items()}

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _open(path)
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for p, group in groupby(rows, key=lambda r: r[0]):
            at, lines = ends.get(p, 0), []
            for _, key, value in group:
                lines.append(json.dumps({"key": key, "value": value}, ensure_ascii=False))
                if len(lines) == segment_rows:
                    at, lines = put(files, root, p, at, lines), []
            if lines:
                at = put(files, root, p, at, lines)
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([at], pa.int64())], names=["partition", "end"])

    def put(files, root: str, p: int, at: int, lines: list[str]) -> int:
        folder, name = f"{root}/{p}", f"{at:020d}-{at + len(lines):020d}.jsonl"
        files.create_dir(folder, recursive=True)
        with files.open_output_stream(f"{folder}/.{name}") as out:
            out.write(("\n".join(lines) + "\n").encode())
        files.move(f"{folder}/.{name}", f"{folder}/{name}")
        return at + len(lines)

    dealt = messages.select(partition.cast("int").alias("p"), F.col("key").cast("string"), F.col("value").cast("string"))
    dealt.repartition(partitions, "p").sortWithinPartitions("p", "key", "value").mapInArrow(
        write, "partition int, end bigint").write.format("noop").mode("overwrite").save()


def retain_log(path: str, before: dict[int, int]) -> None:
    """Drop the segments that end at or before the given offset of their
    partition.  One that loses all keeps an empty segment: offsets go on from there."""
    files, root = _open(path)
    for p, found in segments(path).items():
        last = found[-1][1]
        if last <= before.get(p, 0):
            with files.open_output_stream(f"{root}/{p}/{last:020d}-{last:020d}.jsonl"):
                pass
        for first, end, name in found:
            if end <= before.get(p, 0) and first < end:
                files.delete_file(name)


class Slice(InputPartition):
    """A range of offsets of one segment."""

    def __init__(self, partition: int, lo: int, hi: int, first: int, file: str):
        self.partition, self.lo, self.hi, self.first, self.file = partition, lo, hi, first, file


class _Log:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.strict = str(options.get("failOnDataLoss", options.get("failondataloss", "false"))).lower() == "true"

    def slices(self, start: dict, end: dict) -> list[Slice]:
        out, found = [], segments(self.path)
        for p, hi in end.items():
            at = start.get(p, 0)
            for first, last, file in found.get(int(p), []):
                lo, up = max(first, at), min(last, hi)
                if lo >= up:
                    continue
                if lo > at and self.strict:
                    raise ValueError(f"offsets {at} to {lo} of partition {p} are lost")
                out.append(Slice(int(p), lo, up, first, file))
                at = up
            if at < hi and self.strict:
                raise ValueError(f"offsets {at} to {hi} of partition {p} are lost")
        return out

    def read(self, part: Slice | None) -> Iterator[tuple]:
        if part is None:                                       # no slice at all
            return
        files, _ = _open(part.file if "://" in part.file else self.path)
        with files.open_input_stream(part.file) as f:
            lines = f.read().decode().split("\n")[part.lo - part.first:part.hi - part.first]
        for i, line in enumerate(lines):
            row = json.loads(line)
            yield row["key"], row["value"], part.partition, part.lo + i

    def earliest(self) -> dict:
        return {str(p): s[0][0] for p, s in segments(self.path).items()}

    def latest(self) -> dict:
        return {str(p): s[-1][1] for p, s in segments(self.path).items()}


class BatchReader(_Log, DataSourceReader):
    def __init__(self, options):
        super().__init__(options)
        self.start = json.loads(options.get("startingOffsets", options.get("startingoffsets", "{}")) or "{}")
        self.end = json.loads(options.get("endingOffsets", options.get("endingoffsets", "{}")) or "{}")

    def partitions(self):
        return self.slices(self.earliest() | self.start, self.latest() | self.end)


class StreamReader(_Log, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802 - the interface's name
        return self.earliest()

    def latestOffset(self) -> dict:  # noqa: N802
        return self.latest()

    def partitions(self, start: dict, end: dict):
        return self.slices(start, end)

    def commit(self, end: dict) -> None:
        """Nothing to do: the offsets lie in the checkpoint."""


class PriceLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "price_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return BatchReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return StreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PriceLog)
