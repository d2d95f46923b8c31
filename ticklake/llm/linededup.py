"""Line deduplication by overlapping three-line windows, native Spark.

A text is cut at line feeds.  Every three consecutive lines are a window,
named by two 64-bit hashes of its lines; windows of three blank lines are
passed over.  A window that occurs more than once in the corpus keeps its
first occurrence, in order of (doc_id, text hash, position); every later
occurrence covers its three lines, overlapping occurrences merge, and the
covered lines are removed.  Texts of fewer than three lines stay as they
are, and so do null texts (they have no lines).  A null doc_id comes before
all others.  Repeated rows of one id and text count as one document, each
with the same result.

Only hashes and positions are shuffled to find repeats (pre-aggregated per
window; the join back to occurrences is one that Spark can split where a
window is very frequent); texts are shuffled once, by document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import store

WIDTH = 3


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def window_at(i: Column) -> Column:
    """The window of lines i to i + 2, over the columns h1, h2 and full."""
    at = lambda name: [F.get(F.col(name), i + j) for j in range(WIDTH)]
    a, b, c = at("full")
    return F.struct(i.alias("pos"), F.xxhash64(*at("h1")).alias("w1"), F.xxhash64(*at("h2")).alias("w2"),
                    (a | b | c).alias("full"))


def occurrences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, pos, w1, w2): one row per window."""
    return (docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"),
                        F.split(F.col(text_col), "\n").alias("lines"))
            .where(F.size("lines") >= WIDTH)
            .select("doc_id", "key", F.transform("lines", lambda x: F.xxhash64(x)).alias("h1"),
                    F.transform("lines", lambda x: F.xxhash64(F.lit(1), x)).alias("h2"),
                    F.transform("lines", lambda x: F.trim(x) != "").alias("full"))
            .select("doc_id", "key", F.explode(F.transform(
                F.sequence(F.lit(0), F.size("h1") - WIDTH), window_at)).alias("w"))
            .where("w.full").select("doc_id", "key", "w.pos", "w.w1", "w.w2"))


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, starts): per document with later occurrences, the sorted
    first lines of the windows to remove."""
    occ = store(occurrences(docs, id_col, text_col), "windows")
    here = F.struct("doc_id", "key", "pos")
    first = occ.groupBy("w1", "w2").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = (occ.join(first.select("w1", "w2", "first"), ["w1", "w2"])
             .where(~here.eqNullSafe(F.col("first"))))
    return later.groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def drop_covered(lines: Column, starts: Column) -> Column:
    """The lines outside [s, s + WIDTH) of all starts: the stretches between
    consecutive starts, which are empty where windows overlap."""

    def stretch(i):
        lo = F.coalesce(F.get(starts, i - 1) + WIDTH, F.lit(0))
        hi = F.coalesce(F.get(starts, i), F.size(lines))
        return F.slice(lines, lo + 1, F.greatest(hi - lo, F.lit(0)))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(starts)), stretch))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                n_lines: str = "n_lines", n_removed: str = "n_removed") -> DataFrame:
    """The documents with covered lines removed from the text, and two more
    columns: how many lines there were and how many went."""
    cover = covered(docs, id_col, text_col).select(
        F.col("doc_id").alias("_ld_id"), F.col("key").alias("_ld_key"), F.col("starts").alias("_ld_starts"))
    rows = docs.withColumn("_ld_at", text_key(F.col(text_col)))
    joined = rows.join(cover, F.col(id_col).eqNullSafe(F.col("_ld_id")) & (F.col("_ld_at") == F.col("_ld_key")),
                       "left")
    lines = F.split(F.col(text_col), "\n")
    joined = joined.withColumn("_ld_kept", F.when(F.col("_ld_starts").isNotNull(),
                                                  drop_covered(lines, F.col("_ld_starts"))))
    hit = F.col("_ld_kept").isNotNull()
    total = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines))
    return joined.select(
        *[F.when(hit, F.array_join("_ld_kept", "\n")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c)
          for c in docs.columns if c not in (n_lines, n_removed)],
        total.alias(n_lines), F.when(hit, total - F.size("_ld_kept")).otherwise(0).alias(n_removed))
