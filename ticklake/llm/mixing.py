"""Mixing sources to target weights, native Spark.

The corpus is a tree (say domain, language, source).  A token budget enters
at the root and flows down: a node's budget is dealt to its children in
proportion to their weights; a child that holds fewer tokens than its share
(over all epochs allowed) gets what it holds, and its shortage goes to its
siblings in proportion to their weights.  Since a node's capacity is the sum
of its leaves', a shortage leaves a subtree only when every sibling in it is
full; it is then met one level up.  All shares are whole tokens, rounded
down.

A leaf takes its documents in seeded epochs: whole passes while its budget
lasts, then the longest prefix of the next pass that fits.  A pass is an
order of the documents by md5 of seed, pass and id; ties go by id and text.

No leaf is ever ordered as a whole: the order is cut into buckets by the
leading digits of the md5, bucket totals (pre-aggregated) give what lies
before a bucket, and only the inside of each bucket is ordered.

Tokens are words (runs without ASCII white space); documents without any are
never taken.  Null ids, languages and sources count as values of their own.
Repeated rows (same id, text and leaf) are taken or left together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticklake.llm.common import store
from ticklake.llm.linededup import text_key

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3                       # leading hex digits of the md5: 4,096 buckets


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _weight(col: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for value, w in weights.items():
        out = F.when(F.col(col).eqNullSafe(F.lit(value)), F.lit(w)).otherwise(out)
    return out.cast("decimal(10,0)")


def renamed(cols: list[str]) -> list[Column]:
    """Columns for the other side of a join on ``same(cols)``."""
    return [F.col(c).alias(f"_at_{c}") for c in cols]


def same(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in cols])


def deal(children: DataFrame, parents: list[str], weight: Column) -> DataFrame:
    """Share each parent's ``budget`` among its children by weight, none
    getting more than its ``cap``; replaces ``budget`` with the child's."""
    w = Window.partitionBy(*parents, "_root")
    order = w.orderBy(F.col("cap").cast("double") / F.col("_w").cast("double"), *[F.col(c) for c in children.columns
                                                                                  if c not in ("cap", "budget")])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    big = lambda c: F.col(c).cast("decimal(28,0)")
    cols = [c for c in children.columns if c != "budget"]
    rows = (children.withColumn("_w", weight).withColumn("_root", F.lit(0)).where("_w > 0")
            .withColumn("_before", F.coalesce(F.sum(big("cap")).over(before), F.lit(0)).cast("decimal(28,0)"))
            .withColumn("_after", F.sum("_w").over(after).cast("decimal(18,0)"))
            .withColumn("_full", big("cap") * F.col("_after") <= (big("budget") - F.col("_before")) * F.col("_w"))
            .withColumn("_spent", F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(w))
            .withColumn("_open", F.sum(F.when(~F.col("_full"), F.col("_w")).otherwise(F.lit(0).cast("decimal(10,0)")))
                        .over(w))
            .withColumn("_share", F.when(F.col("_full"), F.col("cap")).otherwise(
                F.expr("(CAST(budget - _spent AS decimal(28,0)) * _w) div _open"))))
    return rows.select(*cols, F.col("_share").cast("long").alias("budget"))


def budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, int]], share: tuple[int, int],
            epochs: int, default: int = 1) -> DataFrame:
    """(levels, tokens) per leaf -> levels, tokens, budget."""
    nodes, parents = None, []
    for level, table in zip(levels, weights, strict=True):
        caps = leaves.groupBy(*parents, level).agg((F.sum("tokens") * epochs).alias("cap"))
        if parents:
            caps = (caps.join(nodes.select(*renamed(parents), "budget"), same(parents))
                    .drop(*[f"_at_{c}" for c in parents]))
        else:
            everything = F.sum("cap").over(Window.partitionBy(F.lit(0)))
            caps = caps.withColumn("_all", everything).withColumn("budget", F.least(F.col("_all"), F.expr(
                f"CAST(CAST(_all AS decimal(28,0)) * {share[0]} div {share[1] * epochs} AS bigint)"))).drop("_all")
        nodes = deal(caps, parents, _weight(level, table, default))
        parents = [*parents, level]
    return nodes.select(*levels, (F.col("cap") / epochs).cast("long").alias("tokens"), "budget")


def choose(docs: DataFrame, levels: list[str], weights: list[dict[str, int]], share: tuple[int, int], epochs: int,
           seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (text hash), levels, n_tokens, copies: the documents taken
    and how often.  ``share`` is the budget as a fraction of all tokens."""
    rows = store(docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), *levels,
                             word_count(F.col(text_col)).alias("n_tokens")), "mix-rows").where("n_tokens > 0")
    leaves = store(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    plan = (budgets(leaves, levels, weights, share, epochs)
            .select(*renamed(levels), F.expr("budget div tokens").cast("long").alias("passes"),
                    F.expr("budget % tokens").cast("long").alias("rest")))
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("passes").cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    marked = (rows.join(plan, same(levels)).drop(*[f"_at_{c}" for c in levels])
              .withColumn("mark", mark).withColumn("bucket", F.substring("mark", 1, DIGITS)))
    through = Window.partitionBy(*levels).orderBy("bucket")
    place = [*levels, "bucket"]
    buckets = (marked.groupBy(*place).agg(F.sum("n_tokens").alias("held"))
               .select(*place, (F.sum("held").over(through) - F.col("held")).alias("before")))
    inside = Window.partitionBy(*place).orderBy("mark", "doc_id", "key")
    run = F.sum("n_tokens").over(inside) + F.col("before")
    return (marked.join(buckets.select(*renamed(place), "before"), same(place))
            .select("doc_id", "key", *levels, "n_tokens",
                    (F.col("passes") + (run <= F.col("rest")).cast("long")).alias("copies"))
            .where("copies > 0"))


def mix(docs: DataFrame, levels: list[str], weights: list[dict[str, int]], share: tuple[int, int], epochs: int,
        seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents taken, all columns, each as many times as taken."""
    taken = choose(docs, levels, weights, share, epochs, seed, id_col, text_col).distinct().select(
        F.col("doc_id").alias("_mx_id"), F.col("key").alias("_mx_key"),
        *renamed(levels), F.col("copies").alias("_mx_copies"))
    rows = docs.join(taken, F.col(id_col).eqNullSafe(F.col("_mx_id")) & same(levels)
                     & (text_key(F.col(text_col)) == F.col("_mx_key")))
    if epochs > 1:
        rows = rows.withColumn("_mx_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mx_copies"))))
    return rows.select(docs.columns)
