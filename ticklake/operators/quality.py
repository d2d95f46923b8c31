"""Integrity checks, contracts and small reports.

Every check is a one-row DataFrame ``(check_name, status, n, sample)`` so a
whole report is a ``unionByName`` and nothing is collected.  Samples are the
first k values in order, taken with a bounded top-k (``orderBy.limit(k)``:
per-partition top k, then a merge of k rows per partition), never with a
global window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_SEP = ", "


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no match in dim (NOT EXISTS)."""
    dk = dim.select(F.col(dim_key or key).alias(key))
    return fact.join(dk, key, "left_anti")


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct left keys absent from right."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def sample_list(df: DataFrame, col: str, k: int) -> DataFrame:
    """One row (n, sample) with the count and the first k values in order,
    joined by ', '.  The sample comes from a bounded top-k."""
    v = F.col(col)
    first_k = df.select(v.alias("_v")).orderBy("_v").limit(k)
    counted = df.agg(F.count(F.lit(1)).alias("_n"))
    both = (counted.select("_n", F.lit(None).cast(df.schema[col].dataType).alias("_v"))
            .unionByName(first_k.select(F.lit(None).cast("bigint").alias("_n"), "_v")))
    return both.agg(
        F.coalesce(F.max("_n"), F.lit(0)).alias("n"),
        F.array_join(F.transform(F.array_sort(F.collect_list("_v")), lambda x: x.cast("string")),
                     SAMPLE_SEP).alias("sample"))


def _check(name: str, counted: DataFrame, fail_status: str, pass_status: str = "PASS") -> DataFrame:
    return counted.select(F.lit(name).alias("check_name"),
                          F.when(F.col("n") > 0, F.lit(fail_status)).otherwise(F.lit(pass_status)).alias("status"),
                          F.col("n").cast("bigint").alias("n"),
                          (F.col("sample") if "sample" in counted.columns else F.lit(None).cast("string"))
                          .alias("sample"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def check_fact_dates(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """K3: fact rows whose date_key is missing from dim_date."""
    return _check("fact_prices_date_fk", _count(orphan_rows(fact, dim_date, "date_key")), "FAIL")


def check_fact_companies(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """K4: fact rows whose company_key is absent from dim_companies (any version)."""
    return _check("fact_prices_company_fk", _count(orphan_rows(fact, dim, "company_key")), "FAIL")


def check_dims_without_facts(dim: DataFrame, fact: DataFrame, k: int = 5) -> DataFrame:
    """K5: current companies with no fact rows (WARN) + first 5 symbols."""
    cur = dim.filter(F.col("is_current")).select("company_key", "symbol")
    lonely = cur.join(fact.select("company_key"), "company_key", "left_anti")
    return _check("dim_companies_without_facts", sample_list(lonely, "symbol", k), "WARN")


def check_silver_coverage(silver: DataFrame, dim: DataFrame, k: int = 10) -> DataFrame:
    """K6: silver symbols missing from the current dimension + first 10."""
    cur = dim.filter(F.col("is_current")).select("symbol")
    gap = missing_keys(silver, cur, "symbol")
    return _check("silver_symbols_missing_from_dim", sample_list(gap, "symbol", k), "FAIL")


def check_calendar_gaps(dim_date: DataFrame, k: int = 5) -> DataFrame:
    """K7: days between min and max full_date missing from dim_date + first 5."""
    b = dim_date.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"))
    expected = b.select(F.explode(F.sequence("lo", "hi")).alias("full_date"))
    gaps = expected.join(dim_date.select("full_date"), "full_date", "left_anti")
    return _check("dim_date_gaps", sample_list(gaps, "full_date", k), "FAIL")


def table_health(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, UNION ALL."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, parts)


def key_counts(fact: DataFrame, key: str) -> DataFrame:
    """(key, n_rows): rows per value of one foreign key.  Partial aggregation
    leaves at most one row per day or company and input split to shuffle."""
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def _sum_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n"))


def integrity_report(fact: DataFrame, dim: DataFrame, dim_date: DataFrame,
                     silver: DataFrame) -> DataFrame:
    """K8: K3-K7 in one frame (advisory: statuses, never an exception)."""
    by_date, by_company = key_counts(fact, "date_key"), key_counts(fact, "company_key")
    return reduce(DataFrame.unionByName, [
        _check("fact_prices_date_fk", _sum_rows(orphan_rows(by_date, dim_date, "date_key")), "FAIL"),
        _check("fact_prices_company_fk", _sum_rows(orphan_rows(by_company, dim, "company_key")), "FAIL"),
        check_dims_without_facts(dim, by_company),
        check_silver_coverage(silver, dim),
        check_calendar_gaps(dim_date)])


def date_bounds(df: DataFrame, col: str = "trade_date") -> DataFrame:
    """D10."""
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"))


def report_stats(reports: DataFrame) -> DataFrame:
    """Distinct tickers, number of reports, last created_at."""
    return reports.agg(F.countDistinct("ticker").alias("tickers"), F.count(F.lit(1)).alias("reports"),
                       F.max("created_at").alias("last_created_at"))


def symbol_list(df: DataFrame, col: str = "symbol") -> DataFrame:
    """Distinct symbols (order applied by the caller when presenting)."""
    return df.select(col).distinct()


def contract_report(df: DataFrame, table: str, *, not_null: Sequence[str] = (),
                    unique: Sequence[Sequence[str]] = (), checks: dict[str, Column] | None = None,
                    max_length: dict[str, int] | None = None,
                    foreign_keys: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """K9: one row per rule (table, rule, violations), from one pass over ``df``.

    Foreign keys are resolved first with left joins against the distinct
    referenced keys (small sides are broadcast by AQE after measurement);
    then NOT NULL, CHECK, length and FK flags are summed per UNIQUE key in a
    grouped aggregate (partial aggregation before the shuffle), and a final
    global aggregate adds them up together with the duplicate-row counts.
    """
    checks = checks or {}
    max_length = max_length or {}
    x = df
    rules: list[tuple[str, Column]] = []
    for c in not_null:
        rules.append((f"not_null:{c}", F.col(c).isNull()))
    for name, cond in checks.items():
        rules.append((f"check:{name}", ~F.coalesce(cond, F.lit(True))))
    for c, n in max_length.items():
        rules.append((f"max_length:{c}", F.coalesce(F.length(F.col(c)) > n, F.lit(False))))
    for i, (col, ref, ref_col) in enumerate(foreign_keys):
        keys = ref.select(F.col(ref_col).alias(col)).distinct().withColumn(f"_fk{i}", F.lit(True))
        x = x.join(keys, col, "left")
        rules.append((f"fk:{col}", F.col(col).isNotNull() & F.col(f"_fk{i}").isNull()))
    flags = [F.sum(F.when(cond, 1).otherwise(0)).alias(f"_v{i}") for i, (_, cond) in enumerate(rules)]
    totals = []
    if unique:
        key = list(unique[0])
        g = x.groupBy(*key).agg(F.count(F.lit(1)).alias("_c"), *flags)
        totals = [F.coalesce(F.sum(f"_v{i}"), F.lit(0)).alias(f"_v{i}") for i in range(len(rules))]
        totals.append(F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c") - 1)), F.lit(0)).alias("_dup0"))
        one = g.agg(*totals)
        names = [r for r, _ in rules] + ["unique:" + ",".join(key)]
        cols = [f"_v{i}" for i in range(len(rules))] + ["_dup0"]
    else:
        one = x.agg(*[F.coalesce(f, F.lit(0)).alias(f"_v{i}") for i, f in enumerate(flags)])
        names = [r for r, _ in rules]
        cols = [f"_v{i}" for i in range(len(rules))]
    stack = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(c).cast("bigint").alias("violations"))
                                for r, c in zip(names, cols)]))
    out = one.select(stack.alias("s")).select("s.rule", "s.violations")
    for key in unique[1:]:
        key = list(key)
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > 1)
                 .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("bigint").alias("violations")))
        out = out.unionByName(dup.select(F.lit("unique:" + ",".join(key)).alias("rule"), "violations"))
    return out.select(F.lit(table).alias("table_name"), "rule", "violations")


def run_audit(df: DataFrame, task: str, run_date, name: str = "audit"):
    """Attach row-count metrics to an action with ``observe``.

    Returns (observed_df, observation); after an action on observed_df,
    ``observation.get`` holds {'rows': n} and ``audit_row`` turns it into
    the one-row audit record.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def audit_row(spark, task: str, run_date, status: str, read: int, written: int,
              error: str | None = None) -> DataFrame:
    return spark.createDataFrame(
        [(task, str(run_date), status, int(read), int(written), error)],
        "task string, run_date string, status string, rows_read bigint, rows_written bigint, error string"
    ).withColumn("run_date", F.to_date("run_date")).withColumn("recorded_at", F.current_timestamp())


def audited(spark, path: str, task: str, run_date, action: Callable[[], tuple[int, int]]) -> None:
    """Run ``action``, which returns the rows read and written, and
    append its audit row to the log at ``path``: status ``success``, or
    ``failed`` with the error, which then goes on to the caller."""
    started, counts, error = datetime.now(UTC).replace(tzinfo=None), (0, 0), None
    try:
        counts = action()
    except Exception as e:
        error = f"{type(e).__name__}: {e}"
        raise
    finally:
        (audit_row(spark, task, run_date, "failed" if error else "success", *counts, error)
         .withColumn("started_at", F.lit(started)).write.mode("append").parquet(path))


def embedding_gate(spark, path: str, vectors: DataFrame, model: str, dim: int, vec: str = "embedding") -> DataFrame:
    """K11 as a gate: the first run writes the record (model, dimension) at
    ``path``; a later one goes on only if both are the stored ones and every
    vector has that size, else it raises.  Returns the stored record."""
    from ticklake.sources.sinks import path_exists
    record = "model_name string, dimension int"
    first = not path_exists(spark, path)
    meta = spark.createDataFrame([], record) if first else spark.read.schema(record).parquet(path)
    found = embedding_compat(vectors, meta, model, dim, vec).first()
    if not found["compatible"]:
        raise RuntimeError(f"embeddings refused: stored {found['stored_model']} of {found['stored_dim']}, "
                           f"now {model} of {dim}, {found['bad_vectors']} vectors of another size")
    if first:
        spark.createDataFrame([(model, dim)], record).coalesce(1).write.parquet(path)
    return spark.read.schema(record).parquet(path)


def embedding_compat(vectors: DataFrame, meta: DataFrame, model: str, dim: int,
                     vec: str = "embedding") -> DataFrame:
    """Stored model/dimension vs the current one, plus a scan for
    vectors of the wrong size.  One row: (compatible, stored_model,
    stored_dim, bad_vectors)."""
    m = meta.agg(F.max("model_name").alias("stored_model"), F.max("dimension").alias("stored_dim"))
    bad = vectors.agg(F.count_if(F.size(F.col(vec)) != dim).alias("bad_vectors"))
    both = (m.select("stored_model", "stored_dim", F.lit(None).cast("bigint").alias("bad_vectors"))
            .unionByName(bad.select(F.lit(None).cast("string").alias("stored_model"),
                                    F.lit(None).cast(m.schema["stored_dim"].dataType).alias("stored_dim"),
                                    "bad_vectors")))
    agg = both.agg(F.max("stored_model").alias("stored_model"), F.max("stored_dim").alias("stored_dim"),
                   F.max("bad_vectors").alias("bad_vectors"))
    ok = ((F.col("stored_model").isNull() | (F.col("stored_model") == model)) &
          (F.col("stored_dim").isNull() | (F.col("stored_dim") == dim)) & (F.col("bad_vectors") == 0))
    return agg.select(ok.alias("compatible"), "stored_model", "stored_dim", "bad_vectors")
