"""Profiling, rules with reasons, quarantine, expectations and guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from stratalake.functions.columns import ColumnLike, as_column, clean_text, is_true, key_hash

REASON = "rejection_reason"


# --- profiling -------------------------------------------------------------


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, stddev, min and max per numeric column, in one aggregate; one row per column."""
    stats = {
        "count": lambda c: F.count(c),
        "mean": lambda c: F.avg(c),
        "stddev": lambda c: F.stddev(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    per_column = [
        F.struct(F.lit(c).alias("column"), *[fn(F.col(c)).alias(name) for name, fn in stats.items()])
        for c in columns
    ]
    return df.agg(F.array(*per_column).alias("profile")).select(F.inline("profile"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: NULLs per column, in one pass."""
    return df.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns or df.columns])


def duplicates(df: DataFrame, keys: Sequence[str], name: str = "occurrences") -> DataFrame:
    """Key values that appear more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


# --- keys and duplicates ---------------------------------------------------


def dedup_latest(
    df: DataFrame, keys: Sequence[str], order: ColumnLike, tiebreak: Sequence[ColumnLike] = ()
) -> DataFrame:
    """One row per key: highest `order` first, then lowest `tiebreak`.

    Filtering a row number by a constant lets Spark keep one row per key on the
    map side already, so a key that fills a third of the table shuffles at most
    one row per input task.
    """
    newest = Window.partitionBy(*keys).orderBy(as_column(order).desc(), *[as_column(t).asc() for t in tiebreak])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def surrogate_key(
    df: DataFrame, columns: Sequence[str], name: str, null_token: str | None = "␀"
) -> DataFrame:
    """Deterministic key over the natural key; see `key_hash` for NULLs."""
    return df.withColumn(name, key_hash(columns, null_token=null_token))


def assert_unique(df: DataFrame, key: Sequence[str] | str) -> None:
    """Raise if a key value repeats. Counts are combined before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    repeated = duplicates(df, keys).limit(5).collect()
    if repeated:
        raise ValueError(f"repeated keys in {keys}, for example {[r.asDict() for r in repeated]}")


# --- rules and quarantine --------------------------------------------------


def normalize(df: DataFrame, columns: Sequence[str], case: str = "lower") -> DataFrame:
    return df.withColumns({c: clean_text(F.col(c), case) for c in columns})


def validate(df: DataFrame, rules: Sequence[tuple[str, ColumnLike]], reason: str = REASON) -> DataFrame:
    """Add the name of the first rule whose failing condition holds, NULL for a valid row.

    A condition that evaluates to NULL does not fail; add an explicit rule where
    a NULL must be rejected.
    """
    chain: Column | None = None
    for name, failing in rules:
        condition = as_column(failing)
        chain = F.when(condition, name) if chain is None else chain.when(condition, name)
    return df.withColumn(reason, F.lit(None).cast("string") if chain is None else chain)


def split(df: DataFrame, batch_id: str | None = None, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """Validated rows as (valid, quarantine); rejected rows keep reason, time and batch."""
    valid = df.filter(F.col(reason).isNull()).drop(reason)
    extra = {"rejection_timestamp": F.current_timestamp()}
    if batch_id is not None:
        extra["source_batch_id"] = F.lit(batch_id)
    return valid, df.filter(F.col(reason).isNotNull()).withColumns(extra)


# --- expectations ----------------------------------------------------------


def expect(df: DataFrame, rules: Mapping[str, ColumnLike], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Keep all rows; count violations while the data flows to its sink.

    The counts are in `observation.get` once an action has run. An unknown
    outcome is a violation.
    """
    observation = Observation(name)
    counts = [F.count_if(~is_true(rule)).alias(rule_name) for rule_name, rule in rules.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def violation_counts(df: DataFrame, rules: Mapping[str, ColumnLike]) -> DataFrame:
    """(expectation, passed, failed) per rule, in one aggregate."""
    rows = [
        F.struct(
            F.lit(name).alias("expectation"),
            F.count_if(is_true(rule)).alias("passed"),
            F.count_if(~is_true(rule)).alias("failed"),
        )
        for name, rule in rules.items()
    ]
    return df.agg(F.array(*rows).alias("counts")).select(F.inline("counts"))


def expect_or_drop(df: DataFrame, rules: Mapping[str, ColumnLike]) -> DataFrame:
    for rule in rules.values():
        df = df.filter(is_true(rule))
    return df


def guard(df: DataFrame, rule: ColumnLike, message: str) -> DataFrame:
    """Fail the job on the first row that breaks `rule`.

    It is a filter, not a column, so that no projection above can prune it away.
    """
    return df.filter(F.when(is_true(rule), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def expect_or_fail(df: DataFrame, rules: Mapping[str, ColumnLike]) -> DataFrame:
    for name, rule in rules.items():
        df = guard(df, rule, f"expectation violated: {name}")
    return df


# --- metrics ---------------------------------------------------------------


def batch_metrics(
    validated: DataFrame, keys: Sequence[str], batch_id: str, reason: str = REASON
) -> DataFrame:
    """One row of quality figures for a validated batch, in one job.

    Rows are counted per key first, so the distinct keys come out of the same
    aggregate as the totals.
    """
    ok = F.col(reason).isNull()
    per_key = validated.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("v"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("v"), F.lit(0)).alias("valid_rows"),
        F.count_if(F.col("v") > 0).alias("final_rows"),
    )
    rejected = F.col("total_rows") - F.col("valid_rows")
    return totals.select(
        F.lit(batch_id).alias("batch_id"),
        "total_rows",
        "valid_rows",
        rejected.alias("rejected_rows"),
        (F.col("valid_rows") - F.col("final_rows")).alias("duplicates_removed"),
        "final_rows",
        F.round(rejected * 100 / F.nullif(F.col("total_rows"), F.lit(0)), 2).alias("rejected_pct"),
    )


def layer_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts of two layers and their difference."""
    counts = before.agg(F.count(F.lit(1)).alias("rows_before"), F.lit(0).cast("bigint").alias("rows_after")).unionByName(
        after.agg(F.lit(0).cast("bigint").alias("rows_before"), F.count(F.lit(1)).alias("rows_after"))
    )
    return counts.agg(F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after")).withColumn(
        "dropped", F.col("rows_before") - F.col("rows_after")
    )


def reconcile(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Row counts per group on both sides; `matches` is false where they differ.

    Both sides are counted before one shared shuffle; NULL groups are kept.
    """
    side_a = a.groupBy(*by).agg(F.count(F.lit(1)).alias("n_a")).withColumn("n_b", F.lit(0).cast("bigint"))
    side_b = b.groupBy(*by).agg(F.count(F.lit(1)).alias("n_b")).withColumn("n_a", F.lit(0).cast("bigint"))
    both = side_a.unionByName(side_b).groupBy(*by).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    return both.withColumn("matches", F.col("n_a") == F.col("n_b"))


def ingestion_entry(df: DataFrame, batch_id: str, file_column: str, status: str = "COMPLETADO") -> DataFrame:
    """One log row per source file of a batch."""
    return df.groupBy(F.col(file_column).alias("file")).agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit(batch_id).alias("batch_id"), "file", "rows_read", F.lit(status).alias("status")
    )


def log_ingestion(log: DataFrame, entries: DataFrame) -> DataFrame:
    """Upsert log rows by (batch_id, file): a retried batch updates its rows."""
    from stratalake.operators.merge import Insert, Update, merge

    measured = [c for c in log.columns if c not in ("batch_id", "file", "source_system", "target", "started_at")]
    return merge(
        log,
        entries,
        ["batch_id", "file"],
        matched=[Update({c: f"s.{c}" for c in measured})],
        not_matched=[Insert()],
    )
