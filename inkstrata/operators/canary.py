"""Canary metrics and alerts over runs and event lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Thresholds.
MAX_ERROR_RATE, MAX_ROBOTS_BLOCKS = 0.2, 20


def error_rate(runs: DataFrame) -> DataFrame:
    """Fetches, errors and their ratio, 0.0 without fetches."""
    return runs.agg(F.coalesce(F.sum("fetched"), F.lit(0)).alias("fetched"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors")).withColumn("error_rate", F.coalesce(F.try_divide("errors", "fetched"), F.lit(0.0)))


def event_counts(events: DataFrame) -> DataFrame:
    """Counts that alerts look at, of events with event_type, error_code and run_id."""
    kind = F.coalesce("event_type", F.lit(""))
    return events.agg(
        F.count_if(kind == "cli_error").alias("cli_errors"), F.count_if(kind.startswith("pipeline_") & kind.endswith("_error")).alias("pipeline_errors"),
        F.count_if(F.col("error_code") == "BLOCKED_BY_ROBOTS").alias("robots_blocks"), F.count_if(F.coalesce("run_id", F.lit("")) == "").alias("missing_run_ids"),
    )


def last_of_type(events: DataFrame, kind: str, order: str, *columns: str) -> DataFrame:
    """The last event of each type."""
    return events.groupBy(kind).agg(F.max_by(F.struct(order, *columns), order).alias("e")).select(kind, "e.*")


def alerts(metrics: DataFrame, failed_commands: int = 0, rollback_ok: bool = True, max_error_rate: float = MAX_ERROR_RATE, max_robots: int = MAX_ROBOTS_BLOCKS) -> DataFrame:
    """critical and warning lists and the exit code, of one row of error_rate() and event_counts() columns."""
    critical = F.array_compact(F.array(
        F.when(F.lit(failed_commands) > 0, "commands failed"), F.when(F.col("cli_errors") > 0, "cli errors"), F.when(F.col("pipeline_errors") > 0, "pipeline errors"), F.when(F.col("missing_run_ids") > 0, "events without run id"),
        F.when(F.col("error_rate") > max_error_rate, "error rate"), F.when(~F.lit(rollback_ok), "rollback failed"), F.when(F.col("robots_blocks") > max_robots, "robots blocks"),
    ))
    warning = F.array_compact(F.array(F.when(F.col("robots_blocks").between(1, max_robots), "robots blocks")))
    return metrics.withColumn("critical", critical).withColumn("warning", warning).withColumn("exit_code", F.when(F.size("critical") > 0, 2).otherwise(0))


def report(judged: DataFrame, now: str, sources: DataFrame, commands: DataFrame, rollback_ok: bool | None = None, rollback_run: str | None = None, max_error_rate: float = MAX_ERROR_RATE, max_robots: int = MAX_ROBOTS_BLOCKS) -> DataFrame:
    """The canary's report as one JSON text, of the row of alerts() and the tables of sources and of commands that ran
    (name, run_id, returncode): both are lists that an operator wrote, tens of rows."""

    def listed(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias(name))

    held = judged.crossJoin(listed(sources, "sources")).crossJoin(listed(commands, "commands"))  # one row by one row
    metrics = F.struct(F.col("fetched").alias("total_fetched"), F.col("errors").alias("total_errors"), "error_rate", F.col("cli_errors").alias("cli_error_count"), F.col("pipeline_errors").alias("pipeline_error_count"), F.col("robots_blocks").alias("blocked_by_robots_count"), F.col("missing_run_ids").alias("missing_run_id_count"))
    check = F.struct(F.lit(rollback_ok is not None).alias("checked"), F.lit(rollback_run).cast("string").alias("target_run_id"), F.lit(rollback_ok).cast("boolean").alias("ok"))
    limits = F.struct(F.lit(max_error_rate).alias("error_rate_fail_threshold"), F.lit(max_robots).alias("blocked_by_robots_fail_threshold"))
    parts = F.struct(F.lit(now).alias("generated_at"), "sources", metrics.alias("metrics"), check.alias("rollback_check"), limits.alias("thresholds"), F.struct("critical", "warning").alias("alerts"), "commands")
    return held.select(F.to_json(parts, {"ignoreNullFields": "false"}).alias("value"), "exit_code")
