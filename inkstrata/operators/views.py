"""Views and operational queries over the store's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions.dates import duration_seconds
from inkstrata.operators.export import with_evidence


def articles_with_evidence(articles: DataFrame, evidence: DataFrame) -> DataFrame:
    """Articles and their evidence as a JSON text, [] where there is none."""
    return with_evidence(articles, evidence).withColumn("evidence_json", F.to_json("evidence")).drop("evidence")


def run_summary(run_log: DataFrame, fetch_log: DataFrame, versions: DataFrame) -> DataFrame:
    """Per run: duration, distinct URLs, those that succeeded, error kinds, articles touched.

    Each log is summed by run before the joins: no fan-out to count away.
    """
    fetched = fetch_log.groupBy(F.col("run_id").alias("id")).agg(
        F.count_distinct("url").alias("urls"), F.count_distinct(F.when(F.col("error_code").isNull(), F.col("url"))).alias("urls_ok"), F.count_distinct("error_code").alias("error_kinds")
    )
    touched = versions.groupBy(F.col("run_id").alias("id")).agg(F.count_distinct("article_id").alias("articles"))
    seconds = duration_seconds(F.to_timestamp("started_at"), F.to_timestamp("ended_at")).alias("duration_seconds")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("urls", "urls_ok", "error_kinds", "articles")]
    return run_log.join(fetched, "id", "left").join(touched, "id", "left").select("id", "source_id", "status", seconds, *zero)


def active_decisions(decisions: DataFrame) -> DataFrame:
    return decisions.filter("reverted_at is null")


def duplicated(rows: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Keys of more than one row; with limit a report of the most frequent ones."""
    out = rows.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    return out.orderBy(F.desc("n"), key).limit(limit) if limit else out


def recent(rows: DataFrame, at: str, tie: str, limit: int) -> DataFrame:
    """A top-k report: the newest rows."""
    return rows.orderBy(F.desc(at), tie).limit(limit)


def evidence_of_run(evidence: DataFrame, articles: DataFrame, run_id: str, limit: int = 50) -> DataFrame:
    """A report: the first claims of a run, by article and claim path; ties by article id."""
    mine = evidence.filter(F.col("run_id") == run_id).select("article_id", "claim_path", "extracted_text")
    return mine.join(articles.select(F.col("id").alias("article_id"), "canonical_url"), "article_id").orderBy("canonical_url", "claim_path", "article_id").limit(limit)


def run_counters(steps: DataFrame, *groups: str, error: Column, new: Column, updated: Column) -> DataFrame:
    """Fetched, new, updated and error counts of a run's steps."""
    return steps.groupBy(*groups).agg(F.count("*").alias("fetched"), F.count_if(new).alias("new_articles"), F.count_if(updated).alias("updated_articles"), F.count_if(error).alias("errors"))
