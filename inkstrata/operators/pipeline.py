"""A sync as one composition of tables: discover, fetch (a table of bodies), parse, extract, store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.functions.ids import uuid5
from inkstrata.operators.extract import enforce_coverage, extract
from inkstrata.operators.store import Store, logged, upsert
from inkstrata.sources.feeds import discover
from inkstrata.sources.pages import parse_pages


@dataclass(frozen=True)
class Sync:
    store: Store
    fetch_log: DataFrame
    run_log: DataFrame
    parsed: DataFrame

    def close(self) -> None:
        """Let go of the parsed pages, once the store is committed."""
        self.parsed.unpersist()


def sync(store: Store, seeds: DataFrame, source_id: str, corpus: DataFrame, run_id: str, now: str, dry_run: bool = False) -> Sync:
    """corpus: url, html, status_code, error_code (and content_type, if known) of what was fetched; a URL that it lacks is
    a fetch error. The store that comes back holds the run's fetch log and its line of the run log; a dry run stores
    nothing."""
    # the order of discovery as a text that sorts alike: no window over all URLs
    found = discover(seeds, source_id).withColumn("seq", F.concat_ws("\x1f", F.coalesce("seed", F.lit("")), F.lpad(F.col("pos").cast("string"), 10, "0")))
    fetched = found.join(corpus, "url", "left").withColumn("error_code", F.when(F.col("status_code").isNull() & F.col("error_code").isNull(), "FETCH_ERROR").otherwise(F.col("error_code")))
    log = fetched.select(uuid5(F.concat_ws("|", F.lit(run_id), "url")).alias("id"), "url", F.col("status_code").cast("int").alias("status_code"), F.lit(None).cast("int").alias("latency_ms"), F.octet_length("html").cast("bigint").alias("bytes_received"), "error_code", F.lit(now).alias("created_at"), F.lit(run_id).alias("run_id"))
    typed = "content_type" if "content_type" in corpus.columns else None
    parsed = parse_pages(fetched.filter("error_code is null"), key="seq", content_type=typed).persist()  # articles, evidence, versions and counts all read them
    drafts = enforce_coverage(extract(parsed, source_id, run_id, now)).drop("warnings")
    after = store if dry_run else upsert(store, drafts, run_id, now)
    changes = after.counts.get("changes") if not dry_run else None
    counted = log.agg(F.count("*").cast("int").alias("fetched_count"), F.count_if(F.col("error_code").isNotNull()).cast("int").alias("error_count"))
    both = counted.crossJoin(changes) if changes is not None else counted.withColumns({"new": F.lit(0), "updated": F.lit(0)})  # one row by one row
    run = both.select(
        F.lit(run_id).alias("id"), F.lit(source_id).alias("source_id"), F.lit(now).alias("started_at"), F.lit(now).alias("ended_at"), F.lit("COMPLETED").alias("status"), F.lit(None).cast("string").alias("error_message"),
        "fetched_count", F.col("new").cast("int").alias("new_articles_count"), F.col("updated").cast("int").alias("updated_articles_count"), "error_count",
    )
    return Sync(after if dry_run else logged(after, fetch_log=log, run_log=run), log, run, parsed)
