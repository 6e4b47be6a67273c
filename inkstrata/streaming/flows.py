"""The store's operators over streams: beyond parity, for crawls that never end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkstrata.operators.store import commit, load, upsert


def first_seen_stream(links: DataFrame, at: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Distinct URLs of a stream; state is dropped once the watermark passes."""
    return links.withWatermark(at, delay).dropDuplicatesWithinWatermark(["url"])


def error_rate_stream(events: DataFrame, at: str = "ts", window: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Events and errors by window; late events count until the watermark passes."""
    return events.withWatermark(at, delay).groupBy(F.window(at, window)).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")).select("window.start", "window.end", "n", "errors")


def upsert_stream(drafts: DataFrame, folder: str, checkpoint: str, now: Callable[[int], str]) -> StreamingQuery:
    """Each micro-batch of drafts into the store in folder, as a version of its own; a batch that is replayed after
    a failure makes the same version once more, from the one before it, and that then counts."""

    def step(batch: DataFrame, epoch: int) -> None:
        store = load(batch.sparkSession, folder, before=epoch + 1)
        commit(upsert(store, batch, f"batch-{epoch}", now(epoch)), folder, epoch + 1)

    return drafts.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
