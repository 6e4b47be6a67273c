"""Structured event lines: one JSON object a row, keys in order, nulls kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the fields of a fetch's log line, and the columns of the fetch log that fill them.
FETCH_LINE = {"bytes_received": "bytes_received", "error_code": "error_code", "id": "id", "latency_ms": "latency_ms", "run_id": "run_id", "status_code": "status_code", "timestamp": "created_at", "url": "url"}


def json_line(**fields: Column) -> Column:
    """A JSON object of the fields, by name."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def event_line(event_type: str, run_id: Column, now: Column, level: str | None = "info", **payload: Column) -> Column:
    """An event's line; without level (None) the line has none, as the lines of a fetcher's own events."""
    fixed = {"event_type": F.lit(event_type), "timestamp": now, "run_id": run_id} | ({"level": F.lit(level)} if level else {})
    return json_line(**(fixed | payload))


def fetch_lines(fetch_log: DataFrame) -> DataFrame:
    """line: the JSON line of each row of a fetch log."""
    return fetch_log.select(json_line(**{k: F.col(c) for k, c in FETCH_LINE.items()}).alias("line"))
