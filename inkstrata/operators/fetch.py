"""The fetch stage as a relation: what a polite fetcher would have made of recorded responses. Nothing opens a connection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions.ids import body_hash, uuid5
from inkstrata.functions.urls import resolve, scheme_allowed, url_host
from inkstrata.operators.events import event_line
from inkstrata.operators.fetch_policy import MAX_REDIRECTS, blocked_ip, body_limit, outcome, robots_allows, robots_policy, too_large
from inkstrata.schemas import with_columns_of

#: Fixed value: the answer that says that nothing has changed; it has no body.
NOT_MODIFIED = 304


@dataclass(frozen=True)
class Fetched:
    """docs: url and the fetched_doc columns of what was fetched; log: a row of the fetch log for every request; events: event lines."""

    docs: DataFrame
    log: DataFrame
    events: DataFrame


def blocked_hosts(hosts: DataFrame) -> DataFrame:
    """host and blocked, of hosts (host, ips); a host without addresses is not blocked."""
    return hosts.select("host", F.coalesce(F.exists("ips", lambda ip: blocked_ip(ip)), F.lit(False)).alias("blocked"))


def walk(requests: DataFrame, responses: DataFrame, blocked: DataFrame, limit: int = MAX_REDIRECTS) -> DataFrame:
    """url, at (where its redirects end), hops, and cut: the limit is passed, or a hop leads to a scheme or an address
    that is never fetched. Joins, unrolled, with the responses that are redirects alone."""
    moved = responses.filter(F.col("status_code").between(300, 399) & (F.coalesce("location", F.lit("")) != ""))
    steps = moved.select(F.col("url").alias("at"), resolve("url", "location").alias("to")).withColumn("host", url_host(F.col("to")))
    steps = steps.join(blocked, "host", "left").select("at", "to", (scheme_allowed(F.col("to")) & ~F.coalesce("blocked", F.lit(False))).alias("ok"))
    out = requests.select("url", F.col("url").alias("at"), F.lit(0).alias("hops"), F.lit(False).alias("cut"))
    for hop in range(limit + 1):
        goes = F.col("to").isNotNull() & ~F.col("cut")
        ends = goes & (F.lit(hop >= limit) | ~F.coalesce("ok", F.lit(False)))
        on = goes & ~ends
        out = out.join(steps, "at", "left").select("url", F.when(on, F.col("to")).otherwise(F.col("at")).alias("at"), (F.col("hops") + on.cast("int")).alias("hops"), (F.col("cut") | ends).alias("cut"))
    return out


def fetch(requests: DataFrame, responses: DataFrame, hosts: DataFrame, robots: DataFrame, run_id: str, now: str, agent: str = "inkstrata") -> Fetched:
    """requests: url, each once. responses: url, status_code, location, content_type, headers, body, failure (null, timeout
    or another word), latency_ms; a URL without one is a failed connection. hosts: host, ips. robots: host, status_code,
    failure, body of the robots file; a host without a row is allowed. Later hops skip robots, as the gap."""
    blocked = blocked_hosts(hosts)
    policy = robots_policy(F.col("status_code"), F.col("failure"))
    rules = robots.select("host", policy.alias("policy"), F.col("body").alias("robots_body"))
    asked = requests.select("url", url_host(F.col("url")).alias("host")).join(blocked, "host", "left").join(rules, "host", "left")
    body = F.when(F.col("policy.mode") == "parsed", F.coalesce("robots_body", F.lit("")))
    asked = asked.withColumn("rules", body).withColumn("allowed", robots_allows(F.col("rules"), F.col("url"), F.lit(agent)))

    answers = responses.select(F.col("url").alias("at"), "status_code", "content_type", "headers", "body", "failure", "latency_ms", F.lit(True).alias("answered"))
    ended = asked.join(walk(requests, responses, blocked), "url").join(answers, "at", "left")
    unchanged = F.coalesce(F.col("status_code") == NOT_MODIFIED, F.lit(False))
    failure = F.when(F.col("answered").isNull(), "connection").otherwise(F.col("failure"))
    large = ~unchanged & too_large(F.coalesce("body", F.lit(b"")), body_limit(F.col("content_type")))
    hops = F.when(F.col("cut"), MAX_REDIRECTS + 1).otherwise(F.col("hops"))
    code = outcome(F.col("url"), F.col("host"), F.coalesce("blocked", F.lit(False)), F.col("allowed"), failure, hops, F.coalesce(large, F.lit(False)))
    judged = ended.withColumn("error_code", code).withColumn("held", F.when(~unchanged, F.coalesce("body", F.lit(b""))))
    good = F.col("error_code").isNull()

    log = judged.select(
        uuid5(F.concat_ws("|", F.lit(run_id), "url")).alias("id"), "url", F.when(good, F.col("status_code")).cast("int").alias("status_code"), F.col("latency_ms").cast("int").alias("latency_ms"),
        F.when(good, F.coalesce(F.octet_length("held"), F.lit(0))).cast("bigint").alias("bytes_received"), "error_code", F.lit(now).alias("created_at"), F.lit(run_id).alias("run_id"),
    )
    docs = judged.filter(good).select(
        "url", F.col("status_code").cast("int").alias("status_code"), F.col("at").alias("final_url"), _lowered("headers").alias("headers"), F.col("held").alias("body_bytes"),
        body_hash(F.col("held")).alias("body_sha256"), F.col("latency_ms").cast("int").alias("latency_ms"), F.lit(now).alias("retrieved_at"),
    )
    slowed = asked.filter((F.col("policy.multiplier") > 1.0) & ~F.coalesce("blocked", F.lit(False)))
    events = slowed.select(event_line("robots_slowdown", F.lit(run_id), F.lit(now), None, url=F.col("url"), domain=F.col("host"), robots_mode=F.col("policy.mode"), delay_multiplier=F.col("policy.multiplier")).alias("line"))
    return Fetched(docs, with_columns_of(log, "fetch_log"), events)


def _lowered(headers: str) -> Column:
    return F.transform_keys(headers, lambda k, _: F.lower(k))
