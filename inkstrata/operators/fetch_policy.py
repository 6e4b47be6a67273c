"""What a polite fetcher decides, as relations over what was fetched: nothing here opens a connection."""

from __future__ import annotations

import ipaddress
from functools import reduce
from operator import or_
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from inkstrata.functions.urls import scheme_allowed

#: Limits of body sizes, seconds between requests, redirects, networks that are never fetched.
BODY_LIMITS = {
    "text/html": 5_000_000, "application/xml": 5_000_000, "text/xml": 5_000_000, "application/atom+xml": 5_000_000, "application/rss+xml": 5_000_000,
    "application/json": 2_000_000, "text/plain": 2_000_000, "application/pdf": 0, "application/x-pdf": 0,
}
DEFAULT_BODY_LIMIT = 500_000
DOMAIN_GAP = 5.0
MAX_REDIRECTS = 5
BLOCKED_NETWORKS = (
    "127.0.0.1/8", "10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16", "169.254.0.0/16", "169.254.169.254/32", "224.0.0.0/4", "255.255.255.255/32", "0.0.0.0/8",
    "::1/128", "fe80::/10", "fc00::/7", "ff00::/8",
)
ROBOTS_TTL = {"parsed": 3600, "missing": 14_400, "error": 900, "other": 3600}


def limit_problems() -> list[str]:
    """What is wrong with the limits that a run starts with; empty if nothing is."""
    from inkstrata.schemas import EVIDENCE_CHARS, SNIPPET_CHARS

    positive = {"default body limit": DEFAULT_BODY_LIMIT, "snippet length": SNIPPET_CHARS, "evidence length": EVIDENCE_CHARS}
    allowed = {"gap between requests": DOMAIN_GAP, "redirects": MAX_REDIRECTS} | {f"body limit of {k}": v for k, v in BODY_LIMITS.items()}
    return [f"{k} must be above 0" for k, v in positive.items() if v <= 0] + [f"{k} must not be below 0" for k, v in allowed.items() if v < 0]


def body_limit(content_type: Column) -> Column:
    kind = F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    by_limit = {n: [k for k, v in BODY_LIMITS.items() if v == n] for n in BODY_LIMITS.values()}
    return F.coalesce(*(F.when(kind.isin(*kinds), n) for n, kinds in by_limit.items()), F.lit(DEFAULT_BODY_LIMIT))


def too_large(body: Column, limit: Column) -> Column:
    return (limit == 0) | (F.octet_length(body) > limit)


def once(value: Column, f) -> Column:
    """f(value), value being worked out once however often f reads it: a bound variable is not written out again."""
    return F.get(F.transform(F.array(value), f), 0)


OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
QUAD = rf"(?:{OCTET}\.){{3}}{OCTET}"
GROUPS = "(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*)?"


def ip_number(ip: Column) -> Column:
    """An IPv4 address as a number, null for anything else."""
    number = once(F.split(ip, r"\."), lambda p: sum((F.get(p, i).cast("bigint") * 256 ** (3 - i) for i in range(1, 4)), F.get(p, 0).cast("bigint") * 256**3))
    return F.when(ip.rlike(rf"\A{QUAD}\z"), number)


def ip6_digits(ip: Column) -> Column:
    """An IPv6 address as its 32 hexadecimal digits, null for anything else; a zone is no part of it."""

    def hexed(low: Column) -> Column:
        """The address without its zone, and a quad at its end as two groups."""
        part = lambda i: F.lpad(F.hex(F.split_part(F.regexp_extract(low, r"([0-9.]+)\z", 1), F.lit("."), F.lit(i)).cast("bigint")), 2, "0")
        quad = F.concat(F.regexp_replace(low, r"[0-9.]+\z", ""), part(1), part(2), F.lit(":"), part(3), part(4))
        return F.when(low.rlike(rf":{QUAD}\z"), F.lower(quad)).otherwise(low)

    def filled(plain: Column) -> Column:
        """Four digits a group, and zeros for what :: leaves out."""
        four = F.regexp_replace(F.regexp_replace(plain, "([0-9a-f]+)", "000$1"), "0+([0-9a-f]{4})(?![0-9a-f])", "$1")
        sides = F.transform(F.split(four, "::"), lambda x: F.replace(x, F.lit(":"), F.lit("")))
        gap = lambda s: F.concat(s[0], F.repeat(F.lit("0"), 32 - F.length(s[0]) - F.length(s[1])), s[1])
        whole = once(sides, lambda s: F.when(F.size(s) == 1, F.when(F.length(s[0]) == 32, s[0])).when(F.length(s[0]) + F.length(s[1]) <= 28, gap(s)))
        return F.when(plain.rlike(rf"\A{GROUPS}(?:::{GROUPS})?\z"), whole)

    # what has no colon, or characters that no address has, is told at once
    likely = ip.rlike(r"\A[0-9A-Fa-f.]*:[0-9A-Fa-f.:]*(?:%[^%/]+)?\z")
    return F.when(likely, once(F.lower(F.split_part(ip, F.lit("%"), F.lit(1))), lambda low: once(hexed(low), filled)))


def blocked_ip(ip: Column, networks=BLOCKED_NETWORKS) -> Column:
    """Whether an address, of either version, is in one of the networks: a predicate on constants, no join. What is no
    address is not. Each form of the address is made once, whatever the number of networks."""
    nets = [ipaddress.ip_network(n, strict=False) for n in networks]

    def among(version: int, value: Column, constant) -> Column:
        return reduce(or_, (value.between(constant(n.network_address), constant(n.broadcast_address)) for n in nets if n.version == version), F.lit(False))

    four = once(ip_number(ip), lambda n: among(4, n, int))
    six = once(ip6_digits(ip), lambda h: among(6, h, lambda a: f"{int(a):032x}"))
    return F.coalesce(F.when(ip.contains(":"), six).otherwise(four), F.lit(False))


@F.pandas_udf(BooleanType())
def blocked_address(ips: pd.Series) -> pd.Series:
    """Whether an address, of either version, is in a blocked network; what is no address is not."""
    nets = [ipaddress.ip_network(n, strict=False) for n in BLOCKED_NETWORKS]

    def one(ip):
        try:
            a = ipaddress.ip_address(ip)
        except ValueError:
            return False
        return any(a in n for n in nets if n.version == a.version)

    return ips.map(one)


def block_ips(rows: DataFrame, ip: str, networks=BLOCKED_NETWORKS) -> DataFrame:
    """rows with blocked."""
    return rows.withColumn("blocked", blocked_ip(F.col(ip), networks))


def outcome(url: Column, host: Column, ip_blocked: Column, robots_allowed: Column, failure: Column, redirects: Column, body_too_large: Column) -> Column:
    """The error code of a fetch, null for none; the order of the cases is part of the meaning."""
    return (
        F.when(~F.coalesce(scheme_allowed(url), F.lit(False)), "SECURITY_BLOCKED").when(F.coalesce(host, F.lit("")) == "", "FETCH_ERROR").when(ip_blocked, "SECURITY_BLOCKED").when(~robots_allowed, "BLOCKED_BY_ROBOTS")
        .when(failure == "timeout", "TIMEOUT").when(redirects > MAX_REDIRECTS, "REDIRECT_LIMIT").when(body_too_large, "BODY_TOO_LARGE").when(failure.isNotNull(), "FETCH_ERROR")
    )


def robots_policy(status: Column, failure: Column) -> Column:
    """mode, ttl and multiplier of the gap, from the answer to a robots request."""
    make = lambda mode, kind, factor: F.struct(F.lit(mode).alias("mode"), F.lit(ROBOTS_TTL[kind]).alias("ttl"), F.lit(factor).alias("multiplier"))
    return F.when(failure.isin("timeout", "redirects"), make("allow", "other", 1.0)).when(failure.isNotNull() | (status >= 500), make("allow", "error", 2.0)).when(status == 200, make("parsed", "parsed", 1.0)).when(status == 404, make("allow", "missing", 1.0)).otherwise(make("allow", "other", 1.0))


@F.pandas_udf(BooleanType())
def robots_allows(body: pd.Series, url: pd.Series, agent: pd.Series) -> pd.Series:
    parsers: dict[str, RobotFileParser] = {}
    out = []
    for b, u, a in zip(body, url, agent):
        if b is None:
            out.append(True)
            continue
        if b not in parsers:
            parsers[b] = RobotFileParser()
            parsers[b].parse(b.splitlines())
        out.append(parsers[b].can_fetch(a, u))
    return pd.Series(out, dtype=bool)


def cache_misses(requests: DataFrame, domain: str, at: str, ttl: str) -> DataFrame:
    """requests with miss: a cache entry lives ttl seconds from the miss that made it; streams each domain in order."""
    columns = requests.columns
    dealt = requests.repartition(F.col(domain)).sortWithinPartitions(domain, at)

    def run(batches):
        key, until = None, None
        for b in batches:
            flags = []
            for d, t, s in zip(b[domain], b[at], b[ttl]):
                if d != key:
                    key, until = d, None
                miss = until is None or t >= until
                if miss:
                    until = t + s
                flags.append(miss)
            b["miss"] = flags
            yield b[[*columns, "miss"]]

    return dealt.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in requests.dtypes) + ", miss boolean")


def politeness(requests: DataFrame, domain: str, seq: list[str], arrival: str, delay: Column) -> DataFrame:
    """requests with start: no earlier than arrival, and each delay after the start before it on the domain.

    The recurrence start = max(arrival, previous start + previous delay) in closed form, by running sums and maxima.
    """
    w = Window.partitionBy(domain).orderBy(*seq)
    before = F.coalesce(F.sum("__delay").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    timed = requests.withColumn("__delay", F.greatest(delay, F.lit(0.0))).withColumn("__before", before).withColumn("__slack", F.col(arrival) - F.col("__before"))
    return timed.withColumn("start", F.col("__before") + F.max("__slack").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__delay", "__before", "__slack")


def serial_schedule(requests: DataFrame, seq: str, domain: str, arrival: str, delay: str, duration: str) -> DataFrame:
    """One request at a time over all domains: the slot is held while a request waits and runs. A simulation in one task, in order."""
    columns = requests.columns
    dealt = requests.coalesce(1).sortWithinPartitions(seq)

    def run(batches):
        free, due = 0.0, {}
        for b in batches:
            starts = []
            for d, a, g, t in zip(b[domain], b[arrival], b[delay], b[duration]):
                start = max(free, a, due.get(d, 0.0))
                due[d], free = start + max(g, 0.0), start + t
                starts.append(start)
            b["start"] = starts
            yield b[[*columns, "start"]]

    return dealt.mapInPandas(run, ", ".join(f"`{c}` {t}" for c, t in requests.dtypes) + ", start double")


def follow_redirects(starts: DataFrame, hops: DataFrame, limit: int = MAX_REDIRECTS) -> DataFrame:
    """url, final_url and redirects of each start over hops (url, location); past the limit the chain is cut.

    limit joins, unrolled: chains are short by definition.
    """
    step = hops.select(F.col("url").alias("__at"), F.col("location").alias("__to"))
    out = starts.select("url", F.col("url").alias("final_url"), F.lit(0).alias("redirects"))
    for _ in range(limit + 1):
        out = out.join(step, F.col("final_url") == F.col("__at"), "left").select("url", F.coalesce("__to", "final_url").alias("final_url"), (F.col("redirects") + F.col("__to").isNotNull().cast("int")).alias("redirects"))
    return out
