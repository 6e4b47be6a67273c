"""URL functions: native expressions, and an Arrow function where a URL may hold anything."""

from __future__ import annotations

from urllib.parse import parse_qsl, urlencode, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Query parameters that name a session; a prefix that marks campaigns.
SESSION_PARAMS = ("session", "sessionid", "sid", "phpsessid", "jsessionid")
CAMPAIGN_PREFIX = "utm_"
DEFAULT_PORTS = {"http": 80, "https": 443}


def is_http_url(url: Column) -> Column:
    return F.coalesce(url.rlike(r"(?i)^https?://[^/?#]+"), F.lit(False))


def is_pdf(url: str) -> bool:
    """The rule of is_pdf_link for one address, where links are read one by one."""
    return url.lower().endswith(".pdf") or "/pdf/" in url.lower()


def is_pdf_link(url: Column) -> Column:
    low = F.lower(url)
    return low.endswith(".pdf") | low.contains("/pdf/")


def scheme_allowed(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)).isin("http", "https")


def url_host(url: Column) -> Column:
    """Lower-case host without user and port; '' where there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))


def profile_host(url: Column) -> Column:
    """What stands between :// and the next slash, port and user included."""
    return F.split_part(F.split_part(F.lower(url), F.lit("://"), F.lit(2)), F.lit("/"), F.lit(1))


def canonical_url(url: Column) -> Column:
    """Canonical form by native expressions: for URLs without user, escapes and bare keys in the query."""
    clean = F.trim(url)
    scheme = F.lower(F.regexp_extract(clean, "^([A-Za-z]+)://", 1))
    authority = F.lower(F.regexp_extract(clean, r"^[A-Za-z]+://([^/?#]*)", 1))
    host = F.regexp_replace(authority, ":[0-9]*$", "")
    port = F.regexp_extract(authority, ":([0-9]*)$", 1)
    default = F.when(scheme == "http", str(DEFAULT_PORTS["http"])).otherwise(str(DEFAULT_PORTS["https"]))
    netloc = F.when((port == "") | (port == "0") | (port == default), host).otherwise(F.concat(host, F.lit(":"), port))
    path = F.lower(F.regexp_extract(clean, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1))
    query = F.regexp_extract(clean, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).startswith(CAMPAIGN_PREFIX) & ~F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(*SESSION_PARAMS))
    pairs = F.array_sort(F.transform(kept, lambda p: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("k"), p.alias("p"))))
    tail = F.array_join(F.transform(pairs, lambda p: p["p"]), "&")
    whole = F.concat(F.lit("https://"), netloc, F.when(path == "", "/").otherwise(path), F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))
    return F.when(scheme.isin("http", "https"), whole).otherwise(url)


def canonical_text(url: str) -> str:
    """The same rules for any URL."""
    parts = urlsplit(url.strip())
    scheme = parts.scheme.lower()
    if scheme not in DEFAULT_PORTS:
        return url
    netloc = parts.hostname or ""
    if parts.port and parts.port != DEFAULT_PORTS[scheme]:
        netloc += f":{parts.port}"
    pairs = sorted((k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if not k.lower().startswith(CAMPAIGN_PREFIX) and k.lower() not in SESSION_PARAMS)
    path = parts.path.lower()
    return urlunsplit(("https", netloc, path if path.startswith("/") else f"/{path}", urlencode(pairs), ""))


@F.pandas_udf(StringType())
def canonical_url_any(urls: pd.Series) -> pd.Series:
    """Canonical form of any URL; null where its port is no number."""

    def one(u):
        try:
            return None if u is None else canonical_text(u)
        except ValueError:
            return None

    return urls.map(one)


@F.pandas_udf(StringType())
def resolve(base: pd.Series, ref: pd.Series) -> pd.Series:
    """ref seen from base (RFC 3986)."""
    return pd.Series([None if r is None else urljoin(b or "", r) for b, r in zip(base, ref)], dtype=object)


def resolve_rooted(base: Column, ref: Column) -> Column:
    """ref seen from base, for references that begin with one slash; native."""
    return F.concat(F.regexp_extract(base, r"^([A-Za-z]+://[^/?#]*)", 1), ref)


def quote_plus(text: Column) -> Column:
    """Form encoding that leaves ~ and escapes *."""
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))
