"""Discovery: feeds, author pages and search results as tables of (seed, pos, url)."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.functions.urls import is_pdf, quote_plus

SEARCH_URL = "https://export.arxiv.org/api/query?search_query=all:"
FOUND = "seed string, pos int, url string"


def read_seeds(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Seed files whole: seed (path) and body."""
    return spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("seed"), F.col("value").alias("body"))


def _web(url: str | None) -> bool:
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return False
    return parts.scheme.lower() in ("http", "https") and bool(parts.netloc)


def _tag(node) -> str:
    return node.tag.rpartition("}")[2].lower() if isinstance(node.tag, str) else ""


#: Fixed value: the relations of a link to the page itself; none given is the first.
PAGE_RELS = ("alternate", "")


def _links(entry) -> list[tuple[int, str, str, dict]]:
    """(place, text, address if its relation is the page itself, attributes) of an entry's links, in order."""
    out = []
    for place, node in enumerate(entry):
        if _tag(node) == "link":
            own = (node.get("rel") or PAGE_RELS[0]).strip().lower() in PAGE_RELS
            out.append((place, (node.text or "").strip(), (node.get("href") or "").strip() if own else "", node.attrib))
    return out


def feed_link(entry) -> str | None:
    """An entry's page: the first web address that a link has as its text, or else as its address."""
    return next((url for _, text, href, _ in _links(entry) for url in (text, href) if _web(url)), None)


def _declared_pdf(attributes: dict) -> bool:
    said = {k: (attributes.get(k) or "").strip().lower() for k in ("title", "type")}
    return said["title"] == "pdf" or said["type"] == "application/pdf"


def paper_link(entry) -> str | None:
    """A paper's abstract page: the first link that is no PDF, else the last id that is a page and no PDF."""
    pages = (href for _, _, href, attributes in _links(entry) if _web(href) and not is_pdf(href) and not _declared_pdf(attributes))
    named = [text for node in entry if _tag(node) == "id" and _web(text := (node.text or "").strip()) and not is_pdf(text)]
    return next(pages, named[-1] if named else None)


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and (href := (dict(attrs).get("href") or "").strip()):
            self.found.append(href)


def anchors(html: str) -> list[str]:
    parser = _Anchors()
    parser.feed(html or "")
    parser.close()
    return parser.found


def _xml_links(body: str, tags: tuple[str, ...], link) -> list[str]:
    root = ElementTree.fromstring(body)
    return [u for node in root.iter() if _tag(node) in tags and (u := link(node))]


def _author_page(seed: str, body: str) -> list[str]:
    base = seed if _web(seed) else None
    return [u for h in anchors(body) if _web(u := urljoin(base, h) if base else h)]


#: By the part of a source id before the colon.
READERS = {
    "rss": lambda seed, body: _xml_links(body, ("item", "entry"), feed_link),
    "html": _author_page,
    "arxiv": lambda seed, body: _xml_links(body, ("entry",), paper_link),
}


def reader_of(source_id: str):
    kind = source_id.partition(":")[0]
    if ":" not in source_id or kind not in READERS:
        raise ValueError(f"unsupported source id: {source_id}")
    return READERS[kind]


def links(seeds: DataFrame, source_id: str) -> DataFrame:
    """Every link of every seed (seed, body), in order; a feed that is no XML fails."""
    read = reader_of(source_id)

    def run(batches):
        for b in batches:
            rows = [(s, i, u) for s, body in zip(b["seed"], b["body"]) for i, u in enumerate(read(s, body))]
            yield pd.DataFrame(rows, columns=["seed", "pos", "url"])

    return seeds.select("seed", "body").mapInPandas(run, FOUND)


def first_seen(found: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key by order: an aggregate, partial before the shuffle, so that a key that very many rows
    share is no task's group."""
    rest = [c for c in found.columns if c != key]
    least = found.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return least.select(*(F.col(c) if c == key else F.col("__row")[c].alias(c) for c in found.columns))


def discover(seeds: DataFrame, source_id: str) -> DataFrame:
    return first_seen(links(seeds, source_id), "url", "seed", "pos")


def search_url(query: Column, limit: int = 100, strict: bool = False) -> Column:
    """The search request for a plain text; a blank text has none, or fails the job where strict."""
    blank = F.raise_error(F.lit("a search needs a text")).cast("string") if strict else F.lit(None).cast("string")
    return F.when(F.trim(query) != "", F.concat(F.lit(SEARCH_URL), quote_plus(F.trim(query)), F.lit(f"&start=0&max_results={limit}"))).otherwise(blank)
