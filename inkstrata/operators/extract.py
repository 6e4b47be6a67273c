"""Articles from parsed pages: each claim by priority, with the evidence that it rests on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions.dates import iso_date
from inkstrata.functions.ids import uuid5
from inkstrata.functions.text import collapse, split_authors, truncate
from inkstrata.functions.urls import canonical_url_any
from inkstrata.schemas import CLAIM_PATHS, EVIDENCE, EVIDENCE_CHARS, SNIPPET_CHARS
from inkstrata.sources.pages import ARTICLE_TYPES, AUTHOR_KEYS, DATE_KEYS, TITLE_KEYS


def _filled(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def meta(keys: tuple[str, ...]) -> tuple[Column, Column]:
    """Value and key of the first meta tag of keys that has one."""
    tags = F.array(*(F.struct(F.lit(k).alias("k"), _filled(F.try_element_at("meta_tags", F.lit(k))).alias("v")) for k in keys))
    first = F.get(F.filter(tags, lambda t: t["v"].isNotNull()), 0)
    return first["v"], first["k"]


def _block() -> Column:
    """The best linked-data block: the first of an article's type, else the first."""
    kind = lambda b: F.lower(F.coalesce(F.get_json_object(b, "$['@type']"), F.lit("")))
    typed = F.filter("json_ld_blocks", lambda b: F.arrays_overlap(F.split(F.regexp_replace(kind(b), r'[\[\]" ]', ""), ","), F.array(*(F.lit(t) for t in sorted(ARTICLE_TYPES)))))
    return F.coalesce(F.get(typed, 0), F.get("json_ld_blocks", 0))


def _names(author: Column) -> Column:
    """Names of an author that is a text, an object, or a list of either."""
    items = F.when(author.startswith("["), F.from_json(author, "array<string>")).otherwise(F.array(author))
    name = F.transform(items, lambda a: collapse(F.when(a.startswith("{"), F.get_json_object(a, "$.name")).otherwise(a)))
    return F.array_distinct(F.filter(name, lambda n: n.isNotNull() & (n != "")))


def extract(parsed: DataFrame, source_id: str, run_id: str, now: str) -> DataFrame:
    """Drafts (canonical_url, source_id, title, author_hint, published_at, snippet, evidence) of parsed pages."""
    block = parsed.withColumn("__block", _block())
    ld = lambda path: _filled(F.get_json_object("__block", path))
    authors = F.when(F.col("__block").isNotNull(), _names(F.get_json_object("__block", "$.author")))
    (title, title_key), (author, author_key), (date, date_key) = meta(TITLE_KEYS), meta(AUTHOR_KEYS), meta(DATE_KEYS)
    headline = F.coalesce(*(F.when(x != "", x) for x in (F.get_json_object("__block", "$.headline"), F.get_json_object("__block", "$.name"))))

    def candidate(value: Column, kind: str, method: Column, text: Column | None = None) -> Column:
        shown = value if text is None else text
        return F.struct(value.alias("value"), F.lit(kind).alias("kind"), method.alias("method"), shown.alias("text"))

    def first(*candidates: Column) -> Column:
        return F.get(F.filter(F.array(*candidates), lambda c: c["value"].isNotNull()), 0)

    dated = F.coalesce(ld("$.datePublished"), ld("$.dateCreated"))
    picked = block.withColumn("__ld_date", iso_date(dated)).withColumn("__meta_date", iso_date(date)).withColumn("__authors", authors).select(
        "*",
        first(candidate(collapse(_filled(headline)), "json_ld", F.lit("json_ld.headline")), candidate(collapse(title), "meta_tag", F.concat(F.lit("meta."), title_key)), candidate(collapse(_filled(F.coalesce("title", "html_title"))), "extracted", F.lit("parsed.title"))).alias("__title"),
        first(candidate(F.get("__authors", 0), "json_ld", F.lit("json_ld.author"), F.array_join("__authors", ", ")), candidate(F.get(split_authors(author), 0), "meta_tag", F.concat(F.lit("meta."), author_key), author), candidate(F.get("author_names", 0), "extracted", F.lit("parsed.author_names"))).alias("__author"),
        first(candidate(F.col("__ld_date"), "json_ld", F.lit("json_ld.datePublished"), dated), candidate(F.col("__meta_date"), "meta_tag", F.concat(F.lit("meta."), date_key), date), candidate(F.col("date_published"), "extracted", F.lit("parsed.date_published"))).alias("__date"),
    )
    url = canonical_url_any(F.coalesce("canonical_url", "url"))

    def piece(field: str, c: Column) -> Column:
        path = F.lit(CLAIM_PATHS[field])
        return F.when(c["value"].isNotNull(), F.struct(
            uuid5(F.concat_ws("|", F.lit("evidence"), "url", path, F.lit(run_id))).alias("id"), F.lit(None).cast("string").alias("article_id"), path.alias("claim_path"), c["kind"].alias("evidence_type"), F.col("url").alias("source_url"),
            c["method"].alias("extraction_method"), truncate(collapse(c["text"]), EVIDENCE_CHARS).alias("extracted_text"), F.lit(1.0).alias("confidence"), F.create_map(F.lit("field"), c["method"]).alias("metadata"), F.lit(now).alias("retrieved_at"),
            F.lit(None).cast("string").alias("extractor_version"), F.lit(None).cast("string").alias("input_ref"), F.lit(None).cast("int").alias("snippet_max_chars_applied"), F.lit(now).alias("created_at"), F.lit(run_id).alias("run_id"),
        ).cast(EVIDENCE))

    fields = {"title": F.col("__title"), "author_hint": F.col("__author"), "published_at": F.col("__date")}
    evidence = F.array_compact(F.array(*(piece(f, c) for f, c in fields.items())))
    keep = [c for c in parsed.columns if c in ("page_id", "seq")]
    return picked.select(*keep, url.alias("canonical_url"), F.lit(source_id).alias("source_id"), *(c["value"].alias(f) for f, c in fields.items()), truncate(collapse(F.col("text")), SNIPPET_CHARS).alias("snippet"), evidence.alias("evidence"))


def enforce_coverage(drafts: DataFrame, evidence: str = "evidence") -> DataFrame:
    """Claims without evidence become null; warnings lists them."""
    covered = {f: _covers(evidence, path) for f, path in CLAIM_PATHS.items()}
    warnings = F.array_compact(F.array(*(F.when(F.col(f).isNotNull() & ~covered[f], F.lit(f"no evidence for {path}")) for f, path in CLAIM_PATHS.items())))
    out = drafts.withColumn("warnings", warnings)
    return out.withColumns({f: F.when(covered[f], F.col(f)) for f in CLAIM_PATHS})


def _covers(evidence: str, path: str) -> Column:
    return F.coalesce(F.exists(evidence, lambda e: e["claim_path"] == path), F.lit(False))


def evidence_errors(evidence: str = "evidence") -> Column:
    """What is wrong with an article's evidence: claims without any, and paths that name no claim."""
    missing = [F.when(F.col(f).isNotNull() & ~_covers(evidence, p), F.lit(f"missing evidence: {p}")) for f, p in CLAIM_PATHS.items()]
    odd = F.transform(F.filter(evidence, lambda e: ~e["claim_path"].isin(*CLAIM_PATHS.values())), lambda e: F.concat(F.lit("unknown claim path: "), e["claim_path"]))
    return F.concat(F.array_compact(F.array(*missing)), odd)
