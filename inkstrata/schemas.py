"""The record types, as Spark schemas. ISO instants stay text: see functions.dates."""

from __future__ import annotations

EVIDENCE = (
    "struct<id:string,article_id:string,claim_path:string,evidence_type:string,source_url:string,extraction_method:string,extracted_text:string,"
    "confidence:double,metadata:map<string,string>,retrieved_at:string,extractor_version:string,input_ref:string,snippet_max_chars_applied:int,created_at:string,run_id:string>"
)
SCHEMAS = {
    "fetched_doc": "status_code int, final_url string, headers map<string,string>, body_bytes binary, body_sha256 string, latency_ms int, retrieved_at string",
    "parsed": "url string, text string, title string, date_published string, author_names array<string>, html_title string, meta_tags map<string,string>, json_ld_blocks array<string>, canonical_url string",
    "article_draft": "canonical_url string, source_id string, title string, author_hint string, published_at string, snippet string",
    "evidence": EVIDENCE[len("struct<") : -1],
    "articles": "id string, canonical_url string, source_id string, title string, author_hint string, published_at string, snippet string, version int, created_at string, updated_at string",
    "versions": f"id string, article_id string, version int, content_hash string, title_snapshot string, author_hint_snapshot string, published_at_snapshot string, snippet_snapshot string, evidence_snapshot array<{EVIDENCE}>, created_at string, run_id string",
    "run_log": "id string, source_id string, started_at string, ended_at string, status string, error_message string, fetched_count int, new_articles_count int, updated_articles_count int, error_count int",
    "fetch_log": "id string, url string, status_code int, latency_ms int, bytes_received bigint, error_code string, created_at string, run_id string",
    "accounts": "id string, author_id string, source_id string, source_identifier string, created_at string",
    "authors": "id string, canonical_name string, metadata string, created_at string, updated_at string",
    "merge_decisions": "id string, from_author_id string, to_author_id string, evidence_ids array<string>, decision_criteria string, created_at string, created_by string, run_id string, reverted_at string, reverted_by string, reverted_reason string",
    "review_candidate": "id string, from_author struct<id:string,canonical_name:string>, to_author struct<id:string,canonical_name:string>, score double, confidence string, scoring_breakdown map<string,double>, evidence array<string>, decision string",
}

#: Fixed values.
EVIDENCE_TYPES = ("meta_tag", "json_ld", "extracted", "fetched_content")
CLAIM_PATHS = {"title": "/title", "author_hint": "/author_hint", "published_at": "/published_at"}
SNIPPET_CHARS, EVIDENCE_CHARS = 1500, 800


def empty(spark, name: str):
    return spark.createDataFrame([], SCHEMAS[name])


def with_columns_of(df, name: str):
    """df in the columns of a record type; those that it lacks are null (additive evolution)."""
    return empty(df.sparkSession, name).unionByName(df, allowMissingColumns=True)
