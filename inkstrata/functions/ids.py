"""Identifiers and digests that any attempt of a task computes alike, native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of URLs in RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(text: Column, namespace: str = URL_NAMESPACE) -> Column:
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(text, "UTF-8")))
    variant = F.element_at(F.array(*(F.lit(c) for c in "89ab")), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def content_hash(*fields: Column) -> Column:
    """Digest of a record's fields by name; a null differs from an empty text."""
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def body_hash(body: Column) -> Column:
    """SHA-256 of a body, null for an empty one."""
    return F.when(F.octet_length(body) > 0, F.sha2(body, 256))


def evidence_hash(article_id: Column, claim_path: Column, evidence_type: Column, source_url: Column, text: Column) -> Column:
    """What makes two pieces of evidence the same: neither time nor run."""
    return content_hash(article_id.alias("article_id"), claim_path.alias("claim_path"), evidence_type.alias("evidence_type"), source_url.alias("source_url"), text.alias("extracted_text"))
