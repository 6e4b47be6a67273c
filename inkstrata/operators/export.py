"""Validation as native expressions, and the export that stops at the first bad row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions.dates import exported
from inkstrata.schemas import EVIDENCE_CHARS, EVIDENCE_TYPES, SNIPPET_CHARS

#: Fixed value: a JSON Pointer.
POINTER = r"^(/([^/~]|(~[01]))*)+$"
REQUIRED = ("id", "canonical_url", "source_id", "version", "created_at", "updated_at")
EVIDENCE_REQUIRED = ("id", "article_id", "claim_path", "evidence_type", "source_url", "extracted_text", "retrieved_at", "created_at", "run_id")


def _broken(e: Column) -> Column:
    lacks = [e[c].isNull() for c in EVIDENCE_REQUIRED]
    out = lacks[0]
    for x in lacks[1:]:
        out |= x
    return out | ~e["evidence_type"].isin(*EVIDENCE_TYPES) | ~e["claim_path"].rlike(POINTER) | (F.length(e["extracted_text"]) > EVIDENCE_CHARS) | ~F.coalesce(e["confidence"], F.lit(1.0)).between(0.0, 1.0)


def article_violations(evidence: str | None = "evidence") -> Column:
    """What an article breaks of its schema; date and URL formats are not part of it."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in REQUIRED]
    checks += [F.when(F.length("snippet") > SNIPPET_CHARS, F.lit("snippet too long")), F.when(F.col("version") < 1, F.lit("version below 1"))]
    if evidence:
        checks.append(F.when(F.col(evidence).isNull(), F.lit("missing evidence")).when(F.exists(evidence, lambda e: F.coalesce(_broken(e), F.lit(True))), F.lit("bad evidence")))
    return F.array_compact(F.array(*checks))


def with_evidence(articles: DataFrame, evidence: DataFrame) -> DataFrame:
    """Articles with their evidence as an array, oldest first, empty where there is none: one join."""

    def older(a: Column, b: Column) -> Column:
        key = lambda e: F.struct(e["created_at"], e["id"])
        return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)

    held = evidence.groupBy("article_id").agg(F.array_sort(F.collect_list(F.struct(*evidence.columns)), older).alias("evidence"))
    none = F.array().cast(held.schema["evidence"].dataType)
    return articles.join(held.withColumnRenamed("article_id", "id"), "id", "left").withColumn("evidence", F.coalesce("evidence", none))


def exportable(rows: DataFrame, order: tuple[str, ...] = ("canonical_url", "source_id")) -> tuple[DataFrame, DataFrame]:
    """The rows before the first that breaks the schema, and that first key with its violations (no row: all pass)."""
    checked = rows.withColumn("violations", article_violations("evidence" if "evidence" in rows.columns else None))
    key = F.struct(*order)
    first = checked.filter(F.size("violations") > 0).agg(F.min_by(F.struct(*order, "violations"), key).alias("bad"))
    bad = first.filter("bad is not null").select("bad.*")
    edge = bad.select(F.struct(*order).alias("__edge"))
    # one row at most on the broadcast side
    before = checked.join(F.broadcast(edge), key >= F.col("__edge"), "left_anti")
    return before.drop("violations"), bad


def export_jsonl(rows: DataFrame, path: str) -> int:
    """Ordered JSON lines at path; the prefix is written before a bad row fails the export. Returns the rows written."""
    good, bad = exportable(rows)
    shaped = good.withColumns({c: exported(F.col(c)) for c in ("published_at", "created_at", "updated_at") if c in good.columns})
    shaped.orderBy("canonical_url", "source_id").write.option("ignoreNullFields", "false").json(path)
    found = bad.first()
    if found:
        raise ValueError(f"schema validation failed for {found['canonical_url']} ({found['source_id']}): {', '.join(found['violations'])}")
    return rows.sparkSession.read.text(path).count()


def schema_problems(name: str) -> list[str]:
    """Structural check of the record types: names without repeats, and the fields that validation requires."""
    from pyspark.sql.types import StructType

    from inkstrata.schemas import SCHEMAS

    fields = StructType.fromDDL(SCHEMAS[name]).fieldNames()
    needed = {"articles": set(REQUIRED), "evidence": set(EVIDENCE_REQUIRED)}.get(name, set())
    return [f"repeated {f}" for f in {f for f in fields if fields.count(f) > 1}] + [f"missing {f}" for f in sorted(needed - set(fields))]


def foreign_key_gaps(child: DataFrame, column: str, parent: DataFrame, key: str = "id") -> DataFrame:
    return child.filter(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")
