"""Reading the engine's JSON documents: review files, source lists, event lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkstrata.schemas import SCHEMAS


def read_review(spark: SparkSession, path: str) -> DataFrame:
    """Candidates of a review file; fails if the file has no list of them."""
    whole = spark.read.text(path, wholetext=True)
    parsed = whole.select(F.from_json("value", "struct<generated_at:string,min_score:double,candidates:string>").alias("r"))
    bad = F.when(~F.coalesce(F.ltrim("r.candidates").startswith("["), F.lit(False)), F.raise_error(F.lit("a review file needs a list of candidates")))
    kind = T.ArrayType(T.StructType.fromDDL(SCHEMAS["review_candidate"]))
    return parsed.select(F.explode(F.coalesce(bad, F.from_json("r.candidates", kind))).alias("c")).select("c.*")


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """name, source_id and seed of a source list; entries that lack one fail."""
    rows = spark.read.schema("name string, source_id string, seed string").json(path, multiLine=True)
    lacks = F.coalesce(F.trim("name"), F.lit("")).eqNullSafe("") | F.coalesce(F.trim("source_id"), F.lit("")).eqNullSafe("") | F.coalesce(F.trim("seed"), F.lit("")).eqNullSafe("")
    return rows.withColumn("name", F.when(lacks, F.raise_error(F.lit("a source needs name, source_id and seed"))).otherwise(F.col("name")))


def events_of(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that are JSON objects, as line, event_type, run_id, error_code; blank, broken and other lines are skipped."""
    doc = F.try_parse_json(column)
    found = lines.select(F.col(column).alias("line"), doc.alias("v")).filter(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))
    return found.select("line", *(F.try_variant_get("v", f"$.{c}", "string").alias(c) for c in ("event_type", "run_id", "error_code")))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return events_of(spark.read.text(path))
