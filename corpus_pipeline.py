"""A training corpus from documents, in five stages; each is written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir), works on all rows of docs, and reads its columns doc_id (an integer) and text;
other columns, whatever their names, pass through unchanged, but for n_chars, which follows the text, where it is there.
Defined results, the same for every stage: null text counts as empty; empty texts, and texts without words, go with
quality_rules, and pass the others unchanged; a row without an id passes dedup_lines, near_duplicates and
mix_sources unchanged; rows that repeat, id and text, count as one document: they are kept or dropped together; between
documents that are alike in all, the smaller id goes first; texts of any length are read to their end; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm import line_dedup, mixing, ngram_join, packing, quality
from inkstrata.llm._shared import drop, scratch, written
from inkstrata.session import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the cascade rejects."""
    return quality.keep(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines, short ones too, that match an earlier line; those that lose their last word go with it."""
    out = line_dedup.dedup_lines(docs, short=True)
    left = out.filter((F.size("__removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.size("__removed") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return left.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each component of links: five words, a similarity of 0.8."""
    return ngram_join.first_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights says; domains grow to their shares, no document is lost."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return mixing.mix(docs, labels, mixing.production_domain(), mixing.WEIGHTS, least=1, cover=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, placed in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("dedup_lines", dedup_lines),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Classifier, tokenizer and packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch() as scope:
            out = written(stage(spark, docs, sf_dir), name)
            scope.keep(out)
        drop(docs)  # the stage before: this one has all that it kept
        docs = out
    return docs
