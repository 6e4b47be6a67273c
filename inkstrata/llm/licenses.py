"""License scans by diagonal voting.

Every text's rolling word k-gram hashes are joined, in Spark, to the positions of the same k-grams in templates:
a table of fixed size, which is broadcast. Each match votes for a diagonal, text position minus template position.
Votes are summed by diagonal; neighbouring diagonals, as inserted or lost words make them, are merged; a merged
span is verified by the share of the template's k-grams that it holds and by its length. A short phrase must match
whole, on one diagonal: then its words stand consecutively.

Defined results: null and empty texts have no words and no labels; repeated rows are scanned each by itself;
overlapping places of different phrases all count; an empty table gives an empty result; other columns are ignored.
Words and k-grams are compared by 64-bit hashes. A text's k-grams travel in pieces of bounded size.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkstrata.llm import _bytes as B
from inkstrata.llm._shared import tidy
from inkstrata.session import table

#: Phrases that must stand whole, and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Wording of common licenses, from their published texts, and labels of the method's own.
TEMPLATES = (
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("apache-text", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-notice", "Licensed under the Apache License, Version 2.0"),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mpl-text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by-text", "This work is licensed under the Creative Commons Attribution 4.0 International License"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
)
PHRASE_K = 2
TEMPLATE_K = 3
GAP = 3
COVERAGE = 0.6
PIECE = 4096
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _hash(text: str, k: int) -> np.ndarray:
    return B.combine(next(B.each_text(pa.array([text]), B.NOT_ALNUM))[1], k).view(np.int64)


def template_positions(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """hash, template, at (position), size (k-grams of the template), label, base: as many rows as the templates have
    k-grams, and one row for hash 0, which stands for a text as a whole."""
    rows = [(0, -1, 0, 0, "", False)]
    for n, (text, label, k, base) in enumerate([(t, x, PHRASE_K, True) for t, x in phrases] + [(t, x, TEMPLATE_K, False) for x, t in templates]):
        found = _hash(text, k)
        rows += [(int(h), n, i, len(found), label, base) for i, h in enumerate(found)]
    return spark.createDataFrame(rows, "hash long, template int, at long, size int, label string, base boolean")


def rolling_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, n_words, first (position of the first hash), hashes: a text's k-grams, whole, in pieces; one piece of
    hash 0 for each text."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("row", "at", "n", "first", "hashes")}
            held = 0

            def flush():
                ids = b.column(0).take(pa.array(out["at"], pa.int64()))
                return pa.RecordBatch.from_arrays([pa.array(out["row"], pa.int64()), ids, pa.array(out["n"], pa.int64()), pa.array(out["first"], pa.int64()), pa.array(out["hashes"], pa.list_(pa.int64()))], names=["row", id_col, "n_words", "first", "hashes"])

            for r, words in B.each_text(b.column(1), B.NOT_ALNUM):
                pieces = [(0, np.zeros(1, np.int64))]
                for k in (PHRASE_K, TEMPLATE_K):
                    grams = B.combine(words, k).view(np.int64)
                    pieces += [(i, grams[i : i + PIECE]) for i in range(0, len(grams), PIECE)]
                for first, grams in pieces:
                    for c, v in zip(out, (row, r, len(words), first, grams)):
                        out[c].append(v)
                    held += len(grams)
                row += 1
                if held > 1 << 19:
                    yield flush()
                    held = 0
                    for c in out:
                        out[c] = []
            if out["row"]:
                yield flush()

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"row long, `{id_col}` {kind}, n_words long, first long, hashes array<long>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES, coverage: float = COVERAGE, gap: int = GAP) -> DataFrame:
    """One row a text: id, n_words, and spans (label, base, first_word, last_word, coverage), sorted."""
    spark = docs.sparkSession
    grams = rolling_hashes(docs, id_col, text_col).select("row", id_col, "n_words", F.posexplode("hashes").alias("i", "hash"), "first")
    votes = grams.join(F.broadcast(template_positions(spark, phrases, templates)), "hash").select("row", id_col, "n_words", "template", "size", "label", "base", (F.col("first") + F.col("i")).alias("pos"), (F.col("first") + F.col("i") - F.col("at")).alias("diagonal"))
    keys = ["row", id_col, "n_words", "template", "size", "label", "base"]
    # a span is short of twice its template: diagonals that are near stand for places that are near
    lines = votes.groupBy(*keys, "diagonal").agg(F.count_distinct("pos").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.col("base") | F.lag("diagonal").over(order).isNull() | (F.col("diagonal") - F.lag("diagonal").over(order) > gap)
    merged = lines.withColumn("run", F.sum(new.cast("int")).over(order)).groupBy(*keys, "run").agg(F.sum("votes").alias("votes"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    share = F.least(F.col("votes") / F.col("size"), F.lit(1.0))
    whole = F.when(F.col("base"), F.col("votes") == F.col("size")).otherwise((share >= coverage) & (F.col("hi") - F.col("lo") < 2 * F.col("size")))
    span = F.struct("label", "base", F.col("lo").alias("first_word"), (F.col("hi") + F.when(F.col("base"), PHRASE_K - 1).otherwise(TEMPLATE_K - 1)).alias("last_word"), F.round(share, 6).alias("coverage"))
    return merged.groupBy("row", id_col, "n_words").agg(F.array_sort(F.collect_list(F.when((F.col("template") >= 0) & whole, span))).alias("spans")).drop("row")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    s = F.col("spans")
    base = F.filter(s, lambda x: x["base"])
    starts = F.transform(base, lambda x: x["first_word"])
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda y: y["label"]))), ",")
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(s).alias("labels"), F.coalesce(F.array_max(F.transform(s, lambda x: x["coverage"])), F.lit(0.0)).alias("score"),
    )


QUERIES = {"op6_license_scan": op6_license_scan}


def _oracle() -> str:
    rows = []
    for n, (text, label, k, base) in enumerate([(t, x, PHRASE_K, True) for t, x in PHRASES] + [(t, x, TEMPLATE_K, False) for x, t in TEMPLATES]):
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
        rows += [f"('{g}', {n}, {i}, {len(grams)}, '{label}', {str(base).lower()}, {k})" for i, g in enumerate(grams)]
    return rf"""
WITH p(gram, template, tpos, size, label, base, k) AS (VALUES {", ".join(rows)}),
d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
u AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM d),
g AS (SELECT r, i, w || ' ' || lead(w) OVER o AS g2, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g3 FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
v AS (SELECT r, i, template, tpos, size, label, base FROM g JOIN p ON gram = g2 AND k = 2 UNION ALL SELECT r, i, template, tpos, size, label, base FROM g JOIN p ON gram = g3 AND k = 3),
l AS (SELECT r, template, size, label, base, i - tpos AS diagonal, count(DISTINCT i) AS votes, min(i) AS lo, max(i) AS hi FROM v GROUP BY ALL),
n AS (SELECT *, CASE WHEN base OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {GAP}, true) THEN 1 ELSE 0 END AS new FROM l),
s AS (SELECT *, sum(new) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM n),
m AS (SELECT r, template, size, label, base, sum(votes) AS votes, min(lo) AS lo, max(hi) AS hi FROM s GROUP BY r, template, size, label, base, run),
k AS (SELECT *, least(votes / size, 1.0::DOUBLE) AS share FROM m),
f AS (SELECT * FROM k WHERE CASE WHEN base THEN votes = size ELSE share >= {COVERAGE} AND hi - lo < 2 * size END)
SELECT doc_id, len(any_value(ws))::BIGINT AS n_words, count(*) FILTER (WHERE base)::BIGINT AS n_base, min(lo) FILTER (WHERE base)::BIGINT AS first_word,
       max(lo) FILTER (WHERE base)::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE base))), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE label IS NOT NULL))), ','), '') AS labels,
       coalesce(max(round(share, 6)), 0.0)::DOUBLE AS score
FROM d LEFT JOIN f USING (r) GROUP BY r, doc_id
"""


ORACLES = {"op6_license_scan": _oracle()}
