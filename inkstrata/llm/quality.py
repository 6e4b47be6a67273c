"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

Every rule is a predicate on the whole text. Its cost (seconds, less those of reading alone) and its rejection rate are
measured on a sample drawn by chance from all rows; the cascade tries the rules by rejections per cost, and a text that
one rule rejects never pays for the rules after it. The order changes the work, never the verdict.

Defined results: null text has no words and is rejected as too short; empty texts likewise; rows that repeat are
judged each by itself; an empty table gives an empty result; other columns, whatever their names, pass through
keep() unchanged and are ignored by features().
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm._shared import drop, written
from inkstrata.session import table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, whatever body does with it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def word_chars(words: Column) -> Column:
    return F.length(F.array_join(words, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long")


def n_dup_lines(lines: Column) -> Column:
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def n_repeat_words(words: Column, k: int = WINDOW) -> Column:
    """Words inside k-word windows that the text holds twice or more; O(n log n), and O(n) without repeats."""

    def covered(hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(order, lambda s: F.filter(s, lambda e, j: ((j > 0) & (F.get(s, j - 1)["h"] == e["h"])) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))))
        starts = F.array_sort(F.transform(again, lambda e: e["i"]))
        spans = let(starts, lambda p: F.transform(p, lambda x, j: F.least(F.lit(k), F.coalesce(F.get(p, j + 1) - x, F.lit(k)))))
        return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)

    def counted(w: Column) -> Column:
        # a window's hash is that of its words' hashes: each word is hashed once
        rolled = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.transform(h, lambda x, i: F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k)))))
        hashes = F.slice(rolled, 1, F.size(w) - (k - 1))
        return F.when(F.size(w) < k, F.lit(0).cast("long")).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))))

    return let(words, counted)


@dataclass(frozen=True)
class Rule:
    """reject: whether a text fails. A rule on words may have them ready: with words, reject takes text and words."""

    name: str
    reject: Callable[..., Column]
    words: bool = False

    def on(self, text: Column, words: Column | None = None) -> Column:
        said = self.reject(text, words_of(text) if words is None else words) if self.words else self.reject(text)
        return F.coalesce(said, F.lit(False))


@cache
def _defaults() -> tuple[Rule, ...]:
    """Lenient rules: they reject junk (markup, tables, repetition) and leave prose of any language alone."""
    few = Rule("few_words", lambda t, w: F.size(w) < MIN_WORDS, True)
    repeat = Rule("repeated_windows", lambda t, w: 100 * n_repeat_words(w) > MAX_REPEAT_PERCENT * F.size(w), True)
    symbols = Rule("symbols", lambda t, w: 100 * n_symbols(t) > 20 * F.size(w), True)
    length = Rule("word_length", lambda t, w: let(word_chars(w), lambda c: (c > 25 * F.size(w)) | (c < 2 * F.size(w))), True)
    lines = Rule("repeated_lines", lambda t: let(word_lines(t), lambda x: (F.size(x) >= 4) & (100 * n_dup_lines(x) > 50 * F.size(x))))
    return few, repeat, symbols, length, lines


def default_rules() -> list[Rule]:
    return list(_defaults())


#: Rows that the sample has, about, and how often each is judged to tell the rules' costs.
SAMPLE_ROWS, REPEATS = 500, 8


def with_words(docs: DataFrame, text_col: str) -> DataFrame:
    """row, text, words: words are made once, whatever rules read them; names in the row cannot clash."""
    return docs.select(F.struct(*docs.columns).alias("row"), F.col(text_col).alias("text")).select("row", "text", words_of(F.col("text")).alias("words"))


def measured(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """By rule: the share of the sample that it rejects, and the seconds that it takes for the sample."""
    n = docs.count()
    drawn = docs.select(F.col(text_col).alias("text")).sample(fraction=min(1.0, sample_rows / n), seed=7) if n else docs.select(F.col(text_col).alias("text"))
    sample = written(drawn, "sample")
    many = with_words(sample, "text").select("text", "words", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def timed(verdict: Column) -> tuple[int, int, float]:
        best = float("inf")
        for _ in range(2):
            began = time.perf_counter()
            rows, rejected = many.agg(F.count("*"), F.count_if(verdict)).first()
            best = min(best, time.perf_counter() - began)
        return rows, rejected, best

    _, _, reading = timed(F.size("words") + F.length("text") < 0)
    out = {}
    for r in rules:
        rows, rejected, seconds = timed(r.on(F.col("text"), F.col("words")))
        out[r.name] = (rejected / max(rows, 1), max(seconds - reading, 1e-4))
    drop(sample)
    return out


def ordered_rules(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """rules by rejections per second on the sample; ties keep their order."""
    found = measured(docs, rules, text_col, sample_rows)
    return sorted(rules, key=lambda r: -found[r.name][0] / found[r.name][1])


def cascade(rules: list[Rule], text: Column, words: Column | None = None) -> Column:
    """The first rule that rejects the text, null if none does; later rules are not evaluated."""
    out = F.when(rules[0].on(text, words), rules[0].name)
    for r in rules[1:]:
        out = out.when(r.on(text, words), r.name)
    return out


def keep(docs: DataFrame, rules: list[Rule] | None = None, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs without those that a rule rejects; columns unchanged."""
    chosen = ordered_rules(docs, rules or default_rules(), text_col, sample_rows)
    passed = with_words(docs, text_col).filter(cascade(chosen, F.col("text"), F.col("words")).isNull())
    return passed.select("row.*")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """id, the base counts, base_failed, and kept: what the cascade says. Every text pays for its counts; what the counts
    tell already, the default rules read from them, and the cascade is spared texts that failed by the base rules."""
    chosen = ordered_rules(docs, rules or default_rules(), text_col, sample_rows)
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).select("id", "text", words_of(F.col("text")).alias("words"), word_lines(F.col("text")).alias("lines"))
    t = F.col("text")
    counted = found.select(
        "id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("words")).alias("word_chars"),
        n_symbols(t).alias("n_symbols"),
        n_dup_lines(F.col("lines")).alias("n_dup_lines"),
        F.size("lines").alias("n_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    known = {
        "few_words": F.col("n_words") < MIN_WORDS,
        "repeated_windows": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"),
        "symbols": 100 * F.col("n_symbols") > 20 * F.col("n_words"),
        "word_length": (F.col("word_chars") > 25 * F.col("n_words")) | (F.col("word_chars") < 2 * F.col("n_words")),
        "repeated_lines": (F.col("n_lines") >= 4) & (100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    }
    by_counts = [Rule(r.name, lambda _, c=known[r.name]: c) if r in _defaults() else r for r in chosen]
    kept = F.when(failed, F.lit(False)).otherwise(cascade(by_counts, t).isNull())
    return counted.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), kept.alias("kept"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(table(spark, sf_dir, "documents"))


QUERIES = {"op7_quality_rules": op7_quality_rules}

ORACLE = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
u AS (SELECT r, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w),
v AS (SELECT r, i, string_agg(x, ' ') OVER o AS g, count(*) OVER o AS m FROM u
      WINDOW o AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM v WHERE m = 8),
n AS (SELECT r, count(DISTINCT i + j) AS n FROM g, range(8) q(j) WHERE c > 1 GROUP BY r),
f AS (
  SELECT w.r, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
         coalesce(n.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN n USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 20 * n_words
            OR word_chars > 25 * n_words OR word_chars < 2 * n_words
            OR (n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines)) AS kept
FROM f
"""
ORACLES = {"op7_quality_rules": ORACLE}
