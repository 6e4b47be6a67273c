import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkstrata.llm import quality as Q

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = SPACE.findall(text)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if count[g] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None,
    "",
    " \n\t ",
    "one two",
    "a b c d e f g h " * 40,
    "a b c d e f g h a b c d e f g h",
    "same line of words\nsame line of words\n\n\nother",
    "%%% ### word | <b> " * 9,
    "été naïve \U0001f600 mot " * 8 + "x y",
    " ".join(f"w{i}" for i in range(3000)) + " " + " ".join(f"w{i}" for i in range(100, 160)),
]


def test_counts_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, *TEXTS[3:5]])], "doc_id long, text string, n_words string")
    got = {r.doc_id: r for r in Q.features(docs.repartition(3)).collect()}
    assert len(got) == len(TEXTS) + 2
    for i, t in enumerate(TEXTS):
        r = got[i]
        want = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed
        assert not (failed and r.kept)


def test_order_does_not_change_the_verdict(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    kept = {r.doc_id for r in Q.keep(docs).collect()}
    assert kept == {r.doc_id for r in Q.features(docs).collect() if r.kept}
    t = docs["text"]
    rules = Q.default_rules()
    assert {r.doc_id for r in docs.filter(Q.cascade(rules[::-1], t).isNull()).collect()} == kept


def test_cascade_puts_cheap_rejecting_rules_first(spark):
    docs = spark.createDataFrame([(i, "short text") for i in range(20)], "doc_id long, text string")
    assert Q.ordered_rules(docs, Q.default_rules())[0].name == "few_words"


def test_own_rule_of_a_default_name_is_used(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(30 + i))) for i in range(3)], "doc_id long, text string")
    own = Q.Rule("symbols", lambda t: t.contains("w31"))
    assert {r.doc_id: r.kept for r in Q.features(docs, rules=[own, *Q.default_rules()]).collect()} == {0: True, 1: True, 2: False}


def test_a_rejected_text_pays_for_no_later_rule(spark):
    docs = spark.createDataFrame([("short text",), (None,), ("",)], "text string")
    never = Q.Rule("never", lambda t: F.raise_error(F.lit("evaluated")).cast("boolean"))
    few = Q.default_rules()[0]
    assert {r[0] for r in docs.select(Q.cascade([few, never], F.col("text"))).collect()} == {"few_words"}
    with pytest.raises(Exception, match="evaluated"):
        docs.select(Q.cascade([never, few], F.col("text"))).collect()


def test_costs_are_measured(spark):
    docs = spark.createDataFrame([(" ".join(f"w{i * j % 977}" for i in range(2000)),) for j in range(40)], "text string")
    slow, fast = Q.Rule("slow", lambda t, w: F.size(F.array_distinct(F.transform(w, lambda x: F.sha2(x, 512)))) > 0, True), Q.Rule("fast", lambda t: F.length(t) > 0)
    found = Q.measured(docs, [slow, fast])
    assert found["slow"][0] == found["fast"][0] == 1.0 and found["slow"][1] > found["fast"][1]
    assert [r.name for r in Q.ordered_rules(docs, [slow, fast])] == ["fast", "slow"]


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)), 5, "x", 7)], "doc_id long, text string, words int, row string, n_words int")
    assert Q.keep(docs).collect() == docs.collect() and Q.features(docs).first().n_words == 30


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert Q.features(docs).count() == 0 and Q.keep(docs).count() == 0
