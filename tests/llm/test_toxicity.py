import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkstrata.llm import toxicity as T

BAD = ["worthless", "disgusting", "pathetic"]


def corpus(n, seed):
    rng = np.random.default_rng(seed)
    clean = ["".join(rng.choice(list("aeioutrnsl"), 5)) for _ in range(300)]
    texts, labels = [], []
    for i in range(n):
        w = list(rng.choice(clean, 60))
        if i % 3 == 0:
            w[int(rng.integers(60))] = BAD[i % 2]
        texts.append(" ".join(w))
        labels.append(int(i % 3 == 0))
    return texts, labels


@pytest.fixture(scope="module")
def model():
    return T.train(*corpus(300, 1))


def test_held_out_accuracy_and_misspellings(model):
    texts, labels = corpus(150, 2)
    s = model.scores(pa.array(texts))
    assert np.mean((s >= 0.5) == np.array(labels)) > 0.95
    plain, odd = texts[1], texts[1] + " wortthless"
    assert model.scores(pa.array([odd]))[0] > 0.5 > model.scores(pa.array([plain]))[0]


def test_toxic_words_at_the_end_of_a_very_long_text(model):
    texts, _ = corpus(400, 3)
    long = " ".join(t for i, t in enumerate(texts) if i % 3) * 80
    assert len(long) > 2 * T.B.SEGMENT or len(long) > 1_000_000
    assert model.scores(pa.array([long + " disgusting"]))[0] > 0.5


def test_scores_depend_on_the_text_alone(model):
    texts = [None, "", "  \n", "été", "a", *corpus(20, 4)[0]]
    alone = [model.scores(pa.array([t], pa.string()))[0] for t in texts]
    assert np.allclose(model.scores(pa.array(texts, pa.string())), alone)
    assert alone[:3] == [0.0, 0.0, 0.0] and all(0 <= x <= 1 for x in alone)


def test_one_class_or_no_rows():
    assert T.train([], []).scores(pa.array(["x"]))[0] == 0.0
    assert T.train(["x y"], [1]).scores(pa.array(["x"]))[0] == 1.0


def test_held_out_rows_are_never_learned(spark):
    texts, labels = corpus(60, 5)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (3, None, "x")], "doc_id long, text string, score string")
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(1, 5), (999, 1), (None, 1), (2, None)], "doc_id long, toxic int")
    sample = T.training_sample(docs, marks)
    learned = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    assert sorted(r.text for r in sample) == sorted(texts[i] for i in learned)
    model = T.train([r.text for r in sample], [r.label for r in sample])
    out = T.score(docs, model).withColumn("h", T.held_out()).collect()
    assert len(out) == 62 and {r.doc_id for r in out if r.h} == {i for i in range(60) if i not in learned}
    assert T.score(docs.limit(0), model).count() == 0
    assert T.training_sample(docs.limit(0), marks.filter(F.lit(False))) == []


def _brute(model, text):
    """A score word by word, by plain integers."""
    mask, shift = 2**64 - 1, 64 - T.BUCKETS.bit_length() + 1
    base = int(T.B.BASE)

    def mixed(x):
        for s, m in ((30, int(T.B.MULTS[0])), (27, int(T.B.MULTS[1])), (31, 1)):
            x = (x ^ (x >> s)) * m & mask
        return x

    def word(w):
        spaced, found = b" " + w + b" ", []
        for k in T.NGRAMS:
            for i in range(len(spaced) - k + 1):
                gram = sum(int(T.B.TABLE[b]) * pow(base, j, 2**64) for j, b in enumerate(spaced[i : i + k])) & mask
                found.append(float(model.weights[mixed((gram + k) & mask) >> shift]))
        return sum(found) / len(found)

    lowered = "".join(c.lower() if c.isascii() else c for c in text or "").encode()
    values = [word(w) for w in re.findall(rb"[0-9a-z\x80-\xff]+", lowered)]
    if not values:
        return 0.0
    z = max(sum(values[i : i + T.WINDOW]) for i in range(max(1, len(values) - T.WINDOW + 1)))
    return 1 / (1 + np.exp(-np.clip(model.slope * z + model.shift, -40, 40)))


def test_scores_equal_brute_force(model):
    texts = [None, "", "a", "\u00e9t\u00e9 disgusting \u65e5\u672c", "Wortthless, you!", *corpus(12, 9)[0], " ".join(corpus(3, 8)[0])]
    assert np.allclose(model.scores(pa.array(texts, pa.string())), [_brute(model, t) for t in texts], atol=2e-6)


def test_pieces_of_long_texts_change_nothing(model, monkeypatch):
    texts = [" ".join(corpus(4, s)[0]) for s in range(5)] + ["y" * 900 + " disgusting", "a b", "", ",. " * 400, "disgusting " + "z" * 300]
    whole = model.scores(pa.array(texts))
    monkeypatch.setattr(T.B, "SEGMENT", 128)
    monkeypatch.setattr(T.B.blocks, "__defaults__", (128,))
    monkeypatch.setattr(T.B.cuts, "__defaults__", (128,))
    assert np.allclose(model.scores(pa.array(texts)), whole, atol=2e-6)


def test_windows_of_very_long_texts_are_drawn_over_the_whole(monkeypatch):
    monkeypatch.setattr(T, "TRAIN_WINDOWS", 5)
    text = " ".join(f"w{i}" for i in range(600))
    got = T.drawn_windows(text).split()
    assert len(got) == 5 * T.WINDOW and got == sorted(got, key=lambda w: int(w[1:])) and int(got[-1][1:]) > 120
    monkeypatch.setattr(T.B.cuts, "__defaults__", (50,))
    assert T.drawn_windows(text).split() == got and T.drawn_windows("short text") == "short text"
