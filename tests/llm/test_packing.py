import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from inkstrata.llm import packing as P


def checked(patterns, counts, capacity):
    used = Counter()
    for runs, times in patterns:
        assert times > 0 and sum(n * k for n, k in runs) <= capacity
        for n, k in runs:
            used[n] += k * times
    assert used == Counter({n: c for n, c in counts.items() if c})
    return sum(t for _, t in patterns)


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), len(items)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] >= items[i]:
                go(i + 1, [*bins[:j], bins[j] - items[i], *bins[j + 1 :]])
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_the_optimum(items):
    counts = Counter(items)
    fixed, left = P.reduce_by_dominance(counts, 20)
    rest = [n for n, c in left.items() for _ in range(c)]
    assert sum(t for _, t in fixed) + optimum(rest, 20) == optimum(items, 20)
    checked(P.plan(counts, 20), counts, 20)


def test_best_fit_equals_piece_by_piece():
    for seed in range(30):
        items = [(seed * 7919 + i * i * 31) % 97 + 1 for i in range(200)]
        bins = []
        for n in sorted(items, reverse=True):
            fits = [b for b in bins if b >= n]
            if fits:
                bins.remove(min(fits))
                bins.append(min(fits) - n)
            else:
                bins.append(100 - n)
        assert checked(P.best_fit(Counter(items), 100), Counter(items), 100) == len(bins)


def test_fixed_sets():
    fixed, left = P.reduce_by_dominance({100: 3, 60: 5, 40: 4, 99: 1}, 100)
    assert not left and sorted(fixed) == [(((60, 1),), 1), (((60, 1), (40, 1)), 4), (((99, 1),), 1), (((100, 1),), 3)]


def test_token_bytes_equal_the_tokenizer():
    encode = P.TokenBytes(P.public_tokenizer())
    assert encode.fast is not None
    texts = ["Hello, World's été Straße ²½ 12a_b", "<|endoftext|> x<|startoftext|>y", "tab\tand\x0bodd\xa0blank  em", "é İstanbul ΣΑΣ \U0001f600漢字", "don't we'll I'VE 'S", "a" * 5000, "\x1c\x85 \r\n", "ª º ß ÿ × ÷", ""]
    for t in [*texts, " ".join(texts), "\n".join(texts)]:
        ids = encode.tokenizer.encode(t, add_special_tokens=False).ids
        assert encode(t) == struct.pack(f"<{len(ids)}I", *ids), t


def test_documents_round_trip(spark):
    texts = [None, "", "one two", "word " * 5000, "x y z", "x y z", *(f"t{i} " * (i * 13 % 700) for i in range(60))]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, piece int").repartition(3)
    rows = P.pack_documents(docs.select("doc_id", "text", docs.piece.alias("length"))).collect()
    encode = P.token_bytes(P.public_tokenizer())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, t in enumerate(texts):
        ids = encode(t or "") + b"\0\0\0\0"
        got = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start) for r in got] == [(n, 2048 * n) for n in range(len(got))]
        assert sum(r.length for r in got) == len(ids) // 4
        assert all(r.ids_crc32 == zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) for r in got)
        assert len(got) == 1 or all(r.length == 2048 for r in got[:-1])
    for group in by_sequence.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 1
    assert not [1 for a, b in combinations(by_sequence.values(), 2) if sum(r.length for r in [*a, *b]) <= 1024]


def test_empty_table(spark):
    assert P.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
