"""Best-fit packing after a Martello-Toth reduction.

Texts become token pieces of at most the capacity. Only the number of pieces of each length matters to packing, so
the corpus is reduced to a histogram of bounded size. On it the reduction permanently fixes small sets that
dominate every alternative (a piece that fits with no other; a piece and its exact complement; a piece and the
largest that fits, where no third can), again and again; the remainder is packed best fit, longest first, runs of
equal pieces at a time. The plan is a table of runs, again of bounded size: the k-th piece of a length finds its
sequence and place by a binary search. Ranks are dealt in salted buckets, so that a length that a third of all
pieces has is not one task's.

Defined results: null text is empty and is the end token alone; repeated rows are packed each by itself; ties of
length are ordered by id; an empty table gives no sequences; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkstrata.llm._shared import tidy, written
from inkstrata.session import table

CAPACITY = 2048
END = 0
BUCKETS = 64
CACHE = 400_000

_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words whose normal form is plain: ASCII, and Latin-1 letters, which are composed already.
_PLAIN = regex.compile(r"(?:(?!<\|)[\x21-\x7e\xc0-\xff])+")


class TokenBytes:
    """A word-end BPE vocabulary's ids of a text, as little-endian 32-bit values.

    Words between blanks are encoded one by one and kept in a bounded cache. Plain words take a byte-pair encoder
    with the same ranks, in which the word's end is one more byte (one that UTF-8 never has); all others take the
    tokenizer itself. Both give the same ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.fast = self._ranked(path)

    def _ranked(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, shape = spec["model"], json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        if model.get("end_of_word_suffix") != "</w>" or "ByteLevel" not in shape or "Lowercase" not in shape or json.dumps(_SPLIT.pattern)[1:-1] not in shape:
            return None
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {}
        for token, number in model["vocab"].items():
            end = token.endswith("</w>")
            if all(c in byte for c in token.removesuffix("</w>")):
                ranks[bytes(byte[c] for c in token.removesuffix("</w>")) + b"\xff" * end] = number
        return tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe if len(ranks) == max(ranks.values()) + 1 else None

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            ids = self.fast.encode_single_piece(part.encode() + b"\xff")
            found = pack(f"<{len(ids)}I", *ids)
            if len(part) <= 64:
                if len(self.parts) >= CACHE:
                    self.parts.clear()
                self.parts[part] = found
        return found

    def word(self, word: str) -> bytes:
        if self.fast is not None and _PLAIN.fullmatch(word):
            found = b"".join(map(self._part, _SPLIT.findall(word.lower())))
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self.words) >= CACHE:
                self.words.clear()
            self.words[word] = found
        return found

    def __call__(self, text: str) -> bytes:
        get, word = self.words.get, self.word
        return b"".join([b if (b := get(w)) is not None else word(w) for w in text.replace("\n", " ").split(" ") if w])


_loaded: dict[str, TokenBytes] = {}


def token_bytes(path: str) -> TokenBytes:
    if path not in _loaded:
        _loaded[path] = TokenBytes(path)
    return _loaded[path]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """id, piece, start, length, ids_crc32 of each piece of each text's ids with the end token."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        encode, last = token_bytes(tokenizer_path), pack("<I", end)
        for b in batches:
            out = []
            for r, text in enumerate(b.column(1)):
                ids = memoryview(encode(text.as_py() or "") + last)
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((r, n, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*out)) or [()] * 5
            arrays = [b.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "piece", "start", "length", "ids_crc32"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


#: A kind of sequence: (length, times) runs in order, and how many such sequences there are.
Pattern = tuple[tuple[tuple[int, int], ...], int]


def reduce_by_dominance(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Pattern], dict[int, int]]:
    """The sets that dominance fixes, and what is left."""
    left = {n: c for n, c in counts.items() if c}
    fixed: list[Pattern] = []

    def fix(runs: tuple[tuple[int, int], ...], times: int) -> None:
        fixed.append((runs, times))
        for n, k in runs:
            left[n] -= k * times
            if not left[n]:
                del left[n]

    changed = True
    while changed:
        changed = False
        for n in sorted(left, reverse=True):
            while left.get(n):
                room = capacity - n
                others = [m for m in left if m <= room and (m != n or left[n] > 1)]
                if not others:
                    fix(((n, 1),), left[n])
                    changed = True
                    continue
                best = max(others)
                small = min(others)
                two = 2 * small if left[small] - (small == n) > 1 else small + min((m for m in others if m != small), default=capacity)
                if best != room and two <= room:
                    break
                if best == n:
                    fix(((n, 2),), left[n] // 2)
                else:
                    fix(((n, 1), (best, 1)), min(left[n], left[best]))
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Longest first, each piece into the fullest sequence that has room; equal sequences are handled as one group."""
    groups: dict[int, list[Pattern]] = {}
    for n in sorted((n for n, c in counts.items() if c), reverse=True):
        todo = counts[n]
        for room in [*sorted(r for r in groups if r >= n), capacity]:
            fresh = room == capacity and room not in groups
            stack = groups.pop(room, []) if not fresh else [((), -(-todo // (room // n)))]
            most = room // n
            while stack and todo:
                runs, times = stack.pop()
                full = min(times, todo // most)
                if full:
                    groups.setdefault(room - most * n, []).append(((*runs, (n, most)), full))
                    todo -= full * most
                if full < times and todo:
                    groups.setdefault(room - todo * n, []).append(((*runs, (n, todo)), 1))
                    todo, full = 0, full + 1
                if full < times and not fresh:
                    stack.append((runs, times - full))
            if stack and not fresh:
                groups.setdefault(room, []).extend(stack)
            if not todo:
                break
    return [p for found in groups.values() for p in found]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, left = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(left, capacity)


def runs_table(patterns: list[Pattern]) -> np.ndarray:
    """Columns length, first rank, sequence, offset, times a sequence: by length and rank. Sequences from 0, no gaps."""
    rows, ranks, sequence = [], {}, 0
    for runs, times in patterns:
        offset = 0
        for n, k in runs:
            rows.append((n, ranks.get(n, 0), sequence, offset, k))
            ranks[n] = ranks.get(n, 0) + k * times
            offset += n * k
        sequence += times
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def place(runs: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the rank-th piece of each length."""
    wide = np.int64(1) << 44
    row = runs[np.searchsorted(runs[:, 0] * wide + runs[:, 1], length * wide + rank, "right") - 1]
    at = rank - row[:, 1]
    return row[:, 2] + at // row[:, 4], row[:, 3] + at % row[:, 4] * row[:, 0]


def pack_pieces(cut: DataFrame, id_col: str = "doc_id", capacity: int = CAPACITY, planner: Callable[[dict[int, int], int], list[Pattern]] = plan) -> DataFrame:
    """cut (of pieces()) with sequence_id and offset."""
    salted = written(cut.withColumn("bucket", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(BUCKETS)).cast("int")), "pieces")
    # at most capacity * BUCKETS rows, whatever the corpus
    found = salted.groupBy("length", "bucket").count().collect()
    counts = np.zeros((capacity + 1, BUCKETS), np.int64)
    for r in found:
        counts[r["length"], r["bucket"]] = r["count"]
    runs = runs_table(planner({n: int(c) for n, c in enumerate(counts.sum(1)) if c}, capacity))
    before = np.cumsum(counts, 1) - counts
    order = Window.partitionBy("length", "bucket").orderBy(id_col, "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order).cast("long"))
    kept = cut.columns
    names = [*kept, "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, bucket, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "bucket", "rank"))
            sequence, offset = place(runs, length, before[length, bucket] + rank - 1) if len(length) else (np.zeros(0, np.int64),) * 2
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=names)

    schema = ", ".join(f"`{c}` {t}" for c, t in cut.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(tidy(run), schema)


def public_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    return pack_pieces(pieces(docs, tokenizer_path or public_tokenizer(), id_col, text_col, capacity), id_col, capacity)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op3_packing": op3_packing}
ORACLES: dict = {}
