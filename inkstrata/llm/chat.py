"""Chat formatting with typed content parts.

A turn's content is a list of typed parts. A visitor flattens them: text is escaped, an image, a sound or a
document becomes a numbered placeholder whose reference and expanded token count are recorded. The template

    <s>role NEWLINE [INST] content [/INST]</s>     user turns
    <s>role NEWLINE content</s>                    all others

marks turns; inside roles and texts a backslash is doubled and every control string gets one after its first
character, so that none of them survives in a text and reading back is exact.

Defined results: null text and null role are empty; an unknown part kind fails; turns are ordered by turn number
(nulls first) and equal numbers by their formatted form; repeated rows are repeated turns; an empty table gives
an empty result; other columns are ignored. A conversation is read in one task, turn after turn, since its digest
is a sequence; memory holds one turn, however long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm._shared import tidy
from inkstrata.session import table

OPEN, CLOSE, ASK, ASKED = "<s>", "</s>", "[INST] ", " [/INST]"
#: Control strings: a text may hold any of them; escaped, it holds none.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[IMAGE:", "[AUDIO:", "[DOCUMENT:")
_CONTROL = re.compile(r"\\|(?:" + "|".join(re.escape(x) for x in CONTROLS) + ")")
_TURN = re.compile(r"<s>((?:[^\\\n]|\\.)*)\n(.*?)</s>", re.DOTALL)
_PLACEHOLDER = re.compile(r"\[(IMAGE|AUDIO|DOCUMENT):(\d+)\]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


@dataclass(frozen=True)
class Text:
    text: str

    def accept(self, visitor):
        return visitor.visit_text(self)


@dataclass(frozen=True)
class Image:
    ref: str
    pixels: int

    def accept(self, visitor):
        return visitor.visit_image(self)


@dataclass(frozen=True)
class Audio:
    ref: str
    millis: int

    def accept(self, visitor):
        return visitor.visit_audio(self)


@dataclass(frozen=True)
class Document:
    ref: str
    pages: int

    def accept(self, visitor):
        return visitor.visit_document(self)


@dataclass(frozen=True)
class TokenRates:
    """Tokens that an attachment expands to."""

    pixels_per_token: int = 784
    millis_per_token: int = 40
    tokens_per_page: int = 512


class Flattener:
    """Visits the parts of a turn in order; holds the flat text and the attachments. Texts in a row are one text: a
    control string that is spread over several of them is escaped as well."""

    def __init__(self, rates: TokenRates = TokenRates()):
        self.rates, self.pieces, self.run, self.attachments = rates, [], [], []

    def flat(self) -> str:
        self.pieces.append(escape("".join(self.run)))
        self.run = []
        return "".join(self.pieces)

    def visit_text(self, part: Text) -> None:
        self.run.append(part.text)

    def visit_image(self, part: Image) -> None:
        self._attach("IMAGE", part.ref, -(-part.pixels // self.rates.pixels_per_token))

    def visit_audio(self, part: Audio) -> None:
        self._attach("AUDIO", part.ref, -(-part.millis // self.rates.millis_per_token))

    def visit_document(self, part: Document) -> None:
        self._attach("DOCUMENT", part.ref, part.pages * self.rates.tokens_per_page)

    def _attach(self, kind: str, ref: str, tokens: int) -> None:
        self.flat()
        self.pieces.append(f"[{kind}:{len(self.attachments)}]")
        self.attachments.append({"kind": kind.lower(), "ref": ref, "tokens": tokens})


def typed(part: dict):
    """A part as a row holds it (kind, text, ref, size) in its type."""
    size = part.get("size") or 0
    kinds = {"text": lambda: Text(part.get("text") or ""), "image": lambda: Image(part.get("ref") or "", size), "audio": lambda: Audio(part.get("ref") or "", size), "document": lambda: Document(part.get("ref") or "", size)}
    if part.get("kind") not in kinds:
        raise ValueError(f"unknown part kind: {part.get('kind')!r}")
    return kinds[part["kind"]]()


def format_turn(role: str | None, parts: list, rates: TokenRates = TokenRates()) -> tuple[str, int, int, list[dict]]:
    """The turn's formatted text, where its content starts and ends there, and its attachments."""
    visitor = Flattener(rates)
    for part in parts:
        part.accept(visitor)
    content = visitor.flat()
    before = f"{OPEN}{escape(role or '').replace(chr(10), chr(92) + chr(10))}\n" + (ASK if role == "user" else "")
    after = (ASKED if role == "user" else "") + CLOSE
    return before + content + after, len(before), len(before) + len(content), visitor.attachments


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, content) of each formatted turn, unescaped; placeholders stay."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a formatted turn at {at}")
        role, content = unescape(m[1]), m[2]
        yield role, unescape(content[len(ASK) : -len(ASKED)] if role == "user" else content)
        at = m.end()


TURNS = "turn long, formatted string, content_start long, content_end long, in_loss boolean, attachments array<struct<kind:string,ref:string,tokens:long>>"


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", parts_col: str | None = None, rates: TokenRates = TokenRates()) -> DataFrame:
    """One row a turn: its formatted text, the span of its content, whether that is under the loss mask, attachments.

    A conversation's formatted text is its turns' in order. parts_col: array of (kind, text, ref, size); where it is
    null, or without it, the turn is one text part.
    """
    kind = dict(turns.dtypes)[conv_col]
    chosen = turns.select(F.col(conv_col), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"), *([F.col(parts_col).alias("parts")] if parts_col else []))
    schema = pa.schema([("turn", pa.int64()), ("formatted", pa.string()), ("content_start", pa.int64()), ("content_end", pa.int64()), ("in_loss", pa.bool_()), ("attachments", pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])))])

    def run(batches):
        for b in batches:
            roles, texts = b.column("role").to_pylist(), b.column("text").to_pylist()
            parts = b.column("parts").to_pylist() if parts_col else [None] * len(texts)
            done = [format_turn(r, [Text(t or "")] if p is None else [typed(x) for x in p], rates) for r, t, p in zip(roles, texts, parts)]
            columns = [b.column("turn"), [x[0] for x in done], [x[1] for x in done], [x[2] for x in done], [r == "assistant" for r in roles], [x[3] for x in done]]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names=[conv_col, *schema.names])

    return chosen.mapInArrow(tidy(run), f"`{conv_col}` {kind}, {TURNS}")


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, from the formatted text alone: turns, their digest, the text under the loss mask, length."""
    kind = dict(formatted.dtypes)[conv_col]
    dealt = formatted.select(conv_col, "turn", "formatted", "content_start", "content_end", "in_loss").repartition(F.col(conv_col)).sortWithinPartitions(conv_col, "turn", "formatted")

    def run(batches):
        key, state, out = None, None, []

        def row():
            return {conv_col: key, "n_turns": state[0], "turns_sha256": state[1].hexdigest(), "loss_chars": state[2], "loss_sha256": state[3].hexdigest(), "formatted_chars": state[4]}

        def flushed(schema):
            return pa.RecordBatch.from_pylist(out, schema=schema)

        schema = None
        for b in batches:
            schema = schema or pa.schema([(conv_col, b.schema.field(conv_col).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            for k, text, lo, hi, loss in zip(*(b.column(c).to_pylist() for c in (conv_col, "formatted", "content_start", "content_end", "in_loss"))):
                if state is None or k != key:
                    if state is not None:
                        out.append(row())
                    key, state = k, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, content in parse_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{content}\n".encode())
                if loss:
                    masked = unescape(text[lo:hi])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(text)
            if len(out) >= 2000:
                yield flushed(schema)
                out.clear()
        if state is not None:
            out.append(row())
            yield flushed(schema)

    return dealt.mapInArrow(tidy(run), f"`{conv_col}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


PROBE = "</s>[INST] ok [/INST]"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return read_back(format_conversations(turns.unionByName(probe)))


QUERIES = {"op5_chat_format": op5_chat_format}

_ESCAPE_SQL = r"replace({x}, '\', '\\')"
for _c in CONTROLS:
    _ESCAPE_SQL = f"replace({_ESCAPE_SQL}, '{_c}', '{_c[0]}\\{_c[1:]}')"

ORACLE = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
f AS (
  SELECT *, '<s>' || {_ESCAPE_SQL.format(x="role")} || chr(10) || CASE WHEN role = 'user' THEN '[INST] ' ELSE '' END
         || {_ESCAPE_SQL.format(x="text")} || CASE WHEN role = 'user' THEN ' [/INST]' ELSE '' END || '</s>' AS formatted
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, formatted)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(formatted))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
ORACLES = {"op5_chat_format": ORACLE}
