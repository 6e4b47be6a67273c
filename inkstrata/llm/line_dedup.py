"""Line dedup by an exact set-similarity join, in DataFrame functions alone.

A line's tokens are its distinct five-word shingles, as 64-bit hashes of its words' hashes. Equal lines collapse to
their first place (document id, then line number). Distinct lines are joined exactly at a Jaccard similarity of 0.8:

1. A line becomes its digest, its size and its prefix: the first tokens in one global order. That order is by
   rarity: tokens that are frequent come last, by class of frequency, all others by hash. Which tokens are frequent is
   counted over all postings of a first order, by hash alone: the TOP most frequent are ranked last, and the lines whose
   prefix holds one are posted again. No other line's prefix can change.
2. Tokens that two lines or more are posted under keep their postings; sets are computed for lines that may have a match
   alone, from the texts, with a sketch of each set (parities of its tokens: these never differ by more than the sets do).
3. Every line is first tried against the earliest line of each of its tokens (length filter, positional filter, then the
   sets); where that leaves many, also against the next earliest. The lines left meet all earlier ones under
   their tokens, in blocks, by their sketches: groups of near copies never meet pair by pair, no row is made for a pair.

A line with an earlier match goes, wherever it stands; equal lines stay at their first place.

Defined results: lines of fewer than five words always stay, unless short lines are asked for: then such a line has
one token, its whole word sequence; blank lines always stay; null text stays null; a line's place is (id, line
number), rows of equal ids share places, and repeated rows keep the same lines; null ids are left alone; an empty
table gives an empty result; words and texts may be of any length; other columns, whatever their names, pass through
dedup_lines() unchanged, but for __n_lines and __removed, which are the operator's. Rows of one id that hold
different texts share places all the same: a place stays if a line there does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm._shared import TOP, among, constant_table, scratch, slot_class, slots, written
from inkstrata.session import table

WORDS = 5
NUM, DEN = 8, 10
BLANKS = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]+"
#: A line of WORDS words at least: anchored and possessive, so that a line is passed once whatever its words' length.
LONG = r"^[\x20\x09-\x0D]*+(?:[^\x20\x09-\x0D]++[\x20\x09-\x0D]++){%d}[^\x20\x09-\x0D]" % (WORDS - 1)
#: A line of one word at least.
ANY = r"[^\x20\x09-\x0D]"
#: Lines left meet all others of their tokens, in blocks of so many, when that makes at most so many pairs a shared
#: posting, or after so many rounds.
BLOCK, FEW, ROUNDS = 128, 32, 4
#: Places and tokens that a join needs are known by 2**PLACE_BITS bits before: a fixed size, which lets more others pass as tables grow.
PLACE_BITS = 22
#: A token's hash; the bits above it hold its class of frequency. The most frequent tokens, of so many lines at least, come last.
TOKEN_BITS, FREQUENT = 60, 8


def plain(text: Column) -> Column:
    """Whether all words of a text stand apart by single blanks or line ends: its lines split at single blanks."""
    odd = F.lit(False)
    for x in ("\t", "\x0b", "\f", "\r", "  ", " \n", "\n "):
        odd |= F.contains(text, F.lit(x))
    return ~(odd | text.startswith(" ") | text.endswith(" "))


def line_words(line: Column, is_plain: Column | None = None) -> Column:
    """A line's words; of a blank line one empty word."""
    apart = F.split(F.btrim(line, F.lit(BLANKS)), SPACE)
    return apart if is_plain is None else F.when(is_plain, F.split(line, " ")).otherwise(apart)


def takes_part(words: Column, least: int) -> Column:
    return (F.size(words) >= least) & (words[0] != "")


def once(column: Column) -> Column:
    """A column's value as that of a generator of one row: no filter or project above computes it a second time."""
    return F.explode(F.array(column))


def with_tokens(lines: DataFrame, *others: str) -> DataFrame:
    """The columns named and x: hashes, of TOKEN_BITS bits, of the distinct shingles of a line's words; with fewer than WORDS
    words the whole sequence is one.

    A shingle's hash is that of its first four words' and its last word; that of four is that of two pairs. All shingles
    of a line take three passes of two operands each; beyond the line's end there is nothing to hash.
    """
    words = F.col("words")
    after = lambda x, n: F.slice(x, n + 1, F.greatest(F.size(x) - n, F.lit(0)))
    mask = F.lit((1 << TOKEN_BITS) - 1)
    pairs = lines.select(*others, "words", F.zip_with(words, after(words, 1), lambda a, b: F.xxhash64(a, b)).alias("two"))
    fours = pairs.select(*others, "words", F.zip_with("two", after(F.col("two"), 2), lambda a, b: F.xxhash64(a, b)).alias("four"))
    every = F.zip_with("four", after(words, 4), lambda a, b: F.xxhash64(a, b).bitwiseAND(mask))
    return fours.select(*others, F.array_distinct(F.slice(every, 1, F.greatest(F.size("words") - (WORDS - 1), F.lit(1)))).alias("x"))


@dataclass(frozen=True)
class Places:
    """A line's place, (id, line number), as one ordered column: a long where both fit into one, else a struct."""

    kind: str
    lo: int = 0
    width: int = 0

    @classmethod
    def over(cls, docs: DataFrame, id_col: str, text_col: str) -> Places:
        kind = dict(docs.dtypes)[id_col]
        if kind in ("tinyint", "smallint", "int", "bigint"):
            lo, hi, most = docs.agg(F.min(id_col), F.max(id_col), F.max(F.octet_length(text_col))).first()
            if (hi or 0) - (lo or 0) + 1 < (1 << 62) // ((most or 0) + 2):
                return cls(kind, lo or 0, (most or 0) + 2)
        return cls(kind)

    def at(self, id: Column, ln: Column) -> Column:
        if not self.width:
            return F.struct(id.alias("id"), ln.alias("ln"))
        return (id.cast("long") - F.lit(self.lo)) * F.lit(self.width) + ln

    def split(self, p: str) -> list[Column]:
        if not self.width:
            return [F.col(p)["id"].alias("id"), F.col(p)["ln"].alias("ln")]
        return [(F.call_function("div", F.col(p), F.lit(self.width)) + F.lit(self.lo)).cast(self.kind).alias("id"), F.pmod(F.col(p), F.lit(self.width)).cast("int").alias("ln")]


@dataclass(frozen=True)
class Lines:
    """The lines of a table of texts that have so many words at least."""

    docs: DataFrame
    id_col: str
    text_col: str
    least: int
    places: Places

    def _split(self) -> DataFrame:
        texts = self.docs.filter(F.col(self.id_col).isNotNull()).select(F.col(self.id_col).alias("id"), F.col(self.text_col).alias("text"), plain(F.col(self.text_col)).alias("plain"))
        lines = texts.select("id", "plain", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
        return lines.select(self.places.at(F.col("id"), F.col("ln")).alias("p"), "line", "plain")

    def each(self) -> DataFrame:
        """p, line, words."""
        found = self._split().select("p", "line", once(line_words(F.col("line"), F.col("plain"))).alias("words"))
        return found.filter(takes_part(F.col("words"), self.least))

    def chosen(self, places: DataFrame) -> DataFrame:
        """p, words of the places given, which are distinct: these lines travel, dealt by p, and few others."""
        held = among(self._split(), places, ["p"], PLACE_BITS).join(places.hint("shuffle_hash"), "p")
        found = held.select("p", once(line_words(F.col("line"), F.col("plain"))).alias("words"))
        return found.filter(takes_part(F.col("words"), self.least))


def _class(t: Column, words: Column) -> Column:
    return slot_class(t, TOKEN_BITS, words)


def postings_of(posts: DataFrame) -> DataFrame:
    return posts.select("p", "n", F.posexplode("prefix").alias("i", "t"))


def prefix_of(tokens: str) -> Column:
    """n, the size of a set, and its prefix in the order of its tokens."""
    n = F.size(tokens)
    return F.struct(n.alias("n"), F.slice(F.sort_array(tokens), 1, n - F.ceil(n * NUM / DEN).cast("int") + 1).alias("prefix"))


def posted(lines: Lines) -> tuple[DataFrame, DataFrame]:
    """p, n and prefix of each distinct line, and t, the tokens that may have two lines or more.

    The first order is by hash. The tokens of most lines in it, counted over all postings, become the last of the
    order that holds, by class of frequency, and the lines that have one in their prefix are posted again.
    """
    keyed = lines.each().select(F.xxhash64("line").alias("k"), F.xxhash64(F.lit(1), "line").alias("k2"), "p", "words")
    seen = with_tokens(keyed, "k", "k2", "p").select("k", "k2", "p", prefix_of("x").alias("x"))
    first = written(seen.groupBy("k", "k2").agg(F.min("p").alias("p"), F.first("x").alias("x")).select("p", "x.n", "x.prefix"), "posts")
    common = written(postings_of(first).groupBy("t").agg(F.count("*").alias("c")).filter("c > 1"), "common")
    classes = slots(common.filter(F.col("c") >= FREQUENT).orderBy(F.desc("c"), "t").limit(TOP).collect(), TOKEN_BITS, FREQUENT)
    if classes is None:
        return first, common.select("t")
    known = constant_table(classes)
    moved = written(postings_of(first).filter(_class(F.col("t"), known) > 0).select("p").distinct(), "moved")
    classed = with_tokens(lines.chosen(moved), "p").select("p", F.transform("x", lambda t: F.shiftleft(_class(t, known), TOKEN_BITS).bitwiseOR(t)).alias("x"))
    found = classed.select("p", prefix_of("x").alias("x"))
    late = written(found.groupBy("p").agg(F.max("x").alias("x")).select("p", "x.n", "x.prefix"), "late")
    same = first.filter(~F.exists("prefix", lambda t: _class(t, known) > 0))
    return same.unionByName(late), written(common.select("t").unionByName(late.select(F.explode("prefix").alias("t"))).distinct(), "common")


def _may_match(n: Column, i: Column, m: Column, j: Column) -> Column:
    """Length and positional filter for a common token at places i and j (from 0) of sets of n and m."""
    like = F.least(n, m) * DEN >= F.greatest(n, m) * NUM
    return like & (F.least(n - i, m - j) * (NUM + DEN) >= NUM * (n + m))


def shared_postings(posts: DataFrame, common: DataFrame) -> DataFrame:
    """t, p, n, i, and c, the lines of t, of postings under tokens that two lines or more have, written. Tokens were
    counted before anything else travels: a token of very many lines is a skewed join's stream, never one task's group."""
    held = written(among(postings_of(posts), common, ["t"], PLACE_BITS).join(common.hint("shuffle_hash"), "t").select("t", "p", "n", "i"), "postings")
    counts = held.groupBy("t").agg(F.count("*").alias("c")).filter("c > 1")
    return written(held.join(counts.hint("shuffle_hash"), "t"), "postings")


#: A set's sketch: the parity of its tokens in 64 * SKETCH_WORDS places. Two sketches differ in no more places than the sets do.
SKETCH_WORDS = 8
SKETCH_OF = [f"s{q}" for q in range(SKETCH_WORDS)]


def sketches(sets: DataFrame) -> DataFrame:
    """p, s0, s1, ... of each set (p, x)."""
    token = F.col("t")
    place = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(token, 3).bitwiseAND(F.lit(63)).cast("int"))
    parity = [F.bit_xor(F.when(token.bitwiseAND(F.lit(SKETCH_WORDS - 1)) == q, place).otherwise(F.lit(0).cast("long"))).alias(name) for q, name in enumerate(SKETCH_OF)]
    return sets.select("p", F.explode("x").alias("t")).groupBy("p").agg(*parity)


def _near(n: Column, m: Column, mine: list[Column], other: list[Column]) -> Column:
    """Whether sketches leave it open that sets of n and m reach the similarity."""
    differ = F.lit(0)
    for x, y in zip(mine, other):
        differ += F.bit_count(x.bitwiseXOR(y))
    return differ * (NUM + DEN) <= (n + m) * (DEN - NUM)


def _matched(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """p of the pairs (p, a), a table, that reach the similarity, written. Few other sets travel."""
    mine = among(sets, pairs.select("p"), ["p"], PLACE_BITS)
    other = among(sets, pairs.select(F.col("a").alias("p")), ["p"], PLACE_BITS).select(F.col("p").alias("a"), F.col("x").alias("y"))
    both = pairs.join(mine, "p").join(other, "a")
    shared = both.select("p", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("both"))
    return written(shared.filter(F.col("both") * DEN >= (F.col("n") - F.col("both")) * NUM).select("p").distinct(), "gone")


def later_matches(lines: Lines, postings: DataFrame) -> DataFrame:
    """p of each distinct line that an earlier distinct line matches, written; postings: the shared ones."""
    fits = (F.col("a") < F.col("p")) & _may_match(F.col("n"), F.col("i"), F.col("m"), F.col("j"))

    def tried(left: DataFrame, hubs: DataFrame) -> DataFrame:
        return left.join(hubs, "t").filter(fits).select("p", "a").distinct()

    # each token's earliest line meets the others: those that go need no more search
    hubs = written(_hubs(postings), "hubs")
    pairs = written(tried(postings, hubs), "pairs")
    places = pairs.select("p").unionByName(pairs.select(F.col("a").alias("p"))).unionByName(postings.filter("c > 2").select("p"))
    found = with_tokens(lines.chosen(written(places.distinct(), "places")), "p")
    sets = written(found.groupBy("p").agg(F.max("x").alias("x")), "sets")
    gone, left, n_postings = _matched(pairs, sets), postings.filter("c > 2"), postings.count()
    for done in range(ROUNDS):
        left = written(left.join(gone, "p", "left_anti"), "left")
        crowd = left.groupBy("t").agg((F.count("*") * F.max("c")).alias("pairs")).agg(F.sum("pairs")).first()[0]
        if (crowd or 0) <= FEW * n_postings or done == ROUNDS - 1:
            break
        # many lines under few tokens: the earliest that are left, and were not tried, meet the others too
        hubs = written(_hubs(left.join(hubs.select("t", F.col("a").alias("last")), "t").filter("p > last")), "hubs")
        gone = written(gone.unionByName(_matched(written(tried(left, hubs), "pairs"), sets)), "gone")
    hits = written(partners(left, postings, sets), "hits")
    # nearly all that sketches leave open match: a line's earliest partner first, the others of those that it does not match
    now = _matched(written(hits.groupBy("p").agg(F.min(F.array_min("partners")).alias("a")), "pairs"), sets)
    others = written(hits.join(now, "p", "left_anti").select("p", F.explode("partners").alias("a")).distinct(), "pairs")
    return written(gone.unionByName(now).unionByName(_matched(others, sets)).distinct(), "gone")


def _hubs(postings: DataFrame) -> DataFrame:
    return postings.groupBy("t").agg(F.min("p").alias("a"), F.min_by("n", "p").alias("m"), F.min_by("i", "p").alias("j"))


def partners(left: DataFrame, postings: DataFrame, sets: DataFrame) -> DataFrame:
    """p and its earlier lines that filters and sketches leave open, by token, as an array; rows of none are left out. The
    lines of a token come in blocks: no row is made for a pair."""
    blocks = F.ceil(F.col("c") / F.lit(BLOCK)).cast("long")
    entry = F.struct("p", "n", "i", *SKETCH_OF)
    asked = left.select("t").distinct()
    asked_for = written(postings.join(asked, "t", "left_semi"), "asked")
    drawn = written(sketches(sets.join(asked_for, "p", "left_semi")), "sketches")
    every = asked_for.join(drawn, "p").select("t", F.pmod(F.xxhash64("p"), blocks).alias("b"), entry.alias("e"))
    held = every.groupBy("t", "b").agg(F.collect_list("e").alias("block"), F.min("e.p").alias("least"))
    each = left.select("t", "p", "n", "i").join(drawn, "p").join(held, "t").filter("least < p")

    def open_to(e: Column) -> Column:
        fits = (e["p"] < F.col("p")) & _may_match(F.col("n"), F.col("i"), e["n"], e["i"])
        return F.when(fits, _near(F.col("n"), e["n"], [F.col(c) for c in SKETCH_OF], [e[c] for c in SKETCH_OF])).otherwise(False)

    found = each.select("p", F.transform(F.filter("block", open_to), lambda e: e["p"]).alias("partners"))
    return found.filter(F.size("partners") > 0)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: bool = False) -> DataFrame:
    """docs with text_col less the lines that go, and __n_lines, __removed (their numbers, from 0); short: lines of
    fewer than WORDS words take part."""
    lines = Lines(docs, id_col, text_col, 1 if short else WORDS, Places.over(docs, id_col, text_col))
    pattern = ANY if short else LONG
    with scratch() as held:
        with scratch() as early:
            posts, common = posted(lines)
            postings, places = shared_postings(posts, common), written(posts.select("p"), "lines")
            early.keep(postings, places)  # the prefixes, and postings that nothing shares, go now
        gone = later_matches(lines, postings)
        first = places.join(gone, "p", "left_anti").select(*lines.places.split("p"))
        kept = written(first.groupBy("id").agg(F.collect_list("ln").alias("kept")), "kept")
        held.keep(kept)
    others = [c for c in docs.columns if c not in ("__n_lines", "__removed")]
    rows = docs.select(F.struct(*(c for c in others if c != text_col)).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = F.split(F.coalesce("text", F.lit("")), "\n")
    joined = rows.join(kept.hint("shuffle_hash"), "id", "left").select("row", "id", "text", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"), parts.alias("parts"))
    taking = F.filter(F.sequence(F.lit(0), F.size("parts") - 1), lambda i: F.get("parts", i).rlike(pattern))
    removed = F.when(F.col("id").isNull(), F.array().cast("array<int>")).otherwise(F.array_except(taking, "kept"))
    found = joined.select("row", "text", "parts", removed.alias("removed"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), "removed")
    less = F.array_join(F.transform(stay, lambda i: F.get("parts", i)), "\n")
    text = F.when(F.col("text").isNotNull() & (F.size("removed") > 0), less).otherwise(F.col("text"))
    return found.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in others), F.size("parts").alias("__n_lines"), F.col("removed").alias("__removed"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: lines, how many go, their numbers, and the text's length without them."""
    out = dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__n_lines").cast("long").alias("n_lines"), F.size("__removed").cast("long").alias("n_removed"), F.array_join(F.transform("__removed", lambda i: i.cast("string")), ",").alias("removed"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars_left"))


QUERIES = {"op8_line_dedup": op8_line_dedup}

ORACLE = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS ln, unnest(ls) AS x FROM d),
w AS (SELECT doc_id, ln, x, list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS ws FROM l),
f AS MATERIALIZED (SELECT x, any_value(ws) AS ws, min((doc_id, ln)) AS place, row_number() OVER (ORDER BY min((doc_id, ln))) AS r FROM w WHERE len(ws) >= 5 GROUP BY x),
u AS (SELECT r, unnest(ws) AS y, generate_subscripts(ws, 1) AS i FROM f),
g AS (SELECT r, string_agg(y, ' ') OVER o AS g, count(*) OVER o AS c FROM u WINDOW o AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
s AS MATERIALIZED (SELECT DISTINCT r, hash(g) AS g FROM g WHERE c = 5),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
gone AS (SELECT DISTINCT b AS r FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 10 * shared >= 8 * (x.n + y.n - shared)),
k AS (SELECT place[1] AS doc_id, place[2] AS ln FROM f WHERE r NOT IN (SELECT r FROM gone)),
m AS (SELECT w.doc_id, w.ln, w.x, len(ws) >= 5 AND k.ln IS NULL AS goes FROM w LEFT JOIN k ON k.doc_id = w.doc_id AND k.ln = w.ln)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE goes)::BIGINT AS n_removed,
       coalesce(string_agg(ln::VARCHAR, ',' ORDER BY ln) FILTER (WHERE goes), '') AS removed,
       coalesce(length(string_agg(x, chr(10) ORDER BY ln) FILTER (WHERE NOT goes)), 0)::BIGINT AS n_chars_left
FROM m GROUP BY doc_id
"""
ORACLES = {"op8_line_dedup": ORACLE}
