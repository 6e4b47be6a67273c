"""N-gram Jaccard join by T-occurrence search.

A text is the set of its distinct word k-grams; texts of equal sets are one. Two sets link when the intersection
is at least num/den of the union. Search space: linked sets are of the same size band or of neighbouring ones and
differ in at most d k-grams, d a number of the band; so of d + t parts of the hash space t at least hold the same
k-grams of both. That is a T-occurrence problem too, over hashes of parts: sets that share fewer than t parts with all
others together are out, the others are posted under their rarest shared parts, all but t - 1; sets under one part make
clusters that no link leaves. Sets that share but passages have few equal parts. A cluster is searched in one task; a
large one by size band in chunks, each with heads (sets drawn by hash) of all the others, which connects groups of near
copies, and then either chunk by chunk or by equal part, whichever reads fewer k-grams; of parts only those whose sets are
of several components so far: a missing link is between two of those, so nothing is lost. In a task, sets are differences
from centres, the k-grams that most sets of a group have: what near copies share is in no list, and two sets share
what both have of the centre and what their differences share. Sets come in increasing size: a set's inverted lists
are divided; the short ones are merged, the long ones are probed by binary search, and sets that reach the required
overlap are links. Sets of the query's own component are left out: they cannot connect anything new. After the first
units, sets of a unit's largest component do not ask, as the others ask them.

Defined results: null and empty texts have an empty set and link with nothing; a null id has no component;
repeated rows are one set; an empty table gives an empty result; other columns are ignored. k-grams are compared
by 64-bit hashes, equal sets by 128 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkstrata.llm import _bytes as B
from inkstrata.llm._shared import among, constant_table, drop, frequent_slots, scratch, slot_class, tidy, written
from inkstrata.llm.components import Forest, components
from inkstrata.session import table

#: Shingles of a search unit.
UNIT = 2_000_000
#: A part that so many sets have, if it is among the most frequent, need not meet its like in one task to be known as shared.
FREQUENT = 1024
#: How often sets with too few shared parts are left out, and the parts counted again.
ROUNDS = 3
MU = 0.0085
#: Parts beyond those that pigeonholes need, as a share of these: so many parts at least are equal in linked sets.
SPARE = 0.3
#: Centres that a unit may have, and the sets of a centre at least.
LEADERS, GROUP = 32, 16
#: Sets that are probed one by one; for more, the long lists are merged too.
PROBES = 64


def _needed(n: int, num: int, den: int) -> int:
    """Overlap at least of a set of n with any other that it links with."""
    return -(-num * n // den)


def size_bands(num: int, den: int, upto: int) -> np.ndarray:
    """First size of each band, to beyond upto: a size that links with one of a band is in it or in the one before."""
    first = [1]
    while first[-1] <= upto:
        first.append(first[-1] * den // num + 1)
    return np.array([*first, first[-1] * den // num + 1], np.int64)


def part_keys(s: np.ndarray, num: int, den: int, bands: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Hashes of the parts of a sorted set, in the division of its own band and of the next, for larger partners; and how
    many of these hashes any set that links with it shares at least."""
    own = int(np.searchsorted(bands, len(s), "right")) - 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(B.mix(s + np.uint64(1)))])
    out = []
    for band in (own, own + 1):
        differ = 2 * (int(bands[band + 1]) - 1) * (den - num) // (num + den)
        parts = differ + 1 + (math.ceil(SPARE * (differ + 1)) if differ else 0)
        edges = np.array([-(-(i << 64) // parts) for i in range(1, parts)], np.uint64) if parts < 64 else (np.arange(1, parts, dtype=np.float64) * (2.0**64 / parts)).astype(np.uint64)
        at = np.concatenate([[0], np.searchsorted(s, edges), [len(s)]])
        filled = np.diff(at) > 0
        with np.errstate(over="ignore"):
            keys = B.mix((sums[at[1:]] - sums[at[:-1]]) ^ B.mix(np.arange(parts, dtype=np.uint64) * B.MULTS[5] + np.uint64(band + 1) * B.MULTS[6]))
        # of the equal parts no more are empty than the set has; if all may be, empty ones count too, and one is sure
        sure = parts - differ - int((~filled).sum())
        out.append((keys[filled], sure) if sure > 0 else (keys, 1))
    return out


def signatures(texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """id, n, digest of the set, node (even), and per division the hashes of its parts and how many a link shares, of each text."""
    columns = [("own", pa.list_(pa.int64())), ("own_sure", pa.int64()), ("next", pa.list_(pa.int64())), ("next_sure", pa.int64())]
    schema = pa.schema([("n", pa.int64()), ("digest", pa.binary()), ("node", pa.int64()), *columns])

    def run(batches):
        bands = size_bands(num, den, 1 << 16)
        for b in batches:
            out: list[list] = [[] for _ in range(len(schema) + 1)]
            held = 0

            def flush():
                return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(out[0], pa.int64())), *(pa.array(c, f.type) for c, f in zip(out[1:], schema))], names=["id", *schema.names])

            for r, words in B.each_text(b.column(1), B.WHITESPACE):
                s = B.shingles(words, k)
                row = [len(s), *[None] * 6]
                if len(s):
                    if len(s) >= bands[-2]:
                        bands = size_bands(num, den, 2 * len(s))
                    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                    (own, own_sure), (after, after_sure) = part_keys(s, num, den, bands)
                    row = [len(s), digest, (int.from_bytes(digest[:8], "little") >> 2) * 2, own.view(np.int64), own_sure, after.view(np.int64), after_sure]
                    held += len(own) + len(after)
                for c, v in zip(out, [r, *row]):
                    c.append(v)
                if held > 1 << 18:
                    yield flush()
                    out, held = [[] for _ in range(len(schema) + 1)], 0
            if out[0]:
                yield flush()

    return texts.select("id", "text").mapInArrow(tidy(run), "id long, n long, digest binary, node long, own array<long>, own_sure long, next array<long>, next_sure long")


def shared_parts(once: DataFrame) -> DataFrame:
    """key and u (node, or node + 1 for the division of the next band) of parts that two sets or more have, written. once:
    distinct sets. Parts are sorted by key; of very common ones, each set's is known as shared without its like."""
    each = once.select(F.explode("own").alias("key"), F.col("node").alias("u")).unionByName(once.select(F.explode("next").alias("key"), (F.col("node") + 1).alias("u")))
    hot = frequent_slots(each.select("key"), 64, FREQUENT)
    common = F.lit(False) if hot is None else slot_class(F.col("key"), 64, constant_table(hot)) > 0
    order = Window.partitionBy("key").orderBy("u")
    beside = each.filter(~common).select("key", "u", F.lag("u").over(order).alias("before"), F.lead("u").over(order).alias("after"))
    found = beside.filter("before is not null or after is not null").select("key", "u")
    return written(found if hot is None else found.unionByName(each.filter(common)), "shared")


def posted_parts(shared: DataFrame, needs: DataFrame) -> DataFrame:
    """key and node of the parts that a set is searched under, written. needs: u, and how many parts a link shares.

    T-occurrence, by parts: a set with fewer shared parts than a link needs has none; the others, in the order of rarity
    (sets that have the part, then its hash), are posted under all but the last that a link needs, less one.
    """
    left = shared
    for _ in range(ROUNDS):
        several = left.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
        counted = left.join(several, "key")
        enough = counted.groupBy("u").agg(F.count("*").alias("s")).join(needs, "u").filter("s >= sure")
        left = written(counted.join(enough.select("u"), "u", "left_semi").select("key", "u"), "shared")
    several = left.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    order = Window.partitionBy("u").orderBy("c", "key")
    ranked = left.join(several, "key").select("key", "u", F.row_number().over(order).alias("r"), F.count("*").over(Window.partitionBy("u")).alias("s"))
    out = ranked.join(needs, "u").filter("r <= s - sure + 1").select("key", (F.col("u") - F.pmod("u", F.lit(2))).alias("node"))
    return written(out, "parts")


def cluster_edges(parts: DataFrame) -> DataFrame:
    """Edges (a, b: nodes) whose components no link leaves: from each set to the first one under each of its parts."""
    first = parts.groupBy("key").agg(F.min("node").alias("b"))
    return parts.join(first, "key").select(F.col("node").alias("a"), "b").filter("a <> b")


def size_band(n: str, num: int, den: int):
    """Sets that can link are of the same band or of neighbouring ones."""
    return F.floor(F.log(F.col(n).cast("double")) / F.lit(math.log(den / num)) + 1e-9)


def sizes_of(members: DataFrame, *keys: str) -> DataFrame:
    return members.groupBy(*keys).agg(F.sum("n").alias("total"), F.count("*").alias("sets")).filter("sets > 1")


UNIT_KEY = ["cluster", "band", "i", "j"]


def small_units(members: DataFrame, unit: int) -> DataFrame:
    """id, n and unit (cluster, band, i, j) of the members of clusters that one task searches."""
    return members.join(sizes_of(members, "cluster").filter(F.col("total") <= unit).select("cluster"), "cluster").select(F.col("rep").alias("id"), "n", "cluster", *(F.lit(-1).cast("long").alias(c) for c in UNIT_KEY[1:]))


def large_members(members: DataFrame, num: int, den: int, unit: int) -> DataFrame:
    """The members of larger clusters by size band, each band with the one below: id, n, cluster, band, chunk (of at most
    half a unit, more or less), chunks, and whether the set is one of the band's heads, a quarter of a unit at most."""
    own = size_band("n", num, den)
    large = members.join(sizes_of(members, "cluster").filter(F.col("total") > unit).select("cluster"), "cluster")
    banded = large.select(F.col("rep").alias("id"), "n", "node", "cluster", own.alias("own"), F.explode(F.array(own, own + 1)).alias("band"))
    # sets that are all of the band below meet there
    topped = banded.filter("own = band").select("cluster", "band").distinct()
    load = sizes_of(banded, "cluster", "band").join(topped, ["cluster", "band"]).select("cluster", "band", "total", F.ceil(2 * F.col("total") / F.lit(unit)).cast("long").alias("chunks"))
    share = F.lit(unit / 4) / F.col("total") * (1 << 20)
    return banded.join(load, ["cluster", "band"]).select("id", "n", "node", "cluster", "band", F.pmod(F.xxhash64("id"), "chunks").alias("chunk"), "chunks", (F.pmod(F.xxhash64("id", F.lit("head")), F.lit(1 << 20)) < share).alias("head"))


def first_units(large: DataFrame) -> DataFrame:
    """Every chunk by itself, with the heads of all chunks: groups of near copies are connected after this."""
    own = large.select("id", "n", "cluster", "band", F.col("chunk").alias("i"), F.col("chunk").alias("j"))
    heads = large.filter("head and chunks > 1").select("id", "n", "cluster", "band", "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("i")).filter("i <> chunk")
    return own.unionByName(heads.select("id", "n", "cluster", "band", "i", F.col("i").alias("j")))


def pair_units(large: DataFrame) -> DataFrame:
    """Every chunk with every other one of its band; large has labels: the components so far."""
    several = large.groupBy("cluster", "band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("cluster", "band")
    met = large.filter("chunks > 1").join(several, ["cluster", "band"]).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).filter("with <> chunk")
    return met.select("id", "n", "cluster", "band", F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"), "label")


def last_units(large: DataFrame, parts: DataFrame, joined: DataFrame, unit: int) -> DataFrame:
    """What may still be missing: links between sets of different components so far that have an equal part. Units are the
    parts whose sets are of several components; a part with very many sets is searched in chunks, the sets outside its
    largest component (i) with all sets (j). A cluster whose parts hold more than its pairs of chunks, as near copies that
    do not link, is searched by these. label: the component so far."""
    labelled = large.join(joined.select(F.col("node").alias("id"), "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = labelled.select("id", "n", "node", "label", F.col("cluster").alias("of")).distinct()
    keyed = named.join(parts.distinct(), "node").select("id", "n", "label", "of", F.col("key").alias("cluster"))
    mixed = keyed.groupBy("cluster").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.sum("n").alias("total"), F.first("of").alias("of")).filter("lo < hi").select("cluster", "of", "total")
    copies = F.when(F.col("total") > unit, 2 * F.ceil(2 * F.col("total") / F.lit(unit))).otherwise(1)
    by_parts = mixed.groupBy("of").agg(F.sum(F.col("total") * copies).alias("by_parts"))
    by_pairs = large.groupBy(F.col("cluster").alias("of")).agg(F.sum(F.col("n") * (F.col("chunks") - 1)).alias("by_pairs"))
    paired = written(by_parts.join(by_pairs, "of").filter("by_pairs <= by_parts").select("of"), "paired")
    told = written(keyed.join(mixed.join(paired, "of", "left_anti").select("cluster", "total"), "cluster"), "told")
    none = [F.lit(-2).cast("long").alias("band"), *(F.lit(-1).cast("long").alias(c) for c in ("i", "j"))]
    columns = ["id", "n", *UNIT_KEY, "label"]
    few = told.filter(F.col("total") <= unit).select("id", "n", "label", "cluster", *none)
    many = told.filter(F.col("total") > unit).withColumn("chunks", F.ceil(2 * F.col("total") / F.lit(unit)).cast("long"))
    most = many.groupBy("cluster", "label").agg(F.count("*").alias("c")).groupBy("cluster").agg(F.max_by("label", F.struct("c", -F.col("label"))).alias("main"))
    dealt = many.join(most, "cluster").select("id", "n", "label", "cluster", none[0], "chunks", F.pmod(F.xxhash64("id"), "chunks").alias("chunk"), (F.col("label") != F.col("main")).alias("outside"))
    outsiders = dealt.filter("outside").withColumn("i", F.col("chunk")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).filter("i <> j")
    open_chunks = dealt.filter("outside").groupBy("cluster").agg(F.collect_set("chunk").alias("open"))
    others = dealt.join(open_chunks, "cluster").withColumn("j", F.col("chunk")).withColumn("i", F.explode("open"))
    pairs = pair_units(labelled.join(paired.select(F.col("of").alias("cluster")), "cluster", "left_semi"))
    return few.select(columns).unionByName(outsiders.select(columns)).unionByName(others.select(columns)).unionByName(pairs.select(columns))


def gathered(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of slices that start at first, one slice after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - ends + lengths, lengths)


class Group:
    """Sets of a unit as differences from a centre: inverted lists of what a set has beyond the centre's tokens, and of
    those that it lacks. Two sets of near copies have most of their tokens in no list."""

    def __init__(self, members: np.ndarray, centre: np.ndarray, rows: list[np.ndarray], sizes: np.ndarray):
        self.members, self.centre, self.sizes = members, centre, sizes[members]
        held = [self.differ(rows[i]) for i in members.tolist()]
        self.inside = np.array([h[0] for h in held], np.int64)
        self.rows = [h[1] for h in held]
        self.widest = int((self.sizes + len(centre) - 2 * self.inside).max())
        tokens = np.concatenate(self.rows)
        owner = np.repeat(np.arange(len(members)), [len(r) for r in self.rows])
        order = np.argsort(tokens, kind="stable")
        tokens, self.owner = tokens[order], owner[order]
        self.first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
        self.tokens, self.lengths = tokens[self.first], np.diff(np.append(self.first, len(tokens)))

    def differ(self, row: np.ndarray) -> tuple[int, np.ndarray]:
        """How many of the centre's tokens a set has, and its difference, sorted."""
        if not len(self.centre):
            return 0, row
        at = np.searchsorted(self.centre, row)
        at[at == len(self.centre)] = 0
        inside = self.centre[at] == row
        lacks = np.ones(len(self.centre), bool)
        lacks[at[inside]] = False
        return int(inside.sum()), np.sort(np.concatenate([row[~inside], self.centre[lacks]]))

    def lists(self, tokens: np.ndarray) -> np.ndarray:
        """The lists of these tokens, the shortest first."""
        at = np.searchsorted(self.tokens, tokens)
        at = at[self.tokens[np.minimum(at, len(self.tokens) - 1)] == tokens] if len(self.tokens) else at[:0]
        return at[np.argsort(self.lengths[at], kind="stable")]

    def merge(self, lists: np.ndarray) -> np.ndarray:
        """On how many of the lists each set is."""
        return np.bincount(self.owner[gathered(self.first[lists], self.lengths[lists])], minlength=len(self.members))

    def probe(self, tokens: np.ndarray, x: int) -> int:
        """How many of the long lists hold set x, by binary search."""
        own = self.rows[x]
        if not len(own):
            return 0
        at = np.searchsorted(own, tokens)
        at[at == len(own)] = 0
        return int((own[at] == tokens).sum())


class TOccurrence:
    """DivideSkip over the sets of one unit, which come in increasing size, on their differences from centres.

    With a and b tokens of a centre of c in two sets, these share a + b - c tokens and as many more as their differences
    share: a T-occurrence problem over the lists of differences. The short ones are merged, the long ones probed.
    """

    def __init__(self, ids: list[int], sets: list[np.ndarray], num: int, den: int, labels: list[int] | None = None):
        self.ids, self.num, self.den = ids, num, den
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.component = np.arange(len(sets))
        self.main = None
        if labels:  # sets of one label are connected already; those of the largest one need not ask
            _, first, self.component = np.unique(np.array(labels, np.int64), return_index=True, return_inverse=True)
            self.main = self.component == np.bincount(self.component).argmax()
        tokens, numbers, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = held > 1  # a list of one set connects nothing
        numbers = np.where(shared[numbers], (np.cumsum(shared) - 1)[numbers], -1)
        edges = np.cumsum(self.sizes)[:-1]
        self.rows = [r[r >= 0] for r in np.split(numbers, edges)]
        self.width = int(shared.sum())
        self.groups = [Group(members, centre, self.rows, self.sizes) for members, centre in self.centres()]

    def centres(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Groups of sets that share half of the most central one's tokens or more, with the tokens that most of them have;
        the sets that are left have an empty centre. Any division gives the same links."""
        out, left, none = [], np.arange(len(self.rows)), np.zeros(0, np.int64)
        rest = []
        for _ in range(LEADERS):
            if len(left) < GROUP:
                break
            tokens = np.concatenate([self.rows[i] for i in left.tolist()])
            owner = np.repeat(np.arange(len(left)), [len(self.rows[i]) for i in left.tolist()])
            often = np.bincount(tokens, minlength=self.width)
            central = np.bincount(owner, often[tokens], len(left)) / self.sizes[left]
            leader = int(central.argmax())
            mine = np.zeros(self.width, bool)
            mine[self.rows[left[leader]]] = True
            near = 2 * np.bincount(owner[mine[tokens]], minlength=len(left)) > self.sizes[left[leader]]
            near[leader] = True
            if (n := int(near.sum())) >= GROUP:
                out.append((left[near], np.flatnonzero(2 * np.bincount(tokens[near[owner]], minlength=self.width) > n)))
            else:
                rest.append(left[near])
            left = left[~near]
        left = np.sort(np.concatenate([left, *rest]))
        return out + ([(left, none)] if len(left) else [])

    def links(self) -> Iterator[tuple[int, int]]:
        """Links that connect all components: each joins two that no earlier one did."""
        for q in range(len(self.rows)):
            if self.main is None or not self.main[q]:
                for group in self.groups:
                    yield from self.search(q, group)

    def search(self, q: int, group: Group) -> Iterator[tuple[int, int]]:
        """Links of q with smaller sets of the group, and with larger ones that do not ask themselves."""
        n, num, den = int(self.sizes[q]), self.num, self.den
        lo = int(np.searchsorted(group.sizes, _needed(n, num, den)))
        hi = int(np.searchsorted(group.members, q) if self.main is None else np.searchsorted(group.sizes, n * den // num, "right"))
        if lo >= hi:
            return
        members = group.members[lo:hi]
        other = self.component[members] != self.component[q]
        if self.main is not None:
            other &= (members < q) | self.main[members]
        at = np.flatnonzero(other) + lo
        if not len(at):
            return
        inside, row = group.differ(self.rows[q])
        if (n + len(group.centre) - 2 * inside - group.widest) * (num + den) > (n + int(group.sizes[hi - 1])) * (den - num):
            return
        need = -(-num * (n + group.sizes[at]) // (num + den)) - (inside + group.inside[at] - len(group.centre))
        lists = group.lists(row)
        least = int(need.min())
        if len(lists) < least:
            return
        long = min(least - 1, int(least / (MU * math.log2(max(2, int(group.lengths[lists[-1]]))) + 1))) if least > 1 else 0
        short, probed = lists[: len(lists) - long], lists[len(lists) - long :]
        count = group.merge(short)[at]
        found = count >= need - long
        at, need, count = at[found], need[found], count[found]
        if long and len(at) > PROBES:
            count = count + group.merge(probed)[at]
            found, long = count >= need, 0
            at, need, count = at[found], need[found], count[found]
        tokens = group.tokens[probed]
        while len(at):
            x = int(group.members[at[0]])
            keep = np.arange(len(at)) > 0
            if not long or count[0] + group.probe(tokens, int(at[0])) >= need[0]:
                self.component[self.component == self.component[x]] = self.component[q]
                yield self.ids[q], self.ids[x]
                keep = self.component[group.members[at]] != self.component[q]  # sets of the joined component drop out
            at, need, count = at[keep], need[keep], count[keep]


def search_units(rows: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links (a, b: ids) within each unit; rows: cluster, band, i, j, n, id, text, label if sets are connected already,
    dealt by unit and sorted by size and id in it."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        key, ids, sets, labels, out = None, [], [], [], []

        def close():
            if len(ids) > 1:
                out.extend(TOccurrence(ids, sets, num, den, labels).links())

        def flushed():
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in (0, 1)], schema=schema)

        for b in batches:
            units = list(zip(*(b.column(c).to_pylist() for c in (*UNIT_KEY, "id", "n"))))
            known = b.column("label").to_pylist() if "label" in b.schema.names else None
            for r, words in B.each_text(b.column("text"), B.WHITESPACE):
                if units[r][:4] != key:
                    close()
                    key, ids, sets, labels = units[r][:4], [], [], []
                s = B.shingles(words, k)
                if len(s) == units[r][5]:  # an id that repeats with another text brings that too
                    ids.append(units[r][4])
                    sets.append(s)
                    if known:
                        labels.append(known[r])
            if len(out) > 10_000:
                yield flushed()
                out = []
        close()
        yield flushed()

    return rows.mapInArrow(tidy(run), "a long, b long")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85, den: int = 100, unit: int = UNIT) -> DataFrame:
    """id, n_shingles and component_id (smallest id that links reach) of every row; ids are integers."""
    if dict(docs.dtypes)[id_col] not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError(f"{id_col} is no integer column: component ids are the smallest of integers")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def searched(units: DataFrame) -> DataFrame:
        # texts go to their units once: those of no unit stay where they are
        held = among(texts, units, ["id"]).join(units, "id")
        return written(search_units(held.repartition(*UNIT_KEY).sortWithinPartitions(*UNIT_KEY, "n", "id"), k, num, den), "links")

    with scratch() as scope:
        signed = written(signatures(texts, k, num, den), "signatures")
        sets = written(signed.select("id", "n", "digest", "node"), "sets")
        kept = ["node", "own", "own_sure", "next", "next_sure"]
        once = written(signed.filter("n > 0 and id is not null").groupBy("digest").agg(F.first(F.struct(*kept)).alias("s")).select("s.*"), "once")
        drop(signed)
        needs = written(once.select(F.col("node").alias("u"), F.col("own_sure").alias("sure")).unionByName(once.select((F.col("node") + 1).alias("u"), F.col("next_sure").alias("sure"))), "needs")
        shared = shared_parts(once)
        drop(once)
        parts = posted_parts(shared, needs)
        clusters = components(cluster_edges(parts))
        reps = sets.filter("n > 0 and id is not null").groupBy("digest", "n", "node").agg(F.min("id").alias("rep"))
        members = written(reps.join(clusters.select("node", F.col("label").alias("cluster")), "node"), "members")
        large = written(large_members(members, num, den, unit), "large")
        links = searched(written(small_units(members, unit).unionByName(first_units(large)), "units"))
        joined = components(links)
        if not large.isEmpty():
            rest = written(last_units(large, parts, joined, unit), "units")
            if not rest.isEmpty():
                joined = components(links.unionByName(searched(rest)))
        named = reps.join(joined.select(F.col("node").alias("rep"), "label"), "rep", "left").select("digest", F.coalesce("label", "rep").alias("component_id"))
        own = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("component_id", "id"))
        found = sets.select("id", "n", "digest").join(named, "digest", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), own).alias("component_id"))
        out = written(found, "components")
        scope.keep(out)
    return out


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs without those whose component has a smaller id; columns unchanged."""
    found = ngram_components(docs, id_col, text_col, k, num, den)
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(id_col)
    return docs.join(gone, id_col, "left_anti").select(docs.columns)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


QUERIES = {"op2_ngram_jaccard": op2_ngram_jaccard}

ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
u AS (SELECT doc_id, len(ws) AS m, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT doc_id, m, i, string_agg(w, ' ') OVER o AS g, count(*) OVER o AS c FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(g) AS g FROM g WHERE c = 4 OR (m < 4 AND i = 1)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
f AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT f.b, r.c FROM r JOIN f ON f.a = r.doc_id WHERE r.c < f.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c)::BIGINT AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id
"""
ORACLES = {"op2_ngram_jaccard": ORACLE}
