"""Secret scans with corpus-wide ownership frequency, in DataFrame functions alone.

Candidates of every kind are found in whole texts with their code-point spans. The hash of each candidate's value
is then counted over the corpus by distinct repositories and distinct owners: a value that many owners hold is a
copied example, one that few hold is live-looking. The base kinds (assign, access, hex) are reported whatever the
count says, with it as a verdict; the further kinds are reported only where they look live. The value of a private key
is its body without white space; a header without a whole key is reported whatever the count says.

Defined results: null and empty texts hold nothing; repeated rows are scanned each by itself; a null repository or
owner counts as one of its own; an empty table gives an empty result; other columns are ignored. Control
characters 1 and 2 in a text count as characters that no pattern takes.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkstrata.llm._shared import constant_table, frequent_slots, slot_class, written
from inkstrata.llm.quality import let
from inkstrata.session import table

#: A live-looking value has so many owners at most, and is in so many repositories at most; and a value that occurs
#: FREQUENT times is judged in SALTS pieces, if it is among the most frequent.
MAX_OWNERS, MAX_REPOS = 2, 8
FREQUENT, SALTS = 1024, 32


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Kind:
    """A pattern; group: the one that holds the secret; least: its characters at least; base: reported always; armored:
    the secret is its group less white space, and matches whose group is too short are their own value, reported always."""

    name: str
    pattern: str
    group: int
    least: int
    base: bool
    mixed: bool = False
    armored: bool = False


_WORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either_case("api") + "_?" + _either_case("key")
_HEADER = "-----BEGIN [A-Z ]*PRIVATE KEY-----"
#: No five hyphens in a row; hyphens at all only in the few header fields of a key.
_BODY = "[^-]*+(?:-{1,4}+[^-]++){0,32}"
KINDS = (
    Kind("assign", rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Kind("access", "AKIA[A-Z0-9]+", 0, 20, True),
    Kind("hex", "[0-9a-f]+", 0, 24, True),
    Kind("github", "gh[oprsu]_[A-Za-z0-9]{30,}", 0, 34, False),
    Kind("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15, False),
    Kind("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, False),
    Kind("private_key", f"{_HEADER}(?:({_BODY})-----END [A-Z ]*PRIVATE KEY-----)?", 1, 20, False, armored=True),
    Kind("blob", "[A-Za-z0-9+/_-]{32,}", 0, 32, False, mixed=True),
)
#: Matches of a text that one fold goes through.
BLOCK = 64
SPAN = "struct<start:int,kind_no:int,end:int,kind:string,value:string>"


def _quick(k: Kind) -> str:
    """A pattern that holds wherever a match can pass: runs too short to pass are not worth marking."""
    return {"hex": "[0-9a-f]{24}", "access": "AKIA[A-Z0-9]{16}"}.get(k.name, k.pattern)


def find(text: Column, number: int, k: Kind) -> Column:
    """Spans of one kind: leftmost matches that do not overlap, failing ones dropped; no Python, no positions lost.

    Matches are marked inside the text by two control characters; a fold over the marked pieces adds up lengths.
    """
    safe = F.translate(text, "\x01\x02", "\x03\x03")
    pieces = F.split(F.regexp_replace(safe, k.pattern, f"\x01$0\x02${k.group}\x02"), "\x01")

    def step(acc: Column, piece: Column) -> Column:
        def add(q: Column) -> Column:
            end = acc["at"] + F.length(q[0])
            value = q[1]
            if k.armored:
                body = F.regexp_replace(q[1], r"\s|\\[nrt]", "")
                value = F.when(F.length(body) >= k.least, body).otherwise(q[0])
            span = F.struct(acc["at"].alias("start"), F.lit(number).alias("kind_no"), end.alias("end"), F.lit(k.name).alias("kind"), value.alias("value"))
            ok = F.length(value) >= k.least
            if k.mixed:
                ok &= q[1].rlike("[A-Z]") & q[1].rlike("[a-z]") & q[1].rlike("[0-9]")
            return F.struct((end + F.length(q[2])).alias("at"), F.when(ok, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found")).cast(f"struct<at:int,found:array<{SPAN}>>")

        return F.transform(F.array(F.split(piece, "\x02")), add)[0]

    def fold(p: Column) -> Column:
        """By blocks of pieces: a fold copies what it has found, so no fold is longer than a block."""
        marked = F.slice(p, 2, F.size(p) - 1)
        starts = F.sequence(F.lit(1), F.greatest(F.size(p) - 1, F.lit(1)), F.lit(BLOCK))

        def placed(blocks: Column) -> Column:
            # a piece without its marks and its value's second copy
            shown = lambda q: F.length(q) - 2 - F.length(F.get(F.split(q, "\x02"), 1))
            sizes = F.transform(blocks, lambda x: F.aggregate(x, F.lit(0), lambda a, q: a + shown(q)))
            begins = F.aggregate(sizes, F.array(F.length(p[0])), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
            return let(begins, lambda at: F.flatten(F.transform(blocks, lambda x, i: folded(x, F.get(at, i)))))

        return F.when(F.size(p) < 2, F.array().cast(f"array<{SPAN}>")).otherwise(let(F.transform(starts, lambda i: F.slice(marked, i, BLOCK)), placed))

    def folded(block: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.array().cast(f"array<{SPAN}>").alias("found")).cast(f"struct<at:int,found:array<{SPAN}>>")
        return F.aggregate(block, start, step)["found"]

    return F.when(text.rlike(_quick(k)), F.transform(F.array(pieces), fold)[0]).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(docs: DataFrame, id_col: str, text_col: str, repo: Column, owner: Column, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """row, id, repo, owner and the candidate spans of each text, as a written table: texts are scanned once."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    found = F.concat(*(find(t, i, k) for i, k in enumerate(kinds)))
    return written(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(repo.cast("string"), F.lit("")).alias("repo"), F.coalesce(owner.cast("string"), F.lit("")).alias("owner"), F.array_sort(found).alias("spans")), "secrets")


def ownership(scanned: DataFrame) -> DataFrame:
    """Per candidate hash: distinct repositories, distinct owners, occurrences; counted before and after the shuffle."""
    held = scanned.select("repo", "owner", F.explode("spans").alias("s")).groupBy(F.sha2("s.value", 256).alias("hash"), "repo", "owner").agg(F.count("*").alias("n"))
    return held.groupBy("hash").agg(F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"), F.sum("n").alias("n_seen"))


def judged(each: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates (row, hash) with the counts of their hash. A hash that very many rows hold is dealt over SALTS tasks."""
    key = F.xxhash64("hash")
    hot = frequent_slots(each.select(key.alias("h")), 64, FREQUENT)
    if hot is None:
        return each.join(counts, "hash")
    often = slot_class(key, 64, constant_table(hot)) > 0
    salts = F.when(often, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = each.withColumn("salt", F.when(often, F.pmod(F.xxhash64("row", "start"), F.lit(SALTS)).cast("int")).otherwise(0))
    return dealt.join(counts.withColumn("salt", F.explode(salts)), ["hash", "salt"]).drop("salt")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo: Column | None = None, owner: Column | None = None, max_owners: int = MAX_OWNERS, kinds: tuple[Kind, ...] = KINDS, max_repos: int = MAX_REPOS) -> DataFrame:
    """id and spans (start, kind_no, end, kind, hash, n_repos, n_owners, live) of every text, none left out.

    repo, owner: whose text it is, by default column source with lang, and source.
    """
    scanned = scan(docs, id_col, text_col, repo if repo is not None else F.concat_ws("/", "source", "lang"), owner if owner is not None else F.col("source"), kinds)
    each = scanned.filter(F.size("spans") > 0).select("row", F.explode("spans").alias("s")).select("row", "s.*", F.sha2("s.value", 256).alias("hash"))
    told = judged(each, ownership(scanned)).withColumn("live", (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos))
    base = [i for i, k in enumerate(kinds) if k.base]
    bare = F.col("kind_no").isin([i for i, k in enumerate(kinds) if k.armored]) & (F.length("value") == F.col("end") - F.col("start"))
    reported = told.filter(F.col("kind_no").isin(base) | F.col("live") | bare)
    spans = reported.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "kind", "hash", "n_repos", "n_owners", "live"))).alias("spans"))
    none = F.array().cast(spans.schema["spans"].dataType)
    return scanned.select("row", F.col("id").alias(id_col)).join(spans, "row", "left").select(id_col, F.coalesce("spans", none).alias("spans"))


def _line(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda x: x["kind"] == kind


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    s = F.col("spans")
    counts = [F.size(F.filter(s, _is(n))).cast("long").alias(f"n_{n}") for n in ("assign", "access", "hex")]
    base = F.filter(s, lambda x: x["kind"].isin("assign", "access", "hex"))
    return found.select("doc_id", *counts, F.sha2(_line(base), 256).alias("base_sha256"), _line(s).alias("spans"), F.size(F.filter(s, lambda x: x["live"])).cast("long").alias("n_live"))


QUERIES = {"op4_secret_scan": op4_secret_scan}


def _oracle() -> str:
    # the SQL is as it was: it takes a key's header alone as the value; no given table holds one
    given = [replace(k, pattern=_HEADER, group=0) if k.armored else k for k in KINDS]
    each = "\nUNION ALL\n".join(
        f"SELECT r, {i} AS kind_no, '{k.name}' AS kind, {k.least} AS least, {str(k.mixed).lower()} AS mixed, {str(k.base).lower()} AS base, "
        f"string_split(regexp_replace(t, '{k.pattern.replace(chr(39), chr(39) * 2)}', chr(1) || '\\0' || chr(2) || '\\{k.group}' || chr(2), 'g'), chr(1)) AS p FROM d"
        for i, k in enumerate(given)
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, concat_ws('/', source, lang) AS repo, coalesce(source, '') AS owner,
                  translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents),
m AS ({each}),
u AS (SELECT * EXCLUDE (p), unnest(p) AS x, generate_subscripts(p, 1) AS i FROM m WHERE len(p) > 1),
q AS (SELECT *, string_split(x, chr(2)) AS y FROM u),
l AS (SELECT *, CASE WHEN i = 1 THEN length(x) ELSE length(y[1]) + length(y[3]) END AS n FROM q),
o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY r, kind_no ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM l),
c AS MATERIALIZED (SELECT r, kind_no, kind, base, s, s + length(y[1]) AS e, y[2] AS v FROM o
      WHERE i > 1 AND length(y[2]) >= least AND (NOT mixed OR (regexp_matches(y[2], '[A-Z]') AND regexp_matches(y[2], '[a-z]') AND regexp_matches(y[2], '[0-9]')))),
f AS (SELECT v, count(DISTINCT owner) AS owners FROM c JOIN d USING (r) GROUP BY v),
a AS MATERIALIZED (SELECT c.*, owners <= {MAX_OWNERS} AS live, kind || ':' || s || ':' || e AS z FROM c JOIN f USING (v) WHERE base OR owners <= {MAX_OWNERS}),
g AS (SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
             string_agg(z, ',' ORDER BY s, kind_no) FILTER (WHERE base) AS b, string_agg(z, ',' ORDER BY s, kind_no) AS spans, count(*) FILTER (WHERE live) AS n_live
      FROM a GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live
FROM d LEFT JOIN g USING (r)
"""


ORACLES = {"op4_secret_scan": _oracle()}
