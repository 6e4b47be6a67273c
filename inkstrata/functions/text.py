"""Text functions, native."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as str.split() has it.
SPACE = r"(?U)[\s\x1c-\x1f]+"
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
ELLIPSIS = "…"
#: White space as the SQL of the queries has it: what is a run within a text, and what goes at its ends (space separators).
PLAIN_SPACE = r"[\t\n\f\r ]+"
SEPARATORS = " \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def collapse(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def collapse_plain(text: Column) -> Column:
    """Runs of ASCII white space as one blank, no space separators at the ends: trim(regexp_replace(text, '\\s+', ' ', 'g'))
    of the queries' SQL."""
    return F.btrim(F.regexp_replace(text, PLAIN_SPACE, " "), F.lit(SEPARATORS))


def normalize_name(name: Column) -> Column:
    return collapse(F.lower(name))


def paragraphs(text: Column, line_break: str = LINE_BREAK, squeeze=collapse) -> Column:
    """Each line collapsed (by squeeze), blank lines dropped, lines apart by an empty one."""
    return F.array_join(F.filter(F.transform(F.split(text, line_break), squeeze), lambda x: x != ""), "\n\n")


def truncate(text: Column, limit: int) -> Column:
    """At most limit characters, cut at the last blank, and an ellipsis; without a blank limit characters and it."""
    head = F.substring(text, 1, limit)
    cut = F.regexp_extract(head, r"(?s)^(.*) [^ ]*$", 1)
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.rtrim(F.when(head.contains(" "), cut).otherwise(head)), F.lit(ELLIPSIS)))


def exceeds(text: Column, limit: int) -> Column:
    """Whether clamp changes a text, which a text of limit + 1 characters does not show in its length."""
    return F.length(text) > limit


def clamp(text: Column, limit: int) -> Column:
    return F.when(exceeds(text, limit), F.concat(F.substring(text, 1, limit), F.lit(ELLIPSIS))).otherwise(text)


def split_authors(names: Column) -> Column:
    """Names apart by comma, bar or the word and; distinct, in order."""
    parts = F.transform(F.split(names, r"(?U),|\||\band\b"), collapse)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def name_distance(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 if both are empty."""
    return F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def confidence_bucket(score: Column) -> Column:
    return F.when(score >= 0.75, "HIGH").when(score >= 0.5, "MEDIUM").otherwise("LOW")
