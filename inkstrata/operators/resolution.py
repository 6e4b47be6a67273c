"""Author identities: profiles, candidate pairs for review, and applying what the review decided.

A pair that scores at all shares an account, or a domain with equal or close names: candidates come from equi-joins
on those, never from all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkstrata.functions.ids import uuid5
from inkstrata.functions.text import confidence_bucket, name_distance, normalize_name
from inkstrata.functions.urls import profile_host, url_host
from inkstrata.operators.store import insert_new, latest_wins

#: What each rule adds, the largest distance of close names, the scores that count.
WEIGHTS = {"account": 1.0, "profile": 0.9, "exact_name": 0.8, "similar_name": 0.6, "domain": 0.3}
CLOSE, LEAST, MIN_SCORE = 0.15, 0.5, 0.6


def author_profiles(articles: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """One profile for each source, normalised name and domain, with hints that are accounts or profile pages."""
    named = articles.filter(F.col("author_hint").isNotNull() & (F.trim("author_hint") != "")).withColumn("name", normalize_name(F.col("author_hint"))).filter("name <> ''").withColumn("domain", url_host(F.col("canonical_url")))
    url = F.col("name").rlike("^https?://")
    grouped = named.groupBy("source_id", "name", "domain").agg(
        F.count("*").alias("n_articles"), F.min_by("author_hint", "canonical_url").alias("canonical_name"),
        F.sort_array(F.collect_set(F.when(url | F.col("name").contains("@"), F.col("name")))).alias("accounts"),
        F.sort_array(F.collect_set(F.when(url & F.regexp_extract("name", "^https?://[^/]*([^?#]*)", 1).rlike("/author/|/people/|/profile/|/bio"), F.trim("author_hint")))).alias("profile_urls"),
    )
    out = grouped.withColumn("id", uuid5(F.concat_ws("|", F.lit("author"), "source_id", "name", "domain"))).withColumn("domains", F.when(F.col("domain") != "", F.array("domain")).otherwise(F.array().cast("array<string>")))
    if accounts is not None:
        held = accounts.groupBy(F.col("author_id").alias("id")).agg(F.collect_set(F.lower(F.trim("source_identifier"))).alias("known"))
        out = out.join(held, "id", "left").withColumn("accounts", F.sort_array(F.array_union("accounts", F.coalesce("known", F.array().cast("array<string>"))))).drop("known")
    return out.select("id", "source_id", "canonical_name", "name", "domain", "n_articles", "domains", "accounts", "profile_urls")


def _both(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_intersect(a, b))


def candidate_pairs(profiles: DataFrame) -> DataFrame:
    """Id pairs (l, r), l before r, that share an account, or a domain with names that may be close."""
    side = lambda p: profiles.select(F.col("id").alias(p), F.col("name").alias(f"{p}_name"), F.col("domains").alias(f"{p}_domains"), F.col("accounts").alias(f"{p}_accounts"), F.transform("profile_urls", profile_host).alias(f"{p}_hosts"))
    l, r = side("l"), side("r")
    domain = l.withColumn("k", F.explode("l_domains")).join(r.withColumn("k", F.explode("r_domains")), "k").filter("l < r")
    longest = F.greatest(F.length("l_name"), F.length("r_name"))
    bound = F.floor(longest * F.lit(CLOSE)).cast("int")
    # the difference of lengths bounds the distance from below: most pairs end there
    close = (F.abs(F.length("l_name") - F.length("r_name")) <= bound) & (name_distance(F.col("l_name"), F.col("r_name")) <= F.lit(CLOSE))
    hosts = F.array_contains(F.array_intersect("l_hosts", "r_hosts"), F.col("k"))
    near = domain.filter((F.col("l_name") == F.col("r_name")) | close | hosts)
    account = l.withColumn("k", F.explode("l_accounts")).join(r.withColumn("k", F.explode("r_accounts")), "k").filter("l < r")
    return near.select("l", "r").union(account.select("l", "r")).distinct()


def score_pairs(pairs: DataFrame, profiles: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Candidates (id, both profiles, score, confidence, breakdown, evidence, decision null) that reach min_score."""
    keep = ("id", "canonical_name", "source_id", "name", "domains", "accounts", "profile_urls")
    side = lambda p: profiles.select(F.col("id").alias(p), F.struct(*keep).alias(f"{p}_author"))
    rows = pairs.join(side("l"), "l").join(side("r"), "r")
    a, b = F.col("l_author"), F.col("r_author")
    hosts = lambda x: F.array_distinct(F.transform(x["profile_urls"], profile_host))
    rows = rows.withColumn("acc", _both(a["accounts"], b["accounts"])).withColumn("dom", _both(a["domains"], b["domains"])).withColumn("d", name_distance(a["name"], b["name"]))
    rows = rows.withColumn("host", F.array_intersect("dom", F.array_intersect(hosts(a), hosts(b))))
    shared, named = F.size("dom") > 0, (a["name"] != "") & (b["name"] != "")
    exact = shared & named & (a["name"] == b["name"])
    close = shared & named & (a["name"] != b["name"]) & (F.col("d") <= F.lit(CLOSE))
    text = lambda c: F.array_join(c, ", ")
    rules = [
        ("account", F.size("acc") > 0, F.concat(F.lit("shared account: "), text("acc"))),
        ("profile", F.size("host") > 0, F.concat(F.lit("profile pages on one domain: "), text("host"))),
        ("exact_name", exact, F.concat(F.lit("same name on one domain: "), text("dom"))),
        ("similar_name", close, F.concat(F.lit("close names ("), F.format_string("%.3f", F.bround("d", 3)), F.lit(") on one domain: "), text("dom"))),
        ("domain", shared & ~exact & ~close, F.concat(F.lit("one domain: "), text("dom"))),
    ]
    total = sum((F.when(on, WEIGHTS[n]).otherwise(0.0) for n, on, _ in rules), F.lit(0.0))
    breakdown = F.map_from_entries(F.array_compact(F.array(*(F.when(on, F.struct(F.lit(n), F.lit(WEIGHTS[n]))) for n, on, _ in rules))))
    scored = rows.withColumn("score", F.round(F.least(total, F.lit(1.0)), 4)).filter((F.col("score") >= LEAST) & (F.col("score") >= min_score))
    return scored.select(
        uuid5(F.concat_ws("|", F.lit("candidate"), "l", "r")).alias("id"), a.alias("from_author"), b.alias("to_author"), "score", confidence_bucket(F.col("score")).alias("confidence"),
        breakdown.alias("scoring_breakdown"), F.array_compact(F.array(*(F.when(on, t) for _, on, t in rules))).alias("evidence"), F.lit(None).cast("string").alias("decision"),
    )


def candidates(profiles: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    return score_pairs(candidate_pairs(profiles), profiles, min_score).orderBy(F.desc("score"), "id")


def review_document(found: DataFrame, now: str, min_score: float = MIN_SCORE) -> DataFrame:
    """The review file: one JSON text."""

    def better(a: Column, b: Column) -> Column:
        key = lambda c: F.struct(-c["score"], c["id"])
        return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)

    return found.agg(F.array_sort(F.collect_list(F.struct(*found.columns)), better).alias("s")).select(
        F.to_json(F.struct(F.lit(now).alias("generated_at"), F.lit(min_score).alias("min_score"), F.col("s").alias("candidates")), {"ignoreNullFields": "false"}).alias("value")
    )


def routed(review: DataFrame) -> DataFrame:
    """review with outcome: accept, reject, hold or invalid."""
    word = F.lower(F.trim(F.coalesce("decision", F.lit(""))))
    ends = [F.coalesce(F.col(f"{c}.id"), F.lit("")) for c in ("from_author", "to_author")]
    lacks = (ends[0] == "") | (ends[1] == "")
    review = review.withColumn("id", F.coalesce(F.when(F.col("id") != "", F.col("id")), F.concat_ws(":", *ends)))
    return review.withColumn("outcome", F.when(word == "reject", "reject").when(word.isin("", "hold"), "hold").when((word == "accept") & ~lacks, "accept").otherwise("invalid"))


def apply_review(review: DataFrame, authors: DataFrame, decisions: DataFrame, run_id: str, now: str, by: str = "review") -> tuple[DataFrame, DataFrame, DataFrame]:
    """New authors, new decisions and tallies by outcome; a decision that is known already counts as a duplicate.

    An accepted merge is recorded, nothing is rewritten.
    """
    rows = routed(review)
    taken = rows.filter("outcome = 'accept'")
    people = taken.select(F.explode(F.array("from_author", "to_author")).alias("a")).select(F.col("a.id").alias("id"), F.coalesce(F.when(F.trim("a.canonical_name") != "", F.trim("a.canonical_name")), F.col("a.id")).alias("canonical_name"), F.lit("{}").alias("metadata"), F.lit(now).alias("created_at"), F.lit(now).alias("updated_at")).dropDuplicates(["id"])
    null = F.lit(None).cast("string")
    said = [c for c in ("confidence", "score", "scoring_breakdown") if c in review.columns]
    proof = F.filter("evidence", lambda e: F.coalesce(e, F.lit("")) != "") if "evidence" in review.columns else F.array().cast("array<string>")
    made = taken.select(
        "id", F.col("from_author.id").alias("from_author_id"), F.col("to_author.id").alias("to_author_id"), F.coalesce(proof, F.array().cast("array<string>")).alias("evidence_ids"), F.to_json(F.struct(*said), {"ignoreNullFields": "false"}).alias("decision_criteria"),
        F.lit(now).alias("created_at"), F.lit(by).alias("created_by"), F.lit(run_id).alias("run_id"), null.alias("reverted_at"), null.alias("reverted_by"), null.alias("reverted_reason"),
    )
    fresh = insert_new(decisions, made, "id", "from_author_id")
    tally = rows.join(fresh.select("id", F.lit(True).alias("new")), "id", "left").select(F.when((F.col("outcome") == "accept") & F.col("new").isNull(), "duplicate").otherwise(F.col("outcome")).alias("outcome")).groupBy("outcome").count()
    return latest_wins(authors, people, "id", "updated_at"), decisions.unionByName(fresh), tally
