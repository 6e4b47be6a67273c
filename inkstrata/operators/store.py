"""The article store as pure functions: old tables and a change give new tables.

Parquet has no in-place change, so nothing is updated: upsert and rollback return the frames that a snapshot
writer puts into a new directory. Ids follow from natural keys, so that a task that runs twice writes the same.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkstrata.functions.ids import content_hash, uuid5

KEY = ["canonical_url", "source_id"]
CONTENT = ["title", "author_hint", "published_at", "snippet"]
TABLES = ("articles", "evidence", "versions", "fetch_log", "merge_decisions", "run_log", "authors", "accounts")


@dataclass(frozen=True)
class Store:
    """The tables of a store; counts: what the last change did."""

    articles: DataFrame
    evidence: DataFrame
    versions: DataFrame
    fetch_log: DataFrame | None = None
    merge_decisions: DataFrame | None = None
    run_log: DataFrame | None = None
    authors: DataFrame | None = None
    accounts: DataFrame | None = None
    counts: dict = field(default_factory=dict)


def draft_hash() -> Column:
    return content_hash(*(F.col(c) for c in CONTENT))


def latest(versions: DataFrame, *columns: str) -> DataFrame:
    """Each article's newest version: a per-key aggregate, no sort."""
    return versions.groupBy("article_id").agg(F.max_by(F.struct("version", *columns), "version").alias("v")).select("article_id", "v.*")


def change_flags(rows: DataFrame, key: list[str], content: str, order: list[str], base: str | None = None) -> DataFrame:
    """changed: whether content differs from the row before of the key (or from base, before the first); version:
    how many changes there were up to the row."""
    w = Window.partitionBy(*key).orderBy(*order)
    before = F.lag(content).over(w)
    if base:
        before = F.when(F.row_number().over(w) == 1, F.col(base)).otherwise(before)
    flagged = rows.withColumn("changed", ~F.col(content).eqNullSafe(before))
    return flagged.withColumn("version", F.sum(F.col("changed").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def upsert(store: Store, drafts: DataFrame, run_id: str, now: str) -> Store:
    """drafts (seq, canonical_url, source_id, the content, evidence array<struct>) into the store.

    Unknown keys become articles of version 1; a draft of new content makes the next version and replaces the
    evidence; one of the same content changes nothing, and its evidence is dropped. Drafts of one key apply in order.
    counts has new and updated, as single-row frames would count them.
    """
    known = latest(store.versions, "content_hash").withColumnRenamed("version", "base_version").withColumnRenamed("content_hash", "base_hash")
    ids = drafts.withColumn("article_id", uuid5(F.concat_ws("|", *KEY))).withColumn("content_hash", draft_hash())
    joined = ids.join(known, "article_id", "left")
    steps = change_flags(joined, ["article_id"], "content_hash", ["seq"], "base_hash").withColumn("version", (F.coalesce("base_version", F.lit(0)) + F.col("version")).cast("int"))
    changes = steps.filter("changed")
    evidence = F.transform("evidence", lambda e: e.withField("article_id", F.col("article_id")).withField("run_id", F.lit(run_id)))
    made = changes.withColumn("evidence", evidence)
    versions = made.select(
        uuid5(F.concat_ws("|", F.lit("version"), "article_id", "version")).alias("id"), "article_id", "version", "content_hash",
        *(F.col(c).alias(f"{c}_snapshot") for c in CONTENT), F.col("evidence").alias("evidence_snapshot"), F.lit(now).alias("created_at"), F.lit(run_id).alias("run_id"),
    )
    last = made.groupBy("article_id").agg(F.max_by(F.struct(*KEY, *CONTENT, "version", "evidence"), "seq").alias("d")).select("article_id", "d.*")
    old = store.articles
    created = old.select(F.col("id").alias("article_id"), F.col("created_at").alias("first_at"))
    fresh = last.join(created, "article_id", "left").select(F.col("article_id").alias("id"), *KEY, *CONTENT, "version", F.coalesce("first_at", F.lit(now)).alias("created_at"), F.lit(now).alias("updated_at"))
    articles = old.join(fresh.select("id"), "id", "left_anti").select(old.columns).unionByName(fresh)
    current = last.select(F.explode("evidence").alias("e")).select("e.*")
    kept = store.evidence.join(last.select("article_id"), "article_id", "left_anti").select(store.evidence.columns)
    counts = steps.agg(F.count_if(F.col("changed") & (F.col("version") == 1)).alias("new"), F.count_if(F.col("changed") & (F.col("version") > 1)).alias("updated"))
    return replace(store, articles=articles, evidence=kept.unionByName(current), versions=store.versions.unionByName(versions), counts={"changes": counts})


def rollback(store: Store, run_id: str, now: str | None = None) -> Store:
    """The store without what a run did: its fetch log, evidence, versions and decisions go; articles that it changed
    return to their newest version left, with its evidence, or go too; the run itself is marked as cancelled, ended now
    where it had no end. counts: one-row frames by name."""
    mine = F.col("run_id") == run_id
    touched = store.versions.filter(mine).select("article_id").distinct()
    left = store.versions.filter(~mine)
    back = latest(left.join(touched, "article_id", "left_semi"), *(f"{c}_snapshot" for c in CONTENT), "evidence_snapshot", "created_at")
    restored = store.articles.join(back.withColumnRenamed("article_id", "id").drop("created_at").withColumnRenamed("version", "to_version"), "id").select(
        "id", *KEY, *(F.col(f"{c}_snapshot").alias(c) for c in CONTENT), F.col("to_version").alias("version"), "created_at", "updated_at"
    )
    ids = touched.withColumnRenamed("article_id", "id")
    articles = store.articles.join(ids, "id", "left_anti").select(store.articles.columns).unionByName(restored)
    again = back.select(F.explode("evidence_snapshot").alias("e")).select("e.*")
    evidence = store.evidence.filter(~mine).join(touched, "article_id", "left_anti").select(store.evidence.columns).unionByName(again)
    rest = {name: t.filter(~mine) for name in ("fetch_log", "merge_decisions") if (t := getattr(store, name)) is not None}
    count = lambda df: df.agg(F.count("*").alias("n"))
    counts = {
        "versions_removed": count(store.versions.filter(mine)), "evidence_removed": count(store.evidence.filter(mine)), "articles_reverted": count(restored),
        "articles_deleted": count(touched.join(back, "article_id", "left_anti")), **{f"{n}_removed": count(getattr(store, n).filter(mine)) for n in rest},
    }
    if store.run_log is not None:
        rest["run_log"] = cancelled(store.run_log, run_id, now)
    return replace(store, articles=articles, evidence=evidence, versions=left, counts=counts, **rest)


def logged(store: Store, **logs: DataFrame) -> Store:
    """The store with rows added to its logs; a row whose id is there already is not added: a run may be replayed."""
    from inkstrata.schemas import with_columns_of

    grown = {}
    for name, rows in logs.items():
        fresh, old = with_columns_of(rows, name), getattr(store, name)
        grown[name] = fresh if old is None else old.unionByName(fresh.join(old.select("id"), "id", "left_anti").select(old.columns))
    return replace(store, **grown)


def foreign_key_errors(store: Store) -> dict[str, DataFrame]:
    """Rows whose reference names nothing: evidence and versions of no article, decisions on no author."""
    from inkstrata.operators.export import foreign_key_gaps

    out = {name: foreign_key_gaps(getattr(store, name), "article_id", store.articles) for name in ("evidence", "versions")}
    if store.merge_decisions is not None and store.authors is not None:
        out |= {f"merge_decisions.{c}": foreign_key_gaps(store.merge_decisions, c, store.authors) for c in ("from_author_id", "to_author_id")}
    return out


def cancelled(run_log: DataFrame, run_id: str, now: str | None) -> DataFrame:
    mine = F.col("id") == run_id
    return run_log.withColumn("status", F.when(mine, "CANCELLED").otherwise(F.col("status"))).withColumn("ended_at", F.when(mine, F.coalesce("ended_at", F.lit(now).cast("string"))).otherwise(F.col("ended_at")))


def insert_new(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of new whose key old lacks, the first of each by order: insert-or-ignore."""
    w = Window.partitionBy(key).orderBy(order)
    return new.join(old.select(key), key, "left_anti").withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n").select(new.columns)


def latest_wins(old: DataFrame, new: DataFrame, key: str, order: str, keep: str = "created_at") -> DataFrame:
    """old and new by key: the newest row, with the earliest keep."""
    both = old.unionByName(new)
    return both.groupBy(key).agg(F.max_by(F.struct(*(c for c in both.columns if c not in (key, keep))), order).alias("r"), F.min(keep).alias(keep)).select(key, "r.*", keep).select(both.columns)


def commit(store: Store, folder: str, version: int | None = None, checked: bool = False) -> str:
    """Write the tables to a directory of their own; only then does the pointer name it: readers see all or nothing.

    version: by default the one after the newest. A version that is written again, by a step that is replayed, goes to
    a fresh directory, and the pointer's later line counts. checked: rows whose reference names nothing fail the commit.
    """
    spark = store.articles.sparkSession
    if checked:
        broken = [name for name, gaps in foreign_key_errors(store).items() if not gaps.isEmpty()]
        if broken:
            raise ValueError(f"references to nothing in: {', '.join(broken)}")
    lines = _pointers(spark, folder)
    if version is None:
        version = 1 + max((r["version"] for r in lines), default=0)
    line = 1 + max((r["line"] for r in lines), default=0)
    path = f"{folder}/v{version:08d}-{uuid.uuid4().hex[:8]}"
    for name in TABLES:
        if (t := getattr(store, name)) is not None:
            t.write.parquet(f"{path}/{name}")
    spark.createDataFrame([(version, line, path)], POINTER).coalesce(1).write.mode("append").parquet(f"{folder}/_pointer")
    return path


POINTER = "version long, line long, path string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _pointers(spark: SparkSession, folder: str) -> list:
    """A line for each commit of the folder: as many as there are versions."""
    return spark.read.schema(POINTER).parquet(f"{folder}/_pointer").collect() if _exists(spark, f"{folder}/_pointer") else []


def load(spark: SparkSession, folder: str, before: int | None = None) -> Store:
    """The newest version; before: the newest one below that, for a step that is replayed. A folder without any version
    is an empty store."""
    from inkstrata.schemas import empty

    lines = [r for r in _pointers(spark, folder) if before is None or r["version"] < before]
    if not lines:
        return Store(**{name: empty(spark, name) for name in TABLES})
    path = max(lines, key=lambda r: (r["version"], r["line"]))["path"]
    return Store(**{name: spark.read.parquet(f"{path}/{name}") for name in TABLES if _exists(spark, f"{path}/{name}")})
