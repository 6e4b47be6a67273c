"""Written intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Scratch:
    """The tables written within a scope: all but those kept are deleted at its end; kept ones go to the scope around it."""

    def __init__(self):
        self.tables, self.kept = [], []

    def keep(self, *tables: DataFrame) -> None:
        self.kept.extend(t._inkstrata_path for t in tables)


_scopes: list[Scratch] = []


@contextmanager
def scratch():
    scope = Scratch()
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _scopes.remove(scope)
        drop(*(t for t in scope.tables if t._inkstrata_path not in scope.kept))
        if _scopes:
            _scopes[-1].tables.extend(t for t in scope.tables if t._inkstrata_path in scope.kept)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where it is unset in local mode (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set: executors need a folder that they share")
    if not found:
        held = getattr(spark.sparkContext, "_inkstrata_shared", None)
        found = spark.sparkContext._inkstrata_shared = held or tempfile.mkdtemp(prefix="inkstrata-shared-")
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/inkstrata-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors, computed once."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    # the shuffle files of a table that is written are of no more use: Spark removes them with the write
    held = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, held)
    out = spark.read.schema(df.schema).parquet(path)
    out._inkstrata_path = path
    if _scopes:
        _scopes[-1].tables.append(out)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete written() tables that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_inkstrata_path", None)
        if path:
            p = t.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def tidy(run: Callable) -> Callable:
    """run for mapInArrow, giving what it has freed back to the system at its end: Python workers idle beside the next stage."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return tidied


def constant_table(values: list[int]) -> Column:
    """A constant array, folded once; F.get() on it is one step."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def among(df: DataFrame, members: DataFrame, keys: list[str], bits: int = 20) -> DataFrame:
    """df without most of the rows whose keys members lacks, and with all those that it has: a table of 2**bits bits,
    whatever the corpus. It saves a shuffle of what a following join would drop."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(1 << bits)).cast("int")
    rows = members.select(slot.alias("s")).groupBy(F.shiftright("s", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, s & 63)")).alias("bits")).collect()
    words = [0] * (1 << (bits - 6))
    for r in rows:
        words[r["word"]] = r["bits"]
    held = F.get(constant_table(words), F.shiftright(slot, 6))
    return df.filter(F.call_function("getbit", held, slot.bitwiseAND(F.lit(63))) == 1)


#: Frequent values: at most TOP, known by 2**SLOT_BITS slots of their leading bits, 16 a word; those that are not
#: counted one by one are seen by a sketch of SKETCH counters. All fixed sizes.
TOP, SLOT_BITS, SKETCH = 512, 19, 1 << 16
CLASSES = 7
#: Sketches of tasks are merged in so many groups, then those into one.
GROUPS = 64


def slots(found: list, bits: int, least: int) -> list[int] | None:
    """A class of frequency for every slot of hashes of so many bits: 0 but for those of the (hash, count) rows found; None
    without any."""
    words = [0] * (1 << (SLOT_BITS - 4))
    for value, count in found:
        slot = (value & ((1 << bits) - 1)) >> (bits - SLOT_BITS)
        shift = 4 * (slot & 15)
        held = words[slot >> 4] >> shift & 15
        words[slot >> 4] += (max(held, min(CLASSES, (count // least).bit_length())) - held) << shift
    return words if found else None


def frequent_slots(values: DataFrame, bits: int, least: int) -> list[int] | None:
    """slots() of the most frequent values (one column of hashes), of those that occur least times or more, by a
    frequent-items sketch over all."""
    (name,) = values.columns
    by_task = values.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g")).agg(F.expr(f"approx_top_k_accumulate(`{name}`, {SKETCH})").alias("s"))
    merged = by_task.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(s, {SKETCH})").alias("s"))
    rows = merged.select(F.expr(f"inline(approx_top_k_estimate(s, {TOP}))")).collect()
    return slots([(r["item"], r["count"]) for r in rows if r["item"] is not None and r["count"] >= least], bits, least)


def slot_class(value: Column, bits: int, words: Column) -> Column:
    """The class of a hash in the words of frequent_slots(), given as a constant_table()."""
    slot = F.shiftrightunsigned(value, bits - SLOT_BITS).cast("int")
    return F.call_function("shiftright", F.get(words, F.shiftright(slot, 4)), slot.bitwiseAND(F.lit(15)) * 4).bitwiseAND(F.lit(15))
