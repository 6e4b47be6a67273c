"""Connected components of an edge table, as tables all the way."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkstrata.llm._shared import tidy, written


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def union(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def contracted(edges: DataFrame, limit: int = 200_000) -> DataFrame:
    """Edges with the same components: within a task, runs of at most limit edges become stars on their smallest node."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        forest, n = Forest(), 0

        def flush():
            rows = [(forest.find(x), x) for x in list(forest.parent)]
            rows = [r for r in rows if r[0] != r[1]]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], schema=schema)

        for b in batches:
            for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                forest.union(x, y)
            n += b.num_rows
            if n >= limit:
                yield flush()
                forest, n = Forest(), 0
        yield flush()

    return edges.select("a", "b").mapInArrow(tidy(run), "a long, b long")


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, label (its component's smallest node) for every node that has an edge (a, b; longs).

    Loops, edges with a null end and repeated edges change nothing; without edges there are no rows.

    Each round every node follows its smallest neighbour, paths are halved twice, and the edges are drawn between
    what the nodes have become; hot nodes are summed by partial aggregates. The number of rounds is logarithmic.
    """
    left = written(contracted(_distinct(edges)), "edges")
    found = None
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("up"))
        for _ in range(2):
            parent = written(parent, "parents")
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parent = parent.join(above, "up").select("node", F.col("top").alias("up"))
        parent = written(parent, "parents")
        if found is None:
            found = parent.select("node", F.col("up").alias("label"))
        else:
            found = written(found.join(parent.select(F.col("node").alias("label"), "up"), "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels")
        for c in ("a", "b"):
            left = left.join(parent.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")), c)
        left = written(contracted(_distinct(left.select(F.col("a_up").alias("a"), F.col("b_up").alias("b")))), "edges")
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return found


