"""Connected components of a graph of long numbers, by labels passed along links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import in_arrow, sent_whole
from tidemark.workspace import pin

#: Nodes that a task holds before it hands on what connects them.
HELD = 200_000


def stars(links: DataFrame) -> DataFrame:
    """Links from each node ``a`` to a node ``b``, itself or a smaller one, that connect what ``links`` connect.

    A task links each node to the smallest that the links it reads lead to, block by block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: dict[int, int] = {}

        def root(x: int) -> int:
            while (above := head.setdefault(x, x)) != x:
                head[x] = x = head[above]
            return x

        def found() -> pa.RecordBatch:
            a, b = list(head), [root(x) for x in head]
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = root(x), root(y)
                head[max(x, y)] = min(x, y)
            if len(head) >= HELD:
                yield found()
                head.clear()
        yield found()

    return in_arrow(links.select(F.col("a").cast("long"), F.col("b").cast("long")), run, "a long, b long")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, from links (``a``, ``b``).

    Each round a node is merged into the smallest one next to it, and links inside
    what was merged go; rounds end when no link is left. Tasks first make stars of the
    links they read, so that a round is left with what connects the tasks' stars. The
    number of rounds grows at most with the logarithm of the nodes where ids are spread
    at random, as hashes are. Every round is written to the shared folder.
    """
    edges = pin(stars(links), label)
    rounds = []
    while True:
        # Few and small files are read by few tasks, which make larger stars.
        heads = pin(stars(edges).groupBy(F.col("a").alias("node")).agg(F.min("b").alias("head")), label)
        rounds.append(heads)
        to = sent_whole(heads)
        one = to.select(F.col("node").alias("a"), F.col("head").alias("x"))
        other = to.select(F.col("node").alias("b"), F.col("head").alias("y"))
        between = edges.join(one, "a").join(other, "b").where("x != y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = pin(stars(between), label)
        if edges.isEmpty():
            break
    labels = after = rounds.pop().withColumnRenamed("head", "component")
    if not rounds:
        return labels
    while rounds:
        # From the last round, which has the fewest nodes, to the first.
        there = sent_whole(labels.withColumnRenamed("node", "head"), after)
        after = rounds.pop()
        labels = after.join(there, "head", "left").select("node", F.coalesce("component", "head").alias("component"))
    return pin(labels, label)
