"""Connected components of a graph given as a table of edges, by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelift.session import materialize


TASK_EDGES = 250_000       # edges that one task contracts at most (on average)


def _contracted(edges: DataFrame, tasks: int) -> DataFrame:
    """The same components with fewer edges: every task replaces its share of the edges, dealt
    out evenly, by stars around the smallest vertex of each of its own components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(v: int) -> int:
            top = v
            while (up := above.get(top, top)) != top:
                top = up
            while v != top:
                above[v], v = top, above[v]
            return top

        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
                a, b = sorted((root(a), root(b)))
                if a != b:
                    above[b] = a
        pairs = [(v, root(v)) for v in list(above)]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in (list(zip(*pairs)) or [[], []])], names=["a", "b"])

    return edges.repartition(tasks).mapInArrow(run, "a long, b long")


def _all_stars(edges: DataFrame) -> bool:
    """Whether every vertex either points to one other vertex or is pointed to."""
    ends = (edges.select(F.col("a").alias("v"), F.col("b").alias("to"))
            .union(edges.select("b", F.lit(None).cast("long"))))
    return (ends.groupBy("v").agg(F.min("to").alias("lo"), F.max("to").alias("hi"),
                                  F.max(F.col("to").isNull()).alias("center"))
            .where("lo <> hi or (center and lo is not null)").isEmpty())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long; a stored table) to (v, label): each vertex that has an edge
    to another one, and the smallest vertex of its component.

    First every task contracts a bounded number of edges to stars.  Where that took several
    tasks, rounds follow: each links the larger neighbours of every vertex to the smallest
    one (large star), then the smaller neighbours likewise (small star); their number grows
    with the logarithm of the longest path.  Minima are aggregated before the shuffle and
    stored, so the join of a vertex that holds a large share of all edges can be split.
    Loops, repeated and null edges are left out."""
    real = edges.where("a <> b")
    tasks = -(-real.count() // TASK_EDGES) or 1
    e = materialize(_contracted(real, tasks), "edges")
    while tasks > 1 and not _all_stars(e):
        both = e.union(e.select("b", "a"))
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select("a", F.least("a", "m").alias("m")), "star-minima")
        large = materialize(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                            .distinct(), "large-star")
        low = materialize(large.groupBy("a").agg(F.min("b").alias("m")), "star-minima")
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialize(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    return (e.select(F.col("a").alias("v"), F.col("b").alias("label"))
            .union(e.select("b", "b").distinct()))
