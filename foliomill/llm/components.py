"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import dropped, split_join, stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.inline(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = _both(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return split_join(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    own = least.select("a", F.col("m").alias("b"))
    rest = split_join(down, least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return own.unionByName(rest).distinct()


def _state(edges: DataFrame) -> tuple[int, int]:
    n, total = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
    return n, int(total)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: a, b (ids, any direction; loops and repeats do no harm). Rows (a, b): each node that isn't the smallest of its component, and the smallest.

    Each round is written to the shared folder; the rounds end when a round changes nothing.
    """
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _state(now)
    if not before[0]:
        return now
    for _ in range(most_rounds):
        then, now = now, stored(small_star(large_star(now)), "edges")
        dropped(then)
        after = _state(now)
        if after == before:
            return now
        before = after
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
