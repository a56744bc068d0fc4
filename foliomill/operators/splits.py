"""Leakage-safe splits, stratified ranking, nested subsets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.functions.hashing import sha256
from foliomill.operators import graph
from foliomill.storage import stored
from foliomill.workers import ship

ORDER = ("train", "val", "test")
SHARES = {"train": 0.90, "val": 0.05}


def split_targets(total: int) -> dict[str, int]:
    """Whole numbers, halves to even; the rest is test."""
    out = {s: round(total * p) for s, p in SHARES.items()}
    return out | {"test": total - sum(out.values())}


def proportional_targets(sizes: dict[str, int], total: int) -> dict[str, int]:
    """total by size with largest remainders, ties in split order."""
    everything = sum(sizes.values())
    if not 0 <= total <= everything:
        raise ValueError("the target must be from 0 to the number of rows")
    quota = {s: total * sizes.get(s, 0) / everything if everything else 0.0 for s in ORDER}
    out = {s: int(q) for s, q in quota.items()}
    for s in sorted(ORDER, key=lambda s: (out[s] - quota[s], ORDER.index(s)))[: total - sum(out.values())]:
        out[s] += 1
    return out


def subset_sizes(total: int) -> dict[str, int]:
    """tiny and medium: 10 % and 40 %, but 25 % and 50 % of exactly 100,000 rows."""
    tiny, medium = (0.25, 0.5) if total == 100_000 else (0.1, 0.4)
    return {"tiny": round(total * tiny), "medium": round(total * medium)}


class Places:
    """Which split each of many components of one size gets, if each goes to the least filled split that still has room (ties in split order).

    Split i takes its j-th component when it is filled to (filled + j * size) / target, so the
    order of all takes is that of these fractions, and the number of takes before
    any of them is known without making them. Whole numbers throughout.
    """

    def __init__(self, size: int, filled: tuple[int, ...], targets: tuple[int, ...]):
        self.size, self.filled, self.targets = size, filled, targets
        self.room = [max(0, (t - f) // size) for f, t in zip(filled, targets, strict=True)]

    def before(self, i: int, j: int) -> int:
        """Takes before split i takes its j-th (from 0)."""
        n = 0
        for k, (f, t) in enumerate(zip(self.filled, self.targets, strict=True)):
            over, step = (self.filled[i] + j * self.size) * t - f * self.targets[i], self.size * self.targets[i]
            first = over // step + 1 if k < i else -(-over // step)  # those with a smaller fraction, or an equal one of an earlier split
            n += j if k == i else min(self.room[k], max(0, first))
        return n

    def taken(self, i: int, place: int) -> int:
        """How many of the first ``place`` components split i gets."""
        low, high = 0, self.room[i]
        while low < high:
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.before(i, mid) < place else (low, mid)
        return low

    def split(self, place: int) -> int:
        """Split of the component at that place (from 0)."""
        return next(i for i in range(len(self.targets)) if self.taken(i, place + 1) > self.taken(i, place))


def assign(members: DataFrame, key: str, component: str = "component") -> DataFrame:
    """members: key, component. Adds split: components stay whole and the split sizes are exact.

    Components of several rows go, largest first, ties by hash, to the least filled
    split that still has room. The driver sees how many components each size has
    and sums up what they fill; which one goes where follows on the executors from
    its place among those of its size. Single rows are ranked by hash, and fill what
    is left. Raises if no exact assignment exists.
    """
    spark = members.sparkSession
    ship(spark)
    sized = stored(members.groupBy(component).agg(F.count(F.lit(1)).alias("size"), F.sha2(F.min(F.col(key).cast("string")), 256).alias("hash")), "components")
    classes = sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("size")).collect()  # distinct sizes: fewer than the square root of twice the rows
    targets = tuple(split_targets(sum(r["size"] * r["n"] for r in classes)).values())
    filled, starts, upto = (0,) * len(ORDER), [], 0
    for r in classes:
        if r["size"] == 1:
            continue
        places = Places(r["size"], filled, targets)
        if sum(places.room) < r["n"]:
            raise ValueError(f"no split has room for a component of {r['size']} rows")
        starts.append((r["size"], upto, list(filled)))
        filled, upto = tuple(f + r["size"] * places.taken(i, r["n"]) for i, f in enumerate(filled)), upto + r["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Places] = {}
        for b in batches:
            splits = []
            for size, place, start in zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                if size not in known:
                    known[size] = Places(size, tuple(start), targets)
                splits.append(ORDER[known[size].split(place)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(splits, pa.string())], [component, "split"])

    kind = members.schema[component].dataType.simpleString()
    several = ranked_by(sized.where("size > 1"), F.desc("size"), F.col("hash"), F.col(component))
    several = several.join(spark.createDataFrame(starts, "size long, _first long, _filled array<long>"), "size").select(component, "size", (F.col("rank") - F.col("_first")).alias("place"), "_filled")
    grouped = members.join(several.mapInArrow(run, f"{component} {kind}, split string"), component)
    single = members.join(sized.where("size = 1"), component).drop("size")
    ranked = ranked_by(single, F.col("hash"), F.col(key)).drop("hash")
    left = dict(zip(ORDER, (t - f for t, f in zip(targets, filled, strict=True)), strict=True))
    a, b = left["train"], left["train"] + left["val"]
    split = F.when(F.col("rank") < a, "train").when(F.col("rank") < b, "val").otherwise("test")
    return grouped.unionByName(ranked.withColumn("split", split).drop("rank"))


def ranked_by(df: DataFrame, *order: Column) -> DataFrame:
    """df with rank (from 0) in that order: ranges are sorted in parallel and start where the ranges before end."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = stored(sorted_.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "ranked")
    starts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return parts.join(F.broadcast(starts), "_part").withColumn("rank", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")  # one row for each partition


def _from_first(ranked: DataFrame, by: list[str], name: str) -> DataFrame:
    """ranked: rank over all rows, in which those with equal columns ``by`` follow each other. Their place from the first of them, as column name; nulls are equal."""
    if not by:
        return ranked.withColumnRenamed("rank", name)
    ranked = ranked.withColumnRenamed("rank", "_at")
    firsts = ranked.groupBy(*(F.col(c).alias(f"_of_{c}") for c in by)).agg(F.min("_at").alias("_first"))
    on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]
    return ranked.join(firsts, on).withColumn(name, F.col("_at") - F.col("_first")).drop("_at", "_first", *(f"_of_{c}" for c in by))


def stratified_rank(df: DataFrame, key: str, strata: list[str], within: tuple[str, ...] = ()) -> DataFrame:
    """Round-robin over sorted strata, by SHA-256 of the key within each: rank from 0 (by columns ``within``).

    A row's turn is its place in its stratum; all rows of one turn come before the
    next, in the strata's order. Both come from ranges that are sorted in parallel,
    so a stratum or split may hold any share of the rows.
    """
    by_hash = ranked_by(df.withColumn("_hash", sha256(F.col(key))), *map(F.col, (*within, *strata, "_hash", key)))
    turns = _from_first(by_hash.drop("_hash"), [*within, *strata], "_turn")
    return _from_first(ranked_by(turns, *map(F.col, (*within, "_turn", *strata))), list(within), "rank").drop("_turn")


def nested_subsets(ranked: DataFrame, targets: dict[str, dict[str, int]], split: str = "split") -> DataFrame:
    """ranked: split, rank. Adds in_tiny, in_medium, in_large and the list of subsets; a smaller subset is part of a larger one."""
    def limit(name: str) -> Column:
        out = F.lit(0)
        for s in ORDER:
            out = F.when(F.col(split) == s, targets[name][s]).otherwise(out)
        return F.col("rank") < out

    x = ranked.withColumn("in_tiny", limit("tiny")).withColumn("in_medium", limit("medium")).withColumn("in_large", F.lit(True))
    names = F.filter(F.array(F.when(F.col("in_tiny"), "tiny"), F.when(F.col("in_medium"), "medium"), F.lit("large")), lambda s: s.isNotNull())
    return x.withColumn("subsets", names)


def hash_split(df: DataFrame, key: str, share: float = 0.85) -> DataFrame:
    """Rows in the order of SHA-256 of the key; the first round(n * share) are train, the others test."""
    n = df.count()
    return ranked_by(df.withColumn("_hash", sha256(F.col(key))), F.col("_hash"), F.col(key)).withColumn("split", F.when(F.col("rank") < round(n * share), "train").otherwise("test")).drop("_hash", "rank")


def distribution(df: DataFrame, split: str, features: list[str]) -> DataFrame:
    """Share of each feature value in each split, 4 places, 0 where it doesn't occur."""
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.coalesce(F.col(f).cast("string"), F.lit("unknown")).alias("value")) for f in features))
    counted = df.select(split, F.inline(pairs)).groupBy("feature", "value").pivot(split, list(ORDER)).count()
    totals = df.groupBy().agg(*(F.count(F.when(F.col(split) == s, 1)).alias(f"n_{s}") for s in ORDER))
    x = counted.join(F.broadcast(totals), how="cross")  # one row
    return x.select("feature", "value", *(F.round(F.coalesce(F.try_divide(F.coalesce(F.col(s), F.lit(0)), F.col(f"n_{s}")), F.lit(0.0)), 4).alias(s) for s in ORDER))


def shared_keys(links: DataFrame, splits: DataFrame, key: str) -> DataFrame:
    """links: key, link. By link kind: over all pairs of splits, the number of links that both have."""
    x = links.join(splits, key).select("link", "split").distinct().groupBy("link").agg(F.count(F.lit(1)).alias("k"))
    return x.groupBy(F.substring_index("link", ":", 1).alias("kind")).agg(F.sum((F.col("k") * (F.col("k") - 1) / 2).cast("long")).alias("overlap"))


def spanning(members: DataFrame, component: str, split: str) -> DataFrame:
    """Components that are in more than one split."""
    return members.groupBy(component).agg(F.countDistinct(split).alias("splits")).where("splits > 1")


def split_pages(pages: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """pages' keys with component and split; links: id, link (lineage, corpus record, grammar, duplicate cluster)."""
    return assign(graph.labelled(pages.select(key), graph.linked(links), key), key)


def enforce_no_leakage(members: DataFrame, component: str = "component", split: str = "split") -> None:
    bad = spanning(members, component, split).limit(1).collect()
    if bad:
        raise ValueError(f"component {bad[0][0]} is in more than one split")
