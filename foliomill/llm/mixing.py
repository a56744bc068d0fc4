"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's
target over its size.  Documents are ordered by size, longest first, within their source, so
that each size gets its share; expected copies are prefix-summed, one offset
that depends on seed and source is added, and a document is emitted once for
each whole number that its stretch of the sum crosses.  The taken words are off
the target by about the size of the longest document at most.

The prefix sum runs over counts of nested groups: classes of sizes in a source, sizes
in a class, coarse hash buckets of a size, buckets in a coarse one, rows in a bucket.
The number of buckets grows with the most rows that a size of the class has in one
source (about ``BUCKET_ROWS`` rows each, at most as many groups as their square root in one
window), so that no task holds a whole source or size, whatever its share of the rows.
Only the targets come from a window over one row per source.

Null source: one source, the last. Null or empty text: size 0, taken 0. Repeated
rows are documents of their own.  Null ids: ordered among their size like an id of
their own.  No rows: no result.  Other columns don't matter, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.llm.common import numbered, stored, word_count

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix"
#: Rows of one size and source that share a bucket, on average at most.
BUCKET_ROWS = 256


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """sizes: no_source, source, source_size (one row per source). Adds weight and target; what a source can't take is shared anew by weight.

    All sources are ordered by the level at which they fill up; the level is the
    first, in the window's order, that no source below it exceeds; of sources that tie only the first has all their room. One row per source, so one window is enough.
    """
    place = F.row_number().over(Window.orderBy("no_source", "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    x = sizes.withColumn("weight", weight.cast("long")).withColumn("room", F.col("source_size") * limit)
    x = x.withColumn("full_at", F.col("room").cast("double") / F.col("weight"))
    order = Window.orderBy("full_at", "no_source", "source")
    everything = Window.partitionBy()
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    x = x.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0))).cast("double") / F.sum("weight").over(rest))
    x = x.withColumn("level", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "no_source", "source", "level"))).over(everything)["level"])
    return x.select("no_source", "source", "source_size", "weight", F.least(F.col("room").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def size_class(size: Column) -> Column:
    """Grows with size: its number of binary digits, then the first four of them; all sizes below 16 have their own."""
    digits = F.length(F.bin(size))
    return digits * 16 + F.call_function("shiftright", size, F.greatest(digits - 4, F.lit(0))).cast("int")


def offset(source: Column, seed: str = SEED) -> Column:
    """In [0, 1), from seed and source."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\0")))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def bucket_digits(sizes: DataFrame) -> Column:
    """Hexadecimal digits of the hash that name a bucket, by column class. sizes: class, n (rows of one size in one source)."""
    most = sizes.groupBy("class").agg(F.max("n").alias("n")).collect()  # 16 classes for each binary digit of the sizes
    digits = {r["class"]: math.ceil(math.log(r["n"] / BUCKET_ROWS, 16)) for r in most if r["n"] > BUCKET_ROWS}
    if not digits:
        return F.lit(0)
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in sorted(digits.items()) for x in kv)), F.col("class")), F.lit(0))


def _before(n: str, within: list[str], *order: str | Column) -> Column:
    """Sum of n over the rows before this one."""
    return F.coalesce(F.sum(n).over(Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def sampled(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, row_col: str | None = None) -> DataFrame:
    """One row per row of df: id, source, size, source_size, target, copies, taken; and row_col, a number of the row, if it is given."""
    row = [F.col(row_col).cast("long").alias("row")] if row_col else []
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("\0"))))
    named = F.col(source_col).cast("string")
    rows = df.select(F.col(id_col).cast("long").alias("id"), named.isNull().alias("no_source"), F.coalesce(named, F.lit("")).alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key"), *row)
    rows = stored(rows.withColumn("class", size_class(F.col("size"))), "mixing")
    of = ["no_source", "source"]
    sizes = stored(rows.groupBy(*of, "class", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    digits = bucket_digits(sizes)
    rows = rows.withColumn("bucket", F.substring(F.col("key"), F.lit(1), digits)).withColumn("coarse", F.substring("key", F.lit(1), F.floor(digits / 2).cast("int")))
    classes = sizes.groupBy(*of, "class").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words"))
    wanted = targets(classes.groupBy(*of).agg(F.sum("words").alias("source_size")))
    heads = classes.select(*of, "class", _before("n", of, F.desc("class")).alias("class_before")).join(wanted, of)
    sizes = sizes.withColumn("size_before", _before("n", [*of, "class"], F.desc("size"))).join(heads, [*of, "class"])
    groups = rows.groupBy(*of, "size", "coarse", "bucket").agg(F.count(F.lit(1)).alias("n"))
    coarse = groups.groupBy(*of, "size", "coarse").agg(F.sum("n").alias("n")).withColumn("coarse_before", _before("n", [*of, "size"], "coarse")).drop("n")
    groups = groups.withColumn("bucket_before", _before("n", [*of, "size", "coarse"], "bucket")).join(coarse, [*of, "size", "coarse"]).join(sizes.drop("n"), [*of, "size"])
    groups = groups.select(*of, "size", "bucket", (F.col("class_before") + F.col("size_before") + F.col("coarse_before") + F.col("bucket_before")).alias("before"), "source_size", "target")
    out = rows.drop("class", "coarse").join(groups, [*of, "size", "bucket"])
    rank = F.col("before") + F.row_number().over(Window.partitionBy(*of, "size", "bucket").orderBy("key", "id", *(["row"] if row else [])))
    out = out.withColumn("rank", rank).withColumn("each", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    named_or_null = F.when(~F.col("no_source"), F.col("source"))
    crossed = lambda k: F.floor(k * F.col("each") + offset(named_or_null, seed))
    out = out.withColumn("copies", (crossed(F.col("rank")) - crossed(F.col("rank") - 1)).cast("long"))
    return out.select(F.col("id").alias(id_col), named_or_null.alias("source"), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *([F.col("row").alias(row_col)] if row_col else []))


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED, number_col: str = "copy_no") -> DataFrame:
    """The mix itself: rows of df, each as often as sampled() says, numbered in number_col. Ids may be null or repeated, other columns have any names but number_col's."""
    rows, at = numbered(df)
    taken = sampled(rows, id_col, text_col, source_col, seed, row_col=at).where("copies > 0")
    copies = taken.select(at, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(number_col))
    return rows.join(copies, at).select(*(rows[f"`{c}`"] for c in df.columns), number_col)
