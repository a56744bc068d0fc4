"""Digests and validation of what was written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """name (relative to path), bytes, digest of each file below path. Files are hashed on the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    root = path.split(":", 1)[-1].rstrip("/")
    name = F.regexp_replace("path", F.lit(rf"^[a-z]*:/*{root.lstrip('/')}/"), F.lit(""))
    return files.select(name.alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("digest"))


def inventory_digest(files: DataFrame) -> DataFrame:
    """One digest of names and digests in name order, number and bytes of files."""
    each = F.transform(F.array_sort(F.collect_list(F.struct("name", "digest"))), lambda x: F.concat_ws(":", x["name"], x["digest"]))
    return files.agg(F.sha2(F.array_join(each, "\n"), 256).alias("digest"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def run_signature(*digests: str) -> str:
    import hashlib

    return hashlib.sha256("\n".join(digests).encode()).hexdigest()


def canonical_digest(record: dict, volatile: tuple[str, ...] = ("metrics",)) -> str:
    """SHA-256 of compact JSON with sorted keys, without volatile parts."""
    import hashlib
    import json

    kept = {k: v for k, v in record.items() if k not in volatile}
    return hashlib.sha256(json.dumps(kept, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def file_problems(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(name, problem): missing, unlisted, of another size, of another digest. Both: name, bytes, digest."""
    x = expected.select("name", F.col("bytes").alias("eb"), F.col("digest").alias("ed")).join(actual.select("name", F.col("bytes").alias("ab"), F.col("digest").alias("ad")), "name", "full")
    problem = F.when(F.col("ad").isNull(), "missing").when(F.col("ed").isNull(), "unlisted").when(F.col("eb") != F.col("ab"), "size").when(F.col("ed") != F.col("ad"), "digest")
    return x.select("name", problem.alias("problem")).where("problem is not null")


def file_rows(rows: DataFrame, key: str, fields: tuple[str, ...], digests: DataFrame) -> DataFrame:
    """For each row and path field: key, field, path, status (ok or missing), digest (empty if missing). digests: name, digest."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("path")) for f in fields))
    x = rows.select(key, F.inline(pairs)).where("path is not null")
    known = digests.groupBy("name").agg(F.min("digest").alias("digest"))
    x = x.join(known, F.col("path") == F.col("name"), "left").drop("name")
    return x.withColumn("status", F.when(F.col("digest").isNull(), "missing").otherwise("ok")).withColumn("digest", F.coalesce("digest", F.lit("")))


def archive_problems(members: DataFrame, index: DataFrame, suffixes: tuple[str, ...] = ("png", "json")) -> DataFrame:
    """(page_id, problem): a member without its partner, a page of the index in no archive, a page of an archive not in the index, a page in two archives."""
    parts = members.select("archive", F.regexp_extract("member", r"([^/]+)\.[^.]+$", 1).alias("page_id"), F.regexp_extract("member", r"\.([^.]+)$", 1).alias("suffix"))
    pages = parts.groupBy("page_id").agg(F.countDistinct("archive").alias("archives"), F.array_sort(F.collect_set("suffix")).alias("suffixes"))
    x = pages.join(index.select("page_id").distinct().withColumn("_in", F.lit(1)), "page_id", "full")
    problem = F.when(F.col("archives").isNull(), "in no archive").when(F.col("_in").isNull(), "not in the index").when(F.col("archives") > 1, "in two archives").when(F.size(F.array_except(F.array(*map(F.lit, suffixes)), "suffixes")) > 0, "incomplete")
    return x.select("page_id", problem.alias("problem")).where("problem is not null")


def split_problems(index: DataFrame, expected: dict[str, int]) -> DataFrame:
    """(split, expected, actual) where the number of rows isn't as told."""
    spark = index.sparkSession
    want = spark.createDataFrame(sorted(expected.items()), "split string, expected long")
    have = index.groupBy("split").agg(F.count(F.lit(1)).alias("actual"))
    return want.join(have, "split", "full").select("split", F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")).where("expected != actual")


def subset_problems(index: DataFrame, key: str = "page_id") -> DataFrame:
    """Rows of a smaller subset that a larger one lacks."""
    has = lambda s: F.array_contains("subsets", s)
    return index.where((has("tiny") & ~has("medium")) | (has("medium") & ~has("large"))).select(key, "subsets")


def summary(index: DataFrame) -> DataFrame:
    """Rows by layout, language and effect."""
    x = index.select(F.inline(F.array(*(F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias("value")) for c in ("layout_id", "language_mix", "effect_profile") if c in index.columns))))
    return x.groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
