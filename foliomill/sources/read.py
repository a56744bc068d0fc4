"""Scans: JSON lines in three tempers, Parquet metadata, archives, listings, configuration."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliomill.functions.text import is_layout_artifact, json_structure, sanitized
from foliomill.workers import ship

#: Guards (fixed values).
LONGEST_LINE, MOST_ROWS, DEEPEST, MOST_ITEMS, LONGEST_STRING = 16 << 20, 300_000, 32, 100_000, 4 << 20
CORPUS_FIELDS = ("id", "language", "domain", "text", "source_type", "source", "license")
CORPUS_LICENSES = ("CC-BY-4.0", "MIT", "Apache-2.0", "CC0-1.0", "ODbL-1.0", "open_data", "curated", "public_domain")


def jsonl_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Every line must parse; the first that doesn't ends the query. Blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def jsonl_guarded(spark: SparkSession, path: str, schema: StructType | str, most_rows: int = MOST_ROWS) -> DataFrame:
    """As strict, with limits on lines, depth, items, strings and rows that are checked while rows are read; a path that isn't there is empty."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(fs_path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.trim("value") != "")
    x = lines.withColumn("shape", json_structure(F.when(F.length("value") <= LONGEST_LINE, F.col("value"))))
    faults = {
        "a line is too long": F.length("value") > LONGEST_LINE, "a line is no object": ~F.ltrim("value").startswith("{"), "a line nests too deep": F.col("shape.depth") > DEEPEST,
        "a line has too many items": F.col("shape.items") > MOST_ITEMS, "a string is too long": F.col("shape.longest_string") > LONGEST_STRING,
    }
    guarded = F.col("value")
    for message, fault in reversed(faults.items()):
        guarded = F.when(F.coalesce(fault, F.lit(False)), F.raise_error(F.lit(message))).otherwise(guarded)
    lines = x
    rows = lines.select(F.from_json(guarded, schema if isinstance(schema, StructType) else StructType.fromDDL(schema), {"mode": "FAILFAST"}).alias("row")).select("row.*")
    if rows.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"more than {most_rows} rows")
    return rows


def jsonl_tolerant(spark: SparkSession, path: str, schema: StructType | str, first: int | None = None) -> DataFrame:
    """Lines that don't parse are left out; at most the first so many."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows if first is None else rows.limit(first)


def jsonl_projected(spark: SparkSession, path: str, schema: StructType, columns: list[str]) -> DataFrame:
    """Only these columns are parsed."""
    return spark.read.schema(StructType([schema[c] for c in columns])).json(path)


def bounded_count(rows: DataFrame, most: int = 1000) -> int:
    return rows.limit(most).count()


def parquet_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row: number of rows and column names, from the footers."""
    df = spark.read.parquet(path)
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.array(*map(F.lit, df.columns)))


def config(path: str) -> dict:
    """A JSON or YAML file as a dictionary, read on the driver."""
    text = open(path, encoding="utf-8").read()
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    out = yaml.safe_load(text)
    if not isinstance(out, dict):
        raise ValueError(f"{path} is no mapping")
    return out


def config_rows(spark: SparkSession, shares: dict[str, float]) -> DataFrame:
    """A small table (value, share) of a configured distribution."""
    return spark.createDataFrame(sorted(shares.items()), "value string, share double")


def front_matter(text: str, most: int = 64 << 10) -> dict:
    """The mapping between the two --- lines at the head of a card."""
    if len(text) > most:
        raise ValueError("the card is too long")
    lines = text.splitlines()
    if not lines or lines[0].strip() != "---" or "---" not in [x.strip() for x in lines[1:]]:
        raise ValueError("no front matter")
    import yaml

    end = next(k for k, x in enumerate(lines) if k and x.strip() == "---")
    out = yaml.safe_load("\n".join(lines[1:end]))
    if not isinstance(out, dict):
        raise ValueError("front matter is no mapping")
    return out


def run_summary(summary: dict | None, manifest: dict | None) -> dict:
    """A run's totals: from its summary, else from the counts of its manifest."""
    if summary:
        return {"total": summary.get("total"), "accepted": summary.get("accepted"), "rejected": summary.get("rejected")}
    counts = (manifest or {}).get("counts", {})
    return {"total": counts.get("total", 0), "accepted": counts.get("accepted", 0), "rejected": counts.get("rejected", 0)}


def corpus(spark: SparkSession, path: str, licenses: tuple[str, ...] = CORPUS_LICENSES) -> tuple[DataFrame, DataFrame]:
    """Typed corpus records, and those put aside with the reason: a missing field, a licence that isn't allowed."""
    schema = StructType.fromDDL(", ".join(f"{c} string" for c in CORPUS_FIELDS) + ", allowed_layouts array<string>, tags array<string>")
    rows = jsonl_guarded(spark, path, schema)
    missing = F.array_join(F.array_compact(F.array(*(F.when(F.coalesce(F.col(c), F.lit("")) == "", c) for c in CORPUS_FIELDS))), ",")
    reason = F.when(missing != "", F.concat(F.lit("missing "), missing)).when(~F.col("license").isin(*licenses), "license")
    checked = rows.withColumn("reason", reason)
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null")


def phrases(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments nor form parts."""
    line = F.col("value")
    return spark.read.text(path).where((F.trim(line) != "") & ~line.startswith("#") & ~is_layout_artifact(line)).select(sanitized(line).alias("phrase"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a path without reading them: path, bytes, modified; newest first."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")).orderBy(F.desc("modified"), "path")


def tar_members(spark: SparkSession, path: str) -> DataFrame:
    """Members of archives: archive, member, bytes. Names that would leave the folder end the query."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for archive, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                with tarfile.open(fileobj=io.BytesIO(data.as_buffer()), mode="r:*") as t:
                    for m in t:
                        if not m.isfile():
                            continue
                        if m.name.startswith("/") or ".." in m.name.split("/"):
                            raise ValueError(f"{archive}: {m.name} leaves the folder")
                        yield pa.RecordBatch.from_arrays([pa.array([archive]), pa.array([m.name]), pa.array([t.extractfile(m).read()], pa.binary())], ["archive", "member", "bytes"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "archive string, member string, bytes binary")


def image_formats(df: DataFrame, content: str) -> DataFrame:
    """df with the image format that the leading bytes tell, null if it is none of JPEG, PNG, WEBP."""
    head = F.hex(F.substring(content, 1, 12))
    return df.withColumn("format", F.when(F.startswith(head, F.lit("FFD8FF")), "JPEG").when(F.startswith(head, F.lit("89504E470D0A1A0A")), "PNG").when(head.rlike("^52494646.{8}57454250"), "WEBP"))


def missing_characters(coverage: DataFrame, required: str) -> DataFrame:
    """coverage: font, characters (array). By font the required characters that it lacks."""
    return coverage.select("font", F.array_sort(F.array_except(F.array(*map(F.lit, sorted(set(required)))), "characters")).alias("missing"))
