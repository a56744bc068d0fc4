"""Sinks. Spark's commit protocol makes each write all or nothing."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.pages import date_roles, ocr_regions
from foliomill.operators.splits import ORDER, ranked_by
from foliomill.workers import ship

REVIEW_STATES = ("pending", "accepted", "rejected", "needs_review")


def jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    """One object per line, nulls kept; an empty table writes no row."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def parquet(df: DataFrame, path: str, *by: str) -> None:
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*by) if by else w).parquet(path)


def split_manifest(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder for each split; rows of a split are together, so each task writes few files."""
    df.repartition(split, F.pmod(F.xxhash64(*df.columns[:1]), F.lit(32))).write.mode("overwrite").partitionBy(split).parquet(path)


def release_indexes(df: DataFrame, path: str) -> None:
    """All rows, and those of each subset by split: df has subsets (array) and split."""
    every = df.select("*", F.explode(F.concat(F.array(F.lit("all")), "subsets")).alias("config"))
    parquet(every, path, "config", "split")


def metadata_groups() -> Column:
    """The parts of a page record by topic."""
    group = lambda name, *columns: F.struct(*columns).alias(name)
    return F.struct(
        group("identity", "page_id", "shard_id", "image_path"), group("language", "language_mix", "primary_language", "secondary_language", "language_mix_ratio", "mixing_features"),
        group("layout", "layout_id", "layout_variant", "layout_density", "orientation", "content_lineage_id"), group("render", "width", "height", "content_height_ratio"),
        group("effects", "quality_profile", "effect_chain", "geometry_tier"), group("corpus", "content_record_ids", "grammar_source"), group("qa", "qa_ok", "qa_flags", "qa_issues"),
    )


def exports(pages: DataFrame) -> dict[str, DataFrame]:
    """The six tables of a shard as projections of one: manifest, metadata, zones, detection, recognition, prompts."""
    regions = pages.select("page_id", F.col("image_path").alias("image"), F.inline(ocr_regions(F.col("zones"))))
    detection = regions.select("image", "page_id", "region_id", F.col("region_id").alias("line_id"), "text", "bbox", "polygon")
    return {
        "manifest": pages.withColumn("metadata_groups", metadata_groups()),
        "metadata": pages.select("*", date_roles(F.col("zones")).alias("date_roles")).drop("zones"),
        "zones": pages.select("page_id", "zones"),
        "detection": detection,
        "recognition": detection.drop("bbox", "polygon"),
        "prompts": pages.select("page_id", F.col("image_path").alias("image"), F.lit("Read the page.").alias("prompt"), F.to_json("zones").alias("response")),
    }


def export_shard(pages: DataFrame, path: str, *names: str) -> None:
    for name, table in exports(pages).items():
        if not names or name in names:
            jsonl(table, f"{path}/{name}")


def subset_index(ranked: DataFrame, key: str) -> DataFrame:
    """One row for each subset and split: its keys in rank order. The lists are the file that consumers expect; the table with subsets holds the same."""
    x = ranked.select(key, "split", "rank", F.explode("subsets").alias("subset"))
    keys = F.transform(F.array_sort(F.collect_list(F.struct("rank", key))), lambda s: s[key])
    return x.groupBy("subset", "split").agg(keys.alias("ids"), F.count(F.lit(1)).alias("n"))


def sharded(rows: DataFrame, per_shard: int, split: str, *order: str) -> DataFrame:
    """rows with shard: the number of full shards before them in their split. Starts of splits come from ranks over all rows."""
    position = F.element_at(F.create_map(*[x for k, s in enumerate(ORDER) for x in (F.lit(s), F.lit(k))]), F.col(split))
    x = ranked_by(rows.withColumn("_split", position), F.col("_split"), *map(F.col, order))
    starts = x.groupBy(split).agg(F.min("rank").alias("_start"))
    return x.join(F.broadcast(starts), split).withColumn("shard", F.floor((F.col("rank") - F.col("_start")) / per_shard)).drop("_split", "_start", "rank")  # one row for each split


def tar_shards(rows: DataFrame, split: str = "split", name: str = "page_id", payload: str = "image", suffix: str = "png", record: str = "json") -> DataFrame:
    """Archives as rows (split, shard, bytes): for each row of a shard its payload and its JSON, in name order. rows: split, shard, name, payload (binary), json."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, buffer, archive = None, None, None

        def done():
            archive.close()
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.string()), pa.array([now[1]], pa.int64()), pa.array([buffer.getvalue()], pa.binary())], ["split", "shard", "bytes"])

        for b in batches:
            for s, k, n, data, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (s, k) != now:
                    if now is not None:
                        yield done()
                    now, buffer = (s, k), io.BytesIO()
                    archive = tarfile.open(fileobj=buffer, mode="w")
                for ending, content in ((suffix, data or b""), (record, (text or "{}").encode())):
                    info = tarfile.TarInfo(f"{n}.{ending}")
                    info.size = len(content)
                    archive.addfile(info, io.BytesIO(content))
        if now is not None:
            yield done()

    x = rows.select(F.col(split).alias("split"), F.col("shard").cast("long").alias("shard"), F.col(name).cast("string").alias("name"), F.col(payload).cast("binary").alias("payload"), F.col(record).cast("string").alias("json"))
    return x.repartition("split", "shard").sortWithinPartitions("split", "shard", "name").mapInArrow(run, "split string, shard long, bytes binary")


def report(df: DataFrame) -> str:
    """A one-row table as indented JSON."""
    return json.dumps(json.loads(df.toJSON().first() or "{}"), ensure_ascii=False, indent=2)


def markdown(df: DataFrame, most: int = 100) -> str:
    """The first rows as a Markdown table."""
    rows = df.limit(most).collect()
    line = lambda cells: "| " + " | ".join(str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(df.columns), line(["-"] * len(df.columns)), *map(line, rows)])


def merged(*shards: DataFrame) -> DataFrame:
    """Shards by column name; columns that one lacks are null there."""
    out = shards[0]
    for s in shards[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def reviewed(log: DataFrame, path: str) -> None:
    """Appends review entries; a state that isn't known ends the query."""
    state = F.when(F.col("visual_qa_status").isin(*REVIEW_STATES), F.col("visual_qa_status")).otherwise(F.raise_error(F.concat(F.lit("unknown state "), F.coalesce("visual_qa_status", F.lit("null")))))
    log.withColumn("visual_qa_status", state).write.mode("append").json(path)


def shard_range(text: str, shards: int) -> range:
    """N or START-END, within the number of shards."""
    first, _, last = text.partition("-")
    if not first.isdigit() or (last and not last.isdigit()):
        raise ValueError(f"{text} is no shard or range")
    out = range(int(first), int(last or first) + 1)
    if not len(out) or out[-1] >= shards:
        raise ValueError(f"{text} is outside 0-{shards - 1}")
    return out
