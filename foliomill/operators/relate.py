"""Joins and set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.geometry import boxes_intersect, overlap_ratio, polygons_intersect
from foliomill.functions.text import filled_or_unknown


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of left without partner; their number must be 0 for a complete pair of tables."""
    return left.join(right, keys, "left_anti")


def matched_in_order(detections: DataFrame, recognitions: DataFrame, keys: list[str], page: str, order: str, keep: list[str]) -> DataFrame:
    """By page the matched pairs in the detections' order, as an array."""
    x = detections.join(recognitions, keys)
    pairs = F.array_sort(F.collect_list(F.struct(order, *keep)))
    return x.groupBy(page).agg(pairs.alias("pairs"))


def with_default_array(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Left outer join; a missing array is empty."""
    x = left.join(right, key, "left")
    return x.withColumn(column, F.coalesce(F.col(column), F.array().cast(right.schema[column].dataType)))


def complete_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join that fails at run time if a row of either side has no partner."""
    x = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), key, "full")
    missing = F.raise_error(F.concat(F.lit("without partner: "), F.col(key).cast("string")))
    return x.withColumn("_l", F.when(F.col("_l").isNull() | F.col("_r").isNull(), missing.cast("int")).otherwise(1)).where("_l = 1").drop("_l", "_r")


def leakage(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """All pairs (field, value, left_id, right_id) of equal values; nulls match nothing. A value common on both sides gives many pairs: see leaked_values for counts alone."""
    x, y = _unpivoted(left, key, fields), _unpivoted(right, key, fields)
    return x.withColumnRenamed("id", "left_id").join(y.withColumnRenamed("id", "right_id"), ["field", "value"])


def _unpivoted(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))
    return df.select(F.col(key).alias("id"), F.inline(pairs)).where("value is not null")


def leaked_values(left: DataFrame, right: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """By field the number of distinct values that both sides have, and the number of pairs, without making them."""
    x = _unpivoted(left, key, fields).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
    y = _unpivoted(right, key, fields).groupBy("field", "value").agg(F.count(F.lit(1)).alias("m"))
    return x.join(y, ["field", "value"]).groupBy("field").agg(F.count(F.lit(1)).alias("shared_values"), F.sum(F.col("n") * F.col("m")).alias("pairs"))


def overlapping_zones(pages: DataFrame, limit: float = 0.35) -> DataFrame:
    """Pairs of zones of one page, earlier and later, that overlap by more than limit; stamps and decoration aside."""
    zones = pages.select("page_id", F.posexplode("zones").alias("at", "z")).where("z.zone_type not in ('stamp', 'decorative_non_text')")
    zones = zones.select("page_id", "at", "z.zone_id", F.coalesce("z.metadata.source_bbox", "z.bbox").alias("box"))
    a, b = zones.alias("a"), zones.alias("b")
    x = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.at") < F.col("b.at")))
    return x.withColumn("ratio", overlap_ratio(F.col("a.box"), F.col("b.box"))).where(F.col("ratio") > limit).select("a.page_id", F.col("a.zone_id").alias("zone_id"), F.col("b.zone_id").alias("other"), "ratio")


def intersecting_cells(pages: DataFrame) -> DataFrame:
    """Pairs of cells of one zone whose rendered polygons, or else boxes, intersect."""
    cells = pages.select("page_id", F.explode("zones").alias("z")).where("z.zone_type = 'table'").select("page_id", "z.zone_id", F.posexplode("z.cells").alias("at", "c"))
    cells = cells.select("page_id", "zone_id", "at", F.col("c.metadata.rendered_bbox").alias("box"), F.col("c.metadata.rendered_bbox_polygon").alias("polygon")).where("box is not null")
    a, b = cells.alias("a"), cells.alias("b")
    x = a.join(b, (F.col("a.page_id") == F.col("b.page_id")) & (F.col("a.zone_id") == F.col("b.zone_id")) & (F.col("a.at") < F.col("b.at")))
    hit = F.when((F.size("a.polygon") > 0) & (F.size("b.polygon") > 0), polygons_intersect(F.col("a.polygon"), F.col("b.polygon"))).otherwise(boxes_intersect(F.col("a.box"), F.col("b.box")))
    return x.where(hit).select("a.page_id", "a.zone_id", F.col("a.at").alias("cell"), F.col("b.at").alias("other"))


def issues_by_zone(zones: Column, issues: Column) -> Column:
    """Zones with the issues that name them."""
    return F.transform(zones, lambda z: F.struct(z["zone_id"].alias("zone_id"), F.filter(issues, lambda i: i["zone_id"] == z["zone_id"]).alias("issues")))


def with_files(rows: DataFrame, path: str, files: DataFrame) -> DataFrame:
    """rows with exists, whether their path is in files (path, ...)."""
    present = files.select(F.col("path").alias(path), F.lit(True).alias("exists")).distinct()
    return rows.join(present, path, "left").withColumn("exists", F.coalesce("exists", F.lit(False)))


def with_digests(rows: DataFrame, name: str, digests: DataFrame, computed: Column) -> DataFrame:
    """rows with the digest that a manifest (name, digest) has for their file name, else the computed one."""
    known = digests.groupBy("name").agg(F.min("digest").alias("digest")).withColumnRenamed("name", "_name")
    return rows.join(known, F.element_at(F.split(F.col(name), "/"), -1) == F.col("_name"), "left").withColumn("digest", F.coalesce("digest", computed)).drop("_name")


def append_new(base: DataFrame, extra: DataFrame, text: str) -> DataFrame:
    """base, and the rows of extra whose text base doesn't have."""
    return base.unionByName(extra.join(base.select(text).distinct(), text, "left_anti").select(*base.columns))


def linkage_edges(rows: DataFrame, key: str, links: dict[str, Column]) -> DataFrame:
    """Rows (id, link): a row's non-empty linkage values by kind; each Column is an array of strings."""
    parts = [rows.select(F.col(key).alias("id"), F.explode(values).alias("value")).where("value is not null and value != ''").select("id", F.concat(F.lit(f"{kind}:"), "value").alias("link")) for kind, values in links.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of either that the other lacks, with multiplicity: side, columns."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def stratum(*columns: Column) -> Column:
    """A key of several columns in which null and empty are the same."""
    return F.concat_ws("|", *(filled_or_unknown(c.cast("string")) for c in columns))
