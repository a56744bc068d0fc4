"""Queries of the operators on nested records: orders as pages, line items as cells of their table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions import pages as P
from foliomill.functions import text as T
from foliomill.operators import distribution, profile, qa, relate, release, similarity
from foliomill.plans import ranking
from foliomill.plans.tables import read
from foliomill.schema import ZONE, page_schema
from foliomill.sources import write
from foliomill.streaming.incremental import counts_by_window


def order_pages(s: SparkSession, d: str) -> DataFrame:
    """Each order a page: a title (the priority) and a table with a row of two cells for each line item."""
    items = read(s, d, "lineitem")
    box = lambda y, x1, x2: F.array(F.lit(float(x1)), (y * 10 + 30).cast("double"), F.lit(float(x2)), (y * 10 + 40).cast("double"))
    y = F.col("l_linenumber")
    cell = lambda col, text, x1, x2: F.struct(y.alias("row"), F.lit(col).alias("col"), box(y, x1, x2).alias("bbox"), text.alias("text"))
    both = F.struct("l_linenumber", cell(0, F.col("l_partkey").cast("string"), 0, 50).alias("a"), cell(1, F.col("l_returnflag"), 50, 100).alias("b"))
    grouped = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(both)).alias("rows"))
    cells = F.flatten(F.transform("rows", lambda r: F.array(r["a"], r["b"])))
    wide = lambda y1, y2: F.array(F.lit(0.0), y1, F.lit(100.0), y2)
    zones = F.array(
        F.struct(F.lit("title").alias("zone_id"), F.lit("title").alias("zone_type"), F.lit("").alias("role"), wide(F.lit(0.0), F.lit(50.0)).alias("bbox"), F.lit(None).cast("array<array<double>>").alias("polygon"), F.col("o_orderpriority").alias("text"), F.lit("en").alias("language"), F.lit(0).alias("reading_order")).alias("z"),
    )
    table = F.struct(F.lit("table").alias("zone_id"), F.lit("table").alias("zone_type"), wide(F.lit(40.0), (F.size("rows") * 10 + 40).cast("double")).alias("bbox"), F.lit("").alias("text"), F.lit(1).alias("reading_order"), cells.alias("cells"))
    x = read(s, d, "orders").join(grouped, F.col("o_orderkey") == F.col("l_orderkey"))
    as_zone = lambda c: F.from_json(F.to_json(c), ZONE)
    have = {
        "page_id": F.col("o_orderkey").cast("string"), "layout_id": F.col("o_orderstatus"), "language_mix": F.lit("kk"), "width": F.lit(100), "height": F.lit(1000), "orientation": F.when(F.size("rows") > 4, "landscape").otherwise("portrait"),
        "layout_density": F.when(F.size("rows") > 5, "dense"), "image_path": F.concat(F.lit("p/"), F.col("o_orderkey").cast("string"), F.lit(".png")), "zones": F.array(as_zone(zones[0]), as_zone(table)),
    }
    return x.select(*((have[f.name] if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in page_schema()))


def table_rows(s: SparkSession, d: str) -> DataFrame:
    return profile.table_rows(order_pages(s, d)).select("page_id", "row", "text")


def table_row_duplicates(s: SparkSession, d: str) -> DataFrame:
    return profile.duplicate_groups(profile.table_rows(order_pages(s, d)), "text")


def coverage(s: SparkSession, d: str) -> DataFrame:
    return distribution.coverage(order_pages(s, d))


def depths(s: SparkSession, d: str) -> DataFrame:
    return distribution.depths(order_pages(s, d))


def rendering(s: SparkSession, d: str) -> DataFrame:
    return distribution.rendering(order_pages(s, d))


def regions(s: SparkSession, d: str) -> DataFrame:
    """Detection rows of the export: cells with text and room."""
    return write.exports(order_pages(s, d))["detection"].select("page_id", "region_id", "text", F.array_join(F.transform("bbox", lambda v: v.cast("int").cast("string")), ",").alias("bbox"))


def segments(s: SparkSession, d: str) -> DataFrame:
    zones = F.col("zones")
    return order_pages(s, d).select("page_id", F.sha2(F.array_join(P.meaningful_segments(zones), "\n"), 256).alias("meaningful"), F.size(P.atomic_texts(zones)).alias("atoms"), P.row_text(zones).alias("text"), P.has_rare(zones).alias("rare"))


def overlapping_zones(s: SparkSession, d: str) -> DataFrame:
    return relate.overlapping_zones(order_pages(s, d)).select("page_id", "zone_id", "other", F.round("ratio", 6).alias("ratio"))


def zone_issues(s: SparkSession, d: str) -> DataFrame:
    """Pages by the issues of their zones, attached by zone."""
    rules = {"excessive_overlap": qa.excessive_overlap, "cells": qa.cells, "missing_required_zone": qa.missing_required_zone}
    checked = qa.check(order_pages(s, d), rules)
    attached = checked.select("page_id", F.inline(relate.issues_by_zone(F.col("zones"), F.col("issues"))))
    return attached.select("zone_id", F.inline("issues")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def structures(s: SparkSession, d: str) -> DataFrame:
    """Sizes of the classes of pages with equal layout."""
    return order_pages(s, d).groupBy(similarity.structure_digest(F.col("zones")).alias("digest")).agg(F.count(F.lit(1)).alias("pages")).select("pages")


def drawable_zones(s: SparkSession, d: str) -> DataFrame:
    return qa.drawable(order_pages(s, d)).groupBy("zones", "repeated", "valid", "drawable").agg(F.count(F.lit(1)).alias("pages"))


def subset_index(s: SparkSession, d: str) -> DataFrame:
    ranked = ranking.nested_subsets(s, d).withColumn("subsets", F.split("subsets", ",")).withColumn("rank", F.col("doc_id"))
    return write.subset_index(ranked, "doc_id").select("subset", "split", "n", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))


def shard_numbers(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select("doc_id", F.element_at(F.array(*map(F.lit, ("train", "train", "val", "test"))), (F.col("doc_id") % 4 + 1).cast("int")).alias("split"))
    return write.sharded(rows, 64, "split", "doc_id").select("doc_id", "split", "shard")


def _files(s: SparkSession, d: str, changed: bool) -> DataFrame:
    digest = F.when(F.col("doc_id") % 50 == 3, F.lit("changed")).otherwise(F.sha2("text", 256)) if changed else F.sha2("text", 256)
    x = read(s, d, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.col("n_chars").alias("bytes"), digest.alias("digest"), "doc_id")
    return x.where("doc_id % 70 <> 5" if changed else "doc_id % 90 <> 7").drop("doc_id")


def file_problems(s: SparkSession, d: str) -> DataFrame:
    return release.file_problems(_files(s, d, False), _files(s, d, True))


def inventory(s: SparkSession, d: str) -> DataFrame:
    return release.inventory_digest(_files(s, d, False))


def hashed_files(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("image"), F.when(F.col("doc_id") % 2 == 0, F.concat("source", F.lit(".txt"))).alias("image_path"))
    return release.file_rows(rows, "doc_id", ("image", "image_path"), _files(s, d, True))


def split_problems(s: SparkSession, d: str) -> DataFrame:
    return release.split_problems(shard_numbers(s, d), {"train": 1, "val": 0, "other": 4}).where("split <> 'x'").select("split", "expected", (F.col("actual") > 0).alias("present"))


def events_by_window(s: SparkSession, d: str) -> DataFrame:
    return counts_by_window(read(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "event_type").select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


def dates(s: SparkSession, d: str) -> DataFrame:
    day = F.date_format("o_orderdate", "dd.MM.yyyy")
    return read(s, d, "orders").select("o_orderkey", T.plus_days(day, 14).alias("due"), F.size(T.dates_in(F.concat(F.lit("on "), day, F.lit(", or 1.1.1999 or "), day))).alias("found"))


def layouts(s: SparkSession, d: str) -> DataFrame:
    names = ["memo_page", "simple_table_page", "glossary_page", "unknown_page", None]
    languages = ["kazakh", " KG ", "ru-kz", "ru_ky", None, "xx"]
    x = s.createDataFrame([(n, m) for n in names for m in languages], "layout string, language string")
    first, second = T.language_parts(F.col("language"))
    return x.select("layout", "language", T.layout_family(F.col("layout")).alias("family"), T.canonical_language(F.col("language")).alias("mix"), first.alias("primary"), second.alias("secondary"))


FUNCTIONS = (
    table_rows, table_row_duplicates, coverage, depths, rendering, regions, segments, overlapping_zones, zone_issues, structures, drawable_zones, subset_index, shard_numbers, file_problems, inventory, hashed_files,
    split_problems, events_by_window, dates, layouts,
)
QUERIES = {f.__name__: f for f in FUNCTIONS}

_N = "(SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)"
_O = f"(SELECT o.*, n FROM orders o JOIN {_N} ON k = o_orderkey)"
_FILES = "(SELECT doc_id || '.txt' AS name, n_chars AS bytes, CASE WHEN {0} AND doc_id % 50 = 3 THEN 'changed' ELSE sha256(text) END AS digest FROM documents WHERE CASE WHEN {0} THEN doc_id % 70 <> 5 ELSE doc_id % 90 <> 7 END)"
_SHARDS = "(SELECT doc_id, split, (row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1) // 64 AS shard FROM (SELECT doc_id, ['train', 'train', 'val', 'test'][doc_id % 4 + 1] AS split FROM documents))"

ORACLES = {
    "table_rows": "SELECT l_orderkey::VARCHAR AS page_id, l_linenumber AS row, string_agg(l_partkey || ' | ' || l_returnflag, ' | ' ORDER BY l_partkey::VARCHAR, l_returnflag) AS text FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL",
    "table_row_duplicates": """SELECT sha256(text) AS digest, count(*) AS n, count(*) - 1 AS excess FROM (SELECT string_agg(l_partkey || ' | ' || l_returnflag, ' | ' ORDER BY l_partkey::VARCHAR, l_returnflag) AS text
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, l_linenumber) GROUP BY 1 HAVING count(*) > 1""",
    "coverage": f"SELECT 'table_count' AS dimension, '1' AS value, count(*) AS n FROM {_O} UNION ALL SELECT 'orientation', CASE WHEN n > 4 THEN 'landscape' ELSE 'portrait' END, count(*) FROM {_O} GROUP BY 2 UNION ALL SELECT 'text_density', CASE WHEN n > 5 THEN 'dense' ELSE 'standard' END, count(*) FROM {_O} GROUP BY 2",
    "depths": "SELECT * FROM (VALUES ('zones', 2, 2, 2.0::DOUBLE), ('paragraphs', 0, 0, 0.0), ('reading_order', 1, 1, 1.0)) v(measure, least, most, mean)",
    "rendering": f"SELECT 'cell' AS part, 2 * sum(n)::BIGINT AS n, 0::BIGINT AS wrapped, 0::BIGINT AS not_wrapped, 0::BIGINT AS complete, 0::BIGINT AS incomplete, 0::BIGINT AS small_fonts FROM {_O}",
    "regions": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey::VARCHAR, l_returnflag) - 1 AS r FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
c AS (SELECT l_orderkey, l_linenumber, col, CASE WHEN col = 0 THEN l_partkey::VARCHAR ELSE l_returnflag END AS text, 2 * r + col AS i FROM r, (VALUES (0), (1)) v(col))
SELECT l_orderkey::VARCHAR AS page_id, 'table_cell' || i AS region_id, text, (50 * col) || ',' || (l_linenumber * 10 + 30) || ',' || (50 + 50 * col) || ',' || (l_linenumber * 10 + 40) AS bbox FROM c""",
    "segments": f"""SELECT o_orderkey::VARCHAR AS page_id, sha256(o_orderpriority || chr(10) || m) AS meaningful, (2 * n + 1)::INT AS atoms, o_orderpriority || chr(10) AS text, false AS rare
FROM {_O} JOIN (SELECT l_orderkey, string_agg(l_partkey || chr(10) || l_returnflag, chr(10) ORDER BY l_linenumber, l_partkey::VARCHAR, l_returnflag) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "overlapping_zones": f"SELECT o_orderkey::VARCHAR AS page_id, 'title' AS zone_id, 'table' AS other, round(1000.0::DOUBLE / least(5000, 1000 * n), 6) AS ratio FROM {_O} WHERE 1000.0 / least(5000, 1000 * n) > 0.35",
    "zone_issues": f"SELECT 'excessive_overlap' AS code, count(*) AS n FROM {_O} WHERE 1000.0 / least(5000, 1000 * n) > 0.35 UNION ALL SELECT 'invalid_table_cell', count(*) FROM lineitem l JOIN {_O} ON o_orderkey = l_orderkey, (VALUES (0), (1)) v(c) WHERE l_linenumber * 10 + 40 > n * 10 + 40 OR l_linenumber * 10 + 30 < 40 HAVING count(*) > 0",
    "structures": "SELECT count(*) AS pages FROM (SELECT l_orderkey, string_agg(l_linenumber::VARCHAR, ',' ORDER BY l_linenumber) AS k FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) GROUP BY k",
    "drawable_zones": f"SELECT 2::BIGINT AS zones, 0::BIGINT AS repeated, 2::BIGINT AS valid, 2::BIGINT AS drawable, count(*) AS pages FROM {_O}",
    "subset_index": f"WITH x AS ({ranking.ORACLES['nested_subsets']}) SELECT subset, split, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM (SELECT doc_id, split, unnest(string_split(subsets, ',')) AS subset FROM x) GROUP BY 1, 2",
    "shard_numbers": f"SELECT * FROM {_SHARDS}",
    "file_problems": f"""SELECT name, problem FROM (SELECT coalesce(e.name, a.name) AS name, CASE WHEN a.digest IS NULL THEN 'missing' WHEN e.digest IS NULL THEN 'unlisted' WHEN e.bytes <> a.bytes THEN 'size' WHEN e.digest <> a.digest THEN 'digest' END AS problem
FROM {_FILES.format('false')} e FULL JOIN {_FILES.format('true')} a ON e.name = a.name) WHERE problem IS NOT NULL""",
    "inventory": f"SELECT sha256(string_agg(name || ':' || digest, chr(10) ORDER BY name, digest)) AS digest, count(*) AS files, sum(bytes)::BIGINT AS bytes FROM {_FILES.format('false')}",
    "hashed_files": f"""WITH r AS (SELECT doc_id, 'image' AS field, doc_id || '.txt' AS path FROM documents UNION ALL SELECT doc_id, 'image_path', source || '.txt' FROM documents WHERE doc_id % 2 = 0)
SELECT doc_id, field, path, coalesce(digest, '') AS digest, CASE WHEN digest IS NULL THEN 'missing' ELSE 'ok' END AS status FROM r LEFT JOIN {_FILES.format('true')} f ON f.name = path""",
    "split_problems": "SELECT split, expected::BIGINT AS expected, present FROM (VALUES ('train', 1, true), ('val', 0, true), ('test', 0, true), ('other', 4, false)) v(split, expected, present)",
    "events_by_window": "SELECT strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "dates": "SELECT o_orderkey, strftime(o_orderdate + INTERVAL 14 DAY, '%d.%m.%Y') AS due, 2 AS found FROM orders",
    "layouts": """WITH l(layout, family) AS (VALUES ('memo_page', 'specialized'), ('simple_table_page', 'table'), ('glossary_page', 'reference'), ('unknown_page', 'other'), (NULL, 'other')),
g(language, mix, "primary", secondary) AS (VALUES ('kazakh', 'kk', 'kk', NULL), (' KG ', 'ky', 'ky', NULL), ('ru-kz', 'ru_kk', 'kk', 'ru'), ('ru_ky', 'ru_ky', 'ky', 'ru'), (NULL, 'kk', 'kk', NULL), ('xx', 'kk', 'kk', NULL)) SELECT layout, language, family, mix, "primary", secondary FROM l, g""",
}
