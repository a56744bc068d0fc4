"""Queries of scans, sinks, gates and smaller functions over the test tables."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliomill.functions import geometry
from foliomill.functions import pages as P
from foliomill.functions import text as T
from foliomill.operators import distribution, gallery, qa, relate, sampling, splits
from foliomill.plans import faults, ranking, records
from foliomill.plans.tables import read
from foliomill.sources import read as sources
from foliomill.sources import write
from foliomill.storage import shared_dir


def _folder(s: SparkSession) -> str:
    return f"{shared_dir(s)}/foliomill-{s.sparkContext.applicationId}/{uuid.uuid4().hex}"


def json_lines(s: SparkSession, d: str) -> DataFrame:
    """Documents written as JSON lines and read back in every temper: rows and characters."""
    docs, at = read(s, d, "documents"), _folder(s)
    write.jsonl(docs, at)
    schema = StructType(docs.schema.fields)
    readers = {
        "strict": sources.jsonl_strict(s, at, schema), "guarded": sources.jsonl_guarded(s, at, schema, 2_000_000_000), "tolerant": sources.jsonl_tolerant(s, at, schema), "projected": sources.jsonl_projected(s, at, schema, ["text"]),
    }
    parts = [x.agg(F.lit(name).alias("reader"), F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).cast("long").alias("characters")) for name, x in readers.items()]
    bounded = s.createDataFrame([("bounded", sources.bounded_count(readers["tolerant"], 150), 0)], "reader string, n long, characters long")
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(bounded)


def split_folders(s: SparkSession, d: str) -> DataFrame:
    """Documents written by split with their metadata read back."""
    docs, at = read(s, d, "documents"), _folder(s)
    write.split_manifest(docs.withColumn("split", F.element_at(F.array(*map(F.lit, splits.ORDER)), (F.col("doc_id") % 3 + 1).cast("int"))), at)
    counts = s.read.parquet(at).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(sources.parquet_metadata(s, at).select(F.array_join(F.array_sort("columns"), ",").alias("split"), F.col("rows").alias("n")))


def json_shapes(s: SparkSession, d: str) -> DataFrame:
    """Depth, items and longest string of each document as JSON."""
    row = F.to_json(F.struct("doc_id", "text", F.struct(F.array("lang", "source").alias("of")).alias("tags"), F.array().cast("array<int>").alias("none")))
    return read(s, d, "documents").select("doc_id", T.json_structure(row).alias("x")).select("doc_id", "x.*")


def fonts(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    pick = lambda *values: F.element_at(F.array(*(F.lit(v).cast("string") for v in values)), (F.col("doc_id") % len(values) + 1).cast("int"))
    family, path = pick("Noto Serif", "Deja Mono", "Arial", "Times"), pick("C:\\Windows\\Fonts\\a.ttf", "/usr/share/fonts/b.ttf", "own_fonts/c.ttf", "", None, "d.ttf")
    return docs.select("doc_id", T.font_category(family, path).alias("category"), T.font_source(path, "own_fonts/").alias("source"))


def selected_fonts(s: SparkSession, d: str) -> DataFrame:
    """Distinct fonts of the lines of each document, first seen first; a line's length picks its font."""
    font = lambda t: F.struct(F.struct((F.length(t) % 3).cast("string").alias("font_family"), (F.length(t) % 2).cast("string").alias("font_path")).alias("style"))
    found = P.selected_fonts(F.transform(F.split("text", "\n"), font))
    return read(s, d, "documents").select("doc_id", F.array_join(F.transform(found, lambda x: F.concat(x["family"], F.lit("/"), x["path"])), ",").alias("fonts"))


def last_per_id(s: SparkSession, d: str) -> DataFrame:
    """Of the lines of each document the last of each length modulo 4, in the order in which those came first; by SHA-256."""
    rows = F.transform(F.split("text", "\n"), lambda t: F.struct((F.length(t) % 4).alias("id"), t.alias("value")))
    return read(s, d, "documents").select("doc_id", F.sha2(F.array_join(F.transform(P.last_per_id(rows, "id"), lambda r: F.concat_ws(":", r["id"].cast("string"), r["value"])), "\n"), 256).alias("digest"))


def full_texts(s: SparkSession, d: str) -> DataFrame:
    x = records.order_pages(s, d)
    return x.select("page_id", F.sha2(P.full_text(F.col("zones")), 256).alias("digest"), F.size(P.compacted(F.col("zones"))).alias("zones"), F.size(P.date_roles(F.col("zones"))).alias("roles"))


def language_ratios(s: SparkSession, d: str) -> DataFrame:
    """Estimated shares of a page with the document as its zone, in a language that its number tells."""
    language = F.element_at(F.array(*map(F.lit, ("kk", "ru", "bilingual_kk_ru"))), (F.col("doc_id") % 3 + 1).cast("int"))
    zones = F.array(F.struct(F.col("text"), language.alias("language"), F.array(F.struct(F.lit("сөз").alias("text"), F.lit("ru").alias("language"))).alias("cells")))
    ratio = P.language_ratio(zones, F.lit("kk"), F.when(F.col("doc_id") % 4 != 0, "ru"))
    return read(s, d, "documents").select("doc_id", *(F.round(ratio[k], 3).alias(k) for k in ("kk", "ru", "en")))


def intersecting_cells(s: SparkSession, d: str) -> DataFrame:
    return relate.intersecting_cells(faults.faulty_pages(s, d))


def known_digests(s: SparkSession, d: str) -> DataFrame:
    """Digests by file name from a manifest, computed where it has none."""
    rows = read(s, d, "documents").select("doc_id", F.concat(F.lit("images/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.lit("computed").alias("own"))
    return relate.with_digests(rows, "path", records._files(s, d, True), F.col("own")).select("doc_id", "digest")


def retries(s: SparkSession, d: str) -> DataFrame:
    """For each document the first of 20 attempts that is good."""
    return sampling.retried(read(s, d, "documents"), "doc_id", lambda k, a: (k * 7 + a * 3) % 31, lambda v: v % 16 == 5)


def subset_sizes(s: SparkSession, d: str) -> DataFrame:
    totals = [0, 1, 25, 99_999, 100_000, 100_001, read(s, d, "documents").count() + 1_000_000]
    return s.createDataFrame([(n, *splits.subset_sizes(n).values()) for n in totals], "total long, tiny long, medium long")


def moved_boxes(s: SparkSession, d: str) -> DataFrame:
    """Boxes of the nations under the map of one rectangle to another, kept inside the page."""
    matrix = geometry.homography(np.array([(0, 0), (100, 0), (100, 100), (0, 100)]), np.array([(10, 20), (210, 20), (210, 120), (10, 120)]))
    forward = F.array(*(F.array(*(F.lit(float(v)) for v in row)) for row in matrix))
    inverse = F.array(*(F.array(*(F.lit(float(v)) for v in row)) for row in np.linalg.inv(matrix)))
    corner = F.col("n_nationkey").cast("double")
    x = read(s, d, "nation").select("n_nationkey", geometry.moved(P.corners(F.array(corner, corner, corner + 30.0, corner + 10.0)), forward, F.lit(100), F.lit(50)).alias("p"), geometry.inverse_holds(forward, inverse).alias("inverse"))
    return x.select("n_nationkey", *(F.round(F.col("p")[k][j], 6).alias(f"{c}{k}") for k in (0, 2) for j, c in enumerate("xy")), "inverse")


def image_formats(s: SparkSession, d: str) -> DataFrame:
    heads = ("FFD8FFE0", "89504E470D0A1A0A00", "524946460000000057454250", "00")
    x = read(s, d, "documents").select("doc_id", F.unhex(F.element_at(F.array(*map(F.lit, heads)), (F.col("doc_id") % 4 + 1).cast("int"))).alias("content"))
    return sources.image_formats(x, "content").select("doc_id", "format")


def missing_characters(s: SparkSession, d: str) -> DataFrame:
    """By language the accented letters that none of its documents has."""
    have = read(s, d, "documents").groupBy(F.col("lang").alias("font")).agg(F.array_distinct(F.flatten(F.collect_set(F.array_distinct(F.split(F.regexp_replace("text", "[^éèñßüó]", ""), ""))))).alias("characters"))
    return sources.missing_characters(have, "éèñßüó").select("font", F.array_join("missing", "").alias("missing"))


def run_totals(s: SparkSession, d: str) -> DataFrame:
    return gallery.run_detail(ranking._gallery(s, d))[0]


def first_rejected(s: SparkSession, d: str) -> DataFrame:
    """A page of the rejected rows."""
    return gallery.page(gallery.rejected(ranking._gallery(s, d)), F.lit(True), 2, 12).select("row_index", "page_id")


def variant_gates(s: SparkSession, d: str) -> DataFrame:
    """Sources with enough documents in fewer than four languages, or than 12."""
    docs = read(s, d, "documents")
    return distribution.variant_gate(docs, "source", "lang", from_rows=3).unionByName(distribution.variant_gate(docs.where("lang <> 'es'"), "lang", "source", 21, 1))


def coverage_gates(s: SparkSession, d: str) -> DataFrame:
    return distribution.coverage_gate(read(s, d, "documents"), {"lang": ["de", "it", "kk"], "source": ["src1", "src99"]})


def rendering_gates(s: SparkSession, d: str) -> DataFrame:
    """Counted over one page per document, each with one fault."""
    pages = faults.faulty_pages(s, d)
    return distribution.rendering_gate(qa.issue_rows(qa.check(pages, faults.RULES)), distribution.rendering(pages))


def audit_gates(s: SparkSession, d: str) -> DataFrame:
    return distribution.audit_gate(read(s, d, "documents"), read(s, d, "labels"), "doc_id")


def layout_artifacts(s: SparkSession, d: str) -> DataFrame:
    """Whether a line is part of a form: rules for lines, headings and fields, on lines that the documents' numbers pick."""
    lines = ("____", "Өтініш", "Дата: 1.1.2024", "жай мәтін", "қолы: ", "  ")
    x = read(s, d, "documents").select("doc_id", F.element_at(F.array(*map(F.lit, lines)), (F.col("doc_id") % len(lines) + 1).cast("int")).alias("line"))
    return x.select("doc_id", T.is_layout_artifact(F.col("line")).alias("artifact"), T.mixes_scripts(F.concat(F.col("line"), F.lit("x"))).alias("mixed"))


def searched_texts(s: SparkSession, d: str) -> DataFrame:
    """Names and values of nested columns in one lower-case text, and whether a page has a stamp."""
    row = F.struct(F.col("source").alias("Layout"), F.array("lang").alias("tags"))
    stamp = F.when(F.col("doc_id") % 3 == 0, "s").when(F.col("doc_id") % 3 == 1, "")
    return read(s, d, "documents").select("doc_id", P.search_text(row).alias("search"), P.has_stamp(stamp, F.when(F.col("doc_id") % 2 == 0, "t")).alias("stamped"))


FUNCTIONS = (
    json_lines, split_folders, json_shapes, fonts, selected_fonts, last_per_id, full_texts, language_ratios, intersecting_cells, known_digests, retries, subset_sizes, moved_boxes, image_formats, missing_characters,
    run_totals, first_rejected, variant_gates, coverage_gates, rendering_gates, audit_gates, layout_artifacts, searched_texts,
)
QUERIES = {f.__name__: f for f in FUNCTIONS}

_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)"
_N = len(faults.FAULTS)
_KIND = next(k for k, (codes, _) in enumerate(faults.FAULTS) if "glyph_intersection_neighboring_cells" in codes)
_GATES = ", ".join(f"({k}, '{gate}', {n})" for k, (codes, _) in enumerate(faults.FAULTS) for code, n in codes.items() for gate, of in distribution.RENDERING_GATES.items() if code in of)
_LETTERS = "[A-Za-zА-Яа-яЁёӘәҒғҚқҢңӨөҰұҮүҺһІі]"

ORACLES = {
    "json_lines": "SELECT reader, count(*) AS n, sum(length(text))::BIGINT AS characters FROM documents, (VALUES ('strict'), ('guarded'), ('tolerant'), ('projected')) v(reader) GROUP BY 1 UNION ALL SELECT 'bounded', least(150, (SELECT count(*) FROM documents)), 0",
    "split_folders": "SELECT ['train', 'val', 'test'][doc_id % 3 + 1] AS split, count(*) AS n FROM documents GROUP BY 1 UNION ALL SELECT 'doc_id,lang,n_chars,source,split,text', count(*) FROM documents",
    "json_shapes": "SELECT doc_id, 3 AS depth, 13 AS items, greatest(length(text), length(source), 6)::INT AS longest_string FROM documents",
    "fonts": r"SELECT doc_id, ['serif', 'mono_or_table_safe', 'sans', 'serif'][doc_id % 4 + 1] AS category, ['system', 'system', 'custom_user', 'fallback', 'fallback', 'pil_lookup'][doc_id % 6 + 1] AS source FROM documents",
    "selected_fonts": f"SELECT doc_id, string_agg(f, ',' ORDER BY i) AS fonts FROM (SELECT doc_id, (length(t) % 3) || '/' || (length(t) % 2) AS f, min(i) AS i FROM {_LINES} GROUP BY 1, 2) GROUP BY 1",
    "last_per_id": f"SELECT doc_id, sha256(string_agg(k || ':' || v, chr(10) ORDER BY i)) AS digest FROM (SELECT doc_id, length(t) % 4 AS k, arg_max(t, i) AS v, min(i) AS i FROM {_LINES} GROUP BY 1, 2) GROUP BY 1",
    "full_texts": f"""SELECT o_orderkey::VARCHAR AS page_id, sha256(o_orderpriority || '  ' || m) AS digest, 2 AS zones, 0 AS roles
FROM orders JOIN (SELECT l_orderkey, string_agg(l_partkey || ' ' || l_returnflag, ' ' ORDER BY l_linenumber, l_partkey::VARCHAR, l_returnflag) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "language_ratios": rf"""WITH a AS (SELECT doc_id, greatest(1, length(regexp_replace(text, '^\s+|\s+$', '', 'g')))::DOUBLE AS n, coalesce(len(regexp_extract_all(text, '[A-Za-z]'))::DOUBLE / nullif(len(regexp_extract_all(text, '{_LETTERS}')), 0), 0) AS l FROM documents),
b AS (SELECT doc_id, n * l AS e, greatest(0, n - n * l) AS r FROM a), c AS (SELECT doc_id, e, CASE doc_id % 3 WHEN 0 THEN r WHEN 1 THEN 0 ELSE r * 0.68::DOUBLE END AS p, CASE doc_id % 3 WHEN 0 THEN 0 WHEN 1 THEN r ELSE r * 0.32::DOUBLE END + 3 AS s FROM b),
x AS (SELECT doc_id, round(p / (p + s + e), 3) AS p, round(s / (p + s + e), 3) AS s, round(e / (p + s + e), 3) AS e FROM c)
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 1.0 ELSE round(p + (1.0 - (p + s + e)), 3) END::DOUBLE AS kk, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE s END::DOUBLE AS ru, CASE WHEN doc_id % 4 = 0 THEN 0 ELSE e END::DOUBLE AS en FROM x""",
    "intersecting_cells": f"SELECT doc_id::VARCHAR AS page_id, 't' AS zone_id, 0 AS cell, 1 AS other FROM documents WHERE doc_id % {_N} = {_KIND}",
    "known_digests": f"SELECT doc_id, coalesce(digest, 'computed') AS digest FROM documents LEFT JOIN {records._FILES.format('true')} f ON f.name = doc_id || '.txt'",
    "retries": "WITH a AS (SELECT doc_id, k AS attempt, (doc_id * 7 + k * 3) % 31 AS v FROM documents, range(0, 20) r(k)), f AS (SELECT doc_id, min(attempt) AS attempt, arg_min(v, attempt) AS v FROM a WHERE v % 16 = 5 GROUP BY 1) SELECT doc_id, v::VARCHAR AS value, attempt::BIGINT AS attempt FROM documents LEFT JOIN f USING (doc_id)",
    "subset_sizes": "WITH t AS (SELECT unnest([0, 1, 25, 99999, 100000, 100001, (SELECT count(*) FROM documents) + 1000000])::BIGINT AS total) SELECT total, round_even(total * CASE WHEN total = 100000 THEN 0.25 ELSE 0.1 END::DOUBLE, 0)::BIGINT AS tiny, round_even(total * CASE WHEN total = 100000 THEN 0.5 ELSE 0.4 END::DOUBLE, 0)::BIGINT AS medium FROM t",
    "moved_boxes": "SELECT n_nationkey, least(99, 10 + 2 * n_nationkey)::DOUBLE AS x0, least(49, 20 + n_nationkey)::DOUBLE AS y0, least(99, 70 + 2 * n_nationkey)::DOUBLE AS x2, least(49, 30 + n_nationkey)::DOUBLE AS y2, true AS inverse FROM nation",
    "image_formats": "SELECT doc_id, ['JPEG', 'PNG', 'WEBP', NULL][doc_id % 4 + 1] AS format FROM documents",
    "missing_characters": "SELECT lang AS font, string_agg(CASE WHEN NOT has THEN c ELSE '' END, '' ORDER BY c) AS missing FROM (SELECT lang, c, bool_or(contains(text, c)) AS has FROM documents, (VALUES ('é'), ('è'), ('ñ'), ('ß'), ('ü'), ('ó')) v(c) GROUP BY 1, 2) GROUP BY 1",
    "run_totals": "SELECT count(*) AS total, count(*) FILTER (doc_id % 5 <> 0) AS accepted FROM documents",
    "first_rejected": f"SELECT row_index, page_id FROM {ranking._G} WHERE NOT qa_ok ORDER BY row_index LIMIT 12 OFFSET 12",
    "variant_gates": "SELECT 'variants' AS gate, source AS bucket FROM documents GROUP BY source HAVING count(*) >= 3 AND count(DISTINCT nullif(lang, '')) < 12 UNION ALL SELECT 'variants', lang FROM documents WHERE lang <> 'es' GROUP BY lang HAVING count(DISTINCT nullif(source, '')) < 21",
    "coverage_gates": "SELECT 'zero_coverage' AS gate, dimension || ':' || value AS bucket FROM (VALUES ('lang', 'de'), ('lang', 'it'), ('lang', 'kk'), ('source', 'src1'), ('source', 'src99')) v(dimension, value) WHERE value NOT IN (SELECT lang FROM documents WHERE lang IS NOT NULL UNION SELECT source FROM documents WHERE source IS NOT NULL)",
    "rendering_gates": f"SELECT gate, sum(n)::BIGINT AS n FROM documents JOIN (VALUES {_GATES}) v(kind, gate, n) ON doc_id % {_N} = kind GROUP BY 1",
    "audit_gates": "SELECT 'not_audited' AS gate, doc_id::VARCHAR AS bucket FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "layout_artifacts": "SELECT doc_id, [true, true, true, false, true, false][doc_id % 6 + 1] AS artifact, [false, true, false, true, true, false][doc_id % 6 + 1] AS mixed FROM documents",
    "searched_texts": "SELECT doc_id, 'layout ' || lower(source) || ' tags ' || lower(lang) AS search, doc_id % 3 = 0 OR doc_id % 2 = 0 AS stamped FROM documents",
}
