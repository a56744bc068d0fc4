"""Queries of splits, ranking, sampling, the query surface and page rules over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions.hashing import bucket, row_seed
from foliomill.operators import duplicates, gallery, graph, qa, relate, sampling, similarity, splits
from foliomill.plans.tables import labelled_documents, read
from foliomill.schema import ZONE

STRATA = ["lang", "source", "quality"]
TIERS = {"clean": 60, "light": 25, "strong": 15}
LAYOUTS = {"book": 0.5, "form": 0.3, "table": 0.2}
FEATURES = [("abbreviation", 0.2), ("field", 0.5), ("table", 0.3)]
EFFECTS = [("blur", 0.1, 1.0), ("fold", 0.3, 3.0), ("noise", 0.5, 2.0), ("stain", 0.2, 5.0)]


def _components(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return graph.labelled(docs.select("doc_id"), similarity.equal_links(docs, "doc_id", F.col("digest")), "doc_id")


def hash_split(s: SparkSession, d: str) -> DataFrame:
    return splits.hash_split(read(s, d, "documents").select("doc_id"), "doc_id")


def component_split(s: SparkSession, d: str) -> DataFrame:
    """Exact 90/5/5 split of copies' components."""
    members = splits.assign(_components(s, d), "doc_id")
    return members.select("doc_id", "component", "split")


def split_sizes(s: SparkSession, d: str) -> DataFrame:
    """Sizes of component_split, and components in more than one split (none)."""
    members = component_split(s, d)
    sizes = members.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return sizes.unionByName(splits.spanning(members, "component", "split").agg(F.lit("leaking").alias("split"), F.count(F.lit(1)).alias("n")))


def split_distribution(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").withColumn("split", F.element_at(F.array(*map(F.lit, ("train", "train", "train", "val", "test"))), (F.col("doc_id") % 5 + 1).cast("int")))
    return splits.distribution(docs, "split", ["lang", "source"])


def split_overlap(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    links = relate.linkage_edges(docs, "doc_id", {"text": F.array(F.sha2("text", 256)), "source": F.array("source")})
    by = docs.select(F.col("doc_id").alias("id"), F.element_at(F.array(*map(F.lit, ("train", "val", "test"))), (F.col("doc_id") % 3 + 1).cast("int")).alias("split"))
    return splits.shared_keys(links, by, "id")


def stratified_rank(s: SparkSession, d: str) -> DataFrame:
    return splits.stratified_rank(labelled_documents(s, d), "doc_id", STRATA).select("doc_id", F.col("rank").cast("long").alias("rank"))


def nested_subsets(s: SparkSession, d: str) -> DataFrame:
    """Ranks within splits, and which subsets each row is in: tiny takes 5 of each split, medium 20."""
    docs = labelled_documents(s, d).withColumn("split", F.element_at(F.array(*map(F.lit, splits.ORDER)), (F.col("doc_id") % 3 + 1).cast("int")))
    ranked = splits.stratified_rank(docs, "doc_id", ["lang", "quality"], within=("split",))
    x = splits.nested_subsets(ranked, {"tiny": dict.fromkeys(splits.ORDER, 5), "medium": dict.fromkeys(splits.ORDER, 20)})
    return x.select("doc_id", "split", "in_tiny", "in_medium", F.array_join("subsets", ",").alias("subsets"))


def audit_sample(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    return sampling.audit_sample(docs, "doc_id", "source", "lang", ["lang"]).select("doc_id", "source")


def weighted_layouts(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    draw = bucket(F.col("doc_id"), 10_000) / F.lit(10_000.0)
    return docs.select("doc_id", sampling.weighted_choice(draw, LAYOUTS).alias("layout"), sampling.by_modulo(F.col("doc_id"), ["portrait", "portrait", "landscape"]).alias("orientation"))


def tiers(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select("doc_id", sampling.tier(F.col("doc_id"), TIERS).alias("tier"), row_seed(7, F.col("doc_id")).cast("string").alias("seed"))


def features(s: SparkSession, d: str) -> DataFrame:
    """Two weighted features for each document without replacement."""
    items = s.createDataFrame(FEATURES, "item string, weight double")
    return sampling.weighted_without_replacement(read(s, d, "documents"), "doc_id", items, "item", "weight", F.lit(2)).select("doc_id", "place", "item")


def effects(s: SparkSession, d: str) -> DataFrame:
    return sampling.optional_effects(read(s, d, "documents"), "doc_id", s.createDataFrame(EFFECTS, "effect string, chance double, weight double"))


def running_rank(s: SparkSession, d: str) -> DataFrame:
    x = sampling.running_rank(read(s, d, "documents").select("doc_id", "lang"), "doc_id", F.col("lang") == "fr")
    return x.select("doc_id", F.col("before").cast("long").alias("before"))


def fallbacks(s: SparkSession, d: str) -> DataFrame:
    """Parts for each customer's nation and segment: of both, else of the nation, else any; how many there are, and the first. Suppliers stand for records, nations for layouts."""
    wanted = read(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("string").alias("layout"), (F.col("c_custkey") % 40).cast("string").alias("domain"))
    corpus = read(s, d, "supplier").where("s_nationkey > 2").select("s_suppkey", F.array(F.col("s_nationkey").cast("string"), F.lit("all")).alias("layouts"), (F.col("s_suppkey") % 40).cast("string").alias("domain")).withColumnRenamed("s_suppkey", "record")
    return sampling.with_fallback(wanted, corpus, "layout", "domain").groupBy("id", "level").agg(F.count(F.lit(1)).alias("records"), F.min("record").alias("first"))


def phrase_pool(s: SparkSession, d: str) -> DataFrame:
    """Lines of the documents in three languages, as often as the pool takes each language; by SHA-256."""
    part = lambda lang: read(s, d, "documents").where(F.col("lang") == lang).select(F.explode(F.split("text", "\n")).alias("phrase"))
    return sampling.phrase_pool(part("de"), part("fr"), part("es"), "phrase").groupBy(F.sha2("phrase", 256).alias("phrase")).agg(F.count(F.lit(1)).alias("n"))


def cells(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "nation").select("n_nationkey", (F.col("n_nationkey") * 13 + 200).alias("width"), (F.col("n_nationkey") % 4 + 1).alias("rows"))
    return sampling.grid(x, "n_nationkey", "width", "rows", [1.0, 2.0, 1.5])


def entity_pool(s: SparkSession, d: str) -> DataFrame:
    return sampling.entity_pool(read(s, d, "nation"), read(s, d, "region"), "n_name", "r_name", 11, 40)


def variants(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select("doc_id", F.when(F.col("lang") == "en", "book").otherwise("form").alias("family"), F.when(F.col("doc_id") % 4 == 0, "landscape").otherwise("portrait").alias("orientation"))
    known = s.createDataFrame([("book", "b1", "portrait"), ("book", "b2", "portrait"), ("form", "f1", "portrait"), ("form", "f2", "landscape"), ("form", "f3", "landscape")], "family string, variant string, orientation string")
    return sampling.variant_of(rows, F.col("doc_id"), known, "family", "orientation").select("doc_id", "variant")


def planned_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages planned for as many documents as there are."""
    return sampling.plan(s, read(s, d, "documents").count(), 3, LAYOUTS, {"kk": 0.5, "ky": 0.5}, {"clean": 0.7, "worn": 0.3})


def _gallery(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    rows = docs.select(F.col("doc_id").cast("string").alias("page_id"), "doc_id", (F.col("doc_id") % 5 != 0).alias("qa_ok"), F.col("lang").alias("language_mix"), F.col("source").alias("layout_id"), F.lit("fold, Stain 10%").alias("effect_profile"))
    return gallery.index(rows, "doc_id")


def gallery_page(s: SparkSession, d: str) -> DataFrame:
    where = gallery.predicate(status="accepted", language="en", effect="stain 10%")
    return gallery.page(_gallery(s, d), where, 3, 24).select("row_index", "page_id", "layout_id")


def gallery_totals(s: SparkSession, d: str) -> DataFrame:
    return gallery.totals(_gallery(s, d), gallery.predicate(status="rejected", layout="src5"))


def gallery_options(s: SparkSession, d: str) -> DataFrame:
    return gallery.options(_gallery(s, d), "language_mix", "layout_id", "quality_profile")


def gallery_neighbours(s: SparkSession, d: str) -> DataFrame:
    return gallery.neighbours(_gallery(s, d), "page_id", "17").select("page_id", "previous", "next")


def neighbours_within(s: SparkSession, d: str) -> DataFrame:
    return gallery.neighbours_within(read(s, d, "documents").select("doc_id", "source"), "source", "doc_id", "doc_id")


def latest_reviews(s: SparkSession, d: str) -> DataFrame:
    log = read(s, d, "events").select(F.col("user_id").cast("string").alias("sample_id"), F.col("event_type").alias("visual_qa_status"), F.col("event_id").cast("string").alias("reviewer_note"), F.col("ts").cast("string").alias("reviewed_at"))
    return gallery.latest_reviews(log)


def first_of_duplicates(s: SparkSession, d: str) -> DataFrame:
    """All rows of a text but the first."""
    from pyspark.sql import Window

    w = Window.partitionBy(F.sha2("text", 256)).orderBy("doc_id")
    return read(s, d, "documents").withColumn("place", F.row_number().over(w)).where("place > 1").select("doc_id", "place")


def pages_of(documents: DataFrame) -> DataFrame:
    """documents as nested pages: each line a zone, the first a title."""
    zone = lambda t, i: F.struct(
        F.concat(F.lit("z"), i.cast("string")).alias("zone_id"), F.when(i == 0, "title").otherwise("body").alias("zone_type"), F.lit("").alias("role"),
        F.array(F.lit(10.0), (i * 20 + 10).cast("double"), F.lit(900.0), (i * 20 + 28).cast("double")).alias("bbox"), F.array().cast("array<array<double>>").alias("polygon"), t.alias("text"), F.lit("kk").alias("language"), i.alias("reading_order"),
    )
    x = documents.select(
        F.col("doc_id").cast("string").alias("page_id"), F.col("source").alias("layout_id"), F.col("lang").alias("language_mix"), F.lit(1000).alias("width"), F.lit(1400).alias("height"),
        F.from_json(F.to_json(F.transform(F.split("text", "\n"), zone)), f"array<{ZONE}>").alias("zones"),
    )
    from foliomill.schema import page_schema

    have = set(x.columns)
    return x.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in page_schema()))


def page_rules(s: SparkSession, d: str) -> DataFrame:
    """Issues by code over documents as pages."""
    checked = qa.check(pages_of(read(s, d, "documents")))
    return qa.issue_rows(checked).groupBy("code", "severity").agg(F.count(F.lit(1)).alias("n"))


def page_boxes(s: SparkSession, d: str) -> DataFrame:
    """Two of the rules, for which SQL is short: zones that leave the page, and titles that hold a date or are sparse."""
    rules = {"invalid_zone_box": qa.invalid_zone_box, "empty_page": qa.empty_page}
    checked = qa.check(pages_of(read(s, d, "documents")), rules)
    return qa.issue_rows(checked, "page_id").groupBy("page_id", "code").agg(F.count(F.lit(1)).alias("n"))


def manifest_problems(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select(F.col("doc_id").cast("string").alias("page_id"), F.sha2("text", 256).alias("image_path"), F.when(F.col("lang") != "es", F.col("source")).alias("layout_id"), F.col("lang").alias("language_mix"), F.lit("x").alias("quality_profile"), (F.col("doc_id") % 7 != 0).alias("qa_ok"), F.array("source").alias("zones"))
    return qa.manifest_problems(rows)


def _page_members(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    pages = pages_of(read(s, d, "documents"))
    return duplicates.members(pages), pages


def duplicate_modes(s: SparkSession, d: str) -> DataFrame:
    """Metrics of duplicate clusters of documents as pages, by mode. Rasters and normal forms are beyond SQL; exact_text_clusters has the part that isn't."""
    found, pages = _page_members(s, d)
    return duplicates.metrics(found, pages.count())


def exact_text_clusters(s: SparkSession, d: str) -> DataFrame:
    """Clusters of equal meaningful text: its lines, trimmed, without blank ones."""
    texts = duplicates.page_texts(pages_of(read(s, d, "documents"))).select(F.col("page_id").cast("long").alias("doc_id"), F.sha2("exact", 256).alias("digest"))
    x = graph.labelled(texts.select("doc_id"), similarity.equal_links(texts, "doc_id", F.col("digest")), "doc_id")
    return graph.clusters(x, "doc_id").select("first", "size", F.array_join(F.transform("members", lambda m: m.cast("string")), ",").alias("members"))


FUNCTIONS = (
    duplicate_modes, exact_text_clusters, hash_split, component_split, split_sizes, split_distribution, split_overlap, stratified_rank, nested_subsets, audit_sample, weighted_layouts, tiers, features, effects, running_rank, fallbacks, phrase_pool, cells,
    entity_pool, variants, planned_pages, gallery_page, gallery_totals, gallery_options, gallery_neighbours, neighbours_within, latest_reviews, first_of_duplicates, page_rules, page_boxes, manifest_problems,
)
QUERIES = {f.__name__: f for f in FUNCTIONS}

_L = "(SELECT d.doc_id, lang, source, coalesce(quality::VARCHAR, 'unknown') AS quality, sha256(d.doc_id::VARCHAR) AS h FROM documents d LEFT JOIN labels USING (doc_id))"
_HEX = "('0x' || substr(sha256({0}), 1, {1}))::BIGINT"
_G = "(SELECT doc_id::VARCHAR AS page_id, doc_id % 5 <> 0 AS qa_ok, lang AS language_mix, source AS layout_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents)"
_UNIT = _HEX.format("{0}", 13) + "::DOUBLE / 4503599627370496.0"

ORACLES = {
    "hash_split": "WITH n AS (SELECT round_even(count(*) * 0.85, 0) AS k FROM documents) SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY sha256(doc_id::VARCHAR), doc_id) <= k THEN 'train' ELSE 'test' END AS split FROM documents, n",
    "split_sizes": "WITH n AS (SELECT count(*) AS n FROM documents), t AS (SELECT n, round_even(n * 0.9, 0)::BIGINT AS a, round_even(n * 0.05, 0)::BIGINT AS b FROM n) SELECT 'train' AS split, a AS n FROM t UNION ALL SELECT 'val', b FROM t UNION ALL SELECT 'test', n - a - b FROM t UNION ALL SELECT 'leaking', 0",
    "split_distribution": " UNION ALL ".join(f"""SELECT '{c}' AS feature, {c} AS value, round(count(*) FILTER (doc_id % 5 <= 2)::DOUBLE / any_value(a), 4) AS train, round(count(*) FILTER (doc_id % 5 = 3)::DOUBLE / any_value(b), 4) AS val, round(count(*) FILTER (doc_id % 5 = 4)::DOUBLE / any_value(c_), 4) AS test
FROM documents, (SELECT count(*) FILTER (doc_id % 5 <= 2) AS a, count(*) FILTER (doc_id % 5 = 3) AS b, count(*) FILTER (doc_id % 5 = 4) AS c_ FROM documents) GROUP BY 2""" for c in ("lang", "source")),
    "split_overlap": """WITH l AS (SELECT DISTINCT 'text' AS kind, text AS v, doc_id % 3 AS s FROM documents UNION SELECT DISTINCT 'source', source, doc_id % 3 FROM documents)
SELECT kind, sum(k * (k - 1) // 2)::BIGINT AS overlap FROM (SELECT kind, v, count(*) AS k FROM l GROUP BY 1, 2) GROUP BY 1""",
    "stratified_rank": f"WITH t AS (SELECT *, row_number() OVER (PARTITION BY lang, source, quality ORDER BY h, doc_id) AS turn FROM {_L}) SELECT doc_id, row_number() OVER (ORDER BY turn, lang, source, quality) - 1 AS rank FROM t",
    "nested_subsets": f"""WITH t AS (SELECT *, ['train', 'val', 'test'][doc_id % 3 + 1] AS split FROM {_L}), u AS (SELECT *, row_number() OVER (PARTITION BY split, lang, quality ORDER BY h, doc_id) AS turn FROM t),
r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY turn, lang, quality) - 1 AS rank FROM u) SELECT doc_id, split, rank < 5 AS in_tiny, rank < 20 AS in_medium, CASE WHEN rank < 5 THEN 'tiny,' ELSE '' END || CASE WHEN rank < 20 THEN 'medium,' ELSE '' END || 'large' AS subsets FROM r""",
    "audit_sample": f"""WITH n AS (SELECT count(*) AS n, CASE WHEN count(*) >= 100000 THEN 500 WHEN count(*) >= 25000 THEN 250 WHEN count(*) >= 10000 THEN 100 ELSE count(*) END AS k FROM documents),
t AS (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY h, doc_id) AS turn FROM {_L}), p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY turn, lang) AS place FROM t),
q AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN n >= 100000 AND (turn <= 5 OR place <= 20) THEN 0 ELSE 1 END, place, source) AS r FROM p, n) SELECT doc_id, source FROM q WHERE r <= k""",
    "component_split": """WITH RECURSIVE n AS (SELECT count(*) AS n, round_even(count(*) * 0.9, 0)::BIGINT AS ta, round_even(count(*) * 0.05, 0)::BIGINT AS tb FROM documents), t AS (SELECT ta, tb, n - ta - tb AS tc FROM n),
comp AS (SELECT min(doc_id) AS component, count(*) AS size, sha256(min(doc_id::VARCHAR)) AS hash FROM documents GROUP BY text), multi AS (SELECT *, row_number() OVER (ORDER BY size DESC, hash) AS k FROM comp WHERE size > 1),
g AS (SELECT 0::BIGINT AS k, 0::BIGINT AS a, 0::BIGINT AS b, 0::BIGINT AS c, NULL::BIGINT AS component, '' AS split UNION ALL
  SELECT k, a + CASE WHEN split = 'train' THEN size ELSE 0 END, b + CASE WHEN split = 'val' THEN size ELSE 0 END, c + CASE WHEN split = 'test' THEN size ELSE 0 END, component, split
  FROM (SELECT mk AS k, a, b, c, size, component, CASE WHEN ra <= rb AND ra <= rc THEN 'train' WHEN rb <= rc THEN 'val' ELSE 'test' END AS split
    FROM (SELECT a, b, c, m.size, m.component, m.k AS mk, CASE WHEN a + size <= ta THEN a / ta ELSE 9 END AS ra, CASE WHEN b + size <= tb THEN b / tb ELSE 9 END AS rb, CASE WHEN c + size <= tc THEN c / tc ELSE 9 END AS rc FROM g JOIN multi m ON m.k = g.k + 1, t) x)),
last AS (SELECT * FROM g ORDER BY k DESC LIMIT 1), one AS (SELECT component, row_number() OVER (ORDER BY hash, component) - 1 AS r FROM comp WHERE size = 1),
placed AS (SELECT component, split FROM g WHERE k > 0 UNION ALL SELECT component, CASE WHEN r < ta - a THEN 'train' WHEN r < ta - a + tb - b THEN 'val' ELSE 'test' END FROM one, t, (SELECT a, b FROM last))
SELECT doc_id, component, split FROM documents JOIN (SELECT text, min(doc_id) AS component FROM documents GROUP BY 1) USING (text) JOIN placed USING (component)""",
    "weighted_layouts": f"WITH b AS (SELECT doc_id, ({_HEX.format('doc_id::VARCHAR', 8)} % 10000) / 10000.0::DOUBLE AS u FROM documents) SELECT doc_id, CASE WHEN u < 0.5 THEN 'book' WHEN u < 0.8 THEN 'form' ELSE 'table' END AS layout, ['portrait', 'portrait', 'landscape'][doc_id % 3 + 1] AS orientation FROM b",
    "tiers": f"WITH b AS (SELECT doc_id, {_HEX.format('doc_id::VARCHAR', 8)} % 100 AS b FROM documents) SELECT doc_id, CASE WHEN b < 60 THEN 'clean' WHEN b < 85 THEN 'light' ELSE 'strong' END AS tier, (('0x' || substr(sha256('7:' || doc_id || ':0'), 1, 16))::UBIGINT)::VARCHAR AS seed FROM b",
    "features": f"""WITH i(item, weight) AS (VALUES {", ".join(f"('{a}', {b}::DOUBLE)" for a, b in FEATURES)}), s AS (SELECT doc_id, item, ln({_UNIT.format("doc_id || ':' || item")} + 1.1102230246251565e-16) / weight AS score FROM documents, i)
SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item)::INT AS place, item FROM s) WHERE place <= 2""",
    "effects": f"""WITH e(effect, chance, weight) AS (VALUES {", ".join(f"('{a}', {b}::DOUBLE, {c}::DOUBLE)" for a, b, c in EFFECTS)}), s AS (SELECT doc_id, effect, weight, {_UNIT.format("doc_id || ':' || effect")} < chance AS drawn FROM documents, e),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY drawn DESC, weight DESC, effect) AS place FROM s) SELECT doc_id, effect, drawn FROM r WHERE drawn OR place <= 3""",
    "running_rank": "SELECT doc_id, coalesce(sum((lang = 'fr')::INT) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM documents",
    "fallbacks": """WITH w AS (SELECT c_custkey AS id, c_nationkey::VARCHAR AS layout, c_custkey % 40 AS domain FROM customer), c AS (SELECT s_suppkey AS record, s_nationkey::VARCHAR AS layout, s_suppkey % 40 AS domain FROM supplier WHERE s_nationkey > 2),
b AS (SELECT layout, domain, count(*) AS n, min(record) AS first FROM c GROUP BY 1, 2), o AS (SELECT layout, count(*) AS n, min(record) AS first FROM c GROUP BY 1), e AS (SELECT count(*) AS n, min(record) AS first FROM c)
SELECT id, CASE WHEN b.n > 0 THEN 'both' WHEN o.n > 0 THEN 'layout' ELSE 'any' END AS level, coalesce(b.n, o.n, e.n) AS records, coalesce(b.first, o.first, e.first) AS first FROM w LEFT JOIN b USING (layout, domain) LEFT JOIN o USING (layout), e""",
    "phrase_pool": "SELECT sha256(phrase) AS phrase, sum(k)::BIGINT AS n FROM (SELECT unnest(string_split(text, chr(10))) AS phrase, CASE WHEN lang = 'es' THEN 1 ELSE 3 END AS k FROM documents WHERE lang IN ('de', 'fr', 'es')) GROUP BY 1",
    "planned_pages": f"""WITH p AS (SELECT 'page_' || lpad(i::VARCHAR, 8, '0') AS page_id, i AS index FROM range(0, (SELECT count(*) FROM documents)) r(i)),
u AS (SELECT *, {", ".join(_UNIT.format(f"'3:' || page_id || ':{n}'") + f" AS {n}" for n in ("layout", "language", "quality", "orientation"))} FROM p)
SELECT page_id, index, CASE WHEN layout < 0.5 THEN 'book' WHEN layout < 0.8 THEN 'form' ELSE 'table' END AS layout_id, CASE WHEN language < 0.5 THEN 'kk' ELSE 'ky' END AS language_mix, CASE WHEN quality < 0.7 THEN 'clean' ELSE 'worn' END AS quality_profile,
  CASE WHEN orientation < 0.1 THEN 'landscape' ELSE 'portrait' END AS orientation FROM u""",
    "cells": """WITH t AS (SELECT n_nationkey, n_nationkey * 13 + 200 AS w, unnest(range(0, n_nationkey % 4 + 1)) AS row FROM nation), e AS (SELECT *, [0, floor(w * (1.0::DOUBLE / 4.5))::INT, floor(w * (3.0::DOUBLE / 4.5))::INT, w] AS x FROM t)
SELECT n_nationkey, row::INT AS row, c::INT AS col, x[c + 1] AS x1, x[c + 2] AS x2 FROM e, (VALUES (0), (1), (2)) v(c)""",
    "entity_pool": "SELECT n_name, r_name FROM nation, region ORDER BY sha256('11:' || n_name || ':' || r_name), n_name, r_name LIMIT 40",
    "variants": "SELECT doc_id, CASE WHEN lang = 'en' THEN ['b1', 'b2'][doc_id % 2 + 1] WHEN doc_id % 4 = 0 THEN ['f2', 'f3'][doc_id % 2 + 1] ELSE 'f1' END AS variant FROM documents",
    "gallery_page": f"SELECT row_index, page_id, layout_id FROM {_G} WHERE qa_ok AND language_mix = 'en' ORDER BY row_index LIMIT 24 OFFSET 48",
    "gallery_totals": f"SELECT count(*) AS total, count(*) FILTER (NOT qa_ok AND layout_id = 'src5') AS matching FROM {_G}",
    "gallery_options": f"SELECT DISTINCT 'language_mix' AS field, language_mix AS value FROM {_G} UNION ALL SELECT DISTINCT 'layout_id', layout_id FROM {_G} UNION ALL SELECT 'quality_profile', 'unknown'",
    "gallery_neighbours": f"SELECT * FROM (SELECT page_id, lag(page_id) OVER (ORDER BY row_index) AS previous, lead(page_id) OVER (ORDER BY row_index) AS next FROM {_G}) WHERE page_id = '17'",
    "neighbours_within": "SELECT doc_id, source, lag(doc_id) OVER w AS previous, lead(doc_id) OVER w AS next FROM documents WINDOW w AS (PARTITION BY source ORDER BY doc_id)",
    "latest_reviews": """SELECT sample_id, visual_qa_status, reviewer_note, reviewed_at FROM (SELECT user_id::VARCHAR AS sample_id, event_type AS visual_qa_status, event_id::VARCHAR AS reviewer_note, ts::VARCHAR AS reviewed_at,
row_number() OVER (PARTITION BY user_id ORDER BY ts::VARCHAR DESC, event_type DESC, event_id::VARCHAR DESC) AS k FROM events) WHERE k = 1""",
    "first_of_duplicates": "SELECT doc_id, place FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id)::INT AS place FROM documents) WHERE place > 1",
    "exact_text_clusters": r"""WITH l AS (SELECT doc_id, generate_subscripts(a, 1) AS i, regexp_replace(unnest(a), '^\s+|\s+$', '', 'g') AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)),
e AS (SELECT doc_id, coalesce(string_agg(t, chr(10) ORDER BY i) FILTER (t <> ''), '') AS e FROM l GROUP BY 1)
SELECT min(doc_id) AS first, count(*)::INT AS size, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS members FROM e GROUP BY e HAVING count(*) > 1""",
    "page_boxes": """WITH z AS (SELECT doc_id, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents)
SELECT doc_id::VARCHAR AS page_id, 'invalid_zone_box' AS code, count(*) AS n FROM z WHERE i * 20 + 28 > 1400 GROUP BY 1 UNION ALL SELECT doc_id::VARCHAR, 'empty_page', 1 FROM documents""",
    "manifest_problems": """WITH p AS (SELECT doc_id::VARCHAR AS row, lang, doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id::VARCHAR) AS k FROM documents)
SELECT row, 'missing layout_id' AS problem FROM p WHERE lang = 'es' UNION ALL SELECT row, 'repeated image' FROM p WHERE k > 1 UNION ALL SELECT row, 'not accepted' FROM p WHERE doc_id % 7 = 0""",
}
