"""Queries of joins, set operators, duplicates, components and distributions over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions import text as T
from foliomill.functions.hashing import simhash
from foliomill.operators import distribution, graph, relate, similarity
from foliomill.plans.counting import NORM
from foliomill.plans.tables import labelled_documents, read

LANG_TARGETS = [("de", 0.15), ("en", 0.6), ("es", 0.1), ("fr", 0.15)]
SOURCE_TARGETS = [(f"src{k}", 0.05) for k in range(20)]
QUALITY_SHARES = {"0": 0.05, "1": 0.35, "unknown": 0.6}

def unlabelled(s: SparkSession, d: str) -> DataFrame:
    return relate.unmatched(read(s, d, "documents").select("doc_id", "lang"), read(s, d, "labels"), ["doc_id"])


def matched_in_order(s: SparkSession, d: str) -> DataFrame:
    orders = read(s, d, "orders").select("o_orderkey", "o_orderpriority").withColumnRenamed("o_orderkey", "l_orderkey")
    lines = read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    x = relate.matched_in_order(lines, orders, ["l_orderkey"], "l_orderkey", "l_linenumber", ["l_returnflag", "o_orderpriority"])
    return x.select("l_orderkey", F.array_join(F.transform("pairs", lambda p: F.concat_ws(":", p["l_linenumber"].cast("string"), p["l_returnflag"], p["o_orderpriority"])), ",").alias("pairs"))


def defaulted_arrays(s: SparkSession, d: str) -> DataFrame:
    """Turns by document number: none for most documents, whose conversations don't exist; and by all conversations."""
    turns = read(s, d, "conversations").where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    ids = read(s, d, "documents").select(F.col("doc_id").alias("conv_id")).union(turns.select("conv_id")).distinct()
    return relate.with_default_array(ids, turns, "conv_id", "turns").select("conv_id", F.array_join(F.transform("turns", lambda t: t.cast("string")), ",").alias("turns"))


def complete_join(s: SparkSession, d: str) -> DataFrame:
    nation = read(s, d, "nation").select(F.col("n_regionkey").alias("r_regionkey"), "n_name").groupBy("r_regionkey").agg(F.count(F.lit(1)).alias("nations"))
    return relate.complete_join(read(s, d, "region"), nation, "r_regionkey")


def optional_labels(s: SparkSession, d: str) -> DataFrame:
    return labelled_documents(s, d).select("doc_id", "quality")


def _halves(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = read(s, d, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("digest"))
    return docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")


def leakage_pairs(s: SparkSession, d: str) -> DataFrame:
    return relate.leakage(*_halves(s, d), "doc_id", ["digest"])


def leaked_values(s: SparkSession, d: str) -> DataFrame:
    return relate.leaked_values(*_halves(s, d), "doc_id", ["digest", "lang", "source"])


def leakage_of_benchmark(s: SparkSession, d: str) -> DataFrame:
    """Documents and items that share a line, without regard to case and punctuation."""
    lines = lambda t, key: read(s, d, t).select(F.col(key).alias("id"), F.explode(F.split("text", "\n")).alias("line")).select("id", T.normalized(F.col("line")).alias("line")).where("length(line) > 30")
    left, right = lines("documents", "doc_id"), lines("benchmark", "item_id")
    return relate.leakage(left, right, "id", ["line"]).select(F.col("left_id").alias("doc_id"), F.col("right_id").alias("item_id")).distinct()


def linkage(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    links = {"text": F.array(F.sha2("text", 256)), "line": F.filter(F.split("text", "\n"), lambda t: F.length(t) > 120)}
    return graph.labelled(docs.select(F.col("doc_id").alias("id")), graph.linked(relate.linkage_edges(docs, "doc_id", links)), "id")


def existing_files(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select("doc_id", F.concat(F.lit("images/"), "source", F.lit(".png")).alias("path"))
    files = s.createDataFrame([(f"images/src{k}.png",) for k in range(0, 20, 2)], "path string")
    return relate.with_files(rows, "path", files)


def appended_texts(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").select("doc_id", "lang", "text")
    return relate.append_new(docs.where("lang <> 'fr'"), docs.where("lang = 'fr' or doc_id % 3 = 0"), "text").select("doc_id", "lang")


def set_differences(s: SparkSession, d: str) -> DataFrame:
    """Languages and sources of labelled documents against those of the others, with multiplicity."""
    labelled, others = _labelled_and_others(s, d)
    return relate.differences(labelled, others).groupBy("side", "lang", "source").agg(F.count(F.lit(1)).alias("n"))


def shared_values(s: SparkSession, d: str) -> DataFrame:
    labelled, others = _labelled_and_others(s, d)
    return labelled.intersect(others)


def _labelled_and_others(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs, labels = read(s, d, "documents"), read(s, d, "labels")
    return docs.join(labels, "doc_id", "left_semi").select("lang", "source"), docs.join(labels, "doc_id", "left_anti").select("lang", "source")


def similar_documents(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    return similarity.similar_pairs(docs, "doc_id", similarity.similarity_shingles(F.col("text")), 0.85).withColumn("score", F.round("score", 6))


def near_duplicate_clusters(s: SparkSession, d: str) -> DataFrame:
    return similarity.near_duplicate_clusters(read(s, d, "documents"), "doc_id", "text", 0.85)


def band_candidates(s: SparkSession, d: str) -> DataFrame:
    """Pairs of different texts that agree in a band of their 64 minima, confirmed on their token shingles: a pair at 0.85 is missed with chance 7e-6."""
    docs = similarity.one_of_each(read(s, d, "documents"), "doc_id", F.col("text"))
    sets = similarity.token_shingles(F.col("text"))
    return similarity.confirmed_pairs(similarity.band_pairs(similarity.minhash(docs, "doc_id", sets)), docs, "doc_id", sets, 0.85).withColumn("score", F.round("score", 6))


def one_permutation_candidates(s: SparkSession, d: str) -> DataFrame:
    """As band_candidates, with one permutation and word shingles."""
    docs = similarity.one_of_each(read(s, d, "documents"), "doc_id", F.col("text"))
    sets = similarity.candidate_shingles(F.col("text"))
    return similarity.confirmed_pairs(similarity.band_pairs(similarity.one_permutation(docs, "doc_id", sets), 32, 2), docs, "doc_id", sets, 0.85).withColumn("score", F.round("score", 6))


def universal_candidates(s: SparkSession, d: str) -> DataFrame:
    """As band_candidates, with 128 universal hashes modulo a prime."""
    docs = similarity.one_of_each(read(s, d, "documents"), "doc_id", F.col("text"))
    sets = similarity.token_shingles(F.col("text"))
    return similarity.confirmed_pairs(similarity.band_pairs(similarity.universal_minhash(docs, "doc_id", sets), 32, 4), docs, "doc_id", sets, 0.85).withColumn("score", F.round("score", 6))


def _simhashes(s: SparkSession, d: str) -> DataFrame:
    return simhash(read(s, d, "documents").select("doc_id", T.tokens(F.col("text")).alias("words")), "doc_id", "words")


def hamming_pairs(s: SparkSession, d: str) -> DataFrame:
    return similarity.hamming_pairs(_simhashes(s, d), "doc_id", "hash", 3).select("a", "b", F.col("distance").cast("long").alias("distance"))


def hamming_clusters(s: SparkSession, d: str) -> DataFrame:
    return graph.sizes(similarity.hamming_clusters(_simhashes(s, d), "doc_id", "hash", 3))


def shingle_counts(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    text = F.col("text")
    return docs.select("doc_id", F.size(similarity.token_shingles(text)).alias("token5"), F.size(similarity.candidate_shingles(text)).alias("word4"), F.size(similarity.similarity_shingles(text)).alias("masked4"), F.size(T.character_shingles(text)).alias("character5"))


def marginal_audit(s: SparkSession, d: str) -> DataFrame:
    x = distribution.marginal(read(s, d, "documents"), "lang", s.createDataFrame(LANG_TARGETS, "value string, share double"))
    return x.select("value", "actual", *(F.round(c, 6).alias(c) for c in ("share", "expected", "deviation", "relative", "allowed")))


def unknown_values(s: SparkSession, d: str) -> DataFrame:
    return distribution.unknown(read(s, d, "documents"), "source", s.createDataFrame(SOURCE_TARGETS[:15], "value string, share double"))


def shard_drift(s: SparkSession, d: str) -> DataFrame:
    return distribution.drift(read(s, d, "documents").withColumn("shard", F.col("doc_id") % 10), "shard", "lang")


def _joint(s: SparkSession, d: str) -> DataFrame:
    shares = [(src, v, p) for src, _ in SOURCE_TARGETS for v, p in QUALITY_SHARES.items()]
    return distribution.joint(
        labelled_documents(s, d), "source", "lang", "quality", s.createDataFrame(SOURCE_TARGETS, "value string, share double"), s.createDataFrame(LANG_TARGETS, "value string, share double"), s.createDataFrame(shares, "first string, value string, share double")
    )


_ROUNDED = ("expected", "deviation", "relative", "allowed")


def joint_audit(s: SparkSession, d: str) -> DataFrame:
    return _joint(s, d).select("first", "second", "third", "actual", *(F.round(c, 6).alias(c) for c in _ROUNDED))


def family_audit(s: SparkSession, d: str) -> DataFrame:
    family = F.concat(F.lit("family"), (F.substring("first", 4, 10).cast("int") % 4).cast("string"))
    return distribution.rolled_up(_joint(s, d), family).select("first", "second", "third", "actual", *(F.round(c, 6).alias(c) for c in _ROUNDED))


def represented(s: SparkSession, d: str) -> DataFrame:
    x = distribution.ranked(_joint(s, d).withColumn("deviation", F.round("deviation", 6)), 20)
    return x


def gate_violations(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    marginals = distribution.marginal(docs, "lang", s.createDataFrame(LANG_TARGETS, "value string, share double"))
    return distribution.gates(_joint(s, d), marginals, distribution.unknown(docs, "source", s.createDataFrame(SOURCE_TARGETS[:15], "value string, share double")), absent_from=1.0, deviates_from=5.0, share_points=0.001)


def concentration(s: SparkSession, d: str) -> DataFrame:
    return distribution.concentration(read(s, d, "documents").select("source", F.sha2("text", 256).alias("digest")), "source", "digest")


def text_features(s: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return read(s, d, "documents").select(
        "doc_id", F.sha2(T.normalized(t), 256).alias("normalized"), F.size(T.tokens(t)).alias("tokens"), F.round(T.latin_ratio(t), 6).alias("latin"), T.has_any(t, "äöüß").alias("umlauts"),
        F.sha2(T.redacted(t), 256).alias("redacted"), T.safe_path(F.col("source")).alias("safe"), T.shard_of(F.lit(""), F.concat(F.lit("a/shard-"), "source", F.lit("/x.png"))).alias("shard"), T.title_variant(F.col("lang"), F.col("doc_id")).alias("variant"),
    )


FUNCTIONS = (
    unlabelled, matched_in_order, defaulted_arrays, complete_join, optional_labels, leakage_pairs, leaked_values, leakage_of_benchmark, linkage, existing_files, appended_texts, set_differences, shared_values,
    similar_documents, near_duplicate_clusters, band_candidates, one_permutation_candidates, universal_candidates, hamming_pairs, hamming_clusters, shingle_counts, marginal_audit, unknown_values, shard_drift, joint_audit, family_audit,
    represented, gate_violations, concentration, text_features,
)
QUERIES = {f.__name__: f for f in FUNCTIONS}

_values = lambda rows: ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE" for v in r) + ")" for r in rows)
_HALF = "(SELECT doc_id AS id, sha256(text) AS digest, lang, source FROM documents WHERE doc_id % 2 = {0})"
_DEV = "actual - expected AS deviation, CASE WHEN expected > 0 THEN (actual - expected) / expected ELSE 0 END AS relative, CASE WHEN expected > 0 THEN greatest(0.15, 3 / sqrt(expected)) ELSE 0.15 END AS allowed"
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _ROUNDED)
_MASKED = rf"regexp_replace({NORM.format('text')}, '\d+', '<num>', 'g')"


def _shingles(words: str, k: int, joint: str = "' '") -> str:
    return f"list_distinct(list_transform(range(1, greatest(len({words}) - {k - 2}, 2)), lambda i: array_to_string({words}[i:i + {k - 1}], {joint})))"


_SETS = f"d AS (SELECT doc_id, list_filter(string_split({_MASKED}, ' '), lambda w: w <> '') AS w FROM documents), s AS (SELECT doc_id, unnest({_shingles('w', 4)}) AS z FROM d WHERE len(w) > 0), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1)"
_PAIRS = f"{_SETS}, h AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.z = b.z AND a.doc_id < b.doc_id GROUP BY 1, 2), p AS (SELECT a, b, k / (x.n + y.n - k) AS score FROM h JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k / (x.n + y.n - k) >= 0.85)"


def _text_pairs(words: str, k: int, joint: str = "' '") -> str:
    """Pairs of different texts (the first document of each) at 0.85 on shingles of the tokens (a) or of the normalized words (b)."""
    split = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')" if words == "a" else f"list_filter(string_split({NORM.format('text')}, ' '), lambda x: x <> '')"
    return f"""f AS (SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text), d AS (SELECT doc_id, {split} AS w FROM f), s AS (SELECT doc_id, unnest({_shingles('w', k, joint)}) AS z FROM d WHERE len(w) > 0), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
h AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.z = b.z AND a.doc_id < b.doc_id GROUP BY 1, 2)
SELECT a, b, round(k / (x.n + y.n - k), 6) AS score FROM h JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k / (x.n + y.n - k) >= 0.85"""


def _closure(edges: str, nodes: str) -> str:
    return f"""sym AS (SELECT a, b FROM {edges} UNION ALL SELECT b, a FROM {edges}), reach AS (SELECT DISTINCT a AS start, a AS node FROM sym UNION SELECT reach.start, sym.b FROM reach JOIN sym ON sym.a = reach.node),
c AS (SELECT start AS id, min(node) AS component FROM reach GROUP BY 1), members AS (SELECT x.doc_id AS id, coalesce(component, x.doc_id) AS component FROM {nodes} x LEFT JOIN c ON c.id = x.doc_id)"""


_SIMHASH = (
    r"m AS (SELECT doc_id, md5(w) AS h FROM (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'))) AS w FROM documents)), hl AS (SELECT doc_id, ('0x' || substr(h, 1, 8))::BIGINT AS high, ('0x' || substr(h, 9, 8))::BIGINT AS low FROM m), "
    "sh AS (SELECT doc_id, "
    + ", ".join("(" + " + ".join(f"CASE WHEN sum(((({c} >> {k}) & 1) * 2 - 1)) > 0 THEN {1 << k}::BIGINT ELSE 0 END" for k in range(32)) + f") AS {c}" for c in ("high", "low"))
    + " FROM hl GROUP BY doc_id)"
)
_HAMMING = f"{_SIMHASH}, hp AS (SELECT a.doc_id AS a, b.doc_id AS b, (bit_count(xor(a.high, b.high)) + bit_count(xor(a.low, b.low)))::BIGINT AS distance FROM sh a JOIN sh b ON a.doc_id < b.doc_id WHERE bit_count(xor(a.high, b.high)) + bit_count(xor(a.low, b.low)) <= 3)"
_JOINT = f"""l AS (SELECT d.*, coalesce(quality::VARCHAR, 'unknown') AS q FROM documents d LEFT JOIN labels USING (doc_id)), t1(first, p1) AS (VALUES {_values(SOURCE_TARGETS)}), t2(second, p2) AS (VALUES {_values(LANG_TARGETS)}), t3(third, p3) AS (VALUES {_values(QUALITY_SHARES.items())}),
o AS (SELECT source, lang, q, count(*) AS actual FROM l GROUP BY ALL), j AS (SELECT first, second, third, (SELECT count(*) FROM documents) * p1 * p2 * p3 AS expected, coalesce(actual, 0) AS actual FROM t1, t2, t3 LEFT JOIN o ON first = source AND second = lang AND third = q)"""

ORACLES = {
    "unlabelled": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "matched_in_order": "SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag || ':' || o_orderpriority, ',' ORDER BY l_linenumber, l_returnflag, o_orderpriority) AS pairs FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1",
    "defaulted_arrays": "SELECT i AS conv_id, coalesce(string_agg(turn::VARCHAR, ',' ORDER BY turn), '') AS turns FROM (SELECT doc_id AS i FROM documents UNION SELECT conv_id FROM conversations WHERE conv_id IS NOT NULL) LEFT JOIN conversations ON conv_id = i GROUP BY 1",
    "complete_join": "SELECT r_regionkey, r_name, count(*) AS nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY ALL",
    "optional_labels": "SELECT doc_id, coalesce(quality::VARCHAR, 'unknown') AS quality FROM documents LEFT JOIN labels USING (doc_id)",
    "leakage_pairs": f"SELECT 'digest' AS field, digest AS value, a.id AS left_id, b.id AS right_id FROM {_HALF.format(0)} a JOIN {_HALF.format(1)} b USING (digest)",
    "leaked_values": "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS field, count(*) AS shared_values, sum(n * m)::BIGINT AS pairs FROM (SELECT {c}, count(*) AS n FROM {_HALF.format(0)} GROUP BY 1) a JOIN (SELECT {c}, count(*) AS m FROM {_HALF.format(1)} GROUP BY 1) b USING ({c})" for c in ("digest", "lang", "source")) + ") WHERE shared_values > 0",
    "leakage_of_benchmark": f"""WITH a AS (SELECT doc_id, {NORM.format('line')} AS v FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)), b AS (SELECT item_id, {NORM.format('line')} AS v FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS line FROM benchmark))
SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (v) WHERE length(v) > 30""",
    "linkage": f"""WITH RECURSIVE k AS (SELECT doc_id, 'text:' || sha256(text) AS link FROM documents UNION SELECT doc_id, 'line:' || line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(line) > 120),
e AS (SELECT k.doc_id AS a, h.b FROM k JOIN (SELECT link, min(doc_id) AS b FROM k GROUP BY 1) h USING (link) WHERE k.doc_id <> h.b), {_closure('e', 'documents')} SELECT id, component FROM members""",
    "existing_files": "SELECT doc_id, 'images/' || source || '.png' AS path, substr(source, 4)::INT % 2 = 0 AS exists FROM documents",
    "appended_texts": "WITH b AS (SELECT * FROM documents WHERE lang <> 'fr') SELECT doc_id, lang FROM b UNION ALL SELECT doc_id, lang FROM documents WHERE (lang = 'fr' OR doc_id % 3 = 0) AND text NOT IN (SELECT text FROM b)",
    "set_differences": """WITH l AS (SELECT lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)), r AS (SELECT lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
SELECT side, lang, source, count(*) AS n FROM (SELECT 'left' AS side, * FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) UNION ALL SELECT 'right', * FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)) GROUP BY ALL""",
    "shared_values": "SELECT lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels) INTERSECT SELECT lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "similar_documents": f"WITH {_PAIRS}, rep AS (SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, list_sort(list(z)) AS z FROM s GROUP BY 1) GROUP BY z) SELECT a, b, round(score, 6) AS score FROM p WHERE a IN (SELECT doc_id FROM rep) AND b IN (SELECT doc_id FROM rep)",
    "near_duplicate_clusters": f"WITH RECURSIVE {_PAIRS}, {_closure('p', 'documents')} SELECT id AS doc_id, component FROM members",
    "band_candidates": f"WITH {_text_pairs('a', 5, 'chr(31)')}",
    "universal_candidates": f"WITH {_text_pairs('a', 5, 'chr(31)')}",
    "one_permutation_candidates": f"WITH {_text_pairs('b', 4)}",
    "hamming_pairs": f"WITH {_HAMMING}, reps AS (SELECT min(doc_id) AS doc_id FROM sh GROUP BY high, low) SELECT * FROM hp WHERE a IN (SELECT doc_id FROM reps) AND b IN (SELECT doc_id FROM reps)",
    "hamming_clusters": f"WITH RECURSIVE {_HAMMING}, {_closure('hp', 'sh')} SELECT component, count(*) AS size FROM members GROUP BY 1",
    "shingle_counts": rf"""WITH w AS (SELECT doc_id, text AS t, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS a, list_filter(string_split({NORM.format('text')}, ' '), lambda x: x <> '') AS b, list_filter(string_split({_MASKED}, ' '), lambda x: x <> '') AS c FROM documents)
SELECT doc_id, CASE WHEN len(a) > 0 THEN len({_shingles('a', 5, 'chr(31)')}) ELSE 0 END::INT AS token5, CASE WHEN len(b) > 0 THEN len({_shingles('b', 4)}) ELSE 0 END::INT AS word4, CASE WHEN len(c) > 0 THEN len({_shingles('c', 4)}) ELSE 0 END::INT AS masked4,
 len(list_distinct(list_transform(range(1, greatest(length(t) - 3, 2)), lambda i: substr(t, i, 5))))::INT AS character5 FROM w""",
    "marginal_audit": f"""WITH t(value, share) AS (VALUES {_values(LANG_TARGETS)}), x AS (SELECT value, share, share * (SELECT count(*) FROM documents) AS expected, coalesce(actual, 0) AS actual FROM t LEFT JOIN (SELECT lang, count(*) AS actual FROM documents GROUP BY 1) ON lang = value),
y AS (SELECT *, {_DEV} FROM x) SELECT value, actual, round(share, 6) AS share, {_ROUND} FROM y""",
    "unknown_values": f"WITH t(value, share) AS (VALUES {_values(SOURCE_TARGETS[:15])}) SELECT source AS value, count(*) AS n FROM documents WHERE source NOT IN (SELECT value FROM t) GROUP BY 1",
    "shard_drift": """WITH s AS (SELECT doc_id % 10 AS shard, count(*)::DOUBLE AS r FROM documents GROUP BY 1), v AS (SELECT lang, count(*)::DOUBLE / (SELECT count(*) FROM documents) AS p FROM documents GROUP BY 1),
c AS (SELECT doc_id % 10 AS shard, lang, count(*) AS n FROM documents GROUP BY 1, 2) SELECT round(max(abs(coalesce(n, 0) / r - p)), 4) AS drift FROM s CROSS JOIN v LEFT JOIN c USING (shard, lang)""",
    "joint_audit": f"WITH {_JOINT}, y AS (SELECT *, {_DEV} FROM j) SELECT first, second, third, actual, {_ROUND} FROM y",
    "family_audit": f"WITH {_JOINT}, f AS (SELECT 'family' || (substr(first, 4)::INT % 4) AS first, second, third, sum(expected) AS expected, sum(actual)::BIGINT AS actual FROM j GROUP BY 1, 2, 3), y AS (SELECT *, {_DEV} FROM f) SELECT first, second, third, actual, {_ROUND} FROM y",
    "represented": f"""WITH {_JOINT}, y AS (SELECT first, second, third, round(actual - expected, 6) AS deviation FROM j)
SELECT * FROM (SELECT *, 'under' AS side FROM y WHERE deviation < 0 ORDER BY deviation, first, second, third LIMIT 20) UNION ALL SELECT * FROM (SELECT *, 'over' AS side FROM y WHERE deviation > 0 ORDER BY deviation DESC, first, second, third LIMIT 20)""",
    "gate_violations": f"""WITH {_JOINT}, y AS (SELECT *, {_DEV} FROM j), t(value, share) AS (VALUES {_values(LANG_TARGETS)}), u(value, share) AS (VALUES {_values(SOURCE_TARGETS[:15])}), n AS (SELECT count(*) AS n FROM documents)
SELECT 'joint_absent' AS gate, first || ' x ' || third || ' x ' || second AS bucket FROM y WHERE expected >= 1 AND actual = 0 UNION ALL SELECT 'joint_deviation', first || ' x ' || third || ' x ' || second FROM y WHERE expected >= 5 AND abs(relative) > allowed
UNION ALL SELECT 'marginal_share', value FROM t, n WHERE abs((SELECT count(*) FROM documents WHERE lang = value) - share * n) / n > 0.001 UNION ALL SELECT DISTINCT 'unknown_value', source FROM documents WHERE source NOT IN (SELECT value FROM u)""",
    "concentration": "SELECT source, max(n) AS largest, sum(n)::BIGINT AS total, round(max(n)::DOUBLE / sum(n), 6) AS concentration FROM (SELECT source, text, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY 1",
    "text_features": rf"""SELECT doc_id, sha256({NORM.format('text')}) AS normalized, len(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'))::INT AS tokens, round(coalesce(len(regexp_extract_all(text, '[A-Za-z]'))::DOUBLE / nullif(len(regexp_extract_all(text, '\p{{L}}')), 0), 0), 6) AS latin,
 regexp_matches(text, '[äöüß]') AS umlauts, sha256(regexp_replace(regexp_replace(text, '\b(?:hf|sk)-[A-Za-z0-9_-]{{12,}}\b', '[REDACTED]', 'g'), '(?i)\b(?:authorization|token|api[_-]?key|secret|password)\b\s*[:=]\s*[^\s,;]+', '[REDACTED]', 'g')) AS redacted,
 true AS safe, 'shard-' || source AS shard, lang || ' · ' || lpad((doc_id + 1)::VARCHAR, 4, '0') AS variant FROM documents""",
}
