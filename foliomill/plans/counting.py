"""Queries of the counting operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.functions.text import KAZAKH_SPECIAL, normalized
from foliomill.operators import graph, profile, similarity
from foliomill.plans.tables import read

LETTERS = "éèêçöüäßñíó"
ACCENTED = "áéíóúüñ"


def group_count(s: SparkSession, d: str) -> DataFrame:
    return profile.group_count(read(s, d, "documents"), "lang", "source")


def duplicate_count(s: SparkSession, d: str) -> DataFrame:
    return profile.duplicate_count(read(s, d, "documents"), "text")


def character_counts(s: SparkSession, d: str) -> DataFrame:
    return profile.character_counts(read(s, d, "documents"), "text", LETTERS + KAZAKH_SPECIAL)


def duplicate_groups(s: SparkSession, d: str) -> DataFrame:
    return profile.duplicate_groups(read(s, d, "documents"), "text")


def top_repeated_lines(s: SparkSession, d: str) -> DataFrame:
    return profile.top(profile.lines_of(read(s, d, "documents"), "text"), "line", 20, least=2)


def title_repeats(s: SparkSession, d: str) -> DataFrame:
    return profile.repeats_by(read(s, d, "documents").select("source", F.trim(F.split("text", "\n")[0]).alias("title")), "source", "title")


def field_summary(s: SparkSession, d: str) -> DataFrame:
    found = profile.field_summary(read(s, d, "events"), "event_type", "user_id")
    return found.withColumn("top_values", F.array_join(F.transform("top_values", lambda x: F.concat_ws(":", x["value"].cast("string"), x["n"].cast("string"))), ","))


def entropy(s: SparkSession, d: str) -> DataFrame:
    counts = profile.group_count(read(s, d, "documents"), "lang", "source")
    return profile.entropy(counts, ("source",))


def routed_fields(s: SparkSession, d: str) -> DataFrame:
    x = read(s, d, "events")
    field = profile.routed_field(F.lit(""), F.col("event_type"), F.col("props"))
    by_role = profile.routed_field(F.element_at(F.array(*map(F.lit, ("sender_block", "date", "ref_number", "signature_zone", "other"))), (F.col("user_id") % 5 + 1).cast("int")), F.lit(None).cast("string"), F.col("props"))
    return x.groupBy(F.coalesce(field, F.lit("none")).alias("by_key"), F.coalesce(by_role, F.lit("none")).alias("by_role")).agg(F.count(F.lit(1)).alias("n"))


def paragraph_duplicates(s: SparkSession, d: str) -> DataFrame:
    lines = profile.lines_of(read(s, d, "documents"), "text", longer_than=80)
    exact = profile.duplicate_groups(lines, "line").select(F.lit("exact").alias("mode"), "digest", "n")
    near = profile.duplicate_groups(lines.select(normalized(F.col("line")).alias("line")), "line").select(F.lit("normalized").alias("mode"), "digest", "n")
    return exact.unionByName(near)


def title_violations(s: SparkSession, d: str) -> DataFrame:
    titles = read(s, d, "documents").select("source", normalized(F.split("text", "\n")[0]).alias("title"))
    return profile.repeat_violations(titles, "source", "title")


def record_reuse(s: SparkSession, d: str) -> DataFrame:
    return profile.top(read(s, d, "lineitem"), "l_partkey", 50)


def characters(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    x = profile.characters(read(s, d, "documents"), "text", "lang")
    rank = F.row_number().over(Window.partitionBy("lang", "class").orderBy(F.desc("n"), "character"))
    return x.withColumn("rank", rank).where("rank <= 100")


def letter_bigrams(s: SparkSession, d: str) -> DataFrame:
    return _top_grams(s, d, 2)


def letter_trigrams(s: SparkSession, d: str) -> DataFrame:
    return _top_grams(s, d, 3)


def _top_grams(s: SparkSession, d: str, k: int) -> DataFrame:
    from pyspark.sql import Window

    x = profile.letter_ngrams(read(s, d, "documents"), "text", "lang", k)
    return x.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where("rank <= 50")


def word_cardinality(s: SparkSession, d: str) -> DataFrame:
    return profile.word_cardinality(read(s, d, "documents"), "text", "lang")


def line_patterns(s: SparkSession, d: str) -> DataFrame:
    return profile.line_patterns(read(s, d, "documents"), "text").orderBy(F.desc("n"), "pattern").limit(20)


def near_duplicate_metrics(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    members = graph.labelled(docs.select("doc_id"), similarity.equal_links(docs, "doc_id", F.col("digest")), "doc_id")
    return graph.near_duplicate_metrics(members)


def percentiles(s: SparkSession, d: str) -> DataFrame:
    return profile.percentiles(read(s, d, "events"), "value", "event_type")


RUNS = [(1, 5.0, 900.0, 1000.0, 0.0), (4, 18.0, 950.0, 2500.0, 0.0), (8, 20.0, 990.0, 9000.0, 0.0), (16, 25.0, 990.0, 4000.0, 0.01)]
RUN_SCHEMA = "worker_count int, throughput_pages_per_sec double, p95_latency_sec double, peak_rss_mb double, failure_rate double"


def best_run(s: SparkSession, d: str) -> DataFrame:
    return profile.best_run(s.createDataFrame(RUNS, RUN_SCHEMA))


def ratio_gate(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents")
    return profile.ratio_gate(docs, F.contains("text", F.lit("Licensed")), F.col("lang") == "fr", 50, 10, 0.10, 0.20)


def character_coverage(s: SparkSession, d: str) -> DataFrame:
    return profile.character_coverage(read(s, d, "documents").where("lang = 'es'"), "text", ACCENTED)


def release_summary(s: SparkSession, d: str) -> DataFrame:
    from foliomill.operators.release import summary

    return summary(read(s, d, "documents").select(F.col("source").alias("layout_id"), F.col("lang").alias("language_mix")))


def page_duplicates(s: SparkSession, d: str) -> DataFrame:
    x = profile.lines_of(read(s, d, "documents"), "text", "doc_id", longer_than=32)
    return x.groupBy("doc_id", "line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def event_counts(s: SparkSession, d: str) -> DataFrame:
    """Partial counts by hour, merged: the shape of per-shard counters."""
    hourly = read(s, d, "events").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return hourly.groupBy("event_type").agg(F.sum("n").alias("n"), F.max("n").alias("busiest"))


QUERIES = {
    f.__name__: f
    for f in (
        group_count, duplicate_count, character_counts, duplicate_groups, top_repeated_lines, title_repeats, field_summary, entropy, routed_fields, paragraph_duplicates, title_violations, record_reuse,
        characters, letter_bigrams, letter_trigrams, word_cardinality, line_patterns, near_duplicate_metrics, percentiles, best_run, ratio_gate, character_coverage, release_summary, page_duplicates, event_counts,
    )
}

NORM = r"trim(regexp_replace(regexp_replace(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_\s]', ' ', 'g'), '\s+', ' ', 'g'))"
LINES = "(SELECT doc_id, source, lang, trim(unnest(string_split(text, chr(10)))) AS line FROM documents)"
_chars = lambda letters, where="": ", ".join(f"('{c}')" for c in letters)


def _grams(k: int) -> str:
    return rf"""
WITH r AS (SELECT lang, unnest(regexp_extract_all(text, '\p{{L}}{{{k},}}')) AS run FROM documents),
g AS (SELECT lang, unnest(list_transform(range(1, length(run)::BIGINT - {k - 2}), lambda i: substr(run, i, {k}))) AS gram FROM r),
c AS (SELECT lang, gram, count(*) AS n FROM g GROUP BY ALL)
SELECT * FROM (SELECT lang, gram, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram)::INT AS rank FROM c) WHERE rank <= 50"""


ORACLES = {
    "group_count": "SELECT coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source, count(*) AS n FROM documents GROUP BY 1, 2",
    "duplicate_count": "SELECT (count(text) - count(DISTINCT text))::BIGINT AS duplicates FROM documents",
    "character_counts": f"SELECT c AS character, sum(length(text) - length(replace(text, c, '')))::BIGINT AS n FROM documents, (VALUES {_chars(LETTERS + KAZAKH_SPECIAL)}) v(c) GROUP BY c HAVING n > 0",
    "duplicate_groups": "SELECT sha256(text) AS digest, count(*) AS n, count(*) - 1 AS excess FROM documents WHERE trim(text) <> '' GROUP BY 1 HAVING count(*) > 1",
    "top_repeated_lines": f"SELECT line, count(*) AS n FROM {LINES} WHERE length(line) > 0 GROUP BY line HAVING count(*) >= 2 ORDER BY n DESC, line LIMIT 20",
    "title_repeats": "SELECT source, sum(n - 1)::BIGINT AS repeats FROM (SELECT source, trim(string_split(text, chr(10))[1]) AS title, count(*) AS n FROM documents GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY source",
    "field_summary": """WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2)
SELECT event_type, sum(n)::BIGINT AS total, count(*) AS distinct_values, round(count(*)::DOUBLE / sum(n), 4) AS unique_ratio, round(log2(sum(n)::DOUBLE) - sum(n * log2(n)) / sum(n), 4) AS entropy,
  string_agg(user_id || ':' || n, ',' ORDER BY place) FILTER (place <= 5) AS top_values FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) AS place FROM c) GROUP BY 1""",
    "entropy": """WITH c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT source, abs(round(log2(sum(n)::DOUBLE) - sum(n * log2(n)) / sum(n), 4)) AS entropy, round(pow(2.0::DOUBLE, abs(round(log2(sum(n)::DOUBLE) - sum(n * log2(n)) / sum(n), 4))), 4) AS effective FROM c GROUP BY 1""",
    "routed_fields": """SELECT coalesce(CASE WHEN contains(event_type, 'status') THEN NULL WHEN contains(event_type, 'name') OR event_type = 'applicant' THEN 'person_name' WHEN regexp_matches(event_type, 'organization|company') THEN 'organization'
 WHEN contains(event_type, 'department') OR event_type = 'office' THEN 'department' WHEN contains(event_type, 'address') THEN 'address' WHEN regexp_matches(event_type, 'subject|topic') OR event_type IN ('request_type', 'request_summary') THEN 'subject'
 WHEN regexp_matches(event_type, 'number|id') THEN 'document_number' WHEN contains(event_type, 'date') THEN 'date' WHEN contains(event_type, 'note') OR length(props) > 40 THEN 'long_note' END, 'none') AS by_key,
 ['organization', 'date', 'document_number', 'person_name', 'none'][user_id % 5 + 1] AS by_role, count(*) AS n FROM events GROUP BY 1, 2""",
    "paragraph_duplicates": f"""WITH l AS (SELECT line FROM {LINES} WHERE length(line) > 80)
SELECT 'exact' AS mode, sha256(line) AS digest, count(*) AS n FROM l GROUP BY 2 HAVING count(*) > 1 UNION ALL
SELECT 'normalized', sha256(v), count(*) FROM (SELECT {NORM.format('line')} AS v FROM l) WHERE v <> '' GROUP BY 2 HAVING count(*) > 1""",
    "title_violations": f"""WITH t AS (SELECT source, {NORM.format('string_split(text, chr(10))[1]')} AS title FROM documents), a AS (SELECT count(*) AS total FROM t)
SELECT source, title, count(*) AS n, round(count(*)::DOUBLE / any_value(total), 4) AS ratio FROM t, a GROUP BY 1, 2 HAVING count(*) > 3 OR count(*)::DOUBLE / any_value(total) > 0.05""",
    "record_reuse": "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 50",
    "characters": r"""WITH c AS (SELECT lang, unnest(string_split(text, '')) AS character FROM documents), n AS (SELECT lang, character, count(*) AS n FROM c WHERE character <> '' GROUP BY ALL),
k AS (SELECT *, CASE WHEN regexp_matches(character, '^\p{Lu}$') THEN 'upper' WHEN regexp_matches(character, '^\p{L}$') THEN 'lower' ELSE 'other' END AS class FROM n)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, class ORDER BY n DESC, character)::INT AS rank FROM k) WHERE rank <= 100""",
    "letter_bigrams": _grams(2),
    "letter_trigrams": _grams(3),
    "word_cardinality": r"""WITH w AS (SELECT lang, lower(regexp_replace(unnest(regexp_split_to_array(text, '\s+')), '[^\p{L}\p{M}\p{N}_]', '', 'g')) AS word FROM documents)
SELECT lang, count(*) AS total_words, count(DISTINCT word) AS unique_words, round(count(DISTINCT word)::DOUBLE / count(*), 4) AS ratio FROM w WHERE word <> '' GROUP BY lang""",
    "line_patterns": """SELECT pattern, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(unnest(string_split(text, chr(10))), '[0-9]', '0', 'g'), '[A-Za-zА-Яа-яӘәҒғҚқҢңӨөҰұҮүҺһІі]', 'A', 'g') AS pattern FROM documents)
WHERE pattern <> '' GROUP BY 1 ORDER BY n DESC, pattern LIMIT 20""",
    "near_duplicate_metrics": """WITH s AS (SELECT count(*) AS size FROM documents GROUP BY text)
SELECT count(*) FILTER (size > 1) AS clusters, coalesce(sum(size - 1) FILTER (size > 1), 0)::BIGINT AS excess, coalesce(sum(size) FILTER (size > 1), 0)::BIGINT AS involved, round(coalesce(sum(size) FILTER (size > 1), 0)::DOUBLE / sum(size), 6) AS rate, max(size) AS largest FROM s""",
    "percentiles": "SELECT event_type, count(value) AS n, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY 1",
    "best_run": """WITH r(worker_count, throughput_pages_per_sec, p95_latency_sec, peak_rss_mb, failure_rate) AS (VALUES (1, 5.0::DOUBLE, 900.0::DOUBLE, 1000.0::DOUBLE, 0.0::DOUBLE), (4, 18.0, 950.0, 2500.0, 0.0), (8, 20.0, 990.0, 9000.0, 0.0), (16, 25.0, 990.0, 4000.0, 0.01)),
c AS (SELECT * FROM r WHERE failure_rate = 0 OR NOT EXISTS (SELECT 1 FROM r WHERE failure_rate = 0))
SELECT * FROM c WHERE peak_rss_mb <= (SELECT greatest(4096, 2 * min(peak_rss_mb)) FROM c) ORDER BY throughput_pages_per_sec DESC, p95_latency_sec, peak_rss_mb, worker_count LIMIT 1""",
    "ratio_gate": """WITH g AS (SELECT count(*) AS rows, count(*) FILTER (lang = 'fr') AS over, avg(contains(text, 'Licensed')::INT::DOUBLE) AS share, avg(contains(text, 'Licensed')::INT::DOUBLE) FILTER (lang = 'fr') AS share_over FROM documents)
SELECT *, rows < 50 OR (share <= 0.10 AND (over < 10 OR share_over <= 0.20)) AS passed FROM g""",
    "character_coverage": f"""WITH c AS (SELECT c AS character, sum(length(text) - length(replace(text, c, '')))::BIGINT AS n, count(*) AS rows FROM documents, (VALUES {_chars(ACCENTED)}) v(c) WHERE lang = 'es' GROUP BY c)
SELECT rows, character, n, greatest(3, ceil(rows * 0.04))::BIGINT AS needed, rows < 100 OR n >= greatest(3, ceil(rows * 0.04)) AS passed FROM c""",
    "release_summary": "SELECT 'layout_id' AS field, source AS value, count(*) AS n FROM documents GROUP BY 2 UNION ALL SELECT 'language_mix', lang, count(*) FROM documents GROUP BY 2",
    "page_duplicates": f"SELECT doc_id, line, count(*) AS n FROM {LINES} WHERE length(line) > 32 GROUP BY 1, 2 HAVING count(*) > 1",
    "event_counts": "SELECT event_type, sum(n)::BIGINT AS n, max(n) AS busiest FROM (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1",
}
