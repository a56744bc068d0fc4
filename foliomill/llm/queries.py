"""The registered queries of the ten operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from foliomill.llm import minhash, mixing, pii, preferences, repeats, secrets, templates, tokens, warc, weak
from foliomill.llm.common import table

TOKENIZERS = os.environ.get("FOLIOMILL_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "piece_bpe_32k.model"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/{VOCABULARY}")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return weak.scored(documents, weak.fit(documents, table(spark, sf_dir, "labels")))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """longest_repeat up to one more than its limit, as in the SQL."""
    found = repeats.quality(table(spark, sf_dir, "documents"))
    return found.withColumn("longest_repeat", F.least("longest_repeat", F.lit(repeats.Limits.longest_repeat + 1).cast("long")))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turns of the prompt, status, SHA-256 of the three texts, masks as text."""
    spelled = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    x = preferences.formatted(preferences.answer_pairs(table(spark, sf_dir, "conversations")))
    return x.select(F.col("id").alias("conv_id"), "prompt_turns", "status", F.sha2("prompt", 256).alias("prompt_sha256"), F.sha2("chosen", 256).alias("chosen_sha256"), F.sha2("rejected", 256).alias("rejected_sha256"), spelled("chosen_mask").alias("chosen_mask"), spelled("rejected_mask").alias("rejected_mask"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.verdicts(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.read(warc.write(table(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sampled(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_pii": op2_pii,
    "op3_token_counts": op3_token_counts,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_quality_rules": op6_quality_rules,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_secrets": op8_secrets,
    "op9_warc": op9_warc,
    "op10_mixing": op10_mixing,
    "pipeline": corpus_pipeline.run,
}

WORD = r"[^\x20\x09-\x0D]+"

_OP5 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS z FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
h AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.z = b.z AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM h JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
sym AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT DISTINCT a AS start, a AS node FROM sym UNION SELECT r.start, sym.b FROM r JOIN sym ON sym.a = r.node),
c AS (SELECT start AS doc_id, min(node) AS component_id FROM r GROUP BY start)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

_LIMITS = repeats.Limits()

_OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS words FROM d),
p AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i, len(words) AS n FROM w),
win AS (SELECT r, i, n, word, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {_LIMITS.base_words - 1} FOLLOWING) AS k,
        list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {_LIMITS.min_words - 1} FOLLOWING) AS short,
        list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND {_LIMITS.longest_repeat} FOLLOWING) AS long FROM p),
twice AS (SELECT r, i, word, count(*) OVER (PARTITION BY r, k) > 1 AND i + {_LIMITS.base_words - 1} <= n AS hit, count(*) OVER (PARTITION BY r, short) > 1 AND i + {_LIMITS.min_words - 1} <= n AS hit_short FROM win),
covered AS (SELECT r, word, max(hit::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {_LIMITS.base_words - 1} PRECEDING AND CURRENT ROW) AS c,
  max(hit_short::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {_LIMITS.min_words - 1} PRECEDING AND CURRENT ROW) AS s FROM twice),
reps AS (SELECT r, sum(c) AS n_repeat_words, sum(s * length(word)) AS n_covered_chars FROM covered GROUP BY r),
sorted AS (SELECT r, long AS a, lead(long) OVER (PARTITION BY r ORDER BY long) AS b FROM win),
longs AS (SELECT r, max(coalesce(nullif(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda x: a[x] <> b[x]), true), 0) - 1, least(len(a), len(b)))) AS longest FROM sorted WHERE b IS NOT NULL GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '{WORD}') GROUP BY r),
x AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
      len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
      coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_covered_chars, 0)::BIGINT AS n_covered_chars, coalesce(longest, 0)::BIGINT AS longest_repeat
      FROM w LEFT JOIN reps USING (r) LEFT JOIN longs USING (r) LEFT JOIN lines USING (r))
SELECT *, n_words < {_LIMITS.fewest_words} OR 100 * n_repeat_words > {_LIMITS.base_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {_LIMITS.fewest_words} OR 100 * n_repeat_words > {_LIMITS.base_repeat_percent} * n_words OR 100 * n_covered_chars > {_LIMITS.covered_percent} * word_chars OR longest_repeat > {_LIMITS.longest_repeat}) AS kept FROM x
"""

_OP7 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
a AS (SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS answer FROM t WHERE role = 'assistant' GROUP BY conv_id),
p AS (SELECT c.conv_id, a.last_turn, b.answer AS other, a.answer FROM (SELECT DISTINCT conv_id FROM t) c LEFT JOIN a USING (conv_id) LEFT JOIN a b ON b.conv_id = xor(c.conv_id, 1::BIGINT)),
s AS (SELECT conv_id, CASE WHEN last_turn IS NULL OR other IS NULL THEN 'no rejected' WHEN answer = other THEN 'equal' ELSE 'pair' END AS status, last_turn, other,
  CASE WHEN last_turn IS NULL OR other IS NULL THEN -9223372036854775808 WHEN answer = other THEN 9223372036854775807 ELSE last_turn END AS cut FROM p),
r AS (SELECT s.conv_id, status, 'chosen' AS side, turn, role, text, turn < cut AS prompt FROM s JOIN t USING (conv_id)
  UNION ALL SELECT s.conv_id, status, 'rejected', turn, role, CASE WHEN turn = last_turn THEN other ELSE text END, turn < cut FROM s JOIN t USING (conv_id) WHERE status <> 'no rejected'),
m AS (SELECT *, '<|im_start|>' || role || chr(10) AS head, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS line FROM r),
o AS (SELECT *, coalesce(sum(length(line)) FILTER (NOT prompt) OVER (PARTITION BY conv_id, side ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM m),
g AS (SELECT conv_id, status, count(*) FILTER (prompt AND side = 'chosen') AS prompt_turns,
  coalesce(string_agg(line, '' ORDER BY turn) FILTER (prompt AND side = 'chosen'), '') AS prompt,
  coalesce(string_agg(line, '' ORDER BY turn) FILTER (NOT prompt AND side = 'chosen'), '') AS chosen,
  coalesce(string_agg(line, '' ORDER BY turn) FILTER (NOT prompt AND side = 'rejected'), '') AS rejected,
  coalesce(string_agg((off + length(head)) || ':' || (off + length(line)), ',' ORDER BY turn) FILTER (NOT prompt AND side = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg((off + length(head)) || ':' || (off + length(line)), ',' ORDER BY turn) FILTER (NOT prompt AND side = 'rejected' AND role = 'assistant'), '') AS rejected_mask
  FROM o GROUP BY conv_id, status)
SELECT conv_id, prompt_turns::INT AS prompt_turns, status, sha256(prompt) AS prompt_sha256, sha256(chosen) AS chosen_sha256,
  CASE WHEN status <> 'no rejected' THEN sha256(rejected) END AS rejected_sha256, chosen_mask, CASE WHEN status <> 'no rejected' THEN rejected_mask END AS rejected_mask FROM g
"""

_ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _op8_kind(rank: int, kind: str) -> str:
    pattern = _ASSIGN if kind == "assign" else secrets.PATTERNS[kind]
    value = f"regexp_extract_all(text, '{pattern}', 2)" if kind == "assign" else "m"
    keep = "WHERE length(value) >= 6" if kind == "assign" else f"WHERE regexp_matches(value, '{secrets.KEEP[kind]}')" if kind in secrets.KEEP else ""
    return f"""SELECT r, {rank} AS rank, '{kind}' AS kind, start, start + length(word) AS "end", value FROM (
  SELECT r, unnest(m) AS word, unnest(v) AS value, unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS start
  FROM (SELECT r, m, {value} AS v, regexp_split_to_array(text, '{pattern}') AS gaps FROM (SELECT *, regexp_extract_all(text, '{pattern}') AS m FROM d) WHERE len(m) > 0)) {keep}"""


_OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(0)) AS owner, coalesce(source, chr(0)) || '/' || coalesce(lang, chr(0)) AS repo, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(_op8_kind(n, k) for n, k in enumerate(secrets.KINDS))}),
held AS (SELECT count(DISTINCT owner) AS owners, count(DISTINCT owner || chr(1) || repo) AS repos, value FROM s JOIN d USING (r) GROUP BY value),
judged AS (SELECT r, owners, repos, CASE WHEN owners >= {secrets.COPIED_OWNERS} OR repos >= {secrets.COPIED_REPOS} THEN 'copied'
    WHEN owners = 1 AND repos <= {secrets.LIVE_REPOS} AND len(list_distinct(string_split(value, ''))) >= {secrets.LIVE_CHARACTERS} AND NOT regexp_matches(value, '{secrets.EXAMPLES}') THEN 'live' ELSE 'shared' END AS is_
  FROM (SELECT DISTINCT r, value FROM s) JOIN held USING (value)),
verdict AS (SELECT r, count(*) FILTER (is_ = 'live') AS n_live, count(*) FILTER (is_ = 'shared') AS n_shared, count(*) FILTER (is_ = 'copied') AS n_copied, max(owners) AS most_owners, max(repos) AS most_repos FROM judged GROUP BY r),
spans AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (rank < {len(secrets.BASE)}) AS base,
  string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared, coalesce(n_copied, 0) AS n_copied, coalesce(most_owners, 0) AS most_owners, coalesce(most_repos, 0) AS most_repos
FROM d LEFT JOIN spans USING (r) LEFT JOIN verdict USING (r)
"""

_OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, payload,
  list_reduce(list_transform(range(0, 8), lambda k: (CAST('0x' || substr(sha1(payload), 5 * k + 1, 5) AS BIGINT)).to_base(32, 4)), lambda a, b: a || b) AS b32 FROM p),
k AS (SELECT payload, max(page_id) AS keep FROM p GROUP BY payload)
SELECT page_id, payload_bytes, translate(b32, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
  CASE WHEN keep IS NULL OR page_id = keep THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM d JOIN k USING (payload)
"""

_OP10 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, chr(0))) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS room FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS weight FROM s),
f AS (SELECT *, room::DOUBLE / weight AS full_at FROM w),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(room) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / sum(weight) OVER (ORDER BY full_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
t AS (SELECT source, source_size, least(room::DOUBLE, (SELECT arg_min(level, full_at) FROM l WHERE level <= full_at) * weight) AS target FROM l),
r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS each_,
  ('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.source, chr(0))), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u,
  row_number() OVER (PARTITION BY d.source ORDER BY size DESC, key, doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (floor(k * each_ + u) - floor((k - 1) * each_ + u))::BIGINT * size AS taken FROM r
"""

ORACLES = {"op5_near_duplicates": _OP5, "op6_quality_rules": _OP6, "op7_chat_formatting": _OP7, "op8_secrets": _OP8, "op9_warc": _OP9, "op10_mixing": _OP10}
