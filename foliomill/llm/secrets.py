"""Secrets by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found in each whole text; their values are hashed; hashes are
counted by distinct owners and repositories over the whole corpus.  A value that
``COPIED_OWNERS`` owners or ``COPIED_REPOS`` repositories hold is a copied example; one that
stays with a single owner, in at most ``LIVE_REPOS`` of its repositories, and looks random is
taken for a live credential; what is in between is shared.

Base kinds: assign, access, hex.  Kinds that the method adds: github, slack,
jwt, pem.  All patterns take time in proportion to the text, whatever it holds.
Null text: no candidates.  A null owner or repository counts as one
owner or repository of its own.  Rows are told apart by a number given when the
candidates are stored, so repeated rows and null ids stay apart.  Other columns of the table don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import split_join, stored

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "slack", "jwt", "pem")

#: Java patterns (fixed values). Of assign, group 2 is the value and has 6 characters at least;
#: a shorter one is dropped and its text stays used up. The others can't match anew in what they drop.
PATTERNS = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "github": r"gh[opsur]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"eyJ[A-Za-z0-9_.-]*[A-Za-z0-9_-]",
    "pem": r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----",
}
#: What a match must also be; one that isn't is dropped, and its text stays used up.
KEEP = {"jwt": r"^eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"}
#: A text without this string has no match.
NEEDS = {"access": "AKIA", "github": "gh", "slack": "xox", "jwt": "eyJ", "pem": "-----BEGIN "}

#: Owners, repositories from which a value counts as copied; repositories that a live one has at most; distinct characters that it has; words of examples.
COPIED_OWNERS, COPIED_REPOS, LIVE_REPOS, LIVE_CHARACTERS, EXAMPLES = 3, 5, 2, 8, r"(?i)example|sample|changeme|placeholder|dummy|redacted|x{4,}|0{6,}|123456"


def _matches(kind: str) -> Column:
    found = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(0))
    return F.when(F.contains("text", F.lit(NEEDS[kind])), found).otherwise(F.array().cast("array<string>")) if kind in NEEDS else found


def _spans(kind: str) -> Column:
    """Structs (start, rank, end, kind, value) of the matches in column m_<kind>."""
    m = F.col(f"m_{kind}")
    values = F.regexp_extract_all("text", F.lit(PATTERNS[kind]), F.lit(2)) if kind == "assign" else m
    rows = F.arrays_zip(
        F.transform(F.slice(F.split("text", PATTERNS[kind], -1), F.lit(1), F.size(m)), F.length).alias("gap"),
        F.transform(m, F.length).alias("length"),
        values.alias("value"),
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (start + x["length"]).alias("end"), F.lit(kind).alias("kind"), x["value"].alias("value"))
        return F.struct((start + x["length"]).alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda acc: acc["spans"])
    if kind in KEEP:
        spans = F.filter(spans, lambda x: x["value"].rlike(KEEP[kind]))
    if kind == "assign":
        spans = F.filter(spans, lambda x: F.length(x["value"]) >= 6)
    return F.when(F.size(m) > 0, spans).otherwise(none)


def _spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per row of df: id, owner, repo, spans (start, rank, end, kind, value) sorted by start, then kind."""
    owner = F.coalesce(F.col(owner_col).cast("string"), F.lit("\0"))
    repo = F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in repo_cols))
    src = df.select(F.col(id_col).cast("long").alias("id"), owner.alias("owner"), repo.alias("repo"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    src = src.select("*", *(_matches(k).alias(f"m_{k}") for k in KINDS))
    return src.select("id", "owner", "repo", F.array_sort(F.concat(*map(_spans, KINDS))).alias("spans")).withColumnRenamed("id", id_col)


def ownership(found: DataFrame) -> DataFrame:
    """By value hash: n_owners, n_repos. Counted in parts before rows are shuffled, so a common value is no hot key."""
    each = found.select("owner", "repo", F.explode("hashes").alias("hash")).groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = each.groupBy("hash", "owner").agg(F.count("one").alias("repos"))
    return owners.groupBy("hash").agg(F.count("repos").alias("n_owners"), F.sum("repos").alias("n_repos"))


def verdicts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per row of df: counts by base kind, SHA-256 of the base spans, all spans, how many values are live, shared or copied,
    and the most owners and repositories that one of its values has (0 without values)."""
    found = candidates(df, id_col, text_col, owner_col, repo_cols)
    base = F.filter("spans", lambda x: x["rank"] < len(BASE))
    looks = F.transform("spans", lambda x: F.struct(F.sha2(x["value"], 256).alias("hash"), ((F.size(F.array_distinct(F.split(x["value"], ""))) >= LIVE_CHARACTERS) & ~x["value"].rlike(EXAMPLES)).alias("random")))
    held = stored(
        found.select(
            F.monotonically_increasing_id().alias("row"), id_col, "owner", "repo", *map(_count, BASE),
            F.sha2(_spelled(base), 256).alias("base_sha256"), _spelled(F.col("spans")).alias("spans"), F.array_distinct(looks).alias("looks"),
        ).withColumn("hashes", F.transform("looks", lambda x: x["hash"])),
        "secrets",
    )
    some = held.where(F.size("looks") > 0)
    values = some.select("row", F.inline("looks"))
    judged = split_join(values, ownership(some), "hash")
    copied = (F.col("n_owners") >= COPIED_OWNERS) | (F.col("n_repos") >= COPIED_REPOS)
    live = (F.col("n_owners") == 1) & (F.col("n_repos") <= LIVE_REPOS) & F.col("random")
    judged = judged.select("row", "n_owners", "n_repos", F.when(copied, "copied").when(live, "live").otherwise("shared").alias("is"))
    counts = judged.groupBy("row").agg(*(F.count(F.when(F.col("is") == k, 1)).alias(f"n_{k}") for k in ("live", "shared", "copied")), F.max("n_owners").alias("most_owners"), F.max("n_repos").alias("most_repos"))
    keep = held.select("row", id_col, *(f"n_{k}" for k in BASE), "base_sha256", "spans")
    return keep.join(counts, "row", "left").select(*keep.columns[1:], *(F.coalesce(k, F.lit(0).cast("long")).alias(k) for k in ("n_live", "n_shared", "n_copied", "most_owners", "most_repos")))
