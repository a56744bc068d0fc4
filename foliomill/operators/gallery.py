"""The query surface over an index of pages: predicates, pages of results, neighbours, option lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.functions.pages import search_text
from foliomill.functions.text import filled_or_unknown

#: Page sizes that may be asked for, the default, and how many rows a scan reads at most (fixed values).
PAGE_SIZES, DEFAULT_SIZE, SCAN_LIMIT = (12, 24, 48, 96), 24, 100_000
COLUMNS = ("row_index", "id", "page_id", "qa_ok", "language_mix", "layout_id", "effect_profile", "quality_profile", "orientation", "image", "warning_text", "domain_text")


def index(pages: DataFrame, order: str) -> DataFrame:
    """The twelve columns that queries read. row_index numbers the pages in that order."""
    from foliomill.operators.splits import ranked_by

    have = set(pages.columns)
    text = lambda c: filled_or_unknown(F.col(c)) if c in have else F.lit("unknown")
    x = pages.select(
        F.col(order).alias("_order"), F.col("id" if "id" in have else "page_id").alias("id"), "page_id", F.coalesce("qa_ok", F.lit(True)).alias("qa_ok") if "qa_ok" in have else F.lit(True).alias("qa_ok"),
        *(text(c).alias(c) for c in ("language_mix", "layout_id", "effect_profile", "quality_profile", "orientation")), (F.col("image") if "image" in have else F.lit("")).alias("image"),
        (search_text(F.col("qa_issues")) if "qa_issues" in have else F.lit("")).alias("warning_text"), (search_text(F.col("corpus_metadata")) if "corpus_metadata" in have else F.lit("")).alias("domain_text"),
    )
    return ranked_by(x, F.col("_order")).withColumnRenamed("rank", "row_index").select(*COLUMNS)


def predicate(status: str = "", language: str = "", layout: str = "", effect: str = "", quality: str = "", warning: str = "", domain: str = "") -> Column:
    """Conditions that aren't empty, all of them. Text conditions look for a part, without regard to case; % and _ stand for themselves."""
    out = F.lit(True)
    if status == "accepted":
        out = out & F.col("qa_ok")
    elif status == "rejected":
        out = out & ~F.col("qa_ok")
    for column, value in (("language_mix", language), ("layout_id", layout), ("quality_profile", quality)):
        if value:
            out = out & (F.col(column) == value)
    for column, value in (("effect_profile", effect), ("warning_text", warning), ("domain_text", domain)):
        if value:
            out = out & F.contains(F.lower(column), F.lit(value.lower()))
    return out


def page_size(asked: int) -> int:
    return asked if asked in PAGE_SIZES else DEFAULT_SIZE


def page(rows: DataFrame, where: Column, number: int, size: int, order: str = "row_index") -> DataFrame:
    """One page of the rows that qualify, from page 1."""
    size = page_size(size)
    return rows.where(where).orderBy(order).offset((max(number, 1) - 1) * size).limit(size)


def totals(rows: DataFrame, where: Column) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(where, 1)).alias("matching"))


def options(rows: DataFrame, *columns: str) -> DataFrame:
    """Distinct values of each column, for filters."""
    pairs = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns))
    return rows.select(F.inline(pairs)).where("value is not null and value != ''").distinct()


def neighbours(rows: DataFrame, key: str, value, order: str = "row_index") -> DataFrame:
    """A row with the keys of those before and after it; two top-1 searches and no window over all rows."""
    at = rows.where(F.col(key) == value).limit(1)
    here = at.select(F.col(order).alias("_at"), F.col(key).alias("_key"))
    before = rows.join(F.broadcast(here), F.col(order) < F.col("_at")).orderBy(F.desc(order)).limit(1).select("_key", F.col(key).alias("previous"))  # one row
    after = rows.join(F.broadcast(here), F.col(order) > F.col("_at")).orderBy(order).limit(1).select("_key", F.col(key).alias("next"))  # one row
    return at.join(before, F.col(key) == before["_key"], "left").drop("_key").join(after, F.col(key) == after["_key"], "left").drop("_key")


def neighbours_within(rows: DataFrame, by: str, key: str, order: str) -> DataFrame:
    """Every row with the keys before and after it in its group."""
    w = Window.partitionBy(by).orderBy(order)
    return rows.withColumn("previous", F.lag(key).over(w)).withColumn("next", F.lead(key).over(w))


def rejected(rows: DataFrame, reason: str = "") -> DataFrame:
    return rows.where(predicate(status="rejected", warning=reason))


def run_detail(rows: DataFrame, preview: int = 50) -> tuple[DataFrame, DataFrame]:
    """Totals of a run, and its first rows."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("qa_ok"), 1)).alias("accepted")), rows.orderBy("row_index").limit(preview)


def is_fresh(entry: dict, path_state: dict, columns: list[str]) -> bool:
    """Whether an index was made from the file as it is now and has all columns."""
    return all(entry.get(k) == path_state.get(k) for k in ("mtime", "size")) and set(COLUMNS) <= set(columns)


def latest_reviews(log: DataFrame) -> DataFrame:
    """Of an append-only review log the last entry of each sample."""
    return log.groupBy("sample_id").agg(F.max_by(F.struct("visual_qa_status", "reviewer_note", "reviewed_at"), F.struct("reviewed_at", "visual_qa_status", "reviewer_note")).alias("x")).select("sample_id", "x.*")
