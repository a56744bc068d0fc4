"""Five stages over documents: quality, near-duplicates, benchmark leaks, personal data, mixing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns a DataFrame; all but the last return the columns of documents.  Columns beyond
those of documents go through, whatever their names.  Null texts are empty: the first
stage rejects them.  Null and repeated ids: rows are told apart by a stored number, so that each
is judged as a row.  No rows: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.llm import minhash, mixing, pii, templates, weak
from foliomill.llm.common import numbered, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label scorer rejects go. Repeated rows are judged alike."""
    return weak.filtered(docs, weak.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, that with the smallest id; rows without id come last. Blank texts have no duplicates."""
    rows, at = numbered(docs.orderBy(F.col("doc_id").isNull(), "doc_id"))  # in the ids' order, so that the smallest number of a group is its smallest id's
    gone = minhash.near_duplicates(rows, at).where("not kept").select(at).distinct()
    return rows.join(gone.hint("shuffle_hash"), at, "left_anti").select(*(f"`{c}`" for c in docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go, whatever their ids."""
    rows, at = numbered(docs)
    gone = templates.leaks(rows, table(spark, sf_dir, "benchmark"), at).select(at).distinct()
    return rows.join(gone.hint("shuffle_hash"), at, "left_anti").select(*(f"`{c}`" for c in docs.columns))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in all rows; n_chars follows."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: rows of docs, each as often as systematic sampling takes it, numbered in copy_no; what isn't taken is gone."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("mixing", mixing_stage),
]

#: SQL can't express the classifier or the template windows.
ORACLE_SQL = None


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all stages but the last leave of documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = stored(stage(spark, docs, sf_dir), f"stage{k}")
    return docs


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as the mix takes them: their columns and copy_no, one row per copy."""
    return STAGES[-1][1](spark, kept(spark, sf_dir), sf_dir)
