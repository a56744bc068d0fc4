"""The test tables, and views of them in the shapes that operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with quality (unknown where there is no label)."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return read(spark, sf_dir, "documents").join(labels, "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit("unknown")))
