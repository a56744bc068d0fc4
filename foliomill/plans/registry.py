"""Registered queries and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliomill.plans import counting, details, faults, ranking, records, relating

FAMILIES = (counting, relating, ranking, records, faults, details)
QUERIES = {name: query for family in FAMILIES for name, query in family.QUERIES.items()}
ORACLES = {name: sql for family in FAMILIES for name, sql in family.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal text."""
    return counting.duplicate_groups(spark, sf_dir)
