"""Plans: what reaches the scan, what is exchanged, and that a common value splits."""

from conftest import SF
from pyspark.sql import functions as F

from foliomill.operators import profile, splits
from foliomill.plans import counting, ranking
from foliomill.storage import stored


def plan(df):
    return df._jdf.queryExecution().toString()


def test_scans_read_only_what_is_asked(spark):
    text = plan(counting.group_count(spark, SF))
    assert "ReadSchema: struct<lang:string,source:string>" in text
    filtered = plan(profile.group_count(spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'fr'"), "source"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]" in filtered


def test_counts_are_combined_before_they_are_moved(spark):
    text = plan(counting.duplicate_groups(spark, SF))
    assert "partial_count" in text
    assert text.count("Exchange hashpartitioning") <= 3  # the same one in each printed plan


def test_character_counts_make_no_row_for_each_character(spark):
    assert "Generate explode" not in plan(counting.character_counts(spark, SF))


def test_hot_path_has_no_python(spark):
    for name in ("group_count", "characters", "letter_trigrams", "word_cardinality", "stratified_rank", "nested_subsets"):
        query = {**counting.QUERIES, **ranking.QUERIES}[name]
        assert "Python" not in plan(query(spark, SF)) and "ArrowEval" not in plan(query(spark, SF)), name


def test_ranks_use_no_global_window_over_rows(spark):
    ranked = splits.ranked_by(spark.range(1000).withColumn("x", F.col("id") % 7), F.col("x"), F.col("id"))
    assert [r["rank"] for r in ranked.orderBy("x", "id").collect()] == list(range(1000))
    assert "rangepartitioning" not in plan(ranked)  # the sorted table is stored before it is numbered


def test_no_window_holds_a_whole_table(spark):
    """Windows without keys only number the ranges of a sorted table."""
    for name in ("stratified_rank", "nested_subsets", "component_split", "audit_sample", "running_rank"):
        for line in plan(ranking.QUERIES[name](spark, SF)).splitlines():
            if "windowspecdefinition(" in line:
                spec = line.split("windowspecdefinition(", 1)[1]
                assert spec.startswith("_part") or not spec.split(",")[0].rstrip().endswith(("ASC NULLS FIRST", "DESC NULLS LAST")), (name, line)


def test_stored_tables_are_in_the_shared_folder(spark):
    t = stored(spark.range(3), "test")
    assert t.count() == 3
    assert all(spark.conf.get("spark.checkpoint.dir").removeprefix("file://") in f for f in t.inputFiles())
