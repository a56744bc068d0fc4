"""The registered queries against DuckDB, and the pipeline stage by stage against plain Python."""

import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from conftest import SF, same  # noqa: E402
from test_ten_operators import linked, share_out  # noqa: E402

import corpus_pipeline  # noqa: E402
from foliomill.llm import pii  # noqa: E402
from foliomill.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(name, spark, duck):
    same(QUERIES[name](spark, SF), duck, ORACLES[name])


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [*(f"op{k}" for k in range(1, 11)), "pipeline"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = stage(spark, docs, SF).cache()
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        kept.append((before.count(), docs.count()))
        if k == 0:
            good = {r.doc_id for r in QUERIES["op4_quality_classifier"](spark, SF).where("kept").collect()}
            assert {r.doc_id for r in docs.collect()} == good
        if k == 1:
            found = linked({r.doc_id: r.text for r in before.collect()})
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in found.items() if c == i}
        if k == 2:
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not [r for r in docs.collect() if any(i in r.text for i in items)]
        if k == 3:
            assert all(r.text == pii.redacted(texts[r.doc_id]) and r.n_chars == len(r.text) for r in docs.collect())
            assert not [r for r in docs.collect() if "@" in r.text and pii.find(r.text)]
        if k == 4:
            sizes, taken, longest = Counter(), Counter(), Counter()
            for r in before.collect():
                n = len(r.text.encode().split())
                sizes[r.source] += n
                longest[r.source] = max(longest[r.source], n)
            made = docs.collect()
            for r in made:
                taken[r.source] += len(r.text.encode().split())
            want = share_out(sizes)
            assert all(abs(taken[s] - want[s]) <= longest[s] + 1 for s in sizes)
            times = Counter(r.doc_id for r in made)
            assert {(r.doc_id, r.copy_no) for r in made} == {(i, c + 1) for i, n in times.items() for c in range(n)}
            assert max(times.values()) <= 3 and len(times) < kept[4][0]
            assert all(r.text == texts_now[r.doc_id] for r in made)
        else:
            texts_now = {r.doc_id: r.text for r in docs.collect()}
    assert kept[0][1] < kept[0][0]
    assert kept[1][1] < kept[1][0]
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == [*columns, "copy_no"]
    assert sorted((r.doc_id, r.copy_no) for r in run.collect()) == sorted((r.doc_id, r.copy_no) for r in made)


def test_stages_judge_rows_with_null_and_repeated_ids(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    one, two = (" ".join(f"{c}{k}" for k in range(50)) for c in "pq")
    rows = [(None, one), (7, one), (5, one), (5, one), (5, two), (None, two), (None, "alone"), (3, "only"), (3, "other"), (None, f"See. {item}"), (4, f"So. {item}"), (4, "fine")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert near.columns == docs.columns
    assert sorted(map(tuple, (r for r in near.collect() if item not in r.text)), key=repr) == sorted([(5, one), (5, two), (None, "alone"), (3, "only"), (3, "other"), (4, "fine")], key=repr)
    clean = corpus_pipeline.decontamination_stage(spark, docs, SF)
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted((r for r in rows if item not in r[1]), key=repr)


def test_stages_of_nothing_and_of_other_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wide = docs.limit(40).select("*", *(F.lit(k).alias(n) for k, n in enumerate(("_row", "id", "key", "row", "rank", "size", "n", "kept", "order", "class", "at", "shift"))))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        assert stage(spark, docs.limit(0), SF).count() == 0
        out = stage(spark, wide, SF)
        assert out.count() > 0
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == wide.columns
