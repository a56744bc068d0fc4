"""Operators against plain Python: graphs, similarity, splits, sampling, files, streams."""

import hashlib
import itertools
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliomill.functions.text import json_structure
from foliomill.functions.unicode import normalize_text
from foliomill.operators import gallery, graph, release, sampling, similarity, splits
from foliomill.plans import ranking, relating
from foliomill.sources import read, write
from foliomill.streaming import incremental


def roots(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_against_union_find(spark):
    r = random.Random(3)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(50)] + [(k, k + 1) for k in range(100, 130)]
    found = {x.id: x.component for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == roots(edges, {n for e in edges for n in e})


def test_hamming_pairs_against_all_pairs(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(12)]
    hashes = [b ^ sum(1 << k for k in r.sample(range(64), r.randrange(6))) for b in base for _ in range(5)]
    signed = [h - 2**64 if h >= 2**63 else h for h in hashes]
    rows = spark.createDataFrame(list(enumerate(signed)), "id long, hash long")
    first = {h: min(i for i, x in enumerate(signed) if x == h) for h in signed}
    want = {(a, b) for a, b in itertools.combinations(sorted(first.values()), 2) if bin(hashes[a] ^ hashes[b]).count("1") <= 3}
    assert {(x.a, x.b) for x in similarity.hamming_pairs(rows, "id", "hash", 3).collect()} == want
    wide = spark.createDataFrame([(i, [h, h]) for i, h in enumerate(signed)], "id long, hash array<long>")
    want = {(a, b) for a, b in itertools.combinations(sorted(first.values()), 2) if 2 * bin(hashes[a] ^ hashes[b]).count("1") <= 4}
    assert {(x.a, x.b) for x in similarity.hamming_pairs_wide(wide, "id", "hash", 4).collect()} == want


def test_one_cluster_of_130_equal_texts(spark):
    rows = spark.createDataFrame([(k, "one two three four five six") for k in range(130)], "id long, text string")
    assert similarity.near_duplicate_clusters(rows, "id", "text").select("component").distinct().count() == 1


def test_bands_find_similar_documents(spark):
    from conftest import SF

    exact = {(r.a, r.b) for r in relating.similar_documents(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {(r.a, r.b) for r in similarity.band_pairs(similarity.minhash(docs, "doc_id", similarity.similarity_shingles(F.col("text")))).collect()}
    assert len(exact - found) <= 0.05 * len(exact)


@pytest.mark.parametrize("n", range(1, 60))
def test_targets(n):
    t = splits.split_targets(n)
    assert sum(t.values()) == n
    assert t["train"] == round(n * 0.9)
    p = splits.proportional_targets(t, n // 2)
    assert sum(p.values()) == n // 2


def test_split_keeps_components_whole(spark):
    rows = [(k, k // 6 if k < 60 else k) for k in range(100)]
    found = splits.assign(spark.createDataFrame(rows, "id long, component long"), "id").collect()
    sizes = {s: sum(r.split == s for r in found) for s in splits.ORDER}
    assert sizes == {"train": 90, "val": 5, "test": 5}
    by = {}
    for r in found:
        by.setdefault(r.component, set()).add(r.split)
    assert all(len(v) == 1 for v in by.values())


def greedy(sizes, targets):
    """One component after the other to the least filled split with room."""
    filled, out = [0, 0, 0], []
    for size in sizes:
        room = [i for i in range(3) if filled[i] + size <= targets[i]]
        i = min(room, key=lambda i: (Fraction(filled[i], targets[i]), i))
        filled[i] += size
        out.append(i)
    return out


def test_places_are_those_of_the_greedy_order():
    r = random.Random(9)
    for _ in range(150):
        targets = tuple(r.choice((0, 7, 40, 90, 333)) for _ in range(3))
        sizes, filled, want = sorted((r.choice((2, 3, 5, 9)) for _ in range(60)), reverse=True), (0, 0, 0), []
        for size in sorted(set(sizes), reverse=True):
            places = splits.Places(size, filled, targets)
            n = min(sizes.count(size), sum(places.room))
            found = [places.split(k) for k in range(n)]
            want += [(size, i) for i in found]
            filled = tuple(f + size * places.taken(i, n) for i, f in enumerate(filled))
            assert filled == tuple(sum(s for s, j in want if j == i) for i in range(3))
        assert [i for _, i in want] == greedy([s for s, _ in want], targets)


def test_audit_floors(spark):
    """Of a large table the rarest variant has its five rows first, and every layout its twenty."""
    rows = [(k, "ab"[k % 2], "rare" if k < 6 else "usual", f"l{k % 7}") for k in range(3000)]
    df = spark.createDataFrame(rows, "id long, layout string, variant string, lang string")
    found = sampling.audit_sample(df, "id", "layout", "variant", ["lang"], 100_000).collect()
    assert len(found) == 500 and len({r.id for r in found}) == 500
    assert {r.id for r in found} >= {0, 1, 2, 3, 4, 5}
    assert sampling.audit_sample(df, "id", "layout", "variant", ["lang"]).count() == 3000


def test_strata_with_nulls(spark):
    rows = [(k, None if k % 3 else "a", k % 2) for k in range(30)]
    found = splits.stratified_rank(spark.createDataFrame(rows, "id long, s string, split long"), "id", ["s"], within=("split",)).collect()
    assert len(found) == 30
    for part in (0, 1):
        assert sorted(r["rank"] for r in found if r.split == part) == list(range(15))


def test_split_is_refused_without_room(spark):
    rows = [(k, k // 50) for k in range(100)]
    with pytest.raises(ValueError, match="no split has room"):
        splits.assign(spark.createDataFrame(rows, "id long, component long"), "id")


def test_round_robin_rank(spark):
    r = random.Random(1)
    rows = [(f"p{k}", r.choice("ab"), r.choice("xyz")) for k in range(40)]
    import hashlib

    queues = {}
    for p, a, b in sorted(rows, key=lambda x: hashlib.sha256(x[0].encode()).hexdigest()):
        queues.setdefault((a, b), []).append(p)
    want = [p for turn in itertools.zip_longest(*(queues[k] for k in sorted(queues))) for p in turn if p]
    found = splits.stratified_rank(spark.createDataFrame(rows, "id string, a string, b string"), "id", ["a", "b"]).orderBy("rank")
    assert [x.id for x in found.collect()] == want


def test_conditional_shares():
    shares = sampling.conditional_shares({"clean": 0.7, "worn": 0.3}, {"book": {"clean": 1.0}}, {"book": 0.4, "form": 0.6})
    first = {"book": 0.4, "form": 0.6}
    for v, want in (("clean", 0.7), ("worn", 0.3)):
        assert sum(first[f] * p for f, x, p in shares if x == v) == pytest.approx(want)


def test_normalize_text():
    assert normalize_text("ﬁne—ÇA  VA?") == "fine ça va"


def test_hashes_of_images():
    gray = np.tile(np.arange(64), (64, 1)) * 3
    assert similarity.difference_hash(gray) == 0
    assert similarity.difference_hash(255 - gray) == 2**64 - 1
    assert bin(similarity.average_hash(gray)).count("1") == 32


def test_files(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{"a": \n')
    assert [r.a for r in read.jsonl_strict(spark, f"file://{tmp_path}/in.jsonl", "a int").collect()] == [1, 2]
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        read.jsonl_strict(spark, f"file://{tmp_path}/bad.jsonl", "a int").collect()
    assert read.jsonl_tolerant(spark, f"file://{tmp_path}/bad.jsonl", "a int").select("a").where("a is not null").collect()[0].a == 1
    assert read.jsonl_guarded(spark, f"file://{tmp_path}/none.jsonl", "a int").count() == 0
    with pytest.raises(ValueError, match="more than 1 rows"):
        read.jsonl_guarded(spark, f"file://{tmp_path}/in.jsonl", "a int", most_rows=1)
    digests = release.file_digests(spark, f"file://{tmp_path}", "*.jsonl")
    assert sorted(r.name for r in digests.collect()) == ["bad.jsonl", "in.jsonl"]
    other = digests.withColumn("digest", F.when(F.col("name") == "in.jsonl", F.lit("x")).otherwise(F.col("digest"))).where("name <> 'bad.jsonl'")
    assert {(r.name, r.problem) for r in release.file_problems(other, digests).collect()} == {("in.jsonl", "digest"), ("bad.jsonl", "unlisted")}
    with pytest.raises(ValueError, match="front matter"):
        read.front_matter("no")
    assert write.shard_range("2-4", 5) == range(2, 5)
    with pytest.raises(ValueError, match="outside"):
        write.shard_range("7", 5)


def test_guards_of_json_lines(spark, tmp_path, monkeypatch):
    nested = lambda n, inner: "{\"a\": " + "[" * n + inner + "]" * n + "}"
    bad = {"deep": nested(32, "1"), "items": '{"a": [' + ",".join("1" * 1 for _ in range(100_001)) + "]}", "object": "[1]", "string": '{"a": ["' + "x" * 40 + '"]}'}
    good = [nested(31, "1"), nested(32, ""), '{"a": ["\\"[[[[", {}, []]}', '{"a": []}']
    monkeypatch.setattr(read, "LONGEST_STRING", 39)
    for name, line in bad.items():
        (tmp_path / name).write_text(line + "\n")
        with pytest.raises(Exception, match="too deep|too many items|no object|string is too long"):
            read.jsonl_guarded(spark, f"file://{tmp_path}/{name}", "a string").collect()
    (tmp_path / "good").write_text("\n".join(good) + "\n")
    assert read.jsonl_guarded(spark, f"file://{tmp_path}/good", "a string").count() == 4
    shapes = spark.createDataFrame([(g,) for g in ('{"a": [1, {"b": "c\\n\\u00e9"}], "d": {}}', "{}", "7")], "j string").select(json_structure(F.col("j")).alias("x")).collect()
    assert [tuple(r.x) for r in shapes] == [(3, 9, 3), (0, 1, 0), (0, 1, 0)]


def test_small_things(spark, tmp_path):
    assert release.canonical_digest({"b": 1, "a": "é", "metrics": 5}) == release.canonical_digest({"a": "é", "b": 1}) == hashlib.sha256('{"a":"é","b":1}'.encode()).hexdigest()
    assert release.run_signature("x", "y") == hashlib.sha256(b"x\ny").hexdigest()
    assert read.run_summary({"total": 3, "accepted": 2, "rejected": 1}, None) == {"total": 3, "accepted": 2, "rejected": 1}
    assert read.run_summary(None, {"counts": {"total": 4}}) == {"total": 4, "accepted": 0, "rejected": 0}
    assert read.front_matter("---\na: 1\n---\ntext") == {"a": 1}
    (tmp_path / "c.json").write_text('{"x": 0.5}')
    assert [tuple(r) for r in read.config_rows(spark, read.config(f"{tmp_path}/c.json")).collect()] == [("x", 0.5)]
    assert [r.path.rsplit("/", 1)[1] for r in read.listing(spark, f"file://{tmp_path}", "*.json").collect()] == ["c.json"]
    (tmp_path / "lines.txt").write_text("жай мәтін\n# no\n\n____\n")
    assert read.phrases(spark, f"file://{tmp_path}/lines.txt").count() == 1
    state = {"mtime": 1, "size": 2}
    assert gallery.is_fresh(state, state, list(gallery.COLUMNS)) and not gallery.is_fresh(state, state | {"size": 3}, list(gallery.COLUMNS))
    rows = spark.createDataFrame([(1, "a", "train"), (2, "a", "val"), (3, "b", "val")], "id long, component string, split string")
    with pytest.raises(ValueError, match="component a"):
        splits.enforce_no_leakage(rows)
    splits.enforce_no_leakage(rows.where("id > 1"))
    assert sampling.paragraphs(spark.range(5), "id", ["one.", "two.", "three."]).where("length(paragraph) > 0").count() == 5
    merged = graph.clusters(graph.components(spark.createDataFrame([(2, 1), (3, 2)], "a long, b long"))).first()
    assert (merged["first"], merged["members"], merged["size"]) == (1, [1, 2, 3], 3)


def test_archives_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(f"p{k}", "train" if k < 7 else "val", b"\x89PNG" + bytes([k]), "{}") for k in range(10)], "page_id string, split string, image binary, json string")
    shards = write.tar_shards(write.sharded(rows, 3, "split", "page_id")).collect()
    assert sorted((r.split, r.shard) for r in shards) == [("train", 0), ("train", 1), ("train", 2), ("val", 0)]
    for r in shards:
        (tmp_path / f"{r.split}-{r.shard}.tar").write_bytes(r.bytes)
    members = read.tar_members(spark, f"file://{tmp_path}")
    assert members.count() == 20
    assert release.archive_problems(members, rows).count() == 0
    assert {(r.page_id, r.problem) for r in release.archive_problems(members.where("member <> 'p3.json'"), rows.where("page_id <> 'p1'")).collect()} == {("p3", "incomplete"), ("p1", "not in the index")}


def test_writes(spark, tmp_path):
    from conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ranked = ranking.nested_subsets(spark, SF).withColumn("subsets", F.split("subsets", ","))
    write.release_indexes(ranked, f"{tmp_path}/index")
    back = spark.read.parquet(f"{tmp_path}/index")
    assert back.where("config = 'all'").count() == docs.count()
    assert back.where("config = 'tiny'").count() == 15
    pages = ranking.pages_of(docs)
    write.export_shard(pages, f"{tmp_path}/shard", "zones", "prompts")
    assert spark.read.json(f"{tmp_path}/shard/zones").count() == docs.count()
    assert set(write.exports(pages)) == {"manifest", "metadata", "zones", "detection", "recognition", "prompts"}


def test_review_log(spark, tmp_path):
    log = spark.createDataFrame([("a", "accepted", "", "1"), ("a", "rejected", "", "2")], "sample_id string, visual_qa_status string, reviewer_note string, reviewed_at string")
    write.reviewed(log, f"{tmp_path}/log")
    assert gallery.latest_reviews(spark.read.json(f"{tmp_path}/log")).first().visual_qa_status == "rejected"
    with pytest.raises(Exception, match="unknown state"):
        write.reviewed(log.withColumn("visual_qa_status", F.lit("?")), f"{tmp_path}/log")


def test_stream_ingest_is_resumable(spark, tmp_path):
    source, target, at = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"
    source.mkdir()
    for k in (1, 2):
        (source / f"{k}.json").write_text(f'{{"a": {k}}}\n')
        incremental.ingest(incremental.shards(spark, str(source), "a int"), str(at), incremental.into_parquet(str(target))).awaitTermination()
    assert sorted(r.a for r in spark.read.parquet(str(target)).collect()) == [1, 2]


def test_stream_first_seen(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"t": "2024-01-01T00:00:00", "x": "a"}\n{"t": "2024-01-01T00:01:00", "x": "a"}\n{"t": "2024-01-01T00:02:00", "x": "b"}\n')
    stream = incremental.first_seen(incremental.shards(spark, str(tmp_path / "in"), "t timestamp, x string"), "x", "t")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.x for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
