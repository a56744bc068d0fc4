"""Functions and rules on nested pages."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foliomill.functions import pages as P
from foliomill.functions.geometry import polygons_intersect
from foliomill.operators import distribution, profile, qa, relate
from foliomill.schema import page_schema


def zone(zone_id, zone_type, bbox, text="", **more):
    style = {"font_family": "Serif", "font_size_px": 40, "align": "left"} | more.pop("style", {})
    return {"zone_id": zone_id, "zone_type": zone_type, "bbox": bbox, "text": text, "language": "kk", "reading_order": more.pop("order", 0), "style": style, "lines": [], "cells": [], "metadata": {}} | more


def page(page_id="p1", **more):
    return {
        "page_id": page_id, "layout_id": "other", "language_mix": "kk", "primary_language": "kk", "language_mix_ratio": {"kk": 0.9, "ru": 0.1, "en": 0.0}, "width": 1000, "height": 1000,
        "content_height_ratio": 0.9, "image_path": f"{page_id}.png", "qa_ok": True, "zones": [],
    } | more


def frame(spark, *rows):
    return spark.read.schema(page_schema()).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows]))


def codes(spark, row):
    found = qa.check(frame(spark, row)).select(F.transform("issues", lambda i: i["code"]).alias("c"), "ok").first()
    return sorted(found["c"]), found["ok"]


LINE = {"line_id": "l", "bbox": [10, 10, 200, 40], "text": "бір сөз", "reading_order": 0, "polygon": []}


def test_a_sound_page_passes(spark):
    row = page(zones=[zone("t", "title", [10, 10, 500, 60], "Тақырып", lines=[LINE])])
    assert codes(spark, row) == ([], True)


@pytest.mark.parametrize(
    ("change", "code"),
    [
        ({"zones": []}, "empty_page"),
        ({"zones": [zone("t", "title", [10, 10, 5, 60], "x", lines=[LINE])]}, "invalid_zone_box"),
        ({"zones": [zone("t", "title", [10, 10, 500, 60], "x", lines=[LINE], style={"font_size_px": 10})]}, "tiny_title_font"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], "x", lines=[LINE], style={"align": "justify"})]}, "body_justify"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], "MY ARIZA", lines=[LINE])]}, "latin_fallback_text"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], lines=[LINE | {"text": " "}])]}, "empty_ocr_label"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], lines=[LINE | {"bbox": [10, 10, 12, 11]}])]}, "tiny_ocr_box"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], lines=[LINE | {"polygon": [[0, 0], [1, 1]]}])]}, "invalid_polygon_geometry"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], lines=[LINE]), zone("u", "body", [10, 10, 500, 60], lines=[LINE], order=1)]}, "excessive_overlap"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], lines=[LINE]), zone("u", "body", [10, 100, 500, 160])]}, "invalid_reading_order"),
        ({"zones": [zone("t", "title", [10, 10, 500, 60], "Күні 01.02.2024", lines=[LINE])]}, "title_semantic_mismatch"),
        ({"zones": [zone("s", "signature", [10, 10, 500, 60], lines=[LINE], metadata={"signature_role": "final"})]}, "signature_too_high"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], "сөzдер", lines=[LINE])]}, "latin_confusable_detected"),
        ({"language_mix": "ky", "zones": [zone("t", "body", [10, 10, 500, 60], "қала", lines=[LINE])]}, "unsupported_character_detected"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], "\u0438\u0306", lines=[LINE])]}, "text_not_nfc_normalized"),
        ({"language_mix_ratio": {"kk": 0.5}, "zones": [zone("t", "body", [10, 10, 500, 60], "а", lines=[LINE])]}, "invalid_language_mix_ratio"),
        ({"geometry_tier": "extreme", "zones": [zone("t", "body", [10, 10, 500, 60], "а", polygon=[[1, 1], [2, 1], [2, 2]], lines=[LINE | {"polygon": [[1, 1], [2, 1], [2, 2]]}])]}, "missing_extreme_transform"),
        ({"effect_chain": [{"effect": "x", "warnings": ["stamp_used_default_safe_corner"]}], "zones": [zone("t", "body", [10, 10, 500, 60], "а", lines=[LINE])]}, "effect_safety"),
        ({"artifacts": [{"type": "pen"}], "zones": [zone("t", "body", [10, 10, 500, 60], "а", lines=[LINE])]}, "incomplete_pen_metadata"),
        ({"zones": [zone("t", "body", [10, 10, 500, 60], "а", lines=[LINE], metadata={"text_truncated": True})]}, "rendered_text_truncated"),
    ],
)
def test_one_fault_one_code(spark, change, code):
    found, ok = codes(spark, page(**change))
    assert code in found
    assert ok == (code in ("empty_ocr_label", "tiny_ocr_box", "title_semantic_mismatch", "invalid_language_mix_ratio", "effect_safety"))


def test_every_code_fires(spark):
    """One page for each code, each of which gives just what it should."""
    from foliomill.plans import faults

    rows = [p | {"page_id": str(k)} for k, (_, p) in enumerate(faults.FAULTS)]
    found = {r.page_id: Counter(r.c) for r in qa.check(frame(spark, *rows), faults.RULES).select("page_id", F.transform("issues", lambda i: i["code"]).alias("c")).collect()}
    assert found == {str(k): Counter(codes) for k, (codes, _) in enumerate(faults.FAULTS)}
    assert len({c for codes, _ in faults.FAULTS for c in codes}) == 49


def test_table_faults(spark):
    cell = {"row": 1, "col": 0, "bbox": [20, 20, 120, 60], "text": "толық мәтін", "polygon": [], "metadata": {"rendered_font_size": 12, "rendered_lines": ["толық"], "rendered_text_y": 10, "rendered_line_height": 14}}
    row = page(layout_id="simple_table_page", content_height_ratio=0.1, zones=[zone("title", "title", [10, 900, 500, 960], "Аты", lines=[LINE]), zone("table", "table", [10, 10, 500, 300], order=1, cells=[cell]), zone("note", "body", [10, 400, 500, 500], "қысқа", order=2)])
    found, ok = codes(spark, row)
    assert set(found) == {"table_cell_font_too_small", "table_cell_text_truncated", "rendered_text_outside_cell", "low_table_density", "low_content_height_ratio", "required_zone_sparse"}
    assert not ok


def test_missing_zones_are_named(spark):
    found = qa.check(frame(spark, page(layout_id="memo_page", zones=[zone("title", "title", [10, 10, 500, 60], "Хат", lines=[LINE])]))).select(F.inline("issues")).where("code = 'missing_required_zone'")
    assert sorted(r.zone_id for r in found.collect()) == ["body", "recipient", "sender", "signature", "subject"]


def test_texts_of_pages(spark):
    cells = [{"row": 0, "text": "head"}, {"row": 1, "text": " a "}, {"row": 1, "text": ""}]
    row = page(zones=[zone("h", "header", [0, 0, 1, 1], "skip"), zone("t", "table", [0, 0, 1, 1], "x", cells=cells), zone("b", "body", [0, 0, 1, 1], "one\n\n two", lines=[]), zone("f", "form", [0, 0, 1, 1], "", metadata={"rendered_fields": [{"label_text": "L", "value_text": " v "}]})])
    r = frame(spark, row).select(P.meaningful_segments(F.col("zones")).alias("m"), P.atomic_texts(F.col("zones")).alias("a"), P.row_text(F.col("zones")).alias("t"), P.has_rare(F.col("zones")).alias("rare")).first()
    assert r.m == ["a", "one", "two", "v"]
    assert r.a == ["skip", "head", " a ", "one\n\n two", "L", " v "]
    assert r.t == "skip\nx\none\n\n two\n"
    assert not r.rare


def test_table_rows_and_coverage(spark):
    cells = [{"row": 0, "text": "h"}, {"row": 1, "text": "a"}, {"row": 1, "text": "b"}, {"row": 2, "text": "c"}]
    pages = frame(spark, page(zones=[zone("t", "table", [0, 0, 1, 1], cells=cells)]))
    assert sorted(r.text for r in profile.table_rows(pages).collect()) == ["a | b", "c"]
    assert {(r.dimension, r.value): r.n for r in distribution.coverage(pages).collect()} == {("font_family", "Serif"): 1, ("font_size_bucket", "36-48"): 1, ("text_density", "standard"): 1, ("orientation", "portrait"): 1, ("table_count", "1"): 1}
    assert relate.overlapping_zones(pages).count() == 0


def test_separating_axes(spark):
    square, turned, far = [[0, 0], [2, 0], [2, 2], [0, 2]], [[1, 1], [3, 0.9], [3.1, 3], [1, 3.1]], [[5, 5], [6, 5], [6, 6], [5, 6]]
    df = spark.createDataFrame([(json.dumps(square), json.dumps(turned), json.dumps(far))], "a string, b string, c string").select(*(F.from_json(c, "array<array<double>>").alias(c) for c in "abc"))
    assert tuple(df.select(polygons_intersect(F.col("a"), F.col("b")), polygons_intersect(F.col("a"), F.col("c"))).first()) == (True, False)


def test_empty_table(spark):
    assert qa.check(frame(spark).limit(0)).count() == 0


def test_duplicate_report(spark):
    from foliomill.operators import duplicates

    box = [10, 10, 500, 60]
    text = "алты сөзден тұратын бір ұзын жол осында"
    rows = [page(f"p{k}", zones=[zone("b", "body", box, text)]) for k in range(3)] + [page("q", zones=[zone("b", "body", box, text.upper() + "!")]), page("r", zones=[zone("b", "body", [10, 700, 900, 960], "басқа")]), page("e")]
    pages = frame(spark, *rows)
    found = duplicates.members(pages)
    clusters = {(r["mode"], tuple(r["members"])) for r in duplicates.report(found).collect()}
    assert ("exact_text", ("p0", "p1", "p2")) in clusters
    assert {("normalized_text", ("p0", "p1", "p2", "q")), ("near_text", ("p0", "p1", "p2", "q")), ("structure", ("p0", "p1", "p2", "q")), ("skeleton", ("p0", "p1", "p2", "q")), ("mask", ("p0", "p1", "p2", "q"))} <= clusters
    measured = duplicates.metrics(found, len(rows))
    assert {r.gate for r in duplicates.violations(measured, found, pages).collect()} == {"exact_text", "near_rate"}


def test_pages_that_differ_in_digits_are_near(spark):
    """They have equal sets of shingles, of which only one makes pairs."""
    from foliomill.operators import duplicates

    box = [10, 10, 500, 60]
    pages = frame(spark, *(page(f"p{k}", zones=[zone("b", "body", box, f"алты сөзден тұратын бір ұзын жол {k}")]) for k in range(3)), page("q", zones=[zone("b", "body", box, "басқа")]))
    clusters = {(r["mode"], tuple(r["members"])) for r in duplicates.report(duplicates.members(pages)).collect()}
    assert ("near_text", ("p0", "p1", "p2")) in clusters
    assert not any(mode in ("exact_text", "normalized_text") for mode, _ in clusters)


def test_one_raster_for_equal_boxes(spark):
    """As many rasters as layouts; hashes are those of the pages' own rasters."""
    from foliomill.operators import duplicates, similarity

    zones = [zone("b", "body", [10, 10, 500, 60], "x"), zone("s", "stamp", [600, 700, 800, 900], cells=[{"row": 0, "bbox": [610, 710, 700, 800]}])]
    pages = frame(spark, page("a", zones=zones), page("b", zones=[dict(z, text="y") for z in zones]), page("c", zones=zones[:1]), page("e"))
    layouts = pages.select(F.col("page_id").alias("key"), "width", "height", F.coalesce(duplicates.geometry(F.col("zones")), F.lit("[]")).alias("geometry"))
    assert layouts.select("geometry").distinct().count() == 3
    found = {r.key: r for r in duplicates.raster_hashes(layouts).collect()}
    assert {k: r.skeleton for k, r in found.items()} == {r.page_id: r.hash for r in similarity.skeleton_hashes(pages).collect()}
    for r in pages.collect():
        want = similarity.mask_hash(similarity.skeleton(r.asDict(True)["zones"], r.width or 1, r.height or 1))
        assert found[r.page_id]["mask"] == similarity._words(want, 1024)


def test_hashed_shingles_are_as_many_as_texts(spark):
    from foliomill.operators import similarity

    df = spark.createDataFrame([("a", "b c d e f g"), ("b", "b c d e f g"), ("c", "b b b b b b b"), ("d", "b c"), ("e", "c b"), ("f", ""), ("g", None), ("h", "e d c b f g"), ("i", "x b c d e f y")], "k string, t string")
    hashed = {r.id: r for r in similarity.hashed_shingles(df, "k", F.col("t"), 4).collect()}
    plain = {r.k: set(r.s) for r in df.select("k", similarity.candidate_shingles(F.coalesce("t", F.lit(""))).alias("s")).collect() if r.s}
    assert {k: (r.n, r.s == sorted(set(r.s))) for k, r in hashed.items()} == {k: (len(s), True) for k, s in plain.items()}
    for a in plain:
        for b in plain:
            assert len(set(hashed[a].s) & set(hashed[b].s)) == len(plain[a] & plain[b]), (a, b)
            assert (hashed[a].digest == hashed[b].digest) == (plain[a] == plain[b])


def test_older_manifests(spark):
    x = P.completed(spark.createDataFrame([("p", None, "s")], "page_id string, layout_variant string, stamp_text string")).first()
    assert (x.layout_variant, x.visual_qa_status, x.has_stamp, x.content_record_ids) == ("legacy", "pending_manual", True, [])
    assert P.present(spark.range(1), "id", "x").columns == ["id"]


def test_rejections_and_drawable(spark):
    issues = [{"code": "a", "severity": "error"}, {"code": "b", "severity": "warning"}]
    pages = frame(spark, page(qa_issues=issues, zones=[zone("t", "body", [1, 1, 2, 2]), zone("t", "body", [1, 1, 2, 2]), zone("u", "body", [5, 5, 1, 1]), zone("v", "body", [5, 5, 1, 1], polygon=[[1, 1], [2, 1], [2, 2]])]))
    assert [tuple(r) for r in profile.rejection_reasons(pages).collect()] == [("a", 1)]
    r = qa.drawable(pages).first()
    assert (r.zones, r.repeated, r.valid, r.drawable) == (4, 1, 1, 2)
