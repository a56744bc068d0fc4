"""Pages with one fault each, so that every rule code fires; each document of the test tables stands for one of them."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.operators import qa
from foliomill.plans.tables import read
from foliomill.schema import page_schema

LINE = {"line_id": "l", "bbox": [10, 10, 200, 40], "text": "бір сөз", "reading_order": 0, "polygon": []}
BOX, LOW = [10, 10, 500, 60], [10, 900, 500, 960]
SQUARE = [[1, 1], [2, 1], [2, 2]]


def zone(zone_id: str, zone_type: str, bbox: list, text: str = "", order: int = 0, style: dict | None = None, **more) -> dict:
    own = {"font_family": "Serif", "font_size_px": 40, "align": "left"} | (style or {})
    return {"zone_id": zone_id, "zone_type": zone_type, "bbox": bbox, "text": text, "language": "kk", "reading_order": order, "style": own, "lines": [], "cells": [], "metadata": {}} | more


def page(*zones: dict, **more) -> dict:
    return {
        "layout_id": "other", "language_mix": "kk", "primary_language": "kk", "language_mix_ratio": {"kk": 0.9, "ru": 0.1, "en": 0.0}, "width": 1000, "height": 1000,
        "content_height_ratio": 0.9, "image_path": "p.png", "qa_ok": True, "zones": list(zones),
    } | more


def body(text: str = "мәтін", **more) -> dict:
    return zone("t", "body", BOX, text, lines=more.pop("lines", [LINE]), **more)


def cell(**more) -> dict:
    return {"row": 1, "col": 0, "bbox": [20, 20, 120, 60], "text": "толық мәтін", "polygon": [], "metadata": {}} | more


def table(*cells: dict) -> dict:
    return zone("t", "table", [10, 10, 500, 300], cells=list(cells))


def form(*fields: dict, **metadata) -> dict:
    return zone("t", "form", [10, 10, 500, 300], "а: б", lines=[LINE], metadata={"rendered_fields": [{"kind": "field", "rendered_complete": True} | f for f in fields]} | metadata)


MIXED = {"language_mix": "ru_kk", "secondary_language": "ru"}
EYE = [[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]]
TWICE = [[2.0, 0.0, 0.0], [0.0, 2.0, 0.0], [0.0, 0.0, 1.0]]
PEN = {"type": "pen", "color_rgb": [1, 2, 3], "opacity": 0.5, "stroke_width": 1.0, "target_zone": "t", "polygon": SQUARE, "bbox": BOX}

#: What a page must give, by code, and the page.
FAULTS: list[tuple[dict[str, int], dict]] = [
    ({}, page(zone("t", "title", BOX, "Тақырып", lines=[LINE]))),
    ({"missing_required_zone": 5}, page(zone("title", "title", BOX, "Хат мәтіні", lines=[LINE]), layout_id="memo_page")),
    ({"required_zone_empty": 1, "missing_required_zone": 5}, page(zone("title", "title", BOX, " ", lines=[LINE]), layout_id="memo_page")),
    ({"required_zone_sparse": 1, "missing_required_zone": 5}, page(zone("title", "title", BOX, "Ха", lines=[LINE]), layout_id="memo_page")),
    ({"invalid_zone_box": 1}, page(zone("t", "title", [10, 10, 5, 60], "x", lines=[LINE]))),
    ({"invalid_reading_order": 1}, page(body(), zone("u", "body", [10, 100, 500, 160]))),
    ({"body_justify": 1}, page(body(style={"align": "justify"}))),
    ({"tiny_title_font": 1}, page(zone("t", "title", BOX, "Тақырып", style={"font_size_px": 10}, lines=[LINE]))),
    ({"tiny_body_font": 1}, page(body(style={"font_size_px": 10}))),
    ({"table_cell_font_too_small": 1}, page(zone("t", "table", [10, 10, 500, 300], style={"font_size_px": 10}, cells=[cell()]))),
    ({"tiny_metadata_font": 1}, page(zone("t", "header", BOX, "бас", style={"font_size_px": 10}, lines=[LINE]))),
    ({"latin_fallback_text": 1}, page(body("MY ARIZA"))),
    ({"empty_ocr_label": 1}, page(body(lines=[LINE | {"text": " "}]))),
    ({"tiny_ocr_box": 1}, page(body(lines=[LINE | {"bbox": [10, 10, 12, 40]}]))),
    ({"invalid_line_box": 1}, page(body(lines=[LINE | {"bbox": [10, 10, 2000, 40]}]))),
    ({"invalid_polygon_geometry": 1}, page(body(lines=[LINE | {"polygon": [[0, 0], [1, 1]]}]))),
    ({"invalid_table_cell": 1}, page(table(cell(bbox=[600, 20, 700, 60])))),
    ({"table_cell_text_truncated": 1}, page(table(cell(metadata={"rendered_lines": ["толық"]})))),
    ({"excessive_duplicates": 1}, page(body(lines=[LINE | {"text": "ұзын жол " * 5, "bbox": [10, 10 + k, 200, 40 + k]} for k in range(5)]))),
    ({"excessive_overlap": 1}, page(body(), zone("u", "body", BOX, order=1))),
    ({"glyph_intersection_page_boundary": 1}, page(body(metadata={"rendered_bbox": [10, 10, 1010, 60]}))),
    ({"glyph_intersection_rule": 1, "rendered_text_outside_cell": 1}, page(table(cell(metadata={"rendered_bbox": [20, 20, 130, 60]})))),
    ({"glyph_intersection_neighboring_cells": 1}, page(table(cell(metadata={"rendered_bbox": [20, 20, 120, 60]}), cell(col=1, bbox=[100, 20, 220, 60], metadata={"rendered_bbox": [110, 20, 220, 60]})))),
    ({"rendered_text_outside_cell": 1}, page(table(cell(metadata={"rendered_inside_cell": False})))),
    ({"glyph_intersection_label_value": 1, "form_field_overlap": 1}, page(form({"label_bbox": [20, 20, 100, 40], "value_bbox": [90, 20, 200, 40]}))),
    ({"form_field_overlap": 1}, page(form({"label_bbox": [20, 20, 80, 40], "value_bbox": [90, 20, 200, 40], "rendered_complete": False}))),
    ({"title_semantic_mismatch": 1}, page(zone("t", "title", BOX, "Күні 01.02.2024", lines=[LINE]))),
    ({"empty_page": 1}, page()),
    ({"duplicate_structural_date": 1}, page(*(zone(f"d{k}", "body", [10, 10 + 100 * k, 500, 60 + 100 * k], "күні 01.02.2024", order=k, lines=[LINE], metadata={"date_role": "issue"}) for k in range(2)))),
    ({"multiple_final_signatures": 1}, page(*(zone(f"s{k}", "signature", [10 + 400 * k, 900, 300 + 400 * k, 960], order=k, lines=[LINE], metadata={"signature_role": "final"}) for k in range(2)))),
    ({"signature_too_high": 1}, page(zone("s", "signature", BOX, lines=[LINE], metadata={"signature_role": "final"}))),
    ({"low_content_height_ratio": 1, "missing_required_zone": 5}, page(zone("title", "title", BOX, "Хат мәтіні", lines=[LINE]), layout_id="memo_page", content_height_ratio=0.1)),
    ({"rendered_text_truncated": 1}, page(body(metadata={"text_truncated": True}))),
    ({"low_text_density": 1}, page(body("аз"), layout_id="dense_page")),
    ({"low_form_density": 1}, page(*(zone(n, "form" if n == "fields" else "other", [10, 10 + 100 * k, 500, 60 + 100 * k], "а: б", order=k, lines=[LINE], metadata={"rendered_fields": [{"kind": "other"}]} if n == "fields" else {}) for k, n in enumerate(("title", "fields", "date", "signature"))), layout_id="worksheet_page")),
    ({"low_table_density": 1}, page(*(zone(n, "table" if n == "table" else "other", [10, 10 + 200 * k, 500, 200 + 200 * k], "мәтін", order=k, cells=[cell(bbox=[20, 230, 120, 270])] if n == "table" else []) for k, n in enumerate(("title", "table", "note"))), layout_id="syllabus_page")),
    ({"effect_safety": 2}, page(body(), effect_chain=[{"effect": "x", "warnings": ["stamp_used_default_safe_corner", "other"]}])),
    ({"mixed_language_has_no_secondary_content": 1}, page(body(), **MIXED)),
    ({"missing_zone_language_metadata": 1}, page(body(language="ru"), mixing_features=["sentence_level"], **MIXED)),
    ({"declared_mixing_feature_not_present": 1}, page(body(language="ru", metadata={"mixing_feature": "field_level"}), mixing_features=["field_level"], **MIXED)),
    ({"invalid_language_mix_ratio": 1}, page(body(), language_mix_ratio={"kk": 0.5})),
    ({"missing_polygon": 2}, page(body(polygon=[]), geometry_tier="extreme", forward=EYE, inverse=EYE)),
    ({"extreme_geometry_outside_canvas": 1}, page(body(polygon=[[1, 1], [2000, 1], [2, 2]], lines=[LINE | {"polygon": SQUARE}]), geometry_tier="extreme", forward=EYE, inverse=EYE)),
    ({"missing_extreme_transform": 1}, page(body(polygon=SQUARE, lines=[LINE | {"polygon": SQUARE}]), geometry_tier="extreme")),
    ({"invalid_inverse_transform": 1}, page(body(polygon=SQUARE, lines=[LINE | {"polygon": SQUARE}]), geometry_tier="extreme", forward=EYE, inverse=TWICE)),
    ({"incomplete_pen_metadata": 1}, page(body(), artifacts=[{"type": "pen"}])),
    ({"pen_body_crossing_budget": 1}, page(body(), artifacts=[PEN] * 3)),
    ({"latin_confusable_detected": 1}, page(body("сөzдер"))),
    ({"unsupported_character_detected": 1}, page(body("қала"), language_mix="ky")),
    ({"text_not_nfc_normalized": 1}, page(body("\u0438\u0306"))),
]
SAFE = {"empty_ocr_label", "tiny_ocr_box", "title_semantic_mismatch", "invalid_language_mix_ratio", "required_zone_sparse", "excessive_duplicates", "mixed_language_has_no_secondary_content", "missing_zone_language_metadata", "declared_mixing_feature_not_present"}

RULES: dict[str, Callable[[], Column]] = qa.RULES | {"ratios_and_densities": lambda: qa.ratios_and_densities({"dense_page": 20})}


def faulty_pages(s: SparkSession, d: str) -> DataFrame:
    """A page for each document: the document's number tells which."""
    known = s.createDataFrame([(k, json.dumps(p)) for k, (_, p) in enumerate(FAULTS)], "kind long, json string")
    x = read(s, d, "documents").select(F.col("doc_id"), (F.col("doc_id") % len(FAULTS)).alias("kind")).join(F.broadcast(known), "kind")  # as many rows as there are faults
    row = F.from_json("json", page_schema())
    return x.withColumn("p", row).select(*((F.col("doc_id").cast("string") if f.name == "page_id" else F.col(f"p.{f.name}")).alias(f.name) for f in page_schema()))


def rule_codes(s: SparkSession, d: str) -> DataFrame:
    """Issues by code over one page per document, each with one fault."""
    return qa.issue_rows(qa.check(faulty_pages(s, d), RULES)).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def accepted_pages(s: SparkSession, d: str) -> DataFrame:
    """Pages without issues that are errors."""
    return qa.accepted(qa.check(faulty_pages(s, d), RULES)).select("page_id")


QUERIES = {f.__name__: f for f in (rule_codes, accepted_pages)}

_CODES = ", ".join(f"({k}, '{code}', {n})" for k, (codes, _) in enumerate(FAULTS) for code, n in codes.items())
_ACCEPTED = ", ".join(str(k) for k, (codes, _) in enumerate(FAULTS) if set(codes) <= SAFE)
ORACLES = {
    "rule_codes": f"SELECT code, sum(n)::BIGINT AS n FROM documents JOIN (VALUES {_CODES}) v(kind, code, n) ON doc_id % {len(FAULTS)} = kind GROUP BY 1",
    "accepted_pages": f"SELECT doc_id::VARCHAR AS page_id FROM documents WHERE doc_id % {len(FAULTS)} IN ({_ACCEPTED})",
}
