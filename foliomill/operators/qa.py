"""Rules on nested pages. Each rule is one expression that gives an array of issues; a page passes if none is an error.

Rules are declared in RULES; check() puts their arrays together in one projection,
without explode and without shuffle. Missing arrays count as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.geometry import area, box_valid, boxes_intersect, contains, inverse_holds, overlap_ratio, polygon_inside, polygons_intersect
from foliomill.functions.text import KAZAKH_ONLY, canonical_language, dates_in, layout_family, let, mixes_scripts
from foliomill.functions.unicode import nfc
from foliomill.schema import ISSUE

#: Zones that each layout must have (fixed values).
_WORD_LIST = ["title", "range", "entries_left", "entries_right"]
_FORM = ["title", "fields", "date", "signature"]
_TABLE = ["title", "table", "note"]
REQUIRED_ZONES = {
    "official_statement_page": ["recipient", "applicant", "doc_number", "title", "body", "attachment_note", "date", "signature", "stamp_safe"],
    "certificate_page": ["organization", "title", "reference", "recipient", "body", "signature", "stamp_safe"],
    "official_letter_page": ["applicant", "doc_number", "date", "recipient", "title", "body", "attachment_note", "signature", "stamp_safe"],
    "memo_page": ["sender", "recipient", "title", "subject", "body", "signature"],
    "meeting_minutes_page": ["organization", "title", "meeting_metadata", "participants", "agenda", "decisions", "signature"],
    "archival_notice_page": ["archive_code", "title", "catalog_metadata", "body", "archive_footer"],
    "lecture_notes_page": ["course", "title", "outline", "notes", "summary"],
    "bulletin_or_newspaper_page": ["masthead", "issue_metadata", "lead_story", "column_left", "column_right", "footer_note"],
    "historical_newspaper_page": ["masthead", "issue_metadata", "column_1", "column_2", "column_3"],
    "glossary_page": _WORD_LIST,
    "dictionary_entry_page": _WORD_LIST,
    "index_page": _WORD_LIST,
    "simple_form_page": _FORM,
    "application_form_page": _FORM,
    "exam_sheet_page": _FORM,
    "worksheet_page": _FORM,
    "receipt_like_page": _FORM,
    "simple_table_page": _TABLE,
    "registry_extract_page": _TABLE,
    "syllabus_page": _TABLE,
    "catalog_entry_page": _TABLE,
    "invoice_like_page": _TABLE,
    "schedule_table_page": _TABLE,
    "exam_register_page": _TABLE,
    "inventory_sheet_page": _TABLE,
    "attendance_sheet_page": _TABLE,
    "wide_schedule_page": _TABLE,
}

#: Least share of the page's height that content fills, by family of layouts and by layout (fixed values).
FAMILY_HEIGHT_RATIOS = {"form": 0.70, "table": 0.65}
LAYOUT_HEIGHT_RATIOS = {
    "official_statement_page": 0.62,
    "certificate_page": 0.62,
    "official_letter_page": 0.62,
    "memo_page": 0.62,
    "meeting_minutes_page": 0.62,
    "archival_notice_page": 0.62,
}

#: Fixed values.
SAFE_WARNINGS = ("perspective_profile_limited_to_non_geometric_proxy", "stamp_used_default_safe_corner")
LATIN_FALLBACK = ("ARIZA", "OTINISH", "OTUNUCH", "QABYLDANDY", "KABYL", "PRINYATO", "ZAYAVLENIE", "OBRASCHENIE")
ABBREVIATIONS = ("ЖСН / ИИН", "БСН / БИН", "Жеке номер / ИИН", "ID", "QR", "PDF", "GPA")
TITLE_METADATA = r"\b\d{2}\.\d{2}\.\d{4}\b|(?iu:дата выдачи|берилген күн|берілген күні)"
NO_TEXT_ZONES, METADATA_ZONES = ("stamp", "decorative_non_text"), ("header", "footer", "date", "signature", "recipient", "applicant", "doc_number")
LIMITS = {"title_font": 32, "body_font": 20, "table_font": 18, "metadata_font": 16, "box_width": 4, "box_height": 6, "overlap": 0.35, "slack": 3, "signature_from": 0.70, "fields": 15, "cells": 30, "pen_crossings": 2}

Z, NONE = "zones", F"array<{ISSUE}>"


def _none() -> Column:
    return F.array().cast(NONE)


def issue(code: str, severity: str, message: str, zone: Column | None = None) -> Column:
    return F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(message).alias("message"), (F.lit(None).cast("string") if zone is None else zone).alias("zone_id"))


def when(condition: Column, *issues: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.array(*issues)).otherwise(_none())



def per_zone(rule: Callable[[Column], Column], where: Callable[[Column], Column] | None = None) -> Column:
    source = F.col(Z) if where is None else F.filter(F.col(Z), lambda z: F.coalesce(where(z), F.lit(False)))
    return F.coalesce(F.flatten(F.transform(source, rule)), _none())


def per_item(z: Column, field: Column, rule: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.flatten(F.transform(field, rule)), _none())


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text), F.lit("")) == ""


def valid(z: Column) -> Column:
    return box_valid(z["bbox"], F.col("width"), F.col("height"))


def is_type(*types: str) -> Callable[[Column], Column]:
    return lambda z: z["zone_type"].isin(*types)


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def required() -> Column:
    names = F.create_map(*(x for layout, zones in REQUIRED_ZONES.items() for x in (F.lit(layout), F.array(*map(F.lit, zones)))))
    return F.coalesce(F.try_element_at(names, F.col("layout_id")), F.array().cast("array<string>"))


# --- rules of a page's structure


def missing_required_zone() -> Column:
    absent = F.array_sort(F.array_except(required(), F.coalesce(F.transform(F.col(Z), lambda z: z["zone_id"]), F.array().cast("array<string>"))))
    return F.transform(absent, lambda name: issue("missing_required_zone", "error", "a zone of this layout is missing", name))


def required_zone_content() -> Column:
    def rule(z: Column) -> Column:
        empty = issue("required_zone_empty", "error", "a required zone has no text", z["zone_id"])
        sparse = issue("required_zone_sparse", "warning", "a required zone has little content", z["zone_id"])
        text = F.trim(F.coalesce(z["text"], F.lit("")))
        table = is_type("table")(z)
        cell_text = F.coalesce(F.exists(z["cells"], lambda c: ~blank(c["text"])), F.lit(False))
        little = (is_type("title")(z) & (F.length(text) < 3)) | (is_type("body", "paragraph")(z) & (F.length(text) < 15)) | (is_type("form")(z) & (F.coalesce(F.size(z["metadata"]["rendered_fields"]), F.lit(0)) <= 0))
        return F.when(table & ~cell_text, F.array(empty)).when(table, _none()).when(text == "", F.array(empty)).when(little, F.array(sparse)).otherwise(_none())

    return per_zone(rule, lambda z: F.array_contains(required(), z["zone_id"]) & ~is_type(*NO_TEXT_ZONES)(z))


def invalid_zone_box() -> Column:
    return per_zone(lambda z: when(~valid(z), issue("invalid_zone_box", "error", "the box isn't inside the page", z["zone_id"])))


def invalid_reading_order() -> Column:
    sound = F.transform(F.filter(F.col(Z), valid), lambda z: F.struct(z["zone_id"].alias("zone_id"), z["reading_order"].alias("order")))
    taken = lambda all_, orders: F.transform(all_, lambda z, i: when(F.array_position(orders, z["order"]) <= i, issue("invalid_reading_order", "error", "the reading order is taken", z["zone_id"])))
    return F.coalesce(let(sound, lambda x: let(F.transform(x, lambda z: z["order"]), lambda orders: F.flatten(taken(x, orders)))), _none())


def body_justify() -> Column:
    return per_zone(lambda z: when(z["style"]["align"] == "justify", issue("body_justify", "error", "justified text", z["zone_id"])), valid)


def fonts() -> Column:
    def rule(z: Column) -> Column:
        size = z["style"]["font_size_px"]
        least_body = F.coalesce(z["metadata"]["min_render_font_px"], F.lit(LIMITS["body_font"]))
        small = lambda code, types, least: when(is_type(*types)(z) & (size < least), issue(code, "error", "the font is too small", z["zone_id"]))
        return F.concat(
            small("tiny_title_font", ("title",), LIMITS["title_font"]), small("tiny_body_font", ("paragraph", "body"), least_body),
            small("table_cell_font_too_small", ("table",), LIMITS["table_font"]), small("tiny_metadata_font", METADATA_ZONES, LIMITS["metadata_font"]),
        )

    return per_zone(rule, valid)


def latin_fallback() -> Column:
    native = canonical_language(F.col("language_mix")).isin("kk", "ky")
    any_of = "|".join(LATIN_FALLBACK)  # most texts have none of them and are looked through once
    found = lambda z: F.when(F.upper(z["text"]).rlike(any_of), F.filter(F.array(*map(F.lit, LATIN_FALLBACK)), lambda t: F.contains(F.upper(z["text"]), t)))
    return per_zone(lambda z: F.transform(found(z), lambda _: issue("latin_fallback_text", "error", "Latin letters instead of Cyrillic", z["zone_id"])), lambda z: valid(z) & native)


def _polygon(z: Column, polygon: Column) -> Column:
    bad = (F.size(polygon) > 0) & ((F.size(polygon) < 3) | ~polygon_inside(polygon, F.col("width"), F.col("height")))
    return when(bad, issue("invalid_polygon_geometry", "error", "a polygon has too few points or leaves the page", z["zone_id"]))


def _text_box(z: Column, x: Column) -> Column:
    tiny = (x["bbox"][2] - x["bbox"][0] < LIMITS["box_width"]) | (x["bbox"][3] - x["bbox"][1] < LIMITS["box_height"])
    return F.concat(when(blank(x["text"]), issue("empty_ocr_label", "warning", "no text", z["zone_id"])), when(tiny, issue("tiny_ocr_box", "warning", "the box is too small", z["zone_id"])))


def lines() -> Column:
    def rule(z: Column) -> Column:
        bad = lambda x: when(~box_valid(x["bbox"], F.col("width"), F.col("height")), issue("invalid_line_box", "error", "the line's box isn't inside the page", z["zone_id"]))
        return per_item(z, z["lines"], lambda x: F.concat(_text_box(z, x), bad(x), _polygon(z, x["polygon"])))

    return per_zone(rule, valid)


def cells() -> Column:
    def rule(z: Column) -> Column:
        def of(c: Column) -> Column:
            sound = box_valid(c["bbox"], F.col("width"), F.col("height"))
            wrong = issue("invalid_table_cell", "error", "the cell's box is wrong", z["zone_id"])
            shown = F.regexp_replace(F.array_join(c["metadata"]["rendered_lines"], ""), r"\s+", "")
            cut = (F.size(c["metadata"]["rendered_lines"]) > 0) & (shown != F.regexp_replace(F.coalesce(c["text"], F.lit("")), r"\s+", ""))
            rest = F.concat(
                when(~contains(z["bbox"], c["bbox"]), wrong), _text_box(z, c),
                when(c["metadata"]["rendered_font_size"] < LIMITS["table_font"], issue("table_cell_font_too_small", "error", "the font is too small", z["zone_id"])),
                when(cut, issue("table_cell_text_truncated", "error", "the cell's text is cut", z["zone_id"])), _polygon(z, c["polygon"]),
            )
            return F.when(sound, rest).otherwise(F.array(wrong))

        return per_item(z, z["cells"], of)

    return per_zone(rule, valid)


def excessive_duplicates(most: int = 4) -> Column:
    kind = lambda z: F.when(is_type("body", "paragraph")(z), "body_line").otherwise("text")
    pair = lambda text, k: F.struct(F.trim(text).alias("text"), k.alias("kind"))
    none = F.array().cast("array<struct<text:string,kind:string>>")
    of = lambda z: F.concat(F.coalesce(F.transform(z["lines"], lambda x: pair(x["text"], kind(z))), none), F.coalesce(F.transform(z["cells"], lambda x: pair(x["text"], F.coalesce(x["metadata"]["value_type"], F.lit("None")))), none))
    found = F.filter(F.flatten(F.transform(F.col(Z), of)), lambda x: F.length(x["text"]) > F.when(x["kind"] == "body_line", 32).otherwise(3))
    found = F.filter(found, lambda x: ~x["kind"].isin("sequence", "date", "amount", "department", "score", "status"))
    often = let(found, lambda all_: F.exists(F.array_distinct(all_), lambda x: F.size(F.filter(all_, lambda y: y == x)) > most))
    return when(often, issue("excessive_duplicates", "warning", "one text occurs too often"))


def excessive_overlap() -> Column:
    box = lambda z: F.coalesce(z["metadata"]["source_bbox"], z["bbox"])
    solid = F.transform(F.filter(F.col(Z), lambda z: ~F.coalesce(is_type(*NO_TEXT_ZONES)(z), F.lit(False))), lambda z: F.struct(z["zone_id"].alias("zone_id"), box(z).alias("box")))

    def of(boxes: Column) -> Column:
        def rule(z: Column, i: Column) -> Column:
            later = F.slice(boxes, i + 2, F.size(boxes))
            hits = F.filter(later, lambda y: overlap_ratio(z["box"], y["box"]) > LIMITS["overlap"])
            return F.transform(hits, lambda _: issue("excessive_overlap", "error", "two zones overlap", z["zone_id"]))

        return F.flatten(F.transform(boxes, rule))

    return F.coalesce(let(solid, of), _none())


# --- rules of what was rendered


def _outside_page(z: Column, box: Column) -> Column:
    s = LIMITS["slack"]
    out = (box[0] < -s) | (box[1] < -s) | (box[2] > F.col("width") + s) | (box[3] > F.col("height") + s)
    return when((F.size(box) == 4) & out, issue("glyph_intersection_page_boundary", "error", "rendered text leaves the page", z["zone_id"]))


def glyphs_of_zones() -> Column:
    return per_zone(lambda z: _outside_page(z, z["metadata"]["rendered_bbox"]))


def glyphs_of_tables() -> Column:
    crossed = lambda z: issue("glyph_intersection_rule", "error", "rendered text crosses a rule", z["zone_id"])

    def rule(z: Column) -> Column:
        box, polygon = (lambda c: c["metadata"]["rendered_bbox"]), (lambda c: c["metadata"]["rendered_bbox_polygon"])
        meet = lambda a, b: F.when((F.size(polygon(a)) > 0) & (F.size(polygon(b)) > 0), polygons_intersect(polygon(a), polygon(b))).otherwise(boxes_intersect(box(a), box(b)))

        def of(c: Column, i: Column) -> Column:
            later = F.slice(z["cells"], i + 2, F.size(z["cells"]))
            hits = F.filter(later, lambda d: F.coalesce((F.size(box(d)) == 4) & meet(c, d), F.lit(False)))
            near = F.transform(hits, lambda _: issue("glyph_intersection_neighboring_cells", "error", "rendered texts of two cells meet", z["zone_id"]))
            return F.when(F.size(box(c)) == 4, F.concat(_outside_page(z, box(c)), when(~contains(c["bbox"], box(c), LIMITS["slack"]), crossed(z)), near)).otherwise(_none())

        return F.coalesce(F.flatten(F.transform(z["cells"], of)), _none())

    return per_zone(rule, is_type("table"))


def glyphs_of_forms() -> Column:
    s = LIMITS["slack"]

    def rule(z: Column) -> Column:
        crossed = issue("glyph_intersection_rule", "error", "rendered text crosses a rule", z["zone_id"])
        line = z["metadata"]["form_separator_polygon"]
        straight = F.coalesce((F.size(line) == 2) & F.forall(line, lambda p: F.size(p) == 2), F.lit(False))
        (x1, y1), (x2, y2) = ((line[k][0], line[k][1]) for k in (0, 1))
        at = lambda y: F.when(y2 == y1, (x1 + x2) / 2).otherwise(x1 + F.try_divide(y - y1, y2 - y1) * (x2 - x1))
        edge = z["bbox"][0] + z["metadata"]["form_label_width"]

        def of(f: Column) -> Column:
            label, value, row = f["label_bbox"], f["value_bbox"], f["row_bbox"]
            leaves = lambda b: when((F.size(b) == 4) & (F.size(row) == 4) & ((b[1] < row[1] - s) | (b[3] > row[3] + s)), crossed)
            both = when((F.size(label) == 4) & (F.size(value) == 4) & boxes_intersect(label, value), issue("glyph_intersection_label_value", "error", "label and value meet", z["zone_id"]))
            by_line = F.concat(when(F.exists(f["label_bbox_polygon"], lambda p: p[0] > at(p[1]) + s), crossed), when(F.exists(f["value_bbox_polygon"], lambda p: p[0] < at(p[1]) - s), crossed))
            by_edge = F.concat(when(label[2] > edge + s, crossed), when(value[0] < edge - s, crossed))
            separated = F.when(F.coalesce(f["kind"], F.lit("")) != "field", _none()).when(straight, by_line).when(z["metadata"]["form_label_width"] > 0, by_edge).otherwise(_none())
            return F.concat(_outside_page(z, label), leaves(label), _outside_page(z, value), leaves(value), both, separated)

        return per_item(z, z["metadata"]["rendered_fields"], of)

    return per_zone(rule, is_type("form"))


def rendered_text_outside_cell() -> Column:
    def rule(z: Column) -> Column:
        def of(c: Column) -> Column:
            m = c["metadata"]
            told = m["rendered_inside_cell"]
            box = m["rendered_bbox"]
            by_box = (F.size(box) == 4) & ~(contains(c["bbox"], box) & (box[0] <= box[2]) & (box[1] <= box[3]))
            bottom = m["rendered_text_y"] + F.coalesce(F.greatest(F.size(m["rendered_lines"]), F.lit(0)), F.lit(0)) * m["rendered_line_height"]
            by_lines = (m["rendered_text_y"] < c["bbox"][1]) | (bottom > c["bbox"][3])
            out = F.when(told.isNotNull(), ~told).otherwise(F.coalesce(by_box, F.lit(False)) | F.coalesce(by_lines, F.lit(False)))
            return when(out, issue("rendered_text_outside_cell", "error", "rendered text leaves its cell", z["zone_id"]))

        return per_item(z, z["cells"], of)

    return per_zone(rule, is_type("table"))


def form_field_overlap() -> Column:
    def rule(z: Column) -> Column:
        bad = lambda f: (F.size(f["label_bbox"]) == 4) & (F.size(f["value_bbox"]) == 4) & (boxes_intersect(f["label_bbox"], f["value_bbox"]) | ~F.coalesce(f["rendered_complete"], F.lit(False)))
        return when(F.exists(z["metadata"]["rendered_fields"], lambda f: F.coalesce(bad(f), F.lit(False))), issue("form_field_overlap", "error", "label and value overlap or don't fit", z["zone_id"]))

    return per_zone(rule, is_type("form"))


def title_semantic_mismatch() -> Column:
    bad = F.filter(F.col(Z), lambda z: F.coalesce(is_type("title")(z) & ~blank(z["text"]) & z["text"].rlike(TITLE_METADATA), F.lit(False)))
    return F.coalesce(F.transform(F.slice(bad, 1, 1), lambda z: issue("title_semantic_mismatch", "warning", "the title holds a date or its label", z["zone_id"])), _none())


def empty_page() -> Column:
    many = F.aggregate(F.filter(F.col(Z), lambda z: ~F.coalesce(is_type(*NO_TEXT_ZONES)(z), F.lit(False))), F.lit(0), lambda n, z: n + F.greatest(F.coalesce(F.size(z["lines"]), F.lit(0)), F.lit(0)) + F.greatest(F.coalesce(F.size(z["cells"]), F.lit(0)), F.lit(0)))
    return when(F.coalesce(many, F.lit(0)) == 0, issue("empty_page", "error", "no lines and no cells"))


def dates_and_signatures() -> Column:
    dated = F.filter(F.col(Z), lambda z: F.coalesce(valid(z) & z["metadata"]["date_role"].isNotNull(), F.lit(False)))
    pairs = F.flatten(F.transform(dated, lambda z: F.transform(dates_in(z["text"]), lambda d: F.struct(d.alias("date"), z["metadata"]["date_role"].alias("role")))))
    of_date = lambda all_, d: let(F.filter(all_, lambda p: p["date"] == d), lambda same: (F.size(same) > 1) & (F.size(F.array_distinct(F.transform(same, lambda p: p["role"]))) == 1))
    repeated = let(pairs, lambda all_: F.filter(F.array_distinct(F.transform(all_, lambda p: p["date"])), lambda d: of_date(all_, d)))
    signed = F.filter(F.col(Z), lambda z: F.coalesce(valid(z) & (z["metadata"]["signature_role"] != ""), F.lit(False)))
    high = F.filter(signed, lambda z: F.coalesce(z["metadata"]["source_bbox"], z["bbox"])[1] < F.col("height") * LIMITS["signature_from"])
    return F.concat(
        F.coalesce(F.transform(repeated, lambda _: issue("duplicate_structural_date", "error", "a date repeats in one role")), _none()),
        when(F.size(signed) > 1, issue("multiple_final_signatures", "error", "more than one final signature")),
        F.coalesce(F.transform(high, lambda z: issue("signature_too_high", "error", "the signature isn't at the foot of the page", z["zone_id"])), _none()),
    )


def ratios_and_densities(min_chars: dict[str, int] | None = None) -> Column:
    family = layout_family(F.col("layout_id"))
    least = F.lit(None).cast("double")
    for layout, ratio in LAYOUT_HEIGHT_RATIOS.items():
        least = F.when(F.col("layout_id") == layout, ratio).otherwise(least)
    for name, ratio in FAMILY_HEIGHT_RATIOS.items():
        least = F.when(family == name, ratio).otherwise(least)
    total = lambda types, f: F.coalesce(F.aggregate(F.filter(F.col(Z), lambda z: F.coalesce(is_type(*types)(z), F.lit(False))), F.lit(0), lambda n, z: n + f(z)), F.lit(0))
    visible = F.coalesce(F.aggregate(F.filter(F.col(Z), lambda z: F.coalesce(valid(z) & is_type("body", "form")(z), F.lit(False))), F.lit(0), lambda n, z: n + F.length(F.trim(F.coalesce(z["text"], F.lit(""))))), F.lit(0))
    entries = total(("form",), lambda z: F.coalesce(z["metadata"]["rendered_entry_count"], F.regexp_count(F.coalesce(z["text"], F.lit("")), F.lit(":"))))
    filled = total(("table",), lambda z: F.greatest(F.coalesce(F.size(z["cells"]), F.lit(0)), F.lit(0)))
    chars = F.coalesce(F.try_element_at(_map(min_chars), F.col("layout_id")), F.lit(0)) if min_chars else F.lit(0)
    return F.concat(
        when(F.coalesce(F.col("content_height_ratio"), F.lit(0.0)) < least, issue("low_content_height_ratio", "error", "content fills too little of the page")),
        per_zone(lambda z: when(z["metadata"]["text_truncated"], issue("rendered_text_truncated", "error", "text is cut", z["zone_id"]))),
        when(visible < chars, issue("low_text_density", "error", "too little text")),
        when((family == "form") & (entries < LIMITS["fields"]), issue("low_form_density", "error", "too few filled fields")),
        when((family == "table") & (filled < LIMITS["cells"]), issue("low_table_density", "error", "too few cells")),
    )


def effect_safety() -> Column:
    warnings = F.flatten(F.transform(F.col("effect_chain"), lambda e: F.coalesce(e["warnings"], F.array().cast("array<string>"))))
    severity = lambda w: F.when(w.isin(*SAFE_WARNINGS), "warning").otherwise("error")
    return F.coalesce(F.transform(warnings, lambda w: F.struct(F.lit("effect_safety").alias("code"), severity(w).alias("severity"), w.alias("message"), F.lit(None).cast("string").alias("zone_id"))), _none())


# --- rules of languages


def _marked(x: Column) -> Column:
    m = x["metadata"]
    return F.coalesce(F.startswith(x["language"], F.lit("bilingual_")) | (x["language"] == "ru"), F.lit(False)) | F.coalesce(m["mixing_feature"] != "", F.lit(False)) | (F.coalesce(F.size(m["mixing_features"]), F.lit(0)) > 0)


def _has_feature(x: Column, feature: Column) -> Column:
    m = x["metadata"]
    return F.coalesce(m["mixing_feature"] == feature, F.lit(False)) | F.coalesce(F.array_contains(m["mixing_features"], feature), F.lit(False))


def language_mixing() -> Column:
    mixed = canonical_language(F.col("language_mix")).isin("ru_kk", "ru_ky")
    declared = F.coalesce(F.col("mixing_features"), F.array().cast("array<string>"))
    in_zone = lambda test: F.coalesce(F.exists(F.col(Z), test), F.lit(False))
    in_cells = lambda z, test: F.coalesce(F.exists(z["cells"], test), F.lit(False))
    marked = in_zone(lambda z: _marked(z) | in_cells(z, _marked))
    unplaced = F.filter(declared, lambda f: ~in_zone(lambda z: _has_feature(z, f) | in_cells(z, lambda c: _has_feature(c, f))))
    field = in_zone(lambda z: is_type("form")(z) & (F.coalesce(F.startswith(z["language"], F.lit("bilingual_")), F.lit(False)) | _has_feature(z, F.lit("field_level"))))
    table = in_zone(lambda z: is_type("table")(z) & (_has_feature(z, F.lit("table_level")) | in_cells(z, lambda c: _has_feature(c, F.lit("table_level")))))
    text = F.array_join(F.flatten(F.transform(F.col(Z), lambda z: F.concat(F.array(z["text"]), F.coalesce(F.transform(z["cells"], lambda c: c["text"]), F.array().cast("array<string>"))))), "\n")
    short = F.exists(F.array(*map(F.lit, ABBREVIATIONS)), lambda t: F.coalesce(F.contains(text, t), F.lit(False)))
    absent = lambda name, present: when(F.array_contains(declared, name) & ~present, issue("declared_mixing_feature_not_present", "warning", f"{name} is declared but isn't there"))
    found = F.concat(
        when(~marked, issue("mixed_language_has_no_secondary_content", "warning", "nothing is in the second language")),
        when(F.size(unplaced) > 0, issue("missing_zone_language_metadata", "warning", "a declared feature is in no zone")),
        absent("field_level", field), absent("table_level", table), absent("abbreviation_level", short),
    )
    return F.when(mixed, found).otherwise(_none())


def invalid_language_mix_ratio() -> Column:
    ratio = F.col("language_mix_ratio")
    values = F.map_values(ratio)
    keys = F.array_compact(F.array(F.col("primary_language"), F.lit("ru"), F.lit("en")))
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    mixed = canonical_language(F.col("language_mix")).isin("ru_kk", "ru_ky")
    good = F.forall(keys, lambda k: F.map_contains_key(ratio, k)) & F.forall(values, lambda v: v.between(0, 1)) & (F.abs(total - 1) <= 0.01) & (~mixed | F.coalesce(F.col("secondary_language") == "ru", F.lit(False)))
    return when(~F.coalesce(good, F.lit(False)), issue("invalid_language_mix_ratio", "warning", "shares of languages are missing, incomplete or don't add up"))


def latin_confusable() -> Column:
    bad = lambda text: F.coalesce(F.exists(F.split(text, r"\s+"), mixes_scripts), F.lit(False))
    one = lambda z: issue("latin_confusable_detected", "error", "a word mixes scripts", z["zone_id"])
    return per_zone(lambda z: F.concat(when(bad(z["text"]), one(z)), per_item(z, z["cells"], lambda c: when(bad(c["text"]), one(z)))))


def unsupported_character() -> Column:
    kyrgyz = canonical_language(F.col("language_mix")).isin("ky", "ru_ky")
    one = lambda z: issue("unsupported_character_detected", "error", "a letter of another alphabet", z["zone_id"])
    bad = lambda text: text.rlike(f"[{KAZAKH_ONLY}]")
    return per_zone(lambda z: F.concat(when(bad(z["text"]), one(z)), per_item(z, z["cells"], lambda c: when(bad(c["text"]), one(z)))), lambda z: kyrgyz)


def not_nfc() -> Column:
    """Compares texts with their normal form, made once for each page by check(); a page's first bad zone is named, and each zone with a bad cell up to it."""
    one = lambda z: issue("text_not_nfc_normalized", "error", "the text isn't in normal form C", z["zone_id"])
    first = F.array_position(F.transform(F.col("_nfc"), lambda x: F.coalesce(x["own"], F.lit(False))), True)

    def of(at: Column) -> Column:
        def rule(z: Column, i: Column) -> Column:
            state = F.element_at(F.col("_nfc"), i + 1)
            return F.when((at > 0) & (i + 1 > at), _none()).when(F.coalesce(state["own"], F.lit(False)), F.array(one(z))).otherwise(when(state["cells"], one(z)))

        return F.flatten(F.transform(F.col(Z), rule))

    return F.coalesce(F.when(F.exists("_nfc", lambda x: F.coalesce(x["own"] | x["cells"], F.lit(False))), let(first, of)), _none())


# --- rules of effects


def extreme_geometry() -> Column:
    extreme = F.coalesce(F.col("geometry_tier") == "extreme", F.lit(False))
    given = (F.size("forward") > 0) & (F.size("inverse") > 0)
    none = lambda p: F.coalesce(F.size(p), F.lit(0)) <= 0
    def rule(z: Column) -> Column:
        gone = issue("missing_polygon", "error", "a polygon is missing", z["zone_id"])
        out = F.exists(z["polygon"], lambda p: ~((p[0] >= 0) & (p[0] < F.col("width")) & (p[1] >= 0) & (p[1] < F.col("height"))))
        return F.concat(when(none(z["polygon"]), gone), per_item(z, z["lines"], lambda x: when(none(x["polygon"]), gone)), per_item(z, z["cells"], lambda x: when(none(x["polygon"]), gone)), when(out, issue("extreme_geometry_outside_canvas", "error", "a zone left the page", z["zone_id"])))

    matrices = F.when(~F.coalesce(given, F.lit(False)), F.array(issue("missing_extreme_transform", "error", "a matrix is missing"))).otherwise(when(~inverse_holds(F.col("forward"), F.col("inverse")), issue("invalid_inverse_transform", "error", "the matrices aren't inverse")))
    return F.when(extreme, F.concat(matrices, per_zone(rule))).otherwise(_none())


def pen_artifacts() -> Column:
    parts = ("type", "color_rgb", "opacity", "stroke_width", "target_zone", "polygon", "bbox")
    partial = F.filter(F.col("artifacts"), lambda a: F.exists(F.array(*(a[p].isNull() for p in parts)), lambda x: x))
    body = F.transform(F.filter(F.col(Z), lambda z: F.coalesce(is_type("body", "paragraph")(z), F.lit(False))), lambda z: z["zone_id"])
    crossing = F.filter(F.col("artifacts"), lambda a: F.coalesce(F.array_contains(body, a["target_zone"]), F.lit(False)))
    return F.concat(F.coalesce(F.transform(partial, lambda _: issue("incomplete_pen_metadata", "error", "a mark isn't described in full")), _none()), when(F.size(crossing) > LIMITS["pen_crossings"], issue("pen_body_crossing_budget", "error", "too many marks cross the text")))


def _page_text() -> Column:
    """Texts of zones and cells by lines."""
    return F.array_join(F.flatten(F.transform(F.col(Z), lambda z: F.concat(F.array(z["text"]), F.coalesce(F.transform(z["cells"], lambda c: c["text"]), F.array().cast("array<string>"))))), "\n")


#: Characters that are their own normal form C and never part of another's: Latin, Greek and Cyrillic letters, common punctuation.
_SURELY_NFC = r"\x{0}-\x{2FF}\x{391}-\x{482}\x{48A}-\x{52F}\x{2010}-\x{2027}\x{2030}-\x{205E}\x{20A0}-\x{20BF}\x{2116}"
#: What a page's text must match for a rule to find anything; most pages match none of these, so their zones aren't looked through.
GUARDS: dict[str, Callable[[Column], Column]] = {
    "latin_fallback": lambda text: F.upper(text).rlike("|".join(LATIN_FALLBACK)),
    "latin_confusable": lambda text: text.rlike(r"\p{IsCyrillic}") & text.rlike(r"\p{IsLatin}"),
    "unsupported_character": lambda text: text.rlike(f"[{KAZAKH_ONLY}]"),
    "title_semantic_mismatch": lambda text: text.rlike(TITLE_METADATA),
    "not_nfc": lambda text: text.rlike(f"[^{_SURELY_NFC}]"),
}

RULES: dict[str, Callable[[], Column]] = {
    f.__name__: f
    for f in (
        missing_required_zone, required_zone_content, invalid_zone_box, invalid_reading_order, body_justify, fonts, latin_fallback, lines, cells, excessive_duplicates, excessive_overlap,
        glyphs_of_zones, glyphs_of_tables, glyphs_of_forms, rendered_text_outside_cell, form_field_overlap, title_semantic_mismatch, empty_page, dates_and_signatures, ratios_and_densities,
        effect_safety, language_mixing, invalid_language_mix_ratio, extreme_geometry, pen_artifacts, latin_confusable, unsupported_character, not_nfc,
    )
}


def _nfc_state(pages: DataFrame) -> DataFrame:
    """pages with _nfc, null for pages in normal form C: for each zone whether its text, or a cell's, isn't. Only texts with other characters than usual go to the normalizer, in one piece for each page."""
    suspect = F.coalesce(GUARDS["not_nfc"](F.col("_text")), F.lit(False))
    joined = F.when(suspect, F.to_json(F.transform(F.col(Z), lambda z: F.struct(z["text"].alias("t"), F.transform(z["cells"], lambda c: c["text"]).alias("c")))))
    x = pages.withColumn("_raw", joined).withColumn("_flat", nfc(F.col("_raw")))
    both = lambda c: F.from_json(c, "array<struct<t:string,c:array<string>>>")
    differ = lambda a, b: F.struct((~a["t"].eqNullSafe(b["t"])).alias("own"), (~a["c"].eqNullSafe(b["c"])).alias("cells"))
    return x.withColumn("_nfc", F.when(F.col("_raw") != F.col("_flat"), F.zip_with(both("_raw"), both("_flat"), differ))).drop("_raw", "_flat")


def check(pages: DataFrame, rules: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """pages (foliomill.schema.PAGE) with issues and ok."""
    rules = RULES if rules is None else rules
    x = pages.withColumn("_text", _page_text())
    x = _nfc_state(x) if "not_nfc" in rules else x
    guarded = lambda name, found: F.when(F.coalesce(GUARDS[name](F.col("_text")), F.lit(False)), found).otherwise(_none()) if name in GUARDS else found
    x = x.withColumn("issues", F.concat(*(guarded(name, rule()) for name, rule in rules.items())))
    return x.withColumn("ok", ~F.exists("issues", lambda i: i["severity"] == "error")).drop("_nfc", "_text")


def issue_rows(checked: DataFrame, *keep: str) -> DataFrame:
    """One row per issue. Pages without issues fall out only after the arrays were made: a filter on their size would have all rules evaluated twice."""
    return checked.select(*keep, F.inline_outer("issues")).where("code is not null")


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where("ok")


def manifest_problems(rows: DataFrame, key: str = "page_id", image: str = "image_path", needed: tuple[str, ...] = ("layout_id", "language_mix", "quality_profile")) -> DataFrame:
    """(row, problem) of a manifest: missing fields, repeated ids and images (all but the first), no zones, not accepted."""
    from pyspark.sql import Window

    x = rows.withColumn("_id_no", F.row_number().over(Window.partitionBy(key).orderBy(image))).withColumn("_image_no", F.row_number().over(Window.partitionBy(image).orderBy(key)))
    problem = lambda name, c: F.when(F.coalesce(c, F.lit(False)), F.lit(name))
    found = F.array_compact(F.array(
        *(problem(f"missing {c}", F.coalesce(F.col(c), F.lit("")) == "") for c in (key, image, *needed)), problem("repeated id", F.col(key).isNotNull() & (F.col("_id_no") > 1)),
        problem("repeated image", F.col(image).isNotNull() & (F.col("_image_no") > 1)), problem("no zones", F.coalesce(F.size(Z), F.lit(0)) <= 0), problem("not accepted", ~F.coalesce(F.col("qa_ok"), F.lit(False))),
    ))
    return x.select(F.col(key).alias("row"), F.explode(found).alias("problem"))


def drawable(pages: DataFrame) -> DataFrame:
    """By page the number of zones, of repeated zone ids, of zones whose box is sound, and of those with a polygon or a box to draw."""
    z = pages.select("page_id", "width", "height", F.posexplode("zones").alias("at", "z"))
    sound = box_valid(F.col("z.bbox"), F.col("width"), F.col("height")) & (area(F.col("z.bbox")) > 0) & F.forall("z.bbox", lambda v: ~F.isnan(v))
    x = z.groupBy("page_id", "z.zone_id").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct(sound.alias("sound"), ((F.size("z.polygon") >= 3) | sound).alias("drawable")), "at").alias("first"))
    return x.groupBy("page_id").agg(F.sum("n").alias("zones"), F.sum(F.col("n") - 1).alias("repeated"), F.count(F.when(F.col("first.sound"), 1)).alias("valid"), F.count(F.when(F.col("first.drawable"), 1)).alias("drawable"))
