"""Texts and parts of nested page records (columns named as in foliomill.schema)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.text import BOILERPLATE, KAZAKH_SPECIAL, has_any

_NONE = "array<string>"


def _texts(items: Column, field: str = "text") -> Column:
    return F.coalesce(F.filter(F.transform(items, lambda x: x[field]), lambda t: F.coalesce(t, F.lit("")) != ""), F.array().cast(_NONE))


def _trimmed(texts: Column) -> Column:
    return F.filter(F.transform(texts, lambda t: F.regexp_replace(t, r"^\s+|\s+$", "")), lambda t: t != "")


def row_text(zones: Column, joint: str = "\n") -> Column:
    """Zone texts that aren't null, joined."""
    return F.array_join(F.filter(F.transform(zones, lambda z: z["text"]), lambda t: t.isNotNull()), joint)


def atomic_texts(zones: Column) -> Column:
    """Of each zone the cells, else the fields' labels and values, else the lines, else the text."""

    def of(z: Column) -> Column:
        fields = z["metadata"]["rendered_fields"]
        pairs = F.flatten(F.transform(fields, lambda f: F.array(f["label_text"], f["value_text"])))
        return (
            F.when(F.size(z["cells"]) > 0, _texts(z["cells"]))
            .when(F.size(fields) > 0, F.filter(pairs, lambda t: F.coalesce(t, F.lit("")) != ""))
            .when(F.size(z["lines"]) > 0, _texts(z["lines"]))
            .otherwise(F.filter(F.array(z["text"]), lambda t: F.coalesce(t, F.lit("")) != ""))
        )

    return F.flatten(F.transform(zones, of))


def full_text(zones: Column) -> Column:
    """All texts of a page: zones, lines, cells, field labels and values."""

    def of(z: Column) -> Column:
        fields = F.coalesce(F.flatten(F.transform(z["metadata"]["rendered_fields"], lambda f: F.array(f["label_text"], f["value_text"]))), F.array().cast(_NONE))
        return F.concat(F.array(z["text"]), _texts(z["lines"]), _texts(z["cells"]), fields)

    return F.array_join(F.flatten(F.transform(zones, of)), " ")


def meaningful_segments(zones: Column) -> Column:
    """Trimmed texts without boilerplate zones and table heads: cells below row 0, else field values, else lines, else lines of the text."""

    def boiler(z: Column) -> Column:
        role = F.coalesce(F.nullif(z["role"], F.lit("")), z["metadata"]["role"], F.lit(""))
        return F.lower(role).rlike(BOILERPLATE) | F.lower(F.coalesce(z["zone_type"], F.lit(""))).rlike(BOILERPLATE)

    def of(z: Column) -> Column:
        fields = z["metadata"]["rendered_fields"]
        return _trimmed(
            F.when(F.size(z["cells"]) > 0, _texts(F.filter(z["cells"], lambda c: c["row"] > 0)))
            .when(F.size(fields) > 0, _texts(fields, "value_text"))
            .when(F.size(z["lines"]) > 0, _texts(z["lines"]))
            .otherwise(F.split(F.coalesce(z["text"], F.lit("")), r"\r?\n"))
        )

    return F.flatten(F.transform(F.filter(zones, lambda z: ~boiler(z)), of))


def has_rare(zones: Column, characters: str = KAZAKH_SPECIAL) -> Column:
    def of(z: Column) -> Column:
        return has_any(z["text"], characters) | F.coalesce(F.exists(z["lines"], lambda x: has_any(x["text"], characters)), F.lit(False)) | F.coalesce(F.exists(z["cells"], lambda x: has_any(x["text"], characters)), F.lit(False))

    return F.coalesce(F.exists(zones, of), F.lit(False))


def corners(box: Column) -> Column:
    """Polygon of a box (x1, y1, x2, y2)."""
    return F.array(F.array(box[0], box[1]), F.array(box[2], box[1]), F.array(box[2], box[3]), F.array(box[0], box[3]))


def ocr_regions(zones: Column, min_width: int = 4, min_height: int = 6) -> Column:
    """Lines and cells with text in a box of that size, outside stamps and decoration: region_id, text, bbox, polygon."""

    def region(kind: str, z: Column, x: Column, i: Column) -> Column:
        name = F.concat(z["zone_id"], F.lit(f"_{kind}"), i.cast("string"))
        return F.struct(name.alias("region_id"), x["text"].alias("text"), x["bbox"].alias("bbox"), F.when(F.size(x["polygon"]) > 0, x["polygon"]).otherwise(corners(x["bbox"])).alias("polygon"))

    def of(z: Column) -> Column:
        none = F.array()
        lines = F.transform(z["lines"], lambda x, i: region("line", z, x, i))
        cells = F.transform(z["cells"], lambda x, i: region("cell", z, x, i))
        return F.concat(F.coalesce(lines, none), F.coalesce(cells, none))

    target = lambda z: ~F.coalesce(z["zone_type"], F.lit("")).isin("stamp", "decorative_non_text")
    found = F.flatten(F.transform(F.filter(zones, target), of))
    good = lambda r: (F.trim(F.coalesce(r["text"], F.lit(""))) != "") & (r["bbox"][2] - r["bbox"][0] >= min_width) & (r["bbox"][3] - r["bbox"][1] >= min_height)
    return F.filter(found, good)


def selected_fonts(zones: Column) -> Column:
    """Distinct (family, path), first seen first."""
    return F.array_distinct(F.transform(zones, lambda z: F.struct(z["style"]["font_family"].alias("family"), z["style"]["font_path"].alias("path"))))


def compacted(zones: Column) -> Column:
    """Only the parts of zones that audits read."""
    return F.transform(zones, lambda z: F.struct(*(z[c].alias(c) for c in ("zone_id", "zone_type", "role", "text", "reading_order", "style", "lines", "cells", "metadata"))))


def date_roles(zones: Column) -> Column:
    """Rows (zone, role): a zone's own date role, and those of its parts as zone.key."""

    def of(z: Column) -> Column:
        own = F.filter(F.array(F.struct(z["zone_id"].alias("zone"), z["metadata"]["date_role"].alias("role"))), lambda x: x["role"].isNotNull())
        parts = F.transform(F.map_entries(z["metadata"]["date_roles"]), lambda e: F.struct(F.concat(z["zone_id"], F.lit("."), e["key"]).alias("zone"), e["value"].alias("role")))
        return F.concat(own, F.coalesce(parts, F.array()))

    return F.flatten(F.transform(zones, of))


def last_per_id(records: Column, key: str) -> Column:
    """Of an array of structs the last of each key, in the order in which keys came first."""
    keys = F.array_distinct(F.transform(records, lambda r: r[key]))
    return F.transform(keys, lambda k: F.element_at(F.filter(records, lambda r: r[key].eqNullSafe(k)), -1))


def search_text(column: Column) -> Column:
    """Names and values of a nested column as one lower-case string."""
    return F.lower(F.trim(F.regexp_replace(F.to_json(column), r'[{}\[\]":,]+', " ")))


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Only those of the columns that the table has."""
    return df.select(*(c for c in columns if c in df.columns))


def has_stamp(stamp_id: Column, stamp_text: Column) -> Column:
    return (F.coalesce(stamp_id, F.lit("")) != "") | (F.coalesce(stamp_text, F.lit("")) != "")


def completed(df: DataFrame) -> DataFrame:
    """Rows of older manifests with what newer ones have: absent columns, and nulls where a default is known."""
    defaults = {
        "generator_schema_version": ("string", F.lit("legacy")), "content_schema_id": ("string", F.lit(None)), "layout_variant": ("string", F.lit("legacy")), "content_record_ids": ("array<string>", F.array()),
        "visual_qa_status": ("string", F.lit("pending_manual")), "qa_flags": ("array<string>", F.array()), "stamp_id": ("string", F.lit(None)), "stamp_text": ("string", F.lit(None)),
    }
    for name, (kind, value) in defaults.items():
        value = value.cast(kind)
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df.withColumn("has_stamp", has_stamp(F.col("stamp_id"), F.col("stamp_text")))


#: Letters among which the Latin share is taken; weights of bilingual text; shares of a page without text (fixed values).
MIX_LETTERS = "A-Za-zА-Яа-яЁёӘәҒғҚқҢңӨөҰұҮүҺһІі"
BILINGUAL_PRIMARY, BILINGUAL_SECONDARY = 0.68, 0.32
EMPTY_PRIMARY, EMPTY_SECONDARY, EMPTY_ENGLISH = 0.68, 0.29, 0.03


def language_ratio(zones: Column, primary: Column, secondary: Column) -> Column:
    """Estimated shares of languages by zones' and cells' texts, 3 places, what rounding leaves goes to the primary one; a page of one language has it alone."""
    parts = F.flatten(F.transform(zones, lambda z: F.concat(F.array(F.struct(z["text"].alias("text"), z["language"].alias("language"))), F.coalesce(F.transform(z["cells"], lambda c: F.struct(c["text"].alias("text"), c["language"].alias("language"))), F.array()))))

    def add(s: Column, x: Column) -> Column:
        text = F.coalesce(x["text"], F.lit(""))
        length = F.greatest(F.lit(1), F.length(F.regexp_replace(text, r"^\s+|\s+$", ""))).cast("double")
        latin = length * F.coalesce(F.try_divide(F.regexp_count(text, F.lit("[A-Za-z]")), F.regexp_count(text, F.lit(f"[{MIX_LETTERS}]"))), F.lit(0.0))
        rest = F.greatest(F.lit(0.0), length - latin)
        both, other = F.startswith(F.coalesce(x["language"], F.lit("")), F.lit("bilingual_")), F.coalesce(x["language"] == "ru", F.lit(False))
        own = F.when(other, 0.0).when(both, rest * BILINGUAL_PRIMARY).otherwise(rest)
        second = F.when(other, rest).when(both, rest * BILINGUAL_SECONDARY).otherwise(0.0)
        return F.struct((s["p"] + own).alias("p"), (s["s"] + second).alias("s"), (s["e"] + latin).alias("e"))

    def shares(s: Column) -> Column:
        total = s["p"] + s["s"] + s["e"]
        p, q, e = (F.round(F.try_divide(s[k], total), 3) for k in "pse")
        return F.when(total > 0, F.array(F.round(p + (1.0 - (p + q + e)), 3), q, e)).otherwise(F.array(F.lit(EMPTY_PRIMARY), F.lit(EMPTY_SECONDARY), F.lit(EMPTY_ENGLISH)))

    zero = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("s"), F.lit(0.0).alias("e"))
    mixed = F.map_from_arrays(F.array(primary, secondary, F.lit("en")), F.aggregate(F.coalesce(parts, F.array()), zero, add, shares))
    return F.when(secondary.isNull(), F.map_from_arrays(F.array(primary, F.lit("ru"), F.lit("en")), F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)))).otherwise(mixed)
