"""Expected against observed distributions, and the gates on them.

Dimensions (targets) are small tables; observed counts are one aggregation over the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper ends of the font size buckets (fixed values).
FONT_SIZES = ((14, "< 14"), (18, "14-18"), (22, "18-22"), (26, "22-26"), (30, "26-30"), (36, "30-36"), (48, "36-48"))


def allowed_deviation(expected: Column) -> Column:
    """15 %, or three standard deviations of a sparse bucket."""
    return F.when(expected > 0, F.greatest(F.lit(0.15), 3.0 / F.sqrt(expected))).otherwise(0.15)


def _deviations(x: DataFrame) -> DataFrame:
    relative = F.when(F.col("expected") > 0, (F.col("actual") - F.col("expected")) / F.col("expected")).otherwise(0.0)
    return x.withColumn("deviation", F.col("actual") - F.col("expected")).withColumn("relative", relative).withColumn("allowed", allowed_deviation(F.col("expected")))


def marginal(df: DataFrame, column: str, targets: DataFrame) -> DataFrame:
    """targets: value, share. Expected and actual count of each target value, deviations; values without target aren't listed (see unknown)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("actual"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    x = targets.join(F.broadcast(total), how="cross").join(counts, "value", "left")  # one row
    return _deviations(x.select("value", "share", (F.col("share") * F.col("total")).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")))


def unknown(df: DataFrame, column: str, targets: DataFrame) -> DataFrame:
    """Observed values without target, with their counts."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).join(targets, "value", "left_anti")


def drift(df: DataFrame, shard: str, column: str) -> DataFrame:
    """Largest difference between a value's share in a shard and overall; 0 for one shard. Absent pairs differ by the overall share."""
    cells = df.groupBy(F.col(shard).alias("shard"), F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    shards = cells.groupBy("shard").agg(F.sum("n").alias("rows"))
    values = cells.groupBy("value").agg(F.sum("n").alias("overall"), F.countDistinct("shard").alias("in_shards"))
    total = cells.agg(F.sum("n").alias("total"), F.countDistinct("shard").alias("shards"))
    present = cells.join(shards, "shard").join(values, cells["value"].eqNullSafe(values["value"])).join(F.broadcast(total), how="cross")  # one row
    here = F.abs(F.col("n") / F.col("rows") - F.col("overall") / F.col("total"))
    absent = F.when(F.col("in_shards") < F.col("shards"), F.col("overall") / F.col("total")).otherwise(0.0)
    return present.agg(F.round(F.max(F.when(F.col("shards") > 1, F.greatest(here, absent)).otherwise(0.0)), 4).alias("drift"))


def joint(df: DataFrame, first: str, second: str, conditional: str, first_targets: DataFrame, second_targets: DataFrame, conditional_shares: DataFrame) -> DataFrame:
    """Expected N * p(first) * p(second) * p(conditional | first) against observed, over all combinations; those never observed stay with 0.

    first_targets, second_targets: value, share. conditional_shares: first, value, share. The combinations of the three small dimensions are the result's size.
    """
    counts = df.groupBy(F.col(first).alias("first"), F.col(second).alias("second"), F.col(conditional).alias("third")).agg(F.count(F.lit(1)).alias("actual"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    a = first_targets.select(F.col("value").alias("first"), F.col("share").alias("p1"))
    b = second_targets.select(F.col("value").alias("second"), F.col("share").alias("p2"))
    c = conditional_shares.select("first", F.col("value").alias("third"), F.col("share").alias("p3"))
    grid = a.join(c, "first").join(F.broadcast(b), how="cross").join(F.broadcast(total), how="cross")  # dimension tables, one row
    x = grid.join(counts, ["first", "second", "third"], "left")
    return _deviations(x.select("first", "second", "third", (F.col("total") * F.col("p1") * F.col("p2") * F.col("p3")).alias("expected"), F.coalesce("actual", F.lit(0)).alias("actual")))


def rolled_up(joined: DataFrame, family: Column) -> DataFrame:
    """A joint audit by family of its first dimension."""
    x = joined.groupBy(family.alias("first"), "second", "third").agg(F.sum("expected").alias("expected"), F.sum("actual").alias("actual"))
    return _deviations(x)


def ranked(x: DataFrame, k: int = 20) -> DataFrame:
    """The k most under- and the k most over-represented buckets."""
    key = [c for c in ("value", "first", "second", "third") if c in x.columns]
    under = x.where("deviation < 0").orderBy("deviation", *key).limit(k).withColumn("side", F.lit("under"))
    over = x.where("deviation > 0").orderBy(F.desc("deviation"), *key).limit(k).withColumn("side", F.lit("over"))
    return under.unionByName(over).select(*key, "deviation", "side")


def size_bucket(size: Column) -> Column:
    out = F.lit("> 48")
    for end, name in reversed(FONT_SIZES):
        out = F.when(size < end, name).otherwise(out)
    return out


def coverage(pages: DataFrame) -> DataFrame:
    """Of nested pages: rows (dimension, value, n) for fonts, sizes, densities, orientations, table counts."""
    zones = pages.select("page_id", F.explode("zones").alias("z"))
    name = lambda d, v: F.struct(F.lit(d).alias("dimension"), v.cast("string").alias("value"))
    of_zone = zones.select(F.explode(F.array(name("font_family", F.col("z.style.font_family")), name("font_size_bucket", F.when(F.col("z.style.font_size_px") > 0, size_bucket(F.col("z.style.font_size_px")))))).alias("x"))
    tables = F.size(F.filter(F.coalesce("zones", F.array()), lambda z: (F.coalesce(z["zone_type"], F.lit("")) == "table") | (F.coalesce(z["metadata"]["role"], F.lit("")) == "typed_table")))
    of_page = pages.select(F.explode(F.array(name("text_density", F.coalesce("layout_density", F.lit("standard"))), name("orientation", F.coalesce("orientation", F.lit("portrait"))), name("table_count", tables))).alias("x"))
    return of_zone.unionByName(of_page).select("x.*").where("value is not null").groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))


def depths(pages: DataFrame) -> DataFrame:
    """Least, most and mean number of zones, paragraphs and reading order of nested pages."""
    zones = F.coalesce("zones", F.array())
    body = F.filter(zones, lambda z: F.coalesce(z["zone_type"], F.lit("")).isin("body", "paragraph"))
    paragraphs = F.aggregate(body, F.lit(0), lambda n, z: n + F.size(F.filter(F.split(F.coalesce(z["text"], F.lit("")), "\n\n"), lambda p: F.trim(p) != "")))
    order = F.coalesce(F.array_max(F.transform(zones, lambda z: z["reading_order"])), F.lit(0))
    x = pages.select(F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), v.alias("n")) for k, v in (("zones", F.size(zones)), ("paragraphs", paragraphs), ("reading_order", order))))).alias("x")).select("x.*")
    return x.groupBy("measure").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.avg("n"), 2).alias("mean"))


def rendering(pages: DataFrame) -> DataFrame:
    """Counts over fields and cells: wrapped, incomplete, small table fonts; a flag that is null is neither."""
    zones = pages.select(F.explode("zones").alias("z"))
    fields = zones.select(F.explode("z.metadata.rendered_fields").alias("x")).select(F.lit("field").alias("part"), "x.wrap_state", "x.rendered_complete", F.col("x.font_size").alias("font_size"))
    cells = zones.select(F.explode("z.cells").alias("x")).select(F.lit("cell").alias("part"), "x.metadata.wrap_state", "x.metadata.rendered_complete", F.col("x.metadata.rendered_font_size").alias("font_size"))
    count = lambda c: F.count(F.when(c, 1))
    return fields.unionByName(cells).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), count(F.col("wrap_state")).alias("wrapped"), count(~F.col("wrap_state")).alias("not_wrapped"), count(F.col("rendered_complete")).alias("complete"),
        count(~F.col("rendered_complete")).alias("incomplete"), count((F.col("part") == "cell") & (F.col("font_size") < 18)).alias("small_fonts"),
    )


def gates(joined: DataFrame, marginals: DataFrame, unknowns: DataFrame, absent_from: float = 25, deviates_from: float = 100, share_points: float = 0.02) -> DataFrame:
    """Violations (gate, bucket): a joint bucket that should be there and isn't, one that deviates too far, a marginal share off by more than two points, unknown values."""
    bucket = F.concat_ws(" x ", "first", "third", "second")
    absent = joined.where((F.col("expected") >= absent_from) & (F.col("actual") == 0)).select(F.lit("joint_absent").alias("gate"), bucket.alias("bucket"))
    far = joined.where((F.col("expected") >= deviates_from) & (F.abs("relative") > F.col("allowed"))).select(F.lit("joint_deviation").alias("gate"), bucket.alias("bucket"))
    off = marginals.where((F.col("share") > 0) & (F.abs(F.col("deviation")) / (F.col("expected") / F.col("share")) > share_points)).select(F.lit("marginal_share").alias("gate"), F.col("value").alias("bucket"))
    new = unknowns.select(F.lit("unknown_value").alias("gate"), F.coalesce(F.col("value").cast("string"), F.lit("null")).alias("bucket"))
    return absent.unionByName(far).unionByName(off).unionByName(new)


#: Gates (fixed values): variants that a family needs from so many pages on; codes that count as overlap, truncation and mismatch.
LEAST_VARIANTS, VARIANTS_FROM = 12, 50
RENDERING_GATES = {
    "overlaps": ("form_field_overlap", "glyph_intersection_neighboring_cells", "glyph_intersection_label_value"),
    "truncations": ("rendered_text_truncated", "table_cell_text_truncated", "required_zone_empty"),
    "mismatches": ("table_cell_text_truncated", "rendered_text_mismatch", "rendered_text_outside_cell"),
}


def variant_gate(rows: DataFrame, family: str, variant: str, least: int = LEAST_VARIANTS, from_rows: int = VARIANTS_FROM) -> DataFrame:
    """(gate, bucket): families with enough rows that show too few variants; null and empty variants don't count."""
    found = rows.groupBy(family).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.nullif(F.col(variant).cast("string"), F.lit(""))).alias("variants"))
    return found.where((F.col("n") >= from_rows) & (F.col("variants") < least)).select(F.lit("variants").alias("gate"), F.col(family).cast("string").alias("bucket"))


def coverage_gate(rows: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """(gate, bucket): by column the wanted values that no row has. wanted: a listed handful of values."""
    pairs = rows.sparkSession.createDataFrame([(c, v) for c, values in wanted.items() for v in values], "dimension string, value string")
    have = rows.select(F.inline(F.array(*(F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in wanted)))).distinct()
    return pairs.join(have, ["dimension", "value"], "left_anti").select(F.lit("zero_coverage").alias("gate"), F.concat_ws(":", "dimension", "value").alias("bucket"))


def rendering_gate(issues: DataFrame, small_fonts: DataFrame | None = None) -> DataFrame:
    """(gate, n): how many issues count as overlap, truncation and mismatch, where there are any. issues: code; small_fonts: of rendering(), with small_fonts."""
    kinds = F.array(*(F.when(F.col("code").isin(*codes), F.lit(gate)) for gate, codes in RENDERING_GATES.items()))
    found = issues.select(F.explode(F.array_compact(kinds)).alias("gate")).groupBy("gate").agg(F.count(F.lit(1)).alias("n"))
    if small_fonts is None:
        return found
    return found.unionByName(small_fonts.agg(F.sum("small_fonts").alias("n")).where("n > 0").select(F.lit("small_fonts").alias("gate"), "n"))


def audit_gate(rows: DataFrame, audited: DataFrame, key: str) -> DataFrame:
    """(gate, bucket): rows that the audit hasn't seen."""
    return rows.join(audited.select(key).distinct(), key, "left_anti").select(F.lit("not_audited").alias("gate"), F.col(key).cast("string").alias("bucket"))


def enforce(violations: DataFrame, rows: int, hard: bool) -> None:
    """Raise with the first violations if the gates are hard (public profile, or enough rows)."""
    if hard or rows >= 10_000:
        first = violations.orderBy("gate", "bucket").limit(20).collect()
        if first:
            raise ValueError("gates violated: " + "; ".join(f"{r.gate}: {r.bucket}" for r in first))


def concentration(members: DataFrame, family: str, cluster: str) -> DataFrame:
    """By family the share of its rows in its largest cluster."""
    sizes = members.groupBy(family, cluster).agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(family).agg(F.max("n").alias("largest"), F.sum("n").alias("total")).withColumn("concentration", F.round(F.col("largest") / F.col("total"), 6))
