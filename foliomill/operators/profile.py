"""Counting operators: groups, duplicates, characters, words, patterns, percentiles.

All are partial aggregations; none collects a group. Ties of top lists go to the smaller value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomill.functions.text import case_class, line_pattern, or_unknown, trimmed


def group_count(df: DataFrame, *columns: str) -> DataFrame:
    """Rows by columns; null counts as unknown."""
    return df.groupBy(*(or_unknown(F.col(c).cast("string")).alias(c) for c in columns)).agg(F.count(F.lit(1)).alias("n"))


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    """Rows less distinct values, nulls aside."""
    return df.groupBy(column).agg(F.count(column).alias("n")).agg(F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("n") - 1)), F.lit(0)).cast("long").alias("duplicates"))


def character_counts(df: DataFrame, column: str, characters: str) -> DataFrame:
    """Occurrences of each character, zeros left out; one pass, no row per character."""
    found = [F.sum(F.length(column) - F.length(F.replace(F.col(column), F.lit(c)))).cast("long").alias(str(k)) for k, c in enumerate(characters)]
    pairs = F.array(*(F.struct(F.lit(c).alias("character"), F.col(str(k)).alias("n")) for k, c in enumerate(characters)))
    return df.agg(*found).select(F.inline(pairs)).where("n > 0")


def duplicate_groups(df: DataFrame, text: str) -> DataFrame:
    """Texts that occur more than once, by SHA-256: n and excess. Blank texts are left out."""
    return df.where(F.trim(text) != "").groupBy(F.sha2(text, 256).alias("digest")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("excess", F.col("n") - 1)


def top(df: DataFrame, value: str, k: int, least: int = 1, by: tuple[str, ...] = ()) -> DataFrame:
    """The k most frequent values, overall or by columns; ties go to the smaller value."""
    counted = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    order = [F.desc("n"), F.asc(value)]
    if not by:
        return counted.orderBy(*order).limit(k)
    return counted.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def repeats_by(df: DataFrame, by: str, value: str) -> DataFrame:
    """By column: sum of (count - 1) over values that occur more than once."""
    return df.groupBy(by, value).agg(F.count(F.lit(1)).alias("n")).where("n > 1").groupBy(by).agg(F.sum(F.col("n") - 1).alias("repeats"))


def entropy(counts: DataFrame, by: tuple[str, ...] = (), n: str = "n", places: int | None = 4) -> DataFrame:
    """Shannon entropy in bits and effective cardinality of counts: log2(N) - sum(n log2 n) / N."""
    total, weighted = F.sum(n).cast("double"), F.sum(F.col(n) * F.log2(F.col(n)))
    value = F.when(total > 0, F.log2(total) - weighted / total).otherwise(0.0)
    value = F.abs(F.round(value, places)) if places is not None else value
    return counts.where(F.col(n) > 0).groupBy(*by).agg(value.alias("entropy")).withColumn("effective", F.round(F.pow(F.lit(2.0), "entropy"), places or 4))


def field_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """By field: count, distinct values, their ratio, entropy, and the five most frequent values with their counts (ties to the smaller value)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("n"))
    sums = counts.groupBy(by).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct_values"))
    best = counts.withColumn("_place", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), value))).where("_place <= 5")
    best = best.groupBy(by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", value, "n"))), lambda x: F.struct(x[value].alias("value"), x["n"].alias("n"))).alias("top_values"))
    return sums.withColumn("unique_ratio", F.round(F.col("distinct_values") / F.col("total"), 4)).join(entropy(counts, (by,)).drop("effective"), by).join(best, by)


def routed_field(role: Column, key: Column, value: Column) -> Column:
    """One of eight logical fields of a value, by its zone's role or its key; null if none."""
    has = lambda *parts: key.rlike("|".join(parts))
    by_key = (
        F.when(has("status"), F.lit(None).cast("string")).when(has("name") | (key == "applicant"), "person_name").when(has("organization", "company"), "organization")
        .when(has("department") | (key == "office"), "department").when(has("address"), "address").when(has("subject", "topic") | key.isin("request_type", "request_summary"), "subject")
        .when(has("number", "id"), "document_number").when(has("date"), "date").when(has("note") | (F.length(value) > 40), "long_note")
    )
    by_role = F.when(role == "sender_block", "organization").when(role.isin("recipient_block", "signature_zone"), "person_name").when(role == "date", "date").when(role == "ref_number", "document_number")
    return F.when(key.isNull(), by_role).otherwise(by_key)


def lines_of(df: DataFrame, text: str, *keep: str, longer_than: int = 0) -> DataFrame:
    """One row per trimmed line longer than that."""
    lines = F.filter(F.transform(F.split(text, "\n"), trimmed), lambda t: F.length(t) > longer_than)
    return df.select(*keep, F.explode(lines).alias("line"))


def table_rows(pages: DataFrame) -> DataFrame:
    """Of nested pages the table rows below the head, cells in their order joined by space-bar-space."""
    cells = pages.select("page_id", F.inline(F.transform("zones", lambda z: F.struct(z["zone_id"].alias("zone_id"), z["cells"].alias("cells")))))
    rows = cells.select("page_id", "zone_id", F.posexplode("cells").alias("at", "cell")).where("cell.row > 0")
    ordered = F.array_sort(F.collect_list(F.struct("at", F.trim("cell.text").alias("text"))))
    return rows.groupBy("page_id", "zone_id", F.col("cell.row").alias("row")).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " | ").alias("text")).where("text != ''")


def repeat_violations(df: DataFrame, by: str, title: str, most: int = 3, share: float = 0.05) -> DataFrame:
    """Titles that occur more than ``most`` times or in more than that share of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    counted = df.groupBy(by, title).agg(F.count(F.lit(1)).alias("n"))
    return counted.crossJoin(F.broadcast(total)).withColumn("ratio", F.round(F.col("n") / F.col("total"), 4)).where((F.col("n") > most) | (F.col("n") / F.col("total") > share)).drop("total")  # one row


def characters(df: DataFrame, text: str, by: str) -> DataFrame:
    """Counts of characters by column and case class."""
    counted = df.select(by, F.explode(F.split(text, "")).alias("character")).where("character != ''").groupBy(by, "character").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("class", case_class(F.col("character")))


def letter_ngrams(df: DataFrame, text: str, by: str, k: int) -> DataFrame:
    """Counts of k letters in a row by column: what a look ahead sees from each place."""
    grams = F.regexp_extract_all(F.col(text), F.lit(r"(?=(\p{L}{%d}))" % k), F.lit(1))
    return df.select(by, F.explode(grams).alias("gram")).groupBy(by, "gram").agg(F.count(F.lit(1)).alias("n"))


def word_cardinality(df: DataFrame, text: str, by: str) -> DataFrame:
    """By column: words, distinct words, ratio. Words are cut at white space, stripped of all but word characters, in lower case."""
    bare = F.lower(F.regexp_replace("raw", r"[^\p{L}\p{M}\p{N}_]", ""))
    words = df.select(by, F.explode(F.split(text, r"\s+")).alias("raw")).select(by, bare.alias("word")).where("word != ''")
    counted = words.groupBy(by, "word").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(by).agg(F.sum("n").alias("total_words"), F.count(F.lit(1)).alias("unique_words")).withColumn("ratio", F.round(F.col("unique_words") / F.col("total_words"), 4))


def line_patterns(df: DataFrame, text: str) -> DataFrame:
    """Counts of line patterns (digits 0, letters A)."""
    return df.select(F.explode(F.split(text, "\n")).alias("line")).where("line != ''").groupBy(line_pattern(F.col("line")).alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def percentiles(df: DataFrame, value: str, by: str, at: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Exact percentiles with linear interpolation."""
    return df.groupBy(by).agg(F.count(value).alias("n"), *(F.percentile(value, p).alias(f"p{round(100 * p)}") for p in at))


def best_run(runs: DataFrame) -> DataFrame:
    """Of benchmark runs: without failures if there are any such, with at most max(4096, twice the least) MB, then the fastest, leanest, quickest, smallest."""
    clean = runs.where("failure_rate = 0")
    runs = runs.join(F.broadcast(clean.agg(F.count(F.lit(1)).alias("_clean"))), how="cross").where("_clean = 0 or failure_rate = 0").drop("_clean")  # one row
    limit = runs.agg(F.greatest(F.lit(4096.0), 2 * F.min("peak_rss_mb")).alias("_limit"))
    fit = runs.join(F.broadcast(limit), how="cross").where("peak_rss_mb <= _limit").drop("_limit")  # one row
    return fit.orderBy(F.desc("throughput_pages_per_sec"), "p95_latency_sec", "peak_rss_mb", "worker_count").limit(1)


def rejection_reasons(pages: DataFrame) -> DataFrame:
    """Pages' issues of severity error, by code."""
    return pages.select(F.inline("qa_issues")).where("severity = 'error'").groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def ratio_gate(df: DataFrame, condition: Column, over: Column, least_rows: int, least_over: int, low: float, high: float) -> DataFrame:
    """Share of condition overall and within ``over``, and whether both pass, which too few rows do."""
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(over, 1)).alias("over"), F.avg(F.when(condition, 1.0).otherwise(0.0)).alias("share"), F.avg(F.when(over, F.when(condition, 1.0).otherwise(0.0))).alias("share_over"))
    return found.withColumn("passed", (F.col("rows") < least_rows) | ((F.col("share") <= low) & ((F.col("over") < least_over) | (F.col("share_over") <= high))))


def character_coverage(df: DataFrame, text: str, characters: str, share: float = 0.04, least: int = 3, least_rows: int = 100) -> DataFrame:
    """Occurrences of each required character, and whether they reach max(least, ceil(share * rows)); fewer rows than least_rows pass."""
    found = [F.coalesce(F.sum(F.length(text) - F.length(F.replace(F.col(text), F.lit(c)))), F.lit(0)).cast("long").alias(str(k)) for k, c in enumerate(characters)]
    pairs = F.array(*(F.struct(F.lit(c).alias("character"), F.col(str(k)).alias("n")) for k, c in enumerate(characters)))
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *found).select("rows", F.inline(pairs))
    needed = F.greatest(F.lit(least), F.ceil(F.col("rows") * share))
    return counted.withColumn("needed", needed.cast("long")).withColumn("passed", (F.col("rows") < least_rows) | (F.col("n") >= F.col("needed")))


def page_duplicates(pages: DataFrame, most: int = 4, least_text: int = 3, least_body: int = 32, ignored: tuple[str, ...] = ("sequence", "date", "amount", "department", "score", "status")) -> DataFrame:
    """Texts that one page holds more than ``most`` times: lines of body zones from least_body characters, others from least_text; value types that repeat by nature aside."""
    kind = lambda z: F.when(z["zone_type"].isin("body", "paragraph"), "body_line").otherwise("text")
    none = F.array().cast("array<struct<text:string,kind:string>>")
    lines = lambda z: F.coalesce(F.transform(z["lines"], lambda x: F.struct(F.trim(x["text"]).alias("text"), kind(z).alias("kind"))), none)
    cells = lambda z: F.coalesce(F.transform(z["cells"], lambda x: F.struct(F.trim(x["text"]).alias("text"), F.coalesce(x["metadata"]["value_type"], F.lit("None")).alias("kind"))), none)
    rows = pages.select("page_id", F.inline(F.flatten(F.transform("zones", lambda z: F.concat(lines(z), cells(z)))))).where("text != ''")
    long = F.length("text") > F.when(F.col("kind") == "body_line", least_body).otherwise(least_text)
    return rows.where(long & ~F.col("kind").isin(*ignored)).groupBy("page_id", "text", "kind").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
