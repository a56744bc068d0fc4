"""Benchmark decontamination by template canonicalisation.

1. Tokens are canonicalised: lower case without outer punctuation; numbers,
   names (a capital after a token that ends no sentence) and units become the
   typed placeholders NUM, NAME and UNIT, whose values are kept as slots.
2. Windows of ``width`` canonical tokens (a shorter item: all of it) of the benchmark are joined on
   their hash with those of the documents.  Windows with fewer than
   ``least_literal`` tokens that are no placeholder, and whole items of at most
   ``width`` tokens, are plain: joined on their values, without placeholders.
3. Matches of one item on one alignment (position in the document less that in
   the item) must fill the item's slots consistently: one value of the item never
   stands for two of the document.  A re-parameterised question does; a form that
   only looks alike does not.  Where a value clashes, only the windows that hold it
   go, and of those none whose slots are the item's own.
4. Alignments of an item in a document go together while the next is at most ``drift``
   tokens off (words put in or left out).  A document is contaminated by an item if the consistent
   windows of one such run hold a share of ``least_share`` of the item's windows (of all, or of
   those with placeholders, whichever is more), or ``enough`` of them (a passage of 20
   tokens of a long item).  Windows scattered over the document don't add up.

A bitmap of fixed size over the hashes of the benchmark's windows keeps windows
that can't match from leaving the scan; it is exact, as what passes is joined.  Null
or empty texts and items: no match.  Null ids: no match.  Rows
that share an id count as one document or item.  Other columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliomill.llm.common import hashes, mapped, pieces, split_words, stored, word_windows

WIDTH, LEAST_LITERAL, LEAST_SHARE, ENOUGH, DRIFT = 8, 4, 0.5, 13, 4

#: Units and number words (fixed values).
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years percent % $ € £ usd eur dollar dollars euro euros cent cents degree degrees mile miles meter meters metre metres kilometer kilometers liter liters gram grams kilogram kilograms pound pounds watt watts volt volts km/h mph".split())
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split())

LITERAL, NUM, UNIT, NAME = 0, 1, 2, 3
#: Bits of the filter: 2 MB whatever the benchmark's size.
FILTER_BITS = 24

_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
#: For plain windows.
_PLAIN = np.uint64(0x9FB21C651E98DF25)
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?([^\d\s]{0,12})$")
_OUTER = ".,;:!?\"'()[]{}<>«»“”‘’…"
_MARK = [np.uint64(xxhash.xxh64_intdigest(f"\0{k}")) for k in range(4)]


class Tokens:
    """Of all tokens of some texts, one after another: hash of the canonical form, class, hash of the value; and the texts' first tokens."""

    def __init__(self, texts: pa.Array):
        words, at, self.starts = split_words(texts)
        bare = pc.utf8_trim(words, characters=_OUTER)
        low = pc.utf8_lower(bare)
        flags = lambda found: np.asarray(found, bool)
        kind = np.where(flags(pc.is_in(low, value_set=pa.array(sorted(UNITS)))), UNIT, LITERAL).astype(np.int8)
        kind[flags(pc.is_in(low, value_set=pa.array(sorted(NUMBERS))))] = NUM
        for k in np.flatnonzero(flags(pc.match_substring_regex(low, r"\p{Nd}"))).tolist():
            if (m := _NUMBER.match(low[k].as_py())) and (not m[1] or m[1] in UNITS):
                kind[k] = NUM
        capital = flags(pc.utf8_is_upper(pc.utf8_slice_codeunits(bare, 0, 1))) & ~flags(pc.utf8_is_upper(bare)) & (kind == LITERAL) & (np.asarray(pc.utf8_length(bare), np.int64) > 1)
        ends = flags(pc.match_substring_regex(words, r"(?s)[.!?:;]$|[.!?].$"))
        self.value, self.kind = hashes(low)[at], kind[at]
        inside = np.zeros(len(at), bool)
        inside[1:] = ~ends[at[:-1]]
        inside[self.starts[:-1][self.starts[:-1] < len(at)]] = False
        self.kind[capital[at] & inside] = NAME
        self.canonical = self.value.copy()
        for k in (NUM, UNIT, NAME):
            self.canonical[self.kind == k] = _MARK[k]
        self.text = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def windows(self, width: int, least_literal: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place whether a window of that width starts there and doesn't leave its text, and whether it has tokens enough that are no placeholder."""
        n = max(0, len(self.kind) - width + 1)
        literals = np.concatenate([[0], np.cumsum(self.kind == LITERAL)])
        return self.text[:n] == self.text[width - 1 :], literals[width:] - literals[:-width] >= min(least_literal, width)


_ROWS = "id long, pos int, hash long, slots array<bigint>, plain boolean"


class _Windows:
    """Columns of windows: slots are the value hashes of the placeholders in order; a plain window has none."""

    def __init__(self, ids: list[int], tokens: Tokens) -> None:
        self.ids, self.tokens = ids, tokens
        self.columns: tuple[list, ...] = ([], [], [], [], [])

    def add(self, at: np.ndarray, hashes: np.ndarray, width: int, plain: bool) -> None:
        t = self.tokens
        of = t.text[at]
        for p, k, pos, h in zip(at.tolist(), of.tolist(), (at - t.starts[of]).tolist(), hashes[at].view(np.int64).tolist(), strict=True):
            slots = [] if plain else t.value[p : p + width][t.kind[p : p + width] != LITERAL].view(np.int64).tolist()
            for column, x in zip(self.columns, (self.ids[k], pos, h, slots, plain), strict=True):
                column.append(x)

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds, strict=True)], ["id", "pos", "hash", "slots", "plain"])


def item_windows(items: DataFrame, id_col: str, text_col: str, width: int, least_literal: int) -> DataFrame:
    """Rows (id, pos, hash, slots, plain) of all windows; a whole item of at most ``width`` tokens may have both kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in pieces(batch.column(1)):
                tokens = Tokens(texts)
                rows, sizes = _Windows(batch.column(0).to_pylist()[low : low + len(texts)], tokens), np.diff(tokens.starts)
                for w in np.unique(np.minimum(sizes[sizes > 0], width)).tolist():
                    whole, filled = tokens.windows(w, least_literal)
                    here = whole & (np.minimum(sizes, width)[tokens.text[: len(whole)]] == w)
                    short = sizes[tokens.text[: len(whole)]] == w
                    rows.add(np.flatnonzero(here & filled), word_windows(tokens.canonical, w, _BASE), w, False)
                    rows.add(np.flatnonzero(here & (~filled | short)), word_windows(tokens.value, w, _PLAIN), w, True)
                yield rows.batch()

    src = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return mapped(src, run, _ROWS)


def window_filter(found: DataFrame) -> np.ndarray:
    """Bitmap over the top FILTER_BITS bits of the hashes, put together on the executors; at most 2 MB reach the driver."""
    bit = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    words = found.select(F.shiftright(bit, 5).alias("at"), F.expr("shiftleft(1L, cast(%s & 31 as int))" % "shiftrightunsigned(hash, 40)").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for at, bits in words.toLocalIterator():
        out[at] = bits
    return out


def document_windows(docs: DataFrame, id_col: str, text_col: str, held: np.ndarray, widths: list[int], whole: set[int], least_literal: int) -> DataFrame:
    """Windows of the documents that pass the filter, for each width that items have; whole: widths of whole items."""
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value

        def held_at(hashes: np.ndarray) -> np.ndarray:
            top = hashes >> np.uint64(64 - FILTER_BITS)
            return (bitmap[top >> np.uint64(5)] >> (top & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1

        for batch in batches:
            for low, texts in pieces(batch.column(1)):
                tokens = Tokens(texts)
                rows = _Windows(batch.column(0).slice(low, len(texts)).to_pylist(), tokens)
                for w in widths:
                    inside, filled = tokens.windows(w, least_literal)
                    if not inside.any():
                        continue
                    hashes = word_windows(tokens.canonical, w, _BASE)
                    rows.add(np.flatnonzero(held_at(hashes) & inside & filled), hashes, w, False)
                    plain = inside if w in whole else inside & ~filled
                    if plain.any():
                        hashes = word_windows(tokens.value, w, _PLAIN)
                        rows.add(np.flatnonzero(held_at(hashes) & plain), hashes, w, True)
                yield rows.batch()

    src = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return mapped(src, run, _ROWS)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, least_literal: int = LEAST_LITERAL, least_share: float = LEAST_SHARE, enough: int = ENOUGH, drift: int = DRIFT) -> DataFrame:
    """Rows (id, item, n_windows, item_windows, share, exact): documents contaminated by items, with the run of alignments that holds the largest share. exact: all its windows have the item's own values."""
    bench = stored(item_windows(items, item_col, item_text_col, width, least_literal), "items")
    each_size = bench.groupBy("id", "pos").agg(F.max((~F.col("plain")).cast("int")).alias("template"))
    sizes = each_size.groupBy(F.col("id").alias("item")).agg(F.count(F.lit(1)).alias("all"), F.sum("template").alias("templates"))
    short = items.select(F.size(F.filter(F.split(F.col(item_text_col).cast("string"), r"[\x20\x09-\x0D]+"), lambda x: x != "")).alias("n")).where(f"n between 1 and {width}").distinct()
    whole = {r.n for r in short.collect()}  # at most ``width`` of them
    found = document_windows(docs, id_col, text_col, window_filter(bench), sorted({width, *whole}), whole, least_literal)
    on_item = bench.select(F.col("id").alias("item"), F.col("pos").alias("item_pos"), "hash", "plain", F.col("slots").alias("item_slots"))
    hits = stored(found.join(on_item, ["hash", "plain"]).select("id", "item", "item_pos", (F.col("pos") - F.col("item_pos")).alias("shift"), "slots", "item_slots", "plain"), "hits")

    filled = hits.select("id", "item", "shift", F.inline(F.arrays_zip("item_slots", "slots")).alias("was", "is"))
    clash = filled.groupBy("id", "item", "shift", "was").agg(F.min("is").alias("low"), F.max("is").alias("high")).where("low != high").groupBy("id", "item", "shift").agg(F.collect_list("was").alias("clashing"))
    own = F.col("slots") == F.col("item_slots")
    good = hits.join(clash, ["id", "item", "shift"], "left").where(own | F.col("clashing").isNull() | ~F.arrays_overlap("item_slots", "clashing"))
    each = good.groupBy("id", "item", "shift", "item_pos").agg(F.max(own.cast("int")).alias("exact"), F.max((~F.col("plain")).cast("int")).alias("template"), F.max(F.when(~F.col("plain"), own.cast("int"))).alias("template_exact"))
    by_shift = Window.partitionBy("id", "item").orderBy("shift")  # windows of one item in one document
    apart = (F.col("shift") - F.lag("shift").over(by_shift) > drift).cast("int")
    each = each.withColumn("apart", apart).withColumn("run", F.coalesce(F.sum("apart").over(by_shift.rangeBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    each = each.groupBy("id", "item", "run", "item_pos").agg(*(F.max(c).alias(c) for c in ("exact", "template", "template_exact")))
    matched = each.groupBy("id", "item", "run").agg(F.count(F.lit(1)).alias("n"), F.sum("template").alias("n_templates"), F.min("exact").alias("exact"), F.min("template_exact").alias("template_exact"))
    side = lambda n, of, exact: F.struct((F.col(n) / F.nullif(F.col(of), F.lit(0))).alias("share"), F.col(n).alias("n_windows"), F.col(of).alias("item_windows"), F.col(exact).alias("exact"))
    out = matched.join(sizes, "item").withColumn("best", F.greatest(side("n", "all", "exact"), side("n_templates", "templates", "template_exact")))
    out = out.where((F.col("best.share") >= least_share) | (F.col("n") >= enough)).groupBy("id", "item").agg(F.max("best").alias("best")).select("id", "item", "best.*")
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "n_windows", "item_windows", "share", (F.col("exact") == 1).alias("exact"))
