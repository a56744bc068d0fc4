"""MinHash near-duplicates: universal hash minima, banding, verification, components.

1. Each text becomes its set of distinct 5-word shingles and BANDS * ROWS minima
   of universal hashes.  Texts with equal sets are one class; only the first of a
   class in a task carries band keys.
2. Documents that share a band key are compared with the smallest id of that
   key, first by signature, then on their full shingle sets: a star for each
   bucket, never all pairs of it.  The pair with the best signature of each
   document is confirmed first; of the rest, only pairs whose ends are still apart.
3. The smallest id of a large family may be one of those least like the rest.
   Buckets whose members are still in different components after that get
   another centre, drawn for each bucket, SPREADS times; as a document is in many
   buckets, it meets many centres.
4. Members of a bucket that are even then in different components are
   compared with each other where their rarest shingles allow a link, so that no
   link in a bucket is lost and no pairs are made of those that are merely alike.
5. Components come from alternating large-star and small-star.

With 45 bands of 5 rows a pair at similarity 0.75 shares no band with
probability 5e-6, at 0.8 with 2e-8.  The signature test lets all pairs pass that are within
six standard deviations of the threshold.

Null or blank text: empty set, linked with nothing.  Null id: never a link's end;
component null, kept.  Rows that share an id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import Remembered, dropped, mapped, mixed, split_join, starts_of, stored
from foliomill.llm.components import components
from foliomill.llm.shingles import digest, shingle_set, similar

BANDS, ROWS, PERCENT, SPREADS = 45, 5, 75, 2
#: Signatures that agree in a smaller share are not compared on full sets.
LEAST_AGREEMENT = PERCENT / 100 - 6 * (PERCENT / 100 * (1 - PERCENT / 100) / (BANDS * ROWS)) ** 0.5

_random = np.random.default_rng(20240229)
_A = _random.integers(1, 2**64, BANDS * ROWS, dtype=np.uint64, endpoint=False) | np.uint64(1)
_B = _random.integers(0, 2**64, BANDS * ROWS, dtype=np.uint64, endpoint=False)
_BAND = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_TOGETHER = 24_000


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix: for each non-empty set, the minima of all hashes."""
    out = np.empty((len(_A), len(sets)), dtype=np.uint64)
    first = 0
    while first < len(sets):
        last, held = first, 0
        while last < len(sets) and (last == first or held + len(sets[last]) <= _TOGETHER):
            held += len(sets[last])
            last += 1
        x = np.concatenate(sets[first:last])
        starts = starts_of(np.fromiter(map(len, sets[first:last]), np.int64, last - first))[:-1]
        y = np.empty_like(x)
        for k in range(len(_A)):
            np.multiply(x, _A[k], out=y)
            np.add(y, _B[k], out=y)
            np.minimum.reduceat(y, starts, out=out[k, first:last])
        first = last
    return out.T


def band_keys(found: np.ndarray) -> np.ndarray:
    """Matrix of band keys from minima."""
    parts = found.reshape(len(found), BANDS, ROWS)
    key = np.broadcast_to(_BAND, (len(found), BANDS)).copy()
    for k in range(ROWS):
        key = mixed(key * np.uint64(0xD1342543DE82EF95) + parts[:, :, k])
    return key


def signature(found: np.ndarray) -> np.ndarray:
    """One byte of each minimum."""
    return mixed(found.copy()).astype(np.uint8)


def sketches(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, digest of the set, band keys and signature (null for all but the first of equal sets in a task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for low in range(0, len(ids), 200):
                sets = [shingle_set(t) for t in texts.slice(low, 200).to_pylist()]
                digests = [digest(s) for s in sets]
                new = []
                for k, d in enumerate(digests):
                    if d is not None and d not in seen and ids[low + k] is not None:
                        if len(seen) >= 500_000:
                            seen.clear()
                        seen.add(d)
                        new.append(k)
                keys: list = [None] * len(sets)
                sigs: list = [None] * len(sets)
                if new:
                    found = minima([sets[k] for k in new])
                    for k, key, sig in zip(new, band_keys(found).view(np.int64), signature(found), strict=True):
                        keys[k], sigs[k] = key, sig.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, 200), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    ["id", "n_shingles", "digest", "keys", "sig"],
                )

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return mapped(src, run, "id long, n_shingles long, digest binary, keys array<bigint>, sig binary")


def agreeing(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """pairs (a, b) whose signatures agree often enough, with that share. Many pairs may have one b: the join is split by Spark where it is skewed."""
    sigs = sketch.where("sig is not null").select("id", "sig")
    x = pairs.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    x = x.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b").select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                a, b = (np.frombuffer(b"".join(t.column(k).to_pylist()), np.uint8).reshape(t.num_rows, -1) for k in (2, 3))
                share = (a == b).mean(axis=1)
                near = share >= LEAST_AGREEMENT
                yield pa.RecordBatch.from_arrays([t.column(0).filter(near), t.column(1).filter(near), pa.array(share[near])], ["a", "b", "share"])

    return mapped(x, run, "a long, b long, share double")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """pairs (a, b) whose full shingle sets are similar. texts: id, text."""
    x = pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    x = x.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = Remembered(shingle_set, most=8, longest=1 << 20)
        for t in batches:
            yes = pa.array([similar(shingle_set(p), last[q], percent) for p, q in zip(t.column(2).to_pylist(), t.column(3).to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column(0).filter(yes), t.column(1).filter(yes)], ["a", "b"])

    return mapped(x, run, "a long, b long")


def texts_of(df: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text of these ids (column id, distinct); the ids' side is hashed, so texts aren't sorted."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(ids.hint("shuffle_hash"), "id", "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def _apart(pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """pairs whose ends are in different components."""
    of = lambda c: stars.select(F.col("a").alias(c), F.col("b").alias(f"of_{c}"))
    x = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return x.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of df: id, n_shingles, component_id (the smallest id of the component), kept. Nulls and ties: see the module."""
    sketch = stored(sketches(df, id_col, text_col), "sketch")
    small = sketch.where("id is not null and digest is not null").select("id", "digest")
    copies = small.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("far")).where("rep != far").drop("far")
    moved = stored(split_join(small, copies, "digest").where("id != rep").select("id", "rep").distinct(), "copies")

    bands = sketch.where("keys is not null").select("id", F.explode("keys").alias("key"))
    heads = bands.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("far")).where("head != far").drop("far")
    hits = stored(split_join(bands, heads, "key").where("id != head"), "buckets")

    as_rep = lambda c: moved.select(F.col("id").alias(c), F.col("rep").alias(f"rep_{c}"))
    pairs = hits.select(F.col("id").alias("a"), F.col("head").alias("b")).distinct()
    pairs = agreeing(pairs, sketch).join(as_rep("a"), "a", "left").join(as_rep("b"), "b", "left")
    pairs = pairs.select(F.coalesce("rep_a", "a").alias("a"), F.coalesce("rep_b", "b").alias("b"), "share").where("a != b")
    pairs = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), "share").distinct(), "pairs")
    texts = stored(texts_of(df, _ends(pairs), id_col, text_col), "texts")
    stars = joined_up(pairs, None, texts, percent)
    for turn in range(SPREADS):
        stars = spread(df, sketch, hits, moved, stars, turn, id_col, text_col, percent)

    rest = stored(still_apart(df, sketch, hits, moved, stars, id_col, text_col, percent), "apart")
    rest = agreeing(rest, signatures_of_reps(sketch, moved)).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    rest = stored(rest.join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        stars = components(stars.unionByName(confirmed(rest, texts_of(df, _ends(rest), id_col, text_col), percent)))

    dropped(hits, pairs, texts, rest)
    of_copies = moved.join(stars.select(F.col("a").alias("rep"), F.col("b").alias("of")), "rep", "left").select("id", F.coalesce("of", "rep").alias("of"))
    of_reps = stars.select(F.col("a").alias("id"), F.col("b").alias("of"))
    component = of_copies.unionByName(of_reps).groupBy("id").agg(F.min("of").alias("component_id"))
    out = sketch.select("id", "n_shingles").join(component, "id", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def joined_up(pairs: DataFrame, stars: DataFrame | None, texts: DataFrame, percent: int) -> DataFrame:
    """Components with the links among pairs (a, b, share): the likeliest pair of each a is confirmed first, then those whose ends are still apart."""
    best = pairs.groupBy("a").agg(F.max(F.struct("share", (-F.col("b")).alias("b"))).alias("x")).select("a", (-F.col("x.b")).alias("b"))
    links = confirmed(best, texts, percent)
    stars = components(links if stars is None else stars.unionByName(links))
    return components(stars.unionByName(confirmed(_apart(pairs.select("a", "b"), stars), texts, percent)))


def bucket_members(hits: DataFrame, moved: DataFrame, stars: DataFrame) -> DataFrame:
    """(key, id, of) of bucket members, heads aside, in buckets whose members are in different components."""
    members = hits.select("key", "id").join(moved, "id", "left").select("key", F.coalesce("rep", "id").alias("id")).distinct()
    members = members.join(stars.select(F.col("a").alias("id"), F.col("b").alias("of")), "id", "left").select("key", "id", F.coalesce("of", "id").alias("of"))
    open_keys = members.groupBy("key").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low != high").select("key")
    return split_join(members, open_keys, "key")


def spread(df: DataFrame, sketch: DataFrame, hits: DataFrame, moved: DataFrame, stars: DataFrame, turn: int, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Components after members of open buckets were compared with a centre that is drawn for each bucket: one pair for each member, whatever the bucket's size."""
    opened = stored(bucket_members(hits, moved, stars), "opened")
    drawn = F.min(F.struct(F.xxhash64("id", "key", F.lit(turn)).alias("h"), "id", "of")).alias("c")
    centres = opened.groupBy("key").agg(drawn).select("key", F.col("c.id").alias("centre"), F.col("c.of").alias("centre_of"))
    pairs = split_join(opened, centres, "key").where("of != centre_of").select(F.col("id").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = stored(agreeing(pairs, signatures_of_reps(sketch, moved)), "spread")
    if not pairs.isEmpty():
        texts = stored(texts_of(df, _ends(pairs), id_col, text_col), "texts")
        stars = joined_up(pairs, stars, texts, percent)
        dropped(texts)
    dropped(opened, pairs)
    return stars


def signatures_of_reps(sketch: DataFrame, moved: DataFrame) -> DataFrame:
    """Signatures by class representative."""
    x = sketch.where("sig is not null").select("id", "sig").join(moved, "id", "left")
    return x.select(F.coalesce("rep", "id").alias("id"), "sig").dropDuplicates(["id"])


def set_rows(texts: DataFrame) -> DataFrame:
    """id and shingle set of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t).view(np.int64) for t in batch.column(1).to_pylist()], pa.list_(pa.int64()))], ["id", "s"])

    return mapped(texts, run, "id long, s array<bigint>")


def still_apart(df: DataFrame, sketch: DataFrame, hits: DataFrame, moved: DataFrame, stars: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Pairs (a, b) of bucket members, heads aside, that are in different components and may be similar: none that is similar is left out.

    A bucket of many documents that are somewhat, but not enough, alike would make
    pairs with the square of its size.  So members are paired by prefix instead: with
    shingles ordered by how many members have them, rarest first, two sets with the
    required overlap share one that leaves at least that overlap from its place on
    in both.  A document's prefix is cut by the smallest size in its buckets.
    Shingles that one component alone has in its prefixes make no pairs.
    """
    sizes = sketch.where("id is not null").groupBy("id").agg(F.max("n_shingles").alias("n"))
    opened = stored(bucket_members(hits, moved, stars).join(sizes, "id"), "open")
    least = opened.groupBy("key").agg(F.min("n").alias("least"))
    who = split_join(opened, least, "key").groupBy("id").agg(F.min("of").alias("of"), F.min("least").alias("least"))
    # required overlap: percent / (100 + percent) of both sizes together; the smaller size is percent of the larger at least
    other = F.greatest(F.col("least"), F.ceil(F.col("n") * percent / 100))
    sets = set_rows(texts_of(df, who.select("id"), id_col, text_col)).join(who, "id").withColumn("n", F.size("s"))
    sets = stored(sets.withColumn("prefix", F.col("n") - F.ceil((F.col("n") + other) * percent / (100 + percent)) + 1), "sets")
    elements = sets.select("id", F.explode("s").alias("h"))
    common = elements.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # shingles that no other member has come first; they only take up places
    ordered = split_join(elements, common, "h").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("x"))
    x = sets.select("id", "of", "n", "prefix").join(ordered, "id").withColumn("alone", F.col("n") - F.size("x"))
    places = F.col("prefix") - F.col("alone")
    probes = x.where(places > 0).select("id", "of", "n", "alone", F.posexplode(F.slice("x", F.lit(1), places.cast("int"))).alias("at", "y"))
    probes = stored(probes.select("id", "of", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left_over"), F.col("y.h").alias("h")), "probes")
    shared = probes.groupBy("h").agg(F.min("of").alias("low"), F.max("of").alias("high")).where("low != high").select("h")
    probes = split_join(probes, shared, "h")
    a, b = (probes.select("h", *(F.col(c).alias(f"{c}_{side}") for c in ("id", "of", "n", "left_over"))) for side in ("a", "b"))
    needed = (F.col("n_a") + F.col("n_b")) * percent
    enough = (F.col("left_over_a") * (100 + percent) >= needed) & (F.col("left_over_b") * (100 + percent) >= needed)
    return a.join(b, "h").where((F.col("of_a") > F.col("of_b")) & enough).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
