"""Exact, near and perceptual duplicates."""

from __future__ import annotations

import binascii
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.hashing import hamming, hamming_wide
from foliomill.functions.text import masked_digits, normalized, shingles, split_words, tokens
from foliomill.operators import graph
from foliomill.storage import stored
from foliomill.workers import ship


def similarity_shingles(text: Column, k: int = 4) -> Column:
    """k-word shingles of the normalized text, digits masked."""
    return shingles(split_words(similarity_text(text)), k)


def similarity_text(text: Column) -> Column:
    """The normalized text, digits masked."""
    return masked_digits(normalized(text))


def candidate_shingles(text: Column, k: int = 4) -> Column:
    """k-word shingles of the normalized text as it stands."""
    return shingles(split_words(normalized(text)), k)


def token_shingles(text: Column, k: int = 5) -> Column:
    """k-token shingles joined by U+001F."""
    return shingles(tokens(text), k, "\x1f")


def hashed_sets(df: DataFrame, key: str, sets: Column) -> DataFrame:
    """(id, n, s, digest): sets of strings as sorted distinct 64-bit hashes, and a digest of all of them; empty sets aside."""
    x = df.select(F.col(key).alias("id"), F.array_sort(F.array_distinct(F.transform(sets, lambda e: F.xxhash64(e)))).alias("s")).where(F.size("s") > 0)
    return x.select("id", F.size("s").alias("n"), "s", F.md5(F.array_join(F.transform("s", lambda h: h.cast("string")), ",")).alias("digest"))


#: Factors of the mix of word hashes (fixed values).
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _shingle_hashes(words: list[int], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of k words in a row, of all if there are fewer, from the words' hashes."""
    w = np.array(words, np.uint64)
    k = min(k, len(w))
    x = np.full(len(w) - k + 1, k, np.uint64)
    for at in range(k):
        x = (x ^ w[at : at + len(x)]) * np.uint64(MIX[0])
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
        x ^= x >> np.uint64(31)
    return np.unique(x.view(np.int64))


def hashed_shingles(df: DataFrame, key: str, text: Column, k: int) -> DataFrame:
    """As hashed_sets(), of the k-word shingles of a normalized text: a shingle's hash is mixed from its words' 64-bit hashes, in Arrow batches."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}

        def hashed(word: str) -> int:
            if (h := known.get(word)) is None:
                if len(known) >= 200_000:
                    known.clear()
                h = known[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
            return h

        for b in batches:
            # a batch's sets may be larger than its texts, so it goes out in parts
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = [[w for w in (t or "").split(" ") if w] for t in part.column(1).to_pylist()]
                full = [n for n, t in enumerate(texts) if t]
                sets = [_shingle_hashes([hashed(w) for w in texts[n]], k) for n in full]
                offsets = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int64), *sets])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(full, pa.int64())), pa.array([len(s) for s in sets], pa.int32()), lists, pa.array([hashlib.md5(s.tobytes()).hexdigest() for s in sets], pa.string())],
                    ["id", "n", "s", "digest"],
                )

    src = df.select(F.col(key).alias("id"), text.alias("t"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n int, s array<bigint>, digest string")


def similar_pairs(df: DataFrame, key: str, sets: Column, threshold: float) -> DataFrame:
    """All pairs (a, b, score), a < b, of Jaccard similarity of at least threshold: exact, by prefix filtering.

    Elements are ordered by how rare they are; two similar sets share one of the
    first n - ceil(threshold * n) + 1 elements, from which on both still have the
    overlap that they need, so only those are joined. Elements are 64-bit hashes. Equal
    sets are found by digest first, and pairs are made of one of each.
    """
    return pairs_of_sets(stored(hashed_sets(df, key, sets), "sets"), threshold)


def pairs_of_sets(rows: DataFrame, threshold: float) -> DataFrame:
    """rows: as of hashed_sets(), stored."""
    reps = rows.groupBy("digest").agg(F.min("id").alias("id")).select("id")
    classes = stored(rows.drop("digest").join(reps, "id", "left_semi").dropDuplicates(["id"]).withColumnRenamed("id", "rep"), "classes")  # read four times below
    elements = classes.select("rep", "n", F.explode("s").alias("e"))
    frequency = elements.groupBy("e").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    ordered = elements.join(frequency, "e").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "e"))).alias("x"))
    # elements that no other set has come first in the order; they never meet another
    alone = F.col("n") - F.size("x")
    prefix = F.col("n") - F.ceil(F.col("n") * threshold) + 1 - alone
    probes = ordered.where(prefix > 0).select("rep", "n", alone.alias("alone"), F.posexplode(F.slice("x", F.lit(1), prefix.cast("int"))).alias("at", "x"))
    probes = probes.select("rep", "n", (F.col("n") - F.col("alone") - F.col("at")).alias("left_over"), "x.e")
    a, b = probes.alias("a"), probes.alias("b")
    needed = (F.col("a.n") + F.col("b.n")) * (threshold / (1 + threshold)) - 1e-6
    sizes = (F.col("a.n") >= threshold * F.col("b.n")) & (F.col("b.n") >= threshold * F.col("a.n")) & (F.col("a.left_over") >= needed) & (F.col("b.left_over") >= needed)
    pairs = a.join(b, (F.col("a.e") == F.col("b.e")) & (F.col("a.rep") < F.col("b.rep")) & sizes).select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()
    left = classes.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    right = classes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").withColumn("score", both / (F.col("na") + F.col("nb") - both)).where(F.col("score") >= threshold).select("a", "b", "score")


def equal_links(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Edges from each row to the smallest id with an equal value; null and empty values aside."""
    return graph.linked(df.select(F.col(key).alias("id"), value.alias("link")).where("link is not null"))


def near_duplicate_clusters(df: DataFrame, key: str, text: str, threshold: float = 0.85) -> DataFrame:
    """Every row with its component under similarity of masked 4-word shingles; rows without words are one cluster."""
    return clusters_of_sets(df, key, similarity_shingles(F.col(text)), threshold)


def clusters_of_sets(df: DataFrame, key: str, sets: Column, threshold: float) -> DataFrame:
    """Every row with its component under similarity of sets; rows with empty sets are one cluster."""
    rows = stored(hashed_sets(df, key, sets), "sets")
    empty = graph.linked(df.select(F.col(key).alias("id"), F.lit("").alias("link"), sets.alias("s")).where(F.size("s") == 0).drop("s"))
    edges = empty.unionByName(graph.linked(rows.select("id", F.col("digest").alias("link")))).unionByName(pairs_of_sets(rows, threshold).select("a", "b"))
    return graph.labelled(df.select(key).distinct(), edges, key)


def one_of_each(df: DataFrame, key: str, value: Column) -> DataFrame:
    """df with one row, that of the smallest key, for each value: copies make no candidates."""
    first = df.groupBy(F.sha2(value.cast("string"), 256).alias("_value")).agg(F.min(key).alias(key)).select(key)
    return df.join(first, key, "left_semi")


def confirmed_pairs(pairs: DataFrame, df: DataFrame, key: str, sets: Column, threshold: float) -> DataFrame:
    """Candidate pairs (a, b) whose sets have that Jaccard similarity at least, with it."""
    rows = hashed_sets(df, key, sets)
    x = pairs.select("a", "b").distinct().join(rows.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa")), "a").join(rows.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    return x.withColumn("score", both / (F.col("na") + F.col("nb") - both)).where(F.col("score") >= threshold).select("a", "b", "score")


def minhash(df: DataFrame, key: str, sets: Column, slots: int = 64) -> DataFrame:
    """(id, signature) of classic MinHash with one 64-bit hash for each slot, in built-in functions."""
    x = df.select(F.col(key).alias("id"), F.explode(sets).alias("e"))
    return x.groupBy("id").agg(*(F.min(F.xxhash64(F.lit(k), "e")).alias(f"m{k}") for k in range(slots))).select("id", F.array(*(f"m{k}" for k in range(slots))).alias("signature"))


#: The largest prime below 2 ** 31 (a fixed value): products of two numbers below it fit a long.
PRIME = (1 << 31) - 1


def universal_minhash(df: DataFrame, key: str, sets: Column, slots: int = 128, seed: int = 1) -> DataFrame:
    """(id, signature) of classic MinHash: slot k is the least (a_k * x + b_k) mod a prime over the elements' 31-bit hashes x, in built-in functions and one aggregation."""
    r = np.random.default_rng(seed)
    a, b = r.integers(1, PRIME, slots).tolist(), r.integers(0, PRIME, slots).tolist()
    x = df.select(F.col(key).alias("id"), F.explode(sets).alias("e")).select("id", F.pmod(F.xxhash64("e"), F.lit(PRIME).cast("long")).alias("x"))
    least = [F.min((F.col("x") * F.lit(a[k]).cast("long") + F.lit(b[k]).cast("long")) % F.lit(PRIME).cast("long")).alias(f"m{k}") for k in range(slots)]
    return x.groupBy("id").agg(*least).select("id", F.array(*(f"m{k}" for k in range(slots))).alias("signature"))


def one_permutation(df: DataFrame, key: str, sets: Column, slots: int = 64) -> DataFrame:
    """(id, signature): one hash picks the slot, a second the value; empty slots are filled from the next one that isn't."""
    if slots <= 0 or slots & (slots - 1):
        raise ValueError("slots must be a positive power of two")
    ship(df.sparkSession)

    def signature(elements: list[str]) -> list[int]:
        raw = [e.encode() for e in elements]
        at = np.array([binascii.crc32(r) for r in raw], np.int64) & (slots - 1)
        value = np.array([binascii.crc32(r, 0x9E3779B9) for r in raw], np.int64)
        out = np.full(slots, 2**32 - 1, np.int64)
        np.minimum.at(out, at, value)
        full = np.flatnonzero(out < 2**32 - 1)
        if len(full) and len(full) < slots:
            empty = np.flatnonzero(out == 2**32 - 1)
            away = (full[None, :] - empty[:, None]) % slots
            near = away.argmin(axis=1)
            out[empty] = (out[full[near]] + away[np.arange(len(empty)), near] * 0x9E3779B1) & 0xFFFFFFFF
        return out.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([signature(s or []) for s in b.column(1).to_pylist()], pa.list_(pa.int64()))], ["id", "signature"])

    src = df.select(F.col(key).alias("id"), sets.alias("s"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, signature array<bigint>")


def band_pairs(signatures: DataFrame, bands: int = 16, rows: int = 4) -> DataFrame:
    """Candidate pairs (a, b), a < b, that agree in all slots of a band; distinct. No cap on a band's bucket: give one row of each copy (one_of_each)."""
    keys = F.array(*(F.xxhash64(F.lit(k), F.slice("signature", k * rows + 1, rows)) for k in range(bands)))
    banded = signatures.select("id", "signature", F.posexplode(keys).alias("band", "key"))
    a, b = banded.alias("a"), banded.alias("b")
    x = a.join(b, (F.col("a.band") == F.col("b.band")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id")))
    agree = F.size(F.filter(F.zip_with("a.signature", "b.signature", lambda p, q: p == q), lambda e: e)) / F.size("a.signature")
    return x.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.round(agree, 4).alias("score")).distinct()


def _part_choices(most: int) -> tuple[int, list[tuple[int, ...]]]:
    """Number of parts of a hash, and the choices of parts of which one must be equal if at most ``most`` bits differ: of most + k parts, k at least are."""
    k = 3 if most <= 4 else 2 if most <= 9 else 1
    return most + k, list(itertools.combinations(range(most + k), k))


def hamming_pairs(df: DataFrame, key: str, value: str, most: int, block: tuple[str, ...] = (), bits: int = 64) -> DataFrame:
    """All pairs (a, b, distance) of 64-bit hashes at most that far apart, exactly.

    A hash has more parts than bits may differ, so several parts are equal; hashes are joined on each
    choice of as many parts, which are long keys that few hashes share. Bit i is in part i mod the number of parts.
    Equal hashes are put together first (of each block), so that a common hash makes no pairs with itself.
    """
    if not 0 <= most < bits:
        raise ValueError("distance must be from 0 to the width less one")
    reps = df.where(F.col(value).isNotNull()).groupBy(*block, F.col(value).alias("hash")).agg(F.min(key).alias("id"))
    n, choices = _part_choices(most)
    masks = [sum(1 << i for i in range(bits) if i % n in c) for c in choices]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    parts = F.array(*(F.col("hash").bitwiseAND(F.lit(m).cast("long")) for m in signed))
    probes = reps.select(*block, "id", "hash", F.posexplode(parts).alias("part", "bits"))
    a, b = probes.alias("a"), probes.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in block]
    on = (F.col("a.part") == F.col("b.part")) & (F.col("a.bits") == F.col("b.bits")) & (F.col("a.id") < F.col("b.id")) & (hamming(F.col("a.hash"), F.col("b.hash")) <= most)
    for c in same:
        on = on & c
    x = a.join(b, on).withColumn("distance", hamming(F.col("a.hash"), F.col("b.hash")))
    return x.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), "distance").distinct()


def hamming_pairs_wide(df: DataFrame, key: str, value: str, most: int, block: tuple[str, ...] = ()) -> DataFrame:
    """As hamming_pairs, for hashes that are arrays of longs (16 for 1024 bits): parts are most + 1 interleaved sets of bits, compared by their hash."""
    reps = df.where(F.col(value).isNotNull()).groupBy(*block, F.col(value).alias("hash")).agg(F.min(key).alias("id"))
    n = most + 1

    def of_part(p: int) -> Column:
        # bit k of word w is bit 64 w + k overall; which bits of a word are in the part depends on w mod n
        masks = [sum(1 << k for k in range(64) if (64 * w + k) % n == p) for w in range(n)]
        signed = F.array(*(F.lit(m - (1 << 64) if m >= 1 << 63 else m).cast("long") for m in masks))
        return F.xxhash64(F.transform("hash", lambda w, i: w.bitwiseAND(F.get(signed, i % n))))

    probes = reps.select(*block, "id", "hash", F.posexplode(F.array(*map(of_part, range(n)))).alias("part", "bits"))
    a, b = probes.alias("a"), probes.alias("b")
    on = (F.col("a.part") == F.col("b.part")) & (F.col("a.bits") == F.col("b.bits")) & (F.col("a.id") < F.col("b.id"))
    for c in block:
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    x = a.join(b, on).withColumn("distance", hamming_wide(F.col("a.hash"), F.col("b.hash"))).where(F.col("distance") <= most)
    return x.select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), "distance").distinct()


def hamming_clusters(df: DataFrame, key: str, value: str, most: int, block: tuple[str, ...] = ()) -> DataFrame:
    """Every row with its component under Hamming distance."""
    kind = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in block), F.col(value).cast("string"))
    equal = equal_links(df.where(F.col(value).isNotNull()), key, kind)
    near = hamming_pairs(df, key, value, most, block).select("a", "b")
    return graph.labelled(df.select(key).distinct(), equal.unionByName(near), key)


def layout_parts(zones: Column) -> Column:
    """Zone types, boxes, cell boxes and row boxes."""
    return F.transform(zones, lambda z: F.struct(z["zone_type"].alias("type"), z["bbox"].alias("bbox"), F.transform(z["cells"], lambda c: c["bbox"]).alias("cells"), F.transform(z["metadata"]["rendered_fields"], lambda f: f["row_bbox"]).alias("rows")))


def structure_digest(zones: Column) -> Column:
    """SHA-256 of zone types, boxes and cell boxes: equal for equal layouts."""
    return F.sha2(F.to_json(layout_parts(zones)), 256)


def difference_hash(gray: np.ndarray, size: int = 8) -> int:
    """Bit y * size + x is set if the averaged image is lighter at x than at x + 1."""
    small = _shrunk(gray, size, size + 1)
    bits = (small[:, :-1] > small[:, 1:]).ravel()
    return int(sum(1 << i for i in np.flatnonzero(bits).tolist()))


def average_hash(gray: np.ndarray, size: int = 8) -> int:
    """Bits of cells at least as light as the whole-number mean, first cell highest."""
    small = _shrunk(gray, size, size)
    bits = (small >= int(small.mean())).ravel()
    return int("".join("1" if b else "0" for b in bits), 2)


def _shrunk(gray: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """Mean of each cell of a grid."""
    y, x = np.linspace(0, gray.shape[0], rows + 1).astype(int), np.linspace(0, gray.shape[1], columns + 1).astype(int)
    return np.array([[gray[a : max(b, a + 1), c : max(d, c + 1)].mean() for c, d in zip(x, x[1:], strict=False)] for a, b in zip(y, y[1:], strict=False)]).astype(int)


def skeleton(zones: list, width: int, height: int, side: int = 256) -> np.ndarray:
    """Gray raster of a page's boxes: outlines of zones, cells and field rows, decoration filled."""
    image = np.full((side, side), 255, np.uint8)

    def scaled(box):
        return [int(v * side / (width if k % 2 == 0 else height)) for k, v in enumerate(box)]

    def outline(box, fill=False):
        x1, y1, x2, y2 = (min(max(v, 0), side - 1) for v in scaled(box))
        if fill:
            image[y1 : y2 + 1, x1 : x2 + 1] = 0
        image[y1, x1 : x2 + 1] = image[y2, x1 : x2 + 1] = 0
        image[y1 : y2 + 1, x1] = image[y1 : y2 + 1, x2] = 0

    for z in zones or []:
        if z["bbox"]:
            outline(z["bbox"], "decorative" in (z["zone_type"] or "") or "stamp" in (z["zone_type"] or ""))
        for c in z["cells"] or []:
            if c["bbox"]:
                outline(c["bbox"])
        for f in (z["metadata"] or {}).get("rendered_fields") or []:
            if f["row_bbox"]:
                outline(f["row_bbox"])
    return image


def _words(value: int, bits: int) -> list[int]:
    """A wide whole number as signed 64-bit words, the lowest first."""
    out = [(value >> (64 * k)) & (2**64 - 1) for k in range(max(1, bits // 64))]
    return [w - 2**64 if w >= 2**63 else w for w in out]


def skeleton_hashes(pages: DataFrame, size: int = 32) -> DataFrame:
    """(page_id, hash): difference hash of the layout skeleton as an array of longs (size * size bits)."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            hashes = [_words(difference_hash(skeleton(r["zones"], r["width"] or 1, r["height"] or 1), size), size * size) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array([r["page_id"] for r in rows], pa.string()), pa.array(hashes, pa.list_(pa.int64()))], ["page_id", "hash"])

    return pages.select("page_id", "width", "height", "zones").mapInArrow(run, "page_id string, hash array<bigint>")


def mask_hash(gray: np.ndarray, size: int = 32, darker_than: int = 224, share: float = 0.02) -> int:
    """Occupancy of a grid: a bit, the first cell's highest, for cells in which more than that share of the pixels is dark."""
    dark = (gray < darker_than).astype(float) * 1000
    return int("".join("1" if v > share * 1000 else "0" for v in _shrunk(dark, size, size).ravel()), 2)
