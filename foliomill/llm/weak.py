"""Quality classifier from weak labels.

1. Heuristic labellers vote on each document: good (1), bad (0) or nothing (-1);
   for toxicity 1 is toxic.  Each looks at evidence of its own (marks, case, table
   bars, repeated words, word pairs, sentence ends; several word lists, words in
   disguise, words addressed to somebody).
2. A labels table, where there is one, is a development set: two word lists of
   toxicity are mined from separate halves of at most ``fit_rows`` labelled
   documents and become two labellers more.  No document gets its label from the table.
3. Votes of all documents are counted by pattern (at most 3 ** labellers patterns,
   whatever the input).  Expectation-maximisation on these counts estimates each
   labeller's chance of each vote on documents of either class, and the classes' shares.
   ``PRIOR`` of the documents' weight holds each labeller to being mostly right where it votes.
4. Posterior labels of a bounded sample (``fit_rows`` documents, those with the
   smallest hashes of id and text, as far as they have ``fit_places`` features together)
   train a hashed linear scorer: words, their first 5 and 7 characters, and the
   votes of the fixed labellers.  Features whose share of bad documents differs
   from the average by fewer than ``LEAST_Z`` standard deviations get no weight.
5. The scorer alone scores all documents.

There are two targets, quality and toxicity; a document is kept if it is likely
good and not likely toxic.  Null or blank text: one vote for bad (empty).
Null ids: scored like others, never in a sample.  Repeated rows are scored each and
count once in a sample; of repeated label rows, a bad one wins; null labels tell nothing.
Other columns of the tables don't matter, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import bytes_of, dropped, hashes, mapped, mixed, pieces, split_words, stored, sums

FIT_ROWS, FIT_PLACES, DIMENSIONS = 8_000, 8_000_000, 1 << 18
LEAST_Z, PRIOR, TRUST = 4.0, 0.05, 0.95
#: From here on a document counts as good, as toxic.
GOOD_FROM, TOXIC_FROM = 0.5, 0.5
#: Beginnings of these lengths are mined: twice in so many labelled toxic documents of the half, so much likelier there than in others, and so many standard deviations off.
MINED_LENGTHS, MINED_DOCUMENTS, MINED_LIFT, MINED_Z = (4, 5, 7), 3, 20.0, 7.0

#: Word lists (fixed values): what people are called, what is said of them, what they are likened to; second person.
PERSONS = frozenset("asshole bastard bitch clown cretin dumbass fool freak idiot imbecile jerk loser moron pig retard scumbag".split())
CONTEMPT = frozenset("disgusting dumb idiotic moronic pathetic stupid ugly useless worthless".split())
FILTH = frozenset("crap filth garbage scum shit trash vermin".split())
SECOND = frozenset("you your you're youre u du dein deine ihr tu toi ton votre vous tú tu eres ustedes".split())

QUALITY = ("symbols", "shouting", "table", "narrow", "empty", "pairs", "letters", "sentences")
TOXIC = ("persons", "contempt", "filth", "disguised", "addressed")
MINED = ("mined_a", "mined_b")

_OUTER = ".,;:!?\"'()[]#*$%&|"
_SYMBOL, _SOLID = np.zeros(256, np.uint8), np.ones(256, np.uint8)
_SYMBOL[list(b"#*$%&|<>")] = 1
_SOLID[list(b" \t\n\x0b\x0c\r")] = 0
_DISGUISE = str.maketrans("013457@$!", "oieastasi")


# --- words of a batch, in columns


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct values; a sort is several times faster here than numpy's table of hashes."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of some texts: distinct words, and for each place in the texts which of them is there."""

    def __init__(self, texts: pa.Array):
        self.texts = pc.fill_null(texts.cast(pa.string()), "")
        self.words, self.at, self.starts = split_words(texts)
        self.sizes = np.diff(self.starts)
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.low = pc.utf8_trim(pc.utf8_lower(self.words), characters=_OUTER)
        pairs = _distinct(self.text * max(1, len(self.words)) + self.at)
        self.of_text, self.distinct = pairs // max(1, len(self.words)), pairs % max(1, len(self.words))

    def count(self, flags: np.ndarray) -> np.ndarray:
        """By text the number of places whose word has the flag."""
        return sums(flags[self.at], self.starts)

    def among(self, names: frozenset[str]) -> np.ndarray:
        return np.asarray(pc.is_in(self.low, value_set=pa.array(sorted(names))), bool)

    def beginnings(self, length: int) -> np.ndarray:
        """Hash of the first characters of each distinct word."""
        return hashes(pc.utf8_slice_codeunits(self.low, 0, length), length)

    def repeated(self, length: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of beginnings that occur twice in a text, of words that are not shorter; only such as are among these."""
        begin, long = self.beginnings(length), np.asarray(pc.utf8_length(self.low), np.int64) >= length
        use = (long if among is None else long & np.isin(begin, among))[self.at]
        text, begin = self.text[use], begin[self.at[use]]
        order = np.lexsort((begin, text))
        text, begin = text[order], begin[order]
        again = (text[1:] == text[:-1]) & (begin[1:] == begin[:-1])
        first = again & ~np.concatenate([[False], again[:-1]]) if len(again) else again
        return text[1:][first], begin[1:][first]


def _disguised(words: Words) -> np.ndarray:
    """Distinct words that only name somebody once digits and signs are read as the letters they look like."""
    odd = np.flatnonzero(np.asarray(pc.match_substring_regex(words.words, r"[A-Za-z].*[013457@$!*].*[A-Za-z]"), bool))
    out = np.zeros(len(words.words), bool)
    known = PERSONS | CONTEMPT | FILTH
    starred = {w[:1] + w[-1:] + str(len(w)) for w in known}
    for k in odd.tolist():
        word = words.words[k].as_py().lower().strip(".,;:?\"'()[]#%&|")
        inner = word.strip("*")
        out[k] = word.translate(_DISGUISE) in known and word not in known or (0 < inner.count("*") == len(inner) - 2 and inner[:1] + inner[-1:] + str(len(inner)) in starred)
    return out


@dataclass
class Mined:
    """Beginnings of words that two halves of the labelled documents tie to toxicity: sorted hashes. Without labels: none."""

    halves: list[np.ndarray] = field(default_factory=list)

    @property
    def names(self) -> tuple[str, ...]:
        return (*TOXIC, *MINED[: len(self.halves)])


def votes(words: Words, mined: Mined = Mined()) -> tuple[np.ndarray, np.ndarray]:
    """Matrices (text, labeller) of votes: of QUALITY (1: good), and of TOXIC and the mined lists (1: toxic)."""
    n = words.sizes
    some = np.maximum(n, 1)
    data, at = bytes_of(words.texts)
    symbols = sums(_SYMBOL[data], at) / np.maximum(sums(_SOLID[data], at), 1)
    upper = np.asarray(pc.utf8_is_upper(words.words), bool) & (np.asarray(pc.utf8_length(words.words), np.int64) > 3)
    plain = np.asarray(pc.match_substring_regex(words.words, r"^\p{L}+[.,;:!?]?$"), bool)
    ends = np.asarray(pc.match_substring_regex(words.words, r"[\p{L}\d][.!?][\"')\]]*$"), bool)
    bar = np.asarray(pc.equal(words.words, "|"), bool)
    inside = words.text[1:] == words.text[:-1]
    both = words.at[:-1][inside] * np.int64(max(1, len(words.words))) + words.at[1:][inside]
    of = words.text[1:][inside]
    key = mixed(both.view(np.uint64)) & np.uint64((1 << 44) - 1) | of.view(np.uint64) << np.uint64(44)  # 44 bits of a word pair's hash; a batch has fewer than 2**20 texts
    pairs = np.bincount((_distinct(key) >> np.uint64(44)).view(np.int64), minlength=len(n))
    pairs = pairs / np.maximum(n - 1, 1)
    same = np.bincount(of[words.at[:-1][inside] == words.at[1:][inside]], minlength=len(n)) / some
    distinct = np.bincount(words.of_text, minlength=len(n)) / some**0.8
    loud, bars, letters, stops = (words.count(x) / some for x in (upper, bar, plain, ends))
    long = n >= 12
    bad = lambda is_bad: np.where(is_bad, 0, -1)
    good = lambda is_good: np.where(is_good, 1, -1)
    either = lambda is_good, is_bad: np.where(n == 0, -1, np.where(is_good, 1, bad(is_bad)))
    quality = [
        bad(symbols > 0.04), bad(loud > 0.2), bad(bars > 0.1), bad(long & (distinct < 0.3)), bad(n == 0),
        either(long & (pairs > 0.8) & (same < 0.1), long & ((pairs < 0.5) | (same > 0.25))), either(letters > 0.85, letters < 0.7), either((stops > 0.02) & (stops < 0.4), long & ((stops < 0.01) | (stops > 0.6))),
    ]
    persons, contempt, filth = (words.among(x) for x in (PERSONS, CONTEMPT, FILTH))
    named = persons | contempt | filth
    near = np.zeros(len(words.at), bool)
    spoken, insulting = words.among(SECOND)[words.at], named[words.at]
    for k in (1, 2, 3):
        near[k:] |= spoken[:-k] & insulting[k:] & (words.text[k:] == words.text[:-k])
    toxic = [words.count(persons), words.count(contempt), words.count(filth), words.count(_disguised(words)), sums(near | (insulting & upper[words.at]), words.starts)]
    for half in mined.halves:
        toxic.append(sum(np.bincount(words.repeated(k, half)[0], minlength=len(n)) for k in MINED_LENGTHS))
    return np.stack(quality, 1).astype(np.int8), np.stack([good(x > 0) for x in toxic], 1).astype(np.int8)


def vote_keys(found: np.ndarray) -> list[str]:
    return ["".join("?01"[v + 1] for v in row) for row in found.tolist()]


def _votes_of(key: str) -> list[int]:
    return ["?01".index(c) - 1 for c in key]


# --- accuracies


@dataclass
class Accuracies:
    """Of each labeller the chance of each vote (nothing, 0, 1) given class 0 and 1, and the share of class 1."""

    chance: np.ndarray
    share: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of class 1 for rows of votes (-1, 0, 1)."""
        log = np.log(np.array([1 - self.share, self.share]))[:, None] + sum(np.log(self.chance[:, k, patterns[:, k] + 1]) for k in range(patterns.shape[1]))
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, share: float, rounds: int = 200) -> Accuracies:
    """From labellers that are right with chance TRUST where they vote; this start also counts as PRIOR of the weight."""
    voted = np.stack([(counts[:, None] * (patterns == v)).sum(0) for v in (-1, 0, 1)], 1) + 1.0
    abstain = voted[:, 0] / voted.sum(1)
    chance = np.empty((2, patterns.shape[1], 3))
    for c in (0, 1):
        chance[c, :, 0] = abstain
        chance[c, :, 1 + c] = (1 - abstain) * TRUST
        chance[c, :, 2 - c] = (1 - abstain) * (1 - TRUST)
    prior = np.array([1 - share, share])[:, None, None] * chance * PRIOR * counts.sum() + 0.1
    model, before = Accuracies(chance, share), None
    for _ in range(rounds):
        p = model.posterior(patterns)
        weight = np.stack([counts * (1 - p), counts * p])
        chance = np.stack([np.stack([weight[c] @ (patterns == v) for v in (-1, 0, 1)], -1) for c in (0, 1)]) + prior
        chance /= chance.sum(-1, keepdims=True)
        model = Accuracies(chance, float(np.clip(weight[1].sum() / counts.sum(), 1e-4, 1 - 1e-4)))
        if before is not None and np.abs(p - before).max() < 1e-6:
            break
        before = p
    return model


# --- the scorer


def _vote_places() -> np.ndarray:
    """Place of each vote (-1, 0, 1) of each fixed labeller."""
    names = pa.array([f"\0{name}={v}" for name in (*QUALITY, *TOXIC) for v in (-1, 0, 1)])
    return (hashes(names) % np.uint64(DIMENSIONS)).astype(np.int64).reshape(-1, 3)


VOTE_PLACES = _vote_places()


def features(words: Words, fixed: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of all features, distinct and sorted; fixed: votes of the fixed labellers. wanted: flags of the places that matter."""
    keys = []
    there = np.asarray(pc.binary_length(words.low), np.int64) > 0
    for found in (hashes(words.low), words.beginnings(5), words.beginnings(7)):
        place = (found % np.uint64(DIMENSIONS)).astype(np.int64)
        use = there if wanted is None else there & wanted[place]
        use = use[words.distinct]
        keys.append(words.of_text[use] * DIMENSIONS + place[words.distinct[use]])
    of_votes = VOTE_PLACES[np.arange(fixed.shape[1]), fixed + 1]
    keys.append((np.arange(len(words.sizes))[:, None] * DIMENSIONS + of_votes).ravel())
    found = _distinct(np.concatenate(keys))
    return found // DIMENSIONS, found % DIMENSIONS


def train(rows: list[np.ndarray], target: np.ndarray, rounds: int = 300, rate: float = 0.3, decay: float = 1e-3) -> np.ndarray:
    """Weights (the last is the bias) of a logistic model on soft labels, by full-batch adaptive gradients; classes weigh alike."""
    index = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), list(map(len, rows)))
    p = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    n = np.bincount(index, minlength=DIMENSIONS)
    z = (np.bincount(index, target.astype(np.float32)[row], DIMENSIONS) - n * p) / np.sqrt(n * p * (1 - p) + 1e-9)
    chosen = (np.abs(z) >= LEAST_Z) & (n >= 5)
    keep = chosen[index]
    index, row = index[keep], row[keep]
    used, index = np.unique(index, return_inverse=True)
    weight = target * 0.5 / p + (1 - target) * 0.5 / (1 - p)
    w, squares = np.zeros(len(used) + 1), np.full(len(used) + 1, 1e-8)
    for _ in range(rounds):
        score = np.bincount(row, w[index], len(rows)) + w[-1]
        error = weight * (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) / len(rows)
        gradient = np.append(np.bincount(index, error[row], len(used)) + decay * w[:-1], error.sum())
        squares += gradient**2
        w -= rate * gradient / np.sqrt(squares)
    out = np.zeros(DIMENSIONS + 1, np.float32)
    out[used], out[-1] = w[:-1], w[-1]
    return out


class Scorer:
    """Chances of being good and of being toxic, from the weights alone."""

    def __init__(self, quality: np.ndarray, toxic: np.ndarray):
        self.weights = np.stack([quality, toxic]).astype(np.float64)
        self.wanted = self.weights[:, :-1].any(axis=0)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words = Words(texts)
        text, place = features(words, np.concatenate(votes(words), 1), self.wanted)
        good, bad = (1 / (1 + np.exp(-np.clip(np.bincount(text, w[place], len(texts)) + w[-1], -30, 30))) for w in self.weights)
        return good.round(6), bad.round(6)


def kept(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return (good >= GOOD_FROM) & (bad < TOXIC_FROM)


@dataclass
class Model:
    """What fit() learns: accuracies of the labellers, mined lists, and the scorers' weights, in float32."""

    quality: Accuracies
    toxic: Accuracies
    mined: Mined
    quality_weights: np.ndarray
    toxic_weights: np.ndarray


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def _patterns(docs: DataFrame, mined: Mined) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Votes on all documents, counted by pattern."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in pieces(b.column(0)):
                q, t = votes(Words(texts), mined)
                yield pa.RecordBatch.from_arrays([pa.array(vote_keys(q)), pa.array(vote_keys(t))], ["quality", "toxic"])

    rows = mapped(docs.select("text"), run, "quality string, toxic string").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** labellers
    out = {}
    for c in ("quality", "toxic"):
        counts: dict[str, int] = {}
        for r in rows:
            counts[r[c]] = counts.get(r[c], 0) + r["n"]
        keys = sorted(counts)
        out[c] = np.array([_votes_of(k) for k in keys], np.int64), np.array([counts[k] for k in keys], float)
    return out


def _share(most: int, n: int) -> int:
    """Below this are so many of n hashes of 62 bits, or all."""
    return (1 << 62) * min(most, max(n, 1)) // max(n, 1)


def _ample(most: int) -> int:
    """So many more are taken by estimated shares that there are enough: the estimate is off by 5 % or so, and draws by the square root."""
    return most + most // 4 + 10 * math.isqrt(most) + 100


def _some(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` distinct rows (id, text, ...) with the smallest hashes of id and text, in the column order.

    An estimate of how many distinct rows there are bounds what is sorted, with a quarter more than needed to spare, and more of small samples.
    """
    x = rows.where("id is not null").withColumn("order", F.shiftrightunsigned(F.xxhash64("id", "text"), 2))
    n = x.agg(F.approx_count_distinct("order")).first()[0]
    return x.where(F.col("order") < _share(_ample(most), n)).dropDuplicates(["order"]).orderBy("order").limit(most)


def mine(docs: DataFrame, labels: DataFrame, fit_rows: int) -> Mined:
    """Two lists of word beginnings, each from half of at most fit_rows labelled documents. docs: id, text; labels: id, toxic."""
    n = labels.agg(F.approx_count_distinct("id")).first()[0]
    known = labels.where(F.shiftrightunsigned(F.xxhash64("id"), 2) < _share(_ample(fit_rows), n)).orderBy(F.xxhash64("id")).limit(2 * _ample(fit_rows))
    rows = _some(docs.join(F.broadcast(known), "id").where("toxic is not null"), fit_rows)  # ids of the sample: the limit is twice what the share lets pass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, texts in pieces(b.column(0)):
                words = Words(texts)
                text, begin = (np.concatenate(x) for x in zip(*(words.repeated(k) for k in MINED_LENGTHS), strict=True))
                of = lambda c: b.column(c).to_numpy(zero_copy_only=False)[low + text]
                yield pa.RecordBatch.from_arrays([pa.array(begin.view(np.int64)), pa.array(of(1).astype(np.int32)), pa.array(of(2).astype(np.int32))], ["begin", "toxic", "half"])

    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).cast("int").alias("half")
    sample = stored(rows.select("text", F.col("toxic").cast("int").alias("toxic"), half), "labelled")
    sizes = {(r.half, r.toxic): r.n for r in sample.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # four rows
    counted = mapped(sample, run, "begin long, toxic int, half int").groupBy("half", "begin").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    halves = []
    for h in (0, 1):
        of_toxic, of_clean = max(1, sizes.get((h, 1), 0)), max(1, sizes.get((h, 0), 0))
        share, rate, other = (F.col("t") + F.col("c")) / (of_toxic + of_clean), F.col("t") / of_toxic, F.col("c") / of_clean
        far = (rate - other) / F.sqrt(share * (1 - share) * (1 / of_toxic + 1 / of_clean)) >= MINED_Z
        found = counted.where((F.col("half") == h) & (F.col("t") >= MINED_DOCUMENTS) & (rate >= MINED_LIFT * (F.col("c") + 0.5) / of_clean) & far).select("begin").collect()  # bounded by the sample
        halves.append(np.array(sorted(r.begin for r in found), np.int64).view(np.uint64))
    dropped(sample)
    return Mined(halves)


def fit(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic", fit_rows: int = FIT_ROWS, fit_places: int = FIT_PLACES) -> Model | None:
    """labels: id and toxic (0, 1 or null) of some documents, for the mined lists alone. All votes of all documents are counted; the scorers see fit_rows documents. None if there are none."""
    docs = _source(docs, id_col, text_col)
    mined = Mined()
    if labels is not None:
        known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic"))
        mined = mine(docs, known, fit_rows)
    patterns = _patterns(docs, mined)
    if not len(patterns["quality"][1]):
        return None
    models = {c: expectation_maximisation(*patterns[c], share) for c, share in (("quality", 0.8), ("toxic", 0.1))}

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for low, texts in pieces(b.column(1)):
                words = Words(texts)
                q, t = votes(words, mined)
                text, place = features(words, np.concatenate([q, t[:, : len(TOXIC)]], 1))
                ends = np.searchsorted(text, np.arange(len(texts) + 1))
                places = [place[x:y].astype(np.int32).tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(low, len(texts)), pa.array(vote_keys(q)), pa.array(vote_keys(t)), pa.array(np.diff(ends)), pa.array(places, pa.binary())], ["order", "quality", "toxic", "n", "places"])

    sample = stored(mapped(_some(docs, fit_rows).select("order", "text"), featured, "order long, quality string, toxic string, n long, places binary"), "sample")
    tables = {c: (models[c].chance, models[c].share) for c in ("quality", "toxic")}

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys, held = [], {"quality": [], "toxic": []}, 0
        for b in batches:
            for q, t, places in zip(*(b.column(k).to_pylist() for k in (1, 2, 4)), strict=True):
                held += len(places) // 4
                if held <= fit_places:
                    rows.append(np.frombuffer(places, np.int32))
                    keys["quality"].append(_votes_of(q))
                    keys["toxic"].append(_votes_of(t))
        if rows:
            weights = [train(rows, Accuracies(*tables[c]).posterior(np.array(keys[c], np.int64))).tobytes() for c in ("quality", "toxic")]
            yield pa.RecordBatch.from_arrays([pa.array([w], pa.binary()) for w in weights], ["quality", "toxic"])

    # one task has the sample, fit_places places of 4 bytes at most; two vectors of weights, 1 MB each, reach the driver
    found = mapped(sample.repartition(1).sortWithinPartitions("order"), trained, "quality binary, toxic binary").collect()
    dropped(sample)
    if not found:
        return None
    return Model(models["quality"], models["toxic"], mined, *(np.frombuffer(w, np.float32) for w in found[0]))


def scored(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, p_quality, p_toxic (6 decimals), kept. Weights are 2 MB whatever the input. Without a model (no documents with an id): no chances, all kept."""
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select(F.col(id_col).cast("long").alias(id_col), none.alias("p_quality"), none.alias("p_toxic"), F.lit(True).alias("kept"))
    sent = docs.sparkSession.sparkContext.broadcast((model.quality_weights, model.toxic_weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*sent.value)
        for b in batches:
            for low, texts in pieces(b.column(1)):
                good, bad = score(texts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(low, len(texts)), pa.array(good), pa.array(bad), pa.array(kept(good, bad))], ["id", "p_quality", "p_toxic", "kept"])

    return mapped(_source(docs, id_col, text_col), run, "id long, p_quality double, p_toxic double, kept boolean").withColumnRenamed("id", id_col)


def filtered(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """docs without those that the scorer rejects; all columns and repeated rows stay as they are."""
    if model is None:
        return docs
    sent = docs.sparkSession.sparkContext.broadcast((model.quality_weights, model.toxic_weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*sent.value)
        for b in batches:
            for low, texts in pieces(b.column(b.schema.get_field_index(text_col))):
                yield b.slice(low, len(texts)).filter(pa.array(kept(*score(texts))))

    return mapped(docs, run, docs.schema)
