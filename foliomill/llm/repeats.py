"""Quality rules from suffix-array repetition.

The words of each text become a suffix array by prefix doubling (ranks at
1, 2, 4, ... words; only suffixes still tied are sorted again).  The longest
common prefixes of neighbours in the array follow from the first ranks where
they are short, and else in the texts' order, each from the one before it
(Kasai's bound).  They give for each word position the longest substring that
starts there and occurs elsewhere in the text: the longest-common-prefix
interval it lies in.

The base rule counts words in repeats of ``base_words`` words.  The method's own
limits are stricter on long repeats and see shorter ones: repeats of
``min_words`` words may cover ``covered_percent`` of the text's characters at most,
and no repeat may be longer than ``longest_repeat`` words.

Ranks compare words, not hashes, so repeats are exact.  Several texts share one
array (the text's number leads the key), so short texts cost no more than long
ones; what is held grows with one batch or the longest text, by about a dozen
numbers a word.  Null or blank text: no words, base failed.  Null ids and repeated
rows: a row each.  Other columns of the table don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import Interned, mapped, starts_of, utf8

#: Words put into one suffix array, unless one text has more.
TOGETHER = 150_000


@dataclass(frozen=True)
class Limits:
    """Base limits are fixed by the rule; the three others are the method's."""

    base_words: int = 8
    fewest_words: int = 20
    base_repeat_percent: int = 30
    min_words: int = 4
    covered_percent: int = 25
    longest_repeat: int = 50


def longest_repeats(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word: length of the longest substring from it that occurs elsewhere in its text. starts: texts' offsets."""
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.int64)
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    end = np.repeat(starts[1:], sizes)
    key = text * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = _group_starts(key[order])
    first = [rank]  # ranks by the first word, and by the first two; later ones replace each other
    before, width = rank, 1
    tied = _tied(rank, np.arange(n), n)
    four = tied[:0]  # positions whose first four words occur elsewhere in the text
    while len(tied):
        after = tied + width
        inside = after < end[tied]
        key = before[tied] * (n + 1)
        key[inside] += before[after[inside]] + 1
        order = np.argsort(key, kind="stable")
        at, key = tied[order], key[order]
        rank = before.copy()
        rank[at] += _group_starts(key) - _group_starts(before[at])
        before, width = rank, width * 2
        tied = _tied(rank, tied, n)
        if width == 2:
            first.append(rank)
        elif width == 4:
            four = tied
    array = np.empty(n, dtype=np.int64)
    array[rank] = np.arange(n)
    following = np.full(n, -1)  # the next in the array, in the same text
    following[array[:-1]] = np.where(text[array[:-1]] == text[array[1:]], array[1:], -1)
    common = np.zeros(n, dtype=np.int64)
    a = np.flatnonzero(following >= 0)
    here, there, stop = a.copy(), following[a], end[a]
    for k in reversed(range(len(first))):  # up to three words
        at = np.flatnonzero((here < stop) & (there < stop))
        hit = at[first[k][here[at]] == first[k][there[at]]]
        common[a[hit]] += 1 << k
        here[hit] += 1 << k
        there[hit] += 1 << k
    _from_the_one_before(words, end, four[following[four] >= 0], following, common)
    out = common.copy()
    some = a[common[a] > 0]
    np.maximum.at(out, following[some], common[some])
    return out


def _from_the_one_before(words: np.ndarray, end: np.ndarray, some: np.ndarray, following: np.ndarray, common: np.ndarray) -> None:
    """Common prefixes of four words or more, at sorted positions: at most one word shorter than that of the position before."""
    some = np.sort(some)
    word, held, last = memoryview(np.ascontiguousarray(words)), 0, -2
    for a, b, stop in zip(some.tolist(), following[some].tolist(), end[some].tolist(), strict=True):
        held = held - 1 if a == last + 1 and held > 0 else 0
        most = stop - max(a, b)
        while held < most and word[a + held] == word[b + held]:
            held += 1
        if held >= 4:
            common[a] = held
        last = a


def _group_starts(ordered: np.ndarray) -> np.ndarray:
    """For each of these sorted values, the index of the first that equals it."""
    new = np.empty(len(ordered), dtype=bool)
    new[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


def _tied(rank: np.ndarray, among: np.ndarray, n: int) -> np.ndarray:
    return among[np.bincount(rank[among], minlength=n)[rank[among]] > 1]


def _covered(length: np.ndarray, least: int) -> np.ndarray:
    """Whether each word lies in a repeat of at least so many words."""
    long = np.flatnonzero(length >= least)
    delta = np.zeros(len(length) + 1, dtype=np.int64)
    np.add.at(delta, long, 1)
    np.add.at(delta, long + length[long], -1)
    return np.cumsum(delta[:-1]) > 0


LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_chars", "longest_repeat")


def profile(texts: list[str | None], limits: Limits = Limits()) -> dict[str, np.ndarray]:
    """Counts and verdicts of whole texts, by column."""
    out = {k: np.zeros(len(texts), dtype=np.int64) for k in LONGS}
    batch: list[list[bytes]] = []
    first = held = 0

    def settle(upto: int) -> None:
        nonlocal batch, first, held
        starts = starts_of(np.fromiter(map(len, batch), np.int64, len(batch)))
        ids = Interned()
        words = np.fromiter((ids[w] for ws in batch for w in ws), np.int64, int(starts[-1]))
        size = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in ids), np.int64, len(ids))
        length = longest_repeats(words, starts)
        for name, least, weight in (("n_repeat_words", limits.base_words, 1), ("n_covered_chars", limits.min_words, size[words])):
            covered = starts_of(_covered(length, least) * weight)
            out[name][first:upto] = covered[starts[1:]] - covered[starts[:-1]]
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            out["longest_repeat"][first + full] = np.maximum.reduceat(length, starts[:-1][full])
        batch, first, held = [], upto, 0

    for k, text in enumerate(texts):
        text = text or ""
        raw = utf8(text)
        words = raw.split()
        if held and held + len(words) > TOGETHER:
            settle(k)
        batch.append(words)
        held += len(words)
        out["n_words"][k] = len(words)
        out["word_chars"][k] = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
        out["n_symbols"][k] = sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
        lines = [x for x in raw.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        out["n_dup_lines"][k] = len(lines) - len(set(lines))
    settle(len(texts))
    n = out["n_words"]
    failed = (n < limits.fewest_words) | (100 * out["n_repeat_words"] > limits.base_repeat_percent * n)
    out["base_failed"] = failed
    out["kept"] = ~failed & (100 * out["n_covered_chars"] <= limits.covered_percent * out["word_chars"]) & (out["longest_repeat"] <= limits.longest_repeat)
    return out


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """One row per row of df: id, counts, longest repeat in words, base_failed, kept. Nulls: see the module."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = profile(b.column(1).to_pylist(), limits)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[k]) for k in (*LONGS, "base_failed", "kept"))], ["id", *LONGS, "base_failed", "kept"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return mapped(src, run, f"id long, {', '.join(f'{k} long' for k in LONGS)}, base_failed boolean, kept boolean").withColumnRenamed("id", id_col)
