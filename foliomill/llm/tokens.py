"""Token counts by a count-only Viterbi pass.

An Aho-Corasick automaton over a unigram vocabulary lists, for each end
position, the pieces that end there, longest first.  The dynamic programme
keeps two numbers per position: best score and number of pieces on that path.
No piece string is built.

Tie rule (that of public unigram tokenizers): at each end position the longest
piece is tried first and a later one must score strictly more.  A character
that is no piece by itself may be unknown: it scores ten below the lowest score
of the vocabulary and counts as its UTF-8 bytes (byte fallback).

Text is normalised as the vocabulary expects: a leading U+2581, and U+2581 for
each space.  Null or empty text: 0.  Where all pieces are U+2581* followed by
other characters, no piece crosses from a word into the next U+2581, so a text
falls into words that are counted one by one and remembered; scores are whole
numbers below 2**53, so sums, and with them ties, stay exact.  Otherwise the
whole text is one word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import Remembered, mapped

SPACE = "▁"
UNKNOWN_PENALTY = 10.0

#: Pieces that a vocabulary sent to the executors may have at most.
MOST_PIECES = 1_000_000


@lru_cache(maxsize=4)
def vocabulary(path: str) -> tuple[tuple[str, float], ...]:
    """(piece, score) of a sentencepiece model file, without control, unknown and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = tuple((model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    if len(pieces) > MOST_PIECES:
        raise ValueError(f"{len(pieces)} pieces; at most {MOST_PIECES} are sent to the executors")
    return pieces


class Counter:
    """Counts the pieces of the best segmentation."""

    def __init__(self, pieces: tuple[tuple[str, float], ...]):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = frozenset(p for p, _ in pieces if len(p) == 1)
        self.unknown = min(0.0, *(s for _, s in pieces)) - UNKNOWN_PENALTY
        inner = all(SPACE not in p.lstrip(SPACE) for p, _ in pieces)
        exact = all(s == int(s) and abs(s) < 2**31 for _, s in pieces)
        cuts = "".join(c for c in "\n\t\r" if not any(c in p for p, _ in pieces))
        self.words = re.compile(f"{SPACE}+[^{SPACE}{cuts}]*|[{cuts}]|[^{SPACE}{cuts}]+" if cuts else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall if inner and exact else lambda text: [text]
        self.known = Remembered(self.word, most=400_000)

    def word(self, text: str) -> int:
        n = len(text)
        best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
        if self.single.issuperset(text):
            for last, (length, score) in self.automaton.iter(text):
                end = last + 1
                score += best[end - length]
                if score > best[end]:
                    best[end] = score
                    count[end] = count[end - length] + 1
            return count[n]
        at = 0  # ends up to here have had their unknown character
        for last, (length, score) in self.automaton.iter(text):
            while at < last:
                at = self._unknown(text, at, best, count)
            end = last + 1
            score += best[end - length]
            if score > best[end]:
                best[end] = score
                count[end] = count[end - length] + 1
        while at < n:
            at = self._unknown(text, at, best, count)
        return count[n]

    def _unknown(self, text: str, at: int, best: list[float], count: list[int]) -> int:
        if (c := text[at]) not in self.single and (score := best[at] + self.unknown) > best[at + 1]:
            best[at + 1] = score
            count[at + 1] = count[at] + len(c.encode("utf-8", "surrogatepass"))
        return at + 1

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.known.__getitem__, self.words(SPACE + text.replace(" ", SPACE))))


@lru_cache(maxsize=2)
def counter(pieces: tuple[tuple[str, float], ...]) -> Counter:
    return Counter(pieces)


def token_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id, n_tokens (null or empty text: 0). path: the vocabulary's file, read on the driver only."""
    sent = df.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(sent.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([count(t) for t in b.column(1).to_pylist()], pa.int64())], ["id", "n_tokens"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return mapped(src, run, "id long, n_tokens long").withColumnRenamed("id", id_col)
