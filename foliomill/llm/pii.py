"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs,
``://`` of schemes, digits, plus signs before a digit, and words that announce
an identifier.  From each anchor a deterministic local parser expands to the
left and right and validates the boundary, so text between anchors is never
parsed.  What an anchor has parsed is not parsed again by the next one, so the
time is in proportion to the text, whatever it holds.

Base kinds: email, ip, card, phone.  Kinds that the method adds: iban (country
code, length, modulus 97), account (a number that an announcing word precedes),
profile (URL with a user in its authority or path) and address (house number, one to three
capitalised words of any length, street word).  Null text: no spans.  Offsets are code points,
end exclusive.  Null ids and repeated rows: a row each.  Other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomill.llm.common import mapped

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "account", "profile", "address")

#: Words that announce an account or identity number, and street words (fixed values).
CUES = ("account", "acct", "iban", "ssn", "social security", "passport", "konto", "compte", "cuenta", "tax id", "member id", "customer id")
STREETS = ("Street", "Avenue", "Road", "Boulevard", "Lane", "Drive", "Square")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:[ ]?(?:number|no\.?|nr\.?|#))?[ ]?[:=#]?[ ]?([0-9][0-9 -]{4,30}[0-9])(?![0-9])", re.I)
_URL_TAIL = re.compile(r"[^\s\"'<>()\[\]{}]+")
_USER_PATH = re.compile(r"/(?:~|@|users?/|profile/|u/|in/)[A-Za-z0-9._-]+")

_EMAIL_AT, _SCHEME, _PLUS, _DIGIT, _CUE, _STREET = range(6)


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", _EMAIL_AT)
    found.add_word("://", _SCHEME)
    for d in "0123456789":
        found.add_word(d, _DIGIT)
        found.add_word(f"+{d}", _PLUS)
    for cue in CUES:
        for form in {cue, cue.upper(), cue.title(), cue.capitalize()}:
            found.add_word(form, _CUE)
    for street in STREETS:
        found.add_word(street, _STREET)
    found.make_automaton()
    return found


_ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += (n * 2 - 9 if n > 4 else n * 2) if k % 2 else n
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _iban(found: str) -> bool:
    s = found.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _is(text: str, at: int, low: str, high: str) -> bool:
    return at >= 0 and low <= text[at] <= high


def _house(text: str, end: int) -> int | None:
    """Where a house number (1 to 5 digits, perhaps a letter) starts that ends here."""
    at = end - 1 if _is(text, end - 1, "a", "z") or _is(text, end - 1, "A", "Z") else end
    start = at
    while at - start < 5 and _is(text, start - 1, "0", "9"):
        start -= 1
    if start == at or any(_is(text, start - 1, *r) for r in ("09", "az", "AZ")):
        return None
    return start


def _before_street(text: str, word: int) -> int | None:
    """Where the address starts whose street word, or the word that it ends, starts here: a house number and one to three capitalised words before it."""
    for _ in range(3):
        end = word - 1
        if not _is(text, end, " ", " "):
            return None
        start = end
        while _is(text, start - 1, "a", "z"):
            start -= 1
        if start == end or not _is(text, start - 1, "A", "Z"):
            return None
        word = start - 1
        if _is(text, word - 1, " ", " ") and (found := _house(text, word - 1)) is not None:
            return found
    return None


def find(text: str | None) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) of a whole text, sorted by kind as in KINDS, then start."""
    out: dict[str, list[tuple[int, int]]] = {}
    if not text:
        return []
    past_email = past_ip = past_card = past_phone = past_account = past_iban = url_end = letters_from = letters_to = 0
    street: int | None = None
    for last, anchor in _ANCHORS.iter(text):
        if anchor == _DIGIT:
            if last >= past_card:
                if m := _CARD.match(text, last):
                    past_card = m.end()
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out.setdefault("card", []).append(m.span())
                else:
                    past_card = last + 1
            if last >= past_ip:
                if m := _IP.match(text, last):
                    past_ip = m.end()
                    if all(map(_octet, m.groups())):
                        out.setdefault("ip", []).append(m.span())
                else:  # a later digit of the same run fails alike
                    past_ip = _DIGITS.match(text, last).end()
            at = last - 2
            if at >= past_iban and "A" <= text[at] <= "Z" and "A" <= text[at + 1] <= "Z" and not (at and text[at - 1].isalnum()) and (m := _IBAN.match(text, at)) and _iban(m[0]):
                past_iban = m.end()
                out.setdefault("iban", []).append(m.span())
        elif anchor == _EMAIL_AT:
            start = last
            while start > past_email and text[start - 1] in _LOCAL:
                start -= 1
            if start < last and (m := _DOMAIN.match(text, last + 1)):
                past_email = m.end()
                out.setdefault("email", []).append((start, past_email))
        elif anchor == _PLUS:
            if last - 1 >= past_phone and (m := _PHONE.match(text, last - 1)):
                past_phone = m.end()
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.setdefault("phone", []).append(m.span())
        elif anchor == _CUE:
            if last >= past_account and (m := _ACCOUNT.match(text, last + 1)) and 6 <= sum("0" <= c <= "9" for c in m[1]) <= 20:
                past_account = m.end()
                out.setdefault("account", []).append(m.span(1))
        elif anchor == _SCHEME:
            start = last - 2
            while start and text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "+.-"):
                start -= 1
            if last + 1 >= url_end and (m := _URL_TAIL.match(text, last + 1)):
                url_end = m.end()
            if start < last - 2 and last + 1 < url_end:
                path = text.find("/", last + 1, url_end)
                path = url_end if path < 0 else path
                if "@" in text[last + 1 : path].strip("@") or _USER_PATH.match(text, path, url_end):
                    out.setdefault("profile", []).append((start, url_end))
        else:
            word = last + 1
            while word > letters_to and text[word - 1].isalpha():
                word -= 1
            if word > letters_to or not letters_to:  # else these letters go on from those of the street word before
                letters_from, street = word, _before_street(text, word)
            letters_to = last + 1
            if street is not None:
                out.setdefault("address", []).append((street, last + 1))
    return [(k, a, b) for k in KINDS for a, b in out.get(k, ())]


def spelled(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: its id, spans as ``kind, start, end`` structs. Null text or id: no spans, id kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))], ["id", "spans"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return mapped(src, run, "id long, spans array<struct<kind:string,start:long,end:long>>").withColumnRenamed("id", id_col)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, SHA-256 of the base spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [find(t) for t in b.column(1).to_pylist()]
            counts = [pa.array([sum(x[0] == k for x in spans) for spans in found], pa.int64()) for k in BASE]
            base = [hashlib.sha256(spelled([x for x in spans if x[0] in BASE]).encode()).hexdigest() for spans in found]
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(base, pa.string()), pa.array(map(spelled, found), pa.string())], ["id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return mapped(src, run, f"id long, {', '.join(f'n_{k} long' for k in BASE)}, base_sha256 string, spans string").withColumnRenamed("id", id_col)


def redacted(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of spans that overlap, one."""
    if not text or not (spans := find(text)):
        return text
    out, at, rank = [], 0, {k: n for n, k in enumerate(KINDS)}
    merged: list[list] = []
    for k, a, b in sorted(spans, key=lambda x: (x[1], -x[2], rank[x[0]])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([k, a, b])
    for kind, start, end in merged:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(out) + text[at:]


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with personal data replaced in text_col; other columns, nulls and row order within partitions stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.schema.get_field_index(text_col)
            yield b.set_column(k, b.schema.field(k), pa.array([redacted(t) for t in b.column(k).to_pylist()], b.schema.field(k).type))

    return mapped(df, run, df.schema)
