"""The ten operators against brute force, on small tables with nulls, repeats, empty and long texts, and clashing column names."""

import base64
import collections
import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliomill.llm import minhash, mixing, pii, preferences, repeats, secrets, shingles, templates, tokens, warc, weak
from foliomill.llm.components import components
from foliomill.llm.queries import TOKENIZERS, VOCABULARY

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t", "one", "a b c d", "a b c d", "x " * 3000, "\x00\x1f  é🙂", "same words again and again " * 4]


def documents(spark, texts, **more):
    rows = [(k, t, "en", f"s{k % 3}", 0) for k, t in enumerate(texts)] + [(None, "lost words of a row without id", None, None, None), (3, texts[3], "en", "s0", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    # names that operators use inside
    for name in ("id", "key", "row", "rank", "size", "n", "spans", "digest", "bucket", "at"):
        df = df.withColumn(name, F.lit("x"))
    return df


# --- 1


def test_templates_find_reparameterised_questions(spark):
    items = spark.createDataFrame([(1, "If John Smith has 12 apples and gives 5 apples to Mary, how many apples does he still have after lunch today?"), (2, "short item"), (3, None), (4, "")], "item_id long, text string")
    docs = documents(spark, [
        "Well. If Peter Brown has 31 apples and gives 7 apples to Anna, how many apples does he still have after lunch today? ok",
        "If John Smith has 12 apples and gives 5 apples to Mary, how many apples does he still have after lunch today?",
        "Nothing of the kind is in here at all", "a short item here",
    ])
    found = {(r.doc_id, r.item_id): r.exact for r in templates.leaks(docs, items).collect()}
    assert found == {(0, 1): False, (1, 1): True, (3, 2): True}


def test_templates_want_consistent_slots(spark):
    item = "the price of 12 units is then 12 times the cost of one"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(spark, ["the price of 40 units is then 40 times the cost of one", "the price of 40 units is then 7 times the cost of one", "", "z"])
    assert [r.doc_id for r in templates.leaks(docs, items).collect()] == [0]


def test_a_clash_removes_only_its_windows(spark):
    words = [f"w{k}" for k in range(60)]
    words[10] = words[45] = "2019"
    again = "a man walks on from here to there all day and on through the night with 5 dogs and 5 cats behind him"
    items = spark.createDataFrame([(1, " ".join(words)), (2, again)], "item_id long, text string")
    docs = spark.createDataFrame([(0, " ".join([*words[:45], "2020", *words[46:]])), (1, again.replace("5 d", "3 d").replace("5 c", "7 c"))], "doc_id long, text string")
    assert {(r.doc_id, r.item_id): r.n_windows for r in templates.leaks(docs, items).collect()} == {(0, 1): 53 - 8, (1, 2): 9}


def test_short_and_placeholder_heavy_items_are_found(spark):
    texts = ["What is 17 * 24?", "How many days in March?", "Which river flows through the old town?", "17 24 days 31 5 hours 12 miles 9 weeks 3 cents 44 pounds", "Add 5 to 6 and 7 to 8 then 9 to 10 then 11 and 12 all of it then once more"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = spark.createDataFrame([*((k, f"A heading\n{t}\nand more") for k, t in enumerate(texts)), (5, "What is 18 * 24? How many days in April?"), (6, texts[4].replace("5 to 6", "1 to 2")), (7, "a heading\nWHAT IS 17 * 24")], "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in templates.leaks(docs, items).collect()}
    assert set(found) == {*((k, k) for k in range(5)), (6, 4), (7, 0)}
    assert all(r.exact and r.share == 1 for k, r in found.items() if k[0] in (0, 1, 2, 3, 7))


def test_leaks_against_passage_search(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if i.text in d.text}
    assert want <= {(r.doc_id, r.item_id) for r in templates.leaks(docs, items).collect()}


def plain_tokens(text):
    """(canonical, value) of each token, by the rules in words."""
    out, after_end = [], True
    for raw in (text or "").encode().split():
        raw = raw.decode()
        bare = raw.strip(".,;:!?\"'()[]{}<>«»“”‘’…")
        low = bare.lower()
        m = re.match(r"[$€£]?[+-]?\d[\d.,:/]*(?:st|nd|rd|th)?([^\d\s]{0,12})$", low)
        if (m and (not m[1] or m[1] in templates.UNITS)) or low in templates.NUMBERS:
            out.append(("<NUM>", low))
        elif low and low in templates.UNITS:
            out.append(("<UNIT>", low))
        elif len(bare) > 1 and bare[0].isupper() and not bare.isupper() and not after_end:
            out.append(("<NAME>", low))
        else:
            out.append((low, low))
        after_end = raw[-1:] in ".!?:;" or raw[-2:-1] in tuple(".!?")
    return out


def plain_leaks(docs, items):
    """All windows of all documents against all windows of all items."""
    held = lambda c: c in ("<NUM>", "<UNIT>", "<NAME>")

    def windows(tokens, w, short):
        for p in range(len(tokens) - w + 1):
            part = tokens[p : p + w]
            filled = sum(not held(c) for c, _ in part) >= min(4, w)
            if filled:
                yield p, False, tuple(c for c, _ in part), [v for c, v in part if held(c)]
            if not filled or short:
                yield p, True, tuple(v for _, v in part), []

    item_tokens = {i: plain_tokens(t) for i, t in items.items()}
    short = {len(t) for t in item_tokens.values() if 1 <= len(t) <= 8}
    found = {}
    for d, text in docs.items():
        tokens = plain_tokens(text)
        by = collections.defaultdict(list)
        for w in {8, *short}:
            for p, plain, key, slots in windows(tokens, w, w in short):
                by[plain, key].append((p, slots))
        for i, t in item_tokens.items():
            if not t:
                continue
            w = min(8, len(t))
            own = list(windows(t, w, len(t) == w))
            hits = [(at, p - at, slots, mine, plain) for at, plain, key, mine in own for p, slots in by.get((plain, key), ())]
            filling = collections.defaultdict(set)
            for _, shift, slots, mine, _ in hits:
                for a, b in zip(mine, slots, strict=True):
                    filling[shift, a].add(b)
            good = [h for h in hits if h[2] == h[3] or all(len(filling[h[1], a]) == 1 for a in h[3])]
            runs, last = [], None
            for shift in sorted({h[1] for h in good}):
                if last is None or shift - last > 4:
                    runs.append(set())
                runs[-1].add(shift)
                last = shift
            best = None
            for run in runs:
                windows_of = collections.defaultdict(list)
                for at, shift, slots, mine, plain in good:
                    if shift in run:
                        windows_of[at].append((slots == mine, plain))
                sides = []
                for only_templates in (False, True):
                    of = len({a for a, plain, _, _ in own if not (only_templates and plain)})
                    got = {a: [x for x, plain in m if not (only_templates and plain)] for a, m in windows_of.items()}
                    got = {a: any(m) for a, m in got.items() if m}
                    if of and got:
                        sides.append((len(got) / of, len(got), of, all(got.values())))
                side = max(sides)
                if side[0] >= 0.5 or len(windows_of) >= 13:
                    best = max(best or side, side)
            if best:
                found[d, i] = (best[1], best[2], best[0], best[3])
    return found


def test_leaks_against_plain_python(spark):
    """Two-sided, on documents as they are, with changed numbers and names, words put in, windows strewn about, and short items."""
    r = random.Random(12)
    items = {x.item_id: x.text for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    items |= {1000: "What is 17 * 24?", 1001: "12 7 5 3 9 11 15 22 31 40 is", 1002: "How many days in March?", 1003: "If John Smith has 12 apples and gives 5 apples to Mary then how many of the 12 apples does John Smith keep after 5 days?"}
    docs = {x.doc_id: x.text for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for k in range(200):
        words = items[r.choice(list(items))].split()
        change = r.randrange(6)
        if change == 1:
            words = [str(r.randrange(9)) if any(c.isdigit() for c in w) else w for w in words]
        elif change == 2:
            words.insert(r.randrange(len(words) + 1), "really")
        elif change == 3:
            low = r.randrange(len(words))
            words = words[low : low + r.choice((8, 12, 25))]
        elif change == 4:
            words = [x for p in range(0, len(words), 8) for x in (*words[p : p + 8], *(f"q{r.randrange(99)}" for _ in range(9)))]
        elif change == 5:
            words = [r.choice(("Ann", "Bob", "Cy")) if w[:1].isupper() else w for w in words]
        docs[10_000 + k] = " ".join(["Some", "words.", *words, "and", "more", *words[: r.choice((0, 9, 99))]])
    frame = lambda x, kind: spark.createDataFrame(list(x.items()), kind)
    found = {(x.doc_id, x.item_id): (x.n_windows, x.item_windows, x.share, x.exact) for x in templates.leaks(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string")).collect()}
    assert found == plain_leaks(docs, items)
    assert len(found) > 100 and len({x[3] for x in found.values()}) == 2


def test_windows_strewn_about_are_no_leak(spark):
    words = [f"w{k}" for k in range(26)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    strewn = " ".join(" ".join((*words[p : p + 8], *(f"x{p}{k}" for k in range(12)))) for p in range(0, 19, 2))
    close = " ".join((*words[:13], "so", "to", "say", *words[13:]))
    docs = spark.createDataFrame([(1, strewn), (2, close), (None, " ".join(words))], "doc_id long, text string").withColumn("run", F.lit(1)).withColumn("shift", F.lit("x"))
    assert [(r.doc_id, r.n_windows) for r in templates.leaks(docs, items).collect()] == [(2, 12)]


def test_leaks_of_nothing(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    assert templates.leaks(docs.limit(0), items).count() == 0
    assert templates.leaks(docs, items.limit(0)).count() == 0


# --- 2

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0


def personal(text):
    digits = lambda m: re.sub(r"\D", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)] + [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a", "Z9", "@", ".", "+", "-", " ", "(", ")", "1", "255", "256", "12.", "é", "4539578763621486", "a@b.c", "+49 30 1234567", "\n", "://"]), max_size=20).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert [x for x in pii.find(text) if x[0] in pii.BASE] == personal(text)


def test_added_kinds_and_redaction():
    text = "IBAN GB82 WEST 1234 5698 7654 32, account number: 12345678, see https://example.com/users/ann or 12 Long Green Street, write ann@example.com."
    assert [k for k, _, _ in pii.find(text)] == ["email", "iban", "account", "profile", "address"]
    assert "12345678" not in pii.redacted(text) and "ann@" not in pii.redacted(text)
    assert pii.find("A clean sentence of 12 words, 3.5 kg and 2024.") == []
    assert pii.redacted(None) is None


def test_addresses_of_any_length():
    words = "A" + "b" * 24 + " C" + "d" * 80 + " E" + "f" * 25
    for text, found in ((f"at 12 {words} Street now", True), ("7b Green Lane", True), ("x12 Green Lane", False), ("123456 Green Lane", False), ("12 green Lane", False), ("12 A B Lane", False), ("12  Green Lane", False), ("5 One Two Three Four Road", False), ("5 One Two ThreeRoad", True), ("12a3 Green Road", False)):
        assert bool([x for x in pii.find(text) if x[0] == "address"]) == found, text
    assert pii.find("12 Green StreetStreet") == [("address", 0, 15), ("address", 0, 21)]


STREET = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]? (?:[A-Z][a-z]+ ){1,3}$")
TAIL, USER = re.compile(r"[^\s\"'<>()\[\]{}]+"), re.compile(r"/(?:~|@|users?/|profile/|u/|in/)[A-Za-z0-9._-]+")


def addresses(text):
    """By trying every street word on all that is before it."""
    out = []
    for m in sorted((m for s in pii.STREETS for m in re.finditer(s, text)), key=lambda m: m.end()):
        start = m.end()
        while start and text[start - 1].isalpha():
            start -= 1
        if x := STREET.search(text[:start]):
            out.append((x.start(), m.end()))
    return out


def profiles(text):
    out = []
    for m in re.finditer("://", text):
        start = re.search(r"[A-Za-z0-9+.-]*$", text[: m.start()]).start()
        tail = TAIL.match(text, m.end())
        if start < m.start() and tail:
            authority, slash, path = tail[0].partition("/")
            if "@" in authority.strip("@") or USER.match(slash + path):
                out.append((start, tail.end()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["Street", "Lane", " ", " ", "12", "7b", "Green ", "Oak ", "x", "é", "a", "://", "http", "/users/", "ann", "@", "/", "(", "1"]), max_size=16).map("".join))
def test_added_spans_against_plain_search(text):
    found = pii.find(text)
    assert [x[1:] for x in found if x[0] == "address"] == addresses(text)
    assert [x[1:] for x in found if x[0] == "profile"] == profiles(text)


@pytest.mark.parametrize("part", ["Street", "a://", "a://b", "1", "1.", "+1 ", "a@", "12 Aa ", "account 1", "Aa", "http://x/users/", "GB82 ", "- ", "@@", "+"])
def test_long_texts_of_anchors(part):
    text = part * (2_000_000 // len(part))
    began = time.time()
    pii.find(text)
    assert time.time() - began < 10, part


def test_pii_rows(spark):
    found = pii.digest(documents(spark, [*ODD, "mail a@b.cd"])).collect()
    assert len(found) == len(ODD) + 3
    assert sum(r.n_email for r in found) == 1
    assert all(r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in found if not r.n_email)


# --- 3


def test_counts_are_those_of_a_unigram_tokenizer():
    from tokenizers import Tokenizer, models

    pieces = tokens.vocabulary(f"{TOKENIZERS}/{VOCABULARY}")
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *((f"<0x{b:02X}>", 0.0) for b in range(256)), *pieces], 0, True))
    count, r = tokens.Counter(pieces), random.Random(2)
    texts = ["".join(r.choice("ab \n\té日☃🙂the  ing▁") for _ in range(r.randrange(60))) for _ in range(800)] + [t for t in ODD if t]
    for t in texts:
        assert count(t) == (len(model.encode("▁" + t.replace(" ", "▁")).tokens) if t else 0), t


def test_ties_go_to_the_longest_piece():
    count = tokens.Counter((("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)))
    assert count("aa") == 2  # ▁a a, and ▁ aa, score the same; the longer one at the end is tried first
    assert count(None) == count("") == 0


def test_token_rows(spark):
    found = tokens.token_counts(documents(spark, ODD), f"{TOKENIZERS}/{VOCABULARY}").collect()
    assert len(found) == len(ODD) + 2
    assert {r.n_tokens for r in found if r.doc_id in (0, 1)} == {0}


# --- 4


def test_expectation_maximisation_finds_accuracies():
    r = np.random.default_rng(0)
    truth = r.random(20_000) < 0.7
    right = (0.9, 0.8, 0.75, 0.6)
    votes = np.stack([np.where(r.random(len(truth)) < 0.8, np.where(r.random(len(truth)) < p, truth, ~truth), -1) for p in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weak.expectation_maximisation(patterns.astype(np.int64), counts.astype(float), 0.5)
    found = [model.chance[1, k, 2] / model.chance[1, k, 1:].sum() for k in range(4)]
    assert abs(model.share - 0.7) < 0.08
    assert found == sorted(found, reverse=True)


def test_expectation_maximisation_against_plain_loops():
    """The same model by loops over single documents, without patterns and counts."""
    r = np.random.default_rng(5)
    truth = r.random(400) < 0.3
    votes = np.stack([np.where(r.random(400) < 0.7, np.where(r.random(400) < p, truth, ~truth), -1) for p in (0.9, 0.8, 0.7)], 1).astype(int)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    found = weak.expectation_maximisation(patterns, counts.astype(float), 0.4, rounds=7)

    n, share = len(votes), 0.4
    chance, prior = {}, {}
    for k in range(3):
        tally = collections.Counter(votes[:, k].tolist())
        nothing = (tally[-1] + 1) / (n + 3)
        for c in (0, 1):
            for v in (-1, 0, 1):
                chance[c, k, v] = nothing if v < 0 else (1 - nothing) * (weak.TRUST if v == c else 1 - weak.TRUST)
                prior[c, k, v] = (share if c else 1 - share) * chance[c, k, v] * weak.PRIOR * n + 0.1
    for _ in range(7):
        total, seen = 0.0, dict.fromkeys(chance, 0.0)
        for row in votes.tolist():
            good, bad = share, 1 - share
            for k, v in enumerate(row):
                good, bad = good * chance[1, k, v], bad * chance[0, k, v]
            p = good / (good + bad)
            total += p
            for k, v in enumerate(row):
                seen[1, k, v] += p
                seen[0, k, v] += 1 - p
        for c in (0, 1):
            for k in range(3):
                whole = sum(seen[c, k, v] + prior[c, k, v] for v in (-1, 0, 1))
                for v in (-1, 0, 1):
                    chance[c, k, v] = (seen[c, k, v] + prior[c, k, v]) / whole
        share = total / n
    assert found.share == pytest.approx(share)
    for (c, k, v), p in chance.items():
        assert found.chance[c, k, v + 1] == pytest.approx(p)


def arrow(texts):
    import pyarrow as pa

    return pa.array(texts, pa.string())


def test_words_of_a_batch():
    texts = ["  Réeux rÉeux, réeux\u00a0b\tx\x1f| |", None, "", " \n", "a", "é" * 40 + " a a"]
    w = weak.Words(arrow(texts))
    words = [(t or "").encode().split() for t in texts]
    assert w.sizes.tolist() == list(map(len, words))
    assert [w.words[int(k)].as_py().encode() for k in w.at] == [x for ws in words for x in ws]
    again = weak.Words(arrow(["zz", *texts]).slice(1))
    assert again.sizes.tolist() == w.sizes.tolist()
    text, begin = w.repeated(5)
    assert text.tolist() == [0] and len(begin) == 1  # réeux three times; the long word once


def test_votes_look_at_their_own_evidence():
    prose = "This is a plain line of words. It goes on for a while, and then it ends here. "
    texts = [prose * 1, "WORD!! LOUD!! THIS!! IS!! VERY!! MUCH!! SO!! HERE!! AND!! THERE!!", "a| | b | c | d | e | f | g |", "abc### def%%% ghi&&& jkl***", "again " * 40, "", None, "you are an idiot", "what a m0r0n and 1d10t he is", "IDIOT", "a stupid idiot, scum of the earth"]
    quality, toxic = weak.votes(weak.Words(arrow(texts)))
    q = lambda row, name: int(quality[row, weak.QUALITY.index(name)])
    t = lambda row, name: int(toxic[row, weak.TOXIC.index(name)])
    assert (q(0, "letters"), q(0, "pairs"), q(0, "sentences"), q(0, "symbols")) == (1, 1, 1, -1)
    assert (q(1, "shouting"), q(1, "letters"), q(2, "table"), q(3, "symbols"), q(4, "narrow"), q(4, "pairs")) == (0, 0, 0, 0, 0, 0)
    assert (q(5, "empty"), q(6, "empty"), q(5, "letters")) == (0, 0, -1)
    assert [t(7, k) for k in weak.TOXIC] == [1, -1, -1, -1, 1]
    assert (t(8, "disguised"), t(8, "persons"), t(9, "addressed")) == (1, -1, 1)
    assert [t(10, k) for k in ("persons", "contempt", "filth")] == [1, 1, 1]
    assert [t(0, k) for k in weak.TOXIC] == [-1] * 5


def test_long_and_short_texts_score_alike_in_any_batch():
    r = np.random.default_rng(3)
    weights = r.normal(size=(2, weak.DIMENSIONS + 1))
    score = weak.Scorer(*weights)
    texts = [" ".join(r.choice(["aa", "Bb.", "çc", "dd,", "|"], n)) for n in (3, 30_000, 1, 0, 50)] + [None]
    good, bad = score(arrow(texts))
    for k, t in enumerate(texts):
        one = score(arrow([t]))
        assert (one[0][0], one[1][0]) == (good[k], bad[k])


def test_posteriors_are_not_the_labels(spark):
    """Without labels the method reaches its accuracy held out; with them the training labels are still those of expectation-maximisation."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = weak.fit(docs)
    held = weak.scored(docs, model).join(labels, "doc_id")
    right = held.agg(F.avg(((F.col("p_quality") >= 0.5) == (F.col("quality") == 1)).cast("int")), F.avg(((F.col("p_toxic") >= 0.5) == (F.col("toxic") == 1)).cast("int"))).first()
    assert right[0] > 0.97
    assert right[1] > 0.95
    patterns = np.array(list(itertools.product((-1, 0, 1), repeat=3)))
    assert len(np.unique(model.quality.posterior(np.pad(patterns, ((0, 0), (0, len(weak.QUALITY) - 3)), constant_values=-1)).round(6))) > 5


def test_repeated_rows_and_labels_without_use(spark):
    """One id with many rows, null labels and a fit bound below the rows."""
    rows = [(1 if k < 300 else k, f"plain words number {k % 5}. They go on and on like that, row by row.") for k in range(600)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("order", F.lit("x")).withColumn("id", F.lit("y")).withColumn("toxic", F.lit(2))
    labels = spark.createDataFrame([(1, None), (None, 1), (400, 1), (400, 0), (401, 0)], "doc_id long, toxic int")
    model = weak.fit(docs, labels, fit_rows=50)
    assert weak.scored(docs, model).count() == 601
    assert weak.fit(docs, labels.limit(0), fit_rows=50, fit_places=1) is None  # room for no document
    nameless = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert weak.scored(nameless, weak.fit(nameless, labels)).where("kept").count() == weak.filtered(nameless, None).count() == 601


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = weak.fit(docs, labels.where("doc_id % 2 = 0"))
    held = weak.scored(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id")
    right = held.agg(F.avg(((F.col("p_quality") >= 0.5) == (F.col("quality") == 1)).cast("int")), F.avg(((F.col("p_toxic") >= 0.5) == (F.col("toxic") == 1)).cast("int"))).first()
    assert right[0] > 0.98
    assert right[1] > 0.97


def test_classifier_rows(spark):
    docs = documents(spark, [*ODD, *("a plain sentence of its own, number " + str(k) for k in range(60))])
    model = weak.fit(docs)
    assert weak.scored(docs, model).count() == docs.count()
    assert weak.filtered(docs, model).columns == docs.columns
    assert weak.fit(docs.limit(0)) is None
    assert weak.scored(docs.limit(0), None).count() == 0


# --- 5


def linked(texts):
    def grams(t):
        w = (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    sets = {k: grams(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in texts}


def edited(r, words, share):
    return [r.choice("uvwxyz") * r.randint(1, 9) if r.random() < share else w for w in words]


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(7)
    texts = dict(enumerate(ODD))
    for _ in range(6):
        base = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(r.choice((30, 120, 400)))]
        for _ in range(12):
            texts[len(texts)] = " ".join(edited(r, base, r.choice((0, 0.005, 0.02, 0.04, 0.06))))
    rows = spark.createDataFrame([*texts.items(), (None, texts[12]), (12, texts[12])], "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("key", F.lit(1))
    found = minhash.near_duplicates(rows).collect()
    assert len(found) == len(texts) + 2
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in found if x.doc_id is not None} == linked(texts)
    assert all(x.kept == (x.doc_id == x.component_id) for x in found if x.doc_id is not None)


def test_a_family_of_edits_keeps_all_links(spark):
    """Many documents that are alike, but often not alike enough, share their buckets; the smallest is one of the least alike."""
    r = random.Random(11)
    base = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(150)]
    texts = {k: " ".join(edited(r, base, 0.09 if k < 3 else r.choice((0.01, 0.03, 0.05, 0.08)))) for k in range(120)}
    found = minhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in found} == linked(texts)


def test_no_documents(spark):
    assert minhash.near_duplicates(documents(spark, ODD).limit(0)).count() == 0


def test_minima_estimate_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 1000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[:800], r.integers(0, 2**63, 200, dtype=np.uint64)]))
    share = (minhash.minima([a, b])[0] == minhash.minima([a, b])[1]).mean()
    assert abs(share - 800 / 1200) < 0.12


def test_alternating_stars(spark):
    r = random.Random(3)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 140)]
    nodes = {n for e in edges for n in e}
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = {x.a: x.b for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for n in nodes if find(n) != n}


def test_short_and_blank_sets():
    assert len(shingles.shingle_set(None)) == len(shingles.shingle_set(" \n")) == 0
    assert len(shingles.shingle_set("a b")) == 1
    assert shingles.shingle_set("A b c d E")[0] == shingles.shingle_set("a b c d e")[0]
    assert shingles.shingle_set("É")[0] != shingles.shingle_set("é")[0]


# --- 6


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=4))
def test_longest_repeats(docs):
    def brute(words):
        out = []
        for i in range(len(words)):
            best = 0
            for j in range(len(words)):
                k = 0
                while i != j and max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                    k += 1
                best = max(best, k)
            out.append(best)
        return out

    starts = np.array([0, *itertools.accumulate(map(len, docs))])
    words = np.array([w for d in docs for w in d], np.int64)
    assert repeats.longest_repeats(words, starts).tolist() == [x for d in docs for x in brute(d)]


def test_quality_rows(spark):
    found = {r.doc_id: r for r in repeats.quality(documents(spark, [*ODD, " ".join(f"w{k}" for k in range(300)), " ".join(f"w{k % 250}" for k in range(500))])).collect()}
    assert (found[0].n_words, found[2].n_words, found[6].n_words) == (0, 0, 3000)
    assert found[6].base_failed and found[6].n_repeat_words == 3000
    assert found[len(ODD)].kept and not found[len(ODD)].base_failed
    assert found[len(ODD) + 1].longest_repeat == 250 and not found[len(ODD) + 1].kept


def test_the_method_rejects_what_the_base_lets_pass():
    r = random.Random(8)
    own = lambda n: [f"v{r.randrange(10**9)}" for _ in range(n)]
    passage, phrases = own(60), [own(5) for _ in range(8)]
    once = " ".join([*own(300), *passage, *own(100), *passage, *own(200)])
    often = " ".join(w for k in range(40) for w in (*phrases[k % 8], *own(6)))
    found = repeats.profile([once, often, " ".join(own(300))])
    assert found["base_failed"].tolist() == [False, False, False]
    assert found["kept"].tolist() == [False, False, True]
    assert found["longest_repeat"].tolist() == [60, 5, 0]
    assert found["n_covered_chars"][1] == sum(len(w) for p in phrases for w in p) * 5


def test_long_repeats_in_long_texts():
    """A million words: one that repeats throughout, and one with a passage that comes twice."""
    began = time.time()
    words = [f"w{k}" for k in range(500_000)]
    found = repeats.profile(["ab " * 1_000_000, " ".join([*words, *words[1000:250_000]])])
    assert found["longest_repeat"].tolist() == [999_999, 249_000]
    assert found["n_repeat_words"].tolist() == [1_000_000, 498_000]
    assert time.time() - began < 60


# --- 7


def test_common_prefix_is_rendered_once(spark):
    turn = lambda n, role, text: {"turn": n, "role": role, "text": text}
    kind = "array<struct<turn:long,role:string,text:string>>"
    a = [turn(0, "system", "s"), turn(1, "user", "u"), turn(2, "assistant", "good")]
    b = [turn(0, "system", "s"), turn(5, "user", "u"), turn(6, "assistant", "bad"), turn(7, "user", "more")]
    rows = [(1, a, b), (2, a, a), (3, a, None), (4, None, b), (5, [], a), (6, a[:2], a)]
    found = {r.id: r for r in preferences.formatted(spark.createDataFrame(rows, f"id long, chosen {kind}, rejected {kind}")).collect()}
    one = found[1]
    assert one.prompt == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n"
    assert one.chosen == "<|im_start|>assistant\ngood<|im_end|>\n"
    assert [one.chosen[s.start : s.end] for s in one.chosen_mask] == ["good<|im_end|>\n"]
    assert [one.rejected[s.start : s.end] for s in one.rejected_mask] == ["bad<|im_end|>\n"]
    assert {k: r.status for k, r in found.items()} == {1: "pair", 2: "equal", 3: "no rejected", 4: "no chosen", 5: "pair", 6: "pair"}
    assert (found[5].prompt_turns, found[6].prompt_turns, found[6].chosen) == (0, 2, "")


def test_pairs_of_conversations(spark):
    turns = spark.createDataFrame([(0, 0, "user", "q"), (0, 1, "assistant", "a"), (1, 0, "user", "r"), (1, 1, "assistant", None), (2, 0, "user", "z"), (None, 0, "user", "x"), (3, None, None, None)], "conv_id long, turn long, role string, text string")
    found = {r.id: r for r in preferences.formatted(preferences.answer_pairs(turns)).collect()}
    assert {k: r.status for k, r in found.items()} == {0: "pair", 1: "pair", 2: "no rejected", 3: "no rejected"}
    assert found[0].rejected == "<|im_start|>assistant\n<|im_end|>\n"


def test_turns_after_the_answer_stay_on_both_sides(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 2, "user", "thanks"), (1, 0, "assistant", "b"), (2, 0, "assistant", "c"), (2, 1, "user", "d"), (3, 0, "assistant", "c")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("last", F.lit(9)).withColumn("other", F.lit("x"))
    found = {r.id: r for r in preferences.formatted(preferences.answer_pairs(turns)).collect()}
    shown = lambda *x: "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in x)
    assert (found[0].prompt, found[0].chosen, found[0].rejected) == (shown(("user", "q")), shown(("assistant", "a"), ("user", "thanks")), shown(("assistant", "b"), ("user", "thanks")))
    assert [(x.start, x.end) for x in found[0].chosen_mask] == [(x.start, x.end) for x in found[0].rejected_mask]
    assert (found[2].status, found[2].chosen, found[2].prompt_turns) == ("equal", "", 2)
    assert preferences.formatted(preferences.answer_pairs(turns.limit(0))).count() == 0


# --- 8

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secret_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secrets_against_the_patterns(spark):
    r = random.Random(4)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", ":", "=", '"', "'", " ", "AKIA", "A1", "Z9QQQQQQ", "a1b2c3d4", "f0", "é", "🙂", "abcdef", ".", "\n", "ſecret", "tokens"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(30))) for _ in range(1500)]
    found = secrets.verdicts(documents(spark, texts)).collect()
    assert len(found) == len(texts) + 2
    for x in found:
        if x.doc_id is not None:
            assert x.base_sha256 == hashlib.sha256(secret_spans(texts[x.doc_id]).encode()).hexdigest(), texts[x.doc_id]


def test_owners_tell_examples_from_credentials(spark):
    live, copied = "token = 9f8e7d6c5b4a39281706f5e4d3c2b1a0", "password: hunter22hunter"
    rows = [(1, live, "a", "en"), (2, live, "a", "en"), *((k, copied, f"o{k}", "en") for k in range(3, 9)), (9, None, None, None), (9, "", None, None)]
    found = {r.doc_id: r for r in secrets.verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert (found[1].n_live, found[1].n_copied) == (1, 0)
    assert all((found[k].n_live, found[k].n_copied) == (0, 1) for k in range(3, 9))
    assert found[9].spans == ""


@pytest.mark.parametrize("part", ["eyJ", "eyJ-", "eyJa.", "password", "password ", "gho_", "xoxb-", "AKIA", "-----BEGIN ", "a1"])
def test_long_texts_of_cues(part, spark):
    rows = spark.createDataFrame([(1, part * (500_000 // len(part)), "s", "en")], "doc_id long, text string, source string, lang string")
    began = time.time()
    assert secrets.verdicts(rows).count() == 1
    assert time.time() - began < 20, part


def test_repositories_count(spark):
    """One owner's value in many of its repositories is no live credential; tokens of three parts are found whole."""
    one, two = "token = 9f8e7d6c5b4a39281706f5e4d3c2b1a0", "secret: qW8eR7tY6uI5oP4a"
    jwt = "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK"
    rows = [*((k, one, "a", f"l{k}") for k in range(4)), *((k, two, "b", f"l{k}") for k in range(10, 15)), (20, f"see {jwt}. eyJno.eyJno.no", "c", "en")]
    found = {r.doc_id: r for r in secrets.verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()}
    assert (found[0].n_live, found[0].n_shared, found[0].most_owners, found[0].most_repos) == (0, 1, 1, 4)
    assert (found[10].n_copied, found[10].most_repos) == (1, 5)
    assert found[20].spans == f"jwt:4:{4 + len(jwt)}"


# --- 9


def pages(spark):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, "other é"), (3, None, "other é"), (4, "u\r\nv: w", ""), (5, "x", None), (None, "y", "same"), (None, "z", "alone")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("id", F.lit(1)).withColumn("digest", F.lit("x"))


def test_archives_round_trip(spark, tmp_path):
    bundles = warc.write(pages(spark))
    found = sorted((-1 if r.page_id is None else r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read(bundles).collect())
    assert found == [(-1, 4, "revisit", 2), (-1, 5, "response", None), (1, 4, "revisit", 2), (2, 4, "response", None), (3, 8, "response", None), (3, 8, "response", None), (4, 0, "revisit", 5), (5, 0, "response", None)]
    digests = {r.payload_digest for r in warc.read(bundles).where("page_id = 2").collect()}
    assert digests == {base64.b32encode(hashlib.sha1(b"same").digest()).decode()}
    data = {r.bundle: r.data for r in bundles.collect()}
    for r in warc.index(bundles).collect():
        fields, payload = warc.fetch(data[r.bundle], r.frame, r.offset)
        assert fields["WARC-Record-ID"] == f"<urn:page:{'none' if r.id is None else r.id}>"
    made = warc.export(bundles, str(tmp_path)).collect()
    import zstandard

    for r in made:
        plain = zstandard.ZstdDecompressor().stream_reader(open(r.path, "rb"), read_across_frames=True).read()
        assert sum(1 for _ in warc.parsed(plain)) == sum(len(x.records) for x in bundles.where(F.col("bundle") == r.bundle).collect())


def test_frames_are_independent():
    b = warc.Bundle()
    for k in range(40):
        b.add(k, warc.record(k, "u", bytes([k]) * 20_000, "D", None))
    data = b.bytes()
    table = warc.seek_table(data)
    assert len(table) > 2
    for k, f, o, n in b.index:
        assert warc.fetch(data, f, o)[1] == bytes([k]) * 20_000
        assert len(warc.record(k, "u", bytes([k]) * 20_000, "D", None)) == n


def test_no_pages(spark):
    assert warc.read(warc.write(pages(spark).limit(0))).count() == 0


# --- 10


def share_out(sizes, weights=(5, 2, 1)):
    """Targets by resharing the excess until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        level = rest / sum(w[s] for s in free) if free else 0
        over = [s for s in free if level * w[s] > 3 * sizes[s]]
        if not over:
            return {s: 3 * sizes[s] if s in capped else level * w[s] for s in order}
        capped |= set(over)


def test_mixing(spark):
    r = random.Random(6)
    rows = [(k, " ".join("w" for _ in range(r.randrange(1, 200))), r.choice(["a", "a", "a", "b", "c", None, "é"])) for k in range(900)] + [(900, None, "a"), (None, "x y", "b"), (5, "x y", "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit(-1)).withColumn("key", F.lit("q"))
    found = mixing.sampled(df).collect()
    assert len(found) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken, longest = share_out(sizes), collections.Counter(), collections.Counter()
    for x in found:
        assert x.target == pytest.approx(want[x.source])
        assert x.source_size == sizes[x.source]
        assert x.copies <= 3 and x.taken == x.copies * x.size
        taken[x.source] += x.taken
        longest[x.source] = max(longest[x.source], x.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] + 1
    again = mixing.sampled(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mixed(df.where("doc_id is not null and doc_id <> 5"), text_col="text").count() > 0


def test_targets_of_sources_that_tie(spark):
    for sizes in ({"a": 90, "b": 90, "c": 90, "d": 90}, {"a": 500, "b": 200, "c": 100, "d": 7, None: 200}, {"a": 5, "b": 2, "c": 1, "d": 5}):
        df = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()], "no_source boolean, source string, source_size long")
        found = {None if r.no_source else r.source: r.target for r in mixing.targets(df).collect()}
        assert found == pytest.approx(share_out(sizes))
        assert sum(found.values()) == pytest.approx(sum(sizes.values()))


def test_the_mix_has_a_row_for_each_copy(spark):
    rows = [(k % 40 if k % 9 else None, f"n{k} " + "w " * (k % 30), "abc"[k % 3] if k < 60 else "a") for k in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken, made = collections.Counter(), collections.Counter()
    for x in mixing.sampled(df).collect():
        taken[x.source] += x.copies
    mix = mixing.mixed(df)
    assert mix.columns == [*df.columns, "copy_no"]
    found = [(r.doc_id, r.text, r.source, r.copy_no) for r in mix.collect()]
    for *_, source, _n in found:
        made[source] += 1
    assert made == +taken
    assert len(set(found)) == len(found) and {x[:3] for x in found} < set(rows)


def test_empty_tables(spark):
    none = documents(spark, ODD).limit(0)
    assert pii.digest(none).count() == pii.scan(none).count() == pii.redact(none).count() == 0
    assert tokens.token_counts(none, f"{TOKENIZERS}/{VOCABULARY}").count() == 0
    assert repeats.quality(none).count() == secrets.verdicts(none).count() == mixing.mixed(none).count() == 0


def test_a_hot_size_is_dealt_to_many_buckets(spark):
    """A third of a source's rows have one size; reruns and other bucket sizes agree."""
    rows = [(k, "w " * (7 if k % 3 == 0 else k % 90), "a" if k % 10 else "b") for k in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("class", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("n", F.lit(3))
    found = sorted(mixing.sampled(df).collect(), key=str)
    was, mixing.BUCKET_ROWS = mixing.BUCKET_ROWS, 2
    try:
        assert sorted(mixing.sampled(df.repartition(5)).collect(), key=str) == found
    finally:
        mixing.BUCKET_ROWS = was
    assert mixing.mixed(df, number_col="times").columns == [*df.columns, "times"]


def test_no_sources(spark):
    assert mixing.sampled(documents(spark, ODD).limit(0)).count() == 0


def test_part_of_a_long_item_is_a_leak(spark):
    words = [f"w{k}" for k in range(80)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = documents(spark, ["own text " + " ".join(words[30:55]) + " and more", "own text " + " ".join(words[30:42]) + " and more", "x", "y"])
    assert [r.doc_id for r in templates.leaks(docs, items).collect()] == [0]
