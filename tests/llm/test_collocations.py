"""Phrase mining against counting every phrase in plain Python."""

import random
import re
from collections import Counter

import pytest

from geotally.llm import collocations as co
from tests.llm.helpers import DOCS, ODD_TEXTS, clashing


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least, longest, top):
    totals, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    candidates = {c: n for c, n in counts.items() if len(c[1]) > 1 and n >= least}
    inside = Counter()
    for (lang, p), n in candidates.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(inside[lang, p[i : i + k]], n)
    by = {}
    for (lang, p), a in candidates.items():
        if inside[lang, p] < a:
            cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), a, l, r, totals[lang], score))
    return {(lang, k, x[2].decode(), *x[3:]) for lang, xs in by.items() for k, x in enumerate(sorted(xs)[:top], 1)}


def corpus(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(25)] + ["É", "Straße", "X", "x", "ÀB", " ", "a b", "\x01"]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!", "\x0b", "\x1c"]
    texts = ["".join(rng.choice(vocabulary) + rng.choice(ends) for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["the New York times are here. "] * 40 + ["New York. new york city"] * 30 + ["very very very very very very very"] * 5 + ODD_TEXTS
    rows = [(k, t, rng.choice(["en", "de", None]), None, None) for k, t in enumerate(texts)]
    rows += [(None, "New York is it", "en", None, None)] * 12
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCS).repartition(3), [(r[2], r[1]) for r in rows]


def shown(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in df.collect()]
    assert len(set(got)) == len(got)
    return set(got)


@pytest.mark.parametrize(("least", "longest", "top"), [(10, 5, 2000), (3, 4, 7), (5, 2, 50)])
def test_equal_to_counting(spark, least, longest, top):
    docs, rows = corpus(spark)
    want = brute(rows, least, longest, top)
    assert len(want) > 5
    assert shown(co.collocations(docs, least, longest, top)) == want


def test_semi_joins_that_shuffle_and_small_holds(spark, monkeypatch):
    docs, rows = corpus(spark)
    for name in ("SENT_WORDS", "SENT_PAIRS"):
        monkeypatch.setattr(co, name, 0)
    monkeypatch.setattr(co.word_occurrences, "__defaults__", (0,))
    monkeypatch.setattr(co.longer_occurrences, "__defaults__", (0,))
    monkeypatch.setattr(co, "HELD_WORDS", 5)
    monkeypatch.setattr(co, "HELD_PAIRS", 20)
    assert shown(co.collocations(docs, 6, 5, 2000)) == brute(rows, 6, 5, 2000)


def test_products_beyond_64_bits(spark):
    counts = [(1, "en", ["a", "b"], 10**13, 2 * 10**13, 3 * 10**13)]
    one = spark.createDataFrame([(1, "en", ["a"], [2 * 10**13], [2 * 10**13], 2 * 10**13), (2, "en", ["b"], [3 * 10**13], [3 * 10**13], 3 * 10**13)],
                                "id long, lang string, words array<string>, heads array<long>, tails array<long>, n long")
    two = co._phrases(spark.createDataFrame([(1, 2, counts[0][3])], "left long, right long, n long"), one, 100)
    total = spark.createDataFrame([("en", 9 * 10**14)], "lang string, total long")
    keep = co.frequent_phrases
    try:
        co.frequent_phrases = lambda *_: (total, [one, two])
        got = co.collocations(one, longest=2).first()
    finally:
        co.frequent_phrases = keep
    assert got.score == 1000 * 10**13 * 9 * 10**14 // (2 * 10**13 * 3 * 10**13) and got.phrase == "a b"


def test_no_rows_and_more_columns(spark):
    none = spark.createDataFrame([], DOCS)
    assert co.collocations(none).count() == 0
    assert co.collocations(spark.createDataFrame([(1, None, None, None, None)], DOCS), least=1).count() == 0
    docs, rows = corpus(spark)
    assert shown(co.collocations(clashing(docs).withColumnRenamed("ok", "words"), 10)) == brute(rows, 10, 5, 2000)
