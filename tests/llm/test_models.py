"""Held-out accuracy of the learned operators, and what they do on odd input."""

import zlib

import numpy as np
import pytest

from geotally.llm import language_id, quality_crf, toxicity
from tests.conftest import DATA
from tests.llm.helpers import ODD_TEXTS, clashing, docs

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    folder = DATA.parent / "sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_language_of_held_out_documents(tables):
    documents, _ = tables
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    got = language_id.identify(documents).collect()
    assert {r.doc_id for r in got} == set(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.95


def test_language_of_odd_texts(spark):
    texts = [*ODD_TEXTS, "123 !?", "der die das " * 20, "the and of " * 20]
    df = docs(spark, texts).drop("lang").selectExpr("*", "CASE WHEN text LIKE 'd%' THEN 'de' WHEN text LIKE 't%' THEN 'en' END AS lang")
    got = {r.doc_id: r for r in language_id.identify(clashing(df)).collect()}
    for k, t in enumerate(texts):
        assert (got[k].lang_pred == "und") == (not any(c.isalpha() for c in t or ""))
    empty = language_id.identify(docs(spark, ["no languages known", None])).collect()
    assert [(r.lang_pred, r.score) for r in empty] == [("und", 0.0)] * 2
    assert language_id.identify(docs(spark, [])).collect() == []


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    net = language_id.ByteConvNet(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(1, 256, (6, language_id.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])

    def loss():
        return -np.log(net.predict(x)[np.arange(6), y]).mean()

    grads = net.gradients(x, y)
    for name, g in grads.items():
        k = np.unravel_index(np.abs(g).argmax(), g.shape)
        step, old = 1e-5, net.p[name][k]
        net.p[name][k] = old + step
        up = loss()
        net.p[name][k] = old - step
        down = loss()
        net.p[name][k] = old
        assert abs((up - down) / (2 * step) - g[k]) < 1e-3 * max(1, abs(g[k]))


def test_quality_of_held_out_documents(tables):
    documents, labels = tables
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_crf.quality(documents, labels).collect()
    assert len(got) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([truth[r.doc_id] == r.predicted for r in held]) > 0.9


def test_quality_of_odd_texts(spark):
    df = docs(spark, [*ODD_TEXTS, *["good line here.\nanother one.", "### ### ###\n$$$ $$$"] * 20])
    labels = spark.createDataFrame([(k, k % 2 if k >= len(ODD_TEXTS) else None, None) for k in range(df.count())], LABELS)
    got = quality_crf.quality(clashing(df), labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    none = quality_crf.quality(df, spark.createDataFrame([], LABELS)).collect()
    assert {r.predicted for r in none} == {1}
    assert quality_crf.quality(docs(spark, []), labels).collect() == []


def test_marginals_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(3)
    model = quality_crf.LineCrf(np.zeros(quality_crf.WIDTH), rng.normal(size=(2, 2)))
    scores = [rng.normal(size=n) for n in (4, 1, 6, 4)]
    good, expected = model.marginals(scores)
    moves = np.zeros((2, 2))
    for s, g in zip(scores, good, strict=True):
        total, ones, met = 0.0, np.zeros(len(s)), np.zeros((2, 2))
        for y in product((0, 1), repeat=len(s)):
            p = np.exp(sum(a for a, b in zip(s, y, strict=True) if b) + sum(model.steps[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += p
            ones += p * np.array(y)
            for a, b in zip(y, y[1:], strict=False):
                met[a, b] += p
        assert np.allclose(g, ones / total)
        moves += met / total
    assert np.allclose(moves, expected)


def test_toxicity_of_held_out_documents(tables):
    documents, labels = tables
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.toxicity(documents, labels).collect()
    assert len(got) == documents.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([truth[r.doc_id] == r.predicted for r in held]) > 0.85


def test_toxicity_of_odd_texts(spark):
    df = docs(spark, [*ODD_TEXTS, *["you idiot there", "you friend there"] * 20])
    labels = spark.createDataFrame([(k, None, 1 - k % 2 if k >= len(ODD_TEXTS) + 1 else None) for k in range(df.count())], LABELS)
    got = toxicity.toxicity(clashing(df), labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    none = toxicity.toxicity(df, spark.createDataFrame([], LABELS)).collect()
    assert {r.predicted for r in none} == {0}
    assert toxicity.toxicity(docs(spark, []), labels).collect() == []


def brute_restored(model, seen):
    """All readings of a disguised word, and the cheapest."""
    t = toxicity
    ways, last = [("", "  ", 0.0)], ""
    for c in seen:
        options = [(c, 0.0)] + ([("", t.REPEAT)] if c == last else []) if c.isalpha() else [(x, t.LOOK) for x in t.LOOKS_LIKE.get(c, "")]
        if not c.isalpha():
            options += [(x, t.HIDE) for x in model.letters] if c in t.HIDES else []
            options.append(("", t.SPACE if c in " ._-*#'" else t.REPEAT if c == last else t.DROP))
            options += [(" ", t.PART)] if c in t.SEPARATORS else []
        last = c
        ways = [(p + x, "  " if x == " " else s[1] + x if x else s, cost + price + (model.cost(s + x) if x else 0)) for p, s, cost in ways for x, price in options]
    return min((cost + model.cost(s + " "), p) for p, s, cost in ways)[1]


def test_disguised_words_are_restored(spark):
    words = "idiot moron stupid scum clown people thing other there these their about would which could first after where " * 30
    model = toxicity.char_model(docs(spark, [words]))
    for seen, hidden in {"1d10t": "idiot", "$tup1d": "stupid", "s c u m": "scum", "m0r0n": "moron", "iiidiooot": "idiot", "c.l.o.w.n": "clown", "sc*m": "scum", "s c u m c l o w n": "clown"}.items():
        assert hidden in toxicity.word_forms(seen, model), (seen, toxicity.word_forms(seen, model))
        if len(seen) < 10:
            assert model.restored(seen) == brute_restored(model, seen)
    assert toxicity.word_forms("people", model) == ["people"]
    assert toxicity.word_forms("4111", model) == []


def test_disguise_is_scored_like_the_word_it_hides(spark):
    rng = np.random.default_rng(0)
    clean = "people thing other there these their about would which could first after where sound water".split()
    texts = [" ".join(rng.choice(clean, 12)) + (" you idiot moron" if k % 3 == 0 else "") for k in range(240)]
    texts += ["these people would " + x for x in ("1d10t m0r0n", "i d i o t m o r o n", "iiidiot moooron", "i.d.i.o.t m-o-r-o-n", "water sound")]
    labels = spark.createDataFrame([(k, None, int(k % 3 == 0)) for k in range(240)], LABELS)
    got = {r.doc_id: r.predicted for r in toxicity.toxicity(docs(spark, texts), labels).collect()}
    assert [got[k] for k in range(240, 245)] == [1, 1, 1, 1, 0]


def test_char_counts_are_of_all_documents(spark):
    texts = ["abc abc", "abc, xyz", None, "日本"]
    model = toxicity.char_model(docs(spark, texts))
    assert model.counts == {"  a": 3, " ab": 3, "abc": 3, "bc ": 3, "  x": 1, " xy": 1, "xyz": 1, "yz ": 1}


def test_quality_of_documents_with_text_ids_learned_from_whole(spark, monkeypatch):
    bad, good = "buy now !!! | | | 99 99 99 99\n" * 3, "A sentence of plain words that ends as it should.\n"
    rows = [(f"id{k}", bad + good * 150 if k % 2 else good * 153) for k in range(60)] + [("long", good * 500)]
    labels = [(f"id{k}", 1 - k % 2, 0) for k in range(60)] + [("long", 0, 0)]
    documents = spark.createDataFrame(rows, "doc_id string, text string")
    marks = spark.createDataFrame(labels, "doc_id string, quality int, toxic int")
    got = {r.doc_id: r.predicted for r in quality_crf.quality(documents, marks).collect()}
    # Bad lines are at the head only, far from the middle; a document beyond the bound is scored, but not learned from.
    assert [got[f"id{k}"] for k in range(60)] == [1 - k % 2 for k in range(60)] and got["long"] == 1
    assert {type(r.doc_id) for r in quality_crf.quality(documents, marks).collect()} == {str}


def test_every_telling_word_counts(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"bad{letters[k // 676]}{letters[k // 26 % 26]}{letters[k % 26]}word" for k in range(17_000)]
    words += [f"ill{letters[k // 676]}{letters[k // 26 % 26]}{letters[k % 26]}word" for k in range(5_000)]
    rows = [(k, " ".join(["plain text here"] + (words if k % 2 else []))) for k in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(k, 1, k % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    model = toxicity.trained(documents, marks)
    assert not hasattr(toxicity, "MOST_FEATURES")
    # Words with tripled letters are restored first, so that they are one word with another.
    assert sum(f.startswith("=") for f in model.odds) > 20_000
    assert "=badxyzword" in model.odds and "=illabcword" in model.odds
