"""Removal of repeated strings against counting every string, and the suffix sort against plain sorting."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotally.llm import suffix_dedup as sd
from tests.llm.helpers import DOCS, ODD_TEXTS, clashing, docs

NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def brute(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k : k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def shown(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["alpha", "beta", "gamma", "δέλτα", "e", "ff", "☃", "\n", "  "]

    def text(k):
        return " ".join(rng.choice(words) for _ in range(k))

    passages = [text(60) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [text(rng.randrange(40)) for _ in range(3)]
        if rng.random() < 0.6:
            parts.insert(rng.randrange(4), rng.choice(passages))
        texts.append(" ".join(parts))
    for _ in range(n // 4):
        t = rng.choice(texts)
        k = rng.randrange(len(t) + 1)
        texts.append(rng.choice([t, t[:k] + "x" + t[k:], t[k:] + t[:k], t[:k], t + t]))
    return texts + ["a" * 300, "ab" * 700, "a" * 12, "abc" * 5, "z" * 11] + ODD_TEXTS


@pytest.mark.parametrize("depth", [1, 5, 12, 40])
def test_suffix_order(depth):
    rng = np.random.default_rng(depth)
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 50, 301, 302, 303]:
        for size in (1, 2, 5, 300):
            s = rng.integers(1, size + 1, n)
            order = sd.suffix_order(s, depth)
            assert sorted(order) == list(range(n))
            heads = [s[k : k + depth].tolist() for k in order]
            assert heads == sorted(heads)


def test_names_of_many_symbols(monkeypatch):
    s = np.random.default_rng(0).integers(1, 9, 400)
    want = sd.suffix_order(s, 400)
    monkeypatch.setattr(sd, "MOST_SYMBOLS", 3)
    assert (sd.suffix_order(s, 400) == want).all()


@pytest.mark.parametrize(("length", "most"), [(12, None), (12, 60), (40, None), (200, None), (200, 500), (5, None), (1, None)])
def test_equal_to_counting(spark, length, most):
    texts = corpus(length)
    rows = list(enumerate(texts))
    got = sd.digest_of_kept(docs(spark, texts).repartition(5), length=length, most_of_anchor=most)
    assert shown(got) == brute(rows, length)


def test_parts_and_long_stretches(spark, monkeypatch):
    monkeypatch.setattr(sd, "PART", 100)
    monkeypatch.setattr(sd, "MOST_STARTS", 16)
    monkeypatch.setattr(sd, "SORTED_AT_ONCE", 300)
    texts = corpus(3)
    assert shown(sd.digest_of_kept(docs(spark, texts), length=20)) == brute(list(enumerate(texts)), 20)


def test_repeated_rows_null_ids_and_more_columns(spark):
    long = "one passage that is said again and again, word for word, by all who say it. "
    rows = [(1, long), (1, long), (None, long + "x"), (None, None), (2, "other " + long[:40]), (3, "no")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    more = clashing(df).withColumn("at", F.lit(1)).withColumn("anchor", F.lit("x"))
    assert shown(sd.digest_of_kept(more, length=30)) == brute(rows, 30)
    assert sd.digest_of_kept(spark.createDataFrame([], DOCS)).count() == 0
    names = spark.createDataFrame([("p", long), ("q", long)], "name string, body string")
    assert [r.n_removed for r in sd.without_repeats(names, 30, "name", "body").collect()] == [len(long)] * 2


def test_counted_starts_that_follow_each_other_are_one_run(spark):
    rng = random.Random(9)
    said = "".join(rng.choice("abcdefgh") for _ in range(60))
    texts = [f"{k:03d}{said}{k:03d}" for k in range(40)] + [f"x{said}y"] * 30 + [said[:30] + "-" + said[:30]]
    rows = docs(spark, texts).select("text", F.col("doc_id").alias("t1"), F.lit(0).cast("long").alias("t2"))

    def spans(most):
        return {r.t1: sorted(tuple(s) for s in r.spans) for r in sd.repeated_spans(rows, 20, most).collect()}

    # A row of each start and copy would be carried back to the texts otherwise.
    assert spans(1) == spans(None)


def test_spans_and_kept_bytes(spark):
    passage = "".join(chr(97 + k * 7 % 26) for k in range(60))
    got = {r.doc_id: r for r in sd.without_repeats(docs(spark, ["é" + passage + "!", "?" + passage, "none"]), length=50).collect()}
    assert [tuple(s) for s in got[0].spans] == [(2, 62)] and bytes(got[0].kept) == "é!".encode()
    assert [tuple(s) for s in got[1].spans] == [(1, 61)] and bytes(got[1].kept) == b"?"
    assert got[2].spans == [] and bytes(got[2].kept) == b"none"


def test_one_exchange_of_texts(spark):
    plan = sd.digest_of_kept(docs(spark, ["x" * 300] * 3 + ["y" * 400]), length=200)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final or "BroadcastHashJoin" in final
