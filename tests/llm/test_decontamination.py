import hashlib
import random
import re

import pytest

from geotally.llm.decontamination import Matcher, contamination, windows, without_contaminated
from tests.llm.helpers import ODD_TEXTS, clashing, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w = split(text)
    hit, met = set(), set()
    for item, t in items:
        v = split(t)
        size = min(10, len(v))
        for j in range(len(v) - size + 1 if v else 0):
            for i in range(len(w) - size + 1):
                if w[i : i + size] == v[j : j + size]:
                    hit |= set(range(i, i + size))
                    met.add(str(item))
    return len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


def sample():
    rng = random.Random(5)
    vocabulary = ["the", "a", "of", "Straße", "x1", "été", "long", "longer", "word", "日本"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 9, 10, 14, 30])))) for k in range(8, 22)]
    items += [(90, None), (91, " ,. "), (92, items[0][1].upper())]
    texts = [*ODD_TEXTS]
    for _ in range(40):
        w = rng.choices(vocabulary + ["filler", "other"], k=rng.randint(0, 80))
        if rng.random() < 0.7:
            at = rng.randint(0, len(w))
            w[at:at] = (rng.choice(items)[1] or "").split()
        texts.append(rng.choice([" ", ", ", "\n"]).join(w))
    return texts, items


@pytest.mark.parametrize("block_bytes", [10**6, 200])
def test_equals_brute_force(spark, block_bytes):
    texts, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(clashing(docs(spark, texts)), clashing(bench.withColumnRenamed("item_id", "item")).withColumnRenamed("item", "item_id"), block_bytes=block_bytes)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()}
    assert got == {k: brute(t, items) for k, t in enumerate(texts)}


def test_repeated_rows_stay_as_many_in_every_number_of_passes(spark):
    df = spark.createDataFrame([(1, "alpha beta"), (1, "alpha beta"), (1, "gamma")], "doc_id long, text string")
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(["alpha beta", "gamma", "delta", "zeta eta"])], "item_id long, text string")
    for block_bytes in (10**6, 6):
        got = sorted((r.n_words, r.n_hit) for r in contamination(df, bench, block_bytes=block_bytes).collect())
        assert got == [(1, 1), (2, 2), (2, 2)]


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs(spark, []), bench).collect() == []
    assert [r.contaminated for r in contamination(docs(spark, ["a b", None]), bench).collect()] == [False, False]


def test_occurrences_at_ends_of_stretches_and_texts():
    item = " ".join(f"token{k}" for k in range(10))
    matcher = Matcher([("7", item)])
    for pad in range(900, 1100, 7):
        text = "z" * pad + " " + item + " tail"
        (n, spans, items), (m, none, _) = matcher.scan([text, item[:-1]])
        assert (n, spans, items) == (12, [[1, 11]], ["7"]) and not none and m == 10
    assert len(windows(item + " more")) == 2


def test_rows_that_stay_by_text(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(None, f"x {item} y"), (1, f"x {item} y"), (1, "clean text"), (None, "clean too"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' AS key")
    benchmark = spark.createDataFrame([("i", item)], "item_id string, text string")
    got = without_contaminated(df, benchmark)
    assert got.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in got.collect()) == [("1", "clean text"), ("2", "None"), ("None", "clean too")]
