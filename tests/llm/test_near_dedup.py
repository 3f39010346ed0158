import random

import pytest

from pyspark.sql import functions as F

import corpus_pipeline

from geotally.llm import near_dedup
from geotally.llm.common import table
from geotally.llm.near_dedup import without_near_duplicates
from tests.conftest import DATA
from tests.llm.helpers import DOCS, ODD_TEXTS, clashing, docs
from tests.llm.test_simhash import brute_components, brute_fingerprint


def brute_set(text, k=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(texts, least=0.8):
    sets, label = [brute_set(t) for t in texts], list(range(len(texts)))
    pairs = [(a, b) for a in label for b in label[:a] if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {k for k, c in enumerate(label) if k == c}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def sample():
    rng = random.Random(4)
    texts = [*ODD_TEXTS]
    for k in range(25):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([40, 120, 300]))]
        texts += [edited(rng, base, rng.randint(0, len(base) // 20)) for _ in range(5)]
    group = [f"g{k}" for k in range(150)]
    return texts + [edited(rng, group, rng.randint(2, 8)) for _ in range(60)]


def test_equals_brute_force(spark):
    texts = sample()
    got = {r.doc_id for r in without_near_duplicates(clashing(docs(spark, texts)), 5, 8, 0.8).collect()}
    assert got == brute(texts)
    # Fingerprints alone drop some of these and keep some of the others.
    by_bits = {k for k, c in brute_components(list(range(len(texts))), [brute_fingerprint(t, 5) for t in texts], 8).items() if k == c}
    assert by_bits - got and got - by_bits


@pytest.mark.parametrize("radius", [1, 12])
def test_the_radius_does_not_decide(spark, radius):
    texts = sample()[:60]
    assert {r.doc_id for r in without_near_duplicates(docs(spark, texts), 5, radius, 0.8).collect()} == brute(texts)


def test_null_and_repeated_ids(spark):
    text, near = " ".join(f"w{k}" for k in range(100)), " ".join(f"w{k}" for k in range(99))
    rows = [(None, text), (7, near), (7, text), (None, "other words"), (3, "more of them"), (3, "yet another text"), (None, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = sorted((str(r.doc_id), str(r.text)) for r in without_near_duplicates(df, 5, 3, 0.8).collect())
    kept_seven = [r for r in got if r[0] == "7"]
    assert len(kept_seven) == 1 and kept_seven[0][1] in (text, near)
    assert [r for r in got if r[0] != "7"] == [("3", "more of them"), ("3", "yet another text"), ("None", "None"), ("None", "other words")]
    assert without_near_duplicates(docs(spark, []), 5, 3, 0.8).collect() == []


def test_columns_of_any_name_stay_as_they_are(spark):
    df = docs(spark, ["a b c d e f", "a b c d e f", "g h i j k l"]).withColumns(
        {n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in ("_row", "t1", "T2", "comp", "comp_", "rank", "c1", "fp", "prefix", "_id")}
    )
    got = without_near_duplicates(df, 5, 3, 0.8)
    assert got.columns == df.columns
    assert sorted((r.doc_id, r._row, r.t1, r.T2, r.comp, r.rank) for r in got.collect()) == [
        (0, "_row0", "t10", "T20", "comp0", "rank0"), (2, "_row2", "t12", "T22", "comp2", "rank2")
    ]


def test_many_copies_of_one_set_and_of_one_row(spark):
    text = " ".join(f"w{k}" for k in range(60))
    texts = [text] * 300 + [text + f" end{k % 3}" for k in range(90)] + ["apart from all that", None, " "]
    df = docs(spark, texts)
    twice = df.union(df).repartition(4)
    assert sorted(r.doc_id for r in without_near_duplicates(twice, 5, 3, 0.8).collect()) == sorted(brute(texts))


def test_a_dense_group_without_links_gives_few_pairs(spark, monkeypatch):
    rng, made, candidates = random.Random(6), [], near_dedup._candidates

    def counted(*args):
        made.append(candidates(*args))
        return made[-1]

    monkeypatch.setattr(near_dedup, "_candidates", counted)
    monkeypatch.setattr(near_dedup.Scratch, "clear", lambda self: None)
    base = [f"g{k}" for k in range(150)]
    texts = [edited(rng, base, rng.choice([1, 2, 3, 3, 3, 3])) for _ in range(200)]
    assert {r.doc_id for r in without_near_duplicates(docs(spark, texts), 5, 3, 0.8).collect()} == brute(texts)
    assert sum(m.count() for m in made) < 10 * len(texts)


@pytest.mark.parametrize("size", [1, 90, 3000])
def test_parities_differ_in_no_more_than_sets(size):
    rng = random.Random(size)
    for edits in (0, 1, size // 9, size):
        a = near_dedup.shingle_set(" ".join(f"w{rng.randrange(10**9)}" for _ in range(size)), 1)
        b = near_dedup.shingle_set(" ".join(f"v{rng.randrange(10**9)}" for _ in range(edits)), 1)
        c = near_dedup.np.union1d(a[edits // 2 :], b)
        bits = sum(int(x ^ y).bit_count() for x, y in zip(near_dedup.parities(a).view("<u8"), near_dedup.parities(c).view("<u8"), strict=True))
        assert bits <= len(near_dedup.np.setxor1d(a, c)) and (edits == 0) == (bits == 0)


def test_tables_on_the_way_are_removed(spark):
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    without_near_duplicates(docs(spark, sample()[:40]), 5, 3, 0.8).collect()
    left = {p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p.name not in before}
    assert not left & {"signatures", "often", "shared", "sets", "near", "tagged"}


def test_stage_of_the_pipeline_on_the_given_table(spark):
    documents = table(spark, str(DATA), "documents")
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    got = {r.doc_id for r in corpus_pipeline.near(spark, documents, str(DATA)).collect()}
    assert got == {rows[k][0] for k in brute([t for _, t in rows])}
