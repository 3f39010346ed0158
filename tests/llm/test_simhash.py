import numpy as np
import pytest
import xxhash

from geotally.llm import simhash
from geotally.llm.components import components
from tests.llm.helpers import ODD_TEXTS, clashing, docs


def brute_fingerprint(text, k=3):
    w = [x for x in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if x]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius):
    label = dict(zip(ids, ids, strict=True))
    changed = True
    while changed:
        changed = False
        for a, fa in zip(ids, fps, strict=True):
            for b, fb in zip(ids, fps, strict=True):
                if (fa ^ fb).bit_count() <= radius and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text, 3) & (1 << 64) - 1 == brute_fingerprint(text)


def test_near_duplicates_equal_brute_force(spark):
    base = [f"w{k % 97} v{k % 31} u{k}" for k in range(120)]
    texts = [*ODD_TEXTS, *(" ".join(base[:k]) for k in range(60, 120)), *("left " * k for k in range(5))]
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in simhash.near_duplicates(clashing(docs(spark, texts)), 3, 3).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    want = brute_components(list(range(len(texts))), fps, 3)
    assert got == {k: (fps[k], want[k]) for k in range(len(texts))}
    assert len(set(want.values())) < len(texts)
    wide = brute_components(list(range(len(texts))), fps, 6)
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, texts), 3, 6).collect()} == wide


@pytest.mark.parametrize("radius", [1, 3, 6])
def test_no_link_is_lost(spark, radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 2**63, 40)
    values = {int(c) for c in centres}
    for c in centres:  # neighbours at every distance up to just beyond the radius
        for distance in range(1, radius + 2):
            bits = rng.choice(64, distance, replace=False)
            values.add(int(c) ^ sum(1 << int(b) for b in bits))
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    fps = spark.createDataFrame([(v, k) for k, v in enumerate(signed)], "fp long, comp long")
    plan = simhash.chosen_partitions(len(signed), simhash.bit_pairs(fps), radius)
    assert sorted(b for bits, _ in plan for b in bits) == sorted({b for bits, _ in plan for b in bits})
    found = [frozenset(r) for r in simhash.linked(fps, plan, radius).collect()]
    got = set(found)
    assert len(found) == len(got)  # each once, however many partitions the two meet in
    want = {frozenset((i, j)) for i, a in enumerate(signed) for j, b in enumerate(signed) if i < j and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
    assert got == want


@pytest.mark.parametrize("n", [1, 10**4, 10**7, 10**10])
@pytest.mark.parametrize("radius", [1, 3, 6])
def test_thresholds_add_up(n, radius):
    rng = np.random.default_rng(0)
    bits = rng.random((500, 64)) < rng.uniform(0.2, 0.8, 64)
    pairs = bits.T.astype(int) @ bits.astype(int)
    groups = simhash.grouped_bits(pairs / 500, radius + 1)
    assert sorted(sum(groups, [])) == list(range(64))
    plan = simhash.chosen_partitions(500, pairs, radius)
    assert sum(t + 1 for _, t in plan) == radius + 1  # so some partition has no more differences than its threshold


def test_estimate_of_near_pairs():
    rng = np.random.default_rng(1)
    bits = rng.random((4000, 64)) < rng.uniform(0.3, 0.7, 64)
    bits[:, 1] = bits[:, 0] ^ (rng.random(4000) < 0.1)  # two correlated bits
    pairs = bits.T.astype(int) @ bits.astype(int)
    group = [0, 1, 2, 3, 4, 5]
    estimate = simhash.near_share(pairs / 4000, group, 2)
    a, b = bits[:2000][:, group], bits[2000:][:, group]
    differ = (a[:, None] != b[None]).sum(2)
    for t in range(3):
        assert abs((differ <= t).mean() - estimate[t]) < 0.02


def test_empty_table_and_null_ids(spark):
    assert simhash.near_duplicates(docs(spark, []), 3, 3).collect() == []
    big = (1 << 62) + 1  # a null beside it must not turn it into a fraction
    found = simhash.near_duplicates(spark.createDataFrame([(None, "x"), (big, "y")], "doc_id long, text string"), 3, 0)
    assert {r.doc_id for r in found.collect()} == {None, big}
    df = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (None, "z")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(df, 3, 0).collect()) == [("4", "4"), ("None", "4"), ("None", "None")]


def test_components_of_path_star_and_ring(spark):
    path = [(k, k + 1) for k in range(0, 40)]
    star = [(100, 100 + k) for k in range(1, 300)]
    ring = [(500 + k, 500 + (k + 1) % 17) for k in range(17)]
    links = spark.createDataFrame([*path, *star, *ring, (7, 7), (None, 3)], "a long, b long")
    got = dict(components(links).collect())
    assert got == {k: 0 for k in range(41)} | {100 + k: 100 for k in range(300)} | {500 + k: 500 for k in range(17)}


def test_rounds_of_components_broadcast_nothing(spark):
    from geotally.llm import components as stars

    links = spark.createDataFrame([(k, k // 3) for k in range(1, 60)], "u long, v long")
    found = stars._small_star(stars._large_star(links))
    assert found.count() > 0
    rows = found.collect()
    final = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert rows and "SortMergeJoin" in final and "Broadcast" not in final
    whole = stars.components(links.withColumnsRenamed({"u": "a", "v": "b"}))
    assert {(r.id, r.component_id) for r in whole.collect()} == {(k, 0) for k in range(60)}
