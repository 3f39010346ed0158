"""Near-duplicates by SimHash fingerprints and the generalised pigeonhole principle.

Correlated bits of the fingerprint are grouped into partitions. If two fingerprints differ in at most ``radius`` bits
and the thresholds of m partitions add up to radius - m + 1, then in at least one partition they differ in no more bits than
its threshold. The number of partitions and the thresholds are those of the least estimated cost; each fingerprint is
filed under its value in every partition, probes the values within the threshold, and what is found is verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import ids_and_texts, with_ids, written
from geotally.llm.components import components

BITS = 64
SEED = 42
#: Cost of one row that is filed or probes, measured in verified candidates.
ROW_COST = 50.0
#: The radius grows in steps of so many bits; each search is between the components of the one before.
RADIUS_STEP = 3


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """Hashes of the shingles of ``words`` words in their order, repeats included; a shorter text is one shingle, a blank one none."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    n = max(1, len(parts) - words + 1)
    froms, tos = (ends - sizes)[:n].tolist(), ends[min(words, len(parts)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(froms, tos, strict=True)], np.uint64)


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of the shingles of ``words`` words, repeats included; 0 for a text without words."""
    return fingerprint_of(shingle_hashes(text, words))


def fingerprint_of(hashes: np.ndarray) -> int:
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 255):  # sums of up to 255 bits fit one byte
        bits = np.unpackbits(hashes[at : at + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of each whole text, as a signed long."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "fp": np.fromiter((fingerprint(t, words) for t in b["text"]), np.int64, len(b))})

    found = ids_and_texts(docs, id_col, text_col).mapInPandas(each, "id string, fp long")
    return with_ids(found, docs, id_col)


def bit_pairs(fps: DataFrame) -> np.ndarray:
    """How many fingerprints have both of two bits set, for every two bits; 64 x 64 numbers whatever the input."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((BITS, BITS), np.int64)
        for b in batches:
            raw = np.ascontiguousarray(b["fp"].to_numpy(np.int64)).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total += (bits.T @ bits).astype(np.int64)
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "n": total.ravel()})

    out = np.zeros((BITS, BITS), np.int64)
    for r in fps.select("fp").mapInPandas(each, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[r.i, r.j] = r.n
    return out


def grouped_bits(share: np.ndarray, parts: int) -> list[list[int]]:
    """The bits in ``parts`` groups of nearly equal size, each grown by the bit most correlated with it so far."""
    p = np.diag(share)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(share - np.outer(p, p)) / np.outer(spread, spread)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        group = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (corr[b, group].max(), -b)))
            left.remove(group[-1])
        groups.append(group)
    return groups


def near_share(share: np.ndarray, bits: list[int], most: int) -> np.ndarray:
    """Estimated share of pairs that differ in at most 0, 1, ..., ``most`` of the bits.

    The bits form a chain: whether two fingerprints differ in a bit depends on whether they differ in the one before.
    """
    p = np.diag(share)
    differ = 2 * p * (1 - p)
    dist = np.zeros((2, most + 2))  # by whether the last bit differs, and how many do; the last column is "more"
    dist[0, 0], dist[1, 1] = 1 - differ[bits[0]], differ[bits[0]]
    for a, b in zip(bits, bits[1:], strict=False):
        p11 = share[a, b]
        p10, p01 = p[a] - p11, p[b] - p11
        both = 2 * (p11 * (1 - p11 - p10 - p01) + p10 * p01)
        then = np.clip([(differ[b] - both) / max(1 - differ[a], 1e-9), both / max(differ[a], 1e-9)], 0, 1)
        yes, no = then @ dist, (1 - then) @ dist
        dist[0] = no
        dist[1, 1:] = yes[:-1]
        dist[1, 0] = 0
        dist[1, -1] += yes[-1]
    return np.cumsum(dist.sum(0)[: most + 1])


def ball(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1))


def chosen_partitions(n: int, pairs: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition in use. Dynamic programming over what the thresholds add up to."""
    n = max(1, n)
    share = pairs / n
    best: tuple[float, list[tuple[list[int], int]]] = (np.inf, [])
    for parts in range(1, radius + 2):
        groups = grouped_bits(share, parts)
        total = radius - parts + 1
        # A threshold of -1 leaves the partition out; sums are shifted by one a partition.
        table = {0: (0.0, [])}
        for group in groups:
            near = near_share(share, group, min(total + parts - 1, 3))
            cost = {-1: 0.0} | {t: n * ROW_COST * (1 + ball(len(group), t)) + n * n / 2 * near[t] for t in range(len(near))}
            table = {
                s: min(
                    ((c + cost[t], [*ts, (group, t)]) for t in cost for c, ts in [table.get(s - t - 1, (np.inf, []))]),
                    key=lambda x: x[0],
                )
                for s in range(total + parts + 1)
            }
        found = table[total + parts]
        if found[0] < best[0]:
            best = found
    return [(bits, t) for bits, t in best[1] if t >= 0]


def _long(value: int) -> Column:
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def _keys(partitions: list[tuple[list[int], int]], probe: bool) -> Column:
    """Array of (part, key): the value of each partition, and for probes every value within its threshold."""

    def of_part(k: int, bits: list[int], threshold: int) -> Column:
        value = F.col("fp").bitwiseAND(_long(sum(1 << b for b in bits)))
        flips = [sum(1 << b for b in c) for r in range(threshold + 1 if probe else 1) for c in combinations(bits, r)]
        return F.transform(F.array(*map(_long, flips)), lambda f: F.struct(F.lit(k).alias("part"), value.bitwiseXOR(f).alias("key")))

    return F.flatten(F.array(*(of_part(k, bits, t) for k, (bits, t) in enumerate(partitions))))


def linked(classes: DataFrame, partitions: list[tuple[list[int], int]], radius: int) -> DataFrame:
    """(a, b) of each two ``comp`` that two rows of ``classes`` (fp, comp) link by differing in at most ``radius`` bits.

    Candidates are verified inside the join, and only in the first partition where they meet, so a link leaves it
    once; hot keys are split by the skew join.
    """
    filed = classes.select("fp", "comp", F.explode(_keys(partitions, False)).alias("k")).select("k.*", "fp", "comp")
    probes = classes.select(F.col("fp").alias("fp2"), F.col("comp").alias("comp2"), F.explode(_keys(partitions, True)).alias("k"))
    probes = probes.select("k.*", "fp2", "comp2")
    differ = F.col("fp").bitwiseXOR(F.col("fp2"))
    near = (F.col("fp") < F.col("fp2")) & (F.bit_count(differ) <= radius) & (F.col("comp") != F.col("comp2"))
    for k, (bits, threshold) in enumerate(partitions):
        met = F.bit_count(differ.bitwiseAND(_long(sum(1 << b for b in bits)))) <= threshold
        near = near & ((filed.part <= k) | ~met)
    joined = filed.join(probes, (filed.part == probes.part) & (filed.key == probes.key) & near)
    return joined.select(F.col("comp").alias("a"), F.col("comp2").alias("b"))


def fingerprint_components(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, comp): each fingerprint of ``marked`` (id, fp) once, with the smallest id that it reaches."""
    classes = written(marked.groupBy("fp").agg(F.min("id").alias("comp")), "classes")
    n, pairs = classes.count(), bit_pairs(classes)
    for step in [*range(RADIUS_STEP, radius, RADIUS_STEP), radius]:
        found = components(linked(classes, chosen_partitions(n, pairs, step), step))
        joined = classes.join(found, classes.comp == found.id, "left")
        classes = written(joined.select("fp", F.coalesce("component_id", "comp").alias("comp")), "classes")
    return classes


def near_duplicates(docs: DataFrame, words: int = 5, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest id that can be reached over fingerprints differing in at most ``radius`` bits, the
    own id included. Null and blank texts have fingerprint 0 and are linked like any other. Copies of a fingerprint
    stand for one row in the search. Components of close fingerprints are found first; further links are then
    looked for between components only, so a dense group does not give all of its pairs. A row without an id takes
    the component of its fingerprint.
    """
    marked = written(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = fingerprint_components(marked, radius)
    named = classes.select(F.col("fp").alias("class_fp"), F.col("comp").alias("component_id"))
    return marked.join(named, marked.fp == named.class_fp).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
