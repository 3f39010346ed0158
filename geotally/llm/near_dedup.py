"""Near-duplicates by the Jaccard similarity of shingle sets: SimHash makes the first candidates, every link is verified.

First, what cannot have a partner is set aside. Two sets of a similarity of ``least`` or more differ in no more than (1 - least) n of
either's n shingles, so a set with more shingles that no other set has is closed. To see that, the shingles in a fixed share of the
hash values are enough; they are counted in one exchange.

Open texts with equal sets are one class, and only classes are compared. What the fingerprints miss is found by prefixes: in any one
order of all shingles, two alike sets share one among the first n - ceil(least n) + 1 of each, and no earlier one of either; rare
shingles come first, so few sets share any. Links are looked for between components only, at first with one class of each shared
shingle, then with a few, so a dense group gives fewer of its pairs; those of classes that are still apart are all compared. Parities
of the counts of shingles by hash bound what two sets can share within the join, and the counts themselves after it, so that few
pairs leave it and whole sets are made and compared only where that is enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotally.llm import simhash
from geotally.llm.common import Scratch, unused
from geotally.llm.components import components

#: Share of the hash values whose shingles are counted to close sets. A set without partners has most of its shingles alone, and
#: must show more than 1 - least of them in this share; a smaller share leaves more sets open, and the result the same.
COUNTED_SHARE = 0.35
#: Documents from which the order of the shingles is estimated, and frequent shingles that it tells apart. Any order gives
#: the same result; a good one gives few candidates.
SAMPLE_DOCS, FREQUENT = 20_000, 200_000
#: Rounds in which the classes of a shared shingle are compared with so many of them: first with one, the same one for many
#: shingles, then with others for each shingle. The last comparison, of all that are still apart, makes the result whole.
LEADERS = [1, 8]
#: Parts of a set, by hash, whose sizes are kept.
PARTS_LOG = 7
#: Words of 64 bits in the parities of a set: one bit for each part, by hash, set if the part has an odd number of shingles.
ODD_WORDS = 4
ODD = [f"odd{k}" for k in range(ODD_WORDS)]
#: Documents that a task works on at once.
AT_ONCE = 500
#: Rounding of similarities.
SLACK = 1e-9
#: Keys of a row: two hashes of its text and one of its id. Rows that repeat both give their links twice, which changes nothing.
KEYS = ["t1", "t2", "t3"]


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The different shingles of ``words`` words as sorted 64-bit hashes; a shorter text is one shingle, a blank one none."""
    return np.unique(simhash.shingle_hashes(text, words)).view(np.int64)


def _some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield from (b.iloc[first : first + AT_ONCE] for first in range(0, len(b), AT_ONCE))


def closed(rows: DataFrame, words: int, least: float) -> DataFrame:
    """(t,) of those of ``rows`` (t, text) whose sets have too many shingles of their own to be like any other."""
    top = np.uint64(int(COUNTED_SHARE * (1 << 32)) << 32)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _some(batches):
            sets = [shingle_set(t, words) for t in b["text"]]
            chosen = [x[x.view(np.uint64) < top] for x in sets]
            sizes = [len(x) for x in chosen]
            yield pd.DataFrame(
                {
                    "t": np.repeat(b["t"].to_numpy(np.int64), sizes),
                    "n": np.repeat(np.array([len(x) for x in sets], np.int32), sizes),
                    "key": np.concatenate(chosen),
                }
            )

    keys = rows.mapInPandas(each, "t long, n int, key long")
    # Of a shingle that several sets have, any of them may be named: it does not count.
    alone = keys.groupBy("key").agg(F.count(F.lit(1)).alias("sets"), F.min("t").alias("t"), F.min("n").alias("n")).where("sets = 1")
    return alone.groupBy("t").agg(F.count(F.lit(1)).alias("alone"), F.max("n").alias("n")).where(
        F.col("alone") > (1 - least) * F.col("n") + SLACK
    ).select("t")


def frequent(rows: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of a sample of ``rows`` (t1, text) have, sorted, and their counts."""
    share = min(1.0, SAMPLE_DOCS / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.col("t1"), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1)).select("text")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _some(batches):
            yield pd.DataFrame({"key": np.concatenate([shingle_set(t, words) for t in b["text"]])})

    counts = drawn.mapInPandas(each, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    got = counts.where("n > 1").orderBy(F.desc("n"), "key").limit(FREQUENT).orderBy("key").toPandas()
    return got["key"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


def parities(x: np.ndarray) -> np.ndarray:
    """Parities of the parts of the set ``x`` by hash, as ``ODD_WORDS`` longs. Two sets differ in at least as many shingles as parities."""
    counts = np.bincount(x & (64 * ODD_WORDS - 1), minlength=64 * ODD_WORDS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.int64)


def signatures(rows: DataFrame, words: int, least: float) -> DataFrame:
    """(t1, t2, t3, c1, c2, fp, n, sizes, prefix, odd0, ...) of ``rows`` (t1, t2, t3, text).

    These are digest and size of the shingle set, fingerprint, sizes of the set's parts by hash, its first shingles, and parities.
    """
    sent = rows.sparkSession.sparkContext.broadcast(frequent(rows, words))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts = sent.value
        for b in _some(batches):
            out = []
            for t in b["text"]:
                hashes = simhash.shingle_hashes(t, words)
                x = np.unique(hashes).view(np.int64)
                digest = xxhash.xxh3_128_intdigest(x.tobytes())
                sizes = np.bincount((x.view(np.uint64) >> np.uint64(64 - PARTS_LOG)).astype(np.int64), minlength=1 << PARTS_LOG)
                if len(x) and len(keys):
                    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
                    x = x[np.lexsort((x, np.where(keys[at] == x, counts[at], 0)))]
                first = x[: len(x) - ceil(least * len(x) - SLACK) + 1]
                halves = [int(h) - (1 << 63) for h in (digest >> 64, digest & (1 << 64) - 1)]
                out.append((*halves, simhash.fingerprint_of(hashes), len(x), sizes.astype(np.int32), first, *parities(x)))
            found = pd.DataFrame(out, columns=["c1", "c2", "fp", "n", "sizes", "prefix", *ODD])
            yield pd.concat([b[["t1", "t2", "t3"]].reset_index(drop=True), found], axis=1)

    odd = "".join(f", {c} long" for c in ODD)
    return rows.mapInPandas(each, f"t1 long, t2 long, t3 long, c1 long, c2 long, fp long, n int, sizes array<int>, prefix array<long>{odd}")


def _both(pairs: DataFrame, of_class: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with the ``column`` of each class as ``s`` and ``t``."""
    one, two = (of_class.select(F.col("id").alias(end), F.col(column).alias(name)) for end, name in (("a", "s"), ("b", "t")))
    return pairs.join(one, "a").join(two, "b")


def _alike(shared, n, m, least: float):
    return shared >= least * (n + m - shared) - SLACK


def possible(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets could have the similarity, by the sizes of their parts: no part shares more than the smaller."""
    total = lambda sizes: F.aggregate(sizes, F.lit(0), lambda x, y: x + y)
    most = total(F.zip_with("s", "t", lambda x, y: F.least(x, y)))
    return _both(pairs, classes, "sizes").where(_alike(most, total(F.col("s")), total(F.col("t")), least)).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets have a Jaccard similarity of ``least`` or more; two empty sets are equal."""
    shared = F.size(F.array_intersect("s", "t"))
    return _both(pairs, sets, "shingles").where(_alike(shared, F.size("s"), F.size("t"), least)).select("a", "b")


def _candidates(one: DataFrame, two: DataFrame, least: float) -> DataFrame:
    """(a, b) of each two classes of different components that share a shingle so early that they can be alike.

    Where both sides have parities, pairs that differ in too many of them do not leave the join.
    """
    odd = [c for c in ODD if c in one.columns and c in two.columns]
    two = two.select("key", *(F.col(c).alias(f"{c}2") for c in ("id", "n", "pos", "comp", *odd)))
    need = least / (1 + least) * (F.col("n") + F.col("n2")) - SLACK
    fits = (F.col("n") - F.col("pos") >= need) & (F.col("n2") - F.col("pos2") >= need)
    if odd:
        differ = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}2"))) for c in odd), F.lit(0))
        fits = fits & (differ <= F.col("n") + F.col("n2") - 2 * need)
    sizes = F.least("n", "n2") >= least * F.greatest("n", "n2") - SLACK
    found = one.join(two, "key").where((F.col("comp") != F.col("comp2")) & fits & sizes)
    return found.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def class_components(rows: DataFrame, classes: DataFrame, marked: DataFrame, scratch: Scratch, words: int, radius: int, least: float) -> DataFrame:
    """(id, component_id) of each class that is linked to another.

    ``classes`` (id, t1, t2, t3, fp) name one text of each; ``marked`` (t1, t2, t3, n, sizes, prefix, odd0, ...) has the signatures of texts, ``rows``
    (t1, t2, t3, text) the texts. Two classes are linked if the Jaccard similarity of their sets is ``least`` or more, and
    components are all that links reach. ``radius`` decides only which links the fingerprints find.
    """
    named = simhash.fingerprint_components(classes.select("id", "fp"), radius).withColumnRenamed("fp", "class_fp")
    near = classes.join(named, classes.fp == named.class_fp).select(F.col("comp").alias("a"), F.col("id").alias("b")).where("a != b")
    own = classes.select("id", *KEYS).join(marked, KEYS)
    sizes = scratch.written(own.select("id", "sizes", *ODD), "sizes")
    early = own.select("id", "n", F.posexplode("prefix").alias("pos", "key"))
    often = scratch.written(early.groupBy("key").agg(F.count(F.lit(1)).alias("of_key")).where("of_key > 1").select("key"), "often")
    shared = scratch.written(early.join(often, "key", "left_semi"), "shared")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _some(batches):
            yield pd.DataFrame({"id": b["id"], "shingles": [shingle_set(t, words) for t in b["text"]]})

    tagged, known = shared.withColumn("comp", F.col("id")), None
    for k, leaders in enumerate([*LEADERS, None]):
        other = tagged
        if leaders:
            # A class with the shingle too late for another of its size would find few.
            late = F.col("pos") > (1 - least) / (1 + least) * F.col("n")
            drawn = F.xxhash64("id", F.col("key") if k else F.lit(0))
            # The rank is cut before the exchange, so a shingle of any number of classes gives few rows of each task.
            order = Window.partitionBy("key").orderBy(late, drawn, "id")
            other = tagged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= leaders).drop("rank")
        found = _candidates(tagged, other, least)
        pairs = scratch.written(possible(found if k else found.union(near).distinct(), sizes, least), "pairs")
        needed = classes.join(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "id", "left_semi")
        texts = rows.join(needed.select("id", *KEYS), KEYS).select("id", "text")
        sets = scratch.written(texts.mapInPandas(each, "id long, shingles array<long>"), "sets")
        links = scratch.written(verified(pairs, sets, least), "links")
        # The components so far stand for the links found so far: a round has only to bring in what is new.
        comps = components(links if known is None else known.union(links))
        known = comps.select(F.col("id").alias("a"), F.col("component_id").alias("b"))
        if leaders:
            moved = comps.withColumnRenamed("id", "_id")
            joined = shared.join(moved, F.col("id") == F.col("_id"), "left").join(sizes.select("id", *ODD).distinct(), "id")
            tagged = scratch.written(joined.select("key", "id", "n", "pos", F.coalesce("component_id", "id").alias("comp"), *ODD), "tagged")
    return comps


def without_near_duplicates(docs: DataFrame, words: int, radius: int, least: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id.

    A null id comes last; of rows with one id and text one stays. Blank and null texts are alike, and like no other. All columns
    are kept as they are, whatever their names; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    t1, t2, comp, rank = (unused(docs, name) for name in ("t1", "t2", "comp", "rank"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({t1: F.xxhash64(text), t2: F.xxhash64(F.lit(1), text)})
    # The third key tells rows of one text apart by id, so that one of many copies stands for them.
    whole = keyed.select(F.col(t1).alias("t1"), F.col(t2).alias("t2"), F.xxhash64(id_col).alias("t3"), text.alias("text"))
    whole = whole.withColumn("t", F.xxhash64(*KEYS))
    done = scratch.written(closed(whole.select("t", "text"), words, least), "closed")
    rows = whole.join(done, "t", "left_anti").select(*KEYS, "text")
    marked = scratch.written(signatures(rows, words, least), "signatures")
    one = F.min(F.struct(*KEYS, "fp")).alias("one")
    grouped = marked.groupBy("c1", "c2").agg(one, F.count(F.lit(1)).alias("n_rows"))
    classes = scratch.written(grouped.select(F.monotonically_increasing_id().alias("id"), "c1", "c2", "n_rows", "one.*"), "classes")
    comps = class_components(rows, classes, marked.select(*KEYS, "n", "sizes", "prefix", *ODD), scratch, words, radius, least)
    found = classes.join(comps.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left")
    many = found.where("component_id IS NOT NULL OR n_rows > 1").select("c1", "c2", F.coalesce("component_id", "id").alias("comp"))
    members = marked.select("t1", "t2", "c1", "c2").join(many, ["c1", "c2"]).select(
        F.col("t1").alias(t1), F.col("t2").alias(t2), F.col("comp").alias(comp)
    )
    members = Scratch(docs.sparkSession).written(members.distinct(), "members")
    scratch.clear()
    tagged = keyed.join(members, [t1, t2], "left")
    # The rank is cut to 1 before the exchange, so a component of any size gives one row of each task.
    order = Window.partitionBy(comp).orderBy(F.col(id_col).isNull(), id_col, t1, t2)
    first = tagged.where(F.col(comp).isNotNull()).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return tagged.where(F.col(comp).isNull()).select(docs.columns).union(first.select(docs.columns))
