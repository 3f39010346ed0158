"""Removal of every byte in a repeated string of ``LENGTH`` bytes, by a difference-cover suffix sort of what can repeat.

1. A string that repeats has the same least hash of its ``ANCHOR``-byte parts wherever it stands. The starts of a text are cut into
   stretches of one such anchor; a stretch whose anchor no other has cannot repeat, and equal stretches are one, with a number of copies.
2. Stretches that share an anchor without being equal are dealt over the tasks by their anchor and sorted by suffix: names of the
   triples at two of three places (the difference cover) are sorted, the string of names is treated the same way until names cover
   ``LENGTH`` bytes, and the other suffixes are merged in by the ranks found. Neighbours are compared over ``LENGTH`` bytes.
3. An anchor whose stretches are too many for one task has the strings themselves counted by digest instead, over all tasks.
4. The starts found are carried back to every copy, and their bytes are cut out of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import ids_and_texts, with_ids, written

#: Bytes of a string that counts as repeated, and the share of it that an anchor has.
LENGTH, ANCHOR_SHARE = 200, 0.32
#: Bytes of text that are hashed at once; longer texts are taken in parts that overlap.
PART = 1 << 20
#: Starts of a stretch at most, bytes that are sorted at once, and bytes of one anchor beyond which strings are counted by digest.
MOST_STARTS, SORTED_AT_ONCE, MOST_OF_ANCHOR = 4096, 1 << 20, 2_000_000
#: Symbols of a string of names of which three fit into 63 bits.
MOST_SYMBOLS = 2_000_000

MULTIPLIER = 0x9E3779B97F4A7C15
MIX = np.uint64(0xBF58476D1CE4E5B9)


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.full(n, base & (1 << 64) - 1, np.uint64))


def least_hashes(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(least, own): of each string of ``length`` bytes the least hash of its parts, and the hash of its first part."""
    width = max(1, round(length * ANCHOR_SHARE))
    n = len(data)
    symbols = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(symbols * _powers(MULTIPLIER, n))])
    hashes = (sums[width:] - sums[:-width]) * _powers(pow(MULTIPLIER, -1, 1 << 64), n - width + 1)
    hashes = (hashes ^ (hashes >> np.uint64(29))) * MIX
    hashes ^= hashes >> np.uint64(32)
    least, size, window = hashes, 1, length - width + 1
    while 2 * size <= window:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    if size < window:
        least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
    return least, hashes[: len(least)]


def stretches(data: bytes, sizes: list[int], length: int) -> tuple[np.ndarray, ...]:
    """(anchor, first, last, folded) of each stretch of starts in texts of ``sizes`` bytes that stand one after the other in ``data``.

    A stretch is ``folded`` if its anchor stands in it more than once, so that it may hold one string twice.
    """
    least, own = least_hashes(data, length)
    ends = np.cumsum(sizes)
    change = np.zeros(len(data) + 1, np.int64)
    for end, size in zip(ends, sizes, strict=True):
        if size >= length:
            change[end - size] += 1
            change[end - length + 1] -= 1
    inside = np.cumsum(change)[: len(least)] > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
    new[[e - n for e, n in zip(ends, sizes, strict=True) if n >= length]] = True
    first = np.flatnonzero(new)
    stop = inside & np.append(new[1:] | ~inside[1:], True)
    last = np.flatnonzero(stop)
    long = last - first >= MOST_STARTS
    if long.any():
        more = [np.arange(a, z + 1, MOST_STARTS) for a, z in zip(first[long], last[long], strict=True)]
        tails = [np.minimum(m + MOST_STARTS - 1, z) for m, z in zip(more, last[long], strict=True)]
        first, last = np.concatenate([first[~long], *more]), np.concatenate([last[~long], *tails])
        order = np.argsort(first)
        first, last = first[order], last[order]
    again = np.concatenate([[0], np.cumsum(own == least)])
    return least[first].view(np.int64), first, last, again[last] > again[first]


def _keys():
    """Two numbers that tell rows apart by id and text; rows that repeat both have equal results."""
    return F.xxhash64("id", "text").alias("t1"), F.xxhash64(F.lit(1), F.col("text")).alias("t2")


def stretch_rows(rows: DataFrame, length: int) -> DataFrame:
    """(t1, t2, anchor, digest, at, starts, folded) of the stretches of ``rows`` (t1, t2, text)."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def found() -> pd.DataFrame:
            data, sizes = b"".join(p for *_, p in held), [len(p) for *_, p in held]
            anchor, first, last, folded = stretches(data, sizes, length)
            own = np.searchsorted(np.cumsum(sizes), first, side="right")
            begins = np.array([at for _, _, at, _ in held]) - (np.cumsum(sizes) - sizes)
            digests = [xxhash.xxh3_64_intdigest(data[a:z]) for a, z in zip(first.tolist(), (last + length).tolist(), strict=True)]
            keys = [np.array([p[k] for p in held], np.int64)[own] for k in (0, 1)]
            return pd.DataFrame(
                {
                    "t1": keys[0], "t2": keys[1], "anchor": anchor, "digest": np.array(digests, np.uint64).view(np.int64),
                    "at": (first + begins[own]).astype(np.int32), "starts": (last - first + 1).astype(np.int32), "folded": folded,
                }
            )

        for b in batches:
            for t1, t2, text in zip(b["t1"], b["t2"], b["text"], strict=True):
                data = (text or "").encode()
                for at in range(0, max(1, len(data) - length + 1), PART):
                    part = data[at : at + PART + length - 1]
                    if len(part) >= length:
                        held.append((t1, t2, at, part))
                        size += len(part)
                        if size >= PART:
                            yield found()
                            held, size = [], 0
        if held:
            yield found()

    return rows.select("t1", "t2", "text").mapInPandas(
        each, "t1 long, t2 long, anchor long, digest long, at int, starts int, folded boolean"
    )


def _names(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Names (1, 2 …) of the triples of ``s`` (padded) at the places ``at``, in the order of the triples."""
    size = int(s.max()) + 1
    a, b, c = s[at], s[at + 1], s[at + 2]
    if size <= MOST_SYMBOLS:
        keys = (a * size + b) * size + c
        order = np.argsort(keys)
        new = keys[order][1:] != keys[order][:-1]
    else:
        order = np.lexsort((c, b, a))
        new = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]) | (c[order][1:] != c[order][:-1])
    names = np.empty(len(at), np.int64)
    names[order] = 1 + np.concatenate([[0], np.cumsum(new)])
    return names


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``s`` (symbols from 1 on) in the order of their first ``depth`` symbols at least.

    Suffixes that are equal so far come in any order.
    """
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda k: s[k:].tolist()), np.int64)
    s = np.concatenate([s, np.zeros(3, np.int64)])
    # The difference cover {1, 2} modulo 3; where n is 1 modulo 3 the empty suffix ends the first half.
    cover = np.concatenate([np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)])
    names = _names(s, cover)
    if depth <= 3 or names.max() == len(names):
        order = np.argsort(names)
    else:
        order = suffix_order(names, -(-depth // 3))
    rank = np.zeros(n + 3, np.int64)
    rank[cover[order]] = np.arange(1, len(cover) + 1)
    sampled = cover[order]
    sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    many = len(cover) + 1
    rest = rest[np.argsort(s[rest] * many + rank[rest + 1])]
    size = int(s.max()) + 1

    def one(p: np.ndarray) -> np.ndarray:
        return s[p] * many + rank[p + 1]

    def two(p: np.ndarray) -> np.ndarray:
        return (s[p] * size + s[p + 1]) * many + rank[p + 2]

    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(one(first), one(rest)) + np.searchsorted(two(second), two(rest))
    # Places in the merged order; equal beginnings may have left the counts out of order.
    places = np.arange(len(rest)) + np.maximum.accumulate(before)
    merged, own = np.empty(n, np.int64), np.zeros(n, bool)
    own[places] = True
    merged[places], merged[~own] = rest, sampled
    return merged


def repeated_starts(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of ``texts``, which of its strings of ``length`` bytes stand at another place too, in it or another."""
    data = np.concatenate([np.frombuffer(t + b"\0", np.uint8) for t in texts])
    sizes = np.array([len(t) for t in texts])
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols = data.astype(np.int64) + 2
    symbols[begins + sizes] = 1
    starts = np.zeros(len(data), bool)
    for a, n in zip(begins, sizes, strict=True):
        starts[a : a + max(0, n - length + 1)] = True
    order = suffix_order(symbols, length)
    order = order[starts[order]]
    chunk = min(8, length)
    words = np.lib.stride_tricks.sliding_window_view(data, chunk)
    alike = np.arange(max(0, len(order) - 1))
    for k in {*range(0, length - chunk + 1, chunk), length - chunk}:
        one, two = words[order[alike] + k], words[order[alike + 1] + k]
        alike = alike[(one.view(np.uint64) == two.view(np.uint64)).ravel() if chunk == 8 else (one == two).all(axis=1)]
    found = np.zeros(len(data), bool)
    found[order[alike]] = found[order[alike + 1]] = True
    return [found[a : a + max(0, n - length + 1)] for a, n in zip(begins, sizes, strict=True)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(int(a), int(z) - 1) for a, z in edges.reshape(-1, 2)]


RUNS = "anchor long, digest long, runs array<struct<first:int,last:int>>"


def _sorted_runs(strings: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, runs) of ``strings`` (anchor, digest, copies, bytes), sorted by suffix for some anchors at once."""
    rows = strings.repartition("anchor").sortWithinPartitions("anchor", "digest")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, before = [], 0, None

        def found() -> pd.DataFrame:
            flags = repeated_starts([t for *_, t in held], length)
            out = [(a, d, runs(f)) for (a, d, copies, _), f in zip(held, flags, strict=True) if copies == 1 and f.any()]
            return pd.DataFrame(out, columns=["anchor", "digest", "runs"])

        for b in batches:
            for a, d, copies, t in zip(b["anchor"], b["digest"], b["copies"], b["bytes"], strict=True):
                if size >= SORTED_AT_ONCE and a != before[0]:
                    yield found()
                    held, size = [], 0
                if (a, d) != before:  # a row that is there twice gives its strings twice
                    held.append((a, d, copies, t))
                    size += len(t)
                before = (a, d)
        if held:
            yield found()

    return rows.mapInPandas(each, RUNS)


def _counted_runs(strings: DataFrame, length: int) -> DataFrame:
    """The same of strings that are too many for one task, by a digest of 128 bits of each string of ``length`` bytes.

    All stretches are counted, but only those that stand once get runs: the others are repeated whole.
    """

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for a, d, copies, t in zip(b["anchor"], b["digest"], b["copies"], b["bytes"], strict=True):
                digests = [xxhash.xxh3_128_digest(t[k : k + length]) for k in range(len(t) - length + 1)]
                starts = np.arange(len(digests), dtype=np.int32)
                yield pd.DataFrame({"anchor": a, "digest": d, "copies": copies, "start": starts, "string": digests})

    single = strings.dropDuplicates(["anchor", "digest"]).mapInPandas(windows, "anchor long, digest long, copies long, start int, string binary")
    several = single.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    found = single.where("copies = 1").join(several, "string", "left_semi")
    # A stretch has MOST_STARTS starts at most; those that follow each other are one run.
    starts = found.groupBy("anchor", "digest").agg(F.sort_array(F.collect_list("start")).alias("starts"))
    first = F.filter("starts", lambda x, k: F.coalesce(F.get("starts", k - 1) != x - 1, F.lit(True)))
    last = F.filter("starts", lambda x, k: F.coalesce(F.get("starts", k + 1) != x + 1, F.lit(True)))
    return starts.select("anchor", "digest", F.zip_with(first, last, lambda a, z: F.struct(a.alias("first"), z.alias("last"))).alias("runs"))


def _texts_of(reps: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, copies, bytes) of the stretches ``reps`` (t1, t2, anchor, digest, copies, at, starts)."""
    lists = reps.groupBy("t1", "t2").agg(F.collect_list(F.struct("anchor", "digest", "copies", "at", "starts")).alias("reps"))

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for text, reps in zip(b["text"], b["reps"], strict=True):
                data = text.encode()
                out = [(r["anchor"], r["digest"], r["copies"], data[r["at"] : r["at"] + r["starts"] + length - 1]) for r in reps]
                yield pd.DataFrame(out, columns=["anchor", "digest", "copies", "bytes"])

    # All columns of the rows go on, so that this exchange of texts is the one that the cutting reads too.
    return rows.join(lists, ["t1", "t2"]).mapInPandas(each, "anchor long, digest long, copies long, bytes binary")


def repeated_spans(rows: DataFrame, length: int, most_of_anchor: int | None = None) -> DataFrame:
    """(t1, t2, spans): the bytes [first, end) of each text that repeated strings cover; spans may overlap."""
    found = stretch_rows(rows, length)
    met = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("folded").alias("any")).where("n > 1 OR any")
    meeting = written(found.join(met, "anchor", "left_semi"), "meeting")

    place = F.struct("t1", "t2", "at", "starts")
    classes = written(
        meeting.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("copies"), F.min(place).alias("first"), F.max("folded").alias("folded")),
        "classes",
    )
    whole = classes.where("copies > 1").select(
        "anchor", "digest", F.array(F.struct(F.lit(0).alias("first"), (F.col("first.starts") - 1).alias("last"))).alias("runs")
    )
    # Only anchors of several stretches (or of one that folds) of which one is single have something to be sorted.
    groups = classes.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("copies").alias("fewest"), F.max("folded").alias("any"), F.sum(F.col("first.starts") + length).alias("size")
    )
    open_ = groups.where("fewest = 1 AND (n > 1 OR any)").select("anchor", (F.col("size") > (most_of_anchor or MOST_OF_ANCHOR)).alias("hot"))
    reps = classes.join(open_, "anchor").select("first.*", "anchor", "digest", "copies", "hot")
    few, many = (_texts_of(reps.where(c), rows, length) for c in ("NOT hot", "hot"))
    flagged = whole.union(_sorted_runs(few, length)).union(_counted_runs(many, length))
    spans = meeting.join(flagged, ["anchor", "digest"]).select("t1", "t2", "at", F.explode("runs").alias("r"))
    span = F.struct((F.col("at") + F.col("r.first")).alias("first"), (F.col("at") + F.col("r.last") + length).alias("end"))
    return spans.groupBy("t1", "t2").agg(F.collect_list(span).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that ``spans`` cover; spans that touch are one run."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", most_of_anchor: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, spans, kept) of every row of ``docs``: the runs removed and the bytes that stay.

    Texts are UTF-8; null and empty ones have no bytes. Matches stay within a text and may overlap. All copies go, the first one
    too. Repeated rows are copies of each other; null ids are kept; other columns do not count; an empty table gives no rows.
    """
    shown = ids_and_texts(docs, id_col, text_col)
    rows = shown.select("id", F.coalesce("text", F.lit("")).alias("text")).select("id", "text", *_keys())
    spans = repeated_spans(rows, length, most_of_anchor)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for own, text, spans in zip(b["id"], b["text"], b["spans"], strict=True):
                data = text.encode()
                cut = merged([(s["first"], s["end"]) for s in spans] if spans is not None else [])
                begins = [0, *(z for _, z in cut)]
                kept = b"".join(data[a:z] for a, z in zip(begins, [*(a for a, _ in cut), len(data)], strict=True))
                out.append((own, len(data), sum(z - a for a, z in cut), len(cut), [{"first": a, "end": z} for a, z in cut], kept))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    kind = "id string, n_bytes long, n_removed long, n_spans long, spans array<struct<first:int,end:int>>, kept binary"
    return with_ids(rows.join(spans, ["t1", "t2"], "left").mapInPandas(each, kind), docs, id_col, id_col)


def digest_of_kept(docs: DataFrame, **options) -> DataFrame:
    """The counts of ``without_repeats`` and the SHA-256 of the bytes that stay."""
    found = without_repeats(docs, **options)
    return found.select(*(c for c in found.columns if c not in ("spans", "kept")), F.sha2("kept", 256).alias("kept_sha256"))
