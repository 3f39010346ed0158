"""Benchmark decontamination by Wu-Manber search.

The windows of the benchmark are the patterns. A table of block shifts says how far a scan may jump, patterns that end
in the block that was met share a bucket, and a comparison of bytes confirms each occurrence. A batch of documents is
scanned by many cursors at once, each over its own stretch of the bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import ids_and_texts, unused, with_ids

#: Words of a window.
WINDOW = 10
#: Bytes of benchmark text whose patterns are held by a task at once; more text is searched for in several passes.
BLOCK_BYTES = 8_000_000
#: Bytes of documents that are scanned together, and bytes of a cursor's stretch.
SCAN_BYTES, STRETCH = 4_000_000, 1024
TABLE_BITS = 20
#: Patterns at least so long have tables of their own, as the shortest pattern bounds the jumps.
CLASSES = (0, 8, 20, 32, 64)

#: Words are runs of digits, letters a to z and bytes of characters beyond ASCII; A to Z are lower-cased.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


def windows(text: str | None) -> set[bytes]:
    """The different windows of an item, each with a blank before and after it."""
    w = words(text)
    size = min(WINDOW, len(w))
    return {b" %b " % b" ".join(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


class WuManber:
    """Search for patterns whose lengths fall in one class."""

    def __init__(self, patterns: Iterable[bytes]):
        found = sorted(patterns)
        self.least = min(map(len, found))
        self.block = min(8, self.least)
        firsts = np.array([np.frombuffer(p, np.uint8, self.least) for p in found])
        default = self.least - self.block + 1
        self.shift = np.full(1 << TABLE_BITS, default, np.int32)
        for end in range(self.block, self.least + 1):
            at = self._slot(self._value(firsts[:, end - self.block : end]))
            self.shift[at] = np.minimum(self.shift[at], self.least - end)
        self.buckets: dict[int, list[bytes]] = defaultdict(list)
        for p, v in zip(found, self._value(firsts[:, self.least - self.block :]).tolist(), strict=True):
            self.buckets[v].append(p)

    def _value(self, blocks: np.ndarray) -> np.ndarray:
        wide = np.zeros((len(blocks), 8), np.uint8)
        wide[:, : self.block] = blocks
        return wide.view("<u8").ravel()

    @staticmethod
    def _slot(values: np.ndarray) -> np.ndarray:
        return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def occurrences(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        """(start, pattern) of every occurrence in ``data``."""
        text = np.frombuffer(data, np.uint8)
        at = np.arange(self.least - 1, len(text), STRETCH)  # where a block ends
        stop = np.minimum(at + STRETCH, len(text))
        reach = np.arange(1 - self.block, 1)
        met = []
        while len(at):
            value = self._value(text[at[:, None] + reach])
            jump = self.shift[self._slot(value)]
            here = jump == 0
            if here.any():
                met.append((at[here], value[here]))
            at = at + np.maximum(jump, 1)
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]
        for ends, values in met:
            for end, value in zip(ends.tolist(), values.tolist(), strict=True):
                start = end - self.least + 1
                for p in self.buckets.get(value, ()):
                    if data.startswith(p, start):
                        yield start, p


class Matcher:
    """The windows of some items; finds them in batches of texts."""

    def __init__(self, items: Iterable[tuple[str, str | None]]):
        self.items: dict[bytes, list[str]] = defaultdict(list)
        for item_id, text in items:
            for w in windows(text):
                self.items[w].append(item_id)
        by_class = defaultdict(list)
        for p in self.items:
            by_class[sum(len(p) >= c for c in CLASSES)].append(p)
        self.searches = [WuManber(ps) for ps in by_class.values()]

    def scan(self, texts: Iterable[str | None]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: its number of words, (from, to) of the words that windows cover, and the items met."""
        lines, size = [], 0
        for t in texts:
            lines.append(b" %b " % b" ".join(words(t)))
            size += len(lines[-1]) + 1
            if size > SCAN_BYTES:
                yield from self._scan(lines)
                lines, size = [], 0
        yield from self._scan(lines)

    def _scan(self, lines: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        if not lines:
            return
        data = b"\n".join(lines)
        starts = np.cumsum([0] + [len(x) + 1 for x in lines[:-1]])
        hits = defaultdict(list)
        for search in self.searches:
            for start, p in search.occurrences(data):
                hits[int(np.searchsorted(starts, start, "right")) - 1].append((start, p))
        for k, line in enumerate(lines):
            spans, items = [], set()
            if k in hits:
                blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
                for start, p in sorted(hits[k]):
                    first = int(np.searchsorted(blanks, start - starts[k]))
                    last = first + p.count(b" ") - 1
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(last, spans[-1][1])
                    else:
                        spans.append([first, last])
                    items.update(self.items[p])
            yield (line.count(b" ") - 1 if len(line) > 2 else 0), spans, sorted(items)


def _scanned(docs: DataFrame, items: list[tuple[str, str | None]], id_col: str, text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_BYTES and one item

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(sent.value)
        for b in batches:
            found = list(matcher.scan(b["text"]))
            yield pd.DataFrame(
                {
                    "id": b["id"],
                    "text_key": [xxhash.xxh64_intdigest(t or "") >> 1 for t in b["text"]],
                    "n_words": [n for n, _, _ in found],
                    "spans": [[{"from": a, "to": z} for a, z in spans] for _, spans, _ in found],
                    "items": [items for _, _, items in found],
                }
            )

    found = ids_and_texts(docs, id_col, text_col).mapInPandas(
        each, "id string, text_key long, n_words long, spans array<struct<from: long, to: long>>, items array<string>"
    )
    return with_ids(found, docs, id_col)


def _merged(passes: DataFrame, blocks: int) -> DataFrame:
    """What the passes found of each row; equal rows are found equally often in each pass, and stay as many."""
    grouped = passes.groupBy("id", "text_key", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.count(F.lit(1)).alias("rows"),
    )
    return grouped.withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("rows") / blocks).cast("int"))))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items), one row per row of ``docs``.

    A window is ten consecutive words of an item, or all words of a shorter one. A document word inside any occurrence is
    hit; spans are the runs of hit words. Null and wordless texts have no words and are clean; items without words
    are never met; a null item id counts as an empty one. A benchmark of any size is searched for in blocks of
    ``block_bytes``, each against all documents.
    """
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text")
    ).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / block_bytes))
    passes = []
    for k in range(blocks):
        held = [(r.item, r.text) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()]
        passes.append(_scanned(docs, held, id_col, text_col))
    found = passes[0] if blocks == 1 else _merged(reduce(DataFrame.union, passes), blocks)
    covered = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(F.lit(0).cast("long"), x["to"] - F.greatest(s["end"], x["from"]))).alias("n"),
            F.greatest(s["end"], x["to"]).alias("end"),
        ),
    )["n"]
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"),
        "spans",
        "items",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any window of the benchmark, with all their columns.

    What is found depends on the text alone, so rows are dropped by their text: null ids and ids of several texts do no harm.
    """
    key = unused(docs, "key")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumn(key, F.concat_ws(":", F.xxhash64(text), F.xxhash64(F.lit(1), text)))
    found = contamination(keyed.select(F.col(key).alias("key"), F.col(text_col).alias("text")), benchmark, id_col="key", **options)
    dropped = found.where("contaminated").select(F.col("key").alias(key)).distinct()
    return keyed.join(dropped, key, "left_anti").select(docs.columns)
