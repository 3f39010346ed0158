"""Phrase collocations by SETM relational mining.

An occurrence relation R_k holds the place and the name of every frequent phrase of k words, nested by document and sorted by place;
places of one piece follow each other, and the next piece begins after a gap. R_k is written to the shared folder. Merge-joined with
itself at the next place of the piece it gives the candidates of k + 1 words, which are counted in groups; R_k+1 is the semi-join of
the candidates with the groups that are frequent, and so on. A candidate's name is the pair of the names of its first and last k
words, so a phrase is never spelled out in a relation.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geotally.llm.common import written

#: Occurrences of a phrase at least, and words of a phrase at most.
LEAST, LONGEST = 100, 5
#: Phrases of one language in the report.
TOP = 2_000
#: Frequent words and frequent pairs that are sent to every task at most; beyond these the semi-join shuffles the occurrences.
SENT_WORDS, SENT_PAIRS = 500_000, 2_000_000
#: Different words, and pairs, that a task counts before it hands the counts on.
HELD_WORDS, HELD_PAIRS = 250_000, 1_500_000
#: Documents that a task works on at once.
AT_ONCE = 500

BREAK = b"."
PIECES = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", BREAK * 10)
RELATION = "row long, pos array<int>, name array<long>"


def tokens(text: str) -> list[bytes]:
    """The words of a text, A to Z in lower case, with ``BREAK`` between pieces."""
    return text.encode().lower().translate(PIECES).replace(BREAK, b" . ").split()


def _rows(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang, text = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")), F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.monotonically_increasing_id().alias("row"), lang.alias("lang"), text.alias("text"))


def _some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield from (b.iloc[first : first + AT_ONCE] for first in range(0, len(b), AT_ONCE))


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of ``rows`` (lang, text); a null word has the number of all words."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, Counter] = {}

        def counted() -> pd.DataFrame:
            out = []
            for lang, words in held.items():
                words.pop(BREAK, None)
                out += [(lang, w.decode(), n) for w, n in words.items()] + [(lang, None, words.total())]
            held.clear()
            return pd.DataFrame(out, columns=["lang", "word", "n"])

        for b in _some(batches):
            for lang, text in zip(b["lang"], b["text"], strict=True):
                held.setdefault(lang, Counter()).update(tokens(text))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield counted()
        yield counted()

    found = rows.select("lang", "text").mapInPandas(each, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _nested(occurrences: DataFrame) -> DataFrame:
    """``occurrences`` (row, pos, name) as a relation."""
    lists = occurrences.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("o"))
    return lists.select("row", F.col("o.pos").alias("pos"), F.col("o.name").alias("name"))


def word_occurrences(rows: DataFrame, words: DataFrame, most_sent: int = SENT_WORDS) -> DataFrame:
    """R_1: the places of the frequent ``words`` (id, lang, word) in ``rows`` (row, lang, text)."""
    if words.count() > most_sent:

        def spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for row, lang, text in zip(b["row"], b["lang"], b["text"], strict=True):
                    out = [(row, lang, k, w.decode()) for k, w in enumerate(tokens(text)) if w != BREAK]
                    yield pd.DataFrame(out, columns=["row", "lang", "pos", "word"])

        placed = rows.mapInPandas(spelled, "row long, lang string, pos int, word string")
        return _nested(placed.join(words.select("lang", "word", F.col("id").alias("name")), ["lang", "word"]).select("row", "pos", "name"))

    ids: dict[str, dict[bytes, int]] = {}
    for r in words.select("lang", "word", "id").toLocalIterator():
        ids.setdefault(r.lang, {})[r.word.encode()] = r.id
    sent = rows.sparkSession.sparkContext.broadcast(ids)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _some(batches):
            out = []
            for row, lang, text in zip(b["row"], b["lang"], b["text"], strict=True):
                known = sent.value.get(lang)
                if known:
                    found = tokens(text)
                    name = np.fromiter((known.get(w, 0) for w in found), np.int64, len(found))
                    pos = np.flatnonzero(name)
                    if len(pos):
                        out.append((row, pos.astype(np.int32), name[pos]))
            yield pd.DataFrame(out, columns=["row", "pos", "name"])

    return rows.mapInPandas(each, RELATION)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from (b.slice(first, AT_ONCE) for first in range(0, b.num_rows, AT_ONCE))


def _adjacent(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(number of the document in the batch, pos, left, right) of each two phrases of a relation at places that follow each other."""
    sizes = batch.column("pos").value_lengths().to_numpy(zero_copy_only=False)
    pos, name = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pos", "name"))
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first = np.flatnonzero((pos[1:] == pos[:-1] + 1) & (doc[1:] == doc[:-1]))
    return doc[first], pos[first], name[first], name[first + 1]


def _coded(left: np.ndarray, right: np.ndarray, known: np.ndarray) -> np.ndarray:
    """A number for each pair of names in ``known`` (sorted); -1 where one is not."""
    if not len(known):
        return np.full(len(left), -1)
    at = [np.minimum(np.searchsorted(known, x), len(known) - 1) for x in (left, right)]
    there = (known[at[0]] == left) & (known[at[1]] == right)
    return np.where(there, at[0] * len(known) + at[1], -1)


def pair_counts(relation: DataFrame) -> DataFrame:
    """(left, right, n) of the candidates of the next length."""

    def counted(pairs: list) -> pa.RecordBatch:
        left, right = (np.concatenate(x) for x in zip(*pairs, strict=True))
        known = np.unique(np.concatenate([left, right]))
        codes, n = np.unique(_coded(left, right, known), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(known[codes // len(known)]), pa.array(known[codes % len(known)]), pa.array(n, pa.int64())], ["left", "right", "n"]
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in _slices(batches):
            _, _, left, right = _adjacent(b)
            held.append((left, right))
            size += len(left)
            if size > HELD_PAIRS:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)

    found = relation.mapInArrow(each, "left long, right long, n long")
    return found.groupBy("left", "right").agg(F.sum("n").alias("n"))


def longer_occurrences(relation: DataFrame, pairs: DataFrame, most_sent: int = SENT_PAIRS) -> DataFrame:
    """R_k+1: the candidates of R_k that are among the frequent ``pairs`` (id, left, right)."""
    if pairs.count() > most_sent:

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in _slices(batches):
                doc, pos, left, right = _adjacent(b)
                row = b.column("row").to_numpy(zero_copy_only=False)[doc]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()), pa.array(pos, pa.int32()), pa.array(left, pa.int64()), pa.array(right, pa.int64())],
                    ["row", "pos", "left", "right"],
                )

        rows = relation.mapInArrow(placed, "row long, pos int, left long, right long")
        return _nested(rows.join(pairs.select("left", "right", F.col("id").alias("name")), ["left", "right"]).select("row", "pos", "name"))

    got = pairs.select("id", "left", "right").toPandas().astype(np.int64)
    left, right, ids = (got[c].to_numpy() for c in ("left", "right", "id"))
    known = np.unique(np.concatenate([left, right]))
    codes = _coded(left, right, known)
    order = np.argsort(codes)
    sent = relation.sparkSession.sparkContext.broadcast((known, codes[order], ids[order]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, codes, ids = sent.value
        for b in _slices(batches):
            doc, pos, left, right = _adjacent(b)
            if len(doc) and len(codes):
                code = _coded(left, right, known)
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                kept = np.flatnonzero(codes[at] == code)
                doc, pos, name = doc[kept], pos[kept], ids[at[kept]]
                docs, starts = np.unique(doc, return_index=True)
                if len(docs):
                    ends = pa.array(np.append(starts, len(doc)), pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, pa.array(v, t)) for v, t in ((pos, pa.int32()), (name, pa.int64()))]
                    row = b.column("row").to_numpy(zero_copy_only=False)[docs]
                    yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), *lists], ["row", "pos", "name"])

    return relation.mapInArrow(each, RELATION)


def _phrases(counts: DataFrame, shorter: DataFrame, least: int) -> DataFrame:
    """The frequent phrases of the next length: (id, lang, words, heads, tails, left, right, n).

    ``heads`` are the counts of the first 1, 2 … words and ``tails`` those of the last.
    """
    two = shorter.select(F.col("id").alias("right"), F.col("words").alias("words2"), "tails")
    one = shorter.select(F.col("id").alias("left"), "lang", "words", "heads")
    found = counts.where(F.col("n") >= least).join(one, "left").join(two, "right")
    return found.select(
        (F.monotonically_increasing_id() + 1).alias("id"),
        "lang",
        F.concat("words", F.slice("words2", -1, 1)).alias("words"),
        F.concat("heads", F.array("n")).alias("heads"),
        F.concat("tails", F.array("n")).alias("tails"),
        "left",
        "right",
        "n",
    )


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """(lang, total) of all words, and for each length of 1 to ``longest`` words the phrases that occur ``least`` times or more.

    Phrases are counted by language (null: ``und``) within pieces, overlaps included.
    """
    rows = _rows(docs, lang_col, text_col)
    # Frequent words, and the row of each language that has the number of all its words.
    words = written(word_counts(rows).where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = words.where("word IS NULL").select("lang", F.col("n").alias("total"))
    counts = F.array("n")
    first = words.where("word IS NOT NULL").select(
        (F.monotonically_increasing_id() + 1).alias("id"), "lang", F.array("word").alias("words"), counts.alias("heads"), counts.alias("tails"), "word", "n"
    )
    lengths = [written(first, "phrases")]
    relation = written(word_occurrences(rows, lengths[0]), "occurrences")
    for k in range(2, longest + 1):
        lengths.append(written(_phrases(pair_counts(relation), lengths[-1], least), "phrases"))
        if k < longest:
            relation = written(longer_occurrences(relation, lengths[-1]), "occurrences")
    return totals, lengths


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by score, then count, then spelling.

    A phrase's score is the least, over its cuts into two parts, of floor(1000 a n / (l r)), where a, l and r count the phrase and
    the parts and n is the number of all words; of equal cuts the first counts. A phrase that a longer frequent one has inside is left
    out if that one is as frequent. Null texts are empty, a null language is ``und``; repeated rows count each; other columns do
    not count; an empty table gives no rows.
    """
    totals, lengths = frequent_phrases(docs, least, longest, lang_col, text_col)
    left = None
    for k, found in enumerate(lengths[1:], 2):
        if k < longest:
            longer = lengths[k].select(F.col("left").alias("id"), "n").union(lengths[k].select("right", "n"))
            covered = longer.groupBy("id").agg(F.max("n").alias("n_longer"))
            found = found.join(covered, "id", "left").where("n_longer IS NULL OR n_longer < n").drop("n_longer")
        found = found.select("lang", "words", "heads", "tails", F.col("n").alias("a"))
        left = found if left is None else left.union(found)
    # Products may pass 64 bits: the counts are exact decimals of up to 38 digits.
    cuts = F.expr(
        """transform(sequence(1, size(words) - 1), k -> struct(
            1000BD * cast(a AS decimal(17,0)) * cast(total AS decimal(17,0))
              div (cast(heads[k - 1] AS decimal(19,0)) * cast(tails[size(words) - k - 1] AS decimal(19,0))) AS score,
            k AS k, heads[k - 1] AS l, tails[size(words) - k - 1] AS r))"""
    )
    scored = left.join(totals, "lang").withColumn("cut", F.array_min(cuts))
    flat = scored.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", F.col("total").alias("n"), "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
