"""Substring dedup by hashing of lines and the sentences in them.

Units are normalised and digested, equal digests are counted over all documents, the occurrence of the first rank stays, and
the others are removed by their places in the original text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geotally.llm.common import ids_and_texts, unused, with_ids, written

#: Words of a unit at least; shorter ones are repeated by chance.
LEAST_WORDS = 8


def units(text: str | None) -> Iterator[tuple[int, int, list[bytes]]]:
    """(start, end, words) in code points of each unit: a line, or a sentence within one (ended by . ! or ? and a blank).

    Words are between blanks, A to Z in lower case.
    """
    at = 0
    for unit in (text or "").replace(". ", ".\n").replace("! ", "!\n").replace("? ", "?\n").split("\n"):
        yield at, at + len(unit), unit.encode().lower().split()
        at += len(unit) + 1


def hashed_units(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, n_words, digest) of each unit of ``least_words`` or more; digests have 128 bits."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for first in range(0, len(b), 500):
                part, out = b.iloc[first : first + 500], []
                for i, t in zip(part["id"], part["text"], strict=True):
                    out += [(i, a, z, len(w), xxhash.xxh3_128_digest(b" ".join(w))) for a, z, w in units(t) if len(w) >= least_words]
                yield pd.DataFrame(out, columns=["id", "start", "end", "n_words", "digest"])

    found = ids_and_texts(docs, id_col, text_col).mapInPandas(each, "id string, start long, end long, n_words long, digest binary")
    return with_ids(found, docs, id_col)


def repeated_units(docs: DataFrame, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, end, n_words, keep_<id>, keep_start): every unit to be removed, and the place of the one that stays.

    The first occurrence by id, then place stays, within one document too. Null and empty texts have no units; a null id
    ranks first. Rows that repeat an id and a text have the same places, so they stay or go together.
    """
    found = written(hashed_units(docs, least_words, id_col, text_col), "units")
    place = F.struct("id", "start")
    counted = found.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # Written, so that both sides of the join have an exchange of their own, which can be split at a hot digest.
    shared = written(counted.where("n > 1").drop("n"), "shared")
    return (
        found.join(shared, "digest")
        .where(~place.eqNullSafe(F.col("first")))
        .select(F.col("id").alias(id_col), "start", "end", "n_words", F.col("first.id").alias(f"keep_{id_col}"), F.col("first.start").alias("keep_start"))
    )


def without_repeats(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the ``removed`` units cut out of their texts, and ``removed_spans`` with their places in the original.

    All other columns stay, whatever their names; one called ``removed_spans`` is replaced.
    """
    own = unused(docs, "_id")
    spans = removed.groupBy(F.col(id_col).alias(own)).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("removed_spans"))
    rows = docs.drop("removed_spans").join(spans, docs[id_col].eqNullSafe(F.col(own)), "left").drop(own)
    left = F.aggregate(
        "removed_spans",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("kept")),
        lambda s, x: F.struct(
            x["end"].alias("at"),
            F.concat(s["kept"], F.array(F.substr(F.col(text_col), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")))).alias("kept"),
        ),
    )
    rest = F.substr(F.col(text_col), (left["at"] + 1).cast("int"))
    cut = F.concat(F.array_join(left["kept"], ""), rest)
    return rows.withColumn(text_col, F.when(F.col("removed_spans").isNull(), F.col(text_col)).otherwise(cut))
