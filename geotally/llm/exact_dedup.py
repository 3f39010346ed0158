"""Exact dedup by content sort.

Sampled splitters range-partition the texts by content alone: a short leading key, then a hash. The rows of a partition are sorted, so
that equal texts are neighbours, and runs of neighbours whose whole normalised texts are equal are reduced to one row. A text that has
more than a thousandth of all rows would fill a partition; its rows are dealt over ``SALTS`` neighbouring ranges, and what is left of
these, a digest each, meets in a second exchange that no text goes through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotally.llm.common import BLANKS, unused

#: Characters of the leading key, so that the splitters that the driver holds stay small.
KEY_CHARS = 32
#: Share of all rows, and rows, beyond which a text is dealt over several ranges; fewer than 1 / HOT_SHARE texts have that many.
HOT_SHARE, HOT_ROWS, SALTS = 0.001, 1_000, 64


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def equal_text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per different normalised text: its digest, the row that stays, and how many rows have it.

    The row with the most code points in its original text stays, then the smallest id; a null id comes last.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
        normalised(F.col(text_col)).alias("norm"),
    ).withColumn("hash", F.xxhash64("norm"))
    counts = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    many = F.greatest(F.lit(HOT_ROWS), counts.select(F.sum("n")).scalar() * HOT_SHARE)
    hot = counts.where(F.col("n") > many).select(F.col("hash").alias("hot"))
    # Fewer than 1 / HOT_SHARE rows, however large the input.
    dealt = rows.join(F.broadcast(hot), F.col("hash") == F.col("hot"), "left")
    salt = F.when(F.col("hot").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "chars"), F.lit(SALTS)).cast("int"))
    keyed = dealt.select(F.left("norm", F.lit(KEY_CHARS)).alias("head"), "hash", salt.alias("salt"), "norm", "id", "chars")
    ordered = keyed.repartitionByRange("head", "hash", "salt").sortWithinPartitions("head", "hash", "salt", "norm")
    # The ranges hold all rows of a key, so this compares neighbours where they lie.
    runs = ordered.groupBy("head", "hash", "salt", "norm").agg(
        F.min(F.struct((-F.col("chars")).alias("fewer"), F.col("id").isNull().alias("no_id"), "id")).alias("stays"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    digests = runs.select(F.sha2("norm", 256).alias("text_sha256"), "stays", "n_rows")
    whole = digests.groupBy("text_sha256").agg(F.min("stays").alias("stays"), F.sum("n_rows").alias("group_size"))
    return whole.select("text_sha256", F.col("stays.id").alias("keep_id"), "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``, dropped ones too.

    Texts are equal when they are identical without blanks; null and empty texts are equal. Repeated rows with the
    id of the row that stays are all marked kept. An empty table gives no rows; other columns are not read.
    """
    classes = equal_text_classes(docs, id_col, text_col)
    # Only texts that several rows share need the way back; their digests stand for the texts compared above.
    shared = classes.where("group_size > 1").withColumnRenamed("text_sha256", "digest")
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"))
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return rows.join(shared, rows.text_sha256 == shared.digest, "left").select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        keep.eqNullSafe(F.col("id")).alias("kept"),
        "text_sha256",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each normalised text the one of ``equal_text_classes``.

    Rows are told apart by text, so null ids and ids of several texts do no harm; of rows that repeat id and text one stays. An
    empty table gives no rows.
    """
    digest, chars, rank = (unused(docs, name) for name in ("digest", "chars", "rank"))
    group = unused(docs, "group")
    shared = equal_text_classes(docs, id_col, text_col).where("group_size > 1").select(F.col("text_sha256").alias(group))
    keyed = docs.withColumns({digest: F.sha2(normalised(F.col(text_col)), 256), chars: F.length(F.coalesce(F.col(text_col), F.lit("")))})
    tagged = keyed.join(shared, F.col(digest) == F.col(group), "left")
    # The rank is cut to 1 before the exchange, so a text of any number of copies gives one row of each task.
    order = Window.partitionBy(group).orderBy(F.desc(chars), F.col(id_col).isNull(), id_col)
    first = tagged.where(F.col(group).isNotNull()).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return tagged.where(F.col(group).isNull()).select(docs.columns).union(first.select(docs.columns))
