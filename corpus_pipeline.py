"""A corpus from raw documents to packed sequences, stage by stage.

Each stage works on all that the one before it kept; ``run`` writes each result as Parquet to the shared folder and
reads it again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally.llm import decontamination, exact_dedup, near_dedup, packing, quality_crf
from geotally.llm.common import table, written
from geotally.llm.queries import TOKENIZER

#: Near-duplicates share this much of their five-word shingles (Jaccard) at least.
NEAR_WORDS, NEAR_SHARE = 5, 0.8
#: Fingerprints that differ in this many of 64 bits at most give the first candidates; the result does not depend on it.
NEAR_BITS = 3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model finds good (a score of 0.5 or more). Rows are judged by their text; ids do not count."""
    model = quality_crf.trained(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_crf.score(model, F.col("text")) >= 0.5)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, blanks aside: the longest, then the smallest id, a null one last. Of repeated rows one stays."""
    return exact_dedup.one_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest id, a null one last. Of repeated rows one stays."""
    return near_dedup.without_near_duplicates(docs, words=NEAR_WORDS, radius=NEAR_BITS, least=NEAR_SHARE)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark. Rows are dropped by their text; ids do not count."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of token ids; an id that is null or there twice names the pieces of each of its rows."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("benchmark decontamination", clean_of_benchmarks),
    ("packing", packed),
]

#: The quality model and the tokenizer cannot be expressed in SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
