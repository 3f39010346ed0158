"""What the operators of this subpackage share: the shared folder, label samples and byte helpers."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally.session import shared_folder

#: The six blank characters that normalised texts lose or are split at.
BLANKS = "\t\n\x0b\f\r "


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def _write(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    alone = spark.sparkContext.master.startswith("local") and not spark.conf.get("spark.checkpoint.dir", None)
    path = shared_folder(spark, f"{label}-{uuid.uuid4().hex}", fallback=_own_folder() if alone else None)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, which cuts its lineage.

    The folder is the one that ``spark.checkpoint.dir`` names. A cluster without that setting is refused, because a folder of
    the driver's own would be out of reach for executors; a session on one machine gets one.
    """
    return _write(df, label)[0]


class Scratch:
    """Tables written to the shared folder that are removed once their last reader is written itself."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def written(self, df: DataFrame, label: str) -> DataFrame:
        found, path = _write(df, label)
        self.paths.append(path)
        return found

    def clear(self) -> None:
        """Remove the tables; nothing that was not written since may still read them, a lost executor's tasks included."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ids_and_texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, text, more) with ids as text: pandas would turn whole numbers into fractions where a null is among them."""
    return docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), *more)


def with_ids(df: DataFrame, docs: DataFrame, id_col: str, name: str | None = None) -> DataFrame:
    """``df`` with its ids in the type they have in ``docs``, under ``name`` (else still ``id``)."""
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType
    return df.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", name or "id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, of: int) -> Column:
    """Remainder by which rows are held out: crc32 of the id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def label_sample(labels: DataFrame, label: str, of: int, held: int, bound: int) -> DataFrame:
    """At most ``bound`` rows (doc_id, label) of those that may be learned from, chosen by a hash of the id.

    Rows without a label or id do not count; of several labels of one id the largest holds.
    """
    usable = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("doc_id"), of) != held)
    )
    share = min(1.0, 1.2 * bound / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.lit(int(share * 1_000_003) + 1))
    one = drawn.groupBy("doc_id").agg(F.max("label").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
