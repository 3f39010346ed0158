"""Tables that lie in buckets by an upper-case key, so that joins and newest-row rules on it need no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "_key"


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as table ``name`` in ``path`` with its upper-case ``key`` as ``_key``, bucketed and sorted by it.

    One task writes one bucket, so each bucket is one sorted file; the number of buckets is the number of tasks of every join
    on the key, to be chosen for the larger table.
    """
    keyed = df.withColumn(KEY, F.upper(F.col(key).cast("string")))
    rows = keyed.repartition(buckets, KEY)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, KEY).sortBy(KEY).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def join_bucketed(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Rows of ``fact`` with the ``dimension`` row of the same key, both as :func:`write_bucketed` made them; no row is moved."""
    return fact.join(dimension.hint("merge"), KEY).drop(KEY)

