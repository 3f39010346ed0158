"""Tables of the catalogue and of other databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally.operators.clean import filter_names


def catalog_tables(
    spark: SparkSession, schema: str, not_like: Sequence[str] = (), not_in: Sequence[str] = ()
) -> DataFrame:
    """Names of the tables and views of a schema, without those the filters exclude."""
    names = spark.sql(f"SHOW TABLES IN {schema}").where(~F.col("isTemporary"))
    return filter_names(names.select(F.col("tableName").alias("table_name")), "table_name", not_like, not_in)


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: int | str,
    upper: int | str,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Table of another database, read over ``partitions`` connections split by a column's range.

    Credentials come in ``options`` from the caller's own secret store; nothing is logged.
    """
    reader = spark.read.format("jdbc").options(**(options or {}))
    return (
        reader.option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(partitions))
        .load()
    )
