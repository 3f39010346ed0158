"""Staging of files as they land: each file is read exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geotally.session import shared_folder
from geotally.sources.files import FILE_NAME, text_options


def append_landed_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    conform: Callable[[DataFrame], DataFrame],
    target: str,
    name: str,
    checkpoint: str | None = None,
    sep: str = ",",
) -> None:
    """Append the files that landed since the last run to ``target`` and stop.

    Which files were read is kept under ``spark.checkpoint.dir`` (or ``checkpoint``), so a run that
    dies is taken up where it stopped and a file is never staged twice.
    """
    raw = (
        spark.readStream.schema(schema)
        .options(**text_options(sep))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(landing)
        .select("*", F.col("_metadata.file_path").alias(FILE_NAME))
    )
    query = (
        conform(raw)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or shared_folder(spark, "staging", name))
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
