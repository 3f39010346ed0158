"""Table refresh, append and text export."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SLOT = "geotally.slot"


def _live_slot(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    row = spark.sql(f"SHOW TBLPROPERTIES {name} ('{_SLOT}')").first()
    return row["value"] if row["value"] in ("a", "b") else None


def replace_table(
    df: DataFrame, name: str, root: str, partition_by: Sequence[str] = (), rebalance: bool | None = None
) -> DataFrame:
    """Write ``df`` as the new content of table ``name`` and return the table.

    The rows go to the one of two folders that readers do not use; then the view ``name`` is
    pointed at it, in one catalogue change. Readers see the old or the new content, never none,
    and a failed write changes nothing. With ``rebalance`` (by default where there are partition values)
    Spark evens out the files, also where one value has most of the rows; else rows are written by
    the tasks that made them.
    """
    spark = df.sparkSession
    slot = "b" if _live_slot(spark, name) == "a" else "a"
    path = "/".join([root.rstrip("/"), *name.split("."), slot])
    if rebalance if rebalance is not None else bool(partition_by):
        df = df.hint("rebalance", *map(F.col, partition_by))
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rpartition('.')[0]}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{_SLOT}' = '{slot}') AS SELECT * FROM parquet.`{path}`"
    )
    return spark.table(name)


def append_new_files(df: DataFrame, path: str, file_column: str = "src_filename") -> None:
    """Append rows of input files that ``path`` does not hold yet, so staging a file again adds nothing."""
    spark = df.sparkSession
    if _has_rows(spark, path):
        staged = spark.read.parquet(path).select(file_column).distinct()
        df = df.join(staged, file_column, "left_anti").select(*df.columns)
    df.write.mode("append").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def _has_rows(spark: SparkSession, path: str) -> bool:
    folder = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    try:
        return bool(folder.load(path).select("path").head(1))
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def export_csv(df: DataFrame, path: str) -> None:
    """Delimited text with a header in every file of the folder."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_tables(spark: SparkSession, schema: str, names: Iterable[str], folder: str) -> None:
    """One folder of text per table. Struct columns are written as JSON, which text can hold."""
    for name in names:
        df = spark.table(f"{schema}.{name}")
        nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("struct", "array", "map")]
        flat = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
        export_csv(flat, f"{folder.rstrip('/')}/{name}")


def write_features(features: DataFrame, path: str) -> None:
    """GeoJSON text, one feature per line."""
    features.select("feature").write.mode("overwrite").text(path)
