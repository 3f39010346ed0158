"""The given tables in the shapes the operators work on.

Users stand in for stations, customers for places and intersections; positions follow from keys.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 7, 1, 12, 0, 0)
#: The types that the given tables have, in the order of their columns. Another one in a table has a column after these.
EVENT_TYPES = ("view", "signup", "click", "error", "purchase")


def event_types(t: Tables) -> list[str]:
    """Types of the events, the known ones first; there are few, and they become columns."""
    found = {r[0] for r in t("events").select("event_type").distinct().collect() if r[0] is not None}
    return [*EVENT_TYPES, *sorted(found - set(EVENT_TYPES))]


class Tables:
    """Parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def latitude(key: str):
    return (F.lit(43) + F.col(key) % 977 / F.lit(1000)).alias("latitude")


def longitude(key: str):
    return (F.lit(-79) - F.col(key) % 613 / F.lit(1000)).alias("longitude")


def readings(t: Tables) -> DataFrame:
    """Events as long readings, station ids in lower case."""
    return t("events").select(
        F.to_date("ts").alias("the_date"),
        F.hour("ts").cast("bigint").alias("hours_utc"),
        F.concat(F.lit("st"), "user_id").alias("cgndb_id"),
        F.col("value").alias("air_quality_value"),
        F.concat(F.lit("listing/"), "event_type").alias("download_link"),
        F.concat("event_type", F.lit(".csv")).alias("src_filename"),
        F.col("ts").alias("last_updated"),
    )


def positioned_readings(t: Tables) -> DataFrame:
    """Events with the position of their station."""
    return t("events").select(
        F.col("user_id").alias("cgndb_id"),
        latitude("user_id"),
        longitude("user_id"),
        F.to_date("ts").alias("the_date"),
        F.hour("ts").alias("hours_utc"),
        F.col("value").alias("air_quality_value"),
        "ts",
        "event_type",
    )


def raw_gazetteer(t: Tables) -> DataFrame:
    """Customers as gazetteer rows under the landed column names, two versions of each.

    The second version of furniture customers has no decision date and so counts as the newest.
    """
    customer = t("customer")
    key = F.col("c_custkey")
    version = F.explode(F.array(F.lit(0), F.lit(1))).alias("_version")
    rows = customer.select("*", version)
    decided = F.date_add(F.lit("2020-01-01").cast("date"), (key % 365 + F.col("_version")).cast("int"))
    undated = (F.col("_version") == 1) & (F.col("c_mktsegment") == "FURNITURE")
    return rows.select(
        F.concat(F.lit("ST"), key).alias("CGNDB ID"),
        F.concat("c_name", F.lit(" v"), "_version").alias("Geographical Name"),
        F.lit("English").alias("Language"),
        F.lit(None).cast("string").alias("Syllabic Form"),
        F.col("c_mktsegment").alias("Generic Term"),
        F.lower("c_mktsegment").alias("Generic Category"),
        F.substring("c_mktsegment", 1, 4).alias("Concise Code"),
        key.cast("string").alias("Toponymic Feature ID"),
        latitude("c_custkey").alias("Latitude"),
        longitude("c_custkey").alias("Longitude"),
        F.concat(F.lit("Nation "), "c_nationkey").alias("Location"),
        F.col("c_nationkey").cast("string").alias("Province - Territory"),
        F.col("_version").cast("bigint").alias("Relevance at Scale"),
        F.when(~undated, decided).alias("Decision Date"),
        F.lit("customer").alias("Source"),
        F.lit("landing/places.csv").alias("src_filename"),
    )


def intersections(t: Tables) -> DataFrame:
    """Orders as counts per intersection: price as vehicles, a third of the key range as pedestrians."""
    return t("orders").select(
        F.col("o_custkey").alias("objectid"),
        F.col("o_orderpriority").alias("main"),
        F.col("o_orderstatus").alias("tcs__"),
        latitude("o_custkey"),
        longitude("o_custkey"),
        F.col("o_orderdate").cast("date").alias("count_date"),
        F.col("o_totalprice").alias("f8hr_vehicle_volume"),
        (F.col("o_orderkey") % 1000 / F.lit(3)).alias("f8hr_pedestrian_volume"),
    )


def zipped_customers(t: Tables) -> DataFrame:
    """Customers packed by Spark into one zip archive per batch, with awkward text in one column."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as zipped:
                zipped.writestr("notes.txt", "not a table")
                zipped.writestr("customers.csv", batch.to_csv(index=False))
            name = f"customers-{batch['c_custkey'].iloc[0]}.zip"
            yield pd.DataFrame({"path": [name], "content": [buffer.getvalue()]})

    rows = t("customer").select(
        "c_custkey", "c_name", "c_acctbal", F.concat("c_mktsegment", F.lit(', "x"\ny')).alias("note")
    )
    return rows.mapInPandas(pack, "path string, content binary")


def write_lines(lines: DataFrame, path: str) -> None:
    """Text files of ``lines`` (file, header, order, line), one in each folder ``file=…``: the header, then the lines in order."""
    heads = lines.groupBy("file").agg(F.min("header").alias("line")).select("file", F.lit(None).cast("bigint").alias("order"), "line")
    rows = heads.union(lines.select("file", "order", "line")).repartition("file")
    ordered = rows.sortWithinPartitions("file", F.col("order").asc_nulls_first())
    ordered.select("file", F.col("line").alias("value")).write.partitionBy("file").text(path)


def faulty_orders(t: Tables) -> DataFrame:
    """Orders as lines of five files. Some lack a cell, some have a word for a number, and one file has another header."""
    key = F.col("o_orderkey")
    customer = F.when(key % 89 == 0, "n/a").otherwise(F.col("o_custkey").cast("string"))
    price = F.concat(F.floor("o_totalprice").cast("string"), F.lit(".5"))
    cells = [key.cast("string"), customer, price, F.concat(F.lit('"'), "o_orderpriority", F.lit(', ""x"""'))]
    line = F.when(key % 97 == 0, F.concat_ws(";", *cells[:3])).otherwise(F.concat_ws(";", *cells))
    names = "o_orderkey;o_custkey;o_totalprice;priority"
    header = F.when(key % 5 == 4, names.replace("priority", "urgency")).otherwise(names)
    return t("orders").select((key % 5).alias("file"), header.alias("header"), key.alias("order"), line.alias("line"))


def drifting_readings(t: Tables, kinds: list[str]) -> DataFrame:
    """The highest event value by date, hour and type as lines of six files, by day of month, each of which leaves out one of the types."""
    part = F.dayofmonth("ts") % 6
    stations = [F.max(F.when(F.col("event_type") == kind, F.col("value"))).alias(kind) for kind in kinds]
    wide = t("events").groupBy(part.alias("file"), F.to_date("ts").alias("day"), F.hour("ts").alias("hour")).agg(*stations)
    left_out = [F.col("file") % len(kinds) == k for k in range(len(kinds))]
    names = [F.when(~gone, kind.upper()) for gone, kind in zip(left_out, kinds, strict=True)]
    cells = [F.when(~gone, F.coalesce(F.col(kind).cast("string"), F.lit(""))) for gone, kind in zip(left_out, kinds, strict=True)]
    return wide.select(
        "file",
        F.concat_ws(",", F.lit("Date"), F.lit("Hour (UTC)"), *names).alias("header"),
        (F.unix_date("day") * 24 + F.col("hour")).cast("bigint").alias("order"),
        F.concat_ws(",", F.col("day").cast("string"), F.col("hour").cast("string"), *cells).alias("line"),
    )
