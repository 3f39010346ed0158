"""Tables that are updated by key, and tables of which only the months that new rows touch are written.

A keyed table lies in buckets by a hash of its keys. A merge reads and writes only the buckets that have changed keys, each into a new
folder, and then publishes the change by one small manifest; files of other buckets keep their names, and readers see one version or
the next, never a mixture.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geotally.operators.dedupe import latest_per_key
from geotally.session import scratch_path

BUCKET = "_bucket"
Combine = Callable[[DataFrame], DataFrame]


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    system, where = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    system, where = _file_system(spark, path)
    out = system.create(where, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def remove(spark: SparkSession, path: str) -> None:
    system, where = _file_system(spark, path)
    system.delete(where, True)


def newest(keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str]) -> Combine:
    """Of old and new rows the newest of each key stays."""
    return lambda rows: latest_per_key(rows, keys, order, tiebreak)


class KeyedTable:
    """A table under ``root`` with the columns ``keys`` and so many buckets, which are fixed with the first merge."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int = 64) -> None:
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), tuple(keys), buckets

    def versions(self) -> list[int]:
        return [int(n.partition(".")[0]) for n in names_in(self.spark, f"{self.root}/manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict:
        """Schema, keys, number of buckets, and the folder of each bucket that has rows."""
        known = self.versions()
        if not known:
            return {"keys": list(self.keys), "buckets": self.buckets, "schema": None, "folders": {}}
        version = known[-1] if version is None else version
        text = self.spark.read.text(f"{self.root}/manifests/{version:08}.json", wholetext=True).first()[0]
        return json.loads(text)

    def bucket(self, buckets: int):
        return F.pmod(F.xxhash64(*self.keys), F.lit(buckets)).cast("int")

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The rows of a version (the newest), or of some of its buckets; None if there are none."""
        found = self.manifest(version)
        wanted = found["folders"] if buckets is None else {str(b): found["folders"].get(str(b)) for b in buckets}
        folders = sorted(f"{self.root}/{f}" for f in wanted.values() if f)
        if not found["schema"]:
            return None
        schema = StructType.fromJson(found["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def merge(self, updates: DataFrame, combine: Combine) -> int:
        """Put ``updates`` in, ``combine`` deciding over old and new rows of each key; returns the version.

        The combination may leave keys out, which removes them. Two merges at once cannot both publish: the later one fails
        and changes nothing.
        """
        before = self.manifest()
        if tuple(before["keys"]) != self.keys:
            raise ValueError(f"the table's keys are {', '.join(before['keys'])}")
        version = (self.versions() or [0])[-1] + 1
        own = self.bucket(before["buckets"])
        # The updates are needed twice, for their buckets and for their rows.
        incoming = scratch_path(self.spark, "updates")
        updates.write.parquet(incoming)
        staged = self.spark.read.schema(updates.schema).parquet(incoming)
        touched = sorted(r[0] for r in staged.select(own).distinct().collect())
        current = self.read(buckets=touched)
        rows = combine(staged if current is None else current.unionByName(staged)).select(*updates.columns)
        folder = f"data/{version:08}"
        rows.withColumn(BUCKET, own).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        written = {n.partition("=")[2]: f"{folder}/{n}" for n in names_in(self.spark, f"{self.root}/{folder}") if n.startswith(BUCKET)}
        kept = {b: f for b, f in before["folders"].items() if int(b) not in touched}
        after = {**before, "schema": updates.schema.jsonValue(), "folders": {**kept, **written}}
        create_text(self.spark, f"{self.root}/manifests/{version:08}.json", json.dumps(after))
        remove(self.spark, incoming)
        return version

    def forget(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions, and folders that none of these has."""
        known = self.versions()
        used = {f for v in known[-keep:] for f in self.manifest(v)["folders"].values()}
        for v in known[:-keep]:
            remove(self.spark, f"{self.root}/manifests/{v:08}.json")
        for name in names_in(self.spark, f"{self.root}/data"):
            for part in names_in(self.spark, f"{self.root}/data/{name}"):
                if part.startswith(BUCKET) and f"data/{name}/{part}" not in used:
                    remove(self.spark, f"{self.root}/data/{name}/{part}")


def refresh_parts(new: DataFrame, path: str, parts: Sequence[str], combine: Combine) -> DataFrame:
    """Put ``new`` rows into the table at ``path``, partitioned by ``parts``, writing only the partitions that they touch.

    ``combine`` decides over the old and new rows of those. Values of ``parts`` are few (months), so they come to the driver;
    old partitions are pruned by them and replaced in one commit.
    """
    spark = new.sparkSession
    incoming = scratch_path(spark, "incoming")
    new.write.parquet(incoming)
    staged = spark.read.schema(new.schema).parquet(incoming)
    touched = staged.select(*parts).distinct().collect()
    rows = staged
    if names_in(spark, path) and touched:
        inside = reduce(or_, [reduce(lambda a, b: a & b, [F.col(p).eqNullSafe(F.lit(r[p])) for p in parts]) for r in touched])
        old = spark.read.schema(new.schema).parquet(path).where(inside)
        rows = old.unionByName(staged)
    merged = combine(rows).select(*new.columns)
    # Written apart first: the partitions that are replaced are read for their own replacement.
    ready = scratch_path(spark, "ready")
    merged.write.parquet(ready)
    whole = spark.read.schema(new.schema).parquet(ready).hint("rebalance", *map(F.col, parts))
    whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
    remove(spark, incoming)
    remove(spark, ready)
    return spark.read.schema(new.schema).parquet(path)
