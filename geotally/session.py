"""Session settings the operators are written for."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on these, so they are always set.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Tuning that a cluster may already have chosen: set only where it is unset.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app_name: str = "geotally", master: str | None = None, **settings: str) -> SparkSession:
    """Return a session with the required settings; ``settings`` win over the preferred ones.

    Setting names are passed with ``__`` for each dot, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**chosen, **REQUIRED}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for name, value in PREFERRED.items():
        if name not in chosen and not submitted.contains(name):
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession, *parts: str, fallback: str | None = None) -> str:
    """Path under the folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    ``fallback`` is for sessions without a cluster (tests); without either, this refuses to guess.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return "/".join([root.rstrip("/"), *parts])


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="shared-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder. A session on one machine without that setting gets a folder of its own; a cluster does not."""
    alone = spark.sparkContext.master.startswith("local") and not spark.conf.get("spark.checkpoint.dir", None)
    return shared_folder(spark, f"{label}-{uuid.uuid4().hex}", fallback=_own_folder() if alone else None)
