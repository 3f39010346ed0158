"""Log of pipeline steps and of map load times."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally import fixed_values as fixed
from geotally.functions.text import base_name, keyword_label
from geotally.operators.aggregate import least_column
from geotally.operators.clean import union_by_name
from geotally.operators.dedupe import latest_per_key
from geotally.schemas import RUN_LOG

FAILED = "(failed)"
LOAD_TIMES = ("chrome_load_time", "firefox_load_time", "safari_load_time")


def tag_phase(steps: DataFrame, phase: str) -> DataFrame:
    """Steps with their phase first and file paths cut to file names."""
    return steps.withColumn("phase", F.lit(phase)).select(
        "phase",
        base_name("step_name").alias("step_name"),
        "duration_seconds",
        "start_time",
        "end_time",
        "files_processed",
    )


def union_logs(production: DataFrame, stage: DataFrame, leave_out: str = fixed.TOTAL_STEP) -> DataFrame:
    """Both phases' steps without the summary row."""
    both = union_by_name([tag_phase(production, "production"), tag_phase(stage, "stage")])
    return both.where(F.col("step_name") != leave_out)


def placeholder_steps(spark: SparkSession) -> DataFrame:
    """Rows for steps that have not run yet."""
    steps = [F.struct(F.lit(name).alias("name"), F.lit(end).alias("end")) for name, end in fixed.PLACEHOLDER_STEPS]
    number = F.lit(fixed.PLACEHOLDER_NUMBER)
    return spark.range(1).select(F.explode(F.array(*steps)).alias("step")).select(
        F.lit(fixed.PLACEHOLDER_PHASE).alias("phase"),
        F.col("step.name").alias("step_name"),
        number.alias("duration_seconds"),
        F.lit(fixed.PLACEHOLDER_START).cast("timestamp_ntz").alias("start_time"),
        F.col("step.end").cast("timestamp_ntz").alias("end_time"),
        number.alias("files_processed"),
    )


def latest_steps(log: DataFrame) -> DataFrame:
    """Newest entry of each step: the log is only appended to, and this view plays the update."""
    return latest_per_key(
        log, ["step_name"], ["start_time", "end_time"], ["duration_seconds", "files_processed", "phase"]
    )


def fastest_browser(load_times: DataFrame, columns: Sequence[str] = LOAD_TIMES) -> DataFrame:
    """Column with the shortest load time of each map."""
    return least_column(load_times, columns, "fastest")


def add_map_kind(df: DataFrame, path: str, name: str = "map_type") -> DataFrame:
    """Kind of map from its file name."""
    return df.withColumn(name, keyword_label(path, fixed.MAP_KINDS, fixed.UNKNOWN_MAP_KIND))


@dataclass
class StepLog:
    """Collects one small row per step of a run; :meth:`frame` hands them to Spark.

    A step that fails has a row too, with ``FAILED`` after its phase, and no files processed.
    """

    rows: list[tuple] = field(default_factory=list)

    @contextmanager
    def step(self, phase: str, name: str, files: int = 1) -> Iterator[None]:
        begun, clock, done = _now(), time.monotonic(), False
        try:
            yield
            done = True
        finally:
            status = (phase, float(files)) if done else (f"{phase} {FAILED}", 0.0)
            self.rows.append((status[0], name, time.monotonic() - clock, begun, _now(), status[1]))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, RUN_LOG)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
