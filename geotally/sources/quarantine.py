"""Delimited text whose faulty lines are set aside, by file and reason, instead of stopping the job.

The lines are read once and parsed by the JVM's own parser. Good rows, faulty lines and headers are written side by side; what is asked
later (which files have the right header, how many lines are faulty) is answered from that, not from another read of the files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from geotally.sources.files import FILE_NAME, cells_of, ddl

GOOD, BAD, HEADER = "good", "bad", "header"
#: Why a line was set aside: its file has no header like the schema, it has too many or too few cells, or a cell is not of its type.
NO_HEADER, WRONG_CELLS, WRONG_TYPE = "header", "cells", "type"
#: Files named in a message.
NAMED = 5
SIDE, LINE, REASON = "_side", "_line", "reason"


class BudgetExceeded(ValueError):
    """More lines are faulty than the job allows."""


@dataclass(frozen=True)
class ErrorBudget:
    """Largest share of faulty lines among all lines, and among those of any one file."""

    share: float = 0.01
    share_of_file: float = 1.0


@dataclass(frozen=True)
class Scanned:
    """``good`` rows with their file, ``bad`` lines (file, reason, line), and the counts ``by_file``."""

    good: DataFrame
    bad: DataFrame
    by_file: DataFrame


def parsed_lines(spark: SparkSession, path: str, schema: StructType, sep: str = ",", pattern: str = "*") -> DataFrame:
    """Every line with its file, its cells in one struct ``row``, its side and, for faulty ones, the reason.

    Blank lines do not count. A record is a line: line breaks inside quotes make faulty lines.
    """
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    line = F.regexp_replace("value", "^﻿", "")
    text = files.text(path).select(F.col("_metadata.file_path").alias(FILE_NAME), line.alias(LINE)).where(F.trim(LINE) != "")
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    row = F.from_csv(LINE, f"{ddl(schema)}, _corrupt string", options)
    parsed = text.select(FILE_NAME, LINE, row.alias("row"))
    is_header = F.replace(LINE, F.lit('"'), F.lit("")) == sep.join(schema.names)
    faulty = F.col("row").isNull() | F.col("row._corrupt").isNotNull()
    side = F.when(is_header, HEADER).when(faulty, BAD).otherwise(GOOD)
    reason = F.when(F.size(cells_of(F.col(LINE), sep)) == len(schema.names), WRONG_TYPE).otherwise(WRONG_CELLS)
    return parsed.select("*", side.alias(SIDE)).withColumn(REASON, F.when(F.col(SIDE) == BAD, reason))


def scan(
    spark: SparkSession, path: str, schema: StructType, target: str, budget: ErrorBudget | None = None, sep: str = ",", pattern: str = "*"
) -> Scanned:
    """Read the files of ``path`` once into the folder ``target`` and part good rows from faulty lines.

    All lines of a file without the right header are set aside. Beyond the budget this stops, with the worst files in the
    message; what was read stays in ``target`` to be looked at.
    """
    parsed_lines(spark, path, schema, sep, pattern).write.partitionBy(SIDE).parquet(target)
    read = spark.read.parquet(target)
    headed = read.where(F.col(SIDE) == HEADER).select(F.col(FILE_NAME).alias("_file")).distinct()
    lines = read.where(F.col(SIDE) != HEADER).join(headed, F.col(FILE_NAME) == F.col("_file"), "left")
    wrong = F.when(F.col("_file").isNull(), NO_HEADER).otherwise(F.col(REASON))
    lines = lines.withColumn(REASON, wrong)
    good = lines.where(F.col(REASON).isNull()).select(*(F.col("row")[n].alias(n) for n in schema.names), FILE_NAME)
    bad = lines.where(F.col(REASON).isNotNull()).select(FILE_NAME, REASON, F.col(LINE).alias("line"))
    by_file = lines.groupBy(FILE_NAME).agg(F.count(F.lit(1)).alias("n_lines"), F.count(REASON).alias("n_bad"))
    _check(by_file, budget or ErrorBudget())
    return Scanned(good, bad, by_file)


def _check(by_file: DataFrame, budget: ErrorBudget) -> None:
    share = F.col("n_bad") / F.col("n_lines")
    total, bad, worst = by_file.agg(F.sum("n_lines"), F.sum("n_bad"), F.max(share)).first()
    if not total or (bad <= budget.share * total and worst <= budget.share_of_file):
        return
    named = by_file.where("n_bad > 0").orderBy(share.desc(), F.desc("n_bad"), FILE_NAME).limit(NAMED).collect()
    worst_files = ", ".join(f"{r[FILE_NAME].rsplit('/', 1)[-1]} ({r['n_bad']} of {r['n_lines']})" for r in named)
    raise BudgetExceeded(f"{bad} of {total} lines are faulty, first of all in {worst_files}")
