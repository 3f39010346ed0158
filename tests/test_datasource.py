"""Formats of zipped and drifting text, and scans that set faulty lines aside."""

import datetime as dt
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from geotally import schemas
from geotally.sources import datasource as ds
from geotally.sources import files, quarantine
from geotally.sources.files import FILE_NAME

PAIR = schemas.table(("id", schemas.WHOLE), ("text", schemas.TEXT))
NAMED = schemas.table(("id", schemas.WHOLE), ("text", schemas.TEXT), (FILE_NAME, schemas.TEXT), (ds.MEMBER, schemas.TEXT))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    ds.register(spark)


@pytest.fixture
def archives(tmp_path):
    folder = tmp_path / "zips"
    (folder / "deep").mkdir(parents=True)
    for name, members in {"one": ["a", "b"], "deep/two": ["c"]}.items():
        with zipfile.ZipFile(folder / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.txt", "x")
            for k, m in enumerate(members):
                z.writestr(f"{m}.csv", f'id,text\n{k},"{m}, ""q""\nnext"\n9,\n8,""\n')
    (folder / "other.txt").write_text("no archive")
    return folder


def test_zipped_members_are_partitions(spark, archives):
    read = spark.read.format("zipped_csv").schema(PAIR).load(str(archives))
    assert rows(read) == sorted(
        [(0, 'a, "q"\nnext'), (1, 'b, "q"\nnext'), (0, 'c, "q"\nnext'), *[(9, None), (8, "")] * 3], key=repr
    )
    assert read.rdd.getNumPartitions() == 3
    assert rows(files.read_zipped_csv(spark, str(archives / "one.zip"), PAIR).select("id", "text"))[0] == (0, 'a, "q"\nnext')


def test_filters_spare_members(spark, archives):
    read = spark.read.format("zipped_csv").schema(NAMED).load(str(archives))
    for condition, n in ((F.col(ds.MEMBER) == "b.csv", 1), (F.col(FILE_NAME).endswith("two.zip"), 1), (F.col(ds.MEMBER).isin("a.csv", "c.csv"), 2)):
        found = read.where(condition)
        assert found.rdd.getNumPartitions() == n
        assert found.count() == 3 * n
    assert read.where("src_member = 'none'").count() == 0
    assert read.where("src_member = 'b.csv' AND id = 1").count() == 1


def test_wrong_columns_of_a_member(spark, archives):
    with pytest.raises(Exception, match="has columns"):
        spark.read.format("zipped_csv").schema(schemas.table(("other", schemas.TEXT))).load(str(archives)).collect()


def test_zipped_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = schemas.table(("id", schemas.WHOLE), ("text", schemas.TEXT), ("x", schemas.NUMBER))
    data = [(1, "a,b", 1.5), (2, 'q"q\n\nz', None), (None, "", -0.25), (4, None, 1e-9), (5, "é", 3.0)]
    spark.createDataFrame(data, schema).repartition(3).write.format("zipped_csv").mode("overwrite").save(path)
    assert rows(spark.read.format("zipped_csv").schema(schema).load(path)) == sorted(data, key=repr)
    spark.createDataFrame(data[:1], schema).coalesce(1).write.format("zipped_csv").mode("overwrite").save(path)
    assert rows(spark.read.format("zipped_csv").schema(schema).load(path)) == data[:1]
    assert not list((tmp_path / "out").glob("*.tmp"))


@pytest.fixture
def drifting(tmp_path):
    folder = tmp_path / "air"
    folder.mkdir()
    rng = random.Random(3)
    want = []
    for k in range(6):
        stations = [f"S{j}" for j in range(5) if (j + k) % 3]
        lines = ["﻿Date,Hour (UTC)," + ",".join(stations)] if k else ["Date,Hour (UTC)," + ",".join(stations)]
        for n in range(rng.randrange(40) + 1):
            values = [rng.choice([None, round(rng.random(), 3)]) for _ in stations]
            lines.append(f"2024-01-0{k + 1},{n}," + ",".join("" if v is None else str(v) for v in values))
            want.append((f"2024-01-0{k + 1}", n, *(dict(zip(stations, values)).get(f"S{j}") for j in range(5)), f"f{k}.csv"))
        end = "\r\n" if k % 2 else "\n"
        (folder / f"f{k}.csv").write_text(end.join(lines) + (end if k % 3 else ""), newline="")
    (folder / "readme.txt").write_text("x")
    return folder, want


@pytest.mark.parametrize("size", [7, 64, 10**6])
def test_drifting_files_in_ranges(spark, drifting, size):
    folder, want = drifting
    read = spark.read.format("drifting_csv").option("ids", "Date|Hour (UTC)").option("range", size).load(str(folder))
    assert read.columns == ["Date", "Hour (UTC)", "S0", "S1", "S2", "S3", "S4", FILE_NAME]
    got = rows(read.select(F.col("Date"), F.col("Hour (UTC)").cast("int"), "S0", "S1", "S2", "S3", "S4", F.substring_index(FILE_NAME, "/", -1)))
    assert got == sorted(want, key=repr)
    if size == 10**6:
        assert read.rdd.getNumPartitions() == 6
        assert read.where(F.col(FILE_NAME).endswith("f2.csv")).rdd.getNumPartitions() == 1
    long = spark.read.format("drifting_csv_long").option("ids", "Date|Hour (UTC)").option("range", size).load(str(folder))
    assert long.count() == sum(v is not None for r in want for v in r[2:7])
    assert rows(long.groupBy("station").agg(F.round(F.sum("value"), 6).alias("s"))) == sorted(
        (f"S{j}", round(sum(r[2 + j] or 0 for r in want), 6)) for j in range(5)
    )


def test_drifting_equals_the_reader_by_lines(spark, drifting):
    folder, _ = drifting
    schema = schemas.table(*((f.name, f.dataType) for f in schemas.AIR_WIDE_IDS.fields), *((f"S{j}", schemas.NUMBER) for j in range(5)))
    read = spark.read.format("drifting_csv").schema(schema).option("ids", "Date|Hour (UTC)").load(str(folder))
    other = files.read_drifting(spark, str(folder), schemas.AIR_WIDE_IDS).select(*schema.names)
    assert rows(read) == rows(other)


def test_drifting_faults_stop_the_job(spark, tmp_path):
    for name, text in (("few", "Date,Hour (UTC),S\n2024-01-01,1\n"), ("bad", "Date,Hour (UTC),S\n2024-01-01,1,x\n"), ("ids", "Date,S\n1,2\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(text)
        with pytest.raises(Exception):
            spark.read.format("drifting_csv").option("ids", "Date|Hour (UTC)").load(str(tmp_path / name)).collect()
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.csv").write_text("Date,Hour (UTC),S\n")
    assert spark.read.format("drifting_csv").option("ids", "Date|Hour (UTC)").load(str(tmp_path / "empty")).count() == 0


@pytest.fixture
def faulty(tmp_path):
    folder = tmp_path / "faulty"
    folder.mkdir()
    (folder / "a.csv").write_text('﻿id,"when",x\n1,u,1.5\n2,v\n3,"a, ""b""",\nfour,w,1\n\n5,y,2,3\n6,z,bad\n')
    (folder / "b.csv").write_text("when,id,x\n7,8,9\nx,1,2\n")
    (folder / "c.csv").write_text("id,when,x\n10,ok,0\n")
    (folder / "d.txt").write_text("not read")
    return folder


SCHEMA = schemas.table(("id", schemas.WHOLE), ("when", schemas.TEXT), ("x", schemas.NUMBER))
ANY = quarantine.ErrorBudget(1.0, 1.0)


def test_faulty_lines_are_set_aside(spark, faulty, tmp_path):
    got = quarantine.scan(spark, str(faulty), SCHEMA, str(tmp_path / "out"), ANY, pattern="*.csv")
    name = F.substring_index(FILE_NAME, "/", -1)
    assert rows(got.good.select("id", "when", "x", name)) == sorted(
        [(1, "u", 1.5, "a.csv"), (3, 'a, "b"', None, "a.csv"), (10, "ok", 0.0, "c.csv")], key=repr
    )
    assert rows(got.bad.select(name, "reason", "line")) == sorted(
        [
            ("a.csv", "cells", "2,v"), ("a.csv", "type", "four,w,1"), ("a.csv", "cells", "5,y,2,3"), ("a.csv", "type", "6,z,bad"),
            ("b.csv", "header", "when,id,x"), ("b.csv", "header", "7,8,9"), ("b.csv", "header", "x,1,2"),
        ],
        key=repr,
    )
    assert rows(got.by_file.select(name, "n_lines", "n_bad")) == [("a.csv", 6, 4), ("b.csv", 3, 3), ("c.csv", 1, 0)]


def test_the_budget(spark, faulty, tmp_path):
    with pytest.raises(quarantine.BudgetExceeded, match=r"7 of 10 lines .* b.csv \(3 of 3\), a.csv \(4 of 6\)"):
        quarantine.scan(spark, str(faulty), SCHEMA, str(tmp_path / "x"), pattern="*.csv")
    with pytest.raises(quarantine.BudgetExceeded):
        quarantine.scan(spark, str(faulty), SCHEMA, str(tmp_path / "y"), quarantine.ErrorBudget(1.0, 0.9), pattern="*.csv")
    none = tmp_path / "none"
    none.mkdir()
    (none / "a.csv").write_text("id,when,x\n")
    got = quarantine.scan(spark, str(none), SCHEMA, str(tmp_path / "z"))
    assert got.good.count() == got.bad.count() == 0


def test_the_files_are_read_once(spark, faulty, tmp_path):
    got = quarantine.scan(spark, str(faulty), SCHEMA, str(tmp_path / "out"), ANY, pattern="*.csv")
    for df in (got.good, got.bad, got.by_file):
        assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()
