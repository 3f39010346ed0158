"""Readers, writers and incremental staging on small landed files."""

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from geotally import schemas
from geotally.operators import geo, layers
from geotally.session import shared_folder
from geotally.sinks import tables as sink
from geotally.sources import files, staging
from geotally.sources.tables import catalog_tables
from geotally.streaming.landing import append_landed_files

AS_OF = dt.datetime(2024, 7, 1, 12)
FORECAST_HEADER = "cgndb code,community name,validity date,validity time (UTC),period,value,amended?\n"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def air(tmp_path):
    folder = tmp_path / "air"
    folder.mkdir()
    (folder / "jan.csv").write_text("Date,Hour (UTC),FAAAA,FBBBB\n2024-01-01,0,1.5,\n2024-01-01,1,2.5,3\n")
    (folder / "feb.csv").write_text("Date,Hour (UTC),FBBBB,FCCCC\n2024-02-01,0,4,5\n")
    (folder / "mar.csv").write_text("Date,Hour (UTC),FAAAA,FBBBB\n2024-03-01,0,6,7\n")
    (folder / "readme.txt").write_text("not a table")
    return folder


def test_files_with_different_stations_become_one_frame(spark, air):
    staged = staging.stage_air_wide(spark, str(air), AS_OF, "http://air/")
    assert set(staged.columns) == {
        "the_date", "hours_utc", "FAAAA", "FBBBB", "FCCCC", "src_filename", "last_updated", "download_link"
    }
    got = rows(staged.select("the_date", "hours_utc", "FAAAA", "FBBBB", "FCCCC", "download_link"))
    assert got == sorted(
        [
            (dt.date(2024, 1, 1), 0, 1.5, None, None, "http://air/jan.csv"),
            (dt.date(2024, 1, 1), 1, 2.5, 3.0, None, "http://air/jan.csv"),
            (dt.date(2024, 2, 1), 0, None, 4.0, 5.0, "http://air/feb.csv"),
            (dt.date(2024, 3, 1), 0, 6.0, 7.0, None, "http://air/mar.csv"),
        ],
        key=repr,
    )
    plan = staged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2  # the rows and the headers, however many files there are


def test_many_files_with_own_headers(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(60):
        (folder / f"f{k:02}.csv").write_text(f'\ufeffDate,"Hour (UTC)",S{k % 7},T{k}\r\n2024-01-01,{k % 24},"{k}",\r\n')
    wide = files.read_drifting(spark, str(folder), schemas.AIR_WIDE_IDS)
    assert wide.count() == 60 and len(wide.columns) == 2 + 7 + 60 + 1
    assert wide._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    long = files.read_drifting_long(spark, str(folder), schemas.AIR_WIDE_IDS)
    assert rows(long.select("Hour (UTC)", "station", "value")) == rows(
        spark.createDataFrame([(k % 24, f"S{k % 7}", float(k)) for k in range(60)], "h int, s string, v double")
    )


def test_rows_that_do_not_fit_their_header_stop_the_job(spark, tmp_path):
    for name, text in (("few", "Date,Hour (UTC),S\n2024-01-01,1\n"), ("none", "2024-01-01,1,2\n"), ("bad", "Date,Hour (UTC),S\n2024-01-01,1,x\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(text)
        with pytest.raises(Exception):
            files.read_drifting_long(spark, str(tmp_path / name), schemas.AIR_WIDE_IDS).collect()


def test_no_files(spark, tmp_path):
    with pytest.raises(Exception):
        staging.stage_air_wide(spark, str(tmp_path / "nothing"), AS_OF)


def test_list_files_reads_no_content(spark, air):
    listed = files.list_files(spark, str(air), "*.csv")
    assert sorted(p.path.rsplit("/", 1)[1] for p in listed.collect()) == ["feb.csv", "jan.csv", "mar.csv"]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_separator_quotes_and_wrong_headers(spark, tmp_path):
    schema = schemas.table(("a", schemas.WHOLE), ("b", schemas.TEXT))
    (tmp_path / "x.txt").write_text('a;b\n1;"say ""hi""; there"\n')
    assert rows(files.read_delimited(spark, str(tmp_path / "x.txt"), schema, sep=";").select("a", "b")) == [
        (1, 'say "hi"; there')
    ]
    (tmp_path / "m.csv").write_text('a,b\n1,"two\nlines"\n')
    assert rows(files.read_delimited(spark, str(tmp_path / "m.csv"), schema, multiline=True).select("b")) == [("two\nlines",)]
    (tmp_path / "y.csv").write_text("b,a\nq,1\n")
    with pytest.raises(Exception):
        files.read_delimited(spark, str(tmp_path / "y.csv"), schema).collect()
    (tmp_path / "z.csv").write_text("a,b\nnot a number,1\n")
    with pytest.raises(Exception):
        files.read_delimited(spark, str(tmp_path / "z.csv"), schema).collect()


@pytest.fixture
def zipped(tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    for name, text in (("one", '1,"a, ""b""\nc"\n2,d\n'), ("two", "3,\n")):
        with zipfile.ZipFile(folder / f"{name}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.txt", "x")
            z.writestr(f"{name}.csv", "﻿id,text\n" + text)
    return folder


def test_zipped_rows(spark, zipped):
    schema = schemas.table(("id", schemas.WHOLE), ("text", schemas.TEXT))
    got = rows(files.read_zipped_csv(spark, str(zipped), schema).select("id", "text"))
    assert got == [(1, 'a, "b"\nc'), (2, "d"), (3, None)]
    archives = spark.read.format("binaryFile").load(str(zipped))
    assert rows(files.unzip_csv(archives, schema).select("id", "text")) == got
    name = files.read_zipped_csv(spark, str(zipped), schema).where("id = 3").first()[files.FILE_NAME]
    assert name.endswith("two.zip!two.csv")
    with pytest.raises(Exception):
        files.read_zipped_csv(spark, str(zipped), schemas.table(("other", schemas.TEXT))).collect()


def test_a_plain_write_moves_no_rows(spark, air, tmp_path):
    from geotally.sources.files import read_delimited

    schema = schemas.table(("a", schemas.WHOLE), ("b", schemas.TEXT))
    (tmp_path / "n.csv").write_text("a,b\n1,x\n")
    staged = read_delimited(spark, str(tmp_path / "n.csv"), schema)
    assert "Exchange" not in staged._jdf.queryExecution().executedPlan().toString()
    written = sink.replace_table(staged.drop("src_filename"), "demo.plain", str(tmp_path / "plain"))
    assert rows(written) == [(1, "x")]


def test_links_with_quoted_brackets_and_references(spark):
    from geotally.sources.links import extract_links

    html = """<a title="a>b" href="x.csv"> <a href='p&#46;csv?a=1&amp;b=2'> <a href=q&#x2E;csv> <a href="r&amp;#46;csv">"""
    pages = spark.createDataFrame([(1, "u/", html)], "page_id int, url string, html string")
    assert [r.href for r in extract_links(pages).collect()] == ["x.csv", "p.csv?a=1&b=2", "q.csv"]
    assert [r.href for r in extract_links(pages, containing="r").collect()] == ["r&#46;csv"]


def test_replace_table_keeps_readers_served(spark, tmp_path):
    root = str(tmp_path / "tables")
    first = sink.replace_table(spark.range(3), "demo.t", root)
    assert first.count() == 3
    reader = spark.table("demo.t")
    # The new content is made from the old one, and the reader opened before still finds its files.
    second = sink.replace_table(spark.table("demo.t").withColumn("twice", F.col("id") * 2), "demo.t", root)
    assert rows(second) == [(0, 0), (1, 2), (2, 4)]
    assert reader.count() == 3
    third = sink.replace_table(spark.range(1).withColumn("p", F.lit(7)), "demo.t", root, ["p"])
    assert rows(third) == [(0, 7)]
    assert sorted(p.name for p in (tmp_path / "tables" / "demo" / "t").iterdir()) == ["a", "b"]

    with pytest.raises(Exception):
        sink.replace_table(spark.range(5).select(F.raise_error(F.lit("no")).alias("x")), "demo.t", root)
    assert rows(spark.table("demo.t")) == [(0, 7)]


def test_a_file_is_appended_once(spark, tmp_path):
    path = str(tmp_path / "log")
    part = spark.createDataFrame([("f1", 1), ("f1", 1), ("f2", 2)], "src_filename string, v int")
    sink.append_new_files(part, path)
    sink.append_new_files(part.union(spark.createDataFrame([("f3", 3)], part.schema)), path)
    assert rows(spark.read.parquet(path)) == [("f1", 1), ("f1", 1), ("f2", 2), ("f3", 3)]


def test_csv_export_and_catalogue(spark, tmp_path):
    root = str(tmp_path / "tables")
    point = geo.add_point(spark.createDataFrame([(1.0, 2.0, 'a "b", c')], "longitude double, latitude double, n string"))
    sink.replace_table(point, "shop.places", root)
    sink.replace_table(spark.range(2), "shop.my_forecast", root)
    sink.replace_table(spark.range(2), "shop.spatial_ref_sys", root)
    names = catalog_tables(spark, "shop", ["%forecast%"], ["spatial_ref_sys"])
    assert rows(names) == [("places",)]
    sink.export_tables(spark, "shop", ["places"], str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out" / "places"))
    assert back.columns == ["longitude", "latitude", "n", "geom"]
    got = back.first()
    assert got["n"] == 'a "b", c' and json.loads(got["geom"]) == {"x": 1.0, "y": 2.0, "srid": 4326}


def test_geojson_lines(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, "a", None)], "longitude double, latitude double, n string, m string")
    sink.write_features(layers.geojson_features(df, ["n", "m"]), str(tmp_path / "g"))
    line = spark.read.text(str(tmp_path / "g")).first()[0]
    assert json.loads(line) == {
        "type": "Feature",
        "geometry": {"type": "Point", "coordinates": [1.0, 2.0]},
        "properties": {"n": "a", "m": None},
    }


def test_landed_files_are_staged_once(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "staged")
    landing.mkdir()

    def run():
        append_landed_files(
            spark, str(landing), schemas.FORECASTS, lambda raw: staging.conform_forecasts(raw, AS_OF, "http://f/"),
            target, f"forecasts-{tmp_path.name}",
        )

    (landing / "a.csv").write_text(FORECAST_HEADER + "FAAAA,Town,2024-05-01,17:00:00,1,3,0\n")
    run()
    run()
    (landing / "b.csv").write_text(FORECAST_HEADER + "FBBBB,City,2024-05-02,18:00:00,2,4,0\n")
    run()
    got = rows(spark.read.parquet(target).select("cgndb_code", "validity_date", "value", "download_link"))
    assert got == [
        ("FAAAA", dt.date(2024, 5, 1), 3, "http://f/a.csv"),
        ("FBBBB", dt.date(2024, 5, 2), 4, "http://f/b.csv"),
    ]


def test_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x", "y", fallback="/elsewhere") == f"{root}/x/y"
