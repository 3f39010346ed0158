"""One small fixture per rule of the published tables."""

import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from geotally import fixed_values as fixed
from geotally.functions import calendar as cal
from geotally.functions import numbers, text
from geotally.operators import aggregate, clean, dedupe, enrich, forecast, geo, layers, reshape, runlog
from geotally.sources import links, staging


def rows(df):
    return [tuple(r) for r in df.collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_row_without_date_is_newest(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), "a"), (1, None, "b")], "k int, d date, v string")
    assert rows(dedupe.latest_per_key(df, ["k"], ["d"], ["v"])) == [(1, None, "b")]


def test_tiebreak_is_required_and_decides(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b")], "k int, d int, v string")
    assert rows(dedupe.latest_per_key(df, ["k"], ["d"], ["v"])) == [(1, 5, "c")]
    assert rows(dedupe.latest_per_key(df, ["k"], ["d"], [F.col("v").asc()])) == [(1, 5, "a")]
    with pytest.raises(ValueError):
        dedupe.latest_per_key(df, ["k"], ["d"], [])


def test_station_or_hour_keys(spark):
    day, stamp = dt.date(2024, 5, 6), dt.datetime(2024, 5, 7)
    df = spark.createDataFrame(
        [(day, 3, s, 1.0, stamp) for s in ("A", "B", "C")],
        "the_date date, hours_utc bigint, cgndb_id string, air_quality_value double, last_updated timestamp_ntz",
    )
    assert dedupe.dedupe_readings(df).count() == 3
    assert [r[2] for r in rows(dedupe.dedupe_readings(df, dedupe.READING_KEYS_PER_HOUR))] == ["C"]


def test_names_are_padded_on_request(spark):
    monday = F.lit("2024-05-06").cast("date")
    assert one(spark, cal.weekday_name(monday)) == "Monday"
    assert one(spark, cal.weekday_name(monday, padded=True)) == "Monday   "
    assert one(spark, cal.month_name(monday, padded=True)) == "May      "


def test_means_round_half_to_even(spark):
    df = spark.createDataFrame(
        [("a", 2.0), ("a", 3.0), ("b", 3.0), ("b", 4.0), ("c", -2.0), ("c", -3.0)], "main string, v double"
    ).withColumn("d", F.lit("2024-05-06").cast("date"))
    got = {r["main"]: (r["weekday"], r["volume_avg"]) for r in aggregate.weekday_volume_avg(df, ["main"], "d", "v").collect()}
    assert got == {"a": ("Monday", 2), "b": ("Monday", 4), "c": ("Monday", -2)}


@pytest.mark.parametrize("value, shown", [(2.675, "2.68"), (0.125, "0.13"), (35.355, "35.36"), (-0.125, "-0.13")])
def test_decimal_means_round_half_away(spark, value, shown):
    df = spark.createDataFrame([(1, value), (1, None)], "k int, v double")
    assert df.groupBy("k").agg(numbers.mean_decimal("v").alias("m")).first()["m"] == Decimal(shown)


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(1, None)], "k int, v double")
    assert df.groupBy("k").agg(numbers.mean_decimal("v").alias("m")).first()["m"] is None


def test_mean_does_not_depend_on_row_order(spark):
    values = [72.43, 1e7, 72.42, -1e7, 0.1, 0.2, 0.3] * 40
    means = set()
    for parts in (1, 2, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        means.add(df.agg(numbers.mean_decimal("v").alias("m")).first()["m"])
    assert len(means) == 1


def test_seconds_field_and_elapsed(spark):
    early, late = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01 00:00:00", "2024-01-01 00:01:05.25"))
    assert one(spark, cal.seconds_field(late, early)) == 5.25
    assert one(spark, cal.seconds_field(early, late)) == -5.25
    assert one(spark, cal.elapsed_seconds(late, early)) == 65.25
    assert one(spark, cal.elapsed_seconds(early, late)) == -65.25


def test_insertion_stamp_has_no_daylight_saving(spark):
    assert one(spark, cal.est_stamp(dt.datetime(2024, 7, 1, 12))) == dt.datetime(2024, 7, 1, 7)
    aware = dt.datetime(2024, 7, 1, 8, tzinfo=dt.timezone(dt.timedelta(hours=-4)))
    assert one(spark, cal.est_stamp(aware)) == dt.datetime(2024, 7, 1, 7)


def test_stations_missing_a_bucket_disappear(spark):
    hours = {"A": (0, 6, 12, 18), "B": (0, 6, 12), "C": (0, 6, 12, 18)}
    data = [(s, h, None if (s, h) == ("C", 12) else float(h)) for s, hs in hours.items() for h in hs]
    df = spark.createDataFrame(data, "s string, h int, v double")
    got = sorted(rows(aggregate.phase_avg_wide(df, ["s"], "h", "v")))
    assert [r[0] for r in got] == ["A", "C"]
    assert got[0][1:] == (Decimal("0.00"), Decimal("6.00"), Decimal("12.00"), Decimal("18.00"))
    assert got[1][3] is None


def test_wide_means_equal_long_means(spark):
    df = spark.range(4000).select(
        (F.col("id") % 7).alias("s"), (F.col("id") % 24).alias("h"), (F.col("id") * 37 % 101 / 3).alias("v")
    )
    wide = {r["s"]: r.asDict() for r in aggregate.phase_avg_wide(df, ["s"], "h", "v").collect()}
    for first, last, _, name in fixed.DAY_PHASES:
        long = df.where(F.col("h").between(first, last)).groupBy("s").agg(numbers.mean_decimal("v").alias("m"))
        assert {r["s"]: r["m"] for r in long.collect()} == {s: r[name] for s, r in wide.items()}


def test_station_at_two_positions_is_found(spark):
    df = spark.createDataFrame(
        [("A", 1.0, 2.0), ("A", 1.0, 2.0), ("B", 1.0, 2.0), ("B", 1.0, 3.0)],
        "cgndb_id string, latitude double, longitude double",
    )
    assert [r[0] for r in rows(aggregate.stations_with_many_positions(df))] == ["B"]


def test_unpivot_drops_null_cells_and_rows_with_null_lineage(spark):
    df = spark.createDataFrame(
        [("d", 1, "l", "f", "u", 1.0, None), ("d", 2, "l", None, "u", 3.0, 4.0)],
        "the_date string, hours_utc int, download_link string, src_filename string, last_updated string, A double, B double",
    )
    assert rows(reshape.unpivot_stations(df).select("hours_utc", "cgndb_id", "air_quality_value")) == [(1, "A", 1.0)]


def test_classes_use_the_truncated_mean(spark):
    df = spark.createDataFrame([(11.0,), (10.0,), (9.0,), (13.6,), (None,)], "v double")
    assert df.agg(F.avg("v")).first()[0] == 10.9
    got = dict(rows(layers.classify_vs_mean(df, "v")))
    assert got == {11.0: "red", 10.0: "black", 9.0: "green", 13.6: "red", None: "black"}
    assert dict(rows(layers.classify_vs_mean(df, "v", truncate=False)))[10.0] == "green"


def test_forecast_starts_nine_years_on(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 2, 29), "a"), (1, dt.date(2023, 1, 1), "b"), (2, dt.date(2020, 1, 1), "c")],
        "objectid int, count_date date, main string",
    )
    grid = forecast.horizon_grid(df, "objectid", "count_date", ["main"], "Daily", 30)
    got = sorted(rows(grid))
    assert len(got) == 60
    assert got[0] == (1, "b", dt.date(2033, 2, 28)) and got[-1] == (2, "c", dt.date(2033, 3, 29))
    shared = forecast.horizon_grid(df, "objectid", "count_date", ["main"], "Daily", 1, table_wide=["main"])
    assert {r[1] for r in rows(shared)} == {"c"}
    own = forecast.horizon_grid(df, "objectid", "count_date", ["main"], "Daily", 1, start=dt.date(2030, 1, 5))
    assert {r[2] for r in rows(own)} == {dt.date(2030, 1, 5)}


def test_day_phases(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 23, None, 24]
    df = spark.createDataFrame([(h,) for h in hours], "h int").select(cal.day_phase("h"))
    labels = [label for _, _, label, _ in fixed.DAY_PHASES]
    assert [r[0] for r in rows(df)] == [x for x in labels for _ in (0, 1)] + ["Unknown", "Unknown"]


@pytest.mark.parametrize(
    "word, code, second",
    [
        ("Monthly", dt.date(2033, 3, 1), dt.date(2033, 4, 1)),
        ("Quarter", dt.date(2033, 4, 1), dt.date(2033, 7, 1)),
        ("Annually", dt.date(2034, 1, 1), dt.date(2035, 1, 1)),
        ("Daily", dt.date(2033, 2, 28), dt.date(2033, 3, 1)),
        ("hour", dt.datetime(2033, 2, 28), dt.datetime(2033, 2, 28, 1)),
    ],
)
def test_periods_begin_on_or_after_the_start(spark, word, code, second):
    series = cal.date_series(F.lit("2033-02-28").cast("date"), cal.parse_frequency(word)[0], 3)
    assert one(spark, series)[:2] == [code, second]


def test_period_start_is_kept(spark):
    series = cal.date_series(F.lit("2033-04-01").cast("date"), "QS", 2)
    assert one(spark, series) == [dt.date(2033, 4, 1), dt.date(2033, 7, 1)]


def test_unknown_frequency():
    with pytest.raises(ValueError):
        cal.parse_frequency("weekly")


def test_first_of_equal_columns_wins(spark):
    df = spark.createDataFrame([(3, 1, 1), (2, 2, 5), (None, 7, 8)], "a int, b int, c int")
    assert [r[-1] for r in rows(runlog.fastest_browser(df, ["a", "b", "c"]))] == ["b", "a", "b"]


def test_map_kind_from_file_name(spark):
    df = spark.createDataFrame([("Folium_City.html",), ("my_turf",), ("x",)], "map string")
    assert [r[1] for r in rows(runlog.add_map_kind(df, "map"))] == ["folium", "turf", "unknown"]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], "`Province - Territory` int, `CGNDB ID` int")
    assert clean.normalize_columns(df, {"province_-_territory": "province_territory"}).columns == [
        "province_territory",
        "cgndb_id",
    ]


def test_text_helpers(spark):
    assert one(spark, text.base_name(F.lit("/a/b/c.sql"))) == "c.sql"
    assert one(spark, text.first_token(F.lit("2024-01-01 10:00"))) == "2024-01-01"
    assert text.split_list("folium, turf") == ["folium", "turf"]
    assert one(spark, text.label_text(("A", F.lit(1)), ("B", F.lit(None)))) == "A: 1; B: "


@pytest.mark.parametrize(
    "written, day",
    [
        ("2024-05-06", (2024, 5, 6)),
        ("2015/03/02 00:00:00+00", (2015, 3, 2)),
        ("3/2/2015 12:00:00 AM", (2015, 3, 2)),
        (" 2024-05-06T10:00:00", (2024, 5, 6)),
        ("", None),
        (None, None),
    ],
)
def test_dates_in_any_form(spark, written, day):
    assert one(spark, cal.any_date(F.lit(written).cast("string"))) == (dt.date(*day) if day else None)


def test_typed_dates_and_no_dates(spark):
    assert one(spark, cal.any_date(F.lit("2024-05-06 23:59:59").cast("timestamp_ntz"))) == dt.date(2024, 5, 6)
    assert one(spark, cal.any_date(F.lit("2024-05-06").cast("date"))) == dt.date(2024, 5, 6)
    for wrong in ("soon", "13/13/2024"):
        with pytest.raises(Exception):
            one(spark, cal.any_date(F.lit(wrong)))


def test_date_of_millis(spark):
    assert one(spark, cal.date_of_millis(F.lit(1_704_067_199_999))) == dt.date(2023, 12, 31)
    assert one(spark, cal.date_of_millis(F.lit(1_704_067_200_000))) == dt.date(2024, 1, 1)
    assert one(spark, cal.date_of_millis(F.lit(-1))) == dt.date(1969, 12, 31)


def test_hour_of_time_text(spark):
    assert one(spark, cal.hour_of_text(F.lit("17:05:09"))) == 17
    assert one(spark, cal.hour_of_text(F.lit(None).cast("string"))) is None


def test_case_does_not_matter_in_the_join(spark):
    fact = spark.createDataFrame([("abc", 1), ("ABC", 2), ("zz", 3), (None, 4)], "k string, v int")
    dim = spark.createDataFrame([("Abc", "x"), (None, "y")], "id string, name string")
    for salts in (1, 4):
        joined = enrich.join_ignoring_case(fact, dim, "k", "id", salts)
        assert joined.columns == ["k", "v", "id", "name"]
        assert sorted(rows(joined)) == [("ABC", 2, "Abc", "x"), ("abc", 1, "Abc", "x")]


def test_links_of_real_markup(spark):
    html = (
        '<A HREF="a.csv?x=1&amp;y=2">1</A><!-- <a href="b.csv"> --><script>"<a href=c.csv>"</script>'
        "<a class='k' href='d.csv'>2</a><a data-href=\"e.csv\">3</a><a href=f.csv>4</a><a href=\"g.txt\">5</a><abbr href=\"h.csv\">"
    )
    pages = spark.createDataFrame([(1, "http://x/", html)], "page_id int, url string, html string")
    got = links.extract_links(pages).orderBy("link_no").select("link_no", "href", "download_link")
    assert rows(got) == [
        (1, "a.csv?x=1&y=2", "http://x/a.csv?x=1&y=2"),
        (2, "d.csv", "http://x/d.csv"),
        (3, "f.csv", "http://x/f.csv"),
    ]


def test_first_csv_resource(spark):
    catalog = spark.createDataFrame([(3, "b", "CSV"), (1, "a", "zip"), (2, "c", "csv")], "position int, name string, format string")
    assert rows(staging.first_csv_resource(catalog)) == [(2, "c", "csv")]


def test_point_hex(spark):
    p = geo.point(F.lit(1.0), F.lit(2.0), 26917)
    df = spark.createDataFrame([(0,)], "k int").select(p.alias("p"))
    assert one_hex(df) == "0101000020" + "25690000" + "000000000000F03F" + "0000000000000040"
    assert one_hex(df.select(F.lit(None).cast(df.schema["p"].dataType).alias("p"))) is None


def one_hex(df):
    return df.select(geo.ewkb_hex("p").alias("h")).first()["h"]


def snyder_utm17(lat, lon):
    """Transverse Mercator by the older power series, as a second opinion."""
    a, f, k0 = 6378137.0, 1 / 298.257222101, 0.9996
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, l = math.radians(lat), math.radians(lon + 81)
    n = a / math.sqrt(1 - e2 * math.sin(p) ** 2)
    t, c, x = math.tan(p) ** 2, ep2 * math.cos(p) ** 2, l * math.cos(p)
    m = a * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * p)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * p)
        - (35 * e2**3 / 3072) * math.sin(6 * p)
    )
    east = k0 * n * (x + (1 - t + c) * x**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * x**5 / 120) + 500000
    north = k0 * (
        m
        + n * math.tan(p) * (x**2 / 2 + (5 - t + 9 * c + 4 * c**2) * x**4 / 24
        + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * x**6 / 720)
    )
    return east, north


def test_utm(spark):
    places = [(43.6532, -79.3832), (43.0, -81.0), (0.0, -81.0), (44.2, -78.1), (43.7, -83.9)]
    df = spark.createDataFrame(places, "latitude double, longitude double")
    got = geo.add_point(df).select(geo.to_utm17("geom").alias("u")).collect()
    for (lat, lon), r in zip(places, got):
        east, north = snyder_utm17(lat, lon)
        assert abs(r["u"]["x"] - east) < 0.01 and abs(r["u"]["y"] - north) < 0.01
        assert r["u"]["srid"] == 26917
    assert got[1]["u"]["x"] == 500000.0 and abs(got[2]["u"]["y"]) < 1e-9


def test_run_log(spark):
    step = "step_name string, duration_seconds double, start_time timestamp_ntz, end_time timestamp_ntz, files_processed double"
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    production = spark.createDataFrame(
        [("/x/a.sql", 1.0, t0, t0, 1.0), ("/x/a.sql", 2.0, t1, t1, 1.0), ("create_production_tables", 9.0, t0, t1, 2.0)], step
    )
    stage = spark.createDataFrame([("load", 3.0, t0, t0, 1.0)], step)
    log = runlog.union_logs(production, stage)
    assert sorted(r[:3] for r in rows(log)) == [("production", "a.sql", 1.0), ("production", "a.sql", 2.0), ("stage", "load", 3.0)]
    latest = runlog.latest_steps(clean.union_by_name([log, runlog.placeholder_steps(spark)]))
    seconds = {r["step_name"]: r["duration_seconds"] for r in latest.collect()}
    assert seconds == {"a.sql": 2.0, "load": 3.0, **dict.fromkeys([n for n, _ in fixed.PLACEHOLDER_STEPS], -1.0)}
    done = spark.createDataFrame([("maps", "turf", 4.0, t0, t1, 9.0)], log.schema)
    again = runlog.latest_steps(clean.union_by_name([runlog.placeholder_steps(spark), done]))
    assert {r["step_name"]: r["duration_seconds"] for r in again.collect()}["turf"] == 4.0


def test_failed_steps_are_logged(spark):
    log = runlog.StepLog()
    with log.step("stage", "good", 3):
        pass
    with pytest.raises(ZeroDivisionError), log.step("stage", "bad", 3):
        1 / 0
    got = [(r["phase"], r["step_name"], r["files_processed"]) for r in log.frame(spark).collect()]
    assert got == [("stage", "good", 3.0), ("stage (failed)", "bad", 0.0)]


def test_later_file_wins_over_higher_value(spark):
    t0 = dt.datetime(2024, 1, 1)
    readings = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 5, "a", 9.0, "f1.csv", t0), (dt.date(2024, 1, 1), 5, "a", 2.0, "f2.csv", t0)],
        "the_date date, hours_utc int, cgndb_id string, air_quality_value double, src_filename string, last_updated timestamp_ntz",
    )
    assert [r["air_quality_value"] for r in dedupe.dedupe_readings(readings).collect()] == [2.0]


def test_forecasts_are_kept_by_time_text(spark):
    day, t0 = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)
    schema = "cgndb_code string, validity_date date, validity_time_utc string, period int, value bigint, amended int, download_link string, src_filename string, last_updated timestamp_ntz"
    staged = spark.createDataFrame(
        [
            ("a", day, "05:00:00", 1, 3, 0, "u", "f1.csv", t0),
            ("a", day, "05:30:00", 1, 4, 0, "u", "f1.csv", t0),
            ("b", day, "05:00:00", 1, 5, 0, "u", "f1.csv", t0),
            ("a", day, "05:00:00", 1, 1, 1, "u", "f1.csv", t0),
        ],
        schema,
    )
    assert sorted(r["value"] for r in enrich.newest_forecasts(staged).collect()) == [1, 4, 5]
    assert len(enrich.newest_forecasts(staged, dedupe.FORECAST_KEYS_PER_TIME).collect()) == 2
