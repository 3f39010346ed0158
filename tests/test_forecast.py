"""Forecast parts against plain Python on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from geotally.operators import forecast as fc

SERIES = fc.Series("objectid", "count_date", "volume", ("objectid", "main"), ("latitude",))
AS_OF = dt.datetime(2024, 7, 1, 12)


def table(spark, n=400, locations=8, label=None):
    start = dt.date(2020, 1, 1)
    label = label or (lambda place, day: 1000.0 * place + 2.0 * day)
    data = [
        (i % locations, f"Main {i % 2}", 43.0 + (i % locations) / 100, start + dt.timedelta(days=i // locations),
         label(i % locations, i // locations))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "objectid int, main string, latitude double, count_date date, volume double")


def sides(rows):
    split = fc.with_split(rows, SERIES)
    return split.where("_older"), split.where("NOT _older")


def test_category_means_leave_their_own_fold_out(spark):
    rows = fc._training_rows(table(spark, 60, 4), SERIES)
    plain = [r.asDict() for r in rows.collect()]
    prior = sum(r["volume"] for r in plain) / len(plain)

    def mean(values):
        return (sum(values) + fc.SMOOTHING * prior) / (len(values) + fc.SMOOTHING)

    means = fc.category_means(fc.category_cells(rows, SERIES), SERIES)
    for r in fc.encode_categories(rows, means).collect():
        others = [p["volume"] for p in plain if p["objectid"] == r["objectid"] and p["_fold"] != r["_fold"]]
        assert r["objectid_mean"] == pytest.approx(mean(others))
    for r in fc.encode_categories(rows.drop("_fold"), means).collect():
        assert r["main_mean"] == pytest.approx(mean([p["volume"] for p in plain if p["main"] == r["main"]]))
    new = spark.createDataFrame([(99, None)], "objectid int, main string")
    unseen = fc.encode_categories(new, means).first()
    assert unseen["objectid_mean"] == unseen["main_mean"] == pytest.approx(prior)
    assert fc.encode_categories(rows, means).count() == 60


def test_newest_dates_are_held_out(spark):
    rows = fc._training_rows(table(spark), SERIES)
    older, newest = sides(rows)
    assert older.count() + newest.count() == 400
    assert older.agg(F.max("count_date")).first()[0] < newest.agg(F.min("count_date")).first()[0]
    assert 0.1 < newest.count() / 400 < 0.3
    same_day = fc._training_rows(table(spark).withColumn("count_date", F.lit("2020-01-01").cast("date")), SERIES)
    older, newest = sides(same_day)
    assert older.count() + newest.count() == 400 and newest.count() > 0
    mostly_last = fc._training_rows(
        table(spark).withColumn("count_date", F.when(F.col("volume") > 100, F.lit("2021-01-01")).otherwise("2020-01-01").cast("date")),
        SERIES,
    )
    older, newest = sides(mostly_last)
    assert older.count() > 0 and newest.count() > 0


def test_a_trend_is_carried_forward(spark):
    settings = fc.ForecastSettings(horizon=5, frequency="Daily")
    result = fc.forecast_volume(table(spark), SERIES, "predicted", AS_OF, settings)
    assert result.columns == ["objectid", "main", "latitude", "future_date", "predicted", "last_inserted"]
    rows = result.collect()
    assert len(rows) == 8 * 5
    assert len({(r["objectid"], r["future_date"]) for r in rows}) == 40
    start = dt.date(2020, 1, 1)
    for r in rows:
        truth = 1000 * r["objectid"] + 2 * (r["future_date"] - start).days
        assert abs(r["predicted"] - truth) < 0.25 * truth + 300
        assert r["last_inserted"] == dt.datetime(2024, 7, 1, 7)


def test_leaderboard(spark):
    board = fc.forecast_leaderboard(table(spark), SERIES).collect()
    assert [r["rank"] for r in board] == [1, 2, 3]
    assert {r["model"] for r in board} == {"linear", "forest", "boosted"}
    assert [r["rmse"] for r in board] == sorted(r["rmse"] for r in board)
    # Trees cannot go beyond the last date, so the trend is the linear model's.
    assert board[0]["model"] == "linear"


def test_two_searches_give_the_same_leader(spark):
    boards = [fc.forecast_leaderboard(table(spark, 120, 4), SERIES).collect() for _ in range(2)]
    assert len(boards[0]) == 3 and [r["model"] for r in boards[0]] == [r["model"] for r in boards[1]]


def test_small_categories_are_broadcast_and_locations_are_not_assumed_small(spark, monkeypatch):
    monkeypatch.setattr(fc, "BROADCAST_VALUES", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = fc._training_rows(table(spark), SERIES)
        encoded = fc.encode_categories(rows, fc.category_means(fc.category_cells(rows, SERIES), SERIES))
        plan = encoded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") == 1 and plan.count("SortMergeJoin") == 1
    assert "hashpartitioning(main" not in plan


def test_nothing_to_learn_from(spark):
    with pytest.raises(ValueError):
        fc.forecast_leaderboard(table(spark).withColumn("volume", F.lit(None).cast("double")), SERIES)
