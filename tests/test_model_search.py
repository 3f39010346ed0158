"""The model search against plain Python and numpy."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geotally.operators import forecast as fc
from geotally.operators import model_search as ms
from tests.test_forecast import AS_OF, SERIES, table

SMALL = ms.SearchSettings(grid={"linear": ({"regParam": 0.01}, {"regParam": 10.0}), "forest": ({"maxDepth": 3, "numTrees": 4},)})


def plain(spark, df):
    return [(r["objectid"], r["count_date"], r["volume"]) for r in df.collect()]


def noisy(place, day):
    return 500.0 * place + 3.0 * day + (place * 7 + day * 13) % 11


def brute_folds(rows, percents):
    days = sorted({d for _, d, _ in rows})
    met, ends, wanted = 0, [], list(percents)
    for day in days:
        met += sum(d == day for _, d, _ in rows)
        while wanted and 100 * met >= wanted[0] * len(rows):
            ends.append(day)
            wanted.pop(0)
    return sorted(set(ends))


def test_folds_follow_each_other(spark):
    df = table(spark, 410, 8)
    rows = plain(spark, df)
    ends = brute_folds(rows, ms.SearchSettings().percents())
    got = {r["fold"]: r for r in ms.folds(df, SERIES).collect()}
    assert sorted(got) == [1, 2, 3]
    for k in (1, 2, 3):
        test = [d for _, d, _ in rows if ends[k - 1] < d <= ends[k]]
        train = [d for _, d, _ in rows if d <= ends[k - 1]]
        r = got[k]
        assert (r["n_train"], r["n_test"]) == (len(train), len(test))
        assert (r["train_last"], r["test_first"], r["test_last"]) == (max(train), min(test), max(test))
        assert r["train_last"] < r["test_first"]


def test_trend_errors_equal_least_squares(spark):
    rng = random.Random(1)
    df = table(spark, 300, 7, lambda place, day: 100.0 * place + day * (place - 3) + rng.random() * 40)
    # A location that is there on the last days only, and one with a single date.
    more = spark.createDataFrame(
        [(90, "x", 1.0, dt.date(2020, 1, 1) + dt.timedelta(days=40), 5.0), (91, "x", 1.0, dt.date(2020, 1, 1), 77.0),
         (91, "x", 1.0, dt.date(2020, 1, 1) + dt.timedelta(days=41), 70.0)], df.schema)
    df = df.union(more).cache()
    rows = plain(spark, df)
    ends = brute_folds(rows, ms.SearchSettings().percents())
    for r in ms.trend_errors(df, SERIES).collect():
        k = r["fold"]
        train = [x for x in rows if x[1] <= ends[k - 1]]
        wrong = []
        for place, day, y in (x for x in rows if ends[k - 1] < x[1] <= ends[k]):
            own = [((d - dt.date(2020, 1, 1)).days, v) for p, d, v in train if p == place]
            if len({d for d, _ in own}) > 1:
                slope, base = np.polyfit([d for d, _ in own], [v for _, v in own], 1)
                guess = base + slope * (day - dt.date(2020, 1, 1)).days
            else:
                guess = own[0][1] if own else sum(x[2] for x in train) / len(train)
            wrong.append(guess - y)
        assert r["n_test"] == len(wrong)
        assert r["rmse"] == pytest.approx(math.sqrt(sum(e * e for e in wrong) / len(wrong)))
        assert r["mae"] == pytest.approx(sum(map(abs, wrong)) / len(wrong))
    df.unpersist()


def test_weights_are_the_best_of_all_mixtures():
    rng = np.random.default_rng(2)
    for _ in range(20):
        e = rng.normal(size=(50, 4)) * [1, 1, 2, 5] + rng.normal(size=4)
        sums = e.T @ e
        w = ms.stack_weights(sums)
        assert (w >= 0).all() and w.sum() == pytest.approx(1)
        slope = sums @ w
        least = w @ sums @ w
        assert (slope > least - 1e-6).all() and np.allclose(slope[w > 1e-9], least)
    assert ms.stack_weights(np.zeros((4, 4))).tolist() == [0.25] * 4


def test_a_row_for_each_candidate_and_fold(spark):
    df = table(spark, 240, 6, noisy)
    board = ms.leaderboard(df, SERIES, SMALL).collect()
    names = {(r["model"], r["params"]) for r in board}
    assert names == {("trend", ""), ("linear", "regParam=0.01"), ("linear", "regParam=10"), ("forest", "maxDepth=3, numTrees=4"), ("stack", "")}
    assert len(board) == 5 * 3
    trend = {r["fold"]: r for r in board if r["model"] == "trend"}
    for r in ms.trend_errors(df, SERIES).collect():
        assert trend[r["fold"]]["rmse"] == pytest.approx(r["rmse"], abs=1e-3)
        assert trend[r["fold"]]["mae"] == pytest.approx(r["mae"])
    weights = {(r["model"], r["params"]): r["weight"] for r in board if r["model"] != "stack"}
    assert min(weights.values()) >= 0 and sum(weights.values()) == pytest.approx(1)
    assert {r["rank"] for r in board} == {1, 2, 3, 4, 5}


def test_two_searches_choose_the_same_leader(spark):
    df = table(spark, 240, 6, noisy)
    one, two = ms.search(df, SERIES, SMALL), ms.search(df.repartition(3), SERIES, SMALL)
    assert one.leader == two.leader
    assert np.allclose(one.scores(), two.scores(), rtol=1e-6, atol=1e-3)


def test_later_rows_do_not_change_earlier_folds(spark):
    df = table(spark, 240, 6, noisy)
    last = brute_folds(plain(spark, df), SMALL.percents())[-2]
    changed = df.withColumn("volume", F.when(F.col("count_date") > F.lit(last), F.col("volume") * 50).otherwise(F.col("volume")))
    one, two = ms.search(df, SERIES, SMALL).errors(), ms.search(changed, SERIES, SMALL).errors()
    # Category folds hash the label's whole part, so only rows of the last fold move.
    assert np.allclose(one[:2], two[:2], rtol=1e-6, atol=1e-3)
    assert not np.allclose(one[2], two[2])


def test_forecast_by_the_leader(spark):
    settings = fc.ForecastSettings(horizon=4, frequency="Daily")
    got = ms.forecast_by_search(table(spark, 240, 6), SERIES, "predicted", AS_OF, settings, SMALL)
    assert got.columns == ["objectid", "main", "latitude", "future_date", "predicted", "last_inserted"]
    rows = got.collect()
    assert len({(r["objectid"], r["future_date"]) for r in rows}) == len(rows) == 6 * 4
    for r in rows:
        truth = 1000 * r["objectid"] + 2 * (r["future_date"] - dt.date(2020, 1, 1)).days
        assert abs(r["predicted"] - truth) < 0.05 * truth + 50


def test_what_cannot_be_searched(spark):
    one_day = table(spark).withColumn("count_date", F.lit("2020-01-01").cast("date"))
    with pytest.raises(ValueError, match="one date"):
        ms.search(one_day, SERIES, SMALL)
    with pytest.raises(ValueError, match="no complete rows"):
        ms.folds(table(spark).withColumn("volume", F.lit(None).cast("double")), SERIES)
    with pytest.raises(ValueError, match="models are"):
        ms.SearchSettings(grid={"deep": ({},)})


def test_fits_run_side_by_side_and_keep_their_order(spark):
    import threading

    all_here = threading.Barrier(ms.FITS_AT_ONCE)

    class Fake:
        def __init__(self, name):
            self.name = name

        def fit(self, train):
            all_here.wait(20)  # breaks unless so many fits run at once
            return self.name

    names = [*range(2 * ms.FITS_AT_ONCE)]
    assert ms._fits([Fake(n) for n in names], spark.range(1)) == names
