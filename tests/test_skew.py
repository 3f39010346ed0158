"""Hot keys and copies: results stay whole, and no task or list gets a whole hot group."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from geotally.operators import aggregate, dedupe, enrich, layers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows is one day, half of those one single point."""
    day = F.when(F.col("id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.concat(F.lit("2024-02-0"), F.col("id") % 7 + 1))
    same = F.col("id") % 6 == 0
    return spark.range(6000).select(
        day.cast("date").alias("d"),
        F.when(same, 1.0).otherwise(F.col("id") / 7).alias("latitude"),
        F.when(same, 2.0).otherwise(F.col("id") / 11).alias("longitude"),
        F.when(same, 3.0).otherwise(F.col("id") % 5).alias("w"),
    )


def test_frames_have_one_shape_and_every_point(skewed):
    frames = layers.daily_frames(skewed, "d", "w")
    got = Counter({(r["frame_date"], r["lat"], r["lon"], r["weight"]): r["copies"] for r in frames.collect()})
    assert got == Counter((r["d"], r["latitude"], r["longitude"], float(r["w"])) for r in skewed.collect())
    final = plan(frames).split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") == 1 and "partial_count" in final
    dates = [r["frame_date"] for r in layers.in_date_order(frames).collect()]
    assert dates == sorted(dates)


def test_incomplete_points_are_left_out(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 1.0, 2.0, 3.0), (dt.date(2024, 1, 1), None, 2.0, 3.0), (None, 1.0, 2.0, 3.0)],
        "d date, latitude double, longitude double, w double",
    )
    assert [r["copies"] for r in layers.daily_frames(df, "d", "w").collect()] == [1]


def test_newest_row_cuts_groups_before_the_exchange(skewed):
    shown = plan(dedupe.latest_per_key(skewed, ["d"], ["w"], ["latitude", "longitude"]))
    before, after = shown.split("Exchange hashpartitioning", 1)
    assert "Partial" in after and "WindowGroupLimit" in after
    assert "Final" in before and "WindowGroupLimit" in before


def test_phase_means_take_one_scan_and_one_exchange(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 24).alias("h"), F.rand(1).alias("v"), F.lit("x").alias("other")).write.parquet(
        str(tmp_path / "t")
    )
    shown = plan(aggregate.phase_avg_wide(spark.read.parquet(str(tmp_path / "t")), ["id"], "h", "v"))
    assert shown.count("FileScan") == 1 and shown.count("Exchange hashpartitioning") == 1
    assert "other" not in shown


def test_join_without_broadcast_gives_the_same(spark):
    fact = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id"
    )
    dim = spark.range(50).select(F.concat(F.lit("K"), "id").alias("name"), F.col("id").alias("n")).union(
        spark.createDataFrame([("HOT", -1)], "name string, n bigint")
    )
    results = []
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, salts in ((limit, 1), ("-1", 1), ("-1", 16)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            joined = enrich.join_ignoring_case(fact, dim, "k", "name", salts, ["id"])
            assert ("BroadcastHashJoin" in plan(joined)) == (threshold != "-1")
            results.append(sorted(map(tuple, joined.collect())))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(results[0]) == 5000
    assert results[0] == results[1] == results[2]


def test_hot_join_key_is_split_without_salts(spark):
    """The settings of the library alone: a shuffled join reads the hot partition in several tasks."""
    fact = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"), "id"
    )
    dim = spark.range(5000).select(F.concat(F.lit("K"), "id").alias("name")).union(spark.createDataFrame([("HOT",)], "name string"))
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        joined = enrich.join_ignoring_case(fact, dim, "k", "name")
        assert len(joined.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_newest_rows_match_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice([None, 1, 2]), rng.choice([None, "a", "b"]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, o int, t string, i int").repartition(5)
    got = {r["k"]: tuple(r) for r in dedupe.latest_per_key(df, ["k"], ["o"], ["t", "i"]).collect()}

    def rank(row):
        return tuple((value is None, value) if value is not None else (True, 0) for value in row[1:])

    want = {}
    for row in data:
        if row[0] not in want or rank(row) > rank(want[row[0]]):
            want[row[0]] = row
    assert got == want


def test_salts_spread_a_hot_key(spark):
    fact = spark.range(8000).select(F.lit("hot").alias("k"), "id")
    salt = F.pmod(F.xxhash64("id"), F.lit(16))
    assert fact.groupBy(salt).count().where("count > 1000").count() == 0


def test_mean_of_whole_table_needs_no_join(spark):
    shown = plan(layers.classify_vs_mean(spark.range(10).withColumn("v", F.col("id") * 1.0), "v"))
    assert "Subquery" in shown or "subquery" in shown
    assert "NestedLoop" not in shown and "Cartesian" not in shown
