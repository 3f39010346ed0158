"""Updates by key, refreshed months, kept means and measures of a step."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from geotally.operators import aggregate, kept_means, measures
from geotally.operators.dedupe import latest_per_key
from geotally.sinks import keyed
from geotally.sinks.keyed import KeyedTable, newest, refresh_parts

SCHEMA = "k int, name string, at int, v double"
NEWEST = newest(["k", "name"], ["at"], ["v"])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def loads(spark, seed=1, n=4):
    rng = random.Random(seed)
    return [
        spark.createDataFrame(
            [(rng.choice([None, *range(40)]), rng.choice(["a", "b", None]), rng.randrange(9), rng.random()) for _ in range(60)], SCHEMA
        )
        for _ in range(n)
    ]


def files_of(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet")}


def test_merged_equals_the_newest_of_all(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "name"], 8)
    assert table.read() is None
    parts = loads(spark)
    for k, part in enumerate(parts, 1):
        assert table.merge(part, NEWEST) == k
    union = parts[0]
    for part in parts[1:]:
        union = union.union(part)
    assert rows(table.read()) == rows(latest_per_key(union, ["k", "name"], ["at"], ["v"]))
    assert rows(table.read(1)) == rows(latest_per_key(parts[0], ["k", "name"], ["at"], ["v"]))


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    root = tmp_path / "t"
    table = KeyedTable(spark, str(root), ["k", "name"], 16)
    table.merge(spark.createDataFrame([(k, "a", 1, 1.0) for k in range(200)], SCHEMA), NEWEST)
    before, old = files_of(root), table.manifest()["folders"]
    assert len(old) == 16
    table.merge(spark.createDataFrame([(7, "a", 2, 5.0), (7, "a", 0, 6.0)], SCHEMA), NEWEST)
    new = table.manifest()["folders"]
    assert before <= files_of(root)
    assert sum(old[b] != new[b] for b in old) == 1
    assert rows(table.read().where("k = 7")) == [(7, "a", 2, 5.0)]
    assert table.read().count() == 200
    plan = table.read(buckets=[3])._jdf.inputFiles()
    assert all("_bucket=3/" in f for f in plan)
    table.forget(keep=1)
    assert table.versions() == [2] and table.read().count() == 200
    assert len(files_of(root)) == len(before)


def test_removed_keys_empty_updates_and_wrong_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k", "name"], 4)
    table.merge(spark.createDataFrame([(1, "a", 1, 1.0), (2, "b", 1, 1.0)], SCHEMA), NEWEST)
    table.merge(spark.createDataFrame([(1, "a", 2, None)], SCHEMA), lambda r: NEWEST(r).where("v IS NOT NULL"))
    assert rows(table.read()) == [(2, "b", 1, 1.0)]
    table.merge(spark.createDataFrame([], SCHEMA), NEWEST)
    assert rows(table.read()) == [(2, "b", 1, 1.0)]
    with pytest.raises(ValueError, match="keys are"):
        KeyedTable(spark, str(tmp_path / "t"), ["k"]).merge(spark.createDataFrame([], SCHEMA), NEWEST)


def test_only_one_of_two_merges_is_published(spark, tmp_path):
    one, two = (KeyedTable(spark, str(tmp_path / "t"), ["k", "name"], 4) for _ in range(2))
    one.merge(spark.createDataFrame([(1, "a", 1, 1.0)], SCHEMA), NEWEST)

    def meanwhile(r):
        two.merge(spark.createDataFrame([(2, "b", 1, 2.0)], SCHEMA), NEWEST)
        return NEWEST(r)

    with pytest.raises(Exception):
        one.merge(spark.createDataFrame([(1, "a", 2, 3.0)], SCHEMA), meanwhile)
    assert rows(one.read()) == [(1, "a", 1, 1.0), (2, "b", 1, 2.0)]


def readings(spark, seed, days):
    rng = random.Random(seed)
    first = dt.date(2024, 1, 1)
    data = []
    for _ in range(150):
        day = first + dt.timedelta(days=rng.choice(days))
        data.append((day, rng.randrange(24), f"S{rng.randrange(4)}", rng.choice([None, rng.random()]), rng.randrange(5), day.year, day.month))
    return spark.createDataFrame(data, "day date, hour int, station string, value double, stamp int, year int, month int")


def test_two_halves_equal_one_load_and_other_months_are_not_written(spark, tmp_path):
    rule = newest(["day", "hour", "station"], ["stamp"], ["value"])
    one, two = readings(spark, 1, range(0, 90)), readings(spark, 2, range(31, 60))
    path, at_once = str(tmp_path / "halves"), str(tmp_path / "once")
    refresh_parts(one, path, ["year", "month"], rule)
    before = {f: Path(tmp_path / "halves" / f).stat().st_mtime_ns for f in files_of(path)}
    merged = refresh_parts(two, path, ["year", "month"], rule)
    refresh_parts(one.union(two), at_once, ["year", "month"], rule)
    assert rows(merged) == rows(spark.read.schema(one.schema).parquet(at_once))
    after = {f: Path(tmp_path / "halves" / f).stat().st_mtime_ns for f in files_of(path)}
    for name, when in before.items():
        assert ("month=2/" in name) != (after.get(name) == when)
    assert refresh_parts(two.limit(0), path, ["year", "month"], rule).count() == merged.count()


def test_kept_means_equal_means_from_scratch(spark, tmp_path):
    keys = ["station"]
    parts = [readings(spark, s, range(0, 60)) for s in range(3)]
    union = parts[0].union(parts[1]).union(parts[2])
    for buckets, scratch in (
        (kept_means.phases("hour"), aggregate.phase_avg_wide(union, keys, "hour", "value")),
        (kept_means.weekdays("day"), aggregate.weekday_avg_wide(union, keys, "day", "value")),
    ):
        table = KeyedTable(spark, str(tmp_path / next(iter(buckets))), ["station", kept_means.BUCKET], 4)
        for part in parts:
            state = kept_means.mean_state(part, keys, "value", buckets)
            table.merge(state, lambda s: kept_means.folded(s, keys))
        got = kept_means.means_of(table.read(), keys, list(buckets))
        assert got.schema == scratch.schema
        assert rows(got) == rows(scratch) and got.count() > 0


def test_null_buckets_and_missing_buckets(spark):
    data = spark.createDataFrame([("a", h, None if h < 6 else 1.0) for h in range(24)] + [("b", 1, 2.0)], "station string, hour int, value double")
    buckets = kept_means.phases("hour")
    got = kept_means.means_of(kept_means.mean_state(data, ["station"], "value", buckets), ["station"], list(buckets))
    assert rows(got) == rows(aggregate.phase_avg_wide(data, ["station"], "hour", "value"))
    assert got.first()[1] is None and got.count() == 1


def test_measures_come_with_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "f1"), (2, "x", "f2"), (None, None, "f2")], "a int, `b c` string, src_filename string")
    sc, jobs = spark.sparkContext, []
    sc.setJobGroup("measured", "one write")
    got = measures.write_observed(df, "step", lambda d: d.write.parquet(str(tmp_path / "out")), "src_filename")
    jobs = sc.statusTracker().getJobIdsForGroup("measured")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert rows(got) == [("step", 3, 2, "a", 1), ("step", 3, 2, "b c", 2), ("step", 3, 2, "src_filename", 0)]
    assert keyed.names_in(spark, str(tmp_path / "nowhere")) == []
