"""Cells, clusters, density, curve order and buckets against plain Python, and the plans they are meant to have."""

import math
import random
from collections import defaultdict
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from geotally.operators import geo, layers
from geotally.sinks.bucketed import join_bucketed, write_bucketed

POINTS = "id int, latitude double, longitude double, weight double"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def points(spark, n=400, seed=1):
    rng = random.Random(seed)
    data = [(k, rng.uniform(-89, 89), rng.uniform(-180, 180), rng.choice([None, rng.random()])) for k in range(n)]
    data += [(n, 90.0, 180.0, 1.0), (n + 1, -90.0, -180.0, 2.0), (n + 2, None, 1.0, 1.0), (n + 3, 0.0, 0.0, 1.0), (n + 4, 0.0, 0.0, 1.0)]
    return spark.createDataFrame(data, POINTS), data


def brute_cell(latitude, longitude, level):
    side = 1 << level
    phi = math.radians(latitude)
    y = (1 - math.log(math.tan(phi) + 1 / math.cos(phi)) / math.pi) / 2 if abs(latitude) < 90 else (0.0 if latitude > 0 else 1.0)
    x, y = (min(max(math.floor(p * side), 0), side - 1) for p in ((longitude + 180) / 360, y))
    return sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(level))


def test_clusters_of_all_levels(spark):
    df, data = points(spark)
    want = defaultdict(list)
    for _, latitude, longitude, weight in data:
        if latitude is not None:
            for z in (0, 3, 9):
                want[z, brute_cell(latitude, longitude, z)].append((latitude, longitude, weight))
    got = {(r["level"], r["cell"]): r for r in layers.marker_clusters(df, [9, 0, 3, 3], "weight").collect()}
    assert set(got) == set(want)
    for k, members in want.items():
        r = got[k]
        assert r["n_points"] == len(members)
        weights = [w for *_, w in members if w is not None]
        assert (r["total"] is None) == (not weights) and (not weights or r["total"] == pytest.approx(sum(weights)))
        assert r["latitude"] == pytest.approx(sum(m[0] for m in members) / len(members))
    plan = layers.marker_clusters(df, [0, 3, 9], "weight")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_cells_nest(spark):
    cells = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 1024).alias("x"), (F.col("id") * 13 % 1024).alias("y"))
    up = geo.interleaved(F.shiftright("x", 1), F.shiftright("y", 1))
    assert cells.where(F.shiftright(geo.interleaved(F.col("x"), F.col("y")), 2) != up).count() == 0
    big = spark.range(1).select(geo.interleaved(F.lit(2**20 - 1).cast("bigint"), F.lit(0).cast("bigint"))).first()[0]
    assert big == sum(1 << 2 * b for b in range(20))


def test_density_keeps_the_whole_weight(spark):
    df, data = points(spark, 60, 2)
    got = layers.density_layer(df, 5.0, 2, "weight")
    whole = sum(w for _, a, _, w in data if w is not None and a is not None)
    assert got.agg(F.sum("density")).first()[0] == pytest.approx(whole)
    want = defaultdict(float)
    for _, a, b, w in data:
        if w is not None and a is not None:
            for i, j, share in layers.kernel_weights(2):
                want[math.floor(a / 5.0) + i, math.floor(b / 5.0) + j] += w * share
    assert {(r[0], r[1]): pytest.approx(r[2]) for r in got.collect()} == dict(want)
    assert sum(s for *_, s in layers.kernel_weights(3)) == pytest.approx(1)
    assert layers.kernel_weights(0) == [(0, 0, 1.0)]


def test_a_box_reads_few_row_groups(spark, tmp_path):
    rng = random.Random(4)
    data = [(k, rng.uniform(43, 44), rng.uniform(-80, -79), 1.0) for k in range(40_000)]
    df = spark.createDataFrame(data, POINTS)
    path = tmp_path / "points"
    geo.write_points(df, str(path), row_group=20_000)
    found = geo.points_in_box(spark.read.parquet(str(path)), 43.2, -79.5, 43.25, -79.45)
    assert rows(found.select("id")) == sorted(((k,) for k, a, b, _ in data if 43.2 <= a <= 43.25 and -79.5 <= b <= -79.45), key=repr)
    assert "PushedFilters: [IsNotNull(latitude), IsNotNull(longitude), GreaterThanOrEqual(latitude,43.2)" in found._jdf.queryExecution().executedPlan().toString()

    def groups(folder):
        for file in Path(folder).glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            for g in range(meta.num_row_groups):
                column = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
                a, b = column["latitude"], column["longitude"]
                yield a.max >= 43.2 and a.min <= 43.25 and b.max >= -79.5 and b.min <= -79.45

    met = list(groups(path))
    assert len(met) >= 8 and sum(met) <= len(met) / 3


def test_bucketed_join_moves_no_row(spark, tmp_path):
    fact = spark.createDataFrame([(f"s{k % 9}" if k % 2 else f"S{k % 9}", k) for k in range(100)] + [(None, -1)], "station string, v int")
    places = spark.createDataFrame([(f"s{k}", f"place {k}") for k in range(7)], "id string, name string")
    spark.sql("CREATE DATABASE IF NOT EXISTS lots")
    one = write_bucketed(fact, "lots.fact", str(tmp_path / "fact"), "station", 4)
    two = write_bucketed(places, "lots.places", str(tmp_path / "places"), "id", 4)
    joined = join_bucketed(one, two)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    want = fact.join(places, F.upper("station") == F.upper("id")).select("station", "v", "id", "name")
    assert rows(joined.select("station", "v", "id", "name")) == rows(want)
    grouped = one.groupBy("_key").agg(F.max("v"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in grouped
    spark.sql("DROP DATABASE lots CASCADE")
