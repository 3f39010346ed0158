"""The whole build from landed files, twice."""

import datetime as dt
import random
import shutil
import zipfile

import pytest
from pyspark.sql import functions as F

from geotally.operators.forecast import ForecastSettings
from geotally.plans.settings import DATASETS, JobSettings
from geotally.plans.warehouse import Warehouse

AS_OF = dt.datetime(2024, 7, 1, 12)
STATIONS = ["FCKTB", "FCWYG", "FDQBU", "FZZZZ"]


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    folders = {name: root / name for name in DATASETS}
    for folder in folders.values():
        folder.mkdir()
    rng = random.Random(5)
    for month in (1, 2):
        lines = ["Date,Hour (UTC)," + ",".join(STATIONS)]
        for day in range(1, 15):
            for hour in range(24):
                cells = [f"{rng.uniform(1, 6):.1f}" if rng.random() > 0.1 else "" for _ in STATIONS]
                lines.append(f"2024-{month:02d}-{day:02d},{hour}," + ",".join(cells))
        (folders["air"] / f"air{month}.csv").write_text("\n".join(lines) + "\n")
    header = "cgndb code,community name,validity date,validity time (UTC),period,value,amended?"
    lines = [header] + [f"{s},Town,2024-03-0{d},{h:02d}:00:00,{d},{h % 5},0" for s in STATIONS for d in (1, 2) for h in range(24)]
    (folders["forecasts"] / "f.csv").write_text("\n".join(lines) + "\n")
    lines = ["X_id,location_id,location,lng,lat,centreline_type,centreline_id,px,count_date"]
    lines += [f"{i},{i % 5},Street {i % 5},-79.{i},43.{i},1.0,2.0,,2023-0{i % 9 + 1}-15" for i in range(30)]
    (folders["traffic_volume"] / "v.csv").write_text("\n".join(lines) + "\n")
    header = (
        "CGNDB ID,Geographical Name,Language,Syllabic Form,Generic Term,Generic Category,Concise Code,"
        "Toponymic Feature ID,Latitude,Longitude,Location,Province - Territory,Relevance at Scale,Decision Date,Source"
    )
    lines = [header]
    for i, s in enumerate(STATIONS):
        for year in (2001, 2011):
            lines.append(
                f'{s.lower()},"Place {s}, {year}",English,,City,Populated Place,CITY,id{i},{43 + i / 10},{-79 - i / 10},'
                f"York,Ontario,1000,{year}-01-01,src"
            )
    with zipfile.ZipFile(folders["geo_names"] / "names.zip", "w") as z:
        z.writestr("names.csv", "\n".join(lines) + "\n")
    lines = [
        "OBJECTID,TCS__,MAIN,MIDBLOCK_ROUTE,SIDE_1_ROUTE,SIDE_2_ROUTE,ACTIVATION_DATE,LATITUDE,LONGITUDE,COUNT_DATE,"
        "F8HR_VEHICLE_VOLUME,F8HR_PEDESTRIAN_VOLUME"
    ]
    for i in range(80):
        for day in ("2015-03-02", f"2015-0{i % 8 + 1}-1{i % 9}"):
            lines.append(
                f"{i},{i % 7}.0,Main {i % 4},m,s1,s2,2001-01-01,{43.5 + i / 100},{-79 - i / 100},{day},"
                f"{1000 + 13 * i}.5,{50 + i}"
            )
    (folders["intersections"] / "counts.txt").write_text("\n".join(lines) + "\n")
    return folders


def build(spark, landing, root, **changes):
    changes.setdefault("forecast", ForecastSettings(horizon=3, forest_trees=2, boosting_rounds=1, tree_depth=2))
    settings = JobSettings({k: str(v) for k, v in landing.items()}, str(root), AS_OF, **changes)
    warehouse = Warehouse(spark, settings)
    log = warehouse.run()
    return warehouse, log


def content(spark, schema):
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {schema}").where(~F.col("isTemporary")).collect()]
    return {
        n: sorted(map(repr, spark.table(f"{schema}.{n}").collect())) for n in names if n != "data_model_performance_tbl"
    }


def test_build_and_build_again(spark, landing, tmp_path):
    warehouse, log = build(
        spark, landing, tmp_path / "tables", stage_schema="stage1", public_schema="public1",
        export_folder=str(tmp_path / "export"),
    )
    public = warehouse.public
    readings = public("fact_combined_air_data")
    staged = warehouse.stage("stg_monthly_air_data_transpose")
    assert readings.count() == staged.count() > 2000
    assert readings.select("geographical_name").distinct().count() == 4
    assert readings.where("geographical_name NOT LIKE '%2011'").count() == 0
    assert public("fact_monthly_air_data").count() == 2 * 14 * 24
    assert public("fact_monthly_forecasts").count() == 4 * 2 * 24
    assert public("dim_geo_names").count() == 4
    assert public("fact_traffic_volume").count() == 5
    assert public("fact_gta_traffic_arcgis").count() == 80
    hourly = public("fact_hourly_avg")
    # Three of the four stations are among those the projected table keeps.
    assert sorted(r["cgndb_id"] for r in hourly.collect()) == STATIONS[:3]
    assert hourly.first()["geom"].asDict() == {
        "x": hourly.first()["longitude"], "y": hourly.first()["latitude"], "srid": 26917
    }
    assert public("fact_weekdays_avg").count() == public("fact_geo_stations_avg").count() == 3
    for kind in ("traffic", "pedestrians"):
        ahead = public(f"fact_{kind}_forecast")
        assert ahead.count() == 80 * 3
        # The newest count is 2015-08-18, at intersection 71.
        assert ahead.agg(F.min("future_date")).first()[0] == dt.date(2024, 8, 18)
        assert ahead.columns == [
            "objectid", "tcs__", "main", "latitude", "longitude", "future_date", f"predicted_{kind}", "last_inserted"
        ]
    assert public("layer_traffic_markers").count() == 80
    assert public("layer_predicted_traffic_markers").count() == 240
    assert sum(r["copies"] for r in public("layer_traffic_frames").collect()) == 80
    seconds = {r["step_name"]: r["duration_seconds"] for r in log.collect()}
    assert seconds["turf"] == -1 and seconds["auto_ml"] > 0 and seconds["create_dataframes"] > 0
    assert warehouse.stage("stations_with_many_positions").count() == 0
    assert seconds["fact_hourly_avg"] > 0 and seconds["stg_geo_names"] > 0
    assert (tmp_path / "export" / "fact_hourly_avg").exists()

    # A second run with a copy of every air file changes no production table but the file names.
    before = content(spark, "public1")
    more = dict(landing, air=tmp_path / "air2")
    shutil.copytree(landing["air"], more["air"])
    for file in list(more["air"].iterdir()):
        shutil.copy(file, more["air"] / f"copy_of_{file.name}")
    build(spark, more, tmp_path / "tables", stage_schema="stage1", public_schema="public1")
    assert warehouse.stage("stg_monthly_air_data").count() == 2 * 2 * 14 * 24
    after = content(spark, "public1")
    assert before.keys() == after.keys()
    lineage = {"fact_monthly_air_data", "fact_monthly_air_data_transpose", "fact_combined_air_data", "fact_air_data_proj"}
    for name in before:
        if name in lineage:
            assert len(before[name]) == len(after[name])
        else:
            assert before[name] == after[name], name

    # Without table building, the layers of the same tables are made again.
    warehouse, _ = build(
        spark, {}, tmp_path / "tables", stage_schema="stage1", public_schema="public1", create_tables=False,
        run_forecast=False, layers="heat, charts",
    )
    assert content(spark, "public1") == after


def test_settings_are_checked():
    with pytest.raises(ValueError):
        JobSettings({}, "x", AS_OF)
    with pytest.raises(ValueError):
        JobSettings({}, "x", AS_OF, create_tables=False, layers="folium")
    with pytest.raises(ValueError):
        ForecastSettings(horizon=0)
    with pytest.raises(ValueError):
        ForecastSettings(frequency="never")
    with pytest.raises(ValueError):
        ForecastSettings(frequency="sometimes")
    assert ForecastSettings(frequency="hourly").code == "h"


def test_faulty_lines_are_rejected_within_the_budget(spark, landing, tmp_path):
    from geotally.sources.quarantine import BudgetExceeded, ErrorBudget

    folders = {**landing, "forecasts": tmp_path / "forecasts"}
    folders["forecasts"].mkdir()
    text = (landing["forecasts"] / "f.csv").read_text()
    (folders["forecasts"] / "f.csv").write_text(text + "FCKTB,Town,2024-03-01,01:00:00,one,2,0\nshort,line\n")
    settings = JobSettings(
        {k: str(v) for k, v in folders.items()}, str(tmp_path / "tables"), AS_OF, stage_schema="stage5", error_budget=ErrorBudget(0.05)
    )
    warehouse = Warehouse(spark, settings)
    warehouse.build_staging()
    got = sorted((r["dataset"], r["reason"], r["line"]) for r in warehouse.stage("rejected_lines").collect())
    assert got == [("forecasts", "cells", "short,line"), ("forecasts", "type", "FCKTB,Town,2024-03-01,01:00:00,one,2,0")]
    assert warehouse.stage("stg_monthly_forecasts").count() == text.count("\n") - 1
    measured = {(r["step_name"], r["n_rows"], r["n_files"]) for df in warehouse.measured for r in df.collect()}
    assert ("stg_monthly_forecasts", text.count("\n") - 1, 1) in measured
    assert ("stg_monthly_air_data", 2 * 14 * 24, 2) in measured
    strict = JobSettings({k: str(v) for k, v in folders.items()}, str(tmp_path / "t"), AS_OF, stage_schema="stage6", error_budget=ErrorBudget(0.001))
    with pytest.raises(BudgetExceeded):
        Warehouse(spark, strict).build_staging()
