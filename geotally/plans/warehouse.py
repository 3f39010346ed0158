"""Staging, production, forecast and layer tables, each built once and read back as written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally import fixed_values as fixed
from geotally import schemas
from geotally.functions.calendar import any_date, weekday_name
from geotally.operators import aggregate, clean, dedupe, enrich, forecast, geo, layers, measures, reshape, runlog
from geotally.plans.settings import JobSettings
from geotally.session import scratch_path
from geotally.sinks import tables as sink
from geotally.sinks.keyed import KeyedTable
from geotally.sources import quarantine, staging
from geotally.sources.files import list_files
from geotally.sources.tables import catalog_tables

STATION_KEYS = ("cgndb_id", "latitude", "longitude")
SPOT_KEYS = ("main", "latitude", "longitude")


def latest_traffic_volume(staged: DataFrame) -> DataFrame:
    """Newest count of each location; dates come as text and are compared as dates."""
    dated = staged.withColumn("latest_count_date", any_date("count_date")).drop("count_date")
    others = [c for c in dated.columns if c not in ("location_id", "latest_count_date")]
    newest = dedupe.latest_per_key(dated, ["location_id"], ["latest_count_date"], others)
    return newest.withColumnRenamed("X_id", "_id")


def latest_intersection_counts(staged: DataFrame) -> DataFrame:
    others = [c for c in staged.columns if c not in ("objectid", "count_date")]
    return dedupe.latest_per_key(staged, ["objectid"], ["count_date"], others)


def projected_air(combined: DataFrame, stations, srid: int) -> DataFrame:
    """Chosen stations with plain weekday names and a point."""
    chosen = clean.keep_stations(combined, "cgndb_id", stations)
    return geo.add_point(chosen.withColumn("weekday", weekday_name("the_date")), srid=srid)


def with_station_point(averages: DataFrame, srid: int) -> DataFrame:
    """Wide means are grouped without the point, which follows from the position."""
    return geo.add_point(averages, srid=srid)


class Warehouse:
    """Builds the tables of one run."""

    def __init__(self, spark: SparkSession, settings: JobSettings) -> None:
        self.spark = spark
        self.settings = settings
        self.log = runlog.StepLog()
        self.measured: list[DataFrame] = []

    def stage(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.settings.stage_schema}.{name}")

    def public(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.settings.public_schema}.{name}")

    def _refresh(self, phase: str, schema: str, name: str, df: DataFrame, partition_by=(), files: int = 1) -> DataFrame:
        whole, root = f"{schema}.{name}", self.settings.table_root
        files_of = "src_filename" if phase == "stage" and "src_filename" in df.columns else None
        with self.log.step(phase, name, files):
            self.measured.append(
                measures.write_observed(df, name, lambda d: sink.replace_table(d, whole, root, partition_by), files_of)
            )
            return self.spark.table(whole)

    def _produce(self, name: str, df: DataFrame, partition_by=(), stamped: bool = True) -> DataFrame:
        df = clean.insertion_stamp(df, self.settings.as_of) if stamped else df
        return self._refresh("production", self.settings.public_schema, name, df, partition_by)

    def build_staging(self) -> None:
        s, spark, link = self.settings, self.spark, self.settings.links
        readers = (
            ("stg_monthly_air_data", "air", staging.stage_air_wide),
            ("stg_monthly_forecasts", "forecasts", staging.stage_forecasts),
            ("stg_traffic_volume", "traffic_volume", staging.stage_traffic_volume),
            ("stg_geo_names", "geo_names", staging.stage_geo_names),
            ("stg_gta_traffic_arcgis", "intersections", staging.stage_intersection_counts),
        )
        delimited = {
            "forecasts": (schemas.FORECASTS, staging.conform_forecasts),
            "traffic_volume": (schemas.TRAFFIC_VOLUME, staging.conform_traffic_volume),
            "intersections": (schemas.INTERSECTION_COUNTS, staging.conform_intersection_counts),
        }
        rejected = []
        for name, dataset, read in readers:
            folder = s.landing[dataset]
            landed = list_files(spark, folder).count()
            if s.error_budget and dataset in delimited:
                schema, conform = delimited[dataset]
                scanned = quarantine.scan(spark, folder, schema, scratch_path(spark, dataset), s.error_budget)
                rejected.append(scanned.bad.withColumn("dataset", F.lit(dataset)))
                staged = conform(scanned.good, s.as_of, link.get(dataset, ""))
            else:
                staged = read(spark, folder, s.as_of, link.get(dataset, ""))
            self._refresh("stage", s.stage_schema, name, staged, files=landed)
        if rejected:
            self._refresh("stage", s.stage_schema, "rejected_lines", clean.union_by_name(rejected))
        long = reshape.unpivot_stations(self.stage("stg_monthly_air_data"))
        self._refresh("stage", s.stage_schema, "stg_monthly_air_data_transpose", long)

    def build_production(self) -> None:
        s = self.settings
        wide = self.stage("stg_monthly_air_data")
        self._produce("fact_monthly_air_data", dedupe.dedupe_readings(wide, dedupe.READING_KEYS_PER_HOUR))
        long = self.stage("stg_monthly_air_data_transpose")
        self._produce("fact_monthly_air_data_transpose", dedupe.dedupe_readings(long))
        places = enrich.newest_places(self.stage("stg_geo_names"), s.as_of)
        places = self._produce("dim_geo_names", places, stamped=False)

        months = ("year", "month")
        air = enrich.combined_readings(long, places, s.as_of, places_are_newest=True)
        air = self._produce("fact_combined_air_data", air, months, stamped=False)
        ahead = enrich.combined_forecasts(
            self.stage("stg_monthly_forecasts"), places, s.as_of, places_are_newest=True
        )
        self._produce("fact_monthly_forecasts", ahead, months, stamped=False)

        self._produce("fact_traffic_volume", latest_traffic_volume(self.stage("stg_traffic_volume")))
        counts = latest_intersection_counts(self.stage("stg_gta_traffic_arcgis"))
        counts = self._produce("fact_gta_traffic_arcgis", counts)
        averages = {
            "fact_gta_traffic_arcgis_avg": "f8hr_vehicle_volume",
            "fact_gta_pedestrians_arcgis_avg": "f8hr_pedestrian_volume",
        }
        for name, value in averages.items():
            means = aggregate.weekday_volume_avg(counts, SPOT_KEYS, "count_date", value)
            self._produce(name, means, stamped=False)

        self._produce("fact_gta_traffic_proj", geo.add_point(counts, srid=s.point_label), stamped=False)
        chosen = projected_air(air, s.stations, s.point_label)
        chosen = self._produce("fact_air_data_proj", chosen, stamped=False)
        # Each station should have one position; those with more are listed for whoever runs the job.
        doubtful = aggregate.stations_with_many_positions(chosen)
        self._refresh("production", s.stage_schema, "stations_with_many_positions", doubtful)
        value = "air_quality_value"
        station_means = {
            "fact_hourly_avg": aggregate.phase_avg_wide(chosen, STATION_KEYS, "hours_utc", value),
            "fact_weekdays_avg": aggregate.weekday_avg_wide(chosen, STATION_KEYS, "the_date", value),
            "fact_geo_stations_avg": aggregate.station_avg(chosen, STATION_KEYS, value),
        }
        for name, means in station_means.items():
            self._produce(name, with_station_point(means, s.point_label), stamped=False)

    def build_forecasts(self) -> None:
        counts = self.public("fact_gta_traffic_arcgis")
        names = {
            "f8hr_vehicle_volume": "fact_traffic_forecast",
            "f8hr_pedestrian_volume": "fact_pedestrians_forecast",
        }
        # These two steps have placeholders in the log, which their entries replace.
        with self.log.step(fixed.PLACEHOLDER_PHASE, "auto_ml"):
            for label, predicted in forecast.TARGETS.items():
                ahead = forecast.forecast_volume(
                    counts, forecast.traffic_series(label), predicted, self.settings.as_of, self.settings.forecast
                )
                self._refresh("forecast", self.settings.public_schema, names[label], ahead)

    def _layer_frames(self) -> dict[str, DataFrame]:
        air, counts = self.public("fact_air_data_proj"), self.public("fact_gta_traffic_arcgis")
        vehicles, walkers = "f8hr_vehicle_volume", "f8hr_pedestrian_volume"
        whole = clean.drop_any_null(counts)
        built: dict[str, DataFrame] = {}
        if "markers" in self.settings.layers:
            air_label = layers.air_label("air_quality_value", "geographical_name", "the_date", "phase_hour_utc")
            built["layer_air_markers"] = layers.marker_layer(
                clean.drop_any_null(air, [c for c in air.columns if c != "geom"]), "air_quality_value", air_label
            )
            for name, title, value in (
                ("layer_traffic_markers", "Traffic Volume", vehicles),
                ("layer_pedestrian_markers", "Pedestrian Volume", walkers),
            ):
                label = layers.volume_label(title, value, "count_date", "main")
                built[name] = layers.marker_layer(whole, value, label, keys=["objectid"])
            built["layer_bounds"] = aggregate.bbox_center(whole)
        if "heat" in self.settings.layers:
            built["layer_air_heat"] = layers.heat_layer(
                clean.drop_any_null(self.public("fact_combined_air_data")), "air_quality_value"
            )
            built["layer_traffic_heat"] = layers.heat_layer(whole, vehicles)
            built["layer_pedestrian_heat"] = layers.heat_layer(whole, walkers)
        if "frames" in self.settings.layers:
            built["layer_traffic_frames"] = layers.in_date_order(layers.daily_frames(whole, "count_date", vehicles))
        if "charts" in self.settings.layers:
            means = self.public("fact_weekdays_avg").drop("geom")
            built["layer_weekday_charts"] = layers.weekday_charts(clean.drop_any_null(means), STATION_KEYS)
        if self.settings.run_forecast:
            for kind, title, value in (
                ("traffic", "Predicted Traffic", vehicles),
                ("pedestrians", "Predicted Pedestrians", walkers),
            ):
                ahead, predicted = self.public(f"fact_{kind}_forecast"), forecast.TARGETS[value]
                if "markers" in self.settings.layers:
                    label = layers.prediction_label(title, predicted, "future_date", "main")
                    built[f"layer_predicted_{kind}_markers"] = layers.marker_layer(
                        ahead, predicted, label, keys=["objectid", "future_date"], reference=whole,
                        reference_value=value,
                    )
                if "heat" in self.settings.layers:
                    built[f"layer_predicted_{kind}_heat"] = layers.heat_layer(ahead, predicted)
        return built

    def build_layers(self) -> None:
        with self.log.step(fixed.PLACEHOLDER_PHASE, "create_dataframes"):
            for name, df in self._layer_frames().items():
                self._refresh("layers", self.settings.public_schema, name, df)

    def write_log(self) -> DataFrame:
        """Put this run's steps into the log, which keeps the newest entry of each step, and the measures beside it."""
        s = self.settings
        steps = clean.union_by_name([runlog.placeholder_steps(self.spark), self.log.frame(self.spark)])
        log = KeyedTable(self.spark, f"{s.table_root.rstrip('/')}/run_log", ["step_name"], buckets=4)
        log.merge(steps, runlog.latest_steps)
        log.forget()
        if self.measured:
            sink.replace_table(clean.union_by_name(self.measured), f"{s.stage_schema}.step_measures", s.table_root)
        return sink.replace_table(log.read(), f"{s.public_schema}.data_model_performance_tbl", s.table_root)

    def export(self) -> None:
        """Text copies of all public tables, and of the marker layers as GeoJSON.

        The loops are over table names; each copy is a Spark write.
        """
        names = catalog_tables(self.spark, self.settings.public_schema, not_in=fixed.EXPORT_SKIPS)
        folder = self.settings.export_folder
        names = [r[0] for r in names.collect()]
        sink.export_tables(self.spark, self.settings.public_schema, names, folder)
        for name in names:
            if name.startswith("layer_") and name.endswith("_markers"):
                features = layers.geojson_features(self.public(name), ["marker_class", "popup"])
                sink.write_features(features, f"{folder.rstrip('/')}/geojson/{name}")

    def run(self) -> DataFrame:
        try:
            if self.settings.create_tables:
                self.build_staging()
                self.build_production()
            if self.settings.run_forecast:
                self.build_forecasts()
            self.build_layers()
        finally:
            log = self.write_log()
        if self.settings.export_folder:
            self.export()
        return log
