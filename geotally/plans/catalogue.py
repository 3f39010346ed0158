"""Every operator as a query over the given tables, with the same result in SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geotally import fixed_values as fixed
from geotally import schemas
from geotally.functions import calendar as cal
from geotally.functions import text
from geotally.operators import (
    aggregate,
    clean,
    dedupe,
    enrich,
    forecast,
    geo,
    kept_means,
    layers,
    measures,
    model_search,
    reshape,
    runlog,
)
from geotally.plans import inputs, warehouse
from geotally.plans.inputs import AS_OF, Tables
from geotally.session import scratch_path
from geotally.sinks import tables as sink
from geotally.sinks.bucketed import join_bucketed, write_bucketed
from geotally.sinks.keyed import KeyedTable, newest, refresh_parts
from geotally.sources import datasource, files, links, quarantine, staging
from geotally.sources.tables import catalog_tables


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


CATALOGUE: dict[str, Query] = {}


def query(sql: str | None = None):
    """Register a function as the query of its name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        CATALOGUE[build.__name__] = Query(build, sql)
        return build

    return register


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return CATALOGUE[name].build(Tables(spark, folder))


# SQL pieces used by several queries.

STAMP = "TIMESTAMP '2024-07-01 12:00:00'"
EST = "TIMESTAMP '2024-07-01 07:00:00'"


def sql_position(key: str) -> str:
    return f"43 + {key} % 977 / 1000 AS latitude, -79 - {key} % 613 / 1000 AS longitude"


def sql_mean(value: str, condition: str = "true") -> str:
    return f"cast(printf('%.14e', avg({value}) FILTER (WHERE {condition})) AS decimal(10,2))"


def sql_settled(value: str) -> str:
    return f"cast(printf('%.14e', avg({value})) AS double)"


SQL_READINGS = """SELECT cast(ts AS date) AS the_date, cast(hour(ts) AS bigint) AS hours_utc, 'st' || user_id AS cgndb_id,
    value AS air_quality_value, 'listing/' || event_type AS download_link, event_type || '.csv' AS src_filename,
    ts AS last_updated FROM events"""

SQL_POSITIONED = f"""SELECT user_id AS cgndb_id, {sql_position('user_id')}, cast(ts AS date) AS the_date,
    hour(ts) AS hours_utc, value AS air_quality_value, ts, event_type FROM events"""

SQL_PLACES = f"""SELECT 'ST' || c_custkey AS cgndb_id, c_name || ' v' || v AS geographical_name, 'English' AS "language",
    cast(NULL AS varchar) AS syllabic_form, c_mktsegment AS generic_term, lower(c_mktsegment) AS generic_category,
    substr(c_mktsegment, 1, 4) AS concise_code, cast(c_custkey AS varchar) AS toponymic_feature_id,
    {sql_position('c_custkey')}, 'Nation ' || c_nationkey AS "location",
    cast(c_nationkey AS varchar) AS province_territory, cast(v AS bigint) AS relevance_at_scale,
    CASE WHEN NOT (v = 1 AND c_mktsegment = 'FURNITURE')
         THEN DATE '2020-01-01' + cast(c_custkey % 365 + v AS int) END AS decision_date,
    'customer' AS "source", {STAMP} AS last_updated, 'http://places' AS download_link,
    'landing/places.csv' AS src_filename
    FROM customer, (VALUES (0), (1)) AS versions(v)"""

SQL_NEWEST_PLACES = f"""SELECT * EXCLUDE (rn), {EST} AS last_inserted FROM (
    SELECT *, row_number() OVER (PARTITION BY cgndb_id ORDER BY decision_date DESC NULLS FIRST) AS rn
    FROM ({SQL_PLACES})) WHERE rn = 1"""

SQL_COUNTS = f"""SELECT o_custkey AS objectid, o_orderpriority AS main, o_orderstatus AS tcs__, {sql_position('o_custkey')},
    cast(o_orderdate AS date) AS count_date, o_totalprice AS f8hr_vehicle_volume,
    o_orderkey % 1000 / 3 AS f8hr_pedestrian_volume FROM orders"""

SQL_PHASE = """CASE WHEN hours_utc BETWEEN 0 AND 5 THEN 'DAWN_0_TO_5' WHEN hours_utc BETWEEN 6 AND 11 THEN 'MORNING_6_TO_11'
    WHEN hours_utc BETWEEN 12 AND 17 THEN 'NOON_12_TO_17' WHEN hours_utc BETWEEN 18 AND 23 THEN 'EVENING_18_TO_23'
    ELSE 'Unknown' END"""


def sql_seconds(later: str, earlier: str) -> str:
    return f"extract(microsecond FROM ({later} - {earlier})) / 1e6"


def sql_combined(source: str, keys: str) -> str:
    return f"""WITH newest AS ({SQL_NEWEST_PLACES}),
    kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY last_updated DESC NULLS FIRST,
        src_filename DESC NULLS FIRST, {'cgndb_id DESC NULLS FIRST, ' if 'cgndb_id' not in keys else ''}
        air_quality_value DESC NULLS FIRST) AS rn FROM ({source})) WHERE rn = 1)
    SELECT upper(g.cgndb_id) AS cgndb_id, g.latitude, g.longitude, g.province_territory, g."location",
        g.decision_date, g.concise_code, g.generic_category, g.generic_term, g.geographical_name,
        {sql_seconds('g.last_inserted', 'g.last_updated')} AS geo_names_second_from_extraction, m.the_date,
        cast(year(m.the_date) AS int) AS "year", cast(month(m.the_date) AS int) AS "month",
        monthname(m.the_date) AS the_month, dayname(m.the_date) AS weekday,
        cast(weekofyear(m.the_date) AS int) AS week_number, m.hours_utc, {SQL_PHASE} AS phase_hour_utc,
        m.air_quality_value, {sql_seconds(EST, 'm.last_updated')} AS air_data_seconds_from_extraction,
        m.last_updated, {EST} AS last_inserted, m.src_filename
    FROM kept m JOIN newest g ON upper(g.cgndb_id) = upper(m.cgndb_id)"""


PHASES = ((0, 5, "dawn_avg"), (6, 11, "morning_avg"), (12, 17, "noon_avg"), (18, 23, "evening_avg"))
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def sql_wide(keys: str, value: str, buckets: dict[str, str], source: str) -> str:
    means = ", ".join(f"{sql_mean(value, inside)} AS {name}" for name, inside in buckets.items())
    seen = " AND ".join(f"count(*) FILTER (WHERE {inside}) > 0" for inside in buckets.values())
    return f"SELECT {keys}, {means} FROM ({source}) GROUP BY {keys} HAVING {seen}"


SQL_PHASE_BUCKETS = {name: f"hours_utc BETWEEN {a} AND {b}" for a, b, name in PHASES}
SQL_DAY_BUCKETS = {f"{day}_avg": f"isodow(the_date) = {i}" for i, day in enumerate(DAYS, 1)}
STATION = "cgndb_id, latitude, longitude"
SQL_WEEKDAYS_WIDE = sql_wide(STATION, "air_quality_value", SQL_DAY_BUCKETS, SQL_POSITIONED)


# Newest row per key.


@query(
    """SELECT event_id, ts, user_id, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn
    FROM events) WHERE rn = 1"""
)
def latest_per_key(t: Tables) -> DataFrame:
    return dedupe.latest_per_key(t("events"), ["user_id"], ["ts"], ["event_id"])


@query(
    """SELECT o_orderkey, o_custkey, checked FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY checked DESC NULLS FIRST, o_orderkey DESC) AS rn
    FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS checked FROM orders))
    WHERE rn = 1"""
)
def latest_null_first(t: Tables) -> DataFrame:
    checked = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("checked")
    orders = t("orders").select("o_orderkey", "o_custkey", checked)
    return dedupe.latest_per_key(orders, ["o_custkey"], ["checked"], ["o_orderkey"])


@query(
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS FIRST, l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST) AS rn FROM lineitem)
    WHERE rn = 1"""
)
def dedupe_composite(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return dedupe.dedupe_readings(t("lineitem"), keys, ["l_shipdate"], ["l_partkey", "l_suppkey"])


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY the_date, hours_utc
    ORDER BY last_updated DESC NULLS FIRST, src_filename DESC, cgndb_id DESC, air_quality_value DESC) AS rn
    FROM ({SQL_READINGS}))
    WHERE rn = 1"""
)
def dedupe_per_hour(t: Tables) -> DataFrame:
    return dedupe.dedupe_readings(inputs.readings(t), dedupe.READING_KEYS_PER_HOUR)


@query(
    f"""SELECT * EXCLUDE (rn), {EST} AS last_inserted FROM (SELECT *, row_number() OVER (
    PARTITION BY objectid ORDER BY count_date DESC NULLS FIRST, main DESC, tcs__ DESC, f8hr_vehicle_volume DESC,
    f8hr_pedestrian_volume DESC) AS rn FROM ({SQL_COUNTS})) WHERE rn = 1"""
)
def intersection_counts(t: Tables) -> DataFrame:
    return clean.insertion_stamp(warehouse.latest_intersection_counts(inputs.intersections(t)), AS_OF)


@query(
    f"""SELECT _id, location_id, latest_count_date, {EST} AS last_inserted FROM (SELECT *, row_number() OVER (
    PARTITION BY location_id ORDER BY latest_count_date DESC NULLS FIRST, _id DESC) AS rn FROM (
    SELECT o_orderkey AS _id, o_custkey AS location_id, cast(o_orderdate AS date) AS latest_count_date FROM orders))
    WHERE rn = 1"""
)
def traffic_volume(t: Tables) -> DataFrame:
    staged = t("orders").select(
        F.col("o_orderkey").alias("X_id"),
        F.col("o_custkey").alias("location_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("count_date"),
    )
    return clean.insertion_stamp(warehouse.latest_traffic_volume(staged), AS_OF)


@query(SQL_NEWEST_PLACES)
def newest_places(t: Tables) -> DataFrame:
    return enrich.newest_places(staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places"), AS_OF)


# Reshape.


@query(
    """SELECT l_orderkey, l_linenumber, l_shipdate, measure, value FROM (
    UNPIVOT (SELECT l_orderkey, l_linenumber, nullif(l_shipdate, TIMESTAMP '1995-03-01') AS l_shipdate,
    l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem)
    ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME measure VALUE value) WHERE l_shipdate IS NOT NULL"""
)
def unpivot_stations(t: Tables) -> DataFrame:
    wide = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_shipdate", F.lit("1995-03-01").cast("timestamp_ntz")).alias("l_shipdate"),
        "l_quantity",
        "l_extendedprice",
        F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
    )
    ids = ["l_orderkey", "l_linenumber", "l_shipdate"]
    return reshape.unpivot_stations(wide, ids, station_name="measure", value_name="value")


@query(
    f"""WITH wide AS ({SQL_WEEKDAYS_WIDE}), long AS (UNPIVOT wide ON {', '.join(SQL_DAY_BUCKETS)}
    INTO NAME day_name VALUE weekday_avg)
    SELECT {STATION}, cast(list_position({[f'{d}_avg' for d in DAYS]}, day_name) AS int) AS weekday_number,
    upper(day_name[1]) || replace(day_name[2:], '_avg', '') AS weekday, weekday_avg FROM long"""
)
def weekday_wide_to_long(t: Tables) -> DataFrame:
    return reshape.weekday_wide_to_long(weekday_avg_wide(t), ["cgndb_id", "latitude", "longitude"])


# Enrichment.


@query(sql_combined(SQL_READINGS, "the_date, hours_utc, cgndb_id"))
def combined_readings(t: Tables) -> DataFrame:
    places = staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places")
    return enrich.combined_readings(inputs.readings(t), places, AS_OF)


@query(sql_combined(SQL_READINGS, "the_date, hours_utc"))
def combined_readings_per_hour(t: Tables) -> DataFrame:
    places = staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places")
    return enrich.combined_readings(inputs.readings(t), places, AS_OF, keys=dedupe.READING_KEYS_PER_HOUR)


SQL_FORECASTS = """SELECT cast(ts AS date) AS the_date, strftime(ts, '%H:%M:%S') AS validity_time_utc,
    cast(hour(ts) AS bigint) AS hours_utc, 'st' || user_id AS cgndb_id, cast(floor(value) AS bigint) AS air_quality_value,
    event_type || '.csv' AS src_filename, ts AS last_updated FROM events"""


def _staged_forecasts(t: Tables) -> DataFrame:
    return t("events").select(
        F.concat(F.lit("st"), "user_id").alias("cgndb_code"),
        F.to_date("ts").alias("validity_date"),
        F.date_format("ts", "HH:mm:ss").alias("validity_time_utc"),
        F.floor("value").alias("value"),
        F.lit("listing/").alias("download_link"),
        F.concat("event_type", F.lit(".csv")).alias("src_filename"),
        F.col("ts").alias("last_updated"),
    )


@query(sql_combined(SQL_FORECASTS, "the_date, validity_time_utc, cgndb_id"))
def combined_forecasts(t: Tables) -> DataFrame:
    places = staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places")
    return enrich.combined_forecasts(_staged_forecasts(t), places, AS_OF)


@query(sql_combined(SQL_FORECASTS, "the_date, validity_time_utc"))
def combined_forecasts_per_time(t: Tables) -> DataFrame:
    """One station for each date and time, like the published table."""
    places = staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places")
    return enrich.combined_forecasts(_staged_forecasts(t), places, AS_OF, dedupe.FORECAST_KEYS_PER_TIME)


SQL_ENRICH_JOIN = """SELECT o_orderkey, lower(c_name) AS order_name, c_name, c_mktsegment FROM orders
    JOIN customer ON o_custkey = c_custkey"""


def _orders_by_name(t: Tables) -> tuple[DataFrame, DataFrame]:
    name = F.concat(F.lit("customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    return t("orders").select("o_orderkey", name.alias("order_name")), t("customer").select("c_name", "c_mktsegment")


@query(SQL_ENRICH_JOIN)
def enrich_join_ci(t: Tables) -> DataFrame:
    return enrich.join_ignoring_case(*_orders_by_name(t), "order_name", "c_name")


@query(SQL_ENRICH_JOIN)
def enrich_join_salted(t: Tables) -> DataFrame:
    return enrich.join_ignoring_case(*_orders_by_name(t), "order_name", "c_name", salts=8, salt_on=["o_orderkey"])


@query(
    """SELECT o_orderkey, cast(o_orderdate AS date) AS the_date, cast(year(o_orderdate) AS int) AS "year",
    cast(month(o_orderdate) AS int) AS "month", monthname(o_orderdate) AS the_month, dayname(o_orderdate) AS weekday,
    cast(weekofyear(o_orderdate) AS int) AS week_number FROM orders"""
)
def calendar_enrich(t: Tables) -> DataFrame:
    return enrich.add_calendar(t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("the_date")))


@query(
    """SELECT o_orderkey, rpad(monthname(o_orderdate), 9, ' ') AS the_month,
    rpad(dayname(o_orderdate), 9, ' ') AS weekday FROM orders"""
)
def calendar_padded(t: Tables) -> DataFrame:
    return t("orders").select(
        "o_orderkey",
        cal.month_name("o_orderdate", padded=True).alias("the_month"),
        cal.weekday_name("o_orderdate", padded=True).alias("weekday"),
    )


@query(f"SELECT event_id, {SQL_PHASE} AS phase FROM (SELECT event_id, nullif(hour(ts), 3) AS hours_utc FROM events)")
def day_phase(t: Tables) -> DataFrame:
    hour = F.nullif(F.hour("ts"), F.lit(3))
    return t("events").select("event_id", cal.day_phase(hour).alias("phase"))


@query(
    f"""SELECT event_id, {sql_seconds(STAMP, 'ts')} AS seconds_field,
    (epoch_us({STAMP}) - epoch_us(ts)) / 1e6 AS elapsed FROM events"""
)
def ingest_latency(t: Tables) -> DataFrame:
    stamp = cal.instant(AS_OF)
    return t("events").select(
        "event_id",
        cal.seconds_field(stamp, "ts").alias("seconds_field"),
        cal.elapsed_seconds(stamp, "ts").alias("elapsed"),
    )


@query("SELECT event_id, cast(ts AS date) AS day FROM events")
def millis_to_date(t: Tables) -> DataFrame:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    millis = F.floor(cal.elapsed_seconds("ts", epoch) * 1000)
    return t("events").select("event_id", cal.date_of_millis(millis).alias("day"))


# Means.


@query(sql_wide(STATION, "air_quality_value", SQL_PHASE_BUCKETS, SQL_POSITIONED))
def phase_avg_wide(t: Tables) -> DataFrame:
    keys = ["cgndb_id", "latitude", "longitude"]
    return aggregate.phase_avg_wide(inputs.positioned_readings(t), keys, "hours_utc", "air_quality_value")


@query(SQL_WEEKDAYS_WIDE)
def weekday_avg_wide(t: Tables) -> DataFrame:
    keys = ["cgndb_id", "latitude", "longitude"]
    return aggregate.weekday_avg_wide(inputs.positioned_readings(t), keys, "the_date", "air_quality_value")


@query(
    f"""SELECT l_suppkey, {sql_mean("nullif(l_discount, 0)")} AS station_avg FROM lineitem WHERE l_discount <> 0
    GROUP BY l_suppkey"""
)
def station_avg(t: Tables) -> DataFrame:
    rows = t("lineitem").select("l_suppkey", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"))
    return aggregate.station_avg(rows, ["l_suppkey"], "l_discount")


@query(
    f"""SELECT o_custkey, dayname(o_orderdate) AS weekday,
    cast(round_even({sql_settled('o_totalprice')}, 0) AS int) AS volume_avg FROM orders GROUP BY ALL"""
)
def weekday_volume_avg(t: Tables) -> DataFrame:
    return aggregate.weekday_volume_avg(t("orders"), ["o_custkey"], "o_orderdate", "o_totalprice")


@query(
    f"""SELECT l_suppkey, rpad(dayname(l_shipdate), 9, ' ') AS weekday,
    cast(round_even({sql_settled('l_quantity')}, 0) AS int) AS volume_avg FROM lineitem GROUP BY ALL"""
)
def weekday_volume_avg_b(t: Tables) -> DataFrame:
    return aggregate.weekday_volume_avg(t("lineitem"), ["l_suppkey"], "l_shipdate", "l_quantity", padded=True)


SQL_HOURLY_AVG = f"""WITH combined AS ({sql_combined(SQL_READINGS, 'the_date, hours_utc, cgndb_id')})
    {sql_wide(STATION, 'air_quality_value', SQL_PHASE_BUCKETS, 'SELECT * FROM combined')}"""


@query(SQL_HOURLY_AVG)
def hourly_avg(t: Tables) -> DataFrame:
    """Flagship: readings to newest per hour, joined with their place, to phase means per station."""
    keys = ["cgndb_id", "latitude", "longitude"]
    return aggregate.phase_avg_wide(combined_readings(t), keys, "hours_utc", "air_quality_value")


@query(
    """SELECT min(longitude) AS min_longitude, min(latitude) AS min_latitude, max(longitude) AS max_longitude,
    max(latitude) AS max_latitude, round(avg(latitude), 6) AS center_latitude,
    round(avg(longitude), 6) AS center_longitude FROM ("""
    + SQL_COUNTS
    + ")"
)
def bbox_center(t: Tables) -> DataFrame:
    box = aggregate.bbox_center(inputs.intersections(t))
    return box.withColumns({c: F.round(c, 6) for c in ("center_latitude", "center_longitude")})


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_keys(t: Tables) -> DataFrame:
    return aggregate.distinct_keys(t("events"), ["user_id", "event_type"])


@query(
    """SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1"""
)
def first_attr_per_key(t: Tables) -> DataFrame:
    return aggregate.first_attr_per_key(t("events"), ["user_id"], ["event_type", "value"], ["ts", "event_id"])


@query(
    """SELECT c_nationkey, min(c_custkey) AS first_custkey, max(c_custkey) AS last_custkey FROM customer
    GROUP BY c_nationkey HAVING min(c_custkey) <> max(c_custkey)"""
)
def stations_with_many_positions(t: Tables) -> DataFrame:
    found = aggregate.stations_with_many_positions(t("customer"), "c_nationkey", "c_custkey", "c_custkey")
    return found.select(
        "c_nationkey",
        F.col("first_position.latitude").alias("first_custkey"),
        F.col("last_position.latitude").alias("last_custkey"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount * 100 AS d, l_tax * 400 AS x,
    CASE WHEN l_quantity <= l_discount * 100 AND l_quantity <= l_tax * 400 THEN 'l_quantity'
         WHEN l_discount * 100 <= l_tax * 400 THEN 'd' ELSE 'x' END AS fastest FROM lineitem"""
)
def rowwise_argmin(t: Tables) -> DataFrame:
    measures = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        (F.col("l_discount") * 100).alias("d"),
        (F.col("l_tax") * 400).alias("x"),
    )
    return runlog.fastest_browser(measures, ["l_quantity", "d", "x"])


# Rows, names and lineage.


@query("SELECT * FROM customer WHERE upper(c_mktsegment) IN ('MACHINERY', 'BUILDING')")
def station_subset(t: Tables) -> DataFrame:
    return clean.keep_stations(t("customer"), "c_mktsegment", ["machinery", "Building"])


@query(
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"""
)
def station_subset_semi(t: Tables) -> DataFrame:
    wanted = t("customer").where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").cast("string"))
    orders = t("orders").select("o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("name"))
    return clean.keep_stations(orders, "name", wanted).drop("name")


@query(
    """SELECT * FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
    nullif(o_orderpriority, '2-HIGH') AS o_orderpriority FROM orders)
    WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL"""
)
def drop_any_null(t: Tables) -> DataFrame:
    orders = t("orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("o_orderpriority"),
    )
    return clean.drop_any_null(orders)


@query("SELECT p_partkey AS part_id, p_name, p_retailprice AS retail_price FROM part")
def normalize_columns(t: Tables) -> DataFrame:
    raw = t("part").select(
        F.col("p_partkey").alias("Part ID"), F.col("p_name").alias("P_NAME"), F.col("p_retailprice").alias("Price")
    )
    return clean.normalize_columns(raw, {"price": "retail_price"})


@query(
    f"""SELECT c_custkey, {STAMP} AS last_updated, 'http://x/' || c_mktsegment AS download_link,
    'customer.csv' AS src_filename, {EST} AS last_inserted FROM customer"""
)
def lineage_stamp(t: Tables) -> DataFrame:
    link = F.concat(F.lit("http://x/"), "c_mktsegment")
    rows = t("customer").select("c_custkey", link.alias("link"))
    stamped = clean.lineage_stamp(rows, AS_OF, F.col("link"), "customer.csv").drop("link")
    return clean.insertion_stamp(stamped, AS_OF)


@query("SELECT * FROM documents WHERE lower(lang) = 'fr' ORDER BY doc_id LIMIT 1")
def first_matching(t: Tables) -> DataFrame:
    return clean.first_matching(t("documents"), F.lower("lang").isin("fr"), "doc_id")


@query(
    """SELECT c_custkey, c_name AS "name", c_nationkey AS nationkey, c_mktsegment, NULL AS s_suppkey FROM customer
    UNION ALL SELECT NULL, s_name, s_nationkey, NULL, s_suppkey FROM supplier"""
)
def union_by_name(t: Tables) -> DataFrame:
    customers = t("customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), "c_mktsegment"
    )
    suppliers = t("supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name")
    )
    return clean.union_by_name([customers, suppliers])


@query(
    """SELECT p_partkey, p_name FROM part WHERE p_name NOT LIKE '%ring%' AND p_name NOT LIKE 'red%'
    AND p_name NOT IN ('blue bolt')"""
)
def catalog_filter(t: Tables) -> DataFrame:
    return clean.filter_names(t("part").select("p_partkey", "p_name"), "p_name", ["%ring%", "red%"], ["blue bolt"])


@query(
    """SELECT p_partkey, CASE WHEN upper(p_name) LIKE '%BOLT%' THEN 'folium' WHEN upper(p_name) LIKE '%RING%' THEN 'turf'
    WHEN upper(p_name) LIKE '%RED%' THEN 'mapbox' ELSE 'unknown' END AS map_type FROM part"""
)
def map_kind(t: Tables) -> DataFrame:
    kinds = (("BOLT", "folium"), ("RING", "turf"), ("RED", "mapbox"))
    kind = text.keyword_label("p_name", kinds, fixed.UNKNOWN_MAP_KIND)
    return t("part").select("p_partkey", kind.alias("map_type"))


# Sources.

SQL_LINKS = r"""WITH tags AS (SELECT page_id, url, regexp_extract_all(regexp_replace(html,
    '(?is)<!--.*?-->|<script\b.*?</script>', '', 'g'), '(?i)<a\s(?:"[^"]*"|''[^'']*''|[^>"''])*>') AS tags FROM pages),
    written AS (SELECT page_id, url, list_transform(tags, lambda x: CASE
        WHEN regexp_matches(x, '(?i)\shref\s*=\s*"([^"]*)"') THEN regexp_extract(x, '(?i)\shref\s*=\s*"([^"]*)"', 1)
        WHEN regexp_matches(x, '(?i)\shref\s*=\s*''([^'']*)''') THEN regexp_extract(x, '(?i)\shref\s*=\s*''([^'']*)''', 1)
        WHEN regexp_matches(x, '(?i)\shref\s*=\s*([^\s"''>]+)') THEN regexp_extract(x, '(?i)\shref\s*=\s*([^\s"''>]+)', 1)
        END) AS hrefs FROM tags),
    hrefs AS (SELECT page_id, url, list_filter(list_transform(hrefs, lambda h: replace(replace(replace(replace(replace(replace(
        h, '&#46;', '.'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&')),
        lambda h: contains(h, '{0}')) AS hrefs FROM written)
    SELECT page_id, url, link_no, hrefs[link_no] AS href, url || hrefs[link_no] AS download_link
    FROM (SELECT *, unnest(cast(range(1, len(hrefs) + 1) AS int[])) AS link_no FROM hrefs)"""


@query(SQL_LINKS.format(""))
def extract_links(t: Tables) -> DataFrame:
    return links.extract_links(t("pages"), containing="")


@query(SQL_LINKS.format("."))
def extract_links_by_suffix(t: Tables) -> DataFrame:
    return links.extract_links(t("pages"), containing=".")


@query(
    """SELECT 'lineitem.parquet' AS file_name, count(*) AS n_rows FROM lineitem UNION ALL
    SELECT 'orders.parquet', count(*) FROM orders"""
)
def rows_per_file(t: Tables) -> DataFrame:
    return clean.union_by_name([files.rows_per_file(t("lineitem")), files.rows_per_file(t("orders"))])


@query(
    """WITH lines AS (SELECT cast(o_orderkey % 5 AS int) AS file, o_orderkey || ';' ||
        CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE o_custkey::varchar END || ';' || floor(o_totalprice)::bigint || '.5' ||
        CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE ';"' || o_orderpriority || ', ' || repeat(chr(34), 2) || 'x' || repeat(chr(34), 3) END AS line
        FROM orders)
    SELECT file, sum(strlen(line) + 1)::bigint + any_value(strlen(CASE WHEN file = 4 THEN 'o_orderkey;o_custkey;o_totalprice;urgency'
        ELSE 'o_orderkey;o_custkey;o_totalprice;priority' END)) + 1 AS n_bytes FROM lines GROUP BY file"""
)
def list_files(t: Tables) -> DataFrame:
    """Sizes of text files that the orders were written to, from a listing that reads none of them."""
    path = scratch_path(t.spark, "listed")
    inputs.write_lines(inputs.faulty_orders(t), path)
    listed = files.list_files(t.spark, path, "*.txt")
    return listed.select(_file_number("path"), F.col("length").alias("n_bytes"))


@query(" UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in ("customer", "orders", "supplier")))
def catalog_rows(t: Tables) -> DataFrame:
    """Rows of the tables that a filtered scan of the catalogue finds; the loop is over their names."""
    with _own_database(t.spark) as database:
        for name in ("customer", "lineitem", "nation", "orders", "part", "region", "supplier"):
            t.spark.sql(f"CREATE VIEW {database}.{name} AS SELECT * FROM parquet.`{t.folder}/{name}.parquet`")
        names = [r[0] for r in catalog_tables(t.spark, database, ["%n%"], ["part"]).collect()]
        counts = [t.spark.table(f"{database}.{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n_rows")) for n in names]
        return clean.union_by_name(counts)


@contextmanager
def _own_database(spark: SparkSession) -> Iterator[str]:
    """A database for the time of one query's making. Frames made of its tables know their files and outlive it."""
    name = f"given_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


@query("SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def table_round_trip(t: Tables) -> DataFrame:
    """Customers as a table that is replaced twice and read back."""
    kept = t("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    root = scratch_path(t.spark, "tables")
    with _own_database(t.spark) as database:
        sink.replace_table(kept.limit(0), f"{database}.customers", root)
        sink.replace_table(kept.where("c_custkey % 2 = 0"), f"{database}.customers", root)
        return sink.replace_table(kept, f"{database}.customers", root, ["c_mktsegment"]).select(kept.columns)


CUSTOMERS = schemas.table(
    ("c_custkey", schemas.WHOLE), ("c_name", schemas.TEXT), ("c_acctbal", schemas.NUMBER), ("note", schemas.TEXT)
)
SQL_CUSTOMERS = """SELECT c_custkey, c_name, c_acctbal, c_mktsegment || ', "x"' || chr(10) || 'y' AS note FROM customer"""


def _noted_customers(t: Tables) -> DataFrame:
    return t("customer").select("c_custkey", "c_name", "c_acctbal", F.concat("c_mktsegment", F.lit(', "x"\ny')).alias("note"))


@query(SQL_CUSTOMERS)
def csv_round_trip(t: Tables) -> DataFrame:
    """Customers exported as text with headers and read back; a note has a line break."""
    path = scratch_path(t.spark, "export")
    sink.export_csv(_noted_customers(t), path)
    return files.read_delimited(t.spark, path, CUSTOMERS, multiline=True).drop(files.FILE_NAME)


@query(SQL_CUSTOMERS)
def zipped_round_trip(t: Tables) -> DataFrame:
    """Customers written as zip archives and read back by member."""
    datasource.register(t.spark)
    path = scratch_path(t.spark, "zipped")
    _noted_customers(t).write.format("zipped_csv").mode("overwrite").save(path)
    return t.spark.read.format("zipped_csv").schema(CUSTOMERS).load(path)


ORDERS = schemas.table(
    ("o_orderkey", schemas.WHOLE), ("o_custkey", schemas.WHOLE), ("o_totalprice", schemas.NUMBER), ("priority", schemas.TEXT)
)


def _scanned_orders(t: Tables) -> quarantine.Scanned:
    path = scratch_path(t.spark, "landed")
    inputs.write_lines(inputs.faulty_orders(t), path)
    return quarantine.scan(t.spark, path, ORDERS, scratch_path(t.spark, "scanned"), quarantine.ErrorBudget(0.5), sep=";")


def _file_number(column: str):
    return F.regexp_extract(column, r"file=(\d+)", 1).cast("int").alias("file")


@query(
    """SELECT o_orderkey, o_custkey, floor(o_totalprice) + 0.5::double AS o_totalprice, o_orderpriority || ', "x"' AS priority,
    cast(o_orderkey % 5 AS int) AS file FROM orders WHERE o_orderkey % 5 <> 4 AND o_orderkey % 89 <> 0 AND o_orderkey % 97 <> 0"""
)
def scan_good_rows(t: Tables) -> DataFrame:
    good = _scanned_orders(t).good
    return good.select(*ORDERS.names, _file_number(files.FILE_NAME))


@query(
    """WITH lines AS (SELECT o_orderkey AS k, cast(o_orderkey % 5 AS int) AS file, o_orderkey || ';' ||
        CASE WHEN o_orderkey % 89 = 0 THEN 'n/a' ELSE o_custkey::varchar END || ';' || floor(o_totalprice)::bigint || '.5' ||
        CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE ';"' || o_orderpriority || ', ' || repeat(chr(34), 2) || 'x' || repeat(chr(34), 3) END AS line FROM orders)
    SELECT file, CASE WHEN file = 4 THEN 'header' WHEN k % 97 = 0 THEN 'cells' ELSE 'type' END AS reason, line FROM lines
    WHERE file = 4 OR k % 89 = 0 OR k % 97 = 0
    UNION ALL SELECT DISTINCT file, 'header', 'o_orderkey;o_custkey;o_totalprice;urgency' FROM lines WHERE file = 4"""
)
def scan_bad_lines(t: Tables) -> DataFrame:
    return _scanned_orders(t).bad.select(_file_number(files.FILE_NAME), "reason", "line")


def sql_drifting() -> str:
    """The highest value of each type by date and hour, but for the type that the day's file leaves out."""
    kinds = ", ".join(
        f"max(value) FILTER (WHERE event_type = '{k}' AND day(ts) % 6 % {len(inputs.EVENT_TYPES)} <> {i}) AS {k.upper()}"
        for i, k in enumerate(inputs.EVENT_TYPES)
    )
    return f"""SELECT strftime(ts, '%Y-%m-%d') AS "Date", cast(hour(ts) AS bigint) AS "Hour (UTC)", {kinds},
        cast(day(ts) % 6 AS int) AS file FROM events GROUP BY ALL"""


def _drifting(t: Tables, kind: str) -> DataFrame:
    datasource.register(t.spark)
    path = scratch_path(t.spark, "landed")
    inputs.write_lines(inputs.drifting_readings(t, inputs.event_types(t)), path)
    return t.spark.read.format(kind).option("pattern", "*.txt").option("ids", "Date|Hour (UTC)").load(path)


@query(sql_drifting())
def drifting_round_trip(t: Tables) -> DataFrame:
    """Files whose columns differ as one frame."""
    read = _drifting(t, "drifting_csv").withColumn("Hour (UTC)", F.col("Hour (UTC)").cast("bigint"))
    return read.withColumn("file", _file_number(files.FILE_NAME)).drop(files.FILE_NAME)


@query(
    f"""UNPIVOT (SELECT "Date", "Hour (UTC)"::varchar AS "Hour (UTC)", * EXCLUDE ("Date", "Hour (UTC)", file) FROM ({sql_drifting()}))
    ON {', '.join(k.upper() for k in inputs.EVENT_TYPES)} INTO NAME station VALUE value"""
)
def drifting_long(t: Tables) -> DataFrame:
    return _drifting(t, "drifting_csv_long").drop(files.FILE_NAME)


@query(
    """SELECT c_custkey, c_name, c_acctbal, c_mktsegment || ', "x"' || chr(10) || 'y' AS note FROM customer"""
)
def unzip_csv(t: Tables) -> DataFrame:
    schema = schemas.table(
        ("c_custkey", schemas.WHOLE), ("c_name", schemas.TEXT), ("c_acctbal", schemas.NUMBER), ("note", schemas.TEXT)
    )
    return files.unzip_csv(inputs.zipped_customers(t), schema).drop(files.FILE_NAME)


def _wide_readings(t: Tables) -> DataFrame:
    """Mean event value by date and hour, one column per event type, under the landed names."""
    stations = [
        F.max(F.when(F.col("event_type") == kind, F.col("value"))).alias(kind.upper()) for kind in inputs.event_types(t)
    ]
    grouped = t("events").groupBy(F.to_date("ts").alias("Date"), F.hour("ts").alias("Hour (UTC)"))
    return grouped.agg(*stations).withColumn(files.FILE_NAME, F.lit("landing/air.csv"))


SQL_WIDE = f"""SELECT cast(ts AS date) AS the_date, cast(hour(ts) AS bigint) AS hours_utc,
    {', '.join(f"max(value) FILTER (WHERE event_type = '{k}') AS {k.upper()}" for k in inputs.EVENT_TYPES)},
    'landing/air.csv' AS src_filename, {STAMP} AS last_updated, 'http://air/air.csv' AS download_link
    FROM events GROUP BY 1, 2"""


@query(SQL_WIDE)
def stage_air_wide(t: Tables) -> DataFrame:
    return staging.conform_air_wide(_wide_readings(t), AS_OF, "http://air/")


@query(
    f"""UNPIVOT (SELECT * FROM ({SQL_WIDE})) ON {', '.join(k.upper() for k in inputs.EVENT_TYPES)}
    INTO NAME cgndb_id VALUE air_quality_value"""
)
def stage_air_long(t: Tables) -> DataFrame:
    return reshape.unpivot_stations(stage_air_wide(t))


@query(
    f"""SELECT 'st' || user_id AS cgndb_code, event_type AS community_name, cast(ts AS date) AS validity_date,
    strftime(ts, '%H:%M:%S') AS validity_time_utc, event_id AS period, cast(floor(value) AS bigint) AS value,
    cast(0 AS bigint) AS amended, event_type || '.csv' AS src_filename, {STAMP} AS last_updated,
    'http://ahead/' || event_type || '.csv' AS download_link FROM events"""
)
def stage_forecasts(t: Tables) -> DataFrame:
    raw = t("events").select(
        F.concat(F.lit("st"), "user_id").alias("cgndb code"),
        F.col("event_type").alias("community name"),
        F.col("ts").alias("validity date"),
        F.date_format("ts", "HH:mm:ss").alias("validity time (UTC)"),
        F.col("event_id").alias("period"),
        F.floor("value").alias("value"),
        F.lit(0).cast("bigint").alias("amended?"),
        F.concat("event_type", F.lit(".csv")).alias(files.FILE_NAME),
    )
    return staging.conform_forecasts(raw, AS_OF, "http://ahead/")


@query(SQL_PLACES)
def stage_geo_names(t: Tables) -> DataFrame:
    return staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places")


@query(
    f"""SELECT *, 'landing/counts.txt' AS src_filename, {STAMP} AS last_updated, 'http://counts' AS download_link FROM (
    SELECT *, cast(count_date - 365 AS date) AS activation_date FROM ({SQL_COUNTS}))"""
)
def stage_intersection_counts(t: Tables) -> DataFrame:
    counts = inputs.intersections(t).withColumn("activation_date", F.date_sub("count_date", 365))
    raw = counts.toDF(*[c.upper() for c in counts.columns]).withColumn(files.FILE_NAME, F.lit("landing/counts.txt"))
    return staging.conform_intersection_counts(raw, AS_OF, "http://counts")


@query(
    f"""SELECT o_orderkey AS "X_id", o_custkey AS location_id, strftime(o_orderdate, '%Y-%m-%d') AS count_date,
    'landing/volume.csv' AS src_filename, {STAMP} AS last_updated, 'http://volume' AS download_link FROM orders"""
)
def stage_traffic_volume(t: Tables) -> DataFrame:
    raw = t("orders").select(
        F.col("o_orderkey").alias("X_id"),
        F.col("o_custkey").alias("location_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("count_date"),
        F.lit("landing/volume.csv").alias(files.FILE_NAME),
    )
    return staging.conform_traffic_volume(raw, AS_OF, "http://volume")


# Points and layers.


@query(
    f"""WITH combined AS ({sql_combined(SQL_READINGS, 'the_date, hours_utc, cgndb_id')})
    SELECT *, longitude AS x, latitude AS y, 26917 AS srid FROM combined
    WHERE cgndb_id IN (SELECT 'ST' || c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')"""
)
def projected_readings(t: Tables) -> DataFrame:
    wanted = t("customer").where("c_mktsegment = 'MACHINERY'").select(F.concat(F.lit("st"), "c_custkey"))
    chosen = warehouse.projected_air(combined_readings(t), wanted, fixed.SRID_UTM17)
    return chosen.select("*", "geom.x", "geom.y", "geom.srid").drop("geom")


@query(
    f"""SELECT objectid, longitude AS x, latitude AS y, 26917 AS srid, 4326 AS true_srid,
    dayname(count_date) AS weekday FROM ({SQL_COUNTS})"""
)
def point_layer(t: Tables) -> DataFrame:
    points = geo.add_point(inputs.intersections(t))
    labelled = geo.relabel("geom", fixed.SRID_UTM17)
    return points.select(
        "objectid",
        F.col("geom.x").alias("x"),
        F.col("geom.y").alias("y"),
        labelled["srid"].alias("srid"),
        F.col("geom.srid").alias("true_srid"),
        cal.weekday_name("count_date").alias("weekday"),
    )


def sql_double_hex(value: str) -> str:
    """Hex of a double's eight bytes, lowest first, from its sign, exponent and fraction."""
    exponent = f"cast(floor(log2(abs({value}))) AS int)"
    fraction = f"cast((abs({value}) / pow(2, {exponent}) - 1) * pow(2, 52) AS ubigint)"
    sign = f"CASE WHEN {value} < 0 THEN 9223372036854775808::ubigint ELSE 0::ubigint END"
    bits = f"{sign} + cast({exponent} + 1023 AS ubigint) * 4503599627370496::ubigint + {fraction}"
    swapped = "string_agg(substr(h, 15 - 2 * i, 2), '' ORDER BY i)"
    return f"(SELECT {swapped} FROM (SELECT upper(hex({bits})) AS h), range(8) r(i))"


@query(
    f"""SELECT c_custkey, '0101000020E6100000' || {sql_double_hex('longitude')} || {sql_double_hex('latitude')} AS geom_hex
    FROM (SELECT c_custkey, {sql_position('c_custkey')} FROM customer)"""
)
def point_hex(t: Tables) -> DataFrame:
    point = geo.point(inputs.longitude("c_custkey"), inputs.latitude("c_custkey")).alias("p")
    places = t("customer").select("c_custkey", point)
    return places.select("c_custkey", geo.ewkb_hex("p").alias("geom_hex"))


def sql_utm() -> str:
    """Transverse Mercator of degrees around 81 degrees west, by the Krueger series."""
    n = "0.0016792203946287446"
    e = "0.08181919104281579"
    alphas = (
        f"({n} / 2 - 2 * pow({n}, 2) / 3 + 5 * pow({n}, 3) / 16)",
        f"(13 * pow({n}, 2) / 48 - 3 * pow({n}, 3) / 5)",
        f"(61 * pow({n}, 3) / 240)",
    )
    east = " + ".join(f"{a} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(alphas, 1))
    north = " + ".join(f"{a} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(alphas, 1))
    radius = f"(6378137.0 / (1 + {n}) * (1 + pow({n}, 2) / 4 + pow({n}, 4) / 64) * 0.9996)"
    return f"""WITH angles AS (SELECT *, radians(latitude) AS phi, radians(longitude + 81) AS lam FROM ({SQL_COUNTS})),
        spheres AS (SELECT *, sinh(atanh(sin(phi)) - {e} * atanh({e} * sin(phi))) AS t FROM angles),
        plane AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM spheres)
        SELECT objectid, latitude, longitude, round(500000 + {radius} * (eta + {east}), 3) AS x,
        round({radius} * (xi + {north}), 3) AS y, 26917 AS srid FROM plane"""


@query(sql_utm())
def utm_project(t: Tables) -> DataFrame:
    places = geo.add_point(inputs.intersections(t)).withColumn("utm", geo.to_utm17("geom"))
    metres = [F.round(f"utm.{axis}", 3).alias(axis) for axis in ("x", "y")]
    return places.select("objectid", "latitude", "longitude", *metres, "utm.srid")


@query(
    f"""SELECT cast(floor(latitude / 0.05) AS bigint) AS lat_cell, cast(floor(longitude / 0.05) AS bigint) AS lon_cell,
    count(*) AS n_points, round(avg(f8hr_vehicle_volume), 4) AS mean_value FROM ({SQL_COUNTS}) GROUP BY 1, 2"""
)
def grid_density(t: Tables) -> DataFrame:
    grid = geo.grid_density(inputs.intersections(t), 0.05, value="f8hr_vehicle_volume")
    return grid.withColumn("mean_value", F.round("mean_value", 4))


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN l_quantity > m THEN 'red'
    WHEN l_quantity < m THEN 'green' ELSE 'black' END AS marker_class
    FROM lineitem, (SELECT trunc({sql_settled('l_quantity')}) AS m FROM lineitem)"""
)
def classify_vs_mean(t: Tables) -> DataFrame:
    rows = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return layers.classify_vs_mean(rows, "l_quantity")


@query(
    f"""SELECT cgndb_id, latitude, longitude, CASE WHEN air_quality_value > m THEN 'red' WHEN air_quality_value < m
    THEN 'green' ELSE 'black' END AS marker_class, 'Air Quality Measure: ' || air_quality_value || '; Name: '
    || event_type || '; Date: ' || cast(the_date AS varchar) || '; Phase: ' || {SQL_PHASE} AS popup
    FROM ({SQL_POSITIONED}), (SELECT trunc({sql_settled('value')}) AS m FROM events)"""
)
def air_marker_layer(t: Tables) -> DataFrame:
    label = layers.air_label("air_quality_value", "event_type", "the_date", cal.day_phase("hours_utc"))
    return layers.marker_layer(inputs.positioned_readings(t), "air_quality_value", label, keys=["cgndb_id"])


SQL_MARKER = """SELECT objectid, latitude, longitude, CASE WHEN {value} > m THEN 'red' WHEN {value} < m THEN 'green'
    ELSE 'black' END AS marker_class, {popup} AS popup FROM ({source}),
    (SELECT trunc(cast(printf('%.14e', avg({of})) AS double)) AS m FROM {table})"""


@query(
    SQL_MARKER.format(
        value="f8hr_vehicle_volume",
        popup="""'Traffic Volume: ' || cast(round_even(f8hr_vehicle_volume, 0) AS bigint) || '; Date: '
        || cast(count_date AS varchar) || '; Main Stn: ' || main""",
        source=SQL_COUNTS,
        of="o_totalprice",
        table="orders",
    )
)
def marker_layer(t: Tables) -> DataFrame:
    label = layers.volume_label("Traffic Volume", "f8hr_vehicle_volume", "count_date", "main")
    return layers.marker_layer(inputs.intersections(t), "f8hr_vehicle_volume", label, keys=["objectid"])


@query(
    SQL_MARKER.format(
        value="f8hr_pedestrian_volume",
        popup="""'Pedestrian Volume: ' || cast(round_even(f8hr_pedestrian_volume, 0) AS bigint) || '; Date: '
        || cast(count_date AS varchar) || '; Main Stn: ' || main""",
        source=SQL_COUNTS,
        of="o_orderkey % 1000 / 3",
        table="orders",
    )
)
def pedestrian_marker_layer(t: Tables) -> DataFrame:
    label = layers.volume_label("Pedestrian Volume", "f8hr_pedestrian_volume", "count_date", "main")
    return layers.marker_layer(inputs.intersections(t), "f8hr_pedestrian_volume", label, keys=["objectid"])


@query(
    SQL_MARKER.format(
        value="f8hr_vehicle_volume",
        popup="""'Predicted Traffic: ' || f8hr_vehicle_volume || '; Future Date: '
        || cast(count_date AS varchar) || '; Name: ' || main""",
        source=SQL_COUNTS,
        of="l_extendedprice",
        table="lineitem",
    )
)
def marker_layer_vs_actual(t: Tables) -> DataFrame:
    label = layers.prediction_label("Predicted Traffic", "f8hr_vehicle_volume", "count_date", "main")
    return layers.marker_layer(
        inputs.intersections(t),
        "f8hr_vehicle_volume",
        label,
        keys=["objectid"],
        reference=t("lineitem"),
        reference_value="l_extendedprice",
    )


@query(f"SELECT latitude, longitude, f8hr_pedestrian_volume AS weight FROM ({SQL_COUNTS})")
def heat_layer(t: Tables) -> DataFrame:
    return layers.heat_layer(inputs.intersections(t), "f8hr_pedestrian_volume")


@query(
    f"""SELECT the_date AS frame_date, latitude AS lat, longitude AS lon, air_quality_value AS weight, count(*) AS copies
    FROM ({SQL_POSITIONED}) GROUP BY ALL"""
)
def daily_frames(t: Tables) -> DataFrame:
    return layers.daily_frames(inputs.positioned_readings(t), "the_date", "air_quality_value")


@query(
    f"""SELECT cgndb_id, '[' || {" || ',' || ".join(
        f"'{{\"weekday\":\"{d.title()}\",\"weekday_avg\":' || {d}_avg || '}}'" for d in DAYS)} || ']' AS chart
    FROM ({SQL_WEEKDAYS_WIDE})"""
)
def weekday_charts(t: Tables) -> DataFrame:
    return layers.weekday_charts(weekday_avg_wide(t), ["cgndb_id"])


@query(
    f"""SELECT '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || longitude || ',' || latitude
    || ']}},"properties":{{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}}}}' AS feature
    FROM (SELECT c_custkey, c_mktsegment, {sql_position('c_custkey')} FROM customer)"""
)
def geojson_features(t: Tables) -> DataFrame:
    position = [inputs.latitude("c_custkey"), inputs.longitude("c_custkey")]
    places = t("customer").select("c_custkey", "c_mktsegment", *position)
    return layers.geojson_features(places, ["c_custkey", "c_mktsegment"])


# Forecasts.


def sql_grid(first: str, step: str, kind: str = "date") -> str:
    return f"""WITH bound AS (SELECT max(o_orderdate) + INTERVAL 108 MONTH AS s FROM orders),
    places AS (SELECT objectid, tcs__, main, latitude, longitude FROM (SELECT *, row_number() OVER (
        PARTITION BY objectid ORDER BY count_date, tcs__, main) AS rn FROM ({SQL_COUNTS})) WHERE rn = 1)
    SELECT objectid, tcs__, main, latitude, longitude, cast({first} + {step} AS {kind}) AS future_date
    FROM places, bound, range(30) AS periods(i)"""


def _rolled(unit: str) -> str:
    return f"(CASE WHEN date_trunc('{unit}', s) = s THEN s ELSE date_trunc('{unit}', s) + INTERVAL 1 {unit} END)"


def _grid(t: Tables, frequency: str) -> DataFrame:
    attributes = ["tcs__", "main", "latitude", "longitude"]
    return forecast.horizon_grid(inputs.intersections(t), "objectid", "count_date", attributes, frequency, 30)


@query(sql_grid("s", "to_days(cast(i AS int))"))
def horizon_grid(t: Tables) -> DataFrame:
    return _grid(t, "Daily")


@query(sql_grid("s", "to_hours(i)", "timestamp"))
def horizon_grid_hourly(t: Tables) -> DataFrame:
    return _grid(t, "Hourly")


@query(sql_grid(_rolled("month"), "to_months(cast(i AS int))"))
def horizon_grid_monthly(t: Tables) -> DataFrame:
    return _grid(t, "Month")


@query(sql_grid(_rolled("quarter"), "to_months(cast(3 * i AS int))"))
def horizon_grid_quarterly(t: Tables) -> DataFrame:
    return _grid(t, "Quarterly")


@query(sql_grid(_rolled("year"), "to_months(cast(12 * i AS int))"))
def horizon_grid_yearly(t: Tables) -> DataFrame:
    return _grid(t, "Annual")


@query(
    f"""SELECT g.* EXCLUDE (tcs__), first.tcs__ FROM ({sql_grid("s", "to_days(cast(i AS int))")}) g,
    (SELECT tcs__ FROM ({SQL_COUNTS}) ORDER BY count_date, objectid, tcs__ LIMIT 1) first"""
)
def horizon_grid_table_wide(t: Tables) -> DataFrame:
    """The published grid takes one attribute from the first row of the whole table."""
    attributes = ["tcs__", "main", "latitude", "longitude"]
    counts = inputs.intersections(t)
    return forecast.horizon_grid(counts, "objectid", "count_date", attributes, "Daily", 30, table_wide=["tcs__"])


def sql_training(label: str) -> str:
    return f"""SELECT objectid, tcs__, main, latitude, longitude, count_date, {label},
    (16 * (instr('0123456789abcdef', h[1]) - 1) + instr('0123456789abcdef', h[2]) - 1) % 5 AS fold
    FROM (SELECT *, md5(concat_ws('|', objectid, count_date, floor({label})::bigint)) AS h FROM ({SQL_COUNTS}))"""


def sql_smoothed(category: str, label: str) -> str:
    """Smoothed means of one category, over all rows and over the rows of other folds."""
    over = f"(PARTITION BY {category})"
    fold = f"(PARTITION BY {category}, fold)"
    return f"""(sum({label}) OVER {over} + 10.0 * prior) / (count(*) OVER {over} + 10.0) AS {category}_mean_all,
    (sum({label}) OVER {over} - sum({label}) OVER {fold} + 10.0 * prior)
        / (count(*) OVER {over} - count(*) OVER {fold} + 10.0) AS {category}_mean"""


SQL_SETTLED_MEANS = ", ".join(
    f"printf('%.9e', {c}_mean{part}) AS {c}_mean{part}" for c in ("objectid", "tcs__", "main") for part in ("", "_all")
)


def sql_features(label: str) -> str:
    smoothed = ", ".join(sql_smoothed(c, label) for c in ("objectid", "tcs__", "main"))
    return f"""SELECT objectid, count_date, {label}, cast(fold AS int) AS fold, {SQL_SETTLED_MEANS} FROM (
    SELECT *, {smoothed} FROM ({sql_training(label)}), (SELECT avg({label}) AS prior FROM ({SQL_COUNTS})))"""


def _features(t: Tables, label: str) -> DataFrame:
    """Category means to ten digits, whatever order a cluster adds the labels in."""
    found = forecast.forecast_features(inputs.intersections(t), forecast.traffic_series(label))
    means = [f"{c}_mean{part}" for c in ("objectid", "tcs__", "main") for part in ("", "_all")]
    settled = [F.format_string("%.9e", F.col(m)).alias(m) for m in means]
    return found.select("objectid", "count_date", label, F.col("fold").cast("int").alias("fold"), *settled)


@query(sql_features("f8hr_vehicle_volume"))
def forecast_features(t: Tables) -> DataFrame:
    return _features(t, "f8hr_vehicle_volume")


@query(sql_features("f8hr_pedestrian_volume"))
def forecast_pedestrians_features(t: Tables) -> DataFrame:
    return _features(t, "f8hr_pedestrian_volume")


SQL_CUT = f"""SELECT min(count_date) AS cut FROM (SELECT count_date, sum(count(*)) OVER (ORDER BY count_date) AS met,
    max(count_date) OVER () AS last, (SELECT count(*) FROM ({SQL_COUNTS})) AS total FROM ({SQL_COUNTS}) GROUP BY count_date)
    WHERE met >= 0.8 * total AND count_date < last"""


@query(
    f"""SELECT CASE WHEN count_date <= cut THEN 'older' ELSE 'newest' END AS side, count(*) AS n_rows,
    min(count_date) AS first_date, max(count_date) AS last_date FROM ({SQL_COUNTS}), ({SQL_CUT}) GROUP BY side"""
)
def forecast_split(t: Tables) -> DataFrame:
    return forecast.forecast_split(inputs.intersections(t), forecast.traffic_series("f8hr_vehicle_volume"))


def sql_trend(label: str, predicted: str) -> str:
    return f"""WITH rows AS (SELECT objectid AS k, {label} AS y, count_date - (SELECT min(count_date) FROM ({SQL_COUNTS})) AS x
        FROM ({SQL_COUNTS})),
    lines AS (SELECT k, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base, avg(y) AS mean, count(DISTINCT x) AS days
        FROM rows GROUP BY k)
    SELECT objectid, tcs__, main, latitude, longitude, future_date, cast(round_even(CASE WHEN days > 1
        THEN base + slope * (future_date - (SELECT min(count_date) FROM ({SQL_COUNTS}))) ELSE mean END, 0) AS bigint)
        AS {predicted}, {EST} AS last_inserted FROM ({sql_grid("s", "to_days(cast(i AS int))")}) JOIN lines ON objectid = k"""


@query(sql_trend("f8hr_vehicle_volume", "predicted_traffic"))
def forecast_trend(t: Tables) -> DataFrame:
    series = forecast.traffic_series("f8hr_vehicle_volume")
    return forecast.forecast_trend(inputs.intersections(t), series, "predicted_traffic", AS_OF)


@query(sql_trend("f8hr_pedestrian_volume", "predicted_pedestrians"))
def forecast_pedestrians_trend(t: Tables) -> DataFrame:
    series = forecast.traffic_series("f8hr_pedestrian_volume")
    return forecast.forecast_trend(inputs.intersections(t), series, "predicted_pedestrians", AS_OF)


SQL_FORECAST_KEYS = f"""SELECT objectid, tcs__, main, latitude, longitude, future_date, {EST} AS last_inserted
    FROM ({sql_grid("s", "to_days(cast(i AS int))")})"""


@query(SQL_FORECAST_KEYS)
def forecast_volume_keys(t: Tables) -> DataFrame:
    """All of the forecast table but the fitted numbers."""
    return forecast_volume(t).drop("predicted_traffic")


@query()
def forecast_volume(t: Tables) -> DataFrame:
    series = forecast.traffic_series("f8hr_vehicle_volume")
    return forecast.forecast_volume(inputs.intersections(t), series, "predicted_traffic", AS_OF)


@query()
def forecast_pedestrians(t: Tables) -> DataFrame:
    series = forecast.traffic_series("f8hr_pedestrian_volume")
    return forecast.forecast_volume(inputs.intersections(t), series, "predicted_pedestrians", AS_OF)


@query()
def forecast_leaderboard(t: Tables) -> DataFrame:
    series = forecast.traffic_series("f8hr_vehicle_volume")
    return forecast.forecast_leaderboard(inputs.intersections(t), series)


@query(SQL_FORECAST_KEYS)
def forecast_pedestrians_keys(t: Tables) -> DataFrame:
    """All of the second target's forecast table but the fitted numbers."""
    return forecast_pedestrians(t).drop("predicted_pedestrians")


# Model search on time-ordered folds.

SQL_FOLD_ENDS = f"""SELECT percent, min(count_date) AS ends FROM (SELECT count_date, sum(count(*)) OVER (ORDER BY count_date) AS met,
    (SELECT count(*) FROM ({SQL_COUNTS})) AS total FROM ({SQL_COUNTS}) GROUP BY count_date), (VALUES (40), (60), (80), (100)) p(percent)
    WHERE 100 * met >= percent * total GROUP BY percent"""

SQL_FOLD_OF = f"""cast((SELECT count(DISTINCT ends) FROM ({SQL_FOLD_ENDS}) WHERE ends < count_date) AS int)"""


@query(
    f"""WITH parts AS (SELECT {SQL_FOLD_OF} AS fold, count(*) AS n, min(count_date) AS first, max(count_date) AS last
        FROM ({SQL_COUNTS}) GROUP BY 1)
    SELECT fold, cast(sum(n) OVER earlier AS bigint) AS n_train, n AS n_test, max(last) OVER earlier AS train_last,
        first AS test_first, last AS test_last FROM parts
    WINDOW earlier AS (ORDER BY fold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) QUALIFY fold > 0"""
)
def forecast_folds(t: Tables) -> DataFrame:
    return model_search.folds(inputs.intersections(t), forecast.traffic_series("f8hr_vehicle_volume"))


def sql_trend_errors(label: str) -> str:
    return f"""WITH counted AS (SELECT objectid AS k, {label} AS y, {SQL_FOLD_OF} AS fold,
        count_date - (SELECT min(count_date) FROM ({SQL_COUNTS})) AS x FROM ({SQL_COUNTS})),
    asked AS (SELECT DISTINCT fold AS ahead FROM counted WHERE fold > 0),
    lines AS (SELECT ahead, k, regr_slope(y, x) AS slope, regr_intercept(y, x) AS base, avg(y) AS mean, count(DISTINCT x) AS days
        FROM counted, asked WHERE fold < ahead GROUP BY ALL),
    overall AS (SELECT ahead, avg(y) AS mean FROM counted, asked WHERE fold < ahead GROUP BY ahead),
    wrong AS (SELECT c.fold, CASE WHEN days > 1 THEN base + slope * x ELSE coalesce(l.mean, o.mean) END - y AS e FROM counted c
        JOIN overall o ON o.ahead = c.fold LEFT JOIN lines l ON l.ahead = c.fold AND l.k = c.k)
    SELECT fold, count(*) AS n_test, printf('%.6e', sqrt(avg(e * e))) AS rmse, printf('%.6e', avg(abs(e))) AS mae
    FROM wrong GROUP BY fold"""


def _trend_errors(t: Tables, label: str) -> DataFrame:
    found = model_search.trend_errors(inputs.intersections(t), forecast.traffic_series(label))
    return found.select("fold", "n_test", *(F.format_string("%.6e", F.col(c)).alias(c) for c in ("rmse", "mae")))


@query(sql_trend_errors("f8hr_vehicle_volume"))
def forecast_trend_errors(t: Tables) -> DataFrame:
    return _trend_errors(t, "f8hr_vehicle_volume")


@query(sql_trend_errors("f8hr_pedestrian_volume"))
def forecast_pedestrians_trend_errors(t: Tables) -> DataFrame:
    return _trend_errors(t, "f8hr_pedestrian_volume")


@query()
def forecast_search(t: Tables) -> DataFrame:
    """Errors of each model, its parameters and the stack on each fold."""
    return model_search.leaderboard(inputs.intersections(t), forecast.traffic_series("f8hr_vehicle_volume"))


@query()
def forecast_stacked(t: Tables) -> DataFrame:
    """The forecast table by the leader of the search."""
    series = forecast.traffic_series("f8hr_vehicle_volume")
    return model_search.forecast_by_search(inputs.intersections(t), series, "predicted_traffic", AS_OF)


# Run log.

SQL_LOG = """SELECT 'production' AS phase, event_type || '.sql' AS step_name, value AS duration_seconds,
    ts AS start_time, ts + INTERVAL 1 MINUTE AS end_time, 1.0::double AS files_processed FROM events
    WHERE event_type <> 'error' UNION ALL
    SELECT 'stage', 'extract_' || o_orderpriority, o_totalprice, o_orderdate, o_orderdate + INTERVAL 1 MINUTE,
    o_custkey::double FROM orders"""


def _steps(t: Tables) -> DataFrame:
    minute = F.expr("INTERVAL '1' MINUTE")
    total = F.when(F.col("event_type") == "error", fixed.TOTAL_STEP)
    path = F.coalesce(total, F.concat(F.lit("/jobs/sql/"), "event_type", F.lit(".sql")))
    production = t("events").select(
        path.alias("step_name"),
        F.col("value").alias("duration_seconds"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + minute).alias("end_time"),
        F.lit(1.0).alias("files_processed"),
    )
    stage = t("orders").select(
        F.concat(F.lit("extract_"), "o_orderpriority").alias("step_name"),
        F.col("o_totalprice").alias("duration_seconds"),
        F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + minute).alias("end_time"),
        F.col("o_custkey").cast("double").alias("files_processed"),
    )
    return runlog.union_logs(production, stage)


@query(SQL_LOG)
def run_log_union(t: Tables) -> DataFrame:
    return _steps(t)


# Written out, not taken from the constants, so that the comparison tests those.
SQL_PLACEHOLDERS = """SELECT 'WebMaps', name, -1.0::double, TIMESTAMP '2002-05-01 00:00:00', ended, -1.0::double FROM (VALUES
    ('folium', TIMESTAMP '2002-03-15 13:59:12.498894'), ('mapbox', TIMESTAMP '2002-03-15 13:59:12.498894'),
    ('turf', TIMESTAMP '2002-03-15 13:59:12.498894'), ('auto_ml', TIMESTAMP '2002-03-15 13:59:12.498894'),
    ('create_dataframes', TIMESTAMP '2024-03-15 13:59:12.498894'),
    ('test_maps', TIMESTAMP '2024-03-15 13:59:12.498894')) AS steps(name, ended)"""

SQL_MODEL_STEP = """SELECT 'WebMaps', 'auto_ml', count(*)::double, min(ts), max(ts), 1.0::double FROM events"""


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY step_name ORDER BY start_time DESC,
    end_time DESC, duration_seconds DESC, files_processed DESC, phase DESC) AS rn FROM ({SQL_LOG}
    UNION ALL {SQL_PLACEHOLDERS} UNION ALL {SQL_MODEL_STEP})) WHERE rn = 1"""
)
def run_log_latest(t: Tables) -> DataFrame:
    """The newest entry of each step; that of the model search takes the place of its placeholder."""
    searched = t("events").select(
        F.lit(fixed.PLACEHOLDER_PHASE).alias("phase"),
        F.lit("auto_ml").alias("step_name"),
        F.count(F.lit(1)).cast("double").alias("duration_seconds"),
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.lit(1.0).alias("files_processed"),
    )
    return runlog.latest_steps(clean.union_by_name([_steps(t), runlog.placeholder_steps(t.spark), searched]))


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY step_name ORDER BY start_time DESC,
    end_time DESC, duration_seconds DESC, files_processed DESC, phase DESC) AS rn FROM ({SQL_LOG})) WHERE rn = 1"""
)
def merged_log(t: Tables) -> DataFrame:
    """The log as a keyed table, into which the steps of each phase are merged in turn."""
    steps = _steps(t)
    table = KeyedTable(t.spark, scratch_path(t.spark, "log"), ["step_name"], 8)
    for phase in ("stage", "production"):
        table.merge(steps.where(F.col("phase") == phase), runlog.latest_steps)
    return table.read()


# Tables kept up to date.


@query(SQL_READINGS)
def appended_once(t: Tables) -> DataFrame:
    """Readings appended by file: two files first, then all, of which those two add nothing."""
    path = scratch_path(t.spark, "appended")
    rows = inputs.readings(t)
    for load in (rows.where(F.col("src_filename").isin("view.csv", "click.csv")), rows, rows):
        sink.append_new_files(load, path)
    return t.spark.read.parquet(path)


@query(
    """SELECT 'nation' AS table_name, n_nationkey::varchar AS "key", n_name AS "name" FROM nation
    UNION ALL SELECT 'region', r_regionkey::varchar, r_name FROM region"""
)
def exported_tables(t: Tables) -> DataFrame:
    """Tables of a catalogue exported as text, one folder each, and read back; a third one is left out by its name."""
    folder = scratch_path(t.spark, "exported")
    with _own_database(t.spark) as database:
        for name in ("nation", "region", "supplier"):
            t.spark.sql(f"CREATE VIEW {database}.{name} AS SELECT * FROM parquet.`{t.folder}/{name}.parquet`")
        names = [r[0] for r in catalog_tables(t.spark, database, not_in=["supplier"]).collect()]
        sink.export_tables(t.spark, database, names, folder)
    read = [t.spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{n}").withColumn("table_name", F.lit(n)) for n in names]
    return clean.union_by_name(
        [df.select("table_name", F.col(f"{n[0]}_{n}key").alias("key"), F.col(f"{n[0]}_name").alias("name")) for n, df in zip(names, read, strict=True)]
    )


def _kept_means(t: Tables, buckets: dict) -> DataFrame:
    """Means of three loads, each folded into the sums and counts of those before."""
    table = KeyedTable(t.spark, scratch_path(t.spark, "means"), [*KEPT_KEYS, kept_means.BUCKET], 8)
    positioned = inputs.positioned_readings(t)
    for load in range(3):
        part = positioned.where(F.pmod(F.xxhash64("ts", "event_type"), F.lit(3)) == load)
        state = kept_means.mean_state(part, KEPT_KEYS, "air_quality_value", buckets)
        table.merge(state, lambda states: kept_means.folded(states, KEPT_KEYS))
    return kept_means.means_of(table.read(), KEPT_KEYS, list(buckets))


KEPT_KEYS = ["cgndb_id", "latitude", "longitude"]


@query(sql_wide(STATION, "air_quality_value", SQL_PHASE_BUCKETS, SQL_POSITIONED))
def kept_phase_means(t: Tables) -> DataFrame:
    return _kept_means(t, kept_means.phases("hours_utc"))


@query(SQL_WEEKDAYS_WIDE)
def kept_weekday_means(t: Tables) -> DataFrame:
    return _kept_means(t, kept_means.weekdays("the_date"))


def _refreshed(t: Tables, whole) -> DataFrame:
    """Readings loaded in two halves by their files; months that a half does not touch are not written."""
    path = scratch_path(t.spark, "months")
    rule = newest(dedupe.READING_KEYS, ["last_updated"], ["src_filename", "air_quality_value"])
    first = F.col("src_filename").isin("view.csv", "click.csv")
    for half in (first, ~first):
        table = refresh_parts(whole(half), path, ["year", "month"], rule)
    return table


@query(sql_combined(SQL_READINGS, "the_date, hours_utc, cgndb_id"))
def refreshed_readings(t: Tables) -> DataFrame:
    places = staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places")
    return _refreshed(t, lambda half: enrich.combined_readings(inputs.readings(t).where(half), places, AS_OF))


def sql_measures(columns: tuple[str, ...]) -> str:
    rows = (
        f"""SELECT 'readings' AS step_name, count(*) AS n_rows, count(DISTINCT src_filename) AS n_files,
        '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM readings"""
        for c in columns
    )
    return f"WITH readings AS (SELECT * REPLACE (nullif(floor(air_quality_value) % 7, 0) AS air_quality_value) FROM ({SQL_READINGS})) " + " UNION ALL ".join(rows)


MEASURED = ("the_date", "cgndb_id", "air_quality_value", "src_filename")


@query(sql_measures(MEASURED))
def step_measures(t: Tables) -> DataFrame:
    """Rows, files and nulls of a step, counted by the job that writes it."""
    some = F.nullif(F.floor("air_quality_value") % 7, F.lit(0))
    rows = inputs.readings(t).withColumn("air_quality_value", some).select(*MEASURED)
    path = scratch_path(t.spark, "measured")
    return measures.write_observed(rows, "readings", lambda df: df.write.parquet(path), "src_filename")


@query(
    f"""SELECT f.cgndb_id, the_date, hours_utc, air_quality_value, geographical_name FROM ({SQL_READINGS}) f
    JOIN ({SQL_NEWEST_PLACES}) d ON upper(f.cgndb_id) = upper(d.cgndb_id)"""
)
def bucketed_join(t: Tables) -> DataFrame:
    """Readings with their place, both in buckets by the upper-case station id."""
    places = enrich.newest_places(staging.conform_geo_names(inputs.raw_gazetteer(t), AS_OF, "http://places"), AS_OF)
    with _own_database(t.spark) as database:
        fact, dimension = (
            write_bucketed(df, f"{database}.{name}", scratch_path(t.spark, name), "cgndb_id", 8)
            for name, df in (("fact", inputs.readings(t)), ("dimension", places.select("cgndb_id", "geographical_name")))
        )
        joined = join_bucketed(fact, dimension.drop("cgndb_id"))
        return joined.select("cgndb_id", "the_date", "hours_utc", "air_quality_value", "geographical_name")


# Map layers at every zoom.

LEVELS = (0, 4, 8, 11, 14)


def sql_bits(x: str, y: str, bits: int) -> str:
    """Bits of two numbers in turn."""
    return " + ".join(f"((({x} >> {i}) & 1) << {2 * i}) + ((({y} >> {i}) & 1) << {2 * i + 1})" for i in range(bits))


SQL_MAP_CELLS = f"""SELECT latitude, longitude, f8hr_vehicle_volume AS weight,
    floor((longitude + 180) / 360 * 16384)::bigint AS x,
    floor((1 - ln(tan(radians(latitude)) + 1 / cos(radians(latitude))) / pi()) / 2 * 16384)::bigint AS y FROM ({SQL_COUNTS})"""


@query(
    f"""WITH cells AS ({SQL_MAP_CELLS}), levels(level) AS (VALUES {', '.join(f'({z}::int)' for z in LEVELS)})
    SELECT level, {sql_bits('(x >> (14 - level))', '(y >> (14 - level))', 14)} AS cell, count(*) AS n_points,
    printf('%.9e', sum(weight)) AS total, printf('%.9e', avg(latitude)) AS latitude, printf('%.9e', avg(longitude)) AS longitude
    FROM cells, levels GROUP BY 1, 2"""
)
def marker_clusters(t: Tables) -> DataFrame:
    found = layers.marker_clusters(inputs.intersections(t), LEVELS, "f8hr_vehicle_volume")
    return found.select("level", "cell", "n_points", *(F.format_string("%.9e", F.col(c)).alias(c) for c in ("total", "latitude", "longitude")))


def sql_density(cell: float, reach: int, weight: str) -> str:
    reached = f"generate_series(-{reach}, {reach})"
    return f"""WITH cells AS (SELECT floor(latitude / {cell})::bigint AS a, floor(longitude / {cell})::bigint AS b, sum({weight}) AS w
        FROM ({SQL_COUNTS}) GROUP BY 1, 2),
    kernel AS (SELECT i, j, 1 - (i * i + j * j) / {(reach + 1) ** 2}.0::double AS v FROM {reached} r(i), {reached} s(j)),
    shares AS (SELECT i, j, v / (SELECT sum(v) FROM kernel WHERE v > 0) AS share FROM kernel WHERE v > 0)
    SELECT a + i AS lat_cell, b + j AS lon_cell, printf('%.8e', sum(w * share)) AS density FROM cells, shares GROUP BY 1, 2"""


@query(sql_density(0.05, 2, "f8hr_vehicle_volume"))
def density_layer(t: Tables) -> DataFrame:
    found = layers.density_layer(inputs.intersections(t), 0.05, 2, "f8hr_vehicle_volume")
    return found.withColumn("density", F.format_string("%.8e", F.col("density")))


@query(
    f"""SELECT objectid, latitude, longitude, count_date FROM ({SQL_COUNTS})
    WHERE latitude BETWEEN 43.02 AND 43.1 AND longitude BETWEEN -79.1 AND -79.02"""
)
def points_in_box(t: Tables) -> DataFrame:
    """Intersections written along the curve of their cells, and read back by a box."""
    path = scratch_path(t.spark, "points")
    geo.write_points(inputs.intersections(t).select("objectid", "latitude", "longitude", "count_date"), path)
    return geo.points_in_box(t.spark.read.parquet(path), 43.02, -79.1, 43.1, -79.02)
