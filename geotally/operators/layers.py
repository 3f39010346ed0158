"""Data behind the map layers: marker classes, heat points, daily frames, chart rows, GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.fixed_values import ABOVE_MEAN, AT_MEAN, BELOW_MEAN, WEEKDAYS
from geotally.functions import text
from geotally.functions.calendar import ColumnOrName, as_column
from geotally.functions.numbers import rounded, settled_mean, truncated
from geotally.operators import geo
from geotally.operators.clean import drop_any_null


def overall_mean(df: DataFrame, value: str, truncate: bool = True) -> Column:
    """Mean of a column over the whole table as a scalar subquery: one row computed once, no join."""
    mean = settled_mean(value)
    return df.select((truncated(mean) if truncate else mean).alias("_mean")).scalar()


def classify_vs_mean(
    df: DataFrame,
    value: str,
    reference: DataFrame | None = None,
    reference_value: str | None = None,
    truncate: bool = True,
    name: str = "marker_class",
) -> DataFrame:
    """Class of each row above, below or at the mean of its own table or of ``reference``.

    The mean loses its fraction first unless ``truncate`` is off. A null value is at the mean.
    """
    mean = overall_mean(df if reference is None else reference, reference_value or value, truncate)
    side = F.when(F.col(value) > mean, ABOVE_MEAN).when(F.col(value) < mean, BELOW_MEAN)
    return df.withColumn(name, side.otherwise(AT_MEAN))


def marker_layer(
    df: DataFrame,
    value: str,
    label: Column,
    latitude: str = "latitude",
    longitude: str = "longitude",
    keys: Sequence[str] = (),
    reference: DataFrame | None = None,
    reference_value: str | None = None,
) -> DataFrame:
    """Keys, position, class against the mean, and popup text."""
    classed = classify_vs_mean(df, value, reference, reference_value)
    return classed.select(
        *keys,
        F.col(latitude).alias("latitude"),
        F.col(longitude).alias("longitude"),
        "marker_class",
        label.alias("popup"),
    )


def air_label(value: ColumnOrName, name: ColumnOrName, date: ColumnOrName, phase: ColumnOrName) -> Column:
    day = text.first_token(as_column(date).cast("string"))
    return text.label_text(("Air Quality Measure", value), ("Name", name), ("Date", day), ("Phase", phase))


def volume_label(title: str, value: ColumnOrName, date: ColumnOrName, station: ColumnOrName) -> Column:
    day = text.first_token(as_column(date).cast("string"))
    return text.label_text((title, rounded(value, "bigint")), ("Date", day), ("Main Stn", station))


def prediction_label(title: str, value: ColumnOrName, date: ColumnOrName, station: ColumnOrName) -> Column:
    return text.label_text((title, value), ("Future Date", date), ("Name", station))


def heat_layer(df: DataFrame, weight: str, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """Weighted points."""
    return df.select(
        F.col(latitude).alias("latitude"), F.col(longitude).alias("longitude"), F.col(weight).alias("weight")
    )


def daily_frames(
    df: DataFrame,
    date: str,
    weight: str,
    latitude: str = "latitude",
    longitude: str = "longitude",
) -> DataFrame:
    """Points of each day: (frame_date, lat, lon, weight, copies), rows with a null left out.

    Rows stay long, so no day has to fit into one row and the shape is the same at every size.
    Copies of a point are counted within each task before the only exchange.
    """
    spot = [F.col(latitude).alias("lat"), F.col(longitude).alias("lon"), F.col(weight).alias("weight")]
    points = drop_any_null(df.select(F.to_date(date).alias("frame_date"), *spot))
    return points.groupBy("frame_date", "lat", "lon", "weight").agg(F.count(F.lit(1)).alias("copies"))


def in_date_order(frames: DataFrame) -> DataFrame:
    """Frames as a player reads them, day by day; for the edge, where they are exported."""
    return frames.orderBy("frame_date", "lat", "lon", "weight")


def weekday_charts(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Chart rows of each station as a JSON list of its seven weekday means."""
    bars = [
        F.struct(F.lit(day).alias("weekday"), F.col(f"{day.lower()}_avg").alias("weekday_avg")) for day in WEEKDAYS
    ]
    return df.select(*ids, F.to_json(F.array(*bars)).alias("chart"))


def geojson_features(
    df: DataFrame, properties: Sequence[str], latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """One GeoJSON feature per row, as text."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(
            F.lit("Point").alias("type"), F.array(F.col(longitude), F.col(latitude)).alias("coordinates")
        ).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


def marker_clusters(
    df: DataFrame, levels: Sequence[int], weight: str, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Clusters for each zoom level: (level, cell, n_points, total, latitude, longitude), the position being the mean of the points.

    A row's cell is found once, at the finest level; cells of other levels are its number without the last bits. All levels are
    counted in one grouping, which each task reduces to its cells before the only exchange.
    """
    finest = max(levels)
    cell = geo.interleaved(*geo.map_cell(latitude, longitude, finest))
    kept = [F.col(latitude).cast("double").alias("_lat"), F.col(longitude).cast("double").alias("_lon")]
    points = df.select(cell.alias("_finest"), *kept, F.col(weight).cast("double").alias("_weight")).where("_lat IS NOT NULL AND _lon IS NOT NULL")
    of_level = [F.struct(F.lit(z).alias("level"), F.shiftright("_finest", 2 * (finest - z)).alias("cell")) for z in sorted(set(levels))]
    rolled = points.withColumn("_at", F.explode(F.array(*of_level)))
    grouped = rolled.groupBy("_at.level", "_at.cell").agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("_weight").alias("total"), F.avg("_lat").alias("latitude"), F.avg("_lon").alias("longitude")
    )
    return grouped


def kernel_weights(reach: int) -> list[tuple[int, int, float]]:
    """(rows, columns, share) of a cell's neighbours up to ``reach`` cells away: 1 - (distance / (reach + 1))², scaled to add up to 1."""
    found = {
        (a, b): 1 - (a * a + b * b) / (reach + 1) ** 2 for a in range(-reach, reach + 1) for b in range(-reach, reach + 1)
    }
    inside = {k: v for k, v in found.items() if v > 0}
    whole = sum(inside.values())
    return [(a, b, v / whole) for (a, b), v in sorted(inside.items())]


def density_layer(
    df: DataFrame, cell: float, reach: int, weight: str, latitude: str = "latitude", longitude: str = "longitude", keys: Sequence[str] = ()
) -> DataFrame:
    """Smoothed weight of each square cell of ``cell`` degrees: (keys, lat_cell, lon_cell, density).

    Points are added up by cell first, then each cell hands a share of its weight to each neighbour; shares add up to one, so
    the total weight is kept. The neighbours come from an explode within the row, not from a join.
    """
    at = [F.floor(F.col(c) / F.lit(cell)).alias(name) for c, name in ((latitude, "_lat"), (longitude, "_lon"))]
    cells = df.groupBy(*keys, *at).agg(F.sum(F.col(weight).cast("double")).alias("_weight")).where("_weight IS NOT NULL AND _lat IS NOT NULL AND _lon IS NOT NULL")
    shares = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(w).alias("w")) for a, b, w in kernel_weights(reach)])
    spread = cells.withColumn("_to", F.explode(shares))
    to = [(F.col("_lat") + F.col("_to.a")).alias("lat_cell"), (F.col("_lon") + F.col("_to.b")).alias("lon_cell")]
    return spread.groupBy(*keys, *to).agg(F.sum(F.col("_weight") * F.col("_to.w")).alias("density"))
