"""Points, projection and grid density."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from geotally.fixed_values import SRID_DEGREES, SRID_UTM17
from geotally.functions.calendar import ColumnOrName, as_column


def point(longitude: ColumnOrName, latitude: ColumnOrName, srid: int = SRID_DEGREES) -> Column:
    return F.struct(
        as_column(longitude).alias("x"), as_column(latitude).alias("y"), F.lit(srid).cast("int").alias("srid")
    )


def add_point(
    df: DataFrame,
    longitude: str = "longitude",
    latitude: str = "latitude",
    name: str = "geom",
    srid: int = SRID_DEGREES,
) -> DataFrame:
    """Add a point column. ``srid=SRID_UTM17`` gives the published label, with the same degrees in it."""
    return df.withColumn(name, point(longitude, latitude, srid))


def relabel(geom: ColumnOrName, srid: int) -> Column:
    """Same coordinates under another reference id."""
    return as_column(geom).withField("srid", F.lit(srid).cast("int"))


def to_utm17(geom: ColumnOrName) -> Column:
    """Degrees to UTM zone 17N metres on the GRS80 ellipsoid.

    Transverse Mercator by the Krüger series to third order in the third flattening; the
    remainder is far below a millimetre inside the zone.
    """
    semi_major, flattening = 6378137.0, 1 / 298.257222101
    scale, false_easting, central_meridian = 0.9996, 500000.0, -81.0
    n = flattening / (2 - flattening)
    radius = semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alphas = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    )
    e = math.sqrt(flattening * (2 - flattening))

    geom = as_column(geom)
    phi = F.radians(geom["y"])
    lam = F.radians(geom["x"] - F.lit(central_meridian))
    conformal = F.sinh(F.atanh(F.sin(phi)) - F.lit(e) * F.atanh(F.lit(e) * F.sin(phi)))
    xi = F.atan2(conformal, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + conformal * conformal))
    east, north = eta, xi
    for j, alpha in enumerate(alphas, 1):
        east = east + F.lit(alpha) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
        north = north + F.lit(alpha) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    return F.struct(
        (F.lit(false_easting) + F.lit(scale * radius) * east).alias("x"),
        (F.lit(scale * radius) * north).alias("y"),
        F.lit(SRID_UTM17).cast("int").alias("srid"),
    )


_EWKB = np.dtype([("order", "u1"), ("kind", "<u4"), ("srid", "<u4"), ("x", "<f8"), ("y", "<f8")])


@F.pandas_udf(StringType())
def ewkb_hex(geom: pd.DataFrame) -> pd.Series:
    """Extended well-known binary of a point struct, little endian, as upper-case hex."""
    known = geom.notna().all(axis=1)
    points = np.zeros(int(known.sum()), _EWKB)
    points["order"], points["kind"] = 1, 1 | 0x20000000  # little endian; a point that has a reference id
    for name in ("srid", "x", "y"):
        points[name] = geom.loc[known, name]
    digits = 2 * _EWKB.itemsize
    whole = points.tobytes().hex().upper()
    out = pd.Series([None] * len(geom), dtype=object)
    out[known.to_numpy()] = [whole[at : at + digits] for at in range(0, len(whole), digits)]
    return out


def grid_density(
    df: DataFrame,
    cell: float,
    latitude: str = "latitude",
    longitude: str = "longitude",
    value: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Points (and the mean value) per square cell of ``cell`` degrees."""
    cells = [
        F.floor(F.col(latitude) / F.lit(cell)).alias("lat_cell"),
        F.floor(F.col(longitude) / F.lit(cell)).alias("lon_cell"),
    ]
    measures = [F.count(F.lit(1)).alias("n_points")]
    if value:
        measures.append(F.avg(value).alias("mean_value"))
    return df.groupBy(*keys, *cells).agg(*measures)


#: Levels of map cells: at level 20 a cell is about 38 metres wide at the equator.
FINEST_LEVEL = 20


def map_cell(latitude: ColumnOrName = "latitude", longitude: ColumnOrName = "longitude", level: int = FINEST_LEVEL) -> tuple[Column, Column]:
    """Column and row of a point's cell on the square web map, which has 2 ** level cells a side.

    Latitudes beyond the map's edge (about 85 degrees) fall into its first or last row.
    """
    side = float(1 << level)
    phi = F.radians(as_column(latitude).cast("double"))
    across = (as_column(longitude).cast("double") + 180.0) / 360.0
    down = (1.0 - F.log(F.tan(phi) + 1.0 / F.cos(phi)) / math.pi) / 2.0
    return tuple(F.greatest(F.lit(0.0), F.least(F.lit(side - 1), F.floor(part * side).cast("double"))).cast("bigint") for part in (across, down))


def _spread(value: Column) -> Column:
    """The 32 lowest bits of a number, with a gap of one bit between each two."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return value


def interleaved(x: Column, y: Column) -> Column:
    """One number of the bits of two in turn, so that cells near each other have numbers near each other.

    Two bits less are the number of the cell of the level above.
    """
    return _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1))


def write_points(df: DataFrame, path: str, latitude: str = "latitude", longitude: str = "longitude", row_group: int | None = None) -> None:
    """Write rows with positions along the curve of their cells, so that each row group covers a small box.

    Parquet keeps the bounds of both coordinates for each row group; a filter on a box reads only groups that meet it.
    """
    cell = interleaved(*map_cell(latitude, longitude))
    ordered = df.repartitionByRange(cell, F.col(latitude), F.col(longitude)).sortWithinPartitions(cell, latitude, longitude)
    writer = ordered.write.mode("overwrite")
    (writer.option("parquet.block.size", row_group) if row_group else writer).parquet(path)


def points_in_box(
    df: DataFrame, south: float, west: float, north: float, east: float, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Rows inside a box, its edges included; both conditions reach the scan."""
    return df.where(F.col(latitude).between(south, north) & F.col(longitude).between(west, east))
