"""Volume forecasts per location with Spark ML."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime

from pyspark import StorageLevel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotally.fixed_values import FORECAST_GAP_YEARS
from geotally.functions import calendar as cal
from geotally.functions.numbers import rounded
from geotally.operators.aggregate import first_attr_per_key
from geotally.operators.clean import drop_any_null, insertion_stamp

FOLDS = 5
SMOOTHING = 10.0
# Category tables of up to so many values (a few hundred bytes each) are sent to all tasks.
BROADCAST_VALUES = 5_000
# Fitting reads its rows many times. What does not fit in memory goes to disk, and what an executor
# takes with it is computed again.
KEPT = StorageLevel.MEMORY_AND_DISK


@dataclass(frozen=True)
class ForecastSettings:
    """Horizon in periods, period word, and sizes of the models; every candidate is always fitted."""

    horizon: int = 30
    frequency: str = "Daily"
    seed: int = 17
    forest_trees: int = 12
    boosting_rounds: int = 6
    tree_depth: int = 4

    def __post_init__(self) -> None:
        if self.horizon < 1:
            raise ValueError("the forecast horizon must be above 0")
        cal.parse_frequency(self.frequency)

    @property
    def code(self) -> str:
        return cal.parse_frequency(self.frequency)[0]


@dataclass(frozen=True)
class Series:
    """Columns of a table of counts per location."""

    key: str
    date: str
    label: str
    categories: tuple[str, ...]
    numbers: tuple[str, ...]

    @property
    def attributes(self) -> list[str]:
        return [c for c in (*self.categories, *self.numbers) if c != self.key]


def future_locations(
    df: DataFrame,
    key: str,
    date_column: str,
    attributes: Sequence[str],
    start: date | None = None,
    table_wide: Sequence[str] = (),
) -> DataFrame:
    """Every location with the attributes of its first row by date, and ``_first``, the first future date.

    That date is ``FORECAST_GAP_YEARS`` after the newest date of the whole table unless ``start`` is
    given. Attributes named in ``table_wide`` take the value of the table's first row instead.
    """
    locations = first_attr_per_key(df, [key], attributes, [date_column])
    if table_wide:
        shared = df.orderBy(date_column, key, *table_wide).limit(1)
        locations = locations.withColumns({c: shared.select(c).scalar() for c in table_wide})
    if start is None:
        newest = df.select(F.max(date_column).cast("date").alias("_newest")).scalar()
        first = F.add_months(newest, 12 * FORECAST_GAP_YEARS)
    else:
        first = F.lit(start).cast("date")
    return locations.withColumn("_first", first)


def with_future_dates(locations: DataFrame, frequency: str, horizon: int) -> DataFrame:
    """Each location once per future date; a sequence within the row, not a join with the dates."""
    code, _ = cal.parse_frequency(frequency)
    kept = [c for c in locations.columns if c != "_first"]
    return locations.select(*kept, F.explode(cal.date_series("_first", code, horizon)).alias("future_date"))


def horizon_grid(
    df: DataFrame,
    key: str,
    date_column: str,
    attributes: Sequence[str],
    frequency: str = "Daily",
    horizon: int = 30,
    start: date | None = None,
    table_wide: Sequence[str] = (),
) -> DataFrame:
    """Every location with each of its future dates; see :func:`future_locations`."""
    return with_future_dates(
        future_locations(df, key, date_column, attributes, start, table_wide), frequency, horizon
    )


def _fold(df: DataFrame, series: Series) -> DataFrame:
    """Fold of each row, out of the first two digits of a digest of key, date and whole part of the label."""
    whole = F.floor(series.label).cast("bigint")
    digest = F.md5(F.concat_ws("|", series.key, F.col(series.date).cast("date"), whole).cast("binary"))
    digits = [F.instr(F.lit("0123456789abcdef"), F.substr(digest, F.lit(k), F.lit(1))) - 1 for k in (1, 2)]
    return df.withColumn("_fold", ((16 * digits[0] + digits[1]) % FOLDS).cast("int"))


@dataclass(frozen=True)
class CategoryMeans:
    """Label sums per category value, and the overall mean that rare values lean towards."""

    prior: float
    sums: Mapping[str, DataFrame]


def category_cells(rows: DataFrame, series: Series, *flags: str) -> DataFrame:
    """Label sum and count of each combination of categories, fold and flags: the one pass over all rows.

    All category means are sums of these cells, whatever fold or flag is left out.
    """
    label = F.col(series.label)
    kept = [F.col(c).alias(f"_{c}") for c in series.categories]
    return rows.groupBy(*kept, "_fold", *flags).agg(F.sum(label).alias("_total"), F.count(label).alias("_rows"))


def category_means(cells: DataFrame, series: Series) -> CategoryMeans:
    """Label sum and count of each category value, and both as one array entry per fold.

    They stay tables that are joined, not lists on the driver, because the number of locations
    grows with the data; only the overall mean and the number of values are fetched.
    """
    in_fold = [F.col("_fold") == i for i in range(FOLDS)]
    sums = F.array(*[F.coalesce(F.sum(F.when(f, F.col("_total"))), F.lit(0.0)) for f in in_fold])
    counts = F.array(*[F.coalesce(F.sum(F.when(f, F.col("_rows"))), F.lit(0)) for f in in_fold])
    measures = {"_total": F.sum("_total"), "_rows": F.sum("_rows"), "_sums": sums, "_counts": counts}
    sizes = cells.agg(
        F.sum("_total"), F.sum("_rows"), *[F.approx_count_distinct(f"_{c}", 0.02) for c in series.categories]
    ).first()
    if not sizes[1]:
        raise ValueError("no complete rows to learn from")
    tables = {}
    for c, values in zip(series.categories, sizes[2:], strict=True):
        table = cells.groupBy(F.col(f"_{c}").alias("_category")).agg(*[m.alias(name) for name, m in measures.items()])
        # A few values would otherwise be a few hot keys of a shuffle of all rows.
        tables[c] = F.broadcast(table) if values <= BROADCAST_VALUES else table
    return CategoryMeans(sizes[0] / sizes[1], tables)


def encode_categories(rows: DataFrame, means: CategoryMeans, whole: bool = False) -> DataFrame:
    """Add the smoothed mean label of each category's value.

    Rows with a ``_fold`` are training rows and leave their own fold out, so that a row does not
    see its own label; ``whole`` adds the mean over all folds from the same join. Values not seen in
    training get the overall mean.
    """
    prior = F.lit(means.prior)
    of_all = (F.col("_total") + F.lit(SMOOTHING) * prior) / (F.col("_rows") + F.lit(SMOOTHING))
    total, count = F.col("_total"), F.col("_rows")
    helpers = ["_category", "_total", "_rows"]
    if "_fold" in rows.columns:
        own = F.col("_fold").cast("int")
        total, count = total - F.get("_sums", own), count - F.get("_counts", own)
        helpers += ["_sums", "_counts"]
    mean = (total + F.lit(SMOOTHING) * prior) / (count + F.lit(SMOOTHING))
    for category, sums in means.sums.items():
        needed = sums if "_sums" in helpers else sums.drop("_sums", "_counts")
        joined = rows.join(needed, F.col(category) == F.col("_category"), "left")
        found = {f"{category}_mean": F.coalesce(mean, prior)}
        if whole:
            found[f"{category}_mean_all"] = F.coalesce(of_all, prior)
        rows = joined.withColumns(found).drop(*helpers)
    return rows


def _assemble(encoded: DataFrame, series: Series, date_column: str) -> DataFrame:
    dated = encoded.withColumn("_day", F.unix_date(F.col(date_column).cast("date")).cast("double"))
    inputs = [f"{c}_mean" for c in series.categories] + list(series.numbers) + ["_day"]
    return VectorAssembler(inputCols=inputs, outputCol="_features").transform(dated)


def _vectors(rows: DataFrame, means: CategoryMeans, series: Series) -> DataFrame:
    return _assemble(encode_categories(rows, means), series, series.date).select("_features", series.label)


def candidates(label: str, settings: ForecastSettings) -> dict[str, Estimator]:
    """Models to try. The linear one is there because trees are flat beyond the last date."""
    common = {"featuresCol": "_features", "labelCol": label, "predictionCol": "_predicted"}
    trees = {"maxDepth": settings.tree_depth, "seed": settings.seed, **common}
    return {
        "linear": LinearRegression(regParam=0.01, **common),
        "forest": RandomForestRegressor(numTrees=settings.forest_trees, **trees),
        "boosted": GBTRegressor(maxIter=settings.boosting_rounds, stepSize=0.3, **trees),
    }


def _day(series: Series) -> Column:
    return F.unix_date(F.col(series.date).cast("date"))


def split_dates(rows: DataFrame, series: Series, newest_share: float = 0.2) -> int | None:
    """Last day (since 1970) of the older rows; None when all rows have the same date.

    It is the first day up to which there are at least the older share of all rows, but not the
    last day of all. Rows are counted by day, so the cut is exact and the calendar bounds what is fetched.
    """
    days = sorted(rows.groupBy(_day(series).alias("day")).count().collect())
    if not days:
        raise ValueError("no complete rows to learn from")
    if len(days) == 1:
        return None
    total, met = sum(n for _, n in days), 0
    for day, n in days[:-1]:
        met += n
        if met >= (1 - newest_share) * total:
            return day
    return days[-2][0]


def with_split(rows: DataFrame, series: Series, newest_share: float = 0.2) -> DataFrame:
    """Rows with ``_older``: whether they are learned from in the comparison; by fold when all rows have the same date."""
    cut = split_dates(rows, series, newest_share)
    return rows.withColumn("_older", F.col("_fold") > 0 if cut is None else _day(series) <= cut)


def compare_models(
    rows: DataFrame, cells: DataFrame, series: Series, settings: ForecastSettings
) -> list[tuple[str, float]]:
    """(model, held-out RMSE), best first. ``rows`` are split; the newest dates are held out."""
    means = category_means(cells.where("_older"), series)
    older, newest = rows.where("_older"), rows.where("NOT _older").drop("_fold")
    train, test = (_vectors(part, means, series).persist(KEPT) for part in (older, newest))
    evaluator = RegressionEvaluator(labelCol=series.label, predictionCol="_predicted", metricName="rmse")
    results = []
    try:
        for name, estimator in candidates(series.label, settings).items():
            results.append((name, evaluator.evaluate(estimator.fit(train).transform(test))))
    finally:
        train.unpersist()
        test.unpersist()
    return sorted(results, key=lambda r: r[1])


def _training_rows(df: DataFrame, series: Series) -> DataFrame:
    used = list(dict.fromkeys([series.key, *series.categories, *series.numbers, series.date, series.label]))
    rows = drop_any_null(df.select(*used)).withColumns(
        {c: F.col(c).cast("double") for c in [*series.numbers, series.label]}
    )
    return _fold(rows, series)


def _spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out over all cores and kept for the fits.

    Few input files would otherwise leave most cores idle in every pass. Rows are dealt out in
    turn, so copies of a row do not meet in one task.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(tasks).persist(KEPT)


@contextmanager
def _prepared(rows: DataFrame, series: Series) -> Iterator[tuple[DataFrame, DataFrame]]:
    """(split rows, category cells), both kept while models are fitted."""
    kept = _spread(rows)
    try:
        split = with_split(kept, series)
        cells = category_cells(split, series, "_older").persist(KEPT)
        try:
            yield split, cells
        finally:
            cells.unpersist()
    finally:
        kept.unpersist()


def forecast_leaderboard(df: DataFrame, series: Series, settings: ForecastSettings | None = None) -> DataFrame:
    """All models by held-out error."""
    with _prepared(_training_rows(df, series), series) as (rows, cells):
        results = compare_models(rows, cells, series, settings or ForecastSettings())
    ranked = [(rank, name, rmse) for rank, (name, rmse) in enumerate(results, 1)]
    return df.sparkSession.createDataFrame(ranked, "rank int, model string, rmse double")


def fit_leader(rows: DataFrame, series: Series, settings: ForecastSettings) -> Model:
    """Best model of the comparison, fitted again on all rows."""
    with _prepared(rows, series) as (kept, cells):
        leader = compare_models(kept, cells, series, settings)[0][0]
        train = _vectors(kept, category_means(cells, series), series).persist(KEPT)
        try:
            return candidates(series.label, settings)[leader].fit(train)
        finally:
            train.unpersist()


def forecast_grid(
    series: Series, predicted: Column, name: str, as_of: datetime | Column, grid: DataFrame
) -> DataFrame:
    """Rows of a forecast table: each location and future date with its prediction to the nearest integer."""
    result = grid.select(series.key, *series.attributes, "future_date", rounded(predicted, "bigint").alias(name))
    return insertion_stamp(result, as_of)


def forecast_volume(
    df: DataFrame,
    series: Series,
    predicted: str,
    as_of: datetime | Column,
    settings: ForecastSettings | None = None,
) -> DataFrame:
    """Predicted label of each location and future date, to the nearest integer."""
    settings = settings or ForecastSettings()
    rows = _training_rows(df, series)
    model = fit_leader(rows, series, settings)
    locations = future_locations(rows, series.key, series.date, series.attributes)
    # Categories do not change over time: they are looked up once per location, before the dates.
    encoded = encode_categories(locations, category_means(category_cells(rows, series), series))
    grid = with_future_dates(encoded, settings.frequency, settings.horizon)
    scored = model.transform(_assemble(grid, series, "future_date"))
    return forecast_grid(series, F.col("_predicted"), predicted, as_of, scored)


def forecast_trend(
    df: DataFrame,
    series: Series,
    predicted: str,
    as_of: datetime | Column,
    settings: ForecastSettings | None = None,
) -> DataFrame:
    """Predictions by a straight line through each location's counts; its mean where all have one date."""
    settings = settings or ForecastSettings()
    rows = _training_rows(df, series)
    day, label = _day(series).cast("double"), F.col(series.label)
    # Days are counted from the table's first, so that the squares stay exact.
    origin = rows.select(F.min(_day(series))).scalar()
    since = day - origin
    lines = rows.groupBy(F.col(series.key).alias("_key")).agg(
        F.regr_slope(label, since).alias("_slope"), F.regr_intercept(label, since).alias("_base"), F.avg(label).alias("_mean")
    )
    locations = future_locations(rows, series.key, series.date, series.attributes)
    joined = locations.join(lines, F.col(series.key) == F.col("_key"))
    grid = with_future_dates(joined, settings.frequency, settings.horizon)
    ahead = F.unix_date("future_date") - origin
    value = F.coalesce(F.col("_base") + F.col("_slope") * ahead, F.col("_mean"))
    return forecast_grid(series, value, predicted, as_of, grid)


def forecast_features(df: DataFrame, series: Series) -> DataFrame:
    """Training rows with the mean of each category: over all rows, and over the rows of other folds."""
    rows = _training_rows(df, series)
    means = category_means(category_cells(rows, series), series)
    return encode_categories(rows, means, whole=True).withColumnRenamed("_fold", "fold")


def forecast_split(df: DataFrame, series: Series) -> DataFrame:
    """(side, n_rows, first_date, last_date) of the rows learned from and those held out."""
    rows = with_split(_training_rows(df, series), series)
    side = F.when(F.col("_older"), "older").otherwise("newest").alias("side")
    date = F.col(series.date).cast("date")
    return rows.groupBy(side).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )


def traffic_series(label: str) -> Series:
    """Columns of the intersection counts."""
    return Series("objectid", "count_date", label, ("objectid", "tcs__", "main"), ("latitude", "longitude"))


TARGETS: Mapping[str, str] = {
    "f8hr_vehicle_volume": "predicted_traffic",
    "f8hr_pedestrian_volume": "predicted_pedestrians",
}
