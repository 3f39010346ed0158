"""Search over models and parameters on time-ordered folds, with a stacked leader.

The dates are cut into a first part and folds after it. Each fold is predicted by models that learned from all rows before
it (a rolling origin), so no row is predicted from later ones. From these predictions come each candidate's errors and the
weights of the stack, which are zero or more and add up to one. The stack's own error on a fold uses weights from the folds
before it only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add

import numpy as np
from pyspark.ml.base import Estimator, Model
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from geotally.operators import forecast as fc
from geotally.operators.forecast import KEPT, ForecastSettings, Series

TREND, STACK = "trend", "stack"
#: Models of a fold that are fitted side by side; each keeps its own copy of the rows in bins meanwhile.
FITS_AT_ONCE = 3


@dataclass(frozen=True)
class SearchSettings:
    """Folds, the share of rows before the first one in percent, and the parameters tried for each model."""

    folds: int = 3
    first_percent: int = 40
    seed: int = 17
    grid: Mapping[str, Sequence[Mapping[str, float]]] = field(
        default_factory=lambda: {
            "linear": ({"regParam": 0.01}, {"regParam": 1.0}),
            "forest": ({"maxDepth": 3, "numTrees": 8}, {"maxDepth": 5, "numTrees": 8}),
            "boosted": ({"maxDepth": 3, "maxIter": 4}, {"maxDepth": 4, "maxIter": 6}),
        }
    )

    def __post_init__(self) -> None:
        if self.folds < 1 or not 0 < self.first_percent < 100:
            raise ValueError("a search needs a fold, and rows before it")
        unknown = set(self.grid) - set(MODELS)
        if unknown:
            raise ValueError(f"models are {', '.join(MODELS)}; not {', '.join(sorted(unknown))}")

    def percents(self) -> list[int]:
        """Shares of all rows up to the end of the first part and of each fold."""
        return [self.first_percent + (100 - self.first_percent) * k // self.folds for k in range(self.folds + 1)]


MODELS: Mapping[str, type[Estimator]] = {"linear": LinearRegression, "forest": RandomForestRegressor, "boosted": GBTRegressor}


@dataclass(frozen=True)
class Candidate:
    """A model with parameters; the trend has none and is not one of Spark's."""

    model: str
    params: tuple[tuple[str, float], ...] = ()

    @property
    def shown(self) -> str:
        return ", ".join(f"{name}={value:g}" for name, value in self.params)

    def estimator(self, label: str, output: str, seed: int) -> Estimator:
        own = dict(self.params) if self.model == "linear" else {**dict(self.params), "seed": seed}
        if self.model == "forest":
            own["bootstrap"] = False  # drawn rows would depend on how rows lie in partitions, and with them the leader
        return MODELS[self.model](featuresCol="_features", labelCol=label, predictionCol=output, **own)


def candidates(settings: SearchSettings) -> list[Candidate]:
    tried = [Candidate(m, tuple(sorted(p.items()))) for m, many in settings.grid.items() for p in many]
    return [Candidate(TREND), *tried]


def fold_ends(rows: DataFrame, series: Series, settings: SearchSettings) -> list[int]:
    """Last day (since 1970) of the first part and of each fold: the first days up to which there are the asked shares of rows.

    Rows are counted by day, so the ends are exact and the calendar bounds what is fetched. Folds that would be empty are left out.
    """
    days = sorted(rows.groupBy(fc._day(series).alias("day")).count().collect())
    if not days:
        raise ValueError("no complete rows to learn from")
    total = sum(n for _, n in days)
    ends, met, wanted = [], 0, settings.percents()
    for day, n in days:
        met += n
        while wanted and 100 * met >= wanted[0] * total:
            ends.append(day)
            wanted.pop(0)
    ends = sorted(set(ends))
    if len(ends) < 2:
        raise ValueError("all rows are of one date, or most are of the last; no fold comes after another")
    return ends


def with_segment(rows: DataFrame, series: Series, ends: Sequence[int]) -> DataFrame:
    """Rows with ``_segment``: 0 for the first part, then the number of the fold."""
    return rows.withColumn("_segment", reduce(add, [(fc._day(series) > end).cast("int") for end in ends[:-1]]))


def folds(df: DataFrame, series: Series, settings: SearchSettings | None = None) -> DataFrame:
    """(fold, n_train, n_test, train_last, test_first, test_last)."""
    rows = fc._training_rows(df, series)
    ends = fold_ends(rows, series, settings or SearchSettings())
    date = F.col(series.date).cast("date")
    parts = with_segment(rows, series, ends).groupBy(F.col("_segment").alias("fold")).agg(
        F.count(F.lit(1)).alias("n_test"), F.min(date).alias("test_first"), F.max(date).alias("test_last")
    )
    # A handful of rows: one for each fold.
    earlier = parts.select(F.col("fold").alias("before"), F.col("n_test").alias("n"), F.col("test_last").alias("last"))
    joined = parts.join(F.broadcast(earlier), F.col("before") < F.col("fold"))
    return joined.groupBy("fold", "n_test", "test_first", "test_last").agg(F.sum("n").alias("n_train"), F.max("last").alias("train_last"))


def trend_lines(rows: DataFrame, series: Series, parts: Sequence[Column], origin: Column) -> DataFrame:
    """Straight lines through each location's counts, one for each of the conditions ``parts``, from one pass: (_key, _lines)."""
    since, label = fc._day(series).cast("double") - origin, F.col(series.label)
    lines = [
        F.struct(
            F.regr_slope(F.when(p, label), F.when(p, since)).alias("slope"),
            F.regr_intercept(F.when(p, label), F.when(p, since)).alias("base"),
            F.avg(F.when(p, label)).alias("mean"),
        )
        for p in parts
    ]
    return rows.groupBy(F.col(series.key).alias("_key")).agg(F.array(*lines).alias("_lines"))


def _on_line(line: Column, since: Column, otherwise: Column) -> Column:
    """The line's value, else the location's mean (one date only), else ``otherwise`` (a location not seen)."""
    return F.coalesce(line["base"] + line["slope"] * since, line["mean"], otherwise)


def trend_predictions(rows: DataFrame, series: Series, n_folds: int) -> DataFrame:
    """``rows`` (with ``_segment``) of the folds with the ``_trend`` learned from the segments before theirs."""
    origin = rows.select(F.min(fc._day(series))).scalar()
    parts = [F.col("_segment") < k for k in range(1, n_folds + 1)]
    lines = trend_lines(rows, series, parts, origin)
    overall = F.array(*[rows.select(F.avg(F.when(p, F.col(series.label)))).scalar() for p in parts])
    tested = rows.where("_segment > 0").join(lines, F.col(series.key) == F.col("_key"))
    fold = F.col("_segment") - 1
    value = _on_line(F.get("_lines", fold), fc._day(series) - origin, F.get(overall, fold))
    return tested.withColumn("_trend", value).drop("_key", "_lines")


def trend_errors(df: DataFrame, series: Series, settings: SearchSettings | None = None) -> DataFrame:
    """(fold, n_test, rmse, mae) of the trend, all folds in one pass."""
    rows = fc._training_rows(df, series)
    ends = fold_ends(rows, series, settings or SearchSettings())
    wrong = F.col("_trend") - F.col(series.label)
    predicted = trend_predictions(with_segment(rows, series, ends), series, len(ends) - 1)
    return predicted.groupBy(F.col("_segment").alias("fold")).agg(
        F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg(wrong * wrong)).alias("rmse"), F.avg(F.abs(wrong)).alias("mae")
    )


def stack_weights(wrong: np.ndarray, rounds: int = 2_000) -> np.ndarray:
    """Weights of zero or more with the sum one that minimise the squared error, given the sums of products of the candidates' errors.

    Weight is moved between two candidates at a time, as far as helps. Equal weights where nothing is known.
    """
    k = len(wrong)
    weights = np.full(k, 1.0 / k)
    for _ in range(rounds):
        before = weights.copy()
        for i in range(k):
            for j in range(i):
                bend = wrong[i, i] + wrong[j, j] - 2 * wrong[i, j]
                if bend > 0:
                    moved = np.clip((wrong[j] - wrong[i]) @ weights / bend, -weights[i], weights[j])
                    weights[i] += moved
                    weights[j] -= moved
        if np.abs(weights - before).max() < 1e-12:
            break
    return weights


@dataclass(frozen=True)
class FoldSums:
    """Sums over the predicted rows of a fold, whatever their number: of products of the candidates' errors, and of absolute errors."""

    n_train: int
    n_test: int
    wrong: np.ndarray
    absolute: np.ndarray

    def rmse(self, weights: np.ndarray) -> float:
        return float(np.sqrt(max(0.0, weights @ self.wrong @ weights) / self.n_test))


def _sums(predicted: DataFrame, label: str, outputs: Sequence[str], n_train: int) -> FoldSums:
    wrong = [F.col(o) - F.col(label) for o in outputs]
    k = len(outputs)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = predicted.agg(
        F.count(F.lit(1)), *[F.sum(F.abs(e)) for e in wrong], *[F.sum(wrong[i] * wrong[j]) for i, j in pairs]
    ).first()
    sums = np.zeros((k, k))
    for (i, j), value in zip(pairs, found[1 + k :], strict=True):
        sums[i, j] = sums[j, i] = value
    return FoldSums(n_train, found[0], sums, np.array(found[1 : 1 + k]))


@dataclass(frozen=True)
class Search:
    """What was tried: sums by fold, weights of the stack from all folds, and the number of the leader (the stack comes last)."""

    candidates: Sequence[Candidate]
    folds: Sequence[FoldSums]
    weights: np.ndarray

    def errors(self) -> np.ndarray:
        """RMSE by fold and candidate, the stack's last; its weights on a fold come from the folds before."""
        k = len(self.candidates)
        wrong = np.zeros((k, k))
        out = []
        for f in self.folds:
            out.append([*(f.rmse(w) for w in np.eye(k)), f.rmse(stack_weights(wrong))])
            wrong = wrong + f.wrong
        return np.array(out)

    def scores(self) -> np.ndarray:
        """Root of the mean squared error over all folds."""
        sizes = np.array([f.n_test for f in self.folds], float)
        return np.sqrt((self.errors() ** 2 * sizes[:, None]).sum(axis=0) / sizes.sum())

    @property
    def leader(self) -> int:
        """The least score; to nine digits, so that the order of adding cannot change it, then the first."""
        return int(np.argmin([float(f"{s:.8e}") for s in self.scores()]))

    @property
    def leader_weights(self) -> np.ndarray:
        k = len(self.candidates)
        return self.weights if self.leader == k else np.eye(k)[self.leader]


@contextmanager
def _kept(df: DataFrame) -> Iterator[DataFrame]:
    df.persist(KEPT)
    try:
        yield df
    finally:
        df.unpersist()


def _fits(estimators: Sequence[Estimator], train: DataFrame) -> list[Model]:
    """Models fitted on ``train``, ``FITS_AT_ONCE`` at a time, in the order of ``estimators``.

    A fit is a chain of short jobs; those of another one fill the cores that its last tasks leave idle.
    """
    with ThreadPool(FITS_AT_ONCE) as pool:
        return pool.map(inheritable_thread_target(train.sparkSession)(lambda e: e.fit(train)), estimators, chunksize=1)


def _fold_sums(rows: DataFrame, cells: DataFrame, series: Series, tried: Sequence[Candidate], fold: int, seed: int) -> FoldSums:
    """Fit all models on the rows before ``fold`` and add up their predictions of its rows."""
    means = fc.category_means(cells.where(F.col("_segment") < fold), series)
    earlier, tested = rows.where(F.col("_segment") < fold), rows.where(F.col("_segment") == fold)
    outputs = ["_trend", *(f"_p{i}" for i in range(1, len(tried)))]
    encoded = fc._assemble(fc.encode_categories(tested.drop("_fold"), means), series, series.date)
    with _kept(fc._vectors(earlier.drop("_trend"), means, series)) as train, _kept(encoded.select("_features", series.label, "_trend")) as test:
        n_train = train.count()  # keeps the rows before several fits read them
        scored = test
        for model in _fits([c.estimator(series.label, output, seed) for output, c in zip(outputs[1:], tried[1:], strict=True)], train):
            scored = model.transform(scored)
        return _sums(scored, series.label, outputs, n_train)


def _with_trend(rows: DataFrame, series: Series, n_folds: int) -> DataFrame:
    first = rows.where("_segment = 0").withColumn("_trend", F.lit(None).cast("double"))
    return trend_predictions(rows, series, n_folds).unionByName(first)


def search(df: DataFrame, series: Series, settings: SearchSettings | None = None) -> Search:
    """Try every candidate on every fold. Only sums by fold come to the driver."""
    settings = settings or SearchSettings()
    tried = candidates(settings)
    with _kept(fc._spread(fc._training_rows(df, series))) as rows:
        ends = fold_ends(rows, series, settings)
        split = with_segment(rows, series, ends)
        with _kept(fc.category_cells(split, series, "_segment")) as cells, _kept(_with_trend(split, series, len(ends) - 1)) as known:
            done = [_fold_sums(known, cells, series, tried, k, settings.seed) for k in range(1, len(ends))]
    return Search(tried, done, stack_weights(sum(f.wrong for f in done)))


def leaderboard(df: DataFrame, series: Series, settings: SearchSettings | None = None) -> DataFrame:
    """(rank, model, params, fold, n_train, n_test, rmse, mae, weight): a row for each candidate and fold, the stack's too.

    ``rank`` is by the error over all folds; ``weight`` is the candidate's in the stack. The mean absolute error of the stack
    is null: it does not follow from sums.
    """
    found = search(df, series, settings)
    scores, errors = [float(f"{s:.8e}") for s in found.scores()], found.errors()
    ranks = {k: r for r, k in enumerate(sorted(range(len(scores)), key=lambda k: (scores[k], k)), 1)}
    rows = []
    for k, c in enumerate([*found.candidates, Candidate(STACK)]):
        single = k < len(found.candidates)
        for fold, (f, e) in enumerate(zip(found.folds, errors, strict=True), 1):
            mae = float(f.absolute[k] / f.n_test) if single else None
            rows.append((ranks[k], c.model, c.shown, fold, f.n_train, f.n_test, float(e[k]), mae, float(found.weights[k]) if single else None))
    return df.sparkSession.createDataFrame(
        rows, "rank int, model string, params string, fold int, n_train long, n_test long, rmse double, mae double, weight double"
    )


def fitted(rows: DataFrame, series: Series, found: Search, means: fc.CategoryMeans, seed: int) -> list[tuple[float, Model | None]]:
    """(weight, model fitted on all rows) of what the leader is made of; the trend has no model."""
    chosen = [(w, c) for w, c in zip(found.leader_weights, found.candidates, strict=True) if w > 0]
    with _kept(fc._vectors(rows, means, series)) as train:
        train.count()
        models = iter(_fits([c.estimator(series.label, f"_p{k}", seed) for k, (_, c) in enumerate(chosen) if c.model != TREND], train))
        return [(float(w), None if c.model == TREND else next(models)) for w, c in chosen]


def forecast_by_search(
    df: DataFrame,
    series: Series,
    predicted: str,
    as_of: datetime | Column,
    settings: ForecastSettings | None = None,
    tried: SearchSettings | None = None,
) -> DataFrame:
    """Predicted label of each location and future date by the leader of the search, to the nearest integer."""
    settings, tried = settings or ForecastSettings(), tried or SearchSettings()
    found = search(df, series, tried)
    rows = fc._training_rows(df, series)
    means = fc.category_means(fc.category_cells(rows, series), series)
    models = fitted(rows, series, found, means, tried.seed)
    origin = rows.select(F.min(fc._day(series))).scalar()
    lines = trend_lines(rows, series, [F.lit(True)], origin)
    locations = fc.future_locations(rows, series.key, series.date, series.attributes)
    encoded = fc.encode_categories(locations, means).join(lines, F.col(series.key) == F.col("_key"), "left")
    grid = fc.with_future_dates(encoded, settings.frequency, settings.horizon)
    scored = fc._assemble(grid, series, "future_date")
    ahead = F.unix_date(F.col("future_date").cast("date")) - origin
    parts = []
    for weight, model in models:
        if model is None:
            parts.append(weight * _on_line(F.get("_lines", F.lit(0)), ahead, F.lit(means.prior)))
        else:
            scored = model.transform(scored)
            parts.append(weight * F.col(model.getPredictionCol()))
    return fc.forecast_grid(series, reduce(add, parts), predicted, as_of, scored)
