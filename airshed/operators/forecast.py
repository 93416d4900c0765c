"""Per-series ARIMA(1,1,1) back-test and forecast (SURVEY §2.10 M10-M12,
§2.7 W2, §2.4 R5, §2.6 A11).

One shuffle on (pollutant, location_id) makes a row of each series (a handful
of years); the fits run over batches of these rows in ``mapInArrow``, many
series side by side. The once-differenced series, y'_t = phi y'_{t-1} + e_t +
theta e_{t-1} with no constant, is fitted by exact Gaussian likelihood: one-step
predictions and their variances by the innovations recursion (what a Kalman
filter from the stationary start gives), the error variance in closed form,
the pair of parameters by a grid that is halved around its best point.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.operators.changes import attach_scalar

# ---------------------------------------------------------------------------
# Fixed values that must match the reference for equal results.
MIN_POINTS_BACKTEST = 5
END_YEAR = 2026
POLLUTANTS = ["pm10", "pm25", "no2"]
# ---------------------------------------------------------------------------
# The coarse grid of (phi, theta) is -REACH..REACH in COARSE points, a STEP
# apart; each of REFINEMENTS halves the step and searches FINE x FINE points
# around the best. LIMIT keeps the model stationary and invertible.
REACH, COARSE, STEP, REFINEMENTS, FINE, LIMIT = 0.96, 17, 0.12, 17, 5, 0.999
#: Least sum of squares, so that a series without innovations has a likelihood.
LEAST = 1e-200


#: Series that are fitted side by side.
TOGETHER = 64


def _deviances(ds: list[np.ndarray], phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``deviance`` of several series, the longest first, with a row of
    (phi, theta) for each. Step t takes the series that are longer than t."""
    n, lengths = len(ds), np.array([len(d) for d in ds])
    x = np.zeros((n, int(lengths.max(initial=0)) + 1))  # a column of zeros, then the differences
    for row, d in zip(x, ds, strict=True):
        row[1:len(d) + 1] = d
    e, r = np.zeros_like(phi), np.ones_like(phi)
    square = theta * theta
    ahead = (1 + 2 * phi * theta + square) / (1 - phi * phi)
    squares, spread = np.zeros_like(phi), np.ones_like(phi)
    for t in range(x.shape[1] - 1):
        k = int(np.count_nonzero(lengths > t))
        e[:k] = x[:k, t + 1, None] - phi[:k] * x[:k, t, None] - theta[:k] * e[:k] / r[:k]
        r[:k] = ahead[:k]
        squares[:k] += e[:k] * e[:k] / r[:k]
        spread[:k] *= r[:k]
        ahead[:k] = 1 + square[:k] - square[:k] / r[:k]
    return lengths[:, None] * np.log(np.maximum(squares, LEAST)) + np.log(spread), e / r


def deviance(d: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For arrays of (phi, theta): -2 log likelihood of the differences, the
    error variance at its best, up to a constant; and the last innovation over
    its variance (in error variances)."""
    value, last = _deviances([np.asarray(d, dtype=float)], phi.reshape(1, -1), theta.reshape(1, -1))
    return value.reshape(phi.shape), last.reshape(phi.shape)


def _best(ds: list[np.ndarray], phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each series the likeliest pair of its row of ``phi`` and of
    ``theta``, the first on ties."""
    n = len(ds)
    ph, th = np.repeat(phi, theta.shape[1], axis=1), np.tile(theta, phi.shape[1])
    k = np.argmin(_deviances(ds, ph, th)[0], axis=1)
    return ph[np.arange(n), k], th[np.arange(n), k]


def _fit_together(ds: list[np.ndarray]) -> list[tuple[float, float, float, float]]:
    """The fits of series of differences, the longest first."""
    coarse = np.repeat(np.linspace(-REACH, REACH, COARSE)[None, :], len(ds), axis=0)
    phi, theta = _best(ds, coarse, coarse)
    step = STEP
    for _ in range(REFINEMENTS):
        step /= 2
        around = (np.arange(FINE) - FINE // 2) * step
        phi, theta = _best(ds, np.clip(phi[:, None] + around, -LIMIT, LIMIT), np.clip(theta[:, None] + around, -LIMIT, LIMIT))
    last = _deviances(ds, phi[:, None], theta[:, None])[1][:, 0]
    return [(float(p), float(q), float(d[-1]), float(e)) for p, q, d, e in zip(phi, theta, ds, last, strict=True)]


def fit_many(ys: list[np.ndarray]) -> list[tuple[float, float, float, float] | None]:
    """``fit_arima111`` of each series; TOGETHER of them are searched at once."""
    out: list = [None] * len(ys)
    ds = {}
    for i, y in enumerate(ys):
        if len(y) and np.all(np.isfinite(y)):
            out[i] = 0.0, 0.0, 0.0, 0.0
            if len(y) > 2:
                ds[i] = np.diff(y)
    order = sorted(ds, key=lambda i: -len(ds[i]))
    for at in range(0, len(order), TOGETHER):
        some = order[at:at + TOGETHER]
        for i, fit in zip(some, _fit_together([ds[i] for i in some]), strict=True):
            out[i] = fit
    return out


def fit_arima111(y: np.ndarray) -> tuple[float, float, float, float] | None:
    """(phi, theta, last difference, last innovation over its variance); None
    for an empty series or one that isn't finite. A series of one or two points
    has nothing to learn from: its parameters are 0, its forecast is flat."""
    return fit_many([np.asarray(y, dtype=float)])[0]


def _ahead(y: np.ndarray, fit: tuple[float, float, float, float] | None, steps: int) -> np.ndarray | None:
    if fit is None or steps <= 0:
        return None
    phi, theta, d_last, e_last = fit
    out = np.empty(steps)
    d_hat = phi * d_last + theta * e_last
    level = float(y[-1])
    for h in range(steps):
        if h > 0:
            d_hat = phi * d_hat
        level = level + d_hat
        out[h] = level
    return out


def forecast_arima111(y: np.ndarray, steps: int) -> np.ndarray | None:
    return _ahead(y, fit_arima111(y), steps)


# M12
def series_long(df: DataFrame, id_col: str = "location_id", time_col: str = "year",
                pollutants: list[str] = POLLUTANTS) -> DataFrame:
    """Unpivot the pollutants once: (pollutant, id, year, value), nulls
    dropped, so one job serves every pollutant."""
    rows = F.array(*[F.struct(F.lit(p).alias("pollutant"), F.col(p).cast("double").alias("value"))
                     for p in pollutants])
    return (df.select(id_col, F.col(time_col).cast("int").alias(time_col), F.inline(rows))
            .filter(F.col("value").isNotNull()))


# W2
def split_last_observation(series: DataFrame, keys: list[str], time_col: str = "year",
                           min_points: int = MIN_POINTS_BACKTEST) -> DataFrame:
    """Mark the last point of each series with >= ``min_points`` points as
    the test point, the others as training points."""
    w = Window.partitionBy(*keys)
    last = Window.partitionBy(*keys).orderBy(F.col(time_col).desc())
    return (series.withColumn("__n", F.count(F.lit(1)).over(w))
            .filter(F.col("__n") >= min_points)
            .withColumn("role", F.when(F.row_number().over(last) == 1, F.lit("test")).otherwise(F.lit("train")))
            .drop("__n"))


BACKTEST_SCHEMA = ("pollutant string, location_id int, n_points int, y_true double, "
                   "y_pred double, mae double, rmse double")
FORECAST_SCHEMA = "pollutant string, location_id int, year int, pred double"


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    """The list of each row as doubles, nulls as NaN."""
    flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum(pc.list_value_length(column).to_numpy())
    return np.split(flat, ends[:-1]) if len(ends) else []


def _doubles(values) -> pa.Array:
    return pa.array(np.asarray(values, dtype=float), pa.float64(), from_pandas=True)  # NaN is null


def _backtest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ys = _arrays(batch.column("ys"))
        some = [i for i, y in enumerate(ys) if len(y) >= MIN_POINTS_BACKTEST]
        ahead = [_ahead(ys[i][:-1], fit, 1) for i, fit in zip(some, fit_many([ys[i][:-1] for i in some]), strict=True)]
        some, pred = [i for i, f in zip(some, ahead, strict=True) if f is not None], np.array([f[0] for f in ahead if f is not None], dtype=float)
        true = np.array([ys[i][-1] for i in some], dtype=float)
        err = true - pred
        keys = batch.select(["pollutant", "location_id"]).take(pa.array(some, pa.int64()))
        yield pa.RecordBatch.from_arrays([*keys.columns, pa.array([len(ys[i]) for i in some], pa.int32()), _doubles(true), _doubles(pred),
                                          _doubles(np.abs(err)), _doubles(np.sqrt(err ** 2))], BACKTEST_SCHEMA_COLS)


BACKTEST_SCHEMA_COLS = [c.split()[0] for c in BACKTEST_SCHEMA.split(", ")]


def by_series(s: DataFrame, keys: list[str] = ("pollutant", "location_id")) -> DataFrame:
    """A row per series: its keys and ``ys``, its values by year (W4), as
    well as ``start_year`` where there is one. The rows are few bytes but each
    series is a model fit: AQE would coalesce the small shuffle into one task
    and run every fit in one Python worker. An explicit partition count is kept
    by AQE, and the aggregation reuses this partitioning (no second shuffle)."""
    spark = s.sparkSession  # cores at hand may be few just now under dynamic allocation
    n = max(8, 2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    by_year = F.sort_array(F.collect_list(F.struct(F.col("year").isNull().alias("none"), "year", F.col("value").cast("double").alias("y"))))  # a short series
    more = [F.max("start_year").alias("start_year")] if "start_year" in s.columns else []
    return s.repartition(n, *keys).groupBy(*keys).agg(F.transform(by_year, lambda r: r["y"]).alias("ys"), *more)


# M10
def arima_backtest(series: DataFrame) -> DataFrame:
    """Per series: fit without the last point, predict it, score |error|
    and sqrt(error^2). Series with < 5 points or a failed fit give no row."""
    s = series.select("pollutant", F.col("location_id").cast("int"), F.col("year").cast("int"), "value")
    return by_series(s).mapInArrow(_backtest_batches, BACKTEST_SCHEMA)


def _forecast_batches(end_year: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys, starts = _arrays(batch.column("ys")), batch.column("start_year").to_pylist()
            some = [i for i, a in enumerate(starts) if a is not None and a <= end_year]
            ahead = [_ahead(ys[i], fit, end_year - starts[i] + 1) for i, fit in zip(some, fit_many([ys[i] for i in some]), strict=True)]
            found = [(i, f) for i, f in zip(some, ahead, strict=True) if f is not None]
            keys = batch.select(["pollutant", "location_id"]).take(pa.array(np.repeat([i for i, _ in found], [len(f) for _, f in found]).astype(np.int64)))
            years = np.concatenate([np.arange(starts[i], end_year + 1) for i, _ in found] or [np.zeros(0)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(years), _doubles(np.concatenate([f for _, f in found] or [np.zeros(0)]))],
                                             ["pollutant", "location_id", "year", "pred"])
    return run


# M11
def arima_forecast(series: DataFrame, end_year: int = END_YEAR, start: str = "global") -> DataFrame:
    """Per series: fit on all points, forecast each year from the start
    (global last year + 1, D12; or the series' own with ``start='series'``)
    to ``end_year``; nothing when start > end or the fit fails."""
    s = series.select("pollutant", F.col("location_id").cast("int"), F.col("year").cast("int"), "value")
    if start == "global":
        s = attach_scalar(s, s.agg((F.max("year") + 1).alias("start_year")))  # A9
    elif start == "series":
        s = s.withColumn("start_year", F.max("year").over(Window.partitionBy("pollutant", "location_id")) + 1)
    else:
        raise ValueError(f"unknown start {start!r}")
    return by_series(s).mapInArrow(_forecast_batches(end_year), FORECAST_SCHEMA)


# A11
def mean_error_over_series(backtest: DataFrame) -> DataFrame:
    """Per pollutant: mean MAE and RMSE over the evaluated series."""
    return backtest.groupBy("pollutant").agg(F.avg("mae").alias("mean_mae"), F.avg("rmse").alias("mean_rmse"),
                                             F.count(F.lit(1)).alias("n_series"))
