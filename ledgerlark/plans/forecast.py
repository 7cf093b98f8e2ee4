"""Forecast models on a panel, and their evaluation.

Input frames carry series_id, day, value and is_test (see operators.series.split). Every model returns
series_id, day, model, actual, forecast for the test days.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.functions import columns as C
from ledgerlark.operators import series as S
from ledgerlark.operators.boosting import LEAF_WISE, Boosting, fit
from ledgerlark.operators.trees import Ensemble
from ledgerlark.plans import analyses
from ledgerlark.sources.tables import Tables

COLUMNS = ("series_id", "day", "model", "actual", "forecast")
MEASURES = ("mae", "rmse", "mape")


def panel(t: Tables, by: str | None = None) -> DataFrame:
    """Daily revenue as series: series_id, day, value, orders."""
    daily = analyses.daily_revenue(t, by).withColumnRenamed("revenue", "value")
    return S.one_series(daily) if by is None else daily


def _test_rows(df: DataFrame, model: str, forecast: Column) -> DataFrame:
    """Compute a window-based forecast over the whole series, then keep the test days."""
    return (
        df.withColumn("forecast", forecast)
        .where("is_test")
        .select(S.SERIES, S.DAY, F.lit(model).alias("model"), F.col(S.VALUE).alias("actual"), "forecast")
    )


def naive(df: DataFrame) -> DataFrame:
    """The last training value, held flat."""
    train = ~F.col("is_test")
    last = F.max_by(F.when(train, F.col(S.VALUE)), F.when(train, F.col(S.DAY))).over(S.per_series())
    return _test_rows(df, "naive", last)


def seasonal_naive(df: DataFrame, period: int = 7, recursive: bool = False) -> DataFrame:
    """The value one period earlier.

    By default that value is the observed one even inside the test window, as published; `recursive` repeats the last
    training period instead, which is what a forecaster knows on the first test day.
    """
    if not recursive:
        return _test_rows(df, "seasonal_naive", F.lag(S.VALUE, period).over(S.in_order()))
    train = F.count_if(~F.col("is_test")).over(S.per_series())
    placed = df.withColumn("i", F.row_number().over(S.in_order())).withColumn("train_n", train)
    in_last_period = (F.col("i") > F.col("train_n") - period) & (F.col("i") <= F.col("train_n"))
    last_period = F.collect_list(F.when(in_last_period, F.struct("i", S.VALUE))).over(S.per_series())
    slot = F.pmod(F.col("i") - F.col("train_n") - 1, F.lit(period)).cast("int")
    return _test_rows(placed, "seasonal_naive_recursive", F.get(F.array_sort(last_period), slot)[S.VALUE])


# --- trend with changepoints plus weekly cycle ------------------------------------------------------------------

HINGE_PENALTIES = (0.1, 1.0, 10.0, 100.0)




def _trend_row(i: Column, n: Column, knots: Column, changepoints: int, fourier: int, period: int) -> list[Column]:
    """The regressors of day i of a series whose fit sees the days 0..n-1: level, trend, a slope change at each of `knots`
    points evenly spread over the first four fifths, and the waves of the cycle. Trend columns are on the scale of 0 to 1."""
    hinges = [
        F.when(F.lit(j) <= knots, F.greatest(i - 0.8 * (n - 1) * j / (knots + 1), F.lit(0.0)) / n).otherwise(0.0)
        for j in range(1, changepoints + 1)
    ]
    angles = [2 * np.pi * f * i / period for f in range(1, fourier + 1)]
    return [F.lit(1.0), i / n, *hinges, *map(F.sin, angles), *map(F.cos, angles)]


def _trend_matrix(n: int, knots: int, changepoints: int, fourier: int, period: int) -> np.ndarray:
    """The same regressors for all days 0..n-1, multiplied with themselves and summed: they depend on the calendar alone."""
    t = np.arange(n, dtype=float)[:, None]
    places = 0.8 * (n - 1) * np.arange(1, changepoints + 1) / (knots + 1)
    hinges = np.where(np.arange(1, changepoints + 1) <= knots, np.maximum(t - places, 0.0) / n, 0.0)
    angle = 2 * np.pi * t * np.arange(1, fourier + 1) / period
    x = np.hstack([np.ones((n, 1)), t / n, hinges, np.sin(angle), np.cos(angle)])
    return x.T @ x


def _trend_fits(placed: DataFrame, n: Column, penalties: Column, changepoints: int, fourier: int, period: int) -> DataFrame:
    """(series_id, fits): coefficients of the fit on the days before `n` for each of the penalties.

    The sums of regressors times values are one aggregate over the rows; what is solved outside is one small system per
    series and penalty. Only the slope changes are penalised.
    """
    row = [(x * F.col("y")) for x in _trend_row(F.col("i"), F.col("n"), F.col("knots"), changepoints, fourier, period)]
    seen = placed.where(F.col("i") < n).withColumn("n", n).withColumn("penalties", penalties)
    sums = seen.groupBy(S.SERIES, "n", "knots", "penalties").agg(F.array(*[F.sum(x) for x in row]).alias("sums"))
    kind = dict(placed.dtypes)[S.SERIES]

    def solve(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrices: dict[tuple[int, int], np.ndarray] = {}
        for part in parts:
            fits = []
            for size, knots, given, right in zip(part["n"], part["knots"], part["penalties"], part["sums"], strict=True):
                shape = (int(size), int(knots))
                if shape not in matrices:
                    matrices[shape] = _trend_matrix(*shape, changepoints, fourier, period)
                ridge = np.full(len(right), 1e-6)
                one = []
                for penalty in given:
                    ridge[2 : 2 + changepoints] = penalty
                    one.append(np.linalg.solve(matrices[shape] + np.diag(ridge), np.asarray(right, dtype=float)).tolist())
                fits.append(one)
            yield pd.DataFrame({S.SERIES: part[S.SERIES], "fits": fits})

    return sums.mapInPandas(solve, f"{S.SERIES} {kind}, fits array<array<double>>")


def trend_seasonal(df: DataFrame, changepoints: int = 25, fourier: int = 3, period: int = 7) -> DataFrame:
    """Piecewise-linear trend and a Fourier weekly cycle, fitted per series.

    The penalty on slope changes is chosen on the tail of the training days, never on the test days. There are at most as many
    changepoints as pairs of periods, so that the fit stays determined; a series of no more than two periods gets the
    mean of its training days (NULL without any), because neither a trend nor a cycle can be told from it. A training day without
    a value counts as 0.
    """
    model = (changepoints, fourier, period)
    rows = df.select(S.SERIES, S.DAY, F.col(S.VALUE).cast("double").alias("value"), "is_test")
    place = F.row_number().over(Window.partitionBy(S.SERIES, "is_test").orderBy(S.DAY)) - 1
    train = F.count_if(~F.col("is_test")).over(S.per_series())
    placed = rows.withColumn("place", place).withColumn("days", train).withColumn("horizon", F.count_if("is_test").over(S.per_series()))
    placed = placed.withColumn("mean", F.avg(F.when(~F.col("is_test"), F.col("value"))).over(S.per_series()))
    placed = placed.select(
        "*",
        F.when(F.col("is_test"), F.col("place") + F.col("days")).otherwise(F.col("place")).cast("double").alias("i"),
        F.coalesce("value", F.lit(0.0)).alias("y"),
        F.least(F.lit(changepoints), F.floor(F.col("days") / (2 * period))).alias("knots"),
        F.least("horizon", F.floor(F.col("days") / 4)).alias("tail"),
    )
    fitted = placed.where((F.col("horizon") > 0) & (F.col("days") > 2 * period))
    days, head = F.col("days").cast("double"), (F.col("days") - F.col("tail")).cast("double")

    def value(beta: Column, n: Column) -> Column:
        products = F.zip_with(beta, F.array(*_trend_row(F.col("i"), n, F.col("knots"), *model)), lambda b, x: b * x)
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    tries = _trend_fits(fitted, head, F.array(*map(F.lit, HINGE_PENALTIES)), *model)
    tails = fitted.where((F.col("i") >= head) & ~F.col("is_test")).join(tries, S.SERIES)
    errors = F.array(
        *[
            F.struct(F.avg(F.abs(value(F.col("fits")[p], head) - F.col("y"))).alias("error"), F.lit(p).alias("p"), F.lit(penalty).alias("penalty"))
            for p, penalty in enumerate(HINGE_PENALTIES)
        ]
    )
    best = tails.groupBy(S.SERIES).agg(F.array_min(errors)["penalty"].alias("penalty"))
    chosen = _trend_fits(fitted.join(best, S.SERIES), days, F.array("penalty"), *model)
    tests = placed.where("is_test").join(chosen, S.SERIES, "left")
    forecast = F.coalesce(value(F.col("fits")[0], days), F.col("mean"))
    return tests.select(S.SERIES, S.DAY, F.lit("trend_seasonal").alias("model"), F.col("value").alias("actual"), forecast.alias("forecast"))


# --- trees on lag features --------------------------------------------------------------------------------------


def _features(history: np.ndarray, day: np.ndarray, events: list) -> np.ndarray:
    """One row of features for `day`, from the values of the days before it (its last axis), as in S.feature_names."""
    month = day.astype("datetime64[M]")
    calendar = [
        (day.astype(np.int64) + 3) % 7,  # 1970-01-01 was a Thursday, Monday is 0
        month.astype(np.int64) % 12 + 1,
        (day - month.astype("datetime64[D]")).astype(np.int64) + 1,
        np.any([(day >= a) & (day <= b) for a, b in events] or [np.zeros(day.shape, bool)], axis=0),
    ]
    lags = [history[..., -k] for k in S.LAGS] + [history[..., -k:].mean(axis=-1) for k in S.ROLLS]
    return np.stack([*lags, *calendar], axis=-1).astype(float)


def _dense(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every day up to the last row, the values of the training days (0 where a day has no row), and the test days."""
    days = pdf["day"].to_numpy().astype("datetime64[D]")
    test = days[pdf["is_test"].to_numpy()]
    train_days, train = days[~pdf["is_test"].to_numpy()], pdf.loc[~pdf["is_test"], "value"].to_numpy(dtype=float)
    if not len(train):
        return np.zeros(0, "datetime64[D]"), train, test
    calendar = np.arange(train_days[0], days[-1] + 1)
    values = np.zeros(int((train_days[-1] - train_days[0]).astype(int)) + 1)
    values[(train_days - train_days[0]).astype(int)] = np.nan_to_num(train)
    return calendar, values, test


def _spread(df: DataFrame) -> DataFrame:
    """The columns of a fit, dealt by series over all partitions: the rows are few, the work for each series is not."""
    rows = df.select(S.SERIES, S.DAY, F.col(S.VALUE).cast("double").alias("value"), "is_test")
    return rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), S.SERIES)


def _recursion(values: np.ndarray, calendar: np.ndarray, events: list, predict) -> np.ndarray:
    """Values of all days of the calendar: those known, then one prediction after the other."""
    memory, out = max(*S.LAGS, *S.ROLLS), list(values)
    for day in calendar[len(values) :]:
        out.append(float(predict(_features(np.array(out[-memory:]), day, events)[None, :])[0]))
    return np.array(out)


def _per_series(df: DataFrame, name: str, model, event_windows) -> DataFrame:
    """Recursive forecasts of every test row. `model` makes a predict function from training features and values.

    The calendar is made dense first, a day without a row counts as 0. A series whose training days are no more than the
    longest lag has no features: it gets its value of a week before, repeated, with reason `short`; without a training
    day the forecast is NULL and the reason `empty`.
    """
    events = [(np.datetime64(a), np.datetime64(b)) for a, b in event_windows]
    memory = max(*S.LAGS, *S.ROLLS)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("day").drop_duplicates("day")
        test_rows = pdf[pdf["is_test"]]
        calendar, values, test = _dense(pdf)
        out = pd.DataFrame({"series_id": test_rows["series_id"], "day": test_rows["day"], "model": name, "actual": test_rows["value"]})
        if not len(values):
            return out.assign(forecast=np.nan, reason="empty")
        if len(values) > memory:
            windows = np.lib.stride_tricks.sliding_window_view(values, memory)[:-1]
            x = _features(windows, calendar[memory : len(values)], events)
            filled = _recursion(values, calendar, events, model(x, values[memory:]))
            reason = None
        else:
            week = min(7, len(values))
            filled = np.concatenate([values, np.resize(values[-week:], len(calendar) - len(values))])
            reason = "short"
        return out.assign(forecast=filled[(test - calendar[0]).astype(int)], reason=reason)

    kind = dict(df.dtypes)[S.SERIES]
    schema = f"series_id {kind}, day date, model string, actual double, forecast double, reason string"
    return _spread(df).groupBy(S.SERIES).applyInPandas(run, schema)


def boosted(df: DataFrame, name: str = "boosted", how: Boosting = LEAF_WISE, event_windows=S.EVENT_WINDOWS) -> DataFrame:
    """Boosted trees on lag features, one model per series, predicted one day after the other over the test days.

    Each series is scaled by its own training values alone, so small series are not drowned by large ones.
    """

    def model(x: np.ndarray, y: np.ndarray):
        return fit(x, y, how)[0].predict

    return _per_series(df, name, model, event_windows)


def forecast_recursive(ensemble: Ensemble, df: DataFrame, name: str, event_windows=S.EVENT_WINDOWS) -> DataFrame:
    """The same recursion with given trees for every series."""
    return _per_series(df, name, lambda x, y: ensemble.predict, event_windows)


def importance(df: DataFrame, how: Boosting = LEAF_WISE, event_windows=S.EVENT_WINDOWS) -> DataFrame:
    """(feature, gain): mean share of the split gain per feature over the series that have features, largest first."""
    events = [(np.datetime64(a), np.datetime64(b)) for a, b in event_windows]
    memory, names = max(*S.LAGS, *S.ROLLS), S.feature_names()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        calendar, values, _ = _dense(pdf.sort_values("day").drop_duplicates("day"))
        if len(values) <= memory:
            return pd.DataFrame({"feature": [], "share": []}).astype({"feature": str, "share": float})
        windows = np.lib.stride_tricks.sliding_window_view(values, memory)[:-1]
        shares = fit(_features(windows, calendar[memory : len(values)], events), values[memory:], how)[1]
        return pd.DataFrame({"feature": names, "share": shares})

    shares = _spread(df).groupBy(S.SERIES).applyInPandas(run, "feature string, share double")
    total = F.sum("share").over(Window.partitionBy())  # one row per feature
    summed = shares.groupBy("feature").agg(F.sum("share").alias("share"))
    return summed.select("feature", (F.col("share") / total).alias("gain")).orderBy(F.desc("gain"), "feature")


# --- evaluation -------------------------------------------------------------------------------------------------


def stack(*forecasts: DataFrame) -> DataFrame:
    """Forecasts of several models as one long frame."""
    doubled = [
        f.select(S.SERIES, S.DAY, "model", F.col("actual").cast("double"), F.col("forecast").cast("double"))
        for f in forecasts
    ]
    return reduce(DataFrame.unionByName, doubled)


def metrics(forecasts: DataFrame, *keys: str) -> DataFrame:
    """MAE, RMSE and MAPE per model and series, or per model and the given keys."""
    a, f = F.col("actual"), F.col("forecast")
    return forecasts.groupBy(*(keys or (S.SERIES,)), "model").agg(
        F.count("*").alias("days"),
        C.mean_abs_error(a, f).alias("mae"),
        C.root_mean_sq_error(a, f).alias("rmse"),
        C.mean_abs_pct_error(a, f).alias("mape"),
    )


def leaderboard(scores: DataFrame, models: list[str]) -> DataFrame:
    """One row per series and measure, one column per model."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in MEASURES])
    long = scores.select(S.SERIES, "model", F.inline(entries))
    return long.groupBy(S.SERIES, "metric").pivot("model", models).agg(F.first("score"))


def walk_forward(df: DataFrame, folds: int = 4, horizon: int = 14, period: int = 7) -> DataFrame:
    """Baselines on consecutive test blocks, newest block first, each seeing only the days before it.

    Forecasts with their fold number; all folds come from one window pass over the series.
    """
    days_left = F.count("*").over(S.per_series()) - F.row_number().over(S.in_order())
    placed = df.withColumn("days_left", days_left)
    closes_block = F.when(F.col("days_left") % horizon == 0, F.col(S.VALUE))
    before = S.in_order().rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        S.SERIES,
        S.DAY,
        (F.floor(F.col("days_left") / horizon) + 1).cast("int").alias("fold"),
        F.col(S.VALUE).alias("actual"),
        F.last(closes_block, ignorenulls=True).over(before).alias("naive"),
        F.lag(S.VALUE, period).over(S.in_order()).alias("seasonal_naive"),
    ).where(F.col("fold") <= folds)
    models = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("forecast")) for m in ("naive", "seasonal_naive")])
    return placed.select(S.SERIES, S.DAY, "fold", "actual", F.inline(models))


def monthly_rollup(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy(S.SERIES, "model", F.trunc(S.DAY, "month").alias("month")).agg(
        F.count("*").alias("days"), F.sum("actual").alias("actual"), F.sum("forecast").alias("forecast")
    )
