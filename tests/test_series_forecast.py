from __future__ import annotations

import subprocess
import sys
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.operators import series as S
from ledgerlark.operators.boosting import DEPTH_WISE, LEAF_WISE, Boosting, fit
from ledgerlark.operators.trees import Ensemble
from ledgerlark.plans import forecast
from tests.shop import rows

START = date(2018, 1, 1)  # a Monday
WEEK = (10.0, 20.0, 30.0, 40.0, 50.0, 5.0, 2.0)


def series(spark, values, name="a", start=START):
    days = [(name, start + timedelta(i), float(v)) for i, v in enumerate(values) if v is not None]
    text = ", ".join(f"('{n}', DATE '{d}', CAST({v} AS DOUBLE))" for n, d, v in days)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t(series_id, day, value)")


def weekly(spark, n, spike=None, noise=0.0):
    rng = np.random.default_rng(3)
    values = [WEEK[i % 7] + 0.05 * i + noise * rng.standard_normal() for i in range(n)]
    if spike is not None:
        values[spike] += 500
    return series(spark, values)


def test_calendar_is_filled_and_trimmed(spark):
    df = series(spark, [1, 2, None, None, 5, 6, None, 8])
    got = rows(S.clean_series(df, START + timedelta(1), START + timedelta(6)).orderBy("day"), "day", "value")
    assert [(d - START).days for d, _ in got] == [1, 2, 3, 4, 5, 6]
    assert [v for _, v in got] == [2, 0, 0, 5, 6, 0]
    assert [(r[0] - START).days for r in rows(S.missing_days(df).orderBy("day"), "day")] == [2, 3, 6]


def test_rolling_mean_needs_a_full_frame(spark):
    df = series(spark, range(1, 10)).select("day", S.rolling_mean("value", 7).alias("m"), S.rolling_mean("value", 7, 1).alias("s"))
    got = rows(df.orderBy("day"), "m", "s")
    assert [m for m, _ in got] == [None] * 6 + [4.0, 5.0, 6.0]
    assert [s for _, s in got] == [None] * 7 + [4.0, 5.0]


def test_rolling_median_starts_with_one_value(spark):
    df = series(spark, [9, 1, 5, 7]).select("day", S.rolling_median("value", 3).alias("m"))
    assert [r[0] for r in rows(df.orderBy("day"), "m")] == [9.0, 5.0, 5.0, 5.0]


def test_first_stable_day(spark):
    df = series(spark, [1, 90, 2, 60, 70, 80, 90])
    got = S.first_stable_day(df, "value", threshold=50, window=3).first()
    assert got.first_stable_day == START + timedelta(3)
    assert S.first_stable_day(df, "value", threshold=500).count() == 0


def test_warmup_profile_and_last_days(spark):
    df = series(spark, [1, 2, 3, 40, 50])
    got = {r.segment: (r.days, r["median"], r.low_days) for r in S.warmup_profile(df, "value", head=3, low=3).collect()}
    assert got == {"head": (3, 2.0, 2), "rest": (2, 45.0, 0)}
    assert [r[0] for r in rows(S.last_days(df, 2).orderBy("day"), "value")] == [40.0, 50.0]


@pytest.mark.parametrize("length,complete", [(6, 0), (28, 0), (29, 1)])
def test_lag_features_need_28_days(spark, length, complete):
    assert S.lag_features(series(spark, range(length))).count() == complete


def test_lag_feature_values(spark):
    row = S.lag_features(series(spark, range(29)), event_windows=((date(2018, 1, 29), date(2018, 1, 29)),)).first()
    assert (row.lag_1, row.lag_7, row.lag_14, row.lag_28) == (27.0, 21.0, 14.0, 0.0)
    assert (row.roll_7, row.roll_28) == (24.0, 13.5)
    assert (row.dow, row.month, row.dom, row.is_event) == (0, 1, 29, 1)


def test_describe_and_box(spark):
    got = S.describe_series(series(spark, [1, 2, 3, 4])).first()
    assert (got["count"], got["mean"], got["q25"], got["q50"], got["q75"]) == (4, 2.5, 1.75, 2.5, 3.25)
    assert got["std"] == pytest.approx(1.2909944)
    mondays = [10, *[0] * 6, 11, *[0] * 6, 12, *[0] * 6, 13, *[0] * 6, 100]
    box = {r.weekday: r for r in S.weekday_box(series(spark, mondays)).collect()}["Monday"]
    assert (box.days, box["median"], box.whisker_high, box.outliers) == (5, 12.0, 13.0, 1)


def test_decomposition_adds_up_and_leaves_the_spike_in_the_residual(spark):
    parts = S.decompose(weekly(spark, 140, spike=70, noise=0.5)).toPandas()
    assert np.allclose(parts.trend + parts.seasonal + parts.residual, parts.observed)
    assert (parts.residual.abs().idxmax(), len(parts)) == (parts.index[parts.day == START + timedelta(70)][0], 140)
    one_week = parts.groupby(parts.day.map(lambda d: d.weekday())).seasonal.first()
    assert abs(one_week.sum()) < 1e-9 and one_week.idxmax() == 4


def test_split_flags_the_tail_of_each_series(spark):
    both = series(spark, range(10)).union(series(spark, range(4), name="b"))
    got = rows(S.split(both, 3).where("is_test").groupBy("series_id").agg(F.min("value"), F.count("*")).orderBy("series_id"))
    assert got == [("a", 7.0, 3), ("b", 1.0, 3)]


def test_baselines(spark):
    df = S.split(series(spark, [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18]), 9)
    got = {name: [r[0] for r in rows(f.orderBy("day"), "forecast")] for name, f in {
        "naive": forecast.naive(df),
        "observed": forecast.seasonal_naive(df),
        "recursive": forecast.seasonal_naive(df, recursive=True),
    }.items()}
    assert got["naive"] == [9.0] * 9
    assert got["observed"] == [3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert got["recursive"] == [3, 4, 5, 6, 7, 8, 9, 3, 4]


def test_metrics_skip_zero_days_in_the_percentage_only(spark):
    df = spark.sql(
        "SELECT 'a' AS series_id, DATE '2018-01-01' AS day, 'm' AS model, v.* FROM VALUES "
        "(10.0D, 8.0D), (0.0D, 4.0D), (20.0D, 25.0D) AS v(actual, forecast)"
    )
    got = forecast.metrics(df).first()
    assert got.mae == pytest.approx(11 / 3)
    assert got.rmse == pytest.approx(np.sqrt(45 / 3))
    assert got.mape == pytest.approx((0.2 + 0.25) / 2 * 100)
    board = forecast.leaderboard(forecast.metrics(df), ["m"])
    assert {r.metric for r in board.collect()} == {"mae", "rmse", "mape"}


def test_walk_forward_only_looks_back(spark):
    got = forecast.walk_forward(series(spark, range(30)), folds=2, horizon=5).orderBy("day", "model").collect()
    naive = {(r.fold, r.actual): r.forecast for r in got if r.model == "naive"}
    assert naive == {**{(1, float(v)): 24.0 for v in range(25, 30)}, **{(2, float(v)): 19.0 for v in range(20, 25)}}
    assert all(r.forecast == r.actual - 7 for r in got if r.model == "seasonal_naive")


def test_trend_and_cycle_are_recovered(spark):
    df = S.split(weekly(spark, 210, noise=0.5), 28)
    scores = {r.model: r.mae for r in forecast.metrics(forecast.stack(forecast.naive(df), forecast.trend_seasonal(df))).collect()}
    assert scores["trend_seasonal"] < 2 < scores["naive"]


def plain_lines(y, rho, reach):
    out = []
    for i in range(len(y)):
        j = np.arange(max(0, i - reach), min(len(y), i + reach + 1))
        d = (j - i).astype(float)
        w = (1 - (np.abs(d) / (reach + 1)) ** 3) ** 3 * rho[j]
        if (w > 0).sum() > 1:
            x = np.vander(d, 2)
            out.append(np.linalg.lstsq(x * np.sqrt(w)[:, None], y[j] * np.sqrt(w), rcond=None)[0][1])
        else:
            out.append((w * y[j]).sum() / w.sum() if w.sum() else y[j].mean())
    return np.array(out)


def test_local_lines_equal_least_squares(spark):
    rng = np.random.default_rng(7)
    y, rho = rng.normal(size=40), np.where(rng.random(40) < 0.3, 0.0, rng.random(40))
    rho[10:25] = 0.0
    rho[17] = 0.5
    df = series(spark, y.tolist()).join(series(spark, rho.tolist()).withColumnRenamed("value", "rho"), ["series_id", "day"])
    got = S.local_lines(df, "fit", F.col("value"), F.col("rho"), 4).orderBy("day").collect()
    assert [r.fit for r in got] == pytest.approx(plain_lines(y, rho, 4).tolist(), rel=1e-6, abs=1e-9)


def test_a_spike_moves_neither_trend_nor_season(spark):
    def parts(spike):
        return S.decompose_robust(weekly(spark, 120, spike=spike, noise=0.3)).orderBy("day").collect()

    plain, spiked = parts(None), parts(50)
    for a, b in zip(plain, spiked, strict=True):
        assert abs(a.trend - b.trend) < 0.5 and abs(a.seasonal - b.seasonal) < 0.7
        assert b.observed == pytest.approx(b.trend + b.seasonal + b.residual)
    assert spiked[50].residual > 490 and max(abs(r.residual) for i, r in enumerate(spiked) if i != 50) < 3
    short = S.decompose_robust(series(spark, [1, 5, 2])).collect()
    assert all(r.observed == pytest.approx(r.trend + r.seasonal + r.residual) for r in short)
    flat = S.decompose_robust(series(spark, [4.0] * 30)).collect()
    assert all(r.trend == pytest.approx(4) and abs(r.seasonal) < 1e-9 for r in flat)


def plain_trend(y: np.ndarray, horizon: int, knots: int, penalty: float) -> np.ndarray:
    """The ridge fit of all days at once."""
    n, t = len(y), np.arange(len(y) + horizon, dtype=float)[:, None]
    hinges = np.maximum(t - np.linspace(0, 0.8 * (n - 1), knots + 2)[1:-1], 0) / n
    waves = [w(2 * np.pi * t * np.arange(1, 4) / 7) for w in (np.sin, np.cos)]
    x = np.hstack([np.ones_like(t), t / n, hinges, *waves])
    ridge = np.array([1e-6] * 2 + [penalty] * knots + [1e-6] * 6)
    return x[n:] @ np.linalg.solve(x[:n].T @ x[:n] + np.diag(ridge), x[:n].T @ y)


@pytest.mark.parametrize(("days", "test"), [(400, 30), (60, 20), (20, 3), (14, 2), (3, 3)])
def test_trend_equals_a_plain_fit(spark, days, test):
    rng = np.random.default_rng(days)
    y = np.cumsum(rng.normal(size=days)) * 10 + 5 * np.sin(np.arange(days)) + np.where(np.arange(days) > days / 2, 50.0, 0)
    df = S.split(series(spark, y.tolist()).union(series(spark, (y * 7).tolist(), name="b")), test)
    got = {(r.series_id, r.day): r.forecast for r in forecast.trend_seasonal(df).collect()}
    train = y[: days - test]
    n = len(train)
    if n <= 14:
        want = np.full(test, train.mean() if n else np.nan)
    else:
        knots, tail = min(25, n // 14), min(test, n // 4)
        errors = {p: np.abs(plain_trend(train[:-tail], tail, knots, p) - train[-tail:]).mean() for p in forecast.HINGE_PENALTIES}
        want = plain_trend(train, test, knots, min(errors, key=errors.get))
    for name, scale in (("a", 1), ("b", 7)):
        mine = [v for (who, _), v in sorted(got.items()) if who == name]
        assert len(mine) == test
        if n:
            assert mine == pytest.approx((want * scale).tolist(), rel=1e-6, abs=1e-6)
        else:
            assert mine == [None] * test


SMALL = Boosting(trees=20, rate=0.2, leaves=8, least_rows=5)


@pytest.fixture(scope="module")
def panel(spark):
    a = weekly(spark, 160, noise=1.0)
    b = series(spark, [50 - w for w in WEEK] * 20, name="b")
    short = series(spark, range(1, 31), name="short")
    gappy = weekly(spark, 160, noise=1.0).where("dayofmonth(day) <> 13").withColumn("series_id", F.lit("gappy"))
    return S.split(a.union(b).union(short).union(gappy), 21).cache()


def test_fitted_trees_follow_their_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    y = np.where(x[:, 1] > 0.3, 5.0, -2.0) + 0.01 * x[:, 0]
    trees, share = fit(x, y, Boosting(trees=60, rate=0.2))
    assert np.abs(trees.predict(x) - y).max() < 0.1
    assert share.argmax() == 1 and share.sum() == pytest.approx(1)
    one, _ = fit(x, y, Boosting(trees=1, rate=1.0, leaves=2))
    assert set(np.round(one.predict(x), 6)) == {round(y[x[:, 1] > 0.3].mean(), 6), round(y[x[:, 1] <= 0.3].mean(), 6)}
    deep, _ = fit(x, y, Boosting(trees=3, leaves=64, depth=2, least_rows=1))
    assert deep.depth <= 2
    flat, share = fit(x, np.full(300, 7.0), SMALL)
    assert set(flat.predict(x)) == {7.0} and not share.any()


def test_published_settings():
    assert (LEAF_WISE.trees, LEAF_WISE.rate, LEAF_WISE.leaves) == (500, 0.05, 31)
    assert (DEPTH_WISE.trees, DEPTH_WISE.rate, DEPTH_WISE.depth) == (500, 0.05, 6)


def test_worker_code_needs_no_installed_package(tmp_path):
    """Executors unpickle the trees and the fit without this package on their path."""
    from pyspark import cloudpickle

    payload = tmp_path / "payload"
    payload.write_bytes(cloudpickle.dumps((fit, SMALL, forecast._trend_matrix)))
    code = (
        "import sys, pickle, numpy as np\n"
        "from pyspark import cloudpickle\n"
        "boost, how, matrix = pickle.loads(open(sys.argv[1], 'rb').read())\n"
        "assert boost(np.arange(60.0)[:, None], np.arange(60.0), how)[0].predict(np.zeros((2, 1))).shape == (2,)\n"
        "assert matrix(50, 2, 3, 3, 7).shape == (11, 11)\n"
        "assert 'ledgerlark' not in sys.modules\n"
    )
    done = subprocess.run([sys.executable, "-c", code, str(payload)], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_recursive_forecast_feeds_predictions_back(spark, panel):
    """Against a plain loop over the horizon for one series, with the features recomputed by the feature operator."""
    features = S.lag_features(panel).where("NOT is_test AND series_id = 'a'").orderBy("day").toPandas()
    names = S.feature_names()
    trees, _ = fit(features[names].to_numpy(dtype=float), features["value"].to_numpy(dtype=float), SMALL)
    got = [r[0] for r in rows(forecast.boosted(panel, "m", SMALL).where("series_id = 'a'").orderBy("day"), "forecast")]
    fixed = [r[0] for r in rows(forecast.forecast_recursive(trees, panel, "m").where("series_id = 'a'").orderBy("day"), "forecast")]
    history = [float(r[0]) for r in rows(panel.where("series_id = 'a' AND NOT is_test").orderBy("day"), "value")]
    first = START + timedelta(len(history))
    for step in range(21):
        day = first + timedelta(step)
        x = [history[-k] for k in S.LAGS] + [np.mean(history[-k:]) for k in S.ROLLS]
        x += [day.weekday(), day.month, day.day, 0]
        history.append(float(trees.predict(np.array([x], dtype=float))[0]))
    assert got == pytest.approx(history[-21:]) and fixed == pytest.approx(history[-21:])


def test_every_series_gets_every_day(panel):
    out = forecast.boosted(panel, "m", SMALL).toPandas()
    assert out.groupby("series_id").size().to_dict() == {"a": 21, "b": 21, "short": 21, "gappy": 21}
    assert out["forecast"].notna().all()
    assert set(out.loc[out["series_id"] == "short", "reason"]) == {"short"}
    assert out.loc[out["series_id"] != "short", "reason"].isna().all()
    mae = (out["forecast"] - out["actual"]).abs().groupby(out["series_id"]).mean()
    assert mae["a"] < 5 and mae["b"] < 5


def test_forecasts_do_not_depend_on_partitions(panel, conf):
    seen = []
    for n in ("1", "3", "8"):
        conf("spark.sql.shuffle.partitions", n)
        seen.append(forecast.boosted(panel.repartition(int(n)), "m", SMALL).orderBy("series_id", "day").toPandas())
    assert seen[0].equals(seen[1]) and seen[0].equals(seen[2])


def test_importance_is_sorted_and_complete(panel):
    got = forecast.importance(panel, SMALL).collect()
    assert {r.feature for r in got} == set(S.feature_names())
    gains = [r.gain for r in got]
    assert gains == sorted(gains, reverse=True) and sum(gains) == pytest.approx(1)


def test_ensemble_walks_to_the_leaf():
    one = Ensemble(np.array([[0, 0, 0]]), np.array([[1.5, 0, 0]]), np.array([[1, 1, 2]]), np.array([[2, 1, 2]]),
                   np.array([[0.0, 10.0, 20.0]]), np.array([0.5]), 1)
    assert one.predict(np.array([[1.5], [1.6]])).tolist() == [5.0, 10.0]


def test_monthly_rollup_adds_up(spark):
    daily = forecast.naive(S.split(series(spark, range(60)), 40))
    months = forecast.monthly_rollup(daily).orderBy("month").collect()
    assert [m.days for m in months] == [11, 28, 1]
    assert sum(m.actual for m in months) == sum(range(20, 60))
