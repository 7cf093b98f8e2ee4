"""Operators on a panel of daily series: frames with series_id, day and one or more value columns.

All of them work per series through Window.partitionBy(series_id).orderBy(day), so a chain of them needs one exchange
and one sort. A series is never longer than the calendar, whatever the volume of the sales behind it.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SERIES, DAY, VALUE = "series_id", "day", "value"

LAGS = (1, 7, 14, 28)
ROLLS = (7, 28)
# First and last day of the sales event the published features flag.
EVENT_WINDOWS = ((date(2017, 11, 24), date(2017, 11, 27)),)


def per_series() -> WindowSpec:
    return Window.partitionBy(SERIES)


def in_order() -> WindowSpec:
    return per_series().orderBy(DAY)


def one_series(df: DataFrame, name: str = "all") -> DataFrame:
    """Give a frame without groups the series_id that the operators expect."""
    return df.withColumn(SERIES, F.lit(name))


def trim(df: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Keep the days from start to end, both included."""
    if start is not None:
        df = df.where(F.col(DAY) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(DAY) <= F.lit(end).cast("date"))
    return df


def fill_calendar(df: DataFrame, *values: str, fill: float = 0) -> DataFrame:
    """One row per calendar day from the first to the last observed day; days without a row get the fill value.

    Each row is stretched up to the day before the next observation, which needs neither a calendar table nor a join.
    """
    following = F.lead(DAY).over(in_order())
    until = F.coalesce(F.date_sub(following, 1), F.col(DAY))
    stretched = df.withColumn("until", until).withColumn("slot", F.explode(F.sequence(DAY, "until")))
    observed = F.col("slot") == F.col(DAY)
    types = dict(df.dtypes)
    filled = [F.when(observed, F.col(v)).otherwise(F.lit(fill)).cast(types[v]).alias(v) for v in values]
    return stretched.select(SERIES, F.col("slot").alias(DAY), *filled)


def clean_series(df: DataFrame, start=None, end=None, values: tuple[str, ...] = (VALUE,), fill: float = 0) -> DataFrame:
    """Drop the warm-up, make the calendar continuous, then drop the incomplete tail."""
    return trim(fill_calendar(trim(df, start=start), *values, fill=fill), end=end)


def missing_days(df: DataFrame) -> DataFrame:
    """Calendar days between the first and last observation that have no row."""
    following = F.lead(DAY).over(in_order())
    gaps = df.select(SERIES, DAY, following.alias("following")).where(F.datediff("following", DAY) > 1)
    return gaps.select(
        SERIES, F.explode(F.sequence(F.date_add(DAY, 1), F.date_sub("following", 1))).alias(DAY)
    )


def rolling_mean(value: str, n: int, shift: int = 0) -> Column:
    """Mean of n rows ending `shift` rows back; NULL until n values are there."""
    frame = in_order().rowsBetween(-(n - 1) - shift, -shift)
    full = F.count(value).over(frame) == n
    return F.when(full, F.sum(value).over(frame).cast("double") / n)


def rolling_median(value: str, n: int) -> Column:
    """Median of up to n rows ending here. The ordered aggregate takes no frame, hence the sorted frame contents."""
    window = F.array_sort(F.collect_list(value).over(in_order().rowsBetween(-(n - 1), 0)))
    size = F.size(window)
    low = F.element_at(window, F.floor((size + 1) / 2).cast("int"))
    high = F.element_at(window, (F.floor(size / 2) + 1).cast("int"))
    return F.when(size > 0, (low.cast("double") + high.cast("double")) / 2)


def first_stable_day(df: DataFrame, value: str = "orders", threshold: float = 50, window: int = 7) -> DataFrame:
    """First day on which the rolling median reaches the threshold; series that never do have no row."""
    smoothed = df.withColumn("rolling", rolling_median(value, window)).where(F.col("rolling") >= threshold)
    return smoothed.groupBy(SERIES).agg(F.min(DAY).alias("first_stable_day"))


def warmup_profile(df: DataFrame, value: str = "orders", head: int = 90, low: float = 10) -> DataFrame:
    """The first `head` rows against the rest: days, median, and days below `low`."""
    segment = F.when(F.row_number().over(in_order()) <= head, "head").otherwise("rest")
    return (
        df.withColumn("segment", segment)
        .groupBy(SERIES, "segment")
        .agg(
            F.count("*").alias("days"),
            F.median(value).alias("median"),
            F.count_if(F.col(value) < low).alias("low_days"),
        )
    )


def profile(df: DataFrame) -> DataFrame:
    return df.groupBy(SERIES).agg(
        F.count("*").alias("days"), F.min(DAY).alias("first_day"), F.max(DAY).alias("last_day")
    )


def describe_series(df: DataFrame, value: str = VALUE) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles in one aggregate."""
    return (
        df.groupBy(SERIES)
        .agg(
            F.count(value).alias("count"),
            (F.sum(value).cast("double") / F.count(value)).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
            F.max(value).alias("max"),
        )
        .select(
            SERIES, "count", "mean", "std", "min",
            F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"),
            "max",
        )
    )


def last_days(df: DataFrame, n: int = 14) -> DataFrame:
    """The last n rows of each series."""
    position = df.withColumn("i", F.row_number().over(in_order())).withColumn("n", F.count("*").over(per_series()))
    return position.where(F.col("i") > F.col("n") - n).drop("i", "n")


def weekday_box(df: DataFrame, value: str = VALUE) -> DataFrame:
    """Box-plot numbers per weekday: quartiles, whiskers at 1.5 interquartile ranges, points outside."""
    group = Window.partitionBy(SERIES, "weekday")
    quartiles = F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).over(group)
    points = (
        df.select(SERIES, F.date_format(DAY, "EEEE").alias("weekday"), F.col(value).cast("double").alias("v"))
        .withColumn("q", quartiles)
        .withColumn("reach", (F.col("q")[2] - F.col("q")[0]) * 1.5)
    )
    inside = F.col("v").between(F.col("q")[0] - F.col("reach"), F.col("q")[2] + F.col("reach"))
    first = F.any_value("q")
    return points.groupBy(SERIES, "weekday").agg(
        F.count("*").alias("days"),
        first[0].alias("q25"),
        first[1].alias("median"),
        first[2].alias("q75"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def decompose(df: DataFrame, value: str = VALUE, period: int = 7) -> DataFrame:
    """Additive trend, seasonal and residual parts.

    Trend: centred moving mean over one period, shorter at the two ends. Seasonal: median distance from the trend at
    each position of the cycle, centred to sum to zero; the median keeps a one-day spike in the residual.
    """
    half = period // 2
    around = in_order().rowsBetween(-half, half)
    phase = Window.partitionBy(SERIES, "phase")
    v = F.col(value).cast("double")
    raw = (
        df.withColumn("phase", F.pmod(F.datediff(F.col(DAY), F.lit("1970-01-01").cast("date")), F.lit(period)))
        .withColumn("trend", F.sum(value).over(around).cast("double") / F.count(value).over(around))
        .withColumn("raw", F.median(v - F.col("trend")).over(phase))
        .withColumn("opens_phase", F.col(DAY) == F.min(DAY).over(phase))
    )
    once = F.when(F.col("opens_phase"), F.col("raw"))
    centred = raw.withColumn("seasonal", F.col("raw") - F.sum(once).over(per_series()) / F.count(once).over(per_series()))
    return centred.select(
        SERIES, DAY, F.col(value).alias("observed"), "trend", "seasonal",
        (v - F.col("trend") - F.col("seasonal")).alias("residual"),
    )


# --- decomposition by local lines -------------------------------------------------------------------------------


def local_lines(df: DataFrame, name: str, value: Column, weight: Column, reach: int, *keys: str) -> DataFrame:
    """Add column `name`: at every row the value of the line fitted to the rows up to `reach` places before and after it.

    Rows count by the tricube of their distance, times `weight`. The line comes from five weighted sums over the window's
    frame. Where the weights leave one place only, it is the weighted mean; where they are all 0, the frame's plain mean.
    With `keys` the rows of equal keys are a series of their own.
    """
    order = Window.partitionBy(SERIES, *keys).orderBy(DAY)
    frame = order.rowsBetween(-reach, reach)
    own = [c for c in df.columns]
    placed = df.withColumn("place", F.row_number().over(order)).withColumn("y", value).withColumn("rho", weight)
    placed = placed.withColumn("near", F.collect_list(F.struct("place", "y", "rho")).over(frame))

    def add(sums: Column, x: Column) -> Column:
        d = (x["place"] - F.col("place")).cast("double")
        side = F.lit(1.0) - F.pow(F.abs(d) / (reach + 1), F.lit(3.0))
        w = F.pow(side, F.lit(3.0)) * x["rho"]
        terms = {"w": w, "d": w * d, "dd": w * d * d, "y": w * x["y"], "dy": w * d * x["y"], "n": F.lit(1.0), "plain": x["y"]}
        return F.struct(*[(sums[k] + v).alias(k) for k, v in terms.items()])

    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("w", "d", "dd", "y", "dy", "n", "plain")])
    s = F.aggregate("near", zero, add)
    placed = placed.withColumn("s", s).withColumn("det", F.col("s.w") * F.col("s.dd") - F.col("s.d") * F.col("s.d"))
    line = (F.col("s.dd") * F.col("s.y") - F.col("s.d") * F.col("s.dy")) / F.col("det")
    fitted = F.when(F.col("det") > 1e-9 * F.col("s.w") * F.col("s.w"), line).when(F.col("s.w") > 0, F.col("s.y") / F.col("s.w"))
    return placed.select(*own, fitted.otherwise(F.col("s.plain") / F.col("s.n")).alias(name))


def decompose_robust(
    df: DataFrame, value: str = VALUE, period: int = 7, trend_reach: int = 7, season_reach: int = 3, rounds: int = 5
) -> DataFrame:
    """Additive trend, seasonal and residual parts by local lines; outliers stay in the residual.

    In each round the days of equal place in the cycle are smoothed along the cycles, what a whole cycle of that keeps
    goes to the trend, and the trend is smoothed from what is left. From the second round on a day counts by the
    bisquare of its last residual against six times the series' median one, so a day that fits nowhere bends nothing; it
    takes a few rounds until its neighbours count again. Days
    without a value count as 0. All windows share one exchange by series.
    """
    half = period // 2
    around, before, after = (in_order().rowsBetween(a, b) for a, b in ((-half, half), (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)))
    y, rho = F.col("observed"), F.col("weight")
    phase = F.pmod(F.datediff(F.col(DAY), F.lit("1970-01-01").cast("date")), F.lit(period)).alias("phase")
    parts = df.select(SERIES, DAY, F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("observed"), phase, F.lit(0.0).alias("trend"), F.lit(1.0).alias("weight"))
    for i in range(rounds):
        parts = local_lines(parts, "cycle", y - F.col("trend"), rho, season_reach, "phase")
        full = F.when(F.count("*").over(around) == period, F.avg("cycle").over(around))
        parts = parts.withColumn("full", full)
        level = F.coalesce("full", F.first("full", ignorenulls=True).over(after), F.last("full", ignorenulls=True).over(before), F.avg("cycle").over(per_series()))
        parts = parts.withColumn("seasonal", F.col("cycle") - level).drop("trend", "full", "cycle")
        parts = local_lines(parts, "trend", y - F.col("seasonal"), rho, trend_reach)
        parts = parts.withColumn("residual", y - F.col("trend") - F.col("seasonal"))
        if i + 1 < rounds:
            share = F.abs("residual") / F.nullif(6 * F.median(F.abs("residual")).over(per_series()), F.lit(0.0))
            bisquare = F.when(share < 1, F.pow(1 - share * share, F.lit(2.0))).otherwise(F.when(share.isNull(), 1.0).otherwise(0.0))
            parts = parts.withColumn("weight", bisquare).drop("seasonal", "residual")
    return parts.select(SERIES, DAY, "observed", "trend", "seasonal", "residual")


def split(df: DataFrame, test_days: int = 60) -> DataFrame:
    """Flag the last `test_days` rows of each series as is_test."""
    position = df.withColumn("i", F.row_number().over(in_order())).withColumn("n", F.count("*").over(per_series()))
    return position.withColumn("is_test", F.col("i") > F.col("n") - test_days).drop("i", "n")


def feature_names(lags: tuple[int, ...] = LAGS, rolls: tuple[int, ...] = ROLLS) -> list[str]:
    return [f"lag_{k}" for k in lags] + [f"roll_{k}" for k in rolls] + ["dow", "month", "dom", "is_event"]


def lag_features(
    df: DataFrame,
    value: str = VALUE,
    lags: tuple[int, ...] = LAGS,
    rolls: tuple[int, ...] = ROLLS,
    event_windows=EVENT_WINDOWS,
    drop_incomplete: bool = True,
) -> DataFrame:
    """Lagged values, means over the days before, calendar parts and an event flag, as in `feature_names`."""
    in_event = F.lit(False)
    for first, last in event_windows:
        in_event = in_event | F.col(DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    out = df.select(
        "*",
        *[F.lag(value, k).over(in_order()).cast("double").alias(f"lag_{k}") for k in lags],
        *[rolling_mean(value, k, shift=1).alias(f"roll_{k}") for k in rolls],
        F.weekday(DAY).alias("dow"),
        F.month(DAY).alias("month"),
        F.dayofmonth(DAY).alias("dom"),
        in_event.cast("int").alias("is_event"),
    )
    return out.dropna(subset=feature_names(lags, rolls)) if drop_incomplete else out
