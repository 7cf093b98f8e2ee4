"""Column expressions shared by the plans. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def zero_pad(code: Column, width: int = 5) -> Column:
    """Left-pad with zeros; longer codes are kept whole, which plain lpad would cut."""
    text = code.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


# Spellings that a cell may use; the first that fits is taken.
TIMESTAMP_FORMATS = (
    TIMESTAMP_FORMAT, "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss.SSS",
)


def coerce_timestamp(text: Column, formats: tuple[str, ...] = TIMESTAMP_FORMATS) -> Column:
    """Parse a timestamp string; anything unparseable becomes NULL instead of failing the job."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])


def whole_number(text: Column, kind: T.DataType) -> Column:
    """A whole number, which may be spelled 40.0; a fraction fails the job instead of being cut off."""
    value = text.cast("double")
    lossy = F.raise_error(F.concat(F.lit("not a whole number: "), text))
    return F.when(value == F.floor(value), value.cast(kind)).when(value.isNull(), F.lit(None).cast(kind)).otherwise(lossy.cast(kind))


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "month")


def whole_months(later: Column, earlier: Column) -> Column:
    """Months between two month starts."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def days_between(end: Column, start: Column) -> Column:
    """Calendar-day difference, independent of the time of day."""
    return F.datediff(end.cast("date"), start.cast("date"))


def ratio(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """numerator / denominator rounded half-up, NULL for a zero denominator.

    Both sides are narrowed to 22 digits first: a decimal(38,s) divided by a decimal(38,s) keeps six decimals only,
    and rounding a quotient that was already rounded can move a value across a midpoint.
    """
    top = numerator.cast("decimal(22,4)")
    bottom = F.nullif(denominator.cast("decimal(22,4)"), F.lit(0).cast("decimal(22,4)"))
    return F.round(top / bottom, places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return ratio(part.cast("decimal(22,4)") * 100, whole, places)


def count_where(condition: Column) -> Column:
    """Number of rows that satisfy the condition; NULL counts as not satisfied, and no rows give 0."""
    return F.count_if(condition)


def first_match(rules: list[tuple[Column, str]], otherwise: str) -> Column:
    """Searched CASE from an ordered rule list."""
    chain = F
    for condition, label in rules:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def mean_abs_error(actual: Column, forecast: Column) -> Column:
    return F.sum(F.abs(actual - forecast)).cast("double") / F.count(actual - forecast)


def root_mean_sq_error(actual: Column, forecast: Column) -> Column:
    error = actual - forecast
    return F.sqrt(F.sum(error * error).cast("double") / F.count(error))


def mean_abs_pct_error(actual: Column, forecast: Column) -> Column:
    """Days whose actual value is zero have no percentage error and are left out of the mean."""
    a = actual.cast("double")
    return F.avg(F.abs((a - forecast.cast("double")) / F.nullif(a, F.lit(0.0)))) * 100
