"""Scalar feature columns.

Every function returns a ``Column`` built from built-in expressions, so it
stays inside whole-stage codegen.  Division uses ``try_divide`` so that ANSI
mode (on by default in Spark 4) yields NULL for x/0 like the original jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values that must equal the original jobs' labels ---------------
# time of day: hours 5-11, 12-16, 17-20, otherwise night
TIME_OF_DAY_LABELS = ("Утро", "День", "Вечер", "Ночь")
# month-over-month status: no previous row, growth, flat, decline
GROWTH_LABELS = ("Нет данных", "Рост", "Плато", "Падение")
# price class: below 10, 10..50 inclusive, above 50
PRICE_CLASS_LABELS = ("Дешевые", "Средняя стоимость", "Дорогие")
# speed buckets (km/h) and distance buckets (miles), left-closed
SPEED_BUCKETS = ((10, "0-10 kmh"), (20, "10-20 kmh"), (30, "20-30 kmh"), (None, "30+ kmh"))
DISTANCE_BUCKETS = ((1, "0-1 mi"), (3, "1-3 mi"), (5, "3-5 mi"), (10, "5-10 mi"), (None, "10+ mi"))
KM_PER_MILE = 1.60934


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duration_minutes(start: str | Column, end: str | Column) -> Column:
    """Whole-second difference of two timestamps, in minutes."""
    return (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 60


def month_start(ts: str | Column) -> Column:
    """First day of the month, as a DATE (date_trunc gives a timestamp)."""
    return F.trunc(F.to_date(_c(ts)), "month")


def is_weekend(ts: str | Column) -> Column:
    """E5: 1 when the day of week (1=Sunday) is Saturday or Sunday."""
    return F.when(F.dayofweek(_c(ts)).isin(1, 7), 1).otherwise(0)


def time_of_day(hour: str | Column) -> Column:
    """E6."""
    h = _c(hour)
    morning, day, evening, night = TIME_OF_DAY_LABELS
    return (F.when((h >= 5) & (h < 12), morning)
            .when((h >= 12) & (h < 17), day)
            .when((h >= 17) & (h < 21), evening)
            .otherwise(night))


def is_rush_hour(hour: str | Column) -> Column:
    """7-10 or 16-19 inclusive."""
    h = _c(hour)
    return F.when(h.between(7, 10) | h.between(16, 19), 1).otherwise(0)


def speed_kmh(distance_mi: str | Column, minutes: str | Column) -> Column:
    """NULL when the duration is not positive."""
    m = _c(minutes)
    return F.when(m > 0, (_c(distance_mi) * KM_PER_MILE) / (m / 60.0))


def speed_mph(distance_mi: str | Column, minutes: str | Column) -> Column:
    """0 when the duration is not positive."""
    m = _c(minutes)
    return F.when(m > 0, _c(distance_mi) / (m / 60.0)).otherwise(0.0)


def ratio(num: str | Column, den: str | Column) -> Column:
    """ANSI-safe ratio (x/0 -> NULL)."""
    return F.try_divide(_c(num), _c(den))


def flag(cond: Column) -> Column:
    """E11-style 0/1 integer flag."""
    return F.when(cond, 1).otherwise(0)


def per_minute(amount: str | Column, minutes: str | Column) -> Column:
    """NULL when the duration is not positive."""
    m = _c(minutes)
    return F.when(m > 0, F.try_divide(_c(amount), m))


def per_hour(amount: str | Column, start: str | Column, end: str | Column) -> Column:
    """Amount / (seconds / 3600); NULL for a zero-length interval."""
    hours = (F.unix_timestamp(_c(end)) - F.unix_timestamp(_c(start))) / 3600.0
    return F.try_divide(_c(amount), hours)


def bucket(value: str | Column, bounds) -> Column:
    """Left-closed buckets from ``((upper, label), ..., (None, label))``.

    A NULL value falls through to the last label, as chained ``when`` does.
    """
    v = _c(value)
    expr = None
    for upper, label in bounds:
        if upper is None:
            return expr.otherwise(label) if expr is not None else F.lit(label)
        expr = F.when(v < upper, label) if expr is None else expr.when(v < upper, label)
    return expr


def typed_coalesce(c: str | Column, dtype: str, default=0) -> Column:
    """ANSI-safe cast with a default for NULL or unparsable values.

    Integers also accept decimal text (``'1.0'`` is 1, as a number cast is).
    """
    tries = [_c(c).try_cast(dtype)]
    if dtype.lower() in ("byte", "tinyint", "short", "smallint", "int", "integer", "long", "bigint"):
        tries.append(_c(c).cast("string").try_cast("double").try_cast(dtype))
    return F.coalesce(*tries, F.lit(default).cast(dtype))


def parse_multi_date(s: str | Column) -> Column:
    """E17: "MMM d, yyyy" -> else "MMM yyyy" (first of month) -> else default."""
    text = _c(s)
    return F.coalesce(
        F.try_to_date(text, "MMM d, yyyy"),
        F.when(text.rlike(r"^[A-Za-z]{3} \d{4}$"), F.try_to_date(text, "MMM yyyy")),
        F.try_to_date(text),
    )


def epoch_to_timestamp(seconds: str | Column) -> Column:
    """Epoch seconds -> wall-clock TIMESTAMP_NTZ (UTC), whatever the
    session time zone (``timestamp_seconds`` + cast would shift with it)."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=_c(seconds))


def format_minute(ts: str | Column) -> Column:
    """E18."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm")


def days_since(d: str | Column, as_of: str) -> Column:
    """Whole days from ``d`` to a fixed ``as_of`` date."""
    return F.datediff(F.to_date(F.lit(as_of)), F.to_date(_c(d)))


def price_class(price: str | Column, low: float = 10, high: float = 50) -> Column:
    """CASE without ELSE — NULL price stays unclassified."""
    p = _c(price)
    cheap, mid, dear = PRICE_CLASS_LABELS
    return F.when(p < low, cheap).when((p >= low) & (p <= high), mid).when(p > high, dear)


def abs_error(pred: str | Column, actual: str | Column) -> Column:
    return F.abs(_c(pred) - _c(actual))


def pct_error(pred: str | Column, actual: str | Column) -> Column:
    """|p - a| / a * 100, 0 when the actual value is 0."""
    a = _c(actual)
    return F.when(a == 0, 0.0).otherwise(F.abs(_c(pred) - a) / a * 100)


def route(origin: str | Column, dest: str | Column) -> Column:
    """E15: "A-B" (NULL if either side is NULL)."""
    return F.concat(_c(origin), F.lit("-"), _c(dest))


def hour_from_hhmm(hhmm: str | Column) -> Column:
    """Hour of an HHMM integer time."""
    return (_c(hhmm) / 100).try_cast("int")


def growth_status(change: str | Column, previous: str | Column) -> Column:
    """Label by sign of the change; first row of a series -> no data."""
    ch = _c(change)
    none_, up, flat, down = GROWTH_LABELS
    return (F.when(_c(previous).isNull(), none_)
            .when(ch > 0, up).when(ch == 0, flat).when(ch < 0, down))


def add_time_features(df: DataFrame, ts: str) -> DataFrame:
    """E2-E7 in one projection: month, calendar parts and day-part flags."""
    t = F.col(ts)
    return df.withColumns({
        "date_month": month_start(t),
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
        "day_of_week": F.dayofweek(t),
        "hour": F.hour(t),
        "is_weekend": is_weekend(t),
    }).withColumns({
        "time_of_day": time_of_day("hour"),
        "is_rush_hour": is_rush_hour("hour"),
    })
