"""Date and calendar column builders."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lag_date(as_of: Column, unit: Column, count: Column) -> Column:
    """start of a look-back window.

    day n  -> as_of - n days;  month n -> add_months(as_of, -n) (clipped to the
    month end, Q5/Q6 corrected);  month 0 / year 0 -> first day of the month /
    year;  year n -> add_months(as_of, -12n);  count NULL ("all") -> NULL.
    """
    return (F.when(count.isNull(), F.lit(None).cast("date"))
            .when(unit == "day", F.date_sub(as_of, count))
            .when((unit == "month") & (count == 0), F.trunc(as_of, "MM"))
            .when(unit == "month", F.add_months(as_of, -count))
            .when((unit == "year") & (count == 0), F.trunc(as_of, "YYYY"))
            .when(unit == "year", F.add_months(as_of, -12 * count)))


def validate_lookbacks(lookbacks) -> list[tuple[str, int | None]]:
    """Config check done on the driver before any job: units must be known and
    month/year counts non-negative (the reference raises for those)."""
    out = []
    for unit, count in lookbacks:
        if unit not in ("day", "month", "year", "all"):
            raise ValueError(f"unknown look-back unit {unit!r}")
        if count is not None and not isinstance(count, int):
            try:
                count = int(count)
            except (TypeError, ValueError):
                count = None  # non-number means all history
        if unit == "all":
            count = None
        if count is not None and count < 0 and unit in ("month", "year"):
            raise ValueError(f"look-back {unit} must not be negative")
        out.append((unit, count))
    return out


def compact_date(s: Column) -> Column:
    """date part of a `YYYYmmdd...` argument."""
    return F.to_date(F.substring(s, 1, 8), "yyyyMMdd")


def half_day_period_end(ts: Column, am_end: str = "09:00:00",
                        pm_end: str = "17:30:00") -> Column:
    """End of the half-day publication period holding `ts`.

    Periods: (previous day 17:30, day 09:00] is the AM period of the day,
    (09:00, 17:30] the PM period; after 17:30 a row belongs to the next day's AM.
    """
    day = F.date_trunc("day", ts)
    am = day + F.expr(f"interval '{am_end}' hour to second")
    pm = day + F.expr(f"interval '{pm_end}' hour to second")
    return F.when(ts <= am, am).when(ts <= pm, pm).otherwise(am + F.expr("interval 1 day"))


def is_am_period(period_end: Column, am_end: str = "09:00:00") -> Column:
    return F.date_format(period_end, "HH:mm:ss") == F.lit(am_end)


def day_sequence(start: Column, end: Column) -> Column:
    """Inclusive list of days; start after end gives an empty list (Q20)."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))) \
        .otherwise(F.array().cast("array<date>"))


def hour_sequence(start: Column, end: Column) -> Column:
    """Inclusive list of hours; start after end gives an empty list."""
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 hour"))) \
        .otherwise(F.array().cast("array<timestamp>"))


def parse_compact(s: str) -> _dt.datetime:
    """Driver-side parse of a `YYYYmmdd` or `YYYYmmddHH` job argument."""
    return _dt.datetime.strptime(s, "%Y%m%d%H" if len(s) == 10 else "%Y%m%d")
