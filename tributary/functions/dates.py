"""Date and time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions._util import as_col

__all__ = [
    "date_parts", "hour_of_text", "weekday_mon0", "day_type", "day_period",
    "quarter_text", "month_text", "tolerant_date", "tolerant_timestamp",
    "yesterday", "n_days_ago", "n_weeks_ago", "n_months_ago", "time_text",
    "date_text", "audit_stamp", "late_hours",
]

# Day-period bounds and labels (delivery analysis).
MORNING, AFTERNOON, EVENING = "Morning", "Afternoon", "Evening"
DAY_PERIOD_ORDER = [MORNING, AFTERNOON, EVENING]
WEEKDAY, WEEKEND = "Weekday", "Weekend"


def date_parts(d: Column | str) -> dict[str, Column]:
    """H1: year, month and day of a date as int."""
    d = as_col(d)
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}


def hour_of_text(t: Column | str, fmt: str = "HH:mm:ss") -> Column:
    """H3: hour of a time text; unparseable text gives null."""
    return F.hour(F.try_to_timestamp(as_col(t), F.lit(fmt)))


def weekday_mon0(d: Column | str) -> Column:
    """H4: Monday = 0 ... Sunday = 6."""
    return F.weekday(as_col(d))


def day_type(d: Column | str) -> Column:
    """H4: Weekend when weekday >= 5; a missing day falls into Weekday."""
    return F.when(weekday_mon0(d) >= 5, F.lit(WEEKEND)).otherwise(F.lit(WEEKDAY))


def day_period(hour: Column | str) -> Column:
    """H5: 6-12 Morning, 12-18 Afternoon, else (and unknown) Evening."""
    h = as_col(hour)
    return (F.when((h >= 6) & (h < 12), F.lit(MORNING))
            .when((h >= 12) & (h < 18), F.lit(AFTERNOON))
            .otherwise(F.lit(EVENING)))


def late_hours(hour: Column | str, start: int = 22, end: int = 1) -> Column:
    """Wrap-around hour window ``hour >= start OR hour < end``."""
    h = as_col(hour)
    return (h >= start) | (h < end)


def quarter_text(d: Column | str) -> Column:
    """H6: ``2022Q4``."""
    d = as_col(d)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def month_text(d: Column | str) -> Column:
    """H6: ``2022-12``."""
    return F.date_format(as_col(d), "yyyy-MM")


def tolerant_date(t: Column | str, fmt: str | None = None) -> Column:
    """H7: bad value to null (ANSI mode stays on)."""
    t = as_col(t)
    return F.try_to_date(t, fmt) if fmt else F.try_to_date(t)


def tolerant_timestamp(t: Column | str, fmt: str | None = None) -> Column:
    t = as_col(t)
    return F.try_to_timestamp(t, F.lit(fmt)) if fmt else F.try_to_timestamp(t)


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    return F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of


def yesterday(as_of=None) -> Column:
    """H8 (relative dates take an explicit ``as_of`` for repeatable runs)."""
    return F.date_sub(_as_of(as_of), 1)


def n_days_ago(n: int, as_of=None) -> Column:
    return F.date_sub(_as_of(as_of), n)


def n_weeks_ago(n: int, as_of=None) -> Column:
    return F.date_sub(_as_of(as_of), 7 * n)


def n_months_ago(n: int, as_of=None) -> Column:
    return F.add_months(_as_of(as_of), -n)


def time_text(ts: Column | str) -> Column:
    """Fixed-width ``HH:mm:ss.SSS`` (text order is time order)."""
    return F.date_format(as_col(ts), "HH:mm:ss.SSS")


def date_text(ts: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(as_col(ts), fmt)


def audit_stamp() -> Column:
    """Load time, one value per query."""
    return F.current_timestamp()
