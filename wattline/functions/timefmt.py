"""Timestamp parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattline.contracts import TIMESTAMP_FORMATS, WEEKEND_DAYS


# The shapes of TIMESTAMP_FORMATS: dashes with the year first, slashes with the day first; seconds may be missing.
_TIME = r" [0-9]{2}:[0-9]{2}(:[0-9]{2})?\z"
_DASHED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}" + _TIME
_SLASHED = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}" + _TIME


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(text, formats: list[str] = TIMESTAMP_FORMATS) -> Column:
    """First layout that parses wins; no layout -> null (PRJ-06).

    Returns a local wall-clock `timestamp_ntz`; needs session zone UTC, which
    `wattline.session.configure` sets, so the cast back is exact.

    The usual layouts are told apart by shape and cast, which costs a third of
    letting formatters reject text one after the other (a rejection is an
    exception inside); other layouts go through formatters.
    """
    t = _as_col(text)
    if list(formats) == TIMESTAMP_FORMATS:
        day_first = F.concat(F.substring(t, 7, 4), F.lit("-"), F.substring(t, 4, 2), F.lit("-"), F.substring(t, 1, 2),
                             F.substring(t, 11, 9))
        return F.when(t.rlike(_DASHED), t).when(t.rlike(_SLASHED), day_first).try_cast("timestamp_ntz")
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(fmt)) for fmt in formats]).cast("timestamp_ntz")


def reading_timestamp(date, heures, formats: list[str] = TIMESTAMP_FORMATS) -> Column:
    """Timestamp from the `date` and `heures` cells joined by one space."""
    return parse_timestamp(F.concat(_as_col(date), F.lit(" "), _as_col(heures)), formats)


def floor_hour(ts) -> Column:
    """Truncate to the hour, keeping `timestamp_ntz` (PRJ-07)."""
    return F.date_trunc("hour", _as_col(ts)).cast("timestamp_ntz")


def calendar_columns(ts) -> dict[str, Column]:
    """hour, day, month, dayofweek (Monday = 0) and weekend 0/1 (PRJ-08)."""
    t = _as_col(ts)
    dow = F.weekday(t)
    return {
        "hour": F.hour(t),
        "day": F.dayofmonth(t),
        "month": F.month(t),
        "dayofweek": dow,
        "weekend": dow.isin(WEEKEND_DAYS).cast("int"),
    }
