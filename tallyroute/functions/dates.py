"""Date helpers; every relative window is resolved against an explicit ``as_of``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Kolkata"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day_text(value) -> Column:
    return F.date_format(_col(value), "yyyy-MM-dd")


def short_day_text(value) -> Column:
    return F.date_format(_col(value), "dd MMM yy")


def stamp_text(value) -> Column:
    return F.date_format(_col(value), "dd-MM-yyyy HH:mm:ss")


def parse_stamp(value, pattern: str = "dd-MM-yyyy HH:mm:ss") -> Column:
    return F.try_to_timestamp(_col(value), F.lit(pattern))


def completed_years(born, at) -> Column:
    """Whole birthdays passed; 29 February counts only once the day itself is over.  Whoever is
    born later has no age."""
    return F.when(_col(born) <= _col(at), F.timestamp_diff("YEAR", _col(born), _col(at)))


def local_time(value, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in ``zone`` of a UTC instant."""
    return F.from_utc_timestamp(_col(value).cast("timestamp"), zone)


def as_datetime(as_of) -> datetime:
    return as_of if isinstance(as_of, datetime) else datetime.fromisoformat(str(as_of))


def midnight(as_of) -> datetime:
    return as_datetime(as_of).replace(hour=0, minute=0, second=0, microsecond=0)


def in_range(value, start: datetime | None = None, end: datetime | None = None) -> Column:
    """Half-open range on the raw column: reaches the scan as a pushed filter."""
    column, found = _col(value), None
    for bound, test in ((start, column.__ge__), (end, column.__lt__)):
        if bound is not None:
            part = test(F.lit(bound).cast("timestamp_ntz"))
            found = part if found is None else found & part
    return F.lit(True) if found is None else found


def yesterday(value, as_of) -> Column:
    day = midnight(as_of)
    return in_range(value, day - timedelta(days=1), day)


def since_days(value, as_of, days: int) -> Column:
    """Calendar days: from midnight ``days`` days ago on."""
    return in_range(value, midnight(as_of) - timedelta(days=days))


def month_to_date(value, as_of) -> Column:
    return in_range(value, midnight(as_of).replace(day=1))


def older_than_days(value, as_of, days: int) -> Column:
    """Strictly before the instant ``days`` days ago."""
    return in_range(value, end=as_datetime(as_of) - timedelta(days=days))


def from_day(value, day) -> Column:
    return in_range(value, midnight(day))
