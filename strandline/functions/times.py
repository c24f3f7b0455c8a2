"""Time columns: five encodings, their day in a job's zone, and pushable predicates.

The session's zone is UTC; jobs convert explicitly, so one session serves all.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

ENCODINGS = ("unix_s", "unix_ms", "unix_us", "datetime", "timestamp")
_FROM_EPOCH = {"unix_s": F.timestamp_seconds, "unix_ms": F.timestamp_millis, "unix_us": F.timestamp_micros}
_SCALE = {"unix_s": 1, "unix_ms": 1_000, "unix_us": 1_000_000}


def day_of(column: Column, encoding: str, tz: str) -> Column:
    """The row's date in zone ``tz`` as yyyy-MM-dd."""
    if encoding in _FROM_EPOCH:
        column = F.from_utc_timestamp(_FROM_EPOCH[encoding](column), tz)
    elif encoding == "timestamp":
        column = F.from_utc_timestamp(column, tz)
    elif encoding != "datetime":
        raise ValueError(f"unknown time encoding {encoding!r}")
    return F.date_format(column, "yyyy-MM-dd")


def literal(at: datetime, encoding: str, tz: str) -> Column:
    """``at`` (aware) as a literal comparable with the raw column: whole seconds, but for unix_ms and unix_us."""
    if encoding in ("unix_ms", "unix_us"):
        return F.lit(round(at.timestamp() * 1_000_000) * _SCALE[encoding] // 1_000_000)
    seconds = int(at.timestamp())
    if encoding == "unix_s":
        return F.lit(seconds)
    if encoding == "datetime":
        wall = datetime.fromtimestamp(seconds, ZoneInfo(tz)).replace(tzinfo=None)
        return F.lit(wall.isoformat(sep=" ")).cast("timestamp_ntz")
    if encoding == "timestamp":
        return F.timestamp_seconds(F.lit(seconds))
    raise ValueError(f"unknown time encoding {encoding!r}")


def compared(column: str, op: str, at: datetime, encoding: str, tz: str) -> Column:
    """``column op at`` with the column bare, so that it can be pushed to the source."""
    c, v = F.col(column), literal(at, encoding, tz)
    return {"<": c < v, "<=": c <= v, ">": c > v, ">=": c >= v}[op]


@dataclass(frozen=True)
class Before:
    """Rows whose time column lies before an instant, for Spark and for a database; both round alike."""

    name: str
    at: datetime
    encoding: str
    tz: str

    def column(self) -> Column:
        return compared(self.name, "<", self.at, self.encoding, self.tz)

    def sql(self, quoted: str) -> str:
        """A predicate with the column bare, so that the database can use an index on it."""
        seconds = int(self.at.timestamp())
        if self.encoding in _SCALE:
            value = str(round(self.at.timestamp() * 1_000_000) * _SCALE[self.encoding] // 1_000_000 if self.encoding != "unix_s" else seconds)
        elif self.encoding == "datetime":
            value = f"TIMESTAMP('{datetime.fromtimestamp(seconds, ZoneInfo(self.tz)).replace(tzinfo=None).isoformat(sep=' ')}')"
        else:
            value = f"FROM_UNIXTIME({seconds})"
        return f"{quoted} < {value}"


def day_bounds(day: str, tz: str) -> tuple[datetime, datetime]:
    """Half-open range of a local day; right over changes of daylight saving."""
    d, zone = date.fromisoformat(day), ZoneInfo(tz)
    at = lambda x: datetime(x.year, x.month, x.day, tzinfo=zone)
    return at(d), at(d + timedelta(days=1))


def in_days(column: str, first: str, last: str, encoding: str, tz: str) -> Column:
    return compared(column, ">=", day_bounds(first, tz)[0], encoding, tz) & compared(column, "<", day_bounds(last, tz)[1], encoding, tz)


def today(now: datetime, tz: str) -> str:
    return now.astimezone(ZoneInfo(tz)).date().isoformat()


def utc_now() -> datetime:
    return datetime.now(timezone.utc)
