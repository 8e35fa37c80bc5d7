"""Date expressions (F1-F5, X6, X9, X13, X14, X23, X24). ``as_of`` is always explicit."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the source application.
FEED_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"   # strict, as strptime('%Y-%m-%dT%H:%M:%SZ')
DAY_START_SUFFIX = "0000"
DAY_END_SUFFIX = "2359"
EXPORT_DAY_FORMAT = "yyyy-MM-dd"
EXPORT_MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


def _c(x) -> Column:
    if isinstance(x, (dt.date, dt.datetime)):
        return F.lit(x)
    return F.col(x) if isinstance(x, str) else x


def ntz_lit(v) -> Column:
    """A wall-clock literal as timestamp_ntz. Built from text, so neither the session
    time zone nor the Python process's zone can shift it (``F.lit(datetime)`` can)."""
    if v is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(v, dt.datetime):
        return F.lit(v.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(v, dt.date):
        return F.lit(v.isoformat()).cast("timestamp_ntz")
    return F.lit(v).cast("timestamp_ntz")


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp_ntz by calendar arithmetic:
    no time zone is involved (casting to a zoned timestamp would shift values, and
    DST gaps would fold, in any session zone other than UTC)."""
    t = _c(ts)
    return (F.unix_date(F.to_date(t)).cast("long") * F.lit(86_400_000_000)
            + F.hour(t).cast("long") * F.lit(3_600_000_000)
            + F.minute(t).cast("long") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), t) * F.lit(1_000_000)).cast("long"))


def parse_day(s: str) -> dt.date:
    """a run parameter in ``YYYY-MM-DD``; anything else is rejected before a job starts."""
    try:
        return dt.datetime.strptime(s, "%Y-%m-%d").date()
    except ValueError as e:
        raise ValueError(f"invalid date {s!r}: use YYYY-MM-DD") from e


def target_day(as_of) -> Column:
    """Monday looks back 3 days (Friday), every other day 1 day. weekday(): Monday=0."""
    d = F.to_date(_c(as_of))
    return F.date_sub(d, F.when(F.weekday(d) == 0, F.lit(3)).otherwise(F.lit(1)))


def day_bounds(day) -> tuple[Column, Column]:
    """Request bounds ``yyyyMMdd0000`` and ``yyyyMMdd2359``."""
    d = F.date_format(_c(day), "yyyyMMdd")
    return F.concat(d, F.lit(DAY_START_SUFFIX)), F.concat(d, F.lit(DAY_END_SUFFIX))


def on_day(ts, day) -> Column:
    """half-open range on the raw column so parquet min/max statistics can prune."""
    start = F.to_date(_c(day)).cast("timestamp_ntz")
    return (_c(ts) >= start) & (_c(ts) < start + F.expr("INTERVAL 1 DAY"))


def in_day_range(ts, first_day, last_day) -> Column:
    """every day from ``first_day`` through ``last_day`` inclusive."""
    lo = F.to_date(_c(first_day)).cast("timestamp_ntz")
    hi = F.to_date(_c(last_day)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return (_c(ts) >= lo) & (_c(ts) < hi)


def backfill_range(as_of, days_back: int) -> tuple[Column, Column]:
    """end = day before ``as_of``, start = end - days_back."""
    end = F.date_sub(F.to_date(_c(as_of)), 1)
    return F.date_sub(end, days_back), end


def parse_feed_ts(s) -> Column:
    """Strict feed timestamp; anything else is NULL (the row is then rejected)."""
    return F.try_to_timestamp(_c(s), F.lit(FEED_TS_FORMAT)).cast("timestamp_ntz")


def is_on_day(s, day) -> Column:
    """a feed timestamp string falls on ``day``; unparsable -> false."""
    return F.coalesce(F.to_date(parse_feed_ts(s)) == F.to_date(_c(day)), F.lit(False))


def format_or_keep(ts, fmt: str) -> Column:
    """Format a timestamp; NULL -> ''."""
    return F.coalesce(F.date_format(_c(ts), fmt), F.lit(""))


def run_time() -> dt.datetime:
    """Now, UTC without a zone: the default time of a run."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def reformat_text_date(s, fmt: str) -> Column:
    """X13/X14 on text: a day, or a time after ``T`` or a space with an optional fraction and
    offset, is reformatted as it is written, in its own offset. Anything else is kept as it
    is; NULL -> ''."""
    t = _c(s)
    part = lambda k: F.regexp_extract(t, _TEXT_DATE, k)
    clock = F.when(part(2) == "", F.lit("00:00:00")).otherwise(part(2))
    local = F.when(t.rlike(_TEXT_DATE), F.concat_ws(" ", part(1), clock).try_cast("timestamp_ntz"))
    return F.coalesce(F.date_format(local, fmt), t, F.lit(""))


_TEXT_DATE = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2}:\d{2})(?:\.\d+)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
