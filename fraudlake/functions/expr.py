"""Column expressions shared by sources, SCD2 and the rules.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fraudlake.schemas import FLAG_LIVE, OPEN_END

# File names look like ``transactions_DDMMYYYY.txt`` (fixed pattern).
FILE_NAME_PATTERN = r"^(.*)_(\d{8})\.(\w+)$"
FILE_DATE_FORMAT = "ddMMyyyy"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal (never the session-zone TIMESTAMP)."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    elif not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def open_end() -> Column:
    return ts_lit(OPEN_END)


def trunc_seconds(c: str | Column) -> Column:
    """Drop sub-second digits of a TIMESTAMP_NTZ, independent of session zone.

    ``date_trunc`` would go through the session-zone TIMESTAMP type.
    """
    c = col(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c),
                                F.hour(c), F.minute(c), F.second(c))


def day_start(c: str | Column) -> Column:
    """Midnight of the calendar day of a TIMESTAMP_NTZ, as TIMESTAMP_NTZ."""
    return F.to_date(col(c)).cast("timestamp_ntz")


def minus_seconds(c: str | Column, seconds: int = 1) -> Column:
    return col(c) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def plus_interval(c: str | Column, interval: str) -> Column:
    """``ts + interval '20 minutes'``; stays TIMESTAMP_NTZ."""
    return col(c) + F.expr(f"interval {interval}")


def parse_ts(c: str | Column) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` to TIMESTAMP_NTZ; bad text gives NULL."""
    return trunc_seconds(F.trim(col(c)).try_cast("timestamp_ntz"))


def parse_amount(c: str | Column) -> Column:
    """Decimal-comma text to decimal(10,2); bad text gives NULL (ANSI-safe)."""
    return F.regexp_replace(F.trim(col(c)), ",", ".").try_cast("decimal(10,2)")


def blank_to_null(c: str | Column) -> Column:
    """Oracle stores '' as NULL; blanks around text (CHAR padding) are dropped."""
    t = F.trim(col(c))
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def file_kind(name: str | Column) -> Column:
    return F.regexp_extract(col(name), FILE_NAME_PATTERN, 1)


def file_date(name: str | Column) -> Column:
    """Date suffix of a file name as TIMESTAMP_NTZ midnight; bad name gives NULL."""
    return F.try_to_date(F.nullif(F.regexp_extract(col(name), FILE_NAME_PATTERN, 2), F.lit("")),
                         FILE_DATE_FORMAT).cast("timestamp_ntz")


def file_ext(name: str | Column) -> Column:
    return F.regexp_extract(col(name), FILE_NAME_PATTERN, 3)


def base_name(path: str | Column) -> Column:
    return F.regexp_extract(col(path), r"([^/]*)$", 1)


def fio(last: str | Column, first: str | Column, patronymic: str | Column) -> Column:
    """Full name with Oracle concatenation: a NULL part counts as ''."""
    return F.concat(F.coalesce(col(last), F.lit("")), F.lit(" "),
                    F.coalesce(col(first), F.lit("")), F.lit(" "),
                    F.coalesce(col(patronymic), F.lit("")))


def is_different(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe "some attribute differs" over paired column lists."""
    out = F.lit(False)
    for a, b in zip(left, right, strict=True):
        out = out | ~a.eqNullSafe(b)
    return out


def is_current(effective_to: str = "effective_to", deleted_flg: str = "deleted_flg") -> Column:
    """Open, not deleted version."""
    return (F.col(effective_to) == open_end()) & (F.col(deleted_flg) == FLAG_LIVE)


def on_day(ts: str | Column, day: dt.date | str | Column) -> Column:
    """Calendar-day filter written so Catalyst turns it into a pushed range."""
    d = day if isinstance(day, Column) else F.lit(str(day)).cast("date")
    return F.to_date(col(ts)) == d


def format_ts(c: str | Column) -> Column:
    """Text form of a moment, safe for the 9999 sentinel on the driver side."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")
