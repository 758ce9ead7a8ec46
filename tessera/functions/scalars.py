"""Scalar column expressions: dates, timestamps, strings, math (F rows)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def minutes_between(start, end) -> Column:
    """(end - start) in minutes as DOUBLE (microsecond precision)."""
    s = F.unix_micros(_c(start).cast("timestamp"))
    e = F.unix_micros(_c(end).cast("timestamp"))
    return (e - s) / F.lit(60_000_000.0)


def parse_ampm(col, fmt: str = "MM/dd/yyyy h:mm:ss a") -> Column:
    """``%m/%d/%Y %I:%M:%S %p`` text to timestamp; bad text gives NULL."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def weekday_name(ts) -> Column:
    return F.lower(F.date_format(_c(ts), "EEEE"))


def month_abbrev(ts) -> Column:
    return F.lower(F.date_format(_c(ts), "MMM"))


def rush_hour(ts) -> Column:
    """Weekday 06:00-09:59 or 16:00-19:59."""
    h = F.hour(_c(ts))
    weekday = ~F.dayofweek(_c(ts)).isin(1, 7)
    return (weekday & (h.between(6, 9) | h.between(16, 19))).cast("int")


def day_part_flags(ts) -> dict[str, Column]:
    """am 06-09, daytime 10-15, pm 16-19, night 20-05 (0/1 each)."""
    h = F.hour(_c(ts))
    return {"am_rush": h.between(6, 9).cast("int"),
            "daytime": h.between(10, 15).cast("int"),
            "pm_rush": h.between(16, 19).cast("int"),
            "nighttime": ((h >= 20) | (h <= 5)).cast("int")}


# Java's \d and \W are ASCII classes; they are written out explicitly so any
# engine with a different default class reads them the same way.
DIGIT = "[0-9]"
NON_WORD = "[^a-zA-Z0-9_]"


def count_digits(text) -> Column:
    return F.regexp_count(_c(text), F.lit(DIGIT)).cast("bigint")


def count_non_word(text) -> Column:
    return F.regexp_count(_c(text), F.lit(NON_WORD)).cast("bigint")


def is_alpha(text) -> Column:
    return _c(text).rlike(r"^\p{L}+$")


def log_odds(p) -> Column:
    return F.ln(_c(p) / (F.lit(1.0) - _c(p)))
