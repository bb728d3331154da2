"""Scalar expressions of the domain, all inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"  # fixed value: letters of plates
BASE64 = r"\A[A-Za-z0-9+/]*+={0,2}\z"


def bucket(unit: str, ts: Column | str) -> Column:
    """Start of the minute, hour or day, as a timestamp without zone like its input."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def interval_bucket(seconds: int, ts: Column) -> Column:
    """Start of the interval of so many seconds (of the day's grid) that holds ``ts``."""
    day = F.date_trunc("day", ts)
    into = F.timestamp_diff("SECOND", day.cast("timestamp_ntz"), ts)
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (into - into % seconds).cast("decimal(18,6)"))


def local_time(ts: Column | str, zone: str = "Europe/Istanbul") -> Column:
    """UTC time without zone, as local time without zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts) if isinstance(ts, str) else ts)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def in_window(minute: Column, low: Column, high: Column) -> Column:
    """Whether a minute of the day lies in [low, high); low >= high wraps over midnight."""
    return F.when(low < high, (minute >= low) & (minute < high)).otherwise((minute >= low) | (minute < high))


def hhmm(minute: Column) -> Column:
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(two(F.floor(minute / 60)), F.lit(":"), two(minute % 60))


def millis_between(a: Column | str, b: Column | str) -> Column:
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MILLISECOND", col(a), col(b))


def ratio(top: Column, bottom: Column) -> Column:
    """top / max(bottom, 1)."""
    return top / F.greatest(bottom, F.lit(1))


def map_total(counts: Column) -> Column:
    return F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda a, x: a + x)


def strict_base64(value: Column) -> Column:
    """Decoded bytes, or null unless the value is base64 with its padding and nothing else."""
    return F.when((F.length(value) % 4 == 0) & value.rlike(BASE64), F.unbase64(value))


def plate_body(code: Column) -> Column:
    """The part of a plate after its province, for a code: one letter and four digits, then two
    letters and four digits, then three letters and two digits."""
    n = len(LETTERS)
    one, two = n * 10_000, n * n * 10_000
    letter = lambda i: F.substring(F.lit(LETTERS), i.cast("int") + 1, F.lit(1))
    digits = lambda x, k: F.lpad(x.cast("string"), k, "0")
    b, c = code - one, code - one - two
    j, k = F.floor(b / 10_000), F.floor(c / 100)
    return (
        F.when(code < one, F.concat(letter(F.floor(code / 10_000)), F.lit(" "), digits(code % 10_000, 4)))
        .when(b < two, F.concat(letter(F.floor(j / n)), letter(j % n), F.lit(" "), digits(b % 10_000, 4)))
        .otherwise(F.concat(letter(F.floor(k / (n * n))), letter(F.floor(k / n) % n), letter(k % n), F.lit(" "), digits(c % 100, 2)))
    )
