"""Time columns kept as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHAPE = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(?:[.,]\d{1,9})?\s?(?:[Zz]|UTC|GMT|[+-]\d{2}(?::?\d{2})?)$"


def zoned_micros(text: Column) -> Column:
    """Microseconds since 1970 UTC of a date-time text with a time zone; null where it has none, is null, or is no time.

    Read: ``T`` or a space between date and time, an optional fraction, and as zone ``Z``, ``UTC``, ``GMT`` or an offset
    with or without colon and minutes. The offset is applied as arithmetic, so the session's time zone has no part in it.
    """
    t = F.trim(text)
    number = lambda x: F.coalesce(x.try_cast("bigint"), F.lit(0))
    digits = lambda i, n: number(F.substring(t, i, n))
    # a text of that shape has its date and time at fixed places; fraction and offset are what varies
    day = F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")
    hour, minute, second = digits(12, 2), digits(15, 2), digits(18, 2)
    fraction = F.when(F.substring(t, 20, 1).isin(".", ","), number(F.rpad(F.regexp_extract(F.substring(t, 21, 6), r"^\d+", 0), 6, "0"))).otherwise(0)
    zone = F.replace(F.regexp_extract(t, r"[+-]\d{2}:?(?:\d{2})?$", 0), F.lit(":"))
    oh, om = number(F.substring(zone, 2, 2)), number(F.substring(zone, 4, 2))
    offset = F.when(zone.startswith("-"), -(oh * 60 + om)).otherwise(oh * 60 + om)
    seconds = F.unix_date(day).cast("bigint") * 86400 + hour * 3600 + (minute - offset) * 60 + second
    return F.when(t.rlike(_SHAPE) & (hour <= 23) & (minute <= 59) & (second <= 59) & (oh <= 18) & (om <= 59), seconds * 1_000_000 + fraction)
