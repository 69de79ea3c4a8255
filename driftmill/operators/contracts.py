"""Rules of acquisition as they show in data: what a failed answer asks for, when it may be tried again, and whether a log of requests kept its limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftmill.operators.order import placed

#: Answers that pass by themselves, besides those from 500 on (fixed values).
PASSING = (408, 425, 429)


def error_class(status: Column, message: Column) -> Column:
    """What an answer asks for: ``none``, ``retry`` (it passes by itself), ``recover`` (fields came back null against their contract) or ``fatal``.

    An answer without a status is retried only if it says that the connection was lost.
    """
    text = F.lower(F.coalesce(message, F.lit("")))
    return (
        F.when(status.isin(*PASSING) | (status >= 500), "retry")
        .when(text.rlike("cannot return null for non-nullable"), "recover")
        .when(status.isNull() & text.rlike(r"timed? ?out|connection (?:reset|aborted|refused)|retry later"), "retry")
        .when(status.isNull() & (text == "") | (status < 400), "none")
        .otherwise("fatal")
    )


def retry_delay(status: Column, retry_after: Column, attempt: Column, most: int = 300) -> Column:
    """Seconds to wait before the next attempt: what the answer names, else 2**attempt, at most most; null where there is no retry."""
    told = F.trim(retry_after).try_cast("double")
    wait = F.when(told >= 0, told).otherwise(F.pow(F.lit(2.0), attempt))
    return F.when(status.isin(*PASSING) | (status >= 500), F.least(wait, F.lit(float(most))))


def rate_breaks(log: DataFrame, at: str, key: str, spacing_us: int, most: int, within_us: int = 60_000_000) -> DataFrame:
    """Requests that came too early: key, at, spacing (to the one before), span (from the one that stands most places before).

    Two limits hold at once: spacing_us between neighbours, and no more than most requests within any within_us. at is in
    microseconds; equal times are put in order by the key, which must be unique.
    """
    rows = placed(log.select(key, at).where(F.col(at).isNotNull()), [], [F.col(at), F.col(key)], "__i")
    earlier = lambda n, name: rows.select((F.col("__i") + n).alias("__i"), F.col(at).alias(name))
    told = rows.join(earlier(1, "__one"), "__i", "left").join(earlier(most, "__many"), "__i", "left")
    out = told.select(key, at, (F.col(at) - F.col("__one")).alias("spacing"), (F.col(at) - F.col("__many")).alias("span"))
    return out.where((F.col("spacing") < spacing_us) | (F.col("span") < within_us))
