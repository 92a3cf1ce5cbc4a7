"""Timestamps: epoch numbers, numeric text and ISO 8601 text to one instant."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch readings below this magnitude are seconds, others milliseconds.
EPOCH_SECONDS_BELOW = 1e11
# The accepted range of event times.
EARLIEST = "2020-01-01 00:00:00"
FUTURE_ALLOWANCE = "INTERVAL 24 HOURS"

EPOCH_TEXT = r"^-?\d+(?:\.\d+)?$"
ISO_TEXT = (
    r"^\d{4}-\d{2}(?:-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:?\d{2})?)?)?$"
)
#: The commonest layout, with a day every month has; it needs no rewriting.
PLAIN_ISO_TEXT = r"^\d{4}-\d{2}-(?:[01]\d|2[0-8])[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?Z?$"
# The year 9999 in milliseconds; Spark's calendar functions end there.
_LAST_EPOCH_MS = 253402300799999
# The last instant an ECMAScript date can hold, in milliseconds.
_LAST_DATE_MS = 8.64e15


def from_epoch(number: Column) -> Column:
    """TIMESTAMP from epoch seconds or milliseconds, cut to whole milliseconds.

    What lies past the year 9999 is a date all the same, and too new for any range:
    it comes out as the last instant Spark can write.
    """
    ms = F.when(F.abs(number) < EPOCH_SECONDS_BELOW, number * 1000).otherwise(number)
    within = F.greatest(F.least(ms, F.lit(float(_LAST_EPOCH_MS))), F.lit(-float(_LAST_EPOCH_MS)))
    return F.when(F.abs(ms) <= _LAST_DATE_MS, F.timestamp_millis(within.cast("bigint")))


def from_iso_text(text: Column) -> Column:
    """TIMESTAMP from trimmed ISO 8601 text; UTC when no zone is given.

    A day past the end of its month rolls into the next one (30 February is
    1 or 2 March), as ECMAScript reads it.
    """
    full = F.regexp_replace(
        F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2"),
        r"([T ]\d{2}:\d{2})(Z|[+-]\d{2}:\d{2})$",
        "$1:00$2",
    )
    day = F.substring(text, 9, 2).try_cast("int")
    rolled = F.concat(F.left(full, F.lit(8)), F.lit("01"), F.substring(full, F.lit(11), F.length(full))).try_cast(
        "timestamp"
    ) + F.make_dt_interval(days=day - 1)
    instant = F.when(text.rlike(PLAIN_ISO_TEXT), text.try_cast("timestamp")).when(
        text.rlike(ISO_TEXT),
        F.coalesce(full.try_cast("timestamp"), F.when(day.between(29, 31), rolled)),
    )
    return F.date_trunc("MILLISECOND", instant)


def from_text(text: Column) -> Column:
    """TIMESTAMP from trimmed text, NULL when it is neither an epoch nor ISO 8601."""
    return F.when(text.rlike(EPOCH_TEXT), from_epoch(text.try_cast("double"))).otherwise(
        from_iso_text(text)
    )


def too_old(instant: Column) -> Column:
    return instant < F.lit(EARLIEST).cast("timestamp")


def too_new(instant: Column, now: Column) -> Column:
    return instant > now + F.expr(FUTURE_ALLOWANCE)


def iso_millis(instant: Column) -> Column:
    """``2026-09-01T10:00:00.000Z``"""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
