"""Reads of the stored tables: keyset-paged lists and containment filters."""

from __future__ import annotations

import base64
import binascii
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

READ_COLUMNS = (
    "event_id",
    "drone_id",
    "event_time",
    "event_type",
    "status_code",
    "severity",
    "battery_pct",
    "latitude",
    "longitude",
    "telemetry",
    "source",
    "ingested_at",
)
# Page sizes.
DEFAULT_PAGE = 50
MAX_PAGE = 500
_CURSOR_TIME = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?Z")


@dataclass(frozen=True)
class Cursor:
    """Where a page ended. ``(event_time, event_id)`` is a total order."""

    event_time: datetime
    event_id: str

    def encode(self) -> str:
        time = self.event_time.astimezone(timezone.utc)
        text = f"{time:%Y-%m-%dT%H:%M:%S}.{time.microsecond // 1000:03d}Z|{self.event_id}"
        return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")

    @staticmethod
    def decode(text: str | None) -> Cursor | None:
        """A malformed cursor is ignored, so the read starts at the first page."""
        if not text:
            return None
        try:
            plain = base64.urlsafe_b64decode(text + "=" * (-len(text) % 4)).decode()
        except (binascii.Error, ValueError):
            return None
        time, mark, event_id = plain.partition("|")
        if not mark or not _CURSOR_TIME.fullmatch(time):
            return None
        try:
            return Cursor(datetime.fromisoformat(time), event_id)
        except ValueError:
            return None


@dataclass(frozen=True)
class Page:
    items: list[Row]
    next_cursor: str | None


def cursor_column() -> Column:
    """The same cursor text as a column, for every row of a read."""
    plain = F.concat(
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit("|"), F.col("event_id")
    )
    encoded = F.base64(F.encode(plain, "UTF-8"))
    return F.translate(F.regexp_replace(encoded, "[=\r\n]", ""), "+/", "-_")


def _instant(value: datetime) -> Column:
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.lit(value)


def in_window(df: DataFrame, start: datetime | None, end: datetime | None) -> DataFrame:
    """Half-open ``[start, end)``; the partition date is bounded along with the time."""
    dated = "event_date" in df.columns
    if start is not None:
        df = df.where(F.col("event_time") >= _instant(start))
        if dated:
            df = df.where(F.col("event_date") >= F.lit(_utc_date(start)))
    if end is not None:
        df = df.where(F.col("event_time") < _instant(end))
        if dated:
            df = df.where(F.col("event_date") <= F.lit(_utc_date(end)))
    return df


def _utc_date(value: datetime):
    return value.astimezone(timezone.utc).date() if value.tzinfo else value.date()


def after_cursor(df: DataFrame, cursor: Cursor | None) -> DataFrame:
    """Rows past a cursor, newest first; in a form Parquet filters can use."""
    if cursor is None:
        return df
    time = _instant(cursor.event_time)
    if "event_date" in df.columns:
        df = df.where(F.col("event_date") <= F.lit(_utc_date(cursor.event_time)))
    return df.where(
        (F.col("event_time") < time)
        | ((F.col("event_time") == time) & (F.col("event_id") < cursor.event_id))
    )


def newest(df: DataFrame, limit: int) -> DataFrame:
    return df.orderBy(F.desc("event_time"), F.desc("event_id")).limit(limit)


def newest_dates(rows: DataFrame, column: str, dates: Sequence[date], limit: int) -> DataFrame:
    """``rows`` of the newest ``dates`` only, of as many as hold ``limit`` rows.

    ``dates`` are those of the table's partitions. They are opened newest first, twice as many at a time, counting
    rows, until ``limit`` are found: a page is read from a handful of dates, whatever the table holds before them.
    """
    dates = sorted(dates, reverse=True)
    at, step, missing = 0, 1, limit
    while at < len(dates) and missing > 0:
        some = dates[at : at + step]
        missing -= rows.where(F.col(column).between(F.lit(some[-1]), F.lit(some[0]))).select(F.lit(1)).limit(missing).count()
        at, step = at + len(some), 2 * step
    return rows if at >= len(dates) else rows.where(F.col(column) >= F.lit(dates[at - 1]))


def _read_columns(df: DataFrame) -> DataFrame:
    present = [c for c in READ_COLUMNS if c in df.columns]
    df = df.select(*present)
    types = dict(df.dtypes)
    if types.get("battery_pct", "").startswith("decimal"):
        df = df.withColumn("battery_pct", F.col("battery_pct").cast("double"))
    if types.get("telemetry") == "variant":
        df = df.withColumn("telemetry", F.to_json("telemetry"))
    return df


def device_events(
    events: DataFrame,
    drone_id: str,
    *,
    start: datetime | None = None,
    end: datetime | None = None,
    cursor: Cursor | None = None,
    limit: int = DEFAULT_PAGE,
    dates: Sequence[date] | None = None,
) -> DataFrame:
    """Events of one device, newest first; ``dates`` as for :func:`newest_dates`."""
    found = in_window(events.where(F.col("drone_id") == drone_id), start, end)
    return _newest_page(after_cursor(found, cursor), limit, dates, start, end, cursor)


def errors_in_window(
    events: DataFrame,
    *,
    start: datetime | None = None,
    end: datetime | None = None,
    cursor: Cursor | None = None,
    limit: int = DEFAULT_PAGE,
    dates: Sequence[date] | None = None,
) -> DataFrame:
    """Error events in a time window, newest first; ``dates`` as for :func:`newest_dates`."""
    found = in_window(events.where(F.col("severity") == "error"), start, end)
    return _newest_page(after_cursor(found, cursor), limit, dates, start, end, cursor)


def _newest_page(
    found: DataFrame,
    limit: int,
    dates: Sequence[date] | None,
    start: datetime | None,
    end: datetime | None,
    cursor: Cursor | None,
) -> DataFrame:
    if dates is not None:
        # Dates that the window or the cursor rules out need not be opened to be counted.
        latest = min((_utc_date(t) for t in (end, cursor and cursor.event_time) if t), default=date.max)
        earliest = _utc_date(start) if start else date.min
        found = newest_dates(found, "event_date", [d for d in dates if earliest <= d <= latest], limit)
    return _read_columns(newest(found, limit))


def latest_quarantine(quarantine: DataFrame, limit: int = DEFAULT_PAGE, dates: Sequence[date] | None = None) -> DataFrame:
    """The rejected records seen last; ``dates`` as for :func:`newest_dates`."""
    if dates is not None:
        quarantine = newest_dates(quarantine, "failed_date", dates, limit)
    return (
        quarantine.select("source", "raw_payload", "errors", "failed_at")
        .orderBy(F.desc("failed_at"), F.desc("source"), F.desc("raw_payload"))
        .limit(limit)
    )


def page(read, events: DataFrame, *args, limit: int = DEFAULT_PAGE, cursor: str | None = None, **kwargs) -> Page:
    """One page of :func:`device_events` or :func:`errors_in_window`.

    One row beyond the page tells whether another page exists, without a count.
    """
    limit = max(1, min(int(limit), MAX_PAGE))
    rows = read(
        events, *args, cursor=Cursor.decode(cursor), limit=limit + 1, **kwargs
    ).withColumn("_cursor", cursor_column())
    got = rows.collect()
    items = got[:limit]
    more = len(got) > limit
    plain = [Row(**{k: v for k, v in r.asDict().items() if k != "_cursor"}) for r in items]
    return Page(plain, items[-1]["_cursor"] if more and items else None)


def pages(read, events: DataFrame, *args, limit: int = DEFAULT_PAGE, **kwargs) -> Iterator[Page]:
    """All pages of a read, one after the other."""
    cursor = None
    while True:
        found = page(read, events, *args, limit=limit, cursor=cursor, **kwargs)
        yield found
        cursor = found.next_cursor
        if cursor is None:
            return


def contains(telemetry: Column, wanted: dict[str, Any]) -> Column:
    """JSON containment: every member of ``wanted`` occurs in the VARIANT ``telemetry``.

    Objects match member by member; an array matches when each wanted item equals or
    contains some item, in any order; values must agree in type as well.
    """
    return F.coalesce(_contains(telemetry, wanted), F.lit(False))


def _member(value: Column, key: str) -> Column:
    """By the key itself: in a path, quotes and other marks of a key would have a meaning."""
    return F.try_element_at(F.try_variant_get(value, "$", "map<string,variant>"), F.lit(key))


def _some_item(items: Column, wanted: Any) -> Column:
    return F.exists(items, lambda item: F.coalesce(_contains(item, wanted), F.lit(False)))


def _contains(value: Column, wanted: Any) -> Column:
    kind = F.schema_of_variant(value)
    if isinstance(wanted, dict):
        test = kind.startswith("OBJECT")
        for key, inner in wanted.items():
            test = test & F.coalesce(_contains(_member(value, key), inner), F.lit(False))
        return test
    if isinstance(wanted, (list, tuple)):
        items = F.try_variant_get(value, "$", "array<variant>")
        test = items.isNotNull()
        for inner in wanted:
            test = test & _some_item(items, inner)
        return test
    if wanted is None:
        return kind == "VOID"
    if isinstance(wanted, bool):
        return (kind == "BOOLEAN") & (F.try_variant_get(value, "$", "boolean") == wanted)
    if isinstance(wanted, int):
        # As decimals: large integers are distinct where doubles are not.
        exact = F.try_variant_get(value, "$", "decimal(38,0)") == F.lit(str(wanted)).try_cast("decimal(38,0)")
        real = F.try_variant_get(value, "$", "double")
        return F.when(kind == "BIGINT", exact).when(
            kind.startswith("DECIMAL"), exact & (real == F.rint(real))
        ).otherwise(kind.isin("DOUBLE", "FLOAT") & (real == float(wanted)))
    if isinstance(wanted, float):
        numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        return numeric & (F.try_variant_get(value, "$", "double") == float(wanted))
    return (kind == "STRING") & (F.try_variant_get(value, "$", "string") == str(wanted))


def containing(events: DataFrame, wanted: dict[str, Any]) -> DataFrame:
    """Events whose telemetry contains ``wanted``; telemetry may be VARIANT or text."""
    column = F.col("telemetry")
    if dict(events.dtypes)["telemetry"] == "string":
        column = F.try_parse_json(column)
    return events.where(contains(column, wanted))
