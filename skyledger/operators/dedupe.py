"""First-wins deduplication, inside a run and against the stored events."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The first row per key, by ``order``.

    An aggregate instead of a window: every task first reduces its own copies to
    one, so a key that makes up much of the data crosses the network once per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*others), F.col(order)).alias("_first"))
        .select(*[F.col(k) if k in keys else F.col(f"_first.{k}").alias(k) for k in rows.columns])
    )


def in_batch(rows: DataFrame) -> DataFrame:
    """One row per event id and delivery, the earliest in input order."""
    return first_wins(rows, ["batch_id", "batch_seq", "event_id"], "ord")


def across_batches(rows: DataFrame) -> DataFrame:
    """One row per event id over all deliveries of a run.

    ``ord`` sorts by delivery first, so this alone also gives the winners inside
    each delivery; :func:`in_batch` need not run before it.

    Ids and places alone are compared; the winners' other columns are fetched by
    their place, so the wide rows of the losers are not sorted.
    """
    return winning_rows(rows, winners(rows))


def winners(rows: DataFrame) -> DataFrame:
    """``(event_id, ord)`` of the first row of every id."""
    return rows.groupBy("event_id").agg(F.min("ord").alias("ord"))


def winning_rows(rows: DataFrame, won: DataFrame) -> DataFrame:
    """The rows at the places of :func:`winners`; a place holds one row."""
    won = won.select(F.col("event_id").alias("_won_id"), F.col("ord").alias("_won_ord"))
    return rows.join(
        won, (F.col("event_id") == F.col("_won_id")) & (F.col("ord") == F.col("_won_ord")), "left_semi"
    )


def redeliveries(incoming: DataFrame, stored: DataFrame, **hints) -> DataFrame:
    """Incoming rows whose id is stored already."""
    return incoming.join(known_ids(incoming, stored, **hints), "event_id", "left_semi")


def insert_if_absent(incoming: DataFrame, stored: DataFrame, **hints) -> DataFrame:
    """Incoming rows whose id is not stored yet."""
    return incoming.join(known_ids(incoming, stored, **hints), "event_id", "left_anti")


def known_ids(
    incoming: DataFrame,
    stored: DataFrame,
    *,
    days: Iterable[date] | None = None,
    any_supplied: bool = True,
) -> DataFrame:
    """The stored ids that occur in ``incoming``.

    The stored side is the large one, so it is reduced to the incoming ids first:
    a semi join can broadcast or Bloom-filter the incoming ids, while an anti join
    straight against the store would have to shuffle all of it.

    A derived id holds its event time, so a stored derived id can only match a
    derived one of the same event date. Callers who know the event ``days`` of
    ``incoming``, and that it has no supplied ids, spare the scan of all others: both
    conditions are on partition columns of the store.
    """
    ids = incoming.select("event_id")
    if days is None or any_supplied:
        return stored.select("event_id").join(ids, "event_id", "left_semi")
    reachable = (F.col("id_kind") == "supplied") | F.col("event_date").isin(list(days))
    return stored.where(reachable).select("event_id").join(ids, "event_id", "left_semi")
