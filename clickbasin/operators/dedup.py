"""One row per event id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ties on the event time are settled by the remaining columns in this order;
# rows equal in all of them are interchangeable.
_TIE_BREAK = ["event_type", "user_id", "session_id", "country", "value", "query", "sku", "quantity"]


def latest_per_event(events: DataFrame, *, within: Sequence[str] = (), then: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the latest ``event_ts`` (nulls last) of every ``event_id``.

    ``events`` is one batch; ``within`` names columns that split a wider input
    into batches, so that an id seen on two days stays on both. Of rows that are equal otherwise the
    one that is first in the columns ``then`` is kept.

    Ranking to 1 lets Spark drop the other copies in every map task before the
    shuffle, so an id that holds a large share of the rows sends one row per
    task and no task ever sorts the whole group.
    """
    window = Window.partitionBy(*within, "event_id").orderBy(
        F.col("event_ts").desc_nulls_last(), *[F.col(name).asc_nulls_first() for name in [*_TIE_BREAK, *then]]
    )
    rank = "_rank"
    return events.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)
