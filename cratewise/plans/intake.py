"""Which items of the saved-track pages are still to be read.

Pages come newest first. What has not been read yet is kept as gaps in time: one above the
newest item read, and, after a run that was capped, others below the point where it stopped.
A later run reads what lies in the gaps, so no item is lost by a cap.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.moments import added_time, moment
from cratewise.operators.ranking import first_rows
from cratewise.sources.documents import POSITION

GAPS = "above STRING, below STRING"


@dataclass(frozen=True)
class Gap:
    """Items added from ``above`` to ``below``, both included; None is without end."""

    above: dt.datetime | None
    below: dt.datetime | None

    def holds(self, time: Column) -> Column:
        inside = F.lit(True)
        if self.above is not None:
            inside = inside & (time >= moment(self.above))
        if self.below is not None:
            inside = inside & (time <= moment(self.below))
        return inside


def read_gaps(stored: DataFrame) -> list[Gap]:
    """Gaps as stored, at most one per capped run and one more."""
    moment_of = lambda text: dt.datetime.fromisoformat(text) if text else None
    return [Gap(*map(moment_of, row)) for row in stored.select("above", "below").collect()]


def gap_rows(gaps: list[Gap]) -> list[tuple[str | None, str | None]]:
    text = lambda time: time.isoformat() if time else None
    return [(text(gap.above), text(gap.below)) for gap in gaps]


def open_items(items: DataFrame, gaps: list[Gap]) -> DataFrame:
    """Items that lie in a gap or have no date."""
    time = added_time(F.col("added_at"))
    inside = time.isNull()
    for gap in gaps:
        inside = inside | gap.holds(time)
    return items.where(inside)


def wanted_items(items: DataFrame, gaps: list[Gap], saved: DataFrame) -> DataFrame:
    """Items that lie in a gap or have no date, with ``is_new``.

    An item is not new if its track is stored with the same date; it is read again, which
    changes nothing or brings what changed since, and does not count against a cap.
    """
    time = added_time(F.col("added_at"))
    known = saved.select(
        "track_id", F.col("added_at").alias("known_at"), F.lit(True).alias("is_known")
    )
    same = F.col("is_known") & added_time(F.col("known_at")).eqNullSafe(time)
    return (
        open_items(items, gaps)
        .join(known, "track_id", "left")
        .withColumn("is_new", ~F.coalesce(same, F.lit(False)))
        .drop("known_at", "is_known")
    )


def take(
    wanted: DataFrame, gaps: list[Gap], max_tracks: int | None, complete: bool
) -> tuple[Column, list[Gap]]:
    """Which items, by their place, are left for a later run, and the gaps after this one.

    With a cap, items are taken in input order up to the one that brings the
    ``max_tracks``-th new track. ``complete`` says that the pages go down to the oldest
    track; else gaps below their oldest item stay.
    """
    at = F.struct(*POSITION)
    stop, beyond = None, F.lit(False)
    if max_tracks:
        firsts = wanted.where("is_new").groupBy("track_id").agg(F.min(at).alias("first_at"))
        numbered = first_rows(firsts, [F.col("first_at").asc()], max_tracks, "place")
        stop = numbered.where(F.col("place") == max_tracks).select("first_at").first()
    if stop:
        kinds = [wanted.schema[name].dataType for name in POSITION]
        last = [F.lit(x).cast(kind).alias(n) for x, kind, n in zip(stop[0], kinds, POSITION)]
        beyond = at > F.struct(*last)
    time = added_time(F.col("added_at"))
    # As text: the session's time zone is UTC, that of this process need not be.
    figures = [F.max(time), F.min(time), F.max(F.when(beyond, time))]
    *times, left = wanted.agg(*[x.cast("string") for x in figures], F.count_if(beyond)).first()
    newest, oldest, left_to = [dt.datetime.fromisoformat(x) if x else None for x in times]
    ends = [newest, *[gap.above for gap in gaps if gap.below is None]]
    top = max([x for x in ends if x], default=None)
    rest: list[Gap] = []
    if left and left_to is not None:
        rest = [_below(gap, left_to) for gap in gaps]
    elif not complete and oldest is not None:
        rest = [_below(gap, oldest) for gap in gaps]
    elif not complete:
        rest = [gap for gap in gaps if gap.below is not None]
    kept = [gap for gap in rest if gap and (gap.above is None or gap.above <= gap.below)]
    if top is None:
        # Nothing dated was seen: all is still open.
        return beyond, [Gap(None, None)]
    return beyond, [Gap(top, None), *kept]


def _below(gap: Gap, time: dt.datetime) -> Gap | None:
    """The part of a gap up to ``time``."""
    if gap.above is not None and gap.above > time:
        return None
    return Gap(gap.above, time if gap.below is None else min(gap.below, time))
