"""Admission of found entries: what each way of finding them lets in, and what it makes of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import rules as R
from .merging import first_by_key


def in_range(duration: Column) -> Column:
    """Between two minutes and ten hours, both left out; unknown fails."""
    return (duration > 120) & (duration < 36_000)


def sure_long(duration: Column) -> Column:
    """At least 15 minutes; unknown fails."""
    return duration >= R.MIN_SECONDS


def from_channel(yes: object, no: object) -> Column:
    """``yes`` for an entry that was found in a channel, ``no`` for one found by search."""
    return F.when(F.col("channel_id").isNotNull(), F.lit(yes)).otherwise(F.lit(no))


@dataclass(frozen=True)
class Profile:
    """``long_enough``: of the duration. ``reject``, ``boost``: lists of words between boundaries. ``high``,
    ``low``: priorities with and without a boost. ``unknown``: what a null or zero duration becomes; none
    leaves it. ``title``: characters of the title that are kept. ``more``: further columns."""

    long_enough: Callable[[Column], Column]
    reject: tuple[list[str], ...] = ()
    boost: tuple[list[str], ...] = ()
    high: int = 5
    low: int = 5
    unknown: float | None = 0.0
    title: int | None = None
    more: dict[str, Callable[[], Column]] = field(default_factory=dict)

    def priority(self) -> Column:
        if not self.boost:
            return F.lit(self.low)
        return F.when(R.matches(F.col("title"), P.words(*self.boost)), self.high).otherwise(self.low)


PROFILES = {
    "related": Profile(R.known_long, (P.SHORT_REJECT, P.PLAY, P.GTA_V), (P.BOOST, P.FOREIGN_BOOST, P.FRENCH_BOOST), 8, 5, unknown=None),
    "channel": Profile(R.null_or_long, (P.SHORT_REJECT, P.ANY_PLAY, P.GTA_V), (P.BOOST, P.FOREIGN_BOOST, P.FRENCH_BOOST), 8, 5),
    "cc": Profile(R.known_long, (P.SHORT_REJECT, P.ANY_PLAY, P.GTA_V, P.RELIGIOUS), (P.BOOST,), 9, 7),
    "safe": Profile(
        R.known_long, (P.SHORT_REJECT, P.ANY_PLAY, P.GTA_V, P.RELIGIOUS, P.CONSPIRACY), (P.BOOST, P.BRAND_BOOST, P.FOREIGN_BOOST, P.FRENCH_BOOST), 8, 5,
        more={"license_risk": lambda: from_channel("green", "yellow")},
    ),
    "boot10m": Profile(R.known_long, (P.SHORT_REJECT, P.PLAY, P.WIDE_REJECT), (P.BOOST, P.BRAND_BOOST, P.GRADUATE_BOOST, P.FOREIGN_BOOST), 8, 5, unknown=None),
    "boot1m": Profile(in_range),
    "aggressive": Profile(in_range),
    "mega": Profile(sure_long, title=500, more={"priority": lambda: from_channel(8, 7), "course": lambda: from_channel("channel", "search")}),
}


def admitted(entries: DataFrame, name: str) -> DataFrame:
    """``video_id, arrival, title, duration, priority, origin`` and what the profile adds: the first arrival
    of each video among the entries (``video_id, arrival, title, duration, channel_id``) it lets in.

    A null title passes every title filter, is never boosted and becomes empty. Null ids have no row.
    """
    profile = PROFILES[name]
    kept = entries.where(profile.long_enough(F.col("duration")))
    if profile.reject:
        kept = kept.where(~R.matches(F.col("title"), P.words(*profile.reject)))
    title = F.coalesce("title", F.lit(""))
    duration = F.col("duration") if profile.unknown is None else F.coalesce("duration", F.lit(profile.unknown))
    columns = {
        "title": title if profile.title is None else F.substring(title, 1, profile.title),
        "duration": duration,
        "priority": profile.priority(),
        "origin": F.concat(F.lit(f"{name}:"), F.col("video_id")),
    } | {c: make() for c, make in profile.more.items()}
    return first_by_key(kept.select("video_id", "arrival", *(c.alias(n) for n, c in columns.items())), "video_id", "arrival")
