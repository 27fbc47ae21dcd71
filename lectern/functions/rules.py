"""Column functions of the pipeline: they take and return columns, and hold no state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P

#: Shortest lecture in seconds; a missing or zero duration is unknown and passes where stated.
MIN_SECONDS = 900


def falsy_default(*columns: Column) -> Column:
    """The first column that is neither null nor empty, or the last one."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns[:-1]), columns[-1])


def known_long(duration: Column, least: int = MIN_SECONDS) -> Column:
    """At least ``least`` seconds, or unknown (null or 0)."""
    return (duration >= least) | duration.isNull() | (duration == 0)


def null_or_long(duration: Column, least: int = MIN_SECONDS) -> Column:
    """At least ``least`` seconds, or null; 0 fails."""
    return (duration >= least) | duration.isNull()


def matches(text: Column, pattern: str) -> Column:
    """Whether the pattern is found; null text has no match."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def is_teaching(title: Column, duration: Column) -> Column:
    """Long enough or of unknown length, with a title that no reject pattern matches."""
    return known_long(duration) & title.isNotNull() & (title != "") & ~matches(title, P.matcher(P.REJECT))


def tier(title: Column) -> Column:
    """The first tier that matches: 9, 8, 7, or 5."""
    return (
        F.when(matches(title, P.matcher(P.TIER_9)), 9)
        .when(matches(title, P.matcher(P.TIER_8)), 8)
        .when(matches(title, P.matcher(P.TIER_7)), 7)
        .otherwise(5)
    )


def clean_title(title: Column) -> Column:
    """The title up to the first dash, bar or colon, at most 60 characters; of a short rest the first 60 of the whole."""
    head = F.substring(F.trim(F.regexp_replace(title, r"[|\-–—:]+.*$", "")), 1, 60)
    return F.when(F.length(head) < 10, F.substring(title, 1, 60)).otherwise(head)


def watch_url(video: Column) -> Column:
    return F.concat(F.lit("https://videos.example/watch?v="), video)


def last_part(text: Column, mark: str) -> Column:
    """What follows the last ``mark``."""
    return F.element_at(F.split(text, mark), -1)


def free_licence(description: Column, licence: Column) -> Column:
    """'green' if the licence or the wording of the description says so, else null."""
    says = F.coalesce(F.lower(licence).contains("creative"), F.lit(False))
    return F.when(says | matches(description, P.matcher(P.FREE_LICENCE)), "green")


def licence_note(description: Column, licence: Column) -> Column:
    says = F.coalesce(F.lower(licence).contains("creative"), F.lit(False))
    return F.when(says, "creativeCommon").when(matches(description, P.matcher(P.FREE_LICENCE)), "cc_in_description").otherwise(falsy_default(licence, F.lit("youtube")))


def speed(duration: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, duration / seconds).otherwise(0.0)


def outcome(error: Column, duration: Column, transcript: Column) -> Column:
    """completed, or why not."""
    return (
        F.when(F.coalesce(error == "download_failed", F.lit(False)), "download_failed")
        .when(duration < 5, F.format_string("too_short_%ds", F.floor(duration).cast("int")))
        .when(F.coalesce(F.length(F.trim(transcript)) > 0, F.lit(False)), "completed")
        .otherwise("empty_transcript")
    )


def size_bucket(rows: Column) -> Column:
    return F.when(rows < 1000, "n<1K").when(rows < 10_000, "1K<n<10K").when(rows < 100_000, "10K<n<100K").when(rows < 1_000_000, "100K<n<1M").otherwise("n>1M")


def shuffled(key: Column, seed: str) -> list[Column]:
    """An order that looks random, is the same at every run, and has no ties on a unique key."""
    return [F.md5(F.concat(key.cast("string"), F.lit(f":{seed}"))), key]


def before_last_part(text: Column, mark: str) -> Column:
    """What stands between the last two ``mark``; null if there is no such part."""
    parts = F.split(text, mark)
    return F.when(F.size(parts) > 1, F.try_element_at(parts, F.lit(-2)))


def category(title: Column, source: Column, priority: Column) -> Column:
    """One of 16 categories, by the source, then by the title, then by the priority; null if nothing is
    known of the video. The categories are the published ones; the rules are our own."""
    by_source, by_title = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, source_words, title_words in reversed(P.CATEGORIES):
        if source_words:
            by_source = F.when(matches(source, "(?iU)" + source_words), name).otherwise(by_source)
        if title_words:
            by_title = F.when(matches(title, "(?iU)" + title_words), name).otherwise(by_title)
    nothing = (F.coalesce(source, F.lit("")) == "") & (F.coalesce(title, F.lit("")) == "") & priority.isNull()
    fallback = F.when(priority >= 8, "university_lecture").when(~nothing, "unknown")
    return F.coalesce(by_source, by_title, fallback)
