"""The pipeline's queries: name -> function of (session, data directory). Every query reads whole
tables; a limit stands only where a top-k or a sample is the feature."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions import rules as R
from ..operators import admission, frontier, merging, ranking, summaries, transitions
from ..sources import exports, feeds
from ..streaming.arrivals import events_by_day
from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SEED = "42"
#: Rows a shard: small here so that the test data fill several.
SHARD_ROWS = 500

QUOTA = {"green": 6, "first_short": 3, "first_long": 1, "other_short": 3, "other_long": 1}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def one_video(spark: SparkSession, sf: str) -> DataFrame:
    """Videos with each ``video_id`` once: the row of the smallest id. Texts are left out."""
    return merging.first_by_key(table(spark, sf, "videos").select("id", "video_id", "status", "duration_seconds", "priority"), "video_id", "id")


# Scans, projections and scalar functions


@query
def scan_project(spark, sf):
    return table(spark, sf, "videos").where("status = 'completed'").select("id", "video_id", "title", "university", "duration_seconds")


@query
def schema_evolve(spark, sf):
    wide = feeds.with_missing(table(spark, sf, "videos"), {"lang": "string", "region_code": "string", "view_count": "bigint"})
    return wide.select("id", "video_id", "lang", "region_code", "view_count")


@query
def url_build(spark, sf):
    return table(spark, sf, "videos").select("id", R.watch_url(F.col("video_id")).alias("watch_url"))


@query
def truncate_text(spark, sf):
    """The lengths to which texts are cut: names 30, titles 60, 200 and 500, errors 500, descriptions 5000."""
    cut = lambda c, n: F.substring(c, 1, n)
    return table(spark, sf, "videos").select(
        "id", cut("university", 30).alias("name_30"), cut("title", 60).alias("title_60"), cut("title", 200).alias("title_200"), cut("transcript", 500).alias("text_500"),
        cut("error", 500).alias("error_500"), F.md5(cut("description", 5000)).alias("description_5000"),
    )


@query
def title_clean(spark, sf):
    return table(spark, sf, "videos").select("id", R.clean_title(F.col("title")).alias("short_title"))


@query
def url_label(spark, sf):
    """Labels from addresses: the last part, the one before it, a channel's address without ``/videos``, and
    the start of what follows ``v=`` or ``list=``."""
    url = F.col("url")
    listed = F.concat(url, F.lit("&list=PL"), F.md5("video_id"))
    return table(spark, sf, "videos").select(
        "id", R.last_part(url, "/").alias("tail"), R.before_last_part(F.concat(url, F.lit("/videos")), "/").alias("parent"),
        R.last_part(F.replace(F.concat(url, F.lit("/videos")), F.lit("/videos"), F.lit("")), "/").alias("channel"),
        F.substring(R.last_part(url, "v="), 1, 20).alias("label"), F.substring(R.last_part(listed, "list="), 1, 20).alias("playlist"),
    )


@query
def speed_ratio(spark, sf):
    return table(spark, sf, "videos").select("id", F.round(R.speed(F.col("duration_seconds"), F.col("processing_time_seconds")), 4).alias("speed"))


@query
def segments_join(spark, sf):
    lines = F.split("transcript", "\n")
    rows = table(spark, sf, "videos").where("transcript is not null")
    return rows.select("id", F.size(lines).cast("bigint").alias("n_segments"), F.md5(F.trim(F.array_join(lines, " "))).alias("text_md5"))


@query
def outcome_classify(spark, sf):
    out = R.outcome(F.col("error"), F.col("duration_seconds"), F.col("transcript"))
    return table(spark, sf, "videos").where("status in ('completed', 'error')").select("id", out.alias("outcome"))


@query
def priority_tier(spark, sf):
    return table(spark, sf, "videos").select("id", R.tier(F.col("title")).alias("tier"))


@query
def content_category(spark, sf):
    return table(spark, sf, "videos").select("id", R.category(F.col("title"), F.col("university"), F.col("priority")).alias("category"))


@query
def license_classify(spark, sf):
    text, licence = F.col("description"), F.col("youtube_license")
    return table(spark, sf, "videos").select("id", R.free_licence(text, licence).alias("risk"), R.licence_note(text, licence).alias("note"))


# Filters


@query
def quality_filter(spark, sf):
    return table(spark, sf, "videos").where(R.is_teaching(F.col("title"), F.col("duration_seconds"))).select("id", "video_id")


@query
def text_segments(spark, sf):
    lines = feeds.segments(table(spark, sf, "videos"), "id", "transcript")
    return lines.select("id", "position", F.length("segment").alias("n_chars"))


@query
def duration_floor(spark, sf):
    return table(spark, sf, "videos").where(R.known_long(F.col("duration_seconds"))).select("id", "duration_seconds")


@query
def duration_strict(spark, sf):
    return table(spark, sf, "videos").where("duration_seconds > 900").select("id", "duration_seconds")


@query
def duration_range(spark, sf):
    return table(spark, sf, "videos").where("duration_seconds > 120 and duration_seconds < 36000").select("id", "duration_seconds")


@query
def status_filter(spark, sf):
    return table(spark, sf, "videos").where(F.col("status").isin("pending", "processing")).select("id", "status")


@query
def needs_license(spark, sf):
    return table(spark, sf, "videos").where("youtube_license is null or youtube_license = ''").select("id", "video_id")


@query
def needs_description(spark, sf):
    rows = table(spark, sf, "videos").where("description is null or description = ''")
    return rows.orderBy(F.when(F.col("status") == "completed", 0).otherwise(1), *R.shuffled(F.col("id"), SEED)).limit(100).select("id", "status")


@query
def known_channels(spark, sf):
    """Sources that are an address or a handle; of a video without a source, its own address."""
    source = R.falsy_default(F.col("university"), F.col("url"))
    return table(spark, sf, "videos").select(source.alias("source")).where("source ilike 'http%' or source ilike '@%'").distinct()


@query
def green_sources(spark, sf):
    rows = table(spark, sf, "videos").where("license_risk = 'green' and university <> '' and not university ilike '%crawl%' and not university ilike '%search%'")
    return rows.select("university").distinct().orderBy("university").limit(500)


@query
def id_validate(spark, sf):
    return feeds.valid_entries(table(spark, sf, "raw_entries")).select("arrival", "video_id")


@query
def related_pairs(spark, sf):
    return frontier.clean_edges(table(spark, sf, "channel_discoveries"))


# Semi-structured input


@query
def ndjson_parse(spark, sf):
    return feeds.entries(table(spark, sf, "raw_entries")).select("arrival", "id", "title", "duration")


@query
def entries_explode(spark, sf):
    return feeds.response_items(table(spark, sf, "license_responses")).select("request_id", "video_id", "licence")


@query
def license_scan(spark, sf):
    return feeds.scanned_licences(table(spark, sf, "license_responses"))


@query
def watch_links(spark, sf):
    return feeds.links(table(spark, sf, "raw_entries"), ["arrival"], "line", r"watch\?v=([A-Za-z0-9_-]{11})")


def pages(spark, sf) -> DataFrame:
    """Pages with links to playlists, and playlists of their own, made from ids, as the tables have none."""
    mark = F.substring(F.md5("video_id"), 1, 8)
    linked = F.concat(F.lit("see https://videos.example/playlist?list=PL"), mark, F.lit(" and watch?v=x&list=PL_"), (F.col("id") % 5).cast("string"), F.lit("-a"))
    text = F.when(F.col("id") % 3 == 0, linked).when(F.col("id") % 3 == 2, "no links, list=UUabc")
    own = F.when(F.col("id") % 4 == 0, F.concat(F.lit("PL"), mark)).when(F.col("id") % 4 == 1, F.concat(F.lit("UU"), mark))
    return table(spark, sf, "videos").select("id", text.alias("text"), own.alias("playlist_id"))


@query
def playlist_extract(spark, sf):
    return feeds.playlists(pages(spark, sf), ["id"], "text", "playlist_id")


@query
def playlist_videos(spark, sf):
    """The videos of each channel's own list of uploads, at most 500 a list in order of arrival."""
    got = feeds.valid_entries(table(spark, sf, "raw_entries")).where("channel_id like 'UC%'").select("channel_id", "video_id", "arrival")
    listed = table(spark, sf, "channels").select("channel_id", F.concat(F.lit("UU"), F.substring("channel_id", 3, 100)).alias("playlist_id"))
    once = merging.first_by_key(listed.join(got, "channel_id").select("playlist_id", "video_id", "arrival"), ["playlist_id", "video_id"], "arrival")
    return ranking.first_per_group(once, ["playlist_id"], [F.col("arrival")], 500)


# Admission of new entries


def _admitted(spark, sf, profile: str) -> DataFrame:
    return admission.admitted(feeds.valid_entries(table(spark, sf, "raw_entries")), profile)


@query
def admit_related(spark, sf):
    return _admitted(spark, sf, "related")


@query
def admit_channel(spark, sf):
    return _admitted(spark, sf, "channel")


@query
def admit_cc(spark, sf):
    return _admitted(spark, sf, "cc")


@query
def admit_safe(spark, sf):
    return _admitted(spark, sf, "safe")


@query
def admit_boot10m(spark, sf):
    return _admitted(spark, sf, "boot10m")


@query
def admit_boot1m(spark, sf):
    return _admitted(spark, sf, "boot1m")


@query
def admit_aggressive(spark, sf):
    return _admitted(spark, sf, "aggressive")


@query
def admit_mega(spark, sf):
    return _admitted(spark, sf, "mega")


@query
def legacy_import(spark, sf):
    got = feeds.valid_entries(table(spark, sf, "raw_entries")).where("not coalesce(duration <> 0 and duration < 120, false)")
    length = F.when(F.col("duration").isNull() | (F.col("duration") == 0), 900.0).otherwise(F.col("duration"))
    rows = got.select("video_id", "arrival", F.substring(F.coalesce("title", F.lit("Unknown")), 1, 200).alias("title"), length.alias("duration"))
    tier = F.when(F.col("duration") > 3600, 3).when(F.col("duration") > 1800, 4).otherwise(5)
    return merging.first_by_key(rows, "video_id", "arrival").withColumn("priority", tier)


def done_videos(spark, sf) -> DataFrame:
    """A queue that holds the completed videos only, so that entries are new to it."""
    return table(spark, sf, "videos").where("status = 'completed'").select("video_id")


@query
def insert_new(spark, sf):
    got = feeds.valid_entries(table(spark, sf, "raw_entries")).select("video_id", "arrival", "title", "duration")
    return merging.insert_absent(got, done_videos(spark, sf), "video_id", "arrival")


@query
def edges_insert(spark, sf):
    """Links found from a given time on that are not among the earlier ones, each pair once."""
    found = table(spark, sf, "channel_discoveries").select("id", "from_channel", "to_channel", "discovered_at")
    early = F.col("discovered_at") < F.lit("2026-01-05 01:00:00").cast("timestamp_ntz")
    return merging.insert_absent(found.where(~early).drop("discovered_at"), found.where(early), ["from_channel", "to_channel"], "id")


@query
def channel_extract(spark, sf):
    """Channels of entries that are not among those crawled already."""
    got = feeds.entries(table(spark, sf, "raw_entries")).where("channel_id like 'UC%'").select("channel_id").distinct()
    return got.join(table(spark, sf, "channels").where("status = 'crawled'").select("channel_id"), "channel_id", "left_anti")


@query
def channel_verdict(spark, sf):
    """Channels whose name is not refused and whose first 50 entries are often teaching or long are crawled, others
    rejected; a channel without entries is not rejected for it. ``n_videos``: its entries; ``n_inserted``: the
    videos among them that are admitted and new, if it is crawled."""
    got = feeds.valid_entries(table(spark, sf, "raw_entries")).where("channel_id is not null").select("channel_id", "video_id", "arrival", "title", "duration")
    first = ranking.first_per_group(got, ["channel_id"], [F.col("arrival")], 50)
    teaching = R.matches(F.col("title"), P.words(P.BOOST, P.FOREIGN_BOOST, P.FRENCH_BOOST)).cast("double")
    long = F.coalesce(F.col("duration") >= 900, F.lit(False)).cast("double")
    shares = first.groupBy("channel_id").agg(F.avg(teaching).alias("teaching"), F.avg(long).alias("long"))
    counts = got.groupBy("channel_id").agg(F.count(F.lit(1)).alias("n_videos"))
    admitted = admission.admitted(got, "channel").join(done_videos(spark, sf), "video_id", "left_anti").select("video_id", "arrival")
    inserted = admitted.join(got.select("arrival", "channel_id"), "arrival").groupBy("channel_id").agg(F.count(F.lit(1)).alias("n_inserted"))
    rows = table(spark, sf, "channels").select("channel_id", "channel_name")
    for part in (shares, counts, inserted):
        rows = rows.join(part, "channel_id", "left")
    good = F.col("teaching").isNull() | (F.col("teaching") >= 0.2) | (F.col("long") >= 0.3)
    worth = ~R.matches(F.col("channel_name"), P.words(P.REJECT_CHANNEL)) & good
    return rows.select(
        "channel_id", F.when(worth, "crawled").otherwise("rejected").alias("status"), F.coalesce("n_videos", F.lit(0)).alias("n_videos"),
        F.when(worth, F.coalesce("n_inserted", F.lit(0))).alias("n_inserted"),
    )


# Queue: sampling, claims and transitions


def _claimable(spark, sf) -> DataFrame:
    return table(spark, sf, "videos").where((F.col("status") == "pending") & R.known_long(F.col("duration_seconds")))


def _now() -> Column:
    return F.lit("2026-02-01 00:00:00").cast("timestamp_ntz")


def _sampled(rows: DataFrame) -> DataFrame:
    """``id, bucket`` of a claim: by the quotas, or 15 of any not refused if no bucket has a row."""
    not_red, high = F.col("license_risk") != "red", F.col("priority") >= 8
    short = F.col("duration_seconds") < 3600
    conditions = {
        "green": F.col("license_risk") == "green", "first_short": not_red & high & short, "first_long": not_red & high & ~short,
        "other_short": not_red & ~high & short, "other_long": not_red & ~high & ~short,
    }
    order = R.shuffled(F.col("id"), SEED)
    taken = ranking.sample_buckets(rows, {name: (condition, QUOTA[name]) for name, condition in conditions.items()}, "id", order)
    spare = rows.where("license_risk is null or license_risk <> 'red'").orderBy(*order).limit(15)
    return transitions.or_else(taken, spare.select("id", F.lit("any").alias("bucket")))


@query
def claim_batch(spark, sf):
    return _sampled(_claimable(spark, sf))


@query
def claim_fallback(spark, sf):
    """A claim from videos of unknown risk, for which no bucket has a row."""
    return _sampled(_claimable(spark, sf).where("license_risk is null"))


@query
def claim_rows(spark, sf):
    """The rows a claim changes, with the title that goes to the worker."""
    rows = transitions.claimed(table(spark, sf, "videos"), _sampled(_claimable(spark, sf)), "id", _now())
    return rows.select("id", "video_id", "title", "status", "processing_started_at")


@query
def finish_rows(spark, sf):
    """Results for all videos in processing: failures, recordings too short, blank and whole texts."""
    queue = table(spark, sf, "videos").where("status = 'processing'")
    failure = F.when(F.col("id") % 5 == 0, "download_failed").when(F.col("id") % 5 == 1, F.concat(F.lit("ERROR: "), F.repeat(F.col("video_id"), 60)))
    probed = F.when(F.col("id") % 7 == 0, 2.5).otherwise(F.coalesce("duration_seconds", F.lit(600.0)))
    text = F.when(F.col("id") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" text of "), F.col("video_id"), F.lit(" ")))
    results = queue.select("id", text.alias("text"), probed.alias("probed_seconds"), (F.col("id") % 11).cast("double").alias("seconds"), failure.alias("failure"))
    rows = transitions.finished(queue, results, "id", _now())
    return rows.select(
        "id", "status", "error", F.col("transcript").alias("text"), F.round("duration_seconds", 3).alias("duration_seconds"), "processing_time_seconds",
        F.round("speed_ratio", 3).alias("speed_ratio"), "completed_at",
    )


@query
def describe_rows(spark, sf):
    """A fetch of descriptions for every video whose licence was asked for; those unavailable failed."""
    last = feeds.scanned_licences(table(spark, sf, "license_responses")).groupBy("video_id").agg(F.max_by("licence", "request_id").alias("licence"))
    text = F.when(F.ascii("video_id") % 4 == 0, "Notes. Licensed under a creative commons licence.").otherwise(F.repeat(F.col("video_id"), 600))
    fetched = last.select("video_id", text.alias("text"), "licence", (F.col("licence") != "unavailable").alias("ok"))
    rows = transitions.described(table(spark, sf, "videos"), fetched, "video_id")
    return rows.select("id", F.length("description").alias("n_chars"), F.md5("description").alias("description_md5"), "youtube_license", "license_risk")


@query
def stale_reset(spark, sf):
    return merging.release_stale(table(spark, sf, "videos"), F.lit("2026-01-06 12:00:00").cast("timestamp_ntz"), 30).select("id", "status")


@query
def retro_clean(spark, sf):
    rows = table(spark, sf, "videos").where("status = 'pending'")
    keep = R.is_teaching(F.col("title"), F.col("duration_seconds"))
    return rows.select("id", F.when(keep, "pending").otherwise("rejected").alias("status"), F.when(keep, R.tier(F.col("title"))).otherwise(0).alias("priority"))


@query
def retro_clean_stats(spark, sf):
    rows = table(spark, sf, "videos").where("status = 'pending'")
    keep = R.is_teaching(F.col("title"), F.col("duration_seconds"))
    marked = rows.select("priority", keep.alias("keep"), R.tier(F.col("title")).alias("tier"))
    return marked.agg(
        F.count_if(~F.col("keep")).alias("rejected"),
        F.count_if(F.col("keep") & (F.col("tier") > F.col("priority"))).alias("upgraded"),
        F.count_if(F.col("keep") & (F.col("tier") < F.col("priority"))).alias("downgraded"),
    )


@query
def license_merge(spark, sf):
    """The last answer for a video sets its licence; Creative Commons turns a known risk green."""
    scanned = feeds.scanned_licences(table(spark, sf, "license_responses"))
    last = scanned.groupBy("video_id").agg(F.max_by("licence", "request_id").alias("licence"))
    free = (F.col("licence") == "creativeCommon") & (F.col("license_risk") != "green")
    risk = F.when(free, "green").otherwise(F.col("license_risk"))
    merged = merging.merge(table(spark, sf, "videos").select("id", "video_id", "youtube_license", "license_risk"), last, "video_id", {"youtube_license": F.col("licence"), "license_risk": risk})
    return merged.select("id", "video_id", "youtube_license", "license_risk")


@query
def license_batches(spark, sf):
    rows = table(spark, sf, "videos").where("youtube_license is null or youtube_license = ''").select("id", "video_id")
    return ranking.sharded(rows, [F.col("id")], 50).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query
def seed_sample(spark, sf):
    videos = one_video(spark, sf)
    order = R.shuffled(F.col("id"), SEED)
    done = videos.where("status = 'completed' and duration_seconds > 1800").orderBy(*order).limit(50)
    waiting = videos.where("status = 'pending' and priority >= 8").orderBy(*order).limit(50)
    return done.unionByName(waiting).select("id", "video_id", "status")


@query
def cc_seeds(spark, sf):
    rows = table(spark, sf, "videos").where("license_risk = 'green' and status in ('completed', 'pending')")
    return rows.orderBy(F.when(F.col("status") == "completed", 0).otherwise(1), *R.shuffled(F.col("id"), SEED)).limit(100).select("id", "status")


@query
def seed_titles(spark, sf):
    seeds = table(spark, sf, "channel_discoveries").where("to_channel is not null").select(F.col("to_channel").alias("channel_id")).distinct()
    return seeds.join(table(spark, sf, "channels").select("channel_id", "channel_name"), "channel_id")


@query
def topn_per_group(spark, sf):
    rows = table(spark, sf, "videos").where("university is not null and duration_seconds is not null")
    return ranking.first_per_group(rows, ["university"], [F.col("duration_seconds").desc(), F.col("id")], 3).select("university", "id", "duration_seconds")


@query
def query_gen(spark, sf):
    subjects = table(spark, sf, "subjects").select("subject_code")
    languages = table(spark, sf, "languages").select("english_name")
    forms = spark.createDataFrame([("full course {}",), ("{} lecture",), ("{} seminar for beginners",)], "form string")
    asked = subjects.crossJoin(F.broadcast(forms)).crossJoin(F.broadcast(languages))
    return asked.select(F.concat(F.replace("form", F.lit("{}"), F.col("subject_code")), F.lit(" in "), F.col("english_name")).alias("question"))


@query
def query_shuffle(spark, sf):
    """The questions in an order that a seed determines, ``place`` from 1; the first 30 are a sample."""
    return ranking.global_rank(query_gen(spark, sf), R.shuffled(F.col("question"), SEED), "place").where("place <= 30")


# Frontier


@query
def frontier_unexplored(spark, sf):
    explored = table(spark, sf, "channel_discoveries").select(F.col("from_channel").alias("channel_id")).where("channel_id is not null").distinct()
    return table(spark, sf, "channels").select("channel_id", "status").join(explored, "channel_id", "left_anti")


@query
def snowball_round(spark, sf):
    """Channels linked from those crawled that are not crawled themselves."""
    crawled = table(spark, sf, "channels").where("status = 'crawled'").select(F.col("channel_id").alias("node"))
    return frontier.one_round(frontier.clean_edges(table(spark, sf, "channel_discoveries")), crawled, crawled)


@query
def snowball_reach(spark, sf):
    start = table(spark, sf, "channels").where("source = 'search'").select(F.col("channel_id").alias("node"))
    return frontier.reach(frontier.clean_edges(table(spark, sf, "channel_discoveries")), start)


# Aggregates


@query
def queue_counts(spark, sf):
    return table(spark, sf, "videos").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("status") == "pending").alias("n_pending"),
        F.count_if(F.col("license_risk") == "green").alias("n_green"), F.count_distinct("video_id").alias("n_videos"),
    )


@query
def dist_status(spark, sf):
    return summaries.distribution(table(spark, sf, "videos"), "status")


@query
def dist_priority(spark, sf):
    return summaries.distribution(table(spark, sf, "videos").where("status = 'pending'"), "priority")


@query
def dist_category(spark, sf):
    return summaries.distribution(table(spark, sf, "videos").withColumn("content_category", F.nullif("content_category", F.lit(""))), "content_category")


@query
def dist_license_risk(spark, sf):
    labelled = summaries.distribution(table(spark, sf, "videos"), "license_risk")
    label = F.create_map(*(F.lit(x) for pair in {"green": "free", "yellow": "standard", "orange": "unclear", "red": "refused"}.items() for x in pair))
    return labelled.withColumn("label", F.coalesce(label[F.col("license_risk")], F.lit("unknown")))


@query
def green_by_license(spark, sf):
    rows = table(spark, sf, "videos").where("license_risk = 'green'")
    return rows.groupBy("youtube_license").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_first("youtube_license")).limit(20)


@query
def cc_channels(spark, sf):
    rows = table(spark, sf, "videos").where("youtube_license in ('creativeCommon', 'youtube') and university <> '' and not university ilike '%crawl%' and not university ilike '%search%'")
    counted = summaries.share_above(rows, "university", F.col("youtube_license") == "creativeCommon", "n", "n_free")
    kept = counted.where("n >= 5 and cast(n_free as double) / n > 0.2")
    return kept.orderBy(F.desc("n_free"), "university").limit(100)


@query
def monitor_stats(spark, sf):
    """Counts, hours, tokens by two estimates (characters and hours), and the rate of completion."""
    done = F.col("status") == "completed"
    speed = F.when(F.col("speed_ratio") > 0, F.col("speed_ratio"))
    held = table(spark, sf, "videos").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(done).alias("n_done"), F.coalesce(F.sum(F.when(done, F.col("duration_seconds"))), F.lit(0.0)).alias("s"),
        F.round(F.coalesce(F.avg(speed), F.lit(0.0)), 4).alias("mean_speed"), F.coalesce(F.sum(F.length("transcript")), F.lit(0)).alias("n_chars"),
        F.expr("timestampdiff(second, min(processing_started_at), max(completed_at))").alias("elapsed_seconds"),
    )
    return held.select(
        "n_done", F.round(F.col("s") / 3600, 3).alias("hours"), "mean_speed", "n_chars", F.floor(F.col("n_chars") / 4).alias("tokens_by_chars"),
        F.round(F.col("s") / 3600 * 12_000, 1).alias("tokens_by_hours"), "elapsed_seconds",
        F.round(F.col("n_done") * 3600.0 / F.greatest("elapsed_seconds", F.lit(1)), 4).alias("done_per_hour"), F.round(F.col("n_done") * 100.0 / F.greatest("n", F.lit(1)), 4).alias("percent_done"),
    )


@query
def recent_speed(spark, sf):
    last = table(spark, sf, "videos").where("status = 'completed' and speed_ratio > 0").orderBy(F.desc_nulls_last("completed_at"), F.desc("id")).limit(20)
    return last.agg(F.round(F.avg("speed_ratio"), 4).alias("recent_speed"))


@query
def progress_milestone(spark, sf):
    """Hours that wait, in per cent of a million, their milestone, and whether ten million rows are reached."""
    waiting = F.col("status") == "pending"
    seconds = F.coalesce(F.sum(F.when(waiting, F.col("duration_seconds"))), F.lit(0.0))
    counted = table(spark, sf, "videos").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(waiting).alias("n"), (seconds / 3600).alias("h"))
    milestone = F.when(F.col("h") >= 1_000_000, "1M").when(F.col("h") >= 500_000, "500K").when(F.col("h") >= 100_000, "100K").otherwise("start")
    return counted.select("n", F.round("h", 3).alias("hours"), F.round(F.col("h") / 10_000, 6).alias("percent"), milestone.alias("milestone"), (F.col("n_rows") >= 10_000_000).alias("stop"))


@query
def worker_running(spark, sf):
    return summaries.running(table(spark, sf, "events"), "user_id", ["ts", "event_id"], "value").where("seen <= 3 or seen % 5 = 0").select(
        "event_id", "user_id", "seen", F.round("running_total", 2).alias("running_total"), F.round(F.round("running_total", 2) / F.col("seen"), 6).alias("running_mean")
    )


@query
def source_rollup(spark, sf):
    rows = table(spark, sf, "videos").rollup("license_risk", "status")
    return rows.agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n"), F.round(F.sum("duration_seconds"), 1).alias("seconds"))


@query
def licensing_targets(spark, sf):
    rows = table(spark, sf, "videos").where("university is not null and university <> ''").groupBy("university").agg(F.count(F.lit(1)).alias("n"))
    return rows.where("n > 20").orderBy(F.desc("n"), "university").limit(50).withColumn("band", F.when(F.col("n") > 100, "high").otherwise("middle"))


# Exports


@query
def export_transcripts(spark, sf):
    rows, names = exports.transcript_records(table(spark, sf, "videos"))
    return rows.select(F.col("__id").alias("id"), *names)


@query
def export_shards(spark, sf):
    rows = table(spark, sf, "videos").where("status = 'completed' and transcript is not null").select("id", "priority", "completed_at")
    order = [F.desc_nulls_last("priority"), F.asc_nulls_first("completed_at"), F.col("id")]
    return ranking.sharded(rows, order, SHARD_ROWS).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))


@query
def export_queue(spark, sf):
    rows, names = exports.queue_records(table(spark, sf, "videos"))
    return rows.select(F.col("__id").alias("id"), *names)


@query
def export_card_stats(spark, sf):
    rows = table(spark, sf, "videos").where("status = 'completed' and transcript is not null")
    held = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("transcript")), F.lit(0)).alias("n_chars"), F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("s"))
    return held.select("n", "n_chars", F.floor(F.col("n_chars") / 4).alias("n_tokens"), F.floor(F.col("s") / 3600).alias("hours"), R.size_bucket(F.col("n")).alias("size_bucket"))


QUERIES["late_counts"] = events_by_day
