import pytest
from pyspark.sql import functions as F

from lectern.functions import rules as R

# What the full filter refuses, family by family, and beside each a title that comes near and passes.
REFUSED = {
    "drama": ["总裁的秘密 第3集", "She was forced to wed a stranger", "Reborn as the unloved princess", "Harbour lights [Full Movie] 1962"],
    "music": ["Blue river (official audio)", "Two hours of relaxing music", "Rain sounds and white noise", "Chill evening vibes mix"],
    "whispering": ["Soft spoken map reading", "Whispered roleplay at the library"],
    "games": ["Let's play chess boxing", "Speedrun of the old castle", "Minecraft castle in one day", "Twitch clip of the week", "Esport final in Lyon"],
    "daily life": ["My gym routine in winter", "A vlog from Porto", "Apartment tour in Kyoto", "Unboxing my new lamp", "What I eat before a race"],
    "pranks": ["Elevator prank on my boss", "48 hour challenge in a tent", "Dogs reacting to a magic video", "Social experiment in the park"],
    "gossip": ["Celebrity couple and their scandal", "The mayor was exposed", "The tour was cancelled"],
    "worship": ["Sunday sermon from our church: no, church sermon on sunday", "Evening prayer live from the chapel"],
    "sports": ["UFC 300 main card", "Goals & highlights of May", "Full fight from 1974"],
    "cooking": ["Grandmother's soup recipe", "Mukbang with crab", "Everything I cooked and what I ate"],
    "conspiracy": ["Flat earth: what they hide", "Chemtrail over our town", "The Illuminati are here"],
    "kids": ["Nursery rhyme of the little duck", "Kids cartoon about trains"],
    "low quality": ["Oddly satisfying sand", "Epic fail at the pool", "Top 10 worst bridges", "Compilation of falling trees", "You won't believe this door"],
}
NEAR = [
    "Minecraft and redstone as a computer", "Gaming and its theory", "Unboxing a lab balance", "A prank seen by psychology", "Reaction rate of an enzyme", "Social experiment: psychology of queues",
    "Exposed API keys", "Cancelled flight models", "Full match with analysis", "NBA statistics", "A recipe for success", "Flat earth, a debunk", "The Illuminati in history", "Compilation of a compiler", "Musical form",
]
# Titles of the four tiers. Acronyms count in any case, and a look-ahead sees only what follows.
TIERS = {
    9: ["EE 261 signals", "18.06 matrices", "Lec 12 on waves", "Week 3: sampling", "NPTEL heat transfer", "Harvard STAT 110", "Whole syllabus of optics", "Problem set on fields", "ICML best paper", "a micro oven", "Spotlight talk on graphs", "Курс и лекция 7", "ВШЭ: право", "Vorlesung 4", "Kurs der Universität Kiel", "wykład z fizyki", "Jul 8.50 report", "公开课 2"],
    8: ["Pottery course", "Golf and a course", "A class of its own, first class", "Seminar on glaciers", "Prof. Ada speaks", "Intro to knots", "Lesson 4", "Crash Course botany", "Colloquium on dust", "TEDx Gdansk", "Machine  learning", "Quantum field notes", "Linear algebra by hand", "Bayesian thinking"],
    7: ["Tides explained", "A deep dive into moss", "How locks really work", "Why sleep matters", "History of salt", "Documentary on canals", "Webinar for bakers", "Breakdown of a poem"],
    5: ["A walk by the sea", "Course of golf", "Workshop for wood", "TEDdy bears", "Nervous about a breakdown: mental", "講義録", "Notes", "Euler at the fifa gala"],
}


def judged(spark, titles):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, title string")
    rows = df.select("i", R.is_teaching(F.col("title"), F.lit(1800.0)).alias("keep"), R.tier(F.col("title")).alias("tier")).collect()
    return {titles[r["i"]]: (r["keep"], r["tier"]) for r in rows}


def test_refused_titles(spark):
    got = judged(spark, [t for family in REFUSED.values() for t in family] + NEAR + [None, ""])
    assert [t for family in REFUSED.values() for t in family if got[t][0]] == []
    assert [t for t in NEAR if not got[t][0]] == []
    assert not got[None][0] and not got[""][0]


@pytest.mark.parametrize("tier", TIERS)
def test_tiers(spark, tier):
    assert {t: got[1] for t, got in judged(spark, TIERS[tier]).items() if got[1] != tier} == {}


@pytest.mark.parametrize("seconds,known,null", [(None, True, True), (0.0, True, False), (899.0, False, False), (900.0, True, True), (-5.0, False, False)])
def test_durations(spark, seconds, known, null):
    df = spark.createDataFrame([(seconds,)], "d double")
    assert df.select(R.known_long(F.col("d")).alias("a"), R.null_or_long(F.col("d")).alias("b")).first() == (known, null)


def test_small_functions(spark):
    df = spark.createDataFrame([("Intro | part", "", None, 10.0, 0.0)], "t string, a string, b string, d double, s double")
    row = df.select(
        R.clean_title(F.lit("A long enough title - and a rest")), R.clean_title(F.lit("Ab: the rest")), R.falsy_default(F.col("a"), F.col("b"), F.lit("z")),
        R.speed(F.col("d"), F.col("s")), R.last_part(F.lit("a/b/c"), "/"), R.free_licence(F.lit("This work is licensed under X"), F.lit(None).cast("string")),
    ).first()
    assert tuple(row) == ("A long enough title", "Ab: the rest", "z", 0.0, "c", "green")
