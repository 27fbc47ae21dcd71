"""Subjects, reading levels and spam: held-out accuracy, and defined results for odd input."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lectern.llm import queries, reading, samples, spam, subjects
from lectern.llm.language import fit_languages
from lectern.llm.words import WordTable
from lectern.session import table


@pytest.fixture(scope="module")
def large(data):
    return data.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def languages(spark, large):
    return fit_languages(drawn(spark, large, table(spark, large, "review_labels")), table(spark, large, "languages"))


def drawn(spark, large, reviews):
    return samples.draw(table(spark, large, "videos"), reviews, {"main_language": 6000, "subject": 6000, "reading_level": 10_000})


def halves(spark, large, aspect):
    reviews = table(spark, large, "review_labels").where(F.col("aspect") == aspect)
    first = F.pmod(F.xxhash64("video_id"), F.lit(4)) > 0
    return reviews.where(first), reviews.where(~first).select("video_id", "label_value").distinct().toPandas()


def test_subjects_held_out(spark, large, languages):
    seen, held = halves(spark, large, "subject")
    videos = table(spark, large, "videos")
    model = subjects.fit_reviewed(drawn(spark, large, seen), table(spark, large, "subjects"), languages)
    got = set(map(tuple, subjects.video_subjects(videos, model).select("video_id", "subject_code").collect()))
    want = set(map(tuple, held.to_numpy()))
    ids = set(held["video_id"])
    got = {p for p in got if p[0] in ids}
    # a model of some sixty reviews over six languages misses words it never saw
    assert len(got & want) / max(1, len(got)) > 0.6


def test_factor_keeps_its_seeds():
    # two anchored topics and a background over six terms
    doc = np.repeat(np.arange(20), 6)
    word = np.tile(np.arange(6), 20)
    topic = np.repeat([0, 1], 10)
    count = np.where(word >= 4, 5.0, np.where((word // 2) == topic[doc], 3.0, 0.01))
    membership = np.column_stack([topic == 0, topic == 1, np.ones(20)]).astype(float) + 0.01
    held = subjects.factor(doc, word, count, membership, np.ones((2, 6), bool))
    assert held[0, :2].sum() > 10 * held[0, 2:4].sum() and held[1, 2:4].sum() > 10 * held[1, :2].sum()
    assert held[2, 4:].sum() > 0.9 * held[2].sum()
    assert not held[0, 4:].any() and not held[1, 4:].any()  # zero where it starts at zero
    assert subjects.factor(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.ones((2, 3)), np.ones((2, 6), bool)).sum() == 0


def test_fold_in_shares_a_sentence_out(languages):
    lang = len(languages.codes)
    weights = np.zeros((3 * lang, 3), np.float32)
    weights[0:lang] = [0.9, 0, 0.01]  # a term of the first subject
    weights[lang : 2 * lang] = [0.1, 1, 0.01]  # of the second, and now and then of the first
    weights[2 * lang :] = [0, 0, 0.98]
    model = subjects.SubjectModel(["x", "y"], languages, {"a": 0, "b": 1, "c": 2}, weights)
    unit, number = np.array([0, 0, 0, 1, 1, 2, 2]), np.array([0, 2, 2, 0, 1, 2, -1])
    mass = model.fold_in(unit, number, np.zeros(7, int), 4)
    assert mass[0, 0] > 0.9 and mass[0, 1] == 0 and mass[1].min() > 0.7 and not mass[2:].any()
    # what a word is about depends on the others: alone with the first term, the second leans to it
    alone = model.fold_in(np.zeros(5, int), np.array([0, 0, 0, 0, 1]), np.zeros(5, int), 1)
    assert alone[0, 0] > 4


def test_subjects_of_odd_input(spark, large, languages):
    videos = table(spark, large, "videos")
    model = subjects.fit_reviewed(drawn(spark, large, table(spark, large, "review_labels")), table(spark, large, "subjects"), languages)
    rows = [("a", None, None), ("b", "", ""), ("c", "King - Lecture 3 | School of the garden", None), ("c", "King - Lecture 3 | School of the garden", None), ("d", "x", "word " * 200_000), ("e", None, "1 2 3 " * 40), (None, "King", None)]
    df = spark.createDataFrame(rows, "video_id string, title string, transcript string").withColumn("share", F.lit(1))
    got = subjects.video_subjects(df, model).collect()
    assert len({(r["video_id"], r["subject_code"]) for r in got}) == len(got)
    assert {r["video_id"] for r in got} <= {"c", None}
    assert subjects.video_subjects(df.limit(0), model).collect() == []
    none = subjects.fit_subjects([], [], ["law"], languages)
    assert subjects.document_shares(none, WordTable(none.featurize), ["some text here"]).sum() == 0


def test_levels_held_out(spark, large, languages):
    seen, held = halves(spark, large, "reading_level")
    videos = table(spark, large, "videos")
    model = reading.fit_graded(drawn(spark, large, seen), videos, languages)
    got = {r["video_id"]: r["reading_level"] for r in reading.reading_levels(videos, model).collect()}
    assert set(got.values()) <= {1, 2, 3, 4}
    pairs = [(got[v], int(level)) for v, level in held.to_numpy() if v in got]
    assert np.mean([abs(a - b) <= 1 for a, b in pairs]) > 0.8


def test_ordinal_regression_recovers_order():
    draw = np.random.default_rng(5)
    x = draw.normal(size=(800, 3))
    level = np.digitize(2 * x[:, 0] - x[:, 1] + draw.normal(scale=0.3, size=800), [-2, 0, 2]) + 1
    w, edges = reading.ordinal(x, level)
    guess = 1 + ((x @ w)[:, None] > edges).sum(1)
    assert np.mean(guess == level) > 0.85 and (np.diff(edges) > 0).all()


def test_levels_of_odd_input(spark, languages):
    texts = ["the cat is here and the dog is small " * 10, "notwithstanding the underdetermination of the commensurability " * 10] * 12
    model = reading.fit_levels(texts, np.array([1, 4] * 12), languages, np.zeros(reading.COUNT_BUCKETS, np.int64))
    rows = [("a", None), ("b", ""), ("c", "short"), ("d", texts[0]), ("d", texts[0]), ("e", "1 2 " * 60), ("f", "word " * 200_000), (None, texts[1])]
    df = spark.createDataFrame(rows, "video_id string, transcript string").withColumn("reading_level", F.lit("clash"))
    got = {r["video_id"]: r["reading_level"] for r in reading.reading_levels(df, model).collect()}
    assert set(got) == {"d", "e", "f", None} and got["d"] < got[None]
    assert reading.reading_levels(df.limit(0), model).collect() == []
    empty = reading.fit_levels([], np.zeros(0, np.int64), languages, np.zeros(reading.COUNT_BUCKETS, np.int64))
    assert set(empty.levels(WordTable(empty.reader.featurize), [texts[0]]).tolist()) <= {1, 2, 3, 4}


def test_corpus_counts(spark):
    df = spark.createDataFrame([("one two two",), (None,), ("Two, 3",), ("",)], "t string").repartition(3)
    counts = reading.corpus_counts(df, "t")
    assert counts[reading.bucket("two")] == 3 and counts[reading.bucket("one")] == 1 and counts.sum() == 4


def test_spam_found(spark, large):
    got = {r["doc_id"] for r in queries.p9_found(spark, large).collect()}
    reviews = table(spark, large, "doc_reviews").groupBy("doc_id").agg(F.max(F.col("verdict") == "spam").alias("spam"), F.count_distinct("verdict").alias("n")).where("n = 1").toPandas()
    agree = np.mean([(d in got) == s for d, s in zip(reviews["doc_id"], reviews["spam"])])
    assert agree > 0.85 and 0.01 < len(got) / table(spark, large, "documents").count() < 0.2


def test_spam_of_odd_input(spark, large):
    reviews = table(spark, large, "doc_reviews")
    prose = "The court finds that the claim was made in time and that the notice which the parties had agreed was given. "
    links = "\n".join(f"https://a{i}.example/x{i} cheap loans" for i in range(60))
    rows = [(1, None, "en"), (2, "", None), (3, " \n ", "en"), (4, prose * 3, None), (5, "word " * 100_000, "xx"), (6, links, "en"), (6, links, "en"), (None, links, "en"), (7, "...", "en")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = table(spark, large, "documents").select(F.col("doc_id") + 100, "text", "lang").toDF("doc_id", "text", "lang").union(odd)
    moved = reviews.withColumn("doc_id", F.col("doc_id") + 100)
    got = {r["doc_id"]: r["spam_share"] for r in spam.score_documents(df.withColumn("words", F.lit(1)), moved).where("doc_id < 100").collect()}
    assert set(got) == {4, 5, 6, 7} and got[4] < 0.5 and got[6] > 0.5
    assert spam.score_documents(df.limit(0), reviews).collect() == []
    assert spam.score_documents(odd, reviews.limit(0)).count() == 4


def test_a_recurring_paragraph_is_not_repetition():
    line = "the respondent did not appear and was not represented at the hearing of that day in court"
    own = spam.Blocks()
    _, _, _, once = own.of(["\n".join([line] + [f"other words stand here in line {i} of the text at hand now" for i in range(5)])], ["en"])
    _, _, _, often = own.of(["\n".join([line] * 30)], ["en"])
    pairs = spam.FEATURES.index("repeated_pairs")
    assert once[0, pairs] == 0 and often[:, pairs].max() == 0


def test_all_queries_are_registered(spark, data):
    for name, query in queries.queries().items():
        assert query(spark, data).columns, name
    assert pd.Series(list(queries.queries())).str.match(r"p[1-9]_").all()


def test_ten_thousand_graded_texts_are_fitted_on(spark, monkeypatch):
    monkeypatch.setattr(reading, "corpus_counts", lambda *_: None)
    monkeypatch.setattr(reading, "fit_levels", lambda texts, *_: len(texts))
    ids = spark.range(10_100).select(F.col("id").cast("string").alias("video_id"))
    videos = ids.select("video_id", F.lit(None).cast("string").alias("title"), F.repeat(F.lit("word "), 50).alias("transcript"), F.lit("en").alias("lang"))
    reviews = ids.select("video_id", F.lit("reading_level").alias("aspect"), F.lit("2").alias("label_value"))
    sample = samples.draw(videos, reviews, {"reading_level": 10_000})
    assert reading.fit_graded(sample, videos, None) == 10_000


def test_samples_are_whole_and_bounded(spark, monkeypatch, tmp_path):
    rows = [(f"v{i}", None, f"text {i} " * 100, "en") for i in range(300)] + [("v1", "other", "x", None), (None, "t", "x", "en")]
    videos = spark.createDataFrame(rows, "video_id string, title string, transcript string, lang string").withColumn("label", F.lit("clash"))
    votes = [("v1", "a", "x"), ("v1", "a", "y"), ("v1", "a", "y"), ("v2", "a", "q"), ("v2", "a", "p"), ("v3", "b", "z"), (None, "a", "x"), ("v4", "a", None)]
    reviews = spark.createDataFrame(votes, "video_id string, aspect string, label_value string")
    assert sorted(map(tuple, samples.verdicts(reviews, "a").collect())) == [("v1", "y"), ("v2", "p")]
    monkeypatch.setattr(samples, "SAMPLE_ROWS", 0)
    sample = samples.draw(videos, reviews, {"a": 10, "b": 10})
    assert sorted(r["video_id"] for r in sample.rows.collect()) == ["v1", "v2", "v3"]
    got = sample.take(sample.labels("a"), 10, "nullif(transcript, '')")
    assert got["video_id"].tolist() == ["v1", "v2"] and got["label"].tolist() == ["y", "p"] and got["text"][1] == "text 2 " * 100
    monkeypatch.setattr(samples, "SAMPLE_CHARS", 900)
    assert len(sample.take(sample.labels("a"), 10, "nullif(transcript, '')")) == 1
    monkeypatch.setattr(samples, "SAMPLE_ROWS", 1000)
    assert samples.draw(videos, None, {"a": 10}).rows.count() == 300
    assert samples.draw(videos.limit(0), reviews, {"a": 10}).rows.count() == 0
    samples.save(spark, {"a": 1}, str(tmp_path / "model"))
    assert samples.restore(spark, str(tmp_path / "model")) == {"a": 1}


def test_grades_in_parts_are_those_of_the_whole(spark, large, languages, monkeypatch):
    rows = table(spark, large, "videos").where("length(transcript) > 300").orderBy("id").limit(60).toPandas()
    texts, levels = rows["transcript"].tolist(), np.arange(60) % 4 + 1
    fitted = []
    for part in (1000, 7):
        monkeypatch.setattr(reading, "PART_ROWS", part)
        fitted.append(reading.fit_levels(texts, levels, languages, np.zeros(reading.COUNT_BUCKETS, np.int64)))
    whole, parts = fitted
    assert whole.reader.terms == parts.reader.terms and np.array_equal(whole.reader.grades, parts.reader.grades, equal_nan=True)
    assert np.allclose(whole.weights, parts.weights) and np.allclose(whole.edges, parts.edges)
