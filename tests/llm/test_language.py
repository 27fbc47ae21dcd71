import numpy as np
import pandas as pd
import pytest

from lectern.llm import language as L
from lectern.llm import queries, samples
from lectern.session import table

LANGUAGES = pd.DataFrame({"lang_code": ["de", "en", "fr"], "iso3": ["deu", "eng", "fra"], "english_name": ["German", "English", "French"]})
SENTENCES = {
    "de": "der hund liegt neben dem alten haus und wir sehen heute auch die katze",
    "en": "the dog sits next to the old house and today we can also see the cat",
    "fr": "le chien est à côté de la vieille maison et on voit aussi le chat",
}


@pytest.fixture(scope="module")
def model():
    lines = [s for s in SENTENCES.values() for _ in range(5)]
    labels = np.repeat([0, 1, 2], 5)
    labels[0] = 1  # a wrong label
    return L.LanguageModel.fit(lines, labels, ["de", "en", "fr"])


@pytest.mark.parametrize("label,code", [("en", "en"), (" EN ", "en"), ("en-US", "en"), ("en_GB", "en"), ("English", "en"), ("deu", "de"), ("ger", "de"), ("Deutsch", "de"), ("fra_CA", "fr"), ("unknown", None), ("n/a", None), ("und", None), ("", None), (None, None)])
def test_labels(label, code):
    assert L.stated(label, L.label_names(LANGUAGES)) == code


def segments(spark, model, rows):
    df = spark.createDataFrame(rows, "video_id string, title string, transcript string, lang string").selectExpr("*", "1 as seg_no", "'x' as stated")
    return {(r["video_id"], r["seg_no"]): r for r in L.segments(df, model, L.label_names(LANGUAGES)).collect()}


def test_segments(spark, model):
    de, en, fr = (SENTENCES[c] for c in ("de", "en", "fr"))
    mixed = "\n".join([en, de + ' "le chien est là"', "too short", "", en, fr, "1 2 3 4 5 6 7 8 9"])
    rows = [("a", f"{fr} | {en}", mixed, "en-GB"), ("b", "short title", de, None), ("c", None, None, "en"), ("d", "", "", ""), ("e", en, None, "fra"), (None, None, mixed, "en"), ("f", None, (en + " ") * 5000, "EN")]
    got = segments(spark, model, rows)
    assert {k[1]: r["lang_code"] for k, r in got.items() if k[0] == "a"} == {0: "fr", 1: "en", 2: "de", 5: "en", 6: "fr", 7: None}
    assert {k for k in got if k[0] and k[0] in "bcdef"} == {("e", 0), ("f", 1)}
    assert got["e", 0]["stated"] == "fr" and got["e", 0]["lang_code"] == "en"
    assert all(0 <= r["confidence"] <= 1 for r in got.values()) and got["a", 7]["confidence"] == 0
    assert segments(spark, model, []) == {}


def test_every_title_and_line(spark, model):
    de, en = SENTENCES["de"], SENTENCES["en"]
    rows = [("a", "the old dog", f"{en}\n\nder alte hund\n \n12 34", "en"), ("b", " | le chat et la maison", None, None), ("c", " ", "\n\n", "en"), ("d", None, (en + "\n") * 5 + "le chat", "en"), ("e", "the cat and the old house also", "der hund", "en")]
    df = spark.createDataFrame(rows, "video_id string, title string, transcript string, lang string")
    got = {(r["video_id"], r["seg_no"]): r for r in L.segments(df, model, L.label_names(LANGUAGES), every=True).collect()}
    assert {k: r["lang_code"] for k, r in got.items() if k[0] != "d"} == {("a", 0): "en", ("a", 1): "en", ("a", 3): "de", ("a", 5): None, ("b", 0): "fr", ("e", 0): "en", ("e", 1): "de"}
    assert {k for k in got if k[0] == "d"} == {("d", n) for n in range(1, 7)} and got["d", 6]["lang_code"] == "fr"
    assert {k for k, r in got.items() if r["counted"]} == {("d", n) for n in range(1, 6)} | {("e", 0)}
    assert all((r["confidence"] > 1 / 3) == (r["lang_code"] is not None) for r in got.values())


def test_segments_query_holds_every_title_and_line(spark, data):
    rows = queries.p5_segments(spark, data).toPandas()
    videos = table(spark, data, "videos").select("video_id", "title", "transcript").toPandas()
    want = {(v, 0) for v, t in zip(videos["video_id"], videos["title"]) if t and t.strip()}
    want |= {(v, k) for v, t in zip(videos["video_id"], videos["transcript"]) if t for k, line in enumerate(t.split("\n"), 1) if line.strip()}
    assert set(zip(rows["video_id"], rows["seg_no"])) == want and len(rows) == len(want)
    assert rows[["lang_code", "confidence", "counted"]].notna().all(axis=None) and ((rows["lang_code"] == "und") == (rows["confidence"] == 0)).all()


def test_repeated_rows_give_a_segment_once(spark, data):
    videos = table(spark, data, "videos")
    languages = table(spark, data, "languages")
    args = (L.fit_languages(samples.draw(videos, table(spark, data, "review_labels"), {"main_language": 6000}), languages), languages)
    once = sorted(map(tuple, L.wrong_labels(videos, *args).collect()))
    assert len({r[:2] for r in once}) == len(once) > 0
    assert L.wrong_labels(videos.limit(0), *args).collect() == []


def test_main_language_agrees_with_reviews(spark, data):
    sf = data.replace("sf0.001", "sf0.01")
    rows = queries.p5_segments(spark, sf).toPandas()
    main = rows[rows["seg_no"] > 0].groupby("video_id")["lang_code"].agg(lambda s: s.value_counts().index[0])
    reviews = table(spark, sf, "review_labels").where("aspect = 'main_language'").toPandas()
    both = reviews[reviews["video_id"].isin(main.index)]
    assert np.mean(main[both["video_id"]].to_numpy() == both["label_value"].to_numpy()) > 0.85  # some reviews are wrong
