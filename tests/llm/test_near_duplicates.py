import random

import pytest

from lectern.llm import near_duplicates as nd
from lectern.llm import queries
from lectern.session import table

LIKENESS = 0.6


def brute(rows):
    sets = {}
    for video, title, text in rows:
        if video is None or not text or len(text.split()) < 50:
            continue
        words = nd._RUN.findall(f"{title or ''}\n{text}".lower())
        sets[video] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    ids = sorted(v for v in sets if sets[v])
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) >= LIKENESS * len(sets[a] | sets[b])}


def frame(spark, rows):
    return spark.createDataFrame(rows, "video_id string, title string, transcript string")


def corpus(seed, families, size):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for f in range(families):
        base = draw.choices(vocabulary, k=draw.randrange(55, 200))
        for m in range(size):
            own = list(base)
            for _ in range(draw.randrange(0, 9)):
                at = draw.randrange(len(own))
                own[at : at + draw.randrange(2)] = draw.choices(vocabulary, k=draw.randrange(2))
            rows.append((f"f{f:03d}m{m:02d}", f"Title {f}", " ".join(own)))
    return rows


def test_like_brute_force(spark):
    rows = corpus(1, 60, 4)
    got = {(r[0], r[1]) for r in nd.Duplicates(frame(spark, rows), LIKENESS).pairs(None).collect()}
    want = brute(rows)
    assert got <= want
    assert len(got) >= 0.999 * len(want) and len(want) > 50


def test_large_nodes(spark, monkeypatch):
    monkeypatch.setattr(nd, "LEAF", 5)  # families of 30 are dense nodes
    monkeypatch.setattr(nd, "BLOCK", 8)  # of several blocks
    rows = corpus(2, 4, 30)
    got, want = {(r[0], r[1]) for r in nd.Duplicates(frame(spark, rows), LIKENESS).pairs(None).collect()}, brute(rows)
    assert got <= want and len(got) >= 0.995 * len(want)


def test_large_nodes_that_fall_apart_branch_on(spark, monkeypatch):
    monkeypatch.setattr(nd, "LEAF", 4)
    monkeypatch.setattr(nd, "DENSE", 1.1)  # no node counts as dense, so each branches until its tokens are spent
    monkeypatch.setattr(nd, "BRANCHES", 19)
    rows = corpus(3, 6, 12)
    got, want = {(r[0], r[1]) for r in nd.Duplicates(frame(spark, rows), LIKENESS).pairs(None).collect()}, brute(rows)
    assert got <= want and len(got) >= 0.95 * len(want)


def family(spark, n):
    base = [f"w{i}" for i in range(120)]
    return frame(spark, [(f"v{m:05d}", "T", " ".join(base + [f"own{m}"])) for m in range(n)])


def test_a_dense_family_of_thousands(spark):
    """Different texts that are all alike: what is compared, and checked, stays near the number of their pairs."""
    assert nd.Duplicates(family(spark, 5000), LIKENESS).candidates().count() == 5000 * 4999 // 2
    assert nd.Duplicates(family(spark, 800), LIKENESS).class_pairs().count() == 800 * 799 // 2


def test_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [("a", "T", text), ("b", None, text), ("c", "", text), ("c", "", text), ("d", "T", None), ("e", "T", ""), ("f", "T", "short"), (None, "T", text), ("g", None, "... " * 60), ("h", "T", text.upper()), ("i", "T", "x " * 100_000)]
    df = frame(spark, rows).selectExpr("*", "'clash' as doc", "1 as n")
    got = {(r[0], r[1]) for r in nd.Duplicates(df, LIKENESS).pairs(None).collect()}
    assert got == brute(rows)
    assert ("a", "h") in got and ("b", "c") in got
    groups = {r["video_id"]: r for r in nd.Duplicates(df, LIKENESS).groups().collect()}
    assert set(groups) == {"a", "b", "c", "h", "i"}
    assert groups["h"]["class_id"] == "a" and groups["c"]["class_id"] == "b"
    assert {groups[v]["group_id"] for v in "abch"} == {"a"} and groups["i"]["group_id"] == "i"
    assert groups["a"]["n_links"] == 1 and groups["i"]["n_links"] == 0


def test_groups_of_every_transcript(spark):
    text = " ".join(f"w{i}" for i in range(60))
    short = " ".join(f"s{i}" for i in range(20))
    rows = [("a", "T", text), ("b", "T", text.upper()), ("c", "T", short), ("d", "t", short + "!"), ("e", "T", short + " more"), ("f", "T", "short"), ("g", None, "t short"), ("h", "U", "short"), ("i", None, "... ..."), ("j", None, "...\n..."), ("k", "", "?"), ("l", "T", None), ("m", "T", ""), ("n", "T", " \n"), (None, "T", short)]
    df = frame(spark, rows)
    groups = {r["video_id"]: r for r in nd.Duplicates(df, LIKENESS, every=True).groups().collect()}
    assert {v: r["class_id"] for v, r in groups.items()} == {"a": "a", "b": "a", "c": "c", "d": "c", "e": "e", "f": "f", "g": "f", "h": "h", "i": "i", "j": "i", "k": "k"}
    assert {v: r["group_id"] for v, r in groups.items()} == {"a": "a", "b": "a", "c": "c", "d": "c", "e": "c", "f": "f", "g": "f", "h": "h", "i": "i", "j": "i", "k": "k"}
    assert {v for v, r in groups.items() if r["n_links"]} == {"c", "d", "e"}


def test_groups_query_holds_every_video_with_a_transcript(spark, data):
    got = [r["video_id"] for r in queries.p1_groups(spark, data).collect()]
    videos = table(spark, data, "videos").select("video_id", "transcript").toPandas()
    assert sorted(got) == sorted({v for v, t in zip(videos["video_id"], videos["transcript"]) if t and t.strip()})


def test_empty(spark):
    assert nd.Duplicates(frame(spark, []), LIKENESS).pairs(None).collect() == []
    assert nd.Duplicates(frame(spark, []), LIKENESS).groups().collect() == []


def test_exact_copies_by_the_stated_form(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(f"v{i:02d}", "T", text) for i in range(40)] + [("z", "T", text + " more")]
    form = lambda n: sorted((r[0], r[1]) for r in nd.Duplicates(frame(spark, rows), LIKENESS).pairs(n).collect())
    short = [("v00", f"v{i:02d}") for i in range(1, 40)] + [("v00", "z")]
    assert form(1) == form(39) == short
    assert form(None) == form(40) == sorted(brute(rows))


def test_a_class_of_501_copies(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = frame(spark, [(f"v{i:03d}", "T", text) for i in range(501)])
    assert nd.Duplicates(df, LIKENESS).pairs(None).count() == 125_250
    assert nd.Duplicates(df, LIKENESS).pairs(queries.COPIES).count() == 500
    assert nd.Duplicates(df.where("video_id < 'v500'"), LIKENESS).pairs(queries.COPIES).count() == 124_750
    groups = nd.Duplicates(df, LIKENESS).groups().collect()
    assert len(groups) == 501 and {(r["class_id"], r["group_id"], r["n_links"]) for r in groups} == {("v000", "v000", 0)}


def test_one_video_in_a_third_of_the_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = corpus(4, 20, 2)
    df = frame(spark, rows + [("hot", "T", text)] * 2000 + [("near", "T", text + " more")])
    got = {(r[0], r[1]) for r in nd.Duplicates(df, LIKENESS).pairs(None).collect()}
    assert got == brute(rows + [("hot", "T", text), ("near", "T", text + " more")])
