import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lectern.operators import admission, frontier, merging, ranking, summaries, transitions
from lectern.session import table
from lectern.sources import exports, feeds, sinks
from lectern.streaming import arrivals


def test_feed_skips_what_is_broken(spark):
    lines = ["", None, "  ", "{bad", '{"id": "abcdefghijk", "title": "cut', '{"id": "abcdefghijk", "title": null, "duration": 3}', '{"title": "no id"}',
             '{"id": "short", "url": "http://x/watch?v=ABCDEFGHIJK"}', '{"id": "tooo-looong-id"}']
    raw = spark.createDataFrame([(i, x, None) for i, x in enumerate(lines)], "arrival long, line string, fetched_at timestamp")
    assert sorted(r["arrival"] for r in feeds.entries(raw).collect()) == [5, 7, 8]
    assert sorted((r["arrival"], r["video_id"]) for r in feeds.valid_entries(raw).collect()) == [(5, "abcdefghijk"), (7, "ABCDEFGHIJK")]
    assert feeds.entries(raw.limit(0)).count() == 0


def test_licence_responses(spark):
    body = json.dumps({"items": [{"id": "a", "status": {"license": "youtube"}}, {"id": "b", "status": {}}, {"id": "c"}]})
    rows = [(1, None, ["a", "b", "c", "d", "d", None], body), (2, None, ["a"], "{cut"), (3, None, ["a"], None), (4, None, ["a"], ""), (5, None, ["z"], '{"items": []}')]
    df = spark.createDataFrame(rows, "request_id long, requested_at timestamp, requested_ids array<string>, body string")
    got = {(r["request_id"], r["video_id"]): r["licence"] for r in feeds.scanned_licences(df).collect()}
    assert got == {(1, "a"): "youtube", (1, "b"): "unknown", (1, "c"): "unknown", (1, "d"): "unavailable", (5, "z"): "unavailable"}


def test_first_arrival_wins_in_any_layout(spark):
    rows = [("a", 3, "late"), ("a", 1, "first"), ("b", 2, None), (None, 0, "x"), ("held", 4, "y")]
    new, held = spark.createDataFrame(rows, "video_id string, arrival long, title string"), spark.createDataFrame([("held",)], "video_id string")
    for n in (1, 3):
        got = merging.insert_absent(new.repartition(n), held, "video_id", "arrival")
        assert sorted((r["video_id"], r["arrival"], r["title"]) for r in got.collect()) == [("a", 1, "first"), ("b", 2, None)]
    again = merging.insert_absent(new, got.select("video_id").union(held), "video_id", "arrival")
    assert again.count() == 0


def test_merge_and_stale(spark):
    base = spark.createDataFrame([("a", "x"), ("b", None)], "video_id string, v string")
    update = spark.createDataFrame([("a", None)], "video_id string, u string")
    assert sorted(map(tuple, merging.merge(base, update, "video_id", {"v": F.col("u")}).collect()), key=repr) == [("a", None), ("b", None)]
    rows = spark.sql("select * from values ('processing', timestamp'2026-01-01 00:00:00'), ('processing', timestamp'2026-01-01 00:50:00'), ('processing', null), ('error', timestamp'2026-01-01 00:00:00') as t(status, processing_started_at)")
    got = merging.release_stale(rows, F.lit("2026-01-01 01:00:00").cast("timestamp"), 30)
    assert sorted(r["status"] for r in got.collect()) == ["error", "pending", "processing", "processing"]


@pytest.mark.parametrize("n", [0, 1, 10, 1001])
def test_global_rank_and_shards(spark, n):
    df = spark.range(n).withColumn("half", F.col("id") % 2).repartition(5)
    order = [F.desc("half"), F.asc("id")]
    ranked = sorted((r["rank"], r["id"]) for r in ranking.global_rank(df, order).collect())
    want = sorted(range(n), key=lambda i: (-(i % 2), i))
    assert ranked == [(k + 1, i) for k, i in enumerate(want)]
    shards = {r["shard"]: r["count"] for r in ranking.sharded(df, order, 250).groupBy("shard").count().collect()}
    assert shards == {k: min(250, n - 250 * k) for k in range(-(-n // 250))}


def test_quota_sampling(spark):
    df = spark.range(100)
    got = ranking.sample_buckets(df, {"even": (F.col("id") % 2 == 0, 3), "any": (F.lit(True), 5), "none": (F.col("id") < 0, 2)}, "id", [F.col("id")])
    assert {r["id"]: r["bucket"] for r in got.collect()} == {0: "even", 2: "even", 4: "even", 1: "any", 3: "any"}


def test_frontier_ends_on_cycles(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "b"), ("a", None), ("x", "y"), ("b", "b"), (None, "q")]
    edges = frontier.clean_edges(spark.createDataFrame(rows, "from_channel string, to_channel string"))
    got = {r["node"]: r["depth"] for r in frontier.reach(edges, spark.createDataFrame([("a",)], "node string")).collect()}
    assert got == {"a": 0, "b": 1, "c": 2}
    assert frontier.reach(edges, spark.createDataFrame([], "node string")).count() == 0


def test_reach_has_no_last_round(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(53)] + [("n53", "n0")], "source string, target string")
    got = {r["node"]: r["depth"] for r in frontier.reach(edges, spark.createDataFrame([("n0",)], "node string")).collect()}
    assert got == {f"n{i}": i for i in range(54)}


def test_distribution_and_running(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, v long")
    got = {r["k"]: (r["n"], r["percent"]) for r in summaries.distribution(df, "k").collect()}
    assert got == {"a": (2, 50.0), None: (1, 25.0), "b": (1, 25.0)}
    assert [r["running_total"] for r in summaries.running(df.where("k = 'a'"), "k", ["v"], "v").orderBy("v").collect()] == [1, 3]
    assert summaries.distribution(df.limit(0), "k").count() == 0


def lines(path):
    return {f.name: [json.loads(x) for x in f.read_text(encoding="utf-8").splitlines()] for f in sorted(path.glob("*.jsonl"))}


@pytest.mark.parametrize("n", [0, 8, 10])
def test_shards_keep_order_names_and_nulls(spark, tmp_path, n):
    df = spark.range(n).selectExpr("id", "concat('é 数 ', id) as title", "if(id = 3, null, id) as x").repartition(5)
    (tmp_path / "out").mkdir()
    (tmp_path / "out/train-00007.jsonl").write_text("{}")  # of an earlier, larger export
    ranked = sinks.write_json_shards(df, ["id", "title", "x"], [F.desc("id")], 4, str(tmp_path / "out"))
    got = lines(tmp_path / "out")
    assert list(got) == [f"train-{k:05d}.jsonl" for k in range(-(-n // 4))]
    rows = [r for part in got.values() for r in part]
    assert [r["id"] for r in rows] == list(range(n))[::-1] and all(list(r) == ["id", "title", "x"] for r in rows)
    assert [r["x"] for r in rows if r["id"] == 3] == [None] * (n > 3)
    assert all(len(part) == 4 for part in list(got.values())[:-1]) and ranked.count() == n
    assert not (tmp_path / "out/_parts").exists() and all("数" in r["title"] for r in rows)


def test_transcripts_export(spark, data, tmp_path):
    videos = table(spark, data, "videos")
    stats = exports.export_transcripts(videos, str(tmp_path), 40)
    pdf = videos.where("status = 'completed' and transcript is not null").toPandas()
    want = pdf.sort_values(["priority", "completed_at", "id"], ascending=[False, True, True], na_position="last")
    got = lines(tmp_path)
    rows = [r for part in got.values() for r in part]
    assert len(got) == stats["Files"] == -(-len(pdf) // 40) and [r["text"] for r in rows] == want["transcript"].tolist()
    assert stats["Characters"] == int(pdf["transcript"].str.len().sum()) and rows[0].keys() >= {"video_id", "url", "speed_ratio", "license_risk"}
    card = (tmp_path / "README.md").read_text(encoding="utf-8")
    assert f"- **Videos**: {len(pdf):,}" in card and "| `speed_ratio` |" in card and "n<1K" in card
    again = exports.export_transcripts(videos.limit(0), str(tmp_path), 40)
    assert again["Videos"] == 0 and lines(tmp_path) == {}


def test_queue_export(spark, data, tmp_path):
    videos = table(spark, data, "videos")
    stats = exports.export_queue(videos, str(tmp_path / "all"), 100)
    rows = [r for part in lines(tmp_path / "all").values() for r in part]
    assert len(rows) == stats["Videos"] == videos.count() and stats["Files"] == 3
    card = (tmp_path / "all/README.md").read_text(encoding="utf-8")
    assert all(f"## {t}" in card for t in ("Status", "Priority", "Category", "Risk")) and "🟢 green" in card
    exports.export_queue(videos.drop("content_category", "license_risk"), str(tmp_path / "few"), 1000)
    few = lines(tmp_path / "few")["train-00000.jsonl"]
    assert "license_risk" not in few[0] and "## Risk" not in (tmp_path / "few/README.md").read_text(encoding="utf-8")


def test_a_claim_falls_back_only_if_all_buckets_are_empty(spark):
    some, none, spare = spark.range(2), spark.range(0), spark.range(10, 13)
    assert sorted(r["id"] for r in transitions.or_else(some, spare).collect()) == [0, 1]
    assert sorted(r["id"] for r in transitions.or_else(none, spare).collect()) == [10, 11, 12]


def test_edges_are_inserted_by_pair(spark):
    new = spark.createDataFrame([("a", "b", 2), ("a", "b", 1), ("a", "c", 3), ("a", None, 4)], "s string, t string, n int")
    held = spark.createDataFrame([("a", "c"), ("b", "a")], "s string, t string")
    assert [tuple(r) for r in merging.insert_absent(new, held, ["s", "t"], "n").collect()] == [("a", "b", 1)]


def test_admission_of_odd_entries(spark):
    rows = [("v1", 1, None, None, None), ("v1", 0, "let's play chess", 2000.0, None), ("v2", 2, "Cours de chimie", 0.0, "UCx"), ("v3", 3, "let s play", 1000.0, None), ("v4", 4, "x" * 600, 1000.0, "UCx"), (None, 5, "t", 1000.0, None)]
    df = spark.createDataFrame(rows, "video_id string, arrival long, title string, duration double, channel_id string").withColumn("priority", F.lit(99))
    got = {name: {r["video_id"]: r for r in admission.admitted(df, name).collect()} for name in admission.PROFILES}
    assert set(got["related"]) == {"v1", "v2", "v3", "v4"} and got["related"]["v1"]["arrival"] == 1 and got["related"]["v1"]["duration"] is None
    assert got["related"]["v2"]["priority"] == 8 and got["boot10m"]["v2"]["priority"] == 5
    assert set(got["channel"]) == {"v1", "v4"} and got["channel"]["v1"]["duration"] == 0
    assert {v: r["license_risk"] for v, r in got["safe"].items()} == {"v1": "yellow", "v2": "green", "v4": "green"}
    assert set(got["boot1m"]) == set(got["aggressive"]) == set(got["mega"]) == {"v1", "v3", "v4"}
    assert len(got["mega"]["v4"]["title"]) == 500 and got["mega"]["v4"]["priority"] == 8 and got["mega"]["v3"]["course"] == "search"
    assert all(admission.admitted(df.limit(0), name).count() == 0 for name in admission.PROFILES)


def test_running_over_a_hot_group(spark):
    rows = [("hot", i, i % 7) for i in range(900)] + [(None, i, 1) for i in range(20)] + [("c", 0, None), ("c", 1, 4)]
    df = spark.createDataFrame(rows, "k string, t int, v long").repartition(6)
    got = {(r["k"], r["t"]): (r["seen"], r["running_total"]) for r in summaries.running(df, "k", ["t"], "v").collect()}
    assert got["hot", 899] == (900, sum(i % 7 for i in range(900))) and got["hot", 450] == (451, sum(i % 7 for i in range(451)))
    assert got[None, 19] == (20, 20) and got["c", 0] == (1, None) and got["c", 1] == (2, 4) and len(got) == len(rows)


def test_missing_columns_and_visited(spark, tmp_path):
    (tmp_path / "seen.txt").write_text("a b\n\n  b c \n")
    assert sorted(r["word"] for r in feeds.visited(spark, str(tmp_path)).collect()) == ["a", "b", "c"]
    assert feeds.with_missing(spark.range(1), {"id": "string", "x": "string"}).dtypes == [("id", "bigint"), ("x", "string")]


def test_stream_appends_each_video_once(spark, tmp_path):
    source, queue, state = tmp_path / "in", tmp_path / "queue", tmp_path / "state"
    source.mkdir()
    line = lambda i: json.dumps({"id": f"video{i:06d}", "title": f"t{i}", "duration": 1000})
    (source / "one_videos.json").write_text("\n".join([line(1), line(2), line(2), "{cut"]))
    (source / "ignored.txt").write_text(line(9))

    def run():
        arrivals.into_queue(arrivals.arriving_entries(spark, str(source)), str(queue), str(state)).awaitTermination()
        return sorted(r["video_id"] for r in spark.read.parquet(str(queue)).collect())

    assert run() == ["video000001", "video000002"]
    (source / "playlist_x.json").write_text(line(4))
    (source / "two_videos.json").write_text("\n".join([line(2), line(3)]))
    assert run() == ["video000001", "video000002", "video000003", "video000004"]
    assert run() == ["video000001", "video000002", "video000003", "video000004"]
    (queue / "part-broken.parquet").write_text("not a table")
    (source / "three_videos.json").write_text(line(5))
    with pytest.raises(StreamingQueryException):  # a queue that cannot be read is not an empty one
        run()


def test_late_counts_stream_and_batch_agree(spark, data, tmp_path):
    events = table(spark, data, "events")
    events.write.parquet(str(tmp_path / "events"))
    stream = arrivals.late_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "events")))
    stream.writeStream.outputMode("complete").format("memory").queryName("late").trigger(availableNow=True).start().awaitTermination()
    assert sorted(map(tuple, spark.table("late").collect())) == sorted(map(tuple, arrivals.late_counts(events).collect()))
