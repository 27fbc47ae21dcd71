from collections import defaultdict

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lectern.operators.skew import heavy_keys, per_key, shared_out


def brute(rows):
    out = defaultdict(lambda: [0, set(), 0])
    for key, second, value in rows:
        out[key][0] += 1
        out[key][1] |= {second} - {None}
        out[key][2] += value or 0
    return {k: (n, len(s), t) for k, (n, s, t) in out.items()}


def found(df, partitions):
    return {r["key"]: (r["n_rows"], r["n_distinct"], r["total"]) for r in per_key(df, "k", "s", "v", partitions).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, s string, v long")


def test_one_key_holds_most_rows(spark):
    draw = np.random.default_rng(1)
    rows = [("hot" if draw.random() < 0.8 else f"k{draw.integers(50)}", f"s{draw.integers(300)}", int(draw.integers(9))) for _ in range(5000)]
    df = frame(spark, rows)
    assert found(df, 16) == brute(rows)
    assert max(parts(df, 16)) < 2 * 5000 / 16


def parts(df, n):
    return [len(p) for p in shared_out(df, "k", "s", "v", n).rdd.glom().collect()]


def test_one_pair_of_key_and_second_value_holds_most_rows(spark):
    for second in (None, "one"):
        rows = [("hot", second, 1)] * 16_000 + [(f"k{i % 40}", f"s{i}", 2) for i in range(4000)]
        df = frame(spark, rows).repartition(5)
        assert max(parts(df, 8)) < 2 * 20_000 / 8
        assert found(df, 8) == brute(rows)


def test_a_second_value_over_several_partitions_counts_once(spark):
    rows = [("hot", "same", 1)] * 900 + [("hot", "other", 1)] * 300 + [("cold", "same", 2)]
    assert found(frame(spark, rows), 8) == brute(rows)


def test_small_batches_meet_inside_a_partition(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [("a", f"s{i % 5}", i) for i in range(100)] + [(None, None, None)] * 20
        assert found(frame(spark, rows), 3) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_nulls_empty_strings_and_extra_columns(spark):
    rows = [(None, "a", 1), (None, None, None), ("", "a", 2), ("x", None, None), ("x", None, 3)]
    df = frame(spark, rows).selectExpr("*", "k as key", "v as total", "'z' as second")
    assert found(df, 4) == brute(rows)


def test_empty_table(spark):
    assert found(frame(spark, []), 4) == {}
    assert heavy_keys(frame(spark, []), "k", "s", "v", 0.04).collect() == []


def test_heavy_keys_leave_out_null_and_empty(spark):
    rows = [(None, "a", 1)] * 50 + [("", "a", 1)] * 50 + [("big", f"s{i}", 1) for i in range(60)] + [(f"k{i}", "a", 1) for i in range(100)]
    assert [r["key"] for r in heavy_keys(frame(spark, rows), "k", "s", "v", 0.04).collect()] == ["big"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, "", "a", "b"]), st.sampled_from([None, "", "x", "y", "z"]), st.integers(0, 5)), max_size=60), st.integers(1, 9))
def test_like_brute_force(spark, rows, partitions):
    assert found(frame(spark, rows), partitions) == brute(rows)
