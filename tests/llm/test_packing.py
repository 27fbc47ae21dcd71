import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.lists(st.integers(1, 300), max_size=80))
def test_plan_covers_every_rank_once_and_fits(capacity, sizes):
    bounds = packing.class_bounds(capacity)
    sizes = np.array([min(s, capacity) for s in sizes], int)
    classes = np.searchsorted(bounds, sizes)
    counts = np.bincount(classes, minlength=len(bounds))
    used, load = np.zeros(len(bounds), int), {}
    for k, start, end, each, first in packing.plan(capacity, bounds, counts):
        assert start == used[k]
        used[k] = end
        for rank in range(start, end):
            box = first + (rank - start) // each
            load[box] = load.get(box, 0) + int(bounds[k])
    assert (used == counts).all()
    assert all(v <= capacity for v in load.values())
    assert sorted(load) == list(range(1, len(load) + 1))


def check(items, got, capacities):
    for target, capacity in capacities.items():
        mine = [r for r in got if r["target_id"] == target]
        load, total, pieces = {}, {}, {}
        for r in mine:
            load[r["container_no"]] = load.get(r["container_no"], 0) + r["piece_size"]
            total[r["doc"]] = total.get(r["doc"], 0) + r["piece_size"]
            pieces[r["doc"]] = pieces.get(r["doc"], 0) + 1
        assert all(v <= capacity for v in load.values())
        assert total == {d: n or 0 for d, n in items}
        assert all(pieces[d] == max(1, math.ceil((n or 0) / capacity)) for d, n in items)


def test_pack(spark):
    draw = np.random.default_rng(2)
    items = [(i, int(n)) for i, n in enumerate(draw.lognormal(4, 1.5, 3000))] + [(9001, None), (9002, 0), (9003, 512), (9004, 513), (9005, 100_000)]
    df = spark.createDataFrame([(d, n, "x", "y") for d, n in items], "doc long, n long, target_id string, container_no string")
    capacities = {1: 512, 2: 2048}
    got = packing.pack(df.repartition(7), "doc", "n", capacities).collect()
    check(items, got, capacities)
    for target, capacity in capacities.items():
        containers = len({r["container_no"] for r in got if r["target_id"] == target})
        assert containers <= 1.03 * math.ceil(sum(n or 0 for _, n in items) / capacity)
    again = packing.pack(df.repartition(3), "doc", "n", capacities).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))  # whatever the partitions


@pytest.mark.parametrize("items", [[], [(1, None)], [(1, 5)] * 1], ids=["none", "null", "one"])
def test_small_tables(spark, items):
    got = packing.pack(spark.createDataFrame(items, "doc long, n long"), "doc", "n", {3: 10}).collect()
    assert [(r["doc"], r["container_no"]) for r in got] == [(d, 1) for d, _ in items]


def test_repeated_items_are_packed_each(spark):
    got = packing.pack(spark.createDataFrame([(1, 6), (1, 6), (None, 6)], "doc long, n long"), "doc", "n", {1: 10}).collect()
    assert sorted(r["container_no"] for r in got) == [1, 2, 3]


def test_a_class_is_ranked_in_parts_by_its_size(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 40)
    items = [(i, 5) for i in range(500)] + [(None, 5)] * 500
    got = packing.pack(spark.createDataFrame(items, "doc long, n long").repartition(6), "doc", "n", {1: 10}).collect()
    load = {}
    for r in got:
        load[r["container_no"]] = load.get(r["container_no"], 0) + r["piece_size"]
    assert len(got) == 1000 and sorted(load) == list(range(1, 501)) and set(load.values()) == {10}
