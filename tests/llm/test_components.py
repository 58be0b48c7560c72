import random

import pytest

from cohortloom.llm import components
from cohortloom.llm.components import connected_groups, mention_groups


def brute(ids, edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for v in ids:
        if v is not None:
            find(v)
    for a, b in edges:
        for x in (a, b):
            if x is not None:
                find(x)
        if a is not None and b is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {(v, find(v)) for v in parent}


def run(spark, ids, edges):
    v = spark.createDataFrame([(i, "x") for i in ids], "id long, a string")
    e = spark.createDataFrame([(a, b, 1.0) for a, b in edges], "a long, b long, id double")
    return {tuple(r) for r in connected_groups(v, e).collect()}


@pytest.mark.parametrize("task_edges", [200_000, 60, 0])
def test_long_chain_hub_and_small_groups(spark, monkeypatch, task_edges):
    monkeypatch.setattr(components, "TASK_EDGES", task_edges)
    rng = random.Random(1)
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    chain = [(2000 + i, 2001 + i) for i in range(120)] + [(1005, 2000)]
    pairs = [(rng.randrange(5000, 5400), rng.randrange(5000, 5400)) for _ in range(150)]
    edges = hub + chain + pairs + hub[:20] + [(7, 7), (None, 8), (9, None), (None, None)]
    rng.shuffle(edges)
    edges = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    ids = [1, 2, 2, None, 1000]
    assert run(spark, ids, edges) == brute(ids, edges)


def test_empty_and_only_self_links(spark):
    assert run(spark, [], []) == set()
    assert run(spark, [3], []) == {(3, 3)}
    assert run(spark, [], [(4, 4)]) == {(4, 4)}


def test_one_component_only(spark):
    assert run(spark, [], [(1, 2), (2, 3)]) == {(1, 1), (2, 1), (3, 1)}


def test_contradicting_and_null_rows(spark):
    i = spark.createDataFrame([(1,), (2,), (3,), (None,)], "name_id long")
    l = spark.createDataFrame([(1, 2, False), (2, 1, True), (2, 3, None), (5, None, True), (6, 7, False)], "name_id_a long, name_id_b long, is_match boolean")
    assert {tuple(r) for r in mention_groups(i, l).collect()} == {(1, 1), (2, 1), (3, 3), (5, 5)}
