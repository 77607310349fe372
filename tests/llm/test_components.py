"""Connected components: against a union of sets, and what a round costs the driver."""

from __future__ import annotations

import random

import pytest

from sparkprep.llm.components import connected_components

SCHEMA = "a bigint, b bigint"


def brute(edges):
    """Smallest node reached, of every node that is not the smallest itself."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in root if find(x) != x)


def scattered(n, seed):
    rng = random.Random(seed)
    return [(rng.randrange(-n, n), rng.randrange(-n, n)) for _ in range(n)]


SHUFFLED = random.Random(3).sample(range(200), 200)
GRAPHS = {
    "none": [],
    "loops and nulls": [(1, 1), (None, 2), (3, None), (4, 5), (5, 4), (4, 5), (4, 4)],
    "star": [(7, i) for i in range(500)],
    "two hubs": [(h, i) for h in (1000, -1) for i in range(300)],
    "chain": list(zip(SHUFFLED, SHUFFLED[1:])),
    "scattered": scattered(300, 1),
    "dense": [(a % 40, b % 40) for a, b in scattered(300, 2)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_against_sets(spark, name):
    found = connected_components(spark.createDataFrame(GRAPHS[name], SCHEMA)).collect()
    assert sorted((r["node"], r["root"]) for r in found) == brute(GRAPHS[name])


def test_edges_that_are_stars_take_no_round(spark):
    """Hubs with their copies, the usual case; every job's plan and tasks stay with the driver."""
    edges = [(h, 1000 * h + i) for h in range(1, 40) for i in range(50)]
    df = spark.createDataFrame(edges, SCHEMA)
    spark.sparkContext.setJobGroup("stars", "components")
    try:
        found = connected_components(df).count()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("stars")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found == len(edges)
    assert len(jobs) <= 9
