"""Components over long chains, in orders that a spreading minimum crosses slowly."""

import random

import pytest

from factloom.llm import common


def chains(n=300):
    rng = random.Random(11)
    adverse = [0, *range(n - 1, 0, -1)]
    shuffled = rng.sample(range(n), n)
    return [adverse, [n + i for i in shuffled], [2 * n + i for i in range(n)]]


def test_components_of_long_chains(spark):
    edges = [e for c in chains() for e in zip(c, c[1:])]
    random.Random(2).shuffle(edges)
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: min(c) for c in chains() for i in c}


def test_components_never_stop_short(spark):
    with pytest.raises(RuntimeError):
        common.components(spark.createDataFrame([(i, i + 1) for i in range(64)], "a long, b long"), max_rounds=2)
