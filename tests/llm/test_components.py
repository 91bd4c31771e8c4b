import random

import pytest

from emberlog.llm import components as module


@pytest.mark.parametrize("last", [0, 1 << 20])
def test_components_of_chains_stars_and_repeats(spark, monkeypatch, last):
    monkeypatch.setattr(module, "LAST_LINKS", last)
    dice = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 230)] + [(5, 5), (3, 4), (4, 3), (3, 4)]
    dice.shuffle(pairs)
    got = {r["node"]: r["component"] for r in module.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(200, 230)} | {7: 7, 3: 3, 4: 3}
    assert got == want


def test_no_links(spark):
    assert module.components(spark.createDataFrame([], "u long, v long")).count() == 0
