"""T-occurrence search against plain counting, and clusters that no task takes whole."""

import random
import time
from collections import Counter

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from emberlog.llm import jaccard, staging
from emberlog.llm.divide_skip import connecting_links, occurring
from emberlog.llm.jaccard import jaccard_components


def parts(nodes, links):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def drifting(dice, count, size, universe=10_000):
    """Sets of which each has a few other members than one before it, so that links form chains and trees."""
    sets = [set(dice.sample(range(universe), size))]
    while len(sets) < count:
        new = set(dice.choice(sets[-6:]))
        for _ in range(dice.randrange(size // 6 + 2)):
            new.discard(dice.choice(sorted(new) or [0]))
            if dice.random() < 0.7:
                new.add(dice.randrange(universe))
        sets.append(new or {0})
    return [np.array(sorted(s), np.uint64) for s in sets]


def all_links(sets, percent):
    as_sets = [set(s.tolist()) for s in sets]
    return [
        (i, j)
        for i, a in enumerate(as_sets)
        for j, b in enumerate(as_sets[:i])
        if 100 * len(a & b) >= percent * len(a | b)
    ]


@pytest.mark.parametrize("seed", range(20))
def test_heap_finds_what_occurs_often_enough(seed):
    dice = random.Random(seed)
    lists = [sorted(dice.sample(range(60), dice.randrange(1, 40))) for _ in range(dice.randrange(1, 12))]
    counted = Counter(x for ids in lists for x in ids)
    for least in range(1, len(lists) + 1):
        assert list(occurring(lists, least)) == sorted((x, n) for x, n in counted.items() if n >= least)


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("percent", [50, 80, 100])
def test_links_connect_what_plain_counting_connects(seed, percent):
    dice = random.Random(seed)
    sets = drifting(dice, 80, dice.choice([3, 12, 40]))
    links, found = all_links(sets, percent), connecting_links(list(range(80)), sets, percent)
    assert {(max(p), min(p)) for p in found} <= set(links)
    assert parts(range(80), found) == parts(range(80), links)
    assert len(found) == 80 - len(set(parts(range(80), links).values()))


@pytest.mark.parametrize("seed", range(8))
def test_sides_and_classes_lose_nothing(seed):
    dice = random.Random(seed)
    sets = drifting(dice, 70, 20)
    links = all_links(sets, 80)
    side = [dice.randrange(2) for _ in sets]
    whole = parts(range(70), links)
    class_ = [whole[i] if dice.random() < 0.4 else None for i in range(70)]
    known = [(i, class_[i]) for i in range(70) if class_[i] is not None]
    between = connecting_links(list(range(70)), sets, 80, class_, side)
    assert all(side[a] != side[b] for a, b in between)
    across = [(a, b) for a, b in links if side[a] != side[b]]
    assert parts(range(70), between + known) == parts(range(70), across + known)


def test_many_near_copies_take_one_search():
    dice = np.random.default_rng(5)
    base = np.arange(20, dtype=np.uint64)
    sets = [np.sort(np.append(np.delete(base, i % 20), np.uint64(1000 + i))) for i in dice.permutation(40_000)]
    sets[0] = base
    start = time.process_time()
    found = connecting_links(list(range(len(sets))), sets, 80)
    assert len(found) == len(sets) - 1
    assert time.process_time() - start < 5


def chains(dice):
    """Documents that drift apart, copies of some, and documents that share a passage but no link."""
    rows, words = [], [f"w{dice.randrange(4000)}" for _ in range(120)]
    passage = words[:60]
    for i in range(90):
        if i % 30 == 29:
            words = passage + [f"w{dice.randrange(4000)}" for _ in range(60)]
        words = list(words)
        for _ in range(i % 3):
            words[dice.randrange(60, 120)] = f"x{i}"
        rows.append((i, " ".join(words)))
    return rows


def linked(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs).collect()}


@pytest.mark.parametrize("limit, hubs", [(2500, 1), (400, 16)])
def test_clusters_beyond_a_task_keep_every_link(spark, monkeypatch, limit, hubs):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", limit)
    monkeypatch.setattr(jaccard, "HUBS", hubs)
    rows = chains(random.Random(limit + hubs))
    assert linked(spark, rows) == plain.jaccard_components(rows)


def test_tables_about_keys_beyond_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(staging, "BROADCAST_LIMIT_BYTES", 0)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 400)
    rows = chains(random.Random(3))
    assert linked(spark, rows) == plain.jaccard_components(rows)


def test_blocks_of_a_large_cluster_hold_few_copies_of_its_core(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 1000)
    rows = []
    for i in range(400):
        shingles = np.arange(60) + (100 * i if i % 80 == 0 else 0)
        shingles[i % 60] = 100_000 + i
        rows.append((i, 1, 60, np.sort(shingles).astype(np.uint64).tobytes()))
    sets = spark.createDataFrame(rows, "owner long, cluster long, n long, shingles binary")
    totals = sets.groupBy("cluster").agg(F.sum("n").alias("total"))
    tasks, links = jaccard._cut(sets, totals, 80, 4)
    core = tasks.where("class is not null")
    # The few sets outside of the core fit one block, so a set of the core is in one task.
    assert core.count() == core.select("owner").distinct().count() == 396
    assert links.select("u").union(links.select("v")).distinct().count() == 396
