"""Lookups, joins and the summary on small tables, against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.operators.enrich import enrich_flows, with_process, with_threat, with_user
from emberlog.operators.lookups import auth_lookup, ioc_lookup, proc_lookup
from emberlog.operators.skew import find_heavy_keys, fits_broadcast, number_rows
from emberlog.operators.summary import summarise, user_activity_summary


def _flow(time, src, dst, packets=1, size=10):
    return (time, 0, src, "N1", dst, "80", 6, packets, size)


@pytest.fixture(scope="module")
def tables(spark):
    """Hot keys, exact copies, NULL keys, unlisted and listed hosts, several payloads per key."""
    rng = random.Random(7)
    flows = [_flow(50, "C1", "bad.example", 2, 20)] * 300  # a third, all copies
    flows += [_flow(None, None, None)] * 150
    for _ in range(450):
        time = rng.choice([None, 0, 50, 3599, 3600, 3601, 7200, -5])
        src = rng.choice([None, "C1", "C2", "C3"])
        dst = rng.choice([None, "", "bad.example", "x:80", "fine.example", "nothreat.example"])
        size = rng.choice([None, 46, 2**31 - 1])
        flows.append(_flow(time, src, dst, rng.choice([None, 1, 7]), size))
    auth = [
        (rng.choice([None, 0, 50, 3600, 7200]), rng.choice([None, "U1", "U2", "U10"]), rng.choice([None, "C1", "C2"]))
        for _ in range(60)
    ]
    proc = [
        (rng.choice([None, 0, 50, 3599, 3601]), "U@D", rng.choice([None, "C1", "C3"]),
         rng.choice([None, "P1", "P2", "P3"]), rng.choice(["Start", "End"]))
        for _ in range(60)
    ]
    iocs = [
        ("http://bad.example/a", "ignored", "phishing", "", ""),
        ("https://bad.example/b", "", "malware", "", ""),
        ("http://x:80/", "", "", "", ""),
        ("no url", "", "odd", "", ""),
        ("http://nothreat.example/", "", None, "", ""),
    ]
    data = {"flows": flows, "auth": auth, "proc": proc, "iocs": iocs}
    kinds = schemas.LOGS | {"iocs": schemas.IOCS}
    frames = {name: spark.createDataFrame(rows, kinds[name]).repartition(5) for name, rows in data.items()}
    return data, frames


def _smallest(rows, keys, payload):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row[payload])
    return {
        key: min((v for v in values if v is not None), default=None) for key, values in groups.items()
    }


def _host(url):
    if not url.startswith(("http://", "https://")):
        return ""
    return url.split("://", 1)[1].split("/")[0]


def _enriched(data):
    users = _smallest(data["auth"], (0, 2), 1)
    processes = _smallest(data["proc"], (0, 2), 3)
    threats = _smallest([(_host(r[0]), r[2]) for r in data["iocs"]], (0,), 1)
    out = []
    for flow in data["flows"]:
        key = (flow[0], flow[2])
        known = None not in key
        threat = threats.get((flow[4],)) if flow[4] is not None else None
        out.append(
            (*flow, users.get(key) if known else None, processes.get(key) if known else None,
             threat, int(threat is not None))
        )
    return out


def _gold(data):
    groups = defaultdict(list)
    for row in _enriched(data):
        bucket = None if row[0] is None else int(row[0] / 3600) * 3600
        groups[bucket, row[9], row[2]].append(row)

    def total(rows, i):
        values = [r[i] for r in rows if r[i] is not None]
        return sum(values) if values else None

    return [
        (*key, len(rows), total(rows, 8), total(rows, 7),
         len({r[10] for r in rows if r[10] is not None}), sum(r[12] for r in rows))
        for key, rows in groups.items()
    ]


def _ordered(rows):
    return sorted(map(tuple, rows), key=lambda row: [(v is not None, str(v)) for v in row])


def test_lookups_keep_one_row_per_key_null_keys_included(tables):
    data, frames = tables
    users = _smallest(data["auth"], (0, 2), 1)
    got = auth_lookup(frames["auth"]).select("time", "source_computer", "source_user").collect()
    assert _ordered(got) == _ordered((*k, v) for k, v in users.items())
    processes = _smallest(data["proc"], (0, 2), 3)
    got = proc_lookup(frames["proc"]).select("time", "computer", "process_name").collect()
    assert _ordered(got) == _ordered((*k, v) for k, v in processes.items())
    got = ioc_lookup(frames["iocs"]).collect()
    assert _ordered(got) == _ordered(
        [("bad.example", "malware"), ("x:80", ""), ("", "odd"), ("nothreat.example", None)]
    )


# heavy_rows 100 cuts the copies and the NULL keys over several parts; limit 0 is a large feed.
@pytest.mark.parametrize("heavy_rows", [100, 10**9])
@pytest.mark.parametrize("limit", [0, 10**9])
def test_enriched_flows(tables, heavy_rows, limit):
    data, frames = tables
    got = enrich_flows(**frames, broadcast_limit=limit, heavy_rows=heavy_rows)
    assert got.columns == schemas.FLOWS.fieldNames() + ["user", "process_name", "threat", "malicious_hit"]
    assert _ordered(got.collect()) == _ordered(_enriched(data))


@pytest.mark.parametrize("heavy_rows", [100, 10**9])
def test_single_joins(tables, heavy_rows):
    data, frames = tables
    flows, want = frames["flows"], _enriched(data)
    got = with_user(flows, frames["auth"], heavy_rows).collect()
    assert _ordered(got) == _ordered((*r[:9], r[9]) for r in want)
    got = with_process(flows, frames["proc"], heavy_rows).collect()
    assert _ordered(got) == _ordered((*r[:9], r[10]) for r in want)
    for limit in (0, 10**9):
        got = with_threat(flows, frames["iocs"], limit, heavy_rows).collect()
        assert _ordered(got) == _ordered((*r[:9], r[11]) for r in want)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("limit", [0, 10**9])
def test_both_summaries(spark, tables, limit, threshold):
    data, frames = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        direct = user_activity_summary(**frames, broadcast_limit=limit)
        by_rows = summarise(enrich_flows(**frames, broadcast_limit=limit, heavy_rows=100))
        for gold in (direct, by_rows):
            assert [(f.name, f.dataType) for f in gold.schema] == [
                (f.name, f.dataType) for f in schemas.GOLD
            ]
        assert _ordered(direct.collect()) == _ordered(_gold(data))
        assert _ordered(by_rows.collect()) == _ordered(_gold(data))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hits_are_found(tables):
    _, frames = tables
    total = user_activity_summary(**frames).agg(F.sum("malicious_hits")).first()[0]
    assert total >= 300


def test_heavy_keys_are_found_and_bounded(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.lit(None).cast("int").alias("n")
    )
    heavy = find_heavy_keys(rows, ["k", "n"], heavy_rows=1000)
    found = {r["key_hash"]: r["parts"] for r in heavy.table.collect()}
    expected = spark.sql("SELECT xxhash64(-1L, CAST(NULL AS INT))").first()[0]
    assert set(found) == {expected}
    assert found[expected] >= 10
    assert not find_heavy_keys(rows, ["k", "n"], heavy_rows=20_000)


def test_fits_broadcast_measures_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, None)] * 10, "host string, threat string")
    assert fits_broadcast(df, 20_000)
    assert not fits_broadcast(df, 10_000)
    assert fits_broadcast(df.limit(0), 0)


def test_all_of_very_many_heavy_keys_are_found(spark):
    rows = spark.range(0, 40_000 * 6).select((F.col("id") % 40_000).alias("k"))
    assert find_heavy_keys(rows, ["k"], heavy_rows=5).table.count() == 40_000


def test_dealing_does_not_depend_on_the_order_of_rows(spark):
    rows = spark.range(0, 5000).select((F.col("id") % 3).alias("k"), "id")
    numbered = {r["id"]: r["_spread"] for r in number_rows(rows).collect()}
    assert numbered == {r["id"]: r["_spread"] for r in number_rows(rows.repartition(7)).collect()}
