"""Samples, line numbers, numeric summaries and checks on small tables."""

import hashlib
import math
import random
import statistics as plain

import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.operators import quality
from emberlog.operators.sampling import number_lines, preview, sample_n, take_first
from emberlog.operators.statistics import (
    describe_numeric,
    distinct_entities,
    hit_rows,
    hits_only,
    ingest_totals,
    reduction_pct,
    row_count,
)
from emberlog.plans.samples import sample_lines, write_samples
from emberlog.sources import read_lines


def test_take_first_and_preview(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(300)
    smallest = sorted(i * 7919 % 5003 for i in range(5000))
    assert [r["k"] for r in take_first(df, 700, "k").collect()] == smallest[:700]
    assert [r["k"] for r in take_first(df, 10, F.col("k").desc()).collect()] == smallest[::-1][:10]
    assert [r["k"] for r in preview(df, 5, "k").collect()] == smallest[:5]
    assert take_first(df, 9999, "k").count() == 5000


@pytest.mark.parametrize("n", [0, 1, 999, 20_000, 20_001])
def test_sample_n_is_exact_and_seeded(spark, n):
    df = spark.range(20_000).withColumnRenamed("id", "k")

    def token(key, seed):
        return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()

    for seed in (42, 7):
        want = sorted(range(20_000), key=lambda k: (token(k, seed), k))[:n]
        got = [r["k"] for r in sample_n(df, n, "k", seed).collect()]
        assert sorted(got) == sorted(want)


def test_sample_n_is_uniform(spark):
    """Keys of either half are drawn about equally often."""
    df = spark.range(50_000).withColumnRenamed("id", "k")
    low = sample_n(df, 10_000, "k").where("k < 25000").count()
    assert abs(low - 5000) < 250


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """A log of several files, some long enough for several splits, with copies of one line."""
    folder = tmp_path_factory.mktemp("log")
    lines = [f"line {i}" if i % 3 else "the same line" for i in range(40_000)]
    for part, start in enumerate(range(0, 40_000, 13_000)):
        (folder / f"part-{part:02d}.txt").write_text("\n".join(lines[start : start + 13_000]) + "\n")
    return str(folder), lines


def test_number_lines_over_files_and_splits(spark, log):
    path, lines = log
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        scan = read_lines(spark, path)
        assert scan.rdd.getNumPartitions() > 4
        numbered = number_lines(scan).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["line_no"], r["value"]) for r in numbered) == list(enumerate(lines))


def test_sample_lines(spark, log, tmp_path):
    path, lines = log
    first = sample_lines(spark, path, 15_000).orderBy("line_no").collect()
    assert [(r["line_no"], r["value"]) for r in first] == list(enumerate(lines[:15_000]))
    drawn = sample_lines(spark, path, 500, random=True).collect()
    assert len({r["line_no"] for r in drawn}) == 500
    assert all(lines[r["line_no"]] == r["value"] for r in drawn)
    # Copies of one line are drawn line by line, not all or none.
    assert 100 < sum(r["value"] == "the same line" for r in drawn) < 250

    written = write_samples(spark, {"x": path}, str(tmp_path / "out"), 100, compress=True)
    assert written == {"x": str(tmp_path / "out" / "x_sample")}
    assert list((tmp_path / "out" / "x_sample").glob("*.txt.gz"))
    back = number_lines(read_lines(spark, written["x"])).orderBy("line_no").collect()
    assert [r["value"] for r in back] == lines[:100]


def _describe(df):
    return {r["column"]: r.asDict() for r in describe_numeric(df).collect()}


def test_describe_small(spark):
    df = spark.createDataFrame(
        [(1, 1.5, "a"), (2, None, "b"), (4, float("nan"), "c"), (10, 2.5, "d")], "i int, x double, s string"
    )
    got = _describe(df)
    assert set(got) == {"i", "x"}
    assert [got["i"][k] for k in ("count", "mean", "min", "p25", "p50", "p75", "max")] == [
        4, 4.25, 1.0, 1.75, 3.0, 5.5, 10.0
    ]
    assert math.isclose(got["i"]["std"], plain.stdev([1, 2, 4, 10]))
    assert [got["x"][k] for k in ("count", "min", "p25", "p50", "p75", "max")] == [
        2, 1.5, 1.75, 2.0, 2.25, 2.5
    ]


def test_describe_empty_and_single(spark):
    got = _describe(spark.createDataFrame([(None, 3)], "a long, b long"))
    assert got["a"]["count"] == 0 and got["a"]["p50"] is None and got["a"]["max"] is None
    assert [got["b"][k] for k in ("count", "p25", "p50", "p75", "std")] == [1, 3.0, 3.0, 3.0, None]


@pytest.mark.parametrize("size", [2, 3, 5, 101, 60_000])
def test_describe_equals_pandas(spark, size):
    rng = random.Random(size)
    frame = pd.DataFrame(
        {
            "heavy": [0 if rng.random() < 0.6 else rng.randrange(10**12) for _ in range(size)],
            "wide": [rng.randrange(-(10**9), 10**9) for _ in range(size)],
            "few": [rng.randrange(4) for _ in range(size)],
        }
    )
    got = _describe(spark.createDataFrame(frame).repartition(8))
    want = frame.describe()
    for column in frame:
        names = {"mean": "mean", "std": "std", "min": "min", "25%": "p25", "50%": "p50", "75%": "p75", "max": "max"}
        for theirs, ours in names.items():
            assert math.isclose(got[column][ours], want[column][theirs], rel_tol=1e-9), (column, ours)


GOLD_ROWS = [
    (0, "U892", "C1040", 1, 46, 1, 0, 0),
    (0, "U356", "C150", 10, 10490, 44, 0, 0),
    (3600, None, "C150", 3, None, None, 2, 2),
    (3601, "U356", "C161", 0, 5, 7, 0, -1),
]


def test_gold_counts_and_checks(spark):
    gold = spark.createDataFrame(GOLD_ROWS, schemas.GOLD)
    assert tuple(distinct_entities(gold).first()) == (2, 3)
    assert hit_rows(gold).first()[0] == 1
    assert [r["time_bucket"] for r in hits_only(gold).collect()] == [3600]
    assert {r["rule"]: r["violations"] for r in quality.check_gold(gold).collect()} == {
        "total_flows >= 1": 1,
        "total_bytes >= total_packets": 1,
        "time_bucket on the hour": 1,
        "malicious_hits >= 0": 1,
    }
    rates = {r["column"]: r["null_rate"] for r in quality.null_rates(gold).collect()}
    assert (rates["user"], rates["total_bytes"], rates["time_bucket"]) == (0.25, 0.25, 0.0)
    empty = quality.null_rates(gold.limit(0)).collect()
    assert len(empty) == 8 and all(r["null_rate"] is None for r in empty)


def test_totals_and_reduction(spark):
    tables = {"a": spark.range(700), "b": spark.range(300), "none": spark.range(0)}
    totals = ingest_totals(tables)
    assert {r["dataset"]: r["records"] for r in totals.collect()} == {
        "a": 700, "b": 300, "none": 0, "TOTAL": 1000
    }
    raw = totals.where("dataset = 'TOTAL'")
    row = reduction_pct(raw, spark.range(5)).first()
    assert (row["raw_records"], row["gold_records"]) == (1000, 5)
    assert math.isclose(row["reduction_pct"], 99.5)
    assert reduction_pct(row_count(spark.range(0)), spark.range(0)).first()["reduction_pct"] is None


def test_fanout_is_noticed(spark):
    assert quality.check_fanout(spark.range(5), spark.range(5)).first()["no_fanout"]
    row = quality.check_fanout(spark.range(5), spark.range(6)).first()
    assert tuple(row) == (5, 6, False)


def test_value_domain(spark):
    df = spark.createDataFrame([("Start",), ("End",), ("End",), ("Stop",), (None,)], "v string")
    got = {r["value"]: (r["records"], r["allowed"]) for r in quality.value_domain(df, "v", ["Start", "End"]).collect()}
    assert got == {"Start": (1, True), "End": (2, True), "Stop": (1, False), None: (1, False)}


def test_schema_check(spark):
    got = quality.check_schema(spark.createDataFrame([(1, "a", 2)], "time int, who string, x long"), schemas.AUTH)
    assert [tuple(r)[1:] for r in got.orderBy("position").collect()] == [
        ("time", "int", "time", "int", True, 1),
        ("source_user", "string", "who", "string", False, 1),
        ("source_computer", "string", "x", "bigint", False, 1),
    ]
    short = quality.check_schema(spark.createDataFrame([], "time int"), schemas.AUTH)
    assert [r["matches"] for r in short.orderBy("position").collect()] == [True, False, False]
    assert [r["actual_column"] for r in short.orderBy("position").collect()] == ["time", None, None]


def test_partition_rows(spark):
    parts = quality.partition_rows(spark.range(0, 100, 1, 4)).collect()
    assert {r["partition"]: r["records"] for r in parts} == {i: 25 for i in range(4)}


def test_take_first_orders_only_what_lies_below_the_cut(spark):
    df = spark.range(0, 400_000, 1, 16).select(((F.col("id") * 7919) % 400_009).alias("k"), F.col("id").alias("payload"))
    top = take_first(df, 10_000, "k")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert "Filter" in plan and "TakeOrderedAndProject" in plan
    assert [r["k"] for r in top.collect()] == sorted(r["k"] for r in df.collect())[:10_000]


def test_take_first_with_ties_and_nulls(spark):
    df = spark.range(0, 100_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("k"))
    assert {r["k"] for r in take_first(df, 1000, "k").collect()} == {None}
    assert take_first(df, 70_000, "k").count() == 70_000


def test_quartiles_of_many_distinct_values_by_narrowing(spark):
    df = spark.range(0, 50_000).select((F.col("id") * 1.5).alias("a"), (F.col("id") % 11).alias("b"), F.lit(float("nan")).alias("c"))
    whole = {r["column"]: tuple(r) for r in describe_numeric(df).collect()}
    narrow = {r["column"]: tuple(r) for r in describe_numeric(df, ordered_rows=50).collect()}
    assert str(whole) == str(narrow)
    assert whole["a"][5:8] == (1.5 * 12499.75, 1.5 * 24999.5, 1.5 * 37499.25)


def test_fanout_guard_runs_the_joins_and_can_fail(spark):
    flows = spark.createDataFrame([(1, "C1"), (2, "C2")], "time int, src_computer string")
    once = spark.createDataFrame([(1, "U1")], "time int, user string")
    twice = once.union(once)
    good = quality.check_fanout(flows, flows.join(once.groupBy("time").agg(F.min("user").alias("user")), "time", "left"))
    assert "Join" in good._jdf.queryExecution().optimizedPlan().toString()
    assert good.first()["no_fanout"]
    assert tuple(quality.check_fanout(flows, flows.join(twice, "time", "left")).first()) == (2, 3, False)
