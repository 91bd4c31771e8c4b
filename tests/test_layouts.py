"""Tables stored so that later jobs move or read less: by key, searchable, splittable; feeds cut to what is met."""

import gzip

import pytest
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.operators.enrich import enrich_flows, with_threat, with_user
from emberlog.operators.summary import user_activity_summary
from emberlog.plans import reland as relanding
from emberlog.plans.reland import Lines, LinesDiffer, lines_of, reland
from emberlog.registry import queries, telemetry_views as views
from emberlog.sinks import write_gold, write_iocs, write_silver
from emberlog.sinks.keyed import _name, read_silver_by_second, write_silver_by_second
from emberlog.sources import read_flows, read_gold, read_lines, read_silver

TABLES = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def silver(spark, tmp_path):
    for name, view in {"flows": views.flows, "auth": views.auth, "proc": views.proc, "iocs": views.iocs}.items():
        (write_iocs if name == "iocs" else write_silver)(view(spark, TABLES), f"{tmp_path}/{name}")
    return str(tmp_path)


# Silver by key.


def moved_sides(plan):
    """What exchanges move: the columns of the scans below each."""
    lines = plan.split("\n")
    return [line for line in lines if "Exchange hashpartitioning" in line]


def test_lookups_by_key_are_not_moved(spark, silver, rows_of, no_broadcast):
    write_silver_by_second(spark, silver)
    auth, proc = read_silver_by_second(spark, silver)
    flows = read_silver(spark, silver, "flows")
    joined = with_user(flows, auth)
    moved = moved_sides(plan_of(joined))
    assert len(moved) == 1 and "src_computer" in moved[0]
    assert rows_of(joined) == rows_of(with_user(flows, read_silver(spark, silver, "auth")))

    iocs = read_silver(spark, silver, "iocs")
    gold = user_activity_summary(flows, auth, proc, iocs)
    plain = user_activity_summary(flows, read_silver(spark, silver, "auth"), read_silver(spark, silver, "proc"), iocs)
    # The feed, the flows summed by second, and the joined seconds; auth and proc stay where they are.
    assert len(moved_sides(plan_of(plain))) == 5 and len(moved_sides(plan_of(gold))) == 3
    assert rows_of(gold) == rows_of(plain)


def test_keyed_tables_in_another_session_and_anew(spark, silver, rows_of):
    write_silver_by_second(spark, silver)
    auth, _ = read_silver_by_second(spark, silver)
    before = rows_of(auth)
    spark.sql(f"DROP TABLE {_name(f'{silver}/by_second/auth')}")  # as a new session's catalog has it
    again, _ = read_silver_by_second(spark, silver)
    assert rows_of(again) == before and "Bucketed: true" in plan_of(again.groupBy("time", "source_computer").count())
    more = spark.createDataFrame([(5, "U0", "C0"), (5, "A", "C0"), (None, "B", None)], schemas.AUTH)
    more.write.mode("append").parquet(f"{silver}/auth")
    write_silver_by_second(spark, silver)
    found = read_silver_by_second(spark, silver)[0].where("time = 5 OR time IS NULL")
    assert rows_of(found, "time", "source_user") == [(None, "B"), (5, "A")]


# A feed larger than a broadcast.


def feed_of(spark, unmet):
    met = [("http://h1/a", "t"), ("http://h1/b", "s"), ("http://h2/", None)]
    rows = met + [(f"http://unmet{i}/x", "t") for i in range(unmet)]
    return spark.createDataFrame([(u, "", t, "", "") for u, t in rows], schemas.IOCS)


def test_only_hosts_that_are_met_matter(spark, rows_of, no_broadcast):
    flows = spark.createDataFrame(
        [(i, 0, "C1", "1", dst, "2", 6, 1, 1) for i, dst in enumerate(["h1", "h2", "h3", None, "h1", ""])], schemas.FLOWS
    )
    feed = feed_of(spark, 5000)
    got = with_threat(flows, feed, broadcast_limit=10_000)
    plan = plan_of(got)
    # The flows don't move at all.
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert rows_of(got, "time", "threat") == [(0, "s"), (1, None), (2, None), (3, None), (4, "s"), (5, None)]
    shuffled = with_threat(flows, feed, broadcast_limit=0)
    assert "BroadcastExchange" not in plan_of(shuffled)
    assert rows_of(shuffled) == rows_of(got)
    # Where even the hosts met are too large, both sides are shuffled.
    assert "BroadcastExchange" not in plan_of(with_threat(flows, feed, broadcast_limit=10))
    assert rows_of(with_threat(flows, feed, broadcast_limit=10)) == rows_of(got)


def test_enrichment_with_a_full_feed(spark, silver, rows_of):
    tables = [read_silver(spark, silver, n) for n in ("flows", "auth", "proc")]
    iocs = read_silver(spark, silver, "iocs")
    more = iocs.unionByName(feed_of(spark, 3000))
    want = rows_of(enrich_flows(*tables, iocs))
    assert rows_of(enrich_flows(*tables, more, broadcast_limit=20_000)) == want
    assert rows_of(enrich_flows(*tables, more, broadcast_limit=0)) == want


# Gold to be searched.


def scanned_rows(df):
    """Rows of the row groups that a finished scan had to open."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while "FileSourceScan" not in (kind := plan.getClass().getSimpleName()):
        plan = plan.executedPlan() if kind == "AdaptiveSparkPlanExec" else plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


def test_a_point_query_opens_few_row_groups(spark, tmp_path, rows_of):
    """Users and computers are spread at random over the hours: minima and maxima of a file tell nothing."""
    rows = spark.range(60_000).select(
        (F.col("id") % 40 * 3600).alias("time_bucket"),
        F.sha2(F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(5000))), 256).alias("user"),
        F.sha2(F.concat(F.lit("c"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3000))), 256).alias("src_computer"),
        *(F.lit(1).cast("long").alias(name) for name in schemas.GOLD_MEASURES),
    )
    write_gold(rows, str(tmp_path / "plain"))
    write_gold(rows, str(tmp_path / "found"), find_by=("user", "src_computer"))
    plain, found = (read_gold(spark, str(tmp_path / n)) for n in ("plain", "found"))
    some = rows.select("user", "src_computer").first()
    for column in ("user", "src_computer"):
        where = F.col(column) == some[column]
        assert rows_of(found.where(where)) == rows_of(plain.where(where))
        assert scanned_rows(found.where(where)) < 0.5 * 60_000
    absent = F.col("user") == "0123"
    assert scanned_rows(found.where(F.col("src_computer") == F.sha2(F.lit("nobody"), 256))) < 0.1 * 60_000
    assert found.where(absent).isEmpty()
    assert rows_of(found) == rows_of(plain)


# Files that can be split.


def test_relanded_lines_are_the_same_and_can_be_split(spark, tmp_path):
    source, target = tmp_path / "flows.gz", str(tmp_path / "relanded")
    lines = [f"{i},0,C{i % 97},N{i * 7919 % 10007},C{i % 89},80,6,{i % 50},{i * 31 % 9973}" for i in range(200_000)] + ["", "x,,", ""]
    with gzip.open(source, "wt") as out:
        out.writelines(f"{line}\n" for line in lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        moved = reland(spark, str(source), target, lines_per_file=90_000)
        assert moved.count == len(lines) and moved == lines_of(read_lines(spark, target))
        assert read_flows(spark, str(source)).rdd.getNumPartitions() == 1
        scan = read_flows(spark, target)
        assert scan.rdd.getNumPartitions() >= 4
        assert scan.exceptAll(read_flows(spark, str(source))).isEmpty() and scan.count() == 200_001
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    parts = sorted(p.name for p in (tmp_path / "relanded").glob("*.bz2"))
    assert len(parts) == 3
    first = read_lines(spark, f"{target}/{parts[0]}").limit(2).collect()
    assert [r["value"] for r in first] == lines[:2]


def test_a_line_lost_or_changed_keeps_the_old_target(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "a.gz", tmp_path / "out"
    with gzip.open(source, "wt") as out:
        out.write("one\ntwo\ntwo\n")
    reland(spark, str(source), str(target))
    before = {p.name for p in target.iterdir()}
    real = relanding.read_lines

    def changed(spark_, path):
        lines = real(spark_, path)
        return lines.select(F.regexp_replace("value", "two", "tow").alias("value")) if "staged" in str(path) else lines

    monkeypatch.setattr(relanding, "read_lines", changed)
    with pytest.raises(LinesDiffer):
        reland(spark, str(source), str(target))
    assert {p.name for p in target.iterdir()} == before
    assert [p.name for p in tmp_path.iterdir() if "staged" in p.name] == []


def test_lines_are_compared_as_a_bag(spark):
    def of(*values):
        return lines_of(spark.createDataFrame([(v,) for v in values], "value string"))

    assert of("a", "b", "b") == of("b", "a", "b") != of("a", "a", "b")
    assert of() == Lines(0, 0) and of("a") != of("a", "a")


def test_views_notice_a_changed_table(spark, tmp_path):
    def pages(*ids):
        rows = spark.createDataFrame([(i, f"http://h{i}/") for i in ids], "page_id long, url string")
        rows.write.mode("overwrite").parquet(f"{tmp_path}/pages.parquet")

    pages(1, 2)
    assert views._pages(spark, str(tmp_path))[0] == 2
    pages(1, 2, 3)
    assert views._pages(spark, str(tmp_path))[0] == 3
    assert views.feed_entries(spark, str(tmp_path)).count() == 3


# Raw files.


@pytest.fixture
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("name", ["auth", "flows"])
def test_raw_files_are_cut_finer_than_the_scan(spark, rows_of, no_coalescing, name):
    """The table is one row group, so one task scans it, and a gzip file is read by one task again."""
    view = queries.LOG_VIEWS[name](spark, TABLES)
    assert view.rdd.getNumPartitions() == 1
    whole = read_flows(spark, queries._bronze(spark, TABLES, "flows"))
    assert len(whole.inputFiles()) == 8 and rows_of(whole) == rows_of(views.flows(spark, TABLES))
    places = queries._bronze_parts(spark, TABLES, name)
    late = queries._is_late(F.col("time"))
    want = {"early": view.where(~late), "late": view.where(late)}
    if name == "flows":
        want["moved"] = want["late"].withColumn("time", F.col("time") + 10_000 * 3600)
    assert set(places) == set(want)
    for part, rows in want.items():
        got = spark.read.schema(schemas.LOGS[name]).csv(places[part])
        assert len(got.inputFiles()) == 8 and rows_of(got) == rows_of(rows) != []


def test_a_part_without_rows_is_an_empty_folder(spark, tmp_path):
    for table in ("events", "pages"):
        rows = spark.read.parquet(f"{TABLES}/{table}.parquet")
        (rows.where("ts < '2024-01-03'") if table == "events" else rows).write.parquet(f"{tmp_path}/{table}.parquet")
    places = queries._bronze_parts(spark, str(tmp_path), "flows")
    counts = {part: read_flows(spark, place).count() for part, place in places.items()}
    assert counts["early"] > 0 and counts["late"] == counts["moved"] == 0
    want = user_activity_summary(*(v(spark, str(tmp_path)) for v in (views.flows, views.auth, views.proc, views.iocs)))
    assert sorted(queries.gold_changed_hours(spark, str(tmp_path)).collect()) == sorted(want.collect())
