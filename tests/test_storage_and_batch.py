"""Silver and gold on disk, the report, and the whole batch."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.operators.quality import profile
from emberlog.operators.summary import user_activity_summary
from emberlog.plans.batch import run_batch
from emberlog.plans.silver import build_silver_iocs, build_silver_log
from emberlog.registry import telemetry_views as views
from emberlog.session import shared_path
from emberlog.sinks import write_gold, write_iocs, write_silver
from emberlog.sources import read_gold, read_silver

TABLES = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def gold(spark):
    parts = [view(spark, TABLES) for view in (views.flows, views.auth, views.proc, views.iocs)]
    return user_activity_summary(*parts)


def test_silver_is_snappy_parquet_and_overwrites(spark, tmp_path, rows_of):
    auth = views.auth(spark, TABLES)
    for _ in range(2):
        write_silver(auth, f"{tmp_path}/auth", partitions=3)
    assert len(list((tmp_path / "auth").glob("*.snappy.parquet"))) == 3
    back = read_silver(spark, str(tmp_path), "auth")
    assert back.schema == schemas.AUTH
    assert rows_of(back) == rows_of(auth)


def test_silver_scan_reads_only_what_is_asked(spark, tmp_path):
    write_silver(views.flows(spark, TABLES), f"{tmp_path}/flows")
    flows = read_silver(spark, str(tmp_path), "flows").where("bytes_count > 100").select("time")
    plan = _plan(flows)
    assert "ReadSchema: struct<time:int,bytes_count:int>" in plan
    assert "GreaterThan(bytes_count,100)" in plan


def test_gold_directories_types_and_pruning(spark, gold, tmp_path, rows_of):
    path = str(tmp_path / "gold")
    write_gold(gold, path)
    buckets = {r["time_bucket"] for r in gold.select("time_bucket").distinct().collect()}
    assert {p.name for p in (tmp_path / "gold").glob("time_bucket=*")} == {
        f"time_bucket={b}" for b in buckets
    }
    assert spark.read.parquet(path).schema["time_bucket"].dataType.simpleString() == "int"
    back = read_gold(spark, path)
    assert back.schema == schemas.GOLD
    assert rows_of(back) == rows_of(gold)

    some = read_gold(spark, path, 7200, 90000)
    assert rows_of(some) == rows_of(gold.where("time_bucket BETWEEN 7200 AND 90000"))
    plan = _plan(some)
    line = next(part for part in plan.split("\n") if "PartitionFilters" in part)
    pruned = line.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 7200" in pruned and "<= 90000" in pruned and "cast" not in pruned


def test_a_hot_bucket_is_cut_over_tasks(spark, tmp_path):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") * 3600).cast("long").alias("time_bucket"),
        F.concat(F.lit("U"), "id").alias("user"),
        F.concat(F.lit("C"), F.col("id") % 50).alias("src_computer"),
        *(F.lit(1).cast("long").alias(name) for name in schemas.GOLD_MEASURES),
    ).where("id % 20 < 12")
    write_gold(rows, str(tmp_path / "gold"), partitions=6)
    files = {p: len(list(p.glob("*.parquet"))) for p in (tmp_path / "gold").glob("time_bucket=*")}
    assert files[tmp_path / "gold" / "time_bucket=0"] >= 3
    assert sum(files.values()) <= len(files) + 6


def test_small_feed_is_one_file(spark, tmp_path, rows_of):
    iocs = views.iocs(spark, TABLES).repartition(5)
    write_iocs(iocs, f"{tmp_path}/iocs")
    assert len(list((tmp_path / "iocs").glob("*.parquet"))) == 1
    assert rows_of(read_silver(spark, str(tmp_path), "iocs")) == rows_of(iocs)


def test_profile(spark, tmp_path):
    write_silver(views.auth(spark, TABLES), f"{tmp_path}/auth", partitions=2)
    write_silver(views.auth(spark, TABLES).limit(0), f"{tmp_path}/norows")
    (tmp_path / "nofiles").mkdir()
    names = ["auth", "norows", "nofiles", "absent"]
    got = {r["dataset"]: r for r in profile(spark, {n: f"{tmp_path}/{n}" for n in names}).collect()}
    auth = got["auth"]
    assert (auth["files"], auth["records"], auth["status"]) == (2, views.auth(spark, TABLES).count(), "OK")
    size = sum(p.stat().st_size for p in (tmp_path / "auth").glob("*.parquet")) / 1_048_576
    assert abs(auth["size_mb"] - size) < 1e-9
    assert (got["norows"]["records"], got["norows"]["status"]) == (0, "EMPTY")
    assert (got["nofiles"]["files"], got["nofiles"]["status"]) == (0, "EMPTY")
    assert tuple(got["absent"])[1:] == (None, None, None, "MISSING")


# Rows traced through the layers: raw lines, and what each summary must say.
FLOW_LINES = [
    "1,0,C1065,389,C3799,N10451,6,10,5323",
    "1,0,C1423,N1136,C1707,N1,6,5,847",
    "1,0,C1423,N1142,C1707,N1,6,5,847",
    "4000,0,C1,N1,27.215.210.91:46312,80,6,1,46",
    "4001,0,C1,N1,wood-zone.weplord.lat,80,6,2,92",
    "4001,0,C1,N1,C2,80,6,x,100",
]
AUTH_LINES = ["1,U1,C1423", "1,U0,C1423", "4000,U9,C1", "4001,U9,C1", "6,U4,C5"]
PROC_LINES = ["1,C1$@DOM1,C1423,P16,Start", "4000,U9@DOM1,C1,P4,Start", "4001,U9@DOM1,C1,P5,End"]
FEED = {
    "query_status": "ok",
    "urls": [
        {"url": "http://27.215.210.91:46312/bin.sh", "threat": "malware_download"},
        {"url": "https://wood-zone.weplord.lat/a", "threat": "malware_download"},
        {"url": "http://182.121.152.140:40641/i", "threat": "malware_download"},
    ],
}
GOLD_ROWS = {
    (0, None, "C1065", 1, 5323, 10, 0, 0),
    (0, "U0", "C1423", 2, 1694, 10, 1, 0),
    (3600, "U9", "C1", 3, 238, 3, 2, 2),
}


@pytest.fixture
def bronze(tmp_path):
    def log(name, lines):
        path = tmp_path / f"{name}.txt.gz"
        with gzip.open(path, "wt") as out:
            out.write("\n".join(lines) + "\n")
        return str(path)

    (tmp_path / "feed.json").write_text(json.dumps(FEED, indent=1))
    return {
        "auth": log("auth", AUTH_LINES),
        "dns": log("dns", ["2,C4653,C5030"]),
        "flows": log("flows", FLOW_LINES),
        "proc": log("proc", PROC_LINES),
        "iocs": str(tmp_path / "feed.json"),
    }


def test_whole_batch_and_left_out_stages(spark, bronze, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    report = run_batch(spark, bronze, silver, gold, partitions=2)
    stored = read_gold(spark, f"{gold}/user_activity_summary")
    assert {tuple(r) for r in stored.collect()} == GOLD_ROWS
    assert {r["dataset"]: (r["records"], r["status"]) for r in report["profile"].collect()} == {
        "auth": (5, "OK"), "dns": (1, "OK"), "flows": (6, "OK"), "proc": (3, "OK"),
        "iocs": (3, "OK"), "gold": (3, "OK"),
    }
    assert all(r["violations"] == 0 for r in report["gold_checks"].collect())
    assert report["gold_hit_rows"].first()[0] == 1
    assert tuple(report["gold_entities"].first()) == (2, 3)
    assert report["auth_preview"].count() == 5

    # Gold alone is rebuilt from stored silver; validation alone writes nothing.
    spark.createDataFrame([(9, "U7", "C1065")], schemas.AUTH).write.mode("append").parquet(f"{silver}/auth")
    assert run_batch(spark, {}, silver, gold, stages=("gold",)) == {}
    again = run_batch(spark, {}, silver, gold, stages=("validate",))
    assert {r["dataset"]: r["records"] for r in again["profile"].collect()}["auth"] == 6
    with pytest.raises(ValueError, match="unknown stages"):
        run_batch(spark, {}, silver, gold, stages=("fetch",))


def test_report_over_missing_tables(spark, tmp_path):
    report = run_batch(spark, {}, str(tmp_path / "no"), str(tmp_path / "none"), stages=("validate",))
    assert set(report) == {"profile", "overall"}
    assert report["overall"].first()["ok"] is False
    assert {r["status"] for r in report["profile"].collect()} == {"MISSING"}


def test_a_failing_stage_ends_the_batch(spark, bronze, tmp_path):
    bronze["proc"] = str(tmp_path / "nowhere.txt.gz")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_batch(spark, bronze, str(tmp_path / "s"), str(tmp_path / "g"))
    assert not (tmp_path / "g").exists()


def test_silver_jobs(spark, bronze, tmp_path):
    flows = build_silver_log(spark, "flows", bronze["flows"], str(tmp_path / "s"), partitions=4)
    assert flows.schema == schemas.FLOWS and flows.count() == 6
    assert flows.where("packets_count IS NULL").count() == 1
    iocs = build_silver_iocs(spark, bronze["iocs"], str(tmp_path / "s"), newest=2)
    assert iocs.count() == 2


def test_bzip2_is_split_and_gzip_is_not(spark, tmp_path):
    from emberlog.sources import read_auth

    spark.range(400_000).select(
        F.concat_ws(",", "id", F.md5(F.col("id").cast("string")), F.lit("C1"))
    ).coalesce(1).write.text(str(tmp_path / "b"), compression="bzip2")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(2**20))
    try:
        scan = read_auth(spark, str(tmp_path / "b"))
        assert scan.rdd.getNumPartitions() > 2
        assert scan.count() == 400_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_shared_path_follows_the_session(spark):
    assert shared_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/emberlog-x-")
    assert shared_path(spark, "x") != shared_path(spark, "x")


# Plans.


@pytest.fixture
def silver(spark, tmp_path):
    for name, view in {"flows": views.flows, "auth": views.auth, "proc": views.proc, "iocs": views.iocs}.items():
        (write_iocs if name == "iocs" else write_silver)(view(spark, TABLES), f"{tmp_path}/{name}")
    return [read_silver(spark, str(tmp_path), n) for n in ("flows", "auth", "proc", "iocs")]


def test_summary_plan_with_large_logs(spark, silver):
    """Flows, each log and the joined seconds are shuffled once; only the feed is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(user_activity_summary(*silver))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastExchange") == 1
    assert plan.count("Exchange hashpartitioning(time") == 3
    assert plan.count("Exchange hashpartitioning(host") == 1
    assert plan.count("Exchange hashpartitioning(src_computer") == 1
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 5
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    read = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    assert "time:int,src_computer:string,dst_computer:string,packets_count:int,bytes_count:int" in read
    assert "time:int,computer:string,process_name:string" in read
    assert "url:string,threat:string" in read


def test_large_feed_is_not_broadcast(spark, silver):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(user_activity_summary(*silver, broadcast_limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastExchange" not in plan
