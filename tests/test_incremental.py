"""Landing only what is new, checks inside the write, jobs at the same time, gold of changed hours, leading lines."""

import bz2
import gzip
import os
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.operators.gate import Limits, LimitsBreached, write_checked
from emberlog.operators.leading import leading_lines
from emberlog.operators.summary import user_activity_summary
from emberlog.plans import incremental
from emberlog.plans.incremental import land_log, land_logs, landed_files, read_landed, run_incremental, update_gold, vacuum
from emberlog.plans.samples import write_samples
from emberlog.plans.silver import build_checked_log, build_checked_logs, build_silver_log, build_silver_logs
from emberlog.plans.together import run_together
from emberlog.sinks import write_iocs
from emberlog.sources import read_gold, read_lines, read_silver
from emberlog.sources.files import list_files


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("".join(f"{line}\n" for line in lines))


def auth_lines(first, n):
    return [f"{first + i},U{i % 7},C{i % 3}" for i in range(n)]


@pytest.fixture
def raw(tmp_path):
    write_lines(tmp_path / "raw" / "a.gz", auth_lines(0, 20))
    write_lines(tmp_path / "raw" / "b.gz", auth_lines(100, 30))
    return tmp_path / "raw"


def same_rows(rows_of, landed, *whole):
    assert rows_of(landed) == sorted(
        (row for df in whole for row in rows_of(df)), key=lambda row: [(v is not None, str(v)) for v in row]
    )


# Landing.


def test_listing_opens_no_file(spark, raw):
    os.chmod(raw / "a.gz", 0)
    try:
        got = {os.path.basename(r["path"]): (r["length"], r["modified"]) for r in list_files(spark, str(raw)).collect()}
    finally:
        os.chmod(raw / "a.gz", 0o644)
    want = {p.name: (p.stat().st_size, p.stat().st_mtime_ns // 1_000_000 * 1000) for p in raw.iterdir()}
    assert {k: (v[0], v[1] // 1000 * 1000) for k, v in got.items()} == want


def test_a_second_run_reads_the_new_file_only(spark, raw, tmp_path, rows_of, monkeypatch):
    root = str(tmp_path / "silver")
    first = land_log(spark, "auth", str(raw), root)
    assert sorted(map(os.path.basename, first.files)) == ["a.gz", "b.gz"] and first.counts["records"] == 50
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "silver").rglob("*.parquet") if "landed" in str(p)}

    write_lines(raw / "c.gz", auth_lines(500, 5))
    scans = []
    read = incremental.read_flagged_log
    monkeypatch.setattr(incremental, "read_flagged_log", lambda *a: scans.append(read(*a)) or scans[-1])
    second = land_log(spark, "auth", str(raw), root)
    assert [os.path.basename(f) for f in second.files] == ["c.gz"] and second.dropped == []
    assert [list(map(os.path.basename, s.inputFiles())) for s in scans] == [["c.gz"]]
    assert second.counts["records"] == 5
    # Nothing that was there is written again, and the table equals a full run.
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    full = build_silver_log(spark, "auth", str(raw), str(tmp_path / "full"))
    same_rows(rows_of, read_landed(spark, root, "auth"), full)
    third = land_log(spark, "auth", str(raw), root)
    assert (third.files, third.landed, third.dropped) == ([], None, []) and len(scans) == 1


def test_changed_and_gone_files(spark, raw, tmp_path, rows_of):
    root = str(tmp_path / "silver")
    land_log(spark, "auth", str(raw), root)
    write_lines(raw / "c.gz", auth_lines(500, 5))
    kept = land_log(spark, "auth", str(raw), root).landed

    write_lines(raw / "a.gz", auth_lines(0, 3))
    changed = land_log(spark, "auth", str(raw), root)
    # b.gz is in the load that the changed file was in; c.gz isn't.
    assert sorted(map(os.path.basename, changed.files)) == ["a.gz", "b.gz"] and len(changed.dropped) == 1
    same_rows(rows_of, read_landed(spark, root, "auth"), build_silver_log(spark, "auth", str(raw), str(tmp_path / "full")))

    (raw / "a.gz").unlink()
    (raw / "b.gz").unlink()
    gone = land_log(spark, "auth", str(raw), root)
    assert gone.files == [] and gone.dropped == [changed.landed]
    assert {r["landed"] for r in landed_files(spark, root, "auth").collect()} == {kept}
    same_rows(rows_of, read_landed(spark, root, "auth"), build_silver_log(spark, "auth", str(raw), str(tmp_path / "full")))

    # A file that comes back as it was is new again.
    write_lines(raw / "a.gz", auth_lines(0, 3))
    assert len(land_log(spark, "auth", str(raw), root).files) == 1


def test_new_rules_read_everything_anew(spark, raw, tmp_path, rows_of):
    root = str(tmp_path / "silver")
    land_log(spark, "auth", str(raw), root)
    again = land_log(spark, "auth", str(raw), root, rules="2")
    assert len(again.files) == 2 and len(again.dropped) == 1
    assert read_landed(spark, root, "auth").count() == 50


def test_an_interrupted_run_takes_no_effect(spark, raw, tmp_path, rows_of, monkeypatch):
    root = str(tmp_path / "silver")
    land_log(spark, "auth", str(raw), root)
    write_lines(raw / "c.gz", auth_lines(500, 5))
    write = incremental.write_checked

    def dies(*args):
        write(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "write_checked", dies)
    with pytest.raises(RuntimeError, match="lost"):
        land_log(spark, "auth", str(raw), root)
    assert read_landed(spark, root, "auth").count() == 50
    monkeypatch.setattr(incremental, "write_checked", write)
    land_log(spark, "auth", str(raw), root)
    assert read_landed(spark, root, "auth").count() == 55


def test_a_breach_lands_nothing(spark, raw, tmp_path):
    root = str(tmp_path / "silver")
    land_log(spark, "auth", str(raw), root)
    write_lines(raw / "c.gz", ["x,U1,C1", "2,U2,C2"])
    with pytest.raises(LimitsBreached, match="malformed"):
        land_log(spark, "auth", str(raw), root, limits=Limits(malformed_rate=0.1))
    assert read_landed(spark, root, "auth").count() == 50
    assert land_log(spark, "auth", str(raw), root, limits=Limits(malformed_rate=0.5)).counts["malformed"] == 1


def test_nothing_landed_yet(spark, tmp_path):
    empty = read_landed(spark, str(tmp_path), "flows")
    assert empty.schema == schemas.FLOWS and empty.isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        land_log(spark, "auth", str(tmp_path / "nowhere"), str(tmp_path))


# Checks inside the write.


def job_count(spark, work):
    """How many jobs `work` runs."""
    context = spark.sparkContext
    group = uuid.uuid4().hex
    context.setJobGroup(group, group)
    try:
        work()
        return len(context.statusTracker().getJobIdsForGroup(group))
    finally:
        context._jsc.clearJobGroup()


def test_the_write_itself_counts(spark, tmp_path):
    write_lines(tmp_path / "auth.gz", ["1,U1,C1", "x,U2,C2", "3,,C3", "4,U4", "5,U5,C5,more", ""])
    counts = {}
    jobs = job_count(spark, lambda: counts.update(build_checked_log(spark, "auth", str(tmp_path / "auth.gz"), str(tmp_path / "s"))))
    assert counts == {"records": 5, "malformed": 3, "nulls_time": 1, "nulls_source_user": 1, "nulls_source_computer": 1}
    assert jobs == 1
    assert read_silver(spark, str(tmp_path / "s"), "auth").count() == 5
    assert read_silver(spark, str(tmp_path / "s"), "auth").schema == schemas.AUTH
    assert not [p for p in (tmp_path / "s").iterdir() if p.name.startswith("_staged")]


@pytest.mark.parametrize(
    "limits, what",
    [
        (Limits(null_rates={"source_user": 0.1}), "nulls in source_user: 2 of 4"),
        (Limits(least_records=5), "4 records, at least 5"),
        (Limits(malformed_rate=0.2), "malformed lines: 1 of 4"),
    ],
)
def test_a_breach_leaves_the_old_table(spark, tmp_path, rows_of, limits, what):
    root = str(tmp_path / "s")
    write_lines(tmp_path / "old.gz", auth_lines(0, 9))
    write_lines(tmp_path / "new.gz", ["1,U1,C1", "2,,C2", "3,,C3", "4,U4,C4,more"])
    build_checked_log(spark, "auth", str(tmp_path / "old.gz"), root, limits)
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "auth").iterdir()}
    with pytest.raises(LimitsBreached, match=what) as caught:
        build_checked_log(spark, "auth", str(tmp_path / "new.gz"), root, limits, partitions=3)
    assert caught.value.counts["records"] == 4
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "auth").iterdir()} == old
    assert [p.name for p in (tmp_path / "s").iterdir()] == ["auth"]
    # At the limit is within it, and the new table takes the old one's place.
    fine = Limits(null_rates={"source_user": 0.5}, malformed_rate=0.25, least_records=4)
    build_checked_log(spark, "auth", str(tmp_path / "new.gz"), root, fine)
    assert read_silver(spark, root, "auth").count() == 4


def test_checked_write_of_odd_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, `b.c` string")
    assert write_checked(empty, str(tmp_path / "e")) == {"records": 0, "malformed": 0, "nulls_a": 0, "nulls_b.c": 0}
    assert spark.read.parquet(str(tmp_path / "e")).columns == ["a", "b.c"]
    with pytest.raises(ValueError, match="unknown columns"):
        write_checked(empty, str(tmp_path / "f"), Limits(null_rates={"z": 0.1}))


# At the same time.


def test_jobs_overlap_and_keep_their_results(spark):
    spans = {}

    def job(name):
        start = time.time()
        n = spark.range(0, 4, 1, 2).mapInArrow(lambda batches: (time.sleep(0.4) or b for b in batches), "id long").count()
        spans[name] = start, time.time()
        return name, n, spark.sparkContext.getLocalProperty("spark.scheduler.pool")

    results = run_together(spark, {x: lambda x=x: job(x) for x in "abcd"})
    assert results == {x: (x, 4, x) for x in "abcd"}
    assert max(s for s, _ in spans.values()) < min(e for _, e in spans.values())
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert run_together(spark, {}) == {}


def test_one_error_ends_all(spark):
    started = threading.Event()

    def fails():
        started.wait(20)
        raise KeyError("first")

    def lasts():
        started.set()
        spark.range(0, 8, 1, 8).mapInArrow(lambda batches: (time.sleep(60) or b for b in batches), "id long").count()

    begin = time.time()
    with pytest.raises(KeyError, match="first"):
        run_together(spark, {"fails": fails, "lasts": lasts})
    assert time.time() - begin < 30
    assert spark.range(5).count() == 5


def test_silver_logs_at_the_same_time(spark, tmp_path, monkeypatch):
    lines = {"auth": "1,U1,C1", "dns": "1,C1,C2", "flows": "1,0,C1,1,C2,2,6,3,4", "proc": "1,U,C1,P1,Start"}
    sources = {}
    for name, line in lines.items():
        write_lines(tmp_path / f"{name}.gz", [line] * 3)
        sources[name] = str(tmp_path / f"{name}.gz")
    meet = threading.Barrier(4, timeout=30)  # passes only if all four are under way
    from emberlog.plans import silver

    write = silver.write_silver
    monkeypatch.setattr(silver, "write_silver", lambda *a: meet.wait() is None or write(*a))
    report, previews = build_silver_logs(spark, sources, str(tmp_path / "s"))
    assert {r["log"]: r["records"] for r in report.collect()} == dict.fromkeys(lines, 3)
    assert {name: df.count() for name, df in previews.items()} == dict.fromkeys(lines, 3)
    checked = build_checked_logs(spark, sources, str(tmp_path / "c"), {"dns": Limits(least_records=3)})
    assert checked.count() == 3 + 3 + 9 + 5 and checked.agg(F.sum("nulls")).first()[0] == 0
    with pytest.raises(LimitsBreached):
        build_checked_logs(spark, sources, str(tmp_path / "d"), {"dns": Limits(least_records=4)})


# Gold of changed hours.

HOUR = 3600


class Telemetry:
    """Raw logs and a feed that change from run to run, and gold by the incremental jobs."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.silver, self.gold = str(folder / "silver"), str(folder / "gold")
        for name, line in {"auth": "0,U0,C0", "proc": "0,U0,C0,P0,Start", "flows": flow(0, "C0", "h0")}.items():
            self.file(name, "zero", [line])
        self.feed({"h0": "t"})

    def file(self, log, name, lines):
        write_lines(self.folder / "raw" / log / f"{name}.gz", lines)

    def feed(self, threats):
        rows = [(f"http://{h}/x", h, t, "", "") for h, t in threats.items()]
        write_iocs(self.spark.createDataFrame(rows, schemas.IOCS), f"{self.silver}/iocs")

    def run(self):
        logs = {name: str(self.folder / "raw" / name) for name in ("auth", "flows", "proc")}
        _, hours, gold = run_incremental(self.spark, logs, self.silver, self.gold)
        return sorted((r["time_bucket"] for r in hours.collect()), key=lambda h: (h is None, h)), gold

    def rebuilt(self):
        read = {name: read_landed(self.spark, self.silver, name) for name in ("flows", "auth", "proc")}
        return user_activity_summary(read["flows"], read["auth"], read["proc"], read_silver(self.spark, self.silver, "iocs"))

    def files(self):
        return {p: p.stat().st_mtime_ns for p in (self.folder / "gold").rglob("time_bucket=*/*.parquet")}


def flow(time, src, dst, size="10"):
    return f"{time},0,{src},1,{dst},2,6,1,{size}"


def test_only_touched_hours_are_written(spark, tmp_path, rows_of):
    t = Telemetry(spark, tmp_path)
    t.file("flows", "a", [flow(HOUR * h + 5, f"C{h % 3}", f"h{h}") for h in range(6)] + [flow("x", "C1", "h1")])
    hours, gold = t.run()
    assert hours == [0, HOUR, 2 * HOUR, 3 * HOUR, 4 * HOUR, 5 * HOUR, None]
    assert rows_of(gold) == rows_of(t.rebuilt())

    def change(expected):
        before = t.files()
        hours, gold = t.run()
        assert hours == expected
        assert rows_of(gold) == rows_of(t.rebuilt())
        after = t.files()
        names = {f"time_bucket={'__HIVE_DEFAULT_PARTITION__' if h is None else h}" for h in expected}
        untouched = {p: m for p, m in before.items() if p.parent.name not in names}
        assert {p: m for p, m in after.items() if p.parent.name not in names} == untouched
        return gold

    t.file("flows", "b", [flow(2 * HOUR + 9, "C2", "h9"), flow(9 * HOUR, "C1", "h1")])  # a late row and a new hour
    change([2 * HOUR, 9 * HOUR])
    t.file("auth", "a", [f"{HOUR + 5},U9,C1"])  # users of flows that were there before
    assert change([HOUR]).where("user = 'U9'").count() == 1
    t.file("proc", "a", [f"{3 * HOUR + 5},U,C0,P1,End", f"{77 * HOUR},U,C0,P1,End"])  # the second meets no flow
    change([3 * HOUR, 77 * HOUR])
    t.feed({"h0": "other", "h3": "t", "h4": None})  # h0 stays a hit, h4 is none
    assert change([3 * HOUR]).where("malicious_hits > 0").count() == 3
    t.feed({"h3": "t"})
    change([0])
    assert t.run()[0] == []
    t.file("flows", "b", [flow(2 * HOUR + 9, "C2", "h9")])  # hour 9 becomes empty
    gold = change([2 * HOUR, 9 * HOUR])
    assert not (tmp_path / "gold" / "user_activity_summary" / f"time_bucket={9 * HOUR}").exists()
    assert gold.where(F.col("time_bucket") == 9 * HOUR).isEmpty()
    t.file("flows", "a", [flow(4 * HOUR + 5, "C1", "h4")])
    change([0, HOUR, 2 * HOUR, 3 * HOUR, 4 * HOUR, 5 * HOUR, None])
    assert {p.name for p in (tmp_path / "gold" / "user_activity_summary").glob("time_bucket=*")} == {
        "time_bucket=0", f"time_bucket={2 * HOUR}", f"time_bucket={4 * HOUR}"
    }


def test_an_interrupted_update_is_done_again(spark, tmp_path, rows_of, monkeypatch):
    t = Telemetry(spark, tmp_path)
    t.run()
    t.file("flows", "a", [flow(2 * HOUR, "C1", "h1")])
    land_logs(spark, {"flows": str(tmp_path / "raw" / "flows")}, t.silver)
    write = incremental.write_gold

    def dies(*args, **options):
        write(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "write_gold", dies)
    with pytest.raises(RuntimeError, match="lost"):
        update_gold(spark, t.silver, t.gold)
    monkeypatch.setattr(incremental, "write_gold", write)
    hours, gold = t.run()
    # The flows have been in one load with the first file since it was dropped with nothing changed in it.
    assert 2 * HOUR in hours
    assert rows_of(gold) == rows_of(t.rebuilt())


def test_emptied_hours_are_deleted_together(spark, tmp_path, rows_of, monkeypatch):
    t = Telemetry(spark, tmp_path)
    t.file("flows", "a", [flow(HOUR * h, "C1", "h1") for h in range(1, 40)] + [flow("x", "C1", "h1")])
    t.run()
    (tmp_path / "raw" / "flows" / "a.gz").unlink()
    deleted, delete = [], incremental.delete_folders
    monkeypatch.setattr(incremental, "delete_folders", lambda *args: (deleted.append(args[2]), delete(*args)))
    hours, gold = t.run()
    assert [len(names) for names in deleted] == [40] and len(hours) == 41
    assert {p.name for p in (tmp_path / "gold" / "user_activity_summary").glob("time_bucket=*")} == {"time_bucket=0"}
    assert rows_of(gold) == rows_of(t.rebuilt())
    delete(spark, t.gold, ["absent"])


def test_touched_hours_reach_the_scan(spark, tmp_path):
    t = Telemetry(spark, tmp_path)
    t.run()
    flows = read_landed(spark, t.silver, "flows")
    hours = spark.createDataFrame([(7200,), (10800,)], "time_bucket long")
    plan = incremental._of_hours(flows, hours, (7200, 10800, False), True)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(time,3600)" in plan and "LessThan(time,14400)" in plan
    assert "BroadcastHashJoin" in plan


def test_vacuum_spares_what_gold_was_built_from(spark, tmp_path):
    t = Telemetry(spark, tmp_path)
    t.run()
    t.file("flows", "zero", [flow(0, "C0", "h0", 20)])
    logs = {"flows": str(tmp_path / "raw" / "flows")}
    dropped = land_logs(spark, logs, t.silver)["flows"].dropped
    assert vacuum(spark, t.silver, t.gold) == []
    update_gold(spark, t.silver, t.gold)
    assert [p.rsplit("/", 1)[1] for p in vacuum(spark, t.silver, t.gold)] == dropped
    assert vacuum(spark, t.silver, t.gold) == []
    assert read_landed(spark, t.silver, "flows").first()["bytes_count"] == 20


# Leading lines.


def lines_of(df):
    return [(r["line_no"], r["value"]) for r in df.orderBy("line_no").collect()]


@pytest.mark.parametrize("n", [0, 1, 99, 100, 101, 4321, 10_000, 20_000])
def test_leading_lines_over_files(spark, tmp_path, monkeypatch, n):
    from emberlog.operators import leading

    monkeypatch.setattr(leading, "LEAST_BYTES", 500)
    monkeypatch.setattr(leading, "BYTES_PER_LINE", 1)
    lines, at = [], 0
    for k, size in enumerate([100, 0, 1, 3000, 899, 6000]):
        part = [f"{at + i} line" for i in range(size)]
        at += size
        lines += part
        text = "".join(f"{x}\n" for x in part)
        if k % 2:
            (tmp_path / f"part {k}.txt").write_text(text)
        else:
            with gzip.open(tmp_path / f"part {k}.gz", "wt") as out:
                out.write(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = lines_of(leading_lines(spark, str(tmp_path), n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == list(enumerate(lines[:n]))


def test_a_million_lines_take_few_jobs_and_leave_the_driver_alone(spark, tmp_path):
    """Jobs don't grow with the files, and the result isn't made of rows that the driver held."""

    def run(files, folder):
        spark.range(0, 1_000_000, 1, files).select(F.concat(F.lit("line "), "id")).write.text(folder)
        found = {}
        jobs = job_count(spark, lambda: found.update(df=leading_lines(spark, folder, 999_999)))
        return jobs, found["df"]

    few, _ = run(2, str(tmp_path / "few"))
    many, df = run(40, str(tmp_path / "many"))
    assert many <= few + 2 and many < 20
    assert df.agg(F.count("*"), F.max("line_no"), F.count_distinct("value")).first() == (999_999, 999_998, 999_999)
    assert "LocalTableScan" not in df._jdf.queryExecution().optimizedPlan().toString()


def scanned_rows(df):
    """Rows that the scan of a finished plan gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    while "FileSourceScan" not in (kind := plan.getClass().getSimpleName()):
        wrapped = {"AdaptiveSparkPlanExec": "executedPlan", "ShuffleQueryStageExec": "plan"}
        plan = getattr(plan, wrapped[kind])() if kind in wrapped else plan.children().apply(0)
    return plan.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("codec", ["gz", "bz2"])
def test_reading_stops_at_the_last_line_wanted(spark, tmp_path, monkeypatch, codec):
    """One large file: a task reads little more than the lines wanted, though the file has many splits or can't be split."""
    from emberlog.operators import leading

    lines = [f"{i} {i * 7919 % 1000003} {i * 104729 % 999983}" for i in range(600_000)]
    with (bz2.open if codec == "bz2" else gzip.open)(tmp_path / f"log.{codec}", "wt") as out:
        out.writelines(f"{x}\n" for x in lines)
    monkeypatch.setattr(leading, "LEAST_BYTES", 1 << 19)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        assert (read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 3) == (codec == "bz2")
        first = leading_lines(spark, str(tmp_path), 1000)
        assert lines_of(first) == list(enumerate(lines[:1000]))
        again = leading_lines(spark, str(tmp_path), 1000)
        assert len(again.collect()) == 1000 and scanned_rows(again) < 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_samples_of_first_lines(spark, tmp_path):
    write_lines(tmp_path / "in" / "a.gz", [f"l{i}" for i in range(50)])
    with pytest.warns(UserWarning, match="does not exist"):
        written = write_samples(spark, {"x": str(tmp_path / "in"), "no": str(tmp_path / "no")}, str(tmp_path / "out"), 20)
    assert set(written) == {"x"}
    assert [r["value"] for r in read_lines(spark, written["x"]).collect()] == [f"l{i}" for i in range(20)]


def test_gold_with_only_these_hours_needs_no_table_before(spark, tmp_path, rows_of):
    t = Telemetry(spark, tmp_path)
    _, gold = t.run()
    assert rows_of(read_gold(spark, f"{t.gold}/user_activity_summary")) == rows_of(gold)
