"""Silver that takes in only what is new, and gold that rebuilds only the hours concerned.

A log lands in loads: one folder for the files of one run, below `root/landed/<log>`. The
manifest, an append-only table, says which files (path, length, time of change, rule version)
each load holds and which loads no longer count. A run reads the files that no load in force
has. If a file of a load has changed or gone, the whole load is dropped and its other files
are read again with the new ones, so rows need no mark of the file they came from.

The manifest row of a run is written last, by one task, so a run takes effect at once or not
at all; what an interrupted run left is never read. One run at a time.

Gold remembers the loads and the feed it was built from. Rows of loads that came or went, and
flows to hosts whose threat changed, name the hours to rebuild; other folders aren't touched.
"""

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.functions import time_bucket
from emberlog.functions.columns import BUCKET_SECONDS
from emberlog.operators.gate import Limits, write_checked
from emberlog.operators.lookups import ioc_lookup
from emberlog.operators.skew import BROADCAST_LIMIT_BYTES, fits_broadcast
from emberlog.operators.summary import user_activity_summary
from emberlog.plans.gold import GOLD_NAME
from emberlog.plans.silver import build_silver_iocs
from emberlog.plans.together import run_together
from emberlog.session import shared_path
from emberlog.sinks import write_gold
from emberlog.sources import read_flagged_log, read_gold, read_silver
from emberlog.sources.files import delete_folder, delete_folders, list_files, read_if_there

#: Raise it when raw lines are to be read differently; every file is then taken in anew.
RULES = "1"
MANIFEST = "run long, landed string, op string, path string, length long, modified long, rules string"
BUILT_FROM = "run long, source string, landed string, op string"
FEED = "host string, threat string"
GOLD_LOGS = ("flows", "auth", "proc")
NO_BUCKET = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of a null partition


@dataclass(frozen=True)
class Landing:
    """What a run changed: the files it read, the load it made of them, the loads it dropped."""

    files: list[str]
    landed: str | None
    dropped: list[str]
    counts: dict[str, int] | None


def _manifest(root: str, name: str) -> str:
    return f"{root}/manifest/{name}"


def _load(root: str, name: str, landed: str) -> str:
    return f"{root}/landed/{name}/{landed}"


def _in_force(log: DataFrame, keys: list[str]) -> DataFrame:
    """Added rows of an append-only list whose `keys` have not been dropped."""
    dropped = log.where("op = 'drop'").select(*keys)
    return log.where("op = 'add'").join(dropped, keys, "left_anti")


def landed_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(landed, path, length, modified, rules) of all files that the log now consists of."""
    listed = read_if_there(spark, _manifest(root, name), MANIFEST)
    return _in_force(listed, ["landed"]).select("landed", "path", "length", "modified", "rules")


def _loads(spark: SparkSession, root: str, name: str) -> list[str]:
    """One name per run that is in force."""
    return sorted(r["landed"] for r in landed_files(spark, root, name).select("landed").distinct().collect())


def _read_loads(spark: SparkSession, root: str, name: str, loads: list[str]) -> DataFrame:
    schema = schemas.LOGS[name]
    if not loads:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_load(root, name, landed) for landed in loads])


def read_landed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The log as all loads in force together hold it."""
    return _read_loads(spark, root, name, _loads(spark, root, name))


def land_log(
    spark: SparkSession,
    name: str,
    source: str | list[str],
    root: str,
    partitions: int = 0,
    limits: Limits = Limits(),
    rules: str = RULES,
) -> Landing:
    """Take the files of `source` that are new or have changed into the silver log `name`.

    Files that are gone from `source` leave the log. A load that breaches `limits` ends the job
    before the manifest is written: the log stays as it was.
    """
    have = list_files(spark, source)
    known = landed_files(spark, root, name)
    same = ["path", "length", "modified"]
    unchanged = known.where(F.col("rules") == rules).join(have, same, "left_semi")
    stale = known.join(unchanged, ["landed", "path"], "left_anti").select("landed").distinct()
    in_force = known.join(stale, "landed", "left_anti")
    todo = have.join(in_force, "path", "left_anti").orderBy("path").collect()
    dropped = sorted(r["landed"] for r in stale.collect())
    if not todo and not dropped:
        return Landing([], None, [], None)

    last = read_if_there(spark, _manifest(root, name), MANIFEST).agg(F.max("run")).first()[0]
    run = (last or 0) + 1
    files = [r["path"] for r in todo]
    landed, counts = None, None
    if files:
        # The same work has the same name: what an interrupted run left is overwritten.
        digest = hashlib.md5(repr([(*r, rules) for r in todo]).encode()).hexdigest()
        landed = f"{run:06d}-{digest}"
        rows = read_flagged_log(spark, files, schemas.LOGS[name])
        counts = write_checked(rows, _load(root, name, landed), limits, partitions)
    entries = [(run, landed, "add", *r, rules) for r in todo]
    entries += [(run, gone, "drop", None, None, None, None) for gone in dropped]
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(_manifest(root, name))
    return Landing(files, landed, dropped, counts)


def land_logs(
    spark: SparkSession,
    sources: dict[str, str | list[str]],
    root: str,
    partitions: int = 0,
    limits: dict[str, Limits] | None = None,
) -> dict[str, Landing]:
    """All logs at the same time."""
    jobs = {
        name: lambda name=name, source=source: land_log(
            spark, name, source, root, partitions, (limits or {}).get(name, Limits())
        )
        for name, source in sources.items()
    }
    return run_together(spark, jobs)


def _buckets(rows: DataFrame) -> DataFrame:
    return rows.select(time_bucket(F.col("time")).alias("time_bucket"))


def _of_hours(rows: DataFrame, hours: DataFrame, bounds: tuple[int | None, int | None, bool], small: bool) -> DataFrame:
    """The rows whose hour is listed. The range of the hours reaches the scan."""
    low, high, with_null = bounds
    inside = F.lit(False)
    if low is not None:  # a bucket holds the seconds up to a whole bucket away, towards zero
        inside = (F.col("time") > low - BUCKET_SECONDS) & (F.col("time") < high + BUCKET_SECONDS)
    if with_null:
        inside = inside | F.col("time").isNull()
    hours = F.broadcast(hours) if small else hours
    match = time_bucket(F.col("time")).eqNullSafe(hours["time_bucket"])
    return rows.where(inside).join(hours, match, "left_semi")


def _changed_hosts(spark: SparkSession, before: DataFrame, after: DataFrame) -> DataFrame:
    """Hosts that are a hit now and weren't, or the other way round. The threat's name doesn't count."""
    old = before.where("threat is not null").select("host")
    new = after.where("threat is not null").select("host")
    return old.join(new, "host", "left_anti").unionByName(new.join(old, "host", "left_anti"))


def update_gold(spark: SparkSession, root: str, gold_root: str) -> DataFrame:
    """Bring the stored summary up to date with the landed logs and the feed `root/iocs`.

    Returns the hours rebuilt (time_bucket). An hour that lost its last flow loses its folder.
    What gold was built from is written last: an interrupted update is simply done again.
    """
    state, path = f"{gold_root}/built_from", f"{gold_root}/{GOLD_NAME}"
    built = _in_force(read_if_there(spark, state, BUILT_FROM), ["source", "landed"])
    before: dict[str, set[str]] = {source: set() for source in (*GOLD_LOGS, "iocs")}
    for row in built.select("source", "landed").collect():  # one row per run in force
        before[row["source"]].add(row["landed"])
    last = read_if_there(spark, state, BUILT_FROM).agg(F.max("run")).first()[0]
    run = (last or 0) + 1

    entries, changed = [], []
    for name in GOLD_LOGS:
        now = set(_loads(spark, root, name))
        came, went = sorted(now - before[name]), sorted(before[name] - now)
        entries += [(run, name, x, "add") for x in came] + [(run, name, x, "drop") for x in went]
        if came or went:
            changed.append(_buckets(_read_loads(spark, root, name, came + went)))

    iocs = read_silver(spark, root, "iocs")
    feed_place = f"{gold_root}/feeds"
    old_feeds = [f"{feed_place}/{x}" for x in before["iocs"]]
    old_feed = spark.read.schema(FEED).parquet(*old_feeds) if old_feeds else spark.createDataFrame([], FEED)
    new_feed = shared_path(spark, "feed")
    ioc_lookup(iocs).write.parquet(new_feed)
    hosts = _changed_hosts(spark, old_feed, spark.read.schema(FEED).parquet(new_feed))
    if not hosts.isEmpty():
        flows = read_landed(spark, root, "flows")
        some = F.broadcast(hosts) if fits_broadcast(hosts) else hosts
        changed.append(_buckets(flows.join(some, flows["dst_computer"] == some["host"], "left_semi")))
        landed = f"{run:06d}"
        spark.read.schema(FEED).parquet(new_feed).write.mode("overwrite").parquet(f"{feed_place}/{landed}")
        entries += [(run, "iocs", landed, "add")] + [(run, "iocs", x, "drop") for x in sorted(before["iocs"])]

    if not entries:
        return spark.createDataFrame([], "time_bucket long")
    stored = shared_path(spark, "hours")
    reduce(DataFrame.unionByName, changed).distinct().write.parquet(stored)
    hours = spark.read.schema("time_bucket long").parquet(stored)
    facts = hours.agg(F.count("*"), F.min("time_bucket"), F.max("time_bucket"), F.count_if(F.isnull("time_bucket"))).first()
    if facts[0]:
        bounds, small = (facts[1], facts[2], facts[3] > 0), facts[0] * 16 <= BROADCAST_LIMIT_BYTES
        flows, auth, proc = (_of_hours(read_landed(spark, root, name), hours, bounds, small) for name in GOLD_LOGS)
        write_gold(user_activity_summary(flows, auth, proc, iocs), path, only_these_hours=True)
        left = _buckets(flows).distinct()
        empty = hours.join(left, hours["time_bucket"].eqNullSafe(left["time_bucket"]), "left_anti").collect()
        gone = (NO_BUCKET if row["time_bucket"] is None else row["time_bucket"] for row in empty)
        delete_folders(spark, path, [f"time_bucket={folder}" for folder in gone])
    spark.createDataFrame(entries, BUILT_FROM).coalesce(1).write.mode("append").parquet(state)
    return hours


def vacuum(spark: SparkSession, root: str, gold_root: str) -> list[str]:
    """Delete the loads that neither silver counts nor gold was built from; return their folders."""
    state = read_if_there(spark, f"{gold_root}/built_from", BUILT_FROM)
    built = {tuple(r) for r in _in_force(state, ["source", "landed"]).select("source", "landed").collect()}
    gone = []
    for name in schemas.LOGS:
        dropped = read_if_there(spark, _manifest(root, name), MANIFEST).where("op = 'drop'").select("landed").distinct()
        for row in dropped.collect():
            if (name, row["landed"]) not in built and delete_folder(spark, _load(root, name, row["landed"])):
                gone.append(_load(root, name, row["landed"]))
    return gone


def run_incremental(
    spark: SparkSession,
    sources: dict[str, str | list[str]],
    silver_root: str,
    gold_root: str,
    partitions: int = 0,
    limits: dict[str, Limits] | None = None,
) -> tuple[dict[str, Landing], DataFrame, DataFrame]:
    """Feed, new files of all logs, and the hours they concern: (landings, hours rebuilt, gold)."""
    if "iocs" in sources:
        build_silver_iocs(spark, sources["iocs"], silver_root)
    logs = {name: sources[name] for name in schemas.LOGS if name in sources}
    landings = land_logs(spark, logs, silver_root, partitions, limits)
    hours = update_gold(spark, silver_root, gold_root)
    return landings, hours, read_gold(spark, f"{gold_root}/{GOLD_NAME}")
