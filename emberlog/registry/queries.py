"""Every operator as a query over the given tables. `path` is the folder of the tables.

Queries about files first write what they read: under the shared folder, in a
fresh place for each call.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.functions import numeric_columns, time_bucket, url_host
from emberlog.operators import quality, sampling, statistics
from emberlog.operators.enrich import enrich_flows, with_process, with_threat, with_user
from emberlog.operators.gate import Limits
from emberlog.operators.lookups import auth_lookup, ioc_lookup, proc_lookup
from emberlog.operators.summary import summarise, user_activity_summary
from emberlog.plans.batch import run_batch
from emberlog.plans.gold import GOLD_NAME, build_gold
from emberlog.plans.incremental import land_logs, read_landed, update_gold
from emberlog.plans.reland import reland
from emberlog.plans.report import validation_report
from emberlog.plans.samples import write_samples
from emberlog.plans.silver import build_checked_logs, build_silver_iocs, build_silver_logs
from emberlog.plans.stream import read_flow_stream, run_gold_stream, store_lookups, summary_with
from emberlog.plans.together import run_together
from emberlog.registry import telemetry_views as views
from emberlog.session import shared_path
from emberlog.sinks import write_gold, write_iocs, write_sample, write_silver
from emberlog.sinks.keyed import read_silver_by_second, write_silver_by_second
from emberlog.sources import (
    normalise_dns,
    read_auth,
    read_dns,
    read_flows,
    read_gold,
    read_lines,
    read_proc,
    read_silver,
    read_threat_feed,
    split_malformed,
)
from emberlog.sources.feed import recent_iocs
from emberlog.sources.files import make_folder

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_ROWS = 1000
DEFAULT_SAMPLE = sampling.DEFAULT_SAMPLE
RANGE_START, RANGE_END = 86400, 5 * 86400
FEED_LIMIT_BYTES = 256 << 10

LOG_VIEWS = {"auth": views.auth, "dns": views.dns, "flows": views.flows, "proc": views.proc}
LOG_CODECS = {"auth": "bzip2", "dns": "gzip", "flows": "gzip", "proc": "gzip"}


# Raw files made from the tables. A gzip file is read by one task, so rows are spread over files of equal size.


def _bronze(spark: SparkSession, path: str, name: str) -> str:
    target = shared_path(spark, f"bronze-{name}")
    LOG_VIEWS[name](spark, path, spread=True).write.csv(target, header=False, compression=LOG_CODECS[name])
    return target


def _bronze_logs(spark: SparkSession, path: str) -> dict[str, str]:
    return run_together(spark, {name: lambda name=name: _bronze(spark, path, name) for name in LOG_VIEWS})


def _is_late(time: Column) -> Column:
    return F.coalesce(time >= RANGE_END, F.lit(False))


MOVED_SECONDS = 10_000 * 3600


def _bronze_parts(spark: SparkSession, path: str, name: str) -> dict[str, str]:
    """Every row of a log in one of two places: what came `early`, and what came `late`. Flows that came
    late are in a third place too, `moved` to hours that nothing else is in. One pass writes all."""
    target = shared_path(spark, f"parts-{name}")
    parts = ["late", "moved"] if name == "flows" else ["late"]
    of_row = F.when(_is_late(F.col("time")), F.array(*map(F.lit, parts))).otherwise(F.array(F.lit("early")))
    rows = LOG_VIEWS[name](spark, path, spread=True).withColumn("part", F.explode(of_row))
    time = F.when(F.col("part") == "moved", F.col("time") + MOVED_SECONDS).otherwise(F.col("time"))
    rows.withColumn("time", time).write.partitionBy("part").csv(target, header=False, compression=LOG_CODECS[name])
    places = {part: f"{target}/part={part}" for part in ("early", *parts)}
    for place in places.values():
        make_folder(spark, place)  # also of a part without rows
    return places


def _bronze_feed(spark: SparkSession, path: str) -> str:
    target = shared_path(spark, "bronze-feed")
    views.feed_documents(spark, path).write.partitionBy("part").json(target)
    return target


def _silver(spark: SparkSession, path: str) -> str:
    root = shared_path(spark, "silver")
    for name, view in LOG_VIEWS.items():
        write_silver(view(spark, path), f"{root}/{name}")
    write_iocs(views.iocs(spark, path), f"{root}/iocs")
    return root


def _gold(spark: SparkSession, path: str) -> DataFrame:
    return user_activity_summary(
        views.flows(spark, path),
        views.auth(spark, path),
        views.proc(spark, path),
        views.iocs(spark, path),
    )


def _gold_path(spark: SparkSession, path: str) -> str:
    target = shared_path(spark, "gold")
    write_gold(_gold(spark, path), target)
    return target


def _stored_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_gold(spark, _gold_path(spark, path))


# Scans.


def scan_auth(spark, path):
    return read_auth(spark, _bronze(spark, path, "auth"))


def scan_dns(spark, path):
    return read_dns(spark, _bronze(spark, path, "dns"))


def scan_flows(spark, path):
    return read_flows(spark, _bronze(spark, path, "flows"))


def scan_proc(spark, path):
    return read_proc(spark, _bronze(spark, path, "proc"))


def scan_threat_feed(spark, path):
    return read_threat_feed(spark, f"{_bronze_feed(spark, path)}/*")


def _stacked_logs(read: Callable[[str], DataFrame]) -> DataFrame:
    """(time, computer, log) of the four logs."""
    auth = read("auth").select("time", F.col("source_computer").alias("computer"))
    dns = read("dns").select("time", F.col("SourceComputer").alias("computer"))
    flows = read("flows").select("time", F.col("src_computer").alias("computer"))
    proc = read("proc").select("time", "computer")
    logs = {"auth": auth, "dns": dns, "flows": flows, "proc": proc}
    tagged = [df.withColumn("log", F.lit(name)) for name, df in logs.items()]
    stacked = tagged[0]
    for df in tagged[1:]:
        stacked = stacked.unionByName(df)
    return stacked


def scan_silver_parquet(spark, path):
    root = _silver(spark, path)
    stacked = _stacked_logs(lambda name: read_silver(spark, root, name))
    iocs = read_silver(spark, root, "iocs").select(
        F.lit(None).cast("int").alias("time"), F.col("host").alias("computer"), F.lit("iocs").alias("log")
    )
    return stacked.unionByName(iocs)


def scan_gold(spark, path):
    return _stored_gold(spark, path)


def gold_time_range(spark, path):
    return read_gold(spark, _gold_path(spark, path), RANGE_START, RANGE_END)


def scan_lines(spark, path):
    return read_lines(spark, _bronze(spark, path, "flows"))


def scan_relanded(spark, path):
    """The gzip flow log, landed once more in parts that can be split."""
    target = shared_path(spark, "relanded")
    reland(spark, _bronze(spark, path, "flows"), target, lines_per_file=10_000)
    return read_flows(spark, target)


def gold_of_user(spark, path):
    """The activity of one user, from gold that is stored to be searched by user and computer."""
    target = shared_path(spark, "gold")
    write_gold(_gold(spark, path), target, find_by=("user", "src_computer"))
    gold = read_gold(spark, target)
    return gold.where(F.col("user") == gold.agg(F.min("user")).first()[0])


# Sinks, shown by what they wrote.


def sink_silver(spark, path):
    root = shared_path(spark, "silver")
    write_silver(views.flows(spark, path), f"{root}/flows")
    return read_silver(spark, root, "flows")


def sink_repartition(spark, path):
    root = shared_path(spark, "silver")
    write_silver(views.auth(spark, path), f"{root}/auth", partitions=4)
    return read_silver(spark, root, "auth")


def sink_gold_partitioned(spark, path):
    """Gold rows with the bucket named by the directory each was read from."""
    gold = spark.read.schema(schemas.GOLD).parquet(_gold_path(spark, path))
    folder = F.regexp_extract("_metadata.file_path", r"time_bucket=(-?\d+)/", 1)
    return gold.select(*schemas.GOLD.fieldNames(), folder.cast("long").alias("folder_bucket"))


def sink_iocs(spark, path):
    root = shared_path(spark, "silver")
    write_iocs(views.iocs(spark, path), f"{root}/iocs")
    return read_silver(spark, root, "iocs")


def sink_sample_text(spark, path):
    target = shared_path(spark, "sample")
    sample = sampling.sample_n(_numbered_proc_lines(spark, path), SAMPLE_ROWS, "event_id")
    write_sample(sample.select("value"), target, compress=True)
    return read_lines(spark, target)


# Projections and filters.


def project_lookup(spark, path):
    return views.auth(spark, path).select("source_computer", "time", "source_user")


def project_qualified_star(spark, path):
    flows = views.numbered_flows(spark, path)
    return with_user(flows, views.auth(spark, path)).alias("f").select("f.*")


def query_url_host(spark, path):
    return views.table(spark, path, "pages").select("page_id", url_host(F.col("url")).alias("host"))


def query_hit_flag(spark, path):
    enriched = _enriched(spark, path)
    return enriched.select("event_id", "threat", "malicious_hit")


def query_time_bucket(spark, path):
    return views.numbered_flows(spark, path).select(
        "event_id", "time", time_bucket(F.col("time")).alias("time_bucket")
    )


def feed_defaults(spark, path):
    return scan_threat_feed(spark, path).select("url", "host", "threat", "date_added")


def feed_tags(spark, path):
    return scan_threat_feed(spark, path).select("url", "tags")


def select_numeric(spark, path):
    return numeric_columns(_gold(spark, path))


def dns_rename(spark, path):
    return normalise_dns(views.dns(spark, path))


def gold_hits_only(spark, path):
    return statistics.hits_only(_gold(spark, path))


def feed_status_gate(spark, path):
    """Small documents, every third with another status than ok."""
    target = shared_path(spark, "bronze-feed")
    status = F.when(F.col("part") % 3 == 2, "no_results").otherwise("ok")
    views.feed_documents(spark, path, entries=2, status=status).drop("part").write.json(target)
    return read_threat_feed(spark, target, on_bad="drop", one_per_line=True)


# Dedup and joins.


def dedup_auth(spark, path):
    return auth_lookup(views.auth(spark, path))


def dedup_proc(spark, path):
    return proc_lookup(views.proc(spark, path))


def dedup_iocs(spark, path):
    return ioc_lookup(views.iocs(spark, path))


def join_flows_auth(spark, path):
    return with_user(views.flows(spark, path), views.auth(spark, path))


def join_flows_proc(spark, path):
    return with_process(views.flows(spark, path), views.proc(spark, path))


def join_flows_iocs(spark, path):
    return with_threat(views.flows(spark, path), views.iocs(spark, path))


def _enriched(spark, path, **limits):
    return enrich_flows(
        views.numbered_flows(spark, path),
        views.auth(spark, path),
        views.proc(spark, path),
        views.iocs(spark, path),
        **limits,
    )


def enriched_flows(spark, path):
    return _enriched(spark, path)


def enriched_flows_heavy_keys(spark, path):
    """The threshold is set so low that some keys are heavy at any scale."""
    return _enriched(spark, path, heavy_rows=3)


def enriched_flows_large_feed(spark, path):
    """No feed is small enough to broadcast; popular hosts are dealt out."""
    return _enriched(spark, path, broadcast_limit=0, heavy_rows=3)


def enriched_flows_full_feed(spark, path):
    """A feed too large to broadcast, with a hundred hosts for each page that no flow goes to."""
    iocs, number = views.iocs(spark, path), F.explode(F.sequence(F.lit(1), F.lit(100)))
    unmet = iocs.select("*", number.alias("n")).withColumn("url", F.concat(F.lit("http://unmet-"), "n", F.lit("."), "host", F.lit("/")))
    feed = iocs.unionByName(unmet.drop("n"))
    return enrich_flows(
        views.numbered_flows(spark, path), views.auth(spark, path), views.proc(spark, path), feed, FEED_LIMIT_BYTES
    )


def gold_keyed_silver(spark, path):
    """Gold with users and processes from silver that is stored by second and computer."""
    root = _silver(spark, path)
    write_silver_by_second(spark, root)
    auth, proc = read_silver_by_second(spark, root)
    return user_activity_summary(read_silver(spark, root, "flows"), auth, proc, read_silver(spark, root, "iocs"))


# Aggregations.

GROUP = ["time_bucket", "user", "src_computer"]


def gold_group(spark, path):
    return summarise(_enriched(spark, path))


def agg_count(spark, path):
    return summarise(_enriched(spark, path)).select(*GROUP, "total_flows")


def agg_sum(spark, path):
    return summarise(_enriched(spark, path)).select(*GROUP, "total_bytes", "total_packets")


def agg_count_distinct(spark, path):
    return summarise(_enriched(spark, path)).select(*GROUP, "active_processes")


def agg_conditional_sum(spark, path):
    return summarise(_enriched(spark, path)).select(*GROUP, "malicious_hits")


def query_user_activity_summary(spark, path):
    return _gold(spark, path)


def row_count(spark, path):
    return statistics.row_count(views.flows(spark, path))


def distinct_entities(spark, path):
    return statistics.distinct_entities(_gold(spark, path))


def hit_row_count(spark, path):
    return statistics.hit_rows(_gold(spark, path))


def describe_gold(spark, path):
    """The summary is stored once, because describing it takes several passes."""
    stored = shared_path(spark, "gold-flat")
    _gold(spark, path).write.parquet(stored)
    gold = spark.read.schema(schemas.GOLD).parquet(stored)
    described = statistics.describe_numeric(gold.select(*schemas.GOLD_MEASURES))
    rounded = [F.round(c, 3).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return described.select("column", "count", *rounded)


# Previews and samples.


def preview(spark, path):
    return sampling.preview(views.numbered_flows(spark, path), 10, "time", "event_id")


def sample_first_n(spark, path):
    return sampling.take_first(views.numbered_flows(spark, path), DEFAULT_SAMPLE, "event_id")


def sample_random_n(spark, path):
    return sampling.sample_n(views.numbered_flows(spark, path), SAMPLE_ROWS, "event_id")


def feed_recent_n(spark, path):
    return recent_iocs(views.iocs(spark, path), 7)


def _numbered_proc_lines(spark, path):
    """The proc log as lines of raw text, with the event each comes from."""
    events = views.table(spark, path, "events").where(F.col("event_type") == "error")
    return events.select(
        "event_id",
        F.concat_ws(
            ",",
            F.col("event_id"),
            F.concat(F.lit("U"), F.col("user_id"), F.lit("@DOM1")),
            F.concat(F.lit("C"), F.col("user_id") % views.COMPUTERS),
            F.concat(F.lit("P"), F.col("event_id") % 20),
            F.when(F.col("event_id") % 2 == 0, "Start").otherwise("End"),
        ).alias("value"),
    )


def _log_lines(spark, path):
    """Every log as lines of raw text, with the event each line comes from."""

    def lines(events, *cells):
        return events.select("event_id", F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cells)).alias("value"))

    return {
        "auth": lines(views.numbered_auth(spark, path), *schemas.AUTH.fieldNames()),
        "dns": lines(views.numbered_dns(spark, path), *schemas.DNS.fieldNames()),
        "flows": lines(views.numbered_flows(spark, path), *schemas.FLOWS.fieldNames()),
        "proc": _numbered_proc_lines(spark, path),
    }


def job_samples(spark, path):
    """First and random lines of four logs of many files, in the order of the event ids; a fifth log is absent."""
    target, logs = shared_path(spark, "samples"), {}
    for name, lines in _log_lines(spark, path).items():
        logs[name] = shared_path(spark, f"bronze-{name}")
        lines.orderBy("event_id").select("value").write.text(logs[name], compression="gzip")
    logs["absent"] = f"{target}/absent"
    first = write_samples(spark, logs, f"{target}/first", SAMPLE_ROWS)
    drawn = write_samples(spark, logs, f"{target}/random", SAMPLE_ROWS, random=True, compress=True)
    parts = [
        read_lines(spark, place).select(F.lit(kind).alias("sample"), F.lit(name).alias("log"), "value")
        for kind, places in (("first", first), ("random", drawn))
        for name, place in places.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


# Set operations.


def concat_parts(spark, path):
    """Gold stored in two places, read as one table."""
    gold = _gold(spark, path)
    places = [shared_path(spark, "gold-part") for _ in range(2)]
    late = F.coalesce(F.col("time_bucket") >= RANGE_END, F.lit(False))
    write_gold(gold.where(~late), places[0])
    write_gold(gold.where(late), places[1])
    return read_gold(spark, places)


def _all_tables(spark, path):
    logs = {name: view(spark, path) for name, view in LOG_VIEWS.items()}
    return logs | {"iocs": views.iocs(spark, path)}


def ingest_totals(spark, path):
    return statistics.ingest_totals(_all_tables(spark, path))


# Data quality.


def dataset_profile(spark, path):
    """File counts and sizes differ from run to run; only their presence is shown."""
    root = _silver(spark, path)
    paths = {name: f"{root}/{name}" for name in (*LOG_VIEWS, "iocs")}
    paths |= {"gold": _gold_path(spark, path), "absent": f"{root}/absent"}
    return quality.profile(spark, paths).select(
        "dataset",
        "records",
        "status",
        (F.col("files") > 0).alias("has_files"),
        (F.col("size_mb") > 0).alias("has_bytes"),
    )


def null_rates(spark, path):
    return quality.null_rates(_gold(spark, path)).select(
        "column", F.round("null_rate", 6).alias("null_rate")
    )


def gold_sanity(spark, path):
    """Gold with a fault of each kind, by the computer a row is of."""
    computer = F.col("src_computer")
    faulty = _gold(spark, path).withColumns(
        {
            "total_flows": F.when(computer == "C1", F.lit(0)).otherwise(F.col("total_flows")),
            "total_packets": F.when(computer == "C2", F.col("total_bytes") + 1).otherwise(F.col("total_packets")),
            "time_bucket": F.when(computer == "C3", F.col("time_bucket") + 1).otherwise(F.col("time_bucket")),
            "malicious_hits": F.when(computer == "C4", F.lit(-1)).otherwise(F.col("malicious_hits")),
        }
    )
    return quality.check_gold(faulty)


def fanout_guard(spark, path):
    return quality.check_fanout(views.flows(spark, path), _enriched(spark, path))


def value_domain(spark, path):
    """The process log with one value that isn't allowed and one that is missing."""
    name = F.col("process_name")
    faulty = F.when(name == "P3", "Restart").when(name != "P4", F.col("start_end"))
    log = views.proc(spark, path).withColumn("start_end", faulty)
    return quality.value_domain(log, "start_end", ["Start", "End"])


def schema_check(spark, path):
    """A flow log with one column renamed and one of another type."""
    log = scan_flows(spark, path).withColumnRenamed("src_port", "source_port")
    return quality.check_schema(log.withColumn("bytes_count", F.col("bytes_count").cast("long")), schemas.FLOWS)


def _malformed_auth_log(spark, path):
    """An auth log in which clicks left bad times, purchases short lines and views long ones."""
    kind = F.col("event_type")
    cells = [
        F.when(kind == "click", F.concat(F.lit("x"), F.col("event_id"))).otherwise(
            F.col("event_id").cast("string")
        ),
        F.concat(F.lit("U"), F.col("user_id")),
        F.when(kind != "purchase", F.concat(F.lit("C"), F.col("user_id") % views.COMPUTERS)),
        F.when(kind == "view", F.lit("extra")),
    ]
    log = shared_path(spark, "bronze-auth")
    # concat_ws leaves out NULL cells.
    views.table(spark, path, "events").select(F.concat_ws(",", *cells)).write.text(
        log, compression="bzip2"
    )
    return log


def _malformed_auth(spark, path):
    return split_malformed(spark, _malformed_auth_log(spark, path), schemas.AUTH)


def query_split_malformed(spark, path):
    good, rejected = _malformed_auth(spark, path)
    good = good.withColumn("rejected_line", F.lit(None).cast("string"))
    return good.unionByName(rejected.withColumnRenamed("_rejected_line", "rejected_line"))


def split_malformed_counts(spark, path):
    """Both sides counted without reading whole rows."""
    good, rejected = _malformed_auth(spark, path)

    def counts(side, name):
        return side.select("source_user").agg(
            F.count("*").alias(name), F.count_distinct("source_user").alias(f"{name}_users")
        )

    both = counts(good, "good").unionByName(counts(rejected, "rejected"), allowMissingColumns=True)
    return both.agg(*(F.max(c).alias(c) for c in ("good", "rejected", "good_users", "rejected_users")))


def partition_rows(spark, path):
    """What holds however the scan is cut."""
    parts = quality.partition_rows(scan_auth(spark, path))
    return parts.agg(
        F.sum("records").alias("records"),
        (F.count("*") > 0).alias("some_partition"),
        (F.count("*") == F.count_distinct("partition")).alias("no_partition_twice"),
    )


def reduction_pct(spark, path):
    raw = statistics.ingest_totals(_all_tables(spark, path)).where(F.col("dataset") == "TOTAL")
    return statistics.reduction_pct(raw, _gold(spark, path)).withColumn(
        "reduction_pct", F.round("reduction_pct", 6)
    )


# Composite jobs.


def job_silver(spark, path):
    report, _ = build_silver_logs(spark, _bronze_logs(spark, path), shared_path(spark, "silver"), partitions=8)
    return report


def job_silver_checked(spark, path):
    """What the silver writes counted, with an auth log that has malformed lines."""
    sources = _bronze_logs(spark, path) | {"auth": _malformed_auth_log(spark, path)}
    limits = {"auth": Limits(malformed_rate=0.9), "flows": Limits(null_rates={"time": 0.0})}
    return build_checked_logs(spark, sources, shared_path(spark, "silver"), limits, partitions=8)


def _three_runs(spark, path):
    """Logs that land in three runs: early files, late files too, early files replaced by new ones of the same rows.
    Returns the silver folder and what each run landed."""
    root = shared_path(spark, "silver")
    parts = run_together(spark, {name: lambda name=name: _bronze_parts(spark, path, name) for name in LOG_VIEWS})
    again = run_together(spark, {name: lambda name=name: _bronze_parts(spark, path, name)["early"] for name in LOG_VIEWS})
    runs = [
        {name: [places["early"]] for name, places in parts.items()},
        {name: [places["early"], places["late"]] for name, places in parts.items()},
        {name: [again[name], places["late"]] for name, places in parts.items()},
    ]
    return root, [land_logs(spark, sources, root) for sources in runs]


def job_silver_incremental(spark, path):
    """The landed logs after all runs."""
    root, _ = _three_runs(spark, path)
    return _stacked_logs(lambda name: read_landed(spark, root, name))


def job_silver_runs(spark, path):
    """The records each run read, of each log."""
    root, runs = _three_runs(spark, path)
    rows = [(name, *((run[name].counts or {}).get("records", 0) for run in runs)) for name in LOG_VIEWS]
    read = spark.createDataFrame(rows, "log string, first_run long, second_run long, third_run long")
    landed = _stacked_logs(lambda name: read_landed(spark, root, name)).groupBy("log").agg(F.count("*").alias("records"))
    return read.join(landed, "log")


def gold_changed_hours(spark, path):
    """Gold after two incremental updates. Before the second a file of flows in hours that nothing else
    is in goes away, late files of all logs come in, and the feed gets the hosts that were missing."""
    silver_root, gold_root = shared_path(spark, "silver"), shared_path(spark, "gold")
    logs = ("auth", "flows", "proc")
    parts = run_together(spark, {name: lambda name=name: _bronze_parts(spark, path, name) for name in logs})
    iocs = views.iocs(spark, path)

    write_iocs(iocs.where("threat = 'phishing'"), f"{silver_root}/iocs")
    first = {name: [places["early"]] for name, places in parts.items()}
    land_logs(spark, first | {"flows": [parts["flows"]["early"], parts["flows"]["moved"]]}, silver_root)
    update_gold(spark, silver_root, gold_root)

    write_iocs(iocs, f"{silver_root}/iocs")
    land_logs(spark, {name: [places["early"], places["late"]] for name, places in parts.items()}, silver_root)
    update_gold(spark, silver_root, gold_root)
    return read_gold(spark, f"{gold_root}/{GOLD_NAME}")


def job_iocs(spark, path):
    root = shared_path(spark, "silver")
    return build_silver_iocs(spark, f"{_bronze_feed(spark, path)}/*", root)


def job_validation(spark, path):
    """The whole-table sections of the report as (section, item, value)."""
    silver_root, gold_root = _silver(spark, path), shared_path(spark, "gold")
    build_gold(spark, silver_root, gold_root)
    report = validation_report(spark, silver_root, gold_root)

    def rows(section, item, value):
        return report[section].select(
            F.lit(section).alias("section"), item.alias("item"), F.round(value.cast("double"), 3).alias("value")
        )

    parts = [
        rows("profile", F.col("dataset"), F.col("records")),
        rows("overall", F.lit("ok"), F.col("ok")),
        rows("ingest_totals", F.col("dataset"), F.col("records")),
        rows("auth_null_rates", F.col("column"), F.col("null_rate")),
        rows("gold_hit_rows", F.lit("hit_rows"), F.col("hit_rows")),
        rows("gold_entities", F.lit("users"), F.col("users")),
        rows("gold_entities", F.lit("computers"), F.col("computers")),
        rows("gold_checks", F.col("rule"), F.col("violations")),
        rows("reduction", F.lit("reduction_pct"), F.col("reduction_pct")),
    ]
    parts += [
        rows("gold_statistics", F.concat("column", F.lit(f" {c}")), F.col(c))
        for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def gold_stream(spark, path):
    """Gold by the stream: flow files in two runs, then a flow far in the future that closes all hours."""
    landed, gold, state = (shared_path(spark, f"stream-{x}") for x in ("flows", "gold", "state"))
    early = ~_is_late(F.col("time"))
    closing = spark.createDataFrame([(2_000_000_000, *[None] * 8)], schemas.FLOWS)
    logs = (view(spark, path, spread=True) for view in (views.auth, views.proc))
    lookups = store_lookups(*logs, views.iocs(spark, path))

    def run():
        flows = read_flow_stream(spark, landed)
        run_gold_stream(summary_with(flows, lookups, delay="400 days"), gold, state)

    flows = views.flows(spark, path, spread=True)
    for part in (flows.where(early), flows.where(~early), closing):
        part.write.mode("append").csv(landed, header=False, compression="gzip")
        run()
    return spark.read.schema(schemas.GOLD).parquet(gold)


def job_full_batch(spark, path):
    """Raw files of every source through all stages; the stored summary comes back."""
    sources = {name: _bronze(spark, path, name) for name in LOG_VIEWS}
    sources["iocs"] = f"{_bronze_feed(spark, path)}/*"
    silver_root, gold_root = shared_path(spark, "silver"), shared_path(spark, "gold")
    run_batch(spark, sources, silver_root, gold_root)
    return read_gold(spark, f"{gold_root}/user_activity_summary")


QUERIES: dict[str, Query] = {
    "user_activity_summary": query_user_activity_summary,
    "enriched_flows": enriched_flows,
    "enriched_flows_heavy_keys": enriched_flows_heavy_keys,
    "enriched_flows_large_feed": enriched_flows_large_feed,
    "enriched_flows_full_feed": enriched_flows_full_feed,
    "gold_keyed_silver": gold_keyed_silver,
    "gold_of_user": gold_of_user,
    "scan_relanded": scan_relanded,
    "scan_auth": scan_auth,
    "scan_dns": scan_dns,
    "scan_flows": scan_flows,
    "scan_proc": scan_proc,
    "scan_threat_feed": scan_threat_feed,
    "scan_silver_parquet": scan_silver_parquet,
    "scan_gold": scan_gold,
    "gold_time_range": gold_time_range,
    "scan_lines": scan_lines,
    "sink_silver": sink_silver,
    "sink_repartition": sink_repartition,
    "sink_gold_partitioned": sink_gold_partitioned,
    "sink_iocs": sink_iocs,
    "sink_sample_text": sink_sample_text,
    "project_lookup": project_lookup,
    "project_qualified_star": project_qualified_star,
    "url_host": query_url_host,
    "hit_flag": query_hit_flag,
    "time_bucket": query_time_bucket,
    "feed_defaults": feed_defaults,
    "feed_tags": feed_tags,
    "select_numeric": select_numeric,
    "dns_rename": dns_rename,
    "gold_hits_only": gold_hits_only,
    "feed_status_gate": feed_status_gate,
    "dedup_auth": dedup_auth,
    "dedup_proc": dedup_proc,
    "dedup_iocs": dedup_iocs,
    "join_flows_auth": join_flows_auth,
    "join_flows_proc": join_flows_proc,
    "join_flows_iocs": join_flows_iocs,
    "gold_group": gold_group,
    "agg_count": agg_count,
    "agg_sum": agg_sum,
    "agg_count_distinct": agg_count_distinct,
    "agg_conditional_sum": agg_conditional_sum,
    "row_count": row_count,
    "distinct_entities": distinct_entities,
    "hit_row_count": hit_row_count,
    "describe_gold": describe_gold,
    "preview": preview,
    "sample_first_n": sample_first_n,
    "sample_random_n": sample_random_n,
    "feed_recent_n": feed_recent_n,
    "concat_parts": concat_parts,
    "ingest_totals": ingest_totals,
    "dataset_profile": dataset_profile,
    "null_rates": null_rates,
    "gold_sanity": gold_sanity,
    "fanout_guard": fanout_guard,
    "value_domain": value_domain,
    "schema_check": schema_check,
    "split_malformed": query_split_malformed,
    "split_malformed_counts": split_malformed_counts,
    "partition_rows": partition_rows,
    "reduction_pct": reduction_pct,
    "job_silver": job_silver,
    "job_silver_checked": job_silver_checked,
    "job_silver_incremental": job_silver_incremental,
    "job_silver_runs": job_silver_runs,
    "gold_changed_hours": gold_changed_hours,
    "job_iocs": job_iocs,
    "job_validation": job_validation,
    "job_samples": job_samples,
    "gold_stream": gold_stream,
    "job_full_batch": job_full_batch,
}
