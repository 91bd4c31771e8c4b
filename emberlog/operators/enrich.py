"""Row-level enrichment of flows: every flow comes out exactly once."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions import hit_flag
from emberlog.operators.lookups import auth_lookup, ioc_hosts, ioc_lookup, proc_lookup
from emberlog.operators.skew import (
    BROADCAST_LIMIT_BYTES,
    HEAVY_ROWS,
    SPREAD,
    HeavyKeys,
    find_heavy_keys,
    fits_broadcast,
    left_join_broadcast,
    left_join_lookups,
    number_rows,
)
from emberlog.session import shared_path

SECOND_OF_COMPUTER = ["time", "src_computer"]
BY_HOST = {"dst_computer": "host"}


def users_by_second(auth: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    users = auth_lookup(auth).withColumnRenamed("source_user", "user")
    return users, {"time": "time", "src_computer": "source_computer"}


def processes_by_second(proc: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    return proc_lookup(proc), {"time": "time", "src_computer": "computer"}


def _join_dealt(flows: DataFrame, lookup: DataFrame, on: dict[str, str], heavy_rows: int):
    heavy = find_heavy_keys(flows, list(on), heavy_rows)
    if heavy:
        flows = number_rows(flows)
    return left_join_lookups(flows, [(lookup, on)], heavy).drop(SPREAD)


def with_user(flows: DataFrame, auth: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Flows plus `user`: who was on the source computer in the very same second."""
    return _join_dealt(flows, *users_by_second(auth), heavy_rows)


def with_process(flows: DataFrame, proc: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Flows plus `process_name` on the source computer in the very same second."""
    return _join_dealt(flows, *processes_by_second(proc), heavy_rows)


def hosts_met(flows: DataFrame, iocs: DataFrame) -> DataFrame:
    """The part of the feed's lookup that some flow goes to, stored.

    Only distinct destinations and the feed are shuffled for it, which is little beside the flows.
    """
    met = ioc_lookup(iocs).join(flows.select("dst_computer").distinct(), F.col("host") == F.col("dst_computer"), "left_semi")
    place = shared_path(flows.sparkSession, "hosts-met")
    met.write.parquet(place)
    return flows.sparkSession.read.schema(met.schema).parquet(place)


def threats_met(flows: DataFrame, iocs: DataFrame, broadcast_limit: int) -> tuple[DataFrame, bool]:
    """The feed's lookup, or as much of it as matters to `flows`, and whether it may be broadcast."""
    if fits_broadcast(ioc_hosts(iocs), broadcast_limit):
        return ioc_lookup(iocs), True
    if broadcast_limit <= 0:
        return ioc_lookup(iocs), False
    met = hosts_met(flows, iocs)
    return met, fits_broadcast(met, broadcast_limit)


def with_threat(
    flows: DataFrame,
    iocs: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Flows plus the `threat` of the listed host they went to.

    The feed is measured. Within the limit it is broadcast and the flows do not
    move. Of a larger one, the hosts that any flow goes to are found first, and if these are
    within the limit they are broadcast instead; else flows and hosts met are joined by a
    shuffle, with popular hosts dealt out. A limit of 0 goes straight to the shuffle.
    """
    threats, small = threats_met(flows, iocs, broadcast_limit)
    if small:
        return left_join_broadcast(flows, threats, BY_HOST)
    return _join_dealt(flows, threats, BY_HOST, heavy_rows)


def enrich_flows(
    flows: DataFrame,
    auth: DataFrame,
    proc: DataFrame,
    iocs: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Every flow with `user`, `process_name`, `threat` and `malicious_hit`.

    User and process share their key, so both joins use one shuffle of the flows.
    Heavy keys are looked for on the base flows, before any join.
    """
    threats, small_feed = threats_met(flows, iocs, broadcast_limit)
    heavy_seconds = find_heavy_keys(flows, SECOND_OF_COMPUTER, heavy_rows)
    heavy_hosts = HeavyKeys() if small_feed else find_heavy_keys(flows, list(BY_HOST), heavy_rows)

    rows = number_rows(flows) if heavy_seconds or heavy_hosts else flows
    rows = left_join_lookups(
        rows, [users_by_second(auth), processes_by_second(proc)], heavy_seconds
    )
    if small_feed:
        rows = left_join_broadcast(rows, threats, BY_HOST)
    else:
        rows = left_join_lookups(rows, [(threats, BY_HOST)], heavy_hosts)
    return rows.drop(SPREAD).withColumn("malicious_hit", hit_flag(F.col("threat")))
