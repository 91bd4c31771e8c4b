"""Lookup tables: one row per join key, so a join never multiplies flows.

Where a key has several payloads the smallest one is kept and NULLs come last.
That is one of the outcomes an arbitrary pick allows, and it does not depend on
the run. `min` combines on the map side, so a key with very many copies costs
each task one row. `min` of a string aggregates by sorting, and logs come nearly
in time order, so `time` leads the keys: sorting such input is almost free.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions import url_host


def first_per_key(df: DataFrame, keys: list[str], payload: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(payload).alias(payload))


def auth_lookup(auth: DataFrame) -> DataFrame:
    """One user per (source_computer, time)."""
    return first_per_key(auth, ["time", "source_computer"], "source_user")


def proc_lookup(proc: DataFrame) -> DataFrame:
    """One process per (computer, time); starts and ends both count."""
    return first_per_key(proc, ["time", "computer"], "process_name")


def ioc_hosts(iocs: DataFrame) -> DataFrame:
    """(host, threat) with the host taken from the URL, not from the feed's own column."""
    return iocs.select(url_host(F.col("url")).alias("host"), "threat")


def ioc_lookup(iocs: DataFrame) -> DataFrame:
    """One threat per host."""
    return first_per_key(ioc_hosts(iocs), ["host"], "threat")
