"""Checks of a table while it is written: the write counts, and a gate looks at the counts.

Counts are collected by the tasks that write (`Observation`), so a checked table is read no
more often than an unchecked one. It is written beside its place and moved there only if no
limit is breached; a breach ends the job and leaves the old table as it was.
"""

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from emberlog.sources.bronze import REJECT_COLUMN
from emberlog.sources.files import delete_folder, move_into_place


@dataclass(frozen=True)
class Limits:
    """What a table may look like. Rates are shares of its records; an empty table has none."""

    null_rates: dict[str, float] = field(default_factory=dict)
    malformed_rate: float = 1.0
    least_records: int = 0

    def breaches(self, counts: dict[str, int]) -> list[str]:
        records = counts["records"]
        found = []
        if records < self.least_records:
            found.append(f"{records} records, at least {self.least_records} wanted")
        limits = {f"nulls in {c}": (counts[f"nulls_{c}"], rate) for c, rate in self.null_rates.items()}
        limits["malformed lines"] = counts["malformed"], self.malformed_rate
        for what, (n, rate) in limits.items():
            if n > rate * records:
                found.append(f"{what}: {n} of {records}, {rate:.2%} allowed")
        return found


class LimitsBreached(ValueError):
    """The table that was to be written doesn't keep its limits. `counts` says what was found."""

    def __init__(self, path: str, breaches: list[str], counts: dict[str, int]):
        super().__init__(f"{path} was not written: " + "; ".join(breaches))
        self.breaches, self.counts = breaches, counts


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """`df` without REJECT_COLUMN, and what its next action will have counted:
    records, malformed (lines in REJECT_COLUMN, if `df` has it) and nulls_<column>."""
    columns = [c for c in df.columns if c != REJECT_COLUMN]
    malformed = F.count(REJECT_COLUMN) if REJECT_COLUMN in df.columns else F.sum(F.lit(0)).cast("long")
    counts = [F.count(F.lit(1)).alias("records"), F.coalesce(malformed, F.lit(0)).alias("malformed")]
    counts += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{c}") for c in columns]
    seen = Observation()
    return df.observe(seen, *counts).drop(REJECT_COLUMN), seen


def write_checked(df: DataFrame, path: str, limits: Limits = Limits(), partitions: int = 0) -> dict[str, int]:
    """Write `df` as the Snappy Parquet table `path` if it keeps `limits`; return its counts.

    With `partitions` the rows are spread first. Counting comes last, in the tasks that write,
    whose counts Spark takes once however often a task is run.
    """
    unknown = set(limits.null_rates) - set(df.columns)
    if unknown:
        raise ValueError(f"limits for unknown columns: {sorted(unknown)}")
    rows, seen = observed(df.repartition(partitions) if partitions > 0 else df)
    spark = df.sparkSession
    folder, _, name = path.rstrip("/").rpartition("/")
    staged = f"{folder}/_staged-{name}-{uuid.uuid4().hex}"
    try:
        rows.write.parquet(staged, compression="snappy")
        counts = seen.get
        breaches = limits.breaches(counts)
        if breaches:
            raise LimitsBreached(path, breaches, counts)
        move_into_place(spark, staged, path)
    finally:
        delete_folder(spark, staged)
    return counts
