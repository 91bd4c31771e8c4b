"""Logs in files that can't be split, landed once more in files that can.

A gzip file is one task in every job that reads it. Landing it once as bzip2 parts costs one
such pass, after which every scan is cut over tasks. Lines are compared by count and by the
sum of their hashes: those of the raw file are taken while it is written, those of the parts
when they are read back, and only equal ones take effect.
"""

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from emberlog.sources.bronze import read_lines
from emberlog.sources.files import delete_folder, move_into_place

LINES_PER_FILE = 20_000_000


@dataclass(frozen=True)
class Lines:
    """How many lines there are, and the sum of their hashes: the same for the same lines in any order."""

    count: int
    hashes: int


class LinesDiffer(ValueError):
    """What was written isn't what was read."""


def _measures() -> list:
    # Sums of so many 64-bit hashes are exact in 38 digits for 10^18 lines.
    hashes = F.sum(F.xxhash64("value").cast("decimal(20,0)"))
    return [F.count(F.lit(1)).alias("count"), F.coalesce(hashes, F.lit(0).cast("decimal(30,0)")).alias("hashes")]


def _lines(found: dict) -> Lines:
    return Lines(found["count"], int(found["hashes"]))


def lines_of(lines: DataFrame) -> Lines:
    return _lines(lines.agg(*_measures()).first().asDict())


def reland(spark: SparkSession, source: str, target: str, lines_per_file: int = LINES_PER_FILE) -> Lines:
    """Write the lines of `source` to the folder `target` as bzip2 parts, in their order.

    A target that is there already is replaced, but only by lines that were compared. The source
    stays as it is. Files of `source` are read in parallel, each by one task.
    """
    seen = Observation()
    staged = f"{target.rstrip('/')}-staged-{uuid.uuid4().hex}"
    raw = read_lines(spark, source).observe(seen, *_measures())
    try:
        raw.write.option("maxRecordsPerFile", lines_per_file).text(staged, compression="bzip2")
        read, written = _lines(seen.get), lines_of(read_lines(spark, staged))
        if read != written:
            raise LinesDiffer(f"{source}: {read.count} lines read, {written.count} written")
        move_into_place(spark, staged, target)
    finally:
        delete_folder(spark, staged)
    return read
