"""Writers. Every one overwrites its target, as a rerun of a batch job should."""

from pyspark.sql import DataFrame


def write_silver(df: DataFrame, path: str, partitions: int = 0) -> None:
    """Snappy Parquet. `partitions > 0` spreads the rows first, which a table
    read from a few unsplittable gzip files needs; 0 leaves them as they are."""
    if partitions > 0:
        df = df.repartition(partitions)
    df.write.mode("overwrite").parquet(path, compression="snappy")


def write_gold(
    gold: DataFrame,
    path: str,
    partitions: int | None = None,
    only_these_hours: bool = False,
    find_by: tuple[str, ...] = (),
) -> None:
    """Parquet in one directory per `time_bucket`.

    With `only_these_hours` the directories of the hours in `gold` are replaced and all others
    keep their files; otherwise `gold` is the whole table. Columns `find_by` (such as user and
    src_computer) get Bloom filters, and rows are clustered by them within an hour, so a query for
    one value opens only the row groups that hold it.

    Ranges of (bucket, computer, user) give every task an equal share: small
    buckets go whole to one task, so they get one file, tasks write different
    directories at the same time, and an hour that holds a large part of the rows
    is cut over many tasks.
    """
    if partitions is None:
        partitions = int(gold.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = gold.repartitionByRange(partitions, "time_bucket", "src_computer", "user")
    blooms = {f"parquet.bloom.filter.enabled#{column}": "true" for column in find_by}
    blooms |= {"parquet.bloom.filter.adaptive.enabled": "true"} if find_by else {}  # sized by what is there
    if find_by:
        rows = rows.sortWithinPartitions("time_bucket", *find_by)
    (
        rows.write.mode("overwrite")
        .options(**blooms)
        .option("partitionOverwriteMode", "dynamic" if only_these_hours else "static")
        .partitionBy("time_bucket")
        .parquet(path, compression="snappy")
    )


def write_iocs(iocs: DataFrame, path: str) -> None:
    """Parquet; one file for a feed of ordinary size, more once it outgrows a partition."""
    iocs.hint("rebalance").write.mode("overwrite").parquet(path, compression="snappy")


def write_sample(lines: DataFrame, path: str, compress: bool = False) -> None:
    """Text lines, plain or gzip."""
    lines.write.mode("overwrite").text(path, compression="gzip" if compress else "none")
