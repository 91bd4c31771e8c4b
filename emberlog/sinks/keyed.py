"""Lookups stored by their join key, so that jobs which join with them don't move them.

Buckets are a property of a catalog table, not of files, so each table is registered under a
name made from its path; registering is metadata only and done again in every session.
"""

import hashlib

from pyspark.sql import DataFrame, SparkSession

from emberlog.operators.lookups import auth_lookup, proc_lookup
from emberlog.sources import read_silver

AUTH_KEYS, PROC_KEYS = ["time", "source_computer"], ["time", "computer"]


def _name(path: str) -> str:
    return f"emberlog_{hashlib.md5(path.encode()).hexdigest()}"


def write_keyed(lookup: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Store a table with one row per key in `buckets` files by hash of the keys, sorted by them.

    With one row per key no bucket can be larger than the hash makes it, whatever the skew of the
    rows the lookup was made from.
    """
    spark = lookup.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    (
        lookup.repartition(buckets, *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .format("parquet")
        .option("path", path)
        .option("compression", "snappy")
        .saveAsTable(_name(path))
    )


def read_keyed(spark: SparkSession, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table of `write_keyed`, with the same keys and buckets."""
    if not spark.catalog.tableExists(_name(path)):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(keys)
        spark.sql(
            f"CREATE TABLE {_name(path)} ({columns}) USING parquet"
            f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(_name(path))


def write_silver_by_second(spark: SparkSession, root: str, buckets: int | None = None) -> None:
    """The auth and proc lookups of the silver tables below `root`, stored by (second, computer).

    Take as many buckets as gold jobs have shuffle partitions (the default): flows are then dealt
    out once, in the same way. With another number they are dealt out once more.
    """
    buckets = buckets or _partitions(spark)
    write_keyed(auth_lookup(read_silver(spark, root, "auth")), f"{root}/by_second/auth", AUTH_KEYS, buckets)
    write_keyed(proc_lookup(read_silver(spark, root, "proc")), f"{root}/by_second/proc", PROC_KEYS, buckets)


def read_silver_by_second(spark: SparkSession, root: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(auth, proc) as `write_silver_by_second` stored them: they take the place of the silver logs in joins."""
    buckets = buckets or _partitions(spark)
    auth = read_keyed(spark, f"{root}/by_second/auth", AUTH_KEYS, buckets)
    return auth, read_keyed(spark, f"{root}/by_second/proc", PROC_KEYS, buckets)


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
