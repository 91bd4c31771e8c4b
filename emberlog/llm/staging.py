"""Intermediate tables of the operators, kept in the folder that all executors share."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators.skew import BROADCAST_LIMIT_BYTES
from emberlog.session import shared_path

#: Parts that the rows of one key are dealt over where a table about keys is too large to be broadcast.
SALTS = 16
#: Memory that a row of a few numbers takes in a broadcast table.
ROW_BYTES = 64


def written(frame: DataFrame, label: str) -> DataFrame:
    """`frame` stored as Parquet and read back: cuts the lineage and survives lost executors."""
    spark = frame.sparkSession
    path = shared_path(spark, f"llm-{label}")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(frame: DataFrame) -> int:
    """How many buckets an exchange is dealt over: the session's shuffle partitions, to be set by the data's size."""
    return max(1, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def joined_evenly(rows: DataFrame, about: DataFrame, keys: list[str], how: str, spread: str = "owner") -> DataFrame:
    """`rows` joined with `about`, a stored table of one row per key, without gathering a key's rows in one task.

    `about`, a few numbers a row, is broadcast if its rows, counted, fit; else rows are dealt by a hash of `spread`
    and `about` is repeated.
    """
    if about.count() * ROW_BYTES <= BROADCAST_LIMIT_BYTES:
        return rows.join(F.broadcast(about), keys, how)
    dealt = about.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, [*keys, "salt"], how).drop("salt")
