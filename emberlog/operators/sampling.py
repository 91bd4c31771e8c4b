"""Previews and samples."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.operators.skew import BROADCAST_LIMIT_BYTES, ROW_OVERHEAD_BYTES

DEFAULT_SAMPLE = 10_000  # fixed values: size and seed of a sample nobody sized or seeded
DEFAULT_SEED = 42

KEY_SAMPLE = 20_000  # keys looked at to find a cut
PREFIX_STEPS = (4, 8)  # hex digits: at most 65,536 counts are looked at in each step


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """A few first rows in the given order, for a report."""
    return df.orderBy(*order).limit(n)


def leading_rows(df: DataFrame, n: int) -> DataFrame:
    """Some `n` rows, whichever come first: no sort, and only leading files are read when shown."""
    return df.limit(n)


def take_first(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first `n` rows in ascending order of the columns `order`.

    The cut is found first: a bounded random sample of the keys tells which key about `n`
    rows lie below, a count confirms it, and the search goes on inside until few rows
    more than wanted are left. Only those are ordered, so nothing else is shuffled. An
    order by other expressions than columns is left to a bounded heap per task.
    """
    if n <= 0:
        return df.limit(0)
    if not all(isinstance(c, str) for c in order):
        return df.orderBy(*order).limit(n)
    key = F.struct(*order)
    within, rows = df, df.count()
    while rows > max(4 * n, KEY_SAMPLE):
        keys = within.select(key.alias("key")).sample(KEY_SAMPLE / rows).orderBy("key").collect()
        place = int(1.2 * n * len(keys) / rows) + 8
        cut = None
        while place < len(keys):
            bound = F.struct(*(F.lit(value).cast(df.schema[c].dataType).alias(c) for c, value in zip(order, keys[place]["key"])))
            below = within.where(key <= bound)
            count = below.count()
            if count >= n:
                cut = below
                break
            place *= 2
        if cut is None or count > 0.9 * rows:  # ties: the rest can't be told apart by the key
            break
        within, rows = cut, count
    return within.orderBy(*order).limit(n)


def sample_n(
    df: DataFrame, n: int = DEFAULT_SAMPLE, key: str = "line_no", seed: int = DEFAULT_SEED
) -> DataFrame:
    """Exactly min(n, size) rows, uniform, without replacement, the same for the same seed.

    `key` is unique per row. Rows rank by the md5 of seed and key, and the `n`
    lowest stay. Counts per token prefix, at most 65,536 at a time, show how long
    a prefix must be for the cut, so only the few rows that share the cut's
    prefix are ever ranked.
    """
    if n <= 0:
        return df.limit(0)
    token = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    tagged = df.withColumn("_token", token)
    cut, before = "", 0
    for digits in PREFIX_STEPS:
        prefix = F.substring("_token", 1, digits)
        running = F.sum("rows").over(Window.orderBy("prefix"))
        found = (
            tagged.where(F.col("_token").startswith(cut))
            .groupBy(prefix.alias("prefix"))
            .agg(F.count("*").alias("rows"))
            .select("prefix", (running - F.col("rows") + before).alias("before"), "rows")
            .where(F.col("before") + F.col("rows") >= n)
            .orderBy("prefix")
            .first()
        )
        if found is None:  # fewer than n rows in all
            return df
        cut, before = found["prefix"], found["before"]

    prefix = F.substring("_token", 1, PREFIX_STEPS[-1])
    whole = tagged.where(prefix < cut)
    edge = tagged.where(prefix == cut).orderBy("_token", key).limit(n - before)
    return whole.unionByName(edge).drop("_token")


def number_lines(lines: DataFrame) -> DataFrame:
    """`line_no`, counted from 0 over all files in path order, next to each `value`.

    `lines` is a text scan. Only one count per file split is gathered to place
    the splits; the lines are neither moved nor sorted.
    """
    tagged = lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    )
    splits = tagged.groupBy("_file", "_start").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_rows")
    )
    running = F.sum("_rows").over(Window.orderBy("_file", "_start"))
    places = splits.select(
        "_file", "_start", (running - F.col("_rows") - F.col("_first")).alias("_shift")
    )
    # At most one place per file and partition; its size is that of the path and a few numbers.
    paths = lines.inputFiles()
    longest = max((len(p) for p in paths), default=0)
    if (len(paths) + lines.rdd.getNumPartitions()) * (longest + ROW_OVERHEAD_BYTES) <= BROADCAST_LIMIT_BYTES:
        places = F.broadcast(places)
    return tagged.join(places, ["_file", "_start"]).select(
        (F.col("_id") + F.col("_shift")).alias("line_no"), "value"
    )
