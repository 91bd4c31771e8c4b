"""Guards for joins: what may be broadcast, and which keys are too heavy for one task."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 64

HEAVY_ROWS = 5_000_000  # rows of one key that one task takes without trouble
LEAST_SKETCHES = 64  # sketches the keys are divided over, so that merging them is parallel
TRACKED_PER_SKETCH = 1024
FOUND_PER_SKETCH = 128
HEAVY_PER_SKETCH = 32  # heavy keys that a sketch is given on average, well below what it can find

SPREAD, PART = "_spread", "_part"


def fits_broadcast(df: DataFrame, limit_bytes: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Measure a table of strings: true when all of it stays within the limit."""
    texts = " + ".join(f"coalesce(octet_length(`{name}`), 0)" for name in df.columns)
    size = df.agg(F.expr(f"sum({ROW_OVERHEAD_BYTES}L + {texts}) AS bytes")).first()["bytes"]
    return (size or 0) <= limit_bytes


@dataclass(frozen=True)
class HeavyKeys:
    """Hashes of heavy join keys and the number of parts each is cut into.

    `table` has at most (rows / heavy rows) rows of two numbers. It only steers rows
    to tasks: a key missed or listed in error changes the speed, never the result.
    """

    table: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.table is not None


def find_heavy_keys(df: DataFrame, keys: list[str], heavy_rows: int = HEAVY_ROWS) -> HeavyKeys:
    """Keys with at least `heavy_rows` rows, from frequent-item sketches.

    No more than rows / heavy_rows keys can be heavy, and the number of sketches follows
    that bound, so none is crowded out. One pass counts, one reads the key columns.
    """
    possible = df.count() // max(1, heavy_rows)
    if not possible:
        return HeavyKeys()
    sketches = max(LEAST_SKETCHES, -(-possible // HEAVY_PER_SKETCH))
    hashed = df.select(F.xxhash64(*keys).alias("key_hash"))
    sketch = F.call_function(
        "approx_top_k", F.col("key_hash"), F.lit(FOUND_PER_SKETCH), F.lit(TRACKED_PER_SKETCH)
    )
    heavy = (
        hashed.groupBy(F.pmod("key_hash", F.lit(sketches)))
        .agg(sketch.alias("top"))
        .select(F.inline("top").alias("key_hash", "rows"))
        .where(F.col("rows") >= heavy_rows)
        .select("key_hash", F.ceil(F.col("rows") / heavy_rows + 1).alias("parts"))
        .collect()
    )
    if not heavy:
        return HeavyKeys()
    return HeavyKeys(df.sparkSession.createDataFrame(heavy, "key_hash long, parts long"))


def number_rows(df: DataFrame) -> DataFrame:
    """Give each row a number to deal out rows of one key by: a hash of all its columns.

    It depends on nothing but the row, so a task that is run again, after a shuffle too,
    deals its rows as before. Rows equal in every column stay together."""
    return df.withColumn(SPREAD, F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))


def _with_parts(df: DataFrame, keys: list[str], heavy: HeavyKeys) -> DataFrame:
    # xxhash64 passes over NULLs, so keys may share a hash: they are then cut alike.
    return (
        df.withColumn("key_hash", F.xxhash64(*keys))
        .join(F.broadcast(heavy.table), "key_hash", "left")
        .drop("key_hash")
        .withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    )


def left_join_lookups(
    left: DataFrame,
    lookups: list[tuple[DataFrame, dict[str, str]]],
    heavy: HeavyKeys = HeavyKeys(),
) -> DataFrame:
    """`left` ⟕ each lookup on equal keys: all columns of `left`, then the payloads.

    Every lookup comes with a mapping from key names of `left` (the same for all)
    to its own, and has one row per key; the joins share one shuffle of `left`.
    Rows of heavy keys are dealt out over parts by their row number, and the lookup
    rows of such a key are repeated once per part; all others stay single.
    """
    keys = list(lookups[0][1])
    columns = left.columns
    if heavy:
        left = _with_parts(left, keys, heavy).withColumn(PART, F.pmod(SPREAD, F.col("parts")))
    for lookup, on in lookups:
        payload = [name for name in lookup.columns if name not in on.values()]
        lookup = lookup.select(*(F.col(on[key]).alias(key) for key in keys), *payload)
        match = keys
        if heavy:
            part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
            lookup = _with_parts(lookup, keys, heavy).withColumn(PART, part).drop("parts")
            match = keys + [PART]
        left = left.join(lookup, match, "left")
        columns = columns + payload
    return left.select(*columns)


def left_join_broadcast(left: DataFrame, lookup: DataFrame, on: dict[str, str]) -> DataFrame:
    """The same join with a lookup measured by `fits_broadcast`: `left` does not move."""
    return left_join_lookups(left, [(F.broadcast(lookup), on)])
