"""Uniform sharding with exact shard sizes, by a hypergeometric communication matrix.

Rows lie in blocks. How many rows of each block go to each shard is drawn first: one
multivariate hypergeometric draw per block out of what the shards still have room for,
which is exactly how the counts of a uniform permutation are distributed. Each block
then permutes its own rows and deals them out by its counts, and each shard permutes
what it received. Both permutations are ranks within blocks and pieces whose number grows
with the bytes of the rows, so no task sorts more than about BLOCK_BYTES, whatever the input.
The driver holds one number per block and shard.

All draws depend on the seed and the row's own columns only, so a lost executor's work is
redone with the same result.
"""

from math import exp, lgamma

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.operators.skew import BROADCAST_LIMIT_BYTES

#: A block or a piece of a shard holds about so many bytes at most.
BLOCK_BYTES = 256 << 20
#: At least so many blocks, and pieces in all, so that small inputs are spread too.
BLOCKS = 1024
PIECES = 2048
SEED = 42


def communication_matrix(blocks: list[int], shards: int, seed: int = SEED) -> list[list[int]]:
    """Rows of block b for shard s: row sums are the blocks, column sums differ by one at most."""
    total = sum(blocks)
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    random = np.random.Generator(np.random.PCG64(seed))
    matrix = []
    for size in blocks:
        # Shard by shard: a hypergeometric share of the block in what is left.
        left, rest, draw = int(size), int(room.sum()), []
        for space in room.tolist():
            got = _hypergeometric(random, space, rest - space, left)
            draw.append(got)
            left, rest = left - got, rest - space
        room -= draw
        matrix.append(draw)
    return matrix


def _hypergeometric(random: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """One hypergeometric draw; beyond numpy's range by inversion, outward from the mode."""
    if not good or not drawn:
        return 0
    if not bad:
        return drawn
    if good + bad < 1_000_000_000:
        return int(random.hypergeometric(good, bad, drawn))
    low, high = max(0, drawn - bad), min(drawn, good)
    mode = (drawn + 1) * (good + 1) // (good + bad + 2)

    def choices(n: int, k: int) -> float:
        return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)

    up = down = mode
    above = below = exp(choices(good, mode) + choices(bad, drawn - mode) - choices(good + bad, drawn))
    left = random.random() - above
    while left > 0 and (up < high or down > low):
        if up < high:
            above *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            left -= above
            if left <= 0:
                return up
        if down > low:
            below *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            left -= below
            if left <= 0:
                return down
    return mode


def measured_bytes(rows: DataFrame) -> int:
    """About how large the rows are: the bytes of their texts, and a few for every cell."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)).cast("long") for c, kind in rows.dtypes if kind in ("string", "binary")]
    row = sum(texts, F.lit(16 * len(rows.columns)).cast("long"))
    return int(rows.agg(F.sum(row)).first()[0] or 0)


def shard(rows: DataFrame, shards: int, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """`rows` with `shard` (0 to shards - 1) and `slot` (0, 1, … within the shard), in uniform random order.

    Shard sizes differ by one at most. Existing columns named shard or slot are replaced.
    Rows are dealt by a hash of `key` and the other columns, so rows that share a key, null
    included, are spread like any others. Only rows equal in every column (of kinds that can
    be hashed) keep their places near each other; they are interchangeable. No rows, no rows.
    """
    spark = rows.sparkSession
    plain = rows.drop("shard", "slot")
    by_size = -(-measured_bytes(plain) // BLOCK_BYTES)
    blocks, pieces = max(BLOCKS, by_size), -(-max(PIECES, by_size) // shards)
    names = {c: f"c{i}" for i, c in enumerate(plain.columns)}
    rest = plain.select(*[F.col(f"`{c}`").alias(names[c]) for c in plain.columns])
    rest = rest.withColumn("ident", F.xxhash64(F.coalesce(F.col(names[key]).cast("string"), F.lit("")), *_tie_break(plain, names)))
    ident = F.col("ident")
    keyed = rest.select(
        *names.values(),
        F.pmod(F.xxhash64(F.lit(seed), ident), F.lit(blocks)).cast("int").alias("block"),
        F.xxhash64(F.lit(seed + 1), ident).alias("first_order"),
        F.pmod(F.xxhash64(F.lit(seed + 2), ident), F.lit(pieces)).cast("int").alias("piece"),
        F.xxhash64(F.lit(seed + 3), ident).alias("last_order"),
    )
    counted = {r["block"]: r["count"] for r in keyed.groupBy("block").count().collect()}
    order = sorted(counted)
    matrix = communication_matrix([counted[b] for b in order], shards, seed)
    ends = [(b, np.cumsum(row).tolist()) for b, row in zip(order, matrix)]
    plan = _small(spark.createDataFrame(ends, "block int, ends array<long>"), len(ends) * (shards + 4))
    local = Window.partitionBy("block").orderBy("first_order", *_tie_break(plain, names))
    dealt = (
        keyed.withColumn("rank", F.row_number().over(local))
        .join(plan, "block")
        .withColumn("shard", F.size(F.filter("ends", lambda end: end < F.col("rank"))))
        .drop("rank", "ends", "first_order", "block")
    )
    # Slots: pieces of a shard lie one after the other, each permuted by itself.
    sizes = dealt.groupBy("shard", "piece").count()
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "piece", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("shard", "piece").orderBy("last_order", *_tie_break(plain, names))
    placed = dealt.withColumn("within", F.row_number().over(inner)).join(_small(offsets, shards * pieces * 4), ["shard", "piece"])
    return placed.select(
        *[F.col(new).alias(old) for old, new in names.items()],
        "shard",
        (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"),
    )


def _small(frame: DataFrame, numbers: int) -> DataFrame:
    """Marked for broadcast if it holds few enough numbers; else the join chooses for itself."""
    return F.broadcast(frame) if 8 * numbers <= BROADCAST_LIMIT_BYTES else frame


def _tie_break(plain: DataFrame, names: dict[str, str]) -> list:
    """A total order of rows that share a key, so that a second evaluation deals them alike."""
    simple = [names[c] for c, kind in plain.dtypes if not kind.startswith(("map", "variant"))]
    return [F.xxhash64(*simple)]
