"""Connected components of a table of links, by alternating large and small stars.

Every step is a map-side combined minimum and one join; nothing is gathered on the
driver but two numbers per round. A node with very many links is dealt over SALTS parts
in the join. Once no more than LAST_LINKS links are left, which is a fixed number of
megabytes whatever the input, one task finishes them by union-find.
"""

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.staging import written

SALTS = 16
LAST_LINKS = 1 << 20


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """Links (u, v) with `m`, the smallest node in reach of u."""
    salted = links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    dealt = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(dealt, ["u", "salt"]).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tops = least.select("u", F.col("m").alias("v"))
    rest = _with_least(down, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tops.unionByName(rest)


def root(parent: dict, node):
    """The smallest node connected with `node` so far; paths are shortened on the way."""
    top = node
    while (up := parent.get(top, top)) != top:
        top = up
    while (up := parent.get(node, node)) != top:
        parent[node] = top
        node = up
    return top


def _finish(batches):
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            ra, rb = root(parent, a), root(parent, b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
    nodes = list(parent)
    tops = [root(parent, n) for n in nodes]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.array(nodes, np.int64)), pa.array(np.array(tops, np.int64))], names=["node", "component"]
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (columns u, v, both long); component is its smallest node.

    Links to itself and repeated links are allowed; null ends are not.
    """
    edges = written(links.select("u", "v").where("u <> v"), "links")
    seen = None
    while edges.count() > LAST_LINKS:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == tuple(state):
            leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return leaves.unionByName(roots)
        seen = tuple(state)
        large = _large_star(edges).where("u <> v").distinct()
        edges = written(_small_star(large).where("u <> v").distinct(), "links")
    return edges.coalesce(1).mapInArrow(_finish, "node long, component long")
