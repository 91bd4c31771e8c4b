"""Subtree totals of a forest by centroid decomposition.

A component's centroid is the deepest node that still has more than half of the component's
weight below it (itself included). Nodes with more than half form a chain from the top to the
centroid. What lies at and below the centroid is summed once, the sum is added along the
chain, and the component is split: each child of the centroid tops a new component, what is
not below the centroid keeps the old top. No new component has more than half of the weight,
so the number of levels is the logarithm of the weight, however deep or bushy a tree is.

Weights are positive and the weight of each subtree is known beforehand. Components of more
than SMALL nodes are split on Spark, all at once, level by level; those left are finished by
the same steps with numpy, many of them in one task.

A node is (name, depth), its parent (parent_name, depth - 1); `name` tells nodes of equal
depth apart. Names are inherited: whatever node one is below of, `ancestors` says what its
name is at a smaller depth.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.exchange import groups
from emberlog.llm.staging import written
from emberlog.llm.words import column
from emberlog.operators.skew import BROADCAST_LIMIT_BYTES

SMALL = 1024
#: Nodes of small components that a task solves together.
TOGETHER = 1 << 17
#: About what a component's row of numbers takes.
COMPONENT_BYTES = 128

NODE = ("name", "depth", "parent_name", "weight", "top_name", "top_depth")


def _solved(table: dict[str, np.ndarray], sums: list[str]) -> dict[str, np.ndarray]:
    """Totals of whole components that lie in memory, sorted by component."""
    n = len(table["name"])
    names, code = np.unique(table["name"], return_inverse=True)
    levels = int(table["depth"].max()) + 1
    key = code * levels + table["depth"]
    order = np.argsort(key)
    at = np.searchsorted(names, table["parent_name"])
    wanted = np.minimum(at, len(names) - 1) * levels + table["depth"] - 1
    place = np.minimum(np.searchsorted(key[order], wanted), n - 1)
    parent = order[place]
    is_top = (table["name"] == table["top_name"]) & (table["depth"] == table["top_depth"])
    here = np.arange(n)
    up = np.where(is_top, here, parent)
    starts = groups(table["top_name"], table["top_depth"])
    top = np.repeat(here[is_top], np.diff(np.append(starts, n)))
    weight, own = table["weight"].copy(), {s: table[f"own_{s}"] for s in sums}
    total = {s: table[s].copy() for s in sums}
    alive = here
    while len(alive):
        heavy = alive[2 * weight[alive] > weight[top[alive]]]
        # The deepest heavy node of each component.
        deep = heavy[np.lexsort((table["depth"][heavy], top[heavy]))]
        centroid = np.full(n, -1)
        centroid[top[deep]] = deep
        mine = centroid[top]
        cut = alive[(parent[alive] == mine[alive]) & (up[alive] != alive)]
        up[cut] = cut
        whole = centroid[top[heavy]]
        up[whole] = whole
        new_top = up.copy()
        while True:
            further = new_top[new_top]
            if np.array_equal(further, new_top):
                break
            new_top = further
        below = alive[(alive == mine[alive]) | ((new_top[alive] != top[alive]) & (parent[new_top[alive]] == mine[alive]))]
        for s in sums:
            part = np.bincount(top[below], own[s][below], n).astype(np.int64) if len(below) else np.zeros(n, np.int64)
            total[s][heavy] += part[top[heavy]]
        above = heavy[heavy != mine[heavy]]
        weight[above] -= weight[mine[above]]
        alive = alive[alive != mine[alive]]
        top = new_top
    return total


def _solving(sums: list[str]) -> Callable:
    kinds = [*NODE, *sums, *(f"own_{s}" for s in sums)]

    def solve(parts) -> pa.RecordBatch:
        table = {k: np.concatenate([p[k] for p in parts]) for k in kinds}
        total = _solved(table, sums)
        arrays = [table["name"], table["depth"], *(total[s] for s in sums)]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["name", "depth", *sums])

    def task(batches) -> Iterator[pa.RecordBatch]:
        """Components come one after the other; a batch may end inside of one."""
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {k: np.asarray(column(batch, k)) for k in kinds}
            if size >= TOGETHER:
                last = (held[-1]["top_name"][-1], held[-1]["top_depth"][-1])
                fresh = np.flatnonzero((rows["top_name"] != last[0]) | (rows["top_depth"] != last[1]))
                if len(fresh):
                    held.append({k: v[: fresh[0]] for k, v in rows.items()})
                    yield solve(held)
                    rows = {k: v[fresh[0] :] for k, v in rows.items()}
                    held, size = [], 0
            held.append(rows)
            size += len(rows["name"])
        if held:
            yield solve(held)

    return task


def _level(nodes: DataFrame, large: DataFrame, ancestors: DataFrame, sums: list[str], few: bool) -> DataFrame:
    """One level on Spark: `nodes` with the components listed in `large` split at their centroids.

    Finished nodes have a null top. What is known of each large component, one row of numbers, is
    broadcast where that is small, so a component with a large part of all nodes isn't moved to one task.
    """
    component = ["top_name", "top_depth"]

    def each(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if few else frame

    marked = nodes.join(each(large), component, "left")
    heavy = 2 * F.col("weight") > F.col("all_weight")
    at = F.max_by(F.struct("name", "depth", "weight"), "depth")
    centroids = marked.where(heavy).groupBy(*component).agg(at.alias("c")).select(
        *component, F.col("c.name").alias("c_name"), F.col("c.depth").alias("c_depth"), F.col("c.weight").alias("c_weight")
    )
    marked = written(marked.join(each(centroids), component, "left"), "marked")
    # Nodes of one name lie on one path, so one question for each name and component will do.
    asked = marked.where(F.col("depth") > F.col("c_depth")).select(*component, "name", "c_name", "c_depth").distinct()
    line = ancestors.select(F.col("name"), F.col("depth").alias("at"), F.col("ancestor"), F.col("above"))
    under = (
        asked.withColumn("at", F.col("c_depth") + 1).join(line, ["name", "at"])
        .where(F.col("above") == F.col("c_name")).select(*component, "name", F.col("ancestor").alias("child"))
    )
    split = marked.join(under, [*component, "name"], "left")
    is_centroid = (F.col("name") == F.col("c_name")) & (F.col("depth") == F.col("c_depth"))
    below = F.coalesce(F.col("child").isNotNull() & (F.col("depth") > F.col("c_depth")), F.lit(False))
    split = written(split.select(*nodes.columns, "all_weight", "c_name", "c_depth", "c_weight", is_centroid.alias("is_c"), below.alias("below"), "child"), "split")
    parts = split.where(F.col("is_c") | F.col("below")).groupBy(*component).agg(*[F.sum(f"own_{s}").alias(f"part_{s}") for s in sums])
    joined = split.join(each(parts), component, "left")
    chain = F.coalesce(2 * F.col("weight") > F.col("all_weight"), F.lit(False))
    is_c = F.coalesce("is_c", F.lit(False))
    done = {s: F.when(chain, F.col(s) + F.col(f"part_{s}")).otherwise(F.col(s)) for s in sums}
    new = {
        "weight": F.when(chain & ~is_c, F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")),
        "top_name": F.when(is_c, F.lit(None)).when(F.col("below"), F.col("child")).otherwise(F.col("top_name")),
        "top_depth": F.when(is_c, F.lit(None)).when(F.col("below"), F.col("c_depth") + 1).otherwise(F.col("top_depth")),
    }
    return written(joined.select(*[(done | new).get(c, F.col(c)).alias(c) for c in nodes.columns]), "level")


def subtree_totals(
    nodes: DataFrame, sums: list[str], ancestors: Callable[[], DataFrame], small: int = SMALL
) -> DataFrame:
    """(name, depth, each of `sums`) with the sums over every node's subtree, itself included.

    `nodes` has name, depth, parent_name (null at the top of a tree), weight (of the whole subtree)
    and the columns `sums`. `ancestors()`, called only if some tree is large, gives (name, depth,
    ancestor, above): for each name, at every depth down to its deepest node, the name of the node
    on its line at that depth and one above it.
    """
    first = nodes.select(
        "name",
        F.col("depth").cast("long").alias("depth"),
        F.coalesce("parent_name", "name").alias("parent_name"),
        F.col("weight").cast("long").alias("weight"),
        *[F.col(s).cast("long").alias(f"own_{s}") for s in sums],
        *[F.lit(0).cast("long").alias(s) for s in sums],
        F.lit(None).cast("long").alias("top_name"),
        F.lit(None).cast("long").alias("top_depth"),
    )
    # Every tree has one top, and it is the only node of its depth there: all share the root.
    root = nodes.where("parent_name is null").agg(F.min("name").alias("name"), F.min("depth").alias("depth")).first()
    state = first.withColumns({"top_name": F.lit(root["name"]).cast("long"), "top_depth": F.lit(root["depth"]).cast("long")})
    finished, line = None, None
    while True:
        sizes = state.groupBy("top_name", "top_depth").agg(F.count("*").alias("n"), F.max("weight").alias("all_weight"))
        large = written(sizes.where(F.col("n") > small).drop("n"), "large")
        n_large = large.count()
        if not n_large:
            break
        line = ancestors() if line is None else line
        level = _level(state, large, line, sums, n_large * COMPONENT_BYTES <= BROADCAST_LIMIT_BYTES)
        done = level.where("top_name is null").select("name", "depth", *sums)
        finished = done if finished is None else finished.unionByName(done)
        state = level.where("top_name is not null")
    dealt = state.repartition("top_name", "top_depth").sortWithinPartitions("top_name", "top_depth")
    fields = ", ".join(f"{c} long" for c in ("name", "depth", *sums))
    kinds = [*NODE, *sums, *(f"own_{s}" for s in sums)]
    rest = dealt.select(*kinds).mapInArrow(_solving(sums), fields)
    return rest if finished is None else rest.unionByName(finished)
