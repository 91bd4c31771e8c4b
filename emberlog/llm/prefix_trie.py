"""The trie of conversation prefixes, with totals over subtrees.

Conversations that begin with the same turns share the nodes of these turns. A node is named
by the smallest conversation that passes through it and its depth. Turns are addressed by
two 64-bit hashes, and a prefix by the sums of the hashes of its turns and their places, so a
conversation of any length is cut over tasks: partial sums are enough. Totals over subtrees
come from a centroid decomposition (`centroids.py`).
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.centroids import SMALL, subtree_totals
from emberlog.llm.staging import written
from emberlog.llm.words import column

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of listed ids that travel as one row.
CHUNK_BYTES = 1 << 18
KEY = ["depth", "k1", "k2"]


def numbered(log: DataFrame) -> DataFrame:
    """(conv_id, place from 0, h1, h2, n_words, part) of the turns of a log (conv_id, turn, role, text).

    Turns are ordered by turn (null first), equal ones by role and text; null roles and texts
    become empty. Rows without conv_id belong to no conversation. The log is cut into ranges of
    (conv_id, turn, role, text), so a conversation with a large part of all rows is ordered by
    many tasks; `part` is the range a row is in.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = log.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    hashed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64("text", F.lit(1), "role").alias("h2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("row"),
    )
    stored = written(hashed, "turns")
    # Only conversations that reach into another range: at most one range's edge each.
    parts = stored.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    before = parts.withColumn("before", earlier).where("before > 0").select("conv_id", "part", "before")
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("row")) - 1
    placed = stored.withColumn("place", place).join(F.broadcast(before), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "h1", "h2", "n_words", "part")


def forked(turns: DataFrame, base: Column, shared: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that take their first `shared` turns (at most `most`) from conversation `base`.

    (conversations, turns): conv_id, length; and conv_id, depth from 1, h1, h2, n_words, part.
    What a conversation has itself before its turn `shared` gives way; it takes all the base has,
    if that is less, and nothing if there is no such conversation.
    """
    sizes = turns.groupBy("conv_id", "part").agg(F.count("*").alias("n")).groupBy("conv_id").agg(F.sum("n").alias("own"))
    cell = F.struct("place", "h1", "h2", "n_words")
    heads = turns.where(F.col("place") < most).groupBy("conv_id").agg(F.array_sort(F.collect_list(cell)).alias("heads"))
    convs = sizes.select("conv_id", "own", base.alias("base"), shared.alias("shared"))
    convs = convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
    taken = F.coalesce(F.slice("heads", F.lit(1), F.col("shared")), F.array().cast(heads.schema["heads"].dataType))
    convs = written(
        convs.select("conv_id", "shared", taken.alias("taken"), (F.size(taken) + F.greatest(F.col("own") - F.col("shared"), F.lit(0))).alias("length")),
        "conversations",
    )
    lent = convs.select("conv_id", F.explode("taken").alias("t")).select(
        "conv_id", (F.col("t.place") + 1).alias("depth"), "t.h1", "t.h2", "t.n_words", F.lit(-1).alias("part")
    )
    own = turns.join(convs, "conv_id").where(F.col("place") >= F.col("shared")).select(
        "conv_id", (F.col("place") - F.col("shared") + F.size("taken") + 1).alias("depth"), "h1", "h2", "n_words", "part"
    )
    return convs.select("conv_id", "length"), lent.unionByName(own)


def _key(one: Column, two: Column) -> list[Column]:
    return [F.xxhash64(one, two).alias("k1"), F.xxhash64(two, F.lit(1), one).alias("k2")]


def prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, length, depth, k1, k2, p1, p2, n_words): the key of each prefix and of the one before."""

    def exact(value: Column) -> Column:
        return value.cast("decimal(20,0)")

    scaled = written(
        turns.select(
            "conv_id", "part", F.col("depth").cast("long").alias("depth"), "n_words",
            exact(F.xxhash64("depth", "h1")).alias("t1"), exact(F.xxhash64("h2", "depth")).alias("t2"),
        ),
        "terms",
    )
    parts = scaled.groupBy("conv_id", "part").agg(F.sum("t1").alias("a1"), F.sum("t2").alias("a2"))
    by_part = Window.partitionBy("conv_id").orderBy("part")
    offsets = parts.withColumns({f"b{i}": F.sum(f"a{i}").over(by_part) - F.col(f"a{i}") for i in (1, 2)})
    inside = Window.partitionBy("conv_id", "part").orderBy("depth")
    sums = scaled.withColumns({f"s{i}": F.sum(f"t{i}").over(inside) for i in (1, 2)}).join(offsets, ["conv_id", "part"])
    wide = {f"s{i}": (F.col(f"s{i}") + F.col(f"b{i}")).cast("decimal(38,0)") for i in (1, 2)}
    sums = sums.withColumns(wide)
    previous = [(F.col(f"s{i}") - F.col(f"t{i}")).cast("decimal(38,0)") for i in (1, 2)]
    p1, p2 = _key(*previous)
    keyed = sums.select("conv_id", "depth", *_key(F.col("s1"), F.col("s2")), p1.alias("p1"), p2.alias("p2"), "n_words")
    nothing = F.lit(0).cast("decimal(38,0)")
    roots = convs.select(
        "conv_id", "length", F.lit(0).cast("long").alias("depth"), *_key(nothing, nothing),
        F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), F.lit(0).cast("long").alias("n_words"),
    )
    return written(keyed.join(convs, "conv_id").select(*roots.columns).unionByName(roots), "prefixes")


def _packing(batches) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys as comma-joined ids, at most CHUNK_BYTES or one batch a row."""
    for batch in batches:
        keys = [np.asarray(column(batch, k)) for k in KEY]
        ids = np.asarray(column(batch, "conv_id"))
        if not len(ids):
            continue
        fresh = np.append(True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))
        heads = np.append(np.flatnonzero(fresh), len(ids))
        cuts = [c for a, b in zip(heads[:-1], heads[1:]) for c in range(a, b, CHUNK_BYTES // 20)] + [len(ids)]
        lists = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(cuts[:-1], cuts[1:])]
        at = np.array(cuts[:-1])
        arrays = [*(pa.array(k[at], pa.int64()) for k in keys), pa.array(ids[at], pa.int64()), pa.array(lists, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, names=[*KEY, "first", "ids"])


def _hashing(batches) -> Iterator[pa.RecordBatch]:
    """Digest of the lists of each key, taken in one after the other."""
    current, digest = None, None
    for batch in batches:
        found = []
        for *key, _, ids in zip(*(column(batch, c).to_pylist() for c in (*KEY, "first", "ids"))):
            if key != current:
                if current:
                    found.append((*current, digest.hexdigest()))
                current, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if found:
            yield _digests(found)
    if current:
        yield _digests([(*current, digest.hexdigest())])


def _digests(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names=[*KEY, "ends"])


def listed_ends(lines: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends): the digest of the ids of the conversations that end at a node.

    Ids are ordered over ranges of (node, id) and travel in chunks, so of a node where a large
    part of all conversations end one task sees some rows of text, not the conversations.
    """
    ended = lines.where("depth = length").select(*KEY, "conv_id")
    order = [*KEY, "conv_id"]
    chunks = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _packing, "depth long, k1 long, k2 long, first long, ids string"
    )
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(_hashing, "depth long, k1 long, k2 long, ends string")


def prefix_trie(convs: DataFrame, turns: DataFrame, small: int = SMALL) -> DataFrame:
    """The nodes of the trie of all prefixes of conversations, from the empty one on.

    `convs` has conv_id (unique) and length, `turns` conv_id, depth from 1 to length, h1, h2
    (hashes of the turn), n_words and part (ranges of a conversation's depths, ascending with them).
    Result: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. Equal conversations share all nodes; one without turns is a member
    of the root only. Without conversations there is no node. Components of the forest with more
    than `small` nodes are split on Spark.
    """
    lines = prefixes(convs, turns)
    nodes = lines.groupBy(*KEY).agg(
        F.min("conv_id").alias("name"),
        F.count("*").alias("n_convs"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.min("n_words").alias("n_words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    nodes = written(nodes, "nodes")
    if nodes.isEmpty():
        return convs.sparkSession.createDataFrame([], TRIE)
    above = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children")
    )
    # All nodes of depth 1 have the same parent, so that join would meet in one task.
    root = nodes.where("depth = 0").first()["name"]
    named = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("name").alias("parent_name"))
    near, deep = nodes.where("depth < 2"), nodes.where("depth >= 2")
    parent = F.when(F.col("depth") == 1, F.lit(root)).cast("long")
    linked = deep.join(named.where("depth >= 2"), ["depth", "p1", "p2"]).unionByName(near.withColumn("parent_name", parent))
    childless = F.col("n_children") == 0
    tree = written(
        linked.join(above, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .select(
            *KEY, "name", "parent_name", "n_convs", "n_children", "weight", childless.cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved_tokens"),
        ),
        "tree",
    )

    def ancestors() -> DataFrame:
        at = tree.select(*KEY, F.col("name").alias("ancestor"), F.col("parent_name").alias("above"))
        owners = tree.select(F.col("name").alias("conv_id")).distinct()
        own = lines.where("depth > 0").select("conv_id", *KEY).join(owners, "conv_id", "left_semi")
        return written(own.join(at, KEY).select(F.col("conv_id").alias("name"), "depth", "ancestor", "above"), "ancestors")

    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"], ancestors, small)
    ends = listed_ends(lines)
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        tree.drop("n_leaves", "saved_tokens").join(totals, ["name", "depth"]).join(ends, KEY, "left")
        .select(
            F.col("name").alias("conv_id"), "depth", F.col("parent_name").alias("parent_conv_id"), "n_convs", "n_children",
            "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"),
        )
    )


TRIE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string"
)
