"""N-gram Jaccard join by T-occurrence search.

Documents are sets of word shingles; two are linked when they share at least
`percent` percent of their union. A link needs an overlap of T shingles, so

1. each set offers only the shingles of its extended prefix in hash order. Sets that
   don't meet others in enough of those shingles have no partner and stop here;
2. the whole sets that are left meet shingle by shingle, which gives the length of each
   inverted list. A set's prefix is taken again, shortest lists first; passages that very
   many documents share so come last and connect nothing by themselves;
3. the lists of those prefixes cut what remains into clusters that no link can leave. Within
   a cluster, DivideSkip (`divide_skip.py`) looks for the partners of a set: a heap merges the short
   inverted lists of its shingles, the long ones, fewer than T, are probed by binary search. A cluster
   too large for one task is first compared with a few of its sets, hubs; only sets that these don't
   connect with the bulk of the cluster meet all others, block by block.

A link between documents already known to be connected is not looked for, so a large
group of near copies costs about one comparison a copy. Sets that are equal are one
class and are joined through its smallest id. Steps 1 and 2 lose no link; sets travel
as 64-bit shingle hashes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.components import components, root
from emberlog.llm.divide_skip import connecting_links, least_overlap, needed_overlap, shared
from emberlog.llm.exchange import FLUSH, Packer, by_bucket, groups, schema_of, unpacked
from emberlog.llm.staging import joined_evenly, partitions, written
from emberlog.llm.words import column, mix, slices, tokens, windows

WORDS = 5
PERCENT = 80
#: Extended prefixes reach this share of T shingles beyond the plain prefix.
EXTRA = 0.1
#: Shingles of a cluster that one task takes; larger clusters are compared with hubs and cut into blocks.
BLOCK_SHINGLES = 1 << 16
#: Sets of a larger cluster that all its others are compared with in a round.
HUBS = 16
#: Digests that a task remembers to leave out exact copies.
RECENT = 1 << 16
NO_ID = np.iinfo(np.int64).max


def _extra(n, percent: int):
    return np.maximum(1, (EXTRA * least_overlap(n, percent)).astype(np.int64))


def _sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words than a shingle make one, no word none."""
    for lo, hi in slices(texts):
        found = tokens(texts.slice(lo, hi - lo), lower=True)
        every = windows(found.hashes, words)
        for a, b in zip(found.bounds[:-1], found.bounds[1:]):
            if b - a >= words:
                yield np.unique(every[a : b - words + 1])
            else:
                yield windows(found.hashes[a:b], int(b - a)) if b > a else np.empty(0, np.uint64)


def _digest(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


class _Fresh:
    """Tells digests that a task hasn't met lately, so that exact copies are told once; forgets all when full."""

    def __init__(self):
        self.met: set[int] = set()

    def __call__(self, digest: int) -> bool:
        if digest in self.met:
            return False
        if len(self.met) >= RECENT:
            self.met.clear()
        self.met.add(digest)
        return True


# Step 1: prefixes of all sets.

PREFIX = {"hash": np.uint64, "owner": np.uint64, "size": np.int32}


def _prefixes(words: int, percent: int, buckets: int):
    def task(batches):
        packer, fresh = Packer(buckets, PREFIX), _Fresh()
        for batch in batches:
            for shingles in _sets(column(batch, "text"), words):
                if (n := len(shingles)) and fresh(digest := _digest(shingles)):
                    size = n - least_overlap(n, percent) + int(_extra(np.int64(n), percent))
                    head = shingles[: min(n, size)]
                    yield from packer.add(
                        hash=head,
                        owner=np.full(len(head), digest, np.uint64),
                        size=np.full(len(head), n, np.int32),
                    )
        yield from packer.flush()

    return task


TALLY = {"hash": np.uint64, "owner": np.uint64, "count": np.int64}


def _meetings(percent: int, buckets: int):
    """Per owner: in how many of its offered shingles it meets another owner of fitting size."""

    def task(batches):
        p = unpacked(batches, PREFIX)
        order = np.lexsort((p["owner"], p["size"], p["hash"]))
        h, owner, size = (p[k][order] for k in ("hash", "owner", "size"))
        once = groups(h, size, owner)
        h, owner, size = h[once], owner[once], size[once].astype(np.int64)
        near = (h[1:] == h[:-1]) & (100 * size[:-1] >= percent * size[1:])
        meets = np.zeros(len(h), bool)
        meets[1:] |= near
        meets[:-1] |= near
        who, count = np.unique(owner[meets], return_counts=True)
        packer = Packer(buckets, TALLY)
        yield from packer.add(hash=mix(who), owner=who, count=count)
        yield from packer.flush()

    return task


def _summed(batches):
    p = unpacked(batches, TALLY)
    who, at = np.unique(p["owner"], return_inverse=True)
    total = np.bincount(at, weights=p["count"], minlength=len(who)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(who.view(np.int64)), pa.array(total)], names=["owner", "meetings"])


def _sizes(words: int, keep: list[str]):
    """`keep`, owner and n_shingles of every document."""

    def task(batches):
        for batch in batches:
            found = [(len(s), _digest(s)) for s in _sets(column(batch, "text"), words)]
            sizes = np.array([x[0] for x in found], np.int64)
            owners = _signed(np.array([x[1] for x in found], np.uint64))
            yield pa.RecordBatch.from_arrays(
                [*[column(batch, c) for c in keep], pa.array(owners), pa.array(sizes)], names=[*keep, "owner", "n_shingles"]
            )

    return task


# Step 2: whole sets of what is left.

WHOLE = {"hash": np.uint64, "owner": np.int64, "place": np.int32}
RANKED = {"hash": np.uint64, "owner": np.int64, "place": np.int32, "length": np.int32}
SIZED = {"hash": np.uint64, "owner": np.int64, "size": np.int32}


def _store_sets(words: int):
    def task(batches):
        fresh = _Fresh()
        for batch in batches:
            sets = [s for s in _sets(column(batch, "text"), words) if len(s) and fresh(_digest(s))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_signed(np.array([_digest(s) for s in sets], np.uint64))),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["owner", "n", "shingles"],
            )

    return task


def _postings(buckets: int):
    """Every shingle of the stored sets, with its place in the set."""

    def task(batches):
        packer = Packer(buckets, WHOLE)
        for batch in batches:
            for owner, raw in zip(*(column(batch, c).to_pylist() for c in ("owner", "shingles"))):
                shingles = np.frombuffer(raw, np.uint64)
                n = len(shingles)
                yield from packer.add(
                    hash=shingles, owner=np.full(n, owner, np.int64), place=np.arange(n, dtype=np.int32)
                )
        yield from packer.flush()

    return task


def _lengths(buckets: int):
    """Tell each owner how long the inverted lists of its shingles are, where another owner is in them."""

    def task(batches):
        p = unpacked(batches, WHOLE)
        order = np.lexsort((p["owner"], p["hash"]))
        h, owner, place = (p[k][order] for k in ("hash", "owner", "place"))
        once = groups(h, owner)
        h, owner, place = h[once], owner[once], place[once]
        starts = groups(h)
        runs = np.diff(np.append(starts, len(h)))
        length = np.repeat(runs, runs)
        held = length > 1
        owner, place, length = owner[held], place[held], length[held]
        packer = Packer(buckets, RANKED)
        for at in range(0, len(owner), FLUSH):
            part = slice(at, at + FLUSH)
            yield from packer.add(
                hash=mix(owner[part].view(np.uint64)), owner=owner[part], place=place[part], length=length[part]
            )
        yield from packer.flush()

    return task


def _ranked(batches):
    """(owner, shared, places): an owner's shared shingles, shortest inverted lists first."""
    p = unpacked(batches, RANKED)
    order = np.lexsort((p["place"], p["length"], p["owner"]))
    owner, place = p["owner"][order], p["place"][order]
    starts = groups(owner)
    ends = np.append(starts[1:], len(owner))
    for lo in range(0, len(starts), 4096):
        part = slice(lo, lo + 4096)
        cut = [place[a:b].tobytes() for a, b in zip(starts[part], ends[part])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[starts[part]]), pa.array(ends[part] - starts[part]), pa.array(cut, pa.binary())],
            names=["owner", "shared", "places"],
        )


def _prefix_lists(percent: int, buckets: int):
    """Prefixes in order of list length; shingles nobody else has come first and are of no use."""

    def task(batches):
        packer = Packer(buckets, SIZED)
        for batch in batches:
            for owner, n, raw, places in zip(*(column(batch, c).to_pylist() for c in ("owner", "n", "shingles", "places"))):
                shingles, order = np.frombuffer(raw, np.uint64), np.frombuffer(places, np.int32)
                alone = n - len(order)
                head = shingles[order[: max(0, n - least_overlap(n, percent) + 1 - alone)]]
                yield from packer.add(
                    hash=head, owner=np.full(len(head), owner, np.int64), size=np.full(len(head), n, np.int32)
                )
        yield from packer.flush()

    return task


def _chains(percent: int):
    """Neighbours by size in each inverted list, if their sizes fit, as a spanning forest of the bucket."""

    def task(batches):
        p = unpacked(batches, SIZED)
        order = np.lexsort((p["owner"], p["size"], p["hash"]))
        h, owner, size = (p[k][order] for k in ("hash", "owner", "size"))
        size = size.astype(np.int64)
        near = (h[1:] == h[:-1]) & (100 * size[:-1] >= percent * size[1:])
        pairs = np.unique(np.stack([owner[:-1][near], owner[1:][near]], 1), axis=0) if near.any() else np.empty((0, 2), np.int64)
        kept = _forest(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(kept[:, 0]), pa.array(kept[:, 1])], names=["u", "v"])

    return task


def _forest(pairs: np.ndarray) -> np.ndarray:
    parent: dict[int, int] = {}
    kept = []
    for i, (a, b) in enumerate(pairs.tolist()):
        ra, rb = root(parent, a), root(parent, b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append(i)
    return pairs[kept] if kept else np.empty((0, 2), np.int64)


# Step 3: links within a cluster.


def _links(percent: int):
    """Links that connect each cluster, or what a pair of its blocks connects, one after the other of a sorted partition."""

    def solve(held):
        if len(held) < 2:
            return []
        side, class_, owners, raws = zip(*held)
        sets = [np.frombuffer(raw, np.uint64) for raw in raws]
        return connecting_links(owners, sets, percent, class_, side if len(set(side)) > 1 else None)

    def task(batches):
        key, held = None, []
        for batch in batches:
            names = ("cluster", "left", "right", "side", "class", "owner", "shingles")
            for c, left, right, *row in zip(*(column(batch, x).to_pylist() for x in names)):
                if (c, left, right) != key:
                    if found := solve(held):
                        yield _pairs(found)
                    key, held = (c, left, right), []
                held.append(row)
        if found := solve(held):
            yield _pairs(found)

    return task


def _pairs(found) -> pa.RecordBatch:
    u, v = np.array(found, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _hub_links(percent: int):
    """One link from each set to a hub that it is linked to, and links between hubs that share such a set.

    A partition has the hubs of a part before the part's other sets, which pass through one by one.
    """

    def task(batches):
        key, hubs, told = None, [], set()
        for batch in batches:
            found = []
            names = ("cluster", "part", "hub", "owner", "shingles")
            for c, part, hub, owner, raw in zip(*(column(batch, x).to_pylist() for x in names)):
                if (c, part) != key:
                    key, hubs, told = (c, part), [], set()
                mine = np.frombuffer(raw, np.uint64)
                if hub:
                    hubs.append((owner, mine))
                    continue
                n, linked = len(mine), []
                for other, theirs in hubs:
                    m = len(theirs)
                    fits = least_overlap(max(n, m), percent) <= min(n, m)
                    if fits and shared(mine, theirs) >= needed_overlap(n, m, percent):
                        linked.append(other)
                if linked:
                    pairs = {(owner, linked[0]), *((linked[0], other) for other in linked[1:])}
                    found += pairs - told
                    told |= {p for p in pairs if p[0] != owner}
            if found:
                yield _pairs(found)

    return task


def _met_at_hubs(known: DataFrame, open_ones: DataFrame, sizes: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Links of the sets in `known` with at most HUBS sets out of `open_ones` for each cluster in `sizes` (cluster, total)."""
    slot = F.pmod(F.xxhash64("owner"), F.lit(HUBS))
    chosen = written(
        open_ones.join(sizes.select("cluster"), "cluster", "left_semi")
        .groupBy("cluster", slot.alias("slot"))
        .agg(F.min("owner").alias("owner"))
        .select("cluster", "owner"),
        "hubs",
    )
    parts = F.ceil(8 * F.col("total") / BLOCK_SHINGLES).cast("int")
    hubs = (
        joined_evenly(known, chosen, ["cluster", "owner"], "left_semi")
        .join(sizes, "cluster")
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .withColumn("hub", F.lit(True))
    )
    dealt = joined_evenly(known, sizes, ["cluster"], "inner").withColumn("part", F.pmod(F.xxhash64("owner"), parts))
    columns = ["cluster", F.col("part").cast("int").alias("part"), "hub", "owner", "shingles"]
    return (
        hubs.select(columns)
        .unionByName(dealt.withColumn("hub", F.lit(False)).select(columns))
        .repartition(buckets, "cluster", "part")
        .sortWithinPartitions("cluster", "part", F.desc("hub"))
        .mapInArrow(_hub_links(percent), "u long, v long")
    )


def _with_core(known: DataFrame, links: DataFrame) -> DataFrame:
    """`known` with `class`, what `links` connect it to (null: nothing), and `core`, true in the largest class of its cluster."""
    named = components(links).select(F.col("node").alias("owner"), F.col("component").alias("class"))
    classed = written(known.join(named, "owner", "left"), "classed")
    totals = classed.where("class is not null").groupBy("cluster", "class").agg(F.sum("n").alias("total"))
    largest = written(totals.groupBy("cluster").agg(F.max_by("class", F.struct("total", "class")).alias("largest")), "largest")
    return joined_evenly(classed, largest, ["cluster"], "left").withColumn(
        "core", F.coalesce(F.col("class") == F.col("largest"), F.lit(False))
    )


def _cut(huge: DataFrame, totals: DataFrame, percent: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Tasks for clusters of more than BLOCK_SHINGLES, and the links found on the way.

    A few hubs are compared with every set first, round after round while that connects much. The
    largest class so found, the core, is cut into blocks, and so are the sets outside of it, mostly few;
    blocks of these meet all blocks, those of the core do not meet each other.
    """
    links, open_ones, sizes, left = None, huge, totals, None
    while True:
        fresh = written(_met_at_hubs(huge, open_ones, sizes, percent, buckets), "hub-links")
        links = fresh if links is None else links.unionByName(fresh)
        classed = _with_core(huge, links)
        open_ones = classed.where("not core")
        outside = written(open_ones.groupBy("cluster").agg(F.sum("n").alias("outside")), "outside")
        sizes = written(totals.join(outside.where(F.col("outside") > BLOCK_SHINGLES), "cluster").drop("outside"), "open")
        before, left = left, outside.agg(F.coalesce(F.sum("outside"), F.lit(0))).first()[0]
        if sizes.isEmpty() or (before is not None and 8 * left > 7 * before):
            break
    blocks = [F.ceil(2 * total / BLOCK_SHINGLES).cast("int") for total in (F.col("total") - F.col("outside"), F.col("outside"))]
    plan = written(
        totals.join(outside, "cluster").select("cluster", blocks[0].alias("cores"), blocks[1].alias("others")), "blocks"
    )
    hashed = F.xxhash64("owner")
    at = F.when(F.col("core"), F.pmod(hashed, F.greatest("cores", F.lit(1)))).otherwise(F.col("cores") + F.pmod(hashed, "others")).cast("int")
    tasks = (
        joined_evenly(classed, plan, ["cluster"], "inner")
        .withColumn("block", at)
        .withColumn(
            "other",
            F.explode(F.sequence(F.when(F.col("core"), F.col("cores")).otherwise(0), F.col("cores") + F.col("others") - 1)),
        )
        .select(
            "cluster",
            F.least("block", "other").alias("left"),
            F.greatest("block", "other").alias("right"),
            (F.col("block") < F.col("other")).cast("int").alias("side"),
            "class",
            "owner",
            "shingles",
        )
    )
    return tasks, links


def _clustered_links(sets: DataFrame, clusters: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Links that connect the sets (owner, n, shingles) of each cluster; clusters holds (owner, cluster)."""
    known = written(sets.join(clusters, "owner"), "clustered")
    totals = known.groupBy("cluster").agg(F.sum("n").alias("total"))
    huge = written(totals.where(F.col("total") > BLOCK_SHINGLES), "huge")
    tasks = joined_evenly(known, huge, ["cluster"], "left_anti").select(
        "cluster",
        F.lit(0).alias("left"),
        F.lit(0).alias("right"),
        F.lit(0).alias("side"),
        F.lit(None).cast("long").alias("class"),
        "owner",
        "shingles",
    )
    met = None
    if not huge.isEmpty():
        members = written(joined_evenly(known, huge, ["cluster"], "left_semi"), "huge-sets")
        cut, met = _cut(members, huge, percent, buckets)
        tasks = tasks.unionByName(cut)
    links = (
        tasks.repartition(buckets, "cluster", "left", "right")
        .sortWithinPartitions("cluster", "left", "right", "owner")
        .mapInArrow(_links(percent), "u long, v long")
    )
    return links if met is None else links.unionByName(met)


def ids(column_: str = "doc_id") -> Column:
    """Row ids with null as the largest, so that null ids can be joined and compared."""
    return F.coalesce(F.col(column_).cast("long"), F.lit(int(NO_ID)))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs` (columns doc_id, text; others are ignored).

    Words are lower-cased A to Z and cut at ASCII whitespace. A text of fewer than `words`
    words is one shingle; a null or empty one has none and is linked with nothing. The
    component is named by the smallest doc_id in reach. Rows that repeat a doc_id are
    separate documents under one id. A null doc_id stays null, is never the smallest of a
    group with other ids, and is its own component (null) when nothing is linked to it.
    """
    return linked_rows(docs.select("doc_id", "text"), words, percent).select(
        F.nullif(F.col("doc_id"), F.lit(int(NO_ID))).alias("doc_id"),
        "n_shingles",
        F.nullif(F.col("component_id"), F.lit(int(NO_ID))).alias("component_id"),
    )


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed, null told apart from nothing."""
    simple = [F.col(f"`{c}`") for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    return F.xxhash64(*simple, *[c.isNull() for c in simple])


def linked_rows(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, row_key: Column | None = None) -> DataFrame:
    """`jaccard_components` with null ids as NO_ID, `row_key` of each row if given, and `component`.

    Unlike component_id, which two components can share when an id repeats, `component`
    is the same for two rows exactly if they are linked; it is null for rows without shingles.
    """
    buckets = partitions(docs)
    keys = [] if row_key is None else [row_key.alias("row_key")]
    keyed = docs.select(ids().alias("doc_id"), "text", *keys)
    base = keyed.select("doc_id", "text")
    keep = [c for c in keyed.columns if c != "text"]
    schema = ", ".join(f"{c} long" for c in [*keep, "owner", "n_shingles"])
    sizes = written(keyed.mapInArrow(_sizes(words, keep), schema), "sizes")
    classes = written(
        sizes.where("n_shingles > 0").groupBy("owner").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n")),
        "classes",
    )
    offered = base.mapInArrow(_prefixes(words, percent, buckets), schema_of(PREFIX))
    met = by_bucket(offered, buckets).mapInArrow(_meetings(percent, buckets), schema_of(TALLY))
    met = by_bucket(met, buckets).mapInArrow(_summed, "owner long, meetings long")
    smallest = F.ceil(F.lit(percent) * F.col("n") / 100)
    # A partner may be smaller and so have offered fewer shingles: its share counts.
    least = F.greatest(F.lit(1), F.floor(F.lit(EXTRA) * F.ceil(F.lit(percent) * smallest / 100) - F.lit(1e-6)))
    alive = met.join(classes, "owner").where(F.col("meetings") >= least)
    texts = base.join(alive.select(F.col("first").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = written(texts.mapInArrow(_store_sets(words), "owner long, n long, shingles binary"), "sets")
    lists = by_bucket(sets.mapInArrow(_postings(buckets), schema_of(WHOLE)), buckets).mapInArrow(
        _lengths(buckets), schema_of(RANKED)
    )
    ranked = by_bucket(lists, buckets).mapInArrow(_ranked, "owner long, shared long, places binary")
    left = written(sets.join(ranked, "owner").where(100 * F.col("shared") >= percent * F.col("n")), "left")
    chains = by_bucket(left.mapInArrow(_prefix_lists(percent, buckets), schema_of(SIZED)), buckets).mapInArrow(
        _chains(percent), "u long, v long"
    )
    left = left.select("owner", "n", "shingles")
    clusters = components(chains).select(F.col("node").alias("owner"), F.col("component").alias("cluster"))
    links = _clustered_links(left, clusters, percent, buckets)
    found = written(
        classes.join(components(links).withColumnRenamed("node", "owner"), "owner").select("owner", "component", "first"), "found"
    )
    smallest_id = written(found.groupBy("component").agg(F.min("first").alias("component_id")), "smallest")
    named = joined_evenly(found, smallest_id, ["component"], "inner").select("owner", "component", "component_id")
    named = written(classes.drop("n").join(named, "owner", "left"), "named")
    own = F.coalesce("component_id", F.when(F.col("n_shingles") > 0, F.col("first")), F.col("doc_id"))
    answer = sizes.join(named, "owner", "left")
    component = F.coalesce("component", F.when(F.col("n_shingles") > 0, F.col("owner")))
    return answer.select(*keep, "n_shingles", own.alias("component_id"), component.alias("component"))
