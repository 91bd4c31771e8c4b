"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short, documents long, so plain MinHash similarity says little. Items are
partitioned by size, and each partition gets bottom-k MinHash sketches with k set by its
largest size: an item of n shingles of which `percent` percent must be in a document can
miss at most n - T of them there, so the n - T + 1 smallest hashes can't all be missing.
The sketches therefore lose no item. Documents offer all their shingles, whole texts;
candidates are verified by exact containment of the word shingles themselves.

Items are a query set, taken in blocks of BLOCK_BYTES of text that every task can hold.
With one block, documents are read once and aren't shuffled. With more, each block is a
pass of its own over the stored documents and its matches are written before the next
block is taken, so driver and tasks hold one block at a time.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.llm.staging import written
from emberlog.llm.words import column, slices, tokens, windows

WORDS = 5
PERCENT = 80
BLOCK_BYTES = 8 << 20
FILTER_BITS = 18
#: Words are runs of anything but ASCII other than letters and digits; case of A to Z is ignored.
SEPARATORS = tuple(b for b in range(128) if not chr(b).isalnum())
CUT = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")

MATCHES = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("n_shared", T.LongType()),
        ]
    )
)


def word_list(text: bytes) -> list[bytes]:
    return [w for w in CUT.split(text.lower()) if w]


def shingle_set(words: list[bytes], size: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


class Items:
    """Items of one block: their shingles and sketches, by shingle length."""

    def __init__(self, rows: list[tuple[int | None, str]], words: int, percent: int):
        self.percent = percent
        self.items = []
        by_length: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in rows:
            raw = (text or "").encode()
            listed = word_list(raw)
            if not listed:
                continue
            size = min(words, len(listed))
            hashes = np.unique(windows(tokens(pa.array([text]), SEPARATORS, lower=True).hashes, size))
            by_length.setdefault(size, []).append((len(self.items), hashes))
            self.items.append((item_id, size, shingle_set(listed, size), hashes))
        self.index = {size: self._sketches(group) for size, group in by_length.items()}

    def _sketches(self, group):
        """Sorted sketch hashes and the item of each; sizes of a partition are within a factor of two."""
        partition_of = {i: len(h).bit_length() for i, h in group}
        largest = {}
        for i, h in group:
            largest[partition_of[i]] = max(largest.get(partition_of[i], 0), len(h))
        heads = []
        for i, h in group:
            k = largest[partition_of[i]] - self.least(largest[partition_of[i]]) + 1
            heads.append((h[:k], np.full(min(k, len(h)), i)))
        hashes = np.concatenate([x for x, _ in heads])
        owners = np.concatenate([x for _, x in heads])
        order = np.argsort(hashes, kind="stable")
        hashes, owners = hashes[order], owners[order]
        seen = np.zeros(1 << FILTER_BITS, bool)
        seen[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
        return hashes, owners, seen

    def least(self, n: int) -> int:
        return -(-self.percent * n // 100)

    def candidates(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(place in hashes, item) wherever a sketch hash occurs."""
        known, owners, seen = self.index[size]
        at = np.flatnonzero(seen[(hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(known, hashes[at]), np.searchsorted(known, hashes[at], "right")
        at, lo, count = at[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
        spread = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(at, count), owners[spread]


def _matching(items: Items, keep: list[str]):
    def found_in(texts: pa.Array) -> list[list[dict]]:
        result: list[list[dict]] = [[] for _ in range(len(texts))]
        for lo, hi in slices(texts):
            piece = texts.slice(lo, hi - lo)
            words = tokens(piece, SEPARATORS, lower=True)
            counts = np.diff(words.bounds)
            row = np.repeat(np.arange(len(counts)), counts)
            for size in items.index:
                hashes = windows(words.hashes, size)
                if not len(hashes):
                    continue
                at, item = items.candidates(hashes, size)
                inside = row[at] == row[at + size - 1]
                pairs = np.unique(np.stack([row[at[inside]], item[inside]], 1), axis=0)
                for r, i in pairs.tolist():
                    own = hashes[words.bounds[r] : words.bounds[r + 1] - size + 1]
                    item_id, _, wanted, wanted_hashes = items.items[i]
                    if np.isin(wanted_hashes, own).sum() < items.least(len(wanted)):
                        continue
                    shared = len(wanted & shingle_set(word_list(piece[r].as_buffer().to_pybytes()), size))
                    if shared >= items.least(len(wanted)):
                        result[lo + r].append({"item_id": item_id, "n_shingles": len(wanted), "n_shared": shared})
        return result

    def task(batches):
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_shared", pa.int64())]))
        for batch in batches:
            found = pa.array(found_in(column(batch, "text")), kind)
            arrays = [column(batch, name) for name in keep]
            yield pa.RecordBatch.from_arrays([*arrays, found], names=[*keep, "matches"])

    return task


def with_matches(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """`docs` (a column text, any others) with `matches`: the items of `benchmark` (item_id, text) it contains.

    A document contains an item if it has `percent` percent of the item's distinct shingles
    of `words` words; an item of fewer words is one shingle. Null and empty texts contain
    nothing and are contained nowhere. Items that repeat are reported one by one. A column
    of `docs` called matches is replaced. Without items, matches is empty everywhere.
    """
    docs = docs.drop("matches")
    queries = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = queries.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = size // BLOCK_BYTES + 1

    def matching(texts: DataFrame, block: int) -> DataFrame:
        part = queries.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = Items([tuple(r) for r in part.collect()], words, percent)
        schema = T.StructType([*texts.schema.fields, T.StructField("matches", MATCHES)])
        return texts.mapInArrow(_matching(items, texts.columns), schema)

    if blocks == 1:
        return matching(docs, 0)
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = written(docs.select(F.struct(*names).alias("row"), F.monotonically_increasing_id().alias("row_id")), "rows")
    texts = rows.select("row_id", F.col("row.text").alias("text"))
    found = None
    for block in range(blocks):
        some = matching(texts, block).where(F.size("matches") > 0).select("row_id", F.lit(block).alias("block"), "matches")
        some = written(some, "matches")
        found = some if found is None else found.unionByName(some)
    listed = F.array_sort(F.collect_list(F.struct("block", "matches")))
    every = found.groupBy("row_id").agg(F.flatten(F.transform(listed, lambda x: x["matches"])).alias("matches"))
    nothing = F.array().cast(MATCHES)
    return rows.join(every, "row_id", "left").select("row.*", F.coalesce("matches", nothing).alias("matches"))
