"""Ranked lexical search: the highest-scoring documents of each item, exactly.

Documents are split into terms once; what is kept of one is the terms that items use, with
their counts, and its length. Each task builds ball trees over bounded pieces of its
documents and searches them best-first for every item, carrying an item's best scores from
tree to tree, so that later trees are mostly passed over. The best of all tasks are ranked
in two steps.

Items are a query set, taken in blocks of BLOCK_BYTES of distinct text that driver and tasks
can hold. Documents are read once per block.
"""

from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.ball_tree import BallTree, Best, Rows
from emberlog.llm.contamination import SEPARATORS
from emberlog.llm.staging import partitions, written
from emberlog.llm.words import column, slices, tokens

TOP = 50
BLOCK_BYTES = 1 << 20
#: Documents and term counts of one tree.
TREE_ROWS = 8192
TREE_CELLS = 1 << 21
#: Terms of so many items are common ones.
COMMON = 8
NO_ID = np.iinfo(np.int64).max

COUNTED = "doc_id long, n_terms long, terms binary, counts binary"
STATISTICS = "term long, documents long"
FOUND = "item int, doc_id long, score long"
#: Rows of STATISTICS that aren't about a term.
ALL_DOCUMENTS, ALL_TERMS = -1, -2


class Items:
    """Items of one block, as sorted numbers of their distinct terms.

    Terms of the same item are numbered next to each other, those of many items first, so
    that neighbours are asked for together.
    """

    def __init__(self, texts: list[str]):
        found = tokens(pa.array(texts, pa.string()), SEPARATORS, lower=True)
        item = np.repeat(np.arange(len(texts)), np.diff(found.bounds))
        self.vocabulary, place = np.unique(found.hashes, return_inverse=True)
        pairs = np.unique(place * max(1, len(texts)) + item)
        holders, first = np.unique(pairs // max(1, len(texts)), return_counts=True, return_index=True)[1:][::-1]
        first = pairs[first] % max(1, len(texts)) if len(pairs) else first
        self.numbers = np.empty(len(self.vocabulary), np.int64)
        self.numbers[np.lexsort((first, -np.minimum(holders, COMMON)))] = np.arange(len(self.vocabulary))
        self.queries = [np.unique(self.numbers[place[a:b]]) for a, b in zip(found.bounds[:-1], found.bounds[1:])]


def _counting(items: Items):
    """Documents as counts of the items' terms."""
    vocabulary, numbers = items.vocabulary, items.numbers
    size = max(1, len(vocabulary))

    def task(batches):
        for batch in batches:
            texts, ids = column(batch, "text"), column(batch, "doc_id")
            for lo, hi in slices(texts):
                words = tokens(texts.slice(lo, hi - lo), SEPARATORS, lower=True)
                n = np.diff(words.bounds)
                row = np.repeat(np.arange(hi - lo), n)
                at = np.searchsorted(vocabulary, words.hashes)
                known = np.zeros(len(at), bool)
                if len(vocabulary):
                    known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == words.hashes
                cell, count = np.unique(row[known] * size + numbers[at[known]], return_counts=True)
                cut = np.searchsorted(cell, np.arange(hi - lo + 1) * size)
                term, count = (cell % size).astype(np.int32), count.astype(np.int64)
                packed = [[x[cut[i] : cut[i + 1]].tobytes() for i in range(hi - lo)] for x in (term, count)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), *(pa.array(p, pa.binary()) for p in packed)],
                    names=["doc_id", "n_terms", "terms", "counts"],
                )

    return task


def _unpacked(values: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """A column of packed arrays as one array and where each row begins."""
    width = np.dtype(kind).itemsize
    sizes = np.array([0 if v is None else len(v) for v in values.to_pylist()], np.int64) // width
    flat = np.frombuffer(b"".join(values.to_pylist()), kind)
    return flat, np.append(0, np.cumsum(sizes))


def _statistics(n_vocabulary: int):
    """One row per task and term: how many documents hold it."""

    def task(batches):
        holders = np.zeros(n_vocabulary, np.int64)
        documents = total = 0
        for batch in batches:
            terms, _ = _unpacked(column(batch, "terms"), np.int32)
            holders += np.bincount(terms, minlength=n_vocabulary)
            lengths = np.asarray(column(batch, "n_terms"))
            documents, total = documents + int((lengths > 0).sum()), total + int(lengths.sum())
        held = np.flatnonzero(holders)
        numbers = np.concatenate([held, [ALL_DOCUMENTS, ALL_TERMS]])
        sums = np.concatenate([holders[held], [documents, total]])
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(sums, pa.int64())], names=["term", "documents"])

    return task


def term_weights(holders: np.ndarray, documents: int) -> np.ndarray:
    return np.array([floor(1000 * log((2 * documents + 2) / (2 * df + 1))) for df in holders.tolist()], np.int64)


def impacts(counts: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What one unit of a term's weight adds, for `counts` of it in documents of `lengths` terms."""
    # Whole numbers of any size where 64 bits could overflow.
    if len(lengths) and 50 * int(lengths.max()) * documents >= 1 << 63:
        m = np.array([50 + (50 * n * documents) // total for n in lengths.tolist()], np.int64)
    else:
        m = 50 + (50 * lengths * documents) // max(1, total)
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


def _searching(items: Items, weights: np.ndarray, documents: int, total: int, top: int):
    asked = [k for k, q in enumerate(items.queries) if len(q)]
    queries = [items.queries[k] for k in asked]

    def search(parts, best):
        ids = np.concatenate([p[0] for p in parts])
        sizes = np.concatenate([p[1] for p in parts])
        terms, values = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
        tree = BallTree(Rows(np.append(0, np.cumsum(sizes)), terms, values), len(weights), queries)
        for number, query in enumerate(queries):
            tree.search(number, query, best[number], ids)

    def task(batches):
        if not queries:
            return
        best = [Best(top) for _ in queries]
        parts, rows, cells = [], 0, 0
        for batch in batches:
            ids = column(batch, "doc_id")
            ids = np.where(np.asarray(ids.is_null()), NO_ID, np.asarray(ids.fill_null(0)))
            lengths = np.asarray(column(batch, "n_terms"))
            terms, ptr = _unpacked(column(batch, "terms"), np.int32)
            counts, _ = _unpacked(column(batch, "counts"), np.int64)
            sizes = np.diff(ptr)
            values = weights[terms] * impacts(counts, np.repeat(lengths, sizes), documents, total)
            # A term in every document may weigh nothing.
            heavy = values > 0
            sizes = np.bincount(np.repeat(np.arange(len(ids)), sizes)[heavy], minlength=len(ids))
            terms, values = terms[heavy].astype(np.int64), values[heavy]
            full = sizes > 0
            ids, sizes = ids[full], sizes[full]
            ends = np.cumsum(sizes)
            lo = 0
            while lo < len(ids):
                used = ends[lo - 1] if lo else 0
                hi = min(lo + TREE_ROWS - rows, max(lo + 1, int(np.searchsorted(ends, used + TREE_CELLS - cells, "right"))), len(ids))
                parts.append((ids[lo:hi], sizes[lo:hi], terms[used : ends[hi - 1]], values[used : ends[hi - 1]]))
                rows, cells, lo = rows + hi - lo, cells + int(ends[hi - 1] - used), hi
                if rows >= TREE_ROWS or cells >= TREE_CELLS:
                    search(parts, best)
                    parts, rows, cells = [], 0, 0
        if parts:
            search(parts, best)
        for number, b in zip(asked, best):
            if len(b.scores):
                keys = pa.array(b.keys, pa.int64(), mask=b.keys == NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.keys), number), pa.int32()), keys, pa.array(b.scores, pa.int64())],
                    names=["item", "doc_id", "score"],
                )

    return task


def _ranked(found: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search_block(docs: DataFrame, texts: list[str], top: int) -> DataFrame:
    items = Items(texts)
    counted = written(docs.mapInArrow(_counting(items), COUNTED), "term-counts")
    sums = counted.mapInArrow(_statistics(len(items.vocabulary)), STATISTICS).groupBy("term").agg(F.sum("documents").alias("n"))
    # One number per term of the block.
    known = {r["term"]: r["n"] for r in sums.collect()}
    documents, total = known.pop(ALL_DOCUMENTS, 0), known.pop(ALL_TERMS, 0)
    holders = np.zeros(len(items.vocabulary), np.int64)
    holders[list(known)] = list(known.values())
    weights = term_weights(holders, documents)
    found = counted.mapInArrow(_searching(items, weights, documents, total, top), FOUND)
    part = F.pmod(F.spark_partition_id(), F.lit(partitions(docs)))
    first = _ranked(found.withColumn("part", part), ["item", "part"], top).drop("rank", "part")
    return _ranked(first, ["item"], top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` highest scores above 0 of each row of `items` (item_id, text).

    `docs` has doc_id and text; other columns of both don't matter. Terms are runs of letters
    and digits of ASCII and of anything beyond ASCII, A to Z taken as lower case. Null and empty
    texts have no terms: such items get no rows, such documents no rank. Equal scores rank by
    ascending doc_id, a null doc_id last; rows that repeat a doc_id are ranked each. Items that
    repeat are answered each. Without documents or items there are no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = asked.select("text").distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = size // BLOCK_BYTES + 1
    answers = None
    for block in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        chosen = sorted(r["text"] for r in part.collect())
        found = _search_block(docs, chosen, top)
        named = docs.sparkSession.createDataFrame(list(enumerate(chosen)), "item int, text string")
        found = found.join(F.broadcast(named), "item").select("text", "rank", "doc_id", "score")
        if blocks > 1:
            found = written(found, "ranks")
        answers = found if answers is None else answers.unionByName(found)
    return asked.join(answers, "text").select("item_id", "rank", "doc_id", "score")
