"""Windows of tokens that occur in several documents, found by packed postings.

A posting is a window's hash with its document and place. Within a task, postings of
one hash are combined before the shuffle: of a hash that several documents of the
task share only the earliest goes on, the rest is decided at once. A window that a
third of all documents hold so costs each receiving task one posting per flush.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.exchange import FLUSH, Packer, by_bucket, groups, schema_of, unpacked
from emberlog.llm.words import Tokens, column, mix, slices, tokens

#: `place` holds the checksum of the text (upper half) and the token's number (lower half).
POSTING = {"hash": np.uint64, "doc": np.int64, "place": np.uint64, "decided": np.uint8}
FOUND = {"hash": np.uint64, "doc": np.int64, "place": np.uint64}
MARKS = "doc_id long, part long, places array<int>"
NO_ID = np.iinfo(np.int64).max


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text): null ids become the largest; `part` tells texts under one id apart."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc_id"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("part"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def original_id() -> "F.Column":
    return F.nullif(F.col("doc_id"), F.lit(int(NO_ID))).alias("doc_id")


def _sorted(p: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Postings by (hash, doc, place), and where each hash begins."""
    order = np.lexsort((p["place"], p["doc"], p["hash"]))
    p = {k: v[order] for k, v in p.items()}
    return p, groups(p["hash"])


def _first_of(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each row, the value at the start of its group."""
    return np.repeat(values[starts], np.diff(np.append(starts, len(values))))


def shared(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted postings: which are in several documents, and which must be told to others."""
    starts = groups(p["hash"])
    lengths = np.diff(np.append(starts, len(p["hash"])))
    last = p["doc"][starts + lengths - 1] if len(starts) else p["doc"]
    several = np.repeat(p["doc"][starts] != last, lengths)
    tell = ~several
    tell[starts] = True
    return several, tell


def later_document(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted postings: which have the same window in a smaller document; only the rest is told."""
    later = p["doc"] != _first_of(p["doc"], groups(p["hash"]))
    return later, ~later


def later_place(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted postings: all but the first of each window; a repeated row is at the same place."""
    starts = groups(p["hash"])
    tell = np.zeros(len(p["hash"]), bool)
    tell[starts] = True
    later = (p["doc"] != _first_of(p["doc"], starts)) | (p["place"] != _first_of(p["place"], starts))
    return later, tell


def address(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where the marks of a row go: rows of one id, null included, are told apart by their checksum."""
    return mix(doc.view(np.uint64) ^ mix(place >> np.uint64(32)))


Rule = Callable[[dict[str, np.ndarray]], tuple[np.ndarray, np.ndarray]]


def packer(buckets: int, rule: Rule) -> Packer:
    def combine(p):
        p, _ = _sorted(p)
        hit, tell = rule(p)
        told = {k: v[tell] for k, v in p.items()}
        done = {k: v[hit] for k, v in p.items()}
        # What is decided only travels on to its document; spread it by document.
        done["hash"] = address(done["doc"], done["place"])
        done["decided"] = np.ones(len(done["hash"]), np.uint8)
        both = {k: np.concatenate([told[k], done[k]]) for k in p}
        order = np.argsort(both["doc"], kind="stable")
        return {k: v[order] for k, v in both.items()}

    return Packer(buckets, POSTING, combine)


def deciding(rule: Rule, buckets: int):
    """The receiving side: places that the rule holds for, packed and addressed to their documents."""

    def task(batches):
        p = unpacked(batches, POSTING)
        decided = p["decided"] == 1
        done = {k: v[decided] for k, v in p.items()}
        p, _ = _sorted({k: v[~decided] for k, v in p.items()})
        hit, _ = rule(p)
        doc = np.concatenate([done["doc"], p["doc"][hit]])
        place = np.concatenate([done["place"], p["place"][hit]])
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], place[order]
        packer = Packer(buckets, FOUND)
        for at in range(0, len(doc), FLUSH):
            part = slice(at, at + FLUSH)
            yield from packer.add(hash=address(doc[part], place[part]), doc=doc[part], place=place[part])
        yield from packer.flush()

    return task


def _by_document(batches):
    """(doc_id, part, places): one row per document of the bucket."""
    p = unpacked(batches, FOUND)
    order = np.lexsort((p["place"], p["doc"]))
    doc, place = p["doc"][order], p["place"][order]
    part = (place >> np.uint64(32)).astype(np.int64)
    starts = groups(doc, part)
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(starts, len(doc)), pa.int32()),
        pa.array((place & np.uint64(0xFFFFFFFF)).astype(np.int32)),
    )
    yield pa.RecordBatch.from_arrays(
        [pa.array(doc[starts]), pa.array(part[starts]), lists], names=["doc_id", "part", "places"]
    )


def marks(posted: DataFrame, buckets: int, rule: Rule) -> DataFrame:
    """(doc_id, part, places): one row per document with a place that the rule holds for."""
    found = by_bucket(posted, buckets).mapInArrow(deciding(rule, buckets), schema_of(FOUND))
    return by_bucket(found, buckets).mapInArrow(_by_document, MARKS)


class Slice:
    """Tokens of some consecutive rows, with document, number and room to the document's end of each."""

    def __init__(self, doc: np.ndarray, part: np.ndarray, found: Tokens):
        counts = np.diff(found.bounds)
        self.hashes, self.counts, self.bounds = found.hashes, counts, found.bounds
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.number = np.arange(len(found.hashes)) - np.repeat(found.bounds[:-1], counts)
        self.length = np.repeat(counts, counts)
        self.doc, self.part = doc, part

    def postings(self, at: np.ndarray, hashes: np.ndarray) -> dict[str, np.ndarray]:
        """Postings of the windows that start at tokens `at`."""
        row = self.row[at]
        place = (self.part[row].astype(np.uint64) << np.uint64(32)) | self.number[at].astype(np.uint64)
        return {
            "hash": hashes,
            "doc": self.doc[row],
            "place": place,
            "decided": np.zeros(len(at), np.uint8),
        }


def token_slices(batch: pa.RecordBatch, separators: tuple[int, ...]):
    """(first row, Slice) for parts of a batch."""
    texts = column(batch, "text")
    doc = np.asarray(column(batch, "doc_id"), np.int64)
    part = np.asarray(column(batch, "part"), np.int64)
    for lo, hi in slices(texts):
        yield lo, Slice(doc[lo:hi], part[lo:hi], tokens(texts.slice(lo, hi - lo), separators))


def covered(starts: np.ndarray, window: int, count: int) -> np.ndarray:
    """Which of `count` tokens lie in a window that begins at one of `starts`."""
    edges = np.zeros(count + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + window, count), -1)
    return np.cumsum(edges[:count]) > 0


def posting_schema() -> str:
    return schema_of(POSTING)
