"""Substring deduplication with difference-cover anchors.

COVER is a difference cover modulo PERIOD: for any two places some shift below PERIOD
brings both onto it. Windows of ANCHOR words are hashed only at places on the cover, so
any passage of WINDOW = ANCHOR + PERIOD - 1 words that two documents share contains an
anchor that both of them hash, whatever the alignment.

Anchors that several documents hold are then extended: only the WINDOW-word windows
around them are hashed, and a window that also starts in a document with a smaller id
marks its words for removal.
"""

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberlog.llm import repeats
from emberlog.llm.staging import partitions, written
from emberlog.llm.words import WHITESPACE, column, windows

WINDOW = 50
#: A perfect difference set, every residue modulo 31 is a difference of two members.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)


def _anchors(window: int, buckets: int):
    anchor = window - PERIOD + 1
    on_cover = np.zeros(PERIOD, bool)
    on_cover[list(COVER)] = True

    def task(batches):
        packer = repeats.packer(buckets, repeats.shared)
        for batch in batches:
            for _, piece in repeats.token_slices(batch, WHITESPACE):
                hashes = windows(piece.hashes, anchor)
                room = slice(0, len(hashes))
                fits = (piece.number[room] + anchor <= piece.length[room]) & (piece.length[room] >= window)
                at = np.flatnonzero(fits & on_cover[piece.number[room] % PERIOD])
                if len(at):
                    yield from packer.add(**piece.postings(at, hashes[at]))
        yield from packer.flush()

    return task


def _extended(window: int, buckets: int):
    reach = PERIOD - 1

    def task(batches):
        packer = repeats.packer(buckets, repeats.later_document)
        for batch in batches:
            places = column(batch, "places")
            for lo, piece in repeats.token_slices(batch, WHITESPACE):
                hashes = windows(piece.hashes, window)
                near = np.zeros(len(piece.hashes) + 1, np.int32)
                for row, (first, count) in enumerate(zip(piece.bounds[:-1], piece.counts)):
                    anchors = np.asarray(places[lo + row].values, np.int64)
                    anchors = anchors[anchors < count]
                    np.add.at(near, first + np.maximum(anchors - reach, 0), 1)
                    np.add.at(near, first + anchors + 1, -1)
                room = slice(0, len(hashes))
                fits = piece.number[room] + window <= piece.length[room]
                at = np.flatnonzero(fits & (np.cumsum(near)[room] > 0))
                if len(at):
                    yield from packer.add(**piece.postings(at, hashes[at]))
        yield from packer.flush()

    return task


def _removal(window: int):
    def task(batches):
        for batch in batches:
            total, removed, kept = [], [], []
            for text, starts in zip(column(batch, "text"), column(batch, "places")):
                words = text.as_buffer().to_pybytes().split()
                gone = 0
                if starts.is_valid:
                    out = repeats.covered(np.asarray(starts.values, np.int64), window, len(words))
                    gone = int(out.sum())
                    kept.append(b" ".join(compress(words, (~out).tolist())))
                else:
                    kept.append(b" ".join(words))
                total.append(len(words))
                removed.append(gone)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    return task


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) per row of `docs` (columns doc_id, text; others are ignored).

    Words are cut at ASCII whitespace and otherwise unchanged. A word goes if it lies in a
    window of `window` words whose sequence also starts in a document with a smaller
    doc_id; windows are those of the input. A null text has no words; a null doc_id is
    larger than every other. Rows that share a doc_id are not smaller than each other.
    """
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    buckets = partitions(docs)
    base = repeats.keyed(docs)
    anchors = repeats.marks(
        base.mapInArrow(_anchors(window, buckets), repeats.posting_schema()), buckets, repeats.shared
    )
    anchored = written(anchors, "anchors")
    windows_of = base.join(anchored.hint("shuffle_hash"), ["doc_id", "part"]).mapInArrow(_extended(window, buckets), repeats.posting_schema())
    repeated = written(repeats.marks(windows_of, buckets, repeats.later_document), "repeated")
    result = base.join(repeated.hint("shuffle_hash"), ["doc_id", "part"], "left").mapInArrow(
        _removal(window), "doc_id long, n_words long, n_removed long, kept_text string"
    )
    return result.select(repeats.original_id(), "n_words", "n_removed", "kept_text")
