"""Line deduplication by overlapping three-line windows.

Consecutive non-empty lines are hashed in windows of WINDOW; of each window that occurs
more than once in the corpus the first occurrence (by doc_id, then place) stays, and the
lines covered by any later one are removed.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from emberlog.llm import repeats
from emberlog.llm.staging import partitions, written
from emberlog.llm.words import NEWLINE, column, windows

WINDOW = 3


def _windows(window: int, buckets: int):
    def task(batches):
        packer = repeats.packer(buckets, repeats.later_place)
        for batch in batches:
            for _, piece in repeats.token_slices(batch, NEWLINE):
                hashes = windows(piece.hashes, window)
                room = slice(0, len(hashes))
                at = np.flatnonzero(piece.number[room] + window <= piece.length[room])
                if len(at):
                    yield from packer.add(**piece.postings(at, hashes[at]))
        yield from packer.flush()

    return task


def _removal(window: int):
    def task(batches):
        for batch in batches:
            total, removed, kept = [], [], []
            for text, starts in zip(column(batch, "text"), column(batch, "places")):
                raw = text.as_buffer().to_pybytes()
                lines = raw.split(b"\n")
                full = [i for i, line in enumerate(lines) if line]
                gone = set()
                if starts.is_valid:
                    out = repeats.covered(np.asarray(starts.values, np.int64), window, len(full))
                    gone = {full[i] for i in np.flatnonzero(out)}
                    raw = b"\n".join(line for i, line in enumerate(lines) if i not in gone)
                total.append(len(full))
                removed.append(len(gone))
                kept.append(raw)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_lines", "n_removed", "kept_text"],
            )

    return task


def remove_repeated_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_text) per row of `docs` (columns doc_id, text; others are ignored).

    Lines are cut at newlines; empty lines are no part of a window and stay. A document of
    fewer than `window` lines keeps all. A null text counts as empty; a null doc_id comes
    after all others. Rows repeated with the same doc_id and text are one occurrence.
    """
    buckets = partitions(docs)
    base = repeats.keyed(docs)
    posted = base.mapInArrow(_windows(window, buckets), repeats.posting_schema())
    repeated = written(repeats.marks(posted, buckets, repeats.later_place), "lines")
    result = base.join(repeated.hint("shuffle_hash"), ["doc_id", "part"], "left").mapInArrow(
        _removal(window), "doc_id long, n_lines long, n_removed long, kept_text string"
    )
    return result.select(repeats.original_id(), "n_lines", "n_removed", "kept_text")
