"""A shuffle of packed postings.

Postings (numpy columns led by a 64-bit hash) are cut into buckets by hash inside
each task and shipped as one row per bucket and flush, their columns as raw
little-endian bytes. Spark partitions and shuffles those rows; the tasks on the other
side see whole buckets as numpy arrays. Compared with one row per posting this saves
most of the row overhead on both sides.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

FLUSH = 1 << 19


class Packer:
    """Collects postings and gives them back as batches of packed rows."""

    def __init__(self, buckets: int, kinds: dict[str, type], combine: Callable | None = None):
        self.buckets, self.kinds, self.combine = buckets, kinds, combine
        self.parts, self.held = [], 0

    def add(self, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.held += len(columns["hash"])
        if self.held >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        columns = {k: np.concatenate([p[k] for p in self.parts]).astype(t, copy=False) for k, t in self.kinds.items()}
        self.parts, self.held = [], 0
        if self.combine:
            columns = self.combine(columns)
        bucket = ((columns["hash"] >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        order = np.argsort(bucket.astype(np.uint16 if self.buckets < 1 << 16 else np.uint64), kind="stable")
        columns = {k: v[order] for k, v in columns.items()}
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1, dtype=np.uint64))
        full = np.flatnonzero(np.diff(cuts))
        arrays = [pa.array(full, pa.int32())]
        for values in columns.values():
            arrays.append(pa.array([values[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()))
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def schema_of(kinds: dict[str, type]) -> str:
    return "bucket int, " + ", ".join(f"{name} binary" for name in kinds)


def by_bucket(packed: DataFrame, buckets: int) -> DataFrame:
    return packed.repartitionById(buckets, "bucket")


def unpacked(batches: Iterable[pa.RecordBatch], kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """All postings that reached this task."""
    parts = {name: [] for name in kinds}
    for batch in batches:
        for name in kinds:
            parts[name] += [x.as_buffer() for x in batch.column(batch.schema.get_field_index(name))]
    return {name: np.frombuffer(b"".join(parts[name]), kind) for name, kind in kinds.items()}


def groups(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin in sorted arrays."""
    if not len(keys[0]):
        return np.empty(0, np.int64)
    fresh = np.zeros(len(keys[0]), bool)
    fresh[0] = True
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(fresh)
