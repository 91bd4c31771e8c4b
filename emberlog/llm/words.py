"""Hashes of words, lines and windows of whole Arrow batches, computed column-wise with numpy."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WHITESPACE = (9, 10, 11, 12, 13, 32)
NEWLINE = (10,)
SLICE_BYTES = 2 << 20
POWERS = 1 << 12

_random = np.random.Generator(np.random.PCG64(20240511))
_BYTE = _random.integers(1, 2**63, size=256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWER = np.cumprod(np.full(POWERS, _BASE, np.uint64))
_STEP = _random.integers(1, 2**63, size=64, dtype=np.uint64) | np.uint64(1)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _byte_values(separators: tuple[int, ...], lower: bool) -> np.ndarray:
    table = _BYTE.copy()
    if lower:
        table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


class Tokens:
    """The tokens of some texts: `hashes` in order, and `bounds[i]:bounds[i + 1]` of text i."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray):
        self.hashes, self.bounds = hashes, bounds


def tokens(
    texts: pa.Array, separators: tuple[int, ...] = WHITESPACE, lower: bool = False, prefix: int | None = None
) -> Tokens:
    """Hashes of the maximal runs of bytes other than `separators`; a null text has none.

    With `prefix`, of the first bytes of each run only.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first = int(offsets[0]) if len(texts) else 0
    size = int(offsets[-1]) - first if len(texts) else 0
    if not size:
        return Tokens(np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    raw = np.frombuffer(data, np.uint8)[first : first + size]
    ends = offsets - first
    value = _byte_values(separators, lower)[raw]
    inside = value != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = ends[:-1][ends[:-1] < size]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return Tokens(np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64))
    # Place of each byte within its token; separators weigh nothing.
    place = np.arange(size, dtype=np.int64)
    lengths = np.diff(np.append(starts, size))
    place[starts[0] :] -= np.repeat(starts, lengths)
    value *= _POWER[place & (POWERS - 1)]
    if prefix:
        value[place >= prefix] = 0
    sums = np.add.reduceat(value, starts)
    return Tokens(mix(sums), np.searchsorted(starts, ends))


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about SLICE_BYTES of text, a single larger text by itself."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(texts), 0))
    total = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < len(texts):
        used = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, used + SLICE_BYTES, "right")))
        yield at, min(to, len(texts))
        at = to


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive tokens, by doubling: log(size) passes whatever the size."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    known, length, level = hashes, 1, 0
    out, done = None, 0
    left = size
    while left:
        if left & 1:
            part = known[done : done + len(hashes) - size + 1]
            out = part if out is None else mix(out * _STEP[level] + part)
            done += length
        left >>= 1
        if left:
            known = mix(known[:-length] * _STEP[level + 32] + known[length:])
            length *= 2
            level += 1
    return out if out is not None else np.empty(0, np.uint64)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column called exactly `name`."""
    return batch.column(batch.schema.get_field_index(name))
