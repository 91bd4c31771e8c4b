"""Token counts with a whole-token shortcut.

A byte-level tokenizer cuts a text into pre-tokens and merges each by itself. Which
vocabulary strings come out of the merges as one token is proved once, on the driver, by
encoding every one of them. In the tasks pre-tokens found in that proven set count one
without merging; only the distinct rest of a batch goes through the merges.

The cut is computed for whole Arrow batches with numpy. The class of a character (letter,
number, white space, other) is asked of the tokenizer's own cutter, once per character, so
no other Unicode version comes in.
"""

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from emberlog.llm.words import column, slices

#: Merge results kept from batch to batch within a task, of pre-tokens up to so many bytes.
REMEMBERED = 1 << 19
REMEMBERED_BYTES = 64

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: Endings that a lone apostrophe forms a pre-token with.
ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


def checked(spec: str) -> dict:
    """The parsed tokenizer file, if it is of the kind whose pre-tokens this module can cut."""
    parsed = json.loads(spec)
    cutter = parsed.get("pre_tokenizer") or {}
    plain = parsed.get("normalizer") is None and parsed["model"]["type"] == "BPE" and not parsed["model"].get("dropout")
    level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    added = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in parsed["added_tokens"])
    if not (plain and level and added):
        raise ValueError("only byte-level BPE without normalizer, prefix space and stripping added tokens is supported")
    return parsed


def merging_only(spec: str):
    """The tokenizer without its cut and without added tokens: merges what it is given."""
    from tokenizers import Tokenizer

    parsed = checked(spec)
    parsed["pre_tokenizer"]["use_regex"] = False
    return Tokenizer.from_str(json.dumps(parsed | {"added_tokens": [], "post_processor": None, "truncation": None, "padding": None}))


def whole_tokens(spec: str) -> list[bytes]:
    """Every vocabulary string that, encoded by itself, is exactly its own token."""
    merger = merging_only(spec)
    ids = sorted(merger.get_vocab().values())
    texts = [merger.decode([i], skip_special_tokens=False) for i in ids]
    encoded = merger.encode_batch(texts, add_special_tokens=False)
    return [text.encode() for i, text, e in zip(ids, texts, encoded) if e.ids == [i]]


class Cutter:
    """Where the pre-tokens of texts begin."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.cut = Tokenizer.from_str(spec).pre_tokenizer.pre_tokenize_str
        self.kinds = np.zeros(0x110000, np.uint8)
        special = sorted((t["content"] for t in checked(spec)["added_tokens"]), key=len, reverse=True)
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in special)) if special else None
        self._learn(np.arange(128))

    def _learn(self, points: np.ndarray) -> None:
        for point in points.tolist():
            char = chr(point)
            one = [len(self.cut(before + char)) == 1 for before in "a1!"]
            self.kinds[point] = LETTER if one[0] else NUMBER if one[1] else OTHER if one[2] else SPACE

    def starts(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Byte offsets of all pre-tokens. `raw` holds the texts, text i up to `ends[i + 1]`."""
        at = np.flatnonzero((raw & 0xC0) != 0x80)
        point = _code_points(raw, at)
        new = np.unique(point[self.kinds[point] == 0])
        if len(new):
            self._learn(new)
        kind = self.kinds[point]
        n = len(point)
        first = np.zeros(n + 1, bool)
        first[np.searchsorted(at, ends)] = True
        first[n] = True
        begins = first[:n].copy()
        begins[1:] |= kind[1:] != kind[:-1]
        runs = np.flatnonzero(begins)
        upto = np.append(runs[1:], n)
        blank = point == 32
        spaces = kind[runs] == SPACE
        out = begins.copy()
        # A text run takes one blank before it.
        led = runs[~spaces]
        led = led[~first[led]]
        out[led[blank[led - 1]]] = False
        # White space before more text gives its last character away; at the end of a text it stays whole.
        inner = spaces & ~first[upto]
        out[upto[inner] - 1] = True
        # A lone apostrophe and its ending.
        lone = runs[(upto - runs == 1) & (point[runs] == 39)]
        lone = lone[out[lone]]
        for ending in ENDINGS:
            size = len(ending)
            fits = lone[lone + size < n]
            for k, letter in enumerate(ending, 1):
                fits = fits[(point[fits + k] == ord(letter)) & ~first[fits + k]]
            out[fits + 1] = False
            after = fits + size + 1
            out[after[after < n]] = True
        begin = at[out]
        return self._with_special(raw, ends, begin) if self.special else begin

    def _with_special(self, raw: np.ndarray, ends: np.ndarray, begin: np.ndarray) -> np.ndarray:
        data = raw.tobytes()
        if not self.special.search(data):
            return begin
        parts, lo = [], 0
        for text in range(len(ends) - 1):
            a, b = int(ends[text]), int(ends[text + 1])
            found = [(a + m.start(), a + m.end()) for m in self.special.finditer(data[a:b])]
            if not found:
                continue
            parts.append(begin[(begin >= lo) & (begin < a)])
            # What lies between special strings is cut as texts of their own.
            edges = [a, *[x for pair in found for x in pair], b]
            for k, (x, y) in enumerate(zip(edges, edges[1:])):
                if x == y:
                    continue
                whole = k % 2 == 1
                piece = raw[x:y]
                parts.append(np.array([x]) if whole else x + Cutter.starts(self._plain(), piece, np.array([0, y - x])))
            lo = b
        parts.append(begin[begin >= lo])
        return np.concatenate(parts)

    def _plain(self) -> "Cutter":
        plain = object.__new__(Cutter)
        plain.cut, plain.kinds, plain.special = self.cut, self.kinds, None
        return plain


def _code_points(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    lead = raw[at].astype(np.int64)
    point = lead.copy()
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        some = np.flatnonzero((lead >= low) & (lead < (0xF8 if size == 4 else low + (0x20 if size == 2 else 0x10))))
        if len(some):
            value = lead[some] & mask
            for k in range(1, size):
                value = (value << 6) | (raw[at[some] + k] & 0x3F)
            point[some] = value
    return point


class Counter:
    def __init__(self, spec: str, whole: list[bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.cutter, self.merger = Cutter(spec), merging_only(spec)
        alone = whole + [t["content"].encode() for t in checked(spec)["added_tokens"]]
        self.whole = pa.array(alone, pa.large_binary())
        self.known: dict[bytes, int] = {}

    def count(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, tokens and pre-tokens counted by the shortcut, of each text."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        ends = offsets - offsets[0]
        sizes = np.diff(ends)
        if not ends[-1]:
            nothing = np.zeros(len(texts), np.int64)
            return sizes, nothing, nothing
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        begin = self.cutter.starts(raw, ends)
        bounds = np.append(begin, ends[-1]).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        shortcut = np.asarray(pc.is_in(distinct, value_set=self.whole))
        tokens = np.ones(len(distinct), np.int64)
        rest = np.flatnonzero(~shortcut)
        tokens[rest] = self._merged(distinct.take(pa.array(rest)).to_pylist())
        index = np.asarray(coded.indices)
        place = np.searchsorted(begin, ends)
        total = np.concatenate([[0], np.cumsum(tokens[index])])
        direct = np.concatenate([[0], np.cumsum(shortcut[index].astype(np.int64))])
        return sizes, np.diff(total[place]), np.diff(direct[place])

    def _merged(self, pieces: list[bytes]) -> list[int]:
        new = [p for p in pieces if p not in self.known]
        encoded = self.merger.encode_batch([p.decode() for p in new], add_special_tokens=False)
        fresh = {p: len(e.ids) for p, e in zip(new, encoded)}
        counts = [fresh[p] if p in fresh else self.known[p] for p in pieces]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        self.known.update((p, k) for p, k in fresh.items() if len(p) <= REMEMBERED_BYTES)
        return counts


def _counting(shared, keep: list[str]):
    def task(batches):
        counter = None
        for batch in batches:
            counter = counter or Counter(*shared.value)
            texts = column(batch, "text")
            parts = [counter.count(texts.slice(lo, hi - lo)) for lo, hi in slices(texts)]
            counts = [pa.array(np.concatenate([p[k] for p in parts] or [np.empty(0, np.int64)]), pa.int64()) for k in range(3)]
            arrays = [column(batch, name) for name in keep]
            yield pa.RecordBatch.from_arrays([*arrays, *counts], names=[*keep, "n_bytes", "n_tokens", "n_whole"])

    return task


def with_token_counts(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns `keep` of `docs`, with n_bytes, n_tokens and n_whole (pre-tokens that no merge was needed for) of `text`.

    `tokenizer` is a byte-level BPE file of the tokenizers library; the driver reads it and the
    tasks get its content. Counts equal the library's own for the whole text without special
    tokens added; strings of added tokens inside a text count one. Null and empty texts have
    0 bytes and 0 tokens. Rows that repeat are counted one by one; `keep` may name any columns
    but the three new ones. One pass, no shuffle; a text of any length is one row of one task.
    """
    with open(tokenizer, encoding="utf-8") as file:
        spec = file.read()
    shared = docs.sparkSession.sparkContext.broadcast((spec, whole_tokens(spec)))
    new = [T.StructField(name, T.LongType()) for name in ("n_bytes", "n_tokens", "n_whole")]
    kept = docs.select(*[f"`{name}`" for name in keep])
    picked = docs.select(*[f"`{name}`" for name in keep], *([] if "text" in keep else ["text"]))
    return picked.mapInArrow(_counting(shared, keep), T.StructType([*kept.schema.fields, *new]))
