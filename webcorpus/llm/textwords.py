"""Words, hashes and Arrow plumbing shared by the text operators.

Texts are handled as UTF-8 bytes in numpy arrays: words are found with a
256-entry byte class table, hashed with a polynomial over their bytes and
combined into window hashes with prefix sums, so no per-word Python object
exists.  Hashes are 64 bits wide; two different words or windows of one
corpus get equal hashes with a probability of about n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
BLOCK = 1 << 18  # bytes or words hashed at a time: the temporaries stay in cache


def byte_class(separators: Iterable[int]) -> np.ndarray:
    """True for bytes that belong to words; multi-byte characters always do."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: words ``[^\x20\x09-\x0D]+``
BLANK_SEPARATED = byte_class([0x20, *range(0x09, 0x0E)])
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text, so A-Z count as well
ALPHANUMERIC = byte_class([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK + 64)
            self.up, self.down = (np.cumprod(np.r_[U64(1), np.full(size - 1, b, dtype=U64)], dtype=U64)
                                  for b in (self.base, self.inverse))
        return self.up, self.down


_BYTES, _WORDS = _Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> U64(32))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(29))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(32))


def find_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text (plus one) the number of words before it."""
    inside = table[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, side="right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _BYTES.upto(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, dtype=U64)
        np.cumsum((data[lo:hi].astype(U64) + U64(1)) * up[:hi - lo], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * down[starts[i:j] - lo]
        i = j
    return mix(out)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, windows that cross texts included."""
    n = max(0, len(words) - k + 1)
    out = np.empty(n, dtype=U64)
    for i in range(0, n, BLOCK):
        j = min(n, i + BLOCK)
        part = words[i:j + k - 1]
        up, down = _WORDS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=U64)
        np.cumsum(part * up[:len(part)], out=sums[1:])
        out[i:j] = (sums[k:] - sums[:-k]) * down[:j - i]
    return mix(out + U64(k))


def window_starts(word_offsets: np.ndarray, k: int) -> np.ndarray:
    """True for the word positions (all texts concatenated) at which a k-word window of one text starts."""
    n = int(word_offsets[-1])
    ok = np.ones(max(0, n - k + 1), dtype=bool)
    if len(ok):
        # the last k-1 positions of each text start no window
        marks = np.zeros(n + 1, dtype=np.int32)
        ends = word_offsets[1:]
        np.add.at(marks, np.maximum(ends - (k - 1), word_offsets[:-1]), 1)
        np.add.at(marks, ends, -1)
        ok &= np.cumsum(marks)[:len(ok)] == 0
    return ok


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (first 0) of a string column without copying; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def regroup(batches: Iterator[pa.RecordBatch], column: int, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Batches cut or joined so that the texts of each hold about ``max_bytes`` (one longer text stands alone)."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.diff(text_buffers(batch.column(column))[1]) + 64  # rows without text take room too
        total, lo = np.cumsum(lengths), 0
        while lo < batch.num_rows:
            base = total[lo - 1] if lo else 0
            hi = max(lo + (0 if held else 1), int(np.searchsorted(total, base + max_bytes - size, side="right")))
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                size += int(total[hi - 1] - base)
            if hi < batch.num_rows:
                yield _joined(held)
                held, size = [], 0
            lo = hi
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def annotate(df: DataFrame, text_col: str, keep: list[str], fields: T.StructType,
             make: Callable[[], Callable[[np.ndarray, np.ndarray], dict]], chunk_bytes: int,
             keep_if: str | None = None) -> DataFrame:
    """Columns ``keep`` and the computed ``fields`` of every row, without a shuffle.

    ``make()`` runs once a task and returns a function from (bytes, offsets)
    of a chunk of texts to a dict of arrays, one entry per row.  ``keep_if``
    names a computed boolean: rows where it is false are left out before
    they leave Python.  Kept columns and fields are carried under positional
    names, so equal names do not clash inside.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    src = df.select(F.col(_q(text_col)).cast("string").alias("t"), *[F.col(_q(c)).alias(f"c{i}") for i, c in enumerate(keep)])
    inner = T.StructType([T.StructField(f"c{i}", src.schema[f"c{i}"].dataType) for i in range(len(keep))]
                         + [T.StructField(f"f{i}", f.dataType) for i, f in enumerate(fields)])
    names = [f.name for f in fields]

    def run(batches):
        fn, schema = make(), to_arrow_schema(inner)
        for batch in regroup(batches, 0, chunk_bytes):
            got = fn(*text_buffers(batch.column(0)))
            cols = [batch.column(i + 1) for i in range(len(keep))]
            cols += [pa.array(got[n], type=schema.field(len(keep) + i).type) for i, n in enumerate(names)]
            out = pa.RecordBatch.from_arrays([c.cast(schema.field(i).type) for i, c in enumerate(cols)], schema=schema)
            yield out.filter(pa.array(got[keep_if])) if keep_if else out

    out = src.mapInArrow(run, inner)
    return out.toDF(*keep, *names)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str):
    """Column by its exact name, dots and backquotes included."""
    return F.col(_q(name))


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; ``offsets`` count values."""
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


class HashIndex:
    """Places of distinct 64-bit keys, looked up for whole arrays at a time (open addressing)."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.mask = (1 << max(4, int(4 * len(keys)).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, dtype=np.int32)
        left, at = np.arange(len(keys)), (keys & U64(self.mask)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slots[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            self.slots[at[free[one]]] = left[free[one]]
            rest = self.slots[at] != left
            left, at = left[rest], (at[rest] + 1) & self.mask

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Place of each wanted key, -1 where there is none."""
        at = (wanted & U64(self.mask)).astype(np.int64)
        out = self.slots[at]
        if not len(self.keys):
            return out
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != wanted))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            got = self.slots[at[open_]]
            out[open_] = got
            open_ = open_[(got >= 0) & (self.keys[got] != wanted[open_])]
        return out
