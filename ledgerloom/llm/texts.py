"""Text columns as flat byte arrays.

An Arrow string column already is one byte buffer with offsets. Words, their hashes and their windows are
worked out on that buffer with numpy, so no Python object is made per word. A null text counts as an empty one.

Word hashes are 64 bits wide: the sum of ``table[byte] * M**i`` over the bytes of the word modulo 2**64, mixed.
The sum of a word is the difference of two prefix sums, divided by the power of M at its start, which is a
multiplication since an odd M has an inverse modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import ship_package

#: fixed value: ASCII white space, the separators of plain words
SPACES = b" \t\n\x0b\x0c\r"
#: bytes of text worked on at once; a longer text stands alone
CHUNK = 1 << 20

_M = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}


def byte_table(separators: bytes, lower: bool = False) -> np.ndarray:
    """A 64-bit value for each byte, 0 for separators; ``lower`` gives A-Z the values of a-z."""
    table = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


#: words between white space as they are, and with A-Z lowered
PLAIN = byte_table(SPACES)
LOWERED = byte_table(SPACES, lower=True)
#: words of digits, a-z and bytes from 0x80 on, A-Z lowered
ALNUM = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def map_batches(rows: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``rows`` through ``fn``, batch by batch, in Python workers that know this package."""
    ship_package(rows.sparkSession)
    return rows.mapInArrow(fn, schema)


def schema_of(rows: DataFrame) -> str:
    """The columns of ``rows`` as schema text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def without(rows: DataFrame, *new: str) -> DataFrame:
    """``rows`` without the columns that new ones replace."""
    return rows.drop(*new)


def held(rows: DataFrame) -> DataFrame:
    """``rows`` with all columns under names that no operator gives; ``released`` undoes it."""
    return rows.toDF(*[f"_in_{c}" for c in rows.columns])


def released(rows: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of the rows that ``held`` took, some with new values."""
    return rows.select(*[new.get(c, F.col(f"`_in_{c}`")).alias(c) for c in columns])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the bounds of its rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(pc.cast(column, pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``limit`` bytes of text, or one row, with their bytes and bounds."""
    for batch in batches:
        data, bounds = flat(batch.column(batch.schema.get_field_index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
            lo = hi


def spans(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of every word, and the bounds of each row in the list of words."""
    inside = np.concatenate([(table != 0)[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:]
    ends = inside[:-1] & (~inside[1:] | edge[1:])
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, bounds)


def _power(base: int, n: int) -> np.ndarray:
    key = str(base)
    if len(_POWERS.get(key, ())) < n:
        size = max(CHUNK + 1, n)
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        grown = np.cumprod(powers)
        if size > CHUNK + 1:  # a single huge text: not kept
            return grown
        _POWERS[key] = grown
    return _POWERS[key]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The hash of every word."""
    return span_hashes(table[data], starts, ends)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for the values from each start to its end."""
    n = len(values) + 1
    sums = np.zeros(n, np.uint64)
    np.cumsum(values * _power(_M, n)[: n - 1], out=sums[1:])
    inverse = _power(pow(_M, -1, 1 << 64), n)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word, and the bounds of each row in the list of words."""
    starts, ends, first = spans(data, bounds, table)
    return hashes(data, starts, ends, table), first


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of ``k`` words; at least one word less than ``k`` stands at the end without one.
    Runs that cross from one row into the next are hashed too: the caller leaves them out."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    out = h[:n].copy()
    for j in range(1, k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[j : n + j]
    return mix(out + np.uint64(k))


def whole(h: np.ndarray) -> np.ndarray:
    """One hash for a whole short sequence, told apart from others by its length."""
    return windows(h, len(h)) if len(h) else np.zeros(0, np.uint64)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of every word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))
