"""Whole texts as byte arrays inside Python tasks, and hashes of their words.

Everything here works on one Arrow batch of a task: the UTF-8 bytes of all its texts
lie in one array, and words, lines and shingles are index arrays into it.
"""

from __future__ import annotations

import pickle
import sys
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.session import ship_package

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PIECES = "start long, size long, crc32 long, piece binary"
_PIECE, _FETCHES = 1 << 19, 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package()
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: str | Column, n: int) -> Column:
    """crc32 of a key written as text, modulo ``n``; decides what a learner may see."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % n


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, the same ones on every run: the smallest by hash of ``key``."""
    order = F.xxhash64(F.col(key))
    return df.orderBy(order, F.col(key)).limit(most)


def pieces_of(value: object) -> Iterator[pa.RecordBatch]:
    """``value`` pickled and cut into pieces, rows of ``PIECES``."""
    data = pickle.dumps(value, protocol=5)
    for start in range(0, len(data), _PIECE):
        piece = data[start : start + _PIECE]
        row = [pa.array([start]), pa.array([len(data)]), pa.array([zlib.crc32(data)]), pa.array([piece], pa.binary())]
        yield pa.RecordBatch.from_arrays(row, ["start", "size", "crc32", "piece"])


def joined(pieces: DataFrame) -> object | None:
    """The value of ``pieces_of``; None without a row.  The driver's JVM holds a few pieces at a time, never the whole."""
    data = None
    for row in pieces.repartition(_FETCHES).toLocalIterator():
        data = data or bytearray(row["size"])
        data[row["start"] : row["start"] + len(row["piece"])] = row["piece"]
    if data is not None and zlib.crc32(data) != row["crc32"]:
        raise RuntimeError("pieces are missing, or a task that ran again made others")
    return None if data is None else pickle.loads(data)


def worker_cache(name: str, build: Callable[[], object]) -> object:
    """A value kept in a Python worker from task to task."""
    held = sys.modules.setdefault("_layerframe_worker_cache", ModuleType("_layerframe_worker_cache")).__dict__
    if name not in held:
        held[name] = build()
    return held[name]


@dataclass
class Texts:
    """The texts of some rows: ``data[starts[i]:ends[i]]`` is the UTF-8 of row i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def sizes(self) -> np.ndarray:
        return self.ends - self.starts


def texts_of(column: pa.Array) -> Texts:
    """Byte view of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    low, high = offsets[0], offsets[-1]
    data = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.zeros(0, np.uint8)
    return Texts(data, offsets[:-1] - low, offsets[1:] - low)


def batches_by_size(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches between rows so that a piece holds about ``most`` bytes of text, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = texts_of(batch.column(column)).ends
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _worker_powers(n: int, inverse: bool) -> np.ndarray:
    held = worker_cache(f"powers-{inverse}", lambda: [powers(1 << 16, _INVERSE if inverse else _MULTIPLIER)])
    if len(held[0]) < n:
        held[0] = powers(max(n, 2 * len(held[0])), _INVERSE if inverse else _MULTIPLIER)
    return held[0][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """64-bit hash of each span of bytes, by differences of one running polynomial sum.

    Spans come in ascending order; they are taken in blocks of about ``block`` bytes.
    """
    out = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        base = starts[low]
        high = max(low + 1, int(np.searchsorted(starts, base + block)))
        part = data[base : ends[low:high].max()]
        sums = np.zeros(len(part) + 1, np.uint64)
        values = part.astype(np.uint64)
        values += np.uint64(1)
        values *= _worker_powers(len(part), False)
        np.cumsum(values, out=sums[1:])
        a, b = starts[low:high] - base, ends[low:high] - base
        out[low:high] = mix((sums[b] - sums[a]) * _worker_powers(len(part) + 1, True)[a])
        low = high
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Words:
    """Maximal runs without white space: their spans, and the row of each."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray  # index of each row's first word; one more at the end

    def __len__(self) -> int:
        return len(self.starts)


def words_of(texts: Texts, inside: np.ndarray | None = None) -> Words:
    """Words of all rows.  ``inside`` marks the byte values that words are made of."""
    keep = ~_SPACE[texts.data] if inside is None else inside[texts.data]
    n = len(keep)
    edge = np.zeros(n + 1, bool)
    if n:
        edge[0] = keep[0]
        edge[n] = keep[-1]
        np.not_equal(keep[1:], keep[:-1], out=edge[1:n])
        # a row's end also ends its last word
        seam = texts.starts[(texts.starts > 0) & (texts.starts < n)]
        joined = np.unique(seam[keep[seam] & keep[seam - 1]])
    places = np.flatnonzero(edge)
    if n and len(joined):
        places = np.sort(np.concatenate([places, joined, joined]))
    starts, ends = places[0::2], places[1::2]
    first = np.searchsorted(starts, np.append(texts.starts, n))
    # rows without words keep an empty range
    row = np.repeat(np.arange(len(texts)), np.diff(first)) if len(texts) else np.zeros(0, np.int64)
    return Words(starts, ends, row, first)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]
