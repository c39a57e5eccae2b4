"""Packing along a space-filling curve.

Each document's token ids are hashed to a vector, projected to three dimensions and
given a Hilbert key there.  Documents are range-sorted by that key, so that neighbours
on the curve, and copies above all, come to lie together; each range is then filled
into sequences without gaps.  Documents are cut wherever a sequence is full, so only
the last sequence of a range is not.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.llm import text
from layerframe.llm.counts import vocabulary
from layerframe.plans.scratch import scratch_path

DIMENSIONS, BITS = 3, 16
_HELD_BYTES, _LONGEST_HELD = 16 << 20, 256
# The pre-tokenizer pattern of byte-level vocabularies, and the same in
# Python's own, faster expressions for texts whose characters both classify alike.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PLAIN_PIECE = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_NOT_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ]")


class PieceIds(dict):
    """Ids of a pre-token, as bytes, kept by pre-token; cleared when they hold ``_HELD_BYTES``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._cut = re.compile("(" + "|".join(re.escape(t) for t in self._special) + ")")
        self._ids = _merger(path, spec["model"], self._special)
        self._held = 0

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        ids = np.array(self._ids(data), np.uint32).tobytes()
        if len(data) <= _LONGEST_HELD:
            self._held += len(data) + len(ids)
            if self._held > _HELD_BYTES:
                self.clear()
                self._held = 0
            self[piece] = ids
        return ids

    def encode(self, whole: str) -> bytes:
        """Ids of a whole text; a special string inside it is its one id."""
        if "<|" in whole:
            return b"".join(
                np.uint32(self._special[p]).tobytes() if p in self._special else self._plain(p) for p in self._cut.split(whole)
            )
        return self._plain(whole)

    def _plain(self, part: str) -> bytes:
        pattern = _PIECE if _NOT_PLAIN.search(part) else _PLAIN_PIECE
        return b"".join(map(self.__getitem__, pattern.findall(part)))


def _merger(path: str, model: dict, special: dict[str, int]) -> Callable[[bytes], list[int]]:
    """Merges the bytes of one pre-token into ids.

    Where ids ascend with the rank of the merges, as in vocabularies of the usual make, the
    lower id is the earlier merge, and the faster library needs only the bytes of each token.
    """
    vocab = model["vocab"]
    made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    letters = _byte_letters()
    if all(a < b for a, b in zip(made, made[1:])):
        import tiktoken

        byte_of = {chr(letter): byte for byte, letter in letters.items()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
        return tiktoken.Encoding("pieces", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda data: [t.id for t in tokenizer.model.tokenize(data.decode("latin-1").translate(letters))]


def _byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte, for ``str.translate``."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return {b: b if b in visible else next(hidden) for b in range(256)}


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of points with whole coordinates below ``2**bits``.

    Works on all points at once: from the highest bit down every axis is reflected or
    swapped with the first, then the axes are Gray-coded and their bits interleaved.
    """
    axes = [points[:, d].astype(np.int64).copy() for d in range(points.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        below = q - 1
        for d in range(len(axes)):
            high = (axes[d] & q) > 0
            swap = np.where(high, 0, (axes[0] ^ axes[d]) & below)
            axes[0] = np.where(high, axes[0] ^ below, axes[0] ^ swap)
            if d:
                axes[d] ^= swap
        q >>= 1
    for d in range(1, len(axes)):
        axes[d] ^= axes[d - 1]
    flip = np.zeros(len(points), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(axes[-1] & q, flip ^ (q - 1), flip)
        q >>= 1
    key = np.zeros(len(points), np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hilbert key of each document: the mean of its ids' hashed directions, squeezed to the grid."""
    table = text.worker_cache("directions", lambda: np.random.default_rng(11).standard_normal((1 << 14, DIMENSIONS)).astype(np.float32))
    bucket = ((ids * np.uint32(2654435761)) >> np.uint32(18)).astype(np.int64)
    total = np.add.reduceat(table[bucket], starts, axis=0, dtype=np.float64)
    mean = total / np.diff(np.append(starts, len(ids)))[:, None]
    grid = np.floor((np.tanh(6.0 * mean) * 0.5 + 0.5) * ((1 << BITS) - 1))
    return hilbert_key(grid)


def tokenized(docs: DataFrame, key: str, column: str, path: str | None, end_id: int) -> DataFrame:
    """(_key, _curve, _ids) of each row: ids as bytes, the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = vocabulary("byte_bpe_50k.json", path)
        pieces = text.worker_cache(f"pieces-{file}", lambda: PieceIds(file))
        end = np.uint32(end_id).tobytes()
        for batch in text.batches_by_size(batches, "_text", 2 << 20):
            coded = [pieces.encode(t.as_py() or "") + end for t in batch.column("_text")]
            sizes = np.array([len(c) for c in coded]) // 4
            ids = np.frombuffer(b"".join(coded), np.uint32)
            curve = curve_keys(ids, np.cumsum(sizes) - sizes)
            # two bytes an id where they do
            if ids.max(initial=0) < 1 << 16:
                short, ends = ids.astype(np.uint16).tobytes(), 2 * np.cumsum(sizes)
                stored = [short[a:b] for a, b in zip((ends - 2 * sizes).tolist(), ends.tolist())]
            else:
                small = [np.frombuffer(c, np.uint32) for c in coded]
                stored = [s.astype(np.uint16).tobytes() if s.max() < 1 << 16 else b"\x00" + s.tobytes() for s in small]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(curve), pa.array(stored, pa.binary())], ["_key", "_curve", "_ids"]
            )

    rows = docs.select(docs[f"`{key}`"].alias("_key"), docs[f"`{column}`"].alias("_text"))
    return rows.mapInArrow(run, f"_key {rows.schema['_key'].dataType.simpleString()}, _curve long, _ids binary")


def stored_ids(data: bytes) -> np.ndarray:
    if len(data) % 2:
        return np.frombuffer(data, np.uint32, offset=1)
    return np.frombuffer(data, np.uint16).astype(np.uint32)


def pack(
    docs: DataFrame, length: int = 1024, end_id: int = 0, path: str | None = None, key: str = "doc_id", column: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece of a document: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Every document is its ids and ``end_id``; a null text is empty, so just that.  With
    ``with_ids`` the piece's ids follow, as little-endian unsigned 32-bit bytes.
    Repeated rows are packed each.  Equal places on the curve are parted by key, then by
    row, so a group of copies spreads over many ranges, with or without keys.  A range's
    last sequence is short.
    """
    spark = docs.sparkSession
    path_ids = scratch_path(spark, "packing-ids")
    tokenized(docs, key, column, path, end_id).write.option("compression", "zstd").parquet(path_ids)
    # the place among the written rows parts rows that agree in all else
    ids = spark.read.parquet(path_ids).withColumn("_row", F.monotonically_increasing_id())
    ranged = ids.repartitionByRange("_curve", "_key", "_row").sortWithinPartitions("_curve", "_key", "_row")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        filled = 0  # ids of this range so far
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], [], []]
            for k, stored in enumerate(batch.column("_ids")):
                ids = stored_ids(stored.as_py())
                n, at = len(ids), 0
                while at < n:
                    place = filled % length
                    step = min(length - place, n - at)
                    piece = ids[at : at + step].astype("<u4").tobytes()
                    row = (k, at, step, zlib.crc32(piece), n, base + filled // length, place, piece if with_ids else b"")
                    for values, value in zip(out, row):
                        values.append(value)
                    filled += step
                    at += step
            of = batch.column("_key").take(pa.array(out[0], pa.int64()))
            columns = [of, *(pa.array(values, pa.int64()) for values in out[1:7])]
            if with_ids:
                columns.append(pa.array(out[7], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if with_ids else [])]
    kinds = [ids.schema["_key"].dataType.simpleString(), *["long"] * 6, "binary"]
    schema = ", ".join(f"`{n}` {t}" for n, t in zip(names, kinds))
    return ranged.select("_key", "_ids").mapInArrow(fill, schema)


def op3_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(text.table(spark, sf_dir, "documents"))
