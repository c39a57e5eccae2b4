"""SentencePiece encoding and decoding in batches, by Viterbi over piece keys.

Words are white space marks and what follows them; no piece reaches beyond one.  The
distinct words of a batch advance together by length: hashes of all their substrings
are probed in the sorted keys of the pieces, and at every place each piece that ends
there is weighed against the best piece before it.  The vectorised maximum is kept as a
backpointer.

The model merges by rank instead of adding up scores, so two pieces may follow each
other only where merging their joined text leaves just these two.  A sequence of pieces
is the model's own encoding if every adjacent pair may follow, and each beginning of a
word has exactly one such sequence.  Hence the maximum: the longest piece that may
follow; any other piece at that place weighs nothing.  Which pairs may follow is worked
out once for each pair met, and kept.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.llm import text
from layerframe.llm.counts import vocabulary

MARK = "▁"  # stands for a space
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_HELD_WORDS = 400_000
_HELD_PAIRS = 4_000_000


class PieceModel:
    """The pieces of a SentencePiece model of merge ranks; reads the file with the library, encodes without it."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        held = SentencePieceProcessor(model_file=path)
        self.size = held.vocab_size()
        self.unknown = held.unk_id()
        names = [held.id_to_piece(i) for i in range(self.size)]
        self.byte_ids: dict[int, int] = {}
        self.rank: dict[str, tuple[float, int]] = {}  # piece to (score, id)
        self._bytes: list[bytes] = []
        for i, name in enumerate(names):
            if held.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_ids[value] = i
                self._bytes.append(bytes([value]))
            elif held.is_control(i) or held.is_unknown(i):
                self._bytes.append(b"" if held.is_control(i) else " ⁇ ".encode())
            else:
                self.rank[name] = (held.get_score(i), i)
                self._bytes.append(name.replace(MARK, " ").encode())
        usable = sorted(self.rank.items(), key=lambda item: item[1][1])
        ids = np.array([i for _, (_, i) in usable], np.int64)
        keys = np.array([self._key(name) for name, _ in usable], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], ids[order]
        self.longest = max(map(len, self.rank))
        self.names = names
        self._pairs = np.zeros(0, np.int64)
        self._may = np.zeros(0, bool)
        self._words: dict[str, bytes] = {}

    @staticmethod
    def _key(name: str) -> np.uint64:
        total = 0
        for c in name:
            total = (total * int(_BASE) + ord(c) + 1) & (2**64 - 1)
        return np.uint64(total)

    # merging itself, for two pieces' worth of text
    def merged(self, letters: str) -> list[str]:
        """Best-ranked adjacent pair first, the leftmost of equals, until none may merge."""
        parts = list(letters)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.rank.get(parts[i] + parts[i + 1])
                if found and (best is None or found[0] > best):
                    best, at = found[0], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether pieces may follow others; ``size`` before stands for a word's start or an unknown letter."""
        pair = before * (self.size + 1) + piece
        held, place = np.unique(pair, return_inverse=True)
        at = np.minimum(np.searchsorted(self._pairs, held), max(len(self._pairs) - 1, 0))
        known = self._pairs[at] == held if len(self._pairs) else np.zeros(len(held), bool)
        out = np.zeros(len(held), bool)
        out[known] = self._may[at[known]] if len(self._pairs) else False
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = [self._follows(*divmod(int(p), self.size + 1)) for p in held[new]]
            if len(self._pairs) > _HELD_PAIRS:
                self._pairs, self._may = self._pairs[:0], self._may[:0]
            pairs = np.concatenate([self._pairs, held[new]])
            order = np.argsort(pairs, kind="stable")
            self._pairs, self._may = pairs[order], np.concatenate([self._may, out[new]])[order]
        return out[place]

    def _follows(self, before: int, piece: int) -> bool:
        if piece == self.size:
            return True
        if before == self.size:
            return self.merged(self.names[piece]) == [self.names[piece]]
        pair = [self.names[before], self.names[piece]]
        return self.merged("".join(pair)) == pair

    def viterbi(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last, back) of words of equal length, code points in rows: the last piece of each
        beginning's encoding and its length; ``size`` is an unknown letter."""
        b, n = letters.shape
        prefix = np.zeros((b, n + 1), np.uint64)
        for j in range(n):
            prefix[:, j + 1] = prefix[:, j] * _BASE + letters[:, j].astype(np.uint64) + np.uint64(1)
        ending = {}
        power = np.uint64(1)
        for length in range(1, min(self.longest, n) + 1):
            power = np.uint64((int(power) * int(_BASE)) & (2**64 - 1))
            key = prefix[:, length:] - prefix[:, :-length] * power
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ending[length] = np.where(self.keys[at] == key, self.ids[at], -1)
        ending[1] = np.where(ending[1] < 0, self.size, ending[1])
        last = np.full((b, n + 1), self.size, np.int64)
        back = np.zeros((b, n + 1), np.int64)
        for j in range(1, n + 1):
            lengths = range(1, min(self.longest, j) + 1)
            piece = np.stack([ending[k][:, j - k] for k in lengths], 1)
            row, k = np.nonzero(piece >= 0)
            may = self.may_follow(last[row, j - 1 - k], piece[row, k])
            weight = np.zeros(piece.shape, np.int64)
            weight[row[may], k[may]] = k[may] + 1
            back[:, j] = weight.max(1)
            last[:, j] = piece[np.arange(b), back[:, j] - 1]
        return last, back

    def _encode_equal(self, words: list[str]) -> None:
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
        last, back = self.viterbi(letters)
        n = letters.shape[1]
        at = np.full(len(words), n)
        rows = np.arange(len(words))
        steps = []
        while at.any():
            steps.append(np.where(at > 0, last[rows, at], -1))
            unknown = np.where((at > 0) & (steps[-1] == self.size), letters[rows, np.maximum(at - 1, 0)], 0)
            steps[-1] = np.where(steps[-1] == self.size, -2 - unknown.astype(np.int64), steps[-1])
            at = at - back[rows, at] * (at > 0)
        table = np.stack(steps[::-1], 1)
        plain = (table >= -1).all(1)
        for word, ids, easy in zip(words, table, plain):
            if not easy:
                spelled = []
                for i in ids:
                    spelled += [i] if i > -2 else self._spelled(chr(-2 - i))
                ids = np.array(spelled, np.int64)
            self._words[word] = ids[ids >= 0].astype(np.uint32).tobytes()

    def _spelled(self, letter: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[v] for v in letter.encode("utf-8", "replace")]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, as unsigned 32-bit bytes; an empty text has none."""
        split = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self._words) > _HELD_WORDS:
            self._words.clear()
        by_length: dict[int, list[str]] = {}
        for word in set().union(*split) - self._words.keys():
            by_length.setdefault(len(word), []).append(word)
        for n, words in sorted(by_length.items()):
            most = max(1, (1 << 20) // (n * self.longest))
            for low in range(0, len(words), most):
                self._encode_equal(words[low : low + most])
        return [b"".join(map(self._words.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> str:
        """The text of ids: bytes are put together again, and the first space is the mark put in front."""
        data = b"".join(map(self._bytes.__getitem__, np.frombuffer(ids, np.uint32).tolist()))
        found = data.decode("utf-8", "replace")
        return found[1:] if found.startswith(" ") else found


def _model(path: str | None) -> PieceModel:
    file = vocabulary("piece_bpe_32k.model", path)
    return text.worker_cache(f"sentencepiece-{file}", lambda: PieceModel(file))


def encode(docs: DataFrame, key: str = "doc_id", column: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids) of each row's whole text; ids as little-endian unsigned 32-bit bytes.

    Null and empty texts have no ids.  Repeated rows are encoded alike; other columns
    are not read.  One map over the rows, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in text.batches_by_size(batches, "_text"):
            ids = model.encode([t or "" for t in batch.column("_text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(ids, pa.binary())], [key, "ids"])

    rows = docs.select(docs[f"`{key}`"].alias("_key"), docs[f"`{column}`"].alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema['_key'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, key: str = "doc_id", column: str = "ids", path: str | None = None) -> DataFrame:
    """(key, text) of each row's ids; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            texts = [model.decode(ids or b"") for ids in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(texts, pa.string())], [key, "text"])

    rows = encoded.select(encoded[f"`{key}`"].alias("_key"), encoded[f"`{column}`"].alias("_ids"))
    return rows.mapInArrow(run, f"`{key}` {rows.schema['_key'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, key: str = "doc_id", column: str = "text", path: str | None = None) -> DataFrame:
    """(key, n_ids, ids_crc32, decoded_crc32, decoded_bytes) of each row: its ids, and the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in text.batches_by_size(batches, "_text"):
            ids = model.encode([t or "" for t in batch.column("_text").to_pylist()])
            back = [model.decode(i).encode() for i in ids]
            columns = ([len(i) // 4 for i in ids], map(zlib.crc32, ids), map(zlib.crc32, back), map(len, back))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *(pa.array(list(c), pa.int64()) for c in columns)], names)

    names = [key, "n_ids", "ids_crc32", "decoded_crc32", "decoded_bytes"]
    rows = docs.select(docs[f"`{key}`"].alias("_key"), docs[f"`{column}`"].alias("_text"))
    kinds = [rows.schema["_key"].dataType.simpleString(), *["long"] * 4]
    return rows.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text.table(spark, sf_dir, "documents")
    return digests(docs).select("doc_id", F.col("n_ids"), "ids_crc32", "decoded_crc32", "decoded_bytes")
