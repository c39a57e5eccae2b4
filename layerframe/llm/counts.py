"""Token counts: byte-pair merging with a heap over a linked list, no ids made."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from layerframe.llm import text

# The pre-tokenizer pattern and the white-space rule of the vocabulary's own file.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
_SPACES = regex.compile(r"\s+")
_HELD_PIECES = 300_000


class MergeCounter(dict):
    """Tokens of a piece, kept by piece; cleared when it holds ``_HELD_PIECES``.

    A piece starts as one symbol per byte, the last marked as a word's end.  All
    adjacent pairs that may merge wait in a heap by rank, then place.  Popping the
    lowest merges its two symbols in the linked list and pushes the two new pairs;
    entries whose symbols have changed meanwhile are passed over.  The count is the
    number of first symbols less the merges.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, model = spec["model"]["vocab"], spec["model"]
        alphabet = _byte_symbols()
        end = model.get("end_of_word_suffix") or ""
        self._inner = [vocab[s] for s in alphabet]
        self._last = [vocab[s + end] for s in alphabet]
        self._merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)))

    def __missing__(self, piece: str) -> int:
        n = self._count(piece.encode())
        if len(self) >= _HELD_PIECES:
            self.clear()
        self[piece] = n
        return n

    def _count(self, data: bytes) -> int:
        n = len(data)
        symbol = [self._inner[b] for b in data]
        symbol[-1] = self._last[data[-1]]
        following = list(range(1, n + 1))
        preceding = list(range(-1, n - 1))
        merges = self._merges
        heap = []
        for i in range(n - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                heap.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = following[i]
            if symbol[i] != a or j >= n or symbol[j] != b:
                continue
            symbol[i], symbol[j] = made, -1
            left -= 1
            k = following[i] = following[j]
            if k < n:
                preceding[k] = i
                found = merges.get((made, symbol[k]))
                if found:
                    heapq.heappush(heap, (found[0], i, made, symbol[k], found[1]))
            h = preceding[i]
            if h >= 0:
                found = merges.get((symbol[h], made))
                if found:
                    heapq.heappush(heap, (found[0], h, symbol[h], made, found[1]))
        return left

    def count(self, whole: str) -> int:
        """Tokens of a whole text; a special string inside it is one token."""
        if "<|" in whole:
            parts = self._cut.split(whole)
            return len(parts) - 1 + sum(self._plain(p) for p in parts)
        return self._plain(whole)

    def _plain(self, part: str) -> int:
        part = part if part.isascii() else unicodedata.normalize("NFC", part)
        # lower case letter by letter: a final sigma is like any other
        part = _SPACES.sub(" ", part).replace("Σ", "σ").lower()
        return sum(map(self.__getitem__, _PIECE.findall(part)))


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where visible, else the next free from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def vocabulary(name: str, path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, limit: int = 2048, path: str | None = None, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row's whole text.

    A null text counts as empty: no bytes, no tokens.  Repeated rows give repeated
    results; other columns are not read.  One map over the scan, no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = vocabulary("word_bpe_49k.json", path)
        counter = text.worker_cache(f"merges-{file}", lambda: MergeCounter(file))
        for batch in text.batches_by_size(batches, "_text"):
            sizes = text.texts_of(batch.column("_text")).sizes
            tokens = [counter.count(t.as_py() or "") for t in batch.column("_text")]
            n = pa.array(tokens, pa.int64())
            over = pa.array([t > limit for t in tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(sizes, pa.int64()), n, over], names)

    names = [key, "n_bytes", "n_tokens", "over_limit"]
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("_key"), docs[column].alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(text.table(spark, sf_dir, "documents"))
