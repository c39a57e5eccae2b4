"""Periodic runs of words, found through Lyndon roots.

A run is a maximal stretch with a smallest period that it repeats at least ``times``
times.  For one of two opposite orders of the words, every occurrence of a run's Lyndon
root inside it is the longest Lyndon word at its place.  Those longest Lyndon words fall
out of the first phase of a suffix sorter by grouping, with no sorted suffixes needed;
places that share a final group share that word, so a root repeated is seen by comparing
group numbers.  Each chain of repeated roots is extended to both sides by the longest
common extension of its two ends, which is shorter than the root.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from layerframe.llm import text

LEAST, TIMES = 6, 4
_ROUNDS = 6


def lyndon_groups(symbols: Sequence[int]) -> tuple[list[int], list[int]]:
    """(group, length): of each place, a number for its longest Lyndon word, and that word's length.

    Symbols are whole numbers; a word's end counts as smaller than any symbol.  Suffixes
    start in groups by their first symbol.  Groups are taken from the highest down.  Each
    member points to the nearest place before it that lies in a lower group; a place that
    gets ``k`` pointers has its word extended by ``k`` copies of this group's word, and
    moves, with the others of its group that got as many, to a new group just above its old one.
    """
    n = len(symbols)
    firsts: dict[int, list[int]] = {}
    for i, symbol in enumerate(symbols):
        if symbol in firsts:
            firsts[symbol].append(i)
        else:
            firsts[symbol] = [i]
    members = [firsts[symbol] for symbol in sorted(firsts)]
    size = [1] * len(members)
    lower, higher = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    group = [0] * n
    for g, places in enumerate(members):
        for i in places:
            group[i] = g
    # places whose group is still to come, linked; what precedes place 0 is -1
    before, after = list(range(-1, n)), list(range(1, n + 1))
    top = len(members) - 1
    while top >= 0:
        moved: dict[tuple[int, int], list[int]] = {}
        last, many = -1, 0
        for i in members[top]:
            if group[i] != top:
                continue
            j, following = before[i], after[i]
            before[following] = j
            if j >= 0:
                after[j] = following
            if j == last:
                many += 1
                continue
            if last >= 0:
                moved.setdefault((-many, group[last]), []).append(last)
            last, many = j, 1
        if last >= 0:
            moved.setdefault((-many, group[last]), []).append(last)
        for pointers, old in sorted(moved) if len(moved) > 1 else moved:
            new = len(members)
            members.append(moved[pointers, old])
            size.append(size[old] - pointers * size[top])
            over = higher[old]
            lower.append(old)
            higher.append(over)
            higher[old] = lower[over] = new
            for j in members[new]:
                group[j] = new
        top = lower[top]
    return group, [size[g] for g in group]


def _agreeing(symbols: Sequence[int], a: int, b: int, most: int, step: int) -> int:
    """How many symbols agree going from places a and b in direction ``step``, ``most`` looked at."""
    n = 0
    while n < most and symbols[a] == symbols[b]:
        a, b, n = a + step, b + step, n + 1
    return n


def find_runs(symbols: Sequence[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` symbols and ``times`` periods, ordered.

    ``times`` is 3 or more, so that a run holds two whole Lyndon roots in a row.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")
    n = len(symbols)
    found = set()
    for order in (symbols, [-s for s in symbols]):
        group, length = lyndon_groups(order)
        for i in range(n):
            p = length[i]
            j = i + p
            # the first two of a chain of equal roots
            if j >= n or group[j] != group[i] or (i >= p and group[i - p] == group[i]):
                continue
            while j + p < n and group[j + p] == group[j]:
                j += p
            start = i - _agreeing(symbols, i - 1, i - 1 + p, min(p, i), -1)
            end = j + p
            end += _agreeing(symbols, end - p, end, min(p, n - end), 1)
            if end - start >= max(least, times * p):
                found.add((start, end - start, p))
    return sorted(found)


def _stretches(words: Sequence[object], low: int, high: int, least: int, times: int, rounds: int = _ROUNDS) -> Iterator[tuple[int, int]]:
    """Parts of ``words[low:high]`` outside which no run can lie, by rounds of one exact test.

    A run holds each of its words ``times`` times, so a word rarer than that in a
    stretch ends every run there.  What is left after the last round is passed on as it is.
    """
    if high - low < max(least, times):
        return
    counts = Counter(words[low:high])
    rare = {w for w, c in counts.items() if c < times}
    if not rare or not rounds:
        yield low, high
        return
    if len(rare) == len(counts):
        return
    start = low
    for i in range(low, high):
        if words[i] in rare:
            if i - start >= least:
                yield from _stretches(words, start, i, least, times, rounds - 1)
            start = i + 1
    if high - start >= least:
        yield from _stretches(words, start, high, least, times, rounds - 1)


def word_runs(words: Sequence[object], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of words, by start, then period."""
    found = []
    for low, high in _stretches(words, 0, len(words), least, times):
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words[low:high]))}
        found += [(low + start, length, p) for start, length, p in find_runs([numbers[w] for w in words[low:high]], least, times)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def planted(words: list[bytes], key: object) -> list[bytes]:
    """Makes one row in ten periodic from some word on, decided by the crc32 of its key."""
    n = len(words)
    h = crc32(str(key).encode()) if key is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def kept_words(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """Words outside every run's repetitions: of a run only the first period stays, unless another drops it."""
    kept: list[bytes] = []
    at = 0
    for low, high in sorted((start + p, start + length) for start, length, p in runs):
        kept += words[at:low]
        at = max(at, high)
    return kept + list(words[at:])


def best_run(runs: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length over period; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


_OUT = ("n_runs long", "start long", "length long", "period long", "exponent_milli long", "runs_sha256 string", "collapsed_sha256 string")


def collapse_runs(
    docs: DataFrame, key: str = "doc_id", column: str = "text", least: int = LEAST, times: int = TIMES, plant: bool = False, full: bool = False
) -> DataFrame:
    """Each row's runs of words: their number, the strongest, and digests of all of them and of the collapsed text.

    One row per row, repeats included, with ``key`` and the columns of ``_OUT``; with
    ``full`` also ``runs`` (all of them) and ``collapsed`` (the text without repetitions).
    A word is a maximal stretch without white space (bytes 9 to 13 and 32).  A null,
    empty or blank text has no words, no run, four nulls and the digests of nothing.
    Ties in strength go to the smallest start, then period.  ``plant`` rewrites one row
    in ten, chosen by the crc32 of its key, to be periodic; a null key is never chosen.
    Other columns are not read, whatever their names; an empty table gives no rows.
    One map over the scan, memory bounded by the longest text.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = [f"`{key}` {kind}", *_OUT]
    if full:
        schema += ["runs array<struct<start:bigint,length:bigint,period:bigint>>", "collapsed string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.batches_by_size(batches, "_text"):
            rows = [[] for _ in range(len(schema) - 1)]
            for row_key, whole in zip(batch.column("_key").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                words = (whole or "").encode().split()
                if plant:
                    words = planted(words, row_key)
                runs = word_runs(words, least, times)
                start, length, period = best_run(runs) or (None, None, None)
                lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
                collapsed = b" ".join(kept_words(words, runs))
                values = [
                    len(runs), start, length, period, 1000 * length // period if period else None,
                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest(),
                ]
                if full:
                    values += [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], collapsed.decode()]
                for to, value in zip(rows, values, strict=True):
                    to.append(value)
            kinds = [*[pa.int64()] * 5, *[pa.string()] * 2]
            if full:
                kinds += [pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])), pa.string()]
            columns = [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), *columns], [key, *(s.split()[0] for s in schema[1:])])

    rows = docs.select(docs[f"`{key}`"].alias("_key"), docs[f"`{column}`"].alias("_text"))
    return rows.mapInArrow(run, ", ".join(schema))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_runs(text.table(spark, sf_dir, "documents"), plant=True)
