"""Quality classifier: a sparse ensemble of rules over statistics of whole texts.

Statistics come from one pass over the bytes.  On a bounded labelled sample small
boosted trees are grown; every path from a root to a node is a rule, a conjunction of
comparisons.  A lasso logistic regression weighs the rules and drops most.  What is
left is compiled into one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.llm import text

ROWS = 6000  # labelled rows learned from, at most
STATISTICS = [
    "bytes", "words", "word_length", "upper", "digits", "marks", "bars", "exclaims", "symbols", "breaks",
    "not_ascii", "distinct_words", "top_word", "distinct_pairs", "repeated_lines", "stops", "longest_word",
]


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for c in chars]] = 1
    return out


_CLASSES = {
    "upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "digits": _table("0123456789"),
    "marks": _table("!\"'(),-./:;?[]_`{}"),
    "bars": _table("|"),
    "exclaims": _table("!"),
    "symbols": _table("#$%&*+<=>@\\^~"),
    "breaks": _table("\n"),
    "not_ascii": (np.arange(256) >= 128).astype(np.int64),
    "stops": _table(".?!"),
}
_BYTE_CLASS = np.stack([_CLASSES[c] for c in _CLASSES])


def _distinct(row: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: distinct keys, and how often the commonest occurs."""
    order = np.lexsort((key, row))
    r, k = row[order], key[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, r[at], np.diff(np.append(at, len(r))))
    return np.bincount(r[at], minlength=n), top


def statistics(texts: text.Texts) -> np.ndarray:
    """One row per text; an empty text has zeros everywhere."""
    n = len(texts)
    out = np.zeros((n, len(STATISTICS)))
    of = {name: k for k, name in enumerate(STATISTICS)}
    size = texts.sizes
    share = 1.0 / np.maximum(size, 1)
    row = np.repeat(np.arange(n), size)
    by_byte = np.bincount(row * 256 + texts.data, minlength=n * 256).reshape(n, 256)
    for name, count in zip(_CLASSES, (by_byte @ _BYTE_CLASS.T).T):
        out[:, of[name]] = count * share

    words = text.words_of(texts)
    n_words = np.diff(words.first)
    per_word = 1.0 / np.maximum(n_words, 1)
    length = words.ends - words.starts
    hashes = text.span_hashes(text.ascii_lower(texts.data), words.starts, words.ends)
    distinct, top = _distinct(words.row, hashes, n)
    pairs = np.flatnonzero(words.row[1:] == words.row[:-1])
    distinct_pairs, _ = _distinct(words.row[pairs], text.mix(hashes[pairs]) + hashes[pairs + 1], n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, words.row, length)

    not_break = np.ones(256, bool)
    not_break[[10, 13]] = False
    lines = text.words_of(texts, not_break)
    n_lines = np.diff(lines.first)
    distinct_lines, _ = _distinct(lines.row, text.span_hashes(texts.data, lines.starts, lines.ends), n)

    out[:, of["bytes"]] = size
    out[:, of["words"]] = n_words
    out[:, of["word_length"]] = np.bincount(words.row, length, n) * per_word
    out[:, of["distinct_words"]] = distinct * per_word
    out[:, of["top_word"]] = top * per_word
    out[:, of["distinct_pairs"]] = distinct_pairs / np.maximum(n_words - 1, 1)
    out[:, of["repeated_lines"]] = 1.0 - distinct_lines / np.maximum(n_lines, 1)
    out[n_lines == 0, of["repeated_lines"]] = 0.0
    out[:, of["longest_word"]] = longest
    return out


def with_statistics(docs: DataFrame, keep: list[str], column: str = "text", name: str = "stats") -> DataFrame:
    """The columns ``keep`` and, as ``name``, the statistics of each whole text (null: empty)."""
    judged = text.fresh(docs, "_judged")
    held = docs.select(*(docs[f"`{c}`"] for c in keep), docs[f"`{column}`"].alias(judged))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.batches_by_size(batches, judged, 2 << 20):
            found = statistics(text.texts_of(batch.column(judged)))
            n, k = found.shape
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * k)
            stats = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], stats], [*keep, name])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields[:-1])
    return held.mapInArrow(run, f"{kept}, `{name}` array<double>")


# --- learning -----------------------------------------------------------------------------

Test = tuple[int, bool, float]  # statistic, whether above, threshold


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, above, at in self.tests:
            out &= (x[:, k] > at) == above
        return out


@dataclass
class Ensemble:
    intercept: float
    rules: list[tuple[float, Rule]]

    def column(self, stats: str = "stats") -> Column:
        """Probability of label 1, as one expression."""
        total = F.lit(self.intercept)
        for weight, rule in self.rules:
            held = F.lit(True)
            for k, above, at in rule.tests:
                value = F.element_at(stats, k + 1)
                held = held & ((value > at) if above else (value <= at))
            total = total + F.when(held, F.lit(weight)).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, thresholds: list[np.ndarray], least: int):
    best = (1e-9, None, None)
    base = g.sum() ** 2 / (h.sum() + 1.0)
    for k, cuts in enumerate(thresholds):
        if not len(cuts):
            continue
        bins = np.searchsorted(cuts, x[:, k], "left")  # at most cuts[b]: bins <= b
        gs, hs = (np.bincount(bins, v, len(cuts) + 1).cumsum()[:-1] for v in (g, h))
        ns = np.bincount(bins, minlength=len(cuts) + 1).cumsum()[:-1]
        gain = gs**2 / (hs + 1.0) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1.0) - base
        gain[(ns < least) | (len(x) - ns < least)] = -1
        b = int(gain.argmax())
        if gain[b] > best[0]:
            best = (float(gain[b]), k, float(cuts[b]))
    return best


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, least: int = 8) -> list[Rule]:
    """Paths of gradient-boosted trees, without repeats."""
    thresholds = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, 64))) for k in range(x.shape[1])]
    margin = np.zeros(len(y))
    found: dict[tuple, Rule] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        nodes = [((), np.arange(len(y)))]
        for level in range(depth + 1):
            split = []
            for tests, rows in nodes:
                gain, k, at = _split(x[rows], g[rows], h[rows], thresholds, least) if level < depth else (0, None, None)
                if k is None:
                    margin[rows] += rate * g[rows].sum() / (h[rows].sum() + 1.0)
                    continue
                above = x[rows, k] > at
                for side, part in ((True, rows[above]), (False, rows[~above])):
                    path = (*tests, (k, side, at))
                    rule = tuple(sorted(path))
                    found.setdefault(rule, Rule(rule))
                    split.append((path, part))
            nodes = split
    return list(found.values())


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 600) -> tuple[float, np.ndarray]:
    """Logistic regression with an L1 penalty, by accelerated proximal steps."""
    mean = a.mean(0)
    scale = np.maximum(a.std(0), 1e-6)
    z = (a - mean) / scale
    step = 4.0 * len(y) / (np.linalg.norm(z, 2) ** 2 + len(y))
    w, b = np.zeros(z.shape[1]), 0.0
    v, c, t = w, b, 1.0
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(z @ v + c))) - y
        moved = v - step * (z.T @ r) / len(y)
        w_new = np.sign(moved) * np.maximum(np.abs(moved) - step * penalty, 0)
        b_new = c - step * r.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return b - float((w / scale) @ mean), w / scale


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.002) -> Ensemble:
    """Rules and weights.  With one label only, or none, the intercept alone: its share, or a half."""
    if len(y) < 20 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return Ensemble(float(np.log(share / (1 - share))), [])
    rules = grow_rules(x, y)
    if not rules:
        share = y.mean()
        return Ensemble(float(np.log(share / (1 - share))), [])
    intercept, weights = lasso(np.stack([r.holds(x) for r in rules], 1).astype(float), y, penalty)
    return Ensemble(intercept, [(float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, column: str = "text") -> DataFrame:
    """(_text, _label) of at most ``most`` labelled documents outside the fold held out."""
    known = labels.where(F.col(label).isin(0, 1) & (text.remainder("doc_id", 5) != 0))
    chosen = text.small_sample(known.select("doc_id", F.col(label).alias("_label")), "doc_id", most)
    # at most ``most`` rows
    return docs.select("doc_id", F.col(f"`{column}`").alias("_text")).join(F.broadcast(chosen), "doc_id").select("_text", "_label")


def learn(docs: DataFrame, labels: DataFrame, most: int = ROWS, label: str = "quality") -> Ensemble:
    """The ensemble learned from at most ``most`` labelled rows; only their statistics reach the driver."""
    rows = with_statistics(labelled_sample(docs, labels, label, most), ["_label"], "_text").toPandas()
    x = np.stack(rows["stats"].to_list()) if len(rows) else np.zeros((0, len(STATISTICS)))
    order = np.lexsort((*x.T[::-1], rows["_label"]))  # rows arrive in any order
    return fit(x[order], rows["_label"].to_numpy(float)[order])


def score_quality(docs: DataFrame, ensemble: Ensemble, keep: list[str], threshold: float = 0.3, column: str = "text") -> DataFrame:
    """The columns ``keep``, score and predicted (1 from ``threshold`` on) of each whole text.

    Null and empty texts have all statistics 0 and the score that follows from that.
    Repeated rows are scored alike, an empty table gives no rows, and kept columns may have
    any name but those of the two new ones.  One map over the rows, no shuffle.
    """
    stats = text.fresh(docs, "stats")
    scored = with_statistics(docs, keep, column, stats).withColumn("score", ensemble.column(stats))
    return scored.select(*keep, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (text.table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = score_quality(docs, learn(docs, labels), ["doc_id"])
    return scored.select("doc_id", (text.remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
