"""Toxicity: a bidirectional gated recurrent network with attention, trained in numpy.

A word enters as the sum of two hashed word vectors and the mean of hashed vectors of
its character runs.  Windows of ``WINDOW`` words that overlap by ``WINDOW - STRIDE``
are read forwards and backwards by gated units; attention over all positions pools the
states and a logistic output gives the window's score.  A text scores as its highest
window, all windows of the whole text counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerframe.llm import text
from layerframe.llm.quality import labelled_sample

ROWS = 4000  # labelled documents learned from, at most
WINDOWS_CLEAN, WINDOWS_TOXIC = 4, 16  # windows of one document learned from in one pass, at most
HELD_BACK = 5  # every so many-th document sets the threshold instead
WINDOW, STRIDE = 48, 36
WORD_BUCKETS, CHAR_BUCKETS = 1 << 17, 1 << 17
RUNS = (3, 4, 5)  # lengths of character runs, in bytes
INPUT, HIDDEN = 16, 12
EPOCHS = 10
HIDDEN_WORDS = 0.5
_WORDS_AT_ONCE = 8192

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


# --- inputs ---------------------------------------------------------------------------


def distinct_words(texts: text.Texts) -> tuple[np.ndarray, text.Words, dict]:
    """Number of each word among the distinct ones, all words, and the buckets of the distinct ones."""
    data = text.ascii_lower(texts.data)
    words = text.words_of(texts, _INSIDE)
    hashes = text.span_hashes(data, words.starts, words.ends)
    held, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    order = np.argsort(first)  # as they come in the texts
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    number, held, first = place[number], held[order], first[order]
    spread = text.mix(held)
    pair = np.stack([spread % np.uint64(WORD_BUCKETS), (spread >> np.uint64(32)) % np.uint64(WORD_BUCKETS)], 1).astype(np.int32)
    runs, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for low in range(0, len(held), _WORDS_AT_ONCE):
        some = first[low : low + _WORDS_AT_ONCE]
        run, owner = _character_runs(data, words.starts[some], words.ends[some])
        runs.append(run)
        ends.append(ends[-1][-1] + np.cumsum(np.bincount(owner, minlength=len(some))))
    return number, words, {"pair": pair, "runs": np.concatenate(runs), "ends": np.concatenate(ends), "n": len(held)}


def _character_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of all runs of the words, by word."""
    runs, of = [], []
    for n in RUNS:
        # a run is marked by its length and by whether it begins the word
        count = np.maximum(ends - starts - n + 1, 0)
        owner = np.repeat(np.arange(len(starts)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at = starts[owner] + step
        mark = np.uint64(n * 2) + (step == 0).astype(np.uint64)
        runs.append((text.mix(text.span_hashes(data, at, at + n) + mark) % np.uint64(CHAR_BUCKETS)).astype(np.int32))
        of.append(owner)
    runs, of = np.concatenate(runs), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return runs[order], of[order]


def word_inputs(model: dict, buckets: dict, known: np.ndarray | None = None) -> np.ndarray:
    """Input of each distinct word; where ``known`` is 0 from its character runs alone."""
    x = model["word"][buckets["pair"][:, 0]] + model["word"][buckets["pair"][:, 1]]
    if known is not None:
        x *= known[:, None]
    ends = buckets["ends"]
    for low in range(0, len(x), _WORDS_AT_ONCE):
        edge = ends[low : low + _WORDS_AT_ONCE + 1]
        count = np.diff(edge)
        has = np.flatnonzero(count)
        if len(has):
            vectors = model["char"][buckets["runs"][edge[0] : edge[-1]]]
            x[low + has] += np.add.reduceat(vectors, edge[has] - edge[0], axis=0) / count[has, None].astype(np.float32)
    return x


def windows_of(words: text.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, words) of all windows of all rows; a row without words has none."""
    n = np.diff(words.first)
    count = np.where(n > 0, 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(n)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = words.first[row] + step * STRIDE
    return row, start, np.minimum(WINDOW, words.first[row + 1] - start)


# --- the network ----------------------------------------------------------------------


def new_model(seed: int) -> dict:
    random = np.random.default_rng(seed)
    draw = lambda *shape, by: (random.standard_normal(shape) * by).astype(np.float32)
    return {
        "word": draw(WORD_BUCKETS, INPUT, by=0.02),
        "char": draw(CHAR_BUCKETS, INPUT, by=0.02),
        "in_f": draw(INPUT, 3 * HIDDEN, by=0.5 / np.sqrt(INPUT)) * 2,
        "in_b": draw(INPUT, 3 * HIDDEN, by=0.5 / np.sqrt(INPUT)) * 2,
        "bias_f": np.zeros(3 * HIDDEN, np.float32),
        "bias_b": np.zeros(3 * HIDDEN, np.float32),
        "rec_f": draw(HIDDEN, 3 * HIDDEN, by=1 / np.sqrt(HIDDEN)),
        "rec_b": draw(HIDDEN, 3 * HIDDEN, by=1 / np.sqrt(HIDDEN)),
        "att": draw(2 * HIDDEN, by=0.3),
        "out": draw(2 * HIDDEN, by=0.5),
        "out_bias": np.full(1, -1.0, np.float32),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def read(gates: np.ndarray, rec: np.ndarray, mask: np.ndarray | None, backwards: bool, keep: list | None = None) -> np.ndarray:
    """States after each step of ``gates`` (steps, windows, 3 * HIDDEN).

    Where ``mask`` is 0 the state stays, so reading backwards begins at a window's end.
    """
    steps, n, _ = gates.shape
    out = np.empty((steps, n, HIDDEN), np.float32)
    h = np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1) if backwards else range(steps):
        g = gates[t]
        u = h @ rec
        zr = _sigmoid(g[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        c = np.tanh(g[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
        new = c + z * (h - c)
        if mask is not None:
            m = mask[t][:, None]
            new = h + m * (new - h)
        if keep is not None:
            keep.append((t, h, z, r, c, u[:, 2 * HIDDEN :]))
        out[t] = h = new
    return out


def attend(model: dict, states: np.ndarray, mask: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(attention, pooled states, logits)."""
    e = states @ model["att"]
    if mask is not None:
        e = np.where(mask > 0, e, np.float32(-1e9))
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    pooled = np.einsum("tn,tnh->nh", a, states)
    return a, pooled, pooled @ model["out"] + model["out_bias"][0]


def window_logits(model: dict, x: np.ndarray, number: np.ndarray, start: np.ndarray, length: np.ndarray, at_once: int = 2048) -> np.ndarray:
    """Logit of each window of words; ``x`` holds the inputs of the distinct words."""
    gates = {d: x @ model[f"in_{d}"] + model[f"bias_{d}"] for d in "fb"}
    out = np.empty(len(start), np.float32)
    order = np.argsort(length, kind="stable")
    for low in range(0, len(order), at_once):
        chunk = order[low : low + at_once]
        steps = int(length[chunk].max())
        t = np.arange(steps)[:, None]
        inside = t < length[chunk]
        mask = None if inside.all() else inside.astype(np.float32)
        word = number[np.minimum(start[chunk] + t, len(number) - 1)]
        states = np.concatenate([read(gates[d][word], model[f"rec_{d}"], mask, d == "b") for d in "fb"], 2)
        out[chunk] = attend(model, states, mask)[2]
    return out


# --- training -------------------------------------------------------------------------


def _back_through(d_states: np.ndarray, gates_shape: tuple, rec: np.ndarray, mask: np.ndarray, keep: list) -> tuple[np.ndarray, np.ndarray]:
    d_gates = np.zeros(gates_shape, np.float32)
    d_rec = np.zeros_like(rec)
    d_h = np.zeros_like(d_states[0])
    for t, h, z, r, c, un in reversed(keep):
        d_new = d_h + d_states[t]
        m = mask[t][:, None]
        d_h = d_new * (1 - m)
        d_new = d_new * m
        d_c = d_new * (1 - z) * (1 - c * c)
        d_z = d_new * (h - c) * z * (1 - z)
        d_r = d_c * un * r * (1 - r)
        d_u = np.concatenate([d_z, d_r, d_c * r], 1)
        d_gates[t] = np.concatenate([d_z, d_r, d_c], 1)
        d_rec += h.T @ d_u
        d_h += d_new * z + d_u @ rec.T
    return d_gates, d_rec


def gradients(model: dict, x: np.ndarray, word: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the weighted logistic loss; for the inputs they come per distinct word of ``x``."""
    keep = {"f": [], "b": []}
    g = {d: (x @ model[f"in_{d}"] + model[f"bias_{d}"])[word] for d in "fb"}
    states = np.concatenate([read(g[d], model[f"rec_{d}"], mask, d == "b", keep[d]) for d in "fb"], 2)
    a, pooled, logit = attend(model, states, mask)
    d_logit = (_sigmoid(logit) - y) * weight
    d_pooled = d_logit[:, None] * model["out"]
    d_a = np.einsum("tnh,nh->tn", states, d_pooled)
    d_e = a * (d_a - (a * d_a).sum(0))
    d_states = a[:, :, None] * d_pooled + d_e[:, :, None] * model["att"]
    out = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True), "att": np.einsum("tnh,tn->h", states, d_e)}
    d_x = np.zeros_like(x)
    for k, d in enumerate("fb"):
        part = d_states[:, :, k * HIDDEN : (k + 1) * HIDDEN]
        d_g, out[f"rec_{d}"] = _back_through(part, g[d].shape, model[f"rec_{d}"], mask, keep[d])
        flat = d_g.reshape(-1, 3 * HIDDEN)
        per_word = _sum_by(word.ravel(), flat, len(x))
        out[f"in_{d}"] = x.T @ per_word
        out[f"bias_{d}"] = flat.sum(0)
        d_x += per_word @ model[f"in_{d}"].T
    return out, d_x


def _sum_by(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(index):
        order = np.argsort(index, kind="stable")
        held = index[order]
        at = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
        out[held[at]] = np.add.reduceat(values[order], at, axis=0)
    return out


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, model: dict, grads: dict) -> None:
        self.t += 1
        for name, g in grads.items():
            rows = slice(None)
            if isinstance(g, tuple):
                rows, g = g
            if name not in self.m:
                self.m[name], self.v[name] = np.zeros_like(model[name]), np.zeros_like(model[name])
            m = self.m[name][rows] = 0.9 * self.m[name][rows] + 0.1 * g
            v = self.v[name][rows] = 0.99 * self.v[name][rows] + 0.01 * g * g
            model[name][rows] -= self.rate * m / (np.sqrt(v) + 1e-7)


def train(column: pa.Array, label: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> dict:
    """A model from whole texts and their labels.

    Each pass learns from a bounded number of windows of a document.  The first takes
    them at random.  Later ones take, of a clean document, half at random and half the
    highest scored; of a toxic one those that score at least half its highest.  At
    last the output is shifted to where documents held back are told apart best.
    """
    random = np.random.default_rng(seed)
    model = new_model(seed)
    texts = text.texts_of(column)
    number, words, buckets = distinct_words(texts)
    row, start, length = windows_of(words)
    if not len(row) or label.min() == label.max():
        return model | {"out": np.zeros_like(model["out"]), "out_bias": np.full(1, _share_logit(label), np.float32)}
    y = label[row].astype(np.float32)
    teaches = np.arange(len(label))[row] % HELD_BACK > 0
    first = np.searchsorted(row, np.arange(len(label)))
    place = lambda by: _place(row, first, by)
    adam = _Adam(0.004)
    for epoch in range(epochs):
        drawn = place(random.random(len(row)))
        if epoch == 0:
            use = drawn < np.where(y > 0, WINDOWS_TOXIC, WINDOWS_CLEAN)
        else:
            p = _sigmoid(window_logits(model, word_inputs(model, buckets), number, start, length))
            top = np.zeros(len(label), np.float32)
            np.maximum.at(top, row, p)
            hard = place(-p)
            use = np.where(y > 0, (p >= 0.5 * top[row]) & (hard < WINDOWS_TOXIC), (drawn < WINDOWS_CLEAN // 2) | (hard < WINDOWS_CLEAN // 2))
        adam.rate = 0.004 if epoch < epochs - 2 else 0.0015
        order = random.permutation(np.flatnonzero(use & teaches))
        balance = np.where(y > 0, min(4.0, float((y[order] == 0).sum()) / max(1.0, float(y[order].sum()))), 1.0).astype(np.float32)
        for low in range(0, len(order), 192):
            chunk = order[low : low + 192]
            steps = int(length[chunk].max())
            t = np.arange(steps)[:, None]
            mask = (t < length[chunk]).astype(np.float32)
            word = number[np.minimum(start[chunk] + t, len(number) - 1)]
            local, word = np.unique(word, return_inverse=True)
            word = word.reshape(steps, -1)
            part = _part(buckets, local)
            # words are often hidden as wholes, so that their characters learn to tell as well
            known = (random.random(len(local)) >= HIDDEN_WORDS).astype(np.float32)
            grads, d_x = gradients(model, word_inputs(model, part, known), word, mask, y[chunk], balance[chunk] / len(chunk))
            rows = np.unique(part["pair"])
            d_word = _sum_by(np.searchsorted(rows, part["pair"].T.ravel()), np.tile(d_x * known[:, None], (2, 1)), len(rows))
            grads["word"] = (rows, d_word + np.float32(1e-5) * model["word"][rows])
            if len(part["runs"]):
                rows = np.unique(part["runs"])
                count = np.diff(part["ends"])
                share = d_x / np.maximum(count, 1)[:, None].astype(np.float32)
                d_char = _sum_by(np.searchsorted(rows, part["runs"]), np.repeat(share, count, axis=0), len(rows))
                grads["char"] = (rows, d_char + np.float32(1e-5) * model["char"][rows])
            adam.step(model, grads)
    logits = np.full(len(label), -np.inf)
    np.maximum.at(logits, row, window_logits(model, word_inputs(model, buckets), number, start, length).astype(np.float64))
    back = (np.arange(len(label)) % HELD_BACK == 0) & np.isfinite(logits)
    model["out_bias"] = model["out_bias"] - np.float32(best_cut(logits[back], label[back]))
    return {k: np.ascontiguousarray(v, np.float32) for k, v in model.items()}


def _place(row: np.ndarray, first: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Place of each window among those of its document, in ascending order of ``by``."""
    out = np.empty(len(row), np.int64)
    out[np.lexsort((by, row))] = np.arange(len(row)) - first[row]
    return out


def best_cut(logits: np.ndarray, label: np.ndarray) -> float:
    """The middle of the widest gap between logits that errs least; 0 with one label only."""
    if not len(label) or label.min() == label.max():
        return 0.0
    order = np.argsort(logits, kind="stable")
    x, y = logits[order], label[order]
    # cut after i values: positives below and negatives above are errors
    wrong = np.append(0, np.cumsum(y > 0)) + np.append(np.cumsum((y == 0)[::-1])[::-1], 0)
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    wide = np.where(wrong == wrong.min(), np.diff(edges), -1)
    i = int(wide.argmax())
    return float((edges[i] + edges[i + 1]) / 2)


def _share_logit(label: np.ndarray) -> float:
    share = (label.sum() + 0.5) / (len(label) + 1.0)
    return float(np.log(share / (1 - share)))


def _part(buckets: dict, local: np.ndarray) -> dict:
    """The buckets of some of the distinct words."""
    starts = buckets["ends"][local]
    count = buckets["ends"][local + 1] - starts
    ends = np.append(0, np.cumsum(count))
    at = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], count)
    return {"pair": buckets["pair"][local], "runs": buckets["runs"][at], "ends": ends, "n": len(local)}


# --- on tables ------------------------------------------------------------------------


def learn(docs: DataFrame, labels: DataFrame, most: int = ROWS, label: str = "toxic") -> dict:
    """The network learned from at most ``most`` labelled documents of the folds not held out.

    One task learns from them, so that the driver holds no text; it gets the model, of fixed
    size.  Without a labelled text with words the output is the same for every text.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held and sum(b.num_rows for b in held):
            rows = pa.Table.from_batches(held)
            rows = rows.sort_by([("_label", "ascending"), ("_text", "ascending")]).combine_chunks()  # rows arrive in any order
            column, known = rows.column("_text").combine_chunks(), rows.column("_label").to_numpy().astype(np.int64)
            yield from text.pieces_of(train(column, known))

    sample = labelled_sample(docs, labels, label, most).where(F.col("_text").isNotNull())
    model = text.joined(sample.repartition(1).mapInArrow(fit, text.PIECES))
    if model is None:
        return new_model(0) | {"out": np.zeros(2 * HIDDEN, np.float32), "out_bias": np.zeros(1, np.float32)}
    return model


def score_texts(model: dict, texts: text.Texts) -> np.ndarray:
    """Highest window score of each whole text; 0 for a text without words."""
    out = np.zeros(len(texts))
    number, words, buckets = distinct_words(texts)
    row, start, length = windows_of(words)
    if len(row):
        logits = window_logits(model, word_inputs(model, buckets), number, start, length)
        np.maximum.at(out, row, _sigmoid(logits).astype(np.float64))
    return out


def score_toxicity(
    docs: DataFrame, model: dict, keep: list[str] | None = None, threshold: float = 0.5, column: str = "text", names: tuple[str, str] = ("score", "predicted")
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (by default all), score and predicted (1 from ``threshold`` on).

    Null and empty texts, and texts without a letter or digit, score 0.  ``names`` are
    those of the two new columns; columns so named are replaced.  Repeated rows are
    scored alike.  One map over the rows, no shuffle.
    """
    score_name, predicted_name = names
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    judged = text.fresh(docs, "_judged")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    held = docs.select(*(docs[f"`{c}`"] for c in kept), docs[f"`{column}`"].alias(judged))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in text.batches_by_size(batches, judged, 2 << 20):
            score = score_texts(model, text.texts_of(batch.column(judged)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], [*kept, score_name])

    scored = held.mapInArrow(run, StructType(held.schema.fields[:-1]).add(score_name, "double"))
    return scored.withColumn(predicted_name, (F.col(f"`{score_name}`") >= threshold).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (text.table(spark, sf_dir, t) for t in ("documents", "labels"))
    scored = score_toxicity(docs, learn(docs, labels), ["doc_id"])
    return scored.select("doc_id", (text.remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
