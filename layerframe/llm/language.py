"""Language ID by prediction by partial matching over bytes.

Per language a context tree of orders 0 to ``order`` counts which byte followed which
context in a bounded sample of labelled texts.  The counts are then frozen.  A byte's
code length is that of PPM with escapes: from the longest context seen, either the
byte's own probability c/(N+q), or the escape q/(N+q) and the next shorter context; at
the end a uniform 1/256.  (N: symbols seen in the context, q: distinct ones.  A context
never seen costs nothing to leave.)  The text's language is the one with the shortest
total code over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerframe.llm import text

DOCS_PER_LANG = 1500  # about as many learning texts per language, chosen by hash
ORDER = 3
UNSEEN = 8.0  # bits of a byte that no context has seen
_LANGUAGES = 8  # looked up together


@dataclass
class Codes:
    """Frozen code lengths of what learning saw.

    A byte costs ``UNSEEN`` bits and what each seen run of bytes that ends in it adds: a
    context its escape, a context with the byte the difference between its own code and the
    one that escaping would have come to.  ``known`` marks the bytes seen in learning; any
    other counts as 0, which also stands before a text and is never seen.  ``blocks`` hold
    the runs of a few languages each.
    """

    languages: list[str]
    known: np.ndarray
    blocks: list[dict[str, np.ndarray]]


def _fourgrams(texts: text.Texts) -> np.ndarray:
    d, n = texts.data, len(texts.data)
    starts = texts.starts[texts.sizes > 0]
    out = d.astype(np.uint32)
    for by in (1, 2, 3):
        out |= _context(d, texts, starts, by, n).astype(np.uint32) << np.uint32(8 * by)
    return out


def _context(values: np.ndarray, texts: text.Texts, starts: np.ndarray, by: int, n: int) -> np.ndarray:
    out = np.zeros(n, values.dtype)
    out[by:] = values[: n - by]
    ends = texts.ends[texts.sizes > 0]
    for k in range(by):
        at = starts + k
        out[at[at < ends]] = 0
    return out


def learning_rows(docs: DataFrame, per_lang: int, seen: Column, lang: str, column: str, key: str) -> DataFrame:
    """About ``per_lang`` labelled rows of each language by hash of key; all where there are fewer."""
    labelled = docs.where(seen & F.col(lang).isNotNull() & F.col(column).isNotNull())
    share = labelled.groupBy(F.col(lang).alias("_lang")).agg((F.lit(float(per_lang)) / F.count(F.lit(1))).alias("_share"))
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 20)) / float(1 << 20)
    rows = labelled.select(F.col(lang).alias("_lang"), F.col(column).alias("_text"), place.alias("_place"))
    # one row per language, like the model itself
    return rows.join(F.broadcast(share), "_lang").where("_place < _share").select("_lang", "_text")


def count_contexts(rows: DataFrame) -> DataFrame:
    """(_lang, _gram, _n) of all runs of four bytes; counted in the tasks, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.batches_by_size(batches, "_text"):
            langs = batch.column("_lang").dictionary_encode()
            for k, name in enumerate(langs.dictionary.to_pylist()):
                of = text.texts_of(batch.column("_text").filter(pc.equal(langs.indices, k)))
                grams, n = np.unique(_fourgrams(of), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                    ["_lang", "_gram", "_n"],
                )

    counted = rows.mapInArrow(run, "_lang string, _gram long, _n long")
    return counted.groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n"))


def _runs(gram: np.ndarray, length: int, whole: bool) -> np.ndarray:
    """The last ``length`` bytes before a byte, with the byte if ``whole``, as one number for all lengths."""
    run = (gram & ((1 << (8 * (length + 1))) - 1)) >> (0 if whole else 8)
    return run | ((2 * length + whole) << 32)


def freeze(counts: pd.DataFrame, order: int = ORDER) -> Codes:
    """Codes of counted runs; their size grows with the runs that each language has, not with all by all."""
    languages = sorted(counts["_lang"].unique())
    counts = counts[(counts["_gram"] & 255) > 0]
    lang = np.searchsorted(np.array(languages, object), counts["_lang"].to_numpy(object))
    known = np.zeros(256, bool)
    known[counts["_gram"] & 255] = True
    blocks = []
    for low in range(0, len(languages), _LANGUAGES):
        mine = (lang >= low) & (lang < low + _LANGUAGES)
        seen = pd.DataFrame({"lang": lang[mine] - low, "gram": counts["_gram"].to_numpy(np.int64)[mine], "n": counts["_n"].to_numpy(np.float64)[mine]})
        blocks.append(_block(seen, order))
    return Codes(languages, known, blocks)


def _block(seen: pd.DataFrame, order: int) -> dict[str, np.ndarray]:
    """(run, lang, bits) by run, of rows (lang, gram, n)."""
    added = []
    shorter = None
    gram = seen["gram"].to_numpy(np.int64)
    for length in range(order + 1):
        own = seen.assign(run=_runs(gram, length, True), context=_runs(gram, length, False), less=_runs(gram, max(length - 1, 0), True))
        own = own.groupby(["lang", "run", "context", "less"], as_index=False)["n"].sum()
        of = own.groupby(["lang", "context"])["n"]
        n, q = of.transform("sum"), of.transform("size")
        own["code"], own["escape"] = -np.log2(own["n"] / (n + q)), -np.log2(q / (n + q))
        # what was seen after a context was also seen after its shorter one
        before = UNSEEN if shorter is None else own[["lang", "less"]].merge(shorter, how="left", on=["lang", "less"])["code"].to_numpy()
        own["more"] = own["code"] - own["escape"] - before
        added.append(own[["run", "lang", "more"]].rename(columns={"more": "bits"}))
        added.append(own[["context", "lang", "escape"]].drop_duplicates(["context", "lang"]).set_axis(["run", "lang", "bits"], axis=1))
        shorter = own[["lang", "run", "code"]].rename(columns={"run": "less"})
    table = pd.concat(added).sort_values(["run", "lang"])
    run, start = np.unique(table["run"].to_numpy(np.int64), return_index=True)
    return {"run": run, "start": np.append(start, len(table)), "lang": table["lang"].to_numpy(np.int8), "bits": table["bits"].to_numpy(np.float64)}


def code_lengths(codes: Codes, texts: text.Texts, order: int = ORDER) -> np.ndarray:
    """Bits of each whole text in each language; each distinct run of four bytes is looked up once."""
    out = np.zeros((len(texts), len(codes.languages)))
    full = np.flatnonzero(texts.sizes > 0)
    if not len(full):
        return out
    place, grams = pd.factorize(_fourgrams(replace(texts, data=np.where(codes.known[texts.data], texts.data, np.uint8(0)))))
    grams = grams.astype(np.int64)
    for b, block in enumerate(codes.blocks):
        low = b * _LANGUAGES
        n_lang = min(_LANGUAGES, len(codes.languages) - low)
        bits = np.full(len(grams) * n_lang, UNSEEN)
        for length in range(order + 1) if len(block["run"]) else ():
            for whole in (False, True):
                run = _runs(grams, length, whole)
                at = np.minimum(np.searchsorted(block["run"], run), len(block["run"]) - 1)
                gram = np.flatnonzero(block["run"][at] == run)
                first, last = block["start"][at[gram]], block["start"][at[gram] + 1]
                count = last - first
                entry = np.arange(count.sum()) + np.repeat(first - np.cumsum(count) + count, count)
                # a language has a run once, so no place comes twice
                bits[np.repeat(gram, count) * n_lang + block["lang"][entry]] += block["bits"][entry]
        lengths = np.take(bits.astype(np.float32).reshape(-1, n_lang), place, axis=0)
        out[full, low : low + n_lang] = np.add.reduceat(lengths, texts.starts[full], axis=0, dtype=np.float64)
    return out


def learn(docs: DataFrame, seen: Column, per_lang: int = DOCS_PER_LANG, order: int = ORDER, lang: str = "lang", column: str = "text", key: str = "doc_id") -> Codes | None:
    """Codes of the languages in ``lang``; None if no row is labelled.

    One task freezes the counts of the sample, bounded by ``per_lang``; the driver gets the codes in pieces.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if held and sum(b.num_rows for b in held):
            yield from text.pieces_of(vars(freeze(pa.Table.from_batches(held).to_pandas(), order)))

    counts = count_contexts(learning_rows(docs, per_lang, seen, lang, column, key))
    codes = text.joined(counts.repartition(1).mapInArrow(fit, text.PIECES))
    return codes and Codes(**codes)


def identify(
    docs: DataFrame, codes: Codes | None, order: int = ORDER, column: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """The columns ``keep`` of ``docs`` (by default all) and lang_pred, score: the language of each whole text, ``und`` without a letter.

    The score is the best language's share when code lengths, averaged over at most 200
    bytes' worth of evidence, are taken as probabilities; 0 for ``und``.  Null and empty
    texts, and all texts where nothing was learned, are ``und``.  Equal code lengths
    go to the alphabetically first language.  ``names`` are those of the two new columns;
    columns so named are replaced.
    One map over the rows, no shuffle.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    judged = text.fresh(docs, "_judged")
    spark = docs.sparkSession
    frozen = spark.sparkContext.broadcast(codes and vars(codes))  # grows with the runs of the learning sample
    held = docs.select(*(docs[f"`{c}`"] for c in kept), docs[f"`{column}`"].alias(judged))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = frozen.value and Codes(**frozen.value)
        for batch in text.batches_by_size(batches, judged, 2 << 20):
            texts = text.texts_of(batch.column(judged))
            if codes is None:
                found, score = ["und"] * len(texts), np.zeros(len(texts))
            else:
                bits = code_lengths(codes, texts, order)
                best = bits.argmin(1)
                weight = np.minimum(1.0, 200.0 / np.maximum(texts.sizes, 1))[:, None]
                odds = np.exp2((bits.min(1, keepdims=True) - bits) * weight)
                score = 1.0 / odds.sum(1)
                found = [codes.languages[i] for i in best]
                for i in np.flatnonzero(~_has_letter(texts, batch.column(judged))):
                    found[i], score[i] = "und", 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string()), pa.array(score, pa.float64())], [*kept, *names]
            )

    schema = StructType(held.schema.fields[:-1]).add(names[0], "string").add(names[1], "double")
    return held.mapInArrow(run, schema)


def with_letter(docs: DataFrame, column: str = "text") -> DataFrame:
    """The rows whose text has a letter, which is all that can be asked where nothing was learned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text.batches_by_size(batches, column, 2 << 20):
            yield batch.filter(pa.array(_has_letter(text.texts_of(batch.column(column)), batch.column(column))))

    return docs.mapInArrow(run, docs.schema)


def _has_letter(texts: text.Texts, column: pa.Array) -> np.ndarray:
    """Whether a text has a letter; only texts without an ASCII letter are looked at one by one."""
    letter = ((texts.data | 32) - 97) < 26
    count = np.concatenate([[0], np.cumsum(letter)])
    found = count[texts.ends] > count[texts.starts]
    for i in np.flatnonzero(~found & (texts.sizes > 0)):
        found[i] = any(c.isalpha() for c in column[int(i)].as_py())
    return found


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text.table(spark, sf_dir, "documents")
    codes = learn(docs, text.remainder("doc_id", 3) != 1)
    found = identify(docs, codes, keep=["doc_id"])
    return found.select("doc_id", (text.remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
