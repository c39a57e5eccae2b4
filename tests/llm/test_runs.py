"""Periodic runs against brute force, on small strings and on the whole small table."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from layerframe.llm import runs
from layerframe.llm.queries import QUERIES
from layerframe.llm.text import table


def plain_lyndon(x):
    """Length of the longest Lyndon word at each place: up to the next smaller suffix."""
    return [next((j - i for j in range(i + 1, len(x)) if x[j:] < x[i:]), len(x) - i) for i in range(len(x))]


def plain_runs(x, least=6, times=4):
    found = []
    for p in range(1, len(x) // times + 1):
        i = 0
        while i + p < len(x):
            start = i
            while i + p < len(x) and x[i] == x[i + p]:
                i += 1
            end = i + p
            primitive = not any(all(x[k] == x[k + q] for k in range(start, end - q)) for q in range(1, p))
            if i > start and end - start >= max(least, times * p) and primitive:
                found.append((start, end - start, p))
            i += 1 if i == start else 0
    return sorted(found, key=lambda r: (r[0], r[2]))


symbols = st.lists(st.integers(0, 2), max_size=40)
repeated = st.tuples(symbols, st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 8), symbols).map(
    lambda t: t[0] + t[1] * t[2] + t[3]
)


@settings(max_examples=300, deadline=None)
@given(st.one_of(symbols, repeated))
def test_groups_are_lyndon_words(x):
    group, length = runs.lyndon_groups(x)
    assert length == plain_lyndon(x)
    words = [tuple(x[i : i + n]) for i, n in enumerate(length)]
    assert len(set(zip(group, words, strict=True))) == len(set(group)) == len(set(words))


@settings(max_examples=400, deadline=None)
@given(st.one_of(symbols, repeated), st.sampled_from([(6, 4), (1, 3), (2, 5)]))
def test_runs_equal_brute_force(x, bounds):
    assert runs.word_runs(x, *bounds) == plain_runs(x, *bounds)
    assert runs.find_runs(x, *bounds) == sorted(plain_runs(x, *bounds))


def test_one_word_many_times():
    assert runs.word_runs(["a"] * 50_000) == [(0, 50_000, 1)]


def test_overlap_free_words_have_no_run():
    assert runs.word_runs([bin(i).count("1") % 2 for i in range(1 << 12)]) == []


def test_nested_runs_and_collapse():
    words = (b"a a a a a a b " * 4).split()
    found = runs.word_runs(words)
    assert (0, 28, 7) in found and len(found) == 5
    assert runs.kept_words(words, found) == [b"a", b"b"]
    assert runs.best_run(found) == (0, 6, 1)
    assert runs.best_run([]) is None


def test_too_few_times_is_an_error():
    with pytest.raises(ValueError):
        runs.find_runs([1, 1], times=2)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g = h // 10
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_fast(words)
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    start, length, period = best or (None, None, None)
    milli = 1000 * length // period if best else None
    return (doc_id, len(found), start, length, period, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def plain_fast(words):
    """Brute force over all periods with array comparisons."""
    import numpy as np

    ids = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([ids[w] for w in words], np.int64)
    found = {}
    for p in range(1, len(x) // 4 + 1):
        same = np.concatenate([[False], x[:-p] == x[p:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(edges[0::2].tolist(), edges[1::2].tolist(), strict=True):
            if stop + p - start >= max(6, 4 * p):
                found.setdefault((start, stop + p), p)  # the first, smallest period
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def test_query_equals_brute_force(spark, sf_dir):
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, sf_dir).collect()}
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id] == expected(d.doc_id, d.text), d.doc_id
    assert sum(r[1] > 0 for r in got.values()) > 10


def test_edge_rows(spark):
    rng = random.Random(3)
    long = " ".join(f"w{rng.randrange(9000)}" for _ in range(60_000)) + " end" + " x y" * 9
    rows = [(None, "a " * 7, 1), (1, None, 2), (2, "", 3), (3, " \t\n", 4), (4, long, 5), (4, long, 6), (5, "é\x0bé\x0cé é é é", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs int")
    got = runs.collapse_runs(docs, full=True).collect()
    assert len(got) == len(rows)
    nothing = hashlib.sha256(b"").hexdigest()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[None][0].collapsed == "a" and by_id[None][0].n_runs == 1
    for i in (1, 2, 3):
        r = by_id[i][0]
        assert (r.n_runs, r.start, r.exponent_milli, r.runs_sha256, r.collapsed_sha256, r.runs) == (0, None, None, nothing, nothing, [])
    assert [tuple(x) for x in by_id[4][0].runs] == [(60_001, 18, 2)] and by_id[4][0] == by_id[4][1]
    assert by_id[5][0].collapsed == "é"
    planted = runs.collapse_runs(docs, plant=True)
    assert planted.count() == len(rows)
    assert runs.collapse_runs(docs.limit(0)).count() == 0
    clash = docs.withColumnRenamed("n_runs", "_key").withColumn("a.b", docs.text)
    assert runs.collapse_runs(clash, column="a.b").where("n_runs > 0").count() == 4
