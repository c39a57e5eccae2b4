from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from layerframe.llm import near_duplicates as nd
from layerframe.llm import text
from layerframe.plans.scratch import cut_lineage
from layerframe.session import setting


def bag(t):
    words = (t or "").lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute_force(docs):
    """Class of each document: smallest id over chains of links of at least 0.8."""
    bags = [bag(t) for _, t in docs]
    at = list(range(len(docs)))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if bags[i] and bags[j] and 5 * sum((bags[i] & bags[j]).values()) >= 4 * sum((bags[i] | bags[j]).values()):
                at[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(docs):
        least[root(i)] = min(k, least.get(root(i), k))
    return [(k, least[root(i)]) for i, (k, _) in enumerate(docs)]


def found(spark, docs):
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, class_id string")
    return sorted((r.doc_id, r.class_id) for r in nd.near_duplicates(df).collect())


def test_signatures_estimate_weighted_jaccard():
    words = [f"w{i}" for i in range(300)]
    a = " ".join(words[:200] * 3 + words[200:])
    b = " ".join(words[:200] * 2 + words[150:])
    texts = text.texts_of(pa.array([a, b]))
    row, shingle, weight = nd.bags(texts)
    assert weight.max() > 1
    times = nd.signatures(row, shingle, weight, 2, 4000)
    assert np.isfinite(times).all()
    assert abs((times[0] == times[1]).mean() - similarity(bag(a), bag(b))) < 0.04


def test_elements_compare_as_multisets():
    texts = text.texts_of(pa.array(["a b c d e f " * 5, "a b c d e f " * 4 + "g h"]))
    row, shingle, weight = nd.bags(texts)
    one, two = (nd.elements(shingle[row == k], weight[row == k]) for k in (0, 1))
    both = nd.shared(one, two)
    assert nd.shared_by_all([one], [two]).tolist() == [[both]] and one.dtype == np.uint64
    a, b = bag("a b c d e f " * 5), bag("a b c d e f " * 4 + "g h")
    assert both == sum((a & b).values()) and len(one) == sum(a.values())


def test_classes_of_made_cases(spark):
    base = [f"word{i}" for i in range(120)]
    docs = [(1, " ".join(base))]
    docs += [(10 + i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(30)]
    other = [f"other{i}" for i in range(60)]
    docs += [(100, " ".join(other)), (101, " ".join(other[:30] + base[:30])), (102, " ".join(other).upper())]
    docs += [(200, None), (201, ""), (202, "  \n "), (203, "short text"), (204, "short text"), (204, "short text"), (205, "short  text !")]
    docs += [(300, "again " * 400), (301, "again " * 390), (302, "again " * 200)]
    assert found(spark, docs) == sorted(brute_force(docs))


def test_query_equals_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = nd.op2_near_duplicates(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.class_id) for r in rows) == sorted(brute_force(docs))


def test_chains_are_one_class_whatever_the_pivot(spark):
    # each text is near the next, while those far apart share a bucket at most
    words = [f"w{i}" for i in range(400)]
    docs = [(i, " ".join(words[i * 6 : i * 6 + 100])) for i in range(40)]
    assert found(spark, docs) == sorted(brute_force(docs))


def test_copies_of_one_text_with_their_own_changes(spark):
    random = np.random.default_rng(4)
    base = [f"base{i}" for i in range(110)]
    docs = [(0, " ".join(base))]
    for i in range(1, 90):
        words = list(base)
        for at in random.choice(110, random.integers(1, 9), replace=False):
            words[at] = f"own{i}x{at}" if random.random() < 0.8 else f"shared{at}"
        docs.append((i, " ".join(words[: len(words) - random.integers(0, 12)])))
    assert found(spark, docs) == sorted(brute_force(docs))


def test_texts_without_a_key_link_what_is_near_them(spark):
    # each keyed text is near the one without a key alone: the chain holds through it
    docs, want = [], []
    for g in range(12):
        words = [f"g{g}w{i}" for i in range(124)]
        docs += [(10 * g, " ".join(words[:100])), (None, " ".join(words[10:110])), (10 * g + 1, " ".join(words[20:120]))]
        want += [(10 * g, 10 * g), (10 * g + 1, 10 * g), (None, 10 * g)]
    # a repeated key with texts of its own, one of them near a text without a key
    other = [f"other{i}" for i in range(110)]
    docs += [(500, "quite another text of few words"), (500, " ".join(other[:100])), (None, " ".join(other[5:105])), (501, " ".join(other[10:]))]
    want += [(500, 500), (500, 500), (None, 500), (501, 500)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for _ in range(2):
        assert Counter((r.doc_id, r.class_id) for r in nd.near_duplicates(df).collect()) == Counter(want)
        df = df.where("doc_id IS NOT NULL OR text LIKE 'g%'").unionByName(df.where("doc_id IS NULL AND text NOT LIKE 'g%'")).coalesce(1)


def test_components(spark):
    links = [(bytes([a]), bytes([b])) for a, b in [(1, 2), (2, 3), (9, 3), (20, 21), (21, 22), (5, 5)]]
    rows = nd.components(spark.createDataFrame(links, "a binary, b binary")).collect()
    assert {r.node[0]: r.label[0] for r in rows} == {1: 1, 2: 1, 3: 1, 9: 1, 20: 20, 21: 20, 22: 20}


@pytest.mark.parametrize("tasks, at_once", [(1, 10**6), (1, 7), (6, 10**6), (6, 7)])
def test_components_of_chains_hubs_and_chance(spark, monkeypatch, tasks, at_once):
    text.ship_package()
    monkeypatch.setattr(nd, "STAR_LINKS", at_once)
    random = np.random.default_rng(tasks)
    links = [(i, i + 1) for i in range(60)] + [(100 + i, 101 + i) for i in (3, 1, 0, 2, 4)] + [(250, i) for i in range(200, 240)] + random.integers(300, 400, (70, 2)).tolist()
    smallest = {x: x for link in links for x in link}
    for _ in smallest:
        for a, b in links:
            smallest[a] = smallest[b] = min(smallest[a], smallest[b])
    name = lambda x: x.to_bytes(2, "big")
    writes = []
    monkeypatch.setattr(nd, "cut_lineage", lambda df, label: writes.append(label) or cut_lineage(df, label))
    with setting(spark, "spark.sql.shuffle.partitions", str(tasks)), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        rows = nd.components(spark.createDataFrame([(name(a), name(b)) for a, b in links], "a binary, b binary")).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.label for r in rows} == {name(x): name(y) for x, y in smallest.items() if any(x in link and link[0] != link[1] for link in links)}
    if (tasks, at_once) == (1, 10**6):
        assert len(writes) == 1  # what one task holds takes no round


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (8, "other text")]])
def test_keep_one(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS node", "1 AS n")
    kept = nd.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(k) for k, _ in rows})


def test_shared_counts_of_blocks(monkeypatch):
    monkeypatch.setattr(nd, "_COLUMNS", 7)
    random = np.random.default_rng(2)
    rows, columns = ([np.sort(random.choice(200, n, replace=False)).astype(np.uint64) for n in random.integers(0, 90, 12)] for _ in range(2))
    want = [[len(np.intersect1d(a, b)) for b in columns] for a in rows]
    assert nd.shared_by_all(rows, columns).tolist() == want
    assert nd.shared_by_all(rows, [np.zeros(0, np.uint64)]).tolist() == [[0]] * 12 and nd.shared_by_all([], columns).shape == (0, 12)


def test_long_texts_near_the_threshold(spark):
    random = np.random.default_rng(8)
    words = [f"w{i}" for i in random.integers(0, 5000, 12_000)]
    docs = [(0, " ".join(words))]
    for i, cut in enumerate((0.10, 0.19, 0.199, 0.2005, 0.21, 0.3), 1):
        docs.append((i, " ".join(words[int(len(words) * cut) :])))
    assert found(spark, docs) == sorted(brute_force(docs))


def test_blocks_lose_no_link_and_repeat_none(spark, monkeypatch):
    """One bucket of many labels, dealt into several blocks: its links connect what brute force connects, as a forest would per task."""
    monkeypatch.setattr(nd, "BLOCK_ROWS", 5)
    random = np.random.default_rng(6)
    base = np.arange(100, 190, dtype=np.uint64)
    bags = []
    for i in range(60):
        bag = base.copy()
        at = random.choice(90, random.integers(2, 14), replace=False)
        bag[at] = 10_000 + 100 * i + at if i % 3 else 5_000 + at
        bags.append(np.sort(bag))
    node = [bytes([i]) for i in range(60)]
    labels = [node[0] if i < 20 else node[i] for i in range(60)]
    members = spark.createDataFrame([(7, node[i], len(bags[i]), labels[i]) for i in range(60)], "bucket long, node binary, n long, label binary")
    table = spark.createDataFrame([(node[i], bags[i].tobytes()) for i in range(60)], "node binary, bag binary")
    links = [(bytes(r.a), bytes(r.b)) for r in nd.linked_blocks(members, table).collect()]

    def closure(pairs):
        sets = nd._Sets()
        for a, b in pairs:
            sets.join(a, b)
        return {frozenset(n for n in node if sets.top(n) == top) for top in map(sets.top, node)}

    held = [(node[i], labels[i]) for i in range(60)]
    near = [(node[i], node[j]) for i in range(60) for j in range(i) if (b := len(np.intersect1d(bags[i], bags[j]))) * 9 >= (len(bags[i]) + len(bags[j])) * 4]
    assert closure(held + links) == closure(held + near)
    assert len(links) < len(near) and all(labels[a[0]] != labels[b[0]] for a, b in links)
