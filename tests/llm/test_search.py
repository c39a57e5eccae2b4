import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerframe.llm import forest, topk, urls
from layerframe.llm.vectors import finite


def table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    return np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_topk_query_equals_brute_force(spark, sf_dir):
    ids, x = table(spark, sf_dir)
    x = np.floor(256 * x)
    got = by_query(topk.op4_exact_topk(spark, sf_dir).collect())
    for i in np.flatnonzero(ids % 50 == 0):
        scores = x @ x[i]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:5]
        assert got.pop(ids[i]) == [(ids[j], scores[j]) for j in order]
    assert not got


def plain_topk(rows, queries, k=5):
    out = {}
    for q, v in rows:
        if q in queries:
            scored = sorted({(-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q})
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_topk_with_ties_hot_vectors_and_few_rows(spark):
    rows = [(i, [1, 2, -1]) for i in range(300)] + [(i, [i % 7, -(i % 5), 3]) for i in range(300, 500)]
    df = spark.createDataFrame(rows, "id long, vec array<bigint>")
    got = by_query(topk.top_k(df, F.col("id") % 50 == 0, shard_rows=16).collect())
    assert got == plain_topk(rows, set(range(0, 500, 50)))
    few = [(0, [1, 1]), (1, [2, 0]), (1, [2, 0]), (50, [1 << 40, 5]), (None, [9, 9])]
    df = spark.createDataFrame(few, "id long, vec array<bigint>")
    got = by_query(topk.top_k(df, F.col("id") % 50 == 0).collect())
    assert got == plain_topk([r for r in few if r[0] is not None], {0, 50})
    assert topk.top_k(df.limit(0), F.col("id") % 50 == 0).collect() == []


def repeated_rows():
    """Every row doubled, a vector shared by many repeated ids, and ids with several vectors."""
    rows = [(i, [i % 7 + 1, -(i % 5), 3]) for i in range(40, 120)] * 2
    rows += [(i, [9, 9, 9]) for i in range(200, 212) for _ in range(6)]
    rows += [(300, [8, 9, 10 + i]) for i in range(9)] + [(301, [10 + i, 9, 10 - i]) for i in range(9)]
    return rows + [(0, [9, 9, 9])] * 8 + [(150, [20 + i, 20, 20]) for i in range(9)] + [(50, [1, -4, 3])] * 2


def test_topk_with_repeated_rows(spark):
    rows = repeated_rows()
    df = spark.createDataFrame(rows, "id long, vec array<bigint>").coalesce(1)
    for shard_rows in (16, 1 << 14):
        got = by_query(topk.top_k(df, F.col("id") % 50 == 0, shard_rows=shard_rows).collect())
        asked = {i for i, _ in rows if i % 50 == 0}
        want = {}
        for i in asked:
            scored = {(-sum(a * b for a, b in zip(v, w)), j) for q, v in rows if q == i for j, w in rows if j != i}
            want[i] = [(j, -s) for s, j in sorted(scored)[:5]]
        assert got == want


def test_topk_of_large_components_among_ordinary_ones(spark):
    random = np.random.default_rng(11)
    rows = [(i, [int(v) for v in random.integers(-200, 200, 4)]) for i in range(900)]
    # beyond exact doubles: scores that differ in their last digits, and one that passes 64 bits
    rows += [(1000 + i, [(1 << 40) + i % 3, 1 - i, 7, (1 << 33) - i]) for i in range(40)]
    rows += [(1100, [1 << 61, 5, 0, 0]), (1150, [-(1 << 62), 1, 2, 3]), (1200, [(1 << 26) + 1, 3, 3, 3])]
    df = spark.createDataFrame(rows, "id long, vec array<long>")
    for shard_rows in (16, 1 << 14):
        got = by_query(topk.top_k(df, F.col("id") % 50 == 0, shard_rows=shard_rows).collect())
        clamp = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
        for id_, vec in rows:
            if id_ % 50 == 0:
                scores = sorted((-clamp(sum(a * b for a, b in zip(vec, v))), i) for i, v in rows if i != id_)[:5]
                if -scores[0][0] < (1 << 63) - 1:  # scores held to 64 bits tie
                    assert [(i, s) for i, s in got[id_]] == [(i, -s) for s, i in scores]


def test_forest_with_repeated_rows(spark):
    rows = [(i, [float(c) for c in v]) for i, v in repeated_rows()]
    df = spark.createDataFrame(rows, "id long, vec array<double>").coalesce(1)
    got = by_query(forest.nearest(df, F.col("id") % 50 == 0).collect())
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    for i in {i for i, _ in rows if i % 50 == 0}:
        best = {}
        for v in x[ids == i]:
            for j, s in zip(ids, forest.cosine(v, x)):
                best[int(j)] = max(best.get(int(j), -2.0), s)
        best.pop(i)
        want = sorted((-s, j) for j, s in best.items())[:5]
        assert got[i] == [(j, -s) for s, j in want]


def test_finite(spark):
    bad = [None, [], [1.0, None], [float("nan")], [float("inf"), 1.0], [1.0, -2.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(bad)], "i int, v array<float>")
    assert [r.i for r in df.where(finite(F.col("v"))).collect()] == [5]


def test_tree_boxes_bound_every_row():
    random = np.random.default_rng(2)
    x = np.round(random.standard_normal((700, 6)) * 20)
    tree = topk.ShardTree(x, [[i] for i in range(700)])
    q = np.round(random.standard_normal((9, 6)) * 20)
    bounds = topk.upper_bounds(q, tree.low, tree.high)
    for n, node in enumerate(tree.nodes):
        assert ((x[node[0]] @ q.T).max(0) <= bounds[:, n]).all()
    leaves = [rows for rows, k, *_ in tree.nodes if k < 0]
    assert sorted(np.concatenate(leaves)) == list(range(700)) and max(map(len, leaves)) <= topk.LEAF


def exact_nearest(ids, x, i, k=5):
    scores = (x * x[i]).sum(1) / np.sqrt((x * x).sum(1)) / np.sqrt((x[i] * x[i]).sum())
    return [(ids[j], scores[j]) for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]


def test_forest_query_recall(spark):
    big = "/root/testdata/sf0.1"
    ids, x = table(spark, big)
    rows = spark.read.parquet(f"{big}/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS vec")
    # smaller leaves than in production, so that this small table is searched in part as well
    got = by_query(forest.nearest(rows, F.col("id") % 50 == 0, leaf_rows=64).collect())
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        best = dict(exact_nearest(ids, x, i))
        hits += len(best.keys() & dict(got[ids[i]]).keys())
        total += len(best)
        assert all(s == pytest.approx(best[j], abs=1e-12) for j, s in got[ids[i]] if j in best)
    assert hits / total >= 0.9
    assert len(got) == (ids % 50 == 0).sum()


def test_forest_edge_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(100, [0.0, 0.0]), (150, [2.0, 1.0]), (None, [1.0, 1.0]), (151, [1e200, 1e200])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    got = by_query(forest.nearest(df, F.col("id") % 50 == 0).collect())
    assert set(got) == {0, 50, 150}
    assert [j for j, _ in got[0]] == [1, 2, 3, 4, 5] and [j for j, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [j for j, _ in got[150]] == [151, 0, 1, 2, 3]
    assert got[150][0][1] == pytest.approx(3 / math.sqrt(10))
    assert forest.nearest(df.limit(0), F.col("id") % 50 == 0).collect() == []


# --- urls -------------------------------------------------------------------------------


def parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    cut = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:cut]


def rule(host, path):
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name)) if fits else None


def codes(url):
    out = []
    for c in url.lower():
        c = "0" if c in "0123456789" else c
        out.append(urls.ALPHABET.index(c if c in urls.ALPHABET else "*") + 1)
    return out


def plain_ratios(pages, order=2):
    """Scores by plain Witten-Bell smoothing, url by url."""
    models = {True: {}, False: {}}
    for url in pages:
        r = rule(*parts(url))
        if r and url:
            c = [0] * order + codes(url)
            for i in range(order, len(c)):
                for k in range(order + 1):
                    held = models[r.allow].setdefault(tuple(c[i - k : i]), {})
                    held[c[i]] = held.get(c[i], 0) + 1

    def p(model, context, s):
        base = 1 / urls.SYMBOLS if not context else p(model, context[1:], s)
        held = model.get(context)
        if not held:
            return base
        return (held.get(s, 0) + len(held) * base) / (sum(held.values()) + len(held))

    def ratio(url):
        c = [0] * order + codes(url)
        logs = [math.log(p(models[True], tuple(c[i - order : i]), c[i]) / p(models[False], tuple(c[i - order : i]), c[i])) for i in range(order, len(c))]
        return sum(logs) / len(logs)

    means = {a: np.mean([ratio(u) for u in pages if u and (r := rule(*parts(u))) and r.allow == a]) for a in (True, False)}
    return {u: ratio(u) - (means[True] + means[False]) / 2 for u in pages if u}


def test_url_query_equals_plain_models(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    plain = plain_ratios(list(pages.values()))
    rows = urls.op7_url_filter(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        url = pages[r.page_id]
        assert (r.host, r.path) == parts(url)
        found = rule(r.host, r.path)
        assert r.rule == (found and found.name)
        assert r.score == pytest.approx(plain[url], abs=1e-6)
        assert r.verdict == (("allow" if found.allow else "block") if found else ("allow" if plain[url] >= 0 else "block"))


def test_url_edge_rows(spark):
    made = [
        None, "", "no scheme", "HTTP://A.Example.NET/EN/x", "http://example.net/en/", "http://example.net", "http://notexample.net/en/1",
        "http://x.org/fr/a#/de", "http://ORG?x", "a://b://c/d", "http://example.com/de/\n?q", "http://ÄB.org/fr/é", "http://net/" + "a" * 3000,
    ]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(made * 2)], "page_id long, url string, host string")
    rows = sorted(urls.judge(df).collect())
    assert len(rows) == 2 * len(made)
    for r in rows:
        url = made[r.page_id % len(made)]
        assert (r.host, r.path) == parts(url)
        found = rule(r.host, r.path)
        assert r.rule == (found and found.name)
        if not url:
            assert r.verdict == "allow" and r.score is None
    assert urls.judge(df.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge(df.where("page_id < 3")).collect()} == {"allow"}


def test_exact_query_equals_its_sql(spark, sf_dir):
    import oracle

    from layerframe.llm.queries import ORACLE, QUERIES

    n, differ = oracle.differences(spark, oracle.connect(sf_dir), "op4", QUERIES["op4_exact_topk"], ORACLE["op4_exact_topk"], sf_dir)
    assert differ == [] and n > 0


def test_forest_recall_with_its_own_settings(spark, sf_dir):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect() if r.embedding is not None]
    rows = [(i, v) for i, v in rows if len(v) and np.isfinite(v).all() and v.any()]
    ids, x = np.array([i for i, _ in rows]), np.stack([v / np.linalg.norm(v) for _, v in rows])
    got = {}
    for r in forest.op5_random_projection_forest(spark, sf_dir).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = wanted = 0
    for i in np.flatnonzero(ids % 50 == 0):
        near = x @ x[i]
        near[ids == ids[i]] = -2
        best = set(ids[np.lexsort((ids, -near))[:5]].tolist())
        hits, wanted = hits + len(best & got[ids[i]]), wanted + len(best)
    assert hits >= 0.9 * wanted and wanted >= 50
