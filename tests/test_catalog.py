"""Catalog crawl on hand-written documents."""

import json

import pytest
from pyspark.sql import functions as F

from layerframe.errors import ServiceError
from layerframe.operators.catalog import broken_layer_count, crawl_catalog, feature_layers, layer_feature_count

A, B = "https://a.example.com/rest", "https://b.example.com/rest"
DOCUMENTS = {
    A: (200, {"folders": ["F", "Bad"], "services": [{"name": "S", "type": "MapServer"}]}),
    f"{A}/F": (200, {"services": [{"name": "F/T", "type": "FeatureServer"}, {"name": "F/U", "type": "FeatureServer"}]}),
    f"{A}/Bad": (200, {"error": {"code": 499, "message": "Token Required"}}),
    f"{A}/S/MapServer": (200, {"layers": [{"id": 0}, {"id": 1}, {"id": 2}]}),
    f"{A}/S/MapServer/0": (200, {"id": 0, "name": "zero", "type": "Feature Layer", "extra": 1}),
    f"{A}/S/MapServer/1": (500, None),
    f"{A}/F/T/FeatureServer": (200, {"layers": [{"id": 5}]}),
    f"{A}/F/T/FeatureServer/5": (200, {"error": {"message": "gone"}}),
    f"{A}/F/U/FeatureServer": (None, None),
}


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(u, s, None if d is None else json.dumps(d)) for u, (s, d) in DOCUMENTS.items()]
    return spark.createDataFrame(rows, "url string, status int, payload string")


@pytest.fixture(scope="module")
def roots(spark):
    return spark.createDataFrame([(A,), (B,)], "root_url string")


@pytest.mark.parametrize("live", [False, True])
def test_partial_failures_are_reported(documents, roots, live):
    lookup = (lambda urls: documents.join(urls, "url", "left_semi")) if live else documents
    found = crawl_catalog(roots, lookup)
    assert {(r.url, r.service_error) for r in found.services.collect()} == {
        (f"{A}/S/MapServer", None), (f"{A}/F/T/FeatureServer", None), (f"{A}/F/U/FeatureServer", "TransportError: no response"),
    }
    assert {(r.stage, r.url, r.message) for r in found.errors.collect()} == {
        ("base_metadata", B, "TransportError: no response"),
        ("folder_metadata", f"{A}/Bad", "ResponseError: Token Required (code=499)"),
        ("service_metadata", f"{A}/F/U/FeatureServer", "TransportError: no response"),
    }
    layers = {r.url: r for r in found.layers.collect()}
    assert {u.removeprefix(A): r.layer_error for u, r in layers.items()} == {
        "/S/MapServer/0": None, "/S/MapServer/1": "HttpError: status 500", "/S/MapServer/2": "TransportError: no response",
        "/F/T/FeatureServer/5": "ResponseError: gone",
    }
    assert layers[f"{A}/S/MapServer/0"].name == "zero" and layers[f"{A}/S/MapServer/2"].id == 2
    assert [r.url for r in feature_layers(found.layers).collect()] == [f"{A}/S/MapServer/0"]
    broken = {r.service_url.removeprefix(A): (r.n_layers, r.n_broken) for r in broken_layer_count(found.services, found.layers).collect()}
    assert broken == {"/S/MapServer": (3, 2), "/F/T/FeatureServer": (1, 1), "/F/U/FeatureServer": (0, 0)}


def test_counts_are_for_feature_layers(spark):
    layers = spark.createDataFrame([("u/0", "Feature Layer"), ("u/1", "Table"), ("u/2", "Feature Layer")], "url string, type string")
    counts = spark.createDataFrame([("u/0", 3), ("u/1", 4)], "url string, feature_count bigint")
    assert {(r.url, r.feature_count) for r in layer_feature_count(layers, counts).collect()} == {("u/0", 3), ("u/1", None), ("u/2", None)}


def test_fail_fast(documents, roots):
    with pytest.raises(ServiceError, match="base_metadata"):
        crawl_catalog(roots, documents, mode="failfast")
    with pytest.raises(ServiceError, match="Bad"):
        crawl_catalog(roots.where(F.col("root_url") == A), documents, mode="failfast")
    with pytest.raises(ValueError):
        crawl_catalog(roots, documents, mode="fast")


def test_a_url_landed_twice_is_one_document(spark):
    from layerframe.operators.catalog import one_per_url

    rows = [("a", 500, None), ("a", 200, '{"x": 1}'), ("a", 200, '{"x": 1}'), ("b", 503, "down"), ("c", None, None)]
    df = spark.createDataFrame(rows, "url string, status int, payload string")
    assert sorted(tuple(r) for r in one_per_url(df).collect()) == [("a", 200, '{"x": 1}'), ("b", 503, "down"), ("c", None, None)]
    root = "https://h/rest/services"
    documents = [
        (root, 200, '{"services": [{"name": "S", "type": "FeatureServer"}]}'),
        (f"{root}/S/FeatureServer", 200, '{"layers": [{"id": 0}]}'),
        (f"{root}/S/FeatureServer/0", 200, '{"id": 0, "type": "Feature Layer"}'),
    ] * 2
    found = crawl_catalog(spark.createDataFrame([(root,)], "root_url string"), spark.createDataFrame(documents, df.schema))
    assert (found.services.count(), found.layers.count()) == (1, 1)


def test_services_listed_twice_are_one(spark):
    root = "https://h/rest/services"
    listing = {"services": [{"name": "F/S", "type": "FeatureServer"}], "folders": ["F", "F"]}
    documents = [
        (root, 200, json.dumps(listing)),
        (f"{root}/F", 200, json.dumps({"services": listing["services"] * 2})),
        (f"{root}/F/S/FeatureServer", 200, '{"layers": [{"id": 0}, {"id": 0}, {"id": 1}]}'),
        (f"{root}/F/S/FeatureServer/0", 200, '{"id": 0, "type": "Feature Layer"}'),
    ]
    df = spark.createDataFrame(documents, "url string, status int, payload string")
    found = crawl_catalog(spark.createDataFrame([(root,), (root,)], "root_url string"), df)
    assert (found.services.count(), found.layers.count()) == (1, 2)
    assert [tuple(r) for r in broken_layer_count(found.services, found.layers).collect()] == [(f"{root}/F/S/FeatureServer", 2, 1)]
    assert [(r.root_url, r.root_error) for r in found.roots.collect()] == [(root, None)]


def test_choice_among_repeats_does_not_depend_on_order(spark):
    from layerframe.operators.catalog import one_per_url

    rows = [("a", 200, f'{{"x": {i}}}') for i in range(40)] + [("a", 503, None)] * 40 + [("b", None, None), ("b", 404, "z")]
    kept = set()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "url string, status int, payload string").repartition(5)
        kept.add(tuple(sorted((r.url, r.status, r.payload) for r in one_per_url(df).collect())))
    assert len(kept) == 1 and {r[0] for r in next(iter(kept))} == {"a", "b"} and dict((r[0], r[1]) for r in next(iter(kept))) == {"a": 200, "b": 404}


@pytest.mark.parametrize("live", [False, True])
def test_counts_within_the_crawl(spark, documents, roots, live):
    asked = []
    rows = [(f"{A}/S/MapServer/0", 200, '{"count": 12}'), (f"{A}/S/MapServer/1", 200, '{"count": 5}')]
    envelopes = spark.createDataFrame(rows, "url string, status int, payload string")

    def fetch(urls):
        asked.append(sorted(r.url for r in urls.collect()))
        return envelopes.join(urls, "url", "left_semi")

    found = crawl_catalog(roots, documents, counts=fetch if live else envelopes)
    assert {r.url.removeprefix(A): r.feature_count for r in found.layers.collect()} == {
        "/S/MapServer/0": 12, "/S/MapServer/1": None, "/S/MapServer/2": None, "/F/T/FeatureServer/5": None,
    }
    assert found.errors.where("stage = 'feature_count'").count() == 0
    assert asked == ([[f"{A}/S/MapServer/0"]] if live else [])
    for payload, status, said in (('{"count": "x"}', 200, "not an integer"), (None, 504, "status 504"), ('{"error": {"code": 1, "message": "no"}}', 200, "no (code=1)")):
        bad = spark.createDataFrame([(f"{A}/S/MapServer/0", status, payload)], envelopes.schema)
        failed = crawl_catalog(roots, documents, counts=bad)
        (error,) = failed.errors.where("stage = 'feature_count'").collect()
        assert said in error.message and failed.layers.where("feature_count IS NOT NULL").count() == 0
    nothing = crawl_catalog(roots, documents, counts=envelopes.limit(0))
    assert [r.message for r in nothing.errors.where("stage = 'feature_count'").collect()] == ["TransportError: no response"]


def test_documents_are_scanned_once(spark, documents, roots, tmp_path):
    documents.write.parquet(f"{tmp_path}/documents")
    landed = spark.read.parquet(f"{tmp_path}/documents")
    found = crawl_catalog(roots, landed)
    for frame in (found.services, found.layers, found.errors):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "payload" not in plan and "/documents]" not in plan
