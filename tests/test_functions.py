"""Scalar functions on hand-written values."""

import pytest
from pyspark.sql import functions as F

from layerframe.functions import dates, urls
from layerframe.functions import geometry as G
from layerframe.functions import spatial_reference as SR
from layerframe.functions import variants as V


def evaluate(spark, texts, column):
    """The column over one-column rows of JSON texts, in order."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    found = rows.select("i", F.try_parse_json("j").alias("v"), "j").select("i", column.alias("r")).orderBy("i").collect()
    return [r.r for r in found]


v = lambda: F.col("v")  # noqa: E731  (columns need a session, so not at import)


def test_date_normalization(spark):
    texts = ["0", "1705320000000", "-86400000", "1705320000123", "1705320000000.7", '"1705320000000"', '"soon"', "null", "1" + "0" * 30, "true"]
    assert evaluate(spark, texts, dates.normalize_date(v())) == [
        "1970-01-01T00:00:00+00:00",
        "2024-01-15T12:00:00+00:00",
        "1969-12-31T00:00:00+00:00",
        "2024-01-15T12:00:00.123000+00:00",
        "2024-01-15T12:00:00+00:00",
        "2024-01-15T12:00:00+00:00",
        "soon",
        None,
        "1" + "0" * 30,
        "1970-01-01T00:00:00.001000+00:00",
    ]


def test_year_bounds_stay_raw(spark):
    texts = ["253402300799999", "253402300800000", "-62135596800000", "-62135596800001"]
    assert evaluate(spark, texts, dates.normalize_date(v())) == [
        "9999-12-31T23:59:59.999000+00:00", "253402300800000", "0001-01-01T00:00:00+00:00", "-62135596800001",
    ]


def test_dates_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert evaluate(spark, ["1705320000000"], dates.normalize_date(v())) == ["2024-01-15T12:00:00+00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_exact_large_integers(spark):
    assert evaluate(spark, ["9007199254740993", "2147483649"], V.as_int(v())) == [9007199254740993, 2147483649]


def test_lax_values(spark):
    texts = ["7", "7.0", "7.5", '"7"', '"x"', "true", "null", "[1]"]
    assert evaluate(spark, texts, V.lax_int(v())) == [7, 7, None, 7, None, 1, None, None]
    texts = ["true", "0", '"Yes"', '"maybe"', "2", "null", "{}"]
    assert evaluate(spark, texts, V.lax_bool(v())) == [True, False, True, None, None, None, None]
    texts = ["true", "false", "0", "0.0", '""', '"false"', "[]", "[0]", "{}", '{"a":0}', "null", "3"]
    assert evaluate(spark, texts, V.truthy(v())) == [True, False, False, False, False, True, False, True, False, True, False, True]


@pytest.mark.parametrize(
    "text, null",
    [
        ("null", True), ("5", True), ("{}", True), ('{"x": null, "y": null}', True), ('{"x": "NaN", "y": "nan"}', True),
        ('{"spatialReference": {"wkid": 1}, "hasZ": true, "has_m": false}', True), ('{"rings": []}', False),
        ('{"rings": null}', True), ('{"x": "NaN", "y": 1}', False), ('{"x": "5"}', False), ('{"points": [[1, 2]]}', False),
        ('{"curveRings": []}', False), ('{"x": 1, "y": null}', False), ('{"rings": "NAN"}', True),
    ],
)
def test_null_geometry(spark, text, null):
    assert evaluate(spark, [text], G.is_null_geometry(v())) == [null]


def test_spatial_references(spark):
    texts = ['{"wkid": 102100, "latestWkid": 3857}', '{"latestWkid": 0, "wkid": 4326}', '{"wkid": "4326"}', "4326", '"2263"', '"x"', "null", "4326.5"]
    assert evaluate(spark, texts, SR.epsg(v())) == [3857, 4326, None, 4326, 2263, None, None, None]
    assert evaluate(spark, texts, SR.raw(v()).isNotNull()) == [True, True, True, False, False, False, False, False]


def test_feature_reference_beats_fallback(spark):
    texts = ['{"x": 1, "y": 2, "spatialReference": {"wkid": 4326}}', '{"x": 1, "y": 2, "spatialReference": null}', '{"x": 1, "y": 2}']
    shape = G.normalize_geometry(v(), F.parse_json(F.lit('{"wkid": 2263}')))
    assert evaluate(spark, texts, shape["srid"]) == [4326, 2263, 2263]
    assert evaluate(spark, texts, F.to_json(shape["coords"])) == ['{"x":1,"y":2}'] * 3


def test_curves_differ_between_the_two_type_functions(spark):
    texts = ['{"curvePaths": []}', '{"curveRings": []}', '{"xmin": 0, "ymin": 0, "xmax": 1, "ymax": 1}', '{"x": 1}']
    assert evaluate(spark, texts, G.infer_geometry_type(v())) == [None, None, "envelope", None]
    assert evaluate(spark, texts, G.esri_geometry_type(v())) == ["esriGeometryPolyline", "esriGeometryPolygon", "esriGeometryEnvelope", None]


def test_geojson_geometries(spark):
    import json

    cases = [
        ({"type": "Point", "coordinates": [1, 2, 3, 4]}, {"x": 1, "y": 2, "z": 3, "m": 4}, "esriGeometryPoint"),
        ({"type": "MultiPoint", "coordinates": [[1, 2], [3, 4, 5]]}, {"points": [[1, 2], [3, 4, 5]], "hasZ": True}, "esriGeometryMultipoint"),
        ({"type": "LineString", "coordinates": [[1, 2], [3, 4]]}, {"paths": [[[1, 2], [3, 4]]]}, "esriGeometryPolyline"),
        ({"type": "Feature", "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"x": 1, "y": 2}, "esriGeometryPoint"),
        (
            {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [0, 0]]], [[[5, 5], [6, 6], [5, 5]]]]},
            {"rings": [[[0, 0], [1, 0], [0, 0]], [[5, 5], [6, 6], [5, 5]]]},
            "esriGeometryPolygon",
        ),
    ]
    result = G.geojson_to_esri(v())
    found = evaluate(spark, [json.dumps(c[0]) for c in cases], F.struct(F.to_json(result["geometry"]).alias("g"), result["geometry_type"].alias("t")))
    assert [(json.loads(r.g), r.t) for r in found] == [c[1:] for c in cases]

def test_geojson_errors(spark):
    texts = ['{"type": "FeatureCollection", "features": []}', '{"type": "Feature"}', '{"type": "Point", "coordinates": [1]}', "5", '{"x": 1}', '{"type": "Polygon"}']
    found = evaluate(spark, texts, G.geojson_to_esri(v()))
    assert all(r.error and r.geometry is None and r.geometry_type is None for r in found)


def test_urls(spark):
    rows = spark.createDataFrame(
        [(0, "https://h/x/FeatureServer/3?token=abc&f=json"), (1, "https://h:8/a?f=1&TOKEN=q#token=z"), (2, "http://h/tokens?mytoken=1"), (3, "/plain"), (4, None)],
        "i int, u string",
    )
    found = rows.orderBy("i").select(urls.scrub_url(F.col("u")).alias("s"), urls.service_root(F.col("u")).alias("r"), urls.is_layer_url(F.col("u")).alias("l")).collect()
    assert [r.s for r in found] == ["https://h/x/FeatureServer/3?token=***&f=json", "https://h:8/a?f=1&TOKEN=***#token=z", "http://h/tokens?mytoken=1", "/plain", None]
    assert [r.r for r in found][:2] == ["https://h/x/FeatureServer", "https://h:8"]
    assert [r.l for r in found] == [False, False, True, False, None]
