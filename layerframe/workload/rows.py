"""Queries over row and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerframe.functions import geometry as G
from layerframe.functions import spatial_reference as SR
from layerframe.functions import variants as V
from layerframe.functions.dates import normalize_date
from layerframe.functions.urls import host_key, scrub_url, service_root
from layerframe.operators.domains import resolve_domains
from layerframe.operators.normalize import normalize_features
from layerframe.sources.pages import attributes_of, feature_to_row, scan_features, scan_pages
from layerframe.workload.fixtures import (
    ORDERS_URL,
    customer_pages,
    millis,
    order_pages,
    pack_pages,
    page_of,
    table,
)
from layerframe.workload.registry import query


def pick(key, options: list[str]):
    """One of the texts by key modulo their number."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.col(key) % len(options) + 1).cast("int"))


def cases(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


@query(
    "feature_to_row",
    """
SELECT event_id, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN 'own' ELSE 'top' END AS id_from,
       CASE WHEN event_id % 4 = 0 THEN 'attribute' ELSE 'geometry' END AS geometry_from, 5 AS n_members
FROM events
""",
)
def feature_to_row_query(spark, sf_dir):
    """Clashing names: geometry replaces an attribute, other members never do."""
    e = F.col("event_id")
    attributes = F.to_json(
        F.struct(
            e.alias("OBJECTID"),
            F.col("event_type").alias("kind"),
            F.when(e % 3 == 0, "own").alias("id"),
            F.when(e % 2 == 0, "attribute").alias("geometry"),
        )
    )
    feature = F.concat(
        F.lit('{"attributes":'), attributes,
        F.when(e % 4 == 0, F.lit("")).otherwise(F.lit(',"geometry":{"x":1,"y":2}')),
        F.lit(',"id":"top","centroid":null}'),
    )
    features = table(spark, sf_dir, "events").select(
        F.lit(ORDERS_URL).alias("layer_url"), page_of("event_id", 500).alias("page_index"),
        e.alias("oid"), feature.alias("feature"),
    )
    found = scan_features(scan_pages(pack_pages(features, [])))
    row = F.col("row")
    return found.select(feature_to_row(F.col("feature")).alias("row")).select(
        V.get(row, "OBJECTID", to="bigint").alias("event_id"),
        V.get(row, "kind", to="string").alias("kind"),
        V.get(row, "id", to="string").alias("id_from"),
        F.when(V.is_object(V.get(row, "geometry")), "geometry")
        .otherwise(V.get(row, "geometry", to="string")).alias("geometry_from"),
        F.size(V.entries(row)).alias("n_members"),
    )


@query(
    "feature_attributes",
    """
SELECT event_id // 500 AS page_index, row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id) - 1 AS pos,
       CASE WHEN event_id % 10 IN (0, 1, 2) THEN 0 ELSE 2 END AS n_keys
FROM events
""",
)
def feature_attributes_query(spark, sf_dir):
    """Null, missing and ill-typed attributes are an empty object."""
    e = F.col("event_id")
    feature = (
        F.when(e % 10 == 0, '{"attributes":null}')
        .when(e % 10 == 1, '{"geometry":{"x":1,"y":1}}')
        .when(e % 10 == 2, '{"attributes":"none"}')
        .otherwise(F.to_json(F.struct(F.struct("event_id", "event_type").alias("attributes"))))
    )
    features = table(spark, sf_dir, "events").select(
        F.lit(ORDERS_URL).alias("layer_url"), page_of("event_id", 500).alias("page_index"),
        e.alias("oid"), feature.alias("feature"),
    )
    found = scan_features(scan_pages(pack_pages(features, [])))
    return found.select(
        "page_index", F.col("pos").cast("bigint").alias("pos"),
        F.size(V.entries(attributes_of(F.col("feature")))).alias("n_keys"),
    )


@query(
    "normalize_features",
    """
SELECT o_orderkey // 1000 AS page_index, o_orderkey AS object_id,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS order_date, o_totalprice AS price,
       'point' AS geometry_type, 3857 AS srid, 102100 AS raw_wkid, CAST(o_custkey % 360 - 180 AS DOUBLE) AS x, false AS has_z
FROM orders
""",
)
def normalize_features_query(spark, sf_dir):
    found = normalize_features(scan_pages(order_pages(spark, sf_dir)), normalize_dates=True)
    geometry = F.col("geometry")
    return found.select(
        "page_index",
        "object_id",
        V.get(F.col("attributes"), "ORDERDATE", to="string").alias("order_date"),
        V.get(F.col("attributes"), "PRICE", to="double").alias("price"),
        geometry["type"].alias("geometry_type"),
        geometry["srid"].alias("srid"),
        V.get(geometry["raw_sr"], "wkid", to="int").alias("raw_wkid"),
        V.get(geometry["coords"], "x", to="double").alias("x"),
        geometry["has_z"].alias("has_z"),
    )


@query(
    "hoist_object_id",
    f"""
SELECT o_orderkey // 1000 AS page_index, row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS pos,
       {cases("o_orderkey", ["o_orderkey", "o_orderkey", "o_orderkey", "NULL", "NULL", "NULL", "1"])} AS object_id
FROM orders
""",
)
def hoist_object_id_query(spark, sf_dir):
    """Numbers, numeric text and fractions count; other text and null do not."""
    key = F.col("o_orderkey").cast("string")
    shapes = [key, F.concat(F.lit('"'), key, F.lit('"')), F.concat(key, F.lit(".9")), F.lit('"abc"'), F.lit('"1.5"'), F.lit("null"), F.lit("true")]
    value = F.element_at(F.array(*shapes), (F.col("o_orderkey") % 7 + 1).cast("int"))
    features = table(spark, sf_dir, "orders").select(
        F.lit(ORDERS_URL).alias("layer_url"), page_of("o_orderkey", 1000).alias("page_index"),
        F.col("o_orderkey").alias("oid"),
        F.concat(F.lit('{"attributes":{"OBJECTID":'), value, F.lit("}}")).alias("feature"),
    )
    found = normalize_features(scan_pages(pack_pages(features, [])))
    return found.select("page_index", F.col("pos").cast("bigint").alias("pos"), "object_id")


@query(
    "epoch_ms_to_iso",
    """
WITH t AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events),
e AS (SELECT event_id, ms - CASE WHEN event_id % 2 = 0 THEN 3000000000000 ELSE 0 END - CASE WHEN event_id % 5 = 0 THEN ms % 1000 ELSE 0 END AS ms FROM t)
SELECT event_id,
       CASE WHEN event_id % 17 = 3 THEN 'soon' WHEN event_id % 17 = 4 THEN NULL
            WHEN event_id % 17 = 5 THEN '1000000000000000' WHEN event_id % 17 = 6 THEN '12.5'
            ELSE strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S')
                 || CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(((ms % 1000) + 1000) % 1000 AS VARCHAR), 3, '0') || '000' END || '+00:00'
       END AS iso
FROM e
""",
)
def epoch_ms_to_iso_query(spark, sf_dir):
    """Before and after 1970, with and without a fraction; text and overflow stay raw."""
    e = F.col("event_id")
    full = millis("ts")
    ms = full - F.when(e % 2 == 0, 3000000000000).otherwise(0) - F.when(e % 5 == 0, full % 1000).otherwise(0)
    text = (
        F.when(e % 17 == 3, '"soon"').when(e % 17 == 4, "null")
        .when(e % 17 == 5, "1000000000000000").when(e % 17 == 6, '"12.5"')
        .when(e % 17 == 7, F.concat(F.lit('"'), ms.cast("string"), F.lit('"')))
        .otherwise(ms.cast("string"))
    )
    return table(spark, sf_dir, "events").select("event_id", normalize_date(F.parse_json(text)).alias("iso"))


GEOMETRIES = [
    '{"x": 1, "y": 2}',
    '{"points": [[1, 2], [3, 4]], "hasZ": true}',
    '{"paths": [[[0, 0], [1, 1]]], "has_m": 1}',
    '{"rings": []}',
    '{"xmin": 0, "ymin": 0, "xmax": 1, "ymax": 1, "spatialReference": {"wkid": 4326}}',
    '{"curveRings": [[[0, 0]]]}',
    '{"x": null, "y": "NaN"}',
    '{"spatialReference": {"wkid": 4326}, "hasZ": true}',
    "{}",
    '{"x": "NaN", "y": 5, "spatial_reference": "2263"}',
    "null",
    '{"z": 1}',
]


@query(
    "infer_geometry_type",
    "SELECT c_custkey, "
    + cases("c_custkey", ["'point'", "'multipoint'", "'polyline'", "'polygon'", "'envelope'", "NULL", "'point'", "NULL", "NULL", "'point'", "NULL", "NULL"])
    + " AS geometry_type FROM customer",
)
def infer_geometry_type_query(spark, sf_dir):
    geometry = F.parse_json(pick("c_custkey", GEOMETRIES))
    return table(spark, sf_dir, "customer").select("c_custkey", G.infer_geometry_type(geometry).alias("geometry_type"))


@query(
    "normalize_geometry",
    "SELECT c_custkey, "
    + cases("c_custkey", ["true"] * 6 + ["false"] * 3 + ["true", "false", "true"]) + " AS present, "
    + cases("c_custkey", ["'point'", "'multipoint'", "'polyline'", "'polygon'", "'envelope'", "NULL", "NULL", "NULL", "NULL", "'point'", "NULL", "NULL"]) + " AS geometry_type, "
    + cases("c_custkey", ["3857"] * 4 + ["4326", "3857", "NULL", "NULL", "NULL", "2263", "NULL", "3857"]) + " AS srid, "
    + cases("c_custkey", ["false", "true", "false", "false", "false", "false", "NULL", "NULL", "NULL", "false", "NULL", "false"]) + " AS has_z, "
    + cases("c_custkey", ["false", "false", "true", "false", "false", "false", "NULL", "NULL", "NULL", "false", "NULL", "false"]) + " AS has_m, "
    + cases("c_custkey", ["2", "2", "2", "1", "4", "1", "NULL", "NULL", "NULL", "2", "NULL", "1"]) + " AS n_coord_keys FROM customer",
)
def normalize_geometry_query(spark, sf_dir):
    """The page's geometries through the composite, with a fallback reference."""
    pages = customer_pages(spark, sf_dir, geometry=pick("c_custkey", GEOMETRIES))
    found = normalize_features(scan_pages(pages), sr=F.parse_json(F.lit("3857")))
    geometry = F.col("geometry")
    return found.select(
        F.col("object_id").alias("c_custkey"),
        geometry.isNotNull().alias("present"),
        geometry["type"].alias("geometry_type"),
        geometry["srid"].alias("srid"),
        geometry["has_z"].alias("has_z"),
        geometry["has_m"].alias("has_m"),
        F.when(geometry.isNotNull(), F.size(V.entries(geometry["coords"]))).alias("n_coord_keys"),
    )


REFERENCES = [
    '{"wkid": 102100, "latestWkid": 3857}', '{"wkid": 4326}', '{"latestWkid": 0, "wkid": 2263}',
    '{"latestWkid": "3857", "wkid": 102100}', '{"wkt": "LOCAL"}', "4326", '"2263"', '"EPSG:4326"', "null", '{"wkid": 4326.5}',
]


@query(
    "normalize_sr",
    "SELECT s_suppkey, "
    + cases("s_suppkey", ["3857", "4326", "2263", "NULL", "NULL", "4326", "2263", "NULL", "NULL", "NULL"]) + " AS epsg, "
    + cases("s_suppkey", ["true"] * 5 + ["false"] * 4 + ["true"]) + " AS has_raw, "
    + cases("s_suppkey", ["102100", "4326", "2263", "102100", "NULL", "999", "999", "999", "999", "4326"]) + " AS layer_wkid FROM supplier",
)
def normalize_sr_query(spark, sf_dir):
    """References by themselves, and a layer's own one: the extent's before the top-level."""
    text = pick("s_suppkey", REFERENCES)
    document = F.parse_json(
        F.concat(F.lit('{"extent": {"spatialReference": '), text, F.lit('}, "spatialReference": {"wkid": 999}}'))
    )
    reference = F.parse_json(text)
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        SR.epsg(reference).alias("epsg"),
        SR.raw(reference).isNotNull().alias("has_raw"),
        V.get(SR.layer_raw(document), "wkid", to="int").alias("layer_wkid"),
    )


# Fixed values of the fixture: three of the five order priorities have a name.
PRIORITY_DOMAIN = {
    "type": "codedValue",
    "codedValues": [
        {"code": "1-URGENT", "name": "Urgent"},
        {"code": "2-HIGH", "name": "High"},
        {"code": "5-LOW", "name": "Low"},
        {"code": "3-MEDIUM"},
        "not a coded value",
    ],
}


@query(
    "resolve_domains",
    """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low'
                   ELSE o_orderpriority END AS o_orderpriority,
       CASE o_custkey % 4 WHEN 1 THEN 'One' WHEN 2 THEN 'Two' ELSE CAST(o_custkey % 4 AS VARCHAR) END AS part, o_totalprice
FROM orders
""",
)
def resolve_domains_query(spark, sf_dir):
    fields = [
        {"name": "o_orderpriority", "domain": PRIORITY_DOMAIN},
        {"name": "part", "domain": {"type": "codedValue", "codedValues": [{"code": 1, "name": "One"}, {"code": 2, "name": "Two"}, {"code": "3", "name": "text, not 3"}]}},
        {"name": "o_totalprice", "domain": {"type": "range", "range": [0, 10]}},
    ]
    rows = table(spark, sf_dir, "orders").withColumn("part", (F.col("o_custkey") % 4).cast("int"))
    return resolve_domains(rows, fields).select("o_orderkey", "o_orderpriority", "part", "o_totalprice")


@query(
    "resolve_domains_long",
    """
SELECT o_orderkey, CASE WHEN o_custkey % 2000 < 1500 THEN 'name ' || o_custkey % 2000 ELSE CAST(o_custkey % 2000 AS VARCHAR) END AS code,
       CASE (o_custkey + 1) % 3 WHEN 0 THEN 'even' WHEN 1 THEN 'odd' ELSE '9007199254740994' END AS wide
FROM orders
""",
)
def resolve_domains_long_query(spark, sf_dir):
    """A domain of 1,500 codes, and neighbouring 64-bit codes with one of them repeated."""
    first = 9007199254740992
    coded = lambda pairs: {"type": "codedValue", "codedValues": [{"code": c, "name": n} for c, n in pairs]}
    fields = [
        {"name": "code", "domain": coded((i, f"name {i}") for i in range(1500))},
        {"name": "wide", "domain": coded([(first, "replaced"), (first + 1, "odd"), (first, "even")])},
    ]
    custkey = F.col("o_custkey")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", (custkey % 2000).alias("code"), ((custkey + 1) % 3 + F.lit(first)).alias("wide")
    )
    return resolve_domains(rows, fields)


GEOJSON = [
    '{"type": "Point", "coordinates": [%k, 2]}',
    '{"type": "Point", "coordinates": [%k, 2, 3, 4]}',
    '{"type": "MultiPoint", "coordinates": [[%k, 2], [3, 4, 5]]}',
    '{"type": "LineString", "coordinates": [[%k, 0], [1, 1]]}',
    '{"type": "MultiLineString", "coordinates": [[[%k, 0, 0, 9], [1, 1, 0, 9]], [[2, 2, 0, 9], [3, 3, 0, 9]]]}',
    '{"type": "Polygon", "coordinates": [[[%k, 0], [1, 0], [1, 1], [%k, 0]]]}',
    '{"type": "MultiPolygon", "coordinates": [[[[%k, 0], [1, 0], [1, 1], [%k, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]], [[7, 7], [8, 7], [8, 8], [7, 7]]]]}',
    '{"type": "Feature", "geometry": {"type": "Point", "coordinates": [%k, 2]}}',
    '{"type": "FeatureCollection", "features": []}',
    '{"x": %k, "y": 2}',
    '{"type": "Circle", "coordinates": [%k, 2]}',
    '{"type": "Point", "coordinates": [%k]}',
]


@query(
    "geojson_to_esri",
    "SELECT c_custkey, "
    + cases("c_custkey", ["'esriGeometryPoint'"] * 2 + ["'esriGeometryMultipoint'", "'esriGeometryPolyline'", "'esriGeometryPolyline'",
                          "'esriGeometryPolygon'", "'esriGeometryPolygon'", "'esriGeometryPoint'", "NULL", "'esriGeometryPoint'", "NULL", "NULL"])
    + " AS geometry_type, "
    + cases("c_custkey", ["c_custkey"] * 8 + ["NULL", "c_custkey", "NULL", "NULL"]) + " AS first_x, "
    + cases("c_custkey", ["NULL", "NULL", "true", "NULL", "true", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL"]) + " AS has_z, "
    + cases("c_custkey", ["NULL", "NULL", "NULL", "NULL", "true", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL"]) + " AS has_m, "
    + cases("c_custkey", ["NULL", "3"] + ["NULL"] * 10) + " AS z, "
    + cases("c_custkey", ["NULL", "NULL", "2", "1", "2", "1", "3"] + ["NULL"] * 5) + " AS n_parts, "
    + cases("c_custkey", ["false"] * 8 + ["true", "false", "true", "true"]) + " AS failed FROM customer",
)
def geojson_to_esri_query(spark, sf_dir):
    text = F.replace(pick("c_custkey", GEOJSON), F.lit("%k"), F.col("c_custkey").cast("string"))
    converted = table(spark, sf_dir, "customer").select(
        "c_custkey", G.geojson_to_esri(F.parse_json(text)).alias("r")
    )
    g = F.col("r.geometry")

    parts = F.coalesce(*[V.elements(g, k) for k in ("points", "paths", "rings")])

    def first(path: str):
        return F.try_variant_get(g, path, "bigint")

    return converted.select(
        "c_custkey",
        F.col("r.geometry_type").alias("geometry_type"),
        F.coalesce(first("$.x"), first("$.points[0][0]"), first("$.paths[0][0][0]"), first("$.rings[0][0][0]")).alias("first_x"),
        V.get(g, "hasZ", to="boolean").alias("has_z"),
        V.get(g, "hasM", to="boolean").alias("has_m"),
        V.get(g, "z", to="bigint").alias("z"),
        F.when(parts.isNotNull(), F.size(parts)).alias("n_parts"),
        F.col("r.error").isNotNull().alias("failed"),
    )


@query(
    "esri_geometry_type",
    "SELECT c_custkey, "
    + cases("c_custkey", ["'esriGeometryPoint'", "'esriGeometryMultipoint'", "'esriGeometryPolyline'", "'esriGeometryPolygon'", "'esriGeometryEnvelope'",
                          "'esriGeometryPolygon'", "'esriGeometryPoint'", "NULL", "NULL", "'esriGeometryPoint'", "NULL", "NULL"])
    + " AS geometry_type FROM customer",
)
def esri_geometry_type_query(spark, sf_dir):
    geometry = F.parse_json(pick("c_custkey", GEOMETRIES))
    return table(spark, sf_dir, "customer").select("c_custkey", G.esri_geometry_type(geometry).alias("geometry_type"))


@query(
    "scrub_url",
    """
WITH u AS (SELECT page_id, split_part(url, '#', 1) AS base, CASE WHEN page_id % 4 = 1 THEN '#x?token=keep' ELSE '' END AS frag FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 2 THEN base || frag
                     ELSE base || CASE WHEN contains(base, '?') THEN '&' ELSE '?' END || 'Token=***&z=1' || frag END AS scrubbed
FROM u
""",
)
def scrub_url_query(spark, sf_dir):
    """Token parameters are added to most urls, and token-like fragments to some."""
    base = F.substring_index("url", "#", 1)
    fragment = F.when(F.col("page_id") % 4 == 1, "#x?token=keep").otherwise("")
    token = F.concat(
        F.when(F.contains(base, F.lit("?")), "&").otherwise("?"), F.lit("Token=s3cr"), F.col("page_id").cast("string"), F.lit("&z=1")
    )
    url = F.concat(base, F.when(F.col("page_id") % 3 == 2, "").otherwise(token), fragment)
    return table(spark, sf_dir, "pages").select("page_id", scrub_url(url).alias("scrubbed"))


@query(
    "service_root",
    """
SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') AS host_key,
       regexp_extract(url, '^[a-z]+://[^/?#]*')
       || CASE page_id % 3 WHEN 0 THEN '/rest/services/Roads/FeatureServer' WHEN 1 THEN '/rest/x/mapserver' ELSE '' END AS service_root
FROM pages
""",
)
def service_root_query(spark, sf_dir):
    host = F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1)
    tail = (
        F.when(F.col("page_id") % 3 == 0, "/rest/services/Roads/FeatureServer/3/query?f=json")
        .when(F.col("page_id") % 3 == 1, "/rest/x/mapserver")
        .otherwise("/plain/path?to=/FeatureServer")
    )
    url = F.concat(host, tail)
    return table(spark, sf_dir, "pages").select(
        "page_id", host_key(url).alias("host_key"), service_root(url).alias("service_root")
    )
