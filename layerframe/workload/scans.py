"""Queries over scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerframe.functions import geometry as G
from layerframe.functions import variants as V
from layerframe.operators.domains import domain_codes
from layerframe.operators.frames import get_df, get_geo_df, read_whole
from layerframe.operators.integrity import id_report
from layerframe.plans.execute import landed_answers, read_layers
from layerframe.plans.paging import plan_requests
from layerframe.plans.rank import with_rank
from layerframe.plans.scratch import scratch_path
from layerframe.sources.metadata import layer_fields, scan_metadata
from layerframe.sources.pages import (
    scan_feature_batches,
    scan_features,
    scan_geo_chunks,
    scan_pages,
    scan_rows,
)
from layerframe.sources.policy import ReadPolicy
from layerframe.sources.sinks import write_features
from layerframe.streaming.pages import stream_page_table, write_stream
from layerframe.workload.fixtures import (
    CUSTOMER_FIELDS,
    CUSTOMERS_URL,
    ORDER_FIELDS,
    ORDERS_URL,
    customer_pages,
    order_features,
    order_pages,
    pack_pages,
    page_of,
    supplier_url,
    table,
)
from layerframe.workload.registry import query

ORDER_ROWS_SQL = """
SELECT o_orderkey AS "OBJECTID", o_custkey AS "CUSTKEY", o_orderstatus AS "STATUS", o_totalprice AS "PRICE",
       epoch_ms(o_orderdate) AS order_ms, o_orderpriority AS "PRIORITY",
       CAST(o_custkey % 360 - 180 AS DOUBLE) AS x, o_totalprice / 10000 AS y
FROM orders
"""


def _order_rows(rows):
    return rows.select(
        "OBJECTID",
        "CUSTKEY",
        "STATUS",
        "PRICE",
        F.unix_millis("ORDERDATE").alias("order_ms"),
        "PRIORITY",
        V.get(F.col("geometry"), "x", to="double").alias("x"),
        V.get(F.col("geometry"), "y", to="double").alias("y"),
    )


@query(
    "scan_pages",
    """
SELECT event_id // 500 AS page_index,
       CASE WHEN (event_id // 500) % 7 = 3 THEN 'not_object'
            WHEN (event_id // 500) % 7 = 5 THEN 'not_json'
            WHEN (event_id // 500) % 7 = 6 THEN 'service_error' ELSE 'ok' END AS status,
       CASE WHEN (event_id // 500) % 7 = 6 THEN 400 END AS error_code,
       CASE WHEN (event_id // 500) % 7 IN (0, 1, 2, 4) THEN count(*) END AS n_features
FROM events GROUP BY 1
""",
)
def scan_pages_query(spark, sf_dir):
    """Some payloads are a list, cut-off text or an error document."""
    page = F.col("page_index")
    features = table(spark, sf_dir, "events").select(
        F.lit("https://maps.example.com/rest/services/Web/Events/FeatureServer/0").alias("layer_url"),
        page_of("event_id", 500).alias("page_index"),
        F.col("event_id").alias("oid"),
        F.to_json(F.struct(F.struct("event_id", "event_type", "value").alias("attributes"))).alias("feature"),
    )
    pages = pack_pages(features, [])
    payload = (
        F.when(page % 7 == 3, F.lit("[1, 2]"))
        .when(page % 7 == 5, F.substring("payload", 1, 100))
        .when(page % 7 == 6, F.lit('{"error": {"code": 400, "message": "Invalid query"}}'))
        .otherwise(F.col("payload"))
    )
    scanned = scan_pages(pages.withColumn("payload", payload))
    return scanned.select(
        "page_index",
        "status",
        F.col("error.code").alias("error_code"),
        F.when(F.col("status") == "ok", F.size(V.elements(F.col("body"), "features")).cast("bigint")).alias("n_features"),
    )


@query(
    "scan_features",
    """
SELECT page_index, pos, oid FROM (
  SELECT o_orderkey // 1000 AS page_index, o_orderkey AS oid,
         row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS pos
  FROM orders) WHERE oid % 97 <> 0
""",
)
def scan_features_query(spark, sf_dir):
    """Every 97th entry of the feature lists is not an object."""
    features = order_features(spark, sf_dir)
    features = features.withColumn(
        "feature", F.when(F.col("oid") % 97 == 0, F.lit("42")).otherwise(F.col("feature"))
    )
    found = scan_features(scan_pages(pack_pages(features, ORDER_FIELDS)))
    return found.select(
        "page_index", F.col("pos").cast("bigint").alias("pos"), V.get(F.col("attributes"), "OBJECTID", to="bigint").alias("oid")
    )


@query(
    "scan_feature_batches",
    """
SELECT o_orderkey // 1000 AS page_index, count(*) AS n_features, min(o_orderkey) AS first_oid, max(o_orderkey) AS last_oid
FROM orders GROUP BY 1
""",
)
def scan_feature_batches_query(spark, sf_dir):
    batches = scan_feature_batches(scan_pages(order_pages(spark, sf_dir)))
    oid = lambda f: V.get(f, "attributes", "OBJECTID", to="bigint")
    return batches.select(
        "page_index",
        F.col("n_features").cast("bigint").alias("n_features"),
        oid(F.element_at("features", 1)).alias("first_oid"),
        oid(F.element_at("features", -1)).alias("last_oid"),
    )


@query("scan_rows", ORDER_ROWS_SQL)
def scan_rows_query(spark, sf_dir):
    features = scan_features(scan_pages(order_pages(spark, sf_dir)))
    return _order_rows(scan_rows(features, ORDER_FIELDS))


@query(
    "scan_geo_chunks",
    """
SELECT c_custkey // 500 AS page_index, count(*) AS n, count(*) FILTER (WHERE c_custkey % 10 <> 0) AS n_geometry,
       3857 AS srid, max(c_acctbal) FILTER (WHERE c_custkey % 10 <> 0) AS max_x
FROM customer GROUP BY 1
""",
)
def scan_geo_chunks_query(spark, sf_dir):
    """The layer's reference stamps chunks whose geometries state none."""
    point = F.to_json(F.struct(F.col("c_acctbal").alias("x"), F.col("c_custkey").alias("y")))
    missing = F.lit('{"x": null, "y": "NaN"}')
    pages = customer_pages(spark, sf_dir, geometry=F.when(F.col("c_custkey") % 10 == 0, missing).otherwise(point))
    layers = spark.range(1).select(
        F.lit(CUSTOMERS_URL).alias("layer_url"),
        F.parse_json(F.lit('{"wkid": 102100, "latestWkid": 3857}')).alias("spatial_reference"),
    )
    chunks = scan_geo_chunks(scan_pages(pages), layers)
    return chunks.groupBy("page_index").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("geometry").alias("n_geometry"),
        F.max("geometry.srid").alias("srid"),
        F.max(V.get(F.col("geometry.coords"), "x", to="double")).alias("max_x"),
    )


# Suppliers' line items as layers, read by one plan from pages that were landed in other windows.
LINES_SQL = """
ids AS (SELECT DISTINCT l_suppkey, l_orderkey * 8 + l_linenumber AS oid FROM lineitem),
placed AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY oid) - 1 AS place, count(*) OVER (PARTITION BY l_suppkey) AS total FROM ids),
asked AS (SELECT *, CASE l_suppkey % 4 WHEN 0 THEN 100000 WHEN 3 THEN 250 ELSE 100 END AS cap, l_suppkey % 4 AS k FROM placed),
requests AS (SELECT *, CASE WHEN total <= cap THEN 'single' WHEN k = 1 THEN 'offset' ELSE 'oid' END AS strategy,
                    CASE WHEN total <= cap THEN 0 WHEN k = 1 THEN place // 50 ELSE place // cap END AS page_index,
                    CASE WHEN total <= cap THEN place WHEN k = 1 THEN place % 50 ELSE place % cap END AS pos FROM asked)
"""
_LANDED = 40  # rows of a landed page


def _line_ids(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("oid"))
        .distinct()
        .withColumn("layer_url", supplier_url("l_suppkey"))
    )


def _line_layers(spark, sf_dir):
    """(ids with their place in the layer, layers as ``plan_requests`` takes them)."""
    ids = with_rank(_line_ids(spark, sf_dir), ["oid"], ["layer_url", "l_suppkey"], "place")
    kind = F.col("l_suppkey") % 4
    layers = (
        ids.groupBy("layer_url", "l_suppkey")
        .agg(F.count(F.lit(1)).alias("total"))
        .select(
            "layer_url",
            "total",
            F.when(kind == 0, 100000).when(kind == 3, 250).otherwise(100).alias("max_record_count"),
            (kind != 2).alias("supports_pagination"),
            (kind == 1).alias("pagination_explicit"),
            F.when(kind == 1, 0.5).cast("double").alias("advertised_factor"),
            F.lit("OID").alias("object_id_field"),
            F.lit("1=1").alias("where"),
        )
    )
    return ids, layers


def _landed_lines(ids, spoiled=None, exceeded=None):
    """The layers' pages in windows of their own; ``spoiled`` replaces payloads, ``exceeded`` flags them."""
    page = F.expr(f"place div {_LANDED}")
    features = ids.select(
        "layer_url", page.alias("page_index"), "oid", F.to_json(F.struct(F.struct(F.col("oid").alias("OID")).alias("attributes"))).alias("feature")
    )
    pages = pack_pages(features, [{"name": "OID", "type": "esriFieldTypeOID"}], exceeded, oid_name="OID")
    return pages.select(
        "layer_url",
        (F.col("page_index") * _LANDED).alias("offset"),
        F.lit(_LANDED).cast("bigint").alias("count"),
        (F.col("payload") if spoiled is None else F.coalesce(spoiled, "payload")).alias("payload"),
    )


def _supplier(column="layer_url"):
    return F.regexp_extract(column, r"/S(\d+)/", 1).cast("bigint").alias("l_suppkey")


@query(
    "read_layer",
    f"WITH {LINES_SQL} SELECT l_suppkey, page_index, pos, oid FROM requests",
)
def read_layer_query(spark, sf_dir):
    """One plan over all layers: single requests, windows and id lists meet pages landed in other windows."""
    ids, layers = _line_layers(spark, sf_dir)
    reading = read_layers(plan_requests(layers, ids.select("layer_url", "oid")), landed_answers(_landed_lines(ids), "OID"))
    return reading.features.select(
        _supplier(), "page_index", F.col("pos").cast("bigint").alias("pos"), V.get(F.col("attributes"), "OID", to="bigint").alias("oid")
    )


@query(
    "read_layer_states",
    f"""WITH {LINES_SQL},
spoiled AS (SELECT *, (place // 40) % 6 = 5 AS bad, (place // 40) % 6 = 2 AS cut FROM requests),
per AS (SELECT l_suppkey, page_index, strategy, count(*) AS asked, count(*) FILTER (WHERE NOT bad) AS served,
               bool_or(bad) AS any_bad FROM spoiled GROUP BY ALL)
SELECT l_suppkey, page_index, strategy, asked, served AS found,
       CASE WHEN strategy = 'oid' AND served = 0 THEN 'unanswered' WHEN strategy <> 'oid' AND any_bad THEN 'failed'
            WHEN served < asked THEN 'short' ELSE 'complete' END AS state FROM per""",
)
def read_layer_states_query(spark, sf_dir):
    """Every sixth landed page is an error document: the requests it concerns are named, the rest is read."""
    ids, layers = _line_layers(spark, sf_dir)
    failed = F.when(F.col("page_index") % 6 == 5, '{"error": {"code": 500, "message": "Failed"}}')
    pages = _landed_lines(ids, spoiled=failed)
    reading = read_layers(
        plan_requests(layers, ids.select("layer_url", "oid")), landed_answers(pages, "OID"), ReadPolicy("quarantine", "ignore")
    )
    return reading.states.select(_supplier(), "page_index", "strategy", "asked", "found", "state")


@query(
    "id_report",
    """
WITH i AS (SELECT DISTINCT l_suppkey, l_orderkey * 8 + l_linenumber AS oid FROM lineitem)
SELECT l_suppkey, oid, CASE WHEN oid % 7 = 0 THEN 'repeated' WHEN oid % 11 = 0 THEN 'missing' ELSE 'unexpected' END AS problem,
       CASE WHEN oid % 7 = 0 THEN 2 WHEN oid % 11 = 0 THEN 0 ELSE 1 END AS n
FROM i WHERE (oid % 7 = 0 AND oid % 11 <> 0) OR (oid % 11 = 0 AND oid % 7 <> 0) OR (oid % 13 = 0 AND oid % 7 <> 0 AND oid % 11 <> 0)
UNION ALL
SELECT l_suppkey, NULL, 'null', count(*) FROM i WHERE oid % 17 = 0 GROUP BY 1
""",
)
def id_report_query(spark, sf_dir):
    """A read that holds some ids twice, lacks some, holds some unasked, and has rows without an id."""
    ids = _line_ids(spark, sf_dir)
    oid = F.col("oid")
    times = F.when(oid % 11 == 0, F.when(oid % 7 == 0, 1).otherwise(0)).when(oid % 7 == 0, 2).otherwise(1)
    read = F.concat(F.array_repeat(oid, times), F.when(oid % 17 == 0, F.array(F.lit(None).cast("bigint"))).otherwise(F.array()))
    rows = ids.select("layer_url", F.explode(read).alias("oid"))
    expected = ids.select("layer_url", "oid").where((oid % 13 != 0) | (oid % 7 == 0) | (oid % 11 == 0))
    return id_report(rows, "oid", expected).select(_supplier(), "oid", "problem", "n")


# Pages of 100 orders, some cut off, some broken.
DAMAGED_SQL = """
damaged AS (SELECT *, o_orderkey // 100 AS page, (o_orderkey // 100) % 7 = 3 AS cut, (o_orderkey // 100) % 7 = 5 AS failed,
                   (o_orderkey // 100) % 7 = 6 AS html FROM orders)
"""


def _damaged_pages(spark, sf_dir):
    page = F.col("page_index")
    pages = pack_pages(order_features(spark, sf_dir, 100), ORDER_FIELDS, exceeded=page % 7 == 3)
    payload = F.when(page % 7 == 5, '{"error": {"code": 504, "message": "Timed out"}}').when(page % 7 == 6, "<html></html>").otherwise(F.col("payload"))
    return pages.withColumn("payload", payload)


@query("get_df_ignore", f"""WITH {DAMAGED_SQL} SELECT o_orderkey AS "OBJECTID", o_totalprice AS "PRICE", cut AS truncated FROM damaged WHERE NOT failed AND NOT html""")
def get_df_ignore_query(spark, sf_dir):
    """Failed pages go to quarantine, rows of cut-off ones are flagged."""
    rows = get_df(_damaged_pages(spark, sf_dir), ORDER_FIELDS, policy=ReadPolicy("quarantine", "ignore"))
    return rows.select("OBJECTID", "PRICE", "truncated")


@query(
    "get_geo_df_ignore",
    f"""WITH {DAMAGED_SQL} SELECT o_orderkey AS object_id, 3857 AS srid, o_totalprice / 10000 AS y, cut AS truncated FROM damaged WHERE NOT failed AND NOT html""",
)
def get_geo_df_ignore_query(spark, sf_dir):
    features = get_geo_df(_damaged_pages(spark, sf_dir), 3857, ReadPolicy("quarantine", "ignore"))
    return features.select("object_id", "srid", V.get(F.col("geometry.coords"), "y", to="double").alias("y"), "truncated")


@query(
    "read_quarantine",
    f"""WITH {DAMAGED_SQL} SELECT DISTINCT page AS page_index, CASE WHEN failed THEN 'service_error' ELSE 'not_json' END AS status,
CASE WHEN failed THEN 504 END AS code FROM damaged WHERE failed OR html""",
)
def read_quarantine_query(spark, sf_dir):
    found = read_whole(_damaged_pages(spark, sf_dir), ORDER_FIELDS).quarantine
    return found.select("page_index", "status", "code")


@query(
    "read_states",
    f"""WITH {DAMAGED_SQL},
per AS (SELECT page, count(*) AS n, any_value(cut) AS cut, any_value(failed OR html) AS bad FROM damaged GROUP BY 1)
SELECT page AS page_index, CASE WHEN page % 10 <> 0 THEN n + CASE WHEN page % 4 = 1 THEN 1 ELSE 0 END END AS asked,
       CASE WHEN NOT bad THEN n END AS found, 1 AS landed,
       CASE WHEN bad THEN 'failed' WHEN cut THEN 'truncated' WHEN page % 10 = 0 THEN 'unplanned' WHEN page % 4 = 1 THEN 'short' ELSE 'complete' END AS state
FROM per
UNION ALL SELECT -1 - page, 1000, NULL, 0, 'missing' FROM per WHERE page % 3 = 0
""",
)
def read_states_query(spark, sf_dir):
    """Against a plan that asks some pages for a row more, leaves some out and names some that never landed."""
    page = page_of("o_orderkey", 100)
    counted = table(spark, sf_dir, "orders").groupBy(page.alias("page_index")).agg(F.count(F.lit(1)).alias("n"))
    index = F.col("page_index")
    plan = (
        counted.where(index % 10 != 0)
        .select(index, (F.col("n") + F.when(index % 4 == 1, 1).otherwise(0)).alias("count"))
        .unionByName(counted.where(index % 3 == 0).select((-1 - index).alias("page_index"), F.lit(1000).cast("bigint").alias("count")))
        .withColumn("layer_url", F.lit(ORDERS_URL))
    )
    return read_whole(_damaged_pages(spark, sf_dir), ORDER_FIELDS, plan).states.drop("layer_url")


@query(
    "get_df",
    """
SELECT c_custkey AS "OBJECTID", CASE WHEN c_nationkey % 5 <> 0 THEN n_name ELSE CAST(c_nationkey AS VARCHAR) END AS "NATION",
       c_acctbal AS "BALANCE", c_mktsegment AS "SEGMENT"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
)
def get_df_query(spark, sf_dir):
    """Whole layer with codes resolved from the layer's own metadata document."""
    codes = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 5 != 0)
    listed = codes.groupBy().agg(
        F.to_json(F.collect_list(F.struct(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")))).alias("cv")
    )
    documents = listed.select(
        F.lit(CUSTOMERS_URL).alias("url"),
        F.lit(200).alias("status"),
        F.concat(
            F.lit('{"type":"Feature Layer","fields":[{"name":"NATION","type":"esriFieldTypeInteger",'
                  '"domain":{"type":"codedValue","codedValues":'), "cv", F.lit("}}]}"),
        ).alias("payload"),
    )
    table_of_codes = domain_codes(layer_fields(scan_metadata(documents)))
    rows = get_df(customer_pages(spark, sf_dir), CUSTOMER_FIELDS, table_of_codes, ["NATION"])
    return rows.select("OBJECTID", "NATION", "BALANCE", "SEGMENT")


@query(
    "get_geo_df",
    """
SELECT o_orderkey AS object_id, 'point' AS geometry_type, 3857 AS srid,
       CAST(o_custkey % 360 - 180 AS DOUBLE) AS x, o_totalprice / 10000 AS y
FROM orders
""",
)
def get_geo_df_query(spark, sf_dir):
    """Two chunks of the layer, stamped with its reference and put together."""
    pages = order_pages(spark, sf_dir)
    features = get_geo_df([pages.where(F.col("page_index") % 2 == part) for part in (0, 1)], 3857)
    return features.select(
        "object_id", F.col("geometry.type").alias("geometry_type"), "srid",
        V.get(F.col("geometry.coords"), "x", to="double").alias("x"),
        V.get(F.col("geometry.coords"), "y", to="double").alias("y"),
    )


@query("stream_pages", ORDER_ROWS_SQL)
def stream_pages_query(spark, sf_dir):
    """Pages land in a table; a stream turns them into rows, a few files at a time."""
    landing, sink, log = (scratch_path(spark, p) for p in ("landing", "rows", "log"))
    order_pages(spark, sf_dir).select("layer_url", "page_index", "payload").write.parquet(landing)
    rows = scan_rows(scan_features(stream_page_table(spark, landing, max_files=3)), ORDER_FIELDS)
    write_stream(_order_rows(rows), sink, log).awaitTermination()
    return spark.read.parquet(sink)


@query(
    "write_features",
    """
SELECT o_orderstatus AS layer, o_orderkey AS "OBJECTID", o_totalprice AS "PRICE" FROM orders WHERE o_orderstatus <> 'P'
""",
)
def write_features_query(spark, sf_dir):
    """Rows written by layer and read back with two partitions selected."""
    path = scratch_path(spark, "features")
    rows = scan_rows(scan_features(scan_pages(order_pages(spark, sf_dir))), ORDER_FIELDS)
    rows = rows.withColumn("layer_url", F.concat(F.lit(f"{ORDERS_URL}/"), "STATUS"))
    write_features(rows.select("layer_url", "OBJECTID", "PRICE", G.normalize_geometry(F.col("geometry")).alias("geometry")), path)
    back = spark.read.parquet(path).where(F.col("layer_url") != f"{ORDERS_URL}/P")
    return back.select(F.substring_index("layer_url", "/", -1).alias("layer"), "OBJECTID", "PRICE")
