"""Queries over envelope checks and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerframe.operators.quality import (
    drift_report,
    error_envelopes,
    field_set_drift,
    page_keys,
    permissive_envelopes,
    strict_counts,
    strict_ids,
)
from layerframe.plans.scratch import cut_lineage, scratch_path
from layerframe.session import setting
from layerframe.sources.pages import scan_pages
from layerframe.streaming.drift import PROVIDER, ROCKSDB, stream_field_set_drift
from layerframe.streaming.pages import stream_page_table, write_stream
from layerframe.workload.fixtures import EVENTS_URL, ORDERS_URL, event_pages, order_pages, table
from layerframe.workload.registry import query
from layerframe.workload.rows import cases, pick


@query(
    "error_envelope",
    """
SELECT page_index, CASE WHEN page_index % 6 = 2 THEN 498 END AS code,
       CASE WHEN page_index % 6 = 2 THEN 'Invalid token' ELSE 'error response' END AS message
FROM (SELECT DISTINCT o_orderkey // 100 AS page_index FROM orders) WHERE page_index % 6 IN (2, 3)
""",
)
def error_envelope_query(spark, sf_dir):
    """Two usable error documents; one whose members have the wrong types is no error."""
    page = F.col("page_index") % 6
    payload = (
        F.when(page == 2, '{"error": {"code": "498", "message": "Invalid token", "details": ["x"]}}')
        .when(page == 3, '{"error": {}}')
        .when(page == 4, '{"error": {"code": "many", "message": "no"}}')
        .when(page == 5, '{"error": "text"}')
        .otherwise(F.col("payload"))
    )
    return error_envelopes(scan_pages(order_pages(spark, sf_dir, 100).withColumn("payload", payload))).select(
        "page_index", "code", "message"
    )


COUNTS = ['{"count": %k}', '{"count": "%k"}', '{"count": %k.0}', '{"count": %k.5}', '{"count": null}', "{}", "<html>", "[%k]"]


@query(
    "strict_count",
    f"""
SELECT o_orderkey, {cases("o_orderkey", ["o_orderkey"] * 3 + ["NULL"] * 5)} AS feature_count,
       o_orderkey % 8 > 2 AS rejected FROM orders
""",
)
def strict_count_query(spark, sf_dir):
    text = F.replace(pick("o_orderkey", COUNTS), F.lit("%k"), F.col("o_orderkey").cast("string"))
    good, rejected = strict_counts(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("payload")))
    return good.select("o_orderkey", "feature_count", F.lit(False).alias("rejected")).unionByName(
        rejected.select("o_orderkey", F.lit(None).cast("bigint").alias("feature_count"), F.lit(True).alias("rejected"))
    )


IDS = [
    '{"objectIdFieldName": "OID", "objectIds": [%k, 2147483649]}',
    '{"objectIdField": "OID", "objectIds": null}',
    '{"objectIdFieldName": "OID"}',
    '{"objectIdFieldName": "OID", "objectIds": [%k, "x"]}',
    '{"objectIds": [%k]}',
    '{"objectIdFieldName": "OID", "objectIds": "%k"}',
]


@query(
    "strict_envelope",
    f"""
SELECT o_orderkey, {cases("o_orderkey", ["'OID'", "'OID'", "'OID'", "NULL", "NULL", "NULL"])} AS object_id_field,
       {cases("o_orderkey", ["2", "0", "0", "NULL", "NULL", "NULL"])} AS n_ids,
       {cases("o_orderkey", ["2147483649", "NULL", "NULL", "NULL", "NULL", "NULL"])} AS last_id,
       {cases("o_orderkey", ["NULL", "NULL", "NULL", "'object ids are not a list of integers'", "'object id field name is missing or not text'", "'object ids are not a list of integers'"])} AS reason
FROM orders
""",
)
def strict_envelope_query(spark, sf_dir):
    text = F.replace(pick("o_orderkey", IDS), F.lit("%k"), F.col("o_orderkey").cast("string"))
    good, rejected = strict_ids(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("payload")))
    return good.select(
        "o_orderkey", "object_id_field", F.size("object_ids").alias("n_ids"),
        F.try_element_at("object_ids", F.lit(-1)).alias("last_id"), F.lit(None).cast("string").alias("reason"),
    ).unionByName(
        rejected.select(
            "o_orderkey", F.lit(None).cast("string").alias("object_id_field"), F.lit(None).cast("int").alias("n_ids"),
            F.lit(None).cast("bigint").alias("last_id"), "reason",
        )
    )


ENVELOPES = [
    '{"objectIdFieldName": "OID", "features": [{"attributes": {"A": %k}}], "exceededTransferLimit": true}',
    '{"objectIdFieldName": 7, "features": [{"attributes": {}}, 42, null], "hasZ": false}',
    '{"fields": [{"name": "A", "type": "esriFieldTypeOID"}, {"name": "B", "type": ["x"]}, "C"], "features": "none"}',
    '[%k]',
    '{"features": [], "exceededTransferLimit": "maybe", "fields": null, "extra": {"k": 1}}',
]


def envelopes(spark, sf_dir):
    text = F.replace(pick("p_partkey", ENVELOPES), F.lit("%k"), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").select(
        F.lit(ORDERS_URL).alias("layer_url"), F.col("p_partkey").alias("page_index"), text.alias("payload")
    )


EXTRAS = ["NULL", "'{\"hasZ\":false}'", "NULL", "NULL", "'{\"extra\":{\"k\":1}}'"]


@query(
    "permissive_envelope",
    f"""
SELECT p_partkey AS page_index, {cases("p_partkey", ["'OID'", "NULL", "NULL", "NULL", "NULL"])} AS object_id_field,
       {cases("p_partkey", ["NULL", "NULL", "1", "NULL", "NULL"])} AS n_fields,
       {cases("p_partkey", ["1", "1", "0", "0", "0"])} AS n_features, p_partkey % 5 = 0 AS exceeded,
       {cases("p_partkey", EXTRAS)} AS extras
FROM part
""",
)
def permissive_envelope_query(spark, sf_dir):
    return permissive_envelopes(scan_pages(envelopes(spark, sf_dir))).select(
        "page_index", "object_id_field",
        F.when(F.col("fields").isNotNull(), F.size("fields")).alias("n_fields"),
        F.size("features").alias("n_features"), "exceeded", F.to_json("extras").alias("extras"),
    )


@query(
    "drift_report",
    """
WITH d(k, path, kind, observed_type, sample) AS (VALUES
  (1, 'objectIdFieldName', 'bad_type', 'int', '7'), (1, 'features.1', 'bad_type', 'int', '42'), (1, 'features.2', 'bad_type', 'NoneType', 'null'),
  (1, 'hasZ', 'unknown_extra', 'bool', 'false'), (2, 'fields.1.type', 'bad_type', 'list', '["x"]'), (2, 'fields.2', 'bad_type', 'str', '"C"'),
  (2, 'features', 'bad_type', 'str', '"none"'), (3, '<root>', 'not_a_mapping', 'list', NULL),
  (4, 'exceededTransferLimit', 'bad_type', 'str', '"maybe"'), (4, 'extra', 'unknown_extra', 'dict', '{"k":1}'))
SELECT 'FeaturesResponse' AS model, path, kind, observed_type, min(coalesce(sample, '[' || p_partkey || ']')) AS sample, count(*) AS n_seen
FROM part JOIN d ON p_partkey % 5 = k GROUP BY ALL
""",
)
def drift_report_query(spark, sf_dir):
    return drift_report(envelopes(spark, sf_dir), "FeaturesResponse")


DESCRIPTIONS = [
    '{"id": %k, "name": "L", "layers": [{"id": %k, "name": "ok"}, {"id": "x", "name": 3, "own": 1}, 5]}',
    '{"id": 1, "layers": [{"layers": [{"fields": [{"name": 8}], "id": 1.5}]}], "folders": ["a", 2]}',
    '{"advancedQueryCapabilitiesTyped": {"supportsPagination": "maybe", "maxRecordCountFactor": [1], "other": 1}, "services": [1]}',
    '{"advancedQueryCapabilitiesTyped": 4, "layers": {"id": 1}, "url": "u"}',
    '{"id": "%k", "layers": null, "fields": [{"domain": "d"}]}',
]


@query(
    "drift_report_layers",
    """
WITH d(k, path, kind, observed_type, sample) AS (VALUES
  (0, 'layers.1.id', 'bad_type', 'str', '"x"'), (0, 'layers.1.name', 'bad_type', 'int', '3'), (0, 'layers.2', 'bad_type', 'int', '5'),
  (1, 'layers.0.layers.0.fields.0.name', 'bad_type', 'int', '8'), (1, 'layers.0.layers.0.id', 'bad_type', 'float', '1.5'), (1, 'folders.1', 'bad_type', 'int', '2'),
  (2, 'advancedQueryCapabilitiesTyped.supportsPagination', 'bad_type', 'str', '"maybe"'),
  (2, 'advancedQueryCapabilitiesTyped.maxRecordCountFactor', 'bad_type', 'list', '[1]'), (2, 'services.0', 'bad_type', 'int', '1'),
  (3, 'advancedQueryCapabilitiesTyped', 'bad_type', 'int', '4'), (3, 'layers', 'bad_type', 'dict', '{"id":1}'),
  (4, 'fields.0.domain', 'bad_type', 'str', '"d"'))
SELECT 'LayerMetadata' AS model, path, kind, observed_type, min(sample) AS sample, count(*) AS n_seen
FROM part JOIN d ON p_partkey % 5 = k GROUP BY ALL
""",
)
def drift_report_layers_query(spark, sf_dir):
    """Ill-typed members of layers within layers and of the typed capabilities."""
    text = F.replace(pick("p_partkey", DESCRIPTIONS), F.lit("%k"), F.col("p_partkey").cast("string"))
    return drift_report(table(spark, sf_dir, "part").select(text.alias("payload")), "LayerMetadata")


FIELD_SET_DRIFT_SQL = f"""
WITH present AS (
  SELECT DISTINCT user_id % 10 AS ctx, event_id // 100 AS page, unnest(['EVENTID', event_type]) AS key
  FROM events WHERE (event_id // 100) % 13 <> 6),
pages AS (SELECT ctx, page, row_number() OVER (PARTITION BY ctx ORDER BY page) - 1 AS n FROM (SELECT DISTINCT ctx, page FROM present)),
firsts AS (SELECT ctx, key, min(n) AS first FROM present JOIN pages USING (ctx, page) GROUP BY ALL),
gone AS (SELECT f.ctx, f.key, min(p.n) AS n FROM firsts f JOIN pages p ON p.ctx = f.ctx AND p.n >= 2 AND p.n > f.first
         ANTI JOIN present q ON q.ctx = f.ctx AND q.key = f.key AND q.page = p.page GROUP BY ALL)
SELECT '{EVENTS_URL}' || ctx AS context, 'field_appeared' AS kind, key, page AS at_page
FROM firsts JOIN pages USING (ctx) WHERE first = n AND first >= 2
UNION ALL
SELECT '{EVENTS_URL}' || ctx, 'field_disappeared', key, page FROM gone JOIN pages USING (ctx, n)
"""


@query("field_set_drift", FIELD_SET_DRIFT_SQL)
def field_set_drift_query(spark, sf_dir):
    """Event types as attribute keys of ten layers; the first two pages are the baseline."""
    return field_set_drift(page_keys(scan_pages(event_pages(spark, sf_dir))), learn_pages=2)


@query("stream_field_set_drift", FIELD_SET_DRIFT_SQL.replace("user_id % 10 AS ctx", "user_id % 10 + event_id // 100000 * 10 AS ctx"))
def stream_field_set_drift_query(spark, sf_dir):
    """The same over a stream of landed pages, a third of the files at a time; every 1,000 pages begin ten layers more."""
    landing, sink, log = (scratch_path(spark, p) for p in ("landing", "drift", "log"))
    number = F.regexp_extract("layer_url", "([0-9]+)$", 1).cast("bigint") + F.expr("page_index div 1000") * 10
    pages = event_pages(spark, sf_dir).withColumn("layer_url", F.concat(F.lit(EVENTS_URL), number.cast("string")))
    pages = cut_lineage(pages, "pages")
    # they arrive in three parts; a file of a part holds its layers' pages whole, so a layer's come in order
    last = pages.agg(F.max("page_index")).first()[0] or 0
    for part in range(3):
        arriving = pages.where(F.col("page_index").between(part * (last // 3 + 1), (part + 1) * (last // 3 + 1) - 1))
        arriving.repartition("layer_url").write.mode("append").parquet(landing)
    with setting(spark, PROVIDER, ROCKSDB):
        # each batch opens and commits the state of every partition, so their number does not grow with the files
        files = max(2, -(-len(spark.read.parquet(landing).inputFiles()) // 3))
        found = stream_field_set_drift(stream_page_table(spark, landing, max_files=files), learn_pages=2)
        write_stream(found, sink, log).awaitTermination()
    return spark.read.parquet(sink)
