"""Queries over layer metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerframe.functions import variants as V
from layerframe.sources.metadata import layer_fields, scan_metadata
from layerframe.workload.fixtures import table
from layerframe.workload.registry import query
from layerframe.workload.rows import cases, pick

# Five spellings of a layer document; %k is the key and %n the supplier's name.
DOCUMENTS = [
    '{"currentVersion":11.2,"id":%k,"name":"%n","type":"Feature Layer","objectIdField":"ignored",'
    '"fields":[{"name":"OBJECTID","type":"esriFieldTypeOID"},{"name":"NAME","type":"esriFieldTypeString","length":50},'
    '{"name":"BALANCE","type":"esriFieldTypeDouble"}],"maxRecordCount":2000,'
    '"advancedQueryCapabilities":{"supportsPagination":true},"extent":{"spatialReference":{"wkid":102100,"latestWkid":3857}}}',
    '{"id":"%k","name":"%n","type":"Feature Layer","objectIdField":"objectid",'
    '"fields":[{"name":"ObjectID","type":"esriFieldTypeInteger"}],"MaximumRecordCount":1000,'
    '"advancedQueryCapabilities":{"supportsPagination":false},"supportsPagination":true}',
    '{"id":%k,"Name":"%n","type":"Table","uniqueIdInfo":{"name":"GLOBALID"},'
    '"fields":[{"name":"GlobalID","type":"esriFieldTypeGlobalID"}],"max_record_count":500,"spatialReference":{"wkid":4326}}',
    '{"id":%k,"name":"%n","nameOfOwner":"x","type":"Feature Layer",'
    '"fields":[{"name":"A","type":"esriFieldTypeOID"},{"name":"B","type":"esriFieldTypeOID"}],"maxRecordCount":10,"Max Record Count":20,'
    '"supports_pagination":true}',
    '{"id":%k.5,"name":null,"type":7,"fields":[{"type":"esriFieldTypeOID2"},{"name":"NOTYPE"},{"name":"BAD","type":["x"]},"text",'
    '{"name":"OK","type":"esriFieldTypeSmallInteger"}],"maxRecordCount":null,"advancedQueryCapabilities":{"supportsPagination":"true"}}',
]


def documents(spark, sf_dir):
    text = F.replace(pick("s_suppkey", DOCUMENTS), F.lit("%k"), F.col("s_suppkey").cast("string"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("url"),
        F.lit(200).alias("status"),
        F.replace(text, F.lit("%n"), F.col("s_name")).alias("payload"),
    )


def layers(spark, sf_dir):
    return scan_metadata(documents(spark, sf_dir)).withColumn("s_suppkey", F.col("layer_url").cast("bigint"))


@query(
    "scan_metadata",
    f"""
SELECT s_suppkey, {cases("s_suppkey", ["s_suppkey", "s_suppkey", "s_suppkey", "s_suppkey", "NULL"])} AS id,
       {cases("s_suppkey", ["'Feature Layer'", "'Feature Layer'", "'Table'", "'Feature Layer'", "NULL"])} AS type,
       {cases("s_suppkey", ["3", "1", "1", "2", "3"])} AS n_fields,
       {cases("s_suppkey", ["102100", "NULL", "4326", "NULL", "NULL"])} AS wkid,
       {cases("s_suppkey", ["'11.2'", "NULL", "NULL", "NULL", "NULL"])} AS current_version
FROM supplier
""",
)
def scan_metadata_query(spark, sf_dir):
    return layers(spark, sf_dir).select(
        "s_suppkey", "id", "type", F.size("fields").alias("n_fields"),
        V.get(F.col("spatial_reference"), "wkid", to="int").alias("wkid"),
        V.get(F.col("body"), "currentVersion", to="string").alias("current_version"),
    )


@query(
    "layer_fields",
    """
WITH f(k, name, type) AS (VALUES (0, 'OBJECTID', 'OID'), (0, 'NAME', 'String'), (0, 'BALANCE', 'Double'), (1, 'ObjectID', 'Integer'),
  (2, 'GlobalID', 'GlobalID'), (3, 'A', 'OID'), (3, 'B', 'OID'), (4, 'NOTYPE', ''), (4, 'OK', 'SmallInteger'))
SELECT s_suppkey, name, type FROM supplier JOIN f ON s_suppkey % 5 = k
""",
)
def layer_fields_query(spark, sf_dir):
    return layer_fields(layers(spark, sf_dir)).select(F.col("layer_url").cast("bigint").alias("s_suppkey"), "name", "type")


@query(
    "object_id_field",
    f"""
SELECT s_suppkey, {cases("s_suppkey", ["'OBJECTID'", "'ObjectID'", "'GlobalID'", "NULL", "NULL"])} AS object_id_field,
       {cases("s_suppkey", ["NULL", "NULL", "NULL", "'ambiguous object id fields'", "'no object id field'"])} AS object_id_error
FROM supplier
""",
)
def object_id_field_query(spark, sf_dir):
    return layers(spark, sf_dir).select("s_suppkey", "object_id_field", "object_id_error")


@query(
    "max_record_count",
    f'SELECT s_suppkey, {cases("s_suppkey", ["2000", "1000", "500", "NULL", "NULL"])} AS max_record_count FROM supplier',
)
def max_record_count_query(spark, sf_dir):
    return layers(spark, sf_dir).select("s_suppkey", "max_record_count")


@query(
    "layer_name",
    f'SELECT s_suppkey, {cases("s_suppkey", ["s_name", "s_name", "s_name", "NULL", "NULL"])} AS name FROM supplier',
)
def layer_name_query(spark, sf_dir):
    return layers(spark, sf_dir).select("s_suppkey", "name")


@query(
    "supports_pagination",
    f"""
SELECT s_suppkey, {cases("s_suppkey", ["true", "false", "true", "true", "true"])} AS supports_pagination,
       {cases("s_suppkey", ["true", "false", "false", "true", "false"])} AS pagination_explicit
FROM supplier
""",
)
def supports_pagination_query(spark, sf_dir):
    return layers(spark, sf_dir).select("s_suppkey", "supports_pagination", "pagination_explicit")
