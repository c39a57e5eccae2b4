"""Service documents derived by Spark from the driver's tables.

The tables hold no feature-service responses, so each query that needs some packs
table rows into page envelopes or metadata documents first.  Every group packed into
one document is bounded by construction (unique ids divided by the page size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.session import configure

SERVICES = "https://maps.example.com/rest/services"
ORDERS_URL = f"{SERVICES}/Sales/Orders/FeatureServer/0"
CUSTOMERS_URL = f"{SERVICES}/Sales/Customers/FeatureServer/0"
EVENTS_URL = f"{SERVICES}/Web/Events/FeatureServer/"

ORDER_FIELDS = [
    {"name": "OBJECTID", "type": "esriFieldTypeOID"},
    {"name": "CUSTKEY", "type": "esriFieldTypeBigInteger"},
    {"name": "STATUS", "type": "esriFieldTypeString"},
    {"name": "PRICE", "type": "esriFieldTypeDouble"},
    {"name": "ORDERDATE", "type": "esriFieldTypeDate"},
    {"name": "PRIORITY", "type": "esriFieldTypeString"},
]
CUSTOMER_FIELDS = [
    {"name": "OBJECTID", "type": "esriFieldTypeOID"},
    {"name": "NATION", "type": "esriFieldTypeInteger"},
    {"name": "BALANCE", "type": "esriFieldTypeDouble"},
    {"name": "SEGMENT", "type": "esriFieldTypeString"},
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def page_of(key: str, size: int) -> Column:
    return F.expr(f"{key} div {size}")


def millis(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


def supplier_url(column: str):
    return F.concat(F.lit(f"{SERVICES}/S"), F.col(column).cast("string"), F.lit("/FeatureServer/0"))


def _field_list(fields: list[dict]) -> str:
    return ",".join(
        f'{{"name":"{f["name"]}","type":"{f["type"]}","alias":"{f["name"]}"}}' for f in fields
    )


def pack_pages(
    features: DataFrame, fields: list[dict], exceeded: Column | None = None, oid_name: str = "OBJECTID"
) -> DataFrame:
    """(layer_url, page_index, payload) of feature texts.

    ``features``: layer_url, page_index, oid, feature (JSON text, null for no feature).
    ``exceeded`` is an expression over layer_url and page_index.
    """
    listed = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("oid", "feature"))), lambda s: s["feature"]), ","
    )
    flag = F.lit("false") if exceeded is None else F.when(exceeded, "true").otherwise("false")
    return (
        features.groupBy("layer_url", "page_index")
        .agg(listed.alias("_features"))
        .select(
            "layer_url",
            "page_index",
            F.concat(
                F.lit(f'{{"objectIdFieldName":"{oid_name}","fields":[{_field_list(fields)}],"features":['),
                "_features",
                F.lit('],"exceededTransferLimit":'),
                flag,
                F.lit("}"),
            ).alias("payload"),
        )
    )


def order_features(spark: SparkSession, sf_dir: str, size: int = 1000) -> DataFrame:
    """One feature text per order: attributes, and a point that carries its reference."""
    attributes = F.struct(
        F.col("o_orderkey").alias("OBJECTID"),
        F.col("o_custkey").alias("CUSTKEY"),
        F.col("o_orderstatus").alias("STATUS"),
        F.col("o_totalprice").alias("PRICE"),
        millis("o_orderdate").alias("ORDERDATE"),
        F.col("o_orderpriority").alias("PRIORITY"),
    )
    geometry = F.struct(
        (F.col("o_custkey") % 360 - 180).cast("double").alias("x"),
        (F.col("o_totalprice") / 10000).alias("y"),
        F.struct(F.lit(102100).alias("wkid"), F.lit(3857).alias("latestWkid")).alias("spatialReference"),
    )
    return table(spark, sf_dir, "orders").select(
        F.lit(ORDERS_URL).alias("layer_url"),
        page_of("o_orderkey", size).alias("page_index"),
        F.col("o_orderkey").alias("oid"),
        F.to_json(F.struct(attributes.alias("attributes"), geometry.alias("geometry"))).alias("feature"),
    )


def order_pages(spark: SparkSession, sf_dir: str, size: int = 1000) -> DataFrame:
    return pack_pages(order_features(spark, sf_dir, size), ORDER_FIELDS)


def customer_pages(spark: SparkSession, sf_dir: str, size: int = 500, geometry: Column | None = None) -> DataFrame:
    """Customers as points (balance, key); ``geometry`` overrides the geometry text."""
    point = F.to_json(
        F.struct(F.col("c_acctbal").alias("x"), F.col("c_custkey").cast("double").alias("y"))
    )
    attributes = F.to_json(
        F.struct(
            F.col("c_custkey").alias("OBJECTID"),
            F.col("c_nationkey").alias("NATION"),
            F.col("c_acctbal").alias("BALANCE"),
            F.col("c_mktsegment").alias("SEGMENT"),
        )
    )
    features = table(spark, sf_dir, "customer").select(
        F.lit(CUSTOMERS_URL).alias("layer_url"),
        page_of("c_custkey", size).alias("page_index"),
        F.col("c_custkey").alias("oid"),
        F.concat(
            F.lit('{"attributes":'), attributes, F.lit(',"geometry":'),
            point if geometry is None else geometry, F.lit("}"),
        ).alias("feature"),
    )
    return pack_pages(features, CUSTOMER_FIELDS)


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of ten event layers whose attribute keys vary with the event type.

    Every thirteenth page lists no features at all.
    """
    value = F.col("value")
    attributes = F.struct(
        F.col("event_id").alias("EVENTID"),
        *[F.when(F.col("event_type") == t, value).alias(t) for t in ("click", "error", "purchase", "signup", "view")],
    )
    page = page_of("event_id", 100)
    features = table(spark, sf_dir, "events").select(
        F.concat(F.lit(EVENTS_URL), (F.col("user_id") % 10).cast("string")).alias("layer_url"),
        page.alias("page_index"),
        F.col("event_id").alias("oid"),
        F.when(page % 13 != 6, F.to_json(F.struct(attributes.alias("attributes")))).alias("feature"),
    )
    return pack_pages(features, [{"name": "EVENTID", "type": "esriFieldTypeOID"}], oid_name="EVENTID")
