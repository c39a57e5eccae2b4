"""Queries over projections, predicates, aggregates, order and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerframe.functions.urls import is_layer_url
from layerframe.operators.layer import Layer
from layerframe.operators.spatial import spatial_filter
from layerframe.operators.union import union_chunks
from layerframe.plans.paging import emit_order, page_sizes
from layerframe.sources.metadata import require_feature_layer, scan_metadata
from layerframe.sources.pages import scan_features, scan_pages, scan_rows
from layerframe.workload.fixtures import ORDER_FIELDS, order_pages, table
from layerframe.workload.registry import query


def orders(spark, sf_dir) -> Layer:
    return Layer(table(spark, sf_dir, "orders"), "o_orderkey")


def lineitem(spark, sf_dir) -> Layer:
    return Layer(table(spark, sf_dir, "lineitem"))


def points(spark, sf_dir):
    """Customers as points: balance against key (thinned to 0..1000)."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.struct(
            F.col("c_acctbal").alias("x"),
            (F.col("c_custkey") % 1000).cast("double").alias("y"),
            F.lit(3857).alias("srid"),
        ).alias("geometry"),
    )


@query(
    "paged_value_counts",
    """
SELECT o_orderstatus AS "STATUS", count(o_orderstatus) AS "STATUS_count" FROM orders WHERE o_totalprice > 100000 GROUP BY 1
""",
)
def paged_value_counts_query(spark, sf_dir):
    """The whole way: pages, features, typed rows, predicate, value counts."""
    features = scan_features(scan_pages(order_pages(spark, sf_dir)))
    rows = scan_rows(features, ORDER_FIELDS, geometry=False)
    return Layer(rows, "OBJECTID", ORDER_FIELDS).where("PRICE > 100000").value_counts("STATUS")


@query("out_fields", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def out_fields_query(spark, sf_dir):
    return orders(spark, sf_dir).out_fields("o_orderkey, o_orderstatus,o_totalprice").df


@query("drop_geometry", "SELECT c_custkey FROM customer")
def drop_geometry_query(spark, sf_dir):
    return Layer(points(spark, sf_dir), "c_custkey").drop_geometry().df


@query("check_fields", "SELECT DISTINCT o_orderpriority FROM orders")
def check_fields_query(spark, sf_dir):
    layer = orders(spark, sf_dir)
    return layer.unique_values(layer.check_fields(["o_orderpriority"]))


@query("where", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000 AND o_orderstatus = 'F'")
def where_query(spark, sf_dir):
    layer = Layer(table(spark, sf_dir, "orders"), "o_orderkey", where="o_totalprice > 200000 AND o_orderstatus = 'F'")
    return layer.out_fields(["o_orderkey", "o_totalprice"]).df


@query(
    "refine_where",
    """
SELECT o_orderkey FROM orders
WHERE (o_orderstatus = 'F' OR o_totalprice > 400000) AND (o_orderpriority = '1-URGENT' OR o_custkey % 7 = 0)
""",
)
def refine_where_query(spark, sf_dir):
    layer = orders(spark, sf_dir).where("1=1").where("o_orderstatus = 'F' OR o_totalprice > 400000")
    return layer.where("o_orderpriority = '1-URGENT' OR o_custkey % 7 = 0").out_fields("o_orderkey").df


@query(
    "where_in_list",
    """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'AUTOMOBILE')
  AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""",
)
def where_in_list_query(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").where("c_mktsegment = 'AUTOMOBILE'").select("c_custkey")
    layer = orders(spark, sf_dir).where_in("o_orderpriority", ["1-URGENT", "2-HIGH"])
    return layer.where_in("o_custkey", wanted).out_fields("o_orderkey,o_custkey").df


@query(
    "where_in_long_list",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey % 3 = 0 AND o_custkey <= 7500",
)
def where_in_long_list_query(spark, sf_dir):
    """Two and a half thousand values, as texts against a whole-number field."""
    return orders(spark, sf_dir).where_in("o_custkey", [str(k) for k in range(0, 7501, 3)]).out_fields("o_orderkey,o_custkey").df


# A polygon with a hole; even-odd crossing numbers in both engines.
POLYGON = {
    "rings": [
        [[-500.0, 0.5], [9000.0, 100.5], [7000.0, 900.5], [3000.0, 300.5], [1000.0, 950.5], [-500.0, 0.5]],
        [[4000.0, 200.5], [6000.0, 200.5], [6000.0, 300.5], [4000.0, 300.5], [4000.0, 200.5]],
    ]
}


def _edges_sql() -> str:
    rows = []
    for ring in POLYGON["rings"]:
        rows += [f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(ring, ring[1:])]
    return ", ".join(rows)


@query(
    "spatial_filter",
    f"""
WITH e(x1, y1, x2, y2) AS (VALUES {_edges_sql()}),
p AS (SELECT c_custkey, c_acctbal AS x, CAST(c_custkey % 1000 AS DOUBLE) AS y FROM customer)
SELECT c_custkey FROM p JOIN e ON true
WHERE ((CAST(y1 AS DOUBLE) > y) <> (CAST(y2 AS DOUBLE) > y))
  AND x < (CAST(x2 AS DOUBLE) - CAST(x1 AS DOUBLE)) * (y - CAST(y1 AS DOUBLE)) / (CAST(y2 AS DOUBLE) - CAST(y1 AS DOUBLE)) + CAST(x1 AS DOUBLE)
GROUP BY c_custkey HAVING count(*) % 2 = 1
""",
)
def spatial_filter_query(spark, sf_dir):
    return spatial_filter(points(spark, sf_dir), "geometry", POLYGON, in_sr=3857).select("c_custkey")


@query(
    "spatial_filter_envelope",
    """
SELECT c_custkey FROM customer
WHERE c_acctbal BETWEEN 1000 AND 5000 AND c_custkey % 1000 BETWEEN 100 AND 700
""",
)
def spatial_filter_envelope_query(spark, sf_dir):
    box = {"xmin": 1000, "ymin": 100, "xmax": 5000, "ymax": 700}
    return Layer(points(spark, sf_dir), "c_custkey").spatial_filter(box).out_fields("c_custkey").df


# Suppliers as squares and as paths on a grid of whole numbers, against a square with a square hole.
SQUARES_SQL = """
WITH s AS (SELECT s_suppkey AS k, s_suppkey % 37 AS x, s_suppkey % 23 AS y, 1 + s_suppkey % 5 AS w FROM supplier),
b AS (SELECT k, x AS x0, y AS y0, x + w AS x1, y + w AS y1 FROM s)
"""
HOLED = {"rings": [[[5, 3], [30, 3], [30, 18], [5, 18]], [[10, 6], [20, 6], [20, 12], [10, 12]]]}


def _squares(spark, sf_dir, paths: bool = False):
    k = F.col("s_suppkey")
    x, y, w = k % 37, k % 23, k % 5 + 1
    corner = lambda a, b: F.array(a.cast("double"), b.cast("double"))
    # a path goes along the square's lower edge and up its right one
    corners = [corner(x, y), corner(x + w, y), corner(x + w, y + w)]
    line = F.array(F.array(*corners) if paths else F.array(*corners, corner(x, y + w)))
    shape = F.struct(line.alias("paths" if paths else "rings"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", shape.alias("geometry"))


@query(
    "spatial_filter_rings",
    f"""{SQUARES_SQL}
SELECT k AS s_suppkey FROM b
WHERE x0 >= 5 AND x1 <= 30 AND y0 >= 3 AND y1 <= 18 AND NOT (x0 < 20 AND x1 > 10 AND y0 < 12 AND y1 > 6)""",
)
def spatial_filter_rings_query(spark, sf_dir):
    """Squares inside, many of them with edges on the filter's own or corners on its hole."""
    return spatial_filter(_squares(spark, sf_dir), "geometry", HOLED, relation="contains").select("s_suppkey")


@query(
    "spatial_filter_paths",
    f"""{SQUARES_SQL},
seg AS (SELECT k, x0 AS a0, x1 AS a1, y0 AS c0, y0 AS c1 FROM b UNION ALL SELECT k, x1, x1, y0, y1 FROM b)
SELECT k AS s_suppkey FROM seg
WHERE a0 <= 30 AND a1 >= 5 AND c0 <= 18 AND c1 >= 3 AND NOT (a0 > 10 AND a1 < 20 AND c0 > 6 AND c1 < 12)
GROUP BY k""",
)
def spatial_filter_paths_query(spark, sf_dir):
    """Paths that meet the filter, be it at a point of its boundary."""
    return spatial_filter(_squares(spark, sf_dir, paths=True), "geometry", HOLED).select("s_suppkey")


@query(
    "is_layer_url",
    "SELECT page_id, regexp_matches(url, '[0-9]$') AS is_layer FROM pages",
)
def is_layer_url_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", is_layer_url(F.col("url")).alias("is_layer"))


@query(
    "require_feature_layer",
    """
SELECT s_suppkey, s_suppkey % 4 = 0 AS accepted,
       CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'the url must point to a Feature Layer'
            WHEN 2 THEN 'the url must point to a Feature Layer' ELSE 'HttpError: status 500' END AS reason
FROM supplier
""",
)
def require_feature_layer_query(spark, sf_dir):
    kind = F.col("s_suppkey") % 4
    documents = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("url"),
        F.when(kind == 3, 500).otherwise(200).alias("status"),
        F.when(kind == 0, '{"type": "Feature Layer"}').when(kind == 1, '{"type": "Table"}').otherwise("{}").alias("payload"),
    )
    good, rejected = require_feature_layer(scan_metadata(documents))
    key = F.col("layer_url").cast("bigint").alias("s_suppkey")
    return good.select(key, F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select(key, F.lit(False).alias("accepted"), "reason")
    )


@query("feature_count", "SELECT o_orderpriority, count(*) AS feature_count FROM orders WHERE o_totalprice > 50000 GROUP BY 1")
def feature_count_query(spark, sf_dir):
    return orders(spark, sf_dir).where("o_totalprice > 50000").feature_count(["o_orderpriority"])


@query("object_ids", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def object_ids_query(spark, sf_dir):
    return orders(spark, sf_dir).where("o_orderstatus = 'O'").object_ids()


@query("unique_values", "SELECT DISTINCT o_custkey FROM orders")
def unique_values_query(spark, sf_dir):
    return orders(spark, sf_dir).unique_values("o_custkey", sortby="o_custkey")


@query("unique_values_multi", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def unique_values_multi_query(spark, sf_dir):
    return lineitem(spark, sf_dir).unique_values(["l_returnflag", "l_linestatus", "l_linenumber"], sortby="l_linenumber")


@query(
    "value_counts",
    """
SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind,
       count(CASE WHEN event_type <> 'error' THEN event_type END) AS kind_count
FROM events GROUP BY 1
""",
)
def value_counts_query(spark, sf_dir):
    """One of the groups is null: it is kept, with a count of 0."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return Layer(table(spark, sf_dir, "events").select(kind.alias("kind"))).value_counts("kind")


@query(
    "nested_count",
    'SELECT l_returnflag, l_linestatus, count(l_linestatus) AS "Count" FROM lineitem GROUP BY 1, 2',
)
def nested_count_query(spark, sf_dir):
    return lineitem(spark, sf_dir).nested_count(["l_returnflag", "l_linestatus"])


@query(
    "page_sizes",
    "SELECT o_orderkey // 700 AS page_index, count(*) AS n_features FROM orders GROUP BY 1",
)
def page_sizes_query(spark, sf_dir):
    return page_sizes(scan_pages(order_pages(spark, sf_dir, 700))).select("page_index", "n_features")


@query("order_by_oid", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P'")
def order_by_oid_query(spark, sf_dir):
    return orders(spark, sf_dir).where("o_orderstatus = 'P'").order_by_oid().out_fields("o_orderkey,o_custkey").df


@query("page_slice", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1200")
def page_slice_query(spark, sf_dir):
    return orders(spark, sf_dir).page_slice(1200, 500).out_fields("o_orderkey,o_totalprice").df


@query(
    "page_slice_deep",
    "SELECT l_id, l_partkey FROM (SELECT l_orderkey * 8 + l_linenumber AS l_id, l_partkey FROM lineitem) "
    "ORDER BY l_id LIMIT 900 OFFSET (SELECT count(*) * 3 // 4 FROM lineitem)",
)
def page_slice_deep_query(spark, sf_dir):
    """Three quarters into the layer, beyond 100,000 rows from a scale of 0.1 on."""
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("l_id"), "l_partkey")
    layer = Layer(rows, "l_id")
    return layer.page_slice(layer.count() * 3 // 4, 900).df


@query("head", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 10")
def head_query(spark, sf_dir):
    return orders(spark, sf_dir).where("o_orderstatus = 'F'").head(10).out_fields("o_orderkey,o_totalprice").df


@query(
    "sample",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 50",
)
def sample_query(spark, sf_dir):
    return orders(spark, sf_dir).sample(50, seed=7).out_fields("o_orderkey,o_totalprice").df


@query(
    "emit_order",
    """
SELECT o_orderkey // 1000 AS page_index,
       row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1 AS pos, o_orderkey AS oid
FROM orders
""",
)
def emit_order_query(spark, sf_dir):
    found = emit_order(scan_features(scan_pages(order_pages(spark, sf_dir))), "request")
    return found.select(
        "page_index", F.col("pos").cast("bigint").alias("pos"),
        F.expr("try_variant_get(attributes, '$.OBJECTID', 'bigint')").alias("oid"),
    )


@query(
    "union_chunks",
    """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment END AS segment, 3857 AS srid FROM customer
""",
)
def union_chunks_query(spark, sf_dir):
    """Three chunks of one reference, one of them with a further column."""
    customers = table(spark, sf_dir, "customer")
    chunks = []
    for part in range(3):
        chunk = customers.where(F.col("c_custkey") % 3 == part)
        more = [F.col("c_mktsegment").alias("segment")] if part == 2 else []
        chunks.append(chunk.select("c_custkey", F.lit(3857).alias("srid"), *more))
    return union_chunks(chunks)
