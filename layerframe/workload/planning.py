"""Queries over page plans, id chunks and truncation."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerframe.plans.paging import (
    apply_truncation_policy,
    cap_oid_chunks,
    clamp_factor,
    oid_chunks,
    pagination_plan,
    plan_requests,
    split_truncated,
    truncation_report,
)
from layerframe.sources.metadata import scan_metadata
from layerframe.sources.pages import scan_feature_batches, scan_pages
from layerframe.workload.fixtures import order_features, pack_pages, page_of, supplier_url, table
from layerframe.workload.fixtures import ORDER_FIELDS, ORDERS_URL
from layerframe.workload.registry import query


def supplier_layers(spark, sf_dir):
    """Each supplier's line items as one layer: totals, caps and capability flags."""
    kind = F.col("l_suppkey") % 4
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.count(F.lit(1)).alias("total"))
        .select(
            "l_suppkey",
            supplier_url("l_suppkey").alias("layer_url"),
            "total",
            (50 + F.col("l_suppkey") % 3 * 25).alias("max_record_count"),
            F.when(kind == 1, 0.5).when(kind == 2, 3.0).cast("double").alias("advertised_factor"),
        )
    )


@query(
    "pagination_plan",
    """
WITH l AS (SELECT l_suppkey, count(*) AS total, 50 + l_suppkey % 3 * 25 AS cap, l_suppkey % 4 AS k FROM lineitem GROUP BY ALL),
s AS (SELECT *, greatest(1, CAST(floor(cap * CASE k WHEN 1 THEN 0.5 WHEN 2 THEN 2.0 ELSE 2.0 END) AS BIGINT)) AS size FROM l)
SELECT l_suppkey, i AS page_index, i * size AS "offset", least(size, total - i * size) AS "count", size AS page_size, k = 1 AS clamped
FROM (SELECT *, unnest(range(CAST(ceil(total / size) AS BIGINT))) AS i FROM s)
""",
)
def pagination_plan_query(spark, sf_dir):
    plan = pagination_plan(supplier_layers(spark, sf_dir), factor=2.0)
    key = F.regexp_extract("layer_url", r"/S(\d+)/", 1).cast("bigint").alias("l_suppkey")
    return plan.select(key, "page_index", "offset", "count", "page_size", "clamped")


@query(
    "clamp_factor",
    """
SELECT p_partkey, CASE WHEN p_size % 5 > 0 AND p_retailprice / 500 > p_size % 5 THEN CAST(p_size % 5 AS DOUBLE)
                       ELSE p_retailprice / 500 END AS factor,
       p_size % 5 > 0 AND p_retailprice / 500 > p_size % 5 AS clamped
FROM part
""",
)
def clamp_factor_query(spark, sf_dir):
    advertised = F.when(F.col("p_size") % 5 > 0, (F.col("p_size") % 5).cast("double"))
    clamped = clamp_factor(F.col("p_retailprice") / 500, advertised)
    return table(spark, sf_dir, "part").select(
        "p_partkey", clamped["factor"].alias("factor"), clamped["clamped"].alias("clamped")
    )


# Fixed values of the fixture: factor texts by part size modulo 9 and what they mean.
FACTORS = ["2", "0.5", '"1.5"', "true", "null", "0", "-1", '"NaN"', '"abc"']
FACTOR_MEANS = ["2.0", "0.5", "1.5", "NULL", "NULL", "NULL", "NULL", "NULL", "NULL"]


@query(
    "advertised_factor",
    "SELECT p_partkey, CASE p_partkey % 9 "
    + " ".join(f"WHEN {i} THEN CAST({m} AS DOUBLE)" for i, m in enumerate(FACTOR_MEANS))
    + " END AS advertised_factor FROM part",
)
def advertised_factor_query(spark, sf_dir):
    texts = F.element_at(F.array(*[F.lit(t) for t in FACTORS]), (F.col("p_partkey") % 9 + 1).cast("int"))
    documents = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("url"),
        F.lit(200).alias("status"),
        F.concat(
            F.lit('{"maxRecordCountFactor": 7, "advancedQueryCapabilities": {"maxRecordCountFactor": '), texts, F.lit("}}")
        ).alias("payload"),
    )
    return scan_metadata(documents).select(F.col("layer_url").cast("bigint").alias("p_partkey"), "advertised_factor")


PLAN_REQUESTS_SQL = """
WITH ids AS (SELECT DISTINCT l_suppkey, l_orderkey * 8 + l_linenumber AS oid FROM lineitem),
l AS (SELECT l_suppkey, count(*) AS total, l_suppkey % 4 AS k,
             CASE l_suppkey % 4 WHEN 0 THEN 100000 WHEN 1 THEN 100 WHEN 2 THEN 100 ELSE 250 END AS cap,
             CASE WHEN l_suppkey % 8 < 4 THEN '1=1' ELSE 'l_tax > 0' END AS w
      FROM ids GROUP BY l_suppkey),
paged AS (SELECT *, 50 AS size FROM l WHERE k = 1 AND total > cap),
chunked AS (SELECT l.l_suppkey, (row_number() OVER (PARTITION BY l.l_suppkey ORDER BY oid) - 1) // cap AS i, oid, w
            FROM l JOIN ids ON l.l_suppkey = ids.l_suppkey WHERE k IN (2, 3) AND total > cap)
SELECT l_suppkey, 0 AS page_index, 'single' AS strategy, NULL AS "offset", NULL AS "count", w AS "where", NULL AS order_by
FROM l WHERE total <= cap
UNION ALL
SELECT l_suppkey, i, 'offset', i * size, least(size, total - i * size), w, 'OID'
FROM (SELECT *, unnest(range(CAST(ceil(total / size) AS BIGINT))) AS i FROM paged)
UNION ALL
SELECT l_suppkey, i, 'oid', NULL, NULL,
       CASE WHEN w = '1=1' THEN 'OID In (' || string_agg(oid, ', ' ORDER BY oid) || ')'
            ELSE '(' || w || ') AND (OID In (' || string_agg(oid, ', ' ORDER BY oid) || '))' END, NULL
FROM chunked GROUP BY l_suppkey, i, w
"""


@query("plan_requests", PLAN_REQUESTS_SQL)
def plan_requests_query(spark, sf_dir):
    """Suppliers as layers: one response, offset pages, or runs of object ids."""
    ids = (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("oid"))
        .distinct()
        .withColumn("layer_url", supplier_url("l_suppkey"))
    )
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
            F.when(F.col("l_suppkey") % 8 < 4, "1=1").otherwise("l_tax > 0").alias("where"),
        )
    )
    plan = plan_requests(layers, ids.select("layer_url", "oid"))
    key = F.regexp_extract("layer_url", r"/S(\d+)/", 1).cast("bigint").alias("l_suppkey")
    return plan.select(key, "page_index", "strategy", "offset", "count", "where", "order_by")


@query(
    "oid_chunks",
    """
SELECT i AS chunk_index, min(oid) AS lo, max(oid) AS hi, count(*) AS n_ids
FROM (SELECT oid, (row_number() OVER (ORDER BY oid) - 1) // 2000 AS i FROM (SELECT DISTINCT l_orderkey AS oid FROM lineitem))
GROUP BY 1
""",
)
def oid_chunks_query(spark, sf_dir):
    chunks = oid_chunks(table(spark, sf_dir, "lineitem"), "l_orderkey", 2000)
    return chunks.select("chunk_index", "lo", "hi", "n_ids")


@query(
    "cap_oid_chunks",
    """
WITH RECURSIVE ids AS (SELECT oid, row_number() OVER (ORDER BY oid) - 1 AS r
                       FROM (SELECT DISTINCT l_orderkey AS oid FROM lineitem)),
cut(lo, hi) AS (
  SELECT CAST(0 AS BIGINT), count(*) FROM ids
  UNION ALL
  SELECT CASE WHEN s = 0 THEN lo ELSE lo + (hi - lo) // 2 END, CASE WHEN s = 0 THEN lo + (hi - lo) // 2 ELSE hi END
  FROM cut JOIN (VALUES (0), (1)) h(s) ON hi - lo > 1000)
SELECT cut.lo AS start, cut.hi AS stop, min(oid) AS lo, max(oid) AS hi, count(*) AS n_ids
FROM cut JOIN ids ON r >= cut.lo AND r < cut.hi WHERE cut.hi - cut.lo <= 1000 GROUP BY 1, 2
""",
)
def cap_oid_chunks_query(spark, sf_dir):
    chunks = cap_oid_chunks(table(spark, sf_dir, "lineitem"), "l_orderkey", 1000)
    return chunks.select("start", "stop", "lo", "hi", "n_ids")


def _flagged_pages(spark, sf_dir):
    """Order pages of 500; some say they were cut off, some of those are empty."""
    page = F.col("page_index")
    features = order_features(spark, sf_dir, 500)
    features = features.withColumn("feature", F.when(page % 10 != 7, F.col("feature")))
    return scan_pages(pack_pages(features, ORDER_FIELDS, exceeded=page % 5 == 2))


@query(
    "truncation_policy",
    """
SELECT page_index, page_index % 5 = 2 AS exceeded, CASE WHEN page_index % 10 = 7 THEN 0 ELSE n END AS n_features
FROM (SELECT o_orderkey // 500 AS page_index, count(*) AS n FROM orders GROUP BY 1)
""",
)
def truncation_policy_query(spark, sf_dir):
    kept = apply_truncation_policy(_flagged_pages(spark, sf_dir), "ignore")
    return scan_feature_batches(kept).select(
        "page_index", "exceeded", F.col("n_features").cast("bigint").alias("n_features")
    )


@query(
    "truncation_report",
    """
SELECT page_index, CASE WHEN page_index % 10 = 7 THEN 0 ELSE n END AS n_features, page_index % 10 = 7 AS inconsistent
FROM (SELECT o_orderkey // 500 AS page_index, count(*) AS n FROM orders GROUP BY 1) WHERE page_index % 5 = 2
""",
)
def truncation_report_query(spark, sf_dir):
    report = truncation_report(_flagged_pages(spark, sf_dir))
    return report.select("page_index", F.col("n_features").cast("bigint").alias("n_features"), "inconsistent")


@query(
    "split_truncated",
    """
WITH RECURSIVE o AS (
  SELECT o_orderkey // 1000 AS page, o_orderkey AS oid, CASE WHEN o_orderstatus = 'P' THEN 4 ELSE 1 END AS w,
         row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) AS r FROM orders),
pre AS (SELECT page, r, sum(w) OVER (PARTITION BY page ORDER BY r) AS cw FROM o
        UNION ALL SELECT DISTINCT page, 0, 0 FROM o),
cut(page, depth, lo, hi) AS (
  SELECT page, 0, CAST(0 AS BIGINT), count(*) FROM o GROUP BY page
  UNION ALL
  SELECT cut.page, depth + 1, CASE WHEN s = 0 THEN lo ELSE lo + (hi - lo) // 2 END,
         CASE WHEN s = 0 THEN lo + (hi - lo) // 2 ELSE hi END
  FROM cut JOIN pre a ON a.page = cut.page AND a.r = lo JOIN pre b ON b.page = cut.page AND b.r = hi
  JOIN (VALUES (0), (1)) h(s) ON b.cw - a.cw > 500)
SELECT cut.page AS page_index, depth, min(oid) AS lo, max(oid) AS hi, count(*) AS n_features
FROM cut JOIN pre a ON a.page = cut.page AND a.r = lo JOIN pre b ON b.page = cut.page AND b.r = hi
JOIN o ON o.page = cut.page AND o.r > lo AND o.r <= hi
WHERE b.cw - a.cw <= 500 GROUP BY 1, 2, lo, cut.hi
""",
)
def split_truncated_query(spark, sf_dir):
    """Responses hold at most 500 units of weight; heavier requests come back cut off."""
    orders = table(spark, sf_dir, "orders")
    weight = F.when(F.col("o_orderstatus") == "P", 4).otherwise(1)
    requests = (
        orders.groupBy(page_of("o_orderkey", 1000).alias("page_index"))
        .agg(F.sort_array(F.collect_list("o_orderkey")).alias("oids"))
        .withColumn("layer_url", F.lit(ORDERS_URL))
    )

    def fetch(asked):
        wanted = asked.withColumn("o_orderkey", F.explode("oids"))
        found = wanted.join(orders.select("o_orderkey", weight.alias("w")), "o_orderkey")
        answered = found.groupBy("page_index", "path").agg(
            F.count(F.lit(1)).alias("n_features"), (F.sum("w") > 500).alias("exceeded")
        )
        return asked.join(answered, ["page_index", "path"])

    done = split_truncated(requests, fetch)
    return done.select(
        "page_index", "depth", F.array_min("oids").alias("lo"), F.array_max("oids").alias("hi"), "n_features"
    )
