"""Queries over a catalog of services and layers.

Regions and runs of 5,000 suppliers are roots, nations and runs of 50 are folders,
suppliers are services and their line numbers are layers, so no document's lists grow
with the data.  Chosen documents are missing, refused or error documents.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from layerframe.operators.catalog import (
    FEATURE_LAYER,
    RASTER_LAYER,
    broken_layer_count,
    crawl_catalog,
    filter_layers,
    layer_feature_count,
    scan_services,
)
from layerframe.functions import variants as V
from layerframe.workload.fixtures import table
from layerframe.workload.registry import query

SERVICES_SQL = """
svc AS (
  SELECT s_suppkey AS k, 'https://r' || r_regionkey || '-' || (s_suppkey // 5000) || '.example.com/rest/services' AS root_url,
         n_name || '_' || (s_suppkey // 50) AS folder, (r_regionkey + s_suppkey // 5000) % 5 = 4 AS root_bad,
         (n_nationkey + s_suppkey // 50) % 8 = 5 AS folder_bad, s_suppkey % 6 = 0 AS at_root,
         CASE WHEN s_suppkey % 2 = 0 THEN 'MapServer' ELSE 'FeatureServer' END AS service_type
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
named AS (SELECT *, CASE WHEN at_root THEN 'S' || k ELSE folder || '/S' || k END AS service_name FROM svc),
seen AS (SELECT *, root_url || '/' || service_name || '/' || service_type AS url,
                CASE WHEN k % 10 = 3 THEN 'TransportError: no response' WHEN k % 10 = 7 THEN 'HttpError: status 404' END AS service_error
         FROM named WHERE NOT root_bad AND (at_root OR NOT folder_bad))
"""
LAYERS_SQL = """
lay AS (
  SELECT seen.url AS service_url, seen.url || '/' || n AS url, n AS id, k,
         CASE WHEN (k + n) % 9 = 0 THEN 'ResponseError: Layer failed (code=500)'
              WHEN (k + n) % 9 = 4 THEN 'HttpError: status 503' END AS layer_error,
         CASE WHEN (k + n) % 9 IN (0, 4) THEN NULL WHEN n = 7 THEN 'Table' WHEN n = 6 THEN 'Raster Layer' ELSE 'Feature Layer' END AS type
  FROM seen JOIN (SELECT DISTINCT l_suppkey, l_linenumber AS n FROM lineitem) ON l_suppkey = k WHERE service_error IS NULL)
"""


def _services(spark, sf_dir, healthy: bool = False):
    k = F.col("s_suppkey")
    run = lambda n: F.floor(k / n).cast("string")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            k.alias("k"),
            F.concat(F.lit("https://r"), "r_regionkey", F.lit("-"), run(5000), F.lit(".example.com/rest/services")).alias("root_url"),
            F.concat("n_name", F.lit("_"), run(50)).alias("folder"),
            (((F.col("r_regionkey") + F.floor(k / 5000)) % 5 == 4) & F.lit(not healthy)).alias("root_bad"),
            (((F.col("n_nationkey") + F.floor(k / 50)) % 8 == 5) & F.lit(not healthy)).alias("folder_bad"),
            (k % 6 == 0).alias("at_root"),
            F.when(k % 2 == 0, "MapServer").otherwise("FeatureServer").alias("type"),
        )
        .withColumn(
            "name",
            F.when(F.col("at_root"), F.concat(F.lit("S"), "k")).otherwise(F.concat("folder", F.lit("/S"), "k")),
        )
        .withColumn("url", F.concat_ws("/", "root_url", "name", "type"))
    )


def _body(folders):
    return F.to_json(F.struct(folders, F.col("services")))


def root_documents(services):
    """(url, status, payload) of the roots, each listing its folders and some of its services.

    Bounded by the runs above: at most 5,000 services, so at most a few hundred folders.
    """
    listed = services.groupBy("root_url", "root_bad").agg(
        F.array_sort(F.collect_set("folder")).alias("folders"),
        F.collect_list(F.when(F.col("at_root"), F.struct("name", "type"))).alias("services"),
    )
    return listed.select(
        F.col("root_url").alias("url"), F.when(F.col("root_bad"), 500).otherwise(200).alias("status"), _body(F.col("folders")).alias("payload")
    )


def catalog_documents(spark, sf_dir, healthy: bool = False):
    """(url, status, payload) of every document that answers.

    ``healthy`` leaves out the root and folder failures.
    """
    services = _services(spark, sf_dir, healthy)
    root_docs = root_documents(services)
    entry = F.struct("name", "type")
    folder_docs = (
        services.groupBy("root_url", "folder", "folder_bad")
        .agg(F.collect_list(F.when(~F.col("at_root"), entry)).alias("services"))
        .select(
            F.concat_ws("/", "root_url", "folder").alias("url"),
            F.lit(200).alias("status"),
            F.when(F.col("folder_bad"), '{"error":{"code":499,"message":"Token Required"}}')
            .otherwise(_body(F.array().cast("array<string>").alias("folders"))).alias("payload"),
        )
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("n"))
        .distinct()
        .join(services.select("k", "url"), "k")
    )
    k, n = F.col("k"), F.col("n")
    service_docs = (
        lines.where(k % 10 != 3)
        .groupBy("url", "k")
        .agg(F.collect_list(F.struct(n.alias("id"), F.concat(F.lit("L"), n).alias("name"))).alias("layers"))
        .select(
            "url",
            F.when(k % 10 == 7, 404).otherwise(200).alias("status"),
            F.to_json(F.struct("layers")).alias("payload"),
        )
    )
    kind = F.when(n == 7, "Table").when(n == 6, "Raster Layer").otherwise("Feature Layer")
    layer_docs = lines.select(
        F.concat_ws("/", "url", n.cast("string")).alias("url"),
        F.when((k + n) % 9 == 4, 503).otherwise(200).alias("status"),
        F.when((k + n) % 9 == 0, '{"error":{"code":500,"message":"Layer failed"}}')
        .otherwise(F.to_json(F.struct(n.alias("id"), F.concat(F.lit("L"), n).alias("name"), kind.alias("type")))).alias("payload"),
    )
    return root_docs.unionByName(folder_docs).unionByName(service_docs).unionByName(layer_docs)


def catalog(spark, sf_dir, mode: str = "report", counts=None):
    healthy = mode == "failfast"
    roots = _services(spark, sf_dir, healthy).select("root_url").distinct()
    return crawl_catalog(roots, catalog_documents(spark, sf_dir, healthy), mode, counts)


@query(
    "scan_services",
    f"WITH {SERVICES_SQL} SELECT root_url, service_name, service_type, url FROM named_all".replace(
        "named_all",
        "(SELECT root_url, service_name, service_type, root_url || '/' || service_name || '/' || service_type AS url FROM named WHERE at_root)",
    ),
)
def scan_services_query(spark, sf_dir):
    """Services listed by the root documents themselves, whatever status they came with."""
    documents = root_documents(_services(spark, sf_dir)).select(F.col("url").alias("root_url"), F.lit(200).alias("status"), "payload")
    return scan_services(documents)


@query("crawl_catalog", f"WITH {SERVICES_SQL} SELECT root_url, service_name, service_type, url, service_error FROM seen")
def crawl_catalog_query(spark, sf_dir):
    return catalog(spark, sf_dir).services


@query(
    "service_layers",
    f"""WITH {SERVICES_SQL}, {LAYERS_SQL}
SELECT service_url, url, id, CASE WHEN layer_error IS NULL THEN 'L' || id END AS name, type, layer_error FROM lay""",
)
def service_layers_query(spark, sf_dir):
    return catalog(spark, sf_dir).layers.select("service_url", "url", "id", "name", "type", "layer_error")


@query(
    "layer_feature_count",
    f"""WITH {SERVICES_SQL}, {LAYERS_SQL},
c AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT url, type, CASE WHEN type = 'Feature Layer' AND (k + id) % 5 <> 0 THEN n END AS feature_count
FROM lay JOIN c ON l_suppkey = k AND l_linenumber = id""",
)
def layer_feature_count_query(spark, sf_dir):
    """Counts exist for most layers; a timed-out one has none."""
    counts = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("n"))
        .agg(F.count(F.lit(1)).alias("feature_count"))
        .where((F.col("k") + F.col("n")) % 5 != 0)
        .join(_services(spark, sf_dir).select("k", F.col("url").alias("service_url")), "k")
        .select(F.concat_ws("/", "service_url", F.col("n").cast("string")).alias("url"), "feature_count")
    )
    counted = layer_feature_count(catalog(spark, sf_dir).layers, counts)
    return counted.select("url", "type", "feature_count")


def _count_envelopes(spark, sf_dir):
    """(url, status, payload) of the layers' counts: some time out, some are refused, some are no number."""
    k, n = F.col("k"), F.col("n")
    counted = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("n"))
        .agg(F.count(F.lit(1)).alias("total"))
        .where((k + n) % 5 != 0)
        .join(_services(spark, sf_dir).select("k", F.col("url").alias("service_url")), "k")
    )
    said = F.concat(F.lit('{"count":'), F.when((k + n) % 5 == 2, '"many"').otherwise(F.col("total").cast("string")), F.lit("}"))
    return counted.select(
        F.concat_ws("/", "service_url", n.cast("string")).alias("url"), F.when((k + n) % 5 == 1, 504).otherwise(200).alias("status"), said.alias("payload")
    )


@query(
    "crawl_counts",
    f"""WITH {SERVICES_SQL}, {LAYERS_SQL},
c AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT url, type, CASE WHEN type = 'Feature Layer' AND (k + id) % 5 IN (3, 4) THEN n END AS feature_count
FROM lay JOIN c ON l_suppkey = k AND l_linenumber = id""",
)
def crawl_counts_query(spark, sf_dir):
    """Counts asked for within the crawl, for feature layers alone."""
    return catalog(spark, sf_dir, counts=_count_envelopes(spark, sf_dir)).layers.select("url", "type", "feature_count")


@query(
    "crawl_count_errors",
    f"""WITH {SERVICES_SQL}, {LAYERS_SQL}
SELECT url, CASE (k + id) % 5 WHEN 0 THEN 'TransportError: no response' WHEN 1 THEN 'HttpError: status 504'
                 ELSE 'ResponseError: count is missing or not an integer' END AS message
FROM lay WHERE type = 'Feature Layer' AND (k + id) % 5 IN (0, 1, 2)""",
)
def crawl_count_errors_query(spark, sf_dir):
    errors = catalog(spark, sf_dir, counts=_count_envelopes(spark, sf_dir)).errors
    return errors.where("stage = 'feature_count'").select("url", "message")


@query(
    "crawl_roots",
    f"""WITH {SERVICES_SQL}
SELECT root_url, CASE WHEN root_bad THEN 'HttpError: status 500' END AS root_error,
       CASE WHEN NOT root_bad THEN count(DISTINCT folder) END AS n_folders
FROM svc GROUP BY root_url, root_bad""",
)
def crawl_roots_query(spark, sf_dir):
    """The roots' own metadata."""
    roots = catalog(spark, sf_dir).roots
    folders = F.size(V.elements(F.col("body"), "folders")).cast("bigint")
    return roots.select("root_url", "root_error", F.when(F.col("body").isNotNull(), folders).alias("n_folders"))


@query(
    "crawl_errors",
    f"""WITH {SERVICES_SQL}
SELECT DISTINCT 'base_metadata' AS stage, root_url AS url, 'HttpError: status 500' AS message FROM svc WHERE root_bad
UNION ALL
SELECT DISTINCT 'folder_metadata', root_url || '/' || folder, 'ResponseError: Token Required (code=499)' FROM svc WHERE NOT root_bad AND folder_bad
UNION ALL
SELECT 'service_metadata', url, service_error FROM seen WHERE service_error IS NOT NULL""",
)
def crawl_errors_query(spark, sf_dir):
    return catalog(spark, sf_dir).errors.select("stage", "url", "message")


@query(
    "crawl_fail_fast",
    f"""WITH {SERVICES_SQL}
SELECT service_name, root_url || '/' || service_name || '/' || service_type AS url,
       CASE WHEN k % 10 = 3 THEN 'TransportError: no response' WHEN k % 10 = 7 THEN 'HttpError: status 404' END AS service_error
FROM named""",
)
def crawl_fail_fast_query(spark, sf_dir):
    """No root or folder fails, so nothing is raised; service failures stay inline."""
    return catalog(spark, sf_dir, "failfast").services.select("service_name", "url", "service_error")


@query(
    "broken_layer_count",
    f"""WITH {SERVICES_SQL}, {LAYERS_SQL}
SELECT seen.url AS service_url, count(lay.url) AS n_layers, count(layer_error) AS n_broken
FROM seen LEFT JOIN lay ON lay.service_url = seen.url GROUP BY 1""",
)
def broken_layer_count_query(spark, sf_dir):
    found = catalog(spark, sf_dir)
    return broken_layer_count(found.services, found.layers)


@query(
    "filter_layers",
    f"WITH {SERVICES_SQL}, {LAYERS_SQL} SELECT url, id, type FROM lay WHERE type IN ('Feature Layer', 'Raster Layer')",
)
def filter_layers_query(spark, sf_dir):
    return filter_layers(catalog(spark, sf_dir).layers, FEATURE_LAYER, RASTER_LAYER).select("url", "id", "type")
