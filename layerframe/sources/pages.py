"""Query pages: landed response documents, their features and their rows.

A *pages* DataFrame has ``layer_url``, ``page_index`` and ``payload`` (the
response text).  ``scan_pages`` parses it once into ``body``; every later step
reads paths out of that VARIANT, so unused parts are never materialised.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerframe.functions import geometry as G
from layerframe.functions import spatial_reference as SR
from layerframe.functions import variants as V
from layerframe.schema import Field, fields_of

# Landed paths carry the page index: .../page-<n>.json or .../page_index=<n>/...; of
# several such places the last, so that a file's own name goes before its folders'.
_PAGE_NUMBER = r"^.*page(?:-|_index=)(\d+)"


def read_pages(spark: SparkSession, path: str, layer_url: str | None = None) -> DataFrame:
    """Whole response files, one page each, whatever content type they came with."""
    raw = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    return pages_from_files(raw, layer_url)


def pages_from_files(raw: DataFrame, layer_url: str | None = None) -> DataFrame:
    name = F.col("_metadata.file_path")
    return raw.select(
        (F.lit(layer_url) if layer_url else F.regexp_replace(name, "/[^/]*$", "")).alias("layer_url"),
        F.regexp_extract(name, _PAGE_NUMBER, 1).try_cast("bigint").alias("page_index"),
        F.col("value").alias("payload"),
    )


def envelope_error(body: Column) -> Column:
    """``STRUCT<code BIGINT, message STRING>`` of an error document, else null.

    It counts as one only when ``error`` is an object whose own members have
    usable types.
    """

    def checked(error: Column) -> Column:
        code, message, details = (V.get(error, k) for k in ("code", "message", "details"))
        absent = lambda v: V.kind(v) == "null"
        texts = F.forall(V.elements(details), lambda d: V.kind(d) == "string")
        usable = (
            V.is_object(error)
            & (absent(code) | V.lax_int(code).isNotNull())
            & V.kind(message).isin("null", "string")
            & (absent(details) | F.coalesce(texts, F.lit(False)))
        )
        said = F.coalesce(F.nullif(V.text(message), F.lit("")), F.lit("error response"))
        return F.when(usable, F.struct(V.lax_int(code).alias("code"), said.alias("message")))

    return V.let(V.get(body, "error"), checked)


def scan_pages(pages: DataFrame) -> DataFrame:
    """Adds ``body``, ``status``, ``error`` and the truncation flags.

    ``status`` is ``ok``, ``not_json``, ``not_object`` or ``service_error``.  Nothing
    is dropped: see :func:`valid_pages` and :func:`quarantined_pages`.
    """
    body = F.col("body")
    exceeded = V.lax_bool(V.first_of(body, "exceededTransferLimit", "exceeded_transfer_limit"))
    parsed = V.parsed(pages, "payload").select(
        "*",
        envelope_error(body).alias("error"),
        F.coalesce(exceeded, F.lit(False)).alias("exceeded"),
    )
    return parsed.withColumn(
        "status",
        F.when(body.isNull(), "not_json")
        .when(~V.is_object(body), "not_object")
        .when(F.col("error").isNotNull(), "service_error")
        .otherwise("ok"),
    )


def valid_pages(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("status") == "ok")


def quarantined_pages(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("status") != "ok").select(
        "layer_url", "page_index", "status", "error.code", "error.message", "payload"
    )


def features_of(body: Column) -> Column:
    """The page's feature objects as ``ARRAY<VARIANT>``; other entries are skipped."""
    found = F.filter(V.elements(body, "features"), V.is_object)
    return F.coalesce(found, F.array().cast("array<variant>"))


def scan_features(scanned: DataFrame) -> DataFrame:
    """One row per feature object, with its position in the page and whether that was cut off."""
    # Page-level values are taken before the explode: beside it, they would be computed
    # per feature and drag the whole page along.
    body = F.col("body")
    pages = valid_pages(scanned).select(
        "layer_url",
        "page_index",
        "exceeded",
        V.text(V.first_of(body, "objectIdFieldName", "object_id_field_name")).alias("oid_field"),
        V.elements(body, "features").alias("_features"),
    )
    return (
        pages.select(
            "layer_url", "page_index", "exceeded", "oid_field", F.posexplode("_features").alias("pos", "feature")
        )
        .where(V.is_object(F.col("feature")))
        .select(
            "layer_url",
            "page_index",
            "pos",
            "oid_field",
            V.get(F.col("feature"), "attributes").alias("attributes"),
            V.get(F.col("feature"), "geometry").alias("geometry"),
            "feature",
            "exceeded",
        )
    )


def scan_feature_batches(scanned: DataFrame) -> DataFrame:
    """One row per page holding that page's features; page boundaries are kept."""
    features = features_of(F.col("body"))
    return valid_pages(scanned).select(
        "layer_url",
        "page_index",
        "exceeded",
        features.alias("features"),
        F.size(features).alias("n_features"),
    )


def attributes_of(feature: Column) -> Column:
    """A feature's attributes object, ``{}`` when missing or not an object."""
    attributes = V.get(feature, "attributes")
    return F.when(V.is_object(attributes), attributes).otherwise(V.json_literal("{}"))


def feature_to_row(feature: Column) -> Column:
    """Attributes, geometry and other members flattened into one VARIANT object.

    Geometry replaces an attribute of the same name; other top-level members are
    added only where no attribute has their name.
    """
    attributes = F.coalesce(V.entries(V.get(feature, "attributes")), _no_members())
    members = V.entries(feature)
    geometry = F.map_filter(members, lambda k, _: k == "geometry")
    has_geometry = F.size(geometry) > 0
    kept = F.map_filter(attributes, lambda k, _: ~(has_geometry & (k == "geometry")))
    others = F.map_filter(
        members,
        lambda k, _: ~k.isin("attributes", "geometry") & ~F.map_contains_key(attributes, k),
    )
    return F.to_variant_object(F.map_concat(kept, geometry, others))


def _no_members() -> Column:
    return F.from_json(F.lit("{}"), V.OBJECT)


def scan_rows(
    features: DataFrame,
    fields: Iterable[Field | dict],
    extras: Sequence[str] = (),
    keep: Sequence[str] = ("layer_url", "page_index", "pos"),
    geometry: bool = True,
) -> DataFrame:
    """Typed rows: one column per declared field, plus raw geometry and extras.

    ``extras`` names top-level feature members wanted as text columns; an attribute
    of the same name wins.
    """
    attributes, feature = F.col("attributes"), F.col("feature")
    columns = [F.col(k) for k in keep]
    for field in fields_of(fields):
        if field.name == "geometry" and geometry:
            continue
        columns.append(field.read(attributes).alias(field.name))
    # A present member with a null value is a VARIANT null, so it still wins here.
    for name in extras:
        columns.append(V.text(F.coalesce(V.get(attributes, name), V.get(feature, name))).alias(name))
    if geometry:
        columns.append(F.coalesce("geometry", V.get(attributes, "geometry")).alias("geometry"))
    return features.select(*columns)


def require_complete(scanned: DataFrame) -> DataFrame:
    """Fails the query when a page says its rows were cut off."""
    message = F.concat(
        F.col("layer_url"), F.lit(" page "), F.col("page_index").cast("string"),
        F.lit(": exceededTransferLimit=true, rows are missing"),
    )
    return scanned.where(
        F.when(F.col("exceeded"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )


def scan_geo_chunks(scanned: DataFrame, layers: DataFrame) -> DataFrame:
    """Page-wise rows with normalized geometry, stamped with the layer's reference.

    ``layers`` has ``layer_url`` and ``spatial_reference`` (VARIANT).  Truncation
    always raises.  The join carries no hint: the optimizer broadcasts the layers
    when they are small enough and splits a layer that dominates otherwise.
    """
    stamped = layers.select("layer_url", F.col("spatial_reference").alias("layer_sr"))
    features = scan_features(require_complete(scanned))
    return (
        features.join(stamped, "layer_url", "left")
        .withColumn("geometry", G.normalize_geometry(F.col("geometry"), F.col("layer_sr")))
        .withColumn("layer_srid", SR.epsg(F.col("layer_sr")))
    )
