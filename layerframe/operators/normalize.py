"""Normalized features: attributes, geometry and object id in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerframe.functions import dates
from layerframe.functions import geometry as G
from layerframe.functions import variants as V
from layerframe.sources.metadata import field_specs
from layerframe.sources.pages import attributes_of, valid_pages


def hoist_object_id(attributes: Column, oid_field: str | Column) -> Column:
    """Integer object id by field name; null when absent or not a number."""
    if isinstance(oid_field, str):
        return V.get(attributes, oid_field, to="bigint")
    return V.as_int(F.try_element_at(V.entries(attributes), oid_field))


def normalize_attributes(attributes: Column, date_fields: Column) -> Column:
    """Attributes with date values as ISO text; unconvertible values stay raw."""
    def shown(iso: Column, value: Column) -> Column:
        # A one-element array is the built-in way from STRING to VARIANT.
        as_variant = F.try_variant_get(F.to_variant_object(F.array(iso)), "$[0]", "variant")
        return F.when(iso.isNull(), value).otherwise(as_variant)

    def convert(name: Column, value: Column) -> Column:
        iso = V.let(V.as_int(value), dates.epoch_ms_to_iso)
        converted = V.let(iso, lambda text: shown(text, value))
        return F.when(F.array_contains(date_fields, name), converted).otherwise(value)

    return F.to_variant_object(F.transform_values(V.entries(attributes), convert))


def normalize_features(
    scanned: DataFrame,
    oid_field: str | None = None,
    sr: Column | None = None,
    normalize_dates: bool = False,
) -> DataFrame:
    """``attributes VARIANT, geometry STRUCT, object_id BIGINT, exceeded BOOLEAN`` per feature object.

    ``sr`` is a VARIANT fallback for geometries without a reference.  The declared
    field list of each page says which attributes are dates.
    """
    body = F.col("body")
    name = (
        F.lit(oid_field)
        if oid_field
        else V.text(V.first_of(body, "objectIdFieldName", "object_id_field_name"))
    )
    nothing = F.array().cast("array<string>")
    dated = F.coalesce(
        F.transform(
            F.filter(
                F.col("_specs"),
                lambda f: f["name"].isNotNull() & dates.is_date_type(f["type"]),
            ),
            lambda f: f["name"],
        ),
        nothing,
    )
    pages = valid_pages(scanned)
    if normalize_dates:
        pages = pages.withColumn("_specs", field_specs(body))
    # Page-level values are taken before the explode, so that no page travels with its
    # features.
    features = (
        pages.select(
            "layer_url",
            "page_index",
            "exceeded",
            name.alias("_oid"),
            (dated if normalize_dates else nothing).alias("_dates"),
            V.elements(body, "features").alias("_features"),
        )
        .select("layer_url", "page_index", "exceeded", "_oid", "_dates", F.posexplode("_features").alias("pos", "feature"))
        .where(V.is_object(F.col("feature")))
    )
    # Attributes and geometry become columns of their own first, so that the many paths
    # read out of them below start from there.
    features = features.select(
        "*",
        attributes_of(F.col("feature")).alias("_attributes"),
        V.get(F.col("feature"), "geometry").alias("_geometry"),
    )
    attributes = F.col("_attributes")
    shown = normalize_attributes(attributes, F.col("_dates")) if normalize_dates else attributes
    return features.select(
        "layer_url",
        "page_index",
        "pos",
        shown.alias("attributes"),
        G.normalize_geometry(F.col("_geometry"), sr).alias("geometry"),
        hoist_object_id(attributes, oid_field or F.col("_oid")).alias("object_id"),
        "exceeded",
    )
