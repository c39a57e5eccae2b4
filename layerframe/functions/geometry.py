"""Geometry columns: Esri JSON and GeoJSON held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerframe.functions import spatial_reference as SR
from layerframe.functions import variants as V

# Keys that describe a geometry without being coordinates, and the
# texts that stand for a missing ordinate.
DESCRIPTIVE_KEYS = ["spatialReference", "spatial_reference", "hasZ", "has_z", "hasM", "has_m"]
NAN_TEXTS = ["NaN", "nan", "NAN"]

# Service names of the geometry types.
POINT = "esriGeometryPoint"
MULTIPOINT = "esriGeometryMultipoint"
POLYLINE = "esriGeometryPolyline"
POLYGON = "esriGeometryPolygon"
ENVELOPE = "esriGeometryEnvelope"


def is_null_geometry(geometry: Column) -> Column:
    """No object, no coordinate keys, or only null / NaN-text coordinates.

    A numeric x or a first ring, path or point settles the common case without looking
    at the other keys.
    """
    coords = F.map_filter(V.entries(geometry), lambda k, _: ~k.isin(DESCRIPTIVE_KEYS))
    all_missing = F.forall(
        F.map_values(coords),
        lambda v: F.is_variant_null(v)
        | F.coalesce(V.strict_text(v).isin(NAN_TEXTS), F.lit(False)),
    )
    x = V.get(geometry, "x", to="double")
    settled = x.isNotNull() & ~F.isnan(x)
    parts = F.coalesce(*[
        F.try_variant_get(geometry, f"$.{key}[0]", "variant") for key in ("rings", "paths", "points")
    ])
    return F.when(settled | parts.isNotNull(), F.lit(False)).otherwise(
        F.coalesce(all_missing, F.lit(True))
    )


def infer_geometry_type(geometry: Column) -> Column:
    """``point multipoint polyline polygon envelope`` by key, curves are null."""
    return (
        F.when(V.has(geometry, "x") & V.has(geometry, "y"), "point")
        .when(V.has(geometry, "points"), "multipoint")
        .when(V.has(geometry, "paths"), "polyline")
        .when(V.has(geometry, "rings"), "polygon")
        .when(_is_envelope(geometry), "envelope")
    )


def _is_envelope(geometry: Column) -> Column:
    present = V.has(geometry, "xmin")
    for key in ("ymin", "xmax", "ymax"):
        present = present & V.has(geometry, key)
    return present


def esri_geometry_type(geometry: Column) -> Column:
    """Service type name; unlike :func:`infer_geometry_type` it knows curves."""
    return (
        F.when(V.has(geometry, "x") & V.has(geometry, "y"), POINT)
        .when(V.has(geometry, "points"), MULTIPOINT)
        .when(V.has(geometry, "paths") | V.has(geometry, "curvePaths"), POLYLINE)
        .when(V.has(geometry, "rings") | V.has(geometry, "curveRings"), POLYGON)
        .when(_is_envelope(geometry), ENVELOPE)
    )


def normalize_geometry(geometry: Column, fallback_sr: Column | None = None) -> Column:
    """``STRUCT<type, coords, srid, raw_sr, has_z, has_m>``, null for null geometry.

    The geometry's own reference wins over ``fallback_sr`` (a VARIANT column).
    """
    reference = F.coalesce(
        V.non_null(V.get(geometry, "spatialReference")),
        V.non_null(V.get(geometry, "spatial_reference")),
    )
    if fallback_sr is not None:
        reference = F.coalesce(reference, fallback_sr)
    without = F.to_variant_object(
        F.map_filter(
            V.entries(geometry),
            lambda k, _: ~k.isin("spatialReference", "spatial_reference"),
        )
    )
    has_reference = V.has(geometry, "spatialReference") | V.has(geometry, "spatial_reference")
    coords = F.when(has_reference, without).otherwise(geometry)
    return F.when(
        ~is_null_geometry(geometry),
        F.struct(
            infer_geometry_type(geometry).alias("type"),
            coords.alias("coords"),
            V.let(reference, SR.epsg).alias("srid"),
            SR.raw(reference).alias("raw_sr"),
            (V.truthy(V.get(geometry, "hasZ")) | V.truthy(V.get(geometry, "has_z"))).alias("has_z"),
            (V.truthy(V.get(geometry, "hasM")) | V.truthy(V.get(geometry, "has_m"))).alias("has_m"),
        ),
    )


def _looks_esri(geometry: Column) -> Column:
    test = _is_envelope(geometry)
    for key in ("x", "points", "paths", "curvePaths", "rings", "curveRings"):
        test = test | V.has(geometry, key)
    return test


def _with_flags(key: str, shape: Column, positions: Column) -> Column:
    """Array geometry plus hasZ / hasM when some position is long enough."""
    true = V.json_literal("true")
    longest = F.array_max(F.transform(positions, lambda p: F.size(p)))
    return V.make_object(
        **{
            key: shape,
            "hasZ": F.when(longest >= 3, true),
            "hasM": F.when(longest >= 4, true),
        }
    )


def geojson_to_esri(value: Column) -> Column:
    """``STRUCT<geometry VARIANT, geometry_type STRING, error STRING>``.

    Takes GeoJSON geometries and Features; Esri JSON passes through unchanged.
    Multi-polygon rings are flattened into one list of rings.
    """

    def unwrapped(v: Column) -> Column:
        feature = ~_looks_esri(v) & (V.get(v, "type", to="string") == "Feature")
        return F.when(feature, V.get(v, "geometry")).otherwise(v)

    def outcome(v: Column) -> Column:
        missing = F.when(~V.is_object(v) | v.isNull(), "geometry must be an object")
        return V.let(unwrapped(v), lambda g: _converted(g, missing))

    return V.let(value, outcome)


def _converted(geometry: Column, missing: Column) -> Column:
    """Result struct for an unwrapped geometry; ``missing`` is an earlier error, if any."""
    esri = _looks_esri(geometry)
    name = V.get(geometry, "type", to="string")
    coordinates = V.get(geometry, "coordinates")
    ordinates = V.elements(geometry, "coordinates")
    is_list, size = ordinates.isNotNull(), F.size(ordinates)

    def nested(depth: int) -> Column:
        """Coordinates as lists of positions, ``depth`` lists deep."""
        return V.get(geometry, "coordinates", to="array<" * (depth + 1) + "variant" + ">" * (depth + 1))

    point = V.make_object(**{k: F.get(ordinates, F.lit(i)) for i, k in enumerate("xyzm")})
    one_path = F.to_variant_object(F.array(coordinates))
    all_rings = F.to_variant_object(F.flatten(nested(3)))
    converted = (
        F.when(esri, geometry)
        .when((name == "Point") & (size >= 2), point)
        .when((name == "MultiPoint") & is_list, _with_flags("points", coordinates, nested(1)))
        .when((name == "LineString") & is_list, _with_flags("paths", one_path, nested(1)))
        .when((name == "MultiLineString") & is_list, _with_flags("paths", coordinates, F.flatten(nested(2))))
        .when((name == "Polygon") & is_list, _with_flags("rings", coordinates, F.flatten(nested(2))))
        .when((name == "MultiPolygon") & is_list, _with_flags("rings", all_rings, F.flatten(F.flatten(nested(3)))))
    )
    kind = (
        F.when(esri, esri_geometry_type(geometry))
        .when((name == "Point") & (size >= 2), POINT)
        .when((name == "MultiPoint") & is_list, MULTIPOINT)
        .when(name.isin("LineString", "MultiLineString") & is_list, POLYLINE)
        .when(name.isin("Polygon", "MultiPolygon") & is_list, POLYGON)
    )

    def result(found: Column) -> Column:
        error = F.coalesce(
            missing,
            F.when(~V.is_object(geometry) | geometry.isNull(), "Feature without a geometry")
            .when(name == "FeatureCollection", "FeatureCollection is not supported")
            .when((name == "Point") & (size < 2), "Point needs x and y")
            .when(found.isNull(), F.concat(F.lit("unsupported geometry type: "), F.coalesce(name, F.lit("none")))),
        )
        return F.struct(
            F.when(found.isNotNull(), converted).alias("geometry"),
            found.alias("geometry_type"),
            error.alias("error"),
        )

    return V.let(kind, result)
