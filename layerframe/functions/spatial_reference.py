"""Spatial references: an EPSG number plus the raw object it came from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from layerframe.functions import variants as V


def _plain_int(value: Column) -> Column:
    """The value when JSON wrote it as a whole number, without coercion."""
    return F.when(V.kind(value) == "integer", F.try_variant_get(value, "$", "int"))


def epsg(value: Column) -> Column:
    """EPSG number of an int, a numeric string or an object.

    In an object ``latestWkid`` wins unless it is empty or zero, then ``wkid``.
    """
    latest, wkid = V.get(value, "latestWkid"), V.get(value, "wkid")
    return F.coalesce(
        F.when(V.kind(value) != "number", F.try_variant_get(value, "$", "int")),
        F.when(V.truthy(latest), _plain_int(latest)).otherwise(_plain_int(wkid)),
    )


def raw(value: Column) -> Column:
    """The object form, null for numbers and strings."""
    return F.when(V.is_object(value), value)


def layer_raw(body: Column) -> Column:
    """A layer's own reference: the extent's first, then the top-level one."""
    return F.coalesce(
        raw(V.get(body, "extent", "spatialReference")),
        raw(V.get(body, "spatialReference")),
    )
