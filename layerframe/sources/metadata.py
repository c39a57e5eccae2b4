"""Metadata documents: one typed row per layer, field lists, declared limits.

A *documents* DataFrame has ``url``, ``status`` (HTTP status, may be null) and
``payload``.  All derivations are expressions over the parsed body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerframe.functions import spatial_reference as SR
from layerframe.functions import variants as V
from layerframe.schema import TYPE_PREFIX
from layerframe.sources.pages import envelope_error

# The key patterns of the record cap and the layer name, matched from
# the start of the key without regard to case.
RECORD_CAP_KEY = r"(?i)^max(imum)?(\s|_)?record(\s|_)?count$"
NAME_KEY = r"(?i)^name"
OID_KEYS = ("objectidfield", "objectidfieldname")

OK, MISSING = "ok", "missing"


def parse_documents(documents: DataFrame) -> DataFrame:
    """Adds ``body`` and ``doc_error`` (null for a usable document)."""
    body = F.col("body")
    error = envelope_error(body)
    status = F.col("status")
    return V.parsed(documents, "payload").withColumn(
        "doc_error",
        F.when(status.isNotNull() & (status >= 400), F.concat(F.lit("HttpError: status "), status.cast("string")))
        .when(F.col("payload").isNull(), F.lit("TransportError: no response"))
        .when(body.isNull(), F.lit("ResponseError: not JSON"))
        .when(
            error.isNotNull(),
            F.concat(
                F.lit("ResponseError: "),
                error["message"],
                F.coalesce(F.concat(F.lit(" (code="), error["code"].cast("string"), F.lit(")")), F.lit("")),
            ),
        ),
    )


def field_specs(body: Column) -> Column:
    """``ARRAY<STRUCT<name, type, alias, length, nullable, editable, domain>>``.

    Malformed entries (not an object, or a member of the wrong type) are left out
    one by one; the rest of the list stays.
    """

    def usable(spec: Column) -> Column:
        def optional(key: str, test) -> Column:
            value = V.get(spec, key)
            return (V.kind(value) == "null") | F.coalesce(test(value), F.lit(False))

        return (
            V.is_object(spec)
            & optional("name", lambda v: V.kind(v) == "string")
            & optional("type", lambda v: V.kind(v) == "string")
            & optional("alias", lambda v: V.kind(v) == "string")
            & optional("length", lambda v: V.lax_int(v).isNotNull())
            & optional("domain", V.is_object)
            & optional("nullable", lambda v: V.lax_bool(v).isNotNull())
            & optional("editable", lambda v: V.lax_bool(v).isNotNull())
        )

    def shaped(spec: Column) -> Column:
        return F.struct(
            V.text(V.get(spec, "name")).alias("name"),
            V.text(V.get(spec, "type")).alias("type"),
            V.text(V.get(spec, "alias")).alias("alias"),
            V.lax_int(V.get(spec, "length")).alias("length"),
            V.lax_bool(V.get(spec, "nullable")).alias("nullable"),
            V.lax_bool(V.get(spec, "editable")).alias("editable"),
            V.non_null(V.get(spec, "domain")).alias("domain"),
        )

    return F.transform(F.filter(V.elements(body, "fields"), usable), shaped)


def object_id_field(fields: Column, body: Column) -> Column:
    """``STRUCT<name, error>``: the layer's object id field.

    The single OID-typed field; else ``objectIdField`` / ``objectIdFieldName`` and then
    ``uniqueIdInfo.name``, both re-cased to the declared spelling.
    """
    oids = F.transform(
        F.filter(fields, lambda f: f["type"] == F.lit(TYPE_PREFIX + "OID")), lambda f: f["name"]
    )
    n_oids = F.coalesce(F.size(oids), F.lit(0))

    def recased(name: Column) -> Column:
        same = F.filter(fields, lambda f: F.lower(f["name"]) == F.lower(name))
        # Of several spellings the last declared one counts.
        return F.coalesce(F.try_element_at(same, F.lit(-1))["name"], name)

    named = F.filter(
        F.map_entries(V.entries(body)),
        lambda e: F.lower(e["key"]).isin(*OID_KEYS)
        & (V.kind(e["value"]) == "string"),
    )
    by_key = V.text(F.get(named, F.lit(0))["value"])
    by_unique = V.strict_text(V.get(body, "uniqueIdInfo", "name"))
    name = (
        F.when(n_oids == 1, F.get(oids, F.lit(0)))
        .when(n_oids > 1, F.lit(None))
        .when(by_key.isNotNull(), recased(by_key))
        .when(by_unique.isNotNull(), recased(by_unique))
    )
    error = F.when(n_oids > 1, "ambiguous object id fields").when(
        name.isNull(), "no object id field"
    )
    return F.struct(name.alias("name"), error.alias("error"))


def _only_key(body: Column, pattern: str) -> Column:
    """The value of the one key matching ``pattern``; null for none or several."""
    hits = F.filter(
        F.map_entries(V.entries(body)),
        lambda e: e["key"].rlike(pattern) & ~F.is_variant_null(e["value"]),
    )
    return F.when(F.size(hits) == 1, F.get(hits, F.lit(0))["value"])


def max_record_count(body: Column) -> Column:
    return V.lax_int(_only_key(body, RECORD_CAP_KEY))


def layer_name(body: Column) -> Column:
    return V.text(_only_key(body, NAME_KEY))


def supports_pagination(body: Column) -> Column:
    """Nested capability flag, then the top-level one, then true."""
    nested = V.get(body, "advancedQueryCapabilities", "supportsPagination")
    top = V.lax_bool(V.first_of(body, "supportsPagination", "supports_pagination"))
    return F.when(nested.isNotNull(), V.truthy(nested)).otherwise(F.coalesce(top, F.lit(True)))


def supports_pagination_explicitly(body: Column) -> Column:
    """Only a literal true counts."""
    nested = V.get(body, "advancedQueryCapabilities", "supportsPagination")
    top = V.lax_bool(V.first_of(body, "supportsPagination", "supports_pagination"))
    return F.when(nested.isNotNull(), F.to_json(nested) == "true").otherwise(F.coalesce(top, F.lit(False)))


def advertised_factor(body: Column) -> Column:
    """``maxRecordCountFactor`` of the capability block: positive and finite, else null."""
    value = F.coalesce(
        V.get(body, "advancedQueryCapabilities", "maxRecordCountFactor"),
        V.get(body, "advanced_query_capabilities", "maxRecordCountFactor"),
    )
    number = F.when(V.kind(value) != "boolean", F.trim(V.text(value)).try_cast("double"))
    return F.when((number > 0) & (number < float("inf")) & ~F.isnan(number), number)


def scan_metadata(documents: DataFrame) -> DataFrame:
    """The *layers* table: one row per document, ``body`` kept for everything else."""
    body = F.col("body")
    parsed = parse_documents(documents).withColumn("fields", field_specs(body))
    oid = object_id_field(F.col("fields"), body)
    return parsed.withColumn("_oid", oid).select(
        F.col("url").alias("layer_url"),
        "doc_error",
        V.lax_int(V.get(body, "id")).alias("id"),
        V.strict_text(V.get(body, "type")).alias("type"),
        layer_name(body).alias("name"),
        "fields",
        F.col("_oid.name").alias("object_id_field"),
        F.col("_oid.error").alias("object_id_error"),
        max_record_count(body).alias("max_record_count"),
        supports_pagination(body).alias("supports_pagination"),
        supports_pagination_explicitly(body).alias("pagination_explicit"),
        advertised_factor(body).alias("advertised_factor"),
        SR.layer_raw(body).alias("spatial_reference"),
        "body",
    )


def layer_fields(layers: DataFrame) -> DataFrame:
    """(layer, field, type, domain) rows; nameless fields dropped, missing type ``""``."""
    return (
        layers.select("layer_url", F.explode("fields").alias("f"))
        .where(F.col("f.name").isNotNull())
        .select(
            "layer_url",
            F.col("f.name").alias("name"),
            F.replace(F.coalesce("f.type", F.lit("")), F.lit(TYPE_PREFIX), F.lit("")).alias("type"),
            F.col("f.domain").alias("domain"),
        )
    )


def require_feature_layer(layers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feature layers, rejected rows with a reason)."""
    accepted = F.col("doc_error").isNull() & F.col("type").eqNullSafe(F.lit("Feature Layer"))
    reason = F.coalesce("doc_error", F.lit("the url must point to a Feature Layer"))
    return layers.where(accepted), layers.where(~accepted).withColumn("reason", reason)
