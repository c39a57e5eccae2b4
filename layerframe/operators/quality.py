"""Envelope checks and schema drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerframe.functions import variants as V
from layerframe.plans.rank import with_rank
from layerframe.plans.scratch import cut_lineage
from layerframe.sources.pages import envelope_error, features_of

# --- envelopes ------------------------------------------------------------------------

SAMPLE_CHARS = 200


def error_envelopes(scanned: DataFrame) -> DataFrame:
    """Pages that are error documents, with code and message; never an empty page."""
    return scanned.where(F.col("status") == "service_error").select(
        "layer_url", "page_index", "error.code", "error.message"
    )


def strict_counts(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Count envelopes: (``feature_count`` rows, rejected rows with raw payload)."""
    checked = (
        V.parsed(responses, "payload", "_body")
        .withColumn("feature_count", V.lax_int(V.get(F.col("_body"), "count")))
        .drop("_body")
    )
    good = F.col("feature_count").isNotNull()
    rejected = checked.where(~good).drop("feature_count").withColumn(
        "reason", F.lit("count is missing or not an integer")
    )
    return checked.where(good).drop("payload"), rejected


def strict_ids(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Object-id envelopes: (``object_id_field, object_ids`` rows, rejected rows).

    A null or absent id list is an empty one; any id that is not an integer rejects
    the envelope.
    """
    body = F.col("_body")
    name_value = F.coalesce(
        V.get(body, "objectIdFieldName"), V.get(body, "objectIdField"), V.get(body, "object_id_field_name")
    )
    ids_value = F.coalesce(V.get(body, "objectIds"), V.get(body, "object_ids"))
    ids = F.transform(V.elements(ids_value), V.lax_int)
    empty = F.array().cast("array<bigint>")
    checked = V.parsed(responses, "payload", "_body").withColumn(
        "object_id_field", V.strict_text(name_value)
    ).withColumn(
        "object_ids",
        F.when(V.is_object(body) & (ids_value.isNull() | F.is_variant_null(ids_value)), empty).when(
            ~F.exists(ids, lambda i: i.isNull()), ids
        ),
    ).drop("_body")
    good = F.col("object_id_field").isNotNull() & F.col("object_ids").isNotNull()
    reason = F.when(F.col("object_id_field").isNull(), "object id field name is missing or not text").otherwise(
        "object ids are not a list of integers"
    )
    rejected = checked.where(~good).withColumn("reason", reason).drop("object_id_field", "object_ids")
    return checked.where(good).drop("payload"), rejected


# --- models ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Key:
    """A declared key: accepted spellings and what its value must be."""

    names: tuple[str, ...]
    holds: str  # text int number flag object | model:<model name> | list:<one of those, or a model name>


MODEL_DEPTH = 2  # layers within layers whose members are looked at

# The declared keys of each document kind.
MODELS: dict[str, tuple[Key, ...]] = {
    "FieldSpec": (
        Key(("name",), "text"),
        Key(("type",), "text"),
        Key(("alias",), "text"),
        Key(("length",), "int"),
        Key(("domain",), "object"),
        Key(("nullable",), "flag"),
        Key(("editable",), "flag"),
    ),
    "FeaturesResponse": (
        Key(("objectIdFieldName", "object_id_field_name"), "text"),
        Key(("fields",), "list:FieldSpec"),
        Key(("features",), "list:object!"),
        Key(("exceededTransferLimit", "exceeded_transfer_limit"), "flag"),
    ),
    "AdvancedQueryCapabilities": (
        Key(("supportsPagination", "supports_pagination"), "flag"),
        Key(("supportsQueryByOIDs", "supports_query_by_oids"), "flag"),
        Key(("supportsReturnExceededLimitFeatures", "supports_return_exceeded_limit_features"), "flag"),
        Key(("supportsPaginationOnAggregatedQueries", "supports_pagination_on_aggregated_queries"), "flag"),
        Key(("maxRecordCountFactor", "max_record_count_factor"), "number"),
    ),
    "LayerMetadata": (
        Key(("name",), "text"),
        Key(("id",), "int"),
        Key(("type",), "text"),
        Key(("fields",), "list:FieldSpec"),
        Key(("maxRecordCount", "max_record_count"), "int"),
        Key(("supportsPagination", "supports_pagination"), "flag"),
        Key(("advancedQueryCapabilities", "advanced_query_capabilities"), "object"),
        Key(("advancedQueryCapabilitiesTyped", "advanced_query_capabilities_typed"), "model:AdvancedQueryCapabilities"),
        Key(("layers",), "list:LayerMetadata"),
        Key(("services",), "list:object"),
        Key(("folders",), "list:text"),
        Key(("url",), "text"),
        Key(("feature_count",), "int"),
    ),
}


def _fits(value: Column, holds: str) -> Column:
    """Whether a present, non-null value has the declared shape (lists: outer only)."""
    if holds.startswith("list:"):
        return V.elements(value).isNotNull()
    if holds.startswith("model:"):
        return V.is_object(value)
    return {
        "text": lambda: V.kind(value) == "string",
        "int": lambda: V.lax_int(value).isNotNull(),
        "number": lambda: F.try_variant_get(value, "$", "double").isNotNull(),
        "flag": lambda: V.lax_bool(value).isNotNull(),
        "object": lambda: V.is_object(value),
    }[holds]()


def _bad(path: Column, value: Column) -> Column:
    return F.struct(
        path.cast("string").alias("path"),
        F.lit("bad_type").alias("kind"),
        _type_name(value).alias("observed_type"),
        _short(value).alias("sample"),
    )


# How drift records name the observed types.
TYPE_NAMES = "null:NoneType,boolean:bool,integer:int,number:float,string:str,object:dict,array:list"


def _type_name(value: Column) -> Column:
    return V.lookup(TYPE_NAMES, V.kind(value))


def _indexed(value: Column, path: Column) -> Column:
    """List entries with the path each is reported under."""

    def place(v: Column, i: Column) -> Column:
        return F.struct(F.concat(path, F.lit("."), i.cast("string")).alias("p"), v.alias("v"))

    return F.transform(V.elements(value), place)


def _nested(model: str, depth: int):
    def records(e: Column) -> Column:
        whole = F.array(_bad(e["p"], e["v"]))
        return F.when(~V.is_object(e["v"]), whole).otherwise(_bad_types(e["v"], model, e["p"], depth))

    return records


def _unfit(holds: str):
    return lambda e: ~F.coalesce(_fits(e["v"], holds), F.lit(False))


def _bad_types(body: Column, model: str, prefix: Column | None = None, depth: int = 0) -> Column:
    """``ARRAY<STRUCT<path, kind, observed_type, sample>>`` of ill-typed values.

    Walks the declared tree of models; a model that holds itself is followed ``MODEL_DEPTH``
    times, beyond that its entries need only be objects.
    """
    found = []
    for key in MODELS[model]:
        for name in key.names:
            value = V.get(body, name)
            path = F.lit(name) if prefix is None else F.concat(prefix, F.lit("." + name))
            required = key.holds.endswith("!")  # null is not accepted either
            holds = key.holds.rstrip("!")
            wrong = ~F.coalesce(_fits(value, holds), F.lit(False))
            if not required:
                wrong = wrong & ~F.is_variant_null(value)
            found.append(F.filter(F.array(F.when(value.isNotNull() & wrong, _bad(path, value))), lambda r: r.isNotNull()))
            shape, _, inner = holds.partition(":")
            if not inner:
                continue
            deeper = depth + (inner == model)
            if shape == "model":
                found.append(F.when(V.is_object(value), _bad_types(value, inner, path, deeper)))
                continue
            indexed = _indexed(value, path)
            if inner in MODELS and deeper <= MODEL_DEPTH:
                found.append(F.flatten(F.transform(indexed, _nested(inner, deeper))))
            else:
                inner = "object" if inner in MODELS else inner
                found.append(F.transform(F.filter(indexed, _unfit(inner)), lambda e: _bad(e["p"], e["v"])))
    records = F.coalesce(found[0], F.array().cast(_RECORDS))
    for part in found[1:]:
        records = F.concat(records, F.coalesce(part, F.array().cast(_RECORDS)))
    return records


_RECORDS = "array<struct<path:string,kind:string,observed_type:string,sample:string>>"


def _unknown_keys(body: Column, model: str) -> Column:
    known = sorted(
        {n for key in MODELS[model] for n in key.names}
    )
    extra = F.filter(F.map_entries(V.entries(body)), lambda e: ~e["key"].isin(known))
    return F.transform(
        extra,
        lambda e: F.struct(
            e["key"].alias("path"),
            F.lit("unknown_extra").alias("kind"),
            _type_name(e["value"]).alias("observed_type"),
            _short(e["value"]).alias("sample"),
        ),
    )


def _short(value: Column) -> Column:
    """A sample is the beginning of the value's JSON, so that no list of features travels with it."""
    return F.substring(F.to_json(value), 1, SAMPLE_CHARS)


def drift_records(documents: DataFrame, model: str) -> DataFrame:
    """Every drift observation of every document, keeping the input's columns.

    ``documents`` has ``payload``; the kinds are ``not_a_mapping``, ``bad_type`` and
    ``unknown_extra``.  Error envelopes are not drift.
    """
    body = F.col("_body")
    parsed = V.parsed(documents, "payload", "_body").where(
        body.isNotNull() & envelope_error(body).isNull()
    )
    not_mapping = F.array(
        F.struct(
            F.lit("<root>").alias("path"),
            F.lit("not_a_mapping").alias("kind"),
            _type_name(body).alias("observed_type"),
            _short(body).alias("sample"),
        )
    )
    records = F.when(~V.is_object(body), not_mapping).otherwise(
        F.concat(_bad_types(body, model), F.coalesce(_unknown_keys(body, model), F.array().cast(_RECORDS)))
    )
    return parsed.withColumn("_r", F.explode(records)).select(
        *documents.columns,
        F.lit(model).alias("model"),
        "_r.path",
        "_r.kind",
        "_r.observed_type",
        "_r.sample",
    )


def drift_report(documents: DataFrame, model: str) -> DataFrame:
    """One record per (model, path, kind, observed type), with the smallest sample.

    Documents repeat the same drift millions of times; the partial aggregate leaves
    one row per task and key before anything is shuffled.
    """
    return (
        drift_records(documents, model)
        .groupBy("model", "path", "kind", "observed_type")
        .agg(F.min("sample").alias("sample"), F.count(F.lit(1)).alias("n_seen"))
    )


def permissive_envelopes(scanned: DataFrame) -> DataFrame:
    """Usable parts of every page: bad members are null, bad list entries are left out.

    A payload that is not an object counts as an empty envelope; error envelopes are
    not pages and stay out.  ``extras`` is one object of all undeclared members as they
    came, null where there are none.
    """
    from layerframe.sources.metadata import field_specs

    body = F.col("body")
    declared = sorted(n for key in MODELS["FeaturesResponse"] for n in key.names)
    extras = F.map_filter(V.entries(body), lambda k, _: ~k.isin(declared))
    return scanned.where(F.col("status").isin("ok", "not_object")).select(
        "layer_url",
        "page_index",
        V.strict_text(V.first_of(body, "objectIdFieldName", "object_id_field_name")).alias("object_id_field"),
        field_specs(body).alias("fields"),
        features_of(body).alias("features"),
        "exceeded",
        F.when(F.size(extras) > 0, F.to_variant_object(extras)).alias("extras"),
    )


# --- field-set drift ----------------------------------------------------------------------


def page_keys(scanned: DataFrame) -> DataFrame:
    """Distinct attribute keys of each page: (context, page_index, key)."""
    keys = F.array_distinct(
        F.flatten(
            F.transform(
                features_of(F.col("body")),
                lambda f: F.coalesce(F.map_keys(V.entries(V.get(f, "attributes"))), F.array().cast("array<string>")),
            )
        )
    )
    return scanned.where(F.col("status") == "ok").select(
        F.col("layer_url").alias("context"), "page_index", F.explode(keys).alias("key")
    )


def field_set_drift(presence: DataFrame, learn_pages: int = 1) -> DataFrame:
    """Keys that appear after, or vanish from, the pages a layer started with.

    ``presence``: (context, page_index, key).  Output: context, kind, key and the page
    of the first occurrence, once per key and kind.  Pages without keys do not count.

    A key has vanished at the first counted page at or after ``learn_pages`` that comes
    after one having it and lacks it: the smallest "next page" that is not itself among
    the key's pages.  That is an anti join on (context, page, key), so a context or key
    present on nearly all pages spreads like any other.
    """
    if learn_pages < 1:
        raise ValueError("drift needs at least one page to learn from")
    # Written once: every step below starts from these short rows, not from the pages.
    presence = cut_lineage(presence.select("context", "page_index", "key").distinct(), "presence")
    pages = with_rank(
        presence.select("context", "page_index").distinct(), ["page_index"], ["context"], "_n", size="_pages"
    )
    # Few contexts and keys make these files tiny for their rows, so a join may not go by their size.
    dense = cut_lineage(presence.hint("merge").join(pages, ["context", "page_index"]), "dense")

    first = dense.groupBy("context", "key").agg(F.min(F.struct("_n", "page_index")).alias("_first"))
    appeared = first.where(F.col("_first._n") >= learn_pages).select(
        "context", F.lit("field_appeared").alias("kind"), "key", F.col("_first.page_index").alias("at_page")
    )

    nexts = dense.select(
        "context", "key", F.greatest(F.col("_n") + 1, F.lit(learn_pages)).alias("_at"), "_pages"
    ).where(F.col("_at") < F.col("_pages"))
    held = dense.select("context", "key", F.col("_n").alias("_at"))
    vanished = (
        nexts.hint("merge").join(held, ["context", "key", "_at"], "left_anti")
        .groupBy("context", "key")
        .agg(F.min("_at").alias("_at"))
    )
    where = dense.select("context", F.col("_n").alias("_at"), F.col("page_index").alias("at_page")).distinct()
    vanished = vanished.hint("merge").join(where, ["context", "_at"]).select(
        "context", F.lit("field_disappeared").alias("kind"), "key", "at_page"
    )
    return appeared.unionByName(vanished)
