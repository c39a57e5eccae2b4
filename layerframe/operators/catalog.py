"""Catalog of services and layers, assembled from metadata documents.

One job handles any number of roots.  ``documents`` (url, status, payload) is either
a landed table or, for a live crawl, what :func:`layerframe.sources.connector.fetch_documents`
returns for the urls of a stage.

Landed documents are read once: every one is parsed and classified into narrow columns
(what it lists, what it says of itself) beside its body, and written by column.  The
stages of the crawl then follow listed urls over the narrow columns alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerframe.errors import ServiceError
from layerframe.functions import variants as V
from layerframe.plans.scratch import cut_lineage
from layerframe.sources.metadata import parse_documents

FEATURE_LAYER = "Feature Layer"
RASTER_LAYER = "Raster Layer"

# Either a landed table or a function from a table of urls to their documents.
Documents = DataFrame | Callable[[DataFrame], DataFrame]


def _best(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Of rows (url, order, _row) that share a url: url and the ``_row`` of the greatest."""
    return rows.groupBy("url").agg(F.max(F.struct(*order, "_row"))["_row"].alias("_row"))


def one_per_url(documents: DataFrame) -> DataFrame:
    """One document of each url, however often it was landed.

    A document answered with status 200 goes before any other; of several such ones that
    of the greatest digest stays, so that the choice does not depend on the order of rows.
    Only urls landed more than once take part in the choice, by digest and not by payload.
    """
    numbered = documents.select("url", "status", "payload", *(c for c in ("body", "doc_error") if c in documents.columns))
    digest = F.md5(F.coalesce("payload", F.lit("")))
    marked = cut_lineage(numbered.withColumn("_digest", digest).withColumn("_row", F.monotonically_increasing_id()), "documents")
    return _without_repeats(marked).drop("_digest", "_row")


def _without_repeats(marked: DataFrame) -> DataFrame:
    """Written documents with ``_digest`` and ``_row``, one of each url."""
    order = ("_usable", "_digest", "status")
    narrow = marked.select("url", (F.coalesce("status", F.lit(0)) == 200).alias("_usable"), "_digest", "status", "_row")
    repeated = narrow.groupBy("url").count().where("count > 1").select("url")
    several = narrow.join(repeated, "url")
    best = _best(several, order).withColumnRenamed("_row", "_kept")
    # few as a rule, so the documents themselves need not move
    losers = cut_lineage(several.join(best, "url").where("_row <> _kept").select("_row"), "repeats")
    return marked.join(losers, "_row", "left_anti")


def classified(documents: DataFrame) -> DataFrame:
    """Documents with ``body``, ``doc_error`` and what their bodies list and say, in one pass.

    ``folders`` (texts), ``services`` (name, type), ``layer_ids`` (texts), and ``id``,
    ``name`` and ``type`` of the document itself; null where the document is unusable.
    """
    body = F.col("body")
    usable = F.col("doc_error").isNull()
    services = F.transform(
        F.filter(V.elements(body, "services"), V.is_object),
        lambda s: F.struct(V.get(s, "name", to="string").alias("name"), V.get(s, "type", to="string").alias("type")),
    )
    layer_ids = F.transform(F.filter(V.elements(body, "layers"), V.is_object), lambda layer: V.get(layer, "id", to="string"))
    said = {
        "folders": F.transform(V.elements(body, "folders"), V.text),
        "services": services,
        "layer_ids": layer_ids,
        "id": V.lax_int(V.get(body, "id")),
        "name": V.strict_text(V.get(body, "name")),
        "type": V.strict_text(V.get(body, "type")),
        "body": body,
    }
    parsed = parse_documents(documents)
    kept = [c for c in parsed.columns if c not in (*said, "payload")]
    return parsed.select(*kept, *(F.when(usable, value).alias(name) for name, value in said.items()))


class _Lookup:
    """Classified documents of urls, from a landed table or asked for stage by stage."""

    def __init__(self, documents: Documents):
        self._ask = None if isinstance(documents, DataFrame) else documents
        if self._ask is None:
            digest = F.md5(F.coalesce("payload", F.lit("")))
            marked = documents.select("url", "status", "payload", digest.alias("_digest"))
            written = cut_lineage(classified(marked).withColumn("_row", F.monotonically_increasing_id()), "documents")
            self._known = _without_repeats(written)

    def __call__(self, urls: DataFrame, stage: str) -> DataFrame:
        """``urls`` (with a column url) and their documents; one without is a transport error."""
        known = self._known if self._ask is None else self._asked(urls, stage)
        found = urls.join(known.drop("status", "_digest", "_row").withColumn("_there", F.lit(True)), "url", "left")
        missing = F.when(F.col("_there").isNull(), "TransportError: no response")
        return found.withColumn("doc_error", F.coalesce("doc_error", missing)).drop("_there")

    def _asked(self, urls: DataFrame, stage: str) -> DataFrame:
        answers = self._ask(urls.select("url").distinct()).select("url", "status", "payload")
        digest = F.md5(F.coalesce("payload", F.lit("")))
        written = cut_lineage(classified(answers.withColumn("_digest", digest)).withColumn("_row", F.monotonically_increasing_id()), stage)
        return _without_repeats(written)


@dataclass(frozen=True)
class Catalog:
    """The tables of a crawl.

    Landed documents are classified and written when the crawl is called, those of a live
    crawl stage by stage; the tables themselves are lazy.
    """

    roots: DataFrame  # root_url, root_error, body
    services: DataFrame  # root_url, service_name, service_type, url, service_error
    layers: DataFrame  # root_url, service_url, url, id, name, type, layer_error, body; feature_count where asked for
    errors: DataFrame  # root_url, stage, url, message


def listed_services(documents: DataFrame) -> DataFrame:
    """Services listed in classified root or folder documents, one row each.

    ``documents``: ``root_url``, ``services``.  The service url is ``root/name/type``.  A
    service listed more than once, as by root and folder, is one.
    """
    return (
        documents.select("root_url", F.inline("services"))
        .select(
            "root_url",
            F.col("name").alias("service_name"),
            F.col("type").alias("service_type"),
            F.concat_ws("/", "root_url", "name", "type").alias("url"),
        )
        .distinct()
    )


def scan_services(documents: DataFrame) -> DataFrame:
    """Services listed by root or folder documents (``root_url``, ``status``, ``payload``), see :func:`listed_services`."""
    return listed_services(classified(documents))


def service_layers(services: DataFrame, documents: Documents | _Lookup) -> DataFrame:
    """Layers of each service with their own metadata.

    ``services``: ``root_url``, ``url``, ``layer_ids``.  A layer whose document is unusable
    stays, carrying ``layer_error``; one that a service lists twice is one.
    """
    look_up = documents if isinstance(documents, _Lookup) else _Lookup(documents)
    listed = (
        services.select("root_url", F.col("url").alias("service_url"), F.explode("layer_ids").alias("_id"))
        .distinct()
        .withColumn("url", F.concat_ws("/", "service_url", "_id"))
    )
    return look_up(listed, "layers").select(
        "root_url",
        "service_url",
        "url",
        F.coalesce("id", F.col("_id").try_cast("bigint")).alias("id"),
        "name",
        "type",
        F.col("doc_error").alias("layer_error"),
        "body",
    )


def crawl_catalog(roots: DataFrame, documents: Documents, mode: str = "report", counts: Documents | None = None) -> Catalog:
    """Root → folders (one level) → services → layers, and counts of feature layers.

    ``roots``: ``root_url``.  Failures never stop the crawl: they are rows of
    ``errors`` with stage ``base_metadata``, ``folder_metadata`` or ``service_metadata``,
    or ``layer_error`` on a layer.  A failed root yields nothing else.
    ``mode="failfast"`` raises on the first root or folder failure instead.

    ``counts``: count envelopes by layer url (url, status, payload), landed or from
    :func:`layerframe.sources.connector.fetch_counts`; they are asked for once for each
    usable feature layer.  A count that could not be had is null, with an error of stage
    ``feature_count``.
    """
    if mode not in ("report", "failfast"):
        raise ValueError(f"mode must be 'report' or 'failfast', got {mode!r}")
    look_up = _Lookup(documents)
    usable = F.col("doc_error").isNull()

    def failures(found: DataFrame, stage: str) -> DataFrame:
        return found.where(~usable).select("root_url", F.lit(stage).alias("stage"), "url", F.col("doc_error").alias("message"))

    root_docs = look_up(roots.select("root_url", F.col("root_url").alias("url")).distinct(), "roots")
    folders = (
        root_docs.where(usable).select("root_url", F.explode("folders").alias("_f")).select("root_url", F.concat_ws("/", "root_url", "_f").alias("url")).distinct()
    )
    folder_docs = look_up(folders, "folders")
    errors = failures(root_docs, "base_metadata").unionByName(failures(folder_docs, "folder_metadata"))
    if mode == "failfast":
        first = errors.orderBy("stage", "url").first()
        if first is not None:
            raise ServiceError(f"{first.stage} of {first.url}: {first.message}")

    listing = root_docs.select("root_url", "services").unionByName(folder_docs.select("root_url", "services"))
    service_docs = look_up(listed_services(listing), "services")
    layers = service_layers(service_docs.where(usable).select("root_url", "url", "layer_ids"), look_up)
    errors = errors.unionByName(failures(service_docs, "service_metadata"))
    if counts is not None:
        wanted = layers.where(F.col("type") == FEATURE_LAYER).select("root_url", "url").distinct()
        asked = fetched_counts(wanted, counts)
        errors = errors.unionByName(
            asked.where("message IS NOT NULL").select("root_url", F.lit("feature_count").alias("stage"), "url", "message")
        )
        layers = layer_feature_count(layers, asked.select("url", "feature_count").distinct())
    return Catalog(
        roots=root_docs.select("root_url", F.col("doc_error").alias("root_error"), "body"),
        services=service_docs.select(
            "root_url", "service_name", "service_type", "url", F.col("doc_error").alias("service_error")
        ),
        layers=layers,
        errors=errors,
    )


def fetched_counts(layers: DataFrame, counts: Documents) -> DataFrame:
    """(root_url, url, feature_count, message) of layers (root_url, url), one count each.

    ``message`` says why a count is null: no answer, an error document, or no whole number.
    """
    wanted = layers.select("url").distinct()
    answers = counts.select("url", "status", "payload").join(wanted, "url", "left_semi") if isinstance(counts, DataFrame) else counts(wanted)
    parsed = parse_documents(answers.select("url", "status", "payload"))
    number = V.lax_int(V.get(F.col("body"), "count"))
    good = F.col("doc_error").isNull() & number.isNotNull()
    why = F.when(~good, F.coalesce("doc_error", F.lit("ResponseError: count is missing or not an integer")))
    judged = parsed.select("url", F.when(good, number).alias("_n"), why.alias("_why"))
    # a layer answered more than once has the greatest of its counts
    one = judged.groupBy("url").agg(F.max("_n").alias("feature_count"), F.max("_why").alias("_why"), F.lit(True).alias("_there"))
    one = cut_lineage(one, "counts")
    message = F.when(F.col("feature_count").isNull(), F.when(F.col("_there").isNull(), "TransportError: no response").otherwise(F.col("_why")))
    return layers.join(one, "url", "left").select("root_url", "url", "feature_count", message.alias("message"))


def filter_layers(layers: DataFrame, *layer_types: str) -> DataFrame:
    """Layers of any of the types, in one pass."""
    return layers.where(F.col("type").isin(*layer_types))


def feature_layers(layers: DataFrame) -> DataFrame:
    return filter_layers(layers, FEATURE_LAYER)


def raster_layers(layers: DataFrame) -> DataFrame:
    return filter_layers(layers, RASTER_LAYER)


def layer_feature_count(layers: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds ``feature_count``: for feature layers only, null when it could not be had.

    ``counts``: (url, feature_count), one row per url.
    """
    known = counts.select(F.col("url").alias("_url"), F.col("feature_count").alias("_n"))
    countable = F.col("type").eqNullSafe(F.lit(FEATURE_LAYER))
    return (
        layers.join(known, (F.col("url") == F.col("_url")) & countable, "left")
        .withColumn("feature_count", F.col("_n"))
        .drop("_url", "_n")
    )


def broken_layer_count(services: DataFrame, layers: DataFrame) -> DataFrame:
    """Layers and broken layers per service; services without layers count 0."""
    per_service = layers.groupBy(F.col("service_url").alias("url")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("layer_error").isNotNull()).alias("b")
    )
    zero = F.lit(0).cast("bigint")
    return services.join(per_service, "url", "left").select(
        F.col("url").alias("service_url"),
        F.coalesce("n", zero).alias("n_layers"),
        F.coalesce("b", zero).alias("n_broken"),
    )
