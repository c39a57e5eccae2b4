"""Carrying out a plan: all requests of all layers answered, checked and put together.

A plan is what ``plan_requests`` gives.  An *answer function* takes request rows and
returns them with ``status``, ``error``, ``exceeded``, ``oid_field`` and ``features``
(ARRAY<VARIANT>): ``landed_answers`` looks them up in landed pages,
``layerframe.sources.connector.fetch_answers`` asks the services.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerframe.errors import TruncatedPageError
from layerframe.functions import variants as V
from layerframe.plans.paging import IN_LIST_CAP, MAX_SPLIT_DEPTH, cap_id_list
from layerframe.plans.scratch import cut_lineage
from layerframe.sources.pages import features_of, scan_pages
from layerframe.sources.policy import ReadPolicy, page_name, raise_where

AnswerFunction = Callable[[DataFrame], DataFrame]
REQUEST = ("layer_url", "page_index", "path", "depth", "strategy", "offset", "count", "where", "order_by", "object_id_field", "oids")
_BLOCK = 1000  # rows per block of the range join


@dataclass(frozen=True)
class Reading:
    """What a plan brought in.  The answers were written once; these are lazy views of them."""

    features: DataFrame  # layer_url, page_index, path, pos, oid_field, attributes, geometry, feature, exceeded
    quarantine: DataFrame  # layer_url, page_index, path, status, code, message
    states: DataFrame  # layer_url, page_index, strategy, asked, found, state


def shaped_answers(scanned: DataFrame) -> DataFrame:
    """Requests with a ``payload``, parsed by ``scan_pages``, in the form of an answer."""
    body = F.col("body")
    oid_field = V.text(V.first_of(body, "objectIdFieldName", "object_id_field_name"))
    return scanned.select(*REQUEST, "status", "error", "exceeded", oid_field.alias("oid_field"), features_of(body).alias("features"))


def landed_answers(pages: DataFrame, oid: str) -> AnswerFunction:
    """Answers from landed pages that hold what the plan's predicates select.

    ``pages``: layer_url, ``offset`` and ``count`` (the window of the layer's order that
    the page was asked for), payload.  Windows of requests and pages need not agree: they
    meet in a range join by blocks of rows, each pair in the first block they share, and
    the page's features are cut to the request.  Listed ids meet features by their value
    in ``oid``.  A page that failed or was cut off marks every request it concerns; a
    request that meets no page is ``unanswered``.  A window covered by several pages gets
    one row per page.
    """
    landed = scan_pages(pages)
    body = F.col("body")
    named = V.text(V.first_of(body, "objectIdFieldName", "object_id_field_name"))
    held = landed.select(
        "layer_url", F.col("offset").alias("_from"), (F.col("offset") + F.col("count")).alias("_to"),
        "status", "error", "exceeded", named.alias("oid_field"), features_of(body).alias("_features"),
    )

    def blocks(low: str, high: str) -> Column:
        return F.sequence(F.expr(f"{low} div {_BLOCK}"), F.expr(f"({high} - 1) div {_BLOCK}"))

    def by_window(requests: DataFrame) -> DataFrame:
        # a layer that fits one response is the window of all its rows
        low = F.coalesce("offset", F.lit(0).cast("bigint"))
        high = low + F.coalesce("count", "total")
        windows = requests.withColumn("_low", low).withColumn("_high", high).where("_high > _low")
        left = windows.withColumn("_block", F.explode(blocks("_low", "_high")))
        right = held.where("_to > _from").withColumn("_block", F.explode(blocks("_from", "_to")))
        begin, end = F.greatest("_low", "_from"), F.least("_high", "_to")
        met = left.join(right, ["layer_url", "_block"]).where((begin < end) & (F.expr(f"greatest(_low, _from) div {_BLOCK}") == F.col("_block")))
        n = F.size("_features")
        cut = F.slice("_features", (begin - F.col("_from") + 1).cast("int"), F.greatest(F.lit(0), end - begin).cast("int"))
        return met.select(
            *REQUEST, "status", "error",
            # only a request that reaches past what the page served misses rows
            (F.col("exceeded") & (end > F.col("_from") + n)).alias("exceeded"),
            "oid_field", cut.alias("features"), begin.alias("_first"),
        )

    def by_ids(requests: DataFrame) -> DataFrame:
        listed = requests.select("layer_url", "page_index", "path", F.explode("oids").alias("_oid"))
        found = held.where(F.col("status") == "ok").select("layer_url", "oid_field", F.explode("_features").alias("_feature"))
        # a feature travels as text: as a VARIANT it would carry the keys of its whole page
        found = found.select(
            "layer_url", "oid_field", V.get(F.col("_feature"), "attributes", oid, to="bigint").alias("_oid"), F.to_json("_feature").alias("_text")
        )
        met = listed.join(found, ["layer_url", "_oid"])
        # at most one response's ids
        answered = met.groupBy("layer_url", "page_index", "path").agg(
            F.first("oid_field", True).alias("oid_field"),
            F.transform(F.array_sort(F.collect_list(F.struct("_oid", "_text"))), lambda f: F.parse_json(f["_text"])).alias("features"),
        )
        return requests.join(answered, ["layer_url", "page_index", "path"]).select(
            *REQUEST, F.lit("ok").alias("status"), F.lit(None).cast("struct<code:bigint,message:string>").alias("error"),
            F.lit(False).alias("exceeded"), "oid_field", "features", F.lit(0).cast("bigint").alias("_first"),
        )

    def answer(requests: DataFrame) -> DataFrame:
        listed = F.col("oids").isNotNull()
        return by_window(requests.where(~listed)).unionByName(by_ids(requests.where(listed)))

    return answer


def read_layers(
    plan: DataFrame, answer: AnswerFunction, policy: ReadPolicy = ReadPolicy(), ids: DataFrame | None = None, max_depth: int = MAX_SPLIT_DEPTH
) -> Reading:
    """Carries out a plan under a policy.

    Each round of requests is one job whose answers are written once; without ``split``
    there is one round.  Splitting halves the window or the id list of every cut-off
    request of a round and asks again, as often as ``max_depth`` allows; a request of one
    row cannot be halved and fails the read.  A layer asked for in one request may know no
    windows, so it is split by its ``ids`` (layer_url, oid).  Under ``raise`` a failed, unanswered or
    unplannable request, and a cut-off one, fail the queries over ``features``.
    """
    planned = plan.where(F.col("error").isNull())
    pending = planned.withColumn("path", F.lit("")).withColumn("depth", F.lit(0))
    rounds: list[DataFrame] = []
    for depth in range(max_depth + 1):
        answered = cut_lineage(answer(pending.select(*REQUEST, "total")), "answers")
        if policy.on_truncation != "split":
            rounds.append(answered)
            break
        cut = (F.col("status") == "ok") & F.coalesce("exceeded", F.lit(False))
        # a request answered by several pages is asked again whole
        again = answered.where(cut).select(*REQUEST).dropDuplicates(["layer_url", "page_index", "path"])
        rounds.append(answered.join(again.select("layer_url", "page_index", "path"), ["layer_url", "page_index", "path"], "left_anti"))
        pending = again.join(pending.select("layer_url", "page_index", "path", "total"), ["layer_url", "page_index", "path"])
        if not depth:
            pending = _with_ids(pending, ids)
        size = F.coalesce(F.size(F.when(F.col("oids").isNotNull(), F.col("oids"))), F.coalesce("count", "total"))
        n, smallest = pending.agg(F.count(F.lit(1)), F.min(F.coalesce(size, F.lit(0)))).first()
        if not n:
            break
        if smallest <= 1:
            raise TruncatedPageError("a cut-off request of at most one row cannot be split further")
        if depth == max_depth:
            raise TruncatedPageError(f"split reached its maximum depth of {max_depth}")
        pending = cut_lineage(_halved(pending), "requests")
    whole = rounds[0]
    for part in rounds[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return _reading(plan, whole, policy)


def _with_ids(requests: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Single requests with the ids of their layers, at most a response's; without ``ids`` they cannot be split."""
    single = (F.col("strategy") == "single") & F.col("oids").isNull()
    if ids is None:
        said = F.concat(page_name(), F.lit(": only the ids of the layer could split its one request"))
        return raise_where(requests, F.when(single, said))
    listed = (
        ids.where(F.col("oid").isNotNull())
        .join(requests.where(single).select("layer_url").distinct(), "layer_url", "left_semi")
        .groupBy("layer_url")
        .agg(F.array_sort(F.collect_set(F.col("oid").cast("bigint"))).alias("_ids"))
    )
    return requests.join(listed, "layer_url", "left").withColumn("oids", F.coalesce("oids", F.when(single, F.col("_ids")))).drop("_ids")


def _halved(requests: DataFrame) -> DataFrame:
    """Two requests for each: halves of its window or of its ids, lists never above the cap of an IN list."""
    ids = F.col("oids")
    mid = F.shiftright(F.size(ids), 1)
    lists = F.concat(cap_id_list(F.slice(ids, F.lit(1), mid), IN_LIST_CAP), cap_id_list(F.slice(ids, mid + 1, F.size(ids) - mid), IN_LIST_CAP))
    low, n = F.coalesce("offset", F.lit(0).cast("bigint")), F.coalesce("count", "total")
    half = F.expr("coalesce(count, total) div 2")
    none = F.lit(None).cast("bigint")

    def request(offset: Column, count: Column, oids: Column) -> Column:
        return F.struct(offset.alias("offset"), count.alias("count"), oids.alias("oids"))

    nothing = F.lit(None).cast("array<bigint>")
    windows = F.array(request(low, half, nothing), request(low + half, n - half, nothing))
    parts = F.when(ids.isNotNull(), F.transform(lists, lambda part: request(none, none, part))).otherwise(windows)
    kept = ("layer_url", "page_index", "strategy", "where", "order_by", "object_id_field", "total")
    return requests.select(*kept, "path", (F.col("depth") + 1).alias("depth"), F.posexplode(parts).alias("_i", "_part")).select(
        *kept, "depth", F.concat("path", F.lit("/"), F.col("_i").cast("string")).alias("path"), "_part.*"
    )


def _reading(plan: DataFrame, answers: DataFrame, policy: ReadPolicy) -> Reading:
    ok = F.col("status") == "ok"
    exceeded = F.coalesce("exceeded", F.lit(False))
    keys = ["layer_url", "page_index"]
    per_request = answers.groupBy(*keys).agg(
        F.sum(F.when(ok, F.size("features")).otherwise(0)).cast("bigint").alias("found"),
        F.max(~ok).alias("_failed"),
        F.max(ok & exceeded).alias("_cut"),
        F.min(F.when(~ok, F.concat_ws(" ", "status", "error.message"))).alias("_why"),
    )
    asked = F.when(F.col("oids").isNotNull(), F.size("oids").cast("bigint")).otherwise(F.coalesce("count", "total"))
    joined = plan.select(*keys, "strategy", "error", F.when(F.col("error").isNull(), asked).alias("asked")).join(
        per_request.where(F.col("page_index").isNotNull()), keys, "left"
    )
    state = (
        F.when(F.col("error").isNotNull(), "not_planned")
        .when(F.col("found").isNull() & (F.col("asked") == 0), "complete")
        .when(F.col("found").isNull(), "unanswered")
        .when(F.col("_failed"), "failed")
        .when(F.col("_cut"), "truncated")
        .when(F.col("found") < F.col("asked"), "short")
        .when(F.col("found") > F.col("asked"), "over")
        .otherwise("complete")
    )
    judged = joined.withColumn("state", state)
    states = judged.select(*keys, "strategy", "asked", F.coalesce("found", F.lit(0).cast("bigint")).alias("found"), "state")
    nothing = F.lit(None).cast("string")
    unmet = judged.where(F.col("state").isin("not_planned", "unanswered")).select(
        *keys, nothing.alias("path"), F.col("state").alias("status"), F.lit(None).cast("bigint").alias("code"), F.col("error").alias("message")
    )
    quarantine = answers.where(~ok).select(*keys, "path", "status", "error.code", "error.message").unionByName(unmet)
    # One condition raises and selects: a separate test for usable answers would reach the
    # scan of what was written and skip the rows that must fail the query.
    said = F.lit(None).cast("string")
    if policy.on_error == "raise":
        answers = answers.unionByName(unmet.select(*keys, "status"), allowMissingColumns=True)
        said = F.when(~ok, F.concat(page_name(), F.lit(": "), F.concat_ws(" ", "status", "error.message")))
    if policy.on_truncation == "raise":
        cut_off = F.concat(page_name(), F.lit(": exceededTransferLimit=true, rows are missing"))
        said = F.coalesce(said, F.when(ok & exceeded, cut_off))
    answers = answers.where(F.when(said.isNotNull(), F.raise_error(said).cast("boolean")).otherwise(ok))
    # a window's rows are counted from its own first one, whichever page they lie in
    first = F.coalesce("_first", "offset", F.lit(0).cast("bigint")) if "_first" in answers.columns else F.coalesce("offset", F.lit(0).cast("bigint"))
    start = first - F.coalesce("offset", F.lit(0).cast("bigint"))
    features = (
        answers.select(*keys, "path", "oid_field", exceeded.alias("exceeded"), start.alias("_start"), F.posexplode("features").alias("_i", "feature"))
        .select(
            *keys, "path", (F.col("_start") + F.col("_i")).alias("pos"), "oid_field",
            V.get(F.col("feature"), "attributes").alias("attributes"), V.get(F.col("feature"), "geometry").alias("geometry"),
            "feature", "exceeded",
        )
    )
    return Reading(features, quarantine, states)
