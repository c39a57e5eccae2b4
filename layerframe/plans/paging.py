"""Page planning, object-id chunks, truncation and the split of truncated pages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerframe.errors import TruncatedPageError
from layerframe.plans.rank import with_rank
from layerframe.plans.scratch import cut_lineage
from layerframe.sources.pages import features_of

IN_LIST_CAP = 1000  # ids a service accepts in one IN list
MAX_SPLIT_DEPTH = 32
_BLOCK = 4096  # pages per planned block, keeps every generated array short


def clamp_factor(factor: Column, advertised: Column) -> Column:
    """``STRUCT<factor, clamped>``: a factor above the advertised one is lowered."""
    clamped = F.coalesce(factor > advertised, F.lit(False))
    return F.struct(
        F.when(clamped, advertised).otherwise(factor).alias("factor"), clamped.alias("clamped")
    )


def page_size(cap: Column, factor: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), F.floor(cap * factor).cast("bigint"))


def _checked(total: Column, cap: Column, factor: Column) -> Column:
    problem = (
        F.when(total < 0, "a layer cannot have fewer than no rows")
        .when(cap <= 0, "a page must hold at least one record")
        .when(factor <= 0, "the page factor has to be positive")
    )
    return F.when(problem.isNotNull(), F.raise_error(problem).cast("bigint")).otherwise(total)


def _explode_pages(layers: DataFrame, total: str, size: str) -> DataFrame:
    """(page_index, offset, count) rows; the number of pages of a layer is unbounded.

    Two levels: blocks of pages first, spread over the cluster, then the pages of a
    block.  So one huge layer neither builds one huge array nor runs in one task.
    """
    n = int(layers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pages = F.ceil(F.col(total) / F.col(size)).cast("bigint")
    blocks = (
        layers.where(F.col(total) > 0)
        .withColumn("_pages", pages)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pages") - 1, F.lit(_BLOCK).cast("bigint"))))
        .repartition(n, F.xxhash64("layer_url", "_block"))
    )
    last = F.least(F.col("_block") + (_BLOCK - 1), F.col("_pages") - 1)
    return (
        blocks.withColumn("page_index", F.explode(F.sequence("_block", last)))
        .withColumn("offset", F.col("page_index") * F.col(size))
        .withColumn("count", F.least(F.col(size), F.col(total) - F.col("offset")))
        .drop("_pages", "_block")
    )


def pagination_plan(layers: DataFrame, factor: float = 1.0) -> DataFrame:
    """Offset pages of every layer.

    ``layers``: ``layer_url``, ``total``, ``max_record_count``, ``advertised_factor``.
    A layer without rows has no pages.
    """
    chosen = clamp_factor(F.lit(float(factor)), F.col("advertised_factor"))
    planned = (
        layers.withColumn("_f", chosen)
        .withColumn("total", _checked(F.col("total"), F.col("max_record_count"), F.lit(float(factor))))
        .withColumn("page_size", page_size(F.col("max_record_count"), F.col("_f.factor")))
        .withColumn("clamped", F.col("_f.clamped"))
        .drop("_f")
    )
    return _explode_pages(planned, "total", "page_size").select(
        "layer_url", "page_index", "offset", "count", "page_size", "clamped"
    )


def and_where(base: Column, extra: Column) -> Column:
    """Conjunction of two predicate texts; an all-records base disappears."""
    trivial = base.isNull() | (base == "") | (base == "1=1")
    return F.when(trivial, extra).otherwise(
        F.concat(F.lit("("), base, F.lit(") AND ("), extra, F.lit(")"))
    )


def in_list(field: Column, ids: Column) -> Column:
    """``field In (1, 2, 3)`` for an array of ids."""
    listed = F.array_join(F.transform(ids, lambda i: i.cast("string")), ", ")
    return F.concat(field, F.lit(" In ("), listed, F.lit(")"))


BAD_CAP = "the layer states no usable record cap"
NO_IDS = "the layer needs object ids and none are known"


def plan_requests(
    layers: DataFrame,
    ids: DataFrame | None = None,
    requested_page_size: int | None = None,
    order_by: str | None = None,
) -> DataFrame:
    """All requests needed to read every layer completely.

    ``layers``: ``layer_url``, ``total``, ``max_record_count``, ``supports_pagination``,
    ``pagination_explicit``, ``advertised_factor``, ``object_id_field``, ``where``.
    ``ids``: (``layer_url``, ``oid``), needed for layers without offset paging.

    A layer that fits one response gets one request.  Explicit paging support gives
    offset pages, sorted by object id unless ``order_by`` is given; anything else gets
    runs of ``max_record_count`` object ids.  A layer that cannot be planned, for want of
    a positive cap, of a total or of its ids, is one row with ``error`` and no request.
    ``total`` and ``object_id_field`` repeat the layer's, ``oids`` are the ids a request lists.
    """
    cap, total = F.col("max_record_count"), F.col("total")
    usable = F.coalesce((cap > 0) & (total >= 0), F.lit(False))
    single = total <= cap
    paged = ~single & F.coalesce(F.col("supports_pagination") & F.col("pagination_explicit"), F.lit(False))
    strategy = F.when(~usable, "none").when(single, "single").when(paged, "offset").otherwise("oid")
    # Written once: the strategies each read this table, and its totals may be costly.
    sized = cut_lineage(layers.withColumn("strategy", strategy), "layers")
    order = F.lit(order_by) if order_by else F.col("object_id_field")

    def requests(df: DataFrame, index: Column, offset=None, count=None, where="where", order=F.lit(order_by), error=None, oids=None) -> DataFrame:
        text = lambda c: (F.lit(None) if c is None else c).cast("string")
        number = lambda c: (F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c).cast("bigint")
        return df.select(
            "layer_url",
            number(index).alias("page_index"),
            "strategy",
            number(offset).alias("offset"),
            number(count).alias("count"),
            (F.col(where) if isinstance(where, str) else where).alias("where"),
            text(order).alias("order_by"),
            text(error).alias("error"),
            number("total").alias("total"),
            "object_id_field",
            (F.lit(None) if oids is None else F.col(oids)).cast("array<bigint>").alias("oids"),
        )

    unusable = requests(sized.where("strategy = 'none'"), F.lit(None), error=F.lit(BAD_CAP))
    one = requests(sized.where("strategy = 'single'"), F.lit(0))
    if requested_page_size is not None and requested_page_size > 0:
        size = F.least(F.lit(requested_page_size).cast("bigint"), cap.cast("bigint"))
    else:
        # Callers leave the factor at 1, so only an advertised factor below 1 matters.
        size = page_size(cap, clamp_factor(F.lit(1.0), F.col("advertised_factor"))["factor"])
    blocks = _explode_pages(sized.where("strategy = 'offset'").withColumn("_size", size), "total", "_size")
    offsets = requests(blocks, F.col("page_index"), F.col("offset"), F.col("count"), order=order)
    plan = unusable.unionByName(one).unionByName(offsets)
    chunked = sized.where("strategy = 'oid'")
    if ids is None:
        return plan.unionByName(requests(chunked, F.lit(None), error=F.lit(NO_IDS)))
    wanted = ids.where(F.col("oid").isNotNull()).join(
        chunked.select("layer_url", F.col("max_record_count").alias("_cap")), "layer_url"
    )
    chunks = oid_chunks(wanted, "oid", F.col("_cap"), by=("layer_url",)).drop("error")
    # a left join: a layer without ids stays, with its error
    by_oid = chunked.select("layer_url", "strategy", "where", "object_id_field", "total").join(chunks, "layer_url", "left")
    where = F.when(F.col("oids").isNull(), F.col("where")).otherwise(
        and_where(F.col("where"), in_list(F.col("object_id_field"), F.col("oids")))
    )
    error = F.when(F.col("oids").isNull(), NO_IDS)
    return plan.unionByName(requests(by_oid, F.col("chunk_index"), where=where, error=error, oids="oids"))


def oid_chunks(
    df: DataFrame, oid: str, cap: Column | int, by: Sequence[str] = ()
) -> DataFrame:
    """Consecutive runs of ``cap`` object ids: chunk index, bounds, the ids and ``error``.

    Ids are made distinct first, with partial aggregation, so repeated ids cost no
    more than one row per task.  Ids under a cap that is null or not positive are not
    listed: they are counted in one row with ``error`` instead of a chunk.
    """
    cap = F.lit(cap) if isinstance(cap, int) else cap
    ids = df.select(*by, F.col(oid).alias("_oid"), cap.cast("bigint").alias("_cap")).distinct()
    usable = F.coalesce(F.col("_cap") > 0, F.lit(False))
    ranked = with_rank(ids.where(usable), ["_oid"], by, "_rank")
    chunk = F.expr("_rank div _cap")
    chunks = ranked.groupBy(*by, chunk.alias("chunk_index")).agg(
        F.min("_oid").alias("lo"),
        F.max("_oid").alias("hi"),
        F.count(F.lit(1)).alias("n_ids"),
        F.sort_array(F.collect_list("_oid")).alias("oids"),  # at most ``cap`` ids
        F.lit(None).cast("string").alias("error"),
    )
    refused = (
        ids.where(~usable)
        .groupBy(*by)
        .agg(F.min("_oid").alias("lo"), F.max("_oid").alias("hi"), F.count(F.lit(1)).alias("n_ids"))
        .where("n_ids > 0")
        .withColumn("error", F.lit(BAD_CAP))
    )
    return chunks.unionByName(refused, allowMissingColumns=True)


# --- capped bisection -------------------------------------------------------------


def bisection_leaf(position: Column, size: Column, cap: int = IN_LIST_CAP) -> Column:
    """``STRUCT<lo, hi>``: the chunk holding ``position`` when ``size`` ids are halved
    at the midpoint until no chunk has more than ``cap``.  Bounds are [lo, hi)."""
    start = F.struct(F.lit(0).cast("bigint").alias("lo"), size.cast("bigint").alias("hi"))
    # After log2(size / cap) halvings, rounded up, every chunk fits.
    depth = F.ceil(F.log2(F.greatest(size, F.lit(cap)) / F.lit(cap))).cast("int") + 1
    rounds = F.sequence(F.lit(1), depth)

    def halve(span: Column, _: Column) -> Column:
        lo, hi = span["lo"], span["hi"]
        mid = lo + F.shiftright(hi - lo, 1)
        left = position < mid
        return F.when(hi - lo <= cap, span).otherwise(
            F.struct(
                F.when(left, lo).otherwise(mid).alias("lo"),
                F.when(left, mid).otherwise(hi).alias("hi"),
            )
        )

    return F.aggregate(rounds, start, halve)


def cap_id_list(ids: Column, cap: int = IN_LIST_CAP) -> Column:
    """One page's id list cut by midpoint halving into lists of at most ``cap``."""
    positions = F.sequence(F.lit(0).cast("bigint"), F.size(ids).cast("bigint") - 1)
    leaves = F.array_distinct(
        F.transform(positions, lambda p: bisection_leaf(p, F.size(ids), cap))
    )
    cut = F.transform(
        leaves,
        lambda leaf: F.slice(ids, (leaf["lo"] + 1).cast("int"), (leaf["hi"] - leaf["lo"]).cast("int")),
    )
    return F.when(F.size(ids) <= cap, F.array(ids)).otherwise(cut)


def cap_oid_chunks(
    df: DataFrame, oid: str, cap: int = IN_LIST_CAP, by: Sequence[str] = ()
) -> DataFrame:
    """Capped bisection of a whole id list, however long: leaf bounds and its ids."""
    ids = df.select(*by, F.col(oid).alias("_oid")).distinct()
    ranked = with_rank(ids, ["_oid"], by, "_rank", size="_n")
    leaf = bisection_leaf(F.col("_rank"), F.col("_n"), cap)
    return (
        ranked.withColumn("_leaf", leaf)
        .groupBy(*by, F.col("_leaf.lo").alias("start"), F.col("_leaf.hi").alias("stop"))
        .agg(
            F.min("_oid").alias("lo"),
            F.max("_oid").alias("hi"),
            F.count(F.lit(1)).alias("n_ids"),
            F.sort_array(F.collect_list("_oid")).alias("oids"),
        )
    )


# --- truncation -------------------------------------------------------------------


def truncation_report(scanned: DataFrame) -> DataFrame:
    """Truncated pages; ``inconsistent`` marks those that are also empty."""
    n = F.size(features_of(F.col("body")))
    return (
        scanned.where((F.col("status") == "ok") & F.col("exceeded"))
        .select("layer_url", "page_index", n.alias("n_features"))
        .withColumn("inconsistent", F.col("n_features") == 0)
    )


def apply_truncation_policy(scanned: DataFrame, on_truncation: str = "raise") -> DataFrame:
    """``raise`` fails the query, ``ignore`` keeps the page with its ``exceeded`` flag.

    ``split`` needs a way to ask again: see :func:`split_truncated`.
    """
    if on_truncation not in ("raise", "ignore", "split"):
        raise ValueError(f"on_truncation must be raise, ignore or split, got {on_truncation!r}")
    if on_truncation == "split":
        raise ValueError("use split_truncated with a fetch function")
    if on_truncation == "ignore":
        return scanned
    from layerframe.sources.pages import require_complete

    return require_complete(scanned)


def split_truncated(
    requests: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    max_depth: int = MAX_SPLIT_DEPTH,
    cap: int = IN_LIST_CAP,
) -> DataFrame:
    """Answers to all requests, with truncated ones halved and asked again.

    ``requests`` has ``layer_url``, ``page_index`` and ``oids`` (the page's own ids).
    ``fetch`` gets those plus ``depth`` and ``path`` and returns them with an
    ``exceeded`` flag and whatever else it fetched.  Each round handles every
    truncated page in one job and is written out, so no page is fetched twice; the
    driver only learns whether any page is left.
    """
    pending = requests.withColumn("depth", F.lit(0)).withColumn("path", F.lit(""))
    complete: list[DataFrame] = []
    for depth in range(max_depth + 1):
        answered = cut_lineage(
            fetch(pending).withColumn("exceeded", F.coalesce("exceeded", F.lit(False))), "split"
        )
        complete.append(answered.where(~F.col("exceeded")))
        left = answered.where("exceeded")
        n_left, smallest = left.agg(
            F.count(F.lit(1)), F.coalesce(F.min(F.size("oids")), F.lit(0))
        ).first()
        if n_left == 0:
            break
        if smallest <= 1:
            raise TruncatedPageError("a truncated page of at most one id cannot be split further")
        if depth == max_depth:
            raise TruncatedPageError(f"split reached its maximum depth of {max_depth}")
        pending = _halves(left, cap)
    result = complete[0]
    for part in complete[1:]:
        result = result.unionByName(part)
    return result


def _halves(left: DataFrame, cap: int) -> DataFrame:
    ids = F.col("oids")
    mid = F.shiftright(F.size(ids), 1)
    first = F.slice(ids, F.lit(1), mid)
    second = F.slice(ids, mid + 1, F.size(ids) - mid)
    parts = F.concat(cap_id_list(first, cap), cap_id_list(second, cap))
    return left.select(
        "layer_url",
        "page_index",
        (F.col("depth") + 1).alias("depth"),
        "path",
        F.posexplode(parts).alias("_part", "oids"),
    ).select(
        "layer_url",
        "page_index",
        "depth",
        F.concat("path", F.lit("/"), F.col("_part").cast("string")).alias("path"),
        "oids",
    )


def emit_order(df: DataFrame, order: str = "request") -> DataFrame:
    """``request`` gives plan order, ``completion`` leaves the order open."""
    if order not in ("request", "completion"):
        raise ValueError(f"no such emit order: {order!r} (request, completion)")
    if order == "completion":
        return df
    keys = [c for c in ("layer_url", "page_index", "pos") if c in df.columns]
    return df.orderBy(*keys)


def page_sizes(scanned: DataFrame) -> DataFrame:
    """Features per page."""
    return scanned.where(F.col("status") == "ok").select(
        "layer_url", "page_index", F.size(features_of(F.col("body"))).cast("bigint").alias("n_features")
    )
