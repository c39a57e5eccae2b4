"""What a whole read does with pages that are broken or cut off."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerframe.sources.pages import features_of

ON_ERROR = ("raise", "quarantine")
ON_TRUNCATION = ("raise", "ignore", "split")


@dataclass(frozen=True)
class ReadPolicy:
    """``on_error``: ``raise``, or ``quarantine`` to leave failed pages to the quarantine table.
    ``on_truncation``: ``raise``, ``ignore`` to keep a cut-off page and flag its rows, or
    ``split`` to ask for its halves, which only a read that can ask again offers.
    """

    on_error: str = "raise"
    on_truncation: str = "raise"

    def __post_init__(self) -> None:
        for name, allowed in (("on_error", ON_ERROR), ("on_truncation", ON_TRUNCATION)):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}, got {getattr(self, name)!r}")


def raise_where(df: DataFrame, problem: Column) -> DataFrame:
    """The same rows; the query fails with ``problem`` where it is not null."""
    return df.where(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)))


def page_name() -> Column:
    return F.concat(F.coalesce("layer_url", F.lit("?")), F.lit(" page "), F.coalesce(F.col("page_index").cast("string"), F.lit("?")))


def enforce(scanned: DataFrame, policy: ReadPolicy) -> DataFrame:
    """Pages as ``scan_pages`` gives them, under a policy.

    ``raise`` fails the query at the first page concerned.  What is not raised stays as it
    is: failed pages with their ``status``, cut-off ones with ``exceeded``; the scans of
    features leave the former out.
    """
    if policy.on_truncation == "split":
        raise ValueError("landed pages cannot be split; read a plan with read_layers")
    said = F.lit(None).cast("string")
    if policy.on_error == "raise":
        why = F.concat_ws(" ", "status", "error.message")
        said = F.when(F.col("status") != "ok", F.concat(page_name(), F.lit(": "), why))
    if policy.on_truncation == "raise":
        cut_off = F.concat(page_name(), F.lit(": exceededTransferLimit=true, rows are missing"))
        said = F.coalesce(said, F.when((F.col("status") == "ok") & F.col("exceeded"), cut_off))
    if policy == ReadPolicy("quarantine", "ignore"):
        return scanned
    return raise_where(scanned, said)


def page_states(scanned: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """One row per planned or landed page: (layer_url, page_index, asked, found, landed, state).

    ``plan``: layer_url, page_index, ``count`` (null where the plan states none).  States,
    the first that holds: ``missing`` (planned, not landed), ``failed`` (no landed copy is
    usable), ``truncated``, ``unplanned``, ``short``, ``over``, ``complete``.  A page landed
    more than once counts the features of its fullest copy; ``landed`` tells how often.
    """
    usable = F.col("status") == "ok"
    found = scanned.groupBy("layer_url", "page_index").agg(
        F.count(F.lit(1)).alias("landed"),
        F.max(F.when(usable, F.size(features_of(F.col("body"))).cast("bigint"))).alias("found"),
        F.min(F.when(usable, F.col("exceeded"))).alias("_cut"),
    )
    if plan is None:
        both = found.withColumn("asked", F.lit(None).cast("bigint")).withColumn("_planned", F.lit(True))
    else:
        asked = plan.groupBy("layer_url", "page_index").agg(F.sum("count").alias("asked"), F.lit(True).alias("_planned"))
        both = asked.join(found, ["layer_url", "page_index"], "full_outer")
    state = (
        F.when(F.col("landed").isNull(), "missing")
        .when(F.col("found").isNull(), "failed")
        .when(F.col("_cut"), "truncated")
        .when(F.col("_planned").isNull(), "unplanned")
        .when(F.col("found") < F.col("asked"), "short")
        .when(F.col("found") > F.col("asked"), "over")
        .otherwise("complete")
    )
    return both.select(
        "layer_url", "page_index", "asked", "found", F.coalesce("landed", F.lit(0).cast("bigint")).alias("landed"), state.alias("state")
    )
