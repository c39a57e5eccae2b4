"""Whole layers from their landed pages: a table of rows, or of features in one reference.

Nothing leaves a whole read silently.  A page that failed or was cut off fails the query
unless a policy says otherwise; then failed pages are in ``quarantined_pages`` and the rows
of cut-off ones are flagged.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerframe.operators.domains import resolve_domains_from
from layerframe.operators.normalize import normalize_features
from layerframe.operators.union import union_chunks
from layerframe.sources.pages import quarantined_pages, scan_features, scan_pages, scan_rows
from layerframe.sources.policy import ReadPolicy, enforce, page_states, raise_where


def get_df(
    pages: DataFrame,
    fields: Iterable[Any],
    codes: DataFrame | None = None,
    coded: Sequence[str] = (),
    policy: ReadPolicy = ReadPolicy(),
) -> DataFrame:
    """All rows of the pages, typed by ``fields`` and without geometry.

    The fields ``coded`` show names instead of codes, as listed in ``codes``
    (see :func:`layerframe.operators.domains.domain_codes`).  Where the policy ignores
    truncation, ``truncated`` tells whether a row's page was cut off.
    """
    features = scan_features(enforce(scan_pages(pages), policy))
    kept = ("layer_url", "page_index", "pos")
    if policy.on_truncation == "ignore":
        features, kept = features.withColumnRenamed("exceeded", "truncated"), (*kept, "truncated")
    rows = scan_rows(features, fields, keep=kept, geometry=False)
    for name in coded if codes is not None else ():
        rows = resolve_domains_from(rows, codes, name)
    return rows


def get_geo_df(chunks: DataFrame | Sequence[DataFrame], srid: int, policy: ReadPolicy = ReadPolicy()) -> DataFrame:
    """All features of one or more chunks of pages, stamped with the layer's reference.

    The reference belongs to the whole: ``srid`` is set on every row, also on those
    without a geometry, and a geometry that states another reference fails the query.
    ``truncated`` as in :func:`get_df`.
    """
    chunks = [chunks] if isinstance(chunks, DataFrame) else list(chunks)
    features = [
        (f := normalize_features(enforce(scan_pages(pages), policy))).withColumn(
            "_own", F.when(f["geometry"].isNotNull(), f["geometry.srid"])
        )
        for pages in chunks
    ]
    whole = union_chunks(features, "_own", expected=srid).drop("_own").withColumn("srid", F.lit(srid))
    return whole.withColumnRenamed("exceeded", "truncated") if policy.on_truncation == "ignore" else whole.drop("exceeded")


@dataclass(frozen=True)
class WholeRead:
    """A whole read and the account of it."""

    rows: DataFrame
    quarantine: DataFrame  # layer_url, page_index, status, code, message, payload
    states: DataFrame  # of every planned or landed page, see ``page_states``


def read_whole(
    pages: DataFrame, fields: Iterable[Any], plan: DataFrame | None = None, policy: ReadPolicy = ReadPolicy("quarantine", "ignore")
) -> WholeRead:
    """Rows of a layer's landed pages with the failed pages and the state of all of them.

    ``plan`` (layer_url, page_index, count) makes missing, short and unplanned pages
    visible; see :func:`require_complete_read` to fail on them.
    """
    scanned = scan_pages(pages)
    return WholeRead(get_df(pages, fields, policy=policy), quarantined_pages(scanned), page_states(scanned, plan))


def require_complete_read(states: DataFrame) -> DataFrame:
    """The states; the query fails at a page that is not complete."""
    page = F.concat(F.coalesce("layer_url", F.lit("?")), F.lit(" page "), F.coalesce(F.col("page_index").cast("string"), F.lit("?")))
    return raise_where(states, F.when(F.col("state") != "complete", F.concat(page, F.lit(" is "), "state")))
