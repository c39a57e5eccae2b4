"""Union of chunks that must share one spatial reference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_chunks(chunks: Sequence[DataFrame], srid: str = "srid", expected: int | None = None) -> DataFrame:
    """All rows of all chunks; a row of another spatial reference fails the query.

    A row that states no reference, as one without a geometry, fits any.  ``expected`` is
    the layer's own reference; without it the smallest one found counts, which takes one
    more pass over that column.  Nothing runs before the result does.
    """
    if not chunks:
        raise ValueError("nothing to union")
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)
    if expected is None:
        # exactly one row
        found = whole.agg(F.min(srid).alias("_expected"))
        checked = whole.join(F.broadcast(found))
    else:
        checked = whole.withColumn("_expected", F.lit(expected))
    differs = F.coalesce(F.col(srid) != F.col("_expected"), F.lit(False))
    said = F.concat(F.lit("a chunk is in reference "), F.col(srid).cast("string"), F.lit(", the layer in "), F.col("_expected").cast("string"))
    checked = checked.where(F.when(differs, F.raise_error(said).cast("boolean")).otherwise(F.lit(True)))
    return checked.drop("_expected")
