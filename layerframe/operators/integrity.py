"""What a finished read lacks or holds twice, by object id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerframe.sources.policy import raise_where


def id_report(rows: DataFrame, oid: str, expected: DataFrame | None = None, by: Sequence[str] = ("layer_url",)) -> DataFrame:
    """(by, oid, problem, n): ids that a read holds more than once, lacks, or holds unasked.

    ``rows`` are those read, ``expected`` (``by``, ``oid``) the ids there should be, null
    ids and repeats in it aside.  Problems: ``null`` (n rows without an id), ``repeated``
    (held n times), ``missing`` (n is 0) and ``unexpected``.  Both sides are counted in one
    partial aggregation, so an id that fills a third of all rows is one row per task, and a
    task holds each of its ids once, not sorted on both sides of a join.
    """
    id_of = F.col(f"`{oid}`").cast("bigint").alias("oid")
    both = rows.select(*by, id_of, F.lit(1).alias("_n"), F.lit(expected is None).alias("_wanted"))
    if expected is not None:
        wanted = expected.select(*by, id_of).where(F.col("oid").isNotNull())
        both = both.unionByName(wanted.select("*", F.lit(0).alias("_n"), F.lit(True).alias("_wanted")))
    both = both.groupBy(*by, "oid").agg(F.sum("_n").alias("_n"), F.max("_wanted").alias("_wanted"))
    n = F.col("_n")
    problem = (
        F.when(F.col("oid").isNull(), "null").when(n == 0, "missing").when(~F.col("_wanted"), "unexpected").when(n > 1, "repeated")
    )
    return both.select(*by, "oid", problem.alias("problem"), n.alias("n")).where(F.col("problem").isNotNull())


def id_gaps(rows: DataFrame, oid: str, by: Sequence[str] = ("layer_url",), block: int = 100_000) -> DataFrame:
    """(by, after, before): holes between consecutive ids of a read, for layers that number without holes.

    Ids meet in blocks of ``block`` numbers, so no window holds a whole layer; the ends of
    neighbouring blocks are compared by one more window over one row per block.
    """
    from pyspark.sql import Window

    ids = rows.select(*by, F.col(f"`{oid}`").cast("bigint").alias("_oid")).where(F.col("_oid").isNotNull()).distinct()
    blocks = ids.withColumn("_block", F.floor(F.col("_oid") / block))
    last = F.lag("_oid").over(Window.partitionBy(*by, "_block").orderBy("_oid"))
    inside = blocks.select(*by, last.alias("after"), F.col("_oid").alias("before"))
    ends = blocks.groupBy(*by, "_block").agg(F.min("_oid").alias("_low"), F.max("_oid").alias("_high"))
    earlier = F.lag("_high").over(Window.partitionBy(*by).orderBy("_block"))
    across = ends.select(*by, earlier.alias("after"), F.col("_low").alias("before"))
    return inside.unionByName(across).where(F.col("before") - F.col("after") > 1)


def require_unique_ids(rows: DataFrame, oid: str, expected: DataFrame | None = None, by: Sequence[str] = ("layer_url",)) -> DataFrame:
    """The report, empty where all is well; the query fails at the first problem."""
    def said(*parts: Column) -> Column:
        return F.concat_ws(" ", *parts)

    report = id_report(rows, oid, expected, by)
    return raise_where(report, said(*(F.col(c).cast("string") for c in by), F.lit("id"), F.coalesce(F.col("oid").cast("string"), F.lit("null")), F.lit("is"), F.col("problem")))
