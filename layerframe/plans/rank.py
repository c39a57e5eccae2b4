"""Exact distributed rank without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerframe.plans.scratch import cut_lineage

_SHIFT = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def _named(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def with_rank(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    name: str = "rank",
    size: str | None = None,
) -> DataFrame:
    """Adds the 0-based rank of each row in the order of ``order`` within ``by``.

    ``size`` names a further column for the number of rows in the group.

    One range shuffle spreads even a single dominant group over all partitions; the
    sorted rows are written once with their place, so the second pass sees the same
    partitions.  Only per-partition counts are added up afterwards: at most one row
    per partition, or per partition and group.

    Rows that tie on all keys get distinct ranks in no particular order.
    """
    spark = df.sparkSession
    keys = [_named(c) for c in (*by, *order)]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "rank",
    )
    placed = placed.withColumn("_part", F.shiftright("_slot", _SHIFT)).withColumn(
        "_pos", F.col("_slot").bitwiseAND((1 << _SHIFT) - 1)
    )
    group = [_named(c).alias(f"_by_{i}") for i, c in enumerate(by)]
    names = [f"_by_{i}" for i in range(len(by))]
    slices = placed.groupBy(F.col("_part").alias("_slice"), *group).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    # Within one group there are at most as many slices as partitions.
    group_slices = Window.partitionBy(*names)
    before = group_slices.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn(
        "_size", F.sum("_n").over(group_slices)
    )
    if not by:
        # At most one row per shuffle partition.
        slices = F.broadcast(slices)
    on = F.col("_part") == F.col("_slice")
    for column, alias in zip(by, names):
        on = on & _named(column).eqNullSafe(F.col(alias))
    added = [(F.col("_pos") - F.col("_first") + F.col("_before")).alias(name)]
    if size:
        added.append(F.col("_size").alias(size))
    # Every row has its slice; a left join, as only its right side is ever sent to all tasks,
    # however small the files of the rows are.
    return placed.join(slices, on, "left").select(*map(_named, df.columns), *added)


_CELLS = 1 << 14  # cells of one histogram, at most


def id_at_rank(ids: DataFrame, name: str, rank: int, low: int, high: int, before: int = 0) -> tuple[int, int]:
    """(id, rows with smaller ids) of the row at a 0-based rank, for whole-number ids in [low, high].

    ``before`` is the number of rows below ``low``.  Histograms over ever narrower ranges
    find it: each is a filtered scan of the one column and an aggregate of at most
    ``_CELLS`` rows, and each narrows the range by that factor.
    """
    while True:
        width = -(-(high - low + 1) // _CELLS)
        # wide ranges do not fit a difference of 64 bits
        wide = high - low >= 1 << 63 or low == -(1 << 63)
        base = f"cast(`{name}` as {'decimal(20,0)' if wide else 'bigint'}) - ({f'{low}BD' if wide else f'{low}L'})"
        cell = F.expr(f"({base}) div {width}{'BD' if wide else 'L'}")
        inside = ids.where(F.col(name).between(low, high))
        counts = inside.groupBy(cell.cast("bigint").alias("cell")).agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
        for row in counts:
            if before + row.n > rank:
                break
            before += row.n
        low += row.cell * width
        if width == 1:
            return low, before
        high = min(high, low + width - 1)
