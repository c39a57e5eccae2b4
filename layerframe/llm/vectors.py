"""Usable vectors of a table, and one row for each distinct one.

A result of k neighbours, ties going to smaller ids, never needs more than the k + 1
smallest ids of equal vectors (one of them may be the query itself).  So equal vectors
are searched once, and however many rows share one vector, its row stays bounded.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HELD_VECTORS = 20_000


def finite(vector: Column) -> Column:
    """Whether a vector has components and all of them are finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, bad)


def distinct_vectors(rows: DataFrame, smallest: int) -> DataFrame:
    """(vec, ids) of rows (id, vec): the ``smallest`` smallest ids of each distinct vector, ascending, each once.

    Tasks first drop ids that are surely too large, so that what meets for one vector is
    at most a few ids from each task.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list[int]] = defaultdict(list)
        for batch in batches:
            column = batch.column("vec")
            starts = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False)
            keep = np.zeros(batch.num_rows, bool)
            if len(held) > _HELD_VECTORS:
                held.clear()
            for i, id_ in enumerate(batch.column("id").to_pylist()):
                known = held[values[starts[i] : starts[i + 1]].tobytes()]
                if id_ not in known and (len(known) < smallest or id_ < known[-1]):
                    keep[i] = True
                    known.append(id_)
                    known.sort()
                    del known[smallest:]
            yield batch.filter(pa.array(keep))

    kept = rows.select("id", "vec").mapInArrow(thin, rows.select("id", "vec").schema)
    ids = F.slice(F.sort_array(F.collect_set("id")), 1, smallest)
    return kept.groupBy("vec").agg(ids.alias("ids"))


def leading(order: np.ndarray, first: np.ndarray, own: int, k: int) -> list[int]:
    """Vectors, best first, until k different ids other than ``own`` come first in them.

    What follows has no id that could still be among the best k: an id may have several
    vectors, and the query's own any number of them.
    """
    taken, others = [], set()
    for i in order:
        taken.append(int(i))
        if first[i] != own:
            others.add(int(first[i]))
            if len(others) == k:
                break
    return taken


def matrix(column: pa.Array, dim: int, kind: type) -> np.ndarray:
    """Vectors as rows; shorter ones are continued with zeros."""
    starts, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(starts)
    if len(sizes) and (sizes == dim).all():
        return values[starts[0] : starts[-1]].reshape(-1, dim).astype(kind)
    out = np.zeros((len(sizes), dim), kind)
    for i, n in enumerate(sizes):
        out[i, :n] = values[starts[i] : starts[i + 1]]
    return out
