"""A feature layer as an immutable, lazily refined DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerframe.errors import LayerError, MissingFieldError
from layerframe.operators.domains import resolve_domains
from layerframe.operators.spatial import spatial_filter
from layerframe.plans.rank import id_at_rank, with_rank
from layerframe.schema import Field, fields_of

ALL_ROWS = "1=1"


def _as_text(value: Any, kind: T.DataType) -> str | None:
    """A value as text that casts to ``kind``; whole floats count as integers."""
    if value is None:
        return None
    if isinstance(value, float) and value.is_integer() and isinstance(kind, T.IntegralType):
        value = int(value)
    return str(value)


def quoted(name: str) -> str:
    """A field name as a reference to the column of that very name, dots and all."""
    return f"`{name.replace('`', '``')}`"


def column(name: str) -> Column:
    return F.col(quoted(name))


class Layer:
    """Rows of one layer with its object id field, declared fields and predicate."""

    def __init__(
        self,
        df: DataFrame,
        object_id_field: str | None = None,
        fields: Iterable[Field | Mapping[str, Any]] = (),
        where: str | Column = ALL_ROWS,
        geometry: str = "geometry",
    ):
        self._base = df
        self.object_id_field = object_id_field
        self.fields = fields_of(fields)
        self.geometry = geometry
        self.df = df if isinstance(where, str) and where.strip() in ("", ALL_ROWS) else df.where(where)

    def _with(self, df: DataFrame) -> Layer:
        return Layer(df, self.object_id_field, self.fields, geometry=self.geometry)

    # --- schema -------------------------------------------------------------------

    @property
    def field_names(self) -> list[str]:
        return self.df.columns

    def check_fields(self, fields: str | Sequence[str]) -> list[str]:
        """The names as a list; raises for any the layer does not have."""
        names = [fields] if isinstance(fields, str) else list(fields)
        missing = [n for n in names if n not in self.df.columns]
        if missing:
            raise MissingFieldError(missing, self.df.columns)
        return names

    def _oid(self) -> str:
        if not self.object_id_field:
            raise LayerError("the layer has no object id field")
        return self.object_id_field

    # --- projection and predicates ---------------------------------------------------

    def out_fields(self, fields: str | Sequence[str] = "*") -> Layer:
        """Comma list, sequence or ``*``."""
        if isinstance(fields, str):
            fields = [f.strip() for f in fields.split(",")]
        if list(fields) == ["*"]:
            return self
        return self._with(self.df.select(*map(column, self.check_fields(fields))))

    def drop_geometry(self) -> Layer:
        return self._with(self.df.drop(self.geometry))

    def where(self, predicate: str | Column) -> Layer:
        """Both the present predicate and this one hold, however either is written."""
        if isinstance(predicate, str) and predicate.strip() in ("", ALL_ROWS):
            return self
        return self._with(self.df.where(predicate))

    def where_in(self, field: str, values: Iterable[Any] | DataFrame) -> Layer:
        """Rows whose field is among the values; no values, no rows.

        Values come as a list or as the first column of a DataFrame.  Either way they are
        cast to the field's type, one that cannot be cast matches nothing, and rows are
        kept by a left semi join without a hint, so the optimizer decides by size.
        """
        self.check_fields(field)
        kind = self.df.schema[field].dataType
        if not isinstance(values, DataFrame):
            texts = pa.array([_as_text(v, kind) for v in values], pa.string())
            values = self.df.sparkSession.createDataFrame(pa.table({"_wanted": texts}))
        wanted = values.select(column(values.columns[0]).try_cast(kind).alias("_wanted"))
        return self._with(self.df.join(wanted, column(field) == F.col("_wanted"), "left_semi"))

    def spatial_filter(self, geometry: Mapping, in_sr=None, relation: str = "intersects") -> Layer:
        return self._with(spatial_filter(self.df, self.geometry, geometry, in_sr, relation))

    # --- summaries -----------------------------------------------------------------------

    def feature_count(self, by: Sequence[str] = ()) -> DataFrame:
        return self.df.groupBy(*by).agg(F.count(F.lit(1)).alias("feature_count"))

    def count(self) -> int:
        return self.df.count()

    def object_ids(self) -> DataFrame:
        """All object ids, ascending."""
        oid = self._oid()
        return self.df.select(column(oid)).orderBy(column(oid))

    def unique_values(self, fields: str | Sequence[str], sortby: str | None = None) -> DataFrame:
        """Distinct values or combinations, nulls kept and sorted last."""
        names = self.check_fields(fields)
        found = self.df.select(*map(column, names)).distinct()
        if sortby is None or (len(names) == 1 and sortby != names[0]):
            return found
        if sortby not in names:
            raise MissingFieldError([sortby], names)
        return found.orderBy(column(sortby).asc_nulls_last())

    def value_counts(self, field: str) -> DataFrame:
        """``field, field_count``, largest first.  The null group counts 0."""
        self.check_fields(field)
        counted = f"{field}_count"
        return (
            self.df.groupBy(column(field))
            .agg(F.count(column(field)).alias(counted))
            .orderBy(column(counted).desc(), column(field).asc_nulls_last())
        )

    def nested_count(self, fields: Sequence[str]) -> DataFrame:
        """``f0, f1, Count`` for exactly two fields."""
        names = [fields] if isinstance(fields, str) else list(fields)
        if len(names) != 2:
            raise ValueError(f"nested_count needs exactly two fields, got {names!r}")
        first, second = self.check_fields(names)
        return (
            self.df.groupBy(column(first), column(second))
            .agg(F.count(column(second)).alias("Count"))
            .orderBy(column(first).asc_nulls_last(), F.desc("Count"), column(second).asc_nulls_last())
        )

    # --- order, slices, samples -----------------------------------------------------------

    def order_by_oid(self, order_by: str | Sequence[str] | None = None) -> Layer:
        """The caller's sort if given, else by object id; unsorted without either."""
        if order_by:
            keys = [order_by] if isinstance(order_by, str) else list(order_by)
            return self._with(self.df.orderBy(*map(column, keys)))
        if not self.object_id_field:
            return self
        return self._with(self.df.orderBy(column(self.object_id_field)))

    def page_slice(self, offset: int, count: int) -> Layer:
        """Rows ``offset`` to ``offset + count`` in object id order, and in that order.

        The ids at both ends are looked for first, on the id column alone, so the slice is a
        range filter that reaches the scan; nothing is sorted but the slice, and nothing
        written.  Layers whose ids are no whole numbers, or partly null, are ranked instead.
        """
        oid = self._oid()
        ids = self.df.select(column(oid).alias("_id"))
        if not isinstance(ids.schema["_id"].dataType, T.IntegralType):
            return self._ranked_slice(oid, offset, count)
        n, held, low, high = ids.agg(F.count(F.lit(1)), F.count("_id"), F.min("_id"), F.max("_id")).first()
        if held < n:
            return self._ranked_slice(oid, offset, count)
        offset, last = max(0, offset), min(offset + count, n) - 1
        if last < offset:
            return self._with(self.df.limit(0))
        first_id, before = id_at_rank(ids, "_id", offset, low, high)
        last_id, before_last = id_at_rank(ids, "_id", last, first_id, high, before)
        kept = self.df.where(column(oid).between(first_id, last_id)).orderBy(column(oid))
        if before < offset or last_id == first_id:
            # rows that share the first id, some of them before the slice
            return self._with(kept.offset(offset - before).limit(last - offset + 1))
        at_last = ids.where(F.col("_id") == last_id).count()
        return self._with(kept if before_last + at_last == last + 1 else kept.limit(last - offset + 1))

    def _ranked_slice(self, oid: str, offset: int, count: int) -> Layer:
        ranked = with_rank(self.df, [oid], name="_rank")
        kept = (F.col("_rank") >= offset) & (F.col("_rank") < offset + count)
        return self._with(ranked.where(kept).orderBy("_rank").drop("_rank"))

    def head(self, n: int = 10) -> Layer:
        return self._with(self.df.orderBy(column(self._oid())).limit(n))

    def sample(self, n: int = 10, seed: int = 0) -> Layer:
        """``min(n, rows)`` rows without replacement; the same seed gives the same rows."""
        oid = self._oid()
        draw = F.md5(F.concat(F.lit(f"{seed}:"), column(oid).cast("string")))
        return self._with(self.df.orderBy(draw, column(oid)).limit(n))

    # --- whole layer ---------------------------------------------------------------------------

    def to_df(self, domains: bool = False) -> DataFrame:
        """The distributed table, optionally with coded values replaced by their names."""
        return resolve_domains(self.df, self.fields) if domains else self.df
