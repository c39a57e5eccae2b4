"""Layer fields and their Spark types."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from layerframe.functions import dates
from layerframe.functions import variants as V

TYPE_PREFIX = "esriFieldType"

# Spark type of each field type name (prefix stripped).  Anything
# else is read as text.
SPARK_TYPES: dict[str, T.DataType] = {
    "OID": T.LongType(),
    "SmallInteger": T.ShortType(),
    "Integer": T.IntegerType(),
    "BigInteger": T.LongType(),
    "Single": T.FloatType(),
    "Double": T.DoubleType(),
    "String": T.StringType(),
    "GlobalID": T.StringType(),
    "GUID": T.StringType(),
    "Date": T.TimestampType(),
    "DateOnly": T.DateType(),
    "TimeOnly": T.StringType(),
    "TimestampOffset": T.StringType(),
}


@dataclass(frozen=True)
class Field:
    """One declared field of a layer; ``type`` has the prefix stripped."""

    name: str
    type: str = ""
    domain: Mapping[str, Any] | None = None

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES.get(self.type, T.StringType())

    def read(self, attributes: Column) -> Column:
        """The typed value of this field in a VARIANT attributes object."""
        if self.type == "Date":
            return dates.to_timestamp(V.get(attributes, self.name, to="bigint"))
        if self.type == "DateOnly":
            return V.get(attributes, self.name, to="string").try_cast("date")
        return V.get(attributes, self.name, to=self.spark_type.simpleString())


def fields_of(specs: Iterable[Any]) -> list[Field]:
    """Fields from a metadata document's ``fields`` list; nameless ones are dropped."""
    found = []
    for spec in specs or ():
        if isinstance(spec, Field):
            found.append(spec)
        elif isinstance(spec, Mapping) and isinstance(spec.get("name"), str):
            domain = spec.get("domain")
            found.append(
                Field(
                    spec["name"],
                    str(spec.get("type") or "").replace(TYPE_PREFIX, ""),
                    domain if isinstance(domain, Mapping) else None,
                )
            )
    return found


def struct_type(fields: Iterable[Any]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.spark_type) for f in fields_of(fields)])
