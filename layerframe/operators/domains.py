"""Coded-value domains: codes replaced by their names."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerframe.functions import variants as V
from layerframe.schema import fields_of


def _codes(domain: Mapping[str, Any]) -> list[tuple[Any, str]]:
    """Well-formed (code, name) pairs; codes without a name are left to pass through."""
    if domain.get("type") != "codedValue":
        return []
    listed = domain.get("codedValues")
    return [
        (cv["code"], cv["name"])
        for cv in (listed if isinstance(listed, list) else [])
        if isinstance(cv, Mapping) and "code" in cv and "name" in cv
    ]


def _is_number(code: Any) -> bool:
    return isinstance(code, (int, float)) and not isinstance(code, bool) and math.isfinite(code)


def _comparable(value: Column, kind: T.DataType) -> Column:
    """A code as its column compares it: whole numbers exactly, fractions as doubles, texts as texts.

    A code that is no number of the column's kind is null and equals nothing.
    """
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return value.try_cast("decimal(38,10)")
    return value.try_cast("double") if isinstance(kind, T.NumericType) else value.cast("string")


def _replace(rows: DataFrame, field: str, codes: DataFrame, on: Column) -> DataFrame:
    """Left join with at most one code a row, then the name instead of the value."""
    value = F.coalesce(F.col("_label"), F.col(f"`{field}`").cast("string")).alias(field)
    joined = rows.join(codes, on, "left")
    return joined.select(*(value if c == field else F.col(f"`{c}`") for c in rows.columns))


def resolve_domains(df: DataFrame, fields: Iterable[Any]) -> DataFrame:
    """Replaces codes of ``codedValue`` domains by name in a layer's rows.

    Unknown codes, range domains, malformed domains and nameless codes pass through.
    A column that can hold both codes and names becomes STRING.  Of equal codes the
    last entry counts.  A domain is a left join without a hint, whatever its length.
    """
    for field in fields_of(fields):
        if field.name not in df.columns or not field.domain or not _codes(field.domain):
            continue
        kind = df.schema[field.name].dataType
        fits = _is_number if isinstance(kind, T.NumericType) else (lambda code: isinstance(code, str))
        listed = [(repr(c) if _is_number(c) else c, n) for c, n in _codes(field.domain) if fits(c)]
        table = pa.table(
            {
                "_text": pa.array([c for c, _ in listed], pa.string()),
                "_name": pa.array([None if n is None else str(n) for _, n in listed], pa.string()),
                "_pos": pa.array(range(len(listed)), pa.int64()),
            }
        )
        codes = df.sparkSession.createDataFrame(table).withColumn("_code", _comparable(F.col("_text"), kind))
        codes = codes.where("_code IS NOT NULL").groupBy("_code").agg(F.max_by("_name", "_pos").alias("_label"))
        df = _replace(df, field.name, codes, _comparable(F.col(f"`{field.name}`"), kind) == F.col("_code"))
    return df


def domain_codes(layer_fields: DataFrame) -> DataFrame:
    """(layer_url, name, code_kind, code, label, position) of every coded-value domain.

    ``code`` is text and ``code_kind`` says whether it was a number or a string;
    ``position`` is the entry's place, the last one's where a code is repeated.
    """
    domain = F.col("domain")
    coded = layer_fields.where(V.get(domain, "type", to="string") == "codedValue")
    entry = F.col("entry")
    code = V.get(entry, "code")
    return (
        coded.select("layer_url", "name", F.posexplode(V.elements(domain, "codedValues")).alias("_pos", "entry"))
        .where(V.is_object(entry) & V.has(entry, "code") & V.has(entry, "name"))
        .select(
            "layer_url",
            "name",
            F.when(V.kind(code) == "string", "string").otherwise("number").alias("code_kind"),
            V.text(code).alias("code"),
            V.text(V.get(entry, "name")).alias("label"),
            "_pos",
        )
        .groupBy("layer_url", "name", "code_kind", "code")
        .agg(F.max_by("label", "_pos").alias("label"), F.max("_pos").alias("position"))
    )


def resolve_domains_from(rows: DataFrame, codes: DataFrame, field: str) -> DataFrame:
    """As :func:`resolve_domains` for rows of many layers, codes held in a table.

    A left join on (layer, code) without a hint: small code tables are broadcast by
    the optimizer, and a layer or code holding most rows is split as join skew.  Codes
    that compare equal are reduced to one first, the last by ``position`` where the
    table has that, so that no row is ever multiplied.
    """
    kind = rows.schema[field].dataType
    numeric = isinstance(kind, T.NumericType)
    latest = F.struct(*(F.col(c) for c in ("position", "code", "label") if c in codes.columns))
    mine = (
        codes.where((F.col("name") == field) & (F.col("code_kind") == ("number" if numeric else "string")))
        .select(F.col("layer_url").alias("_url"), _comparable(F.col("code"), kind).alias("_code"), "label", latest.alias("_order"))
        .where("_code IS NOT NULL")
        .groupBy("_url", "_code")
        .agg(F.max_by("label", "_order").alias("_label"))
    )
    on = (F.col("layer_url") == F.col("_url")) & (_comparable(F.col(f"`{field}`"), kind) == F.col("_code"))
    return _replace(rows, field, mine, on)
