"""Reading a live layer: a page-partitioned Python data source.

``spark.read.format("feature_layer").options(url=..., where=...).load()``

The driver asks for metadata and the row count and plans runs of pages; executors
fetch and emit Arrow batches.  Comparisons that a service can evaluate narrow what it
sends; Spark applies them again to what arrives.

Options: ``url``, ``where``, ``outFields``, ``returnGeometry``, ``token``, ``timeout``,
``pageSize``, ``orderByFields`` (offset pages: the object id unless given), ``onTruncation`` (raise, ignore, split), ``numPartitions``, ``geometry``
, ``geometryType``, ``spatialRel`` and ``inSR`` (see
``layerframe.operators.spatial.filter_options``), ``output`` (rows, pages), ``transport``.  Raise
``numPartitions`` for services that allow more than a few requests at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from http.client import HTTPException
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from layerframe.errors import LayerError, ServiceError, TruncatedPageError
from layerframe.functions.urls import host_key
from layerframe.schema import fields_of
from layerframe.session import ship_package
from layerframe.sources.metadata import OID_KEYS, RECORD_CAP_KEY
from layerframe.sources.transport import HttpStatusError, form_text, resolve

PUSHDOWN_SETTING = "spark.sql.python.filterPushdown.enabled"
PAGES_SCHEMA = T.StructType([
    T.StructField("layer_url", T.StringType()),
    T.StructField("page_index", T.LongType()),
    T.StructField("payload", T.StringType()),
])
DEFAULT_PARTITIONS = 8  # tasks, and so requests in flight at once
IN_LIST_CAP = 1000
MAX_SPLIT_DEPTH = 32
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


# --- requests -------------------------------------------------------------------------


class _Service:
    """Requests of one layer; small enough to be shipped to every task."""

    def __init__(self, options: Mapping[str, str]):
        self.options = {k.lower(): v for k, v in options.items()}
        self.url = self.options.get("url", "").rstrip("/")
        if not re.search(r"[0-9]$", self.url):
            raise LayerError("option url must end with the layer's number")
        self.where = self.options.get("where") or "1=1"

    def ask(self, path: str, form: Mapping[str, Any]) -> dict:
        sent = {"f": "json", **{k: form_text(v) for k, v in form.items() if v is not None}}
        if "token" in self.options:
            sent["token"] = self.options["token"]
        fetch = resolve(self.options.get("transport"))
        try:
            answer = json.loads(fetch(self.url + path, sent, self.options))
        except HttpStatusError as error:
            raise ServiceError(str(error)) from error
        if not isinstance(answer, dict):
            raise ServiceError(f"{self.url}{path}: the answer is no JSON object")
        if isinstance(answer.get("error"), dict):
            error = answer["error"]
            raise ServiceError(f"{self.url}{path}: {error.get('message')} (code={error.get('code')})")
        return answer

    def metadata(self) -> dict:
        return self.ask("", {})

    def _filtered(self, where: str) -> dict:
        form: dict[str, Any] = {"where": where}
        # as ``layerframe.operators.spatial.filter_options`` writes them
        if "geometry" in self.options:
            form.update({k: self.options[k.lower()] for k in ("geometry", "geometryType", "spatialRel")})
            if "insr" in self.options:
                form["inSR"] = self.options["insr"]
        return form

    def count(self, where: str) -> int:
        answer = self.ask("/query", {**self._filtered(where), "returnCountOnly": True}).get("count")
        if not isinstance(answer, int) or isinstance(answer, bool):
            raise ServiceError(f"{self.url}: count is missing or not an integer")
        return answer

    def ids(self, where: str) -> list[int]:
        answer = self.ask("/query", {**self._filtered(where), "returnIdsOnly": True})
        return sorted(int(i) for i in answer.get("objectIds") or [])

    def id_range(self, oid: str, where: str) -> tuple[int, int]:
        wanted = [
            {"statisticType": kind, "onStatisticField": oid, "outStatisticFieldName": f"{kind}_id"}
            for kind in ("min", "max")
        ]
        answer = self.ask("/query", {**self._filtered(where), "outStatistics": wanted, "returnGeometry": False})
        row = answer["features"][0]["attributes"]
        found = {k.lower(): v for k, v in row.items()}
        return int(found["min_id"]), int(found["max_id"])

    def page(self, where: str, **more: Any) -> dict:
        return self.ask(
            "/query",
            {
                **self._filtered(where),
                "outFields": self.options.get("outfields", "*"),
                "returnGeometry": self.options.get("returngeometry", "true"),
                "orderByFields": self.options.get("orderbyfields"),
                **{k: v for k, v in more.items() if v is not None},
            },
        )


def _record_cap(metadata: Mapping[str, Any]) -> int:
    keys = [k for k, v in metadata.items() if v is not None and re.match(RECORD_CAP_KEY, k)]
    if len(keys) != 1:
        raise ServiceError("the layer declares no single record cap")
    return int(metadata[keys[0]])


def _object_id(metadata: Mapping[str, Any]) -> str | None:
    """As ``sources.metadata.object_id_field`` decides it for tables of documents."""
    declared = fields_of(f for f in metadata.get("fields") or () if isinstance(f, dict))
    oids = [f.name for f in declared if f.type == "OID"]
    if len(oids) > 1:
        raise ServiceError("ambiguous object id fields")
    if oids:
        return oids[0]
    unique = metadata.get("uniqueIdInfo")
    named = [v for k, v in metadata.items() if k.lower() in OID_KEYS and isinstance(v, str)]
    named += [unique["name"]] if isinstance(unique, dict) and isinstance(unique.get("name"), str) else []
    spelled = {f.name.lower(): f.name for f in declared}
    return spelled.get(named[0].lower(), named[0]) if named else None


def _explicit_paging(metadata: Mapping[str, Any]) -> bool:
    nested = metadata.get("advancedQueryCapabilities") or {}
    return nested.get("supportsPagination", metadata.get("supportsPagination")) is True


def _both(left: str, right: str) -> str:
    return right if left in ("", "1=1") else f"({left}) AND ({right})"


# --- partitions -------------------------------------------------------------------------


@dataclass(frozen=True)
class _Plan:
    """What every task needs to know about the layer."""

    where: str
    oid: str | None
    cap: int
    size: int
    total: int


@dataclass
class _Run(InputPartition):
    """A run of pages: offset pages [start, stop) or object ids [start, stop)."""

    plan: _Plan
    kind: str  # single, offset, oid
    start: int = 0
    stop: int = 0


def _runs(start: int, stop: int, parts: int, step: int = 1) -> list[tuple[int, int]]:
    """[start, stop) cut into at most ``parts`` runs that begin at multiples of ``step``."""
    steps = -(-(stop - start) // step)
    per = max(1, -(-steps // max(1, parts))) * step
    return [(at, min(at + per, stop)) for at in range(start, stop, per)]


class FeatureLayerReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: Mapping[str, str]):
        self.schema = schema
        self.service = _Service(options)
        self.where = self.service.where
        self.policy = self.service.options.get("ontruncation", "raise")
        if self.policy not in ("raise", "ignore", "split"):
            raise ValueError(f"onTruncation must be raise, ignore or split, got {self.policy!r}")
        self.as_pages = self.service.options.get("output", "rows") == "pages"

    def pushFilters(self, filters: list) -> Iterator:
        """Joins what the service can evaluate to the predicate.

        Every filter is handed back as well: services may compare text without regard
        to case, so Spark has the last word on what they return.
        """
        types = {f.name: f.dataType for f in self.schema.fields}
        for item in filters:
            text = None if self.as_pages else _predicate(item, types)
            if text is not None:
                self.where = _both(self.where, text)
            yield item

    def partitions(self) -> list[_Run]:
        metadata = self.service.metadata()
        if metadata.get("type") != "Feature Layer":
            raise LayerError("the url must point to a Feature Layer")
        cap, oid = _record_cap(metadata), _object_id(metadata)
        total = self.service.count(self.where)
        parts = int(self.service.options.get("numpartitions", DEFAULT_PARTITIONS))
        asked = int(self.service.options.get("pagesize", 0))
        size = min(asked, cap) if asked > 0 else cap
        factor = (metadata.get("advancedQueryCapabilities") or {}).get("maxRecordCountFactor")
        # Pages are never larger than the cap, so only a factor below 1 matters.
        if asked <= 0 and isinstance(factor, (int, float)) and 0 < factor < 1:
            size = max(1, int(cap * factor))
        plan = _Plan(self.where, oid, cap, size, total)
        if total <= cap:
            return [_Run(plan, "single")]
        if _explicit_paging(metadata):
            return [_Run(plan, "offset", a, b) for a, b in _runs(0, total, parts, size)]
        if oid is None:
            raise ServiceError("the layer has neither paging support nor an object id field")
        # Tasks list the ids of their own range, so no id list passes through the driver.
        low, high = self.service.id_range(oid, self.where)
        parts = min(parts, -(-total // cap))  # no more ranges than full requests
        return [_Run(plan, "oid", a, b) for a, b in _runs(low, high + 1, parts)]

    def read(self, partition: _Run) -> Iterator:
        from pyarrow import RecordBatch

        for index, page in self._pages(partition):
            if self.as_pages:
                columns = [[self.service.url], [index], [json.dumps(page)]]
            else:
                columns = _columns(page, self.schema)
            arrow = _arrow_schema(self.schema)
            yield RecordBatch.from_arrays(
                [_array(values, kind) for values, kind in zip(columns, arrow.types)], schema=arrow
            )

    def _pages(self, run: _Run) -> Iterator[tuple[int, dict]]:
        plan = run.plan
        if run.kind == "single":
            page = self.service.page(plan.where)
            if self._cut_off(page):
                pages = self._halved(plan, self.service.ids(plan.where), 0)
            else:
                pages = iter([page])
            yield from ((0, p) for p in pages)
        elif run.kind == "offset":
            for offset in range(run.start, run.stop, plan.size):
                for page in self._window(plan, offset, min(plan.size, plan.total - offset), 0):
                    yield offset // plan.size, page
        else:
            span = f"{plan.oid} >= {run.start} AND {plan.oid} < {run.stop}"
            ids = self.service.ids(_both(plan.where, span))
            for at in range(0, len(ids), plan.cap):
                for page in self._listed(plan, ids[at : at + plan.cap], 0):
                    yield run.start + at, page

    def _cut_off(self, page: dict) -> bool:
        if page.get("exceededTransferLimit") is not True:
            return False
        if self.policy == "raise":
            raise TruncatedPageError(f"{self.service.url}: exceededTransferLimit=true, rows are missing")
        return self.policy == "split"

    def _window(self, plan: _Plan, offset: int, count: int, depth: int) -> Iterator[dict]:
        """An offset page; cut off, its own window is halved, not the whole layer."""
        page = self.service.page(
            plan.where, resultOffset=offset, resultRecordCount=count,
            orderByFields=None if "orderbyfields" in self.service.options else plan.oid,
        )
        if not self._cut_off(page):
            yield page
            return
        self._deeper(count, depth)
        half = count // 2
        yield from self._window(plan, offset, half, depth + 1)
        yield from self._window(plan, offset + half, count - half, depth + 1)

    def _listed(self, plan: _Plan, ids: list[int], depth: int) -> Iterator[dict]:
        listed = ", ".join(map(str, ids))
        page = self.service.page(_both(plan.where, f"{plan.oid} In ({listed})"))
        if self._cut_off(page):
            yield from self._halved(plan, ids, depth)
        else:
            yield page

    def _halved(self, plan: _Plan, ids: list[int], depth: int) -> Iterator[dict]:
        self._deeper(len(ids), depth)
        half = len(ids) // 2
        for part in (ids[:half], ids[half:]):
            for at in range(0, len(part), IN_LIST_CAP):
                yield from self._listed(plan, part[at : at + IN_LIST_CAP], depth + 1)

    def _deeper(self, size: int, depth: int) -> None:
        if size <= 1 or depth >= MAX_SPLIT_DEPTH:
            raise TruncatedPageError(f"{self.service.url}: a truncated page cannot be split further")


class FeatureLayerSource(DataSource):
    """``format("feature_layer")``: rows typed by the layer's fields, geometry as JSON text."""

    @classmethod
    def name(cls) -> str:
        return "feature_layer"

    def schema(self) -> T.StructType:
        service = _Service(self.options)
        if service.options.get("output") == "pages":
            return PAGES_SCHEMA
        declared = fields_of(service.metadata().get("fields") or ())
        wanted = [n.strip() for n in service.options.get("outfields", "*").split(",")]
        if wanted != ["*"]:
            declared = [f for f in declared if f.name in wanted]
        columns = [T.StructField(f.name, f.spark_type) for f in declared]
        if service.options.get("returngeometry", "true").lower() != "false":
            columns.append(T.StructField("geometry", T.StringType()))
        return T.StructType(columns)

    def reader(self, schema: T.StructType) -> FeatureLayerReader:
        return FeatureLayerReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets filters reach it."""
    ship_package()
    spark.conf.set(PUSHDOWN_SETTING, "true")
    spark.dataSource.register(FeatureLayerSource)


# --- predicates ----------------------------------------------------------------------------

_COMPARISONS = {
    EqualTo: "=",
    GreaterThan: ">",
    GreaterThanOrEqual: ">=",
    LessThan: "<",
    LessThanOrEqual: "<=",
}


def _literal(value: Any) -> str | None:
    if isinstance(value, bool):
        return None
    if isinstance(value, (int, float)):
        return repr(value)
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return None  # dates differ between services; Spark compares them


def _predicate(item: Any, types: Mapping[str, T.DataType]) -> str | None:
    """SQL text of a pushed filter, or null when only Spark should apply it."""
    attribute = getattr(item, "attribute", ())
    if len(attribute) != 1 or attribute[0] not in types or attribute[0] == "geometry":
        return None
    name, kind = attribute[0], types[attribute[0]]
    if not isinstance(kind, (T.NumericType, T.StringType)):
        return None
    if isinstance(item, IsNull):
        return f"{name} IS NULL"
    if isinstance(item, IsNotNull):
        return f"{name} IS NOT NULL"
    if isinstance(item, In):
        listed = [_literal(v) for v in item.value]
        if not listed or len(listed) > IN_LIST_CAP or None in listed:
            return None
        return f"{name} IN ({', '.join(listed)})"
    value = _literal(getattr(item, "value", None))
    if value is None:
        return None
    for kind_of, sign in _COMPARISONS.items():
        if isinstance(kind, T.StringType) and sign != "=":
            continue  # text order depends on the service's collation
        if type(item) is kind_of:
            return f"{name} {sign} {value}"
    for kind_of, shape in ((StringStartsWith, "{}%"), (StringEndsWith, "%{}"), (StringContains, "%{}%")):
        if type(item) is kind_of and not re.search(r"[%_\\]", item.value):
            return f"{name} LIKE " + _literal(shape.format(item.value))
    return None


# --- values --------------------------------------------------------------------------------------


def _arrow_schema(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _array(values: list, kind):
    from pyarrow import array

    return array(values, type=kind)


def _columns(page: Mapping[str, Any], schema: T.StructType) -> list[list]:
    """Column-wise values of a page's feature objects."""
    features = [f for f in page.get("features") or [] if isinstance(f, dict)]
    columns = []
    for field in schema.fields:
        if field.name == "geometry":
            columns.append([None if f.get("geometry") is None else json.dumps(f["geometry"]) for f in features])
            continue
        convert = _converter(field.dataType)
        columns.append([convert(_attribute(f, field.name)) for f in features])
    return columns


def _attribute(feature: Mapping[str, Any], name: str) -> Any:
    attributes = feature.get("attributes")
    return attributes.get(name) if isinstance(attributes, dict) else None


def _converter(kind: T.DataType):
    def as_int(value):
        try:
            return None if value is None else int(value)
        except (TypeError, ValueError, OverflowError):
            return None

    def as_float(value):
        try:
            return None if value is None else float(value)
        except (TypeError, ValueError):
            return None

    def as_time(value):
        ms = as_int(value)
        try:
            return None if ms is None else _EPOCH + timedelta(milliseconds=ms)
        except OverflowError:
            return None

    def as_date(value):
        try:
            return date.fromisoformat(value)
        except (TypeError, ValueError):
            return None

    def as_text(value):
        return value if value is None or isinstance(value, str) else json.dumps(value)

    if isinstance(kind, T.IntegralType):
        return as_int
    if isinstance(kind, T.FractionalType):
        return as_float
    if isinstance(kind, T.TimestampType):
        return as_time
    return as_date if isinstance(kind, T.DateType) else as_text


# --- tables of requests ------------------------------------------------------------------------------


def _post(options: Mapping[str, str], url: str, form: Mapping[str, Any]) -> tuple[int | None, str | None]:
    """(status, payload) of one request; no payload, and perhaps no status, where it failed."""
    fetch = resolve(options.get("transport"))
    sent = {"f": "json", **{k: form_text(v) for k, v in form.items() if v is not None}}
    if "token" in options:
        sent["token"] = options["token"]
    try:
        return 200, fetch(url, sent, options)
    except HttpStatusError as error:
        return error.status, None
    except (OSError, HTTPException, UnicodeError):
        # no answer, a broken one, or one that is no text
        return None, None


def _dealt(requests: DataFrame, url: str, tasks_per_host: int) -> DataFrame:
    """Requests of one host in at most ``tasks_per_host`` tasks."""
    return requests.repartition(host_key(F.col(url)), F.pmod(F.xxhash64(*requests.columns), F.lit(tasks_per_host)))


def _asked(requests: DataFrame, options: Mapping[str, str], tasks_per_host: int, url: str, form: Callable[[dict], tuple[str, dict]]) -> DataFrame:
    """The requests with the ``http`` status and ``payload`` of each; a failed one never fails the job."""
    import pyarrow as pa

    def load(batches):
        for batch in batches:
            answers = [_post(options, *form(row)) for row in batch.to_pylist()]
            columns = [pa.array([a[0] for a in answers], pa.int32()), pa.array([a[1] for a in answers], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "http", "payload"])

    ship_package()
    schema = T.StructType([*requests.schema.fields, T.StructField("http", T.IntegerType()), T.StructField("payload", T.StringType())])
    return _dealt(requests, url, tasks_per_host).mapInArrow(load, schema)


def fetch_documents(urls: DataFrame, options: Mapping[str, str] | None = None, tasks_per_host: int = 4) -> DataFrame:
    """Metadata documents of a table of urls: (url, status, payload), one per url.

    Urls of one host share at most ``tasks_per_host`` tasks; a failed request is a row
    with its status or without a payload, never a failed job.
    """
    options = {k.lower(): v for k, v in (options or {}).items()}
    asked = _asked(urls.select("url").distinct(), options, tasks_per_host, "url", lambda row: (row["url"], {}))
    return asked.select("url", F.col("http").alias("status"), "payload")


def fetch_counts(urls: DataFrame, options: Mapping[str, str] | None = None, tasks_per_host: int = 4, where: str = "1=1") -> DataFrame:
    """Count envelopes of a table of layer urls: (url, status, payload), as :func:`fetch_documents` gives documents."""
    options = {k.lower(): v for k, v in (options or {}).items()}
    form = {"where": where, "returnCountOnly": True}
    asked = _asked(urls.select("url").distinct(), options, tasks_per_host, "url", lambda row: (row["url"] + "/query", form))
    return asked.select("url", F.col("http").alias("status"), "payload")


def fetch_answers(options: Mapping[str, str] | None = None, tasks_per_host: int = 4) -> Callable[[DataFrame], DataFrame]:
    """An answer function for ``plans.execute.read_layers`` that asks the services themselves.

    Options as for the format, but for what a request states: outFields, returnGeometry,
    token, timeout and transport.  A request that got no usable answer is a row whose
    ``status`` is ``http_error`` or ``no_response``.
    """
    from layerframe.plans.execute import shaped_answers
    from layerframe.plans.paging import in_list
    from layerframe.sources.pages import scan_pages

    options = {k.lower(): v for k, v in (options or {}).items()}

    def form(row: dict) -> tuple[str, dict]:
        return row["layer_url"] + "/query", {
            "where": row["where"] or "1=1",
            "outFields": options.get("outfields", "*"),
            "returnGeometry": options.get("returngeometry", "true"),
            "resultOffset": row["offset"],
            "resultRecordCount": row["count"],
            "orderByFields": row["order_by"],
        }

    def answer(requests: DataFrame) -> DataFrame:
        # a request split off a larger one lists what is left of its ids
        split = (F.col("depth") > 0) & F.col("oids").isNotNull()
        sent = requests.withColumn("where", F.when(split, in_list(F.col("object_id_field"), F.col("oids"))).otherwise(F.col("where")))
        asked = scan_pages(_asked(sent, options, tasks_per_host, "layer_url", form))
        failed = F.when(F.col("http").isNull(), "no_response").when(F.col("http") >= 400, "http_error")
        why = F.struct(F.col("http").cast("bigint").alias("code"), F.concat(F.lit("status "), F.coalesce(F.col("http").cast("string"), F.lit("none"))).alias("message"))
        return shaped_answers(
            asked.withColumn("error", F.when(failed.isNotNull(), why).otherwise(F.col("error"))).withColumn("status", F.coalesce(failed, "status"))
        )

    return answer
