"""Field-set drift over arriving pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from layerframe.functions import variants as V
from layerframe.session import ship_package
from layerframe.sources.pages import features_of

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
OUTPUT = "context string, kind string, key string, at_page bigint"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _DriftProcessor(StatefulProcessor):
    """Per context: pages counted so far, and per key whether each kind was reported."""

    def __init__(self, learn_pages: int):
        self.learn_pages = learn_pages

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pages = handle.getValueState("pages", "n bigint")
        self.keys = handle.getMapState("keys", "key string", "appeared boolean, vanished boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        seen = self.pages.get()[0] if self.pages.exists() else 0
        known = {k[0]: [v[0], v[1]] for k, v in self.keys.iterator()} if self.keys.exists() else {}
        changed: set[str] = set()
        found: list[tuple] = []
        # One short row per page: its index and the distinct attribute keys.  Equal key sets
        # are held once, so what a layer's batch takes here is about a number a page.
        sets: dict[tuple, frozenset] = {}
        arrived = []
        for frame in rows:
            for page, names in zip(frame["page_index"], frame["keys"]):
                names = tuple(names)
                arrived.append((page, sets.setdefault(names, frozenset(names))))
        arrived.sort(key=lambda row: row[0])
        for page, present in arrived:
            if not present:
                continue
            for name in sorted(present - known.keys()):
                known[name] = [seen >= self.learn_pages, False]
                changed.add(name)
                if seen >= self.learn_pages:
                    found.append((key[0], "field_appeared", name, page))
            if seen >= self.learn_pages:
                for name in sorted(known.keys() - present):
                    if not known[name][1]:
                        known[name][1] = True
                        changed.add(name)
                        found.append((key[0], "field_disappeared", name, page))
            seen += 1
        self.pages.update((seen,))
        for name in changed:
            self.keys.updateValue((name,), tuple(known[name]))
        yield pd.DataFrame(found, columns=["context", "kind", "key", "at_page"])

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """The state store stateful processors need."""
    spark.conf.set(PROVIDER, ROCKSDB)


def stream_field_set_drift(scanned: DataFrame, learn_pages: int = 1) -> DataFrame:
    """Batch :func:`~layerframe.operators.quality.field_set_drift` over a stream of pages.

    Pages count in order of arrival, within a micro-batch by page index; the result is
    the batch one when pages arrive in order.  What reaches the state is one short row
    per page, never its features.
    """
    if learn_pages < 1:
        raise ValueError("drift needs at least one page to learn from")
    ship_package()
    # sorted, so that equal sets are equal arrays
    keys = F.array_distinct(
        F.flatten(
            F.transform(
                features_of(F.col("body")),
                lambda f: F.coalesce(
                    F.map_keys(V.entries(V.get(f, "attributes"))), F.array().cast("array<string>")
                ),
            )
        )
    )
    pages = scanned.where(F.col("status") == "ok").select(
        F.col("layer_url").alias("context"), "page_index", F.array_sort(keys).alias("keys")
    )
    return pages.groupBy("context").transformWithStateInPandas(
        statefulProcessor=_DriftProcessor(learn_pages),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None",
    )
