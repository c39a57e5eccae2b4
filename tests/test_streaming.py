"""Streams over several micro-batches and restarts."""

import json
import random

import pytest

from layerframe.operators.quality import field_set_drift, page_keys
from layerframe.session import setting
from layerframe.sources.pages import scan_features, scan_pages
from layerframe.streaming.drift import stream_field_set_drift, use_rocksdb
from layerframe.streaming.pages import stream_page_table, stream_pages, write_stream
from layerframe.workload import quality

SCHEMA = "layer_url string, page_index bigint, payload string"


def test_drift_over_batches_equals_batch(spark, tmp_path):
    rng = random.Random(3)
    landing = str(tmp_path / "landing")
    rows = []
    for batch in range(3):
        # Pages arrive in order; one of the layers skips a batch.
        mine = [
            (f"u/{u}", batch * 4 + p, json.dumps({"features": [{"attributes": {k: 1 for k in "abcd" if rng.random() < 0.6}}]}))
            for u in range(3) for p in range(4) if (u, batch) != (1, 1)
        ]
        rows += mine
        spark.createDataFrame(mine, SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    use_rocksdb(spark)
    found = stream_field_set_drift(stream_page_table(spark, landing, max_files=1), learn_pages=2)
    with setting(spark, "spark.sql.shuffle.partitions", "2"):
        write_stream(found, str(tmp_path / "sink"), str(tmp_path / "log")).awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(str(tmp_path / "sink")).select("context", "kind", "key", "at_page").collect()}
    batch = field_set_drift(page_keys(scan_pages(spark.createDataFrame(rows, SCHEMA))), learn_pages=2)
    assert streamed == {tuple(r) for r in batch.select("context", "kind", "key", "at_page").collect()}
    assert streamed
    with pytest.raises(ValueError):
        stream_field_set_drift(stream_page_table(spark, landing), 0)


def test_landed_files_are_read_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    sink, log = str(tmp_path / "sink"), str(tmp_path / "log")

    def run():
        found = scan_features(stream_pages(spark, str(landing), "u/0", max_files=1)).select("page_index", "pos")
        write_stream(found, sink, log).awaitTermination()
        return sorted(r.page_index for r in spark.read.parquet(sink).collect())

    for i in (1, 2):
        (landing / f"page-{i}.json").write_text(json.dumps({"features": [{"attributes": {}}, 7]}))
    assert run() == [1, 2]
    (landing / "page-3.json").write_text(json.dumps({"features": [{"attributes": {}}]}))
    assert run() == [1, 2, 3]


def test_batches_do_not_grow_with_the_files(spark, sf_dir, monkeypatch):
    started = []
    monkeypatch.setattr(quality, "write_stream", lambda *given: started.append(write_stream(*given)) or started[-1])
    small = "spark.sql.adaptive.coalescePartitions.minPartitionSize", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    with setting(spark, small[0], "1b"), setting(spark, small[1], "1b"):  # a file for each partition
        quality.stream_field_set_drift_query(spark, sf_dir)
    batches = sum(p.numInputRows > 0 for p in started[0].recentProgress)
    assert 2 <= batches <= 4
