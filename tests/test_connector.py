"""The connector's planning and reading, driven in this process."""

import fake_service
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringContains

from layerframe.operators.spatial import filter_options
from layerframe.errors import LayerError, ServiceError, TruncatedPageError
from layerframe.sources.connector import FeatureLayerReader, FeatureLayerSource, fetch_documents

URL = "https://maps.example.com/rest/services/A/FeatureServer/0"


def read(**options):
    source = FeatureLayerSource({"url": URL, "transport": "fake_service:fetch", **options})
    reader = FeatureLayerReader(source.schema(), dict(source.options))
    parts = reader.partitions()
    return parts, [row for part in parts for batch in reader.read(part) for row in batch.to_pylist()]


@pytest.fixture(autouse=True)
def service(monkeypatch):
    for key, value in {"rows": 57, "cap": 10, "paging": True, "serves": 10, "log": []}.items():
        monkeypatch.setitem(fake_service.STATE, key, value)
    return fake_service.STATE


@pytest.mark.parametrize("parts", ["1", "3", "200"])
@pytest.mark.parametrize("paging", [True, False])
def test_every_row_once(service, parts, paging):
    service["paging"] = paging
    planned, rows = read(numPartitions=parts)
    assert sorted(r["OID"] for r in rows) == list(range(100, 157))
    assert len(planned) <= max(int(parts), 1) or int(parts) == 200
    assert rows[0]["NAME"] == f"n{rows[0]['OID']}" and rows[0]["AT"].timestamp() == rows[0]["OID"]


def test_small_layers_take_one_request(service):
    service["rows"] = 8
    planned, rows = read()
    assert [p.kind for p in planned] == ["single"] and len(rows) == 8


@pytest.mark.parametrize("paging", [True, False])
def test_truncation(service, paging):
    service.update(paging=paging, serves=4)
    with pytest.raises(TruncatedPageError):
        read()
    assert len(read(onTruncation="ignore")[1]) < 57
    assert sorted(r["OID"] for r in read(onTruncation="split")[1]) == list(range(100, 157))
    service["serves"] = 0
    with pytest.raises(TruncatedPageError):
        read(onTruncation="split")


def test_page_output_and_sizes(service):
    _, pages = read(output="pages", pageSize="7")
    assert len(pages) == 9 and {p["layer_url"] for p in pages} == {URL}


def test_filters_narrow_the_request_and_stay_with_spark(service):
    source = FeatureLayerSource({"url": URL, "transport": "fake_service:fetch", "where": "A = 1 OR B = 2"})
    reader = FeatureLayerReader(source.schema(), dict(source.options))
    filters = [EqualTo(("NAME",), "it's"), GreaterThan(("OID",), 5), In(("OID",), (1, 2)), StringContains(("NAME",), "50%"), GreaterThan(("NAME",), "a")]
    assert list(reader.pushFilters(filters)) == filters
    assert reader.where == "(((A = 1 OR B = 2) AND (NAME = 'it''s')) AND (OID > 5)) AND (OID IN (1, 2))"


def test_spatial_and_token_parameters(service):
    read(**filter_options({"type": "Point", "coordinates": [1, 2]}, 4326), token="secret", outFields="OID", returnGeometry="false")
    form = service["log"][-1][1]
    assert form["geometryType"] == "esriGeometryPoint" and form["inSR"] == "4326" and form["geometry"] == '{"x": 1, "y": 2}'
    assert form["token"] == "secret" and form["outFields"] == "OID"


def test_bad_options():
    with pytest.raises(LayerError):
        read(url="https://maps.example.com/rest/services/A/FeatureServer")
    with pytest.raises(ValueError):
        read(onTruncation="drop")


def test_callers_sort_reaches_the_service(service):
    read(orderByFields="NAME DESC")
    sent = [form for _, form in service["log"] if "resultOffset" in form]
    assert sent and {form["orderByFields"] for form in sent} == {"NAME DESC"}
    service["log"].clear()
    read()
    assert {form["orderByFields"] for _, form in service["log"] if "resultOffset" in form} == {"OID"}


@pytest.mark.parametrize(
    ("metadata", "name"),
    [
        ({"fields": [{"name": "OID", "type": "esriFieldTypeOID"}]}, "OID"),
        ({"fields": [{"name": "ObjectId", "type": "x"}], "objectIdField": "OBJECTID"}, "ObjectId"),
        ({"fields": [], "objectidfieldname": "FID"}, "FID"),
        ({"fields": ["junk", {"name": "gid"}], "uniqueIdInfo": {"name": "GID"}}, "gid"),
        ({"uniqueIdInfo": "junk"}, None),
    ],
)
def test_one_rule_for_the_object_id(spark, metadata, name):
    import json

    from layerframe.sources.connector import _object_id
    from layerframe.sources.metadata import scan_metadata

    assert _object_id(metadata) == name
    document = spark.createDataFrame([("u/0", 200, json.dumps(metadata))], "url string, status int, payload string")
    assert scan_metadata(document).first().object_id_field == name


def test_several_object_ids_are_an_error():
    from layerframe.sources.connector import _object_id

    with pytest.raises(ServiceError, match="ambiguous"):
        _object_id({"fields": [{"name": n, "type": "esriFieldTypeOID"} for n in "ab"]})


def test_failed_documents_are_rows(spark):
    import fake_service as module

    spark.sparkContext.addPyFile(module.__file__)
    urls = spark.createDataFrame([("https://a.example.com/broken/x",), ("https://a.example.com/broken/x",), ("https://b.example.com/y/0",)], "url string")
    found = {r.url: r for r in fetch_documents(urls, {"transport": "fake_service:fetch"}).collect()}
    assert len(found) == 2
    assert (found["https://a.example.com/broken/x"].status, found["https://a.example.com/broken/x"].payload) == (None, None)
    assert found["https://b.example.com/y/0"].status == 200 and "maxRecordCount" in found["https://b.example.com/y/0"].payload
