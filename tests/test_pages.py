"""Pages, features, rows, envelopes and drift on hand-written documents."""

import contextlib
import io
import json

import pytest
from pyspark.sql import functions as F

from layerframe.errors import TruncatedPageError
from layerframe.functions import variants as V
from layerframe.operators.domains import resolve_domains, resolve_domains_from
from layerframe.operators.normalize import normalize_features
from layerframe.operators.quality import drift_report, field_set_drift, page_keys, strict_counts, strict_ids
from layerframe.operators.union import union_chunks
from layerframe.plans.paging import apply_truncation_policy, emit_order, truncation_report
from layerframe.sources.pages import (
    feature_to_row,
    quarantined_pages,
    read_pages,
    require_complete,
    scan_feature_batches,
    scan_features,
    scan_pages,
    scan_rows,
)


def pages(spark, *payloads):
    rows = [("u/0", i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return scan_pages(spark.createDataFrame(rows, "layer_url string, page_index bigint, payload string"))


def test_quarantine_keeps_every_page(spark):
    scanned = pages(spark, {"features": []}, "[1]", "<html>", {"error": {"code": 498, "message": "Invalid token"}}, '{"a": NaN}')
    assert [r.status for r in scanned.orderBy("page_index").collect()] == ["ok", "not_object", "not_json", "service_error", "not_json"]
    bad = {r.page_index: (r.code, r.message) for r in quarantined_pages(scanned).collect()}
    assert set(bad) == {1, 2, 3, 4} and bad[3] == (498, "Invalid token")


def test_pages_from_files(spark, tmp_path):
    for i in (0, 12):
        (tmp_path / f"page-{i}.json").write_text(json.dumps({"features": [{"attributes": {"A": i}}]}, indent=1))
    scanned = scan_pages(read_pages(spark, str(tmp_path), "u/0"))
    found = scan_features(scanned).select("page_index", V.get(F.col("attributes"), "A", to="int").alias("a")).collect()
    assert sorted(tuple(r) for r in found) == [(0, 0), (12, 12)]


def test_missing_features_are_an_empty_page(spark):
    scanned = pages(spark, {}, {"features": None}, {"features": [1, None, {"attributes": {"A": 1}}]})
    assert [r.n_features for r in scan_feature_batches(scanned).orderBy("page_index").collect()] == [0, 0, 1]
    assert scan_features(scanned).count() == 1


def test_row_flattening(spark):
    features = [
        {"attributes": {"OBJECTID": 1, "geometry": "attr", "id": None}, "geometry": {"x": 1}, "id": "top"},
        {"attributes": None, "geometry": None, "id": "top"},
        {"attributes": {"geometry": "attr"}},
        {"id": 5},
    ]
    found = scan_features(pages(spark, {"features": features})).orderBy("pos")
    rows = [json.loads(r[0]) for r in found.select(F.to_json(feature_to_row(F.col("feature")))).collect()]
    assert rows == [
        {"OBJECTID": 1, "geometry": {"x": 1}, "id": None},
        {"geometry": None, "id": "top"},
        {"geometry": "attr"},
        {"id": 5},
    ]
    typed = scan_rows(found, [{"name": "OBJECTID", "type": "esriFieldTypeOID"}], extras=["id"])
    assert [(r.OBJECTID, r.id) for r in typed.orderBy("pos").collect()] == [(1, None), (None, "top"), (None, None), (None, "5")]


def test_typed_fields(spark):
    fields = [
        {"name": "BIG", "type": "esriFieldTypeBigInteger"}, {"name": "D", "type": "esriFieldTypeDateOnly"},
        {"name": "T", "type": "esriFieldTypeTimeOnly"}, {"name": "S", "type": "esriFieldTypeSmallInteger"}, {"name": "X"}, {"type": "esriFieldTypeOID"},
        {"name": "WHEN", "type": "esriFieldTypeDate"},
    ]
    page = {"features": [{"attributes": {"BIG": 9007199254740993, "D": "2025-01-15", "T": "10:30:00", "S": 70000, "X": {"a": 1}, "WHEN": 0}}]}
    rows = scan_rows(scan_features(pages(spark, page)), fields, geometry=False)
    row = rows.select("BIG", F.col("D").cast("string"), "T", "S", "X", F.unix_millis("WHEN").alias("w")).first()
    assert tuple(row) == (9007199254740993, "2025-01-15", "10:30:00", None, '{"a":1}', 0)


def test_normalized_dates_leave_other_attributes(spark):
    page = {
        "objectIdFieldName": "ID",
        "fields": [{"name": "ID", "type": "esriFieldTypeOID"}, {"name": "D", "type": "esriFieldTypeDate"}],
        "features": [{"attributes": {"ID": "7", "D": 0, "N": 1.5}}, {"attributes": {"ID": 1.9, "D": "x"}}, {"attributes": {"ID": "abc", "D": None}}, "junk"],
    }
    found = normalize_features(pages(spark, page), normalize_dates=True).orderBy("pos")
    rows = found.select("object_id", F.to_json("attributes").alias("a"), "geometry").collect()
    assert [r.object_id for r in rows] == [7, 1, None]
    assert json.loads(rows[0].a) == {"ID": "7", "D": "1970-01-01T00:00:00+00:00", "N": 1.5}
    assert json.loads(rows[1].a)["D"] == "x" and json.loads(rows[2].a)["D"] is None
    assert all(r.geometry is None for r in rows)


def test_truncation(spark):
    scanned = pages(spark, {"features": [{"attributes": {}}], "exceededTransferLimit": True}, {"features": [], "exceededTransferLimit": True}, {"features": []})
    assert sorted(tuple(r)[1:] for r in truncation_report(scanned).collect()) == [(0, 1, False), (1, 0, True)]
    assert apply_truncation_policy(scanned, "ignore").count() == 3
    with pytest.raises(Exception, match="exceededTransferLimit"):
        require_complete(scanned).select("page_index").collect()
    with pytest.raises(ValueError):
        apply_truncation_policy(scanned, "drop")
    with pytest.raises(ValueError):
        emit_order(scanned, "random")


def test_strict_envelopes(spark):
    rows = spark.createDataFrame([('{"count": 3}',), ('{"count": "x"}',), ("<html>",)], "payload string")
    good, bad = strict_counts(rows)
    assert [r.feature_count for r in good.collect()] == [3] and bad.count() == 2
    rows = spark.createDataFrame([('{"objectIdFieldName": "A", "objectIds": null}',), ('{"objectIdField": "A", "objectIds": [2147483649]}',), ('{"objectIds": []}',)], "payload string")
    good, bad = strict_ids(rows)
    assert sorted(r.object_ids for r in good.collect()) == [[], [2147483649]] and bad.count() == 1


def test_drift_report_counts_once_per_key(spark):
    rows = spark.createDataFrame([('{"id": "x", "zed": 1}',), ('{"id": "x", "zed": 2}',), ('{"zed": "t", "layers": [1]}',)], "payload string")
    found = sorted((r.path, r.kind, r.observed_type, r.sample) for r in drift_report(rows, "LayerMetadata").collect())
    assert found == [
        ("id", "bad_type", "str", '"x"'), ("layers.0", "bad_type", "int", "1"),
        ("zed", "unknown_extra", "int", "1"), ("zed", "unknown_extra", "str", '"t"'),
    ]


def observe(page_keys, learn):
    """Plain statement of the rule, page by page."""
    seen, counted, out = set(), 0, set()
    for page, keys in page_keys:
        if not keys:
            continue
        if counted >= learn:
            out |= {("field_appeared", k, page) for k in keys - seen}
            gone = {k for k in seen - keys if not any(o[:2] == ("field_disappeared", k) for o in out)}
            out |= {("field_disappeared", k, page) for k in gone}
        seen |= keys
        counted += 1
    return out


@pytest.mark.parametrize("learn", [1, 2, 4])
def test_field_set_drift_against_the_rule(spark, learn):
    import random

    rng = random.Random(learn)
    layers = {f"u/{n}": [(p * 3, {k for k in "abcd" if rng.random() < 0.6}) for p in range(12)] for n in range(6)}
    rows = [(u, p, json.dumps({"features": [{"attributes": dict.fromkeys(keys, 1)}]})) for u, ps in layers.items() for p, keys in ps]
    scanned = scan_pages(spark.createDataFrame(rows, "layer_url string, page_index bigint, payload string"))
    found = {(r.context, r.kind, r.key, r.at_page) for r in field_set_drift(page_keys(scanned), learn).collect()}
    assert found == {(u, *o) for u, ps in layers.items() for o in observe(ps, learn)}
    with pytest.raises(ValueError):
        field_set_drift(page_keys(scanned), 0)


def test_field_set_drift_sends_no_presence_to_the_driver(spark):
    # Such rows take next to no space in files: 300,000 of them are far below the size up to which a table is sent around.
    presence = spark.range(100_000).select(
        F.lit("https://maps.example.com/0").alias("context"), F.col("id").alias("page_index"), F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("key")
    )
    drift = field_set_drift(presence.where("key <> 'c' or page_index between 10 and 99998"))
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        drift.explain("formatted")
    assert "Join" in plan.getvalue() and "Broadcast" not in plan.getvalue()
    assert {tuple(r) for r in drift.select("kind", "key", "at_page").collect()} == {("field_appeared", "c", 10), ("field_disappeared", "c", 99_999)}


def test_domains(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 5.0), (88, "1", 700.0)], "status int, code string, size double")
    fields = [
        {"name": "status", "domain": {"type": "codedValue", "codedValues": [{"code": 1, "name": "Open"}, {"code": 2}, "bad", {"code": "88", "name": "text"}]}},
        {"name": "code", "domain": {"type": "codedValue", "codedValues": [{"code": "a", "name": "Alpha"}, {"code": 1, "name": "number"}]}},
        {"name": "size", "domain": {"type": "range", "range": [0, 10]}},
        {"name": "absent", "domain": "text"},
    ]
    assert [tuple(r) for r in resolve_domains(df, fields).collect()] == [("Open", "Alpha", 1.0), ("2", "b", 5.0), ("88", "1", 700.0)]
    many = [{"name": "status", "domain": {"type": "codedValue", "codedValues": [{"code": i, "name": f"n{i}"} for i in range(700)]}}]
    assert sorted(r.status for r in resolve_domains(df, many).collect()) == ["n1", "n2", "n88"]
    assert df.columns == resolve_domains(df, many).columns


def test_union_needs_one_reference(spark):
    a = spark.createDataFrame([(1, 3857)], "k int, srid int")
    b = spark.createDataFrame([(2, 3857, "x")], "k int, srid int, more string")
    assert union_chunks([a, b]).count() == 2
    none = spark.createDataFrame([(3, None)], "k int, srid int")
    assert union_chunks([none, a, b]).count() == 3
    other = spark.createDataFrame([(3, 4326)], "k int, srid int")
    for chunks, expected in (([a, other], None), ([a, none, other], 3857), ([a], 4326)):
        with pytest.raises(Exception, match="in reference"):
            union_chunks(chunks, expected=expected).collect()


def test_domains_from_a_table_never_multiply_rows(spark):
    big = 9007199254740992
    rows = spark.createDataFrame([("u", big), ("u", big + 1), ("u", 7), ("v", 7), ("u", None)], "layer_url string, code bigint")
    codes = [("u", "code", "number", str(big), "A"), ("u", "code", "number", str(big + 1), "B"), ("u", "code", "number", "7", "old")]
    codes += [("u", "code", "number", "7.0", "seven"), ("u", "code", "number", "NaN", "never"), ("u", "code", "string", "7", "text")]
    table = spark.createDataFrame([(*c, i) for i, c in enumerate(codes)], "layer_url string, name string, code_kind string, code string, label string, position int")
    found = [tuple(r) for r in resolve_domains_from(rows, table, "code").collect()]
    assert sorted(found, key=str) == sorted([("u", "A"), ("u", "B"), ("u", "seven"), ("v", "7"), ("u", None)], key=str)
    assert resolve_domains_from(rows, table.drop("position"), "code").count() == 5
    fields = [{"name": "code", "domain": {"type": "codedValue", "codedValues": [{"code": float("nan"), "name": "x"}, {"code": big + 1, "name": "B"}]}}]
    assert sorted(r.code or "" for r in resolve_domains(rows, fields).collect()) == ["", "7", "7", "9007199254740992", "B"]


def test_page_number_is_the_file_s_own(spark):
    from pyspark.sql import functions as F

    from layerframe.sources.pages import _PAGE_NUMBER

    paths = ["/in/page-2/run/page-7.json", "/in/page_index=3/part-0.txt", "/in/page-12.json", "/in/other"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert [r[0] for r in df.select(F.regexp_extract("p", _PAGE_NUMBER, 1)).collect()] == ["7", "3", "12", ""]


def test_split_needs_more_than_one_id(spark):
    from layerframe.plans.paging import split_truncated

    requests = spark.createDataFrame([("u/0", 0, [1, 2, 3, 4, 5])], "layer_url string, page_index bigint, oids array<bigint>")
    with pytest.raises(TruncatedPageError):
        split_truncated(requests, lambda asked: asked.withColumn("exceeded", F.array_contains("oids", 3)))
    done = split_truncated(requests, lambda asked: asked.withColumn("exceeded", F.size("oids") > 2))
    assert sorted(i for r in done.collect() for i in r.oids) == [1, 2, 3, 4, 5]
    assert max(len(r.oids) for r in done.collect()) <= 2
    with pytest.raises(TruncatedPageError, match="depth"):
        split_truncated(requests, lambda asked: asked.withColumn("exceeded", F.size("oids") > 1), max_depth=1)


def test_a_layer_with_null_geometries_is_one_reference(spark):
    import json

    from layerframe.operators.frames import get_df, get_geo_df

    shapes = [{"x": 1, "y": 2}, None, {}, {"x": None, "y": None}, {"rings": []}, {"points": []}, {"x": 3, "y": 4, "spatialReference": {"wkid": 3857}}]

    def page(index, geometries, wkid=3857):
        features = [{"attributes": {"OID": 10 * index + i}, "geometry": g} for i, g in enumerate(geometries)] + [{"attributes": {"OID": 10 * index + 9}}]
        body = {"objectIdFieldName": "OID", "spatialReference": {"wkid": wkid}, "features": features}
        return spark.createDataFrame([("u", index, json.dumps(body))], "layer_url string, page_index bigint, payload string")

    whole = get_geo_df([page(0, shapes), page(1, shapes[::-1])], 3857)
    assert [r.srid for r in whole.collect()] == [3857] * 16
    assert get_geo_df(page(0, [None]), 4326).count() == 2
    other = [{"x": 1, "y": 1, "spatialReference": {"wkid": 4326}}]
    with pytest.raises(Exception, match="in reference"):
        get_geo_df([page(0, shapes), page(1, other)], 3857).collect()
    codes = spark.createDataFrame([("u", "OID", "number", "1", "one")], "layer_url string, name string, code_kind string, code string, label string")
    rows = get_df(page(0, shapes), [{"name": "OID", "type": "esriFieldTypeInteger"}], codes, ["OID"])
    assert sorted(r.OID for r in rows.collect()) == sorted(["0", "one", *map(str, range(2, 7)), "9"])
