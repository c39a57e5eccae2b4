"""Whole reads under each policy, plans carried out, and what a read lacks."""

import contextlib
import io
import json

import fake_service
import pytest
from pyspark.sql import functions as F

from layerframe.errors import TruncatedPageError
from layerframe.functions import variants as V
from layerframe.operators.frames import get_df, get_geo_df, read_whole, require_complete_read
from layerframe.operators.integrity import id_gaps, id_report, require_unique_ids
from layerframe.plans.execute import landed_answers, read_layers
from layerframe.plans.paging import plan_requests
from layerframe.sources.connector import fetch_answers
from layerframe.sources.policy import ReadPolicy

FIELDS = [{"name": "OID", "type": "esriFieldTypeOID"}]
KEEP = ReadPolicy("quarantine", "ignore")


def page(*ids, **more):
    features = [{"attributes": {"OID": i}, "geometry": {"x": i, "y": 0}} for i in ids]
    return json.dumps({"objectIdFieldName": "OID", "features": features, **more})


def landed(spark, *payloads):
    return spark.createDataFrame([("u/0", i, p) for i, p in enumerate(payloads)], "layer_url string, page_index long, payload string")


BAD = {
    "exceededTransferLimit": page(3, exceededTransferLimit=True),
    "service_error Timed out": '{"error": {"code": 504, "message": "Timed out"}}',
    "not_json": "<html>",
    "not_object": "[1]",
}


@pytest.mark.parametrize("said", BAD)
def test_a_bad_page_fails_the_read(spark, said):
    pages = landed(spark, page(1, 2), BAD[said])
    with pytest.raises(Exception, match=f"u/0 page 1: {said}"):
        get_df(pages, FIELDS).collect()
    with pytest.raises(Exception, match=f"u/0 page 1: {said}"):
        get_geo_df(pages, 4326).select("object_id").collect()
    with pytest.raises(Exception, match=said):
        get_df(pages, FIELDS).count()


def test_ignored_and_quarantined(spark):
    pages = landed(spark, page(1, 2), *BAD.values(), page())
    whole = read_whole(pages, FIELDS)
    assert sorted((r.OID, r.truncated) for r in whole.rows.collect()) == [(1, False), (2, False), (3, True)]
    assert sorted((r.page_index, r.status, r.code) for r in whole.quarantine.collect()) == [(2, "service_error", 504), (3, "not_json", None), (4, "not_object", None)]
    features = get_geo_df(pages, 4326, KEEP).collect()
    assert sorted((r.object_id, r.truncated) for r in features) == [(1, False), (2, False), (3, True)]
    assert "truncated" not in get_df(pages, FIELDS).columns
    # only one kind is let pass
    with pytest.raises(Exception, match="page 1: exceeded"):
        get_df(pages, FIELDS, policy=ReadPolicy("quarantine", "raise")).collect()
    with pytest.raises(Exception, match="page [234]: (service_error|not_json|not_object)"):
        get_df(pages, FIELDS, policy=ReadPolicy("raise", "ignore")).collect()
    with pytest.raises(ValueError):
        get_df(pages, FIELDS, policy=ReadPolicy(on_truncation="split"))
    with pytest.raises(ValueError):
        ReadPolicy(on_error="drop")


def test_states_of_pages(spark):
    pages = landed(spark, page(1, 2), *BAD.values(), page(4), page(5, 6))
    pages = pages.unionByName(spark.createDataFrame([("u/0", 0, page(1)), ("u/0", 2, page(9)), (None, None, "x")], pages.schema))
    plan = spark.createDataFrame([("u/0", i, n) for i, n in [(0, 2), (1, 2), (2, 1), (3, 1), (5, 2), (6, 1), (7, 3), (8, None)]], "layer_url string, page_index long, count long")
    found = {r.page_index: (r.asked, r.found, r.landed, r.state) for r in read_whole(pages, FIELDS, plan).states.collect()}
    assert found == {
        0: (2, 2, 2, "complete"), 1: (2, 1, 1, "truncated"), 2: (1, 1, 2, "complete"), 3: (1, None, 1, "failed"), 4: (None, None, 1, "failed"),
        5: (2, 1, 1, "short"), 6: (1, 2, 1, "over"), 7: (3, None, 0, "missing"), 8: (None, None, 0, "missing"), None: (None, None, 1, "failed"),
    }
    with pytest.raises(Exception, match="is (truncated|failed|short|over|missing)"):
        require_complete_read(read_whole(pages, FIELDS, plan).states).collect()
    good = landed(spark, page(1, 2))
    assert require_complete_read(read_whole(good, FIELDS).states).count() == 1


LAYER = "layer_url string, total long, max_record_count int, supports_pagination boolean, pagination_explicit boolean, advertised_factor double, object_id_field string, where string"


def layers(spark, *rows):
    return spark.createDataFrame([(url, total, cap, paging, paging, None, "OID", "1=1") for url, total, cap, paging in rows], LAYER)


def windows(spark, *rows):
    return spark.createDataFrame(rows, "layer_url string, offset long, count long, payload string")


def oids(reading):
    return sorted((r.layer_url, r.page_index, r.pos, r.oid) for r in reading.features.select("layer_url", "page_index", "pos", V.get(F.col("attributes"), "OID", to="long").alias("oid")).collect())


def test_windows_meet_pages_of_other_windows(spark):
    n = 2500
    pages = windows(spark, *(("u/1", at, 700, page(*range(at, min(at + 700, n)))) for at in range(0, n, 700)), ("u/2", 0, 10, page(7, 8)), ("u/9", 0, 5, page(1)))
    plan = plan_requests(layers(spark, ("u/1", n, 300, True), ("u/2", 2, 300, False), ("u/3", 0, 10, True)))
    reading = read_layers(plan, landed_answers(pages, "OID"))
    assert oids(reading) == [("u/1", i // 300, i % 300, i) for i in range(n)] + [("u/2", 0, 0, 7), ("u/2", 0, 1, 8)]
    states = {(r.layer_url, r.page_index): r.state for r in reading.states.collect()}
    assert set(states.values()) == {"complete"} and len(states) == 11
    assert reading.quarantine.count() == 0


def test_id_lists_and_failures(spark):
    pages = windows(spark, ("u/1", 0, 4, page(10, 20, 30, 40)), ("u/1", 4, 3, page(50, 60, 70)), ("u/2", 0, 3, page(1, 2, 3)), ("u/2", 3, 3, "<html>"), ("u/2", 6, 3, page(7, exceededTransferLimit=True)))
    ids = spark.createDataFrame([("u/1", i) for i in (70, 60, 50, 40, 30, 20, 10)], "layer_url string, oid long")
    plan = plan_requests(layers(spark, ("u/1", 7, 3, False), ("u/2", 9, 3, True), ("u/3", 5, None, True), ("u/4", 1, 5, True)), ids)
    reading = read_layers(plan, landed_answers(pages, "OID"), KEEP)
    assert oids(reading) == [("u/1", i // 3, i % 3, 10 * (i + 1)) for i in range(7)] + [("u/2", 0, 0, 1), ("u/2", 0, 1, 2), ("u/2", 0, 2, 3), ("u/2", 2, 0, 7)]
    states = {(r.layer_url, r.page_index): r.state for r in reading.states.collect()}
    assert states == {
        ("u/1", 0): "complete", ("u/1", 1): "complete", ("u/1", 2): "complete", ("u/2", 0): "complete", ("u/2", 1): "failed", ("u/2", 2): "truncated",
        ("u/3", None): "not_planned", ("u/4", 0): "unanswered",
    }
    assert sorted((r.layer_url, r.status) for r in reading.quarantine.collect()) == [("u/2", "not_json"), ("u/3", "not_planned"), ("u/4", "unanswered")]
    for policy, said in ((ReadPolicy("raise", "ignore"), "not_json|not_planned|unanswered"), (ReadPolicy("quarantine", "raise"), "u/2 page 2: exceeded")):
        with pytest.raises(Exception, match=said):
            read_layers(plan, landed_answers(pages, "OID"), policy).features.collect()


def test_services_are_asked_and_split(spark):
    spark.sparkContext.addPyFile(fake_service.__file__)
    answer = fetch_answers({"transport": "fake_service:fetch", "serves": "4", "rows": "57"})
    ids = spark.createDataFrame([(f"https://h/{i}/0", o) for i in (1, 2, 3) for o in range(100, 157)], "layer_url string, oid long")
    plan = plan_requests(layers(spark, ("https://h/1/0", 57, 10, True), ("https://h/2/0", 57, 10, False), ("https://h/3/0", 57, 100, True)), ids)
    reading = read_layers(plan, answer, ReadPolicy("raise", "split"), ids)
    found = sorted((url, oid) for url, _, _, oid in oids(reading))
    assert found == [(f"https://h/{i}/0", o) for i in (1, 2, 3) for o in range(100, 157)]
    assert {r.state for r in reading.states.collect()} == {"complete"}
    with pytest.raises(Exception, match="only the ids of the layer"):
        read_layers(plan, answer, ReadPolicy("raise", "split")).features.collect()
    with pytest.raises(Exception, match="exceededTransferLimit"):
        read_layers(plan, answer).features.collect()
    ignored = read_layers(plan, answer, ReadPolicy("raise", "ignore"))
    assert ignored.features.where("exceeded").count() == ignored.features.count() == 24 + 24 + 4
    with pytest.raises(TruncatedPageError):
        read_layers(plan, fetch_answers({"transport": "fake_service:fetch", "serves": "0"}), ReadPolicy("raise", "split"), ids)
    with pytest.raises(TruncatedPageError, match="depth"):
        read_layers(plan, answer, ReadPolicy("raise", "split"), ids, max_depth=1)


def test_features_meet_listed_ids_as_text(spark):
    # as a VARIANT each feature would take the keys of its whole page through the shuffle
    pages = spark.createDataFrame([("u", 0, 2, '{"features": [{"attributes": {"OID": 1}}, {"attributes": {"OID": 2}}]}')], "layer_url string, offset long, count long, payload string")
    requests = spark.createDataFrame(
        [("u", 0, "", 0, "oid", None, None, "1=1", None, "OID", [1, 2], 2)],
        "layer_url string, page_index long, path string, depth int, strategy string, offset long, count long, where string, order_by string, object_id_field string, oids array<long>, total long",
    )
    answered = landed_answers(pages, "OID")(requests)
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        answered.explain("formatted")
    moved = [part for part in plan.getvalue().split("\n\n") if "Exchange" in part.split("\n")[0]]
    assert moved and not [part for part in moved if "_feature#" in part]
    assert answered.select(F.size("features")).first()[0] == 2


def test_unreachable_services_are_quarantined(spark):
    spark.sparkContext.addPyFile(fake_service.__file__)
    plan = plan_requests(layers(spark, ("https://h/broken/0", 5, 10, True), ("https://h/1/0", 3, 10, True)))
    reading = read_layers(plan, fetch_answers({"transport": "fake_service:fetch", "rows": "3"}), KEEP)
    assert [(r.layer_url, r.status) for r in reading.quarantine.collect()] == [("https://h/broken/0", "no_response")]
    assert reading.features.count() == 3


def test_ids_repeated_missing_null_and_unexpected(spark):
    rows = spark.createDataFrame([("a", i) for i in [1, 1, 2, None, None, 9] + [5] * 400] + [("b", 1)], "layer_url string, OID long")
    expected = spark.createDataFrame([("a", i) for i in (1, 2, 3, 3, None, 5)] + [("b", 1), ("c", 4)], "layer_url string, OID long")
    found = {(r.layer_url, r.oid): (r.problem, r.n) for r in id_report(rows, "OID", expected).collect()}
    assert found == {
        ("a", 1): ("repeated", 2), ("a", 3): ("missing", 0), ("a", None): ("null", 2), ("a", 9): ("unexpected", 1), ("a", 5): ("repeated", 400), ("c", 4): ("missing", 0),
    }
    assert {r.oid for r in id_report(rows, "OID").collect()} == {1, None, 5}
    assert id_report(rows.limit(0), "OID").count() == 0
    with pytest.raises(Exception, match="is (repeated|missing|null|unexpected)"):
        require_unique_ids(rows, "OID", expected).collect()
    assert require_unique_ids(rows.where("layer_url = 'b'"), "OID").count() == 0


def test_id_report_counts_both_sides_at_once(spark):
    # a layer without a name is one layer on both sides, and no task sorts the two for a join
    rows = spark.createDataFrame([(None, 1), (None, 1), ("u", 2)], "layer_url string, OID long")
    expected = spark.createDataFrame([(None, 1), (None, 3), ("u", 2), ("u", 2)], "layer_url string, OID long")
    report = id_report(rows, "OID", expected)
    assert sorted(tuple(r) for r in report.select("oid", "problem", "n").collect()) == [(1, "repeated", 2), (3, "missing", 0)]
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        report.explain("formatted")
    assert "Join" not in plan.getvalue()


def test_gaps_across_blocks(spark):
    ids = [1, 2, 3, 7, 8, 20, 21, 22, 40]
    rows = spark.createDataFrame([("a", i) for i in ids + [8]] + [("b", 5)], "layer_url string, OID long")
    for block in (1, 4, 10, 1000):
        found = sorted((r.layer_url, r.after, r.before) for r in id_gaps(rows, "OID", block=block).collect())
        assert found == [("a", 3, 7), ("a", 8, 20), ("a", 22, 40)]
