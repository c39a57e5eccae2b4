"""The layer wrapper and the spatial filter."""

import random
from fractions import Fraction

import json

import pytest
from pyspark.sql import functions as F

from layerframe import Layer, LayerError, MissingFieldError
from layerframe.operators.spatial import filter_geometry, filter_options, spatial_filter


@pytest.fixture(scope="module")
def layer(spark):
    rows = [(i, "ab"[i % 2] if i % 5 else None, i % 3) for i in range(40)]
    return Layer(spark.createDataFrame(rows, "oid bigint, k string, n int"), "oid")


def test_missing_fields(layer):
    for call in (lambda: layer.unique_values("K"), lambda: layer.value_counts("x"), lambda: layer.nested_count(["k", "x"]), lambda: layer.out_fields("oid,x"), lambda: layer.where_in("x", [1])):
        with pytest.raises(MissingFieldError):
            call()
    with pytest.raises(ValueError):
        layer.nested_count(["k"])
    with pytest.raises(LayerError):
        Layer(layer.df).head()


def test_refining_parenthesizes(layer):
    refined = layer.where("n = 0 OR n = 1").where("k = 'a'")
    assert refined.count() == layer.df.where("(n = 0 OR n = 1) AND k = 'a'").count()
    assert layer.where("1=1") is layer and Layer(layer.df, where="n = 2").count() == 13


def test_where_in(layer, spark):
    assert layer.where_in("k", []).count() == 0
    assert layer.where_in("k", ["a", "it's"]).count() == layer.where("k = 'a'").count()
    assert layer.where_in("oid", range(20, 5000)).count() == 20
    twice = spark.createDataFrame([(1,), (1,), (None,)], "v bigint")
    assert layer.where_in("oid", twice).count() == 1


def test_nulls_in_summaries(layer):
    assert [r.k for r in layer.unique_values("k", "k").collect()] == ["a", "b", None]
    assert [tuple(r) for r in layer.value_counts("k").collect()] == [("a", 16), ("b", 16), (None, 0)]
    assert layer.nested_count(("n", "k")).columns == ["n", "k", "Count"]
    assert layer.where("n > 9").value_counts("k").columns == ["k", "k_count"]


def test_slices_and_samples(layer):
    assert [r.oid for r in layer.page_slice(10, 3).df.collect()] == [10, 11, 12]
    assert [r.oid for r in layer.head(3).df.collect()] == [0, 1, 2]
    drawn = [r.oid for r in layer.sample(7, seed=3).df.collect()]
    assert len(set(drawn)) == 7 and drawn == [r.oid for r in layer.sample(7, seed=3).df.collect()]
    assert layer.sample(1000).count() == 40


def test_slices_keep_the_order_at_any_depth(spark, layer):
    assert [r.oid for r in layer.page_slice(10, 3).df.collect()] == [10, 11, 12]
    deep = Layer(spark.range(150_000).selectExpr("149999 - id AS oid"), "oid")
    assert [r.oid for r in deep.page_slice(120_000, 4).df.collect()] == [120_000, 120_001, 120_002, 120_003]


def test_value_lists_are_cast_whatever_their_length(spark):
    numbers = Layer(spark.range(3000).selectExpr("id AS k", "CAST(id AS STRING) AS t"), "k")
    assert numbers.where_in("k", [str(i) for i in range(0, 3000, 2)]).count() == 1500
    assert numbers.where_in("k", ["5", "x", None, 7.0, 8.5]).count() == 2
    assert numbers.where_in("t", [1, 2]).count() == 2
    assert numbers.where_in("k", []).count() == 0


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "`OBJECT.ID` int, `Shape.STArea()` string")
    layer = Layer(df, "OBJECT.ID")
    name = "Shape.STArea()"
    assert [tuple(r) for r in layer.value_counts(name).collect()] == [("a", 2), (None, 0)]
    assert [r[0] for r in layer.unique_values(name, name).collect()] == ["a", None]
    assert layer.where_in(name, ["a"]).count() == 2
    assert layer.nested_count([name, "OBJECT.ID"]).count() == 3
    assert [r[0] for r in layer.object_ids().collect()] == [1, 2, 3]
    assert layer.head(1).sample(1).page_slice(0, 1).df.columns == df.columns


RING = [[0, 0], [10, 0], [10, 10], [5, 4], [0, 10], [0, 0]]
HOLE = [[4, 1], [6, 1], [6, 3], [4, 3], [4, 1]]


def inside(x, y):
    odd = False
    for ring in (RING, HOLE):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


def points(spark, rows):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(rows)], "i int, x double, y double").select(
        "i", F.struct("x", "y").alias("geometry")
    )


def test_polygon_against_ray_casting(spark):
    rng = random.Random(5)
    rows = [(rng.uniform(-2, 12), rng.uniform(-2, 12)) for _ in range(500)]
    shape = {"rings": [RING, HOLE]}
    for relation in ("intersects", "esriSpatialRelContains"):
        found = {r.i for r in spatial_filter(points(spark, rows), "geometry", shape, relation=relation).collect()}
        assert found == {i for i, p in enumerate(rows) if inside(*p)}
    assert spatial_filter(points(spark, rows), "geometry", shape, relation="within").count() == 0


def test_boundary_points(spark):
    df = points(spark, [(0.0, 5.0), (10.0, 10.0), (4.0, 2.0), (5.0, 2.0), (None, 1.0)])
    shape = {"type": "Polygon", "coordinates": [RING, HOLE]}
    assert {r.i for r in spatial_filter(df, "geometry", shape).collect()} == {0, 1, 2}
    assert spatial_filter(df, "geometry", shape, relation="contains").count() == 0
    box = {"xmin": 0, "ymin": 0, "xmax": 10, "ymax": 10}
    assert {r.i for r in spatial_filter(df, "geometry", box).collect()} == {0, 1, 2, 3}
    assert {r.i for r in spatial_filter(df, "geometry", box, relation="contains").collect()} == {2, 3}
    assert {r.i for r in spatial_filter(df, "geometry", {"x": 5, "y": 2}, relation="within").collect()} == {3}


def test_envelope_and_multipoint_features(spark):
    texts = [
        '{"xmin": 1, "ymin": 1, "xmax": 2, "ymax": 2}', '{"xmin": -5, "ymin": -5, "xmax": 15, "ymax": 15}',
        '{"xmin": 4.5, "ymin": 1.5, "xmax": 5.5, "ymax": 2.5}', '{"xmin": 4.5, "ymin": 8, "xmax": 5.5, "ymax": 9}',
        '{"xmin": 9, "ymin": 1, "xmax": 12, "ymax": 2}', '{"points": [[1, 1], [50, 50]]}', '{"points": [[1, 1], [2, 2]]}', "null",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, j string").select("i", F.parse_json("j").alias("geometry"))
    shape = {"rings": [RING, HOLE]}
    kept = lambda relation: {r.i for r in spatial_filter(df, "geometry", shape, relation=relation).collect()}
    assert kept("intersects") == {0, 1, 4, 5, 6}
    assert kept("contains") == {0, 6}
    assert kept("within") == {1}


def test_references_must_agree(spark):
    df = spark.createDataFrame([(1.0, 1.0, 4326)], "x double, y double, srid int").select(F.struct("x", "y", "srid").alias("geometry"))
    assert spatial_filter(df, "geometry", {"rings": [RING]}, in_sr={"wkid": 4326}).count() == 1
    with pytest.raises(Exception, match="reference"):
        spatial_filter(df, "geometry", {"rings": [RING]}, in_sr=3857).collect()


def test_filter_options(spark):
    found = filter_options({"type": "Point", "coordinates": (1, 2)}, in_sr={"wkid": 102100, "latestWkid": 3857})
    assert json.loads(found.pop("geometry")) == {"x": 1, "y": 2}
    assert found == {"geometryType": "esriGeometryPoint", "spatialRel": "esriSpatialRelIntersects", "inSR": "3857"}
    assert json.loads(filter_options({"curveRings": []}, in_sr={"wkt": "LOCAL"})["inSR"]) == {"wkt": "LOCAL"}
    for bad in ({"type": "FeatureCollection"}, {"type": "Feature"}, {"type": "Point", "coordinates": [1]}, {"z": 1}):
        with pytest.raises(ValueError):
            filter_geometry(bad)
    with pytest.raises(TypeError):
        filter_geometry(5)


def test_lines_and_areas_against_a_polygon(spark):
    shapes = {
        "small area inside": {"rings": [[[1, 1], [2, 1], [2, 2], [1, 1]]]},
        "area around": {"rings": [[[-5, -5], [15, -5], [15, 15], [-5, 15], [-5, -5]]]},
        "area over the hole": {"rings": [[[3.5, 0.5], [6.5, 0.5], [6.5, 3.5], [3.5, 3.5], [3.5, 0.5]]]},
        "area in the hole": {"rings": [[[4.5, 1.5], [5.5, 1.5], [5, 2.5], [4.5, 1.5]]]},
        "area cutting an edge": {"rings": [[[9, 1], [12, 1], [12, 2], [9, 2], [9, 1]]]},
        "area in the notch": {"rings": [[[4.5, 8], [5.5, 8], [5, 9], [4.5, 8]]]},
        "line inside": {"paths": [[[1, 1], [2, 3]]]},
        "line through": {"paths": [[[-1, 1], [11, 1.5]]]},
        "line across the hole": {"paths": [[[3, 2], [7, 2]]]},
        "line outside": {"paths": [[[20, 20], [30, 30]]]},
        "nothing": {"rings": []},
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in shapes.items()], "k string, j string").select("k", F.parse_json("j").alias("geometry"))
    kept = lambda relation, shape={"rings": [RING, HOLE]}: {r.k for r in spatial_filter(df, "geometry", shape, relation=relation).collect()}
    assert kept("intersects") == {"small area inside", "area around", "area over the hole", "area cutting an edge", "line inside", "line through", "line across the hole"}
    assert kept("contains") == {"small area inside", "line inside"}
    assert kept("within") == {"area around"}
    assert kept("within", {"x": 1.6, "y": 1.2}) == {"small area inside", "area around"}
    assert kept("intersects", {"points": [[5, 2], [50, 50]]}) == {"area around", "area over the hole", "area in the hole", "line across the hole"}
    curved = spark.createDataFrame([('{"curveRings": [[[0, 0], [1, 1]]]}',)], "j string").select(F.parse_json("j").alias("geometry"))
    with pytest.raises(Exception, match="curves"):
        spatial_filter(curved, "geometry", {"rings": [RING]}).collect()


# --- relations of lines and areas against a plain test in exact fractions ---------------------


def segments(shape):
    out = []
    for line in shape.get("rings", shape.get("paths", ())):
        closed = line + [line[0]] if "rings" in shape else line
        out += [(tuple(a), tuple(b)) for a, b in zip(closed, closed[1:]) if a != b]
    return out


def strictly_inside(edges, x, y):
    odd = False
    for (x1, y1), (x2, y2) in edges:
        if (y1 > y) != (y2 > y) and x < Fraction(x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def on_some(edges, x, y):
    return any(
        (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2)
        for (x1, y1), (x2, y2) in edges
    )


def pieces(edges, others):
    """(middle, point just left, point just right) of every piece between meetings."""
    for (x1, y1), (x2, y2) in edges:
        dx, dy = x2 - x1, y2 - y1
        cuts = {Fraction(0), Fraction(1)}
        for (a1, b1), (a2, b2) in [*edges, *others]:
            turn = dx * (b2 - b1) - dy * (a2 - a1)
            if turn:
                t, u = Fraction((a1 - x1) * (b2 - b1) - (b1 - y1) * (a2 - a1), turn), Fraction((a1 - x1) * dy - (b1 - y1) * dx, turn)
                cuts |= {t} if 0 <= u <= 1 and 0 <= t <= 1 else set()
            elif (a1 - x1) * dy == (b1 - y1) * dx:
                cuts |= {t for a, b in ((a1, b1), (a2, b2)) if 0 <= (t := Fraction((a - x1) * dx + (b - y1) * dy, dx * dx + dy * dy)) <= 1}
        places = sorted(cuts)
        for t, u in zip(places, places[1:]):
            x, y = x1 + (t + u) / 2 * dx, y1 + (t + u) / 2 * dy
            tiny = Fraction(1, 10**9)
            yield (x, y), (x - tiny * dy, y + tiny * dx), (x + tiny * dy, y - tiny * dx)


def plain_holds(outer, inner):
    out, inn = segments(outer), segments(inner)
    if "paths" in outer:
        return "paths" in inner and all(on_some(out, *m) for m, _, _ in pieces(inn, out))
    if "paths" in inner:
        middles = [m for m, _, _ in pieces(inn, out)]
        return all(on_some(out, *m) or strictly_inside(out, *m) for m in middles) and any(not on_some(out, *m) and strictly_inside(out, *m) for m in middles)
    beside = [p for _, a, b in [*pieces(inn, out), *pieces(out, inn)] for p in (a, b)]
    return all(strictly_inside(out, *p) for p in beside if strictly_inside(inn, *p))


def plain_intersects(a, b):
    first, second = segments(a), segments(b)
    for (own, other, shape) in ((first, second, b), (second, first, a)):
        for piece in own:
            if any(on_some(other, *p) or ("rings" in shape and strictly_inside(other, *p)) for p in piece):
                return True
        if any(on_some(other, *m) or ("rings" in shape and strictly_inside(other, *m)) for m, _, _ in pieces(own, other)):
            return True
    # crossings at single points end pieces
    return any(on_some(second, *p) for s in first for p in ends_of_pieces(s, second))


def ends_of_pieces(s, others):
    (x1, y1), (x2, y2) = s
    dx, dy = x2 - x1, y2 - y1
    for (a1, b1), (a2, b2) in others:
        turn = dx * (b2 - b1) - dy * (a2 - a1)
        if turn:
            t, u = Fraction((a1 - x1) * (b2 - b1) - (b1 - y1) * (a2 - a1), turn), Fraction((a1 - x1) * dy - (b1 - y1) * dx, turn)
            if 0 <= t <= 1 and 0 <= u <= 1:
                yield x1 + t * dx, y1 + t * dy


def random_shapes(rng, n):
    """Concave rings around a centre and short paths, on a coarse grid so that edges meet edges and corners."""
    made = []
    for _ in range(n):
        cx, cy = rng.randint(2, 8), rng.randint(2, 8)
        if rng.random() < 0.3:
            made.append({"paths": [[[rng.randint(0, 10), rng.randint(0, 10)] for _ in range(rng.randint(2, 4))]]})
            continue
        directions = [(1, 0), (2, 1), (1, 1), (1, 2), (0, 1), (-1, 2), (-1, 1), (-2, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]
        chosen = sorted(rng.sample(range(12), rng.randint(5, 9)))
        ring = [[cx + (r := rng.randint(1, 3)) * directions[i][0], cy + r * directions[i][1]] for i in chosen]
        made.append({"rings": [ring]})
    return made


def test_random_relations_equal_a_plain_test(spark):
    rng = random.Random(11)
    shapes = [s for s in random_shapes(rng, 70) if segments(s)]
    shapes += [{"rings": [RING]}, {"rings": [RING, HOLE]}, {"rings": [HOLE]}, {"rings": [[[0, 0], [10, 0], [10, 10], [0, 10]]]}, {"paths": [[[0, 0], [10, 0]]]}]
    df = spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(shapes)], "i int, j string").select("i", F.parse_json("j").alias("geometry")).cache()
    seen = {r: 0 for r in ("intersects", "contains", "within")}
    for shape in [*random_shapes(rng, 5), *shapes[-5:]]:
        if not segments(shape):
            continue
        for relation, test in (("intersects", plain_intersects), ("contains", plain_holds), ("within", lambda a, b: plain_holds(b, a))):
            found = {r.i for r in spatial_filter(df, "geometry", shape, relation=relation).collect()}
            want = {i for i, s in enumerate(shapes) if test(shape, s)}
            assert found == want, (relation, shape, [shapes[i] for i in found ^ want])
            seen[relation] += len(want)
    assert all(n > 10 for n in seen.values())


def test_line_along_the_boundary_across_a_notch(spark):
    notched = {"rings": [[[0, 0], [10, 0], [10, 10], [4, 10], [4, 5], [3, 5], [3, 10], [0, 10], [0, 0]]]}
    lines = {"across": [[0.5, 10], [9.5, 10]], "beside": [[0.5, 10], [2.5, 10]], "into": [[0.5, 10], [2.5, 10], [2.5, 1]], "through": [[1, 1], [9, 1]]}
    df = spark.createDataFrame([(k, json.dumps({"paths": [v]})) for k, v in lines.items()], "k string, j string").select("k", F.parse_json("j").alias("geometry"))
    assert {r.k for r in spatial_filter(df, "geometry", notched, relation="contains").collect()} == {"into", "through"}
    assert {r.k for r in spatial_filter(df, "geometry", notched).collect()} == set(lines)


def test_polyline_filters(spark):
    shapes = {
        "on": {"x": 2, "y": 2}, "off": {"x": 2, "y": 3}, "some": {"points": [[1, 1], [5, 1]]}, "all": {"points": [[1, 1], [3, 3]]}, "part": {"paths": [[[1, 1], [2, 2]]]},
        "around": {"rings": [[[-1, -1], [9, -1], [9, 9], [-1, 9]]]}, "dot": {"paths": [[[1, 1], [1, 1]]]}, "box": {"xmin": 3, "ymin": 0, "xmax": 5, "ymax": 9},
        "longer": {"paths": [[[-1, -1], [9, 9]]]}, "none": {"paths": []}, "empty": {"points": []},
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in shapes.items()], "k string, j string").select("k", F.parse_json("j").alias("geometry"))
    line = {"type": "LineString", "coordinates": [[0, 0], [4, 4]]}
    kept = lambda relation: {r.k for r in spatial_filter(df, "geometry", line, relation=relation).collect()}
    assert kept("intersects") == {"on", "some", "all", "part", "around", "dot", "box", "longer"}
    assert kept("contains") == {"on", "all", "part", "dot"}
    assert kept("within") == {"around", "longer"}
    with pytest.raises(LayerError):
        spatial_filter(df, "geometry", {"curvePaths": [[[0, 0], [1, 1]]]})


def test_plain_filters_start_no_job(spark):
    df = points(spark, [(1.0, 1.0)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        spatial_filter(df, "geometry", {"rings": [RING]}, in_sr=3857)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setJobGroup("rest", "rest")


@pytest.mark.parametrize("ids", [list(range(0, 3000, 3)), [-(2**63), -5, 0, 7, 2**40, 2**63 - 1], [5] * 7 + [6] * 3 + [9], [10**12 + i * i for i in range(200)], [3]])
def test_slices_by_id_bounds_equal_a_sort(spark, ids, monkeypatch):
    from layerframe.plans import rank

    monkeypatch.setattr(rank, "_CELLS", 16)
    shuffled = random.Random(1).sample(ids, len(ids))
    layer = Layer(spark.createDataFrame([(i, n) for n, i in enumerate(shuffled)], "`o.id` bigint, n int"), "o.id")
    n = len(ids)
    for offset, count in ((0, 3), (n // 3, n // 4 + 1), (n - 1, 5), (n, 2), (0, n), (2, 0)):
        found = layer.page_slice(offset, count).df.collect()
        assert [r[0] for r in found] == sorted(ids)[offset : offset + count]
        assert len({r.n for r in found}) == len(found)


def test_slice_is_a_range_filter(spark, tmp_path):
    spark.range(50_000).selectExpr("id * 7 AS oid", "id AS a").write.parquet(f"{tmp_path}/layer")
    sliced = Layer(spark.read.parquet(f"{tmp_path}/layer"), "oid").page_slice(20_000, 10).out_fields("a").df
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(oid,140000)" in plan and "LessThanOrEqual(oid,140063)" in plan
    assert [r.a for r in sliced.collect()] == list(range(20_000, 20_010))


def test_slices_of_other_ids_are_ranked(spark):
    texts = Layer(spark.createDataFrame([(c,) for c in "dbaec"], "oid string"), "oid")
    assert [r.oid for r in texts.page_slice(1, 2).df.collect()] == ["b", "c"]
    partly = Layer(spark.createDataFrame([(3,), (None,), (1,)], "oid bigint"), "oid")
    assert [r.oid for r in partly.page_slice(0, 2).df.collect()] == [None, 1]
    empty = Layer(spark.createDataFrame([], "oid bigint"), "oid")
    assert empty.page_slice(0, 5).df.count() == 0
