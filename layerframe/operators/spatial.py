"""Spatial filter: features related to one given geometry.

The filter geometry is known on the driver, so it becomes literals: a bounding box
that the optimizer can push down where the coordinates are plain columns, and an
edge list for the exact test on what is left.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerframe.errors import LayerError
from layerframe.functions import geometry as G
from layerframe.functions import spatial_reference as SR
from layerframe.functions import variants as V

# Accepted names of the relations, short and as services spell them.
# "contains" keeps features inside the filter geometry, "within" features around it.
RELATIONS = {
    "intersects": "intersects",
    "contains": "contains",
    "within": "within",
    "esriSpatialRelIntersects": "intersects",
    "esriSpatialRelContains": "contains",
    "esriSpatialRelWithin": "within",
}

# Which coordinate keys make which geometry, looked for in this order.
_KEYS = (
    (("x", "y"), G.POINT), (("points",), G.MULTIPOINT), (("paths",), G.POLYLINE), (("curvePaths",), G.POLYLINE),
    (("rings",), G.POLYGON), (("curveRings",), G.POLYGON), (("xmin", "ymin", "xmax", "ymax"), G.ENVELOPE),
)


def _plain(value: Any) -> Any:
    return value.tolist() if hasattr(value, "tolist") else dict(value)


def _converted(geometry: Mapping, in_sr: Any) -> tuple[dict, str, int | None]:
    """(Esri JSON, type, EPSG number) of the filter.

    Esri JSON with a plain number for a reference is taken as it is.  Anything else goes
    through the column functions, once, on a single literal row.
    """
    geometry = json.loads(json.dumps(dict(geometry), default=_plain))
    esri = next((kind for keys, kind in _KEYS if all(k in geometry for k in keys)), None)
    if esri and (in_sr is None or type(in_sr) is int):
        return geometry, esri, in_sr
    literal = lambda v: F.parse_json(F.lit(json.dumps(v, default=_plain)))
    found = G.geojson_to_esri(literal(geometry))
    row = SparkSession.builder.getOrCreate().range(1).select(
        F.to_json(found["geometry"]).alias("shape"), found["geometry_type"].alias("kind"), found["error"].alias("error"),
        SR.epsg(literal(in_sr)).alias("epsg"),
    ).first()
    if row["error"] or row["kind"] is None:
        raise ValueError(row["error"] or "no geometry of a known kind")
    return json.loads(row["shape"]), row["kind"], row["epsg"]


def filter_geometry(geometry: Any, in_sr: Any = None) -> tuple[dict, str, int | None]:
    """Esri JSON, service type name and reference number of a filter geometry.

    Takes GeoJSON, Esri JSON, and objects with ``__geo_interface__``.
    """
    geometry = getattr(geometry, "__geo_interface__", geometry)
    if not isinstance(geometry, Mapping):
        raise TypeError(f"no geometry: {type(geometry).__name__}")
    return _converted(geometry, in_sr)


def filter_options(geometry: Any, in_sr: Any = None, relation: str = "intersects") -> dict[str, str]:
    """Options that make the live connector hand the filter on to its service."""
    shape, kind, number = filter_geometry(geometry, in_sr)
    spelled = next((name for name, short in RELATIONS.items() if short == relation and name != short), relation)
    options = {"geometry": json.dumps(shape), "geometryType": kind, "spatialRel": spelled}
    if in_sr is not None:
        options["inSR"] = str(number) if number is not None else json.dumps(in_sr)
    return options


# --- evaluation ---------------------------------------------------------------------


_EDGE = ("x1", "y1", "x2", "y2")


def _text(rows: list[tuple], names: tuple[str, ...]) -> str:
    """SQL of a literal ``ARRAY<STRUCT<name DOUBLE, ...>>``, one text that is folded away."""
    listed = json.dumps([dict(zip(names, row)) for row in rows])
    return f"from_json('{listed}', 'array<struct<{','.join(n + ':double' for n in names)}>>')"


class _Filter:
    """A filter geometry as plain numbers: points, or the segments of lines or areas, and a bounding box."""

    def __init__(self, shape: Mapping, kind: str):
        lists: list = []
        points: list = []
        if kind == G.POINT:
            points = [[shape["x"], shape["y"]]]
        elif kind == G.MULTIPOINT:
            points = shape["points"]
        elif kind == G.ENVELOPE:
            x0, y0, x1, y1 = (shape[k] for k in ("xmin", "ymin", "xmax", "ymax"))
            lists = [[[x0, y0], [x1, y0], [x1, y1], [x0, y1]]]
        elif "rings" in shape or "paths" in shape:
            lists = shape["rings"] if kind == G.POLYGON else shape["paths"]
        else:
            raise LayerError(f"{kind} filters with curves are left to the service")
        self.is_box = kind == G.ENVELOPE
        self.is_area = kind in (G.ENVELOPE, G.POLYGON)
        self.points = [(float(p[0]), float(p[1])) for p in points]
        self.edges = []
        for line in lists:
            corners = [(float(p[0]), float(p[1])) for p in line]
            if self.is_area and corners:
                corners.append(corners[0])
            self.edges += [(*a, *b) for a, b in zip(corners, corners[1:]) if a != b]
        every = self.points + [p for e in self.edges for p in (e[:2], e[2:])]
        if not every:
            raise LayerError("the filter geometry has no coordinates or no extent")
        self.box = (
            min(p[0] for p in every), min(p[1] for p in every),
            max(p[0] for p in every), max(p[1] for p in every),
        )
        self.vertices = list(dict.fromkeys(every))

        self.edge_array = F.expr(_text(self.edges, _EDGE))
        self.vertex_array = F.expr(_text(self.vertices, ("x", "y")))

    def in_box(self, x: Column, y: Column) -> Column:
        x0, y0, x1, y1 = self.box
        return (x >= x0) & (x <= x1) & (y >= y0) & (y <= y1)

    def covers(self, x: Column, y: Column) -> Column:
        """Point inside or on the boundary."""
        if not self.edges:
            return F.exists(self.vertex_array, lambda v: (x == v["x"]) & (y == v["y"]))
        if self.is_box:
            return self.in_box(x, y)
        inside = self._on_edge(x, y) | self._odd(x, y) if self.is_area else self._on_edge(x, y)
        return self.in_box(x, y) & inside

    def holds(self, x: Column, y: Column) -> Column:
        """Point strictly inside (for point and line filters: one of theirs)."""
        if not self.is_area:
            return self.covers(x, y)
        if self.is_box:
            x0, y0, x1, y1 = self.box
            return (x > x0) & (x < x1) & (y > y0) & (y < y1)
        return self.in_box(x, y) & ~self._on_edge(x, y) & self._odd(x, y)

    def _odd(self, x: Column, y: Column) -> Column:
        """Even-odd rule: a ray to the right crosses an odd number of edges."""

        def crosses(e: Column) -> Column:
            spans = (e["y1"] > y) != (e["y2"] > y)
            at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
            return spans & (x < at)

        return F.size(F.filter(self.edge_array, crosses)) % 2 == 1

    def _on_edge(self, x: Column, y: Column) -> Column:
        def touches(e: Column) -> Column:
            cross = (x - e["x1"]) * (e["y2"] - e["y1"]) - (y - e["y1"]) * (e["x2"] - e["x1"])
            return (
                (cross == 0)
                & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
                & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
            )

        return F.exists(self.edge_array, touches)


class _Feature:
    """Extent and positions of a feature geometry column (struct or VARIANT)."""

    def __init__(self, df: DataFrame, name: str):
        column, kind = F.col(name), df.schema[name].dataType
        # Whether rows may hold anything but points.
        self.mixed = not isinstance(kind, T.StructType) or bool({"coords", "points", "xmin", "rings", "paths"} & set(kind.names))
        if isinstance(kind, T.StructType) and "coords" in kind.names:
            self.srid, column = column["srid"], column["coords"]
            number = lambda k: V.get(column, k, to="double")
            self.points = F.try_variant_get(column, "$.points", "array<array<double>>")
        elif isinstance(kind, T.StructType):
            self.srid = column["srid"] if "srid" in kind.names else F.lit(None).cast("int")
            number = lambda k: column[k] if k in kind.names else F.lit(None).cast("double")
            self.points = column["points"] if "points" in kind.names else F.lit(None).cast("array<array<double>>")
        else:
            self.srid = SR.epsg(V.first_of(column, "spatialReference", "spatial_reference"))
            number = lambda k: V.get(column, k, to="double")
            self.points = F.try_variant_get(column, "$.points", "array<array<double>>")
        # Lines and areas: their segments, rings closed.  Curves are not evaluated.
        lists = "array<array<array<double>>>"
        variant = not isinstance(kind, T.StructType) or "coords" in kind.names
        part = lambda k: F.try_variant_get(column, f"$.{k}", lists) if variant else (column[k] if k in kind.names else F.lit(None).cast(lists))
        self.rings, self.paths = part("rings"), part("paths")
        self.curved = (V.has(column, "curveRings") | V.has(column, "curvePaths")) if variant else F.lit(False)
        self.x, self.y = number("x"), number("y")
        self.box = tuple(number(k) for k in ("xmin", "ymin", "xmax", "ymax"))


def _segments(lists: Column, closed: bool) -> Column:
    """``ARRAY<STRUCT<x1, y1, x2, y2>>`` of all paths or rings."""

    def of(line: Column) -> Column:
        n = F.size(line)
        following = lambda i: F.get(line, F.when(i + 1 < n, i + 1).otherwise(0))
        last = n - 1 if closed else n - 2
        edge = lambda i: F.struct(
            F.get(F.get(line, i), 0).alias("x1"), F.get(F.get(line, i), 1).alias("y1"),
            F.get(following(i), 0).alias("x2"), F.get(following(i), 1).alias("y2"),
        )
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), edge)).otherwise(F.array().cast(_SEGMENTS))

    return F.flatten(F.transform(lists, of))


_SEGMENTS = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


# Places closer than this share of a segment's length count as one.
_NEAR = 1e-9

# The relations of lines and areas are SQL texts over one struct ``g``: ``own`` (the
# feature's segments), ``edges`` and ``vertices`` (the filter's).  As texts they cost next
# to nothing to put together, however deep they nest.


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` computed once and named."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _meet(a: str, b: str) -> str:
    """Two segments share a point, be it an end."""

    def apart(c: str, d: str) -> str:
        high, low = (lambda v: f"greatest({v}.{c}, {v}.{d})"), (lambda v: f"least({v}.{c}, {v}.{d})")
        return f"{high(a)} < {low(b)} or {high(b)} < {low(a)}"

    def side(e: str, v: str, n: int) -> str:
        return f"signum(({e}.x2 - {e}.x1) * ({v}.y{n} - {e}.y1) - ({e}.y2 - {e}.y1) * ({v}.x{n} - {e}.x1))"

    across = lambda e, v: f"{side(e, v, 1)} * {side(e, v, 2)} <= 0"
    return f"(not ({apart('x1', 'x2')} or {apart('y1', 'y2')}) and {across(a, b)} and {across(b, a)})"


def _covered(segments: str, area: bool, x: str, y: str) -> str:
    """A point on the segments, or inside the area that they bound."""
    on = (
        f"exists({segments}, e -> {x} between least(e.x1, e.x2) and greatest(e.x1, e.x2) and {y} between least(e.y1, e.y2) and greatest(e.y1, e.y2)"
        f" and (e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1))"
    )
    crossed = f"(e.y1 > {y}) <> (e.y2 > {y}) and {x} < e.x1 + ({y} - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0D)"
    return f"({on} or size(filter({segments}, e -> {crossed})) % 2 = 1)" if area else on


def _along(edges: str, other: bool) -> str:
    """Edges seen from segment ``s``: where their lines meet, in shares of its length, and how they turn."""
    dx, dy, ex, ey, px, py = "(s.x2 - s.x1)", "(s.y2 - s.y1)", "(e.x2 - e.x1)", "(e.y2 - e.y1)", "(e.x1 - s.x1)", "(e.y1 - s.y1)"
    share = lambda n: f"((e.x{n} - s.x1) * {dx} + (e.y{n} - s.y1) * {dy}) / ({dx} * {dx} + {dy} * {dy})"
    turn = f"{dx} * {ey} - {dy} * {ex}"
    return (
        f"transform({edges}, e -> named_struct('other', {str(other).lower()}, 'x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2, 'turn', {turn}, "
        f"'off', {px} * {dy} - {py} * {dx}, 'at', ({px} * {ey} - {py} * {ex}) / nullif({turn}, 0D), 'first', {share(1)}, 'last', {share(2)}))"
    )


def _judged(segments: str, other: str) -> str:
    """Every part of the segments: does an edge of the other shape run along it (``on``), does that
    shape lie to its ``left`` and ``right``, and does its own (``own_left``, ``own_right``).

    Segments are cut wherever they meet an edge.  From the middle of a part, rays go to both
    sides at a right angle.  No edge but one along it meets the part, so what the rays count
    does not depend on how the middle was rounded.
    """
    cuts = (
        f"flatten(transform(near, e -> case when e.turn = 0 and e.off = 0 then array(e.first, e.last) "
        f"when e.off / nullif(e.turn, 0D) between -{_NEAR} and 1 + {_NEAR} then array(e.at) else cast(array() as array<double>) end))"
    )
    places = f"array_sort(array_distinct(concat(array(0D, 1D), filter({cuts}, t -> t > {_NEAR} and t < 1 - {_NEAR}))))"
    parts = f"filter(transform(sequence(1, size(places) - 1), i -> named_struct('a', places[i - 1], 'b', places[i])), p -> p.b - p.a > {_NEAR})"
    middle = (
        "named_struct('x', s.x1 + (p.a + p.b) / 2 * (s.x2 - s.x1), 'y', s.y1 + (p.a + p.b) / 2 * (s.y2 - s.y1), 'dx', s.x2 - s.x1, 'dy', s.y2 - s.y1)"
    )
    spans = f"e.turn = 0 and e.off = 0 and least(e.first, e.last) <= p.a + {_NEAR} and greatest(e.first, e.last) >= p.b - {_NEAR}"
    ahead = lambda n: f"(m.dx * (e.x{n} - m.x) + m.dy * (e.y{n} - m.y))"
    height = lambda n: f"(m.dx * (e.y{n} - m.y) - m.dy * (e.x{n} - m.x))"
    seen = (
        f"transform(near, e -> named_struct('other', e.other, 'on', {spans}, 'h', case when ({ahead(1)} > 0) <> ({ahead(2)} > 0) and not ({spans}) "
        f"then {height(1)} + ({height(2)} - {height(1)}) * {ahead(1)} / ({ahead(1)} - {ahead(2)}) end))"
    )
    odd = lambda other, test: f"size(filter(seen, h -> {other} and h.h {test} 0)) % 2 = 1"
    judged = (
        f"named_struct('on', exists(seen, h -> h.other and h.on), 'left', {odd('h.other', '>')}, 'right', {odd('h.other', '<')}, "
        f"'own_left', {odd('not h.other', '>')}, 'own_right', {odd('not h.other', '<')})"
    )
    of_part = _let(middle, "m", _let(seen, "seen", judged))
    of_segment = _let(f"concat({_along(segments, False)}, {_along(other, True)})", "near", _let(places, "places", f"transform({parts}, p -> {of_part})"))
    return f"flatten(transform({segments}, s -> {of_segment}))"


def _holds(outer: str, outer_area: bool, inner: str, inner_area: bool) -> str:
    """The inner shape lies in the outer one, and not only along its boundary."""
    if not outer_area:
        # a line holds only lines that run along it
        return "false" if inner_area else f"forall({_judged(inner, outer)}, q -> q.on)"
    if not inner_area:
        return _let(_judged(inner, outer), "qs", "forall(qs, q -> q.on or q.left) and exists(qs, q -> not q.on and q.left)")
    # wherever one boundary runs, what the inner area covers beside it the outer one covers too
    inside = "(q.on or q.left) and (not q.own_left or q.left) and (not q.own_right or q.right)"
    around = "(not q.left or q.own_left) and (not q.right or q.own_right)"
    return f"(forall({_judged(inner, outer)}, q -> {inside}) and forall({_judged(outer, inner)}, q -> {around}))"


def _shape_test(f: _Filter, area: bool, relation: str) -> str:
    """Line and area features against the filter."""
    if relation == "contains":
        return _holds("g.edges", f.is_area, "g.own", area) if f.edges else "false"
    if not f.edges:
        return f"{'forall' if relation == 'within' else 'exists'}(g.vertices, v -> {_covered('g.own', area, 'v.x', 'v.y')})"
    if relation == "within":
        return _holds("g.own", area, "g.edges", f.is_area)
    met = f"exists(g.own, a -> exists(g.edges, b -> {_meet('a', 'b')}))"
    if f.is_area:
        met += f" or exists(g.own, a -> {_covered('g.edges', True, 'a.x1', 'a.y1')})"
    if area:
        met += f" or exists(g.vertices, v -> {_covered('g.own', True, 'v.x', 'v.y')})"
    return f"({met})"


def _point_test(f: _Filter, x: Column, y: Column, relation: str) -> Column:
    if relation == "intersects":
        return f.covers(x, y)
    if relation == "contains":
        return f.holds(x, y)
    # a point holds nothing but itself
    return F.lit(not f.edges and len(f.vertices) == 1) & f.covers(x, y)


def _points_test(f: _Filter, points: Column, relation: str) -> Column:
    at = lambda test: lambda p: test(F.get(p, 0), F.get(p, 1))
    if relation == "intersects":
        return F.exists(points, at(f.covers))
    if relation == "contains":
        return F.forall(points, at(f.covers)) & F.exists(points, at(f.holds))
    if f.edges:
        return F.lit(False)
    return F.forall(f.vertex_array, lambda v: F.exists(points, lambda p: (F.get(p, 0) == v["x"]) & (F.get(p, 1) == v["y"])))


def _box_segments(box: tuple[Column, ...]) -> Column:
    x0, y0, x1, y1 = box
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    return F.array(*(
        F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")) for a, b in zip(corners, corners[1:] + corners[:1])
    ))


def _related_shapes(df: DataFrame, f: _Filter, feature: _Feature, relation: str) -> tuple[DataFrame, Column, list[str]]:
    """(rows with the segments of lines and areas, their relation to the filter, the columns added)."""
    taken = {c.lower() for c in df.columns}
    segments, area = "_segments", "_area"
    while segments in taken or area in taken:
        segments, area = segments + "_", area + "_"
    is_box, is_area = feature.box[0].isNotNull(), F.size(feature.rings) > 0
    found = (
        F.when(is_box, _box_segments(feature.box))
        .when(is_area, _segments(feature.rings, True))
        .when(F.size(feature.paths) > 0, _segments(feature.paths, False))
    )
    df = df.withColumn(segments, found).withColumn(area, F.coalesce(is_box | is_area, F.lit(False)))
    real = f"filter({segments}, s -> s.x1 <> s.x2 or s.y1 <> s.y2)"
    given = f"named_struct('own', {real}, 'edges', {_text(f.edges, _EDGE)}, 'vertices', {_text(f.vertices, ('x', 'y'))})"
    test = f"case when size(g.own) > 0 then case when {area} then {_shape_test(f, True, relation)} else {_shape_test(f, False, relation)} end end"
    # a shape without extent is its first point
    first = F.get(segments, 0)
    related = F.coalesce(F.expr(_let(given, "g", test)), _point_test(f, first["x1"], first["y1"], relation))
    return df, F.when(F.size(segments) > 0, related), [segments, area]


def spatial_filter(
    df: DataFrame,
    column: str,
    geometry: Any,
    in_sr: Any = None,
    relation: str = "intersects",
) -> DataFrame:
    """Rows whose geometry is related to ``geometry``.

    Point, multipoint, envelope, polyline and polygon features against filters of the
    same kinds.  Lines and areas are cut wherever they meet and judged part by part, so
    edges that lie on edges, shared corners and holes count as they should.  A line along
    the boundary of an area meets it and is not inside it.  Nothing is reprojected: with
    ``in_sr`` given, a feature that states another reference is an error, and so is a
    feature with curves.  A row without a geometry, or with an empty one, is related to
    nothing; a line or area without extent counts as a point.
    """
    if relation not in RELATIONS:
        raise ValueError(f"relation must be one of {sorted(RELATIONS)}, got {relation!r}")
    shape, kind, expected = filter_geometry(geometry, in_sr)
    wanted, f, feature = RELATIONS[relation], _Filter(shape, kind), _Feature(df, column)
    x, y = feature.x, feature.y
    related, added = F.when(x.isNotNull() & y.isNotNull(), _point_test(f, x, y, wanted)), []
    if feature.mixed:
        df, of_shapes, added = _related_shapes(df, f, feature, wanted)
        related = (
            related.when(feature.points.isNotNull(), (F.size(feature.points) > 0) & _points_test(f, feature.points, wanted))
            .when(feature.curved, F.raise_error(F.lit("features with curves cannot be evaluated here")).cast("boolean"))
            .otherwise(of_shapes)
        )
    related = F.coalesce(related, F.lit(False))
    differs = F.lit(False)
    if expected is not None:
        differs = F.coalesce(feature.srid != expected, F.lit(False))
        message = F.concat(F.lit(f"filter reference {expected}, feature reference "), feature.srid.cast("string"))
        related = F.when(differs, F.raise_error(message).cast("boolean")).otherwise(related)
    if wanted != "within":
        # The box by itself, so that it can reach the scan; whatever the exact test has to
        # see for another reason passes.
        near = f.in_box(x, y) | differs
        if feature.mixed:
            near = near | x.isNull() | y.isNull()
        df = df.where(near)
    return df.where(related).drop(*added)
