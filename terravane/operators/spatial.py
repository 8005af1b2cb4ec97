"""Spatial joins, snapping and overlays.

Candidates meet by an equi join on grid cells: every shape is listed under the
cells that its bounds touch, a pair is taken only in the cell that holds the
lower left corner of the bounds' common part, so that no pair is met twice, and
an exact test follows in Arrow batches. Shapes are rows findex, gtype, coords
(the shell, line or point), and optionally holes (array of rings); shapes of
several parts hold all of their rings, lines or points in rings instead. A
polygon's inside is what an odd number of its rings surround, so that holes and
parts need no order. Other kinds of shapes are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from terravane.functions import geometry as g

COORDS = "array<struct<x:double,y:double,z:double>>"


def rings_of(shapes: DataFrame) -> Column:
    """All rings, lines or points of a shape."""
    coords = F.array("coords")
    if "holes" in shapes.columns:
        coords = F.concat(coords, F.coalesce(F.col("holes"), F.array().cast(f"array<{COORDS}>")))
    return F.coalesce(F.col("rings"), coords) if "rings" in shapes.columns else coords


def bounds(shapes: DataFrame, grow: float = 0.0) -> DataFrame:
    low = lambda c: F.array_min(F.transform(F.flatten(rings_of(shapes)), lambda p: p[c])) - grow
    high = lambda c: F.array_max(F.transform(F.flatten(rings_of(shapes)), lambda p: p[c])) + grow
    return shapes.withColumns({"x0": low("x"), "y0": low("y"), "x1": high("x"), "y1": high("y")})


def candidates(main: DataFrame, sub: DataFrame, cell: float, grow: float = 0.0) -> DataFrame:
    """Pairs whose bounds, those of main grown, meet: columns l, l_rings, l_type, r, r_rings, r_type."""

    def cells(df: DataFrame, side: str, more: float) -> DataFrame:
        b = bounds(df, more).select(F.col("findex").alias(side), rings_of(df).alias(f"{side}_rings"), F.col("gtype").alias(f"{side}_type"), *[F.col(c).alias(f"{side}_{c}") for c in ("x0", "y0", "x1", "y1")])
        span = lambda c: F.sequence(F.floor(F.col(f"{side}_{c}0") / cell), F.floor(F.col(f"{side}_{c}1") / cell))
        return b.withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y")))

    met = cells(main, "l", grow).join(cells(sub, "r", 0.0), ["cx", "cy"])
    touch = (F.col("l_x0") <= F.col("r_x1")) & (F.col("r_x0") <= F.col("l_x1")) & (F.col("l_y0") <= F.col("r_y1")) & (F.col("r_y0") <= F.col("l_y1"))
    once = (F.floor(F.greatest("l_x0", "r_x0") / cell) == F.col("cx")) & (F.floor(F.greatest("l_y0", "r_y0") / cell) == F.col("cy"))
    return met.where(touch & once).select("l", "l_rings", "l_type", "r", "r_rings", "r_type")


def xyz(coords) -> np.ndarray:
    return np.array([(p["x"], p["y"], p["z"] if p["z"] is not None else np.nan) for p in coords], float).reshape(-1, 3)


#: Dimensions of the kinds of shapes.
KINDS = {"Point": 0, "MultiPoint": 0, "LineString": 1, "MultiLineString": 1, "LinearRing": 1, "Polygon": 2, "MultiPolygon": 2}


def _parts(rings, kind: str) -> tuple[int, list[np.ndarray]]:
    """Dimension, and rings, lines, or all points in one array."""
    if kind not in KINDS:
        raise ValueError(f"shapes of kind {kind} can't be compared")
    found = [xyz(r)[:, :2] for r in rings]
    if KINDS[kind] == 2:
        return 2, [g.closed(r) for r in found]
    lines = [r for r in found if len(r) > 1] if KINDS[kind] == 1 else []
    return (1, lines) if lines else (0, [np.concatenate(found)])


def polygons(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Rings by polygon, the shell first: one that an even number of others surround."""
    size = [abs(g.area(r)) for r in rings]
    within = [[j for j, o in enumerate(rings) if size[j] > size[i] and g.side(np.array([g.representative_point([r])]), [o])[0] > 0] for i, r in enumerate(rings)]
    out = {i: [r] for i, r in enumerate(rings) if len(within[i]) % 2 == 0}
    for i, r in enumerate(rings):
        if i not in out:
            out[min((j for j in within[i] if j in out), key=lambda j: size[j])].append(r)
    return list(out.values())


def _meet(a: list[np.ndarray], b: list[np.ndarray]) -> bool:
    return any(g.crossings(x, y) for x in a for y in b)


def _cut(a: list[np.ndarray], b: list[np.ndarray]) -> list[np.ndarray]:
    """Lines of a in pieces between where they meet lines of b."""
    return [p for x in a for p in g.split_at(x, [(i, t) for y in b for i, t, _, _ in g.crossings(x, y)])]


def _to_lines(points: np.ndarray, lines: list[np.ndarray]) -> np.ndarray:
    """Each point's least distance to the lines."""
    return np.min([g.point_segments(points, x).min(1) for x in lines], axis=0)


def distance(a: tuple[int, list], b: tuple[int, list]) -> float:
    """Least distance of two shapes, 0 if they meet."""
    (da, pa), (db, pb) = a, b
    some = lambda d, p: p[0] if d == 0 else np.array([x[0] for x in p])  # noqa: E731  a point of each part
    if da == 2 and (g.side(some(db, pb), pa) >= 0).any() or db == 2 and (g.side(some(da, pa), pb) >= 0).any():
        return 0.0
    if da and db and _meet(pa, pb):
        return 0.0
    if not da and not db:
        return float(np.hypot(*np.moveaxis(pa[0][:, None] - pb[0][None], 2, 0)).min())
    return float(min([_to_lines(x, pb).min() for x in pa if db] + [_to_lines(x, pa).min() for x in pb if da]))


def _inside(a: tuple[int, list], b: tuple[int, list]) -> tuple[bool, bool]:
    """Whether a lies in b, boundary included, and whether their interiors meet."""
    (da, pa), (db, pb) = a, b
    if db == 2:
        if da == 0:
            s = g.side(pa[0], pb)
            return bool((s >= 0).all()), bool((s > 0).any())
        sides = g.side(np.array([_middle(p) for p in _cut(pa, pb)]), pb)
        covered, inner = bool((sides >= 0).all()), bool((sides > 0).any())
        if da == 2:
            back = g.side(np.array([_middle(p) for p in _cut(pb, pa)]), pa)
            if (back > 0).any():  # beyond b's boundary there is something outside b
                return False, True
            if not inner:  # all on the boundary or outside: equal, a in a hole of b, b in a hole of a, or apart
                within = g.side(np.array([g.representative_point(p) for p in polygons(pa)]), pb) > 0
                return covered and bool(within.all()), bool(within.any())
        return covered, inner
    if da > db:
        return False, False
    if db == 1:
        if da == 0:
            on = _to_lines(pa[0], pb) <= g.EPS
            ends = np.array([x[k] for x in pb if not np.array_equal(x[0], x[-1]) for k in (0, -1)]).reshape(-1, 2)
            end = (np.abs(pa[0][:, None] - ends[None]).max(2) <= g.EPS).any(1) if len(ends) else np.zeros(len(on), bool)
            return bool(on.all()), bool((on & ~end).any())
        on = [bool(_to_lines(_middle(p)[None], pb).min() <= g.EPS) for p in _cut(pa, pb)]
        return all(on), any(on) or any(_interior(x, i, t) and _interior(y, j, u) for x in pa for y in pb for i, t, j, u in g.crossings(x, y))
    same = (np.abs(pa[0][:, None] - pb[0][None]).max(2) <= g.EPS).any(1)
    return bool(same.all()), bool(same.any())


def _interior(line: np.ndarray, k: int, t: float) -> bool:
    return np.array_equal(line[0], line[-1]) or not (k == 0 and t <= g.EPS or k == len(line) - 2 and t >= 1 - g.EPS)


def _middle(line: np.ndarray) -> np.ndarray:
    return (line[0] + line[1]) / 2


def relate(a: tuple[int, np.ndarray], b: tuple[int, np.ndarray], how: str) -> bool:
    """Whether the predicate holds between two shapes."""
    if how == "intersects":
        return distance(a, b) <= g.EPS
    if how in ("within", "covered_by", "contains", "covers"):
        x, y = (a, b) if how in ("within", "covered_by") else (b, a)
        covered, inner = _inside(x, y)
        return covered and (inner or how in ("covered_by", "covers"))
    if how == "equals":
        return a[0] == b[0] and _inside(a, b)[0] and _inside(b, a)[0]
    if distance(a, b) > g.EPS:
        return False
    (ca, ia), (cb, ib) = _inside(a, b), _inside(b, a)
    inner = ia or ib
    if how == "touches":
        return not inner
    along = lambda: any(_to_lines(_middle(p)[None], b[1]).min() <= g.EPS for p in _cut(a[1], b[1]))
    if how == "crosses":
        if a[0] == b[0] == 1:
            return inner and not along()
        low = ca if a[0] < b[0] else cb
        return a[0] != b[0] and inner and not low
    if how == "overlaps":
        return a[0] == b[0] and inner and (a[0] != 1 or along()) and not ca and not cb
    raise ValueError(f"no such predicate: {how}")


def _tested(pairs: DataFrame, test: Callable[[tuple, tuple], float | None]) -> DataFrame:
    """l, r, measure of the pairs for which test gives a number."""
    kinds = {f.name: f.dataType for f in pairs.schema}
    schema = T.StructType([T.StructField("l", kinds["l"]), T.StructField("r", kinds["r"]), T.StructField("measure", T.DoubleType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = [test(_parts(a, ta), _parts(b, tb)) for a, ta, b, tb in zip(f["l_rings"], f["l_type"], f["r_rings"], f["r_type"], strict=True)]
            keep = [i for i, m in enumerate(found) if m is not None]
            yield pd.DataFrame({"l": f["l"].iloc[keep], "r": f["r"].iloc[keep], "measure": [found[i] for i in keep]})

    return pairs.mapInPandas(run, schema)


def predicate_pairs(main: DataFrame, sub: DataFrame, how: str, cell: float, tolerance: float = 0.0) -> DataFrame:
    """Pairs (l, r) for which the predicate holds; intersects may allow a distance."""
    if tolerance < 0:
        raise ValueError("a negative tolerance")
    test = (lambda a, b: 1.0 if distance(a, b) <= tolerance + g.EPS else None) if how == "intersects" else (lambda a, b: 1.0 if relate(a, b, how) else None)
    return _tested(candidates(main, sub, cell, tolerance), test).select("l", "r")


def _one_point(shapes: DataFrame) -> Column:
    rings = rings_of(shapes)
    return F.coalesce((F.col("gtype") == "Point") & (F.size(rings) == 1) & (F.size(F.get(rings, F.lit(0))) == 1), F.lit(False))


def point_pairs(main: DataFrame, sub: DataFrame, reach: float, cell: float) -> DataFrame:
    """l, r, distance of points no farther apart than reach, in built-in expressions: a point of main is listed under all cells that it reaches, one of sub under its own."""
    most = reach + g.EPS

    def points(df: DataFrame, side: str) -> DataFrame:
        p = F.get(F.get(rings_of(df), F.lit(0)), F.lit(0))
        return df.where(_one_point(df)).select(F.col("findex").alias(side), p["x"].alias(f"{side}x"), p["y"].alias(f"{side}y"))

    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - most) / cell), F.floor((F.col(c) + most) / cell)))
    left = points(main, "l").where("lx is not null and ly is not null").withColumn("cx", span("lx")).withColumn("cy", span("ly"))
    right = points(sub, "r").withColumns({"cx": F.floor(F.col("rx") / cell), "cy": F.floor(F.col("ry") / cell)})
    apart = lambda c: F.col(f"l{c}") - F.col(f"r{c}")
    # few bytes make many pairs: a number that is given keeps rows from being gathered into a few tasks
    left = left.repartition(int(main.sparkSession.conf.get("spark.sql.shuffle.partitions")), "l", "cx", "cy")
    return left.join(right, ["cx", "cy"]).select("l", "r", F.sqrt(apart("x") * apart("x") + apart("y") * apart("y")).alias("distance")).where(F.col("distance") <= most)


def distance_pairs(main: DataFrame, sub: DataFrame, reach: float, cell: float) -> DataFrame:
    """l, r, distance of pairs no farther apart than reach; all but pairs of points are measured in Arrow batches."""
    test = lambda a, b: d if (d := distance(a, b)) <= reach + g.EPS else None
    out = point_pairs(main, sub, reach, cell)
    for m, s in ((main.where(~_one_point(main)), sub), (main.where(_one_point(main)), sub.where(~_one_point(sub)))):
        out = out.unionAll(_tested(candidates(m, s, cell, reach), test).withColumnRenamed("measure", "distance"))
    return out


def package(pairs: DataFrame, main: DataFrame, output: str = "pairs", include_empty: bool = False) -> DataFrame:
    """Pairs as rows, or a list of partners for each main row, empty ones only on request."""
    if output == "pairs":
        return pairs
    lists = pairs.groupBy("l").agg(F.array_sort(F.collect_list("r")).alias("r"))
    return main.select(F.col("findex").alias("l")).join(lists, "l", "left") if include_empty else lists


def extract_by_location(target: DataFrame, compare: DataFrame, how: str, cell: float) -> DataFrame:
    """Target rows within, or intersecting, any shape of compare; another condition keeps all."""
    if how not in ("within", "intersects"):
        return target
    found = predicate_pairs(target, compare, how, cell).select(F.col("l").alias("findex")).distinct()
    return target.join(found, "findex", "left_semi")


def spatial_left_join(base: DataFrame, target: DataFrame, cell: float) -> DataFrame:
    """l, r: targets within each base polygon, null where there are none."""
    inside = predicate_pairs(target, base, "within", cell).select(F.col("r").alias("l"), F.col("l").alias("r"))
    return base.select(F.col("findex").alias("l")).join(inside, "l", "left")


def most_intersecting(main: DataFrame, sub: DataFrame, cell: float) -> DataFrame:
    """For each main shape the sub shape with the greatest common area or length; ties go to the least (x, y) of its bounds."""

    def common(a: tuple, b: tuple) -> float | None:
        if distance(a, b) > g.EPS:
            return None
        if a[0] == b[0] == 2:
            return g.rings_area(g.overlay(polygons(a[1]), polygons(b[1]), "intersection"))
        line, other = (a[1], b) if a[0] == 1 else (b[1], a)
        if max(a[0], b[0]) == 2 and min(a[0], b[0]) == 1:
            return float(sum(g.length(p) for p in _cut(line, other[1]) if g.side(_middle(p), other[1])[0] >= 0))
        if a[0] == b[0] == 1:
            return float(sum(g.length(p) for p in _cut(a[1], b[1]) if _to_lines(_middle(p)[None], b[1]).min() <= g.EPS))
        return 0.0

    pairs = _tested(candidates(main, sub, cell), common).join(bounds(sub).select(F.col("findex").alias("r"), "x0", "y0"), "r")
    w = Window.partitionBy("l").orderBy(F.desc("measure"), "x0", "y0", "r")
    return pairs.withColumn("__n", F.row_number().over(w)).where("__n = 1").select("l", "r", "measure")


def overlay_pairs(main: DataFrame, sub: DataFrame, pairs: DataFrame, how: str) -> DataFrame:
    """Polygon overlays of pairs: union, intersection and symmetric_difference (main less all subs) give a result a main shape, difference and clip one a pair.

    Rows: l, r (null for results a main shape), ring, rings as coords; shells anticlockwise, holes clockwise.
    """
    full = pairs.where("r is not null").join(main.select(F.col("findex").alias("l"), rings_of(main).alias("a")), "l").join(sub.select(F.col("findex").alias("r"), rings_of(sub).alias("b")), "r")
    kinds = {f.name: f.dataType for f in full.schema}
    schema = T.StructType([T.StructField("l", kinds["l"]), T.StructField("r", kinds["r"]), T.StructField("ring", T.IntegerType()), T.StructField("coords", kinds["a"].elementType), T.StructField("area", T.DoubleType())])

    def rows(l, r, rings: list[np.ndarray]) -> list[dict]:  # noqa: E741
        return [{"l": l, "r": r, "ring": i, "coords": [{"x": float(x), "y": float(y), "z": 0.0} for x, y in ring], "area": g.area(ring)} for i, ring in enumerate(rings)]

    every = lambda rings: polygons([xyz(r) for r in rings])

    if how in ("difference", "clip"):

        def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                out = []
                for l, r, a, b in zip(f["l"], f["r"], f["a"], f["b"], strict=True):  # noqa: E741
                    rings = g.overlay(every(a), every(b), "difference" if how == "difference" else "intersection")
                    out += rows(l, r, rings if how == "difference" else rings[:1])
                yield pd.DataFrame(out, columns=["l", "r", "ring", "coords", "area"])

        return full.mapInPandas(each, schema)

    def whole(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("r")
        a = every(f["a"].iloc[0])
        done: list[list[np.ndarray]] = a if how != "intersection" else []
        for b in f["b"]:
            if how == "union":
                done = g.as_polygons(g.overlay(done, every(b), "union"))
            elif how == "intersection":
                part = g.as_polygons(g.overlay(a, every(b), "intersection"))
                done = g.as_polygons(g.overlay(done, part, "union")) if done and part else done or part
            else:
                done = g.as_polygons(g.overlay(done, every(b), "difference"))
        return pd.DataFrame(rows(f["l"].iloc[0], None, [r for p in done for r in g._oriented(p)]), columns=["l", "r", "ring", "coords", "area"])

    return full.groupBy("l").applyInPandas(whole, schema)


def circle_shapes(shapes: DataFrame, tolerance: float, output: str = "is_circle") -> DataFrame:
    """Marks closed shapes of 4 points or more that differ from the circle of equal perimeter by less than tolerance of their area."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            found = []
            for c in f["coords"]:
                a = xyz(c)[:, :2]
                found.append(bool(len(a) >= 4 and np.array_equal(a[0], a[-1]) and g.circle_likeness(a) < tolerance))
            f[output] = found
            yield f

    return shapes.mapInPandas(run, T.StructType([*shapes.schema.fields, T.StructField(output, T.BooleanType())]))


# points and segments, in built-in expressions ------------------------------------------------------


def segments(vertices: DataFrame) -> DataFrame:
    """line, seq, ax, ay, az, bx, by, bz."""
    w = Window.partitionBy("findex").orderBy("seq")
    return vertices.select(F.col("findex").alias("line"), "seq", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), F.lead("x").over(w).alias("bx"), F.lead("y").over(w).alias("by"), F.lead("z").over(w).alias("bz")).where("bx is not null")


def nearest_segments(points: DataFrame, vertices: DataFrame, reach: float, best_only: bool = True) -> DataFrame:
    """point, line, seq, t, x, y, distance: where on the lines within reach each point's nearest position lies (on each line, or the best; ties: least line)."""
    cell = reach
    seg = segments(vertices)
    span = lambda a, b: F.sequence(F.floor((F.least(a, b)) / cell), F.floor(F.greatest(a, b) / cell))
    seg = seg.withColumn("cx", F.explode(span("ax", "bx"))).withColumn("cy", F.explode(span("ay", "by")))
    own = points.select(F.col("findex").alias("point"), F.col("x").alias("px"), F.col("y").alias("py"))
    near = F.array(*[F.struct((F.floor(F.col("px") / cell) + i).alias("cx"), (F.floor(F.col("py") / cell) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    met = own.select("*", F.inline(near)).join(seg, ["cx", "cy"])
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    n = dx * dx + dy * dy
    t = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("px") - F.col("ax")) * dx + (F.col("py") - F.col("ay")) * dy) / n)))
    found = met.withColumn("t", t).withColumns({"x": F.col("ax") + F.col("t") * dx, "y": F.col("ay") + F.col("t") * dy})
    found = found.withColumn("distance", F.sqrt(F.pow(F.col("px") - F.col("x"), 2) + F.pow(F.col("py") - F.col("y"), 2))).where(F.col("distance") <= reach)
    keys = ["point"] if best_only else ["point", "line"]
    best = F.min(F.struct("distance", "line", "seq", "t", "x", "y"))
    return found.groupBy(*keys).agg(best.alias("b")).select("point", "b.line", "b.seq", "b.t", "b.x", "b.y", "b.distance")


def join_by_nearest(points: DataFrame, vertices: DataFrame, reach: float) -> DataFrame:
    """Pairs (l point, r line) of each point with its nearest line within reach; points without one give nothing."""
    return nearest_segments(points, vertices, reach).select(F.col("point").alias("l"), F.col("line").alias("r"))


def snap_points(points: DataFrame, vertices: DataFrame, reach: float) -> DataFrame:
    """Points moved in XY to the nearest position on a line within reach; z stays."""
    to = nearest_segments(points, vertices, reach).select(F.col("point").alias("findex"), F.col("x").alias("__x"), F.col("y").alias("__y"))
    return points.join(to, "findex", "left").withColumns({"x": F.coalesce("__x", "x"), "y": F.coalesce("__y", "y")}).select(points.columns)


def insert_snapped(points: DataFrame, vertices: DataFrame, reach: float, least: float) -> DataFrame:
    """Lines with snapped points as new vertices, unless a vertex is closer than least."""
    w = Window.partitionBy("findex").orderBy("seq")
    at = nearest_segments(points, vertices, reach)
    seg = segments(vertices).select("line", "seq", "ax", "ay", "az", "bx", "by", "bz")
    new = at.join(seg, ["line", "seq"]).where((F.sqrt(F.pow(F.col("x") - F.col("ax"), 2) + F.pow(F.col("y") - F.col("ay"), 2)) >= least) & (F.sqrt(F.pow(F.col("x") - F.col("bx"), 2) + F.pow(F.col("y") - F.col("by"), 2)) >= least))
    new = new.select(F.col("line").alias("findex"), (F.col("seq") + F.col("t") * 0.999999).alias("__at"), "x", "y", (F.col("az") + F.col("t") * (F.col("bz") - F.col("az"))).alias("z")).distinct()
    both = vertices.select("findex", F.col("seq").cast("double").alias("__at"), "x", "y", "z").unionByName(new)
    return both.select("findex", (F.row_number().over(w.orderBy("__at")) - 1).alias("seq"), "x", "y", "z")


def touching_ends(main: DataFrame, sub: DataFrame, tolerance: float) -> DataFrame:
    """l, r, end (0 first, 1 last), x, y: line ends of sub within tolerance of main lines, with the position on main."""
    ends = sub.groupBy("findex").agg(F.min_by(F.struct("x", "y"), "seq").alias("a"), F.max_by(F.struct("x", "y"), "seq").alias("b"))
    points = ends.select(F.col("findex").alias("r"), F.inline(F.array(F.struct(F.lit(0).alias("end"), F.col("a.x").alias("x"), F.col("a.y").alias("y")), F.struct(F.lit(1).alias("end"), F.col("b.x").alias("x"), F.col("b.y").alias("y")))))
    keyed = points.withColumn("findex", F.struct("r", "end"))
    return nearest_segments(keyed, main, max(tolerance, 1e-9), best_only=False).select(F.col("line").alias("l"), F.col("point.r").alias("r"), F.col("point.end").alias("end"), "x", "y")


def cascade_touches(main: DataFrame, sub: DataFrame, cell: float, tolerance: float = 0.0, steps: int | None = None) -> DataFrame:
    """l, r, step: subs reached from each main shape over touching subs, breadth first, each at its first step. steps: where to stop, if at all."""
    from terravane.plans.lineage import cut

    front = cut(predicate_pairs(main, sub, "intersects", cell, tolerance).withColumn("step", F.lit(1)))
    edges = cut(predicate_pairs(sub, sub, "intersects", cell, tolerance).where("l <> r").select(F.col("l").alias("from"), F.col("r").alias("to")))
    seen = front
    for k in count(2) if steps is None else range(2, steps + 1):
        new = front.join(edges, front["r"] == edges["from"]).select("l", F.col("to").alias("r")).distinct().join(seen.select("l", "r"), ["l", "r"], "left_anti").withColumn("step", F.lit(k))
        front = cut(new)
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def match_control_points(subjective: DataFrame, objective: DataFrame, reach: float, angle_limit: float, difference: float) -> DataFrame:
    """l, r: 1:1 matches of line vertices (point: findex and seq) within reach, whose adjacent segments' directions differ by less than `difference` degrees and whose own angle is below the limit.

    Greedy by distance within a round: a pair is taken if each is the other's best; rounds go on until none is left.
    """
    from terravane.plans.lineage import cut

    def corners(v: DataFrame, side: str) -> DataFrame:
        w = Window.partitionBy("findex").orderBy("seq")
        back = F.atan2(F.col("y") - F.lag("y").over(w), F.col("x") - F.lag("x").over(w))
        ahead = F.atan2(F.lead("y").over(w) - F.col("y"), F.lead("x").over(w) - F.col("x"))
        rows = v.select(F.struct("findex", "seq").alias(side), "x", "y", F.degrees(back).alias("back"), F.degrees(ahead).alias("ahead")).where("back is not null and ahead is not null")
        inner = F.lit(180.0) - F.abs(F.pmod(F.col("ahead") - F.col("back") + 180, F.lit(360.0)) - 180)
        return rows.where(inner < angle_limit).select(side, *[F.col(c).alias(f"{side}_{c}") for c in ("x", "y", "back", "ahead")])

    near = F.array(*[F.struct((F.floor(F.col("l_x") / reach) + i).alias("cx"), (F.floor(F.col("l_y") / reach) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = corners(subjective, "l").select("*", F.inline(near))
    b = corners(objective, "r").withColumns({"cx": F.floor(F.col("r_x") / reach), "cy": F.floor(F.col("r_y") / reach)})
    turn = lambda c: F.abs(F.pmod(F.col(f"l_{c}") - F.col(f"r_{c}") + 180, F.lit(360.0)) - 180)
    pairs = a.join(b, ["cx", "cy"]).withColumn("d", F.sqrt(F.pow(F.col("l_x") - F.col("r_x"), 2) + F.pow(F.col("l_y") - F.col("r_y"), 2)))
    left = cut(pairs.where((F.col("d") <= reach) & (turn("back") < difference) & (turn("ahead") < difference)).select("l", "r", "d"))
    done = None
    while not left.isEmpty():
        bl = left.withColumn("n", F.row_number().over(Window.partitionBy("l").orderBy("d", "r"))).where("n = 1").select("l", "r", "d")
        br = left.withColumn("n", F.row_number().over(Window.partitionBy("r").orderBy("d", "l"))).where("n = 1").select("l", "r")
        best = cut(bl.join(br, ["l", "r"]))
        done = best if done is None else done.unionByName(best)
        left = cut(left.join(best.select("l"), "l", "left_anti").join(best.select("r"), "r", "left_anti"))
    return done if done is not None else left
