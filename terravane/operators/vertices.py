"""Operators on vertex tables (findex, seq, x, y, z): constructors, measures and affine changes, all as windows or array functions.

Geometry columns, where rows hold whole shapes, are arrays of parts, and parts
arrays of struct<x, y, z>; a vertex table is the default form.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window



def by_seq():
    return Window.partitionBy("findex").orderBy("seq")


def point() -> Column:
    return F.struct("x", "y", "z")

NO_Z = -9999.0
#: Metres of a unit.
UNITS = {"mm": 0.001, "cm": 0.01, "dm": 0.1, "m": 1.0, "km": 1000.0, "degree": 1.0, "Meter": 1.0, "Millimeter": 0.001, "Inch": 0.0254}


def to_coords(vertices: DataFrame, gtype: str = "LineString") -> DataFrame:
    """A row a shape: findex, gtype, coords in order of seq."""
    return vertices.groupBy("findex").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y", "z"))), lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"), v["z"].alias("z"))).alias("coords")).withColumn("gtype", F.lit(gtype)).select("findex", "gtype", "coords")


def to_vertices(shapes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return shapes.select("findex", *(keep or []), F.posexplode("coords").alias("seq", "v")).select("findex", *(keep or []), "seq", "v.x", "v.y", "v.z")


def explode_parts(shapes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Multi-part shapes (parts: array of coords) as single ones: the part's place is `part`."""
    return shapes.select("findex", *(keep or []), F.regexp_replace("gtype", "^Multi", "").alias("gtype"), F.posexplode("parts").alias("part", "coords"))


def singleparts(shapes: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """explode_parts with a fresh findex from 0, numbered without gathering rows: rows are numbered within ranges of findex."""
    from terravane.plans.numbering import numbered

    return numbered(explode_parts(shapes, keep).withColumnRenamed("findex", "source_findex"), ["source_findex", "part"], "findex")


def vertices_by_type(vertices: DataFrame, header: DataFrame, kind: str, codes: dict[str, str], unit: str = "m") -> dict[str, DataFrame]:
    """Shapes by their header's type code, with z 0 and coordinates in metres: one table a type."""
    k = UNITS[unit]
    scaled = vertices.select("findex", "seq", (F.col("x") * k).alias("x"), (F.col("y") * k).alias("y"), F.lit(0.0).alias("z"))
    shapes = to_coords(scaled).drop("gtype").join(header.select("findex", F.col(kind).cast("string").alias("__kind")), "findex")
    out = {}
    for name, code in codes.items():
        coords = close_ring("coords") if name == "Polygon" else F.col("coords")
        out[name] = shapes.where(F.col("__kind") == str(code)).select("findex", F.lit(name).alias("gtype"), coords.alias("coords"))
    return out


def close_ring(coords: str) -> Column:
    c = F.col(coords)
    return F.when(F.element_at(c, 1) != F.element_at(c, -1), F.concat(c, F.slice(c, 1, 1))).otherwise(c)


def with_z(vertices: DataFrame, default: float = NO_Z) -> DataFrame:
    return vertices.withColumn("z", F.coalesce("z", F.lit(default)))


def densify(vertices: DataFrame, interval: float) -> DataFrame:
    """Cuts segments longer than interval (in XY) into equal parts no longer than it; z is linear. seq is renumbered."""
    nxt = F.lead(point()).over(by_seq())
    d = F.sqrt(F.pow(F.col("n.x") - F.col("x"), 2) + F.pow(F.col("n.y") - F.col("y"), 2))
    rows = vertices.withColumn("n", nxt).withColumn("k", F.greatest(F.lit(1), F.coalesce(F.ceil(d / interval), F.lit(1))).cast("int"))
    out = rows.select("findex", "seq", "x", "y", "z", "n", "k", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("i"))
    at = lambda c: F.when(F.col("i") == 0, F.col(c)).otherwise(F.col(c) + (F.col(f"n.{c}") - F.col(c)) * F.col("i") / F.col("k"))
    new = F.row_number().over(Window.partitionBy("findex").orderBy("seq", "i")) - 1
    return out.select("findex", new.alias("seq"), at("x").alias("x"), at("y").alias("y"), at("z").alias("z"))


def lines_to_polygons(shapes: DataFrame, skip_invalid: bool = False) -> DataFrame:
    """Closed rings of lines; a ring under 4 points fails, or is left out with skip_invalid."""
    ring = close_ring("coords")
    rows = shapes.withColumn("coords", ring).withColumn("gtype", F.lit("Polygon"))
    if skip_invalid:
        return rows.where(F.size("coords") >= 4)
    return rows.withColumn("coords", F.when(F.size("coords") >= 4, F.col("coords")).otherwise(F.raise_error(F.lit("not a polygon")).cast(dict(rows.dtypes)["coords"])))


def points_to_depth_lines(points: DataFrame, depth: str, unit: str = "m") -> DataFrame:
    """A vertical line from each point down to z - depth."""
    d = F.col(depth).cast("double") * UNITS[unit]
    return points.select("findex", F.inline(F.array(F.struct(F.lit(0).alias("seq"), F.col("x"), F.col("y"), F.col("z")), F.struct(F.lit(1).alias("seq"), F.col("x"), F.col("y"), (F.col("z") - d).alias("z")))))


def offset(vertices: DataFrame, dx: float = 0.0, dy: float = 0.0, dz: float = 0.0) -> DataFrame:
    return vertices.withColumns({"x": F.col("x") + dx, "y": F.col("y") + dy, "z": F.col("z") + dz})


def rotate(vertices: DataFrame, degrees: float, direction: str = "left", centre: str = "centroid") -> DataFrame:
    """Turns all vertices about the centre of their bounds or the origin; a text's `rotation` turns with it."""
    t = math.radians(degrees if direction == "left" else -degrees)
    if centre == "origin":
        cx, cy, rows = F.lit(0.0), F.lit(0.0), vertices
    else:
        middle = vertices.agg(((F.min("x") + F.max("x")) / 2).alias("__cx"), ((F.min("y") + F.max("y")) / 2).alias("__cy"))
        rows, cx, cy = vertices.crossJoin(F.broadcast(middle)), F.col("__cx"), F.col("__cy")  # one row
    dx, dy = F.col("x") - cx, F.col("y") - cy
    out = rows.withColumns({"x": cx + dx * math.cos(t) - dy * math.sin(t), "y": cy + dx * math.sin(t) + dy * math.cos(t)})
    if "rotation" in vertices.columns:
        out = out.withColumn("rotation", F.col("rotation") + (degrees if direction == "left" else -degrees))
    return out.select(vertices.columns)


def _corner(prefix: str, corner: str) -> tuple[Column, Column]:
    x = {"left": F.col(f"{prefix}x_min"), "right": F.col(f"{prefix}x_max"), "center": (F.col(f"{prefix}x_min") + F.col(f"{prefix}x_max")) / 2}
    y = {"top": F.col(f"{prefix}y_max"), "bottom": F.col(f"{prefix}y_min"), "center": (F.col(f"{prefix}y_min") + F.col(f"{prefix}y_max")) / 2}
    v, h = ("center", "center") if corner == "center" else corner.split("-")
    return x[h], y[v]


def _bounds(vertices: DataFrame, prefix: str) -> DataFrame:
    return vertices.agg(*[f(c).alias(f"{prefix}{c}_{n}") for c in "xy" for f, n in ((F.min, "min"), (F.max, "max"))])


def align_grid(vertices: DataFrame, mesh: DataFrame, scale: float = 1.0, origin_x: float = 0.0, origin_y: float = 0.0, flip_x: bool = False, flip_y: bool = False, corner: str = "bottom-left") -> DataFrame:
    """Moves and scales vertices so that the corner of their bounds meets that of the mesh's bounds plus the origin."""
    rows = vertices.crossJoin(F.broadcast(_bounds(vertices, "__s_"))).crossJoin(F.broadcast(_bounds(mesh, "__m_")))  # one row each
    (sx, sy), (mx, my) = _corner("__s_", corner), _corner("__m_", corner)
    return rows.withColumns({"x": mx + origin_x + (F.col("x") - sx) * scale * (-1 if flip_x else 1), "y": my + origin_y + (F.col("y") - sy) * scale * (-1 if flip_y else 1)}).select(vertices.columns)


def set_spatial_definition(vertices: DataFrame, x: float, y: float, shift_x: float = 0.0, shift_y: float = 0.0, scale: float = 1.0, position: str = "center") -> DataFrame:
    """Moves the chosen position of the bounds to (x, y), shifts, then scales about (0, 0)."""
    rows = vertices.crossJoin(F.broadcast(_bounds(vertices, "__s_")))  # one row
    sx, sy = _corner("__s_", position)
    return rows.withColumns({"x": (F.col("x") - sx + x + shift_x) * scale, "y": (F.col("y") - sy + y + shift_y) * scale}).select(vertices.columns)


def add_vertical_lines(vertices: DataFrame, decimals: int = 3) -> tuple[DataFrame, DataFrame]:
    """New vertical lines where line ends share XY, cut to decimals, but not z; and pairs (l new, r source). New keys follow the greatest old one."""
    from terravane.plans.numbering import numbered

    ends = vertices.groupBy("findex").agg(F.min_by(point(), "seq").alias("a"), F.max_by(point(), "seq").alias("b"))
    ends = ends.select("findex", F.inline(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("p")), F.struct(F.lit(1).alias("side"), F.col("b").alias("p"))))).select("findex", "side", "p.*")
    k = 10.0**decimals
    cut = lambda c: F.when(c < 0, F.ceil(c * k)).otherwise(F.floor(c * k)).cast("long")
    w = Window.partitionBy(cut(F.col("x")), cut(F.col("y"))).orderBy("z", "findex", "side")
    gaps = ends.withColumn("z2", F.lead("z").over(w)).where("z2 > z").select(F.col("findex").alias("source"), "x", "y", "z", "z2")
    last = vertices.agg(F.max("findex").alias("__last"))
    rows = numbered(gaps, ["source", "x", "y", "z"], "__n").crossJoin(F.broadcast(last)).withColumn("findex", F.col("__last") + 1 + F.col("__n"))  # one row
    lines = rows.select("findex", F.inline(F.array(*[F.struct(F.lit(i).alias("seq"), F.col("x"), F.col("y"), F.col(z).alias("z")) for i, z in enumerate(("z", "z2"))])))
    return lines, rows.select(F.col("findex").alias("l"), F.col("source").alias("r"))


def drop_close_vertices(vertices: DataFrame, distance: float) -> DataFrame:
    """Keys of lines that have neighbouring vertices closer than distance."""
    d = F.sqrt(F.pow(F.lead("x").over(by_seq()) - F.col("x"), 2) + F.pow(F.lead("y").over(by_seq()) - F.col("y"), 2))
    return vertices.select("findex", d.alias("d")).where(F.col("d") < distance).select("findex").distinct()


def range_polygons(vertices: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The bounding rectangle of each key as a closed ring."""
    b = vertices.groupBy(*(by or ["findex"])).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    ring = F.array(*[F.struct(F.lit(i).alias("seq"), F.col(x).alias("x"), F.col(y).alias("y"), F.lit(0.0).alias("z")) for i, (x, y) in enumerate((("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")))])
    return b.select(*(by or ["findex"]), F.inline(ring))


def ring_area(vertices: DataFrame) -> DataFrame:
    """Signed area (positive: anticlockwise) and perimeter of each closed ring."""
    cross = F.col("x") * F.lead("y").over(by_seq()) - F.lead("x").over(by_seq()) * F.col("y")
    d = F.sqrt(F.pow(F.lead("x").over(by_seq()) - F.col("x"), 2) + F.pow(F.lead("y").over(by_seq()) - F.col("y"), 2))
    return vertices.select("findex", cross.alias("c"), d.alias("d")).groupBy("findex").agg((F.sum("c") / 2).alias("area"), F.sum("d").alias("perimeter"))


def check_shapes(vertices: DataFrame, distance: float) -> DataFrame:
    """findex, problem, n: closure and orientation of rings, repeated vertices, spacing."""
    nxt, dist = F.lead(point()).over(by_seq()), F.sqrt(F.pow(F.lead("x").over(by_seq()) - F.col("x"), 2) + F.pow(F.lead("y").over(by_seq()) - F.col("y"), 2))
    rows = vertices.select("findex", "seq", "x", "y", (F.struct("x", "y", "z") == nxt).alias("same"), (dist < distance).alias("close"), (F.col("x") * F.lead("y").over(by_seq()) - F.lead("x").over(by_seq()) * F.col("y")).alias("cross"))
    by = rows.groupBy("findex").agg(
        F.count_if("same").alias("repeated_vertex"), F.count_if("close").alias("too_close"), (F.min_by(F.struct("x", "y"), "seq") != F.max_by(F.struct("x", "y"), "seq")).cast("long").alias("not_closed"), (F.sum("cross") < 0).cast("long").alias("clockwise"), (F.count("*") < 4).cast("long").alias("too_few_vertices")
    )
    names = ("repeated_vertex", "too_close", "not_closed", "clockwise", "too_few_vertices")
    return by.select("findex", F.inline(F.array(*[F.struct(F.lit(n).alias("problem"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("n")) for n in names]))).where("n > 0")


def duplicate_shapes(vertices: DataFrame) -> DataFrame:
    """Groups of equal shapes, either way round: the least findex, and the others."""
    text = lambda asc: F.concat_ws(";", F.transform(F.sort_array(F.collect_list(F.struct((F.col("seq") if asc else -F.col("seq")).alias("seq"), "x", "y", "z")), True), lambda v: F.concat_ws(",", v["x"], v["y"], v["z"])))
    shapes = vertices.groupBy("findex").agg(F.least(text(True), text(False)).alias("shape"))
    first = shapes.groupBy("shape").agg(F.min("findex").alias("first"))
    return shapes.join(first, "shape").where("findex > first").select("first", "findex")


# z values -----------------------------------------------------------------------------------------


def estimate_z(vertices: DataFrame) -> DataFrame:
    """Interior z, linear in planar distance between the ends' z; two-point lines stay."""
    whole = Window.partitionBy("findex")
    d = F.coalesce(F.sqrt(F.pow(F.col("x") - F.lag("x").over(by_seq()), 2) + F.pow(F.col("y") - F.lag("y").over(by_seq()), 2)), F.lit(0.0))
    rows = vertices.withColumn("__d", d)
    rows = rows.withColumns({"__at": F.sum("__d").over(by_seq().rowsBetween(Window.unboundedPreceding, 0)), "__total": F.sum("__d").over(whole), "__a": F.min_by("z", "seq").over(whole), "__b": F.max_by("z", "seq").over(whole), "__first": F.min("seq").over(whole), "__last": F.max("seq").over(whole)})
    inner = (F.col("seq") != F.col("__first")) & (F.col("seq") != F.col("__last")) & (F.col("__total") > 0)
    return rows.withColumn("z", F.when(inner, F.col("__a") + (F.col("__b") - F.col("__a")) * F.col("__at") / F.col("__total")).otherwise(F.col("z"))).select(vertices.columns)


def z_by_covering(vertices: DataFrame, constant: float | None = None, covering: DataFrame | None = None, width: DataFrame | None = None) -> DataFrame:
    """z - earth covering (a constant, or a column `covering` by key) + half the width (a column `width` by key)."""
    if constant is not None and covering is not None:
        raise ValueError("either a constant or a table of coverings")
    rows, change = vertices, F.lit(-float(constant or 0))
    if covering is not None:
        rows = rows.join(covering.select("findex", F.col("covering").cast("double").alias("__cover")), "findex", "left")
        change = -F.coalesce("__cover", F.lit(0.0))
    if width is not None:
        rows = rows.join(width.select("findex", F.col("width").cast("double").alias("__width")), "findex", "left")
        change = change + F.coalesce(F.col("__width") / 2, F.lit(0.0))
    return rows.withColumn("z", F.col("z") + change).select(vertices.columns)


def subtract_depth(vertices: DataFrame, depths: DataFrame) -> DataFrame:
    """Takes start_depth from a line's first z and end_depth from its last."""
    whole = Window.partitionBy("findex")
    rows = vertices.join(depths.select("findex", F.col("start_depth").alias("__s"), F.col("end_depth").alias("__e")), "findex", "left")
    less = F.when(F.col("seq") == F.min("seq").over(whole), F.coalesce("__s", F.lit(0.0))).when(F.col("seq") == F.max("seq").over(whole), F.coalesce("__e", F.lit(0.0))).otherwise(F.lit(0.0))
    return rows.withColumn("z", F.col("z") - less).select(vertices.columns)


def z_by_chainage(vertices: DataFrame, manholes: DataFrame, ends: DataFrame, depths: DataFrame) -> DataFrame:
    """Sets z along pipes from measured depths.

    vertices: (findex, seq, x, y, z); manholes: (key, z); ends: (findex, start_key,
    end_key); depths: (findex, distance, depth), distances from the start. Depth
    points are scaled from the greatest distance to the line's length, inserted
    as vertices, and every vertex's z is linear between the depth points around
    it, below the manholes' z interpolated likewise. Lines without both manholes
    or without depths stay as they are.
    """
    w = by_seq().rowsBetween(Window.unboundedPreceding, 0)
    d = F.coalesce(F.sqrt(F.pow(F.col("x") - F.lag("x").over(by_seq()), 2) + F.pow(F.col("y") - F.lag("y").over(by_seq()), 2)), F.lit(0.0))
    at = vertices.withColumn("__d", d).withColumn("at", F.sum("__d").over(w)).drop("__d")
    total = at.groupBy("findex").agg(F.max("at").alias("total"))
    span = depths.groupBy("findex").agg(F.max("distance").alias("most")).where("most > 0")
    known = ends.join(manholes.select(F.col("key").alias("start_key"), F.col("z").alias("za")), "start_key").join(manholes.select(F.col("key").alias("end_key"), F.col("z").alias("zb")), "end_key").join(total, "findex").join(span, "findex").select("findex", "za", "zb", "total", "most")
    marks = depths.join(known, "findex").select("findex", (F.col("distance") / F.col("most") * F.col("total")).alias("at"), "depth")
    segs = at.withColumns({"nx": F.lead("x").over(by_seq()), "ny": F.lead("y").over(by_seq()), "nat": F.lead("at").over(by_seq())}).where("nat > at")
    new = marks.join(segs.select("findex", F.col("at").alias("a0"), "nat", "x", "y", "nx", "ny"), "findex").where("at > a0 and at < nat").select("findex", (F.col("x") + (F.col("nx") - F.col("x")) * (F.col("at") - F.col("a0")) / (F.col("nat") - F.col("a0"))).alias("x"), (F.col("y") + (F.col("ny") - F.col("y")) * (F.col("at") - F.col("a0")) / (F.col("nat") - F.col("a0"))).alias("y"), "at", "depth")
    old = at.join(marks.groupBy("findex", "at").agg(F.max("depth").alias("depth")), ["findex", "at"], "left").select("findex", "x", "y", "z", "at", "depth")
    rows = old.unionByName(new.withColumn("z", F.lit(None).cast("double"))).join(known, "findex", "left")
    line = Window.partitionBy("findex").orderBy("at")
    mark = F.when(F.col("depth").isNotNull(), F.struct("at", "depth"))
    rows = rows.withColumns({"__p": F.last(mark, True).over(line.rowsBetween(Window.unboundedPreceding, 0)), "__n": F.first(mark, True).over(line.rowsBetween(0, Window.unboundedFollowing))})
    p, n = F.coalesce("__p", "__n"), F.coalesce("__n", "__p")
    depth = p["depth"] + F.when(n["at"] > p["at"], (n["depth"] - p["depth"]) * (F.col("at") - p["at"]) / (n["at"] - p["at"])).otherwise(F.lit(0.0))
    ground = F.col("za") + (F.col("zb") - F.col("za")) * F.when(F.col("total") > 0, F.col("at") / F.col("total")).otherwise(F.lit(0.0))
    return rows.select("findex", (F.row_number().over(line) - 1).alias("seq"), "x", "y", F.when(F.col("za").isNotNull(), ground - depth).otherwise(F.col("z")).alias("z"))


def drape(vertices: DataFrame, dem: DataFrame, origin_x: float, origin_y: float, cell: float, add: bool = False) -> DataFrame:
    """z of the elevation cell (row from the top, col, z) below each vertex, added or set; cells without a number leave z as it is."""
    own = vertices.withColumns({"__col": F.floor((F.col("x") - origin_x) / cell), "__row": F.floor((origin_y - F.col("y")) / cell)})
    cells = dem.where("z is not null and not isnan(z)").select(F.col("row").cast("long").alias("__row"), F.col("col").cast("long").alias("__col"), F.col("z").alias("__z"))
    base = F.coalesce("z", F.lit(0.0)) if add else F.lit(0.0)
    return own.join(cells, ["__row", "__col"], "left").withColumn("z", F.when(F.col("__z").isNotNull(), base + F.col("__z")).otherwise(F.col("z"))).select(vertices.columns)
