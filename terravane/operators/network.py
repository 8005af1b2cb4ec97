"""Line networks: end points, merging, grouping by transitive closure, cutting pipes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from terravane.operators.spatial import nearest_segments, segments
from terravane.plans.lineage import cut


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root: the least node that each node of the edges (l, r) is connected to, by turns of large-star and small-star steps."""
    links = cut(edges.select(F.greatest("l", "r").alias("u"), F.least("l", "r").alias("v")).where("u <> v").distinct())
    state = None
    for _ in range(rounds):
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        links = cut(large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots.select("node", F.col("node").alias("root"))).distinct()


def line_ends(vertices: DataFrame) -> DataFrame:
    """findex, end (0 first, 1 last), x, y, z, and qx, qy: the vertex next to the end."""
    w = Window.partitionBy("findex").orderBy("seq")
    rows = vertices.select("findex", "x", "y", "z", F.lag("x").over(w).alias("bx"), F.lag("y").over(w).alias("by"), F.lead("x").over(w).alias("ax"), F.lead("y").over(w).alias("ay"), "seq")
    first = rows.where("bx is null and ax is not null").select("findex", F.lit(0).alias("end"), "x", "y", "z", F.col("ax").alias("qx"), F.col("ay").alias("qy"))
    return first.unionAll(rows.where("ax is null and bx is not null").select("findex", F.lit(1).alias("end"), "x", "y", "z", F.col("bx").alias("qx"), F.col("by").alias("qy")))


def segment_crossings(vertices: DataFrame, cell: float) -> DataFrame:
    """l, l_seq, t, r, r_seq, u, x, y: proper crossings of segments of different lines, l before r."""
    span = lambda a, b: F.sequence(F.floor(F.least(a, b) / cell), F.floor(F.greatest(a, b) / cell))
    s = segments(vertices).withColumn("cx", F.explode(span("ax", "bx"))).withColumn("cy", F.explode(span("ay", "by")))
    side = lambda p: s.select("cx", "cy", F.col("line").alias(p), F.col("seq").alias(f"{p}_seq"), *[F.col(c).alias(f"{p}_{c}") for c in ("ax", "ay", "bx", "by")])
    met = side("l").join(side("r"), ["cx", "cy"]).where("l < r")
    d = lambda p, c: F.col(f"{p}_b{c}") - F.col(f"{p}_a{c}")
    den = d("l", "x") * d("r", "y") - d("l", "y") * d("r", "x")
    wx, wy = F.col("r_ax") - F.col("l_ax"), F.col("r_ay") - F.col("l_ay")
    t, u = F.try_divide(wx * d("r", "y") - wy * d("r", "x"), den), F.try_divide(wx * d("l", "y") - wy * d("l", "x"), den)
    hit = met.where(den != 0).withColumns({"t": t, "u": u}).where("t between 0 and 1 and u between 0 and 1").withColumns({"x": F.col("l_ax") + F.col("t") * d("l", "x"), "y": F.col("l_ay") + F.col("t") * d("l", "y")})
    return hit.where((F.floor(F.col("x") / cell) == F.col("cx")) & (F.floor(F.col("y") / cell) == F.col("cy"))).select("l", "l_seq", "t", "r", "r_seq", "u", "x", "y").distinct()


def move_ends(vertices: DataFrame, threshold: float, cell: float) -> DataFrame:
    """Moves line ends to their nearest crossing with another line if that is within threshold (under 0.5) of the line's length."""
    if not threshold < 0.5:
        raise ValueError("the threshold must be under 0.5")
    from terravane.operators.aggregates import length

    c = segment_crossings(vertices, cell)
    hits = c.select(F.col("l").alias("findex"), "x", "y").unionAll(c.select(F.col("r").alias("findex"), "x", "y"))
    ends = line_ends(vertices).select("findex", "end", F.col("x").alias("ex"), F.col("y").alias("ey"))
    near = hits.join(ends, "findex").join(length(vertices), "findex").withColumn("d", F.sqrt(F.pow(F.col("x") - F.col("ex"), 2) + F.pow(F.col("y") - F.col("ey"), 2))).where((F.col("d") > 0) & (F.col("d") <= F.col("length") * threshold))
    best = near.groupBy("findex", "end").agg(F.min_by(F.struct("x", "y"), F.struct("d", "x", "y")).alias("to"))
    w = Window.partitionBy("findex")
    rows = vertices.withColumn("end", F.when(F.col("seq") == F.min("seq").over(w), 0).when(F.col("seq") == F.max("seq").over(w), 1))
    return rows.join(best, ["findex", "end"], "left").withColumns({"x": F.coalesce("to.x", "x"), "y": F.coalesce("to.y", "y")}).select(vertices.columns)


def connect_ends(vertices: DataFrame, distance: float) -> DataFrame:
    """New two-point lines between ends of different lines within distance, one for each pair of positions and none where a segment already joins them."""
    e = line_ends(vertices).select("findex", "x", "y", "z").withColumns({"cx": F.floor(F.col("x") / distance), "cy": F.floor(F.col("y") / distance)})
    near = F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    a = e.select(F.col("findex").alias("l"), F.struct("x", "y", "z").alias("p"), F.inline(near))
    b = e.select(F.col("findex").alias("r"), F.struct("x", "y", "z").alias("q"), "cx", "cy")
    d = F.sqrt(F.pow(F.col("p.x") - F.col("q.x"), 2) + F.pow(F.col("p.y") - F.col("q.y"), 2))
    pairs = a.join(b, ["cx", "cy"]).where((F.col("l") < F.col("r")) & (d > 0) & (d <= distance)).select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    s = segments(vertices).select(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"), F.col("az").alias("z")).alias("a"), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"), F.col("bz").alias("z")).alias("b")).select(F.least("a", "b").alias("p"), F.greatest("a", "b").alias("q"))
    return pairs.join(s, ["p", "q"], "left_anti").select(F.expr("uuid()").alias("fid"), F.inline(F.array(*[F.struct(F.lit(i).alias("seq"), F.col(f"{c}.x").alias("x"), F.col(f"{c}.y").alias("y"), F.col(f"{c}.z").alias("z")) for i, c in enumerate("pq")])))


def extend_ends(vertices: DataFrame, reach: float, cell: float) -> DataFrame:
    """Extends ends that no other line shares along their last segment to the nearest crossing within reach, as a new vertex."""
    e = line_ends(vertices)
    alone = e.withColumn("n", F.count("*").over(Window.partitionBy("x", "y"))).where("n = 1")
    d = F.sqrt(F.pow(F.col("x") - F.col("qx"), 2) + F.pow(F.col("y") - F.col("qy"), 2))
    rays = alone.withColumn("d", d).where("d > 0").select((-F.row_number().over(Window.partitionBy("findex").orderBy("end")) - F.col("findex") * 2 - 1).cast("double").alias("ray"), "findex", "end", "x", "y", "z", (F.col("x") + (F.col("x") - F.col("qx")) / F.col("d") * reach).alias("tx"), (F.col("y") + (F.col("y") - F.col("qy")) / F.col("d") * reach).alias("ty"))
    lines = rays.select(F.col("ray").alias("findex"), F.inline(F.array(F.struct(F.lit(0).alias("seq"), F.col("x"), F.col("y"), F.col("z")), F.struct(F.lit(1).alias("seq"), F.col("tx").alias("x"), F.col("ty").alias("y"), F.col("z")))))
    both = lines.unionByName(vertices.select(F.col("findex").cast("double").alias("findex"), "seq", "x", "y", "z"))
    hits = segment_crossings(both, cell).where("l < 0 and r >= 0 and t > 1e-9").select(F.col("l").alias("ray"), "r", "t", F.col("x").alias("hx"), F.col("y").alias("hy"))
    best = hits.join(rays, "ray").where(F.col("r") != F.col("findex")).groupBy("findex", "end").agg(F.min_by(F.struct("hx", "hy", "z"), "t").alias("to"))
    span = vertices.groupBy("findex").agg(F.min("seq").alias("a"), F.max("seq").alias("b"))
    new = best.join(span, "findex").select("findex", F.when(F.col("end") == 0, F.col("a") - 1).otherwise(F.col("b") + 1).alias("seq"), F.col("to.hx").alias("x"), F.col("to.hy").alias("y"), F.col("to.z").alias("z"))
    rows = vertices.select("findex", "seq", "x", "y", "z").unionByName(new)
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("findex").orderBy("seq")) - 1)


def split_at_crossings(vertices: DataFrame, cell: float) -> DataFrame:
    """source, findex (source and piece), seq, x, y, z: lines cut wherever another line crosses them."""
    c = segment_crossings(vertices, cell)
    cuts = c.select(F.col("l").alias("findex"), (F.col("l_seq") + F.col("t")).alias("at"), "x", "y").unionAll(c.select(F.col("r").alias("findex"), (F.col("r_seq") + F.col("u")).alias("at"), "x", "y"))
    old = vertices.select("findex", F.col("seq").cast("double").alias("at"), "x", "y", "z", F.lit(False).alias("cut"))
    w = Window.partitionBy("findex").orderBy("at")
    rows = old.unionByName(cuts.withColumns({"z": F.lit(None).cast("double"), "cut": F.lit(True)})).groupBy("findex", "at").agg(F.first("x").alias("x"), F.first("y").alias("y"), F.max("z").alias("z"), F.max("cut").alias("cut"))
    ends = Window.partitionBy("findex")
    rows = rows.withColumn("cut", F.col("cut") & (F.col("at") > F.min("at").over(ends)) & (F.col("at") < F.max("at").over(ends))).withColumn("piece", F.sum(F.col("cut").cast("int")).over(w))
    twice = rows.select("findex", F.explode(F.when(F.col("cut"), F.array(F.col("piece") - 1, F.col("piece"))).otherwise(F.array("piece"))).alias("piece"), "at", "x", "y", "z")
    return twice.select(F.col("findex").alias("source"), F.concat_ws("-", F.col("findex").cast("string"), F.col("piece").cast("string")).alias("findex"), (F.row_number().over(Window.partitionBy("findex", "piece").orderBy("at")) - 1).alias("seq"), "x", "y", "z")


def integrate_lines(vertices: DataFrame) -> DataFrame:
    """Merges lines end to end where exactly two meet: root (least line of the merged), seq, x, y, z; cycles are closed.

    Chains are components over shared ends of degree two; one chain's lines are put in order in one task.
    """
    e = line_ends(vertices).select("findex", "end", F.col("x").alias("ex"), F.col("y").alias("ey"))
    joint = e.groupBy("ex", "ey").agg(F.count("*").alias("n"), F.min("findex").alias("l"), F.max("findex").alias("r")).where("n = 2")
    roots = components(joint.select("l", "r").where("l <> r"))
    met = vertices.join(roots, vertices["findex"] == roots["node"], "left")
    rows = met.where("root is not null").select(F.col("root").cast("double").alias("root"), F.col("findex").cast("double").alias("findex"), "seq", *[F.col(c).cast("double").alias(c) for c in ("x", "y", "z")])
    # a line that meets no other: from its last vertex, unless it is closed
    w = Window.partitionBy("findex").orderBy("seq")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at, n, closed = F.row_number().over(w), F.count(F.lit(1)).over(whole), (F.first("x").over(whole) == F.last("x").over(whole)) & (F.first("y").over(whole) == F.last("y").over(whole))
    alone = met.where("root is null").select(F.col("findex").cast("double").alias("root"), F.when(closed, at - 1).otherwise(n - at).cast("int").alias("seq"), *[F.col(c).cast("double").alias(c) for c in ("x", "y", "z")])

    def run(f: pd.DataFrame) -> pd.DataFrame:
        lines = {k: x.sort_values("seq")[["x", "y", "z"]].to_numpy(float) for k, x in f.groupby("findex")}
        at: dict = {}
        for k, a in lines.items():
            for end in (0, -1):
                at.setdefault(tuple(a[end, :2]), []).append((k, end))
        free = [v[0] for v in at.values() if len(v) == 1]
        k, end = min(free) if free else (min(lines), 0)
        path, left = [], dict(lines)
        while k in left:
            a = left.pop(k)
            a = a if end == 0 else a[::-1]
            path.append(a if not path else a[1:])
            nxt = [v for v in at[tuple(a[-1, :2])] if v[0] in left]
            if len(at[tuple(a[-1, :2])]) != 2 or not nxt:
                break
            k, end = nxt[0]
        p = np.vstack(path)
        return pd.DataFrame({"root": f["root"].iloc[0], "seq": range(len(p)), "x": p[:, 0], "y": p[:, 1], "z": p[:, 2]})

    return alone.unionAll(rows.groupBy("root").applyInPandas(run, "root double, seq int, x double, y double, z double"))


def group_leader_lines(vertices: DataFrame, groups: DataFrame, tolerance: float) -> DataFrame:
    """node, root over groups (l, r) enlarged by one pair a line: a free end and the other line's end within tolerance whose two bends are least (then the nearest, then the least key)."""
    e = line_ends(vertices)
    cx, cy = F.floor(F.col("x") / tolerance), F.floor(F.col("y") / tolerance)
    near = F.array(*[F.struct((cx + i).alias("cx"), (cy + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    side = lambda p: [F.col("findex").alias(p), *[F.col(c).alias(f"{p}{c}") for c in ("x", "y", "qx", "qy")]]
    pairs = e.select(*side("l"), F.inline(near)).join(e.select(*side("r"), cx.alias("cx"), cy.alias("cy")), ["cx", "cy"]).where("l <> r")
    pairs = pairs.withColumn("d", F.sqrt(F.pow(F.col("lx") - F.col("rx"), 2) + F.pow(F.col("ly") - F.col("ry"), 2))).where(F.col("d") <= tolerance)
    way = lambda ax, ay, bx, by: F.atan2(F.col(by) - F.col(ay), F.col(bx) - F.col(ax))
    bend = lambda a, b: F.abs(F.pmod(F.degrees(a - b) + 180, F.lit(360.0)) - 180)
    link = F.when(F.col("d") > 0, way("lx", "ly", "rx", "ry")).otherwise(way("lqx", "lqy", "lx", "ly"))
    total = bend(way("lqx", "lqy", "lx", "ly"), link) + bend(link, way("rx", "ry", "rqx", "rqy"))
    best = pairs.withColumn("bend", total).groupBy("l").agg(F.min_by("r", F.struct("bend", "d", "r")).alias("r"))
    return components(groups.select("l", "r").unionByName(best.select("l", "r")))


def leader_ranges(lines: DataFrame, circles: DataFrame, pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """findex and bounds of each leader line's group and of the circles paired (l line, r circle) with its lines."""
    roots = components(groups)
    own = lines.select("findex", "x", "y").join(roots, lines["findex"] == roots["node"], "left").withColumn("root", F.coalesce("root", "findex")).select("findex", "root", "x", "y")
    circle = pairs.join(circles.select(F.col("findex").alias("r"), "x", "y"), "r").select(F.col("l").alias("findex"), "x", "y").join(own.select("findex", "root").distinct(), "findex").select("root", "x", "y")
    box = own.select("root", "x", "y").unionByName(circle).groupBy("root").agg(F.min("x").alias("x_min"), F.min("y").alias("y_min"), F.max("x").alias("x_max"), F.max("y").alias("y_max"))
    return own.select("findex", "root").distinct().join(box, "root").drop("root")


def divide_pipes(pipes: DataFrame, points: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cuts pipes with two or more leader lines half way between their nearest positions on the pipe: (new pipes: findex, source, piece, seq, x, y, z), (pairs: l new pipe, r leader).

    pairs: (l pipe, r leader); points: (findex leader, x, y). Every vertex of a pipe stays.
    """
    w = Window.partitionBy("findex").orderBy("seq")
    chain = pipes.withColumn("d", F.coalesce(F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2)), F.lit(0.0))).withColumn("at", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("d")
    s = segments(pipes).join(chain.select(F.col("findex").alias("line"), "seq", F.col("at").alias("a0")), ["line", "seq"])
    met = pairs.join(points.select(F.col("findex").alias("r"), F.col("x").alias("px"), F.col("y").alias("py")), "r").join(s, pairs["l"] == s["line"])
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    n = dx * dx + dy * dy
    t = F.when(n == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("px") - F.col("ax")) * dx + (F.col("py") - F.col("ay")) * dy) / n)))
    met = met.withColumn("t", t).withColumn("dist", F.sqrt(F.pow(F.col("px") - F.col("ax") - F.col("t") * dx, 2) + F.pow(F.col("py") - F.col("ay") - F.col("t") * dy, 2)))
    foot = met.groupBy("l", "r").agg(F.min_by(F.col("a0") + F.col("t") * F.sqrt(n), F.struct("dist", "seq")).alias("at"))
    order = Window.partitionBy("l").orderBy("at", "r")
    foot = foot.withColumns({"piece": F.row_number().over(order) - 1, "n": F.count("*").over(Window.partitionBy("l")), "next": F.lead("at").over(order)})
    cuts = foot.where("n > 1 and next is not null").select(F.col("l").alias("findex"), ((F.col("at") + F.col("next")) / 2).alias("at"))
    # a cut's position lies on the segment that spans it
    span = chain.withColumns({"nx": F.lead("x").over(w), "ny": F.lead("y").over(w), "nz": F.lead("z").over(w), "nat": F.lead("at").over(w)}).where("nat > at").select("findex", F.col("at").alias("a0"), "nat", "x", "y", "z", "nx", "ny", "nz")
    share = (F.col("at") - F.col("a0")) / (F.col("nat") - F.col("a0"))
    new = cuts.join(span, "findex").where("at > a0 and at <= nat").select("findex", "at", *[(F.col(c) + (F.col(f"n{c}") - F.col(c)) * share).alias(c) for c in "xyz"], F.lit(True).alias("cut"))
    rows = chain.select("findex", "at", "x", "y", "z", F.lit(False).alias("cut")).unionByName(new)
    by = Window.partitionBy("findex").orderBy("at", "cut")
    rows = rows.withColumn("piece", F.sum(F.col("cut").cast("int")).over(by))
    twice = rows.select("findex", F.explode(F.when(F.col("cut"), F.array(F.col("piece") - 1, F.col("piece"))).otherwise(F.array("piece"))).alias("piece"), "at", "cut", "x", "y", "z")
    pieces = twice.select(F.col("findex").alias("source"), "piece", (F.row_number().over(Window.partitionBy("findex", "piece").orderBy("at", F.desc("cut"))) - 1).alias("seq"), "x", "y", "z")
    pieces = pieces.withColumn("findex", F.concat_ws("-", F.col("source").cast("string"), F.col("piece").cast("string")))
    return pieces, foot.select(F.concat_ws("-", F.col("l").cast("string"), F.when(F.col("n") > 1, F.col("piece")).otherwise(0).cast("string")).alias("l"), "r")


# pixels and map positions ----------------------------------------------------------------------------


def to_pixels(vertices: DataFrame, areas: DataFrame, scale: float | None = None, width: int | None = None) -> DataFrame:
    """area, findex, seq, px, py: whole pixels, y downwards, for every area (area, x_min, y_min, x_max, y_max) that holds the vertex; the scale is given, or makes the area `width` pixels wide."""
    k = F.lit(scale) if scale is not None else width / (F.col("x_max") - F.col("x_min"))
    met = vertices.join(F.broadcast(areas), F.col("x").between(F.col("x_min"), F.col("x_max")) & F.col("y").between(F.col("y_min"), F.col("y_max")))  # clip areas are a list the user wrote
    return met.select("area", "findex", "seq", F.floor((F.col("x") - F.col("x_min")) * k).alias("px"), F.floor((F.col("y_max") - F.col("y")) * k).alias("py"))


def pixels_to_points(pixels: DataFrame, ulx: float, uly: float, dx: float, dy: float) -> DataFrame:
    """Pixel centres as map positions."""
    return pixels.withColumns({"x": ulx + (F.col("px") + 0.5) * dx, "y": uly - (F.col("py") + 0.5) * dy})


def pixels_to_lines(lines: DataFrame, ulx: float, uly: float, dx: float, dy: float) -> DataFrame:
    """Two-point pixel lines (findex, seq, px, py) as map lines; an end whose pixel no other line shares is extended by half a pixel along the line."""
    w = Window.partitionBy("findex").orderBy("seq")
    other = lambda c: F.coalesce(F.lead(c).over(w), F.lag(c).over(w))
    rows = lines.withColumns({"ox": other("px"), "oy": other("py"), "n": F.count("*").over(Window.partitionBy("px", "py"))})
    d = F.sqrt(F.pow(F.col("px") - F.col("ox"), 2) + F.pow(F.col("py") - F.col("oy"), 2))
    more = lambda c: F.when((F.col("n") == 1) & (d > 0), (F.col(f"p{c}") - F.col(f"o{c}")) / d * 0.5).otherwise(0.0)
    return rows.select("findex", "seq", (ulx + (F.col("px") + more("x") + 0.5) * dx).alias("x"), (uly - (F.col("py") + more("y") + 0.5) * dy).alias("y"))
