"""Solids as triangle tables, rubber-sheeting by triangles, and the polygon kernels that need whole shapes.

A triangle table has four rows for each closed triangle: findex, patch, k, the
vertex x, y, z and its normal nx, ny, nz.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.functions import geometry as g

TRIANGLES = "findex double, patch int, k int, x double, y double, z double, nx double, ny double, nz double"


def _table(findex: float, triangles: list[tuple]) -> pd.DataFrame:
    t = np.asarray(triangles, float).reshape(-1, 3, 3)
    n = np.cross(t[:, 1] - t[:, 0], t[:, 2] - t[:, 0])
    size = np.linalg.norm(n, axis=1)
    n = np.repeat(n / np.where(size == 0, 1, size)[:, None], 4, axis=0)
    p = t[:, [0, 1, 2, 0]].reshape(-1, 3)
    rows = np.arange(len(p))
    return pd.DataFrame({"findex": np.full(len(p), findex), "patch": (rows // 4).astype(np.int32), "k": (rows % 4).astype(np.int32), "x": p[:, 0], "y": p[:, 1], "z": p[:, 2], "nx": n[:, 0], "ny": n[:, 1], "nz": n[:, 2]})


def _lines(vertices: DataFrame, sizes: DataFrame) -> DataFrame:
    return vertices.join(sizes, "findex").withColumn("findex", F.col("findex").cast("double"))


#: Vertices of one turn of the kernels over many lines; a line's own stay together.
TURN = 4096


def _many(vertices: DataFrame, sizes: DataFrame, names: list[str], run: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Applies run to many whole lines at once: keys, numbers of vertices, vertices one line after the other, and a row of sizes for each line."""
    vertex = F.struct(F.col("seq").alias("seq"), *[F.col(c).cast("double").alias(c) for c in ("x", "y", "z")])
    lines = vertices.join(sizes, "findex").groupBy("findex").agg(F.collect_list(vertex).alias("line"), *[F.first(c).cast("double").alias(c) for c in names])
    lines = lines.select(F.col("findex").cast("double").alias("findex"), "line", *names)
    numbers = lambda a: a.to_numpy(zero_copy_only=False)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            count = numbers(batch.column("line").value_lengths()).astype(np.int64)
            seq, *xyz = batch.column("line").flatten().flatten()
            seq, p = numbers(seq), np.column_stack([numbers(c).astype(float) for c in xyz])
            line = np.repeat(np.arange(len(count)), count)
            if ((seq[1:] < seq[:-1]) & (line[1:] == line[:-1])).any():
                p = p[np.lexsort((seq, line))]
            keys, size = numbers(batch.column("findex")), np.column_stack([numbers(batch.column(c)).astype(float) for c in names])
            ends = np.cumsum(count)
            i = 0
            while i < len(count):
                first = ends[i] - count[i]
                j = max(i + 1, int(np.searchsorted(ends, first + TURN, "right")))
                yield from run(keys[i:j], count[i:j], p[first : ends[j - 1]], size[i:j])
                i = j

    return lines.mapInArrow(batches, schema)


def _kept(count: np.ndarray, p: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whose lines are left with two vertices or more, their numbers of vertices, and those."""
    line = np.repeat(np.arange(len(count)), count)
    left = np.bincount(line[keep], minlength=len(count))
    some = np.flatnonzero(left > 1)
    return some, left[some], p[keep & (left > 1)[line]]


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _steps(count: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vertex less the one before it, and whether it is the first of its line."""
    first = np.zeros(len(p), bool)
    first[(np.cumsum(count) - count)[count > 0]] = True
    return np.diff(p, axis=0, prepend=p[:1]), first


def _sides(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For lines of two vertices or more: each segment's first vertex, each vertex's place, and the segments before and after it (at ends the only one)."""
    start = np.cumsum(count) - count
    line = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(line)) - start[line]
    segments = np.delete(np.arange(len(line)), start + count - 1)
    own = (start - np.arange(len(count)))[line]
    return segments, at, own + np.maximum(at - 1, 0), own + np.minimum(at, count[line] - 2)


def _unit(v: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    n = np.sqrt((v**2).sum(1))[:, None]
    return np.where(n < 1e-9, otherwise, v / np.where(n < 1e-9, 1, n))


def _frames(count: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At each vertex of 3D lines: the mitre's sideways and upward vectors, for cross sections of constant size."""
    seg, _, a, b = _sides(count)
    d = p[seg + 1] - p[seg]
    d = d / np.maximum(np.sqrt((d**2).sum(1)), 1e-12)[:, None]
    flat = np.column_stack([d[:, 1], -d[:, 0], np.zeros(len(d))])
    n = np.sqrt((flat**2).sum(1))[:, None]
    side = np.where(n > 1e-9, flat / np.where(n > 1e-9, n, 1), np.array([1.0, 0.0, 0.0]))
    s, t = _unit(side[a] + side[b], side[b]), _unit(d[a] + d[b], d[b])
    u = np.column_stack([s[:, 1] * t[:, 2], -s[:, 0] * t[:, 2], s[:, 0] * t[:, 1] - s[:, 1] * t[:, 0]])
    n = np.sqrt((u**2).sum(1))[:, None]
    u = u / np.where(n == 0, 1, n)
    wide = 1 / np.fmax(0.2, (s * side[b]).sum(1))  # a mitre is wider than the section
    return s * wide[:, None], np.where(u[:, 2:] >= 0, u, -u)


def _rings(count: np.ndarray, p: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Whose lines have a length, their numbers of vertices, each vertex's section (vertices, corners, xyz), the caps' triangles by kind of section, and each line's kind."""
    d, first = _steps(count, p)
    some, count, p = _kept(count, p, first | (np.sqrt((d**2).sum(1)) > 1e-12))
    if not len(some):
        return some, count, np.empty((0, sections.shape[1], 3)), [], some
    sections = sections[some]
    line = np.repeat(np.arange(len(count)), count)
    s, u = _frames(count, p)
    ring = p[:, None] + sections[line, :, :1] * s[:, None] + sections[line, :, 1:] * u[:, None]
    # the caps' triangles follow from a section's corners but for their distances from its middle
    _, like, kind = np.unique(np.where(np.isnan(sections), 2, np.sign(sections)).reshape(len(sections), -1), axis=0, return_index=True, return_inverse=True)
    return some, count, ring, [np.array(g.triangulate(sections[i]), np.int64).reshape(-1, 3) for i in like], kind.ravel()


def sweep(count: np.ndarray, p: np.ndarray, sections: np.ndarray, start: bool, end: bool) -> tuple[np.ndarray, np.ndarray, list[list[np.ndarray]]]:
    """Each line's section (lines, corners, and sideways and upward offsets) drawn along it, with caps on request: each triangle's line and number, and its corners' coordinates."""
    some, count, ring, fans, kind = _rings(count, p, sections)
    if not len(some):
        return np.empty(0, np.int64), np.empty(0, np.int64), [[np.empty(0)] * 3] * 3
    m, line = sections.shape[1], np.repeat(np.arange(len(count)), count)
    ring = [ring[:, :, c].ravel() for c in range(3)]
    seg, at, _, _ = _sides(count)
    lid = np.array([len(f) for f in fans])[kind]
    walls = (count - 1) * 2 * m
    total = walls + lid * (start + end)
    base = np.cumsum(total) - total
    corner = np.empty((3, int(total.sum())), np.int64)
    i = np.arange(m)
    j = (i + 1) % m
    to = ((base[line] + at * 2 * m)[seg][:, None] + np.arange(2 * m)).ravel()
    for k, (one, two) in enumerate(((i, i), (j, j + m), (j + m, i + m))):
        corner[k, to] = (seg[:, None] * m + np.column_stack([one, two]).ravel()).ravel()
    last = np.cumsum(count)
    for k, fan in enumerate(fans):
        of = np.flatnonzero(kind == k)
        to = ((base + walls)[of][:, None] + np.arange(len(fan))).ravel()
        if start:
            corner[:, to] = [(((last - count)[of] * m)[:, None] + fan[:, c]).ravel() for c in (0, 2, 1)]
            to += len(fan)
        if end:
            corner[:, to] = [(((last - 1)[of] * m)[:, None] + fan[:, c]).ravel() for c in (0, 1, 2)]
    owner = np.repeat(np.arange(len(count)), total)
    return some[owner], np.arange(len(owner)) - base[owner], [[c[k] for c in ring] for k in corner]


#: Segments of a line that come in one row at most.
PIECE = 512
PIECES = "findex double, base int, walls int, head int, tail int, lid int, cap int, ring array<double>, normal array<double>, flat array<double>, fan array<int>"


def _across(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    e, f = np.moveaxis(b - a, -1, 0), np.moveaxis(c - a, -1, 0)
    return np.stack([e[y] * f[z] - e[z] * f[y] for y, z in ((1, 2), (2, 0), (0, 1))], -1)


def _normal(n: np.ndarray) -> np.ndarray:
    size = np.sqrt(n[..., 0] * n[..., 0] + n[..., 1] * n[..., 1] + n[..., 2] * n[..., 2])
    return n / np.where(size == 0, 1, size)[..., None]


def _tubes(vertices: DataFrame, sizes: DataFrame, names: list[str], section: Callable[[np.ndarray], np.ndarray], start: bool, end: bool) -> DataFrame:
    """Sections swept along lines, as sweep does it: the kernel gives sections along pieces of lines and normals, of which Catalyst makes triangles.

    A piece has head triangles of the first cap, numbered from cap, those of its walls, from base, and tail ones of the last cap, the last of all.
    Rows of a cap or segment come by k, and the walls' two halves apart, so that coordinates and normals come again in long runs, which files
    hold in less space than triangles one by one. A cap is flat and has one normal.
    """
    m = section(np.zeros((1, len(names)))).shape[1]

    def run(keys: np.ndarray, count: np.ndarray, p: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            some, count, ring, fans, kind = _rings(count, p, section(size))
            if not len(some):
                return
            seg, _, _, _ = _sides(count)
            near, far = ring[seg], ring[seg + 1]
            over = np.roll(far, -1, 1)
            normal = _normal(np.stack([_across(near, np.roll(near, -1, 1), over), _across(near, over, far)], 1))
            last = np.cumsum(count) - 1
            lids = np.empty((len(count), 2, 3))
            for k, fan in enumerate(fans):
                of = np.flatnonzero(kind == k)
                for side, at, turn in ((0, last - count + 1, (0, 2, 1)), (1, last, (0, 1, 2))):
                    lids[of, side] = _normal(_across(*(ring[at[of]][:, fan[:, c]] for c in turn)).sum(1))
        pieces = -(-(count - 1) // PIECE)
        line = np.repeat(np.arange(len(count)), pieces)
        at = np.arange(len(line)) - (np.cumsum(pieces) - pieces)[line]
        segments = np.minimum(PIECE, count[line] - 1 - at * PIECE)
        lid, walls = np.array([len(f) for f in fans])[kind][line], segments * 2 * m
        head, tail = lid * (at == 0) * start, lid * (at == pieces[line] - 1) * end
        numbers = [at * PIECE * 2 * m, walls, head, tail, np.maximum(lid, 1), (count[line] - 1) * 2 * m]
        corners = ring[_spans((np.cumsum(count) - count)[line] + at * PIECE, segments + 1)].ravel()
        fan, of = np.concatenate(fans).ravel(), kind[line]
        corner_count = np.array([f.size for f in fans])
        listed = lambda values, size: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(values))
        columns = [pa.array(keys[some][line]), *(pa.array(x, pa.int32()) for x in numbers), listed(corners, (segments + 1) * 3 * m), listed(normal.ravel(), segments * 6 * m), listed(lids[line].ravel(), np.full(len(line), 6))]
        columns.append(listed(fan[_spans((np.cumsum(corner_count) - corner_count)[of], corner_count[of])].astype(np.int32), corner_count[of]))
        out = pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PIECES.split(", ")])
        for i in range(0, len(out), 1 << 10):
            yield out.slice(i, 1 << 10)

    c = F.col
    v = _many(vertices, sizes, names, run, PIECES).withColumn("t", F.explode(F.sequence(F.lit(0), (c("head") + c("walls") + c("tail")) * 4 - 1)))
    v = v.withColumns({"first": c("t") < c("head") * 4, "u": c("t") - c("head") * 4})
    v = v.withColumns({"wall": ~c("first") & (c("u") < c("walls") * 4), "u": F.when(c("first"), c("t")).when(c("u") < c("walls") * 4, c("u")).otherwise(c("u") - c("walls") * 4)})
    v = v.withColumns({"k": F.when(c("wall"), F.expr(f"int(u % {8 * m} div {2 * m})")).otherwise(F.expr("int(u div lid)")), "r": F.when(c("wall"), c("u") % (2 * m)).otherwise(c("u") % c("lid"))})
    # corners' places among the piece's: walls go round the section, by two triangles a side
    v = v.withColumns({"from": F.expr(f"int(u div {8 * m}) * {m}"), "odd": c("r") >= m, "i": c("r") % m})
    j = F.when(c("i") == m - 1, 0).otherwise(c("i") + 1)
    wall = c("from") + F.when(c("k") % 3 == 0, c("i")).when(c("k") == 1, F.when(c("odd"), j + m).otherwise(j)).otherwise(F.when(c("odd"), c("i")).otherwise(j) + m)
    lid = F.when(c("first"), c("fan")[c("r") * 3 + (3 - c("k")) % 3]).otherwise(F.expr("int(walls div 2)") + c("fan")[c("r") * 3 + c("k") % 3])
    v = v.withColumns({
        "patch": F.when(c("wall"), c("base") + (c("from") + c("i")) * 2 + c("odd").cast("int")).when(c("first"), c("cap") + c("r")).otherwise(c("cap") + F.when(F.lit(start), c("lid")).otherwise(0) + c("r")),
        "corner": F.when(c("wall"), wall).otherwise(lid) * 3,
        "of": F.when(c("wall"), c("from") * 2 + c("r")).when(c("first"), 0).otherwise(1) * 3,
    })
    normals = [F.when(c("wall"), c("normal")[c("of") + k]).otherwise(c("flat")[c("of") + k]).alias(f"n{x}") for k, x in enumerate("xyz")]
    return v.select("findex", "patch", "k", *[c("ring")[c("corner") + k].alias(x) for k, x in enumerate("xyz")], *normals)


def box_solids(vertices: DataFrame, sizes: DataFrame, start: bool = True, end: bool = True) -> DataFrame:
    """Box tubes around lines, of each line's width and depth (sizes: findex, width, depth)."""

    def section(size: np.ndarray) -> np.ndarray:
        return size[:, None, :] / 2 * np.array([(-1, -1), (1, -1), (1, 1), (-1, 1)])

    return _tubes(vertices, sizes, ["width", "depth"], section, start, end)


def cylinder_solids(vertices: DataFrame, sizes: DataFrame, divisions: int = 16, start: bool = True, end: bool = True) -> DataFrame:
    """Cylinders around lines (sizes: findex, radius)."""
    t = np.arange(divisions) * 2 * np.pi / divisions
    return _tubes(vertices, sizes, ["radius"], lambda size: size[:, :, None] * np.c_[np.cos(t), np.sin(t)], start, end)


def prism_solids(vertices: DataFrame, sizes: DataFrame, top: bool = True, bottom: bool = True) -> DataFrame:
    """Polygons extruded by each one's height (sizes: findex, height), lids by ear clipping."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq")
        r = g.closed(f[["x", "y", "z"]].to_numpy(float))[:-1]
        r = r if g.area(r) > 0 else r[::-1]
        q = r + [0, 0, float(f["height"].iloc[0])]
        out = [t for i in range(len(r)) for j in [(i + 1) % len(r)] for t in ((r[i], r[j], q[j]), (r[i], q[j], q[i]))]
        fan = g.triangulate(r)
        out += [(q[a], q[b], q[c]) for a, b, c in fan] * top + [(r[a], r[c], r[b]) for a, b, c in fan] * bottom
        return _table(f["findex"].iloc[0], out)

    return _lines(vertices, sizes).groupBy("findex").applyInPandas(run, TRIANGLES)


def volume(triangles: DataFrame) -> DataFrame:
    """Signed volume of closed solids, by the divergence theorem, in built-in expressions."""
    p = lambda k: F.max(F.when(F.col("k") == k, F.struct("x", "y", "z")))
    t = triangles.groupBy("findex", "patch").agg(p(0).alias("a"), p(1).alias("b"), p(2).alias("c"))
    v = sum(s * F.col(f"a.{i}") * (F.col(f"b.{j}") * F.col(f"c.{k}") - F.col(f"b.{k}") * F.col(f"c.{j}")) for s, i, j, k in ((1, "x", "y", "z"), (1, "y", "z", "x"), (1, "z", "x", "y")))
    return t.groupBy("findex").agg((F.sum(v) / 6).alias("volume"))


# rubber-sheeting -------------------------------------------------------------------------------------

#: Bound on control points, whose triangles travel with the plan.
MOST_POINTS = 50_000


def affine_sheet(vertices: DataFrame, control: DataFrame, three_d: bool = False) -> DataFrame:
    """Moves vertices by the triangles of control points (x, y, z to tx, ty, tz): within each triangle by its affine map, elsewhere not at all.

    control is gathered on the driver, which refuses more than MOST_POINTS.
    """
    rows = control.select("x", "y", "z", "tx", "ty", "tz").limit(MOST_POINTS + 1).toPandas()
    if len(rows) > MOST_POINTS:
        raise ValueError(f"more than {MOST_POINTS} control points")
    src, dst = rows[["x", "y", "z"]].to_numpy(float), rows[["tx", "ty", "tz"]].to_numpy(float)
    triangles = np.array(g.delaunay(src), int).reshape(-1, 3)
    a, b, c = (src[triangles[:, k], :2] for k in range(3))
    cell = max(float((src[:, :2].max(0) - src[:, :2].min(0)).max()) / max(1, int(np.sqrt(len(triangles)))), 1e-9) if len(src) else 1.0
    grid: dict[tuple[int, int], list[int]] = {}
    for i in range(len(triangles)):
        low, high = np.floor(np.min([a[i], b[i], c[i]], 0) / cell).astype(int), np.floor(np.max([a[i], b[i], c[i]], 0) / cell).astype(int)
        for x in range(low[0], high[0] + 1):
            for y in range(low[1], high[1] + 1):
                grid.setdefault((x, y), []).append(i)
    shipped = vertices.sparkSession.sparkContext.broadcast((src, dst, triangles, grid))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        src, dst, triangles, grid = shipped.value
        for f in frames:
            p = f[["x", "y", "z"]].to_numpy(float)
            out = p.copy()
            for i, key in enumerate(map(tuple, np.floor(p[:, :2] / cell).astype(int))):
                for t in grid.get(key, ()):
                    s, d = src[triangles[t]], dst[triangles[t]]
                    m = np.array([s[1, :2] - s[0, :2], s[2, :2] - s[0, :2]]).T
                    u, v = np.linalg.solve(m, p[i, :2] - s[0, :2])
                    if u >= -1e-9 and v >= -1e-9 and u + v <= 1 + 1e-9:
                        out[i, :2] = d[0, :2] + u * (d[1, :2] - d[0, :2]) + v * (d[2, :2] - d[0, :2])
                        if three_d:
                            shift = d[:, 2] - s[:, 2]
                            out[i, 2] = p[i, 2] + shift[0] + u * (shift[1] - shift[0]) + v * (shift[2] - shift[0])
                        break
            yield f.assign(x=out[:, 0], y=out[:, 1], z=out[:, 2])

    return vertices.mapInPandas(run, vertices.schema)


# whole shapes ----------------------------------------------------------------------------------------

VERTICES = "findex double, seq int, x double, y double, z double"


def _each(vertices: DataFrame, change) -> DataFrame:
    """Applies change(array of x, y, z) -> list of arrays to each key; several results are numbered in `part`."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq")
        parts = change(f[["x", "y", "z"]].to_numpy(float))
        return pd.DataFrame([(float(f["findex"].iloc[0]), k, i, *p) for k, q in enumerate(parts) for i, p in enumerate(q)], columns=["findex", "part", "seq", "x", "y", "z"])

    return vertices.withColumn("findex", F.col("findex").cast("double")).groupBy("findex").applyInPandas(run, "findex double, part int, seq int, x double, y double, z double")


def simplify(vertices: DataFrame, tolerance: float) -> DataFrame:
    return _each(vertices, lambda a: [g.simplify(a, tolerance)]).drop("part")


def clip_lines(vertices: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    return _each(vertices, lambda a: g.clip_line(a, x0, y0, x1, y1))


def clip_polygons(vertices: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    return _each(vertices, lambda a: [r] if len(r := g.clip_ring(a, x0, y0, x1, y1)) else [])


def clip_points(points: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    return points.where(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))


def representative_points(vertices: DataFrame) -> DataFrame:
    """A point within each polygon; z is its first vertex's, or 0."""
    return _each(vertices, lambda a: [np.array([[*g.representative_point([a]), 0.0 if np.isnan(a[0, 2]) else a[0, 2]]])]).drop("part", "seq")


def invalid_shapes(vertices: DataFrame, polygons: bool = True) -> DataFrame:
    """Keys of rings that meet themselves or have too few points."""
    return _each(vertices, lambda a: [] if (g.is_simple(a) if polygons else len(a) > 1) else [a[:1]]).select("findex").distinct()


def bottom_polygons(vertices: DataFrame, widths: DataFrame, half: bool = False) -> DataFrame:
    """Lines widened to both sides by the full width (or half of it), neighbouring offsets joined where they cross, collinear vertices left out."""

    def run(keys: np.ndarray, count: np.ndarray, p: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            d, first = _steps(count, p)
            some, count, p = _kept(count, p, first | (np.abs(d[:, :2]).max(1) > 0))
            if not len(some):
                return
            w = size[some, 0] * (0.5 if half else 1)
            # a ring: the line to the right, and the way back to the left
            start, n = np.cumsum(count) - count, 2 * count
            owner = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(owner)) - 2 * start[owner]
            there = place < count[owner]
            vertex = start[owner] + np.where(there, place, 2 * count[owner] - 1 - place)
            line = np.repeat(np.arange(len(count)), count)
            ring = np.where(there[:, None], _offset(count, p, w[line])[vertex], _offset(count, p, -w[line])[vertex])
            low, row = 2 * start[owner], np.arange(len(owner))
            a, c = ring[np.where(place == 0, low + n[owner] - 1, row - 1), :2], ring[np.where(place == n[owner] - 1, low, row + 1), :2]
            b = ring[:, :2]
            keep = np.abs((b[:, 0] - a[:, 0]) * (c[:, 1] - b[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - b[:, 0])) > 1e-9
            ring, n = ring[keep], np.bincount(owner[keep], minlength=len(n))
            low, n = np.cumsum(n) - n, n + (n > 0)  # closed
            owner = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
            ring = ring[low[owner] + np.where(place == n[owner] - 1, 0, place)]
        out = pa.RecordBatch.from_arrays([pa.array(v) for v in (keys[some][owner], place.astype(np.int32), *ring.T.copy())], ["findex", "seq", "x", "y", "z"])
        for i in range(0, len(out), 1 << 16):
            yield out.slice(i, 1 << 16)

    return _many(vertices, widths, ["width"], run, VERTICES)


def _offset(count: np.ndarray, p: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Lines moved sideways by w at each vertex, to the right."""
    seg, at, i, j = _sides(count)
    d = p[seg + 1, :2] - p[seg, :2]
    n = np.column_stack([d[:, 1], -d[:, 0]]) / np.maximum(np.hypot(*d.T), 1e-12)[:, None]
    w = w[:, None]
    a0, a1, b0, b1 = p[seg[i], :2] + w * n[i], p[:, :2] + w * n[i], p[:, :2] + w * n[j], p[seg[j] + 1, :2] + w * n[j]
    r, s = a1 - a0, b1 - b0
    den = r[:, 0] * s[:, 1] - r[:, 1] * s[:, 0]
    t = ((b0[:, 0] - a0[:, 0]) * s[:, 1] - (b0[:, 1] - a0[:, 1]) * s[:, 0]) / den
    met = np.where(np.abs(den)[:, None] < 1e-12, a1, a0 + r * t[:, None])
    end = (i == j)[:, None]  # of two segments none is the one before and after
    return np.column_stack([np.where(end, p[:, :2] + w * n[i], met), p[:, 2]])


def centre_lines(vertices: DataFrame, margin: float) -> DataFrame:
    """Centre lines of polygons: midpoints of the triangulation's inner edges, linked to the longest path, its ends drawn on to the polygon's edge; z comes from the nearest vertices."""

    def run(a: np.ndarray) -> list[np.ndarray]:
        ring = g.closed(g.simplify(g.closed(a), margin))
        r = ring[:-1]
        inner: dict[tuple[int, int], list[int]] = {}
        triangles = g.triangulate(ring)
        for k, t in enumerate(triangles):
            for i, j in ((t[0], t[1]), (t[1], t[2]), (t[2], t[0])):
                if (abs(i - j) not in (1, len(r) - 1)):
                    inner.setdefault((min(i, j), max(i, j)), []).append(k)
        if not inner:
            return []
        if len(inner) == 1:  # four corners: between the middles of the two shortest sides
            sides = sorted((float(np.hypot(*(ring[i + 1, :2] - ring[i, :2]))), i) for i in range(len(r)))
            if sides[0][0] == sides[-1][0]:
                return []
            i, j = sides[0][1], sides[1][1]
            ends = [(ring[i] + ring[i + 1]) / 2, (ring[j] + ring[j + 1]) / 2]
            return [np.array([ends[0] + (ends[1] - ends[0]) * t for t in np.linspace(0, 1, 10)])]
        middle = {e: (r[e[0]] + r[e[1]]) / 2 for e in inner}
        near: dict[tuple, list[tuple]] = {e: [] for e in inner}
        for k, t in enumerate(triangles):
            own = [e for e, ks in inner.items() if k in ks]
            for x in own:
                near[x] += [y for y in own if y != x]
        path = max((_walk(near, e) for e in near if len(near[e]) == 1), key=len, default=[])
        line = np.array([middle[e] for e in path]).reshape(-1, 3)
        if len(line) < 2:
            return []
        for end in (0, -1):
            tip, back = line[end], line[1 if end == 0 else -2]
            d = (tip - back)[:2]
            far = np.array([tip[:2], tip[:2] + d / (np.hypot(*d) or 1) * g.length(ring)])
            hits = sorted(t for _, t, _, _ in g.crossings(far, ring) if t > 1e-9)
            if hits:
                at = far[0] + hits[0] * (far[1] - far[0])
                z = r[np.hypot(*(r[:, :2] - at).T).argmin(), 2]
                new = np.array([[*at, z]])
                line = np.vstack([new, line]) if end == 0 else np.vstack([line, new])
        return [line]

    return _each(vertices, run).drop("part")


def _walk(near: dict, start: tuple) -> list[tuple]:
    """The longest of the shortest paths from start."""
    came: dict = {start: None}
    queue = [start]
    for e in queue:
        for n in near[e]:
            if n not in came:
                came[n] = e
                queue.append(n)
    path, at = [], queue[-1]
    while at is not None:
        path.append(at)
        at = came[at]
    return path


def polygonize(lines: DataFrame, group: str = "grp") -> DataFrame:
    """Faces of line networks, by group: lines are cut at their crossings, dead ends fall away, and each bounded face is a ring.

    Rows: group, findex from 0 within it, seq, x, y, z, area. A group's lines meet in one task.
    """

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        all_lines = [x.sort_values("seq")[["x", "y", "z"]].to_numpy(float) for _, x in f.groupby("findex", sort=True)]
        z = {}
        edges = set()
        for i, a in enumerate(all_lines):
            cuts = [(s, t) for j, b in enumerate(all_lines) if j != i for s, t, _, _ in g.crossings(a, b)] + [(s, t) for s, t, j, _ in g.crossings(a, a) if s != j]
            for p in g.split_at(a, cuts + [(k, 0.0) for k in range(1, len(a) - 1)]):
                k = [tuple(np.round(q[:2], 7)) for q in p]
                z.update({q: v[2] for q, v in zip(k, p, strict=True)})
                edges |= {(k[0], k[1]), (k[1], k[0])} if k[0] != k[1] else set()
        while True:
            degree: dict = {}
            for s, _ in edges:
                degree[s] = degree.get(s, 0) + 1
            loose = {e for e in edges if degree[e[0]] < 2 or degree[e[1]] < 2}
            if not loose:
                break
            edges -= loose
        rows, n = [], 0
        for ring in g.link(sorted(edges)):
            if g.area(ring) > 0:
                rows += [(key[0], float(n), i, p[0], p[1], z[tuple(p)], g.area(ring)) for i, p in enumerate(ring)]
                n += 1
        return pd.DataFrame(rows, columns=[group, "findex", "seq", "x", "y", "z", "area"])

    kind = dict(lines.dtypes)[group]
    return lines.groupBy(group).applyInPandas(run, f"{group} {kind}, findex double, seq int, x double, y double, z double, area double")
