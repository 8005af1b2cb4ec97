"""Exports: city models, glTF, tiles, OBJ, voxel identifiers of solids, CSV and text forms."""

from __future__ import annotations

import base64
import json
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from terravane.operators import tiles as tl

#: Name spaces of city models.
SPACES = {"core": "http://www.opengis.net/citygml/2.0", "gml": "http://www.opengis.net/gml", "gen": "http://www.opengis.net/citygml/generics/2.0", "frn": "http://www.opengis.net/citygml/cityfurniture/2.0"}


def city_models(triangles: DataFrame, attributes: DataFrame, sheets: DataFrame, feature: str, crs: str, centre: DataFrame | None = None) -> DataFrame:
    """sheet, text: a city model for each map sheet. triangles: a triangle table; attributes: findex and generic attributes; sheets: findex, sheet; centre: vertices of centre lines or points.

    A sheet's features meet in one task, which its extent bounds.
    """
    names = [c for c in attributes.columns if c != "findex"]
    solids = triangles.groupBy("findex").agg(F.array_sort(F.collect_list(F.struct("patch", "k", "x", "y", "z"))).alias("solid"))
    rows = sheets.select("findex", "sheet").join(solids, "findex", "left").join(attributes.select("findex", *[F.col(c).cast("string").alias(c) for c in names]), "findex", "left")
    if centre is not None:
        rows = rows.join(centre.groupBy("findex").agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y", "z"))).alias("centre")), "findex", "left")
    else:
        rows = rows.withColumn("centre", F.lit(None).cast("array<struct<seq:int,x:double,y:double,z:double>>"))

    def ring(points) -> str:
        return " ".join(f"{p['x']:.6f} {p['y']:.6f} {p['z']:.6f}" for p in points)

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("findex")
        every = [p for r in f["solid"] if r is not None for p in r] + [p for r in f["centre"] if r is not None for p in r]
        low = [min((p[c] for p in every), default=0.0) for c in "xyz"]
        high = [max((p[c] for p in every), default=0.0) for c in "xyz"]
        out = ['<?xml version="1.0" encoding="UTF-8"?>', "<core:CityModel " + " ".join(f'xmlns:{k}="{v}"' for k, v in SPACES.items()) + ">"]
        out.append(f'<gml:boundedBy><gml:Envelope srsName="{escape(crs)}" srsDimension="3"><gml:lowerCorner>{" ".join(map(str, low))}</gml:lowerCorner><gml:upperCorner>{" ".join(map(str, high))}</gml:upperCorner></gml:Envelope></gml:boundedBy>')
        for r in f.to_dict("records"):
            out.append(f'<core:cityObjectMember><{feature} gml:id="{feature.split(":")[-1]}_{r["findex"]:.0f}">')
            out += [f'<gen:stringAttribute name="{escape(n)}"><gen:value>{escape(r[n])}</gen:value></gen:stringAttribute>' for n in names if isinstance(r[n], str)]
            if r["centre"] is not None and len(r["centre"]):
                tag = "LineString" if len(r["centre"]) > 1 else "Point"
                pos = "posList" if tag == "LineString" else "pos"
                out.append(f"<{feature.split(':')[0]}:lod1TerrainIntersection><gml:{tag}><gml:{pos}>{ring(r['centre'])}</gml:{pos}></gml:{tag}></{feature.split(':')[0]}:lod1TerrainIntersection>")
            if r["solid"] is not None and len(r["solid"]):
                out.append("<gml:MultiSurface>")
                for k in range(0, len(r["solid"]), 4):
                    out.append(f"<gml:surfaceMember><gml:Polygon><gml:exterior><gml:LinearRing><gml:posList>{ring(r['solid'][k : k + 4])}</gml:posList></gml:LinearRing></gml:exterior></gml:Polygon></gml:surfaceMember>")
                out.append("</gml:MultiSurface>")
            out.append(f"</{feature}></core:cityObjectMember>")
        out.append("</core:CityModel>")
        text = "\n".join(out)
        ET.fromstring(text)  # well formed, or the job fails
        return pd.DataFrame({"sheet": [key[0]], "text": [text]})

    return rows.groupBy("sheet").applyInPandas(run, "sheet string, text string")


def join_city_models(docs: DataFrame, start: str, end: str, order: str = "name", text: str = "text") -> DataFrame:
    """One text: the first document, with what lies between the first start tag and the last end tag of the others before its last line; lines end in CRLF."""
    rows = docs.agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("d"))  # the documents of one model
    inner = F.transform(F.slice("d", F.lit(2), F.greatest(F.size("d") - 1, F.lit(0))), lambda x: F.regexp_extract(x["t"], "(?s)" + _quoted(start) + ".*" + _quoted(end), 0))
    first = F.regexp_replace(F.regexp_replace(F.element_at("d", 1)["t"], "\r\n", "\n"), "\n$", "")
    head, tail = F.regexp_extract(first, r"(?s)^(.*)\n[^\n]*$", 1), F.substring_index(first, "\n", -1)
    return rows.select(F.regexp_replace(F.concat_ws("\n", head, F.concat_ws("\n", inner), tail), "\r?\n", "\r\n").alias("text"))


def _quoted(text: str) -> str:
    return r"\Q" + text + r"\E"


def obj_text(triangles: DataFrame) -> DataFrame:
    """line_no, line of an OBJ file: vertices without repeats, then faces. Vertices are numbered in order of position."""
    from terravane.plans.numbering import numbered

    t = triangles.where("k < 3")
    v = numbered(t.select("x", "y", "z").distinct(), ["x", "y", "z"], "n")
    total = v.count()
    faces = t.join(v, ["x", "y", "z"]).groupBy("findex", "patch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "n"))), lambda s: (s["n"] + 1).cast("string")), " ").alias("f"))
    faces = numbered(faces, ["findex", "patch"], "n")
    return v.select(F.col("n").alias("line_no"), F.concat_ws(" ", F.lit("v"), "x", "y", "z").alias("line")).unionAll(faces.select((F.col("n") + total).alias("line_no"), F.concat(F.lit("f "), "f").alias("line")))


def _gltf(frame: pd.DataFrame, attributes: list[str]) -> str:
    """A glTF document of one or more features, with their attributes as structural metadata."""
    keys = sorted(frame["findex"].unique())
    f = frame[frame["k"] < 3].sort_values(["findex", "patch", "k"])
    pos, nor = f[["x", "y", "z"]].to_numpy("<f4"), f[["nx", "ny", "nz"]].to_numpy("<f4")
    ids = f["findex"].map({k: i for i, k in enumerate(keys)}).to_numpy("<f4")
    parts = [pos.tobytes(), nor.tobytes(), ids.tobytes()]
    views, at = [], 0
    for p in parts:
        views.append({"buffer": 0, "byteOffset": at, "byteLength": len(p), "target": 34962})
        at += len(p)
    rows = frame.drop_duplicates("findex").sort_values("findex")
    columns = {}
    for a in attributes:
        data = ["" if not isinstance(x, str) else x for x in rows[a]]
        blob, offsets = "".join(data).encode(), np.cumsum([0] + [len(x.encode()) for x in data]).astype("<u4").tobytes()
        for p in (blob, offsets):
            p += b"\0" * (-len(p) % 8)
            parts.append(p)
            views.append({"buffer": 0, "byteOffset": at, "byteLength": len(p)})
            at += len(p)
        columns[a] = {"values": len(views) - 2, "stringOffsets": len(views) - 1}
    doc = {
        "asset": {"version": "2.0"}, "scene": 0, "scenes": [{"nodes": [0]}], "nodes": [{"mesh": 0}],
        "extensionsUsed": ["EXT_structural_metadata", "EXT_mesh_features"],
        "meshes": [{"primitives": [{"attributes": {"POSITION": 0, "NORMAL": 1, "_FEATURE_ID_0": 2}, "mode": 4, "extensions": {"EXT_mesh_features": {"featureIds": [{"featureCount": len(keys), "attribute": 0, "propertyTable": 0}]}}}]}],
        "accessors": [
            {"bufferView": 0, "componentType": 5126, "count": len(pos), "type": "VEC3", "min": pos.min(0).tolist() if len(pos) else [0, 0, 0], "max": pos.max(0).tolist() if len(pos) else [0, 0, 0]},
            {"bufferView": 1, "componentType": 5126, "count": len(pos), "type": "VEC3"},
            {"bufferView": 2, "componentType": 5126, "count": len(pos), "type": "SCALAR"},
        ],
        "bufferViews": views, "buffers": [{"byteLength": at, "uri": "data:application/octet-stream;base64," + base64.b64encode(b"".join(parts)).decode()}],
        "extensions": {"EXT_structural_metadata": {"schema": {"id": "features", "classes": {"feature": {"properties": {a: {"type": "STRING"} for a in attributes}}}}, "propertyTables": [{"class": "feature", "count": len(keys), "properties": columns}]}},
    }
    return json.dumps(doc)


def gltf(triangles: DataFrame, attributes: DataFrame, by: DataFrame | None = None) -> DataFrame:
    """tile, text: a glTF document a tile (by: findex, tile), or one a feature."""
    names = [c for c in attributes.columns if c != "findex"]
    tile = by if by is not None else triangles.select("findex", F.col("findex").cast("string").alias("tile")).distinct()
    rows = triangles.join(tile.select("findex", "tile"), "findex").join(attributes.select("findex", *[F.col(c).cast("string").alias(c) for c in names]), "findex", "left")
    return rows.groupBy("tile").applyInPandas(lambda key, f: pd.DataFrame({"tile": [key[0]], "text": [_gltf(f, names)]}), "tile string, text string")


def tileset(triangles: DataFrame, attributes: DataFrame, x_unit: float, y_unit: float) -> tuple[DataFrame, DataFrame]:
    """glTF documents a grid cell of the features' least corner, and their tileset rows: tile, uri and bounds in radians and metres. Coordinates are longitude and latitude."""
    corner = triangles.groupBy("findex").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    by = corner.select("findex", F.concat_ws("_", F.floor(F.col("x") / x_unit).cast("string"), F.floor(F.col("y") / y_unit).cast("string")).alias("tile"))
    box = triangles.join(by, "findex").groupBy("tile").agg(*[F.radians(f(c)).alias(n) for c, f, n in (("x", F.min, "west"), ("y", F.min, "south"), ("x", F.max, "east"), ("y", F.max, "north"))], F.min("z").alias("low"), F.max("z").alias("high"))
    return gltf(triangles, attributes, by), box.withColumn("uri", F.concat("tile", F.lit(".gltf")))


def tileset_json(rows: DataFrame, error: float = 100.0) -> str:
    """The root document over a tileset's rows, a child a tile."""
    children = [{"boundingVolume": {"region": [r["west"], r["south"], r["east"], r["north"], r["low"], r["high"]]}, "geometricError": 0, "content": {"uri": r["uri"]}} for r in rows.orderBy("tile").toLocalIterator()]
    region = [f(c["boundingVolume"]["region"][i] for c in children) for i, f in enumerate((min, min, max, max, min, max))] if children else [0] * 6
    return json.dumps({"asset": {"version": "1.1"}, "geometricError": error, "root": {"boundingVolume": {"region": region}, "geometricError": error, "refine": "ADD", "children": children}})


def object_csv(features: DataFrame, object_id: str, kind: int) -> DataFrame:
    """object_id, type (1 or 2) and the other attributes as JSON, without repeats."""
    rest = [c for c in features.columns if c != object_id]
    return features.select(F.col(object_id).cast("string").alias("object_id"), F.lit(kind).alias("type"), F.to_json(F.struct(*rest)).alias("attributes")).distinct()


def fields_csv(fields: list[DataFrame]) -> DataFrame:
    """Field tables joined on findex, columns in order of name, without findex."""
    out = fields[0]
    for f in fields[1:]:
        out = out.join(f, "findex")
    return out.select(sorted(c for c in out.columns if c != "findex"))


def line_voxels(vertices: DataFrame, sizes: DataFrame, zoom: int, epsg: int) -> DataFrame:
    """findex, voxel: identifiers of the cells that tubes of a width and height around lines fill, sampled at half a cell's size."""
    from terravane.functions.crs import reproject
    from terravane.operators.spatial import segments

    cell = 2.0 ** (tl.HEIGHT_EXPONENT - zoom) / 2
    s = segments(vertices).join(sizes.select(F.col("findex").alias("line"), "width", "height"), "line")
    d = F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2) + F.pow(F.col("bz") - F.col("az"), 2))
    s = s.withColumn("d", d).withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("d") / cell)))
    along = s.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n")))).withColumn("t", F.col("i") / F.col("n"))
    planar = F.greatest(F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2)), F.lit(1e-12))
    steps = lambda c: F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(1), F.ceil(F.col(c) / cell))), lambda k: k / F.greatest(F.lit(1), F.ceil(F.col(c) / cell)) - 0.5)
    p = along.withColumn("a", F.explode(steps("width"))).withColumn("b", F.explode(steps("height")))
    at = lambda c: F.col(f"a{c}") + F.col("t") * (F.col(f"b{c}") - F.col(f"a{c}"))
    pts = p.select(F.col("line").alias("findex"), (at("x") + F.col("a") * F.col("width") * (F.col("by") - F.col("ay")) / planar).alias("x"), (at("y") - F.col("a") * F.col("width") * (F.col("bx") - F.col("ax")) / planar).alias("y"), (at("z") + F.col("b") * F.col("height")).alias("z"))
    return reproject(pts, epsg, 6668).select("findex", tl.voxel_id(F.col("x"), F.col("y"), F.col("z"), zoom).alias("voxel")).distinct()


def cylinder_voxels(vertices: DataFrame, radii: DataFrame, zoom: int, epsg: int) -> DataFrame:
    """Like line_voxels, for tubes of a radius: samples off the circle fall away."""
    from terravane.functions.crs import reproject
    from terravane.operators.spatial import segments

    cell = 2.0 ** (tl.HEIGHT_EXPONENT - zoom) / 2
    s = segments(vertices).join(radii.select(F.col("findex").alias("line"), "radius"), "line")
    d = F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2) + F.pow(F.col("bz") - F.col("az"), 2))
    s = s.withColumns({"n": F.greatest(F.lit(1), F.ceil(d / cell)), "m": F.greatest(F.lit(1), F.ceil(F.col("radius") / cell))})
    grid = F.sequence(-F.col("m"), F.col("m"))
    p = s.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n")))).withColumn("a", F.explode(grid)).withColumn("b", F.explode(grid)).where("a * a + b * b <= m * m")
    t, planar = F.col("i") / F.col("n"), F.greatest(F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2)), F.lit(1e-12))
    at = lambda c: F.col(f"a{c}") + t * (F.col(f"b{c}") - F.col(f"a{c}"))
    k = F.col("radius") / F.col("m")
    pts = p.select(F.col("line").alias("findex"), (at("x") + F.col("a") * k * (F.col("by") - F.col("ay")) / planar).alias("x"), (at("y") - F.col("a") * k * (F.col("bx") - F.col("ax")) / planar).alias("y"), (at("z") + F.col("b") * k).alias("z"))
    return reproject(pts, epsg, 6668).select("findex", tl.voxel_id(F.col("x"), F.col("y"), F.col("z"), zoom).alias("voxel")).distinct()


def voxel_csv(voxels: DataFrame, start: str, end: str) -> DataFrame:
    """Lines voxel,findex,start,end."""
    return voxels.select(F.concat_ws(",", "voxel", F.col("findex").cast("string"), F.lit(start), F.lit(end)).alias("line"))


def raster_lines(vertices: DataFrame, zoom: int, size: int) -> DataFrame:
    """tile, px, py: pixels of densified lines in zoom tiles of size x size pixels (x, y: longitude, latitude), each with how many samples fell on it."""
    fx, fy = (F.col("x") + 180) / 360 * 2**zoom, (1 - F.ln(F.tan(F.radians("y")) + 1 / F.cos(F.radians("y"))) / np.pi) / 2 * 2**zoom
    rows = vertices.select(fx.alias("u"), fy.alias("v"))
    return rows.select(F.concat_ws("/", F.lit(zoom), F.floor("u"), F.floor("v")).alias("tile"), F.floor((F.col("u") - F.floor("u")) * size).alias("px"), F.floor((F.col("v") - F.floor("v")) * size).alias("py")).groupBy("tile", "px", "py").agg(F.count("*").alias("n"))


def draw(shapes: DataFrame, areas: DataFrame, scale: float) -> DataFrame:
    """Images of lines and outlines (vertices: findex, seq, x, y) on white, an image for each clip area (area, x_min, y_min, x_max, y_max)."""
    from terravane.functions import pixels as px
    from terravane.operators.images import COLUMNS, SCHEMA, row_of

    w = Window.partitionBy("findex").orderBy("seq")
    segs = shapes.select("findex", "x", "y", F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2")).withColumns({"x2": F.coalesce("x2", "x"), "y2": F.coalesce("y2", "y")})
    met = segs.join(F.broadcast(areas), (F.least("x", "x2") <= F.col("x_max")) & (F.greatest("x", "x2") >= F.col("x_min")) & (F.least("y", "y2") <= F.col("y_max")) & (F.greatest("y", "y2") >= F.col("y_min")))  # clip areas are a list the user wrote

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        r = f.iloc[0]
        img = np.full((int(np.ceil((r["y_max"] - r["y_min"]) * scale)), int(np.ceil((r["x_max"] - r["x_min"]) * scale)), 3), 255, np.uint8)
        for s in f.itertuples():
            px.draw_line(img, *(int(np.floor(v)) for v in ((s.x - r["x_min"]) * scale, (r["y_max"] - s.y) * scale, (s.x2 - r["x_min"]) * scale, (r["y_max"] - s.y2) * scale)))
        return pd.DataFrame([row_of(str(key[0]), 0.0, "RGB", img)], columns=COLUMNS)

    return met.groupBy("area").applyInPandas(run, SCHEMA)
