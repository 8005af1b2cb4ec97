"""Readers and writers of map formats. Files come as rows of path and content (Spark's binaryFile), so any file system that Spark reads will do."""

from __future__ import annotations

import io
import json
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE = "path string, findex double, gtype string, parts array<array<struct<x:double,y:double,z:double>>>, attributes map<string,string>"
#: Type codes of fixed-width definitions.
CODES = {1: "bigint", 2: "double", 3: "string", 4: "binary"}


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", definition: list[tuple[str, int]] | None = None, header: bool = True) -> DataFrame:
    """CSV in an encoding: with a definition (name, code 1 int, 2 float, 3 text) columns are read as text and cast by position, else types are inferred."""
    reader = spark.read.option("header", header).option("encoding", encoding)
    if definition is None:
        return reader.option("inferSchema", True).csv(path)
    df = reader.csv(path)
    return df.select(*[F.col(f"`{c}`").cast(CODES[code]).alias(name) for c, (name, code) in zip(df.columns, definition, strict=True)])


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """Features of GeoJSON collections: findex from 0 in a file, gtype, parts, all properties as text, and for MultiPolygons in ring_counts how many of the parts are each polygon's rings."""
    shape = "struct<features: array<struct<geometry: struct<type: string, coordinates: string>, properties: map<string, string>>>>"
    docs = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", shape).alias("d"))
    f = docs.select("path", F.posexplode("d.features").alias("findex", "f")).select("path", F.col("findex").cast("double").alias("findex"), F.col("f.geometry.type").alias("gtype"), F.col("f.geometry.coordinates").alias("c"), F.col("f.properties").alias("attributes"))
    depth = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}
    point = lambda a: F.struct(F.get(a, F.lit(0)).alias("x"), F.get(a, F.lit(1)).alias("y"), F.get(a, F.lit(2)).alias("z"))

    def parts(kind: str, n: int) -> Column:
        v = F.from_json("c", "array<" * (n + 1) + "double" + ">" * (n + 1))
        if n == 0:
            return F.array(F.array(point(v)))
        if n == 1:
            return F.transform(v, lambda p: F.array(point(p))) if kind == "MultiPoint" else F.array(F.transform(v, point))
        return F.transform(v if n == 2 else F.flatten(v), lambda line: F.transform(line, point))

    rule = F.lit(None).cast("array<array<struct<x:double,y:double,z:double>>>")
    for kind, n in depth.items():
        rule = F.when(F.col("gtype") == kind, parts(kind, n)).otherwise(rule)
    polygons = F.from_json("c", "array<array<array<array<double>>>>")
    return f.select("path", "findex", "gtype", rule.alias("parts"), "attributes", F.when(F.col("gtype") == "MultiPolygon", F.transform(polygons, F.size)).alias("ring_counts"))


def to_geojson(features: DataFrame) -> DataFrame:
    """A row of text a feature, ready to be wrapped in a collection."""
    xyz = lambda p: F.array(p["x"], p["y"], F.coalesce(p["z"], F.lit(0.0)))
    lines = F.transform("parts", lambda a: F.transform(a, xyz))
    # without the rings of each polygon, all are one polygon's
    rings = F.coalesce("ring_counts", F.array(F.size("parts"))) if "ring_counts" in features.columns else F.array(F.size("parts"))
    begin = lambda i: F.aggregate(F.slice(rings, F.lit(1), i), F.lit(1), lambda a, n: a + n)
    kinds = {
        "Point": lines[0][0],
        "MultiPoint": F.transform(lines, lambda a: a[0]),
        "LineString": lines[0],
        "Polygon": lines,
        "MultiPolygon": F.transform(F.sequence(F.lit(0), F.size(rings) - 1), lambda i: F.slice(lines, begin(i), F.get(rings, i))),
    }
    c = F.to_json(lines)
    for k, shape in kinds.items():
        c = F.when(F.col("gtype") == k, F.to_json(shape)).otherwise(c)
    kind = F.when(F.col("gtype").isin(*kinds), F.col("gtype")).otherwise("MultiLineString")
    return features.select(F.concat(F.lit('{"type":"Feature","geometry":{"type":"'), kind, F.lit('","coordinates":'), c, F.lit('},"properties":'), F.coalesce(F.to_json("attributes"), F.lit("{}")), F.lit("}")).alias("value"))


def fixed_width(rows: DataFrame, content: str, definition: list[tuple[str, int, int]], encoding: str = "UTF-8") -> DataFrame:
    """Records of fixed widths one behind the other: definition (name, code, bytes). NUL reads '0' in numbers and nothing in text; an incomplete last record is left out."""
    width = sum(d[2] for d in definition)
    data = F.col(content).cast("binary")
    n = F.floor(F.octet_length(data) / width)
    recs = rows.select(*[c for c in rows.columns if c != content], F.posexplode(F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.substring(data, (i * width + 1).cast("int"), F.lit(width))))).alias("record", "__r"))
    at, cols = 1, []
    for name, code, size in definition:
        raw = F.substring(F.col("__r"), at, size)
        if code != 4:
            raw = F.decode(raw, encoding)
            raw = F.regexp_replace(raw, "\x00", "0" if code in (1, 2) else "")
            raw = F.trim(raw).cast(CODES[code]) if code in (1, 2) else raw
        cols.append(raw.alias(name))
        at += size
    return recs.select(*[c for c in recs.columns if c != "__r"], *cols)


def header_body_footer(rows: DataFrame, content: str, header: list, body: list, footer: list, encoding: str = "UTF-8") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fixed-width content with a header and footer around repeated body records, as three tables."""
    size = lambda d: sum(x[2] for x in d)
    data = F.col(content).cast("binary")
    h, f = size(header), size(footer)
    total = F.octet_length(data)
    rest = (F.floor((total - h - f) / max(size(body), 1)) * max(size(body), 1)).cast("int")
    keep = [c for c in rows.columns if c != content]
    part = lambda start, n: rows.select(*keep, F.substring(data, start, n).alias(content))
    return (
        fixed_width(part(F.lit(1), F.lit(h)), content, header, encoding) if header else rows.limit(0),
        fixed_width(part(F.lit(h + 1), rest), content, body, encoding) if body else rows.limit(0),
        fixed_width(part((F.lit(h + 1) + rest).cast("int"), F.lit(f)), content, footer, encoding) if footer else rows.limit(0),
    )


def digits_to_number(text: Column, base: int, width: int, signed: bool = False) -> Column:
    """Hexadecimal or binary digits as a number, with two's complement on request; width in digits."""
    v = F.conv(text, base, 10).cast("decimal(20,0)").cast("bigint")
    bits = width * (4 if base == 16 else 1)
    return F.when(v >= (1 << (bits - 1)), v - (1 << bits)).otherwise(v) if signed and bits < 64 else v


def split_digits(rows: DataFrame, key: str, text: str, base: int, header: list[tuple[str, int]], loop: int, body: list[tuple[str, int]], footer: list[tuple[str, int]]) -> DataFrame:
    """Walks a string of hexadecimal or binary digits: header fields by byte width, as many body records as the header field number `loop` says, a footer, and again until the end. Pieces stay text."""
    unit = 2 if base == 16 else 8
    names = [n for n, _ in header] + ["body"] + [n for n, _ in footer]
    kind = dict(rows.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for k, t in zip(f[key], f[text], strict=True):
                at, n = 0, 0
                while t is not None and at < len(t):
                    row = []
                    for _, w in header:
                        row.append(t[at : at + w * unit])
                        at += w * unit
                    size = int(row[loop] or "0", base) * sum(w for _, w in body) * unit
                    row.append(t[at : at + size])
                    at += size
                    for _, w in footer:
                        row.append(t[at : at + w * unit])
                        at += w * unit
                    out.append((k, n, *row))
                    n += 1
            yield pd.DataFrame(out, columns=[key, "record", *names])

    return rows.select(key, text).mapInPandas(run, f"{key} {kind}, record int, " + ", ".join(f"{n} string" for n in names))


def _dbf(data: bytes, encoding: str) -> list[dict]:
    n, head, width = struct.unpack_from("<IHH", data, 4)
    fields, at, pos = [], 32, 1
    while at < head - 1 and data[at] != 0x0D:
        name = data[at : at + 11].split(b"\0")[0].decode(encoding)
        fields.append((name, pos, data[at + 16]))
        pos += data[at + 16]
        at += 32
    rows = [data[head + i * width : head + (i + 1) * width] for i in range(n)]
    return [{k: r[p : p + w].decode(encoding, "replace").strip() or None for k, p, w in fields} for r in rows]


def _shp(data: bytes) -> list[tuple[str, list]]:
    out, at = [], 100
    while at + 8 <= len(data):
        (size,) = struct.unpack_from(">i", data, at + 4)
        rec = data[at + 8 : at + 8 + 2 * size]
        at += 8 + 2 * size
        (kind,) = struct.unpack_from("<i", rec)
        has_z = kind in (11, 13, 15, 18)
        if kind == 0:
            out.append((None, None))
        elif kind in (1, 11, 21):
            p = struct.unpack_from("<3d" if has_z else "<2d", rec, 4)
            out.append(("Point", [[p]]))
        else:
            several = kind % 10 in (3, 5)
            m, n = struct.unpack_from("<2i", rec, 36) if several else (1, struct.unpack_from("<i", rec, 36)[0])
            starts = list(struct.unpack_from(f"<{m}i", rec, 44)) if several else [0]
            base = 44 + 4 * m if several else 40
            xy = np.frombuffer(rec, "<f8", 2 * n, base).reshape(-1, 2)
            z = np.frombuffer(rec, "<f8", n, base + 16 * n + 16) if has_z else np.full(n, np.nan)
            pts = np.c_[xy, z]
            parts = [pts[a:b].tolist() for a, b in zip(starts, [*starts[1:], n], strict=True)]
            name = {3: "LineString", 5: "Polygon", 8: "MultiPoint"}[kind % 10]
            out.append((name if name != "LineString" or m == 1 else "MultiLineString", [[p] for p in pts.tolist()] if name == "MultiPoint" else parts))
    return out


def _points(parts) -> list | None:
    return None if parts is None else [[{"x": p[0], "y": p[1], "z": None if len(p) < 3 or p[2] != p[2] else p[2]} for p in a] for a in parts]


def read_shapefiles(binary: DataFrame, encoding: str = "cp932", dx: float = 0.0, dy: float = 0.0, scale: float = 1.0) -> DataFrame:
    """Zipped shapefiles as features; positions are moved, then scaled about (0, 0)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                z = zipfile.ZipFile(io.BytesIO(content))
                out = []
                for name in (n for n in z.namelist() if n.lower().endswith(".shp")):
                    dbf = next((n for n in z.namelist() if n.lower() == name.lower()[:-4] + ".dbf"), None)
                    rows = _dbf(z.read(dbf), encoding) if dbf else []
                    for i, (kind, parts) in enumerate(_shp(z.read(name))):
                        moved = _points([[((p[0] + dx) * scale, (p[1] + dy) * scale, *p[2:]) for p in a] for a in parts] if parts else None)
                        out.append((path, float(i), kind, moved, rows[i] if i < len(rows) else {}))
                yield pd.DataFrame(out, columns=["path", "findex", "gtype", "parts", "attributes"])

    return binary.select("path", "content").mapInPandas(run, FEATURE)


def shapefile_bytes(features: list[dict], encoding: str = "cp932") -> bytes:
    """A zipped shapefile (.shp, .shx, .dbf) of features of one kind, for a sink that writes one file a group."""
    kind = {"Point": 11, "LineString": 13, "MultiLineString": 13, "Polygon": 15}[features[0]["gtype"]]
    recs, every = [], []
    for f in features:
        parts = [[(p["x"], p["y"], p["z"] or 0.0) for p in a] for a in f["parts"]]
        pts = np.array([p for a in parts for p in a], float)
        every.append(pts)
        if kind == 11:
            recs.append(struct.pack("<i4d", kind, *pts[0], 0.0))
            continue
        starts = np.cumsum([0] + [len(a) for a in parts])[:-1]
        recs.append(struct.pack("<i4d2i", kind, *pts[:, :2].min(0), *pts[:, :2].max(0), len(parts), len(pts)) + starts.astype("<i4").tobytes() + pts[:, :2].astype("<f8").tobytes() + struct.pack("<2d", pts[:, 2].min(), pts[:, 2].max()) + pts[:, 2].astype("<f8").tobytes())
    p = np.vstack(every)

    def head(size: int) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", 1000, kind, *p[:, :2].min(0), *p[:, :2].max(0), p[:, 2].min(), p[:, 2].max(), 0, 0)

    shp, shx, at = b"", b"", 50
    for i, r in enumerate(recs):
        shp += struct.pack(">2i", i + 1, len(r) // 2) + r
        shx += struct.pack(">2i", at, len(r) // 2)
        at += 4 + len(r) // 2
    names = sorted({k for f in features for k in f["attributes"]})
    cols = [[str(f["attributes"].get(n) or "").encode(encoding, "replace")[:254] for f in features] for n in names]
    widths = [max([1, *map(len, c)]) for c in cols]
    dbf = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(features), 33 + 32 * len(names), 1 + sum(widths))
    for n, w in zip(names, widths, strict=True):
        dbf += struct.pack("<11scIBB14x", n.encode(encoding, "replace")[:10], b"C", 0, w, 0)
    dbf += b"\r" + b"".join(b" " + b"".join(c[i].ljust(w) for c, w in zip(cols, widths, strict=True)) for i in range(len(features))) + b"\x1a"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("features.shp", head(100 + len(shp)) + shp)
        z.writestr("features.shx", head(100 + len(shx)) + shx)
        z.writestr("features.dbf", dbf)
    return out.getvalue()


def to_shapefiles(features: DataFrame, by: list[str], encoding: str = "cp932") -> DataFrame:
    """by columns and content: a zipped shapefile a group; a group's features meet in one task, as one file must hold them."""
    kinds = dict(features.dtypes)

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        rows = [{"gtype": r["gtype"], "parts": r["parts"], "attributes": dict(r["attributes"])} for r in f.sort_values("findex").to_dict("records")]
        return pd.DataFrame({**{b: [k] for b, k in zip(by, key, strict=True)}, "content": [shapefile_bytes(rows, encoding)]})

    return features.groupBy(*by).applyInPandas(run, ", ".join(f"{b} {kinds[b]}" for b in by) + ", content binary")


def read_dxf(binary: DataFrame, encoding: str = "cp932", origin_x: float = 0.0, origin_y: float = 0.0, scale: float = 1.0) -> DataFrame:
    """LINE, POLYLINE, LWPOLYLINE, ARC, CIRCLE, TEXT and POINT of DXF drawings, blocks inserted at their points; x = origin + scale * x."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                yield pd.DataFrame([(path, float(i), k, _points([[(origin_x + scale * x, origin_y + scale * y, z) for x, y, z in a] for a in parts]), at) for i, (k, parts, at) in enumerate(_dxf(content.decode(encoding, "replace")))], columns=["path", "findex", "gtype", "parts", "attributes"])

    return binary.select("path", "content").mapInPandas(run, FEATURE)


def _dxf(text: str) -> list[tuple[str, list, dict]]:
    lines = text.splitlines()
    pairs = [(int(a), b.strip()) for a, b in zip(lines[::2], lines[1::2], strict=False) if a.strip().lstrip("-").isdigit()]
    entities: list[list[tuple[int, str]]] = []
    for code, value in pairs:
        if code == 0:
            entities.append([(0, value)])
        elif entities:
            entities[-1].append((code, value))
    blocks: dict[str, list] = {}
    main: list = []
    section, block, poly = "", None, None
    for e in entities:
        kind, get = e[0][1], dict(e[::-1])
        if kind == "SECTION":
            section = get.get(2, "")
        elif kind == "BLOCK":
            block = blocks.setdefault(get.get(2, ""), [])
        elif kind == "ENDBLK":
            block = None
        elif kind == "POLYLINE":
            poly = (e, [])
        elif kind == "VERTEX" and poly:
            poly[1].append(tuple(float(get.get(c, 0)) for c in (10, 20, 30)))
        elif kind == "SEQEND" and poly:
            (block if block is not None else main).append(("POLYLINE", poly[0], poly[1]))
            poly = None
        elif section in ("ENTITIES", "BLOCKS"):
            (block if block is not None else main).append((kind, e, None))

    def shapes(items: list, ox: float, oy: float, depth: int) -> Iterator[tuple[str, list, dict]]:
        for kind, e, points in items:
            get = dict(e[::-1])
            num = lambda c, d=0.0, get=get: float(get.get(c, d))
            at = {"type": kind, "layer": get.get(8, "")}
            move = lambda ps: [(x + ox, y + oy, z) for x, y, z in ps]
            if kind == "LINE":
                yield "LineString", [move([(num(10), num(20), num(30)), (num(11), num(21), num(31))])], at
            elif kind in ("POLYLINE", "LWPOLYLINE"):
                ps = points if points is not None else [(x, y, num(38)) for x, y in zip((float(v) for c, v in e if c == 10), (float(v) for c, v in e if c == 20), strict=True)]
                if int(num(70)) & 1 and ps:
                    yield "Polygon", [move([*ps, ps[0]])], at
                elif ps:
                    yield "LineString", [move(ps)], at
            elif kind in ("ARC", "CIRCLE"):
                a, b = (np.radians(num(50)), np.radians(num(51))) if kind == "ARC" else (0.0, 2 * np.pi)
                t = np.linspace(a, b if b > a else b + 2 * np.pi, 101)
                yield ("LineString" if kind == "ARC" else "Polygon"), [move([(num(10) + num(40) * c, num(20) + num(40) * s, num(30)) for c, s in zip(np.cos(t), np.sin(t), strict=True)])], at | {"radius": str(num(40)), "center": f"{num(10) + ox},{num(20) + oy}"}
            elif kind == "TEXT":
                yield "Point", [move([(num(10), num(20), num(30))])], at | {"text": get.get(1, ""), "rotation": str(num(50)), "height": str(num(40)), "align": str(int(num(72)))}
            elif kind == "POINT":
                yield "Point", [move([(num(10), num(20), num(30))])], at
            elif kind == "INSERT" and depth < 16:
                yield from shapes(blocks.get(get.get(2, ""), []), ox + num(10), oy + num(20), depth + 1)

    return list(shapes(main, 0.0, 0.0, 0))


def read_geotiff(binary: DataFrame) -> DataFrame:
    """path, origin_x, origin_y, cell_x, cell_y, row, col, z of uncompressed single-band GeoTIFFs."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for path, data in zip(f["path"], f["content"], strict=True):
                info = tiff_info(data)
                a = info["pixels"]
                r, c = np.indices(a.shape)
                yield pd.DataFrame({"path": path, "origin_x": info["origin_x"], "origin_y": info["origin_y"], "cell_x": info["cell_x"], "cell_y": info["cell_y"], "row": r.ravel(), "col": c.ravel(), "z": a.ravel().astype(float)})

    return binary.select("path", "content").mapInPandas(run, "path string, origin_x double, origin_y double, cell_x double, cell_y double, row long, col long, z double")


def tiff_info(data: bytes) -> dict:
    """Position, cell size and pixels by the tags of a TIFF."""
    o = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(o + "I", data, 4)
    (n,) = struct.unpack_from(o + "H", data, at)
    sizes = {1: "B", 2: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d"}
    tags = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(o + "HHI", data, at + 2 + 12 * i)
        code = sizes.get(kind)
        if code:
            size = struct.calcsize(code) * count
            pos = at + 10 + 12 * i if size <= 4 else struct.unpack_from(o + "I", data, at + 10 + 12 * i)[0]
            tags[tag] = struct.unpack_from(f"{o}{count}{code}", data, pos)
    if tags.get(259, (1,))[0] != 1:
        raise ValueError("only uncompressed pictures are read")
    w, h, bits, form = tags[256][0], tags[257][0], tags[258][0], tags.get(339, (1,))[0]
    dtype = np.dtype({1: "u", 2: "i", 3: "f"}[form] + str(bits // 8)).newbyteorder(o)
    raw = b"".join(data[p : p + c] for p, c in zip(tags[273], tags[279], strict=True))
    scale, tie = tags.get(33550, (1.0, 1.0, 0.0)), tags.get(33922, (0.0,) * 6)
    return {"origin_x": tie[3] - tie[0] * scale[0], "origin_y": tie[4] + tie[1] * scale[1], "cell_x": scale[0], "cell_y": -scale[1], "pixels": np.frombuffer(raw, dtype, w * h).reshape(h, w)}


def to_fields(df: DataFrame, group: str, definition: dict[str, str] | None = None) -> DataFrame:
    """Long form of a table: dwh (group/name), type, findex, value as text."""
    names = definition or {c: c for c in df.columns if c != "findex"}
    kinds = dict(df.dtypes)
    return df.select("findex", F.inline(F.array(*[F.struct(F.lit(f"{group}/{n}").alias("dwh"), F.lit(kinds[c]).alias("type"), F.col(c).cast("string").alias("value")) for c, n in names.items()]))).select("dwh", "type", "findex", "value")


def from_fields(fields: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A table of the long form: columns maps dwh names to types."""
    return fields.groupBy("findex").agg(*[F.max(F.when(F.col("dwh") == d, F.col("value"))).cast(t).alias(d.split("/")[-1]) for d, t in columns.items()])


def features_to_vertices(features: DataFrame) -> DataFrame:
    """findex, gtype, part, seq, x, y, z."""
    return features.select("findex", "gtype", F.posexplode("parts").alias("part", "a")).select("findex", "gtype", "part", F.posexplode("a").alias("seq", "p")).select("findex", "gtype", "part", "seq", "p.x", "p.y", "p.z")


def image_page(name: str, title: str) -> str:
    """An HTML page that shows an image and links to it."""
    from html import escape

    return f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{escape(title)}</title></head><body><a href="{escape(name)}"><img src="{escape(name)}" alt="{escape(title)}"></a></body></html>'


def write_text(df: DataFrame, path: str, column: str = "value", overwrite: bool = False) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def options_from(rows: list[tuple[str, str]]) -> dict[str, object]:
    """Reader options of OPTION, VALUE rows, values read as JSON where they are JSON and as text else; nothing is evaluated."""
    out: dict[str, object] = {}
    for k, v in rows:
        try:
            out[k] = json.loads(v)
        except (TypeError, ValueError):
            out[k] = v
    return out
