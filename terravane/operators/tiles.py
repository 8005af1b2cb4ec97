"""Map sheets, regional meshes, zoom tiles and voxel identifiers, as arithmetic on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A map sheet of level 50000 is 40 km wide and 30 km high; zones have 8 columns and 20 rows of them, from the origin's 4 to the west and 10 to the north.
SHEET_WIDTH, SHEET_HEIGHT, COLUMNS, ROWS = 40_000.0, 30_000.0, 8, 20
#: Fixed value: heights of voxels run to 2 ** 25 metres.
HEIGHT_EXPONENT = 25
#: EPSG codes 6669 to 6687 are zones 1 to 19 of the plane rectangular system.
FIRST_ZONE = 6668


def zone_of(epsg: int) -> str:
    if not 1 <= epsg - FIRST_ZONE <= 19:
        raise ValueError(f"EPSG {epsg} is not a zone of the plane rectangular system")
    return f"{epsg - FIRST_ZONE:02d}"


def _letter(index: Column) -> Column:
    return F.char((index + 65).cast("int"))


def sheet_code(x: Column, y: Column, zone: str, level: int = 2500) -> Column:
    """The map sheet that holds a point: zone, row and column letters, and by level 2 digits (5000), a quarter (2500) or 2 more digits (500); null outside the zone's sheets."""
    col, row = F.floor(x / SHEET_WIDTH) + COLUMNS // 2, F.floor(-y / SHEET_HEIGHT) + ROWS // 2
    dx, dy = x - F.floor(x / SHEET_WIDTH) * SHEET_WIDTH, -y - F.floor(-y / SHEET_HEIGHT) * SHEET_HEIGHT  # from the sheet's left and top
    code = [F.lit(zone), _letter(row), _letter(col)]
    if level <= 5000:
        w, h = SHEET_WIDTH / 10, SHEET_HEIGHT / 10
        code += [F.floor(dy / h).cast("string"), F.floor(dx / w).cast("string")]
        dx, dy = dx - F.floor(dx / w) * w, dy - F.floor(dy / h) * h
        if level == 2500:
            code.append((F.floor(dy / (h / 2)) * 2 + F.floor(dx / (w / 2)) + 1).cast("string"))
        elif level == 500:
            code += [F.floor(dy / (h / 10)).cast("string"), F.floor(dx / (w / 10)).cast("string")]
    return F.when(col.between(0, COLUMNS - 1) & row.between(0, ROWS - 1), F.concat(*code))


def sheet_bounds(code: Column) -> Column:
    """struct(x_min, y_min, x_max, y_max) of a map sheet code of 4, 6, 7 or 8 characters."""
    n = F.length(code)
    digit = lambda i: F.when(n >= i, F.substring(code, i, 1).cast("int")).otherwise(F.lit(0))
    x = (F.ascii(F.substring(code, 4, 1)) - 65 - COLUMNS // 2) * SHEET_WIDTH + F.when(n >= 6, digit(6) * (SHEET_WIDTH / 10)).otherwise(F.lit(0.0))
    top = -(F.ascii(F.substring(code, 3, 1)) - 65 - ROWS // 2) * SHEET_HEIGHT - F.when(n >= 6, digit(5) * (SHEET_HEIGHT / 10)).otherwise(F.lit(0.0))
    x = x + F.when(n == 7, ((digit(7) - 1) % 2) * (SHEET_WIDTH / 20)).when(n == 8, digit(8) * (SHEET_WIDTH / 100)).otherwise(F.lit(0.0))
    top = top - F.when(n == 7, F.floor((digit(7) - 1) / 2) * (SHEET_HEIGHT / 20)).when(n == 8, digit(7) * (SHEET_HEIGHT / 100)).otherwise(F.lit(0.0))
    share = F.when(n == 4, 1.0).when(n == 6, 0.1).when(n == 7, 0.05).otherwise(0.01)
    return F.struct(x.alias("x_min"), (top - SHEET_HEIGHT * share).alias("y_min"), (x + SHEET_WIDTH * share).alias("x_max"), top.alias("y_max"))


def sheets_of_boxes(boxes: DataFrame, zone: str, level: int = 2500) -> DataFrame:
    """boxes (x_min, y_min, x_max, y_max) with a row for each sheet they touch: column sheet."""
    part = {50000: 1, 5000: 10, 2500: 20, 500: 100}[level]
    w, h = SHEET_WIDTH / part, SHEET_HEIGHT / part
    cells = boxes.withColumn("__i", F.explode(F.sequence(F.floor(F.col("x_min") / w), F.floor(F.col("x_max") / w)))).withColumn("__j", F.explode(F.sequence(F.floor(-F.col("y_max") / h), F.floor(-F.col("y_min") / h))))
    return cells.withColumn("sheet", sheet_code((F.col("__i") + 0.5) * w, -(F.col("__j") + 0.5) * h, zone, level)).drop("__i", "__j").where("sheet is not null")


def sheet_codes_text(boxes: DataFrame, zone: str, level: int = 2500) -> DataFrame:
    """All sheets touched, joined by @ in order of their digits and then their letters."""
    codes = sheets_of_boxes(boxes, zone, level).select("sheet").distinct()
    by = F.struct(F.substring("sheet", 5, 4).alias("n"), F.col("sheet").alias("sheet"))
    return codes.agg(F.array_join(F.transform(F.array_sort(F.collect_list(by)), lambda s: s["sheet"]), "@").alias("sheets"))


def mesh_code(lon: Column, lat: Column, level: int = 3) -> Column:
    """Regional mesh: first (40' x 1 degree), second (8 x 8 of it) or third (10 x 10 of that)."""
    u, v = lat * 1.5, lon - 100
    p, q = F.floor(u), F.floor(v)
    code = F.concat(F.lpad(p.cast("string"), 2, "0"), F.lpad(q.cast("string"), 2, "0"))
    if level >= 2:
        r, s = (u - p) * 8, (v - q) * 8
        code = F.concat(code, F.floor(r).cast("string"), F.floor(s).cast("string"))
        if level >= 3:
            code = F.concat(code, F.floor((r - F.floor(r)) * 10).cast("string"), F.floor((s - F.floor(s)) * 10).cast("string"))
    return code


def tile_x(lon: Column, zoom: int) -> Column:
    return F.floor((lon + 180) / 360 * 2**zoom)


def tile_y(lat: Column, zoom: int) -> Column:
    r = F.radians(lat)
    return F.floor((1 - F.ln(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * 2**zoom)


def tile_f(height: Column, zoom: int) -> Column:
    return F.floor(height * 2**zoom / 2**HEIGHT_EXPONENT)


def tile_lon(x: Column, zoom: Column | int) -> Column:
    return x / _tiles(zoom) * 360 - 180


def tile_lat(y: Column, zoom: Column | int) -> Column:
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y / _tiles(zoom)))))


def tile_height(f: Column, zoom: Column | int) -> Column:
    return f * 2.0**HEIGHT_EXPONENT / _tiles(zoom)


def _tiles(zoom: Column | int) -> Column:
    return F.lit(float(2**zoom)) if isinstance(zoom, int) else F.pow(F.lit(2.0), zoom)


def voxel_id(lon: Column, lat: Column, height: Column, zoom: int) -> Column:
    """z/f/x/y."""
    return F.concat_ws("/", F.lit(zoom), tile_f(height, zoom), tile_x(lon, zoom), tile_y(lat, zoom))


def change_zoom(index: Column, zoom: int, to: int) -> Column:
    """The index at a coarser zoom."""
    return F.shiftright(index, zoom - to)


def voxel_centres(df: DataFrame, text: str, separator: str = "/") -> DataFrame:
    """Identifiers z/f/x/y as centre points in longitude, latitude and height."""
    part = F.split(F.col(text), separator)
    z, f, x, y = (part[i].cast("double") for i in range(4))
    return df.withColumns({"x": tile_lon(x + 0.5, z), "y": tile_lat(y + 0.5, z), "z": tile_height(f + 0.5, z)})


def ground_resolution(lat: Column, zoom: int) -> Column:
    """Metres a tile's side spans at a latitude."""
    return F.cos(F.radians(lat)) * 2 * math.pi * 6378137 / 2**zoom


def split_by_index(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """Chunks of `size` rows in order: column tile."""
    from terravane.plans.numbering import numbered

    return numbered(df, order, "__n").withColumn("tile", F.floor(F.col("__n") / size)).drop("__n")


def missing_tiles(tiles: DataFrame) -> DataFrame:
    """For lists of tiles (list_name, tile): a row dwh, type, value for every tile of any list that a list lacks."""
    lists = tiles.select("list_name").distinct()
    every = tiles.select("tile").distinct()
    gaps = every.crossJoin(F.broadcast(lists)).join(tiles.select("list_name", "tile"), ["list_name", "tile"], "left_anti")  # a handful of lists, each with every tile: the result itself
    return gaps.select(F.concat_ws("_", "list_name", "tile").alias("dwh"), F.lit("").alias("type"), F.lit("").alias("value"))


def clip_ranges(text: str) -> list[dict]:
    """Lines of four numbers as clip areas."""
    out = []
    for line in text.splitlines():
        if line.strip():
            a, b, c, d = (float(v) for v in line.replace(",", " ").split())
            out.append({"x_min": a, "y_min": b, "x_max": c, "y_max": d})
    return out


def corner_range(bounds: DataFrame, corner: str, x_ratio: float, y_ratio: float) -> DataFrame:
    """The part of each box that is x_ratio wide and y_ratio high, at one of its corners."""
    w, h = (F.col("x_max") - F.col("x_min")) * x_ratio, (F.col("y_max") - F.col("y_min")) * y_ratio
    v, side = corner.split("-")
    x0 = F.col("x_min") if side == "left" else F.col("x_max") - w
    y0 = F.col("y_min") if v == "bottom" else F.col("y_max") - h
    return bounds.withColumn("__b", F.struct(x0.alias("x_min"), y0.alias("y_min"), (x0 + w).alias("x_max"), (y0 + h).alias("y_max"))).select(*[c for c in bounds.columns if c not in ("x_min", "y_min", "x_max", "y_max")], "__b.*")
