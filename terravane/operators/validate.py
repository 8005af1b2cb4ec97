"""Validation: rules as columns, all rules of a table in one scan, and the 71 rule sets as data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

ERROR = "code string, message string, column_name string, findex double"


def _number(c: str) -> Column:
    return F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")


#: What each row rule calls wrong, of a table's named column.
ROW_RULES: dict[str, tuple[str, Callable[[str], Column]]] = {
    "field_null": ("ED001", lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")),
    "no_nan": ("ED002", lambda c: F.coalesce(F.isnan(_number(c)), F.lit(False))),
    "fields_type_is_num": ("ED003", lambda c: F.col(c).isNotNull() & _number(F.col(c).cast("string")).isNull()),
    "data_types": ("ED004", lambda c: F.col(c).isNull()),
    "geometry_not_null": ("EC010", lambda c: F.col(c).isNull()),
    "coordinates_is_3D": ("ED005", lambda c: F.col(c).isNull() | F.isnan(F.col(c))),
    "wrong_file_extension": ("ER001", lambda c: ~F.lower(F.coalesce(F.col(c), F.lit(""))).rlike(r"\.(jpg|jpeg|png|tiff?|pdf)$")),
    "empty_color_space": ("ER002", lambda c: ~F.coalesce(F.col(c), F.lit("")).isin("BINARY", "GRAYSCALE", "RGB", "HLS", "HSV", "BGR")),
    "fsf_format": ("EC001", lambda c: ~F.coalesce(F.col(c), F.lit("")).rlike("^[^/]+/[^/]+$")),
    "check_epsg": ("EC002", lambda c: ~F.coalesce(F.col(c).cast("string"), F.lit("")).rlike("^(4326|4612|6668|6697|3857|24[45][0-9]|2461|66[67][0-9]|668[0-7])$")),
}
#: Rules about whole tables or keys.
TABLE_RULES = ("empty_data", "exist_attribute", "duplicates_fid_data", "data_uniqueness", "line_coordinates", "point_coordinates", "polygon_closed", "multipatch_closed", "fsf_match_record")
TABLE_CODES = {"empty_data": "EC003", "exist_attribute": "EC004", "duplicates_fid_data": "EC005", "data_uniqueness": "EC006", "line_coordinates": "ED006", "point_coordinates": "ED007", "polygon_closed": "ED008", "multipatch_closed": "ED009", "fsf_match_record": "EC007"}


def row_errors(df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """An error a row and broken rule (rule, column), in one scan."""
    found = []
    for rule, column in rules:
        code, bad = ROW_RULES[rule]
        found.append(F.when(F.coalesce(bad(column), F.lit(True)), F.struct(F.lit(code).alias("code"), F.lit(rule).alias("message"), F.lit(column).alias("column_name"))))
    return df.select("findex", F.explode(F.filter(F.array(*found), lambda e: e.isNotNull())).alias("e")).select("e.code", "e.message", "e.column_name", F.col("findex").cast("double").alias("findex"))


def _one(df: DataFrame, rule: str, column: str = "") -> DataFrame:
    return df.select(F.lit(TABLE_CODES[rule]).alias("code"), F.lit(rule).alias("message"), F.lit(column).alias("column_name"), F.col("findex").cast("double").alias("findex"))


def table_errors(df: DataFrame, rule: str, column: str = "findex") -> DataFrame:
    """Errors of a rule about a whole table."""
    if rule == "empty_data":
        return _one(df.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(None).cast("double").alias("findex")), rule)
    if rule == "exist_attribute":
        missing = F.lit(column not in df.columns)
        return _one(df.sparkSession.range(1).where(missing).select(F.lit(None).cast("double").alias("findex")), rule, column)
    if rule in ("duplicates_fid_data", "data_uniqueness"):
        return _one(df.groupBy(column).agg(F.count("*").alias("n"), F.min("findex").alias("first")).where("n > 1").select(F.col("first").alias("findex")), rule, column)
    if rule == "line_coordinates":
        return _one(df.groupBy("findex").count().where("count < 2"), rule)
    if rule == "point_coordinates":
        return _one(df.groupBy("findex").count().where("count <> 1"), rule)
    if rule == "polygon_closed":
        p = F.struct("x", "y")
        return _one(df.groupBy("findex").agg(F.min_by(p, "seq").alias("a"), F.max_by(p, "seq").alias("b"), F.count("*").alias("n")).where("a <> b or n < 4"), rule)
    if rule == "multipatch_closed":
        p = lambda k: F.max(F.when(F.col("k") == k, F.struct("x", "y", "z")))
        return _one(df.groupBy("findex", "patch").agg(p(0).alias("a"), p(3).alias("d"), F.count("*").alias("n")).where("n <> 4 or a <> d").select("findex").distinct(), rule)
    if rule == "fsf_match_record":
        n = df.groupBy(column).agg(F.count("*").alias("n"))
        w = Window.partitionBy(F.lit(0))
        return _one(n.withColumn("most", F.max("n").over(w)).where("n < most").select(F.lit(None).cast("double").alias("findex")), rule, column)
    raise ValueError(f"no such rule: {rule}")


def control_point_errors(control: DataFrame) -> DataFrame:
    """Triangles of control points (triangle, k, x, y, tx, ty) whose orientation the move turns over."""
    p = lambda k, c: F.max(F.when(F.col("k") == k, F.col(c)))
    t = control.groupBy("triangle").agg(*[p(k, c).alias(f"{c}{k}") for k in range(3) for c in ("x", "y", "tx", "ty")])
    turn = lambda x, y: (F.col(f"{x}1") - F.col(f"{x}0")) * (F.col(f"{y}2") - F.col(f"{y}0")) - (F.col(f"{x}2") - F.col(f"{x}0")) * (F.col(f"{y}1") - F.col(f"{y}0"))
    return t.where(turn("x", "y") * turn("tx", "ty") <= 0).select(F.lit("ED010").alias("code"), F.lit("correct_GCP").alias("message"), F.lit("triangle").alias("column_name"), F.col("triangle").cast("double").alias("findex"))


def validate(df: DataFrame, rules: list[tuple[str, str]], stop: bool = False) -> DataFrame:
    """All errors of the rules (rule, column); with stop, the first alone, by order of rules and then key."""
    rows = [(r, c) for r, c in rules if r in ROW_RULES and c in df.columns]
    missing = [(r, c) for r, c in rules if r in ROW_RULES and c not in df.columns]
    parts = [row_errors(df, rows)] if rows else []
    parts += [table_errors(df, r, c) for r, c in rules if r not in ROW_RULES] + [table_errors(df, "exist_attribute", c) for _, c in missing]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if not stop:
        return out
    order = {r: i for i, (r, _) in enumerate(rules)}
    rank = F.coalesce(*[F.when(F.col("message") == r, F.lit(i)) for r, i in order.items()], F.lit(len(order)))
    return out.orderBy(rank, F.asc_nulls_first("findex")).limit(1)


def rules_for(checks: tuple[str, ...], columns: dict[str, list[str]]) -> list[tuple[str, str]]:
    """Pairs of rule and column for named checks; columns says which columns a check is about, by default findex."""
    unknown = [c for c in checks if c not in ROW_RULES and c not in TABLE_RULES]
    if unknown:
        raise ValueError(f"no such checks: {', '.join(unknown)}")
    return [(c, col) for c in checks for col in columns.get(c, ["findex"])]


#: Groups of checks that many validators share.
_GEO = ("empty_data", "geometry_not_null", "exist_attribute")
_CAD = ("data_uniqueness", "duplicates_fid_data", "empty_data", "exist_attribute", "fsf_format")
_XYZ = ("coordinates_is_3D", "empty_data", "field_null", "fields_type_is_num", "fsf_format", "line_coordinates")
_DEF = ("exist_attribute", "empty_data", "fsf_format")
#: The checks of each validator, by the operator it stands before.
VALIDATORS: dict[str, tuple[str, ...]] = {
    "add_points_to_lines": ("empty_data", "fsf_format", "line_coordinates"),
    "adjust_ends": _CAD,
    "align_grid": _DEF,
    "leader_ranges": (*_CAD, "fsf_match_record"),
    "concatenate_attribute": ("fsf_format",),
    "drape": ("empty_data", "fsf_format"),
    "cylinder_solids": _XYZ,
    "to_shapes": ("coordinates_is_3D", "empty_data", "fsf_format"),
    "box_solids": _XYZ,
    "affine_sheet": ("empty_data", "fsf_format"),
    "affine_sheet_files": ("coordinates_is_3D", "empty_data"),
    "z_by_covering": ("empty_data", "fields_type_is_num", "fsf_format"),
    "table_to_fields": _DEF,
    "tileset": (*_DEF, "check_epsg"),
    "gltf": _DEF,
    "fields_to_features": _DEF,
    "read_dxf": ("empty_data",),
    "fields_to_features_cad": ("geometry_not_null", "fsf_format"),
    "fields_to_vertices": ("geometry_not_null", "fsf_format"),
    "features_to_vertices": _GEO,
    "draw": _GEO,
    "features_to_contents": ("empty_data",),
    "features_to_fields": _DEF,
    "features_to_fields_multi": _GEO,
    "read_geojson": ("check_epsg", "empty_data"),
    "bottom_polygons": ("data_types", *_DEF),
    "city_model_lines": (*_DEF, "line_coordinates"),
    "city_model_lines_plain": (*_DEF, "line_coordinates"),
    "voxel_centres": ("check_epsg", "empty_data"),
    "city_model_multipoints": (*_DEF, "fields_type_is_num", "point_coordinates"),
    "city_model_points": (*_DEF, "point_coordinates"),
    "city_model_points_plain": (*_DEF, "point_coordinates"),
    "read_shapefiles": ("check_epsg", "empty_data"),
    "fields_csv": _DEF,
    "centre_lines": ("data_types", *_CAD),
    "range_polygons": ("data_types", "fsf_format"),
    "polygonize": ("data_types", "empty_data", "fsf_format"),
    "object_csv": _DEF,
    "divide": ("data_types", "data_uniqueness", "duplicates_fid_data", "exist_attribute", "fsf_format"),
    "divide_pipes": _CAD,
    "evaluate_attribute": ("data_types", "fsf_format"),
    "to_shapefiles": _GEO,
    "extract_group": ("empty_data", "fsf_format"),
    "extract_geometry_type": _GEO,
    "extract_layer": _GEO,
    "line_ends": ("fsf_format", "line_coordinates"),
    "cylinder_voxels": (*_CAD, "no_nan"),
    "line_voxels": (*_CAD, "no_nan"),
    "coordinates_of_features": ("empty_data", "geometry_not_null"),
    "group_leader_lines": ("data_types", *_CAD, "fsf_match_record"),
    "integrate_lines": ("data_types", "data_uniqueness", "duplicates_fid_data", "exist_attribute", "fsf_format"),
    "join_by_nearest": ("check_epsg", "empty_data", "fsf_format"),
    "images": ("empty_color_space", "empty_data", "wrong_file_extension"),
    "read_files": ("check_epsg", "empty_data"),
    "remove_where": ("data_types", *_CAD),
    "rotate": _GEO,
    "bounding_box": _GEO,
    "corner_range": ("exist_attribute",),
    "content_as_attribute": ("empty_data",),
    "simplify": ("data_types", "fsf_format", "no_nan"),
    "snap_points": ("empty_data", "fsf_format", "line_coordinates"),
    "spatial_operations": _CAD,
    "subtract_depth": ("coordinates_is_3D", "empty_data", "fields_type_is_num", "fsf_format"),
    "synchronize_findex": ("data_uniqueness", "duplicates_fid_data", "empty_data", "fsf_format"),
    "shift_by_grid": ("coordinates_is_3D", "empty_data", "fsf_format"),
    "to_pixels": _GEO,
    "vertices_to_features": ("data_types", "no_nan"),
    "pixels_to_lines": ("empty_data", "fsf_format", "line_coordinates"),
    "pixels_to_points": ("empty_data", "fsf_format", "point_coordinates"),
    "update_coordinates": ("check_epsg", "empty_data", "fsf_format"),
    "set_spatial_definition": _GEO,
}
