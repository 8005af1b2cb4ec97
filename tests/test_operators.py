"""Map-feature operators on hand-made cases and invariants; the registered queries are held against SQL by the driver."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.functions import crs, geometry as g, pixels as px
from terravane.operators import aggregates, export, fields, images, joins, network, solids, spatial, tiles, validate, vertices
from terravane.plans import fixtures
from terravane.plans.flow import Flow, operators, template
from terravane.plans.numbering import numbered
from terravane.sources import readers

V = "findex long, seq int, x double, y double, z double"


def line(spark, *rows):
    return spark.createDataFrame([(int(f), i, float(x), float(y), float(z)) for f, i, x, y, z in rows], V)


@pytest.fixture(scope="module")
def bend(spark):
    return line(spark, (1, 0, 0, 0, 0), (1, 1, 3, 4, 0), (1, 2, 3, 4, 12), (2, 0, 5, 5, 1), (2, 1, 5, 5, 3))


def square(x0, y0, x1, y1):
    return np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], float)


def shape(spark, *rings, kind="Polygon"):
    return spark.createDataFrame([(i, kind, [(float(p[0]), float(p[1]), 0.0) for p in r]) for i, r in enumerate(rings)], "findex long, gtype string, coords array<struct<x:double,y:double,z:double>>")


def test_measures(spark, bend):
    assert {r.findex: r.length for r in aggregates.length(bend).collect()} == {1: 17.0, 2: 2.0}
    assert {r.findex: r.gradient for r in aggregates.gradient(bend).collect()} == {1: 24.0, 2: None}
    z = vertices.estimate_z(line(spark, (1, 0, 0, 0, 0), (1, 1, 2, 0, 9), (1, 2, 10, 0, 10))).orderBy("seq").collect()
    assert [r.z for r in z] == [0.0, 2.0, 10.0]
    d = vertices.densify(line(spark, (1, 0, 0, 0, 0), (1, 1, 10, 0, 4)), 3.0).orderBy("seq").collect()
    assert [(r.x, r.z) for r in d] == [(0, 0), (2.5, 1), (5, 2), (7.5, 3), (10, 4)]


def test_field_rules(spark):
    df = spark.createDataFrame([(1, "ab", 0.0, 2.5), (2, None, 4.0, 3.5), (3, "　", float("nan"), None)], "findex long, s string, a double, b double")
    assert [r.s for r in fields.replace_values(df, "s", [("a", "x"), ("ab", "y"), (None, "none")]).orderBy("findex").collect()] == ["y", "none", "　"]
    assert [r.o for r in fields.round_field(df, "b", 0, "o").orderBy("findex").collect()] == [2.0, 4.0, None]
    over = fields.calculate_fields(df, "b", "a", "/", "o").orderBy("findex").collect()
    assert over[0].o == float("inf") and over[1].o == 0.875 and over[2].o is None
    assert [r.s for r in fields.fill_missing(df, "s", "d").orderBy("findex").collect()] == ["ab", "d", "d"]
    with pytest.raises(Exception, match="more parts"):
        fields.split_fields(df.withColumn("s", F.lit("a-b-c")), "s", "-", [("p", 3), ("q", 3)]).collect()
    assert [r.ok for r in fields.split_fields(df.limit(1).withColumn("s", F.lit("1, TRUE ")), "s", ",", [("n", 1), ("ok", 4)]).collect()] == [True]


def test_islands_and_joins(spark):
    df = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate(zip("11010", "abcde", strict=True))], "n int, flag string, t string")
    assert sorted(r.t for r in aggregates.recreate_records(df, "flag", "1", "n", "t").collect()) == ["abc", "de"]
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "findex long, k string"), spark.createDataFrame([(0, "y"), (0, "z")], "findex long, k string")
    with pytest.raises(Exception, match="no partner: z"):
        joins.synchronize_findex(a, b, "k").collect()
    with pytest.raises(ValueError):
        joins.join_tables(a, b, "k", "k", ["findex"])


def test_overlay_areas():
    a, b = [[square(0, 0, 2, 2)]], [[square(1, 0, 3, 2)]]
    for how, want in (("union", 6), ("intersection", 2), ("difference", 2)):
        assert abs(g.rings_area(g.overlay(a, b, how)) - want) < 1e-9
    hole = g.as_polygons(g.overlay(a, [[square(0.5, 0.5, 1, 1)]], "difference"))
    assert len(hole) == 1 and len(hole[0]) == 2 and abs(g.polygon_area(hole[0]) - 3.75) < 1e-9
    assert not g.is_simple(np.array([(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)], float)) and g.is_simple(square(0, 0, 1, 1))
    rng = np.random.default_rng(0)
    p = rng.uniform(0, 1, (40, 2))
    assert all(g.area(p[list(t)]) > 0 for t in g.delaunay(p))


@pytest.mark.parametrize(("how", "want"), [("intersects", {0, 1, 2, 3}), ("touches", {1}), ("overlaps", {0}), ("contains", {2}), ("covers", {2, 3}), ("within", set()), ("equals", {3})])
def test_predicates(spark, how, want):
    main = shape(spark, square(0, 0, 4, 4))
    sub = shape(spark, square(3, 3, 6, 6), square(4, 0, 6, 4), square(1, 1, 2, 2), square(0, 0, 4, 4), square(9, 9, 10, 10))
    want = want | {3} if how in ("contains", "within", "covers") else want
    assert {r.r for r in spatial.predicate_pairs(main, sub, how, 2.0).collect()} == want


def test_overlay_pairs_and_cascade(spark):
    a, b = shape(spark, square(0, 0, 2, 2)), shape(spark, square(1, 0, 3, 2), square(3, 0, 4, 1), square(8, 8, 9, 9))
    pairs = spark.createDataFrame([(0, 0)], "l long, r long")
    for how, want in (("union", 6), ("intersection", 2), ("difference", 2), ("symmetric_difference", 2)):
        assert abs(spatial.overlay_pairs(a, b, pairs, how).agg(F.sum("area")).first()[0] - want) < 1e-6
    assert {(r.r, r.step) for r in spatial.cascade_touches(a, b, 2.0).collect()} == {(0, 1), (1, 2)}
    assert spatial.most_intersecting(a, b, 2.0).first().r == 0
    t = np.linspace(0, 2 * np.pi, 60)
    ring = np.c_[np.cos(t), np.sin(t)]
    ring[-1] = ring[0]
    assert [r.is_circle for r in spatial.circle_shapes(shape(spark, ring, square(0, 0, 1, 1)), 0.05).orderBy("findex").collect()] == [True, False]


def test_crs_round_trip_and_sheets(spark):
    lon, lat = np.array([139.7, 130.2, 141.4]), np.array([35.6, 33.5, 43.1])
    for zone, i in ((9, 0), (2, 1), (12, 2)):
        x, y = crs.to_plane(lon[i : i + 1], lat[i : i + 1], zone)
        a, b = crs.from_plane(x, y, zone)
        assert abs(a[0] - lon[i]) < 1e-9 and abs(b[0] - lat[i]) < 1e-9
    x, y = crs.convert(np.array([139 + 5 / 6]), np.array([36.0]), 6668, 6677)
    assert abs(x[0]) < 1e-6 and abs(y[0]) < 1e-6
    pts = spark.createDataFrame([(0.5, -0.5), (-39999.0, 29999.0), (1234.5, -14321.0)], "x double, y double")
    for level in (50000, 5000, 2500, 500):
        r = pts.withColumn("c", tiles.sheet_code(F.col("x"), F.col("y"), "09", level)).withColumn("b", tiles.sheet_bounds(F.col("c")))
        assert r.where("x < b.x_min or x >= b.x_max or y <= b.y_min or y > b.y_max").count() == 0
    assert pts.select(tiles.sheet_code(F.col("x"), F.col("y"), "09", 50000).alias("c")).first().c == "09KE"


def test_voxels_round_trip(spark):
    df = spark.createDataFrame([(139.7, 35.6, 12.0), (130.0, 33.0, -5.0)], "x double, y double, h double")
    back = tiles.voxel_centres(df.withColumn("id", tiles.voxel_id(F.col("x"), F.col("y"), F.col("h"), 25)).withColumnRenamed("x", "lon").withColumnRenamed("y", "lat"), "id")
    assert back.where("abs(x - lon) > 1e-5 or abs(y - lat) > 1e-5 or abs(z - h) > 1").count() == 0
    v = line(spark, (1, 0, 0, 0, 0), (1, 1, 10, 0, 0))
    n = export.line_voxels(v, spark.createDataFrame([(1, 1.0, 1.0)], "findex long, width double, height double"), 23, 6677).count()
    assert 4 <= n <= 40


def test_solids(spark):
    v = line(spark, (1, 0, 0, 0, 0), (1, 1, 10, 0, 0))
    size = spark.createDataFrame([(1, 2.0, 3.0, 1.0)], "findex long, width double, depth double, radius double")
    assert abs(abs(solids.volume(solids.box_solids(v, size.select("findex", "width", "depth"))).first().volume) - 60) < 1e-9
    assert abs(abs(solids.volume(solids.cylinder_solids(v, size.select("findex", "radius"), 64)).first().volume) - 10 * np.pi) < 0.1
    tri = solids.box_solids(v, size.select("findex", "width", "depth"))
    assert validate.table_errors(tri, "multipatch_closed").count() == 0
    doc = json.loads(export.gltf(tri, size.select("findex", "width")).first().text)
    assert doc["accessors"][0]["count"] == tri.where("k < 3").count()
    city = export.city_models(tri, size.select("findex", "width"), spark.createDataFrame([(1, "09LD")], "findex long, sheet string"), "frn:CityFurniture", "EPSG:6697").first()
    assert city.text.count("<gml:Polygon>") == tri.where("k = 0").count()
    assert "upperCorner" in aggregates.update_envelopes(spark.createDataFrame([(city.text,)], "text string")).first().text
    bottom = solids.bottom_polygons(v, size.select("findex", "width"))
    assert abs(vertices.ring_area(bottom).first().area) == 40
    sheet = solids.affine_sheet(v, spark.createDataFrame([(-20.0, -20.0, 0.0, -19.0, -20.0, 1.0), (30.0, -20.0, 0.0, 31.0, -20.0, 1.0), (0.0, 40.0, 0.0, 1.0, 40.0, 1.0)], "x double, y double, z double, tx double, ty double, tz double"), True)
    assert [(round(r.x, 9), round(r.z, 9)) for r in sheet.orderBy("seq").collect()] == [(1, 1), (11, 1)]


def grouped(df):
    """Whether a Python call is made for each key of df's plan."""
    return "FlatMapGroupsIn" in df._jdf.queryExecution().analyzed().toString()


def odd_lines(spark):
    """Lines of 1 to 6 vertices, some repeated, upright or without z, rows in any order."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        p = rng.integers(0, 4, (rng.integers(1, 7), 3)).astype(float)
        p[:, :2] *= i % 7 > 0
        rows += [(i, k, *q) for k, q in enumerate(p.tolist())]
    rng.shuffle(rows)
    return line(spark, *rows)


def test_cylinder_solids_of_many_lines(spark):
    v = odd_lines(spark)
    tri = solids.cylinder_solids(v, v.select("findex").distinct().withColumn("radius", F.col("findex") % 5 / 4), 8)
    assert not grouped(tri)
    rows = tri.toPandas().sort_values(["findex", "patch", "k"]).groupby("findex")
    points = v.toPandas().sort_values(["findex", "seq"]).groupby("findex")[["x", "y", "z"]]
    t = np.arange(8) * 2 * np.pi / 8
    for k, p in points:
        p = p.to_numpy()
        _, patch, corner = solids.sweep(np.array([len(p)]), p, (k % 5 / 4 * np.c_[np.cos(t), np.sin(t)])[None], True, True)
        segments = int((np.abs(np.diff(p, axis=0)).max(1, initial=0) > 0).sum())
        assert len(patch) == (16 * segments + 2 * (6 if k % 5 else 1) if segments else 0)
        found = rows.get_group(k) if k in rows.groups else tri.limit(0).toPandas()
        assert found["patch"].tolist() == np.repeat(patch, 4).tolist() and found["k"].tolist() == [0, 1, 2, 3] * len(patch)
        want = np.array(corner)[[0, 1, 2, 0]].transpose(2, 0, 1).reshape(-1, 3)
        assert np.allclose(found[["x", "y", "z"]].to_numpy(float).reshape(-1, 3), want, atol=1e-12)


def test_box_solids_of_many_lines(spark):
    v = odd_lines(spark)
    size = v.select("findex").distinct().withColumns({"width": F.col("findex") % 3 + 0.5, "depth": F.col("findex") % 4 + 0.25})
    tri = solids.box_solids(v, size)
    assert not grouped(tri)
    straight = v.groupBy("findex").agg(F.max_by(F.struct("x", "y", "z"), "seq").alias("q"), F.min_by(F.struct("x", "y", "z"), "seq").alias("p"), F.count("*").alias("n")).where("n = 2 and (p.x <> q.x or p.y <> q.y or p.z <> q.z)")
    far = F.sqrt(sum(F.pow(F.col(f"p.{c}") - F.col(f"q.{c}"), 2) for c in "xyz"))
    found = straight.join(size, "findex").withColumn("want", far * F.col("width") * F.col("depth")).join(solids.volume(tri), "findex").collect()
    assert len(found) == straight.count() > 20
    assert all(abs(abs(r.volume) - r.want) < 1e-9 for r in found)
    open_ended = solids.box_solids(v, size, start=False, end=True)
    assert tri.count() - open_ended.count() == 8 * tri.select("findex").distinct().count()


def test_box_solids_by_pieces(spark):
    """Lines longer than a piece, sizes of any kind and unknown places: the rows are sweep's. Lines that were dealt by findex are not dealt again."""
    rng = np.random.default_rng(4)
    rows = [(i, k, *q) for i, n in enumerate((2, 512, 513, 514, 1026, 3, 3, 4, 2)) for k, q in enumerate(rng.normal(size=(n, 3)).tolist())]
    rows = [(i, k, None if (i, k) in ((5, 1), (7, 0)) else x, y, z) for i, k, x, y, z in rows]
    rng.shuffle(rows)
    v = spark.createDataFrame([(int(i), int(k), x, y, z) for i, k, x, y, z in rows], "findex long, seq int, x double, y double, z double")
    wide = {i: (0.5 + i, 2.0) for i in range(6)} | {6: (-1.0, 2.0), 7: (1.0, 0.0), 8: (None, 1.0)}
    size = spark.createDataFrame([(i, *w) for i, w in wide.items()], "findex long, width double, depth double")
    for start, end in ((True, True), (False, True), (True, False)):
        found = dict(list(solids.box_solids(v, size, start, end).toPandas().sort_values(["findex", "patch", "k"]).groupby("findex")))
        for i, p in v.toPandas().sort_values(["findex", "seq"]).groupby("findex")[["x", "y", "z"]]:
            section = np.array(wide[i], float) / 2 * np.array([(-1, -1), (1, -1), (1, 1), (-1, 1)])
            p = p.to_numpy(float)
            with np.errstate(all="ignore"):
                _, patch, corner = solids.sweep(np.array([len(p)]), p, section[None], start, end)
            want = np.array(corner)[[0, 1, 2, 0]].transpose(2, 0, 1).reshape(-1, 3)
            if not len(patch):
                assert i not in found
                continue
            assert found[i]["patch"].tolist() == np.repeat(patch, 4).tolist() and found[i]["k"].tolist() == [0, 1, 2, 3] * len(patch)
            assert np.array_equal(found[i][["x", "y", "z"]].to_numpy(float), want, equal_nan=True)
    lines = fixtures.short_lines(spark, "/root/testdata/sf0.001")
    plan = solids.box_solids(lines, lines.select("findex").distinct().withColumns({"width": F.lit(0.4), "depth": F.lit(0.2)}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # of vertices and of sizes


def test_solids_as_files(spark, tmp_path):
    """Files of solids hold what repeats in few bytes (cylinders, one triangle after the other, take 17.6 a row); each triangle has its own normal, and a cap one alone."""
    rng = np.random.default_rng(5)
    count = [*rng.integers(2, 8, 400).tolist(), 1100]
    v = line(spark, *[(i, k, *q) for i, n in enumerate(count) for k, q in enumerate((rng.random((n, 3)) * 100).tolist())])
    size = v.select("findex").distinct().withColumns({"radius": F.lit(0.2), "width": F.lit(0.4), "depth": F.lit(0.2)})
    for name, tri, m, most in (("cylinder", solids.cylinder_solids(v, size.select("findex", "radius"), 8), 8, 12.5), ("box", solids.box_solids(v, size.select("findex", "width", "depth")), 4, 14.5)):
        tri.write.options(**{"compression": "snappy", "parquet.enable.dictionary": "false"}).parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name)).toPandas()
        assert len(rows) == 4 * sum((n - 1) * 2 * m + 2 * (m - 2) for n in count)
        assert sum(f.stat().st_size for f in (tmp_path / name).glob("*.parquet")) / len(rows) < most
        rows = rows.sort_values(["findex", "patch", "k"])
        p, normal = (rows[c].to_numpy().reshape(-1, 4, 3) for c in (["x", "y", "z"], ["nx", "ny", "nz"]))
        want = np.cross(p[:, 1] - p[:, 0], p[:, 2] - p[:, 0])
        assert np.allclose(normal, (want / np.linalg.norm(want, axis=1)[:, None])[:, None], rtol=0, atol=1e-9)
        caps = rows[rows["patch"] >= (rows["findex"].astype(int).map(dict(enumerate(count))) - 1) * 2 * m]
        assert len(caps[["findex", "nx", "ny", "nz"]].drop_duplicates()) == 2 * len(count)


def test_bottom_polygons_of_many_lines(spark):
    v = line(spark, (1, 1, 0, 0, 1), (1, 2, 4, 0, 2), (1, 3, 4, 0, 3), (1, 4, 4, 4, 4), (2, 0, 0, 0, 0), (3, 0, 1, 1, 0), (3, 1, 1, 1, 5), (4, 0, 0, 0, 0), (4, 1, 2, 0, 1), (4, 2, 5, 0, 2))
    sized = lambda v: v.select("findex").distinct().withColumn("width", F.lit(1.0))
    found = solids.bottom_polygons(v, sized(v))
    assert not grouped(found)
    rings = {k: f.sort_values("seq")[["x", "y", "z"]].to_numpy().tolist() for k, f in found.toPandas().groupby("findex")}
    assert rings == {
        1.0: [[0, -1, 1], [5, -1, 2], [5, 4, 4], [3, 4, 4], [3, 1, 2], [0, 1, 1], [0, -1, 1]],
        4.0: [[0, -1, 0], [5, -1, 2], [5, 1, 2], [0, 1, 0], [0, -1, 0]],
    }
    many = odd_lines(spark)
    flat = lambda v: sorted(map(tuple, solids.bottom_polygons(v, sized(v), True).collect()))
    assert flat(many) == sorted(r for k in range(3) for r in flat(many.where(F.col("findex") % 3 == k)))


def test_distance_pairs_of_points_and_others(spark):
    rng = np.random.default_rng(5)
    p = rng.integers(0, 40, (200, 2)) / 2
    rows = [(i, "Point", [(x, y, 0.0)]) for i, (x, y) in enumerate(p.tolist())] + [(200, "LineString", [(0.0, 0.0, 0.0), (20.0, 20.0, 0.0)]), (201, "MultiPoint", [(1.0, 1.0, 0.0), (9.0, 9.0, 0.0)])]
    shapes = spark.createDataFrame(rows, f"findex long, gtype string, coords {spatial.COORDS}")
    assert "MapInPandas" not in spatial.point_pairs(shapes, shapes, 2.5, 4.0)._jdf.queryExecution().analyzed().toString()
    kind = {"Point": 0, "MultiPoint": 0, "LineString": 1}
    parts = [(kind[k], [np.array(c)[:, :2]]) for _, k, c in rows]
    want = {(i, j): d for i, a in enumerate(parts) for j, b in enumerate(parts) if (d := spatial.distance(a, b)) <= 2.5}
    found = spatial.distance_pairs(shapes, shapes, 2.5, 4.0).collect()
    assert len(found) == len(want) and all(abs(want[r.l, r.r] - r.distance) < 1e-12 for r in found)


def test_integrate_lines_leaves_lone_lines_to_catalyst(spark):
    v = line(spark, (1, 3, 0, 0, 1), (1, 5, 1, 0, 2), (1, 9, 2, 5, 3), (2, 0, 7, 7, 0), (2, 1, 8, 7, 1), (2, 2, 7, 7, 2), (3, 0, 20, 0, 0), (3, 1, 21, 0, 1), (4, 0, 22, 0, 2), (4, 1, 21, 0, 3), (5, 0, 30, 30, 0))
    found = network.integrate_lines(v)
    assert found.dtypes == [("root", "double"), ("seq", "int"), ("x", "double"), ("y", "double"), ("z", "double")]
    # lines 3 and 4 alone share an end; a line that is not closed begins with its last vertex
    assert sorted(map(tuple, found.collect())) == [
        (1, 0, 2, 5, 3), (1, 1, 1, 0, 2), (1, 2, 0, 0, 1), (2, 0, 7, 7, 0), (2, 1, 8, 7, 1), (2, 2, 7, 7, 2),
        (3, 0, 20, 0, 0), (3, 1, 21, 0, 1), (3, 2, 22, 0, 2), (5, 0, 30, 30, 0),
    ]
    assert "Union" in found._jdf.queryExecution().analyzed().toString()


def test_networks(spark):
    v = line(spark, (1, 0, 0, 0, 0), (1, 1, 10, 0, 0), (2, 0, 10, 0, 0), (2, 1, 20, 0, 0), (3, 0, 5, -5, 0), (3, 1, 5, 5, 0))
    assert {(r.l, r.r, r.x) for r in network.segment_crossings(v, 4.0).collect()} == {(1, 3, 5.0)}
    merged = network.integrate_lines(v).groupBy("root").agg(F.max("x").alias("x"), F.count("*").alias("n")).collect()
    assert {(r.root, r.x, r.n) for r in merged} == {(1.0, 20.0, 3), (3.0, 5.0, 2)}
    assert network.split_at_crossings(v, 4.0).select("findex").distinct().count() == 5
    grid = line(spark, *[(i, k, *p, 0) for i, q in enumerate((((0, 0), (2, 0)), ((0, 1), (2, 1)), ((0, 0), (0, 1)), ((1, -1), (1, 1)), ((2, 0), (2, 1)))) for k, p in enumerate(q)]).withColumn("grp", F.lit(1))
    faces = solids.polygonize(grid).groupBy("findex").agg(F.first("area").alias("a")).collect()
    assert sorted(round(f.a, 6) for f in faces) == [1, 1]
    pieces, pairs = network.divide_pipes(line(spark, (7, 0, 0, 0, 0), (7, 1, 4, 0, 0), (7, 2, 10, 0, 0)), spark.createDataFrame([(1, 2.0, 1.0), (2, 8.0, 1.0)], "findex long, x double, y double"), spark.createDataFrame([(7, 1), (7, 2)], "l long, r long"))
    assert {(r.findex, r.seq, r.x) for r in pieces.collect()} == {("7-0", 0, 0.0), ("7-0", 1, 4.0), ("7-0", 2, 5.0), ("7-1", 0, 5.0), ("7-1", 1, 10.0)}
    assert {(r.l, r.r) for r in pairs.collect()} == {("7-0", 1), ("7-1", 2)}


def test_pixels(spark):
    rng = np.random.default_rng(1)
    rgb = rng.integers(0, 256, (16, 20, 3)).astype(np.uint8)
    assert (px.from_png(px.to_png(rgb)) == rgb).all() and abs(px.hsv_to_rgb(px.rgb_to_hsv(rgb)).astype(int) - rgb).mean() < 3 and abs(px.hls_to_rgb(px.rgb_to_hls(rgb)).astype(int) - rgb).mean() < 4
    mask = np.zeros((16, 20), np.uint8)
    mask[2:6, 3:9] = 255
    mask[10:14, 12:13] = 255
    assert px.regions(mask, 1) == [(3, 2, 6, 4, 24), (12, 10, 1, 4, 4)] and px.label(mask > 0)[1] == 2
    assert abs(g.area(px.contours(mask, 5)[0])) == 15 and len(px.rectangles(mask, 5)) == 1
    assert (px.morphology(mask, "MORPH_OPEN") > 0).sum() == 24
    assert sorted(px.hough_lines(mask * (np.arange(20) == 12), 4, 2, 1)[0][1::2]) == [10, 13]
    img = spark.createDataFrame([images.row_of("a", 0.0, "RGB", rgb)], images.SCHEMA)
    tiles_ = images.split(img, 3, 2, 4)
    assert tiles_.count() == 6 and bytes(images.merge(tiles_).first().content) == rgb.tobytes()
    assert bytes(images.to_grey(img).first().content) == px.to_grey(rgb).tobytes()
    assert images.regions(images.to_binary(img, 255), 1).count() == 0
    for f in (lambda: images.adjust_contrast(img, "CLAHE"), lambda: images.smooth(img, 3, 1.0), lambda: images.sharpen(img), lambda: images.edges(img, "Sobel"), lambda: images.reshape(img, "Rotation", 90.0)):
        assert f().first().h == 16
    square_ = np.zeros((9, 9), np.uint8)
    square_[4, 4] = 200
    assert px.warp(square_, px.rotation(90, 1, 4, 4), (9, 9))[4, 4] == 200


def test_sources(spark, tmp_path):
    features = spark.createDataFrame([("p", 0.0, "Polygon", [[(0.0, 0.0, 1.0), (1.0, 0.0, 1.0), (1.0, 1.0, 1.0), (0.0, 0.0, 1.0)]], {"name": "日本"}), ("p", 1.0, "Polygon", [[(5.0, 5.0, 2.0), (6.0, 5.0, 2.0), (6.0, 6.0, 2.0), (5.0, 5.0, 2.0)]], {"name": None})], readers.FEATURE)
    zipped = readers.to_shapefiles(features, ["path"])
    back = readers.read_shapefiles(zipped).orderBy("findex").collect()
    assert [(r.gtype, r.parts[0][1].x, r.parts[0][1].z, r.attributes["name"]) for r in back] == [("Polygon", 1.0, 1.0, "日本"), ("Polygon", 6.0, 2.0, None)]
    text = '{"type":"FeatureCollection","features":[' + ",".join(r.value for r in readers.to_geojson(features).collect()) + ',{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"a":"b"}}]}'
    (tmp_path / "f.geojson").write_text(text)
    got = readers.read_geojson(spark, f"file://{tmp_path}/f.geojson").orderBy("findex").collect()
    assert [r.gtype for r in got] == ["Polygon", "Polygon", "Point"] and got[2].parts[0][0].y == 2.0 and got[0].attributes["name"] == "日本"
    dxf = "0\nSECTION\n2\nENTITIES\n0\nLINE\n8\nL1\n10\n0\n20\n0\n11\n3\n21\n4\n0\nCIRCLE\n8\nL2\n10\n1\n20\n1\n40\n2\n0\nENDSEC\n0\nEOF\n"
    shapes = readers.read_dxf(spark.createDataFrame([("d", dxf.encode())], "path string, content binary"), scale=2.0).orderBy("findex").collect()
    assert [(s.gtype, s.attributes["layer"], len(s.parts[0])) for s in shapes] == [("LineString", "L1", 2), ("Polygon", "L2", 101)] and shapes[0].parts[0][1].y == 8.0
    rows = spark.createDataFrame([(1, bytearray(b"0012ab \x0034cd"))], "k int, c binary")
    assert [tuple(r) for r in readers.fixed_width(rows, "c", [("n", 1, 4), ("s", 3, 2)]).orderBy("record").collect()] == [(1, 0, 12, "ab"), (1, 1, 34, "cd")]
    assert spark.createDataFrame([("ff",)], "t string").select(readers.digits_to_number(F.col("t"), 16, 2, True).alias("v")).first().v == -1
    walk = readers.split_digits(spark.createDataFrame([("k", "02aabb01cc")], "k string, t string"), "k", "t", 16, [("n", 1)], 0, [("b", 1)], [])
    assert [(r.n, r.body) for r in walk.orderBy("record").collect()] == [("02", "aabb"), ("01", "cc")]


def test_validators_and_flow(spark):
    assert len(validate.VALIDATORS) == 71
    df = spark.createDataFrame([(1, "a/b", "x"), (1, "ab", None)], "findex long, dwh string, v string")
    errors = validate.validate(df, [("fsf_format", "dwh"), ("field_null", "v"), ("duplicates_fid_data", "findex"), ("no_nan", "gone")])
    assert sorted(r.message for r in errors.collect()) == ["duplicates_fid_data", "exist_attribute", "field_null", "fsf_format"]
    assert validate.validate(df, [("fsf_format", "dwh"), ("field_null", "v")], stop=True).first().message == "fsf_format"
    for checks in validate.VALIDATORS.values():
        assert all(c in validate.ROW_RULES or c in validate.TABLE_RULES for c in checks)
    assert template("${filename:substringBefore('.'):append('.xml')} #{p}", {"filename": "a.b", "p": "q"}) == "a.xml q"
    out = Flow({"to": "w"}).add("add_constant_field", name="${to}", value="1").add("convert_type", column="w", kind="int").run(df)
    assert out.select("w").first().w == 1 and len(operators()) > 150


def test_numbering(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 as a")
    got = numbered(df, ["a"], "n", rows=100).collect()
    assert all(r.a == r.n for r in got) and len(got) == 1000


def test_vertical_lines_and_missing_tiles(spark):
    v = line(spark, (1, 0, 0, 0, 0), (1, 1, 5, 0, 1), (2, 0, 5, 0, 4), (2, 1, 9, 0, 4))
    lines, pairs = vertices.add_vertical_lines(v)
    assert sorted((r.findex, r.z) for r in lines.collect()) == [(3, 1.0), (3, 4.0)] and pairs.first().r == 1
    t = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "list_name string, tile int")
    assert [r.dwh for r in tiles.missing_tiles(t).collect()] == ["b_1"]


def test_defragment_stream(spark, tmp_path):
    from terravane.streaming.defragment import defragment

    rows = [("m", 1, 2, "2024-01-01 00:00:00", "b"), ("m", 0, 2, "2024-01-01 00:00:01", "a"), ("n", 0, 2, "2024-01-01 00:00:01", "x")]
    df = spark.createDataFrame(rows, "identifier string, number int, count int, ts string, content string").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    q = defragment(stream).writeStream.format("memory").queryName("whole").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.identifier, r.content) for r in spark.table("whole").where("complete").collect()] == [("m", "ab")]




def test_key_points_have_no_cap(spark):
    """900 squares have four corners each; a cap is taken only where it is asked for."""
    img = np.zeros((370, 370), np.uint8)
    for y in range(30):
        for x in range(30):
            img[12 * y + 6 : 12 * y + 12, 12 * x + 6 : 12 * x + 12] = 255
    rows = spark.createDataFrame([images.row_of("a", 0.0, "GRAYSCALE", img)], images.SCHEMA)
    got = [(r.px, r.py) for r in images.key_points(rows).orderBy("n").collect()]
    assert len(got) >= 3600 and {(round((x - 6) / 12), round((y - 6) / 12)) for x, y in got} >= {(x, y) for x in range(30) for y in range(30)}
    assert all(np.hypot(np.array(got)[:, 0] - x, np.array(got)[:, 1] - y)[np.arange(len(got)) != i].min() >= 3 for i, (x, y) in enumerate(got))
    assert [(r.px, r.py) for r in images.key_points(rows, 500).orderBy("n").collect()] == got[:500]


def _cells(boxes, holes):
    """Unit cells of boxes less holes, each (x0, y0, x1, y1)."""
    inside = lambda x, y, bs: any(x0 <= x < x1 and y0 <= y < y1 for x0, y0, x1, y1 in bs)
    return {(x, y) for x in range(20) for y in range(20) if inside(x, y, boxes) and not inside(x, y, holes)}


def test_predicates_and_overlays_with_holes_and_parts(spark):
    """Against sets of unit cells: shapes of several boxes and holes, a hole filled exactly, points and lines in holes."""
    ring = lambda b: [(b[0], b[1]), (b[2], b[1]), (b[2], b[3]), (b[0], b[3]), (b[0], b[1])]
    shapes = {
        0: ([(0, 0, 10, 10)], [(3, 3, 7, 7)]), 1: ([(3, 3, 7, 7)], []), 2: ([(4, 4, 6, 6)], []), 3: ([(2, 2, 8, 8)], []), 4: ([(0, 0, 2, 2), (12, 12, 15, 15)], []),
        5: ([(12, 12, 15, 15)], [(13, 13, 14, 14)]), 6: ([(10, 0, 12, 4)], []), 7: ([(0, 0, 10, 10), (4, 4, 6, 6)], [(3, 3, 7, 7)]), 8: ([(8, 1, 9, 9), (1, 8, 2, 9)], []), 9: ([(0, 0, 10, 10)], [(3, 3, 7, 7)]),
    }
    cells = {k: _cells(b, h) for k, (b, h) in shapes.items()}
    cells[7] |= _cells([(4, 4, 6, 6)], [])  # an island in the hole
    xyz = lambda r: [(float(x), float(y), 0.0) for x, y in r]
    rows = [(k, "MultiPolygon" if len(b) > 1 else "Polygon", xyz(ring(b[0])), [xyz(ring(x)) for x in [*b, *h]]) for k, (b, h) in shapes.items()]
    schema = f"findex int, gtype string, coords {spatial.COORDS}, rings array<{spatial.COORDS}>"
    df = spark.createDataFrame(rows, schema)
    closed = {k: {(2 * x + i, 2 * y + j) for x, y in c for i in range(3) for j in range(3)} for k, c in cells.items()}
    meets = {"intersects": lambda a, b: bool(closed[a] & closed[b]), "within": lambda a, b: cells[a] <= cells[b], "contains": lambda a, b: cells[b] <= cells[a], "covers": lambda a, b: cells[b] <= cells[a], "covered_by": lambda a, b: cells[a] <= cells[b], "equals": lambda a, b: cells[a] == cells[b], "touches": lambda a, b: bool(closed[a] & closed[b]) and not cells[a] & cells[b], "overlaps": lambda a, b: bool(cells[a] & cells[b]) and not cells[a] <= cells[b] and not cells[b] <= cells[a], "crosses": lambda a, b: False}
    for how, rule in meets.items():
        got = {(r.l, r.r) for r in spatial.predicate_pairs(df, df, how, 4.0).collect()}
        assert got == {(a, b) for a in cells for b in cells if rule(a, b)}, how
    pairs = spatial.predicate_pairs(df, df, "intersects", 4.0)
    area = {r.l: r.area for r in spatial.overlay_pairs(df, df, pairs.where("l <> r and r in (2, 3, 5)"), "symmetric_difference").groupBy("l").agg(F.sum("area").alias("area")).collect()}
    for k in area:
        assert abs(area[k] - len(cells[k] - set().union(*(cells[r] for r in (2, 3, 5) if r != k)))) < 1e-6, k
    most = {r.l: r.measure for r in spatial.most_intersecting(df, df, 4.0).collect()}
    assert all(abs(most[k] - len(cells[k])) < 1e-6 for k in cells)
    points = spark.createDataFrame([(0, "Point", [(5.0, 5.0, 0.0)], None), (1, "MultiPoint", [(1.0, 1.0, 0.0)], [[(1.0, 1.0, 0.0)], [(5.0, 5.0, 0.0)]]), (2, "LineString", [(4.0, 5.0, 0.0), (6.0, 5.0, 0.0)], None), (3, "MultiLineString", [(1.0, 1.0, 0.0), (2.0, 1.0, 0.0)], [[(1.0, 1.0, 0.0), (2.0, 1.0, 0.0)], [(4.0, 5.0, 0.0), (6.0, 5.0, 0.0)]])], schema)
    ring_only = df.where("findex = 0")
    assert {r.l for r in spatial.predicate_pairs(points, ring_only, "within", 4.0).collect()} == set()
    assert {r.l for r in spatial.predicate_pairs(points, ring_only, "intersects", 4.0).collect()} == {1, 3}
    assert {r.l for r in spatial.predicate_pairs(points, ring_only, "crosses", 4.0).collect()} == {1, 3}
    assert {r.l for r in spatial.predicate_pairs(points, df.where("findex = 7"), "within", 4.0).collect()} == {0, 1, 2, 3}
    away = {r.l: r.distance for r in spatial.distance_pairs(points, ring_only, 5.0, 4.0).collect()}
    assert away == {0: 2.0, 1: 0.0, 2: 1.0, 3: 0.0}
    with pytest.raises(Exception, match="can't be compared"):
        spatial.predicate_pairs(df.withColumn("gtype", F.lit("GeometryCollection")), df, "intersects", 4.0).collect()


def test_unknown_checks_are_refused():
    with pytest.raises(ValueError, match="no such checks: nothing"):
        validate.rules_for(("empty_data", "nothing"), {})


def test_geojson_keeps_kinds_holes_and_parts(spark, tmp_path):
    ring = lambda x, y, n: [[x, y, 0.0], [x + n, y, 0.0], [x + n, y + n, 0.0], [x, y + n, 0.0], [x, y, 0.0]]
    shapes = [
        ("Point", [1.0, 2.0, 0.0]), ("MultiPoint", [[1.0, 2.0, 0.0], [3.0, 4.0, 0.0]]), ("LineString", ring(0.0, 0.0, 1.0)), ("MultiLineString", [ring(0.0, 0.0, 1.0), ring(5.0, 0.0, 1.0)]),
        ("Polygon", [ring(0.0, 0.0, 9.0), ring(1.0, 1.0, 2.0)]), ("MultiPolygon", [[ring(0.0, 0.0, 9.0), ring(1.0, 1.0, 2.0)], [ring(20.0, 0.0, 1.0)], [ring(30.0, 0.0, 9.0), ring(31.0, 1.0, 1.0), ring(34.0, 1.0, 1.0)]]),
    ]
    features = [{"type": "Feature", "geometry": {"type": k, "coordinates": c}, "properties": {"n": str(i)}} for i, (k, c) in enumerate(shapes)]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    back = [json.loads(r.value) for r in readers.to_geojson(readers.read_geojson(spark, f"file://{tmp_path}/a.geojson").orderBy("findex")).collect()]
    assert [(f["geometry"]["type"], f["geometry"]["coordinates"], f["properties"]) for f in back] == [(k, c, {"n": str(i)}) for i, (k, c) in enumerate(shapes)]


def test_numbers_by_text_in_ranges(spark):
    """Text keys with nulls and ties, in many ranges: the numbers follow the order, and no range holds all rows."""
    rows = [(None if i % 50 == 0 else f"k{i * 7919 % 1000:03d}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, id long").repartition(5)
    got = numbered(df, ["key", "id"], "n", rows=200)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.key, r.id) for r in got.orderBy("n").collect()] == want and [r.n for r in got.select("n").orderBy("n").collect()] == list(range(3000))
