"""Registered queries over the plain tables, each with its SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.operators import aggregates, fields, joins, network, solids, spatial, tiles, validate, vertices
from terravane.plans import fixtures as fx
from terravane.plans.numbering import numbered

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        name = f.__name__.rstrip("_")
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int) -> DataFrame:
    """Doubles to some digits, for comparison across engines."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(df: DataFrame) -> DataFrame:
    return rounded(df, 6)


# fields ------------------------------------------------------------------------------------------------


@query(f"with {fx.FIELDS} select findex, cast('sheet' as varchar) as label from f")
def add_constant_field(s, d):
    return fields.add_constant_field(fx.fields(s, d), "label", "sheet").select("findex", "label")


@query(f"with {fx.FIELDS} select findex, a + b as plus, a - b as minus, a * b as times, case when (b % 7) = 0 then case when a = 0 then 'nan'::double else 'inf'::double end else a / (b % 7) end as over from f")
def calculate_fields(s, d):
    df = fx.fields(s, d).withColumn("m", F.col("b") % 7)
    for op, other, name in (("+", "b", "plus"), ("-", "b", "minus"), ("*", "b", "times"), ("/", "m", "over")):
        df = fields.calculate_fields(df, "a", other, op, name)
    return df.select("findex", "plus", "minus", "times", "over")


@query(f"with {fx.FIELDS} select findex, b * 2.5::double as scaled, a + 10::double as moved from f")
def add_or_multiply(s, d):
    return fields.add_or_multiply(fields.add_or_multiply(fx.fields(s, d), "b", "*", 2.5, "scaled"), "a", "+", 10.0, "moved").select("findex", "scaled", "moved")


@query(f"with {fx.FIELDS} select findex, cast(b as varchar) as text, cast(b as double) as number, cast(trunc(a) as bigint) as whole from f")
def convert_type(s, d):
    df = fields.convert_type(fx.fields(s, d), "b", "str", "text")
    return fields.convert_type(fields.convert_type(df, "b", "float", "number"), "a", "int", "whole").select("findex", "text", "number", "whole")


@query(f"with {fx.FIELDS} select findex, round_even(b / 2.0::double, 0) as half, round_even(a, 1) as tenth from f")
def round_field(s, d):
    df = fx.fields(s, d).withColumn("h", F.col("b") / 2)
    return fields.round_field(fields.round_field(df, "h", 0, "half"), "a", 1, "tenth").select("findex", "half", "tenth")


@query(f"with {fx.DIRTY} select findex, case when v is null or trim(v) = '' or v = 'NaN' then '0' else v end as v, case when num < 10 or num > 90 then -1.0 else num end as num from d")
def fill_missing(s, d):
    df = fields.fill_missing(fx.dirty(s, d), "v", "0", words=True)
    return fields.fill_missing(df, "num", -1.0, low=10, high=90).select("findex", "v", "num")


@query("select event_id as findex, case when event_type = 'view' then 'seen' when event_type = 'click' then 'seen' else event_type end as kind from events")
def replace_values(s, d):
    return fields.replace_values(fx.dirty(s, d), "event_type", [("view", "click"), ("click", "seen"), ("ee", "x")], "kind").select("findex", "kind")


@query(f"with {fx.DIRTY} select findex, 'fixed' as event_type from d")
def overwrite_values(s, d):
    return fields.overwrite_values(fx.dirty(s, d), "event_type", "fixed").select("findex", "event_type")


@query(f"with {fx.DIRTY} select findex, event_type || '-' || coalesce(v, 'None') || '-' || cast(user_id as varchar) as joined from d")
def join_fields(s, d):
    return fields.join_fields(fx.dirty(s, d), ["event_type", "v", "user_id"], "-", "joined").select("findex", "joined")


@query("select o_orderkey as findex, cast(split_part(o_orderpriority, '-', 1) as bigint) as level, split_part(o_orderpriority, '-', 2) as name from orders")
def split_fields(s, d):
    df = fx.table(s, d, "orders").select(F.col("o_orderkey").alias("findex"), "o_orderpriority")
    return fields.split_fields(df, "o_orderpriority", "-", [("level", 1), ("name", 3)]).select("findex", "level", "name")


@query(f"with {fx.FIELDS} select findex, greatest(a / 100, b) as most, least(a / 100, b) as least from f")
def max_min_fields(s, d):
    df = fx.fields(s, d).withColumns({"c": F.col("a") / 100, "e": F.col("b").cast("double")})
    return fields.max_min_fields(fields.max_min_fields(df, ["c", "e"], True, "most"), ["c", "e"], False, "least").select("findex", "most", "least")


@query(f"with {fx.DIRTY} select findex, num >= 50 as big, event_type != 'view' as other, coalesce(v, 'None') = 'None' as missing from d")
def evaluate_attribute(s, d):
    df = fields.evaluate_attribute(fx.dirty(s, d), "num", ">=", "50", "big")
    df = fields.evaluate_attribute(df, "event_type", "!=", "view", "other")
    return fields.evaluate_attribute(df, "v", "=", "None", "missing").select("findex", "big", "other", "missing")


@query("select c_custkey as findex, exists (select 1 from orders where o_custkey = c_custkey) as has_order from customer")
def evaluate_pairs(s, d):
    pairs = fx.table(s, d, "orders").select(F.col("o_custkey").alias("l"), F.col("o_orderkey").alias("r"))
    return fields.evaluate_pairs(fx.table(s, d, "customer").select(F.col("c_custkey").alias("findex")), pairs, "has_order")


@query(f"with {fx.FIELDS}, n as (select 'part/a' as dwh, findex, cast(b as varchar) as value from f union all select 'other/b', findex, cast(b as varchar) from f) select dwh, findex, value from n where split_part(dwh, '/', 1) = 'part'")
def extract_group(s, d):
    f = fx.fields(s, d)
    both = f.select(F.lit("part/a").alias("dwh"), "findex", F.col("b").cast("string").alias("value")).unionAll(f.select(F.lit("other/b"), "findex", F.col("b").cast("string")))
    return fields.extract_group(both, "part")


@query("select 'yes' as side, event_id from events where value > 50 union all select 'no', event_id from events where not coalesce(value > 50, false)")
def divide_geometry(s, d):
    a, b = fields.divide(fx.table(s, d, "events").select("event_id", (F.col("value") > 50).alias("c")), "c")
    return a.select(F.lit("yes").alias("side"), "event_id").unionAll(b.select(F.lit("no").alias("side"), "event_id"))


@query("select event_id from events where not coalesce(value > 50, false)")
def remove_geometry(s, d):
    return fields.remove_where(fx.table(s, d, "events").select("event_id", (F.col("value") > 50).alias("c")), "c").select("event_id")


@query("select event_id, case when event_type in ('view', 'click') then 'view@click' when event_type in ('purchase') then 'purchase' else 'other' end as group_name from events")
def split_by_values(s, d):
    return fields.split_by_values(fx.table(s, d, "events"), "event_type", [["view", "click"], ["purchase"]]).select("event_id", "group_name")


@query("select o_orderkey as findex, 0 as part, o_custkey as v, o_orderstatus as t from orders union all select o_orderkey, 1, cast(floor(o_totalprice) as bigint), o_orderpriority from orders where true")
def columns_to_rows(s, d):
    df = fx.table(s, d, "orders").select(F.col("o_orderkey").alias("findex"), F.col("o_custkey").alias("a1"), F.col("o_orderstatus").alias("b1"), F.floor("o_totalprice").alias("a2"), F.col("o_orderpriority").alias("b2"))
    return fields.columns_to_rows(df, "a1", ["v", "t"])


@query("select user_id, event_id from (select *, max(value) over (partition by user_id) as m, avg(value) over (partition by user_id) as g from events) where value = m")
def filter_measures(s, d):
    return fields.filter_measures(fx.table(s, d, "events"), "value", "max", group=["user_id"]).select("user_id", "event_id")


# joins -------------------------------------------------------------------------------------------------


@query("select o.o_orderkey, o.o_custkey, coalesce(c.c_nationkey, 0) as c_nationkey, c.c_name from orders o left join customer c on o.o_custkey = c.c_custkey and c.c_acctbal > 0")
def join_horizontal(s, d):
    o = fx.table(s, d, "orders").select("o_orderkey", "o_custkey")
    c = fx.table(s, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("k"), "c_nationkey", "c_name")
    return joins.join_tables(o, c, "o_custkey", "k", ["c_nationkey", "c_name"], "left")


@query("select n_nationkey as k, n_name as name, n_regionkey as extra, 'nation' as filename from nation union all select r_regionkey, r_name, null, 'region' from region")
def join_vertical(s, d):
    n = fx.table(s, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("extra"))
    return joins.stack_tables({"nation": n, "region": fx.table(s, d, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))}).select("k", "name", "extra", "filename")


@query("select o_orderkey as l, c_mktsegment as value from orders join customer on o_custkey = c_custkey where c_mktsegment <> ''")
def concatenate_attribute(s, d):
    pairs = fx.table(s, d, "orders").select(F.col("o_orderkey").alias("l"), F.col("o_custkey").alias("r"))
    return joins.concatenate_attribute(pairs, fx.table(s, d, "customer").select(F.col("c_custkey").alias("findex"), F.col("c_mktsegment").alias("value")))


@query("select n_name as name, s_suppkey as id, n_nationkey as findex from supplier join nation on s_nationkey = n_nationkey")
def synchronize_findex(s, d):
    src = fx.table(s, d, "nation").select(F.col("n_nationkey").alias("findex"), F.col("n_name").alias("name"))
    dst = fx.table(s, d, "supplier").join(F.broadcast(src.withColumnRenamed("findex", "k")), F.col("s_nationkey") == F.col("k")).select(F.lit(-1).alias("findex"), "name", F.col("s_suppkey").alias("id"))  # 25 nations
    return joins.synchronize_findex(src, dst, "name").select("name", "id", "findex")


@query("select o_custkey as findex, o_totalprice as value from (select *, row_number() over (partition by o_custkey order by o_orderkey) as n from orders) where n = 1")
def update_findex(s, d):
    o = fx.table(s, d, "orders")
    return joins.update_findex(o.select(F.col("o_custkey").alias("l"), F.col("o_orderkey").alias("r")), o.select(F.col("o_orderkey").alias("findex"), F.col("o_totalprice").alias("value")))


@query("select o_custkey as findex, o_orderkey as r, o_totalprice as price from (select *, row_number() over (partition by o_custkey order by (o_orderstatus = 'F') desc, o_totalprice desc, o_orderkey) as n from orders) where n = 1")
def add_line_fields(s, d):
    o = fx.table(s, d, "orders").select(F.col("o_custkey").alias("findex"), F.col("o_orderkey").alias("r"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    return joins.resolve_duplicates(o, "findex", [("status", 1, "F"), ("price", 1, None)], "r").select("findex", "r", "price")


@query("with e as (select user_id as k, event_id as a, event_id + cast(floor(value) as bigint) as b from events), m as (select *, max(b) over (partition by k order by a, b rows between unbounded preceding and 1 preceding) as reach from e), i as (select *, sum(case when reach is null or a > reach then 1 else 0 end) over (partition by k order by a, b) as n from m) select k, min(a) as a, max(b) as b from i group by k, n")
def merge_ranges(s, d):
    e = fx.table(s, d, "events").select(F.col("user_id").alias("k"), F.col("event_id").alias("a"), (F.col("event_id") + F.floor("value")).alias("b"))
    return joins.merge_ranges(e, ["k"], "a", "b").select("k", "a", "b")


# aggregates --------------------------------------------------------------------------------------------


@query(f"with {fx.DIRTY} select coalesce(event_type, 'None') as value, count(*) as n from d group by 1")
def unique_values(s, d):
    return aggregates.unique_values(fx.dirty(s, d), "event_type")


@query("select 'o_orderstatus' as column_name, 'string' as data_type, o_orderstatus as value, count(*) as n from orders group by 3 union all select 'o_orderpriority', 'string', o_orderpriority, count(*) from orders group by 3")
def analyze(s, d):
    return aggregates.analyze(fx.table(s, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("select o_custkey, count(*) as n from orders group by 1 having count(*) > 1")
def duplicate_keys(s, d):
    return aggregates.duplicate_keys(fx.table(s, d, "orders"), "o_custkey")


@query("with f as (select user_id, event_id, case when event_type = 'view' then '1' else '0' end as flag from events), g as (select *, coalesce(sum(case when flag = '1' then 0 else 1 end) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) as record from f) select user_id, cast(record as bigint) as record, string_agg(cast(event_id as varchar), '' order by event_id) as piece, min(event_id) as first_id, count(*) as n_rows from g group by 1, 2")
def recreate_records(s, d):
    e = fx.table(s, d, "events").select("user_id", "event_id", F.col("event_id").cast("string").alias("piece"), F.when(F.col("event_type") == "view", "1").otherwise("0").alias("flag"), F.col("event_id").alias("first_id"))
    return aggregates.recreate_records(e, "flag", "1", "event_id", "piece", ["first_id"], ["user_id"])


_STEP = "sqrt(power(lead(x) over w - x, 2) + power(lead(y) over w - y, 2)"


@query(f"with {fx.SHORT}, s as (select findex, {_STEP} + power(lead(z) over w - z, 2)) as d from lines window w as (partition by findex order by seq)) select findex, round(coalesce(sum(d), 0), 6) as length from s group by 1")
def polyline_length(s, d):
    return r6(aggregates.length(fx.short_lines(s, d)))


@query(f"with {fx.LONG}, s as (select findex, seq, z, {_STEP}) as d from lines window w as (partition by findex order by seq)) select findex, case when sum(d) > 0 then round_even(abs(arg_max(z, seq) - arg_min(z, seq)) / sum(d) * 10, 1) end as gradient from s group by 1")
def polyline_gradient(s, d):
    return aggregates.gradient(fx.long_lines(s, d))


@query(f"with {fx.SHORT} select findex, max(z) as z_max, min(z) as z_min from lines group by 1")
def z_range(s, d):
    return aggregates.z_range(fx.short_lines(s, d))


@query(f"with {fx.LONG} select min(x) as x_min, min(y) as y_min, max(x) as x_max, max(y) as y_max from lines")
def bounding_box(s, d):
    return aggregates.bounding_box(fx.long_lines(s, d))


@query()
def uuids(s, d):
    return aggregates.uuids(fx.long_lines(s, d))


# vertices ----------------------------------------------------------------------------------------------


@query(f"with {fx.LONG}, a as (select *, coalesce(sqrt(power(x - lag(x) over w, 2) + power(y - lag(y) over w, 2)), 0) as d from lines window w as (partition by findex order by seq)), b as (select *, sum(d) over (partition by findex order by seq) as pos, sum(d) over (partition by findex) as total, arg_min(z, seq) over (partition by findex) as za, arg_max(z, seq) over (partition by findex) as zb, min(seq) over (partition by findex) as s0, max(seq) over (partition by findex) as s1 from a) select findex, seq, round(case when seq <> s0 and seq <> s1 and total > 0 then za + (zb - za) * pos / total else z end, 6) as z from b")
def estimate_z(s, d):
    return r6(vertices.estimate_z(fx.long_lines(s, d)).select("findex", F.col("seq").cast("bigint").alias("seq"), "z"))


@query(f"with {fx.SHORT}, n as (select *, lead(x) over w as nx, lead(y) over w as ny, lead(z) over w as nz from lines window w as (partition by findex order by seq)), k as (select *, greatest(1, coalesce(ceil(sqrt(power(nx - x, 2) + power(ny - y, 2)) / 10), 1))::int as k from n), e as (select *, unnest(range(0, k)) as i from k) select findex, row_number() over (partition by findex order by seq, i) - 1 as seq, round(case when i = 0 then x else x + (nx - x) * i / k end, 8) as x, round(case when i = 0 then y else y + (ny - y) * i / k end, 8) as y, round(case when i = 0 then z else z + (nz - z) * i / k end, 8) as z from e")
def densify(s, d):
    return rounded(vertices.densify(fx.short_lines(s, d), 10.0), 8).withColumn("seq", F.col("seq").cast("bigint"))


@query(f"with {fx.SHORT} select findex, seq, round(x + 1.5, 6) as x, round(y - 2, 6) as y, round(z + 3, 6) as z from lines")
def offset(s, d):
    return r6(vertices.offset(fx.short_lines(s, d), 1.5, -2.0, 3.0)).withColumn("seq", F.col("seq").cast("bigint"))


@query(f"with {fx.LONG}, b as (select (min(x) + max(x)) / 2 as cx, (min(y) + max(y)) / 2 as cy from lines) select findex, seq, round(cx + (x - cx) * cos(radians(30)) - (y - cy) * sin(radians(30)), 6) as x, round(cy + (x - cx) * sin(radians(30)) + (y - cy) * cos(radians(30)), 6) as y from lines, b")
def rotate(s, d):
    return r6(vertices.rotate(fx.long_lines(s, d), 30.0).select("findex", F.col("seq").cast("bigint").alias("seq"), "x", "y"))


@query(f"with {fx.SHORT}, c as (select o_orderkey as findex, o_totalprice / 100000 as covering, 0.5 as width from orders) select l.findex, seq, round(z - coalesce(covering, 0) + coalesce(width / 2, 0), 9) as z from lines l left join c using (findex)")
def z_by_covering(s, d):
    o = fx.table(s, d, "orders")
    cover, width = o.select(F.col("o_orderkey").alias("findex"), (F.col("o_totalprice") / 100000).alias("covering")), o.select(F.col("o_orderkey").alias("findex"), F.lit(0.5).alias("width"))
    return rounded(vertices.z_by_covering(fx.short_lines(s, d), covering=cover, width=width).select("findex", F.col("seq").cast("bigint").alias("seq"), "z"), 9)


@query(f"with {fx.SHORT}, m as (select *, min(seq) over (partition by findex) as a, max(seq) over (partition by findex) as b from lines) select findex, seq, round(z - case when seq = a then 1.5 when seq = b then 2.5 else 0 end, 6) as z from m")
def subtract_depth(s, d):
    depths = fx.table(s, d, "orders").select(F.col("o_orderkey").alias("findex"), F.lit(1.5).alias("start_depth"), F.lit(2.5).alias("end_depth"))
    return r6(vertices.subtract_depth(fx.short_lines(s, d), depths).select("findex", F.col("seq").cast("bigint").alias("seq"), "z"))


@query(f"with {fx.SHORT}, g as (select findex, min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from lines group by 1) select findex, unnest([0, 1, 2, 3, 4]) as seq, unnest([x0, x1, x1, x0, x0]) as x, unnest([y0, y0, y1, y1, y0]) as y from g")
def range_polygons(s, d):
    return vertices.range_polygons(fx.short_lines(s, d)).select("findex", "seq", "x", "y")


@query(f"with {fx.LONG}, n as (select findex, x * lead(y) over w - lead(x) over w * y as c, {_STEP}) as d from lines window w as (partition by findex order by seq)) select findex, round(sum(c) / 2, 4) as area, round(sum(d), 4) as perimeter from n group by 1")
def ring_area(s, d):
    return vertices.ring_area(fx.long_lines(s, d)).select("findex", F.round("area", 4).alias("area"), F.round("perimeter", 4).alias("perimeter"))


@query(f"with {fx.PLANE}, dem as (select row, col, cast((row * 31 + col * 17) % 101 as double) as z from range(0, 30) r(row), range(0, 40) c(col)) select findex, x, y, dem.z as z from points join dem on floor(x / 100) = col and floor((3000 - y) / 100) = row")
def drape(s, d):
    dem = s.range(1200).select((F.col("id") / 40).cast("long").alias("row"), (F.col("id") % 40).alias("col")).withColumn("z", ((F.col("row") * 31 + F.col("col") * 17) % 101).cast("double"))
    return vertices.drape(fx.plane_points(s, d), dem, 0.0, 3000.0, 100.0)


@query(f"with {fx.PLANE} select findex, unnest([0, 1]) as seq, x, y, unnest([z, z - 1.2]) as z from points")
def depth_lines(s, d):
    return vertices.points_to_depth_lines(fx.plane_points(s, d).withColumn("depth", F.lit(1200)), "depth", "mm")


@query(f"with {fx.SHORT}, e as (select findex, arg_min(x, seq) as xa, arg_min(y, seq) as ya, arg_max(x, seq) as xb, arg_max(y, seq) as yb from lines group by 1 having count(*) >= 2) select findex, cast(trunc(xa) as int) as x0, cast(trunc(ya) as int) as y0, cast(trunc(xb) as int) as x1, cast(trunc(yb) as int) as y1, round(degrees(atan2(yb - ya, xb - xa)), 2) as angle from e")
def line_ends(s, d):
    v = fx.short_lines(s, d)
    ends = v.groupBy("findex").agg(F.min("seq").alias("first"), F.max("seq").alias("last")).where("first < last")
    return fields.line_ends(v.join(ends, "findex").where("seq = first or seq = last").drop("first", "last"))


@query(f"with {fx.SHORT}, n as (select findex, count(*) - 1 as segs, sum(case when d < 3 then 1 else 0 end) as close, arg_min(x, seq) <> arg_max(x, seq) or arg_min(y, seq) <> arg_max(y, seq) as open, sum(c) < 0 as cw, count(*) < 4 as few, sum(case when same then 1 else 0 end) as same from (select *, {_STEP}) as d, x * lead(y) over w - lead(x) over w * y as c, x = lead(x) over w and y = lead(y) over w and z = lead(z) over w as same from lines window w as (partition by findex order by seq)) group by 1), u as (select findex, unnest(['repeated_vertex', 'too_close', 'not_closed', 'clockwise', 'too_few_vertices']) as problem, unnest([same, close, open::int, coalesce(cw, false)::int, few::int]) as n from n) select findex, problem, cast(n as bigint) as n from u where n > 0")
def check_shapes(s, d):
    return vertices.check_shapes(fx.short_lines(s, d), 3.0)


# tiles -------------------------------------------------------------------------------------------------


@query(f"with {fx.PLACES} select findex, cast(floor((lon + 180) / 360 * 262144) as bigint) as x, cast(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 262144) as bigint) as y, cast(floor(h * 262144 / 33554432) as bigint) as f from places")
def spatial_ids(s, d):
    p = fx.places(s, d)
    return p.select("findex", tiles.tile_x(F.col("lon"), 18).alias("x"), tiles.tile_y(F.col("lat"), 18).alias("y"), tiles.tile_f(F.col("h"), 18).alias("f"))


@query(f"with {fx.PLACES}, t as (select findex, floor((lon + 180) / 360 * 1048576) as x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 1048576) as y, floor(h * 1048576 / 33554432) as f from places) select findex, round((x + 0.5) / 1048576 * 360 - 180, 6) as x, round(degrees(atan(sinh(pi() * (1 - 2 * (y + 0.5) / 1048576)))), 6) as y, (f + 0.5) * 32 as z from t")
def voxel_centres(s, d):
    p = fx.places(s, d).select("findex", tiles.voxel_id(F.col("lon"), F.col("lat"), F.col("h"), 20).alias("id"))
    return r6(tiles.voxel_centres(p, "id").select("findex", "x", "y", "z"))


@query(f"with {fx.PLACES}, m as (select findex, lat * 1.5 as u, lon - 100 as v from places), n as (select *, floor(u) as p, floor(v) as q, (u - floor(u)) * 8 as r, (v - floor(v)) * 8 as s from m) select findex, lpad(cast(cast(p as bigint) as varchar), 2, '0') || lpad(cast(cast(q as bigint) as varchar), 2, '0') || cast(cast(floor(r) as bigint) as varchar) || cast(cast(floor(s) as bigint) as varchar) as mesh from n")
def mesh_codes(s, d):
    return fx.places(s, d).select("findex", tiles.mesh_code(F.col("lon"), F.col("lat"), 2).alias("mesh"))


@query(f"with {fx.PLANE}, c as (select findex, floor(x / 40000) + 4 as col, floor(-y / 30000) + 10 as row, x - floor(x / 40000) * 40000 as dx, -y - floor(-y / 30000) * 30000 as dy from points) select findex, '09' || chr(65 + row::int) || chr(65 + col::int) || cast(floor(dy / 3000)::int as varchar) || cast(floor(dx / 4000)::int as varchar) || cast((floor((dy - floor(dy / 3000) * 3000) / 1500) * 2 + floor((dx - floor(dx / 4000) * 4000) / 2000) + 1)::int as varchar) as sheet from c")
def sheet_codes(s, d):
    return fx.plane_points(s, d).select("findex", tiles.sheet_code(F.col("x"), F.col("y"), tiles.zone_of(6677), 2500).alias("sheet"))


@query("select event_id, cast((row_number() over (order by event_id) - 1) // 1000 as bigint) as tile from events")
def split_by_index(s, d):
    return tiles.split_by_index(fx.table(s, d, "events").select("event_id"), 1000, ["event_id"])


@query("with t as (select distinct event_type as list_name, cast(floor(value * 10) as bigint) as tile from events) select list_name || '_' || cast(tile as varchar) as dwh, '' as type, '' as value from (select distinct list_name from t) l, (select distinct tile from t) m where not exists (select 1 from t where t.list_name = l.list_name and t.tile = m.tile)")
def missing_tiles(s, d):
    t = fx.table(s, d, "events").select(F.col("event_type").alias("list_name"), F.floor(F.col("value") * 10).alias("tile")).distinct()
    return tiles.missing_tiles(t)


@query("select event_id, row_number() over (order by user_id, event_id) - 1 as n from events")
def numbering(s, d):
    return numbered(fx.table(s, d, "events").select("event_id", "user_id"), ["user_id", "event_id"], "n", 3000).select("event_id", "n")


# spatial -----------------------------------------------------------------------------------------------


@query(f"with {fx.PLANE}, {fx.BOXES} select p.findex as l, b.findex as r from points p join boxes b on x > x0 and x < x0 + 800 and y > y0 and y < y0 + 600")
def spatial_within(s, d):
    pts = fx.plane_points(s, d).select("findex", F.lit("Point").alias("gtype"), F.array(F.struct("x", "y", "z")).alias("coords"))
    return spatial.predicate_pairs(pts, fx.boxes(s, d).select("findex", "gtype", "coords"), "within", 500.0)


@query(f"with {fx.BOXES} select a.findex as l, b.findex as r from boxes a join boxes b on a.findex <> b.findex and abs(a.x0 - b.x0) <= 800 and abs(a.y0 - b.y0) <= 600")
def spatial_touches(s, d):
    b = fx.boxes(s, d).select("findex", "gtype", "coords")
    return spatial.predicate_pairs(b, b, "touches", 500.0)


@query(f"with {fx.PLANE} select a.findex as l, b.findex as r, round(sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)), 6) as distance from points a join points b on sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2)) <= 150")
def spatial_distance(s, d):
    pts = fx.plane_points(s, d).select("findex", F.lit("Point").alias("gtype"), F.array(F.struct("x", "y", "z")).alias("coords"))
    return r6(spatial.distance_pairs(pts, pts, 150.0, 300.0))


@query(f"with {fx.PLANE}, {fx.BOXES} select distinct p.* from points p join boxes b on x > x0 and x < x0 + 800 and y > y0 and y < y0 + 600")
def extract_by_location(s, d):
    pts = fx.plane_points(s, d)
    shapes = pts.select("findex", F.lit("Point").alias("gtype"), F.array(F.struct("x", "y", "z")).alias("coords"))
    found = spatial.extract_by_location(shapes, fx.boxes(s, d).select("findex", "gtype", "coords"), "within", 500.0)
    return pts.join(found, "findex", "left_semi")


_GRID = "l as (select k as line, 0.0 as ax, k * 250.0 + 20 as y0, 4000.0 as bx, k * 250.0 + 60 as y1 from range(0, 12) t(k))"
_FOOT = "f as (select p.findex as point, line, greatest(0, least(1, ((x - ax) * (bx - ax) + (y - y0) * (y1 - y0)) / (power(bx - ax, 2) + power(y1 - y0, 2)))) as t, x as px, y as py, ax, y0, bx, y1 from points p, l), g as (select *, sqrt(power(px - ax - t * (bx - ax), 2) + power(py - y0 - t * (y1 - y0), 2)) as d from f), n as (select *, row_number() over (partition by point order by d, line) as n from g where d <= 100)"


def _grid_lines(s: SparkSession) -> DataFrame:
    k = F.col("id").cast("double")
    return s.range(12).select(F.col("id").alias("findex"), F.inline(F.array(F.struct(F.lit(0).alias("seq"), F.lit(0.0).alias("x"), (k * 250 + 20).alias("y"), F.lit(0.0).alias("z")), F.struct(F.lit(1).alias("seq"), F.lit(4000.0).alias("x"), (k * 250 + 60).alias("y"), F.lit(0.0).alias("z")))))


@query(f"with {fx.PLANE}, {_GRID}, {_FOOT} select point as l, line as r from n where n = 1")
def join_by_nearest(s, d):
    return spatial.join_by_nearest(fx.plane_points(s, d), _grid_lines(s), 100.0)


@query(f"with {fx.PLANE}, {_GRID}, {_FOOT} select p.findex, round(coalesce(ax + t * (bx - ax), x), 6) as x, round(coalesce(y0 + t * (y1 - y0), y), 6) as y, z from points p left join n on point = p.findex and n = 1")
def snap_points(s, d):
    return r6(spatial.snap_points(fx.plane_points(s, d), _grid_lines(s), 100.0))


@query()
def insert_snapped(s, d):
    return spatial.insert_snapped(fx.plane_points(s, d), _grid_lines(s), 100.0, 1.0)


@query("with recursive e as (select p_partkey - 37 * p_size as l, p_partkey as r from part where p_partkey > 37 * p_size), up as (select r as node, l as root from e union all select node, l from up join e on r = root) select node, min(root) as root from (select * from up union all select l, l from e) group by 1")
def connected_groups(s, d):
    """A link a part to one before it: trees whose least part is their root."""
    p = fx.table(s, d, "part").select((F.col("p_partkey") - 37 * F.col("p_size")).alias("l"), F.col("p_partkey").alias("r"))
    return network.components(p.where("l > 0")).select("node", "root")


@query(f"with {fx.BOXES} select findex, round(greatest(0, least(x0 + 800, 2500) - greatest(x0, 500)) * greatest(0, least(y0 + 600, 2000) - greatest(y0, 500)), 4) as area from boxes where x0 < 2500 and x0 + 800 > 500 and y0 < 2000 and y0 + 600 > 500")
def clip_polygons(s, d):
    v = vertices.to_vertices(fx.boxes(s, d))
    return vertices.ring_area(solids.clip_polygons(v, 500.0, 500.0, 2500.0, 2000.0)).select(F.col("findex").cast("int").alias("findex"), F.round(F.abs("area"), 4).alias("area"))


@query(f"with {fx.PLANE} select findex, x, y, z from points where x between 500 and 2500 and y between 500 and 2000")
def clip_points(s, d):
    return solids.clip_points(fx.plane_points(s, d), 500.0, 500.0, 2500.0, 2000.0)


@query(f"with {fx.BOXES} select cast(findex as double) as findex, round(800.0 * 600 * 10, 3) as volume from boxes")
def prism_volume(s, d):
    b = fx.boxes(s, d)
    return solids.volume(solids.prism_solids(vertices.to_vertices(b), b.select("findex", F.lit(10.0).alias("height")))).select("findex", F.round("volume", 3).alias("volume"))


@query("with p as (select unnest(['x', 'y']) as g, 1 as one), e as (select cast(floor(s_suppkey * 7919 % 4000 / 1000) as int) as px, cast(floor(s_suppkey * 104729 % 3000 / 1000) as int) as py, s_suppkey from supplier) select s_suppkey as findex, px, py, 100.0 + (px + 0.5) * 2 as x, 500.0 - (py + 0.5) * 3 as y from e")
def pixels_to_points(s, d):
    p = fx.table(s, d, "supplier").select(F.col("s_suppkey").alias("findex"), F.floor(F.col("s_suppkey") * 7919 % 4000 / 1000).cast("int").alias("px"), F.floor(F.col("s_suppkey") * 104729 % 3000 / 1000).cast("int").alias("py"))
    return network.pixels_to_points(p, 100.0, 500.0, 2.0, 3.0)


@query(f"with {fx.DIRTY} select 'ED001' as code, 'field_null' as message, 'v' as column_name, cast(findex as double) as findex from d where v is null or trim(v) = '' union all select 'ED003', 'fields_type_is_num', 'event_type', findex from d union all select 'EC005', 'duplicates_fid_data', 'user_id', min(findex) from d group by user_id having count(*) > 1")
def validate_rules(s, d):
    return validate.validate(fx.dirty(s, d), [("field_null", "v"), ("fields_type_is_num", "event_type"), ("duplicates_fid_data", "user_id"), ("empty_data", "findex")])


# whole shapes, solids, networks, rasters: without SQL, held against cases and invariants in tests/ ----------


def _pixels(s, d) -> DataFrame:
    """A 16 x 16 grey picture a user, of event numbers."""
    from terravane.operators.images import SCHEMA, row_of

    e = fx.table(s, d, "events").select((F.col("event_id") / 256).cast("long").alias("findex"), (F.col("event_id") % 256).alias("at"), (F.col("event_id") * 37 % 256).alias("v"))

    def run(f):
        import numpy as np
        import pandas as pd

        img = np.zeros(256, np.uint8)
        img[f["at"].to_numpy()] = f["v"].to_numpy()
        return pd.DataFrame([row_of("events", float(f["findex"].iloc[0]), "GRAYSCALE", img.reshape(16, 16))])

    return e.groupBy("findex").applyInPandas(run, SCHEMA)


@query()
def simplify(s, d):
    return solids.simplify(fx.long_lines(s, d), 5.0)


@query()
def representative_points(s, d):
    return solids.representative_points(vertices.to_vertices(fx.boxes(s, d)))


@query()
def box_solids(s, d):
    v = fx.short_lines(s, d)
    return solids.box_solids(v, v.select("findex").distinct().select("findex", F.lit(0.4).alias("width"), F.lit(0.2).alias("depth")))


@query()
def cylinder_solids(s, d):
    v = fx.short_lines(s, d)
    return solids.cylinder_solids(v, v.select("findex").distinct().select("findex", F.lit(0.2).alias("radius")), 8)


@query()
def bottom_polygons(s, d):
    v = fx.short_lines(s, d)
    return solids.bottom_polygons(v, v.select("findex").distinct().select("findex", F.lit(0.5).alias("width")))


@query()
def affine_sheet(s, d):
    p = fx.plane_points(s, d)
    control = s.range(25).select((F.col("id") % 5 * 1000.0 - 1).alias("x"), (F.floor(F.col("id") / 5) * 800.0 - 1).alias("y"), F.lit(0.0).alias("z")).withColumns({"tx": F.col("x") + 3, "ty": F.col("y") - 2, "tz": F.col("z") + 1})
    return solids.affine_sheet(p, control, True)


@query()
def reproject(s, d):
    from terravane.functions import crs

    return crs.reproject(fx.plane_points(s, d), 6677, 6668)


@query()
def city_models(s, d):
    from terravane.operators import export

    b = fx.boxes(s, d)
    t = solids.prism_solids(vertices.to_vertices(b), b.select("findex", F.lit(10.0).alias("height")))
    sheets = b.select(F.col("findex").cast("double").alias("findex"), tiles.sheet_code(F.col("x_min") + 1, F.col("y_min") + 1, "09", 2500).alias("sheet"))
    return export.city_models(t, b.select(F.col("findex").cast("double").alias("findex"), F.col("gtype").alias("kind")), sheets, "frn:CityFurniture", "EPSG:6697")


@query()
def gltf(s, d):
    from terravane.operators import export

    b = fx.boxes(s, d)
    t = solids.prism_solids(vertices.to_vertices(b), b.select("findex", F.lit(10.0).alias("height")))
    return export.gltf(t, b.select(F.col("findex").cast("double").alias("findex"), F.col("gtype").alias("kind")))


@query()
def line_voxels(s, d):
    from terravane.operators import export

    v = vertices.to_vertices(fx.boxes(s, d))
    return export.line_voxels(v, v.select("findex").distinct().select("findex", F.lit(2.0).alias("width"), F.lit(2.0).alias("height")), 20, 6677)


@query()
def overlay_difference(s, d):
    b = fx.boxes(s, d).select("findex", "gtype", "coords")
    moved = b.select((F.col("findex") + 100).alias("findex"), "gtype", F.transform("coords", lambda p: F.struct((p["x"] + 300).alias("x"), (p["y"] + 200).alias("y"), p["z"].alias("z"))).alias("coords"))
    pairs = spatial.predicate_pairs(b, moved, "overlaps", 500.0)
    return spatial.overlay_pairs(b, moved, pairs, "symmetric_difference").select("l", "ring", "area")


@query()
def integrate_lines(s, d):
    v = fx.short_lines(s, d).select("findex", "seq", F.floor("x").cast("double").alias("x"), F.floor(F.col("y") / 10).cast("double").alias("y"), "z")
    return network.integrate_lines(v)


@query()
def segment_crossings(s, d):
    return network.segment_crossings(_grid_lines(s).unionByName(vertices.to_vertices(fx.boxes(s, d)).withColumn("findex", F.col("findex").cast("long") + 100)), 500.0)


@query()
def image_regions(s, d):
    from terravane.operators import images

    return images.regions(images.to_binary(_pixels(s, d), 128), 4)


@query()
def image_edges(s, d):
    from terravane.operators import images

    return images.edges(images.smooth(_pixels(s, d), 3, 1.0), "Sobel")


@query()
def geojson_features(s, d):
    from terravane.sources import readers

    b = fx.boxes(s, d).select("findex", "gtype", F.array("coords").alias("parts"), F.create_map(F.lit("findex"), F.col("findex").cast("string")).alias("attributes"))
    return readers.to_geojson(b)
