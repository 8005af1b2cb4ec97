"""Profiles, polyline measures and gaps-and-islands over field and vertex tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window



def by_seq():
    return Window.partitionBy("findex").orderBy("seq")



def unique_values(df: DataFrame, column: str) -> DataFrame:
    """Different values as text, with counts, nulls read 'None'."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("value")).agg(F.count("*").alias("n"))


def unique_values_text(df: DataFrame, column: str, name: str) -> DataFrame:
    """One line: name@v1,v2@c1,c2, in order of value. The values of one column meet in a row; for columns of few values."""
    rows = unique_values(df, column).agg(F.array_sort(F.collect_list(F.struct("value", "n"))).alias("v"))
    return rows.select(F.concat_ws("@", F.lit(name), F.concat_ws(",", F.transform("v", lambda x: x["value"])), F.concat_ws(",", F.transform("v", lambda x: x["n"].cast("string")))).alias("text"))


def analyze(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, data_type, value, n: counts of each column's values, nulls too, in one pass of an unpivot."""
    kinds = dict(df.dtypes)
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("data_type"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(rows).groupBy("column_name", "data_type", "value").agg(F.count("*").alias("n"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def data_definition(df: DataFrame, name: str) -> list[tuple[str, str]]:
    """The names and types that a definition of df would list."""
    return [(f"{name}/{c}", t) for c, t in df.dtypes]


def recreate_records(df: DataFrame, flag: str, proceed: str, order: str, text: str, firsts: list[str] | None = None, partition: list[str] | None = None) -> DataFrame:
    """Gaps and islands: a record goes on while the flag equals proceed and ends with the first row where it doesn't. Texts are joined in order, other columns are the first row's."""
    w = Window.partitionBy(*(partition or [F.lit(0)])).orderBy(order)
    ends = F.when(F.col(flag).eqNullSafe(F.lit(proceed)), 0).otherwise(1)
    record = F.coalesce(F.sum(ends).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = df.withColumn("record", record)
    return rows.groupBy(*(partition or []), "record").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])).alias(text), *[F.min_by(c, order).alias(c) for c in firsts or []], F.count("*").alias("n_rows")
    )


def step(x: Column, y: Column, z: Column | None = None) -> Column:
    """Distance from this vertex to the next of its line."""
    total = F.pow(F.lead(x).over(by_seq()) - x, 2) + F.pow(F.lead(y).over(by_seq()) - y, 2)
    return F.sqrt(total if z is None else total + F.pow(F.lead(z).over(by_seq()) - z, 2))


def length(vertices: DataFrame, output: str = "length") -> DataFrame:
    """3D length of each line; a single vertex has length 0."""
    steps = vertices.select("findex", step(F.col("x"), F.col("y"), F.coalesce("z", F.lit(0.0))).alias("d"))
    return steps.groupBy("findex").agg(F.coalesce(F.sum("d"), F.lit(0.0)).alias(output))


def gradient(vertices: DataFrame, output: str = "gradient") -> DataFrame:
    """|z at the end - z at the start| / planar length * 10, to 1 digit half to even; null where the length is 0."""
    steps = vertices.select("findex", "seq", "z", step(F.col("x"), F.col("y")).alias("d"))
    ends = steps.groupBy("findex").agg(F.min_by("z", "seq").alias("a"), F.max_by("z", "seq").alias("b"), F.sum("d").alias("d"))
    return ends.select("findex", F.when(F.col("d") > 0, F.bround(F.abs(F.col("b") - F.col("a")) / F.col("d") * 10, 1)).alias(output))


def z_range(vertices: DataFrame, highest: str = "z_max", lowest: str = "z_min") -> DataFrame:
    return vertices.groupBy("findex").agg(F.max("z").alias(highest), F.min("z").alias(lowest))


def uuids(vertices: DataFrame, output: str = "uuid") -> DataFrame:
    """A random UUID for each key."""
    return vertices.select("findex").distinct().withColumn(output, F.expr("uuid()"))


def bounding_box(vertices: DataFrame, by: list[str] | None = None) -> DataFrame:
    return vertices.groupBy(*(by or [])).agg(F.min("x").alias("x_min"), F.min("y").alias("y_min"), F.max("x").alias("x_max"), F.max("y").alias("y_max"))


def update_envelopes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Writes the common envelope of all city-model texts into each: least lower and greatest upper corners."""
    corner = lambda which: F.split(F.regexp_extract(text, rf"<gml:{which}Corner>\s*([^<]*?)\s*</gml:{which}Corner>", 1), r"\s+").cast("array<double>")
    rows = docs.select("*", corner("lower").alias("__low"), corner("upper").alias("__high"))
    best = rows.agg(*[F.min(F.col("__low")[k]).alias(f"l{k}") for k in range(3)], *[F.max(F.col("__high")[k]).alias(f"u{k}") for k in range(3)])
    out = rows.crossJoin(F.broadcast(best))  # one row
    for which, k in (("lower", "l"), ("upper", "u")):
        corner_text = F.concat_ws(" ", *[F.col(f"{k}{i}").cast("string") for i in range(3)])
        out = out.withColumn(text, F.regexp_replace(F.col(text), F.lit(rf"(<gml:{which}Corner>)[^<]*(</gml:{which}Corner>)"), F.concat(F.lit("$1"), corner_text, F.lit("$2"))))
    return out.select(docs.columns)
