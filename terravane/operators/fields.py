"""Scalar field operators: projections, filters, replacement and comparison rules.

A field table has a row for each record: the key `findex` and typed columns.
Every function is lazy and stays within built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

TYPES = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean", "整数型": "bigint", "浮動小数点型": "double", "文字列型": "string"}
#: Codes of a split definition.
SPLIT_CODES = {1: "bigint", 2: "double", 3: "string", 4: "boolean"}
#: Spellings of a missing value in text.
NULL_WORDS = ["Null", "NULL", "None", "NONE", "nan", "Nan", "NaN", "NAN", "#N/A"]
#: Half-width and full-width blanks.
BLANK = r"^[\s　]*$"


def type_of(name: str) -> str:
    return TYPES.get(name, name)


def add_constant_field(df: DataFrame, name: str, value, kind: str = "str") -> DataFrame:
    """A constant column, cast to kind; a null value stays null."""
    return df.withColumn(name, F.lit(value).cast(type_of(kind)))


def overwrite_values(df: DataFrame, column: str, value, kind: str = "str", output: str | None = None) -> DataFrame:
    """Replaces every value of a column by a constant."""
    return add_constant_field(df, output or column, value, kind)


def _divided(a: Column, b: Column) -> Column:
    """IEEE division: x / 0 is infinite, 0 / 0 not a number."""
    sign = F.when(F.isnan(a) | (a == 0), F.lit(float("nan"))).when(a > 0, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, sign).otherwise(F.try_divide(a, b))


def calculate_fields(df: DataFrame, base: str, other: str, method: str, output: str) -> DataFrame:
    """base (+ - * /) other as doubles, row by row; dividing by zero gives an infinity or NaN."""
    a, b = F.col(base).cast("double"), F.col(other).cast("double")
    how = {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: _divided(a, b)}
    return df.withColumn(output, how[method.strip("()")[-1]]())


def add_or_multiply(df: DataFrame, column: str, method: str, value: float, output: str | None = None) -> DataFrame:
    """column + value or column * value, as a double."""
    c = F.col(column).cast("double")
    return df.withColumn(output or column, c * value if "*" in method else c + value)


def convert_type(df: DataFrame, column: str, kind: str, output: str | None = None) -> DataFrame:
    """Casts strictly: a value that doesn't convert fails the job."""
    return df.withColumn(output or column, F.col(column).cast(type_of(kind)))


def round_field(df: DataFrame, column: str, digits: int, output: str | None = None) -> DataFrame:
    """Rounds half to even; null, NaN and '' become null."""
    c = F.col(column)
    c = F.when(F.trim(c.cast("string")) == "", None).otherwise(c.cast("double")) if dict(df.dtypes)[column] == "string" else c.cast("double")
    return df.withColumn(output or column, F.when(~F.isnan(c), F.bround(c, digits)))


def is_missing(c: Column, kind: str, low: float | None = None, high: float | None = None, words: bool = False) -> Column:
    """Null, NaN, infinite, blank, outside [low, high], and, with words, spelled-out nulls."""
    bad = c.isNull()
    if kind == "string":
        bad = bad | c.rlike(BLANK) | c.isin("[]", "{}")
        number = c.try_cast("double")
        if words:
            bad = bad | c.isin(NULL_WORDS)
    else:
        number = c.cast("double")
        bad = bad | F.isnan(number) | number.isin(float("inf"), float("-inf"))
    if low is not None:
        bad = bad | F.coalesce(number < low, F.lit(False))
    if high is not None:
        bad = bad | F.coalesce(number > high, F.lit(False))
    return F.coalesce(bad, F.lit(True))


def fill_missing(df: DataFrame, column: str, default, low: float | None = None, high: float | None = None, words: bool = False, output: str | None = None) -> DataFrame:
    """Replaces missing and out-of-range values by a default of the column's type."""
    kind = dict(df.dtypes)[column]
    return df.withColumn(output or column, F.when(is_missing(F.col(column), kind, low, high, words), F.lit(default).cast(kind)).otherwise(F.col(column)))


def replace_values(df: DataFrame, column: str, pairs: list[tuple[str, str]], output: str | None = None) -> DataFrame:
    """Whole-value replacements, one after the other, on the value as text; a null reads 'None'."""
    c = F.coalesce(F.col(column).cast("string"), F.lit("None"))
    for before, after in pairs:
        c = F.when(c == F.lit("None" if before is None else before), F.lit(after)).otherwise(c)
    return df.withColumn(output or column, c)


def join_fields(df: DataFrame, columns: list[str], delimiter: str, output: str) -> DataFrame:
    """Concatenates columns as text in the order given; a null reads 'None'."""
    return df.withColumn(output, F.concat_ws(delimiter, *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in columns]))


def split_fields(df: DataFrame, column: str, delimiter: str, definition: list[tuple[str, int]]) -> DataFrame:
    """Splits text into the columns of a definition (name, type code): missing parts are null, more parts than names fail."""
    parts = F.split(F.col(column), r"\Q" + delimiter + r"\E", -1)
    out = df.withColumn("__parts", F.when(F.size(parts) > len(definition), F.raise_error(F.concat(F.lit("more parts than the definition names: "), F.col(column)))).otherwise(parts))
    for i, (name, code) in enumerate(definition):
        part = F.get("__parts", F.lit(i))
        out = out.withColumn(name, (F.lower(F.trim(part)) == "true") if SPLIT_CODES[code] == "boolean" else part.cast(SPLIT_CODES[code]))
    return out.drop("__parts")


def max_min_fields(df: DataFrame, columns: list[str], largest: bool, output: str) -> DataFrame:
    """The row's greatest or least value over several columns, nulls left out."""
    cols = [F.col(c) for c in columns]
    return df.withColumn(output, cols[0] if len(cols) == 1 else (F.greatest if largest else F.least)(*cols))


def evaluate_attribute(df: DataFrame, column: str, operator: str, value: str, output: str) -> DataFrame:
    """Compares a column with a constant: as numbers where both are, else as text; a null compares as 'None'."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("None"))
    number = text.try_cast("double")
    try:
        constant = float(value) if value not in ("None", "nan") else None
    except ValueError:
        constant = None
    compare = {"=": Column.__eq__, "!=": Column.__ne__, "<": Column.__lt__, ">": Column.__gt__, "<=": Column.__le__, ">=": Column.__ge__}[operator]
    as_text = compare(text, F.lit(value))
    return df.withColumn(output, as_text if constant is None else F.when(number.isNotNull(), compare(number, F.lit(constant))).otherwise(as_text))


def evaluate_pairs(df: DataFrame, pairs: DataFrame, output: str, key: str = "findex") -> DataFrame:
    """Whether a row has a partner in pairs (l, r)."""
    found = pairs.where("r is not null").select(F.col("l").alias(key)).distinct().withColumn(output, F.lit(True))
    return df.join(found, key, "left").withColumn(output, F.coalesce(output, F.lit(False)))


def extract_group(df: DataFrame, group: str, name: str = "dwh") -> DataFrame:
    """Rows whose name before the slash is group."""
    return df.where(F.substring_index(name, "/", 1) == group)


def extract_geometry_type(df: DataFrame, layers: list[str] | None, number: int) -> DataFrame:
    """Rows of the layers, and of these the number-th geometry type in order of name, from 0."""
    chosen = df.where(F.col("layer").isin(layers)) if layers else df
    kinds = chosen.select("gtype").distinct().withColumn("__rank", F.dense_rank().over(Window.orderBy("gtype")) - 1)  # a handful of types
    return chosen.join(F.broadcast(kinds.where(F.col("__rank") == number).drop("__rank")), "gtype", "left_semi")


def extract_layer(df: DataFrame, number: int, order: str = "findex") -> DataFrame:
    """Rows of the number-th layer, from 0, in the order in which layers first appear."""
    first = df.groupBy("layer").agg(F.min(order).alias("__first")).orderBy("__first", "layer").limit(number + 1)
    chosen = first.orderBy(F.desc("__first"), F.desc("layer")).limit(1) if number else first
    return df.join(chosen.select("layer"), "layer", "left_semi")


def divide(df: DataFrame, condition: str) -> tuple[DataFrame, DataFrame]:
    """Rows where the condition holds, and all others; the condition is dropped."""
    c = F.coalesce(F.col(condition), F.lit(False))
    return df.where(c).drop(condition), df.where(~c).drop(condition)


def remove_where(df: DataFrame, condition: str) -> DataFrame:
    """Rows where the condition doesn't hold."""
    return df.where(~F.coalesce(F.col(condition), F.lit(False)))


def split_by_values(df: DataFrame, column: str, groups: list[list[str]], output: str = "group_name") -> DataFrame:
    """Names each row's group of values, joined by @, or 'other'; the first group that lists a value takes it."""
    c = F.col(column).cast("string")
    rule = F.lit("other")
    for values in reversed(groups):
        rule = F.when(c.isin(values), F.lit("@".join(values))).otherwise(rule)
    return df.withColumn(output, rule)


def columns_to_rows(df: DataFrame, start: str, names: list[str]) -> DataFrame:
    """Wide to long: from column start on, each len(names) columns become a row; rows of nulls only are left out. part: the place of the columns, from 0."""
    at = df.columns.index(start)
    keep, wide = df.columns[:at], df.columns[at:]
    if len(wide) % len(names):
        raise ValueError("the columns don't divide into rows")
    rows = [F.struct(F.lit(i // len(names)).alias("part"), *[F.col(wide[i + k]).alias(n) for k, n in enumerate(names)]) for i in range(0, len(wide), len(names))]
    out = df.select(*keep, F.inline(F.array(*rows)))
    return out.where(F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull())


def filter_measures(df: DataFrame, column: str, how: str, value: float | None = None, value2: float | None = None, group: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """Keeps rows by a measure: <> = > < or between (bounds included, in any order), or the group's max, min or at least its average."""
    c = F.col(column) if digits is None else F.bround(column, digits)
    if how in ("max", "min", "average"):
        w = Window.partitionBy(*(group or [F.lit(0)]))
        own = {"max": F.max(c).over(w), "min": F.min(c).over(w), "average": F.avg(c).over(w)}[how]
        out = df.withColumn("__own", own)
        return out.where(c >= F.col("__own") if how == "average" else c == F.col("__own")).drop("__own")
    if how == "between":
        low, high = sorted((value, value2))
        return df.where(c.between(low, high))
    return df.where({"=": c == value, "<>": c != value, ">": c > value, "<": c < value}[how])


def line_ends(df: DataFrame) -> DataFrame:
    """Two-point lines of a vertex table as whole-number ends and their angle in degrees, to 2 digits; other lines fail."""
    ends = df.groupBy("findex").agg(F.min_by(F.struct("x", "y"), "seq").alias("a"), F.max_by(F.struct("x", "y"), "seq").alias("b"), F.count("*").alias("n"))
    angle = F.round(F.degrees(F.atan2(F.col("b.y") - F.col("a.y"), F.col("b.x") - F.col("a.x"))), 2)
    x0 = F.when(F.col("n") == 2, F.col("a.x")).otherwise(F.raise_error(F.lit("a line of other than two points")).cast("double"))
    return ends.select("findex", x0.cast("int").alias("x0"), F.col("a.y").cast("int").alias("y0"), F.col("b.x").cast("int").alias("x1"), F.col("b.y").cast("int").alias("y1"), angle.alias("angle"))
