"""Keyed joins of field tables; Catalyst picks the join strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

HORIZONTAL = {"inner": "inner", "outer": "full", "left": "left", "right": "right", "横結合(内部結合)": "inner", "横結合(外部結合)": "full", "横結合(左結合)": "left", "横結合(右結合)": "right"}


def stack_tables(frames: dict[str, DataFrame], common_only: bool = False) -> DataFrame:
    """Vertical join: all rows with their frame's name in `filename`; columns that some lack are null, or left out with common_only."""
    named = [df.withColumn("filename", F.lit(name)) for name, df in frames.items()]
    if common_only:
        shared = [c for c in named[0].columns if all(c in df.columns for df in named)]
        named = [df.select(shared) for df in named]
    out = named[0]
    for df in named[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def join_tables(base: DataFrame, target: DataFrame, base_key: str, target_key: str, columns: list[str], how: str = "inner", fill_integers: bool = True) -> DataFrame:
    """Horizontal join on keys of other names, keeping base and the listed columns of target; target's key is cast to base's type.

    fill_integers: whole-number columns that an outer join leaves null become 0.
    """
    kind = dict(base.dtypes)[base_key]
    clash = [c for c in columns if c in base.columns]
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(clash)}")
    right = target.select(F.col(target_key).cast(kind).alias("__key"), *columns)
    out = base.join(right, base[base_key] == right["__key"], HORIZONTAL.get(how, how)).drop("__key")
    whole = [c for c, t in out.dtypes if t in ("int", "bigint")] if fill_integers and HORIZONTAL.get(how, how) != "inner" else []
    return out.fillna(0, whole) if whole else out


def merge_ranges(ranges: DataFrame, key: list[str], low: str, high: str) -> DataFrame:
    """Joins overlapping intervals of a key into one."""
    w = Window.partitionBy(*key).orderBy(low, high)
    reach = F.max(high).over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(reach.isNull() | (F.col(low) > F.col("__reach")), 1).otherwise(0)).over(w)
    return ranges.withColumn("__reach", reach).withColumn("__island", island).groupBy(*key, "__island").agg(F.min(low).alias(low), F.max(high).alias(high)).drop("__island")


def concatenate_attribute(pairs: DataFrame, attribute: DataFrame, key: str = "findex", value: str = "value") -> DataFrame:
    """Main pairs (l, r) with the attribute of r: (l, value). Empty values are dropped; a second value of l fails."""
    if dict(pairs.dtypes)["r"].startswith("array"):
        pairs = pairs.select("l", F.explode("r").alias("r"))
    kind = dict(attribute.dtypes)[value]
    empty = F.col(value).isNull() | ((F.col(value) == "") if kind == "string" else F.coalesce(F.col(value) == F.lit(0).cast(kind), F.lit(False)) if kind not in ("boolean",) else ~F.col(value))
    met = pairs.join(attribute.where(~empty).select(F.col(key).alias("r"), value), "r")
    once = met.groupBy("l").agg(F.min(value).alias(value), F.count("*").alias("n"))
    return once.select("l", F.when(F.col("n") == 1, F.col(value)).otherwise(F.raise_error(F.concat(F.lit("several values of "), F.col("l").cast("string"))).cast(kind)).alias(value))


def synchronize_findex(src: DataFrame, dst: DataFrame, attribute: str) -> DataFrame:
    """dst with the findex of src where the attribute agrees; a row without a partner fails."""
    left = dst.drop("findex").join(src.select(F.col("findex"), attribute), attribute, "left")
    checked = F.when(F.col("findex").isNotNull(), F.col("findex")).otherwise(F.raise_error(F.concat(F.lit("no partner: "), F.coalesce(F.col(attribute).cast("string"), F.lit("null")))).cast(dict(src.dtypes)["findex"]))
    return left.withColumn("findex", checked)


def update_findex(pairs: DataFrame, fields: DataFrame, order: str = "r") -> DataFrame:
    """Fields under new keys: pairs (l new, r old) left join fields, the first row of each new key."""
    met = pairs.select("l", "r", *([order] if order not in ("l", "r") else [])).join(fields.withColumnRenamed("findex", "r"), "r", "left")
    first = met.withColumn("__n", F.row_number().over(Window.partitionBy("l").orderBy(order)))
    return first.where("__n = 1").drop("__n", "r").withColumnRenamed("l", "findex")


def resolve_duplicates(df: DataFrame, key: str, rules: list[tuple[str, int, str | None]], order: str) -> DataFrame:
    """One row a key by rules in turn: (column, 1 most or 2 least, None), or (column, 1 equal or 2 unequal, text); the last tie goes to the first by order."""
    by = []
    for column, rule, text in rules:
        if text is None:
            by.append(F.desc_nulls_last(column) if rule == 1 else F.asc_nulls_last(column))
        else:
            fits = F.coalesce(F.col(column) == text, F.lit(False))
            by.append(F.desc(fits if rule == 1 else ~fits))
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(*by, order))).where("__n = 1").drop("__n")


def add_line_fields_to_points(pairs: DataFrame, fields: DataFrame, rules: list[tuple[str, int, str | None]]) -> DataFrame:
    """Points (l) with the fields of their lines (r), duplicates resolved by rules."""
    met = pairs.join(fields.withColumnRenamed("findex", "r"), "r", "left").withColumnRenamed("l", "findex")
    return resolve_duplicates(met, "findex", rules, "r").drop("r")
