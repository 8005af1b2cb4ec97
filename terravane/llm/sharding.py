"""Sharding by vector bin packing: bytes, words and rows are balanced together.

Rows of equal texts form a group, and a group goes to one shard. Groups are
placed largest first, each on the shard where the dot product of its needs and
the shard's residual capacity is highest. Groups are packed in buckets of
bounded size, side by side, into as many bins as there are shards; the bins are
then packed in the same way, until one bucket holds all, so that no task or
driver ever sees more than a bucket. A group that would outweigh a small share
of a shard is first split into parts by a hash of its rows; there are few such
groups, as their shares add up to one.

Defined results: a null text has no bytes and counts as equal to an empty one;
repeated rows are separate rows of one group; null ids are allowed; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from terravane.llm.mixing import words
from terravane.llm.tables import cut

SHARDS = 8
#: Units that one task packs.
BUCKET = 40_000
#: A group larger than this share of a shard is split; smaller ones stay together.
GRAIN = 1 / 2
NEEDS = ["bytes", "words", "rows"]
#: Weights of the needs in the dot product: bytes are to come out near equal, the others as far as that allows.
WEIGHTS = np.array([4.0, 1.0, 1.0])


def place(needs: np.ndarray, shards: int) -> np.ndarray:
    """A shard for each row of needs, in the order given."""
    total = np.maximum(needs.sum(0), 1)
    share = needs / total * shards
    left = np.ones((shards, needs.shape[1]))
    out = np.empty(len(needs), np.int32)
    for i, need in enumerate(share):
        out[i] = s = int((left @ (need * WEIGHTS)).argmax())
        left[s] -= need
    return out


def assign(units: DataFrame, shards: int = SHARDS, bucket: int = BUCKET) -> DataFrame:
    """unit, shard for units with the columns unit (long) and NEEDS."""
    if bucket < 3 * shards:
        raise ValueError("a bucket must hold more units than its bins")
    n = units.count()
    buckets = max(1, -(-n // bucket))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        needs = part[NEEDS].to_numpy(np.float64)
        order = np.lexsort((part["unit"].to_numpy(), -(needs / np.maximum(needs.sum(0), 1)).max(1)))
        shard = np.empty(len(part), np.int32)
        shard[order] = place(needs[order], shards)
        return part.assign(shard=shard)[["bucket", "unit", *NEEDS, "shard"]]

    placed = units.withColumn("bucket", F.pmod(F.xxhash64("unit"), F.lit(buckets))).groupBy("bucket").applyInPandas(run, "bucket long, unit long, bytes long, words long, rows long, shard int")
    if buckets == 1:
        return placed.select("unit", "shard")
    placed = cut(placed.withColumn("bin", F.col("bucket") * shards + F.col("shard")), "bins")
    bins = placed.groupBy(F.col("bin").alias("unit")).agg(*[F.sum(c).alias(c) for c in NEEDS])
    upper = assign(bins, shards, bucket).select(F.col("unit").alias("bin"), F.col("shard").alias("to"))
    return placed.join(upper, "bin").select("unit", F.col("to").alias("shard"))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, bucket: int = BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for each row of docs; slots of a shard are gapless from 0."""
    text = F.coalesce(docs[text_col], F.lit(""))
    base = cut(
        docs.select(
            F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), words(docs[text_col]).alias("words"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("key")
        ),
        "rows",
    )
    groups = base.groupBy("key").agg(F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count("*").alias("rows"))
    groups = cut(groups, "groups")
    total = groups.agg(*[F.greatest(F.coalesce(F.sum(c), F.lit(0)), F.lit(1)).alias(c) for c in NEEDS]).first()
    share = F.greatest(*[F.col(c) / F.lit(total[c]) for c in NEEDS]) * shards / GRAIN
    # shares of each need add up to one, so that there are at most 3 * shards / GRAIN such groups
    hot = groups.withColumn("pieces", F.ceil(share).cast("int")).where("pieces > 1").select("key", "pieces")
    members = base.join(F.broadcast(hot), "key", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("doc_id", "row"), F.col("pieces")), F.lit(0))).drop("pieces")
    cold = groups.join(F.broadcast(hot), "key", "left_anti").select("key", F.lit(0).cast("long").alias("salt"), *NEEDS)
    split = base.join(F.broadcast(hot), "key").groupBy("key", F.pmod(F.xxhash64("doc_id", "row"), F.col("pieces")).alias("salt")).agg(F.sum("size").alias("bytes"), F.sum("words").alias("words"), F.count("*").alias("rows"))
    units = cut(cold.unionAll(split).withColumn("unit", F.monotonically_increasing_id()), "units")
    placed = units.select("unit", "key", "salt").join(assign(units.select("unit", *NEEDS), shards, bucket), "unit").select("key", "salt", "shard")
    n = max(1, -(-total["rows"] // bucket))
    found = cut(members.join(placed, ["key", "salt"]).select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("row"), F.lit(n)).alias("chunk"), "row"), "sharded")
    counts = found.groupBy("shard", "chunk").count()
    base_slot = counts.select("shard", "chunk", (F.sum("count").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    w = Window.partitionBy("shard", "chunk").orderBy("row")
    return found.withColumn("at", F.row_number().over(w) - 1).join(base_slot, ["shard", "chunk"]).select("doc_id", "size", "text_crc32", "shard", (F.coalesce("before", F.lit(0)) + F.col("at")).cast("long").alias("slot"))
