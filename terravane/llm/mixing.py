"""Mixing sources to target weights with exact block quotas and a multivariate-hypergeometric splitting tree.

Each source's target follows from its weight, capped at a multiple of its size.
A source gives whole copies of itself and, for the rest of its target, a prefix
of its rows in a pseudo-random order; the row where the prefix ends is found
exactly by narrowing down the order's value in steps of 1024, each a small
aggregate. What the prefix leaves, as its next row is too large, is filled in
the same way from the smaller rows behind it, again and again until no row fits.
A source's rows fall into blocks by the order's leading bits, and
the number of blocks that each source gives is its quota. The quotas are split
among output shards by halving the shards again and again: how many blocks of
each source go left is drawn from the multivariate hypergeometric law, so that
all quotas hold exactly. A source's permuted blocks are then dealt to the shards
by their quotas, disjointly; a row is taken as often as a shard drew its block,
and each shard shuffles its rows locally.

The driver handles a row for each source and block, not for each document, and
refuses more than MOST_SOURCES sources.

Defined results: a null text has size 0; a null source is a source of its own,
last in the order; rows alike in id and text are drawn together; an empty table
gives an empty mix; the result depends on the rows and the seed, not on how
they are stored; other columns pass through `mix` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import cut

WEIGHTS = (5, 2, 1)
CAP = 3
SHARDS = 8
SEED = 17
#: A block is the rows of a source that agree in so many leading bits of their order.
BLOCK_BITS = 7
STEP_BITS = 10
#: The driver holds 2 ** STEP_BITS numbers a source, so that it refuses more sources than these.
MOST_SOURCES = 10_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null, in the sources' order by code point with null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def order_of(doc_id: Column, text: Column, seed: int) -> Column:
    """63 pseudo-random bits of a row."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.xxhash64(text), F.lit(seed)), 1)


def targets(sizes: list[int], weights: tuple = WEIGHTS, cap: float = CAP) -> list[float]:
    """Each source's share of all sizes by weight; shares above cap sizes stop there, and the excess is shared anew by weight."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target, fixed = [0.0] * len(sizes), [s == 0 for s in sizes]
    left = float(sum(sizes))
    while not all(fixed):
        total = sum(w for w, f in zip(weight, fixed, strict=True) if not f)
        over = [i for i, f in enumerate(fixed) if not f and left * weight[i] / total > cap * sizes[i]]
        if not over:
            for i, f in enumerate(fixed):
                if not f:
                    target[i] = left * weight[i] / total
            break
        for i in over:
            target[i], fixed[i] = float(cap * sizes[i]), True
        left = sum(sizes) - sum(t for t, f in zip(target, fixed, strict=True) if f)
    return target


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): each source's quota dealt out exactly by halving the shards, with multivariate hypergeometric draws."""
    if shards == 1:
        return quotas[None, :]
    left = shards // 2
    total = int(quotas.sum())
    draw = rng.multivariate_hypergeometric(quotas, total * left // shards, method="marginals") if total else quotas
    return np.concatenate([split_quotas(draw, left, rng), split_quotas(quotas - draw, shards - left, rng)])


def deal(items: list[tuple], shares: np.ndarray) -> dict[tuple, int]:
    """The shard that draws each item: the first so many permuted items go to shard 0, the next to shard 1, and so on."""
    return dict(zip(items, np.repeat(np.arange(len(shares)), shares).tolist(), strict=True))


@dataclass
class Mix:
    """What the mix takes: by source, and by source and block."""

    sources: DataFrame  # key, source_size, target, whole, drawn: the rows of one more copy, as ranges of the order with a bound on the size
    blocks: DataFrame  # key, block, shards of the block's whole copies, last: the shard of the rows that one more copy takes, if any
    seed: int


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, cap: int = CAP, shards: int = SHARDS, seed: int = SEED) -> Mix:
    spark = docs.sparkSession
    base = cut(docs.select(source_key(docs[source_col]).alias("key"), words(docs[text_col]).alias("size"), order_of(docs[id_col], docs[text_col], seed).alias("order")), "sizes")

    def level(among: DataFrame, bits: int) -> dict[str, list[tuple[int, int, int]]]:
        """Rows and sizes by source and leading bits of the order: at most 2 ** STEP_BITS rows a source."""
        found: dict[str, list[tuple[int, int, int]]] = {}
        for r in among.groupBy("key", F.shiftright("order", bits).alias("part")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
            found.setdefault(r["key"], []).append((r["part"], r["size"], r["n"]))
        return {k: sorted(v) for k, v in found.items()}

    def prefixes(rows: DataFrame, rest: dict[str, float], parts: dict | None = None) -> dict[str, int]:
        """Where each source's longest prefix of rows ends that is no larger than the rest of its target; rest is lowered by it."""
        bits, until = 63 - STEP_BITS, {}
        parts = level(rows, bits) if parts is None else parts
        while parts:
            open_: list[tuple[str, int]] = []
            for k, found in parts.items():
                until.setdefault(k, 0)
                for part, size, n in found:
                    if size > rest[k]:
                        if n > 1 and bits > 0:
                            open_.append((k, part))
                        break
                    rest[k] -= size
                    until[k] = min((part + 1) << bits, (1 << 63) - 1)
            if not open_:
                break
            edge = spark.createDataFrame(open_, "key string, part long")  # a row for each source at most
            down = min(STEP_BITS, bits)
            parts = level(rows.join(F.broadcast(edge), "key").where(F.shiftright("order", bits) == F.col("part")).select("key", "size", "order"), bits - down)
            bits -= down
        return until

    if (n := base.select("key").distinct().count()) > MOST_SOURCES:
        raise ValueError(f"{n} sources; the driver plans for {MOST_SOURCES} at most")
    parts = level(base, 63 - STEP_BITS)
    keys = sorted(parts)
    sizes = [sum(p[1] for p in parts[k]) for k in keys]
    target = targets(sizes, weights, cap)
    whole = [int(t // s) if s else 0 for t, s in zip(target, sizes, strict=True)]
    rest = {k: t - w * s for k, t, w, s in zip(keys, target, whole, sizes, strict=True)}
    blocks = {k: sorted({p[0] >> (STEP_BITS - BLOCK_BITS) for p in parts[k]}) for k in keys}
    until = prefixes(base, rest, parts)
    drawn = {k: [(0, u, 1 << 62)] for k, u in until.items() if u}
    begins = {k: until.get(k, 0) for k in keys}
    while gaps := [(k, b, int(rest[k])) for k, b in begins.items() if rest[k] >= 1]:  # the row after a prefix was too large: smaller ones behind it fill what is left, until none fits
        fill = base.join(F.broadcast(spark.createDataFrame(gaps, "key string, begin long, most long")), "key").where("order >= begin and size <= most and size > 0").select("key", "size", "order")
        more = prefixes(fill, rest)
        stuck = [k for k, b, _ in gaps if k in more and more[k] <= b]  # rows drawn together that fit singly, but not all of them
        past = {r["key"]: r["order"] + 1 for r in fill.where(F.col("key").isin(stuck)).groupBy("key").agg(F.min("order").alias("order")).collect()} if stuck else {}
        begins = past
        for k, begin, most in gaps:
            if more.get(k, 0) > begin:
                drawn.setdefault(k, []).append((begin, more[k], most))
                begins[k] = until[k] = more[k]
    rng = np.random.default_rng(seed)
    items = {k: [(c, b) for c in range(w) for b in blocks[k]] + [(w, b) for b in blocks[k] if b << (63 - BLOCK_BITS) < until.get(k, 0)] for k, w in zip(keys, whole, strict=True)}
    shares = split_quotas(np.array([len(items[k]) for k in keys], np.int64), shards, rng) if keys else np.zeros((shards, 0), np.int64)
    rows = []
    for i, k in enumerate(keys):
        dealt = deal([items[k][j] for j in rng.permutation(len(items[k]))], shares[:, i])
        rows += [(k, b, [dealt[c, b] for c in range(whole[i]) if (c, b) in dealt], dealt.get((whole[i], b))) for b in blocks[k]]
    return Mix(
        spark.createDataFrame([(k, s, t, w, drawn.get(k, [])) for k, s, t, w in zip(keys, sizes, target, whole, strict=True)], "key string, source_size long, target double, whole int, drawn array<struct<begin: long, until: long, most: long>>"),
        spark.createDataFrame(rows, "key string, block long, shards array<int>, last int"),
        seed,
    )


def counted(docs: DataFrame, plan: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """row: docs' columns; mix: size, source_size, target, copies, order and the shards of the copies. A row is taken as often as its block was dealt to a shard. Both joined tables have at most 2 ** BLOCK_BITS rows a source, of MOST_SOURCES at most."""
    own = F.struct(source_key(docs[source_col]).alias("key"), words(docs[text_col]).alias("size"), order_of(docs[id_col], docs[text_col], plan.seed).alias("order"))
    data = docs.select(F.struct("*").alias("row"), own.alias("own"))
    per = plan.sources.select("key", F.struct("source_size", "target", "whole", "drawn").alias("source"))
    block = plan.blocks.select("key", "block", "shards", "last")
    out = data.join(F.broadcast(per), F.col("own.key") == per["key"]).drop("key").join(F.broadcast(block), (F.col("own.key") == block["key"]) & (F.shiftright(F.col("own.order"), 63 - BLOCK_BITS) == F.col("block")))
    once_more = F.exists("source.drawn", lambda d: (F.col("own.order") >= d["begin"]) & (F.col("own.order") < d["until"]) & (F.col("own.size") <= d["most"])) & F.col("last").isNotNull()
    shards = F.concat("shards", F.when(once_more, F.array("last")).otherwise(F.array().cast("array<int>")))
    return out.select("row", F.struct("own.size", "own.order", "source.source_size", "source.target", F.size(shards).alias("copies"), shards.alias("shards")).alias("mix"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shuffled: bool = True, **options) -> DataFrame:
    """docs' columns, a row for each copy taken. shuffled: dealt to the shards' partitions and shuffled in each."""
    plan = plan_mix(docs, id_col, text_col, source_col, **options)
    rows = counted(docs, plan, id_col, text_col, source_col).select("row", F.posexplode("mix.shards").alias("copy", "shard"))
    if not shuffled:
        return rows.select("row.*")
    # a shard may be larger than a task: each is dealt over several partitions, whose rows are shuffled there
    salt = F.xxhash64(F.col("row")[id_col], "copy", F.lit(plan.seed))
    return rows.withColumn("salt", salt).repartition("shard", F.pmod("salt", F.lit(64))).sortWithinPartitions("shard", "salt").select("row.*")
