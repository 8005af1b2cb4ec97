"""SimHash near-dedup: fingerprints of word shingles, linked by tiled exact comparison.

Different fingerprints are compared, never rows. Two of them within the radius
agree on all bits of enough segments of the 64, so they meet under at least one
key made of segments; under each key all pairs are compared exactly, tile by
tile, with exclusive-or and bit counts in numpy. A key with more fingerprints
than a tile holds is cut into tiles by bit count and salt; of their pairs, those
whose bit counts differ beyond the radius are never made, and the rest are
dealt out as tasks of their own. A task reports no pairs but a spanning forest
of the links it saw. Links are joined into components by rounds of large-star
and small-star steps. How many segments there are follows from the number of
fingerprints and changes the work only, not the result.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; fewer words than a shingle give
one shingle of them all; equal fingerprints are always linked; repeated rows
have the same fingerprint and component; rows with a null id take part but can't
name a component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.media import slices
from terravane.llm.tables import LOWER, cut

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of a tile.
TILE = 4096
#: Fingerprints that should share a key, on average, at most.
KEY_ROWS = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text's shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxh64_intdigest(b" ".join(words[i : i + shingle]), seed) for i in range(n)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        ones += np.unpackbits(hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, fp: each row's fingerprint, as a signed long of the same bits."""
    data = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in slices(batch, 8 << 20):
                fps = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64)
                yield pa.record_batch([ids, pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return data.mapInArrow(run, f"doc_id {data.schema['doc_id'].dataType.simpleString()}, fp long")


def segments(n: int, radius: int = RADIUS, key_rows: int = KEY_ROWS) -> tuple[int, int]:
    """Into how many segments to cut the 64 bits, and how many form a key: the fewest keys whose width leaves key_rows fingerprints or fewer to a key, were bits even."""
    for parts in range(radius + 1, 2 * radius + 6):
        if n >> (64 * (parts - radius) // parts) <= key_rows:
            break
    return parts, parts - radius


def keys_of(fp: Column, radius: int, parts: int) -> Column:
    """An array of (number of the combination, its bits)."""
    edges = [round(64 * k / parts) for k in range(parts + 1)]
    masks = []
    for chosen in combinations(range(parts), parts - radius):
        mask = sum(((1 << edges[k + 1]) - (1 << edges[k])) for k in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.struct(F.lit(i).alias("combination"), fp.bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(masks)])


def forest(fps: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (left, right), both positions in fps: each linked position with its tree's root."""
    root = np.arange(len(fps))
    while True:
        a, b = root[left], root[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(fps)))
    return child, root[child]


def links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs of a and b, both sorted by bit count, that differ in radius bits or fewer."""
    ca, cb = np.bitwise_count(a).astype(np.int64), np.bitwise_count(b).astype(np.int64)
    found_a, found_b = [], []
    step = 256
    for i in range(0, len(a), step):
        low, high = np.searchsorted(cb, ca[i] - radius), np.searchsorted(cb, ca[min(i + step, len(a)) - 1] + radius, side="right")
        low = max(low, i) if same else low
        if low >= high:
            continue
        near = np.bitwise_count(a[i : i + step, None] ^ b[None, low:high]) <= radius
        x, y = np.nonzero(near)
        x, y = x + i, y + low
        if same:
            x, y = x[x < y], y[x < y]
        found_a.append(x)
        found_b.append(y)
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (np.empty(0, np.int64), np.empty(0, np.int64))


def _compare(radius: int):
    """Compares the tiles of one or more cells. Rows come sorted by cell; a cell's rows have side 0, 1, or, where a tile meets itself, all 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []

        def cells(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
            cell = frame["cell"].to_numpy()
            fps, side = frame["fp"].to_numpy().view(np.uint64), frame["side"].to_numpy()
            starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            ends = np.r_[starts[1:], len(cell)]
            out_a, out_b = [], []
            for s, e in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
                f, d = fps[s:e], side[s:e]
                order = np.lexsort((f, np.bitwise_count(f), d))
                f, d = f[order], d[order]
                n = int(np.searchsorted(d, 1))
                x, y = links(f, f, radius, True) if n == len(f) else links(f[:n], f[n:], radius, False)
                if not len(x):
                    continue
                child, root = forest(f, x, y if n == len(f) else y + n)
                out_a.append(f[child])
                out_b.append(f[root])
            if out_a:
                yield pa.record_batch([pa.array(np.concatenate(out_a).view(np.int64)), pa.array(np.concatenate(out_b).view(np.int64))], ["a", "b"])

        for batch in batches:
            frame = batch.to_pandas()
            held.append(frame)
            if sum(map(len, held)) < 8 * TILE:
                continue
            frame = pd.concat(held, ignore_index=True)
            last = frame["cell"].iloc[-1]
            cut_at = int((frame["cell"] != last).to_numpy().nonzero()[0][-1]) + 1 if (frame["cell"] != last).any() else 0
            yield from cells(frame.iloc[:cut_at]) if cut_at else ()
            held = [frame.iloc[cut_at:]]
        if held:
            frame = pd.concat(held, ignore_index=True)
            if len(frame):
                yield from cells(frame)

    return run


def link_forest(fps: DataFrame, n: int, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """a, b: links between different fingerprints of fps (a column fp, without repeats) that connect all those within the radius, directly or through others."""
    parts, _ = segments(n, radius)
    keyed = fps.select("fp", F.explode(keys_of(F.col("fp"), radius, parts)).alias("key")).select("fp", "key.combination", "key.bits", F.bit_count("fp").alias("ones"))
    keyed = cut(keyed, "keyed")
    sizes = keyed.groupBy("combination", "bits", "ones").agg(F.count("*").alias("n"))
    large = cut(
        sizes.groupBy("combination", "bits").agg(F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct("ones", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))).alias("tiles")).where(F.col("total") > tile).select("combination", "bits", "tiles"),
        "large-keys",
    )
    small = keyed.join(large, ["combination", "bits"], "left_anti").select("fp", F.shiftleft(F.xxhash64("combination", "bits"), 2).alias("cell"), F.lit(0).alias("side"))
    # in a large key: a tile is (bit count, salt); it meets itself, and every later tile whose bit count is near enough
    member = keyed.join(large, ["combination", "bits"]).withColumn("salt", F.pmod(F.xxhash64("fp"), F.col("tiles")[F.col("ones")]).cast("int"))
    others = F.flatten(
        F.transform(
            F.filter(F.map_keys("tiles"), lambda o: F.abs(o - F.col("ones")) <= radius),
            lambda o: F.transform(F.sequence(F.lit(0), F.col("tiles")[o] - 1), lambda s: F.struct(o.alias("ones"), s.alias("salt"))),
        )
    )
    mine = F.struct(F.col("ones"), F.col("salt"))
    dealt = member.select("fp", "combination", "bits", mine.alias("mine"), F.explode(others).alias("other")).select(
        "fp",
        # the last two bits tell apart small keys, tiles that meet themselves, and tiles that meet others: should hashes collide, cells of one sort merge, and every pair is still compared
        F.shiftleft(F.xxhash64("combination", "bits", F.least("mine", "other"), F.greatest("mine", "other")), 2).bitwiseOR(F.when(F.col("mine") == F.col("other"), 1).otherwise(2).cast("long")).alias("cell"),
        F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"),
    )
    return small.unionAll(dealt).repartition("cell").sortWithinPartitions("cell").mapInArrow(_compare(radius), "a long, b long").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node, root: each node of the links (a, b) with the least node it is connected to, by turns of large-star and small-star steps until nothing changes."""
    links_ = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    for _ in range(most):
        both = links_.unionAll(links_.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        links_ = cut(small, "small-star")
        now = links_.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return links_.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
    raise RuntimeError("components did not settle")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """A row for each row of docs: doc_id, fingerprint (16 hex digits), component_id (the least id reachable by links)."""
    printed = cut(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = cut(printed.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    tree = components(link_forest(nodes.select("fp"), nodes.count(), radius))
    placed = cut(nodes.join(tree, nodes["fp"] == tree["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "placed")
    # rows of one fingerprint were merged above, so that a root has a row for each different fingerprint at most, and these are merged before the shuffle
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = placed.join(least, "root").select("fp", "component_id")
    return printed.join(by_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """docs with one row of each group, that of the smallest id, and of the smallest text hash where ids are equal; null ids come last. Rows alike in id and text are one."""
    # the id's place among all: null ids last, and equal ids told apart by their texts
    key = F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), F.sha2(F.coalesce(docs[text_col].cast("binary"), F.lit("").cast("binary")), 256).alias("sha"))
    marked = docs.select(F.struct("*").alias("row"), key.alias("key"), docs[text_col].alias("text"))
    groups = near_groups(marked, "key", "text", radius)
    keep = cut(groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id.id").alias("id"), F.col("doc_id.sha").alias("sha")).agg(F.count("*").alias("n")), "kept")
    out = marked.select("row", "key").join(keep, F.col("key.id").eqNullSafe(keep["id"]) & (F.col("key.sha") == keep["sha"]), "left_semi")
    if not keep.where("n > 1").isEmpty():
        out = out.dropDuplicates(["key"])
    return out.select("row.*")
