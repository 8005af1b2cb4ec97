"""Exact dedup by deterministic block naming, in DataFrame operations only.

Each normalised text is cut into blocks of a fixed number of bytes. Blocks are
sorted within buckets, and a block's name is an integer made of its rank and its
bucket, so that equal blocks and no others share a name. Then names of
neighbours are paired, the pairs sorted and named in the same way, and so on,
until each text has one name: two texts of as many blocks are equal if and only
if they have the same name. Nothing rests on a hash being free of collisions:
hashes only deal out the work and stand for a block where the sorted table
shows that no other block has the same hash.

Skew: equal blocks are merged before they are shuffled, whatever their number,
and names go back to their places by joins, which Spark splits where a key is
hot. No text, and no list of a group's rows, is ever gathered.

Defined results: a null text counts as empty and so equals an empty one; texts
are equal if they are identical after each run of ASCII white space is replaced
by one space; of equal texts the row with the smallest id stays; rows that
repeat an id are told apart only by their texts; null ids come last in the
order; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from terravane.llm.tables import cut

BLOCK = 4096
#: Names that one bucket sorts.
BUCKET_ROWS = 20_000
#: Groups of equal texts that are sent to all tasks, at most.
HOT = 5_000


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; only runs that aren't so already are rewritten."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def _ranked(distinct: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """distinct with name: rank within a bucket times the number of buckets, plus the bucket, plus 1."""
    w = Window.partitionBy("bucket").orderBy(*keys)
    return distinct.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))).withColumn("name", (F.row_number().over(w).cast("long") - 1) * buckets + F.col("bucket") + 1)


def _blocks(texts: DataFrame, block: int) -> DataFrame:
    """texts with blocks: an array of binaries; an empty text has one empty block."""
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block)).cast("int")
    return texts.select("*", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("text").cast("binary"), i * block + 1, F.lit(block))).alias("blocks"))


def name_blocks(texts: DataFrame, block: int = BLOCK) -> DataFrame:
    """block_hash, name, bytes of each different block; bytes only where another block has the same hash."""
    # the hash goes first: it deals out the blocks and decides nearly every comparison
    found = _blocks(texts.select("text"), block).select(F.explode("blocks").alias("bytes")).select(F.xxhash64("bytes").alias("block_hash"), "bytes").distinct()
    rough = texts.agg(F.sum(F.ceil(F.octet_length("text") / block) + 1)).first()[0] or 0
    buckets = max(1, -(-rough // BUCKET_ROWS))
    keys = ["block_hash", "bytes"]
    w = Window.partitionBy("bucket").orderBy(*keys)
    named = found.withColumn("bucket", F.pmod("block_hash", F.lit(buckets))).select(
        "block_hash", "bytes", ((F.row_number().over(w).cast("long") - 1) * buckets + F.col("bucket") + 1).alias("name"), (F.coalesce(F.lag("block_hash").over(w) == F.col("block_hash"), F.lit(False)) | F.coalesce(F.lead("block_hash").over(w) == F.col("block_hash"), F.lit(False))).alias("shared")
    )
    return cut(named.select("block_hash", "name", F.when(F.col("shared"), F.col("bytes")).alias("bytes")), "block-names")


def text_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """row, doc_id, text_sha256, blocks, name: (blocks, name) is the collision-free identity of each row's text.

    row numbers the rows, so that repeated ids stay apart. Rounds of pairing
    need about log2 of the longest text's blocks; a text leaves them as soon as
    it has one name.
    """
    texts = docs.select(docs[id_col].alias("doc_id"), normalised(docs[text_col]).alias("text"))
    names = name_blocks(texts, block)
    rows = cut(
        _blocks(texts, block).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"), F.transform("blocks", lambda b: F.xxhash64(b)).alias("hashes"), F.when(F.lit(False), F.col("blocks")).alias("bytes")),
        "block-hashes",
    )
    if not names.where("bytes is not null").isEmpty():  # then each block's own bytes decide
        rows = cut(_blocks(texts, block).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2("text", 256).alias("text_sha256"), F.transform("blocks", lambda b: F.xxhash64(b)).alias("hashes"), F.col("blocks").alias("bytes")), "block-hashes")
        places = rows.select("row", F.size("hashes").alias("blocks"), F.posexplode(F.arrays_zip("hashes", "bytes")).alias("at", "b")).select("row", "blocks", "at", F.col("b.hashes").alias("block_hash"), F.col("b.bytes").alias("own"))
        named = places.join(names, (places["block_hash"] == names["block_hash"]) & (names["bytes"].isNull() | (names["bytes"] == places["own"])))
    else:
        places = rows.select("row", F.size("hashes").alias("blocks"), F.posexplode("hashes").alias("at", "block_hash"))
        named = places.join(names, "block_hash")
    level = cut(named.select("row", "blocks", "at", "name"), "names")
    done = [level.where("blocks = 1").select("row", "blocks", "name")]
    longest = rows.agg(F.max(F.size("hashes"))).first()[0] or 1
    todo, width = level.where("blocks > 1"), 1
    while width < longest:
        pairs = cut(
            todo.groupBy("row", "blocks", F.floor(F.col("at") / 2).cast("int").alias("at")).agg(F.max(F.when(F.col("at") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("at") % 2 == 1, F.col("name"))), F.lit(0)).alias("b")),
            "pairs",
        )
        buckets = max(1, -(-pairs.count() // BUCKET_ROWS))
        level = cut(pairs.join(_ranked(pairs.select("a", "b").distinct(), ["a", "b"], buckets).select("a", "b", "name"), ["a", "b"]).select("row", "blocks", "at", "name"), "names")
        width *= 2
        done.append(level.where(F.col("blocks") <= width).select("row", "blocks", "name"))
        todo = level.where(F.col("blocks") > width)
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return rows.select("row", "doc_id", "text_sha256").join(out, "row")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """A row for each row of docs: doc_id, keep_id, group_size, kept, text_sha256. Of rows of one text and one id, one is kept."""
    named = cut(text_names(docs, id_col, text_col, block), "text-names")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row")))
    groups = cut(named.groupBy("blocks", "name").agg(first.alias("first"), F.count("*").alias("group_size")), "groups")
    # groups of over one in HOT of all rows are fewer than HOT: they are sent to the rows, so that none of them meets in one task
    total = groups.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0]
    hot = groups.where(F.col("group_size") > total // HOT).select("blocks", "name", F.struct("first", "group_size").alias("hot"))
    met = named.join(F.broadcast(hot), ["blocks", "name"], "left")
    rest = met.where("hot is null").drop("hot").join(groups.where(F.col("group_size") <= total // HOT), ["blocks", "name"])
    out = met.where("hot is not null").select("doc_id", "row", "text_sha256", "hot.first", "hot.group_size").unionAll(rest.select("doc_id", "row", "text_sha256", "first", "group_size"))
    return out.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows of which an equal text with a smaller id stays; all columns are kept.

    Ids are what names a row here: should an id be repeated or null, its rows
    are kept or dropped by (id, text), one of each.
    """
    kept = exact_groups(docs, id_col, text_col).where("kept").select("doc_id", "text_sha256")
    marked = docs.select(F.struct("*").alias("row"), docs[id_col].alias("id"), F.sha2(normalised(docs[text_col]), 256).alias("sha"))
    out = marked.join(kept, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256")), "left_semi")
    repeated = not docs.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return (out.dropDuplicates(["id", "sha"]) if repeated else out).select("row.*")


ORACLE = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from t
"""
