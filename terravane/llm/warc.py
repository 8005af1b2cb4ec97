"""WARC archives: written through Spark's committers, read back by boundary-chain verification.

Writing: each page becomes a record of WARC/1.0; of equal payloads the one with
the smallest page_id is a response and the others are revisits that refer to it.

Reading: archives are split at every occurrence of the version line, wherever it
stands, so tasks can read any part of any file. Each piece is a candidate
record: its header, if it has one, names its length and so its successor's
offset. Pointer jumping from the file's start keeps the candidates on the chain;
a version line inside a payload is never reached. A record's payload is what
lies between its header and its successor, over as many pieces as that takes.

Defined results: a null payload is empty; every record's payload_bytes and
payload_digest are those of the full payload, also for revisits; a payload may
hold version lines, whole records, and any other text; repeated page_ids give
records of their own; of rows of equal payload and smallest id one is the
response, that of the smallest url, and the others refer to its id; null ids come
last; an empty table gives no records; other columns are ignored. A file whose
chain breaks off raises an error, and so does a count of records read back that
differs from the pages written.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from terravane.llm.tables import cut, new_path

VERSION = "WARC/1.0\r\n"
#: Records of one archive file, which bounds what one task must link.
FILE_RECORDS = 5_000
ID = "urn:page:"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: ten hexadecimal digits are eight of base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", least: int = 0) -> DataFrame:
    """page_id, record: each page's whole record but for its last CRLF. Payloads under `least` bytes are never revisits."""
    url = F.coalesce(pages[url_col].cast("string"), F.lit("")) if url_col in pages.columns else F.lit("")
    data = pages.select(pages[id_col].alias("page_id"), url.alias("url"), F.coalesce(pages[payload_col], F.lit("")).alias("payload"))
    data = data.withColumn("key", F.sha2("payload", 256))
    per = data.groupBy("key", "page_id").agg(F.count("*").alias("n"))
    first = cut(per.groupBy("key").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "n")).alias("first"), F.sum("n").alias("n")).where("n > 1"), "copies")
    marked = data.join(first.select("key", "first"), "key", "left").withColumn("own", F.coalesce(F.col("page_id").eqNullSafe(F.col("first.page_id")), F.lit(False)))
    revisit = F.col("first").isNotNull() & ~F.col("own")
    if not first.where("first.n > 1").isEmpty():  # several rows of the smallest id, counted by url: one of them is the response
        tied = marked.where("own and first.n > 1").groupBy("key", "page_id", "url").agg(F.count("*").alias("n"), F.max("payload").alias("payload"), F.max("first").alias("first"))
        lead = tied.groupBy("key").agg(F.min("url").alias("lead"))
        spread = tied.join(lead, "key").select("page_id", "url", "payload", "first", "lead", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
        rows = marked.where("first is null or not own or first.n = 1").select("page_id", "url", "payload", "first", revisit.alias("again")).unionAll(
            spread.select("page_id", "url", "payload", "first", ((F.col("copy") > 1) | (F.col("url") != F.col("lead"))).alias("again"))
        )
    else:
        rows = marked.select("page_id", "url", "payload", "first", revisit.alias("again"))
    revisit = F.col("again") & (F.octet_length("payload") >= least)
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    name = lambda c: F.concat(F.lit(f"<{ID}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit(f"{VERSION}WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")),
        F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20]+", "%20"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), base32_sha1(F.col("payload").cast("binary")),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), name(F.col("first.page_id")), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return rows.select("page_id", F.concat(head, body, F.lit("\r\n")).alias("record"))


def write_archives(pages: DataFrame, path: str, **options) -> str:
    """Writes records of pages as WARC files under path: a text file's line end is a record's last CRLF."""
    records(pages, **options).select(F.col("record").alias("value")).write.option("lineSep", "\r\n").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    return path


def _chain(part: pd.DataFrame) -> pd.DataFrame:
    """Candidates of one file, in order; those that the chain from the file's start reaches, each with how many pieces it takes."""
    part = part.sort_values("at", kind="stable").reset_index(drop=True)
    offset = part["offset"].to_numpy(np.int64)
    end = int(part["end"].max())
    goal = part["successor"].to_numpy(np.int64)
    n = len(part)
    at = np.searchsorted(offset, goal)
    # n: the file's end; n + 1: nowhere
    hop = np.where(goal == end, n, np.where((at < n) & (offset[np.minimum(at, n - 1)] == goal) & (goal > offset), at, n + 1))
    hop = np.r_[hop, n, n + 1]
    reached = np.zeros(n + 2, bool)
    reached[0] = True
    while True:
        more = reached.copy()
        more[hop[reached]] = True
        if (more == reached).all():
            break
        reached, hop = more, hop[hop]
    if reached[n + 1] or not reached[n]:
        raise ValueError(f"the chain of records in {part['file'].iloc[0]} breaks off")
    keep = reached[:n]
    start = np.cumsum(keep) - 1
    return pd.DataFrame({"file": part["file"], "at": part["at"], "record": part["at"].to_numpy()[keep][start]})


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Pieces of archives between version lines: file, value, and block and seq, which order a file's pieces within this scan. Another scan may split files elsewhere: what joins scans is a piece's place in its file, never these."""
    return spark.read.option("lineSep", VERSION).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), F.col("value"))


def _header(value: Column) -> Column:
    return F.concat(F.lit("\r\n"), F.substring_index(value, "\r\n\r\n", 1), F.lit("\r\n"))


def _record(value: Column) -> dict[str, Column]:
    """The fields of a whole record's text, and its payload."""
    head = _header(value)
    field = lambda name: F.regexp_extract(head, rf"(?i)\r\n{name}: *([^\r]*)\r\n", 1)
    number = lambda name: F.nullif(F.regexp_extract(field(name), f"<{ID}(-?[0-9]{{1,19}})>", 1), F.lit("")).try_cast("long")
    payload = F.substring(value.cast("binary"), F.octet_length(head) + 1, field("Content-Length").try_cast("int"))
    return {"page_id": number("WARC-Record-ID"), "record_type": field("WARC-Type"), "refers_to": number("WARC-Refers-To"), "digest": F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", ""), "payload": payload}


def _digested(fields: dict[str, Column]) -> list[Column]:
    return [fields[c].alias(c) for c in ("page_id", "record_type", "refers_to", "digest")] + [F.octet_length(fields["payload"]).cast("long").alias("payload_bytes"), base32_sha1(fields["payload"]).alias("payload_digest")]


def chain(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Pieces on the boundary chains (file, at: the piece's place in its file, record: the first piece's at), and the digests of pieces that are whole records, by file and at.

    Only sizes, offsets and digests leave the scan, never payloads.
    """
    header = F.substring_index("value", "\r\n\r\n", 1)
    length = F.regexp_extract(header, r"(?i)(?:^|\r\n)Content-Length: *([0-9]{1,18})(?:\r\n|$)", 1)
    valid = (length != "") & F.col("value").contains("\r\n\r\n") & F.col("value").startswith("WARC-Type: ")
    size = F.octet_length("value").cast("long")
    span = F.when(valid, F.octet_length(header) + 4 + length.cast("long") + 4 + len(VERSION))
    own = F.when(span == size + len(VERSION), F.struct(*_digested(_record(F.col("value")))))
    pieces = cut(_lines(spark, path).select("file", "block", "seq", size.alias("size"), span.alias("span"), own.alias("own")), "pieces")
    # byte offsets within a file: each piece takes its own bytes and the version line before it; a file starts with an empty piece
    w = Window.partitionBy("file").orderBy("block", "seq")
    before = F.sum(F.col("size") + len(VERSION)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size") - 2 * len(VERSION)
    placed = cut(pieces.select("file", F.row_number().over(w).alias("at"), "size", "span", before.alias("offset"), "own").where("at > 1"), "placed")
    found = placed.select("file", "at", "offset", F.coalesce(F.col("offset") + F.col("span"), F.lit(-1)).alias("successor"), (F.col("offset") + F.col("size") + len(VERSION)).alias("end"))
    chained = found.groupBy("file").applyInPandas(_chain, "file string, at int, record int")
    return cut(chained, "chain"), placed.where("own is not null").select("file", "at", "own")


def _pieced(spark: SparkSession, path: str, links: DataFrame, every: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Places of records of one piece, and the text of those of several, if there are any. every: the text of all records, in place of both."""
    parts = links if every else cut(links.join(links.groupBy("file", "record").agg(F.count("*").alias("n")).where("n > 1").select("file", "record"), ["file", "record"], "left_semi"), "parts")
    single = None if every else links.where("at = record")
    if not every:
        if parts.isEmpty():
            return single.select("file", "at"), None
        single = single.join(parts.select("file", "record").distinct(), ["file", "record"], "left_anti").select("file", "at")
    # a second scan, of the files that hold such records: its pieces are placed anew, as it may split files elsewhere
    lines = _lines(spark, path)
    lines = lines if every else lines.join(parts.select("file").distinct(), "file", "left_semi")
    placed = lines.select("file", F.row_number().over(Window.partitionBy("file").orderBy("block", "seq")).alias("at"), "value")
    rows = placed.join(parts, ["file", "at"])
    return single, rows.groupBy("file", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), VERSION).alias("value"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, digest and payload of every record in the WARC files under path."""
    links, _ = chain(spark, path)
    _, whole = _pieced(spark, path, links, every=True)
    return whole.select(*[c.alias(n) for n, c in _record(F.col("value")).items()])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Like read_archives, with payload_bytes and payload_digest for the payload: only files with records of several pieces move their text."""
    links, own = chain(spark, path)
    single, whole = _pieced(spark, path, links)
    out = own.join(single, ["file", "at"]).select("own.*")
    return out.unionAll(whole.select(*_digested(_record(F.col("value"))))) if whole is not None else out


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes pages as archives, reads them back, and gives a row for each record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = write_archives(pages, path or new_path(spark, "warc"), **options)
    back = cut(read_digests(spark, path), "records")
    if (read := back.count()) != (wrote := pages.count()):
        raise ValueError(f"{wrote} pages were written, {read} records read back")
    full = back.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full_bytes"), F.col("payload_digest").alias("full_digest")).dropDuplicates(["refers_to"])
    wrong = back.where("record_type = 'response' and digest <> payload_digest")
    if not wrong.isEmpty():
        raise ValueError("a payload read back differs from its digest")
    response = back.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    revisit = back.where("record_type = 'revisit'").join(full, "refers_to", "left").select("page_id", F.col("full_bytes").alias("payload_bytes"), F.coalesce("full_digest", "digest").alias("payload_digest"), "record_type", "refers_to")
    return response.unionAll(revisit)


ORACLE = r"""
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, h, sha1(h) as x, min(page_id) over (partition by h) as f from p)
select page_id, cast(strlen(h) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(x, cast(k // 4 * 5 + 1 as int), 5))::int >> cast(15 - k % 4 * 5 as int)) & 31), 1)), '') as payload_digest,
  case when f = page_id then 'response' else 'revisit' end as record_type, case when f <> page_id then f end as refers_to
from q
"""
