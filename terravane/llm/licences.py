"""License scans: MinHash bands over overlapping windows, verified by exact shingle containment.

Texts and templates are lower-cased and cut into words of letters and digits,
and words into shingles of five. For each template size, windows of twice that
size, rounded up to a power of two, start every half window, so that each
occurrence lies within a window. A window's MinHash is the least value of its
shingle hashes under each of 64 exclusive-or masks, one mask a band of one row:
an occurrence with 0.8 of a template's shingles shares at least 0.19 of the
union, so that the chance of meeting in no band is below 2 in a million. A
window without any shingle of any template can meet none in any band and is not
hashed. Windows that meet a template are verified: the share of the template's
different shingles that they hold, exactly, must be 0.8 or more.

All of it is DataFrame functions; a text is searched within its own row, so no
text is shuffled. The templates are a bounded parameter and sent along.

Defined results: null, empty and short texts (under five words) have no matches;
a template under five words is refused; of several windows of a text that match
a template, the best is reported, the first of equals, with their number;
repeated rows give rows of their own; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import cut

SHINGLE = 5
CONTAINED = 0.8
BANDS = 64
#: Bound on the templates' shingles, which travel with the plan.
MOST_SHINGLES = 20_000

#: Notices by which texts are put under well-known licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def half_window(shingles: int) -> int:
    return 1 << (shingles - 1).bit_length()


def mask(band: int) -> int:
    """A band's exclusive-or mask: multiples of the golden ratio's 64 bits, as a signed long."""
    m = (band * 0x9E3779B97F4A7C15) % (1 << 64)
    return m - (1 << 64) if m >> 63 else m


def _shingles(words: Column) -> Column:
    """Hashes of a text's shingles, in order."""
    n = F.size(words) - (SHINGLE - 1)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))).otherwise(F.array().cast("array<bigint>"))


def _bands(hashes: Column) -> Column:
    return F.transform(F.array(*[F.lit(mask(b)) for b in range(BANDS)]), lambda m: F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(m))))


def template_table(spark, templates: dict[str, str]) -> list[tuple[str, int, list[int], list[int]]]:
    """(name, half window, different shingles, band values) of each template."""
    short = [k for k, v in templates.items() if len(words_of(v)) < SHINGLE]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {', '.join(short)}")
    rows = spark.createDataFrame([(k, words_of(v)) for k, v in sorted(templates.items())], "name string, words array<string>")
    hashes = F.array_distinct(_shingles(F.col("words")))
    found = rows.select("name", hashes.alias("hashes"), _bands(hashes).alias("bands")).collect()
    if sum(len(r["hashes"]) for r in found) > MOST_SHINGLES:
        raise ValueError(f"templates of more than {MOST_SHINGLES} shingles")
    return [(r["name"], half_window(len(r["hashes"])), r["hashes"], r["bands"]) for r in found]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, containment, first_word, windows: a row for each text and template that it holds. first_word: where the best window begins, in words from 0."""
    spark = docs.sparkSession
    table = template_table(spark, TEMPLATES if templates is None else templates)
    every = sorted({h for t in table for h in t[2]})
    known = F.array(*[F.lit(h) for h in every]).cast("array<bigint>")
    words = F.filter(F.split(F.lower(F.coalesce(docs[text_col], F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    hashes = cut(docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), words.alias("words")).select("row", "doc_id", _shingles(F.col("words")).alias("hashes")).where(F.arrays_overlap("hashes", known)), "shingles")
    out = []
    for half in sorted({t[1] for t in table}):
        starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("hashes") - 1), F.lit(half))
        windows = hashes.select("row", "doc_id", F.explode(F.transform(starts, lambda s: F.struct(s.alias("first"), F.slice("hashes", s + 1, F.lit(2 * half)).alias("hashes")))).alias("w")).select("row", "doc_id", "w.first", "w.hashes")
        hashed = windows.where(F.arrays_overlap("hashes", known)).select("*", _bands(F.col("hashes")).alias("bands"))
        own = spark.createDataFrame([(n, h, b) for n, x, h, b in table if x == half], "license string, template array<bigint>, t_bands array<bigint>")
        meet = F.broadcast(own.select("license", "template", F.posexplode("t_bands").alias("band", "value")))  # MOST_SHINGLES bounds the templates
        met = hashed.select("row", "doc_id", "first", "hashes", F.posexplode("bands").alias("band", "value")).join(meet, ["band", "value"]).groupBy("row", "doc_id", "first", "license").agg(F.first("hashes").alias("hashes"), F.first("template").alias("template"))
        out.append(met.select("row", "doc_id", "first", "license", (F.size(F.array_intersect("template", "hashes")) / F.size("template")).alias("containment")).where(F.col("containment") >= CONTAINED))
    found = out[0]
    for o in out[1:]:
        found = found.unionAll(o)
    best = F.max(F.struct(F.col("containment").alias("containment"), (-F.col("first")).alias("back")))
    return found.groupBy("row", "doc_id", "license").agg(best.alias("best"), F.count("*").alias("windows")).select("doc_id", "license", "best.containment", (-F.col("best.back")).cast("long").alias("first_word"), "windows")


def _sql_templates() -> str:
    rows = []
    for name, text in sorted(TEMPLATES.items()):
        w = words_of(text)
        s = list(dict.fromkeys(" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)))
        rows += [f"('{name}', {half_window(len(s))}, {len(s)}, '{x}')" for x in s]
    return ", ".join(rows)


ORACLE = rf"""
with t(license, half, n, s) as (values {_sql_templates()}),
d as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') as w from documents),
s as (select r, doc_id, unnest(range(0, len(w) - 4)) as i, w from d where len(w) >= 5),
h as (select r, doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') as s from s),
m as (select distinct r, doc_id, license, n, half, s, (i // half - k) * half as first from h join t using (s), (values (0), (1)) v(k) where i // half - k >= 0),
c as (select r, doc_id, license, first, count(*) / n as containment from m group by r, doc_id, license, n, first having count(*) / n >= 0.8)
select doc_id, license, max(containment) as containment, arg_max(first, (containment, -first)) as first_word, count(*) as windows from c group by r, doc_id, license
"""
