"""Each operator against a brute-force version, on a fixture of hard rows, and on empty tables."""

import base64
import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from terravane.llm import exact, licences, media, mixing, neardup, packing, quality, scoring, sharding, warc

LOW = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words(t):
    return (t or "").encode().translate(LOW).split()


DEAL = mixing.deal


def by_row(df):
    return collections.Counter(tuple(r) for r in df.collect())


# media -----------------------------------------------------------------------------------------------


def test_media_round_trip(docs, rows):
    got = media.read_media(media.store_texts(docs), payload=True).collect()
    assert len(got) == len(rows)
    want = collections.Counter((r[0], (r[1] or "").encode()) for r in rows)
    seen = collections.Counter()
    for r in got:
        p = bytes(r.payload)
        assert r.payload_bytes == len(p) and r.payload_bytes % 192 == 0 and r.payload_bytes > 0
        assert r.payload_sha256 == hashlib.sha256(p).hexdigest() and r.tail_crc32 == zlib.crc32(p[-16:])
        assert p[r.n_bytes :] == b" " * (len(p) - r.n_bytes) and len(p) - r.n_bytes < 192 + (r.n_bytes == 0)
        seen[r.doc_id, p[: r.n_bytes]] += 1
    assert seen == want


def test_media_empty_table(empty):
    assert media.read_media(media.store_texts(empty)).count() == 0


@pytest.mark.parametrize("n", [192, 192 * 3, 192 * 8191 + 192, 192 * 20000])
def test_media_sizes(n):
    p = np.random.default_rng(n).integers(0, 256, n).astype(np.uint8).tobytes()
    (m,) = media.encode_payloads([p])
    assert b"".join(g.tobytes() for g in media.decode_media([m])[0]) == p


def test_reader_takes_colour_pictures_with_ac_and_no_restarts():
    """A hand-made 16 x 16 picture of three parts, 2 x 2 samples of brightness, with AC coefficients."""
    bits = ""
    put = lambda table, symbol: next(format(c, f"0{n}b") for s, c, n in media.canonical(*table) if s == symbol)
    dc, ac = (media.DC_COUNTS, media.DC_SYMBOLS), (bytes([0, 3] + [0] * 14), bytes([0x00, 0x01, 0xF0]))

    def block(diff, with_ac):
        size = abs(diff).bit_length()
        out = put(dc, size) + (format(diff if diff > 0 else diff + (1 << size) - 1, f"0{size}b") if size else "")
        return out + (put(ac, 0x01) + "1" + put(ac, 0xF0) + put(ac, 0x01) + "0" if with_ac else "") + put(ac, 0x00)

    for i, d in enumerate((5, -3, 0, 7)):
        bits += block(d, i % 2 == 0)
    bits += block(2, True) + block(-1, False)
    bits += "1" * (-len(bits) % 8)
    scan = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    seg = media._segment
    pic = b"\xff\xd8" + seg(0xE0, b"JFIF") + seg(0xDB, bytes([0, 16] + [1] * 63)) + seg(0xC0, struct.pack(">BHHB", 8, 16, 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))
    pic += seg(0xC4, bytes([0]) + dc[0] + dc[1]) + seg(0xC4, bytes([0x10]) + ac[0] + ac[1]) + seg(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])) + scan + b"\xff\xd9"
    ((grid,),) = media.decode_media([pic])
    assert grid.tolist() == [[128 + 10, 128 + 4], [128 + 4, 128 + 18]]


def test_media_refuses_damage():
    (m,) = media.encode_payloads([b"x" * 192 * 4])
    for bad in (m[:-30] + b"\xff\xd9", b"junk" + m, m.replace(b"\xff\xc0", b"\xff\xc2")):
        with pytest.raises(ValueError):
            media.decode_media([bad])


# exact dedup -----------------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [700, 4096])
def test_exact_groups(docs, rows, block):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = collections.defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    got = exact.exact_groups(docs, block=block).collect()
    assert len(got) == len(rows)
    kept = collections.Counter()
    for r in got:
        t = next(k for k in groups if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        assert (r.keep_id, r.group_size) == (min(groups[t]), len(groups[t])) and (not r.kept or r.doc_id == r.keep_id)
        kept[t] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_when_hashes_collide(docs, rows, monkeypatch):
    """Names come from the sorted blocks, whatever the hash does."""
    real = F.xxhash64
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: real(*c) % 3 if len(c) == 1 else real(*c))
    got = exact.exact_groups(docs, block=900)
    assert got.where("kept").count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows})


def test_exact_drop_and_empty(docs, rows, empty):
    out = exact.drop_copies(docs)
    assert out.columns == docs.columns
    assert out.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows})
    assert exact.exact_groups(empty).count() == 0 and exact.drop_copies(empty).count() == 0


# licenses --------------------------------------------------------------------------------------------


def test_license_scan(spark, empty):
    t = licences.TEMPLATES
    rng = np.random.default_rng(3)
    filler = lambda n: " ".join("".join(rng.choice(list("abcdefg"), 5)) for _ in range(n))
    changed = licences.words_of(t["mit-grant"])
    changed[1] = "thus"
    texts = [filler(50) + " " + t["mit"].upper() + "! " + filler(80), t["gpl-3.0"], filler(3), None, "", filler(30) + "\n" + " ".join(changed), filler(7) + t["apache-2.0-header"], t["mit-grant"].split(",")[0] + filler(40), filler(5000) + " " + t["cc-by-nc-4.0"] + " " + t["cc-by-nc-4.0"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = set()
    for i, x in enumerate(texts):
        w = licences.words_of(x or "")
        s = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        for name, text in t.items():
            v = licences.words_of(text)
            own = {tuple(v[k : k + 5]) for k in range(len(v) - 4)}
            half = licences.half_window(len(own))
            best = max((len(own & set(s[a : a + 2 * half])) / len(own) for a in range(0, max(1, len(s)), half)), default=0)
            if best >= 0.8:
                want.add((i, name, round(best, 9)))
    got = {(r.doc_id, r.license, round(r.containment, 9)) for r in licences.scan(docs).collect()}
    assert got == want and {(0, "mit"), (1, "gpl-3.0"), (5, "mit-grant"), (6, "apache-2.0-header")} <= {g[:2] for g in got}
    assert licences.scan(empty).count() == 0
    with pytest.raises(ValueError):
        licences.scan(docs, templates={"short": "too few words"})


def test_license_scan_repeated_rows(docs):
    assert licences.scan(docs.withColumn("text", F.lit(licences.TEMPLATES["mit"]))).where("license = 'mit'").count() == docs.count()


# sharding --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bucket", [30, 40_000])
def test_shards(docs, rows, bucket):
    got = sharding.shard(docs, bucket=bucket).collect()
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_shards_split_hot_groups_and_balance(spark, empty):
    rng = np.random.default_rng(1)
    texts = ["same text " * 20] * 400 + ["".join(rng.choice(list("abc "), int(n))) for n in rng.integers(1, 600, 800)] + ["pair"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sharding.shard(docs).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 8 and sums.max() < 1.03 * sums.min()
    assert got[got.doc_id >= 1200].shard.nunique() == 1
    assert sharding.shard(empty).count() == 0


# SimHash ---------------------------------------------------------------------------------------------


def brute_components(rows):
    fp = {}
    for r in rows:
        w = words(r[1])
        s = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        ones = [sum(h >> b & 1 for h in (xxh64_intdigest(x, seed=42) for x in s)) for b in range(64)]
        fp[r[0]] = sum(1 << b for b in range(64) if 2 * ones[b] > len(s))
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(fp)
    for a in ids:
        for b in ids:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (f"{fp[i]:016x}", find(i)) for i in ids}


def test_simhash(docs, rows, empty):
    want = brute_components(rows)
    got = neardup.near_groups(docs).collect()
    assert len(got) == len(rows) and all((r.fingerprint, r.component_id) == want[r.doc_id] for r in got)
    kept = neardup.drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want.values()})
    assert neardup.near_groups(empty).count() == 0 and neardup.drop_near_copies(empty).count() == 0


def test_near_copies_with_repeated_and_null_ids(spark):
    """Exactly one row of each group stays, whatever its id."""
    rng = random.Random(11)
    one, two, three, four = (" ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)) for _ in range(4))
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " x"), (None, three), (None, three + " x"), (None, four), (5, four + " x"), (1, one), (6, three[:-1] + "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    group = {r.doc_id: r.component_id for r in neardup.near_groups(docs.select(F.col("text").alias("doc_id"), "text")).distinct().collect()}
    assert len(set(group.values())) == 4
    kept = [tuple(r) for r in neardup.drop_near_copies(docs).collect()]
    assert sorted(i for i, _ in kept) == [1, 1, 5, 6] and {group[t] for _, t in kept} == set(group.values()) and set(kept) <= set(rows)
    assert neardup.drop_near_copies(docs.where("doc_id is null")).count() == 2


@pytest.mark.parametrize(("tile", "key_rows"), [(4, 1024), (16, 1), (4096, 1024)])
def test_links_by_tiles(spark, tile, key_rows, monkeypatch):
    """Large keys cut into tiles, and any number of segments, lose no link."""
    rng = np.random.default_rng(tile)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.int64)
    fps = sorted({int(c) ^ (1 << int(a)) ^ (1 << int(b)) for c in centres for a, b in rng.integers(0, 63, (25, 2))} | set(map(int, centres)))
    parts = neardup.segments
    monkeypatch.setattr(neardup, "segments", lambda n, r: parts(n, r, key_rows))
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.node: r.root for r in neardup.components(neardup.link_forest(df, len(fps), tile=tile)).collect()}
    root = {f: f for f in fps}
    a = np.array(fps)
    while True:
        new = {f: min(root[int(g)] for g in a[np.bitwise_count(a ^ f) <= 3]) for f in fps}
        new = {f: min(new[f], new[new[f]]) for f in fps}
        if new == root:
            break
        root = new
    assert {f: got.get(f, f) for f in fps} == root


# WARC ------------------------------------------------------------------------------------------------


def pages(spark, tmp=None):
    fake = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = ["<p>one</p>", fake, "a" + fake * 3 + "b", "WARC/1.0\r\n", "", None, "<p>one</p>", "é🙂" * 500, "\r\n\r\n\n\r", fake, "x" * 300_000, "WARC/1.0", "<p>one</p>", "ends with WARC/1.0\r"]
    return [(i * 3, f"http://h/ {i}" if i % 2 else None, h, "clash") for i, h in enumerate(html)]


def test_warc(spark):
    rows = pages(spark)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, file string").repartition(2)
    first = {}
    for i, _, h, _ in rows:
        first.setdefault(h or "", i)
    got = {r.page_id: r for r in warc.archive(df).collect()}
    assert sorted(got) == [r[0] for r in rows]
    for i, _, h, _ in rows:
        b = (h or "").encode()
        want = (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), *(("response", None) if first[h or ""] == i else ("revisit", first[h or ""])))
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == want
    assert warc.archive(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", ["997", "5000"])
def test_warc_scans_split_elsewhere(spark, tmp_path, size):
    """The second scan splits files otherwise than the first one, as it may after a lost executor."""
    rows = [(100 * k + i, u, (h or "") + str(k % 3), c) for k in range(5) for i, u, h, c in pages(spark)]
    path = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string, file string").repartition(2), f"file://{tmp_path}/w")
    links, own = warc.chain(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        single, whole = warc._pieced(spark, path, links)
        text = [r.value for r in whole.collect()]
        found = own.join(single, ["file", "at"]).select("own.*").unionAll(whole.select(*warc._digested(warc._record(F.col("value"))))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(text) > 5 and sorted(r.page_id for r in found) == sorted(r[0] for r in rows)
    assert all(r.payload_digest == r.digest for r in found if r.record_type == "response")


def test_warc_repeated_and_null_ids(spark):
    """Of equal payloads one is the response, also among rows of one id, or of none."""
    rows = [(1, "b", "same"), (1, "a", "same"), (1, "a", "same"), (2, "c", "same"), (3, None, "other"), (3, "x", "else"), (None, "n", "null"), (None, "m", "null"), (None, "p", "same")]
    got = by_row(warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "record_type", "refers_to"))
    want = {(1, "response", None): 1, (1, "revisit", 1): 2, (2, "revisit", 1): 1, (3, "response", None): 2, (None, "response", None): 1, (None, "revisit", None): 1, (None, "revisit", 1): 1}
    assert got == want


def test_warc_counts_what_it_reads(spark, monkeypatch):
    whole = warc.read_digests
    monkeypatch.setattr(warc, "read_digests", lambda *a: whole(*a).limit(2))
    with pytest.raises(ValueError, match="read back"):
        warc.archive(spark.createDataFrame(pages(spark), "page_id long, url string, html string, file string"))


def test_warc_split_files_and_broken_chain(spark, tmp_path):
    rows = pages(spark)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, file string").coalesce(1)
    path = warc.write_archives(df, f"file://{tmp_path}/w")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "997")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        back = warc.read_archives(spark, path).collect()
        assert sorted(r.page_id for r in back) == [r[0] for r in rows]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (f,) = (tmp_path / "w").glob("part-*")
    data = f.read_bytes()
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part").write_bytes(data.replace(b"Content-Length: 10", b"Content-Length: 11", 1))
    with pytest.raises(Exception, match="breaks off"):
        warc.read_archives(spark, f"file://{tmp_path}/broken").collect()


# packing ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("capacity", "part_rows"), [(2048, 50_000), (100, 20)])
def test_packing(docs, rows, empty, capacity, part_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for r in rows:
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            p = ids[k : k + capacity]
            want[r[0], k // capacity, k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())] += 1
    got = packing.pack_documents(docs, capacity=capacity, part_rows=part_rows).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    seqs = collections.defaultdict(list)
    for r in got:
        seqs[r.sequence_id].append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= capacity
    bound = packing.lower_bound(np.array([r.length for r in got]), capacity)
    assert bound <= len(seqs) <= bound * 1.1 + 1
    assert packing.pack_documents(empty).count() == 0


def test_bound_never_exceeds_best():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = rng.integers(1, 9)
        lengths = rng.integers(1, 21, n)
        assert packing.lower_bound(lengths, 20) <= packing.best_fit(lengths, 20)[2]
    assert packing.lower_bound(np.array([11, 11, 11]), 20) == 3


@pytest.mark.parametrize("text", ["<|endoftext|> hi <|startoftext|>x", "ΣΑΣ ΑΣ. Σ", "éa b　c", "İstanbul don't WE'LL 1234 ½ x²", "\x1c a\x1db \x85 q", "🙂👩‍👩‍👧 zz—“q”", "a" * 300, "'S 'T'Re", "ﬁ Å K ſ"])
def test_words_have_the_tokenizers_ids(text):
    w = packing.WordTokens("word_bpe_49k.json")
    assert np.frombuffer(w.ids(text.encode()), "<u4").tolist() == w.whole.encode(text, add_special_tokens=False).ids


def test_many_new_words_are_tokenized_in_portions():
    w, calls = packing.WordTokens("word_bpe_49k.json"), []
    encode = w._encode
    w._encode = lambda fresh: (calls.append(len(fresh)), encode(fresh))
    words = [("w" + "".join(chr(97 + int(c)) for c in str(i))).encode() for i in range(3 * packing.PORTION // 2)]
    assert len(w.ids(b" ".join(words))) > 4 * len(words)
    assert max(calls) <= packing.PORTION and sum(calls) == len(words)


# quality ---------------------------------------------------------------------------------------------


def test_quality_held_out(spark, empty):
    rng = np.random.default_rng(5)
    good = lambda: " ".join(rng.choice(["plain", "words", "in", "a", "row", "that", "read", "well."], 60))
    bad = lambda: " ".join(rng.choice(["$$$", "!!!", "CLICK", "|", "###", "x9x9"], 60))
    docs = spark.createDataFrame([(i, good() if i % 3 else bad(), 5) for i in range(600)] + [(600, None, None), (601, "", 0)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(500)] + [(None, 1), (700, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == 602
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id < 600:
            assert r.predicted == (r.doc_id % 3 > 0)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted}
    assert quality.score(empty, model).count() == 0
    blank = quality.train(docs, labels.where("quality = 1"))
    assert {round(r.score, 9) for r in quality.score(docs, blank).collect()}.pop() > 0.9


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    docs = [quality.features(b"some words to score with pairs"), quality.features(b"")]
    m = quality.Model(0.3, rng.normal(0, 1, quality.HASHES + quality.STATISTICS * quality.BINS).astype(np.float32), rng.normal(0, 1, (quality.HASHES + quality.STATISTICS * quality.BINS, 8)).astype(np.float32), np.zeros((quality.STATISTICS, quality.BINS - 2)))
    idx, x, start = m.rows(docs)
    raw, _ = m.raw(idx, x, start)
    for k, (a, b) in enumerate(zip(start, [*start[1:], len(idx)], strict=True)):
        i, w = idx[a:b], x[a:b].astype(float)
        pairs = sum(float(m.factors[i[p]] @ m.factors[i[q]]) * w[p] * w[q] for p in range(len(i)) for q in range(p))
        assert abs(raw[k] - (0.3 + float(m.linear[i] @ w) + pairs)) < 1e-3


# scoring ---------------------------------------------------------------------------------------------


def test_scores(docs, rows, empty):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    count = collections.Counter()
    for r in rows:
        if not held(r[0]):
            count.update([*words(r[1]), b"\n"])
    n, v = sum(count.values()), len(count)
    for frequent in (1, 1000):
        got = scoring.score(docs, frequent=frequent).collect()
        assert len(got) == len(rows)
        text = {r[0]: r[1] for r in rows}
        for r in got:
            t = [*words(text[r.doc_id]), b"\n"]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(count[w] > 0 for w in t), n)
            assert abs(r.base_score - sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) < 1e-6 * len(t)
            assert r.score < 0 and math.isfinite(r.score)
    assert scoring.score(empty).count() == 0


def scored_slices(table, held):
    """Of rows (doc_id, text), by doc_id: each token's cost in nats, and what the whole contexts foretell; on the driver."""
    data = table.select("doc_id", F.col("text").cast("binary").alias("text")).withColumn("train", ~F.col("doc_id").isin(list(held)))
    model = scoring.model_of(data)
    scorer, told, out = scoring.Scorer(model.vocabulary.value, model.tables.value.tables), model.told.collect(), {}
    for r in model.texts.collect():
        ids = iter(r.ids)
        for k, blobs in enumerate(zip(r.train, r.lens, r.tokens, r.words, strict=True)):
            part = scoring.Slice.read(*blobs, scorer.vocabulary)
            foretold = scoring.Foretold(part, scorer.vocabulary, model.buckets, [(t.bucket, t.told[k]) for t in told if t.slice == r.slice and t.told[k] is not None])
            costs = scorer.costs(part, foretold)
            for begin, n in zip(part.start, part.lens, strict=True):
                out[next(ids)] = costs[begin : begin + n], foretold, begin, part
    return out, scorer.vocabulary


def test_model_is_a_distribution(spark):
    """The next word's probabilities sum to one at most, at places where whole contexts foretell known and spelt words, and where none do."""
    rng = random.Random(11)
    known = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(30)]
    passage = "alpha beta gamma delta epsilon zeta eta theta iota".split()
    train = [" ".join(rng.choice(known) for _ in range(40)) for _ in range(60)]
    train += [" ".join([*rng.sample(known, 4), *passage, *rng.sample(known, 3)]) for _ in range(3)]
    train += [" ".join([*passage[:5], x]) for x in ("onceonly", "neveragain", *known[:2])]
    every = sorted({w for t in train for w in t.split()}) + ["zz", "q", "unheardof"]
    for prefix in (passage[:5], passage[:6], [known[3], "q"]):
        rows = [*enumerate(train), *((1000 + i, " ".join([*prefix, w])) for i, w in enumerate(every)), (999, " ".join(prefix))]
        held = [i for i, _ in rows if i >= 999]
        out, _ = scored_slices(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), held)
        total = math.exp(-out[999][0][-1]) + sum(math.exp(-out[1000 + i][0][-2]) for i in range(len(every)))
        assert 0.3 < total <= 1 + 1e-5
    assert math.exp(-out[999][0][0]) < 1


@pytest.mark.parametrize("parts", [1, 4])
def test_whole_contexts_count(spark, parts):
    """Against brute force: of all training places with the same three words before but a document's own, those that share a token's first 0, 1, ... bits."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["a", "b", "c", f"r{i}", f"q{i // 2}"]) for _ in range(rng.randint(1, 30))) for i in range(60)]
    held = set(range(0, 60, 4))
    out, v = scored_slices(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts), held)
    number = {w: i for i, w in enumerate(v.words)}
    code = lambda w: number.get(w, v.escape)
    bits = lambda w: scoring.loose_bits(v.bit[v.code.first[code(w)] :][: v.code.size[code(w)]])[3].tolist()
    docs, checked = [[*words(t), b"\n"] for t in texts], 0
    after = collections.defaultdict(list)
    for j, d in enumerate(docs):
        if j not in held:
            for r in range(3, len(d)):
                after[tuple(d[r - 3 : r])].append((j, d[r]))
    for i, d in enumerate(docs):
        _, told, begin, part = out[i]
        for p in range(len(d)):
            others = [w for j, w in after[tuple(d[p - 3 : p])] if j != i] if p >= 3 else []
            at = told.first[begin + p]
            assert (at >= 0) == bool(others)
            if others:
                mine = bits(d[p])
                assert told.counts[at : at + len(mine) + 1].tolist() == [sum(bits(w)[:k] == mine[:k] for w in others) for k in range(len(mine) + 1)]
                assert told.exact[begin + p] == sum(w == d[p] for w in others)
                checked += 1
    assert checked > 150


def test_rare_passages_are_known(spark):
    """Each passage of seven words stands in two documents only: both gain from it, whichever its contexts are."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passages = [" ".join(word() for _ in range(7)) for _ in range(60)]
    texts = [*passages * 2, *(" ".join(word() for _ in range(7)) for _ in range(60))]
    got = {r.doc_id: r.score for r in scoring.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), folds=1_000_000_007).collect()}
    assert max(got[i] for i in range(120, 180)) < min(got[i] for i in range(120))


def test_scores_do_not_depend_on_the_layout(spark, docs):
    one = sorted((r.doc_id, r.score) for r in scoring.score(docs.coalesce(1)).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    many = sorted((r.doc_id, r.score) for r in scoring.score(docs.repartition(7)).collect())
    spark.conf.unset("spark.sql.shuffle.partitions")
    assert [k for k, _ in one] == [k for k, _ in many]
    assert max(abs(a - b) for (_, a), (_, b) in zip(one, many, strict=True)) < 1e-3


def test_all_bits_are_mixed():
    """Against a plain loop: every bit costs what its key's weights say, and every bit moves them."""
    rng = np.random.default_rng(2)
    key, inputs = rng.integers(0, 3, 400), [rng.normal(size=400).astype(np.float32) for _ in range(4)]
    weights = rng.normal(size=(4, 3)).astype(np.float32)
    want, cost = weights.astype(np.float64), []
    moved = want.copy()
    for k in range(3):
        some = np.flatnonzero(key == k)
        for b in some:
            x = np.array([i[b] for i in inputs], np.float64)
            p = 1 / (1 + math.exp(-(want[:, k] @ x)))
            cost.append((b, -math.log(p)))
            moved[:, k] += 16 * scoring.RATE / (len(some) + 16) * (1 - p) * x
    got = scoring.mixed(weights, key, inputs)
    assert np.allclose(got, [c for _, c in sorted(cost)], atol=1e-5) and np.allclose(weights, moved, atol=1e-5)


def test_a_documents_cost_is_its_own():
    """Weights move for a document alone: others beside it in a slice don't change its cost."""
    vocabulary = scoring.Vocabulary([b"the", b"cat", b"\n"], np.array([5, 3, 2]), 12, np.ones(256), 14)
    scorer = scoring.Scorer(vocabulary, [scoring.guesses(np.random.default_rng(k).integers(0, 9, (1 << (14 - scoring.SPELT_LESS * (k > 1)), 2))) for k in range(scoring.TABLES)])
    texts = [[0, 1, 4, 0, 2], [1] * 500 + [5, 2], [2]]

    def costs(some):
        part = scoring.Slice(np.ones(len(some), bool), np.array([len(texts[i]) for i in some]), np.arange(6), np.concatenate([texts[i] for i in some]).astype(np.int64), [b"dog", b"zebra"], vocabulary)
        return scorer.costs(part, scoring.Foretold(part, vocabulary, 1, []))

    assert np.allclose(np.concatenate([costs([0]), costs([1]), costs([2])]), costs([0, 1, 2]), atol=1e-5)


def test_pairs_are_looked_up_once(monkeypatch):
    """The counts of a loop over all places, from as many bits as the different pairs have."""
    words = [b"the", b"cat", b"sat", b"\n"]
    v = scoring.Vocabulary(words, np.array([9, 5, 3, 2]), 22, np.ones(256), 14)
    rng = np.random.default_rng(4)
    word, context = rng.integers(0, 5, 3000), rng.integers(0, 6, 3000)
    want, pairs, looked = np.zeros(2 << 14, np.uint32), set(), []
    loose = scoring.loose_bits
    for w, c in zip(word.tolist(), context.tolist(), strict=True):
        node, _, line, one = loose(v.bit[v.code.first[w] :][: v.code.size[w]])
        np.add.at(want, v.slots(node + v.salts[1][c], line) * 2 + one, np.uint32(1))
        pairs.add((w, c))
    monkeypatch.setattr(scoring, "loose_bits", lambda x: looked.append(len(x)) or loose(x))
    got = np.zeros(2 << 14, np.uint32)
    scoring.count_pairs(got, v, v.salts[1], word << 32 | context)
    scoring.count_pairs(got, v, v.salts[1], word[:0] << 32)
    assert (got == want).all() and sum(looked) == sum(int(v.code.size[w]) for w, _ in pairs)


def test_words_are_numbered():
    """As by a dictionary, of words that differ little, are very long or hold any bytes."""
    rng = random.Random(8)
    words = list({bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 9))) for _ in range(4000)} | {b"a" * 5000, b"a" * 4999 + b"b"})
    known = [*words[::2], b"\n"]
    v = scoring.Vocabulary(known, np.ones(len(known), np.int64), len(known) + 9, np.ones(256), 14)
    got, rare = v.numbers(b" ".join(words))
    place = {w: i for i, w in enumerate(known)}
    assert rare == [w for w in words if w not in place]
    new = iter(range(v.escape + 1, v.escape + 1 + len(rare)))
    assert got.tolist() == [place[w] if w in place else next(new) for w in words]
    assert len(np.unique(scoring.hashes(words))) == len(words)


def test_code_is_complete_and_holds_the_counts():
    counts = np.r_[np.arange(1.0, 200), 10**9, 3 * 10**12]
    code = scoring.Code(counts)
    assert abs((0.5 ** code.size.astype(float)).sum() - 1) < 1e-9 and code.size.max() <= 32
    cost = np.add.reduceat(np.log1p(np.exp(-code.flat(0, len(counts))[2].astype(np.float64))), code.first)
    assert np.allclose(cost, -np.log(counts / counts.sum()), atol=1e-3)
    paths = {(int(w) >> (32 - int(s)), int(s)) for w, s in zip(code.word, code.size, strict=True)}
    assert len(paths) == len(counts)


# mixing ----------------------------------------------------------------------------------------------


def test_mix(docs, rows, empty):
    plan = mixing.plan_mix(docs)
    got = mixing.counted(docs, plan).select("row.doc_id", "row.source", "mix.*").collect()
    assert len(got) == len(rows)
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    names = sorted(k for k in size if k is not None) + [None]
    want = dict(zip(names, mixing.targets([size[k] for k in names]), strict=True))
    taken = collections.Counter()
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - want[r.source]) < 1e-6 and 0 <= r.copies <= 3 and len(r.shards) == r.copies
        taken[r.source] += r.copies * r.size
    assert abs(sum(want.values()) - sum(size.values())) < 1e-6
    out = mixing.mix(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    assert mixing.mix(empty).count() == 0
    again = mixing.counted(docs.repartition(5), mixing.plan_mix(docs.repartition(2))).select("row.doc_id", "row.source", "mix.*")
    assert by_row(again.select("doc_id", "copies")) == collections.Counter((r.doc_id, r.copies) for r in got)


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(2)
    docs = spark.createDataFrame([(i, "w " * int(rng.integers(1, 40)), "abcdefg"[int(rng.integers(0, 7)) if i % 3 else 0]) for i in range(3000)], "doc_id long, text string, source string")
    got = mixing.counted(docs, mixing.plan_mix(docs)).select("row.source", "mix.*").toPandas()
    s = got.assign(taken=got["size"] * got["copies"]).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), n=("size", "sum"))
    assert (abs(s.taken - s.target) <= 40).all() and (s.target <= 3 * s.n + 1e-6).all()


def test_mix_fills_until_no_row_fits(spark):
    """Sizes with a heavy tail, and rows that are drawn together: what is left of a target is less than any row that could still be drawn."""
    rng = np.random.default_rng(6)
    size = lambda: int(min(20_000, 1 + rng.pareto(0.35)))
    rows = [(i, "w " * size(), "abc"[i % 3]) for i in range(1500)]
    rows += [(i, "w " * 7, "b") for i in range(2000, 2040) for _ in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(docs)
    whole = {r.key: r.whole for r in plan.sources.collect()}
    got = mixing.counted(docs, plan).select("row.source", "mix.*").toPandas()
    for source, rows in got.groupby("source"):
        left = rows.target.iloc[0] - (rows["size"] * rows["copies"]).sum()
        spare = rows[(rows["copies"] == whole[f"={source}"]) & (rows["size"] > 0)].groupby("order")["size"].sum()
        assert left >= -1e-6 and (spare > left).all()
    assert len({s for shards in got.shards for s in shards}) == mixing.SHARDS


def test_mix_comes_through_the_tree(spark, monkeypatch):
    """A tree that loses a part of the quotas takes fewer words; one that fails fails the mix."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(2000)], "doc_id long, text string, source string")
    taken = lambda: mixing.counted(docs, mixing.plan_mix(docs)).select(F.sum(F.col("mix.size") * F.col("mix.copies"))).first()[0]
    whole = taken()
    monkeypatch.setattr(mixing, "deal", lambda items, shares: {item: s for item, s in DEAL(items, shares).items() if s != 3})
    assert 0.8 * whole < taken() < 0.95 * whole


def test_mix_refuses_sources_without_bound(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SOURCES", 3)
    with pytest.raises(ValueError, match="sources"):
        mixing.plan_mix(spark.createDataFrame([(i, "w", f"s{i}") for i in range(5)], "doc_id long, text string, source string"))


NAMES = ("row", "own", "key", "id", "sha", "mix", "copy", "shard", "salt", "last", "text_sha256", "__key", "__id", "__sha", "__sha2", "__copy", "__shard", "__mix", "block", "source_size", "fp", "n")


def test_no_column_name_clashes(spark):
    """Whatever docs' other columns are called, they come through."""
    rows = [(i, t, "ab"[i % 2], *range(len(NAMES))) for i, t in enumerate(["one two three four"] * 3 + ["five six seven eight nine"] * 2 + ["", None])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` long" for n in NAMES))
    for out, n in ((exact.drop_copies(docs), 3), (neardup.drop_near_copies(docs), 3), (mixing.mix(docs), None), (mixing.mix(docs, shuffled=False), None)):
        got = out.collect()
        assert out.columns == docs.columns and all(tuple(r)[3:] == tuple(range(len(NAMES))) for r in got) and got
        assert n is None or len(got) == n


def test_splitting_tree_keeps_quotas():
    q = np.array([0, 7, 100, 3])
    s = mixing.split_quotas(q, 8, np.random.default_rng(0))
    assert s.shape == (8, 4) and (s.sum(0) == q).all() and s.sum(1).max() - s.sum(1).min() <= 1 and (s >= 0).all()


@pytest.mark.parametrize(("sizes", "want"), [([10, 10, 10], [15 + 3.75, 7.5, 3.75]), ([1, 100, 100], [3, None, None]), ([0, 5], [0, 5]), ([], [])])
def test_targets(sizes, want):
    got = mixing.targets(sizes)
    assert abs(sum(got) - sum(sizes)) < 1e-9 and all(t <= 3 * s + 1e-9 for t, s in zip(got, sizes, strict=True))
    if want[:1] == [3]:
        assert got[0] == 3


def test_workers_keep_one_operators_words():
    """A worker that has tokenized words doesn't keep them while it classifies or packs."""
    import gc
    import weakref

    import pandas as pd
    import pyarrow as pa

    batch = pa.record_batch([pa.array(["a", "b"]), pa.array([b"some words", b"and more"])], ["doc_id", "text"])
    part = pd.DataFrame({"doc_id": ["a"], "piece": [0], "start": [0], "length": [5], "ids_crc32": [1], "sequence_id": [0], "offset": [0]})
    for then in (lambda: list(quality._with_metadata(batch, 1, 0)), lambda: packing._packer(2048, 0)((0,), part)):
        words = weakref.ref(packing.word_tokens("word_bpe_49k.json"))
        assert words() is packing.word_tokens("word_bpe_49k.json")
        then()
        gc.collect()
        assert words() is None
