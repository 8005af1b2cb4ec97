"""Best-fit packing of token sequences, certified by dual-feasible-function bounds.

Documents are cut into pieces of at most `capacity` tokens; only longer ones
are cut. Pieces are dealt to parts of bounded size; each part packs its own
best-fit decreasing, and the largest of several dual-feasible-function bounds
says how few sequences its pieces could ever need. Parts that meet their bound
are done; the others hand over their unfilled sequences, which are dealt anew,
so that pieces of different parts meet, and packed again. A repacking counts
only if it needs fewer sequences than before.

Defined results: a null text is empty, and every document has an end token, so
each row has a piece; repeated rows and rows of equal or null ids are separate
documents; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Collection, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.media import slices
from terravane.llm.tables import LOWER, Numbers, cut, hand_back, kept, let_go, spans

CAPACITY = 2048
#: Pieces that one task packs.
PART = 50_000
ROUNDS = 3
#: Entries of a worker's caches of words' tokens; beyond that, those that came first stay, as frequent words come early, and those in use.
CACHE = 450_000
PIECE_CACHE = 250_000
#: New words that are tokenized, and words whose tokens are gathered, at a time.
PORTION = 20_000
SPAN = 1 << 17

#: Fixed value: how the tokenizer's file splits normalised text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordTokens:
    """Token ids of texts, as little-endian 32-bit bytes; each different word is tokenized once.

    White space never lies within a token of this vocabulary, so that a text's
    ids are those of its words, one after the other. A word that normalising
    might change further than by case goes through the whole tokenizer.
    """

    def __init__(self, name: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.whole = Tokenizer.from_file(public_tokenizers.path(name) if "/" not in name else name)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = Split(" ", "removed")
        self.parts = regex.compile(PIECES).findall
        self.letter = _byte_letters()
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def ids(self, text: bytes) -> bytes:
        words = text.split()
        self.learn({w for w in words if w not in self.words}, set(words))
        return b"".join(map(self.words.__getitem__, words))

    def learn(self, words: Collection[bytes], every: Collection[bytes] | None = None) -> None:
        """Tokenizes words that are new, a portion at a time. every: all that are needed at once, should the cache start anew."""
        if len(self.words) > CACHE:
            needed = {w: self.words[w] for w in every or () if w in self.words}  # what is needed now stays too
            self.words = dict(islice(self.words.items(), CACHE // 3))
            self.words.update(needed)
            words = [w for w in every or words if w not in self.words]
        if len(self.pieces) > PIECE_CACHE:
            self.pieces = dict(islice(self.pieces.items(), PIECE_CACHE // 2))
        new = iter(words)
        while portion := list(islice(new, PORTION)):
            self._learn(portion)

    def _learn(self, words: list[bytes]) -> None:
        import re
        import unicodedata

        odd = re.compile("[Σİ]").search
        split: list[tuple[bytes, list[str]]] = []
        fresh: dict[str, None] = {}
        for w in words:
            # most words are small ASCII letters, or those and one mark behind them
            if w.isalpha() and w.islower() and len(w) <= 200:
                split.append((w, [(low := w.decode())]))
                if low not in self.pieces:
                    fresh[low] = None
                continue
            if 1 < len(w) <= 200 and 33 <= w[-1] <= 126 and not w[-1:].isalnum() and (body := w[:-1]).isalpha() and body.islower():
                split.append((w, found := [body.decode(), chr(w[-1])]))
                for p in found:
                    if p not in self.pieces:
                        fresh[p] = None
                continue
            s = w.decode("utf-8", "replace")
            if b"<|" in w or len(w) > 200 or not w.isascii() and (odd(s) or not unicodedata.is_normalized("NFC", s)):
                self.words[w] = np.array(self.whole.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
                continue
            low = s.lower()
            found = [low] if low.isalpha() else self.parts(low)
            split.append((w, found))
            for p in found:
                if p not in self.pieces:
                    fresh[p] = None
        if fresh:
            self._encode(list(fresh))
        for w, found in split:
            self.words[w] = b"".join(map(self.pieces.__getitem__, found)) if len(found) != 1 else self.pieces[found[0]]

    def _encode(self, fresh: list[str]) -> None:
        joined = [" ".join([p if p.isascii() and p.isprintable() else p.encode().decode("latin-1").translate(self.letter) for p in fresh[i : i + 256]]) for i in range(0, len(fresh), 256)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.bare.encode_batch_fast(joined, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(fresh):
            raise ValueError("a piece without an end")
        data, begin = ids.tobytes(), 0
        for p, stop in zip(fresh, stops.tolist(), strict=True):
            self.pieces[p] = data[begin : 4 * stop]
            begin = 4 * stop


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: printable Latin-1 as it is, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def word_tokens(name: str) -> WordTokens:
    """One for a worker process, with what it has learnt."""
    return kept(f"tokens {name}", lambda: WordTokens(name))


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's tokens and end token, in pieces of at most capacity."""
    data = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"))
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(tokenizer)
        for batch in batches:
            for ids, texts in slices(batch, 6 << 20):
                # case is dropped by the tokenizer's normaliser, and so early here: fewer different words
                numbers, words, counts = Numbers(), [], []
                number, stop = numbers.__getitem__, numbers[b" "]  # no word is a space: it stands for the end
                for t in texts:
                    found = t.translate(LOWER).split() if b"<|" not in t else t.split()
                    words.extend(map(number, found))
                    words.append(stop)
                    counts.append(len(found) + 1)
                words = np.array(words, np.int32)
                del found, number, numbers[b" "]
                known = tokens.words
                tokens.learn([w for w in numbers if w not in known], numbers)
                known = tokens.words
                blobs = [tail, *[known[w] for w in numbers]]
                del numbers, known
                size = np.array([len(b) // 4 for b in blobs])
                table, first = np.frombuffer(b"".join(blobs), "<u4"), np.cumsum(size) - size
                del blobs
                lens = np.add.reduceat(size[words], np.cumsum([0, *counts[:-1]]))
                flat, to = np.empty(int(lens.sum()), "<u4"), 0
                for k in range(0, len(words), SPAN):
                    some = words[k : k + SPAN]
                    ids_here = table[spans(first[some], size[some])]
                    flat[to : to + len(ids_here)] = ids_here
                    to += len(ids_here)
                n = -(-lens // capacity)
                owner, piece = np.repeat(np.arange(len(lens)), n), spans(np.zeros(len(n), np.int64), n)
                start = piece * capacity
                length = np.minimum(capacity, lens[owner] - start)
                begin = (np.cumsum(lens) - lens)[owner] + start
                view = memoryview(flat).cast("B")
                crc = [zlib.crc32(view[4 * b : 4 * (b + m)]) for b, m in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.record_batch([ids.take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
                del texts, ids, flat, table, words, view, ids_here
                hand_back()
            del batch  # else it stays while the next is read

    return data.mapInArrow(run, f"doc_id {data.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest dual-feasible-function bound on the sequences that lengths need.

    Two families: small pieces left out and pieces that exclude them rounded up
    to a whole sequence, for each threshold up to half; and shares rounded down
    to k-ths, for k up to 50.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    above = np.r_[np.cumsum(count[::-1])[::-1], 0]
    mass = np.r_[np.cumsum((count * size)[::-1])[::-1], 0]
    a = np.arange(capacity // 2 + 1)
    whole = above[capacity - a + 1]
    best = int((-(-(whole * capacity + mass[a] - mass[capacity - a + 1]) // capacity)).max())
    for k in range(1, 51):
        share = (k + 1) * size
        value = np.where(share % capacity == 0, size * k, share // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: each piece's sequence and offset, and how many sequences. Ties go by position."""
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, n = 0, 0
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = open_ >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            stack = room[left]
            s = stack.pop()
            if not stack:
                open_ &= ~(1 << left)
        else:
            s, left, n = n, capacity, n + 1
        place[i], offset[i] = s, capacity - left
        left -= size
        if left:
            room[left].append(s)
            open_ |= 1 << left
    return place, offset, n


def _packer(capacity: int, n_round: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        let_go()
        part = part.sort_values(["length", "ids_crc32", "doc_id", "piece", "start"], ascending=[False, True, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        lengths = part["length"].to_numpy()
        place, offset, n = best_fit(lengths, capacity)
        before = part["sequence_id"].nunique() if n_round else n + 1
        if n < before:
            part["sequence_id"] = (np.int64(n_round) << 56) + (np.int64(key[0]) << 24) + place
            part["offset"] = offset
        else:
            n = before
        bound = lower_bound(lengths, capacity)
        used = part.groupby("sequence_id")["length"].transform("sum")
        part["open"] = (n > bound) & (used < capacity).to_numpy()
        part["gap"] = n - bound
        part["part"] = key[0]
        return part[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open", "gap", "part"]]

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_rows: int = PART, rounds: int = ROUNDS) -> DataFrame:
    """pieces with sequence_id and offset: pieces of capacity stand alone, the others are packed best-fit decreasing and repacked where the bound leaves a gap.

    Fewer than part_rows pieces meet in a task on average; the driver only sees counts.
    """
    spark = pieces.sparkSession
    kind = pieces.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean, gap long, part long"
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = pieces.where(F.col("length") == capacity).select("doc_id", "piece", "start", "length", "ids_crc32", (F.lit(1 << 62) + F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    todo = pieces.where(F.col("length") < capacity).select("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done = [full]
    for k in range(rounds + 1):
        n = todo.count()
        parts = max(1, -(-n // part_rows))
        # in the first round a piece's place in its files deals it out; later whole sequences move, so that their pieces stay together
        deal = F.pmod(F.monotonically_increasing_id(), F.lit(parts)) if k == 0 else F.pmod(F.xxhash64("sequence_id", F.lit(k)), F.lit(parts))
        packed = cut(todo.withColumn("part", deal).groupBy("part").applyInPandas(_packer(capacity, k), schema), "packed")
        again = packed.where("open")
        gaps = packed.groupBy("part").agg(F.max("gap").alias("gap")).agg(F.sum(F.when(F.col("gap") > 0, 1).otherwise(0)), F.sum("gap")).first()
        if k == rounds or not gaps[1] or parts == 1 or gaps[0] < 2 and k:
            done.append(packed.select(columns))
            break
        done.append(packed.where("not open").select(columns))
        todo = again.select(columns)
    out = done[0]
    for d in done[1:]:
        out = out.unionAll(d)
    return out


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end: int = 0, part_rows: int = PART) -> DataFrame:
    """Tokenizes, cuts and packs documents: a row for each piece."""
    return pack(cut(pieces_of(docs, tokenizer, capacity, end), "pieces"), capacity, part_rows)
