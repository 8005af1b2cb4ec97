"""Language-model scoring: a smoothed unigram base, and online logistic context mixing of bit predictors.

The model reads a text as tokens: words, then one end. A token is the bits of a
Huffman code over the training vocabulary, which holds words seen twice or more
(at most FREQUENT, the most frequent); any other word is the code's escape and
then its bytes and a space, each byte the bits of a second code. Four predictors
guess every bit of a token, each from how often training documents went on with
a one and a zero after the same context and the same bits of the token so far:

- no context (exact counts of the vocabulary);
- the most frequent word among the sixteen before (hashed);
- the word before (hashed);
- the three words before (whole contexts of all documents, kept apart; a
  document's own places don't count for it).

Six guess the bits of spelt bytes: no context, the last two, three and five bytes,
the word so far, the last three bytes with the frequent word before. Guesses,
stretched, are added with weights that a gate selects: how often the contexts were
seen, and how many words in a row the three before have foretold. A spelt word
that the three words before foretell is one more bit behind the escape. Weights
start from fixed values and are refined online: after every block of a
document's tokens its own weights move along the gradient of the block's coding
cost. The bits' total cost is the score, so that the probabilities of all texts
sum to one at most: the foretold is only ever an input of the mixed bits.

The whole contexts grow with the corpus: every place of every document goes to a
bucket of its context, where it meets all others of this context, and how often
the others went on with each of its bits comes back. There are as many buckets
as the counted tokens ask for. Hashed tables grow with the corpus up to 2 **
TABLE_BITS slots; they are summed part by part, in rounds, and sent to the
executors, as is the vocabulary. Counts of words beyond the vocabulary come back
from the buckets too, so that base scores are exact.

Defined results: a null text counts as empty: one end token; held-out rows and
all others are scored in the same way; rows with a null id are training rows;
repeated rows count as often as they occur, and for each other; a training
document's words are in the vocabulary and the hashed tables, which makes its
score a little high; without training rows the base score is uniform and the
model uninformed; an empty table gives no rows; other columns are ignored. How
rows are stored or dealt to tasks doesn't change a score.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.media import slices
from terravane.llm.tables import LOWER, Numbers, crc_of_id, cut, hand_back, spans

END = b"\n"
FREQUENT = 250_000
#: Different words that a worker counts before it hands them on.
HELD = 300_000
#: log2 of the slots of a hashed table, at most.
TABLE_BITS = 20
#: The hashed tables: frequent word before; word before; and of spelt bytes: two, three and five, the word so far, three with the frequent word.
TABLES = 7
#: Tables of spelt bits have that many times a half of the slots.
SPELT_LESS = 1
#: Slots of a table that are summed together.
PART = 1 << 16
#: Training tokens whose bits one task adds to its tables.
TABLE_TOKENS = 50_000_000
#: Tokens before a token among which the most frequent one is looked for.
NEAR = 16
#: Words of a whole context.
CONTEXT = 3
#: Places of the corpus that meet in one bucket of contexts.
BUCKET = 1_000_000
#: Bytes of text in a row of the slices, which ask and are answered together, and in each of its parts, which are read and scored together.
ROW = 16 << 20
SLICE = 2 << 20
#: Tokens after which a document's weights are refined: so many at first, and later this share of those before.
BLOCK = 64
GROWTH = 8
#: Tokens whose bits are mixed together.
CHUNK = 4_000
RATE = 0.05
#: Classes of how often a context was seen.
SEEN = np.array([1, 2, 4, 10, 40, 200, 1500])
PRIOR = 0.3
#: Classes of how many words in a row the whole contexts have foretold.
RUNS = np.array([1, 3, 16])
#: Gates of a token's bits: whole context (none; by run, seen once or more often), word before, frequent word before.
WHOLE = 1 + 2 * (len(RUNS) + 1)
GATES = WHOLE * 8 * 4
#: Gates of spelt bits: word so far, five bytes, three bytes with the frequent word.
SPELT_GATES = 8 * 3 * 3
LIMIT = 15.0
NONE = -1

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_MIX32 = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def counted_tokens(texts: DataFrame) -> DataFrame:
    """word, c: how often training documents hold each word and the end, from slices of texts. Tasks hand on compressed lists, which meet by their words' hashes."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            words, counts = list(held.keys()), np.fromiter(held.values(), np.int64, len(held))
            held.clear()
            part = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % parts
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            some = np.flatnonzero(np.diff(cuts))
            lists = [order[cuts[i] : cuts[i + 1]] for i in some]
            return pa.record_batch([pa.array(some, pa.int32()), pa.array([_zip(b" ".join([words[i] for i in x.tolist()])) for x in lists], pa.binary()), pa.array([_squeezed(counts[x]) for x in lists], pa.binary())], ["part", "words", "counts"])

        for batch in batches:
            for words, counts in zip(batch.column(0), batch.column(1), strict=True):
                for w, c in zip(_words(words.as_py()), _loose(counts.as_py(), np.int64).tolist(), strict=True):
                    if c:
                        held[w] = held.get(w, 0) + c
                if len(held) > HELD:
                    yield handed()
        if held:
            yield handed()

    def add(rows: pa.Table) -> pa.Table:
        total: dict[bytes, int] = {}
        for words, counts in zip(rows.column("words"), rows.column("counts"), strict=True):
            for w, c in zip(_words(words.as_py()), _loose(counts.as_py(), np.int64).tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        return pa.table([pa.array(total.keys(), pa.binary()), pa.array(total.values(), pa.int64())], ["word", "c"])

    return texts.select(F.explode(F.arrays_zip("words", "counts")).alias("p")).select("p.words", "p.counts").mapInArrow(run, "part int, words binary, counts binary").groupBy("part").applyInArrow(add, "word binary, c long")


def _words(data: bytes) -> list[bytes]:
    return _unzip(data).split(b" ")


def _zip(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(data)


def _unzip(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _squeezed(x: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes."""
    return _zip(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _loose(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unzip(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


class Code:
    """A Huffman code of numbered symbols. For each: where its bits begin, how many, and all of them from a word's top bit on."""

    def __init__(self, counts: np.ndarray):
        """Every symbol has a code, of at most 32 bits."""
        n = len(counts)
        true = np.maximum(np.asarray(counts, np.float64), 0.5)
        heap = list(zip(np.maximum(true, true.sum() / 2**21).tolist(), range(n), strict=True))
        heapq.heapify(heap)
        up, side = np.full(2 * n - 1, NONE, np.int32), np.zeros(2 * n - 1, np.int8)
        for node in range(n, 2 * n - 1):
            (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
            up[i] = up[j] = node
            side[j] = 1
            heapq.heappush(heap, (a + b, node))
        self.__setstate__((up, side, true))

    def __getstate__(self) -> tuple:
        return self.up, self.side, self.true

    def __setstate__(self, tree: tuple) -> None:
        self.up, self.side, self.true = tree
        n = len(self.true)
        self.weight = np.r_[self.true, np.zeros(n - 1)]
        at, self.size = np.arange(n), np.zeros(n, np.int64)
        while (up := self.up[at]).max() >= 0:
            self.size += up >= 0
            at = np.where(up >= 0, up, at)
        for i, j in enumerate(self.up[:-1].tolist()):  # nodes come behind what they join
            self.weight[j] += self.weight[i]
        self.first = np.cumsum(self.size) - self.size
        self.word = np.zeros(n, np.uint32)
        at = np.arange(n)
        for k in range(int(self.size.max())):  # from each symbol towards the root
            some = np.flatnonzero(self.size > k)
            self.word[some] |= self.side[at[some]].astype(np.uint32) << (32 - self.size[some] + k).astype(np.uint32)
            at[some] = self.up[at[some]]

    def flat(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the bits of symbols lo to hi: the node from which the bit's group of three starts, its place in the group's line of eight, the stretched guess of it by the counts, and its value as a sign."""
        n, size, first = len(self.true), self.size[lo:hi], self.first[lo:hi] - self.first[lo]
        node, sign, guess = np.zeros(size.sum(), np.int64), np.zeros(size.sum(), np.int8), np.zeros(size.sum(), np.float32)
        at = np.arange(lo, hi)
        for k in range(int(size.max(initial=0))):
            some = np.flatnonzero(size > k)
            here, place = at[some], first[some] + size[some] - 1 - k
            above = self.up[here]
            node[place], sign[place] = above - n, 2 * self.side[here] - 1
            guess[place] = np.log(self.weight[here] / np.maximum(self.weight[above] - self.weight[here], 1e-9))
            at[some] = above
        back = (np.arange(len(node)) - np.repeat(first, size)) % 3
        one = (sign > 0).astype(np.uint8)
        before, last = np.r_[np.zeros(2, np.uint8), one][: len(one)], np.r_[np.zeros(1, np.uint8), one][: len(one)]
        line = np.where(back == 0, 1, np.where(back == 1, 2 + last, 4 + 2 * before + last)).astype(np.uint8)
        return node[np.arange(len(node)) - back].astype(np.uint32), line, guess, sign


def hashed(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of words joined by spaces: where each begins and ends, and two hashes, which are sums of its bytes times random numbers of their places."""
    text = np.frombuffer(data + b" ", np.uint8)
    ends = np.flatnonzero(text == 32)
    begin = np.r_[0, ends[:-1] + 1]
    size = ends + 1 - begin
    place = np.arange(len(text)) - np.repeat(begin, size)
    factor, value, sums = np.arange(1, size.max() + 1, dtype=np.uint64), text.astype(np.uint64) + np.uint64(1), []
    for mix in _MIX[:2]:
        factor = factor * mix + _MIX[2]
        for turn in (31, 27):
            factor = (factor ^ (factor >> np.uint64(turn))) * _MIX[0]
        h = np.add.reduceat((factor ^ (factor >> np.uint64(33)))[place] * value, begin)
        sums.append((h ^ (h >> np.uint64(32))) * _MIX[1])
    return begin, ends, *(h ^ (h >> np.uint64(29)) for h in sums)


def hashes(words: list[bytes]) -> np.ndarray:
    return hashed(b" ".join(words))[2] if words else np.empty(0, np.uint64)


def _mixed32(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x.astype(np.uint32) + np.uint32(salt)) * _MIX32[0]
    x ^= x >> np.uint32(15)
    return x * _MIX32[1]


def packed_bits(node: np.ndarray, guess: np.ndarray, line: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """All that bits are as one number each, so that one look finds it: a hashed node, the stretched guess in thousandths, the place in a line, the value."""
    guess = np.rint(np.clip(guess, -LIMIT, LIMIT) * 1000).astype(np.int16).view(np.uint16)
    return node.astype(np.uint64) << np.uint64(32) | guess.astype(np.uint64) << np.uint64(16) | line.astype(np.uint64) << np.uint64(1) | (sign > 0)


def loose_bits(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, guesses, places in lines, and values (0 or 1)."""
    low = packed.astype(np.uint32)
    byte = low.astype(np.uint8)
    return (packed >> np.uint64(32)).astype(np.uint32), np.multiply((low >> np.uint32(16)).astype(np.uint16).view(np.int16), np.float32(0.001), dtype=np.float32), (byte >> np.uint8(1)) & np.uint8(7), (byte & np.uint8(1)).view(np.int8)


@dataclass
class Spelt:
    """Words as bits of their bytes: where each word's begin and how many; for each bit packed_bits, with the last three bytes in its node, and its place in the lines of eight of all groups; each group's line in four tables."""

    first: np.ndarray
    size: np.ndarray
    bit: np.ndarray
    place: np.ndarray
    lines: list[np.ndarray]


class Vocabulary:
    """Words with codes of their own, by falling count; the number behind the last is the escape's, the next stands for no word."""

    def __init__(self, words: list[bytes], counts: np.ndarray, total: int, letters: np.ndarray, bits: int):
        self.__setstate__((_zip(b" ".join(words)), counts, bits, Code(np.r_[counts, total - counts.sum()]), Code(letters)))

    def __getstate__(self) -> tuple:
        return _zip(b" ".join(self.words)), self.counts, self.bits, self.code, self.bytes

    def __setstate__(self, state: tuple) -> None:
        words, self.counts, self.bits, self.code, self.bytes = state
        self.words = _unzip(words).split(b" ")
        self.escape, self.end = len(self.words), self.words.index(END)
        self._bit: np.ndarray | None = None
        _, _, names, more = hashed(b" ".join(self.words))
        self.hash = np.r_[names, np.uint64(0)]
        self._order = np.argsort(names)
        self._names, self._more = names[self._order], more[self._order]
        number = np.arange(len(self.words) + 2)
        self.salts = (_mixed32(number, 101), _mixed32(number, 202))

    @property
    def bit(self) -> np.ndarray:
        """packed_bits of all words and the escape."""
        if self._bit is None:
            self._bit = np.empty(int(self.code.size.sum()), np.uint64)
            for lo in range(0, self.escape + 1, 20_000):
                hi = min(lo + 20_000, self.escape + 1)
                root, line, guess, sign = self.code.flat(lo, hi)
                self._bit[self.code.first[lo] :][: len(root)] = packed_bits(_mixed32(root, 3), guess, line, sign)
        return self._bit

    def numbers(self, data: bytes) -> tuple[np.ndarray, list[bytes]]:
        """The numbers of different words, joined by spaces, and those that aren't in the vocabulary: they are numbered behind the escape. Words are the same where both hashes, of 128 bits, are."""
        begin, ends, names, more = hashed(data)
        order = np.argsort(names)
        found = np.empty(len(names), np.int64)
        found[order] = np.minimum(np.searchsorted(self._names, names[order]), self.escape - 1)
        out = np.where((self._names[found] == names) & (self._more[found] == more), self._order[found], self.escape)
        odd = np.flatnonzero(out == self.escape)
        out[odd] += 1 + np.arange(len(odd))
        return out, [data[i:j] for i, j in zip(begin[odd].tolist(), ends[odd].tolist(), strict=True)]

    def slots(self, mixed: np.ndarray, line: np.ndarray, less: int = 0) -> np.ndarray:
        """Bits of one group of three lie in one line of eight slots."""
        slot = self.lines(mixed, less)
        slot <<= 3
        slot += line
        return slot

    def lines(self, mixed: np.ndarray, less: int = 0) -> np.ndarray:
        mixed = (mixed ^ (mixed >> np.uint32(16))) * _MIX32[2]
        mixed >>= np.uint32(35 + less - self.bits)
        return mixed.astype(np.intp)

    def spelt(self, words: list[bytes]) -> Spelt:
        code, (root, lines, guess, sign) = self.bytes, self.bytes.flat(0, 256)
        lens = np.array([len(w) + 1 for w in words], np.int64)
        text = np.frombuffer(b"".join(w + b" " for w in words), np.uint8)
        begin = np.cumsum(lens) - lens
        place = np.arange(len(text)) - np.repeat(begin, lens)
        contexts, h = {}, np.zeros(len(text), np.uint32)
        for back in range(1, 6):
            before = np.full(len(text), 257, np.uint32)
            before[back:] = text[:-back]
            before[place < back] = 256
            h = (h + before + np.uint32(1)) * _MIX32[0]
            h ^= h >> np.uint32(13)
            contexts[back] = h * _MIX32[1]
        whole, value, depth, live = np.zeros(len(text), np.uint32), np.full(len(words), 7, np.uint32), 0, np.arange(len(words))
        while len(live):  # all words' byte `depth` at once
            at = begin[live] + depth
            whole[at] = value
            value = (value + text[at] + np.uint32(1)) * _MIX32[0]
            value ^= value >> np.uint32(14)
            depth += 1
            on = lens[live] > depth
            live, value = live[on], value[on]
        n, g = code.size[text], -(-code.size // 3)
        heads = np.flatnonzero(lines == 1)
        at, of = spans(code.first[text], n), np.repeat(np.arange(len(text)), g[text])
        node = _mixed32(root[heads], 5)[spans((np.cumsum(g) - g)[text], g[text])]
        three = contexts[3][of] + node
        size = np.add.reduceat(n, begin) if len(words) else np.empty(0, np.int64)
        line = lines[at]
        group = np.cumsum(line == 1) - 1  # a group's first bit has place 1
        # all of the few bits once, then the nodes
        bit = packed_bits(np.zeros(len(lines), np.uint32), guess, lines, sign)[at]
        bit |= three.astype(np.uint64)[group] << np.uint64(32)
        return Spelt(np.cumsum(size) - size, size, bit, group * 8 + line, [self.lines(c, SPELT_LESS) for c in (contexts[2][of] + node, three, contexts[5][of] + node, (whole * _MIX32[1])[of] + node)])


class Slice:
    """Some documents as numbers of their tokens, one document after the other."""

    def __init__(self, train: np.ndarray, lens: np.ndarray, numbers: np.ndarray, tokens: np.ndarray, rare: list[bytes], vocabulary: Vocabulary):
        """numbers: of the slice's different words; tokens: places of words among them."""
        self.train, self.lens, self.rare, self.local, self.words = train, lens, rare, tokens, np.minimum(numbers, vocabulary.escape)
        self.none, self.escape = vocabulary.escape + 1, vocabulary.escape
        self.tokens = numbers.astype(np.int32)[tokens]
        self.start = np.cumsum(lens) - lens
        self.doc = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        self.place = np.arange(len(tokens), dtype=np.int32) - np.repeat(self.start.astype(np.int32), lens)
        self.ids = np.minimum(self.tokens, np.int32(vocabulary.escape))

    @cached_property
    def before(self) -> np.ndarray:
        """The number before."""
        before = np.r_[np.int32(self.none), self.ids[:-1]]
        before[self.start] = self.none
        return before

    @cached_property
    def near(self) -> np.ndarray:
        """The least number among the NEAR tokens before, escapes left out."""
        none = np.int32(self.none)
        near, reach = np.where(self.before == self.escape, none, self.before), 1
        while reach < min(NEAR, len(near)):  # the range doubles
            further = near.copy()
            np.minimum(near[reach:], near[:-reach], out=further[reach:], where=self.place[reach:] >= reach)
            near, reach = further, 2 * reach
        return near

    def bits(self, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The slice's own words' bits, those of words that come early and so often together: where a word's begin, how many, and packed_bits."""
        size = vocabulary.code.size[self.words]
        return np.cumsum(size) - size, size, vocabulary.bit[spans(vocabulary.code.first[self.words], size)]

    @classmethod
    def read(cls, train: bytes, lens: bytes, tokens: bytes, words: bytes, vocabulary: Vocabulary) -> Slice:
        numbers, rare = vocabulary.numbers(_unzip(words))
        return cls(_loose(train, np.uint8).astype(bool), _loose(lens, np.int64), numbers, _loose(tokens, np.uint32).astype(np.int64), rare, vocabulary)


def sliced(data: DataFrame) -> DataFrame:
    """slice, ids, train, lens, tokens, words, counts: documents (doc_id, train, text) dealt to rows of about ROW bytes, in parts of about SLICE bytes; each part's different words, their numbers in place of them, and how often its training documents hold each."""
    kind = data.schema["doc_id"].dataType.simpleString()

    def part_of(train: np.ndarray, texts: list[bytes]) -> list[bytes]:
        numbers, tokens, lens = Numbers(), [], []
        number, end = numbers.__getitem__, numbers[END]
        for t in texts:
            words = t.translate(LOWER).split()
            tokens.extend(map(number, words))
            tokens.append(end)
            lens.append(len(words) + 1)
        lens, tokens = np.array(lens, np.int64), np.array(tokens, np.uint32)
        counts = np.bincount(tokens[np.repeat(train, lens)], minlength=len(numbers))
        return [_squeezed(train.astype(np.uint8)), _squeezed(lens), _squeezed(tokens), _zip(b" ".join(numbers)), _squeezed(counts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            for keys, train, texts in slices(batch, ROW):
                train = train.to_numpy(zero_copy_only=False)
                begins = np.cumsum([0, *map(len, texts)])[:-1] // SLICE
                cuts = [*np.flatnonzero(np.r_[True, begins[1:] != begins[:-1]]).tolist(), len(texts)]
                parts = [part_of(train[lo:hi], texts[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
                cols = [pa.array([[p[k] for p in parts]], pa.list_(pa.binary())) for k in range(5)]
                hand_back()
                yield pa.record_batch([pa.array([name], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), *cols], ["slice", "ids", "train", "lens", "tokens", "words", "counts"])
                name += 1

    blobs = ", ".join(f"{c} array<binary>" for c in ("train", "lens", "tokens", "words", "counts"))
    return cut(data.select("doc_id", "train", "text").mapInArrow(run, f"slice long, ids array<{kind}>, {blobs}"), "slices")


def parts_of(batch: pa.RecordBatch | pa.Table, i: int, vocabulary: Vocabulary) -> Iterator[Slice]:
    for blobs in zip(*(batch.column(k)[i] for k in ("train", "lens", "tokens", "words")), strict=True):
        yield Slice.read(*(b.as_py() for b in blobs), vocabulary)


# hashed tables ---------------------------------------------------------------------------------------


def count_pairs(table: np.ndarray, vocabulary: Vocabulary, salts: np.ndarray, pair: np.ndarray) -> None:
    """Counts the bits of words (upper halves) after their contexts (lower halves): each pair of them once, as often as it stands there, word by word. Sorts the pairs in place."""
    pair.sort()
    edge = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][: len(pair)])
    times, pair = np.diff(np.r_[edge, len(pair)]).astype(np.uint32), pair[edge]
    for at in range(0, len(pair), CHUNK):
        some = pair[at : at + CHUNK]
        word = some >> 32
        n = vocabulary.code.size[word]
        node, _, line, one = loose_bits(np.take(vocabulary.bit, spans(vocabulary.code.first[word], n)))
        slot = vocabulary.slots(node + np.repeat(salts[some & 0xFFFFFFFF], n), line)
        slot <<= 1
        slot += one
        np.add.at(table, slot, np.repeat(times[at : at + CHUNK], n))


def _tables(texts: DataFrame, shared, n_train: int, bits: int) -> list[np.ndarray]:
    """Every table's guesses by slot, from the counts of zeros and ones summed over all training documents."""

    def spell(part: Slice, learnt: np.ndarray, tables: list[np.ndarray]) -> None:
        """Counts the spelt bits of a part."""
        vocabulary = shared.value
        odd = np.flatnonzero(learnt & (part.tokens > vocabulary.escape))
        spelt = vocabulary.spelt(part.rare)
        times = np.repeat(np.bincount(part.tokens[odd] - vocabulary.escape - 1, minlength=len(part.rare)).astype(np.uint32), spelt.size)
        group, low = spelt.place >> 3, (spelt.bit & np.uint64(15)).view(np.int64)
        for k, lines in enumerate(spelt.lines, 2):
            slot = np.take(lines << 4, group)
            slot += low
            np.add.at(tables[k], slot, times)
        for some in np.array_split(odd, max(1, len(odd) // CHUNK)):
            word = part.tokens[some] - vocabulary.escape - 1
            n = spelt.size[word]
            three, _, line, one = loose_bits(np.take(spelt.bit, spans(spelt.first[word], n)))
            np.add.at(tables[6], vocabulary.slots(three + np.repeat(vocabulary.salts[0][part.near[some]], n), line, SPELT_LESS) * 2 + one, np.uint32(1))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary, tables = shared.value, None
        for batch in batches:
            if tables is None:
                tables = [np.zeros(2 << (bits - SPELT_LESS * (k > 1)), np.uint32) for k in range(TABLES)]
            for i in range(batch.num_rows):
                pairs = [[], []]
                for part in parts_of(batch, i, vocabulary):
                    hand_back()
                    learnt, word = part.train[part.doc], part.ids.astype(np.int64) << 32
                    for found, of in zip(pairs, (part.near, part.before), strict=True):
                        found.append((word | of)[learnt])
                    spell(part, learnt, tables)
                for k in (0, 1):
                    count_pairs(tables[k], vocabulary, vocabulary.salts[k], np.concatenate(pairs[k]))
                    pairs[k] = None
        if tables is not None:
            task = TaskContext.get().partitionId()
            for k, t in enumerate(tables):
                for i in range(0, len(t), 2 * PART):
                    part = t[i : i + 2 * PART]
                    if part.any():
                        yield pa.record_batch([pa.array([k], pa.int32()), pa.array([i // (2 * PART)], pa.int32()), pa.array([task], pa.int32()), pa.array([_squeezed(part.astype(np.uint64))], pa.binary())], ["k", "part", "task", "data"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(_loose(data, np.uint64) for data in rows["data"])
        return pd.DataFrame({"k": rows["k"].iloc[:1].to_numpy(), "part": rows["part"].iloc[:1].to_numpy(), "task": [int(rows["task"].iloc[0]) // 32], "data": [_squeezed(total)]})

    schema = "k int, part int, task int, data binary"
    # a task should meet many tokens, as each hands on whole tables
    parts = cut(texts.select("train", "lens", "tokens", "words").coalesce(max(1, -(-n_train // TABLE_TOKENS))).mapInArrow(gather, schema), "table-parts")
    while (parts.agg(F.max("task")).first()[0] or 0) > 0:  # sums of 32 at a time, so that no task holds more
        parts = cut(parts.groupBy("k", "part", F.floor(F.col("task") / 32).cast("int").alias("group")).applyInPandas(add, schema), "table-parts")
    tables = [guesses(np.zeros((1, 2)))[0] * np.ones(1 << (bits - SPELT_LESS * (k > 1)), np.int16) for k in range(TABLES)]
    for r in parts.select("k", "part", "data").toLocalIterator():  # bounded by TABLE_BITS
        x = guesses(_loose(r["data"], np.uint64).reshape(-1, 2))
        tables[r["k"]][r["part"] * PART : r["part"] * PART + len(x)] = x
    return tables


def guesses(counts: np.ndarray) -> np.ndarray:
    """Counts of zeros and ones as one number: the stretched guess in tenths, times 8, and the class of how often."""
    counts = counts.astype(np.float64)
    st = np.rint(10 * np.clip(np.log((counts[:, 1] + PRIOR) / (counts[:, 0] + PRIOR)), -12, 12)).astype(np.int16)
    return st * np.int16(8) + np.searchsorted(SEEN, counts.sum(1), side="right").astype(np.int16)


# whole contexts --------------------------------------------------------------------------------------


def sorted_within(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The order of entries sorted by group, by group and then by key."""
    edge = np.r_[True, group[1:] != group[:-1]][: len(group)]
    number = np.cumsum(edge, dtype=np.uint64) << np.uint64(32) | key >> np.uint64(32)
    by = np.argsort(number)
    number = number[by]
    same = np.r_[False, number[1:] == number[:-1]][: len(by)]
    tied = np.flatnonzero(same | np.r_[same[1:], False][: len(by)])  # upper halves of keys are equal
    by[tied] = by[tied][np.lexsort((key[by[tied]], number[tied]))]
    return by


def shared_prefixes(group: np.ndarray, key: np.ndarray, size: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For entries sorted by group and key (a code of size bits from the top bit on, then a rare word's hash): the weight of its group's entries that share its first 0, 1, ..., size bits, one entry after the other; where each begins; and the weight of those with its key."""
    n = len(group)
    first = np.cumsum(size + 1) - size - 1
    out = np.repeat(weight, size + 1)
    if not n:
        return out, first, weight
    apart = key[1:] ^ key[:-1]
    high = (apart >> np.uint64(32)).astype(np.float64)
    common = np.r_[NONE, np.where(group[1:] != group[:-1], NONE, np.where(apart == 0, 99, 32 - np.frexp(high)[1]))]

    def runs(some: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        begin = np.flatnonzero(common[some] < least)
        length = np.diff(np.r_[begin, len(some)])
        return np.repeat(np.add.reduceat(weight[some], begin), length), np.repeat(length > 1, length)

    same = runs(np.arange(n), 99)[0]
    live, j = np.arange(n), 0
    while len(live):
        total, many = runs(live, j)
        out[first[live] + j] = total
        # what stands alone from here on keeps its own weight
        live = live[many & (size[live] > j)]
        j += 1
    return out, first, same


class Entries:
    """The different pairs of a whole context and a word in a slice, sorted by bucket and context; and one entry for each rare word."""

    def __init__(self, part: Slice, vocabulary: Vocabulary, buckets: int):
        rare = hashes(part.rare)
        h = np.r_[vocabulary.hash, rare]
        token = h[part.tokens]
        context = np.zeros(max(len(token) - CONTEXT, 0), np.uint64)
        for k in range(CONTEXT):
            context += token[k : k + len(context)]
            context *= _MIX[k]
            context ^= context >> np.uint64(32)
        self.at = np.flatnonzero(part.place >= CONTEXT)
        context = np.r_[context[self.at - CONTEXT], (rare ^ (rare >> np.uint64(29))) * _MIX[0]]
        # bucket, 39 bits of the context, 1 bit: a rare word's own entry
        c = ((((context >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)) << np.uint64(40)) | ((context & np.uint64((1 << 39) - 1)) << np.uint64(1))
        c[len(self.at) :] |= np.uint64(1)
        names = np.r_[np.arange(vocabulary.escape + 1, dtype=np.uint32), (rare & np.uint64(0x7FFFFFFF) | np.uint64(0x80000000)).astype(np.uint32)]
        name = np.r_[names[part.tokens[self.at]], names[vocabulary.escape + 1 :]]
        odd = part.tokens > vocabulary.escape
        learnt = part.train[part.doc]
        weight = np.r_[learnt[self.at], np.bincount(part.tokens[odd & learnt] - vocabulary.escape - 1, minlength=len(rare))]
        order = np.argsort(c)
        sorted_ = c[order]
        edge = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1], True][: len(order) + 1])
        several = np.repeat(np.diff(edge) > 1, np.diff(edge))
        tied = order[several]  # ties go by key
        order[several] = tied[np.lexsort((keys_of(name[tied], vocabulary), c[tied]))]
        sorted_, name = c[order], name[order]
        new = np.r_[True, (sorted_[1:] != sorted_[:-1]) | (name[1:] != name[:-1])][: len(order)]
        begin = np.flatnonzero(new)
        self.c, self.name = sorted_[begin], name[begin]
        self.weight = np.add.reduceat(weight[order], begin) if len(begin) else weight
        self.places = np.diff(np.r_[begin, len(order)])
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        self.of_place, self.of_rare = of[: len(self.at)], of[len(self.at) :]
        self.cuts = np.searchsorted(self.c >> np.uint64(40), np.arange(buckets + 1, dtype=np.uint64))


def keys_of(name: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    odd = name >= np.uint32(0x80000000)
    return vocabulary.code.word[np.where(odd, vocabulary.escape, name)].astype(np.uint64) << np.uint64(32) | np.where(odd, name, 0).astype(np.uint64)


def sizes_of(name: np.ndarray, c: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    return np.where((c & np.uint64(1)) == 1, 0, vocabulary.code.size[np.where(name >= np.uint32(0x80000000), vocabulary.escape, name)])


def hints(texts: DataFrame, shared, buckets: int) -> DataFrame:
    """slice, bucket, told: for a row of slices and a bucket, for each part None or, for its entries that other parts share, their places among its entries in the bucket, and what shared_prefixes finds over all training documents."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                found = []
                for part in parts_of(batch, i, vocabulary):
                    e = Entries(part, vocabulary, buckets)
                    found.append((e.cuts, e.c & np.uint64((1 << 40) - 1), e.name, e.weight.astype(np.uint32)))
                some = np.flatnonzero(sum(np.diff(f[0]) for f in found))
                asked = []
                for b in some.tolist():
                    cuts = [slice(f[0][b], f[0][b + 1]) for f in found]
                    sizes = np.array([c.stop - c.start for c in cuts], np.int64)
                    asked.append(_joined(sizes, np.concatenate([np.diff(f[1][c], prepend=np.uint64(0)) for f, c in zip(found, cuts, strict=True)]), *(np.concatenate([f[k][c] for f, c in zip(found, cuts, strict=True)]) for k in (2, 3))))
                yield pa.record_batch([pa.array(some), pa.array(np.full(len(some), batch.column("slice")[i].as_py()), pa.int64()), pa.array(asked, pa.binary())], ["bucket", "slice", "asked"])
                del found, asked
                hand_back()

    def answer(rows: pa.Table) -> pa.Table:
        vocabulary, read = shared.value, []
        for blob in rows.column("asked"):
            sizes, c, name, weight = _apart(blob.as_py(), np.int64, np.uint64, np.uint32, np.uint32)
            c = np.cumsum(c, dtype=np.uint64)  # each part's first is whole
            edge = np.cumsum(sizes)[:-1]
            c -= np.repeat(np.r_[np.uint64(0), np.r_[np.uint64(0), c][edge]], sizes)
            read.append((sizes, c, name, weight))
        parts = np.array([len(r[0]) for r in read])
        sizes, c, name, weight = (np.concatenate(x) for x in zip(*read, strict=True))
        del read
        part = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        if len(c) < 1 << 24:  # contexts and places in one number, which sorts sooner
            order = np.sort(c << np.uint64(24) | np.arange(len(c), dtype=np.uint64))
            by = order >> np.uint64(24)
            order &= np.uint64((1 << 24) - 1)
            order = order.view(np.int64)
        else:
            order = np.argsort(c)
            by = c[order]
        edge = np.flatnonzero(np.r_[True, by[1:] != by[:-1]])
        del by
        met = (np.minimum.reduceat(part[order], edge) < np.maximum.reduceat(part[order], edge)) & (np.add.reduceat(weight[order], edge, dtype=np.int64) > 0)
        order = order[np.repeat(met, np.diff(np.r_[edge, len(order)]))]
        key = keys_of(name[order], vocabulary)
        by = sorted_within(c[order], key)
        order, key = order[by], key[by]
        size = sizes_of(name[order], c[order], vocabulary)
        out, first, same = shared_prefixes(c[order], key, size, weight[order].astype(np.int64))
        by = np.empty(len(weight), np.int32)
        by[order] = np.arange(len(order), dtype=np.int32)
        asked = np.zeros(len(weight), bool)
        asked[order] = True
        by = by[asked]  # by part, and by place there
        order, first, size, same = order[by], first[by], size[by], same[by]
        place = order - (np.cumsum(sizes) - sizes)[part[order]]
        cuts = np.searchsorted(part[order], np.arange(len(sizes) + 1)).tolist()
        told = [None if lo == hi else _joined(np.diff(place[lo:hi], prepend=0).astype(np.uint32), out[spans(first[lo:hi], size[lo:hi] + 1)], same[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]
        ends = np.cumsum(parts).tolist()
        lists = [told[end - n : end] for end, n in zip(ends, parts.tolist(), strict=True)]
        some = [i for i, x in enumerate(lists) if any(x)]
        hand_back()
        return pa.table([rows.column("slice").take(pa.array(some, pa.int64())), rows.column("bucket").take(pa.array(some, pa.int64())), pa.array([lists[i] for i in some], pa.list_(pa.binary()))], ["slice", "bucket", "told"])

    asked = texts.select("slice", "train", "lens", "tokens", "words").mapInArrow(ask, "bucket long, slice long, asked binary")
    return asked.groupBy("bucket").applyInArrow(answer, "slice long, bucket long, told array<binary>")


def _joined(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as compressed planes of bytes, all in one."""
    head = np.array([len(x) for x in arrays], np.uint32).tobytes()
    return _zip(head + b"".join(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() for x in arrays))


def _apart(data: bytes, *kinds) -> list[np.ndarray]:
    data = np.frombuffer(_unzip(data), np.uint8)
    at, out = 4 * len(kinds), []
    for n, kind in zip(data[:at].view(np.uint32).tolist(), kinds, strict=True):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T).view(kind).reshape(n))
        at += n * width
    return out


class Foretold:
    """What other documents' places of the same whole context foretell for the tokens of a slice: where each token's counts begin (NONE: no other place), the counts of those that share its first 0, 1, ... bits, those that share all and the word itself; the class of the run of foretold words before; and how often training documents hold each rare word."""

    def __init__(self, part: Slice, vocabulary: Vocabulary, buckets: int, told: list[tuple[int, bytes]]):
        e = Entries(part, vocabulary, buckets)
        n = len(e.c)
        self.known = e.weight[e.of_rare].copy()
        first, same = np.full(n, NONE), np.zeros(n, np.int64)
        pools, begin = [], 0
        new = np.r_[True, e.c[1:] != e.c[:-1]][:n]
        group = np.cumsum(new) - 1
        some = np.flatnonzero((np.bincount(group, e.places) > 1)[group] & (np.bincount(group, e.weight) > 0)[group]) if n else np.empty(0, np.int64)
        if len(some):  # several places of this slice
            pool, at, exact = shared_prefixes(group[some], keys_of(e.name[some], vocabulary), sizes_of(e.name[some], e.c[some], vocabulary), e.weight[some])
            pools.append(pool)
            first[some], same[some], begin = at, exact, len(pool)
        for bucket, blob in told:
            at, pool, exact = _apart(blob, np.uint32, np.int64, np.int64)
            at = np.cumsum(at).astype(np.int64) + e.cuts[bucket]
            size = sizes_of(e.name[at], e.c[at], vocabulary) + 1
            first[at], same[at] = begin + np.cumsum(size) - size, exact
            pools.append(pool)
            begin += len(pool)
        pool = np.concatenate([*pools, np.zeros(1, np.int64)])
        asked = first[e.of_rare] >= 0
        self.known[asked] = same[e.of_rare[asked]]
        # places with counts; a training document's own ones are taken off
        has = np.flatnonzero(first[e.of_place] >= 0)
        of, at = e.of_place[has], e.at[has]
        size, learnt = vocabulary.code.size[part.ids[at]], part.train[part.doc[at]]
        counts = pool[spans(first[of], size + 1)] - np.repeat(learnt.astype(np.int64), size + 1)
        exact = same[of] - learnt
        begin = np.cumsum(size + 1) - size - 1
        pair = group[of] * np.int64(len(part.lens)) + part.doc[at]
        order = np.argsort(pair)
        edge = np.r_[np.flatnonzero(np.r_[True, pair[order[1:]] != pair[order[:-1]]][: len(order)]), len(order)]
        again = order[np.repeat(np.diff(edge) > 1, np.diff(edge))]
        again = again[learnt[again]]
        if len(again):  # a context that stands several times in its document
            again = again[np.lexsort((keys_of(e.name[of[again]], vocabulary), pair[again]))]
            own, own_first, own_same = shared_prefixes(pair[again], keys_of(e.name[of[again]], vocabulary), size[again], np.ones(len(again), np.int64))
            counts[spans(begin[again], size[again] + 1)] -= own - 1
            exact[again] -= own_same - 1
        told = counts[begin] > 0 if len(begin) else np.empty(0, bool)
        self.first, self.exact = np.full(len(part.tokens), NONE), np.zeros(len(part.tokens), np.int64)
        self.first[at[told]] = begin[told]
        self.exact[at[told]] = exact[told]
        self.counts = np.r_[counts, 0].astype(np.float32)
        i = np.arange(len(part.tokens))
        missed = np.maximum.accumulate(np.where((self.exact == 0) | (part.place == 0), i, NONE)) if len(i) else i
        run = np.r_[0, (i - missed)[:-1]][: len(i)]  # words foretold right before; one more if it goes back to a document's first
        run[part.place == 0] = 0
        self.run = np.searchsorted(RUNS, run, side="right")


# scores ----------------------------------------------------------------------------------------------


#: Where weights start. Of a token's bits, by how often the word before was seen: of the word before without and with a whole context, and of the whole context.
BEFORE_ALONE = (0.0, 0.0, 0.02, 0.08, 0.25, 0.35, 0.4, 1.2)
BEFORE = (0.4, 0.5, 0.45, 0.35, 0.3, 0.25, 0.25, 0.2)
FORETOLD = (1.0, 1.1, 1.6, 1.8, 1.7, 1.3, 1.0, 0.85)
#: By the run of foretold words, a factor of the last; and of a spelt word's bit the weight of how often, and the rest.
FORETOLD_RUN = (1.0, 1.05, 0.95, 1.3)
SPELT_RUN = ((-0.7, 0.7, 0.5, 2.0), (-0.3, 1.2, 1.5, 2.5))
#: By how often the frequent word before was seen: of it, and of no context beside it where the word before was seen often.
NEAR_ALONE = (0.25, 0.35, 0.6, 0.9)
PLAIN = (0.4, 0.4, 0.4, 0.2)
#: Of spelt bits, by the classes of five bytes and of three with the frequent word: no context, two, three and five bytes, the word so far, three with the frequent word.
SPELT = (
    (-0.3, -0.2, -0.1, 0.0, 0.0, 0.2, -0.1, 0.05, 0.3),
    (0.6, 0.55, 0.35, 0.35, 0.35, 0.2, 0.15, 0.2, 0.1),
    (0.1, 0.2, 0.5, 0.25, 0.4, 0.35, 0.3, 0.3, 0.15),
    (0.25, 0.25, 0.25, 0.15, 0.25, 0.55, 0.2, 0.3, 0.45),
    (0.2, 0.2, 0.2, 0.2, 0.2, 0.2, 0.25, 0.25, 0.25),
    (0.25, 0.05, 0.1, 0.25, 0.2, 0.4, 0.25, 0.15, 0.4),
)


def first_weights() -> np.ndarray:
    """(4, GATES): where the weights of a token's bits start."""
    w = np.zeros((4, WHOLE, 8, 4), np.float32)
    w[0] = 0.4
    w[0, 0, 4:] = PLAIN
    w[1, 0], w[1, 1:] = NEAR_ALONE, 0.5
    w[2, 0], w[2, 1:] = np.reshape(BEFORE_ALONE, (8, 1)), np.reshape(BEFORE, (8, 1))
    for run, factor in enumerate(FORETOLD_RUN):
        for several in (0, 1):
            w[3, 1 + 2 * run + several] = np.reshape(FORETOLD, (8, 1)) * factor * (0.85 if several else 1)
    return w.reshape(4, GATES)


def first_spelt_weights() -> np.ndarray:
    """(6, SPELT_GATES): where the weights of spelt bits start."""
    return np.repeat(np.array(SPELT, np.float32)[:, None], 8, axis=1).reshape(6, SPELT_GATES)


def first_run_weights() -> np.ndarray:
    """(2, classes of runs): where the weights start of the bit that says that a spelt word is foretold."""
    return np.array(SPELT_RUN, np.float32)


def mixed(weights: np.ndarray, key: np.ndarray, inputs: np.ndarray | list[np.ndarray], rate: float = RATE) -> np.ndarray:
    """Costs of bits in nats, by guesses (an even number of inputs) stretched towards what each bit is; then moves the weights (inputs, keys) along the gradient of the cost. Best are weights and inputs that lie by keys and by bits."""
    x = np.ascontiguousarray(np.transpose(inputs), np.float32)
    k, n = weights.shape
    w = np.take(np.ascontiguousarray(weights.T), key, axis=0)
    w *= x
    # two inputs at a time, as one complex number
    x, w = x.view(np.complex64).T, w.view(np.complex64).T
    z = sum(w[1:], start=w[0])
    z = z.real + z.imag
    np.clip(z, -LIMIT, LIMIT, out=z)
    np.negative(z, out=z)
    np.exp(z, out=z)
    err = (z / (z + np.float32(1))).astype(np.complex64)
    moves, at = np.zeros(n * k // 2, np.complex64), key * (k // 2)
    for j in range(k // 2):
        np.add.at(moves, at, np.multiply(x[j], err, out=w[j]))
        at += 1
    times = np.bincount(key, minlength=n)
    some = np.flatnonzero(times)
    scale = (rate / (times[some] + 16) * 16).astype(np.float32)
    weights.T[some] += moves.view(np.float32).reshape(n, k)[some] * scale[:, None]
    return np.log(z + np.float32(1))


def blocks(longest: int) -> Iterator[tuple[int, int]]:
    at = 0
    while at < longest:
        size = max(BLOCK, at // GROWTH)
        yield at, size
        at += size


class Tables:
    """Tables of guesses, small when sent."""

    def __init__(self, tables: list[np.ndarray]):
        self.tables = tables

    def __getstate__(self) -> list[bytes]:
        return [_squeezed(t) for t in self.tables]

    def __setstate__(self, state: list[bytes]) -> None:
        self.tables = [_loose(t, np.int16) for t in state]


class Scorer:
    """Scores slices of texts; a text's score does not depend on its slice."""

    def __init__(self, vocabulary: Vocabulary, tables: list[np.ndarray]):
        self.vocabulary, self.tables = vocabulary, tables
        self.start = (first_weights(), first_spelt_weights(), first_run_weights())

    @staticmethod
    def _read(found: np.ndarray, sign: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Puts a table's guesses of what bits are to out; the classes of how often they were seen."""
        np.multiply((found >> np.int16(3)) * sign, np.float32(0.1), out=out, dtype=np.float32)
        return found & np.int16(7)

    def costs(self, part: Slice, told: Foretold) -> np.ndarray:
        """The cost of each token of a slice, in nats."""
        spelt = self.vocabulary.spelt(part.rare)
        # of each spelt bit what four tables say
        told_spelt = np.stack([np.take(np.take(t.reshape(-1, 8), lines, axis=0).ravel(), spelt.place) for t, lines in zip(self.tables[2:6], spelt.lines, strict=True)], axis=1).view(np.uint64).ravel()
        bits = part.bits(self.vocabulary)
        out = np.zeros(len(part.tokens))
        order = np.argsort(-part.lens, kind="stable")
        weights = [np.repeat(w.T[None], len(part.lens), axis=0) for w in self.start]
        for b, size in blocks(int(part.lens.max())):
            live = order[: int(np.searchsorted(-part.lens[order], -b, side="left"))]
            sizes = np.minimum(size, part.lens[live] - b)
            chunk = (np.cumsum(sizes) - sizes) // CHUNK
            for lo, hi in zip(*(lambda e: (e[:-1], e[1:]))(np.r_[np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]), len(live)]), strict=True):
                some = live[lo:hi]
                at = spans(part.start[some] + b, sizes[lo:hi])
                mine = [w[some] for w in weights]
                out[at] = self._block(part, told, bits, spelt, told_spelt, at, sizes[lo:hi], [w.reshape(-1, w.shape[2]).T for w in mine])
                for w, m in zip(weights, mine, strict=True):
                    w[some] = m
        return out

    def _block(self, part: Slice, told: Foretold, bits: tuple, spelt: Spelt, told_spelt: np.ndarray, at: np.ndarray, sizes: np.ndarray, weights: list[np.ndarray]) -> np.ndarray:
        """sizes: how many of the tokens are each document's."""
        v = self.vocabulary
        begin, size, bit = bits
        word = part.local[at]
        n = size[word]
        ends = np.cumsum(n)
        node, guess, line, one = loose_bits(np.take(bit, spans(begin[word], n)))
        inputs, sign = np.empty((len(node), 4), np.float32), one * np.int16(2) - np.int16(1)
        inputs[:, 0] = guess
        seen_near = self._read(np.take(self.tables[0], v.slots(node + np.repeat(v.salts[0][part.near[at]], n), line)), sign, inputs[:, 1])
        seen = self._read(np.take(self.tables[1], v.slots(node + np.repeat(v.salts[1][part.before[at]], n), line)), sign, inputs[:, 2])
        inputs[:, 3] = 0
        gate = seen * np.int16(4) + (seen_near >> np.int16(1))
        first = told.first[at]
        hit = np.flatnonzero(first >= 0)
        if len(hit):
            of = spans(ends[hit] - n[hit], n[hit])
            begin = spans(first[hit], n[hit])
            all_, right = np.take(told.counts, begin), np.take(told.counts[1:], begin)
            inputs[of, 3] = np.log((right + np.float32(0.1)) / (all_ - right + np.float32(0.1)))
            kind = np.repeat((1 + 2 * told.run[at[hit]]).astype(np.int16), n[hit]) + (all_ > 1)
            gate[of] += kind * (all_ > 0) * np.int16(32)
        starts = np.cumsum(sizes) - sizes
        key = np.repeat(np.arange(len(sizes)) * GATES, np.add.reduceat(n, starts))
        key += gate
        cost = mixed(weights[0], key, inputs.T)
        total = np.add.reduceat(cost, ends - n, dtype=np.float64)
        odd = np.flatnonzero(part.ids[at] == v.escape)
        if not len(odd):
            return total
        # is an escaped word one that the words before foretell? that many others were escaped, and that many were this word
        doc = np.repeat(np.arange(len(sizes)), sizes)
        place = at[odd]
        asked = np.flatnonzero(told.first[place] >= 0)
        escaped = told.counts[told.first[place[asked]] + v.code.size[v.escape]]
        asked, escaped = asked[escaped > 0], escaped[escaped > 0]
        right = told.exact[place[asked]]
        if len(asked):
            sign = np.where(right > 0, 1, -1).astype(np.float32)
            key = doc[odd[asked]] * (len(RUNS) + 1) + told.run[place[asked]]
            total[odd[asked]] += mixed(weights[2], key, [sign * np.log(escaped + 1), sign])
            yes = right > 0
            total[odd[asked[yes]]] += np.log(escaped[yes] / right[yes])
            odd = np.delete(odd, asked[yes])
            if not len(odd):
                return total
        word = part.tokens[at[odd]] - v.escape - 1
        n = spelt.size[word]
        ends, bit = np.cumsum(n), spans(spelt.first[word], n)
        three, guess, line, one = loose_bits(np.take(spelt.bit, bit))
        inputs, sign = np.empty((len(bit), 6), np.float32), one * np.int16(2) - np.int16(1)
        inputs[:, 0] = guess
        found = [*np.take(told_spelt, bit).view(np.int16).reshape(-1, 4).T, np.take(self.tables[6], v.slots(three + np.repeat(v.salts[0][part.near[at[odd]]], n), line, SPELT_LESS))]
        seen = [self._read(x, sign, inputs[:, k]) for k, x in enumerate(found, 1)]
        gate = (seen[3] * np.int16(3) + _THREE[seen[2]]) * np.int16(3) + _THREE[seen[4]]
        cost = mixed(weights[1], np.repeat(doc[odd] * SPELT_GATES, n) + gate, inputs.T)
        total[odd] += np.add.reduceat(cost, ends - n, dtype=np.float64)
        return total


_THREE = np.array([0, 1, 1, 2, 2, 2, 2, 2], np.int16)


def told_of(told: pa.Table, part: int) -> list[tuple[int, bytes]]:
    """What all buckets told a part of a row."""
    return [(b, blob.as_py()) for b, x in zip(told.column("bucket").to_pylist(), told.column("told"), strict=True) if (blob := x[part]).is_valid]


def vocabulary_of(counts: DataFrame, frequent: int = FREQUENT) -> tuple[Vocabulary, int, int]:
    """From the counts of the training words: the vocabulary, the sum of the counts, and how many words there are."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.where(F.col("c") > 1).orderBy(F.desc("c"), "word").limit(frequent).toArrow()  # at most `frequent` words
    words, many = top.column("word").to_pylist(), top.column("c").to_pylist()
    if END not in words:
        ends = counts.where(F.col("word") == F.lit(bytearray(END))).first()
        words, many = [*words, END], [*many, ends["c"] if ends else 0]

    known = counts.sparkSession.sparkContext.broadcast(frozenset(words))

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256)
        for batch in batches:
            rare = [(w, c) for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if w not in known.value]
            text = np.frombuffer(b"".join(w + b" " for w, _ in rare), np.uint8)
            total += np.bincount(text, np.repeat([c for _, c in rare], [len(w) + 1 for w, _ in rare]) if rare else None, 256)
        yield pa.record_batch([pa.array(range(256), pa.int32()), pa.array(total.tolist(), pa.float64())], ["byte", "c"])

    frequency = np.zeros(256)
    for r in counts.select("word", "c").mapInArrow(letters, "byte int, c double").groupBy("byte").agg(F.sum("c").alias("c")).collect():
        frequency[r["byte"]] = r["c"]
    known.unpersist()
    bits = min(TABLE_BITS, max(14, math.ceil(math.log2(sums["n"] + 1))))
    return Vocabulary(words, np.array(many, np.int64), int(sums["n"]), frequency, bits), int(sums["n"]), int(sums["v"])


@dataclass
class Model:
    """What scores texts: slices of them, what the whole contexts foretell there, and the rest, sent to the executors."""

    texts: DataFrame
    told: DataFrame
    vocabulary: object
    tables: object
    buckets: int
    n_train: int
    n_words: int


def model_of(data: DataFrame, frequent: int = FREQUENT) -> Model:
    """From doc_id, train and text (binary)."""
    context = data.sparkSession.sparkContext
    texts = sliced(data)
    counts = cut(counted_tokens(texts), "token-counts")
    vocabulary, n_train, n_words = vocabulary_of(counts, frequent)
    shared = context.broadcast(vocabulary)
    buckets = max(1, -(-n_train // BUCKET))
    tables = _tables(texts, shared, n_train, vocabulary.bits)
    return Model(texts, hints(texts, shared, buckets), shared, context.broadcast(Tables(tables)), buckets, n_train, n_words)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte for each row of docs."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.coalesce(crc_of_id(F.col("doc_id")) % folds == 0, F.lit(False))
    model = model_of(docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text")).withColumn("train", ~held), frequent)
    vocabulary, tables, buckets, n_train, n_words = model.vocabulary, model.tables, model.buckets, model.n_train, model.n_words

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        own = Scorer(vocabulary.value, tables.value.tables)
        lengths = np.r_[[len(w) + (w != END) for w in own.vocabulary.words], 0].astype(np.int64)
        rows = []
        for k, part in enumerate(parts_of(texts, 0, own.vocabulary)):
            foretold = Foretold(part, own.vocabulary, buckets, told_of(told, k))
            total = -np.add.reduceat(own.costs(part, foretold), part.start) / np.log(10)
            c = np.r_[own.vocabulary.counts, 0, foretold.known][part.tokens]
            base = np.add.reduceat(np.log10((c + 0.1) / (n_train + 0.1 * (n_words + 1))), part.start)
            sizes = np.r_[lengths, np.array([len(w) + 1 for w in part.rare], np.int64)][part.tokens]
            del foretold
            hand_back()
            rows.append((part.lens, np.add.reduceat((c > 0).astype(np.int64), part.start), base, total, np.add.reduceat(sizes, part.start)))
        return pa.table([texts.column("ids").combine_chunks().flatten(), *(pa.array(np.concatenate(x)) for x in zip(*rows, strict=True))], ["doc_id", "n_tokens", "n_known", "base_score", "score", "n_bytes"])

    met = model.texts.drop("counts").groupBy("slice").cogroup(model.told.groupBy("slice")).applyInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    return met.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
