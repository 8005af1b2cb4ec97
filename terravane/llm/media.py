"""Media columns: texts stored losslessly as baseline JPEG, and a DC-only reader for any baseline JPEG.

A payload byte v becomes one 8x8 block of constant brightness v: its DC
coefficient is 8 (v - 128), quantised by 8, and its AC part is a lone
end-of-block, so the DC-only thumbnail of the stored form is the payload
itself. Every row of blocks is one restart interval, so that the reader
decodes all rows of all pictures of a batch side by side in numpy.

Defined results: a null text counts as empty; an empty text is one row of
spaces; equal texts give equal media. A text too long for one picture (8191
rows) goes on in further pictures, one behind the other in the same column.
Repeated rows each give a row; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.tables import hand_back

ROW = 192
MAX_ROWS = 8191
#: Payload bytes coded or read at once, which bounds a worker's memory.
CHUNK = 1 << 20

#: The DC luminance code of the JPEG standard, as counts of codes by length 1 to 16, then categories in order of code.
DC_COUNTS = bytes([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0])
DC_SYMBOLS = bytes(range(12))
#: The AC code that is written: end-of-block alone, in one bit.
AC_COUNTS = bytes([1] + [0] * 15)
AC_SYMBOLS = bytes([0])


def canonical(counts: bytes, symbols: bytes) -> list[tuple[int, int, int]]:
    """(symbol, code, length) for each code of a Huffman table."""
    out, code, at = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((symbols[at], code, length))
            code, at = code + 1, at + 1
        code <<= 1
    return out


def lookup(counts: bytes, symbols: bytes) -> np.ndarray:
    """By the next 16 bits: length * 256 + symbol; 0 where no code fits."""
    table = np.zeros(1 << 16, np.int64)
    for symbol, code, length in canonical(counts, symbols):
        table[code << (16 - length) : (code + 1) << (16 - length)] = length * 256 + symbol
    return table


def _difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """Code and length of a whole block, by its DC difference + 255."""
    codes, lengths = np.zeros(511, np.uint64), np.zeros(511, np.int64)
    table = {s: (c, n) for s, c, n in canonical(DC_COUNTS, DC_SYMBOLS)}
    for d in range(-255, 256):
        size = abs(d).bit_length()
        code, n = table[size]
        extra = d if d >= 0 else d + (1 << size) - 1
        codes[d + 255], lengths[d + 255] = ((code << size) | extra) << 1, n + size + 1
    return codes, lengths


CODES, LENGTHS = _difference_codes()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(width: int, rows: int) -> bytes:
    return (
        b"\xff\xd8"
        + _segment(0xDB, bytes([0, 8] + [1] * 63))
        + _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, width * 8, 1) + bytes([1, 0x11, 0]))
        + _segment(0xC4, bytes([0x00]) + DC_COUNTS + DC_SYMBOLS)
        + _segment(0xC4, bytes([0x10]) + AC_COUNTS + AC_SYMBOLS)
        + _segment(0xDD, struct.pack(">H", width))
        + _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))
    )


def pad(text: bytes, row: int = ROW) -> bytes:
    return text + b" " * (row - len(text) if len(text) < row else -len(text) % row)


def encode_rows(samples: np.ndarray, last: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coded rows of blocks, each with the marker that follows it, and where each ends. last: whether a row ends its picture; number: its place in it."""
    n, width = samples.shape
    diff = np.empty((n, width), np.int16)
    diff[:, 0] = samples[:, 0].astype(np.int16) - 128
    np.subtract(samples[:, 1:], samples[:, :-1], out=diff[:, 1:], dtype=np.int16)
    diff += 255
    length = np.empty((n, width + 1), np.int64)
    length[:, :width] = LENGTHS[diff]
    fill = -length[:, :width].sum(1) % 8
    length[:, width] = fill
    code = np.empty((n, width + 1), np.uint64)
    code[:, :width] = CODES[diff]
    code[:, width] = (1 << fill) - 1
    flat, code = length.ravel(), code.ravel()
    ends = np.cumsum(flat)
    start = ends - flat
    shift = 64 - (start & 31) - flat
    value = code << np.where(flat == 0, 0, shift).astype(np.uint64)
    word = start >> 5
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    sums = np.add.reduceat(value, first)
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[first]] += sums >> np.uint64(32)
    out[word[first] + 1] += sums & np.uint64(0xFFFFFFFF)
    total = int(ends[-1]) // 8
    data = out.astype(">u4").view(np.uint8)[:total]
    row_bytes = (length.sum(1) // 8).astype(np.int64)
    stuffed = data == 255
    place = np.arange(total) + np.cumsum(stuffed) - stuffed + 2 * np.repeat(np.arange(n), row_bytes)
    final = np.cumsum(row_bytes) - 1
    after = place[final] + 1 + stuffed[final]
    done = np.zeros(int(after[-1]) + 2, np.uint8)
    done[place] = data
    done[after] = 255
    done[after + 1] = np.where(last, 0xD9, 0xD0 + number % 8)
    return done, after + 2


def encode_payloads(payloads: list[bytes], row: int = ROW) -> list[bytes]:
    """The stored form of each payload; their sizes are multiples of row."""
    pictures, owner = [], []
    for i, p in enumerate(payloads):
        for at in range(0, len(p), row * MAX_ROWS):
            pictures.append(p[at : at + row * MAX_ROWS])
            owner.append(i)
    rows = np.array([len(p) // row for p in pictures], np.int64)
    samples = np.frombuffer(b"".join(pictures), np.uint8).reshape(-1, row)
    ends = np.cumsum(rows)
    last = np.zeros(len(samples), bool)
    last[ends - 1] = True
    number = np.arange(len(samples)) - np.repeat(ends - rows, rows)
    parts: list[bytes] = []
    step = max(1, CHUNK // row)
    cuts = np.empty(len(samples), np.int64)
    base = 0
    for at in range(0, len(samples), step):
        s = slice(at, at + step)
        coded, after = encode_rows(samples[s], last[s], number[s])
        cuts[s] = after + base
        base += len(coded)
        parts.append(coded.tobytes())
    scans = b"".join(parts)
    out: list[list[bytes]] = [[] for _ in payloads]
    begin = 0
    for i, n, end in zip(owner, rows, cuts[ends - 1], strict=True):
        out[i].append(header(row, int(n)) + scans[begin:end])
        begin = end
    return [b"".join(x) for x in out]


SCAN_END = re.compile(rb"\xff[^\x00\xff\xd0-\xd7]", re.S)


def parse(media: bytes) -> list[dict]:
    """The pictures that a stored form holds, by their markers: tables, sizes, and where each scan lies."""
    found: list[dict] = []
    at = 0
    while at < len(media):
        if media[at : at + 2] != b"\xff\xd8":
            raise ValueError("no start of image where one is due")
        at += 2
        picture: dict = {"q": {}, "dc": {}, "ac": {}, "restart": 0}
        while True:
            if at + 2 > len(media) or media[at] != 0xFF:
                raise ValueError("no marker where one is due")
            marker = media[at + 1]
            if marker == 0xFF:
                at += 1
                continue
            if marker == 0xD9:
                at += 2
                break
            (size,) = struct.unpack_from(">H", media, at + 2)
            body = media[at + 4 : at + 2 + size]
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    picture["q"][body[0] & 15] = struct.unpack_from(">H", body, 1)[0] if wide else body[1]
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xC4:
                while body:
                    counts = body[1:17]
                    n = sum(counts)
                    picture["ac" if body[0] >> 4 else "dc"][body[0] & 15] = (counts, body[17 : 17 + n])
                    body = body[17 + n :]
            elif marker in (0xC0, 0xC1):
                bits, height, width, n = struct.unpack_from(">BHHB", body)
                if bits != 8:
                    raise ValueError("only 8-bit samples are read")
                picture |= {"height": height, "width": width, "parts": [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]}
            elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
                raise ValueError("not a baseline picture")
            elif marker == 0xDD:
                (picture["restart"],) = struct.unpack(">H", body)
            elif marker == 0xDA:
                use = {body[1 + 2 * k]: (body[2 + 2 * k] >> 4, body[2 + 2 * k] & 15) for k in range(body[0])}
                if len(use) != len(picture["parts"]):
                    raise ValueError("only interleaved scans are read")
                end = SCAN_END.search(media, at)
                if not end:
                    raise ValueError("a scan without an end")
                picture |= {"use": use, "scan": (at, end.start())}
                at = end.start()
        found.append(picture)
    return found


def _layout(p: dict) -> tuple:
    """What pictures must share to be decoded side by side."""
    return (tuple(p["parts"]), tuple(sorted(p["use"].items())), p["restart"], p["width"] if p["restart"] == 0 or len(p["parts"]) > 1 else 0, tuple(sorted(p["q"].items())), tuple(sorted(p["dc"].items())), tuple(sorted(p["ac"].items())))


def _shape(p: dict) -> tuple[int, int, int, int]:
    """MCUs in a row and in a column; blocks of the first part in an MCU, across and down."""
    if len(p["parts"]) == 1:
        return -(-p["width"] // 8), -(-p["height"] // 8), 1, 1
    h, v = max(x[1] for x in p["parts"]), max(x[2] for x in p["parts"])
    return -(-p["width"] // (8 * h)), -(-p["height"] // (8 * v)), p["parts"][0][1], p["parts"][0][2]


def decode_scans(pictures: list[dict], scans: list[bytes]) -> list[np.ndarray]:
    """DC-only luminance of pictures of one layout: an array of bytes each, one for a block."""
    data = np.frombuffer(b"".join(s + b"\xff\xd0" for s in scans), np.uint8)
    ff = np.flatnonzero(data[:-1] == 255)
    then = data[ff + 1]
    marks = ff[(then >= 0xD0) & (then <= 0xD7)]
    keep = np.ones(len(data), bool)
    keep[ff[then == 0] + 1] = False
    keep[marks] = keep[marks + 1] = False
    clean = np.concatenate([data[keep], np.full(8, 255, np.uint8)]).astype(np.int64)
    lane_end = np.cumsum(keep)[marks]
    lane_start = np.r_[0, lane_end[:-1]]
    window = (clean[:-4] << 32) | (clean[1:-3] << 24) | (clean[2:-2] << 16) | (clean[3:-1] << 8) | clean[4:]
    first = pictures[0]
    shapes = [_shape(p) for p in pictures]
    counts = [w * h for w, h, _, _ in shapes]
    step = first["restart"]
    sizes = np.concatenate([np.full(-(-c // step), step, np.int64) if step else np.array([c]) for c in counts])
    if step:
        sizes[np.cumsum([-(-c // step) for c in counts]) - 1] -= [-c % step for c in counts]
    if len(sizes) != len(lane_end):
        raise ValueError("restart markers don't match the size of the picture")
    blocks = [(k, *first["use"][part[0]]) for k, part in enumerate(first["parts"]) for _ in range(part[1] * part[2] if len(first["parts"]) > 1 else 1)]
    luma = sum(b[0] == 0 for b in blocks)
    dc = {i: lookup(*t) for i, t in first["dc"].items()}
    ac = {i: lookup(*t) for i, t in first["ac"].items()}
    half, low, mask = np.array([0] + [1 << (s - 1) for s in range(1, 17)]), np.array([0] + [1 - (1 << s) for s in range(1, 17)]), np.array([(1 << s) - 1 for s in range(17)])
    order = np.argsort(-sizes, kind="stable")
    pos, left = lane_start[order] * 8, sizes[order]
    previous = np.zeros((len(first["parts"]), len(order)), np.int64)
    out = np.zeros((len(order), int(left[0]) if len(left) else 0, luma), np.int64)
    at = 0
    for m in range(out.shape[1]):
        n = int(np.searchsorted(-left, -m, side="left"))  # lanes that have an MCU of this number
        p = pos[:n]
        at = 0
        for part, use_dc, use_ac in blocks:
            x, bit = window[p >> 3], p & 7
            got = dc[use_dc][(x >> (24 - bit)) & 0xFFFF]
            size = got & 255
            used = (got >> 8) + size
            if not got.all():
                raise ValueError("no such Huffman code")
            extra = (x >> (40 - bit - used)) & mask[size]
            previous[part, :n] += extra + np.where(extra < half[size], low[size], 0)
            p = p + used
            if part == 0:
                out[:n, m, at] = previous[0, :n]
                at += 1
            going, k = None, np.ones(n, np.int64)
            while True:
                q = p if going is None else p[going]
                x, bit = window[q >> 3], q & 7
                got = ac[use_ac][(x >> (24 - bit)) & 0xFFFF]
                if not got.all():
                    raise ValueError("no such Huffman code")
                symbol = got & 255
                moved = q + (got >> 8) + (symbol & 15)
                if going is None:
                    p = moved
                else:
                    p[going] = moved
                if not symbol.any():
                    break
                lanes = np.arange(n) if going is None else going
                k[lanes] += (symbol >> 4) + 1
                going = lanes[((symbol & 15 != 0) | (symbol == 0xF0)) & (k[lanes] < 64)]
                if not len(going):
                    break
        pos[:n] = p
    if (pos > lane_end[order] * 8).any():
        raise ValueError("a scan is cut short")
    quant = first["q"][first["parts"][0][3]]
    back = np.empty_like(out)
    back[order] = out
    level = np.clip((back * quant + 4) // 8 + 128, 0, 255).astype(np.uint8)
    lanes = np.cumsum([0] + [-(-c // step) if step else 1 for c in counts])
    result = []
    for i, (w, h, across, down) in enumerate(shapes):
        mcus = level[lanes[i] : lanes[i + 1]].reshape(-1, luma)[: w * h]
        grid = mcus.reshape(h, w, down, across).transpose(0, 2, 1, 3).reshape(h * down, w * across)
        result.append(grid[: -(-pictures[i]["height"] // 8), : -(-pictures[i]["width"] // 8)])
    return result


def decode_media(stored: list[bytes]) -> list[list[np.ndarray]]:
    """The DC-only thumbnails of each stored form's pictures."""
    out: list[list] = []
    waiting: dict[tuple, list] = {}

    def run(group: list) -> None:
        for (i, k, _, _), grid in zip(group, decode_scans([g[2] for g in group], [g[3] for g in group]), strict=True):
            out[i][k] = grid

    held: dict[tuple, int] = {}
    for i, media in enumerate(stored):
        pictures = parse(media)
        out.append([None] * len(pictures))
        for k, p in enumerate(pictures):
            key = _layout(p)
            waiting.setdefault(key, []).append((i, k, p, media[slice(*p["scan"])]))
            held[key] = held.get(key, 0) + p["scan"][1] - p["scan"][0]
            if held[key] >= CHUNK:
                run(waiting.pop(key))
                held[key] = 0
    for group in waiting.values():
        run(group)
    return out


def average_hash(grid: np.ndarray) -> str:
    """64 bits: whether each of 8 x 8 areas of a thumbnail is brighter than their mean."""
    if not grid.size:
        return "0" * 16
    sums = np.add.reduceat(np.add.reduceat(grid.astype(np.int64), np.arange(8) * grid.shape[0] // 8, axis=0), np.arange(8) * grid.shape[1] // 8, axis=1)
    rows, cols = (np.maximum(1, np.diff(np.r_[np.arange(8) * n // 8, n])) for n in grid.shape)
    mean = sums / (rows[:, None] * cols[None, :])
    return np.packbits((mean > mean.mean()).ravel()).tobytes().hex()


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: int = ROW) -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes, padded with spaces to a positive multiple of row, as baseline JPEG."""
    data = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in slices(batch, 4 * CHUNK):
                yield pa.record_batch([ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(encode_payloads([pad(t, row) for t in texts], row), pa.binary())], ["doc_id", "n_bytes", "media"])

    return data.mapInArrow(run, f"doc_id {data.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def slices(batch: pa.RecordBatch, most: int) -> Iterator[tuple]:
    """A batch in pieces of about most bytes of its last column: other columns as they are, the last as bytes."""
    begin, size, held = 0, 0, []
    for i, value in enumerate(batch.column(batch.num_columns - 1)):
        held.append(value.as_py() or b"")
        size += len(held[-1])
        if size >= most:
            yield *(c.slice(begin, i + 1 - begin) for c in batch.columns[:-1]), held
            begin, size, held = i + 1, 0, []
    if held:
        yield *(c.slice(begin) for c in batch.columns[:-1]), held
    held = None
    hand_back()


def read_media(stored: DataFrame, payload: bool = False) -> DataFrame:
    """Parses and decodes the column media: dimensions, thumbnail hash and digests of what was read back; payload: the thumbnail's bytes too."""
    kind = stored.schema["doc_id"].dataType.simpleString()
    data = stored.select("doc_id", "n_bytes", "media")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, media in slices(batch, 4 * CHUNK):
                grids = decode_media(media)
                back = [b"".join(g.tobytes() for g in x) for x in grids]
                cols = [
                    ids,
                    sizes,
                    pa.array([len(b) for b in back], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in back]),
                    pa.array([zlib.crc32(b[-16:]) for b in back], pa.int64()),
                    pa.array([len(m) for m in media], pa.int64()),
                    pa.array([hashlib.sha256(m).hexdigest() for m in media]),
                    pa.array([f"{8 * x[0].shape[1]}x{8 * sum(len(g) for g in x)}:{average_hash(x[0] if len(x) == 1 else np.concatenate(x))}" for x in grids]),
                ]
                if payload:
                    cols.append(pa.array(back, pa.binary()))
                yield pa.record_batch(cols, names)

    schema = f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", payload binary" * payload
    names = [x.split()[0] for x in schema.split(", ")]
    return data.mapInArrow(run, schema)
