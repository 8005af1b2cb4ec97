"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document's features are its different words, hashed, each with the weight
1 / sqrt(their number), and, for each statistic of its structure and each
metadata column, the bin that its value falls into. The score adds a bias,
linear weights and all pairwise interactions, these as dot products of
low-rank vectors by the sum-of-squares identity, in time linear in the number
of features. The model is fitted on the driver on a bounded sample of labelled
rows; scoring covers all rows and whole texts, in Arrow batches.

Defined results: a null text counts as empty; an empty text is scored by its
structure alone; null metadata have a bin of their own; repeated rows have equal
scores; labels of null or without a document are ignored, of contradictory
labels of one document the smaller counts; without labels of both kinds every
score is the smoothed share of label 1; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.media import slices
from terravane.llm.tables import LOWER, crc_of_id, let_go

#: Bound on the labelled rows that the model is fitted on: those of the least hash of their id.
SAMPLE = 12_000
HASHES = 1 << 17
RANK = 8
BINS = 12
EPOCHS = 12
SEED = 5
#: Columns that may be scored besides the text.
METADATA = ("n_chars",)

_LETTERS = bytes(c for c in range(256) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128)
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_PLAIN = _LETTERS + _DIGITS + b" \t\n\r\x0b\x0c.,"
STATISTICS = 18


def features(text: bytes, hashes: int = HASHES) -> tuple[np.ndarray, list[float]]:
    """Hashes of a text's different words, sorted, and its statistics."""
    words = text.translate(LOWER).split()
    different = set(words)
    crc = zlib.crc32
    idx = np.unique(np.fromiter((crc(w) & (hashes - 1) for w in different), np.int32, len(different)))
    n, count = max(1, len(text)), len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = n - len(text.translate(None, _LETTERS))
    long = sum(len(x) for x in different)
    marks = [text.count(m) for m in (b"|", b"!", b".", b",", b"http", b"://")]
    stats = [
        float(np.log1p(len(text))), float(np.log1p(count)), float(np.log1p(len(lines))),
        letters / n, (n - len(text.translate(None, _UPPER))) / max(1, letters), (n - len(text.translate(None, _DIGITS))) / n, len(text.translate(None, _PLAIN)) / n,
        len(different) / max(1, count), len(set(lines)) / max(1, len(lines)), (n - count) / max(1, count), long / max(1, len(different)), max(map(len, words), default=0),
        marks[0] / n, marks[1] / n, marks[2] / max(1, count), marks[3] / max(1, count), (marks[4] + marks[5]) / max(1, count), max(map(len, lines), default=0) / n,
    ]
    return idx, stats


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # HASHES words, then BINS for each statistic and metadata column
    factors: np.ndarray
    edges: np.ndarray  # (statistics, BINS - 2): a bin's upper ends; the last bin is for nulls

    def rows(self, docs: list[tuple[np.ndarray, list[float]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers, weights, and where each document begins."""
        m, base = len(self.edges), len(self.linear) - len(self.edges) * BINS
        stats = np.array([s for _, s in docs], np.float64).reshape(len(docs), m)
        bins = np.empty((len(docs), m), np.int64)
        for k in range(m):
            bins[:, k] = np.where(np.isnan(stats[:, k]), BINS - 1, np.searchsorted(self.edges[k], stats[:, k], side="right"))
        number = base + bins + np.arange(m) * BINS
        idx = np.concatenate([x for i, (words, _) in enumerate(docs) for x in (words, number[i])]).astype(np.int64)
        weight = np.concatenate([x for words, _ in docs for x in (np.full(len(words), 1 / np.sqrt(max(1, len(words)))), np.full(m, 1 / np.sqrt(m)))]).astype(np.float32)
        start = np.cumsum([0] + [len(words) + m for words, _ in docs])[:-1]
        return idx, weight, start

    def raw(self, idx: np.ndarray, weight: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score before the logistic function, and each document's sums of weighted factors."""
        v = self.factors[idx] * weight[:, None]
        sums = np.add.reduceat(v, start)
        pairs = 0.5 * ((sums**2).sum(1) - np.add.reduceat((v**2).sum(1), start))
        return self.bias + np.add.reduceat(self.linear[idx] * weight, start) + pairs, sums

    def score(self, docs: list[tuple[np.ndarray, list[float]]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.rows(docs))[0].astype(np.float64), -30, 30))) if docs else np.empty(0)


def fit(docs: list[tuple[np.ndarray, list[float]]], labels: np.ndarray, m: int, hashes: int = HASHES, rank: int = RANK, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Adagrad on the logistic loss, in small batches of a fixed pseudo-random order."""
    rng = np.random.default_rng(seed)
    size = hashes + m * BINS
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    model = Model(float(np.log(share / (1 - share))), np.zeros(size, np.float32), np.zeros((size, rank), np.float32), np.zeros((m, BINS - 2)))
    if not 0 < labels.sum() < len(labels):
        return model
    stats = np.array([s for _, s in docs], np.float64)
    for k in range(m):
        known = stats[~np.isnan(stats[:, k]), k]
        model.edges[k] = np.quantile(known, np.linspace(0, 1, BINS)[1:-1]) if len(known) else 0
    model.factors = rng.normal(0, 0.05, (size, rank)).astype(np.float32)
    g_linear, g_factors, g_bias = np.full(size, 1e-3, np.float32), np.full((size, rank), 1e-3, np.float32), 1e-3
    rows = [model.rows(docs[i : i + 1])[:2] for i in range(len(docs))]
    rate, decay = 0.1, 2e-4
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for at in range(0, len(docs), 64):
            part = order[at : at + 64]
            idx, weight = (np.concatenate([rows[i][k] for i in part]) for k in (0, 1))
            lens = np.array([len(rows[i][0]) for i in part])
            start = np.cumsum(lens) - lens
            raw, sums = model.raw(idx, weight, start)
            error = np.repeat((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[part]).astype(np.float32), lens)
            v = model.factors[idx]
            d_linear = error * weight + decay * model.linear[idx]
            d_factors = (error * weight)[:, None] * (np.repeat(sums, lens, axis=0) - v * weight[:, None]) + decay * v
            d_bias = float(error[start].mean())
            g_bias += d_bias**2
            model.bias -= rate * d_bias / np.sqrt(g_bias)
            np.add.at(g_linear, idx, d_linear**2)
            np.add.at(g_factors, idx, d_factors**2)
            np.subtract.at(model.linear, idx, rate * d_linear / np.sqrt(g_linear[idx]))
            np.subtract.at(model.factors, idx, rate * d_factors / np.sqrt(g_factors[idx]))
    return model


def _with_metadata(batch: pa.RecordBatch, first: int, metadata: int) -> Iterator[tuple]:
    """Pieces of a batch: the columns before `first`, and features with metadata behind the statistics."""
    let_go()
    for *cols, texts in slices(batch, 4 << 20):
        meta = [[float("nan") if x is None else float(x) for x in c.to_pylist()] for c in cols[first : first + metadata]]
        docs = [(idx, stats + [float(np.log1p(max(0.0, c[i]))) for c in meta]) for i, (idx, stats) in enumerate(map(features, texts))]
        yield cols[:first], docs


def _data(docs: DataFrame, id_col: str, text_col: str, metadata: tuple) -> tuple[DataFrame, int]:
    used = [c for c in metadata if c in docs.columns]
    return docs.select(docs[id_col].alias("doc_id"), *[docs[c].cast("double").alias(f"meta_{i}") for i, c in enumerate(used)], docs[text_col].cast("binary").alias("text")), len(used)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 5, metadata: tuple = METADATA, sample: int = SAMPLE) -> Model:
    """Fitted on at most `sample` labelled rows whose fold (crc32 of the id as text, modulo folds) is not 0; of rows of one id, on that with the smallest words."""
    chosen = (
        labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .where(crc_of_id(F.col("doc_id")) % folds != 0)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    data, n = _data(docs, id_col, text_col, metadata)
    rows = data.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", *[f"meta_{i}" for i in range(n)], "text")  # sample rows of two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (ids, label), found in _with_metadata(batch, 2, n):
                yield pa.record_batch([ids.cast(pa.string()), label, pa.array([f[0].tobytes() for f in found], pa.binary()), pa.array([f[1] for f in found], pa.list_(pa.float64()))], ["doc_id", "label", "words", "stats"])

    # of rows of one id one is learnt, so that the driver gets `sample` rows at most
    one = rows.mapInArrow(run, "doc_id string, label int, words binary, stats array<double>").groupBy("doc_id").agg(F.min(F.struct("words", "stats", "label")).alias("r"))
    found = one.select("doc_id", "r.words", "r.stats", "r.label").toArrow().to_pylist()
    found.sort(key=lambda r: r["doc_id"])
    return fit([(np.frombuffer(r["words"], np.int32), r["stats"]) for r in found], np.array([r["label"] for r in found], np.float64), STATISTICS + n)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, threshold: float = 0.3, metadata: tuple = METADATA) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    data, n = _data(docs, id_col, text_col, metadata)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # HASHES * (RANK + 1) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (ids,), found in _with_metadata(batch, 1, n):
                yield pa.record_batch([ids, pa.array(shipped.value.score(found), pa.float64())], ["doc_id", "score"])

    out = data.mapInArrow(run, f"doc_id {data.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", (crc_of_id(F.col("doc_id")) % folds == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, metadata: tuple = METADATA) -> DataFrame:
    """docs' rows, with all their columns, that score threshold or more."""
    used = [c for c in metadata if c in docs.columns]
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at, meta = names.index(text_col), [names.index(c) for c in used]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slim = pa.record_batch([pa.array(range(batch.num_rows), pa.int64()), *[batch.column(i) for i in meta], batch.column(at).cast(pa.binary())], [str(i) for i in range(2 + len(meta))])
            for (rows,), found in _with_metadata(slim, 1, len(meta)):  # by pieces, so that no batch stands twice
                yield batch.take(rows.filter(pa.array(shipped.value.score(found) >= threshold)))
            del batch, slim  # else they stay while the next is read

    return docs.mapInArrow(run, docs.schema)
