"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text becomes shape terms (trigrams of character classes, shares of repeated words and
lines, a length band), never its language, source or id. A truncated SVD of a bounded
sample of labelled texts gives the latent space; the sample's vectors and labels, whose
size is fixed by ``per_label``, are broadcast. Every document is scored against all of
them with exact cosine products in blocks, and its nearest neighbours vote with weights
that grow with similarity. No text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import SPACE, chunks, run_hashes, text_bytes

# The character classes.
GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n", ".,;:", "!?",
          "'\"()[]{}<>", "-_/\\|", "@#$%&*+=^~`")
CLASSES = len(GROUPS) + 2  # bytes of longer characters, control bytes
CLASS = np.full(256, CLASSES - 1, np.int64)
CLASS[0x80:] = CLASSES - 2
for _number, _group in enumerate(GROUPS):
    CLASS[np.frombuffer(_group.encode(), np.uint8)] = _number
SHAPES = CLASSES ** 3
REPEATS, LENGTHS = 3, 24
TERMS = SHAPES + REPEATS + LENGTHS


def _shares(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document: the share of runs seen before in it, and of runs equal to the one before."""
    count = np.maximum(np.bincount(doc, minlength=n_docs), 1)
    key = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    again = np.zeros(len(doc), bool)
    again[1:] = key[1:] == key[:-1]
    beside = np.zeros(len(doc), bool)
    beside[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    return (np.bincount((key >> np.uint64(48)).astype(np.int64), again, n_docs) / count, np.bincount(doc, beside, n_docs) / count)


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x TERMS: class-trigram counts, shares of repeats, and a mark for the length band."""
    n = len(offsets) - 1
    out = np.zeros((n, TERMS), np.float32)
    size = np.diff(offsets)
    out[np.arange(n), SHAPES + REPEATS + np.minimum(np.frexp(size.astype(float))[1], LENGTHS - 1)] = 1
    if not len(data):
        return out
    code = CLASS[data]
    tri = code[:-2] * (CLASSES * CLASSES) + code[1:-1] * CLASSES + code[2:]
    for k in range(n):
        if size[k] >= 3:
            out[k, :SHAPES] = np.bincount(tri[offsets[k]: offsets[k + 1] - 2], minlength=SHAPES)
    doc = np.repeat(np.arange(n), size)
    edge = np.ones(len(data), bool)
    edge[1:] = doc[1:] != doc[:-1]
    solid = ~SPACE[data]
    for at, gap in ((SHAPES, ~solid), (SHAPES + 2, data == 0x0A)):
        begin = ~gap
        begin[1:] &= gap[:-1] | edge[1:]
        end = ~gap
        end[:-1] &= gap[1:] | edge[1:]
        start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        before, beside = _shares(run_hashes(data, start, stop), doc[start], n) if len(start) else (0.0, 0.0)
        out[:, at] = before
        if at == SHAPES:
            out[:, at + 1] = beside
    return out


def leading_directions(square: np.ndarray, rank: int, extra: int = 16, rounds: int = 60) -> np.ndarray:
    """The ``rank`` leading eigenvectors of a symmetric matrix without negative eigenvalues.

    Block subspace iteration from a fixed start, then a small eigenproblem inside the subspace:
    a full one would take several more matrices of memory on the driver.
    """
    width = min(len(square), rank + extra)
    basis = np.linalg.qr(np.random.default_rng(0).normal(size=(len(square), width)).astype(square.dtype))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(square @ basis)[0]
    _, inner = np.linalg.eigh((basis.T @ (square @ basis)).astype(float))
    return np.ascontiguousarray((basis @ inner)[:, ::-1][:, :rank], np.float32)


class LatentVotes:
    """Term weights, the latent projection and the labelled vectors."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, prior: float, rank: int, neighbours: int, sharpness: float):
        # In slices, so that the driver holds one copy of the sample besides the square matrix.
        parts = [counts[at: at + 512] for at in range(0, len(counts), 512)]
        used = sum((p[:, :SHAPES] > 0).sum(axis=0) for p in parts) / len(counts)
        self.weight = np.where(used > 0, np.log1p(1 / np.maximum(used, 1e-9)), 0).astype(np.float32)
        self.neighbours, self.sharpness = min(neighbours, len(labels)), sharpness
        square = np.zeros((TERMS, TERMS), np.float32)
        for part in parts:
            x = self.weighted(part)
            square += x.T @ x
        self.projection = leading_directions(square, rank)
        self.vectors = np.concatenate([self.latent(p) for p in parts])
        share = labels.mean()
        # The sample has as many rows of either label; votes count as in the whole labelled table.
        self.good = labels * (prior / share if share else 1)
        self.bad = (1 - labels) * ((1 - prior) / (1 - share) if share < 1 else 1)
        self.prior = prior

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        shapes = counts[:, :SHAPES]
        total = np.maximum(shapes.sum(axis=1, keepdims=True), 1)
        shapes = np.sqrt(shapes / total) * self.weight
        shapes /= np.maximum(np.linalg.norm(shapes, axis=1, keepdims=True), 1e-9)
        extra = counts[:, SHAPES:].copy()
        extra[:, :REPEATS] = np.sqrt(extra[:, :REPEATS])
        extra[:, REPEATS:] *= 0.2
        return np.hstack([shapes, extra]).astype(np.float32)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        z = self.weighted(counts) @ self.projection
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        cosine = self.latent(counts) @ self.vectors.T
        near = np.argpartition(-cosine, self.neighbours - 1, axis=1)[:, : self.neighbours]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(float)
        top = np.maximum(weight.max(axis=1, keepdims=True), 1e-9)
        weight = (weight / top) ** self.sharpness
        good, bad = (weight * self.good[near]).sum(axis=1), (weight * self.bad[near]).sum(axis=1)
        return (good + self.prior) / (good + bad + 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int, label_col: str = "quality") -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``per_label`` rows of either label, chosen by a hash of the id."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
    parts = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])  # at most 2 * per_label rows: a proven bound

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            counts = term_counts(*text_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([row.tobytes() for row in counts.astype(np.float32)])],
                ["doc_id", "label", "counts"])

    text = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    kind = text.schema["doc_id"].dataType.simpleString()
    table = text.mapInArrow(run, f"doc_id {kind}, label int, counts binary").orderBy("doc_id").toArrow()
    marks = table["label"].to_numpy().astype(float)
    counts = np.empty((len(marks), TERMS), np.float32)
    for n, row in enumerate(table["counts"]):
        counts[n] = np.frombuffer(row.as_buffer(), np.float32)
    return counts, marks


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 2048, rank: int = 48, neighbours: int = 25,
        sharpness: float = 6.0, label_col: str = "quality") -> LatentVotes | None:
    """Learn from ``labels(doc_id, quality)``; None without a labelled document.

    At most ``2 * per_label`` labelled texts are read: the bound of what is broadcast.
    The share of either label is counted over all labelled rows.
    """
    counts, marks = labelled_sample(docs, labels, per_label, label_col)
    if not len(marks):
        return None
    prior = labels.where(F.col(label_col).isin(0, 1)).agg(F.avg(label_col)).first()[0]
    return LatentVotes(counts, marks, prior, rank, neighbours, sharpness)


def score(docs: DataFrame, model: LatentVotes | None) -> DataFrame:
    """``doc_id, text_hash, score`` for every row, from whole texts.

    Null text is empty; empty texts have a length band and so are scored like others.
    Without a model every score is 0.5. Repeated rows are scored alike; an empty table
    gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                if shared.value is None:
                    marks = np.full(part.num_rows, 0.5)
                else:
                    marks = shared.value.scores(term_counts(*text_bytes(part.column("text"))))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), pa.array(marks)],
                                                 ["doc_id", "text_hash", "score"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, score double")
