"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

Tokens belong to units: the most frequent tokens and the end mark are units of their own,
all other tokens share ``CLASSES`` units by their last letters. The log-bilinear model
predicts the unit of the next token from the vectors of the tokens before it, and a
smoothed count distribution gives the token within its unit, so token probabilities are
normalised: ``log P(token) = log softmax(context . Q + b)[unit] + log P(token | unit)``.

Counts cover every training token (one shuffle of pre-aggregated hashes). The vectors are
trained on all training documents: each task runs numpy SGD with noise-contrastive
estimation over its texts, and Spark averages the parameters by the tokens behind them.
The ``FREQUENT`` most frequent tokens are broadcast (a fixed number of rows); the others
meet their counts in a join, which keeps hot tokens out of the shuffle. Tokens are told
apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import chunks, run_hashes, text_bytes, words
from tidemark.session import materialize

FREQUENT = 200_000
WHOLE, CLASSES = 190, 64
UNITS = WHOLE + CLASSES + 1
END = UNITS - 1
START = UNITS  # stands before a text, never predicted
END_HASH = np.uint64(0)
ORDER, WIDTH, NOISE, BATCH = 4, 24, 32, 2048
SMOOTH = 0.1


class Counts(NamedTuple):
    """Training counts: the frequent tokens by hash, and the totals of the units."""

    hashes: np.ndarray
    counts: np.ndarray
    units: np.ndarray  # of the frequent tokens
    unit_tokens: np.ndarray
    unit_words: np.ndarray
    n_tokens: int
    n_words: int


class Weights(NamedTuple):
    """Input vectors, output vectors, position weights and output biases."""

    inputs: np.ndarray
    outputs: np.ndarray
    places: np.ndarray
    bias: np.ndarray


def tokenised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and class of each token, the end mark after each text, and the texts' first tokens (n + 1)."""
    text, starts, ends, first = words(data, offsets)
    n = len(offsets) - 1
    bounds = first + np.arange(n + 1)
    hashes = np.full(bounds[-1], END_HASH)
    kinds = np.full(bounds[-1], CLASSES, np.int64)
    if len(starts):
        at = np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(first))
        hashes[at] = np.maximum(run_hashes(text, starts, ends), np.uint64(1))
        last = text[ends - 1].astype(np.int64)
        kinds[at] = (last * 31 + text[np.maximum(ends - 2, starts)] * 7 + (ends - starts > 6)) % CLASSES
    return hashes, kinds, bounds


def count_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``hash, kind, n`` of all tokens and end marks, as a stored table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 4 << 20):
            hashes, kinds, _ = tokenised(*text_bytes(batch.column("text")))
            found, at, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(kinds[at].astype(np.int32)), pa.array(n)],
                                             ["hash", "kind", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "hash long, kind int, n long")
    return materialize(rows.groupBy("hash").agg(F.min("kind").alias("kind"), F.sum("n").alias("n")), "token-counts")


def gather(counted: DataFrame) -> Counts:
    """The bounded part of the counts that every task gets.

    A histogram of at most some hundred bins finds the count above which there are no more
    than ``FREQUENT`` tokens, so no task has to rank the tokens of the others.
    """
    grade = F.floor(F.log2("n") * 8)
    limit, room = None, FREQUENT
    for row in sorted(counted.groupBy(grade.alias("grade")).agg(F.count("*").alias("words")).collect(), reverse=True):
        room -= row.words
        if room < 0:
            break
        limit = row.grade
    top = counted.where(F.lit(False) if limit is None else grade >= limit).toArrow()
    top = top.sort_by([("n", "descending"), ("hash", "ascending")])
    hashes, n = top["hash"].to_numpy().view(np.uint64), top["n"].to_numpy()
    kinds = top["kind"].to_numpy().astype(np.int64)
    tokens, vocabulary = np.zeros(UNITS, np.int64), np.zeros(UNITS, np.int64)
    for row in counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        unit = END if row.kind == CLASSES else WHOLE + row.kind
        tokens[unit], vocabulary[unit] = row.n, row.words
    units = np.where(kinds == CLASSES, END, WHOLE + kinds)
    whole = np.flatnonzero(kinds != CLASSES)[:WHOLE]
    np.subtract.at(tokens, units[whole], n[whole])
    np.subtract.at(vocabulary, units[whole], 1)
    units[whole] = np.arange(len(whole))
    tokens[: len(whole)], vocabulary[: len(whole)] = n[whole], 1
    order = np.argsort(hashes)
    return Counts(hashes[order], n[order], units[order], tokens, vocabulary, int(tokens.sum()), int(vocabulary.sum()))


def looked_up(hashes: np.ndarray, kinds: np.ndarray, counts: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Unit of each token, and its count; -1 where it is not among the frequent ones."""
    units, found = np.where(kinds == CLASSES, END, WHOLE + kinds), np.full(len(hashes), -1, np.int64)
    if len(counts.hashes):
        at = np.minimum(np.searchsorted(counts.hashes, hashes), len(counts.hashes) - 1)
        hit = counts.hashes[at] == hashes
        units[hit], found[hit] = counts.units[at[hit]], counts.counts[at[hit]]
    return units, found


def start_weights(counts: Counts, seed: int = 11) -> Weights:
    rng = np.random.default_rng(seed)
    share = (counts.unit_tokens + 1) / (counts.unit_tokens + 1).sum()
    return Weights(rng.normal(0, 0.3, (UNITS + 1, WIDTH)).astype(np.float32), rng.normal(0, 0.05, (UNITS, WIDTH)).astype(np.float32),
                   np.repeat(0.8 ** np.arange(ORDER), WIDTH).reshape(ORDER, WIDTH).astype(np.float32), np.log(share).astype(np.float32))


def histories(units: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Tokens x ORDER: the units before each token, nearest first."""
    out = np.full((len(units), ORDER), START, np.int64)
    inside = np.arange(len(units)) - np.repeat(bounds[:-1], np.diff(bounds))
    for j in range(ORDER):
        at = np.flatnonzero(inside > j)
        out[at, j] = units[at - j - 1]
    return out


def contexts(history: np.ndarray, w: Weights) -> np.ndarray:
    total = np.zeros((len(history), WIDTH), np.float32)
    for j in range(ORDER):
        total += w.inputs[history[:, j]] * w.places[j]
    return total


def unit_logs(history: np.ndarray, units: np.ndarray, w: Weights) -> np.ndarray:
    """Normalised natural-log probability of each unit after its history."""
    out = np.empty(len(units), np.float32)
    for lo in range(0, len(units), 4096):
        s = contexts(history[lo: lo + 4096], w) @ w.outputs.T + w.bias
        s -= s.max(axis=1, keepdims=True)
        own = s[np.arange(len(s)), units[lo: lo + 4096]]
        out[lo: lo + 4096] = own - np.log(np.exp(s, out=s).sum(axis=1))
    return out


def _sum_by(index: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``rows`` by index: the indices that occur and their sums."""
    order = np.argsort(index.astype(np.uint16), kind="stable")
    sorted_index = index[order]
    start = np.flatnonzero(np.concatenate([[True], sorted_index[1:] != sorted_index[:-1]]))
    return sorted_index[start], np.add.reduceat(rows[order], start, axis=0)


class Trainer:
    """Noise-contrastive SGD with AdaGrad steps over batches of tokens."""

    def __init__(self, weights: Weights, counts: Counts, rate: float = 0.1, seed: int = 5):
        self.w = Weights(*(np.array(x, np.float32) for x in weights))
        self.square = [np.full(x.shape, 0.1, np.float32) for x in self.w]
        self.rng, self.rate, self.seen = np.random.default_rng(seed), rate, 0
        share = (counts.unit_tokens + 1) / (counts.unit_tokens + 1).sum()
        self.edges, self.log_noise = np.cumsum(share), np.log(NOISE * share).astype(np.float32)

    def _step(self, which: int, at, gradient: np.ndarray) -> None:
        self.square[which][at] += gradient * gradient
        self.w[which][at] += self.rate * gradient / np.sqrt(self.square[which][at])

    def learn(self, history: np.ndarray, units: np.ndarray) -> None:
        order = self.rng.permutation(len(units))
        for lo in range(0, len(order), BATCH):
            pick = order[lo: lo + BATCH]
            before, target = history[pick], units[pick]
            context = contexts(before, self.w)
            noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), UNITS - 1)
            q, r = self.w.outputs[target], self.w.outputs[noise]
            real = 1 / (1 + np.exp(np.clip((context * q).sum(axis=1) + self.w.bias[target] - self.log_noise[target], -30, 30)))
            fake = 1 / (1 + np.exp(-np.clip(context @ r.T + self.w.bias[noise] - self.log_noise[noise], -30, 30)))
            scale = np.float32(1 / np.sqrt(len(pick)))
            pull = real[:, None] * q - fake @ r
            index = np.concatenate([target, noise])
            at, total = _sum_by(index, np.concatenate([real[:, None] * context, -(fake.T @ context)]), UNITS)
            _, slope = _sum_by(index, np.concatenate([real, -fake.sum(axis=0)])[:, None], UNITS)
            turns = []
            for j in range(ORDER):
                turns.append((self.w.inputs[before[:, j]] * pull).sum(axis=0))
            rows = [_sum_by(before[:, j], pull, UNITS + 1) for j in range(ORDER)]
            for j, (seen, sums) in enumerate(rows):
                self._step(0, seen, sums * self.w.places[j] * scale)
            self._step(1, at, total * scale)
            self._step(2, slice(None), np.array(turns) * scale * np.float32(0.1))
            self._step(3, at, slope[:, 0] * scale)
            self.seen += len(pick)


def train(docs: DataFrame, counts: Counts, weights: Weights, text_col: str = "text") -> Weights:
    """One pass over all of ``docs``: SGD in every task, parameters averaged by tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((counts, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start = shared.value
        trainer = Trainer(start, known)
        for batch in chunks(batches, "text", 1 << 20):
            hashes, kinds, bounds = tokenised(*text_bytes(batch.column("text")))
            units, _ = looked_up(hashes, kinds, known)
            trainer.learn(histories(units, bounds), units)
        if trainer.seen:
            flat = np.concatenate([x.ravel() for x in trainer.w]).astype(float) * trainer.seen
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), trainer.seen))],
                                             ["place", "value", "tokens"])

    sums = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "place long, value double, tokens long")
    table = sums.groupBy("place").agg((F.sum("value") / F.sum("tokens")).alias("value")).orderBy("place").toArrow()
    if not table.num_rows:
        return weights
    flat, out, at = table["value"].to_numpy().astype(np.float32), [], 0
    for x in weights:
        out.append(flat[at: at + x.size].reshape(x.shape))
        at += x.size
    return Weights(*out)


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", warm_share: int = 16) -> DataFrame:
    """Base and model scores of every row, from whole texts; the model learns where ``learn`` holds.

    Returns ``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score``. Null
    text is empty and has the end mark only. Repeated rows are rows of their own; a null
    ``learn`` counts as false; without training rows all counts are zero. An empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learned"), F.col(text_col).alias("text"))
    training = rows.where("learned")
    counted = count_tokens(training)
    counts = gather(counted)
    weights = start_weights(counts)
    if counts.n_tokens:
        warm = training.where(F.pmod(F.xxhash64("text"), F.lit(warm_share)) == 0)
        weights = train(training, counts, train(warm, counts, weights))
    shared = spark.sparkContext.broadcast((counts, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, w = shared.value
        spread = np.log10(known.unit_tokens + SMOOTH * (known.unit_words + 1))
        for batch in chunks(batches, "text", 1 << 20):
            hashes, kinds, bounds = tokenised(*text_bytes(batch.column("text")))
            units, n = looked_up(hashes, kinds, known)
            model = unit_logs(histories(units, bounds), units, w) / np.log(10) - spread[units]
            frequent = n >= 0
            logs = np.where(frequent, np.log10(np.maximum(n, 0) + SMOOTH), 0.0)
            rare = pa.array(hashes[~frequent].view(np.int64))
            cut = np.concatenate([[0], np.cumsum(np.add.reduceat((~frequent).astype(np.int64), bounds[:-1]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id"), batch.column("learned"), pa.array(np.diff(bounds)),
                 pa.array(np.add.reduceat(frequent.astype(np.int64), bounds[:-1])), pa.array(np.add.reduceat(logs, bounds[:-1])),
                 pa.array(np.add.reduceat(model, bounds[:-1])), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), rare)],
                ["uid", "doc_id", "learned", "n_tokens", "known", "logs", "model", "rare"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    part = rows.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(
        run, f"uid long, doc_id {kind}, learned boolean, n_tokens long, known long, logs double, model double, rare array<long>")
    part = materialize(part, "scored")
    rare = part.select("uid", F.explode("rare").alias("hash")).groupBy("uid", "hash").agg(F.count("*").alias("tf"))
    rare = rare.join(counted.select("hash", "n"), "hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rare = rare.groupBy("uid").agg(F.sum(F.col("tf") * F.log10(F.col("n") + SMOOTH)).alias("rare_logs"),
                                   F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("rare_known"))
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    total = float(np.log10(counts.n_tokens + SMOOTH * (counts.n_words + 1)))
    return part.drop("rare").join(rare, "uid", "left").select(
        "doc_id", "learned", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(counts.n_tokens).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * total).alias("base_score"),
        (logs + F.col("model")).alias("score"))
