"""Toxicity scores: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: compatibility forms, accents, invisible characters, letters of other
scripts that look Latin, and digits or signs put for letters inside a word. A text becomes its
folded words, each between blanks of its own, so that ``" idi"`` is the start of a word, ``" idiot "``
a whole word, and ``" clown  fish "`` a phrase. One automaton holds the weighted entries and the
exception phrases, whose weight is zero; matching takes the leftmost, longest pattern, so an
exception covers the entries inside it. The weights found, over a power of the text's length,
give the score.

The lexicon is learned from labels: word starts and whole words that are significantly more
frequent in toxic texts become entries, their continuations and neighbours that are not become
exceptions.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import chunks
from tidemark.session import materialize

# Greek and Cyrillic letters that look Latin, and the Latin letters they stand for.
ALIKE = dict(zip("αβεικνορτυχγωаеиіјкмнорсѕтухһԁԛԝвьӏɡɑıⅼ", "abeiknoptuxywaeiijkmhopcstyxhdqwbblgail", strict=True))
# Digits and signs put for letters.
SIGNS = dict(zip("013457@$!|", "oieastasil", strict=True))
INVISIBLE = "­​-‏‪-‮⁠-⁤﻿̀-ͯ︀-️"
HIDDEN = re.compile(f"[{INVISIBLE}]+")
STRANGE = re.compile("[" + "".join(ALIKE) + "]")
#: Signs between letters, or up to two digits, @ or $ before a word, or up to two digits after one.
PUT = re.compile(r"(?<=[^\W\d_])[013457@$!|]+(?=[^\W\d_])|(?<![\w@$])[013457@$]{1,2}(?=[^\W\d_])|(?<=[^\W\d_])[013457]{1,2}(?![\w@$])")
WORD = re.compile(r"[^\W_]+")
SHORT, LONG = 3, 8
FLUSH = 200_000


def fold(text: str | None) -> str:
    """Lower-cased text without disguises."""
    text = text or ""
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFKD", text)).lower()
        text = STRANGE.sub(lambda m: ALIKE[m.group()], text)
    else:
        text = text.lower()
    return PUT.sub(lambda m: "".join(SIGNS[c] for c in m.group()), text)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(fold(text))


def spaced(words: Iterable[str]) -> str:
    """Words between blanks of their own."""
    return "".join(f" {w} " for w in words)


@dataclass
class Lexicon:
    """Patterns over spaced words with their weights; exceptions weigh zero."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    power: float = 0.5
    slope: float = 1.0
    bias: float = 0.0
    #: The score of every text where nothing could be learned.
    constant: float | None = None

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for pattern, weight in {**self.weights, **dict.fromkeys(self.exceptions, 0.0)}.items():
            if pattern.strip():
                found.add_word(pattern, (pattern, weight))
        found.make_automaton()
        return found

    def strength(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        return np.log1p(100 * total / (words + 20.0) ** self.power)

    def scores(self, total: np.ndarray, words: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(total), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * self.strength(total, words), -40, 40)))


def matches(automaton: ahocorasick.Automaton, stream: str) -> Iterator[tuple[int, str, float]]:
    """End, pattern and weight of the leftmost, longest matches, which do not overlap."""
    if not len(automaton):
        return
    found = sorted((end + 1 - len(pattern), -len(pattern), pattern, weight) for end, (pattern, weight) in automaton.iter(stream))
    done = 0
    for start, size, pattern, weight in found:
        if start >= done:
            done = start - size
            yield done, pattern, weight


def weigh(automaton: ahocorasick.Automaton, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text the sum of the weights found and the number of words."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for n, text in enumerate(texts):
        words = words_of(text)
        count[n] = len(words)
        total[n] = sum(weight for _, _, weight in matches(automaton, spaced(words)))
    return total, count


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int, label_col: str) -> DataFrame:
    """``text, label, check`` of at most ``per_label`` ids of either label, chosen by a hash of the id; stored.

    Repeated rows count once. ``check`` marks a quarter that calibrates the score.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
    parts = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * per_label rows: a proven bound
    text = docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "label", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"))
    return materialize(text.select("text", "label", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).alias("check")), "labelled")


def _counted(names: list[str], rows: dict, shape: int) -> pa.RecordBatch:
    columns = [pa.array(list(rows), pa.string()), *(pa.array([v[c] for v in rows.values()], pa.int64()) for c in range(shape))]
    return pa.RecordBatch.from_arrays(columns, names)


def term_counts(sample: DataFrame) -> DataFrame:
    """``term, c0, c1, d0, d1``: how many different words of the texts of either label hold the term, and how many texts.

    The term ``""`` holds all words. Terms are word starts of 3 to 8 characters and whole words.
    """
    names = ["term", "c0", "c1", "d0", "d1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[str, list[int]] = {}
        for batch in chunks(batches, "text"):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = set(words_of(text))
                held = Counter(f" {w[:n]}" for w in words for n in range(SHORT, min(len(w), LONG) + 1))
                held.update(f" {w} " for w in words if len(w) >= SHORT)
                held[""] = len(words)
                for term, count in held.items():
                    row = rows.setdefault(term, [0, 0, 0, 0])
                    row[label] += count
                    row[2 + label] += 1
                if len(rows) > FLUSH:
                    yield _counted(names, rows, 4)
                    rows = {}
        yield _counted(names, rows, 4)

    found = sample.mapInArrow(run, "term string, c0 long, c1 long, d0 long, d1 long")
    return found.groupBy("term").agg(*(F.sum(c).alias(c) for c in names[1:]))


def match_counts(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    """As ``term_counts`` for the patterns of the lexicon as they match, and for the phrases (kind 1) of a match and a neighbour."""
    names = ["kind", "term", "c0", "c1", "d0", "d1"]
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        rows: dict[str, list[int]] = {}
        for batch in chunks(batches, "text"):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                stream = spaced(words_of(text))
                held = set()
                for end, pattern, weight in matches(automaton, stream):
                    stop = stream.find(" ", max(end - 1, 0)) + 1 if not pattern.endswith(" ") else end
                    start = end - len(pattern)
                    held.add(("0" + pattern, stream[start:stop]))
                    if weight:
                        ahead, after = stream.rfind(" ", 0, start - 1) if start else -1, stream.find(" ", stop + 1)
                        held |= {("1" + stream[ahead:stop], "")} if ahead >= 0 else set()
                        held |= {("1" + stream[start: after + 1], "")} if after > 0 else set()
                for term, count in Counter(term for term, _ in held).items():
                    row = rows.setdefault(term, [0, 0, 0, 0])
                    row[label] += count
                    row[2 + label] += 1
                if len(rows) > FLUSH:
                    yield _counted(names[1:], rows, 4)
                    rows = {}
        yield _counted(names[1:], rows, 4)

    found = sample.mapInArrow(run, "term string, c0 long, c1 long, d0 long, d1 long").groupBy("term").agg(*(F.sum(c).alias(c) for c in names[2:]))
    return found.select(F.substring("term", 1, 1).cast("int").alias("kind"), F.expr("substring(term, 2)").alias("term"), *names[2:])


def log_odds(c0: int, c1: int, e0: int, e1: int) -> float:
    """Log ratio of the rates at which words of toxic and of other texts hold a term."""
    return math.log((c1 + 0.5) / (e1 + 1)) - math.log((c0 + 0.5) / (e0 + 1))


def compressed(found: list, e0: int, e1: int, margin: float = 0.5, same: float = 0.98) -> dict[str, float]:
    """Entries whose log odds exceed those of every shorter entry by ``margin``.

    A word start gives way to the longest one that has as good as all its occurrences in toxic texts.
    """
    kept: dict[str, float] = {}
    for r in sorted(found, key=lambda r: (len(r.term), r.term)):
        odds = log_odds(r.c0, r.c1, e0, e1)
        above = max((kept[r.term[:n]] for n in range(len(r.term)) if r.term[:n] in kept), default=0.0)
        if odds >= above + margin:
            kept[r.term] = odds
    count = {r.term: (r.c0, r.c1) for r in found}
    starts = sorted((t for t in count if not t.endswith(" ")), key=len)
    out = {}
    for term in kept:
        longest = max((t for t in starts if t.startswith(term) and count[t][1] >= same * count[term][1]), key=len, default=term)
        out[longest] = log_odds(*count[longest], e0, e1)
    return out


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 4096, max_terms: int = 5000, evidence: float = 20.0, support: int = 3,
        label_col: str = "toxic") -> Lexicon:
    """A lexicon and its calibration from ``labels(doc_id, toxic)``.

    At most ``2 * per_label`` labelled texts are read and ``max_terms`` entries and as many exceptions
    of either kind kept: the bounds of what is counted, collected and broadcast. Entries need a
    likelihood ratio of ``evidence`` and ``support`` toxic texts, exceptions ``support`` other texts.
    The share of toxic labels is counted over all labelled rows with an id. Without labels of both kinds every
    score is the share of toxic labels, or 0.5 without any.
    """
    prior = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).agg(F.avg(label_col)).first()[0]
    sample = labelled_sample(docs, labels, per_label, label_col)
    sizes = {(r.label, r.check): r["count"] for r in sample.groupBy("label", "check").count().collect()}
    if not all(sizes.get((y, False)) for y in (0, 1)):
        return Lexicon({}, constant=0.5 if prior is None else float(prior))
    learn = sample.where("NOT check")
    terms = materialize(term_counts(learn).where(f"d1 >= {support} OR d0 >= {support} OR term = ''"), "terms")
    every = terms.where("term = ''").first()
    e0, e1, n0, n1 = (max(x, 1) for x in (every.c0, every.c1, sizes[0, False], sizes[1, False]))
    share = n1 / (n0 + n1)

    def part(k, expected):
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)

    held = F.col("d0") + F.col("d1")
    rest = F.lit(n0 + n1) - held
    ratio = 2 * (part(F.col("d1"), held * share) + part(F.col("d0"), held * (1 - share))
                 + part(F.lit(n1) - F.col("d1"), rest * share) + part(F.lit(n0) - F.col("d0"), rest * (1 - share)))
    strong = terms.where((F.col("term") != "") & (F.col("d1") >= support) & (F.col("c1") * e0 > F.col("c0") * e1) & (F.col("d1") * n0 > F.col("d0") * n1))
    strong = strong.withColumn("ratio", ratio).where(F.col("ratio") >= evidence).orderBy(F.desc("ratio"), "term").limit(max_terms).collect()
    weights = compressed(strong, e0, e1)
    # Continuations of an entry that are no more toxic than other words.
    starts = sample.sparkSession.createDataFrame([(t,) for t in weights if not t.endswith(" ")], "start string")
    calm = terms.where((F.col("d0") >= support) & (F.log((F.col("c1") + 0.5) / (e1 + 1)) - F.log((F.col("c0") + 0.5) / (e0 + 1)) < 0.7))
    calm = calm.select("*", F.explode(F.expr("transform(sequence(1, length(term) - 1), n -> substring(term, 1, n))")).alias("start"))
    calm = calm.join(starts, "start").groupBy("term").agg(F.max("d0").alias("d0")).orderBy(F.desc("d0"), "term").limit(max_terms).collect()
    first = Lexicon(weights, [r.term for r in calm if r.term not in weights])
    # What the patterns match when the longest one counts decides their weights; calm phrases become exceptions.
    counted = materialize(match_counts(learn, first), "matches")
    weights = {r.term: min(log_odds(r.c0, r.c1, e0, e1), 8.0) for r in counted.where("kind = 0").collect()}
    phrases = counted.where((F.col("kind") == 1) & (F.col("d0") >= support) & (F.col("c0") * e1 >= F.col("c1") * e0))
    phrases = [r.term for r in phrases.orderBy(F.desc("d0"), "term").limit(max_terms).collect()]
    final = Lexicon({t: w if w >= 0.7 else 0.0 for t, w in weights.items()}, phrases)
    return calibrated(final, sample.where("check") if all(sizes.get((y, True)) for y in (0, 1)) else learn, prior)


def calibrated(lexicon: Lexicon, sample: DataFrame, prior: float) -> Lexicon:
    """Length power, slope and bias of a logistic curve that fits the sample's labels, weighted to ``prior``."""
    shared = sample.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in chunks(batches, "text"):
            total, count = weigh(automaton, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(total), pa.array(count)], ["label", "total", "words"])

    found = sample.mapInArrow(run, "label int, total double, words double").toArrow()  # at most the sample's rows, three numbers each
    y, total, words = (found[c].to_numpy().astype(float) for c in ("label", "total", "words"))
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    best = None
    for power in (0.25, 0.5, 0.75, 1.0):
        lexicon.power = power
        slope, bias = _logistic(lexicon.strength(total, words), y, weight)
        z = np.clip(bias + slope * lexicon.strength(total, words), -40, 40)
        loss = float((weight * (np.logaddexp(0, z) - y * z)).sum())
        if best is None or loss < best[0]:
            best = loss, power, slope, bias
    _, lexicon.power, lexicon.slope, lexicon.bias = best
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """Slope (not negative) and bias by Newton steps with a little ridge."""
    design, theta = np.column_stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -40, 40)))
        gradient = design.T @ (weight * (p - y)) + ridge * theta
        step = np.linalg.solve((design.T * (weight * p * (1 - p))) @ design + ridge * np.eye(2), gradient)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(theta[0]), 0.0), float(theta[1])


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, score, total, words`` for every row, from whole texts; no text is shuffled.

    Null text is empty; a text without words or matches has the score of strength zero. Repeated
    rows are scored alike; an empty table gives no rows; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value.automaton()
        for batch in chunks(batches, "text"):
            total, count = weigh(automaton, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(total, count)), pa.array(total), pa.array(count.astype(np.int64))],
                                             ["doc_id", "score", "total", "words"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, total double, words long")
