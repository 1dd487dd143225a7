"""Base scores against brute force; the model is normalised and better than the base."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import lm, queries
from tidemark.llm.arrow import text_bytes

SF = "/root/testdata/sf0.01"


def slow_tokens(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def slow_base(rows):
    """rows: (doc_id, text, learned); returns n_tokens, n_known, train_tokens, base_score by id."""
    seen = Counter(t for _, text, learned in rows if learned for t in slow_tokens(text))
    n, v = sum(seen.values()), len(seen)
    out = {}
    for i, text, _ in rows:
        tokens = slow_tokens(text)
        out[i] = (len(tokens), sum(seen[t] > 0 for t in tokens), n, sum(math.log10((seen[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens))
    return out


def test_query_equals_brute_force_and_beats_the_base(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 500)  # so that most tokens meet their counts in the join
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    learned = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 != 0 for r in docs}
    wanted = slow_base([(r.doc_id, r.text, learned[r.doc_id]) for r in docs])
    rows = queries.op6_lm_score(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, known, train, base = wanted[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, train, not learned[r.doc_id])
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
    held = [r for r in rows if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / tokens > sum(r.base_score for r in held) / tokens + 0.1


def test_probabilities_sum_to_one():
    texts = ["the cat and the dog", "der hund und die katze", "the the the", ""]
    hashes, kinds, bounds = lm.tokenised(*text_bytes(pa.array(texts)))
    found, at, n = np.unique(hashes, return_index=True, return_counts=True)
    tokens, vocabulary = np.zeros(lm.UNITS, int), np.zeros(lm.UNITS, int)
    units = np.where(kinds[at] == lm.CLASSES, lm.END, lm.WHOLE + kinds[at])
    np.add.at(tokens, units, n)
    np.add.at(vocabulary, units, 1)
    counts = lm.Counts(found, n, units, tokens, vocabulary, int(n.sum()), len(n))
    trainer = lm.Trainer(lm.start_weights(counts), counts)
    for _ in range(5):
        trainer.learn(lm.histories(lm.looked_up(hashes, kinds, counts)[0], bounds), lm.looked_up(hashes, kinds, counts)[0])
    history = np.repeat(np.array([[3, lm.START, lm.START, lm.START]]), lm.UNITS, axis=0)[:, : lm.ORDER]
    unit = np.exp(lm.unit_logs(history, np.arange(lm.UNITS), trainer.w).astype(float))
    assert abs(unit.sum() - 1) < 1e-4
    inside = [(n[units == u] + lm.SMOOTH).sum() + lm.SMOOTH for u in range(lm.UNITS)]  # one place for unseen tokens
    assert np.allclose(inside, tokens + lm.SMOOTH * (vocabulary + 1))


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "word"), (3, " A\tb\n" * 3), (4, "é" * 300 + " x"), (5, "w " * 30000)]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    found = sorted(lm.score(docs, F.col("doc_id") != 3).collect(), key=lambda r: (r.doc_id or 0, r.n_tokens))
    wanted = slow_base([(n, t, i not in (None, 3)) for n, (i, t) in enumerate(rows)])
    key = sorted(range(len(rows)), key=lambda n: (rows[n][0] or 0, wanted[n][0]))
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in found] == [wanted[n][:3] for n in key]
    assert np.allclose([r.base_score for r in found], [wanted[n][3] for n in key])
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    none = lm.score(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)
    assert lm.score(docs.limit(0), F.lit(True)).collect() == []
