"""Held-out accuracy of the quality classifier, and its votes against brute force."""

import zlib

import numpy as np
import pyarrow as pa

from tidemark.llm import quality, queries
from tidemark.llm.arrow import text_bytes

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in queries.op2_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(found[r.doc_id].held_out for r in held) and not all(r.held_out for r in found.values())
    good = [found[r.doc_id].score for r in held if r.quality == 1]
    bad = [found[r.doc_id].score for r in held if r.quality == 0]
    assert bad and np.mean([[g > b for b in bad] for g in good]) > 0.97
    assert np.mean([found[r.doc_id].predicted == r.quality for r in held]) > 0.95
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_votes_equal_brute_force():
    texts = ["some plain words here. And more.", "A!! B!! C!!", "x | y | z |", "dup dup dup dup", "", "Then a longer text follows.\nWith lines."] * 3
    counts = quality.term_counts(*text_bytes(pa.array(texts)))
    labels = np.array([1, 0, 0, 0, 1, 1] * 3, float)
    model = quality.LatentVotes(counts, labels, 0.6, 8, 5, 3.0)
    z = [model.latent(counts[i:i + 1])[0] for i in range(len(texts))]
    for i, s in enumerate(model.scores(counts)):
        cosine = [float(z[i] @ v) for v in z]
        near = sorted(range(len(texts)), key=lambda j: -cosine[j])[:5]
        if cosine[near[-1]] - sorted(cosine)[-6] < 1e-6:
            continue  # a tie at the border may be cut either way
        w = [(max(cosine[j], 0) / max(cosine)) ** 3 for j in near]
        good, bad = sum(a * model.good[j] for a, j in zip(w, near)), sum(a * model.bad[j] for a, j in zip(w, near))
        assert abs(s - (good + 0.6) / (good + bad + 1)) < 1e-3


def test_leading_directions_are_those_of_the_full_problem():
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(400, 120)) * np.geomspace(5, 0.05, 120)).astype(np.float32)
    square = x.T @ x
    value, vector = np.linalg.eigh(square.astype(float))
    found = quality.leading_directions(square, 10)
    assert np.allclose(np.abs((found * vector[:, ::-1][:, :10]).sum(axis=0)), 1, atol=1e-3)
    assert np.isfinite(quality.leading_directions(np.zeros((30, 30), np.float32), 5)).all()


def test_term_counts_of_single_texts_and_of_batches_agree():
    texts = ["a b a b", "", None, "é" * 5, "x", " \n ", "line\nline\nline", "w" * 500 + " " + "w" * 500]
    together = quality.term_counts(*text_bytes(pa.array(texts)))
    alone = np.vstack([quality.term_counts(*text_bytes(pa.array([t], pa.string()))) for t in texts])
    assert np.allclose(together, alone)
    assert np.isclose(together[0, quality.SHAPES], 0.5) and np.isclose(together[6, quality.SHAPES + 1], 2 / 3)
    assert np.isclose(together[7, quality.SHAPES], 0.5)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (2, "", "q"), (None, "some text", "q")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None), (None, 1), (99, 0)], "doc_id long, quality int")
    assert [r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()] == [0.5] * 4
    labels = spark.createDataFrame([(1, 1), (1, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.fit(docs, labels)).collect())
    assert quality.score(docs.limit(0), None).collect() == []
