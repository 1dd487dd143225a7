"""The mix against plain water-filling, and its edge rows."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import mixing


def plain_targets(sizes, share=1.5, epochs=2.0):
    """sizes by source in order; the weights are 3, 1, 2 in turn."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
    total, full = share * sum(sizes.values()), set()
    while True:
        free = sum(weights[s] for s in sizes if s not in full)
        level = (total - sum(epochs * sizes[s] for s in full)) / free if free else 0
        over = {s for s in sizes if s not in full and level * weights[s] > epochs * sizes[s] + 1e-9}
        if not over:
            return {s: epochs * sizes[s] if s in full else level * weights[s] for s in sizes}
        full |= over


def test_targets_and_taken_words(spark):
    rng = random.Random(1)
    sources = ["b", "a", "é", "Z", None, "", "a b"]
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choices(sources, weights=[30, 1, 5, 5, 9, 2, 3])[0]) for i in range(3000)]
    rows += [(9000, None, "empty"), (9001, "", "empty")]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, source string, size int")
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows) and sorted(map(str, found)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    ordered = {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, (s or "").encode()))}
    wanted, taken = plain_targets(ordered), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - wanted[r.source]) < 1e-6 * max(1, wanted[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - wanted[s]) <= 300 for s in sizes)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 300 * len(sizes)


def test_sample_repeats_documents(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (2, "d", "s"), (None, "e f", None), (1, "a b c", "s")], "doc_id long, text string, source string")
    taken = defaultdict(int)
    for r in mixing.mix(docs).collect():
        taken[r.doc_id, r.source] = max(taken[r.doc_id, r.source], r.copies)
    rows = mixing.sample(docs).collect()
    assert {(r.doc_id, r.source) for r in rows} == {k for k, n in taken.items() if n}
    assert all(1 <= r.epoch <= taken[r.doc_id, r.source] for r in rows)
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.sample(docs.limit(0)).collect() == []


def test_numbers_follow_the_order(spark):
    frame = spark.createDataFrame([(x,) for x in ["b", "a", None, "Z", "é"]], "s string")
    found = {r.s: r.no for r in mixing.numbered(frame, F.col("s").asc_nulls_last()).collect()}
    assert found == {"Z": 1, "a": 2, "b": 3, "é": 4, None: 5}
