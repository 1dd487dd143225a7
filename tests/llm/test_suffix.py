"""Repeated strings against brute force over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import queries, suffix

SF = "/root/testdata/sf0.001"


def brute_force(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i: i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i: i + length]] > 1:
                gone[i: i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8)]))
        out.append((len(b), int(gone.sum()), int((edge == 1).sum()), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def made_texts(rng, n):
    """Near copies, shared passages, repeats inside a text, one-letter runs and short texts."""
    base = ["".join(rng.choice("abcd é") for _ in range(rng.randint(0, 300))) for _ in range(8)]
    texts = [None, "", "x", "a" * 90, "ab" * 70, base[0] * 2]
    while len(texts) < n:
        t = list(rng.choice(base) + rng.choice(["", rng.choice(base)[rng.randint(0, 20):], "a" * 40]))
        for _ in range(rng.randint(0, 3)):
            if t:
                t[rng.randrange(len(t))] = rng.choice("abcdeé")
        texts.append("".join(t))
    return texts


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    wanted = brute_force([d.text for d in docs], 400)
    found = {r.doc_id: tuple(r)[1:] for r in queries.op9_suffix_dedup(spark, SF).collect()}
    assert found == {d.doc_id: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for d, w in zip(docs, wanted)}
    assert sum(w[1] for w in wanted) > 0


@pytest.mark.parametrize("anchor_rows", [4096, 2])
def test_random_texts_and_split_anchors(spark, anchor_rows):
    texts = made_texts(random.Random(anchor_rows), 120)
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.remove_repeats(docs, 30, anchor_rows).collect()}
    assert found == dict(enumerate(brute_force(texts, 30)))


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "".join(random.Random(3).choices("abcdefgh", k=60))
    docs = spark.createDataFrame([(None, text), (1, text[::-1]), (1, text[::-1]), (None, "short"), (2, text[5:50])], "doc_id long, text string")
    found = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in suffix.remove_repeats(docs, 30).collect())
    assert found == [(-1, 5, 0), (-1, 60, 45), (1, 60, 60), (1, 60, 60), (2, 45, 45)]
    assert suffix.remove_repeats(docs.limit(0)).collect() == []


def test_matching_statistics_equal_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        alphabet = rng.choice([b"ab", b"a", b"abc\0", bytes(range(256))])
        parts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 10))]
        parts += [p[1:] + b"z" for p in parts]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        tails = [p[i:] for p in parts for i in range(len(p))]

        def common(x, y):
            return next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))

        wanted = [max([common(x, y) for j, y in enumerate(tails) if j != i], default=0) for i, x in enumerate(tails)]
        assert suffix.matching_statistics(np.frombuffer(b"".join(parts), np.uint8), bounds).tolist() == wanted


def test_a_block_stays_small_in_memory():
    import tracemalloc
    import pyarrow as pa
    from tidemark.llm.arrow import chunks, text_bytes
    rng = random.Random(3)
    batch = pa.RecordBatch.from_pydict({"text": ["".join(rng.choices("abcdefgh ", k=20_000)) for _ in range(100)]})
    tracemalloc.start()
    n = sum(len(suffix.segments(*text_bytes(part.column("text")))[0]) for part in chunks([batch], "text", suffix.BLOCK_BYTES))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 1000 and peak < 32e6
