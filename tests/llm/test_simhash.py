"""SimHash near-duplicates against brute force."""

import re

import numpy as np
import xxhash
from pyspark.sql import Row

from tidemark.llm import queries, simhash
from tidemark.llm.components import components

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    parts = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, radius=4):
    """rows: (doc_id, text); returns doc_id -> (fingerprint, component)."""
    prints = {i: slow_fingerprint(t) for i, t in rows}
    ids, root = sorted(prints), {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, x in enumerate(ids):
        for y in ids[n + 1:]:
            if bin(prints[x] ^ prints[y]).count("1") <= radius:
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, SF).collect()}
    assert found == slow_components([(r.doc_id, r.text) for r in docs])
    assert len({c for _, c in found.values()}) < len(found)


def test_edge_texts(spark):
    texts = [None, "", " \t\n", "one", "One", "a b c d", "A  b\tc\nd", "é ß ñ word", "x " * 60000, "x\x0bx x x x", "aaa\x85bbb ccc"]
    docs = spark.createDataFrame([Row(doc_id=i, text=t, fingerprint="clash", row=1) for i, t in enumerate(texts)])
    found = {r.doc_id: (f"{r.fingerprint & (2 ** 64 - 1):016x}", r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == slow_components(list(enumerate(texts)))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in found.values()}


def test_null_ids_repeated_rows_and_empty_table(spark):
    rows = [(None, "same text here now"), (7, "same text here now"), (7, "same text here now"), (None, "alone in the wide world")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.near_duplicates(docs).collect())
    assert found == [(-1, -1), (-1, 7), (7, 7), (7, 7)]
    assert sorted(str(r.doc_id) for r in simhash.keep_one(docs).collect()) == ["7", "None"]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_bit_sliced_pairs_equal_popcounts():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(12)] + [base]))
    for radius in (0, 1, 3, 4, 6):
        i, j = simhash.close_pairs(values, values, radius)
        wanted = {(a, b) for a in range(len(values)) for b in range(len(values)) if bin(int(values[a] ^ values[b])).count("1") <= radius}
        assert set(zip(i.tolist(), j.tolist())) == wanted


def test_split_buckets_lose_no_link(spark):
    """A ball of near fingerprints, far above the tile size, links the same as in one tile."""
    rng = np.random.default_rng(2)
    centre = 0x0123456789ABCDEF
    values = {centre}
    while len(values) < 600:
        flips = rng.integers(0, 64, int(rng.integers(1, 9)))
        values.add(centre ^ int(np.bitwise_xor.reduce(np.uint64(1) << flips.astype(np.uint64))))
    values = sorted(np.array(sorted(values), np.uint64).view(np.int64).tolist())
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    roots = [{(r.node, r.root) for r in components(simhash.links(frame, bucket_rows=n)).collect()} for n in (25, 10000)]
    assert roots[0] == roots[1]
    i, j = simhash.close_pairs(np.array(values).view(np.uint64), np.array(values).view(np.uint64), 4)
    assert {n for n, _ in roots[0]} == {values[k] for k in i[i != j]}


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 400)] + [(5, None), (9, 9)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 400)}}
