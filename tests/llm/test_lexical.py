"""Ranked search against brute force, and what its pair bounds save."""

import math
import random
import re

import numpy as np
import pytest

from oracle import compare, connect
from tidemark.llm import lexical, queries


def slow_terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def slow_rank(docs, items, k=10):
    """docs: (id, text), items: (id, text); a list of (item_id, rank, doc_id, score)."""
    bags = [(i, slow_terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    out = []
    for item, text in items:
        scores = [0] * len(bags)
        for t in set(slow_terms(text)):
            df = sum(t in w for _, w in bags)
            weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            for n, (_, w) in enumerate(bags):
                tf = w.count(t)
                if tf:
                    m = 10 + 90 * len(w) * n_docs // n_terms
                    scores[n] += weight * (10 ** 9 * tf // (1000 * tf + 8 * m))
        found = sorted((-s, i is None, i or 0, i) for s, (i, _) in zip(scores, bags) if s > 0)[:k]
        out += [(item, n + 1, i, -s) for n, (s, _, _, i) in enumerate(found)]
    return sorted(out, key=str)


def run(spark, docs, items, k=10):
    docs = spark.createDataFrame([(t, i, 1, "x") for i, t in docs], "text string, doc_id long, score int, item_id string")
    items = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id string, text string, doc_id int")
    return sorted((tuple(r) for r in lexical.rank(docs, items, k).collect()), key=str)


def corpus(seed, n, words=60):
    rng = random.Random(seed)
    word = lambda: f"W{min(int(rng.paretovariate(0.7)), words)}"
    return [(rng.randrange(10 ** 6), " ".join(word() for _ in range(rng.choice([0, 1, 5, 30, 120])))) for _ in range(n)]


@pytest.mark.parametrize("shard,block", [(2048, 1 << 17), (7, 1 << 17), (16, 20)])
def test_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(lexical, "SHARD_ROWS", shard)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
    docs, items = corpus(1, 150), [(str(i), t) for i, t in corpus(2, 12)]
    assert run(spark, docs, items, 3) == slow_rank(docs, items, 3)


def test_long_queries_beyond_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PAIR_TERMS", 3)
    docs, items = corpus(3, 100), [("q", " ".join(f"w{n}" for n in range(60)))]
    assert run(spark, docs, items) == slow_rank(docs, items)


def test_ties_nulls_repeats_and_long_texts(spark):
    docs = [(9, "same words here"), (3, "Same WORDS, here!"), (None, "same words here"), (3, "same words here"), (4, None), (5, ""), (6, " \n.,"),
            (7, "é ñandú 日本 x1"), (8, "word " * 50_000 + "same"), (10, "Ä ä")] + [(100 + i, "filler text only") for i in range(30)]
    items = [("a", "same here"), ("a", "same here"), ("b", None), ("c", "nothing matches"), ("d", "ÑANDÚ ñandú 日本"), (None, "ä word"), ("e", "text")]
    assert run(spark, docs, items) == slow_rank(docs, items)


def test_a_term_in_every_document_weighs_nothing(spark):
    docs = [(i, "common") for i in range(600)]
    assert run(spark, docs, [("a", "common")]) == slow_rank(docs, [("a", "common")]) == []


def test_empty_tables(spark):
    assert run(spark, [], [("a", "x")]) == run(spark, [(1, "x")], []) == run(spark, [], []) == []


def test_pair_bounds_read_fewer_postings():
    """Two terms that never meet: the pair bound sees it, single maxima do not."""
    rng = np.random.default_rng(4)
    rows, n_terms = 2000, 8
    held = [np.flatnonzero(rng.random(rows) < 0.3) for _ in range(n_terms - 2)]
    held += [np.arange(0, 900), np.arange(1000, 1900)]
    doc = np.concatenate(held)
    term = np.repeat(np.arange(n_terms), [len(h) for h in held])
    impact = rng.integers(1, 1000, len(doc))
    order = np.lexsort((doc, term))
    q = lexical.Queries(["q"], [np.arange(n_terms)], {}, np.ones(n_terms, np.int64))
    a, b = np.triu_indices(n_terms, 1)
    q.pairs, own = np.column_stack([a, b]), (np.arange(len(a)), a, b)
    joint = lexical.joint_maxima(q, term[order], doc[order], impact[order], rows)
    for n, (s, t) in enumerate(q.pairs.tolist()):
        left, right = dict(zip(doc[term == s], impact[term == s])), dict(zip(doc[term == t], impact[term == t]))
        assert joint[n] == max([left[d] + right[d] for d in left.keys() & right.keys()], default=0)
    pair = np.flatnonzero(joint)
    shard = lexical.Shard(np.arange(rows), np.ones(rows, bool), np.arange(n_terms), np.concatenate([[0], np.cumsum([len(h) for h in held])]),
                          doc[order], impact[order], pair, joint[pair])
    total = np.zeros(rows, np.int64)
    np.add.at(total, doc, impact)
    wanted = np.lexsort((np.arange(rows), -total))[:10]
    least = int(total[wanted[-1]])
    top, scores, touched = shard.search(q.terms[0], own, 10, least)
    plain, plain_scores, more = shard.search(q.terms[0], own, 10, least, paired=False)
    assert top.tolist() == plain.tolist() == wanted.tolist() and scores.tolist() == plain_scores.tolist() == total[wanted].tolist()
    assert touched < more < len(doc) + 1


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    assert compare(spark, connect(path), queries.op13_lexical, queries.OP13_SQL, path) == []
