"""The toxicity lexicon: folding, matching against brute force, learned stems and exceptions, held-out accuracy.

At sf0.01 six held-out texts are toxic, and stems of the smaller languages occur in two or three labelled texts;
at sf0.1 five of 92 toxic texts hold no word of their own: their labels come from text that repeats replaced.
"""

import math
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import queries, toxicity


def test_folding_undoes_disguises():
    for text in ("idiot", "IDIOT", "1d10t", "íd́iöt", "іdіоt", "ｉｄｉｏｔ", "id​iot", "i­diot", "!d" [1:] and "id!ot", "idi0t", "idio7"):
        assert toxicity.words_of(text) == ["idiot"], text
    assert toxicity.words_of("$cum @sshat pa7het1c") == ["scum", "asshat", "pathetic"]
    # Numbers and trailing signs are not letters; words keep their bounds.
    assert toxicity.words_of("In 2014, idiot!! the$$$ 50 items") == ["in", "2014", "idiot", "the", "50", "items"]
    assert toxicity.words_of(None) == toxicity.words_of("") == toxicity.words_of(" \n!") == []


def slow_total(patterns, stream):
    """Leftmost, longest matches by trying every pattern at every place."""
    at, total = 0, 0.0
    while at < len(stream):
        here = max((p for p in patterns if stream.startswith(p, at)), key=len, default=None)
        total += patterns[here] if here else 0
        at += len(here) if here else 1
    return total


def test_matching_equals_brute_force():
    rng = random.Random(5)
    words = ["ab", "abc", "abcd", "bc", "bca", "c", "d", "ca"]
    for _ in range(200):
        weights = {rng.choice([" " + w, f" {w} ", w]): rng.choice([0.5, 1.0, 2.0]) for w in rng.sample(words, 4)}
        exceptions = [f" {rng.choice(words)}  {rng.choice(words)} ", f" {rng.choice(words)} "]
        exceptions = [e for e in exceptions if e not in weights]
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(12)))
        total, count = toxicity.weigh(toxicity.Lexicon(weights, exceptions).automaton(), [text])
        assert count[0] == len(text.split())
        assert math.isclose(total[0], slow_total({**weights, **dict.fromkeys(exceptions, 0.0)}, toxicity.spaced(text.split())))


def test_exception_phrases_cover_their_entries():
    lexicon = toxicity.Lexicon({" clown": 2.0, " scum ": 1.0}, [" clown  fish ", " clownfish "])
    total, count = toxicity.weigh(lexicon.automaton(), ["a clown", "a clown fish", "clownfish, clowns", "scum clown scum", "scumble", None])
    assert total.tolist() == [2.0, 0.0, 2.0, 4.0, 0.0, 0.0] and count.tolist() == [2, 3, 2, 3, 1, 0]


def test_scores_fall_with_length():
    lexicon = toxicity.Lexicon({" clown": 2.0}, slope=2.0, bias=-4.0)
    found = lexicon.scores(np.array([0.0, 2.0, 2.0, 2.0]), np.array([10.0, 10.0, 1000.0, 100_000.0]))
    assert found[1] > found[2] > found[3] > found[0]


def corpus(n, seed):
    """Toxic texts hold stems with random endings or disguised words; both kinds hold a harmless word and phrase."""
    rng = random.Random(seed)
    syllable = ["ba", "co", "du", "fe", "gi", "ha", "jo", "ku", "li", "mo", "ne", "po", "ra", "su", "te", "vi"]
    word = lambda: "".join(rng.choice(syllable) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["zork" + word(), "zork" + word(), "Tr0ll", "trоll", "troll"]))
        if rng.random() < 0.3:
            words.insert(rng.randrange(len(words)), "zorknado")
        if rng.random() < 0.3:
            words.insert(rng.randrange(len(words)), "troll doll")
        rows.append((i, " ".join(words), toxic))
    return rows


def test_learns_stems_exceptions_and_phrases(spark):
    rows = corpus(1500, 3)
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i < 1000], "doc_id long, toxic int")
    lexicon = toxicity.fit(docs, labels)
    assert lexicon.weights[" zork"[:5]] > 2 if " zork" in lexicon.weights else any(t.startswith(" zor") and w > 2 for t, w in lexicon.weights.items())
    assert lexicon.weights.get(" zorknado ", lexicon.weights.get(" zorknado", 0.0)) == 0.0
    assert any(e.startswith(" troll  doll") for e in lexicon.exceptions)
    found = {r.doc_id: r.score for r in toxicity.score(docs, lexicon).collect()}
    assert np.mean([(found[i] >= 0.5) == bool(y) for i, _, y in rows[1000:]]) > 0.97


@pytest.mark.parametrize("sf,accuracy,order", [("sf0.01", 0.93, 0.8), ("sf0.1", 0.97, 0.95)])
def test_held_out_accuracy(spark, sf, accuracy, order):
    path = f"/root/testdata/{sf}"
    found = {r.doc_id: r for r in queries.op11_toxicity(spark, path).collect()}
    labels = spark.read.parquet(f"{path}/labels.parquet").collect()
    held = [r for r in labels if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(found[r.doc_id].held_out for r in held) and not all(r.held_out for r in found.values())
    assert np.mean([found[r.doc_id].predicted == r.toxic for r in held]) > accuracy
    bad, good = ([found[r.doc_id].score for r in held if r.toxic == y] for y in (1, 0))
    assert np.mean([[(b > g) + (b == g) / 2 for g in good] for b in bad]) > order
    assert len(found) == spark.read.parquet(f"{path}/documents.parquet").count()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "q"), (2, "", "q"), (2, "", "q"), (None, "some text", "q"), (3, "w" * 100_000 + " x" * 100_000, "q")],
                                 "doc_id long, text string, label string")
    none = spark.createDataFrame([(1, None), (None, 1), (99, 5)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0.5] * 5
    one = spark.createDataFrame([(1, 1), (1, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, one)).collect()] == [1.0] * 5
    both = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.fit(docs, both)).collect()
    assert len(found) == 5 and all(0 <= r.score <= 1 and r.total == 0 for r in found)
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), both)).collect() == []
