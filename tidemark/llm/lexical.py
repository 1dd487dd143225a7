"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

The index is a table of shards, each of some thousand documents: term postings with their
impacts, the largest impact of every term, and, for every pair of terms that occur in one
query together, an entry of the pair's intersection list: the largest joint impact of a
document that holds both. A query matches its terms into pairs; a document cannot gain more
from a pair than the larger of its joint maximum and its two single maxima, which is less
than their sum. Pairs whose bounds together cannot reach the k-th score are not searched for
documents of their own, and a shard or a candidate whose bound falls short is left. What the
intersection lists hold also bounds the k-th score from below before any search begins.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import chunks
from tidemark.session import materialize

#: Runs of digits, letters and non-ASCII characters, as UTF-8 bytes; ``bytes.lower`` lowers A-Z only.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SHARD_ROWS = 2048
#: Impacts a shard may hold as a dense matrix while its pairs are measured; a large vocabulary makes shards smaller.
DENSE = 1 << 23
#: Terms of the queries that are searched for together, on average, so what is broadcast is bounded.
BLOCK_TERMS = 1 << 17
#: Joint maxima are kept among so many of a query's rarest terms; others are bounded by their own maxima.
PAIR_TERMS = 64


def terms_of(text: bytes | None) -> list[bytes]:
    return TERM.findall((text or b"").lower())


@dataclass
class Queries:
    """Queries over a vocabulary: what is broadcast of one block of them."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]
    weight: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    n_docs: int = 0
    n_terms: int = 0
    pairs: np.ndarray = field(default_factory=lambda: np.empty((0, 2), np.int64))
    #: Per query: the numbers of its pairs, and the places of their terms in the query.
    own: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def weigh(self, n_docs: int, n_terms: int, frequency: np.ndarray) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in frequency], np.int64)
        known: dict[tuple[int, int], int] = {}
        for terms in self.terms:
            rare = np.sort(np.argsort(-self.weight[terms], kind="stable")[:PAIR_TERMS])
            a, b = np.triu_indices(len(rare), 1)
            a, b = rare[a], rare[b]
            numbers = [known.setdefault((s, t) if s < t else (t, s), len(known)) for s, t in zip(terms[a].tolist(), terms[b].tolist())]
            self.own.append((np.array(numbers, np.int64), a, b))
        self.pairs = np.array(list(known), np.int64).reshape(-1, 2)

    def impacts(self, term: np.ndarray, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        m = 10 + (90 * length * self.n_docs) // max(self.n_terms, 1)
        return self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def joint_maxima(queries: Queries, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, rows: int) -> np.ndarray:
    """For every pair of terms, the largest sum of their impacts in one document that holds both; else 0."""
    present, number = np.unique(term, return_inverse=True)
    dense = np.zeros((len(present), rows), np.int64)
    dense[number, doc] = impact
    slot = np.full(len(queries.weight), -1)
    slot[present] = np.arange(len(present))
    count = np.bincount(number, minlength=len(present))
    at = np.argsort(number, kind="stable")
    edge = np.concatenate([[0], np.cumsum(count)])
    pair = slot[queries.pairs]
    out = np.zeros(len(pair), np.int64)
    live = np.flatnonzero((pair >= 0).all(axis=1))
    a, b = pair[live, 0], pair[live, 1]
    swap = count[a] > count[b]
    few, many = np.where(swap, b, a), np.where(swap, a, b)
    order = np.argsort(few, kind="stable")
    live, few, many = live[order], few[order], many[order]
    for start, stop in _runs(few):
        s = few[start]
        docs = doc[at[edge[s]: edge[s + 1]]]
        step = max(1, DENSE // 8 // len(docs))
        for lo in range(start, stop, step):
            hi = min(lo + step, stop)
            other = dense[many[lo:hi, None], docs[None, :]]
            out[live[lo:hi]] = np.where(other > 0, other + dense[s, docs], 0).max(axis=1)
    return out


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of runs of equal values."""
    edge = np.flatnonzero(np.diff(values)) + 1
    return zip(np.concatenate([[0], edge]).tolist(), np.concatenate([edge, [len(values)]]).tolist()) if len(values) else iter(())


class Shard:
    """Postings by term, with single and joint maxima."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, term: np.ndarray, edge: np.ndarray, doc: np.ndarray, impact: np.ndarray,
                 pair: np.ndarray, joint: np.ndarray):
        self.ids, self.known, self.doc, self.impact = ids, known, doc, impact
        self.edge, self.slot = edge, {t: n for n, t in enumerate(term.tolist())}
        self.best = np.maximum.reduceat(impact, edge[:-1]) if len(term) else np.empty(0, np.int64)
        self.pair, self.joint = pair, joint

    def postings(self, slot: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.edge[slot], self.edge[slot + 1])
        return self.doc[part], self.impact[part]

    def units(self, terms: np.ndarray, own: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, list[int]]]:
        """The query's terms in the shard, matched into pairs by what that saves: (bound, slots), lowest bound first."""
        slot = [self.slot.get(t, -1) for t in terms.tolist()]
        free = [s >= 0 for s in slot]
        single = np.array([self.best[s] if s >= 0 else 0 for s in slot], np.int64)
        numbers, a, b = own
        found = []
        if len(numbers) and len(self.pair):
            at = np.minimum(np.searchsorted(self.pair, numbers), len(self.pair) - 1)
            joint = np.where(self.pair[at] == numbers, self.joint[at], 0)
        else:
            joint = np.zeros(len(numbers), np.int64)
        bound = np.maximum(joint, np.maximum(single[a], single[b]))
        saved = single[a] + single[b] - bound
        for n in np.argsort(-saved, kind="stable").tolist():
            if saved[n] <= 0:
                break
            if free[a[n]] and free[b[n]]:
                free[a[n]] = free[b[n]] = False
                found.append((int(bound[n]), [slot[a[n]], slot[b[n]]]))
        found += [(int(single[n]), [slot[n]]) for n in range(len(slot)) if free[n]]
        return sorted(found)

    def search(self, terms: np.ndarray, own: tuple, k: int, least: int, paired: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and scores of the documents that may be among the ``k`` best with ``least`` or more; postings touched."""
        units = self.units(terms, own if paired else tuple(x[:0] for x in own))
        bounds = np.cumsum([bound for bound, _ in units])
        rest = int(np.searchsorted(bounds, least))  # the first units together stay below the least score
        if rest == len(units):
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        score, touched = np.zeros(len(self.ids), np.int64), 0
        for _, slots in units[rest:]:
            for s in slots:
                doc, impact = self.postings(s)
                score[doc] += impact
                touched += len(doc)
        at = np.flatnonzero(score)
        for n in range(rest, -1, -1):
            ahead = int(bounds[n - 1]) if n else 0
            if len(at) >= k:
                least = max(least, int(np.partition(score[at], len(at) - k)[len(at) - k]))
            at = at[score[at] + ahead >= least]
            if not n or not len(at):
                break
            for s in units[n - 1][1]:
                doc, impact = self.postings(s)
                place = np.minimum(np.searchsorted(doc, at), len(doc) - 1)
                score[at] += np.where(doc[place] == at, impact[place], 0)
                touched += len(at)
        top = at[np.lexsort((self.ids[at], ~self.known[at], -score[at]))[:k]]
        return top, score[top], touched


SHARD = ("ids array<long>, known array<boolean>, term array<int>, edge array<long>, doc array<int>, impact array<long>, "
         "pair array<int>, joint array<long>, seeds array<long>")


def _lists(columns: list[np.ndarray]) -> list[pa.Array]:
    """Each array as a column of one list."""
    return [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c)) for c in columns]


def read_queries(items: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    """Blocks of queries; rows are queries of their own, repeated ones too. Queries without terms are left out."""
    kind = items.schema[id_col].dataType.simpleString()

    def lex(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(text))) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    rows = materialize(rows.mapInArrow(lex, f"item_id {kind}, terms array<binary>").where("size(terms) > 0"), "queries")
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).orderBy("item_id", "terms").collect()
        vocabulary = {bytes(t): n for n, t in enumerate(sorted({bytes(t) for r in part for t in r.terms}))}
        if part:
            yield Queries([r.item_id for r in part], [np.array([vocabulary[bytes(t)] for t in r.terms]) for r in part], vocabulary)


def index(docs: DataFrame, queries: Queries, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The shards of all documents for the terms of ``queries``, stored; completes ``queries`` with the corpus' statistics."""
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(queries.vocabulary)

    def lex(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in chunks(batches, "text"):
            length, edge, term, tf = [], [0], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = terms_of(text)
                count = Counter(words)
                held = [(known[w], c) for w, c in count.items() if w in known]
                length.append(len(words))
                term += [t for t, _ in held]
                tf += [c for _, c in held]
                edge.append(len(term))
            edges = pa.array(edge, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(length, pa.int64()), pa.ListArray.from_arrays(edges, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(edges, pa.array(tf, pa.int32()))], ["doc_id", "length", "terms", "tf"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    forward = materialize(texts.mapInArrow(lex, "doc_id long, length long, terms array<int>, tf array<int>").where("length > 0"), "forward")
    n_docs, n_terms = forward.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    frequency = np.zeros(len(queries.vocabulary), np.int64)
    for r in forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row per term of the queries
        frequency[r.term] = r["count"]
    queries.weigh(n_docs, n_terms, frequency)
    shared = spark.sparkContext.broadcast(queries)
    rows = max(1, min(SHARD_ROWS, DENSE // max(len(queries.vocabulary), 1)))

    def shard(ids: pa.Array, length: np.ndarray, count: np.ndarray, term: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
        q = shared.value
        doc = np.repeat(np.arange(len(ids)), count)
        impact = q.impacts(term, tf, length[doc])
        term, doc, impact = (x[impact > 0] for x in (term, doc, impact))
        order = np.lexsort((doc, term))
        term, doc, impact = term[order], doc[order], impact[order]
        present, start = np.unique(term, return_index=True)
        joint = joint_maxima(q, term, doc, impact, len(ids))
        single = np.zeros(len(q.weight), np.int64)
        if len(present):
            single[present] = np.maximum.reduceat(impact, start)
        seeds = np.array([max(joint[own[0]].max(initial=0), single[terms].max(initial=0)) for terms, own in zip(q.terms, q.own)], np.int64)
        pair = np.flatnonzero(joint)
        return pa.RecordBatch.from_arrays(_lists([
            np.array(ids.fill_null(0)), ~np.array(ids.is_null()), present.astype(np.int32), np.append(start, len(term)).astype(np.int64),
            doc.astype(np.int32), impact, pair.astype(np.int32), joint[pair], seeds]),
            ["ids", "known", "term", "edge", "doc", "impact", "pair", "joint", "seeds"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            table = pa.Table.from_batches(waiting).combine_chunks()
            column = lambda name: table.column(name).combine_chunks()
            terms = column("terms")
            return shard(column("doc_id"), column("length").to_numpy(), np.diff(terms.offsets.to_numpy()),
                         terms.flatten().to_numpy().astype(np.int64), column("tf").flatten().to_numpy().astype(np.int64))

        for batch in batches:
            while batch.num_rows:
                room = rows - sum(b.num_rows for b in waiting)
                waiting.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in waiting) == rows:
                    yield close()
                    waiting = []
        if waiting:
            yield close()

    return materialize(forward.where("size(terms) > 0").mapInArrow(build, SHARD), "shards")


def search_index(shards: DataFrame, queries: Queries, id_type: pa.DataType, kind: str, k: int) -> DataFrame:
    """``query, item_id, doc_id, score``: each shard's candidates for the ``k`` best of every query."""
    spark = shards.sparkSession
    # Each shard has a document with at least its seed, so the k-th largest seed bounds the k-th score.
    seeds = shards.select(F.posexplode("seeds").alias("query", "seed"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("seed")))
    least = np.ones(len(queries.ids), np.int64)
    for r in seeds.withColumn("place", place).where(F.col("place") <= k).where(F.col("place") == k).collect():  # one row per query
        least[r["query"]] = max(1, r.seed)
    shared = spark.sparkContext.broadcast((queries, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, least = shared.value
        least, best = least.copy(), [np.empty(0, np.int64) for _ in q.ids]
        for batch in batches:
            for n in range(batch.num_rows):
                part = [batch.column(c).slice(n, 1).flatten() for c in range(8)]
                part = [np.array(c) for c in part]
                here = Shard(*part[:2], *part[2:])
                number, doc, score = [], [], []
                for i, (terms, own) in enumerate(zip(q.terms, q.own)):
                    top, scores, _ = here.search(terms, own, k, int(least[i]))
                    best[i] = np.sort(np.concatenate([best[i], scores]))[-k:]
                    if len(best[i]) == k:
                        least[i] = max(least[i], best[i][0])
                    number += [i] * len(top)
                    doc.append(top)
                    score.append(scores)
                at = np.concatenate(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int32()), pa.array([q.ids[i] for i in number], id_type),
                     pa.array(here.ids[at], pa.int64(), mask=~here.known[at]), pa.array(np.concatenate(score), pa.int64())],
                    ["query", "item_id", "doc_id", "score"])

    return shards.drop("seeds").mapInArrow(run, f"query int, item_id {kind}, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0.

    Terms are runs of digits, letters and non-ASCII characters of the whole text, A-Z lowered.
    Equal scores go by ascending id, null ids last. Null and empty texts have no terms; an item
    without terms or matches gives no rows, and fewer matches give fewer. Every row is a document
    or an item of its own: a repeated document takes several ranks, a repeated item has its ranks
    several times. Empty tables give no rows; other columns are ignored.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    field_type = items.schema[item_col].dataType
    kind, found = field_type.simpleString(), None
    for queries in read_queries(items, item_col, item_text_col):
        shards = index(docs, queries, id_col, text_col)
        part = search_index(shards, queries, to_arrow_type(field_type), kind, k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        part = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
