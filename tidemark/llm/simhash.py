"""SimHash near-duplicates with bit-sliced comparison.

A fingerprint per document comes from one pass over the texts. Distinct fingerprints are
dealt to buckets that every pair within the radius must share (of ``radius + 2`` bit
blocks at least two are equal), and each bucket is compared bit-sliced: bit planes stand
vertically, 64 candidates to a machine word, distances are carry-save counters, and words
whose 64 candidates all exceed the radius are dropped on the way. Buckets above
``bucket_rows`` fingerprints are split into pairs of tiles, so no task holds more than two
tiles of one bucket. A tile hands on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.arrow import chunks, text_bytes, words
from tidemark.llm.components import components
from tidemark.session import materialize

BITS = 64
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
TILE = 256


def simhashes(data: np.ndarray, offsets: np.ndarray, width: int = 4, seed: int = 42) -> np.ndarray:
    """The SimHash of each text over its word shingles, repeats included; zero without words."""
    text, starts, ends, first = words(data, offsets)
    count = np.diff(first)
    n_shingles = np.where(count > 0, np.maximum(count - width + 1, 1), 0)
    bound = np.concatenate([[0], np.cumsum(n_shingles)])
    out = np.zeros(len(count), np.uint64)
    if not bound[-1]:
        return out
    word = np.arange(bound[-1]) - np.repeat(bound[:-1], n_shingles) + np.repeat(first[:-1], n_shingles)
    stop = np.minimum(word + width, np.repeat(first[1:], n_shingles)) - 1
    raw, digest = text.tobytes(), xxhash.xxh64_intdigest
    spans = zip(starts[word].tolist(), ends[stop].tolist())
    hashes = np.fromiter((digest(raw[a:b], seed) for a, b in spans), np.uint64, bound[-1])
    some = n_shingles > 0
    for lo in range(0, len(hashes), 1 << 16):  # whole columns of ones, 64 bytes a shingle
        hi = min(lo + (1 << 16), len(hashes))
        bits = np.unpackbits(hashes[lo:hi].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cut = np.clip(bound[:-1][some], lo, hi)
        here = (np.clip(bound[1:][some], lo, hi) > cut)
        part = np.add.reduceat(bits, cut[here] - lo, axis=0, dtype=np.int32)
        if lo == 0:
            ones = np.zeros((int(some.sum()), BITS), np.int64)
        ones[here] += part
    majority = 2 * ones > n_shingles[some][:, None]
    out[some] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, fingerprint`` (a signed long) for every row, from whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = simhashes(*text_bytes(batch.column("text")), width, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(found)],
                                             ["doc_id", "text_hash", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fingerprint long")


def bucket_keys(fingerprint: Column, radius: int = 4) -> Column:
    """One key per pair of bit blocks: of ``radius + 2`` blocks, two equal ones remain at least."""
    n = radius + 2
    edge = [BITS * i // n for i in range(n + 1)]
    block = [F.shiftrightunsigned(fingerprint, a).bitwiseAND((1 << (b - a)) - 1) for a, b in zip(edge, edge[1:])]
    keys = []
    for number, (i, j) in enumerate(combinations(range(n), 2)):
        both = F.shiftleft(block[i], edge[j + 1] - edge[j]).bitwiseOR(block[j])
        keys.append(both * F.lit(n * n).cast("long") + F.lit(number).cast("long"))
    return F.array(*keys)


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes (64 x words) of the values, 64 to a word, and the word mask of unused places."""
    size = -(-len(values) // BITS) * BITS
    padded = np.zeros(size, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(size, 8), axis=1, bitorder="little")
    planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)
    unused = np.packbits(np.arange(size) >= len(values), bitorder="little").view(np.uint64)
    return planes, unused


def exceeded(counter: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Per bit: the counted distance is above the radius."""
    more, same = over.copy(), ~over
    for i in reversed(range(len(counter))):
        if radius >> i & 1:
            same &= counter[i]
        else:
            more |= same & counter[i]
            same &= ~counter[i]
    return more


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with at most ``radius`` differing bits between left[i] and right[j]."""
    found_i, found_j = [], []
    for at in range(0, len(right), TILE * BITS // 4):
        planes, unused = bit_planes(right[at: at + TILE * BITS // 4])
        for lo in range(0, len(left), TILE):
            query = left[lo: lo + TILE]
            flip = np.where(query[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1), ONES, np.uint64(0))
            live = np.arange(planes.shape[1])
            counter = [np.zeros((len(query), len(live)), np.uint64) for _ in range(radius.bit_length())]
            over = np.repeat(unused[None, :], len(query), axis=0)
            for bit in range(BITS):
                carry = planes[bit, live][None, :] ^ flip[:, bit, None]
                for c in counter:
                    carry, c[...] = c & carry, c ^ carry
                over |= carry
                if bit % 8 == 7:
                    gone = exceeded(counter, over, radius)
                    stay = (gone != ONES).any(axis=0)
                    if not stay.any():
                        break
                    if not stay.all():
                        live, over, counter = live[stay], over[:, stay], [np.ascontiguousarray(c[:, stay]) for c in counter]
            else:
                near = ~exceeded(counter, over, radius)
                row, word = np.nonzero(near)
                bits = np.unpackbits(near[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                k, place = np.nonzero(bits)
                found_i.append(lo + row[k])
                found_j.append(at + live[word[k]] * BITS + place)
    return (np.concatenate(found_i), np.concatenate(found_j)) if found_i else (np.empty(0, int), np.empty(0, int))


def forest(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the links: each value and the smallest of its component."""
    nodes, ends = np.unique(np.concatenate([values[i], values[j]]), return_inverse=True)
    u, v = ends[: len(i)], ends[len(i):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def links(distinct: DataFrame, radius: int = 4, bucket_rows: int = 4096, column: str = "fingerprint") -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all pairs within the radius.

    Every pair within the radius is found; of the links found in a tile a spanning forest
    is returned, which joins the same fingerprints.
    """
    keyed = distinct.select(F.explode(bucket_keys(F.col(column), radius)).alias("key"), F.col(column).alias("value"))
    hot = keyed.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > bucket_rows)
    hot = materialize(hot.select("key", F.ceil(F.col("rows") / bucket_rows).cast("int").alias("tiles")), "hot-buckets")
    keyed = keyed.join(hot, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    keyed = keyed.withColumn("tile", F.pmod(F.xxhash64("value"), F.col("tiles")).cast("int"))
    keyed = keyed.select("key", "value", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    keyed = keyed.select("key", "value", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
                         (F.col("tile") > F.col("other")).alias("second"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "value", "low", "high", "second")}
            if rest is not None:
                table = {c: np.concatenate([rest[c], table[c]]) for c in table}
            group = _changes(table)
            cut = int(np.flatnonzero(group)[-1]) if group.any() else 0  # the last group may go on in the next batch
            yield from _compare({c: v[:cut] for c, v in table.items()}, radius)
            rest = {c: v[cut:] for c, v in table.items()}
        if rest is not None:
            yield from _compare(rest, radius)

    dealt = keyed.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _changes(table: dict[str, np.ndarray]) -> np.ndarray:
    new = np.zeros(len(table["key"]), bool)
    for c in ("key", "low", "high"):
        new[1:] |= table[c][1:] != table[c][:-1]
    return new


def _compare(table: dict[str, np.ndarray], radius: int) -> Iterator[pa.RecordBatch]:
    """Compare each bucket; small buckets share a block, which can only find true links too."""
    n = len(table["key"])
    if not n:
        return
    bound = np.concatenate([[0], np.flatnonzero(_changes(table)), [n]])
    start = 0
    while start < len(bound) - 1:
        stop = start + 1
        while stop < len(bound) - 1 and bound[stop + 1] - bound[start] <= TILE:
            stop += 1
        part = slice(bound[start], bound[stop])
        value, second = table["value"][part].view(np.uint64), table["second"][part]
        crossed = stop == start + 1 and table["low"][part][0] != table["high"][part][0]
        if crossed:
            left, right = np.flatnonzero(~second), np.flatnonzero(second)
        else:
            left = right = np.arange(len(value))
        if len(value) > 1 and len(left) and len(right):
            i, j = close_pairs(value[left], value[right], radius)
            i, j = left[i], right[j]
            real = value[i] < value[j] if not crossed else value[i] != value[j]
            if real.any():
                a, b = forest(value.view(np.int64), i[real], j[real])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        start = stop


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4, seed: int = 42, bucket_rows: int = 4096,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fingerprint, component_id`` for every row of ``docs``.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the
    smallest id reachable, the row's own included. Null and empty texts, and texts of
    white space only, have fingerprint zero and are linked like any other; texts of fewer
    than ``width`` words are one shingle. Rows with equal ids are rows of their own. A null
    id takes part, but is the component's id only where the component has no other.
    An empty table gives no rows; other columns are ignored.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    distinct = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, radius, bucket_rows))
    grouped = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    grouped = grouped.join(named, "root").select("fingerprint", "component_id")
    return prints.join(grouped, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id")


def keep_one(docs: DataFrame, find: Callable[..., DataFrame] = near_duplicates, **options) -> DataFrame:
    """The rows of ``docs`` with one row, that of the smallest id, for each component that ``find`` gives.

    Of rows that repeat an id and a text one stays. All columns are kept as they are.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    groups = find(docs, **options)
    first = Window.partitionBy("component_id", "rootless").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash")
    groups = groups.withColumn("rootless", F.when(F.col("component_id").isNull(), F.col("fingerprint")))
    key = F.struct("doc_id", "text_hash").alias("key")  # nulls inside a struct are equal
    kept = groups.withColumn("n", F.row_number().over(first)).where("n = 1").select(key)
    row = docs.select(F.struct("*").alias("row"), F.struct(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")).alias("key"))
    once = Window.partitionBy("key").orderBy(F.lit(1))
    return row.join(kept, "key", "left_semi").withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")
