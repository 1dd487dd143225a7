"""Remove long repeated byte strings, with run-length suffix indexes.

1. Every window of ``length`` bytes is assigned to its anchor, the k-gram with the least
   hash inside it: equal windows have equal anchors wherever they stand. The windows of one
   anchor occurrence form a segment. Only hashes and places of segments are shuffled.
2. Anchors that occur once are dropped. Segments that occur twice are repeats as a whole.
3. Where an anchor has several different segments, one text of each is sent to the task of
   that anchor, which builds a run-compressed Burrows-Wheeler transform over them, samples
   it at the run ends, streams the matching statistics of all segments from the samples and
   marks every window that occurs elsewhere.
4. The marked spans of a document are united and cut out.

An anchor with more than ``anchor_rows`` different segments does not go to one task: its
windows are counted by a 128-bit hash instead, which is exact up to that hash and spreads
evenly. Anchors and segments are compared by two 64-bit hashes together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import chunks, text_bytes
from tidemark.session import materialize

GRAM = 64
#: Text of a block in a task; the arrays over it take about 70 times as much.
BLOCK_BYTES = 1 << 18
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def _words(data: np.ndarray, shift: int, n: int, order: str = "<") -> np.ndarray:
    """The eight bytes from each of ``n`` places on, as numbers; ``data`` is padded."""
    return np.ndarray((n,), f"{order}u8", data, shift, (1,)).astype(np.uint64)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * A
    h ^= (right + A) * B
    h ^= h >> np.uint64(32)
    h *= A
    h ^= h >> np.uint64(29)
    return h


def segments(data: np.ndarray, offsets: np.ndarray, length: int = 400) -> tuple[np.ndarray, ...]:
    """The segments of the texts: text number, first and last window start, anchor hash, segment hash."""
    n, gram = len(data), 16
    while gram < GRAM and 4 * gram < length:
        gram *= 2
    width = length - gram + 1
    if n < length:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    grams = n - gram + 1
    h = _mixed(_words(padded, 0, n - 15), _words(padded, 8, n - 15))
    size = 16
    while size < gram:  # the hash of a gram from those of its halves
        h = _mixed(h[:-size], h[size:])
        size *= 2
    key = np.full(-(-grams // width) * width, np.uint64(2 ** 64 - 1))
    key[:grams] = (h & HIGH) | np.arange(grams, dtype=np.uint64)  # the leftmost of equal k-grams
    rows = key.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - length + 1
    anchor = (np.minimum(behind[:starts], ahead[width - 1: width - 1 + starts]) & LOW).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:starts]
    whole = np.arange(starts) + length <= offsets[1:][doc]
    new = np.ones(starts, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new & whole)
    last = np.ones(starts, bool)
    last[:-1] = new[1:] | ~whole[1:]
    tail = np.flatnonzero(last & whole)
    view, digest = memoryview(data.tobytes()), xxhash.xxh3_64_intdigest
    seg = np.fromiter((digest(view[a: b + length]) for a, b in zip(head.tolist(), tail.tolist())), np.uint64, len(head))
    seg ^= (anchor[head] - head).astype(np.uint64) * A
    doc = doc[head]
    return doc, head - offsets[doc], tail - offsets[doc], h[anchor[head]], seg


def suffix_order(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes in order; each ends with its segment, ``left`` bytes on. Ties keep text order."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = _words(padded, 0, n, ">")
    held = np.minimum(left, 7).astype(np.uint64)
    word &= ~np.uint64(0) << (np.uint64(8) * (np.uint64(8) - held))
    word |= held  # the last byte tells a zero byte from the end
    reach, longest = 7, int(left.max())
    while True:
        order = np.argsort(word, kind="stable")
        step = np.zeros(n, np.int64)
        step[1:] = word[order][1:] != word[order][:-1]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(step) + 1
        if reach >= longest or step.sum() == n - 1:
            return order
        after = np.zeros(n, np.uint64)
        after[: max(n - reach, 0)] = rank[reach:]
        after[left <= reach] = 0
        word = rank << np.uint64(32) | after
        reach *= 2


def common(data: np.ndarray, left: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of suffixes i and j within their segments."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    most = np.minimum(left[i], left[j])
    size = np.zeros(len(i), np.int64)
    live = np.flatnonzero(most > 0)
    word = np.ndarray((len(data),), ">u8", padded, 0, (1,))
    while len(live):
        differ = word[i[live] + size[live]].astype(np.uint64) ^ word[j[live] + size[live]].astype(np.uint64)
        same = np.full(len(live), 8)
        some = differ > 0
        # The leading zero bytes of the difference.
        same[some] = (63 - np.frexp((differ[some] >> np.uint64(11)).astype(float))[1] - 10) // 8
        exact = some & (differ >> np.uint64(11) == 0)
        same[exact] = 6 + (differ[exact] < 256)
        size[live] += same
        live = live[(~some) & (size[live] < most[live])]
    return np.minimum(size, most)


def matching_statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each place of the segments, the longest match that starts anywhere else.

    ``bounds`` (m + 1) cut ``data`` into segments. The Burrows-Wheeler transform is kept as
    runs with the text places at both run ends; between samples the statistics fall by one
    per byte, as neighbours in suffix order stay neighbours inside a run.
    """
    n = len(data)
    size = np.diff(bounds)
    left = np.repeat(bounds[1:], size) - np.arange(n)
    order = suffix_order(data, left)
    first = np.zeros(n, bool)
    first[bounds[:-1][size > 0]] = True
    char = data[order - 1]  # the transform; a segment's first place has an end mark of its own
    own = first[order]
    border = np.flatnonzero((char[1:] != char[:-1]) | own[1:] | own[:-1]) + 1
    value = common(data, left, order[border - 1], order[border])
    out = np.zeros(n, np.int64)
    for place, edge in ((order[border], order[0]), (order[border - 1], order[-1])):
        at = np.append(place, edge)  # the outermost suffix has no neighbour on that side
        known = np.append(value, 0)
        by = np.argsort(at)
        at, known = at[by], known[by]
        before = np.searchsorted(at, np.arange(n), "right") - 1
        np.maximum(out, known[before] - (np.arange(n) - at[before]), out=out)
    return out


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true values."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def _index_block(rows: dict, length: int) -> pa.RecordBatch:
    """Mark repeated windows in a block of segments with different anchors or texts."""
    bodies = rows["body"]
    data = np.frombuffer(b"".join(bodies), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
    again = matching_statistics(data, bounds) >= length
    number, start, stop = [], [], []
    for k in np.flatnonzero(np.logical_or.reduceat(again, bounds[:-1])):
        a, b = _runs(again[bounds[k]: bounds[k + 1]])
        number += [k] * len(a)
        start += (rows["start"][k] + a).tolist()
        stop += (rows["start"][k] + b + length).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array([rows["key"][k] for k in number], rows["type"]), pa.array(start, pa.int32()), pa.array(stop, pa.int32())],
        ["key", "start", "stop"])


def repeated_spans(docs: DataFrame, length: int = 400, anchor_rows: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, start, stop``: byte spans of strings of ``length`` bytes that start elsewhere too.

    ``key`` is a struct of id and text hash; rows that agree in both have the same spans,
    which are listed once or more often. Spans may overlap.
    """
    rows = docs.select(F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")).alias("key"),
                       F.col(text_col).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BLOCK_BYTES):
            doc, start, stop, anchor, seg = segments(*text_bytes(batch.column("text")), length)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(doc)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32)),
                 pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64))], ["key", "start", "stop", "anchor", "seg"])
        pa.default_memory_pool().release_unused()  # the worker stays while later stages run without it

    places = materialize(rows.mapInArrow(cut, f"key {kind}, start int, stop int, anchor long, seg long"), "segments")
    several = (places.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("seg") != F.max("seg")).alias("mixed"))
               .where("n > 1").select("anchor", "mixed"))
    places = materialize(places.join(several, "anchor"), "repeated-anchors")
    variants = places.groupBy("anchor", "seg").agg(F.count("*").alias("n"), F.first("mixed").alias("mixed"),
                                                   F.min(F.struct("key", "start", "stop")).alias("at"))
    variants = materialize(variants, "variants")
    twice = places.join(variants.where("n > 1").select("anchor", "seg"), ["anchor", "seg"])
    twice = twice.select("key", "start", (F.col("stop") + length).cast("int").alias("stop"))

    mixed = variants.where("mixed")
    hot = mixed.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > anchor_rows)
    hot = materialize(hot.select("anchor", F.lit(True).alias("hot")), "hot-anchors")
    mixed = mixed.join(hot, "anchor", "left").select(
        F.col("at.key").alias("key"), F.struct("anchor", F.col("at.start").alias("start"), F.col("at.stop").alias("stop"),
                                               F.coalesce("hot", F.lit(False)).alias("hot")).alias("part"))
    wanted = mixed.groupBy("key").agg(F.collect_list("part").alias("parts"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BLOCK_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            raw, keys, parts = data.tobytes(), batch.column("key").to_pylist(), batch.column("parts").to_pylist()
            out: dict[str, list] = {"key": [], "start": [], "anchor": [], "body": [], "high": [], "low": []}
            for k, listed in enumerate(parts):
                for p in listed:
                    base = int(offsets[k])
                    for s in range(p["start"], p["stop"] + 1) if p["hot"] else (p["start"],):
                        body = raw[base + s: base + (s if p["hot"] else p["stop"]) + length]
                        mark = xxhash.xxh3_128_intdigest(body) if p["hot"] else None
                        for c, v in (("key", keys[k]), ("start", s), ("anchor", p["anchor"]), ("body", None if p["hot"] else body),
                                     ("high", mark and (mark >> 64) - 2 ** 63), ("low", mark and (mark & (2 ** 64 - 1)) - 2 ** 63)):
                            out[c].append(v)
            kinds = [batch.schema.field("key").type, pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], list(out))

    fetched = rows.join(wanted, "key").mapInArrow(fetch, f"key {kind}, start int, anchor long, body binary, high long, low long")
    fetched = materialize(fetched, "variant-texts")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {"key": [], "start": [], "body": [], "anchor": []}
        for batch in batches:
            held["type"] = batch.schema.field("key").type
            for row in batch.select(["key", "start", "body", "anchor"]).to_pylist():
                full = sum(map(len, held["body"])) if held["anchor"] and row["anchor"] != held["anchor"][-1] else 0
                if full >= BLOCK_BYTES:
                    yield _index_block(held, length)
                    held |= {c: [] for c in ("key", "start", "body", "anchor")}
                for c in ("key", "start", "body", "anchor"):
                    held[c].append(row[c])
        if held["body"]:
            yield _index_block(held, length)

    bodies = fetched.where("body IS NOT NULL").select("key", "start", "body", "anchor")
    marked = bodies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(index, f"key {kind}, start int, stop int")
    single = fetched.where("body IS NULL").select("key", "start", "high", "low")
    common_windows = single.groupBy("high", "low").agg(F.count("*").alias("n")).where("n > 1").select("high", "low")
    counted = single.join(common_windows, ["high", "low"]).select("key", "start", (F.col("start") + length).cast("int").alias("stop"))
    return twice.unionByName(marked).unionByName(counted)


def remove_repeats(docs: DataFrame, length: int = 400, anchor_rows: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans`` for every row; ``kept`` are the remaining bytes.

    Every byte covered by a ``length``-byte string that also starts at another place, in
    this or another row, is removed; strings are judged on the input. Null text is empty.
    Repeated rows are places of their own, so texts of ``length`` bytes or more in them go
    wholly; equal rows give equal results. A null id is an id like others. An empty table
    gives no rows; other columns are ignored.
    """
    spans = repeated_spans(docs, length, anchor_rows, id_col, text_col)
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = docs.select(F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")).alias("key"),
                       F.col(text_col).alias("text")).join(spans, "key", "left")
    rows = rows.select(F.col("key.doc_id").alias("doc_id"), "text", "spans")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BLOCK_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            kept, counts = [], []
            for k, listed in enumerate(batch.column("spans").to_pylist()):
                text = data[offsets[k]: offsets[k + 1]]
                gone = np.zeros(len(text), bool)
                for s in listed or ():
                    gone[s["start"]: s["stop"]] = True
                kept.append(text[~gone].tobytes())
                counts.append((len(text), int(gone.sum()), len(_runs(gone)[0])))
            numbers = np.array(counts, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.binary()), *map(pa.array, numbers.T)],
                                             ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return rows.mapInArrow(clean, f"doc_id {kind}, kept binary, n_bytes long, n_removed long, n_spans long")
