"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (document, position) for every training token that is a term of
the test items, written once to the shared folder. Every window of ten test words is
looked up by its rarest term; the other terms' lists are shifted by their offsets and
intersected with it. Only SQL functions are used. Postings are spread by document and
position, so a frequent term or a document full of matches is no hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import lower_ascii, row_key, small
from tidemark.session import materialize

# A word is a run of ASCII letters and digits and of all longer characters; what stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Tables up to this many rows (about 50 bytes each) are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000


def tokens(text: Column) -> Column:
    """The words of a text, A-Z lowered; none for null.

    On documents ``split`` took about a sixth of the CPU of ``regexp_extract_all``.
    """
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), BETWEEN), ""), F.array().cast("array<string>"))


def test_windows(items: DataFrame, length: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, window, terms``: all runs of ``length`` words; a shorter item is one window.

    Items without words have none. Equal windows of different items keep their item.
    """
    words = items.select(F.col(id_col).alias("item_id"), tokens(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (length - 1), F.lit(1)))
    each = words.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.slice("words", F.col("start"), length).alias("terms")).distinct()
    return each.withColumn("window", F.xxhash64("item_id", "terms"))


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``key, pos, term_id`` of the given ``term, term_id`` in all documents, as a stored table.

    Term 0, the end mark, has one posting per row of ``docs``: its position is the number
    of words.
    """
    end = terms.sparkSession.createDataFrame([("", 0)], "term string, term_id long")
    wanted = small(terms.select("term", F.col("term_id").cast("long")).unionByName(end), BROADCAST_ROWS)
    words = docs.select(row_key(id_col, text_col).alias("key"), F.array_append(tokens(F.col(text_col)), F.lit("")).alias("words"))
    places = words.select(F.col("key.doc_id").alias("doc_id"), F.col("key.text_hash").alias("text_hash"),
                          F.posexplode("words").alias("pos", "term"))
    return materialize(places.join(wanted, "term").select("doc_id", "text_hash", "pos", "term_id"), "postings")


def _keyed(postings: DataFrame) -> DataFrame:
    return postings.select(F.struct("doc_id", "text_hash").alias("key"), "pos", "term_id")


def find(postings: DataFrame, windows: DataFrame, slack: int = 0, share: float = 1.0) -> DataFrame:
    """``key, item_id, window, start, length, matched``: places where a window occurs.

    ``windows`` has ``item_id, window, terms`` with ``terms`` as term ids. With ``slack`` 0
    and ``share`` 1 these are the exact phrases. Otherwise proximity matches: around the
    rarest term, at least ``share`` of the terms stand within ``slack`` words of their place.
    """
    counts = postings.where("term_id > 0").groupBy("term_id").agg(F.count("*").alias("n"))
    listed = windows.select("item_id", "window", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term_id"))
    rarest = Window.partitionBy("window").orderBy("n", "offset")
    heads = 1 if slack or share < 1 else 2  # an exact phrase holds its second rarest term too
    heads = (listed.join(counts, "term_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
             .withColumn("place", F.row_number().over(rarest)).where(F.col("place") <= heads)
             .withColumn("heads", F.least(F.lit(heads), "length")))
    heads = materialize(heads.select("item_id", "window", "length", "heads", "place", "term_id", F.col("offset").alias("shift")), "heads")
    starts = _keyed(postings).join(small(heads, BROADCAST_ROWS), "term_id").select(
        "key", "item_id", "window", "length", "heads", "place", (F.col("pos") - F.col("shift")).alias("start"))
    starts = starts if slack else starts.where("start >= 0")
    starts = starts.groupBy("key", "item_id", "window", "length", "heads", "start").agg(F.bit_or(F.col("place")).alias("met"))
    starts = starts.where("met = if(heads = 1, 1, 3)").select("key", "item_id", "window", "length", "start")
    starts = materialize(starts, "starts")
    keys = small(starts.select("key").distinct(), BROADCAST_ROWS)
    lists = _keyed(postings).where("term_id > 0").join(keys, "key", "left_semi").distinct()

    expected = starts.join(small(listed.select("window", "offset", "term_id"), 10 * BROADCAST_ROWS), "window")
    near = F.explode(F.sequence(F.lit(-slack), F.lit(slack))).alias("shift")
    expected = expected.select("key", "item_id", "window", "length", "start", "offset", "term_id", near).select(
        "key", "item_id", "window", "length", "start", "offset", "term_id",
        (F.col("start") + F.col("offset") + F.col("shift")).alias("pos")).distinct()
    met = expected.join(lists, ["key", "pos", "term_id"]).groupBy("key", "item_id", "window", "length", "start").agg(
        F.countDistinct("offset").alias("matched") if slack else F.count("*").alias("matched"))
    return met.where(F.col("matched") >= F.ceil(F.col("length") * F.lit(share)))


def contamination(docs: DataFrame, items: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key, doc_id, n_words, n_hit, items`` for every row of ``docs``.

    A word is hit if it lies in any occurrence of any window of ``length`` words of an
    item; ``items`` are the ids of the items with such windows. Null text has no words.
    Repeated rows give equal rows; null ids are ids like others; without items nothing is
    hit; an empty table gives no rows. Other columns are ignored.
    """
    windows = materialize(test_windows(items, length), "windows")
    terms = windows.select(F.explode("terms").alias("term")).distinct().withColumn(
        "term_id", F.xxhash64("term").bitwiseAND((1 << 62) - 1) + 1)
    hashed = windows.select("item_id", "window", F.transform("terms", lambda t: F.xxhash64(t).bitwiseAND((1 << 62) - 1) + 1).alias("terms"))
    postings = build_index(docs, terms, id_col, text_col)
    hits = materialize(find(postings, hashed).select("key", "item_id", "start", "length"), "hits")
    words = hits.select("key", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    n_hit = words.groupBy("key").agg(F.count("*").alias("n_hit"))
    found = hits.select("key", "item_id").distinct().groupBy("key").agg(F.collect_list("item_id").alias("items"))
    whole = _keyed(postings.where("term_id = 0")).select("key", F.col("pos").cast("long").alias("n_words"))
    kind = items.schema["item_id"].dataType.simpleString()
    return whole.join(n_hit.join(found, "key"), "key", "left").select(
        "key", "key.doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """The rows of ``docs`` without any word of a test window, all columns as they are."""
    bad = contamination(docs, items, length).where("n_hit > 0").select("key").distinct()
    bad = small(materialize(bad, "contaminated"), BROADCAST_ROWS)
    return docs.select(F.struct("*").alias("row"), row_key().alias("key")).join(bad, "key", "left_anti").select("row.*")
