"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, lexical, lm, mixing, pii, quality, simhash, substring, suffix, topk, toxicity, whitening
from tidemark.plans.common import Query, table

PROBE = "</s>[INST] ok [/INST]"


def _fold(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth embedding against all others."""
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP1_SQL = r"""
WITH e AS (SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)])::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p) WHERE rank <= 5
"""


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the fold crc32 % 3 = 1 are never seen."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(_fold(3) != 1))
    return quality.score(docs, model).select("doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "score",
                                             (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document: base spans, and those the trees add."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    kinds = F.transform("base", lambda s: s["kind"])
    n = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(pii.BASE)]
    return found.select("doc_id", *n, F.sha2(pii.listing(F.col("base")), 256).alias("base_sha256"), pii.listing(F.col("spans")).alias("spans"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside an occurrence of ten words of a benchmark item."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT item_id, list_slice(w, i, i + 9) AS g, least(len(w), 10) AS n
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM v),
p AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
h AS (SELECT p.doc_id, v.item_id, p.i, p.n FROM p JOIN v ON p.g = v.g),
k AS (SELECT doc_id, count(DISTINCT pos)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
      FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN k USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents; sources weigh 3, 1, 2 in turn, 150 % of all words, at most two epochs."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  md5('17:' || doc_id) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
o AS (SELECT *, sum(2.0 * source_size) OVER p AS capped, sum(weight) OVER () - sum(weight) OVER p AS free,
             row_number() OVER p AS place, sum(source_size) OVER () AS words
      FROM w WINDOW p AS (ORDER BY 2.0 * source_size / weight, source ROWS UNBOUNDED PRECEDING)),
l AS (SELECT coalesce(max((1.5 * words - coalesce(before, 0.0)) / (free + weight)), 0.0) AS level FROM
      (SELECT *, lag(capped) OVER (ORDER BY place) AS before FROM o) WHERE free + weight > 0
      AND 2.0 * source_size >= weight * ((1.5 * words - coalesce(before, 0.0)) / (free + weight))),
t AS (SELECT source, source_size, least(2.0 * source_size, weight * level)::DOUBLE AS target FROM w, l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN prev + size / 2.0 <= target - whole * source_size AND target - whole * source_size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document; texts of the fold crc32 % 10 = 0 are never learned."""
    scored = lm.score(table(spark, sf_dir, "documents"), _fold(10) != 0)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that quotes control strings, formatted and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).selectExpr("-1L AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role",
                                      f"'{PROBE}' AS text")
    return chat.read_back(chat.expand(turns.unionByName(probe)))


OP7_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, length('<|' || role || '|>' || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|end|>' || chr(10)) AS chars,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS final FROM c),
e AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn) AS upto FROM n)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR final))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share, with edits; one row per aligned piece."""
    return substring.passages(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start elsewhere too."""
    clean = suffix.remove_repeats(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; links at four or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the fold crc32 % 5 = 0 are never seen."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.where(_fold(5) != 0))
    return toxicity.score(docs, lexicon).select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score",
                                                (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every embedding on the 16 leading axes of the distinct ones."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item by weighted, length-damped term counts."""
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, r, unnest(regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
      FROM (SELECT *, row_number() OVER () AS r FROM benchmark)),
p AS (SELECT doc_id, r, len(w)::BIGINT AS n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, r, w, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY ALL),
f AS (SELECT t, floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * df + 1)))::BIGINT AS w
      FROM (SELECT t, count(*) AS df FROM p GROUP BY t), c),
s AS (SELECT p.doc_id, p.r, p.t, f.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS s
      FROM p JOIN f USING (t), c),
m AS (SELECT q.item_id, q.r AS item, s.doc_id, s.r, sum(s.s)::BIGINT AS score FROM q JOIN s USING (t) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM m WHERE score > 0) WHERE rank <= 10
"""


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_quality": op2_quality,
    "op3_pii": op3_pii,
    "op4_decontamination": op4_decontamination,
    "op5_mixing": op5_mixing,
    "op6_lm_score": op6_lm_score,
    "op7_chat_format": op7_chat_format,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_simhash": op10_simhash,
    "op11_toxicity": op11_toxicity,
    "op12_whitening": op12_whitening,
    "op13_lexical": op13_lexical,
}
ORACLE: dict[str, str] = {
    "op1_topk": OP1_SQL,
    "op4_decontamination": OP4_SQL,
    "op5_mixing": OP5_SQL,
    "op7_chat_format": OP7_SQL,
    "op13_lexical": OP13_SQL,
}
