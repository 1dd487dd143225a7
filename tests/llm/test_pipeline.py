"""The corpus pipeline: each stage keeps what the next one may need, and does its work."""

import re

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from tidemark.llm import queries
from tidemark.session import materialize
from test_decontam import slow_hits
from test_nearcopies import slow_components
from test_pii import slow_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def test_all_but_the_last_return_documents(results):
    columns = results["start"].columns
    assert all(results[n].columns == columns for n, _ in corpus_pipeline.STAGES[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "pii", "mix"]


def test_quality_keeps_the_good(spark, results):
    kept = {r.doc_id for r in results["quality"].collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good, bad = [r.doc_id in kept for r in labels if r.quality == 1], [r.doc_id in kept for r in labels if r.quality == 0]
    # The smallest tables have seven bad texts to learn from; test_quality holds the accuracy on larger ones.
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.4 * len(bad)


def test_one_of_each_group_stays(results):
    before = slow_components([(r.doc_id, r.text) for r in results["quality"].collect()])
    assert {r.doc_id for r in results["near_dedup"].collect()} == set(before.values())


def test_contaminated_go_and_personal_data_too(spark, results):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    wanted = {r.doc_id for r in results["near_dedup"].collect() if not slow_hits(r.text, items)[1]}
    clean = {r.doc_id: r for r in results["pii"].collect()}
    assert {r.doc_id for r in results["decontaminate"].collect()} == wanted == set(clean)
    for r in results["decontaminate"].collect():
        assert slow_spans(clean[r.doc_id].text) == [] and clean[r.doc_id].n_chars == len(clean[r.doc_id].text)
        if not re.search("[0-9]", r.text):
            assert clean[r.doc_id].text == r.text


def test_the_mix_repeats_what_is_left(results):
    rows = results["mix"].collect()
    texts = {r.doc_id: r.text for r in results["pii"].collect()}
    assert rows and all(texts[r.doc_id] == r.text and 1 <= r.epoch <= 2 for r in rows)


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_sql(spark, name):
    assert compare(spark, connect(SF), queries.QUERIES[name], queries.ORACLE[name], SF) == []


def run_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, SF), f"odd-{name}")
        assert out.columns == docs.columns
        docs = out
    return docs, materialize(corpus_pipeline.mix_sources(spark, docs, SF), "odd-mix")


def test_odd_rows_pass_all_stages(spark):
    """Null ids, texts and sources, repeated rows, a very long text, and columns named as the stages' own."""
    good = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), i, "k", 7.0) for i, t in enumerate(good)]
    rows += [(None, good[0] + " more words", None, None, None, None, None, None), (None, None, "en", "s0", None, 1, "k", 0.0), (900, "", "en", "s0", 0, 1, "k", 0.0)]
    rows += [rows[3]] * 3 + [(901, " ".join(good) * 20, "en", "s1", None, 1, "k", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, epoch long, key string, score double")
    kept, mixed = run_stages(spark, docs)
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) <= 43 and {"epoch", "size", "target"} <= set(mixed.columns)
    assert {r.doc_id for r in mixed.collect()} <= set(ids)


def test_an_empty_table_passes_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    kept, mixed = run_stages(spark, docs)
    assert kept.count() == mixed.count() == 0


def test_stages_leave_nothing_behind_on_the_driver(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(5)
    for name, stage in corpus_pipeline.STAGES:
        left = spark.sparkContext._jvm.java.lang.ref.WeakReference(spark.sparkContext._jvm.java.util.ArrayList())
        assert stage(spark, docs, SF) is not None
        assert left.get() is None, name
