import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes as C
from tidemark.operators.quality import append_merge_schema
from tidemark.plans.common import folders
from tidemark.streaming import cdc as stream_cdc

PARCEL = "port string, phase string, weight bigint, crate string, id bigint"


def rows(df, *order):
    return sorted((tuple(r) for r in df.select(*order or df.columns).collect()), key=repr)


def at(n):
    return F.lit(f"2024-01-{n + 1:02d}").cast("timestamp")


def test_merge_golden_case(spark):
    target = spark.createDataFrame([("OSLO", "open", 40, "B", 7)], PARCEL)
    source = spark.createDataFrame([("BERN", "late", 55.0, "C", 7), ("ROME", "late", 60.0, "B", 8)],
                                   PARCEL.replace("weight bigint", "weight float"))
    out = C.merge(target, source, ["id"], [C.Update({"weight": F.col("source.weight")}), C.Insert()])
    assert rows(out.rows) == [("OSLO", "open", 55, "B", 7), ("ROME", "late", 60, "B", 8)]
    kinds = sorted(r["_change_type"] for r in out.changes.collect())
    assert kinds == ["insert", "update_postimage", "update_preimage"]


KV = "k int, v int"


def test_merge_first_true_clause_wins_and_null_conditions_do_nothing(spark):
    target = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 4)], KV)
    source = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (5, None), (6, 60)], KV)
    t, s = F.col("target.v"), F.col("source.v")
    out = C.merge(target, source, ["k"], [
        C.Delete(t == 1), C.Update({"v": s}, t >= 1), C.Insert({"k": F.col("source.k"), "v": -s}, s > 0)])
    assert rows(out.rows) == [(2, 20), (3, None), (4, 4), (6, -60)]


def test_merge_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, 1), (1, 1)], KV)
    source = spark.createDataFrame([(None, 9), (1, 2)], KV)
    out = C.merge(target, source, ["k"], [C.Update(), C.Insert()])
    assert rows(out.rows) == [(1, 2), (None, 1), (None, 9)]


def test_merge_refuses_two_source_rows_for_one_target_row(spark):
    target = spark.createDataFrame([(1, 1)], KV)
    source = spark.createDataFrame([(1, 2), (1, 3)], KV)
    with pytest.raises(Exception, match="several source rows"):
        C.merge(target, source, ["k"], [C.Update()]).rows.collect()
    with pytest.raises(Exception, match="several source rows"):
        C.merge(target, source, ["k"], [C.Delete()]).changes.collect()


def test_merge_keeps_duplicate_inserts_and_duplicate_target_rows(spark):
    target = spark.createDataFrame([(1, 1), (1, 5)], KV)
    source = spark.createDataFrame([(1, 2), (7, 3), (7, 4)], KV)
    out = C.merge(target, source, ["k"], [C.Update(), C.Insert()])
    assert rows(out.rows) == [(1, 2), (1, 2), (7, 3), (7, 4)]


CLIENT = "id bigint, name string, operation string, day int"


def cdc(spark, target, ops, **options):
    base = spark.createDataFrame(target, "id bigint, name string, day int")
    batch = spark.createDataFrame(ops, CLIENT)
    return C.apply_cdc(base, batch, "id", [F.desc("day"), F.desc("name")], **options)


def test_cdc_golden_case(spark):
    out = cdc(spark, [(1, "old", 0), (2, "x", 0)], [(1, "new", "UPDATE", 5), (2, None, "DELETE", 5)])
    assert rows(out.rows) == [(1, "new", 5)]


def test_cdc_unknown_delete_and_null_operation_do_nothing(spark):
    out = cdc(spark, [(1, "a", 0)], [(9, None, "DELETE", 1), (1, "b", None, 1), (8, "c", None, 1)])
    assert rows(out.rows) == [(1, "a", 0)] and out.changes.count() == 0


def test_cdc_newest_operation_wins_and_ties_give_one_row(spark):
    out = cdc(spark, [], [(1, "a", "INSERT", 1), (1, "b", "UPDATE", 2), (1, "c", "UPDATE", 2), (2, "z", "INSERT", 1),
                          (2, None, "DELETE", 3)])
    assert rows(out.rows) == [(1, "c", 2)]


def test_cdc_guard_against_older_operations(spark):
    late = [(1, "late", "UPDATE", 3), (2, None, "DELETE", 3)]
    assert rows(cdc(spark, [(1, "a", 9), (2, "b", 1)], late, not_older="day").rows) == [(1, "a", 9)]
    assert rows(cdc(spark, [(1, "a", 9), (2, "b", 1)], late).rows) == [(1, "late", 3)]


def test_change_feed_golden_case(spark):
    df = spark.createDataFrame([(1, "a"), (13, "b")], "id int, name string")
    gone = C.delete_where(df, F.col("id") == 1)
    renamed = C.update_where(gone.rows, F.col("id") == 13, {"name": F.lit("Marwa")})
    assert rows(gone.changes) == [(1, "a", "delete")]
    assert rows(renamed.changes) == [(13, "Marwa", "update_postimage"), (13, "b", "update_preimage")]
    assert rows(C.diff_changes(df, renamed.rows, ["id"])) == sorted(
        rows(gone.changes) + rows(renamed.changes), key=repr)


def test_log_versions_restore_and_expire(spark):
    path, = folders(spark, "log", "log")
    table = spark.createDataFrame([(i, i) for i in range(5)], KV)
    C.write_version(table.withColumn("_change_type", F.lit("insert")), path, 0, at(0))
    states = [rows(table)]
    steps = [lambda t: C.delete_where(t, F.col("k") == 1),
             lambda t: C.update_where(t, F.col("k") > 2, {"v": F.col("v") * 10}),
             lambda t: C.merge(t, spark.createDataFrame([(1, 7), (2, 8)], KV), ["k"], [C.Update(), C.Insert()])]
    for version, step in enumerate(steps, 1):
        change = step(C.as_of(C.read_log(spark, path), ["k"], version - 1))
        C.write_version(change.changes, path, version, at(version))
        states.append(rows(C.as_of(C.read_log(spark, path), ["k"])))
    log = C.read_log(spark, path)
    assert states[3] == [(0, 0), (1, 7), (2, 8), (3, 30), (4, 40)]
    for version, state in enumerate(states):
        assert rows(C.as_of(log, ["k"], version)) == state
        assert rows(C.as_of_time(log, ["k"], at(version))) == state
    assert C.latest_version(log) == 3
    assert [r["deleted"] for r in C.history(log).collect()] == [0, 0, 1, 0]
    C.write_version(C.restore(log, ["k"], 1), path, 4, at(4))
    assert rows(C.as_of(C.read_log(spark, path), ["k"])) == states[1]
    short = C.expire(log, ["k"], 2)
    assert rows(C.as_of(short, ["k"], 2)) == states[2] and rows(C.as_of(short, ["k"])) == states[3]
    assert C.table_changes(short, 0, 1).count() == 0
    copy, = folders(spark, "clone", "copy")
    C.clone(log, ["k"], 2, copy)
    assert rows(spark.read.parquet(copy)) == states[2]


def test_log_with_a_new_column(spark):
    path, = folders(spark, "log", "log")
    C.write_version(spark.createDataFrame([(1, 1, "insert")], KV + ", _change_type string"), path, 0, at(0))
    C.write_version(spark.createDataFrame([(2, 2, "x", "insert")], KV + ", zip string, _change_type string"), path, 1, at(1))
    assert rows(C.as_of(C.read_log(spark, path), ["k"]), "k", "v", "zip") == [(1, 1, None), (2, 2, "x")]


def test_replayed_version_replaces_itself(spark):
    path, = folders(spark, "log", "log")
    first = spark.createDataFrame([(1, 1, "insert")], KV + ", _change_type string")
    for _ in range(2):
        C.write_version(first, path, 0, at(0))
    assert C.read_log(spark, path).count() == 1


def test_init_change_log(spark):
    log = C.init_change_log(spark.createDataFrame([(1, 1)], KV), at(0))
    assert rows(log, "_change_type", "_commit_version") == [("insert", 0)]


def test_propagate_drops_preimages_and_cleans(spark):
    gold = spark.createDataFrame([(1, "a"), (2, "b")], "id int, address string")
    feed = spark.createDataFrame(
        [(1, "a", "update_preimage", 3), (1, 'x"y"', "update_postimage", 3), (2, "b", "delete", 4), (3, '"n"', "insert", 2)],
        "id int, address string, _change_type string, _commit_version long")
    assert rows(C.propagate(gold, feed, "id", ["address"]).rows) == [(1, "xy"), (3, "n")]


def test_forget_deletes_in_both_layers(spark):
    raw = spark.createDataFrame([("1", '{"u":"a"}'), ("2", '{"u":"b"}'), ("3", "junk")], "seq string, data string")
    typed = spark.createDataFrame([("a",), ("b",)], "u string")
    in_raw, in_typed = C.forget(raw, typed, "u", "a", "seq", F.from_json("data", "u string")["u"])
    assert rows(in_raw.rows, "seq") == [("2",), ("3",)] and rows(in_typed.rows) == [("b",)]
    assert in_raw.changes.count() == in_typed.changes.count() == 1


def test_append_evolved(spark):
    old = spark.createDataFrame([(1,)], "id int")
    new = spark.createDataFrame([("75010", 2)], "zip string, id int")
    assert rows(append_merge_schema(old, new)) == [(1, None), (2, "75010")]


def test_latest_is_limited_before_the_shuffle(spark):
    from tidemark.operators.latest import latest_per_key
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = latest_per_key(df, ["k"], [F.desc("v")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("seed", range(4))
def test_merge_equals_brute_force(spark, seed):
    import random
    rng = random.Random(seed)
    value = lambda: rng.choice([None, *range(6)])
    target = [(rng.choice([None, *range(12)]), value()) for _ in range(30)]
    source = [(k, value()) for k in rng.sample([None, *range(16)], 12)] + [(None, 3), (20, 1), (20, 1)]
    clauses = [C.Delete(F.col("source.v") < 1), C.Update({"v": F.col("source.v") + 10}, F.col("target.v") > 2),
               C.Update(None, F.col("source.v") > 4), C.Insert({"k": F.col("source.k")}, F.col("source.v") == 1),
               C.Insert(None, F.col("source.v") > 2)]
    by_key = {k: v for k, v in source if k is not None and k != 20}
    wanted = []
    for k, v in target:
        s = by_key.get(k)
        if k not in by_key:
            wanted.append((k, v))
        elif s is not None and s < 1:
            continue
        elif v is not None and v > 2:
            wanted.append((k, None if s is None else s + 10))
        else:
            wanted.append((k, s if s is not None and s > 4 else v))
    present = {k for k, _ in target}
    for k, v in source:
        if (k is None or k not in present) and v is not None:
            wanted += [(k, None)] if v == 1 else [(k, v)] if v > 2 else []
    out = C.merge(spark.createDataFrame(target, KV), spark.createDataFrame(source, KV), ["k"], clauses)
    assert rows(out.rows) == sorted(wanted, key=repr)


def test_staged_cdc_gives_the_same_result(spark):
    target, ops = [(1, "a", 0), (2, "b", 0)], [(1, "x", "UPDATE", 2), (2, None, "DELETE", 1), (3, "n", "INSERT", 1)]
    assert rows(cdc(spark, target, ops, stage=True).rows) == rows(cdc(spark, target, ops).rows)


def test_replayed_stream_batch_changes_nothing(spark):
    from tidemark.sources.files import stream_table
    from tidemark.streaming.cdc import cdc_stream
    source, log, first, second = folders(spark, "replay", "in", "log", "c1", "c2")
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id bigint, name string, day int")
    C.write_version(base.withColumn("_change_type", F.lit("insert")), log, 0, at(0), "id")
    spark.createDataFrame([(1, "x", "UPDATE", 1), (2, None, "DELETE", 1)], CLIENT).write.parquet(source)
    results = []
    for checkpoint in (first, second):  # the second checkpoint has forgotten the first run
        cdc_stream(stream_table(spark, source, CLIENT), log, "id", [F.desc("day")], ["id", "name", "day"], checkpoint,
                   first_version=1, available_now=True).awaitTermination()
        results.append(rows(C.read_log(spark, log, base.schema)))  # commit times too
    assert results[0] == results[1] and rows(C.as_of(C.read_log(spark, log, base.schema), ["id"])) == [(1, "x", 1)]


def test_stream_batches_read_their_own_buckets_only(spark):
    from tidemark.streaming.cdc import _before
    log, = folders(spark, "buckets", "log")
    base = spark.range(1000).select(F.col("id"), F.lit("a").alias("name"))
    C.write_version(base.withColumn("_change_type", F.lit("insert")), log, 0, at(0), "id")
    batch = base.filter("id IN (3, 5)").withColumn("operation", F.lit("UPDATE"))
    before = _before(batch, log, 1, "id", ["id", "name"], 16)
    own = {r["b"] for r in batch.select(C.bucket("id", 16).alias("b")).collect()}
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in before.inputFiles()} == own and len(own) <= 2
    assert rows(before) == [(3, "a"), (5, "a")]


def test_merge_and_lookups_plan_no_sort_aggregate_for_texts(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    plan = C.merge(target, target, ["k"], [C.Update(None)]).rows._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def keyed_log(spark, path, versions=100, width=100, keys=5000):
    """Each version upserts ``width`` neighbouring keys of ``keys``; all are written together."""
    rows_ = spark.range(versions * width).select(
        (F.col("id") % keys).alias("id"), F.floor(F.col("id") / width).cast("int").alias("v"), F.lit(None).cast("timestamp").alias("_commit_timestamp"),
        F.when(F.col("id") < keys, "insert").otherwise("update_postimage").alias("_change_type"))
    rows_ = rows_.withColumn("_commit_version", F.col("v").cast("long")).withColumn("_bucket", C.bucket("id", 4)).coalesce(1)
    rows_.write.partitionBy("_commit_version", "_bucket").parquet(path)
    C.write_filters(spark, path, rows_.schema["id"])


def test_few_keys_open_few_folders(spark, monkeypatch):
    """Ten keys on a log of a hundred versions: the folders read are few more than those that hold them."""
    path, = folders(spark, "filters", "log")
    keyed_log(spark, path)
    asked = spark.createDataFrame([(k, 0) for k in [*range(250, 255), 4990, 4991, 17, 99_999, None]], "id long, v int")
    read = []
    monkeypatch.setattr(stream_cdc, "as_of", lambda log, keys: read.append(log.inputFiles()) or C.as_of(log, keys))
    before = stream_cdc._before(asked, path, 100, "id", ["id", "v"], 4)
    assert {(r["id"], r["v"]) for r in before.collect()} == {*((k, 52) for k in range(250, 255)), (4990, 99), (4991, 99), (17, 50)}
    holding = spark.read.parquet(path).where(F.col("id").isin([r["id"] for r in asked.collect() if r["id"] is not None]))
    holding = holding.select("_commit_version", "_bucket").distinct().count()
    assert holding <= len({p.rsplit("/", 1)[0] for p in read[0]}) <= holding + 40 < 100 * 4 / 4
    # Lower versions only, and a table without any hit is empty.
    assert {(r["id"], r["v"]) for r in stream_cdc._before(asked, path, 50, "id", ["id", "v"], 4).collect()} == {
        *((k, 2) for k in range(250, 255)), (4990, 49), (4991, 49), (17, 0)}
    assert stream_cdc._before(asked.where("id = 99999"), path, 1, "id", ["id", "v"], 4).count() == 0
    assert stream_cdc._before(asked.where("id IS NULL"), path, 100, "id", ["id", "v"], 4).count() == 0


def test_filters_grow_with_the_keys_of_a_folder(spark):
    keys = spark.range(50_000).select("id", F.lit(0).alias("_bucket"))
    found = C.key_filter(keys, "id").collect()
    assert {r["_slices"] for r in found} == {16} and {r["_slice"] for r in found} == set(range(16))
    path, = folders(spark, "filters", "log")
    C.write_version(spark.range(50_000).withColumn("_change_type", F.lit("insert")), path, 0, at(1), "id", 1)
    known = spark.range(49_990, 50_000)
    assert C.folders_with(spark, path, known, "id", 1, 1) == [(0, 0)]
    strange = [C.folders_with(spark, path, spark.range(n, n + 1), "id", 1, 1) for n in range(60_000, 60_020)]
    assert sum(map(len, strange)) < 8  # about one in nine is a false hit


def test_folded_logs_have_filters_too(spark):
    path, folded = folders(spark, "filters", "log", "folded")
    keyed_log(spark, path, 6, 10, 30)
    stream_cdc.compact_log(spark, path, ["id"], 3, folded, 4)
    assert C.folders_with(spark, folded, spark.createDataFrame([(1,)], "id long"), "id", 99, 4)
    rows_ = stream_cdc._before(spark.createDataFrame([(1, 0), (15, 0)], "id long, v int"), folded, 6, "id", ["id", "v"], 4).collect()
    assert {(r["id"], r["v"]) for r in rows_} == {(1, 3), (15, 4)}


def test_commit_records_know_the_operation(spark):
    path, = folders(spark, "records", "log")
    rows_ = lambda *r: spark.createDataFrame(list(r), "id long, v int")
    C.write_version(rows_((1, 1)).withColumn("_change_type", F.lit("insert")), path, 0, at(1), operation="WRITE")
    merged = C.merge(rows_((1, 1)), rows_((2, 2)), ["id"], [C.Update(), C.Insert()])
    C.write_version(merged.changes, path, 1, at(2), operation="MERGE", source="batch 7")
    C.write_version(C.delete_where(rows_((1, 1)), F.col("id") > 5).changes, path, 2, at(3), operation="DELETE")
    C.write_version(C.delete_where(rows_((1, 1)), F.col("id") > 5).changes, path, 2, at(3), operation="DELETE")  # a replay
    found = [(r["version"], r["operation"], r["inserted"], r["updated"], r["deleted"], r["source"]) for r in C.commit_history(spark, path).collect()]
    assert found == [(2, "DELETE", 0, 0, 0, None), (1, "MERGE", 1, 0, 0, "batch 7"), (0, "WRITE", 1, 0, 0, None)]


@pytest.mark.parametrize("seed", range(3))
def test_merge_in_one_pass_equals_the_other_way(spark, seed, capsys):
    """Random targets and sources with NULL keys, unmatched duplicates and every kind of clause."""
    import random
    rng = random.Random(seed)
    key = lambda: rng.choice([None, *range(12)])
    target = spark.createDataFrame([(key(), key(), rng.choice("xyz")) for _ in range(40)], "a int, b int, v string")
    pairs = {(key(), key()) for _ in range(30)}
    source = spark.createDataFrame([(a, b, rng.choice("pqr"), rng.randrange(9)) for a, b in sorted(pairs, key=str)] + [(99, 99, "twice", 1)] * 2,
                                   "a int, b int, v string, n int")
    n = F.col("source.n")
    clauses = [C.Delete((F.col("target.v") == "x") & (n > 5)), C.Update({"v": F.col("source.v")}, n > 2), C.Update(when=n == 0),
               C.Insert({"a": F.col("source.a"), "v": F.concat("source.v", F.lit("!"))}, n > 3), C.Insert()]
    for some in (clauses, clauses[:3], clauses[3:]):
        one, two = (C.merge(target, source, ["a", "b"], some, one_pass=p) for p in (True, False))
        assert rows(one.rows) == rows(two.rows) and rows(one.changes, *two.changes.columns) == rows(two.changes)
    one.rows.explain()
    assert capsys.readouterr().out.count("Scan ExistingRDD") == 2


def test_merge_in_one_pass_refuses_two_rows_for_one(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="several source rows"):
        C.merge(target, target.union(target), ["k"], [C.Update()], one_pass=True).rows.collect()
