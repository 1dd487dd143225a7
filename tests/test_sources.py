import json
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import quality as Q
from tidemark.plans.common import folders
from tidemark.sources import files, schema as S, tables, variants as V
from tidemark.streaming import evolve, sinks

READING = "depth double, buoy double, seen timestamp"
HINTS = "seen TIMESTAMP, tide STRUCT<metres: FLOAT, phase: STRING>"
PLAIN = '{"depth":12.5,"buoy":9.0,"seen":"2023-03-02T04:05:06.000Z"}'
EXTRA = PLAIN[:-1] + ',"harbour":"Bergen","tide":{"metres":0.75,"phase":"ebb"}}'
WRONG = ('{"depth":"12.5","buoy":9.0,"seen":"2023-03-02T04:05:06.000Z",'
         '"tide":{"metres":"three","phase":"flood"}}')


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_file_formats_round_trip(spark):
    csv, json, text, parquet = folders(spark, "formats", "csv", "json", "text", "parquet")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    df.write.csv(csv), df.write.json(json), files.write_parquet(df, parquet)
    df.select(F.to_json(F.struct("*"))).write.text(text)
    wanted = {(1, "a"), (2, "b")}
    for back in (files.read_csv(spark, csv, "id long, name string"), files.read_json(spark, json),
                 files.read_json(spark, json, "id long, name string"), files.read_parquet(spark, parquet)):
        assert {(r["id"], r["name"]) for r in back.collect()} == wanted
    assert files.read_text(spark, text).count() == 2
    files.write_parquet(df, parquet, "append")
    assert files.read_parquet(spark, parquet).count() == 4
    files.write_parquet(df, parquet, "overwrite")
    assert spark.sql(f"SELECT * FROM parquet.`{parquet}`").count() == 2


def test_envelope_decoding_keeps_sequence(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":1}'), "7")], "data binary, sequenceNumber string")
    assert files.decode_envelope(df, "data", keep=["sequenceNumber"]).collect()[0].asDict() == {
        "sequenceNumber": "7", "data": '{"a":1}'}


def test_runs_table_has_a_map(spark):
    path, = folders(spark, "runs", "runs")
    spark.createDataFrame([("e", "r", "FINISHED", "u", {"auc": 0.5})],
                          "experiment_id string, run_id string, status string, artifact_uri string, "
                          "metrics map<string,double>").write.parquet(path)
    assert files.read_runs(spark, path).collect()[0]["metrics"] == {"auc": 0.5}


def test_schema_is_inferred_once_and_hints_win(spark):
    source, kept = folders(spark, "infer", "in", "schema")
    lines(spark, PLAIN).write.text(source)
    schema = V.infer_and_store(spark, source, kept, hints=HINTS)
    assert schema["depth"].dataType == T.DoubleType() and schema["seen"].dataType == T.TimestampType()
    assert schema["tide"].dataType["metres"].dataType == T.FloatType()
    lines(spark, EXTRA).write.mode("append").text(source)
    assert V.infer_and_store(spark, source, kept, hints=HINTS) == schema
    S.store_schema(spark, kept, S.apply_schema_hints(schema, "more STRING"))
    assert "more" in S.stored_schema(spark, kept).names


def test_unknown_fields_also_nested(spark):
    schema = T.StructType.fromDDL("depth double, tide struct<metres: float>")
    df = lines(spark, EXTRA, "no json", '{"depth":1}')
    found = df.select(S.unknown_fields(F.col("value"), schema).alias("f")).collect()
    assert sorted(found[0]["f"]) == ["buoy", "harbour", "seen", "tide.phase"]
    assert found[1]["f"] == [] and found[2]["f"] == []
    assert {r["field"] for r in S.detect_new_fields(df, "value", schema).collect()} == set(found[0]["f"])


def test_rescue_keeps_the_row_and_the_raw_values(spark):
    schema = f"{READING}, tide struct<metres: float, phase: string>"
    df = lines(spark, WRONG, PLAIN, '{"depth": null, "tide": "text"}', "junk")
    out = S.parse_with_rescue(df, "value", schema).collect()
    wrong, plain, text, junk = out
    assert wrong["depth"] is None and wrong["buoy"] == 9.0 and wrong["tide"]["phase"] == "flood"
    assert wrong["_incorrect_data"] == '{"depth":"12.5","tide.metres":"three"}'
    assert plain["depth"] == 12.5 and plain["_incorrect_data"] is None
    assert text["_incorrect_data"] == '{"tide":"text"}'
    assert junk["depth"] is None and json.loads(junk["_incorrect_data"]) == {"": "junk"}


def test_rescue_loses_nothing(spark):
    """A map or a list of plain values that the parser gives up as a whole is rescued as a whole."""
    schema = "n INT, xs ARRAY<STRUCT<b: INT>>, m MAP<STRING, INT>, deep STRUCT<ys: ARRAY<INT>>"
    texts = {
        "garbage{": {"": "garbage{"}, "[1,2]": {"": "[1,2]"}, '"text"': {"": '"text"'}, '{"n": 1': {"": '{"n": 1'},
        '{"xs":[{"b":"bad"},{"b":2}]}': {"xs[0].b": "bad"}, '{"xs":[{"b":1,"c":5}]}': {"xs[0].c": "5"}, '{"xs":7}': {"xs": "7"},
        '{"m":{"k":"no","l":3}}': {"m": '{"k":"no","l":3}'}, '{"deep":{"ys":[1,"z"],"q":2}}': {"deep.ys": '[1,"z"]', "deep.q": "2"},
        '{"n":"x","new":[1]}': {"n": "x", "new": "[1]"}, '{"n":3,"xs":[],"m":{},"deep":{}}': None, '{"n":null}': None}
    out = S.parse_with_rescue(lines(spark, *texts).withColumn("raw", F.col("value")), "value", schema, extra=True).collect()
    assert {r["raw"]: r["_incorrect_data"] and json.loads(r["_incorrect_data"]) for r in out} == texts
    good = next(r for r in out if r["raw"].startswith('{"xs":[{"b":"bad"'))
    assert good["xs"][1]["b"] == 2
    names = S.detect_new_fields(lines(spark, *texts), "value", S.T.StructType.fromDDL(schema)).collect()
    assert {r["field"] for r in names} == {"xs[].c", "deep.q", "new"}


def test_variants_equal_the_raw_rescue(spark):
    """One parse gives the rows that three parses give, but for lists and maps with a misfit, whose other items stay."""
    schema = f"{READING}, tide struct<metres: float, phase: string>"
    texts = [WRONG, PLAIN, EXTRA, '{"depth": null, "tide": "text"}', "junk", "[1]", "7", "", None, '{"depth":3,"buoy":true,"seen":"never"}',
             '{"depth":1e300,"tide":{"metres":null,"phase":17,"more":[1,2]}}', '{"tide":{"phase":{"a":1}}}', "{}", '{"depth":1,"depth":2']
    df = lines(spark, *texts).withColumn("n", F.monotonically_increasing_id())
    for extra in (False, True):
        one = V.parse_with_rescue(df, "value", schema, extra=extra).orderBy("n").collect()
        assert one == S.parse_with_rescue(df, "value", schema, extra=extra).orderBy("n").collect()
    nested = "n INT, xs ARRAY<STRUCT<b: INT>>, m MAP<STRING, INT>, deep STRUCT<ys: ARRAY<INT>>"
    wanted = {
        '{"xs":[{"b":"bad"},{"b":2}]}': {"xs[0].b": "bad"}, '{"xs":[{"b":1,"c":5}]}': {"xs[0].c": "5"}, '{"xs":7}': {"xs": "7"},
        '{"m":{"k":"no","l":3}}': {"m.k": "no"}, '{"deep":{"ys":[1,"z"],"q":2}}': {"deep.ys[1]": "z", "deep.q": "2"},
        '{"n":"x","new":[1]}': {"n": "x", "new": "[1]"}, '{"n":1.5}': {"n": "1.5"}, '{"n":3,"xs":[],"m":{},"deep":{}}': None, '{"n":null}': None}
    out = V.parse_with_rescue(lines(spark, *wanted).withColumn("raw", F.col("value")), "value", nested, extra=True).collect()
    assert {r["raw"]: r["_incorrect_data"] and json.loads(r["_incorrect_data"]) for r in out} == wanted
    kept = next(r for r in out if r["raw"].startswith('{"m"'))
    assert kept["m"] == {"k": None, "l": 3}


def test_variants_are_parsed_once(spark, capsys):
    V.parse_with_rescue(lines(spark, PLAIN).repartition(2), "value", READING).explain()
    plan = capsys.readouterr().out
    assert plan.count("try_parse_json") + plan.count("parse_json") <= 2 and "from_json" not in plan


def test_inference_reads_every_file(spark):
    """The eleventh file is the first with a fraction, with a nested field and with a list."""
    source, kept = folders(spark, "infer", "in", "schema")
    for n in range(10):
        lines(spark, '{"a":1,"tide":{"x":"s"},"both":1}').coalesce(1).write.mode("append").text(source)
    lines(spark, '{"a":1.5,"tide":{"x":"s","new field":2},"list":[1,2.5],"both":"s","gone":null}', "junk", "[1]").coalesce(1).write.mode("append").text(source)
    schema = V.infer_and_store(spark, source, kept, hints="more STRING")
    wanted = "a DOUBLE, both STRING, gone STRING, list ARRAY<DOUBLE>, tide STRUCT<`new field`: BIGINT, x: STRING>, more STRING"
    assert schema == T.StructType.fromDDL(wanted)
    lines(spark, '{"z":1}').write.mode("append").text(source)
    assert V.infer_and_store(spark, source, kept) == schema
    assert V.schema_of_lines(lines(spark, "junk")) == T.StructType()


def test_schemas_merge_inside_arrays_and_maps():
    old = S.T.StructType.fromDDL("xs ARRAY<STRUCT<b: INT>>, m MAP<STRING, STRUCT<u: INT>>")
    new = S.T.StructType.fromDDL("xs ARRAY<STRUCT<b: INT, c: STRING>>, m STRUCT<k: STRUCT<u: INT, v: INT>>")
    assert S.merge_schemas(old, new) == S.T.StructType.fromDDL("xs ARRAY<STRUCT<b: INT, c: STRING>>, m MAP<STRING, STRUCT<u: INT, v: INT>>")


def test_stream_widens_its_schema_and_restarts(spark):
    source, target, kept, checkpoint = folders(spark, "evolve", "in", "out", "schema", "checkpoint")
    start = lambda: evolve.start_json_stream(spark, source, target, kept, checkpoint, hints=HINTS)
    for text in (PLAIN, EXTRA, WRONG):
        lines(spark, text).write.mode("append").text(source)
        evolve.run_with_schema_evolution(start, kept)
    out = evolve.read_evolved(spark, target).collect()
    assert len(out) == 3
    assert sorted(str(r["harbour"]) for r in out) == ["Bergen", "None", "None"]
    assert sum(r["_incorrect_data"] is not None for r in out) == 1
    assert "harbour" in S.stored_schema(spark, kept).names


def test_other_stream_errors_are_not_swallowed(spark):
    source, checkpoint = folders(spark, "evolve", "in", "checkpoint")
    lines(spark, PLAIN).write.text(source)

    def fail(*_):
        raise ValueError("boom")

    def start():
        return sinks.sink_batches(spark.readStream.text(source), fail, checkpoint, available_now=True)

    with pytest.raises(Exception, match="boom"):
        evolve.run_with_schema_evolution(start, checkpoint + "-schema")


def test_copy_into_loads_each_file_once(spark):
    source, target, ledger = folders(spark, "copy", "in", "out", "ledger")
    load = lambda: files.copy_into(spark, source, "json", "id long", target, ledger)
    for i in range(2):
        spark.range(i * 10, i * 10 + 10).write.mode("append").json(source)
        load(), load()
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(20))


def test_tables_views_and_reset(spark):
    path, = folders(spark, "tables", "t")
    spark.range(3).write.parquet(path)
    tables.use_database(spark, "shop")
    assert tables.create_table(spark, "t", path).count() == 3
    assert tables.create_table_as(spark.range(2), "u").count() == 2
    assert tables.as_view(spark.range(4), "v").count() == 4
    tables.reset_tables(spark, ["t", "u"])
    assert not spark.catalog.tableExists("u")
    spark.sql("USE default")


def test_constraints(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (None, 1)], "id int, v int")
    good, bad = Q.quarantine(df, ["id"], {"positive": "v >= 0"})
    assert {r["id"] for r in good.collect()} == {1, 2}  # a NULL check passes
    assert sorted((r["_violations"] for r in bad.collect())) == [["id is null"], ["positive"]]
    assert Q.enforce(good, ["id"], {"positive": "v >= 0"}).count() == 2
    with pytest.raises(Exception, match="constraint violated: positive"):
        Q.enforce(df.filter("id = 3"), [], {"positive": "v >= 0"}).count()
    with pytest.raises(Exception, match="id is null"):
        Q.enforce(df, ["id"]).collect()


BERTH = T.StructType().add("quay", T.StringType()).add("tonnes", T.LongType()).add("id", T.LongType())


def test_append_refuses_types_and_columns(spark):
    make = lambda ddl, *row: spark.createDataFrame([row], ddl)
    with pytest.raises(ValueError, match="tonnes is string"):
        Q.check_append(BERTH, make("quay string, tonnes string, id bigint", "north", "80", 1))
    with pytest.raises(ValueError, match="flag"):
        Q.check_append(BERTH, make("quay string, tonnes bigint, id bigint, flag string", "north", 80, 1, "NO"))
    ok = Q.check_append(BERTH, make("id int, quay string, tonnes int", 1, "north", 5))
    assert [f.dataType for f in ok.schema] == [f.dataType for f in BERTH] and ok.columns == BERTH.names


def test_positional_insert_casts(spark):
    table = spark.createDataFrame([], "quay string, tonnes bigint, code string, id bigint")
    out = Q.insert_rows(table, [("south", 1200, 77, "31")]).collect()
    assert tuple(out[0]) == ("south", 1200, "77", 31)


def test_stop_all_and_checkpoint_root(spark):
    root, source, out = folders(spark, "root", "root", "in", "out")
    spark.range(1).write.parquet(source)
    sinks.set_checkpoint_root(spark, root)
    try:
        query = sinks.sink_append(spark.readStream.schema("id long").parquet(source), out, every="1 second")
        query.processAllAvailable()
        sinks.stop_all(spark)
        assert not spark.streams.active and spark.read.parquet(out).count() == 1
    finally:
        spark.conf.unset("spark.sql.streaming.checkpointLocation")
