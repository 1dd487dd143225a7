"""Ingestion: file and message input, schemas, constraints, layers, layout.

Messages are ``events`` rows packed as JSON. Readings of type ``error`` carry a value
that is no number, and readings of type ``signup`` a field that appears later.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators import layout, quality
from tidemark.operators.features import enrich
from tidemark.plans.common import folders, replay, stream_session, table
from tidemark.sources import files, schema as schemas, tables, variants
from tidemark.streaming import evolve, layers, sinks

READING = "event_id long, event_type string, value double, infos struct<k: int>"


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope rows: key, binary payload, sequence number."""
    kind = F.col("event_type")
    value = F.when(kind == "error", F.lit("bad")).otherwise(F.col("value").cast("string"))
    quoted = F.when(kind == "error", F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)
    later = F.when(kind == "signup", F.lit(', "new_column": "test"')).otherwise("")
    payload = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "event_type": "'), kind,
                       F.lit('", "value": '), quoted, F.lit(', "infos": '), "props", later, F.lit("}"))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("double").alias("key"), payload.cast("binary").alias("value"),
        F.col("event_id").cast("string").alias("sequence"), "event_type")


def decoded(spark, sf_dir):
    out = files.decode_envelope(_messages(spark, sf_dir), "value", "text", keep=["sequence"])
    data = F.from_json("text", "event_id long, event_type string").alias("data")
    return out.select("sequence", data).select("sequence", "data.*")


def parse_rescue(spark, sf_dir):
    text = files.decode_envelope(_messages(spark, sf_dir))
    out = schemas.parse_with_rescue(text, "value", READING)
    return out.select("event_id", "event_type", "value", F.col("infos.k").alias("k"), "_incorrect_data")


def parse_rescue_variant(spark, sf_dir):
    """The same rows from one parse of each message, with the schema that hints give."""
    text = files.decode_envelope(_messages(spark, sf_dir))
    out = variants.parse_with_rescue(text, "value", READING)
    return out.select("event_id", "event_type", "value", F.col("infos.k").alias("k"), "_incorrect_data")


def inferred_fields(spark, sf_dir):
    """The fields and types of all messages, found by one aggregate over every line."""
    schema = variants.schema_of_lines(files.decode_envelope(_messages(spark, sf_dir)))
    flat = [(f.name, f.dataType.simpleString()) for f in schema]
    rows = spark.createDataFrame(flat, "field string, type string")
    counts = variants.field_counts(files.decode_envelope(_messages(spark, sf_dir)))
    return rows.join(counts, "field")


def unknown_fields(spark, sf_dir):
    """How many messages carry each field the schema does not have."""
    text = files.decode_envelope(_messages(spark, sf_dir))
    names = schemas.unknown_fields(F.col("value"), T.StructType.fromDDL(READING))
    return text.select(F.explode(names).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def evolved_stream(spark, sf_dir):
    """The JSON stream meets a new field in its second delivery, stops, widens its schema, goes on."""
    own = stream_session(spark)
    source, target, schema_dir, checkpoint = folders(spark, "evolve", "in", "out", "schema", "checkpoint")
    messages = _messages(spark, sf_dir)
    for late in (False, True):
        part = messages.filter((F.col("event_type") == "signup") == late)
        part.select(F.col("value").cast("string")).write.mode("append").text(source)
        evolve.run_with_schema_evolution(lambda: evolve.start_json_stream(
            own, source, target, schema_dir, checkpoint,
            hints="event_id BIGINT, event_type STRING, value DOUBLE, infos STRUCT<k: INT>"), schema_dir)
    out = evolve.read_evolved(spark, target)
    return out.select("event_id", "value", F.col("infos.k").alias("k"), "new_column", "_incorrect_data")


def copy_into(spark, sf_dir):
    """Two deliveries and three loads: every file is loaded once."""
    own = stream_session(spark)
    source, target, ledger = folders(spark, "copy", "in", "out", "ledger")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    load = lambda: files.copy_into(own, source, "parquet", events.schema, target, ledger)
    replay([events.filter("event_type = 'click'"), events.filter("event_type != 'click'")], source, load)
    load()
    return spark.read.parquet(target)


def pending_rows(spark, sf_dir):
    """Two deliveries, of which the ledger lists the first: the rows still to load, without their file."""
    source, ledger = folders(spark, "pending", "in", "ledger")
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    events.filter("event_type = 'click'").write.mode("append").parquet(source)
    files.with_source_file(spark.read.parquet(source)).select("file_name").distinct().write.parquet(ledger)
    events.filter("event_type != 'click'").write.mode("append").parquet(source)
    return files.pending_rows(spark.read.parquet(source), spark.read.parquet(ledger)).drop("file_name")


def source_lineage(spark, sf_dir):
    named = files.with_source_file(table(spark, sf_dir, "events"))
    short = F.regexp_extract("file_name", "[^/]+$", 0)
    return named.groupBy(short.alias("file")).agg(F.count("*").alias("n"))


def append_evolved(spark, sf_dir):
    """Old rows without a priority, new rows with one."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    old = orders.filter("o_orderdate < '1998-01-01'").drop("o_orderpriority")
    return quality.append_merge_schema(old, orders.filter("o_orderdate >= '1998-01-01'"))


def append_checked(spark, sf_dir):
    """Columns in another order and a narrower integer are accepted."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_size").cast("long").alias("p_size"))
    more = table(spark, sf_dir, "part").select("p_size", "p_name", (-F.col("p_partkey") - 1).alias("p_partkey"))
    return parts.union(quality.check_append(parts.schema, more))


CHECKS = {"discount below 8 %": "l_discount < 0.08", "tax known if open": "l_linestatus = 'F' OR l_tax > 0"}


def file_formats(spark, sf_dir):
    """Customers written and read back as CSV, JSON, text and Parquet, typed alike."""
    ddl = "c_custkey long, c_name string, c_acctbal double"
    csv, json, text, parquet = folders(spark, "formats", "csv", "json", "text", "parquet")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat_ws(',"', "c_name", "c_mktsegment").alias("c_name"), "c_acctbal")
    rows.write.option("escape", '"').csv(csv)
    rows.write.json(json)
    rows.select(F.to_json(F.struct("*"))).write.text(text)
    files.write_parquet(rows, parquet)
    lines = files.read_text(spark, text).select(F.from_json("value", ddl).alias("r")).select("r.*")
    found = {"csv": files.read_csv(spark, csv, ddl, escape='"'), "json": files.read_json(spark, json, ddl), "text": lines,
             "parquet": files.read_parquet(spark, parquet)}
    return reduce(DataFrame.unionByName, [df.withColumn("format", F.lit(name)) for name, df in found.items()])


def positional_insert(spark, sf_dir):
    """Literal rows by position, cast to the table's types."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return quality.insert_rows(parts, [("-1", "rope", "12"), ("-2", "sail", "40")])


def named_tables(spark, sf_dir):
    """Files registered as a table of a database, a view on it, a table made from the view; the names are gone afterwards."""
    own = spark.newSession()
    place, path, result = folders(spark, "shop", "database", "orders", "result")
    files.write_parquet(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path)
    shop = f"shop_{path.split('-')[-1][:12].replace('/', '_')}"
    tables.use_database(own, shop, place)
    try:
        orders = tables.create_table(own, "orders_raw", path)
        tables.as_view(orders.filter("o_orderstatus != 'F'"), "open_orders")
        counts = own.sql("SELECT o_orderpriority, count(*) AS n FROM open_orders GROUP BY o_orderpriority")
        tables.create_table_as(counts, "per_priority").write.parquet(result)
        tables.reset_tables(own, ["orders_raw", "per_priority"])
        if own.catalog.listTables(shop) and any(not t.isTemporary for t in own.catalog.listTables(shop)):
            raise RuntimeError("tables are left after the reset")
    finally:
        own.sql(f"DROP DATABASE IF EXISTS `{shop}` CASCADE")
    return spark.read.parquet(result).withColumn("raw_rows", F.lit(spark.read.parquet(path).count()))


def quarantine(spark, sf_dir):
    """Rows per broken constraint, and the clean ones."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_discount", "l_tax", "l_linestatus")
    good, bad = quality.quarantine(lines, ["l_orderkey"], CHECKS)
    broken = bad.select(F.explode("_violations").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))
    return broken.unionByName(good.agg(F.count("*").alias("n")).select(F.lit("clean").alias("rule"), "n"))


def enforced(spark, sf_dir):
    """A table that keeps its constraints passes unchanged."""
    return quality.enforce(table(spark, sf_dir, "part").select("p_partkey", "p_size"), ["p_partkey"],
                           {"size is positive": "p_size >= 0"})


def _readings(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("id"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("speed"))


def _labels(spark, sf_dir):
    return table(spark, sf_dir, "part").filter("p_size < 40").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("status"))


def enrich_left(spark, sf_dir):
    return enrich(_readings(spark, sf_dir), _labels(spark, sf_dir), ["id"])


def enrich_salted(spark, sf_dir):
    return enrich(_readings(spark, sf_dir), _labels(spark, sf_dir), ["id"], salts=4)


def layered_stream(spark, sf_dir):
    """Raw → typed → enriched, two deliveries of several files, two thirds of them a micro-batch, every layer its own query."""
    own = stream_session(spark)
    names = ["in", "raw", "typed", "enriched", "c1", "c2", "c3"]
    source, raw, typed, enriched, c1, c2, c3 = folders(spark, "layers", *names)
    readings = _readings(spark, sf_dir)
    messages = readings.select(F.col("id").cast("double").alias("key"),
                               F.to_json(F.struct(*readings.columns)).cast("binary").alias("value"))
    labels = _labels(own, sf_dir)
    n_files = max(3, messages.rdd.getNumPartitions())  # as many as the input has splits: a file is written by one task

    def run() -> None:
        stream = files.stream_files(own, source, "parquet", "key double, value binary", max_files=2 * n_files // 3)
        layers.raw_layer(stream, "value", ["key"], raw, c1, available_now=True).awaitTermination()
        layers.typed_layer(own, raw, "key double, value string", readings.schema, typed, c2, ["id"],
                           {"id is not negative": "id >= 0"}, available_now=True).awaitTermination()
        layers.enriched_layer(own, typed, readings.schema, labels, ["id"], enriched, c3, salts=4,
                              available_now=True).awaitTermination()

    replay([messages.filter("key < 500").repartition(n_files), messages.filter("key >= 500").repartition(n_files)], source, run)
    return spark.read.parquet(enriched)


def table_stream(spark, sf_dir):
    """Stream into a named table and read it by name."""
    own = stream_session(spark)
    path, checkpoint = folders(spark, "named", "table", "checkpoint")
    name = "tidemark_" + checkpoint.split("/")[-2].replace("-", "_")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    parts.limit(0).write.parquet(path)
    tables.create_table(own, name, path)
    stream = files.stream_files(own, f"{sf_dir}/part.parquet*", "parquet", parts.schema, max_files=None)
    sinks.sink_table(stream, name, checkpoint, available_now=True).awaitTermination()
    return own.table(name)


def publish_latest(spark, sf_dir):
    """The rows an online store receives: each user's newest event."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return tables.online_rows(events, ["user_id"], [F.desc("ts"), F.desc("event_id")])


def table_detail(spark, sf_dir):
    out = layout.table_detail(table(spark, sf_dir, "orders"))
    return out.select("n_files", "n_rows", (F.col("n_bytes") > 0).alias("has_bytes"))


def compact(spark, sf_dir):
    """Many small files rewritten as few."""
    small, large = folders(spark, "compact", "small", "large")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    orders.repartition(64).write.parquet(small)
    layout.write_compacted(spark.read.parquet(small), large)
    return spark.read.parquet(large)


def compact_files(spark, sf_dir):
    """Files and rows before and after compaction."""
    small, large = folders(spark, "compact", "small", "large")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus").repartition(64).write.parquet(small)
    layout.write_compacted(spark.read.parquet(small), large)
    before, after = (layout.table_detail(spark.read.parquet(p)) for p in (small, large))
    return before.select(F.col("n_files").alias("before"), F.col("n_rows").alias("rows_before")).crossJoin(
        after.select((F.col("n_files") < 16).alias("is_few"), F.col("n_rows").alias("rows_after")))


def zorder_spread(spark, sf_dir):
    """Rows of sixteen clustered files, and whether a file spans less than two thirds of either column on average.

    A file of rows in no order spans nearly all of both.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.datediff("o_orderdate", F.lit("1992-01-01")).alias("day"), "o_totalprice")
    path, = folders(spark, "zorder", "out")
    layout.zorder(orders, ["day", "o_totalprice"], files=16).write.parquet(path)
    files_ = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(
        F.count("*").alias("n"), *[(F.max(c) - F.min(c)).alias(c) for c in ("day", "o_totalprice")])
    whole = orders.agg(*[(F.max(c) - F.min(c)).alias(f"all_{c}") for c in ("day", "o_totalprice")])
    return files_.crossJoin(whole).agg(F.sum("n").alias("n"), *[(F.avg(F.col(c) / F.col(f"all_{c}")) < 2 / 3).alias(f"{name}_is_narrow")
                                                                for c, name in (("day", "day"), ("o_totalprice", "price"))])


def zorder(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    return layout.zorder(orders, ["o_orderpriority", "o_orderdate"])


QUERIES = {f.__name__: f for f in (
    decoded, parse_rescue, parse_rescue_variant, inferred_fields, unknown_fields, evolved_stream, copy_into, pending_rows, source_lineage, append_evolved,
    append_checked, file_formats, positional_insert, named_tables, quarantine, enforced, enrich_left, enrich_salted, layered_stream, table_stream, publish_latest,
    table_detail, compact, compact_files, zorder, zorder_spread)}

_RESCUED = """CASE WHEN event_type = 'error' THEN '{"value":"bad"}' END AS _incorrect_data"""
_K = "CAST(json_extract(props, '$.k') AS INTEGER) AS k"
_VALUE = "CASE WHEN event_type <> 'error' THEN value END AS value"
_ENRICHED = """SELECT l_partkey AS id, l_orderkey, l_linenumber, l_quantity AS speed, p_brand AS status
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON l_partkey = p_partkey"""

ORACLE = {
    "decoded": "SELECT CAST(event_id AS VARCHAR) AS sequence, event_id, event_type FROM events",
    "parse_rescue_variant": f"SELECT event_id, event_type, {_VALUE}, {_K}, {_RESCUED} FROM events",
    "parse_rescue": f"SELECT event_id, event_type, {_VALUE}, {_K}, {_RESCUED} FROM events",
    "inferred_fields": """SELECT unnest(['event_id', 'event_type', 'value', 'infos']) AS field,
            unnest(['bigint', 'string', 'string', 'struct<k:bigint>']) AS type, count(*) AS n FROM events
        UNION ALL SELECT 'new_column', 'string', count(*) FROM events WHERE event_type = 'signup'""",
    "unknown_fields": "SELECT 'new_column' AS field, count(*) AS n FROM events WHERE event_type = 'signup'",
    "evolved_stream": f"""SELECT event_id, {_VALUE}, {_K},
        CASE WHEN event_type = 'signup' THEN 'test' END AS new_column, {_RESCUED} FROM events""",
    "copy_into": "SELECT event_id, event_type, value FROM events",
    "pending_rows": "SELECT event_id, event_type FROM events WHERE event_type <> 'click'",
    "source_lineage": "SELECT 'events.parquet' AS file, count(*) AS n FROM events",
    "append_evolved": """SELECT o_orderkey, o_orderdate,
        CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "append_checked": """SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size FROM part
        UNION ALL SELECT -p_partkey - 1, p_name, CAST(p_size AS BIGINT) FROM part""",
    "quarantine": """
        WITH t AS (SELECT l_discount >= 0.08 AS a, l_linestatus <> 'F' AND l_tax <= 0 AS b FROM lineitem)
        SELECT 'discount below 8 %' AS rule, count(*) AS n FROM t WHERE a
        UNION ALL SELECT 'tax known if open', count(*) FROM t WHERE b
        UNION ALL SELECT 'clean', count(*) FROM t WHERE NOT a AND NOT b""",
    "enforced": "SELECT p_partkey, p_size FROM part",
    "enrich_left": _ENRICHED,
    "enrich_salted": _ENRICHED,
    "layered_stream": _ENRICHED,
    "table_stream": "SELECT p_partkey, p_brand FROM part",
    "publish_latest": """SELECT user_id, ts, event_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "table_detail": "SELECT CAST(1 AS BIGINT) AS n_files, count(*) AS n_rows, TRUE AS has_bytes FROM orders",
    "compact": "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders",
    "file_formats": """SELECT c_custkey, c_name || ',"' || c_mktsegment AS c_name, c_acctbal, unnest(['csv', 'json', 'text', 'parquet']) AS format
        FROM customer""",
    "positional_insert": """SELECT p_partkey, p_name, p_size FROM part
        UNION ALL SELECT * FROM (VALUES (-1, 'rope', 12), (-2, 'sail', 40))""",
    "named_tables": """SELECT o_orderpriority, count(*) AS n, (SELECT CAST(count(*) AS INTEGER) FROM orders) AS raw_rows
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1""",
    "compact_files": "SELECT 64::BIGINT AS before, count(*) AS rows_before, TRUE AS is_few, count(*) AS rows_after FROM orders",
    "zorder_spread": "SELECT count(*) AS n, TRUE AS day_is_narrow, TRUE AS price_is_narrow FROM orders",
    "zorder": "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders",
}
