"""Change data capture, DML and versions.

The client table is ``customer``; every order is one operation on its customer: status
``F`` deletes, ``P`` inserts, ``O`` updates. Operations arrive in three waves by date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import changes as C
from tidemark.operators.latest import latest_per_key
from tidemark.plans.common import folders, stream_session, table
from tidemark.session import materialize
from tidemark.sources.files import stream_table
from tidemark.streaming import cdc as stream_cdc

COLUMNS = ["id", "name", "address", "email", "operation_date"]
WAVES = ["1997-01-01", "1999-06-01"]


def _newest() -> list[Column]:
    """Newest operation first; the order key breaks ties."""
    return [F.desc("operation_date"), F.desc("seq")]


def _clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as first loaded: customers that are not in debt."""
    return table(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit('"'), "c_mktsegment", F.lit('" '), "c_nationkey").alias("address"),
        F.concat(F.lit("c"), "c_custkey", F.lit("@example.com")).alias("email"),
        F.lit("1990-01-01").cast("timestamp_ntz").alias("operation_date"))


def _ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operations; a delete carries only its key."""
    kind = F.col("o_orderstatus")
    op = F.when(kind == "F", "DELETE").when(kind == "P", "INSERT").otherwise("UPDATE")
    unless_delete = lambda value: F.when(kind != "F", value)
    date = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        unless_delete(F.concat(F.lit("Customer of order "), "o_orderkey")).alias("name"),
        unless_delete(F.concat(F.lit('"'), "o_orderpriority", F.lit('" '), "o_orderkey")).alias("address"),
        unless_delete(F.concat(F.lit("o"), "o_orderkey", F.lit("@example.com"))).alias("email"),
        op.alias("operation"), date.alias("operation_date"), F.col("o_orderkey").alias("seq"),
        F.when(date < WAVES[0], 1).when(date < WAVES[1], 2).otherwise(3).alias("wave"))


def commit_time(version: int) -> Column:
    """Version ``n`` is committed ``n`` days into 2002."""
    return F.lit(f"2002-01-{version + 1:02d}").cast("timestamp")


def _write_log(spark: SparkSession, sf_dir: str) -> str:
    """The client table's change log, in key buckets: the load and one merge per wave."""
    path, = folders(spark, "clients", "log")
    clients, ops = _clients(spark, sf_dir), _ops(spark, sf_dir)
    C.write_version(clients.withColumn("_change_type", F.lit("insert")), path, 0, commit_time(0), "id")
    for wave in (1, 2, 3):
        now = C.as_of(C.read_log(spark, path, clients.schema), ["id"], wave - 1)
        changes = C.apply_cdc(now, ops.filter(F.col("wave") == wave), "id", _newest()).changes
        C.write_version(changes, path, wave, commit_time(wave), "id")
    return path


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.read_log(spark, _write_log(spark, sf_dir), _clients(spark, sf_dir).schema)


def cdc_latest(spark, sf_dir):
    return latest_per_key(_ops(spark, sf_dir), ["id"], _newest()).select("id", "operation", "operation_date", "seq")


def cdc_apply(spark, sf_dir):
    return C.apply_cdc(_clients(spark, sf_dir), _ops(spark, sf_dir), "id", _newest(), stage=True).rows


def cdc_apply_guarded(spark, sf_dir):
    """A target row newer than the operation stays: customers of the AUTOMOBILE segment were edited in 2100."""
    clients = _clients(spark, sf_dir)
    edited = C.update_where(clients, F.col("address").startswith('"AUTOMOBILE"'),
                            {"operation_date": F.lit("2100-01-01")}).rows
    return C.apply_cdc(edited, _ops(spark, sf_dir), "id", _newest(), not_older="operation_date", stage=True).rows


def cdc_apply_stream(spark, sf_dir):
    """Each wave arrives in two deliveries by date; a delivery is a micro-batch, every run goes on where the last stopped."""
    own = stream_session(spark)
    source, log, checkpoint = folders(spark, "cdc", "in", "log", "checkpoint")
    clients = _clients(spark, sf_dir)
    C.write_version(clients.withColumn("_change_type", F.lit("insert")), log, 0, commit_time(0), "id")
    ops = _ops(spark, sf_dir)
    schema = "id long, name string, address string, email string, operation string, " \
             "operation_date timestamp_ntz, seq long"
    for wave in (1, 2, 3):
        part = ops.filter(F.col("wave") == wave).drop("wave")
        middle = part.agg(F.expr("timestampadd(SECOND, timestampdiff(SECOND, min(operation_date), max(operation_date)) div 2, min(operation_date))").alias("m")).scalar()
        for late in (False, True):
            part.filter((F.col("operation_date") >= middle) == late).write.mode("append").parquet(source)
            stream_cdc.cdc_stream(stream_table(own, source, schema), log, "id", _newest(), COLUMNS, checkpoint,
                                  first_version=1, available_now=True).awaitTermination()
    return C.as_of(C.read_log(spark, log, clients.schema), ["id"])


def merge_clauses(spark, sf_dir, one_pass=False):
    """Orders merged with the totals of their line items; all clause kinds, conditions in order."""
    orders = table(spark, sf_dir, "orders").filter("o_orderpriority != '5-LOW'").select(
        "o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("quantity"), F.max("l_linestatus").alias("status"))
    lines = materialize(lines, "lines")  # the merge reads it three times
    quantity, status = F.col("source.quantity"), F.col("source.status")
    return C.merge(orders, lines, ["o_orderkey"], [
        C.Delete((F.col("target.o_orderstatus") == "F") & (quantity > 100)),
        C.Update({"o_orderstatus": status}, quantity > 60),
        C.Update({"o_totalprice": quantity}, F.col("target.o_orderstatus") == "P"),
        C.Insert({"o_orderkey": F.col("source.o_orderkey"), "o_orderstatus": status, "o_totalprice": quantity},
                 quantity >= 50)], unique_source=True, one_pass=one_pass).rows


def merge_one_pass(spark, sf_dir):
    """The same merge with either side shuffled once."""
    return merge_clauses(spark, sf_dir, one_pass=True)


def delete_where(spark, sf_dir):
    """The balance is NULL for one segment: a NULL predicate keeps the row."""
    return C.delete_where(_accounts(spark, sf_dir), F.col("balance") < 0).rows


def update_where(spark, sf_dir):
    return C.update_where(_accounts(spark, sf_dir), F.col("balance") < 0,
                          {"segment": F.lit("IN DEBT"), "balance": -F.col("balance")}).rows


def update_changes(spark, sf_dir):
    return C.update_where(_accounts(spark, sf_dir), F.col("balance") < 0, {"segment": F.lit("IN DEBT")}).changes


def _accounts(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("balance"))


def delete_in(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    debtors = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select("c_custkey")
    return C.delete_in(orders, "o_custkey", debtors).rows


def forget_user(spark, sf_dir):
    """The most active user leaves both layers: every row of either, left or deleted."""
    events = table(spark, sf_dir, "events")
    user = events.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").select("user_id").limit(1).scalar()
    raw = events.select(F.col("event_id").cast("string").alias("sequence"),
                        F.to_json(F.struct("user_id", "event_type")).cast("binary").alias("data"))
    payload = F.from_json(F.col("data").cast("string"), "user_id long, event_type string")
    in_raw, in_typed = C.forget(raw, events, "user_id", user, "sequence", payload["user_id"])
    part = lambda df, layer, what, key: df.select(
        F.lit(layer).alias("layer"), F.lit(what).alias("what"), F.col(key).cast("string").alias("event"))
    return (part(in_raw.rows, "raw", "left", "sequence").union(part(in_raw.changes, "raw", "deleted", "sequence"))
            .union(part(in_typed.rows, "typed", "left", "event_id")).union(part(in_typed.changes, "typed", "deleted", "event_id")))


def change_log(spark, sf_dir):
    return _log(spark, sf_dir).drop("_commit_timestamp")


def change_feed(spark, sf_dir):
    """Changes between the loaded table and the table after all operations."""
    before = _clients(spark, sf_dir)
    after = C.apply_cdc(before, _ops(spark, sf_dir), "id", _newest(), stage=True).rows
    return C.diff_changes(before, after, ["id"])


def change_feed_range(spark, sf_dir):
    return C.table_changes(_log(spark, sf_dir), 1, 2).drop("_commit_timestamp")


def change_feed_time(spark, sf_dir):
    return C.table_changes_between(_log(spark, sf_dir), commit_time(2), commit_time(3)).drop("_commit_timestamp")


def as_of_version(spark, sf_dir):
    return C.as_of(_log(spark, sf_dir), ["id"], 2)


def as_of_time(spark, sf_dir):
    noon = F.lit("2002-01-02 12:00:00").cast("timestamp")
    return C.as_of_time(_log(spark, sf_dir), ["id"], noon)


def as_of_now(spark, sf_dir):
    return C.as_of(_log(spark, sf_dir), ["id"])


def restore(spark, sf_dir):
    return C.restore(_log(spark, sf_dir), ["id"], 1)


def history(spark, sf_dir):
    return C.history(_log(spark, sf_dir)).drop("_commit_timestamp")


def commit_history(spark, sf_dir):
    """Commits of six kinds with their recorded operations: among them a merge that only inserts, and one that changes nothing."""
    path, = folders(spark, "commits", "log")
    clients, ops = _clients(spark, sf_dir), _ops(spark, sf_dir)
    now = lambda: C.as_of(C.read_log(spark, path, clients.schema), ["id"])
    commit = lambda changes, version, operation, source=None: C.write_version(
        changes, path, version, commit_time(version), "id", operation=operation, source=source)
    commit(clients.withColumn("_change_type", F.lit("insert")), 0, "WRITE", "customer")
    commit(C.apply_cdc(now(), ops.filter("wave = 1"), "id", _newest(), stage=True).changes, 1, "MERGE", "wave 1")
    everyone = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    commit(C.merge(now(), everyone, ["id"], [C.Insert({"id": F.col("source.id"), "name": F.col("source.name")})]).changes, 2, "MERGE", "customer")
    commit(C.merge(now(), everyone, ["id"], [C.Insert({"id": F.col("source.id"), "name": F.col("source.name")})]).changes, 3, "MERGE", "customer")
    commit(C.update_where(now(), F.col("email").isNull(), {"email": F.lit("unknown")}).changes, 4, "UPDATE")
    commit(C.delete_where(now(), F.col("email") == "unknown").changes, 5, "DELETE")
    return C.commit_history(spark, path).withColumn("at", F.col("at").cast("timestamp_ntz"))


def clone_version(spark, sf_dir):
    """The table at version 2, written as a table of its own."""
    path, = folders(spark, "clone", "clients")
    C.clone(_log(spark, sf_dir), ["id"], 2, path)
    return spark.read.parquet(path)


def log_of_table(spark, sf_dir):
    """An existing table turned into a log, with the first wave as its next version: the table at both versions."""
    clients = _clients(spark, sf_dir)
    wave = C.apply_cdc(clients, _ops(spark, sf_dir).filter("wave = 1"), "id", _newest(), stage=True).changes
    log = materialize(C.init_change_log(clients, commit_time(0)).unionByName(C.stamp(wave, 1, commit_time(1))), "log")
    at = lambda n: C.as_of(log, ["id"], n).withColumn("version", F.lit(n))
    return at(0).unionByName(at(1))


def latest_version(spark, sf_dir):
    return _log(spark, sf_dir).agg(F.max("_commit_version").alias("version"))


def expire(spark, sf_dir):
    return C.expire(_log(spark, sf_dir), ["id"], 2).withColumn(
        "_commit_timestamp", F.col("_commit_timestamp").cast("timestamp_ntz"))


def propagate_gold(spark, sf_dir):
    log = _log(spark, sf_dir)
    return C.propagate(C.as_of(log, ["id"], 0), C.table_changes(log, 1), "id", ["address"], stage=True).rows


def propagate_stream(spark, sf_dir):
    """The downstream table follows the log as a stream, a file per micro-batch, and starts empty."""
    own = stream_session(spark)
    path, clients = _write_log(spark, sf_dir), _clients(spark, sf_dir)
    schema = C.read_log(spark, path, clients.schema).schema
    gold, checkpoint = folders(spark, "gold", "log", "checkpoint")
    stream_cdc.propagate_stream(stream_table(own, path, schema), gold, "id", COLUMNS, checkpoint, ["address"],
                                available_now=True).awaitTermination()
    return C.as_of(C.read_log(spark, gold, clients.schema), ["id"])


def propagate_from_version(spark, sf_dir):
    """The downstream table starts as the load and follows the log from version 2 on."""
    own = stream_session(spark)
    path, clients = _write_log(spark, sf_dir), _clients(spark, sf_dir)
    schema = C.read_log(spark, path, clients.schema).schema
    gold, checkpoint = folders(spark, "gold", "log", "checkpoint")
    C.write_version(clients.withColumn("_change_type", F.lit("insert")), gold, 0, commit_time(0), "id")
    stream_cdc.propagate_stream(stream_table(own, path, schema), gold, "id", COLUMNS, checkpoint, ["address"],
                                available_now=True, from_version=2, first_version=1).awaitTermination()
    return C.as_of(C.read_log(spark, gold, clients.schema), ["id"])


QUERIES = {f.__name__: f for f in (
    cdc_latest, cdc_apply, cdc_apply_guarded, cdc_apply_stream, merge_clauses, merge_one_pass, delete_where, update_where,
    update_changes, delete_in, forget_user, change_log, change_feed, change_feed_range, change_feed_time,
    as_of_version, as_of_time, as_of_now, restore, history, commit_history, clone_version, log_of_table, latest_version, expire, propagate_gold,
    propagate_stream, propagate_from_version)}

_BASE = """
WITH clients AS (
  SELECT c_custkey AS id, c_name AS name, '"' || c_mktsegment || '" ' || c_nationkey AS address,
         'c' || c_custkey || '@example.com' AS email, TIMESTAMP '1990-01-01' AS operation_date
  FROM customer WHERE c_acctbal >= 0),
ops AS (
  SELECT o_custkey AS id,
         CASE WHEN o_orderstatus <> 'F' THEN 'Customer of order ' || o_orderkey END AS name,
         CASE WHEN o_orderstatus <> 'F' THEN '"' || o_orderpriority || '" ' || o_orderkey END AS address,
         CASE WHEN o_orderstatus <> 'F' THEN 'o' || o_orderkey || '@example.com' END AS email,
         CASE o_orderstatus WHEN 'F' THEN 'DELETE' WHEN 'P' THEN 'INSERT' ELSE 'UPDATE' END AS operation,
         o_orderdate AS operation_date, o_orderkey AS seq,
         CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 1 WHEN o_orderdate < TIMESTAMP '1999-06-01' THEN 2
              ELSE 3 END AS v
  FROM orders),
newest AS (
  SELECT * FROM ops QUALIFY row_number() OVER (PARTITION BY id ORDER BY operation_date DESC, seq DESC) = 1)"""
_APPLIED = _BASE + """,
applied AS (
  SELECT id, name, address, email, operation_date FROM newest WHERE operation <> 'DELETE'
  UNION ALL
  SELECT * FROM clients WHERE id NOT IN (SELECT id FROM newest))"""
_LOG_SQL = _BASE + """,
steps AS MATERIALIZED (
  SELECT *, 'INSERT' AS operation, 0 AS v FROM clients
  UNION ALL
  SELECT id, name, address, email, operation_date, operation, v FROM ops
  QUALIFY row_number() OVER (PARTITION BY id, v ORDER BY operation_date DESC, seq DESC) = 1),
moves AS MATERIALIZED (
  SELECT *, lag(operation) OVER w AS op0, lag(name) OVER w AS name0, lag(address) OVER w AS address0,
         lag(email) OVER w AS email0, lag(operation_date) OVER w AS date0
  FROM steps WINDOW w AS (PARTITION BY id ORDER BY v)),
log AS MATERIALIZED (
  SELECT id, name, address, email, operation_date, 'insert' AS _change_type, v FROM moves
  WHERE operation <> 'DELETE' AND coalesce(op0, 'DELETE') = 'DELETE'
  UNION ALL
  SELECT id, name, address, email, operation_date, 'update_postimage', v FROM moves
  WHERE operation <> 'DELETE' AND op0 <> 'DELETE'
  UNION ALL
  SELECT id, name0, address0, email0, date0, 'update_preimage', v FROM moves
  WHERE operation <> 'DELETE' AND op0 <> 'DELETE'
  UNION ALL
  SELECT id, name0, address0, email0, date0, 'delete', v FROM moves
  WHERE operation = 'DELETE' AND op0 <> 'DELETE')"""
_FIELDS = "id, name, address, email, operation_date"
_ACCOUNTS = """WITH accounts AS (SELECT c_custkey AS id, c_mktsegment AS segment,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS balance FROM customer) """


def _as_of(version: int) -> str:
    return f"""SELECT {_FIELDS} FROM (SELECT * FROM log WHERE v <= {version} AND _change_type <> 'update_preimage'
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC) = 1) WHERE _change_type <> 'delete'"""


def _diff(old: str, new: str) -> str:
    changed = "(o.name, o.address, o.email, o.operation_date) IS DISTINCT FROM (n.name, n.address, n.email, n.operation_date)"
    o, n = ", ".join("o." + c for c in COLUMNS), ", ".join("n." + c for c in COLUMNS)
    return f"""
        SELECT {n}, 'insert' AS _change_type FROM {new} n WHERE n.id NOT IN (SELECT id FROM {old})
        UNION ALL SELECT {o}, 'delete' FROM {old} o WHERE o.id NOT IN (SELECT id FROM {new})
        UNION ALL SELECT {o}, 'update_preimage' FROM {old} o JOIN {new} n USING (id) WHERE {changed}
        UNION ALL SELECT {n}, 'update_postimage' FROM {old} o JOIN {new} n USING (id) WHERE {changed}"""


def _feed(where: str) -> str:
    return _LOG_SQL + f"SELECT {_FIELDS}, _change_type, CAST(v AS BIGINT) AS _commit_version FROM log WHERE {where}"


ORACLE = {
    "cdc_latest": _BASE + "SELECT id, operation, operation_date, seq FROM newest",
    "cdc_apply": _APPLIED + "SELECT * FROM applied",
    "cdc_apply_guarded": _BASE + """,
        edited AS (SELECT id, name, address, email, CASE WHEN address LIKE '"AUTOMOBILE"%' THEN TIMESTAMP '2100-01-01'
                          ELSE operation_date END AS operation_date FROM clients),
        kept AS (SELECT * FROM edited WHERE id NOT IN (SELECT id FROM newest) OR operation_date = TIMESTAMP '2100-01-01')
        SELECT * FROM kept UNION ALL
        SELECT id, name, address, email, operation_date FROM newest
        WHERE operation <> 'DELETE' AND id NOT IN (SELECT id FROM kept)""",
    "cdc_apply_stream": _LOG_SQL + _as_of(3),
    "merge_clauses": """
        WITH t AS (SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders
                   WHERE o_orderpriority <> '5-LOW'),
        s AS (SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS quantity, max(l_linestatus) AS status
              FROM lineitem GROUP BY 1)
        SELECT t.o_orderkey,
               CASE WHEN quantity > 60 THEN status ELSE o_orderstatus END AS o_orderstatus,
               CASE WHEN quantity <= 60 AND o_orderstatus = 'P' THEN quantity ELSE o_totalprice END AS o_totalprice
        FROM t LEFT JOIN s ON t.o_orderkey = s.o_orderkey
        WHERE NOT coalesce(o_orderstatus = 'F' AND quantity > 100, FALSE)
        UNION ALL
        SELECT o_orderkey, status, quantity FROM s
        WHERE quantity >= 50 AND o_orderkey NOT IN (SELECT o_orderkey FROM t)""",
    "delete_where": _ACCOUNTS + "SELECT * FROM accounts WHERE balance >= 0 OR balance IS NULL",
    "update_where": _ACCOUNTS + """SELECT id, CASE WHEN balance < 0 THEN 'IN DEBT' ELSE segment END AS segment,
        abs(balance) AS balance FROM accounts""",
    "update_changes": _ACCOUNTS + """
        SELECT id, segment, balance, 'update_preimage' AS _change_type FROM accounts WHERE balance < 0
        UNION ALL SELECT id, 'IN DEBT', balance, 'update_postimage' FROM accounts WHERE balance < 0""",
    "delete_in": """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "forget_user": """
        WITH u AS (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1),
        layers AS (SELECT unnest(['raw', 'typed']) AS layer)
        SELECT layer, CASE WHEN e.user_id = u.user_id THEN 'deleted' ELSE 'left' END AS what, CAST(event_id AS VARCHAR) AS event
        FROM layers, events e, u""",
    "change_log": _feed("TRUE"),
    "change_feed": _APPLIED + _diff("clients", "applied"),
    "change_feed_range": _feed("v BETWEEN 1 AND 2"),
    "change_feed_time": _feed("v BETWEEN 2 AND 3"),
    "as_of_version": _LOG_SQL + _as_of(2),
    "as_of_time": _LOG_SQL + _as_of(1),
    "as_of_now": _LOG_SQL + _as_of(3),
    "restore": _LOG_SQL + f", cur AS ({_as_of(3)}), old AS ({_as_of(1)})" + _diff("cur", "old"),
    "history": _LOG_SQL + """SELECT CAST(v AS BIGINT) AS _commit_version,
        count(*) FILTER (WHERE _change_type = 'insert') AS inserted,
        count(*) FILTER (WHERE _change_type = 'update_postimage') AS updated,
        count(*) FILTER (WHERE _change_type = 'delete') AS deleted,
        CASE WHEN bool_and(_change_type = 'insert') THEN 'WRITE' WHEN bool_and(_change_type LIKE 'update%') THEN 'UPDATE'
             WHEN bool_and(_change_type = 'delete') THEN 'DELETE' ELSE 'MERGE' END AS operation FROM log GROUP BY 1""",
    "commit_history": _LOG_SQL + f""",
        one AS ({_as_of(1)}),
        added AS (SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT id FROM one)),
        first AS (SELECT count(*) FILTER (WHERE v = 0) AS loaded,
                         count(*) FILTER (WHERE v = 1 AND _change_type = 'insert') AS inserted,
                         count(*) FILTER (WHERE v = 1 AND _change_type = 'update_postimage') AS updated,
                         count(*) FILTER (WHERE v = 1 AND _change_type = 'delete') AS deleted FROM log)
        SELECT CAST(v AS BIGINT) AS version, TIMESTAMP '2002-01-01' + INTERVAL 1 DAY * v AS at,
               ['WRITE', 'MERGE', 'MERGE', 'MERGE', 'UPDATE', 'DELETE'][v + 1] AS operation,
               [loaded, first.inserted, n, 0, 0, 0][v + 1] AS inserted, [0, first.updated, 0, 0, n, 0][v + 1] AS updated,
               [0, first.deleted, 0, 0, 0, n][v + 1] AS deleted,
               ['customer', 'wave 1', 'customer', 'customer', NULL, NULL][v + 1] AS source
        FROM first, added, range(0, 6) r(v)""",
    "clone_version": _LOG_SQL + _as_of(2),
    "log_of_table": _LOG_SQL + f"SELECT *, 0 AS version FROM ({_as_of(0)}) UNION ALL SELECT *, 1 FROM ({_as_of(1)})",
    "latest_version": _LOG_SQL + "SELECT CAST(max(v) AS BIGINT) AS version FROM log",
    "expire": _LOG_SQL + f""", base AS ({_as_of(2)})
        SELECT *, 'insert' AS _change_type, CAST(2 AS BIGINT) AS _commit_version,
               TIMESTAMP '2002-01-03' AS _commit_timestamp FROM base
        UNION ALL SELECT {_FIELDS}, _change_type, CAST(3 AS BIGINT), TIMESTAMP '2002-01-04' FROM log WHERE v = 3""",
    "propagate_gold": _LOG_SQL + f""", cur AS ({_as_of(3)})
        SELECT id, name, CASE WHEN id IN (SELECT id FROM log WHERE v > 0) THEN replace(address, '"', '')
                              ELSE address END AS address, email, operation_date FROM cur""",
    "propagate_stream": _LOG_SQL + f""", cur AS ({_as_of(3)})
        SELECT id, name, replace(address, '"', '') AS address, email, operation_date FROM cur""",
    "propagate_from_version": _LOG_SQL + f"""
        SELECT id, name, CASE WHEN v > 1 THEN replace(address, '"', '') ELSE address END AS address, email, operation_date
        FROM (SELECT * FROM log WHERE v <> 1 AND _change_type <> 'update_preimage'
              QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC) = 1) WHERE _change_type <> 'delete'""",
}
ORACLE["merge_one_pass"] = ORACLE["merge_clauses"]
