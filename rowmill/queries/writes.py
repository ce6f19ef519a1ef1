"""New versions of a table, and tables written and read back."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rowmill.operators.compliance import ColumnRule
from rowmill.queries import query
from rowmill.queries.fixtures import (
    CUSTOMER_CHANGES, RAW_PEOPLE, customer_changes, raw_people, table)
from rowmill.session import scratch_path
from rowmill.sinks import tables as W
from rowmill.sinks.refusing import FileSink, write_to_sink
from rowmill.sinks.snapshots import as_of, create_snapshot_table, roll_back
from rowmill.streaming.incremental import load_new

KEY = ["c_custkey"]
# The latest of the changes to each key, and the earliest.
_LATEST = f"""WITH {CUSTOMER_CHANGES}, latest AS (
    SELECT c_custkey, seq, c_name, c_acctbal FROM (SELECT *, row_number() OVER (
        PARTITION BY c_custkey ORDER BY seq DESC) AS rn FROM customer_changes) WHERE rn = 1),
    earliest AS (
    SELECT c_custkey, seq, c_name, c_acctbal FROM (SELECT *, row_number() OVER (
        PARTITION BY c_custkey ORDER BY seq) AS rn FROM customer_changes) WHERE rn = 1)"""
_UPDATED = _LATEST + """SELECT c.c_custkey,
        CASE WHEN l.seq IS NOT NULL THEN l.c_name ELSE c.c_name END AS c_name, c.c_nationkey,
        CASE WHEN l.seq IS NOT NULL THEN l.c_acctbal ELSE c.c_acctbal END AS c_acctbal, c.c_mktsegment
    FROM customer c LEFT JOIN latest l ON c.c_custkey = l.c_custkey"""
_UPSERTED = _LATEST + """SELECT * FROM customer c WHERE NOT EXISTS (
        SELECT 1 FROM latest l WHERE l.c_custkey = c.c_custkey)
    UNION ALL SELECT c_custkey, c_name, NULL, c_acctbal, NULL FROM latest"""


def stored(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as a table of its own name in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    path = scratch_path(df.sparkSession, label)
    df.write.option("path", path).partitionBy(*partition_by).saveAsTable(name)
    return name


@query("update", _UPDATED)
def _update(spark, d):
    return W.updated(table(spark, d, "customer"), customer_changes(spark, d), KEY, ["seq"])


@query("update_hot", _UPDATED)
def _update_hot(spark, d):
    return W.updated(table(spark, d, "customer"), customer_changes(spark, d), KEY, ["seq"],
                     share=0.0, rows=1)


@query("update_masked", _LATEST + """SELECT c.* REPLACE (
        CASE WHEN l.seq IS NOT NULL THEN l.c_name ELSE c.c_name END AS c_name)
    FROM customer c LEFT JOIN latest l ON c.c_custkey = l.c_custkey""")
def _update_masked(spark, d):
    return W.updated(table(spark, d, "customer"), customer_changes(spark, d), KEY, ["seq"],
                     updatable=["c_name"])


@query("update_null_safe", """WITH target AS (
        SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS nation, c_name
        FROM customer),
    latest AS (SELECT CASE WHEN n_nationkey <> 3 THEN n_nationkey END AS nation, n_name FROM nation)
    SELECT c_custkey, t.nation, coalesce(n_name, c_name) AS c_name FROM target t
    LEFT JOIN latest l ON t.nation IS NOT DISTINCT FROM l.nation""")
def _update_null_safe(spark, d):
    target = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("nation"),
        "c_name")
    source = table(spark, d, "nation").select(
        F.when(F.col("n_nationkey") != 3, F.col("n_nationkey")).alias("nation"),
        F.col("n_name").alias("c_name"))
    return W.updated(target, source, ["nation"], null_safe=True)


@query("upsert", _UPSERTED)
def _upsert(spark, d):
    return W.upserted(table(spark, d, "customer"), customer_changes(spark, d), KEY, ["seq"])


@query("insert_or_update", _LATEST + """SELECT c.* REPLACE (
        CASE WHEN l.seq IS NOT NULL THEN l.c_acctbal ELSE c.c_acctbal END AS c_acctbal)
    FROM customer c LEFT JOIN latest l ON c.c_custkey = l.c_custkey
    UNION ALL SELECT e.c_custkey, e.c_name, NULL, l.c_acctbal, NULL
    FROM earliest e JOIN latest l ON e.c_custkey = l.c_custkey
    WHERE e.c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def _insert_or_update(spark, d):
    return W.inserted_or_updated(table(spark, d, "customer"), customer_changes(spark, d), KEY,
                                 ["seq"], on_duplicate=["c_acctbal"])


@query("delete_matching", f"""WITH {CUSTOMER_CHANGES} SELECT * FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM customer_changes)""")
def _delete_matching(spark, d):
    return W.deleted(table(spark, d, "customer"), customer_changes(spark, d), KEY)


@query("insert_written", f"""WITH {CUSTOMER_CHANGES}
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, c_name, c_acctbal, 'NEW' FROM customer_changes""")
def _insert_written(spark, d):
    name = stored(table(spark, d, "customer").drop("c_nationkey"), "insert")
    W.write_insert(customer_changes(spark, d), name, add_cols={"c_mktsegment": F.lit("NEW")},
                   max_records_per_file=W.BATCH_ROWS)
    return spark.table(name)


@query("update_written", _UPDATED)
def _update_written(spark, d):
    name = stored(table(spark, d, "customer"), "update")
    W.write_update(customer_changes(spark, d), name, KEY, ["seq"])
    return spark.table(name)


@query("upsert_written", _UPSERTED)
def _upsert_written(spark, d):
    name = stored(table(spark, d, "customer"), "upsert")
    W.write_upsert(customer_changes(spark, d), name, KEY, ["seq"])
    return spark.table(name)


@query("update_partitions", """SELECT * REPLACE (
        CASE WHEN o_totalprice > 400000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_totalprice > 400000 AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END
            AS o_orderstatus) FROM orders""")
def _update_partitions(spark, d):
    """A table in partitions by status; the update sets prices and moves rows from P to F."""
    orders = table(spark, d, "orders")
    name = stored(orders, "orders", ["o_orderstatus"])
    dear = orders.filter("o_totalprice > 400000").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus"))
        .alias("o_orderstatus"))
    W.write_update(dear, name, ["o_orderkey"])
    return spark.table(name)


@query("upsert_partitions_masked", """SELECT * REPLACE (
        CASE WHEN o_totalprice > 400000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_totalprice <= 400000 THEN o_orderstatus END AS o_orderstatus) FROM orders""")
def _upsert_partitions_masked(spark, d):
    """A column that may not be set is null in the rows that come, also where it cuts the table."""
    orders = table(spark, d, "orders")
    name = stored(orders, "orders", ["o_orderstatus"])
    dear = orders.filter("o_totalprice > 400000").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    W.write_upsert(dear, name, ["o_orderkey"], insertable=[c for c in orders.columns if c != "o_orderstatus"])
    return spark.table(name)


def _dear(orders: DataFrame) -> DataFrame:
    return orders.filter("o_totalprice > 400000").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.when(F.col("o_orderstatus") == "P", "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))


def _snapshot(orders: DataFrame) -> tuple[str, str]:
    """Orders by status as a snapshot table, and its first version."""
    name = f"orders_{uuid.uuid4().hex}"
    return name, create_snapshot_table(orders, name, ["o_orderstatus"], scratch_path(orders.sparkSession, "snapshot"))


_DEAR = """SELECT * REPLACE (
        CASE WHEN o_totalprice > 400000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_totalprice > 400000 AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END
            AS o_orderstatus) FROM orders"""


@query("update_snapshot", f"""SELECT 'now' AS version, * FROM ({_DEAR})
    UNION ALL SELECT 'before', * FROM orders""")
def _update_snapshot(spark, d):
    """Partitions that change in one step; the version before stays readable."""
    orders = table(spark, d, "orders")
    name, first = _snapshot(orders)
    W.write_update(_dear(orders), name, ["o_orderkey"])
    now, before = spark.table(name), as_of(spark, name, first)
    return now.select(F.lit("now").alias("version"), "*").unionByName(before.select(F.lit("before").alias("version"), "*"))


@query("upsert_snapshot", """SELECT * REPLACE (
        CASE WHEN o_totalprice > 400000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_totalprice <= 400000 THEN o_orderstatus END AS o_orderstatus) FROM orders""")
def _upsert_snapshot(spark, d):
    """Rows move to the partition of the null status, which the table lacked."""
    orders = table(spark, d, "orders")
    name, _ = _snapshot(orders)
    dear = orders.filter("o_totalprice > 400000").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    W.write_upsert(dear, name, ["o_orderkey"], insertable=[c for c in orders.columns if c != "o_orderstatus"])
    return spark.table(name)


@query("snapshot_rolled_back", "SELECT * FROM orders")
def _snapshot_rolled_back(spark, d):
    orders = table(spark, d, "orders")
    name, first = _snapshot(orders)
    W.write_update(_dear(orders), name, ["o_orderkey"])
    roll_back(spark, name, first)
    return spark.table(name)


@query("upsert_bucketed", _UPSERTED)
def _upsert_bucketed(spark, d):
    """The same changes twice into a table in buckets by its key, which is not shuffled."""
    name = f"bucketed_{uuid.uuid4().hex}"
    W.as_bucketed(table(spark, d, "customer"), name, KEY, 16, scratch_path(spark, "bucketed"))
    for _ in range(2):
        W.write_upsert(customer_changes(spark, d), name, KEY, ["seq"], fits=False)
    return spark.table(name)


@query("incremental_late", """SELECT user_id, event_id, ts, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""")
def _incremental_late(spark, d):
    """The newer half first; the older half comes late, with known and with new users, and is looked back for."""
    events = table(spark, d, "events")
    half = events.agg(F.avg("event_id").alias("half")).scalar()
    newer = events.filter((F.col("event_id") >= half) & (F.col("user_id") % 3 > 0))
    name = stored(W.upserted(events.limit(0), newer, ["user_id"], ["ts"]), "late")
    return W.as_incremental(events, name, ["user_id"], "ts", F.expr("INTERVAL 3650 DAYS"))


_NULL_KEYS = """WITH nulled AS (SELECT * REPLACE (
        CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, CASE WHEN event_id % 21 <> 0 THEN ts END AS ts)
        FROM events),
    parted AS (SELECT *, event_id >= (SELECT avg(event_id) FROM events) AND event_id % 2 = 0 AS early FROM nulled),
    marked AS (SELECT *, early OR coalesce(ts > (SELECT max(ts) FROM parted WHERE early), false) AS added FROM parted)
    SELECT 'table' AS place, event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM marked) WHERE user_id IS NOT NULL AND rn = 1
    UNION ALL SELECT CASE WHEN added THEN 'table' ELSE 'reject' END, event_id, ts, user_id, event_type, value, props
    FROM marked WHERE user_id IS NULL"""


@query("incremental_null_keys", _NULL_KEYS)
def _incremental_null_keys(spark, d):
    """Rows without a user or a time, half of the newer half first, then all events twice: each ends in one place, once."""
    events = table(spark, d, "events")
    half = events.agg(F.avg("event_id").alias("half")).scalar()
    early = (F.col("event_id") >= half) & (F.col("event_id") % 2 == 0)
    nulled = events.withColumns({c: F.when(F.col("event_id") % n != 0, F.col(c)) for c, n in (("user_id", 7), ("ts", 21))})
    name = stored(W.upserted(nulled.limit(0), nulled.filter(early), ["user_id"], ["ts"]), "null_keys")
    nulled.limit(0).write.option("path", scratch_path(spark, "unkeyed")).saveAsTable(W.unkeyed_table(name))
    for _ in range(2):
        loaded = W.as_incremental(nulled, name, ["user_id"], "ts", F.expr("INTERVAL 3650 DAYS"))
    return loaded.withColumn("place", F.lit("table")).unionByName(
        spark.table(W.unkeyed_table(name)).withColumn("place", F.lit("reject")))


@query("incremental_stream_null_keys", _NULL_KEYS)
def _incremental_stream_null_keys(spark, d):
    """The same by stream: early rows, then all events, then all events again as a batch that is repeated."""
    inbox, events = scratch_path(spark, "inbox"), table(spark, d, "events")
    half = events.agg(F.avg("event_id").alias("half")).scalar()
    early = (F.col("event_id") >= half) & (F.col("event_id") % 2 == 0)
    nulled = events.withColumns({c: F.when(F.col("event_id") % n != 0, F.col(c)) for c, n in (("user_id", 7), ("ts", 21))})
    name, checkpoint = stored(nulled.limit(0), "stream_null_keys"), scratch_path(spark, "stream-checkpoint")
    nulled.limit(0).write.option("path", scratch_path(spark, "unkeyed")).saveAsTable(W.unkeyed_table(name))
    for part in (nulled.filter(early), nulled, nulled):
        part.write.mode("append").parquet(inbox)
        load_new(spark.readStream.schema(nulled.schema).parquet(inbox), name, ["user_id"], ["ts"], checkpoint)
    return spark.table(name).withColumn("place", F.lit("table")).unionByName(
        spark.table(W.unkeyed_table(name)).withColumn("place", F.lit("reject")))


_BY_USER = """SELECT user_id, event_id, ts, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events)
    WHERE rn = 1"""


@query("incremental", _BY_USER)
def _incremental(spark, d):
    """Two loads into one table keyed by user: the older half, then all events again."""
    events = table(spark, d, "events")
    half = events.agg(F.avg("event_id").alias("half")).scalar()
    name = stored(W.upserted(events.limit(0), events.filter(F.col("event_id") < half), ["user_id"],
                             ["ts"]), "incremental")
    return W.as_incremental(events, name, ["user_id"], "ts")


@query("incremental_stream", _BY_USER)
def _incremental_stream(spark, d):
    """The same table, fed by a stream that reads files it has not seen and stops."""
    inbox, events = scratch_path(spark, "inbox"), table(spark, d, "events")
    name = stored(events.limit(0), "stream")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    half = events.agg(F.avg("event_id").alias("half")).scalar()
    for part in (events.filter(F.col("event_id") < half), events.filter(F.col("event_id") >= half)):
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).parquet(inbox)
        load_new(stream, name, ["user_id"], ["ts"], checkpoint)
    return spark.table(name)


@query("incremental_stream_late", _BY_USER)
def _incremental_stream_late(spark, d):
    """The newer half of two users in three by stream first; then all events, late ones and new users among them."""
    inbox, events = scratch_path(spark, "inbox"), table(spark, d, "events")
    name, checkpoint = stored(events.limit(0), "stream_late"), scratch_path(spark, "stream-checkpoint")
    half = events.agg(F.avg("event_id").alias("half")).scalar()
    for part in (events.filter((F.col("event_id") >= half) & (F.col("user_id") % 3 > 0)), events):
        part.write.mode("append").parquet(inbox)
        load_new(spark.readStream.schema(events.schema).parquet(inbox), name, ["user_id"], ["ts"], checkpoint)
    return spark.table(name)


_RULES = [ColumnRule("SAL", "int", nullable=False, max_length=6)]


@query("sink_written", f"""WITH {RAW_PEOPLE} SELECT * FROM raw_people WHERE "SAL" IS NOT NULL
    AND TRY_CAST("SAL" AS INTEGER) IS NOT NULL AND length("SAL") <= 6""")
def _sink_written(spark, d):
    return W.split_for_write(raw_people(spark, d), _RULES)["written"]


@query("sink_quarantine", f"""WITH {RAW_PEOPLE}
    SELECT *, CASE WHEN "SAL" IS NULL THEN '4' WHEN length("SAL") > 6 THEN '8' ELSE '2' END
        AS "errorCode",
        CASE WHEN "SAL" IS NULL THEN 'SAL:empty' WHEN length("SAL") > 6 THEN 'SAL:length'
             ELSE 'SAL:type' END AS "errorMessage", 'people' AS source, 'r1' AS run
    FROM raw_people WHERE NOT coalesce(TRY_CAST("SAL" AS INTEGER) IS NOT NULL
        AND length("SAL") <= 6, false)""")
def _sink_quarantine(spark, d):
    rejected = W.split_for_write(raw_people(spark, d), _RULES)["reject"]
    tagged = rejected.withColumns({"source": F.lit(""), "run": F.lit("")})
    name = stored(tagged.limit(0), "quarantine")
    W.quarantine(rejected, name, "people", "r1")
    return spark.table(name)


@query("high_water", """SELECT event_id, ts FROM events
    WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'error')""")
def _high_water(spark, d):
    events = table(spark, d, "events").select("event_id", "ts", "event_type")
    return W.newer_than(events, events.filter("event_type = 'error'"), "ts").drop("event_type")


@query("sink_refused", """SELECT *, 'taken' AS place, NULL AS "errorMessage" FROM customer
    WHERE c_acctbal >= 100
    UNION ALL SELECT *, 'refused', c_name || ' holds too little' FROM customer WHERE c_acctbal < 100""")
def _sink_refused(spark, d):
    """A sink with a rule that only it knows: what it took, and what it gave back."""
    customers, folder = table(spark, d, "customer"), scratch_path(spark, "sink")

    def refuse(row):
        return ("99", f"{row.c_name} holds too little") if row.c_acctbal < 100 else None

    back = write_to_sink(customers, FileSink(folder, customers.schema, refuse))
    taken = spark.read.schema(customers.schema).parquet(folder)
    return (taken.withColumns({"place": F.lit("taken"), "errorMessage": F.lit(None).cast("string")})
            .unionByName(back.drop("errorCode").withColumn("place", F.lit("refused"))))
