"""Queries over the test tables, one or more for each operator, and the same in SQL for an independent engine."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import transforms
from .functions.coerce import json_parameters
from .functions.idents import parse_schema
from .operators import paging
from .operators import write_modes as modes
from .plans.config import parse
from .plans.engine import SyncEngine
from .sources.catalog import Catalog
from .sources.queries import SparkSource
from .streaming.consumer import Consumer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL if there is any."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(df: DataFrame, column: str, n: int, rest: int = 0) -> DataFrame:
    return df.where(F.col(column) % n == rest)


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _catalog(spark: SparkSession, name: str = "shop") -> Catalog:
    """An empty catalog in the folder that the cluster shares; only where there is none and the master is local, in a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    root = f"{shared.rstrip('/')}/lakesync-warehouse/{datetime.now():%Y%m%d%H%M%S%f}" if shared else f"file://{tempfile.mkdtemp(prefix='lakesync-warehouse-')}"
    catalog = Catalog(spark, root)
    catalog.create_namespace(name)
    return catalog


# ---- scans, predicates, pages ----


@query("SELECT event_id, user_id, event_type FROM events")
def scan_projection(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")


@query("SELECT event_id, ts, event_type FROM events ORDER BY event_id LIMIT 50")
def scan_limit(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", "ts", "event_type").orderBy("event_id").limit(50)


@query("SELECT count(*) AS row_count FROM lineitem")
def count_rows(spark, sf_dir):
    return _read(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("row_count"))


@query("SELECT event_id, event_type FROM events WHERE event_type = 'click' OR event_type = 'view'")
def predicate_or_equals(spark, sf_dir):
    return _read(spark, sf_dir, "events").where(paging.any_of("event_type", ["click", "view"])).select("event_id", "event_type")


@query("SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_slice(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return df.where(F.col("ts") > _ts("2024-01-15 00:00:00"))


@query("SELECT max(ts) AS new_watermark, count(*) AS rows_written FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def watermark_advance(spark, sf_dir):
    return incremental_slice(spark, sf_dir).agg(F.max("ts").alias("new_watermark"), F.count(F.lit(1)).alias("rows_written"))


@query("SELECT event_id, ts, value FROM events WHERE event_id > 499 ORDER BY event_id LIMIT 100")
def cursor_page_int(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "ts", "value")
    return paging.strip(paging.keyset_page(df, "event_id", 499, 100), paging.CURSOR)


@query("SELECT c_custkey, c_name FROM customer WHERE c_name > 'Customer#000000099' ORDER BY c_name LIMIT 25")
def cursor_page_text(spark, sf_dir):
    df = _read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return paging.strip(paging.keyset_page(df, "c_name", "Customer#000000099", 25), paging.CURSOR)


@query("SELECT event_id, ts FROM events ORDER BY event_id LIMIT 100 OFFSET 300")
def offset_page(spark, sf_dir):
    return paging.offset_page(_read(spark, sf_dir, "events").select("event_id", "ts"), ["event_id"], 100, 300)


@query(
    "SELECT page, count(*) AS rows_in_page, max(event_id) AS cursor_after FROM (SELECT event_id, "
    "CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 700.0) AS BIGINT) AS page FROM events) GROUP BY page"
)
def cursor_page_ledger(spark, sf_dir):
    """Every page of a paged read. Ranks come from counts of id ranges, so that no task sorts all ids."""
    ids, width = _read(spark, sf_dir, "events").select("event_id"), 4096
    parts = ids.withColumn("part", F.floor(F.col("event_id") / width))
    from pyspark.sql import Window

    start = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", start.alias("start"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("event_id"))
    page = F.floor((F.col("start") + F.col("rank") - 1) / 700).cast("long")
    ranked = parts.withColumn("rank", rank).join(starts, "part").select("event_id", page.alias("page"))
    return ranked.groupBy("page").agg(F.count(F.lit(1)).alias("rows_in_page"), F.max("event_id").alias("cursor_after"))


# ---- write modes ----


@query(
    "SELECT event_id, ts, event_type, value FROM events WHERE event_id % 2 = 0 UNION ALL "
    "SELECT event_id, ts, event_type, value FROM events WHERE event_id % 5 = 0"
)
def append_batch(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return modes.append(_every(df, "event_id", 2), _every(df, "event_id", 5))


@query(
    "WITH b AS (SELECT event_id, event_type, value + 1 AS value FROM events WHERE event_type = 'click' AND event_id % 2 = 0) "
    "SELECT event_id, event_type, value FROM events t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.event_type = t.event_type) UNION ALL SELECT * FROM b"
)
def overwrite_identity(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    batch = _every(df.where("event_type = 'click'"), "event_id", 2).withColumn("value", F.col("value") + 1)
    return modes.overwrite(df, batch, "event_type")


@query(
    "WITH b AS (SELECT event_id, ts, value + 1 AS value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' AND event_id % 3 = 0) "
    "SELECT event_id, ts, value FROM events t WHERE CAST(ts AS DATE) NOT IN (SELECT CAST(ts AS DATE) FROM b) UNION ALL SELECT * FROM b"
)
def overwrite_day(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "ts", "value")
    days = df.where((F.col("ts") >= _ts("2024-01-10")) & (F.col("ts") < _ts("2024-01-12")))
    return modes.overwrite(df, _every(days, "event_id", 3).withColumn("value", F.col("value") + 1), "ts", "day")


@query(
    "WITH b AS (SELECT o_orderkey, o_orderdate, o_totalprice + 1 AS o_totalprice FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 3 AND o_orderkey % 2 = 0) "
    "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders t WHERE date_trunc('month', o_orderdate) NOT IN (SELECT date_trunc('month', o_orderdate) FROM b) UNION ALL SELECT * FROM b"
)
def overwrite_month(spark, sf_dir):
    df = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    march = _every(df.where((F.year("o_orderdate") == 1996) & (F.month("o_orderdate") == 3)), "o_orderkey", 2)
    return modes.overwrite(df, march.withColumn("o_totalprice", F.col("o_totalprice") + 1), "o_orderdate", "month")


@query(
    "WITH b AS (SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 10 = 0 UNION ALL "
    "SELECT o_orderkey + 10000000, 'N', o_totalprice FROM orders WHERE o_orderkey % 97 = 0) SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders t "
    "WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey IS NOT DISTINCT FROM t.o_orderkey) UNION ALL SELECT * FROM b"
)
def upsert_single_key(spark, sf_dir):
    df = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = _every(df, "o_orderkey", 10).withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    new = _every(df, "o_orderkey", 97).withColumns({"o_orderkey": F.col("o_orderkey") + 10_000_000, "o_orderstatus": F.lit("N")})
    return modes.upsert(df, modes.union_all([changed, new]), ["o_orderkey"])


@query(
    "WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity + 1 AS l_quantity FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 4 = 0) "
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey IS NOT DISTINCT FROM t.l_orderkey "
    "AND b.l_linenumber IS NOT DISTINCT FROM t.l_linenumber) UNION ALL SELECT * FROM b"
)
def upsert_composite_key(spark, sf_dir):
    df = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    batch = _every(df.where("l_linenumber = 1"), "l_orderkey", 4).withColumn("l_quantity", F.col("l_quantity") + 1)
    return modes.upsert(df, batch, ["l_orderkey", "l_linenumber"])


@query(
    "WITH t AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id END AS k, event_type, value FROM events), "
    "b AS (SELECT CASE WHEN event_id % 14 = 0 THEN NULL ELSE event_id END AS k, event_type, value + 1 AS value FROM events WHERE event_id % 2 = 0) "
    "SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k IS NOT DISTINCT FROM t.k) UNION ALL SELECT * FROM b"
)
def upsert_null_key(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    key = lambda n: F.when(F.col("event_id") % n != 0, F.col("event_id")).alias("k")
    batch = _every(df, "event_id", 2).select(key(14), "event_type", (F.col("value") + 1).alias("value"))
    return modes.upsert(df.select(key(7), "event_type", "value"), batch, ["k"])


@query(
    "SELECT CASE WHEN upper(op) IN ('U','UPDATE') THEN 'U' WHEN upper(op) IN ('D','DELETE') THEN 'D' ELSE 'I' END AS op, count(*) AS n FROM "
    "(SELECT CASE event_id % 6 WHEN 0 THEN 'U' WHEN 1 THEN 'delete' WHEN 2 THEN 'i' WHEN 3 THEN 'Update' WHEN 4 THEN 'zzz' ELSE NULL END AS op FROM events) GROUP BY 1"
)
def split_by_op(spark, sf_dir):
    words = F.array(*(F.lit(w) for w in ("U", "delete", "i", "Update", "zzz", None)))
    op = words[(F.col("event_id") % 6).cast("int")]
    return _read(spark, sf_dir, "events").groupBy(modes.operation(op).alias("op")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "WITH t AS (SELECT event_id, event_type, value FROM events WHERE event_id % 2 = 0), b AS (SELECT event_id, event_type, value + 1 AS value, "
    "CASE event_id % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'd' ELSE 'insert' END AS _op FROM events WHERE event_id % 5 = 0) SELECT * FROM t WHERE NOT EXISTS "
    "(SELECT 1 FROM b WHERE upper(b._op) IN ('U','UPDATE','D','DELETE') AND b.event_id IS NOT DISTINCT FROM t.event_id) "
    "UNION ALL SELECT event_id, event_type, value FROM b WHERE upper(coalesce(_op,'I')) NOT IN ('D','DELETE')"
)
def merge_into_iud(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "event_type", "value")
    op = F.array(*(F.lit(w) for w in ("U", "d", "insert")))[(F.col("event_id") % 3).cast("int")]
    return modes.merge_into(_every(df, "event_id", 2), _every(df, "event_id", 5).withColumns({"value": F.col("value") + 1, modes.OP: op}), ["event_id"])


@query(
    "WITH t AS (SELECT event_id, value FROM events WHERE event_id % 2 = 0), b AS (SELECT event_id, value FROM events WHERE event_id % 10 = 1) "
    "SELECT * FROM t UNION ALL SELECT * FROM b"
)
def merge_into_insert_only(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id", "value")
    return modes.merge_into(_every(df, "event_id", 2), _every(df, "event_id", 10, 1).withColumn(modes.OP, F.lit("I")), ["event_id"])


@query(
    "SELECT count(*) AS remaining FROM (SELECT event_id FROM events t WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.event_id IS NOT DISTINCT FROM t.event_id))"
)
def merge_into_all_deletes(spark, sf_dir):
    df = _read(spark, sf_dir, "events").select("event_id")
    return modes.merge_into(df, df.withColumn(modes.OP, F.lit("D")), ["event_id"]).agg(F.count(F.lit(1)).alias("remaining"))


# ---- partitions and schema ----


@query(
    "SELECT event_id, CAST(floor(epoch_us(ts) / 3600000000.0) AS BIGINT) AS ts_hour, datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS ts_day, "
    "(year(ts) - 1970) * 12 + month(ts) - 1 AS ts_month, year(ts) - 1970 AS ts_year FROM events"
)
def partition_transforms(spark, sf_dir):
    each = (transforms.number(F.col("ts"), t).cast("long").alias(f"ts_{t}") for t in transforms.TRANSFORMS)
    return _read(spark, sf_dir, "events").select("event_id", *each)


@query(
    "SELECT event_id, strftime(ts, '%Y-%m-%d-%H') AS ts_hour, strftime(ts, '%Y-%m-%d') AS ts_day, strftime(ts, '%Y-%m') AS ts_month, strftime(ts, '%Y') AS ts_year FROM events"
)
def partition_labels(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", *(transforms.label(F.col("ts"), t).alias(f"ts_{t}") for t in transforms.TRANSFORMS))


@query("SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS ts_day FROM events WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-10', DATE '2024-01-11')")
def untouched_partitions(spark, sf_dir):
    """Partitions whose files an overwrite of two days carries over unread, by the manifest of a real table."""
    events = _read(spark, sf_dir, "events").select("event_id", "ts")
    table, _ = _catalog(spark).create_table("shop.events", parse_schema("event_id:long,ts:timestamp"), {"column": "ts", "transform": "day"})
    table.append(events)
    kept = sorted({(f.partition,) for f in table.files_of(["2024-01-10", "2024-01-11"], inverse=True)})
    return spark.createDataFrame(kept, "ts_day string")


def _events_table(spark: SparkSession, sf_dir: str, columns: str):
    schema = parse_schema(columns)
    catalog = _catalog(spark)
    table, _ = catalog.create_table("shop.events", schema)
    table.append(_read(spark, sf_dir, "events").select(*schema.fieldNames()))
    return catalog, table


@query("SELECT event_id, value, CAST(NULL AS VARCHAR) AS note FROM events")
def schema_add_column(spark, sf_dir):
    _, table = _events_table(spark, sf_dir, "event_id:long,value:double")
    table.add_column("note", parse_schema("note:string")["note"].dataType)
    return table.read()


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def schema_drop_column(spark, sf_dir):
    _, table = _events_table(spark, sf_dir, "event_id:long,ts:timestamp,user_id:long,event_type:string,value:double,props:string")
    table.drop_column("props")
    return table.read()


@query("SELECT event_id, value FROM events ORDER BY event_id LIMIT 500")
def copy_table_limit(spark, sf_dir):
    """The first 500 rows by id, appended to another table and read from there."""
    catalog, table = _events_table(spark, sf_dir, "event_id:long,value:double")
    target, _ = catalog.create_table("shop.copy", table.metadata().schema)
    target.append(table.read().orderBy("event_id").limit(500))
    return target.read()


# ---- what jobs delegate to SQL ----


@query(
    "SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderdate AS order_updated_at FROM lineitem l INNER JOIN orders o ON o.o_orderkey = l.l_orderkey "
    "WHERE o.o_orderdate > TIMESTAMP '1997-01-01'"
)
def source_join_incremental(spark, sf_dir):
    source = SparkSource(spark, {t: _read(spark, sf_dir, t) for t in ("orders", "lineitem")})
    return source.query(
        "SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderdate AS order_updated_at FROM lineitem l INNER JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE o.o_orderdate > :watermark",
        {"watermark": datetime(1997, 1, 1)},
    )


@query(
    "SELECT CAST(o.o_orderdate AS DATE) AS sale_date, p.p_brand AS category, count(DISTINCT o.o_orderkey) AS order_count, "
    "CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, CAST(sum(l.l_quantity) AS DOUBLE) AS units_sold FROM orders o "
    "INNER JOIN lineitem l ON l.l_orderkey = o.o_orderkey INNER JOIN part p ON p.p_partkey = l.l_partkey "
    "WHERE CAST(o.o_orderdate AS DATE) >= DATE '1996-01-01' AND CAST(o.o_orderdate AS DATE) < DATE '1996-02-01' GROUP BY 1, 2"
)
def source_daily_sales(spark, sf_dir):
    source = SparkSource(spark, {t: _read(spark, sf_dir, t) for t in ("orders", "lineitem", "part")})
    return source.query(
        "SELECT to_date(o.o_orderdate) AS sale_date, p.p_brand AS category, count(DISTINCT o.o_orderkey) AS order_count, "
        "CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, CAST(sum(l.l_quantity) AS DOUBLE) AS units_sold FROM orders o "
        "INNER JOIN lineitem l ON l.l_orderkey = o.o_orderkey INNER JOIN part p ON p.p_partkey = l.l_partkey "
        "WHERE o.o_orderdate >= :first AND o.o_orderdate < :after GROUP BY 1, 2",
        {"first": datetime(1996, 1, 1), "after": datetime(1996, 2, 1)},
    )


@query(
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CASE event_type WHEN 'signup' THEN 'I' WHEN 'click' THEN 'U' WHEN 'error' THEN 'D' ELSE 'I' END AS _op FROM events"
)
def source_cdc_json(spark, sf_dir):
    source = SparkSource(spark, {"events": _read(spark, sf_dir, "events")})
    return source.query("SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k, CASE event_type WHEN 'signup' THEN 'I' WHEN 'click' THEN 'U' WHEN 'error' THEN 'D' ELSE 'I' END AS _op FROM events", {})


@query("SELECT event_id, user_id, ts FROM events WHERE user_id = 7")
def message_params(spark, sf_dir):
    source = SparkSource(spark, {"events": _read(spark, sf_dir, "events")})
    return source.query("SELECT event_id, user_id, ts FROM events WHERE user_id = :user_id", json_parameters('{"user_id": 7, "user": 1}'))


# ---- tables, runs and messages as a whole ----


def _job_config(jobs: str, uri: str = "") -> str:
    return f"""
sources: {{views: {{type: spark}}}}
destinations: {{lake: {{warehouse: unused}}}}
retry: {{max_attempts: 1}}
rabbitmq: {{uri: "{uri}", queues: [{{queue: users, job: events, dead_letter_exchange: dlx}}]}}
sync_jobs:
{jobs}
"""


_EVENTS_JOB = """
  - name: events
    source: views
    destination: lake
    namespace: shop
    table: events
    sql: SELECT event_id, ts, event_type, value FROM staged WHERE ts > :watermark
    watermark_column: ts
    watermark_type: timestamp
    cursor_column: event_id
    write_mode: upsert
    merge: {key_columns: [event_id]}
"""


@query(
    "SELECT event_id, ts, event_type, value + CASE WHEN ts > TIMESTAMP '2024-01-20' AND event_id % 5 = 0 THEN 1 ELSE 0 END AS value FROM events"
)
def sync_three_stage(spark, sf_dir):
    """Three incremental upsert runs over a growing source: half of it, the other half, then nothing; changed rows come late."""
    events = _read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    late = F.col("ts") > _ts("2024-01-20")
    changed = F.when(late & (F.col("event_id") % 5 == 0), F.col("value") + 1).otherwise(F.col("value"))
    catalog, config = _catalog(spark), parse(_job_config(_EVENTS_JOB))
    engine = SyncEngine(spark, config, catalogs={"lake": catalog}, sources={"views": SparkSource(spark)})
    for stage in (events.where(~late), events.withColumn("value", changed), events.withColumn("value", changed)):
        stage.createOrReplaceTempView("staged")
        engine.run(config.job("events"))
    return catalog.load("shop.events").read()


def _engine(spark: SparkSession, catalog: Catalog, job: str) -> tuple[SyncEngine, Callable[[DataFrame], object]]:
    """An engine with one job `events` over the view `staged`, and a function that runs it over a frame."""
    config = parse(_job_config(job))
    engine = SyncEngine(spark, config, catalogs={"lake": catalog}, sources={"views": SparkSource(spark)})

    def run(df: DataFrame):
        df.createOrReplaceTempView("staged")
        return engine.run(config.job("events"))

    return engine, run


def _plain_job(sql: str, more: str) -> str:
    return f"""
  - name: events
    source: views
    destination: lake
    namespace: shop
    table: events
    mode: full
    sql: {sql}
    {more}
"""


@query("SELECT event_id, CASE WHEN event_id % 3 = 1 THEN value + 1 ELSE value END AS value FROM events WHERE event_id % 3 <> 0")
def sync_merge_into(spark, sf_dir):
    """All events, then a run of changes: every third event is deleted, every third updated, and deletes of unknown events do nothing."""
    events = _read(spark, sf_dir, "events").select("event_id", "value")
    _, run = _engine(spark, catalog := _catalog(spark), _plain_job("SELECT * FROM staged", "write_mode: merge_into\n    merge: {key_columns: [event_id]}"))
    run(events.withColumn("_op", F.lit("I")))
    changes = events.where("event_id % 3 <> 2").withColumn("_op", F.when(F.col("event_id") % 3 == 0, "d").otherwise("U")).withColumn("value", F.col("value") + 1)
    run(changes.union(events.select(-F.col("event_id") - 1, "value", F.lit("D"))))
    return catalog.load("shop.events").read()


@query(
    "SELECT event_id, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-10' OR ts >= TIMESTAMP '2024-01-12' UNION ALL "
    "SELECT event_id, ts, value + 1 FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' AND event_id % 2 = 0"
)
def sync_overwrite_days(spark, sf_dir):
    """A table partitioned by day, of which a second run replaces two days by half as many changed rows."""
    events = _read(spark, sf_dir, "events").select("event_id", "ts", "value")
    _, run = _engine(spark, catalog := _catalog(spark), _plain_job("SELECT * FROM staged", "write_mode: overwrite\n    iceberg_partition: {column: ts, transform: day}"))
    run(events)
    run(events.where((F.col("ts") >= _ts("2024-01-10")) & (F.col("ts") < _ts("2024-01-12")) & (F.col("event_id") % 2 == 0)).withColumn("value", F.col("value") + 1))
    return catalog.load("shop.events").read()


@query("SELECT 'users' AS queue, 'dlx' AS exchange, 'not json' AS payload, 2 AS users, count(*) AS rows_synced FROM events WHERE user_id IN (7, 8)")
def consumer_dead_letters(spark, sf_dir):
    """Two messages run a job, one is no JSON object: it ends in the dead-letter table, which is returned beside what the others wrote."""
    from .sources.files import Files

    catalog = _catalog(spark)
    uri, files = f"{catalog.warehouse}/messages", Files(spark)
    files.create(f"{uri}/users/1.json", '{"user_id": 7}\nnot json\n{"user_id": 8}\n')
    job = _EVENTS_JOB.replace("FROM staged WHERE ts > :watermark", "FROM staged WHERE user_id = :user_id")
    config = parse(_job_config(job, uri))
    _read(spark, sf_dir, "events").createOrReplaceTempView("staged")
    engine = SyncEngine(spark, config, catalogs={"lake": catalog}, sources={"views": SparkSource(spark)})
    Consumer(spark, engine, config, f"{catalog.warehouse}/checkpoints").run(once=True)
    dead = catalog.load("dead_letters.users").read().select("queue", "exchange", "payload")
    return dead.withColumns({"users": F.lit(2), "rows_synced": F.lit(catalog.load("shop.events").count())})


@query("SELECT * FROM (VALUES ('field', 'event_id', '1: bigint, optional'), ('field', 'ts', '2: timestamp_ntz, optional'), ('table', 'format-version', '1')) AS t(item, name, value)")
def describe(spark, sf_dir):
    """What describes any such table; its location and the names of its files are its own."""
    catalog, _ = _events_table(spark, sf_dir, "event_id:long,ts:timestamp")
    return catalog.describe("shop.events").where("name NOT IN ('location', 'current-snapshot-id', 'manifest')")


def _history(snapshots: DataFrame, table) -> DataFrame:
    """Snapshots, newest first, with the rows that each added and holds; ids and times are their own."""
    held = {s.id: s.summary for s in table.metadata().snapshots}
    rows = [(i, r["operation"], r["is_current"], held[r["snapshot_id"]]["added-records"], held[r["snapshot_id"]]["total-records"]) for i, r in enumerate(snapshots.collect())]
    return snapshots.sparkSession.createDataFrame(rows, "age int, operation string, is_current boolean, added long, total long")


_TENTH = "(SELECT count(*) FROM events WHERE event_id % 10 = 0)"


@query(
    f"SELECT 0 AS age, 'append' AS operation, true AS is_current, {_TENTH} AS added, count(*) + {_TENTH} AS total FROM events "
    "UNION ALL SELECT 1, 'append', false, count(*), count(*) FROM events"
)
def snapshots(spark, sf_dir):
    _, table = _events_table(spark, sf_dir, "event_id:long,ts:timestamp")
    table.append(_every(_read(spark, sf_dir, "events"), "event_id", 10))
    return _history(table.snapshots(), table)


@query(
    "SELECT 'total-records' AS statistic, count(*) AS value FROM events UNION ALL SELECT 'added-records', count(*) FROM events "
    "UNION ALL SELECT 'deleted-records', 0 UNION ALL SELECT 'total-delete-files', 0"
)
def table_stats(spark, sf_dir):
    _, table = _events_table(spark, sf_dir, "event_id:long,ts:timestamp")
    found = spark.createDataFrame(sorted(table.stats().items()), "statistic string, value long")
    return found.where("statistic NOT IN ('total-data-files', 'added-data-files', 'total-files-size')")  # how many files hold the rows is the cluster's affair


@query(f"SELECT 0 AS age, 'append' AS operation, true AS is_current, {_TENTH} AS added, count(*) + {_TENTH} AS total FROM events")
def expire_snapshots(spark, sf_dir):
    """What is left after all snapshots but the current one are expired."""
    _, table = _events_table(spark, sf_dir, "event_id:long,ts:timestamp")
    table.append(_every(_read(spark, sf_dir, "events"), "event_id", 10))
    table.expire_snapshots(older_than_days=-1)
    return _history(table.snapshots(), table)


@query("SELECT 'tier' AS key, '2' AS value")
def namespace_properties(spark, sf_dir):
    catalog = _catalog(spark)
    catalog.namespace_properties("shop", {"owner": "data", "tier": "1"})
    found = catalog.namespace_properties("shop", {"tier": "2"}, ["owner"])
    return spark.createDataFrame(sorted(found.items()), "key string, value string")


@query("SELECT 'shop' AS namespace, 'events' AS table_name, count(*) AS row_count FROM events")
def list_tables(spark, sf_dir):
    """Tables of all namespaces with their rows, counted by manifest."""
    catalog, _ = _events_table(spark, sf_dir, "event_id:long,ts:timestamp")
    rows = [(n, t, catalog.load(f"{n}.{t}").count()) for n in catalog.namespaces() for t in catalog.tables(n)]
    return spark.createDataFrame(rows, "namespace string, table_name string, row_count long")
