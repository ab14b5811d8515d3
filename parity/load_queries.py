"""Sources, sinks, load control and schema operators.

Queries on sinks write to a new folder and return what a reader then sees.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import functions as F

from orderloom.functions import temporal as T
from orderloom.operators import schema as S
from orderloom.operators import sinks as K
from orderloom.plans.table_load import load_table, read_current, read_latest
from orderloom.sources import tables as SRC
from orderloom.sources.delimited import read_text, write_text
from orderloom.session import shared_dir
from orderloom.streaming import watermark as W

from .inputs import Tables
from .registry import query
from .scalar_queries import NOW

LATER = datetime(2024, 1, 6, 9, 30)


def source(t: Tables, name: str) -> SRC.Source:
    return SRC.Source("shop-db", "shop", name, format="parquet", location=t.path(name))


def new_table(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


@query("scan_full", "SELECT * FROM orders")
def scan_full(t: Tables):
    return SRC.read_full(t.spark, source(t, "orders"))


@query("scan_where", "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30")
def scan_where(t: Tables):
    return SRC.read_full(t.spark, source(t, "lineitem"), where="l_returnflag = 'R' AND l_quantity > 30")


@query("scan_columns", "SELECT c_custkey, c_mktsegment FROM customer")
def scan_columns(t: Tables):
    return SRC.read_full(t.spark, source(t, "customer"), columns=["c_custkey", "c_mktsegment"])


@query(
    "scan_query",
    """SELECT o_orderpriority, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority""",
)
def scan_query(t: Tables):
    text = """SELECT o_orderpriority, count(*) AS n_orders, max(o_orderdate) AS last_order
              FROM {source} WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority"""
    return SRC.read_full(t.spark, source(t, "orders"), query=text)


@query(
    "scan_partitioned",
    """WITH b AS (SELECT min(l_orderkey) AS lo, max(l_orderkey) AS hi, CAST(ceil(count(*) / 5000.0) AS BIGINT) AS n FROM lineitem)
       SELECT CAST((l_orderkey - lo) // ((hi - lo) // n + 1) AS INT) AS page, count(*) AS n_rows,
              min(l_orderkey) AS first_key, max(l_orderkey) AS last_key
       FROM lineitem, b GROUP BY page""",
)
def scan_partitioned(t: Tables):
    """The pages of a read in key ranges, checked on whole rows: each page's rows and keys."""
    rows = SRC.read_full(t.spark, source(t, "lineitem"))
    return rows.groupBy(SRC.pages_of(rows, "l_orderkey", page_rows=5000).alias("page")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key")
    )


@query(
    "scan_slices",
    "SELECT count(*) AS n_rows, count(*) AS rows_in_one_slice, true AS balanced FROM lineitem",
)
def scan_slices(t: Tables):
    """The slices that a parallel read asks its source for, on a key that has 9 of 10 rows in the lowest hundredth of its range.

    Every row is in exactly one slice, also one without a key, and no slice of keys holds over twice the mean.
    """
    path = shared_dir(t.spark, "uneven")
    key = "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 10 = 0 THEN 100 ELSE 1 END * (l_orderkey * 10 + l_linenumber) AS k"
    t["lineitem"].selectExpr(key).write.parquet(path)
    src = SRC.Source("shop-db", "shop", "uneven", format="parquet", location=path)
    n = SRC.source_count(t.spark, src).first()["n_rows"]
    slices = SRC.asked_slices(t.spark, src, "k", page_rows=max(1, n // 12))
    inside = [F.coalesce(F.expr(p), F.lit(False)) for p in slices]
    counted = SRC.read_full(t.spark, src).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(sum((c.cast("int") for c in inside), F.lit(0)) == 1).alias("rows_in_one_slice"),
        F.greatest(*[F.count_if(c) for c in inside[:-1]]).alias("largest"),
    )
    return counted.select("n_rows", "rows_in_one_slice", (F.col("largest") <= F.lit(2 / (len(slices) - 1)) * F.col("n_rows")).alias("balanced"))


@query("source_count", "SELECT count(*) AS n_rows FROM lineitem WHERE l_linestatus = 'F'")
def source_count(t: Tables):
    return SRC.source_count(t.spark, source(t, "lineitem"), "l_linestatus = 'F'")


def event_log(t: Tables):
    """A load log: every event type was loaded once a day, on every host."""
    daily = t["events"].groupBy("event_type", F.to_date("ts").alias("day"), (F.col("user_id") % 2).alias("host_no")).agg(
        F.max("ts").alias("max_ts")
    )
    return daily.select(
        F.lit("shop").alias("db_name"), F.col("event_type").alias("db_table"),
        F.concat(F.lit("host-"), F.col("host_no").cast("string")).alias("host"), F.lit("ts").alias("inc_column"),
        "max_ts", F.col("max_ts").alias("logged_at"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in W.LOG_SCHEMA if f.name in W.MAXIMA[1:]],
    )


@query(
    "watermark_lookup",
    """SELECT c.db_table, c.host, c.inc_column, m.max_ts
       FROM (SELECT DISTINCT event_type AS db_table, 'host-' || CAST(n_regionkey AS VARCHAR) AS host, 'ts' AS inc_column
             FROM events, nation WHERE event_id % 25 = n_nationkey AND event_type <> 'error') c
       LEFT JOIN (SELECT event_type, 'host-' || CAST(user_id % 2 AS VARCHAR) AS host, max(ts) AS max_ts
                  FROM events GROUP BY ALL) m ON c.db_table = m.event_type AND c.host = m.host""",
)
def watermark_lookup(t: Tables):
    hosts = t["nation"].select("n_nationkey", F.concat(F.lit("host-"), F.col("n_regionkey").cast("string")).alias("host"))
    config = (
        t["events"]
        .where("event_type <> 'error'")
        .join(hosts, F.col("event_id") % 25 == F.col("n_nationkey"))
        .select(F.lit(None).cast("string").alias("db_name"), F.col("event_type").alias("db_table"), "host")
        .distinct()
        .withColumn("inc_column", F.lit("ts"))
    )
    return W.lookup_all(config, event_log(t)).select("db_table", "host", "inc_column", "max_ts")


def earlier_load(t: Tables) -> tuple[str, SRC.Source]:
    """Log of a first load that saw half of January."""
    log_path, src = shared_dir(t.spark, "log"), source(t, "events")
    seen = SRC.read_full(t.spark, src, where="ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    W.advance(log_path, W.log_row(seen, src, "ts", NOW))
    return log_path, src


def config_for(t: Tables, src: SRC.Source, column: str):
    return t.spark.createDataFrame([(src.db, src.table, src.host, column)], W.CONFIG_SCHEMA)


@query(
    "scan_incremental",
    "SELECT * FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00')",
)
def scan_incremental(t: Tables):
    log_path, src = earlier_load(t)
    mark = W.lookup(config_for(t, src, "ts"), W.read_log(t.spark, log_path), src)
    return W.read_incremental(SRC.read_full(t.spark, src), mark)


@query("load_full", "SELECT * FROM orders")
def load_full(t: Tables):
    """A full load over an earlier one with other rows."""
    src, root = source(t, "orders"), shared_dir(t.spark, "lake")
    load_table(t.spark, src, root, NOW, where="o_orderstatus = 'F'")
    return t.spark.read.parquet(load_table(t.spark, src, root, LATER).path)


@query(
    "load_text",
    """SELECT doc_id, nullif(replace(replace(text, chr(13), ''), chr(10), ''), '') AS text, nullif(lang, '') AS lang,
              nullif(source, '') AS source, n_chars
       FROM documents""",
)
def load_text(t: Tables):
    load = load_table(t.spark, source(t, "documents"), shared_dir(t.spark, "lake"), NOW, as_text=True)
    return read_text(t.spark, load.path, t["documents"].schema)


DAILY = "SELECT event_id, date_trunc('DAY', ts) AS day, user_id, value"


def two_loads(t: Tables) -> tuple[SRC.Source, str, str]:
    """A table whose days up to the 15th are loaded first, half of the 15th missing, and which is whole at the second load.

    Times are days, so many rows have the boundary's time. Both loads are in one minute.
    """
    events = t["events"].selectExpr("event_id", "date_trunc('DAY', ts) AS day", "user_id", "value")
    events = events.withColumn("day", F.col("day").cast("timestamp_ntz"))
    root, log_path = shared_dir(t.spark, "lake"), shared_dir(t.spark, "log")
    early = "day < TIMESTAMP_NTZ '2024-01-15' OR day = TIMESTAMP_NTZ '2024-01-15' AND event_id % 2 = 0"
    for rows in (events.where(early), events):
        path = shared_dir(t.spark, "source")
        rows.write.parquet(path)
        src = SRC.Source("shop-db", "shop", "daily", format="parquet", location=path)
        config = t.spark.createDataFrame([(src.db, src.table, src.host, "day")], W.CONFIG_SCHEMA)
        load_table(t.spark, src, root, NOW, log_path=log_path, config=config)
    return src, root, log_path


@query(
    "load_incremental",
    f"""WITH e AS ({DAILY} FROM events)
        SELECT *, 1 AS load FROM e WHERE day < TIMESTAMP '2024-01-15' OR day = TIMESTAMP '2024-01-15' AND event_id % 2 = 0
        UNION ALL SELECT *, 2 FROM e WHERE day >= TIMESTAMP '2024-01-15'""",
)
def load_incremental(t: Tables):
    """What lies in the lake: both loads, the boundary's rows in each."""
    _, root, _ = two_loads(t)
    return t.spark.read.parquet(f"{root}/database=shop/table=daily").select("event_id", "day", "user_id", "value", "load")


@query("lake_current", f"{DAILY} FROM events")
def lake_current(t: Tables):
    """Every row once, none missing, though the boundary was read twice."""
    src, root, log_path = two_loads(t)
    return read_current(t.spark, src, root, log_path)


@contextmanager
def session_zone(spark, zone: str):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@query("load_incremental_zoned", "SELECT event_id, ts, user_id, value FROM events")
def load_incremental_zoned(t: Tables):
    """Three loads of instants, each from a session in another zone: every row once."""
    events = t["events"].select("event_id", T.at_utc_clock("ts").alias("ts"), "user_id", "value")
    root, log_path = shared_dir(t.spark, "lake"), shared_dir(t.spark, "log")
    for zone, until in (("Asia/Kolkata", "2024-01-10 04:00:00"), ("UTC", "2024-01-20 22:30:00"), ("America/New_York", "2100-01-01 00:00:00")):
        with session_zone(t.spark, zone):
            path = shared_dir(t.spark, "source")
            events.where(F.col("ts") < T.at_utc_clock(F.lit(until))).write.parquet(path)
            src = SRC.Source("shop-db", "shop", "moments", format="parquet", location=path)
            load_table(t.spark, src, root, NOW, log_path=log_path, config=config_for(t, src, "ts"))
    return read_current(t.spark, src, root, log_path).select("event_id", T.utc_clock("ts").alias("ts"), "user_id", "value")


@query(
    "lake_latest",
    """SELECT event_id, CASE WHEN changed THEN TIMESTAMP '2024-01-12 00:00:00' ELSE ts END AS changed_at, user_id,
              CASE WHEN changed THEN value + 1 ELSE value END AS value
       FROM (SELECT *, event_id % 7 = 0 AND ts < TIMESTAMP '2024-01-10' AND event_id % 10 <> 3 AS changed FROM events)
       WHERE ts < TIMESTAMP '2024-01-15' AND event_id % 11 <> 0 AND (event_id % 10 <> 3 OR ts >= TIMESTAMP '2024-01-08')""",
)
def lake_latest(t: Tables):
    """Rows that changed, came late or were deleted, over three loads, the last with a lookback: the newest version of each."""
    rows = t["events"].selectExpr("event_id", "ts AS changed_at", "user_id", "value", "false AS gone")
    late, at = F.col("event_id") % 10 == 3, lambda text: F.lit(text).cast("timestamp_ntz")
    first = rows.where(~late & (F.col("changed_at") < at("2024-01-10")))
    touched = F.col("event_id") % 7 == 0
    second = first.withColumns(
        {"value": F.when(touched, F.col("value") + 1).otherwise(F.col("value")), "changed_at": F.when(touched, at("2024-01-12")).otherwise(F.col("changed_at"))}
    ).unionAll(rows.where(~late & F.col("changed_at").between(at("2024-01-10"), at("2024-01-14 23:59:59.999999"))))
    removed = F.col("event_id") % 11 == 0
    third = second.unionAll(rows.where(late & (F.col("changed_at") < at("2024-01-15"))))
    third = third.withColumns({"gone": removed, "changed_at": F.when(removed, at("2024-01-15 12:00:00")).otherwise(F.col("changed_at"))})
    root, log_path = shared_dir(t.spark, "lake"), shared_dir(t.spark, "log")
    for state, lookback in ((first, None), (second, None), (third, 8)):
        path = shared_dir(t.spark, "source")
        state.write.parquet(path)
        src = SRC.Source("shop-db", "shop", "versions", format="parquet", location=path)
        load_table(t.spark, src, root, datetime(2024, 1, 16), log_path=log_path, config=config_for(t, src, "changed_at"), lookback_days=lookback)
    return read_latest(t.spark, src, root, log_path, ["event_id"], deleted="gone").drop("gone")


@query(
    "load_rejects",
    """SELECT o_orderkey, CAST(o_custkey AS INT) AS o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS wrong FROM orders
       WHERE o_orderkey % 9 <> 0 AND o_orderstatus <> 'P'
       UNION ALL SELECT o_orderkey, NULL, NULL, 'o_custkey: #' || CAST(o_custkey AS VARCHAR) || ' is no int' FROM orders WHERE o_orderkey % 9 = 0
       UNION ALL SELECT o_orderkey, NULL, NULL, 'o_totalprice: open is no double' FROM orders WHERE o_orderstatus = 'P'""",
)
def load_rejects(t: Tables):
    """Rows with values that fit, and every value that does not."""
    path = shared_dir(t.spark, "source")
    t["orders"].selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 9 = 0 THEN '#' ELSE '' END || CAST(o_custkey AS STRING) AS o_custkey",
        "CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE CAST(o_totalprice AS STRING) END AS o_totalprice",
    ).write.parquet(path)
    src = SRC.Source("shop-db", "shop", "typed", format="parquet", location=path)
    listing = [S.SourceColumn("o_orderkey", "bigint"), S.SourceColumn("o_custkey", "int(11)"), S.SourceColumn("o_totalprice", "decimal(12,2)")]
    load = load_table(t.spark, src, shared_dir(t.spark, "lake"), NOW, listing=listing, reject_limit=10**12)
    wrong = t.spark.read.parquet(load.rejects).select("o_orderkey", F.explode(S.REJECTS).alias("r"))
    text = F.concat_ws("", "r.column", F.lit(": "), "r.text", F.lit(" is "), "r.reason")
    kept = t.spark.read.parquet(load.path).select("o_orderkey", "o_custkey", "o_totalprice", F.lit(None).cast("string").alias("wrong"))
    return kept.unionByName(wrong.select("o_orderkey", text.alias("wrong")), allowMissingColumns=True)


@query(
    "schema_evolve_load",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
       FROM orders""",
)
def schema_evolve_load(t: Tables):
    """The first load makes the table with three columns; the second one adds the source's new ones."""
    src, root, table = source(t, "orders"), shared_dir(t.spark, "lake"), new_table("orders")
    listing = S.read_listing(t.spark, src)
    path = load_table(t.spark, src, root, NOW, listing=listing, columns=[c.name for c in listing[:3]], lake_table=table).path
    t.spark.catalog.createTable(table, path=path, source="parquet")
    load_table(t.spark, src, root, LATER, listing=listing, lake_table=table)
    return t.spark.table(table)


@query("lookback_window", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00' - INTERVAL 10 DAY")
def lookback_window(t: Tables):
    rows = SRC.read_full(t.spark, source(t, "events"))
    return W.read_incremental(rows, W.Watermark("ts"), datetime(2024, 1, 29, 12), lookback_days=10)


@query(
    "watermark_advance",
    """SELECT 'shop' AS db_name, 'events' AS db_table, 'shop-db' AS host, 'ts' AS inc_column, max(ts) AS max_ts,
              CAST(NULL AS BIGINT) AS max_num, TIMESTAMP '2024-01-05 09:30:00' AS logged_at
       FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
       UNION ALL SELECT 'shop', 'events', 'shop-db', 'ts', max(ts), NULL, TIMESTAMP '2024-01-06 09:30:00' FROM events
       UNION ALL SELECT 'shop', 'lineitem', 'shop-db', 'l_orderkey', NULL, max(l_orderkey), TIMESTAMP '2024-01-06 09:30:00'
       FROM lineitem""",
)
def watermark_advance(t: Tables):
    log_path, src = earlier_load(t)
    mark = W.lookup(config_for(t, src, "ts"), W.read_log(t.spark, log_path), src)
    W.advance(log_path, W.log_row(W.read_incremental(t["events"], mark), src, "ts", LATER))
    W.advance(log_path, W.log_row(t["lineitem"], source(t, "lineitem"), "l_orderkey", LATER))
    nothing_new = t["events"].where("ts > TIMESTAMP_NTZ '2100-01-01 00:00:00'")
    W.advance(log_path, W.log_row(nothing_new, src, "ts", LATER))
    return W.read_log(t.spark, log_path).select(
        "db_name", "db_table", "host", "inc_column", "max_ts", "max_num", "logged_at"
    )


@query("scan_catalog", "SELECT * FROM customer")
def scan_catalog(t: Tables):
    table = new_table("customer")
    t.spark.catalog.createTable(table, path=t.path("customer"), source="parquet")
    return SRC.read_full(t.spark, SRC.Source("lake", "default", table, format="catalog"))


@query(
    "schema_diff",
    """SELECT CAST(position AS INT) AS position, name, status, lake_type, status = 'added' AS is_suspect,
              CASE WHEN status = 'added' THEN n END AS rows_to_backfill
       FROM (VALUES (1, 'l_orderkey', 'same', 'bigint'), (2, 'l_partkey', 'same', 'bigint'),
                    (3, 'l_suppkey', 'same', 'bigint'), (4, 'l_linenumber', 'same', 'int'),
                    (5, 'l_quantity', 'same', 'double'), (6, 'l_extendedprice', 'same', 'double'),
                    (7, 'l_discount', 'same', 'double'), (8, 'l_tax', 'same', 'double'),
                    (9, 'l_returnflag', 'added', 'string'), (10, 'l_linestatus', 'added', 'string'),
                    (11, 'l_shipdate', 'added', 'string')) AS v(position, name, status, lake_type)
       LEFT JOIN (SELECT 'l_returnflag' AS name, count(l_returnflag) AS n FROM lineitem
                  UNION ALL SELECT 'l_linestatus', count(l_linestatus) FROM lineitem
                  UNION ALL SELECT 'l_shipdate', count(l_shipdate) FROM lineitem) USING (name)""",
)
def schema_diff(t: Tables):
    """A source that gained its last three columns, and the values old files lack."""
    rows = t["lineitem"]
    old = type(rows.schema)(rows.schema.fields[:8])
    listing = [S.SourceColumn(c.name, c.type, "0" if i >= 8 else None) for i, c in enumerate(S.listing_of(rows.schema))]
    diff = S.schema_diff(t.spark, listing, old)
    added = [f.name for f in rows.schema.fields[8:]]
    return diff.join(S.nulls_after_evolution(rows, added), "name", "left").select(
        "position", "name", "status", "lake_type", "is_suspect", "rows_to_backfill"
    )


@query(
    "schema_evolve",
    """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS o_totalprice,
              CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS VARCHAR) END AS o_orderdate
       FROM orders""",
)
def schema_evolve(t: Tables):
    """Old files lack two columns; the table gains them; new files have them."""
    path, table, rows = shared_dir(t.spark, "evolve"), new_table("orders"), t["orders"]
    old = ["o_orderkey", "o_custkey", "o_orderstatus"]
    rows.where("o_orderstatus <> 'P'").select(*old).write.parquet(path)
    t.spark.catalog.createTable(table, path=path, source="parquet")
    listing = [c for c in S.listing_of(rows.schema) if c.name != "o_orderpriority"]
    S.evolve(t.spark, table, listing)
    S.cast_to_lake(rows.where("o_orderstatus = 'P'"), listing).write.mode("append").parquet(path)
    t.spark.catalog.refreshTable(table)
    return t.spark.table(table)


@query(
    "type_map",
    """SELECT o_orderkey, CAST(o_custkey AS INT) AS o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
              CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
       FROM orders""",
)
def type_map(t: Tables):
    types = ["bigint(20)", "mediumint(8) unsigned", "char(1)", "decimal(15,2)", "datetime", "enum('1-URGENT','5-LOW')"]
    listing = [S.SourceColumn(n, k) for n, k in zip(t["orders"].columns, types)]
    return S.cast_to_lake(t["orders"], listing)


@query(
    "ctrl_a_roundtrip",
    """SELECT doc_id, nullif(replace(replace(text, chr(13), ''), chr(10), ''), '') AS text, nullif(lang, '') AS lang,
              nullif(source, '') AS source, n_chars
       FROM documents""",
)
def ctrl_a_roundtrip(t: Tables):
    path = shared_dir(t.spark, "text")
    write_text(t["documents"], path)
    return read_text(t.spark, path, t["documents"].schema)


@query(
    "ctas_parquet",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_rows, sum(l_quantity) AS quantity, max(l_shipdate) AS last_ship
       FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def ctas_parquet(t: Tables):
    rows = t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("quantity"), F.max("l_shipdate").alias("last_ship")
    )
    return K.materialize(rows, shared_dir(t.spark, "ctas"), new_table("ctas"))


@query("overwrite_rebuild", "SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_returnflag <> 'N'")
def overwrite_rebuild(t: Tables):
    path, table = shared_dir(t.spark, "rebuild"), new_table("rebuild")
    K.materialize(t["lineitem"].select("l_partkey"), path, table)
    return K.materialize(t["lineitem"].where("l_returnflag <> 'N'").select("l_orderkey", "l_shipdate"), path, table)


@query(
    "snapshot_write",
    """SELECT o_orderkey, o_orderstatus, '202401050930' AS dt FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_orderstatus, '202401060930' FROM orders""",
)
def snapshot_write(t: Tables):
    root, rows = shared_dir(t.spark, "snapshots"), t["orders"].select("o_orderkey", "o_orderstatus")
    K.write_snapshot(rows.where("o_orderstatus = 'F'"), root, NOW)
    K.write_snapshot(rows, root, LATER)
    return K.read_snapshots(t.spark, root)


@query("snapshot_publish", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def snapshot_publish(t: Tables):
    """A reader of the table sees the newer snapshot, and its new column, after the switch."""
    root, table = shared_dir(t.spark, "published"), new_table("published")
    rows = t["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice")
    K.publish(t.spark, table, K.write_snapshot(rows.where("o_orderstatus = 'F'").drop("o_totalprice"), root, NOW))
    K.publish(t.spark, table, K.write_snapshot(rows, root, LATER))
    return t.spark.table(table)


@query(
    "lake_path",
    """SELECT c_custkey, 's3://lake' || CASE WHEN host LIKE '%north%' THEN '' ELSE '/EU' END || '/database=shop/table='
              || lower(c_mktsegment) || '/' || CASE WHEN c_acctbal > 0 THEN 'dt=20240105/' ELSE '' END AS path
       FROM (SELECT *, CASE WHEN c_nationkey < 10 THEN 'db-north-1' ELSE 'db-south-1' END AS host FROM customer)""",
)
def lake_path(t: Tables):
    host = F.when(F.col("c_nationkey") < 10, "db-north-1").otherwise("db-south-1")
    spec = F.when(F.col("c_acctbal") > 0, F.lit("dt=20240105/"))
    path = K.lake_path("s3://lake/", host, F.lit("shop"), F.lower("c_mktsegment"), spec, [("north", ""), ("south", "EU")])
    return t["customer"].select("c_custkey", path.alias("path"))


@query(
    "partition_replace",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
              o_orderstatus FROM orders WHERE o_orderstatus <> 'F' OR o_orderpriority = '1-URGENT'""",
)
def partition_replace(t: Tables):
    root, rows = shared_dir(t.spark, "partitions"), t["orders"].select("o_orderkey", "o_totalprice", "o_orderstatus")
    rows.write.partitionBy("o_orderstatus").parquet(root)
    urgent = t["orders"].where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    K.replace_partition(urgent.select("o_orderkey", F.expr("o_totalprice + 1 AS o_totalprice")), root, {"o_orderstatus": "F"})
    K.replace_partition(urgent.where("false").select("o_orderkey", "o_totalprice"), root, {"o_orderstatus": "O"})
    return t.spark.read.schema(rows.schema).parquet(root)


@query(
    "step_audit",
    """SELECT 'orders' AS step, count(*) AS n_rows FROM orders
       UNION ALL SELECT 'urgent', count(*) FROM orders WHERE o_orderpriority = '1-URGENT'
       UNION ALL SELECT 'lines', count(*) FROM lineitem""",
)
def step_audit(t: Tables):
    urgent = K.materialize(t["orders"].where("o_orderpriority = '1-URGENT'"), shared_dir(t.spark, "audit"))
    return K.step_audit({"orders": t["orders"], "urgent": urgent, "lines": t["lineitem"]})
