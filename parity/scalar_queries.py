"""Projections, predicates, scalar functions and rules on columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import rules as R
from orderloom.functions import temporal as T
from orderloom.functions import text as X
from orderloom.operators.history import item_history

from .inputs import Tables
from .registry import query

NOW = datetime(2024, 1, 5, 9, 30)

# keys as a float-typed text export leaves them: 12.0, 12.000, blank, NULL, words
DIRTY_KEY = """CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_custkey AS STRING) || '.0'
    WHEN '2-HIGH' THEN CAST(o_custkey AS STRING) || '.000' WHEN '3-MEDIUM' THEN ''
    WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'k' || CAST(o_custkey AS STRING) || '.05' END"""


@query("star_plus", "SELECT *, l_extendedprice * (1 - l_discount) AS revenue, l_quantity > 25 AS is_bulk FROM lineitem")
def star_plus(t: Tables):
    return t["lineitem"].select(
        "*", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), (F.col("l_quantity") > 25).alias("is_bulk")
    )


@query(
    "case_rules",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush'
              WHEN o_orderstatus IS NOT NULL AND o_totalprice < 50000 THEN 'small' ELSE 'plain' END AS kind
       FROM orders""",
)
def case_rules(t: Tables):
    price = F.col("o_totalprice")
    kind = X.cases(
        (price > 400000, "large"),
        (X.one_of("o_orderpriority", ["1-URGENT", "2-HIGH"]), "rush"),
        (F.col("o_orderstatus").isNotNull() & (price < 50000), "small"),
        otherwise="plain",
    )
    return t["orders"].select("o_orderkey", kind.alias("kind"))


@query(
    "in_list",
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity FROM lineitem
       WHERE l_returnflag IN ('R', 'A') AND l_linenumber NOT IN (2, 4, 6) AND l_linestatus = 'F'""",
)
def in_list(t: Tables):
    return (
        t["lineitem"]
        .where(X.one_of("l_returnflag", ["R", "A"]) & ~X.one_of("l_linenumber", [2, 4, 6]) & (F.col("l_linestatus") == "F"))
        .select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    )


@query(
    "like_ci",
    """SELECT p_partkey, p_name, p_type, lower(p_name) LIKE '%ring%' AS has_ring FROM part
       WHERE lower(p_type) LIKE '%o%' OR lower(p_name) LIKE '%ring%'""",
)
def like_ci(t: Tables):
    return (
        t["part"]
        .where(X.contains_ci("p_type", "o") | X.contains_ci("p_name", "RING"))
        .select("p_partkey", "p_name", "p_type", X.contains_ci("p_name", "ring").alias("has_ring"))
    )


@query(
    "normalized_match",
    """SELECT o_orderkey, lower(replace(o_orderpriority, ' ', '')) AS squeezed,
              lower(replace(o_orderpriority, ' ', '')) IN ('4-notspecified', '5-low') AS is_slow
       FROM orders""",
)
def normalized_match(t: Tables):
    key = X.squeezed("o_orderpriority")
    return t["orders"].select(
        "o_orderkey", key.alias("squeezed"), X.one_of(key, ["4-notspecified", "5-low"]).alias("is_slow")
    )


@query(
    "clean_key",
    rf"""SELECT o_orderkey, {DIRTY_KEY} AS dirty, regexp_replace({DIRTY_KEY}, '\.0+$', '', 'g') AS cleaned,
                replace({DIRTY_KEY}, '.0', '') AS squashed
         FROM orders""",
)
def clean_key(t: Tables):
    return t["orders"].select("o_orderkey", F.expr(DIRTY_KEY).alias("dirty")).select(
        "o_orderkey",
        "dirty",
        X.clean_key("dirty").alias("cleaned"),
        F.replace("dirty", F.lit(".0"), F.lit("")).alias("squashed"),
    )


@query(
    "clean_key_filter",
    rf"""SELECT o_orderkey, TRY_CAST(regexp_replace({DIRTY_KEY}, '\.0+$', '', 'g') AS INT) AS customer_key FROM orders
         WHERE TRY_CAST(regexp_replace({DIRTY_KEY}, '\.0+$', '', 'g') AS INT) > 0""",
)
def clean_key_filter(t: Tables):
    return (
        t["orders"]
        .select("o_orderkey", F.expr(DIRTY_KEY).alias("dirty"))
        .where(X.positive_key("dirty"))
        .select("o_orderkey", X.lenient(X.clean_key("dirty"), "int").alias("customer_key"))
    )


@query(
    "try_cast_all",
    """SELECT event_id, TRY_CAST(event_type || '1' AS BIGINT) AS no_number,
              TRY_CAST(CAST(user_id AS VARCHAR) AS BIGINT) AS as_bigint,
              TRY_CAST(CASE WHEN event_type = 'click' THEN event_type ELSE CAST(user_id AS VARCHAR) END AS INT) AS as_int,
              TRY_CAST(CASE WHEN event_type = 'view' THEN event_type ELSE CAST(user_id AS VARCHAR) || '.25' END AS DOUBLE)
                  AS as_double,
              TRY_CAST(CASE WHEN event_type = 'error' THEN event_type ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS as_time
       FROM events""",
)
def try_cast_all(t: Tables):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    return t["events"].select(
        "event_id",
        X.lenient(F.concat(kind, F.lit("1")), "bigint").alias("no_number"),
        X.lenient(user, "bigint").alias("as_bigint"),
        X.lenient(F.when(kind == "click", kind).otherwise(user), "int").alias("as_int"),
        X.lenient(F.when(kind == "view", kind).otherwise(F.concat(user, F.lit(".25"))), "double").alias("as_double"),
        T.lenient_time(F.when(kind == "error", kind).otherwise(F.col("ts").cast("string"))).alias("as_time"),
    )


@query(
    "strict_cast",
    """SELECT o_orderkey, CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) AS as_bigint,
              CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS as_time, CAST(o_orderdate AS DATE) AS as_date,
              CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority
       FROM orders""",
)
def strict_cast(t: Tables):
    return t["orders"].select(
        "o_orderkey",
        F.col("o_custkey").cast("string").cast("bigint").alias("as_bigint"),
        T.strict_time(F.col("o_orderdate").cast("string")).alias("as_time"),
        F.to_date("o_orderdate").alias("as_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )


@query(
    "coalesce_default",
    """SELECT p_partkey, coalesce(CASE WHEN p_size > 10 THEN p_brand END, 'Others') AS brand,
              coalesce(CASE WHEN p_type <> 'PROMO' THEN p_type END, 'Others') AS category
       FROM part""",
)
def coalesce_default(t: Tables):
    return t["part"].select(
        "p_partkey",
        X.or_default(F.when(F.col("p_size") > 10, F.col("p_brand"))).alias("brand"),
        X.or_default(F.when(F.col("p_type") != "PROMO", F.col("p_type"))).alias("category"),
    )


@query(
    "prefix_before",
    # how the catalogue's texts are made: the part's number, then a separator and its brand unless its size is 1
    """SELECT 'SKU' || CAST(p_partkey AS VARCHAR) AS sku, CAST(p_partkey AS VARCHAR) AS article,
              CAST(CASE p_size WHEN 1 THEN 0 ELSE length(CAST(p_partkey AS VARCHAR)) + 1 END AS INT) AS separator_at
       FROM part""",
)
def prefix_before(t: Tables):
    return t["catalog_simple"].select(
        "sku",
        X.prefix_before("sku_supplier_simple", "_").alias("article"),
        F.instr("sku_supplier_simple", "_").alias("separator_at"),
    )


@query(
    "concat_null",
    """SELECT id, first_name || ' ' || last_name AS full_name FROM picker_app_user""",
)
def concat_null(t: Tables):
    return t["picker_app_user"].select("id", F.concat("first_name", F.lit(" "), "last_name").alias("full_name"))


ORDER_TIMES = """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
           CASE WHEN o_orderstatus <> 'P' THEN '0 days 0' || substr(o_orderpriority, 1, 1) || ':30:00' END AS start_time,
           '0 days 1' || substr(o_orderpriority, 1, 1) || ':15:20' AS end_time,
           o_orderdate + INTERVAL '1' HOUR * CAST(o_custkey % 7 AS INT) + INTERVAL '1' SECOND * CAST(o_custkey % 3601 AS INT)
               AS created
    FROM {orders}"""


@query(
    "slot_times",
    f"""SELECT o_orderkey, 'Slot ' || CAST(o_orderkey AS VARCHAR) || ' ' || substr(start_time, 8, 5) || '-' || substr(end_time, 8, 5)
               AS delivery_slot,
               CAST(CAST(day AS VARCHAR) || ' ' || substr(start_time, 8, 8) AS TIMESTAMP) AS slot_start,
               CAST(CAST(day AS VARCHAR) || ' ' || substr(end_time, 8, 8) AS TIMESTAMP) AS slot_end,
               CAST(CAST(CAST(day AS VARCHAR) || ' ' || substr(end_time, 8, 8) AS TIMESTAMP) AS DATE) AS slot_day
        FROM ({ORDER_TIMES.format(orders="orders")})""",
)
def slot_times(t: Tables):
    times = t.spark.sql(ORDER_TIMES, orders=t["orders"])
    return times.select(
        "o_orderkey",
        T.slot_label("o_orderkey", "start_time", "end_time").alias("delivery_slot"),
        T.at_clock("day", "start_time").alias("slot_start"),
        T.at_clock("day", "end_time").alias("slot_end"),
        F.to_date(T.at_clock("day", "end_time")).alias("slot_day"),
    )


@query(
    "pick_deadline",
    f"""SELECT o_orderkey, created, slot_start, date_sub('minute', created, slot_start) AS lead_minutes,
               CASE WHEN date_sub('minute', created, slot_start) < 30 THEN created + INTERVAL 30 MINUTE ELSE slot_start END
                   AS to_be_picked_by
        FROM (SELECT *, CAST(CAST(day AS VARCHAR) || ' ' || substr(start_time, 8, 8) AS TIMESTAMP) AS slot_start
              FROM ({ORDER_TIMES.format(orders="orders")}))""",
)
def pick_deadline(t: Tables):
    times = t.spark.sql(ORDER_TIMES, orders=t["orders"]).withColumn("slot_start", T.at_clock("day", "start_time"))
    return times.select(
        "o_orderkey",
        "created",
        "slot_start",
        T.elapsed_minutes("created", "slot_start").alias("lead_minutes"),
        T.pick_deadline("created", "slot_start").alias("to_be_picked_by"),
    )


@query(
    "calendar_labels",
    """SELECT o_orderkey, 'wk-' || strftime(o_orderdate, '%V') || ':' || strftime(o_orderdate, '%Y') AS expected_week,
              strftime(o_orderdate, '%m-%Y') AS expected_month_yr, strftime(o_orderdate, '%G') AS expected_yr,
              CAST(strftime(o_orderdate, '%G%V') AS INT) AS expected_yr_wk,
              CAST(strftime(o_orderdate, '%G%m') AS INT) AS expected_yr_month,
              'wk-' || strftime(o_orderdate, '%V') || ':' || strftime(o_orderdate, '%Y') AS order_week,
              strftime(o_orderdate, '%m-%Y') AS order_month_yr, strftime(o_orderdate, '%m') AS order_month,
              CAST(year(o_orderdate) AS INT) AS order_yr
       FROM orders""",
)
def calendar_labels(t: Tables):
    labels = T.iso_labels("o_orderdate", "expected") | T.calendar_labels("o_orderdate", "order")
    return t["orders"].select("o_orderkey", *[c.alias(n) for n, c in labels.items()])


@query(
    "local_time_label",
    """SELECT event_id, strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S') AS local_time FROM events""",
)
def local_time_label(t: Tables):
    return t["events"].select("event_id", T.local_time_label("ts", "Asia/Kolkata").alias("local_time"))


@query(
    "earliest_non_null",
    "SELECT fk_sales_order_item, list_min([bob_delivery_dt, export_dt]) AS delivery_dt FROM item_pivot",
)
def earliest_non_null(t: Tables):
    return pivot(t).select("fk_sales_order_item", T.earliest("bob_delivery_dt", "export_dt").alias("delivery_dt"))


def pivot(t: Tables, items: DataFrame | None = None, orders: DataFrame | None = None):
    if items is None:
        items = t.narrow("sales_order_item", "id_sales_order_item", "fk_sales_order")
    if orders is None:
        orders = t.narrow("sales_order", "id_sales_order", "order_nr")
    return item_history(t["sales_order_item_status_history"], items, orders)


@query(
    "code_label",
    """SELECT shipment_id, CASE TRY_CAST(fk_sales_order_pickup_method AS INT) WHEN 1 THEN 'in_store_pickup'
              WHEN 2 THEN 'home_delivery' WHEN 3 THEN 'express_delivery' ELSE 'unknown' END AS delivery_type
       FROM sales_order_shipment""",
)
def code_label(t: Tables):
    return t["sales_order_shipment"].select(
        "shipment_id", R.delivery_type("fk_sales_order_pickup_method").alias("delivery_type")
    )


@query(
    "strip_newlines",
    """SELECT doc_id, replace(replace(text, chr(13), ''), chr(10), '') AS text, lang, source, n_chars FROM documents""",
)
def strip_newlines(t: Tables):
    return X.strip_newlines(t["documents"])


@query(
    "is_relevant",
    "SELECT order_nr, fk_sales_order_item, is_relevant FROM relevant_pivot",
)
def is_relevant(t: Tables):
    return pivot(t).select("order_nr", "fk_sales_order_item", "is_relevant")


@query(
    "cancelled_by",
    "SELECT order_nr, fk_sales_order_item, cancelled_by FROM who_cancelled",
)
def cancelled_by(t: Tables):
    who = R.cancelled_by("is_relevant", "cancelled_dt", "invoice_dt", "cancelled_req_type", "cancelled_reason")
    return pivot(t).select("order_nr", "fk_sales_order_item", who.alias("cancelled_by"))


@query(
    "fact_flags",
    # how the rows are made: every third part has unit 1, customers with 99 in their name are called test users, urgent orders
    # are paid at the terminal, nation 9 has the test store, parts of size 2 are membership cards (small parts have no entry)
    """SELECT o.order_nr, l.item AS id_sales_order_item, CAST(p_partkey % 3 = 0 AS INT) AS is_weighted,
              CAST(contains(c_name, '99') AS INT) AS is_test, CAST(o_orderpriority = '1-URGENT' AS INT) AS "is_Mswipe",
              CAST(c_nationkey = 9 AS INT) AS is_test_store, CAST(p_size = 2 AND p_type <> 'SMALL' AS INT) AS is_membership_category
       FROM (SELECT l_orderkey, l_orderkey * 10 + l_linenumber AS item, max(l_partkey) AS p_partkey FROM lineitem GROUP BY ALL) l
       JOIN part USING (p_partkey) JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN sales_order o ON id_sales_order = o_orderkey""",
)
def fact_flags(t: Tables):
    simple = t["catalog_simple"].select("sku", F.col("fk_catalog_config").alias("id_catalog_config"))
    config = t["catalog_config"].select("id_catalog_config", F.col("fk_catalog_attribute_option_global_uom_type").alias("uom"))
    hierarchy = t["product_hierarchy"].select(F.col("CAT_SKU").alias("sku"), "sku_supplier_simple")
    store = t["store_master"].select(F.col("id_store").cast("int").alias("store_key"), "store_code")
    order = t["sales_order"].withColumn("store_key", X.blank_as_zero_key("store_id")).join(store, "store_key", "left")
    flags = R.fact_flags(
        "uom", "customer_first_name", "customer_last_name", "payment_method", "store_code", "sku_supplier_simple"
    )
    return (
        t["sales_order_item"]
        .join(simple.join(config, "id_catalog_config", "left"), "sku", "left")
        .join(hierarchy, "sku", "left")
        .join(order, F.col("fk_sales_order") == F.col("id_sales_order"))
        .select("order_nr", "id_sales_order_item", *[c.alias(n) for n, c in flags.items()])
    )
