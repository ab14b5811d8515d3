"""The plans hold at scale: pruned scans, no cross joins, hot keys split, nothing per row in Python."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parity.registry import QUERIES
from orderloom.functions import temporal as T
from orderloom.operators import joins as J
from orderloom.operators import orders as O
from orderloom.operators.history import item_history
from orderloom.plans.item_fact import LOOKUP_KEYS, item_fact, joined_rows, orders_with_lookups
from orderloom.session import configure, shared_dir
from orderloom.sources import tables as SRC
from orderloom.streaming import watermark as W
from parity.inputs import Tables
from parity.relational_queries import line_fact
from parity.scalar_queries import pivot


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df._jdf.collectToPython()
    return plan(df)


@pytest.fixture
def shuffled(spark):
    """As on large inputs: no side is below the broadcast threshold."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k in keys:
        spark.conf.unset(k)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas", "BatchEvalPython"):
        assert bad not in text


@pytest.mark.parametrize("name", ["item_fact", "order_flags", "items_with_flags", "order_item_counts", "anti_join_not_in", "join_snowflake"])
def test_no_broadcast_is_forced(shuffled, sf_dir, name):
    text = plan(entry.queries()[name](shuffled, sf_dir))
    assert "BroadcastHashJoin" not in text and "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    src = SRC.Source("h", "d", "lineitem", format="parquet", location=f"{sf_dir}/lineitem.parquet")
    text = plan(SRC.read_full(spark, src, "l_returnflag = 'R'", ["l_orderkey"]))
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(W.read_incremental(events, W.Watermark("event_id", 40)))
    assert "GreaterThanOrEqual(event_id,40)" in text


def test_counts_need_no_expand(spark, sf_dir):
    t = Tables(spark, sf_dir)
    assert "Expand" not in plan(O.order_item_counts(line_fact(t)))


def test_history_is_aggregated_before_it_is_joined(shuffled, sf_dir):
    text = plan(pivot(Tables(shuffled, sf_dir)))
    history = text[text.index("fk_sales_order_item_status"):]
    assert "Aggregate" in text and "request_type" in history
    # one shuffle for the history, two for the owners' join, one to place the owners
    assert text.count("Exchange hashpartitioning") == 4


def test_fact_shuffles_items_for_four_keys_only(shuffled, sf_dir):
    t = Tables(shuffled, sf_dir)
    history = pivot(t).withColumns({"is_invoiced_flag": F.lit("0"), "is_defective_flag": F.lit("0")})
    path = shared_dir(shuffled, "history")
    history.write.parquet(path)
    text = plan(item_fact(shuffled.read.parquet(path), t, datetime(2024, 1, 5)))
    wide = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    items = [line.split("hashpartitioning(")[1].split("#")[0] for line in wide]
    assert items.count("p_sku") + items.count("h_sku") == 2, "product lookups are shuffled once each"
    assert items.count("sku") == 1, "both product lookups share one shuffle of the items"


HOT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def sensitive(shuffled):
    """Thresholds at which test data counts as skewed."""
    before = {k: shuffled.conf.get(k) for k in HOT}
    for k, v in HOT.items():
        shuffled.conf.set(k, v)
    yield shuffled
    for k, v in before.items():
        shuffled.conf.set(k, v)


def hot_rows(spark):
    """A third of the rows have key 0."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(60000, numPartitions=8).select(hot.alias("k"), F.col("id").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_a_hot_lookup_key_is_split(sensitive):
    left, right = hot_rows(sensitive), sensitive.range(60000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = J.lookup(J.lookup(left, right, "k"), right.withColumnRenamed("w", "x"), "k")
    assert "skew=true" in final_plan(joined)
    got = joined.agg(F.count("*"), F.sum("w"), F.sum("x"), F.sum("v")).first()
    keys = [0 if i % 3 == 0 else i for i in range(60000)]
    assert tuple(got) == (60000, 2 * sum(keys), 2 * sum(keys), sum(range(60000)))


def test_a_hot_excluded_or_broadcast_key_is_split(sensitive):
    left = hot_rows(sensitive)
    kept = J.exclude_not_in(left, "k", sensitive.range(1, 60000, 2).select(F.col("id").alias("k")))
    assert "skew=true" in final_plan(kept)
    assert kept.count() == sum(1 for i in range(60000) if i % 3 == 0 or i % 2 == 0)
    spread = J.broadcast_by_key(left, "k", {"n": F.count(F.lit(1))})
    assert "skew=true" in final_plan(spread)
    assert spread.where("k = 0").agg(F.count("*"), F.max("n")).first() == (20000, 20000)


def test_a_hot_order_meets_its_flags_and_counts_in_parts(sensitive):
    path = shared_dir(sensitive, "hot")
    hot_rows(sensitive).select(
        F.col("k").alias("order_nr"), "v", "pad", F.lit(1).alias("is_relevant"),
        F.when(F.col("v") % 2 == 0, F.lit(datetime(2024, 1, 1))).cast(T.WALL_CLOCK).alias("invoice_dt"),
    ).write.parquet(path)
    pivot = sensitive.read.parquet(path)
    excluded = pivot.where("order_nr > 59000").select("order_nr").distinct()
    flagged = O.items_with_flags(pivot, O.order_flags(pivot, excluded))
    assert "skew=true" in final_plan(flagged)
    assert flagged.where("order_nr = 0 AND is_invoiced_flag = '1' AND is_defective_flag = '1'").count() == 20000
    kept = J.exclude_not_in(pivot, "order_nr", excluded)
    assert "skew=true" in final_plan(kept)
    assert kept.count() == 60000 - pivot.where("order_nr > 59000").count()
    counts = pivot.groupBy("order_nr").agg(*[F.count("*").alias(c) for c in O.COUNTS])
    joined = O.order_metrics_joined(pivot, counts)
    assert "skew=true" in final_plan(joined)
    assert joined.where("order_nr = 0 AND items_ordered = 20000").count() == 20000


def test_a_hot_order_is_counted_in_parts(sensitive):
    """Items of one order are spread by identity before they are counted per order."""
    when = F.lit(datetime(2024, 1, 1)).cast(T.WALL_CLOCK)
    fact = hot_rows(sensitive).select(
        F.col("k").alias("order_nr"), F.col("pad").alias("sku"), F.col("v").alias("id_sales_order_item"),
        *[F.lit(0).alias(c) for c in ("is_weighted", "is_test", "is_test_store", "is_Mswipe")], F.lit(1).alias("is_relevant"),
        when.alias("invoice_dt"), F.lit(None).cast(T.WALL_CLOCK).alias("cancelled_dt"), F.lit("na").alias("cancelled_by"),
    )
    counts = O.order_item_counts(fact)
    assert "hashpartitioning(order_nr" in plan(counts) and "identity" in plan(counts).split("hashpartitioning(order_nr")[2]
    assert counts.where("order_nr = 0").first().items_invoiced == 20000


def test_settings_respect_the_cluster(spark):
    configure(spark, input_bytes=10 * 2**30)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "80"
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    assert shared_dir(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))


def test_a_hot_order_reaches_the_counted_fact_in_parts(sensitive, sf_dir):
    """A third of all items belong to one order; the counts met the orders before these fan out."""
    t = Tables(sensitive, sf_dir)
    tables = {n: t[n] for n in [*LOOKUP_KEYS, "sales_order_item_status_history"]}
    order = tables["sales_order"].join(tables["sales_order_shipment"], "order_nr").agg(F.min("id_sales_order")).first()[0]
    owner = F.when(F.col("id_sales_order_item") % 3 == 0, F.lit(order)).otherwise(F.col("fk_sales_order")).alias("fk_sales_order")
    path, items = shared_dir(sensitive, "hot-items"), tables["sales_order_item"]
    items.select(*[owner if c == "fk_sales_order" else c for c in items.columns]).write.parquet(path)
    tables["sales_order_item"] = sensitive.read.parquet(path)
    pivot = item_history(tables["sales_order_item_status_history"], tables["sales_order_item"], tables["sales_order"])
    rows = pivot.select("fk_sales_order_item", "order_nr", "is_relevant")
    counts = pivot.groupBy(F.col("order_nr").try_cast("bigint").alias("order_nr")).agg(F.count("*").alias("items_ordered"))
    joined = joined_rows(rows, tables, orders_with_lookups(tables, counts)).select("i_id", "o_id", "items_ordered")
    assert "skew=true" in final_plan(joined)
    hot = joined.where(F.col("o_id") == order)
    assert hot.select("items_ordered").distinct().count() == 1
