"""Derived inputs, their volume and the shuffles left behind."""

import os
import time

import pytest
from pyspark.sql import functions as F

from orderloom.operators.sinks import materialize
from orderloom.session import shared_dir, shuffles_dropped
from parity.inputs import EARLY, INPUTS, Tables, placeholders
from parity.relational_queries import line_fact
from parity.scalar_queries import pivot


@pytest.fixture
def odd(spark, sf_dir, tmp_path):
    """Test tables with rows twice and rows without keys or flags."""
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "supplier"):
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        again = df.where(F.abs(F.xxhash64(df.columns[0])) % 3 == 0)
        if name in ("orders", "lineitem"):
            key = df.columns[0]
            blank = df.where(F.col(key) % 7 == 0).withColumn(key, F.lit(None).cast(df.schema[key].dataType))
            again = again.union(blank)
        if name == "lineitem":
            again = again.union(df.where("l_partkey % 5 = 0").withColumns({"l_linestatus": F.lit(None).cast("string"), "l_returnflag": F.lit("R")}))
        df.union(again).write.parquet(f"{tmp_path}/{name}.parquet")
    return Tables(spark, str(tmp_path))


@pytest.mark.parametrize("name", sorted(EARLY))
def test_reduced_inputs_have_the_rows_of_their_sql(odd, rows, name):
    theirs = odd.spark.sql(INPUTS[name], **{n: odd[n] for n in placeholders(INPUTS[name])})
    assert odd[name].dtypes == theirs.dtypes
    assert rows(odd[name]) == rows(theirs)


@pytest.mark.parametrize("name", ["sales_order_shipment", "picking_state_transition_log"])
def test_lines_are_reduced_before_they_are_joined(odd, name):
    """Of the lines only the order and its halves are shuffled, once: neither their texts nor the finished rows."""
    sql, limit = EARLY[name], "spark.sql.autoBroadcastJoinThreshold"
    before = odd.spark.conf.get(limit)
    odd.spark.conf.set(limit, "-1")
    text = odd.spark.sql(sql, **{n: odd[n] for n in placeholders(sql)})._jdf.queryExecution().executedPlan().toString()
    odd.spark.conf.set(limit, before)
    assert "bit_or" in text and text.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(shipment_id" not in text


def test_queries_on_items_store_the_columns_they_read(spark, sf_dir):
    for made, kept in ((pivot, 2), (line_fact, 3)):
        t = Tables(spark, sf_dir + "/")
        t._staged = {}
        made(t)
        stored = [k[3:] for k in t._staged if k[2] == "sales_order_item"]
        assert [len(c) for c in stored] == [kept]


def shuffle_files(folder) -> int:
    return sum(f.startswith("shuffle_") for _, _, names in os.walk(folder) for f in names)


def test_a_stored_step_leaves_no_shuffle_files(spark):
    folder = os.path.dirname(spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()[0].getPath())
    grouped = spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("n"))
    before = shuffle_files(folder)
    stored = materialize(grouped, shared_dir(spark, "grouped"))
    with shuffles_dropped(spark):
        grouped.write.parquet(shared_dir(spark, "grouped"))
    for _ in range(100):  # the files go in the background
        if (left := shuffle_files(folder)) <= before:
            break
        time.sleep(0.1)
    assert left <= before
    assert stored.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
