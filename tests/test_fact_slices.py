"""The fact of large tables is made slice by slice, and of columns that are made before the items meet their orders."""

import os
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom.functions import temporal as T
from orderloom.operators import joins as J
from orderloom.operators import sinks as K
from orderloom.operators.history import item_history
from orderloom.plans import fact_build
from orderloom.plans import item_fact as P
from orderloom.session import shared_dir
from parity.inputs import Tables

NOW = datetime(2024, 1, 5, 9, 30)
HISTORY = "sales_order_item_status_history"


@pytest.fixture
def tables(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return {n: t[n] for n in [*P.LOOKUP_KEYS, HISTORY]}


def flagged(t):
    pivot = item_history(t[HISTORY], t["sales_order_item"], t["sales_order"])
    return pivot.withColumns({"is_invoiced_flag": F.lit("0"), "is_defective_flag": F.lit("0")})


def in_three(monkeypatch):
    """Test data counts as three slices."""
    monkeypatch.setattr(P, "SLICE_BYTES", 1)
    monkeypatch.setattr(P, "MOST_SLICES", 3)


def test_slices_are_bounded():
    assert [P.slices_for(n * P.SLICE_BYTES) for n in (0, 0.5, 1, 1.5, 7, 5000)] == [1, 1, 1, 2, 7, P.MOST_SLICES]


def test_equal_keys_are_in_one_slice(spark):
    df = spark.range(100).select(F.col("id").cast("int").alias("i"), "id", F.col("id").cast("string").alias("s"), F.col("id").cast("double").alias("d"))
    assert df.where(J.slice_of(df, "i", 7) != J.slice_of(df, "id", 7)).isEmpty() and df.select(J.slice_of(df, "i", 7)).distinct().count() == 7
    none = df.select(F.lit(None).cast("int").alias("i"))
    assert none.select(J.slice_of(none, "i", 7)).distinct().count() == 1
    fits = {(a, b) for a in df.columns for b in df.columns if J.same_slices(df, a, df, b)}
    assert fits == {("i", "i"), ("i", "id"), ("id", "i"), ("id", "id"), ("s", "s")}


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_slices_make_the_same_fact(spark, rows, tables, monkeypatch, kind):
    """Also where the keys of both sides are of different kinds."""
    order = tables["sales_order"]
    tables["sales_order"] = order.withColumn("id_sales_order", F.col("id_sales_order").cast(kind))
    whole = rows(P.item_fact(flagged(tables), tables, NOW))
    in_three(monkeypatch)
    staging = K.Staging(spark, shared_dir(spark, "slices"))
    fact = P.item_fact(flagged(tables), tables, NOW, staging=staging)
    assert fact.columns == P.FACT_COLUMNS and rows(fact) == whole and len(whole) > 100
    left = os.listdir(staging.root.removeprefix("file:"))
    assert {"items", "orders", "fact"} == set(left)
    assert not [f for f in os.listdir(f"{staging.root.removeprefix('file:')}/items") if f.startswith(P.SLICE)], "a slice's items go when its fact is stored"


def test_a_sliced_run_publishes_the_same_rows(spark, sf_dir, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(fact_build, "configure", lambda *a: None)
    t = Tables(spark, sf_dir)
    runs, facts, steps = [], [], []
    for name in ("whole", "parts"):
        runs.append(fact_build.build_item_fact(spark, t, str(tmp_path / name), f"fact_{name}", NOW))
        facts.append(rows(spark.table(f"fact_{name}")))
        spark.sql(f"DROP TABLE fact_{name}")
        in_three(monkeypatch)
        monkeypatch.setattr(K, "write_parts", lambda parts, *a, f=K.write_parts, **k: f(parts if hasattr(parts, "columns") else (steps.append(a[0]) or p for p in parts), *a, **k))
    assert facts[0] == facts[1] and len(facts[0]) > 100
    assert rows(runs[0].audit) == rows(runs[1].audit)
    made = [s.rsplit("/", 1)[1] for s in steps]
    assert made == ["items"] * 3 + ["dt=202401050930"] * 3, "the shuffles of one slice go before the next"
    assert runs[1].path == f"{tmp_path}/parts/published/dt=202401050930"
    assert not os.path.exists(tmp_path / "parts/_staging/202401050930") and not os.listdir(tmp_path / "parts/published/_unfinished")
    assert rows(K.read_snapshots(spark, f"{tmp_path}/parts/published").drop(K.RUN_PARTITION)) == facts[0]


def test_parts_of_a_snapshot_are_seen_together(spark, tmp_path):
    root, seen = str(tmp_path / "s"), []

    def parts(broken):
        for k in range(3):
            yield spark.range(5).select(F.expr(f"IF(id = 4 AND {k} = {broken}, raise_error('bad'), id) AS id").cast("bigint"))
            seen.append(os.path.exists(f"{root}/dt=202401050930"))

    with pytest.raises(PySparkException):
        K.write_snapshot(parts(2), root, NOW, spark=spark)
    assert seen == [False, False] and os.listdir(f"{root}/_unfinished") == []
    path = K.write_snapshot(parts(9), root, NOW, spark=spark)
    assert spark.read.parquet(path).count() == 15 and K.read_snapshots(spark, root).count() == 15 and not any(seen)
    with pytest.raises(K.SnapshotTaken):
        K.write_snapshot(parts(9), root, NOW, spark=spark)


def test_columns_of_one_side_are_made_before_the_sides_meet(spark, tables):
    """Lenient casts and labels cost once per item or order, not once per fact row."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    text = P.item_fact(flagged(tables), tables, NOW)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    above = text[: text.index("Join Inner, (o_id")]
    assert "order_week" in above and "RLIKE" not in above and "yearofweek" not in above.lower()


BAD = {
    "sales_order": ("created_at", "id_sales_order", "sales_order_id"),
    "sales_order_item": ("created_at", "id_sales_order_item", "id_sales_order_item"),
    "item_removal_inventory": ("created_time", "item_id", "id_sales_order_item"),
}


@pytest.mark.parametrize("name", sorted(BAD))
def test_unreadable_times_fail_only_where_they_reach_the_fact(spark, tables, name):
    """As a strict cast of the joined rows does."""
    column, key, shown = BAD[name]
    history = flagged(tables)
    fact = P.item_fact(history, tables, NOW).where("expected_dt_start IS NOT NULL")
    inside = tables[name].join(fact.select(F.col(shown).alias(key)), key, "left_semi").agg(F.min(key)).first()[0]
    outside = tables[name].join(P.item_fact(history, tables, NOW).select(F.col(shown).alias(key)), key, "left_anti").agg(F.min(key)).first()[0]
    good = tables[name]

    def spoilt(which):
        return tables | {name: good.withColumn(column, F.when(F.col(key) == which, F.lit("no time 7")).otherwise(F.col(column)))}

    n = P.item_fact(history, tables, NOW).count()
    assert len(P.item_fact(history, spoilt(outside), NOW).collect()) == n
    with pytest.raises(PySparkException):
        P.item_fact(history, spoilt(inside), NOW).collect()


def test_a_slot_without_a_day_or_with_an_odd_clock(spark):
    df = spark.createDataFrame([("2024-01-05", "0 days 05:30:00"), ("2024-01-05", "0 days 9x"), (None, "0 days 05:30:00")], "day string, at string")
    text = T.clock_text("day", "at")
    got = df.select(T.lenient_time(text).alias("read"), T.unread(text).alias("unread")).collect()
    assert [tuple(r) for r in got] == [(datetime(2024, 1, 5, 5, 30), None), (None, "2024-01-05 9x"), (None, None)]
    both = df.withColumns({"read": T.lenient_time(text), "left": T.unread(text)})
    assert both.where("at NOT LIKE '%x'").select(T.strictly("read", "left")).collect()[0][0] == datetime(2024, 1, 5, 5, 30)
    with pytest.raises(PySparkException):
        both.select(T.strictly("read", "left")).collect()
