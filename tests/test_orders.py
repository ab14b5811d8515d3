"""History pivot, order lists and counts against brute force."""

import random
from datetime import datetime

from pyspark.sql import functions as F

from orderloom.functions import rules as R
from orderloom.operators import history as H
from orderloom.operators import joins as J
from orderloom.operators import orders as O

HISTORY = "fk_sales_order_item bigint, fk_sales_order_item_status string, created_at string, note string, source string, request_type string"


def history(spark, *events):
    return spark.createDataFrame(list(events), HISTORY)


def test_pivot_takes_each_maximum_on_its_own(spark):
    h = history(
        spark,
        (1, "8", "2024-01-01 00:00:00", "b", "x", None),
        (1, "8", "2024-01-02 00:00:00", "a", "y", "gui"),
        (1, "19", "2024-01-03 00:00:00", None, "a", None),
        (1, "11", "2024-01-09 00:00:00", "z", "z", "z"),
        (2, "11", "2024-01-09 00:00:00", "z", "z", "z"),
    )
    got = {r.fk_sales_order_item: r for r in H.status_pivot(h, ["fk_sales_order_item"], "fk_sales_order_item_status", H.stage_rules()).collect()}
    assert got[1].reject_dt == datetime(2024, 1, 3) and got[1].return_dt == datetime(2024, 1, 2)
    assert (got[1].reject_reason, got[1].reject_source, got[1].reject_req_type) == ("b", "y", "gui")
    assert got[1].export_dt is None
    assert all(got[2][c] is None for c in H.stage_rules())
    assert len(H.stage_rules()) == 15


def test_item_history_keeps_items_of_orders_once(spark, rows):
    h = history(spark, *[(i, "5", "2024-01-01 00:00:00", None, None, None) for i in (1, 1, 2, 3, 4)])
    items = spark.createDataFrame([(1, 10), (1, 10), (2, 10), (2, 11), (3, 99)], "id_sales_order_item bigint, fk_sales_order bigint")
    orders = spark.createDataFrame([(10, "A"), (11, "B"), (11, "B"), (12, None)], "id_sales_order bigint, order_nr string")
    got = H.item_history(h, items, orders).select("order_nr", "fk_sales_order_item", "is_relevant")
    assert rows(got) == [("A", 1, 1), ("A", 2, 1), ("B", 2, 1)]


def not_in(df, excluded):
    return df.sparkSession.sql("SELECT * FROM {d} WHERE k NOT IN (SELECT k FROM {e})", d=df, e=excluded)


def test_exclude_not_in_follows_sql_nulls(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    for listed in ([], ["b"], ["x"], ["b", None], [None], ["b", "b"]):
        excluded = spark.createDataFrame([(k,) for k in listed], "k string")
        assert rows(J.exclude_not_in(df, "k", excluded)) == rows(not_in(df, excluded)), listed
    assert J.exclude_not_in(df, "k", df.where("false").select("k")).columns == ["k", "v"]


def flags_by_lists(pivot, excluded):
    """Two distinct lists and a full join, in SQL."""
    return pivot.sparkSession.sql(
        """WITH d AS (SELECT DISTINCT order_nr FROM {p} WHERE is_relevant = 1 AND invoice_dt IS NULL
                      AND order_nr NOT IN (SELECT order_nr FROM {e})),
                i AS (SELECT DISTINCT order_nr FROM {p} WHERE is_relevant = 1 AND invoice_dt IS NOT NULL
                      AND order_nr NOT IN (SELECT order_nr FROM {e}))
           SELECT coalesce(d.order_nr, i.order_nr) AS order_nr,
                  CASE WHEN i.found THEN '1' ELSE '0' END, CASE WHEN d.found THEN '1' ELSE '0' END
           FROM (SELECT *, true AS found FROM d) d FULL JOIN (SELECT *, true AS found FROM i) i ON d.order_nr = i.order_nr""",
        p=pivot, e=excluded,
    )


def test_order_flags(spark, rows):
    when = datetime(2024, 1, 1)
    data = [("both", 1, when), ("both", 1, None), ("inv", 1, when), ("open", 1, None), ("none", 0, when), ("out", 1, when)]
    data += [(None, 1, when), (None, 1, None)]
    pivot = spark.createDataFrame(data, "order_nr string, is_relevant int, invoice_dt timestamp_ntz")
    for listed in (["out"], [], ["out", None]):
        excluded = spark.createDataFrame([(k,) for k in listed], "order_nr string")
        assert rows(O.order_flags(pivot, excluded)) == rows(flags_by_lists(pivot, excluded)), listed
    got = O.items_with_flags(pivot, O.order_flags(pivot, spark.createDataFrame([("out",)], "order_nr string")))
    assert {(r.order_nr, r.is_defective_flag, r.is_invoiced_flag) for r in got.collect()} == {
        ("both", "1", "1"), ("inv", "0", "1"), ("open", "1", "0"), ("none", "0", "0"), ("out", "0", "0"), (None, "0", "0"),
    }


def test_excluded_orders_ignores_nulls(spark, rows):
    orders = spark.createDataFrame(
        [("1", "TEST", None, None, None), ("2", None, None, "Card Mswipe", None), ("3", None, None, None, "381"),
         ("3", "a", "b", "c", "381"), ("4", None, None, None, None), (None, "test", None, None, None)],
        "order_nr string, customer_first_name string, customer_last_name string, payment_method string, store_id string",
    )
    assert rows(O.excluded_orders(orders)) == [(None,), ("1",), ("2",), ("3",)]
    rules = R.Exclusions(store_ids=("9",), payment_texts=())
    assert rows(O.excluded_orders(orders, rules)) == [(None,), ("1",)]


FACT = (
    "order_nr bigint, sku string, id_sales_order_item bigint, is_weighted int, is_relevant int, is_test int, "
    "is_test_store int, is_Mswipe int, cancelled_dt timestamp_ntz, invoice_dt timestamp_ntz, export_dt timestamp_ntz, cancelled_by string"
)


def random_fact(spark, n, seed=7):
    rnd, when = random.Random(seed), datetime(2024, 1, 1)
    data = [
        (
            rnd.choice([None, 1, 1, 1, 2, 3, 4, 5]), rnd.choice(["s1", "s2", "7", None]), rnd.randrange(12),
            rnd.choice([0, 1, 1, None]), rnd.choice([0, 1, 1]), rnd.choice([0, 0, 1]), 0, rnd.choice([0, 0, 0, 1]),
            rnd.choice([None, when]), rnd.choice([None, when]), rnd.choice([None, when]), rnd.choice(["picker", "na", "system"]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(data, FACT)


def test_order_item_counts_equal_distinct_counts(spark, rows):
    fact = random_fact(spark, 400)
    relevant = F.col("is_relevant") == 1
    lost = (
        relevant & F.col("cancelled_dt").isNotNull() & F.col("invoice_dt").isNull() & (F.col("cancelled_by") == "picker")
        & (F.col("is_test") + F.col("is_test_store") + F.col("is_Mswipe") == 0)
    )
    identity = O.counted_identity()
    expected = fact.groupBy("order_nr").agg(
        F.countDistinct(F.when(lost, identity)).cast("double"),
        F.countDistinct(F.when(relevant, identity)),
        F.countDistinct(F.when(relevant & F.col("invoice_dt").isNotNull(), identity)),
    )
    got = O.order_item_counts(fact)
    assert rows(got) == rows(expected)
    assert [t for _, t in got.dtypes] == ["bigint", "double", "bigint", "bigint"]
    assert all(r.items_invoiced <= r.items_ordered for r in got.collect())


def test_counts_share_identities_between_sku_and_line(spark, rows):
    """A line id equal to a sku text counts once, and orders without relevant items count 0."""
    when = datetime(2024, 1, 1)
    base = (0, 0, 0, None, when, when, "na")
    fact = spark.createDataFrame(
        [(1, "7", 1, 1, 1, *base), (1, "7", 2, 1, 1, *base), (1, "x", 7, 0, 1, *base), (2, "x", 8, 0, 0, *base)], FACT
    )
    assert rows(O.order_item_counts(fact)) == [(1, 0.0, 1, 1), (2, 0.0, 0, 0)]


def test_joined_counts_drop_unnumbered_orders(spark):
    fact = random_fact(spark, 200)
    joined = O.with_defective_order(O.order_metrics_joined(fact, O.order_item_counts(fact)))
    assert joined.count() == fact.where("order_nr IS NOT NULL").count()
    wrong = joined.where(
        "is_defective_order != CASE WHEN is_relevant = 1 AND export_dt IS NOT NULL AND items_invoiced < items_ordered "
        "AND items_cancelled_by_picker > 0 THEN 1 ELSE 0 END"
    )
    assert wrong.isEmpty()


def test_double_lookup_squares_and_duplicates_are_found(spark, rows):
    orders = spark.createDataFrame([("0",), ("1",), ("2",)], "k string")
    picks = spark.createDataFrame([("1", 1), ("2", 1), ("2", 2)], "k string, p int")
    twice = J.lookup(J.lookup(orders, picks, "k"), picks.withColumnRenamed("p", "q"), "k")
    assert rows(twice.groupBy("k").count()) == [("0", 1), ("1", 1), ("2", 4)]
    assert rows(J.duplicate_keys(picks, ["k"])) == [("2", 2)]


def test_merge_lists_and_broadcast_by_key(spark, rows):
    a = spark.createDataFrame([("x", "1"), ("y", "1")], "k string, f string")
    b = spark.createDataFrame([("y", "1"), ("z", "1")], "k string, g string")
    assert rows(J.merge_lists(a, b, "k", "0")) == [("x", "1", "0"), ("y", "1", "1"), ("z", "0", "1")]
    df = spark.createDataFrame([("x", 1), ("x", 3), ("y", 2)], "k string, v int")
    assert rows(J.broadcast_by_key(df, "k", {"top": F.max("v")})) == [("x", 1, 3), ("x", 3, 3), ("y", 2, 2)]


def test_repeated_keys(spark):
    from orderloom.operators.joins import repeated_keys

    numbers = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (3,), (3,), (3,)], "k int")
    text = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "s string")
    keyed = {"numbers": (numbers, "k"), "long": (numbers.selectExpr("CAST(k AS BIGINT) AS j"), "j"), "text": (text, "s"), "once": (text.distinct(), "s"), "none": (numbers.where("false"), "k")}
    assert repeated_keys(keyed) == {"numbers": 2, "long": 2, "text": 1, "once": 0, "none": 0}
    assert repeated_keys({}) == {}
