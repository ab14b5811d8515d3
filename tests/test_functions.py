"""Edge rows of the column functions and rules."""

from datetime import date, datetime

import pytest
from pyspark.errors import ArithmeticException, DateTimeException, NumberFormatException
from pyspark.sql import functions as F

from orderloom.functions import rules as R
from orderloom.functions import temporal as T
from orderloom.functions import text as X


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def out(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_clean_key(spark):
    df = one_column(spark, ["12", "12.0", "12.000", "", None, "abc", "1.05", "1.0.0"])
    assert out(df, X.clean_key("v")) == ["12", "12", "12", "", None, "abc", "1.05", "1.0"]
    assert out(df, X.positive_key("v")) == [True, True, True, None, None, None, None, None]
    assert out(one_column(spark, ["0.0", "-3.0"]), X.positive_key("v")) == [False, False]


def test_blank_as_zero_key(spark):
    df = one_column(spark, ["", "7", "7.0", "1.05", None])
    assert out(df, X.blank_as_zero_key("v")) == [0, 7, 7, 15, None]
    with pytest.raises(NumberFormatException):
        one_column(spark, ["abc"]).select(X.blank_as_zero_key("v")).collect()


def test_prefix_before(spark):
    df = one_column(spark, ["A_1", "A", "_1", "A_1_2", "", None])
    assert out(df, X.prefix_before("v", "_")) == ["A", "A", "", "A", "", None]


def test_squeezed_and_contains(spark):
    df = one_column(spark, ["Web Service", "GUI ", None])
    assert out(df, X.squeezed("v")) == ["webservice", "gui", None]
    assert out(df, X.contains_ci("v", "SERVICE")) == [True, False, None]


def test_strip_newlines_keeps_other_text(spark):
    df = spark.createDataFrame([("a\r\nb\n", 1), ("\r", 2), (None, 3), ('x\x01"', 4)], "t string, n int")
    assert [tuple(r) for r in X.strip_newlines(df).collect()] == [("ab", 1), ("", 2), (None, 3), ('x\x01"', 4)]


def test_try_cast_and_strict_cast(spark):
    df = one_column(spark, ["12", "12.0", " 12 ", "x", None])
    assert out(df, F.col("v").try_cast("int")) == [12, None, 12, None, None]
    with pytest.raises(DateTimeException):
        one_column(spark, ["n/a"]).select(T.strict_time("v")).collect()
    assert out(one_column(spark, ["n/a", None]), T.lenient_time("v")) == [None, None]


def test_lenient_equals_try_cast(spark):
    texts = ["12", "+12", "-3", " 12 ", "\t7\n", "12.0", "1e3", "1.", ".5", "99999999999", "99999999999999999999", "", " ", "abc",
             "12a", "NaN", "inf", "-Infinity", "1d", "--1", "+", "0x1F", "\u0661", "\x7f5", None, "2024", "2024-01-05", "2024-1-5 3:4:5",
             "2024-01-05T03:04:05.123456", "2024-13-01", "n/a", "12:30:00", "now", "epoch"]
    df = one_column(spark, texts)
    for kind in ("int", "bigint", "double", T.WALL_CLOCK):
        assert str(out(df, X.lenient("v", kind))) == str(out(df, F.col("v").try_cast(kind))), kind
    numbers = one_column(spark, [12.0, 12.7, 1e12, None], "double")
    assert out(numbers, X.lenient("v", "int")) == out(numbers, F.col("v").try_cast("int")) == [12, 12, None, None]


def test_slot_times(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 5), "0 days 09:30:00"), (date(2024, 1, 5), None), (None, "0 days 09:30:00")], "d date, t string"
    )
    assert out(df, T.at_clock("d", "t")) == [datetime(2024, 1, 5, 9, 30), None, None]
    assert out(df, T.slot_label(F.lit(3), "t", F.lit("0 days 10:45:00"))) == ["Slot 3 09:30-10:45", None, "Slot 3 09:30-10:45"]


def test_pick_deadline(spark):
    slot = datetime(2024, 1, 5, 10, 0)
    created = [
        datetime(2024, 1, 5, 9, 30, 40),  # 29 min 20 s before
        datetime(2024, 1, 5, 9, 30),
        datetime(2024, 1, 5, 9, 29),
        datetime(2024, 1, 5, 11, 0),
        None,
    ]
    df = spark.createDataFrame([(c, slot) for c in created] + [(slot, None)], "c timestamp_ntz, s timestamp_ntz")
    assert out(df, T.elapsed_minutes("c", "s")) == [29, 30, 31, -60, None, None]
    assert out(df, T.pick_deadline("c", "s")) == [
        datetime(2024, 1, 5, 10, 0, 40), slot, slot, datetime(2024, 1, 5, 11, 30), slot, None,
    ]
    with pytest.raises(ValueError):
        T.pick_deadline("c", "s", minutes=0)


def test_deadline_does_not_depend_on_the_session_zone(spark):
    """The clock change of 2024-03-31 is no gap in wall-clock time."""
    df = spark.createDataFrame(
        [(datetime(2024, 3, 31, 1, 50), datetime(2024, 3, 31, 3, 10))], "c timestamp_ntz, s timestamp_ntz"
    )
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert out(df, T.elapsed_minutes("c", "s")) == [80]
        assert out(df, T.pick_deadline("c", "s")) == [datetime(2024, 3, 31, 3, 10)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_earliest(spark):
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame([(a, b), (b, a), (a, a), (None, b), (a, None), (None, None)], "x timestamp_ntz, y timestamp_ntz")
    assert out(df, T.earliest("x", "y")) == [a, a, a, b, a, None]


def test_calendar_labels_mix_iso_and_calendar_years(spark):
    days = [date(2019, 12, 30), date(2020, 1, 1), date(2021, 1, 3), date(2021, 1, 4), date(2024, 12, 30), None]
    df = one_column(spark, days, "date")
    labels = T.iso_labels("v", "expected")
    assert out(df, labels["expected_week"]) == ["wk-01:2019", "wk-01:2020", "wk-53:2021", "wk-01:2021", "wk-01:2024", None]
    assert out(df, labels["expected_month_yr"]) == ["12-2019", "01-2020", "01-2021", "01-2021", "12-2024", None]
    assert out(df, labels["expected_yr"]) == ["2020", "2020", "2020", "2021", "2025", None]
    assert out(df, labels["expected_yr_wk"]) == [202001, 202001, 202053, 202101, 202501, None]
    assert out(df, labels["expected_yr_month"]) == [202012, 202001, 202001, 202101, 202512, None]


def test_local_time_and_stamp(spark):
    now = datetime(2024, 1, 5, 20, 0)
    assert out(spark.range(1), T.local_time_label(now, "Asia/Kolkata")) == ["2024-01-06 01:30:00"]
    assert T.run_stamp(now) == "202401052000"
    assert out(spark.range(1), T.lookback_start(now, 90)) == [datetime(2023, 10, 7, 20, 0)]


D = datetime(2024, 1, 1)


@pytest.mark.parametrize(
    "export, invoice, cancel, source, reason, expected",
    [
        (None, None, D, "Picker App", None, 1),
        (None, None, D, None, "Out of STOCK", 1),
        (D, None, D, "gui", "other", 0),
        (D, D, D, "gui", "other", 1),
        (None, D, D, "picker", None, 1),
        (None, D, None, None, None, 1),
        (D, None, None, "picker", None, 1),
        (None, None, D, None, None, 0),
        (None, None, None, "picker", "stock", 0),
    ],
)
def test_is_relevant(spark, export, invoice, cancel, source, reason, expected):
    kinds = "e timestamp_ntz, i timestamp_ntz, c timestamp_ntz, s string, r string"
    df = spark.createDataFrame([(export, invoice, cancel, source, reason)], kinds)
    assert out(df, R.is_relevant("e", "i", "c", "s", "r")) == [expected]


@pytest.mark.parametrize(
    "relevant, cancel, invoice, channel, reason, expected",
    [
        (1, D, None, "Web Service", None, "picker"),
        (0, D, None, "Web Service", None, "customer"),
        (0, D, None, "GUI", None, "system"),
        (0, D, None, " c l i ", None, "system"),
        (0, D, None, None, "Payment Not Realized", "system"),
        (1, D, D, None, "payment not realized", "system"),
        (0, None, None, "gui", None, "na"),
        (1, None, D, None, None, "na"),
        (0, D, None, None, None, "unknown"),
        (1, D, D, "Web Service", "x", "unknown"),
    ],
)
def test_cancelled_by(spark, relevant, cancel, invoice, channel, reason, expected):
    df = spark.createDataFrame(
        [(relevant, cancel, invoice, channel, reason)], "r int, c timestamp_ntz, i timestamp_ntz, q string, t string"
    )
    assert out(df, R.cancelled_by("r", "c", "i", "q", "t")) == [expected]


def test_flags_are_never_null(spark):
    df = spark.createDataFrame(
        [
            ("1", "TEST x", None, "Card mSwipe", "1052", "Membership"),
            ("2", None, "a tester", "cash", "1", "x"),
            (None, None, None, None, None, None),
        ],
        "u string, f string, l string, p string, s string, a string",
    )
    flags = R.fact_flags("u", "f", "l", "p", "s", "a")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in flags.items()]).collect()]
    assert got == [(1, 1, 1, 1, 1), (0, 1, 0, 0, 0), (0, 0, 0, 0, 0)]


def test_delivery_type(spark):
    df = one_column(spark, ["1", "2", "3", "4", "x", None])
    assert out(df, R.delivery_type("v")) == [
        "in_store_pickup", "home_delivery", "express_delivery", "unknown", "unknown", "unknown",
    ]


def test_cases_takes_the_first_true_branch(spark):
    df = one_column(spark, [1, 5, None], "int")
    chosen = X.cases((F.col("v") > 0, "a"), (F.col("v") > 4, "b"), otherwise="c")
    assert out(df, chosen) == ["a", "a", "c"]


@pytest.mark.parametrize(
    "kind",
    ["int", "integer", "bigint", "long", "smallint", "tinyint", "float", "double", "decimal(10,2)", "boolean", "string",
     "date", "timestamp", "timestamp_ntz", "binary"],
)
def test_lenient_is_try_cast(spark, kind):
    values = ["1", " 2 ", "-3.5", "1e3", "abc", "true", "NaN", "inf", "", None, "2024-01-02", "2024-01-02 03:04:05", "12345678901", "0x1"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = df.select(X.lenient("v", kind).alias("a"), F.col("v").try_cast(kind).alias("b")).selectExpr("a <=> b AS same")
    assert all(r.same for r in got.collect())


def test_fixed_codes_and_texts():
    """The checking SQL takes these from the rules, so they are pinned here."""
    from orderloom.functions import rules

    assert (rules.EXPORT_CODES, rules.INVOICE_CODES, rules.DELIVERY_CODES) == (("4",), ("5",), ("25",))
    assert set(rules.CANCEL_CODES) == {"9", "13"}
    assert set(rules.RETURN_CODES) == {"8", "12", "28", "36"}
    assert set(rules.REJECT_CODES) == set(rules.RETURN_CODES) | {"18", "19"}
    assert (rules.PICKER_TEXT, rules.STOCK_TEXT, rules.TEST_NAME_TEXT) == ("picker", "stock", "test")
    assert (rules.CARD_TERMINAL_TEXT, rules.MEMBERSHIP_TEXT, rules.UNPAID_TEXT) == ("mswipe", "membership", "paymentnotrealized")
    assert (set(rules.CUSTOMER_CHANNELS), set(rules.SYSTEM_CHANNELS)) == ({"webservice"}, {"cli", "gui"})
    assert (rules.EXCLUDED_STORE_ID, rules.TEST_STORE_CODE, rules.WEIGHED_UNIT_TYPE) == ("381", "1052", 1)
    assert rules.DELIVERY_TYPES == {1: "in_store_pickup", 2: "home_delivery", 3: "express_delivery"}
