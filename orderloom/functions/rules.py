"""Order-lifecycle rules as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_col, cases, contains_any_ci, contains_ci, lenient, one_of, squeezed

# Status codes, match texts, store ids and labels the rules are defined on.
EXPORT_CODES = ("4",)
REJECT_CODES = ("19", "18", "8", "36", "28", "12")
RETURN_CODES = ("8", "36", "28", "12")
DELIVERY_CODES = ("25",)
CANCEL_CODES = ("9", "13")
INVOICE_CODES = ("5",)
PICKER_TEXT = "picker"
STOCK_TEXT = "stock"
TEST_NAME_TEXT = "test"
CARD_TERMINAL_TEXT = "mswipe"
MEMBERSHIP_TEXT = "membership"
UNPAID_TEXT = "paymentnotrealized"
CUSTOMER_CHANNELS = ("webservice",)
SYSTEM_CHANNELS = ("gui", "cli")
EXCLUDED_STORE_ID = "381"
TEST_STORE_CODE = "1052"
DELIVERY_TYPES = {1: "in_store_pickup", 2: "home_delivery", 3: "express_delivery"}
WEIGHED_UNIT_TYPE = 1


@dataclass(frozen=True)
class Exclusions:
    """What makes an order a test or an off-channel one."""

    name_texts: tuple[str, ...] = (TEST_NAME_TEXT,)
    payment_texts: tuple[str, ...] = (CARD_TERMINAL_TEXT,)
    store_ids: tuple[str, ...] = (EXCLUDED_STORE_ID,)


def is_relevant(
    export: Column | str, invoice: Column | str, cancel: Column | str, source: Column | str, reason: Column | str
) -> Column:
    """1 when the item counts for its order.

    Cancelled items count only if the picker or missing stock caused it, or if
    they were invoiced; all others count once exported or invoiced.
    """
    exported, invoiced, cancelled = (as_col(c).isNotNull() for c in (export, invoice, cancel))
    shop_fault = F.coalesce(contains_ci(source, PICKER_TEXT), F.lit(False)) | F.coalesce(
        contains_ci(reason, STOCK_TEXT), F.lit(False)
    )
    counts = F.when(cancelled, shop_fault | invoiced).otherwise(exported | invoiced)
    return counts.cast("int")


def cancelled_by(
    relevant: Column | str, cancel: Column | str, invoice: Column | str, channel: Column | str, reason: Column | str
) -> Column:
    """Who cancelled an item: picker, customer, system, unknown, or na."""
    relevant, cancelled = as_col(relevant), as_col(cancel).isNotNull()
    open_item, channel = as_col(invoice).isNull(), squeezed(channel)
    by_system = one_of(channel, SYSTEM_CHANNELS) | squeezed(reason).contains(UNPAID_TEXT)
    return cases(
        (~cancelled, "na"),
        (open_item & (relevant == 1), "picker"),
        (open_item & (relevant == 0) & one_of(channel, CUSTOMER_CHANNELS), "customer"),
        (by_system, "system"),
        otherwise="unknown",
    )


def delivery_type(pickup_method: Column | str) -> Column:
    method = lenient(pickup_method, "int")
    return cases(*[(method == code, label) for code, label in DELIVERY_TYPES.items()], otherwise="unknown")


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or NULL."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def is_weighted(unit_type: Column | str) -> Column:
    return flag(lenient(unit_type, "int") == WEIGHED_UNIT_TYPE)


def is_test_name(first: Column | str, last: Column | str, rules: Exclusions = Exclusions()) -> Column:
    return contains_any_ci(first, rules.name_texts) | contains_any_ci(last, rules.name_texts)


def is_card_terminal(payment: Column | str, rules: Exclusions = Exclusions()) -> Column:
    return contains_any_ci(payment, rules.payment_texts)


def is_excluded(
    first: Column | str, last: Column | str, payment: Column | str, store: Column | str, rules: Exclusions = Exclusions()
) -> Column:
    return is_test_name(first, last, rules) | is_card_terminal(payment, rules) | one_of(store, rules.store_ids)


def is_test_store(store_code: Column | str, code: str = TEST_STORE_CODE) -> Column:
    return flag(as_col(store_code).cast("string") == code)


def is_membership(article: Column | str) -> Column:
    return flag(contains_ci(article, MEMBERSHIP_TEXT))


def fact_flags(
    unit_type: Column | str,
    first_name: Column | str,
    last_name: Column | str,
    payment: Column | str,
    store_code: Column | str,
    article: Column | str,
    rules: Exclusions = Exclusions(),
) -> dict[str, Column]:
    """The 0/1 flags of the item fact that come from lookups."""
    return {
        "is_weighted": is_weighted(unit_type),
        "is_test": flag(is_test_name(first_name, last_name, rules)),
        "is_Mswipe": flag(is_card_terminal(payment, rules)),
        "is_test_store": is_test_store(store_code),
        "is_membership_category": is_membership(article),
    }


def lost_to_picker(
    relevant: Column | str, cancel: Column | str, invoice: Column | str, cancelled_by_col: Column | str, *skip: Column | str
) -> Column:
    """Relevant item a picker cancelled and nobody invoiced, on a regular order."""
    lost = (
        (as_col(relevant) == 1)
        & as_col(cancel).isNotNull()
        & as_col(invoice).isNull()
        & (as_col(cancelled_by_col) == "picker")
    )
    for column in skip:
        lost = lost & (as_col(column) == 0)
    return lost


def defective_order(
    relevant: Column | str, export: Column | str, invoiced: Column | str, ordered: Column | str, lost: Column | str
) -> Column:
    """1 on relevant exported items of an order that lost items to the picker."""
    return flag(
        (as_col(relevant) == 1)
        & as_col(export).isNotNull()
        & (as_col(invoiced) < as_col(ordered))
        & (as_col(lost) > 0)
    )
