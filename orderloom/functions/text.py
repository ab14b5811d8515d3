"""Text and key expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Text that can be an integer (blanks and control characters around it are
# dropped by the cast), and text that can at all be a number or a time.
INTEGER_TEXT = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
NUMBER_TEXT = r"[0-9]|(?i)nan|inf"
TIME_TEXT = r"[0-9]"
POSSIBLE_TEXT = {"int": INTEGER_TEXT, "bigint": INTEGER_TEXT, "double": NUMBER_TEXT, "timestamp_ntz": TIME_TEXT}


def lenient(value: Column | str, kind: str) -> Column:
    """``try_cast`` that does not first raise an error on plain words.

    Spark builds an exception for every text it cannot cast, at many times the
    cost of a good value. For the types the jobs cast to, text that cannot pass is sorted out before the cast.
    """
    value = as_col(value)
    possible = POSSIBLE_TEXT.get(kind)
    if possible is None:
        return value.try_cast(kind)
    is_text = F.typeof(value) == "string"  # known when the query is planned
    return F.when(~is_text | value.cast("string").rlike(possible), value.try_cast(kind))


def contains_ci(text: Column | str, part: str) -> Column:
    """Case-folded substring test; NULL text gives NULL."""
    return F.lower(as_col(text)).contains(part.lower())


def contains_any_ci(text: Column | str, parts: Iterable[str]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | contains_ci(text, part)
    return found


def squeezed(text: Column | str) -> Column:
    """Lower case without blanks, for matching hand-typed labels."""
    return F.lower(F.replace(as_col(text), F.lit(" "), F.lit("")))


def one_of(value: Column | str, codes: Iterable[str]) -> Column:
    return as_col(value).isin(*codes)


def clean_key(key: Column | str) -> Column:
    """Drop the ``.0`` tail an integer gets on its way through a float column."""
    return F.regexp_replace(as_col(key), r"\.0+$", "")


def positive_key(key: Column | str) -> Column:
    """True for keys that are positive integers once cleaned; other text is NULL."""
    return lenient(clean_key(key), "int") > 0


def blank_as_zero_key(key: Column | str) -> Column:
    """Integer key of a text column where blank means 0.

    Removes ``.0`` anywhere, so ``1.05`` becomes 15, and fails on other text.
    """
    key = as_col(key)
    return F.when(key == "", F.lit(0)).otherwise(F.replace(key, F.lit(".0"), F.lit("")).cast("int"))


def prefix_before(text: Column | str, separator: str) -> Column:
    """Text before the first separator, or all of it when there is none."""
    return F.substring_index(as_col(text), separator, 1)


def or_default(value: Column | str, default: str = "Others") -> Column:
    return F.coalesce(as_col(value), F.lit(default))


def strip_newlines(df: DataFrame) -> DataFrame:
    """Remove CR and LF from every string column."""
    return df.select(
        *[
            F.translate(F.col(f.name), "\r\n", "").alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cases(*branches: tuple[Column, object], otherwise: object = None) -> Column:
    """Searched CASE: the first true condition gives the value."""
    (condition, value), *rest = branches
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)
