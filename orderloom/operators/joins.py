"""Join shapes the jobs use.

None forces a broadcast: Spark broadcasts a side whose size it has checked
against its threshold and shuffles both otherwise, and AQE splits a hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lookup(left: DataFrame, right: DataFrame, on: Column | str | Sequence[str], how: str = "left") -> DataFrame:
    """Left join to a lookup; rows fan out when the key is not unique on the right."""
    return left.join(right, on, how)


def placed_anew(key: Column | str) -> Column:
    """The same key as an expression Spark does not recognise as the key.

    AQE splits a hot key only where both sides are shuffled for the join
    itself. A side that comes out of an aggregation or a join on the key keeps
    its placement, and then the other side's hot key cannot be split. With its
    key computed, this side is shuffled once more; it has about one row per
    key, so that is cheap.
    """
    return F.least(key, key)


def join_per_key(df: DataFrame, per_key: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Put a table with one row per key on every row of ``df``, however hot a key is there."""
    added = [c for c in per_key.columns if c != key]
    return df.join(per_key.select(placed_anew(key).alias(key), *added), key, how).select(*df.columns, *added)


def exclude_not_in(df: DataFrame, key: str, excluded: DataFrame) -> DataFrame:
    """Rows where ``key NOT IN (excluded)`` is true, with SQL's NULL rules.

    A NULL in the list leaves no row. A NULL key stays only if the list is
    empty. The list may be large: it joins by hash or sort, while Spark's own
    ``NOT IN`` plan always broadcasts it.
    """
    listed = excluded.select(placed_anew(excluded.columns[0]).alias(key))
    seen = listed.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count(key).alias("keys"))).scalar()
    no_null, no_rows = seen["rows"] == seen["keys"], seen["rows"] == 0
    return df.where(no_null & (F.col(key).isNotNull() | no_rows)).join(listed, key, "left_anti")


def merge_lists(left: DataFrame, right: DataFrame, key: str, fill: object) -> DataFrame:
    """Full outer join of two lists on a key; values missing on one side become ``fill``.

    Each list holds a key once (make it distinct or aggregate it first), so no
    key is hot: AQE does not split full outer joins.
    """
    a, b = left.alias("a"), right.alias("b")
    filled = [F.coalesce(F.col(f"a.{c}"), F.lit(fill)).alias(c) for c in left.columns if c != key]
    filled += [F.coalesce(F.col(f"b.{c}"), F.lit(fill)).alias(c) for c in right.columns if c != key]
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(
        F.coalesce(F.col(f"a.{key}"), F.col(f"b.{key}")).alias(key), *filled
    )


def broadcast_by_key(df: DataFrame, key: str, aggregates: dict[str, Column], how: str = "inner") -> DataFrame:
    """Aggregate per key and put the result on every row of the key."""
    return join_per_key(df, df.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()]), key, how)


def slice_of(df: DataFrame, key: str, slices: int) -> Column:
    """Which of so many slices a row of ``df`` is in, by the hash of its key."""
    value = F.col(key).cast("bigint") if isinstance(df.schema[key].dataType, T.IntegralType) else F.col(key)
    return F.pmod(F.xxhash64(value), F.lit(slices)).cast("int")


def same_slices(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> bool:
    """Whether keys that are equal in a join are in one slice: not if the join casts one of them, or for kinds whose equal values differ in bytes."""
    kinds = [df.schema[key].dataType for df, key in ((left, left_key), (right, right_key))]
    return all(isinstance(k, T.IntegralType) for k in kinds) or all(k == T.StringType() for k in kinds)


def repeated_keys(keyed: Mapping[str, tuple[DataFrame, str]]) -> dict[str, int]:
    """For every named (table, key), how many keys occur more than once.

    Keys of one kind, whole numbers or text, go through one shuffle together, as they are: a long groups faster than its text.
    """
    kinds: dict[str, list[DataFrame]] = {}
    names = list(keyed)
    for number, (df, key) in enumerate(keyed.values()):
        kind = "bigint" if isinstance(df.schema[key].dataType, T.IntegralType) else "string"
        kinds.setdefault(kind, []).append(df.where(F.col(key).isNotNull()).select(F.lit(number).alias("of"), F.col(key).cast(kind).alias("key")))
    found = dict.fromkeys(names, 0)
    counts = [reduce(DataFrame.unionAll, rows).groupBy("of", "key").count().where("count > 1").groupBy("of").count() for rows in kinds.values()]
    for r in reduce(DataFrame.unionAll, counts).collect() if counts else []:  # a row per table at most
        found[names[r["of"]]] = r["count"]
    return found


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: lookups on them multiply rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
