"""Reads of source tables: database over JDBC, files, or the catalog.

Filters and column lists are left to Catalyst, which pushes them into the
database or the Parquet scan. A database is read in disjoint key ranges of equal
counts, one task each, never by offset; it counts and cuts them itself.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from itertools import pairwise

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import literal_of

PAGE_ROWS = 70_000  # fixed value: default rows per page of a pull
MAX_SLICES = 1024  # tasks, and so connections, that one table is read with at most


@dataclass(frozen=True)
class Source:
    """A table of a source system. ``format`` is ``jdbc``, ``catalog`` or a file format."""

    host: str
    db: str
    table: str
    format: str = "jdbc"
    location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.db}.{self.table}"


def read_full(
    spark: SparkSession,
    source: Source,
    where: Column | str | None = None,
    columns: Sequence[str] | None = None,
    query: str | None = None,
    slices: Sequence[str] | None = None,
) -> DataFrame:
    """The whole table, optionally filtered, projected or replaced by a query; a database in one task for each of ``slices``."""
    if source.format == "jdbc" and slices:
        df = _jdbc(spark, source).jdbc(source.location, _relation(source, query), predicates=list(slices), properties={})
    elif query is not None:
        df = _read_query(spark, source, query)
    else:
        df = _read_table(spark, source)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def _jdbc(spark: SparkSession, source: Source) -> DataFrameReader:
    reader = spark.read.format("jdbc").options(**source.options).option("url", source.location).option("preferTimestampNTZ", "true")
    return reader if "fetchsize" in source.options else reader.option("fetchsize", str(PAGE_ROWS))


def _relation(source: Source, query: str | None) -> str:
    return source.name if query is None else f"({query}) q"


def _read_table(spark: SparkSession, source: Source) -> DataFrame:
    if source.format == "catalog":
        return spark.table(source.name)
    if source.format == "jdbc":
        return _jdbc(spark, source).option("dbtable", source.name).load()
    return spark.read.format(source.format).options(**source.options).load(source.location)


def _read_query(spark: SparkSession, source: Source, query: str) -> DataFrame:
    if source.format == "jdbc":
        return _jdbc(spark, source).option("query", query).load()
    # files and catalog tables: the query names its input {source}
    return spark.sql(query, source=_read_table(spark, source))


def read_since(df: DataFrame, column: str, value: object | None) -> DataFrame:
    """Rows at or after a watermark (inclusive); everything when there is none.

    The value is a literal of the column's type, so the filter reaches the database or row groups.
    """
    return df if value is None else df.where(F.col(column) >= literal_of(value, df.schema[column].dataType))


def source_count(spark: SparkSession, source: Source, where: str | None = None, query: str | None = None) -> DataFrame:
    """Rows that a read with the same arguments gives, as ``n_rows``; a database counts them itself and sends one row."""
    if source.format == "jdbc":
        return _read_query(spark, source, f"SELECT COUNT(*) AS n_rows FROM {_relation(source, query)}{_where(where)}")
    return read_full(spark, source, where, query=query).agg(F.count(F.lit(1)).alias("n_rows"))


def _where(*conditions: str | None) -> str:
    given = [f"({c})" for c in conditions if c]
    return f" WHERE {' AND '.join(given)}" if given else ""


def sql_literal(value: object) -> str:
    """A number or quoted text for a database's own SQL."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def asked_slices(
    spark: SparkSession,
    source: Source,
    column: str,
    where: str | None = None,
    query: str | None = None,
    page_rows: int = PAGE_ROWS,
    max_slices: int = MAX_SLICES,
) -> list[str] | None:
    """Disjoint predicates on a column that hold about as many rows each, for a read in as many tasks; None if one will do.

    The source itself cuts its sorted keys into pieces of equal counts and sends a row for each, however unevenly the
    keys lie: numbers, times or text. It needs window functions and, to be quick, an index on the column. Only
    rows that share one key cannot be cut. Spark's own tables are cut at approximate quantiles instead of a sort.
    """
    rows = source_count(spark, source, where, query).first()["n_rows"]
    pages = min(max_slices, math.ceil(rows / page_rows))
    if pages < 2:
        return None
    if source.format == "jdbc":
        cut = f"SELECT {column}, NTILE({pages}) OVER (ORDER BY {column}) AS slice FROM {_relation(source, query)}{_where(where, f'{column} IS NOT NULL')}"
        found = _read_query(spark, source, f"SELECT slice, MIN({column}) AS low FROM ({cut}) s GROUP BY slice").collect()  # a row per task
        lows = [r["low"] for r in sorted(found, key=lambda r: r["slice"])]
    else:
        at = F.percentile_approx(column, [k / pages for k in range(pages)], 100 * pages)
        lows = read_full(spark, source, where, query=query).agg(at.alias("lows")).first()["lows"] or []
    return slice_predicates(column, lows)


def pages_of(df: DataFrame, column: str, page_rows: int = PAGE_ROWS) -> Column:
    """Which of the equally wide ranges of a whole-number key a row is in; null without a key. As many ranges as the rows fill pages."""
    low, high, rows = df.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    if low is None:
        return F.lit(None).cast("int")
    width = (high - low) // math.ceil(rows / page_rows) + 1
    return F.expr(f"CAST((`{column}` - {low}) DIV {width} AS INT)")


def slice_predicates(column: str, lows: Sequence[object]) -> list[str]:
    """Predicates between the least keys of slices, given in order. The first and last are open, so that new keys fall in too; nulls have their own."""
    cuts = [sql_literal(v) for k, v in enumerate(lows) if k and v != lows[k - 1]]
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in pairwise(cuts)]
    return [f"{column} < {cuts[0]}", *between, f"{column} >= {cuts[-1]}", f"{column} IS NULL"]
