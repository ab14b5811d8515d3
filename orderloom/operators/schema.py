"""Lake types, schema comparison and additive schema change."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import utc_clock
from ..functions.text import lenient
from ..sources.tables import Source, read_full, sql_literal

# Lake type per prefix of a source type; any other source type is text.
LAKE_TYPES = {
    "int": T.IntegerType(),
    "smallint": T.IntegerType(),
    "mediumint": T.IntegerType(),
    "tinyint": T.ByteType(),
    "bigint": T.LongType(),
    "float": T.DoubleType(),
    "decimal": T.DoubleType(),
    "double": T.DoubleType(),
    "bit": T.BooleanType(),
}
# How Spark's own types read in that listing.
SOURCE_NAMES = {
    "int": "int",
    "smallint": "smallint",
    "tinyint": "tinyint",
    "bigint": "bigint",
    "float": "float",
    "double": "double",
    "boolean": "bit",
    "timestamp_ntz": "datetime",
    "timestamp": "datetime",
    "date": "date",
    "string": "text",
}


@dataclass(frozen=True)
class SourceColumn:
    """One line of a source table's listing."""

    name: str
    type: str
    default: str | None = None


def to_lake_type(source_type: str, exact_decimal: bool = False) -> T.DataType:
    """Type of a source column in the lake. Decimals become doubles unless asked otherwise."""
    text = source_type.lower()
    exact = re.match(r"decimal\((\d+)(?:,\s*(\d+))?\)", text) if exact_decimal else None
    if exact:
        return T.DecimalType(int(exact[1]), int(exact[2] or 0))
    return next((lake for prefix, lake in LAKE_TYPES.items() if text.startswith(prefix)), T.StringType())


def listing_of(schema: T.StructType) -> list[SourceColumn]:
    """Listing of a table that Spark can read itself."""
    return [SourceColumn(f.name, SOURCE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())) for f in schema]


def read_listing(spark: SparkSession, source: Source) -> list[SourceColumn]:
    """Names, type texts and defaults of a source's columns: a database's own listing, or what Spark knows of a table."""
    if source.format != "jdbc":
        known = read_full(spark, source).schema
        return [SourceColumn(c.name, c.type, f.metadata.get("CURRENT_DEFAULT")) for c, f in zip(listing_of(known), known)]
    text = (
        "SELECT column_name AS name, column_type AS type, column_default AS value, ordinal_position AS place FROM information_schema.columns "
        f"WHERE table_schema = {sql_literal(source.db)} AND table_name = {sql_literal(source.table)}"
    )
    rows = read_full(spark, source, query=text).orderBy("place").collect()
    return [SourceColumn(r["name"], r["type"], r["value"]) for r in rows]


def lake_schema(listing: Sequence[SourceColumn], exact_decimal: bool = False) -> T.StructType:
    return T.StructType([T.StructField(c.name, to_lake_type(c.type, exact_decimal)) for c in listing])


def cast_to_lake(df: DataFrame, listing: Sequence[SourceColumn], exact_decimal: bool = False) -> DataFrame:
    """Every listed column in its lake type, in listing order; zoned times that become text show UTC."""
    zoned = {f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)}
    value = lambda f: utc_clock(f.name) if f.name in zoned and isinstance(f.dataType, T.StringType) else F.col(f.name)
    return df.select(*[value(f).cast(f.dataType).alias(f.name) for f in lake_schema(listing, exact_decimal)])


REJECTS = "_rejects"


def checked_cast(df: DataFrame, listing: Sequence[SourceColumn], exact_decimal: bool = False) -> DataFrame:
    """``cast_to_lake`` that does not fail: values that do not fit are NULL, and ``_rejects`` lists their column, text and reason.

    ``_rejects`` is NULL where all values fit.
    """
    have, typed, wrong = {f.name.lower(): f.dataType for f in df.schema}, [], []
    for f in lake_schema(listing, exact_decimal):
        value, source = F.col(f.name), have.get(f.name.lower())
        if source == f.dataType or isinstance(f.dataType, T.StringType):
            typed.append((utc_clock(value) if isinstance(source, T.TimestampType) and source != f.dataType else value).cast(f.dataType).alias(f.name))
            continue
        fits = lenient(value, f.dataType.simpleString()) if isinstance(source, T.StringType) else value.try_cast(f.dataType)
        typed.append(fits.alias(f.name))
        reason = F.lit(f"no {f.dataType.simpleString()}")
        entry = F.struct(F.lit(f.name).alias("column"), value.cast("string").alias("text"), reason.alias("reason"))
        wrong.append(F.when(value.isNotNull() & fits.isNull(), entry))
    if not wrong:
        return df.select(*typed, F.lit(None).cast("array<struct<column:string,text:string,reason:string>>").alias(REJECTS))
    listed = F.array_compact(F.array(*wrong))
    return df.select(*typed, F.when(F.size(listed) > 0, listed).alias(REJECTS))


DIFF_SCHEMA = "position INT, name STRING, status STRING, lake_type STRING, is_suspect BOOLEAN"


def schema_diff(spark: SparkSession, listing: Sequence[SourceColumn], target: T.StructType) -> DataFrame:
    """Compare by position.

    ``same``: equal names. ``mismatch``: another name at this position; nothing
    may be added then. ``added``: a source column past the target's last.
    ``extra``: a target column past the source's last. ``no_target``: there is
    no target table. An added column with a default is suspect: rows already in
    the lake would read NULL instead.
    """
    return spark.createDataFrame(_compare(listing, target), DIFF_SCHEMA)


def _compare(listing: Sequence[SourceColumn], target: T.StructType) -> list[tuple]:
    rows = []
    for i in range(max(len(listing), len(target))):
        src = listing[i] if i < len(listing) else None
        dst = target[i] if i < len(target) else None
        if src is None:
            status = "extra"
        elif not len(target):
            status = "no_target"
        elif dst is None:
            status = "added"
        else:
            status = "same" if src.name.lower() == dst.name.lower() else "mismatch"
        lake = to_lake_type(src.type).simpleString() if src else dst.dataType.simpleString()
        suspect = status == "added" and src.default is not None
        rows.append((i + 1, (src or dst).name, status, lake, suspect))
    return rows


@dataclass(frozen=True)
class Evolution:
    added: tuple[str, ...]
    suspect: tuple[str, ...]


class SchemaMismatch(ValueError):
    """Source and lake table differ by more than trailing source columns."""


def evolve(spark: SparkSession, table: str, listing: Sequence[SourceColumn]) -> Evolution:
    """Add the source's new trailing columns to a lake table; old files read as NULL there."""
    if not spark.catalog.tableExists(table):
        return Evolution((), ())  # the first load makes it
    rows = _compare(listing, spark.table(table).schema)
    wrong = [r[1] for r in rows if r[2] in ("mismatch", "extra")]
    if wrong:
        raise SchemaMismatch(f"{table}: columns out of place or unknown to the source: {', '.join(wrong)}")
    added = [r for r in rows if r[2] == "added"]
    if added:
        columns = ", ".join(f"`{r[1]}` {r[3]}" for r in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return Evolution(tuple(r[1] for r in added), tuple(r[1] for r in added if r[4]))


def nulls_after_evolution(df: DataFrame, added: Sequence[str]) -> DataFrame:
    """Per added column, how many source rows hold a value that older lake files lack."""
    counts = df.agg(*[F.count(c).alias(c) for c in added])
    return counts.unpivot([], list(added), "name", "rows_to_backfill")
