"""Loading one source table into the lake, in full or from its high watermark.

Order of a load: read into a staging folder, claim the load's number, switch the folder in, log the watermark, let the claim go.
Rows and maximum are observed while the staged files are written, so nothing is read twice. A load that dies in
between is repeated from the old watermark, with the same number and so into the same partition; one that another load
has overtaken is refused and leaves nothing behind.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import Instant, at_utc_clock
from ..functions.text import strip_newlines
from ..operators import schema as S
from ..operators.sinks import (
    PUBLISHED_CODEC,
    make_folder,
    parse_part_spec,
    partition_folder,
    refuse_clash,
    remove_folder,
    staging_path,
    switch_folder,
    target_path,
)
from ..sources.delimited import write_text
from ..sources.tables import PAGE_ROWS, Source, asked_slices, read_full, sql_literal
from ..streaming import watermark as W
from ..streaming.watermark import LoadOvertaken

__all__ = ["Load", "LoadOvertaken", "PartitionTaken", "TooManyRejects", "load_table", "read_current", "read_latest"]

LOAD_PARTITION = "load"


class PartitionTaken(ValueError):
    """A partition already holds a logged load."""


class TooManyRejects(ValueError):
    """More rows than allowed hold values that do not fit the lake's types."""


@dataclass(frozen=True)
class Load:
    """What a load did. ``path`` is None when a delta was empty, ``rejects`` when no row was set aside."""

    mode: str
    n_rows: int
    path: str | None
    evolution: S.Evolution | None = None
    n_rejected: int = 0
    rejects: str | None = None


def load_table(
    spark: SparkSession,
    source: Source,
    root: str,
    now: datetime,
    *,
    log_path: str | None = None,
    config: DataFrame | None = None,
    where: Column | str | None = None,
    columns: Sequence[str] | None = None,
    query: str | None = None,
    split_column: str | None = None,
    part_spec: str | None = None,
    org_rules: Sequence[tuple[str, str]] = (("", ""),),
    listing: Sequence[S.SourceColumn] | None = None,
    lake_table: str | None = None,
    as_text: bool = False,
    lookback_days: int | None = None,
    page_rows: int = PAGE_ROWS,
    reject_limit: int | None = None,
) -> Load:
    """Load one table.

    With a row in ``config`` the load is incremental: it reads from the last
    logged maximum, and everything the first time. ``where`` applies to full
    loads only. ``split_column`` reads a database, or a ``query`` on it, in slices of ``page_rows`` rows
    each, which the database cuts. ``listing`` types the columns as the lake does; ``lake_table``
    gets the source's new trailing columns first, if it exists.

    A full load replaces what was there, also with nothing; until its rows are all written the old
    ones stay. It is refused where the log lists loads, which it would delete. An empty delta changes nothing. An
    incremental load without ``part_spec`` goes to a partition named by the load's number; one into a named partition that
    already holds a logged load is refused, and so is one that another load overtook. So no earlier load is lost.

    A value that does not fit its listed type fails the load. With ``reject_limit`` its row is set aside under ``_rejects``
    beside the table's partitions, with a column that says which values were wrong; more such rows than that fail the load.
    """
    mark, log = None, None
    if config is not None and log_path is not None:
        log = W.read_log(spark, log_path)
        mark = W.lookup(config, log, source)
    base = target_path(root, source.host, source.db, source.table, org_rules=org_rules)
    if mark is None and log is not None and not part_spec and not W.loads_of(log, source).isEmpty():
        raise PartitionTaken(f"{base} holds logged loads; a full load would delete them")
    if mark is not None and columns and mark.column not in columns:
        raise ValueError(f"an incremental load needs its column {mark.column!r}")
    if reject_limit is not None and (as_text or not listing):
        raise ValueError("rows can be set aside where a listing types them, and not from text")
    if listing and columns:
        by_name = {c.name: c for c in listing}
        listing = [by_name[c] for c in columns]

    slices = None
    if source.format == "jdbc" and split_column is not None:
        slices = asked_slices(spark, source, split_column, _condition(mark, where, lookback_days), query, page_rows)
    elif source.format == "jdbc":
        warnings.warn(f"{source.name} is read through one connection, without split_column", stacklevel=2)
    if mark is None:
        rows = read_full(spark, source, where, columns, query, slices)
    else:
        rows = W.read_incremental(read_full(spark, source, None, columns, query, slices), mark, now, lookback_days)
        kind = rows.schema[mark.column].dataType
        W.slot_for(kind)  # fails before anything is written
        load_no = W.next_load(log, source)
        part_spec = part_spec or f"{LOAD_PARTITION}={load_no:08d}"
    partition = parse_part_spec(part_spec) if part_spec else {}
    refuse_clash(rows, partition)
    evolution = S.evolve(spark, lake_table, listing) if lake_table and listing else None

    path = f"{base}{partition_folder(partition)}/" if partition else base
    staging = staging_path(path)
    try:
        seen = _stage(rows, staging, listing, None if mark is None else W.top_of(mark.column, kind), as_text, reject_limit)
        n_rejected = seen["n_rejected"]
        if reject_limit is not None and n_rejected > reject_limit:
            raise TooManyRejects(f"{n_rejected} rows of {source.name} hold values that do not fit, {reject_limit} are allowed")
        done = Load("full" if mark is None else "incremental", seen["n_rows"] - n_rejected, path, evolution, n_rejected)
        if mark is None:
            return _placed(spark, done, staging, base, f"full-{staging[-32:]}", reject_limit, lake_table)
        if not seen["n_rows"]:
            return Load("incremental", 0, None, evolution)
        with W.claimed(spark, log_path, source, load_no) as check:
            if not W.loads_of(W.read_log(spark, log_path), source).where(F.col("part_spec") == part_spec).isEmpty():
                raise PartitionTaken(f"{path} holds an earlier load that the watermark has passed")
            done = _placed(spark, done, staging, base, f"load-{load_no:08d}", reject_limit, None)
            check()
            W.advance(log_path, W.entry(spark, source, mark.column, kind, seen["top"], now, load_no, part_spec, lookback_days))
        return done
    finally:
        remove_folder(spark, staging)


_KEPT, _ASIDE = "rejected=false", "rejected=true"


def _stage(
    rows: DataFrame, staging: str, listing: Sequence[S.SourceColumn] | None, top: Column | None, as_text: bool, reject_limit: int | None
) -> dict:
    """Write the typed rows; returns their number, maximum and the number of rejected ones, observed on the way."""
    seen = Observation()
    # the watermark column is observed in its source type, also where the lake stores text
    known = [F.count(F.lit(1)).alias("n_rows"), (top if top is not None else F.max(F.lit(None).cast("long"))).alias("top")]
    rows = rows.observe(seen, *known)
    if reject_limit is None:
        typed = S.cast_to_lake(strip_newlines(rows), listing) if listing else strip_newlines(rows)
        if as_text:
            write_text(typed, staging)
        else:
            typed.write.option("compression", PUBLISHED_CODEC).parquet(staging)
        return {**seen.get, "n_rejected": 0}
    bad = Observation()
    checked = S.checked_cast(strip_newlines(rows), listing).observe(bad, F.count(S.REJECTS).alias("n_rejected"))
    parts = checked.withColumn("rejected", F.col(S.REJECTS).isNotNull())
    parts.write.option("compression", PUBLISHED_CODEC).partitionBy("rejected").parquet(staging)
    return {**seen.get, **bad.get}


def _placed(spark: SparkSession, load: Load, staging: str, base: str, name: str, reject_limit: int | None, lake_table: str | None) -> Load:
    """Switch the staged rows in; rejected ones go beside the table's partitions, where its readers do not look."""
    if reject_limit is None:
        switch_folder(spark, staging, load.path)
    else:
        make_folder(spark, f"{staging}/{_KEPT}")  # there may be no good row
        aside = f"{base.rstrip('/')}/_rejects/{name}/"
        full = load.path == base
        if load.n_rejected:
            target = f"{staging}/{_KEPT}/_rejects/{name}/" if full else aside  # a full load replaces the whole folder
            switch_folder(spark, f"{staging}/{_ASIDE}", target)
            load = replace(load, rejects=aside)
        switch_folder(spark, f"{staging}/{_KEPT}", load.path)
    if lake_table and spark.catalog.tableExists(lake_table):
        spark.catalog.refreshTable(lake_table)
    return load


def _condition(mark: W.Watermark | None, where: Column | str | None, lookback_days: int | None) -> str | None:
    """What the database is asked to cut; a wider range than what is read does no harm."""
    if mark is None:
        return where if isinstance(where, str) else None
    if lookback_days is not None or mark.value is None or isinstance(mark.value, Instant):
        return None
    return f"{mark.column} >= {sql_literal(mark.value)}"


def logged_rows(
    spark: SparkSession, source: Source, root: str, log_path: str, org_rules: Sequence[tuple[str, str]] = (("", ""),), schema: T.StructType | None = None
) -> tuple[DataFrame, DataFrame]:
    """The rows of all logged loads of a Parquet table, with the load's number as ``__load``, and the log of these loads.

    All loads named by their number are one scan of the table's folder, however many there are; which of the folders count is
    for the log to say, so rows that a dead load left are not seen. A load into a named partition is a scan of its own.
    ``schema`` spares the reading of all files' footers.
    """
    base = target_path(root, source.host, source.db, source.table, org_rules=org_rules)
    log = W.loads_of(W.read_log(spark, log_path), source)
    numbered = F.col("part_spec").rlike(f"^{LOAD_PARTITION}=[0-9]+$")
    named = log.where(~numbered).select("load_no", "part_spec").collect()
    reader = spark.read.option("mergeSchema", "true")
    parts = []
    if not log.where(numbered).isEmpty():
        reads = reader if schema is None else spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD_PARTITION, T.LongType())]))
        found = reads.option("basePath", base).parquet(f"{base}{LOAD_PARTITION}=*")
        parts.append(found.withColumn("__load", F.col(LOAD_PARTITION).cast("long")).drop(LOAD_PARTITION))
    for r in named:
        reads = reader if schema is None else spark.read.schema(schema)
        parts.append(reads.parquet(f"{base}{partition_folder(parse_part_spec(r['part_spec']))}/").withColumn("__load", F.lit(r["load_no"]).cast("long")))
    if not parts:
        raise ValueError(f"no load of {source.name} is logged")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.drop(S.REJECTS), log


def read_current(
    spark: SparkSession, source: Source, root: str, log_path: str, org_rules: Sequence[tuple[str, str]] = (("", ""),), schema: T.StructType | None = None
) -> DataFrame:
    """The rows of an incrementally loaded Parquet table, each once.

    A load reads again from its predecessor's maximum on, inclusively. So of each load but the last, rows at or after
    its own maximum are left out: the next load holds them as they were then. Rows without a value in the
    incremental column are only read by the first load and stay. Loads with a lookback read more than
    that again, and changed rows are there in each version: ``read_latest`` tells such rows apart by their key.
    """
    rows, log = logged_rows(spark, source, root, log_path, org_rules, schema)
    ends = log.agg(F.max("load_no").alias("last"), F.max("lookback_days").alias("lookback"), F.min("inc_column").alias("column")).first()
    if ends["lookback"] is not None:
        raise ValueError(f"loads of {source.name} looked back: read it by key, with read_latest")
    column = ends["column"]
    bounds = log.select(F.col("load_no").alias("__load"), *[F.col(c).alias(f"__{c}") for c in W.MAXIMA])
    kept = rows.join(bounds, "__load")
    kept = kept.where((F.col("__load") == ends["last"]) | F.col(column).isNull() | _before(column, rows.schema[column].dataType))
    return kept.select(*[c for c in rows.columns if c != "__load"])


def _before(column: str, kind: T.DataType) -> Column:
    """Whether a row lies before its load's maximum; the log has it in the source's type, the lake perhaps as text or double."""
    value, at, clock = F.col(column), F.timestamp_micros("__max_at"), F.col("__max_ts")
    if isinstance(kind, T.TimestampType):
        return value < F.coalesce(at, clock.cast("timestamp"))
    if isinstance(kind, T.TimestampNTZType):
        return value < clock
    if isinstance(kind, T.DateType):
        return value < clock.cast("date")
    if isinstance(kind, T.StringType):
        return F.when(at.isNotNull(), at_utc_clock(value) < at).when(clock.isNotNull(), value.cast("timestamp_ntz") < clock).otherwise(value < F.col("__max_text"))
    if isinstance(kind, T.IntegralType):
        return value < F.col("__max_num")
    if isinstance(kind, T.DecimalType):
        return value < F.col("__max_dec")
    return value < F.coalesce("__max_real", F.col("__max_dec").cast("double"))


def read_latest(
    spark: SparkSession,
    source: Source,
    root: str,
    log_path: str,
    key: Sequence[str],
    changed: str | None = None,
    deleted: Column | str | None = None,
    org_rules: Sequence[tuple[str, str]] = (("", ""),),
    schema: T.StructType | None = None,
) -> DataFrame:
    """The newest version of every row of an incrementally loaded Parquet table, whatever its loads read again.

    Of the rows with one ``key``, the one with the largest ``changed`` (the incremental column unless given) counts, at a tie the one
    that was loaded last, and of equal ones in one load either. Late rows that a lookback found are
    there, and so are changed rows, once. A key whose newest version meets ``deleted`` is left out. A missing change time is older than
    any. Rows without a full key cannot be told to be versions of each other: each different one stays.
    """
    rows, log = logged_rows(spark, source, root, log_path, org_rules, schema)
    changed = changed or log.select("inc_column").first()[0]
    columns = [c for c in rows.columns if c != "__load"]
    content = F.xxhash64(*columns)
    version = F.struct(F.col(changed).alias("at"), F.col("__load").alias("load"), content.alias("content"))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    groups = [F.col(k).alias(f"__key{i}") for i, k in enumerate(key)]
    newest = rows.groupBy(*groups, F.when(no_key, content).alias("__apart")).agg(F.max_by(F.struct(*columns), version).alias("__row")).select("__row.*")
    if deleted is None:
        return newest
    gone = F.expr(deleted) if isinstance(deleted, str) else deleted
    return newest.where(~F.coalesce(gone, F.lit(False)))
