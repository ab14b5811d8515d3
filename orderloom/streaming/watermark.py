"""Batch high watermark: where the last load of a table stopped.

The log is an append-only Parquet table with one row per committed load. The
maximum is kept typed, so it compares as time or number and not as text: wall-clock times as
they are, zoned ones as instants, which mean the same in every session. Loads of a table have numbers
without gaps; whoever commits one claims the next number first.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import Instant, lookback_start, wall_clock
from ..sources.tables import Source, read_since

KEY_FIELDS = [T.StructField(n, T.StringType()) for n in ("db_name", "db_table", "host", "inc_column")]
CONFIG_SCHEMA = T.StructType(KEY_FIELDS)
LOG_SCHEMA = T.StructType(
    [
        *KEY_FIELDS,
        T.StructField("max_ts", T.TimestampNTZType()),
        T.StructField("max_num", T.LongType()),
        T.StructField("max_text", T.StringType()),
        T.StructField("max_real", T.DoubleType()),
        T.StructField("max_dec", T.DecimalType(38, 18)),
        T.StructField("logged_at", T.TimestampNTZType()),
        T.StructField("load_no", T.LongType()),
        T.StructField("part_spec", T.StringType()),
        T.StructField("max_at", T.LongType()),  # microseconds since 1970 in UTC
        T.StructField("lookback_days", T.IntegerType()),
    ]
)
MAXIMA = ("max_ts", "max_num", "max_text", "max_real", "max_dec", "max_at")
CLAIM_HOURS = 1.0  # after which a claim whose load was never logged is taken for dead; a commit takes seconds
KEY = ["db_name", "db_table", "host"]


@dataclass(frozen=True)
class Watermark:
    column: str
    value: object | None = None


def slot_for(data_type: T.DataType) -> str:
    """Log column that holds maxima of a type."""
    if isinstance(data_type, T.TimestampType):
        return "max_at"
    if isinstance(data_type, (T.TimestampNTZType, T.DateType)):
        return "max_ts"
    if isinstance(data_type, T.IntegralType):
        return "max_num"
    if isinstance(data_type, T.StringType):
        return "max_text"
    if isinstance(data_type, T.FractionalType):
        return "max_dec" if isinstance(data_type, T.DecimalType) else "max_real"
    raise TypeError(f"no watermark on a {data_type.simpleString()} column")


def top_of(column: str, data_type: T.DataType) -> Column:
    """Aggregate that gives a column's maximum as the log holds it."""
    slot = slot_for(data_type)
    top = F.max(F.col(column).cast("timestamp_ntz") if slot == "max_ts" else F.col(column))
    return F.unix_micros(top) if slot == "max_at" else top


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log, empty before the first load."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def latest(log: DataFrame) -> DataFrame:
    """Highest maximum per table."""
    return log.groupBy(*KEY, "inc_column").agg(*[F.max(c).alias(c) for c in MAXIMA])


def lookup_all(config: DataFrame, log: DataFrame) -> DataFrame:
    """Every configured table with its last maximum (NULL before its first load).

    A configuration row without a database name stands for any database.
    """
    last, conf = latest(log).alias("l"), config.alias("c")
    same = (
        (F.col("c.db_table") == F.col("l.db_table"))
        & (F.col("c.host") == F.col("l.host"))
        & (F.col("c.inc_column") == F.col("l.inc_column"))
        & (F.col("c.db_name").isNull() | (F.col("c.db_name") == F.col("l.db_name")))
    )
    return conf.join(last, same, "left").select(
        F.coalesce("l.db_name", "c.db_name").alias("db_name"),
        "c.db_table", "c.host", "c.inc_column", *[f"l.{c}" for c in MAXIMA],
    )


def lookup(config: DataFrame, log: DataFrame, source: Source) -> Watermark | None:
    """Watermark of one table; None when the table is not loaded incrementally."""
    rule = (
        config.where((F.col("db_table") == source.table) & (F.col("host") == source.host))
        .where(F.col("db_name").isNull() | (F.col("db_name") == source.db))
        .orderBy(F.col("db_name").isNull())
        .select("inc_column")
        .first()
    )
    if rule is None:
        return None
    mine = of_table(log, source).where(F.col("inc_column") == rule.inc_column)
    top = mine.agg(*[F.max(c).alias(c) for c in MAXIMA]).first()
    return Watermark(rule.inc_column, _maximum(top.asDict()))


def _maximum(row: dict) -> object | None:
    """The maximum of a log row; an instant counts before a clock's time from an older log."""
    if row["max_at"] is not None:
        return Instant(row["max_at"])
    return next((row[c] for c in MAXIMA if row[c] is not None), None)


def of_table(log: DataFrame, source: Source) -> DataFrame:
    return log.where((F.col("db_name") == source.db) & (F.col("db_table") == source.table) & (F.col("host") == source.host))


def loads_of(log: DataFrame, source: Source) -> DataFrame:
    """A table's committed loads into partitions: a row each."""
    return of_table(log, source).where("part_spec IS NOT NULL")


def next_load(log: DataFrame, source: Source) -> int:
    """Number of a table's next load. A load that died before it was logged leaves its number to the next one."""
    seen = of_table(log, source).agg(F.count(F.lit(1)).alias("n"), F.max("load_no").alias("top")).first()
    return max(seen["n"], seen["top"] or 0) + 1


class LoadOvertaken(RuntimeError):
    """Another load of the table was, or is just being, committed; repeat this one from the new watermark."""


@contextmanager
def claimed(spark: SparkSession, log_path: str, source: Source, load_no: int, hours: float = CLAIM_HOURS) -> Iterator[Callable[[], None]]:
    """Hold a table's next load number while a load is committed. Yields a check to make right before the log row.

    The claim is a file that is created only if it is not there. With it in hand, the log is read again: if the number is
    logged by now, this load started from an old watermark and is refused. The claim goes when the load is
    logged or fails; one that a killed driver left is taken over after ``hours``.
    """
    jvm = spark.sparkContext._jvm
    name = "/".join(quote(x, safe="") for x in (source.db, source.table, source.host))
    path = jvm.org.apache.hadoop.fs.Path(f"{log_path.rstrip('/')}/_claims/{name}/{load_no:08d}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    token = uuid.uuid4().hex

    def create() -> bool:
        try:
            stream = files.create(path, False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        stream.write(bytearray(token.encode()))
        stream.close()
        return True

    def holder() -> str | None:
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def check() -> None:
        if holder() != token:
            raise LoadOvertaken(f"the claim of load {load_no} of {source.name} was taken over")

    if not create():
        if time.time() - files.getFileStatus(path).getModificationTime() / 1000 < hours * 3600:
            raise LoadOvertaken(f"load {load_no} of {source.name} is being committed by another run")
        files.delete(path, False)
        if not create():
            raise LoadOvertaken(f"load {load_no} of {source.name} is being committed by another run")
    try:
        if next_load(read_log(spark, log_path), source) != load_no:
            raise LoadOvertaken(f"load {load_no} of {source.name} was committed by another run")
        yield check
    finally:
        if holder() == token:
            files.delete(path, False)


def read_incremental(
    df: DataFrame, mark: Watermark, now: datetime | None = None, lookback_days: int | None = None
) -> DataFrame:
    """Rows at or after the last maximum, or of the last days when a lookback is set."""
    if lookback_days is None:
        return read_since(df, mark.column, mark.value)
    if now is None:
        raise ValueError("a lookback needs the time of the run")
    return df.where(F.col(mark.column) >= lookback_start(now, lookback_days))


def log_row(
    committed: DataFrame, source: Source, column: str, now: datetime | Column, load_no: int | None = None, part_spec: str | None = None
) -> DataFrame:
    """One log row for data that is already in the lake; none when it is empty."""
    kind = committed.schema[column].dataType
    top = committed.agg(top_of(column, kind).alias("top")).where("top IS NOT NULL")
    values = {
        "db_name": F.lit(source.db),
        "db_table": F.lit(source.table),
        "host": F.lit(source.host),
        "inc_column": F.lit(column),
        slot_for(kind): F.col("top"),
        "logged_at": wall_clock(now),
        "load_no": F.lit(load_no),
        "part_spec": F.lit(part_spec),
    }
    return top.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]
    )


def entry(
    spark: SparkSession, source: Source, column: str, data_type: T.DataType, top: object, now: datetime, load_no: int, part_spec: str, lookback_days: int | None
) -> DataFrame:
    """The log row of a load whose maximum was observed while it was written."""
    values = {
        "db_name": source.db, "db_table": source.table, "host": source.host, "inc_column": column, slot_for(data_type): top,
        "logged_at": now.replace(tzinfo=None), "load_no": load_no, "part_spec": part_spec, "lookback_days": lookback_days,
    }
    return spark.createDataFrame([tuple(values.get(f.name) for f in LOG_SCHEMA)], LOG_SCHEMA)


def advance(log_path: str, row: DataFrame) -> None:
    """Append to the log. Call after the data is committed, never before."""
    row.coalesce(1).write.mode("append").parquet(log_path)
