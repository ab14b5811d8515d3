"""Delimited text as the lake's legacy tables hold it, and CSV control tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import at_utc_clock, utc_clock
from ..functions.text import lenient, strip_newlines

# The text format. No header, columns by position, doubled quotes.
TEXT_FORMAT = {"sep": "\x01", "quote": '"', "escape": '"', "encoding": "UTF-8", "header": "false"}
WATERMARK_COLUMNS = "db_name STRING, DB_TABLE STRING, MAX_DATE STRING, logged_at STRING, HOST STRING"
CONFIG_COLUMNS = "DB_TABLE STRING, HOST STRING, INCREMENTAL_COLUMN_NAME STRING"


def write_text(df: DataFrame, path: str) -> None:
    """NULL becomes empty text; CR and LF are dropped, so one row is one line.

    Times are written as ``yyyy-MM-dd HH:mm:ss``, with a fraction where they have one; zoned ones as UTC.
    """
    flat = strip_newlines(df).select(*[_as_text(f).alias(f.name) for f in df.schema])
    (
        flat.write.mode("overwrite")
        .options(**TEXT_FORMAT)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def _as_text(field: T.StructField) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        return utc_clock(field.name).cast("string")
    return F.col(field.name).cast("string") if isinstance(field.dataType, T.TimestampNTZType) else F.col(field.name)


def _as_time(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return at_utc_clock(value)
    return value.cast(field.dataType)


def read_text(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Columns by position; empty text reads as NULL."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    times = (T.TimestampType, T.TimestampNTZType)
    raw = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, times) else f.dataType) for f in schema])
    lines = spark.read.schema(raw).options(**TEXT_FORMAT).option("nullValue", "").option("mode", "FAILFAST").csv(path)
    return lines.select(*[_as_time(f).alias(f.name) if isinstance(f.dataType, times) else F.col(f.name) for f in schema])


def read_watermark_csv(spark: SparkSession, path: str) -> DataFrame:
    """Legacy watermark log: every maximum as text."""
    return spark.read.schema(WATERMARK_COLUMNS).option("header", True).csv(path)


def read_config_csv(spark: SparkSession, path: str) -> DataFrame:
    """Incremental column per table and host."""
    config = spark.read.schema(CONFIG_COLUMNS).option("header", True).csv(path)
    return config.select(
        F.lit(None).cast("string").alias("db_name"),
        F.col("DB_TABLE").alias("db_table"),
        F.col("HOST").alias("host"),
        F.col("INCREMENTAL_COLUMN_NAME").alias("inc_column"),
    )


def log_from_csv(legacy: DataFrame, config: DataFrame) -> DataFrame:
    """A legacy log as a load log: maxima of configured tables, times typed where they read as times, numbers where as numbers."""
    from ..streaming.watermark import LOG_SCHEMA

    conf, text = config.alias("c"), F.col("l.MAX_DATE")
    same = (F.col("l.DB_TABLE") == F.col("c.db_table")) & (F.col("l.HOST") == F.col("c.host"))
    same &= F.col("c.db_name").isNull() | (F.col("c.db_name") == F.col("l.db_name"))
    number, time = lenient(text, "bigint"), lenient(text, "timestamp_ntz")
    values = {
        "db_name": F.col("l.db_name"), "db_table": F.col("l.DB_TABLE"), "host": F.col("l.HOST"), "inc_column": F.col("c.inc_column"),
        "max_num": number, "max_ts": F.when(number.isNull(), time), "max_text": F.when(number.isNull() & time.isNull(), text),
        "logged_at": lenient(F.col("l.logged_at"), "timestamp_ntz"),
    }
    rows = legacy.alias("l").join(conf, same)
    return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA])
