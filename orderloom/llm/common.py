"""Helpers the corpus operators share."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.session import SHUFFLE_TARGET_BYTES, shared_dir, size_of

#: The white space that separates words.
SPACES = r"\x20\x09-\x0D"


#: A petabyte in shuffle partitions; estimates beyond are taken for unknown.
MOST_PARTITIONS = 1 << 23

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package's code to the Python workers of all executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    if package.is_dir():  # else it came from an archive that was shipped already
        archive = os.path.join(tempfile.mkdtemp(prefix="orderloom-"), "orderloom_code.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Cuts the lineage and fixes the rows: what follows sees the same rows in
    every task attempt, also after an executor is lost.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame) -> int:
    """How many partitions a shuffle of these rows needs: what the session sets, and more where the estimated size asks for it.

    Where Spark has no estimate (rows that are in no file), or one that joins have blown up, the session's number holds.
    """
    wanted = math.ceil(size_of(df) / SHUFFLE_TARGET_BYTES)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), wanted if wanted <= MOST_PARTITIONS else 0)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.array_remove(F.split(text, f"[{SPACES}]+", -1), "")


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_az(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number all rows from 0 in an order; each range of rows is sorted in its own task."""
    dealt = staged(df.repartitionByRange(partitions_for(df), *order).select("*", F.spark_partition_id().alias("__range")), "numbered")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = dealt.groupBy("__range").count().select("__range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    here = Window.partitionBy("__range").orderBy(*order)
    return dealt.join(counts, "__range").select(*df.columns, (F.col("__base") + F.row_number().over(here) - 1).alias(name))
