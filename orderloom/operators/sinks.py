"""Writes, snapshots, publishing, audits."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.temporal import run_stamp
from ..functions.text import as_col
from ..session import shuffles_dropped

# Codec of published tables and name of the run partition.
PUBLISHED_CODEC = "gzip"
RUN_PARTITION = "dt"
# Files written for one run only: cheaper to write and read back.
STAGING_CODEC = "zstd"


class UnknownOrganisation(ValueError):
    """No path rule matches the host."""


def target_path(
    root: str,
    host: str,
    db: str,
    table: str,
    part_spec: str | None = None,
    org_rules: Sequence[tuple[str, str]] = (("", ""),),
) -> str:
    """``<root>[/<segment>]/database=<db>/table=<table>/[<part_spec>/]``.

    ``org_rules`` are (text in the host name, path segment), first match wins.
    """
    segment = next((seg for text, seg in org_rules if text in host), None)
    if segment is None:
        raise UnknownOrganisation(f"no lake path rule for host {host!r}")
    parts = [root.rstrip("/"), segment.strip("/"), f"database={db}", f"table={table}", (part_spec or "").strip("/")]
    return "/".join(p for p in parts if p) + "/"


def lake_path(
    root: str,
    host: Column | str,
    db: Column | str,
    table: Column | str,
    part_spec: Column | str,
    org_rules: Sequence[tuple[str, str]],
) -> Column:
    """``target_path`` for a column of tables; an unknown host fails the job."""
    host = as_col(host)
    segment = F.raise_error(F.concat(F.lit("no lake path rule for host "), host))
    for text, seg in reversed(list(org_rules)):
        seg = f"/{seg.strip('/')}" if seg.strip("/") else ""
        segment = F.when(host.contains(text), F.lit(seg)).otherwise(segment)
    spec = F.rtrim(as_col(part_spec), F.lit("/"))
    return F.concat(
        F.lit(root.rstrip("/")), segment, F.lit("/database="), as_col(db), F.lit("/table="), as_col(table), F.lit("/"),
        F.when(spec.isNotNull() & (spec != ""), F.concat(spec, F.lit("/"))).otherwise(""),
    )


def counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The frame, and how many rows it had once it was written: observed by the tasks that write, no second read."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), lambda: seen.get["n_rows"]


def write_parts(parts: DataFrame | Iterable[DataFrame], path: str, codec: str, by: str | None = None) -> DataFrame:
    """Replace a Parquet table by these frames, one after the other, and give back the first.

    A frame's shuffle files go before the next frame is written. ``by`` is a column to make folders of.
    """
    first = None
    for df in [parts] if isinstance(parts, DataFrame) else parts:
        with shuffles_dropped(df.sparkSession):
            write = df.write.mode("append" if first else "overwrite").option("compression", codec)
            (write.partitionBy(by) if by else write).parquet(path)
        first = first or df
    return first


def materialize(
    df: DataFrame | Iterable[DataFrame], path: str, name: str | None = None, codec: str = PUBLISHED_CODEC, by: str | None = None
) -> DataFrame:
    """Rebuild a Parquet table at a path, of one frame or of several, register it if named, and read it back.

    Later steps start from the files: a lost executor never re-runs the steps before.
    """
    df = write_parts(df, path, codec, by)
    spark = df.sparkSession
    if name is not None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet")
        return spark.table(name)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Staging:
    """A folder for what a run keeps between its steps. Files take a fraction of the shuffles they save."""

    spark: SparkSession
    root: str
    write: Callable[..., DataFrame] = materialize

    def keep(self, df: DataFrame | Iterable[DataFrame], name: str, by: str | None = None) -> DataFrame:
        return self.write(df, f"{self.root}/{name}", codec=STAGING_CODEC, by=by)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, f"{self.root}/{name}")


def snapshot_path(root: str, now: datetime) -> str:
    return f"{root.rstrip('/')}/{RUN_PARTITION}={run_stamp(now)}"


class SnapshotTaken(ValueError):
    """A run of the same minute has finished the snapshot, or a table points at it."""


def write_snapshot(
    df: DataFrame | Iterable[DataFrame], root: str, now: datetime, table: str | None = None, spark: SparkSession | None = None
) -> str:
    """A new folder per run. What a failed run left is replaced; a finished snapshot is not.

    With ``table`` only the snapshot that this table points at is safe: a run that died before it published is repeated.
    Several frames, made one after the other, are seen once the last is written; they need ``spark``.
    """
    spark, path = spark or df.sparkSession, snapshot_path(root, now)
    done = jvm_path(spark, path + "/_SUCCESS")
    if table is not None and spark.catalog.tableExists(table):
        if jvm_path(spark, location_of(spark, table)).toUri().getPath() == jvm_path(spark, path).toUri().getPath():
            raise SnapshotTaken(f"{table} points at {path}")
    elif done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        raise SnapshotTaken(f"{path} is the snapshot of an earlier run")
    if isinstance(df, DataFrame):
        write_parts(df, path, PUBLISHED_CODEC)
    else:
        unfinished = f"{root.rstrip('/')}/_unfinished/{path.rsplit('/', 1)[1]}"  # readers pass over the folder above
        try:
            write_parts(df, unfinished, PUBLISHED_CODEC)
        except BaseException:
            remove_folder(spark, unfinished)
            raise
        switch_folder(spark, unfinished, path)
    return path


def jvm_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def location_of(spark: SparkSession, table: str) -> str:
    """The folder a table points at."""
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]


def read_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """All snapshots, with the run stamp as a partition column in text form."""
    df = spark.read.option("basePath", root).parquet(root)
    return df.withColumn(RUN_PARTITION, F.col(RUN_PARTITION).cast("string"))


def publish(spark: SparkSession, table: str, path: str) -> None:
    """Point the table at a snapshot; only the catalog entry changes."""
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
        return
    new = spark.read.parquet(path).schema
    known = {f.name.lower(): f.dataType for f in spark.table(table).schema}
    changed = [f.name for f in new if known.get(f.name.lower(), f.dataType) != f.dataType]
    if changed:
        raise ValueError(f"{table}: the snapshot has other types for {', '.join(changed)}")
    added = [f for f in new if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{quoted}'")
    spark.catalog.refreshTable(table)


def replace_partition(df: DataFrame, root: str, partition: Mapping[str, str], codec: str = PUBLISHED_CODEC) -> None:
    """Replace one partition with these rows and leave the others alone.

    The new files are staged and moved in at commit; without rows nothing changes.
    """
    refuse_clash(df, partition)
    parts = df.withColumns({k: F.lit(v) for k, v in partition.items()})
    (
        parts.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec)
        .partitionBy(*partition)
        .parquet(root)
    )


def refuse_clash(df: DataFrame, partition: Mapping[str, str]) -> None:
    """A column named like a partition would lose its values."""
    both = {k.lower() for k in partition} & {c.lower() for c in df.columns}
    if both:
        raise ValueError(f"columns named like the partition: {', '.join(sorted(both))}")


def partition_folder(partition: Mapping[str, str]) -> str:
    """``a=1/b=2`` with the characters escaped that Spark escapes in folder names."""
    odd = set("\"#%'*/:=?\\{[]^\x7f") | {chr(k) for k in range(32)}
    name = lambda v: "".join(f"%{ord(c):02X}" if c in odd else c for c in v)
    return "/".join(f"{name(k)}={name(v)}" for k, v in partition.items())


def staging_path(path: str) -> str:
    """A new folder beside ``path`` that readers of the parent pass over."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_{name}-{uuid.uuid4().hex}"


def switch_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another one, which is kept until the new one is there."""
    target = jvm_path(spark, path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    aside = jvm_path(spark, staging_path(path))
    had = files.exists(target)
    if had and not files.rename(target, aside):
        raise OSError(f"cannot move {path}")
    if not files.rename(jvm_path(spark, new), target):
        if had:
            files.rename(aside, target)
        raise OSError(f"cannot move {new} to {path}")
    if had:
        files.delete(aside, True)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = jvm_path(spark, path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    target = jvm_path(spark, path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def parse_part_spec(spec: str) -> dict[str, str]:
    """``a=1/b=2`` as a mapping."""
    pairs = [p.split("=", 1) for p in spec.strip("/").split("/") if p]
    if not pairs or any(len(p) != 2 for p in pairs):
        raise ValueError(f"not a partition: {spec!r}")
    return dict(pairs)


def step_audit(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every step, from the written files' metadata, in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("step"), "n_rows") for n, df in steps.items()]
    return reduce(DataFrame.unionAll, counts)
