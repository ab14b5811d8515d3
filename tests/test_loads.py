"""Load control: watermarks, partitions, text, snapshots, schema change."""

from collections import Counter
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators import schema as S
from orderloom.operators import sinks as K
from orderloom.plans import table_load
from orderloom.plans.table_load import load_table
from orderloom.sources import delimited
from orderloom.sources import tables as SRC
from orderloom.streaming import watermark as W

DAYS = [datetime(2024, 1, d, 9, 30) for d in range(1, 9)]
SCHEMA = "id bigint, ts timestamp_ntz, note string"


class Shop:
    """A source table as a folder, and a lake to load it into."""

    def __init__(self, spark, tmp):
        self.spark, self.root, self.log = spark, str(tmp / "lake"), str(tmp / "log")
        self.source = SRC.Source("db-north", "shop", "events", format="parquet", location=str(tmp / "source"))
        self.config = spark.createDataFrame([("shop", "events", "db-north", "ts")], W.CONFIG_SCHEMA)

    def put(self, *data, mode="append"):
        self.spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode(mode).parquet(self.source.location)

    def load(self, now, config=True, **kw):
        return load_table(
            self.spark, self.source, self.root, now, log_path=self.log, config=self.config if config else None, **kw
        )

    def logged(self):
        return [r.max_ts for r in W.read_log(self.spark, self.log).orderBy("logged_at").collect()]

    def ids(self, path):
        return sorted(r.id for r in self.spark.read.parquet(path).collect())


@pytest.fixture
def shop(spark, tmp_path):
    return Shop(spark, tmp_path)


def test_incremental_loads_continue_inclusively(shop):
    shop.put((1, DAYS[0], "a\nb"), (2, DAYS[1], None))
    first = shop.load(DAYS[2])
    assert (first.mode, first.n_rows) == ("incremental", 2)
    assert first.path.endswith("/database=shop/table=events/load=00000001/")
    assert shop.logged() == [DAYS[1]]
    assert sorted(str(r.note) for r in shop.spark.read.parquet(first.path).collect()) == ["None", "ab"]

    shop.put((3, DAYS[1], "equal"), (4, DAYS[3], "new"), (5, DAYS[0], "late"))
    second = shop.load(DAYS[4])
    assert shop.ids(second.path) == [2, 3, 4], "rows at the maximum are read again, older ones are not"
    assert shop.ids(first.path) == [1, 2], "the earlier load stays"
    assert shop.logged() == [DAYS[1], DAYS[3]]


def test_empty_delta_changes_nothing(shop):
    shop.put((1, DAYS[0], "a"))
    shop.load(DAYS[1], part_spec="dt=1")
    shop.put(mode="overwrite")
    load = shop.load(DAYS[2], part_spec="dt=1")
    assert (load.n_rows, load.path) == (0, None)
    assert shop.ids(shop.root + "/database=shop/table=events/dt=1") == [1]
    assert shop.logged() == [DAYS[0]]


def test_watermark_waits_for_the_data(shop, monkeypatch):
    """A load that dies before its log row is repeated from the old watermark, without duplicates."""
    shop.put((1, DAYS[0], "a"))

    def dies(*_):
        raise OSError("lost")

    monkeypatch.setattr(table_load.W, "advance", dies)
    with pytest.raises(OSError):
        shop.load(DAYS[1], part_spec="dt=1")
    monkeypatch.undo()
    assert shop.logged() == []
    shop.put((2, DAYS[2], "b"))
    again = shop.load(DAYS[3], part_spec="dt=1")
    assert shop.ids(again.path) == [1, 2]
    assert shop.logged() == [DAYS[2]]


def test_a_failed_write_logs_nothing(shop, monkeypatch):
    shop.put((1, DAYS[0], "a"))
    monkeypatch.setattr(table_load, "switch_folder", lambda *_, **__: (_ for _ in ()).throw(OSError("full")))
    with pytest.raises(OSError):
        shop.load(DAYS[1])
    assert shop.logged() == []


def test_two_loads_in_one_minute_lose_nothing(shop):
    shop.put(*[(i, DAYS[0], None) for i in range(99)], (99, DAYS[1], None))
    shop.load(DAYS[4])
    shop.put((100, DAYS[1], None), (101, DAYS[2], None), (102, DAYS[3], None))
    shop.load(DAYS[4])
    everything = shop.spark.read.parquet(shop.root + "/database=shop/table=events")
    assert everything.select("id").distinct().count() == 103
    current = table_load.read_current(shop.spark, shop.source, shop.root, shop.log)
    assert sorted(r.id for r in current.collect()) == list(range(103)), "no row twice, none missing"


def test_a_named_partition_is_not_loaded_over(shop):
    shop.put((1, DAYS[0], "a"))
    shop.load(DAYS[1], part_spec="dt=1")
    shop.put((2, DAYS[2], "b"))
    with pytest.raises(table_load.PartitionTaken):
        shop.load(DAYS[3], part_spec="dt=1")
    assert shop.ids(shop.root + "/database=shop/table=events/dt=1") == [1]
    assert shop.logged() == [DAYS[0]]
    assert shop.ids(shop.load(DAYS[3], part_spec="dt=2").path) == [1, 2]


@pytest.mark.parametrize("part_spec", [None, "dt=1", "dt=2024-01-01 10:00/x=a%b"])
def test_an_empty_full_load_empties(shop, part_spec):
    shop.put((1, DAYS[0], "a"), (2, DAYS[1], "b"))
    assert shop.load(DAYS[2], config=False, part_spec=part_spec).n_rows == 2
    load = shop.load(DAYS[3], config=False, where="id > 9", part_spec=part_spec)
    assert load.n_rows == 0
    assert shop.ids(load.path) == []


def test_a_failed_full_load_keeps_the_old_rows(shop):
    shop.put((1, DAYS[0], "a"))
    path = shop.load(DAYS[2], config=False).path
    with pytest.raises(PySparkException):
        shop.load(DAYS[3], config=False, where="raise_error('lost') IS NULL")
    assert shop.ids(path) == [1]


def test_a_column_named_like_the_partition_is_refused(shop):
    shop.put((1, DAYS[0], "a"))
    with pytest.raises(ValueError, match="note"):
        shop.load(DAYS[1], part_spec="NOTE=x")
    with pytest.raises(ValueError, match="id"):
        K.replace_partition(shop.spark.range(2), shop.root, {"id": "1"})


def test_columns_restrict_the_listing_and_the_first_load_needs_no_table(shop):
    shop.put((1, DAYS[0], "a"))
    listed = S.read_listing(shop.spark, shop.source)
    load = shop.load(DAYS[1], config=False, columns=["note", "id"], listing=listed, lake_table="not_there_yet")
    assert load.evolution == S.Evolution((), ())
    assert shop.spark.read.parquet(load.path).dtypes == [("note", "string"), ("id", "bigint")]


def test_an_unusable_watermark_column_fails_before_the_write(shop, tmp_path):
    shop.spark.range(2).selectExpr("array(id) AS ts").write.parquet(shop.source.location)
    with pytest.raises(TypeError):
        shop.load(DAYS[1])
    assert not (tmp_path / "lake").exists()


def test_defaults_of_a_catalog_table_are_listed(spark, tmp_path):
    spark.sql(f"CREATE TABLE listed (a INT, b INT DEFAULT 7) USING parquet LOCATION '{tmp_path}/listed'")
    found = S.read_listing(spark, SRC.Source("h", "default", "listed", format="catalog"))
    assert found == [S.SourceColumn("a", "int"), S.SourceColumn("b", "int", "7")]
    spark.sql("DROP TABLE listed")


def test_a_snapshot_of_another_type_is_not_published(spark, tmp_path):
    root, table = str(tmp_path / "it's"), "typed_once"
    K.publish(spark, table, K.write_snapshot(spark.range(3), root, DAYS[0]))
    with pytest.raises(ValueError, match="id"):
        K.publish(spark, table, K.write_snapshot(spark.range(3).selectExpr("CAST(id AS STRING) AS id"), root, DAYS[1]))
    assert spark.table(table).count() == 3
    K.publish(spark, table, K.write_snapshot(spark.range(5).selectExpr("id AS ID", "1 AS n"), root, DAYS[2]))
    assert spark.table(table).columns == ["id", "n"]
    assert spark.table(table).count() == 5
    spark.sql(f"DROP TABLE {table}")


def test_times_in_text_have_one_format(spark, tmp_path):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' a, TIMESTAMP '2024-01-01 10:00:00' b, TIMESTAMP_NTZ '2024-01-01 10:00:00.5' c")
    delimited.write_text(df, str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).first().value == "2024-01-01 10:00:00\x012024-01-01 10:00:00\x012024-01-01 10:00:00.5"
    assert delimited.read_text(spark, str(tmp_path / "t"), df.schema).collect() == df.collect()


def test_legacy_log_continues_a_load(shop, tmp_path):
    shop.put((1, DAYS[0], "a"), (2, DAYS[2], "b"))
    (tmp_path / "log.csv").write_text("db_name,DB_TABLE,MAX_DATE,logged_at,HOST\nshop,events,2024-01-02 09:30:00,x,db-north\nshop,other,9,x,db-north\n")
    W.advance(shop.log, delimited.log_from_csv(delimited.read_watermark_csv(shop.spark, str(tmp_path / "log.csv")), shop.config))
    assert shop.logged() == [DAYS[1]]
    assert shop.ids(shop.load(DAYS[4]).path) == [2]


def test_full_load_without_config_row_uses_where(shop):
    shop.put((1, DAYS[0], "a"), (2, DAYS[1], "b"))
    load = shop.load(DAYS[2], config=False, where="id = 2", columns=["id", "note"])
    assert (load.mode, load.n_rows) == ("full", 1)
    assert shop.spark.read.parquet(load.path).columns == ["id", "note"]
    assert shop.logged() == []


def test_text_load_types_and_reads_back(shop):
    listing = [S.SourceColumn("id", "bigint"), S.SourceColumn("ts", "datetime"), S.SourceColumn("note", "text")]
    shop.put((1, DAYS[0], 'say "hi"\r\nnow'), (2, DAYS[1], ""))
    load = shop.load(DAYS[2], as_text=True, listing=listing)
    lines = sorted(r.value for r in shop.spark.read.text(load.path).collect())
    assert lines == ['1\x012024-01-01 09:30:00\x01"say ""hi""now"', "2\x012024-01-02 09:30:00\x01"]
    assert shop.logged() == [DAYS[1]]


def test_lookback_replaces_the_watermark(shop):
    shop.put(*[(i, d, None) for i, d in enumerate(DAYS)])
    shop.load(DAYS[7])
    again = shop.load(DAYS[7], lookback_days=2, part_spec="dt=x")
    assert shop.ids(again.path) == [5, 6, 7]
    with pytest.raises(ValueError):
        W.read_incremental(shop.spark.range(1), W.Watermark("id"), lookback_days=1)


def test_incremental_columns_must_hold_the_watermark(shop):
    shop.put((1, DAYS[0], "a"))
    with pytest.raises(ValueError):
        shop.load(DAYS[1], columns=["id"])


def test_lookup_separates_hosts_and_databases(spark):
    log = spark.createDataFrame(
        [
            ("a", "t", "h1", "n", None, 9, None, None, None, DAYS[0], None, None, None, None),
            ("a", "t", "h1", "n", None, 10, None, None, None, DAYS[1], None, None, None, None),
            ("a", "t", "h2", "n", None, 99, None, None, None, DAYS[0], None, None, None, None),
            ("b", "t", "h1", "n", None, 77, None, None, None, DAYS[0], None, None, None, None),
        ],
        W.LOG_SCHEMA,
    )
    config = spark.createDataFrame([(None, "t", "h1", "n"), ("c", "u", "h1", "ts")], W.CONFIG_SCHEMA)

    def mark(db, table, host):
        return W.lookup(config, log, SRC.Source(host, db, table))

    assert mark("a", "t", "h1") == W.Watermark("n", 10), "numbers compare as numbers"
    assert mark("b", "t", "h1") == W.Watermark("n", 77)
    assert mark("a", "t", "h2") is None, "no configuration: loaded in full"
    assert mark("c", "u", "h1") == W.Watermark("ts", None), "configured but never loaded"
    assert mark("d", "u", "h1") is None
    found = {(r.db_name, r.db_table): r.max_num for r in W.lookup_all(config, log).collect()}
    assert found == {("a", "t"): 10, ("b", "t"): 77, ("c", "u"): None}


def test_log_row_types(spark):
    src = SRC.Source("h", "d", "t")
    df = spark.createDataFrame([(1, "b", DAYS[0], 1.5), (2, "a", DAYS[1], 2.5)], "n int, s string, t timestamp_ntz, x double")
    assert W.log_row(df, src, "n", DAYS[2]).first().max_num == 2
    assert W.log_row(df, src, "s", DAYS[2]).first().max_text == "b"
    assert W.log_row(df.select(F.to_date("t").alias("t")), src, "t", DAYS[2]).first().max_ts == datetime(2024, 1, 2)
    assert W.log_row(df.where("n > 5"), src, "n", DAYS[2]).isEmpty()
    assert W.log_row(df, src, "x", DAYS[2]).first().max_real == 2.5
    exact = df.select(F.col("x").cast("decimal(12,3)").alias("x"))
    assert W.log_row(exact, src, "x", DAYS[2]).first().max_dec == Decimal("2.5")
    with pytest.raises(TypeError):
        W.log_row(df.select(F.array("n").alias("a")), src, "a", DAYS[2])


def test_control_csv(spark, tmp_path):
    (tmp_path / "log.csv").write_text("db_name,DB_TABLE,MAX_DATE,logged_at,HOST\nd,t,2024-01-01 00:00:00,x,h\n")
    (tmp_path / "conf.csv").write_text("DB_TABLE,HOST,INCREMENTAL_COLUMN_NAME\nt,h,ts\n")
    assert delimited.read_watermark_csv(spark, str(tmp_path / "log.csv")).first().MAX_DATE == "2024-01-01 00:00:00"
    config = delimited.read_config_csv(spark, str(tmp_path / "conf.csv"))
    empty = spark.createDataFrame([], W.LOG_SCHEMA)
    assert W.lookup(config, empty, SRC.Source("h", "d", "t")) == W.Watermark("ts", None)


def test_target_path():
    rules = [("north", ""), ("south", "/EU")]
    assert K.target_path("s3://lake/", "db-north", "d", "t", None, rules) == "s3://lake/database=d/table=t/"
    assert K.target_path("/lake", "db-south", "d", "t", "dt=1/", rules) == "/lake/EU/database=d/table=t/dt=1/"
    with pytest.raises(K.UnknownOrganisation):
        K.target_path("/lake", "db-west", "d", "t", None, rules)


def test_lake_path_column_fails_on_unknown_hosts(spark):
    df = spark.createDataFrame([("db-south", "dt=1"), ("db-north", None), ("db-south", "")], "h string, p string")
    path = K.lake_path("/lake", "h", F.lit("d"), F.lit("t"), "p", [("north", ""), ("south", "EU")])
    assert [r[0] for r in df.select(path).collect()] == [
        "/lake/EU/database=d/table=t/dt=1/", "/lake/database=d/table=t/", "/lake/EU/database=d/table=t/",
    ]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("west", "x")], "h string, p string").select(path).collect()


def test_part_spec():
    assert K.parse_part_spec("a=1/b=x=y/") == {"a": "1", "b": "x=y"}
    for wrong in ("", "a", "a=1/b"):
        with pytest.raises(ValueError):
            K.parse_part_spec(wrong)


def test_text_round_trip(spark, tmp_path):
    values = ["plain", "cr\rlf\ncrlf\r\n", "ctrl\x01a", 'quote "x"', 'end"', "back\\slash", " padded ", "", None, "ünï"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    delimited.write_text(df, str(tmp_path / "t"))
    got = {r.i: r.v for r in delimited.read_text(spark, str(tmp_path / "t"), df.schema).collect()}
    want = {i: (v.replace("\r", "").replace("\n", "") or None) if v else None for i, v in enumerate(values)}
    assert got == want


def listing(*names, default=None):
    return [S.SourceColumn(n, "int(11)", default) for n in names]


def target(*names):
    return T.StructType([T.StructField(n, T.IntegerType()) for n in names])


@pytest.mark.parametrize(
    "source, lake, statuses",
    [
        (listing("a", "b"), target("a", "b"), ["same", "same"]),
        (listing("a", "b"), target("a"), ["same", "added"]),
        (listing("a", "x"), target("a", "b"), ["same", "mismatch"]),
        (listing("a"), target("a", "b"), ["same", "extra"]),
        (listing("a", "n", "b"), target("a", "b"), ["same", "mismatch", "added"]),
        (listing("a"), target(), ["no_target"]),
    ],
)
def test_schema_diff(spark, source, lake, statuses):
    assert [r.status for r in S.schema_diff(spark, source, lake).orderBy("position").collect()] == statuses


def test_suspect_columns(spark):
    src = listing("a") + listing("b", default="0") + listing("c")
    assert [r.is_suspect for r in S.schema_diff(spark, src, target("a")).orderBy("position").collect()] == [False, True, False]


def test_evolve(spark, tmp_path):
    spark.range(3).select(F.col("id").cast("int").alias("a")).write.parquet(str(tmp_path / "t"))
    spark.catalog.createTable("evolving", path=str(tmp_path / "t"), source="parquet")
    done = S.evolve(spark, "evolving", listing("a") + [S.SourceColumn("b", "decimal(10,2)", "0"), S.SourceColumn("c", "datetime")])
    assert done == S.Evolution(("b", "c"), ("b",))
    assert dict(spark.table("evolving").dtypes) == {"a": "int", "b": "double", "c": "string"}
    assert spark.table("evolving").where("b IS NULL AND c IS NULL").count() == 3
    assert S.evolve(spark, "evolving", listing("a", "b", "c")) == S.Evolution((), ())
    for wrong in (listing("a", "x", "c"), listing("a")):
        with pytest.raises(S.SchemaMismatch):
            S.evolve(spark, "evolving", wrong)
    spark.sql("DROP TABLE evolving")


@pytest.mark.parametrize(
    "source, lake",
    [
        ("int(11)", "int"), ("INT UNSIGNED", "int"), ("integer", "int"), ("smallint(6)", "int"), ("mediumint(9)", "int"),
        ("tinyint(1)", "tinyint"), ("bigint(20)", "bigint"), ("float", "double"), ("decimal(12,4)", "double"),
        ("double", "double"), ("bit(1)", "boolean"), ("varchar(255)", "string"), ("datetime", "string"),
        ("timestamp", "string"), ("date", "string"), ("time", "string"), ("enum('a')", "string"), ("json", "string"),
    ],
)
def test_type_map(source, lake):
    assert S.to_lake_type(source).simpleString() == lake


def test_exact_decimals():
    assert S.to_lake_type("decimal(12,4)", exact_decimal=True) == T.DecimalType(12, 4)
    assert S.to_lake_type("decimal(12)", exact_decimal=True) == T.DecimalType(12, 0)


def test_snapshot_publish_and_failure(spark, tmp_path):
    """A failing run leaves the table on its last snapshot."""
    root, table = str(tmp_path / "s"), "published_once"
    K.publish(spark, table, K.write_snapshot(spark.range(3), root, DAYS[0]))
    broken = spark.range(5).select(F.expr("IF(id = 4, raise_error('bad'), id) AS id").cast("bigint"))
    with pytest.raises(PySparkException):
        K.publish(spark, table, K.write_snapshot(broken, root, DAYS[1]))
    assert spark.table(table).count() == 3
    K.publish(spark, table, K.write_snapshot(spark.range(7), root, DAYS[2]))
    assert spark.table(table).count() == 7
    spark.sql(f"DROP TABLE {table}")


class Recorder:
    """Stands in for a session and records how a reader is set up; no database is started."""

    def __init__(self):
        self.read, self.seen = self, {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **kw):
        self.seen.update(kw)
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def load(self, *_):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.seen |= {"table": table, "predicates": predicates}
        return self


ORDERS = SRC.Source("h", "shop", "orders", location="jdbc:mysql://h/shop", options={"user": "u"})


def test_jdbc_reads_in_slices():
    common = {"format": "jdbc", "user": "u", "url": "jdbc:mysql://h/shop", "fetchsize": "70000", "preferTimestampNTZ": "true"}
    session = Recorder()
    SRC.read_full(session, ORDERS, slices=["id < 5", "id >= 5", "id IS NULL"])
    assert session.seen == common | {"table": "shop.orders", "predicates": ["id < 5", "id >= 5", "id IS NULL"]}
    session = Recorder()
    SRC.read_full(session, ORDERS, query="SELECT 1 AS id", slices=["id < 5", "id >= 5"])
    assert session.seen == common | {"table": "(SELECT 1 AS id) q", "predicates": ["id < 5", "id >= 5"]}
    session = Recorder()
    SRC.read_full(session, ORDERS, query="SELECT 1")
    assert session.seen == common | {"query": "SELECT 1"}
    session = Recorder()
    SRC.read_full(session, ORDERS)
    assert session.seen == common | {"dbtable": "shop.orders"}


@pytest.fixture
def database(spark, monkeypatch):
    """Answers what a database is asked, from the checking database; returns what was asked."""
    import duckdb

    db, asked = duckdb.connect(), []
    db.sql("CREATE SCHEMA shop")

    def answer(session, source, query):
        asked.append(query)
        found = db.sql(query)
        kinds = {"BIGINT": "bigint", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "INTEGER": "int"}
        return spark.createDataFrame(found.fetchall(), ", ".join(f"{c} {kinds[str(t)]}" for c, t in zip(found.columns, found.types)))

    monkeypatch.setattr(SRC, "_read_query", answer)
    return db, asked


def slices_hold_everything(db, table, predicates):
    """Rows in each slice; every row is in exactly one."""
    inside = [db.sql(f"SELECT count(*) FROM {table} WHERE {p}").fetchall()[0][0] for p in predicates]
    once = " + ".join(f"CAST(coalesce({p}, false) AS INT)" for p in predicates)
    assert db.sql(f"SELECT count(*) FROM {table} WHERE {once} <> 1").fetchall()[0][0] == 0
    return inside


def test_a_database_cuts_its_slices(spark, database):
    db, asked = database
    # 90 of 100 rows in one hundredth of the key's range, some keys repeated, some missing
    db.sql("""CREATE TABLE shop.orders AS
        SELECT CASE WHEN i % 50 = 0 THEN NULL WHEN i % 10 = 1 THEN i * 1000 ELSE i % 9000 END AS id,
               TIMESTAMP '2024-01-01' + INTERVAL (i * i % 977) MINUTE AS ts, 'it''s ' || CAST(i * 7 % 3001 AS VARCHAR) AS name
        FROM range(100000) t(i)""")
    for column in ("id", "ts", "name"):
        found = SRC.asked_slices(spark, ORDERS, column, page_rows=5000)
        rows = slices_hold_everything(db, "shop.orders", found)
        assert 15 <= len(found) <= 21 and max(rows) <= 2 * 5000
    asked.clear()
    found = SRC.asked_slices(spark, ORDERS, "id", "id >= 5", page_rows=50000)
    assert asked == [
        "SELECT COUNT(*) AS n_rows FROM shop.orders WHERE (id >= 5)",
        "SELECT slice, MIN(id) AS low FROM (SELECT id, NTILE(2) OVER (ORDER BY id) AS slice FROM shop.orders "
        "WHERE (id >= 5) AND (id IS NOT NULL)) s GROUP BY slice",
    ]
    slices_hold_everything(db, "shop.orders", found)
    asked.clear()
    query = "SELECT id % 100 AS k FROM shop.orders"
    rows = slices_hold_everything(db, f"({query}) q", SRC.asked_slices(spark, ORDERS, "k", query=query, page_rows=10000))
    assert all(f"FROM ({query}) q" in text for text in asked) and max(rows) <= 20000
    assert SRC.asked_slices(spark, ORDERS, "id", page_rows=100000) is None
    assert len(SRC.asked_slices(spark, ORDERS, "name", page_rows=1, max_slices=7)) == 8
    db.sql("CREATE TABLE shop.same AS SELECT 5 AS id, CAST(NULL AS INT) AS n FROM range(10)")
    same = SRC.Source("h", "shop", "same", location="jdbc:x")
    for column in ("id", "n"):
        assert SRC.asked_slices(spark, same, column, page_rows=2) == [f"{column} IS NOT NULL", f"{column} IS NULL"]
    assert SRC.sql_literal("it's") == "'it''s'"


def test_a_database_counts_itself(spark, database):
    db, asked = database
    db.sql("CREATE TABLE shop.orders AS SELECT i AS id FROM range(10) t(i)")
    assert SRC.source_count(spark, ORDERS, "id > 3").collect() == [(6,)]
    assert SRC.source_count(spark, ORDERS, query="SELECT 1 AS a FROM shop.orders WHERE id > 7").collect() == [(2,)]
    assert asked == ["SELECT COUNT(*) AS n_rows FROM shop.orders WHERE (id > 3)", "SELECT COUNT(*) AS n_rows FROM (SELECT 1 AS a FROM shop.orders WHERE id > 7) q"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_predicates_and_watermarks_reach_the_scan(spark, tmp_path):
    src = SRC.Source("h", "d", "t", format="parquet", location=str(tmp_path / "t"))
    spark.sql("SELECT id, TIMESTAMP_NTZ '2024-01-01' AS n, TIMESTAMP '2024-01-01' AS z, CAST('2024-01-01' AS DATE) AS d FROM range(5)").write.parquet(src.location)
    rows = SRC.read_full(spark, src, where="id > 3", columns=["id"])
    assert "GreaterThan(id,3)" in plan_of(rows) and "ReadSchema: struct<id:bigint>" in plan_of(rows)
    for column, value in (("n", DAYS[0]), ("d", DAYS[0]), ("z", W.Instant(10**15)), ("id", 3)):
        assert f"GreaterThanOrEqual({column}," in plan_of(SRC.read_since(SRC.read_full(spark, src), column, value))


def test_slices_of_spark_tables(spark, tmp_path):
    src = SRC.Source("h", "d", "t", format="parquet", location=str(tmp_path / "t"))
    spark.sql("SELECT CASE WHEN id % 10 = 0 THEN id * 1000 WHEN id % 7 = 0 THEN NULL ELSE id END AS k FROM range(20000)").write.parquet(src.location)
    df = SRC.read_full(spark, src)
    found = [df.where(p).count() for p in SRC.asked_slices(spark, src, "k", page_rows=1000)]
    assert sum(found) == 20000 and max(found[:-1]) <= 2000


# ---- loads in other zones, at the same time, again and again


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zones", [("Asia/Kolkata", "UTC", "America/New_York"), ("America/New_York", "Asia/Kolkata", "UTC"), ("UTC", "Pacific/Kiritimati", "Asia/Kolkata")])
@pytest.mark.parametrize("listed", [False, True])
def test_zoned_times_mean_the_same_in_every_session(spark, shop, zone, zones, listed):
    hours = spark.range(20).select("id", F.timestamp_micros(F.col("id") * 3_600_000_000 + 1_730_600_000_123_456).alias("ts"), F.lit("x").alias("note"))
    listing = [S.SourceColumn("id", "bigint"), S.SourceColumn("ts", "timestamp"), S.SourceColumn("note", "text")] if listed else None
    pulled = []
    for name, upto in zip(zones, (9, 14, 20)):
        zone(name)
        hours.where(F.col("id") < upto).write.mode("overwrite").parquet(shop.source.location)
        pulled.append(shop.load(DAYS[0], listing=listing).n_rows)
        current = table_load.read_current(spark, shop.source, shop.root, shop.log)
        assert sorted(r.id for r in current.select("id").collect()) == list(range(upto))
    assert pulled == [9, 6, 7], "each load reads again from the last one's maximum on"
    if listed:
        text = table_load.read_current(spark, shop.source, shop.root, shop.log).where("id = 0").first().ts
        assert text == "2024-11-03 02:13:20.123456", "text shows UTC, also in the hour that a zone has twice"


@pytest.mark.parametrize("name", ["Asia/Kolkata", "America/New_York"])
def test_clocks_and_days_are_no_instants(spark, shop, zone, name):
    zone(name)
    shop.put((1, DAYS[0], "a"), (2, DAYS[1], "b"))
    shop.load(DAYS[2])
    shop.put((3, DAYS[1], "c"))
    assert shop.ids(shop.load(DAYS[3]).path) == [2, 3]
    assert shop.logged() == [DAYS[1], DAYS[1]]
    assert {r.logged_at for r in W.read_log(spark, shop.log).collect()} == {DAYS[2], DAYS[3]}
    assert shop.ids(shop.load(DAYS[2], lookback_days=1).path) == [2, 3]
    days = spark.sql("SELECT DATE '2024-01-05' AS ts, 1 AS id UNION ALL SELECT DATE '2024-01-04', 2")
    assert [r.id for r in SRC.read_since(days, "ts", datetime(2024, 1, 5)).collect()] == [1]
    assert [r.id for r in SRC.read_since(days.selectExpr("id", "CAST(ts AS TIMESTAMP) AS ts"), "ts", datetime(2024, 1, 5)).collect()] == [1], "an older log's time is one of the session's zone"


def test_an_overtaken_load_is_refused(shop, monkeypatch, tmp_path):
    """Two loads that start from one watermark: the second to commit leaves the first one's rows alone."""
    shop.put(*[(i, DAYS[0], None) for i in range(50)])
    stage = table_load._stage

    def meanwhile(*args):
        monkeypatch.undo()
        shop.put(*[(i, DAYS[1], None) for i in range(50, 103)])
        assert shop.load(DAYS[2]).n_rows == 103
        return stage(*args)

    monkeypatch.setattr(table_load, "_stage", meanwhile)
    with pytest.raises(table_load.LoadOvertaken):
        shop.load(DAYS[3])
    current = table_load.read_current(shop.spark, shop.source, shop.root, shop.log)
    assert sorted(r.id for r in current.collect()) == list(range(103))
    left = [p.name for p in (tmp_path / "lake/database=shop/table=events").iterdir()]
    assert left == ["load=00000001"], "nothing staged is left behind"
    assert shop.load(DAYS[3]).path.endswith("load=00000002/"), "repeated, it goes on from the new watermark"


def test_one_claim_at_a_time(spark, shop):
    with W.claimed(spark, shop.log, shop.source, 1) as check:
        check()
        with pytest.raises(table_load.LoadOvertaken, match="being committed"):
            with W.claimed(spark, shop.log, shop.source, 1):
                pass
        other = SRC.Source("db-north", "shop", "a/b c", format="parquet", location="x")
        with W.claimed(spark, shop.log, other, 1):
            pass
        shop.put((1, DAYS[0], "a"))
        with pytest.raises(table_load.LoadOvertaken):
            shop.load(DAYS[1])
        with W.claimed(spark, shop.log, shop.source, 1, hours=0):  # the first one is taken for dead
            with pytest.raises(table_load.LoadOvertaken, match="taken over"):
                check()
    assert shop.load(DAYS[1]).n_rows == 1
    with pytest.raises(table_load.LoadOvertaken, match="was committed"):
        with W.claimed(spark, shop.log, shop.source, 1):
            pass


def test_a_full_load_does_not_delete_logged_loads(shop):
    shop.put((1, DAYS[0], "a"))
    path = shop.load(DAYS[1]).path
    none = shop.spark.createDataFrame([], W.CONFIG_SCHEMA)
    with pytest.raises(table_load.PartitionTaken):
        load_table(shop.spark, shop.source, shop.root, DAYS[2], log_path=shop.log, config=none)
    assert shop.ids(path) == [1]


def test_a_thousand_loads_are_one_scan(spark, shop, tmp_path):
    n, kinds = 1000, "id bigint, ts timestamp_ntz, note string"
    rows = spark.range(3 * n).selectExpr("CAST(id DIV 3 + 1 AS INT) AS load", "id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, id DIV 2) AS ts", "'x' AS note")
    base = shop.root + "/database=shop/table=events"
    rows.repartition(4, "load").write.partitionBy("load").parquet(base + "_plain")
    (tmp_path / "lake/database=shop/table=events").mkdir()
    for folder in (tmp_path / "lake/database=shop/table=events_plain").glob("load=*"):
        folder.rename(tmp_path / "lake/database=shop/table=events" / f"load={int(folder.name[5:]):08d}")
    log = rows.groupBy("load").agg(F.max("ts").alias("max_ts"))
    values = {"db_name": F.lit("shop"), "db_table": F.lit("events"), "host": F.lit("db-north"), "inc_column": F.lit("ts"), "max_ts": F.col("max_ts"),
              "logged_at": F.col("max_ts"), "load_no": F.col("load"), "part_spec": F.format_string("load=%08d", "load")}
    W.advance(shop.log, log.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in W.LOG_SCHEMA]))
    current = table_load.read_current(spark, shop.source, shop.root, shop.log, schema=T.StructType.fromDDL(kinds))
    assert plan_of(current).count("FileScan parquet [id") == 1 and "Union" not in plan_of(current)
    want = rows.join(log.select("load", F.col("max_ts").alias("top")), "load").where(f"load = {n} OR ts < top").count()
    assert current.count() == want
    assert W.next_load(W.read_log(spark, shop.log), shop.source) == n + 1


def test_named_and_numbered_loads_and_new_columns_are_read_together(shop):
    shop.put((1, DAYS[0], "a"), (2, DAYS[1], "b"))
    shop.load(DAYS[2], part_spec="dt=2024-01-01 10:00/x=a%b")
    shop.put((3, DAYS[2], "c"))
    shop.load(DAYS[3])
    more = shop.spark.createDataFrame([(4, DAYS[3], "d", 9), (5, None, "e", 9)], SCHEMA + ", extra int")
    more.write.mode("overwrite").parquet(shop.source.location)
    shop.load(DAYS[4])
    got = table_load.read_current(shop.spark, shop.source, shop.root, shop.log).select("id", "note", "extra").collect()
    assert sorted(map(tuple, got)) == [(1, "a", None), (2, "b", None), (4, "d", 9)], "the last load holds no rows of the boundary any more"


def test_unlogged_folders_are_not_read(shop, monkeypatch):
    shop.put((1, DAYS[0], "a"))
    shop.load(DAYS[1])
    shop.put((2, DAYS[2], "b"))
    monkeypatch.setattr(table_load.W, "advance", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        shop.load(DAYS[3])
    monkeypatch.undo()
    current = lambda: sorted(r.id for r in table_load.read_current(shop.spark, shop.source, shop.root, shop.log).collect())
    assert current() == [1]
    shop.load(DAYS[3])
    assert current() == [1, 2]


def test_latest_versions(spark, shop):
    key_rows = [(1, DAYS[0], "a"), (2, DAYS[1], "b"), (3, DAYS[1], "c"), (None, DAYS[0], "no key"), (None, DAYS[0], "other"), (4, None, "no time")]
    shop.put(*key_rows)
    shop.load(DAYS[2])
    shop.put((2, DAYS[3], "b2"), (5, DAYS[0], "late, missed"), (4, DAYS[2], "timed"))
    shop.load(DAYS[3])
    shop.put((6, DAYS[1], "late, found"), (3, DAYS[4], "gone"), (None, DAYS[0], "no key"))
    shop.load(DAYS[5], lookback_days=5)
    with pytest.raises(ValueError, match="read_latest"):
        table_load.read_current(spark, shop.source, shop.root, shop.log)
    latest = table_load.read_latest(spark, shop.source, shop.root, shop.log, ["id"], deleted="note = 'gone'")
    got = sorted(((r.id, r.note) for r in latest.collect()), key=str)
    assert got == sorted([(1, "a"), (2, "b2"), (4, "timed"), (5, "late, missed"), (6, "late, found"), (None, "no key"), (None, "other")], key=str)
    assert table_load.read_latest(spark, shop.source, shop.root, shop.log, ["id"], deleted=F.lit(None)).count() == 8
    assert table_load.read_latest(spark, shop.source, shop.root, shop.log, ["note", "id"], changed="ts").columns == ["id", "ts", "note"]


def test_a_hot_key_has_one_latest_version(spark, shop):
    spark.range(20000).selectExpr("CASE WHEN id % 3 = 0 THEN id ELSE -1 END AS id", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "CAST(id AS STRING) AS note").write.parquet(shop.source.location)
    shop.load(DAYS[0])
    latest = table_load.read_latest(spark, shop.source, shop.root, shop.log, ["id"])
    assert latest.count() == 6667 + 1 and latest.where("id = -1").first().note == "19999"


# ---- values that do not fit


LISTED = [S.SourceColumn("id", "int(11)"), S.SourceColumn("ts", "datetime"), S.SourceColumn("price", "decimal(10,2)"), S.SourceColumn("flag", "tinyint")]


def put_prices(shop):
    rows = [("1", DAYS[0], "2.5", 1), ("x", DAYS[1], "3", 1), ("3", DAYS[1], "n/a", 300), ("4", DAYS[2], None, None), ("99999999999", DAYS[2], "1e3", 2), ("6", DAYS[2], "", 2)]
    shop.spark.createDataFrame(rows, "id string, ts timestamp_ntz, price string, flag int").write.mode("overwrite").parquet(shop.source.location)


def test_values_that_do_not_fit_are_set_aside(spark, shop):
    put_prices(shop)
    with pytest.raises(PySparkException):
        shop.load(DAYS[3], listing=LISTED)
    with pytest.raises(table_load.TooManyRejects, match="4 rows"):
        shop.load(DAYS[3], listing=LISTED, reject_limit=3)
    assert shop.logged() == []
    load = shop.load(DAYS[3], listing=LISTED, reject_limit=4)
    assert (load.n_rows, load.n_rejected) == (2, 4)
    current = table_load.read_current(spark, shop.source, shop.root, shop.log)
    assert current.dtypes == [("id", "int"), ("ts", "string"), ("price", "double"), ("flag", "tinyint")]
    assert sorted(map(tuple, current.select("id", "price", "flag").collect())) == [(1, 2.5, 1), (4, None, None)]
    wrong = spark.read.parquet(load.rejects).select("ts", F.explode(S.REJECTS).alias("r")).select("r.*").collect()
    assert sorted(map(tuple, wrong)) == [("flag", "300", "no tinyint"), ("id", "99999999999", "no int"), ("id", "x", "no int"), ("price", "", "no double"), ("price", "n/a", "no double")]
    assert shop.logged() == [DAYS[2]], "a row that is set aside counts for the watermark"
    with pytest.raises(ValueError):
        shop.load(DAYS[3], reject_limit=1)


def test_a_full_load_sets_aside_too(spark, shop):
    put_prices(shop)
    load = shop.load(DAYS[3], config=False, listing=LISTED, reject_limit=10)
    assert sorted(r.id for r in spark.read.parquet(load.path).collect()) == [1, 4]
    assert spark.read.parquet(load.rejects).count() == 4
    again = shop.load(DAYS[4], config=False, listing=LISTED, reject_limit=10, where="flag = 1 AND id = '1'")
    assert (again.n_rows, again.rejects) == (1, None) and spark.read.parquet(again.path).count() == 1
    none = shop.load(DAYS[4], config=False, listing=LISTED, reject_limit=10, where="id = 'x'")
    assert (none.n_rows, none.n_rejected) == (0, 1)


def test_a_finished_snapshot_is_not_rewritten(spark, tmp_path):
    root, table = str(tmp_path / "s"), "in_one_minute"
    path = K.write_snapshot(spark.range(3), root, DAYS[0])
    with pytest.raises(K.SnapshotTaken):
        K.write_snapshot(spark.range(5), root, DAYS[0])
    K.publish(spark, table, path)
    with pytest.raises(K.SnapshotTaken):
        K.write_snapshot(spark.range(5), root, DAYS[0], table)
    K.publish(spark, table, K.write_snapshot(spark.range(7), root, DAYS[1], table))
    assert K.write_snapshot(spark.range(5), root, DAYS[0], table) == path, "the run before was not the published one"
    assert spark.table(table).count() == 7
    spark.sql(f"DROP TABLE {table}")


def test_a_load_reads_its_source_once(spark, shop, tmp_path):
    """Rows and maximum are observed on the way: no job counts what was written."""
    shop.put((1, DAYS[0], "a"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-load", "x")
    stage = table_load._stage(SRC.read_full(spark, shop.source), str(tmp_path / "staged"), None, W.top_of("ts", T.TimestampNTZType()), False, None)
    assert stage == {"n_rows": 1, "top": DAYS[0], "n_rejected": 0}
    assert len([j for j in jobs.getJobIdsForGroup("one-load")]) <= 2, "the schema's footer and the write"
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_fact_run_audits_and_publishes(spark, sf_dir, tmp_path):
    from orderloom.plans.fact_build import build_item_fact
    from orderloom.plans.item_fact import FACT_COLUMNS
    from parity.inputs import Tables

    run = build_item_fact(spark, Tables(spark, sf_dir), str(tmp_path), "fact_run", DAYS[4])
    audit = {r.step: r.n_rows for r in run.audit.collect()}
    fact = spark.table("fact_run")
    assert run.path.endswith("/published/dt=202401050930")
    assert audit["published"] == fact.count() and audit["pivot"] <= audit["history"]
    assert len(fact.columns) == 98 and fact.columns[:94] == FACT_COLUMNS
    spark.sql("DROP TABLE fact_run")


def test_the_items_and_orders_of_a_fact_run_are_stored_before_they_meet(spark, sf_dir, tmp_path, monkeypatch):
    from orderloom.plans import fact_build
    from parity.inputs import Tables

    stored, wanted = [], []
    monkeypatch.setattr(fact_build, "materialize", lambda df, path, **k: stored.append(path.rsplit("/", 1)[1]) or K.materialize(df, path, **k))
    monkeypatch.setattr(fact_build, "configure", lambda spark, volume: wanted.append(volume))
    run = fact_build.build_item_fact(spark, Tables(spark, sf_dir), str(tmp_path), "fact_steps", DAYS[4])
    assert stored[:-1] == ["pivot", "flags", "catalogue", "counts", "items", "orders"]
    assert not {"items", "orders"} & {r.step for r in run.audit.collect()}
    files = sum(f.stat().st_size for n in ("sales_order_item_status_history", "sales_order_item", "sales_order") for f in Path(Tables(spark, sf_dir).path(n).removeprefix("file:")).glob("*.parquet"))
    assert wanted[0] > 10 * files, "partitions for rows, not for the compressed columns they come from"
    spark.sql("DROP TABLE fact_steps")


def test_pages_have_equal_width_and_every_row(spark):
    keys = [1, 2, 3, 50, 99, 100, 2**60, None, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    width = (2**60 - 1) // 5 + 1
    page = lambda k: None if k is None else (k - 1) // width
    got = {r.page: r.n for r in df.groupBy(SRC.pages_of(df, "k", page_rows=2).alias("page")).agg(F.count("*").alias("n")).collect()}
    assert got == Counter(map(page, keys)) and got[None] == 2
    assert [r.page for r in df.where("k IS NULL").select(SRC.pages_of(df.where("k IS NULL"), "k").alias("page")).collect()] == [None, None]


def test_scan_partitioned_gives_every_page(spark, sf_dir):
    import __spark_entry__ as entry

    got = entry.queries()["scan_partitioned"](spark, sf_dir)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    assert got.columns == ["page", "n_rows", "first_key", "last_key"]
    assert got.count() > 1 and got.agg(F.sum("n_rows")).first()[0] == lines
