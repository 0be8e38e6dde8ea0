import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from ledgerlens.sources import sinks

DAY = dt.date(2024, 1, 2)


def _days(folder):
    return sorted(p for p in os.listdir(folder) if p.startswith("run_date="))


def _rows(spark, base, name="cost_dump"):
    return [tuple(r) for r in spark.read.option("header", True).csv(sinks.current_snapshot(spark, base, name)).collect()]


def _failing(df):
    return df.select(F.raise_error(F.lit("no")).cast("long").alias("id"))


# ---------------------------------------------------------------- dated files
def test_snapshot_keeps_only_newest(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id long, v string")
    base = str(tmp_path)
    assert sinks.current_snapshot(spark, base, "cost_dump") is None
    sinks.write_snapshot(df, [base], "cost_dump", dt.date(2024, 1, 1), sort=["id", "v"])
    sinks.write_snapshot(df, [base, base + "_copy"], "cost_dump", DAY, sort=["id", "v"])
    for b in (base, base + "_copy"):
        assert _days(os.path.join(b, "cost_dump")) == ["run_date=2024_01_02"]
        assert _rows(spark, b) == [("1", "a"), ("2", "b")]


def test_snapshot_of_the_same_day_replaces_the_earlier_one(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    sinks.write_snapshot(df, [str(tmp_path)], "cost_dump", DAY)
    sinks.write_snapshot(df.withColumn("v", F.lit("new")), [str(tmp_path)], "cost_dump", DAY)
    assert _rows(spark, str(tmp_path)) == [("1", "new")]
    assert len(os.listdir(tmp_path / "cost_dump" / "run_date=2024_01_02")) == 1


@pytest.mark.parametrize("day", [dt.date(2024, 1, 1), DAY])
def test_failing_write_leaves_the_published_snapshot(spark, tmp_path, day):
    good = spark.createDataFrame([(1, "a")], "id long, v string")
    sinks.write_snapshot(good, [str(tmp_path)], "cost_dump", dt.date(2024, 1, 1))
    with pytest.raises(Exception):
        sinks.write_snapshot(_failing(good), [str(tmp_path)], "cost_dump", day)
    assert _rows(spark, str(tmp_path)) == [("1", "a")]


def test_failing_switch_leaves_todays_earlier_snapshot(spark, tmp_path, monkeypatch):
    good = spark.createDataFrame([(1, "a")], "id long, v string")
    sinks.write_snapshot(good, [str(tmp_path)], "cost_dump", DAY)

    def broken(*_):
        raise OSError("the store does not answer")

    monkeypatch.setattr(sinks, "_put_pointer", broken)
    with pytest.raises(OSError, match="does not answer"):
        sinks.write_snapshot(good.withColumn("v", F.lit("new")), [str(tmp_path)], "cost_dump", DAY)
    assert _rows(spark, str(tmp_path)) == [("1", "a")]
    assert len(os.listdir(tmp_path / "cost_dump" / "run_date=2024_01_02")) == 1  # nothing half-published stays


def test_snapshot_leaves_no_checkpoint_files(spark, tmp_path):
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    before = {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs}
    sinks.write_snapshot(spark.range(50).toDF("id"), [str(tmp_path)], "cost_dump", DAY, sort=["id"])
    assert {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs} <= before


# ---------------------------------------------------------------- tables of the catalog
def test_replace_table_switches_versions(spark, tmp_path):
    path, name = str(tmp_path / "t"), "ledgerlens_test_t"
    for n in (3, 2, 5):
        sinks.replace_table(spark.range(n).toDF("id"), name, path)
        assert spark.table(name).count() == n
    assert len(os.listdir(path)) == 2  # the newest and the one before
    sinks.replace_table(spark.range(4).selectExpr("id", "1 AS more"), name, path)  # another schema
    assert spark.table(name).columns == ["id", "more"]
    spark.sql(f"DROP VIEW {name}")


def test_a_table_of_an_earlier_job_becomes_a_view(spark, tmp_path):
    name = "ledgerlens_test_e"
    spark.range(2).write.parquet(str(tmp_path / "old"))
    spark.catalog.createTable(name, path=str(tmp_path / "old"), source="parquet")
    sinks.replace_table(spark.range(3).toDF("id"), name, str(tmp_path / "t"))
    assert spark.catalog.getTable(name).tableType == "VIEW" and spark.table(name).count() == 3
    assert spark.read.parquet(str(tmp_path / "old")).count() == 2
    spark.sql(f"DROP VIEW {name}")


def test_failing_build_leaves_the_old_table(spark, tmp_path):
    path, name = str(tmp_path / "t"), "ledgerlens_test_f"
    sinks.replace_table(spark.range(3).toDF("id"), name, path)
    with pytest.raises(Exception):
        sinks.replace_table(_failing(spark.range(3)), name, path)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP VIEW {name}")


def test_a_reader_finds_the_table_at_every_step(spark, tmp_path):
    """Readers look the table up while it is replaced by versions of other columns."""
    path, name = str(tmp_path / "t"), "ledgerlens_test_r"
    sinks.replace_table(spark.range(3).toDF("id"), name, path)
    seen, failed, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.add(tuple(spark.table(name).columns))
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    shapes = [["id", *[f"c{i}" for i in range(k % 3)]] for k in range(1, 9)]
    for shape in shapes:
        sinks.replace_table(spark.range(3).select(*[F.col("id").alias(c) for c in shape]), name, path)
        assert spark.table(name).columns == shape and spark.table(name).count() == 3
    done.set()
    reader.join()
    assert not failed and len(seen) > 1
    spark.sql(f"DROP VIEW {name}")


# ---------------------------------------------------------------- tables of a database
class Database:
    """Tables by name; runs the renames and drops that the sink asks for."""

    def __init__(self, **tables):
        self.tables, self.log, self.broken = dict(tables), [], None

    def write(self, df, name):
        self.tables[name] = []
        for r in df.collect():  # row by row, so that a failure is a half table
            if self.broken == "write" and len(self.tables[name]) == 2:
                raise RuntimeError("connection lost")
            self.tables[name].append(r[0])

    def execute(self, statements):
        after = dict(self.tables)
        for sql in statements:
            self.log.append(sql)
            if self.broken == "switch" and "RENAME" in sql:
                raise RuntimeError("lock timeout")
            word = sql.split()
            if sql.startswith("RENAME TABLE "):
                for move in sql.removeprefix("RENAME TABLE ").split(", "):
                    a, b = move.split(" TO ")
                    after[b] = after.pop(a)
            elif sql.startswith("ALTER TABLE "):
                schema = word[2].rpartition(".")[0]
                after[f"{schema}.{word[5]}" if schema else word[5]] = after.pop(word[2])
            else:
                del after[word[2]]
        self.tables = after

    def replace(self, df, url="jdbc:mysql://host/db", table="data"):
        sinks.replace_jdbc_table(df, url, table, {}, write=self.write, execute=self.execute,
                                 exists=lambda name: name in self.tables)


@pytest.mark.parametrize("url", ["jdbc:mysql://host/db", "jdbc:postgresql://host/db"])
@pytest.mark.parametrize("table", ["data", "reports.data"])
def test_database_table_is_switched_once_its_rows_are_there(spark, url, table):
    db = Database()
    for n in (3, 5):
        db.replace(spark.range(n), url, table)
        assert db.tables == {table: list(range(n))}
    switches = [s for s in db.log if "RENAME" in s]
    assert len(switches) == (2 if "mysql" in url else 3)


@pytest.mark.parametrize("broken", ["write", "switch"])
@pytest.mark.parametrize("url", ["jdbc:mysql://host/db", "jdbc:postgresql://host/db"])
def test_failing_push_leaves_the_old_rows(spark, broken, url):
    db = Database(data=[7, 8])
    db.broken = broken
    with pytest.raises(RuntimeError):
        db.replace(spark.range(4), url)
    assert db.tables == {"data": [7, 8]}
