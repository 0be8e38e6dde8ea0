"""Sinks: replace a result table, and publish a dated report snapshot.

Each sink writes the new rows aside and then switches in one step, so a reader
finds the old rows or the new ones, and a run that fails leaves the old ones.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete on whatever file system ``path`` lies on."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


# ---------------------------------------------------------------- tables of the catalog
def replace_table(df: DataFrame, name: str, path: str) -> str:
    """Replace a result table (``if_exists='replace'``); returns where its data lies.

    ``name`` is a view that points at the newest of the version folders below
    ``path``. The new version is written beside the old one, and one change in
    the catalog lets the view point at it, whatever its columns are. The version
    before stays for readers that are still at it; older ones are deleted.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    old = [c for c in _children(spark, path) if c.startswith("version-")]
    stamp = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d%H%M%S%f")
    target = f"{path}/version-{stamp}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(target)
    quoted = target.replace("`", "``")
    # ALTER VIEW changes the entry in place; CREATE OR REPLACE would drop it first
    there = spark.catalog.tableExists(name)
    if there and spark.catalog.getTable(name).tableType != "VIEW":  # once, where an earlier job kept a table; its files stay
        spark.sql(f"DROP TABLE {name}")
        there = False
    spark.sql(f"{'ALTER' if there else 'CREATE'} VIEW {name} AS SELECT * FROM parquet.`{quoted}`")
    for c in old[:-1]:
        delete_path(spark, f"{path}/{c}")
    return target


# ---------------------------------------------------------------- tables of a reporting database
Writer = Callable[[DataFrame, str], None]
Execute = Callable[["list[str]"], None]


def switch_statements(url: str, table: str, staging: str, old: str, exists: bool) -> list[str]:
    """What puts ``staging`` in the place of ``table``; ``old`` is what it was.

    MySQL renames both tables in one atomic statement. Elsewhere the renames are
    statements of one transaction (``execute`` commits once), which databases
    with transactional DDL apply together.
    """
    if url.startswith(("jdbc:mysql:", "jdbc:mariadb:")):
        moves = [f"{table} TO {old}"] * exists + [f"{staging} TO {table}"]
        return [f"RENAME TABLE {', '.join(moves)}"]
    bare = [x.rpartition(".")[2] for x in (table, old)]  # the new name has no schema there
    return [f"ALTER TABLE {table} RENAME TO {bare[1]}"] * exists + [f"ALTER TABLE {staging} RENAME TO {bare[0]}"]


def replace_jdbc_table(df: DataFrame, url: str, table: str, properties: dict, write: Writer | None = None,
                       execute: Execute | None = None, exists: Callable[[str], bool] | None = None) -> None:
    """Replace a table in a relational reporting database.

    The rows go to a staging table of their own first; only once all are there
    are the names switched (``switch_statements``), and then the old rows are
    dropped. A push that fails leaves the table as it was, and its staging table
    is dropped. ``write``, ``execute`` and ``exists`` stand for the database in
    tests.
    """
    spark, token = df.sparkSession, uuid.uuid4().hex[:8]
    staging, old = f"{table}__new_{token}", f"{table}__old_{token}"
    write = write or (lambda rows, name: _jdbc_write(rows, url, name, properties))
    execute = execute or (lambda statements: _jdbc_execute(spark, url, properties, statements))
    exists = exists or (lambda name: _jdbc_exists(spark, url, properties, name))
    try:
        write(df, staging)
        there = exists(table)
        execute(switch_statements(url, table, staging, old, there))
    except BaseException:
        if exists(staging):
            execute([f"DROP TABLE {staging}"])
        raise
    if there:
        execute([f"DROP TABLE {old}"])


def _jdbc_write(df: DataFrame, url: str, table: str, properties: dict) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **properties).mode("errorifexists").save()


def _connection(spark: SparkSession, url: str, properties: dict):
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    if "driver" in properties:  # drivers of --jars are known to Spark's registry
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(properties["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, props)


def _jdbc_execute(spark: SparkSession, url: str, properties: dict, statements: list[str]) -> None:
    connection = _connection(spark, url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.execute(sql)
        connection.commit()
    finally:
        connection.close()


def _jdbc_exists(spark: SparkSession, url: str, properties: dict, table: str) -> bool:
    connection = _connection(spark, url, properties)
    try:
        schema, _, name = table.rpartition(".")
        return connection.getMetaData().getTables(None, schema or None, name, None).next()
    finally:
        connection.close()


# ---------------------------------------------------------------- dated files
POINTER = "_current"


def _put_pointer(spark: SparkSession, folder: str, value: str) -> None:
    """Replace the pointer file of ``folder`` in one step."""
    fs, fresh = _fs(spark, f"{folder}/.{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(value.encode("utf-8")))
    out.close()
    hadoop, jvm = spark._jvm.org.apache.hadoop.fs, spark._jvm
    over = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
            fresh, hadoop.Path(f"{folder}/{POINTER}"), over)
    except BaseException:
        fs.delete(fresh, False)
        raise


def current_snapshot(spark: SparkSession, base: str, name: str) -> str | None:
    """The folder of the published snapshot; None if there is none."""
    folder = f"{base.rstrip('/')}/{name}"
    if POINTER not in _children(spark, folder):
        return None
    fs, pointer = _fs(spark, f"{folder}/{POINTER}")
    io = spark._jvm.java.io
    reader = io.BufferedReader(io.InputStreamReader(fs.open(pointer), "UTF-8"))
    try:
        return f"{folder}/{reader.readLine()}"
    finally:
        reader.close()


def _own_checkpoint(df: DataFrame) -> tuple[DataFrame, str | None]:
    """A checkpoint of ``df`` and where its files lie."""
    rows = df.checkpoint()
    file = rows._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    return rows, file.get() if file.isDefined() else None


def write_snapshot(df: DataFrame, base_dirs: list[str], name: str,
                   run_date: _dt.date | None = None, sort: list[str] | None = None) -> list[str]:
    """Publish a dated CSV snapshot of a report in each target folder.

    The rows are sorted once, by ``sort``, and cut off from their plan by a
    checkpoint, whose files go at the end; each folder is written from that. A
    snapshot is ``<base>/<name>/run_date=YYYY_MM_DD/version=<id>``, and the file
    ``<base>/<name>/_current`` names the published one (``current_snapshot``).
    The pointer is replaced once the new files stand complete, and only then do
    earlier snapshots disappear, those of the same day too; whatever fails
    before leaves the published one as it was. (The spreadsheet format of the
    original report files has no distributed writer; CSV with a header replaces
    it.)
    """
    spark = df.sparkSession
    dated = f"run_date={(run_date or _dt.date.today()).strftime('%Y_%m_%d')}"
    if sort:
        df = df.orderBy(*[F.col(c).asc_nulls_first() for c in sort])
    (rows, kept), paths = _own_checkpoint(df), []
    try:
        for base in base_dirs:
            folder, version = f"{base.rstrip('/')}/{name}", f"version={uuid.uuid4().hex}"
            try:
                rows.write.option("header", True).csv(f"{folder}/{dated}/{version}")
                _put_pointer(spark, folder, f"{dated}/{version}")
            except BaseException:
                delete_path(spark, f"{folder}/{dated}/{version}")
                raise
            for day in _children(spark, folder):
                if day.startswith("run_date=") and day != dated:
                    delete_path(spark, f"{folder}/{day}")
            for other in _children(spark, f"{folder}/{dated}"):
                if other != version:
                    delete_path(spark, f"{folder}/{dated}/{other}")
            paths.append(folder)
    finally:
        if kept:
            delete_path(spark, kept)
    return paths
