"""Helpers shared by the operators: words, scratch tables, prefix sums."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.session import checkpoint_dir

#: Separators between words: space, tab, LF, VT, FF, CR.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

_scratch: list[str] = []


def words(text: Column) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body`` applied to ``value``, which is computed once per row.

    A lambda variable keeps the optimizer from copying an expensive
    expression into each place, and each loop, that uses it.
    """
    return F.transform(F.array(value), body)[0]


def rows_as(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns packed into one struct, so that no name of theirs clashes."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def unpacked(df: DataFrame, columns: list[str], name: str = "_row") -> DataFrame:
    return df.select(*[F.col(f"{name}.`{c}`").alias(c) for c in columns])


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``).

    A machine-local folder stands in for it only under a local master.
    """
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local"):
        return checkpoint_dir(spark, tempfile.mkdtemp(prefix="ledgerlens-"))
    return checkpoint_dir(spark)


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


#: Whether Spark deletes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries that run meanwhile go as soon as each ends,
    not when the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lineage cut that a
    lost executor does not undo and of which readers fetch single columns. Its
    shuffle files go as soon as it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with shuffles_freed(spark):
        df.write.options(**options).parquet(path)
    # the nullable schema that parquet would give, without a job to infer it
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def forget(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that is not needed any more."""
    delete(spark, path)
    if path in _scratch:
        _scratch.remove(path)


@contextlib.contextmanager
def recorded(paths: list[str]):
    """Add to ``paths`` the scratch tables that are made meanwhile."""
    before = set(_scratch)
    try:
        yield
    finally:
        paths += [p for p in _scratch if p not in before]


#: Rows of a table that is sent to every executor at most.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, written, with a broadcast hint once it is counted and has at most
    ``BROADCAST_ROWS`` rows; else it is joined by shuffle. For narrow tables of
    groups, so that rows with texts are not dealt by a hot group's key."""
    df = written(df, "groups")
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which null equals null; the keys come out once.
    A hint on ``right`` stays in force."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def prefix_sums(rows: DataFrame, stats: DataFrame, group: str, key: str, size: str, ties: list[str],
                out: str, rows_per_bucket: int = 5_000) -> DataFrame:
    """Exclusive running sum of the long ``size`` per ``group`` (not null), in
    the order of the hexadecimal hash ``key`` (eight digits or more), then ``ties``.

    A group is cut by ranges of its hash into buckets of about
    ``rows_per_bucket`` rows. Bucket totals are summed up in a small table and
    rows only inside their bucket, so no task holds a whole group. ``stats`` has
    group, key and size of the same rows and is read twice; ``rows`` may carry
    more and is read once. Rows that tie in everything are interchangeable.
    """
    counts = broadcast_if_small(
        stats.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / rows_per_bucket).alias("_buckets")))

    def cut(df: DataFrame) -> DataFrame:
        return df.join(counts, group).withColumn(
            "_bucket", F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
                               * F.col("_buckets") / float(2 ** 32))).drop("_buckets")

    totals = cut(stats.select(group, key, size)).groupBy(group, "_bucket").agg(F.sum(size).alias("_total"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy(group, "_bucket").orderBy(key, *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (cut(rows).join(offsets, [group, "_bucket"])
            .withColumn(out, F.col("_offset") + F.coalesce(F.sum(size).over(inside), F.lit(0)))
            .drop("_bucket", "_offset"))
