"""The database-backed source maps report views to source tables and splits
large tables by their rows; reader and counts are injected (no database in the
test, its tables are DataFrames)."""

import pytest
from pyspark.sql import functions as F

from fixtures import SCHEMAS
from ledgerlens.sources import jdbc
from ledgerlens.sources.jdbc import SECOND_COLUMNS, SOURCE_TABLES, SPLIT_COLUMNS, JdbcSource, Split

CODE_TABLES = {"project_status", "country", "currency", "cost_type_translation", "invoice_status_translation",
               "billing_item_attribute"}


class Database:
    """Tables by name; answers the counts with Spark SQL and keeps the conditions of the reads."""

    def __init__(self, spark, **tables):
        self.spark, self.tables, self.reads, self.queries = spark, tables, {}, 0
        for name, df in tables.items():
            df.createOrReplaceTempView(name)

    def query(self, sql):
        self.queries += 1
        return [tuple(r) for r in self.spark.sql(sql).collect()]

    def reader(self, table, conditions):
        self.reads[table] = conditions
        return self.tables[table]

    def source(self, **options):
        return JdbcSource(self.spark, "jdbc:unused", {}, reader=self.reader, query=self.query, **options)

    def rows_by_read(self, table):
        """Rows of each read; fails if a row is in none or in two of them."""
        df, conditions = self.tables[table], self.reads[table]
        hits = df.select(*[F.coalesce(F.expr(c), F.lit(False)).cast("int").alias(f"c{i}") for i, c in enumerate(conditions)])
        total = sum(F.col(f"c{i}") for i in range(len(conditions)))
        assert hits.where(total != 1).count() == 0
        return list(hits.agg(*[F.sum(f"c{i}") for i in range(len(conditions))]).first())


def test_every_large_table_is_split_and_code_tables_are_not(spark):
    views = {v: k for k, v in SOURCE_TABLES.items()}
    reads = {}

    def reader(table, conditions):
        reads[table] = conditions
        return spark.createDataFrame([], SCHEMAS[views[table]])

    def query(sql):
        return [(1, 4_000, 4_000_000, 0)] if sql.startswith("SELECT MIN") else [(k, 2_000) for k in range(1, 2_001)]

    src = JdbcSource(spark, "jdbc:unused", {}, reader=reader, query=query)
    for view in SOURCE_TABLES:
        getattr(src, view)
    assert {t for t, c in reads.items() if c is None} == CODE_TABLES
    assert all(len(reads[t]) == 8 and c in reads[t][3] for t, c in SPLIT_COLUMNS.items())
    assert set(SECOND_COLUMNS) <= set(SPLIT_COLUMNS)


def test_reads_hold_about_as_many_rows_where_ids_are_uneven(spark):
    """Half of the ids are close together, half spread over a range of a billion, and negative ones are among them."""
    ids = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(
        F.col("id") * 50_000 - 400_000_000).alias("id"))
    db = Database(spark, project=ids)
    db.source(rows_per_split=1_000).project
    sizes = db.rows_by_read("project")
    assert sum(sizes) == 20_000 and max(sizes) <= 1_000 and len(sizes) < 50
    assert db.queries < 8


def test_a_hot_value_is_cut_by_the_second_column(spark):
    """One order has 9,000 of 10,000 costs, some without an amount; some costs have no order."""
    costs = spark.range(10_000).select(
        F.when(F.col("id") < 9_000, 77).when(F.col("id") < 9_900, F.col("id") % 300).cast("long").alias("omnibus_order_id"),
        F.when(F.col("id") % 50 != 0, F.col("id") * 7 - 9_000).alias("amount"))
    db = Database(spark, omnibus_order_cost=costs)
    db.source(rows_per_split=1_000).omnibus_order_cost
    sizes = db.rows_by_read("omnibus_order_cost")
    assert sum(sizes) == 10_000 and max(sizes) <= 1_300  # rows without an amount go with the first part
    assert sum("omnibus_order_id = 77" in c for c in db.reads["omnibus_order_cost"]) == 10
    db.source(rows_per_split=1_000, second_columns={}).omnibus_order_cost
    assert max(db.rows_by_read("omnibus_order_cost")) >= 9_000


@pytest.mark.parametrize("plan", [
    [(10, 19, 5), (30, 39, 5), (40, 40, 9), (50, 59, 2)], [(10, 10, 9), (15, 15, 9), (20, 29, 1), (30, 30, 9)],
    [(10, 19, 5)], [(10, 10, 9)], [(10, 19, 2), (20, 20, 9), (21, 21, 9), (22, 29, 1), (30, 39, 2)]])
def test_values_that_came_after_the_counting_are_read(spark, plan):
    conditions = list(jdbc.predicates("id", "id", [Split(*x) for x in plan], 0, 5))
    hits = spark.range(-5, 100).select("id", sum(F.expr(c).cast("int") for c in conditions).alias("n"))
    assert hits.where("n <> 1").collect() == []


def test_small_and_empty_tables_are_one_read(spark):
    db = Database(spark, project=spark.range(50), company=spark.range(0))
    src = db.source(rows_per_split=100)
    src.project, src.company
    assert db.reads == {"project": None, "company": None}


@pytest.mark.parametrize("rows, reads", [(10_000, 10), (100_000, 20)])
def test_reads_grow_when_their_number_is_bounded(spark, rows, reads):
    db = Database(spark, project=spark.range(rows))
    db.source(rows_per_split=1_000, max_splits=20).project
    assert reads <= len(db.reads["project"]) <= 2 * reads


def test_reports_run_on_the_database_source(spark):
    from ledgerlens.plans import reports

    views = {v: k for k, v in SOURCE_TABLES.items()}
    src = JdbcSource(spark, "jdbc:unused", {}, reader=lambda table, _: spark.createDataFrame([], SCHEMAS[views[table]]),
                     query=lambda _: [(None, None, 0, 0)])
    assert reports.project_summary(src).count() == 0
    assert reports.cost_dump(src).count() == 0
