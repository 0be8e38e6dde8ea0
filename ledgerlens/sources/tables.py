"""Readers for the base tables.

Every reader is lazy: it returns a DataFrame whose scan Catalyst prunes to the
columns and filters a report really uses (``ReadSchema`` / ``PushedFilters``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Declared schemas of the given tables (no inference job per read).
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables(dict):
    """Name -> DataFrame, read on first access with its declared schema."""

    def __init__(self, spark: SparkSession, base_dir: str, fmt: str = "parquet",
                 schemas: dict | None = None):
        super().__init__()
        self.spark = spark
        self.base_dir = base_dir
        self.fmt = fmt
        self.schemas = DRIVER_SCHEMAS if schemas is None else schemas

    def __missing__(self, name: str) -> DataFrame:
        path = os.path.join(self.base_dir, f"{name}.{self.fmt}")
        reader = self.spark.read.format(self.fmt)
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        df = reader.load(path)
        self[name] = df
        return df


def load_tables(spark: SparkSession, base_dir: str) -> Tables:
    """Lazy access to ``<base_dir>/<table>.parquet``."""
    return Tables(spark, base_dir)


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict,
                    conditions: list[str] | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Read one *base* table from a relational source in parallel.

    The report joins run in Spark, not in the source database, so each table
    is read once, with one read for each of ``conditions`` (one of all without
    any). Filters and the column list of the report are pushed into each.
    """
    options = {k: str(v) for k, v in properties.items()} | {"fetchsize": str(fetch_size)}
    if conditions:
        return spark.read.jdbc(url, table, predicates=conditions, properties=options)
    return spark.read.jdbc(url, table, properties=options)
