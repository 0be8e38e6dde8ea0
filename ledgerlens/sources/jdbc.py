"""The reporting schema read straight from the relational source database.

Each base table is read in parallel, in ranges of an integer column that hold
about as many rows each: the database counts the rows of equal steps of the
column's range, steps with many rows are counted again in finer ones, and
neighbours are put together (``split_plan``). A single value with more rows than
a read should have is cut further by a second column. Spark pushes each report's
column list and filters into the reads. The joins, aggregations and picks then
run in Spark, not in the database. Attribute names are the ones the reports use (``wave`` for
the project product group, ``sales_line`` for the project's sales products,
...).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .tables import read_jdbc_table

# report view name -> source table
SOURCE_TABLES = {
    "project": "project",
    "project_status": "project_status",
    "wave": "project_product_group",
    "project_account_view": "project_account_view",
    "project_account": "project_account",
    "company": "company",
    "country": "country",
    "user": "user",
    "currency": "currency",
    "sales_line": "project_sales_product",
    "product": "sales_product_translation",
    "cost_line": "project_cost",
    "cost_type_translation": "cost_type_translation",
    "time_log": "project_time_log",
    "invoice": "invoice",
    "project_invoice": "project_invoice",
    "invoice_product": "invoice_product",
    "invoice_product_code": "invoice_product_code",
    "invoice_status_translation": "invoice_status_translation",
    "sales_product_invoice_product_code": "sales_product_invoice_product_code",
    "omnibus_order": "omnibus_order",
    "omnibus_order_cost": "omnibus_order_cost",
    "omnibus_order_time_log": "omnibus_order_time_log",
    "omnibus_order_item": "omnibus_order_item",
    "billing_item": "billing_item",
    "billing_item_attribute": "billing_item_attribute",
    "billing_item_attribute_value": "billing_item_attribute_value",
}

# Every table that can be large, with the integer column to split it on. What is
# left out are code tables: statuses, countries, currencies, types, attributes.
SPLIT_COLUMNS = {
    "project": "id",
    "project_product_group": "id",
    "project_account_view": "project_id",
    "project_account": "project_id",
    "company": "id",
    "user": "id",
    "project_sales_product": "id",
    "sales_product_translation": "translatable_id",
    "project_cost": "id",
    "project_time_log": "id",
    "invoice": "id",
    "project_invoice": "invoice_id",
    "invoice_product": "invoice_id",
    "invoice_product_code": "id",
    "sales_product_invoice_product_code": "sales_product_id",
    "omnibus_order": "id",
    "omnibus_order_cost": "omnibus_order_id",
    "omnibus_order_time_log": "omnibus_order_id",
    "omnibus_order_item": "id",
    "billing_item": "id",
    "billing_item_attribute_value": "billing_item_id",
}
# Where one value of the split column may have very many rows: a number column that tells them apart.
SECOND_COLUMNS = {
    "project_account_view": "company_id",
    "project_account": "company_id",
    "sales_product_translation": "id",
    "project_invoice": "project_id",
    "invoice_product": "project_sales_product_id",
    "sales_product_invoice_product_code": "invoice_product_code_id",
    "omnibus_order_cost": "amount",
    "omnibus_order_time_log": "minutes",
    "billing_item_attribute_value": "billing_item_attribute_id",
}
# rows in one read, reads of a table at most (larger tables get larger reads)
ROWS_PER_SPLIT, MAX_SPLITS = 500_000, 1_000
# steps that a table's range is counted in first, and those of a step that is counted again
STEPS, FINER_STEPS = 2_048, 64


class Bounds(NamedTuple):
    """Of a column: least and greatest value (None without any), rows, rows without a value."""

    lo: int | None
    hi: int | None
    rows: int
    nulls: int


class Split(NamedTuple):
    """Values from ``lo`` to ``hi`` and their rows."""

    lo: int
    hi: int
    rows: int


#: rows by step: (width, ranges or None for all) -> (floor(value / width), rows)
Counts = Callable[[int, "list[tuple[int, int]] | None"], "list[tuple[int, int]]"]


def split_plan(lo: int, hi: int, rows_per_split: int, counts: Counts) -> list[Split]:
    """Ranges that hold at most twice ``rows_per_split`` rows, or one value.

    One counting query a level: the next one counts only the steps that hold too
    much, in finer steps, which are whole parts of them.
    """
    width = 1
    while (hi - lo + 1) // width > STEPS:
        width *= FINER_STEPS
    fine: list[Split] = []
    ranges = None
    while True:
        steps = [Split(step * width, step * width + width - 1, n) for step, n in counts(width, ranges)]
        heavy = [x for x in steps if x.rows > rows_per_split and width > 1]
        fine += [x for x in steps if x not in heavy]
        if not heavy:
            break
        ranges, width = [(x.lo, x.hi) for x in heavy], width // FINER_STEPS
    out: list[Split] = []
    for x in sorted(fine):
        if out and out[-1].rows + x.rows <= rows_per_split:
            out[-1] = Split(out[-1].lo, max(out[-1].hi, x.hi), out[-1].rows + x.rows)
        else:
            out.append(x)
    return out


def predicates(column: str, second: str | None, plan: list[Split], nulls: int, rows_per_split: int) -> Iterator[str]:
    """One condition a read; every row meets exactly one of them, also one whose
    value was not there when values were counted."""
    begin = None  # of what is not covered yet; None is below all
    for k, x in enumerate(plan):
        if x.lo == x.hi:
            if begin is None or begin < x.lo:
                yield _range(column, begin, x.lo)
            yield from _cut(f"{column} = {x.lo}", second, x.rows, rows_per_split)
            begin = x.lo + 1
        elif k + 1 == len(plan) or plan[k + 1].lo < plan[k + 1].hi:
            end = plan[k + 1].lo if k + 1 < len(plan) else None
            yield _range(column, begin, end)
            begin = end
        # before a single value, the range is what its turn finds uncovered
    if plan and begin is not None:
        yield _range(column, begin, None)
    if nulls:
        yield from _cut(f"{column} IS NULL", second, nulls, rows_per_split)


def _range(column: str, begin: int | None, end: int | None) -> str:
    ends = [f"{column} >= {begin}"] * (begin is not None) + [f"{column} < {end}"] * (end is not None)
    return " AND ".join(ends) or f"{column} IS NOT NULL"


def _cut(condition: str, second: str | None, rows: int, rows_per_split: int) -> Iterator[str]:
    n = -(-rows // rows_per_split) if second else 1
    if n < 2:
        yield condition
        return
    for i in range(n):
        rest = f"MOD(FLOOR(ABS({second})), {n}) = {i}"
        yield f"{condition} AND ({rest}{f' OR {second} IS NULL' if i == 0 else ''})"


Reader = Callable[[str, "list[str] | None"], DataFrame]
Query = Callable[[str], "list[tuple]"]


class JdbcSource:
    """Lazily read source views; ``fx_wide`` and ``fx_daily`` are the landed
    rates, wide as in the file and long. ``reader`` (table, conditions of the
    reads) and ``query`` (SQL of a few counts) stand for the database in tests."""

    def __init__(self, spark: SparkSession, url: str, properties: dict, *, schema: str | None = None,
                 split_columns: dict | None = None, second_columns: dict | None = None,
                 rows_per_split: int = ROWS_PER_SPLIT, max_splits: int = MAX_SPLITS,
                 fx_wide: DataFrame | None = None, fx_daily: DataFrame | None = None,
                 reader: Reader | None = None, query: Query | None = None):
        self._spark = spark
        self._url = url
        self._props = dict(properties)
        self._schema = schema
        self._splits = SPLIT_COLUMNS if split_columns is None else split_columns
        self._seconds = SECOND_COLUMNS if second_columns is None else second_columns
        self._rows, self._most = rows_per_split, max_splits
        self._rates = {"fx_wide": fx_wide, "fx_daily": fx_daily}
        self._reader = reader or self._jdbc_reader
        self._query = query or self._jdbc_query
        self._cache: dict[str, DataFrame] = {}

    def _qualified(self, table: str) -> str:
        return f"{self._schema}.{table}" if self._schema else table

    def _jdbc_query(self, sql: str) -> list[tuple]:
        return [tuple(r) for r in read_jdbc_table(self._spark, self._url, f"({sql}) q", self._props).collect()]

    def _jdbc_reader(self, table: str, conditions: list[str] | None) -> DataFrame:
        return read_jdbc_table(self._spark, self._url, table, self._props, conditions)

    def _bounds(self, table: str, column: str) -> Bounds:
        (row,) = self._query(f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n, "
                             f"COUNT(*) - COUNT({column}) AS nulls FROM {table}")
        return Bounds(*row)

    def _counts(self, table: str, column: str) -> Counts:
        def counts(width: int, ranges: list[tuple[int, int]] | None) -> list[tuple[int, int]]:
            where = " OR ".join(f"({column} >= {a} AND {column} <= {b})" for a, b in ranges) if ranges \
                else f"{column} IS NOT NULL"
            step = f"FLOOR({column} / {width})"
            # at most a few thousand rows, however large the table is
            return [(int(k), int(n)) for k, n in self._query(
                f"SELECT {step} AS step, COUNT(*) AS n FROM {table} WHERE {where} GROUP BY {step}")]

        return counts

    def conditions(self, table: str) -> list[str] | None:
        """Conditions of a table's reads; None for one read of all."""
        column, name = self._splits.get(table), self._qualified(table)
        if column is None:
            return None
        at = self._bounds(name, column)
        if at.lo is None or at.rows <= self._rows:
            return None
        share = max(self._rows, -(-at.rows // self._most))
        plan = split_plan(at.lo, at.hi, share, self._counts(name, column))
        return list(predicates(column, self._seconds.get(table), plan, at.nulls, share))

    def read(self, table: str) -> DataFrame:
        """A table in as many reads as its rows ask for."""
        return self._reader(self._qualified(table), self.conditions(table))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in self._rates:
            if self._rates[name] is None:
                raise AttributeError(f"{name}: pass the landed rates")
            return self._rates[name]
        if name not in SOURCE_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.read(SOURCE_TABLES[name])
        return self._cache[name]
