"""The reporting job: FX tables first, then every report, each result replaced.

Order and data flow:

1. for a database source, copy the views that several reports read into the
   shared checkpoint folder (``spark.checkpoint.dir``) and read them back. Each
   is read from the database once, so reports agree on it and a lost executor
   recomputes from the copy; the copies are separate reads, no transaction
   holds them together, and other views are read by each report;
2. X1 (wide rates) and X2 (long rates with weekly averages) are written;
3. R1-R11 are built and written as concurrent jobs (R11 reads X2 back from
   its written table, the one cross-job dependency); R8 ∪ R9 and R10 also
   get a dated CSV copy, sorted by project and wave. With a reporting
   database, every table is then replaced there from its written copy.

Usage (test tables):  python -m ledgerlens.plans.job --sf-dir DIR --out DIR
Usage (source DB):    python -m ledgerlens.plans.job --jdbc-url URL --jdbc-properties FILE
                          --fx-archives 'landing/*.zip' --out DIR
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import os
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..session import build_session, checkpoint_dir
from ..sources import fx_files
from ..sources.adapters import Adapters
from ..sources.jdbc import JdbcSource
from ..sources.sinks import delete_path, replace_jdbc_table, replace_table, write_snapshot
from ..sources.tables import load_tables
from . import fx, reports

# source views read by more than one report
SHARED_VIEWS = ("project", "company", "project_account", "wave", "sales_line", "product", "cost_line",
                "time_log", "invoice", "invoice_product", "project_invoice", "currency")

# result table (without the deployment's prefix) -> report
RESULT_TABLES = {
    "project_data": "project_master",
    "product_data": "sold_products",
    "cost_data": "project_cost",
    "time_data": "project_time",
    "invoice_data": "invoice_lines",
    "data_export": "data_export",
    "project_summary_data_export": "project_summary",
    "cost_data_export": "cost_dump",
    "accounting_data_export": "accounting_dump",
}
EXTENDED_TABLE = "data_export_ext"


class SnapshotSource:
    """A source whose shared views were written once to the shared folder.

    The views are written concurrently (independent Spark jobs in one
    session), then read back from the files.
    """

    def __init__(self, src, spark: SparkSession, folder: str, names=SHARED_VIEWS, workers: int = 4):
        self._src = src
        self._spark = spark
        self._folder = folder
        self._views: dict[str, DataFrame] = {}
        self._parts: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()
        self._wait = threading.local()

        def write(name):
            path = os.path.join(folder, name)
            getattr(src, name).write.mode("overwrite").parquet(path)
            return name, path

        for name, path in _in_parallel(write, names, workers):
            self._views[name] = spark.read.parquet(path)

    def waited(self) -> float:
        """Seconds that the calling thread has waited for other threads' sub-plans."""
        return getattr(self._wait, "seconds", 0.0)

    def shared_part(self, name: str, build) -> DataFrame:
        """A sub-plan several reports use, computed once per job: the first
        report that needs it writes it to the shared folder, the others wait
        for it and read it back."""
        with self._guard:
            lock = self._locks.setdefault(name, threading.Lock())
        t = time.perf_counter()
        with lock:
            self._wait.seconds = self.waited() + time.perf_counter() - t
            if name not in self._parts:
                path = os.path.join(self._folder, "parts", name)
                build().write.mode("overwrite").parquet(path)
                self._parts[name] = self._spark.read.parquet(path)
        return self._parts[name]

    def __getattr__(self, name):
        views = self.__dict__.get("_views", {})
        if name in views:
            return views[name]
        return getattr(self.__dict__["_src"], name)


def _in_parallel(fn, items, workers: int):
    """Run ``fn`` over ``items`` as concurrent Spark jobs; re-raise the first
    failure."""
    items = list(items)
    if workers <= 1:
        return [fn(i) for i in items]
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(fn, items))


def run(spark: SparkSession, src, out_dir: str, snapshot_dirs: list[str] | None = None,
        run_date: _dt.date | None = None, fx_cutoff: str = "2018-01-01",
        client_not_like: str = reports.TESTING, table_prefix: str = "",
        timings: dict | None = None, workers: int = 4, keep_snapshot: bool = False,
        snapshot_views=SHARED_VIEWS, case_insensitive: bool = False,
        push=None, checks: dict | None = None) -> dict[str, str]:
    """Run the whole job; returns table name -> written path.

    ``table_prefix`` is prepended to every report table name (the FX tables
    keep their own names), for deployments whose readers expect a prefix.
    ``timings``, when given, receives seconds per step (steps overlap when
    ``workers`` > 1: independent tables are written as concurrent jobs; the
    time a step waits for a sub-plan that another one computes is not its own).
    The run's source copies are removed from the shared folder at its end,
    also a failed one, unless ``keep_snapshot``. ``snapshot_views`` chooses
    what is copied: all shared views for a database source; ``()`` when the
    sources are already well-split files and a second copy of the facts is not
    worth its write. ``case_insensitive`` compares client names as a database
    with such a collation does. ``push(df, name)``, when given, receives each
    written table, to replace it in a reporting database. ``checks``, when
    given, receives the post-check of the project master: how many of its rows
    share their wave with another (several client companies on one wave).
    """
    run_date = run_date or _dt.date.today()
    timings = {} if timings is None else timings
    shared = os.path.join(checkpoint_dir(spark), f"ledgerlens-snapshot-{uuid.uuid4().hex}")
    try:
        return _run(spark, src, shared, out_dir, snapshot_dirs, run_date, fx_cutoff, client_not_like, table_prefix,
                    timings, workers, snapshot_views, case_insensitive, push, checks)
    finally:
        if not keep_snapshot:
            delete_path(spark, shared)


def _run(spark, src, shared, out_dir, snapshot_dirs, run_date, fx_cutoff, client_not_like, table_prefix, timings,
         workers, snapshot_views, case_insensitive, push, checks) -> dict[str, str]:
    t0 = time.perf_counter()
    snap = SnapshotSource(src, spark, shared, names=snapshot_views, workers=workers)
    timings["snapshot_sources"] = round(time.perf_counter() - t0, 3)
    written: dict[str, str] = {}

    def put(name: str, build) -> None:
        t, waited = time.perf_counter(), snap.waited()
        written[name] = replace_table(build(), name, os.path.join(out_dir, name))
        if push is not None:
            push(spark.read.parquet(written[name]), name)
        timings[name] = round(time.perf_counter() - t - (snap.waited() - waited), 3)

    builders = {
        "project_master": lambda: reports.project_master(snap),
        "sold_products": lambda: reports.sold_products(snap, not_like=client_not_like,
                                                        case_insensitive=case_insensitive),
        "project_cost": lambda: reports.project_cost(snap),
        "project_time": lambda: reports.project_time(snap),
        "invoice_lines": lambda: reports.invoice_lines(snap),
        "data_export": lambda: reports.data_export(snap, not_like=client_not_like,
                                                    case_insensitive=case_insensitive),
        "project_summary": lambda: reports.project_summary(snap),
        "cost_dump": lambda: reports.cost_dump(snap),
        "accounting_dump": lambda: reports.accounting_dump(snap),
    }
    # FX tables first: the extended export reads the weekly rates back from
    # their written table (the one cross-job dependency) ...
    _in_parallel(lambda step: put(*step), [
        ("full_table", lambda: fx.wide_table(src.fx_wide)),
        ("weekly_avg", lambda: fx.weekly_average_table(src.fx_daily, snap.currency))], workers)
    weekly = spark.read.parquet(written["weekly_avg"])
    builders["extended_export"] = lambda: reports.extended_export(snap, weekly, cutoff=fx_cutoff)
    # ... then every report as concurrent jobs
    steps = [(table_prefix + base, builders[key]) for base, key in RESULT_TABLES.items()]
    steps.append((table_prefix + EXTENDED_TABLE, builders["extended_export"]))
    _in_parallel(lambda step: put(*step), steps, workers)

    if checks is not None:
        master = spark.read.parquet(written[table_prefix + "project_data"])
        checks["duplicate_waves"] = reports.project_master_duplicate_waves(master).count()
    if snapshot_dirs:
        for base, name in (("cost_data_export", "cost_dump"), ("accounting_data_export", "accounting_cost_dump")):
            write_snapshot(spark.read.parquet(written[table_prefix + base]), snapshot_dirs, name, run_date,
                           sort=["project_id", "project_cost_id", "invoice_number", "cost_amount"])
    return written


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", help="test tables (parquet); or use --jdbc-url")
    ap.add_argument("--jdbc-url", help="source database; reads the reporting schema's base tables")
    ap.add_argument("--jdbc-properties", help="JSON file with user/password/driver (never printed)")
    ap.add_argument("--jdbc-schema", default=None)
    rates = ap.add_mutually_exclusive_group()
    rates.add_argument("--fx-archives", help="glob of landed rate archives (zip with one wide CSV)")
    rates.add_argument("--fx-csv", help="one plain wide rate CSV")
    ap.add_argument("--jdbc-target-url", help="reporting database whose tables are replaced too")
    ap.add_argument("--jdbc-target-properties", help="JSON file with user/password/driver (never printed)")
    ap.add_argument("--snapshot", choices=("auto", "all", "none"), default="auto",
                    help="copy shared source views first; auto: for a database source only")
    ap.add_argument("--case-insensitive", action="store_true", help="client name filters ignore case")
    ap.add_argument("--out", required=True)
    ap.add_argument("--snapshot-dir", action="append", default=[])
    ap.add_argument("--master", default=None)
    ap.add_argument("--fx-cutoff", default="2018-01-01")
    ap.add_argument("--client-not-like", default=reports.TESTING)
    ap.add_argument("--table-prefix", default="")
    a = ap.parse_args(argv)
    spark = build_session(a.master)
    if not spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark, os.path.join(a.out, "_checkpoints"))
    if a.jdbc_url:
        src = JdbcSource(spark, a.jdbc_url, _properties(a.jdbc_properties), schema=a.jdbc_schema,
                         **_rates(spark, a.fx_archives, a.fx_csv))
    else:
        src = Adapters(load_tables(spark, a.sf_dir))
    push = None
    if a.jdbc_target_url:
        target = _properties(a.jdbc_target_properties)

        def push(df, name):
            replace_jdbc_table(df, a.jdbc_target_url, name, target)

    copy = a.snapshot == "all" or a.snapshot == "auto" and bool(a.jdbc_url)
    checks: dict[str, int] = {}
    for name, path in run(spark, src, a.out, a.snapshot_dir, fx_cutoff=a.fx_cutoff,
                          client_not_like=a.client_not_like, table_prefix=a.table_prefix,
                          snapshot_views=SHARED_VIEWS if copy else (), case_insensitive=a.case_insensitive,
                          push=push, checks=checks).items():
        print(name, path)
    print("rows of project_data that share their wave:", checks["duplicate_waves"])


def _properties(path: str) -> dict:
    with open(path) as fh:
        return json.load(fh)


def _rates(spark: SparkSession, archives: str | None, csv: str | None) -> dict[str, DataFrame]:
    """The wide rate table and its long rows, from landed archives or one CSV."""
    if archives:
        cells = fx_files.newest_cells(fx_files.read_zipped_cells(spark, archives))
        return {"fx_wide": fx_files.cells_to_wide(cells), "fx_daily": fx_files.cells_to_long(cells)}
    if csv:
        wide = fx_files.read_rates_csv(spark, csv)
        return {"fx_wide": wide, "fx_daily": fx.long_rates(wide)}
    return {}


if __name__ == "__main__":
    main()
