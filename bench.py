"""Benchmark: the reporting job end to end.

The measured workload is what the original scripts do in one run: read the
sources, build the FX tables, build all eleven reports and replace every
result table. Here that is ``ledgerlens.plans.job.run`` over the adapter
views at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``: the shared source views are copied once, then
X1, X2, R1-R10 and R11 are written as parquet. One JSON line is printed;
``value`` is the wall clock of the whole job, ``queries`` holds the seconds of
each registered report query run on its own, one after the other (no shared
copy, ``noop`` sink), and ``job_steps`` those of the job's steps, which overlap.

The job runs twice in one session; the first run (``cold_pass``) pays JIT and
code generation, ``value`` is the second. ``BENCH_ORACLE=1`` adds the same SQL
on DuckDB as a single-node reference.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import job  # noqa: E402
from ledgerlens.plans.registry import CLIENT_NOT_LIKE, FX_CUTOFF, QUERIES  # noqa: E402
from ledgerlens.session import build_session, checkpoint_dir  # noqa: E402
from ledgerlens.sources.adapters import Adapters  # noqa: E402
from ledgerlens.sources.sinks import delete_path  # noqa: E402
from ledgerlens.sources.tables import load_tables  # noqa: E402

HEADLINE = [
    "report_project_master", "report_sold_products", "report_cost", "report_time", "report_invoice_lines",
    "report_data_export", "report_project_summary", "report_cost_dump", "report_accounting_dump",
    "report_extended_fx", "fx_table_wide", "fx_table_long",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    workers = int(os.environ.get("BENCH_JOB_WORKERS", "4"))
    spark = build_session(f"local[{cpus}]", app="ledgerlens-bench", shuffle_partitions=parts,
                          extra={"spark.driver.memory": "16g", "spark.scheduler.mode": os.environ.get("BENCH_SCHEDULER", "FIFO"),
                                 **json.loads(os.environ.get("BENCH_EXTRA_CONF", "{}"))})
    # outputs go to the shared folder the session names; a local temporary
    # folder is used only when none is set (a laptop run)
    if not spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark, tempfile.mkdtemp(prefix="ledgerlens-bench-"))
    scratch = os.path.join(checkpoint_dir(spark), f"ledgerlens-bench-{uuid.uuid4().hex}")

    def job_pass(tag: str) -> tuple[float, dict]:
        steps: dict[str, float] = {}
        t0 = time.perf_counter()
        job.run(spark, Adapters(load_tables(spark, sf_dir)), os.path.join(scratch, tag), fx_cutoff=FX_CUTOFF,
                client_not_like=CLIENT_NOT_LIKE, timings=steps, workers=workers)
        return round(time.perf_counter() - t0, 3), steps

    cold_total, cold = job_pass("cold")
    total, steps = job_pass("warm")
    delete_path(spark, scratch)  # bench outputs are not kept
    per = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        per[name] = round(time.perf_counter() - t0, 3)
    out = {
        "metric": "report_job_total_sec",
        "value": total,
        "unit": "sec",
        "queries": per,
        "queries_total_sec": round(sum(per.values()), 3),
        "job_steps": steps,
        "cold_pass_total_sec": cold_total,
        "cold_pass": cold,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "engine": f"spark {spark.version} local[{cpus}]",
        "job_workers": workers,
        "note": "value = wall clock of the whole job; queries = each on its own; job_steps overlap",
    }
    if os.environ.get("BENCH_ORACLE") == "1":
        out["duckdb_reference"] = _duckdb_times(sf_dir)
    print(json.dumps(out))


def _duckdb_times(sf_dir: str) -> dict[str, float]:
    import duckdb

    from ledgerlens.plans.oracle import ORACLE_SQL
    from ledgerlens.sources.tables import DRIVER_TABLES

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    res = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        con.sql(ORACLE_SQL[name]).aggregate("count(*)").fetchall()
        res[name] = round(time.perf_counter() - t0, 3)
    res["total"] = round(sum(res.values()), 3)
    return res


if __name__ == "__main__":
    main()
