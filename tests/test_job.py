import datetime as dt
import os

from ledgerlens.plans import job
from ledgerlens.plans.registry import FX_CUTOFF, QUERIES
from ledgerlens.sources.adapters import Adapters
from ledgerlens.sources.tables import load_tables

SF = "/root/testdata/sf0.001"


def test_job_writes_every_table(spark, tmp_path):
    src = Adapters(load_tables(spark, SF))
    ckpt = spark.conf.get("spark.checkpoint.dir").replace("file:", "")
    before = set(os.listdir(ckpt))
    out = str(tmp_path / "out")
    snaps = [str(tmp_path / "files_a"), str(tmp_path / "files_b")]
    checks = {}
    written = job.run(spark, src, out, snaps, run_date=dt.date(2024, 2, 1), fx_cutoff=FX_CUTOFF,
                      client_not_like="%MACHINERY%", checks=checks)
    master = spark.read.parquet(written["project_data"])
    assert checks == {"duplicate_waves": sum(n for (n,) in master.groupBy("project_wave_id").count().where("count > 1").select(
        "count").collect())}
    assert set(written) == set(job.RESULT_TABLES) | {"full_table", "weekly_avg", job.EXTENDED_TABLE}
    # the written summary equals the registered query on the same tables
    got = spark.read.parquet(written["project_summary_data_export"])
    exp = QUERIES["report_project_summary"](spark, SF)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    ext = spark.read.parquet(written[job.EXTENDED_TABLE])
    assert ext.count() == QUERIES["report_extended_fx"](spark, SF).count()
    # the run's source snapshot is removed once the results are written
    assert not [p for p in set(os.listdir(ckpt)) - before if p.startswith("ledgerlens-snapshot-")]
    for d in snaps:
        assert os.path.isdir(os.path.join(d, "cost_dump", "run_date=2024_02_01"))
        assert os.path.isdir(os.path.join(d, "accounting_cost_dump", "run_date=2024_02_01"))


def test_job_without_snapshot(spark, tmp_path):
    src = Adapters(load_tables(spark, SF))
    written = job.run(spark, src, str(tmp_path / "out"), fx_cutoff=FX_CUTOFF, client_not_like="%MACHINERY%",
                      snapshot_views=(), workers=2)
    got = spark.read.parquet(written["cost_data_export"])
    exp = QUERIES["report_cost_dump"](spark, SF)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_shared_part_built_once_under_concurrency(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    src = Adapters(load_tables(spark, SF))
    snap = job.SnapshotSource(src, spark, str(tmp_path / "snap"), names=())
    calls = []

    def build():
        calls.append(1)
        return spark.range(10).toDF("id")

    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda _: snap.shared_part("ids", build).count(), range(8)))
    assert counts == [10] * 8 and len(calls) == 1


def test_job_pushes_every_table_and_leaves_no_copy_when_it_fails(spark, tmp_path):
    import pytest

    src = Adapters(load_tables(spark, SF))
    ckpt = spark.conf.get("spark.checkpoint.dir").replace("file:", "")
    before, pushed = set(os.listdir(ckpt)), {}

    def push(df, name):
        pushed[name] = df.count()
        if name == "weekly_avg":
            raise RuntimeError("target is away")

    with pytest.raises(RuntimeError, match="target is away"):
        job.run(spark, src, str(tmp_path / "out"), fx_cutoff=FX_CUTOFF, snapshot_views=("project",), push=push, workers=1)
    assert pushed["weekly_avg"] > 0 and not [
        p for p in set(os.listdir(ckpt)) - before if p.startswith("ledgerlens-snapshot-")]


def test_rates_from_a_plain_csv(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Date,USD,GBP\n2024-01-01,1.5,N/A\n")
    rates = job._rates(spark, None, str(tmp_path / "r.csv"))
    assert rates["fx_wide"].columns == ["Date", "USD", "GBP"] and rates["fx_daily"].count() == 1
