"""One project holds most rows: results are identical whether or not adaptive
execution splits the hot partitions."""

import contextlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fixtures import CURRENCIES, STATUSES, T, Source
from ledgerlens.plans import parts, reports

D = T(2021, 1, 1)


def _skewed(spark):
    hot_waves = [(1000 + w, 1) for w in range(40)]
    cold_waves = [(2000 + p, p) for p in range(2, 30)]
    lines = [(i, 1, 1000 + i % 40, i % 7, 1 + i % 3, 100 + i, 12 if i % 2 else 3, None, D, D) for i in range(2000)]
    lines += [(5000 + p, p, 2000 + p, p % 7, 1, 500, 12, None, D, D) for p in range(2, 30)]
    costs = [(i, 1, 1000 + i % 40, 5 + i % 3, 12, 1, "c", 1, D) for i in range(600)]
    return Source(
        spark, project_status=STATUSES, currency=CURRENCIES, cost_type_translation=[(1, "Travel")],
        company=[(c, f"Company {c}", None, None, None, 1, None) for c in range(1, 40)],
        project=[(p, 1, p, f"P{p}", f"C-{p}", D, None, None, None) for p in range(1, 30)],
        project_account=[(1, c) for c in range(1, 6)] + [(p, p) for p in range(2, 30)],
        wave=hot_waves + cold_waves, sales_line=lines, cost_line=costs,
        product=[(k + 1, k, f"TYPE-Brand#{k} - part {k}") for k in range(7)])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


@contextlib.contextmanager
def _splitting(spark, on=True):
    """Shuffle joins only; with ``on``, partitions split at a few hundred bytes."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
            "spark.sql.adaptive.skewJoin.enabled": str(on).lower()}
    if on:
        conf |= {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.mark.parametrize("build", [reports.project_summary, reports.cost_dump, reports.sold_products,
                                   reports.accounting_dump, reports.project_master, reports.data_export,
                                   reports.extended_export_base])
def test_hot_project_split_keeps_results(spark, build):
    with _splitting(spark, on=False):
        plain = _rows(build(_skewed(spark)))
    with _splitting(spark):
        split = _rows(build(_skewed(spark)))
    assert split == plain and (plain or build is reports.data_export)


def test_the_wave_join_itself_is_split(spark):
    """399,000 of 400,000 waves belong to one project."""

    def rows_in_task(batches):
        yield pa.RecordBatch.from_pydict({"n": [sum(b.num_rows for b in batches)]})

    class Waves:
        wave = spark.range(400_000, numPartitions=8).select(
            F.when(F.col("id") < 399_000, F.lit(1)).otherwise(F.col("id") % 50).cast("long").alias("project_id"), "id")

        project = spark.range(60, numPartitions=8)

    projects = Waves.project.select(F.col("id").alias("project_id"))
    with _splitting(spark):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        df = parts.with_waves(projects, Waves)
        counts = [r.n for r in df.mapInArrow(rows_in_task, "n long").collect()]
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        plan = execution.executedPlan().toString()
    assert sum(counts) == 400_000 + 10  # ten projects have no wave
    assert max(counts) < 0.25 * sum(counts)
    final = plan.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "SortMergeJoin(skew=true)" in final
