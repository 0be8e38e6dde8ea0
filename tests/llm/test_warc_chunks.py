import base64
import gzip
import hashlib
import os
import subprocess
import sys

import pytest
from .conftest import PAGES, SF
from pyarrow import fs as pafs

from ledgerlens.llm import common, warc_chunks as w

BIG = "0123456789abcdef\r\n\r\n" * 30_000


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture()
def pages(spark):
    rows = [(1, "http://a/\r\nx y", "<p>é</p>"), (2, None, BIG), (3, "u", BIG), (4, "u", BIG), (5, "u", None), (6, "u", ""),
            (7, "u", "a\r\n\r\nWARC/1.1\r\n"), (None, "u", "lonely"), (None, "u", BIG), (8, "u", "twice"), (8, "u", "twice")]
    return spark.createDataFrame([r + ("clash",) for r in rows], PAGES + ", payload string")


def test_round_trip(pages):
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in w.round_trip(pages).collect()), key=str)
    n = len(BIG)
    expected = [(1, 9, digest("<p>é</p>"), "response", None), (2, n, digest(BIG), "revisit", 4), (3, n, digest(BIG), "revisit", 4),
                (4, n, digest(BIG), "response", None), (5, 0, digest(""), "revisit", 6), (6, 0, digest(""), "response", None),
                (7, 15, digest("a\r\n\r\nWARC/1.1\r\n"), "response", None), (None, 6, digest("lonely"), "response", None),
                (None, n, digest(BIG), "revisit", 4), (8, 5, digest("twice"), "response", None),
                (8, 5, digest("twice"), "response", None)]
    assert got == sorted(expected, key=str)


def test_chunks_carry_growing_digests_and_give_the_payload_back(spark, pages):
    index = w.write(pages, common.scratch_path(spark, "warc-test"))
    rows = w.read(index, with_data=True).where("page_id = 4").orderBy("chunk_no").collect()
    assert [r.chunk_no for r in rows] == list(range(len(rows))) and len(rows) > 5
    assert all(len(r.data) == r.n_bytes <= w.CHUNK for r in rows)
    sha = hashlib.sha1()
    for r in rows:
        sha.update(r.data)
        assert r.digest == base64.b32encode(sha.digest()).decode()
    assert b"".join(r.data for r in rows).decode() == BIG


def test_archives_are_gzip_members_of_warc_records(spark, pages):
    index = w.write(pages, common.scratch_path(spark, "warc-test")).collect()
    for name in {r.archive for r in index}:
        f, path = pafs.FileSystem.from_uri(name)
        with f.open_input_stream(path, compression=None) as s:
            data = gzip.decompress(s.read())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n") and b"\r\nx y" not in data


def test_damage_is_found(spark, pages):
    index = w.write(pages.where("page_id = 2"), common.scratch_path(spark, "warc-test"))
    f, path = pafs.FileSystem.from_uri(index.first().archive)
    with f.open_input_stream(path, compression=None) as s:
        data = gzip.decompress(s.read())
    with f.open_output_stream(path, compression=None) as s:
        s.write(gzip.compress(data.replace(b"0123456789abcdef", b"0123456789abcdeF", 1)))
    with pytest.raises(Exception, match="damaged record"):
        w.records(w.read(index)).collect()


def test_empty_table(spark):
    assert w.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_pages_against_a_plain_reading(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    rows = rows.unionByName(rows.where("page_id % 7 = 0").withColumn("page_id", rows["page_id"] + 100_000)).collect()
    last = {}
    for r in rows:
        last[r.html or ""] = max(last.get(r.html or "", r.page_id), r.page_id)
    want = [(r.page_id, len((r.html or "").encode()), digest(r.html), *(
        ("response", None) if last[r.html or ""] == r.page_id else ("revisit", last[r.html or ""]))) for r in rows]
    got = w.round_trip(spark.createDataFrame(rows, PAGES).repartition(3)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == sorted(want)
    assert {x[3] for x in want} == {"response", "revisit"}


def test_payloads_are_not_shuffled(spark, pages):
    plan = w.typed(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from ledgerlens.session import build_session, checkpoint_dir
spark = build_session("local[1]", shuffle_partitions=1, extra={{"spark.driver.memory": "1536m"}})
checkpoint_dir(spark, {folder!r})
from pyspark.sql import functions as F
from ledgerlens.llm import warc_chunks as w
pages = spark.range(1).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(
    F.concat(F.lit("123456789abcdef"), F.col("id").cast("string")), 12_500_000).alias("html"))  # no literal, which would be folded
row, = w.round_trip(pages).collect()
print(row.payload_bytes, row.payload_digest)
"""


def test_a_page_of_200_mb_in_a_small_heap(tmp_path):
    """The payload is a cell of 200 MB in a heap of 1.5 GB; what Python holds are chunks."""
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    ran = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, folder=str(tmp_path / "shared"))], cwd=tmp_path,
                         capture_output=True, text=True, timeout=300, env=os.environ | {"PYTHONDONTWRITEBYTECODE": "1"})
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert ran.stdout.split() == ["200000000", digest("123456789abcdef0" * 12_500_000)]
