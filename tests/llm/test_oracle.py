"""The queries against their SQL, as views, on the given documents and on odd rows."""

import math

import duckdb
import pytest

from .conftest import DOCS, SF

from ledgerlens.llm.oracle import ORACLE_SQL
from ledgerlens.llm.queries import QUERIES


def same(spark, name, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')"
                if folder != SF else f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    con.execute(f"CREATE VIEW checked AS {ORACLE_SQL[name]}")
    got, want = QUERIES[name](spark, folder), con.sql("SELECT * FROM checked")
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)

    def rows(values, names):
        return sorted((tuple(v if not isinstance(v, float) else None if math.isnan(v) else float(f"{v:.12g}")
                             for v in (r[names.index(c)] for c in columns)) for r in values), key=str)

    assert rows(map(tuple, got.collect()), got.columns) == rows(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_given_documents(spark, name):
    same(spark, name, SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_odd_rows(spark, odd, name, tmp_path):
    odd.select("doc_id", "text", "lang", "source", "n_chars").unionByName(spark.createDataFrame([
        (50, "a\rb\x0bc\x0cd e\tf", "en", "a", 3), (51, "Ärger UND mehr", "de", None, 4), (52, "É", None, "", None)], DOCS)).write.parquet(
        f"{tmp_path}/documents.parquet")
    same(spark, name, str(tmp_path))
