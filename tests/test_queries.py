"""Every query of the core against its SQL in DuckDB, over whole tables."""

import math
from decimal import Decimal
from pathlib import Path

import pytest

from quillstone.plans import registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(float(v), 6) if isinstance(v, (float, Decimal)) else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(name, spark, duck):
    df = registry.queries()[name](spark, str(DATA))
    cols = sorted(df.columns)
    rows = ordered(df.select(*cols).collect())
    assert len(set(cols)) == len(cols)
    sql = registry.oracle_sql().get(name)
    if sql:
        quoted = ", ".join(f'"{c}"' for c in cols)
        assert sorted(duck.sql(sql).columns) == cols
        assert rows == ordered(duck.sql(f"SELECT {quoted} FROM ({sql})").fetchall())


def test_no_sql_without_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["lang", "docs", "tokens", "sentences", "oversized"]
    assert set(e.oracle_sql()) <= set(e.queries())


def test_token_windows_hold_whole_texts(spark):
    from pyspark.sql import functions as F

    from quillstone.functions import text as t

    q = registry.queries()
    windows = q["all_token_windows"](spark, str(DATA))
    counts = {r.doc_id: r.tokens for r in q["text_sizes"](spark, str(DATA)).collect() if r.tokens}
    per = windows.select("doc_id", "window_no", t.token_count(F.col("window")).alias("n")).groupBy("doc_id").agg(F.sum("n").alias("n"), F.max("window_no").alias("last")).collect()
    assert {r.doc_id: r.n for r in per} == counts
    assert max(r.last for r in per) > 1
    assert {r.doc_id: r.last for r in per} == {r.doc_id: r.n_windows for r in q["fixed_token_windows"](spark, str(DATA)).collect()}
