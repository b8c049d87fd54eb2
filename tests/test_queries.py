"""Every query against its SQL counterpart on the smallest data set."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{SMALL}/{name}'")
    return con


def canon(df):
    def text(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(float(v)) if isinstance(v, float) else str(v)

    df = df[sorted(df.columns)].map(text)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


NUMBERED = re.compile(r"op\d+_")
OWN = sorted(k for k in SQL if not NUMBERED.match(k) and k != "pipeline")


@pytest.mark.parametrize("name", OWN)
def test_same_as_sql(spark, db, name):
    ours, theirs = canon(QUERIES[name](spark, SMALL).toPandas()), canon(db.execute(SQL[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    assert len(ours) == len(theirs) and ours.equals(theirs)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
    own = {k for k in QUERIES if not NUMBERED.match(k) and k != "pipeline"}
    assert own - set(SQL) == {"fit_model", "config_sweep", "robustness"}


def test_no_exchange_in_front_of_row_local_queries(spark):
    for name in ("urgency_score", "tokenize", "typo_corpus"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name


def test_stream_over_a_folder_of_part_files(spark, tmp_path):
    whole = spark.read.parquet(f"{SMALL}/documents.parquet")
    whole.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["stream_scores"](spark, str(tmp_path)).select("review_id", "route")
    want = QUERIES["stream_scores"](spark, SMALL).select("review_id", "route")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
