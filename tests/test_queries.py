"""Every query with SQL against DuckDB on the small tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from refrain.operators import training
from refrain.plans import catalog
from refrain.plans.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if v is None or v is pd.NA or isinstance(v, float) and np.isnan(v):
            return None
        return float(v) if isinstance(v, (int, float, np.integer, np.floating)) and not isinstance(v, (bool, np.bool_)) else str(v)

    return sorted((tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    got, want = rows(got), rows(want)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or isinstance(x, float) and isinstance(y, float) and abs(x - y) <= 1e-5 * max(1, abs(y))


@pytest.mark.parametrize("name", ["identity_fuzzy", "train_logistic"])
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_taste_variants_take_whole_vectors_and_keys(spark, monkeypatch):
    taken, real = {}, catalog.observations

    def stop(samples, *, observations, **_):
        taken["rows"] = observations
        raise training.NothingTrained([])

    monkeypatch.setattr(training, "train_taste_models", stop)
    monkeypatch.setattr(catalog, "observations", lambda s, sf: real(s, sf).withColumn("track_id", F.lit("u12345678901")))
    assert catalog.taste_variants(spark, SF).count() == 0
    audio = taken["rows"].filter("feature_name = 'audio_v1'").select(F.substring("track_id", 2, 20).cast("long").alias("vec_id"), "value_vector")
    whole = catalog.table(spark, SF, "embeddings").join(audio, "vec_id").filter(F.col("embedding").cast("array<double>") == F.col("value_vector"))
    assert whole.count() == catalog.table(spark, SF, "embeddings").count()
    assert {r.track_id for r in taken["rows"].filter("feature_name = 'size_v1'").select("track_id").distinct().collect()} == {"k12345678901"}


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
