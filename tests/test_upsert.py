"""Upsert semantics on Parquet: insert, replace all non-key columns, touched years only."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agroclim.plans import upsert as up
from agroclim.session import checkpoint_dir
from agroclim.sources import files

SCHEMA = "region_code string, date date, precipitation_sum double"


def rows(spark, data):
    df = spark.createDataFrame([(a, b, None if c is None else float(c)) for a, b, c in data], SCHEMA)
    return df.withColumn("precipitation_sum", F.col("precipitation_sum").cast("decimal(6,2)")).withColumn(
        "_source", F.lit("open-meteo-archive"))


def test_weather_upsert(spark, tmp_path):
    path = str(tmp_path / "raw_weather")
    d = dt.date
    assert up.upsert_weather(spark, path, rows(spark, [("MA-01", d(2023, 1, 1), 1), ("MA-01", d(2024, 1, 1), 2)])) == 2
    assert up.upsert_weather(spark, path, rows(spark, [])) == 0
    year2023 = [f for f in (tmp_path / "raw_weather" / "year=2023").iterdir()]
    n = up.upsert_weather(spark, path, rows(spark, [("MA-01", d(2024, 1, 1), None), ("MA-02", d(2024, 1, 2), 3)]))
    assert n == 2
    table = {(r.region_code, r.date): r for r in spark.read.parquet(path).collect()}
    assert len(table) == 3
    assert table[("MA-01", d(2024, 1, 1))].precipitation_sum is None  # null overwrites
    assert table[("MA-01", d(2023, 1, 1))].precipitation_sum == 1
    assert [f for f in (tmp_path / "raw_weather" / "year=2023").iterdir()] == year2023  # untouched year kept as is
    with pytest.raises(ValueError, match="repeats key"):
        up.upsert_weather(spark, path, rows(spark, [("MA-01", d(2024, 1, 1), 1), ("MA-01", d(2024, 1, 1), 2)]))
    assert up.upsert_weather(spark, path, rows(spark, [("MA-01", d(2023, 1, 1), 1)])) == 1  # idempotent re-run
    assert spark.read.parquet(path).count() == 3
    # every row is stamped with its batch
    up.upsert_weather(spark, path, rows(spark, [("MA-03", d(2024, 2, 1), 1)]), batch_id="b-7", source="open-meteo-archive", source_url="http://x/1")
    per_row = rows(spark, [("MA-04", d(2024, 2, 1), 1)]).withColumn("source_url", F.lit("http://x/2"))
    up.upsert_weather(spark, path, per_row, batch_id="b-8", source_url="http://x/ignored")
    stamped = {r.region_code: (r._batch_id, r._source, r._source_url) for r in spark.read.parquet(path).where("date = '2024-02-01'").collect()}
    assert stamped == {"MA-03": ("b-7", "open-meteo-archive", "http://x/1"), "MA-04": ("b-8", "open-meteo-archive", "http://x/2")}
    # nothing of the upserts stays in the shared folder
    assert not [n for n in files.names(spark, checkpoint_dir(spark)) if n.startswith("upsert-")]


def test_only_touched_months_are_rewritten(spark, tmp_path):
    path, d = str(tmp_path / "t"), dt.date
    up.upsert_weather(spark, path, rows(spark, [("MA-01", d(2024, m, 1), m) for m in range(1, 13)]))

    def parts():
        return {p.parent.name: p.name for p in (tmp_path / "t").rglob("*.parquet")}

    before = parts()
    assert len(before) == 12
    up.upsert_weather(spark, path, rows(spark, [("MA-01", d(2024, 3, 1), 9), ("MA-02", d(2024, 5, 2), 1)]))
    after = parts()
    assert {m for m in after if after[m] != before[m]} == {"month=3", "month=5"}
    assert spark.read.parquet(path).count() == 13


def test_a_token_is_applied_once(spark, tmp_path):
    path, done = str(tmp_path / "t"), []
    mk = spark.createDataFrame([("a", 1)], "k string, v int")

    def work():
        done.append(1)
        return up.upsert(spark, path, mk, ["k"])

    assert up.apply_once(spark, path, "b-1", work) == 1
    assert up.apply_once(spark, path, "b-1", work) is None and len(done) == 1
    with pytest.raises(ValueError):
        up.apply_once(spark, path, "b-2", lambda: up.upsert(spark, path, mk.unionByName(mk), ["k"]))
    assert up.apply_once(spark, path, "b-2", work) == 1  # a batch that failed is not marked
    assert spark.read.parquet(path).count() == 1


def test_a_stopped_switch_is_undone(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    files.rename(spark, path, f"{path}.replaced")  # stopped between the two renames
    assert up.overwrite_table(spark, spark.range(5), path) == 5
    files.rename(spark, path, f"{path}.replaced")
    files.recover(spark, path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_agriculture_upsert(spark, tmp_path):
    path = str(tmp_path / "raw_agri")
    batch = spark.createDataFrame([("MA-01", 2020, 1.0)], "region_code string, annee int, production_tonnes double")
    with pytest.raises(ValueError):
        up.upsert_agriculture(spark, path, batch, "")
    up.upsert_agriculture(spark, path, batch, "mock-not-configured")
    up.upsert_agriculture(spark, path, batch.withColumn("production_tonnes", F.lit(2.0)), "datagovma")
    r = spark.read.parquet(path).collect()
    assert len(r) == 1 and (r[0].production_tonnes, r[0]._source) == (2.0, "datagovma")


def test_newest_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    mk = lambda data: spark.createDataFrame(data, "k string, v int, ingest_date string")
    up.upsert(spark, path, mk([("a", 1, "2024-01-02")]), ["k"], newest_wins=["ingest_date"])
    up.upsert(spark, path, mk([("a", 0, "2024-01-01")]), ["k"], newest_wins=["ingest_date"])  # older: ignored
    assert spark.read.parquet(path).first().v == 1
    up.upsert(spark, path, mk([("a", 2, "2024-01-05")]), ["k"], newest_wins=["ingest_date"])
    assert spark.read.parquet(path).first().v == 2


def test_overwrite_self(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    assert up.overwrite_table(spark, spark.read.parquet(path).where("id >= 2"), path) == 3
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4]
