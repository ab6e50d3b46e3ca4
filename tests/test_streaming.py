"""Incremental bronze -> silver: late corrections win, older re-deliveries do not."""

import json

from pyspark.sql import functions as F

from agroclim.constants import DAILY_VARIABLES
from agroclim.streaming.incremental import stream_bronze_to_silver


def land(root, ingest_date, region, start, times, precip):
    daily = {"time": times, **{v: [1.0] * len(times) for v in DAILY_VARIABLES}}
    daily["precipitation_sum"] = precip
    folder = root / f"ingest_date={ingest_date}" / f"region_code={region}" / f"range_start={start}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "data.json").write_text(json.dumps({"latitude": 0.0, "longitude": 0.0, "daily": daily}, indent=1))


def run(spark, bronze, silver, ckpt):
    q = stream_bronze_to_silver(spark, str(bronze), str(silver), str(ckpt))
    q.awaitTermination(120)
    assert q.exception() is None


def test_incremental_merge(spark, tmp_path):
    bronze, silver, ckpt = tmp_path / "bronze", tmp_path / "silver", tmp_path / "ckpt"
    land(bronze, "2024-01-03", "MA-01", "2023-12-30", ["2023-12-31", "2024-01-01", "2024-01-02"], [1.0, None, None])
    run(spark, bronze, silver, ckpt)
    t = {r.observation_date.isoformat(): r for r in spark.read.parquet(str(silver)).collect()}
    assert len(t) == 3 and t["2024-01-01"].precipitation_mm is None and t["2024-01-01"].has_water_balance_data is False
    # a later ingestion corrects the last two days (values arrive late)
    land(bronze, "2024-01-05", "MA-01", "2024-01-01", ["2024-01-01", "2024-01-02"], [2.0, 3.0])
    # an older re-delivery of the first payload must not overwrite the correction
    land(bronze, "2024-01-02", "MA-01", "2023-12-30", ["2024-01-01"], [9.0])
    run(spark, bronze, silver, ckpt)
    t = {r.observation_date.isoformat(): r for r in spark.read.parquet(str(silver)).collect()}
    assert len(t) == 3
    assert float(t["2024-01-01"].precipitation_mm) == 2.0 and float(t["2024-01-02"].precipitation_mm) == 3.0
    assert float(t["2023-12-31"].precipitation_mm) == 1.0
    run(spark, bronze, silver, ckpt)  # nothing new: same table
    assert spark.read.parquet(str(silver)).count() == 3



def test_stream_continues_a_batch_built_silver(spark, tmp_path):
    from agroclim.plans import jobs

    bronze, silver, ckpt = tmp_path / "bronze", tmp_path / "silver", tmp_path / "ckpt"
    land(bronze / "openmeteo", "2024-01-03", "MA-01", "2024-01-01", ["2024-01-01", "2024-01-02"], [1.0, None])
    (bronze / "agriculture").mkdir(parents=True)
    weather = jobs.silver_weather_from_bronze(spark, str(bronze))
    from agroclim.sources.sinks import write_silver_weather

    write_silver_weather(weather, str(silver))
    land(bronze / "openmeteo", "2024-01-04", "MA-01", "2024-01-02", ["2024-01-02"], [5.0])
    run(spark, bronze / "openmeteo", silver, ckpt)
    t = {r.observation_date.isoformat(): r for r in spark.read.parquet(str(silver)).collect()}
    assert float(t["2024-01-02"].precipitation_mm) == 5.0 and float(t["2024-01-01"].precipitation_mm) == 1.0
    assert t["2024-01-02"].ingest_date == "2024-01-04" and t["2024-01-01"].ingest_date == "2024-01-03"


def test_a_replayed_batch_does_nothing(spark, tmp_path):
    from agroclim.schemas import BRONZE_WEATHER
    from agroclim.streaming.incremental import apply_batch

    silver = tmp_path / "silver"

    def payload(ingest_date, times, precip):
        daily = {"time": times, **{v: [1.0] * len(times) for v in DAILY_VARIABLES}, "precipitation_sum": precip}
        text = json.dumps({"latitude": 0.0, "longitude": 0.0, "daily": daily})
        df = spark.createDataFrame([(text, ingest_date, "MA-01", times[0], ingest_date)], "text string, ingest_date string, region_code string, range_start string, _file string")
        return df.select(F.from_json("text", BRONZE_WEATHER).alias("p"), "ingest_date", "region_code", "range_start", "_file").select("p.*", "ingest_date", "region_code", "range_start", "_file")

    def parts():
        return {str(p.parent.relative_to(silver)): p.name for p in silver.rglob("*.parquet")}

    days = ["2023-12-31", "2024-01-01", "2024-02-01"]
    assert apply_batch(payload("2024-02-02", days, [1.0, 2.0, None]), 0, str(silver), "s") == 3
    first = parts()
    assert sorted(first) == ["year=2023/month=12", "year=2024/month=1", "year=2024/month=2"]
    correction = payload("2024-02-03", ["2024-02-01"], [5.0])
    assert apply_batch(correction, 1, str(silver), "s") == 1
    second = parts()
    assert {k for k in second if second[k] != first[k]} == {"year=2024/month=2"}  # one file rewritten
    assert apply_batch(correction, 1, str(silver), "s") is None
    assert parts() == second
    assert apply_batch(correction, 0, str(silver), "other") == 1  # another stream counts its own batches
    assert sorted(float(r.precipitation_mm) for r in spark.read.parquet(str(silver)).collect()) == [1.0, 2.0, 5.0]
