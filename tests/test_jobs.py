"""The three batch jobs end to end on bronze files written by the test."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from agroclim.constants import DAILY_VARIABLES
from agroclim.operators import cleaning
from agroclim.operators.quality import QualityError
from agroclim.plans import jobs, serving
from agroclim.sources import sinks


def land_year(root, region, year, ingest_date, precip):
    days = [dt.date(year, 1, 1) + dt.timedelta(days=i) for i in range((dt.date(year + 1, 1, 1) - dt.date(year, 1, 1)).days)]
    daily = {"time": [d.isoformat() for d in days]}
    for v in DAILY_VARIABLES:
        daily[v] = [20.0] * len(days)
    daily["precipitation_sum"] = [precip] * len(days)
    daily["et0_fao_evapotranspiration"] = [4] * len(days)
    folder = root / "openmeteo" / f"ingest_date={ingest_date}" / f"region_code={region}" / f"range_start={year}-01-01"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "data.json").write_text(json.dumps({"latitude": 1.0, "longitude": 2.0, "daily": daily}))


def test_medallion_jobs(spark, tmp_path):
    bronze_root = tmp_path / "bronze"
    land_year(bronze_root, "MA-01", 2023, "2024-01-02", 0.5)
    land_year(bronze_root, "MA-01", 2024, "2025-01-02", 3.0)
    land_year(bronze_root, "MA-01", 2024, "2025-01-01", 9.0)  # older delivery of the same days
    land_year(bronze_root, "MA-12", 2024, "2025-01-02", 0.1)
    agri = spark.createDataFrame(
        [("Tanger-Tétouan", "2023", "1 000,5", "10", "20"), ("Atlantis", "2023", "1", "1", "1"),
         ("ma-12", "2024/2025", "7", "8", "9")],
        "region string, annee string, production_tonnes string, surface_irriguee_ha string, ressource_hydrique_m3 string")
    sinks.land_bronze_agriculture(agri, str(bronze_root / "agriculture"), "2025-01-03", "mock-not-configured")
    sinks.land_bronze_agriculture(agri.limit(1).withColumn("production_tonnes", F.lit("2000")),
                                  str(bronze_root / "agriculture"), "2025-01-03", "datagovma")

    counts = jobs.bronze_to_silver(spark, str(bronze_root), str(tmp_path / "silver"), cleaning.alias_table(spark))
    assert counts == {"weather_daily": 365 + 366 + 366, "agriculture_regional": 2}
    weather, agriculture = jobs.read_silver(spark, str(tmp_path / "silver"))
    assert {float(r.precipitation_mm) for r in weather.where("region_code = 'MA-01' and year = 2024").collect()} == {3.0}
    a = {r.region_code: r for r in agriculture.collect()}
    assert float(a["MA-01"].production_tonnes) == 2000.0 and a["MA-01"].data_source == "datagovma"  # real data wins a tie
    assert a["MA-12"].year == 2024 and a["MA-12"].is_mock is True

    sinks.export_dim_region(spark, str(tmp_path / "dim"))
    from agroclim.sources.bronze import load_dim_region

    gold_counts = jobs.silver_to_gold(spark, str(tmp_path / "silver"), load_dim_region(spark, str(tmp_path / "dim")), str(tmp_path / "gold"))
    report = jobs.check_stored(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), [r.region_code for r in load_dim_region(spark, str(tmp_path / "dim")).collect()])
    assert report.count() == 51 and report.where("violations > 0").count() == 0
    with pytest.raises(QualityError, match="dim_region.region_code accepted_values"):
        jobs.check_stored(spark, str(tmp_path / "silver"), str(tmp_path / "gold"), ["MA-01"])
    assert spark.read.parquet(str(tmp_path / "gold" / "quality_report")).where("violations > 0").count() == 1
    assert gold_counts == {"dim_region": 12, "dim_year": 2, "fct_region_climate_kpi": 3, "fct_solar_potential": 3}
    climate = {(r.region_code, r.year): r for r in spark.read.parquet(str(tmp_path / "gold" / "fct_region_climate_kpi")).collect()}
    k = climate[("MA-01", 2024)]
    assert k.is_complete_year and float(k.precip_et0_ratio) == 0.75 and k.drought_class == "humide"
    assert climate[("MA-12", 2024)].drought_class == "tres_sec" and climate[("MA-01", 2023)].dry_days == 365
    version = jobs.gold_to_serving(spark, str(tmp_path / "gold"), str(tmp_path / "serving"))
    assert serving.read_serving(spark, str(tmp_path / "serving"), "fct_solar_potential").count() == 3 and version
    assert jobs.read_marts(spark, str(tmp_path / "gold")).count() == 3


def test_corrections_refresh_their_months_only(spark, tmp_path):
    from agroclim.operators import gold
    from agroclim.plans import incremental_gold as inc
    from agroclim.plans.upsert import month_of, upsert
    from agroclim.sources.sinks import region_rows

    silver, part, full = str(tmp_path / "silver"), str(tmp_path / "part"), str(tmp_path / "full")
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(3 * 365)]
    rows = spark.createDataFrame([(r, d, 15.0 + d.month, d.day / 4, 3.0, 20.0, 50.0) for r in ("MA-01", "MA-02") for d in days],
                                 "region_code string, observation_date date, t double, p double, e double, s double, h double")
    weather = rows.select(
        "region_code", "observation_date", *[F.col(c).cast(t).alias(n) for c, n, t in (("t", "temp_mean_c", "decimal(5,2)"), ("p", "precipitation_mm", "decimal(6,2)"),
                                                                        ("e", "et0_mm", "decimal(6,2)"), ("h", "humidity_mean_pct", "decimal(5,2)"))],
        F.round(F.col("s").cast("decimal(7,2)") / 3, 3).cast("decimal(10,3)").alias("solar_radiation_kwh_m2"), F.lit(True).alias("has_water_balance_data"), F.lit(True).alias("has_solar_data"))
    sinks.write_silver_weather(weather, f"{silver}/weather_daily", full=True)
    agri = spark.createDataFrame([("MA-01", 2023, 1.0, 2.0, 3.0, "datagovma", False)],
                                 "region_code string, year int, production_tonnes double, irrigated_area_ha double, water_resource_m3 double, data_source string, is_mock boolean")
    sinks.write_silver_agriculture(agri, f"{silver}/agriculture_regional")
    dim = region_rows(spark)
    first = inc.refresh_gold(spark, silver, dim, part)
    assert first["fct_region_climate_kpi"] == 6

    window = weather.where("region_code = 'MA-01' and observation_date between '2023-02-26' and '2023-03-02'")
    correction = window.withColumn("precipitation_mm", F.lit(30).cast("decimal(6,2)")).withColumn("solar_radiation_kwh_m2", F.lit(None).cast("decimal(10,3)"))
    upsert(spark, f"{silver}/weather_daily", correction, ["region_code", "observation_date"], partitions=month_of("observation_date"))
    months = inc.touched_months(correction)
    assert months == [(2023, 2), (2023, 3)]
    # the files of every other month become unreadable: the refresh must not open them
    kept = {}
    for f in (tmp_path / "silver" / "weather_daily").rglob("*.parquet"):
        if f.parent.name not in ("month=2", "month=3") or f.parent.parent.name != "year=2023":
            kept[f] = f.read_bytes()
            f.write_bytes(b"no parquet here")
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    inc.refresh_gold(spark, silver, dim, part, months)
    for f, data in kept.items():
        f.write_bytes(data)
    spark.catalog.clearCache()
    counts = jobs.silver_to_gold(spark, silver, dim, full)
    assert counts["dim_year"] == 3
    for name in ("fct_region_climate_kpi", "fct_solar_potential", "dim_year", "int_weather_agriculture_join"):
        a, b = spark.read.parquet(f"{part}/{name}"), spark.read.parquet(f"{full}/{name}")
        assert a.dtypes == b.dtypes
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), name
    # totals of any split of the days add up to the same
    halves = [gold.day_totals(weather.where(c)) for c in ("day(observation_date) % 2 = 0", "day(observation_date) % 2 = 1")]
    assert sorted(map(repr, gold.merge_totals(halves[0].unionByName(halves[1])).collect())) == sorted(map(repr, gold.day_totals(weather).collect()))


def test_colliding_labels_in_one_load_raise(spark, tmp_path):
    bronze_root = tmp_path / "bronze"
    agri = spark.createDataFrame(
        [("Souss-Massa", "2020", "1", "1", "1"), ("Souss-Massa-Drâa", "2020", "2", "2", "2")],
        "region string, annee string, production_tonnes string, surface_irriguee_ha string, ressource_hydrique_m3 string")
    sinks.land_bronze_agriculture(agri, str(bronze_root / "agriculture"), "2025-01-03", "datagovma")
    with pytest.raises(ValueError, match="repeats key"):
        jobs.silver_agriculture_from_bronze(spark, str(bronze_root), cleaning.alias_table(spark)).collect()


def test_runs_are_recorded(spark, tmp_path):
    from agroclim.constants import SOURCE_AGRI_FALLBACK, SOURCE_AGRI_MOCK, SOURCE_AGRI_REAL
    from agroclim.plans import ledger
    from agroclim.sources.sinks import region_rows

    root, aliases, dim = str(tmp_path / "raw"), cleaning.alias_table(spark), region_rows(spark)
    weather = spark.createDataFrame([("MA-01", dt.date(2024, 1, 1), 1.25), ("MA-02", dt.date(2024, 1, 1), 2.0)], "region_code string, date date, precipitation_sum double")
    agri = spark.createDataFrame([("Rabat-Salé-Kénitra", "2020", "1", "2", "3"), ("Atlantis", "2020", "1", "2", "3"), ("MA-02", "N/A", "1", "2", "3")],
                                 "region_code string, annee string, production_tonnes string, surface_irriguee_ha string, ressource_hydrique_m3 string")
    failed = spark.createDataFrame([("MA-04", "2024-01-01", "2024-01-31", "boom")], "region_code string, chunk_start string, chunk_end string, error string")

    def run(**sources):
        return jobs.ingest(spark, root, aliases=aliases, dim=dim, **sources).status

    assert run(weather=weather, agriculture=(agri, SOURCE_AGRI_REAL), batch_id="b1") == 0       # full success
    assert run(agriculture=(agri, SOURCE_AGRI_REAL), failed_chunks=failed, batch_id="b2") == 1   # a chunk failed
    assert run(agriculture=(agri, SOURCE_AGRI_MOCK), batch_id="b3") == 0                         # the mock by configuration
    assert run(agriculture=(agri, SOURCE_AGRI_FALLBACK), batch_id="b4") == 1                     # the mock after a read error
    assert run(weather=weather, batch_id="b5") == 0                                              # agriculture skipped
    junk = agri.withColumn("annee", F.lit("2020")).withColumn("production_tonnes", F.lit("much"))
    with pytest.raises(Exception, match="much"):
        run(weather=weather.withColumn("precipitation_sum", F.lit(7.0)), agriculture=(junk, SOURCE_AGRI_REAL), batch_id="b6")
    with pytest.raises(ValueError, match="source is mandatory"):
        run(agriculture=(agri, ""), batch_id="b7")
    got = {r.batch_id: (r.weather_rows, r.agriculture_rows, r.rejected_rows, r.failed_chunks, r.agriculture_source, r.status) for r in ledger.read_runs(spark, root).collect()}
    assert got == {
        "b1": (2, 1, 2, 0, SOURCE_AGRI_REAL, 0), "b2": (0, 1, 2, 1, SOURCE_AGRI_REAL, 1), "b3": (0, 1, 2, 0, SOURCE_AGRI_MOCK, 0),
        "b4": (0, 1, 2, 0, SOURCE_AGRI_FALLBACK, 1), "b5": (2, 0, 0, 0, "skipped", 0), "b6": (2, 0, 1, 0, "skipped", 2), "b7": (0, 0, 2, 0, "skipped", 2)}
    # the weather of the failed run stays, under its batch id
    stored = spark.read.parquet(f"{root}/weather_daily")
    assert {(r.region_code, float(r.precipitation_sum), r._batch_id) for r in stored.collect()} == {("MA-01", 7.0, "b6"), ("MA-02", 7.0, "b6")}
    rejects = spark.read.parquet(f"{root}/agriculture_rejects").where("batch_id = 'b1'")
    assert {(r.label, r.reject_reason) for r in rejects.collect()} == {("Atlantis", "unknown_region"), ("MA-02", "invalid_year")}
    assert spark.read.parquet(f"{root}/agriculture_absent").where("batch_id = 'b1'").count() == 11


def test_the_newest_days_open_their_months_only(spark, tmp_path):
    root = str(tmp_path)
    days = [dt.date(2023, 11, 1) + dt.timedelta(days=i) for i in range(94)]  # to 2024-02-02
    rows = spark.createDataFrame([("MA-01", d) for d in days], "region_code string, observation_date date").withColumn("temp_mean_c", F.lit(1).cast("decimal(5,2)"))
    sinks.write_silver_weather(rows, f"{root}/weather_daily", full=True)
    for month in ("year=2023/month=11", "year=2023/month=12"):  # older months cannot be read
        for f in (tmp_path / "weather_daily" / month).glob("*.parquet"):
            f.write_bytes(b"no parquet here")
            (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    assert jobs.newest_day(spark, root) == dt.date(2024, 2, 2)
    got = sorted(r.observation_date for r in jobs.recent_weather(spark, root).collect())
    assert got == [dt.date(2024, 1, 29) + dt.timedelta(days=k) for k in range(5)]
    (tmp_path / "empty" / "weather_daily").mkdir(parents=True)
    assert jobs.recent_weather(spark, str(tmp_path / "empty")).count() == 0
