"""Ingestion planning: chunks, windows, region selection, gaps and repair list."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from agroclim.functions import daybits
from agroclim.operators import planning, runs

D = dt.date


def chunks(spark, start, end):
    req = spark.createDataFrame([("MA-01", start, end)], "region_code string, start_date date, end_date date")
    return [(r.chunk_start, r.chunk_end) for r in planning.split_chunks(req).orderBy("chunk_index").collect()]


def test_chunk_vectors(spark):
    assert chunks(spark, D(2015, 1, 1), D(2016, 12, 31)) == [(D(2015, 1, 1), D(2016, 12, 31))]
    assert chunks(spark, D(2015, 1, 1), D(2018, 12, 31)) == [(D(2015, 1, 1), D(2016, 12, 31)), (D(2017, 1, 1), D(2018, 12, 31))]
    assert chunks(spark, D(2016, 2, 29), D(2020, 1, 1)) == [(D(2016, 2, 29), D(2018, 2, 27)), (D(2018, 2, 28), D(2020, 1, 1))]
    assert chunks(spark, D(2016, 2, 29), D(2024, 6, 1))[-2:] == [(D(2022, 2, 28), D(2024, 2, 27)), (D(2024, 2, 28), D(2024, 6, 1))]
    assert chunks(spark, D(2020, 1, 2), D(2020, 1, 1)) == []
    assert chunks(spark, D(2020, 1, 1), D(2020, 1, 1)) == [(D(2020, 1, 1), D(2020, 1, 1))]


def test_chunks_match_python_loop(spark):
    def loop(start, end):
        out, cur = [], start
        while cur <= end:
            try:
                nxt = cur.replace(year=cur.year + 2) - dt.timedelta(days=1)
            except ValueError:
                nxt = cur.replace(month=2, day=28, year=cur.year + 2) - dt.timedelta(days=1)
            out.append((cur, min(nxt, end)))
            cur = min(nxt, end) + dt.timedelta(days=1)
        return out

    starts = [D(2012, 2, 29), D(2015, 3, 31), D(2015, 12, 31), D(2016, 1, 31), D(2019, 2, 28)]
    for s in starts:
        assert chunks(spark, s, D(2026, 9, 15)) == loop(s, D(2026, 9, 15))


def test_date_window(spark):
    df = spark.createDataFrame([(D(2026, 9, d),) for d in range(1, 16)], "date date")
    got = planning.date_window(df, F.lit(D(2026, 9, 15))).collect()
    assert sorted(r.date.day for r in got) == [11, 12, 13, 14, 15]
    got = planning.date_window(df, F.lit(D(2026, 9, 15)), start=F.lit(D(2026, 9, 1))).count()
    assert got == 15


def test_select_regions(spark):
    dim = spark.createDataFrame([("MA-01",), ("MA-02",), ("MA-03",)], "region_code string")
    df = spark.createDataFrame([("MA-01", 1), ("MA-02", 2), ("MA-03", 3)], "region_code string, v int")
    assert planning.parse_region_codes(" ma-01, MA-03 ,") == ["MA-01", "MA-03"]
    assert sorted(r.v for r in planning.select_regions(df, dim, " ma-01, MA-03 ,").collect()) == [1, 3]
    assert planning.select_regions(df, dim, None).count() == 3
    with pytest.raises(ValueError):
        planning.select_regions(df, dim, "MA-01,MA-99")
    with pytest.raises(ValueError):
        planning.select_regions(df, dim, " , ")


def test_missing_days_and_chunks(spark):
    days = [D(2017, 1, 1) + dt.timedelta(days=i) for i in range(1000)]
    observed = [("MA-11", d) for d in days if not (D(2017, 3, 1) <= d <= D(2017, 3, 10))] + [("MA-01", d) for d in days]
    obs = spark.createDataFrame(observed, "region_code string, date date")
    spans = spark.createDataFrame([("MA-11", D(2017, 1, 1), D(2019, 9, 27)), ("MA-01", D(2017, 1, 1), D(2019, 9, 27))],
                                  "region_code string, start_date date, end_date date")
    missing = planning.missing_days(obs, spans)
    assert missing.count() == 10
    ch = planning.split_chunks(spans)
    repair = planning.missing_chunks(missing, ch).collect()
    assert [(r.region_code, r.chunk_start, r.missing_days) for r in repair] == [("MA-11", D(2017, 1, 1), 10)]
    regions = planning.region_maps(planning.day_maps(obs))
    assert [(r.region_code, r.chunk_start, r.missing_days, r.first_missing, r.last_missing) for r in planning.repair_list(regions).collect()] == [
        ("MA-11", D(2017, 1, 1), 10, D(2017, 3, 1), D(2017, 3, 10))]


def test_run_summary(spark):
    loads = spark.createDataFrame([
        ("b1", "weather_daily", "open-meteo-archive", 3), ("b1", "agriculture_regional", "mock-fallback-network-error", 1),
        ("b2", "weather_daily", "open-meteo-archive", 4), ("b2", "weather_daily", "open-meteo-archive", 5), ("b2", "agriculture_regional", "datagovma", 2),
        ("b3", "agriculture_regional", "mock-not-configured", 7), ("b4", "weather_daily", "open-meteo-archive", 1),
    ], "batch_id string, table string, source string, rows long")
    failed = spark.createDataFrame([("b4", 1), ("b5", 2), ("b2", 0)], "batch_id string, failed_chunks long")
    assert sorted(map(tuple, runs.ingest_summary(loads, failed).collect())) == [
        ("b1", 3, 1, 0, "mock-fallback-network-error", 1),
        ("b2", 9, 2, 0, "datagovma", 0),
        ("b3", 0, 7, 0, "mock-not-configured", 0),
        ("b4", 1, 0, 1, "skipped", 1),
        ("b5", 0, 0, 2, "skipped", 1),
    ]


def test_manifest_url(spark):
    req = spark.createDataFrame([("MA-04", D(2023, 1, 1), D(2024, 12, 31))], "region_code string, start_date date, end_date date")
    dim = spark.createDataFrame([("MA-04", 34.0211, -6.8414)], "region_code string, latitude double, longitude double")
    url = planning.ingest_manifest(planning.split_chunks(req), dim).first().url
    assert url.startswith("https://archive-api.open-meteo.com/v1/archive?latitude=34.0211&longitude=-6.8414"
                          "&start_date=2023-01-01&end_date=2024-12-31&daily=temperature_2m_max%2C")
    assert url.endswith("&timezone=Africa%2FCasablanca")


def test_day_maps_equal_brute_force(spark):
    # repeated ingestions, leap years, first and last days of years, years without any day
    import random

    rng = random.Random(5)
    rows = []
    for code, start, n_days, per_day in (("MA-01", D(2019, 11, 1), 500, 30), ("MA-02", D(2020, 2, 28), 3, 1), ("MA-03", D(2015, 12, 30), 900, 2)):
        for i in range(n_days):
            day = start + dt.timedelta(days=i)
            if (0 < i < n_days - 1 and rng.random() < 0.1) or day.year == 2017:
                continue
            rows += [(code, day)] * per_day
    obs = spark.createDataFrame(rows, "region_code string, date date")
    seen = {}
    for code, day in rows:
        seen.setdefault(code, set()).add(day)
    maps = planning.day_maps(obs)
    got = {(r.region_code, r.year): r.days_observed for r in maps.collect()}
    assert got == {(c, y): len([d for d in ds if d.year == y]) for c, ds in seen.items() for y in {d.year for d in ds}}
    spans = {r.region_code: (r.start_date, r.end_date, r.days) for r in planning.region_maps(maps).collect()}
    assert spans == {c: (min(ds), max(ds), len(ds)) for c, ds in seen.items()}
    assert [tuple(r) for r in planning.completeness(maps).collect()] == sorted(((c, len(ds), min(ds), max(ds)) for c, ds in seen.items()), key=lambda r: (r[1], r[0]))

    def gaps(spans):
        return sorted((c, a + dt.timedelta(days=k)) for c, (a, z) in spans.items() for k in range((z - a).days + 1) if a + dt.timedelta(days=k) not in seen.get(c, ()))

    assert sorted(map(tuple, planning.missing_days(obs).collect())) == gaps({c: (min(ds), max(ds)) for c, ds in seen.items()})
    wide = {"MA-01": (D(2018, 12, 31), D(2021, 1, 1)), "MA-09": (D(2020, 2, 27), D(2020, 3, 1)), "MA-02": (D(2021, 1, 2), D(2021, 1, 1))}
    asked = spark.createDataFrame([(c, *v) for c, v in wide.items()], "region_code string, start_date date, end_date date")
    assert sorted(map(tuple, planning.missing_days(obs, asked).collect())) == gaps(wide)
    # the repair list from bits equals the roll-up of the listed days
    regions = planning.region_maps(maps)
    listed = planning.missing_chunks(planning.missing_days(obs), planning.split_chunks(planning.observed_span(obs)))
    assert sorted(map(tuple, planning.repair_list(regions).collect())) == sorted(map(tuple, listed.collect()))
    none = planning.day_maps(obs.limit(0))
    assert planning.completeness(none).count() == planning.repair_list(planning.region_maps(none)).count() == 0


def test_day_bits(spark):
    df = spark.createDataFrame([(a, b) for a in (0, 1, 60, 61, 121, 364, 365) for b in (0, 59, 60, 61, 122, 365)], "a int, b int")
    got = df.select("a", "b", daybits.count_days(daybits.days_between(F.col("a"), F.col("b"))).alias("n"),
                    daybits.first_day(daybits.days_between(F.col("a"), F.col("b"))).alias("first"),
                    daybits.last_day(daybits.days_between(F.col("a"), F.col("b"))).alias("last"),
                    daybits.list_days(daybits.days_between(F.col("a"), F.col("b"))).alias("days")).collect()
    for r in got:
        days = list(range(r.a, r.b + 1))
        assert (r.n, r.first, r.last, r.days) == (len(days), days[0] if days else None, days[-1] if days else None, days)
