"""Data-quality checks return violating rows; the suite counts them per test."""

from agroclim.operators import quality
from agroclim.operators.quality import TableChecks
from agroclim.sources.sinks import region_rows


def test_checks(spark):
    df = spark.createDataFrame(
        [("MA-01", 2020, 10.0, "sec"), ("MA-01", 2020, -1.0, "bad"), ("MA-02", 2021, None, None), (None, 2022, 101.0, "humide")],
        "region_code string, year int, v double, cls string")
    dim = spark.createDataFrame([("MA-01",), ("MA-02",)], "region_code string")
    assert [tuple(r) for r in quality.check_unique(df, ["region_code", "year"]).collect()] == [("MA-01", 2020, 2)]
    assert quality.check_not_null(df, ["region_code", "v"]).count() == 2
    assert quality.check_range(df, "v", 0, 100).count() == 2  # null passes
    assert quality.check_values(df, "cls", ("tres_sec", "sec", "normal", "humide")).count() == 1  # null passes
    orphan = spark.createDataFrame([("MA-09",), (None,), ("MA-01",)], "region_code string")
    assert [r.region_code for r in quality.check_relationship(orphan, "region_code", dim).collect()] == ["MA-09"]
    assert [r.region_code for r in quality.missing_from(dim, df.where("year = 2021")).collect()] == ["MA-01"]
    report = {(r.check, r.column): r.violations for r in quality.run_checks([
        TableChecks("t", df, unique=[("region_code", "year")], not_null=["region_code"], ranges=[("v", 0, 100)],
                    accepted=[("cls", ("sec", "humide"))], relationships=[("region_code", dim, "region_code")])
    ]).collect()}
    assert report == {("not_null", "region_code"): 1, ("accepted_range", "v"): 2, ("accepted_values", "cls"): 1,
                      ("unique", "region_code,year"): 1, ("relationships", "region_code"): 0}


def test_rules_observed_in_a_write_equal_the_counted_ones(spark, tmp_path):
    rows = [("MA-01", 2020, 10.0, "sec"), ("MA-01", 2020, -1.0, "bad"), ("MA-09", 2021, None, None), (None, 2022, 101.0, "humide")]
    df = spark.createDataFrame(rows, "region_code string, year int, v double, cls string")
    dim = spark.createDataFrame([("MA-01",), ("MA-02",)], "region_code string")

    def checks(frame):
        return TableChecks("t", frame, unique=[("region_code", "year")], not_null=["region_code", "v"], ranges=[("v", 0, 100)],
                           accepted=[("cls", ("sec", "humide"))], relationships=[("region_code", dim, "region_code")],
                           mirrors={"raw": {"region_code": "code", "year": "annee"}})

    declared = checks(df)
    watched, seen = quality.observe_rules(declared)
    watched.write.parquet(str(tmp_path / "t"))
    got = quality.observed_report(declared, seen)
    got += [tuple(r) for r in quality.run_checks([checks(spark.read.parquet(str(tmp_path / "t")))], row_rules=False).select("check", "table", "column", "violations").collect()]
    whole = [tuple(r) for r in quality.run_checks([declared]).select("check", "table", "column", "violations").collect()]
    assert sorted(got) == sorted(whole)
    assert set(whole) == {
        ("not_null", "t", "region_code", 1), ("not_null", "raw", "code", 1), ("not_null", "t", "v", 1), ("accepted_range", "t", "v", 2),
        ("accepted_values", "t", "cls", 1), ("unique", "t", "region_code,year", 1), ("unique", "raw", "code,annee", 1), ("relationships", "t", "region_code", 1)}


def test_raw_rules(spark):
    df = spark.createDataFrame([("MA-01", 2020), ("X-1", 2020), ("MA-02", 1800)], "region_code string, annee int")
    bad = {r.region_code: r.broken_rules for r in quality.check_raw_rules(df, "agriculture", r"^MA-[0-9]{2}$").collect()}
    assert bad == {"X-1": ["code_pattern"], "MA-02": ["year_range"]}


def test_region_dimension_integrity(spark):
    dim = region_rows(spark)
    assert quality.check_dim(dim, expected_rows=12).count() == 0
    broken = dim.unionByName(dim.limit(1))
    rules = {r.rule for r in quality.check_dim(broken, expected_rows=12).collect()}
    assert rules == {"duplicate_code", "row_count"}


def _days(spark, n):
    """Silver weather of one region: the first ``n`` days of 2019, all measured."""
    return spark.sql(f"""select 'R01' as region_code, date_add(date'2019-01-01', cast(id as int)) as observation_date,
        cast(20 as decimal(5,2)) as temp_max_c, cast(10 as decimal(5,2)) as temp_min_c, cast(15 as decimal(5,2)) as temp_mean_c,
        cast(1 as decimal(6,2)) as precipitation_mm, cast(2 as decimal(6,2)) as et0_mm, cast(18 as decimal(7,2)) as solar_radiation_mj_m2,
        cast(5 as decimal(10,3)) as solar_radiation_kwh_m2, cast(50 as decimal(5,2)) as humidity_mean_pct, cast(9 as decimal(5,2)) as wind_max_kmh,
        true as has_water_balance_data, true as has_solar_data from range({n})""")


def test_days_observed_reads_every_day(spark, monkeypatch):
    from agroclim.plans import catalog, panel

    root = "/root/testdata/sf0.001"
    agriculture = panel.silver_agriculture(spark, root).limit(0)
    monkeypatch.setattr(panel, "silver_agriculture", lambda spark, root: agriculture)
    for days, flagged in ((365, []), (349, [("R01", 2019, 349)]), (340, [])):
        monkeypatch.setattr(panel, "_PLANS", {})
        monkeypatch.setattr(panel, "silver_weather", lambda spark, root, days=days: _days(spark, days))
        got = catalog.QUERIES["dq_days_observed"](spark, root).collect()
        assert [(r.region_code, r.year, r.days_observed) for r in got] == flagged


def test_missing_regions_reads_every_year(spark, monkeypatch):
    from agroclim.plans import catalog, panel

    root = "/root/testdata/sf0.001"
    assert catalog.QUERIES["missing_regions"](spark, root).collect() == []
    whole = panel.dirty_agriculture_csv(spark, root)
    monkeypatch.setattr(panel, "dirty_agriculture_csv", lambda spark, root: whole.where("annee like '%1997%'"))
    seen = {r.region_code for r in catalog.QUERIES["missing_regions"](spark, root).collect()}
    assert len(seen) < panel.dim_region(spark, root).count()  # no row of 1996 is left
