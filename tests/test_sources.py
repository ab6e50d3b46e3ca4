"""Bronze sources and sinks on files written by the test."""

import json

import pytest
from pyspark.sql import functions as F

from agroclim.constants import DAILY_VARIABLES, SOURCE_AGRI_FALLBACK, SOURCE_AGRI_MOCK, SOURCE_AGRI_REAL
from agroclim.operators import silver
from agroclim.sources import bronze, sinks

HEADER = "region,annee,production_tonnes,surface_irriguee_ha,ressource_hydrique_m3"


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_tabular_csv_separator_and_encoding(spark, tmp_path):
    a = write(tmp_path / "a.csv", f"{HEADER}\nFès-Meknès,2020,\"1 234,5\",10,20\nRabat,2021,N/A,11,21\n")
    b = write(tmp_path / "b.csv", HEADER.replace(",", ";") + "\nFès-Meknès;2019;1234,5;10;20\nOriental;2018;;1;2\n")
    c = write(tmp_path / "c.csv", "Région\tCampagne\tProduction\tSuperficie\tEau_m3\nFès-Meknès\t2017/2018\t5\t6\t7\n", "latin-1")
    sniff = {r.path.rsplit("/", 1)[1]: (r.sep, r.encoding) for r in bronze.sniff_csv_files(spark, [a, b, c]).collect()}
    assert sniff == {"a.csv": (",", "UTF-8"), "b.csv": (";", "UTF-8"), "c.csv": ("\t", "ISO-8859-1")}
    df = bronze.read_tabular_csv(spark, [a, b, c])
    assert set(df.columns) == {"region_code", "annee", "production_tonnes", "surface_irriguee_ha", "ressource_hydrique_m3"}
    rows = {(r.region_code, r.annee): r for r in df.collect()}
    assert len(rows) == 5
    assert rows[("Rabat", "2021")].production_tonnes is None        # N/A read as missing
    assert rows[("Oriental", "2018")].production_tonnes is None     # blank read as missing
    assert rows[("Fès-Meknès", "2017/2018")].production_tonnes == "5"  # latin-1 file decoded


def test_load_agriculture_precedence(spark, tmp_path):
    fixture = write(tmp_path / "fixture.csv", f"{HEADER}\nFès-Meknès,2015,1,2,3\n")
    real = write(tmp_path / "real.csv", f"{HEADER}\nRabat,2016,4,5,6\n")
    bad = write(tmp_path / "bad.csv", "region,annee,production_tonnes\nRabat,2016,4\n")
    df, src = bronze.load_agriculture(spark, fixture, None)
    assert src == SOURCE_AGRI_MOCK and df.count() == 1
    df, src = bronze.load_agriculture(spark, fixture, str(tmp_path / "missing.csv"))
    assert src == SOURCE_AGRI_FALLBACK and df.first().region_code == "Fès-Meknès"
    df, src = bronze.load_agriculture(spark, fixture, real)
    assert src == SOURCE_AGRI_REAL and df.first().region_code == "Rabat"
    with pytest.raises(ValueError, match="surface_irriguee_ha"):
        bronze.load_agriculture(spark, fixture, bad)


def test_globs_and_unreadable_files(spark, tmp_path):
    fixture = write(tmp_path / "fixture.csv", f"{HEADER}\nFès-Meknès,2015,1,2,3\n")
    write(tmp_path / "drops" / "a.csv", f"{HEADER}\nRabat,2016,4,5,6\n")
    write(tmp_path / "drops" / "b.csv", HEADER.replace(",", "|") + "\nOriental|2017|4|5|6\n")
    df, src = bronze.load_agriculture(spark, fixture, str(tmp_path / "drops" / "*.csv"))
    assert src == SOURCE_AGRI_REAL and {r.region_code for r in df.collect()} == {"Rabat", "Oriental"}
    df, src = bronze.load_agriculture(spark, fixture, str(tmp_path / "nothing" / "*.csv"))
    assert src == SOURCE_AGRI_FALLBACK and df.count() == 1
    # a file that is listed and cannot be read: compressed by name, not in fact
    write(tmp_path / "broken.csv.gz", "no gzip")
    df, src = bronze.load_agriculture(spark, fixture, str(tmp_path / "broken.csv.gz"))
    assert src == SOURCE_AGRI_FALLBACK and df.count() == 1
    write(tmp_path / "empty.csv", "")
    assert bronze.load_agriculture(spark, fixture, str(tmp_path / "empty.csv"))[1] == SOURCE_AGRI_FALLBACK


def test_layouts_are_told_from_split_files(spark, tmp_path):
    body = "".join(f"Fès-Meknès;{2000 + k % 20};{k},5;1;2\n" for k in range(20_000))
    path = write(tmp_path / "big.csv", HEADER.replace(",", ";") + "\n" + body)
    late = write(tmp_path / "late.csv", HEADER + "\n" + "Rabat,2010,1,2,3\n" * 20_000 + "Fès-Meknès,2010,1,2,3\n", "latin-1")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = {r.path.rsplit("/", 1)[1]: (r.sep, r.encoding, r.header) for r in bronze.sniff_csv_files(spark, [path, late]).collect()}
        rows = bronze.read_tabular_csv(spark, [path, late]).groupBy("region_code").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {"big.csv": (";", "UTF-8", HEADER.replace(",", ";")), "late.csv": (",", "ISO-8859-1", HEADER)}  # the odd byte is in the last block
    assert {r.region_code: r["count"] for r in rows} == {"Fès-Meknès": 20_001, "Rabat": 20_000}


def test_a_changed_input_is_read_again(spark, tmp_path):
    from agroclim.sources import tables

    spark.range(3).write.parquet(str(tmp_path / "region.parquet"))
    assert tables.read_table(spark, str(tmp_path), "region").count() == 3
    spark.range(4).write.mode("append").parquet(str(tmp_path / "region.parquet"))
    assert tables.read_table(spark, str(tmp_path), "region").count() == 7


def payload(times, **overrides):
    daily = {"time": times}
    for name in DAILY_VARIABLES:
        daily[name] = overrides.get(name, [1.5] * len(times))
    return {"latitude": 99.0, "longitude": 99.0, "elevation": 1.0, "timezone": "x", "daily": daily}


def test_bronze_weather_json_roundtrip(spark, tmp_path):
    root = tmp_path / "bronze"
    p = payload(["2024-01-01", "2024-01-02"], precipitation_sum=[None, 68], et0_fao_evapotranspiration=[1, 2])
    write(root / "ingest_date=2024-01-03" / "region_code=MA-04" / "range_start=2024-01-01" / "data.json", json.dumps(p, indent=2))
    raw = bronze.read_bronze_weather(spark, str(root))
    assert {"ingest_date", "region_code", "range_start"} <= set(raw.columns)
    days = silver.explode_daily(raw).orderBy("date").collect()
    assert [d.date.isoformat() for d in days] == ["2024-01-01", "2024-01-02"]
    assert days[0].precipitation_sum is None and days[1].precipitation_sum == 68.0
    assert days[0].region_code == "MA-04"  # from the path, not the payload coordinates


def test_explode_rejects_ragged_arrays(spark, tmp_path):
    root = tmp_path / "bronze"
    p = payload(["2024-01-01", "2024-01-02"], precipitation_sum=[1.0])
    write(root / "ingest_date=2024-01-03" / "region_code=MA-04" / "range_start=2024-01-01" / "data.json", json.dumps(p))
    with pytest.raises(Exception, match="differ in length"):
        silver.explode_daily(bronze.read_bronze_weather(spark, str(root))).collect()


def test_land_bronze(spark, tmp_path):
    rows = spark.createDataFrame([("Fès", "2020", "1", "2", "3")], "region string, annee string, production_tonnes string, "
                                 "surface_irriguee_ha string, ressource_hydrique_m3 string")
    sinks.land_bronze_agriculture(rows, str(tmp_path / "agri"), "2026-10-01", "datagovma")
    files = list((tmp_path / "agri" / "ingest_date=2026-10-01" / "source=datagovma").glob("*.csv"))
    assert files and files[0].read_text().splitlines()[1] == '"Fès","2020","1","2","3"'
    back = bronze.read_bronze_agriculture(spark, str(tmp_path / "agri")).first()
    assert (back.region, back.source, back.ingest_date) == ("Fès", "datagovma", "2026-10-01")
    pay = spark.createDataFrame([("MA-01", "2024-01-01", json.dumps(payload(["2024-01-01"])))], "region_code string, range_start string, j string")
    pay = pay.select("region_code", "range_start", F.from_json("j", bronze.BRONZE_WEATHER).alias("p")).select("region_code", "range_start", "p.*")
    sinks.land_bronze_weather(pay, str(tmp_path / "weather"), "2024-01-02")
    assert bronze.read_bronze_weather(spark, str(tmp_path / "weather")).count() == 1


def test_dim_region_seed_roundtrip(spark, tmp_path):
    sinks.export_dim_region(spark, str(tmp_path / "dim"))
    dim = bronze.load_dim_region(spark, str(tmp_path / "dim"))
    rows = {r.region_code: r for r in dim.collect()}
    assert len(rows) == 12 and rows["MA-08"].altitude_m == 1009.0 and rows["MA-05"].region_name == "Béni Mellal-Khénifra"


def test_staging_guard_and_projection(spark):
    empty = spark.createDataFrame([], "region_code string, year int, is_complete_year boolean, year_label string")
    with pytest.raises(ValueError, match="empty"):
        sinks.staging_frame(empty, "dim_year")
    one = spark.createDataFrame([("x", 2020, True, "2020")], "region_code string, year int, is_complete_year boolean, year_label string")
    assert sinks.staging_frame(one, "dim_year").columns == ["year", "is_complete_year", "year_label"]


def test_bom_header_is_recognised(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_bytes(("\ufeff" + HEADER + "\nRabat,2020,1,2,3\n").encode("utf-8"))
    df = bronze.read_tabular_csv(spark, str(path))
    assert df.columns[0] == "region_code" and df.first().region_code == "Rabat"


def test_quoted_fields_keep_quotes_and_line_breaks(spark, tmp_path):
    drop = write(tmp_path / "q.csv", f'{HEADER}\n"Oriental ""est"", nord",2020,1,2,3\n"two\nlines",2021,4,5,6\n')
    back = bronze.read_tabular_csv(spark, drop).collect()
    assert sorted(r[0] for r in back) == ['Oriental "est", nord', "two\nlines"]
    fields = [f.name for f in bronze.BRONZE_AGRICULTURE if f.name not in ("ingest_date", "source")]
    rows = spark.createDataFrame([tuple('a "b", c\nd' for _ in fields)], ", ".join(f"{x} string" for x in fields))
    sinks.land_bronze_agriculture(rows, str(tmp_path / "agri"), "2026-10-01", "datagovma")
    landed = bronze.read_bronze_agriculture(spark, str(tmp_path / "agri")).select(*fields).collect()
    assert [tuple(r) for r in landed] == [tuple('a "b", c\nd' for _ in fields)]
