"""Gold writes, serving publish and the star view on the proxy panel."""

import pytest
from pyspark.sql import functions as F

from agroclim.plans import panel, serving
from conftest import SF_SMALL


def test_write_gold_counts(spark, tmp_path):
    counts = serving.write_gold(spark, panel.region_year(spark, SF_SMALL), panel.dim_region(spark, SF_SMALL), str(tmp_path / "gold"))
    assert counts == {"dim_region": 5, "dim_year": 7, "fct_region_climate_kpi": 35, "fct_solar_potential": 35}
    assert spark.read.parquet(str(tmp_path / "gold" / "fct_region_climate_kpi")).count() == 35


@pytest.fixture(scope="module")
def frames(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("gold"))
    serving.write_gold(spark, panel.region_year(spark, SF_SMALL), panel.dim_region(spark, SF_SMALL), root)
    return {name: spark.read.parquet(f"{root}/{name}") for name in serving.REQUIRED}


def test_publish_is_all_or_nothing(spark, tmp_path, frames):
    root = str(tmp_path / "serving")
    v1 = serving.publish(spark, frames, root)
    assert serving.current_version(spark, root) == v1
    assert serving.read_serving(spark, root, "fct_region_climate_kpi").columns[:2] == ["region_code", "year"]
    climate = frames["fct_region_climate_kpi"]
    refused = {
        "dim_year": dict(frames, dim_year=frames["dim_year"].limit(0)),                                            # empty
        "missing": {k: v for k, v in frames.items() if k != "fct_solar_potential"},                               # not all four
        "unknown": dict(frames, other=climate),
        "region_code,year unique": dict(frames, fct_region_climate_kpi=climate.unionByName(climate.limit(1))),     # key twice
        "drought_class accepted_values": dict(frames, fct_region_climate_kpi=climate.withColumn("drought_class", F.lit("wet"))),
        "year relationships": dict(frames, dim_year=frames["dim_year"].where("year <> 1995")),
        "region_code relationships": dict(frames, dim_region=frames["dim_region"].where("region_code <> 'R01'")),
        "dry_days not_null": dict(frames, fct_region_climate_kpi=climate.withColumn("dry_days", F.lit(None).cast("bigint"))),
        "solar_potential_score accepted_range": dict(frames, fct_solar_potential=frames["fct_solar_potential"].withColumn("solar_potential_score", F.lit(100.1))),
    }
    for message, tables in refused.items():
        with pytest.raises(ValueError, match=message):
            serving.publish(spark, tables, root)
        assert serving.current_version(spark, root) == v1  # readers still see the version before
    assert sorted(p.name for p in (tmp_path / "serving").iterdir()) == sorted(["_commits", v1])  # nothing refused is left
    v2 = serving.publish(spark, frames, root)
    assert v2 != v1 and serving.current_version(spark, root) == v2
    assert serving.commits(spark, root) == [(1, v1), (2, v2)]


def test_a_reader_between_the_steps_sees_the_old_version(spark, tmp_path, frames):
    root = str(tmp_path / "serving")
    assert serving.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        serving.read_serving(spark, root, "dim_year")
    v1 = serving.publish(spark, frames, root)
    fewer = {name: df.where("year < 1999") if "year" in df.columns else df for name, df in frames.items()}
    v2 = serving.stage(spark, fewer, root)
    assert serving.read_serving(spark, root, "dim_year").count() == 7
    serving.validate(spark, root, v2)
    assert serving.read_serving(spark, root, "dim_year").count() == 7  # a publisher that stops here has changed nothing
    # a commit file that is not complete yet does not count
    (tmp_path / "serving" / "_commits" / "000000000002").write_text("")
    assert serving.current_version(spark, root) == v1
    # ... and its number is taken, so the next publisher takes the one after it
    assert serving.commit(spark, root, v2) == 3
    assert serving.read_serving(spark, root, "dim_year").count() == 4
    assert serving.read_serving(spark, root, "dim_year", v1).count() == 7  # a reader that began before goes on


def test_of_two_publishers_each_gets_a_number(spark, tmp_path, frames):
    from agroclim.sources import files

    root = str(tmp_path / "serving")
    assert files.create_new(spark, f"{root}/_commits/000000000001", "{}")
    assert not files.create_new(spark, f"{root}/_commits/000000000001", "x")
    versions = [serving.stage(spark, frames, root) for _ in range(2)]
    assert [serving.commit(spark, root, v) for v in versions] == [2, 3]
    assert serving.current_version(spark, root) == versions[1]


def test_view_labels(spark):
    view = serving.region_year_view(panel.climate_kpi(spark, SF_SMALL), panel.solar_potential(spark, SF_SMALL),
                                    panel.dim_region(spark, SF_SMALL), panel.dim_year(spark, SF_SMALL))
    rows = view.collect()
    assert len(rows) == 35
    assert {(r.drought_class_label, r.drought_class_sort) for r in rows} == {("Année incomplète", 5)}
    assert all(r.year_label.endswith("(partielle)") for r in rows)
