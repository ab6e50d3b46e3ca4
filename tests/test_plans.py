"""Scale guards on the physical plans of every registered query."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from agroclim.operators import silver
from agroclim.sources import proxy
from conftest import SF_SMALL


def plan_of(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(q(spark, SF_SMALL)) for name, q in entry.queries().items()}


def test_no_cartesian_or_nested_loop(plans):
    bad = {n for n, p in plans.items() if "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p}
    assert not bad


def test_fact_tables_are_never_broadcast(plans):
    # a BroadcastExchange directly fed by a scan of lineitem or orders would ship a fact table
    for name, p in plans.items():
        nodes = dict(re.findall(r"^\((\d+)\) (.+?)\s*$", p, re.M))
        for num, _ in [(k, v) for k, v in nodes.items() if v.startswith("BroadcastExchange")]:
            block = p.split(f"({num}) BroadcastExchange", 1)[1].split("\n\n", 1)[0]
            assert "lineitem" not in block and "orders" not in block, name
        assert "BuildLeft" not in p, name


def test_scans_are_pruned(plans):
    seen = 0
    for name, p in plans.items():
        for schema in re.findall(r"lineitem\.parquet\]\n(?:.*\n)*?ReadSchema: (struct<[^\n]*>)", p):
            seen += 1
            # no registered query uses these two columns: they must never be read
            assert "l_returnflag" not in schema and "l_linestatus" not in schema, name
    assert seen > 50


def test_dashboard_reads_the_facts_once(plans):
    # both gold marts come from one pass: the dashboard frame, the region x year view
    # (dim_year's flag rides along as a window) and everything built on them read lineitem once
    def lineitem_scans(name):
        return len(re.findall(r"^\(\d+\) Scan parquet .*\n(?:.*\n)*?Location: [^\n]*lineitem\.parquet", plans[name], re.M))

    for name in ("merge_kpis", "vw_region_year_kpi", "format_number", "kpi_cards", "map_solar", "time_series", "yoy_delta"):
        assert lineitem_scans(name) == 1, name
    assert lineitem_scans("merge_kpi_tables") == 2  # two marts read back as tables


def test_latest_wins_reduces_before_the_shuffle(spark):
    p = plan_of(silver.latest_wins(proxy.ingestions(spark, SF_SMALL), ["region_code", "date"], proxy.INGEST_ORDER))
    tree = p.split("\n\n", 1)[0]
    # WindowGroupLimit appears on both sides of the Exchange: partial (map side) and final
    assert tree.count("WindowGroupLimit") == 2
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_gap_queries_read_two_columns_once(plans):
    # spans, chunks, gaps and completeness come from one scan's day bits: the key of the region
    # and the day, hash aggregates only, no calendar join
    for name in ("chunks", "ingest_manifest", "missing_days", "missing_chunks", "completeness"):
        scans = re.findall(r"lineitem\.parquet\]\n(?:.*\n)*?ReadSchema: (struct<[^\n]*>)", plans[name])
        assert len(scans) == 1 and sorted(re.findall(r"(l_\w+):", scans[0])) == ["l_shipdate", "l_suppkey"], name
        assert "SortAggregate" not in plans[name] and "WindowGroupLimit" not in plans[name], name
        assert "LeftAnti" not in plans[name], name
    scans = re.findall(r"lineitem\.parquet\]\n(?:.*\n)*?ReadSchema: (struct<[^\n]*>)", plans["ingest_summary"])
    assert 1 <= len(scans) <= 2 and all(sorted(re.findall(r"(l_\w+):", s)) == ["l_shipdate", "l_suppkey"] for s in scans)


def test_the_stored_suite_reads_no_facts_again(plans):
    assert "lineitem.parquet" not in plans["dq_report"]  # the facts were read once, into the stored tables


def test_silver_months_are_split_by_adaptive_execution(spark, tmp_path):
    from pyspark.sql import functions as F

    from agroclim.sources import sinks

    days = spark.range(0, 400_000).select(
        F.concat(F.lit("MA-"), (F.col("id") % 100).cast("string")).alias("region_code"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 31).cast("int")).alias("observation_date"), F.rand(1).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.write_silver_weather(days, str(tmp_path / "t"), full=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    found = list((tmp_path / "t").rglob("*.parquet"))
    assert {f.parent.name for f in found} == {"month=1"} and len(found) > 1  # one hot month, several tasks
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000
