"""Registered queries: name -> (spark, root) -> DataFrame with portable types.

Each query reads the driver tables under ``root`` (through the proxy panel) and runs
one operator of the library over the whole data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from agroclim.plans import panel
from agroclim.plans.normalize import portable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, root: str) -> DataFrame:
            return portable(fn(spark, root))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return wrap


@register("climate_kpi")
def q_climate_kpi(spark: SparkSession, root: str) -> DataFrame:
    """Flagship: drought KPIs per region x year."""
    return panel.climate_kpi(spark, root)


@register("solar_potential")
def q_solar_potential(spark: SparkSession, root: str) -> DataFrame:
    return panel.solar_potential(spark, root)


@register("region_year")
def q_region_year(spark: SparkSession, root: str) -> DataFrame:
    return panel.region_year(spark, root)


@register("dim_year")
def q_dim_year(spark: SparkSession, root: str) -> DataFrame:
    return panel.dim_year(spark, root)


# --- staging / silver -------------------------------------------------------------------

from pyspark.sql import functions as F  # noqa: E402

from agroclim.operators import cleaning, planning, quality, report, runs, silver  # noqa: E402
from agroclim.functions import daybits, display, labels, numbers  # noqa: E402
from agroclim.sources import proxy  # noqa: E402
from agroclim.schemas import AGRICULTURE_KEYS, WEATHER_KEYS  # noqa: E402

CODE_PATTERN = r"^R[0-9]{2}$"  # region codes of the proxy panel
PROXY_CODES = ("R00", "R01", "R02", "R03", "R04")


@register("latest_weather")
def q_latest_weather(spark, root):
    """E1 on weather: newest ingestion per (region_code, date)."""
    return panel.raw_weather(spark, root)


@register("latest_agriculture")
def q_latest_agriculture(spark, root):
    """E1 on agriculture: one row per (region_code, annee) of the cleaned CSV rows;
    rows resolving to the same key collapse to the greatest values (total order)."""
    clean = cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)
    return silver.latest_wins(clean, AGRICULTURE_KEYS, ["production_tonnes", "surface_irriguee_ha", "ressource_hydrique_m3"])


@register("stg_weather")
def q_stg_weather(spark, root):
    return panel.silver_weather(spark, root)


@register("stg_agriculture")
def q_stg_agriculture(spark, root):
    return panel.silver_agriculture(spark, root)


@register("dim_region")
def q_dim_region(spark, root):
    return panel.dim_region(spark, root)


@register("weather_by_year")
def q_weather_by_year(spark, root):
    from agroclim.operators import gold

    return gold.weather_by_year(panel.silver_weather(spark, root))


@register("spi_reference")
def q_spi_reference(spark, root):
    from agroclim.operators import gold

    base = gold.climate_base(panel.region_year(spark, root), panel.dim_region(spark, root))
    ref = gold.spi_reference(base)
    return ref.select(
        "region_code", "precip_ref_years",
        F.round(F.col("precip_ref_mean_mm"), 2).alias("precip_ref_mean_mm"),
        numbers.round_half_up(F.col("precip_ref_std_mm"), 4).alias("precip_ref_std_mm"),
    ).distinct()


@register("serving_climate")
def q_serving_climate(spark, root):
    from agroclim.plans.serving import select_serving

    return select_serving(panel.climate_kpi(spark, root), "fct_region_climate_kpi")


@register("serving_solar")
def q_serving_solar(spark, root):
    from agroclim.plans.serving import select_serving

    return select_serving(panel.solar_potential(spark, root), "fct_solar_potential")


@register("vw_region_year_kpi")
def q_vw(spark, root):
    from agroclim.plans.serving import region_year_view_of_marts

    return region_year_view_of_marts(panel.kpi_marts(spark, root), panel.dim_region(spark, root))


@register("vw_region_year_kpi_tables")
def q_vw_tables(spark, root):
    """The view as a join of the two fact tables (the form used on stored serving tables)."""
    from agroclim.plans.serving import region_year_view

    return region_year_view(
        panel.climate_kpi(spark, root), panel.solar_potential(spark, root), panel.dim_region(spark, root), panel.dim_year(spark, root)
    )


@register("coerce_raw")
def q_coerce_raw(spark, root):
    """B12: double measures (x 1.005, off the 2-dp grid) coerced to NUMERIC(p, 2)."""
    raw = panel.raw_weather(spark, root)
    measures = ["temperature_2m_mean", "precipitation_sum", "et0_fao_evapotranspiration", "shortwave_radiation_sum"]
    scaled = raw.select("region_code", "date", *[(F.col(m).cast("double") * 1.005).alias(m) for m in measures])
    return silver.coerce_raw_weather(scaled)


@register("with_audit")
def q_with_audit(spark, root):
    """B11: audit columns on proxy observations; the per-row source_url wins."""
    obs = proxy.weather_observations(spark, root).withColumnRenamed("_source_url", "source_url")
    known = ["region_code", "date", "precipitation_sum", "et0_fao_evapotranspiration", "shortwave_radiation_sum"]
    out = silver.with_audit(obs, known, batch_id="batch-audit", source="open-meteo-archive", source_url="ignored://param")
    return out.drop("_ingested_at")


@register("explode_daily")
def q_explode_daily(spark, root):
    """J1: pack each region-year of raw weather into a payload of parallel arrays
    (sorted by day), then unpack it; the result must equal the panel."""
    raw = panel.raw_weather(spark, root).withColumn("_year", F.year("date"))
    from agroclim.constants import DAILY_VARIABLES

    packed = raw.groupBy("region_code", "_year").agg(
        F.sort_array(F.collect_list(F.struct(F.col("date").cast("string").alias("time"),
                                             *[F.col(v).cast("double").alias(v) for v in DAILY_VARIABLES]))).alias("days")
    )
    payload = packed.select(
        "region_code",
        F.struct(
            F.col("days.time").alias("time"), *[F.col(f"days.{v}").alias(v) for v in DAILY_VARIABLES]
        ).alias("daily"),
    )
    return silver.explode_daily(payload)


# --- scalar functions over data-derived text --------------------------------------------


@register("normalize_label")
def q_normalize_label(spark, root):
    """I1 on one messy label per order."""
    return proxy.order_texts(spark, root).select(
        "o_orderkey", "label", labels.normalize_label(F.col("label")).alias("normalized"), labels.label_key(F.col("label")).alias("label_key"))


@register("resolve_region")
def q_resolve_region(spark, root):
    texts = proxy.order_texts(spark, root).select("o_orderkey", "label")
    return cleaning.resolve_region(texts, "label", panel.region_aliases(spark, root), CODE_PATTERN)


@register("parse_decimal")
def q_parse_decimal(spark, root):
    texts = proxy.order_texts(spark, root)
    return texts.select("o_orderkey", F.col("amount_text").alias("text"), numbers.parse_decimal(F.col("amount_text")).alias("value"))


@register("parse_year")
def q_parse_year(spark, root):
    texts = proxy.order_texts(spark, root)
    return texts.select("o_orderkey", F.col("year_text").alias("text"), numbers.parse_year(F.col("year_text")).alias("year"))


@register("clean_agriculture")
def q_clean_agriculture(spark, root):
    return cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)


@register("agriculture_rejects")
def q_agriculture_rejects(spark, root):
    return cleaning.agriculture_rejects(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)


@register("label_join")
def q_label_join(spark, root):
    return cleaning.join_by_label(proxy.dirty_agriculture(spark, root), panel.dim_region(spark, root))


@register("drought_class")
def q_drought_class(spark, root):
    """I8 on every region-year: class from the unrounded ratio (complete years)."""
    from agroclim.operators import gold

    base = gold.climate_base(panel.region_year(spark, root), panel.dim_region(spark, root))
    return base.select("region_code", "year", display.drought_class(F.col("precip_et0_ratio"), F.col("is_complete_year")).alias("drought_class"))


@register("drought_label")
def q_drought_label(spark, root):
    k = panel.climate_kpi(spark, root)
    return k.select("region_code", "year", "drought_class",
                    display.drought_label(F.col("drought_class")).alias("drought_label"),
                    display.drought_sort(F.col("drought_class")).alias("drought_class_sort"))


@register("drought_color")
def q_drought_color(spark, root):
    k = panel.climate_kpi(spark, root)
    return k.select("region_code", "year", display.drought_color(F.col("drought_class")).alias("color"))


@register("solar_color")
def q_solar_color(spark, root):
    s = panel.solar_potential(spark, root)
    return s.select("region_code", "year", display.solar_color(F.col("solar_potential_score").cast("double")).alias("color"))


@register("format_number")
def q_format_number(spark, root):
    k = panel.merged_kpis(spark, root)
    return k.select(
        "region_code", "year",
        display.format_number(F.col("precip_et0_ratio"), 2).alias("ratio_text"),
        display.format_number(F.col("solar_potential_score"), 1, " / 100").alias("score_text"),
        display.format_number(F.col("spi_simplified"), 2).alias("spi_text"),
        display.format_number(F.col("solar_radiation_avg_kwh_m2_day"), 2).alias("kwh_text"),
    )


# --- report layer -------------------------------------------------------------------------


@register("merge_kpis")
def q_merge_kpis(spark, root):
    return report.ordered(panel.merged_kpis(spark, root))


@register("merge_kpi_tables")
def q_merge_kpi_tables(spark, root):
    """The two-mart join of C5 (the form used on marts read back from storage)."""
    return report.ordered(report.merge_kpis(panel.climate_kpi(spark, root), panel.solar_potential(spark, root)))


@register("filter_kpis")
def q_filter_kpis(spark, root):
    return report.filter_kpis(panel.merged_kpis(spark, root), 1998, ["R01", "R03"])


@register("complete_by_year")
def q_complete_by_year(spark, root):
    """D5: status of every year from one before the first to one after the last
    (absent years are partial)."""
    return report.years_around(panel.merged_kpis(spark, root))


@register("latest_complete_year")
def q_latest_complete_year(spark, root):
    return report.latest_complete_year(panel.merged_kpis(spark, root))


@register("available_years")
def q_available_years(spark, root):
    return report.available_years(panel.merged_kpis(spark, root))


@register("available_regions")
def q_available_regions(spark, root):
    return report.available_regions(panel.merged_kpis(spark, root))


@register("summarize")
def q_summarize(spark, root):
    return report.summarize(report.filter_kpis(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES)))


@register("yoy_delta")
def q_yoy_delta(spark, root):
    return report.yoy_delta(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES))


@register("yoy_delta_partial")
def q_yoy_delta_partial(spark, root):
    return report.yoy_delta(panel.merged_kpis(spark, root), 2001, list(PROXY_CODES))


@register("top_solar")
def q_top_solar(spark, root):
    return report.rank_regions(report.filter_kpis(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES)),
                               "solar_potential_score", ascending=False, n=3)


@register("driest_regions")
def q_driest_regions(spark, root):
    return report.rank_regions(report.filter_kpis(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES)),
                               "precip_et0_ratio", ascending=True, n=3)


@register("time_series")
def q_time_series(spark, root):
    return report.time_series(panel.merged_kpis(spark, root), ["R00", "R02", "R04"])


@register("has_mock")
def q_has_mock(spark, root):
    return report.has_mock(report.filter_kpis(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES)))


@register("class_distribution")
def q_class_distribution(spark, root):
    return report.class_distribution(panel.merged_kpis(spark, root))


@register("region_means")
def q_region_means(spark, root):
    return report.region_means(panel.merged_kpis(spark, root))


@register("spi_by_year")
def q_spi_by_year(spark, root):
    return report.spi_by_year(panel.merged_kpis(spark, root))


@register("display_table")
def q_display_table(spark, root):
    return report.display_table(report.filter_kpis(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES)))


@register("map_drought")
def q_map_drought(spark, root):
    return report.map_rows(report.filter_kpis(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES)), "drought")


@register("map_solar")
def q_map_solar(spark, root):
    return report.map_rows(report.filter_kpis(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES)), "solar")


@register("kpi_cards")
def q_kpi_cards(spark, root):
    return report.kpi_cards(panel.merged_kpis(spark, root), 1998, list(PROXY_CODES))


def _recent_weather(spark, root, days):
    """Raw weather of the last days: the window is cut from the ingestions, by the newest day
    of a two-column aggregate, before the newest ingestion per key is taken."""
    ing = proxy.ingestions(spark, root)
    recent = planning.date_window(ing, ing.select(F.max("date")).scalar(), lookback=days)
    return proxy.with_measures(silver.latest_wins(recent, WEATHER_KEYS, proxy.INGEST_ORDER))


@register("preview_json")
def q_preview_json(spark, root):
    return report.json_rows(_recent_weather(spark, root, 7).select(
        "region_code", "date", "precipitation_sum", "et0_fao_evapotranspiration", "shortwave_radiation_sum"))


# --- quality --------------------------------------------------------------------------------


@register("dq_unique")
def q_dq_unique(spark, root):
    """K1 on the ingestion log: (region_code, date) cells ingested more than once."""
    obs = proxy.weather_observations(spark, root)
    return quality.check_unique(obs, WEATHER_KEYS)


@register("dq_not_null")
def q_dq_not_null(spark, root):
    stg = panel.silver_weather(spark, root)
    return quality.check_not_null(stg, ["precipitation_mm", "et0_mm", "solar_radiation_mj_m2"], keep=["region_code", "observation_date"])


@register("dq_relationships")
def q_dq_relationships(spark, root):
    clean = cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)
    return quality.check_relationship(clean, "region_code", panel.dim_region(spark, root)).select("region_code", "annee")


@register("dq_range")
def q_dq_range(spark, root):
    stg = panel.silver_weather(spark, root)
    return quality.check_range(stg, "temp_mean_c", -20, 55).select("region_code", "observation_date", "temp_mean_c")


@register("dq_accepted_values")
def q_dq_accepted_values(spark, root):
    clean = cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)
    bad_codes = quality.check_values(clean, "region_code", PROXY_CODES).select(
        F.lit("region_code").alias("column"), F.col("region_code").alias("value"))
    bad_class = quality.check_values(panel.climate_kpi(spark, root), "drought_class", ("tres_sec", "sec", "normal", "humide")).select(
        F.lit("drought_class").alias("column"), F.col("drought_class").alias("value"))
    return bad_codes.unionByName(bad_class)


@register("dq_checks")
def q_dq_checks(spark, root):
    """K6: the DDL checks of four tables on feeds with faults (codes, dates, years, classes
    and scores out of their domains), one row per faulty row with the broken rules."""
    spoiled = F.dayofmonth("date") == 29
    weather = panel.raw_weather(spark, root).select(
        F.when(F.dayofyear("date") == 60, F.concat(F.lit("X-"), "region_code")).otherwise(F.col("region_code")).alias("region_code"),
        F.when(spoiled, F.add_months("date", 12 * 110)).otherwise(F.col("date")).alias("date"))
    clean = cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)
    agriculture = clean.withColumn("annee", F.when(F.col("annee") % 4 == 0, F.col("annee") + 200).otherwise(F.col("annee")))
    marts = panel.kpi_marts(spark, root)
    climate = marts.select("region_code", "year", F.when(F.col("dry_days") % 2 == 1, F.lit("inconnu")).otherwise(F.col("drought_class")).alias("drought_class"))
    solar = marts.select("region_code", "year", (F.col("sunny_days_pct") * 1.5).alias("solar_potential_score"))
    parts = []
    for table, rows, period in (("weather", weather, "date"), ("agriculture", agriculture, "annee"), ("climate", climate, "year"), ("solar", solar, "year")):
        bad = quality.check_raw_rules(rows, table, CODE_PATTERN)
        parts.append(bad.select(F.lit(table).alias("table"), "region_code", F.col(period).cast("string").alias("period"), "broken_rules"))
    return reduce(DataFrame.unionByName, parts)


@register("dq_days_observed")
def q_dq_days_observed(spark, root):
    """L4: whole region-years of the panel that count as complete with fewer days than asked."""
    return quality.check_days_observed(panel.region_year(spark, root))


@register("dq_report")
def q_dq_report(spark, root):
    """K7: the 51 declared tests over the stored panel."""
    from agroclim.plans.checks import proxy_report

    return proxy_report(spark, root, PROXY_CODES)


@register("orphan_regions")
def q_orphan_regions(spark, root):
    clean = cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)
    return quality.orphans(clean, panel.dim_region(spark, root))


@register("missing_regions")
def q_missing_regions(spark, root):
    """G1/C7: regions of the dimension with no clean agriculture row in the load."""
    clean = cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)
    return quality.missing_from(panel.dim_region(spark, root), clean)


# --- planning -------------------------------------------------------------------------------


@register("date_window")
def q_date_window(spark, root):
    return _recent_weather(spark, root, 5).select("region_code", "date", "precipitation_sum", "shortwave_radiation_sum")


@register("select_regions")
def q_select_regions(spark, root):
    return planning.select_regions(panel.raw_weather(spark, root), panel.dim_region(spark, root), " r01, R03 ,").select(
        "region_code", "date", "precipitation_sum")


def _day_maps(spark, root):
    """Observed days straight from the ingestion log: two columns, one scan, no newest-per-key sort."""
    return planning.day_maps(proxy.ingestions(spark, root))


def _regions(spark, root):
    return planning.region_maps(_day_maps(spark, root))


def _chunks(spark, root):
    return planning.split_chunks(_regions(spark, root).select("region_code", "start_date", "end_date"))


@register("chunks")
def q_chunks(spark, root):
    return _chunks(spark, root)


@register("ingest_manifest")
def q_ingest_manifest(spark, root):
    return planning.ingest_manifest(_chunks(spark, root), panel.dim_region(spark, root))


@register("missing_days")
def q_missing_days(spark, root):
    return planning.missing_days(proxy.ingestions(spark, root))


@register("missing_chunks")
def q_missing_chunks(spark, root):
    gaps = ["missing_days", "first_missing", "last_missing"]
    listed = planning.ingest_manifest(planning.repair_list(_regions(spark, root)), panel.dim_region(spark, root), keep=gaps)
    return listed.select("region_code", "chunk_index", "chunk_start", "chunk_end", "url", *gaps)


@register("completeness")
def q_completeness(spark, root):
    return planning.completeness(_day_maps(spark, root))


@register("ingest_summary")
def q_ingest_summary(spark, root):
    """D13: one row per run. The panel loads one batch per year: its weather rows are the
    observed region-days, its failed chunks the region-years of the span with a gap."""
    by_year = planning.region_maps(_day_maps(spark, root))
    gaps = planning.missing_by_year(by_year).withColumn("gap", daybits.count_days(F.col("missing_bits")))
    days = F.coalesce(daybits.count_days(F.try_element_at("day_maps", F.col("year"))), F.lit(0))
    loads = by_year.withColumn("year", F.explode(F.map_keys("day_maps"))).select(
        F.concat(F.lit("batch-"), "year").alias("batch_id"), F.lit(runs.WEATHER).alias("table"), F.lit("open-meteo-archive").alias("source"), days.alias("rows"))
    agriculture = panel.raw_agriculture(spark, root).groupBy(F.concat(F.lit("batch-"), "annee").alias("batch_id"), F.col("_source").alias("source")).agg(
        F.count(F.lit(1)).alias("rows")).select("batch_id", F.lit(runs.AGRICULTURE).alias("table"), "source", "rows")
    failed = gaps.groupBy(F.concat(F.lit("batch-"), "year").alias("batch_id")).agg(F.count_if(F.col("gap") > 0).alias("failed_chunks"))
    return runs.ingest_summary(loads.unionByName(agriculture), failed)


# --- upserts (two loads of the same data) ---------------------------------------------------


@register("upsert_weather")
def q_upsert_weather(spark, root):
    """H1: the table holds the newest ingestion per key from order lines 1-3; a second
    load (lines 4-7, newest per key) is upserted: its rows replace every column of
    the stored ones, keys only in the table stay."""
    from agroclim.plans.upsert import upsert_rows

    ing = proxy.ingestions(spark, root)
    first = silver.latest_wins(ing.where(F.col("l_linenumber") <= 3), WEATHER_KEYS, proxy.INGEST_ORDER)
    second = silver.latest_wins(ing.where(F.col("l_linenumber") >= 4), WEATHER_KEYS, proxy.INGEST_ORDER)
    cols = ["region_code", "date", "precipitation_sum", "et0_fao_evapotranspiration", "shortwave_radiation_sum", "_source_url"]
    target = proxy.with_measures(first).select(*cols)
    batch = proxy.with_measures(second).select(*cols)
    return upsert_rows(target, batch, WEATHER_KEYS)


@register("upsert_agriculture")
def q_upsert_agriculture(spark, root):
    """H2: proxy agriculture rows, then the cleaned CSV rows upserted on
    (region_code, annee) under the 'datagovma' source."""
    from agroclim.plans.upsert import upsert_rows

    target = silver.coerce_raw_agriculture(panel.raw_agriculture(spark, root))
    clean = cleaning.clean_agriculture(panel.dirty_agriculture_csv(spark, root), panel.region_aliases(spark, root), CODE_PATTERN)
    batch = silver.coerce_raw_agriculture(clean).withColumn("_source", F.lit("datagovma"))
    return upsert_rows(target, batch, AGRICULTURE_KEYS)
