"""Oracle SQL per registered query (DuckDB dialect, driver tables as views)."""

from __future__ import annotations

from oracle.base import AVG, D, with_ctes
from oracle.base import INGEST_ORDER as INGEST_ORDER_SQL

ORACLE: dict[str, str] = {}


def _climate_cols(prefix: str = "") -> str:
    p = prefix
    return f"""{p}region_code, {p}region_name, cast({p}year as bigint) as year, {p}is_complete_year,
        cast({p}water_balance_days as bigint) as water_balance_days,
        {D(p + 'water_balance_coverage')} as water_balance_coverage,
        {D(p + 'precipitation_total_mm')} as precipitation_total_mm, {D(p + 'et0_total_mm')} as et0_total_mm,
        {D(p + 'precip_et0_ratio')} as precip_et0_ratio, {p}drought_class, cast({p}dry_days as bigint) as dry_days,
        {D(p + 'dry_days_ratio')} as dry_days_ratio, {D(p + 'spi_simplified')} as spi_simplified,
        {p}has_agriculture_data, {D(p + 'production_tonnes')} as production_tonnes,
        {D(p + 'irrigated_area_ha')} as irrigated_area_ha, {D(p + 'water_resource_m3')} as water_resource_m3,
        {p}agriculture_source, {p}agriculture_is_mock"""


def _solar_cols(prefix: str = "") -> str:
    p = prefix
    return f"""{p}region_code, {p}region_name, {p}latitude, {p}longitude, {p}altitude_m, cast({p}year as bigint) as year,
        {p}is_complete_year, cast({p}solar_days as bigint) as solar_days, {D(p + 'solar_coverage')} as solar_coverage,
        {D(p + 'solar_radiation_avg_kwh_m2_day')} as solar_radiation_avg_kwh_m2_day,
        {D(p + 'solar_radiation_total_kwh_m2')} as solar_radiation_total_kwh_m2,
        cast({p}sunny_days as bigint) as sunny_days, {D(p + 'sunny_days_pct')} as sunny_days_pct,
        {D(p + 'radiation_score')} as radiation_score, {D(p + 'regularity_score')} as regularity_score,
        {D(p + 'solar_potential_score')} as solar_potential_score"""


def _region_year_cols() -> str:
    return f"""region_code, cast(year as bigint) as year, cast(days_observed as bigint) as days_observed,
        cast(water_balance_days as bigint) as water_balance_days,
        {D('precipitation_total_mm')} as precipitation_total_mm, {D('et0_total_mm')} as et0_total_mm,
        cast(dry_days as bigint) as dry_days, cast(solar_days as bigint) as solar_days,
        {D(AVG('solar_radiation_avg_kwh_m2_day', 7))} as solar_radiation_avg_kwh_m2_day,
        {D('solar_radiation_total_kwh_m2')} as solar_radiation_total_kwh_m2,
        cast(sunny_days as bigint) as sunny_days, {D(AVG('temp_mean_avg_c', 6))} as temp_mean_avg_c,
        {D(AVG('humidity_mean_avg_pct', 6))} as humidity_mean_avg_pct, cast(days_in_year as bigint) as days_in_year,
        {D('water_balance_coverage')} as water_balance_coverage, {D('solar_coverage')} as solar_coverage,
        has_agriculture_data, {D('production_tonnes')} as production_tonnes,
        {D('irrigated_area_ha')} as irrigated_area_ha, {D('water_resource_m3')} as water_resource_m3,
        agriculture_source, agriculture_is_mock"""


ORACLE["climate_kpi"] = with_ctes(["climate_kpi"], f"select {_climate_cols()} from climate_kpi")
ORACLE["solar_potential"] = with_ctes(["solar_potential"], f"select {_solar_cols()} from solar_potential")
ORACLE["region_year"] = with_ctes(["region_year"], f"select {_region_year_cols()} from region_year")
ORACLE["dim_year"] = with_ctes(
    ["dim_year"], "select cast(year as bigint) as year, is_complete_year, year_label from dim_year"
)


# --- silver / staging -------------------------------------------------------------------------

from oracle.base import (  # noqa: E402
    DROUGHT_LABEL, DROUGHT_RGBA, DROUGHT_SORT, MEAN, R, code_or_null, fmt, label_key, norm_label,
    parse_dec, parse_year, solar_rgba,
)

RAW_W_COLS = """region_code, date, cast(temperature_2m_max as double) as temperature_2m_max,
  cast(temperature_2m_min as double) as temperature_2m_min, cast(temperature_2m_mean as double) as temperature_2m_mean,
  cast(precipitation_sum as double) as precipitation_sum, cast(et0_fao_evapotranspiration as double) as et0_fao_evapotranspiration,
  cast(shortwave_radiation_sum as double) as shortwave_radiation_sum,
  cast(relative_humidity_2m_mean as double) as relative_humidity_2m_mean, cast(wind_speed_10m_max as double) as wind_speed_10m_max"""

ORACLE["latest_weather"] = with_ctes(["raw_weather"], f"select {RAW_W_COLS}, _source, _source_url, _batch_id from raw_weather")

ORACLE["stg_weather"] = with_ctes(["stg_weather"], """
select region_code, observation_date, cast(temp_max_c as double) as temp_max_c, cast(temp_min_c as double) as temp_min_c,
  cast(temp_mean_c as double) as temp_mean_c, cast(precipitation_mm as double) as precipitation_mm, cast(et0_mm as double) as et0_mm,
  cast(solar_radiation_mj_m2 as double) as solar_radiation_mj_m2, cast(solar_radiation_kwh_m2 as double) as solar_radiation_kwh_m2,
  cast(humidity_mean_pct as double) as humidity_mean_pct, cast(wind_max_kmh as double) as wind_max_kmh,
  has_water_balance_data, has_solar_data
from stg_weather""")

ORACLE["stg_agriculture"] = with_ctes(["stg_agriculture"], """
select region_code, cast(year as bigint) as year, cast(production_tonnes as double) as production_tonnes,
  cast(irrigated_area_ha as double) as irrigated_area_ha, cast(water_resource_m3 as double) as water_resource_m3,
  data_source, is_mock
from stg_agriculture""")

ORACLE["dim_region"] = with_ctes(["dim_region"], "select * from dim_region")

ORACLE["weather_by_year"] = with_ctes(["region_year"], f"""
select region_code, cast(year as bigint) as year, days_observed, water_balance_days,
  {D('precipitation_total_mm')} as precipitation_total_mm, {D('et0_total_mm')} as et0_total_mm, dry_days, solar_days,
  {D(AVG('solar_radiation_avg_kwh_m2_day', 7))} as solar_radiation_avg_kwh_m2_day,
  {D('solar_radiation_total_kwh_m2')} as solar_radiation_total_kwh_m2, sunny_days,
  {D(AVG('temp_mean_avg_c', 6))} as temp_mean_avg_c, {D(AVG('humidity_mean_avg_pct', 6))} as humidity_mean_avg_pct
from weather_by_year""")

ORACLE["spi_reference"] = with_ctes(["climate_kpi"], f"""
select distinct region_code, precip_ref_years,
  cast(round(cast(precip_ref_mean_mm as decimal(18,12)), 2) as double) as precip_ref_mean_mm,
  {D(R('precip_ref_std_mm', 4))} as precip_ref_std_mm
from climate_ref""")

SERVING_CLIMATE = f"""region_code, cast(year as bigint) as year, is_complete_year, cast(water_balance_days as bigint) as water_balance_days,
  {D('water_balance_coverage')} as water_balance_coverage, {D('precipitation_total_mm')} as precipitation_total_mm,
  {D('et0_total_mm')} as et0_total_mm, {D('precip_et0_ratio')} as precip_et0_ratio, drought_class,
  cast(dry_days as bigint) as dry_days, {D('dry_days_ratio')} as dry_days_ratio, {D('spi_simplified')} as spi_simplified,
  has_agriculture_data, {D('production_tonnes')} as production_tonnes, {D('irrigated_area_ha')} as irrigated_area_ha,
  {D('water_resource_m3')} as water_resource_m3, agriculture_source, agriculture_is_mock"""
ORACLE["serving_climate"] = with_ctes(["climate_kpi"], f"select {SERVING_CLIMATE} from climate_kpi")

ORACLE["serving_solar"] = with_ctes(["solar_potential"], f"""
select region_code, cast(year as bigint) as year, is_complete_year, cast(solar_days as bigint) as solar_days,
  {D('solar_coverage')} as solar_coverage, {D('solar_radiation_avg_kwh_m2_day')} as solar_radiation_avg_kwh_m2_day,
  {D('solar_radiation_total_kwh_m2')} as solar_radiation_total_kwh_m2, cast(sunny_days as bigint) as sunny_days,
  {D('sunny_days_pct')} as sunny_days_pct, {D('radiation_score')} as radiation_score,
  {D('regularity_score')} as regularity_score, {D('solar_potential_score')} as solar_potential_score
from solar_potential""")

ORACLE["vw_region_year_kpi"] = with_ctes(["climate_kpi", "solar_potential", "dim_region", "dim_year"], f"""
select r.region_code, r.region_name, r.capital, r.latitude, r.longitude, r.altitude_m, cast(k.year as bigint) as year, y.year_label,
  k.is_complete_year as climate_complete_year, s.is_complete_year as solar_complete_year,
  {D('k.precip_et0_ratio')} as precip_et0_ratio, k.drought_class,
  {DROUGHT_LABEL.format(c='k.drought_class')} as drought_class_label,
  cast({DROUGHT_SORT.format(c='k.drought_class')} as bigint) as drought_class_sort,
  {D('k.precipitation_total_mm')} as precipitation_total_mm, {D('k.et0_total_mm')} as et0_total_mm,
  cast(k.dry_days as bigint) as dry_days, {D('k.dry_days_ratio')} as dry_days_ratio, {D('k.spi_simplified')} as spi_simplified,
  {D('s.solar_radiation_avg_kwh_m2_day')} as solar_radiation_avg_kwh_m2_day, {D('s.sunny_days_pct')} as sunny_days_pct,
  {D('s.solar_potential_score')} as solar_potential_score,
  {D('k.production_tonnes')} as production_tonnes, {D('k.irrigated_area_ha')} as irrigated_area_ha,
  {D('k.water_resource_m3')} as water_resource_m3, k.agriculture_is_mock
from climate_kpi k join solar_potential s on s.region_code = k.region_code and s.year = k.year
join dim_region r on r.region_code = k.region_code join dim_year y on y.year = k.year""")

ORACLE["coerce_raw"] = with_ctes(["raw_weather"], """
select region_code, date,
  cast(cast(cast(cast(temperature_2m_mean as double) * 1.005 as varchar) as decimal(5,2)) as double) as temperature_2m_mean,
  cast(cast(cast(cast(precipitation_sum as double) * 1.005 as varchar) as decimal(6,2)) as double) as precipitation_sum,
  cast(cast(cast(cast(et0_fao_evapotranspiration as double) * 1.005 as varchar) as decimal(6,2)) as double) as et0_fao_evapotranspiration,
  cast(cast(cast(cast(shortwave_radiation_sum as double) * 1.005 as varchar) as decimal(7,2)) as double) as shortwave_radiation_sum
from raw_weather""")

ORACLE["with_audit"] = with_ctes(["proxy_weather_obs"], """
select region_code, date, cast(precipitation_sum as double) as precipitation_sum,
  cast(et0_fao_evapotranspiration as double) as et0_fao_evapotranspiration,
  cast(shortwave_radiation_sum as double) as shortwave_radiation_sum,
  'open-meteo-archive' as _source, _source_url, 'batch-audit' as _batch_id
from proxy_weather_obs""")

ORACLE["explode_daily"] = with_ctes(["raw_weather"], f"select {RAW_W_COLS} from raw_weather")

# --- scalar functions -----------------------------------------------------------------------------

# no-break spaces, which this engine's trim and \s do not know, are blanks
BLANKED = "replace({c}, chr(160), ' ')"

ORACLE["normalize_label"] = with_ctes(["order_texts"], f"""
select o_orderkey, label, {norm_label(BLANKED.format(c='label'))} as normalized, {label_key('label')} as label_key from order_texts""")

ORACLE["resolve_region"] = with_ctes(["order_texts", "aliases"], f"""
select o_orderkey, label, coalesce({code_or_null('label')}, al.region_code) as resolved_code
from order_texts left join aliases al on al.alias_key = {norm_label(BLANKED.format(c='label'))}""")

ORACLE["parse_decimal"] = with_ctes(["order_texts"], f"select o_orderkey, amount_text as text, {parse_dec('amount_text')} as value from order_texts")

ORACLE["parse_year"] = with_ctes(["order_texts"], f"""
select o_orderkey, year_text as text, cast({parse_year(BLANKED.format(c='year_text'))} as bigint) as year from order_texts""")

ORACLE["clean_agriculture"] = with_ctes(["clean_agri"], """
select region_code, cast(annee as bigint) as annee, production_tonnes, surface_irriguee_ha, ressource_hydrique_m3 from clean_agri""")

ORACLE["latest_agriculture"] = ORACLE["clean_agriculture"]

ORACLE["agriculture_rejects"] = with_ctes(["clean_agri"], """
select region as label, annee as year_text,
  case when code is null then 'unknown_region' else 'invalid_year' end as reject_reason
from resolved where code is null or yr is null""")

ORACLE["label_join"] = with_ctes(["dirty_agri", "dim_region"], f"""
select a.region, a.annee, a.production_tonnes, a.surface_irriguee_ha, a.ressource_hydrique_m3, a.source, d.region_code
from dirty_agri a join dim_region d on {label_key('a.region')} = {label_key('d.region_name')}""")

ORACLE["drought_class"] = with_ctes(["climate_kpi"], """
select region_code, cast(year as bigint) as year,
  case when not is_complete_year or precip_et0_ratio is null then null
       when precip_et0_ratio < 0.20 then 'tres_sec' when precip_et0_ratio < 0.50 then 'sec'
       when precip_et0_ratio < 0.65 then 'normal' else 'humide' end as drought_class
from climate_base""")

ORACLE["drought_label"] = with_ctes(["climate_kpi"], f"""
select region_code, cast(year as bigint) as year, drought_class, {DROUGHT_LABEL.format(c='drought_class')} as drought_label,
  cast({DROUGHT_SORT.format(c='drought_class')} as bigint) as drought_class_sort
from climate_kpi""")

ORACLE["drought_color"] = with_ctes(["climate_kpi"], f"""
select region_code, cast(year as bigint) as year, cast({DROUGHT_RGBA.format(c='drought_class')} as bigint[]) as color from climate_kpi""")

ORACLE["solar_color"] = with_ctes(["solar_potential"], f"""
select region_code, cast(year as bigint) as year, cast({solar_rgba('cast(solar_potential_score as double)')} as bigint[]) as color
from solar_potential""")

ORACLE["format_number"] = with_ctes(["merged"], f"""
select region_code, cast(year as bigint) as year, {fmt('precip_et0_ratio', 2)} as ratio_text,
  {fmt('solar_potential_score', 1, ' / 100')} as score_text, {fmt('spi_simplified', 2)} as spi_text,
  {fmt('solar_radiation_avg_kwh_m2_day', 2)} as kwh_text
from merged""")

# --- report layer -----------------------------------------------------------------------------------

MERGED_COLS = """region_code, region_name, cast(year as bigint) as year, climate_complete_year, precipitation_total_mm,
  et0_total_mm, precip_et0_ratio, drought_class, dry_days, dry_days_ratio, spi_simplified, has_agriculture_data,
  production_tonnes, irrigated_area_ha, water_resource_m3, agriculture_is_mock, latitude, longitude, altitude_m,
  solar_complete_year, solar_radiation_avg_kwh_m2_day, sunny_days_pct, radiation_score, solar_potential_score"""
ALL = "('R00','R01','R02','R03','R04')"

ORACLE["merge_kpis"] = with_ctes(["merged"], f"select {MERGED_COLS} from merged")
ORACLE["merge_kpi_tables"] = ORACLE["merge_kpis"]
ORACLE["filter_kpis"] = with_ctes(["merged"], f"select {MERGED_COLS} from merged where region_code in ('R01','R03') and year = 1998")

ORACLE["complete_by_year"] = with_ctes(["merged"], """
select cast(y.year as bigint) as year, not coalesce(s.ok, false) as is_partial,
  case when coalesce(s.ok, false) then cast(y.year as varchar) else cast(y.year as varchar) || ' (partielle)' end as year_label
from (select unnest(generate_series(min(year) - 1, max(year) + 1)) as year from merged) y
left join (select year, bool_and(climate_complete_year and solar_complete_year) as ok from merged group by year) s on s.year = y.year""")

ORACLE["latest_complete_year"] = with_ctes(["merged"], """
select cast(max(case when ok then year end) as bigint) as latest_complete_year,
  cast(coalesce(max(case when ok then year end), max(year)) as bigint) as default_year
from (select year, bool_and(climate_complete_year and solar_complete_year) as ok from merged group by year) s""")

ORACLE["available_years"] = with_ctes(["merged"], "select distinct cast(year as bigint) as year from merged")
ORACLE["available_regions"] = with_ctes(["merged"], "select distinct region_code, region_name from merged")

SUMMARY = {"spi": "spi_simplified", "ratio": "precip_et0_ratio", "solar_score": "solar_potential_score",
           "solar_kwh": "solar_radiation_avg_kwh_m2_day", "dry_days": "dry_days"}
ORACLE["summarize"] = with_ctes(["merged"], "select " + ", ".join(f"{MEAN(c)} as {k}" for k, c in SUMMARY.items())
                                + f" from merged where year = 1998 and region_code in {ALL}")


def _pair(year: int) -> str:
    partial = (f"(not coalesce((select bool_and(climate_complete_year and solar_complete_year) from merged "
               f"where year = {year}), false))")
    cur = ", ".join(f"{MEAN(f'case when year = {year} then {c} end')} as c_{k}" for k, c in SUMMARY.items())
    prev = ", ".join(f"{MEAN(f'case when year = {year - 1} and not {partial} then {c} end')} as p_{k}" for k, c in SUMMARY.items())
    return f"pair as (select {cur}, {prev} from merged where region_code in {ALL} and year in ({year}, {year - 1}))"


def _yoy(year: int) -> str:
    cols = [f"cast({year} as bigint) as year"]
    cols += [f"c_{k} as {k}_current" for k in SUMMARY]
    cols += [f"p_{k} as {k}_previous" for k in SUMMARY]
    cols += [f"{D(R(f'c_{k} - p_{k}', 6))} as {k}_delta" for k in SUMMARY]
    return with_ctes(["merged"], f"select {', '.join(cols)} from pair", extra=[_pair(year)])


ORACLE["yoy_delta"] = _yoy(1998)
ORACLE["yoy_delta_partial"] = _yoy(2001)

ORACLE["kpi_cards"] = with_ctes(["merged"], f"""
select {fmt('c_spi', 2)} as spi, case when c_spi - p_spi is not null then {fmt(D(R('c_spi - p_spi', 6)), 2)} end as spi_delta,
  {fmt('c_ratio', 2)} as ratio, case when c_ratio - p_ratio is not null then {fmt(D(R('c_ratio - p_ratio', 6)), 2)} end as ratio_delta,
  {fmt('c_solar_score', 1, ' / 100')} as solar_score,
  case when c_solar_score - p_solar_score is not null then {fmt(D(R('c_solar_score - p_solar_score', 6)), 1)} end as solar_score_delta,
  {fmt('c_dry_days', 0)} as dry_days,
  case when c_dry_days - p_dry_days is not null then {fmt(D(R('c_dry_days - p_dry_days', 6)), 0)} end as dry_days_delta
from pair""", extra=[_pair(1998)])

ORACLE["top_solar"] = with_ctes(["merged"], f"""
select region_name, solar_potential_score from merged
where year = 1998 and region_code in {ALL} and solar_potential_score is not null
order by solar_potential_score desc, region_name limit 3""")

ORACLE["driest_regions"] = with_ctes(["merged"], f"""
select region_name, precip_et0_ratio from merged
where year = 1998 and region_code in {ALL} and precip_et0_ratio is not null
order by precip_et0_ratio, region_name limit 3""")

_TS = {"SPI simplifié": "spi_simplified", "Ratio précipitations / ET0": "precip_et0_ratio",
       "Précipitations annuelles (mm)": "precipitation_total_mm", "Jours secs": "dry_days",
       "Score de potentiel solaire (0-100)": "solar_potential_score",
       "Rayonnement moyen (kWh/m²/jour)": "solar_radiation_avg_kwh_m2_day"}
ORACLE["time_series"] = with_ctes(["merged"], " union all ".join(
    f"select region_code, region_name, cast(year as bigint) as year, '{label}' as metric, cast({col} as double) as value "
    f"from merged where region_code in ('R00','R02','R04')" for label, col in _TS.items()))

ORACLE["has_mock"] = with_ctes(["merged"], f"""
select coalesce(bool_or(agriculture_is_mock), false) as has_mock from merged where year = 1998 and region_code in {ALL}""")

ORACLE["class_distribution"] = with_ctes(["merged"], f"""
select drought_class, region_years, {D(R('100.0 * region_years / sum(region_years) over ()', 1))} as share_pct
from (select drought_class, count(*) as region_years from merged where drought_class is not null group by drought_class) t""")

ORACLE["region_means"] = with_ctes(["merged"], f"""
select region_code, region_name, count(*) as complete_years,
  {MEAN('solar_radiation_avg_kwh_m2_day', 2)} as radiation_kwh_m2_day, {MEAN('solar_potential_score', 1)} as solar_score,
  {MEAN('precip_et0_ratio', 2)} as precip_et0_ratio, {MEAN('precipitation_total_mm', 0)} as precipitation_mm
from merged where climate_complete_year and solar_complete_year group by region_code, region_name""")

ORACLE["spi_by_year"] = with_ctes(["merged"], f"""
select cast(year as bigint) as year, count(*) as regions, {MEAN('spi_simplified', 2)} as spi_mean
from merged where spi_simplified is not null group by year""")

ORACLE["display_table"] = with_ctes(["merged"], f"""
select region_code as "Code région", region_name as "Région", cast(year as bigint) as "Année",
  {DROUGHT_LABEL.format(c='drought_class')} as "Classe de sécheresse", precip_et0_ratio as "Ratio P/ET0",
  spi_simplified as "SPI simplifié", precipitation_total_mm as "Précipitations (mm)", et0_total_mm as "ET0 (mm)",
  dry_days as "Jours secs", solar_radiation_avg_kwh_m2_day as "Rayonnement (kWh/m²/j)",
  sunny_days_pct as "Jours ensoleillés (%)", solar_potential_score as "Score solaire (0-100)",
  production_tonnes as "Production (t) [mock]", irrigated_area_ha as "Surface irriguée (ha) [mock]",
  water_resource_m3 as "Ressource hydrique (m³) [mock]"
from merged where year = 1998 and region_code in {ALL}""")

ORACLE["map_drought"] = with_ctes(["merged"], f"""
select region_code, region_name, latitude, longitude, cast({DROUGHT_RGBA.format(c='drought_class')} as bigint[]) as color,
  {DROUGHT_LABEL.format(c='drought_class')} || ' — P/ET0 ' || {fmt('precip_et0_ratio', 2)} as label
from merged where year = 1998 and region_code in {ALL}""")

ORACLE["map_solar"] = with_ctes(["merged"], f"""
select region_code, region_name, latitude, longitude, cast({solar_rgba('solar_potential_score')} as bigint[]) as color,
  'Score solaire ' || {fmt('solar_potential_score', 1)} || ' — ' || {fmt('solar_radiation_avg_kwh_m2_day', 2)} || ' kWh/m²/j' as label
from merged where year = 1998 and region_code in {ALL}""")


def _json_field(name: str, expr: str, quoted: bool) -> str:
    val = f"'\"' || {expr} || '\"'" if quoted else expr
    return f"case when {expr} is not null then '\"{name}\":' || {val} end"


ORACLE["preview_json"] = with_ctes(["raw_weather"], f"""
select region_code, date, cast(precipitation_sum as double) as precipitation_sum,
  cast(et0_fao_evapotranspiration as double) as et0_fao_evapotranspiration,
  cast(shortwave_radiation_sum as double) as shortwave_radiation_sum,
  '{{' || concat_ws(',', {_json_field('region_code', 'region_code', True)}, {_json_field('date', 'cast(date as varchar)', True)},
    {_json_field('precipitation_sum', 'cast(precipitation_sum as varchar)', False)},
    {_json_field('et0_fao_evapotranspiration', 'cast(et0_fao_evapotranspiration as varchar)', False)},
    {_json_field('shortwave_radiation_sum', 'cast(shortwave_radiation_sum as varchar)', False)}) || '}}' as json
from raw_weather where date between (select max(date) from raw_weather) - 6 and (select max(date) from raw_weather)""")

# --- quality ---------------------------------------------------------------------------------------------

ORACLE["dq_unique"] = with_ctes(["proxy_weather_obs"], """
select region_code, date, count(*) as occurrences from proxy_weather_obs group by region_code, date having count(*) > 1""")

ORACLE["dq_not_null"] = with_ctes(["stg_weather"], """
select region_code, observation_date,
  list_filter([case when precipitation_mm is null then 'precipitation_mm' end, case when et0_mm is null then 'et0_mm' end,
               case when solar_radiation_mj_m2 is null then 'solar_radiation_mj_m2' end], lambda x: x is not null) as null_columns
from stg_weather where precipitation_mm is null or et0_mm is null or solar_radiation_mj_m2 is null""")

ORACLE["dq_relationships"] = with_ctes(["clean_agri", "dim_region"], """
select region_code, cast(annee as bigint) as annee from clean_agri c
where region_code is not null and not exists (select 1 from dim_region d where d.region_code = c.region_code)""")

ORACLE["dq_range"] = with_ctes(["stg_weather"], """
select region_code, observation_date, cast(temp_mean_c as double) as temp_mean_c from stg_weather
where temp_mean_c is not null and (temp_mean_c < -20 or temp_mean_c > 55)""")

ORACLE["dq_accepted_values"] = with_ctes(["clean_agri", "climate_kpi"], """
select 'region_code' as "column", region_code as value from clean_agri
where region_code is not null and region_code not in ('R00','R01','R02','R03','R04')
union all
select 'drought_class', drought_class from climate_kpi
where drought_class is not null and drought_class not in ('tres_sec','sec','normal','humide')""")

ORACLE["dq_checks"] = with_ctes(["raw_weather", "clean_agri", "climate_kpi", "solar_potential"], """
select "table", region_code, period, broken_rules from (
  select 'weather' as "table", region_code, cast(date as varchar) as period,
    list_filter([case when not regexp_matches(region_code, '^R[0-9]{2}$') then 'code_pattern' end,
                 case when date < date '1900-01-01' or date > date '2100-01-01' then 'date_range' end], lambda x: x is not null) as broken_rules
  from (select case when dayofyear(date) = 60 then 'X-' || region_code else region_code end as region_code,
               cast(case when day(date) = 29 then date + interval 110 year else date end as date) as date from raw_weather) w
  union all
  select 'agriculture', region_code, cast(y as varchar),
    list_filter([case when not regexp_matches(region_code, '^R[0-9]{2}$') then 'code_pattern' end,
                 case when y < 1900 or y > 2100 then 'year_range' end], lambda x: x is not null)
  from (select region_code, case when annee % 4 = 0 then annee + 200 else annee end as y from clean_agri) a
  union all
  select 'climate', region_code, cast(year as varchar), ['class_domain'] from climate_kpi where dry_days % 2 = 1
  union all
  select 'solar', region_code, cast(year as varchar), ['score_range'] from solar_potential where sunny_days_pct * 1.5 > 100
) t where len(broken_rules) > 0""")

ORACLE["dq_days_observed"] = with_ctes(["region_year"], """
select region_code, cast(year as bigint) as year, days_observed, cast(water_balance_coverage as double) as water_balance_coverage,
  cast(solar_coverage as double) as solar_coverage
from region_year where water_balance_coverage >= 0.95 and solar_coverage >= 0.95 and days_observed < 350""")

ORACLE["orphan_regions"] = with_ctes(["clean_agri", "dim_region"], """
select region_code, count(*) as rows from clean_agri c
where region_code is not null and region_code not in (select region_code from dim_region) group by region_code""")

ORACLE["missing_regions"] = with_ctes(["clean_agri", "dim_region"], """
select region_code from dim_region except select region_code from clean_agri""")

# --- planning -----------------------------------------------------------------------------------------------

ORACLE["date_window"] = with_ctes(["raw_weather"], """
select region_code, date, cast(precipitation_sum as double) as precipitation_sum,
  cast(shortwave_radiation_sum as double) as shortwave_radiation_sum
from raw_weather where date between (select max(date) from raw_weather) - 4 and (select max(date) from raw_weather)""")

ORACLE["select_regions"] = with_ctes(["raw_weather"], """
select region_code, date, cast(precipitation_sum as double) as precipitation_sum from raw_weather where region_code in ('R01','R03')""")

ORACLE["chunks"] = with_ctes(["chunks"], """
select region_code, start_date, end_date, cast(chunk_index as bigint) as chunk_index, chunk_start, chunk_end from chunks""")

ORACLE["ingest_manifest"] = with_ctes(["manifest"], """
select region_code, cast(chunk_index as bigint) as chunk_index, chunk_start, chunk_end, latitude, longitude, daily, timezone, url
from manifest""")

ORACLE["missing_days"] = with_ctes(["missing"], "select region_code, date from missing")

ORACLE["missing_chunks"] = with_ctes(["missing", "manifest"], """
select m.region_code, cast(c.chunk_index as bigint) as chunk_index, c.chunk_start, c.chunk_end, c.url,
  count(*) as missing_days, min(m.date) as first_missing, max(m.date) as last_missing
from missing m join manifest c on c.region_code = m.region_code and m.date between c.chunk_start and c.chunk_end
group by all""")

ORACLE["completeness"] = with_ctes(["raw_weather"], """
select region_code, count(*) as days, min(date) as first_date, max(date) as last_date from raw_weather group by region_code""")

ORACLE["ingest_summary"] = with_ctes(["missing", "raw_agriculture"], """
select 'batch-' || coalesce(w.y, a.y, f.y) as batch_id, coalesce(w.n, 0) as weather_rows, coalesce(a.n, 0) as agriculture_rows,
  coalesce(f.n, 0) as failed_chunks, coalesce(a.source, 'skipped') as agriculture_source,
  cast(case when coalesce(f.n, 0) > 0 or a.source = 'mock-fallback-network-error' then 1 else 0 end as bigint) as status
from (select year(date) as y, count(*) as n from raw_weather group by 1) w
full join (select annee as y, count(*) as n, max(_source) as source from raw_agriculture group by 1) a on a.y = w.y
full join (select year(date) as y, count(distinct region_code) as n from missing group by 1) f on f.y = coalesce(w.y, a.y)""")

# --- the 51 declarative tests as SQL counts ----------------------------------------------------------

_SUITE = [
    # (report table name, cte, unique keys, not-null cols, ranges, accepted, relationship)
    ("raw_weather_daily", "raw_weather", ["region_code", "date"], ["region_code", "date"], [], [], False),
    ("raw_agriculture_regional", "raw_agriculture", ["region_code", "annee"], ["region_code", "annee"], [], [], False),
    ("stg_weather_daily", "stg_weather", ["region_code", "observation_date"], ["region_code", "observation_date"],
     [("precipitation_mm", 0, None), ("et0_mm", 0, None), ("solar_radiation_mj_m2", 0, None),
      ("humidity_mean_pct", 0, 100), ("temp_mean_c", -20, 55)], [], True),
    ("stg_agriculture_regional", "stg_agriculture", ["region_code", "year"], ["region_code", "year", "is_mock"],
     [("production_tonnes", 0, None), ("irrigated_area_ha", 0, None), ("water_resource_m3", 0, None)], [], True),
    ("int_weather_agriculture_join", "region_year", ["region_code", "year"], ["region_code", "year"],
     [("water_balance_coverage", 0, 1), ("solar_coverage", 0, 1)], [], True),
    ("fct_region_climate_kpi", "climate_kpi", ["region_code", "year"], ["region_code", "region_name", "year"],
     [("precip_et0_ratio", 0, None), ("dry_days_ratio", 0, 1)],
     [("drought_class", "('tres_sec','sec','normal','humide')")], True),
    ("fct_solar_potential", "solar_potential", ["region_code", "year"], ["region_code", "year"],
     [("solar_radiation_avg_kwh_m2_day", 0, 12), ("solar_potential_score", 0, 100)], [], True),
    ("dim_region", "dim_region", ["region_code"],
     ["region_code", "region_name", "capital", "latitude", "longitude", "altitude_m"], [],
     [("region_code", "('R00','R01','R02','R03','R04')")], False),
]


def _suite_sql() -> str:
    parts = []
    for name, cte, keys, nn, ranges, accepted, rel in _SUITE:
        head = lambda check, col: f"select '{check}' as \"check\", '{name}' as \"table\", '{col}' as \"column\""
        for c in nn:
            parts.append(f"{head('not_null', c)}, count(*) filter (where {c} is null) as violations from {cte}")
        for c, lo, hi in ranges:
            cond = " or ".join(x for x in ([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else []))
            parts.append(f"{head('accepted_range', c)}, count(*) filter (where {c} is not null and ({cond})) as violations from {cte}")
        for c, vals in accepted:
            parts.append(f"{head('accepted_values', c)}, count(*) filter (where {c} is not null and {c} not in {vals}) as violations from {cte}")
        k = ", ".join(keys)
        parts.append(f"{head('unique', ','.join(keys))}, (select count(*) from (select {k} from {cte} group by {k} having count(*) > 1)) as violations")
        if rel:
            parts.append(f"{head('relationships', 'region_code')}, count(*) filter (where region_code is not null and "
                         f"region_code not in (select region_code from dim_region)) as violations from {cte}")
    body = "\nunion all\n".join(parts)
    return with_ctes(["raw_weather", "raw_agriculture", "stg_weather", "stg_agriculture", "region_year", "climate_kpi",
                      "solar_potential", "dim_region"], f"select \"check\", \"table\", \"column\", cast(violations as bigint) as violations from ({body}) t")


ORACLE["dq_report"] = _suite_sql()


# --- upserts ------------------------------------------------------------------------------------

_UW = """
loads as (
  select *, row_number() over (partition by region_code, date, l_linenumber <= 3 order by {order}) as rn
  from proxy_weather_obs
),
first_load as (select * from loads where l_linenumber <= 3 and rn = 1),
second_load as (select * from loads where l_linenumber >= 4 and rn = 1)"""

ORACLE["upsert_weather"] = with_ctes(["proxy_weather_obs"], """
select region_code, date, cast(precipitation_sum as double) as precipitation_sum,
  cast(et0_fao_evapotranspiration as double) as et0_fao_evapotranspiration,
  cast(shortwave_radiation_sum as double) as shortwave_radiation_sum, _source_url
from first_load f where not exists (select 1 from second_load s where s.region_code = f.region_code and s.date = f.date)
union all
select region_code, date, cast(precipitation_sum as double), cast(et0_fao_evapotranspiration as double),
  cast(shortwave_radiation_sum as double), _source_url
from second_load""", extra=[_UW.format(order=INGEST_ORDER_SQL)])

ORACLE["upsert_agriculture"] = with_ctes(["raw_agriculture", "clean_agri"], """
select region_code, cast(annee as bigint) as annee, cast(production_tonnes as double) as production_tonnes,
  cast(surface_irriguee_ha as double) as surface_irriguee_ha, cast(ressource_hydrique_m3 as double) as ressource_hydrique_m3,
  _source
from raw_agriculture r where not exists (select 1 from clean_agri c where c.region_code = r.region_code and c.annee = r.annee)
union all
select region_code, cast(annee as bigint), cast(cast(production_tonnes as decimal(12,2)) as double),
  cast(cast(surface_irriguee_ha as decimal(12,2)) as double), cast(cast(ressource_hydrique_m3 as decimal(14,2)) as double),
  'datagovma'
from clean_agri""")

ORACLE["vw_region_year_kpi_tables"] = ORACLE["vw_region_year_kpi"]
