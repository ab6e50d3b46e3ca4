"""Business constants. These are FIXED VALUES: they must equal the source
system's rules for the results to match, so they are stated here once, plainly."""

from __future__ import annotations

# --- Fixed values: units and thresholds -------------------------------------------------
MJ_PER_KWH = 3.6                      # kWh/m2 = MJ/m2 / 3.6
DRY_DAY_MM = 1.0                      # dry day: precipitation < 1.0 mm
SUNNY_DAY_KWH = 5.0                   # sunny day: radiation >= 5.0 kWh/m2/day
COMPLETE_YEAR_COVERAGE = 0.95         # complete year: coverage (rounded to 3 dp) >= 0.95
ARIDITY_THRESHOLDS = (0.20, 0.50, 0.65)   # very dry | dry | normal | humid, lower bound inclusive
DROUGHT_CLASSES = ("tres_sec", "sec", "normal", "humide")
MIN_SPI_REFERENCE_YEARS = 5           # SPI needs >= 5 complete years and std > 0
RADIATION_SCORE_BOUNDS = (3.0, 7.0)   # kWh/m2/day mapped linearly to 0..100, clamped
SOLAR_SCORE_WEIGHTS = (0.7, 0.3)      # radiation score, regularity score
LOOKBACK_DAYS = 5                     # ingestion window: today and the 4 days before
CHUNK_MAX_YEARS = 2                   # one request covers at most 2 years
DRY_RUN_WINDOW_DAYS = 7               # preview: last 7 days
DAYS_OBSERVED_MIN = 350               # planned completeness assertion for complete years

# --- Fixed values: source tags and status ------------------------------------------------
SOURCE_WEATHER = "open-meteo-archive"
SOURCE_AGRI_REAL = "datagovma"
SOURCE_AGRI_MOCK = "mock-not-configured"
SOURCE_AGRI_FALLBACK = "mock-fallback-network-error"
MOCK_PREFIX = "mock"
PARTIAL_YEAR_SUFFIX = " (partielle)"

# --- Fixed values: region code pattern of the Moroccan deployment ------------------------
ISO_CODE_PATTERN = r"^MA-[0-9]{2}$"

# --- Fixed values: daily variables requested from the weather archive ------------------
DAILY_VARIABLES = (
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "precipitation_sum",
    "et0_fao_evapotranspiration",
    "shortwave_radiation_sum",
    "relative_humidity_2m_mean",
    "wind_speed_10m_max",
)
WEATHER_TIMEZONE = "Africa/Casablanca"
WEATHER_ARCHIVE_URL = "https://archive-api.open-meteo.com/v1/archive"

# --- Fixed values: agriculture CSV columns and header aliases ----------------------------
AGRI_COLUMNS = (
    "region_code",
    "annee",
    "production_tonnes",
    "surface_irriguee_ha",
    "ressource_hydrique_m3",
)
COLUMN_ALIASES = {
    "region": "region_code",
    "region_code": "region_code",
    "region_ code": "region_code",
    "annee": "annee",
    "campagne": "annee",
    "occurrence": "annee",
    "production_tonnes": "production_tonnes",
    "production": "production_tonnes",
    "surface_irriguee_ha": "surface_irriguee_ha",
    "superficie_irriguee": "surface_irriguee_ha",
    "superficie": "surface_irriguee_ha",
    "ressource_hydrique_m3": "ressource_hydrique_m3",
    "eau_m3": "ressource_hydrique_m3",
    "ressource_hydrique": "ressource_hydrique_m3",
}

# --- Fixed values: region label aliases (normalised label -> code), incl. pre-2015 names
REGION_ALIASES = {
    "tanger tetouan al hoceima": "MA-01",
    "tanger tetouan": "MA-01",
    "tanger assilah": "MA-01",
    "tanger": "MA-01",
    "l oriental": "MA-02",
    "oriental": "MA-02",
    "oujda": "MA-02",
    "fes meknes": "MA-03",
    "meknes tafilalet": "MA-03",
    "fes": "MA-03",
    "rabat sale kenitra": "MA-04",
    "gharb chrarda beni hssen": "MA-04",
    "rabat": "MA-04",
    "beni mellal khenifra": "MA-05",
    "beni mellal": "MA-05",
    "casablanca settat": "MA-06",
    "chaouia ouardigha": "MA-06",
    "casablanca": "MA-06",
    "marrakech safi": "MA-07",
    "marrakech tensift al haouz": "MA-07",
    "marrakech": "MA-07",
    "daraa tafilalet": "MA-08",
    "draa tafilalet": "MA-08",
    "errachidia": "MA-08",
    "souss massa": "MA-09",
    "souss massa draa": "MA-09",
    "agadir": "MA-09",
    "guelmim oued noun": "MA-10",
    "guelmim": "MA-10",
    "laayoune sakia el hamra": "MA-11",
    "laayoune saguia el hamra": "MA-11",
    "laayoune": "MA-11",
    "dakhla oued ed dahab": "MA-12",
    "oued ed dahab dakhla": "MA-12",
    "oued ed dahab lagouira": "MA-12",
    "oued eddahab": "MA-12",
    "dakhla": "MA-12",
}

# --- Fixed values: the 12 regions (code, name, capital, latitude, longitude, altitude m) -
REGIONS = (
    ("MA-01", "Tanger-Tétouan-Al Hoceïma", "Tanger-Assilah", 35.7669, -5.8, 20.0),
    ("MA-02", "L'Oriental", "Oujda", 34.6867, -1.9114, 450.0),
    ("MA-03", "Fès-Meknès", "Fès", 34.05, -4.9831, 400.0),
    ("MA-04", "Rabat-Salé-Kénitra", "Rabat", 34.0211, -6.8414, 75.0),
    ("MA-05", "Béni Mellal-Khénifra", "Béni Mellal", 32.3394, -6.3608, 500.0),
    ("MA-06", "Casablanca-Settat", "Casablanca", 33.5785, -7.6066, 50.0),
    ("MA-07", "Marrakech-Safi", "Marrakech", 31.6294, -7.9811, 450.0),
    ("MA-08", "Darâa-Tafilalet", "Errachidia", 31.9319, -4.4244, 1009.0),
    ("MA-09", "Souss-Massa", "Agadir", 30.4167, -9.6, 47.0),
    ("MA-10", "Guelmim-Oued Noun", "Guelmim", 28.9881, -10.0575, 456.0),
    ("MA-11", "Laâyoune-Saguia El Hamra", "Laâyoune", 27.1536, -13.2033, 63.0),
    ("MA-12", "Dakhla-Oued Ed-Dahab", "Oued-Eddahab", 23.7167, -15.95, 5.0),
)

# --- Fixed values: display labels, colours ------------------------------------------------
DROUGHT_LABELS = {
    "tres_sec": "Très sec",
    "sec": "Sec",
    "normal": "Normal",
    "humide": "Humide",
}
DROUGHT_SORT = {"tres_sec": 1, "sec": 2, "normal": 3, "humide": 4}
NO_DATA_SORT = 5
DROUGHT_COLORS = {
    "tres_sec": "#8c510a",
    "sec": "#d8b365",
    "normal": "#80cdc1",
    "humide": "#01665e",
}
NO_DATA_COLOR = "#9e9e9e"
NO_DATA_LABEL = "Année incomplète"
SOLAR_RAMP_LOW = "#ffffb2"
SOLAR_RAMP_HIGH = "#bd0026"
COLOR_ALPHA = 220
MISSING_TEXT = "—"

# Series offered over time (label -> column).
TIMESERIES_METRICS = {
    "SPI simplifié": "spi_simplified",
    "Ratio précipitations / ET0": "precip_et0_ratio",
    "Précipitations annuelles (mm)": "precipitation_total_mm",
    "Jours secs": "dry_days",
    "Score de potentiel solaire (0-100)": "solar_potential_score",
    "Rayonnement moyen (kWh/m²/jour)": "solar_radiation_avg_kwh_m2_day",
}

# Detail table: column -> display header, in display order.
DISPLAY_COLUMNS = {
    "region_code": "Code région",
    "region_name": "Région",
    "year": "Année",
    "drought_class": "Classe de sécheresse",
    "precip_et0_ratio": "Ratio P/ET0",
    "spi_simplified": "SPI simplifié",
    "precipitation_total_mm": "Précipitations (mm)",
    "et0_total_mm": "ET0 (mm)",
    "dry_days": "Jours secs",
    "solar_radiation_avg_kwh_m2_day": "Rayonnement (kWh/m²/j)",
    "sunny_days_pct": "Jours ensoleillés (%)",
    "solar_potential_score": "Score solaire (0-100)",
    "production_tonnes": "Production (t) [mock]",
    "irrigated_area_ha": "Surface irriguée (ha) [mock]",
    "water_resource_m3": "Ressource hydrique (m³) [mock]",
}

# --- Fixed values: serving projections (star schema) --------------------------------------
SERVING_COLUMNS = {
    "dim_region": ["region_code", "region_name", "capital", "latitude", "longitude", "altitude_m"],
    "dim_year": ["year", "is_complete_year", "year_label"],
    "fct_region_climate_kpi": [
        "region_code",
        "year",
        "is_complete_year",
        "water_balance_days",
        "water_balance_coverage",
        "precipitation_total_mm",
        "et0_total_mm",
        "precip_et0_ratio",
        "drought_class",
        "dry_days",
        "dry_days_ratio",
        "spi_simplified",
        "has_agriculture_data",
        "production_tonnes",
        "irrigated_area_ha",
        "water_resource_m3",
        "agriculture_source",
        "agriculture_is_mock",
    ],
    "fct_solar_potential": [
        "region_code",
        "year",
        "is_complete_year",
        "solar_days",
        "solar_coverage",
        "solar_radiation_avg_kwh_m2_day",
        "solar_radiation_total_kwh_m2",
        "sunny_days",
        "sunny_days_pct",
        "radiation_score",
        "regularity_score",
        "solar_potential_score",
    ],
}

# Dashboard merge: the columns each fact contributes.
CLIMATE_MERGE_COLUMNS = (
    "region_code",
    "region_name",
    "year",
    "is_complete_year",
    "precipitation_total_mm",
    "et0_total_mm",
    "precip_et0_ratio",
    "drought_class",
    "dry_days",
    "dry_days_ratio",
    "spi_simplified",
    "has_agriculture_data",
    "production_tonnes",
    "irrigated_area_ha",
    "water_resource_m3",
    "agriculture_is_mock",
)
SOLAR_MERGE_COLUMNS = (
    "region_code",
    "year",
    "latitude",
    "longitude",
    "altitude_m",
    "is_complete_year",
    "solar_radiation_avg_kwh_m2_day",
    "sunny_days_pct",
    "radiation_score",
    "solar_potential_score",
)
