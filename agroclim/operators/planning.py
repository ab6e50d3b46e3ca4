"""Ingestion planning as DataFrame jobs: lookback windows, region selection,
2-year request chunks, the request manifest, and gap detection with a repair list."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroclim.constants import (
    CHUNK_MAX_YEARS,
    DAILY_VARIABLES,
    LOOKBACK_DAYS,
    WEATHER_ARCHIVE_URL,
    WEATHER_TIMEZONE,
)
from agroclim.functions import daybits
from agroclim.operators.gold import coverage, days_in_year
from agroclim.operators.joins import join_bounded

CHUNK_MONTHS = 12 * CHUNK_MAX_YEARS
CHUNKS_MAX_ROWS = 1_000_000


def window_bounds(end: Column, lookback: int = LOOKBACK_DAYS, start: Column | None = None) -> tuple[Column, Column]:
    """[end - (lookback - 1), end], or [start, end] when a start is given."""
    return (start if start is not None else F.date_sub(end, lookback - 1)), end


def date_window(df: DataFrame, end: Column, lookback: int = LOOKBACK_DAYS, start: Column | None = None,
                date_col: str = "date") -> DataFrame:
    """Rows whose date lies in the sliding window ending at ``end`` (inclusive)."""
    lo, hi = window_bounds(end, lookback, start)
    return df.where(F.col(date_col).between(lo, hi))


def parse_region_codes(text: str) -> list[str]:
    """'ma-01, MA-03 ,' -> ['MA-01', 'MA-03'] (trimmed, upper-cased, blanks dropped)."""
    return [c.strip().upper() for c in text.split(",") if c.strip()]


def select_regions(df: DataFrame, dim: DataFrame, codes: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of the requested regions (default: all). An empty request or a code
    absent from ``dim`` is an error, raised before any data is read: only the
    requested codes are looked up in the dimension."""
    if codes is None:
        return df
    wanted = parse_region_codes(codes) if isinstance(codes, str) else [c.strip().upper() for c in codes if c.strip()]
    if not wanted:
        raise ValueError("region list must not be empty")
    known = {r[0] for r in dim.where(F.col("region_code").isin(wanted)).select("region_code").distinct().collect()}
    unknown = [c for c in wanted if c not in known]
    if unknown:
        raise ValueError(f"unknown region code(s): {unknown}")
    return df.where(F.col("region_code").isin(wanted))


def split_chunks(requests: DataFrame, start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Closed date chunks of at most 2 years for each request row.

    Chunk k ends the day before its start's 2-year anniversary (clipped to the
    request end). A 29 February start has no anniversary: that chunk ends on
    27 February and every later chunk is anchored on 28 February. start > end
    gives no chunk. Output: request columns + chunk_index, chunk_start, chunk_end.
    """
    start, end = F.col(start_col), F.col(end_col)
    feb29 = (F.month(start) == 2) & (F.dayofmonth(start) == 29)
    anchor = F.when(feb29, F.make_date(F.year(start) + CHUNK_MAX_YEARS, F.lit(2), F.lit(28))).otherwise(start)
    regular = F.when(
        anchor <= end, F.sequence(anchor, end, F.expr(f"INTERVAL {CHUNK_MAX_YEARS} YEARS"))
    ).otherwise(F.array().cast("array<date>"))
    starts = F.when(start > end, F.array().cast("array<date>")).when(
        feb29, F.concat(F.array(start), regular)
    ).otherwise(regular)
    exploded = requests.select("*", F.posexplode(starts).alias("chunk_index", "chunk_start"))
    chunk_end = F.least(F.date_sub(F.add_months(F.col("chunk_start"), CHUNK_MONTHS), 1), end)
    return exploded.withColumn("chunk_end", chunk_end)


def request_url(lat: Column, lon: Column, start: Column, end: Column) -> Column:
    """The archive request URL of one chunk, query string encoded like an HTTP client."""
    daily = quote(",".join(DAILY_VARIABLES), safe="")
    tz = quote(WEATHER_TIMEZONE, safe="")
    return F.concat(
        F.lit(f"{WEATHER_ARCHIVE_URL}?latitude="), lat.cast("string"),
        F.lit("&longitude="), lon.cast("string"),
        F.lit("&start_date="), start.cast("string"),
        F.lit("&end_date="), end.cast("string"),
        F.lit(f"&daily={daily}&timezone={tz}"),
    )


def ingest_manifest(chunks: DataFrame, dim: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Region x chunk request rows with their parameters and exact URL (provenance).
    ``chunks`` carries region_code; coordinates come from the dimension. ``keep``: more
    columns of the chunks."""
    coords = dim.select("region_code", "latitude", "longitude")
    rows = join_bounded(chunks, coords, "region_code", max_rows=100_000)
    return rows.select(
        "region_code",
        "chunk_index",
        "chunk_start",
        "chunk_end",
        "latitude",
        "longitude",
        F.lit(",".join(DAILY_VARIABLES)).alias("daily"),
        F.lit(WEATHER_TIMEZONE).alias("timezone"),
        request_url(F.col("latitude"), F.col("longitude"), F.col("chunk_start"), F.col("chunk_end")).alias("url"),
        *keep,
    )


def day_maps(observed: DataFrame, date_col: str = "date") -> DataFrame:
    """Region x calendar year with the bits of the observed days and their number.

    Reads two columns and keeps six words per region and year in a hash aggregate,
    combined before the shuffle: any number of ingestions of a day costs nothing after
    the map task, and no row is sorted.
    """
    day = F.col(date_col)
    by_year = observed.groupBy("region_code", F.year(day).alias("year")).agg(daybits.collect_days(day).alias("day_bits"))
    return by_year.withColumn("days_observed", daybits.count_days(F.col("day_bits")))


def region_maps(maps: DataFrame) -> DataFrame:
    """Per region: first and last observed day, number of days, and its day maps by year
    (a region has one small entry per year)."""
    bits = F.col("day_bits")
    return maps.groupBy("region_code").agg(
        F.min(daybits.date_of(F.col("year"), daybits.first_day(bits))).alias("start_date"),
        F.max(daybits.date_of(F.col("year"), daybits.last_day(bits))).alias("end_date"),
        F.sum("days_observed").alias("days"),
        F.map_from_entries(F.collect_list(F.struct("year", "day_bits"))).alias("day_maps"),
    )


def observed_span(observed: DataFrame, date_col: str = "date") -> DataFrame:
    """Per region: first and last observed day (the default request span)."""
    return observed.groupBy("region_code").agg(F.min(date_col).alias("start_date"), F.max(date_col).alias("end_date"))


def _missing_bits(year: Column, first: Column, last: Column) -> Column:
    """The bits of the days of ``year`` in first..last that day_maps does not hold."""
    expected = daybits.days_between(daybits.day_of(first, year), daybits.day_of(last, year))
    return daybits.only_in(expected, F.coalesce(F.try_element_at("day_maps", year), daybits.no_days()))


def missing_by_year(regions: DataFrame) -> DataFrame:
    """Region x every calendar year of its span with the bits of the missing days.

    ``regions``: region_code, start_date, end_date, day_maps (null: nothing observed).
    """
    years = F.sequence(F.year("start_date"), F.year("end_date"))
    spread = regions.where("start_date <= end_date").withColumn("year", F.explode(years))
    return spread.select("region_code", "year", _missing_bits(F.col("year"), F.col("start_date"), F.col("end_date")).alias("missing_bits"))


def missing_days(observed: DataFrame, spans: DataFrame | None = None, date_col: str = "date") -> DataFrame:
    """Expected region x day minus observed days: bit operations on one row per region and
    year. ``spans`` gives each region's start_date and end_date (default: first to last
    observed day); the observations are read once and only missing days become rows."""
    regions = region_maps(day_maps(observed, date_col))
    if spans is not None:
        regions = spans.select("region_code", "start_date", "end_date").join(regions.select("region_code", "day_maps"), "region_code", "left")
    gaps = missing_by_year(regions).where(daybits.count_days(F.col("missing_bits")) > 0)
    return gaps.select("region_code", F.explode(F.transform(daybits.list_days(F.col("missing_bits")), lambda d: daybits.date_of(F.col("year"), d))).alias("date"))


def repair_list(regions: DataFrame) -> DataFrame:
    """The request chunks of each region that miss days, with their number and the first
    and last of them. ``regions`` as in ``missing_by_year``: nothing else is read."""
    def of_year(year: Column) -> Column:
        bits = _missing_bits(year, F.col("chunk_start"), F.col("chunk_end"))
        return F.struct(
            daybits.count_days(bits).alias("n"),
            daybits.date_of(year, daybits.first_day(bits)).alias("first"),
            daybits.date_of(year, daybits.last_day(bits)).alias("last"),
        )

    chunks = split_chunks(regions).withColumn("_gaps", F.transform(F.sequence(F.year("chunk_start"), F.year("chunk_end")), of_year))
    return chunks.select(
        "region_code", "chunk_index", "chunk_start", "chunk_end",
        F.aggregate("_gaps", F.lit(0).cast("long"), lambda n, g: n + g["n"]).alias("missing_days"),
        F.array_min("_gaps.first").alias("first_missing"),
        F.array_max("_gaps.last").alias("last_missing"),
    ).where("missing_days > 0")


def missing_chunks(missing: DataFrame, chunks: DataFrame) -> DataFrame:
    """Roll missing days up to the request chunks that must be re-run: the repair list.

    A chunk spans at most 3 calendar years, so each chunk is listed once per year it
    touches and the join key is (region_code, year): no region becomes one hot key,
    and each missing day meets at most two candidate chunks before the range test.
    The chunk list is broadcast when proven small.
    """
    extra = [c for c in ("url",) if c in chunks.columns]
    per_year = chunks.select(
        F.col("region_code").alias("_rc"),
        F.explode(F.sequence(F.year("chunk_start"), F.year("chunk_end"))).alias("_y"),
        "chunk_index", "chunk_start", "chunk_end", *extra,
    )
    days = missing.withColumn("_dy", F.year("date"))
    cond = (
        (F.col("region_code") == F.col("_rc"))
        & (F.col("_dy") == F.col("_y"))
        & F.col("date").between(F.col("chunk_start"), F.col("chunk_end"))
    )
    joined = join_bounded(days, per_year, cond, max_rows=CHUNKS_MAX_ROWS)
    keys = ["region_code", "chunk_index", "chunk_start", "chunk_end", *extra]
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("missing_days"), F.min("date").alias("first_missing"), F.max("date").alias("last_missing")
    )


def completeness(maps: DataFrame) -> DataFrame:
    """Per region: days stored, first and last day; ordered by count then code."""
    return region_maps(maps).select(
        "region_code", "days", F.col("start_date").alias("first_date"), F.col("end_date").alias("last_date")
    ).orderBy("days", "region_code")


def year_coverage(maps: DataFrame) -> DataFrame:
    """Region x year: observed days and the share of the year they cover (3 digits)."""
    return maps.select("region_code", "year", "days_observed", coverage(F.col("days_observed"), days_in_year(F.col("year"))).alias("coverage"))
