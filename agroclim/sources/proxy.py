"""Proxy panel: the weather / agriculture / region relations derived from the
driver's TPC-H-like tables, so that every query reads real tables whose size grows
with the scale factor.

One lineitem row is one *ingestion* of one region x day: several rows hit the same
cell, so keeping the newest ingestion per key is real work. The same relations are
defined in DuckDB SQL in ``oracle/`` for the correctness gate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import SOURCE_AGRI_MOCK, SOURCE_AGRI_REAL, SOURCE_WEATHER
from agroclim.operators.joins import join_bounded
from agroclim.sources.tables import read_table

# Total ingest order of the proxy observations, newest first (all descending).
INGEST_ORDER = (
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_quantity",
    "l_discount",
    "l_tax",
)

# Nation count is fixed by the TPC-H schema; it is the dimension we broadcast.
NATION_MAX_ROWS = 1000
# key -> region maps (supplier, customer): (bigint, int) rows, 2M rows is about
# 32 MB per executor.
SUPPLIER_MAP_MAX_ROWS = 2_000_000


def region_code(regionkey: Column) -> Column:
    """R00 .. R99 from an integer region key."""
    return F.concat(F.lit("R"), F.lpad(regionkey.cast("string"), 2, "0"))


def _dec(col: Column, p: int, s: int) -> Column:
    return col.cast(f"decimal({p},{s})")


def nation_region(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "nation", ["n_nationkey", "n_name", "n_regionkey"])


def supplier_region(spark: SparkSession, root: str) -> DataFrame:
    """supplier key -> region code. Nation is tiny and bounded, supplier grows with SF."""
    supplier = read_table(spark, root, "supplier", ["s_suppkey", "s_nationkey"])
    nation = nation_region(spark, root)
    return join_bounded(
        supplier, nation, F.col("s_nationkey") == F.col("n_nationkey"), max_rows=NATION_MAX_ROWS
    ).select("s_suppkey", "n_regionkey")


def ingestions(spark: SparkSession, root: str) -> DataFrame:
    """Every ingestion of a region x day, narrow: region_code, date, region key and
    the raw columns the measures derive from (the ingest-order columns)."""
    li = read_table(
        spark,
        root,
        "lineitem",
        ["l_shipdate", "l_suppkey", *[c for c in INGEST_ORDER if c != "l_suppkey"]],
    )
    # supplier grows with the data (10k rows per SF): broadcast its 2-column key map
    # only while it is proven small, else a sort-merge join on the supplier key.
    # Never let the planner pick lineitem as the build side.
    obs = join_bounded(
        li, supplier_region(spark, root), F.col("l_suppkey") == F.col("s_suppkey"), max_rows=SUPPLIER_MAP_MAX_ROWS
    )
    return obs.select(
        region_code(F.col("n_regionkey")).alias("region_code"),
        F.col("l_shipdate").cast("date").alias("date"),
        "n_regionkey",
        *INGEST_ORDER,
    )


def with_measures(ing: DataFrame) -> DataFrame:
    """raw.weather_daily measures and audit columns of ingestion rows.

    Kept apart from ``ingestions`` so the newest-per-key filter can run on the
    narrow rows first and the expressions only on the winners.
    """
    rk = F.col("n_regionkey")
    first_line = F.col("l_linenumber") == 1
    temp_mean = _dec((F.col("l_partkey") % 850 - 250) / F.lit(10.0), 5, 2)
    spread = _dec(F.col("l_linenumber"), 5, 2)
    return ing.select(
        "region_code",
        "date",
        _dec(temp_mean + spread, 5, 2).alias("temperature_2m_max"),
        _dec(temp_mean - spread, 5, 2).alias("temperature_2m_min"),
        temp_mean.alias("temperature_2m_mean"),
        F.when(~((F.col("l_quantity") == 50) & first_line), _dec(_dec(F.col("l_discount"), 4, 2) * 10 * (rk + 1), 6, 2)).alias(
            "precipitation_sum"
        ),
        F.when(~((F.col("l_quantity") == 49) & first_line), _dec(1 + _dec(F.col("l_tax"), 4, 2) * 50, 6, 2)).alias(
            "et0_fao_evapotranspiration"
        ),
        F.when(~((F.col("l_quantity") == 48) & first_line), _dec(10 + _dec(F.col("l_quantity"), 4, 1) / 2, 7, 2)).alias(
            "shortwave_radiation_sum"
        ),
        _dec(F.col("l_orderkey") % 101, 5, 2).alias("relative_humidity_2m_mean"),
        _dec(F.col("l_suppkey") % 90 + F.lit(0.5), 5, 2).alias("wind_speed_10m_max"),
        F.lit(SOURCE_WEATHER).alias("_source"),
        F.concat(
            F.lit("proxy://lineitem?orderkey="),
            F.col("l_orderkey").cast("string"),
            F.lit("&line="),
            F.col("l_linenumber").cast("string"),
        ).alias("_source_url"),
        F.concat(F.lit("batch-"), F.year("date").cast("string")).alias("_batch_id"),
        *[F.col(c) for c in INGEST_ORDER],
    )


def weather_observations(spark: SparkSession, root: str) -> DataFrame:
    """Every ingestion of a region x day with raw.weather_daily measures (not deduplicated).

    Columns: region_code, date, 8 NUMERIC measures, audit columns, the ingest-order
    columns (``INGEST_ORDER``).
    """
    return with_measures(ingestions(spark, root))


def dim_region(spark: SparkSession, root: str) -> DataFrame:
    """Region reference rows: code, name, capital (first nation name), coordinates."""
    region = read_table(spark, root, "region", ["r_regionkey", "r_name"])
    capital = nation_region(spark, root).groupBy("n_regionkey").agg(F.min("n_name").alias("capital"))
    rk = F.col("r_regionkey")
    return region.join(capital, rk == F.col("n_regionkey"), "left").select(
        region_code(rk).alias("region_code"),
        F.col("r_name").alias("region_name"),
        F.col("capital"),
        (20 + 3 * rk).cast("double").alias("latitude"),
        (-5 - 2 * rk).cast("double").alias("longitude"),
        (100 * rk).cast("double").alias("altitude_m"),
    )


def agriculture_rows(spark: SparkSession, root: str) -> DataFrame:
    """raw.agriculture_regional-shaped rows: one per region x order year."""
    orders = read_table(spark, root, "orders", ["o_custkey", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, root, "customer", ["c_custkey", "c_nationkey"])
    cust_region = join_bounded(
        customer, nation_region(spark, root), F.col("c_nationkey") == F.col("n_nationkey"), max_rows=NATION_MAX_ROWS
    ).select("c_custkey", "n_regionkey")
    # customer grows with the data (150k rows per SF): same rule as the supplier map.
    joined = join_bounded(orders, cust_region, F.col("o_custkey") == F.col("c_custkey"), max_rows=SUPPLIER_MAP_MAX_ROWS)
    year = F.year("o_orderdate").cast("int")
    grouped = joined.groupBy(F.col("n_regionkey"), year.alias("annee")).agg(
        F.sum(_dec(F.col("o_totalprice"), 12, 2)).alias("price_total"),
        F.count(F.lit(1)).alias("n_orders"),
        F.countDistinct("o_custkey").alias("n_customers"),
    )
    return grouped.select(
        region_code(F.col("n_regionkey")).alias("region_code"),
        F.col("annee"),
        _dec(F.col("price_total") * F.lit(0.0001).cast("decimal(5,4)"), 12, 2).alias("production_tonnes"),
        _dec(F.col("n_orders") * 10, 12, 2).alias("surface_irriguee_ha"),
        _dec(F.col("n_customers") * 1000, 14, 2).alias("ressource_hydrique_m3"),
        F.when(F.col("annee") % 2 == 0, F.lit(SOURCE_AGRI_MOCK)).otherwise(F.lit(SOURCE_AGRI_REAL)).alias("_source"),
    )


def dirty_agriculture(spark: SparkSession, root: str) -> DataFrame:
    """Agriculture rows rendered as a messy text CSV would hold them (I1-I4, B6 input).

    Each row picks a label, year and number style from its own values, so every style
    occurs at every scale: region codes in lower case, region names with accents and
    punctuation, nation names (capital-like aliases), an unknown label; plain, campaign
    ('1996/1997'), float and blank/N/A years; French and English number formats.
    """
    rows = agriculture_rows(spark, root)
    region = read_table(spark, root, "region", ["r_regionkey", "r_name"]).withColumn(
        "region_code", region_code(F.col("r_regionkey"))
    )
    capital = nation_region(spark, root).groupBy("n_regionkey").agg(F.min("n_name").alias("capital"))
    names = region.join(capital, F.col("r_regionkey") == F.col("n_regionkey")).select(
        "region_code", "r_name", "capital"
    )
    rows = rows.join(names, "region_code")
    v = (F.col("annee") + F.length("region_code") + F.col("region_code").substr(2, 2).cast("int")) % 5
    capitalised = F.concat(F.upper(F.substring("r_name", 1, 1)), F.lower(F.expr("substring(r_name, 2)")))
    accented = F.translate(capitalised, "aeiAEI", "àéîÀÉÎ")
    label = (
        F.when(
            v == 0,
            F.when(
                F.col("annee") % 3 == 0,  # shaped like a code but absent from the dimension
                F.concat(F.lit("r"), F.lpad((F.col("region_code").substr(2, 2).cast("int") + 5).cast("string"), 2, "0")),
            ).otherwise(F.lower(F.col("region_code"))),
        )
        .when(v == 1, F.concat(F.lit("  "), F.regexp_replace(accented, " ", "-"), F.lit(" ")))
        .when(v == 2, F.concat(F.lit("L'"), F.col("capital")))
        .when(v == 3, F.col("capital"))
        .otherwise(F.when(F.col("annee") % 3 == 0, F.lit("Atlantis")).otherwise(F.upper(F.col("r_name"))))
    )
    w = (F.col("annee") + F.col("region_code").substr(2, 2).cast("int")) % 6
    year = (
        F.when(w == 0, F.col("annee").cast("string"))
        .when(w == 1, F.concat(F.col("annee").cast("string"), F.lit("/"), (F.col("annee") + 1).cast("string")))
        .when(w == 2, F.concat(F.lit(" "), F.col("annee").cast("string"), F.lit(".0 ")))
        .when(w == 3, F.concat(F.col("annee").cast("string"), F.lit(" / "), (F.col("annee") + 1).cast("string")))
        .when(w == 4, F.when(F.col("annee") % 4 == 0, F.lit("")).otherwise(F.col("annee").cast("string")))
        .otherwise(F.when(F.col("annee") % 4 == 1, F.lit("N/A")).otherwise(F.col("annee").cast("string")))
    )

    def french(col: Column, sep: str) -> Column:
        # 1234567.89 -> '1<sep>234<sep>567,89' (thousands groups, comma decimal)
        text = F.format_number(col, 2)  # '1,234,567.89'
        return F.translate(F.regexp_replace(text, ",", sep), ".", ",")

    n = F.col("annee") % 4
    prod = (
        F.when(n == 0, F.col("production_tonnes").cast("string"))
        .when(n == 1, french(F.col("production_tonnes"), " "))
        .when(n == 2, french(F.col("production_tonnes"), "\u00a0"))
        .otherwise(F.regexp_replace(F.format_number(F.col("production_tonnes"), 2), ",", ""))
    )
    surface = F.when(n == 3, french(F.col("surface_irriguee_ha"), "\u202f")).otherwise(
        F.col("surface_irriguee_ha").cast("string")
    )
    water = F.when(n == 1, F.translate(F.col("ressource_hydrique_m3").cast("string"), ".", ",")).otherwise(
        F.col("ressource_hydrique_m3").cast("string")
    )
    return rows.select(
        label.alias("region"),
        year.alias("annee"),
        prod.alias("production_tonnes"),
        surface.alias("surface_irriguee_ha"),
        water.alias("ressource_hydrique_m3"),
        F.col("_source").alias("source"),
    )


def order_texts(spark: SparkSession, root: str) -> DataFrame:
    """One line of a messy drop per order: o_orderkey, label, year_text, amount_text.

    The order's key picks the style of each text: codes in lower case and unknown ones,
    accents, hyphens, apostrophes and no-break spaces around names, unknown labels; plain,
    campaign, float, blank and spoiled years; plain, French and dotted numbers.
    """
    orders = read_table(spark, root, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    customer = read_table(spark, root, "customer", ["c_custkey", "c_nationkey"])
    region = read_table(spark, root, "region", ["r_regionkey", "r_name"])
    places = join_bounded(nation_region(spark, root), region, F.col("n_regionkey") == F.col("r_regionkey"), max_rows=NATION_MAX_ROWS)
    where = join_bounded(customer, places, F.col("c_nationkey") == F.col("n_nationkey"), max_rows=NATION_MAX_ROWS).select(
        "c_custkey", "n_name", "n_regionkey", "r_name")
    rows = join_bounded(orders, where, F.col("o_custkey") == F.col("c_custkey"), max_rows=SUPPLIER_MAP_MAX_ROWS)
    key, rk, name = F.col("o_orderkey"), F.col("n_regionkey"), F.col("n_name")
    capitalised = F.concat(F.upper(F.substring("r_name", 1, 1)), F.lower(F.expr("substring(r_name, 2)")))

    def pick(n: int, styles: list[Column]) -> Column:
        out = styles[-1]
        for k, style in reversed(list(enumerate(styles[:-1]))):
            out = F.when(key % n == k, style).otherwise(out)
        return out

    label = pick(8, [
        F.concat(F.lit(" "), F.lower(region_code(rk)), F.lit(" ")),
        F.regexp_replace(F.translate(capitalised, "aeiAEI", "àéîÀÉÎ"), " ", "-"),
        F.concat(F.lit("L'"), name),
        F.concat(F.lit(" "), name, F.lit("  ")),
        F.translate(name, "AEIOU", "ÅÉÌÕÜ"),
        F.concat(F.lit("Atlantis "), (key % 97).cast("string")),
        F.concat(F.lit("r"), F.lpad((rk + 5).cast("string"), 2, "0")),
        F.regexp_replace(name, " ", "--"),
    ])
    y, later = F.year("o_orderdate").cast("string"), (F.year("o_orderdate") + 1).cast("string")
    year = pick(7, [
        y, F.concat(y, F.lit("/"), later), F.concat(F.lit(" "), y, F.lit(".0 ")), F.concat(y, F.lit(" / "), later),
        F.lit(""), F.concat(y, F.lit("d")), F.concat(F.lit(" "), y),
    ])
    price = _dec(F.col("o_totalprice"), 12, 2)
    grouped = F.format_number(price, 2)
    amount = pick(5, [
        price.cast("string"),
        F.translate(F.regexp_replace(grouped, ",", " "), ".", ","),
        F.translate(F.regexp_replace(grouped, ",", " "), ".", ","),
        F.translate(grouped, ",.", ".,"),
        F.translate(price.cast("string"), ".", ","),
    ])
    return rows.select("o_orderkey", label.alias("label"), year.alias("year_text"), amount.alias("amount_text"))
