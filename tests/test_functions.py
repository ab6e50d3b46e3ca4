"""Scalar expressions: literal vectors of the source system's unit tests."""

import math

import pytest
from pyspark.sql import functions as F

from agroclim.functions import display, labels, numbers
from agroclim.operators import cleaning


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_decimal_vectors(spark):
    texts = ["1 234,56", "1\u00a0234,56", "1\u202f234,56", "1234.56", "1234,56", "1.234,56", "1,234.56", "", None, "  "]
    got = col_values(spark, texts, numbers.parse_decimal)
    assert got[:6] == [1234.56] * 6
    assert got[6] == pytest.approx(1.23456)  # '.' read as thousands mark when both marks appear
    assert got[7:] == [None, None, None]


def test_parse_decimal_junk_raises(spark):
    with pytest.raises(Exception):
        col_values(spark, ["abc"], numbers.parse_decimal)
    assert col_values(spark, ["abc"], numbers.try_parse_decimal) == [None]


def test_parse_year_vectors(spark):
    got = col_values(spark, ["2010/2011", "2010", " 2010.0 ", "2010 / 2011", "", "N/A", "abc", "1999.9"], numbers.parse_year)
    assert got == [2010, 2010, 2010, 2010, None, None, None, 1999]


def test_normalize_label(spark):
    got = col_values(spark, ["Béni Mellal-Khénifra", "L'Oriental", "  Tanger–Tétouan ", "Laâyoune  Sakia", "O’Hara"], labels.normalize_label)
    assert got == ["beni mellal khenifra", "l oriental", "tanger–tetouan", "laayoune sakia", "o hara"]
    assert col_values(spark, ["Tanger-Tétouan-Al Hoceïma"], labels.label_key) == ["tanger tetouan al hoceima"]


def test_accent_table_is_rule_built():
    src, dst = labels.accent_table()
    assert len(src) == len(dst) > 200
    assert dict(zip(src, dst))["é"] == "e" and dict(zip(src, dst))["Ï"] == "I"


def test_resolve_region_vectors(spark):
    aliases = cleaning.alias_table(spark)
    labels_in = ["L'Oriental", "Béni Mellal-Khénifra", "ma-04", "Atlantis", "MA-99", "Tanger-Tétouan", "Meknès-Tafilalet",
                 "Gharb-Chrarda-Beni Hssen", "Chaouia-Ouardigha", "Marrakech-Tensift-Al Haouz", "Souss-Massa-Drâa",
                 "Oued Ed-Dahab-Lagouira"]
    df = spark.createDataFrame([(x,) for x in labels_in], "label string")
    got = {r["label"]: r["resolved_code"] for r in cleaning.resolve_region(df, "label", aliases).collect()}
    assert got == {
        "L'Oriental": "MA-02", "Béni Mellal-Khénifra": "MA-05", "ma-04": "MA-04", "Atlantis": None, "MA-99": "MA-99",
        "Tanger-Tétouan": "MA-01", "Meknès-Tafilalet": "MA-03", "Gharb-Chrarda-Beni Hssen": "MA-04",
        "Chaouia-Ouardigha": "MA-06", "Marrakech-Tensift-Al Haouz": "MA-07", "Souss-Massa-Drâa": "MA-09",
        "Oued Ed-Dahab-Lagouira": "MA-12",
    }


@pytest.mark.parametrize(
    "p, et0, ratio, cls",
    [(718.9, 1304.5, 0.551, "normal"), (460.3, 1358.4, 0.339, "sec"), (276.5, 1685.5, 0.164, "tres_sec"),
     (1000.0, 1000.0, 1.0, "humide"), (200.0, 1000.0, 0.2, "sec"), (650.0, 1000.0, 0.65, "humide")],
)
def test_drought_class_golden(spark, p, et0, ratio, cls):
    from decimal import Decimal

    df = spark.createDataFrame([(Decimal(str(p)), Decimal(str(et0)))], "p decimal(9,1), e decimal(9,1)")
    r = df.select((F.col("p") / F.col("e")).alias("r")).select(
        F.round("r", 3).cast("double").alias("rounded"), display.drought_class(F.col("r"), F.lit(True)).alias("c"),
        display.drought_class(F.col("r"), F.lit(False)).alias("incomplete")).first()
    assert (r["rounded"], r["c"], r["incomplete"]) == (ratio, cls, None)


def test_labels_and_colours(spark):
    classes = ["tres_sec", "sec", "normal", "humide", None, "autre"]
    df = spark.createDataFrame([(c,) for c in classes], "c string")
    rows = df.select(display.drought_label(F.col("c")).alias("l"), display.drought_sort(F.col("c")).alias("s"),
                     display.drought_color(F.col("c")).alias("rgba")).collect()
    assert [r["l"] for r in rows] == ["Très sec", "Sec", "Normal", "Humide", "Année incomplète", "Année incomplète"]
    assert [r["s"] for r in rows] == [1, 2, 3, 4, 5, 5]
    assert rows[0]["rgba"] == [140, 81, 10, 220]
    assert rows[4]["rgba"] == [158, 158, 158, 220]
    hexes = spark.createDataFrame([("#8c510a",)], "h string").select(display.hex_to_rgb(F.col("h"))).first()[0]
    assert hexes == [140, 81, 10]


def test_solar_colour(spark):
    scores = [0.0, 100.0, 150.0, -5.0, 50.0, None, float("nan")]
    got = col_values(spark, scores, display.solar_color, "double")
    low, high = (255, 255, 178), (189, 0, 38)

    def expected(score):
        if score is None or math.isnan(score):
            return [158, 158, 158, 220]
        t = min(max(score / 100.0, 0.0), 1.0)
        return [round(lo + (hi - lo) * t) for lo, hi in zip(low, high)] + [220]

    assert got == [expected(s) for s in scores]


def test_format_number(spark):
    df = spark.createDataFrame([(1.2345,), (60.44,), (None,), (float("nan"),), (2.675,)], "v double")
    rows = df.select(display.format_number(F.col("v"), 2).alias("a"), display.format_number(F.col("v"), 1, " / 100").alias("b")).collect()
    assert rows[0]["a"] == "1.23"
    assert rows[1]["b"] == "60.4 / 100"
    assert rows[2]["a"] == "—" and rows[3]["a"] == "—"
    assert rows[4]["a"] == f"{2.675:.2f}" == "2.67"  # exact binary value decides, as in Python


def test_year_label(spark):
    df = spark.createDataFrame([(2025, True), (2026, False)], "y int, c boolean")
    assert [r[0] for r in df.select(display.year_label(F.col("y"), F.col("c"))).collect()] == ["2025", "2026 (partielle)"]


def test_mj_to_kwh_no_ties(spark):
    # x / 3.6 for a 2-decimal x is a multiple of 1/360: never a 3-decimal tie
    df = spark.createDataFrame([(x / 100,) for x in range(0, 4000, 7)], "x double")
    got = df.select(F.col("x").cast("decimal(7,2)").alias("d")).select(numbers.mj_to_kwh(F.col("d")).cast("double")).collect()
    assert all(abs(r[0] - round(x / 100 / 3.6, 3)) < 1e-9 for r, x in zip(got, range(0, 4000, 7)))



def test_latest_wins_with_a_hot_key(spark):
    from agroclim.operators.silver import latest_wins

    hot = spark.range(0, 30000).select(F.lit("R00").alias("k"), (F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    cold = spark.range(0, 60000).select(F.concat(F.lit("R"), (F.col("id") % 1000 + 1).cast("string")).alias("k"),
                                        (F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    out = {r.k: (r.a, r.b) for r in latest_wins(hot.unionByName(cold).repartition(16), ["k"], ["a", "b"]).collect()}
    assert len(out) == 1001
    assert out["R00"] == max((i % 7, i) for i in range(30000))  # greatest (a, b) tuple
    assert out["R1"] == max((i % 3, i) for i in range(0, 60000, 1000))


def test_accents_of_every_character_are_stripped(spark):
    import unicodedata

    points = [c for c in range(0xA0, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    df = spark.createDataFrame([("x" + chr(c) + "y",) for c in points], "t string").repartition(8)
    for r in df.select("t", labels.strip_accents(F.col("t")).alias("s")).collect():
        assert r.s == "".join(c for c in unicodedata.normalize("NFKD", r.t) if not unicodedata.combining(c)), r.t


def test_fixed_text_matches_python_rounding(spark):
    import random

    random.seed(11)
    vals = set()
    for d in range(4):
        for i in range(-400, 400):
            vals.add(round(i / 10 ** (d + 1), d + 1))  # decimal ties: x.xx5 (binary value decides)
            vals.add(i / 8)                           # exactly representable ties (to even)
    for _ in range(3000):
        vals.add(random.uniform(-1e4, 1e4))
        vals.add(random.uniform(-1, 1))
    for d in range(5):
        for i in range(-120, 120):
            tie = round((i + 0.5) / 10 ** d, d + 1)
            vals |= {tie, math.nextafter(tie, math.inf), math.nextafter(tie, -math.inf)}  # neighbours of a tie
    vals |= {2.675, 1.005, 0.125, -2.5, 2.5, 3.5, 0.0005, -0.001, 1e-7, -1e-7, 9999999999.995, 3e12, 0.00005, 12.34565}
    vals = sorted(vals)
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    for d in range(5):
        got = [r[0] for r in df.select(display.fixed_text(F.col("v"), d)).collect()]
        assert got == [f"{v:.{d}f}" for v in vals], d


def test_fixed_text_is_exact_for_every_double(spark):
    import random
    import struct

    rng = random.Random(3)
    vals = [0.0, -0.0, 12345678902.5, 1e22, 1e23, 1e300, 5e-324, 1.7976931348623157e308, math.inf, -math.inf, 2.0**53, 2.0**53 + 2, 2.0**52 + 0.5, 2.0**51 + 0.5,
            1e-20, 5e-21, -1e-21, 0.9999999, 2.0**-72, 2.0**-73, 0.05, -0.05, 2.0**124, 2.0**123 - 2.0**80]
    vals += [x for x in (struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(1500)) if x == x]
    vals += [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-22, 20) for _ in range(1500)]
    vals += [rng.randint(-10**7, 10**7) / 2 ** rng.randint(0, 12) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(8)
    for d in (0, 2, 7, 20):
        got = {struct.pack("<d", r.v): r.t for r in df.select("v", display.fixed_text(F.col("v"), d).alias("t")).collect()}
        assert got == {struct.pack("<d", v): f"{v:.{d}f}" for v in vals}, d
    with pytest.raises(ValueError):
        display.fixed_text(F.col("v"), 21)


def test_parsers_take_any_unicode_space_and_no_type_suffix(spark):
    nb = " "
    got = col_values(spark, [nb + "2010", "2010" + nb + "/" + nb + "2011", "\t2010\t", "2010d", "2010f", "2.01e3"], numbers.parse_year)
    assert got == [2010, 2010, 2010, None, None, 2010]
    assert col_values(spark, ["12d", "12f", nb + "12,5", "1 234,5"], numbers.try_parse_decimal) == [None, None, 12.5, 1234.5]


@pytest.mark.parametrize("text", ["2200000000", "3000000000"])
def test_a_year_beyond_the_column_raises(spark, text):
    assert col_values(spark, ["2100000000"], numbers.parse_year) == [2_100_000_000]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        col_values(spark, [text], numbers.parse_year)


def test_a_number_with_a_type_suffix_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        col_values(spark, ["12d"], numbers.parse_decimal)


def test_labels_of_all_alphabets(spark):
    got = col_values(spark, ["Al Ḥoceïma", "ﬁn ĳs", "Ｆès"], labels.normalize_label)
    assert got == ["al hoceima", "fin ijs", "fes"]
    assert col_values(spark, [" ma-01 "], lambda c: labels.code_or_null(c, "^MA-[0-9]{2}$")) == ["MA-01"]
