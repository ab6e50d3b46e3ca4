"""Data-quality checks. Each check returns a violations DataFrame (empty = pass);
nulls pass range and accepted-values checks, as in declarative SQL tests.

``run_checks`` evaluates every test of a table in ONE aggregation pass: row rules
are counted per unique-key group, uniqueness and key relationships are read off the
groups.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from agroclim.constants import DAYS_OBSERVED_MIN, DROUGHT_CLASSES
from agroclim.operators.joins import join_bounded

DIM_MAX_ROWS = 100_000


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count (partial
    aggregation before the shuffle, so hot keys are pre-counted per task)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where(F.col("occurrences") > 1)


def null_columns(cols: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]))


def check_not_null(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a null in any of ``cols``; ``null_columns`` names them."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.where(cond).select(*keep, null_columns(cols).alias("null_columns"))


def check_relationship(df: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None) -> DataFrame:
    """Rows whose non-null ``key`` has no match in ``parent`` (LEFT ANTI)."""
    parent_key = parent_key or key
    right = parent.select(F.col(parent_key).alias("_parent_key")).distinct()
    return join_bounded(df.where(F.col(key).isNotNull()), right, F.col(key) == F.col("_parent_key"), "left_anti", DIM_MAX_ROWS)


def out_of_range(col: str, min_value: float | None = None, max_value: float | None = None) -> Column:
    c = F.col(col)
    cond = F.lit(False)
    if min_value is not None:
        cond = cond | (c < F.lit(min_value))
    if max_value is not None:
        cond = cond | (c > F.lit(max_value))
    return c.isNotNull() & cond


def check_range(df: DataFrame, col: str, min_value: float | None = None, max_value: float | None = None) -> DataFrame:
    """Rows with ``col`` outside [min, max] (nulls pass)."""
    return df.where(out_of_range(col, min_value, max_value))


def not_accepted(col: str, values: Iterable) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def check_values(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose ``col`` is not one of ``values`` (nulls pass)."""
    return df.where(not_accepted(col, values))


def raw_rules(table: str, code_pattern: str) -> dict[str, Column]:
    """DDL-style row predicates per table (True = violation)."""
    code_bad = F.col("region_code").isNotNull() & ~F.col("region_code").rlike(code_pattern)
    rules = {
        "weather": {
            "code_pattern": code_bad,
            "date_range": ~F.col("date").between(F.lit("1900-01-01").cast("date"), F.lit("2100-01-01").cast("date")),
        },
        "agriculture": {
            "code_pattern": code_bad,
            "year_range": ~F.col("annee").between(1900, 2100),
        },
        "climate": {"class_domain": not_accepted("drought_class", DROUGHT_CLASSES)},
        "solar": {"score_range": out_of_range("solar_potential_score", 0, 100)},
    }
    return rules[table]


def check_raw_rules(df: DataFrame, table: str, code_pattern: str) -> DataFrame:
    """Rows breaking any DDL check of ``table``, with the names of the broken rules."""
    rules = raw_rules(table, code_pattern)
    broken = F.array_compact(F.array(*[F.when(F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in rules.items()]))
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


def check_days_observed(region_year: DataFrame, minimum: int = DAYS_OBSERVED_MIN) -> DataFrame:
    """Complete years (both coverages >= 0.95) with fewer observed days than ``minimum``."""
    complete = (F.col("water_balance_coverage") >= 0.95) & (F.col("solar_coverage") >= 0.95)
    return region_year.where(complete & (F.col("days_observed") < minimum)).select(
        "region_code", "year", "days_observed", "water_balance_coverage", "solar_coverage"
    )


def orphans(child: DataFrame, parent: DataFrame, key: str = "region_code") -> DataFrame:
    """Keys of ``child`` absent from ``parent`` with their row counts."""
    return check_relationship(child, key, parent).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def missing_from(expected: DataFrame, seen: DataFrame, key: str = "region_code") -> DataFrame:
    """Expected keys never seen in ``seen`` (set difference, LEFT ANTI)."""
    return expected.select(key).distinct().join(seen.select(key).distinct(), key, "left_anti")


# --- the whole suite -----------------------------------------------------------------------


@dataclass
class TableChecks:
    """The declarative tests of one table.

    ``mirrors``: further declared tables that are the same rows under other column names
    (name -> {column here: column there}); their not-null and unique tests are answered
    by this table's.
    """

    name: str
    df: DataFrame
    unique: list[Sequence[str]] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    ranges: list[tuple[str, float | None, float | None]] = field(default_factory=list)
    accepted: list[tuple[str, tuple]] = field(default_factory=list)
    relationships: list[tuple[str, DataFrame, str]] = field(default_factory=list)
    mirrors: dict[str, dict[str, str]] = field(default_factory=dict)

    def row_rules(self) -> list[tuple[str, str, Column]]:
        """The tests that one row decides: (check, column, violated)."""
        rules = [("not_null", c, F.col(c).isNull()) for c in self.not_null]
        rules += [("accepted_range", c, out_of_range(c, lo, hi)) for c, lo, hi in self.ranges]
        rules += [("accepted_values", c, not_accepted(c, vals)) for c, vals in self.accepted]
        return rules

    def columns(self) -> list[str]:
        """All columns that any test reads, in the order of the table."""
        read = {c for keys in self.unique for c in keys} | {c for _, c, _ in self.row_rules()} | {c for c, _, _ in self.relationships}
        return [c for c in self.df.columns if c in read]


REPORT = "check string, table string, column string, violations bigint"


def _mirrored(t: TableChecks, check: str, column: str) -> list[tuple[str, str]]:
    """(table, column) under which a test of ``t`` is reported."""
    out = [(t.name, column)]
    if check in ("not_null", "unique"):
        for name, renamed in t.mirrors.items():
            parts = column.split(",")
            if all(c in renamed for c in parts):
                out.append((name, ",".join(renamed[c] for c in parts)))
    return out


def observe_rules(t: TableChecks) -> tuple[DataFrame, Observation]:
    """The table with its row rules counted by whatever action runs over it (its write)."""
    seen = Observation(f"rules-{uuid.uuid4().hex}")
    metrics = [F.count_if(violated).alias(f"r{i}") for i, (_, _, violated) in enumerate(t.row_rules())]
    return t.df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen


def observed_report(t: TableChecks, seen: Observation) -> list[tuple[str, str, str, int]]:
    """Report rows of the row rules, from the metrics of the action that ran."""
    counts = seen.get
    return [
        (check, table, shown, int(counts[f"r{i}"]))
        for i, (check, column, _) in enumerate(t.row_rules())
        for table, shown in _mirrored(t, check, column)
    ]


def table_report(t: TableChecks, row_rules: bool = True) -> DataFrame:
    """All tests of one table from ONE aggregation over its rows, or, without the row
    rules (counted elsewhere), the tests on keys alone, reading only key columns.

    Rows are grouped by the table's (first) unique key, counting each row-level rule
    per group (partial aggregation first, so hot keys are pre-counted in every map
    task). Uniqueness is the number of groups holding more than one row; a
    relationship on a key column is checked on the grouped rows (far fewer than the
    rows) against the parent keys, weighted by group size.
    """
    keys = list(t.unique[0]) if t.unique else []
    rules = t.row_rules() if row_rules else []
    grouped = t.df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(pred).alias(f"_r{i}") for i, (_, _, pred) in enumerate(rules)]
    )
    folded_rel = [(i, col, parent, pk) for i, (col, parent, pk) in enumerate(t.relationships) if col in keys]
    for i, col, parent, pk in folded_rel:
        hits = parent.select(F.col(pk).alias(f"_pk{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
        grouped = join_bounded(grouped, hits, F.col(col) == F.col(f"_pk{i}"), "left", DIM_MAX_ROWS)
    totals = [F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(rules))]
    tests = [(check, col, f"_r{i}") for i, (check, col, _) in enumerate(rules)]
    if keys:
        totals.append(F.count_if(F.col("_n") > 1).alias("_unique"))
        tests.append(("unique", ",".join(keys), "_unique"))
    for i, col, _, _ in folded_rel:
        totals.append(F.sum(F.when(F.col(col).isNotNull() & F.col(f"_hit{i}").isNull(), F.col("_n"))).alias(f"_rel{i}"))
        tests.append(("relationships", col, f"_rel{i}"))
    report_rows = [
        F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(shown).alias("column"), F.coalesce(F.col(count), F.lit(0)).cast("bigint").alias("violations"))
        for check, col, count in tests for table, shown in _mirrored(t, check, col)
    ]
    out = grouped.agg(*totals).select(F.inline(F.array(*report_rows))) if report_rows else t.df.sparkSession.createDataFrame([], REPORT)
    # tests the single pass cannot fold: further unique keys, relationships on non-key columns
    for extra in t.unique[1:]:
        dup = check_unique(t.df, extra).agg(F.count(F.lit(1)).alias("violations"))
        out = out.unionByName(dup.select(F.lit("unique").alias("check"), F.lit(t.name).alias("table"),
                                         F.lit(",".join(extra)).alias("column"), F.col("violations").cast("bigint")))
    for i, (col, parent, pk) in enumerate(t.relationships):
        if col in keys:
            continue
        bad = check_relationship(t.df, col, parent, pk).agg(F.count(F.lit(1)).alias("violations"))
        out = out.unionByName(bad.select(F.lit("relationships").alias("check"), F.lit(t.name).alias("table"),
                                         F.lit(col).alias("column"), F.col("violations").cast("bigint")))
    return out


def run_checks(tables: Sequence[TableChecks], row_rules: bool = True) -> DataFrame:
    """One report row per test: (check, table, column, violations), one aggregation
    pass per table (see ``table_report``)."""
    return reduce(DataFrame.unionByName, [table_report(t, row_rules) for t in tables])


class QualityError(ValueError):
    """Some declared test of a table is violated."""


def assert_clean(report: DataFrame) -> None:
    """Raise with the violated tests of a report (one row per test)."""
    bad = report.where("violations > 0").orderBy("table", "check", "column").collect()
    if bad:
        raise QualityError("violated: " + "; ".join(f"{r['table']}.{r['column']} {r['check']} ({r['violations']})" for r in bad))


def check_dim(dim: DataFrame, expected_rows: int | None = None, lat=(20.0, 36.0), lon=(-18.0, -1.0)) -> DataFrame:
    """Region dimension integrity: unique codes, no blank text, coordinates inside
    the country box, altitude >= 0, and (optionally) the expected row count.
    Returns (rule, detail) violation rows."""
    text = ("region_code", "region_name", "capital")
    blank = F.lit(False)
    for c in text:
        blank = blank | F.col(c).isNull() | (F.trim(F.col(c)) == "")
    row_rules = {
        "blank_text": blank,
        "latitude_box": ~F.col("latitude").between(*lat),
        "longitude_box": ~F.col("longitude").between(*lon),
        "altitude_negative": F.col("altitude_m") < 0,
    }
    parts = [
        dim.where(F.coalesce(pred, F.lit(True))).select(F.lit(name).alias("rule"), F.col("region_code").alias("detail"))
        for name, pred in row_rules.items()
    ]
    dups = check_unique(dim, ["region_code"]).select(F.lit("duplicate_code").alias("rule"), F.col("region_code").alias("detail"))
    out = dups
    for p in parts:
        out = out.unionByName(p)
    if expected_rows is not None:
        count = dim.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != expected_rows)
        out = out.unionByName(count.select(F.lit("row_count").alias("rule"), F.col("n").cast("string").alias("detail")))
    return out
