"""Helpers shared by the operators: table access, stored intermediate tables, checked joins."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.session import checkpoint_dir

REPO_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The word pattern of every contract: maximal runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# A side is broadcast only below this many rows, counted on a stored table.
BROADCAST_MAX_ROWS = 50_000

# Bare numbers (one long column) are broadcast below this many: about 14 MB.
BROADCAST_MAX_IDS = 1 << 18


# Rows of a batch of whole texts between Spark and Python: some MB of them, in both memories.
BATCH_ROWS = 2048


# Python workers give freed memory back instead of keeping it in pools of their own.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_TRIM_THRESHOLD_": "131072"}


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package even if only the driver's path names it, and
    bound the Arrow batches of texts (a smaller bound of the session is kept)."""
    environment = spark.sparkContext.environment
    environment.setdefault("PYTHONPATH", REPO_ROOT)
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the cluster's shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads these files instead of recomputing.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a stored ``small``; broadcast only if it is counted to be small, else shuffle."""
    most = BROADCAST_MAX_IDS if [kind for _, kind in small.dtypes] == ["bigint"] else BROADCAST_MAX_ROWS
    if small.limit(most + 1).count() <= most:
        small = F.broadcast(small)
    return big.join(small, on, how)


def most_frequent(counted: DataFrame, limit: int, n: str = "n") -> DataFrame:
    """The rows of a stored ``counted`` with the greatest counts: at most ``limit`` rows.

    The counts are dealt into logarithmic classes (16 to a doubling), whose sizes, a few
    hundred rows, tell which classes from the top fit together. No row is sorted, and no
    task or the driver sees more than is kept. Class by class, so some fewer than
    ``limit`` may come: for tables that only save time.
    """
    level = F.floor(16 * F.log2(F.col(n).cast("double"))).cast("int")
    sizes = counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, cut = 0, None
    for row in sizes:
        total += row["count"]
        if total > limit:
            break
        cut = row["level"]
    return counted.filter(F.lit(False) if cut is None else level >= cut)


def sampled(rows: DataFrame, by: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of a stored table, chosen by a 64-bit hash column, the same on
    every run: a share of the hash range that holds about twice as many is cut into 128
    classes, and classes are taken in order while they fit (equal hashes go together)."""
    n = rows.count()
    if n <= limit:
        return rows
    spot = F.shiftrightunsigned(by, 11).cast("double") / float(1 << 53)
    share = min(1.0, 2.0 * limit / n)
    inside = rows.filter(spot < share)
    level = F.floor(spot / share * 128).cast("int")
    total, taken = 0, []
    for row in inside.groupBy(level.alias("level")).count().orderBy("level").collect():
        if total + row["count"] <= limit:
            total += row["count"]
            taken.append(row["level"])
    return inside.filter(level.isin(taken))


def code_point_rank(column: Column) -> Column:
    """A key whose order is code point order, null last (UTF-8 bytes order like code points)."""
    return F.struct(column.isNull(), column.cast("binary"))
