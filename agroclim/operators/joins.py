"""Join helpers: broadcast only behind a size check, else let Spark shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroclim.session import session_key

# Upper bound on rows we are willing to ship to every executor.
DEFAULT_BROADCAST_MAX_ROWS = 100_000


# Per-session memo of size checks, keyed by the plan's semantic hash: one answer per
# distinct plan. Forgotten when an input table changes (``sources.tables.refresh``) and
# by the writers of this library.
_SIZE_MEMO: dict[tuple[str, int, int], bool] = {}


def _session_key(df: DataFrame) -> str:
    return session_key(df.sparkSession)


def forget_sizes() -> None:
    _SIZE_MEMO.clear()


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` holds at most ``max_rows`` rows.

    A plain count: partial sums per task, no column read, for a dimension mostly the
    files' footers. Only dimensions and key maps are asked, never a plan over facts.
    Answers are memoised per session and plan until an input table changes.
    """
    key = (_session_key(df), df.semanticHash(), max_rows)
    if key not in _SIZE_MEMO:
        _SIZE_MEMO[key] = df.count() <= max_rows
    return _SIZE_MEMO[key]


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str] | Column,
    how: str = "inner",
    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> DataFrame:
    """Join with ``small`` broadcast when it is proven small, else a plain
    (AQE-managed) shuffle join. ``small`` must be the right side."""
    if how in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti") and has_at_most(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)
