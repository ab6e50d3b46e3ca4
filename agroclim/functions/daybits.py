"""Days of a year as bits: which of its days were observed, in six LONG words.

Day d of the year (0 for 1 January) is bit ``d % 61`` of word ``d / 61``: six words hold
366 days and never touch the sign bit. Words combine by OR, so a map is a fixed-width hash
aggregate (``bit_or`` per word, combined in every map task before the shuffle); counts,
first and last days and gaps are bit operations on a few bytes per region and year.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 61
WORDS = 6


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _shift(word: Column, by: Column) -> Column:
    return F.call_function("shiftleft", word, by)


def _ones(n: Column) -> Column:
    """The lowest n bits set (0 <= n <= 61)."""
    return _shift(_long(1), n) - 1


def _and(left: Column, right: Column) -> Column:
    return left.bitwiseAND(right)


def collect_days(date: Column) -> Column:
    """Aggregate: the bits of all dates, which lie in one year (array of six words)."""
    day = F.dayofyear(date) - 1
    bit = _shift(_long(1), F.pmod(day, F.lit(BITS)))
    word = F.floor(day / BITS)
    return F.array(*[F.coalesce(F.bit_or(F.when(word == k, bit)), _long(0)) for k in range(WORDS)])


def no_days() -> Column:
    return F.array(*[_long(0)] * WORDS)


def days_between(first: Column, last: Column) -> Column:
    """The bits of the days first..last (numbers from 0, both included)."""

    def edge(day: Column, k: int) -> Column:
        return F.least(F.greatest(day - BITS * k, F.lit(0)), F.lit(BITS)).cast("int")

    return F.array(*[_and(_ones(edge(last + 1, k)), F.bitwise_not(_ones(edge(first, k)))) for k in range(WORDS)])


def only_in(left: Column, right: Column) -> Column:
    """The days of ``left`` that are not in ``right``."""
    return F.zip_with(left, right, lambda a, b: _and(a, F.bitwise_not(b)))


def shared(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, _and)


def count_days(days: Column) -> Column:
    return F.aggregate(days, _long(0), lambda n, w: n + F.bit_count(w))


def _positions(days: Column, of_word) -> Column:
    return F.transform(days, lambda w, k: F.when(w != 0, k * BITS + of_word(w)))


def first_day(days: Column) -> Column:
    """The number of the first day (null if there is none)."""
    return F.array_min(_positions(days, lambda w: F.bit_count(_and(w, -w) - 1)))


def last_day(days: Column) -> Column:
    """The number of the last day (null if there is none)."""

    def highest(w: Column) -> Column:
        for by in (1, 2, 4, 8, 16, 32):
            w = w.bitwiseOR(F.shiftright(w, by))
        return F.bit_count(w) - 1

    return F.array_max(_positions(days, highest))


def list_days(days: Column) -> Column:
    """The numbers of the days, ascending."""
    return F.filter(
        F.sequence(F.lit(0), F.lit(WORDS * BITS - 1)),
        lambda d: F.bit_get(F.get(days, F.floor(d / BITS).cast("int")), F.pmod(d, F.lit(BITS))) == 1,
    )


def date_of(year: Column, day: Column) -> Column:
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day.cast("int"))


def day_of(date: Column, year: Column) -> Column:
    """The number of ``date`` in ``year``, or of the year's nearest end."""
    start = F.make_date(year, F.lit(1), F.lit(1))
    return F.least(F.greatest(F.date_diff(date, start), F.lit(0)), F.date_diff(F.make_date(year, F.lit(12), F.lit(31)), start))
