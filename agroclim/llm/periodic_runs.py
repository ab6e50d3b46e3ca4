"""Periodic runs of words by multi-scale minimizers, and texts with runs collapsed.

A run is a longest stretch of words with smallest period q (words q apart are the same)
of at least ``max(6, 4 * q)`` words. All texts of a chunk lie in one array of word
numbers with a number of its own after each text, so that no match crosses texts.

* Periods up to ``SHORT`` are found by direct scans: words q apart are compared.
* For periods in (K/2, K], K a power of two, every position has the fingerprint of the K
  words from there (doubled from scale to scale). Inside a run with such a period equal
  fingerprints are a multiple of the period apart, as K words span a period. Every window
  of K/2 positions gives its minima; a run holds a window and the same window one period
  later, so the minima of both are there with equal fingerprints, next to each other
  among the equal ones. These pairs are the seeds; their distance is the period tried.
* A seed is extended to both sides by comparing words, so fingerprints decide nothing;
  seeds inside a stretch already extended for the same period are passed over.

A stretch found for several periods is a run of the smallest. The work is about
``n log n`` in the words of a text. Everything happens where the text lies.

Defined cases: a null or empty text has no words and no runs and collapses to the empty
text; repeated rows are treated alike; an empty table gives none; texts of any length
are read whole. Extra columns pass through (clashing names give way).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroclim.llm import textarrow
from agroclim.llm.common import WORD, prepare, table

LEAST = 6  # words of a run, and
PERIODS = 4  # times its period
SHORT = 8  # periods up to here are scanned directly
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _streaks(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the streaks of True of at least ``least``."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    begin, end = edges[::2], edges[1::2]
    long = end - begin >= least
    return begin[long], end[long]


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of ``width`` values, by doubling."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = pick(out[:-step], out[step:])
        covered += step
    return out


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The positions that are a minimum of some window of ``width`` values (all of equal ones)."""
    low = _extreme(values, width, np.minimum)
    most = np.iinfo(values.dtype).min
    padded = np.concatenate([np.full(width - 1, most, values.dtype), low, np.full(width - 1, most, values.dtype)])
    return np.flatnonzero(_extreme(padded, width, np.maximum) == values)


def _reach(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``at`` whose words equal those ``lag`` further on."""
    end, step = at, 64
    limit = len(words) - lag
    while end < limit:
        stop = min(end + step, limit)
        apart = np.flatnonzero(words[end:stop] != words[end + lag:stop + lag])
        if len(apart):
            end += int(apart[0])
            break
        end, step = stop, step * 2
    begin, step = at, 64
    while begin > 0:
        stop = max(begin - step, 0)
        apart = np.flatnonzero(words[stop:begin] != words[stop + lag:begin + lag])
        if len(apart):
            begin = stop + int(apart[-1]) + 1
            break
        begin, step = stop, step * 2
    return begin, end


def find(words: np.ndarray) -> np.ndarray:
    """The runs of an array of word numbers as rows (start, length, period), in this order."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    n = len(words)
    for lag in range(1, min(SHORT, n // PERIODS) + 1):
        begin, end = _streaks(words[:-lag] == words[lag:], max(LEAST, PERIODS * lag) - lag)
        found.append((begin, end - begin + lag, np.full(len(begin), lag, np.int64)))
    prints, span = textarrow.mix64(words), 1
    scale = 2 * SHORT
    while n >= PERIODS * (scale // 2 + 1):
        while span < scale:  # fingerprints of twice as many words
            with np.errstate(over="ignore"):
                prints = textarrow.mix64(prints[:-span] * np.uint64(0x9E3779B97F4A7C15) + prints[span:])
            span *= 2
        width = scale // 2
        if len(prints) > width:
            at = _minima(prints, width)
            order = at[np.argsort(prints[at], kind="stable")]
            lag = np.diff(order)
            seed = (prints[order[1:]] == prints[order[:-1]]) & (lag > scale // 2) & (lag <= scale)
            found.append(_extended(words, order[:-1][seed], lag[seed]))
        scale *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    start, length, period = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
    order = np.lexsort((period, length, start))  # of one stretch the smallest period is first
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    rows = np.stack([start, length, period], axis=1)[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _extended(words: np.ndarray, seeds: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out = []
    order = np.lexsort((seeds, lags))
    last_lag = last_end = -1
    for at, lag in zip(seeds[order].tolist(), lags[order].tolist(), strict=True):
        if lag == last_lag and at < last_end:
            continue
        begin, end = _reach(words, at, lag)
        last_lag, last_end = lag, end
        if end - begin + lag >= max(LEAST, PERIODS * lag):
            out.append((begin, end - begin + lag, lag))
    rows = np.array(out, dtype=np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def _collapse(at: int):
    """Batches with two columns more: the runs, and the text without their repeats."""

    def run(batches):
        for batch in batches:
            for texts in textarrow.chunks(batch.column(at)):
                values, codes, first = textarrow.word_codes(texts, lower=False)
                texts_n = len(first) - 1
                # after each text a number that no word has
                joined = np.insert(codes, first[1:], -1 - np.arange(texts_n))
                begins = first[:-1] + np.arange(texts_n)
                rows = find(joined)
                text = np.searchsorted(begins, rows[:, 0], side="right") - 1
                gone = np.zeros(len(joined) + 1, dtype=np.int64)
                np.add.at(gone, rows[:, 0] + rows[:, 2], 1)
                np.add.at(gone, rows[:, 0] + rows[:, 1], -1)
                kept = (np.cumsum(gone[:-1]) == 0) & (joined >= 0)
                names = (rows[:, 0] - begins[text], rows[:, 1], rows[:, 2])
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in names], ["start", "length", "period"])
                offsets = np.searchsorted(text, np.arange(texts_n + 1))
                counts = np.add.reduceat(np.append(kept, False), begins) if texts_n else np.zeros(0, np.int64)
                columns = [c.slice(texts.first, texts_n) for c in batch.columns]
                columns += [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs), _joined(values, joined[kept], counts)]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    return run


def _joined(values: pa.Array, codes: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The words of each text with one blank between them."""
    blank = pa.scalar(b" ", pa.large_binary())
    words = pc.binary_join_element_wise(values.cast(pa.large_binary()), pa.scalar(b"", pa.large_binary()), blank).take(pa.array(codes))
    buffers = words.buffers()
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    ends = np.frombuffer(buffers[1], dtype=np.int64)[np.concatenate([[0], np.cumsum(counts)])]
    filled = ends[1:] > ends[:-1]
    data = np.delete(data[:ends[-1]], ends[1:][filled] - 1)  # the blank after a text's last word
    offsets = ends - np.concatenate([[0], np.cumsum(filled)])
    return pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with runs (array of start, length, period by start, then period) and collapsed.

    ``collapsed`` holds the words of the text, joined by one blank, without those that
    repeat an earlier one inside a run (each run keeps its first period).
    """
    prepare(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c not in ("runs", "collapsed")])
    fields = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    fields += [T.StructField(f"c{len(fields)}", T._parse_datatype_string(RUN)), T.StructField(f"c{len(fields) + 1}", T.StringType())]
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    out = plain.mapInArrow(_collapse(docs.columns.index("text")), T.StructType(fields))
    return out.toDF(*docs.columns, "runs", "collapsed")


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` with the contract's periodic tails: words from a on repeat with a period p.

    A tenth of the doc_ids (crc32 of the decimal id divisible by 10) is changed; a null
    doc_id is not.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def tail(words: Column) -> Column:
        n = F.size(words).cast("long")
        return _let(F.struct(F.pmod(g, n).alias("a"), n.alias("n")), lambda x: _let(
            F.struct(x["a"].alias("a"), (1 + F.floor((x["n"] - x["a"]) / (3 + F.pmod(g, F.lit(8))))).alias("p")),
            lambda y: F.array_join(F.transform(words, lambda w, i: F.when(i < y["a"], w).otherwise(
                F.get(words, (y["a"] + F.pmod(i - y["a"], y["p"])).cast("int")))), " ")))

    changed = _let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lambda words: F.when(F.size(words) > 0, tail(words)).otherwise(F.lit("")))
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), changed).otherwise(F.col("text")))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    out = collapse_runs(planted(table(spark, sf_dir, "documents", "doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    out = out.withColumns({"longest": longest, "listed": F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")})
    length, period = F.col("longest.length"), -F.col("longest.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
