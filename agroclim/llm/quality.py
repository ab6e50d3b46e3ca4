"""Quality rules with risk-controlled thresholds.

Every whole text gives the base figures and a few ratios. A rule rejects a document
whose ratio reaches a cutoff; the cutoff is chosen per stratum (language) on labelled
documents: going from the mildest cutoff down a fixed grid, one is admissible as long
as the exact upper binomial bound (Clopper-Pearson) of its false rejections among good
documents stays within ``ALPHA``. Testing in that fixed order needs no correction
along the grid; the confidence is split evenly (Bonferroni) over all pairs of stratum
and rule. Among admissible cutoffs the one with the best gain (bad documents caught
less ``PRICE`` times good ones lost) is taken, the mildest of equals; a stratum with
too few labels gets none and rejects nothing by that rule.

Labels meet figures in one shuffle of narrow rows; the histograms per stratum, rule
and bin are partial sums, so a hot language is reduced before its shuffle.

Defined cases: a null or empty text has no words and fails the base rule; a null
language is a stratum of its own; several labels of one doc_id count as bad if any
is bad; null qualities are no label; a null doc_id has no label; repeated rows are
judged alike; an empty table gives none. Extra columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroclim.llm import textarrow
from agroclim.llm.common import join_checked, prepare, stored, table

ALPHA = 0.01        # false rejections among a stratum's good documents, per rule
CONFIDENCE = 0.95   # that all bounds hold together
PRICE = 10          # bad documents that must be caught for a good one lost
BINS = 100          # cutoffs tried per rule
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Ratios between 0 and 1; larger is worse.
RULES = ("symbol_words", "dup_lines", "repeated", "same_next", "lone_bars", "long_words", "few_short")



def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive positions ``first``."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def figures(texts: textarrow.Texts) -> dict[str, np.ndarray]:
    """The base figures (long) and rule ratios (double) of some texts."""
    n = len(texts)
    values, codes, first = textarrow.words(texts, lower=False)
    n_words = np.diff(first)
    length = np.fromiter((len(w) if w.isascii() else len(w.decode("utf-8", "replace")) for w in values), np.int64, len(values))
    signs = np.fromiter((w.count(b"#") + w.count(b"*") + w.count(b"$") + w.count(b"%") + w.count(b"&") + w.count(b"|") + w.count(b"<") + w.count(b">") for w in values), np.int64, len(values))
    bars = np.fromiter((w == b"|" for w in values), bool, len(values))
    word_chars, n_symbols = _sums(length[codes], first), _sums(signs[codes], first)
    owner = np.repeat(np.arange(n), n_words)

    # words in windows that occur twice or more in the same text
    hashes = textarrow.window_hashes(textarrow.hash64(values)[codes], WINDOW)
    inside = owner[:len(hashes)] == owner[WINDOW - 1:] if len(hashes) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    keys = textarrow.mix64(hashes[at] + textarrow.mix64(owner[at].astype(np.uint64) + np.uint64(1)))
    _, which, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = at[times[which] > 1]
    cover = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    n_repeat = _sums(np.cumsum(cover)[:-1] > 0, first)

    # lines with a word, equal to an earlier line of the text
    line_values, line_codes, line_first = textarrow.lines(texts)
    wordy, same = np.zeros(len(line_values) + 1, bool), np.zeros(len(line_values) + 1, np.int64)
    seen: dict[bytes, int] = {}
    for k, line in enumerate(line_values.to_pylist()):
        bare = line[:-1] if line.endswith(b"\n") else line
        wordy[k] = bool(bare.strip(b" \t\n\x0b\x0c\r"))
        same[k] = seen.setdefault(bare, k)
    line_owner = np.repeat(np.arange(n), np.diff(line_first))
    use = wordy[line_codes]
    pair = line_owner[use] * (len(line_values) + 1) + same[line_codes[use]]
    n_lines = np.bincount(line_owner[use], minlength=n)
    n_dup = n_lines - np.bincount(np.unique(pair) // (len(line_values) + 1), minlength=n)

    next_same = np.zeros(len(codes), bool)
    next_same[1:] = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    count = np.maximum(n_words, 1)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "symbol_words": np.minimum(_sums((signs[codes] > 0) & ~bars[codes], first) / count, 1.0),
        "dup_lines": n_dup / np.maximum(n_lines, 1),
        "repeated": n_repeat / count,
        "same_next": _sums(next_same, first) / count,
        "lone_bars": _sums(bars[codes], first) / count,
        "long_words": np.minimum(word_chars / count / 20.0, 1.0),
        "few_short": 1.0 - _sums(length[codes] <= 3, first) / count,
    }


def _measure(at: int, passed: list[int]):
    def run(batches):
        for batch in batches:
            parts = [figures(texts) for texts in textarrow.chunks(batch.column(at))]
            if parts:
                made = [pa.array(np.concatenate([p[name] for p in parts]), pa.int64() if name in BASE else pa.float64()) for name in (*BASE, *RULES)]
                names = [f"c{k}" for k in passed] + [*BASE, *RULES]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in passed), *made], names=names)

    return run


def measured(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``docs`` with columns c0, c1, ... in place of its own names, then the figures."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")
    passed = [k for k in range(len(docs.columns)) if with_text or k != at]
    fields = [T.StructField(f"c{k}", docs.schema.fields[k].dataType) for k in passed]
    fields += [T.StructField(name, T.LongType()) for name in BASE] + [T.StructField(name, T.DoubleType()) for name in RULES]
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))]).mapInArrow(_measure(at, passed), T.StructType(fields))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def upper_bound(rejected: int, n: int, risk: float) -> float:
    """Exact upper bound of a binomial rate: the p at which so few have probability ``risk``."""
    if n == 0 or rejected >= n:
        return 1.0
    factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    k = np.arange(rejected + 1)
    ways = factorial[n] - factorial[k] - factorial[n - k]
    low, high = rejected / n, 1.0
    for _ in range(50):
        p = (low + high) / 2
        terms = ways + k * math.log(p) + (n - k) * math.log1p(-p) if p < 1 else np.array([-np.inf])
        top = terms.max()
        if top + math.log(np.exp(terms - top).sum()) > math.log(risk):
            low = p
        else:
            high = p
    return high


def choose(good: np.ndarray, bad: np.ndarray, risk: float, alpha: float = ALPHA, price: float = PRICE) -> int | None:
    """The lowest bin that a rule rejects, by histograms of good and bad documents per bin."""
    n, best, gain = int(good.sum()), None, 0.0
    lost_at = np.cumsum(good[::-1])[::-1]
    caught_at = np.cumsum(bad[::-1])[::-1]
    for cut in range(len(good) - 1, 0, -1):
        lost, caught = int(lost_at[cut]), int(caught_at[cut])
        if lost + caught == 0:
            continue
        if upper_bound(lost, n, risk) > alpha:
            break
        if caught - price * lost > gain:
            best, gain = cut, caught - price * lost
    return best


def _cutoff(risk: float):
    def run(rows):
        import pandas as pd

        good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
        good[rows["bin"]], bad[rows["bin"]] = rows["good"], rows["bad"]
        cut = choose(good, bad, risk)
        return pd.DataFrame({"stratum": rows["stratum"].iloc[:1], "rule": rows["rule"].iloc[:1], "cutoff": [np.nan if cut is None else cut / BINS]})

    return run


def _bin(name: str):
    return F.floor(F.col(name) * BINS).cast("int")


def thresholds(labelled: DataFrame) -> DataFrame:
    """(stratum, one column per rule with its cutoff or null) from rows (stratum, quality, ratios)."""
    long = labelled.select("stratum", "quality", F.posexplode(F.array(*[_bin(r) for r in RULES])).alias("rule", "bin"))
    counted = stored(long.groupBy("stratum", "rule", "bin").agg(
        F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad")))
    tests = counted.select("stratum", "rule").distinct().count()
    risk = (1 - CONFIDENCE) / max(1, tests)
    cuts = counted.groupBy("stratum", "rule").applyInPandas(_cutoff(risk), "stratum string, rule int, cutoff double").filter("not isnan(cutoff)")
    return stored(cuts.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == k, F.col("cutoff"))).alias(f"cut_{r}") for k, r in enumerate(RULES)]))


def judged(rows: DataFrame, lang: str, doc_id: str, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """Measured rows with base_failed and kept; ``learn_from`` are the rows that labels meet."""
    stratum = F.coalesce(F.concat(F.lit("="), F.col(lang).cast("string")), F.lit("null"))
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
    held = (learn_from if learn_from is not None else rows).filter(~base_failed())
    held = held.select(stratum.alias("stratum"), F.col(doc_id).cast("long").alias("label_id"), *RULES).join(known, "label_id").select("stratum", "quality", *RULES)
    cuts = thresholds(held)
    out = join_checked(rows.withColumn("stratum", stratum), cuts, ["stratum"])
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(_bin(r) >= F.round(F.col(f"cut_{r}") * BINS), F.lit(False))
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected)


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with their own columns.

    The figures are computed twice rather than stored beside the texts: first without
    the texts, to meet the labels in narrow rows, then to judge. No text is shuffled.
    """
    names = docs.columns
    doc, lang = (f"c{names.index(x)}" for x in ("doc_id", "lang"))
    narrow = measured(docs.select("doc_id", "lang", "text"), with_text=False).toDF(doc, lang, *BASE, *RULES)
    out = judged(measured(docs), lang, doc, labels, learn_from=narrow)
    return out.filter("kept").select(*[f"c{k}" for k in range(len(names))]).toDF(*names)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "text")
    rows = stored(measured(docs).drop("c2"))
    out = judged(rows, "c1", "c0", table(spark, sf_dir, "labels", "doc_id", "quality"))
    return out.select(F.col("c0").alias("doc_id"), *BASE, "base_failed", "kept", *RULES)
