"""Phrase collocation mining by Rabin-Karp fingerprints, per language, exact.

Texts are lower-cased (A-Z), cut at punctuation and line ends into pieces and these into
words. The fingerprint of the words i to j is taken from prefix polynomials over 64-bit
word hashes (numpy, modulo 2**64), the language added; a second polynomial gives a check
value of 24 bits.

1. One pass per phrase length counts fingerprints: grouped in each chunk, then by Spark's
   shuffle, each with the sum of its check values and a pointer to a text it occurs in
   (32 bits of the text's hash, the least of all its texts, so that few texts are pointed at).
   A phrase as frequent as asked has only parts that are, so a longer phrase is counted,
   and its fingerprint taken, only where both its parts of one word less are frequent.
   What is frequent stands in a filter of bits sent to the workers; it has no false
   negatives, is bounded by ``FILTER_BITS``, and only saves work.
2. One pass takes the text of the frequent phrases at their pointers (again through
   filters, one for the texts pointed at, one for the phrases, then by an exact join), so
   that only frequent phrases are ever materialised, and counts all words of each language.
3. A fingerprint holds if its sum of check values is that of its text times the count.
   Where it does not, phrases have collided; they are counted anew as text.
4. Candidates meet the counts of their two parts by text. Scores are exact decimals.

Hot phrases and languages are added up in each chunk and task before the shuffle.

Defined cases: a null or empty text has no words; a null lang is ``und``; repeated rows
count each time; an empty table gives no rows; texts are read whole; of extra columns
nothing is read. Phrases equal in score and count come in UTF-8 byte order.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroclim.llm import textarrow
from agroclim.llm.common import prepare, stored, table

LONGEST = 5
FREQUENT = 100
TOP = 2000
CHUNK = 4 << 20
FILTER_BITS = 1 << 28  # most bits of a filter: 32 MB
FEWEST_BITS = 1 << 20

_WORD, _BLANK, _STOP = 0, 1, 2
_KIND = bytes(_STOP if x in b".,;:!?\n\v\f\r" else _BLANK if x in b" \t" else _WORD for x in range(256))
_OUTSIDE = bytes(x for x in range(256) if _KIND[x] != _WORD)
_LOWER = bytes(range(256)).lower()  # of bytes: A-Z alone

# Odd bases of the two polynomials, and their inverses modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(base: int, inverse: bool, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, or of its inverse; kept in the worker."""
    known = _POWERS.get((base, inverse))
    if known is None or len(known) < n:
        step = pow(base, -1, 1 << 64) if inverse else base
        factors = np.full(max(n, 1 << 16), step, dtype=np.uint64)
        factors[0] = 1
        with np.errstate(over="ignore"):
            known = _POWERS[base, inverse] = np.cumprod(factors, dtype=np.uint64)
    return known[:n]


def _runs(texts: textarrow.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts' runs of bytes of one kind begin, and their kinds."""
    kind = np.frombuffer(texts.data.tobytes().translate(_KIND), dtype=np.uint8)
    edge = np.ones(len(kind), dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[texts.offsets[:-1][texts.offsets[:-1] < len(kind)]] = True
    starts = np.flatnonzero(edge)
    return starts, kind[starts]


class Words:
    """The words of some texts, in order: codes into values, and how many follow in the piece."""

    def __init__(self, texts: textarrow.Texts):
        starts, kinds = _runs(texts)
        is_word = kinds == _WORD
        at = starts[is_word]
        data = np.frombuffer(texts.data.tobytes().translate(_LOWER, _OUTSIDE), dtype=np.uint8)  # the words alone
        sizes = np.diff(np.append(starts, len(texts.data)))[is_word]
        encoded = textarrow.pieces(data, np.concatenate([[0], np.cumsum(sizes)])).dictionary_encode()
        self.codes, self.values = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
        self.first = np.searchsorted(at, texts.offsets)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))
        # a number that grows from piece to piece
        piece = np.cumsum(kinds == _STOP)[is_word] + self.text
        ends = np.append(np.flatnonzero(piece[1:] != piece[:-1]) + 1, len(at))
        self.left = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(len(at)) if len(at) else piece
        self._sums = None

    def __len__(self) -> int:
        return len(self.codes)

    def places(self, length: int) -> np.ndarray:
        """Where ``length`` words follow in a piece."""
        return np.flatnonzero(self.left >= length)

    def prints(self, at: np.ndarray, length: int, lang: str) -> np.ndarray:
        """The fingerprints of the ``length`` words from each of these places."""
        return self._polynomial(0, at, length, lang)

    def checks(self, at: np.ndarray, length: int, lang: str) -> np.ndarray:
        """Their check values."""
        return (self._polynomial(1, at, length, lang) >> np.uint64(40)).view(np.int64)

    def fingerprints(self, length: int, lang: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where ``length`` words follow in a piece, their fingerprints and check values."""
        at = self.places(length)
        return at, self.prints(at, length, lang), self.checks(at, length, lang)

    def _polynomial(self, seed: int, at: np.ndarray, length: int, lang: str) -> np.ndarray:
        if self._sums is None:
            listed = self.values.to_numpy(zero_copy_only=False).tolist()
            # the halves of one 128-bit hash, one for each polynomial
            halves = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, listed)), dtype=">u8").astype(np.uint64).reshape(-1, 2)
            self._sums = []
            for half, base in enumerate(_BASES):
                sums = np.zeros(len(self) + 1, dtype=np.uint64)
                with np.errstate(over="ignore"):
                    np.cumsum(halves[:, half][self.codes] * _powers(base, False, len(self)), out=sums[1:])
                self._sums.append(sums)
        sums, back = self._sums[seed], _powers(_BASES[seed], True, len(self))
        own = np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), seed + 2))
        with np.errstate(over="ignore"):
            if 4 * len(at) < len(self):
                return (sums[at + length] - sums[at]) * back[at] + own
            out = sums[length:] - sums[:-length]
            out *= back[:len(out)]
            out += own
            return out[at]

    def phrases(self, at: np.ndarray, length: int) -> list[str]:
        """The words from each of these places, joined by one blank."""
        codes = self.codes[at[:, None] + np.arange(length)].ravel()
        words = self.values.take(pa.array(codes)).cast(pa.string()).to_pylist()
        return [" ".join(words[k:k + length]) for k in range(0, len(words), length)]


def _by_language(batches):
    """Chunks of texts of one language: the language, text hashes and words."""
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        for k, lang in enumerate(coded.dictionary.to_pylist()):
            rows = batch.filter(pc.equal(coded.indices, k)) if len(coded.dictionary) > 1 else batch
            hashes = rows.column("text_hash").to_numpy(zero_copy_only=False)
            for texts in textarrow.chunks(rows.column("text"), CHUNK):
                yield lang, hashes[texts.first:texts.first + len(texts)], Words(texts)


class Filter:
    """A fixed number of bits, two of them set for each 64-bit key."""

    def __init__(self, shared, bits: int):
        self.shared, self.shift = shared, 65 - bits.bit_length()

    def holds(self, keys: np.ndarray) -> np.ndarray:
        bits = np.frombuffer(self.shared.value, dtype=np.uint8)

        def one(place):
            return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1

        shift = np.uint64(self.shift)
        return (one(keys >> shift) & one((keys << np.uint64(29)) >> shift)).astype(bool)


def _filter(keys: DataFrame) -> Filter:
    """The filter of the 64-bit numbers in the column key; ``FILTER_BITS`` at most reach the driver."""
    spark, n = keys.sparkSession, keys.count()
    bits = min(FILTER_BITS, max(FEWEST_BITS, 1 << (64 * n).bit_length()))
    shift, block = 65 - bits.bit_length(), 1 << 15
    places = keys.select(F.explode(F.array(F.shiftrightunsigned("key", shift), F.shiftrightunsigned(F.shiftleft("key", 29), shift))).alias("place"))
    rows = places.groupBy(F.floor(F.col("place") / block).alias("block")).agg(F.bitmap_construct_agg((F.col("place") % block)).alias("bits")).collect()
    whole = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows:
        whole[row["block"] * block // 8:(row["block"] + 1) * block // 8] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)[:block // 8]
    return Filter(spark.sparkContext.broadcast(whole.tobytes()), bits)


def _pointers(hashes: np.ndarray, words: Words, at: np.ndarray) -> np.ndarray:
    """32 bits of the hash of the text that each of these words is in."""
    return (hashes >> 32).astype(np.int32)[words.text[at]]


def _masked(prints: np.ndarray, kept: int) -> np.ndarray:
    return prints if kept == 64 else prints >> np.uint64(64 - kept) << np.uint64(64 - kept)


def _count(length: int, shorter: Filter | None, kept: int):
    def run(batches):
        for lang, hashes, words in _by_language(batches):
            at = words.places(length)
            if shorter is not None and len(at):
                parts_at = words.places(length - 1)
                known = np.zeros(len(words) + 1, dtype=bool)
                known[parts_at] = shorter.holds(_masked(words.prints(parts_at, length - 1, lang), kept))
                at = at[known[at] & known[at + 1]]
            if not len(at):
                continue
            prints = _masked(words.prints(at, length, lang), kept)
            order = np.argsort(prints)
            prints, at = prints[order], at[order]
            first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
            checks, pointers = words.checks(at, length, lang), _pointers(hashes, words, at)
            columns = [prints[first].view(np.int64), np.diff(np.append(first, len(at))), np.add.reduceat(checks, first), np.minimum.reduceat(pointers, first)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["print", "n", "checks", "pointer"])

    return run


def _frequent(docs: DataFrame, length: int, shorter: Filter | None, least: int, kept: int) -> DataFrame:
    counted = docs.mapInArrow(_count(length, shorter, kept), "print long, n long, checks long, pointer int")
    summed = counted.groupBy("print").agg(F.sum("n").alias("n"), F.sum("checks").alias("checks"), F.min("pointer").alias("pointer"))
    return summed.filter(F.col("n") >= least)


_SPELLED = "lang string, length int, print long, check long, pointer int, phrase string, n long"


def _word_total(column: pa.Array) -> int:
    return sum(int(np.count_nonzero(_runs(texts)[1] == _WORD)) for texts in textarrow.chunks(column, CHUNK))


def _totals(batch: pa.RecordBatch) -> pa.Table:
    """The number of all words of each language, as rows of length 0."""
    langs = batch.column("lang")
    n = {lang: _word_total(batch.filter(pc.equal(langs, lang)).column("text")) for lang in langs.unique().to_pylist()}
    zeros = np.zeros(len(n), dtype=np.int64)
    return pa.table([list(n), zeros.astype(np.int32), zeros, zeros, zeros.astype(np.int32), [""] * len(n), list(n.values())], schema=_SPELLED_ARROW)


_SPELLED_ARROW = pa.schema([("lang", pa.string()), ("length", pa.int32()), ("print", pa.int64()), ("check", pa.int64()), ("pointer", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


def _spelled(wanted: Filter, spots: Filter | None, longest: int, kept: int):
    """Phrases as text: one of each print in a chunk where a pointer may point, or all of the prints, counted.

    With ``spots``, the filter of the pointers alone, other texts are not cut into words,
    and rows of length 0 have the number of all words.
    """

    def run(batches):
        for batch in batches:
            if spots is not None:
                yield from _totals(batch).to_batches()
                batch = batch.filter(pa.array(spots.holds(batch.column("spot").to_numpy(zero_copy_only=False).view(np.uint64))))
            for lang, hashes, words in _by_language([batch]):
                for length in range(1, longest + 1):
                    at, prints, checks = words.fingerprints(length, lang)
                    prints, pointers = _masked(prints, kept), _pointers(hashes, words, at)
                    chosen = np.flatnonzero(wanted.holds(prints if spots is None else _pointer_key(prints, pointers)))
                    if spots is not None:
                        _, once = np.unique(np.stack([prints[chosen], pointers[chosen].astype(np.uint64)], axis=1), axis=0, return_index=True)
                        chosen = chosen[once]
                    at, prints, checks, pointers = at[chosen], prints[chosen], checks[chosen], pointers[chosen]
                    found = pa.table({
                        "lang": pa.array([lang] * len(at), pa.string()), "length": pa.array(np.full(len(at), length, np.int32)), "print": prints.view(np.int64),
                        "check": checks, "pointer": pointers, "phrase": pa.array(words.phrases(at, length), pa.string()), "n": np.ones(len(at), np.int64)})
                    if spots is None:
                        keys = ["lang", "length", "print", "phrase"]
                        found = found.group_by(keys).aggregate([("check", "min"), ("pointer", "min"), ("n", "sum")]).rename_columns([*keys, "check", "pointer", "n"])
                    yield from found.select(_SPELLED_ARROW.names).to_batches()

    return run


def _pointer_key(prints, pointers: np.ndarray) -> np.ndarray:
    return prints ^ (pointers.astype(np.int64).view(np.uint64) << np.uint64(24))


def phrase_counts(docs: DataFrame, least: int = FREQUENT, longest: int = LONGEST, print_bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, length, n) of the phrases counted at least ``least`` times, and (lang, n) of all words.

    ``docs`` has the columns text and lang. ``print_bits`` below 64 makes fingerprints
    collide (for tests); the counts stay exact.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    levels, shorter = [], None
    for length in range(1, longest + 1):
        level = stored(_frequent(docs, length, shorter, least, print_bits).withColumn("length", F.lit(length)))
        levels.append(level)
        if length < longest:
            shorter = _filter(level.select(F.col("print").alias("key")))
    frequent = reduce(DataFrame.unionByName, levels)
    key = F.col("print").bitwiseXOR(F.shiftleft(F.col("pointer").cast("long"), 24))
    wanted = _filter(frequent.select(key.alias("key")))
    spots = _filter(frequent.select("pointer").distinct().select(F.xxhash64("pointer").alias("key")))
    spotted = docs.withColumn("spot", F.xxhash64(F.shiftright("text_hash", 32).cast("int")))
    spelled = stored(spotted.mapInArrow(_spelled(wanted, spots, longest, print_bits), _SPELLED))
    total = spelled.filter("length = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    texts = spelled.filter("length > 0").select("lang", "length", "print", "check", "phrase", "pointer").distinct()
    keys = ["print", "length"]
    sound = frequent.join(texts, [*keys, "pointer"]).filter("checks = n * check").select(*keys, "lang", "phrase", "n")
    sound = stored(sound.dropDuplicates(["lang", "phrase"]))
    out = sound.select("lang", "phrase", "length", "n")
    collided = frequent.select(*keys).join(sound.select(*keys), keys, "left_anti")
    if not collided.isEmpty():
        collided = stored(collided)
        wanted = _filter(collided.select(F.col("print").alias("key")))
        again = docs.mapInArrow(_spelled(wanted, None, longest, print_bits), _SPELLED)
        again = again.join(collided, keys, "left_semi").groupBy("lang", "phrase", "length").agg(F.sum("n").alias("n"))
        out = out.unionByName(again.filter(F.col("n") >= least))
    return stored(out), total


def score() -> Column:
    """floor(1000 * a * n / (l * r)) of the columns of these names, exact (38 digits)."""

    def exact(name):
        return F.col(name).cast("decimal(17,0)")

    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (exact("a") * exact("n")), exact("l") * exact("r"))


def collocations(docs: DataFrame, least: int = FREQUENT, longest: int = LONGEST, print_bits: int = 64) -> DataFrame:
    """All scored phrases: lang, phrase, a, l, r, n, score (contained ones dropped)."""
    counts, total = phrase_counts(docs, least, longest, print_bits)
    found = counts.filter("length > 1").withColumn("words", F.split("phrase", " "))

    def part(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    # A longer candidate as frequent as one of its parts has, by one word more than the
    # part, another that is; so only the parts of one word less are looked at.
    inner = found.filter("length > 2").select("lang", F.explode(F.array(part(F.lit(1), F.col("length") - 1), part(F.lit(2), F.col("length") - 1))).alias("phrase"), "n")
    inner = inner.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = found.join(inner, ["lang", "phrase"], "left").filter("longer is null or 100 * longer < 100 * n").select("lang", "phrase", "length", "words", F.col("n").alias("a"))
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("length") - F.col("k")).alias("right"))
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(total, "lang")

    best = cuts.withColumn("score", score()).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("best"))
    return best.select("lang", "phrase", "best.a", "best.l", "best.r", "best.n", "best.score")


def op12_phrase_collocations(spark, sf_dir: str) -> DataFrame:
    found = collocations(table(spark, sf_dir, "documents", "text", "lang"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.col("phrase").cast("binary"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), total AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM words GROUP BY lang
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), spans AS (
  SELECT lang, w, i, unnest(range(1, 6)) AS m FROM starts
), counts AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM spans WHERE i + m - 1 <= len(w) GROUP BY ALL
), candidates AS (
  SELECT lang, m, phrase, string_split(phrase, ' ') AS w, f AS a FROM counts WHERE m > 1 AND f >= 100
), inner_parts AS (
  SELECT lang, m, w, a, unnest(range(2, m)) AS size FROM candidates
), inner_spans AS (
  SELECT lang, w, a, size, unnest(range(1, m - size + 2)) AS i FROM inner_parts
), longer AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer FROM inner_spans GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN longer x USING (lang, phrase) WHERE x.longer IS NULL OR 100 * x.longer < 100 * c.a
), cuts AS (
  SELECT lang, phrase, w, m, a, unnest(range(1, m)) AS k FROM kept
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, p.f AS l, q.f AS r, t.n, (1000 * c.a * t.n) // (p.f * q.f) AS score
  FROM cuts c
  JOIN counts p ON p.lang = c.lang AND p.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counts q ON q.lang = c.lang AND q.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
  JOIN total t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
