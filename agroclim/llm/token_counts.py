"""Token counts of a public byte-level BPE tokenizer by a two-tier look-up on the map side.

The text is cut into pre-tokens inside Arrow batches; a text's count is the sum of its
pre-tokens' lengths in tokens.

1. One pass over all texts summarises each partition by its ``PER_TASK`` most frequent
   pre-tokens; the summaries, bounded per task, are added up, and the ``FREQUENT`` most
   frequent are encoded once: the broadcast tier, a table of pre-tokens and lengths
   (bounded in number and bytes).
2. A second pass looks distinct pre-tokens of a chunk of texts up in that table; misses
   go to the worker's cache and, new ones, in one batch to the tokenizer. Pre-tokens
   are never shuffled. The table and cache only save time; every count is the library's.

Texts that hold a special string of the tokenizer are counted whole by the library.

Defined cases: a null or empty text has no tokens; repeated rows are counted alike; an
empty table gives none. Long texts are counted whole. Extra columns pass through
``count_tokens`` (clashing names give way).
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroclim.llm import textarrow
from agroclim.llm.common import prepare, stored, table

FREQUENT = 1 << 17
FREQUENT_BYTES = 32
PER_TASK = 1 << 14
CACHE_WORDS = 1 << 18
LIMIT = 1024


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    specials = [t.content.encode() for t in made.get_added_tokens_decoder().values()]
    return made, specials


def _lengths(path: str, words: list[bytes]) -> list[int]:
    made, _ = _tokenizer(path)
    return [len(e.ids) for e in made.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)]


def _summary(batches):
    """The most frequent short pre-tokens of this partition with their counts."""
    known: dict[bytes, int] = {}
    for batch in batches:
        for texts in textarrow.chunks(batch.column(0)):
            values, codes, _ = textarrow.pretokens(texts)
            counts = np.bincount(codes, minlength=len(values))
            top = np.argsort(-counts, kind="stable")[:PER_TASK]
            for word, n in zip(values.take(pa.array(top)).to_pylist(), counts[top].tolist(), strict=True):
                if len(word) <= FREQUENT_BYTES:
                    known[word] = known.get(word, 0) + n
            if len(known) > 4 * PER_TASK:
                known = dict(sorted(known.items(), key=lambda x: (-x[1], x[0]))[:2 * PER_TASK])
    best = sorted(known.items(), key=lambda x: (-x[1], x[0]))[:PER_TASK]
    yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())], names=["word", "n"])


def frequent(docs: DataFrame, path: str) -> DataFrame:
    """(word, n_tokens) of the most frequent pre-tokens, at most ``FREQUENT`` rows."""
    sums = docs.select("text").mapInArrow(_summary, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = sums.orderBy(F.desc("n"), "word").limit(FREQUENT).select("word").repartition(max(1, FREQUENT >> 14))

    def lengths(batches):
        for batch in batches:
            words = batch.column(0)
            yield pa.RecordBatch.from_arrays([words, pa.array(_lengths(path, words.to_pylist()), pa.int32())], names=["word", "n_tokens"])

    return top.mapInArrow(lengths, "word binary, n_tokens int")


_CACHE: dict[str, dict[bytes, int]] = {}
_TABLE: dict[str, tuple[pa.Array, np.ndarray]] = {}  # the last broadcast table of this worker


def _counts(name: str, shared, path: str, at: int):
    def of_misses(words: list[bytes]) -> list[int]:
        cache = _CACHE.setdefault(path, {})
        if len(cache) > CACHE_WORDS:
            cache.clear()
        new = [w for w in words if w not in cache]
        cache.update(zip(new, _lengths(path, new), strict=True))
        return [cache[w] for w in words]

    def run(batches):
        if name not in _TABLE:
            _TABLE.clear()
            words, lengths = shared.value
            _TABLE[name] = (pa.array(words, pa.binary()), np.array(lengths, dtype=np.int64))
        words, lengths = _TABLE[name]
        made, specials = _tokenizer(path)
        for batch in batches:
            counts, sizes = [], []
            for texts in textarrow.chunks(batch.column(at)):
                values, codes, first = textarrow.pretokens(texts)
                place = pc.index_in(values, value_set=words)
                missed = np.asarray(place.is_null())
                each = np.zeros(len(values), dtype=np.int64)
                each[~missed] = lengths[place.drop_null().to_numpy(zero_copy_only=False)]
                each[missed] = of_misses(values.filter(pa.array(missed)).to_pylist())
                total = np.concatenate([[0], np.cumsum(each[codes])])
                own = total[first[1:]] - total[first[:-1]]
                raw = texts.data.tobytes()
                if any(s in raw for s in specials):
                    for k in range(len(texts)):
                        text = raw[texts.offsets[k]:texts.offsets[k + 1]]
                        if any(s in text for s in specials):
                            own[k] = len(made.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
                counts.append(own)
                sizes.append(np.diff(texts.offsets))
            if counts:
                columns = [*batch.columns, pa.array(np.concatenate(sizes)), pa.array(np.concatenate(counts))]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    return run


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with n_bytes (UTF-8) and n_tokens of the column text."""
    prepare(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c not in ("n_bytes", "n_tokens")])
    rows = stored(frequent(docs, path)).collect()  # at most FREQUENT short words
    shared = docs.sparkSession.sparkContext.broadcast(([bytes(r["word"]) for r in rows], [r["n_tokens"] for r in rows]))
    name = f"{docs.sparkSession.sparkContext.applicationId}-{shared._jbroadcast.id()}"
    fields = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    fields += [T.StructField(f"c{len(fields) + k}", T.LongType()) for k in (0, 1)]
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    out = plain.mapInArrow(_counts(name, shared, path, docs.columns.index("text")), T.StructType(fields))
    return out.toDF(*docs.columns, "n_bytes", "n_tokens")


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
