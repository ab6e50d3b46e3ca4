"""Byte-level BPE encoding and decoding by Spark higher-order functions.

A word (pre-token) is folded by ranked merges. Each piece is written as one character
that stands for its rank, a word as the string of its pieces, at first its bytes; each
step looks all adjacent pairs up in a map, takes the result of lowest rank, leftmost
first, and puts it in the pair's place, until no pair has one. The map is one value, an
array of small maps dealt by hash, as Spark reads a map from its start to find a key. It
is a stored table of one row: as a literal, every plan that the driver shows, logs and
keeps would spell it out.

1. One pass counts the distinct pre-tokens of all texts (per Arrow batch, then by key).
2. The ``HOT_WORDS`` most frequent, a bound in number and length, are folded once, in rows
   of ``HOT_ROW`` words with the map beside them, and broadcast with their ids.
3. One pass encodes the texts: words found in the broadcast table get its ids, the
   other distinct words of a chunk of texts are folded in place by the same
   expression. No text or token is shuffled, whatever the vocabulary's size.

Ids of a text are those of its words in order; decoding looks every id's bytes up
and joins the pieces.

Defined cases: a null or empty text has no ids and decodes to nothing; special strings
are ordinary text; repeated rows are encoded alike; an empty table gives none. A long
text or word is never cut. Extra columns pass through ``encode_documents``.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.llm import textarrow
from agroclim.llm.common import most_frequent, prepare, stored, table

HOT_WORDS = 1 << 18
HOT_WORD_BYTES = 32
HOT_ROW = 1 << 14
GROUP_BYTES = 2 << 20  # texts whose other words are folded together
BATCH_BYTES = 8 << 20  # groups of texts in an Arrow batch
_BUCKETS = 1 << 14  # a power of two
_LONG = 64


@functools.lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file: one base64 piece and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


# A piece of rank r is written as one character, so that a word is a string of pieces, and
# strings of one character compare as their ranks do: U+0800 + r where all ranks fit below
# the surrogates, which keeps the map short, or else U+10000 + r.
_BASE, _SURROGATES, _WIDE_BASE = 0x800, 0xD800, 0x10000


def _base(ranks: dict[bytes, int]) -> int:
    return _BASE if _BASE + max(ranks.values()) < _SURROGATES else _WIDE_BASE


def _merge(parts: list[bytes], ranks: dict[bytes, int]) -> list[bytes]:
    while len(parts) > 1:
        best, i = min((ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best == math.inf:
            break
        parts = [*parts[:i], parts[i] + parts[i + 1], *parts[i + 2:]]
    return parts


def _hashed(pairs: list[str]) -> np.ndarray:
    """Spark's ``hash`` (Murmur3, seed 42) of strings of two pieces, all of one length in UTF-8."""
    out = np.full(len(pairs), 42, dtype=np.uint32)
    size = len(pairs[0].encode()) if pairs else 8
    signs = np.frombuffer("".join(pairs).encode(), dtype=np.uint8).reshape(-1, size)
    whole = size // 4 * 4
    words = [*np.ascontiguousarray(signs[:, :whole]).view("<u4").T, *signs[:, whole:].view(np.int8).astype(np.int32).view(np.uint32).T]

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint32(by) | x >> np.uint32(32 - by)

    with np.errstate(over="ignore"):
        for word in words:
            out ^= turned(word * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)
            out = turned(out, 13) * np.uint32(5) + np.uint32(0xE6546B64)
        out ^= np.uint32(size)
        for by, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
            out = (out ^ out >> np.uint32(by)) * np.uint32(factor)
    return out.view(np.int32)


@functools.lru_cache(maxsize=2)
def _literals(path: str) -> tuple[str, str, dict[str, int]]:
    """Pairs and what they merge to, as JSON; the characters of the 256 bytes; pieces that no merges reach."""
    ranks = load_ranks(path)
    base = _base(ranks)
    shown = {piece: chr(base + rank) for piece, rank in ranks.items()}
    buckets: list[dict[str, str]] = [{} for _ in range(_BUCKETS)]
    pairs, odd = {}, {}
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            left, right = shown.get(piece[:cut]), shown.get(piece[cut:])
            if left and right:
                pairs[left + right] = shown[piece]
        if len(piece) > 1 and len(_merge([piece[k:k + 1] for k in range(len(piece))], ranks)) > 1:
            odd[piece.decode("latin-1")] = rank
    for place, (pair, to) in zip((_hashed(list(pairs)) % _BUCKETS).tolist(), pairs.items(), strict=True):
        buckets[place][pair] = to
    return json.dumps(buckets, separators=(",", ":"), ensure_ascii=False), "".join(shown[bytes([k])] for k in range(256)), odd


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def merge_map(spark: SparkSession, ranks_path: str) -> DataFrame:
    """The map of pairs as a stored table of one row and column (pairs)."""
    shown = spark.createDataFrame([(_literals(ranks_path)[0],)], "shown string")
    return stored(shown.select(F.from_json("shown", "array<map<string,string>>").alias("pairs")))


def fold_words(words: Column, merges: Column, ranks_path: str) -> Column:
    """For an array of pre-tokens (binary) the array of their ids (array<array<int>>); ``merges`` is the map."""
    _, byte_chars, odd = _literals(ranks_path)
    base = _base(load_ranks(ranks_path))
    latin = "".join(map(chr, range(256)))

    def fold(word: Column, pairs: Column) -> Column:
        def merged(state: Column) -> Column:
            two = F.transform(F.sequence(F.lit(1), F.length(state) - 1), lambda i: F.substring(state, i, F.lit(2)))
            found = F.transform(two, lambda x: F.try_element_at(F.get(pairs, F.hash(x).bitwiseAND(_BUCKETS - 1)), x))
            return _let(found, lambda to: _let(F.array_min(to), lambda best: F.when(best.isNull(), F.concat(F.lit("."), state)).otherwise(
                replaced(state, best, F.array_position(to, best).cast("int")))))

        def replaced(state: Column, best: Column, i: Column) -> Column:
            one = F.overlay(state, best, i, F.lit(2))
            # Long words: all places of the pair at once, from left to right.
            return F.when(F.length(state) > _LONG, F.replace(state, F.substring(state, i, F.lit(2)), best)).otherwise(one)

        def step(state: Column, _: Column) -> Column:
            # A state that begins with a full stop has no pair left.
            return F.when((F.length(state) < 2) | F.startswith(state, F.lit(".")), state).otherwise(merged(state))

        start = F.translate(word, latin, byte_chars)
        end = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(word) - 1, F.lit(1))), start, step)
        ids = F.filter(F.transform(F.split(end, ""), lambda c: F.ascii(c) - base), lambda x: x >= 0)
        for piece, rank in odd.items():
            ids = F.when(word == piece, F.array(F.lit(rank))).otherwise(ids)
        return ids

    # Read out of the row's bytes once for all words: found in bytes, a key takes longer.
    opened = F.transform(merges, lambda m: F.map_from_entries(F.map_entries(m)))
    return _let(opened, lambda pairs: F.transform(words, lambda w: _let(F.decode(w, "ISO-8859-1"), lambda word: fold(word, pairs))))


def _count(batches):
    for batch in batches:
        tables = []
        for texts in textarrow.chunks(batch.column(0)):
            values, codes, _ = textarrow.pretokens(texts)
            tables.append(pa.table({"word": values, "n": np.bincount(codes, minlength=len(values))}))
        if tables:
            merged = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
            yield from merged.rename_columns(["word", "n"]).select(["word", "n"]).to_batches(max_chunksize=50_000)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n) of every distinct pre-token of the column text."""
    prepare(docs.sparkSession)
    counted = docs.select("text").filter("text <> ''").mapInArrow(_count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def encode_words(words: DataFrame, ranks_path: str) -> DataFrame:
    """``words`` with ids (array<int>)."""
    names = words.columns
    words = words.withColumn("__pairs", merge_map(words.sparkSession, ranks_path).scalar())
    return words.select(*names, F.element_at(fold_words(F.array("word"), F.col("__pairs"), ranks_path), 1).alias("ids"))


def hot_words(docs: DataFrame, ranks_path: str, limit: int = HOT_WORDS, merges: DataFrame | None = None) -> DataFrame:
    """The most frequent short words with their ids: at most ``limit`` rows (a speed tier, not a cap)."""
    counted = stored(word_counts(docs).filter((F.length("word") <= HOT_WORD_BYTES) & (F.col("n") > 1)))
    row = F.pmod(F.xxhash64("word"), F.lit(max(8, limit // HOT_ROW)))
    kept = most_frequent(counted, limit).groupBy(row.alias("row")).agg(F.collect_list("word").alias("words"))  # at most limit words
    merges = merge_map(docs.sparkSession, ranks_path) if merges is None else merges
    # Stored first, the map in every row: the fold is a plan without shuffles or joins.
    rows = stored(kept.select("words").repartition(max(8, limit // HOT_ROW)).crossJoin(F.broadcast(merges)))
    folded = rows.select(F.explode(F.arrays_zip(F.col("words").alias("word"), fold_words(F.col("words"), F.col("pairs"), ranks_path).alias("ids"))).alias("w"))
    return folded.select("w.word", "w.ids")


_LOADED: dict[str, pa.Array] = {}  # the last hot words, or their ids, of this worker


def _hot(name: str, shared) -> pa.Array:
    if name not in _LOADED:
        _LOADED.clear()
        with pa.ipc.open_stream(shared.value) as reader:
            _LOADED[name] = reader.read_all().column(0).combine_chunks()
    return _LOADED[name]


_PACKED = "rows binary, codes binary, first binary, hot binary, cold array<binary>"


def _look_up(name: str, shared):
    """Chunks of texts as word codes: places in the hot table (hot), or in the list of other words."""

    def run(batches):
        table_words = _hot(name, shared)
        for batch in batches:
            for group in textarrow.chunks(batch.column(1), GROUP_BYTES):
                values, codes, first, words, tokens = [], [], [np.zeros(1, np.int64)], 0, 0
                for texts in textarrow.parts(group, 1 << 19):
                    own, own_codes, own_first = textarrow.pretokens(texts)
                    values.append(own)
                    codes.append(own_codes.astype(np.int32) + np.int32(words))
                    first.append(own_first[1:] + tokens)
                    words, tokens = words + len(own), tokens + len(own_codes)
                merged = pa.concat_arrays(values).dictionary_encode()
                order = merged.indices.to_numpy(zero_copy_only=False)[np.concatenate(codes)]
                place = pc.index_in(merged.dictionary, value_set=table_words)
                cold = merged.dictionary.filter(place.is_null())
                place = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int32)
                rows = pa.table({"doc": batch.column(0).slice(group.first, len(group))})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as writer:
                    writer.write_table(rows)
                cold = pa.ListArray.from_arrays(pa.array([0, len(cold)], pa.int32()), cold)
                packed = [sink.getvalue().to_pybytes(), order.astype(np.int32).tobytes(), np.concatenate(first).tobytes(), place.tobytes()]
                yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.binary()) for x in packed), cold], names=["rows", "codes", "first", "hot", "cold"])

    return run


def _joined(pieces: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The pieces of ``ids`` one after the other, and where each begins (with the end)."""
    taken = pieces.take(pa.array(ids))
    buffers = taken.buffers()
    return memoryview(buffers[2] if buffers[2] is not None else b""), np.frombuffer(buffers[1], dtype=np.int64)[:len(ids) + 1]


def _assemble(name: str, shared, ranks_path: str, digest: bool):
    """From word codes and ids of the other words to the ids of every text, and back to bytes."""

    def run(batches):
        hot = _hot(name, shared)
        hot_ids, hot_offsets = hot.flatten().to_numpy(zero_copy_only=False), hot.offsets.to_numpy()
        listed = sorted((rank, piece) for piece, rank in load_ranks(ranks_path).items())
        pieces = [b""] * (listed[-1][0] + 1)
        for rank, piece in listed:
            pieces[rank] = piece
        pieces, numbers = pa.array(pieces, pa.large_binary()), pa.array([b"%d," % k for k in range(len(pieces))], pa.large_binary())
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                with pa.ipc.open_stream(row["rows"].as_py()) as reader:
                    docs = reader.read_all().column("doc").combine_chunks()
                codes, first, place = (np.frombuffer(row[c].as_buffer(), dtype=t) for c, t in (("codes", np.int32), ("first", np.int64), ("hot", np.int32)))
                cold = row["ids"].values
                cold_ids = cold.flatten().to_numpy(zero_copy_only=False) if cold is not None and len(cold) else np.zeros(0, np.int32)
                cold_sizes = cold.value_lengths().to_numpy(zero_copy_only=False) if cold is not None and len(cold) else np.zeros(0, np.int64)
                # where each word's ids begin in a pool of the hot and the other words' ids
                pool = np.concatenate([hot_ids, cold_ids])
                known = place >= 0
                begin, size = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
                begin[known], size[known] = hot_offsets[place[known]], hot_offsets[place[known] + 1] - hot_offsets[place[known]]
                begin[~known], size[~known] = len(hot_ids) + np.cumsum(cold_sizes) - cold_sizes, cold_sizes
                ids_out, text_out, n_tokens = [], [], []
                for a in range(0, len(docs), 512):
                    cuts = first[a:a + 513]
                    own = codes[cuts[0]:cuts[-1]]
                    ends = np.concatenate([[0], np.cumsum(size[own])])
                    ids = pool[np.repeat(begin[own] - ends[:-1], size[own]) + np.arange(ends[-1])]
                    at = ends[cuts - cuts[0]]
                    text, text_at = _joined(pieces, ids)
                    shown, shown_at = _joined(numbers, ids) if digest else (None, None)
                    n_tokens.append(np.diff(at))
                    for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                        whole = text[text_at[x]:text_at[y]]
                        if digest:
                            ids_out.append(hashlib.sha256(shown[shown_at[x]:max(shown_at[y] - 1, shown_at[x])]).hexdigest())
                            text_out.append(hashlib.sha256(whole).hexdigest())
                        else:
                            text_out.append(bytes(whole))
                    if not digest:
                        ids_out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32())))
                ids_out = pa.array(ids_out, pa.string()) if digest else pa.concat_arrays(ids_out)
                yield pa.RecordBatch.from_arrays([docs, pa.array(np.concatenate(n_tokens)), ids_out, pa.array(text_out, pa.string() if digest else pa.binary())], names=["doc", "n_tokens", "ids", "decoded"])

    return run


def _shared_hot(docs: DataFrame, ranks_path: str, limit: int, merges: DataFrame):
    hot = stored(hot_words(docs, ranks_path, limit, merges)).toArrow()  # bounded: limit rows of short words

    def sent(column: str):
        sink = pa.BufferOutputStream()
        one = hot.select([column])
        with pa.ipc.new_stream(sink, one.schema) as writer:
            writer.write_table(one)
        return docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    return sent("word"), sent("ids")


def encode(docs: DataFrame, ranks_path: str, digest: bool = False, hot: int = HOT_WORDS) -> DataFrame:
    """(doc, n_tokens, ids, decoded) from the columns doc and text.

    ``ids`` are the token ids and ``decoded`` their bytes; with ``digest`` their SHA-256
    instead (of decimal ids joined by commas, of the bytes).
    """
    spark = docs.sparkSession
    prepare(spark)
    # A group of texts is one row, so rows alone do not bound its batches (a session's own bound is kept).
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, BATCH_BYTES)
    merges = merge_map(spark, ranks_path)
    words, ids = _shared_hot(docs, ranks_path, hot, merges)
    name = f"{docs.sparkSession.sparkContext.applicationId}-{words._jbroadcast.id()}"
    packed = docs.select("doc", "text").mapInArrow(_look_up(f"{name}-words", words), _PACKED)
    packed = packed.withColumn("pairs", merges.scalar())
    folded = packed.select("rows", "codes", "first", "hot", fold_words(F.col("cold"), F.col("pairs"), ranks_path).alias("ids"))
    kind = docs.schema["doc"].dataType.simpleString()
    out = f"doc {kind}, n_tokens long, " + ("ids string, decoded string" if digest else "ids array<int>, decoded binary")
    return folded.mapInArrow(_assemble(f"{name}-ids", ids, ranks_path, digest), out)


def encode_documents(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``docs`` with token_ids (array<int>), n_tokens and decoded (string); names that clash give way."""
    own = [c for c in docs.columns if c not in ("token_ids", "n_tokens", "decoded")]
    packed = docs.select(F.struct(*own).alias("doc"), "text")
    out = encode(packed, ranks_path)
    return out.select("doc.*", F.col("ids").alias("token_ids"), "n_tokens", F.decode("decoded", "UTF-8").alias("decoded"))


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    out = encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), digest=True)
    return out.select(F.col("doc").alias("doc_id"), "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))
