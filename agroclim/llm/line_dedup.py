"""Line deduplication against a sharded minimal perfect hash of repeated lines.

A line's key is the line without ASCII white space at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points found in at least two documents lose all
their lines but those in the smallest doc_id that holds them.

1. One pass hashes the lines (128 bits) and reduces, per key, the smallest and the
   largest doc_id (partial sums per Arrow batch, then per key): differing ids mean
   that the line repeats. Hot lines are reduced before the shuffle.
2. Repeated keys are sharded by hash; each shard of about ``SHARD_KEYS`` keys becomes
   a minimal perfect hash with arrays of fingerprints and first documents.
3. The arrays' total size is summed. Up to ``INDEX_MAX_BYTES`` they are broadcast and
   the documents probe them, one pass, no shuffle of lines. Above that bound the
   documents' line keys are joined with the repeated keys instead; same rows.

Defined cases: a null text is one empty line and stays null; an empty table gives
none; rows with a null doc_id neither count nor lose lines; repeated rows of a
doc_id are one document. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroclim.llm import mphf, textarrow
from agroclim.llm.common import prepare, stored

MIN_CHARS = 10
SHARD_KEYS = 1 << 18
INDEX_MAX_BYTES = 96 << 20  # 17 bytes a key: about 5.9 million repeated lines

_BLANKS = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_INDEX_SCHEMA = "shard int, sizes binary, bitmap binary, fingerprints binary, `values` binary"


def _keys(values: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For distinct lines: whether they are long enough, and both halves of the key's hash."""
    n = len(values)
    fits, high, low = np.zeros(n, bool), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for k, line in enumerate(values.to_pylist()):
        key = line.strip(_BLANKS)
        if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
            continue
        digest = xxhash.xxh3_128_intdigest(key.translate(_LOWER))
        fits[k], high[k], low[k] = True, digest >> 64, digest & 0xFFFFFFFFFFFFFFFF
    return fits, high, low


def _line_ids(min_chars: int):
    """Per chunk and key: the smallest and largest doc_id whose text holds it."""

    def run(batches):
        for batch in batches:
            ids, text = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            for texts in textarrow.chunks(text):
                values, codes, first = textarrow.lines(texts)
                fits, high, low = _keys(values, min_chars)
                owner = np.repeat(ids[texts.first:texts.first + len(texts)], np.diff(first))
                use = codes >= 0
                use[use] = fits[codes[use]]
                if not use.any():
                    continue
                yield pa.RecordBatch.from_pandas(_reduced(high[codes[use]], low[codes[use]], owner[use]), preserve_index=False)

    return run


def _reduced(high, low, owner):
    import pandas as pd

    rows = pd.DataFrame({"high": high.view(np.int64), "low": low.view(np.int64), "owner": owner})
    return rows.groupby(["high", "low"], sort=False)["owner"].agg(first_doc="min", last_doc="max").reset_index()


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(high, low, first_doc) of every line key that at least two documents hold."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").filter("doc_id is not null and text is not null")
    found = rows.mapInArrow(_line_ids(min_chars), "high long, low long, first_doc long, last_doc long")
    found = found.groupBy("high", "low").agg(F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc"))
    return found.filter("first_doc <> last_doc").select("high", "low", "first_doc")


def _build(rows):
    import pandas as pd

    made = mphf.build(rows["high"].to_numpy().view(np.uint64), rows["low"].to_numpy().view(np.uint64), rows["first_doc"].to_numpy())
    return pd.DataFrame([{"shard": int(rows["shard"].iloc[0]), **made}])


def build_index(repeated: DataFrame, n: int) -> DataFrame:
    """One row per shard: its perfect hash, fingerprints and first documents."""
    shards = -(-n // SHARD_KEYS) or 1
    dealt = repeated.withColumn("shard", F.pmod(F.col("high"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(_build, _INDEX_SCHEMA)


class _Shards:
    def __init__(self, rows: list[tuple]):
        self.by = {row[0]: mphf.Index(*row[1:]) for row in rows}

    def find(self, high: np.ndarray, low: np.ndarray, shards: int):
        found, value = np.zeros(len(high), bool), np.zeros(len(high), np.int64)
        shard = high.view(np.int64) % shards
        for k, index in self.by.items():
            own = shard == k
            found[own], value[own] = index.find(high[own], low[own])
        return found, value


_LOADED: dict[str, _Shards] = {}  # the last index of this worker


def _strip(name: str, shared, shards: int, min_chars: int, at: tuple[int, int]):
    """Rewrite the text column of whole batches; add the numbers of lines and dropped lines."""

    def run(batches):
        if name not in _LOADED:
            _LOADED.clear()
            _LOADED[name] = _Shards(shared.value)
        index = _LOADED[name]
        for batch in batches:
            ids = batch.column(at[0])
            known = np.asarray(ids.is_valid())
            numbers = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            kept, n_lines, n_dropped = [], [], []
            column = batch.column(at[1])
            for texts in textarrow.chunks(column):
                values, codes, first = textarrow.lines(texts)
                fits, high, low = _keys(values, min_chars)
                found, holder = np.zeros(len(values), bool), np.zeros(len(values), np.int64)
                found[fits], holder[fits] = index.find(high[fits], low[fits], shards)
                rows = slice(texts.first, texts.first + len(texts))
                counts = np.diff(first)
                drop = codes >= 0
                drop &= np.repeat(known[rows], counts)
                drop[drop] = found[codes[drop]]
                drop[drop] = holder[codes[drop]] != np.repeat(numbers[rows], counts)[drop]
                dropped = np.add.reduceat(drop, first[:-1]).astype(np.int64) if len(drop) else np.zeros(len(texts), np.int64)
                raw = texts.data.tobytes()
                for k in range(len(texts)):
                    whole = raw[texts.offsets[k]:texts.offsets[k + 1]]
                    if dropped[k]:
                        gone = drop[first[k]:first[k + 1]]
                        whole = b"\n".join(x for x, out in zip(whole.split(b"\n"), gone.tolist()) if not out)
                    kept.append(whole)
                n_lines.append(counts)
                n_dropped.append(dropped)
            if not len(column):
                continue
            texts_out = pa.array(kept, pa.binary(), mask=np.asarray(column.is_null())).cast(pa.string())
            columns = [texts_out if k == at[1] else batch.column(k) for k in range(batch.num_columns)]
            columns += [pa.array(np.concatenate(n_lines)), pa.array(np.concatenate(n_dropped))]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    return run


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, index_max_bytes: int = INDEX_MAX_BYTES) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, then n_lines and n_dropped (long)."""
    spark = docs.sparkSession
    prepare(spark)
    repeated = stored(repeated_lines(docs, min_chars))
    n = repeated.count()
    if 17 * n > index_max_bytes:
        return _joined(docs, repeated, min_chars)
    index = stored(build_index(repeated, n))
    rows = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in row) for row in index.collect()]  # bounded above
    shared = spark.sparkContext.broadcast(rows)
    fields = docs.schema.fields
    at = tuple(next(k for k, f in enumerate(fields) if f.name == name) for name in ("doc_id", "text"))
    plain = T.StructType([T.StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)]
                         + [T.StructField(f"c{len(fields) + k}", T.LongType()) for k in (0, 1)])
    strip = _strip(f"{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}" if shared._jbroadcast else "local", shared, -(-n // SHARD_KEYS) or 1, min_chars, at)
    out = docs.toDF(*[f"c{k}" for k in range(len(fields))]).mapInArrow(strip, plain)
    return out.toDF(*docs.columns, "n_lines", "n_dropped")


def _joined(docs: DataFrame, repeated: DataFrame, min_chars: int) -> DataFrame:
    """The same rows by a shuffled join of line keys, for an index beyond the bound."""
    names = docs.columns
    rows = stored(docs.toDF(*[f"c{k}" for k in range(len(names))]).withColumn("row", F.expr("uuid()")))
    doc, text = (f"c{names.index(x)}" for x in ("doc_id", "text"))
    lines = rows.select("row", F.col(doc).alias("doc_id"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))

    def hashed(batches):
        for batch in batches:
            fits, high, low = _keys(batch.column(3).cast(pa.binary()), min_chars)
            mask = ~fits
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(high.view(np.int64), mask=mask), pa.array(low.view(np.int64), mask=mask)],
                                             names=["row", "doc_id", "pos", "high", "low"])

    keyed = lines.mapInArrow(hashed, "row string, doc_id long, pos int, high long, low long")
    hit = keyed.filter("high is not null and doc_id is not null").join(repeated, ["high", "low"]).filter("first_doc <> doc_id")
    gone = hit.groupBy("row").agg(F.collect_set("pos").alias("gone"))
    split = F.split(F.col(text), "\n", -1)
    kept = F.array_join(F.filter(F.transform(split, lambda x, k: F.when(~F.array_contains(F.col("gone"), k), x)), lambda x: x.isNotNull()), "\n")
    joined = rows.join(gone, "row", "left")
    out = joined.select(*[(F.when(F.col("gone").isNull(), F.col(c)).otherwise(kept) if c == text else F.col(c)).alias(c) for c in rows.columns if c != "row"],
                        F.coalesce(F.size(split), F.lit(1)).cast("long").alias("x"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("y"))
    return out.toDF(*names, "n_lines", "n_dropped")


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    from agroclim.llm.common import table

    out = dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP8_SQL = r"""
with l as (
  select doc_id, n, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(p) as line, unnest(range(len(p))) as n
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents))),
r as (select k, min(doc_id) as f from l where length(k) >= 10 group by k having count(distinct doc_id) >= 2),
j as (select l.doc_id, l.n, l.line, r.f is not null and r.f <> l.doc_id as gone from l left join r on l.k = r.k)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) as kept_sha256
from j group by doc_id
"""
