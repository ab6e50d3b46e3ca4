"""SentencePiece (merge type) encoding and decoding, exact, by backtracking.

A merge-type model joins, of all neighbours whose union is a piece, the best scored
pair, leftmost first, until none is left. Two facts make this local:

* a sequence of pieces is that result if and only if each piece comes back from merging
  its own characters, and each pair of neighbours from merging the pair's characters
  (the first join across a boundary would also be the first one in the pair alone);
* so the pieces before any position are unique: a position that once led nowhere leads
  nowhere on every other way.

The encoder therefore walks from left to right. An Aho-Corasick pass gives the longest
piece that starts at each character; a piece is taken if re-merging it with its
predecessor gives both back, else its next shorter prefix is tried; when none is left
the position's bit is set as failed and the predecessor is given up. Checked pairs and
encoded stretches are remembered in the worker (bounded; they only save time).

Before that a text is cut wherever two characters meet that never meet inside any piece:
no merge crosses such a place, so the stretches are independent and repeat often.
Everything happens where the text lies; nothing is shuffled.

Models: merge type with byte fallback, no character map, no user-defined or unused
pieces, blanks kept; others raise ``ValueError`` (their rules are not these).

Defined cases: a null or empty text has the end id alone and decodes to nothing; the
strings of control pieces are ordinary text; a character without a piece becomes its
bytes; U+2581 reads as a blank, as in the library. Repeated rows are encoded alike, an
empty table gives none, a long text or stretch is never cut elsewhere. Extra columns
pass through ``encode_documents`` (clashing names give way).
"""

from __future__ import annotations

import array
import functools

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroclim.llm import textarrow
from agroclim.llm.common import prepare, table

BLANK = "▁"  # stands for the blank inside pieces
GROUP_BYTES = 2 << 20
CACHE_STRETCHES = 1 << 18
CACHE_PAIRS = 1 << 20
CACHE_LENGTH = 64  # longer stretches are encoded each time

# The model file's numbers for its type and for the types of pieces.
_MERGE_TYPE = 2
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


class Model:
    """Pieces, scores and bytes of a model file, and the encoder over them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        trainer, normalizer, types = proto.trainer_spec, proto.normalizer_spec, {p.type for p in proto.pieces}
        plain = (trainer.model_type == _MERGE_TYPE and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix
                 and normalizer.add_dummy_prefix and normalizer.escape_whitespaces and not normalizer.remove_extra_whitespaces
                 and not normalizer.precompiled_charsmap and types <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE})
        if not plain:
            raise ValueError(f"not a plain merge-type model with byte fallback: {path}")
        self.end_id = trainer.eos_id
        self.ids, self.scores, self.bytes, byte_ids = {}, {}, [], {}
        for k, piece in enumerate(proto.pieces):
            shown = b""
            if piece.type == _NORMAL:
                self.ids[piece.piece], self.scores[piece.piece] = k, piece.score
                shown = piece.piece.replace(BLANK, " ").encode()
            elif piece.type == _BYTE:
                value = int(piece.piece[3:5], 16)
                byte_ids[value], shown = k, bytes([value])
            elif piece.type == _UNKNOWN:
                shown = trainer.unk_surface.encode()
            self.bytes.append(shown)
        self.byte_ids = [byte_ids[k] for k in range(256)]
        self._pairs: dict[tuple[str, str], bool] = {}
        self._wholes: dict[str, str] = {}
        self._matcher = ahocorasick.Automaton()
        for piece in self.ids:
            self._matcher.add_word(piece, len(piece))
        self._matcher.make_automaton()
        self._set_neighbours()

    def _set_neighbours(self) -> None:
        """A table of the character pairs that meet inside a piece (bits, by small numbers)."""
        signs = sorted({ord(c) for piece in self.ids for c in piece})
        self._number = np.zeros(0x110000, dtype=np.uint16)
        self._number[signs] = np.arange(1, len(signs) + 1)
        self._width = len(signs) + 1
        number = {c: k for k, c in enumerate(map(chr, signs), 1)}
        meet = {number[a] * self._width + number[b] for piece in self.ids for a, b in zip(piece, piece[1:], strict=False)}
        bits = np.zeros(self._width * self._width, dtype=bool)
        bits[list(meet)] = True
        self._meet = np.packbits(bits, bitorder="little")

    def cuts(self, texts: textarrow.Texts) -> np.ndarray:
        """Byte positions where stretches begin, with the end; each text begins one."""
        data = texts.data
        if not len(data):
            return np.zeros(1, dtype=np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        at_byte = np.flatnonzero((data & 0xC0) != 0x80)
        number = self._number[points].astype(np.int64)
        key = number[:-1] * self._width + number[1:]
        apart = np.ones(len(points), dtype=bool)
        apart[1:] = (self._meet[key >> 3] >> (key & 7).astype(np.uint8)) & 1 == 0
        begins = texts.offsets[:-1]
        apart[np.searchsorted(at_byte, begins[begins < len(data)])] = True
        return np.append(at_byte[apart], len(data))

    def merge(self, text: str) -> list[str]:
        """The definition: join the best pair, leftmost first, until none is a piece."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, left: str, right: str) -> bool:
        known = self._pairs.get((left, right))
        if known is None:
            if len(self._pairs) >= CACHE_PAIRS:
                self._pairs.clear()
            known = self._pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def _whole(self, start: str) -> str:
        """The longest prefix of ``start`` that merging its own characters gives back."""
        known = self._wholes.get(start)
        if known is None:
            known = start
            while len(known) > 1 and not (known in self.ids and self.merge(known) == [known]):
                known = known[:-1]
            self._wholes[start] = known  # bounded: prefixes of pieces
        return known

    def pieces(self, text: str) -> list[str]:
        """The pieces of a stretch, by backtracking."""
        if len(text) == 1:
            return [text]
        wholes, pairs = self._wholes, self._pairs
        longest = [1] * len(text)
        for end, length in self._matcher.iter(text):
            longest[end + 1 - length] = length  # ends come in order
        failed = bytearray(len(text) // 8 + 1)
        done: list[str] = []
        at = 0
        start = text[:longest[0]]  # what the next piece is a prefix of
        while at < len(text):
            piece = wholes.get(start) or self._whole(start)
            while piece:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (not done or pairs.get((done[-1], piece)) or self._fits(done[-1], piece)):
                    break
                piece = self._whole(piece[:-1])
            if piece:
                done.append(piece)
                at += len(piece)
                start = text[at:at + longest[at]] if at < len(text) else ""
            else:  # nothing goes on from here: give the last piece up
                failed[at >> 3] |= 1 << (at & 7)
                last = done.pop()
                at -= len(last)
                start = last[:-1]
        return done

    def encode(self, text: str) -> bytes:
        """The ids of one stretch (32-bit integers)."""
        out = array.array("i")
        for piece in self.pieces(text):
            known = self.ids.get(piece)
            if known is None:
                out.extend([self.byte_ids[b] for b in piece.encode()])
            else:
                out.append(known)
        return out.tobytes()


@functools.lru_cache(maxsize=2)
def load_model(path: str) -> Model:
    return Model(path)


def _escaped(column: pa.Array) -> pa.Array:
    """Blanks as U+2581, and one before each text that is not empty."""
    column = pc.replace_substring(column.fill_null("").cast(pa.large_string()), " ", BLANK)
    return pc.if_else(pc.equal(column, ""), column, pc.binary_join_element_wise(pa.scalar(BLANK, pa.large_string()), column, pa.scalar("", pa.large_string())))


_CACHE: dict[str, dict[bytes, bytes]] = {}


def _ids(model: Model, path: str, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the distinct stretches one after the other, and their numbers."""
    cache = _CACHE.setdefault(path, {})
    out = []
    for stretch in distinct:
        found = cache.get(stretch)
        if found is None:
            found = model.encode(stretch.decode())
            if len(stretch) <= CACHE_LENGTH:
                if len(cache) >= CACHE_STRETCHES:
                    cache.clear()
                cache[stretch] = found
        out.append(found)
    sizes = np.fromiter(map(len, out), dtype=np.int64, count=len(out)) // 4
    return np.frombuffer(b"".join(out), dtype=np.int32), sizes


def _encode(path: str, at: int):
    """Batches with two columns more: ids with the end id, and the decoded bytes."""

    def run(batches):
        model = load_model(path)
        shown = pa.array(model.bytes, pa.large_binary())
        for batch in batches:
            for texts in textarrow.chunks(_escaped(batch.column(at)), GROUP_BYTES):
                bounds = model.cuts(texts)
                encoded = textarrow.pieces(texts.data, bounds).dictionary_encode()
                codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                pool, sizes = _ids(model, path, encoded.dictionary.to_pylist())
                begin = np.cumsum(sizes) - sizes
                # one stretch more stands at each text's end: the end id
                first = np.searchsorted(bounds[:-1], texts.offsets)
                begin, sizes = np.append(begin, len(pool)), np.append(sizes, 1)
                pool = np.append(pool, np.int32(model.end_id))
                codes = np.insert(codes, first[1:], len(sizes) - 1)
                first = first + np.arange(len(first))
                ends = np.concatenate([[0], np.cumsum(sizes[codes])])
                ids = pool[np.repeat(begin[codes] - ends[:-1], sizes[codes]) + np.arange(ends[-1])]
                offsets = ends[first]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                columns = [c.slice(texts.first, len(texts)) for c in batch.columns]
                columns += [lists, _decoded(shown, ids, offsets)]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{k}" for k in range(len(columns))])

    return run


def _decoded(shown: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The bytes of the ids of each row joined, without one blank at the front."""
    joined = shown.take(pa.array(ids))
    buffers = joined.buffers()
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    ends = np.frombuffer(buffers[1], dtype=np.int64)[:len(ids) + 1][offsets]
    filled = ends[1:] > ends[:-1]
    dropped = ends[:-1][filled][data[ends[:-1][filled]] == 0x20]
    sizes = np.diff(ends)
    sizes[np.isin(ends[:-1], dropped) & filled] -= 1
    kept = np.delete(data[:ends[-1]], dropped)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(kept)])


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with token_ids (array<int>, the end id last), n_tokens and decoded (string)."""
    prepare(docs.sparkSession)
    docs = docs.select(*[c for c in docs.columns if c not in ("token_ids", "n_tokens", "decoded")])
    fields = [T.StructField(f"c{k}", f.dataType) for k, f in enumerate(docs.schema.fields)]
    fields += [T.StructField(f"c{len(fields)}", T.ArrayType(T.IntegerType())), T.StructField(f"c{len(fields) + 1}", T.BinaryType())]
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    out = plain.mapInArrow(_encode(model_path, docs.columns.index("text")), T.StructType(fields)).toDF(*docs.columns, "token_ids", "decoded")
    return out.select(*docs.columns, "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), F.decode("decoded", "UTF-8").alias("decoded"))


def op11_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    out = encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id", "n_tokens",
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
