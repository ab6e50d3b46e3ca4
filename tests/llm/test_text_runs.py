"""Ops 11 to 13 against the library and brute force on small tables, with the odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from agroclim.llm import collocations, periodic_runs, sentence_pieces
from agroclim.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, token_ids string, runs string, c0 string, n string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_texts(library):
    rng = random.Random(4)
    signs = " \n\tab▁é世😀,.'　 xyz the ing  0123\x00\x7f�"
    pieces = [library.id_to_piece(k) for k in range(259, 32000)]
    out = [None, "", " ", " " * 37, "x" + " " * 999 + "y", "a" * 50_000, "=-=-" * 5000, "<s> </s> <unk> <0x41>", "\x85　", "one", "one"]
    out += ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    out += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(700)]
    out.append(" ".join(rng.choice(pieces) for _ in range(40_000)))
    return out


@pytest.fixture(scope="module")
def rows(library):
    made = [(k, t, ["en", "de", None][k % 3], "x", "y", "z", "w") for k, t in enumerate(odd_texts(library))]
    return [*made, made[20], made[20], (None, "one  two", None, "x", "y", "z", "w")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def test_sentence_pieces_equal_the_library(spark, docs, rows, library):
    out = sentence_pieces.encode_documents(docs, MODEL)
    assert out.columns == ["doc_id", "text", "lang", "runs", "c0", "n", "token_ids", "n_tokens", "decoded"]
    got = Counter((r["doc_id"], r["text"], tuple(r["token_ids"]), r["n_tokens"], r["decoded"]) for r in out.collect())
    ids = library.encode([r[1] or "" for r in rows], add_eos=True)
    assert got == Counter((r[0], r[1], tuple(k), len(k), library.decode(k)) for r, k in zip(rows, ids, strict=True))
    assert sentence_pieces.encode_documents(docs.limit(0), MODEL).count() == 0


def test_backtracking_equals_merging():
    model = sentence_pieces.load_model(MODEL)
    rng = random.Random(9)
    pieces = list(model.ids)
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4)))
        assert model.pieces(text) == model.merge(text)


def test_sentence_pieces_query(spark, library):
    got = QUERIES["op11_sentence_pieces"](spark, "/root/testdata/sf0.001")
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    expected = {}
    for doc, text in texts.items():
        ids = library.encode(text, add_eos=True)
        expected[doc] = (doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert {r["doc_id"]: tuple(r) for r in got.collect()} == expected


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    path = tmp_path / "other.model"
    path.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        sentence_pieces.load_model(str(path))


def runs_by_definition(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            own = w[i:j + q]
            if len(own) >= max(6, 4 * q) and all(own[:-d] != own[d:] for d in range(1, q)):
                out.append((i, len(own), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(rng):
    n, kinds = rng.randint(0, 400), rng.choice([1, 2, 3, 5, 50])
    w = [f"w{rng.randrange(kinds)}" for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 8:
            a, p = rng.randrange(n), rng.choice([1, 2, 3, 7, 8, 9, 10, 15, 16, 17, 18, 25, 31, 32, 33, 34, 47, 64, 65, 70, 99])
            for i in range(a, min(n, a + rng.randint(p, 6 * p))):
                w[i] = w[a + (i - a) % p]
    return w


def test_runs_equal_the_definition():
    rng = random.Random(2)
    for _ in range(400):
        w = periodic_words(rng)
        numbers = np.array([hash(x) % 1000003 for x in w], dtype=np.int64)
        assert [tuple(r) for r in periodic_runs.find(numbers).tolist()] == runs_by_definition(w)
    # long ones: one word, a long period, a period with an inner repeat
    assert periodic_runs.find(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]
    assert periodic_runs.find(np.arange(300_000) % 7001).tolist() == [[0, 300_000, 7001]]
    inner = np.tile(np.concatenate([np.arange(50), np.arange(50), np.arange(60)]), 5)
    assert [0, 800, 160] in periodic_runs.find(inner).tolist()


def collapsed_by_definition(w, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_collapse_and_query_equal_brute_force(spark, tmp_path):
    rng = random.Random(6)
    texts = [None, "", " \n", "a", "b b b b b b", "b b b b b", "x y " * 40, "é " * 3000, "a\x85b " * 9]
    texts += [rng.choice([" ", "\n", "\t "]).join(periodic_words(rng)) for _ in range(150)]
    rows = [(k, t, "l", "x", "y", "z", "w") for k, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, "c c c c c c d", None, "x", "y", "z", "w")]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = periodic_runs.collapse_runs(docs)
    assert out.columns == ["doc_id", "text", "lang", "token_ids", "c0", "n", "runs", "collapsed"]
    got = Counter((r["doc_id"], r["text"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in out.collect())
    expected = Counter()
    for r in rows:
        w = WORD.findall(r[1] or "")
        runs = runs_by_definition(w)
        expected[(r[0], r[1], tuple(runs), collapsed_by_definition(w, runs))] += 1
    assert got == expected
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect())
    expected = Counter()
    for doc, text, *_ in rows:
        w = WORD.findall(text or "")
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else x for i, x in enumerate(w)]
        runs = runs_by_definition(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if runs else None
        expected[(doc, len(runs), *best, milli, sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(collapsed_by_definition(w, runs)))] += 1
    assert got == expected


def phrases_by_definition(rows, least):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            counts.update((lang, tuple(w[i:i + m])) for m in range(1, 6) for i in range(len(w) - m + 1))
    found = {k: f for k, f in counts.items() if len(k[1]) > 1 and f >= least}
    out = set()
    for (lang, w), a in found.items():
        inside = any(lang == other and len(v) > len(w) and 100 * f >= 100 * a and any(v[i:i + len(w)] == w for i in range(len(v))) for (other, v), f in found.items())
        if not inside:
            n = total[lang]
            score, _, left, right = min((1000 * a * n // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
            out.add((lang, " ".join(w), a, left, right, n, score))
    return out


def phrase_rows():
    rng = random.Random(8)
    words = "the of a la B é世 x\xa0y it's - of".split(" ")
    rows = [(None, "en"), ("", None), ("one", None), (" \t.,", "en"), ("Of the. of THE, of the\nof\tthe", "und")]
    for _ in range(150):
        rows.append((" ".join(rng.choice(words) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None])))
    return rows + [("alpha beta gamma delta epsilon zeta. " * 40, "fr")] * 3


@pytest.mark.parametrize("bits", [64, 9])
def test_collocations_equal_brute_force(spark, bits):
    rows = phrase_rows()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "text string, lang string, n string, phrase string").repartition(3)
    got = {tuple(r) for r in collocations.collocations(docs, least=12, print_bits=bits).collect()}
    expected = phrases_by_definition(rows, 12)
    assert len(expected) > 50
    assert got == expected


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(docs.limit(0)).count() == 0


def test_scores_beyond_64_bits_are_exact(spark):
    big = [(10**16 - 7, 10**15 + 3, 10**14 + 1, 10**15 + 9), (123456789012, 123456789012, 130000000000, 999999999999999)]
    df = spark.createDataFrame([(a, x, y, n) for a, x, y, n in big], "a long, l long, r long, n long")
    row = df.select(collocations.score().alias("s"), "a", "l", "r", "n").collect()
    assert [r["s"] for r in row] == [1000 * r["a"] * r["n"] // (r["l"] * r["r"]) for r in row]


def test_filter_has_no_false_negatives(spark):
    keys = [random.Random(1).getrandbits(64) - (1 << 63) for _ in range(5000)]
    made = collocations._filter(spark.createDataFrame([(k,) for k in keys], "key long"))
    assert made.holds(np.array(keys, dtype=np.int64).view(np.uint64)).all()
    others = np.random.default_rng(2).integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert made.holds(others).mean() < 0.01


def test_a_word_is_hashed_once_for_both_polynomials(monkeypatch):
    import pyarrow as pa
    import xxhash

    from agroclim.llm import textarrow

    hashed = []

    class Counted:
        def __getattr__(self, name):
            return lambda x, *more: hashed.append(x) or getattr(xxhash, name)(x, *more)

    monkeypatch.setattr(collocations, "xxhash", Counted())
    words = collocations.Words(next(textarrow.chunks(pa.array(["a b c A, b"]))))
    words.fingerprints(2, "a language")
    assert sorted(x for x in hashed if x != b"a language") == [b"a", b"b", b"c"]


def test_only_texts_pointed_at_are_cut_into_words_again(monkeypatch):
    import pyarrow as pa

    class Holds:
        def __init__(self, kept):
            self.kept = kept

        def holds(self, keys):
            return np.isin(keys, self.kept) if self.kept else np.ones(len(keys), dtype=bool)

    cut, whole = [], collocations.Words
    monkeypatch.setattr(collocations, "Words", lambda texts: cut.append(bytes(texts.data)) or whole(texts))
    batch = pa.RecordBatch.from_pydict({
        "text": ["a b, c", "d\te .;", "", " ,", "F", "g h"], "lang": ["en", "en", "en", "de", "de", "fr"],
        "text_hash": pa.array([9 << 32, 8 << 32, 7 << 32, -6 << 32, 5 << 32, 4 << 32]), "spot": pa.array([1, 2, 3, 4, 5, 6])})
    rows = pa.Table.from_batches(collocations._spelled(Holds([]), Holds([2, 5]), 2, 64)([batch])).to_pylist()
    assert cut == [b"d\te .;", b"F"]
    assert {r["lang"]: r["n"] for r in rows if r["length"] == 0} == {"en": 5, "de": 1, "fr": 2}
    assert {(r["lang"], r["pointer"], r["phrase"]) for r in rows if r["length"]} == {("en", 8, "d"), ("en", 8, "e"), ("en", 8, "d e"), ("de", 5, "f")}


def test_a_phrase_is_pointed_at_in_its_least_text():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["x", "x y", "x"], "lang": ["en"] * 3, "text_hash": pa.array([3 << 32, -2 << 32, 1 << 32])})
    (counted,) = collocations._count(1, None, 64)([batch])
    assert sorted(zip(counted.column("n").to_pylist(), counted.column("pointer").to_pylist(), strict=True)) == [(1, -2), (3, -2)]
