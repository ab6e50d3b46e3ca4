"""The operators against brute force on small tables: nulls, empty and long texts, repeats, clashing names."""

import base64
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from agroclim.llm import ann, bpe, boosting, language_model, line_dedup, minhash, mixing, mphf, pii, quality, textarrow, token_counts, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_tokens string, kept string, copies string, c0 string"


def texts():
    """Documents with near copies, shared lines, junk and odd cases."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeéß世 it's 12 +".split()) for _ in range(rng.randint(1, 6))) for _ in range(300)]
    out = [None, "", " \n\t ", "one", "one", "\n\nx\n", "a" * 5000, "<|endoftext|> it's <|endoftext|>", "\x85\u3000  '\u2019s  \n\n b"]
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            lines = [" ".join(copy[k:k + 9]) for k in range(0, len(copy), 9)]
            out.append("\n".join([*lines, rng.choice(["", " A Shared line of LICENSE ", "a shared line of license", "short"])]))
    out.append(" ".join(rng.choice(words) for _ in range(20000)))
    return out


@pytest.fixture(scope="module")
def rows():
    made = [(k, t, ["en", "de", None][k % 3], ["s1", "S2", None, "ä"][k % 4], k, "x", "y", "z", "w") for k, t in enumerate(texts())]
    return [*made, made[20], made[20], (None, "a shared line of license", "en", "s1", 1, "x", "y", "z", "w")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def as_set(values):
    return Counter(tuple(v) for v in values)


def test_splitters_agree_with_the_patterns():
    rng, pattern = random.Random(1), regex.compile(public_tokenizers.PATTERN)
    alphabet = "ab'srevtmld  \n\t 1²é世,!\u00a0\u3000\x85😀"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)] + [None, ""]
    for texts_ in textarrow.chunks(pa.array(made), 500):
        values, codes, first = textarrow.pretokens(texts_)
        plain, word, start = textarrow.words(texts_, lower=True)
        line, at, begin = textarrow.lines(texts_)
        for k in range(len(texts_)):
            text = made[texts_.first + k] or ""
            assert [values[c].as_py().decode() for c in codes[first[k]:first[k + 1]].tolist()] == pattern.findall(text)
            assert [plain[c].decode() for c in word[start[k]:start[k + 1]]] == WORD.findall(text.translate(LOWER))
            own = [line[c].as_py().decode().removesuffix("\n") if c >= 0 else "" for c in at[begin[k]:begin[k + 1]].tolist()]
            assert own == text.split("\n")


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def test_near_duplicates_equal_brute_force(docs, nothing, rows):
    sets = {r[0]: shingles(r[1], 4) for r in rows if r[0] is not None}
    root = {k: k for k in sets}

    def find(k):
        return k if root[k] == k else find(root[k])

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                low, high = sorted((find(x), find(y)))
                root[high] = low
    expected = [(r[0], len(shingles(r[1], 4)), None if r[0] is None else find(r[0]), r[0] is None or find(r[0]) == r[0]) for r in rows]
    got = minhash.near_duplicates(docs, 4)
    assert as_set(got.collect()) == as_set(expected)
    assert minhash.near_duplicates(nothing, 4).count() == 0
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns


def test_ids_with_several_texts_tie_their_links(spark):
    """Rows (1, X), (1, A), (5, A'), (7, X') with X~X' and A~A' are one component; so are chains of such ids."""
    def text(name, changed=None):
        return " ".join(f"{name}{k}" if k != changed else "other" for k in range(60))

    rows = [(1, text("x")), (1, text("a")), (5, text("a", 30)), (7, text("x", 30)), (9, text("z"))]
    rows += [(20, text("m")), (21, text("m")), (21, text("n")), (30, text("n", 10)), (30, text("o")), (12, text("o", 59))]
    rows += [(21, text("m")), (40, None), (40, text("q")), (41, text("q", 3))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for _ in range(2):
        got = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, 4).collect()}
        assert got == {(1, 1, True), (5, 1, False), (7, 1, False), (9, 9, True), (12, 12, True), (20, 12, False), (21, 12, False), (30, 12, False),
                       (40, 40, True), (41, 40, False)}
    kept = sorted((r["doc_id"], r["text"]) for r in minhash.drop_near_duplicates(docs).collect())
    assert kept == [(1, text("a")), (9, text("z")), (12, text("o", 59)), (40, text("q"))]
    bare = spark.createDataFrame([(3, None), (3, None), (None, "x y z"), (None, "x y z")], "doc_id long, text string")
    assert Counter(tuple(r) for r in minhash.drop_near_duplicates(bare).collect()) == Counter([(3, None), (None, "x y z"), (None, "x y z")])


def test_pairs_left_lose_no_link(spark):
    """A group of edited copies, most of them linked with few others, takes the bounded join of the pairs left."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(120)]
    texts_ = {}
    for doc in range(160):
        copy = list(base)
        for k in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = rng.choice(["x", "y", f"own{doc}_{k}"])
        texts_[doc] = " ".join(copy)
    sets = {doc: shingles(text, 4) for doc, text in texts_.items()}
    root = {doc: doc for doc in sets}

    def find(k):
        return k if root[k] == k else find(root[k])

    for x in sets:
        for y in range(x + 1, len(sets)):
            if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y]):
                low, high = sorted((find(x), find(y)))
                root[high] = low
    got = minhash.near_duplicates(spark.createDataFrame(list(texts_.items()), "doc_id long, text string"), 4)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {doc: find(doc) for doc in sets}


def test_profiles_bound_every_overlap(spark):
    rng = random.Random(3)
    texts_ = {doc: " ".join(f"w{k if rng.random() > 0.04 else rng.randrange(9999)}" for k in range(400)) for doc in range(12)}
    sets = {doc: shingles(text, 4) for doc, text in texts_.items()}
    made = {r["doc"]: r for r in minhash.profiles(spark.createDataFrame(list(texts_.items()), "doc long, text string"), 4).collect()}
    for x, own in sets.items():
        best = max(len(own & other) for y, other in sets.items() if y != x)
        assert x in made or 100 * best < 80 * len(own)
        for y in made:
            if x < y and x in made:
                p, q = made[x], made[y]
                common = min(p["above"], q["above"]) + sum(bin(p[f"level{k}"] & q[f"level{k}"] & (2**64 - 1)).count("1") for k in minhash.LEVELS)
                assert len(own & sets[y]) <= common <= min(p["shared"], q["shared"])


def test_components_join_chains(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (105, 101)]
    got = dict(minhash.components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(1, 41)}, 101: 100, 105: 100}


def test_line_dedup_equals_brute_force(docs, nothing, rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    holders = {}
    for r in rows:
        if r[0] is not None:
            for line in (r[1] or "").split("\n"):
                if len(key(line)) >= 10:
                    holders.setdefault(key(line), set()).add(r[0])
    expected = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if r[0] is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == r[0]]
        expected.append((r[0], None if r[1] is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    for bound in (line_dedup.INDEX_MAX_BYTES, 0):  # the index, and the join beyond its bound
        out = line_dedup.dedup_lines(docs, index_max_bytes=bound)
        assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
        assert as_set(out.select("doc_id", "text", "n_lines", "n_dropped").collect()) == as_set(expected)
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_perfect_hash_finds_its_keys_and_no_others():
    rng = np.random.default_rng(1)
    high, low = rng.integers(0, 1 << 63, (2, 20000)).astype(np.uint64)
    index = mphf.Index(**mphf.build(high[:15000], low[:15000], np.arange(15000)))
    found, value = index.find(high, low)
    assert found[:15000].all() and not found[15000:].any() and (value[:15000] == np.arange(15000)).all()


def test_quality_figures_and_bounds(spark, docs, nothing, rows):
    got = quality.measured(docs.select("doc_id", "lang", "text")).select("c0", *quality.BASE).collect()
    expected = []
    for r in rows:
        t = r[1] or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        grams = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        cover = {k + j for k in range(len(w) - 7) if grams[tuple(w[k:k + 8])] > 1 for j in range(8)}
        expected.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)))
    assert as_set(got) == as_set(expected)
    # the exact bound: the binomial probability of so few is the risk there
    p = quality.upper_bound(3, 200, 0.01)
    assert math.isclose(sum(math.comb(200, k) * p**k * (1 - p) ** (200 - k) for k in range(4)), 0.01, rel_tol=1e-6)
    good, bad = np.zeros(101), np.zeros(101)
    good[5], bad[60] = 5000, 300
    assert quality.choose(good, bad, 0.001) in range(6, 61)
    assert quality.choose(good[:] * 0.01, bad, 0.001) is None  # too few labels
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    kept = quality.quality_filter(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {e[0] for e in expected if e[1] >= 20 and 100 * e[5] <= 30 * e[1]}
    assert quality.quality_filter(nothing, labels).count() == 0


def test_mixing_comes_near_targets(spark, nothing):
    rows = [(k, "w " * (1 + k % 7), ["b", "a", None, "B"][k % 4]) for k in range(4000)] + [(9999, None, "z"), (None, "x", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = docs.select("source", mixing.word_count(F.col("text")).alias("size"))
    target = {r["source"]: (r["source_size"], r["target"]) for r in mixing.source_targets(sized).collect()}
    total = sum(n for n, _ in target.values())
    assert math.isclose(sum(t for _, t in target.values()), 1.5 * total) and all(t <= 2 * n for n, t in target.values())
    taken = Counter()
    for r in mixing.mix(docs).collect():
        taken[r["source"]] += len((r["text"] or "").split())
    for source, (n, t) in target.items():
        assert abs(taken[source] - t) <= 0.1 * n + 1
    assert target["z"] == (0, 0.0)
    assert mixing.mix(nothing).count() == 0 and mixing.mix(nothing).columns == nothing.columns


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_and_comes_back(docs, nothing, rows):
    enc = encoding()
    for hot in (bpe.HOT_WORDS, 3):
        got = bpe.encode(docs.select(F.col("doc_id").alias("doc"), "text"), RANKS, hot=hot).collect()
        assert as_set((r["doc"], tuple(r["ids"]), bytes(r["decoded"])) for r in got) == as_set((r[0], tuple(enc.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in rows)
    out = bpe.encode_documents(docs, RANKS)
    assert all((r["text"] or "") == r["decoded"] and r["n_tokens"] == len(r["token_ids"]) for r in out.collect())
    assert bpe.encode_documents(nothing, RANKS).count() == 0


def test_pairs_are_dealt_as_spark_hashes(spark):
    pairs = [chr(bpe._BASE + a) + chr(bpe._BASE + b) for a, b in ((0, 0), (1, 256), (50_000, 7), (32, 49_999))]
    got = spark.createDataFrame([(x,) for x in pairs], "x string").select("x", F.hash("x")).collect()
    assert dict(map(tuple, got)) == dict(zip(pairs, bpe._hashed(pairs).tolist(), strict=True))


def test_the_map_is_short_in_plans(spark):
    folded = bpe.encode_words(spark.createDataFrame([(b"folded",)], "word binary"), RANKS)
    shown = folded._jdf.queryExecution().optimizedPlan().toString()
    assert len(shown) < 1_200_000 and max(map(ord, shown)) < bpe._WIDE_BASE
    wide = [chr(bpe._WIDE_BASE + a) + chr(bpe._WIDE_BASE + b) for a, b in ((0, 0), (60_000, 7))]
    got = spark.createDataFrame([(x,) for x in wide], "x string").select(F.hash("x")).collect()
    assert [r[0] for r in got] == bpe._hashed(wide).tolist()
    assert bpe._base({b"a": 0, b"b": 60_000}) == bpe._WIDE_BASE


def test_hot_words_fold_without_a_shuffle_in_their_plan(docs):
    hot = bpe.hot_words(docs, RANKS, 1000)
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "transform(" in plan and "Exchange" not in plan and "AdaptiveSparkPlan" not in plan
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    got = hot.collect()
    assert 0 < len(got) <= 1000
    assert all(r["ids"] == library._encode_single_piece(bytes(r["word"])) for r in got)


def test_long_words_fold_as_the_library_does(spark):
    rng, enc = random.Random(3), encoding()
    words = ["a" * n for n in (1, 2, 63, 64, 65, 66, 1001)] + ["".join(rng.choice("aab") for _ in range(rng.choice([10, 70, 400]))) for _ in range(60)]
    frame = spark.createDataFrame([(w.encode(), w) for w in words], "word binary, t string")
    assert all(r["ids"] == enc.encode_ordinary(r["t"]) for r in bpe.encode_words(frame, RANKS).collect())


def test_token_counts_equal_the_library(docs, nothing, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = token_counts.count_tokens(docs, path)
    expected = [(r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows]
    assert as_set(got.select("doc_id", "n_bytes", "n_tokens").collect()) == as_set(expected)
    assert token_counts.count_tokens(nothing, path).count() == 0


def test_near_duplicates_leave_one_row_of_a_doc_id(docs, rows, spark):
    left = minhash.drop_near_duplicates(docs).collect()
    ids = Counter(r["doc_id"] for r in left if r["doc_id"] is not None)
    assert ids[20] <= 1 and set(ids.values()) == {1}
    assert sum(r["doc_id"] is None for r in left) == sum(r[0] is None for r in rows)
    made = [(1, "b c d e f g h"), (1, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (2, None), (None, "x"), (None, "x")]
    frame = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    assert as_set(minhash.drop_near_duplicates(frame).collect()) == as_set([(1, "a b c d e f g"), (2, None), (None, "x"), (None, "x")])


def test_language_model_base_and_normalisation(docs, nothing, rows):
    tokens = [(r[0], [*WORD.findall((r[1] or "").translate(LOWER)), " end"]) for r in rows]
    held = [zlib.crc32(str("" if k is None else k).encode()) % 7 == 2 for k, _ in tokens]
    counts = Counter(w for (_, ws), h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = language_model.score_documents(docs).collect()
    expected = Counter((k, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4)) for (k, ws), h in zip(tokens, held, strict=True))
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == expected
    assert all(r["score"] < 0 for r in got)
    assert language_model.score_documents(nothing).count() == 0
    model = language_model.Model(np.arange(40.0))
    trainer = language_model.Trainer(model, 1)
    rng = np.random.default_rng(2)
    u = rng.integers(0, 39, 4000)
    for _ in range(60):
        trainer.step(u, u, (u * 7) % 39)
    tables, z = model.tables()
    logp = tables[0][:, None, :] + tables[1][None, :, :] - z[:, :, None]
    assert np.allclose(np.exp(logp).sum(2), 1, atol=1e-4)  # the start class takes its share too
    assert (logp[u, u, (u * 7) % 39].mean()) > np.log(model.noise)[(u * 7) % 39].mean() + 0.5


def test_language_model_gives_every_counted_token_its_own_rows(spark):
    # Far more words than any fixed list held, alike in their last bytes; each is followed by one other word.
    n = 1500
    word = [f"w{k:04d}zzz" for k in range(n)]
    follower = np.random.default_rng(1).permutation(n)
    rng = random.Random(3)
    made = [" ".join(x for _ in range(150) for k in [rng.randrange(n)] for x in (word[k], word[follower[k]])) for _ in range(600)]
    probe = [" ".join(x for k in range(0, n, 5) for x in (word[k], word[follower[(k + shift) % n]])) for shift in (0, 700)]
    held = [k for k in range(10000, 10100) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    frame = spark.createDataFrame([*enumerate(made), *zip(held, probe, strict=True)], "doc_id long, text string").repartition(2)
    got = {r["doc_id"]: r["score"] / r["n_tokens"] for r in language_model.score_documents(frame).filter(F.col("doc_id").isin(held)).collect()}
    assert got[held[0]] > got[held[1]] + 0.05


def test_language_model_rounds_learn_from_the_mean(spark):
    rng = random.Random(5)
    n = 200
    word = [f"v{k}" for k in range(n)]
    follower = np.random.default_rng(3).permutation(n)
    made = [(" ".join(x for _ in range(60) for k in [rng.randrange(n)] for x in (word[k], word[follower[k]])),) for _ in range(200)]
    frame = spark.createDataFrame(made, "text string").repartition(4)
    place = {language_model.END: language_model.RARE} | {w: k for k, w in enumerate((w.encode() for w in word), language_model.RARE + 1)}
    counts = np.concatenate([np.zeros(language_model.RARE), [200.0], np.full(n, 120.0), [0.0]])
    at = np.arange(n) + language_model.RARE + 1
    one, full = (language_model.train(frame, place, counts, *a).log_probability(np.roll(at, 1), at, at[follower]).mean() for a in ((1,), ()))
    assert full > one + 0.02


def test_language_model_factored_normalisation():
    n = 3001
    model = language_model.Model(np.arange(n, 0, -1.0))
    assert len(model.strides) == 3 and model.r1.shape == model.r2.shape == (n, language_model.WIDTH) and len(model.q[-1]) == n
    trainer = language_model.Trainer(model, 1)
    rng = np.random.default_rng(2)
    for _ in range(30):
        u = rng.integers(0, n, 4000)
        trainer.step(u, u, (u * 7) % n)
    for u, w in ((0, 1), (n - 1, 2), (1234, 3000)):
        logp = model.log_probability(np.full(n, u), np.full(n, w), np.arange(n))
        assert math.isclose(np.exp(logp).sum(), 1, abs_tol=1e-4)
        assert np.isfinite(logp).all()


def test_language_model_steps_without_sorting(monkeypatch):
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, **more: sorts.append(len(x)) or argsort(x, **more))
    n = 3001
    model = language_model.Model(np.arange(n, 0, -1.0))
    trainer = language_model.Trainer(model, 1)
    rng = np.random.default_rng(2)
    u, w, target = rng.integers(0, n, (3, 5000))
    trainer.step(u, w, target)
    assert not sorts
    model.log_probability(u, w, target)
    assert sorts == [5000]  # once for all levels
    # a step adds up the rows of one place: as one AdaGrad step on their sum
    at, rows = rng.integers(0, 40, 5000), rng.standard_normal((5000, language_model.WIDTH)).astype(np.float32)
    before, squares = model.r1[:40].astype(np.float64), trainer.sums[0][:40].astype(np.float64)
    total = np.zeros((40, language_model.WIDTH))
    np.add.at(total, at, rows.astype(np.float64))
    trainer._update(0, at, rows)
    assert np.allclose(model.r1[:40], before + language_model.RATE * total / np.sqrt(squares + (total**2).mean(1))[:, None], atol=1e-5)


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 1500)]
    x[7], x[9] = x[3], x[3] * 2
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(5000, None), (5001, [0.0] * 16), (5050, [float("nan")] * 16), (5100, [1.0]), (None, x[0].tolist()), (3, x[3].tolist()), (5150, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(frame, every=50).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        near = unit @ unit[q]
        near[q] = -9
        best = np.lexsort([np.arange(1500), -np.round(near, 12)])[:5]
        assert len(got[q]) == 5 and all(math.isclose(s, near[k], abs_tol=1e-12) for k, s in got[q])
        hits += len({k for k, _ in got[q]} & set(best.tolist()))
    assert set(got) == set(range(0, 1500, 50)) and hits >= 0.9 * 150
    few = {r["vec_id"] for r in ann.nearest(spark.createDataFrame(rows[:3], frame.schema), every=50).collect()}
    assert few == {1, 2}
    assert ann.nearest(frame.limit(0)).count() == 0


def test_url_rules_and_trees(spark):
    rows = [(0, None), (1, "nothing"), (2, "http://A.Net/x?y#z"), (3, "https://net"), (4, "x://planet/"), (5, "http://m.example.net/en/1"), (6, "http://example.net/enx"), (7, "http://q.org/fr/"), (7, "http://q.org/fr/")]
    out = sorted(tuple(r) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))).select("page_id", "host", "path", F.coalesce("rule", F.lit("-"))).collect())
    assert out == [(0, "", "", "-"), (1, "", "", "-"), (2, "a.net", "/x", "net/"), (3, "net", "", "-"), (4, "planet", "/", "-"), (5, "m.example.net", "/en/1", "example.net/en/"),
                   (6, "example.net", "/enx", "net/"), (7, "q.org", "/fr/", "org/fr/"), (7, "q.org", "/fr/", "org/fr/")]
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_suffix_of_one_rule_does_not_decide(spark):
    rng = random.Random(4)
    dirty = lambda: "".join(rng.choice("0123456789") for _ in range(30)) + "?a=1&b=2&c=3"
    clean = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 14)))
    rows = []
    for _ in range(400):  # the other features agree with the label nine times of ten, the suffix always
        rows.append((f"http://{clean()}.example.com/de/" + (dirty if rng.random() < 0.9 else clean)(), None))
        rows.append((f"http://{clean()}.example.org/fr/" + (clean if rng.random() < 0.9 else dirty)(), None))
    for _ in range(50):
        rows += [(f"http://{clean()}.example.com/es/" + clean(), "allow"), (f"http://{clean()}.example.org/es/" + dirty(), "block")]
    frame = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(frame).collect()}
    wanted = {k: v for k, (_, v) in enumerate(rows) if v}
    assert {k: got[k] for k in wanted} == wanted


def test_boosted_trees_as_a_column(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 2))
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5)).astype(float)
    model = boosting.train(x, y)
    assert ((boosting.scores(model, x) > 0) == (y > 0)).mean() > 0.97
    frame = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double")
    got = [r[0] for r in frame.select(boosting.score_column(model, [F.col("a"), F.col("b")])).collect()]
    assert np.allclose(got, boosting.scores(model, x))


def test_boosted_trees_count_every_row(spark):
    """Trees of profiles equal those of the rows, and a rare kind among many rows counts in full."""
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 6, 90_000), rng.integers(0, 4, 90_000)]).astype(float)
    y = (x[:, 0] == 5) & (x[:, 1] == 3) & (np.arange(len(x)) % 9 > 0)
    cuts = [boosting.COUNT_CUTS, boosting.COUNT_CUTS]
    rows = boosting.profile_counts(boosting.binned(x, cuts), positive=y.astype(np.int64), n=np.ones(len(x), np.int64))
    frame = spark.createDataFrame(rows.to_pandas(), "key binary, positive long, n long").repartition(7)
    model = boosting.train_profiles(frame, cuts)
    plain = boosting.train(x, y.astype(float))
    got, want = boosting.scores(boosting.unbinned(model, cuts), x), boosting.scores(plain, x)
    assert np.allclose(got, want, atol=1e-3)
    again = boosting.train_profiles(frame.repartition(3).groupBy("key").agg(F.sum("positive").alias("positive"), F.sum("n").alias("n")), cuts)
    assert np.allclose(boosting.scores(again, boosting.binned(x, cuts)), got, atol=1e-3)
    assert boosting.precise_threshold(model, frame, 2, 0.85) <= got.max() < boosting.precise_threshold(model, frame, 2, 0.95)


def test_personal_data_learns_from_every_candidate(spark, monkeypatch):
    """More candidates than the 20,000 of the former sample: each is counted once."""
    seen = []
    monkeypatch.setattr(boosting, "train_profiles", lambda profiles, cuts: seen.append(profiles.agg(F.sum("n")).first()[0]) or (0.0, []))
    monkeypatch.setattr(boosting, "precise_threshold", lambda model, profiles, *rest: seen.append(profiles.agg(F.sum("n")).first()[0]) or float("inf"))
    docs = spark.range(30_000).selectExpr("id as doc", "concat('on ', cast(2000000 + id as string), '-77 and a', id, '@b.example') as text")
    pii.fit(docs)
    assert sum(seen) == 60_000


def luhn(d):
    return sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for k, c in enumerate(reversed(d))) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
}


def test_personal_data_runs_no_python_on_rows(spark, monkeypatch):
    def none(self, *args, **kwargs):
        raise AssertionError("Python on the rows")

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", none)
    monkeypatch.setattr(type(spark.range(1)), "mapInPandas", none)
    lines = ["tel +1 555 010 9999", "token = \"a1b2c3d4e5f6g7h8i9\"", "card 4111 1111 1111 1111", "0123456789abcdef0123", "x@y.example", "12.34.56.789 at 123456789"]
    docs = spark.createDataFrame([(k, lines[k % 6] + " " * (k // 6) + str(k)) for k in range(240)], "doc long, text string")
    assert pii.spans(docs).count() == 240
    # Profiles are those of numpy's bins, changed base spans among them.
    at = {name: k for k, name in enumerate(pii.FEATURES)}
    rng = np.random.default_rng(4)
    x = np.floor(rng.gamma(1, 30, (400, len(at))))
    x[:, [at["at"], at["plus"], at["luhn"]]] = rng.integers(0, 2, (400, 3))
    x[:, at["length"]] += 2
    for name in ("digit_share", "hex_share"):
        x[:, at[name]] = rng.integers(0, 129, 400) / 128
    made = [(bool(k % 3 == 0), bool(k % 2), bool(k % 5), x[k].tolist()) for k in range(400)]
    frame = spark.createDataFrame(made, "held boolean, base boolean, label boolean, f array<double>")
    want = Counter()

    def add(held, base, label, f):
        key = boosting.binned(np.array([f]), pii.CUTS).tobytes()
        want[held, base, key, "n"] += 1
        want[held, base, key, "positive"] += int(label)

    for held, base, label, f in made:
        add(held, base, label, f)
        if base and not held and f[at["at"]] == 0:
            f = list(f)
            if f[at["plus"]] == 1:
                f[at["plus"]], f[at["length"]] = 0, f[at["length"]] - 1
                f[at["digit_share"]] = f[at["digits"]] / f[at["length"]]
                add(False, True, True, f)
            elif f[at["luhn"]] == 1 and f[at["groups"]] > 1:
                f[at["dots"]], f[at["blanks"]], f[at["dashes"]] = f[at["groups"]] - 1, 0, 0
                add(False, True, True, f)
    got = {(r.held, r.base, bytes(r.key)): (r.n, r.positive) for r in pii._profiled(frame).collect()}
    assert got == {k[:3]: (want[k], want[*k[:3], "positive"]) for k in list(want) if k[3] == "n"}


def test_personal_data_base_equals_brute_force(spark, nothing):
    rng = random.Random(2)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "256.1.1.1", "001.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+49 30 1", "é世", "12 34 56", "\n", "mail:", "5" * 40, "+", "--", "7.7"]
    made = [None, "", "1 " * 30000] + ["".join(rng.choice([*parts, " "]) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(made)), "doc long, text string")
    out = pii.spans(frame)
    got = {r["doc"]: r for r in out.select("doc", *[F.transform(f"base_{k}", lambda x: F.concat_ws(":", x["s"], x["e"])).alias(k) for k in BASE], "added").collect()}
    for k, text in enumerate(made):
        spans = {kind: [f"{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if ok(m.group())] for kind, (p, ok) in BASE.items()}
        assert {kind: got[k][kind] for kind in BASE} == spans, text
        taken = [tuple(map(int, s.split(":"))) for own in spans.values() for s in own]
        assert all(not (a < x["e"] and x["s"] < b) for x in got[k]["added"] for a, b in taken)
    taken = pii.spans(frame).select("doc", pii._listed(False).alias("base"), pii._listed(True).alias("spans")).collect()
    for r in taken:  # the listed strings, by definition
        own = {kind: [(m.start(), m.end()) for m in re.finditer(p, made[r["doc"]] or "") if ok(m.group())] for kind, (p, ok) in BASE.items()}
        assert r["base"] == ",".join(f"{kind}:{a}:{b}" for kind in BASE for a, b in own[kind])
        for x in got[r["doc"]]["added"]:
            own.setdefault(x["kind"], []).append((x["s"], x["e"]))
        assert r["spans"] == ",".join(f"{kind}:{a}:{b}" for kind in pii.ADDED_KINDS for a, b in sorted(own.get(kind, [])))
    docs = spark.createDataFrame([(1, "mail a.b@c.de now", "k")], "doc_id long, text string, doc string")
    assert [tuple(r) for r in pii.redact(docs).collect()] == [(1, "mail [email] now", "k")]
    assert pii.redact(nothing).count() == 0


def test_keys_and_loose_numbers_are_added(spark):
    """Spans outside the base patterns, planted among decoys: found, and the decoys left alone."""
    rng = random.Random(7)

    def card(valid):
        while True:
            number = "".join(rng.choice("0123456789") for _ in range(16))
            if luhn(number) == valid:
                return number

    rows, planted = [], {}
    for k in range(900):
        words = " ".join(rng.choice(["lorem", "ipsum", "verschiedenheiten", "uncharacteristically", "2024"]) for _ in range(20))
        hexes = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        number = card(True)
        dotted = ".".join(number[i:i + 4] for i in range(0, 16, 4))
        kinds = [("secret", f'token = "{hexes}"', hexes), (None, f"commit {hexes}", hexes), (None, f"order {card(False)}", None), ("card", f"visa {dotted}", dotted) if k % 3 else (None, "", None),
                 ("base", f"call +1 (743) 555-{k:04d}", None), ("base", f"mail a{k}@b.example", None), ("phone", f"tel 030 555 {k:04d} 77", f"030 555 {k:04d} 77"), (None, "on 2024-05-06 07:08:09", None)]
        kind, text, span = kinds[k % len(kinds)]
        rows.append((k, f"{words} then {text} and {words}"))
        planted[k] = (kind, span)
    docs = spark.createDataFrame(rows, "doc long, text string")
    text = dict(rows)
    hits = Counter()
    for r in pii.spans(docs).collect():
        kind, span = planted[r["doc"]]
        found = [(x["kind"], text[r["doc"]][x["s"]:x["e"]]) for x in r["added"]]
        if span and kind not in (None, "base"):
            hits[kind, found == [(kind, span)]] += 1
        elif kind is None:
            hits["decoy", not found] += 1
    for kind in ("secret", "phone", "card", "decoy"):
        assert hits[kind, True] >= 0.9 * (hits[kind, True] + hits[kind, False]), hits


def test_long_runs_are_read_once(spark):
    import time

    mega = 1 << 20
    made = ["a" * mega + " @", "a." * (mega // 2), "1" * mega, "1." * (mega // 2), "a@" + "b" * mega, "x" * mega + "@y.z", "+1" + " " * mega, "<" * mega]
    frame = spark.createDataFrame(list(enumerate(made)), "doc long, text string").repartition(len(made))
    begin = time.time()
    got = {r["doc"]: r for r in pii.detected(frame).select("doc", *[F.size(f"base_{k}").alias(k) for k in BASE]).collect()}
    assert time.time() - begin < 120
    assert [got[k]["email"] for k in range(len(made))] == [0, 0, 0, 0, 0, 1, 0, 0]
    many = "a@b.cd " * 20_000
    row = pii.detected(spark.createDataFrame([(1, many)], "doc long, text string")).select(F.col("base_email")[19_999].alias("last"), F.size("base_email").alias("n")).first()
    assert row["n"] == 20_000 and (row["last"]["s"], row["last"]["e"]) == (7 * 19_999, 7 * 19_999 + 6)


def test_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from agroclim.llm.common import table

    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    stage = [docs]
    for name, run in corpus_pipeline.STAGES:
        stage.append(run(spark, stage[-1], sf).cache())
        assert name == "byte-level BPE" or stage[-1].columns == docs.columns
    passed, lined, single, mixed, encoded = stage[1:]

    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in passed.collect()}
    assert all(len(WORD.findall(text[k])) >= 20 for k in good)
    texts_ = {r["doc_id"]: r for r in lined.collect()}
    assert set(texts_) == good and all(r["n_chars"] == len(r["text"]) for r in texts_.values())
    left = {r["doc_id"]: r["text"] for r in single.collect()}
    sets = {k: shingles(r["text"], 5) for k, r in texts_.items()}
    linked = {k: {j for j in sets if j != k and sets[k] and 100 * len(sets[k] & sets[j]) >= 80 * len(sets[k] | sets[j])} for k in sets}
    for k in sets:
        group, todo = {k}, [k]
        while todo:
            for j in linked[todo.pop()] - group:
                group.add(j)
                todo.append(j)
        assert (k in left) == (k == min(group))
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert set(copies) <= set(left) and max(copies.values()) <= 2
    enc = encoding()
    final = encoded.collect()
    assert Counter(r["doc_id"] for r in final) == copies
    assert all(r["token_ids"] == enc.encode_ordinary(left[r["doc_id"]]) and r["decoded"] == left[r["doc_id"]] for r in final)


def test_plans_do_not_spell_out_the_map_of_merges(docs):
    frames = [bpe.hot_words(docs, RANKS, 1000), bpe.encode(docs.select(F.col("doc_id").alias("doc"), "text"), RANKS, hot=1000)]
    assert all(len(x._jdf.queryExecution().toString()) < 100_000 for x in frames)


def test_quality_filter_shuffles_no_text_to_learn(spark, docs, monkeypatch):
    seen, judged = [], quality.judged

    def spied(*args, learn_from):
        seen.append(learn_from)
        return judged(*args, learn_from=learn_from)

    monkeypatch.setattr(quality, "judged", spied)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    quality.quality_filter(docs, labels)
    assert "c1" not in seen[0].columns and "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_near_dedup_shuffles_no_text_where_ids_are_few(spark, docs, monkeypatch):
    frames, stored = [], minhash.stored

    def spied(df):
        frames.append(df)
        return stored(df)

    monkeypatch.setattr(minhash, "stored", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames.append(minhash.drop_near_duplicates(docs.filter("doc_id is not null").dropDuplicates(["doc_id"])))
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in frames if "text" in x.columns]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 2 and not any("SortMergeJoin" in plan or "ShuffledHashJoin" in plan for plan in plans)
