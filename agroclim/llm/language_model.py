"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

The word before last and the last word predict the next: R1, R2 hold the words' context
vectors, Q their target vectors with the bias as last column. Every training token
counted ``MIN_COUNT`` times or more has its own rows, so the vocabulary grows with the
corpus; rarer ones share ``RARE`` classes, dealt by their last bytes, and get their class's
probability times their share of it, (c + 1) / (N_class + V_class + 1).

Above ``FLAT`` rows the probability is factored: rows, most frequent first, are cut into
groups of ``fan`` (about the cube root), these again, and P(w | u, v) is the product of the
softmax of each of the three levels over the members of w's group there, all with own rows
of Q. Each normaliser is a batched matrix product per group over the tokens that meet it.
The probabilities of all tokens, an unknown one per class included, sum to at most one.

1. Tokens of the training documents are counted (per Arrow batch, then by key).
2. Every partition trains the model on all its texts from the same start by AdaGrad
   on noise-contrastive estimation at each level (numpy) and gives the changes of the rows
   it met; Spark averages them per block of rows, weighted by how often each was met.
   This repeats ``ROUNDS`` times, each from the means of the last: on held-out documents a
   third round gains nothing more.
3. One pass scores all texts. Counts of the ``HOT`` most frequent tokens are broadcast,
   a bound in number and bytes; rarer tokens leave as (doc, word, n), meet their counts
   in a join and are added per document.

Defined cases: a null or empty text is the end token alone; a null doc_id's text form
is taken as empty (its remainder is 0, so it trains); repeated rows are counted and scored
each; an empty table gives none; without training documents all counts are 0.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroclim.llm import textarrow
from agroclim.llm.common import prepare, stored, table

FOLDS, HELD_OUT = 7, 2
MIN_COUNT = 16
FLAT = 1024
RARE = 64
SUFFIX = 3
WIDTH = 16
NOISE = 16  # per batch at the first level; below it NOISE_OF_GROUP for each token
NOISE_OF_GROUP = 2
BATCH = 8192
RATE = 0.2
ROUNDS = 2
BLOCK = 2048
SCORE_BYTES = 4 << 20
HOT = 1 << 19
HOT_BYTES = 48
END = b" "  # no word holds a blank


def remainder():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def _count(batches):
    for batch in batches:
        tables = []
        for texts in textarrow.chunks(batch.column(0)):
            values, codes, _ = textarrow.word_codes(texts, lower=True)
            tables.append(pa.table({"word": values, "n": np.bincount(codes, minlength=len(values))}))
        tables.append(pa.table({"word": pa.array([END], pa.binary()), "n": np.array([batch.num_rows])}))
        merged = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
        yield from merged.rename_columns(["word", "n"]).select(["word", "n"]).to_batches(max_chunksize=50_000)


def token_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n) over all texts, one end token each."""
    return docs.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _small(rng: np.random.Generator, shape: tuple[int, int]) -> np.ndarray:
    out = rng.standard_normal(shape, dtype=np.float32)
    out *= np.float32(0.05)
    return out


class Model:
    """Parameters for V rows: classes of rare tokens, the vocabulary, last the start (never a target)."""

    def __init__(self, counts: np.ndarray, seed: int = 1):
        v = len(counts)
        rng = np.random.default_rng(seed)
        self.noise = (counts + 1.0) / (counts + 1.0).sum()
        self.fan = v if v <= FLAT else math.ceil(v ** (1 / 3))
        self.strides = [1] if v <= FLAT else [self.fan**2, self.fan, 1]
        self.r1, self.r2 = (_small(rng, (v, WIDTH)) for _ in range(2))
        self.q, self.mass = [], []
        for k, stride in enumerate(self.strides):
            mass = np.add.reduceat(self.noise, np.arange(0, v, stride))
            of_group = np.add.reduceat(mass, np.arange(0, len(mass), self.fan)) if k else mass.sum()[None]
            bias = np.log(mass / np.repeat(of_group, self.fan if k else len(mass))[:len(mass)])
            self.q.append(np.column_stack([_small(rng, (len(mass), WIDTH)), bias.astype(np.float32)]))
            self.mass.append(mass)

    def arrays(self) -> list[np.ndarray]:
        return [self.r1, self.r2, *self.q]

    def load(self, arrays: list[np.ndarray]) -> None:
        self.r1, self.r2, *self.q = arrays

    def context(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """One vector per token, with a 1 for the bias."""
        out = np.empty((len(u), WIDTH + 1), dtype=np.float32)
        np.add(self.r1.take(u, axis=0), self.r2.take(w, axis=0), out=out[:, :WIDTH])
        out[:, WIDTH] = 1
        return out

    def group(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last member of each node's group."""
        n = len(self.q[level])
        if level == 0:
            return np.zeros_like(node), np.full_like(node, n)
        first = node // self.fan * self.fan
        return first, np.minimum(first + self.fan, n)

    def log_probability(self, u: np.ndarray, w: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logs of P(target | u, w), normalised exactly at every level."""
        order = np.argsort(target, kind="stable")  # brings the groups of every level together
        target, context = target[order], self.context(u[order], w[order])
        logs = np.zeros(len(target))
        for level, stride in enumerate(self.strides):
            node = target // stride
            first, past = self.group(level, node)
            heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(first) else []
            for a, b in zip(heads, [*heads[1:], len(first)], strict=True):
                q = self.q[level][first[a]:past[a]].T
                for c in range(a, b, BATCH):
                    d = min(c + BATCH, b)
                    scores = context[c:d] @ q
                    top = scores.max(1)
                    wanted = scores[np.arange(d - c), node[c:d] - first[a]]
                    scores -= top[:, None]
                    np.exp(scores, out=scores)
                    logs[c:d] += wanted - top - np.log(scores.sum(1))
        out = np.empty(len(target))
        out[order] = logs
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Of a model of one level, log P(w | u, v) = M1[u, w] + M2[v, w] - Z[u, v]: both tables and Z, natural logs."""
        r1, r2, q, b = (x.astype(np.float64) for x in (self.r1, self.r2, self.q[-1][:, :WIDTH], self.q[-1][:, WIDTH]))
        m1 = r1 @ q.T
        m2 = r2 @ q.T + b
        top1, top2 = m1.max(1, keepdims=True), m2.max(1, keepdims=True)
        z = np.log(np.exp(m1 - top1) @ np.exp(m2 - top2).T) + top1 + top2.T
        return np.stack([m1, m2]).astype(np.float32), z.astype(np.float32)


class Trainer:
    """AdaGrad on noise-contrastive estimation, with one sum of squares a row; only the rows that a batch meets are touched."""

    def __init__(self, model: Model, seed: int):
        self.m, self.rng, self.tokens = model, np.random.default_rng(seed), 0
        self.sums = [np.full(len(x), 0.1, dtype=np.float32) for x in model.arrays()]
        self.met = [np.zeros(len(x), dtype=np.float32) for x in model.arrays()]
        self.slot = np.zeros(max(map(len, model.arrays())), dtype=np.int32)

    def _update(self, which: int, at: np.ndarray, rows: np.ndarray) -> None:
        """Add up ``rows`` by their place ``at`` and take a step there."""
        n = len(at)
        self.slot[at] = np.arange(n, dtype=np.int32)
        held = self.slot.take(at)  # one occurrence stands for all of its place
        stands = np.zeros(n, dtype=bool)
        stands[held] = True
        number, place = (np.cumsum(stands) - 1).take(held), at[stands]
        gradient = np.empty((len(place), rows.shape[1]), dtype=np.float32)
        for k in range(rows.shape[1]):
            gradient[:, k] = np.bincount(number, rows[:, k], len(place))
        self.met[which][place] += np.bincount(number, minlength=len(place))
        sums = self.sums[which].take(place) + np.einsum("ij,ij->i", gradient, gradient) / np.float32(gradient.shape[1])
        self.sums[which][place] = sums
        gradient *= (RATE / np.sqrt(sums))[:, None]
        table = self.m.arrays()[which]
        gradient += table.take(place, axis=0)
        table[place] = gradient

    def step(self, u: np.ndarray, w: np.ndarray, target: np.ndarray) -> None:
        m = self.m
        context = m.context(u, w)
        g_context, updates = np.zeros((len(target), WIDTH), dtype=np.float32), []
        for level, stride in enumerate(m.strides):
            q, node = m.q[level], target // stride
            wanted = q.take(node, axis=0)
            if level == 0:
                noise = self.rng.choice(len(q), NOISE, p=m.mass[0])
                log_noise = np.log(NOISE * m.mass[0]).astype(np.float32)
                own, drawn = log_noise[node], log_noise[noise]
                fake = 1 / (1 + np.exp(-(context @ q[noise].T - drawn)))
                pull = fake @ q[noise]
            else:
                first, past = m.group(level, node)
                noise = first[:, None] + (self.rng.random((len(node), NOISE_OF_GROUP), dtype=np.float32) * (past - first)[:, None]).astype(np.int64)
                noise = np.minimum(noise, past[:, None] - 1)
                own = np.log(NOISE_OF_GROUP / (past - first)).astype(np.float32)
                other = q.take(noise, axis=0)
                fake = 1 / (1 + np.exp(-(np.einsum("ij,ikj->ik", context, other) - own[:, None])))
                pull = np.einsum("ik,ikj->ij", fake, other)
            up = 1 - 1 / (1 + np.exp(-(np.einsum("ij,ij->i", context, wanted) - own)))
            g_context += (up[:, None] * wanted - pull)[:, :WIDTH]
            rows = np.empty((len(node) + noise.size, WIDTH + 1), dtype=np.float32)  # of the tokens, then of the noise
            np.multiply(up[:, None], context, out=rows[:len(node)])
            if level == 0:
                np.matmul(-fake.T, context, out=rows[len(node):])
            else:
                np.multiply(-fake[:, :, None], context[:, None, :], out=rows[len(node):].reshape(len(node), -1, WIDTH + 1))
            updates.append((level + 2, np.concatenate([node, noise.ravel()]), rows))
        for update in [(0, u, g_context), (1, w, g_context), *updates]:
            self._update(*update)
        self.tokens += len(target)


def _rare_class(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % RARE


def _classes(texts: textarrow.Texts, place: dict[bytes, int], end: int, start: int):
    """The texts' words as codes into values, then per token, ends included: class, the two classes before, text."""
    values, codes, first = textarrow.word_codes(texts, lower=True)
    listed = values.to_numpy(zero_copy_only=False).tolist()
    found = map(place.get, listed)
    of_value = np.fromiter((_rare_class(x) if k is None else k for x, k in zip(listed, found, strict=True)), np.int64, len(listed))
    n = len(texts)
    counts = np.diff(first) + 1
    begins = np.concatenate([[0], np.cumsum(counts)])
    token = np.full(begins[-1], end, dtype=np.int64)
    is_word = np.ones(begins[-1], dtype=bool)
    is_word[begins[1:] - 1] = False
    token[is_word] = of_value.take(codes)
    before = np.concatenate([[start], token[:-1]])
    before[begins[:-1]] = start
    second = np.concatenate([[start], before[:-1]])
    second[begins[:-1]] = start
    return values, codes, is_word, token, second, before, np.repeat(np.arange(n), counts)


def _train(name: str, shared):
    def run(batches):
        place, counts, arrays = _loaded(name, shared)
        end, start = place[END], len(counts) - 1
        model = Model(counts)
        for x, x0 in zip(model.arrays(), arrays or [], strict=bool(arrays)):
            x[:] = x0
        trainer = Trainer(model, 7)
        for batch in batches:
            for texts in textarrow.chunks(batch.column(0)):
                *_, token, second, before, _ = _classes(texts, place, end, start)
                order = trainer.rng.permutation(len(token))
                for k in range(0, len(order), BATCH):
                    own = order[k:k + BATCH]
                    trainer.step(second[own], before[own], token[own])
        origin = arrays or Model(counts).arrays()  # the start, made anew: it was not kept while training
        for which, (x, x0, met) in enumerate(zip(model.arrays(), origin, trainer.met, strict=True)):
            for first in range(0, len(x), BLOCK):
                at = np.flatnonzero(met[first:first + BLOCK])
                if len(at):
                    change = (x[first + at] - x0[first + at]).astype(np.float16)
                    values = [which, first, at.astype(np.int16).tobytes(), met[first + at].tobytes(), change.tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(values, _CHANGED, strict=True)], schema=_CHANGED)

    return run


_CHANGED = pa.schema([("which", pa.int32()), ("first", pa.int32()), ("at", pa.binary()), ("met", pa.binary()), ("change", pa.binary())])


def _mean(group: pa.Table) -> pa.Table:
    """The mean change of a block of rows, weighted by how often each partition met a row."""
    total, weight = None, np.zeros(BLOCK)
    for at, met, change in zip(*(group.column(c).to_pylist() for c in ("at", "met", "change")), strict=True):
        at, met = np.frombuffer(at, np.int16), np.frombuffer(met, np.float32).astype(np.float64)
        change = np.frombuffer(change, np.float16).reshape(len(at), -1).astype(np.float64)
        if total is None:
            total = np.zeros((BLOCK, change.shape[1]))
        total[at] += met[:, None] * change
        weight[at] += met
    total /= np.maximum(weight, 1)[:, None]
    return pa.table({"which": group.column("which").slice(0, 1), "first": group.column("first").slice(0, 1), "change": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, place: dict[bytes, int], counts: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The model averaged over partitions that each learn from all their texts."""
    model, arrays = Model(counts), None
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast((place, counts, arrays))
        learnt = docs.select("text").mapInArrow(_train(_name(docs, shared), shared), "which int, first int, at binary, met binary, change binary")
        means = learnt.groupBy("which", "first").applyInArrow(_mean, "which int, first int, change binary")
        arrays = model.arrays()
        for which, first, change in zip(*(c.to_pylist() for c in means.toArrow().columns), strict=True):  # one row per block of parameters
            own = arrays[which][first:first + BLOCK]
            own += np.frombuffer(change, np.float32).reshape(BLOCK, -1)[:len(own)]
        shared.unpersist()
    return model


_LOADED: dict[str, tuple] = {}  # the last broadcast of this worker


def _name(docs: DataFrame, shared) -> str:
    return f"{docs.sparkSession.sparkContext.applicationId}-{shared._jbroadcast.id()}"


def _loaded(name: str, shared) -> tuple:
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = shared.value
    return _LOADED[name]


_SCORED = "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, words array<binary>, times array<long>"


def _score(name: str, shared):
    def run(batches):
        place, model, hot_words, hot_base, hot_rare, end_base, start = _loaded(name, shared)
        end = place[END]
        for batch in batches:
            ids = batch.column(0)
            for texts in textarrow.chunks(batch.column(2), SCORE_BYTES):
                values, codes, is_word, token, second, before, owner = _classes(texts, place, end, start)
                n = len(texts)
                logp = model.log_probability(second, before, token)
                found = pc.index_in(values, value_set=hot_words)
                miss = np.asarray(found.is_null())
                at = found.fill_null(0).to_numpy(zero_copy_only=False)
                base, rare, seen = (np.where(miss, 0.0, x[at]) if len(x) else np.zeros(len(values)) for x in (hot_base, hot_rare, np.ones(len(hot_base))))
                doc_of_word = owner[is_word]
                sums = [np.bincount(doc_of_word, x[codes], n) for x in (base, rare, seen)]
                score = np.bincount(owner, logp, n) / math.log(10) + sums[1]
                cold = miss[codes]
                pair, times = np.unique(doc_of_word[cold] * (len(values) + 1) + codes[cold], return_counts=True)
                cut = np.searchsorted(pair // (len(values) + 1), np.arange(n + 1))
                word = values.take(pa.array(pair % (len(values) + 1)))
                offsets = pa.array(cut, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(texts.first, n), batch.column(1).slice(texts.first, n), pa.array(np.bincount(owner, minlength=n)), pa.array(sums[2].astype(np.int64) + (end_base[1] > 0)),
                     pa.array(sums[0] + end_base[0]), pa.array(score), pa.ListArray.from_arrays(offsets, word), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                    names=["doc_id", "held_out", "n_tokens", "known", "base", "score", "words", "times"])

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) from (doc_id, text)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long"), (remainder() == HELD_OUT).alias("held_out"), "text")
    training = rows.filter("not held_out")
    counts = stored(token_counts(training))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n_all, v_all = int(total["n"]), int(total["v"])
    hot = counts.filter(F.length("word") <= HOT_BYTES).orderBy(F.desc("n"), "word").limit(HOT).toArrow()  # bounded
    hot_words, hot_counts = hot.column("word").combine_chunks(), hot.column("n").to_numpy()
    listed = counts.filter((F.col("n") >= MIN_COUNT) & (F.col("word") != F.lit(END))).orderBy(F.desc("n"), "word").toArrow()  # the vocabulary
    top, n_top = listed.column("word").to_pylist(), listed.column("n").to_numpy()
    place = {END: RARE} | {w: k for k, w in enumerate(top, RARE + 1)}
    ends = counts.filter(F.col("word") == F.lit(END)).first()
    n_end = int(ends["n"]) if ends else 0
    rare_class = F.pmod(F.crc32(F.substring("word", -SUFFIX, SUFFIX)), F.lit(RARE)).cast("int")
    n_rare, v_rare = np.zeros(RARE), np.zeros(RARE)
    for r in counts.groupBy(rare_class.alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():  # RARE rows
        n_rare[r["c"]], v_rare[r["c"]] = r["n"], r["v"]
    for w, n in [*zip(top, n_top.tolist(), strict=True), (END, n_end)]:
        n_rare[_rare_class(w)] -= n
        v_rare[_rare_class(w)] -= n > 0
    class_counts = np.concatenate([n_rare, [n_end], n_top, [0]])  # the last: start
    spread = n_rare + v_rare + 1
    model = train(training, place, class_counts)

    base = np.log10((hot_counts + 1) / (n_all + v_all + 1))
    rare = np.log10((hot_counts + 1) / spread[np.fromiter((_rare_class(w) for w in hot_words.to_pylist()), np.int64, len(hot_words))])
    rare[hot_counts >= MIN_COUNT] = 0.0  # these have their own rows
    end_base = (math.log10((n_end + 1) / (n_all + v_all + 1)), n_end)
    shared = spark.sparkContext.broadcast((place, model, hot_words, base, rare, end_base, len(class_counts) - 1))
    scored = rows.mapInArrow(_score(_name(docs, shared), shared), _SCORED).withColumn("row", F.monotonically_increasing_id())

    # Rarer tokens: a row each, and one of the document itself under a key that no word has.
    own = F.array(F.struct(F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary").alias("word"), F.lit(0).cast("long").alias("times")))
    each = scored.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "score", F.explode(F.concat(own, F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times")))).alias("w"))
    first = F.col("w.times") == 0
    each = each.select("row", F.col("w.word").alias("word"), F.col("w.times").alias("times"), *[F.when(first, F.col(c)).alias(c) for c in ("doc_id", "held_out", "n_tokens", "known", "base", "score")])
    each = each.join(counts, "word", "left")
    c = F.coalesce(F.col("n"), F.lit(0))
    out = each.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        (F.max("known") + F.sum(F.when(c > 0, F.col("times")).otherwise(0))).alias("n_known"),
        (F.max("base") + F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(n_all + v_all + 1))))).alias("base_score"),
        (F.max("score") + F.sum(F.when(c < MIN_COUNT, F.col("times")).otherwise(0) * F.log10((c + 1) / F.get(F.array(*[F.lit(float(x)) for x in spread]), rare_class)))).alias("score"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")


def op2_language_model(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
