"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Texts are lower-cased (A-Z) and split at ASCII white space; a document's set holds the
hashes of its distinct shingles of ``width`` words (the whole sequence, if shorter).
Two documents are linked if their sets' Jaccard similarity is at least 80 %.

1. One pass makes, per document, the set's size, a 128-bit hash of the set and the
   signature: ``COORDINATES`` minima, each a 64-bit token of coordinate and value.
2. Equal sets are one class; the smallest doc_id stands for it. Copies are never paired.
3. Tokens are posted and counted. A token of one class alone can match nothing. Linked
   documents agree, but for ``miss`` below, in at least ``MATCHES`` tokens, so they
   share one among the rarest COORDINATES - MATCHES + 1 tokens of both (prefix); a class
   with fewer than ``MATCHES`` shared tokens is out, and frequent tokens are skipped.
4. Posting lists are merged by stars: every list pairs its smallest member (the pivot)
   with all others. A pair is kept if it agrees in at least ``MATCHES`` coordinates and its
   sizes allow the similarity, then confirmed on the full sets. Confirmed links contract
   the components. In further rounds a member of each list's largest component meets the
   members outside of it, as long as that at least halves the pairs left.
5. The pairs left, of members in different components, are all tested, but for those that
   a bound rules out, each in the first list that holds both. Agreement with the pivot and
   distance from it obey the triangle inequality, so a pair differing by more than
   COORDINATES - MATCHES in the one or more than 0.2 in the other cannot be linked. Two sets
   meet in no more shingles than either shares with any other text left, nor in more than
   the smaller counts of such shingles, summed over 64 buckets. The bounds are exact:
   nothing is capped and no link lost. The bounds are tested pair by pair inside the join.

The chance to miss a link of similarity 0.8 is that of a binomial (64, 0.8) below 36,
about 4e-6; links above 0.85 are missed with less than 1e-8.

Defined cases: documents without words (null or empty text) have an empty set and no
links; a null doc_id is linked with nothing and its own class; repeated rows of a doc_id
give equal rows if their texts are equal (else the doc_id stands in several classes and
takes the smallest component); ties go to the smaller doc_id; an empty table gives none.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroclim.llm import textarrow
from agroclim.llm.common import join_checked, prepare, stored, table

COORDINATES = 64
MATCHES = 36
PERCENT = 80
LEVELS = range(1, 9)

_SEEDS = np.random.default_rng(20).integers(1, 1 << 63, size=(COORDINATES, 2), dtype=np.uint64) | np.uint64(1)
_SIGNED = "doc_id long, text_hash long, n_shingles long, set_hash binary, tokens array<long>"


def shingles(texts: textarrow.Texts, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct shingle hashes."""
    values, codes, first = textarrow.words(texts, lower=True)
    hashes = textarrow.hash64(values)[codes]
    windows = textarrow.window_hashes(hashes, width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(windows[a:b - width + 1]))
        elif b > a:
            out.append(textarrow.window_hashes(np.append(hashes[a:b], np.uint64(b - a)), b - a + 1))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of coordinate tokens per non-empty set."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), COORDINATES), dtype=np.uint64)
    with np.errstate(over="ignore"):
        mixed = np.empty_like(flat)
        for k, (factor, shift) in enumerate(_SEEDS):
            np.multiply(flat, factor, out=mixed)
            mixed += shift
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            out[:, k] = textarrow.mix64(np.minimum.reduceat(mixed, starts) + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15))
    return out


def _sign(width: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for texts in textarrow.chunks(batch.column(1)):
                sets = shingles(texts, width)
                full = [k for k, s in enumerate(sets) if len(s)]
                tokens: list = [None] * len(sets)
                if full:
                    for k, row in zip(full, signatures([sets[k] for k in full]).view(np.int64), strict=True):
                        tokens[k] = row
                digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(texts.first, len(texts)).cast(pa.int64()), batch.column(2).slice(texts.first, len(texts)), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "n_shingles", "set_hash", "tokens"])

    return run


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Per row of (doc_id, text): hash of the text, n_shingles, set_hash (null if empty), tokens."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(_sign(width), _SIGNED)


def postings(classes: DataFrame) -> DataFrame:
    """(token, doc, size): the shared tokens in the prefix of every class that can have a link."""
    posted = classes.select(F.col("rep").alias("doc"), "n_shingles", F.explode("tokens").alias("token"))
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = posted.join(shared, "token").groupBy("doc").agg(F.first("n_shingles").alias("size"), F.sort_array(F.collect_list(F.struct("n", "token"))).alias("own"))
    own = own.filter(F.size("own") >= MATCHES)  # at most COORDINATES tokens a class
    return own.select("doc", "size", F.explode(F.slice("own", F.lit(1), F.size("own") - MATCHES + 1)).alias("t")).select("doc", "size", F.col("t.token").alias("token"))


def _alike(x: str, y: str):
    """Whether the sizes of two sets allow the similarity."""
    return 100 * F.least(x, y) >= PERCENT * F.greatest(x, y)


def _agreement(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) with the number of coordinates they agree in."""
    def side(name: str) -> DataFrame:
        return classes.select(F.col("rep").alias(name), F.col("tokens").alias(f"t_{name}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", F.size(F.array_intersect("t_a", "t_b")).alias("agree"))


def _jaccard(width: int):
    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            inter, union = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
            step = 256  # pairs at a time, for memory
            for at in range(0, len(a), step):
                sides = []
                for column in (2, 3):
                    encoded = batch.column(column).slice(at, step).dictionary_encode()
                    sets = [s for texts in textarrow.chunks(encoded.dictionary) for s in shingles(texts, width)]
                    sides.append([sets[c] for c in encoded.indices.to_pylist()])
                for k, (x, y) in enumerate(zip(*sides, strict=True)):
                    inter[at + k] = len(np.intersect1d(x, y, assume_unique=True))
                    union[at + k] = len(x) + len(y) - inter[at + k]
            linked = 100 * inter >= PERCENT * union
            yield pa.RecordBatch.from_arrays([a, b, pa.array(linked), pa.array(1 - inter / np.maximum(union, 1))], names=["a", "b", "linked", "distance"])

    return run


def _compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Pairs (a, b) with their sets' distance and whether they are linked."""
    both = pairs.select("a", "b").join(texts.select(F.col("doc").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.join(texts.select(F.col("doc").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_jaccard(width), "a long, b long, linked boolean, distance double")


def components(links: DataFrame) -> DataFrame:
    """(doc, comp): the smallest doc reachable over ``links`` (a, b), by star contraction.

    Each round hangs every doc's larger neighbours on its smallest one, then every
    doc's smaller neighbours likewise, until each link leads to a root.
    """
    edges = links.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).filter("x <> y").distinct()
    while True:
        # large star: neighbours larger than a doc hang on its smallest neighbour (or itself)
        near = edges.select("x", "y").union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = near.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("low"))
        large = near.join(low, "x").filter("y > x").select(F.col("y").alias("x"), F.col("low").alias("y"))
        large = large.filter("x <> y").distinct()
        # small star: a doc and its smaller neighbours hang on the smallest of them
        low = large.groupBy("x").agg(F.min("y").alias("low"))
        small = large.join(low, "x").select(F.col("y").alias("x"), F.col("low").alias("y")).filter("x <> y")
        done = stored(small.union(low.select("x", F.col("low").alias("y"))).distinct())
        counts = done.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("x").alias("docs")).first()
        roots = done.join(done.select(F.col("x").alias("y")).distinct(), "y", "left_semi").limit(1).count()
        edges = done
        if counts["n"] == counts["docs"] and not roots:
            return done.select(F.col("x").alias("doc"), F.col("y").alias("comp"))


def _outside(lists: DataFrame) -> DataFrame:
    """Per list that is not one component: its size, its largest component and how many members are outside."""
    each = lists.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n"))
    every = each.groupBy("token").agg(F.sum("n").alias("members"), F.max(F.struct("n", "comp")).alias("top"))
    return every.select("token", "members", F.col("top.comp").alias("top"), (F.col("members") - F.col("top.n")).alias("outside")).filter("outside > 0")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _sets(width: int):
    def run(batches):
        for batch in batches:
            for texts in textarrow.chunks(batch.column(1)):
                sets = [pa.array(s.view(np.int64)) for s in shingles(texts, width)]
                first = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(texts.first, len(texts)), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.concat_arrays(sets))], names=["doc", "shingles"])

    return run


def profiles(texts: DataFrame, width: int) -> DataFrame:
    """Per doc of ``texts`` that can have a link among them: shared, above and levels.

    shared counts the shingles that another text has too; a text with fewer than PERCENT
    of its shingles shared has no link. They are also counted in 64 buckets by hash: bit b
    of a level is set if bucket b holds at least that many, above sums what exceeds the
    last level.
    """
    sets = texts.mapInArrow(_sets(width), "doc long, shingles array<long>")
    each = stored(sets.select("doc", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle")))
    shared = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("shingle")
    counts = each.join(shared, "shingle").groupBy("doc", "n", F.pmod("shingle", F.lit(64)).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("k"))
    bit = F.expr("shiftleft(1L, bucket)")
    levels = [F.coalesce(F.bit_or(F.when(F.col("k") >= level, bit)), F.lit(0).cast("long")).alias(f"level{level}") for level in LEVELS]
    own = counts.groupBy("doc", "n").agg(F.sum("k").alias("shared"), F.sum(F.greatest(F.col("k") - LEVELS[-1], F.lit(0))).alias("above"), *levels)
    return own.filter(100 * F.col("shared") >= PERCENT * F.col("n")).drop("n")


def _rest(member: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) of different components in a list of ``member`` that no bound rules out, each once."""
    docs = member.groupBy("doc").agg(F.collect_list("token").alias("own"))  # at most COORDINATES tokens
    docs = docs.join(profiles(texts.join(member.select("doc").distinct(), "doc", "left_semi"), width), "doc")
    member = stored(member.join(docs, "doc"))

    kept = ["shared", "above", *[f"level{level}" for level in LEVELS]]

    def side(name: str) -> DataFrame:
        return member.select("token", *[F.col(c).alias(f"{name}_{c}") for c in ("doc", "comp", "top", "size", "agree", "distance", "own", *kept)])

    both = side("p").filter("p_comp <> p_top").join(side("q"), "token")
    enough = PERCENT * (F.col("p_size") + F.col("q_size"))  # of (100 + PERCENT) times the shingles in common
    met = [F.bit_count(F.col(f"p_level{level}").bitwiseAND(F.col(f"q_level{level}"))) for level in LEVELS]
    common = functools.reduce(lambda x, y: x + y, met, F.least("p_above", "q_above"))
    near = [
        F.col("p_comp") != F.col("q_comp"),
        (F.col("q_comp") == F.col("q_top")) | (F.col("p_doc") < F.col("q_doc")),
        (100 + PERCENT) * F.least("p_shared", "q_shared") >= enough,
        F.coalesce(F.abs(F.col("p_agree") - F.col("q_agree")) <= COORDINATES - MATCHES, F.lit(True)),
        F.coalesce(F.abs(F.col("p_distance") - F.col("q_distance")) <= 1 - PERCENT / 100 + 1e-9, F.lit(True)),
        (100 + PERCENT) * common >= enough,
        F.col("token") == F.array_min(F.array_intersect("p_own", "q_own")),  # in the first of the lists that hold both
    ]
    return both.filter(functools.reduce(lambda x, y: x & y, near)).select(*_pair("p_doc", "q_doc"))


def links(classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(doc, comp) of every class that is linked with another."""
    lists = stored(postings(classes))
    # The texts and tokens compared are those of the lists' members, a small part of all.
    listed = stored(lists.select("doc").distinct())
    texts = stored(join_checked(texts, listed, ["doc"], "left_semi"))
    classes = stored(join_checked(classes.select("rep", "tokens"), listed.withColumnRenamed("doc", "rep"), ["rep"], "left_semi"))
    may = F.col("agree") >= MATCHES

    # the star of every list's smallest member
    pivots = lists.groupBy("token").agg(F.min("doc").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("token", "pivot")
    sizes = lists.select(F.col("doc").alias("pivot"), F.col("size").alias("pivot_size")).distinct()
    lists = lists.join(pivots.join(sizes, "pivot"), "token").filter("doc <> pivot")
    met = stored(_agreement(lists.filter(_alike("size", "pivot_size")).select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct(), classes))
    seen = stored(_compared(met.filter(may), texts, width))
    found = [seen.filter("linked").select("a", "b")]
    comps = components(found[0])
    known = met.join(seen.select("a", "b", "distance"), ["a", "b"], "left").select(F.col("a").alias("pivot"), F.col("b").alias("doc"), "agree", "distance")
    lists = stored(lists.join(known, ["pivot", "doc"], "left").select("token", "doc", "size", "agree", "distance"))

    before = None
    while True:
        now = stored(lists.join(comps, "doc", "left").withColumn("comp", F.coalesce("comp", "doc")))
        open_lists = stored(_outside(now))
        left = open_lists.agg(F.sum("members").alias("rows"), F.sum(F.col("outside") * F.col("members")).alias("pairs")).first()
        if not left["rows"]:
            return comps
        member = now.join(open_lists.select("token", "top"), "token")
        outside = member.filter("comp <> top")
        if left["pairs"] <= 2 * left["rows"] or (before is not None and left["pairs"] > before / 2):
            break
        before = left["pairs"]
        centre = member.filter("comp = top").groupBy("token").agg(F.min(F.struct(F.xxhash64("doc", F.lit(len(found))), F.col("doc"), F.col("size"))).alias("c"))
        star = outside.join(centre.select("token", F.col("c.doc").alias("centre"), F.col("c.size").alias("centre_size")), "token").filter(_alike("size", "centre_size"))
        new = _agreement(star.select(*_pair("doc", "centre")).distinct(), classes).filter(may)
        found.append(stored(_compared(new, texts, width)).filter("linked").select("a", "b"))
        comps = components(functools.reduce(DataFrame.union, found))

    found.append(stored(_compared(_agreement(_rest(member, texts, width), classes).filter(may), texts, width)).filter("linked").select("a", "b"))
    return components(functools.reduce(DataFrame.union, found))


_OWN_NUMBERS = -(1 << 62)  # classes of doc_ids with several texts are numbered down from here


def _numbered(classes: DataFrame, texts: DataFrame, several: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes and texts where the smallest doc_id of a class has several texts: these classes
    get numbers of their own (rep) and the text that belongs to each."""
    ids = several.withColumnRenamed("doc_id", "least")
    own = join_checked(classes, ids, ["least"], "left_semi").withColumn("rep", F.lit(_OWN_NUMBERS) - F.monotonically_increasing_id())
    own = stored(own)
    classes = stored(join_checked(classes, ids, ["least"], "left_anti").unionByName(own))
    ids = several.withColumnRenamed("doc_id", "doc")
    theirs = join_checked(texts, ids, ["doc"], "left_semi").withColumn("text_hash", F.xxhash64("text"))
    theirs = theirs.join(own.select(F.col("least").alias("doc"), "text_hash", "rep"), ["doc", "text_hash"]).select(F.col("rep").alias("doc"), "text")
    return classes, join_checked(texts, ids, ["doc"], "left_anti").unionByName(theirs)


def near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs`` (doc_id, text).

    A doc_id with several texts ties their classes together.
    """
    rows = stored(signed(docs, width))
    sets = rows.filter("set_hash is not null and doc_id is not null")
    classes = sets.groupBy("set_hash").agg(
        F.min("doc_id").alias("least"), F.min_by("text_hash", "doc_id").alias("text_hash"),
        F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"))
    classes = stored(classes.withColumn("rep", F.col("least")))
    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), "text")
    several = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("text_hash").alias("x"), F.max("text_hash").alias("y"))
    several = stored(several.filter("x <> y").select("doc_id"))
    if several.isEmpty():
        comps = links(classes, texts, width)
        named = classes.join(comps.withColumnRenamed("doc", "rep"), "rep", "left").select("set_hash", F.coalesce("comp", "rep").alias("component"))
    else:
        classes, texts = _numbered(classes, texts, several)
        comps = links(classes, texts, width)
        members = join_checked(sets.select("doc_id", "set_hash"), several, ["doc_id"], "left_semi").join(classes.select("set_hash", "rep"), "set_hash")
        least = members.groupBy("doc_id").agg(F.min("rep").alias("a"))
        ties = members.select("doc_id", F.col("rep").alias("b")).distinct().join(least, "doc_id").select("a", "b").filter("a <> b")
        comps = components(stored(comps.select(F.col("doc").alias("a"), F.col("comp").alias("b")).union(ties)))
        named = classes.join(comps.withColumnRenamed("doc", "rep"), "rep", "left").select("set_hash", "least", F.coalesce("comp", "rep").alias("comp"))
        named = named.join(named.groupBy("comp").agg(F.min("least").alias("component")), "comp").select("set_hash", "component")
    out = rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("set_hash")).alias("set_hash"))
    # Rows without a set get a key of their own, not one hot null.
    key = F.coalesce(F.col("set_hash"), F.concat(F.lit("-"), F.xxhash64("doc_id").cast("string")).cast("binary"))
    out = out.withColumn("set_hash", key).join(named, "set_hash", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """One document of each group, with its own columns; of repeated rows of the kept doc_id one.

    The one is that of the smallest text. Rows with a null doc_id stay. The decision is
    taken on doc_ids; of the texts only those of repeated kept ids are shuffled, one per
    task and id.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    doc, text = (f"c{names.index(x)}" for x in ("doc_id", "text"))
    verdict = stored(near_duplicates(plain.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")), width))
    keyed = plain.withColumn("id", F.col(doc).cast("long"))
    gone = stored(verdict.filter("not kept").select(F.col("doc_id").alias("id")).distinct())
    kept = join_checked(keyed, gone, ["id"], "left_anti")
    again = stored(verdict.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("id")))
    if not again.isEmpty():
        repeated, row = join_checked(kept, again, ["id"], "left_semi"), F.struct(*plain.columns)
        one = repeated.groupBy("id").agg(F.min_by(row, F.col(text).cast("binary")).alias("row"))
        # min_by passes null texts over: an id with null texts alone keeps one of those
        bare = repeated.groupBy("id").agg(F.count(text).alias("texts"), F.first(row).alias("row")).filter("texts = 0")
        kept = join_checked(kept, again, ["id"], "left_anti").select(*plain.columns)
        kept = kept.unionByName(one.filter("row is not null").select("row.*")).unionByName(bare.select("row.*"))
    return kept.select(*plain.columns).toDF(*names)


def op1_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), width=4)


OP1_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then []
                                      when len(ws) < 4 then [array_to_string(ws, ' ')]
                                      else [array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)] end) as sh
  from w),
n as (select w.doc_id, (select count(*) from s where s.doc_id = w.doc_id)::bigint as n_shingles from w),
common as (select a.doc_id as a, b.doc_id as b, count(*) as inter from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
pair as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b
         where 100 * inter >= 80 * (x.n_shingles + y.n_shingles - inter)),
edge as (select a, b from pair union all select b, a from pair),
reach as (select doc_id, doc_id as r from n union select reach.doc_id, edge.b from reach join edge on edge.a = reach.r)
select n.doc_id, n_shingles, c as component_id, n.doc_id = c as kept
from n join (select doc_id, min(r) as c from reach group by doc_id) m on m.doc_id = n.doc_id
"""
