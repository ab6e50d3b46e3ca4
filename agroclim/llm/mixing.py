"""Mixing sources to target weights: repeat or thin documents by source, DataFrame functions only.

Words per source are summed; each source's target follows from its weight and the
share of all words to take, at most ``cap`` times its size, what a cap leaves over
being shared again by weight among the others. The source's rate is target over
size: every document is taken floor(rate) times, and once more if its hash, a
uniform number from the seed and its doc_id, lies below the rate's fraction.

One row per source is all that is gathered; documents meet their source's rate
in a join whose small side is broadcast only when counted to be small (otherwise
a shuffle join, in which AQE splits a hot source).

Defined cases: a null text has no words and is taken like any other by its source's
rate; null is a source of its own, last in order; a source without words has target
and rate 0; a null doc_id is hashed as the text ``null``; repeated rows share their
fate; an empty table gives none. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroclim.llm.common import WORD, code_point_rank, join_checked, stored, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in the order of size per weight reach their cap first; one stays below
    it when the level, what is left over the weights left, fits under its cap.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(code_point_rank(F.col("source")))) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")).cast("long")
    rows = sums.withColumn("weight", weight)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("weight"), code_point_rank(F.col("source"))).rowsBetween(Window.unboundedPreceding, -1)
    rows = (rows.withColumn("all_size", F.sum("source_size").over(everything))
            .withColumn("all_weight", F.sum("weight").over(everything))
            .withColumn("done_size", F.coalesce(F.sum("source_size").over(before), F.lit(0)))
            .withColumn("done_weight", F.coalesce(F.sum("weight").over(before), F.lit(0))))
    level = (F.lit(share) * F.col("all_size") - F.lit(float(cap)) * F.col("done_size")) / (F.col("all_weight") - F.col("done_weight"))
    rows = rows.withColumn("capped", level * F.col("weight") > F.lit(float(cap)) * F.col("source_size"))
    rows = (rows.withColumn("capped_size", F.coalesce(F.sum(F.when(F.col("capped"), F.col("source_size"))).over(everything), F.lit(0)))
            .withColumn("open_weight", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)))
    final = (F.lit(share) * F.col("all_size") - F.lit(float(cap)) * F.col("capped_size")) / F.col("open_weight")
    target = F.when(F.col("capped"), F.lit(float(cap)) * F.col("source_size")).otherwise(F.least(final * F.col("weight"), F.lit(float(cap)) * F.col("source_size")))
    return rows.select("source", "source_size", target.cast("double").alias("target"))


def copies(rate: Column, doc_id: Column, seed: str = SEED) -> Column:
    """floor(rate), and one more with the fraction's probability; a function of doc_id and seed."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))
    unit = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    return (F.floor(rate) + F.when(unit < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _rated(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows (key s, id i, ...) with source_size, target and the number of copies."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    keyed = targets.select(_key("source").alias("s"), "source_size", "target")
    return join_checked(rows, stored(keyed), ["s"]).withColumn("copies", copies(rate, F.col("i")))


def _key(name: str) -> Column:
    """A source as a join key that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("null"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it."""
    targets = source_targets(docs.select("source", word_count(F.col("text")).alias("size")), weights, share, cap)
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    doc, source = (f"c{names.index(x)}" for x in ("doc_id", "source"))
    rated = _rated(plain.withColumn("s", _key(source)).withColumn("i", F.col(doc)), targets)
    out = rated.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(*plain.columns).toDF(*names)


def op6_source_mix(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    sized = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    rows = sized.select("doc_id", "size", _key("source").alias("s"), F.col("doc_id").alias("i"))
    rated = _rated(rows, source_targets(sized.select("source", "size")))
    return rated.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP6_SQL = r"""
with d as (
  select doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents),
s0 as (select source, sum(size)::bigint as n from d group by source),
s1 as (select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint as w from s0),
s2 as (select *, (sum(n) over ())::bigint as t, (sum(w) over ())::bigint as tw,
              coalesce(sum(n) over (order by n / w, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint as pn,
              coalesce(sum(w) over (order by n / w, source nulls last rows between unbounded preceding and 1 preceding), 0)::bigint as pw
       from s1),
s3 as (select *, (1.5::double * t - 2.0::double * pn) / (tw - pw) * w > 2.0::double * n as capped from s2),
s4 as (select *, coalesce(sum(n) filter (capped) over (), 0)::bigint as cn, (sum(w) filter (not capped) over ())::bigint as ow from s3),
s5 as (select source, n, case when capped then 2.0::double * n
                              else least((1.5::double * t - 2.0::double * cn) / ow * w, 2.0::double * n) end as target from s4),
r as (select d.doc_id, d.size, n, target, case when n > 0 then target / n else 0 end as rate
      from d join s5 on d.source is not distinct from s5.source)
select doc_id, size, n as source_size, target,
       (size * (floor(rate)::bigint + case when ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint / 4503599627370496.0::double
                                               < rate - floor(rate) then 1 else 0 end))::bigint as taken
from r
"""
