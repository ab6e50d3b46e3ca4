"""URL filter: path rules first, boosted trees on lexical features for the rest.

A rule (host and path) fits its host and all subdomains if the URL's path starts with
the rule's; the longest fitting rule decides. URLs that a rule decides are the labelled
ones: gradient-boosted trees learn block or allow from their lexical features (lengths,
depth, digit ratio, entropy, parameter counts, statistics of the host's suffix) and judge
all others. The trees run as a SQL expression.

Every rule names a suffix, so the labels of a suffix seen under one rule only tell the rule,
not the page: its statistics are neutral (the block rate of all labelled rows, seen 0). Of
other suffixes a labelled row gets the rate without the rows of its own fold (by hash of the
host), shrunk to the rate of all; leaving out its rule's rows instead would give the reverse
of its label where two rules of a suffix disagree.

The trees are fitted on at most ``SAMPLE`` labelled URLs (those of smallest hash, a
documented bound); the suffix statistics are sums over all labelled URLs, reduced before
their shuffle, so a hot host is no hot group.

Defined cases: a null URL or one without ``://`` has empty host and path and no rule and is
judged by its features (all zero); if labels of one kind are missing the trees' base
rate decides; repeated rows are judged alike; an empty table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroclim.llm import boosting
from agroclim.llm.common import join_checked, stored, table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SAMPLE = 20_000
FOLDS, SHRINK = 5, 20.0
FEATURES = ("url_length", "host_length", "path_length", "labels", "depth", "digit_ratio", "entropy", "parameters", "signs", "suffix_rate", "suffix_seen")

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (null if none fits)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | F.endswith(host, F.lit("." + rule[:at]))) & F.startswith(path, F.lit(rule[at:]))
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.greatest(F.length(text), F.lit(1))  # an empty text has one empty piece
    each = F.transform(F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(each, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def lexical(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, verdict, suffix and the lexical features."""
    u = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(u), F.lit(1))
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"))
    count = lambda pattern: F.regexp_count(u, F.lit(pattern)).cast("double")
    return rows.select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), F.element_at(F.split("host", r"\."), -1).alias("suffix"),
        F.length(u).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"), F.length("path").cast("double").alias("path_length"),
        F.size(F.split("host", r"\.")).cast("double").alias("labels"), F.regexp_count(F.col("path"), F.lit("/")).cast("double").alias("depth"),
        (count("[0-9]") / n).alias("digit_ratio"), _entropy(u).alias("entropy"), count("[?&]").alias("parameters"), count("[-_%=]").alias("signs"))


def with_suffixes(rows: DataFrame, block: Column) -> tuple[DataFrame, float]:
    """``rows`` with suffix_rate and suffix_seen (null if neutral), and the block rate of all labelled rows."""
    fold = F.when(F.col("verdict").isNotNull(), F.pmod(F.xxhash64("host"), F.lit(FOLDS)).cast("int")).otherwise(F.lit(-1))
    rows = rows.withColumn("fold", fold)
    labelled = rows.filter("verdict is not null")
    # a labelled row's suffix is its rule's: no more groups than rules, times folds
    each = stored(labelled.groupBy("suffix", "fold", "rule").agg(F.sum(block).alias("blocked"), F.count(F.lit(1)).cast("double").alias("n")))
    whole = each.groupBy("suffix").agg(F.sum("blocked").alias("all_blocked"), F.sum("n").alias("all_n"), F.countDistinct("rule").alias("rules"))
    total = each.agg(F.coalesce(F.sum("blocked"), F.lit(0.0)).alias("blocked"), F.coalesce(F.sum("n"), F.lit(0.0)).alias("n")).first()
    prior = (total["blocked"] + 1) / (total["n"] + 2)
    own = each.groupBy("suffix", "fold").agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n"))
    own = own.unionByName(whole.select("suffix", F.lit(-1).alias("fold"), F.lit(0.0).alias("blocked"), F.lit(0.0).alias("n")))
    rate = (F.col("all_blocked") - F.col("blocked") + SHRINK * prior) / (F.col("all_n") - F.col("n") + SHRINK)
    suffixes = own.join(whole.filter("rules > 1"), "suffix").select("suffix", "fold", rate.alias("suffix_rate"), F.log1p("all_n").alias("suffix_seen"))
    return join_checked(rows, stored(suffixes), ["suffix", "fold"]), prior


def judge(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages`` (page_id, url)."""
    rows = stored(lexical(pages.select("page_id", "url")))
    block = F.when(F.col("verdict") == "block", 1.0).otherwise(0.0)
    full, prior = with_suffixes(rows, block)
    full = full.fillna({"suffix_rate": prior, "suffix_seen": 0.0})
    taken = full.filter("verdict is not null").select(F.xxhash64("host", "path", "page_id").alias("h"), block.alias("y"), *FEATURES)
    taken = taken.orderBy("h", "y", *FEATURES).limit(sample).toPandas()  # bounded
    model = boosting.train(taken[list(FEATURES)].to_numpy(dtype=np.float64), taken["y"].to_numpy(dtype=np.float64))
    out = full.withColumn("score", boosting.score_column(model, [F.col(f) for f in FEATURES]))
    verdict = F.coalesce(F.col("verdict"), F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), (1 / (1 + F.exp(-F.col("score")))).alias("block_probability"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages", "page_id", "url"))
