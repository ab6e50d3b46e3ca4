"""Personal data: exact base detectors and boosted trees over high-recall candidates, native.

Base detectors (email, ip, card, phone) are patterns with checks; their spans stay.
Generators propose looser spans: anything around an at sign, runs of digits with
separators, and long runs of key signs (``secret``). Gradient-boosted trees score a
candidate by its format (digits, groups, separators, checks passed, kinds of letters) and
context (neighbouring characters, cue words); they learn from weak labels on all
candidates: base spans; digits that pass the Luhn check behind other separators in regular
groups; phone numbers without a plus behind a cue word; keys of letters and digits behind
a cue word. Base spans also train with their separators or plus taken away. A third of the
candidates is held out: there the threshold is set so that at least ``PRECISION`` of the
selected have a positive label. What passes it and touches no base span is added (of
overlapping ones the key, then the address). Candidates alike in the bins of all features
are counted together; Spark adds up the gradients of all of them for every level of a tree.

Spans come from ``regexp_extract_all`` and, for positions and context, the parts between
matches (``split``): no Python runs on the documents or the candidates. A pattern begins only where a run
of its signs begins or the last match ended, and its groups are possessive, so that a run
of any length is read once. Positions are added up in blocks. A document is one row
throughout; the only shuffles are of counts.

Defined cases: a null or empty text has no spans; positions are code points, ends
exclusive; repeated rows are judged alike; an empty table gives none; without both kinds
of labels nothing is added; texts and runs of any length are read whole. Extra columns
pass through ``redact`` (clashing names give way inside).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroclim.llm import boosting
from agroclim.llm.common import stored, table

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
NEAR = 24  # characters of context

ADDED_KINDS = (*KINDS, "secret")


def _from_start(signs: str) -> str:
    """Only where the last match ended or no sign of the run stands before."""
    return rf"(?:\G|(?<![{signs}]))"


# The base patterns. They begin at the start of a run and groups are
# possessive: a start inside the run meets the same end, so they find the same.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"{_from_start(_LOCAL)}[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"{_from_start('0-9')}[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# A character that a text must hold to match at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_KEY = "A-Za-z0-9_+/="
LOOSE = {
    "at": r"(?:\G|(?<![^\s@<>\"]))[^\s@<>\"]++@[^\s@<>\"]++",
    "number": r"[+(]?[0-9][0-9 ().:/_-]{5,}[0-9]",
    "key": rf"(?<![{_KEY}-])[{_KEY}-]{{16,}}+",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
_CUES = r"(?i)(?:mail|e-mail|tel|phone|call|fax|mobil|ip|host|addr|card|visa|konto|credit)\W*$"
_PHONE_CUE = r"(?i)(?:tel|phone|call|fax|mobil\w*)\W*$"
_SECRET_CUE = r"(?i)(?:token|secret|passw(?:or)?d|api.?key|key|bearer)\W*$"
_CARD_GROUPS = r"^[0-9]{4}(?:[ ._:/-]?[0-9]{4}){2}[ ._:/-]?[0-9]{1,7}$"
_BLOCK = 64


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _running(sizes: Column) -> Column:
    """The sums of what stands before each element, in blocks (an array grows by copying)."""
    def before(block: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda acc, x: acc + x)

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")), lambda k: F.slice(sizes, k * _BLOCK + 1, _BLOCK))
    return _let(blocks, lambda cut: _let(before(F.transform(cut, total), F.lit(0)), lambda firsts: F.flatten(F.zip_with(cut, firsts, before))))


_SPAN = "array<struct<m:string,s:int,e:int,before:string,after:string>>"


def _found(text: Column, pattern: str, needs: str | None = None) -> Column:
    """All matches from left to right: array of (m, s, e, before, after), with some context."""
    none = F.array().cast(_SPAN)

    def spans(matches: Column) -> Column:
        def placed(gaps: Column) -> Column:
            sizes = F.transform(matches, lambda m, k: F.length(F.get(gaps, k)) + F.length(m))

            def span(at: Column, k: Column) -> Column:
                m, gap, then = F.get(matches, k), F.get(gaps, k), F.get(gaps, k + 1)
                start = at + F.length(gap)
                before = F.when(F.length(gap) >= NEAR, gap).otherwise(F.concat(F.coalesce(F.get(matches, k - 1), F.lit("")), gap))
                after = F.when(F.length(then) > 0, then).otherwise(F.coalesce(F.get(matches, k + 1), F.lit("")))
                return F.struct(m.alias("m"), start.alias("s"), (start + F.length(m)).alias("e"), F.right(before, F.lit(NEAR)).alias("before"), F.left(after, F.lit(1)).alias("after"))

            return F.transform(_running(sizes), span)

        return F.when(F.size(matches) == 0, none).otherwise(_let(F.split(text, pattern, -1), placed))

    found = _let(F.regexp_extract_all(text, F.lit(pattern), 0), spans)
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(none) if needs else found


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def value(k: Column) -> Column:
        d = F.substring(F.reverse(number), k, F.lit(1)).cast("int")
        return F.when(k % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda a, k: a + value(k)) % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.rlike(m, F.lit(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"))
    if kind == "card":
        return _let(digits(m), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    return F.lit(True)


def _valid(kind: str, x: Column) -> Column:
    return _holds(kind, x["m"])


def _of_kind(kind: str, x: Column) -> Column:
    return x["kind"] == kind


def _shown(kind: str, x: Column) -> Column:
    return F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))


def _ordered(kind: str, x: Column) -> Column:
    return F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), F.lit(kind).alias("kind"))


def _card_runs(text: Column) -> Column:
    """Card candidates need 13 digits near each other; most texts have none."""
    return F.when(F.rlike(text, F.lit(r"[0-9](?:[ -]?[0-9]){12}")), _found(text, BASE["card"])).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the array of valid base spans (m, s, e and context)."""
    out = {}
    for kind in KINDS:
        found = _card_runs(text) if kind == "card" else _found(text, BASE[kind], NEEDS.get(kind))
        out[kind] = F.filter(found, functools.partial(_valid, kind))
    return out


FEATURES = ("at", "key", "length", "digits", "groups", "dots", "dashes", "blanks", "plus", "luhn", "parts_ok", "letters", "capitals", "hex_share", "tail",
            "digit_share", "before_digit", "before_letter", "before_quote", "after_digit", "after_letter", "cue", "secret_cue")


def _candidate(x: Column, made_by: str, base: Column) -> Column:
    """A candidate with its kind, its weak label, whether it touches a base span, and features."""
    m, before, after, d = x["m"], x["before"], x["after"], digits(x["m"])
    number = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    count = lambda p: F.regexp_count(m, F.lit(p)).cast("double")
    is_base = F.exists(base, lambda b: (b["s"] == x["s"]) & (b["e"] == x["e"]))
    checked = F.when(F.length(d).between(12, 20), luhn(d)).otherwise(F.lit(False))
    if made_by == "number":
        kind = F.when(F.rlike(m, F.lit(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$")), F.lit("ip")).when(
            F.rlike(m, F.lit(r"^[+(]")) | (F.length(d) < 13), F.lit("phone")).otherwise(F.lit("card"))
        card = F.length(d).between(13, 19) & checked & F.rlike(m, F.lit(_CARD_GROUPS))
        label = is_base | card | (F.length(d).between(9, 15) & F.rlike(before, F.lit(_PHONE_CUE)))
    elif made_by == "key":
        kind = F.lit("secret")
        label = F.rlike(before, F.lit(_SECRET_CUE)) & F.rlike(m, F.lit("[0-9].*[0-9]")) & F.rlike(m, F.lit("[A-Za-z]"))
    else:
        kind, label = F.lit("email"), is_base
    return F.struct(
        x["s"].alias("s"), x["e"].alias("e"), kind.alias("kind"), label.alias("label"), is_base.alias("is_base"),
        F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])).alias("touches"),
        F.array(
            F.lit(float(made_by == "at")), F.lit(float(made_by == "key")), F.length(m).cast("double"), F.length(d).cast("double"), count("[0-9]+"), count(r"\."), count("-"), count(" "),
            number(F.startswith(m, F.lit("+"))), number(checked), number(F.rlike(m, F.lit(rf"^{_PART}(?:\.{_PART}){{3}}$"))),
            count("[A-Za-z]"), count("[A-Z]"), count("[0-9A-Fa-f]") / F.length(m), F.length(F.regexp_extract(m, r"\.([A-Za-z]+)$", 1)).cast("double"), F.length(d) / F.length(m),
            number(F.rlike(before, F.lit("[0-9]$"))), number(F.rlike(before, F.lit("[A-Za-z]$"))), number(F.rlike(before, F.lit("[\"'`]$"))),
            number(F.rlike(after, F.lit("[0-9]"))), number(F.rlike(after, F.lit("[A-Za-z]"))),
            number(F.rlike(before, F.lit(_CUES))), number(F.rlike(before, F.lit(_SECRET_CUE)))).alias("f"))


def detected(docs: DataFrame) -> DataFrame:
    """``docs`` (with columns doc and text) plus base spans per kind and all candidates."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumns({f"base_{k}": c for k, c in base_spans(text).items()})
    every = F.concat(*[f"base_{k}" for k in KINDS])

    def proposed(base: Column) -> Column:
        def made(by: str) -> Column:
            return F.transform(_found(text, LOOSE[by], "@" if by == "at" else None), lambda x: _candidate(x, by, base))

        return F.concat(made("key"), made("at"), made("number"))

    return rows.withColumn("candidates", _let(every, proposed))


def _loosened(f: Column) -> Column:
    """A base span's features with other separators, or without its plus; null where neither changes."""
    at = {name: F.get(f, F.lit(k)) for k, name in enumerate(FEATURES)}

    def changed(**to: Column) -> Column:
        return F.array(*[to.get(name, value) for name, value in at.items()])

    phone = at["plus"] == 1
    card = (at["luhn"] == 1) & (at["groups"] > 1)
    plain = F.when(phone, changed(plus=F.lit(0.0), length=at["length"] - 1, digit_share=at["digits"] / (at["length"] - 1)))
    return F.when(at["at"] == 0, plain.when(card, changed(dots=at["groups"] - 1, blanks=F.lit(0.0), dashes=F.lit(0.0))))


CUTS = [boosting.SHARE_CUTS if name.endswith("_share") else boosting.COUNT_CUTS for name in FEATURES]


def _profiled(each: DataFrame) -> DataFrame:
    """Candidates by the bins of their features, counted; changed base spans are added to those that train."""
    more = F.when(~F.col("held") & F.col("base"), _loosened(F.col("f")))
    own = F.struct(F.col("label").cast("long").alias("positive"), F.col("f"))
    also = F.struct(F.lit(1).cast("long").alias("positive"), more.alias("f"))
    rows = each.select("held", "base", F.explode(F.filter(F.array(own, also), lambda x: x["f"].isNotNull())).alias("x"))
    rows = rows.select("held", "base", "x.positive", F.col("x.f").alias("f"))
    bins = F.array(*[boosting.bin_column(F.get("f", F.lit(k)), cuts) for k, cuts in enumerate(CUTS)])
    counted = rows.withColumn("key", boosting.key_column(bins)).groupBy("held", "base", "key")
    return counted.agg(F.sum("positive").alias("positive"), F.count("*").alias("n"))


def fit(docs: DataFrame) -> tuple[tuple[float, list], float]:
    """The trees and the threshold (log-odds) from all candidates."""
    each = detected(docs).select("doc", F.explode("candidates").alias("c"))
    each = each.select((F.pmod(F.xxhash64("doc", "c.s", "c.e"), F.lit(3)) == 0).alias("held"), F.col("c.is_base").alias("base"), F.col("c.label").alias("label"), F.col("c.f").alias("f"))
    profiles = stored(_profiled(each))
    groups = profiles.groupBy("held", "base").agg(F.sum("positive").alias("positive"), F.sum("n").alias("n")).collect()
    if sum(r["positive"] for r in groups) in (0, sum(r["n"] for r in groups)):
        return (0.0, []), float("inf")
    model = boosting.train_profiles(profiles.filter("not held"), CUTS)
    # The threshold is set on what may be added: held-out candidates that are no base spans,
    # or, if too few of these are positive, on all that are held out.
    judged = "held and not base" if sum(r["positive"] for r in groups if r["held"] and not r["base"]) >= 20 else "held"
    threshold = boosting.precise_threshold(model, profiles.filter(judged), len(FEATURES), PRECISION)
    return boosting.unbinned(model, CUTS), threshold


def spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc, text, ...) with base_email ... base_phone and added (kind, s, e)."""
    model, threshold = fit(docs.select("doc", "text"))
    rows = detected(docs)
    if threshold == float("inf"):
        chosen = F.filter("candidates", lambda c: F.lit(False))
    else:
        chosen = F.filter("candidates", lambda c: ~c["touches"] & (boosting.score_column(model, [F.get(c["f"], F.lit(k)) for k in range(len(FEATURES))]) >= F.lit(threshold)))
    plain = F.transform(chosen, lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e")))

    def apart(every: Column) -> Column:
        """Without those that overlap a span made by an earlier generator."""
        keys = F.filter(every, lambda c: c["kind"] == "secret")
        mails = F.filter(every, lambda c: (c["kind"] == "email") & ~_meets(c, keys))
        first = F.concat(keys, mails)
        return F.concat(first, F.filter(every, lambda c: ~c["kind"].isin("secret", "email") & ~_meets(c, first)))

    return rows.withColumn("added", _let(plain, apart)).drop("candidates")


def _meets(c: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["s"] < c["e"]) & (c["s"] < o["e"]))


def _listed(with_added: bool) -> Column:
    """kind:start:end by kind, then start, joined by commas."""
    parts = []
    for kind in ADDED_KINDS if with_added else KINDS:
        own = F.array().cast("array<struct<s:int,e:int>>") if kind not in KINDS else F.transform(f"base_{kind}", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
        if with_added:
            more = F.filter("added", functools.partial(_of_kind, kind))
            own = F.array_sort(F.concat(own, F.transform(more, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))))
        parts.append(F.transform(own, functools.partial(_shown, kind)))
    return F.array_join(F.concat(*parts), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in text replaced by its kind in brackets; of overlapping spans the one that begins first (then the longest) counts."""
    names = docs.columns
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    doc, text = (f"c{names.index(x)}" for x in ("doc_id", "text"))
    rows = spans(plain.withColumns({"doc": F.col(doc), "text": F.col(text)}))
    every = F.concat(*[F.transform(f"base_{k}", functools.partial(_ordered, k)) for k in KINDS],
                     F.transform("added", lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda acc, x: F.when(x["s"] < acc["at"], acc).otherwise(F.struct(
        (-x["e"]).alias("at"), F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["s"] - acc["at"]), F.lit("["), x["kind"], F.lit("]")).alias("out")))
    end = F.aggregate(F.array_sort(every), start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length(F.col("text")))))
    return rows.withColumn("redacted", end).select(*[F.col("redacted").alias(c) if c == text else F.col(c) for c in plain.columns]).toDF(*names)


def op9_personal_data(spark, sf_dir: str) -> DataFrame:
    out = spans(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text"))
    return out.select(F.col("doc").alias("doc_id"), *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(_listed(False), 256).alias("base_sha256"), _listed(True).alias("spans"))
