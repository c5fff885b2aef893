"""Quality rules whose cutoffs are certified on labelled holdouts.

Every rule looks at one measure of a text and rejects above a cutoff. Cutoffs differ by stratum. Labels count
once per stratum and distinct text (the lowest), so copies are one observation and lie in one part. A
quarter of them offers a path of joint cutoffs, from mild to strict: first from the worst document down to
the largest value of a good one, then down the quantiles of the good ones. A rule takes part at a step
only if it finds a share of the bad documents some times larger than of the good ones there.

The other three quarters, the holdout, test the path: if k of its n good documents are rejected by any rule
of a step, the step is certified when the exact binomial tail P(X <= k), X ~ Bin(n, alpha), is at most
delta / strata. Steps are tested in their order and testing ends at the first failure, so no step costs a
correction of its own (fixed sequence); strata share delta by Bonferroni. So with probability 1 - delta no
stratum loses more than the share alpha of its good documents, all rules together. Any certified step
may be used: the one that parts the offering quarter best is taken, the mildest of equals. A stratum with too
few labels (some 220 good ones in the holdout, with four strata) rejects nothing beyond the base rules.
Texts that are near copies but not equal count as independent.

DataFrame and SQL functions only. Text never moves: measures are one pass over the documents.

Nulls: a null text has no words, so it fails the base rules. Documents of a null stratum form one of
their own, and unlabelled strata reject nothing beyond the base rules. Labels other than 0 and 1 are not
used. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from themeloom.llm.common import doc_key, without
from themeloom.session import materialize

# Fixed values.
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20

ALPHA, DELTA, CANDIDATES = 0.02, 0.05, 24
OFFERING, LIFT = 4, 5  # one part in so many offers cutoffs; how many times larger the share of bad documents must be
MILDEST, STRICTEST = 0.0005, 0.05  # shares of good documents above the quantiles of a path
#: name -> measure (high is bad); all are 0 for a text without words.
RULES = {
    "symbols": "n_symbols / word_chars", "bangs": "n_bangs / n_words", "capitals": "n_capitals / word_chars",
    "repeats": "n_repeat_words / n_words", "same_lines": "n_dup_lines / n_words", "long_words": "word_chars / n_words",
    "bars": "n_bars / n_words",
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bangs", "n_capitals", "n_bars")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and the measures of every whole text.

    Five-word windows are compared by 64-bit hashes. Only texts in which one occurs twice are sorted
    to find where.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), *(docs[c].alias(c) for c in keep), text.alias("_text"),
        _without(text, BLANKS).alias("_solid"), F.btrim(text, F.lit(BLANKS)).alias("_trim"),
    )
    lines = F.filter(F.split("_text", "\n"), lambda l: F.btrim(l, F.lit(BLANKS)) != "")
    plain = _without(F.col("_solid"), SYMBOLS)
    words = base.select(
        "doc_id", *keep, F.char_length("_solid").cast("bigint").alias("word_chars"),
        (F.char_length("_solid") - F.char_length(plain)).cast("bigint").alias("n_symbols"),
        (F.char_length("_solid") - F.char_length(_without(F.col("_solid"), "!"))).cast("bigint").alias("n_bangs"),
        (F.char_length("_solid") - F.char_length(_without(F.col("_solid"), "|"))).cast("bigint").alias("n_bars"),
        (F.char_length("_solid") - F.char_length(_without(F.col("_solid"), CAPITALS))).cast("bigint").alias("n_capitals"),
        lines.alias("_lines"),
        F.when(F.col("_trim") != "", F.split("_trim", "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>")).alias("_words"),
    )
    n = F.size("_words")
    windows = words.select(
        "doc_id", *keep, "word_chars", "n_symbols", "n_bangs", "n_bars", "n_capitals",
        n.cast("bigint").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n > WINDOW, F.expr(f"transform(sequence(1, size(_words) - {WINDOW - 1}), i -> xxhash64(slice(_words, i, {WINDOW})))"))
        .otherwise(F.array().cast("array<bigint>")).alias("_hashes"),
    )
    placed = windows.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
            F.expr("array_sort(transform(_hashes, (h, i) -> struct(h as h, i as i)))"),
        ),
    ).drop("_hashes")
    twice = placed.withColumn(
        "_at",
        F.expr(
            "array_sort(transform(filter(_sorted, (x, i) -> x.h = get(_sorted, i - 1).h or x.h = get(_sorted, i + 1).h), x -> x.i))"
        ),
    ).drop("_sorted")
    covered = F.expr(
        f"aggregate(_at, struct(0L as n, {-WINDOW} as last), (s, p) -> struct(s.n + least({WINDOW}, p - s.last) as n, p as last), s -> s.n)"
    )
    return twice.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint")).drop("_at")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def binomial_tail(n: Column, k: Column, share: float) -> Column:
    """P(X <= k) for X ~ Bin(n, share), summed term by term; exact up to rounding.

    Beyond the mean the tail is never small enough to certify anything, so it is given as 1 there and
    the sum has at most ``share * n`` terms.
    """
    odds, first = math.log(share / (1 - share)), math.log1p(-share)
    start = F.struct((n * F.lit(first)).alias("term"), F.exp(n * F.lit(first)).alias("sum"))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] + F.log((n - j + 1) / j) + F.lit(odds)
        return F.struct(term.alias("term"), (state["sum"] + F.exp(term)).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * F.lit(share), F.lit(1.0)).otherwise(F.aggregate(terms, start, add, lambda s: s["sum"]))


def _values(rules: dict[str, str]) -> Column:
    """The value of every rule, in their order."""
    return F.array(*(F.coalesce(F.try_divide(*map(F.col, rule.split(" / "))), F.lit(0.0)) for rule in rules.values()))


def paths(offered: DataFrame, rules: dict[str, str], candidates: int) -> DataFrame:
    """``stratum, path``: per step, from mild to strict, the cutoff of every rule or null, from the offering part."""
    long = offered.select("stratum", "quality", F.posexplode("values").alias("rule", "value"))
    good = F.when(F.col("quality") == 1, F.col("value"))
    mild = candidates // 2
    strict = candidates - mild
    shares = [MILDEST * (STRICTEST / MILDEST) ** (k / max(1, strict - 1)) for k in range(strict)]
    ends = long.groupBy("stratum", "rule").agg(
        F.max(good).alias("top"), F.max("value").alias("worst"),
        F.percentile_approx(good, F.array(*(F.lit(1 - x) for x in shares)), 10_000).alias("quantiles"),
    ).filter("top is not null")
    falling = (F.col("top") + F.greatest(F.col("worst") - F.col("top"), F.lit(0.0)) * (1 - (k + 1) / mild) for k in range(mild))
    grids = ends.select("stratum", "rule", F.concat(F.array(*falling), "quantiles").alias("grid"))
    above = [F.col("value") > F.get("grid", F.lit(i)) for i in range(candidates)]
    counted = long.join(grids, ["stratum", "rule"]).groupBy("stratum", "rule").agg(
        F.first("grid").alias("grid"), F.count_if(F.expr("quality = 1")).alias("n_good"), F.count_if(F.expr("quality = 0")).alias("n_bad"),
        F.array(*(F.count_if((F.col("quality") == 1) & x) for x in above)).alias("good"),
        F.array(*(F.count_if((F.col("quality") == 0) & x) for x in above)).alias("bad"),
    )
    useful = "get(bad, i) * (n_good + 1) >= %d * (get(good, i) + 1) * n_bad and get(bad, i) > 0" % LIFT
    cuts = counted.select("stratum", "rule", F.expr(f"transform(grid, (c, i) -> if({useful}, c, null))").alias("cuts"))
    joint = cuts.groupBy("stratum").agg(F.array_sort(F.collect_list(F.struct("rule", "cuts"))).alias("by_rule"))
    steps = f"transform(sequence(0, {candidates - 1}), i -> transform(by_rule, r -> get(r.cuts, i)))"
    return joint.select("stratum", F.expr(steps).alias("path"))


def cutoffs(
    labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, candidates: int = CANDIDATES, rules: dict[str, str] = RULES,
    by: str = "doc_id",
) -> DataFrame:
    """``stratum, rule, cutoff`` of the chosen certified step, from ``stratum, quality``, the measures and ``by``.

    ``by`` names what may be labelled only once in a stratum. Documents are counted per step in one pass; all
    later rows are strata times steps.
    """
    known = labelled.filter("quality in (0, 1)").select("stratum", by, "quality", _values(rules).alias("values"))
    known = known.groupBy("stratum", by).agg(F.min("quality").alias("quality"), F.min("values").alias("values"))
    known = materialize(
        known.select("stratum", "quality", "values", (F.pmod(F.xxhash64(by), F.lit(OFFERING)) == 0).alias("offers")), "known"
    )
    offered = materialize(paths(known.filter("offers"), rules, candidates), "paths")
    rejects = [
        F.exists(F.arrays_zip("values", F.get("path", F.lit(i)).alias("cuts")), lambda x: x["values"] > x["cuts"]) for i in range(candidates)
    ]

    def share(of: str) -> Column:
        n = F.count_if(F.expr(of))
        return F.array(*(F.coalesce(F.try_divide(F.count_if(F.expr(of) & F.coalesce(x, F.lit(False))), n), F.lit(0.0)) for x in rejects))

    counted = known.join(offered, "stratum").groupBy("stratum").agg(
        F.first("path").alias("path"), F.count_if(F.expr("not offers and quality = 1")).alias("n"),
        F.array(*(F.count_if(F.expr("not offers and quality = 1") & F.coalesce(x, F.lit(False))) for x in rejects)).alias("k"),
        share("offers and quality = 0").alias("bad"), share("offers and quality = 1").alias("good"),
    )
    tests = counted.select(
        "stratum", "n", F.posexplode(F.arrays_zip("k", F.col("path").alias("cuts"), "bad", "good")).alias("step", "at")
    ).select("stratum", "n", "step", "at.k", "at.cuts", (F.col("at.bad") - F.col("at.good")).alias("gain"))
    strata = max(1, offered.count())
    passed = tests.withColumn("passed", binomial_tail(F.col("n"), F.col("k"), alpha) <= delta / strata)
    so_far = Window.partitionBy("stratum").orderBy("step")
    certified = passed.withColumn("certified", F.min("passed").over(so_far)).filter("certified and gain > 0")
    chosen = certified.groupBy("stratum").agg(F.max(F.struct("gain", (-F.col("step")).alias("mild"), "cuts")).alias("best"))
    names = F.array(*map(F.lit, rules))
    return chosen.select("stratum", F.posexplode("best.cuts").alias("i", "cutoff")).filter("cutoff is not null").select(
        "stratum", F.get(names, F.col("i")).alias("rule"), "cutoff"
    )


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document."""
    own = docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), doc_key(docs).alias("doc_key"), F.xxhash64("text").alias("text_key"))
    table = materialize(measured(own, keep=("stratum", "doc_key", "text_key")), "measures")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = cutoffs(materialize(table.filter(~base_failed()).join(known, "doc_id"), "labelled"), alpha, delta, by="text_key")
    limits = materialize(chosen.groupBy("stratum").pivot("rule", list(RULES)).agg(F.min("cutoff")), "cutoffs")
    renamed = limits.select("stratum", *(F.col(r).alias(f"max_{r}") for r in RULES))
    rejected = F.lit(False)
    for name, rule in RULES.items():
        value = F.coalesce(F.try_divide(*map(F.col, rule.split(" / "))), F.lit(0.0))
        rejected = rejected | F.coalesce(value > F.col(f"max_{name}"), F.lit(False))
    failed = base_failed()
    return table.join(renamed, "stratum", "left").select(
        "doc_id", *MEASURES, failed.alias("base_failed"), (~failed & ~rejected).alias("kept"), "doc_key"
    )


def passing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    gone = judged(docs, labels).filter(~F.col("kept")).select("doc_id", "doc_key").distinct()
    return without(docs, materialize(gone, "rejected"))
